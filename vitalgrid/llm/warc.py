"""WARC archives: a deterministic sharded writer and its reader.

Writer. Payloads are digested (SHA-1), equal ones share one ``response``: the
record of the smallest id; the others are ``revisit`` records that name it.
Shards are ranges of ids, cut by the exact sum of bytes in ranges, so the same
rows give the same files on any cluster, byte for byte. Rows are range-sorted
once, each together with a small row that says what it revisits; a task writes
its shards, each record a gzip member with regenerated headers and digests, and
begins a new file when one has reached its compressed size.

Commit. A task writes under names of its own attempt in a folder of the job. When
all tasks are through, the files get their final names and a manifest that lists
them is put in place by a rename; a reader takes only files of the manifest, so
files of lost or repeated tasks are never seen. A failed job removes its folder.

Reader. One partition a file of the manifest; records are streamed, headers
parsed, and length and digests computed again.

Defined results: a null payload is an empty one. Payloads shorter than
``least_bytes`` are responses all. Of rows with equal id and payload the first in
order of the URL is the response and the others revisit it. Null ids come last:
such a row is a response only if no equal payload has an id. A null URL gives no
target header; control characters in URLs are percent-encoded. An empty table
makes an archive without files. Only id, URL and payload are read, so other
columns cannot clash. The one thing held whole is a record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from vitalgrid.session import scratch, settle, shared_folder

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest.json"
READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, sound boolean"
#: Ranges of ids whose bytes are counted to cut shards.
CELLS = 1024


@dataclass(frozen=True)
class Archive:
    #: Shorter payloads are never revisits.
    least_bytes: int = 0
    #: Payload bytes of a shard, about, and compressed bytes after which a file is full.
    shard_bytes: int = 32 << 20
    roll_bytes: int = 64 << 20
    date: str = "2025-01-01T00:00:00Z"
    level: int = 6


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _sha1(raw: bytes) -> str:
    return base32(hashlib.sha1(raw).digest())


# --- records ----------------------------------------------------------------


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    """The n-th record of an id and payload."""
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}:{copy}>"


def _page_of(urn: str) -> int | None:
    name = urn.strip("<>").split(":")[2]
    return None if name == "none" else int(name)


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record(kind: str, headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One gzip member; the same input gives the same bytes."""
    fields = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{_sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(own: Archive, page_id: int | None, copy: int, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Date", own.date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean(url)))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers is None:
        return _record("response", headers, http + payload, own.level)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", refers)]
    return _record("revisit", headers, http, own.level)


def _info(own: Archive, name: str) -> bytes:
    body = f"software: corpus archive writer\r\nformat: {VERSION.replace('/', ' File Format ')}\r\n".encode()
    headers = [("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", own.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _record("warcinfo", headers, body, own.level)


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked, one at a time."""
    left, made, inner = b"", [], zlib.decompressobj(31)
    for chunk in chunks:
        left += chunk
        while left:
            made.append(inner.decompress(left))
            left = inner.unused_data
            if inner.eof:
                yield b"".join(made)
                made, inner = [], zlib.decompressobj(31)
    if any(made) or left:
        raise ValueError("an archive file ends within a record")


def parse(raw: bytes) -> tuple | None:
    """A record as a row of the reader; None for one that holds no page."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    if first != VERSION:
        raise ValueError(f"not a record: {first[:40]!r}")
    if fields["warc-type"] not in ("response", "revisit"):
        return None
    size = int(fields["content-length"])
    block = rest[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(re.search(rb"(?mi)^content-length: (\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    sound = len(block) == size and rest[size:] == b"\r\n\r\n" and fields["warc-block-digest"] == f"sha1:{_sha1(block)}"
    kind, refers = fields["warc-type"], fields.get("warc-refers-to")
    if kind == "response":
        sound = sound and len(payload) == full and _sha1(payload) == digest
    page, refers = _page_of(fields["warc-record-id"]), _page_of(refers) if refers else None
    return page, fields.get("warc-target-uri"), kind, refers, full, digest, payload if kind == "response" else None, sound


# --- files ------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: (temporary name, final name, records, bytes)."""

    files: list[tuple[str, str, int, int]]


@dataclass
class ArchiveFile(InputPartition):
    name: str


class _Files:
    """One file after the other of a task's shards."""

    def __init__(self, own: Archive, fs: pafs.FileSystem, folder: str, attempt: str):
        self.own, self.fs, self.folder, self.attempt = own, fs, folder, attempt
        self.shard, self.roll, self.out, self.done = None, 0, None, []
        self.records = self.size = 0

    def add(self, shard: int, raw: bytes) -> None:
        if self.out is not None and (shard != self.shard or self.size >= self.own.roll_bytes):
            self.close()
        if self.out is None:
            self.roll = self.roll + 1 if shard == self.shard else 0
            self.shard, self.records, self.size = shard, 0, 0
            self.final = f"pages-{shard:07d}-{self.roll:04d}.warc.gz"
            self.temporary = f"{self.folder}/{self.attempt}-{self.final}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self._put(_info(self.own, self.final))
        self._put(raw)
        self.records += 1

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.size += len(raw)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.temporary, self.final, self.records, self.size))
            self.out = None


class ArchiveWriter(DataSourceArrowWriter):
    """Rows (shard, page_id, digest, is_page, url, payload, first_id, first_null) in order of shard, id, digest, is_page and URL."""

    def __init__(self, path: str, own: Archive):
        self.path, self.own, self.job = path.rstrip("/"), own, uuid.uuid4().hex

    def _place(self) -> tuple[pafs.FileSystem, str, str]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        return fs, root, f"{root}/_temporary-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        fs, _, folder = self._place()
        fs.create_dir(folder, recursive=True)
        files = _Files(self.own, fs, folder, f"{task.partitionId()}-{task.taskAttemptId()}")
        page: tuple | None = None  # id and digest of the rows at hand, with what they revisit
        last, copy = None, 0
        for batch in iterator:
            names = ("shard", "page_id", "digest", "is_page", "url", "payload", "first_id")
            for shard, page_id, digest, is_page, url, payload, first in zip(*[batch.column(c).to_pylist() for c in names]):
                text = base32(digest)
                if not is_page:
                    page = (page_id, digest, record_id(first, text, 0))
                    continue
                copy = copy + 1 if (page_id, digest) == last else 0
                last = (page_id, digest)
                same = page is not None and page[:2] == last and len(payload) >= self.own.least_bytes
                refers = page[2] if same else None
                files.add(shard, page_record(self.own, page_id, copy, url, payload, text, refers))
                if refers is None:
                    page = (page_id, digest, record_id(page_id, text, copy))
        files.close()
        return Written(files.done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root, folder = self._place()
        fs.create_dir(root, recursive=True)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f[1])
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: fs.move(f[0], f"{root}/{f[1]}"), files))
        fs.create_dir(folder, recursive=True)
        listed = [{"name": f[1], "records": f[2], "bytes": f[3]} for f in files]
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps({"files": listed}, indent=1).encode())
        fs.move(f"{folder}/{MANIFEST}", f"{root}/{MANIFEST}")
        fs.delete_dir(folder)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _, folder = self._place()
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def partitions(self) -> list[ArchiveFile]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_stream(f"{root}/{MANIFEST}") as held:
            return [ArchiveFile(f["name"]) for f in json.loads(held.read())["files"]]

    def read(self, partition: ArchiveFile) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        fs, root = pafs.FileSystem.from_uri(self.path)
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_())
        names = [c.split()[0] for c in READ.split(", ")]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        with fs.open_input_stream(f"{root}/{partition.name}", compression=None) as held:
            rows, size = [], 0
            for raw in members(iter(lambda: held.read(1 << 20), b"")):
                row = parse(raw)
                if row:
                    rows.append(row)
                    size += len(raw)
                if size >= 8 << 20:
                    yield made(rows)
                    rows, size = [], 0
            yield made(rows)


class ArchiveSource(DataSource):
    """``spark.read.format("page_archive")`` and its writer."""

    @classmethod
    def name(cls) -> str:
        return "page_archive"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        given = {k: v for k, v in json.loads(self.options["own"]).items()}
        return ArchiveWriter(self.options["path"], Archive(**given))


# --- plans ------------------------------------------------------------------


def _shards(facts: DataFrame, own: Archive) -> tuple[list[int], list[int], int, int]:
    """How ids become shards: of each range of ids the first shard and how many it is cut into; the lowest id and a range's width.

    Exact sums in at most ``CELLS`` ranges: neighbouring light ranges share a shard, a heavy one is cut into equal parts.
    """
    ends = facts.agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).first()
    low, high = ends["a"] or 0, ends["b"] or 0
    width = (high - low) // CELLS + 1
    cell = F.coalesce(F.expr(f"(page_id - {low}L) div {width}L"), F.lit(CELLS))
    sums = {r["c"]: r["n"] for r in facts.groupBy(cell.alias("c")).agg(F.sum("bytes").alias("n")).collect()}
    first, cuts, shard, filled = [], [], 0, 0
    for c in range(CELLS + 1):
        n = sums.get(c, 0)
        if filled and filled + n > own.shard_bytes:
            shard, filled = shard + 1, 0
        parts = max(1, -(-n // own.shard_bytes))
        first.append(shard)
        cuts.append(parts)
        shard, filled = (shard + parts, 0) if parts > 1 else (shard, filled + n)
    return first, cuts, low, width


def _revisits(facts: DataFrame, own: Archive) -> DataFrame:
    """(page_id, digest, first_id): rows whose payload stands under a smaller id.

    A frequent payload is spread over lots of its rows, so no digest is a hot key; a lot's row is one number.
    """
    lots = F.lit(max(1, facts.count() >> 12))
    cut = facts.where(F.col("bytes") >= own.least_bytes).withColumn("lot", F.pmod(F.xxhash64("page_id"), lots))
    per_lot = cut.groupBy("digest", "lot").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    least = per_lot.groupBy("digest").agg(F.min("least").alias("first_id"), F.sum("n").alias("n")).where("n > 1 AND first_id IS NOT NULL")
    marked = per_lot.select("digest", "lot").join(least.select("digest", "first_id"), "digest")
    rows = cut.select("page_id", "digest", "lot").join(marked, ["digest", "lot"]).where("page_id IS NULL OR page_id > first_id")
    return rows.select("page_id", "digest", "first_id")


def write_archive(
    pages: DataFrame, path: str, own: Archive | None = None, page_id: str = "page_id", url: str = "url", payload: str = "html"
) -> None:
    """Write all pages as WARC files below ``path`` with a manifest."""
    own = own or Archive()
    spark = pages.sparkSession
    spark.dataSource.register(ArchiveSource)
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), raw.alias("payload"))
    with scratch(spark):
        digest = F.unhex(F.sha1("payload")).alias("digest")
        facts = settle(rows.select("page_id", digest, F.octet_length("payload").cast("long").alias("bytes")))
        first, cuts, low, width = _shards(facts, own)
        nothing = F.lit(None)
        both = rows.select(
            "page_id", digest, F.lit(True).alias("is_page"), "url", "payload", nothing.cast("long").alias("first_id")
        ).unionByName(_revisits(facts, own).select(
            "page_id", "digest", F.lit(False).alias("is_page"), nothing.cast("string").alias("url"), nothing.cast("binary").alias("payload"), "first_id"
        ))
        cell = F.coalesce(F.expr(f"(page_id - {low}L) div {width}L"), F.lit(CELLS)).cast("int")
        cut = F.get(F.lit(cuts), cell).cast("long")
        # a range of more ids is cut by id; one of a single id, and rows without one, by digest
        by_id = F.call_function("div", F.expr(f"pmod(page_id - {low}L, {width}L)") * cut, F.lit(width))
        by_digest = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), cut)
        shard = F.get(F.lit(first), cell) + (F.coalesce(by_id, by_digest) if width > 1 else by_digest)
        count = first[-1] + cuts[-1]
        order = ["shard", "page_id", "digest", "is_page", "url"]
        ranged = both.withColumn("shard", shard.cast("long")).repartitionByRange(count, "shard")
        ranged.sortWithinPartitions(*order).write.format("page_archive").mode("append").option("own", json.dumps(own.__dict__)).save(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The pages of an archive, each checked against its digests (``sound``)."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("page_archive").load(path)


def round_trip(pages: DataFrame, own: Archive | None = None) -> DataFrame:
    """All pages written to a new archive in the shared folder and read back."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    write_archive(pages, path, own)
    return read_archive(spark, path).drop("payload")
