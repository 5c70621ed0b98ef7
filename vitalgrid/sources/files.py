"""Many files read by tasks: they are found, cut into pieces and numbered without a list of them on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.session import scratch, settle
from vitalgrid.sinks import staged
from vitalgrid.sources import lines as L

#: A file is read in pieces of so many bytes; what a task lists or reads on average.
PIECE_BYTES = 8 << 20
FOLDERS_PER_TASK, FILES_PER_TASK, BYTES_PER_TASK = 1000, 2000, 64 << 20
_BOM = b"\xef\xbb\xbf"


def _is_hidden(name: str) -> bool:
    """Whether Spark's readers leave the name out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def listed(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(source_file, size) of files below ``root`` whose names end in ``suffix``, found folder by folder.

    A level of folders is one job; its list is written.
    """

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fs, base = staged.store(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for x in fs.get_file_info(pafs.FileSelector(f"{base}/{folder}" if folder else base)):
                    if not _is_hidden(x.base_name):
                        name = f"{folder}/{x.base_name}" if folder else x.base_name
                        yield name, x.size, x.type == pafs.FileType.Directory

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return staged.in_batches(children(batches), ("source_file", pa.string()), ("size", pa.int64()), ("is_folder", pa.bool_()))

    folders, n, levels = spark.createDataFrame([("",)], "source_file string"), 1, []
    while n:
        dealt = folders.repartition(staged.tasks_for(spark, n / FOLDERS_PER_TASK) if n > 1 else 1)
        levels.append(settle(dealt.mapInArrow(told, "source_file string, size bigint, is_folder boolean")))
        folders = levels[-1].where("is_folder").select("source_file")
        n = folders.count()
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.where(~F.col("is_folder") & F.col("source_file").endswith(suffix)).drop("is_folder")


def _first_line(held: pa.NativeFile, at: int, size: int) -> int:
    """Where the first line begins at ``at`` or behind it; lines end in \\n, \\r or both."""
    if at == 0 or at >= size:
        return min(at, size)
    place = at - 1
    held.seek(place)
    while block := held.read(1 << 16):
        ends = [i for i in (block.find(b"\n"), block.find(b"\r")) if i >= 0]
        if ends:
            end = min(ends)
            if block[end : end + 1] == b"\r":
                held.seek(place + end + 1)
                return place + end + 1 + (held.read(1) == b"\n")
            return place + end + 1
        place += len(block)
    return size


def _piece(fs: pafs.FileSystem, path: str, start: int, size: int, most: int) -> list[bytes]:
    """Lines that begin in the piece of at most ``most`` bytes at ``start``."""
    if size <= most:
        with fs.open_input_stream(path, compression=None) as held:
            text = held.read()
    else:
        with fs.open_input_file(path) as held:
            at, to = (_first_line(held, x, size) for x in (start, start + most))
            held.seek(at)
            text = held.read(max(0, to - at))
    if start == 0 and text.startswith(_BOM):
        text = text[3:]
    if b"\r" in text:
        text = text.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    return text.removesuffix(b"\n").split(b"\n") if text else []


def read_lines(spark: SparkSession, root: str, suffix: str = ".csv", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """All lines of these files as ``lines.read_lines`` gives them, written once.

    Spark's own reader keeps a list of all files on the driver and opens few in
    a task. Here tasks list folders and read pieces of files; a piece numbers
    its lines, and only lines of files in several pieces are numbered on by a join.
    Where ``root`` is in a store of Spark's alone, Spark's reader is taken.
    """
    if not staged.is_known(root):
        return L.read_lines(spark, root, f"*{suffix}")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fs, base = staged.store(root)
        for batch in batches:
            for x in batch.to_pylist():
                for at, line in enumerate(_piece(fs, f"{base}/{x['source_file']}", x["start"], x["size"], piece_bytes)):
                    yield x["source_file"], x["start"], at, line

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = ("source_file", pa.string()), ("start", pa.int64()), ("line_no", pa.int64()), ("line", pa.binary())
        return staged.in_batches(numbered(batches), *kinds)

    with scratch(spark):
        found = listed(spark, root, suffix).where("size > 0")
        first, step = (F.lit(x).cast("bigint") for x in (0, piece_bytes))
        pieces = found.withColumn("start", F.explode(F.sequence(first, F.col("size") - 1, step)))
        n, largest, total = pieces.agg(F.count(F.lit(1)), F.max("size"), F.sum(F.least("size", step))).first()
        tasks = staged.tasks_for(spark, n / FILES_PER_TASK, (total or 0) / BYTES_PER_TASK)
        read = pieces.repartition(tasks, "source_file", "start").mapInArrow(told, "source_file string, start bigint, line_no bigint, line binary")
        lines = settle(read.withColumn("line", F.col("line").cast("string")), lasting=True)
        if (largest or 0) <= piece_bytes:
            return lines.drop("start")
        before = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        cut = found.where(F.col("size") > piece_bytes).select("source_file")
        counts = lines.join(cut, "source_file", "left_semi").groupBy("source_file", "start").agg(F.count(F.lit(1)).alias("_n"))
        shifts = counts.select("source_file", "start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
        moved = lines.join(settle(shifts, lasting=True), ["source_file", "start"], "left")
        return moved.select("source_file", (F.col("line_no") + F.coalesce("_shift", F.lit(0))).alias("line_no"), "line")
