"""Archives: read with plain gzip and a parser of the test's own, and by the engine."""

import base64
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import warc
from vitalgrid.llm.warc import Archive

SCHEMA = "page_id long, url string, html string, record_type string, shard string, digest int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(parts)


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def plain(path):
    """name -> bytes of the files, and (type, id, uri, payload digest, block) of all records, by the format's rules alone."""
    files, records = {}, []
    for name in sorted(os.listdir(path)):
        if not name.endswith(".warc.gz"):
            continue
        files[name] = open(f"{path}/{name}", "rb").read()
        left = gzip.decompress(files[name])
        while left:
            head, _, left = left.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            assert version == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines)
            block, left = left[: int(fields["Content-Length"])], left[int(fields["Content-Length"]) :]
            assert left[:4] == b"\r\n\r\n"
            left = left[4:]
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            records.append((fields, block))
    return files, records


def expected(rows, least=0):
    groups, out = {}, []
    for i, url, html in rows:
        groups.setdefault(html or "", []).append((i is None, i or 0, url is not None, url or ""))
    for i, url, html in rows:
        text = html or ""
        size, group = len(text.encode()), sorted(groups[text])
        first = (i is None, i or 0, url is not None, url or "") == group[0]
        again = size >= least and not first
        out.append((i, size, b32(text), "revisit" if again else "response", group[0][1] if again and not group[0][0] else None))
    return sorted(out, key=str)


def read(spark, path):
    rows = warc.read_archive(spark, path).collect()
    assert all(r["sound"] for r in rows)
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str), rows


def pages(n=120):
    rng = random.Random(3)
    rows = [(i, f"http://h{i % 9}.org/p?{i}", " ".join(rng.choice(["ä", "<p>", "word", "\r\n\r\n"]) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    rows += [(n + i, f"http://copy/{i}", rows[i % 7][2]) for i in range(60)]
    rows += [(n + 100, None, None), (n + 101, "http://e", ""), (None, "http://a", "only here"), (None, "http://b", "only here"), (None, "http://c", rows[5][2])]
    rows += [(n + 200, "http://x/\r\nWARC-Type: evil", "odd url"), (n + 300, "http://same", "twice"), (n + 300, "http://same/2", "twice")]
    return rows


def test_records_and_round_trip(spark, tmp_path):
    rows = pages()
    warc.write_archive(frame(spark, rows), str(tmp_path / "a"), Archive(shard_bytes=2000, roll_bytes=1500))
    got, full = read(spark, str(tmp_path / "a"))
    assert got == expected(rows)
    texts = {(i, b32(html or "")): html or "" for i, _, html in rows}
    assert all(r["payload"].decode() == texts[r["page_id"], r["payload_digest"]] for r in full if r["record_type"] == "response")
    files, records = plain(tmp_path / "a")
    assert len(files) > 5 and not [n for n in os.listdir(tmp_path / "a") if n.startswith("_temporary")]
    ids = [f["WARC-Record-ID"] for f, _ in records]
    assert len(set(ids)) == len(ids)
    by_id = {f["WARC-Record-ID"]: f for f, _ in records}
    for f, block in records:
        if f["WARC-Type"] == "revisit":
            target = by_id[f["WARC-Refers-To"]]
            assert target["WARC-Type"] == "response" and target["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
        assert f["WARC-Type"] in ("warcinfo", "response", "revisit")
    assert "http://x/%0D%0AWARC-Type:%20evil" in {f.get("WARC-Target-URI") for f, _ in records}


def test_same_rows_same_files(spark, tmp_path):
    rows, own = pages(), Archive(shard_bytes=3000, roll_bytes=1000)
    warc.write_archive(frame(spark, rows, 2), str(tmp_path / "a"), own)
    warc.write_archive(frame(spark, rows[::-1], 5), str(tmp_path / "b"), own)
    assert plain(tmp_path / "a")[0] == plain(tmp_path / "b")[0]
    order = [f["WARC-Record-ID"].split(":")[2] for f, _ in plain(tmp_path / "a")[1] if f["WARC-Type"] != "warcinfo"]
    numbers = [int(x) for x in order if x != "none"]
    assert numbers == sorted(numbers)


def test_small_payloads_and_files_roll(spark, tmp_path):
    rows = [(i, "u", "same text") for i in range(30)] + [(100 + i, "u", "ab") for i in range(5)]
    own = Archive(least_bytes=3, shard_bytes=1 << 30, roll_bytes=2000)
    warc.write_archive(frame(spark, rows), str(tmp_path / "a"), own)
    assert read(spark, str(tmp_path / "a"))[0] == expected(rows, 3)
    files, _ = plain(tmp_path / "a")
    assert len(files) > 2 and {n[:13] for n in files} == {"pages-0000000"}


def test_only_files_of_the_manifest_are_read(spark, tmp_path):
    rows = pages(20)
    warc.write_archive(frame(spark, rows), str(tmp_path / "a"))
    (tmp_path / "a" / "pages-9999999-0000.warc.gz").write_bytes(b"left by a lost task")
    assert read(spark, str(tmp_path / "a"))[0] == expected(rows)


def test_failed_job_leaves_nothing(spark, tmp_path):
    broken = frame(spark, pages(20)).withColumn("html", F.when(F.col("page_id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        warc.write_archive(broken, str(tmp_path / "a"))
    assert not os.path.exists(tmp_path / "a") or not os.listdir(tmp_path / "a")


def test_empty_table_and_damage(spark, tmp_path):
    warc.write_archive(frame(spark, []), str(tmp_path / "a"))
    assert read(spark, str(tmp_path / "a"))[0] == []
    record = warc.page_record(Archive(), 1, 0, "u", b"text", warc._sha1(b"text"), None)
    raw = next(warc.members(iter([record])))
    assert warc.parse(raw)[-1] and not warc.parse(raw.replace(b"\r\n\r\ntext", b"\r\n\r\ntexd"))[-1]
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members(iter([record[:-9]])))
