"""Registered queries without SQL against the tokenizers library, over whole tables."""

import hashlib
import zlib

import numpy as np
from odd_documents import SMALL
from tokenizers import Tokenizer

from vitalgrid.llm.common import tokenizer_file
from vitalgrid.llm.queries import QUERIES


def texts(spark):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def test_every_piece_of_the_packing(spark):
    tok = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    tok.no_truncation()
    tok.no_padding()
    ids = {d: np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts(spark)}
    rows = QUERIES["op2_packing"](spark, SMALL).collect()
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"] and len(ids[r["doc_id"]]) == r["doc_tokens"]
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        ends = np.cumsum([0, *[n for _, n in sorted(parts)]])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 2048


def test_every_encoded_document(spark):
    tok = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    tok.no_truncation()
    tok.no_padding()
    want = {}
    for d, t in texts(spark):
        ids = tok.encode(t, add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[d] = (len(ids), digest(" ".join(map(str, ids))), digest(tok.decode(ids, skip_special_tokens=False)))
    got = QUERIES["op4_bpe_encode_decode"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
