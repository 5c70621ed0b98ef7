import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd_documents import none, odd  # noqa: F401

from vitalgrid.llm import bpe, packing
from vitalgrid.llm.common import tokenizer_file

tokenizers = pytest.importorskip("tokenizers")
WORDS, BYTES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")


def library(path):
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def texts(n):
    rnd = random.Random(3)
    pool = [chr(i) for i in range(0x250)] + ["  ", "<|endoftext|>", "'s", "'LL", "\u03a3", "\u4e2d", "\U0001f642", "\ufb01", "e\u0301"] + list("etaoin ") * 30
    made = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, 40))) for _ in range(n)]
    return [*made, "a" * 20_000, " " * 9000 + "x", "é" * 3000, "<|startoftext|>a<|endoftext|>", *map(chr, range(0x250))]


def test_fragments_equal_the_library():
    own, other = bpe.codec(WORDS), library(WORDS)
    for t in texts(1500):
        ids = other.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids, t
        assert own.decode(np.array(ids, np.int32)) == other.decode(ids, skip_special_tokens=False)


def test_every_pair_inside_a_token_is_kept_together():
    own = bpe.codec(WORDS)
    assert all(len(own.cut(t.removesuffix("</w>"))) == 1 for t in list(own.vocab)[:20_000] if t != "</w>")
    outside = next(a + b for a in own.letters for b in own.letters if a + b not in own.joined)
    assert own.cut(outside * 2)[0] == outside[0]


def test_packing_ids_equal_the_library():
    own, other = packing.encoder(BYTES), library(BYTES)
    for t in texts(1500):
        assert own(t).tolist() == other.encode(t, add_special_tokens=False).ids, t


def test_deal_places_every_token_once():
    rnd = random.Random(5)
    for _ in range(30):
        lengths = [rnd.randint(1, 2047) for _ in range(rnd.randint(0, 60))]
        parts, filled = defaultdict(list), defaultdict(list)
        for piece, start, n, at, offset in packing.deal(lengths, packing.Plan()):
            parts[piece].append((start, n))
            filled[at].append((offset, n))
        for i, length in enumerate(lengths):
            end = 0
            for start, n in sorted(parts[i]):
                assert start == end
                end += n
            assert end == length
        for pieces in filled.values():
            total = sum(n for _, n in pieces)
            assert total == 2048 or total & (total - 1) == 0


def test_costs_are_balanced():
    lengths = [1024] * 4 + [64] * 64
    cost = defaultdict(float)
    for _, _, n, at, _ in packing.deal(lengths, packing.Plan()):
        cost[at] += n + n * n / 2048
    assert max(cost.values()) <= 1.2 * min(cost.values())


@pytest.mark.parametrize("lot", [4_000_000, 3000])
def test_pieces_of_odd_documents(spark, odd, lot):
    got = packing.pack(odd.repartition(3), BYTES, packing.Plan(lot_tokens=lot)).toPandas()
    other = library(BYTES)
    want = defaultdict(int)
    for row in odd.collect():
        want[row["doc_id"]] += len(other.encode(row["text"] or "", add_special_tokens=False).ids) + 1
    sums = got.groupby("doc_id", dropna=False)["length"].sum()
    assert {None if k != k else int(k): v for k, v in sums.items()} == want
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset.to_numpy() == np.cumsum([0, *s.length[:-1]])).all()
        total = s.length.sum()
        assert total == 2048 or total & (total - 1) == 0
    one = got[got.doc_id == 4].iloc[0]
    ids = np.array([*other.encode("one", add_special_tokens=False).ids, 1], "<u4")
    assert one.ids_crc32 == zlib.crc32(ids.tobytes()) and one.doc_tokens == len(ids)


def test_encode_odd_documents(spark, odd):
    other = library(WORDS)
    got = bpe.encode_decode(odd, WORDS).collect()
    assert len(got) == odd.count()
    want = sorted((r["doc_id"] or 0, other.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd.collect())
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in got) == want
    assert all(r["decoded"] == other.decode(r["ids"], skip_special_tokens=False) for r in got)


def test_nothing(spark, none):
    assert packing.pack(none, BYTES).count() == 0
    assert bpe.encode_decode(none, WORDS).count() == 0
