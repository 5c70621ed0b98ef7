"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``n + attention * n * n``. Whole sequences are cut
from long documents; what remains of each is gathered into bounded lots inside
its task, and a lot is dealt out in descending order: each piece goes to the
cheapest sequence that still has room for it, and is cut only if none has. The
sequences of a lot are as many as its tokens fill, plus a last few of lengths
that are powers of two, so none is padded.

A lot holds at most ``lot_tokens`` ids, so memory is bounded, and no row is
shuffled: an input partition packs its own documents. Sequence numbers start
with the partition's number; a repeated task reads the same rows in the same
order and gives the same pieces again.

Defined results: a null or empty text is the end token alone; repeated rows are
packed each; an empty table gives no pieces. Only the id and the text are read,
so other columns cannot clash.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vitalgrid.llm.bpe import BEYOND, byte_letters

#: Splits text before the merges of a byte-level vocabulary.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer runs without a break are left to the tokenizers library.
LONG_RUN = regex.compile(r"\S{5000}|\s{5000}")
SEQUENCE_BITS = 36


@dataclass(frozen=True)
class Plan:
    capacity: int = 2048
    end_id: int = 1
    #: Attention cost of a squared token count, against one a token.
    attention: float = 1 / 2048
    lot_tokens: int = 4_000_000


class Encoder:
    """Ids as the tokenizers library gives them.

    A rank encoder with the file's own vocabulary does the work. Texts with
    characters beyond U+024F or very long runs go to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        byte = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in told["model"]["vocab"].items() if t not in special}
        self.ranks = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if BEYOND.search(text) or (len(text) > 5000 and LONG_RUN.search(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranks.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype(np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def room_for(tokens: int, capacity: int) -> np.ndarray:
    """Sequence lengths that take exactly ``tokens``: full ones, then powers of two."""
    rest = tokens % capacity
    return np.array([capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], np.int64)


def deal(lengths: list[int], plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """(piece, from, length, sequence, offset) that place every token of the pieces."""
    size = room_for(sum(lengths), plan.capacity)
    left, cost, dealt = size.copy(), np.zeros(len(size)), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start = 0
        while start < lengths[piece]:
            n = lengths[piece] - start
            open_ = left >= n
            if not open_.any():
                open_ = left > 0
            at = int(np.argmin(np.where(open_, cost, np.inf)))
            n = min(n, int(left[at]))
            dealt.append((piece, start, n, at, int(size[at] - left[at])))
            left[at] -= n
            cost[at] += n + plan.attention * n * n
            start += n
    return dealt


def pack(docs: DataFrame, path: str, plan: Plan | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens."""
    plan = plan or Plan()
    kind = dict(docs.dtypes)[doc_id]
    names = [doc_id, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = encoder(path), TaskContext.get().partitionId() << SEQUENCE_BITS
        used, out, lot, held = 0, [], [], 0

        def piece(doc, start, ids, total, sequence, offset, size):
            out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, first + sequence, offset, size))

        def close_lot():
            nonlocal used, lot, held
            sizes = room_for(held, plan.capacity)
            for i, start, n, at, offset in deal([len(x[2]) for x in lot], plan):
                doc, begin, ids, total = lot[i]
                piece(doc, begin + start, ids[start : start + n], total, used + at, offset, int(sizes[at]))
            used, lot, held = used + len(sizes), [], 0

        def rows():
            nonlocal out
            columns = list(zip(*out)) if out else [()] * len(names)
            kinds = [id_kind, *[pa.int64()] * (len(names) - 1)]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            out = []
            return made

        id_kind = pa.int64()
        for batch in batches:
            id_kind = batch.schema.field(0).type
            ids_of_batch = batch.column(0).to_pylist()
            for doc, body in zip(ids_of_batch, batch.column(1)):
                ids = np.append(encode(body.as_py()), np.uint32(plan.end_id))
                whole = len(ids) // plan.capacity * plan.capacity
                for start in range(0, whole, plan.capacity):
                    piece(doc, start, ids[start : start + plan.capacity], len(ids), used, 0, plan.capacity)
                    used += 1
                if whole < len(ids):
                    lot.append((doc, whole, ids[whole:], len(ids)))
                    held += len(ids) - whole
                if held >= plan.lot_tokens:
                    close_lot()
                if len(out) >= 20_000:
                    yield rows()
        close_lot()
        yield rows()

    longs = ", ".join(f"{n} bigint" for n in names[1:])
    return docs.select(doc_id, text).mapInArrow(run, f"`{doc_id}` {kind}, {longs}")
