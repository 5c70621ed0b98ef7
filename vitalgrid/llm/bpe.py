"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be joined by
merges, so every such pair marks a certain cut. A word is cut there, the
fragments are encoded independently (their merges cannot touch each other), and
the results are put together. Fragments come from few letters, so a bounded
memory of finished words and fragments answers most of them.

Text is prepared as the tokenizer file says: composed (NFC), lower-cased, split
into words. For texts with characters beyond U+024F, whose Unicode tables may
differ between libraries, the tokenizers library itself prepares the words.
Truncation and padding settings of the file are not used. Special tokens
written out in a text are those tokens, as in the library.

Defined results: a null or empty text has no ids and an empty decoded text.
Repeated rows get equal results. Input columns other than the named two are not
read and cannot clash.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Finished words and fragments that a worker remembers.
REMEMBERED = 300_000
NEVER = 1 << 40
LONG_WORD = 64
#: Rows of an output batch.
ROWS = 512
BEYOND = regex.compile("[^\\x00-ɏ]")
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class _Ranks(dict):
    """Places of the merges; pairs without one come last."""

    def __missing__(self, pair):
        return NEVER


class _Memory(dict):
    """Answers by word; forgets all when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        made = self.make(key)
        if len(key) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = made
        return made


class ForcedCodec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.ranks = _Ranks({tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])})
        self.letters = byte_letters()
        self.joined = self._joined()
        self.words = _Memory(self._word)
        self.fragments = _Memory(self._fragment)
        self.library = Tokenizer.from_file(path)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _joined(self) -> set[str]:
        """Letter pairs inside some token; all other pairs are certain cuts."""
        pairs = set()
        for token in self.vocab:
            body = token.removesuffix(self.end) if self.end else token
            pairs.update(map("".join, zip(body, body[1:])))
        return pairs

    def cut(self, spelled: str) -> list[str]:
        """The fragments between the forced boundaries."""
        at = [i for i in range(1, len(spelled)) if spelled[i - 1 : i + 1] not in self.joined]
        return [spelled[a:b] for a, b in zip([0, *at], [*at, len(spelled)])]

    def _fragment(self, key: str) -> tuple[int, ...]:
        """Ids of a fragment; a line feed, which no spelling has, marks a word's end."""
        parts = list(key.rstrip("\n"))
        if key.endswith("\n"):
            parts[-1] += self.end
        if len(parts) > 512:
            parts = self._merge_long(parts)
        rank = self.ranks.__getitem__
        ranks = list(map(rank, zip(parts, parts[1:])))
        while ranks and (least := min(ranks)) != NEVER:
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]))
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]))
        return tuple(self.vocab[p] for p in parts if p in self.vocab)

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same merges with a heap, for fragments of any length."""
        import heapq

        ranks, n = self.ranks, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks[parts[i], parts[i + 1]]) != NEVER]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = a + b, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := ranks[parts[x], parts[y]]) != NEVER:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p, there in zip(parts, alive) if there]

    def _word(self, word: str) -> tuple[int, ...]:
        return self._spelled("".join(self.letters[b] for b in word.encode()))

    def _spelled(self, spelled: str) -> tuple[int, ...]:
        *first, last = self.cut(spelled)
        if not first:
            return self._fragment(last + "\n")
        return tuple(chain.from_iterable([*map(self.fragments.__getitem__, first), self.fragments[last + "\n"]]))

    def _plain(self, text: str):
        """Ids of each word of a text without special tokens."""
        if BEYOND.search(text):
            clean = self.library.normalizer.normalize_str(text)
            return [self._spelled(piece) for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]
        return map(self.words.__getitem__, WORD.findall(unicodedata.normalize("NFC", text).lower()))

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if self.marks is None or "<|" not in text:
            words = self._plain(text)
        else:
            words = chain.from_iterable(
                [(self.special[x],)] if x in self.special else self._plain(x) for x in self.marks.split(text) if x
            )
        return np.fromiter(chain.from_iterable(words), np.int32)

    def decode(self, ids) -> str:
        """Tokens joined by spaces, as the library does for a file without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedCodec:
    return ForcedCodec(path)


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the id, ids (array of int) and the text decoded from them. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = [own.encode(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                decoded = pa.array([own.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), lists, decoded], [doc_id, "ids", "decoded"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(doc_id, text).mapInArrow(run, f"`{doc_id}` {kind}, ids array<int>, decoded string")
