"""Byte-level BPE: encoding with a priority queue of merges over a doubly linked symbol list, and decoding.

The vocabulary is that of a public tokenizer file; it is read where the job starts and shipped to the tasks (its size is that
of the file, about 50,000 merges, whatever the corpus). A task keeps the ids of the pieces it has seen in a bounded cache.
"""

from __future__ import annotations

import heapq
import json
import os
import sys
import zlib
from array import array
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fieldbook.llm.common import map_batches

#: Entries kept per Python worker before the cache is emptied; pieces longer than CACHED_CHARS are never kept.
CACHE_ENTRIES, CACHED_CHARS = 300_000, 48

# The split pattern of byte-level BPE files that name no pattern of their own.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SPACE = regex.compile(r"\p{White_Space}")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable ones stand for themselves, the rest follow 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def _little(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Vocabulary:
    """Ranks of merges and strings of ids, from the text of a tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, symbols = spec["model"], byte_symbols()
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rows: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]  # by left id: right id to rank
        for rank, (a, b) in enumerate(pairs):
            self.rows[ids[a]][ids[b]] = rank
        self.made = [ids[a + b] for a, b in pairs]
        self.first = [ids[s] for s in symbols]
        to_byte = {s: bytes([b]) for b, s in enumerate(symbols)}
        self.strings = {i: b"".join(to_byte[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings.update({i: s.encode() for s, i in self.special.items()})
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.sign = os.path.commonprefix(list(self.special))  # what every special token starts with
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the lowest-ranked, leftmost merge first; an entry whose pair is no longer there is skipped.

        A queue entry is rank and position in one integer.
        """
        symbol = [self.first[b] for b in piece]
        n, rows, made, pop, push = len(symbol), self.rows, self.made, heapq.heappop, heapq.heappush
        if n == 1:
            return symbol
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [r << 32 | i for i, (a, b) in enumerate(pairwise(symbol)) if (r := rows[a].get(b)) is not None]
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            left, j = symbol[i], after[i]
            if left < 0 or j >= n or rows[left].get(symbol[j]) != rank:
                continue  # stale
            symbol[i], symbol[j] = new, _ = made[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rows[new].get(symbol[k])) is not None:
                    push(queue, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rows[symbol[h]].get(new)) is not None:
                push(queue, r << 32 | h)
        return [s for s in symbol if s >= 0]

    def part(self, token: str) -> list[int]:
        """Ids of what the pattern took as one token."""
        if (ids := self.parts.get(token)) is None:
            ids = self.merge(token.encode("utf-8", "replace"))
            if len(token) <= CACHED_CHARS:
                if len(self.parts) >= CACHE_ENTRIES:
                    self.parts.clear()
                self.parts[token] = ids
        return ids

    def packed(self, piece: str) -> bytes:
        """Ids of a stretch of text as little-endian 32-bit integers."""
        word = piece[1:] if piece[0] == " " else piece
        if word.isalpha():
            return _little(self.part(piece))
        if len(word) > 1 and word[:-1].isalpha() and word[-1] in ",.!?;:":
            return _little(self.part(piece[:-1]) + self.part(piece[-1]))
        return _little([i for token in SPLIT.findall(piece) for i in self.part(token)])

    def between_spaces(self, text: str) -> list[bytes]:
        """Tokens never cross the place before a space that a visible character follows, so text is cut there.

        A piece that is empty or starts with white space has another cut; then the pattern runs over the text as a whole.
        """
        head, *rest = text.split(" ")
        cache = self.cache
        known = list(map(cache.get, rest))
        if None in known:
            for at, piece in enumerate(rest):
                if known[at] is None:
                    if not piece or SPACE.match(piece):
                        return [self.packed(text)]
                    known[at] = cache.get(piece) or self.packed(" " + piece)
                    if len(piece) <= CACHED_CHARS:
                        if len(cache) >= CACHE_ENTRIES:
                            cache.clear()
                        cache[piece] = known[at]
        return [self.packed(head), *known] if head else known

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        got = []
        for at, part in enumerate(self.marks.split(text) if self.marks and self.sign in text else [text]):
            if at % 2:
                got.append(_little([self.special[part]]))
            elif part:
                got += self.between_spaces(part)
        return b"".join(got)

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings of packed ids, one after the other."""
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return b"".join(map(self.strings.__getitem__, numbers)).decode("utf-8", "replace")


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(content: str) -> Vocabulary:
    """One vocabulary with its cache for each Python worker, kept between tasks."""
    key = zlib.crc32(content.encode())
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(content)
    return _LOADED[key]


def tokenise(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids and decoded text of every row's whole text.

    Returns id_col, ``token_ids`` (binary: little-endian unsigned 32-bit integers), ``n_tokens`` and ``decoded``. Strings of
    special tokens inside a text become their ids. A null text counts as empty: no ids and an empty decoded text. Repeated
    rows and null ids stay as they are; other columns of ``df`` are not carried.
    """
    with open(path, encoding="utf-8") as file:
        shipped = df.sparkSession.sparkContext.broadcast(file.read())
    kind = dict(df.dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> dict:
        vocabulary = _vocabulary(shipped.value)
        coded = [vocabulary.encode(t or "") for t in batch.column(1).to_pylist()]
        return {
            id_col: batch.column(0),
            "token_ids": coded,
            "n_tokens": [len(c) // 4 for c in coded],
            "decoded": [vocabulary.decode(c) for c in coded],
        }

    return map_batches(df.select(id_col, text_col), f"`{id_col}` {kind}, token_ids binary, n_tokens bigint, decoded string", run)


def detokenise(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Text of packed token ids: the vocabulary strings one after the other. Null ids give an empty text."""
    with open(path, encoding="utf-8") as file:
        shipped = df.sparkSession.sparkContext.broadcast(file.read())
    kind = dict(df.dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> dict:
        vocabulary = _vocabulary(shipped.value)
        return {id_col: batch.column(0), "decoded": [vocabulary.decode(b or b"") for b in batch.column(1).to_pylist()]}

    return map_batches(df.select(id_col, ids_col), f"`{id_col}` {kind}, decoded string", run)
