"""Removal of repeated byte strings across documents, by sorting suffixes with hashed comparisons.

A string of LENGTH bytes is repeated if it also starts earlier. To compare only what can be equal, every window of LENGTH bytes
is represented by the least hash among its runs of GRAM bytes (its anchor): equal windows have equal anchors. Neighbouring
windows mostly share their anchor, so one entry stands for a run of windows.

Entries meet by anchor. Where whole runs are equal the earliest stays and the others go, once their bytes are compared with the
earliest's: directly within a batch, by SHA-256 of the bytes across batches. Where runs differ around one anchor,
their bytes are fetched, and the suffixes from the anchors on are sorted by a mergesort whose comparisons take the longest
common extension from prefix polynomial hashes by binary search. Neighbours in that order tell how far a run agrees with any
other; windows within that reach are compared by hash, and byte by byte before anything is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import landed, map_batches, sized
from fieldbook.llm.words import mix, series, text_bytes
from fieldbook.session import shuffle_width

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM + 1  # runs of GRAM bytes in a window
#: Texts are taken together up to so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19
#: Bytes of text whose entries are sorted together before they are sent, and of the text for each bucket of anchors.
PACK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
VALUES = series(256, 3)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LAST = np.iinfo(np.int64).max  # stands for a null id: after all others

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            size = max(n, BLOCK_BYTES + LENGTH)
            for i, b in enumerate((BASE, INVERSE)):
                _POWERS[i] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))])
    return _POWERS[0], _POWERS[1]


class Prefix:
    """Prefix polynomial hashes of a byte string; the hash of any stretch in constant time."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[data] * power[: len(data)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.inverse[start]


def anchors(data: np.ndarray, offsets: np.ndarray, prefix: Prefix) -> tuple[np.ndarray, ...]:
    """For each anchor of a block of texts: its place, hash, and first and last window; windows never cross texts."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at = np.arange(len(data) - GRAM + 1)
    grams = mix(prefix.of(at, at + GRAM))
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    least = (grams >> bits << bits) | at.astype(np.uint64)  # leftmost of the least
    width = 1
    while width * 2 <= REACH:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :])[:n]
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    window = np.arange(n)
    text = np.searchsorted(offsets, window, "right") - 1
    inside = window + LENGTH <= offsets[text + 1]
    window, place = window[inside], place[inside]
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)]))
    last = np.append(first[1:], len(window)) - 1
    return place[first], grams[place[first]], window[first], window[last]


def byte_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each owner joined where they touch or overlap."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    shift = (int(end.max()) + 2) * (np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]])))
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], start[1:] + shift[1:] > reach[:-1]])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(new)) - 1
    return owner[heads], start[heads], reach[tails] - shift[heads]


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the stretches of the data that start at a and at b hold the same bytes."""
    out = size_a == size_b
    for part in np.array_split(np.flatnonzero(out), int(out.sum()) // 5_000 + 1):
        if len(part):
            size = size_a[part]
            heads = np.cumsum(size) - size
            step = np.arange(int(size.sum())) - np.repeat(heads, size)
            out[part] = np.logical_and.reduceat(data[np.repeat(a[part], size) + step] == data[np.repeat(b[part], size) + step], heads)
    return out


ENTRY = np.dtype([("anchor", "<u8"), ("run", "<u8"), ("owner", "<u2"), ("place", "<u4"), ("before", "u1"), ("after", "u1")])


def packed_anchors(df: DataFrame, n_buckets: int) -> DataFrame:
    """Entries of every text (``_id``, ``_hash``, ``_text``), many to a row, by bucket of their anchors.

    Of entries of one batch with the same run of windows only the earliest goes to its bucket; the others are repeats already,
    and their ranges stand in ``ranges`` (id, hash, start, end), joined by text, so a large group of copies is sent once a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size = np.cumsum(np.diff(text_bytes(whole.column(2))[1]))
            cuts = np.flatnonzero(np.diff(size // PACK_BYTES, prepend=0)).tolist()
            for at, to in zip([0, *cuts], [*cuts, whole.num_rows], strict=True):
                for part in range(at, to, 10_000):
                    yield from pack(whole.slice(part, min(to - part, 10_000)))

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).fill_null(int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        parts = []
        for first, data, offsets in byte_blocks(batch.column(2)):
            prefix = Prefix(data)
            place, gram, lo, hi = anchors(data, offsets, prefix)
            text = np.searchsorted(offsets, place, "right") - 1
            with np.errstate(over="ignore"):
                run_hash = mix(prefix.of(lo, hi + LENGTH) + (place - lo).astype(np.uint64) * np.uint64(131) + (hi - lo).astype(np.uint64))
            parts.append((gram, run_hash, text + first, place - offsets[text], place - lo, hi - place))
        if not parts:
            return
        gram, run_hash, owner, place, before, after = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((place, hashes[owner], ids[owner], run_hash, gram))
        gram, run_hash, owner, place, before, after = (x[order] for x in (gram, run_hash, owner, place, before, after))
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (run_hash[1:] != run_hash[:-1])]) if len(gram) else np.zeros(0, bool)
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else new
        # rows that repeat id and text are one document: its copies are no repeats of one another
        same = (ids[owner] == ids[owner[head]]) & (hashes[owner] == hashes[owner[head]]) & (place == place[head])
        again = ~new & ~same
        data, offsets = text_bytes(batch.column(2))
        at, size = offsets[owner] + place - before, before + after + LENGTH
        some = np.flatnonzero(again)
        unlike = some[~equal_bytes(data, at[some], at[head[some]], size[some], size[head[some]])]
        again[unlike], new[unlike] = False, True
        who, start, end = merged(owner[again], (place - before)[again], (place + after)[again] + LENGTH)
        ranges = np.stack([ids[who], hashes[who], start, end], 1).astype(np.int64)
        entries = np.zeros(int(new.sum()), ENTRY)
        entries["anchor"], entries["run"], entries["owner"] = gram[new], run_hash[new], owner[new]
        entries["place"], entries["before"], entries["after"] = place[new], before[new], after[new] + 128
        # place minus first window is 0 to 68, last window minus place is -68 to 0
        # anchors are least hashes, so their own high bits are nearly all low: they are mixed before they are dealt out
        bucket = ((mix(entries["anchor"]) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        entries, bucket = entries[by_bucket], bucket[by_bucket]
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        rows = {"bucket": [], "entries": [], "keys": [], "ranges": []}
        for n in np.flatnonzero(np.diff(cuts)):
            part = entries[cuts[n] : cuts[n + 1]].copy()
            some, short = np.unique(part["owner"], return_inverse=True)
            part["owner"] = short
            rows["bucket"].append(int(n)), rows["entries"].append(part.tobytes()), rows["ranges"].append(b"")
            rows["keys"].append(np.stack([ids[some], hashes[some]], 1).tobytes())
        if len(ranges):
            rows["bucket"].append(int(np.uint64(hashes[0] & 0x7FFFFFFF) % np.uint64(n_buckets))), rows["ranges"].append(ranges.tobytes())
            rows["entries"].append(b""), rows["keys"].append(b"")
        yield pa.RecordBatch.from_arrays([pa.array(rows["bucket"], pa.int64()), *(pa.array(rows[c], pa.binary()) for c in ("entries", "keys", "ranges"))], list(rows))

    return df.mapInArrow(run, "bucket bigint, entries binary, keys binary, ranges binary")


#: ``place`` is VERIFIED for a range whose bytes were compared, CLAIMED for one that should equal a range of ``of_id``, ``of_hash``
#: that starts at ``of_start``.
VERIFIED, CLAIMED = -1, -2
FOUND = "_id bigint, _hash bigint, start int, end int, place int, anchor bigint, of_id bigint, of_hash bigint, of_start int"


def _table(columns: list[np.ndarray]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    names = ("_id", "_hash", "start", "end", "place", "anchor", "of_id", "of_hash", "of_start")
    return pa.table([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds, strict=True)], names=names)


def met_by_anchor(packed: DataFrame) -> DataFrame:
    """Ranges that whole runs repeat, and the earliest entry of each run where runs differ around an anchor
    (``start`` and ``end`` then bound the bytes of its windows)."""

    def run(rows: pa.Table) -> pa.Table:
        entries, keys, ranges = [], [], [np.zeros((0, 4), np.int64)]
        for e, k, r in zip(*(rows[c].to_pylist() for c in ("entries", "keys", "ranges")), strict=True):
            part = np.frombuffer(e, ENTRY)
            entries.append(part), keys.append(np.frombuffer(k, np.int64).reshape(-1, 2)[part["owner"]])
            if r:
                ranges.append(np.frombuffer(r, np.int64).reshape(-1, 4))
        entries, keys, ranges = np.concatenate(entries), np.concatenate(keys), np.concatenate(ranges)
        order = np.lexsort((entries["place"], keys[:, 1], keys[:, 0], entries["run"], entries["after"], entries["before"], entries["anchor"]))
        entries, keys = entries[order], keys[order]
        anchor, run_hash = entries["anchor"], entries["run"]
        place = entries["place"].astype(np.int64)
        start, end = place - entries["before"], place + entries["after"].astype(np.int64) - 128 + LENGTH
        change = lambda *columns: np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]) if len(anchor) else np.zeros(0, bool)
        new = change(anchor, run_hash, entries["before"], entries["after"])
        group = change(anchor)
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else new.astype(int)
        same = (keys[:, 0] == keys[head, 0]) & (keys[:, 1] == keys[head, 1]) & (place == place[head])
        gone = ~new & ~same
        runs = np.bincount(np.cumsum(group) - 1, weights=new) if len(new) else np.zeros(0)
        unclear = new & (runs[np.cumsum(group) - 1] > 1) if len(new) else new
        none, rest = np.zeros(len(ranges), np.int64), np.zeros(int(unclear.sum()), np.int64)
        return _table([
            np.concatenate([ranges[:, 0], keys[gone, 0], keys[unclear, 0]]), np.concatenate([ranges[:, 1], keys[gone, 1], keys[unclear, 1]]),
            np.concatenate([ranges[:, 2], start[gone], start[unclear]]), np.concatenate([ranges[:, 3], end[gone], end[unclear]]),
            np.concatenate([none + VERIFIED, np.full(gone.sum(), CLAIMED), place[unclear]]),
            np.concatenate([none, np.zeros(gone.sum(), np.int64), anchor[unclear].astype(np.int64)]),
            *(np.concatenate([none, x[head][gone], rest]) for x in (keys[:, 0], keys[:, 1], start)),
        ])

    return packed.groupBy("bucket").applyInArrow(run, FOUND)


class Suffixes:
    """Suffixes of one byte string, compared through prefix polynomial hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end, self.prefix = data, start, end, Prefix(data)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of pairs of suffixes, by binary search over hashes."""
        x, y = self.start[a], self.start[b]
        lo, hi = np.zeros(len(a), np.int64), np.minimum(self.end[a] - x, self.end[b] - y)
        while (some := lo < hi).any():
            middle = (lo + hi + 1) // 2
            equal = self.prefix.of(x, x + middle) == self.prefix.of(y, y + middle)
            lo, hi = np.where(some & equal, middle, lo), np.where(some & ~equal, middle - 1, hi)
        return lo

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b; a suffix that ends first comes first, and equal ones are not before each other."""
        common = self.extension(a, b)
        x, y = self.start[a] + common, self.start[b] + common
        over_a, over_b = x >= self.end[a], y >= self.end[b]
        edge = len(self.data) - 1
        less = self.data[np.minimum(x, edge)] < self.data[np.minimum(y, edge)]
        return ~over_b & (over_a | less)

    def sort(self) -> np.ndarray:
        """Mergesort from the bottom up; all merges of a level at once, each suffix finding its rank in the other half."""
        n = len(self.start)
        order = np.arange(n)
        width = 1
        while width < n:
            at = np.arange(n)
            base = at // (2 * width) * (2 * width)
            left = at - base < width
            lo = np.where(left, np.minimum(base + width, n), base)
            hi = np.where(left, np.minimum(base + 2 * width, n), np.minimum(base + width, n))
            other = lo.copy()
            while (some := lo < hi).any():
                middle = (lo + hi) // 2
                where = np.flatnonzero(some)
                mine, theirs = order[where], order[middle[where]]
                # a suffix of the left half goes before its equals in the right half
                right_first = np.where(left[where], self.before(theirs, mine), ~self.before(mine, theirs))
                lo[where] = np.where(right_first, middle[where] + 1, lo[where])
                hi[where] = np.where(right_first, hi[where], middle[where])
            rank = base + (at - base - np.where(left, 0, width)) + (lo - other)
            placed = np.empty_like(order)
            placed[rank] = order
            order = placed
            width *= 2
        return order


def repeated_windows(ids: np.ndarray, hashes: np.ndarray, start: np.ndarray, place: np.ndarray, bytes_of: list[bytes], anchor: np.ndarray) -> list[np.ndarray]:
    """Ranges of windows that an earlier entry with the same anchor holds too: id, hash, start, end."""
    sizes = np.array([len(b) for b in bytes_of], np.int64)
    heads = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(bytes_of), np.uint8)
    suffixes = Suffixes(data, heads + place - start, heads + sizes)
    order = suffixes.sort()
    near = suffixes.extension(order[:-1], order[1:])
    reach = np.zeros(len(order), np.int64)
    reach[order[1:]], reach[order[:-1]] = near, np.maximum(near, reach[order[:-1]])
    reach[order[1:]] = np.maximum(reach[order[1:]], near)
    # windows of an entry that end within what it shares with a neighbour
    count = np.clip(np.minimum(sizes - LENGTH, place - start + reach - LENGTH) + 1, 0, None)
    entry = np.repeat(np.arange(len(sizes)), count)
    window = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = heads[entry] + window
    content = suffixes.prefix.of(at, at + LENGTH)
    absolute = start[entry] + window
    sort = np.lexsort((absolute, hashes[entry], ids[entry], content))
    entry, at, content, absolute = entry[sort], at[sort], content[sort], absolute[sort]
    new = np.concatenate([[True], content[1:] != content[:-1]]) if len(content) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else new.astype(int)
    gone = np.flatnonzero(~new & ~((ids[entry] == ids[entry[head]]) & (hashes[entry] == hashes[entry[head]]) & (absolute == absolute[head])))
    span = np.arange(LENGTH)
    truly = np.concatenate([np.zeros(0, bool), *((data[at[g][:, None] + span] == data[at[head[g]][:, None] + span]).all(1) for g in np.array_split(gone, len(gone) // 20_000 + 1))])
    gone = gone[truly]
    who, first, last = merged(entry[gone], absolute[gone], absolute[gone] + LENGTH)
    return [ids[who], hashes[who], first, last]


def verified(claimed: DataFrame, texts: DataFrame) -> DataFrame:
    """Those claimed ranges whose bytes are those of the range they should equal; ``texts`` has ``_id``, ``_hash``, ``_text``.

    Runs that follow each other in both texts are joined, so their bytes are read once.
    """
    shift = (F.col("start") - F.col("of_start")).alias("shift")
    pairs = claimed.groupBy("_id", "_hash", "of_id", "of_hash", shift).agg(F.collect_list(F.struct("start", "end")).alias("_r"))

    def join(batch: pa.RecordBatch) -> dict:
        lists = batch.column(5)
        inner = lists.flatten()
        owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        who, start, end = merged(owner, *(inner.field(i).to_numpy().astype(np.int64) for i in (0, 1)))
        ids = {name: batch.column(i).to_numpy()[who] for i, name in enumerate(("_id", "_hash", "of_id", "of_hash"))}
        return ids | {"start": start, "end": end, "of_start": start - batch.column(4).to_numpy()[who]}

    schema = "_id bigint, _hash bigint, of_id bigint, of_hash bigint, start int, end int, of_start int"
    pairs = landed(map_batches(pairs, schema, join), "claimed")

    def digests(ranges: DataFrame, names: list[str]) -> DataFrame:
        """``ranges`` has the four columns named (id, hash, start, size), and perhaps more; adds the digest of the bytes."""
        id_, hash_, start, size = names
        wanted = ranges.groupBy(id_, hash_).agg(F.collect_list(F.struct(*[c for c in ranges.columns if c not in (id_, hash_)])).alias("_w"))
        there = texts.select(F.col("_id").alias(id_), F.col("_hash").alias(hash_), "_text")
        some = there.join(sized(landed(wanted.select(id_, hash_), "claimed-texts")), [id_, hash_], "left_semi").dropDuplicates([id_, hash_])
        each = some.join(wanted, [id_, hash_]).select(id_, hash_, F.encode("_text", "UTF-8").alias("_b"), F.explode("_w").alias("_w"))
        piece = F.substring("_b", F.col(f"_w.{start}") + 1, F.col(f"_w.{size}"))
        return each.select(id_, hash_, "_w.*", F.sha2(piece, 256).alias("digest"))

    pairs = pairs.withColumn("size", F.col("end") - F.col("start"))
    key = ["of_id", "of_hash", "of_start", "size"]
    first = sized(landed(digests(pairs.select(*key).distinct(), key), "digests"))
    mine = digests(pairs, ["_id", "_hash", "start", "size"])
    return mine.join(first, [*key, "digest"], "left_semi").select("_id", "_hash", "start", "end")


def repeats(df: DataFrame) -> DataFrame:
    """``_id``, ``_hash`` and ranges (``start``, ``end`` in bytes) that are repeated, over all texts of ``df``."""
    volume = df.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    n_buckets = max(shuffle_width(df.sparkSession), -(-volume // BUCKET_BYTES))
    found = landed(met_by_anchor(packed_anchors(df.select("_id", "_hash", "_text"), n_buckets)), "anchors")
    on = F.coalesce(df["_id"], F.lit(int(LAST)))
    keyed = df.select(on.alias("_id"), "_hash", "_text")
    whole = found.where(F.col("place") == VERIFIED).select("_id", "_hash", "start", "end")
    whole = whole.unionByName(verified(found.where(F.col("place") == CLAIMED), keyed))
    wanted = landed(
        found.where("place >= 0").groupBy("_id", "_hash").agg(F.collect_list(F.struct("start", "end", "place", "anchor")).alias("_w")), "unclear"
    )
    some = sized(wanted.select("_id", "_hash"))
    texts = keyed.join(some, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    pieces = texts.join(wanted, ["_id", "_hash"]).select("_id", "_hash", F.encode("_text", "UTF-8").alias("_b"), F.explode("_w").alias("_w"))
    piece = F.substring("_b", F.col("_w.start") + 1, F.col("_w.end") - F.col("_w.start"))
    pieces = pieces.select("_id", "_hash", "_w.start", "_w.place", "_w.anchor", piece.alias("bytes"), F.pmod("_w.anchor", F.lit(4 * n_buckets)).alias("bucket"))

    def run(rows: pa.Table) -> pa.Table:
        ids, hashes, start, place, anchor = (rows[c].to_numpy().astype(np.int64) for c in ("_id", "_hash", "start", "place", "anchor"))
        out = repeated_windows(ids, hashes, start, place, rows["bytes"].to_pylist(), anchor)
        return pa.table([pa.array(c.astype(k)) for c, k in zip(out, (np.int64, np.int64, np.int32, np.int32), strict=True)], names=["_id", "_hash", "start", "end"])

    partly = pieces.groupBy("bucket").applyInArrow(run, "_id bigint, _hash bigint, start int, end int")
    return whole.unionByName(partly)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id_col, ``n_bytes``, ``spans`` (merged removed ranges of bytes) and ``kept`` (the bytes that are left).

    A byte goes if a string of LENGTH bytes around it also starts earlier: in a row with a smaller id, or in the same text. Null
    and empty texts, and texts of fewer bytes, keep all they have. Rows with equal id and text are one document and get the same
    result; different texts under one id follow each other by hash; null ids come last. Ids are whole numbers.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    per_text = landed(
        repeats(rows).groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "end")).alias("_ranges")), "ranges"
    )
    some = sized(per_text.select(F.col("_id").alias("_k"), "_hash"))
    rows = rows.withColumn("_k", F.coalesce("_id", F.lit(int(LAST))))
    hit = rows.join(some, ["_k", "_hash"], "left_semi").join(per_text.withColumnRenamed("_id", "_k"), ["_k", "_hash"])
    free = rows.join(some, ["_k", "_hash"], "left_anti")
    kind = dict(df.dtypes)[id_col]
    spans = "array<struct<start:int,end:int>>"

    def cut(batch: pa.RecordBatch) -> dict:
        out_spans, kept, size = [], [], []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data = text.encode()
            start, end = (np.array([r[c] for r in ranges], np.int64) for c in ("start", "end"))
            _, start, end = merged(np.zeros(len(start), np.int64), start, end)
            edges = [0, *np.stack([start, end], 1).reshape(-1).tolist(), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            out_spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist(), strict=True)])
            size.append(len(data))
        return {id_col: batch.column(0), "n_bytes": size, "spans": out_spans, "kept": kept}

    schema = f"`{id_col}` {kind}, n_bytes bigint, spans {spans}, kept binary"
    changed = map_batches(hit.select("_id", "_text", "_ranges"), schema, cut)
    same = free.select(
        F.col("_id").alias(id_col), F.octet_length("_text").cast("bigint").alias("n_bytes"), F.array().cast(spans).alias("spans"), F.encode("_text", "UTF-8").alias("kept")
    )
    return changed.unionByName(same)
