"""Prefix trie of conversations by union-find over the common prefixes of sorted neighbours.

Conversations become sequences of turn digests and are sorted over ranges. A task cuts its sorted run into forests of bounded
size. In a forest every conversation starts as a component of its own; the edges between neighbours, each as deep as their
common prefix, are taken in descending depth, and every merge of two components makes (or widens) the branching node of that
depth. The nodes between two merges belong to one component and are put out on the way up, one for each depth.

Nodes that may have members beyond the forest (prefixes that a border shares, or all of a range's first or last conversation)
stay open. What is closed below them is folded into their counts. Open nodes of adjacent forests then meet group by group, equal
prefixes are added up, and those that no border of the group shares are closed, until one group is left and the root closes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import landed, sized

#: Bytes of a turn's and of a node's digest; turns of a forest; forests that meet at once; characters of one row of ids.
WIDTH, FOREST_TURNS, MEET, IDS_CHARS, OUT_ROWS = 16, 100_000, 64, 60_000, 5000
CLOSED, OPEN, IDS = 0, 1, 2
#: In place of a hash of ids: the ids travel in rows of their own.
APART = "+"
NO_IDS = hashlib.sha256(b"").hexdigest()

NAMES = ("kind", "part", "sub", "node", "parent", "depth", "words", "first", "last", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
KINDS = (pa.int8(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 6, pa.string())
SCHEMA = (
    "kind tinyint, part bigint, sub bigint, node binary, parent binary, depth bigint, words bigint, first boolean, last boolean,"
    " conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)


def turn_digest(role: Column, text: Column) -> Column:
    """Hex digest of a turn, half of a SHA-256; null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)


def turn_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def rebuilt(conversations: DataFrame, heads_of: int = 20, most: int = 4) -> DataFrame:
    """``conv_id``, ``path`` (turn digests one after the other) and ``words`` of every rebuilt conversation.

    A conversation c takes its first h turns from conversation c - c % heads_of (all of them if it has fewer, none if there is no
    such conversation) and the rest from its own turns after the h-th, h = crc32(decimal c) % most. Turns go by ``turn`` (null
    first), then role, then digest, so repeated turns stand side by side. Rows without ``conv_id`` belong to no conversation.
    """
    role = F.coalesce("role", F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), turn_digest(F.col("role"), F.col("text")).alias("digest"), turn_words(F.col("text")).alias("words"))
    c = F.col("conv_id").cast("bigint")
    own = conversations.where("conv_id IS NOT NULL").select(c.alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    own = landed(own.select("conv_id", F.transform("own", lambda t: F.struct(t["digest"], t["words"])).alias("own")), "turns")
    heads = own.where(F.col("conv_id") % heads_of == 0).select(F.col("conv_id").alias("_base"), F.slice("own", 1, most - 1).alias("_head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    own = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % heads_of).join(heads, "_base", "left")
    head = F.when(F.col("_head").isNotNull(), F.slice("_head", F.lit(1), h)).otherwise(F.slice("own", 1, 0))
    whole = own.select("conv_id", F.concat(head, F.slice("own", h + 1, F.size("own"))).alias("t"))
    return whole.select("conv_id", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.words").alias("words"))


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.sha256(path[: depth * WIDTH]).digest()[:WIDTH]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high and a[low * WIDTH : (low + 1) * WIDTH] == b[low * WIDTH : (low + 1) * WIDTH]:
        low += 1
    return low


class Item:
    """Conversations with one sequence of turns: how many, the least id, and the ids where they end."""

    __slots__ = ("path", "words", "n", "least", "ids", "size", "apart")

    def __init__(self, path: bytes, words: list[int]):
        self.path, self.words, self.n, self.least, self.ids, self.size, self.apart = path, words, 0, None, [], 0, False


def forest(items: list[Item], shared_left: int, shared_right: int, part: int, sub: int) -> Iterator[tuple]:
    """Rows of the nodes of sorted, distinct sequences; those that a border shares to a depth of ``shared_*`` turns are open."""
    m = len(items)
    above, top = list(range(m)), [len(i.path) // WIDTH for i in items]
    count, least, ends = [i.n for i in items], [i.least for i in items], [_ends(i) for i in items]
    kids, leaves, saved, high = [0] * m, [0] * m, [0] * m, list(range(m))
    waiting: list[list[list]] = [[] for _ in items]
    out: list[list] = []

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    def lift(r: int, to: int) -> None:
        """Puts out the nodes of component ``r`` (named by its first item) deeper than ``to``."""
        path, words = items[r].path, items[r].words
        while top[r] > to:
            d = top[r]
            n, end, here = words[d - 1] if d else 0, ends[r], waiting[r]
            first, last = r == 0 and d <= shared_left, high[r] == m - 1 and d <= shared_right
            if first or last:
                node = _key(path, d)
                for row in here:
                    row[4] = node
                out.append([OPEN, part, sub, node, _key(path, d - 1) if d else None, d, n, first, last, least[r], None, count[r], kids[r], leaves[r], saved[r], end])
                kids[r] = leaves[r] = saved[r] = 0
                waiting[r] = []
            else:
                for row in here:
                    row[10] = least[r]
                leaves[r] = leaves[r] if kids[r] else 1
                saved[r] += (count[r] - 1) * n
                row = [CLOSED, None, None, _key(path, d) if end == APART else None, None, d, None, None, None, least[r], None, count[r], kids[r], leaves[r], saved[r], end]
                out.append(row)
                kids[r], waiting[r] = 1, [row]
            ends[r], top[r] = "", d - 1

    depths = [_common(a.path, b.path) for a, b in zip(items, items[1:])]
    for edge in sorted(range(m - 1), key=depths.__getitem__, reverse=True):
        a, b = find(edge), find(edge + 1)
        lift(a, depths[edge])
        lift(b, depths[edge])
        above[b], high[a] = a, high[b]
        count[a], least[a], ends[a] = count[a] + count[b], min(least[a], least[b]), ends[a] or ends[b]
        kids[a], leaves[a], saved[a] = kids[a] + kids[b], leaves[a] + leaves[b], saved[a] + saved[b]
        more, less = (waiting[a], waiting[b]) if len(waiting[a]) >= len(waiting[b]) else (waiting[b], waiting[a])
        more.extend(less)
        waiting[a] = more
    lift(0, -1)
    return map(tuple, out)


def _ends(item: Item) -> str:
    if item.apart:
        return APART
    return hashlib.sha256(",".join(item.ids).encode()).hexdigest()


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=list(NAMES))


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one sorted range, forest by forest; ids that do not end inside the range go out in rows of their own."""
    part, sub = TaskContext.get().partitionId(), 0
    items: list[Item] = []
    before, turns, at_start, n_ids = None, 0, True, 0
    out: list[tuple] = []

    def ids_row(item: Item) -> tuple:
        nonlocal n_ids
        n_ids += 1
        text, item.ids, item.size, item.apart = ",".join(item.ids), [], 0, True
        return (IDS, part, n_ids, _key(item.path, len(item.path) // WIDTH), *[None] * 11, text)

    def close(right: bytes | None) -> Iterator[tuple]:
        nonlocal at_start, sub
        first, last = items[0], items[-1]
        extra = []
        if at_start and not first.apart:
            extra.append(ids_row(first))
        if right is None and not last.apart:
            extra.append(ids_row(last))
        left = len(first.path) // WIDTH if at_start else _common(before, first.path)
        beyond = len(last.path) // WIDTH if right is None else _common(last.path, right)
        rows = forest(items, left, beyond, part, sub)
        at_start, sub = False, sub + 1
        return chain(extra, rows)

    for batch in batches:
        for conv, path, words in zip(*[c.to_pylist() for c in batch.columns]):
            if not items or path != items[-1].path:
                if items and items[-1].apart and items[-1].ids:
                    out.append(ids_row(items[-1]))
                if turns > FOREST_TURNS:
                    out.extend(close(path))
                    before, items, turns = items[-1].path, [], 0
                items.append(Item(path, words))
                turns += len(words) + 1
            item = items[-1]
            item.n += 1
            item.least = conv if item.least is None else min(item.least, conv)
            item.ids.append(text := str(conv))
            item.size += len(text) + 1
            if item.size > IDS_CHARS:
                out.append(ids_row(item))
        while len(out) >= OUT_ROWS:
            yield _packed(out[:OUT_ROWS])
            out = out[OUT_ROWS:]
    if items:
        if items[-1].apart and items[-1].ids:
            out.append(ids_row(items[-1]))
        out.extend(close(None))
    for i in range(0, len(out), OUT_ROWS):
        yield _packed(out[i : i + OUT_ROWS])


def meet(rows: list[tuple], is_last_round: bool) -> list[tuple]:
    """Open nodes of adjacent forests: equal ones are added up, and those that no border of the group shares are closed."""
    low, high = min(r[2] for r in rows), max(r[2] for r in rows)
    nodes: dict[bytes, list] = {}
    for _, part, sub, node, parent, depth, words, first, last, conv, _, n, kids, leaves, saved, end in rows:
        first, last = first and sub == low, last and sub == high
        if (held := nodes.get(node)) is None:
            nodes[node] = [parent, depth, words, first, last, conv, n, kids, leaves, saved, end]
            continue
        held[3], held[4], held[5] = held[3] or first, held[4] or last, min(held[5], conv)
        held[6], held[7], held[8], held[9] = held[6] + n, held[7] + kids, held[8] + leaves, held[9] + saved
        held[10] = APART if APART in (held[10], end) else held[10] or end
    part, sub, out = rows[0][1], low // MEET, []
    for node, (parent, depth, words, first, last, conv, n, kids, leaves, saved, end) in sorted(nodes.items(), key=lambda x: -x[1][1]):
        if (first or last) and not is_last_round:
            out.append((OPEN, part, sub, node, parent, depth, words, first, last, conv, None, n, kids, leaves, saved, end))
            continue
        leaves, saved = leaves if kids else 1, saved + (n - 1) * words
        out.append((CLOSED, None, None, node, parent, depth, None, None, None, conv, None, n, kids, leaves, saved, end))
        if parent is not None:
            up = nodes[parent]
            up[7], up[8], up[9] = up[7] + 1, up[8] + leaves, up[9] + saved
    return out


def _round(nodes: DataFrame, is_last_round: bool) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*[table.column(n).to_pylist() for n in NAMES]))
        return pa.Table.from_batches([_packed(meet(rows, is_last_round))])

    return nodes.groupBy("part", F.floor(F.col("sub") / MEET)).applyInArrow(run, SCHEMA)


def _hashed_ids(rows: DataFrame) -> DataFrame:
    """Hash of the ids that end in one node, which come sorted and are hashed as they pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], names=["node", "hashed"])
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != now:
                    if state:
                        out.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            if out:
                yield pack()
                out = []
        if state:
            out.append((now, state.hexdigest()))
            yield pack()

    dealt = rows.repartition("node").sortWithinPartitions("node", "part", "sub")
    return dealt.select("node", "ends").mapInArrow(run, "node binary, hashed string")


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row for each distinct prefix, the empty one included, of ``paths`` (``conv_id``, ``path``, ``words``).

    Returns ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256`` (of the ascending ids that end in the node). Conversations with equal turns share all
    nodes; conversations without turns end in the root; without conversations there is no node. A conversation's digests and
    word counts, 20 bytes a turn, travel in one row.
    """
    keys = ["path", "conv_id"]
    ranged = landed(paths.select("conv_id", "path", "words"), "paths").repartitionByRange(*keys).sortWithinPartitions(*keys)
    made = landed(ranged.mapInArrow(_forests, SCHEMA), "forests")
    done, nodes = [], made.where(F.col("kind") == OPEN)
    while True:
        size = nodes.agg(F.max("part").alias("part"), F.max("sub").alias("sub")).first()
        if size["part"] is None:
            return _finished(made.where(F.col("kind") == CLOSED), made.limit(0), made)
        if size["sub"] == 0 and size["part"]:
            nodes = nodes.withColumn("sub", F.col("part")).withColumn("part", F.lit(0).cast("bigint"))
            size = {"part": 0, "sub": size["part"]}
        is_last = size["part"] == 0 and size["sub"] < MEET
        met = landed(_round(nodes, is_last), "meeting")
        done.append(met.where(F.col("kind") == CLOSED))
        if is_last:
            break
        nodes = met.where(F.col("kind") == OPEN)
    spine = done[0]
    for more in done[1:]:
        spine = spine.unionByName(more)
    return _finished(made.where(F.col("kind") == CLOSED), spine, made.where(F.col("kind") == IDS))


def _finished(inner: DataFrame, spine: DataFrame, ids: DataFrame) -> DataFrame:
    """Parents that stood on a border, and hashes of ids that crossed one, joined to the nodes that lack them."""
    hashed = sized(landed(_hashed_ids(ids), "ends")).withColumnRenamed("node", "_ended")
    parents = sized(landed(spine.select(F.col("node").alias("_node"), F.col("conv_id").alias("_conv")), "spine"))
    nodes = inner.unionByName(spine)
    lacks = F.col("parent").isNotNull() | (F.col("ends") == APART)
    mended = nodes.where(lacks).join(parents, F.col("parent") == F.col("_node"), "left")
    mended = mended.join(hashed, F.when(F.col("ends") == APART, F.col("node")) == F.col("_ended"), "left")
    out = nodes.where(~lacks).unionByName(mended, allowMissingColumns=True)
    ends = F.when(F.col("ends") == APART, F.col("hashed")).when(F.col("ends") == "", F.lit(NO_IDS)).otherwise(F.col("ends"))
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends_sha256")
    )
