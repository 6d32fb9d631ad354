"""Merkle manifest of a table: one tree for each group of rows, one tree over the groups, and a proof for every row.

The leaves of a tree are numbered in order and cut into aligned blocks of ``fanout ** levels`` leaves. A task hashes a block up
to its own root. Then the blocks exchange roots as in a butterfly network: in round r the blocks whose numbers differ only in
digit r (base ``fanout``) swap the roots of the subtrees that they stand in, so every block hashes every ancestor itself. After
the last round each block holds the siblings on its way to the top, and proofs are finished block by block: nothing is sent down
the tree, and no task sees more than one block or ``fanout`` roots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import landed, sized

#: Leaves of a block, at most: some 130 kB of digests, and below 3 MB with their proofs.
BLOCK_LEAVES = 4096
#: Rows that a task puts out at once.
OUT_ROWS = 2048


def field(value: Column, is_text: bool = True) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value; integers in decimal."""
    text = value if is_text else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields one after the other, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def hexed(digests: Column) -> Column:
    """Digests as the manifest writes and hashes them: lowercase hex."""
    return F.lower(F.hex(digests))


def parent(children: bytes) -> bytes:
    """Digest of a node from its children's, 32 bytes each; what is hashed is their hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


def levels_below(leaves: list[bytes], fanout: int, height: int | None) -> list[list[bytes]]:
    """The nodes of a block level by level, up to one node, or ``height`` levels where the block is a part of a tree."""
    levels = [leaves]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([parent(b"".join(low[i : i + fanout])) for i in range(0, len(low), fanout)])
    return levels


def _block_height(fanout: int) -> int:
    height = 0
    while fanout ** (height + 1) <= BLOCK_LEAVES:
        height += 1
    return height


def _numbered(leaves: DataFrame, tree: str, order: Sequence[Column], size: int) -> DataFrame:
    """Leaves with ``_place`` and ``_block`` in their tree and the ``_total`` of the tree.

    Rows are dealt to ranges and sorted there; the rows of one tree are a run in each range, so a place is the row's number in
    the run after the run's offset. ``_tie`` lets ranges split any number of equal rows.
    """
    keys = [F.col(tree), *order, F.col("_tie")]
    ranged = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = landed(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    runs = ranged.groupBy(tree, F.shiftright("_at", 33).alias("_slice")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(tree)
    runs = runs.withColumn("_before", F.sum("_n").over(whole.orderBy("_slice")) - F.col("_n")).withColumn("_total", F.sum("_n").over(whole))
    runs = sized(landed(runs.drop("_n"), "merkle-runs"))
    placed = ranged.withColumn("_slice", F.shiftright("_at", 33)).join(runs, [tree, "_slice"])
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.withColumn("_place", place).withColumn("_block", F.floor(place / size)).drop("_at", "_slice", "_first", "_before", "_tie")


def _block_roots(leaves: DataFrame, tree: str, digest: str, fanout: int, height: int) -> DataFrame:
    """``_root`` of every block: blocks come sorted to a task, which holds one at a time."""
    size = fanout**height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def root() -> tuple:
            last = (now[2] - 1) // size
            return now[0], now[1], last, levels_below(held, fanout, height if last else None)[-1][0]

        for batch in batches:
            for *key, leaf in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now:
                    if held:
                        out.append(root())
                    now, held = key, []
                held.append(leaf)
            if len(out) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out = []
        if held:
            out.append(root())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    names, kinds = ["_tree", "_block", "_last", "_root"], [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    dealt = leaves.repartition(tree, "_block").sortWithinPartitions(tree, "_block", "_place")
    return dealt.select(tree, "_block", "_total", digest).mapInArrow(run, "_tree binary, _block bigint, _last bigint, _root binary")


def _butterfly(blocks: DataFrame, fanout: int) -> DataFrame:
    """Adds ``_left`` and ``_right`` (siblings on either side, level by level); ``_root`` becomes the root of the tree.

    In round r a block speaks for the subtree of ``fanout ** r`` blocks in which it stands. It meets the blocks that hold its
    own offset in the sibling subtrees. The last subtree of a tree may lack that offset; its blocks then serve the missing ones
    in turn. A meeting has ``fanout`` members at most, and trees that are complete leave.
    """
    none = F.array().cast("array<binary>")
    state = landed(blocks.withColumn("_left", none).withColumn("_right", none), "merkle-blocks")
    done, step = [], 1
    while True:
        done.append(state.where(F.col("_last") < step))
        state = state.where(F.col("_last") >= step)
        if not state.limit(1).count():
            return _all_of(done)
        subtree, offset = F.floor(F.col("_block") / step), F.pmod("_block", F.lit(step))
        held = F.pmod("_last", F.lit(step)) + 1  # blocks of the last subtree
        serves = (subtree == F.floor(F.col("_last") / step)) & (F.pmod(subtree, F.lit(fanout)) > 0) & (offset + held < step)
        others = F.when(serves, F.sequence(offset + held, F.lit(step - 1), held)).otherwise(F.array().cast("array<bigint>"))
        sent = state.withColumn("_digit", F.pmod(subtree, F.lit(fanout))).withColumn("_group", F.floor(subtree / fanout))
        sent = sent.withColumn("_offset", F.explode(F.concat(F.array(offset), others)))
        own = F.col("_offset") == F.pmod("_block", F.lit(step))
        member = F.struct("_digit", "_root", F.when(own, F.col("_block")).alias("_block"), "_last", *[F.when(own, F.col(c)).alias(c) for c in ("_left", "_right")])
        met = sent.groupBy("_tree", "_group", "_offset").agg(F.sort_array(F.collect_list(member)).alias("_met"))
        spread = met.select("_tree", "_met", F.explode("_met").alias("_me")).where("_me._block IS NOT NULL")
        beside = lambda keep: _joined(F.transform(F.filter("_met", keep), lambda m: m["_root"]))
        state = spread.select(
            "_tree",
            "_me._block",
            "_me._last",
            F.unhex(F.sha2(hexed(_joined(F.col("_met._root"))).cast("binary"), 256)).alias("_root"),
            F.concat("_me._left", F.array(beside(lambda m: m["_digit"] < F.col("_me._digit")))).alias("_left"),
            F.concat("_me._right", F.array(beside(lambda m: m["_digit"] > F.col("_me._digit")))).alias("_right"),
        )
        state = landed(state, "merkle-round")
        step *= fanout


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def _all_of(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _proofs(leaves: DataFrame, headers: DataFrame, tree: str, keep: Sequence[str], fanout: int, height: int) -> DataFrame:
    """Every leaf with its subroot, root, proof and the root that its claimed digest folds to.

    A block's header, with the siblings above it, travels to the task of its leaves and comes before them.
    """
    size, kept = fanout**height, [f"_keep{i}" for i in range(len(keep))]
    types = dict(leaves.dtypes)
    rows = leaves.select(tree, "_block", "_place", "_total", "_leaf", "_claimed", *[F.col(k).alias(a) for k, a in zip(keep, kept)])
    rows = rows.unionByName(headers.withColumn("_place", F.lit(-1).cast("bigint")), allowMissingColumns=True)
    rows = rows.repartition(tree, "_block").sortWithinPartitions(tree, "_block", "_place")
    rows = rows.select("_place", "_total", "_left", "_right", "_subroot", "_root", "_leaf", "_claimed", *kept)
    schema = ", ".join([*[f"{a} {types[k]}" for k, a in zip(keep, kept)], "_leaf binary, _subroot binary, _root binary, _proof binary, _folded binary"])
    n_fixed = 6

    def finished(head: tuple, held: list[tuple]) -> list[tuple]:
        _, _, lefts, rights, subroot, root = head[:n_fixed]
        levels = levels_below([r[n_fixed] for r in held], fanout, height if held[0][1] > size else None)
        above = b"".join(a + b for a, b in zip(lefts, rights))
        proofs = [above]  # of the nodes of one level, from the top down
        for low in reversed(levels[:-1]):
            runs = [low[i : i + fanout] for i in range(0, len(low), fanout)]
            proofs = [b"".join(run[:d] + run[d + 1 :]) + proofs[i] for i, run in enumerate(runs) for d in range(len(run))]
        tops: dict[bytes, bytes] = {}
        out = []
        for at, row in enumerate(held):
            digest, i = row[n_fixed + 1], at
            for low in levels[:-1]:
                first = i - i % fanout
                digest = parent(b"".join((*low[first:i], digest, *low[i + 1 : first + fanout])))
                i //= fanout
            if digest not in tops:
                top = digest
                for a, b in zip(lefts, rights):
                    top = parent(a + top + b)
                tops[digest] = top
            out.append((*row[n_fixed + 2 :], row[n_fixed], subroot, root, proofs[at], tops[digest]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held, out, kinds = None, [], [], None
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            kinds = [*[f.type for f in batch.schema][n_fixed + 2 :], *[pa.binary()] * 5]
            names = [*kept, "_leaf", "_subroot", "_root", "_proof", "_folded"]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] >= 0:
                    held.append(row)
                    continue
                if held:
                    out += finished(head, held)
                head, held = row, []
                while len(out) >= OUT_ROWS:
                    yield pack(out[:OUT_ROWS])
                    out = out[OUT_ROWS:]
        if held:
            out += finished(head, held)
        for i in range(0, len(out), OUT_ROWS):
            yield pack(out[i : i + OUT_ROWS])

    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(kept, keep)))


def _forest(leaves: DataFrame, tree: str, order: Sequence[Column], fanout: int) -> tuple[DataFrame, DataFrame]:
    """Numbered leaves, and the blocks of all trees after the exchange. ``leaves`` has ``_leaf``."""
    height = _block_height(fanout)
    placed = _numbered(leaves, tree, order, fanout**height)
    return placed, _butterfly(_block_roots(placed, tree, "_leaf", fanout, height), fanout)


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str, claimed: str, keep: Sequence[str], fanout: int = 2) -> DataFrame:
    """Proofs of all rows in the trees of their groups and in the tree over the groups.

    ``leaf`` and ``claimed`` are digests of 32 bytes: what the manifest holds and what is to be verified against it. Rows of a
    group ascend by ``order`` (null first), then by ``leaf``; groups ascend by ``group`` (null first, bytewise). Returns
    ``keep``, ``leaf``, ``subroot``, ``root``, ``proof`` (siblings from the leaf up, 32 bytes each) and ``folded_root``, to
    which ``claimed`` leads beside the same siblings. Repeated rows are leaves of their own, beside each other; an empty table
    gives no rows and has no root. Null groups and ids are a group and ids like any other.
    """
    tree = digest_of([field(F.col(group))])
    inner = [f"_o{i}" for i in range(len(order))]
    base = rows.select(
        tree.alias("_tree"), F.col(group).alias("_group"), *[F.col(o).alias(a) for o, a in zip(order, inner)], F.col(leaf).alias("_leaf"),
        F.col(claimed).alias("_claimed"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keep)], F.monotonically_increasing_id().alias("_tie"),
    )
    base, height = landed(base, "merkle-leaves"), _block_height(fanout)
    names = base.select("_tree", "_group").groupBy("_tree").agg(F.min("_group").alias("_group"))
    placed, blocks = _forest(base.drop("_group"), "_tree", [*[F.col(a).asc_nulls_first() for a in inner], F.col("_leaf")], fanout)

    subroots = blocks.where("_block = 0").select("_tree", F.col("_root").alias("_leaf")).join(names, "_tree")
    over = subroots.select(F.lit(b"").alias("_all"), "_tree", "_group", "_leaf", F.col("_leaf").alias("_claimed"), F.lit(0).cast("bigint").alias("_tie"))
    over, tops = _forest(landed(over, "merkle-subroots"), "_all", [F.col("_group").asc_nulls_first()], fanout)
    tops = tops.select(F.col("_tree").alias("_all"), "_block", "_left", "_right", F.lit(b"").alias("_subroot"), "_root")
    ways = _ways(over, tops, fanout, height)

    headers = blocks.select("_tree", "_block", "_left", "_right", F.col("_root").alias("_subroot")).join(sized(landed(ways, "merkle-ways")), "_tree")
    headers = headers.select("_tree", "_block", F.concat("_left", "_up_left").alias("_left"), F.concat("_right", "_up_right").alias("_right"), "_subroot", "_root")
    out = _proofs(placed, headers, "_tree", [f"_k{i}" for i in range(len(keep))], fanout, height)
    return out.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)],
        *[F.col(f"_{c}").alias(c) for c in ("leaf", "subroot", "root", "proof")],
        F.col("_folded").alias("folded_root"),
    )


def _ways(over: DataFrame, tops: DataFrame, fanout: int, height: int) -> DataFrame:
    """For each group's tree the siblings of its subroot on the way to the root, by level, on the left and on the right.

    Inside a block of subroots the siblings come from the proof, which is in level order; a level's left siblings number the
    digit of the place at that level.
    """
    rows = _proofs(over, tops, "_all", ["_tree", "_place", "_total"], fanout, height)
    left, right, at = [], [], F.lit(0)
    n_levels = 0
    most = over.agg(F.max("_total")).first()[0] or 0
    while fanout**n_levels < most:
        width = F.ceil(F.col("_total") / fanout**n_levels)
        node = F.floor(F.col("_place") / fanout**n_levels)
        first = F.floor(node / fanout) * fanout
        before, after = (node - first).cast("int"), (F.least(first + fanout, width) - node - 1).cast("int")
        left.append(F.substring("_proof", at * 32 + 1, before * 32))
        right.append(F.substring("_proof", (at + before) * 32 + 1, after * 32))
        at, n_levels = at + before + after, n_levels + 1
    none = F.array().cast("array<binary>")
    return rows.select("_tree", "_root", (F.array(*left) if left else none).alias("_up_left"), (F.array(*right) if right else none).alias("_up_right"))
