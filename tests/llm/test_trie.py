"""The trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from fieldbook.llm import prefix_trie
from fieldbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_rebuilt(rows):
    """rows: (conv, turn, role, text) -> {conv: [(role, text)]}."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[: heads[c]] + turns[heads[c] :] for c, turns in own.items()}


def plain_trie(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {k: [] for k in members}
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * len(re.findall("[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        leaves[k] = sum(leaves[c] for c in children[k]) or 1
        saved[k] = own + sum(saved[c] for c in children[k])
    ids = lambda k: ",".join(map(str, sorted(ends.get(k, []))))
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children[k]), leaves[k], saved[k], hashlib.sha256(ids(k).encode()).hexdigest())
        for k, m in members.items()
    )


def collected(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in df.collect())


def trie_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return collected(prefix_trie.prefix_trie(prefix_trie.rebuilt(df)))


def test_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    assert collected(QUERIES["op11_prefix_trie"](spark, SF)) == plain_trie(plain_rebuilt(rows))


def random_rows(seed, n, alphabet, longest):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices("abc", k=rng.randint(0, 5))) for _ in range(alphabet)]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", None]) if alphabet > 2 else "user", rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns,meet,ids,args", [
    (100_000, 64, 60_000, (1, 300, 4, 6)),
    (7, 2, 30, (2, 400, 3, 7)),
    (1, 3, 5, (3, 200, 2, 9)),
    (40, 2, 60_000, (4, 900, 1, 3)),
])
def test_random_conversations(spark, monkeypatch, turns, meet, ids, args):
    """Small forests and groups, so that prefixes, copies and ids cross many borders."""
    for name, value in (("FOREST_TURNS", turns), ("MEET", meet), ("IDS_CHARS", ids)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = random_rows(*args)
    assert trie_of(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_hot_conversation(spark, monkeypatch):
    """One conversation that a third of all are copies of spans several ranges; its ids stay in order."""
    monkeypatch.setattr(prefix_trie, "FOREST_TURNS", 50)
    monkeypatch.setattr(prefix_trie, "IDS_CHARS", 500)
    rows = [(c, t, "user", f"turn {t if c % 3 else t + c}") for c in range(3000) for t in range(5)]
    assert trie_of(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_odd_rows(spark, empty):
    """Null ids, turns, roles and texts, repeated rows, ties, a conversation that loses all its turns, and clashing columns."""
    long = " ".join(["word"] * 50_000)
    gone = next(c for c in range(20, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [
        (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, None), (None, 3, "user", "lost"), (3, 1, None, long),
        (3, 1, "", ""), (gone, 0, "user", "only"), (40, 5, "a", "b"), (40, 5, "a", "c"), (45, 5, "a", "b"), (-5, 0, "user", "x y"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "role AS path", "turn AS words", "text AS own")
    got = collected(prefix_trie.prefix_trie(prefix_trie.rebuilt(df)))
    convs = plain_rebuilt(rows)
    assert [] in convs.values() and got == plain_trie(convs)
    assert collected(prefix_trie.prefix_trie(prefix_trie.rebuilt(df.limit(0)))) == []
