"""Packed pieces against the tokenizer library: every id once, binary lengths, dense sequence numbers."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fieldbook.llm import packing
from fieldbook.llm.queries import QUERIES, byte_bpe_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_bpe_path())


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID], dtype="<u4")


def check_sequences(rows, context=packing.CONTEXT):
    """Numbers are dense, each sequence is one piece, and longer buckets come first."""
    rows = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in rows] == list(range(len(rows)))
    lengths = [r["length"] for r in rows]
    assert lengths == sorted(lengths, reverse=True)
    assert all(n & (n - 1) == 0 and n <= context for n in lengths)


@pytest.mark.parametrize("n", [1, 2, 3, 15, 2047, 2048, 2049, 10_000])
def test_binary_lengths(n):
    got = packing.binary_lengths(n)
    assert sum(got) == n and got == sorted(got, reverse=True)
    assert all(got.count(x) == 1 for x in got if x < packing.CONTEXT)


def test_query(spark, library, documents):
    rows = QUERIES["op12_binary_packing"](spark, SF).collect()
    check_sequences(rows)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == {i for i, _ in documents}
    for i, text in documents:
        ids, place = ids_of(library, text), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["offset"], r["doc_tokens"]) == (place, 0, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[place : place + r["length"]].tobytes())
            place += r["length"]
        assert place == len(ids)


def test_texts_that_the_pattern_cannot_take(library):
    """Special tokens inside a text, long runs of white space, other scripts."""
    with open(byte_bpe_path(), encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    texts = ["<|endoftext|>a<|endoftext|>", "x" + " " * 1_500_000 + "y", "\n\t" * 100_000, "żółć 漢字 \x1c's 't", "", "ab   c"]
    for text in texts:
        assert np.append(encoder.encode(text), np.uint32(packing.END_ID)).tolist() == ids_of(library, text).tolist()
    assert encoder.slow


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        packing.Encoder('{"normalizer": {"type": "NFC"}, "pre_tokenizer": null, "post_processor": null}')


def test_odd_rows(spark, library, odd, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "OUT_IDS", 50)
    packed = packing.pack(odd, byte_bpe_path(), context=64)
    rows = packed.collect()
    check_sequences(rows, 64)
    got, whole = {}, {}
    for r in rows:
        got[(str(r["doc_id"]), r["doc_tokens"])] = got.get((str(r["doc_id"]), r["doc_tokens"]), 0) + r["length"]
    for r in odd.collect():
        n = len(ids_of(library, r["text"]))
        whole[(str(r["doc_id"]), n)] = whole.get((str(r["doc_id"]), n), 0) + n
    assert got == whole
    assert [r["length"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert packing.pack(empty, byte_bpe_path()).collect() == []
    packing.write_buckets(packed, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert back.where("octet_length(token_ids) <> 4 * length").count() == 0 and back.count() == len(rows)
    with pytest.raises(ValueError):
        packing.pack(odd, byte_bpe_path(), context=1000)
