"""Packing by power-of-two decomposition: every document is cut into pieces of binary length, and equal lengths share a bucket.

A document of n ids gives n // context pieces of the context's length and one piece for each bit that is set in what is left, so
a sequence is one piece, never crosses documents and needs no padding. Documents are cut where they are tokenised; sequences
are numbered from the counts of each bucket in each task, so neither texts nor ids are shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm import bpe
from fieldbook.llm.common import landed, sized

#: Ids of a full sequence, the id that ends a document, and the ids that a task puts out at once.
CONTEXT, END_ID, OUT_IDS = 2048, 1, 4_000_000

# What the tokenizer file must say of its steps, and the split pattern of that kind of file.
STEPS = {
    "normalizer": None,
    "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    "post_processor": None,
}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of texts as the tokenizer file gives them, by a library that merges by rank."""

    def __init__(self, content: str):
        spec = json.loads(content)
        if any(spec[name] != value for name, value in STEPS.items()):
            raise ValueError("the tokenizer file is not a plain byte-level one")
        to_byte = {s: bytes([b]) for b, s in enumerate(bpe.byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {s: i for s, i in spec["model"]["vocab"].items() if s not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("ids of the tokenizer file do not follow its merges")
        ranks = {b"".join(map(to_byte.__getitem__, s)): i for s, i in vocab.items()}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.content, self.slow = content, None

    def encode(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids. Runs of white space too long for the library's pattern go through the merge queue of ``bpe``."""
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            self.slow = self.slow or bpe.Vocabulary(self.content)
            return np.frombuffer(self.slow.encode(text), dtype="<u4")


@lru_cache(maxsize=1)
def _encoder(content: str) -> Encoder:
    return Encoder(content)


def binary_lengths(n: int, context: int = CONTEXT) -> list[int]:
    """Lengths of the pieces of n ids, descending; ``context`` is a power of two."""
    rest = n % context
    return [context] * (n // context) + [1 << b for b in reversed(range(context.bit_length() - 1)) if rest >> b & 1]


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT, end_id: int = END_ID) -> DataFrame:
    """Sequences of at most ``context`` ids, each a piece of one document.

    Returns id_col, ``start`` (ids of the document before the piece), ``length``, ``token_ids`` (binary, little-endian unsigned
    32-bit), ``doc_tokens`` (ids of the document with the closing ``end_id``) and ``sequence_id``, from 0 without a gap, longer
    sequences first. A null text counts as empty: its document is the closing id alone. Repeated rows and null ids are documents
    of their own; other columns are not carried; an empty table gives no rows. Which of the equally long sequences comes first
    depends on the layout of the files alone.
    """
    if context & (context - 1) or context < 1:
        raise ValueError("the context must be a power of two")
    with open(path, encoding="utf-8") as file:
        shipped = df.sparkSession.sparkContext.broadcast(file.read())
    kind = dict(df.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, start bigint, length int, token_ids binary, doc_tokens bigint, _slice int, _nth bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(shipped.value), TaskContext.get().partitionId()
        nth = dict.fromkeys((1 << b for b in range(context.bit_length())), 0)
        for batch in batches:
            rows, n_ids, ids_of = [], 0, batch.column(0)
            put = lambda: pa.RecordBatch.from_arrays(
                [ids_of.take(pa.array([r[0] for r in rows], pa.int64())), *[pa.array(c, t) for c, t in zip([*zip(*rows)][1:], kinds)]], names=names
            )
            for at, text in enumerate(batch.column(1)):
                ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                start, total = 0, len(ids)
                for length in binary_lengths(total, context):
                    rows.append((at, start, length, ids[start : start + length].tobytes(), total, part, nth[length]))
                    start, nth[length] = start + length, nth[length] + 1
                n_ids += total
                if n_ids >= OUT_IDS:
                    yield put()
                    rows, n_ids = [], 0
            if rows:
                yield put()

    names = [id_col, "start", "length", "token_ids", "doc_tokens", "_slice", "_nth"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
    pieces = landed(df.select(id_col, text_col).mapInArrow(run, schema), "pieces")
    return _numbered(pieces).select(id_col, "start", F.col("length").cast("bigint").alias("length"), "token_ids", "doc_tokens", "sequence_id")


def _numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``sequence_id``: buckets by descending length, in a bucket the tasks in turn, in a task the order of writing."""
    counts = landed(pieces.groupBy("length", "_slice").agg(F.count("*").alias("_n")), "piece-counts")
    buckets = counts.groupBy("length").agg(F.sum("_n").alias("_all"))  # a row for each power of two up to the context
    longer = buckets.select("length", (F.sum("_all").over(Window.orderBy(F.desc("length"))) - F.col("_all")).alias("_base"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_slice")) - F.col("_n")
    firsts = counts.withColumn("_before", before).join(F.broadcast(longer), "length").select("length", "_slice", (F.col("_base") + F.col("_before")).alias("_first"))
    firsts = sized(landed(firsts, "piece-firsts"))
    return pieces.join(firsts, ["length", "_slice"]).withColumn("sequence_id", F.col("_first") + F.col("_nth"))


def write_buckets(packed: DataFrame, folder: str) -> None:
    """Sequences as files, one folder for each length, so that a loader draws batches of equal length."""
    packed.write.partitionBy("length").mode("errorifexists").parquet(folder)
