"""Quality by positive-unlabelled learning: trusted good texts, unlabelled texts, and a non-negative unbiased risk.

The features of a text are shares of its characters and of pairs of neighbouring characters by kind, and how often words repeat.
They are counted over the whole text. The model is a small network fitted with numpy where the job starts, on a bounded sample
of feature rows; scoring applies it to every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import map_batches, share_drawn
from fieldbook.llm.words import blocks, word_hashes, word_spans

#: Rows of features that are fitted on, at most about so many of each sort, whatever the size of the tables.
POSITIVES, UNLABELLED = 15_000, 30_000
HIDDEN, EPOCHS, BATCHES, RATE, SEED = 16, 60, 24, 0.02, 7

#: Kinds of bytes: each group is one; the rest are lower-case letters, bytes above 127, and everything else.
GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".", b",", b"!?", b"%", b"*", b"$", b"#", b"&", b"|", b"<>{}[]()=/\\@_^~`+", b"'\"-:;"]
KINDS = len(GROUPS) + 3
KIND = np.full(256, KINDS - 1)
KIND[97:123], KIND[128:] = KINDS - 2, KINDS - 3
for _n, _group in enumerate(GROUPS):
    KIND[list(_group)] = _n
WIDTH = KINDS + KINDS * KINDS + 7  # the last is the weight of the text's evidence: from 0 to 1 with its length
HALF_WEIGHT = 64


def features(column: pa.Array) -> np.ndarray:
    """One row for each text; an empty or null text has zeros only."""
    out = np.zeros((len(column), WIDTH), np.float32)
    for first, data, offsets in blocks(column):
        n, sizes = len(offsets) - 1, np.diff(offsets)
        if not len(data):
            continue
        owner = np.repeat(np.arange(n), sizes)
        kind = KIND[data]
        single = np.bincount(owner * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS)
        both = owner[:-1] == owner[1:]
        pair = np.bincount((owner[:-1] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:])[both], minlength=n * KINDS * KINDS).reshape(n, KINDS * KINDS)
        starts, of = word_spans(data, offsets)
        hashes = word_hashes(data, starts)
        count = np.bincount(of, minlength=n)
        same = np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=n)
        order = np.lexsort((hashes, of))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
        distinct = np.bincount(of[order][new], minlength=n)
        length, words = np.maximum(sizes, 1)[:, None], np.maximum(count, 1)
        out[first : first + n] = np.hstack([
            np.sqrt(single / length), np.sqrt(pair / length),
            np.stack([same / words, distinct / words, np.sqrt(distinct) / np.sqrt(words), sizes / words / 20, np.log1p(count) / 10, np.log1p(single[:, 3]) / 10, sizes / (sizes + HALF_WEIGHT)], 1),
        ])
        out[first : first + n][sizes == 0] = 0
    return out


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(standard(x, self.centre, self.scale) @ a + b) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Distances from the centre in single precision, drawn in for short texts, of which little is known."""
    z = np.subtract(x, centre.astype(np.float32), dtype=np.float32)
    z /= scale.astype(np.float32)
    np.clip(z, -6, 6, out=z)
    z *= x[:, -1:]
    z[:, -1] = 0
    return z


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def descend(weights: list[np.ndarray], gradient, batches: int, rate: float = RATE) -> None:
    """Adam, in place; ``gradient(step)`` returns one array for each weight."""
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, batches + 1):
        for w, g, m, v in zip(weights, gradient(step), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of the two shares above any threshold of a score.

    Above every threshold the unlabelled hold at least the prior's share of what the positives hold; where the score tells
    negatives apart the bound is tight. A margin of sampling error keeps thin tails from setting it.
    """
    levels = np.quantile(positive, np.linspace(0.002, 0.6, 120))
    p = np.array([(positive >= t).mean() for t in levels])
    u = np.array([(unlabelled >= t).mean() for t in levels])
    slack = np.sqrt(np.log(100) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    return float(np.clip(np.min((u + slack * (1 - p) + 0.2 * slack) / p), 0.05, 0.98))


def moments(x: np.ndarray, rows: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of every column, summed over a few rows at a time."""
    total, squares = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for at in range(0, len(x), rows):
        part = x[at : at + rows].astype(np.float64)
        total += part.sum(0)
        squares += (part * part).sum(0)
    mean = total / len(x)
    return mean, np.sqrt(np.maximum(squares / len(x) - mean * mean, 0)) + 0.01


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED) -> Model:
    """A network with one hidden layer under the non-negative risk.

    The risk is prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)) with the sigmoid loss; a batch whose
    second part is below zero steps against it. The prior is estimated from a logistic fit of positives against unlabelled.
    Without positives or unlabelled rows every score is 0.5.
    """
    if not len(positive) or not len(unlabelled):
        width = positive.shape[1] if positive.ndim == 2 and positive.shape[1] else WIDTH
        return Model(np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.zeros(1)], 0.5)
    rng = np.random.default_rng(seed)
    centre, scale = moments(unlabelled)
    p, u = standard(positive, centre, scale), standard(unlabelled, centre, scale)

    line = [np.zeros(p.shape[1]), np.zeros(1)]

    def apart(_):
        out = [1e-3 * line[0], np.zeros(1)]
        for x, label in ((p, 1.0), (u, 0.0)):
            x = x[rng.integers(0, len(x), 2000)].astype(np.float64)
            error = (sigmoid(x @ line[0] + line[1]) - label) / len(x)
            out[0] += x.T @ error
            out[1] += error.sum()
        return out

    descend(line, apart, 400)
    prior = class_prior(*(x @ line[0].astype(np.float32) for x in (p, u)))

    weights = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]

    def back(x, slope):  # slope: of the risk by each row's margin
        a, b, c, d = weights
        hidden = np.tanh(x @ a + b)
        inner = np.outer(slope, c) * (1 - hidden * hidden)
        return [x.T @ inner, inner.sum(0), hidden.T @ slope, np.array([slope.sum()])]

    def margin(x):
        return np.tanh(x @ weights[0] + weights[1]) @ weights[2] + weights[3]

    size_p, size_u = max(1, min(512, len(p))), max(1, min(1024, len(u)))

    def risk(_):
        xp, xu = (x[rng.integers(0, len(x), n)].astype(np.float64) for x, n in ((p, size_p), (u, size_u)))
        sp, su = sigmoid(margin(xp)), sigmoid(margin(xu))
        gp, gu = sp * (1 - sp) / len(xp), su * (1 - su) / len(xu)
        negative = su.mean() - prior * sp.mean()  # sigmoid loss of calling a row negative is its score
        if negative >= 0:
            parts = back(xp, -2 * prior * gp), back(xu, gu)
        else:
            parts = back(xp, prior * gp), back(xu, -gu)
        return [x + y + 1e-4 * w for x, y, w in zip(*parts, weights, strict=True)]

    descend(weights, risk, EPOCHS * BATCHES)
    return Model(centre, scale, weights, prior)


def sample_features(df: DataFrame, labels: DataFrame, positive: Column, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of about POSITIVES trusted and UNLABELLED other rows, drawn by a hash of the id.

    ``positive`` says which rows of ``labels`` are trusted. Only the ids drawn are broadcast, so their number is bounded. Rows
    come in the order of their hashes, so the fit does not depend on how the files are laid out. It is an error if rows are
    there but none is drawn.
    """
    trusted, rows = labels.where(positive).select(id_col).distinct(), df.select(id_col, text_col)
    drawn = trusted.where(share_drawn(F.xxhash64(id_col, F.lit(1)), POSITIVES, trusted.count())).withColumn("_sort", F.lit(1))
    hashed, total = F.xxhash64(id_col, text_col, F.lit(2)), df.count()
    chosen = rows.join(F.broadcast(drawn), id_col).select(text_col, "_sort", hashed.alias("_hash")).unionByName(
        rows.where(share_drawn(hashed, UNLABELLED, total)).select(text_col, F.lit(0).alias("_sort"), hashed.alias("_hash"))
    )

    def run(batch: pa.RecordBatch) -> dict:
        x = features(batch.column(0))
        return {"_sort": batch.column(1), "_hash": batch.column(2), "x": pa.array([r.tobytes() for r in x], pa.binary())}

    ordered = map_batches(chosen, "_sort int, _hash bigint, x binary", run).orderBy(F.desc("_sort"), "_hash", "x")
    got = ordered.select("_sort", "x").toArrow()
    n = int(pc.sum(got.column("_sort")).as_py() or 0)  # the trusted rows come first
    parts = [_matrix(got.column("x").slice(0, n)), _matrix(got.column("x").slice(n))]
    if total and not len(parts[1]):
        raise RuntimeError("no unlabelled row was drawn")
    return parts[0], parts[1]


def _matrix(rows: pa.ChunkedArray) -> np.ndarray:
    """Rows of WIDTH numbers; chunk by chunk, so that no second copy of all is held."""
    out, at = np.zeros((len(rows), WIDTH), np.float32), 0
    for chunk in rows.chunks:
        for x in chunk:
            out[at] = np.frombuffer(x.as_buffer(), np.float32)
            at += 1
    return out


def train(df: DataFrame, labels: DataFrame, positive: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on trusted rows of ``labels`` (where ``positive`` holds) and on unlabelled rows of ``df``."""
    return fit(*sample_features(df, labels, positive, id_col, text_col))


def score(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``score``, from 0 to 1, of every whole text.

    Null and empty texts have features of zero and get the score the model gives to those. Repeated rows and null ids stay.
    """
    shipped = df.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    kinds = dict(df.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        values = shipped.value.score(features(batch.column(0)))
        return {**{name: batch.column(i) for i, name in enumerate(keep, 1)}, "score": values.astype(float)}

    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in keep), "score double"])
    return map_batches(df.select(F.col(text_col).alias("_text"), *keep), schema, run)
