"""Benchmark items in training text: every passage is a query to a BM25 index of the items, searched with block-max WAND.

The index holds the items, not the corpus, and is shipped to the tasks in blocks of a bounded number of items, all of them with
the document frequencies and mean length of all items. For all passages
of a batch at once, the best impacts of their words in each block of postings are added up; only passages that could reach
some item's threshold are searched. What the search returns is verified on question and answer against the document's words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import map_batches
from fieldbook.llm.string_kernel import core_spans, span_hashes
from fieldbook.llm.words import blocks, shingles

K1, B = 1.2, 0.75
#: Words of a passage, and from one passage to the next: a stretch of PASSAGE - STEP words lies whole in some passage.
PASSAGE, STEP = 96, 48
#: Share of an item's own score that a passage must reach; an item longer than PASSAGE - STEP words can reach less.
LEAST_SCORE = 0.5
#: Words of the runs that are verified, and the share of the runs of question and of answer that a document must hold.
RUN, LEAST_OVERLAP = 5, 0.6
#: Items in one index, indexes that a scan of the texts searches, and items in one block of postings: small blocks bound a passage's
#: scores tightly.
ITEMS, INDEXES, BLOCK = 500, 8, 2

SENTENCE = re.compile(r"(?<=[.!?])\s+")


def question_and_answer(text: str) -> tuple[str, str]:
    """What stands up to the last question mark and after it; else all sentences but the last, and the last."""
    if 0 <= (at := text.rfind("?")) < len(text.rstrip()) - 1:
        return text[: at + 1], text[at + 1 :]
    parts = SENTENCE.split(text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def text_words(column: pa.Array):
    """Number of the first text, word hashes, and which text each word is in, for runs of texts; punctuation around words is left out."""
    for at, data, offsets in blocks(column):
        first, end, owner = core_spans(data, offsets)
        yield at, len(offsets) - 1, span_hashes(data, first, end), owner


def words_of(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, n, hashes, owner in text_words(pa.array(texts, pa.string())):
        cuts = np.searchsorted(owner, np.arange(n + 1))
        out += [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


@dataclass
class Statistics:
    """What weighs a term: number of items, their mean length in words, and in how many items each term stands."""

    n: int
    mean: float
    terms: np.ndarray
    df: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Statistics:
        words = words_of(texts)
        sizes = np.array([len(w) for w in words])
        terms, df = np.unique(np.concatenate([*(np.unique(w) for w in words), np.zeros(0, np.uint64)]), return_counts=True)
        return cls(len(texts), max(1.0, sizes[sizes > 0].mean() if (sizes > 0).any() else 1.0), terms, df)

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = self.df[np.searchsorted(self.terms, terms)] if len(terms) else np.zeros(0)
        return np.log(1 + (self.n - df + 0.5) / (df + 0.5))


@dataclass
class Index:
    """Postings by term: items ascending, impacts as shares of the item's threshold, and the best impact of each block."""

    ids: list
    terms: np.ndarray
    items: list[list[int]]
    impacts: list[list[float]]
    block_best: np.ndarray
    questions: list[tuple[int, np.ndarray]]
    answers: list[tuple[int, np.ndarray]]

    @classmethod
    def build(cls, rows: list[tuple], least_score: float = LEAST_SCORE, statistics: Statistics | None = None) -> Index:
        """An index of (id, text), weighed by ``statistics`` of these and perhaps more items; a text without words is in no postings."""
        texts = [t or "" for _, t in rows]
        words, statistics = words_of(texts), statistics or Statistics.of(texts)
        sizes, mean = np.array([len(w) for w in words]), statistics.mean
        term = np.concatenate([*(np.unique(w) for w in words), np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(words)), [len(np.unique(w)) for w in words])
        often = np.concatenate([*(np.unique(w, return_counts=True)[1] for w in words), np.zeros(0, np.int64)])
        terms, at = np.unique(term, return_inverse=True)
        idf = statistics.idf(terms)
        weight = idf[at] * often * (K1 + 1) / (often + K1 * (1 - B + B * sizes[item] / mean)) if len(item) else often.astype(float)
        full = np.bincount(item, weights=weight, minlength=len(rows))
        reach = np.minimum(1, (PASSAGE - STEP) / np.maximum(sizes, 1))
        share = weight / (least_score * reach * np.maximum(full, 1e-9))[item] if len(item) else weight
        order = np.lexsort((item, at))
        at, item, share = at[order], item[order], share[order]
        best = np.zeros((len(terms), max(1, -(-len(rows) // BLOCK))), np.float32)
        np.maximum.at(best, (at, item // BLOCK), share.astype(np.float32))
        cuts = np.searchsorted(at, np.arange(len(terms) + 1))
        parts = [question_and_answer(t) for t in texts]
        runs = lambda some: [(min(RUN, len(w)), np.unique(shingles(w, RUN))) for w in words_of(some)]
        return cls(
            [i for i, _ in rows], terms, [item[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
            [share[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], best, runs([p[0] for p in parts]), runs([p[1] for p in parts]),
        )

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items whose score reaches their threshold, by block-max WAND over the postings of distinct terms."""
        cursors = [[0, t] for t in terms]
        most = {t: float(self.block_best[t].max()) for t in terms}
        found = []
        while True:
            cursors = [c for c in cursors if c[0] < len(self.items[c[1]])]
            cursors.sort(key=lambda c: self.items[c[1]][c[0]])
            bound, pivot = 0.0, None
            for n, (at, t) in enumerate(cursors):
                bound += most[t]
                if bound >= 1 - 1e-6:
                    pivot = n
                    break
            if pivot is None:
                return found
            item = self.items[cursors[pivot][1]][cursors[pivot][0]]
            while pivot + 1 < len(cursors) and self.items[cursors[pivot + 1][1]][cursors[pivot + 1][0]] == item:
                pivot += 1
            block = item // BLOCK
            if sum(float(self.block_best[t, block]) for _, t in cursors[: pivot + 1]) < 1 - 1e-6:
                # no item up to the end of the block, nor before the next cursor, can reach its threshold
                following = self.items[cursors[pivot + 1][1]][cursors[pivot + 1][0]] if pivot + 1 < len(cursors) else 1 << 60
                to = min((block + 1) * BLOCK, max(following, item + 1))
                for c in cursors[: pivot + 1]:
                    c[0] = bisect_left(self.items[c[1]], to, c[0])
                continue
            score = 0.0
            for c in cursors[: pivot + 1]:
                c[0] = bisect_left(self.items[c[1]], item, c[0])
                if c[0] < len(self.items[c[1]]) and self.items[c[1]][c[0]] == item:
                    score += self.impacts[c[1]][c[0]]
                    c[0] += 1
            if score >= 1 - 1e-6:
                found.append((item, score))

    def candidates(self, hashes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, float]]:
        """(text, item, best score) for all texts of a run of words."""
        at = np.minimum(np.searchsorted(self.terms, hashes), max(0, len(self.terms) - 1))
        known = self.terms[at] == hashes if len(self.terms) else np.zeros(len(hashes), bool)
        if not known.any():
            return []
        heads = np.searchsorted(owner, owner)  # of each word's text
        number = (np.arange(len(owner)) - heads) // STEP
        base = heads // STEP + owner  # passages of a text are numbered on from here
        text_of = np.zeros(int(base[-1] + number[-1]) + 1, np.int64)
        text_of[base + number] = owner
        where, term = np.flatnonzero(known), at[known]
        later = number[where] > 0  # a word is in the passage of its step and, but for the first step, in the one before
        passage = np.concatenate([(base + number)[where], (base + number)[where][later] - 1])
        both = np.unique(passage * len(self.terms) + np.concatenate([term, term[later]]))
        passage, term = np.divmod(both, len(self.terms))
        first = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        best = np.zeros(len(first), np.float32)
        for block in range(self.block_best.shape[1]):
            np.maximum(best, np.add.reduceat(self.block_best[term, block], first), out=best)
        ends, out = np.append(first[1:], len(term)), {}
        for i in np.flatnonzero(best >= 1 - 1e-4):
            for item, score in self.search(term[first[i] : ends[i]].tolist()):
                key = int(text_of[passage[first[i]]]), item
                out[key] = max(score, out.get(key, 0.0))
        return [(text, item, score) for (text, item), score in out.items()]


def _share(part: tuple[int, np.ndarray], words: np.ndarray) -> float:
    """Share of a part's runs among the runs of the same length of a text's words; 1 for a part without words."""
    length, runs = part
    return float(np.isin(runs, shingles(words, length)).mean()) if length and len(words) >= length else float(not length)


def leaks(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Pairs of a row and a benchmark item whose question and answer it holds.

    Returns id_col, ``item_id``, ``score`` (as a multiple of the item's threshold), ``question_overlap`` and
    ``answer_overlap``: shares of the runs of five words that stand in the row's whole text. Null and empty texts or items match
    nothing; an item without an answer is judged by its question; repeated rows or items give a pair each. The items (a
    benchmark, which the driver can hold) are weighed together and searched in INDEXES indexes of ITEMS a scan, so scores do not
    depend on their number and more items cost more scans, not more memory in a task. An item is found through a passage that
    reaches half of its own score: one whose question and answer stand far apart, each below that, is not.
    """
    kinds, items = dict(df.dtypes), benchmark.where(F.length(F.trim(F.coalesce(item_text, F.lit("")))) > 0).select(item_col, item_text)
    item_kind = dict(benchmark.dtypes)[item_col]
    schema = f"`{id_col}` {kinds[id_col]}, item_id {item_kind}, score double, question_overlap double, answer_overlap double"
    parts = []
    rows = [tuple(r) for r in items.orderBy(item_col, item_text).collect()]
    statistics = Statistics.of([t for _, t in rows])
    for at in range(0, max(1, len(rows)), ITEMS * INDEXES):
        group = rows[at : at + ITEMS * INDEXES]
        indexes = [Index.build(group[i : i + ITEMS], statistics=statistics) for i in range(0, max(1, len(group)), ITEMS)]
        parts.append(_against(df.select(text_col, id_col), indexes, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _against(df: DataFrame, indexes: list[Index], schema: str) -> DataFrame:
    shipped = df.sparkSession.sparkContext.broadcast(indexes)
    id_col = df.columns[1]

    def run(batch: pa.RecordBatch) -> dict:
        rows = []
        for at, _, hashes, owner in text_words(batch.column(0)):
            for index in shipped.value if len(hashes) else []:
                for text, item, score in index.candidates(hashes, owner):
                    lo, hi = np.searchsorted(owner, (text, text + 1))
                    words = hashes[lo:hi]
                    question, answer = _share(index.questions[item], words), _share(index.answers[item], words)
                    if question >= LEAST_OVERLAP and answer >= LEAST_OVERLAP:
                        rows.append((at + text, index.ids[item], score, question, answer))
        rows.sort(key=lambda r: (r[0], r[2]))
        return {
            id_col: batch.column(1).take(pa.array([r[0] for r in rows], pa.int64())),
            "item_id": [r[1] for r in rows], "score": [r[2] for r in rows],
            "question_overlap": [r[3] for r in rows], "answer_overlap": [r[4] for r in rows],
        }

    return map_batches(df, schema, run)

