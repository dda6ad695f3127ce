"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over the counts
of vote patterns (at most 3 to the number of labellers, whatever the corpus) estimates how each labeller votes on good
documents and on each kind of bad ones, and so its accuracy; a pattern's posterior is the weak label of the documents
that have it. Nothing is believed of a labeller beforehand: where two agree that a document is bad a kind begins, and
what one says alone counts as much as it turns out to be right. A hashed linear scorer is trained on a bounded sample
of weak labels and scores every document from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import fresh, table
from .encoding import groups, release

#: Documents that the scorer is fitted on, about; hashed features; passes over the sample.
SAMPLE, FEATURES, PASSES = 6000, 1 << 15, 120
LABELLERS = ("case", "shouting", "symbols", "marked_words", "letters", "bare_marks", "separators", "repeats", "common_word", "vocabulary")
#: How likely a document is bad when estimation begins: with two votes against it or more, with one, and with none. It is
#: a start and no prior: the counts alone decide what follows, each with SMOOTH added.
BEGIN, SMOOTH = (0.95, 0.5, 0.05), 1.0

_UPPER, _LOWER, _LETTER, _MARK = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_LOWER[97:123] = True
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARK[[ord(c) for c in "#$%&*@^~<>{}[]\\|=+_!"]] = True


def _sums(flags: np.ndarray, w: words.Words) -> np.ndarray:
    """For each word how many of its bytes have the flag."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[w.ends] - total[w.starts]


class Batch:
    """Numbers of words and documents that labellers and features use."""

    def __init__(self, texts: pa.Array):
        self.w = w = words.scan(texts)
        self.n_docs, self.n = len(texts), np.diff(w.first)
        self.upper, self.lower, self.letters, self.marks = (_sums(x[w.data], w) for x in (_UPPER, _LOWER, _LETTER, _MARK))
        self.again = np.zeros(len(w.doc), bool)
        if len(w.doc):
            self.again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])

    def share(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.w.doc, weights=flags, minlength=self.n_docs) / np.maximum(self.n, 1)

    def votes(self) -> np.ndarray:
        """A row for each document, a column for each labeller: 1 good, 0 bad, -1 none."""
        w = self.w
        length = w.ends - w.starts
        capital = self.share((self.upper > 1) & (self.lower == 0))
        bang = self.share(w.data[w.ends - 1] == ord("!") if len(w.ends) else np.zeros(0))
        symbols = self.share(self.marks) / np.maximum(self.share(length), 1e-9)
        marked = self.share(_MARK[w.data[w.ends - 1]] if len(w.ends) else np.zeros(0))
        other = 1 - self.share(self.letters) / np.maximum(self.share(length), 1e-9)
        bare, bars = self.share(self.letters == 0), self.share(_MARK[w.data[w.starts]] & (length == 1) if len(length) else np.zeros(0))
        again = self.share(self.again)
        top, kinds = np.zeros(self.n_docs), np.zeros(self.n_docs)
        for d, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            if b > a:
                h = np.sort(w.hashes[a:b])
                turn = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
                top[d], kinds[d] = np.diff(turn).max() / (b - a), (len(turn) - 1) / (b - a)
        few, many = self.n < 20, self.n >= 60

        def vote(value: np.ndarray, good: float, bad: float, on: np.ndarray | bool = True) -> np.ndarray:
            return np.where(on, np.where(value <= good, 1, np.where(value >= bad, 0, -1)), -1).astype(np.int8)

        columns = [
            vote(capital, 0.1, 0.4), vote(bang, 0.05, 0.3), vote(symbols, 0.02, 0.06), vote(marked, 0.05, 0.3), vote(other, 0.1, 0.16, self.n >= 10), vote(bare, 0.02, 0.1), vote(bars, 0.02, 0.1),
            vote(again, 0.02, 0.15, ~few), vote(top, 0.12, 0.25, ~few), vote(1 - kinds, 0.5, 0.75, many),
        ]
        out = np.stack(columns, axis=1) if self.n_docs else np.zeros((0, len(LABELLERS)), np.int8)
        out[self.n == 0] = -1
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashed features of each word: the word itself, and its shape (case, marks, last byte, repetition)."""
        w = self.w
        last = w.data[w.ends - 1].astype(np.int64) if len(w.ends) else np.zeros(0, np.int64)
        case = np.where(self.lower == 0, np.where(self.upper > 0, 2, 0), np.where(self.upper > 0, 3, 1))
        length = np.minimum(w.ends - w.starts, 15)
        shape = ((((case * 4 + np.minimum(self.marks, 3)) * 2 + (self.letters == 0)) * 2 + self.again) * 16 + length) * 256 + np.where(_LETTER[last], 0, last)
        half = np.uint64(FEATURES // 2)
        return (w.hashes % half).astype(np.int64), (words.mix(shape.astype(np.uint64)) % half).astype(np.int64) + FEATURES // 2


def pattern_codes(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) + 1) @ 3 ** np.arange(votes.shape[1]) if len(votes) else np.zeros(0, np.int64)


def estimate(counts: dict[int, int], rounds: int = 300) -> tuple[dict[int, float], np.ndarray]:
    """Probability of good for each vote pattern, and each labeller's accuracy, by expectation-maximisation.

    A document is good or of a kind of bad, as many kinds as labellers: votes are independent in a kind but not among
    all bad documents, as one sort of junk is seen by some labellers and passed by others. Each kind begins with the
    documents that its labeller and at least one more call bad.
    """
    codes = np.array(sorted(counts), dtype=np.int64)
    n, k = np.array([counts[c] for c in codes.tolist()], dtype=float), len(LABELLERS)
    vote = codes[:, None] // 3 ** np.arange(k) % 3  # 0 none, 1 bad, 2 good
    one_hot = np.eye(3)[vote][:, :, 1:]  # no vote says nothing
    blamed = vote == 1
    against = blamed.sum(axis=1)
    suspect = np.select([against > 1, against == 1], BEGIN[:2], BEGIN[2])[:, None]
    kind = np.where(against[:, None] > 0, blamed / np.maximum(against, 1)[:, None], 1 / k)
    p = np.concatenate([1 - suspect, suspect * kind], axis=1)  # good, then the kinds
    for _ in range(rounds):
        mass = p * n[:, None]
        share = (mass.sum(axis=0) + SMOOTH) / (n.sum() + SMOOTH * (k + 1))
        how = np.einsum("ic,ikv->ckv", mass, one_hot) + SMOOTH
        how /= how.sum(axis=2, keepdims=True)
        like = np.einsum("ikv,ckv->ic", one_hot, np.log(how)) + np.log(share)
        new = np.exp(like - like.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - p).max() < 1e-8:
            break
        p = new
    good = p[:, 0]
    right = np.where(blamed, 1 - good[:, None], good[:, None]) * (vote > 0) * n[:, None]
    return dict(zip(codes.tolist(), good.tolist(), strict=True)), right.sum(axis=0) / np.maximum(((vote > 0) * n[:, None]).sum(axis=0), 1)


def posteriors(counts: dict[int, int]) -> dict[int, float]:
    return estimate(counts)[0]


def fit(rows: list[np.ndarray], weights: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on sparse rows, by Adam."""
    w = np.zeros(FEATURES + 1)
    if not rows:
        return w
    at, x = np.concatenate(rows), np.concatenate(weights)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    m, v = np.zeros_like(w), np.zeros_like(w)
    side = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    for t in range(1, PASSES + 1):
        z = np.bincount(row, weights=w[at] * x, minlength=len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-z)) - target) * side
        g = np.append(np.bincount(at, weights=error[row] * x, minlength=FEATURES), error.sum()) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _voted(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for a, b in groups(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(pattern_codes(Batch(batch.column(0)[a:b]).votes()))], names=["pattern"])

    return docs.select("text").mapInArrow(run, "pattern bigint")


def model(docs: DataFrame) -> tuple[dict[int, float], np.ndarray]:
    """Posteriors of the vote patterns of all documents, and the scorer's weights."""
    counts = {r["pattern"]: r["n"] for r in _voted(docs).groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    known = posteriors(counts) if counts else {}
    part = min(1.0, SAMPLE / max(sum(counts.values()), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in (Batch(batch.column(0)[x:y]) for batch in batches for x, y in groups(batch.column(0))):
            target = [known.get(c, 0.5) for c in pattern_codes(b.votes()).tolist()]
            one, two = b.features()
            for d, (a, e) in enumerate(zip(b.w.first[:-1].tolist(), b.w.first[1:].tolist(), strict=True)):
                if e > a:
                    at, n = np.unique(np.concatenate([one[a:e], two[a:e]]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([at.astype("<i4").tobytes()]), pa.array([(n / (e - a)).astype("<f4").tobytes()]), pa.array([target[d]])], names=["at", "x", "target"])

    chosen = docs.where(F.pmod(F.xxhash64(*(c for c in ("doc_id", "text") if c in docs.columns)), F.lit(1 << 20)) < int(part * (1 << 20)))
    sample = chosen.select("text").mapInArrow(run, "at binary, x binary, target double").toArrow().sort_by([("target", "ascending"), ("at", "ascending")])
    at, x = ([np.frombuffer(v, kind) for v in sample.column(c).to_pylist()] for c, kind in (("at", "<i4"), ("x", "<f4")))
    return known, fit(at, x, sample.column("target").to_numpy())


#: Columns that ``scored`` adds.
NEW = (("weak_label", T.DoubleType()), ("quality_score", T.DoubleType()), ("quality_kept", T.BooleanType()))


def _scored(docs: DataFrame, names: list[str]) -> DataFrame:
    known, w = model(docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in (batch.slice(x, y - x) for batch in batches for x, y in groups(batch.column(at))):
            b = Batch(part.column(at))
            label = np.array([known.get(c, 0.5) for c in pattern_codes(b.votes()).tolist()])
            one, two = b.features()
            score = 1 / (1 + np.exp(-(b.share(w[one] + w[two]) + w[-1])))
            score[b.n == 0] = 0.0
            columns = [*part.columns, pa.array(label, pa.float64()), pa.array(score), pa.array(score >= 0.5)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(name, kind) for name, (_, kind) in zip(names, NEW, strict=True))]))


def scored(docs: DataFrame) -> DataFrame:
    """``docs`` with weak_label, quality_score and quality_kept; columns that ``docs`` has of these names keep their
    values, and the new ones get underscores.

    Empty and null texts have nothing to be kept for: their score is 0. Every row is scored by its text alone, so rows
    that repeat, tie or have no doc_id are no special case; long texts are read whole. An empty table gives one.
    """
    return _scored(docs, [fresh(docs, name) for name, _ in NEW])


def kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all their columns and values."""
    names = [fresh(docs, name) for name, _ in NEW]
    return _scored(docs, names).where(F.col(names[2])).select(docs.columns)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "weak_label", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"))
