"""Toxic spans by a linear-chain conditional random field.

Training: on a bounded sample of labelled documents, tokens of toxic ones are labelled toxic where a short list of
features (words and their beginnings) explains the document labels; a two-state chain is fitted to stretches of them.
Scoring: forward-backward over every whole text gives each token its marginal; spans are the tokens above a half, and
the marginals add up to the score of the document, calibrated on the sample's document labels.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding
from .common import discard, mark, stored, table

#: Labelled documents of each kind that the field is fitted on, about, and the bytes of their texts, about; words of a
#: stretch; hashed features.
TOXIC, CLEAN, BYTES, STRETCH, FEATURES, PASSES = 3000, 5000, 64 << 20, 24, 1 << 17, 80
#: A feature explains a label if so many toxic documents have it, and it is so many times likelier in them.
LEAST, ODDS, COVER = 5, 25.0, 3
_EDGE = string.punctuation + "“”‘’«»…–—"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features(word: str) -> list[str]:
    """The word without marks at its edges, in lower case, its beginnings and its endings."""
    core = word.strip(_EDGE).lower()
    n = len(core)
    return [f"w{core}", *(f"p{core[:k]}" for k in (3, 4, 5, 6) if n > k), *(f"s{core[-k:]}" for k in (3, 4) if n > k)]


def hashed(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "replace")) % FEATURES for f in features(word)]


def held_out(doc_id: str = "doc_id"):
    """Rows that labels are never learned from: crc32 of the doc_id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of about TOXIC and CLEAN labelled documents that are not held out, chosen by hash.

    A doc_id with both labels is no evidence and has none; one that repeats its label has it once. Of long texts fewer
    are taken, so that they have about BYTES in all.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("other")).where("toxic = other")
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    most = F.when(F.col("toxic") == 1, F.lit(int(min(1, TOXIC / max(n.get(1, 0), 1)) * 1e6))).otherwise(F.lit(int(min(1, CLEAN / max(n.get(0, 0), 1)) * 1e6)))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < most)
    # A few thousand rows by the fractions above, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > BYTES:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < int(BYTES / size * 1e6))
    return stored(rows.select("text", "toxic"))


def explaining(rows: DataFrame) -> set[str]:
    """Features that tell toxic documents: the surest first, until each document has COVER of them if it can."""
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return set()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[toxic].update({f for w in set(_WORD.findall(text)) for f in features(w) if len(f) > 3})
        names = list(found[1] | found[0])
        columns = [pa.array(names, pa.string()), pa.array([found[1][f] for f in names], pa.int64()), pa.array([found[0][f] for f in names], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "clean"])

    counted = rows.mapInArrow(count, "feature string, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = (F.col("toxic") + 0.5) / (n1 + 1) / ((F.col("clean") + 0.5) / (n0 + 1))
    likely = {r["feature"]: (r["odds"], r["toxic"]) for r in counted.withColumn("odds", odds).where((F.col("toxic") >= LEAST) & (F.col("odds") >= ODDS)).collect()}

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [sorted({f for w in set(_WORD.findall(t)) for f in features(w) if f in likely}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.string()))], names=["has"])

    docs = [x for x in rows.where("toxic = 1").select("text").mapInArrow(having, "has array<string>").toArrow().column("has").to_pylist() if x]
    where: dict[str, list[int]] = {}
    for i, has in enumerate(docs):
        for f in has:
            where.setdefault(f, []).append(i)
    covered, chosen = np.zeros(len(docs), int), set()
    for f in sorted(where, key=lambda f: (-len(where[f]) * np.log(likely[f][0]), -len(f), f)):
        if any(f[1:].startswith(g[1:]) for g in chosen if f[0] != "s" and g[0] == "p"):
            continue
        if (covered[where[f]] < COVER).sum() >= LEAST:
            chosen.add(f)
            covered[where[f]] += 1
    return chosen


def stretches(rows: DataFrame, toxic: set[str]) -> tuple[list[list[list[int]]], list[list[int]]]:
    """Hashed features and labels of words, in stretches around toxic words and from the middle of clean documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = _WORD.findall(text)
                hit = [i for i, x in enumerate(w) if any(f in toxic for f in features(x))] if label else []
                starts = {max(0, i - STRETCH // 2) for i in hit[:: max(1, len(hit) // 3)]} if label else {len(w) // 3}
                for a in starts:
                    part = w[a : a + STRETCH]
                    if part:
                        mine = set(hit)
                        yield pa.RecordBatch.from_arrays([pa.array([[hashed(x) for x in part]]), pa.array([[int(a + k in mine) for k in range(len(part))]])], names=["x", "y"])

    found = rows.mapInArrow(cut, "x array<array<bigint>>, y array<bigint>").toArrow()
    both = sorted(zip(found.column("x").to_pylist(), found.column("y").to_pylist(), strict=True))
    return [x for x, _ in both], [y for _, y in both]


class Field:
    """Weights of a two-state chain: ``emit`` (toxic against not, by feature), ``bias``, ``step`` and ``start``."""

    def __init__(self):
        self.emit, self.bias, self.step, self.start = np.zeros(FEATURES), 0.0, np.zeros((2, 2)), np.zeros(2)

    def fit(self, x: list[list[list[int]]], y: list[list[int]]) -> None:
        """Maximum likelihood by Adam, all stretches at once."""
        if not x:
            self.bias = -20.0
            return
        n, most = len(x), max(map(len, x))
        token = np.repeat(np.arange(n * most), [len(f) for s in x for f in [*s, *[[]] * (most - len(s))]])
        at = np.array([i for s in x for f in s for i in f])
        live = np.array([[k < len(s) for k in range(most)] for s in x])
        gold = np.array([[s[k] if k < len(s) else 0 for k in range(most)] for s in y])
        theta, size = np.zeros(FEATURES + 7), live.sum()
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        pair = np.zeros((2, 2))
        for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)):
            pair[a, b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & live[:, 1:]).sum()
        for t in range(1, PASSES + 1):
            emit, bias, step, start = theta[:FEATURES], theta[FEATURES], theta[FEATURES + 1 : FEATURES + 5].reshape(2, 2), theta[FEATURES + 5 :]
            e = np.bincount(token, weights=emit[at], minlength=n * most).reshape(n, most) + bias
            score = np.stack([np.zeros_like(e), e], axis=2)
            forward, backward = np.zeros((n, most, 2)), np.zeros((n, most, 2))
            forward[:, 0] = start + score[:, 0]
            for k in range(1, most):
                new = np.logaddexp(forward[:, k - 1, :1] + step[0], forward[:, k - 1, 1:] + step[1]) + score[:, k]
                forward[:, k] = np.where(live[:, k, None], new, forward[:, k - 1])
            for k in range(most - 2, -1, -1):
                ahead = score[:, k + 1] + backward[:, k + 1]
                new = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
                backward[:, k] = np.where(live[:, k + 1, None], new, 0.0)
            total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
            p = np.exp(forward + backward - total[:, None, None])
            error = np.where(live, p[:, :, 1] - gold, 0.0) / size
            joint = np.exp(forward[:, :-1, :, None] + step + (score + backward)[:, 1:, None, :] - total[:, None, None, None]) * live[:, 1:, None, None]
            g = np.concatenate([np.bincount(at, weights=error.ravel()[token], minlength=FEATURES), [error.sum()], ((joint.sum(axis=(0, 1)) - pair) / size).ravel(), (p[:, 0].sum(axis=0) - np.bincount(gold[:, 0], minlength=2)) / size])
            g += 1e-7 * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        self.emit, self.bias = theta[:FEATURES].astype(np.float32), float(theta[FEATURES])
        self.step, self.start = theta[FEATURES + 1 : FEATURES + 5].reshape(2, 2).copy(), theta[FEATURES + 5 :].copy()

    def marginals(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of toxic for each word; ``first`` marks words at which a text starts.

        The words are laid out as columns of consecutive words. The columns' transfer matrices are multiplied step by
        step for all columns at once, chained from column to column, and only then are the messages computed.
        """
        n = len(e)
        if not n:
            return np.zeros(0)
        rows = int(n**0.5) + 1
        columns = -(-n // rows)
        odds = np.exp(np.clip(np.pad(e, (0, rows * columns - n)), -30, 30)).reshape(columns, rows).T
        begin = np.pad(first, (0, rows * columns - n), constant_values=True).reshape(columns, rows).T
        go, start = np.exp(self.step - self.step.max()), np.exp(self.start - self.start.max())
        a, b, c, d = (np.where(begin, s, g) for s, g in ((start[0], go[0, 0]), (start[1], go[0, 1]), (start[0], go[1, 0]), (start[1], go[1, 1])))
        b, d = b * odds, d * odds
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
        pa_, pb, pc_, pd = a[0], b[0], c[0], d[0]
        for k in range(1, rows):
            pa_, pb, pc_, pd = pa_ * a[k] + pb * c[k], pa_ * b[k] + pb * d[k], pc_ * a[k] + pd * c[k], pc_ * b[k] + pd * d[k]
            top = np.maximum(np.maximum(pa_, pb), np.maximum(pc_, pd))
            pa_, pb, pc_, pd = pa_ / top, pb / top, pc_ / top, pd / top
        ahead, behind = np.zeros((columns, 2)), np.zeros((columns, 2))
        x = np.array([1.0, 1.0])
        for k in range(columns):
            ahead[k] = x
            x = np.array([x[0] * pa_[k] + x[1] * pc_[k], x[0] * pb[k] + x[1] * pd[k]])
            x /= x.sum()
        x = np.array([1.0, 1.0])
        for k in range(columns - 1, -1, -1):
            behind[k] = x
            x = np.array([pa_[k] * x[0] + pb[k] * x[1], pc_[k] * x[0] + pd[k] * x[1]])
            x /= x.sum()
        f0, f1 = np.zeros_like(odds), np.zeros_like(odds)
        x0, x1 = ahead[:, 0], ahead[:, 1]
        for k in range(rows):
            x0, x1 = x0 * a[k] + x1 * c[k], x0 * b[k] + x1 * d[k]
            top = x0 + x1
            f0[k], f1[k] = x0, x1 = x0 / top, x1 / top
        y0, y1 = behind[:, 0], behind[:, 1]
        for k in range(rows - 1, -1, -1):
            f0[k], f1[k] = f0[k] * y0, f1[k] * y1
            y0, y1 = a[k] * y0 + b[k] * y1, c[k] * y0 + d[k] * y1
            top = y0 + y1
            y0, y1 = y0 / top, y1 / top
        return (f1 / (f0 + f1)).T.ravel()[:n]


class Tagger(encoding.Encoder):
    """Marginals of the words of whole batches; each distinct word's emission is computed once."""

    def __init__(self, field: Field):
        self.field = field
        super().__init__(None, words_only=True)

    def _start(self) -> None:
        self.table, self.scores = encoding.Remembered(), np.zeros(0)

    def learned(self, texts: list[str]) -> None:
        emit = self.field.emit
        new = np.array([emit[hashed(t)].sum() for t in texts]) + self.field.bias
        if len(self.scores) < self.table.size + len(new):
            self.scores = np.concatenate([self.scores, np.zeros(len(self.scores) + len(new))])
        self.scores[self.table.size : self.table.size + len(new)] = new

    def tag(self, texts: pa.Array) -> tuple:
        w, entries, _ = self.entries(texts)
        first = np.ones(len(w.doc), bool)
        first[1:] = w.doc[1:] != w.doc[:-1]
        p = self.field.marginals(self.scores[entries] if len(entries) else np.zeros(0), first)
        sure = np.where(p >= 0.01, p, 0.0)
        mass = np.bincount(w.doc, weights=sure, minlength=len(texts))
        most = np.zeros(len(texts))
        np.maximum.at(most, w.doc, p)
        return w, p, np.stack([np.ones(len(texts)), most, np.log1p(mass)], axis=1)


_taggers: dict[str, Tagger] = {}
encoding.kept.append(_taggers)


def tagger(name: str, field: Field) -> Tagger:
    if name not in _taggers:
        _taggers.clear()
        _taggers[name] = Tagger(field)
    return _taggers[name]


def model(docs: DataFrame, labels: DataFrame) -> tuple[Field, np.ndarray, str]:
    """The field, the calibration of its aggregates to document labels, and a name for both."""
    rows, field = sample(docs, labels), Field()
    field.fit(*stretches(rows, explaining(rows)))
    name = str(zlib.crc32(np.asarray(field.emit, np.float32).tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, x = tagger(name, field).tag(batch.column(0))
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in (1, 2)), batch.column(1)], names=["most", "mass", "toxic"])

    found = rows.mapInArrow(run, "most double, mass double, toxic int").toPandas().sort_values(["toxic", "most", "mass"])
    x, y = np.column_stack([np.ones(len(found)), found[["most", "mass"]].to_numpy()]), found["toxic"].to_numpy()
    w = np.array([-3.0, 4.0, 1.0])
    if 0 < y.sum() < len(y):
        for _ in range(50):  # Newton steps, with a light prior
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3) * 0.05
            w = w - np.linalg.solve(h, x.T @ (p - y) + 0.05 * w)
    return field, w, name


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and spans (start:end in code points, comma-joined) of every row.

    Null texts are empty; a text without words has the score of no evidence. Without labels of both kinds no word is
    toxic. A row without doc_id is not held out. Rows that repeat a doc_id are scored by their texts, each by itself.
    Labels that are null or neither 0 nor 1, or that contradict each other for a doc_id, are none. Other columns, of
    whatever names, are not looked at; an empty table gives an empty one.
    """
    since = mark()
    field, weights, name = model(docs, labels)
    discard(docs.sparkSession, since)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in encoding.groups(batch.column(2)):
                texts = batch.column(2)[a:b]
                w, p, x = tagger(name, field).tag(texts)
                score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                spans: list[list[str]] = [[] for _ in range(b - a)]
                for i in np.flatnonzero(p >= 0.5).tolist():
                    d, start, end = w.doc[i], w.starts[i], w.ends[i]
                    before = len(w.data[w.offsets[d] : start].tobytes().decode("utf-8", "replace"))
                    spans[d].append(f"{before}:{before + len(w.data[start:end].tobytes().decode('utf-8', 'replace'))}")
                columns = [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([",".join(s) for s in spans])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "spans"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, spans string")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
