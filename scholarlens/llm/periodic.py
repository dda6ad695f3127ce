"""Periodic runs of words, by a harmonic grid: every run of period q covers neighbouring multiples of q.

Words are hashed once, and prefix sums of the hashes make any two stretches comparable in a few operations. For each
period all grid points of a batch are probed at once (is the period at this point that at the next one?); the points
at which a chain of equal periods begins are extended to both sides by a binary search for the longest common
extension, all pairs simultaneously. What is found is verified word by word; a text in which a hash misled is searched
again by comparing its words. Work is n log n for n words, and a text's own: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import table
from .encoding import groups

#: A run is as long as its period this many times, and has at least so many words.
TIMES, LEAST = 4, 6
#: Pairs of period and grid point that are looked at together, about.
PAIRS = 1 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)

SPACE = r"[^\x20\x09-\x0D]+"


class Prefixes:
    """Prefix sums of hashes weighted by powers of an odd base, modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]).astype(np.uint64))
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.power[:n], out=self.total[1:])

    def same(self, i: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``i`` and from ``i + q`` have equal hashes."""
        t, j = self.total, i + q
        return (t[i + size] - t[i]) * self.power[q] == t[j + size] - t[j]

    def extension(self, i: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The longest common extension, up to ``most``, of the words from (or with ``back``, before) i and i + q."""
        low, high = np.zeros_like(i), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(i - mid if back else i, q, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entry each of ``sizes.sum()`` items belongs to, and its number there."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _parts(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of ``sizes`` that sum to about ``most``."""
    held = (np.cumsum(sizes) - sizes) // most
    cut = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(sizes)]
    yield from (slice(a, b) for a, b in zip(cut[:-1], cut[1:], strict=True) if a < b)


def _candidates(known: Prefixes, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, period, grid point): where a chain of at least three equal periods on the grid begins."""
    found = [(np.zeros(0, np.int64),) * 3]
    most = np.where(n >= LEAST, n // TIMES, 0)
    for texts in _parts(most, PAIRS):
        of, q = _spread(most[texts])
        of, q = of + texts.start, q + 1
        steps = n[of] // q - 1  # pairs of whole neighbouring periods
        for some in _parts(steps, PAIRS):
            pair, k = _spread(steps[some])
            pair += some.start
            period = q[pair]
            at = first[of[pair]] + k * period
            same = known.same(at, period, period)
            before, after = np.zeros(len(same), bool), np.zeros(len(same), bool)
            before[1:], after[:-1] = same[:-1] & (k[1:] > 0), same[1:] & (k[1:] > 0)
            head = np.flatnonzero(same & after & ~before)
            found.append((of[pair[head]], period[head], at[head]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _once(text: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each stretch once, with its smallest period, by start and period."""
    order = np.lexsort((q, end, start, text))
    text, start, end, q = (x[order] for x in (text, start, end, q))
    new = np.ones(len(order), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1]) | (text[1:] != text[:-1])
    text, start, end, q = (x[new] for x in (text, start, end, q))
    order = np.lexsort((q, start))
    return tuple(x[order] for x in (text, start, end, q))


def _equal(w: words.Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i and j are the same, byte by byte."""
    eight = np.ndarray((len(w.data) + 1,), dtype="<u8", buffer=np.concatenate([w.data, np.zeros(8, np.uint8)]), strides=(1,))
    size = w.ends - w.starts
    out = size[i] == size[j]
    active, lane = np.flatnonzero(out), 0
    while len(active):
        a, b = i[active], j[active]
        mask = words._LANE[np.minimum(size[a] - lane, 8)]
        ok = (eight[w.starts[a] + lane] ^ eight[w.starts[b] + lane]) & mask == 0
        out[active[~ok]] = False
        lane += 8
        active = active[ok & (size[a] > lane)]
    return out


def _plainly(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of one text's runs, from words that are equal where their ids are."""
    n, found = len(ids), {}
    for q in range(1, n // TIMES + 1) if n >= LEAST else ():
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b + q - a >= max(LEAST, TIMES * q):
                found.setdefault((a, b + q), q)
    return [(a, b, q) for (a, b), q in found.items()]


def find(w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, period) of every run, by start and period; places are counted over all texts' words."""
    first, n = w.first[:-1], np.diff(w.first)
    known = Prefixes(w.hashes)
    text, q, at = _candidates(known, first, n)
    end = at + q + known.extension(at, q, first[text] + n[text] - at - q, back=False)
    start = at - known.extension(at, q, at - first[text], back=True)
    long = end - start >= np.maximum(LEAST, TIMES * q)
    text, start, end, q = _once(text[long], start[long], end[long], q[long])
    wrong = set()
    for some in _parts(end - start - q, PAIRS):
        of, k = _spread((end - start - q)[some])
        of += some.start
        i = start[of] + k
        wrong.update(text[of[~_equal(w, i, i + q[of])]].tolist())
    for t in sorted(wrong):  # a hash misled: this text's words are compared themselves
        a, b, data = int(first[t]), int(first[t] + n[t]), w.data.tobytes()
        ids = np.unique(np.array([data[x:y] for x, y in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist(), strict=True)], object), return_inverse=True)[1]
        exact = np.array(_plainly(ids), np.int64).reshape(-1, 3)
        keep = text != t
        text, start, end, q = (np.concatenate([x[keep], y]) for x, y in ((text, np.full(len(exact), t)), (start, exact[:, 0] + a), (end, exact[:, 1] + a), (q, exact[:, 2])))
        text, start, end, q = _once(text, start, end, q)
    return text, start, end, q


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any of the stretches."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def _collapsed(w: words.Words, gone: np.ndarray) -> pa.Array:
    """Each text's other words, joined by one blank."""
    kept = np.flatnonzero(~gone)
    last = np.ones(len(kept), bool)
    last[:-1] = w.doc[kept[1:]] != w.doc[kept[:-1]]
    blank = w.ends[kept[~last]]  # the byte after a word that is not the last of its text
    mask = _covered(w.starts[kept], w.ends[kept], len(w.data))
    mask[blank] = True
    data = w.data.copy()
    data[blank] = 32
    offsets = np.concatenate([[0], np.cumsum(mask)])[w.offsets].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[mask])]).cast(pa.string())


def _searched(batch: pa.RecordBatch) -> pa.RecordBatch:
    w = words.scan(batch.column(1))
    text, start, end, q = find(w)
    gone = _covered(start + q, end, len(w.starts))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - w.first[text], end - start, q)], names=["start", "length", "period"])
    cut = np.searchsorted(text, np.arange(len(batch) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(w.first), pa.int64()), pa.ListArray.from_arrays(pa.array(cut), runs), _collapsed(w, gone)], names=["doc_id", "n_words", "runs", "collapsed"])


def detected(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs, collapsed: the periodic runs of words of every text (null: no words).

    A run (start, length, period) is a stretch of words with that smallest period, at least four times as long as it
    and of six words, that neither neighbouring word extends. Runs are in the order of start and period; ``collapsed``
    is the text without the words that lie in a run after its first period, joined by single blanks. Each row is
    searched by itself: rows that repeat give the same, a text may have any length, an empty table gives an empty
    one, and other columns are not looked at.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in groups(batch.column(1)):
                yield _searched(batch.slice(a, b - a))

    return docs.select("doc_id", "text").mapInArrow(search, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """doc_id, text: documents of which one in ten, drawn by doc_id (null: empty), repeats a stretch of its words to its end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g, n, w = F.expr("h div 10"), F.size("w"), F.col("w")
    drawn = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(SPACE), F.lit(0))))
    placed = drawn.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int")).withColumn("p", F.expr("int(1 + (n - a) div (3 + (h div 10) % 8))"))
    left = F.col("n") - F.col("a")
    loop = F.flatten(F.array_repeat(F.slice(w, F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice(w, F.lit(1), F.col("a")), F.slice(loop, F.lit(1), left)), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detected(looped(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    rows = found.withColumn("best", best).select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.withColumn("exponent_milli", F.expr("1000 * length div period"))
