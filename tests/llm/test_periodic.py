"""Periodic runs against a comparison of all words, and what happens where hashes mislead."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from scholarlens.llm import periodic, registry
from scholarlens.llm import words as scanner

from .helpers import documents, messy, words


def brute(w):
    """(start, length, period) of every run, by start and length: all pairs of words are compared."""
    number = {x: k for k, x in enumerate(w)}
    ids, found = np.array([number[x] for x in w]), {}
    for q in range(1, len(w) // 4 + 1):
        differ = np.flatnonzero(np.concatenate([[True], ids[:-q] != ids[q:], [True]])) - 1
        for i, j in zip((differ[:-1] + 1).tolist(), differ[1:].tolist(), strict=True):
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(w, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def looped(doc_id, w):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def row(doc_id, text):
    w = looped(doc_id, words(text))
    runs = sorted(brute(w), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(collapsed(w, runs)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = sorted(tuple(r[c] for c in COLUMNS) for r in registry.QUERIES["op13_periodic"](spark, sf_dir).collect())
    want = sorted(row(r.doc_id, r.text) for r in docs)
    assert got == want and sum(r[1] for r in got) > 10


def cases():
    rng = random.Random(4)
    out = [*messy(), "a " * 40_000, "a b " * 3000 + "c", "x y z " * 9 + "x y", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b"]
    for _ in range(150):
        w = [rng.choice("ab") for _ in range(rng.randrange(60))]
        p = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
        out.append(" ".join(w + p * rng.randrange(3, 7) + p[: rng.randrange(len(p))] + w[:5]))
    return out


def test_rows(spark):
    """Nulls, empty and long texts, white space, equal letters, repeated rows, no id, other columns."""
    texts = cases()
    ids = [*range(len(texts) - 2), 3, None]
    got = periodic.detected(documents(spark, texts, ids).repartition(3)).collect()
    want = []
    for i, t in zip(ids, texts, strict=True):
        w = words(t)
        runs = sorted(brute(w), key=lambda r: (r[0], r[2]))
        want.append((i, len(w), tuple(runs), collapsed(w, runs)))
    assert sorted(((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got), key=str) == sorted(want, key=str)


def test_looped(spark):
    texts = cases()
    ids = [*range(0, 3 * len(texts) - 3, 3), None]
    got = {r.doc_id: r.text for r in periodic.looped(documents(spark, texts, ids)).collect()}
    assert all(words(got[i]) == looped(i, words(t)) for i, t in zip(ids, texts, strict=True))


def test_empty_table(spark):
    assert periodic.detected(documents(spark, ["a"]).limit(0)).count() == 0


@given(st.lists(st.lists(st.sampled_from(["a", "b", "longer-word", "longer-work"]), max_size=50), max_size=5))
@settings(max_examples=200, deadline=None)
def test_find(texts):
    check(texts)


def check(texts, weak=False):
    w = scanner.scan(pa.array([" ".join(t) for t in texts], pa.string()))
    if weak:
        w.hashes = w.hashes & np.uint64(1)
    text, start, end, q = periodic.find(w)
    got = [sorted((s - w.first[t], e - s, p) for d, s, e, p in zip(text, start, end, q, strict=True) if d == t) for t in range(len(texts))]
    assert got == [brute(t) for t in texts]


@given(st.lists(st.lists(st.sampled_from([f"w{k}" for k in range(5)]), min_size=8, max_size=40), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_hashes_that_mislead(texts):
    """With hashes of one bit, false runs are found and thrown out, and the texts searched word by word."""
    check([t + t[:2] * 4 for t in texts], weak=True)


def test_many_pairs_are_looked_at_in_parts(monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 50)
    rng = random.Random(2)
    check([[rng.choice("ab") for _ in range(n)] for n in (0, 5, 6, 300, 1, 90, 200)])


def test_thue_morse():
    """A text in which sums modulo a power of two mislead whatever the base."""
    t = [0]
    while len(t) < 4096:
        t += [1 - x for x in t]
    check([["ab"[x] for x in t] + ["c"] + ["ab"[x] for x in t[:100]] * 4])
