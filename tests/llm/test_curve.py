"""Packing along the curve: every id in exactly one piece, no padding, neighbours alike; the curve itself."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from scholarlens.llm import curve, registry

from .helpers import documents, messy
from .test_tokens import WORDS, assert_gapless, crc, ids, library  # noqa: F401


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_visits_neighbours(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = curve.hilbert([points[:, k] for k in range(dims)], bits)
    assert sorted(key.tolist()) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def check(got, texts, doc_ids, library, size=4096):  # noqa: F811
    """Pieces of each document's ids, whole, in sequences that are full or a power of two."""
    want = Counter()
    for i, t in zip(doc_ids, texts, strict=True):
        want[(i, tuple([*ids(library, WORDS, t), 2]))] += 1
    held = defaultdict(list)
    for r in got:
        held[r.doc_id].append(r)
    for (i, whole), times in want.items():
        mine = [r for r in held[i] if r.doc_tokens == len(whole) and crc(whole[r.start : r.start + r.length]) == r.ids_crc32]
        cover = Counter(k for r in mine for k in range(r.start, r.start + r.length))
        assert cover == Counter({k: times for k in range(len(whole))})
    assert sum(r.length for r in got) == sum(len(w) * n for (_, w), n in want.items())
    assert_gapless(got, size)
    full = Counter()
    for r in got:
        full[r.sequence_id] += r.length
    assert all(n == size or n & (n - 1) == 0 for n in full.values())


def test_packing(spark, library):  # noqa: F811
    texts = [*messy(), "long " * 50_000]
    check(curve.packed(documents(spark, texts).repartition(3), WORDS).collect(), texts, range(len(texts)), library)


def test_parts(spark, library, monkeypatch):  # noqa: F811
    """Many parts, long documents in rows of a few ids."""
    monkeypatch.setattr(curve, "PART_BYTES", 2000)
    monkeypatch.setattr(curve, "CHUNK", 37)
    texts = messy()
    got = curve.packed(documents(spark, texts), WORDS, size=64).collect()
    assert len({r.sequence_id >> 32 for r in got}) > 5
    check(got, texts, range(len(texts)), library, 64)


def test_repeated_rows_and_nulls(spark, library, monkeypatch):  # noqa: F811
    """Half of all rows are copies, some the same in every column: they are dealt over parts, and each is packed once."""
    monkeypatch.setattr(curve, "PART_BYTES", 500)
    texts = ["same words here"] * 200 + [None] * 20 + ["other words"] * 5
    doc_ids = [*range(150), *[7] * 50, *[None] * 20, 1, 2, 3, 4, 5]
    got = curve.packed(documents(spark, texts, doc_ids), WORDS, size=16).collect()
    assert sum(r.length for r in got) == 200 * 4 + 20 + 5 * 3
    assert_gapless(got, 16)
    sizes = Counter(r.sequence_id >> 32 for r in got)
    assert max(sizes.values()) < len(got) / 3


def test_empty_table(spark):
    assert curve.packed(documents(spark, ["a"]).limit(0), WORDS).count() == 0


def test_neighbours_are_alike(spark):
    """Documents of one subject share sequences two and a half times as often as by chance, at least."""
    rng = random.Random(3)
    words = [[f"{s}word{k}" for k in range(60)] for s in "abcdefgh"]
    subject = [rng.randrange(8) for _ in range(400)]
    texts = [" ".join(rng.choice(words[s]) if rng.random() < 0.6 else f"common{rng.randrange(50)}" for _ in range(80)) for s in subject]
    rows = curve.packed(documents(spark, texts), WORDS, size=1024).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(subject[r.doc_id])
    pairs = [(a, b) for m in by.values() for k, a in enumerate(m) for b in m[:k]]
    assert sum(a == b for a, b in pairs) / len(pairs) > 2.5 / 8


def test_query(spark, sf_dir, library):  # noqa: F811
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    check(registry.QUERIES["op12_curve_packing"](spark, sf_dir).collect(), [r.text for r in rows], [r.doc_id for r in rows], library)


def test_encoder_matches_the_shared_one(spark, library):  # noqa: F811
    texts = messy()
    got = {}
    for r in sorted(curve.tokenized(documents(spark, texts).coalesce(1), WORDS).collect(), key=lambda r: (r.row, r.start)):
        held = got.setdefault(r.row & (1 << 40) - 1, [])
        assert r.start == len(held)
        held += np.frombuffer(r.ids, "<u2").tolist()
        assert len(held) <= r.doc_tokens
    assert [got[k] for k in range(len(texts))] == [[*ids(library, WORDS, t), 2] for t in texts]
    assert curve._kind(1 << 16, 2) == "<u2" and curve._kind(1 << 16, 1 << 16) == "<u4" == curve._kind((1 << 16) + 1, 2)
