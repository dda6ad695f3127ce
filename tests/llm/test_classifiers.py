import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarlens.llm import quality, toxicity

from .helpers import documents, messy

SF = "/root/testdata/sf0.01"


def test_quality_by_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.scored(docs).join(labels, "doc_id").select("quality", "quality_kept").toPandas()
    assert got.quality_kept[got.quality == 1].mean() > 0.99
    assert 1 - got.quality_kept[got.quality == 0].mean() > 0.85


def agreement(votes, good):
    """Of the estimate, of the majority of votes, and of "any vote against it"."""
    codes = quality.pattern_codes(votes)
    known, right = quality.estimate(dict(zip(*(x.tolist() for x in np.unique(codes, return_counts=True)), strict=True)))
    says = (np.array([known[c] for c in codes.tolist()]) >= 0.5, (votes == 1).sum(axis=1) >= (votes == 0).sum(axis=1), ~(votes == 0).any(axis=1))
    return [(x == good).mean() for x in says], right


@pytest.mark.parametrize("noisy", [[], [2], [0, 5, 9]])
def test_estimates_beat_any_fixed_vote(noisy):
    """Kinds of junk that two or three labellers see each, and labellers that blame at random: the counts tell which."""
    rng, k = np.random.default_rng(1), len(quality.LABELLERS)
    kind = rng.integers(0, 4, 6000)
    good = rng.random(6000) < 0.8
    votes = np.ones((6000, k), np.int8)
    for j, seen in enumerate((0, 0, 1, 1, 1, 2, 2, 3, 3, 3)):
        votes[~good & (kind == seen) & (rng.random(6000) < 0.9), j] = 0
        votes[rng.random(6000) < (0.25 if j in noisy else 0.002), j] = 0
        votes[rng.random(6000) < 0.1, j] = -1
    (estimate, majority, veto), right = agreement(votes, good)
    assert estimate > 0.95 and estimate > majority + 0.03 and (estimate > veto + 0.1 if noisy else estimate >= veto - 0.01)
    assert all(right[j] < min(right[i] for i in range(k) if i not in noisy) for j in noisy)


def test_estimation_decides_labelled_documents(spark):
    """On labelled documents the weak labels agree better than a majority of the votes that they come from."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").select("text", "quality").toPandas()
    votes = quality.Batch(quality.pa.array(rows.text.tolist(), quality.pa.string())).votes()
    (estimate, majority, _), _ = agreement(votes, rows["quality"].to_numpy() == 1)
    assert estimate > 0.98 and estimate > majority + 0.03


def test_scores_are_the_formula_s(spark):
    """Every score of a table against a plain loop over its words with the fitted weights."""
    docs = documents(spark, messy()[:28])
    known, w = quality.model(docs)
    for r in quality.scored(docs).collect():
        b = quality.Batch(quality.pa.array([r.text], quality.pa.string()))
        one, two = b.features()
        total = sum(w[i] + w[j] for i, j in zip(one.tolist(), two.tolist(), strict=True))
        want = 1 / (1 + np.exp(-(total / len(one) + w[-1]))) if len(one) else 0.0
        assert r.quality_score == pytest.approx(want) and r.quality_kept == (want >= 0.5)
        assert r.weak_label == known[int(quality.pattern_codes(b.votes())[0])]


def test_quality_edges(spark):
    docs = documents(spark, [*messy(), "the same"], [*range(len(messy())), 3])
    got = quality.scored(docs).collect()
    assert len(got) == docs.count()
    assert all(r.quality_score == 0.0 and not r.quality_kept for r in got if not (r.text or "").split())
    clash = docs.withColumn("quality_score", F.lit("x"))
    assert quality.kept(clash).columns == clash.columns
    assert {r.quality_score for r in quality.kept(clash).collect()} == {"x"} and {r.quality_score for r in quality.scored(clash).collect()} == {"x"}
    assert quality.scored(docs.limit(0)).count() == 0


def test_marginals_are_exact():
    f, rng = toxicity.Field(), np.random.default_rng(2)
    f.step, f.start = rng.normal(size=(2, 2)), rng.normal(size=2)
    for n in (1, 2, 50, 333):
        e, first = rng.normal(size=n) * 3, rng.random(n) < 0.1
        first[0] = True
        cut, want = [*np.flatnonzero(first), n], []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            ahead, behind = np.zeros((b - a, 2)), np.ones((b - a, 2))
            ahead[0] = np.exp(f.start) * [1, np.exp(e[a])]
            for k in range(1, b - a):
                ahead[k] = (ahead[k - 1] @ np.exp(f.step)) * [1, np.exp(e[a + k])]
                ahead[k] /= ahead[k].sum()
            for k in range(b - a - 2, -1, -1):
                behind[k] = np.exp(f.step) @ (behind[k + 1] * [1, np.exp(e[a + k + 1])])
                behind[k] /= behind[k].sum()
            both = ahead * behind
            want += (both[:, 1] / both.sum(axis=1)).tolist()
        assert f.marginals(e, first) == pytest.approx(want)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.scored(docs.join(labels.select("doc_id"), "doc_id"), labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 500 and (held.predicted == held.toxic).mean() > 0.97
    hit = got[(got.predicted == 1) & (got.toxic == 1)].head(1).merge(docs.toPandas(), on="doc_id").iloc[0]
    start, end = map(int, hit.spans.split(",")[0].split(":"))
    assert hit.text[start:end].strip() and " " not in hit.text[start:end]


def test_labels_held_out_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.scored(docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert a.score.tolist() == b.score.tolist()


def test_toxicity_edges(spark):
    docs = documents(spark, [*messy(), "x"], [*range(len(messy())), None])
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 1)], "doc_id bigint, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == 0 and r.held_out is not None for r in got)
    assert toxicity.scored(docs.limit(0), labels.limit(0)).count() == 0


def test_contradictory_labels_are_none(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    some = labels.where("doc_id % 3 = 0").select("doc_id", "toxic")
    twice = labels.select("doc_id", "toxic").unionByName(labels.select("doc_id", "toxic")).unionByName(some.withColumn("toxic", 1 - F.col("toxic")))
    kept = labels.where("doc_id % 3 <> 0")
    a, b = (toxicity.scored(docs, x).orderBy("doc_id").toPandas() for x in (twice, kept))
    assert a.score.tolist() == b.score.tolist()


def test_sample_is_bounded_by_bytes(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    size = lambda: toxicity.sample(docs, labels).agg(F.sum(F.octet_length("text"))).first()[0]
    whole = size()
    monkeypatch.setattr(toxicity, "BYTES", whole // 4)
    assert 0 < size() < whole // 2
