"""Each stage of the pipeline against a brute-force version, on what the stage before it kept."""

import numpy as np
import pytest

import corpus_pipeline
from scholarlens.llm import encoding, quality, secrets
from scholarlens.llm.common import stored

from .helpers import near_classes, without_repeats
from .test_secrets import brute
from .test_tokens import assert_gapless


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality(stages):
    known, w = quality.model(stages[0])
    want = {r.doc_id for r in quality.scored(stages[0]).collect() if r.quality_score >= 0.5}
    assert set(texts(stages[1])) == want and 0 < len(want) < stages[0].count()


def test_near_duplicates(stages):
    before = texts(stages[1])
    classes = near_classes(list(before.values()), list(before), 5, 80)
    assert texts(stages[2]) == {i: t for i, t in before.items() if classes[i] == i}


def test_substrings(stages):
    before, want = texts(stages[2]), {}
    for i, (w, gone) in without_repeats(list(before.values()), list(before), 13).items():
        if not any(gone):
            want[i] = before[i]
        elif not all(gone):
            want[i] = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    assert texts(stages[3]) == want


def test_secrets(stages):
    before = texts(stages[3])
    assert texts(stages[4]) == {i: secrets.redact(t, brute(t)) for i, t in before.items()}
    assert not any(brute(t) for t in texts(stages[4]).values())


def test_packing(stages):
    library = encoding.Library(encoding.vocabulary(encoding.WORDS)).library
    rows, want = sorted(stages[5].collect()), []
    for i, t in sorted(texts(stages[4]).items()):
        n = len(library.encode(t, add_special_tokens=False).ids) + 1
        want += [(i, k // 4096, k, min(4096, n - k)) for k in range(0, n, 4096)]
    assert [(r.doc_id, r.piece, r.start, r.length) for r in rows] == want
    assert_gapless(rows, 4096)
    assert len({r.sequence_id for r in rows}) <= np.ceil(sum(r.length for r in rows) / 4096) + 1


def test_run(spark, sf_dir, stages):
    assert sorted(corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32").collect()) == sorted(stages[5].select("doc_id", "piece", "ids_crc32").collect())


def staged(spark, docs, sf_dir):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        out.append(docs)
    return out


def rough(spark, sf_dir):
    """Good texts with copies, secrets and passages, beside nulls, empty texts, repeated rows and clashing columns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = [(None, "no name " * 30), (5_000_000, None), (5_000_001, ""), (5_000_002, "  \n"), (None, None), (5_000_003, 'ordinary words with password = "abcdefgh1" among them')]
    rows = docs.select("doc_id", "text").unionByName(docs.where("doc_id < 20").select("doc_id", "text")).unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    clash = "777 AS block", "'mine' AS quality_score", "1 AS keep", "2L AS component_id", "'r' AS rank", "3L AS length", "4 AS piece", "5L AS n", "'v' AS value", "6L AS hub", "'w' AS weak_label", "true AS quality_kept", "7 AS QUALITY_KEPT_"
    return rows.selectExpr("*", *clash)


def test_rough_input(spark, sf_dir):
    docs = rough(spark, sf_dir)
    out = staged(spark, docs, sf_dir)
    for df in out[:-1]:
        assert df.columns == docs.columns and [f.dataType for f in df.schema] == [f.dataType for f in docs.schema]
        assert {tuple(r) for r in df.drop("doc_id", "text").distinct().collect()} == {(777, "mine", 1, 2, "r", 3, 4, 5, "v", 6, "w", True, 7)}
    known = {r.doc_id for r in docs.collect()}
    left = [r.doc_id for r in out[3].collect()]
    assert set(left) <= known and all(r.text and r.text.strip() for r in out[0].collect())
    assert out[0].where("doc_id IS NULL").count() == out[3].where("doc_id IS NULL").count()
    assert sorted(r.doc_id or -1 for r in out[4].where("piece = 0").collect()) == sorted(i or -1 for i in left)


def test_empty_table(spark, sf_dir):
    out = staged(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0), sf_dir)
    assert [df.count() for df in out] == [0] * 5


def test_text_of_many_megabytes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = [w for r in docs.orderBy("doc_id").select("text").limit(60).collect() for w in (r.text or "").split()]
    rng = np.random.default_rng(1)
    huge = " ".join(np.array(words, dtype=object)[rng.integers(0, len(words), 1_500_000)])
    assert len(huge) > 8_000_000
    row = spark.createDataFrame([(9_000_000, huge)], "doc_id bigint, text string")
    more = docs.limit(1).drop("doc_id", "text").crossJoin(row).select(docs.columns)
    out = staged(spark, docs.unionByName(more), sf_dir)
    for df in out[:-1]:
        kept = df.where("doc_id = 9000000").collect()
        assert len(kept) == 1 and len(kept[0].text) > 7_500_000
    pieces = out[4].where("doc_id = 9000000").orderBy("piece").collect()
    assert [r.piece for r in pieces] == list(range(len(pieces))) and all(r.length == 4096 for r in pieces[:-1]) and len(pieces) > 300


def test_run_leaves_only_its_result(spark, sf_dir):
    from scholarlens.llm import common

    before = common.mark()
    corpus_pipeline.run(spark, sf_dir)
    assert common.mark() - before <= 1
