"""Stems by known examples, and the stored postings: what a search reads, ranks, and no longer finds."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scholarlens.functions import stem
from scholarlens.operators.fulltext import FullTextIndex

STEMS = {
    "pembelajaran": "ajar", "mempelajari": "ajar", "pelajaran": "ajar", "belajar": "ajar", "pelajar": "ajar", "pengajaran": "ajar", "mengajar": "ajar", "dibimbing": "bimbing", "pembimbing": "bimbing",
    "membaca": "baca", "bacalah": "baca", "memukul": "pukul", "menyapu": "sapu", "penyakit": "sakit", "bekerja": "kerja", "makanan": "makan", "bukunya": "buku", "rumahku": "rumah", "kebersamaan": "sama",
    "tertulis": "tulis", "perbaikan": "baik", "diberikan": "beri", "pertanian": "tani", "keadilan": "adil", "buku": "buku", "di": "di", "": "", "2019": "2019", "beku": "beku",
}


def test_stems(spark):
    rows = spark.createDataFrame([(w,) for w in [*STEMS, None]], "w string")
    got = {r.w: r.s for r in rows.select("w", stem.stem(F.col("w")).alias("s")).collect()}
    assert got == STEMS | {None: None}


def test_words(spark):
    rows = spark.createDataFrame([("Élan-VITAL, x2 “y”\n",), ("",), (None,)], "t string")
    assert [r.w for r in rows.select(stem.words(F.col("t")).alias("w")).collect()] == [["élan", "vital", "x2", "y"], [], None]


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()) if isinstance(docs, dict) else docs, "id long, text string")


def brute(docs, terms, every):
    """(id, matched, score): BM25 over words that have no affixes."""
    bags = {i: Counter((t or "").split()) for i, t in docs.items()}
    n, mean = len(docs), sum(sum(b.values()) for b in bags.values()) / max(1, len(docs))
    df = {t: sum(t in b for b in bags.values()) for t in terms}
    out = []
    for i, b in bags.items():
        have = [t for t in terms if t in b]
        if have and (len(have) == len(terms) or not every):
            size = sum(b.values())
            out.append((i, len(have), sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * b[t] * 2.2 / (b[t] + 1.2 * (0.25 + 0.75 * size / mean)) for t in have)))
    return sorted(out, key=lambda r: (-r[2], r[0]))


def agree(found, want):
    got = sorted(map(tuple, found.collect()), key=lambda r: (-r[2], r[0]))
    assert [r[:2] for r in got] == [r[:2] for r in want] and [r[2] for r in got] == pytest.approx([r[2] for r in want])


@pytest.fixture
def index(spark, tmp_path):
    return FullTextIndex(spark, str(tmp_path / "ix"), frame(spark, []).schema["id"], buckets=16, files=2)


def texts(n, seed=1, start=0):
    rng = random.Random(seed)
    return {i: " ".join(rng.choice(["ox", "cat", "dog", "elk", "hen", "zz"] + [f"w{k}" for k in range(40)]) for _ in range(rng.randrange(60))) for i in range(start, start + n)}


def test_batches_replace_remove_and_compact(spark, index):
    docs = texts(60)
    assert index.search("cat").count() == 0
    index.add(frame(spark, docs))
    agree(index.search("cat DOG", k=None), brute(docs, ["cat", "dog"], True))
    more = texts(30, 2, 40)
    for _ in range(2):  # a batch that comes again counts once
        index.add(frame(spark, [*more.items(), (None, "cat"), (41, more[41])]), "s", 0)
    docs |= more
    agree(index.search("cat dog ox", k=None, every=False), brute(docs, ["cat", "dog", "ox"], False))
    index.remove(frame(spark, {1: None, 45: None, 999: None}).select("id"))
    docs = {i: t for i, t in docs.items() if i not in (1, 45)}
    agree(index.search("cat", k=None), brute(docs, ["cat"], True))
    index.compact()
    assert len(index.live()) == 1 and index.expire() > 0
    agree(index.search("cat", k=None), brute(docs, ["cat"], True))
    index.add(frame(spark, {2: "cat cat", 1: "cat again", 3: None}))
    docs |= {2: "cat cat", 1: "cat again", 3: None}
    agree(index.search("cat", k=None), brute(docs, ["cat"], True))
    agree(index.search("cat hen", k=5, every=False), brute(docs, ["cat", "hen"], False)[:5])
    for q in ("", " ,. ", "absent"):
        assert index.search(q).count() == 0


def test_a_failure_before_the_documents_are_listed(spark, index, monkeypatch):
    docs = texts(20)
    index.add(frame(spark, docs), "s", 0)
    new = texts(20, 3)
    whole = index.documents.merge
    monkeypatch.setattr(index.documents, "merge", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.add(frame(spark, new), "s", 1)
    monkeypatch.setattr(index.documents, "merge", whole)
    index.add(frame(spark, new), "s", 1)
    agree(index.search("cat", k=None), brute(new, ["cat"], True))
    index.add(frame(spark, docs), "s", 2)
    agree(index.search("cat", k=None), brute(docs, ["cat"], True))


def test_a_search_reads_its_terms_only(spark, index):
    index.add(frame(spark, texts(80)))
    found, bucket = index.postings(index.terms("cat")), index.terms("cat")["cat"]
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}) > 8
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:] if "term" in x)
    partitions, pushed = scan.split("PartitionFilters: [")[1].split("]")[0], scan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert f"bucket#" in partitions and f" = {bucket})" in partitions or f"IN ({bucket})" in partitions
    assert "EqualTo(term,cat)" in pushed or "In(term, [cat])" in pushed


def test_inflected_words_meet(spark, index):
    index.add(frame(spark, {1: "Pembelajaran mesin", 2: "mempelajari bukunya", 3: "buku", 4: None}))
    assert [r.id for r in index.search("belajar buku").collect()] == [2]
    assert sorted(r.id for r in index.search("pelajar", k=None).collect()) == [1, 2]


def test_tasks_are_bounded(spark, index, monkeypatch):
    """More text is more tasks, in a batch and in ``compact``: no bucket is one task's whatever its size."""
    from scholarlens.operators import fulltext

    monkeypatch.setattr(fulltext, "TEXT", 300, raising=False)
    monkeypatch.setattr(fulltext, "POSTS", 100, raising=False)
    docs = texts(80)
    index.add(frame(spark, docs))
    bucket = index.terms("cat")["cat"]
    parts = lambda: sum(f"/bucket={bucket}/" in f for f in index.postings({"cat": bucket}).inputFiles())
    assert parts() > 2 * index.files
    index.compact()
    assert parts() > 2 * index.files
    agree(index.search("cat dog", k=None), brute(docs, ["cat", "dog"], True))
