"""The transformation against a version that slices Python strings."""

import hashlib
import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from scholarlens.llm import fim, registry

from .helpers import documents, messy

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(text), "plain", None, None, sha(text), sha(text))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc_id, len(text), form, a, b - a, sha(out), sha(text))


def rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def digests(spark, docs):
    from pyspark.sql import functions as F

    out = fim.transformed(docs)
    back = fim.restored(F.col("text"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("text", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def test_rows(spark):
    """Nulls, empty and long texts, marks, parts of marks, repeated rows and ids, no id, other columns."""
    rng = random.Random(1)
    odd = ["<P>", "a<S>b", "<M", "<<P", "S>", "<P <S <M", "é", "日本" * 40, "🎉a" * 30, "<" * 50, "a\x00b\n" * 9, "".join(rng.choice("aé日🎉<PSM>") for _ in range(3000))]
    texts = [*messy(), *odd * 12]
    texts += ["x" * 5_000_000 + "é日🎉" * 400_000]
    ids = [*range(len(texts) - 3), 1, None, 9**15]
    got = rows(digests(spark, documents(spark, texts, ids).repartition(3)))
    assert got == sorted((brute(i, t) for i, t in zip(ids, texts, strict=True)), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert rows(registry.QUERIES["op11_fim"](spark, sf_dir)) == sorted((brute(r.doc_id, r.text) for r in docs), key=str)


def test_empty_table_and_parameters(spark):
    docs = documents(spark, ["some text", "other"])
    assert fim.transformed(docs.limit(0)).count() == 0
    assert {r.form for r in fim.transformed(docs, plain=100).collect()} == {"plain"}
    assert {r.form for r in fim.transformed(docs, plain=0, spm=100).collect()} == {"spm"}


@given(st.lists(st.text(st.sampled_from("ab é日🎉\n"), max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_runs_find_every_byte(texts):
    runs = fim.Runs(pa.array(texts, pa.string()))
    at = 0
    for d, t in enumerate(texts):
        for k in range(len(t) + 1):
            assert runs.bytes_at(runs.first[d : d + 1] + k).tolist() == [at + len(t[:k].encode())]
        at += len(t.encode())
    assert (runs.width[1:] != runs.width[:-1]).all() or len(texts) > 1  # runs are maximal
