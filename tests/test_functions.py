import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scholarlens.functions import extract, quality, text


def one(spark, column, **values):
    """The value of ``column`` on a row of string values."""
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("given_, want", [("a&nbsp;b", "a b"), ("&lt;b&gt;x", "x"), ("<script>1</script>y", "y"), (None, ""), ("", ""), ("a\n\n\n\nb  c\t d ", "a\n\nb c d"), ("ﬁx", "fix"), ("&amp;lt;", "&lt;")])
def test_clean_text(given_, want):
    assert text.clean(given_) == want


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_clean_text_leaves_no_controls(t):
    import unicodedata

    assert not [c for c in text.clean(t) if unicodedata.category(c) == "Cc" and c not in "\n\t\r"]


@pytest.mark.parametrize("given_, want", [('â€"', '""'), ("â€™", "'"), ("cafÃ©", "café"), ("a\x07b\nc", "ab\nc"), ("�x", "x")])
def test_fix_encoding(spark, given_, want):
    assert one(spark, text.fix_encoding(F.col("c")), c=given_) == want


@pytest.mark.parametrize("given_, want", [("Abstract: foo", "foo"), ("abstraction is key", "ion is key"), ("This thesis is submitted to x", "x"), (None, "")])
def test_clean_abstract(spark, given_, want):
    assert one(spark, text.clean_abstract(F.col("c")), c=given_) == want


@pytest.mark.parametrize(
    "given_, want",
    [
        ("Pembimbing I : Dr. A, M.T.", ["Dr. A"]),
        ("co-advisor: Dr. Y, M.T.", ["Dr. Y"]),
        ("Supervisor: ABC\nAdvisor: Dr. Long", ["Dr. Long"]),
        ("Supervisor: Ana B\nAdvisor: ANA B\nCo-advisor: Carl D\nAdvisor 2: Eka F", ["Ana B", "Carl D"]),
        ("x" * 500 + "Supervisor: Ana Budi", []),
        ("", []),
        (None, []),
    ],
)
def test_supervisors(spark, given_, want):
    assert one(spark, extract.supervisors(F.col("c")), c=given_) == want


def test_other_supervisors(spark):
    low = "supervisor: john lowercase name"
    assert one(spark, extract.supervisors_anywhere(F.lit(""), F.col("c")), c=low) == []
    assert one(spark, extract.supervisors_pdf(F.col("c")), c=low) == []
    assert one(spark, extract.supervisors_pdf(F.col("c")), c="Prof. Carl Dewi Lestari NIP: 196512121990021002") == ["Prof. Carl Dewi Lestari"]
    assert one(spark, extract.supervisors_anywhere(F.col("c"), F.lit(None).cast("string")), c="Dibimbing oleh Prof. Indra Jaya") == ["Prof. Indra Jaya"]


@pytest.mark.parametrize("given_, want", [("Pascasarjana", "S1"), ("Master of X", "S2"), ("PhD", "S3"), ("Diploma", "D3"), ("Postgraduate", "POSTG"), ("", ""), (None, "")])
def test_degree(spark, given_, want):
    assert one(spark, extract.degree(F.col("c")), c=given_) == want


@pytest.mark.parametrize("given_, want", [("Master Thesis", "S2"), ("Thesis", "S1"), ("Article", "")])
def test_degree_of_record(spark, given_, want):
    assert one(spark, extract.degree_of_record(F.array("c"), F.lit(None).cast("array<string>")), c=given_) == want


@pytest.mark.parametrize("given_, want", [("H-Index\t34\t45", (34, 45)), ("H-Index\t34", (34, 34)), ("H-Index\tnone\nh index  7", (7, 7)), ("none", (0, 0))])
def test_h_index(spark, given_, want):
    assert tuple(one(spark, extract.h_index(F.col("c")), c=given_)) == want


def test_small_extractors(spark):
    assert one(spark, extract.eprint_id(F.col("c")), c="http://repository.its.ac.id/111537/1/x.pdf") == "111537"
    assert one(spark, extract.nidn(F.col("c")), c="NIDN : 0012345678") == "0012345678"
    assert one(spark, extract.item_year(F.col("c")), c="in 1899 and 2019") == 2019
    assert one(spark, extract.year(F.col("c")), c="none") is None
    assert one(spark, extract.tags(F.split("c", ",")), c="ab, abc ,abc,x,machine learning") == ["abc", "machine learning"]


@pytest.mark.parametrize("abstract, filled, want", [("x" * 500, 1, 0.57), ("", 3, 0.42), ("x" * 200, 4, 0.7)])
def test_confidence(spark, abstract, filled, want):
    fields = [F.lit(v if i < filled else "") for i, v in enumerate("abc")]
    year = F.lit(2000 if filled > 3 else None).cast("int")
    got = quality.confidence(fields[0], fields[1], F.col("c"), year, fields[2], F.lit(None).cast("array<string>"))
    assert one(spark, got, c=abstract) == want


def test_integrity(spark):
    assert one(spark, text.encoding_integrity(F.col("c")), c="�" + "a" * 99) == pytest.approx(0.9)
    assert one(spark, text.encoding_integrity_exact(F.col("c")), c="�" + "a" * 99) == pytest.approx(0.9)
    assert one(spark, text.encoding_integrity(F.col("c")), c="") == 1.0


def test_clean_record(spark):
    raw = spark.createDataFrame(
        [("<b>T</b>", "A", "Abstract: Supervisor: Ana Budi\n" + "y" * 600, "c. 2019", "Master", "D", " u ", [], "{}"), (None, None, None, None, None, None, None, None, None)],
        "title string, author string, abstract string, year string, degree string, dept string, url string, supervisors array<string>, metadata string",
    )
    a, b = quality.clean_record(raw).collect()
    assert (a.title, a.year, a.degree, a.url, a.supervisors, a.data_confidence) == ("T", 2019, "S2", "u", ["Ana Budi"], 0.9)
    assert (b.title, b.abstract, b.supervisors, b.year, b.data_confidence) == ("", "", None, None, 0.2)


def test_clean_record_query_takes_whole_texts(spark, tmp_path):
    from scholarlens.plans import registry

    whole = " ".join(f"w{k}" for k in range(60))
    spark.createDataFrame([(1, whole, "src1", "en")], "doc_id bigint, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert registry.clean_record(spark, str(tmp_path)).first().title == whole


def test_control_characters_are_category_cc():
    import unicodedata

    every = "".join(map(chr, range(0x3000)))
    assert text._CONTROL.sub("", every) == "".join(c for c in every if c in "\n\t\r" or unicodedata.category(c) != "Cc")


def test_required_words(spark):
    """Every match of a pattern has a required word, in any case; where no word is sure there is none."""
    import random
    import re

    from scholarlens.functions import constants as k
    from scholarlens.functions.literals import required

    assert required("(?i)co-?(?:advisor|supervisor)x") == {"advisor", "supervisor"}
    assert required("a+|b") == {"a", "b"} and required("a*b?") == set() and required("(?:ab|.)c") == {"c"} and required("(?:abc){2}") == {"abc"}
    rng = random.Random(2)
    parts = ["pembimbing", "Dosen ", "SUPERVISOR", "advisor", " utama", ": ", "Dr. Ana Budi", "co-", "supervised by ", "under the guidance of ", "dibimbing oleh ", "\n", " I", "NIP 1234567890123", "x", "Approved by", "Mengetahui:", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    found = 0
    for p in [*k.ABSTRACT_SUPERVISORS, *k.ANYWHERE_SUPERVISORS, *k.PDF_SUPERVISORS]:
        words, hits = required(p), [t for t in texts if re.search(p, t)]
        found += len(hits)
        assert words and all(any(w in t.lower() for w in words) for t in hits)
    assert found > 1000


@pytest.mark.parametrize("given_, each, want", [("straße", True, "STRAẞ"), ("weiß", True, "WEIẞ"), ("straße", False, "STRAS"), ("ŉǰ𐐨ab", True, "ŉǰ𐐀AB"), ("x DİPLOMA", True, "D3"), ("", True, "")])
def test_degree_by_letters(spark, given_, each, want):
    """As SQL has it, letters change case one for one."""
    assert one(spark, extract.degree(F.col("c"), each), c=given_) == want


def test_closed_entities(spark):
    """As SQL has it, an entity ends with its semicolon; a parser by itself takes a cut one too."""
    from scholarlens.sources import html

    cut = "<h1>a &amp; b&amp;amp &#38; &#x26; &copy; &amp</h1>"
    assert one(spark, text.clean_text(text.closed_entities(F.col("c"))), c=cut) == "a & b&amp & & © &amp"
    assert one(spark, html.page_fields(text.closed_entities(F.col("c"))), c=cut).title == "a & b&amp & & © &amp"
    assert one(spark, text.clean_text("c"), c=cut) == "a & b&amp & & © &"
