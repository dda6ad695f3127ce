import json

import pytest
from pyspark.sql import functions as F

from scholarlens.sources import bibtex, files, html, oai
from scholarlens.streaming import ingest

PAGE = """<html><head><title>x - ITS Repository</title><meta name="citation_date" content="2019/05"><meta name="citation_advisor" content=" Dr. Ana ">
<meta name="DC.supervisor" content="Dr. Ana"></head><body><h1>A <b>study</b> - ITS Repository</h1><p>Budi, Carl (2018) A study<br>more
<h2>Abstract</h2><div><p>First <i>part</i> of it.</p></div>
<table><tr><td>Pembimbing</td><td>Dr. Eka</td></tr></table>
<a href="/view/divisions/x.html">Fakultas Teknik</a><a href="/view/S2/">S2 Thesis</a><a href="/1/a.PDF">pdf</a></body></html>"""


def test_html_fields(spark):
    got = html.fields(PAGE)
    assert got == {"title": "Astudy", "author": "Budi, Carl", "year": 2019, "abstract": "Firstpartof it.", "supervisors": ["Dr. Ana", "Dr. Ana"], "dept": "Fakultas Teknik", "degree": "S2", "pdf_url": "https://repository.its.ac.id/1/a.PDF"}
    row = spark.createDataFrame([(PAGE,), (None,)], "h string").select(F.inline(F.array(html.page_fields("h")))).collect()
    assert row[0].title == "Astudy" and row[1].title is None and row[1].year is None and row[1].supervisors == []


def test_html_fallbacks():
    assert html.fields("<div class='My-Abstract'>text</div>")["abstract"] == "text"
    assert html.fields("<div id=abstract>t<b>u</b></div>")["abstract"] == "tu"
    assert html.fields("<p>nothing (2001)")["year"] == 2001
    assert html.fields("<table><tr><th>Advisor:</th><td>A</td><tr><td>Supervisor</td><td>B</td></table>")["supervisors"] == ["A", "B"]


def test_links(spark):
    page = '<a href="2019.html">x</a><a href="2019.html">y</a><a href="/111537/">r</a><a href="/111537/">r</a> Page 1 of 3 <a href="/authors/profile/12">Ana </a><a href="/departments/profile/3"> Physics</a><a href="/authors/profile/13">Budi</a>'
    df = spark.createDataFrame([(page,)], "h string")
    r = df.select(html.year_pages(F.col("h"), F.lit("http://x/")).alias("y"), html.record_links(F.col("h")).alias("r"), html.page_count(F.col("h")).alias("n"), html.author_cards(F.col("h")).alias("a")).first()
    assert r.y == ["http://x/2019.html"] and len(r.r) == 2 and r.n == 3 and [tuple(x) for x in r.a] == [("12", "Ana", "Physics"), ("13", "Budi", None)]


def test_oai(spark, tmp_path):
    record = lambda head, dc: f'<record><header{head}><identifier>oai:x:12</identifier><datestamp>2023-05</datestamp></header>{dc}</record>'
    dc = "<metadata><oai_dc:dc xmlns:oai_dc='a' xmlns:dc='b'><dc:title>T</dc:title><dc:date>none</dc:date><dc:date>2023-05</dc:date><dc:subject>Math</dc:subject><dc:subject>Fakultas X</dc:subject><dc:type>Master Thesis</dc:type></oai_dc:dc></metadata>"
    (tmp_path / "p.xml").write_text(f"<OAI-PMH><ListRecords>{record('', dc)}{record(' status=\"deleted\"', dc)}{record('', '')}</ListRecords></OAI-PMH>")
    (r,) = oai.records(oai.read(spark, str(tmp_path))).collect()
    assert (r.title, r.author, r.year, r.degree, r.dept, r.url) == ("T", "Unknown", 2023, "S2", "Fakultas X", "https://repository.its.ac.id/12/")
    assert json.loads(r.metadata) == {"oai_identifier": "oai:x:12", "oai_datestamp": "2023-05", "subjects": ["Math", "Fakultas X"]}
    assert oai.since(oai.read(spark, str(tmp_path)), "2024").count() == 0


def test_bibtex(spark, tmp_path):
    (tmp_path / "a.bib").write_text("@misc{x,\n  advisor = {Dr. Ana Budi and NIP 12},\n  editor={Carl Dewi}\n}")
    got = bibtex.read(spark, str(tmp_path)).select(bibtex.supervisors(F.col("value")).alias("s")).first().s
    assert got == ["Carl Dewi", "Dr. Ana Budi"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', "x\ny", "l1\nl2", ["A", "B"], "S1", 2019, None, "u", 0.5)], "title string, author string, abstract string, supervisors array<string>, degree string, year int, dept string, url string, data_confidence double")
    files.append_csv(df, str(tmp_path / "c"))
    files.append_csv(df, str(tmp_path / "c"))
    got = files.read_csv(spark, str(tmp_path / "c")).collect()
    assert len(got) == 2 and (got[0].title, got[0].abstract, got[0].supervisors, got[0].year) == ('a "q", b', "l1\nl2", "A; B", "2019")


def test_checkpoints(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n "total_processed": 2, "other": 1,\n "processed_urls": ["a", "b", "a"]\n}')
    state = files.read_checkpoint(spark, str(tmp_path / "c.json"))
    assert state.first().total_processed == 2 and files.processed(state).count() == 2
    (tmp_path / "broken").write_text('{"processed_sinta_ids": [\n "1",\n "2"\n], "x": ["3"')
    assert sorted(r.sinta_id for r in files.repaired_ids(spark, str(tmp_path / "broken")).collect()) == ["1", "2"]


def test_stream_takes_each_row_once(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    a = spark.range(10).withColumn("v", F.lit("x"))
    a.write.parquet(source)
    assert ingest.ingest_parquet(spark, source, a.schema, sink, state).count() == 10
    a.where("id < 3").write.mode("append").parquet(source)
    again = ingest.ingest_parquet(spark, source, a.schema, sink, state, lambda df: df)
    assert again.count() == 13
    assert ingest.ingest_parquet(spark, source, a.schema, sink, state).count() == 13


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from scholarlens.sources import tables

    def session(master, conf=None, checkpoint=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: conf), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))

    assert tables.shared_folder(session("yarn", "/x/")) == "/x" and tables.shared_folder(session("yarn", None, "hdfs:/y")) == "hdfs:/y"
    assert tables.shared_folder(session("local[2]")) == tables.shared_folder(session("local"))
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            tables.shared_folder(session(master))
