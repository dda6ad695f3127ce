import pytest
from pyspark.sql import functions as F

from scholarlens.__main__ import main
from scholarlens.operators import embedding, merge, stats
from scholarlens.sources import files, pdf, profiles

RECORD = """<record><header><identifier>oai:x:{i}</identifier><datestamp>2023-0{i}-01</datestamp></header><metadata><dc>
<title>Study {i} of graphs</title><creator>Ana</creator><date>202{i}</date><subject>Fakultas X</subject><type>Master Thesis</type>
<description>Supervisor: Dr. Carl Dewi
About graphs and more graphs, long enough to be read by the embedder {i}</description></dc></metadata></record>"""


def test_from_pages_to_search(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.xml").write_text("<r>" + "".join(RECORD.format(i=i) for i in range(1, 5)) + "</r>")
    last = lambda: capsys.readouterr().out.strip().splitlines()[-1]
    main(["ingest", str(tmp_path / "pages"), "--out", str(tmp_path / "r"), "--limit", "2"], spark)
    first = last()
    main(["ingest", str(tmp_path / "pages"), "--table", first, "--out", str(tmp_path / "r"), "--skip-existing", "--buffer", str(tmp_path / "csv")], spark)
    table = last()
    rows = spark.read.parquet(table)
    assert rows.count() == 4 and {r.degree for r in rows.collect()} == {"S2"} and {tuple(r.supervisors) for r in rows.collect()} == {("Dr. Carl Dewi",)}
    main(["embed", table, "--out", str(tmp_path / "e"), "--dim", "16"], spark)
    embedded = last()
    assert spark.read.parquet(embedded).where("size(embedding) = 16").count() == 4
    main(["profile", embedded, "--out", str(tmp_path / "l")], spark)
    people = last()
    main(["search", people, "graphs", "--threshold", "-1"], spark)
    assert "Dr. Carl Dewi" in capsys.readouterr().out
    main(["search-research", embedded, "Study 1 of graphs", "--threshold", "-1", "-k", "1"], spark)
    assert "similarity" in capsys.readouterr().out
    main(["stats", embedded, people], spark)
    assert "total_researches" in capsys.readouterr().out


def test_profiles(spark):
    page = ("7", "Ana", "", "H-Index\t3\t4\nNIDN : 0012345678", ["ai", "graphs", "graphs"], ["A research of 2019", "short"], None, ["patent 2020"], [])
    row = profiles.parse(spark.createDataFrame([page], profiles.PAGE)).first()
    assert (row.nidn, row.h_index_scopus, row.h_index_gscholar, row.expertise_tags) == ("0012345678", 3, 4, ["graphs"])
    assert [(x.title, x.year) for x in row.researches] == [("A research of 2019", 2019)] and row.iprs[0].year == 2020
    full = spark.createDataFrame([("7", "Ana", "", "D", None, 2, [("t", "scopus", 2020)], None, None, None, None, None, "2024-01-02T03:04:05")], profiles.PROFILE)
    new = profiles.lecturers(full)
    old = spark.createDataFrame([("7", "123")], "sinta_id string, nidn string")
    (r,) = merge.upsert_profiles(old, new).collect()
    assert (r.nidn, r.dept, r.h_index_scopus, r.sinta_books, r.sinta_publications[0].year) == ("123", "D", 0, [], 2020)
    assert full.select(profiles.sources_of(F.col("publications")).alias("s")).first().s == ["scopus"]
    done = spark.createDataFrame([("7",)], "sinta_id string")
    assert profiles.authors(full, done).count() == 0 and profiles.authors(full.union(full), done.limit(0)).count() == 1


def test_pdf_plug_in(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"supervisor: Ana")
    (tmp_path / "b.pdf").write_bytes(b"%")

    def plain(data, pages):
        if data == b"%":
            raise ValueError("empty")
        return data.decode()

    got = {r.path[-5:]: (r.text, r.error) for r in pdf.texts(pdf.read(spark, str(tmp_path)), plain).collect()}
    assert got == {"a.pdf": ("supervisor: Ana", None), "b.pdf": (None, "ValueError: empty")}


def test_observed(spark):
    df, seen = stats.observed(spark.range(10), even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_retrying():
    calls, waits = [], []

    def limited(texts):
        calls.append(texts)
        if len(calls) < 3:
            raise embedding.RateLimited
        return [[1.0]]

    assert embedding.retrying(limited, sleep=waits.append)(["x"]) == [[1.0]] and waits == [10.0, 20.0]
    with pytest.raises(ZeroDivisionError):
        embedding.retrying(lambda t: 1 / 0, sleep=waits.append)(["x"])


def test_enrich_recover_and_profiles(spark, tmp_path, capsys):
    last = lambda: capsys.readouterr().out.strip().splitlines()[-1]
    site = "https://repository.its.ac.id"
    rows = [(f"{site}/{i}/", f"t{i}", "Supervisor: Dr. Mira Nur Hadi" if i == 104 else "none", ["Had"] if i == 101 else None) for i in range(101, 106)]
    spark.createDataFrame(rows, "url string, title string, abstract string, supervisors array<string>").write.parquet(str(tmp_path / "r"))
    for folder, name, text in (("bib", "102.bib", "@misc{a, advisor={Dr. Ana Budi}}"), ("txt", "102.txt", "supervisor: Carl Dewi Lestari\n"), ("txt", "103.txt", "x\nsupervisor: Carl Dewi Lestari\n")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    main(["enrich", str(tmp_path / "r"), "--bibtex", str(tmp_path / "bib"), "--texts", str(tmp_path / "txt"), "--out", str(tmp_path / "v")], spark)
    enriched = last()
    main(["recover", enriched, "--out", str(tmp_path / "v")], spark)
    got = {int(r.url.split("/")[-2]): r.supervisors for r in spark.read.parquet(last()).collect()}
    assert got == {101: ["Had"], 102: ["Dr. Ana Budi"], 103: ["Carl Dewi Lestari"], 104: ["Dr. Mira Nur Hadi"], 105: None}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text("\n".join(f'{{"sinta_id": "{i}", "name": "P{i}", "publications": [{{"title": "A long enough title {i}", "source": "scopus", "year": 2020}}]}}' for i in range(3)))
    (tmp_path / "c.json").write_text('{"processed_sinta_ids": ["1"], "failed_sinta_ids": [{"sinta_id": "2", "error": "x"}, {"sinta_id": "9", "error": "y"}], "current_page": 4}')
    main(["harvest-profiles", str(tmp_path / "p"), "--out", str(tmp_path / "l"), "--checkpoint-file", str(tmp_path / "c.json"), "--retry-failed", "--dry-run"], spark)
    shown = capsys.readouterr().out
    assert "P2" in shown and "P0" not in shown and not (tmp_path / "l").exists()
    main(["harvest-profiles", str(tmp_path / "p"), "--out", str(tmp_path / "l"), "--checkpoint-file", str(tmp_path / "c.json"), "--resume"], spark)
    people = last()
    (state,) = files.read_checkpoint(spark, str(tmp_path / "c.json"), files.PROFILE).collect()
    assert state.processed_sinta_ids == ["0", "1", "2"] and [f.sinta_id for f in state.failed_sinta_ids] == ["9"] and (state.total_scraped, state.total_failed, state.current_page) == (3, 1, 4)
    main(["embed-profiles", people, "--out", str(tmp_path / "l"), "--dim", "8", "--batch-size", "2"], spark)
    assert {r.sinta_id: len(r.expertise_vector) for r in spark.read.parquet(last()).collect()} == {"0": 8, "2": 8}


def test_divisions_and_resume(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    record = RECORD.replace("</datestamp>", "</datestamp><setSpec>{s}</setSpec>")
    (tmp_path / "pages" / "p.xml").write_text("<r>" + "".join(record.format(i=i, s=s) for i, s in ((1, "a:b"), (2, "a"), (3, "ab"))) + "</r>")
    main(["ingest", str(tmp_path / "pages"), "--out", str(tmp_path / "r"), "--list-divisions"], spark)
    assert "a:b" in capsys.readouterr().out
    (tmp_path / "c.json").write_text('{"processed_urls": ["https://repository.its.ac.id/2/"]}')
    main(["ingest", str(tmp_path / "pages"), "--out", str(tmp_path / "r"), "--division", "a", "--checkpoint-file", str(tmp_path / "c.json"), "--resume"], spark)
    assert [r.title for r in spark.read.parquet(capsys.readouterr().out.strip().splitlines()[-1]).collect()] == ["Study 1 of graphs"]
