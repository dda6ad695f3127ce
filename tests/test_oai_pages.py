"""Harvests by resumption tokens: pages that arrive later, runs that fail, tokens that need escaping or never end."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from scholarlens.sources import oai, oai_pages
from scholarlens.streaming import ingest


class Harvest:
    def __init__(self, spark, root):
        self.spark, self.root, self.fails = spark, root, False

    def land(self, token, ids, following, pad=0):
        folder = self.root / "in" / f"token={quote(token, safe='')}"
        folder.mkdir(parents=True)
        rows = "".join(f"<record><header><identifier>oai:x:{i}</identifier></header><metadata><oai_dc:dc xmlns:oai_dc='a' xmlns:dc='b'><dc:title>T{i} &amp; é</dc:title></oai_dc:dc></metadata></record>" for i in ids)
        end = "" if following is None else f"<resumptionToken cursor='0'>{following}</resumptionToken>"
        (folder / "page.xml").write_text(f"<OAI-PMH xmlns='http://www.openarchives.org/OAI/2.0/'><ListRecords>{rows}{end}</ListRecords></OAI-PMH>{' ' * pad}")

    def run(self):
        def each(batch, number):
            batch.write.mode("overwrite").parquet(str(self.root / "out" / f"batch={number}"))
            if self.fails:
                raise RuntimeError("lost")

        ingest.caught_up(oai_pages.read_stream(self.spark, str(self.root / "in"), 2), str(self.root / "state"), each, plans_ahead=False)
        return self.ids()

    def ids(self):
        rows = oai.records(self.spark.read.parquet(str(self.root / "out")))
        return sorted((int(r.url.split("/")[-2]), r.title) for r in rows.select("url", "title").collect())


@pytest.fixture
def harvest(spark, tmp_path):
    return Harvest(spark, tmp_path)


def want(n):
    return [(i, f"T{i} & é") for i in range(n)]


def test_goes_on_where_it_was(harvest):
    """Pages that have not arrived are waited for; every record comes once; the tail of a page may be long."""
    harvest.land("first", [0, 1], "a/b &amp; ü")
    assert harvest.run() == want(2) == harvest.run()
    harvest.land("later", [9], None)  # nothing names it yet
    assert harvest.run() == want(2)
    for k, (token, following) in enumerate([("a/b & ü", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "")]):
        harvest.land(token, [2 + k], following, pad=200_000 if token == "d" else 0)
    assert harvest.run() == want(7) == harvest.run()
    assert len(list((harvest.root / "out").glob("batch=*"))) == 2


def test_a_run_that_fails_is_repeated(harvest):
    harvest.land("first", [0], "b")
    assert harvest.run() == want(1)
    harvest.land("b", [1, 2], "c")
    harvest.fails = True
    with pytest.raises(Exception, match="lost"):
        harvest.run()
    harvest.land("c", [3], None)
    harvest.fails = False
    assert harvest.run() == want(4)


def test_no_page_and_empty_pages(harvest):
    (harvest.root / "in").mkdir()
    (harvest.root / "out").mkdir()
    rows = oai_pages.read_stream(harvest.spark, str(harvest.root / "in"))
    assert rows.columns == ["token", "place", "header", "metadata"]
    ingest.caught_up(rows, str(harvest.root / "state"), lambda batch, number: batch.write.parquet(str(harvest.root / "out" / f"batch={number}")), plans_ahead=False)
    harvest.land("first", [], "b")
    harvest.land("b", [0], None)
    assert harvest.run() == want(1)


def test_tokens_that_come_back(harvest):
    harvest.land("first", [0], "b")
    harvest.land("b", [1], "first")
    with pytest.raises(Exception, match="comes back"):
        harvest.run()


def test_places_in_a_page(spark, harvest):
    harvest.land("first", [5, 3, 4], None)
    harvest.run()
    rows = spark.read.parquet(str(harvest.root / "out"))
    assert [r.id for r in rows.orderBy("place").select(F.col("header.identifier").alias("id")).collect()] == ["oai:x:5", "oai:x:3", "oai:x:4"]
