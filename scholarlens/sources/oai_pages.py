"""Pages of a harvest that follow one another by resumption tokens, as a streaming source of records.

A page is landed as a file in a folder ``token=...`` named by the token that asks for it (escaped like a partition), the first one by ``first``;
its resumption token names the next. The offset of a stream is the token still to be asked for, so a harvest that was
interrupted, or whose next page has not arrived, goes on there, and each record is read once. Pages are read by tasks,
some at a time; the driver looks only at their ends, for the tokens.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from . import oai

#: The first page's name, the last page's token, pages that a task reads, and bytes of a page in which its token is looked for first.
FIRST, END, PAGES_PER_TASK, TAIL = "first", "", 16, 1 << 16
_TOKEN = re.compile(rb"<(?:\w+:)?resumptionToken\b[^>]*?(?:/>|>([^<]*)</)")


class Landed:
    """The landed pages of a folder, on any file system that pyarrow knows."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.files, root = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        self.root, self.folders = root.rstrip("/"), {}

    def _listed(self, folder: str) -> list:
        from pyarrow import fs

        return self.files.get_file_info(fs.FileSelector(folder, allow_not_found=True))

    def file(self, token: str) -> str | None:
        """The page of a token; None if it has not arrived."""
        if token not in self.folders:
            self.folders = {unquote(f.base_name[6:]): f.path for f in self._listed(self.root) if f.base_name.startswith("token=")}
        held = self._listed(self.folders[token]) if token in self.folders else []
        return min((f.path for f in held if f.is_file and f.base_name[0] not in "._"), default=None)

    def read(self, name: str) -> bytes:
        with self.files.open_input_stream(name, compression=None) as page:
            return page.read()

    def next(self, name: str) -> str:
        """The token of the page that follows a page; END if none does."""
        with self.files.open_input_file(name) as page:
            size = page.size()
            page.seek(max(0, size - TAIL))
            found = _TOKEN.findall(page.read())
            if not found and size > TAIL:
                page.seek(0)
                found = _TOKEN.findall(page.read())
        return html.unescape(found[-1].decode()).strip() if found else END


class Pages(InputPartition):
    """(token, file) of some pages."""

    def __init__(self, pages: list[tuple[str, str]]):
        super().__init__(pages)


class Reader(DataSourceStreamReader):
    def __init__(self, path: str, pages_per_task: int):
        self.path, self.pages_per_task = path, pages_per_task
        self.chain, self.names = [FIRST], []  # tokens in order, of which the last is still to be asked for, and their pages

    def initialOffset(self) -> dict:
        return {"token": FIRST, "page": 0}

    def _follow(self) -> None:
        landed = Landed(self.path)
        known = set(self.chain)
        while self.chain[-1] != END and (name := landed.file(self.chain[-1])) is not None:
            token = landed.next(name)
            if token != END and token in known:
                raise ValueError(f"resumption token {token!r} comes back: the harvest would not end")
            self.names.append(name)
            self.chain.append(token)
            known.add(token)

    def latestOffset(self) -> dict:
        self._follow()
        return {"token": self.chain[-1], "page": len(self.chain) - 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if len(self.chain) <= end["page"]:  # a batch that runs again in a new process
            self._follow()
        if self.chain[start["page"]] != start["token"]:
            raise ValueError(f"page {start['page']} was {start['token']!r} and is {self.chain[start['page']]!r}: another harvest was landed here")
        places = range(start["page"], end["page"], self.pages_per_task)
        return [Pages([(self.chain[i], self.names[i]) for i in range(k, min(k + self.pages_per_task, end["page"]))]) for k in places]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        landed = Landed(self.path)
        for token, name in partition.value:
            page = ElementTree.fromstring(landed.read(name))
            for place, record in enumerate(page.iterfind(".//{*}record")):
                yield token, place, ElementTree.tostring(record, encoding="unicode")


class OaiPages(DataSource):
    """``spark.readStream.format("oai_pages").load(folder)``: token, place, record (XML) of every record."""

    @classmethod
    def name(cls) -> str:
        return "oai_pages"

    def schema(self) -> str:
        return "token string, place int, record string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Reader(self.options["path"], int(self.options.get("pagesPerTask", PAGES_PER_TASK)))


def read_stream(spark: SparkSession, folder: str, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """Raw records, as ``oai.read`` has them, with the token of their page and their place in it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the source's own processes need not import this library
    spark.dataSource.register(OaiPages)
    rows = spark.readStream.format("oai_pages").option("pagesPerTask", pages_per_task).load(folder)
    parsed = F.from_xml("record", oai.RECORD, {"ignoreNamespace": "true"})
    return rows.select("token", "place", parsed.alias("r")).select("token", "place", "r.*")
