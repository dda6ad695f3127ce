"""Fields of landed HTML pages, by a tolerant parser in Arrow batches: pages are not well-formed XML."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarlens.functions import constants as k

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass
class Node:
    tag: str
    attrs: dict
    parent: Node | None = None
    parts: list = field(default_factory=list)

    def strings(self) -> list[str]:
        return [s for p in self.parts for s in ([p] if isinstance(p, str) else p.strings())]

    def text(self, stripped: bool = True) -> str:
        """With ``stripped`` the pieces are stripped and joined without anything between."""
        return "".join(s.strip() for s in self.strings()) if stripped else "".join(self.strings())

    def string(self) -> str | None:
        """The text of an element with that one child, however deep."""
        if len(self.parts) != 1:
            return None
        return self.parts[0] if isinstance(self.parts[0], str) else self.parts[0].string()


class Page(HTMLParser):
    def __init__(self, text: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {})
        self.nodes: list[Node] = []
        self.feed(text)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("p", "tr", "td", "th", "li"):
            open_ = self.at
            while open_ is not None and open_.tag not in (tag, "table", "div", "body"):
                open_ = open_.parent
            if open_ is not None and open_.tag == tag:
                self.at = open_.parent
        node = Node(tag, {a: v or "" for a, v in attrs}, self.at)
        self.at.parts.append(node)
        self.nodes.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        open_ = self.at
        while open_ is not None and open_.tag != tag:
            open_ = open_.parent
        if open_ is not None and open_.parent is not None:
            self.at = open_.parent

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.nodes if n.tag in tags]


def _first(nodes) -> Node | None:
    return next(iter(nodes), None)


def abstract(page: Page) -> str:
    for tag, word in (("h2", "abstract"), ("h3", "abstract"), ("h2", "abstrak"), ("h3", "abstrak")):
        head = _first(n for n in page.all(tag) if word in (n.string() or "").lower())
        if head is not None:
            after = page.nodes[page.nodes.index(head) + 1 :]
            if (p := _first(n for n in after if n.tag == "p")) is not None:
                return p.text()
    marked = _first(n for n in page.nodes if "abstract" in n.attrs.get("class", "").lower())
    if marked is None:
        divs = page.all("div")
        marked = _first(n for n in divs if n.attrs.get("id") == "abstract") or _first(n for n in divs if "ep_summary_content_main" in n.attrs.get("class", "").split())
    return marked.text() if marked is not None else ""


def supervisors(page: Page) -> list[str]:
    """At most two: values of metadata (repeated ones too), then of table rows whose label names a supervisor."""
    found = [n.attrs["content"].strip() for n in page.all("meta") if re.search("citation_advisor|supervisor", n.attrs.get("name", ""), re.I) and n.attrs.get("content")]
    for cells in _rows(page):
        if len(cells) >= 2 and any(w in cells[0].text().lower() for w in k.SUPERVISOR_WORDS):
            value = cells[1].text()
            if value and value not in found:
                found.append(value)
    return found[:2]


def _rows(page: Page) -> list[list[Node]]:
    """The cells of each table row, in one pass: a cell belongs to every row that it stands in."""
    rows: dict[int, list[Node]] = {id(n): [] for n in page.all("tr")}
    for cell in page.all("th", "td"):
        up = cell.parent
        while up is not None:
            if id(up) in rows:
                rows[id(up)].append(cell)
            up = up.parent
    return list(rows.values())


def fields(text: str | None, base: str = k.BASE_URL) -> dict:
    """title, author, year, abstract, supervisors, dept, degree, pdf_url of a record's page."""
    page = Page(text or "")
    head = _first(page.all("h1")) or _first(page.all("title"))
    meta = {n.attrs.get("name"): n.attrs.get("content") for n in reversed(page.all("meta"))}
    author = meta.get("citation_author")
    if "citation_author" not in meta:
        lines = (re.match(r"^([A-Za-z\s,']+)\s*\(\d{4}\)", n.text(False)) for n in page.all("p"))
        author = next((m[1].strip() for m in lines if m), None)
    year = re.search(r"\d{4}", meta.get("citation_date") or "")
    if year is None:
        in_text = re.search(r"\((\d{4})\)", page.root.text(False))
        year = in_text and in_text[1]
    else:
        year = year.group()
    links = [n for n in page.all("a") if "href" in n.attrs]
    named = (n.text() for n in links if "/view/divisions/" in n.attrs["href"])
    of_degree = _first(n.text() for n in links if re.search(r"S[123]|Undergraduate|Master|Doctoral", n.attrs["href"]))
    pdf = _first(n.attrs["href"] for n in links if re.search(r"\.pdf$", n.attrs["href"], re.I))
    degree = next((d for d, words in (("S1", ("S1", "Undergraduate")), ("S2", ("S2", "Master")), ("S3", ("S3", "Doctoral"))) if any(w in (of_degree or "") for w in words)), "")
    return {
        "title": re.sub(k.TITLE_SUFFIX, "", head.text()) if head is not None else None,
        "author": author or "Unknown",
        "year": int(year) if year else None,
        "abstract": abstract(page),
        "supervisors": supervisors(page),
        "dept": next((t for t in named if any(w in t.lower() for w in k.PAGE_DEPT_WORDS)), ""),
        "degree": degree,
        "pdf_url": urljoin(base, pdf) if pdf else None,
    }


_TYPES = {"year": T.IntegerType(), "supervisors": T.ArrayType(T.StringType())}
_NAMES = ["title", "author", "year", "abstract", "supervisors", "dept", "degree", "pdf_url"]
FIELDS = T.StructType([T.StructField(n, _TYPES.get(n, T.StringType())) for n in _NAMES])


@F.pandas_udf(FIELDS)
def page_fields(pages: pd.Series) -> pd.DataFrame:
    frame = pd.DataFrame([fields(p) for p in pages], columns=_NAMES)
    frame["year"] = frame["year"].astype("Int32")
    return frame


def _hrefs(page: Column) -> Column:
    return F.regexp_extract_all(page, F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)"), F.lit(1))


def year_pages(page: Column, base: Column, most: int = 50) -> Column:
    """Links of a division's page to its year pages, each once in order, the first ``most``."""
    links = F.filter(_hrefs(page), lambda h: F.regexp_like(h, F.lit(r"\d{4}\.html$")))
    whole = F.transform(links, lambda h: F.when(F.startswith(h, F.lit("http")), h).otherwise(F.concat(base, h)))
    return F.slice(F.array_distinct(whole), 1, most)


def record_links(page: Column, base: str = k.BASE_URL) -> Column:
    """Absolute links of a year page to records; a link that repeats is kept."""
    links = F.filter(_hrefs(page), lambda h: F.regexp_like(h, F.lit(k.RECORD_LINK)))
    return F.transform(links, lambda h: F.when(F.startswith(h, F.lit("http")), h).otherwise(F.concat(F.lit(base), h)))


_CARD = r"(?is)/authors/profile/(\d+)[^>]*>([^<]*)<((?:(?!/authors/profile/).)*)"


def author_cards(page: Column) -> Column:
    """struct(sinta_id, name, dept) of the cards of an author list; dept is the link to a department after the name."""
    part = lambda n: F.regexp_extract_all(page, F.lit(_CARD), F.lit(n))
    cards = F.arrays_zip(part(1).alias("sinta_id"), part(2).alias("name"), part(3).alias("rest"))
    dept = lambda c: F.nullif(F.trim(F.regexp_extract(c["rest"], r"(?is)/departments/profile/[^>]*>([^<]*)<", 1)), F.lit(""))
    return F.transform(cards, lambda c: F.struct(c["sinta_id"].alias("sinta_id"), F.trim(c["name"]).alias("name"), dept(c).alias("dept")))


def page_count(page: Column) -> Column:
    return F.coalesce(F.regexp_extract(page, r"(?i)Page\s+\d+\s+of\s+(\d+)", 1).try_cast("int"), F.lit(1))
