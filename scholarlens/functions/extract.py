"""Heuristic extraction as native columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as k
from .literals import required
from .text import fix_encoding, strip, strip_tags, upper_each, whitespace


def _one_line(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def clean_name(c: Column, source: str) -> Column:
    """A name without ids, role words and marks at its ends; empty if ``source`` does not accept it.

    ``abstract`` accepts anything, ``anywhere`` 5 to 80 characters with a capital, ``pdf`` the same with the capital
    (or a title) first.
    """
    c = strip(whitespace(fix_encoding(strip_tags(c)))) if source == "abstract" else _one_line(c)
    for pattern in k.NAME_NOISE[source]:
        c = F.regexp_replace(c, pattern, "")
    c = strip(c)
    if source == "abstract":
        return c
    capital = r"\p{Lu}" if source == "anywhere" else r"^(?:\p{Lu}|Dr|Prof|Ir)"
    return F.when(F.length(c).between(5, 80) & F.regexp_like(c, F.lit(capital)), c).otherwise("")


def distinct_names(names: Column, longer_than: int, most: int = 2) -> Column:
    """The first ``most`` names, each once whatever its case."""
    empty = F.array().cast("array<string>")
    same = lambda held, x: F.exists(held, lambda y: F.lower(y) == F.lower(x))
    kept = F.filter(names, lambda x: F.length(x) > longer_than)
    return F.slice(F.aggregate(kept, empty, lambda held, x: F.when(same(held, x), held).otherwise(F.array_append(held, x))), 1, most)


def _once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _matches(c: Column, patterns: list[str]) -> Column:
    """What each pattern finds, in the order of the patterns.

    A pattern runs only over texts with one of the words that its matches must have (``literals.required``): most texts
    are searched for a few words, and by no pattern.
    """
    empty = F.array().cast("array<string>")

    def found(t: Column) -> Column:
        out = []
        for p in patterns:
            hit = F.regexp_extract_all(t["text"], F.lit(p), F.lit(1))
            if words := sorted(required(p)):
                hit = F.when(reduce(Column.__or__, [F.contains(t["low"], F.lit(w)) for w in words]), hit).otherwise(empty)
            out.append(hit)
        return F.flatten(F.array(*out))

    return _once(c, lambda text: _once(F.struct(text.alias("text"), F.lower(text).alias("low")), found))


def supervisors(c: Column, limit: int = 500) -> Column:
    """At most two names from the first ``limit`` characters of a cleaned abstract."""
    found = _matches(F.substring(F.coalesce(c, F.lit("")), 1, limit), k.ABSTRACT_SUPERVISORS)
    return distinct_names(F.transform(found, lambda x: clean_name(x, "abstract")), 3)


def supervisors_anywhere(title: Column, abstract: Column) -> Column:
    text = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(abstract, F.lit("")))
    return distinct_names(F.transform(_matches(text, k.ANYWHERE_SUPERVISORS), lambda x: clean_name(x, "anywhere")), 0)


def supervisors_pdf(text: Column) -> Column:
    """From the text of a PDF's first pages, which another tool has extracted."""
    found = _matches(F.coalesce(text, F.lit("")), k.PDF_SUPERVISORS)
    return distinct_names(F.transform(found, lambda x: clean_name(x, "pdf")), 0)


def degree(c: Column, each: bool = False) -> Column:
    """With ``each`` letters change case one for one, as in SQL (ß to ẞ); without it some become two (SS)."""
    low = F.lower(F.replace(strip(c), F.lit("İ"), F.lit("i")) if each else strip(c))
    out = upper_each(F.substring(c, 1, 5)) if each else F.substring(F.upper(c), 1, 5)
    for word, value in reversed(k.DEGREES):
        out = F.when(F.contains(low, F.lit(word)), value).otherwise(out)
    return F.when(F.coalesce(c, F.lit("")) == "", "").otherwise(out)


def degree_of_record(types: Column, subjects: Column) -> Column:
    none = F.array().cast("array<string>")
    low = F.lower(F.array_join(F.concat(F.coalesce(types, none), F.coalesce(subjects, none)), " "))
    out = F.lit("")
    for value, words in reversed(k.RECORD_DEGREES):
        hit = F.contains(low, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(low, F.lit(word))
        out = F.when(hit, value).otherwise(out)
    return out


def dept_of_record(subjects: Column) -> Column:
    hit = F.filter(subjects, lambda s: F.regexp_like(F.lower(s), F.lit("|".join(k.DEPT_WORDS))))
    return F.coalesce(F.get(hit, F.lit(0)), F.lit(""))


def year(c: Column) -> Column:
    """The first four digits of a string."""
    return F.regexp_extract(c, r"\d{4}", 0).try_cast("int")


def first_year(dates: Column) -> Column:
    found = F.filter(F.transform(dates, lambda d: F.regexp_extract(d, r"\d{4}", 0)), lambda x: x != "")
    return F.get(found, F.lit(0)).try_cast("int")


def item_year(c: Column) -> Column:
    return F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1).try_cast("int")


def eprint_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, k.EPRINT_ID, 1), F.lit(""))


def nidn(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"NIDN\s*:\s*(\d{10})", 1), F.lit(""))


def h_index(body: Column, scopus_cell: Column | None = None, scholar_cell: Column | None = None) -> Column:
    """struct(scopus, gscholar): numbers of the first line on the h-index that has any, else the cells, else 0."""
    lines = F.filter(F.split(body, "\n"), lambda x: F.regexp_like(F.lower(x), F.lit("h-index|h index")))
    numbers = F.transform(lines, lambda x: F.filter(F.transform(F.split(x, r"\t+|\s{2,}"), strip), lambda y: F.regexp_like(y, F.lit("^[0-9]+$"))))
    found = F.get(F.filter(numbers, lambda x: F.size(x) > 0), F.lit(0))
    first, second = F.get(found, F.lit(0)).cast("int"), F.get(found, F.lit(1)).cast("int")
    number = lambda c: F.lit(None).cast("int") if c is None else c.try_cast("int")
    zero = F.lit(0)
    return F.struct(F.coalesce(first, number(scopus_cell), zero).alias("scopus"), F.coalesce(second, first, number(scholar_cell), zero).alias("gscholar"))


def tags(links: Column) -> Column:
    """Distinct trimmed texts of more than two characters, of the first ten links."""
    return F.array_distinct(F.filter(F.transform(F.slice(links, 1, k.TAGS_MAX), strip), lambda x: F.length(x) > 2))


def items(texts: Column, longer_than: int) -> Column:
    """struct(title, year) of the first twenty items whose title is long enough (10 researches, services; 5 others)."""
    kept = F.filter(F.transform(F.slice(texts, 1, k.ITEMS_MAX), strip), lambda x: F.length(x) > longer_than)
    return F.transform(kept, lambda x: F.struct(x.alias("title"), item_year(x).alias("year")))


def keyword_flags(c: Column, words: list[str] = k.ABSTRACT_FLAGS) -> Column:
    return _once(F.lower(c), lambda low: F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(low, w)))


def is_network_error(message: Column) -> Column:
    """Whether a failure means that the network is gone, so a harvest should pause; null is no failure."""
    hit = F.lit(False)
    for part in k.NETWORK_ERRORS:
        hit = hit | F.contains(message, F.lit(part))
    return F.coalesce(hit, F.lit(False))


def title_without_suffix(c: Column, suffix: str = k.TITLE_SUFFIX) -> Column:
    return F.regexp_replace(c, suffix, "")
