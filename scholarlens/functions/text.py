"""Text normalisation columns. Everything is native but ``clean_text``, which needs NFKC and HTML entities."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import ABSTRACT_PREFIX, BOILERPLATE, MOJIBAKE

_SCRIPT = r"(?is)<(script|style)[^>]*>.*?</\1>"


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, _SCRIPT, ""), "<[^>]+>", " ")


def fix_encoding(c: Column) -> Column:
    for wrong, right in MOJIBAKE:
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return F.regexp_replace(c, r"[\p{Cc}&&[^\n\t\r]]", "")


def whitespace(c: Column) -> Column:
    """Blanks and tabs to one blank, at most one empty line, every line stripped (in that order)."""
    c = F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), "\n")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


#: Letters whose upper case is more than one, and the one letter that stands for it: themselves, if there is none.
_LONGER = [x for x in map(chr, range(0x20000)) if len(x.upper()) > 1]
_ALONE = ["ẞ" if x == "ß" else x.title() if len(x.title()) == 1 else x for x in _LONGER]


def upper_each(c: Column) -> Column:
    """Upper case of each character by itself: a text keeps its length."""
    one = lambda x: F.when(F.length(F.upper(x)) == 1, F.upper(x)).otherwise(F.translate(x, "".join(_LONGER), "".join(_ALONE)))
    return F.array_join(F.transform(F.split(c, ""), one), "")


def closed_entities(c: Column) -> Column:
    """Markup in which entities count only with their semicolon; without it, a parser reads &amp as & too."""
    return F.regexp_replace(c, r"&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);)", "&amp;")


def strip_boilerplate(c: Column) -> Column:
    for pattern in BOILERPLATE:
        c = F.regexp_replace(c, pattern, "")
    return c


def strip_prefix(c: Column, word_boundary: bool = False) -> Column:
    """Without ``word_boundary`` "abstraction" loses its beginning too."""
    pattern = ABSTRACT_PREFIX.replace(r")\s*:?", r")\b\s*:?") if word_boundary else ABSTRACT_PREFIX
    return F.regexp_replace(c, pattern, "")


_TAG, _BLANKS, _LINES = re.compile("<[^>]+>"), re.compile(r"[ \t]+"), re.compile(r"\n{3,}")
_SCRIPT_RE = re.compile(_SCRIPT)
#: All of category Cc but line end, tab and carriage return.
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")


def clean(text: str | None) -> str:
    """Entities, tags, wrong decoding, NFKC, white space; in that order, so an escaped tag is a tag."""
    if not text:
        return ""
    text = _TAG.sub(" ", _SCRIPT_RE.sub("", html.unescape(text)))
    for wrong, right in MOJIBAKE:
        text = text.replace(wrong, right)
    text = unicodedata.normalize("NFKC", _CONTROL.sub("", text))
    text = _LINES.sub("\n\n", _BLANKS.sub(" ", text))
    return "\n".join(line.strip() for line in text.split("\n")).strip()


@F.pandas_udf(T.StringType())
def clean_text(texts: pd.Series) -> pd.Series:
    return texts.map(clean, na_action=None)


def clean_abstract(c: Column) -> Column:
    """``clean_text`` without boilerplate and the leading word "abstract"; null gives an empty string."""
    return strip(strip_prefix(strip_boilerplate(clean_text(c))))


@F.pandas_udf(T.DoubleType())
def encoding_integrity_exact(texts: pd.Series) -> pd.Series:
    """``encoding_integrity`` by Python's version of Unicode."""

    def one(t: str | None) -> float:
        if not t:
            return 1.0
        return max(0.0, 1.0 - 10 * sum(c == "�" or unicodedata.category(c) in ("Co", "Cn") for c in t) / len(t))

    return texts.map(one, na_action=None).astype(float)


def encoding_integrity(c: Column) -> Column:
    """1 less ten times the share of replacement, private and unassigned characters; 1 for no text."""
    bad = F.regexp_count(c, F.lit(r"[�\p{Co}\p{Cn}]"))
    share = F.try_divide(bad.cast("double") * 10, F.length(c).cast("double"))
    return F.greatest(F.lit(0.0), F.coalesce(1 - share, F.lit(1.0)))
