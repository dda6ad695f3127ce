"""Indonesian stems, by the rules of the Snowball project's stemmer (after Tala, 2003), as one native column.

A word has a measure, its number of vowels, and loses affixes while that is above two: a particle, a possessive, a
prefix of the first order and a suffix that goes with it, a prefix of the second order. Every affix has one vowel, so
the measure is what is left to count; and which prefix was lost is kept before the word, as a digit that no word has
there, until the suffix is decided. So each rule is one replacement, and they follow one another.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"
#: Three vowels or more from here on.
_LONG = "(?=(?:[^aeiou]*[aeiou]){3})"
#: Words that any rule can change: long ones with an affix.
_INFLECTED = rf"^{_LONG}(?:.*(?:kah|lah|pun|ku|mu|nya|an|i)$|(?:di|ke|me|pe|be|ter))"
_SECOND = "(?:bel(?=ajar)|pel(?=ajar)|per|pe|ber|be(?=[^aeiou]er))"

#: (pattern, replacement), in order. Marks: #1 and #3 after a prefix of the first order, #x after its suffix is lost
#: too, #2 and #4 after one of the second order, #0 where a word only began with one that says nothing of suffixes.
_RULES = [
    ("(.*)(?:kah|lah|pun)$", "$1"),
    ("(.*)(?:ku|mu|nya)$", "$1"),
    ("meny(?=[aeiou])", "#1s"),
    ("peny(?=[aeiou])", "#3s"),
    ("mem(?=[aeiou])", "#1p"),
    ("pem(?=[aeiou])", "#3p"),
    ("(?:meng|mem|men|me|di|ter)", "#1"),
    ("(?:peng|pem|pen|ke)", "#3"),
    ("#1(.*)(?:kan|(?<!s)i)$", "#x$1"),
    ("#3(.*)an$", "#x$1"),
    (f"#x{_SECOND}", "#y"),
    ("pel(?=ajar)", "#0"),
    ("(?:per|pe)", "#2"),
    ("(?:ber|be(?=[^aeiou]er)|bel(?=ajar))", "#4"),
    ("#2(.*)(?:an|(?<!s)i)$", "#y$1"),
    ("#4(.*?)(?:kan|an)$", "#y$1"),
    ("(#0|(?!#))(.*?)(?:kan|an|(?<!s)i)$", "$1$2"),
]


def stem(word: Column) -> Column:
    """The stem of a lower-case word; null stays null."""
    out = word
    for pattern, by in _RULES:
        out = F.regexp_replace(out, f"^{_LONG}{pattern}", by)
    return F.when(F.rlike(word, F.lit(_INFLECTED)), F.regexp_replace(out, "^#.", "")).otherwise(word)


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
