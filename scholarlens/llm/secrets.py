"""Secret scans: trigram inverted index, candidate documents by intersected postings, verified by the regexes.

An index covers a block of documents (an Arrow batch), so it never moves and its size does not grow with the corpus.
Its dictionary is the trigrams that the rules' queries name. Rules without mandatory trigrams scan every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import trigrams
from .common import table


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters or more, else a match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = 0


# The base rules, in their order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
#: What is found beside the base rules.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [trigrams.query(r.pattern) for r in rules]
        self.patterns = [re.compile(self._long_only(r), r.flags) for r in rules]
        names = sorted(set().union(*map(trigrams.trigrams, self.queries)))
        self.number = {t: i for i, t in enumerate(names)}
        self.place = np.full(1 << 24, -1, dtype=np.int16)
        for t, i in self.number.items():
            b = t.encode()
            self.place[b[0] << 16 | b[1] << 8 | b[2]] = i
        self.first = np.zeros(1 << 16, dtype=bool)  # two bytes that begin a trigram of the dictionary
        for t in names:
            b = t.encode()
            self.first[b[0] << 8 | b[1]] = True
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    @staticmethod
    def _long_only(rule: Rule) -> str:
        """A single class repeated has its least length in the pattern: its runs are the matches either way."""
        plain = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
        return f"{plain[1]}{{{rule.least},}}" if plain and rule.group == 0 and rule.least else rule.pattern

    def postings(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each trigram of the dictionary the numbers of the texts that have it, ascending."""
        data = self.fold[np.frombuffer(b"\0\0\0".join([*texts, b"\0\0\0"]), np.uint8)]
        starts = np.cumsum([0] + [len(t) + 3 for t in texts[:-1]])
        two = data[:-1].astype(np.uint16) << 8 | data[1:]
        at = np.flatnonzero(self.first[two[:-1]])
        number = self.place[two[at].astype(np.int32) << 8 | data[at + 2]]
        at, number = at[number >= 0], number[number >= 0]
        text = np.searchsorted(starts, at, side="right") - 1
        key = np.unique(number.astype(np.int64) * len(texts) + text)
        cut = np.searchsorted(key, np.arange(len(self.number) + 1) * len(texts))
        return [key[cut[i] : cut[i + 1]] % len(texts) for i in range(len(self.number))]

    def candidates(self, q: trigrams.Query, lists: list[np.ndarray]) -> np.ndarray:
        if isinstance(q, str):
            return lists[self.number[q]]
        found = sorted((self.candidates(x, lists) for x in q[1]), key=len)
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if q[0] == "and" else np.union1d(out, x)
        return out

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, number of the rule, end) of every secret in each text, sorted; code points, end exclusive."""
        out: list[list] = [[] for _ in texts]
        if not texts:
            return out
        lists = self.postings([t.encode("utf-8", "replace") for t in texts])
        for k, (rule, q, pattern) in enumerate(zip(self.rules, self.queries, self.patterns, strict=True)):
            for i in range(len(texts)) if q is True else self.candidates(q, lists).tolist():
                out[i] += [(m.start(), k, m.end()) for m in pattern.finditer(texts[i]) if len(m[rule.group]) >= rule.least]
        for found in out:
            found.sort()
        return out


_scanners: dict[tuple, Scanner] = {}


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules)
    return _scanners[rules]


def _blocks(texts: list, size: int = 8_000_000) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def found(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans of every row.

    A null or empty text has no secret: counts are 0, spans are empty. Every row is scanned by itself, so rows that
    repeat or have no doc_id have their own result. Spans that begin together come in the order of the rules. A text
    of any length is scanned whole. Other columns are not looked at; an empty table gives an empty one.
    """
    n_base = len(BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in _blocks(texts):
                counts, base, spans = [[] for _ in range(n_base)], [], []
                for secrets in scan.scan([t or "" for t in texts[a:b]]):
                    for k in range(n_base):
                        counts[k].append(sum(s[1] == k for s in secrets))
                    shown = [(k, f"{rules[k].kind}:{s}:{e}") for s, k, e in secrets]
                    base.append(hashlib.sha256(",".join(x for k, x in shown if k < n_base).encode()).hexdigest())
                    spans.append(",".join(x for _, x in shown))
                columns = [ids[a:b], *(pa.array(x, pa.int64()) for x in counts), pa.array(base), pa.array(spans)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redact(text: str, secrets: list[tuple[int, int, int]], rules: tuple[Rule, ...] = RULES) -> str:
    """Overlapping secrets become one mark, named after the first."""
    out, at, end, kind = [], 0, 0, ""
    for s, k, e in secrets:
        if s >= end:
            if end:
                out.append(f"[{kind}]")
            out.append(text[at:s])
            kind = rules[k].kind
        at = end = max(end, e)
    return "".join([*out, f"[{kind}]" * bool(end), text[at:]])


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by its kind in brackets.

    Null and empty texts, rows that repeat or have no doc_id, and all other columns of whatever names stay.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in _blocks(texts):
                spans = scan.scan([t or "" for t in texts[a:b]])
                new = [redact(t, s, rules) if s else t for t, s in zip(texts[a:b], spans, strict=True)]
                yield batch.slice(a, b - a).set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"))
