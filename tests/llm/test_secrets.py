import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scholarlens.llm import secrets, trigrams

from .helpers import documents, messy


def brute(text):
    found = [(m.start(), k, m.end()) for k, r in enumerate(secrets.RULES) for m in re.finditer(r.pattern, text, r.flags) if len(m[r.group]) >= r.least]
    return sorted(found)


def holds(q, text):
    if q is True or isinstance(q, str):
        return q is True or q in text
    return (all if q[0] == "and" else any)(holds(x, text) for x in q[1])


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
@given(data=st.data())
@settings(max_examples=60, deadline=None)
def test_query_holds_for_every_match(rule, data):
    text = data.draw(st.from_regex(re.compile(rule.pattern, rule.flags)))
    assert holds(trigrams.query(rule.pattern), "".join(c.lower() if c.isascii() else c for c in text))


def test_queries():
    assert trigrams.query("AKIA[A-Z0-9]+") == ("and", frozenset({"aki", "kia"}))
    assert trigrams.query("[0-9a-f]+") is True
    assert trigrams.query("(abc|xyz)") == ("or", frozenset({"abc", "xyz"}))
    assert trigrams.query("(abcd)?") is True and trigrams.query("ab") is True


def test_found(spark):
    rng = random.Random(2)
    texts = [*messy(), *("".join(rng.choice(["password", "Token", ":", "=", " ", '"', "abcdefgh", "AKIA", "ABCDEF", "0123456789abcdef", "é"]) for _ in range(30)) for _ in range(60))]
    df = documents(spark, texts)
    got = {r.doc_id: r for r in secrets.found(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t or "")
        shown = [(k, f"{secrets.RULES[k].kind}:{s}:{e}") for s, k, e in want]
        assert got[i].spans == ",".join(x for _, x in shown)
        assert got[i].base_sha256 == hashlib.sha256(",".join(x for k, x in shown if k < 3).encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for k, _ in shown) for j in range(3)]


def test_only_ascii_letters_fold(spark):
    assert brute("PASSWORD=abcdefgh") and not brute("paſsword=abcdefgh")


def test_redacted(spark):
    df = documents(spark, ['a token = "abcdefgh12" b', None, "", "x"], [3, 3, None, 4])
    got = secrets.redacted(df)
    assert got.columns == df.columns
    assert [r.text for r in got.collect()] == ['a [assign]" b', None, "", "x"]
    assert secrets.found(df.limit(0)).count() == 0 == secrets.redacted(df.limit(0)).count()


def test_overlapping_secrets_become_one():
    text = "token = " + "0a" * 20 + " end"
    assert secrets.redact(text, secrets.scanner(secrets.RULES).scan([text])[0]) == "[assign] end"
