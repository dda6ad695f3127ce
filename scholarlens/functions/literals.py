"""Words that a text must have for a pattern to match, derived from the pattern."""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from functools import cache


def _runs(items) -> list[frozenset[str]]:
    """Sets of which a match of the sequence contains one member each."""
    out, run = [], ""

    def end() -> None:
        nonlocal run
        if run:
            out.append(frozenset([run]))
        run = ""

    for kind, value in items:
        if kind is op.LITERAL and chr(value).isascii():
            run += chr(value).lower()
            continue
        end()
        if kind is op.SUBPATTERN:
            out += _runs(value[3])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
            out += _runs(value[2])
        elif kind is op.BRANCH and all(branches := [_best(_runs(b)) for b in value[1]]):
            out.append(frozenset().union(*branches))
    end()
    return out


def _best(sets: list[frozenset[str]]) -> frozenset[str]:
    """The set whose shortest word is longest; the smallest of these. Empty if there is none."""
    return max(sets, key=lambda s: (min(map(len, s)), -len(s)), default=frozenset())


@cache
def required(pattern: str) -> frozenset[str]:
    """Lower-case words of which every match has one, in whatever case; empty if none is sure."""
    return _best(_runs(parser.parse(pattern)))
