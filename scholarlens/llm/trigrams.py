"""Boolean trigram queries that every match of a regular expression must satisfy.

``query`` walks the parsed pattern and keeps, for each node, the set of all strings it can match while that set is
small, else what its matches must contain. Text and literals are folded to lower case (ASCII), so a query holds for
either case. A query is True (no mandatory trigram), a trigram, or ("and" | "or", parts).
"""

from __future__ import annotations

import re._constants as c
import re._parser as parser

MOST = 24  # strings in an exact set

Query = bool | str | tuple


def both(a: Query, b: Query) -> Query:
    if a is True or a == b:
        return b
    return a if b is True else ("and", frozenset({a, b}))


def either(queries: list[Query]) -> Query:
    found = frozenset(queries)
    return True if True in found or not found else next(iter(found)) if len(found) == 1 else ("or", found)


def _of_string(s: str) -> Query:
    out: Query = True
    for k in range(len(s) - 2):
        out = both(out, s[k : k + 3])
    return out


def _of_set(strings: set[str]) -> Query:
    return either([_of_string(s) for s in strings])


def _fold(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _class(items: list) -> set[str] | None:
    out: set[str] = set()
    for op, value in items:
        if op is c.LITERAL:
            out.add(_fold(value))
        elif op is c.RANGE and value[1] - value[0] < MOST:
            out |= {_fold(k) for k in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST else None


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """The exact set of a sequence, or None and its query."""
    held: set[str] | None = {""}  # exact strings since the last part that has no exact set
    done, exact = True, True
    for op, value in nodes:
        part: set[str] | None
        need: Query = True
        if op is c.LITERAL:
            part = {_fold(value)}
        elif op is c.IN:
            part = _class(value)
        elif op is c.SUBPATTERN:
            part, need = _walk(value[3])
        elif op is c.BRANCH:
            found = [_walk(x) for x in value[1]]
            whole = all(x[0] is not None for x in found)
            part = set().union(*(x[0] for x in found)) if whole else None
            need = True if whole else either([x[1] if x[0] is None else _of_set(x[0]) for x in found])
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            least, most, inner = value
            sub, need = _walk(inner)
            part = {""} | sub if sub is not None and (least, most) == (0, 1) else sub if (least, most) == (1, 1) else None
            if part is None:
                need = both(need if sub is None else _of_set(sub), True) if least else True
        elif op is c.AT:
            part = {""}
        else:
            part = None
        if part is not None and len(held) * len(part) <= MOST:
            held = {a + b for a in held for b in part}
        else:
            done, exact = both(done, _of_set(held)), False
            held = part if part is not None and len(part) <= MOST else {""}
            done = both(done, need)
    return (held, True) if exact else (None, both(done, _of_set(held)))


def query(pattern: str) -> Query:
    exact, need = _walk(parser.parse(pattern))
    return need if exact is None else _of_set(exact)


def trigrams(q: Query) -> set[str]:
    return set() if q is True else {q} if isinstance(q, str) else set().union(*map(trigrams, q[1]))
