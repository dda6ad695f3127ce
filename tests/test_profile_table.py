"""States that batches add to and take from give the profiles of all research at once."""

import random

import pytest

from scholarlens.operators import profile
from scholarlens.operators.profile_table import ProfileTable

SCHEMA = "id string, embedding array<double>, dept string, supervisors array<string>"


def research(rng, ids):
    names = [" Dr. A", "B b.", "Cc C", "x", None]
    return [(str(i), None if rng.random() < 0.1 else [rng.randrange(9) - 4.0 for _ in range(4)], rng.choice(["P", "Q", "", None]), rng.choice([None, [], [rng.choice(names) for _ in range(rng.randrange(1, 4))]])) for i in ids]


def same(a, b):
    a, b = ({r.name: r for r in x.collect()} for x in (a, b))
    assert a.keys() == b.keys() and a
    for name, r in a.items():
        assert (r.dept, r.research_count) == (b[name].dept, b[name].research_count)
        assert r.expertise_vector == pytest.approx(b[name].expertise_vector, abs=1e-9)


def test_batches_give_the_whole(spark, tmp_path):
    rng = random.Random(3)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    held, now = ProfileTable(spark, str(tmp_path / "p"), 4), {}
    for number in range(5):
        new = research(rng, range(number * 20, number * 20 + 40) if number else range(20))
        old = [now[r[0]] for r in new if r[0] in now]
        for _ in range(2):  # a batch that comes again is left out
            held.apply(frame(new), frame(old), "s", number)
        now |= {r[0]: r for r in new}
        same(held.profiles(), profile.profiles(frame(list(now.values()))))
    gone = list(now.values())[:50]
    held.apply(frame([]), frame(gone))
    same(held.profiles(), profile.profiles(frame(list(now.values())[50:])))
    held.apply(frame([]), frame(list(now.values())[50:]))
    assert held.profiles().count() == 0


def test_only_the_named_people_are_written(spark, tmp_path):
    held = ProfileTable(spark, str(tmp_path / "p"), 16)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    held.apply(frame([(str(i), [1.0, float(i)], "P", [f"Name {i}"]) for i in range(60)]))
    before = held.table.version().buckets
    held.apply(frame([("x", [3.0, 1.0], "Q", ["Name 7"])]))
    after = held.table.version().buckets
    assert sum(before[b] != after[b] for b in after) == 1
    assert {r.name: r.research_count for r in held.profiles().collect()}["Name 7"] == 2
