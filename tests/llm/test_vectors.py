import random

import numpy as np
import pytest

from scholarlens.llm import ann, neardup_vectors

from .helpers import components


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "n", "q") for i, v in rows], "vec_id bigint, embedding array<float>, label int, near string, query string")


def rows(seed, n, groups, size, dim=16):
    rng = np.random.default_rng(seed)
    x = [v / np.linalg.norm(v) for v in rng.normal(size=(n, dim))]
    for g in range(groups):
        x += [x[g] + rng.normal(size=dim) * 0.02 for _ in range(size)]
    x = [*(v * s for v, s in zip(x, rng.uniform(0.5, 2, len(x)), strict=True)), *x[:5], *x[:5]]
    return [*enumerate(np.float32(x).tolist())]


BAD = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] + [1.0] * 15), (9005, [float("inf")] + [0.0] * 15), (9006, [1.0, 0.0])]


def test_links(spark):
    good = rows(1, 300, 4, 40)
    random.Random(1).shuffle(good)
    df = frame(spark, [*good, *BAD])
    got = {r.vec_id: r for r in neardup_vectors.linked(df).collect()}
    ids = [i for i, _ in good]
    x = np.array([v for _, v in good], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    want = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit), strict=True)])
    assert {i: got[i].n_links for i in ids} == dict(zip(ids, hit.sum(axis=1).tolist(), strict=True))
    assert {i: got[i].component_id for i in ids} == want
    for i, _ in BAD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_link_edges(spark):
    df = frame(spark, [(3, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in neardup_vectors.linked(df).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (3, 2, 1, False)]
    assert neardup_vectors.linked(df.limit(0)).count() == 0
    assert [r.n_links for r in neardup_vectors.linked(frame(spark, BAD[:3])).collect()] == [0, 0, 0]


def test_cells_cut_by_hash(spark, monkeypatch):
    monkeypatch.setattr(neardup_vectors, "CELL", 100)
    monkeypatch.setattr(neardup_vectors, "SHARD", 60)
    test_links(spark)


def islands(seed, groups, size, noise, dim=32):
    """Groups of more near copies than a node has candidates, far from each other."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim))
    x = np.repeat(base / np.linalg.norm(base, axis=1, keepdims=True), size, axis=0)
    x = np.float32(x + rng.normal(size=x.shape) * noise)
    return [(int(i), v) for i, v in zip(rng.permutation(len(x)), x.tolist(), strict=True)]


def exact(good, threshold=0.95):
    """n_links and component_id of every row by comparing all pairs."""
    ids, x = [i for i, _ in good], np.array([v for _, v in good], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= threshold
    np.fill_diagonal(hit, False)
    return dict(zip(ids, hit.sum(axis=1).tolist(), strict=True)), components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(hit)), strict=True)])


@pytest.mark.parametrize("cut", [False, True])
def test_one_search_finds_separate_groups(spark, monkeypatch, cut):
    monkeypatch.setattr(neardup_vectors, "TRIES", 1)
    monkeypatch.setattr(neardup_vectors, "AUDIT_RECALL", 0)
    monkeypatch.setattr(neardup_vectors, "GOOD", 0)
    if cut:
        monkeypatch.setattr(neardup_vectors, "SHARD", 500)
    good = islands(5, 12, 80, 0.02)
    got = neardup_vectors.linked(frame(spark, good)).collect()
    links, component = exact(good)
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == component


def rare(n=9000, pairs=60, dim=64):
    """Random vectors of which a few have a partner in range."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal((pairs, dim))
    u -= (u * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    x[pairs : 2 * pairs] = 0.953 * x[:pairs] + np.sqrt(1 - 0.953**2) * u
    return [(int(i), v) for i, v in zip(rng.permutation(n), np.float32(x).tolist(), strict=True)]


def test_rare_links_count_at_both_ends(spark):
    good = rare()
    links, component = exact(good)
    got = neardup_vectors.linked(frame(spark, good)).collect()
    assert sum(links.values()) >= 120
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == component
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_nothing_is_accepted_unseen(spark, monkeypatch):
    """Where no row has a link, planted nodes tell that a blind search finds nothing; they are in no result."""
    audits, audit = [], neardup_vectors._audit
    monkeypatch.setattr(neardup_vectors, "_audit", lambda *a: audits.append(audit(*a)) or audits[-1])
    good = rare(600, 0, 16)
    got = neardup_vectors.linked(frame(spark, good)).collect()
    assert audits[-1] >= 0.99 and sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(i, 0, i) for i in range(600)]
    monkeypatch.setattr(neardup_vectors, "_search", lambda *_: spark.createDataFrame([], "vec_id bigint, others bigint, back bigint, root bigint"))
    audits.clear()
    neardup_vectors.linked(frame(spark, good)).collect()
    assert audits == [0.0] * neardup_vectors.TRIES


def test_counts_in_tiles(spark, monkeypatch):
    """Components of many sizes, one of half of all nodes: tiles and bundles of bounded size count every link."""
    monkeypatch.setattr(neardup_vectors, "CHUNK", 50)
    good = [*islands(5, 1, 300, 0.03), *((i + 1000, v) for i, v in islands(6, 90, 3, 0.02))]
    links, component = exact(good)
    nodes = neardup_vectors.vectors.of_main_length(frame(spark, good)).selectExpr("vec_id", "1L AS copies", "embedding")
    groups = spark.createDataFrame([(i, c) for i, c in component.items() if i != c], "node bigint, component bigint")
    got = {r.vec_id: r.others for r in neardup_vectors._counted(nodes, groups, 0.95).collect()}
    assert got == {i: n for i, n in links.items() if n}


def test_cells_are_dealt_again(spark, monkeypatch):
    """Two levels of centres, and one dense group that none of them divides: parts and blocks of bounded size."""
    for name, value in (("CELL", 40), ("SHARD", 60), ("FAN", 4), ("SPLIT", 2), ("SAMPLE", 300)):
        monkeypatch.setattr(neardup_vectors, name, value)
    good = [*islands(5, 1, 400, 0.01), *((i + 1000, v) for i, v in islands(6, 300, 2, 0.02))]
    df = frame(spark, good)
    nodes = neardup_vectors.vectors.of_main_length(df).selectExpr("vec_id", "1L AS copies", "embedding")
    dealt = neardup_vectors.cells(nodes, len(good), 2).toPandas()
    assert dealt[dealt.home].vec_id.is_unique and dealt.home.sum() == len(good)
    hot = dealt[dealt.home & (dealt.vec_id < 400)].cell.value_counts()
    assert hot.iloc[0] == 400 and dealt.cell.max() >= 4
    links, component = exact(good)
    got = neardup_vectors.linked(df).collect()
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == component


def test_search_leaves_its_cell():
    """The united lists name nodes of other cells near the range, and the search returns them."""
    rng = np.random.default_rng(3)
    x = neardup_vectors._unit(np.repeat(rng.normal(size=(1, 16)), 40, axis=0) + rng.normal(size=(40, 16)) * 0.03)
    near = [np.array([v for v in (k - 1, k + 1) if 0 <= v < 40]) for k in range(40)]
    group = neardup_vectors.pa.table({
        "vec_id": list(range(40)), "copies": [1] * 40, "embedding": x.tolist(), "near": [v.tolist() for v in near],
        "held": [True] * 40, "asks": [k < 20 for k in range(40)],
    })
    got = neardup_vectors.find(group, 32, 0.95).to_pydict()
    hit = (x[:20] @ x.T >= 0.95).sum(axis=1) - 1
    assert dict(zip(got["vec_id"], got["others"], strict=True)) == {k: int(hit[k]) if k < 20 else 0 for k in range(40)}
    assert set(got["root"]) == {0}


@pytest.mark.parametrize("blind", ["all", "small", "first"])
def test_what_searches_miss_is_compared(spark, monkeypatch, blind):
    """Searches that lose every link, those of pairs beside a hot group, or in the last try what the first had found."""
    search, turn = neardup_vectors._search, []

    def worse(shards, beam, threshold):
        turn.append(beam)
        found = search(shards, beam, threshold)
        if blind == "first":
            return found.where(f"pmod(vec_id, 2) = {len(turn) % 2}")  # planted nodes may have negative ids
        return found.where("false" if blind == "all" else "others > 10")

    monkeypatch.setattr(neardup_vectors, "_search", worse)
    monkeypatch.setattr(neardup_vectors, "CELL", 100)
    monkeypatch.setattr(neardup_vectors, "BLOCK", 60, raising=False)
    hot, pairs = islands(7, 1, 120, 0.02), islands(8, 40, 2, 0.02)
    good = [*hot, *((i + 1000, v) for i, v in pairs)]
    links, component = exact(good)
    got = neardup_vectors.linked(frame(spark, good)).collect()
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == component
    assert len(turn) == (2 if blind == "first" else neardup_vectors.TRIES)


def neighbours(spark, df, queries=None):
    out = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0") if queries is None else queries).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(found) for q, found in out.items()}


def recall(good, got):
    """Share of the true 20 nearest that was found; the lists must be ordered, whole and exactly scored."""
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good], np.float64)
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, min(20, len(good) - 1) + 1))
        score = (x * x[ids == q][0]).sum(axis=1)
        assert all(s == pytest.approx(score[ids == v][0], abs=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found) and q not in {v for _, v, _ in found}
        score[ids == q] = -np.inf
        hits += len({v for _, v, _ in found} & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    return hits / sum(map(len, got.values()))


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 100)
    monkeypatch.setattr(ann, "QUERIES", 20)
    good = rows(2, 1500, 3, 30)
    got = neighbours(spark, frame(spark, [*good, *BAD]))
    assert set(got) == {i for i, _ in good if i % 20 == 0}
    assert recall(good, got) >= 0.9


def random_directions(n, dim):
    x = np.random.default_rng(dim).normal(size=(n, dim))
    return [*enumerate(np.float32(x / np.linalg.norm(x, axis=1, keepdims=True)).tolist())]


@pytest.fixture
def tuned(monkeypatch):
    """What the measurement chose: pivots a query, and candidates."""
    found, whole = [], ann._tuned
    monkeypatch.setattr(ann, "_tuned", lambda *a: found.append(whole(*a)) or found[-1])
    return found


@pytest.mark.parametrize("dim", [64, 768])
def test_recall_without_clusters(spark, dim, tuned):
    """Random directions, where no index prunes much."""
    good = random_directions(2000, dim)
    assert recall(good, neighbours(spark, frame(spark, good))) >= 0.9
    assert dim > 64 or tuned[0][1] < 2000 / 5


def test_candidates_fall_with_the_rows(spark, tuned):
    """In random directions of 64 dimensions a query is compared with a falling share of the rows, far under a third."""
    for n in (2500, 10_000):
        good = random_directions(n, 64)
        df = frame(spark, good)
        assert recall(good, neighbours(spark, df, df.where("vec_id % 100 = 0"))) >= 0.9
    small, large = tuned[0][1] / 2500, tuned[1][1] / 10_000
    assert large < small and large < 0.1


def test_footrule_decides(spark, monkeypatch):
    """With the same files and as many candidates, orders that say nothing find far fewer."""
    good = random_directions(2000, 64)
    posts = ann._posts
    monkeypatch.setattr(ann, "_tuned", lambda *_: (200, 200))
    whole = recall(good, neighbours(spark, frame(spark, good)))

    def same_order(rows, *more, query):
        out = posts(rows, *more, query=query)
        return out if query else out.withColumn("pivots", ann.F.lit(np.arange(ann.DEPTH, dtype="<u2").tobytes()))

    monkeypatch.setattr(ann, "_posts", same_order)
    assert recall(good, neighbours(spark, frame(spark, good))) < whole / 2 and whole > 0.85


def test_files_of_pairs_and_triples(spark, monkeypatch):
    """Where a pivot's file would hold too many, files are named by two or three pivots."""
    good = rows(2, 1500, 3, 30)
    df = frame(spark, good)
    for full, size in ((50, 2), (1, 3)):
        monkeypatch.setattr(ann, "FULL", full)
        monkeypatch.setattr(ann, "PIVOTS", 24)
        assert ann.grouping(len(good), 24)[0] == size
        assert recall(good, neighbours(spark, df, df.where("vec_id % 100 = 0"))) >= 0.9
    order = np.array([[5, 2, 9, 1]])
    assert ann.files(order, 1).tolist() == [[5, 2, 9, 1]] and ann.files(order[:, :3], 2).tolist() == [[2 << 16 | 5, 5 << 16 | 9, 2 << 16 | 9]]


def test_a_query_has_no_more_files_than_pivots(spark, monkeypatch):
    """In random directions pairs and triples would be many files for a query, so single pivots name them."""
    good, asked, posts = random_directions(2000, 64), [], ann._posts
    monkeypatch.setattr(ann, "FULL", 1)
    monkeypatch.setattr(ann, "PIVOTS", 64)
    assert ann.grouping(len(good), 64)[0] > 1

    def counted(rows, *more, query):
        out = posts(rows, *more, query=query)
        asked.extend(r["count"] for r in out.groupBy("vec_id").count().collect() if query)
        return out

    monkeypatch.setattr(ann, "_posts", counted)
    df = frame(spark, good)
    assert recall(good, neighbours(spark, df, df.where("vec_id % 100 = 0"))) >= 0.9 and 0 < max(asked) <= 64


def test_blind_search_ends_exact(spark, monkeypatch):
    monkeypatch.setattr(ann, "TARGET", 1.1)
    monkeypatch.setattr(ann, "LEAST", 1.1)
    monkeypatch.setattr(ann, "ROWS", 100)
    monkeypatch.setattr(ann, "QUERIES", 7)
    good = rows(4, 400, 2, 30)
    assert recall(good, neighbours(spark, frame(spark, good))) == 1


def test_more_copies_than_neighbours(spark):
    good = [(i, [1.0, 2.0]) for i in range(70)] + [(i, [2.0, 1.0]) for i in range(70, 80)]
    got = neighbours(spark, frame(spark, good))
    assert [v for _, v, _ in got[0]] == list(range(1, 21)) and [v for _, v, _ in got[60]] == list(range(20))


def test_repeated_and_short_queries(spark):
    df = frame(spark, [(0, [1.0, 0.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0, 0.0]), *((i, [1.0, i, 0.0, 0.0]) for i in range(1, 60)), (59, [1.0, 59.0, 0.0, 0.0])])
    asked = frame(spark, [(0, [1.0, 0.0, 0.0, 0.0])] * 2 + [(100 + i, [1.0, 0.0]) for i in range(9)])
    got = neighbours(spark, df, asked)
    assert list(got) == [0] and [(r, v) for r, v, _ in got[0]] == [(i, i) for i in range(1, 21)]


def test_nearest_edges(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None)])
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 5, 1.0), (0, 2, 20, 1.0), (0, 3, 3, 0.5), (20, 1, 0, 1.0), (20, 2, 5, 1.0), (20, 3, 3, 0.5)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    assert ann.nearest(df, df.limit(0)).count() == 0
