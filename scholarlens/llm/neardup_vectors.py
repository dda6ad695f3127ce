"""Embedding near-dedup by a robust-pruned flat graph.

1. Equal vectors become one node with a count.
2. Nodes are dealt into overlapping cells: each goes to its nearest centres, at the nearest of all it is at home. A cell
   that is still large is dealt again, among centres of its own, and so on; a dense group that no centres keep apart
   stays one cell, which is cut by hash into parts of about SHARD nodes.
3. In every part a graph is built by robust pruning: a neighbour is dropped if a kept one is much nearer to it.
4. The adjacency lists of a node from all its cells are united, and a cell gets the nodes that its nodes' united lists
   name near the range, so a search may leave the cell that it began in.
5. Each node is searched for at home, on the united lists: from the medoids of all islands of the graph and of all
   groups that can fill a beam, and from its own place, greedily with a beam, expanding everything near the range, so
   that whole groups are found. Candidates are verified by their cosine in double precision, in both directions. A
   group of the search is a part and a block of the nodes at home, both of bounded size; links are connected there by
   a forest, never listed.
6. Recall is audited node by node against brute force on a bounded sample, of which a part is planted: nodes made to
   be just in range of another one. Below AUDIT_RECALL the search is repeated with more overlap and a wider beam, and
   all searches' forests connect. If TRIES searches stay below it, all nodes that can be in range are compared exactly.
7. Links are counted within the components that the search found, where each node is compared with all others: so a
   link that was found from one end counts at both.
"""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors
from .common import compact, finished, mark, table
from .graph import components

THRESHOLD = 0.95
#: Nodes of a cell and of a part, about; a cell of SPLIT times as many is dealt again, among FAN centres at most, that are
#: fitted on SAMPLE of its nodes.
CELL, SHARD, SPLIT, FAN, SAMPLE = 1500, 3000, 8, 256, 10_000
#: Neighbours of a node, and the pruning factor.
DEGREE, ALPHA = 24, 1.2
#: Cells of a node and beam at first; how far below the threshold the range is expanded.
OVERLAP, BEAM, MARGIN = 2, 32, 0.05
AUDIT, AUDIT_RECALL, TRIES = 200, 0.99, 3
#: A first search that finds less than this is repeated once, even where it is good enough.
GOOD = 0.999
#: Links of a node in a hot group, which is audited apart from others; nodes on a side of an exact comparison, about, and
#: the cells that rule pairs out there.
HOT, BLOCK, EXACT_CELLS = 2 * DEGREE, 8192, 1024
#: How far a cosine of a matrix product may be from that of the two vectors alone.
ROUNDING = 1e-9
#: How far within the range planted nodes are, and nodes on a side of a tile in which links are counted.
NEAR, CHUNK = 0.002, 2048
#: Rows of a file of a stored table, about.
FILE = 100_000
_log = logging.getLogger(__name__)


def _kept(df: DataFrame) -> DataFrame:
    """``df`` stored in files of about FILE rows, as rows hold vectors."""
    return compact(df, FILE)



def centres(x: np.ndarray, k: int, threshold: float = THRESHOLD, rounds: int = 8) -> np.ndarray:
    """At most ``k`` unit vectors by spherical k-means on the sample ``x`` of unit vectors.

    They start from rows that are twice the range apart, so a group of near copies is not divided.
    """
    apart, chosen = 2 * threshold - 1, []
    free = np.ones(len(x), bool)
    while len(chosen) < k and free.any():
        chosen.append(int(np.argmax(free)))
        free &= x @ x[chosen[-1]] < apart
        free[chosen[-1]] = False
    c = x[chosen].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            mean = x[near == j].sum(axis=0)
            if (size := np.linalg.norm(mean)) > 0:
                c[j] = mean / size
    return c


def prune(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Robust-pruned neighbours of every row of unit vectors, and the nearest few, both ways.

    Candidates of a row are its nearest rows; with distances 2 - 2 cos, a candidate goes when ``alpha`` times its
    distance to a kept neighbour is not more than its distance to the row.
    """
    n, out = len(x), []
    pool = min(n - 1, 2 * degree)
    for a in range(0, n, 512):
        sims = x[a : a + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -3
        if pool <= 0:
            out += [np.zeros(0, np.int64)] * len(sims)
            continue
        near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
        for row, ids in zip(sims, near, strict=True):
            ids = ids[np.argsort(-row[ids], kind="stable")]
            far = 2 - 2 * row[ids]
            between = 2 - 2 * (x[ids] @ x[ids].T)
            live, kept = np.ones(len(ids), bool), []
            for k in range(len(ids)):
                if live[k]:
                    kept.append(k)
                    if len(kept) == degree:
                        break
                    live &= alpha * between[k] > far
            out.append(ids[sorted({*kept, *range(min(6, len(ids)))})])
    back: list[list[int]] = [[] for _ in range(n)]
    for i, ids in enumerate(out):
        for j in ids.tolist():
            back[j].append(i)
    return [np.unique(np.concatenate([out[i], np.array(back[i][: 2 * degree], np.int64)])) for i in range(n)]


def entries(x: np.ndarray, links: list[np.ndarray], least: int = 1) -> np.ndarray:
    """Rows from which every row is reached: the medoid, then one of each part that no earlier entry reaches.

    Parts of fewer than ``least`` rows get none.
    """
    reached, out = np.zeros(len(x), bool), []

    def walk(start: int) -> np.ndarray:
        """Rows reached from ``start`` over rows that are not reached yet."""
        got = np.zeros(len(x), bool)
        got[start], todo = True, [start]
        while todo:
            new = np.unique(np.concatenate([links[i] for i in todo]))
            new = new[~got[new] & ~reached[new]]
            got[new], todo = True, new.tolist()
        return np.flatnonzero(got)

    part = np.arange(len(x))
    while len(part):
        middle = int(part[np.argmax(x[part] @ x[part].sum(axis=0))])
        if len(part) >= least:
            out.append(middle)
        reached[walk(middle)] = True
        part = walk(int(np.argmin(reached))) if not reached.all() else part[:0]
    return np.array(out, np.int64)


def search(x: np.ndarray, links: list[np.ndarray], starts: np.ndarray, near: np.ndarray, q: np.ndarray, beam: int, threshold: float) -> np.ndarray:
    """Rows in range of ``q``: greedy with a beam from ``starts``, then from ``near``, expanding all near the range."""
    seen = np.zeros(len(x), bool)
    seen[starts] = True
    ids, sims, open_ = starts, x[starts] @ q, np.ones(len(starts), bool)
    while True:
        wide = np.flatnonzero(open_ & (sims >= threshold - MARGIN))
        if len(wide):
            todo = wide
        else:
            top = np.argpartition(-sims, beam - 1)[:beam] if len(sims) > beam else np.arange(len(sims))
            top = top[open_[top]]
            todo = top[np.argsort(-sims[top], kind="stable")][:4]
        if len(todo):
            open_[todo] = False
            new = np.unique(np.concatenate([links[i] for i in ids[todo].tolist()]))
        elif len(near):
            new, near = np.unique(near), near[:0]
        else:
            return ids[sims >= threshold - 1e-6]
        new = new[~seen[new]]
        seen[new] = True
        ids, sims, open_ = np.concatenate([ids, new]), np.concatenate([sims, x[new] @ q]), np.concatenate([open_, np.ones(len(new), bool)])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


NODE = "vec_id bigint, copies bigint, embedding array<double>"


def _dealt(batch: pa.RecordBatch, found: np.ndarray, overlap: int, threshold: float) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Rows, their centres, and whether it is the row's nearest.

    Of the ``overlap`` nearest centres a row has the nearest, and those whose rows can be in range of it: those that it
    is not further from than a link is long, on either side of the plane between the two.
    """
    sims = _unit(vectors.matrix(batch.column("embedding"))) @ found.T
    near = np.argsort(-sims, axis=1, kind="stable")[:, :overlap]
    best, at = np.take_along_axis(sims, near, axis=1), near[:, :1]
    between = np.sqrt(np.maximum(2 - 2 * (found @ found.T), 0))[at, near]
    row, place = np.nonzero(best[:, :1] - best <= between * np.sqrt(max(2 - 2 * threshold, 0)) + 1e-6)
    return pa.array(row), near[row, place], place == 0


def cells(nodes: DataFrame, n: int, overlap: int, threshold: float = THRESHOLD) -> DataFrame:
    """(cell, home, vec_id, copies, embedding): each node in the cells of its nearest centres.

    Centres come from samples of bounded size; at the first level there are FAN at most, later ones are fitted in
    their cells and meet the nodes by cell and salt. ``home`` marks one cell of each node.
    """
    found = centres(_unit(vectors.sample(nodes, SAMPLE)), max(1, min(FAN, -(-n // CELL))), threshold)

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                row, cell, home = _dealt(batch, found, overlap, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(home), *(c.take(row) for c in batch.columns)], names=["cell", "home", *batch.schema.names])

    schema = f"cell bigint, home boolean, {NODE}"
    out = _kept(nodes.mapInArrow(deal, schema))
    whole = before = None
    while True:
        sizes = out.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT * CELL)
        if before is not None:
            # What no centres divide, or what has kept most of the cell that it comes from, is left as it is.
            parent = before.select((F.col("cell") + 1).alias("parent"), F.col("n").alias("of"))
            sizes = sizes.join(whole, "cell", "left_anti").withColumn("parent", F.floor(F.col("cell") / FAN)).join(parent, "parent", "left").where("of IS NULL OR n <= 0.75 * of").select("cell", "n")
        sizes = _kept(sizes)
        if not sizes.take(1):
            return out
        parts = F.greatest(F.lit(1), F.ceil(F.col("n") / (SPLIT * CELL)).cast("int"))
        drawn = out.join(sizes, "cell").where(F.pmod(F.xxhash64("vec_id", "cell"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * SAMPLE / F.col("n"))

        def fit(group: pa.Table) -> pa.Table:
            x = _unit(vectors.matrix(group.column("embedding")))
            got = centres(x, max(2, min(FAN, -(-group.column("n")[0].as_py() // CELL))), threshold)
            return pa.table({"cell": group.column("cell").slice(0, 1).cast(pa.int64()), "k": pa.array([len(got)], pa.int32()), "centres": pa.array([got.ravel()], pa.list_(pa.float64()))})

        fitted = _kept(drawn.select("cell", "n", "embedding").groupBy("cell").applyInArrow(fit, "cell bigint, k int, centres array<double>"))
        single = sizes.join(fitted.where("k > 1"), "cell", "left_anti").select("cell")
        whole, before = single if whole is None else whole.unionByName(single), sizes
        cut = fitted.where("k > 1").join(sizes, "cell").select("cell", "k", "centres", parts.alias("parts"))
        mine = out.join(cut.select("cell", F.col("parts").alias("salts")), "cell").select(*out.columns, F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int").alias("salt"))
        theirs = cut.select("cell", "k", "centres", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))

        def again(group: pa.Table, known: pa.Table) -> pa.Table:
            group = group.select(["cell", "home", "vec_id", "copies", "embedding"])
            if not group.num_rows:
                return group
            batch = group.combine_chunks().to_batches()[0]
            row, child, home = _dealt(batch, np.array(known.column("centres")[0].as_py()).reshape(known.column("k")[0].as_py(), -1), overlap, threshold)
            cell = (batch.column("cell")[0].as_py() + 1) * FAN + child
            at_home = home & np.array(batch.column("home").to_pylist(), bool)[row.to_numpy()]
            return pa.table([pa.array(cell, pa.int64()), pa.array(at_home), *(batch.column(c).take(row) for c in ("vec_id", "copies", "embedding"))], names=group.column_names)

        dealt = mine.groupBy("cell", "salt").cogroup(theirs.groupBy("cell", "salt")).applyInArrow(again, schema)
        rest = out.join(cut.select("cell"), "cell", "left_anti").select(*dealt.columns)
        out = _kept(rest.unionByName(dealt))


def _parted(dealt: DataFrame, size: int, name: str = "parts") -> DataFrame:
    """``dealt`` with the number of parts of about ``size`` nodes of each cell."""
    return dealt.join(dealt.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias(name)), "cell")


def build(group: pa.Table, threshold: float) -> pa.Table:
    """Robust-pruned neighbours of every node of a part, and those of them near the range."""
    ids, x = group.column("vec_id").to_numpy(), _unit(vectors.matrix(group.column("embedding")))
    near = prune(x)
    close = [k[x[k] @ x[i] >= threshold - 2 * MARGIN] for i, k in enumerate(near)]
    return pa.table({"vec_id": pa.array(ids, pa.int64()), **{name: pa.array([ids[k] for k in lists], pa.list_(pa.int64())) for name, lists in (("near", near), ("close", close))}})


def _forest(hit: np.ndarray, asks: np.ndarray, held: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of a group the smallest id that links lead to; ``hit`` is rows that ask by rows held."""
    root = ids.copy()
    i, j = np.nonzero(hit)
    i, j = asks[i], held[j]
    if not len(i):
        return root
    both = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.argsort(both[0], kind="stable")
    row, to = both[0][order], both[1][order]
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    while True:
        new = root.copy()
        new[row[head]] = np.minimum(root[row[head]], np.minimum.reduceat(root[to], head))
        if (new == root).all():
            return root
        root = new


def find(group: pa.Table, beam: int, threshold: float) -> pa.Table:
    """Links of the nodes that ask, found on the graph of the nodes that the part holds."""
    group = group.sort_by("vec_id").combine_chunks()
    ids, copies, x = group.column("vec_id").to_numpy(), group.column("copies").to_numpy(), _unit(vectors.matrix(group.column("embedding")))
    asks, held = (np.flatnonzero(np.array(group.column(c).to_pylist(), bool)) for c in ("asks", "held"))
    y, place, near = x[held], {v: k for k, v in enumerate(ids[held].tolist())}, group.column("near").to_pylist()
    around = [np.array([place[v] for v in [own, *(to or [])] if v in place], np.int64) for own, to in zip(ids.tolist(), near, strict=True)]
    hit = np.zeros((len(asks), len(held)), bool)
    if len(held) and len(asks):
        links = [around[i] for i in held.tolist()]
        close = [to[y[to] @ y[k] >= threshold - MARGIN] for k, to in enumerate(links)]
        starts = np.unique(np.concatenate([entries(y, links), entries(y, close, BEAM)]))
        for k, i in enumerate(asks.tolist()):
            got = search(y, links, starts, around[i], x[i], beam, threshold)
            got = got[held[got] != i]
            hit[k, got[(y[got] * x[i]).sum(axis=1) >= threshold]] = True
        # a link found from one side is one of the other side too
        at = np.full(len(ids), -1)
        at[held] = np.arange(len(held))
        mine = np.flatnonzero(at[asks] >= 0)
        square = hit[np.ix_(mine, at[asks[mine]])]
        hit[np.ix_(mine, at[asks[mine]])] = square | square.T
    others = np.zeros(len(ids), np.int64)
    others[asks] = [int(copies[held[h]].sum()) for h in hit]
    root = _forest(hit & (copies[asks] > 0)[:, None] & (copies[held] > 0), asks, held, ids)
    back = np.zeros(len(ids), np.int64)
    back[held] = copies[asks] @ hit
    some = np.flatnonzero((others > 0) | (back > 0) | (root != ids))
    return pa.table({"vec_id": pa.array(ids[some], pa.int64()), **{name: pa.array(x[some], pa.int64()) for name, x in (("others", others), ("back", back), ("root", root))}})


def _search(dealt: DataFrame, beam: int, threshold: float) -> DataFrame:
    """vec_id; others: copies of the nodes that it found in a part; back: of those that found it there; root: the smallest node that links lead to there."""
    own = lambda parts: F.pmod(F.xxhash64("vec_id"), F.col(parts)).cast("int")
    members = _parted(dealt, SHARD)
    built = members.withColumn("part", own("parts")).select("cell", "part", "vec_id", "embedding").groupBy("cell", "part").applyInArrow(lambda rows: build(rows, threshold), "vec_id bigint, near array<bigint>, close array<bigint>")
    lists = _kept(built.groupBy("vec_id").agg(*(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "close"))))
    keys = members.select("cell", "vec_id", "parts")
    named = keys.join(lists.where(F.size("close") > 0).select("vec_id", "close"), "vec_id").select("cell", "parts", F.explode("close").alias("vec_id")).distinct()
    beyond = named.join(keys.select("cell", "vec_id"), ["cell", "vec_id"], "left_anti").join(dealt.where("home").select("vec_id", "copies", "embedding"), "vec_id")
    every = members.unionByName(beyond.withColumn("home", F.lit(False)))
    every = _kept(_parted(every, 2 * SHARD, "again").withColumn("parts", F.greatest("parts", "again")).drop("again").join(lists.select("vec_id", "near"), "vec_id", "left").withColumn("own", own("parts")))
    to = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    held = every.withColumn("part", F.col("own")).withColumn("block", to).withColumn("held", F.lit(True)).withColumn("asks", F.col("home") & (F.col("block") == F.col("own")))
    asking = every.where("home AND parts > 1").withColumn("block", F.col("own")).withColumn("part", to).where("part <> own").withColumn("held", F.lit(False)).withColumn("asks", F.lit(True))
    columns = ["cell", "part", "block", "held", "asks", "vec_id", "copies", "near", "embedding"]
    return held.select(columns).unionByName(asking.select(columns)).groupBy("cell", "part", "block").applyInArrow(lambda rows: find(rows, beam, threshold), "vec_id bigint, others bigint, back bigint, root bigint")


def _planted(nodes: DataFrame, threshold: float) -> DataFrame:
    """Up to AUDIT nodes made for the audit: each is just in range of a node drawn by a hash, and counts as no copy.

    So recall can be measured however rare links are. They take part in the search like any other node; having no
    copies, they add nothing to the links of others, and no forest connects over them.
    """
    low, high = nodes.agg(F.min("vec_id"), F.max("vec_id")).first()
    first = low - AUDIT if low >= AUDIT - (1 << 63) else high + 1
    x = _unit(vectors.sample(nodes, AUDIT))
    rng, cosine = np.random.default_rng(11), min(1.0, threshold + NEAR)
    u = rng.standard_normal(x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(u, axis=1, keepdims=True)
    y = np.where(size > 1e-9, cosine * x + np.sqrt(1 - cosine**2) * u / np.where(size > 1e-9, size, 1), x)
    return nodes.sparkSession.createDataFrame([(first + k, 0, v) for k, v in enumerate(y.tolist())], NODE)


def _audit(nodes: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Mean share of its true links that was found of a node, on bounded samples: planted nodes, others with few links, and with many.

    The three are averaged apart, nodes with more than HOT links as those with many; the lowest mean counts. Planted
    nodes have a link each, so there is always something to measure.
    """
    known = nodes.join(counts, "vec_id", "left").withColumn("kind", F.when(F.col("copies") == 0, 0).when(F.coalesce("others", F.lit(0)) <= HOT, 1).otherwise(2))
    drawn = [known.where(F.col("kind") == kind).orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(AUDIT).select("vec_id", "copies", "embedding") for kind in range(3)]
    asked = reduce(DataFrame.unionByName, drawn).toArrow()
    ids, planted, q = asked.column("vec_id").to_numpy(), asked.column("copies").to_numpy() == 0, _unit(vectors.matrix(asked.column("embedding")))

    def true(batches):
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                hit = _unit(vectors.matrix(batch.column(2))) @ q.T >= threshold + ROUNDING
                hit &= batch.column(0).to_numpy()[:, None] != ids[None, :]
                total += batch.column(1).to_numpy() @ hit
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(planted), pa.array(total)], names=["vec_id", "planted", "n"])

    n = nodes.mapInArrow(true, "vec_id bigint, planted boolean, n bigint").groupBy("vec_id", "planted").agg(F.sum("n").alias("n")).where("n > 0")
    share = F.least("n", F.coalesce("others", F.lit(0))) / F.col("n")
    means = n.join(counts, "vec_id", "left").groupBy("planted", F.col("n") > HOT).agg(F.avg(share).alias("share")).collect()
    return min(r["share"] for r in means)


def _counted(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(vec_id, others): the copies of all nodes in range of each node of a component, by comparing its nodes with one another.

    So a link counts at both its ends, from whichever it was found. Components of more than CHUNK nodes are cut by hash
    into parts that meet in tiles, smaller ones are dealt over groups of about as many nodes.
    """
    heads = groups.select(F.col("component").alias("vec_id"), "component").distinct()
    inside = groups.select(F.col("node").alias("vec_id"), "component").unionByName(heads).join(nodes, "vec_id")
    sizes = groups.groupBy("component").agg(F.ceil((F.count("*") + 1) / CHUNK).cast("int").alias("parts"))
    bundles = max(1, -(-groups.count() // CHUNK))
    inside = inside.join(sizes, "component").withColumn("big", F.col("parts") > 1).withColumn("bundle", F.when(F.col("big"), F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(bundles))))
    mine, to = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = inside.withColumn("own", mine).withColumn("node", F.xxhash64("embedding"))
    asking = placed.withColumn("a", F.col("own")).withColumn("b", to).withColumn("asks", F.lit(True))
    held = placed.withColumn("b", F.col("own")).withColumn("a", to).withColumn("asks", F.lit(False))

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("component").combine_chunks()
        ids, node, copies, component = (group.column(c).to_numpy() for c in ("vec_id", "node", "copies", "component"))
        asks, x = np.array(group.column("asks").to_pylist(), bool), _unit(vectors.matrix(group.column("embedding")))
        others = np.zeros(len(ids), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], component[1:] != component[:-1], [True]])).tolist()
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            rows, to = lo + np.flatnonzero(asks[lo:hi]), lo + np.flatnonzero(~asks[lo:hi])
            sims = x[rows] @ x[to].T
            hit = sims >= threshold
            for i, j in zip(*np.nonzero(np.abs(sims - threshold) <= ROUNDING), strict=True):
                hit[i, j] = float((x[rows[i]] * x[to[j]]).sum()) >= threshold
            others[rows] = (hit & ((ids[rows][:, None] != ids[to][None]) | (node[rows][:, None] != node[to][None]))) @ copies[to]
        return pa.table({"vec_id": pa.array(ids[asks], pa.int64()), "node": pa.array(node[asks], pa.int64()), "others": pa.array(others[asks], pa.int64())})

    columns = ["big", "bundle", "a", "b", "asks", "component", "vec_id", "node", "copies", "embedding"]
    tiles = asking.select(columns).unionByName(held.select(columns)).groupBy("big", "bundle", "a", "b")
    # A vec_id may be that of several vectors: the most links of them are its.
    counts = tiles.applyInArrow(compare, "vec_id bigint, node bigint, others bigint").groupBy("vec_id", "node").agg(F.sum("others").alias("others"))
    return counts.groupBy("vec_id").agg(F.max("others").alias("others"))


def _exact(nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    """(vec_id, root) by comparing each node with all nodes that can be in range.

    A node has its home at its nearest centre, and asks the homes of all centres whose side of the bisecting plane is
    within the threshold's angle of it; no link can lead elsewhere. Homes and their askers are cut by hash into blocks.
    """
    found = centres(_unit(vectors.sample(nodes, SAMPLE)), max(1, min(EXACT_CELLS, -(-n // CELL))), threshold)
    apart = np.sqrt(np.maximum(2 - 2 * found @ found.T, 0) * max(0.0, 1 - threshold**2)) + 1e-6
    schema = "cell int, asks boolean, vec_id bigint, copies bigint, embedding array<double>"

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sims = _unit(vectors.matrix(batch.column(2))) @ found.T
            home = np.argmax(sims, axis=1)
            row, cell = np.nonzero(sims.max(axis=1)[:, None] - sims <= apart[home]) if threshold >= 0 else np.nonzero(np.ones(sims.shape, bool))
            row, cell = np.concatenate([np.arange(len(home)), row]), np.concatenate([home, cell])
            asks = pa.array(np.arange(len(row)) >= len(home))
            for a in range(0, len(row), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(cell[a : a + 2000], pa.int32()), asks[a : a + 2000], *(c.take(pa.array(row[a : a + 2000])) for c in batch.columns)], names=["cell", "asks", *batch.schema.names])

    dealt = nodes.mapInArrow(deal, schema)
    cuts = dealt.groupBy("cell").agg(*(F.ceil(F.count_if(side) / BLOCK).cast("int").alias(name) for side, name in ((~F.col("asks"), "parts"), (F.col("asks"), "blocks"))))
    dealt = dealt.join(F.broadcast(_kept(cuts.where("parts > 0"))), "cell")
    mine = lambda count: F.array(F.pmod(F.xxhash64("embedding"), F.col(count)).cast("int"))
    all_ = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("asks"), all_("parts")).otherwise(mine("parts"))))
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("asks"), mine("blocks")).otherwise(all_("blocks")))).withColumn("node", F.xxhash64("embedding"))

    def compare(group: pa.Table) -> pa.Table:
        asks = np.array(group.column("asks").to_pylist(), bool)
        ids, node, copies = (group.column(c).to_numpy() for c in ("vec_id", "node", "copies"))
        x = _unit(vectors.matrix(group.column("embedding")))
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        others, root = np.zeros(len(ids), np.int64), ids.copy()
        pairs = []
        for a in range(0, len(left) if len(right) else 0, 256):
            rows = left[a : a + 256]
            sims = x[rows] @ x[right].T
            hit = sims >= threshold
            for i, j in zip(*np.nonzero(np.abs(sims - threshold) <= ROUNDING), strict=True):
                hit[i, j] = float((x[rows[i]] * x[right[j]]).sum()) >= threshold
            hit &= (ids[rows][:, None] != ids[right][None]) | (node[rows][:, None] != node[right][None])
            others[rows] = hit @ copies[right]
            pairs.append(np.packbits(hit, axis=1))
        changed = True
        while changed:  # smallest ids spread along the links
            before = root.copy()
            for k, bits in enumerate(pairs):
                rows = left[k * 256 : k * 256 + 256]
                for i, mask in zip(rows.tolist(), np.unpackbits(bits, axis=1, count=len(right)).astype(bool), strict=True):
                    if others[i]:
                        to = right[mask]
                        root[i] = least = min(root[i], root[to].min())
                        root[to] = least
            changed = bool((root != before).any())
        return pa.table({"vec_id": pa.array(ids, pa.int64()), "root": pa.array(root, pa.int64())})

    columns = ["cell", "part", "block", "asks", "vec_id", "node", "copies", "embedding"]
    return _kept(dealt.select(columns).groupBy("cell", "part", "block").applyInArrow(compare, "vec_id bigint, root bigint").where("root <> vec_id"))


def linked(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row with a vec_id.

    Vectors that are null, zero, hold a null or non-finite component, or have another length than most rows link with
    nothing. Rows without vec_id have no result and link with nothing. A vec_id that repeats is one vector for each of
    its rows, and each row has the same result, with the most links of them; copies of a vector count as links of one
    another. An empty table gives no rows. Other columns are not looked at.
    """
    since = mark()
    good = vectors.of_main_length(rows)
    nodes = _kept(good.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).select("vec_id", "copies", "embedding"))
    n, overlap, beam = nodes.count(), OVERLAP, BEAM
    if not n:
        own = rows.where("vec_id IS NOT NULL").select("vec_id")
        return own.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    nodes, real = _kept(nodes.unionByName(_planted(nodes, threshold))), nodes
    tries: list[DataFrame] = []
    for turn in range(TRIES):
        tries.append(_kept(_search(cells(nodes, n, overlap, threshold), beam, threshold).withColumn("turn", F.lit(turn))))
        found = reduce(DataFrame.unionByName, tries)
        # A link found from one end is found: the larger of the two counts is a lower bound.
        sums = found.groupBy("vec_id", "turn").agg(F.sum("others").alias("others"), F.sum("back").alias("back"))
        counts = _kept(sums.groupBy("vec_id").agg(F.max(F.greatest("others", "back")).alias("others")))
        recall = _audit(nodes, counts, threshold)
        _log.info("recall %.4f with %d cells and a beam of %d", recall, overlap, beam)
        if recall >= GOOD or turn and recall >= AUDIT_RECALL:
            break
        # Cells that are dealt again must get smaller, so a node goes to half of the centres of a level at most.
        overlap, beam = min(overlap * 2, max(OVERLAP, FAN // 2)), beam * 2
    else:
        _log.warning("all nodes that can be in range are compared")
        found = _exact(real, n, threshold)
    nodes, groups = real, _kept(components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))))
    counts, groups = _kept(_counted(nodes, groups, threshold)), groups.withColumnRenamed("node", "rep")
    member = good.join(nodes.select(F.col("vec_id").alias("rep"), "copies", "embedding"), "embedding").select("vec_id", "rep", "copies")
    member = member.join(counts.select(F.col("vec_id").alias("rep"), "others"), "rep", "left").join(groups, "rep", "left")
    known = member.groupBy("vec_id").agg(F.max(F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = rows.where("vec_id IS NOT NULL").select("vec_id").join(known, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return finished(out, since)


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))
