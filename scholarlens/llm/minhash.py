"""Near-duplicate documents by bottom-k sketches.

One hash function on word shingles; a sketch is the K smallest values of a set. Two sets that are similar enough share
at least NEED retained values (sets so small that their partners are all retained too: the threshold's share of the
set), so under one order of all values it is enough to post the ``size - NEED + 1`` first: a link always meets in an inverted list. The order
puts values rare in the corpus first, by a table of counters of fixed size, so that common passages make few lists.

Lists are not expanded into pairs. Every document of a list is first compared with the list's hub, the document whose
posted values are the most common, which copies of one text tend to share. What these links leave in different
components is then compared exhaustively: in each list all documents outside its largest component against all of the
list, in tiles of bounded size, so that no link between components is lost. Comparisons estimate similarity on the
union's sketch and confirm it on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import compact, finished, mark, table
from .encoding import groups, release
from .graph import components

#: Retained values, and how many of them a link shares: a pair of large sets at a similarity of exactly 0.8 shares
#: fewer than 70 of 128 with a probability under 1e-8.
K, NEED = 128, 70
#: Counters of the fixed table that orders values by how common they are (2 MB in every task).
COUNTERS = 1 << 18
#: Documents on the two sides of a tile, about.
LEFT, RIGHT = 64, 256
#: Retained values that the comparison across components sends along.
SENT = 64
#: A pair is dropped without its full sets if the estimate is lower than the threshold by this much, five deviations (of K
#: and of SENT values).
SLACK, SENT_SLACK = 0.18, 0.25


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words than ``width`` the whole sequence is one."""
    w = words.scan(texts, lower=True)
    rolled, out = words.rolling(w.hashes, width), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        else:
            out.append(words.rolling(w.hashes[a:b], b - a) + np.uint64(b - a) if b > a else np.zeros(0, np.uint64))
    return out


#: Retained values are kept as their 48 highest bits; a false meeting costs a comparison.
BITS, BYTES = np.uint64(16), 6


def _pack(values: np.ndarray) -> bytes:
    return (values >> BITS).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // BYTES, 8), np.uint8)
    out[:, :BYTES] = np.frombuffer(data, np.uint8).reshape(-1, BYTES)
    return out.view("<u8").ravel()


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (set size), two hashes of the whole set, and the retained values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            n, one, two, low = [], [], [], []
            texts = batch.column(1)
            for s in (s for a, b in groups(texts) for s in shingle_sets(texts[a:b], width)):
                n.append(len(s))
                one.append(np.add.reduce(words.mix(s)).astype(np.int64))
                two.append(np.add.reduce(words.mix(s ^ np.uint64(0x5851F42D4C957F2D))).astype(np.int64))
                low.append(_pack(s[:K]))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, one, two)), pa.array(low, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "one", "two", "low"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, one bigint, two bigint, low binary")


def _counter(values: np.ndarray) -> np.ndarray:
    return (words.mix(values) & np.uint64(COUNTERS - 1)).astype(np.int64)


def _counters(rows: DataFrame) -> np.ndarray:
    """How many retained values fall on each counter: at most COUNTERS rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            total += np.bincount(_counter(_unpack(b"".join(batch.column(0).to_pylist()))), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(COUNTERS, np.int64)
    found = rows.select("low").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out


def posts(rows: DataFrame, percent: int) -> DataFrame:
    """(value, doc_id, n, weight) of the values that a document posts; the weight is how common they are on the whole."""
    common = _counters(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, values, weight = [], [], []
            for n, low in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                v = _unpack(low)
                # a partner of up to n * 100 / percent may be larger than K and lack values that it shares
                need = -(-percent * n // 100) if 100 * n <= percent * K else NEED
                seen = common[_counter(v)]
                order = np.lexsort((v, seen))[: len(v) - need + 1]
                values.append(v[order])
                size.append(len(order))
                weight.append(np.log(seen[order]).sum())
            row = pa.array(np.repeat(np.arange(len(size)), size))
            flat = np.concatenate([*values, np.zeros(0, "<u8")]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column(0).take(row), batch.column(1).take(row).cast(pa.int32()), pa.array(weight, pa.float32()).take(row)], names=["value", "doc_id", "n", "weight"])

    return rows.select("doc_id", "n", "low").mapInArrow(run, "value bigint, doc_id bigint, n int, weight float")


def _member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of ``keys`` are in the sorted ``among``, which is not empty."""
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def estimated(left: tuple[int, np.ndarray], sizes: np.ndarray, flat: np.ndarray, starts: np.ndarray, percent: int, slack: float = SLACK) -> np.ndarray:
    """Which of the right sets may be linked with the left one, by sizes and by the union's sketch.

    A set is its size and its retained values (all of a small set); the right ones stand in ``flat``. Below the smaller
    of two largest retained values both sketches are whole, so the union's sketch is known there; for two small sets it
    is the union.
    """
    n, low = left
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    ends = np.append(starts[1:], len(flat)) - 1
    to_left = low[-1] if n > len(low) else most
    to = np.minimum(np.where(sizes > ends - starts + 1, flat[ends], most), to_left)
    same = np.add.reduceat(_member(flat, low).astype(np.int64), starts)
    right = np.add.reduceat((flat <= to_left).astype(np.int64), starts)
    union = np.searchsorted(low, to, side="right") + right - same
    close = 100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)
    return close & np.where(to == most, 100 * same >= percent * union, same >= (percent / 100 - slack) * union)


def forest(tile: pa.Table, width: int, percent: int) -> list[tuple[int, int]]:
    """Links between left and right texts of a tile, as few as keep them connected."""
    sides = np.array(tile.column("side").to_pylist(), np.int64)
    ids, unpack = tile.column("doc_id").to_pylist(), zstandard.ZstdDecompressor()
    sets = shingle_sets(pa.array([unpack.decompress(z).decode() for z in tile.column("z").to_pylist()], pa.string()), width)
    rights = np.flatnonzero((sides == 1) & np.array([len(s) > 0 for s in sets]))
    out, root = [], {i: i for i in ids}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    if not len(rights):
        return out
    low = [sets[j][:K] for j in rights]
    flat, sizes = np.concatenate(low), np.array([len(sets[j]) for j in rights])
    starts = np.cumsum([0] + [len(x) for x in low[:-1]])
    for i in np.flatnonzero(sides == 0).tolist():
        a = sets[i]
        if not len(a):
            continue
        for j in rights[estimated((len(a), a[:K]), sizes, flat, starts, percent)].tolist():
            x, y = find(ids[i]), find(ids[j])
            if x != y:
                same = int(_member(sets[j], a).sum())
                if 100 * same >= percent * (len(a) + len(sets[j]) - same):
                    root[max(x, y)] = min(x, y)
                    out.append((ids[i], ids[j]))
    return out


TILE = ["k1", "k2", "k3"]


def verified(tiles: DataFrame, docs: DataFrame, width: int, percent: int, few: bool = False) -> DataFrame:
    """Links (a, b) of ``tiles`` (k1, k2, k3, side, doc_id), confirmed on the full sets of whole texts.

    With ``few`` the texts are first cut down to the tiles' documents: where Spark finds their ids small enough to
    broadcast, the other texts are not shuffled.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([z.compress(t.encode("utf-8", "replace")) for t in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "z"])

    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(pack, "doc_id bigint, z binary")
    if few:
        texts = texts.join(compact(tiles.select("doc_id").distinct()), "doc_id", "left_semi")

    def run(rows: pa.Table) -> pa.Table:
        links = forest(rows, width, percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return tiles.join(texts, "doc_id").select(*TILE, "side", "doc_id", "z").groupBy(*TILE).applyInArrow(run, "a bigint, b bigint")


def possible(tiles: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``tiles`` (k1, k2, k3, side, doc_id, component) without the documents that the sketches rule out."""

    def run(tile: pa.Table) -> pa.Table:
        sides, ids, home = (np.array(tile.column(c).to_pylist(), np.int64) for c in ("side", "doc_id", "component"))
        n, low = np.array(tile.column("n").to_pylist(), np.int64), [_unpack(x) for x in tile.column("low").to_pylist()]
        rights, stay = np.flatnonzero(sides == 1), np.zeros(len(ids), bool)
        if len(rights):
            mine = [low[j] for j in rights]
            flat, starts = np.concatenate(mine), np.cumsum([0] + [len(x) for x in mine[:-1]])
            for i in np.flatnonzero(sides == 0).tolist():
                hit = rights[estimated((n[i], low[i]), n[rights], flat, starts, percent, SENT_SLACK) & (home[rights] != home[i])]
                stay[hit] = True
                stay[i] |= len(hit) > 0
        return tile.select([*TILE, "side", "doc_id"]).filter(pa.array(stay))

    held = tiles.join(rows.select("doc_id", "n", F.substring("low", 1, SENT * BYTES).alias("low")), "doc_id").select(*TILE, "side", "doc_id", "component", "n", "low")
    return held.groupBy(*TILE).applyInArrow(run, "k1 bigint, k2 bigint, k3 bigint, side int, doc_id bigint")


def _hub_tiles(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's documents of a like size against its hub, a hub's documents dealt over tiles."""
    close = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    pairs = lists.where((F.col("hub") != F.col("doc_id")) & close).select("hub", "doc_id").distinct()
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / RIGHT).alias("parts"))
    right = pairs.join(sizes, "hub").select(F.col("hub").alias("k1"), F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("k2"), "doc_id")
    left = right.select("k1", "k2").distinct().withColumn("doc_id", F.col("k1"))
    shown = lambda side: ("k1", "k2", F.lit(0).cast("bigint").alias("k3"), F.lit(side).alias("side"), "doc_id")
    return right.select(*shown(1)).unionByName(left.select(*shown(0)))


def _split_tiles(lists: DataFrame, found: DataFrame) -> DataFrame:
    """In lists of more than one component: what is outside the largest against all of the list.

    Outsiders of lists with the same largest component go together, LEFT at a time. The lists are cut by a hash of the
    document into a power of two of parts of about RIGHT, so that lists with the same documents have the same parts.
    """
    named = lists.select("value", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("value", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    parts = named.groupBy("value", "component").agg(F.count("*").alias("m"))
    split = parts.groupBy("value").agg(F.sum("m").alias("size"), F.count("*").alias("n"), F.max(F.struct("m", "component")).alias("most")).where("n > 1")
    apart = compact(named.join(split.select("value", "size", F.col("most.component").alias("major")), "value"))
    outside = apart.where("component <> major")
    homes = outside.groupBy("doc_id").agg(F.min("major").alias("k1"), F.first("component").alias("component"))
    groups = homes.groupBy("k1").agg(F.ceil(F.count("*") / LEFT).alias("parts"))
    homes = homes.join(groups, "k1").select("k1", F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("k2"), "doc_id", "component")
    cuts = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.col("size") / RIGHT)), F.lit(0))).cast("bigint")
    blocks = apart.withColumn("cuts", cuts).withColumn("k3", F.col("cuts") + F.pmod(F.xxhash64("doc_id"), F.col("cuts")))
    blocks = blocks.groupBy("value", "k3").agg(F.collect_list(F.struct("doc_id", "component")).alias("held"))
    wanted = outside.select("value", "doc_id").join(homes.select("k1", "k2", "doc_id"), "doc_id").select("k1", "k2", "value").distinct()
    right = wanted.join(blocks, "value").groupBy(*TILE).agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"))
    right = compact(right)
    left = right.select(*TILE).join(homes, ["k1", "k2"]).select(*TILE, F.lit(0).alias("side"), "doc_id", "component")
    return right.select(*TILE, F.lit(1).alias("side"), F.inline("held")).unionByName(left)


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Rows without words or text link with nothing. A row without doc_id cannot be named by a link: its component is
    null and it is kept. Repeated rows share their doc_id, so they are one node and each is kept or dropped alike, with
    the size of its own set. Texts of any length have one set. Other columns, of whatever names, are not looked at; an
    empty table gives an empty one. What is stored on the way is removed.
    """
    since = mark()
    rows = compact(sketches(docs, width), 50_000)
    sets = rows.where("n > 0 AND doc_id IS NOT NULL")
    same = sets.groupBy("n", "one", "two").agg(F.min("doc_id").alias("rep"))
    copies = sets.select("doc_id", "n", "one", "two").join(same, ["n", "one", "two"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    posted = posts(sets, percent)
    hubs = posted.groupBy("value").agg(F.count("*").alias("size"), F.max(F.struct("weight", (-F.col("doc_id")).alias("o"), "n")).alias("h")).where("size > 1")
    lists = compact(posted.select("value", "doc_id", "n").join(hubs.select("value", (-F.col("h.o")).alias("hub"), F.col("h.n").alias("hub_n")), "value"))
    links = compact(verified(_hub_tiles(lists, percent), docs, width, percent).unionByName(copies))
    found = components(links)
    rest = compact(possible(_split_tiles(lists, found), sets, percent))
    late = compact(verified(rest, docs, width, percent, few=True)) if rest.take(1) else None
    if late is not None and late.take(1):
        found = components(links.unionByName(late))
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    return finished(out, since)


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows of a class but its smallest doc_id's; all columns keep their values."""
    gone = compact(classes(docs, width, percent).where("NOT kept").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"), width=4, percent=80)
