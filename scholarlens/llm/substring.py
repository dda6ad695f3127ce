"""Repeated passages by relative Lempel-Ziv parsing.

The corpus is dealt into reference blocks of bounded size. A document is factored greedily against its own block and
against every other block that can hold a factor of it: a factor starts at a window of WINDOW words that the block has
in a smaller document, at the first place there, and takes the next word as long as the words themselves agree. At a
factor's end the windows that reach across the boundary are tried one by one, so factors may overlap. The words that
factors of WINDOW words or more cover are removed; nothing else is.

No pair of blocks meets for nothing. A directory of window hashes, dealt over shards, names the block of the smallest
document that has a window:

1. Each block sends one entry for each of its anchors (the smallest k-gram hash of every window), once a block however
   often it occurs; a shard answers which anchors another document has too.
2. Each block sends the windows that hold such an anchor, with the smallest document of the block that has them. The
   shard tells each block which of them start in a smaller document of another block, and which block that is; and it
   tells that block which of its windows are asked for.
3. Each block sends its stretches of text with such windows to the blocks named, and its stretches that are asked for
   to be parsed against.
4. The asking stretches are factored against the index of the stretches asked for. Blocks ask in groups of ASKING, so
   what everybody asks for is indexed once for each group and no key gathers the corpus.
5. Each block factors its documents against itself and removes what its own and the others' factors cover.

Only a block's smallest document with a window asks other blocks for it: its other documents find it in the block.

Hashes steer the search alone, every factor is compared word by word, so nothing is removed by a collision; a repeated
window is overlooked only if its 64-bit hash is that of a different window of another document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import fresh, table, text_bytes
from .encoding import release

WINDOW, ANCHOR = 13, 6
#: Bytes of text in a block (a longer document is a block of its own size), and text whose entries make a shard.
BLOCK_BYTES, SHARD_BYTES = 4_000_000, 24_000_000
#: Blocks whose stretches are parsed together against those of one block.
ASKING = 64

_ENTRY = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("many", pa.binary())])
_ANSWER = pa.schema([("block", pa.int32()), ("asks", pa.bool_()), ("keys", pa.binary()), ("other", pa.binary())])
_STRETCH = pa.schema([("reference", pa.int32()), ("part", pa.int32()), ("asks", pa.bool_()), ("block", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("words", pa.binary())])
_SPAN = pa.schema([("block", pa.int32()), ("starts", pa.binary()), ("ends", pa.binary())])
ENTRY = "shard int, block int, keys binary, docs binary, many binary"
ANSWER = "block int, asks boolean, keys binary, other binary"
STRETCH = "reference int, part int, asks boolean, block int, doc_id bigint, first bigint, words binary"
SPAN = "block int, starts binary, ends binary"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Text:
    """Texts by ascending doc_id with their words, their windows, and hashes of every run of words."""

    def __init__(self, doc_ids: np.ndarray, texts: pa.Array, width: int):
        self.ids, self.width = doc_ids, width
        self.words = w = words.scan(texts)
        n = max(0, len(w.doc) - width + 1)
        self.at = np.flatnonzero(w.doc[:n] == w.doc[width - 1 :]) if n else np.zeros(0, np.int64)  # words at which a window starts
        self.doc_id = doc_ids[w.doc[self.at]]

    @cached_property
    def keys(self) -> np.ndarray:
        """The hash of each window."""
        return words.rolling(self.words.hashes, self.width)[self.at]

    def anchors(self, size: int) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, np.uint64)
        grams = words.rolling(self.words.hashes, size)
        least = grams[self.at]
        for k in range(1, self.width - size + 1):
            np.minimum(least, grams[self.at + k], out=least)
        return words.mix(least)

    def first_places(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in ascending order, and the word at which each starts first."""
        distinct, first = np.unique(self.keys, return_index=True)
        return distinct, self.at[first]

    @cached_property
    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums from which the hash of any run of words follows, and the inverse powers that shift it."""
        n = len(self.words.hashes)
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]))
        back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BACK, np.uint64)]))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words.hashes * power[:n])]), back

    def run(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        sums, back = self.sums
        return (sums[start + length] - sums[start]) * back[start]

    def ends(self, start: np.ndarray) -> np.ndarray:
        """The word after the last of the text that has ``start``."""
        return self.words.first[self.words.doc[start] + 1]

    def slice(self, start: int, end: int) -> bytes:
        return self.words.data[self.words.starts[start] : self.words.ends[end - 1]].tobytes()


def _agree(a: bytes, b: bytes, length: int) -> int:
    """How many of ``length`` words are the same."""
    if a == b:
        return length
    return next((k for k, (x, y) in enumerate(zip(a.split(), b.split(), strict=True)) if x != y), length)


def parse(asking: Text, at: np.ndarray, source: np.ndarray, reference: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors of the asking texts: first word, end, and the word at which the reference has them.

    ``at`` are the words, in ascending order, at which a factor may start, ``source`` where the reference has their
    windows. All texts are parsed side by side, each from left to right: the factor at the first such word is made as
    long as the words agree, and the next one starts at the first such word whose window the factor does not hold.
    """
    width = asking.width
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    doc = asking.words.doc[at]
    now = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(at) else np.zeros(0, np.int64)
    while len(now):
        start, place = at[now], source[now]
        low = np.zeros(len(now), np.int64)
        high = np.minimum(asking.ends(start) - start, reference.ends(place) - place)
        while (open_ := low < high).any():  # the longest run whose hashes agree
            middle = (low + high + 1) // 2
            same = asking.run(start, middle) == reference.run(place, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        length = np.array([_agree(asking.slice(a, a + n), reference.slice(p, p + n), n) if n >= width else 0 for a, p, n in zip(start.tolist(), place.tolist(), low.tolist(), strict=True)], np.int64)
        long = length >= width
        out.append((start[long], (start + length)[long], place[long]))
        after = np.where(long, start + length - width + 1, start + 1)
        then = np.searchsorted(at, after)
        going = then < len(at)
        going[going] = doc[then[going]] == doc[now[going]]
        now = then[going]
    found = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    order = np.argsort(found[0], kind="stable")
    return found[0][order], found[1][order], found[2][order]


def own_factors(block: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors of a block's documents against its smaller documents."""
    _, first, inverse = np.unique(block.keys, return_index=True, return_inverse=True)
    earlier = first[inverse]
    held = np.flatnonzero(block.doc_id > block.doc_id[earlier])
    return parse(block, block.at[held], block.at[earlier[held]], block)


def factors(asking: Text, reference: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors of the asking texts against the smaller documents of another block."""
    keys, places = reference.first_places()
    if not len(keys) or not len(asking.keys):
        return parse(asking, asking.at[:0], asking.at[:0], reference)
    k = np.minimum(np.searchsorted(keys, asking.keys), len(keys) - 1)
    place = places[k]
    held = (keys[k] == asking.keys) & (reference.ids[reference.words.doc[place]] < asking.doc_id)
    return parse(asking, asking.at[held], place[held], reference)


def _block(rows: pa.Table, width: int) -> tuple[Text, pa.Table]:
    """The block and its rows, in the order of its documents (rows of one doc_id by their texts)."""
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return Text(rows.column("doc_id").to_numpy(), rows.column("text").combine_chunks(), width), rows


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else schema.empty_table()


def _cut(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value that occurs, and where."""
    if not len(values):
        return
    order = np.argsort(values, kind="stable")
    distinct, first = np.unique(values[order], return_index=True)
    yield from zip(distinct.tolist(), np.split(order, first[1:]), strict=True)


def _entries(block: int, keys: np.ndarray, docs: np.ndarray, shards: int) -> pa.Table:
    """One entry for each distinct key, with its smallest document and whether the block has it in another one too.

    ``keys`` are in ascending order of document. Only shards that get an entry get a row.
    """
    if not len(keys):
        return _ENTRY.empty_table()
    order = np.argsort(keys, kind="stable")
    turn = np.flatnonzero(np.diff(keys[order])) + 1
    head, tail = np.append(0, turn), np.append(turn, len(keys)) - 1
    distinct, least, many = keys[order[head]], docs[order[head]], docs[order[tail]] != docs[order[head]]
    shard = (words.mix(distinct) % np.uint64(shards)).astype(np.int32)
    return _rows(_ENTRY, [(s, block, distinct[o].astype("<u8").tobytes(), least[o].astype("<i8").tobytes(), np.packbits(many[o]).tobytes()) for s, o in _cut(shard)])


class Shard:
    """Entries of all blocks whose keys fall on a shard, in ascending order of key and document."""

    def __init__(self, rows: pa.Table):
        keys = [np.frombuffer(x, "<u8") for x in rows.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(rows.column("many").to_pylist(), sizes, strict=True)])
        docs, blocks = np.concatenate([np.frombuffer(x, "<i8") for x in rows.column("docs").to_pylist()]), np.repeat(rows.column("block").to_numpy(), sizes)
        keys = np.concatenate(keys)
        order = np.lexsort((docs, keys))
        self.keys, self.docs, self.many, self.blocks = keys[order], docs[order], many[order], blocks[order]
        self.head = np.flatnonzero(np.concatenate([[True], self.keys[1:] != self.keys[:-1]]))
        self.size = np.diff(np.append(self.head, len(keys)))


def shared(rows: pa.Table) -> pa.Table:
    """For each block the keys of its entries that another document has."""
    s = Shard(rows)
    hit = np.repeat((s.size > 1) | np.logical_or.reduceat(s.many, s.head), s.size)
    keys, blocks = s.keys[hit], s.blocks[hit]
    return _rows(_ANSWER, [(b, True, keys[o].tobytes(), b"") for b, o in _cut(blocks)])


def owners(rows: pa.Table) -> pa.Table:
    """For each block the keys that a smaller document of another block has, and its block; for that block the keys
    that others ask for, and their groups."""
    s = Shard(rows)
    owner = np.repeat(s.blocks[s.head], s.size)
    hit = (s.docs > np.repeat(s.docs[s.head], s.size)) & (s.blocks != owner)
    keys, blocks, owner = s.keys[hit], s.blocks[hit], owner[hit].astype("<i4")
    out = [(b, True, keys[o].tobytes(), owner[o].tobytes()) for b, o in _cut(blocks)]
    wanted = np.unique(np.rec.fromarrays([owner, keys, (blocks // ASKING).astype("<i4")], names="owner,key,part"))
    for b, o in _cut(wanted["owner"]):
        out.append((b, False, wanted["key"][o].astype("<u8").tobytes(), wanted["part"][o].astype("<i4").tobytes()))
    return _rows(_ANSWER, out)


def _keys(answers: pa.Table, asks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the answers in ascending order, and what was said of each."""
    rows = answers.filter(answers.column("asks") if asks else pc.invert(answers.column("asks")))
    keys, other = np.frombuffer(b"".join(rows.column("keys").to_pylist()), "<u8"), np.frombuffer(b"".join(rows.column("other").to_pylist()), "<i4")
    order = np.argsort(keys, kind="stable")
    return keys[order], other[order] if len(other) else other


def _member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of ``keys`` are in the sorted ``among``."""
    if not len(among):
        return np.zeros(len(keys), bool)
    return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys


def stretches(block: Text, number: int, answers: pa.Table) -> pa.Table:
    """What a block asks others, and what others ask of it, each as runs of words."""
    out: list[tuple] = []

    def runs(at: np.ndarray, other: np.ndarray, row) -> None:
        """A row for each run of windows one after another with the same ``other``."""
        turn = np.flatnonzero((at[1:] != at[:-1] + 1) | (other[1:] != other[:-1])) + 1 if len(at) else at
        for a, b in zip([0, *turn.tolist()] if len(at) else [], [*turn.tolist(), len(at)], strict=False):
            first, end = int(at[a]), int(at[b - 1]) + block.width
            out.append((*row(int(other[a])), number, int(block.ids[block.words.doc[first]]), first, block.slice(first, end)))

    keys, places = block.first_places()
    smallest = block.ids[block.words.doc[places]] if len(places) else np.zeros(0, np.int64)
    asked, owner = _keys(answers, True)
    mine = np.flatnonzero(_member(block.keys, asked))
    mine = mine[block.doc_id[mine] == smallest[np.searchsorted(keys, block.keys[mine])]]
    runs(block.at[mine], owner[np.searchsorted(asked, block.keys[mine])], lambda r: (r, number // ASKING, True))
    wanted, part = _keys(answers, False)
    at = places[np.searchsorted(keys, wanted)] if len(wanted) else np.zeros(0, np.int64)
    order = np.lexsort((at, part))
    runs(at[order], part[order], lambda p: (number, p, False))
    return _rows(_STRETCH, out)


def factored(rows: pa.Table, width: int) -> pa.Table:
    """Spans of the asking blocks that factors against the reference's stretches cover.

    The reference is indexed once; stretches ask in turns of about BLOCK_BYTES, however many there are.
    """
    rows = rows.sort_by([("doc_id", "ascending"), ("block", "ascending"), ("first", "ascending")])
    asks = np.array(rows.column("asks").to_pylist(), bool)
    every, known = rows.filter(pa.array(asks)), rows.filter(pa.array(~asks))
    text = lambda x: Text(x.column("doc_id").to_numpy(), x.column("words").combine_chunks().cast(pa.large_binary()).cast(pa.large_string()), width)
    reference, out = text(known), []
    turn = np.cumsum(pc.binary_length(every.column("words")).to_numpy()) // BLOCK_BYTES
    for _, at in _cut(turn):
        some = every.slice(at[0], len(at))
        asking = text(some)
        start, end, _ = factors(asking, reference)
        row = asking.words.doc[start]
        shift = some.column("first").to_numpy()[row] - asking.words.first[row]
        start, end, blocks = start + shift, end + shift, some.column("block").to_numpy()[row]
        out += [(b, start[o].astype("<i8").tobytes(), end[o].astype("<i8").tobytes()) for b, o in _cut(blocks)]
    return _rows(_SPAN, out)


def removed(block: Text, spans: pa.Table) -> np.ndarray:
    """Words of the block that its own factors and the ``spans`` of others cover."""
    turns = np.zeros(len(block.words.starts) + 1, np.int64)
    start, end, _ = own_factors(block)
    for more, column in ((1, "starts"), (-1, "ends")):
        np.add.at(turns, start if more > 0 else end, more)
        np.add.at(turns, np.frombuffer(b"".join(spans.column(column).to_pylist()), "<i8"), more)
    return np.cumsum(turns)[:-1] > 0


def _spans(docs: DataFrame, width: int, finish, schema) -> DataFrame:
    """``finish(block, rows, gone)`` of every block, as a table of ``schema``."""
    size = text_bytes(docs)
    n_blocks, shards = max(1, -(-size // BLOCK_BYTES)), max(1, -(-size // SHARD_BYTES))
    by = fresh(docs, "block")
    blocks = docs.withColumn(by, F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")).groupBy(by)
    anchor = ANCHOR if width > ANCHOR else width

    def anchors(key: tuple, rows: pa.Table) -> pa.Table:
        release()
        b, _ = _block(rows, width)
        return _entries(key[0].as_py(), b.anchors(anchor), b.doc_id, shards)

    def windows(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        if not rows.num_rows:
            return _ENTRY.empty_table()
        b, _ = _block(rows, width)
        held = _member(b.anchors(anchor), _keys(answers, True)[0])
        return _entries(key[0].as_py(), b.keys[held], b.doc_id[held], shards)

    def asked(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        return stretches(_block(rows, width)[0], key[0].as_py(), answers) if rows.num_rows and answers.num_rows else _STRETCH.empty_table()

    def parsed(_: tuple, rows: pa.Table, spans: pa.Table) -> pa.Table:
        release()
        b, rows = _block(rows, width)
        return finish(b, rows, removed(b, spans))

    common = blocks.applyInArrow(anchors, ENTRY).groupBy("shard").applyInArrow(shared, ANSWER)
    named = blocks.cogroup(common.groupBy("block")).applyInArrow(windows, ENTRY).groupBy("shard").applyInArrow(owners, ANSWER)
    sent = blocks.cogroup(named.groupBy("block")).applyInArrow(asked, STRETCH)
    found = sent.groupBy("reference", "part").applyInArrow(lambda rows: factored(rows, width), SPAN)
    return blocks.cogroup(found.groupBy("block")).applyInArrow(parsed, schema)


def _kept(texts: pa.ChunkedArray, block: Text, gone: np.ndarray) -> Iterator[tuple[int, int, bytes | None]]:
    """Words, removed words and what is left (None if all) of each document."""
    first = block.words.first.tolist()
    for d, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        mine = gone[a:b]
        n = int(mine.sum())
        if n:
            yield b - a, n, b" ".join(compress(texts[d].as_buffer().to_pybytes().split(), (~mine).tolist()))
        else:
            yield b - a, 0, None


def digest(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row with a doc_id.

    A null or empty text has no words (the digest of nothing); rows without doc_id have no result. Rows that repeat a
    doc_id are one document's: none is removed for the other's sake. An empty table gives an empty one. A text of any
    length is parsed whole; one longer than a block is a block of its own. Other columns are not looked at.
    """

    def finish(block: Text, rows: pa.Table, gone: np.ndarray) -> pa.Table:
        n_words, n_removed, sha = [], [], []
        texts = rows.column("text")
        for d, (n, removed_words, kept) in enumerate(_kept(texts, block, gone)):
            if kept is None:
                kept = b" ".join((texts[d].as_py() or "").encode().split())
            n_words.append(n)
            n_removed.append(removed_words)
            sha.append(hashlib.sha256(kept).hexdigest())
        return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    return _spans(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), width, finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (what is left joined by blanks); others stay as they are.

    A document of which nothing is left goes. Null and empty texts, and rows without doc_id, stay unchanged; rows that
    repeat a doc_id are one document's. All columns, whatever their names, keep their values.
    """
    columns = docs.columns
    schema = pa.schema([pa.field(n, t) for n, t in zip(columns, _arrow_types(docs), strict=True)])

    def finish(block: Text, rows: pa.Table, gone: np.ndarray) -> pa.Table:
        rows = rows.select(columns)
        texts, stay, new = rows.column("text"), [], []
        for d, (n, removed_words, kept) in enumerate(_kept(texts, block, gone)):
            new.append(texts[d].as_py() if kept is None else kept.decode())
            stay.append(not n or removed_words < n)
        at = columns.index("text")
        rows = rows.set_column(at, schema.field(at), pa.array(new, schema.field(at).type))
        return rows.filter(pa.array(stay, pa.bool_())).cast(schema)

    out = _spans(docs.where("doc_id IS NOT NULL"), width, finish, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
    return out.unionByName(docs.where("doc_id IS NULL"))


def _arrow_types(docs: DataFrame) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(docs.schema).types)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
