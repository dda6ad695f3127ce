"""Fill-in-middle transformation: texts are cut at places that a hash of doc_id draws, and their parts put in another order.

Cuts are counted in code points, texts are held in UTF-8. Each text is encoded as the maximal runs of one character
class, the class being the bytes that a code point takes, with the code points before each run. A cut's byte is found
by binary search of its run and by arithmetic within it, for all cuts of a batch at once; no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .encoding import groups

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The hash's salt, and percentages: of texts left plain, and of the others with the suffix first.
SEED, PLAIN, SPM = "1", 10, 20

#: The class of a code point by its first byte; 0 for bytes that continue one.
_CLASS = np.zeros(256, np.uint8)
_CLASS[:0x80], _CLASS[0xC0:0xE0], _CLASS[0xE0:0xF0], _CLASS[0xF0:] = 1, 2, 3, 4


class Runs:
    """Run-length encoding of the classes of ``texts``, one after another; a run ends where its text does.

    Run r has ``units[r]`` code points before it, begins at byte ``at[r]`` and holds code points of ``width[r]`` bytes.
    Text d has the code points ``first[d]:first[d + 1]``, and its bytes in ``data`` begin at ``offsets[d]``.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = off - off[0]
        kinds = _CLASS[self.data]
        starts = np.flatnonzero(kinds)
        kinds = kinds[starts]
        self.first = np.searchsorted(starts, self.offsets)
        new = np.ones(len(starts), bool)
        new[1:] = kinds[1:] != kinds[:-1]
        new[self.first[self.first < len(starts)]] = True
        self.units = np.flatnonzero(new)
        self.at, self.width = starts[self.units], kinds[self.units].astype(np.int64)

    def bytes_at(self, units: np.ndarray) -> np.ndarray:
        """The byte at which each of ``units`` (counted over all texts) begins; the end of a text is the next one's start."""
        if not len(self.units):
            return np.zeros(len(units), np.int64)
        run = np.searchsorted(self.units, units, side="right") - 1
        return self.at[run] + (units - self.units[run]) * self.width[run]


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of 32 bits from a hash of ``seed`` and the decimal ``doc_id`` (null: empty)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def transformed(docs: DataFrame, seed: str = SEED, plain: int = PLAIN, spm: int = SPM) -> DataFrame:
    """doc_id, text, form, n, prefix_chars, middle_chars: every document (null text: empty) with its text transformed.

    psm is prefix, suffix, middle, spm is suffix, prefix, middle, each part after its mark; plain is the text itself,
    where it is empty, has a mark in it already, or was drawn to stay. n counts the text's code points; the parts' are
    null where it is plain. Each row is transformed by itself: rows that repeat give the same, a text may have any
    length, an empty table gives an empty one, and other columns are not looked at.
    """
    a, b, c, d = draws(F.col("doc_id"), seed)
    text = F.coalesce("text", F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (c % 100 >= 100 - plain), "plain").when(d % 100 < spm, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), form.alias("form"), a.alias("a"), b.alias("b"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in groups(batch.column(1)):
                yield _cut(batch.slice(lo, hi - lo))

    return rows.mapInArrow(cut, "doc_id bigint, text string, form string, n bigint, prefix_chars bigint, middle_chars bigint")


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, texts, form, a, b = batch.columns
    runs, is_plain = Runs(texts), pc.equal(form, "plain").to_numpy(zero_copy_only=False)
    n = np.diff(runs.first)
    both = np.sort(np.stack([x.to_numpy() % (n + 1) for x in (a, b)]), axis=0)
    low, high = (runs.bytes_at(runs.first[:-1] + x) for x in both)
    data, start, end = runs.data.tobytes(), runs.offsets[:-1], runs.offsets[1:]
    p, s, m, out = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode(), []
    for kind, i, j, k, z in zip(form.to_pylist(), *(x.tolist() for x in (start, low, high, end)), strict=True):
        if kind == "plain":
            out.append(data[i:z])
        elif kind == "psm":
            out.append(b"".join((p, data[i:j], s, data[k:z], m, data[j:k])))
        else:
            out.append(b"".join((s, data[k:z], p, data[i:j], m, data[j:k])))
    chars = [pa.array(x, pa.int64(), mask=is_plain) for x in (both[0], both[1] - both[0])]
    return pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary()).cast(pa.string()), form, pa.array(n, pa.int64()), *chars], names=["doc_id", "text", "form", "n", "prefix_chars", "middle_chars"])


def restored(text: Column, form: Column) -> Column:
    """The text that ``transformed`` was given, from its output and form alone. Parts have no marks: a text with one stays plain."""
    part = F.split(text, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(part, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, third, second)).when(form == "spm", F.concat(second, third, first)).otherwise(text)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transformed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("text", 256).alias("output_sha256"), F.sha2(restored(F.col("text"), F.col("form")), 256).alias("restored_sha256"))
