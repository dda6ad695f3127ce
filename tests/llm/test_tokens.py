import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scholarlens.llm import bpe, dac, encoding, packing, token_store
from scholarlens.llm.common import stored

from .helpers import documents, messy

BYTES, WORDS = encoding.vocabulary(encoding.BYTE_LEVEL), encoding.vocabulary(encoding.WORDS)


@pytest.fixture(scope="module")
def library():
    return {p: encoding.Library(p).library for p in (BYTES, WORDS)}


def ids(library, path, text):
    return library[path].encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


TEXT = st.text(st.sampled_from(list("ab the'sré1ة日 \n\t\x1c\x85  .,!<|endoftext|>🎉")), max_size=60)


@given(st.lists(TEXT, min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_encoders_agree_with_the_library(texts):
    lib = _LIBRARIES
    for path, words_only in ((BYTES, False), (WORDS, True)):
        got = encoding.encoder(path, words_only).ids(pa.array(texts))
        assert [x.tolist() for x in got] == [ids(lib, path, t) for t in texts]
    for t, (n, a, b) in zip(texts, bpe.encoder(BYTES).digests(pa.array(texts)), strict=True):
        want = ids(lib, BYTES, t)
        assert (n, a) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert b == hashlib.sha256(lib[BYTES].decode(want, skip_special_tokens=False).encode()).hexdigest()


_LIBRARIES = {p: encoding.Library(p).library for p in (BYTES, WORDS)}


@given(st.text(st.sampled_from(list("etaoinshrdlu ")), max_size=80))
@settings(max_examples=200, deadline=None)
def test_dynamic_programming_is_exact(text):
    assert bpe.encoder(BYTES).vocabulary.ids(text) == ids(_LIBRARIES, BYTES, text)


def test_bpe_rows(spark, library):
    texts = messy()
    got = sorted(bpe.encoded(documents(spark, [*texts, "again"], [*range(len(texts)), 0]), BYTES).collect())
    assert len(got) == len(texts) + 1
    for r in got[2:]:
        want = ids(library, BYTES, texts[r.doc_id])
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert bpe.encoded(documents(spark, texts).limit(0), BYTES).count() == 0


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_dac_round_trip(values):
    r = dac.Reader(dac.encode(np.array(values, np.uint64)))
    assert r.all().tolist() == values and [r[i] for i in range(len(r))] == values
    with pytest.raises(IndexError):
        r[len(values)]


def test_token_store(spark, library):
    texts = messy()
    order = random.Random(1).sample(range(len(texts)), len(texts))
    docs = documents(spark, [texts[i] for i in order], [i * 7 for i in order]).repartition(5)
    got = sorted(token_store.documents(stored(token_store.segments(docs, BYTES, 2))).collect())
    start = 0
    for r, t in zip(got, texts, strict=True):
        want = [*ids(library, BYTES, t), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), crc(want))
        start += len(want)


def test_tokens_are_read_by_themselves(spark, library, monkeypatch):
    monkeypatch.setattr(token_store, "PART_BYTES", 20_000)
    monkeypatch.setattr(token_store, "SEGMENT_BYTES", 2_000)
    texts = messy()
    store = stored(token_store.segments(documents(spark, texts), BYTES, 2))
    assert store.count() > 5 and store.select("part").distinct().count() > 1
    rng, whole = random.Random(2), [[*ids(library, BYTES, t), 2] for t in texts]
    asks = [(d, rng.randrange(len(w))) for d, w in enumerate(whole) for _ in range(4)]
    more = [(d, len(w) - 1) for d, w in enumerate(whole)] + [(d, len(w)) for d, w in enumerate(whole)] + [(0, -1), (None, 0), (10**6, 0), (3, None)]
    got = token_store.tokens_at(store, spark.createDataFrame(asks + more, "doc_id bigint, place bigint")).collect()
    assert sorted(map(tuple, got)) == sorted((d, k, whole[d][k]) for d, k in [*asks, *more[: len(whole)]])


def test_token_store_edges(spark):
    docs = documents(spark, ["a", "b", "a", "c"], [5, None, 5, 5])
    got = token_store.documents(stored(token_store.segments(docs, BYTES, 2))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 5, 5, 5] and [r.start for r in got] == [0, 2, 4, 6]
    assert token_store.documents(stored(token_store.segments(docs.limit(0), BYTES, 2))).count() == 0


def test_packing(spark, library):
    texts = messy()
    cut = stored(packing.pieces(documents(spark, texts), WORDS))
    got = sorted(packing.pack(cut).collect())
    at = 0
    for i, t in enumerate(texts):
        want = [*ids(library, WORDS, t), 1]
        for k in range(0, len(want), 4096):
            r, part = got[at], want[k : k + 4096]
            assert (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) == (i, k // 4096, k, len(part), crc(part))
            at += 1
    assert at == len(got)
    assert_gapless(got, 4096)


def assert_gapless(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size


def test_packing_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 3)  # ranks over several salts
    docs = documents(spark, ["same words"] * 50 + [None] * 20, [*range(40), *[7] * 10, *[None] * 20])
    got = packing.pack(stored(packing.pieces(docs, WORDS)), size=8)
    rows = got.collect()
    assert len(rows) == 70 and len({r.sequence_id for r in rows}) == 25  # two of length 3 in each
    assert_gapless(rows, 8)
    assert packing.pack(stored(packing.pieces(docs.limit(0), WORDS))).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
@settings(max_examples=200, deadline=None)
def test_plan_uses_every_piece_once(counts):
    used = Counter()
    for runs, times in packing.plan(counts, 64):
        assert sum(k * n for k, n in runs) <= 64 and times > 0
        for k, n in runs:
            used[k] += n * times
    assert used == Counter(counts)


def test_plan_fills_exactly_where_it_can():
    assert sum(t for _, t in packing.plan({60: 2, 40: 4, 30: 2, 33: 1, 27: 1, 20: 2, 100: 1}, 100)) == 6
    rng = random.Random(5)
    counts = Counter(min(4096, max(1, int(rng.lognormvariate(6.5, 1)))) for _ in range(20_000))
    total = sum(k * n for k, n in counts.items())
    assert sum(t for _, t in packing.plan(counts)) <= -(-total // 4096) * 1.002 + 1
