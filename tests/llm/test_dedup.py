import hashlib
import random

import pytest

from scholarlens.llm import graph, minhash, substring

from .helpers import components, documents, messy, near_classes, prose, without_repeats, words


def check_classes(spark, texts, ids, width=4):
    want = near_classes(texts, ids, width, 80)
    got = minhash.classes(documents(spark, texts, ids), width, 80).collect()
    assert sorted(r.doc_id for r in got) == sorted(ids)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_classes(spark):
    texts = messy()
    check_classes(spark, texts, [i * 3 for i in range(len(texts))])


def chain(rng, n, size, step):
    """Texts that each differ a little from the one before."""
    w, out = prose(rng, size).split(), []
    for _ in range(n):
        for _ in range(step):
            w[rng.randrange(size)] = f"y{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size", [60, 150, 700])
def test_chains_and_wide_groups(spark, size):
    rng = random.Random(size)
    texts = chain(rng, 30, size, max(1, size // 60))
    base = prose(rng, size)
    for _ in range(60):  # copies of one text, many of them not close to each other
        w = base.split()
        for k in range(rng.randrange(0, max(2, size // 25))):
            w[rng.randrange(size)] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    common = prose(rng, size // 2)
    texts += [f"{common} {prose(rng, size // 3)}" for _ in range(40)]  # a long passage in unlike texts
    rng.shuffle(texts)
    check_classes(spark, texts, list(range(len(texts))))


def test_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LEFT", 3)
    monkeypatch.setattr(minhash, "RIGHT", 4)
    test_chains_and_wide_groups(spark, 60)


def test_small_sets_in_larger_ones(spark):
    """Sets of up to K shingles with partners above K, beside many texts that make the values they share common."""
    rng, texts = random.Random(12), []
    for small, large in ((123, 153), (124, 155), (125, 156), (126, 157), (127, 158), (128, 160), (128, 159), (128, 160)):
        w = prose(rng, large + 3, 10**6).split()  # a set of n shingles of 4 words has n + 3 words
        texts.append(" ".join(w[: small + 3]))
        # unlike each other by their ends, and of the same start as the small one
        texts += [" ".join([*w[:-1], f"v{k}"]) for k in range(30)]
    check_classes(spark, texts, random.Random(5).sample(range(len(texts)), len(texts)))


def test_pairs_of_all_sizes_about_the_sketch(spark):
    """Pairs alone in their words, of 100 to 128 shingles with 128 to 200, at a similarity just at or above 0.8."""
    rng, texts, want = random.Random(13), [], []
    for small in range(100, 129, 2):
        for large in sorted({128, 129, 135, 140, 150, 155, 158, 159, 160, small * 5 // 4, 170, 200}):
            # the small one's last shingles are its own, as many as 0.8 allows
            own = next((o for o in range(small, -1, -1) if 100 * (small - o) >= 80 * (large + o)), None)
            if own is None:
                continue
            tag = f"p{len(texts)}"
            words = [f"{tag}w{rng.randrange(10**9)}" for _ in range(large + 3)]
            rest = [f"{tag}x{k}" for k in range(own)]
            texts += [" ".join([*words[: small - own + 3], *rest]), " ".join(words)]
            want.append((len(texts) - 2, len(texts) - 1))
    ids = list(range(len(texts)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.classes(documents(spark, texts, ids), 4, 80).collect()}
    assert len(want) > 60 and all(got[b][1] == a for a, b in want)
    assert {i: got[i][1] for i in ids} == near_classes_of_pairs(texts, want)


def near_classes_of_pairs(texts, pairs):
    from .helpers import shingles

    out = {i: i for i in range(len(texts))}
    for a, b in pairs:
        x, y = shingles(texts[a], 4), shingles(texts[b], 4)
        assert 80 * len(x | y) <= 100 * len(x & y) < 86 * len(x | y)
        out[b] = a
    return out


def test_class_edges(spark):
    docs = documents(spark, ["a b c d e f"] * 3 + [None, "", "a b c d e f"], [5, 5, 2, 3, 4, None])
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id, r.kept) for r in minhash.classes(docs, 5).collect())
    assert got == [(-1, 2, None, True), (2, 2, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 2, 2, False), (5, 2, 2, False)]
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 3, 4]
    assert minhash.classes(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 420)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = components({x for link in links for x in link}, links)
    assert got == {k: v for k, v in want.items() if k != v}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def check_repeats(spark, texts, ids, width=13):
    got = {r.doc_id: r for r in substring.digest(documents(spark, texts, ids), width).collect()}
    for i, (w, gone) in without_repeats(texts, ids, width).items():
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("size", [2_000, 8_000_000])
def test_repeats(spark, monkeypatch, size):
    monkeypatch.setattr(substring, "BLOCK_BYTES", size)
    monkeypatch.setattr(substring, "SHARD_BYTES", size)
    texts = messy()
    check_repeats(spark, texts, random.Random(4).sample(range(1000), len(texts)))


def test_passages_that_overlap(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 1_500)
    rng = random.Random(6)
    source = [prose(rng, 200, 50).split() for _ in range(3)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            s, a = rng.choice(source), rng.randrange(180)
            parts += s[a : a + rng.randrange(5, 40)]
        texts.append(" ".join(parts))
    check_repeats(spark, texts, list(range(len(texts))))


def sequence(texts, ids, width=13):
    import numpy as np
    import pyarrow as pa

    order = sorted(range(len(ids)), key=lambda k: ids[k])
    return substring.Text(np.array([ids[k] for k in order], np.int64), pa.array([texts[k] for k in order], pa.string()), width), [words(texts[k]) for k in order]


def test_factors_are_copies_of_one_place():
    """Each factor is as long as the words at its place agree, and starts at the first place of a smaller document."""
    rng = random.Random(8)
    pool = prose(rng, 400, 60).split()
    texts = [" ".join(w for _ in range(4) for a in [rng.randrange(360)] for w in pool[a : a + rng.randrange(8, 40)]) for _ in range(50)]
    text, lists = sequence(texts, list(range(50)))
    flat, doc = [w for x in lists for w in x], [d for d, x in enumerate(lists) for _ in x]
    start, end, place = (x.tolist() for x in substring.own_factors(text))
    assert len(start) > 50
    for a, e, p in zip(start, end, place, strict=True):
        assert doc[p] < doc[a] == doc[e - 1] and e - a >= 13 and doc[p + e - a - 1] == doc[p]
        assert flat[a:e] == flat[p : p + e - a]
        assert e == len(flat) or p + e - a == len(flat) or doc[e] != doc[a] or doc[p + e - a] != doc[p] or flat[e] != flat[p + e - a]
        assert p == next(q for q in range(len(flat)) if flat[q : q + 13] == flat[a : a + 13] and doc[min(q + 12, len(flat) - 1)] == doc[q])


def test_sources_decide(monkeypatch):
    """A factor whose place has other words, or whose hash alone agrees, removes nothing."""
    import numpy as np

    long = " ".join(f"w{k}" for k in range(30))
    text, _ = sequence([long, f"x {long}", "y " * 40], [1, 2, 3])
    assert [x.tolist() for x in substring.own_factors(text)] == [[31], [61], [0]]
    wrong = substring.parse(text, np.array([31, 32]), np.array([61, 1]), text)
    assert [x.tolist() for x in wrong] == [[32], [61], [1]]
    monkeypatch.setattr(substring.Text, "run", lambda self, start, length: start * 0)
    assert [x.tolist() for x in substring.parse(text, np.array([31]), np.array([62]), text)] == [[], [], []]
    assert [x.tolist() for x in substring.parse(text, np.array([31]), np.array([0]), text)] == [[31], [61], [0]]


def test_many_blocks_ask_for_one_passage(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 300)
    monkeypatch.setattr(substring, "ASKING", 4)
    rng = random.Random(9)
    passage = prose(rng, 30)
    texts = [f"{prose(rng, 10)} {passage if k % 3 else passage[k:]} {prose(rng, 5)}" for k in range(120)]
    check_repeats(spark, texts, rng.sample(range(1000), len(texts)))


def test_columns_keep_their_values(spark):
    long = " ".join(f"w{k}" for k in range(20))
    docs = documents(spark, [long, f"a {long}"], [1, 2]).selectExpr("*", "777 AS BLOCK_", "'mine' AS reference")
    assert [(r.doc_id, r.text, r.block, r.BLOCK_, r.reference) for r in substring.without_repeats(docs).orderBy("doc_id").collect()] == [(1, long, 1, 777, "mine"), (2, "a", 1, 777, "mine")]


def test_text_longer_than_a_block(spark):
    rng = random.Random(10)
    huge = prose(rng, 1_300_000, 10**6)
    assert len(huge) > 2 * substring.BLOCK_BYTES
    middle = " ".join(huge.split()[600_000:600_040])
    got = {r.doc_id: r for r in substring.digest(documents(spark, [huge, f"q {middle} r", f"{middle} {huge}"], [5, 3, 9])).collect()}
    assert [(got[i].n_words, got[i].n_removed) for i in (3, 5, 9)] == [(42, 0), (1_300_000, 40), (1_300_040, 1_300_040)]


def test_repeat_edges(spark):
    long = " ".join(f"w{k}" for k in range(20))
    docs = documents(spark, [long, long, long, None, "", f"new {long}  tail\n", long], [4, 2, 2, 6, 7, 5, None])
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.digest(docs).collect())
    assert got == [(2, 20, 0), (2, 20, 0), (4, 20, 20), (5, 22, 20), (6, 0, 0), (7, 0, 0)]
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in out.collect() if r.text is not None) == [(-1, long), (2, long), (2, long), (5, "new tail"), (7, "")]
    assert substring.digest(docs.limit(0)).count() == 0


def test_words_are_the_contract_s():
    import pyarrow as pa

    from scholarlens.llm import words as scan

    texts = messy()
    w = scan.scan(pa.array(texts))
    got = [[w.data[w.starts[k] : w.ends[k]].tobytes().decode() for k in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
    assert got == [words(t) for t in texts]
    by_hash = {}
    for d, found in enumerate(got):
        for k, x in zip(range(w.first[d], w.first[d + 1]), found, strict=True):
            assert by_hash.setdefault(w.hashes[k], x) == x
