"""DuckDB SQL of the operators that it can express, over views of the same whole tables.

Tokens and packing have a tokenizer, neighbours sums in another order: those are tested against brute
force. The searches of vectors are approximate by nature, but on tables that SQL can compare pair by pair they are whole.
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all(coalesce({c}, ''), '[^\x20\x09-\x0D]+')"

_SUBSTRING = f"""
    WITH d AS (SELECT doc_id, {_WORDS.format(c="text")} AS w FROM documents),
    i AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
    k AS (SELECT doc_id, s.i, array_to_string(w[s.i:s.i + 12], ' ') AS key FROM d, unnest(range(1, len(w) - 11)) s(i)),
    f AS (SELECT key, min(doc_id) AS first FROM k GROUP BY key),
    g AS (SELECT DISTINCT doc_id, k.i + o.d AS i FROM k JOIN f USING (key), range(13) o(d) WHERE first < doc_id),
    r AS (SELECT i.doc_id, count(*) AS n_words, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY i.i) FILTER (g.i IS NULL) AS kept FROM i LEFT JOIN g ON i.doc_id = g.doc_id AND i.i = g.i GROUP BY i.doc_id)
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)
"""

#: Smallest node that links lead to, from a table ``link`` (a, b) in both directions and ``node`` (id).
_REACHED = "reach AS (SELECT id, id AS root FROM node UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id), least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"

_MINHASH = f"""
    WITH RECURSIVE d AS (SELECT doc_id AS id, {_WORDS.format(c=f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} AS w FROM documents),
    s AS (SELECT DISTINCT id, array_to_string(CASE WHEN len(w) < 4 THEN w ELSE w[o.i:o.i + 3] END, ' ') AS shingle FROM d, unnest(range(1, greatest(len(w) - 2, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) o(i)),
    n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
    p AS (SELECT x.id AS a, y.id AS b, count(*) AS same FROM s x JOIN s y USING (shingle) WHERE x.id < y.id GROUP BY x.id, y.id),
    h AS (SELECT a, b FROM p JOIN n m ON m.id = a JOIN n o ON o.id = b WHERE 100 * same >= 80 * (m.n + o.n - same)),
    link AS (SELECT a, b FROM h UNION SELECT b, a FROM h), node AS (SELECT id FROM d), {_REACHED}
    SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept FROM least LEFT JOIN n USING (id)
"""

_VECTORS = f"""
    WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    h AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id < y.id WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
    link AS (SELECT a, b FROM h UNION SELECT b, a FROM h), node AS (SELECT vec_id AS id FROM embeddings), {_REACHED}, n AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
    SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM least LEFT JOIN n USING (id)
"""

#: Kind, pattern, the group that must be long enough, and how long.
_SECRETS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
    ("private_key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
]


def _matches(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"SELECT doc_id, {number} AS k, '{kind}' AS kind, {least} AS least, regexp_extract_all(text, {quoted}) AS m, regexp_extract_all(text, {quoted}, {group}) AS g, string_split(regexp_replace(text, {quoted}, chr(1), 'g'), chr(1)) AS between FROM d"


_SECRET_SCAN = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    r AS ({" UNION ALL ".join(_matches(k, *rule) for k, rule in enumerate(_SECRETS))}),
    i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM r),
    s AS (SELECT doc_id, k, kind, (list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a, length(m[i]) AS n FROM i WHERE length(g[i]) >= least),
    t AS (SELECT doc_id, k, a, concat(kind, ':', a, ':', a + n) AS span FROM s)
    SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, sha256(coalesce(string_agg(span, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, k), '') AS spans
    FROM d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id
"""

_FIM = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id)) AS h FROM documents),
    r AS (SELECT *, ('0x' || h[1:8])::UBIGINT % (n + 1) AS x, ('0x' || h[9:16])::UBIGINT % (n + 1) AS y, ('0x' || h[17:24])::UBIGINT % 100 AS c, ('0x' || h[25:32])::UBIGINT % 100 AS s FROM d),
    f AS (SELECT doc_id, t, n, least(x, y)::BIGINT AS p, greatest(x, y)::BIGINT AS q, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
    o AS (SELECT *, substring(t, 1, p) AS prefix, substring(t, p + 1, q - p) AS middle, substring(t, q + 1) AS suffix FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars, sha256(t) AS restored_sha256,
        sha256(CASE form WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) WHEN 'spm' THEN concat('<S>', suffix, '<P>', prefix, '<M>', middle) ELSE t END) AS output_sha256
    FROM o
"""

#: Runs have five words or more in a row, each equal to the one a period later: words that begin equal stretches of five meet.
_PERIODIC = """
    WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
    h AS (SELECT doc_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents, t),
    g AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS drawn, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS times FROM h),
    d AS (SELECT doc_id, n, CASE WHEN drawn THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // times) + 1] END) ELSE w END AS w FROM g),
    i AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM d),
    k AS (SELECT d.doc_id, n, s.i, hash(w[s.i + 1:s.i + 5]) AS five FROM d, unnest(range(n - 4)) s(i)),
    e AS (SELECT DISTINCT x.doc_id, y.i - x.i AS q, x.i + o.d AS i FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i > x.i AND 4 * (y.i - x.i) <= x.n, range(5) o(d)),
    s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
    r AS (SELECT doc_id, min(q) AS q, start, n FROM (SELECT doc_id, q, min(i) AS start, count(*) + q AS n FROM s GROUP BY doc_id, q, island) WHERE n >= greatest(6, 4 * q) GROUP BY doc_id, start, n),
    c AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + n)) AS i FROM r),
    j AS (SELECT i.doc_id, string_agg(word, ' ' ORDER BY i.i) FILTER (c.i IS NULL) AS kept FROM i LEFT JOIN c ON i.doc_id = c.doc_id AND i.i = c.i GROUP BY i.doc_id),
    b AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', n, ',', q, chr(10)), '' ORDER BY start, q) AS lines, min(struct_pack(a := -n, b := start, c := q)) AS best FROM r GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.b::BIGINT AS start, -best.a::BIGINT AS length, best.c::BIGINT AS period, (1000 * -best.a // best.c)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN b USING (doc_id) LEFT JOIN j USING (doc_id)
"""

ORACLES: dict[str, str] = {"op1_secret_scan": _SECRET_SCAN, "op3_substring": _SUBSTRING, "op6_vector_dedup": _VECTORS, "op8_minhash": _MINHASH, "op11_fim": _FIM, "op13_periodic": _PERIODIC}
