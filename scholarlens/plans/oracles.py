"""DuckDB SQL for the registered queries, over views of the same tables."""

from __future__ import annotations

from scholarlens.functions import constants as k

from . import seeds


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _seeded(key: str, values: list[str]) -> str:
    return f"[{', '.join(map(_s, values))}][{key} % {len(values)} + 1]"


def _gone(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {_s(pattern)}, {_s(by)}, 'g')"


def _strip(c: str) -> str:
    return _gone(c, r"^\s+|\s+$")


def _whitespace(c: str) -> str:
    c = _gone(_gone(c, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return f"array_to_string(list_transform(string_split({c}, chr(10)), lambda l: {_strip('l')}), chr(10))"


def _decoded(c: str) -> str:
    for wrong, right in k.MOJIBAKE[:-1]:
        c = f"replace({c}, {_s(wrong)}, {_s(right)})"
    return _gone(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]")


def _boilerplate(c: str) -> str:
    for pattern in k.BOILERPLATE:
        c = _gone(c, pattern)
    return c


def _name(c: str, source: str) -> str:
    c = _strip(_gone(c, r"[ \t]+" if source == "abstract" else r"\s+", " "))
    for pattern in k.NAME_NOISE[source]:
        c = _gone(c, pattern)
    return _strip(c)


def _names(found: str, source: str, longer_than: int) -> str:
    """At most two cleaned names of a list, joined by |."""
    names = f"list_transform({found}, lambda m: {_name('m', source)})"
    ok = f"length(n) > {longer_than}"
    if source != "abstract":
        capital = r"\p{Lu}" if source == "anywhere" else r"^(?:\p{Lu}|Dr|Prof|Ir)"
        ok += f" AND length(n) BETWEEN 5 AND 80 AND regexp_matches(n, {_s(capital)})"
    kept = f"list_filter({names}, lambda n: {ok})"
    first = f"list_filter({kept}, lambda n, i: list_position(list_transform({kept}, lambda o: lower(o)), lower(n)) = i)"
    return f"array_to_string(list_slice({first}, 1, 2), '|')"


def _matches(c: str, patterns: list[str]) -> str:
    return f"flatten([{', '.join(f'regexp_extract_all({c}, {_s(p)}, 1)' for p in patterns)}])"


def _first_word(low: str, pairs: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({low}, {_s(w)}) THEN {_s(v)}" for w, v in pairs) + f" ELSE {other} END"


_QUERY = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
_ALIKE = f"list_cosine_similarity(embedding::DOUBLE[], {_QUERY})"
_TOP = f"SELECT vec_id, label, round({_ALIKE}, 6) AS similarity FROM embeddings WHERE embedding IS NOT NULL AND {_ALIKE} >= {{t}} ORDER BY {_ALIKE} DESC, vec_id LIMIT 10"
_MEANS = """
    m AS (SELECT {key}, pos, avg(value) AS mean FROM (SELECT {key}, unnest(embedding::DOUBLE[]) AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM {table}) GROUP BY {key}, pos),
    n AS (SELECT {key}, sqrt(sum(mean * mean)) AS size FROM m GROUP BY {key}),
    c AS (SELECT m.{key}, pos, CASE WHEN size > 0 THEN mean / size ELSE mean END AS value FROM m JOIN n USING ({key}))
"""
_LABELLED = "l AS (SELECT doc_id, source, lang, text, quality FROM documents LEFT JOIN (SELECT doc_id, quality FROM labels) USING (doc_id))"
_LISTED = "CASE doc_id % 3 WHEN 0 THEN [] WHEN 1 THEN [source] END"
_TAGS = f"list_filter(list_transform(list_slice(string_split(text, ' '), 1, 10), lambda w: {_strip('w')}), lambda w: length(w) > 2)"
_DISTINCT_TAGS = f"list_filter({_TAGS}, lambda w, i: list_position({_TAGS}, w) = i)"


def _items(c: str, longer_than: int) -> str:
    titles = f"list_filter(list_transform(list_slice(string_split({c}, chr(10)), 1, 20), lambda w: {_strip('w')}), lambda w: length(w) > {longer_than})"
    year = r"coalesce(nullif(regexp_extract(w, '\b((?:19|20)\d{2})\b', 1), ''), '-')"
    return f"md5(array_to_string(list_transform({titles}, lambda w: concat(w, '/', {year})), '|'))"


_ITEMS = f"concat({_seeded('doc_id', seeds.ITEMS)}, text)"
_LINES = f"list_filter(string_split(concat({_seeded('doc_id', seeds.H_INDEX)}, chr(10), text), chr(10)), lambda x: regexp_matches(lower(x), 'h-index|h index'))"
_NUMBERS = rf"list_filter(list_transform({_LINES}, lambda x: list_filter(list_transform(regexp_split_to_array(x, '\t+|\s{{2,}}'), lambda y: {_strip('y')}), lambda y: regexp_matches(y, '^[0-9]+$'))), lambda x: len(x) > 0)[1]"

_INTEGRITY = "CASE WHEN length({c}) = 0 THEN 1.0 ELSE greatest(0.0, 1 - ((length({c}) - length(replace({c}, '�', '')))::DOUBLE * 10) / length({c})::DOUBLE) END"
_CONFIDENCE = f"""
    SELECT doc_id, printf('%.2f', greatest(0.0, least(1.0, a::DOUBLE + s1::DOUBLE + s2::DOUBLE + 0.3::DOUBLE * (filled / 4.0::DOUBLE) + 0.2::DOUBLE * ({_INTEGRITY.format(c="whole")}))))::DOUBLE AS confidence
    FROM (
        SELECT doc_id,
            CASE WHEN length(abstract) >= 500 THEN 0.3 WHEN length(abstract) >= 200 THEN 0.2 WHEN length(abstract) >= 100 THEN 0.1 ELSE 0.0 END AS a,
            CASE WHEN doc_id % 3 > 0 THEN 0.1 ELSE 0.0 END AS s1, CASE WHEN doc_id % 3 > 1 THEN 0.1 ELSE 0.0 END AS s2,
            ((source <> '')::INT + (author <> '')::INT + (dept <> '')::INT + (doc_id % 4 <> 0)::INT) AS filled,
            concat(source, ' ', abstract, ' ', author) AS whole
        FROM (SELECT doc_id, source, CASE WHEN doc_id % 7 <> 0 THEN lang ELSE '' END AS author, CASE WHEN doc_id % 5 <> 0 THEN text ELSE '' END AS abstract, CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END AS dept FROM documents)
    )
"""
_EMBED = "CASE WHEN doc_id % 6 <> 0 AND length({s}) > 50 THEN concat('Title: ', source, '. Abstract: ', substr(text, 1, 8000)) ELSE concat('Title: ', source) END".format(s=_strip("text"))
_TITLES = f"list_filter(list_transform(list_slice(p, 1, 20), lambda t: {_strip('t')}), lambda t: length(t) > 10)"
_EXPERTISE = f"CASE WHEN len({_TITLES}) > 0 THEN substr(concat({_s(k.EXPERTISE[0])}, conv_id, {_s(k.EXPERTISE[1])}, CASE WHEN conv_id % 2 = 0 THEN 'Informatics' ELSE 'Unknown Department' END, {_s(k.EXPERTISE[2])}, array_to_string({_TITLES}, '; ')), 1, 8000) ELSE '' END"
_CLEAN_DB = "substr(text, 1, 2000) AS title, text AS abstract, CASE WHEN doc_id % 4 <> 0 THEN source ELSE 'Unknown' END AS author, CASE WHEN doc_id % 2 = 0 THEN [source, lang] ELSE [source] END AS supervisors, 'S1' AS degree, (2000 + doc_id % 20)::INT AS year, CASE WHEN doc_id % 3 <> 0 THEN lang END AS dept, doc_id::VARCHAR AS url"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


# The rest writes its patterns and constants out, apart from those that the library uses.
_UNESCAPED = "replace(replace(replace(replace({c}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"


def _clean(c: str) -> str:
    """Entities of the pages, tags, wrong decoding, control characters, white space; the tables need no NFKC."""
    c = _gone(_gone(_UNESCAPED.format(c=c), "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"), "<[^>]+>", " ")
    for wrong, right in (("â€™", "'"), ("â€œ", '"'), ("â€", '"'), ("Ã©", "é"), ("Ã¨", "è"), ("Ã ", "à"), ("�", "")):
        c = f"replace({c}, {_s(wrong)}, {_s(right)})"
    return _strip(_whitespace(_gone(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]")))


def _of_seed(field: str, otherwise: str = "NULL") -> str:
    show = lambda v: otherwise if v is None else str(v) if isinstance(v, int) else _s(v)
    return f"CASE page_id % {len(seeds.PAGES)} " + " ".join(f"WHEN {i} THEN {show(p[1][field])}" for i, p in enumerate(seeds.PAGES)) + " END"


_H1 = _UNESCAPED.format(c=r"regexp_extract(html, '(?is)<h1>\s*(.*?)\s*</h1>', 1)")
_HREFS = r"""regexp_extract_all(c, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)', 1)"""
_YEARS = f"list_transform(list_filter({_HREFS}, lambda h: regexp_matches(h, '[0-9][0-9][0-9][0-9][.]html$')), lambda h: CASE WHEN starts_with(h, 'http') THEN h ELSE concat('http://x.org/', h) END)"
_RECORDS = f"list_transform(list_filter({_HREFS}, lambda h: regexp_matches(h, '^(https?://repository[.]its[.]ac[.]id)?/[0-9]{{5,}}/')), lambda h: CASE WHEN starts_with(h, 'http') THEN h ELSE concat('https://repository.its.ac.id', h) END)"


def _hashed(text: str) -> str:
    """The 64 sums of signed word hashes of a text: bits 0 to 5 of the first 8 bytes of a word's MD5, and the sign bit."""
    words = f"list_filter(regexp_split_to_array(lower({text}), '\\s+'), lambda w: w <> '')"
    hashes = f"list_transform({words}, lambda w: ('0x' || substr(md5(w), 1, 16))::UBIGINT)"
    return f"list_transform(range(64), lambda d: list_sum(list_transform(list_filter({hashes}, lambda h: h % 64 = d), lambda h: CASE WHEN h >= 9223372036854775808 THEN 1 ELSE -1 END)))"


_NAMED = f"concat({_seeded('doc_id', seeds.SUPERVISORS)}, text)"
_RECORD = f"SELECT doc_id, {_clean('text')} AS title, {_strip(_gone(_boilerplate(_clean(_NAMED)), k.ABSTRACT_PREFIX))} AS abstract, {_clean('source')} AS author, {_clean('lang')} AS dept, (1990 + doc_id % 30)::INT AS year FROM documents"
_RECORD_NAMES = f"SELECT *, {_names(_matches('substr(abstract, 1, 500)', k.ABSTRACT_SUPERVISORS), 'abstract', 3)} AS names FROM ({_RECORD})"
_LANDED = f"""
    l AS (SELECT doc_id AS id, source, text, lang, CASE WHEN doc_id % 6 = 0 THEN [lang] END AS had, nullif(regexp_extract(concat(CASE WHEN doc_id % 11 <> 0 THEN 'http://repository.its.ac.id/' ELSE 'http://x.org/' END, doc_id, '/'), 'repository[.]its[.]ac[.]id/([0-9]+)/?', 1), '') AS eprint FROM documents),
    b AS (SELECT doc_id::VARCHAR AS eprint, {_names("flatten([" + ", ".join("string_split(regexp_extract(concat(" + _seeded("doc_id", seeds.BIBTEX) + ", text), " + _s(rf"(?is)(?:^|[\s,{{]){f}\s*=\s*[{{\"]([^}}\"]*)[}}\"]") + ", 1), ' and ')" for f in k.BIBTEX_FIELDS) + "])", "pdf", 0)} AS names FROM documents WHERE doc_id % 3 <> 0),
    p AS (SELECT doc_id::VARCHAR AS eprint, {_names(_matches(f"concat(text, chr(10), {_seeded('doc_id', seeds.PDF)})", k.PDF_SUPERVISORS), "pdf", 0)} AS names FROM documents WHERE doc_id % 4 <> 0),
    f AS (SELECT id, coalesce(nullif(b.names, ''), nullif(p.names, '')) AS names, CASE WHEN b.names <> '' THEN 'bibtex' WHEN p.names <> '' THEN 'pdf' END AS source
        FROM (SELECT * FROM l WHERE had IS NULL ORDER BY id LIMIT 1000) t LEFT JOIN b USING (eprint) LEFT JOIN p USING (eprint))
"""
_PUBS = "SELECT conv_id, list(text ORDER BY turn) AS p FROM conversations GROUP BY conv_id"

_STREAM_MERGE = "SELECT c_custkey::VARCHAR AS url, CASE WHEN c_custkey % 4 = 0 THEN concat('last ', c_name) WHEN c_custkey % 2 = 0 THEN concat('new ', c_name) ELSE c_name END AS title, CASE WHEN c_custkey % 4 = 0 THEN 2 WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS rank FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0"

def _stems(words: str) -> str:
    """CTEs that end in stems (word, stem) of a CTE's distinct words: rule by rule, with the measure and the prefix's kind as numbers."""
    long = lambda c, n: f"{c}[:length({c}) - {n}]"
    return f"""
        s0 AS (SELECT DISTINCT word, word AS w, length(regexp_replace(word, '[^aeiou]', '', 'g')) AS m FROM {words}),
        s1 AS (SELECT word, CASE WHEN hit THEN {long("w", 3)} ELSE w END AS w, m - hit::INT AS m FROM (SELECT *, m > 2 AND regexp_matches(w, '(kah|lah|pun)$') AS hit FROM s0)),
        s2 AS (SELECT word, CASE WHEN NOT hit THEN w WHEN w LIKE '%nya' THEN {long("w", 3)} ELSE {long("w", 2)} END AS w, m - hit::INT AS m FROM (SELECT *, m > 2 AND regexp_matches(w, '(ku|mu|nya)$') AS hit FROM s1)),
        s3 AS (SELECT word, w, m, CASE WHEN m <= 2 THEN '' WHEN regexp_matches(w, '^[mp]eny[aeiou]') THEN 'ny' WHEN regexp_matches(w, '^[mp]em[aeiou]') THEN 'm' WHEN regexp_matches(w, '^[mp]eng') THEN '4' WHEN regexp_matches(w, '^([mp]e[mn]|ter)') THEN '3' WHEN regexp_matches(w, '^(me|di|ke)') THEN '2' ELSE '' END AS kind FROM s2),
        s4 AS (SELECT word, m - (kind <> '')::INT AS m, CASE kind WHEN 'ny' THEN concat('s', w[5:]) WHEN 'm' THEN concat('p', w[4:]) WHEN '' THEN w ELSE w[kind::INT + 1:] END AS w, CASE WHEN kind = '' THEN 0 WHEN w[1] IN ('p', 'k') THEN 3 ELSE 1 END AS p FROM s3),
        s5 AS (SELECT word, w, m, p, CASE WHEN m <= 2 OR p = 0 THEN 0 WHEN p = 1 AND w LIKE '%kan' THEN 3 WHEN p = 1 AND regexp_matches(w, '(^|[^s])i$') THEN 1 WHEN p = 3 AND w LIKE '%an' THEN 2 ELSE 0 END AS cut FROM s4),
        s6 AS (SELECT word, {long("w", "cut")} AS w, m - (cut > 0)::INT AS m, p, (p = 0 OR cut > 0) AND m - (cut > 0)::INT > 2 AS second FROM s5),
        s7 AS (SELECT *, CASE WHEN NOT second THEN 0 WHEN regexp_matches(w, '^(bel|pel)ajar') OR w LIKE 'per%' OR w LIKE 'ber%' THEN 3 WHEN w LIKE 'pe%' OR regexp_matches(w, '^be[^aeiou]er') THEN 2 ELSE 0 END AS off FROM s6),
        s8 AS (SELECT word, w[off + 1:] AS w, m - (off > 0)::INT AS m, p, CASE WHEN off = 0 OR w LIKE 'pelajar%' THEN 0 WHEN w LIKE 'pe%' THEN 2 ELSE 4 END AS q FROM s7),
        s9 AS (SELECT word, w, CASE WHEN p > 0 OR m <= 2 THEN 0 WHEN q <> 2 AND w LIKE '%kan' THEN 3 WHEN w LIKE '%an' THEN 2 WHEN q <> 4 AND regexp_matches(w, '(^|[^s])i$') THEN 1 ELSE 0 END AS cut FROM s8),
        stems AS (SELECT word, {long("w", "cut")} AS stem FROM s9)
    """


_INFLECTED = f"inflected AS (SELECT doc_id, concat({_seeded('doc_id', seeds.INFLECTED)}, text) AS text FROM documents)"
_TEXT_WORDS = r"words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM inflected)"


def _ranked(terms: list[str], where: str) -> str:
    """Documents by the rank of some stems."""
    return f"""
        WITH {_INFLECTED}, {_TEXT_WORDS}, {_stems("words")},
        d AS (SELECT i.doc_id, count(word) AS size FROM inflected i LEFT JOIN words USING (doc_id) WHERE {where} GROUP BY i.doc_id),
        t AS (SELECT doc_id, stem, size, count(*) AS tf FROM words JOIN stems USING (word) JOIN d USING (doc_id) WHERE stem IN ({", ".join(map(_s, terms))}) GROUP BY ALL),
        f AS (SELECT stem, count(*) AS df FROM t GROUP BY stem), n AS (SELECT count(*) AS n, avg(size) AS mean FROM d)
        SELECT doc_id, count(*) AS matched, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score FROM t JOIN f USING (stem), n GROUP BY doc_id
    """


_PROFILE = f"""
    WITH x AS (SELECT vec_id, embedding, {_seeded("vec_id", seeds.DEPTS)} AS dept, unnest([concat('  Dr.  A', label, ' , '), concat('Prof B', label % 3, '.'), 'x ']) AS raw FROM embeddings WHERE embedding IS NOT NULL),
    k AS (SELECT embedding, dept, trim(regexp_replace({_strip("raw")}, '\\s+', ' ', 'g'), '., ') AS name FROM x WHERE length(trim(raw)) > 2),
    {_MEANS.format(key="name", table="k")},
    d AS (SELECT name, dept, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, dept) AS r FROM k WHERE dept <> '' GROUP BY name, dept),
    t AS (SELECT name, count(*) AS research_count FROM k GROUP BY name)
    SELECT c.name, coalesce(d.dept, '') AS dept, research_count, pos::INT AS pos, round(value, 6) AS value FROM c JOIN t USING (name) LEFT JOIN d ON d.name = c.name AND d.r = 1
"""

ORACLES: dict[str, str] = {
    "clean_text_full": f"SELECT page_id, md5({_clean('html')}) AS clean FROM pages",
    "clean_record": f"""
        SELECT title, abstract, author, nullif(names, '') AS supervisors, CASE WHEN d = '' THEN '' ELSE {_first_word("lower(" + _strip("d") + ")", k.DEGREES, "substr(upper(d), 1, 5)")} END AS degree, year, dept, concat('u', doc_id) AS url, '{{}}' AS metadata,
            printf('%.2f', greatest(0.0, least(1.0, (CASE WHEN length(abstract) >= 500 THEN 0.3 WHEN length(abstract) >= 200 THEN 0.2 WHEN length(abstract) >= 100 THEN 0.1 ELSE 0.0 END)::DOUBLE + (CASE WHEN names <> '' THEN 0.1 ELSE 0.0 END)::DOUBLE + (CASE WHEN contains(names, '|') THEN 0.1 ELSE 0.0 END)::DOUBLE
                + 0.3::DOUBLE * (((title <> '')::INT + (author <> '')::INT + (dept <> '')::INT + 1) / 4.0::DOUBLE) + 0.2::DOUBLE * ({_INTEGRITY.format(c="concat(title, ' ', abstract, ' ', author)")}))))::DOUBLE AS data_confidence
        FROM (SELECT *, {_seeded("doc_id", seeds.DEGREES)} AS d FROM ({_RECORD_NAMES}))
    """,
    "html_fields": f"""
        SELECT page_id, {_of_seed("title", _H1)} AS title, {_of_seed("author")} AS author, ({_of_seed("year", "nullif(regexp_extract(html, '[(]([0-9][0-9][0-9][0-9])[)]', 1), '')::INT")})::VARCHAR AS year, {_of_seed("abstract")} AS abstract, {_of_seed("supervisors")} AS supervisors, {_of_seed("dept")} AS dept, {_of_seed("degree")} AS degree, {_of_seed("pdf_url")} AS pdf_url
        FROM pages
    """,
    "page_links": f"""
        SELECT page_id, array_to_string(list_slice(list_filter({_YEARS}, lambda h, i: list_position({_YEARS}, h) = i), 1, 50), '|') AS year_pages, array_to_string({_RECORDS}, '|') AS records, coalesce(nullif(regexp_extract(c, '(?i)Page\\s+[0-9]+\\s+of\\s+([0-9]+)', 1), '')::INT, 1) AS pages
        FROM (SELECT page_id, concat({_seeded("page_id", seeds.LINKS)}, html) AS c FROM pages)
    """,
    "hashed_embedding": f"SELECT doc_id, 64 AS n, true AS ok, len(list_filter(v, lambda x: x > 0))::INT AS positive, len(list_filter(v, lambda x: x < 0))::INT AS negative FROM (SELECT doc_id, {_hashed('text')} AS v FROM documents)",
    "vec_lsh_recall": "SELECT true AS enough",
    "enrich_flow": f"WITH {_LANDED} SELECT l.id, coalesce(f.names, array_to_string(had, '|'), CASE WHEN l.id % 6 = 1 THEN '' END) AS supervisors, f.source FROM l LEFT JOIN f USING (id)",
    "enrich_counts": f"WITH {_LANDED} SELECT count(*) AS checked, count(*) FILTER (source = 'bibtex') AS bibtex, count(*) FILTER (source = 'pdf') AS pdf, count(*) FILTER (source IS NULL) AS failed FROM f",
    "recover_flow": f"SELECT doc_id AS id, CASE WHEN doc_id % 6 = 0 THEN lang WHEN names <> '' THEN names WHEN doc_id % 6 = 1 THEN '' END AS supervisors FROM (SELECT doc_id, lang, {_names(_matches('c', k.ANYWHERE_SUPERVISORS), 'anywhere', 0)} AS names FROM (SELECT doc_id, lang, concat(source, chr(10), text, chr(10), {_seeded('doc_id', seeds.SUPERVISORS)}) AS c FROM documents))",
    "profile_embed_flow": f"""
        SELECT conv_id AS id, CASE WHEN done THEN 1 WHEN ready THEN 64 END AS n, CASE WHEN done THEN 1 WHEN ready THEN len(list_filter(v, lambda x: x > 0)) END::INT AS positive, CASE WHEN done THEN 0 WHEN ready THEN len(list_filter(v, lambda x: x < 0)) END::INT AS negative
        FROM (SELECT conv_id, conv_id % 3 = 0 AS done, len(p) >= 2 AND c <> '' AS ready, {_hashed("c")} AS v FROM (SELECT conv_id, p, {_EXPERTISE} AS c FROM ({_PUBS})))
    """,
    "harvest_progress": """
        WITH t AS (SELECT doc_id, quality = 1 AS ok FROM labels), r AS (SELECT * FROM t UNION ALL SELECT doc_id, doc_id % 10 = 1 FROM t WHERE NOT ok),
        s AS (SELECT doc_id, bool_or(ok) AS ok, count(*) AS tries FROM r GROUP BY doc_id), u AS (SELECT d.doc_id, ok, tries FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN s USING (doc_id))
        SELECT count(*) AS total_discovered, count(ok) AS total_processed, count(*) FILTER (ok) AS total_success, count(*) FILTER (NOT ok) AS total_failed, count(*) FILTER (ok IS NULL) AS "left", count(*) FILTER (ok IS NULL OR (NOT ok AND tries < 3)) AS retry FROM u
    """,
    "stream_merge": _STREAM_MERGE,
    "stream_merge_sources": _STREAM_MERGE,
    "bucket_merge": """
        SELECT url, CASE WHEN again THEN concat('again ', CASE WHEN k % 4 = 0 THEN 'last ' WHEN k % 2 = 0 THEN 'new ' ELSE '' END, c_name) ELSE c_name END AS title, CASE WHEN NOT again OR k % 2 <> 0 THEN 0 WHEN k % 4 = 0 THEN 2 ELSE 1 END AS rank, again AS rewritten
        FROM (SELECT c_custkey AS k, c_custkey::VARCHAR AS url, c_name, c_custkey % 10 IN (2, 7) AS again FROM customer) WHERE k % 3 <> 0 OR again AND k % 2 = 0
    """,
    "vec_index_recall": "SELECT count(*) AS queries, count(*) * least(10, (SELECT count(*) FROM embeddings)) AS neighbours, true AS enough FROM embeddings WHERE vec_id % 20 = 0",
    "vec_index_updates": """
        SELECT query_id, rank, vec_id, round(s, 6) AS similarity
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, r.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) AS s FROM embeddings q, embeddings r WHERE q.vec_id % 20 = 0 AND r.vec_id % 11 <> 0))
        WHERE rank <= 10
    """,
    "word_stems": f"WITH {_INFLECTED}, {_TEXT_WORDS}, {_stems('words')} SELECT word, stem, count(*) AS n FROM words JOIN stems USING (word) GROUP BY ALL",
    "full_text_ranked": _ranked(["ajar", "dan", "baca", "the", "esthe"], "doc_id % 7 <> 0 OR doc_id % 14 = 0"),
    "full_text_top": f"SELECT doc_id, matched, round(score, 6) AS score FROM ({_ranked(['ajar', 'mesin'], 'true')}) WHERE matched = 2 ORDER BY score DESC, doc_id LIMIT 10",
    "harvest_pauses": """
        WITH a AS (SELECT event_type AS source, event_id, ((event_id // 150) % 3 <> 0 OR event_id % 97 = 0) OR event_id % 89 = 0 AS ends FROM events),
        i AS (SELECT *, sum(ends::INT) OVER (PARTITION BY source ORDER BY event_id) AS island FROM a),
        r AS (SELECT source, island, count(*) FILTER (NOT ends) AS n FROM i GROUP BY source, island),
        l AS (SELECT source, max_by(n, island) AS consecutive, count(*) FILTER (n >= 20) AS pauses FROM r GROUP BY source)
        SELECT source, consecutive, pauses, consecutive >= 20 AS is_paused, CASE WHEN consecutive >= 20 THEN 'Network disconnected - 20 consecutive failures' END AS pause_reason FROM l
    """,
    "paused_log": """
        WITH l AS (SELECT 'all' AS log, event_type = 'error' AS failed, ts FROM events UNION ALL SELECT 'errors', true, ts FROM events WHERE event_type = 'error'),
        n AS (SELECT log, count(*) FILTER (failed) AS n FROM (SELECT *, row_number() OVER (PARTITION BY log ORDER BY ts DESC) AS r FROM l) WHERE r <= 20 GROUP BY log)
        SELECT log, n >= 20 AS is_paused, CASE WHEN n >= 20 THEN concat('Network disconnected - ', n, ' consecutive failures') END AS pause_reason FROM n
    """,
    "arrivals_once": "SELECT event_type, count(*) AS n, count(*) AS urls FROM events GROUP BY event_type",
    "sql_upsert": """
        SELECT k::VARCHAR AS sinta_id, CASE WHEN k % 6 = 0 THEN concat('last ', c_name) WHEN k % 2 = 0 THEN concat('new ', c_name) ELSE c_name END AS name,
            CASE WHEN k % 4 = 0 THEN 'x' WHEN k % 3 <> 0 THEN concat('n', k) END AS nidn, CASE WHEN k % 10 = 0 THEN 'y' WHEN k % 3 <> 0 THEN c_mktsegment END AS dept,
            CASE WHEN k % 6 = 0 THEN 3 WHEN k % 2 = 0 THEN 2 ELSE 1 END AS h_index_scopus, c_mktsegment AS tags, true AS scraped, k % 2 = 0 AS updated
        FROM (SELECT *, c_custkey AS k FROM customer) WHERE k % 3 <> 0 OR k % 2 = 0
    """,
    "metadata_variant": """
        SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('not json ', event_type) WHEN event_id % 7 = 1 THEN '' END AS raw, CASE WHEN object THEN (props::JSON ->> 'k')::INT END AS k, CASE WHEN list THEN event_id END AS first, NOT (event_id % 3 = 0 OR event_id % 7 = 1 OR list OR object) AS none
        FROM (SELECT *, event_id % 11 = 2 AND event_id % 3 <> 0 AND event_id % 7 <> 1 AS list, event_id % 13 <> 3 AND event_id % 11 <> 2 AND event_id % 3 <> 0 AND event_id % 7 <> 1 AS object FROM events)
    """,
    "dry_run": "SELECT title, count(*) * CASE WHEN title = 'BUILDING' THEN 2 ELSE 1 END AS n, count(DISTINCT c_name) AS urls FROM (SELECT c_mktsegment AS title, c_name FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0) GROUP BY title",
    "merge_updated": "SELECT c_custkey::VARCHAR AS url, c_name AS title, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 2 = 0 THEN '2024-05-06' ELSE '2020-01-01' END AS updated_at FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0",
    "oai_records": f"""
        SELECT concat('https://x.org/', doc_id, '/') AS url, source AS title, CASE WHEN doc_id % 4 <> 0 THEN lang ELSE 'Unknown' END AS author, (1990 + doc_id % 30)::INT AS year,
            CASE WHEN regexp_matches(low, 's1|undergraduate|sarjana') THEN 'S1' WHEN regexp_matches(low, 's2|master|magister') THEN 'S2' WHEN regexp_matches(low, 's3|doctoral|doktor') THEN 'S3' WHEN contains(low, 'thesis') THEN 'S1' ELSE '' END AS degree,
            CASE WHEN regexp_matches(lower(subject), 'department|departemen|jurusan|fakultas|faculty') THEN subject ELSE '' END AS dept, md5(CASE WHEN doc_id % 5 <> 0 THEN text ELSE '' END) AS abstract, concat('oai:x:', doc_id) AS identifier, source AS subject
        FROM (SELECT *, lower(concat(t, ' ', source, ' ', subject)) AS low FROM (SELECT *, {_seeded("doc_id", seeds.TYPES)} AS t, {_seeded("doc_id", seeds.SUBJECTS)} AS subject FROM documents WHERE doc_id % 8 <> 0 AND doc_id % 9 <> 0 AND doc_id % 10 <> 0))
    """,
    "oai_resume": r"SELECT concat('https://x.org/', doc_id, '/') AS url, source AS title, lang AS author, (1990 + doc_id % 30)::INT AS year, md5(concat('|', regexp_replace(text, '[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]', ' ', 'g'), '|')) AS abstract, 1 AS times FROM documents",
    "oai_set": "SELECT doc_id FROM documents WHERE source = 'src1'",
    "author_list": "SELECT o_custkey::VARCHAR AS sinta_id, concat('P', o_custkey) AS name, CASE WHEN o_custkey % 3 <> 0 THEN concat('D', o_custkey % 5) END AS dept FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))",
    "checkpoint_ids": "SELECT n_nationkey::VARCHAR AS sinta_id FROM nation",
    "network_errors": "SELECT event_id % 4 IN (1, 2) AS network, count(*) AS n FROM events GROUP BY ALL",
    "sql_search": f"SELECT vec_id::VARCHAR AS id, concat('t', label) AS title, 'a' AS abstract, label::VARCHAR AS author, label::VARCHAR AS supervisors, 'S1' AS degree, label::INT AS year, label::VARCHAR AS dept, vec_id::VARCHAR AS url, round({_ALIKE}, 6) AS similarity FROM embeddings WHERE {_ALIKE} >= 0.2 ORDER BY {_ALIKE} DESC, vec_id::VARCHAR LIMIT 7",
    "vec_topk": _TOP.format(t=-1.0),
    "vec_topk_threshold": _TOP.format(t=0.3),
    "vec_topk_centroid": f"WITH {_MEANS.format(key='label', table='embeddings')}, v AS (SELECT label, list(value ORDER BY pos) AS v FROM c GROUP BY label) SELECT label, round(list_cosine_similarity(v, {_QUERY}), 6) AS similarity FROM v WHERE list_cosine_similarity(v, {_QUERY}) >= 0 ORDER BY list_cosine_similarity(v, {_QUERY}) DESC, label LIMIT 5",
    "centroid_by_label": f"WITH {_MEANS.format(key='label', table='embeddings')} SELECT label, pos::INT AS pos, round(value, 6) AS value FROM c",
    "supervisor_profile": _PROFILE,
    "profile_increments": _PROFILE,
    "modal_dept": "SELECT source, coalesce(max(CASE WHEN r = 1 THEN lang END), '') AS dept FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY (lang = '' OR lang IS NULL), count(*) DESC, lang) AS r FROM documents GROUP BY source, lang) GROUP BY source",
    "top_by_count": "SELECT source AS name, count(*) AS research_count FROM documents GROUP BY source ORDER BY research_count DESC NULLS FIRST, name LIMIT 10",
    "embedding_stats": f"WITH {_LABELLED}, p AS (SELECT nullif(max(quality), 0) AS v FROM l GROUP BY source) SELECT * FROM (SELECT count(*) AS total_researches, count(quality) AS embedded_researches, count(*) FILTER (quality IS NULL) AS pending_researches FROM l), (SELECT count(*) AS total_lecturers, count(v) AS profiled_lecturers FROM p)",
    "profile_stats": f"WITH {_LABELLED} SELECT count(*) AS total_lecturers, count(nullif(lang, 'en')) AS with_sinta_id, count(*) FILTER (len({_LISTED}) > 0) AS with_publications, count(quality) AS with_expertise_vector, count(*) FILTER (len({_LISTED}) > 0 AND quality IS NULL) AS pending_vectorization FROM l",
    "coverage": f"WITH {_LABELLED} SELECT count(quality) AS scraped, round(count(quality) / {k.TOTAL_LECTURERS} * 100, 1) AS percent FROM l",
    "field_presence": f"SELECT count(*) AS total, count(*) FILTER (({_LISTED}) IS NOT NULL) AS not_null, count(*) FILTER (len({_LISTED}) > 0) AS filled FROM documents",
    "count_degree": "SELECT count(*) AS n FROM documents WHERE upper(lang) = 'FR'",
    "pending_rows": f"WITH {_LABELLED} SELECT doc_id, source FROM l WHERE quality IS NULL ORDER BY doc_id LIMIT 100",
    "pending_profiles": f"WITH {_LABELLED} SELECT doc_id, source FROM l WHERE quality IS NULL AND len(string_split(source, '1')) >= 2 ORDER BY doc_id LIMIT 100",
    "without_supervisors": "SELECT doc_id, 'filter_first' AS mode FROM (SELECT doc_id FROM documents WHERE doc_id % 3 <> 1 ORDER BY doc_id LIMIT 50) UNION ALL SELECT doc_id, 'limit_first' FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50) WHERE doc_id % 3 <> 1",
    "existing_keys": "SELECT DISTINCT doc_id FROM documents SEMI JOIN labels USING (doc_id)",
    "new_keys": "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)",
    "harvest_select": "SELECT url, min(source) AS division FROM (SELECT doc_id::VARCHAR AS url, source FROM documents) WHERE contains(source, 'src1') AND url NOT IN (SELECT doc_id::VARCHAR FROM labels WHERE quality = 1) GROUP BY url ORDER BY url LIMIT 100",
    "whitespace_norm": f"SELECT doc_id, md5({_whitespace('c')}) AS clean FROM (SELECT doc_id, concat({_seeded('doc_id', seeds.SPACED)}, text) AS c FROM documents)",
    "strip_tags": f"SELECT page_id, md5({_gone(_gone('html', '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>'), '<[^>]+>', ' ')}) AS clean FROM pages",
    "fix_mojibake": f"SELECT doc_id, md5({_decoded('c')}) AS clean FROM (SELECT doc_id, concat({_seeded('doc_id', seeds.MOJIBAKE)}, text) AS c FROM documents)",
    "strip_boilerplate": f"SELECT doc_id, md5({_boilerplate('c')}) AS clean FROM (SELECT doc_id, concat({_seeded('doc_id', seeds.BOILERPLATE)}, text) AS c FROM documents)",
    "strip_prefix": rf"SELECT doc_id, md5({_gone('c', k.ABSTRACT_PREFIX)}) AS clean, md5(CASE WHEN regexp_matches(c, '(?i)^(abstract|abstrak)[\p{{L}}\p{{N}}_]') THEN c ELSE {_gone('c', k.ABSTRACT_PREFIX)} END) AS whole_word FROM (SELECT doc_id, concat({_seeded('doc_id', seeds.PREFIXES)}, text) AS c FROM documents)",
    "supervisors_abstract": f"SELECT doc_id, {_names(_matches('c', k.ABSTRACT_SUPERVISORS), 'abstract', 3)} AS names FROM (SELECT doc_id, substr(concat({_seeded('doc_id', seeds.SUPERVISORS)}, text), 1, 500) AS c FROM documents)",
    "supervisors_anywhere": f"SELECT doc_id, {_names(_matches('c', k.ANYWHERE_SUPERVISORS), 'anywhere', 0)} AS names FROM (SELECT doc_id, concat(source, chr(10), text, chr(10), {_seeded('doc_id', seeds.SUPERVISORS)}) AS c FROM documents)",
    "supervisors_pdf": f"SELECT doc_id, {_names(_matches('c', k.PDF_SUPERVISORS), 'pdf', 0)} AS names FROM (SELECT doc_id, concat(text, chr(10), {_seeded('doc_id', seeds.PDF)}) AS c FROM documents)",
    "supervisors_bibtex": "SELECT doc_id, {n} AS names FROM (SELECT doc_id, concat({s}, text) AS c FROM documents)".format(
        n=_names("flatten([" + ", ".join("string_split(regexp_extract(c, " + _s(rf"(?is)(?:^|[\s,{{]){f}\s*=\s*[{{\"]([^}}\"]*)[}}\"]") + ", 1), ' and ')" for f in k.BIBTEX_FIELDS) + "])", "pdf", 0), s=_seeded("doc_id", seeds.BIBTEX)
    ),
    "degree_norm": f"SELECT doc_id, CASE WHEN d = '' THEN '' ELSE {_first_word('lower(' + _strip('d') + ')', k.DEGREES, 'substr(upper(d), 1, 5)')} END AS degree FROM (SELECT doc_id, concat({_seeded('doc_id', seeds.DEGREES)}, text) AS d FROM documents)",
    "degree_oai": f"SELECT doc_id, {_first_word('low', [(w, v) for v, words in k.RECORD_DEGREES for w in words], _s(''))} AS degree FROM (SELECT doc_id, lower(concat({_seeded('doc_id', seeds.TYPES)}, ' ', source, ' ', text, ' ', {_seeded('doc_id', seeds.SUBJECTS)})) AS low FROM documents)",
    "dept_oai": f"SELECT doc_id, md5(coalesce(list_filter([source, text, {_seeded('doc_id', seeds.SUBJECTS)}], lambda s: regexp_matches(lower(s), {_s('|'.join(k.DEPT_WORDS))}))[1], '')) AS dept FROM documents",
    "year_parse": rf"SELECT o_orderkey, nullif(regexp_extract({_DAY}, '\d{{4}}'), '')::INT AS year, nullif(regexp_extract(concat('v12 (', {_DAY}, ')'), '\b((?:19|20)\d{{2}})\b', 1), '')::INT AS item_year FROM orders",
    "id_from_url": f"SELECT page_id, nullif(regexp_extract(concat(CASE WHEN page_id % 2 = 0 THEN 'http://repository.its.ac.id/' ELSE 'http://x.org/' END, page_id, '/1/x.pdf'), {_s(k.EPRINT_ID)}, 1), '') AS eprint_id, nullif(regexp_extract(url, {_s(k.EPRINT_ID)}, 1), '') AS from_page FROM pages",
    "confidence": _CONFIDENCE,
    "confidence_hist": f"SELECT confidence, count(*) AS n FROM ({_CONFIDENCE}) GROUP BY confidence",
    "encoding_integrity": f"SELECT doc_id, round({_INTEGRITY.format(c='c')}, 6)::DOUBLE AS integrity FROM (SELECT doc_id, concat(repeat('�', (doc_id % 4)::INT), text) AS c FROM documents)",
    "keyword_flags": f"SELECT conv_id, turn, array_to_string(list_filter([{', '.join(map(_s, k.ABSTRACT_FLAGS))}], lambda w: contains(lower(c), w)), ',') AS flags, length(c) AS n FROM (SELECT conv_id, turn, concat({_seeded('conv_id', seeds.SUPERVISORS)}, text) AS c FROM conversations)",
    "embedding_input": f"SELECT doc_id, length(c) AS n, md5(c) AS md5 FROM (SELECT doc_id, {_EMBED} AS c FROM documents)",
    "expertise_text": f"SELECT conv_id, length(c) AS n, md5(c) AS md5 FROM (SELECT conv_id, {_EXPERTISE} AS c FROM (SELECT conv_id, list(text ORDER BY turn) AS p FROM conversations GROUP BY conv_id))",
    "publications_shape": f"""
        WITH r AS (SELECT source AS author_id, CASE WHEN doc_id % 3 = 0 THEN 'googlescholar' ELSE 'scopus' END AS source, doc_id // 200 AS page, doc_id AS pos, text AS title, CASE WHEN doc_id % 11 <> 0 THEN 2008 + doc_id % 17 END AS year FROM documents),
        o AS (SELECT *, length(title) >= 10 AND coalesce(year >= {k.MIN_YEAR}, true) AS ok FROM r),
        s AS (SELECT author_id, source, min(page) AS stop FROM (SELECT author_id, source, page FROM o GROUP BY ALL HAVING NOT bool_or(ok)) GROUP BY ALL),
        n AS (SELECT o.*, row_number() OVER (PARTITION BY o.author_id, o.source ORDER BY o.page, o.pos) AS n FROM o LEFT JOIN s USING (author_id, source) WHERE ok AND (stop IS NULL OR o.page < stop)),
        h AS (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY (source <> 'scopus'), n) AS m FROM n WHERE n <= {k.PUBLICATIONS_MAX})
        SELECT author_id, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT year) FILTER (year <> 0)), ','), '') AS years, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, md5(string_agg(title, '|' ORDER BY m)) AS md5 FROM h WHERE m <= {k.PUBLICATIONS_MAX} GROUP BY author_id
    """,
    "tags_shape": f"SELECT doc_id, array_to_string({_DISTINCT_TAGS}, ',') AS tags FROM documents",
    "tag_lookup": f"SELECT doc_id FROM documents WHERE list_has_any({_TAGS}, ['the', 'des', 'der', 'que'])",
    "items_shape": f"SELECT doc_id, {_items('c', 10)} AS researches, {_items('c', 5)} AS books FROM (SELECT doc_id, {_ITEMS} AS c FROM documents)",
    "h_index_lines": rf"SELECT doc_id, coalesce(n[1]::INT, 0) AS scopus, coalesce(n[2]::INT, n[1]::INT, 0) AS gscholar, nullif(regexp_extract(c, 'NIDN\s*:\s*(\d{{10}})', 1), '') AS nidn FROM (SELECT doc_id, {_NUMBERS} AS n, concat({_seeded('doc_id', seeds.H_INDEX)}, chr(10), text) AS c FROM documents)",
    "metadata_json": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('not json ', event_type) END AS raw, CASE WHEN event_id % 3 <> 0 THEN json_extract_string(props, '$.k') END AS k FROM events",
    "db_shape": f"SELECT url, length(title) AS n_title, author, array_to_string(supervisors, '|') AS supervisors, degree, year, dept, '{{}}' AS metadata FROM (SELECT {_CLEAN_DB} FROM documents)",
    "csv_shape": f"SELECT url, md5(concat_ws(chr(31), title, author, abstract)) AS md5, array_to_string(supervisors, '; ') AS supervisors, degree, year::VARCHAR AS year, dept, (doc_id % 10 / 10.0)::VARCHAR AS data_confidence FROM (SELECT doc_id, {_CLEAN_DB} FROM documents)",
    "merge_url": """
        WITH o AS (SELECT c_custkey::VARCHAR AS url, c_name AS title, round(c_acctbal, 2) AS data_confidence FROM customer WHERE c_custkey % 3 <> 0),
        a AS (SELECT c_custkey::VARCHAR AS url, CASE WHEN c_custkey % 10 <> 0 THEN concat('new ', c_name) END AS title, round(c_acctbal, 2) AS data_confidence FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey::VARCHAR, concat('old ', c_name), round(c_acctbal, 2) FROM customer WHERE c_custkey % 4 = 0),
        n AS (SELECT url, title, data_confidence FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY title) AS r FROM a WHERE title <> '') WHERE r = 1)
        SELECT coalesce(n.url, o.url) AS url, CASE WHEN n.url IS NOT NULL THEN n.title ELSE o.title END AS title, CASE WHEN n.url IS NOT NULL THEN n.data_confidence ELSE o.data_confidence END AS data_confidence FROM o FULL JOIN n ON o.url = n.url
    """,
    "merge_keep_nonnull": """
        WITH o AS (SELECT c_custkey::VARCHAR AS sinta_id, c_name AS name, concat('n', c_custkey) AS nidn, c_mktsegment AS dept, 1 AS h_index_scopus FROM customer WHERE c_custkey % 3 <> 0),
        n AS (SELECT c_custkey::VARCHAR AS sinta_id, concat('new ', c_name) AS name, CASE WHEN c_custkey % 4 = 0 THEN 'x' END AS nidn, CASE WHEN c_custkey % 5 = 0 THEN 'y' END AS dept, CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 2 END AS h_index_scopus FROM customer WHERE c_custkey % 2 = 0)
        SELECT coalesce(n.sinta_id, o.sinta_id) AS sinta_id, coalesce(n.name, o.name) AS name, coalesce(n.nidn, o.nidn) AS nidn, coalesce(n.dept, o.dept) AS dept, coalesce(n.h_index_scopus, o.h_index_scopus) AS h_index_scopus FROM o FULL JOIN n ON o.sinta_id = n.sinta_id
    """,
    "merge_name": """
        WITH o AS (SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR END AS sinta_id, 1 AS research_count FROM customer WHERE c_custkey % 3 <> 0),
        n AS (SELECT c_name AS name, 5 AS research_count FROM customer WHERE c_custkey % 4 < 2)
        SELECT coalesce(n.name, o.name) AS name, CASE WHEN n.name IS NULL THEN o.sinta_id END AS sinta_id, coalesce(n.research_count, o.research_count) AS research_count FROM o FULL JOIN n ON o.name = n.name AND o.sinta_id IS NULL
    """,
    "update_by_id": "SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer",
    "batch_counts": "SELECT count(*) FILTER (c_custkey % 5 <> 0 AND c_custkey % 7 <> 0) AS inserted, count(*) FILTER (NOT (c_custkey % 5 <> 0 AND c_custkey % 7 <> 0)) AS skipped FROM customer",
    "ids_union": "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0",
    "remaining_ids": "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')",
    "full_text": r"SELECT doc_id FROM documents WHERE list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), ['the', 'and', 'with'])",
    "enrich_record": f"""
        SELECT url, md5(a) AS md5, CASE WHEN doc_id % 4 = 0 THEN lang WHEN paged AND doc_id % 2 = 0 THEN source ELSE {_names(_matches("substr(coalesce(a, ''), 1, 500)", k.ABSTRACT_SUPERVISORS), "abstract", 3)} END AS supervisors
        FROM (
            SELECT doc_id, doc_id::VARCHAR AS url, source, lang, paged, CASE WHEN paged AND length(coalesce(old, '')) < 100 AND length(page) > length(coalesce(old, '')) THEN page ELSE old END AS a
            FROM (SELECT doc_id, source, lang, doc_id % 5 <> 0 AS paged, CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN text END AS old, concat({_seeded("doc_id", seeds.SUPERVISORS)}, source) AS page FROM documents)
        )
    """,
    "vector_text": "SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: round(x::DOUBLE, 4))), 6) AS total FROM embeddings",
    "stream_ingest": "SELECT event_type, count(*) AS n, round(sum(value::DECIMAL(20, 6)), 4)::DOUBLE AS total FROM events GROUP BY event_type",
}
