"""Registered queries of this subpackage and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, fim, language, linededup, merkle, mixing, neardup, quality, tokencounts, tokenfile, toxicity, veccodes, warc
from .tables import read, scratch, staged


def tokenizer_file(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-file")
    tokenfile.write_tokens(read(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return tokenfile.token_index(tokenfile.read_tokens(spark, path))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.fingerprints(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                        "changed.sections", "changed.paragraphs")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(read(spark, sf_dir, "documents"))
    form, output = F.col("fim.form"), F.col("fim.output")
    return made.select("doc_id", "fim.n", "fim.form", F.col("fim.prefix_units").alias("prefix_chars"),
                       F.col("fim.middle_units").alias("middle_chars"), F.sha2(output, 256).alias("output_sha256"),
                       F.sha2(fim.restored(form, output), 256).alias("restored_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    books = veccodes.learned(vectors)
    coded = veccodes.encoded(vectors, books).select("vec_id", "label", "coded.code", "coded.error")
    rows = veccodes.with_label_error(staged(coded, "vector-codes"))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = linededup.dedup_lines(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_token_file": op1_token_file,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_warc_index": op4_warc_index,
    "op5_decontaminate": op5_decontaminate,
    "op6_mix_sources": op6_mix_sources,
    "op7_fingerprints": op7_fingerprints,
    "op8_quality": op8_quality,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language": op10_language,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_vector_codes": op12_vector_codes,
    "op13_line_dedup": op13_line_dedup,
}

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _assigned(out: str, books: str) -> str:
    """Entry and squared distance of each part: the least of 64 * distance + entry."""
    return f"""{out} AS MATERIALIZED (SELECT r, pos, x, m % 64 AS entry, m // 64 AS d FROM (
    SELECT r, p.pos, any_value(p.x) AS x, min(64 * CAST(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x)
           + list_inner_product(c.x, c.x) AS BIGINT) + entry) AS m FROM p JOIN {books} c ON p.pos = c.pos GROUP BY r, p.pos))"""


def _recentred(out: str, books: str, members: str) -> str:
    return f"""{out} AS MATERIALIZED (SELECT c.pos, c.entry, coalesce(n.x, c.x) AS x FROM {books} c LEFT JOIN (
    SELECT pos, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS x FROM (
        SELECT pos, entry, j, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (
            SELECT pos, entry, unnest(x) AS v, unnest(range(len(x))) AS j FROM {members}) GROUP BY pos, entry, j) GROUP BY pos, entry) n
    ON c.pos = n.pos AND c.entry = n.entry)"""


def _sections(x: str) -> str:
    """Section hashes of a list of paragraph hashes: a section ends at a hash that begins with 0 or 1."""
    ends = f"list_filter(range(1, len({x}) + 1), lambda i: {x}[i][1] IN ('0', '1') OR i = len({x}))"
    return (f"list_transform({ends}, lambda e: sha256(array_to_string({x}[coalesce(list_max(list_filter({ends}, "
            f"lambda i: i < e)), 0) + 1 : e], '')))")


def _agreed(x: str, y: str) -> str:
    """How many elements two lists have in common at their start."""
    return f"coalesce(list_min(list_filter(range(1, least(len({x}), len({y})) + 1), lambda i: ({x})[i] <> ({y})[i])) - 1, least(len({x}), len({y})))"


def _changed(x: str, y: str, head: str, end: str) -> str:
    """Places, from 0, of the elements of ``x`` between the agreeing ends that the rest of ``y`` has not."""
    tail = f"least({end}, least(len({x}), len({y})) - {head})"
    return (f"list_transform(list_filter(range({head} + 1, len({x}) - {tail} + 1), "
            f"lambda i: NOT list_contains({y}[{head} + 1 : len({y}) - {tail}], {x}[i])), lambda i: CAST(i - 1 AS INTEGER))")


ORACLE = {
    "op5_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n,
              list_aggregate(w[p : p + least(len(w), 13) - 1], 'string_agg', ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, p, n, list_aggregate(w[p : p + n - 1], 'string_agg', ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
    "op12_vector_codes": f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT r, pos, v[pos * (len(v) // 16) + 1 : (pos + 1) * (len(v) // 16)] AS x FROM e, range(16) t(pos)),
c0 AS (SELECT pos, r - 1 AS entry, x FROM p WHERE r <= 64),
{_assigned("a0", "c0")},
{_recentred("c1", "c0", "a0")},
{_assigned("a1", "c1")},
{_recentred("c2", "c1", "a1")},
{_assigned("a2", "c2")},
codes AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: CAST(v AS BIGINT)), ','), ',' ORDER BY pos, entry)) FROM c2) AS codebooks_sha256
FROM e JOIN codes USING (r)""",
    "op13_line_dedup": """
WITH l AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
           FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) + CAST(bool_or(doc_id IS NULL) AS INTEGER) >= 3),
m AS (SELECT k.*, h.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id""",
    "op4_warc_index": r"""
WITH p AS (SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
r AS (SELECT *, coalesce(payload_bytes >= 100 AND page_id <> first, false) AS revisit,
             regexp_extract(trim(coalesce(url, '')), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)(?:[?]([^#]*))?', ['host', 'path', 'query']) AS u FROM f),
k AS (SELECT *, array_to_string(list_reverse(string_split(regexp_replace(lower(u.host), '^www[.]', ''), '.')), ',') || ')'
             || CASE WHEN rtrim(u.path, '/') = '' THEN '/' ELSE lower(rtrim(u.path, '/')) END
             || CASE WHEN u.query <> '' THEN '?' || lower(u.query) ELSE '' END AS url_key,
             strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0)), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM r)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN first END AS refers_to, url_key, captured,
       row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS position FROM k""",
    "op7_fingerprints": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM d),
e AS (SELECT *, length(text) AS n_chars, substring(text, 1, CAST(length(text) - length(text) // 3 AS BIGINT))
             || substring(next, 1, CAST(length(text) // 3 AS BIGINT)) AS edited FROM n),
h AS (SELECT *, list_transform(string_split(replace(text, '. ', '.' || chr(10)), chr(10)), lambda x: sha256(x)) AS a,
             list_transform(string_split(replace(edited, '. ', '.' || chr(10)), chr(10)), lambda x: sha256(x)) AS b,
             list_transform(string_split(replace(next, '. ', '.' || chr(10)), chr(10)), lambda x: substring(sha256(x), 1, 12)) AS c FROM e),
s AS (SELECT *, {_sections('a')} AS sa, {_sections('b')} AS sb,
             list_transform(a, lambda x: substring(x, 1, 12)) AS pa, list_transform(b, lambda x: substring(x, 1, 12)) AS pb FROM h),
g AS (SELECT *, {_agreed('sb', 'sa')} AS s_head, {_agreed('list_reverse(sb)', 'list_reverse(sa)')} AS s_end,
             {_agreed('b', 'a')} AS p_head, {_agreed('list_reverse(b)', 'list_reverse(a)')} AS p_end FROM s)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
       sha256(array_to_string(sa, '')) || ':' || array_to_string(pa, '.') AS fingerprint,
       sha256(array_to_string(sb, '')) || ':' || array_to_string(pb, '.') AS edited_fingerprint,
       2.0 * len(list_intersect(pa, pb)) / (len(list_distinct(pa)) + len(list_distinct(pb))) AS near_edited,
       2.0 * len(list_intersect(pa, c)) / (len(list_distinct(pa)) + len(list_distinct(c))) AS near_next,
       {_changed('sb', 'sa', 's_head', 's_end')} AS sections, {_changed('b', 'a', 'p_head', 'p_end')} AS paragraphs FROM g""",
    "op6_mix_sources": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
r AS (SELECT *, 2 * source_size AS cap, 2.0 * source_size / weight AS full_at FROM s),
o AS (SELECT full_at, row_number() OVER w AS k, sum(cap) OVER w - cap AS clamped,
             (SELECT sum(weight) FROM r WHERE source_size > 0) - sum(weight) OVER w + weight AS free
      FROM r WHERE source_size > 0 WINDOW w AS (ORDER BY full_at, cap, source ROWS UNBOUNDED PRECEDING)),
l AS (SELECT k, full_at, CAST(1.5 * (SELECT sum(source_size) FROM s) - clamped AS DOUBLE) / CAST(free AS DOUBLE) AS level FROM o),
f AS (SELECT arg_min(level, k) AS level FROM l WHERE level <= full_at),
t AS (SELECT source, source_size,
             CASE WHEN source_size = 0 THEN 0.0 ELSE least(CAST(cap AS DOUBLE), (SELECT level FROM f) * weight) END AS target FROM r),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
u AS (SELECT source, doc_id, size, size * count(*) AS unit, md5('mix-1|' || CAST(doc_id AS VARCHAR)) AS key FROM d GROUP BY 1, 2, 3),
c AS (SELECT u.*, sum(unit) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - unit AS done FROM u)
SELECT d.doc_id, d.size, e.source_size, e.target,
       CAST(d.size * (e.whole + CASE WHEN e.target - e.whole * e.source_size > 0
            AND 2 * c.done + c.unit <= 2 * (e.target - e.whole * e.source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.doc_id = d.doc_id AND c.size = d.size""",
}
