"""The subpackage's registered queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwatch.llm import (exact_dedup, fair_mix, line_dedup, mil_quality, ngram_join, packing, pii_disclosure, quality_divergence,
                          secret_ownership, source_audit, token_alignment, token_counts, token_files)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_divergence.quality_rules(_table(spark, sf_dir, "documents"))


def op2_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.personal_data(_table(spark, sf_dir, "documents"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.scan_secrets(_table(spark, sf_dir, "documents"))


def op4_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix_shares(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


def op10_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mil_quality.score(docs, mil_quality.train(docs, _table(spark, sf_dir, "labels")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(_table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(_table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_distribution_divergence, op2_disclosure_sanitisation, op3_secret_ownership, op4_fair_queue_mix, op5_token_counts, op6_ngram_jaccard, op7_exact_dedup, op8_sum_of_squares_packing,
                                   op9_token_files, op10_attention_quality, op11_token_alignment, op12_line_dedup, op13_source_audit)}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

_LISTS = " ".join(f"WHEN '{lang}' THEN {words!r}" for lang, words in quality_divergence.COMMON_WORDS.items())
_CLASS_COUNTS = ", ".join("len(regexp_extract_all(t, '" + p.replace("'", "''").replace('\\"', '"') + "'))" for p in quality_divergence.CLASSES)


def _distance(counts: str, reference: str) -> str:
    """SQL of the Jensen-Shannon distance of two lists of counts."""
    x, y = f"{counts}[i] / list_sum({counts})", f"{reference}[i] / list_sum({reference})"
    part = lambda z: f"CASE WHEN {z} > 0 THEN {z} * ln({z} / (({x} + {y}) / 2)) ELSE 0 END"
    terms = f"list_transform(range(1, len({counts}) + 1), lambda i: {part(x)} + {part(y)})"
    return (f"CASE WHEN list_sum({counts}) > 0 AND list_sum({reference}) > 0 THEN "
            f"round(sqrt(greatest(list_sum({terms}) / 2 / ln(2), 0)), 6) END")


_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM again, (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS (SELECT *, length(array_to_string(w, '')) AS word_chars, [{_CLASS_COUNTS}] AS found, CASE lang {_LISTS} END AS cw FROM d),
hist AS (SELECT *, [word_chars - list_sum(found), length(t) - word_chars] || found AS classes,
           list_transform(cw, lambda c: len(list_filter(w, lambda x: x = c))) AS hits FROM counted),
full_hist AS (SELECT *, hits || [len(w) - list_sum(hits)] AS common FROM hist),
refs AS (SELECT lang AS ref_lang,
           CASE WHEN count(cw) > 0 OR count(*) > 1 THEN [{", ".join(f"sum(classes[{i}])" for i in range(1, 8))}] END AS ref_classes,
           CASE WHEN count(cw) > 0 THEN [{", ".join(f"sum(common[{i}])" for i in range(1, 22))}] END AS ref_common FROM full_hist GROUP BY lang),
judged AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, found[3]::BIGINT AS n_symbols,
             coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, length(t) AS n_chars,
             {_distance("classes", "ref_classes")} AS char_distance, {_distance("common", "ref_common")} AS word_distance
           FROM full_hist LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN refs ON lang IS NOT DISTINCT FROM ref_lang),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM judged)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
       NOT coalesce(base_failed OR (n_chars >= {quality_divergence.MIN_JUDGED_CHARS} AND char_distance > {quality_divergence.MAX_CHAR_DISTANCE})
                    OR (n_words >= {quality_divergence.MIN_JUDGED_WORDS} AND word_distance > {quality_divergence.MAX_WORD_DISTANCE}), base_failed) AS kept
FROM failed"""


def _secret_kind(k: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return (f"SELECT r, '{kind}' AS kind, {k} AS k, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS e, length(hit) AS n, value "
            f"FROM (SELECT r, unnest(string_split_regex(t, '{p}')) AS gap, unnest(regexp_extract_all(t, '{p}', 0)) AS hit, "
            f"unnest(regexp_extract_all(t, '{p}', {group})) AS value, unnest(range(1, len(string_split_regex(t, '{p}')) + 1)) AS i FROM d) "
            f"WHERE hit IS NOT NULL QUALIFY length(value) >= {least}")


_SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS owner, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(f"({_secret_kind(k, *x)})" for k, x in enumerate((*secret_ownership.BASE_KINDS, secret_ownership.OPAQUE)))}),
looked AS (SELECT *, len(list_distinct(string_split(value, ''))) >= {secret_ownership.LIVE_VARIETY} AND regexp_matches(value, '[0-9]')
             AND regexp_matches(value, '[A-Za-z]') AS random FROM found),
cand AS (SELECT c.*, owner, repo, md5(t) AS same FROM looked c JOIN d USING (r) WHERE kind <> 'opaque' OR random),
owned AS (SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repo)) AS n_repos, count(DISTINCT same) AS n_texts FROM cand GROUP BY value),
firsts AS (SELECT value, same, min(owner) AS owner FROM cand GROUP BY value, same),
holders AS (SELECT value, count(DISTINCT owner) AS n_holders FROM firsts GROUP BY value),
counted AS (SELECT *, n_owners >= {secret_ownership.EXAMPLE_OWNERS} OR n_repos >= {secret_ownership.EXAMPLE_REPOS} OR n_texts >= {secret_ownership.EXAMPLE_TEXTS} AS copied
            FROM cand JOIN owned USING (value) JOIN holders USING (value)),
judged AS (SELECT *, random AND n_holders = 1 AND NOT copied AS live FROM counted),
per AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
          string_agg(kind || ':' || (e - n) || ':' || e, ',' ORDER BY e - n, k) FILTER (kind <> 'opaque') AS base,
          string_agg(kind || ':' || (e - n) || ':' || e, ',' ORDER BY e - n, k) AS spans,
          count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied
        FROM judged WHERE kind <> 'opaque' OR live GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied
FROM d LEFT JOIN per USING (r)"""

_SIMILAR = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
met AS (SELECT a.r AS u, b.r AS v, count(*) AS o FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
links AS (SELECT u, v FROM met JOIN sizes a ON a.r = u JOIN sizes b ON b.r = v WHERE 100 * o >= 85 * (a.n + b.n - o)),
reach(u, v) AS (SELECT r, r FROM d UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (r) JOIN reach ON reach.u = d.r JOIN d o ON o.r = reach.v GROUP BY d.r, d.doc_id"""

_LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
shared AS (SELECT k, min(doc_id) AS own FROM keyed WHERE length(k) >= {line_dedup.LEAST_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT r, doc_id, line, i, own IS NOT NULL AND own <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id"""


def _share(count: str, total: str) -> str:
    return f"1 + 1000000000::HUGEINT * ({count} + 2) // ({total} + 2 * v)"


_AUDIT = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS all_n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {source_audit.LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(all_n) AS all_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, all_n, coalesce(n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, {_share("n", "sum(n) OVER (PARTITION BY lang, source)")} AS p, {_share("all_n", "all_total")} AS q FROM cells JOIN langs USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
         FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND item = b.source),
mark AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM mark) QUALIFY part = 'pair' OR rank <= {source_audit.TOP}"""

ORACLES: dict[str, str] = {
    "op1_distribution_divergence": _QUALITY,
    "op3_secret_ownership": _SECRETS,
    "op6_ngram_jaccard": _SIMILAR,
    "op12_line_dedup": _LINES,
    "op13_source_audit": _AUDIT,
    "op4_fair_queue_mix": rf"""
WITH docs AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size FROM documents),
keyed AS (SELECT *, ('0x' || substr(md5('{fair_mix.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size::VARCHAR), 1, 15))::BIGINT AS k FROM docs),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS r FROM per),
weighed AS (SELECT *, [5, 2, 1][(r % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM ranked),
levels AS (SELECT *, (1.5 * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER b, 0)::DOUBLE)
             / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level, cap::DOUBLE / w AS ratio FROM weighed
           WINDOW b AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, CASE WHEN ratio <= level THEN cap::DOUBLE
              ELSE max(CASE WHEN ratio > level THEN level END) OVER () * w END AS target FROM levels),
queued AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
           FROM keyed d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - ahead)) + greatest(0, least(size, floor(target)::BIGINT - ahead - source_size)))::BIGINT AS taken,
       CASE WHEN target > 0 THEN (ahead + size)::DOUBLE / target END AS virtual_finish FROM queued""",
    "op7_exact_dedup": r"""
WITH docs AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm,
                     row_number() OVER () AS r FROM documents),
ranked AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
           FROM docs WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id ASC NULLS LAST, r ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked""",
}
