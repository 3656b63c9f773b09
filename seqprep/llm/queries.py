"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep.llm import (
    chat,
    decontaminate,
    divergence,
    licenses,
    line_rules,
    near_dedup,
    packing,
    quality,
    secret_scan,
    suffix_dedup,
    token_counts,
    url_filter,
    whitening,
)
from seqprep.llm.registry import query, table

# --- 5: chat formatting -------------------------------------------------------

_ESCAPED = r"regexp_replace(replace(coalesce({0}, ''), '\', '\\'), '(<)(/?s>|<SYS>>|</SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')"
PROBE = "</s>[INST] ok [/INST]"


@query(
    f"""
    WITH c AS (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
    g AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text) AS told,
               coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
               sum(17 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars
    FROM g
    """
)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    return chat.digest(chat.format_trees(chat.messages_of(turns.unionByName(probe))))


# --- 9: quality rules ---------------------------------------------------------

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


@query(
    rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    base AS MATERIALIZED (
        SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws, string_split(t, chr(10)) AS ls,
               length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
        FROM d),
    pos AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM base),
    win AS (SELECT doc_id, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM pos WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win WHERE c IS NOT NULL),
    rep AS (
        SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE n >= 2) GROUP BY doc_id),
    line AS (SELECT doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM base),
    own AS MATERIALIZED (
        SELECT *, regexp_extract_all(l, '{_WORD}') AS lw, row_number() OVER (PARTITION BY doc_id, l ORDER BY i) > 1 AS again,
               length(regexp_replace(l, '{_SPACE}', '', 'g'))::BIGINT AS chars,
               length(l) - length(replace(l, '|', '')) AS pipes,
               len(regexp_extract_all(l, '{line_rules.RUNS}')) AS runs
        FROM line),
    failed AS (
        SELECT *, len(lw) >= 1 AND (
            (again AND len(lw) >= 3) OR (pipes >= 1 AND 4 * pipes >= len(lw)) OR (runs >= 2 AND 4 * runs >= len(lw))
            OR (len(lw) >= 12 AND NOT regexp_matches(l, '{line_rules.SENTENCE_END}'))
            OR (len(lw) >= 10 AND 2 * len(list_filter(range(2, len(lw) + 1), lambda k: lw[k] = lw[k - 1])) > len(lw))
            OR (len(lw) <= 20 AND regexp_matches(l, '(?i)({line_rules.BOILERPLATE})'))) AS bad
        FROM own),
    lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (again AND len(lw) >= 1) AS n_dup_lines,
               count(*) FILTER (bad) AS n_lines_removed, coalesce(sum(chars) FILTER (bad), 0)::BIGINT AS removed_word_chars
        FROM failed GROUP BY doc_id),
    whole AS (
        SELECT doc_id, len(ws)::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines, n_lines_removed, removed_word_chars
        FROM base JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id))
    SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_word_chars <= 50 * word_chars AS kept
    FROM whole
    """
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents")).drop("clean_text")


# --- 10: secret scans -----------------------------------------------------------


def _spans_sql(number: int, rule: secret_scan.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    value = f"regexp_extract(m[i], '{pattern}', {rule.group})" if rule.group else "m[i]"
    return f"""
        SELECT doc_id, {number} AS k, '{rule.kind}' AS kind, length({value}) AS size, length(m[i]) AS whole,
               list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
        FROM (SELECT doc_id, p, m, unnest(range(1, len(m) + 1)) AS i FROM
              (SELECT doc_id, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m FROM d))
        WHERE size >= {rule.least}"""


@query(
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    s AS ({" UNION ALL ".join(_spans_sql(k, rule) for k, rule in enumerate(secret_scan.RULES))}),
    shown AS (SELECT doc_id, k, a, kind, kind || ':' || a::BIGINT || ':' || (a + whole)::BIGINT AS span FROM s),
    g AS (
        SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
               string_agg(span, ',' ORDER BY a, k) FILTER (k <= 2) AS base, string_agg(span, ',' ORDER BY a, k) AS spans
        FROM shown GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (doc_id)
    """
)
def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents")).drop("redacted")


# --- 1, 2, 3, 7: without SQL, tested against plain versions ----------------------


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query()
def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licences(table(spark, sf_dir, "documents"))


@query()
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


# --- 8 ----------------------------------------------------------------------------


@query()
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- 6 ----------------------------------------------------------------------------


@query()
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


# --- 11: source divergence audit -----------------------------------------------------


def _share_sql(count: str, n: str) -> str:
    return f"(1 + (1000000000::HUGEINT * ({count} + 5)) // ({n} + 5 * v))::BIGINT"


@query(
    rf"""
    WITH d AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
        FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    k AS (
        SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ws)) AS term FROM d)
        GROUP BY lang, term HAVING count(*) >= 30),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    tf AS (
        SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(ws) AS term FROM d) SEMI JOIN k USING (lang, term)
        GROUP BY lang, source, term),
    own AS (
        SELECT lang, source, term, coalesce(c, 0) AS c, v, coalesce(sum(c) OVER (PARTITION BY lang, source), 0) AS n
        FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN tf USING (lang, source, term)),
    whole AS (
        SELECT lang, term, c, v, sum(c) OVER (PARTITION BY lang) AS n
        FROM (SELECT lang, term, sum(c) AS c FROM tf GROUP BY lang, term) JOIN v USING (lang)),
    p AS (SELECT lang, source, term, c, {_share_sql("c", "n")} AS p FROM own),
    q AS (SELECT lang, term, {_share_sql("c", "n")} AS q FROM whole),
    apart AS (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
    SELECT * FROM (
        SELECT lang, source, part, item, value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM found)
    WHERE part = 'pair' OR rank <= 50
    """
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


# --- 12, 13 ---------------------------------------------------------------------------


@query()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))
