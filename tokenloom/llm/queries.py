"""One query for each operator of this package, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import ann, bpe, html, importance, licenses, mixing, near, pii, repair, rules, substrings, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Where the tokenizer file lies on every machine.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_license_scans(spark, sf):
    docs = _table(spark, sf, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(docs.select(path.alias("path"), "text"))


@query
def op2_nearest_neighbours(spark, sf):
    return ann.search(_table(spark, sf, "embeddings"), F.col("id") % 20 == 0)


@query
def op3_bpe(spark, sf):
    return bpe.round_trip(_table(spark, sf, "documents"), TOKENIZER)


@query
def op4_substring_dedup(spark, sf):
    return substrings.dedupe(_table(spark, sf, "documents"))


@query
def op5_near_duplicates(spark, sf):
    return near.class_ids(_table(spark, sf, "documents"))


@query
def op6_mixing(spark, sf):
    return mixing.shares(_table(spark, sf, "documents"))


@query
def op7_toxicity(spark, sf):
    docs = _table(spark, sf, "documents")

    def held_out(key):
        return F.crc32(key.cast("string")) % 5 == 0

    model = toxicity.fit(docs, _table(spark, sf, "labels"), held_out=held_out(F.col("id")))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


@query
def op8_personal_data(spark, sf):
    return pii.find(_table(spark, sf, "documents"))


@query
def op9_importance_resampling(spark, sf):
    return importance.resample(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query
def op10_quality_rules(spark, sf):
    return rules.measure(_table(spark, sf, "documents"))


@query
def op11_conversation_repair(spark, sf):
    return repair.audit(_table(spark, sf, "conversations"), damaged=True)


@query
def op12_whitening(spark, sf):
    # A sum that is beyond a long raises; the operator has it as a decimal.
    return whitening.whiten(_table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_html_extraction(spark, sf):
    return html.extract(_table(spark, sf, "pages"))


SQL: dict[str, str] = {}

SQL["op4_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 12], chr(10))) AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d)
), late AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE doc_id > first
), gone AS (
  SELECT DISTINCT r, i + j AS pos FROM late, (SELECT unnest(range(0, 13)) AS j)
), words AS (
  SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
  FROM words ANTI JOIN gone USING (r, pos) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_WORD = r"[^\x20\x09-\x0D]+"
_PHRASES = "|".join(rules.PHRASES)
_MARKS = "".join(rules.SENTENCE_MARKS)
SQL["op10_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), l AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d
), lines AS (
  SELECT r, i, line, regexp_extract_all(line, '{_WORD}') AS w FROM l
), paragraphs AS (
  SELECT *, regexp_matches(line, '[{_MARKS}]') AS marked,
    count(*) FILTER (len(w) = 0) OVER (PARTITION BY r ORDER BY i) AS paragraph
  FROM lines
), judged AS (
  SELECT r, line, len(w) AS n,
    length(regexp_replace(line, '[^!?#*$%&|<>{{}}=_~^]', '', 'g')) > len(w)
    OR (len(list_filter(w, lambda x: x IN ('|', '>', '/', '»', '•', '·'))) >= 2
        AND 5 * len(list_filter(w, lambda x: x IN ('|', '>', '/', '»', '•', '·'))) >= len(w))
    OR (len(w) BETWEEN 4 AND {rules.SHORT_LINE} AND i > coalesce(max(i) FILTER (marked) OVER (PARTITION BY r, paragraph), -1))
    OR (len(w) <= {rules.SHORT_LINE} AND regexp_matches(lower(line), '{_PHRASES}'))
    OR (len(w) >= {rules.SHORTEST_RUN} AND 2 * list_sum(list_transform(range(0, len(w), {rules.RUN}), lambda k:
        CASE WHEN len(w[k + 1:k + {rules.RUN}]) >= {rules.SHORTEST_RUN}
          AND 4 * len(list_distinct(w[k + 1:k + {rules.RUN}])) <= len(w[k + 1:k + {rules.RUN}])
        THEN len(w[k + 1:k + {rules.RUN}]) ELSE 0 END)) > len(w)) AS fails
  FROM paragraphs WHERE len(w) > 0
), by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN fails THEN n ELSE 0 END) AS n_lost
  FROM judged GROUP BY r
), words AS (
  SELECT r, t, doc_id, regexp_extract_all(t, '{_WORD}') AS w FROM d
), windows AS (
  SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n_repeat_words
  FROM repeated, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lost, 0)::BIGINT AS n_lost
  FROM words LEFT JOIN by_line USING (r) LEFT JOIN covered USING (r)
)
SELECT *, n_words < {rules.FEWEST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {rules.FEWEST_WORDS} OR 100 * n_repeat_words > 50 * n_words)
    AND n_lost <= {rules.MOST_LOST} * n_words AS kept
FROM measured
"""


def _notice_sql() -> str:
    """The licence of a line that is a notice and nothing else."""

    def text(pattern: str) -> str:
        return pattern.replace("'", "''")

    marks, under, rest = text(licenses._MARKS), text(licenses._UNDER), text(licenses._REST)
    named = "\n".join(
        f"""    WHEN (regexp_matches(line, '^{marks}(?:the[ ])?(?:{p})[ .]*{marks}$') AND regexp_matches(line, 'licen[sc]e'))
      OR regexp_matches(line, '^{marks}{under}(?:{p})(?:[ ]licen[sc]e)?{rest}[ .]*{marks}$') THEN '{name}'"""
        for name, p in licenses.NOTICES
    )
    spelling = ", ".join(f"'{n.lower()}': '{n}'" for n in licenses.SPDX)
    return rf"""SELECT r, coalesce(
    CASE WHEN len(tag) > 0 AND len(list_filter(tag, lambda x: x IS NULL)) = 0
      THEN replace(replace(array_to_string(tag, ' '), '( ', '('), ' )', ')') END,
    CASE
{named}
    END) AS licence
  FROM (
    SELECT r, line, list_transform(
      list_filter(regexp_split_to_array(regexp_replace(regexp_extract(line, '{text(licenses._TAG)}', 1), '([()])', ' \1 ', 'g'), ' +'), lambda x: x <> ''),
      lambda x: CASE WHEN x IN ('(', ')') THEN x ELSE MAP {{{spelling}}}[x] END) AS tag
    FROM (SELECT DISTINCT r, unnest(string_split(low, chr(10))) AS line FROM d WHERE regexp_matches(low, '{licenses.NOTICE_CUE}'))
    WHERE regexp_matches(line, '{licenses.NOTICE_CUE}')
  )"""


def _license_sql() -> str:
    """Cosine of every line, paragraph and whole text with a cue to each template, and notices; all paths here are dir/dir/name."""
    rows = [
        f"({i}, '{name}', '{term}', {n})"
        for i, ((name, _), counts) in enumerate(zip(licenses.TEMPLATES, licenses.template_terms(), strict=True))
        for term, n in counts.items()
    ]
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, lower(coalesce(text, '')) AS low
  FROM documents
), tpl(t, licence, term, n) AS (VALUES {', '.join(rows)}),
total AS (SELECT count(*) AS docs FROM d),
found AS (
  SELECT term, count(*) AS df
  FROM (SELECT unnest(list_distinct(regexp_extract_all(low, '{licenses.TERM}'))) AS term FROM d) GROUP BY term
), idf AS (
  SELECT term, ln((docs + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT term FROM tpl) LEFT JOIN found USING (term), total
), norms AS (
  SELECT t, licence, sqrt(sum(pow(n * idf, 2))) AS norm FROM tpl JOIN idf USING (term) GROUP BY t, licence
), units AS (
  SELECT r, low, unnest(list_distinct(list_concat([low], list_filter(
    list_concat(string_split(low, chr(10)), regexp_split_to_array(low, '
[ 	]*
')),
    lambda x: regexp_matches(x, '{licenses.CUE}'))))) AS u
  FROM d WHERE regexp_matches(low, '{licenses.CUE}')
), notices AS (
  {_notice_sql()}
), numbered AS (SELECT r, u = low AS whole, u, row_number() OVER () AS k FROM units),
terms AS (
  SELECT r, whole, k, term, count(*) AS tf
  FROM (SELECT r, whole, k, unnest(regexp_extract_all(u, '{licenses.TERM}')) AS term FROM numbered) GROUP BY ALL
), weighed AS (
  SELECT r, whole, k, term, tf, idf IS NULL AS strange, tf * coalesce(idf, ln(docs + 1) + 1) AS w FROM terms LEFT JOIN idf USING (term), total
), lengths AS (
  SELECT k, sqrt(sum(w * w)) AS length,
    sum(tf) >= {licenses.FILE_WORDS} AND {licenses.STRANGE} * coalesce(sum(tf) FILTER (strange), 0) <= sum(tf) AS is_long
  FROM weighed GROUP BY k
), cosines AS (
  SELECT r, whole AND any_value(is_long) AS whole, licence, round(sum(w * n * idf) / (any_value(length) * any_value(norm)), 6) AS score
  FROM weighed JOIN tpl USING (term) JOIN idf USING (term) JOIN norms USING (t, licence) JOIN lengths USING (k)
  GROUP BY r, whole, k, t, licence
  UNION ALL
  SELECT r, false, licence, 1.0 FROM notices WHERE licence IS NOT NULL
), best AS (
  SELECT r, licence, score, max(CASE WHEN whole THEN score END) OVER (PARTITION BY r) AS whole FROM cosines
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, licence DESC) = 1
), own AS (
  SELECT path, regexp_replace(path, '/[^/]*$', '') AS dir, coalesce(whole >= {licenses.FILE}, false) AS licence_file,
    CASE WHEN score >= {licenses.HEADER} OR whole >= {licenses.FILE} THEN licence END AS own_licence, score
  FROM d LEFT JOIN best USING (r)
), licensed AS (
  SELECT dir, own_licence AS near_licence FROM own WHERE licence_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, own_licence) = 1
)
SELECT path, own_licence, CASE WHEN own_licence IS NOT NULL THEN score END AS score, licence_file,
  CASE WHEN own_licence IS NULL AND near_licence IS NOT NULL THEN dir END AS from_dir,
  coalesce(own_licence, near_licence) AS licence
FROM own LEFT JOIN licensed USING (dir)
"""


SQL["op6_mixing"] = r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 'null') AS src, source IS NULL AS last,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('42-' || coalesce(doc_id::VARCHAR, '') || '-' || md5(coalesce(text, ''))), 1, 11))::BIGINT AS place
  FROM documents
), s AS (
  SELECT src, last, sum(size)::BIGINT AS source_size FROM d GROUP BY src, last
), w AS (
  SELECT src, source_size, 2.0 * source_size AS cap,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY last, src) - 1) % 3) + 1] AS w
  FROM s
), filled AS (
  -- Sources in the order in which they fill up; the level if the first k of them are full.
  SELECT *, row_number() OVER o AS k, sum(cap) OVER o - cap AS used, sum(w) OVER () - sum(w) OVER o + w AS free
  FROM w WINDOW o AS (ORDER BY cap / w, src ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT min_by((total - used) / free, k) AS level
  FROM filled, (SELECT 1.5 * sum(source_size) AS total FROM s)
  WHERE w * (total - used) / free <= cap
), target AS (
  SELECT src, source_size, least(cap, w * level)::DOUBLE AS target FROM filled, level
), placed AS (
  SELECT *, round(target)::BIGINT AS budget,
    (sum(size) OVER (PARTITION BY src ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM d JOIN target USING (src)
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
    + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM placed
"""
SQL["op1_license_scans"] = _license_sql()


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
