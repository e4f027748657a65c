"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.llm import (
    decontamination,
    divergence,
    jaccard,
    languages,
    lexical,
    mixing,
    neighbours,
    private,
    quality,
    repeats,
    tokens,
    toxicity,
    warc,
)
from dripline.llm.common import table
from dripline.llm.registry import query

JACCARD_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM split),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS c
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (n + m - c)),
reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = r)
SELECT s.doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(r) AS component_id
FROM sets s JOIN reach USING (doc_id) GROUP BY s.doc_id
"""

REPEATS_SQL = f"""
WITH raw AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
hexed AS (SELECT doc_id, octet_length(t) AS n, hex(t) AS h FROM raw),
digests AS (
  SELECT doc_id, list_transform(range(0, n - {repeats.LENGTH} + 1),
    lambda p: md5_number(substr(h, 2 * p + 1, {2 * repeats.LENGTH}))) AS d FROM hexed),
starts AS (SELECT doc_id, unnest(d) AS s, unnest(range(0, len(d))) AS p FROM digests),
firsts AS (SELECT s, min({{'doc_id': doc_id, 'p': p}}) AS f FROM starts GROUP BY s),
marked AS (
  SELECT doc_id, p, (doc_id, p) <> (f.doc_id, f.p) AS again FROM starts JOIN firsts USING (s)),
runs AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {repeats.LENGTH}, true) AS fresh
  FROM marked WHERE again),
numbered AS (SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM runs),
spans AS (SELECT doc_id, k, min(p) AS a, max(p) + {repeats.LENGTH} AS b FROM numbered GROUP BY 1, 2),
lists AS (SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, list(a ORDER BY a) AS s, list(b ORDER BY a) AS e
  FROM spans GROUP BY 1),
pieces AS (
  SELECT h.doc_id, n, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, h,
    list_prepend(0, coalesce(e, [])) AS f, list_append(coalesce(s, []), n) AS t
  FROM hexed h LEFT JOIN lists USING (doc_id))
SELECT doc_id, n AS n_bytes, n_removed, n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(f) + 1), lambda i: substr(h, 2 * f[i] + 1, 2 * (t[i] - f[i]))), '')))
    AS kept_sha256
FROM pieces
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DIVERGENCE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, {LOWER.format("coalesce(text, '')")} AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c, count(DISTINCT r) AS d FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(c) AS c FROM counts GROUP BY ALL HAVING sum(d) >= {divergence.LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT s.lang, s.source, k.term, coalesce(t.c, 0) AS c, k.c AS k
  FROM sources s JOIN kept k USING (lang) LEFT JOIN counts t USING (lang, source, term)),
sums AS (SELECT lang, source, sum(c) AS n FROM grid GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, term, g.c,
    1 + (1000000000::HUGEINT * (g.c + 5)) // (s.n + 5 * v) AS p, 1 + (1000000000::HUGEINT * (g.k + 5)) // (l.n + 5 * v) AS q
  FROM grid g JOIN sums s USING (lang, source) JOIN langs l USING (lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= {divergence.TOP}
"""

LEXICAL_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
whole AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM docs WHERE len(w) > 0),
asked AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id,
      unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
    FROM benchmark) GROUP BY ALL),
uses AS (
  SELECT r, doc_id, size, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS size, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM uses, whole GROUP BY t),
scores AS (
  SELECT item_id, r, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n) // l))))::BIGINT AS score
  FROM uses JOIN weights USING (t) JOIN asked USING (t), whole GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {lexical.TOP}
"""


@query("op1_ngram_jaccard_join", JACCARD_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, folder, "documents"))


@query("op2_nearest_neighbours")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.approximate_neighbours(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query("op3_quality_scores")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_decontamination")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_personal_data")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return private.personal_digests(table(spark, folder, "documents"))


@query("op6_warc_derivatives")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_derivatives(table(spark, folder, "pages"))


@query("op7_repeated_strings", REPEATS_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, folder, "documents"))


@query("op8_source_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


@query("op9_token_ids")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_digests(table(spark, folder, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op11_source_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(table(spark, folder, "documents"))


@query("op12_language")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return languages.language_scores(table(spark, folder, "documents"))


@query("op13_lexical_search", LEXICAL_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.lexical_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
