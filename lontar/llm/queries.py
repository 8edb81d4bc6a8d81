"""The queries pN_... over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lontar.llm import canonical, incremental, mixing, names, neardup, residue, sourcelines, subjects, tokens
from lontar.llm.catalog import ORACLES, QUERIES, query  # noqa: F401
from lontar.session import cut, small_side
from lontar.sources.tables import table

#: What makes two articles near-duplicates in TESTDATA.md.
P5 = {"n": 3, "threshold": 0.5, "min_words": 60}


@query("p1_found")
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of different bylines that mean the same person or organisation."""
    return names.name_pairs(cut(names.link_names(table(spark, sf, "articles"))))


@query("p1_entities")
def p1_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Each byline that names one person or organisation, with the spelling that stands for the entity."""
    return names.link_names(table(spark, sf, "articles")).select(F.col("name").alias("author_name"), "entity")


_SETS = r"""WITH t AS (SELECT article_id AS id, regexp_extract_all(lower(coalesce(title, '') || chr(10) || coalesce(content_text, '')), '[\p{L}\p{N}_]+') AS w, len(regexp_extract_all(lower(content_text), '[\p{L}\p{N}_]+')) AS n FROM articles),
 g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram FROM t WHERE n >= 60),
 k AS (SELECT id, count(*) AS size, md5(string_agg(gram, '|' ORDER BY gram)) AS h FROM g GROUP BY id),
 shared AS (SELECT x.id AS a, y.id AS b, count(*) AS o FROM g x JOIN g y ON x.gram = y.gram AND x.id < y.id GROUP BY 1, 2),
 near AS (SELECT a, b FROM shared JOIN k x ON x.id = a JOIN k y ON y.id = b WHERE o >= 0.5 * (x.size + y.size - o))"""


@query("p5_found", _SETS + " SELECT a AS article_id_a, b AS article_id_b FROM near")
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of articles that share at least half of the union of their three-word sequences."""
    members, links = neardup.near_duplicates(table(spark, sf, "articles"), **P5)
    return neardup.expand_pairs(cut(members), links).select(F.col("id_a").alias("article_id_a"), F.col("id_b").alias("article_id_b"))


@query("p5_classes", _SETS + """, r AS (SELECT id, min(id) OVER (PARTITION BY h) AS rep FROM k), l AS (SELECT DISTINCT least(x.rep, y.rep) AS p, greatest(x.rep, y.rep) AS q FROM near JOIN r x ON x.id = a JOIN r y ON y.id = b WHERE x.rep <> y.rep),
 e AS (SELECT rep, count(*) AS links FROM (SELECT p AS rep FROM l UNION ALL SELECT q FROM l) GROUP BY rep) SELECT id AS article_id, r.rep AS class_id, coalesce(links, 0) AS links FROM r LEFT JOIN e USING (rep)""")
def p5_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Each eligible article with the class of equal sets it is in and the class's number of links."""
    members, links = neardup.near_duplicates(table(spark, sf, "articles"), **P5)
    ends = links.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    return members.join(ends, "rep", "left").select(F.col("id").alias("article_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


@query("p2_found")
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The entry of category_ref that each article's typed section means, 0 where none fits."""
    reference = table(spark, sf, "category_ref")
    mapped = canonical.map_records(table(spark, sf, "articles").join(small_side(reference.select(F.col("name").alias("category"))), "category", "left_anti"), reference)
    return mapped.select(F.col("id").alias("article_id"), "category_id")


@query("p2_report")
def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every typed section with the entry it maps to and its number of articles; unmatched ones with entry 0."""
    return canonical.report(canonical.map_records(table(spark, sf, "articles"), table(spark, sf, "category_ref"))).withColumnRenamed("value", "category")


P4_SQL = r"""
WITH lines AS (
  SELECT source_id, article_id, unnest(string_split(content_text, chr(10))) AS raw, generate_subscripts(string_split(content_text, chr(10)), 1) AS line_no
  FROM articles WHERE content_text IS NOT NULL
), norm AS (
  SELECT source_id, article_id, line_no, trim(regexp_replace(regexp_replace(lower(raw), '[0-9]', '', 'g'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS line FROM lines
), kept AS (SELECT * FROM norm WHERE regexp_matches(line, '\p{L}')),
sizes AS (SELECT source_id, count(*) AS n_all FROM articles GROUP BY source_id),
counts AS (SELECT source_id, line, count(DISTINCT article_id) AS n_docs FROM kept GROUP BY source_id, line)
SELECT k.article_id, CAST(k.line_no AS INTEGER) AS line_no
FROM kept k JOIN counts c USING (source_id, line) JOIN sizes s USING (source_id)
WHERE c.n_docs >= 5 AND c.n_docs >= 0.02 * s.n_all
"""


@query("p4_found", P4_SQL)
def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Where lines stand that are repeated within their source."""
    return sourcelines.repeated_places(table(spark, sf, "articles")).withColumnRenamed("id", "article_id")


@query("p4_cleaned")
def p4_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Every article's text without the lines repeated within its source."""
    articles = table(spark, sf, "articles")
    return sourcelines.without_lines(articles, sourcelines.repeated_lines(articles)).select(F.col("id").alias("article_id"), F.col("text").alias("content_text"))


@query("p7_ids")
def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_column(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def _mixture(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(mixing.size_documents(table(spark, sf, "documents")), table(spark, sf, "mix_targets"))


@query("p8_mix")
def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Each document used, with its number of uses."""
    return _mixture(spark, sf)[0].select(F.col("id").alias("doc_id"), "source", "tokens", "uses")


@query("p8_report")
def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    """For each listed source the target, the share reached and what is short."""
    return _mixture(spark, sf)[1]


def _key_sql(url: str) -> str:
    """The page that a URL names, as ``incremental.page_key`` has it."""
    u = f"regexp_replace(regexp_replace(lower(trim({url})), '#.*$', ''), '^([a-z][a-z0-9+.-]*:)?//', '')"
    host = f"regexp_replace(regexp_replace(regexp_extract({u}, '^([^/?]*)', 1), ':\\d*$', ''), '^((www\\d?|m|mobile|wap|amp)\\.)+', '')"
    path = f"regexp_replace(regexp_extract({u}, '^[^/?]*([^?]*)', 1), '(/+(amp|mobile|m))?/*$', '')"
    chosen = f"list_sort(list_filter(string_split_regex(regexp_extract({u}, '\\?(.*)$', 1), '[&;]'), lambda p: p <> '' AND NOT regexp_matches(p, '{incremental.PASSING}')))"
    return f"CASE WHEN {u} <> '' THEN {host} || {path} || CASE WHEN len({chosen}) > 0 THEN '?' || array_to_string({chosen}, '&') ELSE '' END END"


_P6_SQL = _SETS + f""", a AS (SELECT article_id AS id, batch_no AS n, content_hash AS c, {_key_sql("canonical_url")} AS page FROM articles JOIN ingest_batches ON collected_at >= opened_at AND collected_at < closed_at),
 u AS (SELECT discovery_id AS id, batch_no AS n, coalesce(source_id, chr(0)) AS s, {_key_sql("normalized_url")} AS page FROM discovered_urls JOIN ingest_batches ON first_discovered_at >= opened_at AND first_discovered_at < closed_at),
 fc AS (SELECT c, min(n) AS n FROM a GROUP BY c), fp AS (SELECT page, min(n) AS n FROM a GROUP BY page), fu AS (SELECT s, page, min(n) AS n FROM u GROUP BY s, page)
 SELECT 'article' AS record_kind, a.id AS record_id FROM a JOIN fc USING (c) WHERE fc.n < a.n UNION SELECT 'article', a.id FROM a JOIN fp USING (page) WHERE fp.n < a.n
 UNION SELECT 'article', y.id FROM near JOIN a x ON x.id = near.a JOIN a y ON y.id = near.b WHERE x.n < y.n UNION SELECT 'article', x.id FROM near JOIN a x ON x.id = near.a JOIN a y ON y.id = near.b WHERE y.n < x.n
 UNION SELECT 'url', u.id FROM u JOIN fu USING (s, page) WHERE fu.n < u.n"""


@query("p6_found", _P6_SQL)
def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Articles and discovered URLs that repeat something of an earlier batch."""
    return incremental.repeats(table(spark, sf, "articles"), table(spark, sf, "discovered_urls"), table(spark, sf, "ingest_batches"), **P5)


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return subjects.assign(documents, subjects.train(documents, table(spark, sf, "subject_labels"), table(spark, sf, "subject_areas")))


@query("p9_found")
def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """The subject areas of each document."""
    return _assigned(spark, sf).select("doc_id", "subject")


@query("p9_makeup")
def p9_makeup(spark: SparkSession, sf: str) -> DataFrame:
    """The number of documents of every subject by source."""
    return subjects.makeup(_assigned(spark, sf))


@query("p3_found")
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with template residue, filler, or the text of an error, block or script page."""
    return residue.find_residue(table(spark, sf, "articles")).select(F.col("id").alias("article_id"))


@query("p3_report")
def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with residue, its kinds (the sum of 1 template, 2 filler, 4 notice) and the share of the characters it covers."""
    return residue.find_residue(table(spark, sf, "articles")).withColumnRenamed("id", "article_id")
