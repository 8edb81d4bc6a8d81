"""The core's queries over the stored tables, with the SQL that says the same."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lontar.config import Health, fetch_delay
from lontar.functions import text, urls
from lontar.operators import api, audit, clustering, discovery, reports, upsert
from lontar.plans import eventsql
from lontar.plans.catalog import query
from lontar.sources.tables import table

#: Where the reports' window begins, a parameter of these queries.
SINCE = datetime(2031, 3, 10, tzinfo=timezone.utc)
SINCE_SQL = "TIMESTAMPTZ '2031-03-10 00:00:00+00'"
us = F.unix_micros


def T(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf, n) for n in names]


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of the trailing 72 hours with the seed of the event each is in."""
    return clustering.cluster(table(spark, sf, "articles"), 72)[1]


# Reports


@query("report_funnel", f"""SELECT source_id, count(*) FILTER (status='stored') AS stored, count(*) FILTER (status='duplicate') AS duplicate, count(*) FILTER (status IN ('invalid','dead_letter')) AS parse_fail,
 count(*) FILTER (status='blocked') AS blocked, count(*) FILTER (status='ignored_by_policy') AS ignored_by_policy,
 count(*) FILTER (status NOT IN ('stored','duplicate','invalid','dead_letter','blocked','ignored_by_policy')) AS in_progress_or_other, count(*) AS total
 FROM processing_status WHERE status_updated_at >= {SINCE_SQL} GROUP BY source_id""")
def report_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return reports.funnel(table(spark, sf, "processing_status"), SINCE)


_FILL = {f: f"{f} IS NOT NULL" + (f" AND len({f}) > 0" if f in ("tags", "validation_warnings") else f" AND {f} <> ''" + (f" AND {f} NOT IN ('{{}}','[]')" if f == "field_provenance" else "") if f not in ("published_at", "updated_at_source") else "") for f in reports.OPTIONAL_FIELDS}


@query("report_field_fill", f"""SELECT source_id, count(*) AS total, {', '.join(f"count(*) FILTER ({c}) AS {f}_filled" for f, c in _FILL.items())} FROM articles WHERE collected_at >= {SINCE_SQL} GROUP BY source_id""")
def report_field_fill(spark: SparkSession, sf: str) -> DataFrame:
    return reports.field_fill(table(spark, sf, "articles"), SINCE)


@query("report_only_in_sitemap", f"""WITH p AS (SELECT source_id, normalized_url, bool_or(discovery_channel ILIKE 'sitemap%') AS s, bool_or(discovery_channel NOT ILIKE 'sitemap%') AS o FROM discovered_urls WHERE last_discovered_at >= {SINCE_SQL} GROUP BY 1, 2)
 SELECT source_id, count(*) AS total_urls, count(*) FILTER (s) AS in_sitemap, count(*) FILTER (s AND NOT o) AS only_in_sitemap, count(*) FILTER (s AND o) AS in_both FROM p GROUP BY source_id""")
def report_only_in_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    return reports.only_in_sitemap(table(spark, sf, "discovered_urls"), SINCE)


@query("report_ratios", """SELECT source_id, CASE WHEN total = 0 THEN NULL ELSE round(stored / total, 6) END AS stored_share FROM (SELECT source_id, CAST(count(*) FILTER (status='stored') AS DOUBLE) AS stored, CAST(count(*) AS DOUBLE) AS total FROM processing_status GROUP BY source_id)""")
def report_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return reports.funnel(table(spark, sf, "processing_status")).select("source_id", F.round(reports.ratio(F.col("stored"), F.col("total")), 6).alias("stored_share"))


@query("report_totals", """SELECT count(*) FILTER (status='stored') AS stored, count(*) FILTER (status='duplicate') AS duplicate, count(*) FILTER (status IN ('invalid','dead_letter')) AS parse_fail FROM processing_status""")
def report_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.totals(reports.funnel(table(spark, sf, "processing_status")), "stored", "duplicate", "parse_fail")


@query("health_rules", """WITH t AS (SELECT count(*) FILTER (status IN ('stored','duplicate')) AS success, count(*) FILTER (status IN ('invalid','dead_letter')) AS parse_fail FROM processing_status),
 d AS (SELECT count(*) AS discovered FROM (SELECT DISTINCT source_id, normalized_url FROM discovered_urls))
 SELECT success, success + parse_fail AS terminal, parse_fail, discovered, concat_ws(',', CASE WHEN parse_fail > 10 THEN 'parse_fail_count' END, CASE WHEN success + parse_fail >= 5 AND parse_fail >= 0.5 * (success + parse_fail) THEN 'parse_fail_ratio' END,
 CASE WHEN success = 0 AND parse_fail > 0 THEN 'no_success' END, CASE WHEN success = 0 THEN 'nothing_stored' END, CASE WHEN discovered >= 1 AND success = 0 THEN 'discovered_without_success' END) AS failures FROM t, d""")
def health_rules(spark: SparkSession, sf: str) -> DataFrame:
    status, found = T(spark, sf, "processing_status", "discovered_urls")
    out = reports.health(reports.funnel(status), reports.only_in_sitemap(found), Health(max_parse_fail=10, require_stored=True, min_discoveries=1))
    return out.select("success", "terminal", "parse_fail", "discovered", F.array_join("failures", ",").alias("failures"))


@query("latest_collected", "SELECT epoch_us(max(collected_at)) AS latest_us FROM articles")
def latest_collected(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "articles").agg(us(F.max("collected_at")).alias("latest_us"))


@query("latest_seen", "SELECT source_id, epoch_us(max(last_discovered_at)) AS latest_us FROM discovered_urls GROUP BY source_id")
def latest_seen(spark: SparkSession, sf: str) -> DataFrame:
    return audit.latest_seen(table(spark, sf, "discovered_urls")).select("source_id", us("latest").alias("latest_us"))


@query("aggregation_scan", f"""SELECT article_id, source_id, title, coalesce(summary, '') AS summary, epoch_us(collected_at) AS collected_us FROM articles WHERE collected_at >= {SINCE_SQL} ORDER BY collected_at DESC, article_id DESC LIMIT 10000""")
def aggregation_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "articles").where(F.col("collected_at") >= F.lit(SINCE))
    return rows.orderBy(F.desc("collected_at"), F.desc("article_id")).limit(10000).select("article_id", "source_id", "title", F.coalesce("summary", F.lit("")).alias("summary"), us("collected_at").alias("collected_us"))


# Read side


@query("article_page", """SELECT a.article_id, a.source_id, s.display_name, a.title, epoch_us(coalesce(a.published_at, a.collected_at)) AS shown_us, count(*) OVER () AS total FROM articles a JOIN sources s USING (source_id)
 WHERE a.validation_status = 'valid' AND (a.title ILIKE '%soal%' OR coalesce(a.summary,'') ILIKE '%soal%') ORDER BY coalesce(a.published_at, a.collected_at) DESC, a.article_id DESC LIMIT 50 OFFSET 50""")
def article_page(spark: SparkSession, sf: str) -> DataFrame:
    a, s = T(spark, sf, "articles", "sources")
    return api.article_page(a, s, page=2, limit=50, search="soal").select("article_id", "source_id", "display_name", "title", us("shown_at").alias("shown_us"), "total")


@query("latest_run", "SELECT batch_no AS run_id, epoch_us(closed_at) AS finished_us FROM ingest_batches ORDER BY closed_at DESC NULLS LAST, batch_no DESC LIMIT 1")
def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    """The last finished run; the batches stand for runs."""
    runs = table(spark, sf, "ingest_batches").select(F.col("batch_no").alias("run_id"), F.lit("succeeded").alias("status"), F.lit(72).alias("window_hours"), F.col("closed_at").alias("finished_at"))
    return api.latest_run(runs, 72).select("run_id", us("finished_at").alias("finished_us"))


@query("report_one_source", "SELECT source_id, count(*) AS total FROM processing_status WHERE source_id = 'warta_lintang' GROUP BY source_id")
def report_one_source(spark: SparkSession, sf: str) -> DataFrame:
    """The funnel's total with the optional source predicate."""
    return reports.funnel(table(spark, sf, "processing_status"), source="warta_lintang").select("source_id", "total")


@query("report_percent", "SELECT source_id, CASE WHEN count(*) = 0 THEN 'n/a' ELSE format('{:.1f}%', floor(1000.0 * count(*) FILTER (status = 'stored') / count(*) + 0.5) / 10) END AS stored_share FROM processing_status GROUP BY source_id")
def report_percent(spark: SparkSession, sf: str) -> DataFrame:
    return reports.funnel(table(spark, sf, "processing_status")).select("source_id", reports.percent(F.col("stored"), F.col("total")).alias("stored_share"))


@query("article_dto", """SELECT article_id, source_id, external_article_id, title, content_text AS content, thumbnail_url AS featured_image, coalesce(nullif(canonical_url,''), nullif(normalized_url,'')) AS source_url FROM articles""")
def article_dto(spark: SparkSession, sf: str) -> DataFrame:
    return api.dto(table(spark, sf, "articles")).select("article_id", "source_id", "external_article_id", "title", "content", "featured_image", "source_url")


@query("article_cards", """SELECT 'crawl-' || article_id AS id, title, coalesce(nullif(canonical_url,''), nullif(normalized_url,''), '#') AS url, source_id, nullif(thumbnail_url,'') AS thumbnail, coalesce(array_to_string(tags, ','), '') AS tags FROM articles""")
def article_cards(spark: SparkSession, sf: str) -> DataFrame:
    return api.card(table(spark, sf, "articles")).select("id", "title", "url", "source_id", "thumbnail", F.array_join("tags", ",").alias("tags"))


@query("articles_with_source", "SELECT a.article_id, s.display_name, s.timezone FROM articles a JOIN sources s USING (source_id)")
def articles_with_source(spark: SparkSession, sf: str) -> DataFrame:
    a, s = T(spark, sf, "articles", "sources")
    return a.join(s.select("source_id", "display_name", "timezone"), "source_id").select("article_id", "display_name", "timezone")


# Discovery and merges


@query("seen_urls", "SELECT DISTINCT source_id, normalized_url FROM discovered_urls WHERE last_discovered_at > (SELECT max(last_discovered_at) FROM discovered_urls) - INTERVAL 24 HOUR")
def seen_urls(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "discovered_urls")
    now = d.agg(F.max("last_discovered_at")).first()[0]
    return discovery.recently_seen(d, F.lit(now), 24)


@query("enqueue_unseen", "SELECT DISTINCT d.source_id, d.normalized_url FROM discovered_urls d WHERE NOT EXISTS (SELECT 1 FROM processing_status p WHERE p.source_id = d.source_id AND p.normalized_url = d.normalized_url AND p.status IN ('stored','duplicate'))")
def enqueue_unseen(spark: SparkSession, sf: str) -> DataFrame:
    d, p = T(spark, sf, "discovered_urls", "processing_status")
    return discovery.to_enqueue(d.select("source_id", "normalized_url"), p.where(F.col("status").isin("stored", "duplicate")).select("source_id", "normalized_url"))


@query("upsert_discovered", """SELECT source_id, normalized_url, discovery_channel, CAST(count(*) AS INTEGER) AS discovery_count, epoch_us(min(first_discovered_at)) AS first_us, epoch_us(max(first_discovered_at)) AS last_us FROM discovered_urls GROUP BY 1, 2, 3""")
def upsert_discovered(spark: SparkSession, sf: str) -> DataFrame:
    """The stored sightings replayed in two batches, merged one after the other."""
    d = table(spark, sf, "discovered_urls").withColumn("seen_at", F.col("first_discovered_at"))
    first = upsert.discovered_batch(d.where(F.col("seen_at") < F.lit(SINCE)))
    merged = upsert.upsert_discovered(first, upsert.discovered_batch(d.where(F.col("seen_at") >= F.lit(SINCE))))
    return merged.select("source_id", "normalized_url", "discovery_channel", "discovery_count", us("first_discovered_at").alias("first_us"), us("last_discovered_at").alias("last_us"))


def _article_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Articles stored before the window, and versions that come in: later articles, and superseded versions at their capture."""
    a, r = T(spark, sf, "articles", "article_revisions")
    cols = ["source_id", "canonical_url", "content_hash", "title", "content_text", "parser_version", "collected_at", "first_discovered_at"]
    new = a.where(F.col("collected_at") >= F.lit(SINCE)).select(*cols)
    old = r.select("article_id", F.col("content_hash").alias("h"), F.col("title").alias("t"), F.col("content_text").alias("x"), F.col("parser_version").alias("p"), F.col("captured_at").alias("c")).join(a.select("article_id", "source_id", "canonical_url", "first_discovered_at"), "article_id")
    return a.where(F.col("collected_at") < F.lit(SINCE)).select(*cols), new.unionByName(old.select("source_id", "canonical_url", F.col("h").alias("content_hash"), F.col("t").alias("title"), F.col("x").alias("content_text"), F.col("p").alias("parser_version"), F.col("c").alias("collected_at"), "first_discovered_at"))


_VERSIONS_SQL = f"""WITH stored AS (SELECT * FROM articles WHERE collected_at < {SINCE_SQL}), incoming AS (SELECT source_id, canonical_url, content_hash, collected_at, first_discovered_at FROM articles WHERE collected_at >= {SINCE_SQL}
 UNION ALL SELECT a.source_id, a.canonical_url, r.content_hash, r.captured_at, a.first_discovered_at FROM article_revisions r JOIN articles a USING (article_id)),
 v AS (SELECT i.*, s.content_hash AS old_hash, coalesce(lag(i.content_hash) OVER (PARTITION BY i.source_id, i.canonical_url ORDER BY i.collected_at, i.content_hash), s.content_hash) AS before FROM incoming i LEFT JOIN stored s USING (source_id, canonical_url))"""


@query("upsert_article_outcomes", _VERSIONS_SQL + " SELECT source_id, canonical_url, epoch_us(collected_at) AS at_us, CASE WHEN before IS NULL OR before <> content_hash THEN 'stored' ELSE 'duplicate' END AS status, CASE WHEN before IS NULL THEN 'new_article' WHEN before <> content_hash THEN 'content_updated' ELSE 'duplicate_content' END AS reason FROM v")
def upsert_article_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert_articles(*_article_versions(spark, sf))[2].select("source_id", "canonical_url", us("collected_at").alias("at_us"), "status", "reason")


@query("upsert_articles", _VERSIONS_SQL + """, l AS (SELECT *, row_number() OVER (PARTITION BY source_id, canonical_url ORDER BY collected_at DESC, content_hash DESC) AS k FROM incoming)
 SELECT coalesce(s.source_id, l.source_id) AS source_id, coalesce(s.canonical_url, l.canonical_url) AS canonical_url, coalesce(l.content_hash, s.content_hash) AS content_hash, epoch_us(coalesce(s.first_discovered_at, l.first_discovered_at)) AS first_us FROM stored s FULL JOIN (SELECT * FROM l WHERE k = 1) l ON s.source_id = l.source_id AND s.canonical_url = l.canonical_url""")
def upsert_articles(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert_articles(*_article_versions(spark, sf))[0].select("source_id", "canonical_url", "content_hash", us("first_discovered_at").alias("first_us"))


@query("upsert_revisions", _VERSIONS_SQL + " SELECT source_id, canonical_url, content_hash, epoch_us(collected_at) AS captured_us FROM v WHERE before IS NULL OR before <> content_hash")
def upsert_revisions(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert_articles(*_article_versions(spark, sf))[1].select("source_id", "canonical_url", "content_hash", us("captured_at").alias("captured_us"))


@query("upsert_status", """WITH c AS (SELECT source_id, normalized_url, 'discovered' AS status, NULL AS reason, NULL::BIGINT AS article_id, first_discovered_at AS seen FROM discovered_urls),
 n AS (SELECT source_id, normalized_url, count(*) AS attempts, max(seen) AS last FROM c GROUP BY 1, 2)
 SELECT coalesce(p.source_id, n.source_id) AS source_id, coalesce(p.normalized_url, n.normalized_url) AS normalized_url, CASE WHEN n.last IS NOT NULL THEN 'discovered' ELSE p.status END AS status, coalesce(p.article_id, -1) AS article_id, CAST(coalesce(p.attempts,0) + coalesce(n.attempts,0) AS INTEGER) AS attempts,
 epoch_us(greatest(p.status_updated_at, n.last)) AS updated_us FROM processing_status p FULL JOIN n ON p.source_id = n.source_id AND p.normalized_url = n.normalized_url""")
def upsert_status(spark: SparkSession, sf: str) -> DataFrame:
    p, d = T(spark, sf, "processing_status", "discovered_urls")
    changes = d.select("source_id", "normalized_url", F.lit("discovered").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("long").alias("article_id"), F.col("first_discovered_at").alias("at"))
    return upsert.upsert_status(p, changes).select("source_id", "normalized_url", "status", F.coalesce("article_id", F.lit(-1)).alias("article_id"), "attempts", us("status_updated_at").alias("updated_us"))


@query("upsert_sources", "SELECT source_id, display_name || ' (baru)' AS display_name, enabled, epoch_us(created_at) AS created_us FROM sources")
def upsert_sources(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources")
    changed = s.drop("created_at", "updated_at").withColumn("display_name", F.concat("display_name", F.lit(" (baru)")))
    return upsert.upsert_sources(s, changed, F.lit(SINCE)).select("source_id", "display_name", "enabled", us("created_at").alias("created_us"))


@query("channel_union", """SELECT source_id, normalized_url, arg_min(discovery_channel, struct_pack(o := CASE discovery_channel WHEN 'indeks' THEN 0 ELSE 1 END, c := discovery_channel, r := raw_url)) AS discovery_channel FROM discovered_urls GROUP BY 1, 2""")
def channel_union(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "discovered_urls").select("source_id", "normalized_url", "discovery_channel", "raw_url")
    order = F.struct(F.when(F.col("discovery_channel") == "indeks", 0).otherwise(1).alias("o"), F.col("discovery_channel").alias("c"))
    return discovery.channel_union(d, order).select("source_id", "normalized_url", "discovery_channel")


@query("channel_union_top", """WITH u AS (SELECT source_id, normalized_url FROM discovered_urls GROUP BY 1, 2) SELECT source_id, normalized_url FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY normalized_url) AS k FROM u) WHERE k <= 20""")
def channel_union_top(spark: SparkSession, sf: str) -> DataFrame:
    """The per-source cap of a discovery run."""
    d = table(spark, sf, "discovered_urls").select("source_id", "normalized_url", "raw_url")
    return discovery.channel_union(d, F.lit(0), 20).select("source_id", "normalized_url")


_LISTED = "SELECT source_id, discovery_id, published_hint, first_discovered_at, row_number() OVER (PARTITION BY source_id, discovery_page ORDER BY first_discovered_at DESC, discovery_id) AS position, discovery_page FROM discovered_urls WHERE discovery_page IS NOT NULL"


@query("overlap_prefix", f"""WITH l AS ({_LISTED}), s AS (SELECT source_id, discovery_page, min(position) AS stop FROM l WHERE published_hint < {SINCE_SQL} GROUP BY 1, 2)
 SELECT discovery_id FROM l LEFT JOIN s USING (source_id, discovery_page) WHERE stop IS NULL OR position < stop""")
def overlap_prefix(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "discovered_urls").where("discovery_page is not null")
    w = Window.partitionBy("source_id", "discovery_page").orderBy(F.desc("first_discovered_at"), "discovery_id")
    items = d.select("source_id", "discovery_id", "discovery_page", "published_hint", F.row_number().over(w).alias("position"))
    return discovery.overlap_prefix(items, F.lit(SINCE), listing=["source_id", "discovery_page"]).select("discovery_id")


@query("due_jobs", """SELECT source_id, epoch_us(unnest(generate_series(TIMESTAMPTZ '2031-03-10 00:00:00+00', TIMESTAMPTZ '2031-03-11 00:00:00+00', to_minutes(crawl_interval_minutes)))) AS due_us FROM sources WHERE enabled""")
def due_jobs(spark: SparkSession, sf: str) -> DataFrame:
    start, end = F.lit(SINCE), F.lit(datetime(2031, 3, 11, tzinfo=timezone.utc))
    return discovery.due_jobs(table(spark, sf, "sources"), start, end).select("source_id", us("due_at").alias("due_us"))


@query("fetch_delay", """SELECT source_id, CAST(greatest(500, least(5000, round(crawl_interval_minutes * 60000 / 8))) AS INTEGER) AS delay_ms FROM sources""")
def source_delay(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sources").select("source_id", fetch_delay(F.col("crawl_interval_minutes")).alias("delay_ms"))


# Scalars


@query("content_hash", """SELECT article_id, content_hash FROM articles""")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Recomputed from title and content; the stored hash is what it must equal."""
    return table(spark, sf, "articles").select("article_id", text.content_hash(F.col("title"), F.col("content_text")).alias("content_hash"))


_NORM = r"""WITH u AS (SELECT discovery_id, normalized_url AS raw, regexp_extract(lower(normalized_url), '^(https?)://', 1) AS scheme, lower(regexp_extract(normalized_url, '^[A-Za-z]+://([^/?#]*)', 1)) AS h, regexp_extract(normalized_url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(normalized_url, '^[^?#]*\?([^#]*)', 1) AS q FROM discovered_urls WHERE regexp_matches(normalized_url, '^(?i)https?://[^/?#\s]+')),
 n AS (SELECT *, CASE WHEN scheme='https' THEN regexp_replace(h, ':443$', '') ELSE regexp_replace(h, ':80$', '') END AS host, CASE WHEN p = '' OR regexp_replace(p, '/+$', '') = '' THEN '/' ELSE regexp_replace(p, '/+$', '') END AS path,
 list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|fbclid|gclid|gclsrc|dclid|msclkid|yclid|igshid|mc_cid|mc_eid|ref|ref_src|refsrc|spm)(=|$)')) AS kept FROM u)
 SELECT discovery_id, scheme || '://' || host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END AS url FROM n"""


@query("normalize_url", _NORM)
def normalize_url(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "discovered_urls").select("discovery_id", urls.normalize_url(F.col("normalized_url")).alias("url"))
    return d.where("url is not null")


_RESOLVED = _NORM.replace("FROM discovered_urls WHERE", "FROM (SELECT d.discovery_id, CASE WHEN regexp_matches(d.raw_url, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN d.raw_url WHEN starts_with(d.raw_url, '//') THEN 'https:' || d.raw_url WHEN starts_with(d.raw_url, '/') THEN s.base_url || d.raw_url ELSE s.base_url || '/' || d.raw_url END AS normalized_url FROM discovered_urls d JOIN sources s USING (source_id)) WHERE")


@query("resolve_raw_url", _RESOLVED)
def resolve_raw_url(spark: SparkSession, sf: str) -> DataFrame:
    """Raw URLs, relative ones against their site, in one form."""
    d, s = T(spark, sf, "discovered_urls", "sources")
    return d.join(s.select("source_id", "base_url"), "source_id").select("discovery_id", urls.normalize_url(F.col("raw_url"), F.col("base_url")).alias("url"))


@query("url_category", r"""SELECT article_id, nullif(split_part(regexp_extract(canonical_url, '^[A-Za-z]+://[^/?#]*/([^?#]*)', 1), '/', 1), '') AS category FROM articles""")
def url_category(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "articles").select("article_id", urls.segment(F.col("canonical_url"), 1).alias("category"))


@query("external_id", r"""SELECT article_id, nullif(CASE WHEN regexp_matches(canonical_url, '[?&]id=\d+') THEN regexp_extract(canonical_url, '[?&]id=(\d+)', 1) ELSE regexp_extract(canonical_url, '/read/(\d+)', 1) END, '') AS external_id, regexp_matches(canonical_url, '/read/\d+/|[?&]id=\d+') AS is_article FROM articles""")
def external_id(spark: SparkSession, sf: str) -> DataFrame:
    """Article rule and external id of each source's URLs by a table of rules."""
    a, s = T(spark, sf, "articles", "sources")
    rules = s.select("source_id", F.lit(".").alias("host_pattern"), F.lit("/read/\\d+/|[?&]id=\\d+").alias("path_pattern"), F.lit(None).cast("string").alias("not_pattern"), F.lit("(?:/read/|[?&]id=)(\\d+)").alias("id_pattern"))
    return urls.apply_url_rules(a.select("article_id", "source_id", F.col("canonical_url").alias("url")), rules).select("article_id", "external_id", "is_article")


@query("url_variants", r"""SELECT article_id, regexp_replace(canonical_url, '[?#].*$', '') AS bare, CASE WHEN contains(canonical_url, '?') THEN canonical_url || '&page=all' ELSE canonical_url || '?page=all' END AS whole FROM articles WHERE NOT regexp_matches(canonical_url, '[#]|[?&]page=|[?&](&|$)|[?]$')""")
def url_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Articles' URLs without their query, and with the parameter that shows all pages."""
    a = table(spark, sf, "articles").where(~F.col("canonical_url").rlike("[#]|[?&]page=|[?&](&|$)|[?]$"))
    return a.select("article_id", urls.without_query(F.col("canonical_url")).alias("bare"), urls.with_param(F.col("canonical_url"), "page", F.lit("all")).alias("whole"))


@query("coverage_scores", "SELECT category, round(10 * count(DISTINCT source_id) + log2(count(*)), 4) AS score FROM articles GROUP BY category")
def coverage_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The coverage score of each section's articles, as of an event's."""
    g = table(spark, sf, "articles").groupBy("category").agg(F.count_distinct("source_id").alias("m"), F.count("*").alias("n"))
    return g.select("category", clustering.coverage_score(F.col("m"), F.col("n")).alias("score"))


@query("masked_connections", "SELECT source_id, 'postgres://' || source_id || ':***@' || replace(base_url, 'https://', '') AS connection FROM sources")
def masked_connections(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources")
    given = F.concat(F.lit("postgres://"), F.col("source_id"), F.lit(":geheim!1@"), F.regexp_replace("base_url", "https://", ""))
    return s.select("source_id", text.masked_connection(given).alias("connection"))


@query("query_hashes", "SELECT source_id, sha256('query feed($source: String) { feed(source: \"' || source_id || '\") }') AS hash FROM sources")
def query_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """The hash under which each source's feed query is known to a server."""
    q = F.concat(F.lit('query feed($source: String) { feed(source: "'), F.col("source_id"), F.lit('") }'))
    return table(spark, sf, "sources").select("source_id", text.query_hash(q).alias("hash"))


@query("retry_times", "SELECT status_id, CASE WHEN attempts BETWEEN 1 AND 2 THEN epoch_us(status_updated_at) + CAST(5000000 * pow(2, attempts - 1) AS BIGINT) END AS retry_us FROM processing_status WHERE status = 'retry_scheduled'")
def retry_times(spark: SparkSession, sf: str) -> DataFrame:
    """When jobs that failed are tried again."""
    p = table(spark, sf, "processing_status").where("status = 'retry_scheduled'").select("status_id", F.col("attempts").alias("attempts_made"), F.col("status_updated_at").alias("failed_at"))
    return discovery.retries(p).select("status_id", us("retry_at").alias("retry_us"))


@query("schedules", "SELECT source_id, CASE WHEN enabled AND crawl_interval_minutes > 0 THEN crawl_interval_minutes END AS every_minutes, CASE WHEN enabled AND crawl_interval_minutes > 0 THEN 'upsert' ELSE 'prune' END AS action FROM sources UNION ALL SELECT 'gone', NULL, 'prune'")
def schedules(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of the recurring schedules of all sources and of one that is no more."""
    s = table(spark, sf, "sources")
    return discovery.prune_schedules(s.select("source_id").union(spark.createDataFrame([("gone",)], "source_id string")), s)


@query("job_ids", "SELECT discovery_id, sha1(concat_ws('|', source_id, nullif(normalized_url, ''), nullif(discovery_channel, ''))) AS job_id FROM discovered_urls")
def job_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "discovered_urls").select("discovery_id", text.job_id(F.col("source_id"), F.col("normalized_url"), F.col("discovery_channel")).alias("job_id"))


@query("store_gate", "SELECT article_id, " + " AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in upsert.REQUIRED) + " AS storable, published_at IS NULL AS warned FROM articles")
def store_gate(spark: SparkSession, sf: str) -> DataFrame:
    a = upsert.with_warnings(table(spark, sf, "articles"))
    return a.select("article_id", upsert.storable().alias("storable"), F.coalesce(F.array_contains("validation_warnings", "missing_published_at"), F.lit(False)).alias("warned"))


# Clustering, stage by stage

_TOK = "list_filter(string_split(trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: len(w) >= 3 AND w NOT IN (" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + "))"
_DOCS_SQL = f"""WITH w AS (SELECT * FROM articles WHERE collected_at >= (SELECT max(collected_at) FROM articles) - INTERVAL 72 HOUR),
 d AS (SELECT article_id AS id, {_TOK.format("coalesce(title,'')")} AS t, {_TOK.format("coalesce(summary,'')")} AS s FROM w),
 tok AS (SELECT DISTINCT id, unnest(list_concat(t, s)) AS token FROM d), df AS (SELECT token, count(*) AS df FROM tok GROUP BY token)"""


@query("token_df", _DOCS_SQL + " SELECT token, df FROM df")
def token_df(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.document_frequency(clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72)))


@query("anchors", _DOCS_SQL + f" SELECT tok.id, tok.token, df.df FROM tok JOIN df USING (token) WHERE df <= greatest(40, floor((SELECT count(*) FROM d) * 0.025)) AND token NOT IN ({', '.join(repr(w) for w in text.GENERIC_ANCHORS)})")
def anchors(spark: SparkSession, sf: str) -> DataFrame:
    docs = clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72))
    return clustering.anchors(docs).where("kind = 'a'").select("id", "token", "df")


_ANCHORS_SQL = _DOCS_SQL + f""", a AS (SELECT tok.id, tok.token FROM tok JOIN df USING (token) WHERE df <= greatest(40, floor((SELECT count(*) FROM d) * 0.025)) AND token NOT IN ({', '.join(repr(w) for w in text.GENERIC_ANCHORS)})),
 m AS (SELECT article_id AS id, epoch_us(collected_at) // 1000 AS ms, CAST(article_id AS VARCHAR) AS sid FROM w)"""


@query("candidate_pairs", _ANCHORS_SQL + """ SELECT x.id AS later, y.id AS earlier, count(*) AS shared_anchors FROM a x JOIN a y ON x.token = y.token JOIN m mx ON mx.id = x.id JOIN m my ON my.id = y.id
 WHERE (my.ms < mx.ms OR (my.ms = mx.ms AND my.sid < mx.sid)) AND mx.ms - my.ms <= 36 * 3600000 GROUP BY 1, 2""")
def candidate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of articles that share an anchor within 36 hours."""
    docs = clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72))
    return clustering.candidate_pairs(docs, clustering.anchors(docs)).select("later", "earlier", "shared_anchors")


@query("weighted_jaccard", _ANCHORS_SQL + """, wt AS (SELECT token, 1.0 / log2(df + 1.0) AS w FROM df), tw AS (SELECT id, token, w FROM tok JOIN wt USING (token)), tot AS (SELECT id, sum(w) AS s FROM tw GROUP BY id),
 p AS (SELECT DISTINCT x.id AS later, y.id AS earlier FROM a x JOIN a y ON x.token = y.token JOIN m mx ON mx.id = x.id JOIN m my ON my.id = y.id WHERE (my.ms < mx.ms OR (my.ms = mx.ms AND my.sid < mx.sid)) AND mx.ms - my.ms <= 36 * 3600000),
 c AS (SELECT later, earlier, sum(x.w) AS common FROM p JOIN tw x ON x.id = later JOIN tw y ON y.id = earlier AND y.token = x.token GROUP BY 1, 2)
 SELECT later, earlier, round(common / (a1.s + a2.s - common), 6) AS wj FROM c JOIN tot a1 ON a1.id = later JOIN tot a2 ON a2.id = earlier""")
def weighted_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    docs = clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72))
    return clustering.scored_pairs(docs, clustering.anchors(docs), ratio=False).select("later", "earlier", F.round("wj", 6).alias("wj"))


@query("phrase_df", f"""WITH w AS (SELECT * FROM articles WHERE collected_at >= (SELECT max(collected_at) FROM articles) - INTERVAL 72 HOUR), d AS (SELECT article_id AS id, {_TOK.format("coalesce(title,'')")} AS t0 FROM w),
 o AS (SELECT id, list_filter(t0, lambda x, i: list_position(t0, x) = i) AS t FROM d), ph AS (SELECT DISTINCT id, unnest(list_transform(list_zip(t[:-2], t[2:]), lambda z: z[1] || ' ' || z[2])) AS token FROM o WHERE len(t) >= 2)
 SELECT token, count(*) AS df FROM ph GROUP BY token""")
def phrase_df(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.document_frequency(clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72)), "phrases")


_BY_WORDS = _ANCHORS_SQL.replace("WITH w AS", "WITH w AS", 1) + f""", o AS (SELECT article_id AS id, {_TOK.format("coalesce(title,'')")} AS t0 FROM w), u AS (SELECT id, list_filter(t0, lambda x, i: list_position(t0, x) = i) AS t FROM o),
 ph AS (SELECT DISTINCT id, unnest(list_transform(list_zip(t[:-2], t[2:]), lambda z: z[1] || ' ' || z[2])) AS token FROM u WHERE len(t) >= 2), pf AS (SELECT token FROM ph GROUP BY token HAVING count(*) <= 12),
 pa AS (SELECT id, token FROM ph JOIN pf USING (token) WHERE len(list_filter(string_split(token, ' '), lambda x: x IN ({', '.join(repr(w) for w in text.GENERIC_ANCHORS)}))) = 0),
 wt AS (SELECT token, 1.0 / log2(df + 1.0) AS w FROM df), tw AS (SELECT id, token, w FROM tok JOIN wt USING (token)), tot AS (SELECT id, sum(w) AS s FROM tw GROUP BY id),
 p AS (SELECT x.id AS later, y.id AS earlier, count(*) AS shared_anchors FROM a x JOIN a y ON x.token = y.token JOIN m mx ON mx.id = x.id JOIN m my ON my.id = y.id WHERE (my.ms < mx.ms OR (my.ms = mx.ms AND my.sid < mx.sid)) AND mx.ms - my.ms <= 36 * 3600000 GROUP BY 1, 2),
 sp AS (SELECT x.id AS later, y.id AS earlier, count(*) AS shared_phrases FROM pa x JOIN pa y ON x.token = y.token AND x.id <> y.id GROUP BY 1, 2),
 c AS (SELECT later, earlier, sum(x.w) AS common FROM p JOIN tw x ON x.id = later JOIN tw y ON y.id = earlier AND y.token = x.token GROUP BY 1, 2),
 j AS (SELECT p.later, p.earlier, shared_anchors, coalesce(shared_phrases, 0) AS shared_phrases, common / (t1.s + t2.s - common) AS wj FROM p JOIN c ON c.later = p.later AND c.earlier = p.earlier LEFT JOIN sp ON sp.later = p.later AND sp.earlier = p.earlier JOIN tot t1 ON t1.id = p.later JOIN tot t2 ON t2.id = p.earlier)
 SELECT later, earlier, shared_anchors, shared_phrases, round(wj, 6) AS wj FROM j WHERE (shared_anchors >= 2 AND round(wj, 12) >= 0.35) OR (shared_phrases >= 1 AND round(wj, 12) >= 0.22)"""


@query("event_pairs_by_words", _BY_WORDS)
def event_pairs_by_words(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of the trailing 72 hours that are accepted by their words and phrases alone."""
    docs = clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72))
    return clustering.scored_pairs(docs, clustering.anchors(docs), ratio=False).where("by_words").select("later", "earlier", "shared_anchors", "shared_phrases", F.round("wj", 6).alias("wj"))


@query("event_pairs", eventsql.pairs(72) + " SELECT later, earlier, a AS shared_anchors, p AS shared_phrases, round(wj, 6) AS wj, accepted, round(score, 6) AS score FROM pairs")
def event_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Scored candidate pairs of the trailing 72 hours."""
    docs = clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72))
    return clustering.scored_pairs(docs, clustering.anchors(docs)).select("later", "earlier", "shared_anchors", "shared_phrases", F.round("wj", 6).alias("wj"), "accepted", F.round("score", 6).alias("score"))


@query("lcs_ratio", eventsql.pairs(72) + " SELECT later, earlier, round(lcs, 6) AS lcs FROM pairs WHERE lcs IS NOT NULL")
def lcs_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """The subsequence ratio of the pairs that it matters for."""
    docs = clustering.prepared(clustering.windowed(table(spark, sf, "articles"), 72))
    return clustering.scored_pairs(docs, clustering.anchors(docs)).where("by_words or shared_anchors >= 3").select("later", "earlier", F.round("lcs", 6).alias("lcs"))


@query("event_assign", eventsql.assigned(168) + " SELECT id, seed, round(score, 6) AS score FROM assigned")
def event_assign(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.cluster(table(spark, sf, "articles"), 168)[1].select("id", "seed", F.round("score", 6).alias("score"))


@query("event_rollup", eventsql.events(24) + " SELECT seed, article_count, media_count, first_ms, last_ms, representative_title, anchor_terms, coverage_score FROM events")
def event_rollup(spark: SparkSession, sf: str) -> DataFrame:
    found = clustering.cluster(table(spark, sf, "articles"), 24)[0]
    return found.select("seed", "article_count", "media_count", F.unix_millis("first_seen_at").alias("first_ms"), F.unix_millis("last_seen_at").alias("last_ms"), "representative_title", F.array_join(F.coalesce("anchor_terms", F.array().cast("array<string>")), " ").alias("anchor_terms"), "coverage_score")


@query("event_metrics", eventsql.events(72) + " SELECT (SELECT count(*) FROM docs) AS article_count, (SELECT count(*) FROM pairs WHERE earlier IN (SELECT id FROM seeds)) AS candidate_count, (SELECT count(*) FROM assigned WHERE id <> seed) AS accepted_edges, (SELECT count(*) FROM events) AS event_count")
def event_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.cluster(table(spark, sf, "articles"), 72)[2]


@query("event_issues", eventsql.events(72) + """, top AS (SELECT *, row_number() OVER (ORDER BY media_count DESC, article_count DESC, seed) AS position FROM events)
 SELECT 'event-' || t.seed AS id, CAST(position AS INTEGER) AS position, format('{} articles by {} media', t.article_count, t.media_count) AS summary, t.representative_title, string_agg(x.article_id || ':' || s.display_name, ' ' ORDER BY coalesce(x.published_at, x.collected_at) DESC, x.article_id DESC) AS articles
 FROM top t JOIN assigned a ON a.seed = t.seed JOIN articles x ON x.article_id = a.id JOIN sources s ON s.source_id = x.source_id WHERE position <= 50 GROUP BY ALL""")
def event_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a run as the read side lists them, articles nested."""
    a, s = T(spark, sf, "articles", "sources")
    found, assigned, _ = clustering.cluster(a, 72)
    run = spark.range(1).select(F.lit(1).alias("run_id"))
    events = found.select(F.lit(1).alias("run_id"), F.col("seed").alias("event_id"), "representative_title", "media_count", "article_count", "coverage_score")
    members = assigned.select(F.lit(1).alias("run_id"), F.col("seed").alias("event_id"), F.col("id").alias("article_id"), F.col("score").alias("match_score"))
    named = F.transform("articles", lambda x: F.concat_ws(":", x["article_id"].cast("string"), x["display_name"]))
    return api.issues(run, events, members, a, s).select("id", "position", "summary", "representative_title", F.array_join(named, " ").alias("articles"))


# Audit


_WATCHED = "status IN ('stored','duplicate','ignored_by_policy')"


@query("audit_unprocessed", f"""WITH n AS (SELECT max(first_discovered_at) AS t FROM discovered_urls) SELECT d.discovery_id FROM discovered_urls d, n WHERE d.first_discovered_at >= n.t - INTERVAL 72 HOUR
 AND NOT EXISTS (SELECT 1 FROM processing_status p WHERE p.source_id = d.source_id AND p.normalized_url = d.normalized_url AND {_WATCHED})""")
def audit_unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    """URLs of the last 72 hours that have come to no good end; every stored URL has a status row, so only final ones count here."""
    d, p = T(spark, sf, "discovered_urls", "processing_status")
    now = d.agg(F.max("first_discovered_at")).first()[0]
    return audit.unprocessed(d, p.where(_WATCHED), F.lit(now)).select("discovery_id")


@query("channel_sets", "SELECT source_id, channels, count(*) AS urls FROM (SELECT source_id, normalized_url, array_to_string(list_sort(list(DISTINCT discovery_channel)), '+') AS channels FROM discovered_urls GROUP BY 1, 2) GROUP BY 1, 2")
def channel_sets(spark: SparkSession, sf: str) -> DataFrame:
    return audit.channel_sets(table(spark, sf, "discovered_urls"))


@query("coverage_proxy", """WITH u AS (SELECT DISTINCT source_id, normalized_url FROM discovered_urls), s AS (SELECT DISTINCT source_id, normalized_url FROM processing_status WHERE status = 'stored')
 SELECT u.source_id, count(*) AS union_urls, count(s.normalized_url) AS stored_urls, round(CAST(count(s.normalized_url) AS DOUBLE) / count(*), 6) AS coverage FROM u LEFT JOIN s ON u.source_id = s.source_id AND u.normalized_url = s.normalized_url GROUP BY u.source_id""")
def coverage_proxy(spark: SparkSession, sf: str) -> DataFrame:
    return audit.coverage_proxy(*T(spark, sf, "discovered_urls", "processing_status"))


_LINE = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"


@query("validation_issues", f"""WITH v AS (SELECT a.article_id, {_LINE.format("a.title")} AS t, {_LINE.format("a.content_text")} AS c, len(list_filter(string_split(coalesce(a.content_text, ''), chr(10)), lambda x: trim(x) <> '')) AS ps, lower({_LINE.format("s.display_name")}) AS site, a.published_at AS p, a.updated_at_source AS u, a.collected_at AS seen
 FROM articles a LEFT JOIN sources s USING (source_id))
 SELECT article_id, concat_ws(',', CASE WHEN t = '' THEN 'title_missing' WHEN lower(t) IN ('home', '404', 'access denied') OR lower(t) = site THEN 'title_forbidden' WHEN len(t) < 10 THEN 'title_short' WHEN len(t) > 500 THEN 'title_long' END,
 CASE WHEN c = '' THEN 'content_missing' WHEN len(c) < 200 THEN 'content_short' END, CASE WHEN c <> '' AND ps < 2 THEN 'few_paragraphs' END, CASE WHEN p IS NULL THEN 'date_missing' WHEN p > seen THEN 'date_in_future' END, CASE WHEN u < p THEN 'updated_before_published' END) AS issues FROM v""")
def validation_issues(spark: SparkSession, sf: str) -> DataFrame:
    a, s = T(spark, sf, "articles", "sources")
    return audit.validation_issues(a, s).select("article_id", F.array_join("issues", ",").alias("issues"))


@query("confidence_score", """WITH p AS (SELECT article_id, (CASE WHEN trim(title) <> '' THEN 20 ELSE 0 END) + (CASE WHEN length(content_text) > 500 THEN 25 ELSE 0 END) + (CASE WHEN regexp_matches(canonical_url, '^https?://[^/?#\\s]+', 'i') THEN 15 ELSE 0 END)
 + (CASE WHEN published_at <= collected_at THEN 20 ELSE 0 END) + (CASE WHEN contains(field_provenance, 'json_ld') THEN 10 ELSE 0 END) + (CASE WHEN trim(author_name) <> '' THEN 5 ELSE 0 END) + (CASE WHEN trim(category) <> '' THEN 5 ELSE 0 END) AS score FROM articles)
 SELECT article_id, CAST(score AS INTEGER) AS score, CASE WHEN score BETWEEN 80 AND 100 THEN 'valid' WHEN score BETWEEN 60 AND 79 THEN 'valid_with_warning' WHEN score BETWEEN 40 AND 59 THEN 'manual_review' ELSE 'invalid' END AS band FROM p""")
def confidence_score(spark: SparkSession, sf: str) -> DataFrame:
    return audit.confidence(table(spark, sf, "articles"))


@query("duplicate_hashes", "SELECT count(*) AS keys, CAST(sum(n) AS BIGINT) AS articles FROM (SELECT count(*) AS n FROM articles GROUP BY content_hash HAVING count(*) > 1)")
def duplicate_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicate_keys(table(spark, sf, "articles")).where("level = '5_content_hash'").select("keys", "articles")


_LEVELS = {"1_normalized_url": "normalized_url", "2_canonical_url": "canonical_url", "3_external_id": "CASE WHEN external_article_id <> '' THEN source_id || '|' || external_article_id END", "4_final_url": "final_url", "5_content_hash": "content_hash"}


@query("duplicate_keys", "SELECT level, count(*) AS keys, CAST(sum(n) AS BIGINT) AS articles FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS level, count(*) AS n FROM articles WHERE ({v}) <> '' GROUP BY {v} HAVING count(*) > 1" for k, v in _LEVELS.items()) + ") GROUP BY level")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicate_keys(table(spark, sf, "articles"))


@query("url_aliases", """WITH f AS (SELECT source_id, external_article_id, canonical_url, first_value(canonical_url) OVER (PARTITION BY source_id, external_article_id ORDER BY collected_at, article_id) AS alias_of FROM articles WHERE external_article_id IS NOT NULL)
 SELECT DISTINCT source_id, external_article_id, canonical_url, alias_of FROM f WHERE canonical_url <> alias_of""")
def url_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return audit.url_aliases(table(spark, sf, "articles"))


@query("hourly_baseline", """WITH h AS (SELECT source_id, epoch(date_trunc('hour', collected_at AT TIME ZONE 'UTC'))::BIGINT AS s, count(*) AS n FROM articles GROUP BY 1, 2)
 SELECT x.source_id, x.s AS at_s, x.n, CAST(count(y.n) AS INTEGER) AS weeks, CAST(median(y.n) AS DOUBLE) AS median, x.n < median(y.n) * 0.5 AS low FROM h x LEFT JOIN h y ON y.source_id = x.source_id AND x.s - y.s IN (604800, 2 * 604800, 3 * 604800, 4 * 604800) GROUP BY x.source_id, x.s, x.n""")
def hourly_baseline(spark: SparkSession, sf: str) -> DataFrame:
    out = audit.hourly_baseline(table(spark, sf, "articles"))
    return out.select("source_id", F.unix_timestamp("at").alias("at_s"), "n", "weeks", "median", "low")


@query("circuit_states", """WITH n AS (SELECT max(status_updated_at) AS t FROM processing_status), a AS (SELECT source_id, status_updated_at AS tm, status IN ('stored','duplicate') AS fine FROM processing_status WHERE status IN ('stored','duplicate','invalid','dead_letter','blocked')),
 g AS (SELECT source_id, count(*) AS attempts, max(tm) FILTER (fine) AS good, max(tm) FILTER (NOT fine) AS bad FROM a GROUP BY source_id),
 r AS (SELECT a.source_id, count(*) FILTER (NOT fine AND (good IS NULL OR tm >= good)) AS failures_in_row, count(*) FILTER (NOT fine AND tm > bad - INTERVAL 10 MINUTE AND tm <= bad) AS f, count(*) FILTER (tm > bad - INTERVAL 10 MINUTE AND tm <= bad) AS m FROM a JOIN g USING (source_id) GROUP BY a.source_id),
 c AS (SELECT g.source_id, attempts, failures_in_row, CASE WHEN m > 0 THEN round(f::DOUBLE / m, 6) END AS error_rate, bad FROM g JOIN r USING (source_id)),
 s AS (SELECT *, CASE WHEN NOT coalesce(failures_in_row >= 20 OR (failures_in_row > 0 AND error_rate >= 0.7), false) THEN 'closed' WHEN bad <= n.t - INTERVAL 15 MINUTE THEN 'half_open' ELSE 'open' END AS state FROM c, n)
 SELECT source_id, attempts, failures_in_row, error_rate, state, CASE state WHEN 'half_open' THEN 3 WHEN 'open' THEN 0 END AS probes FROM s""")
def circuit_states(spark: SparkSession, sf: str) -> DataFrame:
    """Circuit breaker state of each source from its processing outcomes, at the last of them."""
    s = table(spark, sf, "processing_status").where(F.col("status").isin("stored", "duplicate", "invalid", "dead_letter", "blocked"))
    now = table(spark, sf, "processing_status").agg(F.max("status_updated_at")).first()[0]
    return audit.circuit_states(s.select("source_id", F.col("status_updated_at").alias("at"), "status"), F.col("status").isin("stored", "duplicate"), F.lit(now))
