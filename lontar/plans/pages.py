"""Queries over pages and listings. The stored tables hold no pages, so pages are written from the articles and read back."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lontar.functions import dates, html as H, text
from lontar.functions.urls import with_param
from lontar.operators import discovery, pipeline
from lontar.plans.catalog import query
from lontar.plans.core import SINCE, SINCE_SQL, us
from lontar.session import shared_dir
from lontar.sources import feeds, sites
from lontar.sources.tables import table


def _escape(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


#: What the servers said, by the article's last digit.
STATUSES = (200, 200, 200, 200, 200, 200, 404, 503, 403, 429)


def article_pages(articles: DataFrame) -> DataFrame:
    """A page for every article: metadata as JSON-LD, a heading, paragraphs, and furniture around them; statuses of all kinds."""
    ld = F.to_json(F.struct(F.lit("NewsArticle").alias("@type"), F.struct(F.col("author_name").alias("name")).alias("author"), F.col("category").alias("articleSection"), dates.iso(F.col("published_at")).alias("datePublished")))
    body = F.array_join(F.transform(F.split("content_text", "\n"), lambda x: F.concat(F.lit("<p>"), _escape(x), F.lit("</p>"))), "\n")
    page = F.concat(
        F.lit("<!doctype html><html><head><title>x</title><link rel=canonical href=\""), _escape(F.col("canonical_url")), F.lit('"><script type="application/ld+json">'), F.replace(ld, F.lit("</"), F.lit("<\\/")),
        F.lit("</script></head><body><nav><p>Menu</p></nav><h1>"), _escape(F.col("title")), F.lit("</h1><article>"), body, F.lit('<div class="ads"><p>Iklan</p></div></article><footer><p>Kaki</p></footer></body></html>'),
    )
    status = F.element_at(F.array(*[F.lit(x) for x in STATUSES]), (F.col("article_id") % 10 + 1).cast("int"))
    return articles.select(F.col("article_id").alias("page_id"), "source_id", "requested_url", "final_url", status.alias("http_status"), page.alias("body"), F.col("collected_at").alias("fetched_at"))


_LINE = r"trim(regexp_replace({0}, '[\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"
_PARSE_SQL = rf"""WITH l AS (SELECT article_id, list_filter(list_transform(string_split(content_text, chr(10)), lambda x: {_LINE.format("x")}), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^\s*(baca juga|pilihan editor|cek berita dan artikel|ringkasan berita|simak (juga|video)|lihat juga)\b')) AS ps, title, author_name, category, published_at FROM articles)
 SELECT article_id AS page_id, {_LINE.format("title")} AS title, nullif(trim(author_name), '') AS author_name, array_to_string(ps, chr(10) || chr(10)) AS content_text, coalesce(epoch_us(published_at) // 1000, -1) AS published_ms FROM l WHERE len(ps) > 0"""


@query("page_parse", _PARSE_SQL)
def page_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Fields read back from every article's page."""
    parsed = pipeline.parse_pages(article_pages(table(spark, sf, "articles")))
    return parsed.where("content_text is not null").select("page_id", "title", text.presence(F.trim("author_name")).alias("author_name"), "content_text", F.coalesce(F.unix_millis(dates.any_date(F.col("published"))), F.lit(-1)).alias("published_ms"))


_OUTCOMES = rf"""WITH p AS (SELECT article_id AS page_id, source_id, requested_url AS u, [{", ".join(map(str, STATUSES))}][article_id % 10 + 1] AS code, {_LINE.format("title")} AS t,
 len(list_filter(list_transform(string_split(content_text, chr(10)), lambda x: {_LINE.format("x")}), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^\s*(baca juga|pilihan editor|cek berita dan artikel|ringkasan berita|simak (juga|video)|lihat juga)\b'))) AS n FROM articles),
 j AS (SELECT *, regexp_extract(u, '^[A-Za-z]+://[^/?#]*([^#]*)', 1) AS path, regexp_matches(u, '^\s*(?i)https?://[^/?#\s]+') AS http FROM p),
 r AS (SELECT *, regexp_matches(path, '/read/\d+/|[?&]id=\d+') AND NOT regexp_matches(path, '/(tag|indeks)/') AS article FROM j),
 o AS (SELECT *, CASE WHEN NOT http THEN 'invalid:url_normalization_failed' WHEN NOT article THEN 'ignored_by_policy:not_article_url' WHEN code IN (429, 503) THEN 'retry_scheduled:http_status_' || code WHEN code = 403 THEN 'blocked:http_status_403' WHEN code = 404 THEN 'dead_letter:http_status_404'
 WHEN t = '' AND n = 0 THEN 'invalid:parse_returned_empty' WHEN t = '' OR n = 0 THEN 'dead_letter:store_failed' ELSE 'parsed:storable' END AS said FROM r)
 SELECT page_id, source_id, split_part(said, ':', 1) AS status, split_part(said, ':', 2) AS reason, nullif(regexp_extract(path, '(?:/read/|[?&]id=)(\d+)', 1), '') AS external_id FROM o"""


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    a, s = table(spark, sf, "articles"), table(spark, sf, "sources")
    rules = s.select("source_id", F.lit(".").alias("host_pattern"), F.lit("/read/\\d+/|[?&]id=\\d+").alias("path_pattern"), F.lit("/(tag|indeks)/").alias("not_pattern"), F.lit("(?:/read/|[?&]id=)(\\d+)").alias("id_pattern"))
    return pipeline.run_pipeline(article_pages(a), rules)


@query("pipeline_outcomes", _OUTCOMES)
def pipeline_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Every page with its one outcome."""
    return _outcomes(spark, sf).select("page_id", "source_id", "status", "reason", "external_id")


@query("pipeline_store", f"""{_OUTCOMES.rsplit(" SELECT page_id", 1)[0]}, a AS (SELECT o.*, x.content_hash, x.canonical_url, x.collected_at FROM o JOIN articles x ON x.article_id = o.page_id)
 SELECT CASE WHEN said = 'parsed:storable' THEN 'stored' ELSE split_part(said, ':', 1) END AS status, count(*) AS pages FROM a GROUP BY 1""")
def pipeline_store(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by the status they end with when an empty store takes them: every (source, page) is new there."""
    a, p = table(spark, sf, "articles"), table(spark, sf, "processing_status")
    made = _outcomes(spark, sf).withColumn("canonical_url", F.col("requested_url")).withColumn("normalized_url", F.concat_ws("#", "normalized_url", F.col("page_id").cast("string"))).withColumn("requested_url", F.concat_ws("#", "requested_url", F.col("page_id").cast("string")))
    made = made.withColumn("canonical_url", F.concat_ws("#", "canonical_url", F.col("page_id").cast("string")))
    _, _, status = pipeline.store(made, a.limit(0), p.limit(0))
    return status.groupBy("status").agg(F.count("*").alias("pages"))


#: An address of an article on each known site, by an id of digits and one of letters and digits.
ADDRESSES = {
    "detik": "https://news.detik.com/berita/d-{n}/judul", "suara": "https://www.suara.com/news/2031/03/05/{six}/judul", "viva": "https://www.viva.co.id/berita/{n}-judul", "cnn_indonesia": "https://www.cnnindonesia.com/nasional/20310305101010-12-{n}/judul",
    "liputan6": "https://www.liputan6.com/news/read/{n}/judul", "tirto": "https://tirto.id/judul-baru-{four}", "tempo": "https://www.tempo.co/politik/judul-baru-{n}", "kumparan": "https://kumparan.com/akun/judul-20{nine}", "jawa_pos": "https://www.jawapos.com/politik/{ten}/judul",
    "okezone": "https://news.okezone.com/read/2031/03/05/337/{n}/judul", "sindonews": "https://nasional.sindonews.com/read/{n}/12/judul", "idn_times": "https://www.idntimes.com/news/indonesia/judul-00-{five}-{six}", "republika": "https://news.republika.co.id/berita/{nine}/judul",
    "media_indonesia": "https://mediaindonesia.com/politik/{n}/judul", "merdeka": "https://www.merdeka.com/peristiwa/read/{n}/judul", "beritasatu": "https://www.beritasatu.com/nasional/{n}/judul", "tribunnews": "https://www.tribunnews.com/nasional/{ten}/judul",
}
_WIDTHS = {"four": 4, "five": 5, "six": 6, "nine": 9, "ten": 10}


def _element(selector: str, inner: Column) -> Column:
    """``inner`` within elements that the first alternative of a selector finds."""
    before, after = "", ""
    for _, tests in H._compiled(selector)[0]:
        tag = next((t[1] for t in tests if t[0] == "t"), "div")
        marks = [f'class="{" ".join(t[1] for t in tests if t[0] == ".")}"'] + [f'id="{t[1]}"' for t in tests if t[0] == "#"] + [f'{t[1]}="{t[3] or "x"}"' for t in tests if t[0] == "a"]
        before, after = f"{before}<{tag} {' '.join(marks)}>", f"</{tag}>{after}"
    return F.concat(F.lit(before), inner, F.lit(after))


def _site_pages(articles: DataFrame) -> DataFrame:
    """Each article as a page of one of the known sites, in its markup: a foreign heading and text stand first, then title, author, a
    dateline and paragraphs where the site has them; a sixth of the addresses are listings."""
    order = list(ADDRESSES)
    at = (F.col("article_id") % len(order) + 1).cast("int")
    number = (F.col("article_id") + 100_000).cast("string")
    urls, pages = [], []
    for site in order:
        parts = [F.lit(x) if i % 2 == 0 else (number if x == "n" else F.lpad(F.col("article_id").cast("string"), _WIDTHS[x], "0")) for i, x in enumerate(re.split(r"\{(\w+)\}", ADDRESSES[site]))]
        urls.append(F.concat(*parts))
        sel = sites.selectors()[site]
        text_of = F.array_join(F.transform(F.split("content_text", "\n"), lambda x: F.concat(F.lit("<p>"), _escape(x), F.lit("</p>"))), "")
        body = _element(sel["body"], F.concat(F.lit("<strong>Kota Uji</strong>"), text_of, F.lit('<aside><p>Iklan</p></aside>')))
        decoy = F.lit("" if sel["title"] == "h1" else "<h1>Bukan judul</h1>")
        pages.append(F.concat(F.lit("<html><body><main><p>Bukan isi</p></main>"), decoy, _element(sel["title"], _escape(F.col("title"))), _element(sel["author"], _escape(F.coalesce("author_name", F.lit("")))), body, F.lit("</body></html>")))
    listing = F.regexp_replace(F.element_at(F.array(*urls), at), "^(https://[^/]+/).*$", "$1tag/")
    url = F.when(F.col("article_id") % 6 == 5, listing).otherwise(F.element_at(F.array(*urls), at))
    body = F.lit(None).cast("string")
    for i, page in enumerate(pages):
        body = F.when(at == i + 1, page).otherwise(body)
    return articles.select(F.col("article_id").alias("page_id"), F.element_at(F.array(*[F.lit(x) for x in order]), at).alias("source_id"), url.alias("requested_url"), url.alias("final_url"), F.lit(200).alias("http_status"), body.alias("body"), F.col("collected_at").alias("fetched_at"))


_IDS_SQL = " ".join(f"WHEN {i} THEN " + ("lpad(CAST(article_id AS VARCHAR), 5, '0') || '-' || lpad(CAST(article_id AS VARCHAR), 6, '0')" if k == "idn_times" else "'20' || lpad(CAST(article_id AS VARCHAR), 9, '0')" if k == "kumparan" else f"lpad(CAST(article_id AS VARCHAR), {_WIDTHS[m]}, '0')" if (m := re.search(r"\{(\w+)\}", v)[1]) != "n" else "CAST(article_id + 100000 AS VARCHAR)") for i, (k, v) in enumerate(ADDRESSES.items()))


@query("site_pages", rf"""WITH l AS (SELECT article_id, list_filter(list_transform(string_split(content_text, chr(10)), lambda x: {_LINE.format("x")}), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^\s*(baca juga|pilihan editor|cek berita dan artikel|ringkasan berita|simak (juga|video)|lihat juga)\b')) AS ps, {_LINE.format("title")} AS title, split_part(trim({_LINE.format("coalesce(author_name, '')")}), ' - ', 1) AS who FROM articles)
 SELECT article_id AS page_id, CASE WHEN article_id % 6 = 5 THEN 'ignored_by_policy' ELSE 'parsed' END AS status, CASE WHEN article_id % 6 <> 5 THEN title END AS title, CASE WHEN article_id % 6 <> 5 THEN nullif(trim(who), '') END AS author_name,
 CASE WHEN article_id % 6 <> 5 THEN CASE WHEN starts_with(lower(ps[1]), 'kota uji') THEN '' ELSE 'Kota Uji - ' END || array_to_string(ps, chr(10) || chr(10)) END AS content_text, CASE WHEN article_id % 6 <> 5 THEN CASE article_id % 17 {_IDS_SQL} END END AS external_id FROM l WHERE len(ps) > 0 AND title <> ''""")
def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every article as a page of one of the seventeen known sites, through the pipeline with the sites' own rules and selectors."""
    out = pipeline.run_pipeline(_site_pages(table(spark, sf, "articles")), sites.site_rules(spark))
    kept = out.where("status in ('parsed', 'ignored_by_policy')")
    empty = table(spark, sf, "articles").where(~F.exists(F.split("content_text", "\n"), lambda x: F.trim(text.collapse_space(x)) != "")).select(F.col("article_id").alias("page_id"))
    return kept.join(empty, "page_id", "left_anti").select("page_id", "status", "title", text.presence(F.trim("author_name")).alias("author_name"), "content_text", F.when(F.col("status") == "parsed", F.col("external_id")).alias("external_id"))


@query("fetch_classify", """SELECT s AS http_status, CASE WHEN s BETWEEN 200 AND 299 THEN 'fetched' WHEN s IN (408,425,429,500,502,503,504) THEN 'retry_scheduled' WHEN s IN (401,403) THEN 'blocked' ELSE 'dead_letter' END AS outcome FROM (SELECT CAST(unnest(generate_series(100, 599)) AS BIGINT) AS s)""")
def fetch_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Every status code with what it means."""
    return spark.range(100, 600).select(F.col("id").alias("http_status"), pipeline.fetch_outcome(F.col("id")).alias("outcome"))


@query("listing_dates", "SELECT article_id, epoch(date_trunc('minute', published_at))::BIGINT AS minute_s FROM articles WHERE published_at IS NOT NULL")
def listing_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Publication times written as listings do, in local time and Indonesian, and read back."""
    names = F.array(*[F.lit(m) for m in ("Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember")])
    local = F.from_utc_timestamp("published_at", "Asia/Jakarta")
    shown = F.format_string("Jum'at, %s %s %s | %s WIB", F.dayofmonth(local), F.element_at(names, F.month(local)), F.year(local), F.date_format(local, "HH.mm"))
    a = table(spark, sf, "articles").where("published_at is not null")
    return a.select("article_id", F.unix_timestamp(dates.listing_date(shown)).alias("minute_s"))


def _gathered(rows: DataFrame, item: Column, head: str, tail: str, size: int = 512) -> DataFrame:
    """(source_id, body): documents of many items each, by source, day and a hash."""
    by = rows.withColumn("_i", item).groupBy("source_id", F.pmod(F.xxhash64("discovery_id"), F.lit(size)).alias("_k"), F.to_date("first_discovered_at").alias("_d"))
    return by.agg(F.concat(F.lit(head), F.array_join(F.collect_list("_i"), ""), F.lit(tail)).alias("body")).select("source_id", "body")


@query("sitemap_items", "SELECT source_id, normalized_url AS url, nullif(trim(listing_title), '') AS title_hint, coalesce(epoch_us(published_hint) // 1000, -1) AS hint_ms, count(*) AS n FROM discovered_urls WHERE discovery_channel ILIKE 'sitemap%' GROUP BY ALL")
def sitemap_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sitemap sightings written as sitemaps of many entries, with titles, dates and keywords, and read back."""
    d = table(spark, sf, "discovered_urls").where(F.col("discovery_channel").ilike("sitemap%"))
    date = F.coalesce(F.concat(F.lit("<news:publication_date>"), dates.iso(F.col("published_hint")), F.lit("</news:publication_date>")), F.lit(""))
    xml = F.concat(F.lit("<url><loc>"), _escape(F.col("normalized_url")), F.lit("</loc><news:news>"), date, F.lit("<news:title><![CDATA["), F.coalesce("listing_title", F.lit("")), F.lit("]]></news:title><news:keywords><![CDATA[[\"a\",\"b\"]]]></news:keywords></news:news></url>"))
    items = feeds.sitemap_items(_gathered(d, xml, "<urlset>", "</urlset>"))
    return items.groupBy("source_id", "url", "title_hint", F.coalesce(F.unix_millis(dates.any_date(F.col("published_hint"))), F.lit(-1)).alias("hint_ms")).agg(F.count("*").alias("n"))


@query("rss_items", "SELECT source_id, normalized_url AS url, nullif(trim(listing_title), '') AS title_hint, discovery_channel AS section, coalesce(epoch_us(published_hint) // 1000, -1) AS hint_ms, count(*) AS n FROM discovered_urls WHERE discovery_channel NOT ILIKE 'sitemap%' GROUP BY ALL")
def rss_items(spark: SparkSession, sf: str) -> DataFrame:
    """Other sightings written as feeds of many items, with titles, dates and a category, and read back."""
    d = table(spark, sf, "discovered_urls").where(~F.col("discovery_channel").ilike("sitemap%"))
    date = F.coalesce(F.concat(F.lit("<pubDate>"), dates.iso(F.col("published_hint")), F.lit("</pubDate>")), F.lit(""))
    xml = F.concat(F.lit("<item><title>"), _escape(F.coalesce("listing_title", F.lit(""))), F.lit("</title><link>"), _escape(F.col("normalized_url")), F.lit("</link>"), date, F.lit("<category>"), _escape(F.col("discovery_channel")), F.lit("</category></item>"))
    items = feeds.rss_items(_gathered(d, xml, "<rss><channel>", "</channel></rss>"))
    return items.groupBy("source_id", "url", "title_hint", F.element_at("keywords", 1).alias("section"), F.coalesce(F.unix_millis(dates.any_date(F.col("published_hint"))), F.lit(-1)).alias("hint_ms")).agg(F.count("*").alias("n"))


@query("html_listing", r"""SELECT DISTINCT source_id, normalized_url AS url, nullif(trim(regexp_replace(coalesce(listing_title, ''), '\s+', ' ', 'g')), '') AS title_hint, coalesce(epoch_us(published_hint) // 1000, -1) AS hint_ms FROM discovered_urls""")
def html_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Index pages of many links, each with its title and its date in a comment beside a relative label, written and read back."""
    d = table(spark, sf, "discovered_urls")
    date = F.coalesce(F.concat(F.lit('<span class="date"><!-- '), dates.iso(F.col("published_hint")), F.lit(" -->baru saja</span>")), F.lit(""))
    item = F.concat(F.lit('<li><a href="'), _escape(F.col("normalized_url")), F.lit('">'), _escape(F.coalesce("listing_title", F.lit(""))), F.lit("</a>"), date, F.lit("</li>"))
    # a page names an address once, so sightings of one address go to different pages
    nth = F.row_number().over(Window.partitionBy("source_id", "normalized_url").orderBy("discovery_id"))
    pages = d.withColumn("_i", item).withColumn("_n", nth).groupBy("source_id", "_n", F.pmod(F.xxhash64("discovery_id"), F.lit(512)).alias("_k")).agg(F.concat(F.lit("<ul>"), F.array_join(F.collect_list("_i"), ""), F.lit("</ul>")).alias("body"))
    found = feeds.html_listing(pages.select("source_id", "body"))
    return found.select("source_id", "url", text.presence(F.trim("title_hint")).alias("title_hint"), F.coalesce(F.unix_millis(dates.any_date(F.col("published_hint"))), F.lit(-1)).alias("hint_ms")).distinct()


@query("page_merge", """WITH p AS (SELECT article_id, string_split(content_text, chr(10)) AS ps FROM articles WHERE content_text IS NOT NULL), n AS (SELECT *, CAST(ceil(len(ps) / 3.0) AS INTEGER) AS pages, CASE WHEN article_id % 5 = 0 THEN 2 ELSE CAST(ceil(len(ps) / 3.0) AS INTEGER) END AS most FROM p)
 SELECT CAST(article_id AS VARCHAR) AS article_url, array_to_string(ps[1:3 * least(pages, most)], chr(10)) AS content_text, least(pages, most) AS pages FROM n""")
def page_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Articles split into pages of three paragraphs and put together again: every second page names no canonical URL, the others one
    with a page parameter; of a fifth of the articles the third page is another article's."""
    a = table(spark, sf, "articles").where("content_text is not null").select("article_id", "canonical_url", F.split("content_text", "\n").alias("ps"))
    pages = a.select("article_id", F.col("article_id").cast("string").alias("article_url"), "canonical_url", "ps", F.explode(F.sequence(F.lit(1), F.ceil(F.size("ps") / 3).cast("int"))).alias("page_no"))
    own = F.when((F.col("article_id") % 5 == 0) & (F.col("page_no") == 3), F.lit("https://foreign.example/x")).when(F.col("page_no") % 2 == 0, F.lit(None)).otherwise(with_param(F.col("canonical_url"), "page", F.col("page_no")))
    cut = pages.select("article_url", "page_no", own.alias("canonical_url"), F.slice("ps", (F.col("page_no") - 1) * 3 + 1, F.lit(3)).alias("paragraphs"))
    return discovery.merge_pages(cut).select("article_url", F.array_join("paragraphs", "\n").alias("content_text"), "pages")


# Listings in embedded JSON


def _json_pages(spark: SparkSession, sf: str, entry: Column, wrap) -> DataFrame:
    """(source_id, body): sightings as documents of many entries each, ``wrap`` making a body of the list of entries."""
    d = table(spark, sf, "discovered_urls")
    by = d.withColumn("_e", entry).groupBy("source_id", F.to_date("first_discovered_at").alias("_d"), F.pmod(F.xxhash64("discovery_id"), F.lit(64)).alias("_k"))
    return by.agg(F.collect_list("_e").alias("entries")).select("source_id", wrap(F.col("entries")).alias("body"))


_LISTED = "SELECT source_id, normalized_url AS url, nullif(listing_title, '') AS title_hint, count(*) AS n FROM discovered_urls GROUP BY ALL"


def _counted(items: DataFrame) -> DataFrame:
    return items.groupBy("source_id", "url", text.presence(F.col("title_hint")).alias("title_hint")).agg(F.count("*").alias("n"))


@query("graphql_items", "SELECT source_id, 'https://k.example/' || source_id || '/judul-' || discovery_id AS url, nullif(listing_title, '') AS title_hint, count(*) AS n FROM discovered_urls WHERE discovery_id % 2 = 0 GROUP BY ALL UNION ALL SELECT source_id, normalized_url, nullif(listing_title, ''), count(*) FROM discovered_urls WHERE discovery_id % 2 = 1 GROUP BY ALL")
def graphql_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings as pages of a GraphQL feed, every second node without an address of its own, read back."""
    own = F.when(F.col("discovery_id") % 2 == 1, F.col("normalized_url"))
    node = F.struct(own.alias("url"), F.col("listing_title").alias("title"), F.lit("judul").alias("slug"), F.col("discovery_id").cast("string").alias("shortId"), F.struct(F.col("source_id").alias("username")).alias("account"))
    pages = _json_pages(spark, sf, F.struct(node.alias("node")), lambda x: F.to_json(F.struct(F.struct(F.struct(x.alias("edges")).alias("findContentFeed")).alias("data"))))
    return _counted(feeds.graphql_feed(pages, base_url="https://k.example"))


@query("next_items", _LISTED)
def next_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings as listings that pages embed in __NEXT_DATA__, read back."""
    entry = F.struct(F.col("normalized_url").alias("url"), F.col("listing_title").alias("title"))
    state = lambda x: F.to_json(F.struct(F.struct(F.struct(F.struct(x.alias("data")).alias("initialArticles")).alias("pageProps")).alias("props")))
    pages = _json_pages(spark, sf, entry, lambda x: F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), F.replace(state(x), F.lit("</"), F.lit("<\\/")), F.lit("</script></html>")))
    return _counted(feeds.next_listing(pages))


@query("payload_items", _LISTED)
def payload_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings as index-encoded payloads, all titles and addresses behind indexes, read back."""
    entry = F.struct(F.col("normalized_url").alias("u"), F.coalesce("listing_title", F.lit("")).alias("t"))

    def encoded(x: Column) -> Column:
        n = F.size(x)
        item = lambda i: F.format_string('{"url":%d,"title":%d}', F.lit(2) + n + 2 * i, F.lit(3) + n + 2 * i)
        quoted = lambda c: F.expr("1") if c is None else F.regexp_extract(F.to_json(F.array(c)), "(?s)^\\[(.*)\\]$", 1)
        values = F.flatten(F.transform(x, lambda e: F.array(quoted(e["u"]), quoted(e["t"]))))
        refs = F.array_join(F.transform(F.sequence(F.lit(2), n + 1), lambda i: i.cast("string")), ",")
        items = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), item), ",")
        return F.concat(F.lit('[{"latest":1},['), refs, F.lit("],"), items, F.lit(","), F.array_join(values, ","), F.lit("]"))

    return _counted(feeds.payload_listing(_json_pages(spark, sf, entry, encoded)))


@query("flat_sitemap", r"SELECT source_id, normalized_url AS url, count(*) AS n FROM discovered_urls WHERE regexp_matches(normalized_url, '/read/\d+/') GROUP BY ALL")
def flat_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings as flat sitemaps, those that look like articles read back."""
    d = table(spark, sf, "discovered_urls")
    pages = _gathered(d, F.concat(F.lit("<url><loc>"), F.col("normalized_url"), F.lit("</loc></url>")), "<urlset>", "</urlset>")
    return feeds.flat_sitemap(pages, "/read/\\d+/").groupBy("source_id", "url").agg(F.count("*").alias("n"))


@query("articles_json", "SELECT article_id, source_id, title, content_hash FROM articles")
def articles_json(spark: SparkSession, sf: str) -> DataFrame:
    """Articles written as JSON files and read back."""
    at = f"{shared_dir(spark)}/json-{uuid.uuid4().hex}"
    feeds.write_json(table(spark, sf, "articles").select("article_id", "source_id", "title", "content_hash"), at)
    return spark.read.schema("article_id long, source_id string, title string, content_hash string").json(at)


# Fields from other places than the article's own markup


def _field_pages(articles: DataFrame) -> DataFrame:
    """Each article as a page whose fields stand in the data layer, a breadcrumb, a list of images, a comment and a page state, by its id;
    every third is marked as locked."""
    k = F.col("article_id") % 3
    crumbs = F.to_json(F.struct(F.lit("BreadcrumbList").alias("@type"), F.array(F.struct(F.lit(2).alias("position"), F.coalesce("category", F.lit("")).alias("name")), F.struct(F.lit(1).alias("position"), F.lit("Beranda").alias("name"))).alias("itemListElement")))
    news = F.to_json(F.struct(F.lit("NewsArticle").alias("@type"), F.array(F.struct(F.coalesce("thumbnail_url", F.lit("")).alias("url"))).alias("image"), (k != 0).alias("isAccessibleForFree")))
    layer = F.concat(F.lit("dataLayer.push("), F.to_json(F.struct(F.coalesce("author_name", F.lit("")).alias("penulis"))), F.lit(");"))
    safe = lambda c: F.replace(c, F.lit("</"), F.lit("<\\/"))
    body = F.array_join(F.transform(F.split("content_text", "\n"), lambda x: F.concat(F.lit("<p>"), _escape(x), F.lit("</p>"))), "")
    page = F.concat(F.lit('<html><script type="application/ld+json">['), safe(news), F.lit(","), safe(crumbs), F.lit("]</script><script>"), safe(layer), F.lit("</script><h1>"), _escape(F.col("title")), F.lit('</h1><span class="date"><!-- '), F.coalesce(dates.iso(F.col("published_at")), F.lit("")), F.lit(" -->kemarin</span><article>"), body, F.lit("</article></html>"))
    return articles.select(F.col("article_id").alias("page_id"), "source_id", page.alias("body"))


_TEASER = r"(?i)\b(langganan|berlangganan|pelanggan|subscribe|subscribers?|subscription|log ?in|masuk)\b.{0,60}\b(lanjut\w*|selengkapnya|penuh|continue|full|unlock|read on)\b"


@query("page_fields", rf"""WITH l AS (SELECT *, list_filter(list_transform(string_split(content_text, chr(10)), lambda x: {_LINE.format("x")}), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^\s*(baca juga|pilihan editor|cek berita dan artikel|ringkasan berita|simak (juga|video)|lihat juga)\b')) AS ps FROM articles),
 t AS (SELECT *, article_id % 3 = 0 OR regexp_matches(right(array_to_string(ps, chr(10) || chr(10)), 400), '{_TEASER}') AS locked FROM l)
 SELECT article_id AS page_id, nullif({_LINE.format("coalesce(category, '')")}, '') AS category, nullif({_LINE.format("coalesce(author_name, '')")}, '') AS author_name, nullif(trim(thumbnail_url), '') AS thumbnail_url, locked AS premium,
 coalesce(epoch_us(published_at) // 1000, -1) AS published_ms, CASE WHEN locked THEN 'low' ELSE 'medium' END AS content_confidence FROM t WHERE len(ps) > 0""")
def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields read back from breadcrumb, data layer, image list and comment, with the teaser mark and the confidence it leaves."""
    p = pipeline.parse_pages(_field_pages(table(spark, sf, "articles"))).where("content_text is not null")
    clean = lambda c: text.presence(text.collapse_space(F.coalesce(c, F.lit(""))))
    return p.select("page_id", clean("category").alias("category"), clean("author_name").alias("author_name"), text.presence(F.trim("thumbnail_url")).alias("thumbnail_url"), "premium", F.coalesce(F.unix_millis(dates.any_date(F.col("published"))), F.lit(-1)).alias("published_ms"), F.col("provenance")["content_text"]["confidence"].alias("content_confidence"))


@query("since_window", f"SELECT article_id, collected_at < {SINCE_SQL} AS older FROM articles")
def since_window(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each article is older than a cut-off."""
    return table(spark, sf, "articles").select("article_id", dates.older_than(F.col("collected_at"), dates.cutoff(F.lit(SINCE), 0)).alias("older"))


@query("keyword_lists", "SELECT article_id, count(DISTINCT lower(trim(t))) AS n FROM (SELECT article_id, unnest(tags) AS t FROM articles) WHERE trim(t) <> '' GROUP BY article_id")
def keyword_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Tags joined into a list as pages carry it and split again."""
    a = table(spark, sf, "articles").where("size(tags) > 0")
    return a.select("article_id", F.size(text.keyword_list(F.array_join("tags", " , "))).cast("long").alias("n"))


@query("published_iso", "SELECT article_id, epoch_us(date_trunc('milliseconds', published_at)) AS published_us FROM articles WHERE published_at IS NOT NULL")
def published_iso(spark: SparkSession, sf: str) -> DataFrame:
    """ISO moments written and read back."""
    a = table(spark, sf, "articles").where("published_at is not null")
    return a.select("article_id", us(dates.listing_date(dates.iso(F.col("published_at")))).alias("published_us"))
