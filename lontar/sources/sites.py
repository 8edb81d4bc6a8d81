"""Per-site rules: which URLs are articles, where ids and fields stand. Data for the generic functions; other tables may be passed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Host, article path, excluded path, external id in the path, body containers, title, author of each site.
SITES = {
    "detik": (r"(^|\.)detik\.com$", r"/d-\d+([/-].*)?$", r"/(tag|indeks|search|foto|video)/", r"/d-(\d+)(?:[/-]|$)", ".detail__body-text, .itp_bodycontent", ".detail__title", ".detail__author"),
    "suara": (r"^www\.suara\.com$", r"^/[a-z0-9-]+/\d{4}/\d{2}/\d{2}/\d{6}/[a-z0-9-]+/?(\?.*)?$", r"/(tag|indeks|search|author|reporter|foto|video|loadmoredetail)(/|$|\?)", r"/(\d{6})/", ".article-content", ".article-image h1", ".author-trigger a"),
    "viva": (r"^www\.viva\.co\.id$", r"^/[a-z0-9-]+(/[a-z0-9-]+)?/\d+-[a-z0-9-]+/?(\?.*)?$", r"/(indeks|tag|search|foto|video|about|redaksi|pedoman-media-siber)(/|$|\?)", r"/(\d+)-[a-z0-9-]+", ".main-content-detail", ".main-title", ".date-time .author"),
    "cnn_indonesia": (r"^www\.cnnindonesia\.com$", r"^/[a-z0-9-]+/\d{14}-\d+-\d+/[a-z0-9-]+/?(\?.*)?$", r"/(indeks|tag|search|tentang-kami|outboundlinks)(/|$|\?)", r"/\d{14}-\d+-(\d+)/", ".detail-text", "h1", ".text-cnn_black_light3 span"),
    "liputan6": (r"^www\.liputan6\.com$", r"^/[a-z0-9-]+/read/\d+(/[a-z0-9-]+)?/?(\?.*)?$", r"/(indeks|tag|search|author|photo|foto|video)/", r"/read/(\d+)(?:[/?]|$)", ".article-content-body__item-page", ".read-page--header--title", ".read-page-box__author__name"),
    "tirto": (r"^(www\.)?tirto\.id$", r"^/[a-z0-9]+(-[a-z0-9]+)+-[a-zA-Z0-9]{4}/?(\?.*)?$", r"^/(indeks|news|bisnis-tirto|visual-tirto|kueri|inception|rilis-pers|jangkar|pikir-dua-kali|weekly)/?$", r"^/[^/]*-([a-zA-Z0-9]{4})/?(?:\?|$)", ".content-text-editor", "h1.article-title", ".byline a.reporter-name"),
    "tempo": (r"^(www\.)?tempo\.co$", r"^/[^/]+/[a-z0-9]+(-[a-z0-9]+)*-\d+/?(\?.*)?$", r"^/(penulis|tag)/", r"-(\d+)/?(?:\?|$)", "#content-wrapper", "h1", "a[href*=/penulis/]"),
    "kumparan": (r"^kumparan\.com$", r"^/[a-z0-9][a-z0-9-]*/[^/]+-[0-9]{2}[A-Za-z0-9]{9}/?(\?.*)?$", r"^/(channel|topic|search|about|tentang-kumparan|login)/", r"-([0-9]{2}[A-Za-z0-9]{9})/?(?:\?|$)", "[data-qa-id=story-body], article", "[data-qa-id=story-title]", "[data-qa-id=author-name]"),
    "jawa_pos": (r"^(www\.)?jawapos\.com$", r"^/[a-z0-9-]+/\d{10}/[a-z0-9-]+/?(\?.*)?$", r"/(indeks|search|tag|author|login|subscription|foto|infografis)(/|$|\?)", r"/(\d{10})/", ".content-article", "h1", ".author"),
    "okezone": (r"^(news|economy|women|celebrity|sports|bola|ototekno|muslim|edukasi)\.okezone\.com$", r"^/read/\d{4}/\d{2}/\d{2}/\d+/\d+/[a-z0-9-]+/?(\?.*)?$", r"^/(more|mmore|indeks|tag|author|search|foto|video|infografis)(/|$)", r"^/read/\d{4}/\d{2}/\d{2}/\d+/(\d+)/", ".c-detail.read", ".title-article h1", ".journalist a"),
    "sindonews": (r"^(www|nasional|daerah|ekbis|international|sports|kalam|edukasi|lifestyle|otomotif|tekno)\.sindonews\.com$", r"^/read/\d+/\d+/[a-z0-9-]+(/\d+)?/?(\?.*)?$", r"^/(indeks|tag|search)(/|$)", r"^/read/(\d+)/", ".detail-desc, #detail-desc", "h1.detail-title", ".detail-nama-redaksi a[rel=author]"),
    "idn_times": (r"^www\.idntimes\.com$", r"^/[^/]+/[^/]+/[a-z0-9]+(-[a-z0-9]+)*-[a-z0-9]{5}-[a-z0-9]{6}/?(\?.*)?$", r"^/(author|tag|search|ajax|v1|tag-manager|sitemap\.xml)(/|$)", r"-([a-z0-9]{5}-[a-z0-9]{6})/?(?:\?|$)", "#article-description", "h1[data-testid=title-article]", "[data-testid=author-article-1]"),
    "republika": (r"^(?!static\.|files\.)([a-z0-9-]+\.)*republika\.co\.id$", r"^/berita/[a-z0-9]{6,14}/[a-z0-9-]+/?(\?.*)?$", r"^/(indeks|tag)(/|$)", r"/berita/([a-z0-9]{6,14})(?:/|$)", ".article-content article", ".max-card__title h1", ".byline"),
    "media_indonesia": (r"^(www\.)?mediaindonesia\.com$", r"^/[a-z0-9-]+/\d+/(?=[a-z0-9-]*[a-z])[a-z0-9-]+/?(\?.*)?$", r"^/(indeks|video|galleries|e-paper|epaper|tag|author|penulis)(/|$)", r"^/[a-z0-9-]+/(\d+)/", "div.article", "h1", ".byline .author, .date-author .author"),
    "merdeka": (r"^www\.merdeka\.com$", r"^/[a-z0-9-]+/read/\d+/[a-z0-9-]+/?(\?.*)?$", r"^/(foto|video|slideshow)/", r"/read/(\d+)/", ".articles-content__body", "h1.articles-content__title", "[data-tracking=author_name]"),
    "beritasatu": (r"^(www\.)?beritasatu\.com$", r"^/[a-z0-9-]+/\d+/[a-z0-9-]+/?(\?.*)?$", r"^/(indeks|tag|search|widget|widgets|network|penulis|editor)(/|$)", r"^/[a-z0-9-]+/(\d+)/", ".body-content", "h1", ".author"),
    "tribunnews": (r"^www\.tribunnews\.com$", r"^/[a-z0-9-]+/(\d{5,}|\d{4}/\d{2}/\d{2})/(?=[a-z0-9-]*[a-z])[a-z0-9-]+/?(\?.*)?$", r"^/(index-news|tag|topic|search|komentar|member|auth|api)(/|$)", r"^/[a-z0-9-]+/(\d{5,})/", "div.side-article.txt-article", "h1#arttitle", ".author"),
}
COLUMNS = ["source_id", "host_pattern", "path_pattern", "not_pattern", "id_pattern", "body", "title", "author"]


def site_rules(spark: SparkSession) -> DataFrame:
    """The rules as a table for ``apply_url_rules``."""
    return spark.createDataFrame([(k, *v) for k, v in SITES.items()], ", ".join(f"{c} string" for c in COLUMNS))


def selectors() -> dict[str, dict[str, str]]:
    """Where body, title and author stand on the pages of each site."""
    return {k: dict(zip(COLUMNS[5:], v[4:])) for k, v in SITES.items()}


def check_known(rows: DataFrame, known: DataFrame, column: str = "source_id") -> DataFrame:
    """``rows``, failing when run with an error that names a source which ``known`` (a short list) doesn't have."""
    listed = known.select(F.col(column).alias("_known")).distinct()
    joined = rows.join(listed, F.col(column) == F.col("_known"), "left")
    return joined.withColumn(column, F.when(F.col("_known").isNotNull(), F.col(column)).otherwise(F.raise_error(F.concat(F.lit("unknown source: "), F.coalesce(F.col(column), F.lit("null")))))).drop("_known")


# Minutes between crawls and hours of overlap of the sites' profiles.
PROFILES = {
    (15, 2): ["detik", "suara"],
    (20, 3): ["viva", "cnn_indonesia", "liputan6", "kumparan", "okezone", "sindonews"],
    (30, 4): ["tempo", "tirto", "jawa_pos", "idn_times", "republika", "media_indonesia", "merdeka"],
    (60, 6): ["beritasatu", "tribunnews"],
}


def site_profiles(spark: SparkSession) -> DataFrame:
    """(source_id, crawl_interval_minutes, overlap_hours, timezone, enabled, restricted) of the sites."""
    rows = [(s, m, h, "Asia/Jakarta", True, m == 60) for (m, h), ids in PROFILES.items() for s in ids]
    return spark.createDataFrame(rows, "source_id string, crawl_interval_minutes int, overlap_hours int, timezone string, enabled boolean, restricted boolean")
