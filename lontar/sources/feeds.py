"""Listings as rows: sitemaps, feeds, HTML indexes and embedded JSON, one stage of Arrow batches or built-in expressions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lontar.functions import html as H

ITEM = "source_id string, url string, channel string, title_hint string, published_hint string, keywords array<string>, position int"


def _unwrap(c: Column) -> Column:
    """Text of an XML element: CDATA marks removed, entities of XML resolved, trimmed; '' is null."""
    t = F.trim(F.regexp_replace(c, "(?s)^\\s*<!\\[CDATA\\[(.*?)\\]\\]>\\s*$", "$1"))
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.nullif(t, F.lit(""))


def _inside(block: Column, tag: str) -> Column:
    return _unwrap(F.regexp_extract(block, f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>", 1))


def sitemap_items(pages: DataFrame, channel: str = "sitemap") -> DataFrame:
    """Items of news sitemaps (source_id, body): address, title, date (else lastmod) and keywords, which may be a JSON list."""
    block = pages.select("source_id", F.posexplode(F.regexp_extract_all("body", F.lit("(?s)<url>(.*?)</url>"), 1)).alias("position", "b"))
    words = _inside(F.col("b"), "news:keywords")
    keywords = F.coalesce(F.from_json(words, "array<string>"), F.filter(F.transform(F.split(words, ","), lambda x: F.trim(x)), lambda x: x != ""))
    return block.select("source_id", _inside(F.col("b"), "loc").alias("url"), F.lit(channel).alias("channel"), _inside(F.col("b"), "news:title").alias("title_hint"), F.coalesce(_inside(F.col("b"), "news:publication_date"), _inside(F.col("b"), "lastmod")).alias("published_hint"), keywords.alias("keywords"), "position").where("url is not null")


def flat_sitemap(pages: DataFrame, pattern: str, channel: str = "sitemap") -> DataFrame:
    """Addresses of a sitemap that fit a pattern."""
    loc = pages.select("source_id", F.posexplode(F.regexp_extract_all("body", F.lit("<loc>\\s*([^<\\s]*)\\s*</loc>"), 1)).alias("position", "url"))
    return loc.where(F.col("url").rlike(pattern)).select("source_id", "url", F.lit(channel).alias("channel"), F.lit(None).cast("string").alias("title_hint"), F.lit(None).cast("string").alias("published_hint"), F.lit(None).cast("array<string>").alias("keywords"), "position")


def rss_items(pages: DataFrame, channel: str = "rss") -> DataFrame:
    """Items of RSS feeds (source_id, body): link, title, date and categories."""
    block = pages.select("source_id", F.posexplode(F.regexp_extract_all("body", F.lit("(?s)<item(?:\\s[^>]*)?>(.*?)</item>"), 1)).alias("position", "b"))
    categories = F.transform(F.regexp_extract_all("b", F.lit("(?s)<category(?:\\s[^>]*)?>(.*?)</category>"), 1), _unwrap)
    return block.select("source_id", _inside(F.col("b"), "link").alias("url"), F.lit(channel).alias("channel"), _inside(F.col("b"), "title").alias("title_hint"), _inside(F.col("b"), "pubDate").alias("published_hint"), categories.alias("keywords"), "position").where("url is not null")


SITEMAP = "loc string, lastmod string, `news:news` struct<`news:publication_date`:string,`news:title`:string,`news:keywords`:string>"


def read_sitemaps(spark: SparkSession, path: str, channel: str = "sitemap") -> DataFrame:
    """Items of news-sitemap files, read by the built-in XML source, which splits large files; keywords as they stand."""
    rows = spark.read.format("xml").option("rowTag", "url").schema(SITEMAP).load(path)
    news = F.col("`news:news`")
    return rows.select(F.trim("loc").alias("url"), F.lit(channel).alias("channel"), news["news:title"].alias("title_hint"), F.coalesce(news["news:publication_date"], "lastmod").alias("published_hint"), news["news:keywords"].alias("keywords")).where("url is not null")


def write_json(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, a file a partition; an earlier result is replaced."""
    rows.write.mode("overwrite").json(path)


def read_articles_json(spark: SparkSession, path: str) -> DataFrame:
    """Articles from JSON files that hold a list, or an object with the list under ``articles``."""
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(F.explode("articles").alias("a")).select("a.*") if "articles" in raw.columns else raw


def _rows(pages: DataFrame, extract, channel: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s, body in zip(b["source_id"], b["body"]):
                try:
                    items = extract(body or "")
                except (ValueError, TypeError, AttributeError, KeyError):
                    items = []  # a broken listing has no items
                out += [(s, u, c or channel, t, p, k, i) for i, (u, t, p, k, c) in enumerate(items) if u]
            yield pd.DataFrame(out, columns=["source_id", "url", "channel", "title_hint", "published_hint", "keywords", "position"])

    return pages.select("source_id", "body").mapInPandas(run, ITEM)


def html_listing(pages: DataFrame, link: str = "article a[href], li a[href], h2 a[href], h3 a[href]", date: str = "time, .date", channel: str = "indeks") -> DataFrame:
    """Items of HTML indexes: each address once with its first non-empty text and the date beside it: a datetime, else a moment that a
    comment keeps beside a relative label, else the label."""

    def extract(body: str) -> list[tuple]:
        root, seen = H.parse(body), {}
        for a in H.select(root, link):
            u, box = a.attrs["href"].strip(), a.parent or a
            when = [w for n in H.select(box, date) for w in (n.attrs.get("datetime"), *H.comments(n)) if w] + H.comments(a) + [n.text() for n in H.select(box, date)]
            old = seen.get(u)
            seen[u] = (u, (old and old[1]) or a.text() or None, (old and old[2]) or next((w for w in when if w), None), None, None)
        return list(seen.values())

    return _rows(pages, extract, channel)


def next_listing(pages: DataFrame, channel: str = "indeks") -> DataFrame:
    """Items of listings that a page embeds in __NEXT_DATA__, in either of two shapes."""

    def extract(body: str) -> list[tuple]:
        props = H.next_data(H.parse(body)).get("props", {}).get("pageProps", {})
        data = (props.get("initialArticles") or {}).get("data") or props.get("categoryArticle") or []
        out = []
        for d in data:
            section = d.get("category") or {}
            slug = section.get("slug") if isinstance(section, dict) else None
            url = d.get("url") or (f"/{slug}/{d.get('id')}/{d.get('slug')}" if slug else None)
            out.append((url, d.get("title"), d.get("published_at"), None, f"category:{slug}" if slug else None))
        return out

    return _rows(pages, extract, channel)


_NODE = "struct<id:string,title:string,slug:string,shortId:string,url:string,publishedAt:string,channel:struct<slug:string,name:string>,account:struct<username:string>>"
_FEED = f"struct<data:struct<findContentFeed:struct<edges:array<struct<cursor:string,node:{_NODE}>>,pageInfo:struct<hasNextPage:boolean,endCursor:string>>>>"


def graphql_feed(pages: DataFrame, channel: str = "graphql_content_feed", base_url: str = "") -> DataFrame:
    """Items of a GraphQL connection, by built-in JSON expressions: each edge is an item. A node without an address gets one from its
    account, slug and short id under ``base_url``; one that lacks these too is left out."""
    edges = pages.select("source_id", F.posexplode(F.from_json("body", _FEED)["data"]["findContentFeed"]["edges"]).alias("position", "e"))
    built = F.concat(F.lit(base_url.rstrip("/") + "/"), F.nullif(F.col("e.node.account.username"), F.lit("")), F.lit("/"), F.nullif(F.col("e.node.slug"), F.lit("")), F.lit("-"), F.nullif(F.col("e.node.shortId"), F.lit("")))
    url = F.coalesce(F.nullif(F.col("e.node.url"), F.lit("")), built)
    return edges.select("source_id", url.alias("url"), F.lit(channel).alias("channel"), F.col("e.node.title").alias("title_hint"), F.col("e.node.publishedAt").alias("published_hint"), F.array_compact(F.array("e.node.channel.slug")).alias("keywords"), "position").where("url is not null")


def graphql_next(pages: DataFrame) -> DataFrame:
    """(source_id, cursor): where the next page of each feed begins, null at its end: what pageInfo says, else the last edge's cursor."""
    feed = F.from_json("body", _FEED)["data"]["findContentFeed"]
    ends = F.coalesce(feed["pageInfo"]["endCursor"], F.element_at(feed["edges"], -1)["cursor"])
    return pages.select("source_id", F.when(F.coalesce(feed["pageInfo"]["hasNextPage"], F.size(feed["edges"]) > 0), ends).alias("cursor"))


def payload_listing(pages: DataFrame, key: str = "latest", channel: str = "rubric_payload") -> DataFrame:
    """Items of index-encoded payloads: the list under a key of the decoded root."""

    def extract(body: str) -> list[tuple]:
        items = H.find_key(H.revive(json.loads(body)), key) or []
        return [(i.get("url") or i.get("link"), i.get("title"), i.get("published_at") or i.get("date"), None, None) for i in items if isinstance(i, dict)]

    return _rows(pages, extract, channel)


def page_count(body: Column) -> Column:
    """The number of pages a multi-page article names, 1 by default."""
    n = F.array_max(F.transform(F.regexp_extract_all(body, F.lit("[?&]page=(\\d+)"), 1), lambda x: x.try_cast("int")))
    return F.coalesce(n, F.lit(1))
