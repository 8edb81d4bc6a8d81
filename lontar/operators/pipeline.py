"""From fetched pages to articles: every page ends in exactly one outcome."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lontar.functions import html as H
from lontar.functions.dates import any_date
from lontar.functions.text import content_hash
from lontar.functions.urls import apply_url_rules, normalize_url
from lontar.operators.upsert import storable, upsert_articles, upsert_status, with_warnings
from lontar.session import cut
from lontar.sources.sites import selectors

RETRYABLE = [408, 425, 429, 500, 502, 503, 504]
PARSED = "page_id long, title string, subtitle string, summary string, author_name string, category string, tags array<string>, published string, updated string, thumbnail_url string, canonical string, content_text string, content_html string, premium boolean, provenance map<string,struct<source:string,confidence:string>>, page_count int"
_S = pa.string()
ARROW = [_S, _S, _S, _S, _S, pa.list_(_S), _S, _S, _S, _S, _S, _S, pa.bool_(), pa.map_(_S, pa.struct([("source", _S), ("confidence", _S)])), pa.int32()]
GENERIC = {"body": "article, .article-content, .detail__body-text, #content, main, body", "title": "h1", "author": ".author, [rel=author]", "noise": "script, style, nav, aside, footer, .ads, .advertisement, .baca-juga"}


def fetch_outcome(status: Column) -> Column:
    """What a response's status means: fetched, retry_scheduled, blocked or dead_letter."""
    return F.when(status.between(200, 299), "fetched").when(status.isin(RETRYABLE), "retry_scheduled").when(status.isin(401, 403), "blocked").otherwise("dead_letter")


#: How far a field can be trusted by where it was found.
CONFIDENCE = {"json_ld": "high", "state": "high", "data_layer": "high", "link": "high", "dom": "medium", "comment": "medium", "breadcrumb": "medium", "meta": "medium", "title": "low"}
HASHTAGS = re.compile(r"(\s*#\w+)+\s*$")


def _unique(values) -> list[str]:
    """Trimmed, not empty, first of equals but for case."""
    seen: dict[str, str] = {}
    for v in values:
        if v.strip():
            seen.setdefault(v.strip().lower(), v.strip())
    return list(seen.values())


def parse_page(body: str, site: dict[str, str]) -> dict | None:
    """Fields of one page by chains of places (JSON-LD, elements, meta, title), with the place each came from; None for an empty page."""
    if not (body or "").strip():
        return None
    root = H.parse(body)
    objects = H.json_ld(root)
    ld, layer = H.typed(objects, "article"), H.data_layer(body)
    state = H.find_key(H.window_state(body, site["state"]), "article") if site.get("state") else None
    state = state if isinstance(state, dict) else {}
    moments = [n for n in H.select(root, "time, .date")]
    css = lambda sel: next((t for n in H.select(root, sel) if (t := n.text())), None) if sel else None
    attr = lambda sel, a: next((v for n in H.select(root, sel) if (v := n.attrs.get(a, "").strip())), None)
    chains = {
        "title": [("json_ld", ld.get("headline")), ("dom", css(site.get("title"))), ("dom", css("h1")), ("meta", H.meta(root, "og:title")), ("title", css("title"))],
        "summary": [("json_ld", ld.get("description")), ("meta", H.meta(root, "og:description")), ("meta", H.meta(root, "description"))],
        "author_name": [("json_ld", ", ".join(_unique(H.names(ld.get("author"))))), ("data_layer", layer.get("penulis")), ("dom", ", ".join(_unique(x for n in H.select(root, site["author"]) for x in n.text().split(" - ")[:1])) if site.get("author") else None), ("meta", H.meta(root, "author"))],
        "category": [("json_ld", ld.get("articleSection") if isinstance(ld.get("articleSection"), str) else None), ("data_layer", layer.get("sub_category") or layer.get("content_category")), ("breadcrumb", H.last_section(H.breadcrumb(objects))), ("breadcrumb", H.last_section([n.text() for n in H.select(root, ".breadcrumb a")]))],
        "published": [("json_ld", ld.get("datePublished")), ("meta", H.meta(root, "article:published_time")), ("state", state.get("published_at")), ("dom", attr("time[datetime]", "datetime")), ("comment", next((c for n in moments for c in H.comments(n)), None)), ("dom", next((x for n in moments if (x := n.text())), None))],
        "updated": [("json_ld", ld.get("dateModified")), ("meta", H.meta(root, "article:modified_time"))],
        "thumbnail_url": [("json_ld", H.first_image(ld.get("image"))), ("meta", H.meta(root, "og:image"))],
        "canonical": [("link", attr("link[rel=canonical]", "href")), ("meta", H.meta(root, "og:url")), ("json_ld", ld.get("url") if isinstance(ld.get("url"), str) else None)],
        "subtitle": [("json_ld", ld.get("alternativeHeadline"))],
    }
    out: dict = {"provenance": {}}
    for field, chain in chains.items():
        place, value = next(((p, v.strip()) for p, v in chain if isinstance(v, str) and v.strip()), (None, None))
        out[field] = value
        if place:
            out["provenance"][field] = {"source": place, "confidence": CONFIDENCE[place]}
    words = ld.get("keywords")
    words = words.split(",") if isinstance(words, str) else words or (H.meta(root, "keywords") or "").split(",")
    out["tags"] = [w for w in _unique(w.lstrip("#") for w in words if isinstance(w, str)) if w.lower() not in site.get("not_tags", ())]
    if out["summary"]:
        out["summary"] = HASHTAGS.sub("", out["summary"]).strip() or None
    body_text = H.paragraphs(root, site.get("body") or GENERIC["body"], GENERIC["noise"]) or H.paragraphs(root, GENERIC["body"], GENERIC["noise"])
    place = "dom"
    if not body_text and isinstance(state.get("content"), str):  # a body written as markup within JSON
        body_text, place = H.paragraphs(H.parse(f"<div>{state['content']}</div>"), "div"), "state"
    if not body_text and isinstance(ld.get("articleBody"), str):
        body_text, place = [x.strip() for x in re.split(r"\n+", ld["articleBody"]) if x.strip()], "json_ld"
    out["content_text"] = "\n\n".join(body_text) or None
    out["content_html"] = "\n".join(f"<p>{p}</p>" for p in body_text) or None
    out["premium"] = H.premium(root, out["content_text"] or "")
    if body_text:
        out["provenance"]["content_text"] = {"source": place, "confidence": "low" if out["premium"] else CONFIDENCE[place]}
    out["page_count"] = max([1, *(int(n) for a in H.select(root, "a[href*=page=]") if (n := (re.search(r"[?&]page=(\d{1,4})\b", a.attrs["href"]) or [0, "0"])[1]))])
    return out


_COLUMNS = re.findall(r"(?:^|, )(\w+) ", re.sub(r"<[^ ]*>", "", PARSED))


def _parsed(source: str, body: str | None, sites: dict[str, dict[str, str]]) -> list:
    try:
        p = parse_page(body, sites.get(source, {})) or {}
    except (ValueError, RecursionError, AssertionError):
        p = {}
    return [p.get(c) for c in _COLUMNS[1:]]


def parse_pages(pages: DataFrame, sites: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Parsed fields of pages (page_id, source_id, body), in Arrow batches; a page that can't be parsed has null fields.

    ``sites`` has the selectors of each source, those of the known sites by default; other sources are read by general ones.
    """
    sites = selectors() if sites is None else sites

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([[i, *_parsed(s, body, sites)] for i, s, body in zip(b["page_id"], b["source_id"], b["body"])], columns=_COLUMNS)

    return pages.select("page_id", "source_id", "body").mapInPandas(run, PARSED)


def run_pipeline(pages: DataFrame, rules: DataFrame, versions: str = "v1", sites: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Pages (page_id, source_id, requested_url, final_url, http_status, body, fetched_at) with their outcome (status, reason) and, where parsed, the article.

    A column ``error`` names what a request failed with, ``retryable`` says whether it may be tried again; without them, or where
    they are null, a page without a status has the wrong shape.

    First failing step wins: normalise, classify, fetch, parse, store gate. Every row is in the result once, whatever its id: pages
    are read once, in one pass that parses those that got that far and hands the others' columns on.
    """
    sites = selectors() if sites is None else sites
    urls = pages.withColumn("normalized_url", normalize_url(F.col("requested_url"))).withColumn("url", F.col("normalized_url"))
    for name, kind in (("error", "string"), ("retryable", "boolean")):
        urls = urls if name in urls.columns else urls.withColumn(name, F.lit(None).cast(kind))
    judged = apply_url_rules(urls, rules).withColumn("fetch", fetch_outcome(F.col("http_status")))
    early = (
        F.when(F.col("normalized_url").isNull(), F.struct(F.lit("invalid").alias("status"), F.lit("url_normalization_failed").alias("reason")))
        .when(~F.col("is_article"), F.struct(F.lit("ignored_by_policy").alias("status"), F.lit("not_article_url").alias("reason")))
        .when(F.col("error").isNotNull() | F.col("retryable").isNotNull(), F.struct(F.when(F.col("retryable"), "retry_scheduled").otherwise("dead_letter").alias("status"), F.coalesce(F.nullif("error", F.lit("")), F.lit("fetch_threw")).alias("reason")))
        .when(F.col("http_status").isNull(), F.struct(F.lit("invalid").alias("status"), F.lit("invalid_fetch_result_shape").alias("reason")))
        .when(F.col("fetch") != "fetched", F.struct(F.col("fetch").alias("status"), F.concat(F.lit("http_status_"), F.col("http_status").cast("string")).alias("reason")))
    )
    judged = judged.select(*[c for c in judged.columns if c not in _COLUMNS[1:]], early.alias("early"))
    carried = [c for c in judged.columns if c != "body"]
    kinds = ", ".join(f"`{c}` {judged.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = b.column("early").is_null().to_pylist()
            fields = [_parsed(s, body, sites) if go else [None] * (len(_COLUMNS) - 1) for s, body, go in zip(b.column("source_id").to_pylist(), b.column("body").to_pylist(), done)]
            made = [pa.array([list(v.items()) if isinstance(v := f[i], dict) else v for f in fields], kind) for i, kind in enumerate(ARROW)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carried), *made], names=[*carried, *_COLUMNS[1:]])

    out = judged.mapInArrow(run, f"{kinds}, {PARSED.split(', ', 1)[1]}")
    out = out.withColumn("content_hash", F.when(F.col("content_text").isNotNull(), content_hash(F.col("title"), F.col("content_text")))).withColumn("canonical_url", F.coalesce(normalize_url(F.col("canonical"), F.col("normalized_url")), "normalized_url", "final_url"))
    out = out.withColumn("published_at", any_date(F.col("published"))).withColumn("updated_at_source", any_date(F.col("updated"))).withColumn("adapter_version", F.lit(versions)).withColumn("parser_version", F.lit(versions)).withColumn("language", F.lit("id"))
    late = F.when(F.col("title").isNull() & F.col("content_text").isNull(), F.struct(F.lit("invalid").alias("status"), F.lit("parse_returned_empty").alias("reason"))).when(~F.coalesce(storable(), F.lit(False)), F.struct(F.lit("dead_letter").alias("status"), F.lit("store_failed").alias("reason"))).otherwise(F.struct(F.lit("parsed").alias("status"), F.lit("storable").alias("reason")))
    out = out.withColumn("o", F.coalesce("early", late)).withColumn("status", F.col("o.status")).withColumn("reason", F.col("o.reason"))
    return out.drop("o", "early", "fetch", "error", "retryable", "url", "canonical", "published", "updated")


def store(outcomes: DataFrame, articles: DataFrame, status: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pipeline's last step: merged articles, new revisions and merged processing status.

    ``outcomes`` are rows of ``run_pipeline``; ``articles`` and ``status`` what is stored. Storable pages end as stored or duplicate by
    what they meet, all others with the outcome they had; a page without a normalised URL is kept under its requested one.
    """
    outcomes = cut(outcomes)  # read several times; pages are parsed once
    ready = outcomes.where("status = 'parsed'").withColumn("collected_at", F.col("fetched_at")).withColumn("first_discovered_at", F.col("fetched_at")).withColumn("validation_warnings", F.lit(None).cast("array<string>"))
    ready = with_warnings(ready)
    columns = [c for c in articles.columns if c in ready.columns]
    merged, revisions, verdicts = upsert_articles(articles.select(*columns), ready.select(*columns))
    named = ready.select("source_id", "canonical_url", "content_hash", "collected_at", "normalized_url").distinct()
    good = verdicts.join(named, ["source_id", "canonical_url", "content_hash", "collected_at"]).select("source_id", "normalized_url", "status", "reason", F.col("collected_at").alias("at"))
    rest = outcomes.where("status != 'parsed'").select("source_id", F.coalesce("normalized_url", "requested_url").alias("normalized_url"), "status", "reason", F.col("fetched_at").alias("at"))
    changes = good.unionByName(rest).withColumn("article_id", F.lit(None).cast("long"))
    return merged, revisions, upsert_status(status, changes)
