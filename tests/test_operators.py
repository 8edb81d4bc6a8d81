import io
import json
import logging
import math
import pickle
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lontar import session
from lontar.config import Clustering, Health
from lontar.functions import html, lcs
from lontar.functions.text import GENERIC_ANCHORS, STOPWORDS
from lontar.functions.urls import apply_url_rules
from lontar.operators import api, audit, clustering, discovery, greedy, pairblocks, pipeline, reports, upsert
from lontar.sources import feeds, fetch, sites, tables
from lontar.streaming import jobs, logs

T0 = datetime(2026, 7, 28, 8, 0)


def articles(spark, rows):
    return spark.createDataFrame([(i, s, t, None, at) for i, s, t, at in rows], "article_id long, source_id string, title string, summary string, collected_at timestamp")


GOLD = [
    (1, "a", "Polda Periksa Wirawan soal Dana Gempita", T0),
    (2, "b", "Wirawan Diperiksa Polda terkait Dana Gempita", T0 + timedelta(minutes=10)),
    (3, "c", "Panen Cabai Turunkan Harga Pasar Induk", T0 + timedelta(minutes=20)),
    (4, "d", "Kapal Riset Berlayar ke Laut Sembada", T0 + timedelta(minutes=30)),
    (5, "a", "Polda Periksa Wirawan soal Dana Gempita", T0 + timedelta(minutes=40)),
]


def expected_score(rows, x, y):
    """A pair's weighted Jaccard and score, from the definitions."""
    words = {i: [w for w in dict.fromkeys(re.findall("[a-z0-9]{3,}", t.lower())) if w not in STOPWORDS] for i, _, t, _ in rows}
    df = Counter(w for ws in words.values() for w in ws)
    weigh = lambda ws: sum(1 / math.log2(df[w] + 1) for w in ws)
    a, b = words[x], words[y]
    wj = weigh(set(a) & set(b)) / weigh(set(a) | set(b))
    s, t = " ".join(a), " ".join(b)
    best = [[0] * (len(t) + 1) for _ in range(len(s) + 1)]
    for i, c in enumerate(s):
        for j, d in enumerate(t):
            best[i + 1][j + 1] = best[i][j] + 1 if c == d else max(best[i][j + 1], best[i + 1][j])
    shared = len({w for w in set(a) & set(b) if w not in GENERIC_ANCHORS})
    return wj, min(1.0, 0.55 * wj + 0.25 * 2 * best[-1][-1] / (len(s) + len(t)) + 0.2 * min(5, shared) / 5)


def test_clustering_golden(spark):
    events, assigned, metrics = clustering.cluster(articles(spark, GOLD), 24)
    e = events.collect()
    assert [(x.seed, x.article_count, x.media_count, x.coverage_score) for x in e] == [(1, 3, 2, round(20 + math.log2(3), 4))]
    assert {"polda", "wirawan", "gempita"} <= set(e[0].anchor_terms) and e[0].representative_title == GOLD[0][2]
    s = {r.id: (r.seed, round(r.score, 6)) for r in assigned.collect()}
    want = {i: (1, round(expected_score(GOLD, 1, i)[1], 6)) for i in (2, 5)}
    assert s == {1: (1, 1.0), 3: (3, 1.0), 4: (4, 1.0)} | want
    assert metrics.first().asDict() == {"article_count": 5, "candidate_count": 2, "accepted_edges": 2, "event_count": 1}


def test_clustering_window_is_inclusive_and_needs_two_sources(spark):
    rows = [(1, "a", "Polda Wirawan Gempita", T0 - timedelta(hours=24)), (2, "b", "Polda Wirawan Gempita", T0 - timedelta(hours=24, seconds=1)), (3, "a", "Polda Wirawan Gempita", T0)]
    events, _, metrics = clustering.cluster(articles(spark, rows), 24)
    assert metrics.first().article_count == 2 and events.count() == 0


def test_articles_without_ids_are_an_error(spark):
    d = articles(spark, [(None, "a", "Judul", T0)])
    assert clustering.prepared(d, strict=False).count() == 0
    with pytest.raises(Exception, match="an article without article_id"):
        clustering.prepared(d).collect()


def test_assignment_equals_the_sequential_pass(spark):
    rng = random.Random(4)
    words = [f"w{i:02d}x" for i in range(18)]
    rows = [(i, rng.choice("abcd"), " ".join(rng.sample(words, 5)), T0 + timedelta(minutes=rng.randrange(4000))) for i in range(80)]
    docs = clustering.prepared(articles(spark, rows)).cache()
    scored = clustering.scored_pairs(docs, clustering.anchors(docs)).cache()
    order = {r.id: (r.at, str(r.id)) for r in docs.select("id", "at").collect()}
    edges = {}
    for r in scored.where("accepted").collect():
        edges.setdefault(r.later, []).append((-r.score, r.first_pos, order[r.earlier], r.earlier))
    seeds, want = set(), {}
    for d in sorted(order, key=order.get):
        fits = sorted(x for x in edges.get(d, []) if x[3] in seeds)
        want[d] = fits[0][3] if fits else d
        if not fits:
            seeds.add(d)
    for small in (500_000, -1):
        assert {r.id: r.seed for r in clustering.assign(docs, scored, small).collect()} == want


def test_reports_and_health(spark):
    st = spark.createDataFrame([("a", "stored"), ("a", "invalid"), ("a", "queued"), ("b", "duplicate")], "source_id string, status string")
    f = {r.source_id: r for r in reports.funnel(st).collect()}
    assert (f["a"].stored, f["a"].parse_fail, f["a"].in_progress_or_other, f["a"].total, f["b"].duplicate) == (1, 1, 1, 3, 1)

    def judge(stored, dup, fail, t, found=0):
        c = spark.createDataFrame([(stored, dup, fail)], "stored long, duplicate long, parse_fail long")
        d = spark.createDataFrame([(found,)], "total_urls long")
        return reports.health(c, d, t).first().failures

    assert judge(0, 0, 0, Health()) == []
    assert judge(1, 0, 9, Health()) == ["parse_fail_ratio"]
    assert judge(0, 0, 2, Health(min_total=10)) == ["no_success"]
    assert judge(0, 0, 0, Health(min_discoveries=1), 5) == ["discovered_without_success"]
    assert judge(0, 0, 0, Health(require_stored=True)) == ["nothing_stored"]
    assert judge(10, 0, 3, Health(max_parse_fail=2, min_total=100)) == ["parse_fail_count"]
    empty = spark.createDataFrame([], "stored long, duplicate long, parse_fail long")
    assert reports.health(empty).first().ok
    assert "| stored |" in reports.markdown("x", empty)


def test_upserts(spark):
    items = spark.createDataFrame([("a", "/r2", "u", "c", None, None, None, T0 + timedelta(hours=1)), ("a", "/r1", "u", "c", "p", "t", T0, T0)], "source_id string, raw_url string, normalized_url string, discovery_channel string, discovery_page string, listing_title string, published_hint timestamp, seen_at timestamp")
    b = upsert.discovered_batch(items)
    r = upsert.upsert_discovered(b, b).first()
    assert (r.discovery_count, r.raw_url, r.listing_title, r.first_discovered_at, r.last_discovered_at) == (4, "/r1", "t", T0, T0 + timedelta(hours=1))
    cols = "source_id string, canonical_url string, content_hash string, title string, content_text string, parser_version string, collected_at timestamp, first_discovered_at timestamp"
    old = spark.createDataFrame([("a", "u", "h1", "t", "x", "p", T0, T0)], cols)
    new = spark.createDataFrame([("a", "u", "h1", "t", "x", "p", T0 + timedelta(hours=1), T0 + timedelta(hours=9)), ("a", "u", "h2", "t", "x", "p", T0 + timedelta(hours=2), T0 + timedelta(hours=9)), ("a", "v", "h3", "t", "x", "p", T0, T0)], cols)
    merged, revisions, outcomes = upsert.upsert_articles(old, new)
    assert sorted((r.canonical_url, r.content_hash, r.first_discovered_at) for r in merged.collect()) == [("u", "h2", T0), ("v", "h3", T0)]
    assert sorted(r.content_hash for r in revisions.collect()) == ["h2", "h3"]
    assert sorted(r.reason for r in outcomes.collect()) == ["content_updated", "duplicate_content", "new_article"]


def test_run_snapshots_are_replaced(spark, tmp_path):
    """A rerun replaces the whole snapshot, also by one without events; other runs stay; the old files go."""
    e, m, r = (spark.range(n) for n in (2, 3, 1))
    assert upsert.read_run(spark, str(tmp_path), "k") is None
    for _ in range(2):
        upsert.replace_run(str(tmp_path), "k", e, m, r)
    upsert.replace_run(str(tmp_path), "other", e, m, r)
    assert [t.count() for t in upsert.read_run(spark, str(tmp_path), "k")] == [2, 3, 1]
    run = upsert.read_run(spark, str(tmp_path), "k")[2].first()
    assert run.status == "succeeded" and run.finished_at and run.run_key == "k"
    upsert.replace_run(str(tmp_path), "k", e.limit(0), m.limit(0), r)
    assert [t.count() for t in upsert.read_run(spark, str(tmp_path), "k")] == [0, 0, 1]
    assert [t.count() for t in upsert.read_run(spark, str(tmp_path), "other")] == [2, 3, 1]
    assert len(list((tmp_path / "versions").iterdir())) == 2


def test_overlap_is_a_prefix(spark):
    rows = [("s", 1, T0), ("s", 2, None), ("s", 3, T0 - timedelta(hours=5)), ("s", 4, T0), ("t", 1, None), ("t", 2, T0 - timedelta(hours=1))]
    d = spark.createDataFrame(rows, "source_id string, position int, published_hint timestamp")
    got = discovery.overlap_prefix(d, F.lit(T0 - timedelta(hours=1)))
    assert sorted((r.source_id, r.position) for r in got.collect()) == [("s", 1), ("s", 2), ("t", 1), ("t", 2)]


def test_channel_union_and_pages(spark):
    d = spark.createDataFrame([("s", "u", "b", "1"), ("s", "u", "a", "2"), ("s", "v", "b", "3")], "source_id string, normalized_url string, discovery_channel string, raw_url string")
    assert {(r.normalized_url, r.discovery_channel) for r in discovery.channel_union(d, F.col("discovery_channel")).collect()} == {("u", "a"), ("v", "b")}
    assert discovery.channel_union(d, F.col("discovery_channel"), 1).count() == 1
    p = spark.createDataFrame([("x", 1, "c", ["a"]), ("x", 2, "c", ["b"]), ("x", 4, "c", ["d"]), ("y", 1, "https://a/y", ["a"]), ("y", 2, "https://a/other", ["b"]), ("z", 1, "https://a/z", ["a"]), ("z", 2, None, ["b"]), ("z", 3, "https://a/z/?page=3", ["c"]), ("n", 2, None, ["b"])], "article_url string, page_no int, canonical_url string, paragraphs array<string>")
    assert {r.article_url: r.paragraphs for r in discovery.merge_pages(p).collect()} == {"x": ["a", "b"], "y": ["a"], "z": ["a", "b", "c"]}
    blocks = spark.createDataFrame([([(2, ["c"]), (None, ["a"]), (1, ["b"])],)], "b array<struct<page:int,paragraphs:array<string>>>")
    assert blocks.select(discovery.in_page_order(F.col("b")).alias("x")).first().x == ["a", "b", "c"]


def test_site_rules(spark):
    rows = [
        ("detik", "https://news.detik.com/berita/d-123/judul", True, "123"), ("detik", "https://news.detik.com/foto/d-123/x", False, "123"), ("tempo", "https://www.tempo.co/politik/judul-baru-99", True, "99"), ("tempo", "https://www.tempo.co/tag/judul-99", False, "99"),
        ("okezone", "https://news.okezone.com/read/2026/07/28/337/456/judul", True, "456"), ("okezone", "https://x.okezone.com/read/2026/07/28/337/456/judul", False, "456"), ("republika", "https://static.republika.co.id/berita/abc123/judul", False, "abc123"), ("unknown", "https://a.example/1", False, None),
    ]
    d = spark.createDataFrame([r[:2] for r in rows], "source_id string, url string")
    got = {r.url: (r.is_article, r.external_id) for r in apply_url_rules(d, sites.site_rules(spark)).collect()}
    assert got == {u: (a, i) for _, u, a, i in rows}
    assert sites.site_profiles(spark).count() == len(sites.SITES) == 17


def test_pipeline_gives_every_page_one_outcome(spark):
    page = '<link rel=canonical href="https://a.example/read/1/x"><h1>Judul panjang</h1><article><p>Isi</p></article>'
    rows = [(1, "https://a.example/read/1/x", 200, page), (2, "https://a.example/tag/x", 200, page), (3, "oops", 200, page), (4, "https://a.example/read/4/x", 503, None), (5, "https://a.example/read/5/x", 403, None), (6, "https://a.example/read/6/x", 404, None), (7, "https://a.example/read/7/x", 200, ""), (8, "https://a.example/read/8/x", None, None), (9, "https://a.example/read/9/x", 200, "<h1>Judul</h1>")]
    d = spark.createDataFrame([(i, "s", u, u, h, b, T0) for i, u, h, b in rows], "page_id long, source_id string, requested_url string, final_url string, http_status int, body string, fetched_at timestamp")
    rules = spark.createDataFrame([("s", ".", "/read/", None, "/read/(\\d+)")], "source_id string, host_pattern string, path_pattern string, not_pattern string, id_pattern string")
    got = {r.page_id: (r.status, r.reason) for r in pipeline.run_pipeline(d, rules).collect()}
    failed = d.where("page_id in (1, 4, 8)").withColumn("error", F.when(F.col("page_id") == 4, "timeout")).withColumn("retryable", F.when(F.col("page_id") == 8, False).when(F.col("page_id") == 4, True))
    assert {r.page_id: (r.status, r.reason) for r in pipeline.run_pipeline(failed, rules).collect()} == {1: ("parsed", "storable"), 4: ("retry_scheduled", "timeout"), 8: ("dead_letter", "fetch_threw")}
    assert got == {1: ("parsed", "storable"), 2: ("ignored_by_policy", "not_article_url"), 3: ("invalid", "url_normalization_failed"), 4: ("retry_scheduled", "http_status_503"), 5: ("blocked", "http_status_403"), 6: ("dead_letter", "http_status_404"), 7: ("invalid", "parse_returned_empty"), 8: ("invalid", "invalid_fetch_result_shape"), 9: ("dead_letter", "store_failed")}


def test_field_chains_prefer_structured_data():
    p = pipeline.parse_page('<title>T</title><meta property="og:title" content="O"><script type="application/ld+json">[{"@type":["Thing","NewsArticle"],"headline":"L","author":[{"name":"A"},{"name":"B"}],"keywords":"x, X,y","image":{"url":"i"}}]</script><h1>H</h1>', {})
    assert (p["title"], p["author_name"], p["tags"], p["thumbnail_url"], p["provenance"]["title"]["source"]) == ("L", "A, B", ["x", "y"], "i", "json_ld")
    assert pipeline.parse_page("<title>T</title>", {})["title"] == "T" and pipeline.parse_page(" ", {}) is None


def test_listings(spark):
    d = lambda body: spark.createDataFrame([("s", body)], "source_id string, body string")
    html = feeds.html_listing(d('<li><a href="/a"></a><a href="/a">Satu</a><time datetime="t1"></time></li><li><a href="/b">Dua</a></li>')).collect()
    assert [(r.url, r.title_hint, r.published_hint) for r in html] == [("/a", "Satu", "t1"), ("/b", "Dua", None)]
    nxt = feeds.next_listing(d('<script id="__NEXT_DATA__">{"props":{"pageProps":{"categoryArticle":[{"id":7,"slug":"x","title":"T","category":{"slug":"k"}}]}}}</script>')).first()
    assert (nxt.url, nxt.channel) == ("/k/7/x", "category:k")
    gql = feeds.graphql_feed(d('{"data":{"findContentFeed":{"edges":[{"cursor":"1","node":{"url":"u","title":"T","channel":{"slug":"k"}}}]}}}')).first()
    assert (gql.url, gql.title_hint, gql.keywords) == ("u", "T", ["k"])
    pay = feeds.payload_listing(d('[{"latest":1},[2],{"url":3,"title":4},"u","T"]')).first()
    assert (pay.url, pay.title_hint) == ("u", "T")
    rss = feeds.rss_items(d("<item><title><![CDATA[A & B]]></title><link>u?a=1&amp;b=2</link><category>x</category></item>")).first()
    assert (rss.url, rss.title_hint, rss.keywords) == ("u?a=1&b=2", "A & B", ["x"])
    assert feeds.flat_sitemap(d("<loc>/berita/1</loc><loc>/tag/2</loc>"), "/berita/").count() == 1
    assert feeds.html_listing(d(None)).count() == 0


def test_api_pages(spark):
    a = spark.createDataFrame([(i, "s", f"Judul {i}", None, "valid", T0, T0) for i in range(5)], "article_id long, source_id string, title string, summary string, validation_status string, published_at timestamp, collected_at timestamp")
    s = spark.createDataFrame([("s", "S")], "source_id string, display_name string")
    got = api.article_page(a, s, page=2, limit=2, search="judul").collect()
    assert [r.article_id for r in got] == [2, 1] and got[0].total == 5
    assert api.article_page(a, s, page=9, limit=2).count() == 0
    runs = spark.createDataFrame([(1, "succeeded", 72, T0), (2, "succeeded", 72, None), (3, "failed", 72, T0)], "run_id int, status string, window_hours int, finished_at timestamp")
    assert api.latest_run(runs).first().run_id == 1


def test_circuit(spark):
    rows = [("a", i, i < 2) for i in range(8)] + [("b", 1, True)] + [("c", i, False) for i in range(5)] + [("c", 6, True)] + [("d", i, i % 10 == 0) for i in range(10)]
    d = spark.createDataFrame([(s, T0 + timedelta(minutes=h), ok) for s, h, ok in rows], "source_id string, at timestamp, ok boolean")
    at = lambda minutes, **how: {r.source_id: (r.state, r.probes) for r in audit.circuit_states(d, F.col("ok"), F.lit(T0 + timedelta(minutes=minutes)), **how).collect()}
    assert at(9, in_a_row=6) == {"a": ("open", 0), "b": ("closed", None), "c": ("closed", None), "d": ("open", 0)}  # d by its error rate
    assert at(9, in_a_row=6, rate=2.0)["a"] == ("open", 0) and at(9, in_a_row=7, rate=2.0)["a"] == ("closed", None)
    assert at(22, in_a_row=6)["a"] == ("half_open", 3) and at(21, in_a_row=6)["a"] == ("open", 0)


def test_audit_rules(spark):
    cols = "article_id long, source_id string, title string, content_text string, canonical_url string, published_at timestamp, updated_at_source timestamp, collected_at timestamp, field_provenance string, author_name string, category string"
    prov = '{"title":{"source":"json_ld"}}'
    rows = [
        (1, "s", "Judul yang cukup panjang", "x" * 300 + "\n" + "y" * 300, "https://a.example/1", T0, T0, T0, prov, "A", "B"), (2, "s", "Home", "x" * 300, "oops", T0 + timedelta(hours=1), T0, T0, None, " ", None),
        (3, "s", "WARTA  uji", None, None, None, None, T0, None, None, None), (4, "s", "z" * 501, "pendek", "https://a.example/4", T0, T0 - timedelta(hours=1), T0, None, None, None),
    ]
    a = spark.createDataFrame(rows, cols)
    s = spark.createDataFrame([("s", "Warta Uji")], "source_id string, display_name string")
    got = {r.article_id: r.issues for r in audit.validation_issues(a, s).collect()}
    assert got == {1: [], 2: ["title_forbidden", "few_paragraphs", "date_in_future", "updated_before_published"], 3: ["title_forbidden", "content_missing", "date_missing"], 4: ["title_long", "content_short", "few_paragraphs", "updated_before_published"]}
    assert {r.article_id: (r.score, r.band) for r in audit.confidence(a).collect()} == {1: (100, "valid"), 2: (20, "invalid"), 3: (20, "invalid"), 4: (55, "manual_review")}


def test_baseline_is_the_median_of_the_weeks_before(spark):
    day = timedelta(days=7)
    rows = [(k * 100 + i, "s", T0 + k * day) for k, n in enumerate((4, 2, 9, 1)) for i in range(n)] + [(999, "s", T0 + timedelta(hours=1))]
    got = {r.at: (r.n, r.weeks, r.median, r.low) for r in audit.hourly_baseline(spark.createDataFrame(rows, "article_id long, source_id string, collected_at timestamp")).collect()}
    assert got == {T0: (4, 0, None, None), T0 + day: (2, 1, 4.0, False), T0 + 2 * day: (9, 2, 3.0, False), T0 + 3 * day: (1, 3, 4.0, True), T0 + timedelta(hours=1): (1, 0, None, None)}


def test_fetch_takes_what_is_stored_first(spark):
    wanted = spark.createDataFrame([("s", "https://a.example/1"), ("s", "https://a.example/2"), ("s", "https://a.example/2"), ("t", None), ("t", "ftp://x"), ("t", "https://a.example/bad")], "source_id string, url string")
    stored = spark.createDataFrame([("https://a.example/1", "<p>1</p>"), ("https://a.example/9", "x")], "url string, body string")
    shown = lambda df: {r.url: (r.http_status, r.body, r.from_cache, r.error) for r in df.collect()}
    assert shown(fetch.fetch_pages(wanted, stored)) == {"https://a.example/1": (200, "<p>1</p>", True, None)} | {u: (None, None, False, "not_stored") for u in ("https://a.example/2", None, "ftp://x", "https://a.example/bad")}

    def get(url, agent):
        if url.endswith("bad"):
            raise TimeoutError
        return 404, url + "/", f"no {agent}", "text/plain"

    live = fetch.fetch_pages(wanted, stored, live=True, delay_ms=1, get=get, by_source=2)
    assert shown(live) == {"https://a.example/1": (200, "<p>1</p>", True, None), "https://a.example/2": (404, "no lontar", False, None), None: (None, None, False, "not_http"), "ftp://x": (None, None, False, "not_http"), "https://a.example/bad": (None, None, False, "TimeoutError")}


def test_retries_and_schedules(spark):
    d = spark.createDataFrame([(0, T0), (1, T0), (2, T0), (3, T0)], "attempts_made int, failed_at timestamp")
    assert [r.retry_at for r in discovery.retries(d).orderBy("attempts_made").collect()] == [None, T0 + timedelta(seconds=5), T0 + timedelta(seconds=10), None]
    src = spark.createDataFrame([("a", True, 15), ("b", False, 15), ("c", True, 0)], "source_id string, enabled boolean, crawl_interval_minutes int")
    have = spark.createDataFrame([("b",), ("gone",)], "source_id string")
    assert {r.source_id: r.action for r in discovery.prune_schedules(have, src).collect()} == {"a": "upsert", "b": "prune", "gone": "prune"}
    assert {r.source_id: r.action for r in discovery.prune_schedules(have, src, live=True, bounded=False).collect()} == {"b": "prune", "gone": "prune"}


def test_unknown_sources_are_an_error(spark):
    known = spark.createDataFrame([("a",)], "source_id string")
    assert sites.check_known(known, known).count() == 1
    with pytest.raises(Exception, match="unknown source: b"):
        sites.check_known(spark.createDataFrame([("b",)], "source_id string"), known).collect()


def test_report_and_health_line(spark):
    st = spark.createDataFrame([("a", "stored", T0), ("a", "invalid", T0), ("b", "stored", T0 - timedelta(days=9))], "source_id string, status string, status_updated_at timestamp")
    art = spark.createDataFrame([("a", T0)], "source_id string, collected_at timestamp").select("*", *[F.lit("x").alias(f) for f in reports.OPTIONAL_FIELDS])
    found = spark.createDataFrame([("a", "u", "sitemap-news", T0), ("a", "v", "indeks", T0)], "source_id string, normalized_url string, discovery_channel string, last_discovered_at timestamp")
    md = reports.window_report(T0 - timedelta(days=1), st, art, found)
    assert "| a | 1 | 0 | 1 | 0 | 0 | 0 | 2 | 50.0% |" in md and "| a | 2 | 1 | 1 | 0 | 50.0% |" in md and "OK: 1 of 2" in md and "| b |" not in md
    assert "_(no rows)_" in reports.window_report(T0 - timedelta(days=1), st, art, found, source="zzz")
    assert reports.health_summary({"ok": False, "failures": ["no_success"], "parse_fail": 2, "terminal": 2, "success": 0}) == ("FAILED: no_success (2 of 2 finished rows failed)", 2)
    assert Health.from_env({"HEALTH_MAX_PARSE_FAIL": "3", "HEALTH_REQUIRE_STORED": "yes"}) == Health(max_parse_fail=3, require_stored=True)
    assert Clustering.from_env({"EVENT_ENABLED": "on", "EVENT_WINDOWS": "24,5"}).windows == [24]
    with pytest.raises(ValueError):
        Clustering.from_env({"EVENT_ENABLED": "maybe"})
    assert api.service_health(spark, {"x": st})["code"] == 200
    broken = st.select(F.raise_error(F.lit("x")).alias("y"))
    assert api.service_health(spark, {"x": broken})["data"]["status"] == "degraded"


def test_files_in_and_out(spark, tmp_path):
    (tmp_path / "m.xml").write_text("<urlset xmlns:news='n'><url><loc> u1 </loc><lastmod>d0</lastmod><news:news><news:publication_date>d1</news:publication_date><news:title>T</news:title></news:news></url><url><loc>u2</loc><lastmod>d2</lastmod></url></urlset>")
    got = feeds.read_sitemaps(spark, str(tmp_path / "m.xml")).collect()
    assert [(r.url, r.title_hint, r.published_hint) for r in got] == [("u1", "T", "d1"), ("u2", None, "d2")]
    for body in ('[{"article_id":1},{"article_id":2}]', '{"articles":[{"article_id":1},{"article_id":2}],"anchor":"x"}'):
        (tmp_path / "a.json").write_text(body)
        assert feeds.read_articles_json(spark, str(tmp_path / "a.json")).count() == 2
    feeds.write_json(spark.range(3), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    out = io.StringIO()
    log = logs.logger("lontar.test", logging.StreamHandler(out))
    log.info("hello", extra={"fields": {"n": 1}})
    said = json.loads(out.getvalue())
    assert (said["message"], said["n"], said["level"]) == ("hello", 1, "info")


def test_database_tables(spark):
    url = "jdbc:derby:memory:lontar;create=true"
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "id long, title string")
    tables.write_jdbc(rows, url, "articles", "overwrite")
    got = tables.read_jdbc(spark, url, "articles", "id", 4)
    assert got.rdd.getNumPartitions() == 4 and got.count() == 50 and {r.ID if hasattr(r, "ID") else r.id for r in got.where("id < 3").collect()} == {0, 1, 2}
    tables.write_jdbc(rows.limit(0), url, "articles", "overwrite")
    assert tables.read_jdbc(spark, url, "articles", "id", 4).count() == 0


def test_channels_share_a_limit(spark):
    d = spark.createDataFrame([("s", c, f"{c}{i}") for c in "ab" for i in range(5)] + [("t", "a", f"t{i}") for i in range(5)], "source_id string, discovery_channel string, normalized_url string")
    got = {r.normalized_url for r in discovery.shared_limit(d, F.lit(0), 3).collect()}
    assert got == {"a0", "a1", "b0", "b1", "t0", "t1", "t2"}


def test_feeds_build_addresses_and_page_on(spark):
    d = lambda body: spark.createDataFrame([("s", body)], "source_id string, body string")
    body = '{"data":{"findContentFeed":{"edges":[{"cursor":"1","node":{"slug":"judul","shortId":"9","title":"T","account":{"username":"akun"}}},{"cursor":"2","node":{"slug":"x"}}],"pageInfo":{"hasNextPage":true,"endCursor":"2"}}}}'
    assert [(r.url, r.title_hint) for r in feeds.graphql_feed(d(body), base_url="https://k.example/").collect()] == [("https://k.example/akun/judul-9", "T")]
    assert feeds.graphql_next(d(body)).first().cursor == "2" and feeds.graphql_next(d(body.replace("true", "false"))).first().cursor is None
    item = feeds.html_listing(d('<article><a href="/a">Satu<span class="date"><!-- 2031-03-05 07:00:00 -->baru saja</span></a></article>')).first()
    assert item.published_hint == "2031-03-05 07:00:00"


def test_site_selectors_are_used(spark):
    page = '<main><p>Bukan isi</p></main><h1>Bukan judul</h1><h1 class="detail__title">Judul</h1><div class="detail__author">A - detikNews</div><div class="detail__body-text"><strong>Jakarta</strong><p>Isi satu.</p><strong>(abc)</strong></div>'
    got = pipeline.parse_pages(spark.createDataFrame([(1, "detik", page)], "page_id long, source_id string, body string")).first()
    assert (got.title, got.author_name, got.content_text, got.page_count) == ("Judul", "A", "Jakarta - Isi satu.", 1)
    assert got.provenance["title"].source == "dom" and got.provenance["content_text"].confidence == "medium"
    locked = page + '<div class="article-paywall"></div><a href="?page=3">3</a>'
    got = pipeline.parse_page(locked, {})
    assert got["premium"] and got["provenance"]["content_text"]["confidence"] == "low" and got["page_count"] == 3
    state = pipeline.parse_page('<script>window.__STATE__ = {"x":{"article":{"published_at":"2031","content":"<p>Dari JSON</p>"}}};</script>', {"state": "__STATE__"})
    assert (state["content_text"], state["published"]) == ("Dari JSON", "2031")


def test_pipeline_ends_in_the_store(spark):
    page = '<link rel=canonical href="https://a.example/read/1/x"><h1>Judul panjang</h1><article><p>Isi</p></article>'
    rows = [(1, "https://a.example/read/1/x", 200, page), (None, "https://a.example/read/2/x", 200, page.replace("/1/", "/2/")), (3, "https://a.example/read/3/x", 503, None), (3, "oops", 200, page)]
    d = spark.createDataFrame([(i, "s", u, u, h, b, T0) for i, u, h, b in rows], "page_id long, source_id string, requested_url string, final_url string, http_status int, body string, fetched_at timestamp")
    rules = spark.createDataFrame([("s", ".", "/read/", None, "/read/(\\d+)")], "source_id string, host_pattern string, path_pattern string, not_pattern string, id_pattern string")
    out = pipeline.run_pipeline(d, rules)
    assert out.count() == 4
    none = out.select("source_id", "canonical_url", "content_hash", "title", "content_text", "parser_version", F.col("fetched_at").alias("collected_at"), F.col("fetched_at").alias("first_discovered_at"), F.lit(None).cast("array<string>").alias("validation_warnings")).limit(0)
    status = spark.createDataFrame([], "source_id string, normalized_url string, status string, reason string, article_id long, attempts int, first_seen_at timestamp, status_updated_at timestamp")
    merged, revisions, after = pipeline.store(out, none, status)
    assert merged.count() == revisions.count() == 2 and [r.validation_warnings for r in merged.collect()] == [["missing_published_at"]] * 2
    assert {(r.normalized_url, r.status) for r in after.collect()} == {("https://a.example/read/1/x", "stored"), ("https://a.example/read/2/x", "stored"), ("https://a.example/read/3/x", "retry_scheduled"), ("oops", "invalid")}
    again = pipeline.store(out, merged, after)
    assert {r.status for r in again[2].collect()} == {"duplicate", "retry_scheduled", "invalid"} and again[1].count() == 0


def test_broadcasts_are_bounded_by_rows_and_bytes(spark):
    d = spark.createDataFrame([(i, "x" * 100, ["y" * 50], None) for i in range(10)], "a long, b string, c array<string>, d binary")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(session.small_side(d)) and not hinted(session.small_side(d, 9)) and not hinted(session.small_side(d, max_bytes=1500))
    assert hinted(session.small_side(d.limit(0), 0, 0))


def test_shared_and_circular_payloads():
    deep = [[i + 1, i + 1] for i in range(30)] + ["x"]  # 2**30 paths
    x, steps = html.revive(deep), 0
    while isinstance(x, list):
        assert x[0] is x[1] or x[0] == "x"
        x, steps = x[0], steps + 1
    assert (x, steps) == ("x", 30)
    assert html.revive([{"a": 1, "n": 99, "neg": -3, "f": 0.5}, "v"]) == {"a": "v", "n": 99, "neg": -3, "f": 0.5}
    assert html.revive([]) is None


def test_reaggregation_runs_every_window(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    seen = []
    stream = jobs.stream_of(spark, f"{tmp_path}/in", spark.range(1))
    jobs.reaggregate(stream, lambda df, hours: seen.append((df.count(), hours)), lambda: spark.range(5), f"{tmp_path}/c", (24, 72)).awaitTermination()
    assert seen == [(5, 24), (5, 72)]


def test_streams(spark, tmp_path):
    rows = [("s", "u", T0), ("s", "u", T0 + timedelta(minutes=5)), ("s", "v", T0 + timedelta(hours=9))]
    d = spark.createDataFrame(rows, "source_id string, normalized_url string, seen timestamp")
    d.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = jobs.stream_of(spark, f"{tmp_path}/in", d)
    assert jobs.drain_to(jobs.first_sightings(stream, "seen", 24), f"{tmp_path}/o1", f"{tmp_path}/c1").count() == 2
    # every sighting renews what is retained; the third comes within three hours of the second, the fourth doesn't
    more = spark.createDataFrame([("s", "u", T0 + timedelta(hours=h)) for h in (0, 2, 4, 8)] + [("s", "v", T0), ("s", None, T0)], d.schema)
    more.coalesce(1).write.parquet(f"{tmp_path}/in3")
    got = jobs.drain_to(jobs.unseen(jobs.stream_of(spark, f"{tmp_path}/in3", d), "seen", 3), f"{tmp_path}/o3", f"{tmp_path}/c4")
    assert sorted((r.normalized_url or "", r.seen) for r in got.collect()) == [("", T0), ("u", T0), ("u", T0 + timedelta(hours=8)), ("v", T0)]
    more.where("seen > '2026-07-28 15:00:00'").withColumn("seen", F.col("seen") + F.expr("interval 1 hour")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in3")
    assert jobs.drain_to(jobs.unseen(jobs.stream_of(spark, f"{tmp_path}/in3", d), "seen", 3), f"{tmp_path}/o3", f"{tmp_path}/c4").count() == 4
    rate = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c5").start()
    assert jobs.stop_within(rate, 30) and not rate.isActive
    w = jobs.drain_to(jobs.windowed_counts(stream, "seen"), f"{tmp_path}/o2", f"{tmp_path}/c2").collect()
    assert [(r.source_id, r.sightings) for r in w] == [("s", 2)]
    items = d.select("source_id", F.col("normalized_url").alias("raw_url"), "normalized_url", F.lit("c").alias("discovery_channel"), F.lit("p").alias("discovery_page"), F.lit("t").alias("listing_title"), F.lit(None).cast("timestamp").alias("published_hint"), F.col("seen").alias("seen_at"))
    items.where("normalized_url = 'u'").coalesce(1).write.parquet(f"{tmp_path}/items")
    s = jobs.stream_of(spark, f"{tmp_path}/items", items, 1)
    jobs.merge_discovered(s, f"{tmp_path}/table", f"{tmp_path}/c3").awaitTermination()
    items.coalesce(1).write.mode("append").parquet(f"{tmp_path}/items")
    jobs.merge_discovered(s, f"{tmp_path}/table", f"{tmp_path}/c3").awaitTermination()
    got = {r.normalized_url: r.discovery_count for r in spark.read.parquet(f"{tmp_path}/table/version=1").collect()}
    assert got == {"u": 4, "v": 1}


def test_pairs_are_scored_in_blocks_without_shuffling_them(spark, monkeypatch):
    """Blocks of a few articles give what one block gives, and no pair is exchanged to be scored (F2-F6)."""
    rng = random.Random(9)
    words = [f"w{i:02d}x" for i in range(30)]
    rows = [(i, rng.choice("abcd"), " ".join(rng.sample(words, 6)), T0 + timedelta(minutes=rng.randrange(5000) // 60 * 60)) for i in range(90)]
    docs = clustering.prepared(articles(spark, rows)).cache()
    marks = clustering.anchors(docs).cache()
    one = clustering.scored_pairs(docs, marks)
    assert "hashpartitioning(later" not in one._jdf.queryExecution().toString()
    want = {tuple(r) for r in clustering.candidate_pairs(docs, marks).select("later", "earlier", "shared_anchors", "shared_phrases", "first_pos").collect()}
    names = ["later", "earlier", "shared_anchors", "shared_phrases", "first_pos"]
    scores = {tuple(r) for r in one.select("*").collect()}
    assert {tuple(r) for r in one.select(*names).collect()} == want and len(want) > 500
    whole = [clustering.cluster(articles(spark, rows), 200)[k].collect() for k in (1, 2)]
    monkeypatch.setattr(pairblocks, "LEAST", 5)
    monkeypatch.setattr(pairblocks, "MOST", 7)
    assert {tuple(r) for r in clustering.scored_pairs(docs, marks).select("*").collect()} == scores
    small = [clustering.cluster(articles(spark, rows), 200)[k].collect() for k in (1, 2)]
    assert [set(x) for x in small] == [set(x) for x in whole]
    assert whole[1][0].candidate_count == clustering.candidate_pairs(docs, marks).where(F.col("earlier").isin([r.id for r in whole[0] if r.id == r.seed])).count()


def test_subsequence_lengths_of_many_pairs():
    rng = random.Random(3)
    titles = ["", "a"] + ["".join(rng.choice("abc 1") for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    x, y = (g.ravel() for g in np.meshgrid(np.arange(len(titles)), np.arange(len(titles))))
    got = lcs.lcs_lengths(lcs.coded(titles), lcs.coded(titles), x, y, 1000)
    assert got.tolist() == [lcs.lcs_length(titles[i], titles[j]) for i, j in zip(x, y)]


def test_events_are_found_without_listing_pairs(spark, monkeypatch):
    """Nothing that is kept on disk has a row for each accepted pair (F3, F4)."""
    kept = []
    for m in (clustering, greedy, pairblocks):
        monkeypatch.setattr(m, "cut", lambda df: kept.append((x := session.cut(df)).count()) or x)
    rows = [(i, "abc"[i % 3], " ".join(f"w{i % 20:02d}{z}" for z in "xyzuv"), T0 + timedelta(minutes=i)) for i in range(800)]
    events, assigned, metrics = clustering.cluster(articles(spark, rows), 24)
    assert metrics.first().asDict() == {"article_count": 800, "candidate_count": 780, "accepted_edges": 780, "event_count": 20}
    assert {(r.id, r.seed) for r in assigned.collect()} == {(i, i % 20) for i in range(800)}
    assert len(kept) >= 4 and max(kept) <= 4000 < 20 * 40 * 39 // 2
    assert {r.article_count for r in events.collect()} == {40}


def test_greedy_pass_in_small_blocks(spark, monkeypatch):
    """Blocks and passes of a few articles, some of one moment, give what listed pairs give (F3, F4)."""
    rng = random.Random(4)
    words = [f"w{i:02d}x" for i in range(24)]
    rows = [(i, rng.choice("abcd"), " ".join(rng.sample(words, rng.randrange(0, 7))), T0 + timedelta(minutes=rng.randrange(6000) // 200 * 200)) for i in range(120)]
    docs = clustering.prepared(articles(spark, rows)).cache()
    pairs = clustering.scored_pairs(docs, clustering.anchors(docs)).cache()
    want = {tuple(r) for r in clustering.assign(docs, pairs).collect()}
    seeds = [i for i, s, _ in want if i == s]
    assert 20 < len(seeds) < 110
    for least, most, step in ((greedy.LEAST, greedy.MOST, greedy.PASS), (10, 30, 4), (1000, 1000, 7)):
        monkeypatch.setattr(greedy, "LEAST", least)
        monkeypatch.setattr(greedy, "MOST", most)
        monkeypatch.setattr(greedy, "PASS", step)
        _, assigned, metrics = clustering.cluster(articles(spark, rows), 200)
        assert {tuple(r) for r in assigned.collect()} == want
        assert metrics.first().candidate_count == pairs.where(F.col("earlier").isin(seeds)).count()


def test_events_and_issues_move_ids_to_articles(spark, monkeypatch):
    """No article is exchanged for the rows of events and issues, and where ids don't fit a broadcast the rows are the same (F4)."""
    rng = random.Random(6)
    words = [f"w{i:02d}x" for i in range(40)]
    rows = [(i, rng.choice("abcd"), " ".join(rng.sample(words, rng.randrange(0, 7))), T0 + timedelta(minutes=rng.randrange(2000) // 60 * 60)) for i in range(120)]
    found, assigned, _ = clustering.cluster(articles(spark, rows), 200)
    docs = clustering.prepared(articles(spark, rows)).cache()
    marks = clustering.anchors(docs).cache()
    full = articles(spark, rows).selectExpr("*", "cast(article_id as string) as canonical_url", "cast(null as timestamp) as published_at").cache()
    sources = spark.createDataFrame([(s, s.upper()) for s in "abcd"], "source_id string, display_name string")
    listed = found.select(F.lit(1).alias("run_id"), F.col("seed").alias("event_id"), "representative_title", "media_count", "article_count", "coverage_score")
    members = assigned.select(F.lit(1).alias("run_id"), F.col("seed").alias("event_id"), F.col("id").alias("article_id"), F.col("score").alias("match_score"))

    def both():
        return clustering.events(docs, marks, assigned), api.issues(spark.range(1).select(F.lit(1).alias("run_id")), listed, members, full, sources)

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events, issues = both()
        assert not re.search(r"hashpartitioning\(id#", events._jdf.queryExecution().toString())
        assert not re.search(r"hashpartitioning\(article_id#", issues._jdf.queryExecution().toString())
        want = events.collect(), issues.collect()
        assert len(want[0]) > 10 and sum(len(r.articles) for r in want[1]) == sum(r.article_count for r in want[0])
        for m in (clustering, api):
            monkeypatch.setattr(m, "small_side", lambda df, *_: session.small_side(df, 0))
        got = both()
        assert re.search(r"hashpartitioning\(article_id#", got[1]._jdf.queryExecution().toString())
        assert tuple(x.collect() for x in got) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_entries_are_exchanged_once_to_be_packed(spark, monkeypatch):
    """Entries go to their block in one exchange, and blocks are the same where words and ids don't fit a broadcast (F4)."""
    rng = random.Random(7)
    words = [f"w{i:02d}x" for i in range(30)]
    rows = [(i, "a", " ".join(rng.sample(words, 6)), T0 + timedelta(minutes=rng.randrange(3000))) for i in range(60)]
    docs = clustering.prepared(articles(spark, rows)).cache()
    marks = clustering.anchors(docs).cache()
    placed = pairblocks.placed_rows(docs).withColumn("block", (F.col("id") % 3).cast("int")).cache()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = pairblocks.packed(docs, marks, placed)
        assert not re.search(r"hashpartitioning\((owner|kind)#", once._jdf.queryExecution().toString())
        monkeypatch.setattr(pairblocks, "small_side", lambda df, *_: session.small_side(df, 0))
        more = pairblocks.packed(docs, marks, placed)
        assert re.search(r"hashpartitioning\(owner#", more._jdf.queryExecution().toString())
        blocks = [{r.block: {k: np.asarray(v).tolist() for k, v in pickle.loads(r.blob).items() if k not in ("words", "weight")} for r in x.collect()} for x in (once, more)]
        assert sorted(blocks[0]) == [0, 1, 2] and blocks[0] == blocks[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
