from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lontar import config
from lontar.functions import dates, html, text, urls
from lontar.functions.lcs import lcs_ratio_of


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_tokens_fold_and_drop_stopwords(spark):
    assert one(spark, text.tokens(F.lit("Menteri Ékonomi DAN 12 abc-def ke itu"))) == ["menteri", "ekonomi", "abc", "def"]
    assert one(spark, text.tokens(F.lit(None).cast("string"))) == []
    assert one(spark, text.bigrams(F.array(F.lit("a"), F.lit("b"), F.lit("a"), F.lit("b")))) == ["a b", "b a"]
    assert one(spark, text.bigrams(F.array(F.lit("a")))) == []


def test_hashes(spark):
    import hashlib

    assert one(spark, text.content_hash(F.lit(" a   b"), F.lit(None).cast("string"))) == hashlib.sha256(b"a b\n").hexdigest()
    assert one(spark, text.query_hash(F.lit("query {a}"))) == hashlib.sha256(b"query {a}").hexdigest()
    assert one(spark, text.masked_connection(F.lit("postgres://u:p@h/d"))) == "postgres://u:***@h/d"
    assert one(spark, text.job_id(F.lit("a"), F.lit(""), F.lit("b"))) == hashlib.sha1(b"a|b").hexdigest()


def test_lists(spark):
    assert one(spark, text.keyword_list(F.lit("Satu, dua ,SATU,, tiga"))) == ["Satu", "dua", "tiga"]
    assert one(spark, text.author_line(F.array(F.lit(" A "), F.lit("a"), F.lit("B")))) == "A, B"
    assert one(spark, text.without_trailing_hashtags(F.lit("isi #satu #dua_2"))) == "isi"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("HTTPS://WWW.Example.COM:443/a/b/?utm_source=x&b=2&a=1#top", "https://www.example.com/a/b?a=1&b=2"),
        ("http://example.com:80", "http://example.com/"),
        ("https://example.com/?fbclid=1", "https://example.com/"),
        ("not a url", None),
        ("", None),
    ],
)
def test_normalize_url(spark, raw, want):
    assert one(spark, urls.normalize_url(F.lit(raw))) == want


def test_url_parts(spark):
    assert one(spark, urls.normalize_url(F.lit("/a?x=1"), F.lit("https://s.example/z"))) == "https://s.example/a?x=1"
    base = "https://s.example/z/y?k=1#f"
    for raw, want in (("b", "z/b"), ("./b/../c", "z/c"), ("../../b", "b"), ("?q=2", "z/y?q=2"), ("//t.example/x", None), ("..", "")):
        assert one(spark, urls.normalize_url(F.lit(raw), F.lit(base))) == ("https://t.example/x" if want is None else f"https://s.example/{want}")
    assert one(spark, urls.index_url(F.lit("https://a/"), F.lit(3))) == "https://a/indeks?page=3" and one(spark, urls.index_url(F.lit("https://a"), F.lit(1))) == "https://a/indeks"
    assert one(spark, urls.index_url(F.lit("https://a"), F.lit(3), F.lit("2031-03-05").cast("date"), "kanal", 20, "offset", "date")) == "https://a/kanal?date=2031-03-05&offset=40"
    assert one(spark, urls.index_url(F.lit("https://a"), F.lit(2), F.lit("2031-03-05").cast("date"))) == "https://a/indeks/2031/03/05?page=2" and one(spark, urls.sitemap_url(F.lit("https://a/"))) == "https://a/sitemap-news.xml"
    assert one(spark, urls.without_params(F.lit("https://a/b?page=2&x=1"), "page")) == "https://a/b?x=1"
    assert one(spark, urls.with_param(F.lit("https://a/b?x=1#f"), "page", F.lit("all"))) == "https://a/b?x=1&page=all"
    assert one(spark, urls.segment(F.lit("https://a/b/c"), 2)) == "c"
    assert one(spark, urls.segment(F.lit("https://a/b/c"), 3)) is None


@pytest.mark.parametrize(
    "shown, want",
    [
        ("Rabu, 5 Mar 2031 21:05 WIB", "2031-03-05T14:05:00"),
        ("Jum'at, 7 Maret 2031 | 09:41 WIB", "2031-03-07T02:41:00"),
        ("17 November 2030 | 00.15 WIB", "2030-11-16T17:15:00"),
        ("2031-03-07T09:41:13+07:00", "2031-03-07T02:41:13"),
        ("2031-03-07 09:41:13", "2031-03-07T02:41:13"),
        ("21:05", None),
        ("31 Februari 2031 10:00", None),
    ],
)
def test_listing_dates(spark, shown, want):
    got = one(spark, F.date_format(dates.listing_date(F.lit(shown)), "yyyy-MM-dd'T'HH:mm:ss"))
    assert got == want


def test_windows_and_cutoffs(spark):
    now = datetime(2031, 3, 5, tzinfo=timezone.utc)
    assert dates.parse_since("90m") == timedelta(minutes=90) and dates.parse_since(None) == timedelta(hours=24)
    with pytest.raises(ValueError):
        dates.parse_since("soon")
    assert dates.resolve_since(None, "7d", now) == now - timedelta(days=7)
    assert one(spark, dates.older_than(F.lit(None).cast("timestamp"), F.lit(now))) is False
    assert one(spark, dates.older_than(F.lit(now), F.lit(now))) is False
    assert one(spark, dates.cutoff(F.lit(now), -1)) is None


def test_settings(spark):
    assert config.windows("24,72,72,168,5") == [24, 72, 168] and config.window(None) == 72
    assert config.flag("Yes") and not config.flag("off") and config.flag("", True)
    with pytest.raises(ValueError):
        config.flag("perhaps")
    with pytest.raises(ValueError):
        config.window(25)
    with pytest.raises(ValueError):
        config.limit(0)
    got = spark.createDataFrame([(15, False), (60, True), (0, False)], "m int, r boolean").select(config.fetch_delay(F.col("m"), F.col("r")).alias("d"))
    assert [r.d for r in got.collect()] == [5000, 5000, 2000]


def test_lcs():
    assert lcs_ratio_of("abcd", "abcd") == 1 and lcs_ratio_of("", "a") == 0 and lcs_ratio_of("abcbdab", "bdcaba") == pytest.approx(8 / 13)


def test_selection_and_embedded_json():
    root = html.parse('<div class="a b"><p id=x>Satu<p>Dua <b>tiga</b></div><script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"H"}]}</script><script type="application/ld+json">{bad</script>')
    assert [n.text() for n in html.select(root, "div.a > p, #y")] == ["Satu", "Dua tiga"]
    assert html.typed(html.json_ld(root), "article")["headline"] == "H"
    assert html.revive([{"latest": 1}, [2], {"title": 3, "self": 0}, "T"]) == {"latest": [{"title": "T", "self": None}]}
    assert html.data_layer("dataLayer.push({'penulis': 'A', 'x': 'y'})") == {"penulis": "A", "x": "y"}


def test_paragraphs_drop_noise_and_split_at_breaks():
    root = html.parse("<div class=b><p>Baca Juga: x</p><p>Isi</p><aside><p>Iklan</p></aside></div><div class=c>satu<br>dua</div>")
    assert html.paragraphs(root, ".b", "aside") == ["Isi"]
    assert html.paragraphs(root, ".c") == ["satu", "dua"]


def test_numbered_containers_are_one_document():
    root = html.parse('<aside><p>x</p></aside><div class=b data-page=2><p>dua</p><aside><p>x</p></aside></div><div class=b data-page=1><strong>Kota</strong><p>satu</p></div>')
    assert html.paragraphs(root, ".b", "aside") == ["Kota - satu", "dua"]
