"""Text functions as column expressions: folding, tokens, bigrams, hashes, author and keyword lists."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Indonesian words that carry no subject, and words too general to anchor an event.
STOPWORDS = (
    "yang dan di ke dari untuk dengan ini itu dalam pada juga akan telah adalah sebagai oleh karena tidak lebih menjadi dapat agar atau para seorang sebuah saat setelah sebelum tentang terhadap antara melalui masih sudah bisa ada jadi berita video foto hari tahun bulan ujar kata menurut terkait kasus"
).split()
GENERIC_ANCHORS = (
    "polisi pemerintah media berita kasus pihak orang warga hasil korban pejabat resmi nasional negara acara kota dunia viral perang tarif presiden menteri timnas indonesia korupsi tangkap ditangkap menangkap pemeriksaan periksa panggil ditetapkan dugaan"
).split()

#: White space of the web: the regular classes, no-break and zero-width no-break space.
WEB_SPACE = "[\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+"
_ACCENTED = "".join(chr(c) for c in range(0xC0, 0x250) if unicodedata.normalize("NFKD", chr(c))[0].isascii() and unicodedata.normalize("NFKD", chr(c))[0].isalpha() and len(unicodedata.normalize("NFKD", chr(c))) == 2)
_PLAIN = "".join(unicodedata.normalize("NFKD", c)[0] for c in _ACCENTED)


def fold(s: Column) -> Column:
    """Lower case without accents, JVM-side: Latin letters with one mark become the bare letter, loose marks go. Null counts as ''."""
    plain = F.translate(F.coalesce(s, F.lit("")), _ACCENTED, _PLAIN)
    return F.lower(F.regexp_replace(plain, "[\\u0300-\\u036f]", ""))


def tokens(s: Column) -> Column:
    """Words of three letters or digits and more that aren't stopwords, in order, repeats kept."""
    words = F.split(F.trim(F.regexp_replace(fold(s), "[^a-z0-9]+", " ")), " ")
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(STOPWORDS))


def bigrams(words: Column) -> Column:
    """Distinct neighbouring pairs of a word list, in order; none under two words."""
    n = F.size(words)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))
    return F.when(n >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def collapse_space(s: Column) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(s, WEB_SPACE, " "))


def content_hash(title: Column, content: Column) -> Column:
    """SHA-256 over collapsed title, line feed and collapsed content; null counts as ''."""
    parts = [collapse_space(F.coalesce(c, F.lit(""))) for c in (title, content)]
    return F.sha2(F.concat(parts[0], F.lit("\n"), parts[1]), 256)


def job_id(*parts: Column) -> Column:
    """SHA-1 over the non-empty parts joined by '|': the deduplication key of queued work."""
    return F.sha1(F.array_join(F.filter(F.array(*[p.cast("string") for p in parts]), lambda p: p.isNotNull() & (p != "")), "|"))


def query_hash(query: Column) -> Column:
    """SHA-256 of a GraphQL query's text: by it a server knows a persisted query."""
    return F.sha2(query, 256)


def presence(s: Column) -> Column:
    """Empty strings become null, as in optional fields at store time."""
    return F.nullif(s, F.lit(""))


def keyword_list(csv: Column, junk: list[str] | None = None) -> Column:
    """Comma-separated keywords, trimmed, empty and junk ones left out, first of equals (case ignored) kept."""
    items = F.filter(F.transform(F.split(csv, ","), lambda x: F.trim(x)), lambda x: (x != "") & (~F.lower(x).isin(junk or [""]) if junk else F.lit(True)))
    return unique_ignoring_case(items)


def unique_ignoring_case(items: Column) -> Column:
    """Order-preserving unique: the first of entries that are equal but for case."""
    lower = F.transform(items, lambda x: F.lower(x))
    return F.filter(items, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def author_line(names: Column) -> Column:
    """Author names, trimmed and unique but for case, joined by commas; null if none."""
    return presence(F.array_join(unique_ignoring_case(F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x != "")), ", "))


def without_trailing_hashtags(s: Column) -> Column:
    """A text without the hashtags at its end."""
    return F.regexp_replace(s, "(\\s*#[\\p{L}\\p{N}_]+)+\\s*$", "")


def masked_connection(s: Column) -> Column:
    """A connection string whose password is hidden."""
    return F.regexp_replace(s, "://([^:/@]+):([^@]+)@", "://$1:***@")
