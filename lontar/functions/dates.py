"""Dates of listings and pages, windows and cut-offs as column expressions."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

# Month names and short forms of Indonesian and English listings.
MONTHS = {
    "januari": 1, "februari": 2, "maret": 3, "april": 4, "mei": 5, "juni": 6, "juli": 7, "agustus": 8, "september": 9, "oktober": 10, "november": 11, "desember": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "jly": 7, "agu": 8, "ags": 8, "aug": 8, "sep": 9, "sept": 9, "okt": 10, "oct": 10, "nov": 11, "des": 12, "dec": 12,
}
ZONE = "Asia/Jakarta"


def listing_date(s: Column, zone: str = ZONE) -> Column:
    """The moment a listing names: day, month name, year and time in local time, a bare local date-time, or an ISO moment.

    Null where there is only a time, no date, or an impossible one.
    """
    t = F.lower(F.trim(s))
    words = "(\\d{1,2})\\s+([a-z]+)\\.?\\s+(\\d{4})\\D{1,12}?(\\d{1,2})[:.](\\d{2})(?:[:.](\\d{2}))?"
    month = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])[F.regexp_extract(t, words, 2)]
    n = lambda k: F.expr("0") if k is None else F.coalesce(F.regexp_extract(t, words, k).try_cast("int"), F.lit(0))
    named = F.try_make_timestamp(n(3), month, n(1), n(4), n(5), n(6), F.lit(zone))
    local = F.when(t.rlike("^\\d{4}-\\d{2}-\\d{2}[ t]\\d{2}:\\d{2}(:\\d{2})?$"), F.try_to_timestamp(F.concat(F.regexp_replace(t, "t", " "), F.when(F.length(t) == 16, F.lit(":00")).otherwise(""), F.lit("+07:00")), F.lit("yyyy-MM-dd HH:mm:ssXXX")))
    iso = F.when(t.rlike("^\\d{4}-\\d{2}-\\d{2}t.*(z|[+-]\\d{2}:?\\d{2})$"), F.upper(t).try_cast("timestamp"))
    return F.when(t.rlike(words), named).otherwise(F.coalesce(local, iso))


def slash_date(s: Column, zone: str = ZONE) -> Column:
    """D/M/YYYY with HH:mm or HH.mm, in local time."""
    p = "(\\d{1,2})/(\\d{1,2})/(\\d{4})\\D{1,5}(\\d{1,2})[:.](\\d{2})"
    g = lambda k: F.regexp_extract(s, p, k).try_cast("int")
    return F.when(s.rlike(p), F.try_make_timestamp(g(3), g(2), g(1), g(4), g(5), F.lit(0), F.lit(zone)))


def comment_date(html: Column) -> Column:
    """The text of the first HTML comment: some listings keep the moment there beside a relative label."""
    return F.nullif(F.regexp_extract(html, "<!--\\s*([^>]*?)\\s*-->", 1), F.lit(""))


def any_date(*sources: Column) -> Column:
    """The first of several texts that names a moment, in any of the forms above."""
    return F.coalesce(*[x for s in sources for x in (listing_date(s), slash_date(s))])


def iso(ts: Column) -> Column:
    """A moment as ISO text in UTC with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def cutoff(now: Column, hours: Column | float) -> Column:
    """``now`` less a number of hours, fractions allowed; null for a negative number."""
    h = hours if isinstance(hours, Column) else F.lit(float(hours))
    return F.when(h >= 0, F.timestamp_micros((F.unix_micros(now) - h * F.lit(3_600_000_000)).cast("long")))


def older_than(ts: Column, limit: Column) -> Column:
    """Strictly before the limit; a missing moment is not."""
    return F.coalesce(ts < limit, F.lit(False))


def parse_since(text: str | None, default_hours: float = 24) -> timedelta:
    """A duration like 90m, 24h, 7d or 2w; the default for none. Raises ValueError for anything else."""
    if not text:
        return timedelta(hours=default_hours)
    m = re.fullmatch(r"\s*(\d+)\s*([mhdw])\s*", text.lower())
    if not m:
        raise ValueError(f"not a duration: {text!r}")
    return timedelta(**{{"m": "minutes", "h": "hours", "d": "days", "w": "weeks"}[m[2]]: int(m[1])})


def resolve_since(option: str | None, environment: str | None, now: datetime) -> datetime:
    """Where a window begins: the option, else the environment's value, else a day before ``now``."""
    return now - parse_since(option or environment)
