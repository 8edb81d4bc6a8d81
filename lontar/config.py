"""Settings read from the environment, and rules derived from source profiles."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

WINDOWS = (24, 72, 168)
# Limits of the delay between fetches, in milliseconds, and the batch it is spread over.
DELAY_LEAST, DELAY_MOST, DELAY_DEFAULT, BATCH = 500, 5000, 2000, 8


def flag(value: str | None, default: bool = False) -> bool:
    """1, true, yes and on mean true, 0, false, no and off false, none the default; ValueError for anything else."""
    if value is None or value.strip() == "":
        return default
    v = value.strip().lower()
    if v not in {"1", "true", "yes", "on", "0", "false", "no", "off"}:
        raise ValueError(f"not a flag: {value}")
    return v in {"1", "true", "yes", "on"}


def whole(value: str | None, default: int) -> int:
    """A non-negative whole number, else the default."""
    return int(value) if value is not None and value.strip().isdigit() else default


def share(value: str | None, default: float) -> float:
    """A number from 0 to 1, else the default."""
    try:
        x = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return default
    return x if 0 <= x <= 1 else default


def windows(value: str | None) -> list[int]:
    """Distinct known windows of a comma-separated list, in ascending order; all known ones for none."""
    got = sorted({int(x) for x in (value or "").split(",") if x.strip().isdigit() and int(x) in WINDOWS})
    return got or list(WINDOWS)


def window(value: str | int | None, default: int = 72) -> int:
    """One window; ValueError for an unknown one."""
    n = default if value in (None, "") else int(value)
    if n not in WINDOWS:
        raise ValueError(f"window must be one of {WINDOWS}")
    return n


def limit(value: str | int | None, default: int = 50, most: int = 100) -> int:
    """A page size from 1 to ``most``; ValueError outside."""
    n = default if value in (None, "") else int(value)
    if not 1 <= n <= most:
        raise ValueError(f"limit must be from 1 to {most}")
    return n


def page(value: str | int | None) -> int:
    """A page number from 1; ValueError below."""
    n = 1 if value in (None, "") else int(value)
    if n < 1:
        raise ValueError("page must be 1 or more")
    return n


@dataclass
class Clustering:
    """Settings of the event clustering."""

    enabled: bool = False
    dry_run: bool = True
    windows: list[int] = field(default_factory=lambda: list(WINDOWS))
    interval_minutes: int = 15
    max_articles: int | None = None
    jaccard: float = 0.35
    phrase_jaccard: float = 0.22
    sequence: float = 0.72
    hours_apart: int = 36

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Clustering:
        e = os.environ if env is None else env
        return cls(flag(e.get("EVENT_ENABLED")), flag(e.get("EVENT_DRY_RUN"), True), windows(e.get("EVENT_WINDOWS")), whole(e.get("EVENT_INTERVAL_MINUTES"), 15))


@dataclass
class Health:
    """Thresholds of the health rules."""

    max_parse_fail: int | None = None
    fail_ratio: float = 0.5
    min_total: int = 5
    require_stored: bool = False
    min_discoveries: int = 0

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Health:
        e = os.environ if env is None else env
        cap = e.get("HEALTH_MAX_PARSE_FAIL")
        return cls(whole(cap, 0) if cap else None, share(e.get("HEALTH_FAIL_RATIO"), 0.5), whole(e.get("HEALTH_MIN_TOTAL"), 5), flag(e.get("HEALTH_REQUIRE_STORED")), whole(e.get("HEALTH_MIN_DISCOVERIES"), 0))


def fetch_delay(interval_minutes: Column, restricted: Column | None = None) -> Column:
    """Milliseconds between fetches: the interval spread over a batch, within limits; restricted sources wait the longest."""
    derived = F.greatest(F.lit(DELAY_LEAST), F.least(F.lit(DELAY_MOST), F.round(interval_minutes * 60_000 / BATCH))).cast("int")
    out = F.when(interval_minutes > 0, derived).otherwise(DELAY_DEFAULT)
    return out if restricted is None else F.when(restricted & (interval_minutes > 0), F.greatest(out, F.lit(DELAY_MOST))).otherwise(out)
