"""Window reports and health rules over the stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lontar.config import Health

OPTIONAL_FIELDS = ["published_at", "subtitle", "author_name", "category", "tags", "thumbnail_url", "updated_at_source", "summary", "content_html", "language", "external_article_id", "field_provenance", "validation_warnings"]
STATUSES = ["discovered", "queued", "fetching", "retry_scheduled", "fetched", "parsed", "valid", "stored", "duplicate", "invalid", "blocked", "ignored_by_policy", "dead_letter"]


def within(df: DataFrame, column: str, since: datetime | None, source: str | None = None) -> DataFrame:
    """Rows from ``since`` on, and of one source, where these are given."""
    df = df if since is None else df.where(F.col(column) >= F.lit(since))
    return df if source is None else df.where(F.col("source_id") == source)


def funnel(status: DataFrame, since: datetime | None = None, source: str | None = None) -> DataFrame:
    """Rows of each source by outcome."""
    s = F.col("status")
    named = ["stored", "duplicate", "invalid", "dead_letter", "blocked", "ignored_by_policy"]
    return within(status, "status_updated_at", since, source).groupBy("source_id").agg(
        F.count_if(s == "stored").alias("stored"), F.count_if(s == "duplicate").alias("duplicate"), F.count_if(s.isin("invalid", "dead_letter")).alias("parse_fail"), F.count_if(s == "blocked").alias("blocked"),
        F.count_if(s == "ignored_by_policy").alias("ignored_by_policy"), F.count_if(~s.isin(named)).alias("in_progress_or_other"), F.count("*").alias("total"),
    )


def is_filled(df: DataFrame, name: str) -> Column:
    """Whether an optional field holds something, by its type."""
    kind = dict(df.dtypes)[name]
    c = F.col(name)
    if kind.startswith("array") or kind.startswith("map"):
        return c.isNotNull() & (F.size(c) > 0)
    if kind == "string":
        return c.isNotNull() & (c != "") & (~c.isin("{}", "[]") if name in {"field_provenance", "validation_warnings", "tags"} else F.lit(True))
    return c.isNotNull()


def field_fill(articles: DataFrame, since: datetime | None = None, source: str | None = None) -> DataFrame:
    """Articles of each source, and how many have each optional field."""
    rows = within(articles, "collected_at", since, source)
    return rows.groupBy("source_id").agg(F.count("*").alias("total"), *[F.count_if(is_filled(rows, f)).alias(f"{f}_filled") for f in OPTIONAL_FIELDS])


def only_in_sitemap(discovered: DataFrame, since: datetime | None = None, source: str | None = None) -> DataFrame:
    """URLs of each source by whether sitemaps, other channels or both have named them."""
    rows = within(discovered, "last_discovered_at", since, source)
    sitemap = F.lower("discovery_channel").startswith("sitemap")
    pages = rows.groupBy("source_id", "normalized_url").agg(F.bool_or(sitemap).alias("s"), F.bool_or(~sitemap).alias("o"))
    return pages.groupBy("source_id").agg(F.count("*").alias("total_urls"), F.count_if("s").alias("in_sitemap"), F.count_if(F.col("s") & ~F.col("o")).alias("only_in_sitemap"), F.count_if(F.col("s") & F.col("o")).alias("in_both"))


def ratio(part: Column, of: Column) -> Column:
    """A share, null where the whole is zero or null."""
    return F.try_divide(part.cast("double"), of.cast("double"))


def percent(part: Column, of: Column) -> Column:
    """A share as text with one decimal, n/a where there is none."""
    return F.coalesce(F.format_string("%.1f%%", ratio(part, of) * 100), F.lit("n/a"))


def totals(counts: DataFrame, *columns: str) -> DataFrame:
    """Sums over all sources; null counts as zero, no row gives zeros."""
    return counts.agg(*[F.coalesce(F.sum(F.coalesce(c, F.lit(0))), F.lit(0)).alias(c) for c in columns])


def health(funnel_counts: DataFrame, discovered: DataFrame | None = None, t: Health | None = None) -> DataFrame:
    """One row: ok, the failed rules and what they were judged by. ``discovered`` has total_urls by source."""
    t = t or Health()
    one = totals(funnel_counts, "stored", "duplicate", "parse_fail")
    if discovered is None:
        one = one.withColumn("discovered", F.lit(0).cast("long"))
    else:
        one = one.withColumn("k", F.lit(1)).join(totals(discovered, "total_urls").select(F.col("total_urls").alias("discovered"), F.lit(1).alias("k")), "k").drop("k")
    one = one.withColumn("success", F.col("stored") + F.col("duplicate")).withColumn("terminal", F.col("success") + F.col("parse_fail"))
    fail, success = F.col("parse_fail"), F.col("success")
    rules = [
        F.when(F.lit(t.max_parse_fail is not None) & (fail > F.lit(t.max_parse_fail or 0)), F.lit("parse_fail_count")),
        F.when((F.col("terminal") >= t.min_total) & (F.coalesce(ratio(fail, F.col("terminal")), F.lit(0.0)) >= t.fail_ratio), F.lit("parse_fail_ratio")),
        F.when((success == 0) & (fail > 0), F.lit("no_success")),
        F.when(F.lit(t.require_stored) & (success == 0), F.lit("nothing_stored")),
        F.when(F.lit(t.min_discoveries > 0) & (F.col("discovered") >= t.min_discoveries) & (success == 0), F.lit("discovered_without_success")),
    ]
    out = one.withColumn("failures", F.array_compact(F.array(*rules)))
    return out.withColumn("ok", F.size("failures") == 0)


def health_summary(row: dict) -> tuple[str, int]:
    """A line about the result of ``health`` and an exit code: 0, or 2 where a rule failed."""
    if row["ok"]:
        return f"OK: {row['success']} of {row['terminal']} finished rows succeeded", 0
    return f"FAILED: {', '.join(row['failures'])} ({row['parse_fail']} of {row['terminal']} finished rows failed)", 2


def markdown(title: str, table: DataFrame, most: int = 1000) -> str:
    """A small table as Markdown; a table of over ``most`` rows is refused."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows")
    if not rows:
        return f"## {title}\n\n| " + " | ".join(table.columns) + " |\n|" + " - |" * len(table.columns) + "\n\n_(no rows)_\n"
    lines = [f"## {title}", "", "| " + " | ".join(table.columns) + " |", "|" + " - |" * len(table.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def window_report(since: datetime, status: DataFrame, articles: DataFrame, discovered: DataFrame, source: str | None = None, t: Health | None = None, now: datetime | None = None) -> str:
    """The report of a window as Markdown: what it covers, funnel with totals and success shares, field fill in percent, sitemap
    reconciliation, and the health rules. Its tables have a row for each source; each is one aggregate."""
    counts, fill, maps = funnel(status, since, source), field_fill(articles, since, source), only_in_sitemap(discovered, since, source)
    head = [f"# Crawl report since {since.isoformat()}", ""] + ([f"Generated {now.isoformat()}", ""] if now else []) + ([f"Source: {source}", ""] if source else [])
    order = lambda df: df.orderBy("source_id")
    shares = order(counts).withColumn("success", percent(F.col("stored") + F.col("duplicate"), F.col("stored") + F.col("duplicate") + F.col("parse_fail")))
    filled = order(fill).select("source_id", "total", *[percent(F.col(f"{f}_filled"), F.col("total")).alias(f) for f in OPTIONAL_FIELDS])
    sitemaps = order(maps).withColumn("only_in_sitemap_share", percent(F.col("only_in_sitemap"), F.col("total_urls")))
    whole = totals(counts, "stored", "duplicate", "parse_fail", "blocked", "ignored_by_policy", "in_progress_or_other", "total")
    line, _ = health_summary(health(counts, maps, t).first().asDict())
    parts = [("Funnel", shares), ("All sources", whole), ("Field fill", filled), ("Sitemap reconciliation", sitemaps)]
    return "\n".join(head) + "\n" + "\n".join(markdown(title, df) for title, df in parts) + f"\n## Health\n\n{line}\n"
