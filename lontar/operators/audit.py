"""Audit: unprocessed URLs, channel reconciliation, validation, confidence, duplicate keys, baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lontar.functions.text import collapse_space


def unprocessed(discovered: DataFrame, status: DataFrame, now: Column | None = None, hours: int = 72) -> DataFrame:
    """Discovered URLs without a status row; with ``now``, of those first seen within the hours before it."""
    if now is not None:
        discovered = discovered.where(F.col("first_discovered_at") >= now - F.expr(f"interval {hours} hours"))
    return discovered.join(status.select("source_id", "normalized_url"), ["source_id", "normalized_url"], "left_anti")


def channel_sets(discovered: DataFrame) -> DataFrame:
    """URLs of each source by the exact set of channels that named them."""
    sets = discovered.groupBy("source_id", "normalized_url").agg(F.array_join(F.array_sort(F.collect_set("discovery_channel")), "+").alias("channels"))
    return sets.groupBy("source_id", "channels").agg(F.count("*").alias("urls"))


def coverage_proxy(discovered: DataFrame, status: DataFrame) -> DataFrame:
    """Of each source the share of discovered URLs that are stored."""
    urls = discovered.select("source_id", "normalized_url").distinct()
    stored = status.where(F.col("status") == "stored").select("source_id", "normalized_url", F.lit(1).alias("s")).distinct()
    return urls.join(stored, ["source_id", "normalized_url"], "left").groupBy("source_id").agg(F.count("*").alias("union_urls"), F.count("s").alias("stored_urls")).withColumn("coverage", F.round(F.col("stored_urls") / F.col("union_urls"), 6))


# Lengths of titles and contents, titles that are none, points and bands of the confidence score.
TITLE_LEAST, TITLE_MOST, NO_TITLES = 10, 500, ["home", "404", "access denied"]
CONTENT_LEAST, PARAGRAPHS_LEAST = 200, 2
POINTS = {"title": 20, "content": 25, "canonical": 15, "date": 20, "json_ld": 10, "author": 5, "category": 5}
CONTENT_POINTS_FROM = 500
BANDS = [(80, "valid"), (60, "valid_with_warning"), (40, "manual_review"), (0, "invalid")]


def validation_issues(articles: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(article_id, issues): what is wrong with title, content and dates; with ``sources`` also titles that are only the site's name."""
    title, content = collapse_space(F.coalesce("title", F.lit(""))), collapse_space(F.coalesce("content_text", F.lit("")))
    lines = F.size(F.filter(F.split(F.coalesce("content_text", F.lit("")), "\n"), lambda x: F.trim(x) != ""))
    names = F.lit(False)
    if sources is not None:  # as many rows as there are sources
        known = sources.select(F.col("source_id").alias("_s"), F.lower(collapse_space(F.col("display_name"))).alias("_name"))
        articles = articles.join(known, F.col("source_id") == F.col("_s"), "left")
        names = F.coalesce(F.lower(title) == F.col("_name"), F.lit(False))
    issues = [
        F.when(title == "", F.lit("title_missing")).when(F.lower(title).isin(NO_TITLES) | names, F.lit("title_forbidden")).when(F.length(title) < TITLE_LEAST, F.lit("title_short")).when(F.length(title) > TITLE_MOST, F.lit("title_long")),
        F.when(content == "", F.lit("content_missing")).when(F.length(content) < CONTENT_LEAST, F.lit("content_short")),
        F.when((content != "") & (lines < PARAGRAPHS_LEAST), F.lit("few_paragraphs")),
        F.when(F.col("published_at").isNull(), F.lit("date_missing")).when(F.col("published_at") > F.col("collected_at"), F.lit("date_in_future")),
        F.when(F.col("updated_at_source") < F.col("published_at"), F.lit("updated_before_published")),
    ]
    return articles.select("article_id", F.array_compact(F.array(*issues)).alias("issues"))


def confidence(articles: DataFrame) -> DataFrame:
    """(article_id, score, band): points for what an article has, in four bands. JSON-LD counts where the provenance of a field names it."""
    has = lambda c: F.col(c).isNotNull() & (F.trim(c) != "")
    found = {
        "title": has("title"), "content": F.length("content_text") > CONTENT_POINTS_FROM, "canonical": F.col("canonical_url").rlike("^(?i)https?://[^/?#\\s]+"), "date": F.col("published_at").isNotNull() & (F.col("published_at") <= F.col("collected_at")),
        "json_ld": F.col("field_provenance").contains("json_ld"), "author": has("author_name"), "category": has("category"),
    }
    score = sum((F.when(F.coalesce(c, F.lit(False)), POINTS[k]).otherwise(0) for k, c in found.items()), F.lit(0))
    band = F.when(F.col("score") >= BANDS[0][0], BANDS[0][1])
    for least, name in BANDS[1:]:
        band = band.when(F.col("score") >= least, name)
    return articles.select("article_id", score.cast("int").alias("score")).withColumn("band", band)


def duplicate_keys(articles: DataFrame) -> DataFrame:
    """(level, keys, articles): how many keys of each of the five levels are shared, and by how many articles; levels from URL to content."""
    known = lambda c: F.when(F.col(c) != "", F.col(c))
    levels = {"1_normalized_url": known("normalized_url"), "2_canonical_url": known("canonical_url"), "3_external_id": F.when(F.col("external_article_id") != "", F.concat_ws("|", "source_id", "external_article_id")), "4_final_url": known("final_url"), "5_content_hash": known("content_hash")}
    one = articles.select(F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.unhex(F.md5(v)).alias("h")) for k, v in levels.items()])).alias("x")).select("x.*").where("h is not null")
    return one.groupBy("level", "h").agg(F.count("*").alias("n")).where("n > 1").groupBy("level").agg(F.count("*").alias("keys"), F.sum("n").alias("articles"))


def url_aliases(articles: DataFrame) -> DataFrame:
    """(source_id, external_article_id, canonical_url, alias_of): further URLs of an article known by its external id; the first collected leads."""
    w = Window.partitionBy("source_id", "external_article_id").orderBy("collected_at", "article_id")
    rows = articles.where("external_article_id is not null").select("source_id", "external_article_id", "canonical_url", F.first("canonical_url").over(w).alias("alias_of"))
    return rows.where("canonical_url != alias_of").distinct()


def hourly_baseline(articles: DataFrame, weeks: int = 4, low: float = 0.5) -> DataFrame:
    """(source_id, at, n, weeks, median, low): articles of each hour against the median of the same weekday and hour in up to ``weeks``
    weeks before it; weeks without an article in that hour don't count. ``low`` is below that share of the median, null without one.

    What is ranked is one row for each source and hour, so a window holds as many rows as there are weeks.
    """
    hours = articles.groupBy("source_id", F.date_trunc("hour", "collected_at").alias("at")).agg(F.count("*").alias("n"))
    slot = F.unix_timestamp("at") % F.lit(7 * 86400)
    before = Window.partitionBy("source_id", slot).orderBy(F.expr("unix_timestamp(at) div 604800")).rangeBetween(-weeks, -1)
    past = F.collect_list("n").over(before)
    median = F.expr("(element_at(_p, cast(floor((size(_p) + 1) / 2) as int)) + element_at(_p, cast(ceil((size(_p) + 1) / 2) as int))) / 2.0")
    out = hours.withColumn("_p", F.array_sort(past)).withColumn("weeks", F.size("_p")).withColumn("median", F.when(F.col("weeks") > 0, median).cast("double"))
    return out.select("source_id", "at", "n", "weeks", "median", (F.col("n") < F.col("median") * low).alias("low"))


def latest_seen(discovered: DataFrame) -> DataFrame:
    """(source_id, latest): the last sighting of each source."""
    return discovered.groupBy("source_id").agg(F.max("last_discovered_at").alias("latest"))


# Failures in a row and error rate within so many minutes that open a circuit, minutes of rest, probes after it.
IN_A_ROW, ERROR_RATE, RATE_MINUTES, COOLDOWN_MINUTES, PROBES = 20, 0.70, 10, 15, 3


def circuit_states(attempts: DataFrame, ok: Column, now: Column, in_a_row: int = IN_A_ROW, rate: float = ERROR_RATE, minutes: int = RATE_MINUTES, cooldown: int = COOLDOWN_MINUTES, probes: int = PROBES) -> DataFrame:
    """(source_id, attempts, failures_in_row, error_rate, state, probes) of each source at a moment, from its attempts (source_id, at) up to it.

    A circuit opens by failures in a row, or by the error rate of the minutes before its last failure; after the cool-down from that
    failure it is half open and lets ``probes`` requests through; a success after the failure closes it. Attempts of one moment count
    as if the failures came last.
    """
    a = attempts.withColumn("_ok", ok).where(F.col("at") <= now)
    g = a.groupBy("source_id").agg(F.count("*").alias("attempts"), F.max(F.when(F.col("_ok"), F.col("at"))).alias("_good"), F.max(F.when(~F.col("_ok"), F.col("at"))).alias("_bad"))
    span = (F.col("at") > F.col("_bad") - F.expr(f"interval {minutes} minutes")) & (F.col("at") <= F.col("_bad"))
    fails = ~F.col("_ok")
    run = a.join(g.select("source_id", "_good", "_bad"), "source_id").groupBy("source_id").agg(
        F.count_if(fails & (F.col("_good").isNull() | (F.col("at") >= F.col("_good")))).alias("failures_in_row"),
        F.round(F.count_if(fails & span) / F.nullif(F.count_if(span), F.lit(0)), 6).alias("error_rate"),
    )
    tripped = (F.col("failures_in_row") >= in_a_row) | ((F.col("failures_in_row") > 0) & (F.col("error_rate") >= rate))
    state = F.when(~F.coalesce(tripped, F.lit(False)), "closed").when(now - F.expr(f"interval {cooldown} minutes") >= F.col("_bad"), "half_open").otherwise("open")
    out = g.join(run, "source_id").withColumn("state", state)
    return out.select("source_id", "attempts", "failures_in_row", "error_rate", "state", F.when(F.col("state") == "half_open", probes).when(F.col("state") == "open", 0).alias("probes"))
