"""URL functions as column expressions: normalisation, page variants, external ids, article rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Query parameters that only track.
TRACKING_PREFIX = "utm_"
TRACKING = ["fbclid", "gclid", "gclsrc", "dclid", "msclkid", "yclid", "igshid", "mc_cid", "mc_eid", "ref", "ref_src", "refsrc", "spm"]


def _without_dots(path: Column) -> Column:
    """A path without its . and .. segments."""
    parts = F.split(path, "/")
    step = lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.lit(1), F.size(acc) - 1))).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.lit(0), F.size(parts) - 1)), F.array(F.lit("")), step)
    last = F.element_at(parts, -1)
    return F.when(path.rlike("/\\.\\.?(/|$)"), F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))).otherwise(path)


def resolve(raw: Column, base: Column) -> Column:
    """A reference as an absolute URL: against the scheme, the host, the path's folder or the whole path of ``base``, by how it begins."""
    u = F.trim(raw)
    whole = F.regexp_extract(base, "^(https?://[^?#]+)", 1)
    origin = F.regexp_extract(base, "^(https?://[^/?#]+)", 1)
    folder = F.when(F.length(F.regexp_extract(base, "^https?://[^/?#]+(/[^?#]*)", 1)) > 0, F.regexp_extract(base, "^(https?://[^/?#]+[^?#]*/)", 1)).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), u)
        .when(u.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), u))
        .when(u.startswith("/"), F.concat(origin, u))
        .when(u.startswith("?"), F.concat(whole, u))
        .when(u.startswith("#") | (u == ""), F.regexp_replace(base, "#.*$", ""))
        .otherwise(F.concat(folder, u))
    )


def normalize_url(raw: Column, base: Column | None = None, keep: list[str] | None = None, extra: list[str] | None = None, trailing_slash: bool = False, force_https: bool = False) -> Column:
    """One form for URLs of a page: resolved against ``base``, scheme and host in lower case, default port, fragment and tracking
    parameters dropped, parameters sorted by name, final slash stripped (the root stays). Null where it is no absolute http(s) URL.
    """
    u = F.trim(raw)
    if base is not None:
        u = resolve(raw, base)
    ok = u.rlike("^(?i)https?://[^/?#\\s]+")
    scheme = F.lower(F.regexp_extract(u, "^([A-Za-z]+)://", 1))
    host = F.lower(F.regexp_extract(u, "^[A-Za-z]+://([^/?#]*)", 1))
    host = F.when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(F.regexp_replace(host, ":80$", ""))
    path = F.regexp_extract(u, "^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(_without_dots(path))
    if not trailing_slash:
        path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
        path = F.when(path == "", F.lit("/")).otherwise(path)
    drop = [t for t in TRACKING + (extra or []) if t not in (keep or [])]
    query = F.regexp_extract(u, "^[^?#]*\\?([^#]*)", 1)
    name = lambda p: F.lower(F.regexp_extract(p, "^([^=]*)", 1))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & (name(p).isin(keep or [""]) | ~(name(p).startswith(TRACKING_PREFIX) | name(p).isin(drop))))
    ordered = F.transform(F.array_sort(F.transform(kept, lambda p, i: F.struct(F.regexp_extract(p, "^([^=]*)", 1).alias("k"), i.alias("i"), p.alias("p")))), lambda s: s["p"])
    tail = F.when(F.size(ordered) > 0, F.concat(F.lit("?"), F.array_join(ordered, "&"))).otherwise("")
    return F.when(ok, F.concat(F.lit("https") if force_https else scheme, F.lit("://"), host, path, tail))


def without_params(url: Column, *names: str) -> Column:
    """The URL without the query parameters named; never null for a non-null URL."""
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_extract(p, "^([^=]*)", 1).isin(list(names))), "&")
    head, fragment = F.regexp_extract(url, "^([^?#]*)", 1), F.regexp_extract(url, "(#.*)$", 1)
    return F.concat(head, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""), fragment)


def without_query(url: Column) -> Column:
    """The URL up to its query and fragment."""
    return F.regexp_extract(url, "^([^?#]*)", 1)


def with_param(url: Column, name: str, value: Column) -> Column:
    """The URL with one query parameter set: page, page=all, showpage=all and the like."""
    bare = without_params(without_query_fragment(url), name)
    return F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit(f"{name}="), value.cast("string"))


def without_query_fragment(url: Column) -> Column:
    """The URL without its fragment."""
    return F.regexp_replace(url, "#.*$", "")


def index_url(base: Column, page: Column, day: Column | None = None, path: str = "indeks", step: int = 1, name: str = "page", by_date: str | None = None) -> Column:
    """An index listing's URL: by page number, or by offset with ``step`` entries a page; the day in the path, or in a parameter ``by_date``."""
    u = F.concat(F.regexp_replace(base, "/+$", ""), F.lit(f"/{path}"))
    if day is not None and by_date is None:
        u = F.concat(u, F.lit("/"), F.date_format(day, "yyyy/MM/dd"))
    if day is not None and by_date is not None:
        u = with_param(u, by_date, F.date_format(day, "yyyy-MM-dd"))
    number = page if step == 1 else (page - 1) * step
    return F.when(page > 1, with_param(u, name, number)).otherwise(u)


def sitemap_url(base: Column, name: str = "sitemap-news.xml") -> Column:
    """A site's sitemap."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit(f"/{name}"))


def segment(url: Column, n: int) -> Column:
    """The n-th path segment (from 1); null if there is none."""
    parts = F.filter(F.split(F.regexp_extract(url, "^[A-Za-z]+://[^/?#]*([^?#]*)", 1), "/"), lambda s: s != "")
    return F.get(parts, F.lit(n - 1))


def host(url: Column) -> Column:
    """The host in lower case, without its port."""
    return F.lower(F.regexp_extract(url, "^[A-Za-z]+://([^/?#:]*)", 1))


def apply_url_rules(urls: DataFrame, rules: DataFrame, source_col: str = "source_id", url_col: str = "url") -> DataFrame:
    """Adds is_article and external_id by each source's rule: host pattern, path pattern, excluded path pattern, id pattern.

    ``rules`` (source_id, host_pattern, path_pattern, not_pattern, id_pattern) has one row a source.
    A source without a rule has no articles.
    """
    r = rules.select(F.col("source_id").alias("_s"), "host_pattern", "path_pattern", "not_pattern", "id_pattern")
    path = F.regexp_extract(F.col(url_col), "^[A-Za-z]+://[^/?#]*([^#]*)", 1)
    hit = F.expr(f"regexp(`_h`, host_pattern) and regexp(`_p`, path_pattern) and not coalesce(regexp(`_p`, not_pattern), false)")
    out = urls.join(r, F.col(source_col) == F.col("_s"), "left").withColumn("_h", host(F.col(url_col))).withColumn("_p", path)
    ident = F.expr("nullif(regexp_extract(`_p`, id_pattern, 1), '')")
    return out.withColumn("is_article", F.coalesce(hit, F.lit(False))).withColumn("external_id", ident).drop("_s", "_h", "_p", "host_pattern", "path_pattern", "not_pattern", "id_pattern")
