"""URL filter with redirect equivalence (DataFrame functions only).

1. A rule (host, path, verdict) fits a url whose host is the rule's or below it and whose path starts
   with the rule's; the longest rule wins. Urls are expanded into (host suffix, path prefix) keys - for
   path prefixes only the lengths that occur in rules - and equi-joined with the rules, so the cost per
   url does not depend on how many rules share a host.
2. Redirects (``<meta http-equiv=refresh>``, plus an optional table of HTTP redirects) and canonical
   links (``<link rel=canonical>``) are edges between urls. A target is resolved against its page's url and
   both ends are compared in one normal form (``normal_url``). Connected components of these edges are
   aliases of one resource.
3. A url that no rule fits takes its component's decision: allowed if any alias is explicitly allowed
   (explicit allow has precedence), else blocked if any alias is blocked, else allowed. A url's own
   rule always decides for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import lower_ascii, staged
from ticklab.llm.components import connected_components


def host_path(url):
    """(host, path) columns of a url: after the first ``://`` up to / ? # or the end (A-Z lower-cased),
    then up to ? # or the end; both empty for null or a url without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def without_dots(path):
    """``path`` without its ``.`` and ``..`` segments, which never lead above the first ``/``."""
    parts = F.split(path, "/")
    up = lambda acc: F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
    kept = F.aggregate(parts, F.array().cast("array<string>"),
                       lambda acc, s: F.when(s == "..", up(acc)).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.array_join(kept, "/")).otherwise(path)


def normal_url(url):
    """The form in which urls are compared as link ends: scheme and host with A-Z lower-cased, no default port, no
    fragment, ``/`` for an empty path, no dot segments. A url without ``://`` stays as it is."""
    scheme = lower_ascii(F.regexp_extract(url, r"^[^:/?#]*", 0))
    authority = F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1)
    host = F.concat(scheme, F.lit("://"), F.regexp_extract(authority, r"^(?:.*@)?", 0), lower_ascii(F.regexp_extract(authority, r"[^@]*$", 0)))
    host = F.regexp_replace(host, r"^(http://.*):(?:80)?$|^(https://.*):(?:443)?$", "$1$2")
    rest = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*([^#]*)", 1)
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    query = F.regexp_extract(rest, r"(?s)\?.*$", 0)
    path = F.when(path == "", F.lit("/")).otherwise(without_dots(path))
    return F.when(url.rlike(r"^[^:/?#]+://"), F.concat(host, path, query)).otherwise(url)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the longest fitting rule for every distinct url of ``urls`` that has one.

    ``rules``: host, path, verdict; rules with a null part are ignored; of equal rules allow wins."""
    host, path = host_path(F.col("url"))
    rules = (rules.where("host is not null and path is not null and verdict is not null")
             .select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").groupBy("host", "path")
             .agg(F.min("verdict").alias("verdict")))  # 'allow' < 'block'
    lengths = F.array(*[F.lit(r[0]) for r in rules.select(F.length("path")).distinct().collect()] or [F.lit(-1)])  # at most one a url length
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(lengths, lambda n: (n >= 0) & (n <= F.length("p")))
    cand = staged(urls.select("url").where("url is not null").distinct().select("url", host.alias("h"), path.alias("p")), "urls")
    cand = (cand.where("h <> ''").select("url", "p", F.explode(F.array_distinct(suffixes)).alias("host"))
            .select("url", "p", "host", F.explode(fits).alias("n"))
            .select("url", "host", F.substring("p", F.lit(1), F.col("n")).alias("path")))
    hits = cand.join(rules, ["host", "path"]).select("url", F.concat("host", "path").alias("rule"), "verdict")
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict"))
    return hits.groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.verdict")


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): page url and the target of its canonical link or refresh redirect, absolute."""
    tags = F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))
    # a plain containment test keeps the tag scan off pages without links
    marked = F.lower("html")
    linked = pages.where(F.col("url").isNotNull() & (F.contains(marked, F.lit("canonical")) | F.contains(marked, F.lit("http-equiv"))))
    tag = linked.select("url", F.explode(tags).alias("tag"))
    canonical = F.when(F.col("tag").rlike(r"(?i)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"),
                       F.regexp_extract("tag", r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    refresh = F.when(F.col("tag").rlike(r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"),
                     F.regexp_extract("tag", r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    links = staged(tag.select("url", F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&")).alias("href")), "links")
    out = links.where("href <> ''").where(F.col("href").rlike("://") | ~F.col("href").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"))  # mailto: and the like
    scheme = F.substring_index("url", "://", 1)
    authority = F.regexp_extract("url", r"^[^:/?#]*://[^/?#]*", 0)
    file = F.regexp_extract("url", r"^[^?#]*", 0)
    folder = F.regexp_extract("url", r"^([^:/?#]*://[^?#]*/)[^/?#]*", 1)
    href = F.col("href")
    full = (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
            .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
            .when(F.startswith(href, F.lit("/")), F.concat(authority, href))
            .when(F.startswith(href, F.lit("#")), F.col("url"))
            .when(F.startswith(href, F.lit("?")), F.concat(file, href))
            .otherwise(F.concat(F.when(folder.rlike("://[^/]"), folder).otherwise(F.concat(authority, F.lit("/"))), href)))
    return out.select(F.col("url").alias("a"), full.alias("b"))


def url_verdicts(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, component), one row per row of ``pages`` (page_id, url, html).

    ``redirects``: optional (a, b) urls. component is the smallest normal url of the alias group, null for a
    url without links. Defined cases: a null url or one without ``://`` has empty host and path, fits no rule
    and is allowed; null html has no links; a link to the page itself, or by another scheme such as ``mailto:``,
    is none; repeated urls get the same verdict; urls of one normal form share their aliases' decision, each
    its own rule first; a link target that was never fetched still counts with its own rule; empty tables
    give empty results.
    """
    edges = link_edges(pages.select("url", "html"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select("a", "b"))
    groups = staged(connected_components(edges.select(normal_url(F.col("a")).alias("a"), normal_url(F.col("b")).alias("b"))), "aliases")
    # a target that is no page counts by its normal form
    urls = pages.select("url").unionByName(groups.select(F.col("node").alias("url")))
    ruled = staged(match_rules(urls, rules).withColumn("node", normal_url(F.col("url"))), "ruled")
    votes = (groups.join(ruled, "node").groupBy("component")
             .agg(F.min("verdict").alias("group_verdict")))  # 'allow' < 'block': explicit allow first
    alias = groups.join(votes, "component", "left").select("node", "component", "group_verdict")
    host, path = host_path(F.col("url"))
    return (pages.select("page_id", "url").join(ruled.drop("node"), "url", "left").withColumn("node", normal_url(F.col("url")))
            .join(alias, "node", "left")
            .select("page_id", host.alias("host"), path.alias("path"), "rule",
                    F.coalesce("verdict", "group_verdict", F.lit("allow")).alias("verdict"), "component"))
