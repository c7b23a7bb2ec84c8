"""URL filter with redirect equivalence, in DataFrame functions only.

Every url gets the longest rule that fits it: a rule (host, path) fits its host
and all subdomains of it, if the url's path starts with the rule's path.  Urls
that lead to each other (canonical links and refresh redirects in the pages,
and a table of observed redirects if there is one) are aliases: connected
components over these edges, as distributed rounds.  An alias without a rule of
its own is blocked if a member of its component is blocked by a rule and none
is explicitly allowed by one; otherwise it is allowed.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; the path follows up to ``?``, ``#`` or the end.  A null url, or
one without ``://``, has an empty host and path and no aliases.  Two urls with
the same host and path are the same node.  Null html has no links; a link that
cannot be resolved is no edge.  Repeated rows come back repeatedly; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .graph import components

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.  Rules are a
    stated list and part of the plan: one expression, no join."""
    def fits(rule: str) -> Column:
        own, slash, rest = rule.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)

    ordered = sorted(rules, key=lambda x: (-len(x[1]), x[1]))
    rule = F.coalesce(*[F.when(fits(r), F.lit(r)) for _, r in ordered], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(fits(r), F.lit(v)) for v, r in ordered], F.lit(None).cast("string"))
    return rule, verdict


def linked_urls(html: Column, url: Column) -> Column:
    """Array of absolute urls of canonical links and refresh redirects."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), 1),
                    lambda t: t.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b|^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    raw = F.transform(tags, lambda t: F.when(
        t.rlike(r"(?i)^<link"), F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)).otherwise(
        F.regexp_extract(t, r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*[\"']?([^\"'\s>]+)", 1)))
    base = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    whole = F.transform(raw, lambda u: F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), u)
                        .when(u.startswith("//"), F.concat(scheme, u))
                        .when(u.startswith("/"), F.concat(base, u))
                        .when(u.rlike(r"^[?#]"), url)
                        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), u)))
    return F.filter(whole, lambda u: u.contains("://"))


def _node(host: Column, path: Column) -> Column:
    return F.when(host != "", F.xxhash64(host, path))


def url_verdicts(pages: DataFrame, key: str = "page_id", rules=RULES, default: str = "allow",
                 redirects: DataFrame | None = None) -> DataFrame:
    """(key, host, path, rule, verdict) of every page.  ``redirects`` may give
    observed redirects as (from_url, to_url)."""
    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = (pages.select(F.col(key).cast("long").alias(key), host.alias("host"), path.alias("path"))
              .withColumns({"rule": rule, "explicit": verdict, "node": _node(F.col("host"), F.col("path"))}))
    links = (pages.select(url.alias("from_url"), F.explode(linked_urls(F.col("html").cast("string"), url)).alias("to_url")))
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string")))
    ends = stored(links.where(F.col("from_url").contains("://") & F.col("to_url").contains("://")).distinct())
    sides = {s: (host_of(F.col(f"{s}_url")), path_of(F.col(f"{s}_url"))) for s in ("from", "to")}
    edges = ends.select(_node(*sides["from"]).alias("a"), _node(*sides["to"]).alias("b"))
    comp = stored(components(edges))
    said = None
    for s in ("from", "to"):
        own = ends.select(_node(*sides[s]).alias("node"), rule_for(*sides[s], rules)[1].alias("explicit"))
        said = own if said is None else said.unionByName(own)
    said = said.where("explicit is not null and node is not null").distinct()
    decided = stored(
        comp.join(said, "node").groupBy("component").agg(
            F.max(F.col("explicit") == "block").alias("blocked"), F.max(F.col("explicit") == "allow").alias("allowed"))
        .where("blocked and not allowed").select("component"))
    blocked = comp.join(decided, "component", "left_semi").select(F.col("node").alias("alias"))
    return judged.join(blocked, judged["node"] == blocked["alias"], "left").select(
        key, "host", "path", "rule",
        F.coalesce("explicit", F.when(F.col("alias").isNotNull(), F.lit("block")), F.lit(default)).alias("verdict"))
