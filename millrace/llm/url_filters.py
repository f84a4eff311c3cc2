"""URL block rules that reach the aliases of a page.

A rule is a host and the beginning of a path; it fits the host and all its
subdomains, and the longest fitting rule decides. Pages without a rule of their
own take part in the decision of their aliases: URLs joined by redirects and by
canonical links form connected components, a blocked member blocks the whole
component, and an explicitly allowed member lifts that from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct ``rule, verdict``; NULL if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(str(r))):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def canonical_form(url: Column) -> Column:
    """The URL without what does not change the page: scheme and letter case of the host,
    fragment, tracking parameters, closing slash."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)")), "&"
    )
    place = F.concat(host_of(url), F.regexp_replace(path_of(url), r"/+$", ""))
    return F.when(F.instr(url, "://") > 0, F.concat(place, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def _attribute(tag: Column) -> Column:
    """What ``href`` or ``content`` of a tag says, in quotes or without."""
    value = F.regexp_extract(tag, r"""(?is)\b(?:href|content)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.trim(F.replace(F.regexp_replace(value, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&")))


def declared_targets(html: Column) -> Column:
    """What a page names as its canonical form or redirects to, as written: ``<link rel=canonical>``,
    ``<meta property=og:url>`` and ``<meta http-equiv=refresh>``."""
    html = F.coalesce(html, F.lit(""))
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    asks = r"""(?is)(rel\s*=\s*["']?canonical\b|property\s*=\s*["']?og:url\b|http-equiv\s*=\s*["']?refresh\b)"""

    def target(tag: Column) -> Column:
        value = _attribute(tag)
        later = F.regexp_extract(value, r"""(?is)\burl\s*=\s*["']?([^"'\s;]+)""", 1)
        return F.when(tag.rlike(r"""(?is)http-equiv\s*=\s*["']?refresh\b"""), later).otherwise(value)

    return F.array_distinct(F.filter(F.transform(F.filter(tags, lambda t: t.rlike(asks)), target), lambda u: u != ""))


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    empty = F.array().cast("array<string>")

    def step(kept: Column, part: Column) -> Column:
        shorter = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(part == ".", kept).when(part == "..", shorter).otherwise(F.concat(kept, F.array(part)))

    return F.array_join(F.aggregate(F.split(path, "/"), empty, step), "/")


def resolved(target: Column, page: Column) -> Column:
    """A target as a whole URL, seen from the page that names it; NULL for other schemes than http and https, for a place
    within the page, and on a page without an address of its own."""
    root = F.concat(F.regexp_extract(page, r"(?s)^([^:/?#]*):", 1), F.lit("://"), host_of(page))
    folder = F.regexp_extract(path_of(page), r"(?s)^(.*/)", 1)
    url = (
        F.when(F.instr(page, "://") == 0, F.lit(None))
        .when(target.rlike(r"(?i)^https?://"), target)
        .when(target.rlike("^//"), F.concat(F.lit("http:"), target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | target.rlike("^#"), F.lit(None))
        .when(target.rlike("^/"), F.concat(root, target))
        .when(target.rlike(r"^\?"), F.concat(root, path_of(page), target))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), target))
    )
    path = path_of(url)
    dotted = F.concat(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), _without_dots(path), F.regexp_extract(url, r"(?s)(\?.*)$", 1))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), dotted).otherwise(url)


def alias_edges(pages: DataFrame, url: str, html: str, redirects: DataFrame | None) -> DataFrame:
    """``a, b``: the canonical forms of URLs that name the same page."""
    declared = pages.select(F.col(url).alias("page"), F.explode(declared_targets(F.col(html))).alias("target"))
    declared = declared.select(canonical_form(F.col("page")).alias("a"), canonical_form(resolved(F.col("target"), F.col("page"))).alias("b"))
    if redirects is None:
        return declared
    known = redirects.select(
        canonical_form(F.col("source")).alias("a"), canonical_form(resolved(F.col("target"), F.col("source"))).alias("b")
    )
    return declared.unionByName(known)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """``key, host, path, rule, verdict, alias_of`` for every row of ``pages``.

    ``redirects`` may add edges (``source, target``). Targets may be relative to the page. URLs with the same canonical
    form are one node; ``alias_of`` is the least one of the component. A URL that
    is NULL or lacks ``://`` has an empty host and path, no alias and the verdict
    allow. Repeated rows each get a row; further columns of ``pages`` are ignored.
    An empty table gives an empty result; html of any length is read whole.
    """
    nodes = stored(
        pages.select(
            F.col(key),
            host_of(F.col(url)).alias("host"),
            path_of(F.col(url)).alias("path"),
            canonical_form(F.col(url)).alias("_node"),
        ).withColumn("_own", fitting_rule(F.col("host"), F.col("path"), rules)),
        "urls",
    )
    edges = stored(alias_edges(pages, url, html, redirects), "alias-edges")  # the components read them more than once
    # Canonical forms without a declared edge are components by themselves.
    members = stored(connected_components(edges), "aliases")
    named = nodes.groupBy("_node").agg(
        F.bool_or(F.col("_own.verdict") == "block").alias("_block"),
        F.bool_or(F.col("_own.verdict") == "allow").alias("_allow"),
    )
    grouped = named.join(members.withColumnRenamed("node", "_node"), "_node", "left").withColumn(
        "_alias", F.coalesce("component", "_node")
    )
    marks = grouped.groupBy("_alias").agg(F.bool_or("_block").alias("_block"), F.bool_or("_allow").alias("_allow"))
    judged = stored(
        grouped.select("_node", "_alias").join(marks, "_alias").filter(F.col("_node").isNotNull()), "judged"
    )
    by_alias = F.when(F.col("_block") & ~F.coalesce("_allow", F.lit(False)), "block").otherwise("allow")
    # One row a URL: it grows with the input, so it is never broadcast.
    return nodes.join(judged.hint("merge"), "_node", "left").select(
        key,
        "host",
        "path",
        F.col("_own.rule").alias("rule"),
        F.coalesce(F.col("_own.verdict"), by_alias).alias("verdict"),
        F.col("_alias").alias("alias_of"),
    )
