"""URL filters over redirect equivalence.

A page is an alias of the pages it forwards to (``meta`` refresh) and of the one it
names as canonical. Aliases are connected components over these links, found by
distributed star contraction on numbered URLs. Rules block or allow a host with
its subdomains below a path, the longest fitting rule wins. A page without a rule
of its own is blocked if a rule blocks any alias and none of them is allowed by a
rule: an explicit allow takes precedence.

URLs are nodes without scheme and fragment. Rules meet (host, path) pairs, not
pages, through the parent domains of a host; a host with a third of the pages is
one such pair per path. Only URLs that a link names are numbered.

Defined results: a NULL URL, or one without ``://``, has an empty host and path,
no rule and no aliases, and is allowed; a NULL page has no links; rows that
repeat a URL get the same verdict; no rules allow everything; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import ascii_lower
from kindred.llm.components import roots
from kindred.sources.scratch import Scratch

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def rest_of(url: Column) -> Column:
    """What stands behind the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def node_of(rest: Column) -> Column:
    """A URL without scheme and fragment; NULL where there is no host."""
    node = F.concat(host_of(rest), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))
    return F.when(host_of(rest) != "", node)


def targets(html: Column, rest: Column) -> Column:
    """The URLs a page forwards to or names as canonical, completed by the page's own."""
    found = F.filter(
        F.array(
            F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
            F.regexp_extract(F.regexp_extract(html, REFRESH, 0), TARGET, 1),
        ),
        lambda t: t != "",
    )
    folder = F.regexp_replace(path_of(rest), r"[^/]*$", "")
    return F.transform(
        found,
        lambda t: F.when(t.contains("://"), t)
        .when(t.startswith("//"), F.concat(F.lit("http:"), t))
        .when(t.startswith("/"), F.concat(F.lit("http://"), host_of(rest), t))
        .otherwise(F.concat(F.lit("http://"), host_of(rest), F.when(folder == "", F.lit("/")).otherwise(folder), t)),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table: rule_host, rule_path, rule_verdict."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def judge(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of every distinct (host, path) that has one: ``rule`` and ``own`` verdict."""
    parts = F.split("host", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    met = places.select("host", "path").distinct().select("host", "path", F.explode(parents).alias("rule_host")).join(rules, "rule_host")
    rule = F.concat("rule_host", "rule_path")
    fits = met.filter(F.col("path").startswith(F.col("rule_path"))).groupBy("host", "path")
    best = fits.agg(F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), F.col("rule_verdict").alias("own"))).alias("b"))
    return best.select("host", "path", "b.rule", "b.own")


def aliases(pages: DataFrame, scratch: Scratch, url: str = "url", html: str = "html") -> DataFrame:
    """``node``, ``host``, ``path`` and ``component`` of every URL that a link joins to another."""
    rest = rest_of(F.col(url))
    linked = pages.filter(F.col(html).rlike(r"(?i)canonical|http-equiv")).select(rest.alias("rest"), F.explode(targets(F.col(html), rest)).alias("to"))
    split = lambda r, side: [node_of(r).alias(f"n{side}"), host_of(r).alias(f"h{side}"), path_of(r).alias(f"p{side}")]
    edges = linked.select(*split(F.col("rest"), 1), *split(rest_of(F.col("to")), 2)).filter("n1 <> n2").distinct()
    edges = scratch.save(edges, "edges")
    ends = edges.select(F.inline(F.array(*[F.struct(F.col(f"n{i}").alias("node"), F.col(f"h{i}").alias("host"), F.col(f"p{i}").alias("path")) for i in (1, 2)])))
    # Numbered once and written, so the numbers stay when a task is repeated.
    nodes = scratch.save(ends.distinct().withColumn("number", F.monotonically_increasing_id()), "nodes")
    of = lambda n, c: nodes.select(F.col("node").alias(n), F.col("number").alias(c))
    links = edges.join(of("n1", "x"), "n1").join(of("n2", "y"), "n2").select("x", "y")
    stars = roots(links, scratch).withColumnRenamed("node", "number")
    return nodes.join(stars, "number", "left").select("node", "host", "path", F.coalesce("root", "number").alias("component"))


def verdicts(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and whether an alias blocked it."""
    scratch = Scratch(pages.sparkSession, "urls")
    joined = aliases(pages, scratch, url, html)
    ruled = joined.join(judge(joined, rules), ["host", "path"], "left")
    told = ruled.groupBy("component").agg(F.bool_or(F.col("own") == "block").alias("blocked"), F.bool_or(F.col("own") == "allow").alias("allowed"))
    blocked = told.filter(F.col("blocked") & ~F.coalesce("allowed", F.lit(False))).select("component")
    spread = ruled.join(blocked, "component").select(F.col("node"), F.lit(True).alias("alias_blocked"))
    rest = rest_of(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), rest.alias("rest")).select(
        "page_id", host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path"), node_of(F.col("rest")).alias("node")
    )
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    done = rows.join(judge(rows, rules), ["host", "path"], "left").join(spread, "node", "left")
    by_alias = F.coalesce("alias_blocked", F.lit(False))
    verdict = F.coalesce("own", F.when(by_alias, F.lit("block")).otherwise(F.lit("allow")))
    return done.select("page_id", "host", "path", "rule", verdict.alias("verdict"), (F.col("own").isNull() & by_alias).alias("blocked_by_alias"))
