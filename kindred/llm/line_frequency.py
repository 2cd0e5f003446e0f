"""Boilerplate lines: those that a large share of a site's pages contain.

For every (site, line) the pages containing the line are counted and divided by
the pages of the site; lines above the ratio are dropped from all pages of that
site. Lines travel as hashes of 96 bits, counts are combined before the shuffle,
and the lines of a hot site are joined with the few lines to drop, a join that
AQE broadcasts by measured size or splits where a site owns much of the rows.

Defined results: a NULL site is a site of its own; a NULL text is a page without
lines and stays NULL; a line without a word is never dropped; a line repeated on
a page counts once for it; repeated rows are pages of their own, or with
``copies_once`` the copies of a text within a site are one page; a site with fewer
than ``min_pages`` pages loses nothing. A page may end up empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import null_safe_join, row_key

#: Share of a site's pages above which a line is boilerplate, and pages it must be on at least: one page
#: of a small site is above any ratio, and two may be a chance repeat.
MAX_RATIO = 0.05
MIN_PAGES = 3

KEY = ["_host", "_id", "_row"]


def _hashes(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.hash(line).alias("h2"))


def page_lines(pages: DataFrame) -> DataFrame:
    """Every distinct line with a word of every page, hashed: _host, _id, _row, h1, h2."""
    lines = F.array_distinct(F.split("_text", "\n"))
    return (
        pages.select(*KEY, F.explode(lines).alias("_line"))
        .filter(F.col("_line").rlike(r"[^\x20\x09-\x0D]"))
        .select(*KEY, _hashes(F.col("_line")).alias("_h"))
        .select(*KEY, "_h.h1", "_h.h2")
    )


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """Lines to drop: _host, h1, h2, the pages containing it, and the pages of the site."""
    count = F.count_distinct("_row") if copies_once else F.count(F.lit(1))
    containing = page_lines(pages).groupBy("_host", "h1", "h2").agg(count.alias("pages_with_line"))
    containing = containing.filter(F.col("pages_with_line") >= min_pages)
    totals = pages.groupBy("_host").agg(count.alias("pages_of_site"))
    totals = totals.withColumnRenamed("_host", "_of")
    rows = containing.join(totals, F.col("_host").eqNullSafe(F.col("_of"))).drop("_of")
    return rows.filter(F.col("pages_with_line") > F.lit(max_ratio) * F.col("pages_of_site"))


def drop_boilerplate(
    docs: DataFrame,
    host: str,
    doc_id: str = "doc_id",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """``_doc`` (the row as it came), ``clean_text``, ``n_lines``, ``n_dropped``."""
    pages = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(host).alias("_host"),
        F.col(doc_id).alias("_id"),
        F.col(text).alias("_text"),
        row_key(F.col(text)).alias("_row"),
    )
    slim = pages.select("_host", "_id", "_row", "_text")
    to_drop = boilerplate(slim, max_ratio, min_pages, copies_once).select(F.col("_host").alias("_of"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    lines = page_lines(slim)
    hit = lines.join(
        to_drop, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2"))
    )
    # A set per page, at most as long as the page.
    per_page = hit.groupBy(*KEY).agg(F.collect_set(F.struct("h1", "h2")).alias("_bad"))
    out = null_safe_join(pages, per_page, KEY, "left")
    lines = F.split("_text", "\n")
    kept = F.when(F.col("_bad").isNull(), lines).otherwise(
        F.filter(lines, lambda line: ~(line.rlike(r"[^\x20\x09-\x0D]") & F.array_contains("_bad", _hashes(line))))
    )
    return (
        out.select("_doc", "_text", "_bad", kept.alias("_kept"))
        .select(
            "_doc",
            F.when(F.col("_bad").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n")).alias("clean_text"),
            F.coalesce(F.size(F.split("_text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
            F.when(F.col("_text").isNull(), 0).otherwise(F.size(F.split("_text", "\n")) - F.size("_kept")).cast("long").alias("n_dropped"),
        )
    )


def stage(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents with the remaining lines as text, and their new length where they carry one.

    Copies are one page here, so that a large group of them keeps its text for the stages behind.
    """
    done = drop_boilerplate(docs, host, **({"copies_once": True} | limits))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("clean_text").alias(c))
        elif c == "n_chars":
            out.append(F.length("clean_text").cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"_doc.`{c}`").alias(c))
    return done.select(*out)
