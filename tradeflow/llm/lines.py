"""Lines that are boilerplate of their site go.

A line's share is the number of a host's pages that contain it over the number of
the host's pages. Lines are counted as 128-bit hashes, once per page, with partial
sums before the shuffle, so neither a hot host nor a hot line meets in one task.
What comes back is one row per host: its flagged lines. A page holds a bounded
number of lines, so a host has at most (lines per page / share) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradeflow.llm.common import key128
from tradeflow.session import pin

SHARE = 0.1
MIN_PAGES = 2  # a line of one page is no frame
TRIM = "\t\n\x0b\x0c\r "


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(TRIM))


def _host(host: str) -> Column:
    """A null host is a host of its own, apart from any text."""
    return F.coalesce(F.concat(F.lit("h"), F.col(f"`{host}`").cast("string")), F.lit("n"))


def boilerplate(
    pages: DataFrame, host: str, text: str, share: float = SHARE, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``_host`` and ``_lines``, the hashes of its lines that more than ``share`` of
    its pages, and at least ``min_pages``, contain."""
    pages = pages.select(_host(host).alias("_host"), F.col(f"`{text}`").alias("_text"))
    totals = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    lines = F.array_distinct(F.transform(F.split("_text", "\n"), _trim))
    counts = (
        pages.select("_host", F.explode(lines).alias("_line"))
        .filter("_line != ''")
        .select("_host", *key128(F.col("_line")))
        .groupBy("_host", "_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_pages)
    )
    often = counts.join(totals, "_host").filter(F.col("_n") > F.lit(share) * F.col("_pages"))
    return often.groupBy("_host").agg(F.collect_list(F.struct("_h1", "_h2")).alias("_lines"))


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    share: float = SHARE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, and ``n_lines`` and
    ``n_dropped``.

    Lines are parted by ``\\n`` and compared without white space at their ends;
    blank lines are neither counted nor dropped. Boilerplate frames a text: a page
    of nothing but such lines is a copy of other pages and stays whole, for
    deduplication to judge. A null text stays null and has no lines; each row is a
    page, also where ids repeat; pages of a null host form a host. Columns of
    ``pages`` named like the two new ones are replaced.
    """
    # As a table its size is known when the join is planned: Spark broadcasts it if
    # it is small, and the texts are not shuffled; if it is large, both sides are,
    # and a hot host is split.
    flagged = pin(boilerplate(pages, host, text, share, min_pages), "boilerplate")
    keep = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    carried = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in keep if c != text])
    rows = pages.select(carried.alias("_row"), F.col(f"`{text}`").alias("_text"), _host(host).alias("_host"))
    lines = F.split("_text", "\n")

    def stays(line: Column) -> Column:
        key = F.struct(*key128(_trim(line)))
        return ~F.array_contains(F.col("_lines"), key) | (_trim(line) == "")

    kept = F.when(F.col("_lines").isNull(), lines).otherwise(F.filter(lines, stays))
    rows = rows.join(flagged, "_host", "left").withColumn("_kept", kept)
    rest = F.exists("_kept", lambda line: _trim(line) != "")
    rows = rows.withColumn("_kept", F.when(rest, F.col("_kept")).otherwise(lines))
    dropped = F.coalesce(F.size(lines) - F.size("_kept"), F.lit(0)).cast("bigint")
    whole = F.when(dropped == 0, F.col("_text")).otherwise(F.array_join("_kept", "\n"))
    return rows.select(
        *[whole.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in keep],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        dropped.alias("n_dropped"),
    )
