"""URL rules, and a blocked Bloom filter in front of an exact join with a list.

Only DataFrame functions. The filter has one 512-bit block per hash range, kept
as a row of eight bigints; a listed URL sets one bit in each. Its number of blocks
follows the list up to ``MAX_BLOCKS``, so what is broadcast never exceeds 8 MiB of
bits. A longer list lets more URLs through to the join, which alone decides: the
verdicts do not depend on the filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradeflow.llm.common import ascii_lower, power_of_two

MAX_BLOCKS = 1 << 17
KEYS_PER_BLOCK = 32
WORDS = 8
TRACKING = r"&(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*"

Rule = tuple[str, str, str]  # host, path, verdict


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without closing slashes, and the query
    without tracking parameters. Null where the URL is null or has no host."""
    host = F.regexp_replace(url_host(url), r"^(www|m)\.", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.concat(F.lit("&"), query), TRACKING, "")
    kept = F.regexp_replace(kept, "^&+", "")
    tail = F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept))
    return F.when(host != "", F.concat(host, path, tail))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls.

    A rule fits its host and all subdomains where the path starts with its path.
    """
    text = verdict = F.lit(None).cast("string")
    for h, p, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def _bit(i: int) -> Column:
    at = F.shiftright("_bits", 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def _hashed(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.withColumns(
        {
            "_block": F.pmod(F.xxhash64("_url"), F.lit(blocks)).cast("int"),
            "_bits": F.xxhash64(F.lit("bits"), "_url"),
        }
    )


def bloom_blocks(listed: DataFrame) -> tuple[DataFrame, int]:
    """The filter of the column ``_url``: at most ``MAX_BLOCKS`` rows."""
    n = listed.agg(F.approx_count_distinct("_url")).first()[0]
    blocks = min(MAX_BLOCKS, 1 << power_of_two(n / KEYS_PER_BLOCK))
    words = [F.bit_or(_bit(i)).alias(f"_w{i}") for i in range(WORDS)]
    return _hashed(listed, blocks).groupBy("_block").agg(*words), blocks


def maybe_listed(rows: DataFrame, blooms: DataFrame, blocks: int) -> DataFrame:
    """Adds ``_maybe``: true for every listed ``_url`` and for a few others."""
    probed = _hashed(rows, blocks).join(F.broadcast(blooms), "_block", "left")
    hits = [F.col(f"_w{i}").bitwiseAND(_bit(i)) == _bit(i) for i in range(WORDS)]
    hit = F.coalesce(reduce(lambda a, b: a & b, hits), F.lit(False))
    return probed.withColumn("_maybe", hit).drop(
        "_block", "_bits", *[f"_w{i}" for i in range(WORDS)]
    )


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``.

    ``listed`` holds URLs in the column ``url``; they and the pages' are compared
    in canonical form. The longest rule that fits decides; without one, a listed
    URL is blocked and any other allowed. A null URL, or one without ``://``, has
    an empty host and path, fits no rule and is allowed. Repeated rows stay; an
    empty list or table gives what is left. Columns of ``pages`` named like a new
    one are replaced.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "listed", "verdict")]
    given = F.col(f"`{url}`").cast("string")
    carried = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in keep])
    rows = pages.select(
        carried.alias("_row"), given.alias("_given"), url_host(given).alias("host"), url_path(given).alias("path")
    )
    text, decision = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": text, "_decision": decision})
    rows = rows.withColumn("_url", F.when(F.col("rule").isNull(), canonical_url(F.col("_given"))))
    known = listed.select(canonical_url(F.col(f"`{url}`")).alias("_url")).filter("_url IS NOT NULL")
    blooms, blocks = bloom_blocks(known)
    probed = maybe_listed(rows, blooms, blocks)
    exact = known.distinct().withColumn("listed", F.lit(True))
    hits = probed.filter("_maybe").join(exact, "_url", "left")
    rest = probed.filter("NOT _maybe").withColumn("listed", F.lit(False))
    both = hits.unionByName(rest).withColumn("listed", F.coalesce("listed", F.lit(False)))
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(F.col("_decision"), method)
    return both.select(
        *[F.col("_row").getField(c).alias(c) for c in keep], "host", "path", "rule", "listed", verdict.alias("verdict")
    )
