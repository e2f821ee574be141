"""Connected components of a link table by alternating large and small stars.

Every step is joins and groupings with a map-side minimum; the links of a step
are written to the shared folder, so that a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.durable import written
from marquee.skew import hottest, salted_join

MANY_LINKS = 500


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """Each link with ``m`` of its ``u``; the links of a node with very many are spread over tasks."""
    hot = hottest(least, ["u"], "links", MANY_LINKS)
    least = least.drop("links")
    return links.join(least, "u") if hot.isEmpty() else salted_join(links, least, ["u"], hot, how="inner")


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node around it."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links")).select("u", F.least("u", "m").alias("m"), "links")
    out = _with_least(both, least).filter(F.col("v") > F.col("u"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))
    own = least.select("u", F.col("m").alias("v"))
    out = _with_least(down, least).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.filter("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) to (node, component): the least node reachable.  Only nodes with a link
    to another node are listed; NULL ends and self links count as none."""
    now = written(links.select("u", "v").filter("u <> v").distinct(), "links")
    seen = _fingerprint(now)
    while True:
        now = written(_small_star(_large_star(now)), "links")
        if (after := _fingerprint(now)) == seen:
            break
        seen = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
