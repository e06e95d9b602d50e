"""Connected components of a table of links, by alternating stars.

Each round replaces every link by links to the smallest neighbour; the links
become one star per component in a number of rounds that grows with the logarithm of
the longest path.  Links stay in tables; the driver sees one row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import stored


def _towards_greater(links: DataFrame) -> DataFrame:
    """Links of every node's greater neighbours to its smallest."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _towards_smaller(links: DataFrame) -> DataFrame:
    """Links of every node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    own = least.select("u", F.col("m").alias("v"))
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link.

    ``links`` are rows (u, v) of longs in either direction; loops, repeats and nulls
    count for nothing."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    links = stored(links, "links")
    state = None
    while True:
        new = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
        links = stored(_towards_smaller(_towards_greater(links)), "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
