"""Running sums over a whole table in an order, with no task holding more than
a bounded share of it.

The rows are range-partitioned by the order.  A range above the bound is
split again, and what that gives again if need be, each time with the ranges
found so far as the first part of the order; every range ends up with a path of numbers
that sorts as the order does.  A range's offset is the running sum of the ranges'
totals, which is the same problem on a table smaller by the bound and is
solved the same way.  Inside a range a window makes the sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.session import materialize

MAX_ROWS = 1_000_000        # rows that one task sorts
WIDTH = 2000                # ranges of a round: the driver samples 100 keys for each
PATH = "_path"


def range_paths(df: DataFrame, order: Sequence[str], max_rows: int = MAX_ROWS, width: int = WIDTH, rows: int | None = None, path: str = PATH) -> DataFrame:
    """``df`` with the path of its range (``array<int>``); no range has more than
    ``max_rows`` rows.  Rows must differ in ``order``: equal ones stay in one range."""
    rest = df.withColumn(path, F.array().cast("array<int>"))
    n, ranges, done, key = df.count() if rows is None else rows, 1, [], F.struct(*order)
    while True:
        parts = max(2 * ranges, min(width, -(-4 * n // (3 * max_rows))))        # two for each range: the largest is split
        cut = materialize(rest.repartitionByRange(parts, path, *order).withColumn(path, F.concat(path, F.array(F.spark_partition_id()))), "ranges")
        sizes = cut.groupBy(path).agg(F.count(F.lit(1)).alias("_rows"), F.min(key).alias("_lo"), F.max(key).alias("_hi"))
        over = materialize(sizes.where((F.col("_rows") > max_rows) & ~F.col("_lo").eqNullSafe(F.col("_hi"))).select(path, "_rows"), "ranges-over")
        n, ranges = over.agg(F.sum("_rows"), F.count(F.lit(1))).first()
        if not ranges:
            return reduce(DataFrame.unionByName, [*done, cut])
        done.append(cut.join(over.select(path), path, "left_anti"))
        rest = cut.join(over.select(path), path, "left_semi")


def prefix_sums(df: DataFrame, order: Sequence[str], sums: dict[str, Column], max_rows: int = MAX_ROWS, width: int = WIDTH) -> DataFrame:
    """``df`` with, under each name, the sum of the expression over all rows that come
    before in ascending ``order`` (nulls first, NaN last); 0 for the first row.

    Rows must differ in ``order``.  Expressions are whole numbers: sums are exact.  An empty table stays
    empty.  Up to ``max_rows`` rows (two at least) are one task's work."""
    return _prefix_sums(df, list(order), sums, max(2, max_rows), width, 0)


def _prefix_sums(df: DataFrame, order: list[str], sums: dict[str, Column], max_rows: int, width: int, depth: int) -> DataFrame:
    own, path = {name: f"_sum{depth}_{i}" for i, name in enumerate(sums)}, f"{PATH}{depth}"
    ahead = {name: f"_ahead{depth}_{i}" for i, name in enumerate(sums)}
    df = materialize(df.withColumns({own[name]: expr.cast("bigint") for name, expr in sums.items()}), "ordered")
    kept = [c for c in df.columns if c not in own.values()] + list(sums)
    before = lambda part, c: F.coalesce(F.sum(c).over(Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = df.count()
    if n <= max_rows:
        return df.withColumns({name: before(F.lit(0), c) for name, c in own.items()}).select(*kept)
    ranged = range_paths(df, order, max_rows, width, n, path)
    totals = ranged.groupBy(path).agg(*(F.sum(c).alias(c) for c in own.values()))
    offsets = _prefix_sums(totals, [path], {ahead[name]: F.col(c) for name, c in own.items()}, max_rows, width, depth + 1).select(path, *ahead.values())
    out = ranged.join(materialize(offsets, "ranges-offsets"), path)
    return out.withColumns({name: F.col(ahead[name]) + before(path, c) for name, c in own.items()}).select(*kept)
