"""Histograms over a profile's edges (all bins kept, zeros filled).

Bins are assigned with a binary-search expression over the profile's
literal cut points (codegen, log2(bins) compares per value), on the wide
rows, before one narrow unpivot to ``(feature, bin)`` and a map-side
combined count: the shuffle is at most features x bins rows per task.  A
profile has one row per column of the data, so its cuts fit in the plan
whenever the data's columns do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.search import count_le_sql, quoted, sql_double


def bin_grid(profile: DataFrame, bins_col: str = "bins") -> DataFrame:
    """Every ``(feature, bin)`` of the profile, so empty bins show as 0."""
    return profile.select("feature", F.explode(F.sequence(F.lit(0), F.col(bins_col) - 1)).alias("bin"))


def _zero_fill(grid: DataFrame, counts: DataFrame) -> DataFrame:
    return (grid.join(counts, ["feature", "bin"], "left")
                .select("feature", "bin", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def _binned(df: DataFrame, edges: list[tuple[str, list[float]]], ids: list[str],
            bin_sql: Callable[[str, list[float]], str]) -> DataFrame:
    """``(*ids, feature, bin)`` of the non-null values of the listed columns."""
    present = [(f, e) for f, e in edges if f in df.columns]
    if not present:
        none = [F.lit(None).cast("string").alias("feature"), F.lit(None).cast("int").alias("bin")]
        return df.select(*ids, *none).where(F.lit(False))
    sel = []
    for f, e in present:
        x = f"CAST({quoted(f)} AS DOUBLE)"
        sel.append(F.expr(f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL ELSE {bin_sql(x, e)} END")
                   .cast("int").alias(f))
    return (df.select(*ids, *sel).unpivot(ids, [f for f, _ in present], "feature", "bin")
              .where(F.col("bin").isNotNull()))


def binned(df: DataFrame, profile: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """``(*ids, feature, bin)``: one row per non-null feature value of the wide
    ``df`` with its open-ended bin.  Stateless, so it also runs on streams."""
    rows = profile.select("feature", "cuts").collect()      # one row per feature
    return _binned(df, [(r["feature"], r["cuts"]) for r in rows], list(ids or []), count_le_sql)


def histogram_open(df: DataFrame, profile: DataFrame, zero_fill: bool = True) -> DataFrame:
    """``(feature, bin, n)`` counts of ``df``'s non-null values per open-ended bin.

    ``df`` is wide (the features are columns); features missing from ``df``
    get zero counts.
    """
    counts = binned(df, profile).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    return _zero_fill(bin_grid(profile), counts) if zero_fill else counts


def _closed_sql(x: str, edges: list[float]) -> str:
    return (f"CASE WHEN {x} >= {sql_double(edges[0])} AND {x} <= {sql_double(edges[-1])} "
            f"THEN {count_le_sql(x, edges[:-1])} - 1 ELSE -1 END")


def histogram_closed(df: DataFrame, edges: DataFrame, edges_col: str = "edges",
                     keep_outside: bool = False) -> DataFrame:
    """``(feature, bin, n)`` for closed-range edges; out-of-range values dropped.

    ``df`` is wide; ``edges`` is ``(feature, edges)`` with B+1 non-decreasing
    edges.  Bins are [e_i, e_i+1) except the last, [e_B-1, e_B]; duplicate
    edges keep their (empty) bins.  With ``keep_outside`` bin -1 counts the
    values outside the range, so the same pass gives the sample total.  One
    scan and one aggregation either way.
    """
    rows = edges.select("feature", F.col(edges_col).alias("e")).collect()      # one row per feature
    closed = [(r["feature"], [float(x) for x in r["e"]]) for r in rows]
    counts = _binned(df, closed, [], _closed_sql).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    first = F.lit(-1 if keep_outside else 0)
    grid = edges.select("feature", F.explode(F.sequence(first, F.size(edges_col) - 2)).alias("bin"))
    return _zero_fill(grid, counts)
