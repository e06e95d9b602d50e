"""Category indexes as tables: any number of categories, none of them on the driver.

Index 0 is a column's most frequent value, equal ones in ascending order: the
dense rank is a running count over the ordered value table (``ordered``).  An
index is applied by join.  Its head, the most frequent values by construction,
is broadcast up to a fixed number of rows, so no value that many rows share is ever a
shuffle key; only rows of rarer values are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.operators.ordered import MAX_ROWS, prefix_sums
from tabwatch.session import materialize

HEAD = 100_000              # rows of an index that are broadcast


def category_index(df: DataFrame, columns: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """``(feature string, value string, n bigint, idx bigint)`` of every value of the columns, as
    text; null is no value.  One scan of ``df`` for all columns."""
    named = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    counts = (named.unpivot([], list(columns), "feature", "value").where(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = materialize(prefix_sums(counts.withColumn("_less", -F.col("n")), ["feature", "_less", "value"], {"_rank": F.lit(1)}, max_rows), "index-ranks")
    first = ranked.groupBy("feature").agg(F.min("_rank").alias("_first"))       # a row per column
    out = ranked.join(F.broadcast(first), "feature").select("feature", "value", "n", (F.col("_rank") - F.col("_first")).alias("idx"))
    return materialize(out, "index")


def index_sizes(index: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of categories of each column (one row per column is collected)."""
    found = {r["feature"]: int(r["size"]) for r in index.groupBy("feature").agg(F.count(F.lit(1)).alias("size")).collect()}
    return {c: found.get(c, 0) for c in columns}


def apply_index(df: DataFrame, index: DataFrame, columns: Sequence[str], suffix: str = "_idx", invalid: str = "keep",
                head: int = HEAD, sizes: dict[str, int] | None = None) -> DataFrame:
    """``df`` with ``<column><suffix>`` (double).  A null or unseen value gets the extra
    index after all others (``keep``), stops the job (``error``) or loses the row (``skip``)."""
    if invalid not in ("keep", "error", "skip"):
        raise ValueError(f"unknown way with values that have no index: {invalid!r}")
    sizes = sizes or index_sizes(index, columns)
    kept = list(df.columns)
    for c in columns:
        own = index.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("idx").cast("double").alias("_index"))
        text = F.col(c).cast("string")
        df = df.join(F.broadcast(own.where(F.col("_index") < head)), text == F.col("_value"), "left").drop("_value")
        if sizes[c] > head:
            df = materialize(df, "index-head")
            open_ = F.col("_index").isNull() & F.col(c).isNotNull()
            tail = own.where(F.col("_index") >= head)
            rest = df.where(open_).drop("_index").join(tail, text == F.col("_value"), "left").drop("_value")
            df = df.where(~open_).unionByName(rest)
        name = c + suffix
        if invalid == "skip":
            df = df.where(F.col("_index").isNotNull())
        other = _no_index(c) if invalid == "error" else F.lit(float(sizes[c]))
        kept.append(name)
        df = df.withColumn(name, F.coalesce("_index", other)).drop("_index").select(*kept)
    return df


def _no_index(c: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"column {c}: no index for "), F.coalesce(F.col(c).cast("string"), F.lit("null")))).cast("double")


def hot_slots(df: DataFrame, index: DataFrame, column: str, slot: str = "slot", width: str = "width", head: int = HEAD) -> DataFrame:
    """``df`` with the one-hot position of ``column`` and the number of slots: the
    last slot is that of null and unseen values."""
    sizes = index_sizes(index, [column])
    out = apply_index(df, index, [column], "__slot", "keep", head, sizes)
    return (out.withColumn(slot, F.col(f"{column}__slot").cast("int")).drop(f"{column}__slot")
            .withColumn(width, F.lit(sizes[column] + 1)))
