"""Driver-table access and the stand-in columns used by the registered queries.

Stand-ins (all derived by Spark from the given tables, whole tables kept):
numeric features = l_quantity, l_extendedprice, l_discount, l_tax;
baseline / new = l_shipdate before / from 1996-01-01;
missing values = every row whose l_orderkey is a multiple of 7 has its
numeric features (and its return flag) set to null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUM_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CUTOFF = "1996-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cutoff_col() -> F.Column:
    return F.lit(CUTOFF).cast("timestamp_ntz")


def lineitem_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_shipdate") < cutoff_col())


def lineitem_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_shipdate") >= cutoff_col())


def with_nulls(df: DataFrame, cols=NUM_FEATURES, key: str = "l_orderkey") -> DataFrame:
    """Null-inject: rows whose key is a multiple of 7 lose the listed columns."""
    hole = (F.col(key) % 7) == 0
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(~hole, F.col(c)))
    return out


# SQL spellings of the same derivations for the DuckDB oracle.
SQL_CUTOFF = f"TIMESTAMP '{CUTOFF}'"


def sql_nulls(col: str, key: str = "l_orderkey") -> str:
    return f"CASE WHEN {key} % 7 <> 0 THEN {col} END"
