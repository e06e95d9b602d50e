import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.functions.binning import bin_closed, bin_open
from tabwatch.functions.levels import quantile_levels
from tabwatch.functions.scalars import collapse_category, mem_to_mb, null_if_token
from tabwatch.functions.search import count_le_sql


def test_levels_match_numpy_grids():
    assert quantile_levels(10, "linspace") == list(np.linspace(0, 1, 11))
    pct = np.linspace(0, 100, 11) / 100
    assert quantile_levels(10, "percent") == list(pct)
    assert quantile_levels(10, "exact")[3] == 0.3
    assert quantile_levels(10, "linspace")[3] == 0.30000000000000004


def test_mem_to_mb(spark):
    rows = [("2g",), ("4096m",), ("2.5g",), ("1024",), ("512k",), ("N/A",), (None,), ("2G",), ("x g",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r["mb"] for r in df.select(mem_to_mb(F.col("s")).alias("mb")).collect()]
    assert got == [2048, 4096, 2560, 1024, -1, -1, -1, 2048, -1]


def test_collapse_null_and_other_spellings(spark):
    df = spark.createDataFrame([("male",), ("Male",), (None,), ("female",)], "s string")
    got = [r[0] for r in df.select(collapse_category(F.col("s"), "male", "female")).collect()]
    assert got == ["male", "female", "female", "female"]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("x",), ("",)], "s string")
    got = [r[0] for r in df.select(null_if_token(F.col("s"))).collect()]
    assert got == [None, None, "x", None]


def test_bin_open_edges(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (2.0,), (9.0,), (-9.0,)], "v double")
    got = [r[0] for r in df.select(bin_open(F.col("v"), F.array(F.lit(1.0), F.lit(2.0)))).collect()]
    # a value on an inner edge goes right
    assert got == [0, 1, 1, 2, 2, 0]


def test_bin_closed_drops_out_of_range_and_keeps_last_edge(spark):
    edges = F.array(*[F.lit(x) for x in (0.0, 0.0, 1.0, 2.0)])
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (2.0,), (2.5,)], "v double")
    got = [r[0] for r in df.select(bin_closed(F.col("v"), edges)).collect()]
    assert got == [None, 1, 1, 2, 2, None]


@pytest.mark.parametrize("cuts", [[], [1.0], [1.0, 1.0, 2.0], [0.5 * i for i in range(37)]])
def test_count_le_tree_matches_linear_count(spark, cuts):
    vals = [-1.0, 0.0, 0.5, 1.0, 1.2, 2.0, 7.25, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(F.expr(count_le_sql("v", sorted(cuts)))).collect()]
    assert got == [sum(1 for c in cuts if c <= v) for v in vals]
