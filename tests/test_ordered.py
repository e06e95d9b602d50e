"""Prefix sums by ranges that are split, and the indexes and AUC that stand on them."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tabwatch.operators.evaluate import auc_evaluator, auc_rank_sum
from tabwatch.operators.ordered import PATH, prefix_sums, range_paths
from tabwatch.operators.vocabulary import apply_index, category_index, hot_slots
from tabwatch.plans import feature_queries as Q
from tabwatch.testing import duck_connect

SF = "/root/testdata/sf0.01"


@pytest.fixture
def collected(monkeypatch):
    """Rows that came to the driver, call by call."""
    seen, collect = [], DataFrame.collect

    def counting(self):
        rows = collect(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(DataFrame, "collect", counting)
    return seen


@pytest.mark.parametrize("rows, bound, width", [(0, 50, 4), (1, 50, 4), (50, 50, 4), (51, 50, 4), (3000, 50, 3), (400, 3, 20), (3000, 5000, 4)])
def test_prefix_sums_at_any_bound(spark, rows, bound, width):
    df = spark.range(rows).select((F.col("id") * 7919 % 3001).alias("k"), (F.col("id") % 5 - 2).alias("x"), F.lit("other").alias("_rows_name"))
    out = prefix_sums(df, ["k"], {"before": F.col("x"), "rank": F.lit(1)}, bound, width)
    assert out.columns == ["k", "x", "_rows_name", "before", "rank"]
    got = sorted((r.k, r.x, r.before, r["rank"]) for r in out.collect())
    total = 0
    for i, (_, x, before, rank) in enumerate(got):
        assert (before, rank) == (total, i)
        total += x
    assert len(got) == rows


def test_ranges_stay_under_the_bound_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id") % 100_003).cast("double").alias("s")).distinct()
    n = df.count()
    out = range_paths(df, ["s"], 50, 4)
    sizes = [r["count"] for r in out.groupBy(PATH).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 50
    spans = sorted((tuple(r[PATH]), r.lo, r.hi) for r in out.groupBy(PATH).agg(F.min("s").alias("lo"), F.max("s").alias("hi")).collect())
    assert max(len(p) for p, _, _ in spans) >= 3                        # several rounds
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_equal_rows_end_the_splitting(spark):
    same = spark.range(200).select(F.lit(1).alias("k"))
    assert range_paths(same, ["k"], 50, 4).count() == 200


def test_order_by_several_columns_with_nulls_and_nan(spark):
    rows = [(a, b) for a in (None, "", "a", "z", "é") for b in (None, -math.inf, -1.0, 0.0, 2.5, math.inf, math.nan)]
    df = spark.createDataFrame(rows, "a string, b double").repartition(5)
    got = {(r.a, str(r.b)): r["rank"] for r in prefix_sums(df, ["a", "b"], {"rank": F.lit(1)}, 3, 2).collect()}
    assert [got[a, str(b)] for a, b in rows] == list(range(len(rows)))


def test_auc_over_many_ranges_equals_its_oracle(spark):
    docs = Q.labeled_docs(spark, SF, nulls=False)
    want = duck_connect(SF).sql(Q.SQL_AUC_RANKED).fetchall()[0]
    for bound in (50, 7, 10**6):
        got = auc_rank_sum(docs, "quality", "n_chars", max_rows=bound).first()
        assert (round(got["auc"], 6), got["n_pos"], got["n_neg"]) == want


def test_auc_of_ties_and_infinities_at_a_small_bound(spark):
    df = spark.range(2000).select((F.col("id") % 3 == 0).cast("double").alias("label"),
                                  F.when(F.col("id") % 4 == 0, F.lit(0.0)).when(F.col("id") % 401 == 0, F.lit(math.inf)).otherwise((F.col("id") * 31 % 997).cast("double")).alias("rawPrediction"))
    assert auc_rank_sum(df, "label", "rawPrediction", max_rows=20).first()["auc"] == pytest.approx(auc_evaluator(df), abs=1e-12)


def test_index_orders_by_frequency_then_value(spark):
    values = ["b"] * 3 + ["a"] * 3 + ["é"] * 5 + ["z", None, None, "Z", ""]
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(values)], "id long, c string, d long").repartition(3)
    index = category_index(df, ["c", "d"], max_rows=2)
    got = {(r.feature, r.value): (r.idx, r.n) for r in index.collect()}
    assert [v for _, v in sorted((i, v) for (f, v), (i, _) in got.items() if f == "c")] == ["é", "a", "b", "", "Z", "z"]
    assert got["d", "0"][0] == 0 and got["c", "é"] == (0, 5)


@pytest.mark.parametrize("head", [0, 2, 100])
def test_index_applied_by_join(spark, head):
    train = spark.createDataFrame([(v,) for v in "aaabbcd"], "c string")
    df = spark.createDataFrame([(1, "a"), (2, "c"), (3, "new"), (4, None), (5, "b"), (5, "b"), (6, "d")], "_index_ long, c string")
    index = category_index(train, ["c"])
    out = apply_index(df, index, ["c"], head=head)
    assert out.columns == ["_index_", "c", "c_idx"]
    assert Counter(tuple(r) for r in out.collect()) == Counter([(1, "a", 0.0), (2, "c", 2.0), (3, "new", 4.0), (4, None, 4.0), (5, "b", 1.0), (5, "b", 1.0), (6, "d", 3.0)])
    assert apply_index(df, index, ["c"], invalid="skip", head=head).count() == 5
    with pytest.raises(Exception, match="no index for"):
        apply_index(df, index, ["c"], invalid="error", head=head).collect()
    slots = {(r["_index_"], r.slot, r.width) for r in hot_slots(df, index, "c", head=head).collect()}
    assert slots == {(1, 0, 5), (2, 2, 5), (3, 4, 5), (4, 4, 5), (5, 1, 5), (6, 3, 5)}


def test_index_equals_the_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    docs = Q.labeled_docs(spark, SF)
    both = StringIndexer(inputCols=["source", "lang"], outputCols=["x", "y"]).setHandleInvalid("keep").fit(docs).transform(docs)
    ours = apply_index(both, category_index(docs, ["source", "lang"], max_rows=3), ["source", "lang"], head=4)
    assert ours.where("x <> source_idx or y <> lang_idx").count() == 0 and ours.count() == docs.count()


def test_a_million_categories_stay_off_the_driver(spark, collected):
    n = 1_000_000
    df = spark.range(0, n + 200_000).select(F.when(F.col("id") < n, F.col("id")).otherwise(F.lit(17)).cast("string").alias("c"))
    index = category_index(df, ["c"], max_rows=300_000)
    out = apply_index(df, index, ["c"], head=1000)
    row = out.agg(F.countDistinct("c_idx").alias("d"), F.max("c_idx").alias("m"), F.count(F.when(F.col("c") == "17", F.col("c_idx") == 0)).alias("hot"),
                  F.sum(F.when(F.col("c") == "17", F.col("c_idx"))).alias("z")).first()
    assert (row["d"], row["m"], row["hot"], row["z"]) == (n, n - 1, 200_001, 0.0)
    assert max(collected) <= 2


def test_index_of_nothing(spark):
    none = spark.createDataFrame([], "c string")
    index = category_index(none, ["c"])
    assert index.count() == 0
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r.c_idx for r in apply_index(df, index, ["c"]).collect()] == [0.0, 0.0]
