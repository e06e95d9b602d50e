"""Numbered changes with several writers; run maps; exact element quantiles; the sample's bound."""

import math
import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch import jobs
from tabwatch.operators.quantiles import element_quantile, median_element
from tabwatch.operators.runlog import run_map, run_wide
from tabwatch.operators.sampling import sample_exact_n
from tabwatch.sources import changes

COLS = "who string, change bigint"


def test_two_writers_get_every_number_once(spark, tmp_path):
    versions, each = str(tmp_path / "versions"), 20

    def work(who):
        return [jobs.add_version(spark, versions, "model", f"{who}{i}", f"/m/{who}{i}") for i in range(each)]

    with ThreadPoolExecutor(2) as pool:
        got = [v for found in pool.map(work, "ab") for v in found]
    assert sorted(map(int, got)) == list(range(1, 2 * each + 1))
    now = jobs.read_versions(spark, versions).collect()
    assert Counter(r.stage for r in now) == {"Production": 1, "Archived": 2 * each - 1} and len({r.run_id for r in now}) == 2 * each
    assert [r.version for r in now if r.stage == "Production"] == [str(2 * each)]
    assert not [f for f in os.listdir(versions) if f.startswith("_staged")]


@pytest.mark.parametrize("scheme", ["", "file:", "viewed"])
def test_a_taken_number_is_tried_again(spark, tmp_path, scheme, monkeypatch):
    """Another writer takes the number between reading and writing; names with blanks and signs."""
    path, calls = str(tmp_path / "a b%é"), []
    if scheme == "file:":
        path = "file:" + path
    if scheme == "viewed":               # the way of other file systems
        monkeypatch.setattr(changes.os, "rename", None)
        hadoop = changes._hadoop

        class Other:
            def __init__(self, fs):
                self.fs = fs

            def getScheme(self):
                return "other"

            def __getattr__(self, name):
                return getattr(self.fs, name)

        monkeypatch.setattr(changes, "_hadoop", lambda spark, p: (lambda jvm, conf, fs, q: (jvm, conf, Other(fs), q))(*hadoop(spark, p)))

    def rows(who, meddle):
        def after(state, n):
            calls.append((who, n, state.count()))
            if meddle and len(calls) == 2:
                changes.append_change(spark, path, COLS, rows("other", False))
            return spark.createDataFrame([(who,)], "who string")
        return after

    assert changes.append_change(spark, path, COLS, rows("first", False)) == 1
    assert changes.append_change(spark, path, COLS, rows("mine", True)) == 3
    assert calls == [("first", 1, 0), ("mine", 2, 1), ("other", 2, 1), ("mine", 3, 2)]
    assert {tuple(r) for r in changes.read_changes(spark, path, COLS).collect()} == {("first", 1), ("other", 2), ("mine", 3)}


def test_plain_files_of_before_are_read(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([("m", "1", "Production", "r", "/p", 1)], jobs.VERSION_COLS).write.parquet(path)
    assert jobs.add_version(spark, path, "m", "r2", "/p2") == "2"
    assert {r.version: r.stage for r in jobs.read_versions(spark, path).collect()} == {"1": "Archived", "2": "Production"}


def test_an_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        jobs.add_version(spark, str(tmp_path), "m", "r", "/p")


def test_many_keys_are_one_map(spark):
    n = 20_000
    log = spark.range(2 * n).select(F.concat(F.lit("r"), F.col("id") % 3).alias("run_id"), F.lit("metric").alias("kind"), F.concat(F.lit("k"), F.col("id") % n).alias("key"),
                                    F.col("id").cast("double").alias("value"), F.col("id").alias("ts_ms"), F.lit(0).cast("bigint").alias("seq"))
    runs = run_map(log)
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 3000
    sizes = {r.run_id: r.s for r in runs.select("run_id", F.size("latest").alias("s")).collect()}
    assert sum(sizes.values()) == 2 * n
    r = run_wide(log, ["k7", "absent"]).orderBy("run_id").collect()
    assert [(x.run_id, x.k7, x.absent) for x in r] == [("r0", 20007.0, None), ("r1", 7.0, None), ("r2", None, None)]


def test_runs_keep_their_rows(spark):
    log = spark.createDataFrame([("a", "metric", "x", 1.0, 5, 0), ("a", "metric", "x", 2.0, 5, 1), ("a", "param", "x", 9.0, 1, 0), ("b", "param", "y", 3.0, 4, 0),
                                 ("c", "metric", None, 3.0, 4, 0), ("d", "metric", "x", None, 4, 0), ("d", "metric", "x", 7.0, 3, 0), ("e", "metric", "nan", math.nan, 4, 0)],
                                "run_id string, kind string, key string, value double, ts_ms long, seq long")
    got = {r.run_id: (r.start_time, r.x) for r in run_wide(log).collect()}
    assert got == {"a": (1, 2.0), "b": (4, None), "c": (4, None), "d": (3, None), "e": (4, None)}
    assert run_wide(log).columns == ["run_id", "start_time", "nan", "x"]


@pytest.mark.parametrize("bound", [5, 100_000])
def test_element_median_is_exact(spark, bound):
    rng = np.random.default_rng(1)
    rows = [(k, float(v)) for k, n in (("a", 101), ("b", 100), (None, 7), ("é", 1)) for v in rng.integers(0, 40, n)]
    df = spark.createDataFrame(rows + [("a", None), ("none", None)], "k string, value double").repartition(4)
    want = {k: (sorted(v for g, v in rows if g == k)[(n - 1) // 2], n) for k, n in Counter(g for g, _ in rows).items()}
    assert {r.k: (r.median, r.n) for r in median_element(df, ["k"], max_rows=bound).collect()} == want
    whole = sorted(v for _, v in rows)
    for level in (0.0, 0.1, 0.5, 1.0):
        r = element_quantile(df, [], level, max_rows=bound).collect()
        assert [tuple(x) for x in r] == [(whole[max(0, math.ceil(level * len(whole)) - 1)], len(whole))]


def test_sample_scans_twice(spark, tmp_path):
    """One count of the steps, one ordered head of little more than n rows."""
    from pyspark.sql.classic.dataframe import DataFrame
    spark.range(200_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    calls, plain = [], DataFrame.collect
    DataFrame.collect = lambda self: calls.append(1) or plain(self)
    try:
        out = sample_exact_n(df, "id", 500)
    finally:
        DataFrame.collect = plain
    assert len(calls) == 1 and out.count() == 500
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Filter" in plan
    order = F.md5(F.concat(F.col("id").cast("string"), F.lit(":sample:123")))
    want = {r[0] for r in df.orderBy(order).limit(500).collect()}
    assert {r[0] for r in out.collect()} == want
