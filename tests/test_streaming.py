"""Stream results equal batch results on the same rows (closed windows)."""

import pytest
from pyspark.sql import functions as F

from tabwatch.operators.drift import psi_report
from tabwatch.operators.profile import build_profile
from tabwatch.plans.stream_queries import EV_FEATS, SPLIT_TS, _events_baseline, file_stream
from tabwatch.session import scratch_path
from tabwatch.streaming.drift import drift_per_batch, read_sink

SF = "/root/testdata/sf0.001"


def test_stream_batch_drift_equals_batch_report(spark):
    prof = build_profile(_events_baseline(spark, SF), EV_FEATS, 10)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    stream = (file_stream(spark, SF, "events", ev.schema)
              .withColumn("k", F.get_json_object("props", "$.k").cast("double"))
              .where(F.col("ts") >= cut))
    sink = scratch_path(spark, "t_stream")
    drift_per_batch(stream, prof, sink, scratch_path(spark, "t_stream_ckpt"))
    got = {r["feature"]: r["psi"] for r in read_sink(spark, sink, "feature string, psi double").collect()}
    new = ev.withColumn("k", F.get_json_object("props", "$.k").cast("double")).where(F.col("ts") >= cut)
    exp = {r["feature"]: r["psi"] for r in psi_report(prof, new, "empirical").collect()}
    assert got.keys() == exp.keys()
    for f in exp:
        assert got[f] == pytest.approx(exp[f], rel=1e-9, abs=1e-12)


def test_replayed_batch_does_not_duplicate(spark):
    from tabwatch.streaming.drift import write_batch
    sink = scratch_path(spark, "t_idem")
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "feature string, psi double")
    write_batch(df, 0, sink)
    write_batch(df, 1, sink)
    write_batch(df, 0, sink)          # replay of batch 0 after a failure
    got = read_sink(spark, sink, "feature string, psi double, batch_id bigint")
    assert got.count() == 4
    assert sorted(r[0] for r in got.select("batch_id").distinct().collect()) == [0, 1]


def test_window_drift_drops_rows_behind_the_watermark(spark):
    import time as _t

    from tabwatch.streaming.drift import drift_per_window
    ev = (spark.read.parquet(f"{SF}/events.parquet")
          .withColumn("k", F.get_json_object("props", "$.k").cast("double")))
    prof = build_profile(ev.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), EV_FEATS, 10)
    src = scratch_path(spark, "t_late_src")
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    recent_a = ev.where((F.col("ts") >= day("2024-01-20")) & (F.col("ts") < day("2024-01-25")))
    recent_b = ev.where(F.col("ts") >= day("2024-01-25"))
    late = ev.where(F.col("ts") < day("2024-01-10"))
    # one file per micro-batch; Spark filters late rows with the watermark of
    # the previous batch, so the late file comes third
    for part in (recent_a, recent_b, late):
        part.coalesce(1).write.mode("append").parquet(src)
        _t.sleep(1.1)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    sink = scratch_path(spark, "t_late_sink")
    drift_per_window(stream, prof, EV_FEATS, "ts", "1 day", "1 hour", sink,
                     scratch_path(spark, "t_late_ckpt"))
    got = read_sink(spark, sink, "window_start bigint, feature string")
    starts = [r[0] for r in got.select("window_start").distinct().collect()]
    jan20 = 1705708800                              # 2024-01-20 00:00:00 UTC
    assert starts and min(starts) >= jan20          # every late row was dropped


def test_stream_windows_equal_batch_windows_when_closed(spark):
    from tabwatch.operators.drift import psi_by_window
    from tabwatch.plans.stream_queries import q_stream_drift_window
    sf = "/root/testdata/sf0.01"
    got = {(r["window_start"], r["feature"]): r["psi"] for r in q_stream_drift_window(spark, sf).collect()}
    ev = (spark.read.parquet(f"{sf}/events.parquet")
          .withColumn("k", F.get_json_object("props", "$.k").cast("double")))
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    prof = build_profile(ev.where(F.col("ts") < cut), EV_FEATS, 10)
    batch = {(r["window_start"], r["feature"]): r["psi"]
             for r in psi_by_window(prof, ev.where(F.col("ts") >= cut), "ts", "1 day").collect()}
    assert got and set(got) < set(batch)              # the still-open last window is not emitted
    for k, v in got.items():
        assert round(batch[k], 6) == v


def test_restarted_stream_resumes_from_its_checkpoint(spark):
    import time as _t
    ev = (spark.read.parquet(f"{SF}/events.parquet")
          .withColumn("k", F.get_json_object("props", "$.k").cast("double")))
    prof = build_profile(ev.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), EV_FEATS, 10)
    src, sink, ckpt = (scratch_path(spark, "t_rs_src"), scratch_path(spark, "t_rs_sink"),
                       scratch_path(spark, "t_rs_ckpt"))
    first = ev.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    second = ev.where(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    first.coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(ev.schema).parquet(src)
        drift_per_batch(stream, prof, sink, ckpt)

    run()
    _t.sleep(1.1)
    second.coalesce(1).write.mode("append").parquet(src)
    run()                                           # restart: same checkpoint, one new file
    got = read_sink(spark, sink, "feature string, new_total bigint, batch_id bigint")
    totals = {r["batch_id"]: r["t"] for r in got.groupBy("batch_id").agg(F.max("new_total").alias("t")).collect()}
    exp_first = first.where(F.col("value").isNotNull()).count()
    exp_second = second.where(F.col("value").isNotNull()).count()
    assert totals == {0: exp_first, 1: exp_second}


def test_slow_streams_are_waited_for_and_broken_sinks_raise(spark, tmp_path):
    import time as _t

    from pyspark.errors import AnalysisException

    from tabwatch.streaming.drift import run_available
    src = scratch_path(spark, "t_slow_src")
    for _ in range(4):
        spark.range(10).coalesce(1).write.mode("append").parquet(src)
    seen = []

    def slow(batch, _id):
        _t.sleep(1.5)
        seen.append(batch.count())

    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    run_available(stream.writeStream.foreachBatch(slow).option("checkpointLocation", scratch_path(spark, "t_slow_ckpt")))
    assert sum(seen) == 40
    assert read_sink(spark, str(tmp_path / "none"), "a long").collect() == []
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("a,b\n1,2\n")
    with pytest.raises(Exception) as e:
        read_sink(spark, str(tmp_path / "broken"), "a long").collect()
    assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"
