"""Run logs and model versions as tables.

Run log (long): ``run_id string, kind string, key string, value double,
ts_ms bigint, seq bigint`` (one row per logged metric/param value).
Version log: ``name string, version string, stage string, run_id string,
ts_ms bigint``.  Every query below is an aggregation with map-side combine
(no per-name window), so a name or run holding a third of all rows is
still split across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.sources.parquet import read_parquet, write_parquet
from tabwatch.session import local_frame, materialize

RUNLOG_SCHEMA = ("run_id string, kind string, key string, value double, "
                 "ts_ms bigint, seq bigint")


def epoch_ms(ts_col: str) -> F.Column:
    """Milliseconds since the epoch of a timestamp without time zone."""
    from tabwatch.functions.timeparts import ntz_epoch_millis
    return ntz_epoch_millis(F.col(ts_col))


def append_runlog(rows: DataFrame, path: str) -> None:
    """Append long run-log rows to a Parquet table (creates it if absent)."""
    write_parquet(rows.select("run_id", "kind", "key", "value", "ts_ms", "seq"), path, mode="append")


def read_runlog(spark, path: str) -> DataFrame:
    return read_parquet(spark, path)


def run_map(log: DataFrame, kind: str = "metric") -> DataFrame:
    """One row per run of the log: ``run_id, start_time, latest`` with the latest value
    (by time, then sequence) of every key that the run logged, as a map; empty for a run
    without any.  The plan is the same for any number of keys."""
    key = F.when(F.col("kind") == kind, F.col("key"))
    last = log.groupBy("run_id", key.alias("key")).agg(F.min("ts_ms").alias("first"), F.max_by("value", F.struct("ts_ms", "seq")).alias("value"))
    entries = F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "value")))
    return last.groupBy("run_id").agg(F.min("first").alias("start_time"), F.map_from_entries(entries).alias("latest"))


def metric_keys(runs: DataFrame) -> list[str]:
    """The keys of a run_map() table, in order: names of columns to be, not data."""
    return sorted(r["key"] for r in runs.select(F.explode(F.map_keys("latest")).alias("key")).distinct().collect())


def run_wide(log: DataFrame, keys: Sequence[str] | None = None, kind: str = "metric") -> DataFrame:
    """One row per run of the log: ``run_id, start_time, <key>...`` with each key's
    latest value; a key the run never logged is null, and a run without any metric
    keeps its row.  Without ``keys``, all that were logged: the runs are written
    once, and the columns are taken from what is written."""
    runs = run_map(log, kind)
    if keys is None:
        runs = materialize(runs, "run_map")
        keys = metric_keys(runs)
    return runs.select("run_id", "start_time", *(F.try_element_at("latest", F.lit(k)).alias(k) for k in keys))


def metric_series(wide: DataFrame, metric: str) -> DataFrame:
    """``(run_id, start_time, value)`` of one metric, ordered by start time;
    empty when the metric is not a column."""
    if metric not in wide.columns:
        return local_frame(wide.sparkSession, [], "run_id string, start_time bigint, value double")
    return (wide.where(F.col(metric).isNotNull())
                .select("run_id", "start_time", F.col(metric).alias("value"))
                .orderBy("start_time", "run_id"))


def best_run(wide: DataFrame, metric: str, require: bool = False) -> DataFrame:
    """Top run by ``metric`` descending (runs lacking it or with NaN last, ties by run_id)."""
    score = F.when(~F.isnan(metric), F.col(metric))
    top = (wide.orderBy(score.desc_nulls_last(), F.col("run_id"))
               .limit(1).select("run_id", F.col(metric).alias("value")))
    if require and top.count() == 0:
        raise ValueError("the run log is empty: there is no best run")
    return top


def artifact_uri(run_id: F.Column) -> F.Column:
    return F.concat(F.lit("runs:/"), run_id, F.lit("/model"))


def run_artifacts(log: DataFrame) -> DataFrame:
    """``(run_id, artifact_uri)`` for every run in the log."""
    return log.select("run_id").distinct().withColumn("artifact_uri", artifact_uri(F.col("run_id")))


def best_run_location(wide: DataFrame, metric: str) -> DataFrame:
    """``(run_id, value, artifact_uri)`` of the best run."""
    return best_run(wide, metric).withColumn("artifact_uri", artifact_uri(F.col("run_id")))


# ------------------------------------------------------------ model versions

def next_version(versions: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``(name, next_version bigint)``: previous numeric maximum + 1 (1 when none).

    Versions are text in a registry; the maximum is taken as an integer.
    """
    agg = versions.groupBy("name").agg(F.max(F.col("version").cast("bigint")).alias("_mx"))
    if names is not None:
        agg = names.select("name").distinct().join(agg, "name", "left")
    return agg.select("name", (F.coalesce("_mx", F.lit(0)) + 1).cast("bigint").alias("next_version"))


def promote(versions: DataFrame, policy: str = "newest", archive_existing: bool = True,
            metric: DataFrame | None = None) -> DataFrame:
    """Promote one version per name to Production.

    policy 'newest' picks the highest version number; policy 'best' picks
    the version with the highest ``metric`` (``(name, version, score)``; NaN is no score).
    With ``archive_existing`` other Production versions become Archived.
    """
    if policy == "newest":
        pick = versions.groupBy("name").agg(F.max(F.col("version").cast("bigint")).alias("_pick"))
    elif policy == "best":
        if metric is None:
            raise ValueError("policy 'best' needs a metric table")
        pick = metric.groupBy("name").agg(
            F.max_by(F.col("version").cast("bigint"),
                     F.struct(F.when(~F.isnan("score"), F.col("score")), -F.col("version").cast("bigint"))).alias("_pick"))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    j = versions.join(pick, "name", "left")
    is_pick = F.col("version").cast("bigint") == F.col("_pick")
    stage = F.when(is_pick, F.lit("Production"))
    if archive_existing:
        stage = stage.when(F.col("stage") == "Production", F.lit("Archived"))
    stage = stage.otherwise(F.col("stage"))
    return j.withColumn("stage", stage).drop("_pick")


def current_production(versions: DataFrame, stage: str = "Production") -> DataFrame:
    """``(name, version, model_uri)``: the highest version in ``stage`` per name."""
    cur = (versions.where(F.col("stage") == stage)
                   .groupBy("name").agg(F.max(F.col("version").cast("bigint")).alias("version")))
    return cur.select("name", F.col("version").cast("string").alias("version"),
                      F.concat(F.lit("models:/"), F.col("name"), F.lit("/" + stage)).alias("model_uri"))
