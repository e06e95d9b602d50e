"""Registered run-log and model-version queries (events as the log)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators.runlog import (append_runlog, best_run, best_run_location, current_production,
                                       epoch_ms, metric_series, next_version, promote,
                                       read_runlog, run_wide)
from tabwatch.plans.tables import table
from tabwatch.session import scratch_path

# Metric keys of the stand-in run log (the event types).
METRIC_KEYS = ["click", "error", "purchase", "signup", "view"]
SPLIT_TS = "2024-01-16 00:00:00"


def runlog_from_events(ev: DataFrame) -> DataFrame:
    """events as a run log: user = run, event type = metric key."""
    return ev.select(F.col("user_id").cast("string").alias("run_id"), F.lit("metric").alias("kind"),
                     F.col("event_type").alias("key"), "value", epoch_ms("ts").alias("ts_ms"),
                     F.col("event_id").alias("seq"))


def versions_from_events(ev: DataFrame) -> DataFrame:
    """events as a version log: event type = model name, event id + 1 = version."""
    stage = (F.when(F.col("value") >= 100, "Production").when(F.col("value") >= 50, "Staging")
              .when(F.col("value") >= 20, "Archived").otherwise("None"))
    return ev.select(F.col("event_type").alias("name"),
                     (F.col("event_id") + 1).cast("string").alias("version"),
                     stage.alias("stage"), F.col("user_id").cast("string").alias("run_id"),
                     epoch_ms("ts").alias("ts_ms"))


SQL_RUNLOG = """(SELECT CAST(user_id AS VARCHAR) AS run_id, 'metric' AS kind, event_type AS key, value,
                 (epoch_us(ts) // 1000) AS ts_ms, event_id AS seq FROM events)"""
SQL_VERSIONS = """(SELECT event_type AS name, CAST(event_id + 1 AS VARCHAR) AS version,
                  CASE WHEN value >= 100 THEN 'Production' WHEN value >= 50 THEN 'Staging'
                       WHEN value >= 20 THEN 'Archived' ELSE 'None' END AS stage,
                  CAST(user_id AS VARCHAR) AS run_id, (epoch_us(ts) // 1000) AS ts_ms FROM events)"""


def _wide(spark, sf_dir):
    return run_wide(runlog_from_events(table(spark, sf_dir, "events")))


def q_run_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(spark, sf_dir)


_latest = ",\n".join(
    f"  max(CASE WHEN key = '{k}' AND rn = 1 THEN value END) AS {k}" for k in METRIC_KEYS)
SQL_RUN_WIDE = f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY ts_ms DESC, seq DESC) AS rn
           FROM {SQL_RUNLOG})
SELECT run_id, min(ts_ms) AS start_time,
{_latest}
FROM l GROUP BY run_id
"""


def q_metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_series(_wide(spark, sf_dir), "purchase")


SQL_METRIC_SERIES = f"""
SELECT run_id, start_time, purchase AS value FROM ({SQL_RUN_WIDE}) WHERE purchase IS NOT NULL
"""


def q_best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_run(_wide(spark, sf_dir), "purchase")


SQL_BEST_RUN = f"""
SELECT run_id, purchase AS value FROM ({SQL_RUN_WIDE}) ORDER BY purchase DESC NULLS LAST, run_id LIMIT 1
"""


def q_best_run_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = runlog_from_events(table(spark, sf_dir, "events"))
    return best_run_location(run_wide(log, METRIC_KEYS), "purchase")


SQL_BEST_RUN_LOCATION = f"""
SELECT run_id, value, 'runs:/' || run_id || '/model' AS artifact_uri FROM ({SQL_BEST_RUN})
"""


def q_run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends (first half of the month, then the rest) read back whole."""
    ev = table(spark, sf_dir, "events")
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    path = scratch_path(spark, "runlog")
    append_runlog(runlog_from_events(ev.where(F.col("ts") < cut)), path)
    append_runlog(runlog_from_events(ev.where(F.col("ts") >= cut)), path)
    return read_runlog(spark, path)


SQL_RUN_LOG_APPEND = f"SELECT * FROM {SQL_RUNLOG}"


def q_next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_version(versions_from_events(table(spark, sf_dir, "events")))


SQL_NEXT_VERSION = f"""
SELECT name, COALESCE(max(CAST(version AS BIGINT)), 0) + 1 AS next_version
FROM {SQL_VERSIONS} GROUP BY name
"""


def q_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = versions_from_events(table(spark, sf_dir, "events"))
    return promote(v, policy="newest", archive_existing=True).select("name", "version", "stage")


SQL_PROMOTE = f"""
WITH v AS {SQL_VERSIONS},
     p AS (SELECT name, max(CAST(version AS INTEGER)) AS pick FROM v GROUP BY name)
SELECT v.name, v.version,
       CASE WHEN CAST(v.version AS INTEGER) = p.pick THEN 'Production'
            WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
FROM v JOIN p USING (name)
"""


def q_promote_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version goes to Production beside those that are there."""
    v = versions_from_events(table(spark, sf_dir, "events"))
    return promote(v, policy="newest", archive_existing=False).select("name", "version", "stage")


SQL_PROMOTE_KEEP = f"""
WITH v AS {SQL_VERSIONS}, p AS (SELECT name, max(CAST(version AS BIGINT)) AS pick FROM v GROUP BY name)
SELECT v.name, v.version, CASE WHEN CAST(v.version AS BIGINT) = p.pick THEN 'Production' ELSE v.stage END AS stage
FROM v JOIN p USING (name)
"""


def q_promote_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version of the best metric goes to Production; NaN is no metric."""
    ev = table(spark, sf_dir, "events")
    score = F.when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("score")
    scores = ev.select(F.col("event_type").alias("name"), (F.col("event_id") + 1).cast("string").alias("version"), score)
    return promote(versions_from_events(ev), policy="best", metric=scores).select("name", "version", "stage")


SQL_PROMOTE_BEST = f"""
WITH v AS {SQL_VERSIONS},
     p AS (SELECT event_type AS name, event_id + 1 AS pick FROM events WHERE event_id % 17 <> 0
           QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) = 1)
SELECT v.name, v.version, CASE WHEN CAST(v.version AS BIGINT) = p.pick THEN 'Production'
       WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
FROM v JOIN p USING (name)
"""


def q_current_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = versions_from_events(table(spark, sf_dir, "events"))
    return current_production(v)


SQL_CURRENT_PRODUCTION = f"""
SELECT name, CAST(max(CAST(version AS INTEGER)) AS VARCHAR) AS version,
       'models:/' || name || '/Production' AS model_uri
FROM {SQL_VERSIONS} WHERE stage = 'Production' GROUP BY name
"""

QUERIES = {
    "run_wide": q_run_wide,
    "metric_series": q_metric_series,
    "best_run": q_best_run,
    "best_run_location": q_best_run_location,
    "run_log_append": q_run_log_append,
    "next_version": q_next_version,
    "promote": q_promote,
    "promote_keep": q_promote_keep,
    "promote_best": q_promote_best,
    "current_production": q_current_production,
}

ORACLES = {
    "run_wide": SQL_RUN_WIDE,
    "metric_series": SQL_METRIC_SERIES,
    "best_run": SQL_BEST_RUN,
    "best_run_location": SQL_BEST_RUN_LOCATION,
    "run_log_append": SQL_RUN_LOG_APPEND,
    "next_version": SQL_NEXT_VERSION,
    "promote": SQL_PROMOTE,
    "promote_keep": SQL_PROMOTE_KEEP,
    "promote_best": SQL_PROMOTE_BEST,
    "current_production": SQL_CURRENT_PRODUCTION,
}
