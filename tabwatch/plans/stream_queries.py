"""Registered streaming queries (file streams over the driver tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwatch.operators.profile import build_profile
from tabwatch.plans import sqlfrag as S
from tabwatch.plans.model_queries import SQL_RECORD_SCORE, lineitem_model, with_odd_status
from tabwatch.plans.tables import table
from tabwatch.session import scratch_path
from tabwatch.spec import PSI_EPS
from tabwatch.streaming.drift import drift_per_batch, drift_per_window, read_sink, stream_score

R = 6
EV_FEATS = ["value", "k"]
SPLIT_TS = "2024-01-16 00:00:00"
WINDOW = "1 day"
DELAY = "1 hour"
FILES_PER_TRIGGER = 1000


def file_stream(spark: SparkSession, sf_dir: str, name: str, schema) -> DataFrame:
    """A file stream over one table of the folder (new files are picked up
    as they land; each run starts from its checkpoint).  A backlog is read
    ``FILES_PER_TRIGGER`` files at a time.  A table that is a folder of part
    files is streamed from that folder, since a name pattern is held against
    the files' own names only."""
    folder, file = sf_dir.rstrip("/"), f"{name}.parquet"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    files = table(spark, sf_dir, name).inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{file}") and not files[0].endswith(f"/{file}/{file}"):
        return stream.option("pathGlobFilter", file).parquet(folder)
    return stream.parquet(f"{folder}/{file}")


def check_seen(query: StreamingQuery, rows: DataFrame) -> None:
    """Raise if a stream with a fresh checkpoint has read nothing of a table that
    holds ``rows`` for it."""
    if not any(p.numInputRows for p in query.recentProgress) and rows.limit(1).count():
        raise RuntimeError("the stream read no rows, but its table has some")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    s = file_stream(spark, sf_dir, "events", ev.schema)
    return s.withColumn("k", F.get_json_object("props", "$.k").cast("double"))


def _events_baseline(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    return ev.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))


def _new(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))


def _ckpt(spark, name):
    """A fresh stream checkpoint location in the shared folder."""
    return scratch_path(spark, f"{name}-checkpoint")


def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    stream = with_odd_status(file_stream(spark, sf_dir, "lineitem", li.schema))
    from tabwatch.operators.score import load_model
    model = load_model(lineitem_model(spark, sf_dir))
    sink = scratch_path(spark, "stream_score")
    done = stream_score(stream, model, ["l_orderkey", "l_linenumber"], sink, _ckpt(spark, "stream_score"))
    check_seen(done, li)
    return read_sink(spark, sink, "l_orderkey bigint, l_linenumber int, prediction int")


def q_stream_drift_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = build_profile(_events_baseline(spark, sf_dir), EV_FEATS, 10)
    stream = _new(_events_stream(spark, sf_dir))
    sink = scratch_path(spark, "stream_drift_batch")
    done = drift_per_batch(stream, prof, sink, _ckpt(spark, "stream_drift_batch"))
    check_seen(done, _new(table(spark, sf_dir, "events")))
    rep = read_sink(spark, sink, "feature string, psi double, bins int, new_total bigint, batch_id bigint")
    return rep.select("batch_id", "feature", F.round("psi", R).alias("psi"), "bins", "new_total")


def q_stream_drift_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = build_profile(_events_baseline(spark, sf_dir), EV_FEATS, 10)
    stream = _new(_events_stream(spark, sf_dir))
    sink = scratch_path(spark, "stream_drift_window")
    done = drift_per_window(stream, prof, EV_FEATS, "ts", WINDOW, DELAY, sink, _ckpt(spark, "stream_drift_window"))
    check_seen(done, _new(table(spark, sf_dir, "events")))
    rep = read_sink(spark, sink, "window_start bigint, feature string, psi double, bins int, "
                                 "new_total bigint, batch_id bigint")
    return rep.select("window_start", "feature", F.round("psi", R).alias("psi"), "bins", "new_total")


_EV = "(SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"
_EV_BASE = f"(SELECT * FROM {_EV} WHERE ts < TIMESTAMP '{SPLIT_TS}')"
_EV_NEW = f"(SELECT * FROM {_EV} WHERE ts >= TIMESTAMP '{SPLIT_TS}')"
_EPS = S.dbl(PSI_EPS)


def _psi_sql(group_expr: str, group_name: str, source: str, where: str = "TRUE") -> str:
    return f"""
WITH prof AS ({S.profile_cte(_EV_BASE, EV_FEATS, 10, 'exact')}),
     bh AS ({S.hist_open_cte(_EV_BASE, EV_FEATS, 'prof')}),
     nv AS (SELECT {group_expr} AS g, v.feature, len(list_filter(p.cuts, lambda x: x <= v.value)) AS bin
            FROM (SELECT *, ts FROM (
                    SELECT ts, 'value' AS feature, CAST(value AS DOUBLE) AS value FROM {source}
                    UNION ALL SELECT ts, 'k' AS feature, k AS value FROM {source})
                  WHERE value IS NOT NULL AND NOT isnan(value)) v
            JOIN prof p USING (feature) WHERE {where}),
     gf AS (SELECT DISTINCT g, feature FROM nv),
     cnt AS (SELECT g, feature, bin, count(*) AS n FROM nv GROUP BY ALL),
     t AS (SELECT gf.g, gf.feature, bh.bin, bh.n::DOUBLE AS p_raw, COALESCE(cnt.n, 0) AS n,
                  len(p.cuts) + 1 AS bins
           FROM gf JOIN bh ON bh.feature = gf.feature JOIN prof p ON p.feature = gf.feature
           LEFT JOIN cnt ON cnt.g = gf.g AND cnt.feature = gf.feature AND cnt.bin = bh.bin),
     s AS (SELECT *, p_raw / (sum(p_raw) OVER (PARTITION BY g, feature) + {_EPS}) AS p,
                  n::DOUBLE / (sum(n) OVER (PARTITION BY g, feature)::DOUBLE + {_EPS}) AS q FROM t)
SELECT g AS {group_name}, feature,
       round(sum((p - q) * ln((p + {_EPS}) / (q + {_EPS}))), {R}) AS psi,
       CAST(max(bins) AS INTEGER) AS bins, sum(n)::BIGINT AS new_total
FROM s GROUP BY ALL
"""


SQL_STREAM_DRIFT_BATCH = _psi_sql("CAST(0 AS BIGINT)", "batch_id", _EV_NEW)
SQL_STREAM_DRIFT_WINDOW = _psi_sql(
    "CAST(epoch(date_trunc('day', ts)) AS BIGINT)", "window_start", _EV_NEW,
    where=f"date_trunc('day', v.ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM {_EV_NEW}) - INTERVAL 1 HOUR")

def q_drift_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch PSI per daily window of the new period (every window, closed or
    not): the batch counterpart of the windowed stream."""
    from tabwatch.operators.drift import psi_by_window
    prof = build_profile(_events_baseline(spark, sf_dir), EV_FEATS, 10)
    ev = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    new = ev.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    rep = psi_by_window(prof, new, "ts", WINDOW)
    return rep.select("window_start", "feature", F.round("psi", R).alias("psi"), "bins", "new_total")


QUERIES = {
    "drift_by_window": q_drift_by_window,
    "stream_score": q_stream_score,
    "stream_drift_batch": q_stream_drift_batch,
    "stream_drift_window": q_stream_drift_window,
}

SQL_DRIFT_BY_WINDOW = _psi_sql("CAST(epoch(date_trunc('day', ts)) AS BIGINT)", "window_start", _EV_NEW)

ORACLES = {
    "drift_by_window": SQL_DRIFT_BY_WINDOW,
    "stream_score": SQL_RECORD_SCORE,
    "stream_drift_batch": SQL_STREAM_DRIFT_BATCH,
    "stream_drift_window": SQL_STREAM_DRIFT_WINDOW,
}
