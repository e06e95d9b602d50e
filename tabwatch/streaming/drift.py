"""Drift on streams.

* ``stream_score``: a fitted pipeline applied to a stream of records.
* ``drift_per_batch``: each micro-batch scored against a fixed baseline
  profile inside ``foreachBatch`` (where the batch is a static DataFrame,
  so the zero-filled outer join of bins is allowed).
* ``drift_per_window``: rows binned against the baseline's literal cuts
  (a stateless codegen projection), counted per tumbling event-time window
  with a watermark (append mode: a window is emitted once the watermark
  passes its end), PSI computed per closed window in ``foreachBatch``.
  Rows later than the delay are dropped once the watermark of an earlier
  micro-batch has passed them (Spark filters late rows with the previous
  batch's watermark; rows within the delay are always kept).

All sinks are Parquet tables in the shared folder with checkpoints in the
shared checkpoint folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwatch.operators.drift import expected_grid, score_counts, psi_report
from tabwatch.operators.histogram import binned
from tabwatch.operators.score import batch_score
from tabwatch.spec import PSI_EPS
from tabwatch.session import local_frame


def event_time(ts_col: str) -> F.Column:
    """A timestamp without zone as an instant on the UTC line (zone-free)."""
    from tabwatch.functions.timeparts import ntz_as_instant
    return ntz_as_instant(F.col(ts_col))


def run_available(query_builder):
    """Run the stream over everything that is there now, however long it takes.

    A failed batch raises here; the stream is only stopped when the wait itself
    is interrupted."""
    q = query_builder.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    return q


def write_batch(df: DataFrame, batch_id: int, sink: str) -> None:
    """Idempotent micro-batch write: each batch replaces only its own
    ``batch_id`` partition, so a batch replayed after a failure does not
    duplicate rows (exactly-once output from ``foreachBatch``)."""
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(sink))


def stream_score(stream: DataFrame, model: PipelineModel, keep: list[str], sink: str,
                 checkpoint: str) -> StreamingQuery:
    """Score a stream as batch_score() does a table; ``keep`` names the input columns
    that go to the sink, beside the model's ``prediction``."""
    scored = batch_score(model, stream).select(*(c for c in keep if c != "prediction"), "prediction")
    return run_available(scored.writeStream.format("parquet").option("path", sink)
                         .option("checkpointLocation", checkpoint).outputMode("append"))


def drift_per_batch(stream: DataFrame, profile: DataFrame, sink: str, checkpoint: str,
                    expected: str = "empirical") -> StreamingQuery:
    def score(batch: DataFrame, batch_id: int) -> None:
        rep = psi_report(profile, batch, expected)
        write_batch(rep, batch_id, sink)

    return run_available(stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint))


def drift_per_window(stream: DataFrame, profile: DataFrame, features: list[str], time_col: str,
                     window: str, delay: str, sink: str, checkpoint: str,
                     expected: str = "empirical", eps: float = PSI_EPS) -> StreamingQuery:
    timed = stream.withColumn("_et", event_time(time_col)).withWatermark("_et", delay)
    rows = binned(timed.select("_et", *[f for f in features if f in timed.columns]), profile, ids=["_et"])
    counts = rows.groupBy(F.window("_et", window).alias("w"), "feature", "bin").agg(
        F.count(F.lit(1)).alias("n"))
    grid = expected_grid(profile, expected)

    def score(batch: DataFrame, batch_id: int) -> None:
        c = batch.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "feature", "bin", "n")
        rep = score_counts(c, grid, ["window_start"], eps)
        write_batch(rep.select("window_start", "feature", "psi", F.col("bins").cast("int").alias("bins"),
                               "new_total"), batch_id, sink)

    return run_available(counts.writeStream.outputMode("append").foreachBatch(score)
                         .option("checkpointLocation", checkpoint))


def read_sink(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The sink's rows; without a sink folder (a stream that had no rows), an
    empty table.  Anything else that cannot be read is an error."""
    try:
        return spark.read.schema(schema).parquet(sink)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_frame(spark, [], schema)
