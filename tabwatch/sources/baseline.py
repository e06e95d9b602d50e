"""Baseline profile files.

Current shape (one JSON object)::

    {"num_cols": [...], "bins": {feature: {"bin_edges": [...]}}, "n_bins": N}

Legacy shape: ``{feature: {"bin_edges": [...]}}``.  Open ends are written as
-Infinity / Infinity and read back with an explicit schema.  Any other shape
is rejected.

A baseline is saved as the next version beside the ones before
(``version=<n>``), written apart and renamed when it is whole; the greatest
number is the baseline.  A writer that fails, or a reader at the same time, finds
the one before.  Plain JSON files, as other writers leave them, count as version 0.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.sources.changes import drop_folder, is_file, last_number, missing, rename_new

BEFORE = ".before"

EDGES_T = T.StructType([T.StructField("bin_edges", T.ArrayType(T.DoubleType()), True),
                        T.StructField("counts", T.ArrayType(T.LongType()), True)])
BASELINE_SCHEMA = T.StructType([
    T.StructField("num_cols", T.ArrayType(T.StringType()), True),
    T.StructField("bins", T.MapType(T.StringType(), EDGES_T), True),
    T.StructField("n_bins", T.IntegerType(), True),
])
LEGACY_SCHEMA = T.MapType(T.StringType(), EDGES_T)


def profile_document(open_edges: DataFrame, n_bins: int) -> DataFrame:
    """One-row DataFrame in the current baseline shape from
    ``(feature, pos, bin_edges[, counts])`` rows (one per feature; the
    optional per-bin baseline counts are an extra key that readers of the
    plain shape ignore).  The feature list is configuration-sized."""
    cnt = F.col("counts") if "counts" in open_edges.columns else F.lit(None).cast("array<bigint>")
    agg = open_edges.select("pos", "feature", "bin_edges", cnt.alias("counts")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "feature", "bin_edges", "counts"))).alias("_r"))
    return agg.select(
        F.transform("_r", lambda s: s["feature"]).alias("num_cols"),
        F.map_from_entries(F.transform(
            "_r", lambda s: F.struct(s["feature"], F.struct(s["bin_edges"].alias("bin_edges"),
                                                            s["counts"].alias("counts"))))
        ).alias("bins"),
        F.lit(int(n_bins)).alias("n_bins"))


def save_baseline(open_edges: DataFrame, path: str, n_bins: int) -> None:
    """Save the next version at ``path``.  A plain file there is moved to
    ``<path>.before``, from which it is still read until the new one is in place."""
    spark, path = open_edges.sparkSession, path.rstrip("/")
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    try:
        profile_document(open_edges, n_bins).coalesce(1).write.json(f"{staged}/version=0")
        if is_file(spark, path):
            rename_new(spark, path, path + BEFORE)
        while not rename_new(spark, f"{staged}/version=0", f"{path}/version={last_number(spark, path, 'version') + 1}"):
            pass                                       # another writer took the number
    finally:
        drop_folder(spark, staged)


def save_legacy(open_edges: DataFrame, path: str) -> None:
    """Write the legacy ``{feature: {bin_edges}}`` shape (for migration tests)."""
    doc = profile_document(open_edges.select("feature", "pos", "bin_edges"), 0)
    legacy = F.transform_values("bins", lambda k, v: F.struct(v["bin_edges"].alias("bin_edges")))
    doc.select(F.to_json(legacy).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)


def _whole_text(spark: SparkSession, path: str) -> DataFrame:
    """The text of the greatest version: plain files are of version 0."""
    try:
        text = _read_text(spark, path)
    except AnalysisException as e:
        if not (missing(e) and is_file(spark, path.rstrip("/") + BEFORE)):
            raise
        text = _read_text(spark, path.rstrip("/") + BEFORE)
    number = F.coalesce(F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/[^/]*$", 1).try_cast("bigint"), F.lit(0))
    text = text.select("value", number.alias("version")).where(F.length(F.trim("value")) > 0)
    last = text.agg(F.max("version")).first()[0]
    return text.where(F.col("version") == F.lit(last)).select("value")


def load_baseline(spark: SparkSession, path: str, n_bins: int | None = None) -> DataFrame:
    """Read a baseline file of either shape -> ``(feature, pos, bin_edges, n_bins)``.

    Legacy files are migrated (feature order kept, ``n_bins`` taken from the
    argument).  Raises ``ValueError`` on any other shape.
    """
    txt = _whole_text(spark, path)
    cur = txt.select(F.from_json("value", BASELINE_SCHEMA, {"allowNonNumericNumbers": "true"}).alias("d"))
    cur = cur.select("d.*")
    ok_cur = cur.where(F.col("num_cols").isNotNull() & F.col("bins").isNotNull())
    if ok_cur.limit(1).count() == 1:
        return _explode_current(ok_cur)
    leg = txt.select(F.from_json("value", LEGACY_SCHEMA).alias("m"))
    valid = leg.where(F.col("m").isNotNull() & (F.size(F.map_keys("m")) > 0)
                      & F.forall(F.map_values("m"), lambda v: v["bin_edges"].isNotNull()))
    if valid.limit(1).count() == 1:
        if n_bins is None:
            raise ValueError("legacy baseline needs n_bins")
        migrated = valid.select(
            F.map_keys("m").alias("num_cols"), F.col("m").alias("bins"),
            F.lit(int(n_bins)).alias("n_bins"))
        return _explode_current(migrated)
    raise ValueError(f"{path} holds neither a current nor a legacy baseline")


def is_legacy(spark: SparkSession, path: str) -> bool:
    """Whether the file at ``path`` lacks the current shape's keys."""
    txt = _whole_text(spark, path)
    cur = txt.select(F.from_json("value", BASELINE_SCHEMA, {"allowNonNumericNumbers": "true"}).alias("d"))
    return cur.where("d.num_cols IS NOT NULL AND d.bins IS NOT NULL").limit(1).count() == 0


def migrate_legacy(spark: SparkSession, path: str, out_path: str, n_bins: int) -> DataFrame:
    """Read a legacy file and write it back in the current shape."""
    prof = load_baseline(spark, path, n_bins)
    save_baseline(prof.select("feature", "pos", "bin_edges"), out_path, n_bins)
    return prof


def _explode_current(doc: DataFrame) -> DataFrame:
    return doc.select(F.posexplode("num_cols").alias("pos", "feature"), "bins", "n_bins") \
              .select("feature", F.col("pos").cast("int").alias("pos"),
                      F.element_at("bins", F.col("feature"))["bin_edges"].alias("bin_edges"),
                      F.element_at("bins", F.col("feature"))["counts"].alias("counts"),
                      "n_bins")


def profile_from_edges(loaded: DataFrame) -> DataFrame:
    """Loaded ``(feature, pos, bin_edges)`` -> a scoring profile
    ``(feature, pos, cuts, bins)`` (inner edges only)."""
    n = F.size("bin_edges")
    cuts = F.when(n >= 3, F.slice("bin_edges", 2, n - 2)).otherwise(F.array().cast("array<double>"))
    return loaded.select("feature", "pos", cuts.alias("cuts"),
                         F.greatest(n - 1, F.lit(1)).cast("int").alias("bins"), "counts")
