"""Registered source/sink and preparation queries with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.functions.scalars import mem_to_mb
from tabwatch.operators.prep import collapse, column_checks, fill_median, shift_scale
from tabwatch.operators.profile import build_profile, open_edges, quantile_edges
from tabwatch.operators.reshape import to_long
from tabwatch.plans import sqlfrag as S
from tabwatch.plans.drift_queries import BASE_SQL, FEATS, NULLED_SQL, R, SQL_PSI_EMPIRICAL, SQL_PSI_UNIFORM
from tabwatch.plans.tables import lineitem_baseline, sql_nulls, table, with_nulls
from tabwatch.session import scratch_path
from tabwatch.sources.baseline import load_baseline, save_baseline, save_legacy
from tabwatch.sources.csv import read_csv, write_csv
from tabwatch.sources.parquet import read_parquet, write_parquet
from tabwatch.sources.records import frame_to_records, records_to_frame

# ------------------------------------------------------------------ sources

EVENTS_CSV_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
    T.StructField("note", T.StringType()),
])


def q_csv_scan_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> CSV (columns in another order, 'NA' tokens, empty fields, whole
    numbers as 3.0, quoted line breaks) -> read by header name."""
    ev = table(spark, sf_dir, "events")
    user = F.when(F.col("event_id") % 5 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".0"))).otherwise(F.col("user_id").cast("string"))
    dirty = ev.select(
        "props", F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.concat(F.lit('first "line"\nsecond, '), F.col("event_type")).alias("note"), user.alias("user_id"),
        F.when(F.col("event_id") % 11 == 0, F.lit("NA")).otherwise(F.col("event_type")).alias("event_type"), "event_id")
    path = scratch_path(spark, "csv_scan_nulls")
    write_csv(dirty, path)
    return read_csv(spark, path, EVENTS_CSV_SCHEMA)


SQL_CSV_SCAN_NULLS = """
SELECT event_id, user_id,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value,
       props, 'first "line"' || chr(10) || 'second, ' || event_type AS note
FROM events
"""


def q_parquet_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_copy")
    write_parquet(orders.where(F.col("o_orderstatus") == "F"), path)   # first write
    write_parquet(orders, path)                                          # overwritten
    back = read_parquet(spark, path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                       "o_orderpriority")


SQL_PARQUET_OVERWRITE_ROUNDTRIP = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders
"""


def _edges_out(prof: DataFrame) -> DataFrame:
    """(feature, edge_idx, edge) with open ends exported as nulls."""
    e = prof.select("feature", F.posexplode("bin_edges").alias("edge_idx", "edge"))
    return e.select("feature", F.col("edge_idx").cast("int").alias("edge_idx"),
                    F.round(F.when(~F.isnan("edge") & (F.abs("edge") != F.lit(float("inf"))), F.col("edge")), R)
                    .alias("edge"))


def q_baseline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline (linspace deciles, open-ended) -> JSON file -> read back."""
    prof = build_profile(lineitem_baseline(spark, sf_dir), FEATS, 10, "linspace", with_counts=False)
    path = scratch_path(spark, "baseline")
    save_baseline(open_edges(prof), path, 10)
    back = load_baseline(spark, path)
    return _edges_out(back).join(back.select("feature", "n_bins"), "feature")


def _sql_open_edges(source: str, mode: str) -> str:
    return f"""
      WITH prof AS ({S.profile_cte(source, FEATS, 10, mode)}),
           oe AS (SELECT feature, list_concat(['-inf'::DOUBLE], cuts, ['inf'::DOUBLE]) AS e FROM prof)
      SELECT feature, CAST(i - 1 AS INTEGER) AS edge_idx,
             round(CASE WHEN isinf(e[i]) THEN NULL ELSE e[i] END, {R}) AS edge
      FROM oe, LATERAL (SELECT unnest(range(1, len(e) + 1)) AS i)
    """


SQL_BASELINE_ROUNDTRIP = f"""
SELECT *, 10 AS n_bins FROM ({_sql_open_edges(BASE_SQL, 'linspace')})
"""


def q_baseline_legacy_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy {feature: {bin_edges}} file -> migrated current shape."""
    prof = build_profile(lineitem_baseline(spark, sf_dir), FEATS, 10, "exact", with_counts=False)
    path = scratch_path(spark, "baseline_legacy")
    save_legacy(open_edges(prof), path)
    back = load_baseline(spark, path, n_bins=10)
    return _edges_out(back).join(back.select("feature", "n_bins"), "feature")


SQL_BASELINE_LEGACY_MIGRATE = f"""
SELECT *, 10 AS n_bins FROM ({_sql_open_edges(BASE_SQL, 'exact')})
"""

def q_psi_from_saved_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and save the baseline file, then reuse it (K2) to score the new
    rows with the stored counts: equals the empirical PSI report."""
    from tabwatch.operators.drift import psi_report
    from tabwatch.operators.profile import saved_profile
    from tabwatch.plans.tables import lineitem_new
    path = scratch_path(spark, "baseline_reuse")
    saved_profile(spark, path, lineitem_baseline(spark, sf_dir), FEATS, 10, levels="exact")
    reused = saved_profile(spark, path, None, FEATS, 10)          # loaded from the file
    rep = psi_report(reused, lineitem_new(spark, sf_dir), "empirical")
    return rep.select("feature", F.round("psi", R).alias("psi"), "bins", "new_total")


def q_psi_from_plain_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A legacy baseline file without bin counts, reused (and rewritten in the
    current shape) to score the new rows against uniform shares."""
    from tabwatch.operators.drift import psi_report
    from tabwatch.operators.profile import saved_profile
    from tabwatch.plans.tables import lineitem_new
    path = scratch_path(spark, "baseline_plain")
    save_legacy(open_edges(build_profile(lineitem_baseline(spark, sf_dir), FEATS, 10, with_counts=False)), path)
    saved_profile(spark, path, None, FEATS, 10)
    reused = saved_profile(spark, path, None, FEATS, 10)
    rep = psi_report(reused, lineitem_new(spark, sf_dir), "uniform")
    return rep.select("feature", F.round("psi", R).alias("psi"), "bins", "new_total")


RECORD_SCHEMA = T.StructType([
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_extra", T.StringType()),
])


def q_records_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows -> JSON records (some fields missing) -> typed frame."""
    li = with_nulls(table(spark, sf_dir, "lineitem"), cols=("l_tax",))
    rec = frame_to_records(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                "l_returnflag", "l_linestatus"],
                           keep=["l_orderkey", "l_linenumber"])
    return records_to_frame(rec, "payload", RECORD_SCHEMA, keep=["l_orderkey", "l_linenumber"])


SQL_RECORDS_FRAME = f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       {sql_nulls('l_tax')} AS l_tax, l_returnflag, l_linestatus, NULL::VARCHAR AS l_extra
FROM lineitem
"""

# -------------------------------------------------------------- preparation

def q_category_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = with_nulls(table(spark, sf_dir, "lineitem"), cols=("l_returnflag",))
    return collapse(li, "l_returnflag", "R", "N").select("l_orderkey", "l_linenumber", "l_returnflag")


SQL_CATEGORY_COLLAPSE = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN {sql_nulls('l_returnflag')} = 'R' THEN 'R' ELSE 'N' END AS l_returnflag
FROM lineitem
"""


def q_drop_null_per_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = with_nulls(table(spark, sf_dir, "lineitem"))
    return to_long(li, FEATS, ids=["l_orderkey", "l_linenumber"])


SQL_DROP_NULL_PER_FEATURE = " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{f}' AS feature, CAST({f} AS DOUBLE) AS value "
    f"FROM {NULLED_SQL} WHERE {f} IS NOT NULL" for f in FEATS)


def q_median_fill_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median-fill two columns, then shift one by +8.0 and scale one by 1.5."""
    li = with_nulls(table(spark, sf_dir, "lineitem"))
    filled = fill_median(li, ["l_quantity", "l_extendedprice"])
    out = shift_scale(filled, {"l_quantity": (1.0, 8.0), "l_extendedprice": (1.5, 0.0),
                               "no_such_column": (1.3, 0.0)})
    return out.select("l_orderkey", "l_linenumber", F.round("l_quantity", R).alias("l_quantity"),
                      F.round("l_extendedprice", R).alias("l_extendedprice"))


SQL_MEDIAN_FILL_SHIFT = f"""
WITH t AS {NULLED_SQL},
     m AS (SELECT quantile_cont(l_quantity, 0.5) AS mq, quantile_cont(l_extendedprice, 0.5) AS mp FROM t)
SELECT l_orderkey, l_linenumber,
       round(COALESCE(l_quantity, m.mq) + 8.0, {R}) AS l_quantity,
       round(COALESCE(l_extendedprice, m.mp) * 1.5, {R}) AS l_extendedprice
FROM t, m
"""

CHECK_FEATURES = ["l_quantity", "l_discount", "l_missing", "l_allnull"]


def q_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_allnull", F.when(F.col("l_quantity") < 0, F.col("l_quantity")))
    chk = column_checks(li, CHECK_FEATURES)
    present = [f for f in CHECK_FEATURES if f in li.columns]
    e = quantile_edges(li, present, 10).select(
        "feature", F.when(F.size("edges") >= 3, F.size("edges") - 1).otherwise(1).cast("int").alias("bins"))
    return chk.join(e, "feature", "left").select(
        "feature", "pos", "present", "non_null", "status", "bins")


SQL_COLUMN_CHECKS = f"""
WITH li AS (SELECT *, CASE WHEN l_quantity < 0 THEN l_quantity END AS l_allnull FROM lineitem),
     prof AS ({S.profile_cte('li', ['l_quantity', 'l_discount', 'l_allnull'], 10, 'exact')}),
     spec AS {S.features_values(CHECK_FEATURES)}
SELECT s.feature, s.pos,
       s.feature IN ('l_quantity', 'l_discount', 'l_allnull') AS present,
       COALESCE(p.n, 0)::BIGINT AS non_null,
       CASE WHEN s.feature NOT IN ('l_quantity', 'l_discount', 'l_allnull') THEN 'missing'
            WHEN COALESCE(p.n, 0) = 0 THEN 'skipped' ELSE 'ok' END AS status,
       CAST(CASE WHEN p.feature IS NULL THEN NULL ELSE len(p.cuts) + 1 END AS INTEGER) AS bins
FROM spec s LEFT JOIN prof p USING (feature)
"""


def q_setting_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run (user) settings map with defaults for missing keys."""
    ev = table(spark, sf_dir, "events")
    per = (ev.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
             .groupBy("user_id").agg(F.map_from_entries(
                 F.collect_list(F.struct("event_type", F.col("v").cast("string")))).alias("settings")))
    return per.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.coalesce(F.element_at("settings", F.lit("purchase")), F.lit("N/A")).alias("purchase"),
        F.coalesce(F.element_at("settings", F.lit("refund")), F.lit("N/A")).alias("refund"),
        F.map_contains_key("settings", F.lit("error")).alias("has_error"))


SQL_SETTING_DEFAULTS = """
WITH per AS (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY ALL)
SELECT CAST(u.user_id AS VARCHAR) AS run_id,
       COALESCE((SELECT CAST(v AS VARCHAR) FROM per p WHERE p.user_id = u.user_id AND event_type = 'purchase'), 'N/A') AS purchase,
       'N/A' AS refund,
       EXISTS (SELECT 1 FROM per p WHERE p.user_id = u.user_id AND event_type = 'error') AS has_error
FROM (SELECT DISTINCT user_id FROM events) u
"""


def _mem_text(size, key):
    return (F.when(key % 6 == 0, F.concat(size.cast("string"), F.lit("g")))
             .when(key % 6 == 1, F.concat(size.cast("string"), F.lit("m")))
             .when(key % 6 == 2, size.cast("string"))
             .when(key % 6 == 3, F.concat(size.cast("string"), F.lit("k")))
             .when(key % 6 == 4, F.concat(size.cast("string"), F.lit(".5G")))
             .otherwise(F.lit("N/A")))


def q_mem_to_mb(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    t = part.select("p_partkey", _mem_text(F.col("p_size"), F.col("p_partkey")).alias("mem_text"))
    return t.select("p_partkey", "mem_text", mem_to_mb(F.col("mem_text")).alias("mb"))


SQL_MEM_TO_MB = """
WITH t AS (
  SELECT p_partkey,
         CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS VARCHAR) || 'g'
                            WHEN 1 THEN CAST(p_size AS VARCHAR) || 'm'
                            WHEN 2 THEN CAST(p_size AS VARCHAR)
                            WHEN 3 THEN CAST(p_size AS VARCHAR) || 'k'
                            WHEN 4 THEN CAST(p_size AS VARCHAR) || '.5G'
                            ELSE 'N/A' END AS mem_text
  FROM part)
SELECT p_partkey, mem_text,
       COALESCE(CASE
         WHEN lower(mem_text) LIKE '%g' THEN TRY_CAST(trunc(TRY_CAST(left(lower(mem_text), -1) AS DOUBLE) * 1024.0) AS BIGINT)
         WHEN lower(mem_text) LIKE '%m' THEN TRY_CAST(trunc(TRY_CAST(left(lower(mem_text), -1) AS DOUBLE)) AS BIGINT)
         ELSE TRY_CAST(mem_text AS BIGINT) END, -1)::BIGINT AS mb
FROM t
"""

QUERIES = {
    "psi_from_saved_baseline": q_psi_from_saved_baseline,
    "psi_from_plain_baseline": q_psi_from_plain_baseline,
    "csv_scan_nulls": q_csv_scan_nulls,
    "parquet_overwrite_roundtrip": q_parquet_overwrite_roundtrip,
    "baseline_roundtrip": q_baseline_roundtrip,
    "baseline_legacy_migrate": q_baseline_legacy_migrate,
    "records_frame": q_records_frame,
    "category_collapse": q_category_collapse,
    "drop_null_per_feature": q_drop_null_per_feature,
    "median_fill_shift": q_median_fill_shift,
    "column_checks": q_column_checks,
    "setting_defaults": q_setting_defaults,
    "mem_to_mb": q_mem_to_mb,
}

ORACLES = {
    "psi_from_saved_baseline": SQL_PSI_EMPIRICAL,
    "psi_from_plain_baseline": SQL_PSI_UNIFORM,
    "csv_scan_nulls": SQL_CSV_SCAN_NULLS,
    "parquet_overwrite_roundtrip": SQL_PARQUET_OVERWRITE_ROUNDTRIP,
    "baseline_roundtrip": SQL_BASELINE_ROUNDTRIP,
    "baseline_legacy_migrate": SQL_BASELINE_LEGACY_MIGRATE,
    "records_frame": SQL_RECORDS_FRAME,
    "category_collapse": SQL_CATEGORY_COLLAPSE,
    "drop_null_per_feature": SQL_DROP_NULL_PER_FEATURE,
    "median_fill_shift": SQL_MEDIAN_FILL_SHIFT,
    "column_checks": SQL_COLUMN_CHECKS,
    "setting_defaults": SQL_SETTING_DEFAULTS,
    "mem_to_mb": SQL_MEM_TO_MB,
}
