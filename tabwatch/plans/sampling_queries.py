"""Registered split / fold / sample queries and the generated-batch monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators.drift import generate_drift_batch, monitor, with_status
from tabwatch.operators.sampling import kfold_hash, sample_exact_n, split_hash
from tabwatch.plans import sqlfrag as S
from tabwatch.plans.tables import SQL_CUTOFF, cutoff_col, table, with_nulls
from tabwatch.spec import DRIFT_BATCH_SCALE, DRIFT_BATCH_SHIFT, PSI_EPS, DriftSpec

R = 6
ORDER_FEATS = ["o_totalprice", "o_custkey"]
ADJUST = {"o_totalprice": (DRIFT_BATCH_SCALE, 0.0), "o_custkey": (1.0, DRIFT_BATCH_SHIFT)}


def _hex32(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


def q_split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_hash(table(spark, sf_dir, "orders"), "o_orderkey", 80, 42).select("o_orderkey", "split")


SQL_SPLIT_HASH = f"""
SELECT o_orderkey,
       CASE WHEN {_hex32("CAST(o_orderkey AS VARCHAR) || ':split:42'")} % 100 < 80
            THEN 'train' ELSE 'valid' END AS split
FROM orders
"""


def q_kfold_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kfold_hash(table(spark, sf_dir, "orders"), "o_orderkey", 3, 42).select("o_orderkey", "fold")


SQL_KFOLD_HASH = f"""
SELECT o_orderkey, CAST({_hex32("CAST(o_orderkey AS VARCHAR) || ':fold:42'")} % 3 AS INTEGER) AS fold
FROM orders
"""


def q_sample_exact_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_exact_n(table(spark, sf_dir, "events"), "event_id", 300, 123).select(
        "event_id", "user_id", "event_type", "value")


SQL_SAMPLE_EXACT_N = """
SELECT event_id, user_id, event_type, value FROM events
ORDER BY md5(CAST(event_id AS VARCHAR) || ':sample:123'), event_id LIMIT 300
"""


def _orders_nulled(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return with_nulls(o, cols=ORDER_FEATS, key="o_orderkey")


def q_drift_batch_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = generate_drift_batch(_orders_nulled(spark, sf_dir), "o_orderkey", 300, 123, ADJUST)
    return b.select("o_orderkey", F.round("o_totalprice", R).alias("o_totalprice"),
                    F.round("o_custkey", R).alias("o_custkey"))


_SQL_SAMPLE = """
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS tp,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS ck
  FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':sample:123'), o_orderkey LIMIT 300
"""
_SQL_BATCH = f"""
  WITH s AS ({_SQL_SAMPLE}),
       m AS (SELECT quantile_cont(tp, 0.5) AS mt, quantile_cont(ck::DOUBLE, 0.5) AS mc FROM s)
  SELECT o_orderkey, COALESCE(tp, m.mt) * 1.5 AS o_totalprice, COALESCE(ck::DOUBLE, m.mc) + 8.0 AS o_custkey
  FROM s, m
"""
SQL_DRIFT_BATCH_GENERATED = f"""
SELECT o_orderkey, round(o_totalprice, {R}) AS o_totalprice, round(o_custkey, {R}) AS o_custkey
FROM ({_SQL_BATCH})
"""


def q_monitor_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline = orders before 1996 (uniform expectation, linspace levels as
    in the reference); new = the generated drifted batch."""
    o = _orders_nulled(spark, sf_dir)
    base = o.where(F.col("o_orderdate") < cutoff_col())
    batch = generate_drift_batch(o, "o_orderkey", 300, 123, ADJUST)
    spec = DriftSpec(features=tuple(ORDER_FEATS), levels="linspace", expected="uniform")
    report, _ = monitor(base, batch, spec)
    out = with_status(report, spec.alert, spec.warn)
    return out.select("feature", F.round("psi", R).alias("psi"), "bins", "new_total",
                      F.round("max_psi", R).alias("max_psi"), "status", "retrain")


_BASE_ORD = f"""(SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
                        CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey
                 FROM orders WHERE o_orderdate < {SQL_CUTOFF})"""
SQL_MONITOR_JOB = f"""
WITH prof AS ({S.profile_cte(_BASE_ORD, ORDER_FEATS, 10, "linspace")}),
     nb AS ({_SQL_BATCH}),
     nh AS ({S.hist_open_cte('nb', ORDER_FEATS, 'prof')}),
     t AS (SELECT h.feature, len(p.cuts) + 1 AS bins, h.n, 1.0 / (len(p.cuts) + 1) AS p_raw
           FROM nh h JOIN prof p USING (feature)),
     s AS (SELECT *, p_raw / (sum(p_raw) OVER (PARTITION BY feature) + {S.dbl(PSI_EPS)}) AS p,
                  n::DOUBLE / (sum(n) OVER (PARTITION BY feature)::DOUBLE + {S.dbl(PSI_EPS)}) AS q FROM t),
     rep AS (SELECT feature, sum((p - q) * ln((p + {S.dbl(PSI_EPS)}) / (q + {S.dbl(PSI_EPS)}))) AS psi,
                    CAST(max(bins) AS INTEGER) AS bins, sum(n)::BIGINT AS new_total FROM s GROUP BY feature)
SELECT feature, round(psi, {R}) AS psi, bins, new_total,
       round(max(psi) OVER (), {R}) AS max_psi,
       CASE WHEN max(psi) OVER () >= 0.25 THEN 'ALERT' WHEN max(psi) OVER () >= 0.1 THEN 'WARN' ELSE 'OK' END AS status,
       CASE WHEN max(psi) OVER () >= 0.25 THEN 1 ELSE 0 END AS retrain
FROM rep
"""

QUERIES = {
    "split_hash": q_split_hash,
    "kfold_hash": q_kfold_hash,
    "sample_exact_n": q_sample_exact_n,
    "drift_batch_generated": q_drift_batch_generated,
    "monitor_job": q_monitor_job,
}

ORACLES = {
    "split_hash": SQL_SPLIT_HASH,
    "kfold_hash": SQL_KFOLD_HASH,
    "sample_exact_n": SQL_SAMPLE_EXACT_N,
    "drift_batch_generated": SQL_DRIFT_BATCH_GENERATED,
    "monitor_job": SQL_MONITOR_JOB,
}
