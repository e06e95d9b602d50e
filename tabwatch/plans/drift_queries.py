"""Registered drift queries (profiles, histograms, PSI, status) and oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators.drift import drift_status, psi_raw_sample, psi_report
from tabwatch.operators.histogram import histogram_closed, histogram_open
from tabwatch.operators.profile import build_profile, quantile_edges, row_count
from tabwatch.operators.quantiles import KLL_K, feature_sketches, median_exact, merge_sketches, quantiles, sketch_quantiles
from tabwatch.operators.reshape import to_long
from tabwatch.plans import sqlfrag as S
from tabwatch.plans.tables import (NUM_FEATURES, SQL_CUTOFF, cutoff_col, lineitem_baseline, lineitem_new,
                                   sql_nulls, table, with_nulls)
from tabwatch.spec import PSI_EPS, RAW_LAST_EDGE_PAD, RAW_SHARE_FLOOR

FEATS = list(NUM_FEATURES)
BINS = 10
R = 6  # decimals in reports
DECILES = [i / 10 for i in range(11)]
RANK_ERROR = 0.01           # of an estimated quantile, as a share of the rows

BASE_SQL = f"(SELECT * FROM lineitem WHERE l_shipdate < {SQL_CUTOFF})"
NEW_SQL = f"(SELECT * FROM lineitem WHERE l_shipdate >= {SQL_CUTOFF})"
NULLED_SQL = ("(SELECT l_orderkey, l_linenumber, "
              + ", ".join(f"{sql_nulls(c)} AS {c}" for c in FEATS) + " FROM lineitem)")


def _profile(spark, sf_dir, levels="exact", counts=True):
    return build_profile(lineitem_baseline(spark, sf_dir), FEATS, BINS, levels,
                         with_counts=counts)


def _report_cols(rep: DataFrame) -> DataFrame:
    return rep.select("feature", F.round("psi", R).alias("psi"), "bins", "new_total")


# ---------------------------------------------------------------- PSI reports

def q_psi_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = _profile(spark, sf_dir, counts=False)
    return _report_cols(psi_report(prof, lineitem_new(spark, sf_dir), "uniform"))


def q_psi_empirical(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = _profile(spark, sf_dir)
    return _report_cols(psi_report(prof, lineitem_new(spark, sf_dir), "empirical"))


def q_psi_raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = psi_raw_sample(lineitem_baseline(spark, sf_dir), lineitem_new(spark, sf_dir), FEATS, BINS)
    return _report_cols(rep)


def _sql_psi(expected: str, rounded: bool = True) -> str:
    prof = S.profile_cte(BASE_SQL, FEATS, BINS, "exact")
    if expected == "uniform":
        p_raw = "1.0 / (len(p.cuts) + 1)"
        extra = ""
    else:
        p_raw = "bh.n::DOUBLE"
        extra = f", bh AS ({S.hist_open_cte(BASE_SQL, FEATS, 'prof')})"
    join_bh = "JOIN bh ON bh.feature = h.feature AND bh.bin = h.bin" if expected != "uniform" else ""
    return f"""
    WITH prof AS ({prof}),
         nh AS ({S.hist_open_cte(NEW_SQL, FEATS, 'prof')}){extra},
         t AS (
           SELECT h.feature, p.pos, len(p.cuts) + 1 AS bins, h.bin, h.n, {p_raw} AS p_raw
           FROM nh h JOIN prof p USING (feature) {join_bh}
         ),
         s AS (
           SELECT *, p_raw / (sum(p_raw) OVER (PARTITION BY feature) + {S.dbl(PSI_EPS)}) AS p,
                  n::DOUBLE / (sum(n) OVER (PARTITION BY feature)::DOUBLE + {S.dbl(PSI_EPS)}) AS q
           FROM t
         )
    SELECT feature,
           {_rnd("sum((p - q) * ln((p + " + S.dbl(PSI_EPS) + ") / (q + " + S.dbl(PSI_EPS) + ")))", rounded)} AS psi,
           CAST(max(bins) AS INTEGER) AS bins, sum(n)::BIGINT AS new_total
    FROM s GROUP BY feature
    """


def _rnd(expr: str, rounded: bool) -> str:
    return f"round({expr}, {R})" if rounded else expr


def _sql_raw_edges() -> str:
    lv = S.level_list(BINS, "percent")
    return f"""
      SELECT feature,
             list_concat(e[1:len(e)-1], [e[len(e)] + {S.dbl(RAW_LAST_EDGE_PAD)}]) AS edges
      FROM (SELECT feature, quantile_cont(value, {lv}) AS e
            FROM {S.long_values(BASE_SQL, FEATS)} GROUP BY feature)
    """


def _sql_hist_closed(source: str) -> str:
    """(feature, bin, n) for closed-range percentile breakpoints."""
    return f"""
      SELECT g.feature, g.bin, COALESCE(c.n, 0)::BIGINT AS n
      FROM (SELECT feature, unnest(range(0, len(edges) - 1)) AS bin FROM rb) g
      LEFT JOIN (
        SELECT v.feature, len(list_filter(rb.edges[1:len(rb.edges)-1], lambda x: x <= v.value)) - 1 AS bin,
               count(*) AS n
        FROM {S.long_values(source, FEATS)} v JOIN rb USING (feature)
        WHERE v.value >= rb.edges[1] AND v.value <= rb.edges[len(rb.edges)]
        GROUP BY ALL
      ) c ON c.feature = g.feature AND c.bin = g.bin
    """


def _sql_psi_raw(rounded: bool = True) -> str:
    return f"""
WITH rb AS ({_sql_raw_edges()}),
     eh AS ({_sql_hist_closed(BASE_SQL)}),
     ah AS ({_sql_hist_closed(NEW_SQL)}),
     et AS (SELECT feature, count(*) AS tot FROM {S.long_values(BASE_SQL, FEATS)} GROUP BY feature),
     ntot AS (SELECT feature, count(*) AS tot FROM {S.long_values(NEW_SQL, FEATS)} GROUP BY feature),
     t AS (
       SELECT eh.feature, eh.bin,
              CASE WHEN eh.n = 0 THEN {S.dbl(RAW_SHARE_FLOOR)} ELSE eh.n::DOUBLE / et.tot::DOUBLE END AS e_p,
              CASE WHEN ah.n = 0 THEN {S.dbl(RAW_SHARE_FLOOR)} ELSE ah.n::DOUBLE / ntot.tot::DOUBLE END AS a_p,
              ntot.tot AS a_tot
       FROM eh JOIN ah USING (feature, bin) JOIN et USING (feature) JOIN ntot USING (feature)
     )
SELECT feature, {_rnd("sum((a_p - e_p) * ln(a_p / e_p))", rounded)} AS psi,
       CAST(count(*) AS INTEGER) AS bins, max(a_tot)::BIGINT AS new_total
FROM t GROUP BY feature
"""


SQL_PSI_RAW = _sql_psi_raw()

# ----------------------------------------------------------- profile pieces

def q_quantile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct deciles (linspace levels) of the null-injected table,
    with the open-ended bin count."""
    df = with_nulls(table(spark, sf_dir, "lineitem"))
    e = quantile_edges(df, FEATS, BINS, levels="linspace")
    return e.select("feature", F.posexplode("edges").alias("edge_idx", "edge"), "n",
                    F.when(F.size("edges") >= 3, F.size("edges") - 1).otherwise(1).alias("bins")) \
            .select("feature", F.col("edge_idx").cast("int").alias("edge_idx"),
                    F.round("edge", R).alias("edge"), "n", F.col("bins").cast("int").alias("bins"))


SQL_QUANTILE_EDGES = f"""
WITH prof AS ({S.profile_cte(NULLED_SQL, FEATS, BINS, "linspace")})
SELECT feature, CAST(i - 1 AS INTEGER) AS edge_idx, round(edges[i], {R}) AS edge, n::BIGINT AS n,
       CAST(len(cuts) + 1 AS INTEGER) AS bins
FROM prof, LATERAL (SELECT unnest(range(1, len(edges) + 1)) AS i)
"""


def _rank_errors(df: DataFrame, found: DataFrame) -> DataFrame:
    """``(feature, level_idx, level, n, within)``: whether each estimated quantile's rank,
    counted exactly, lies within RANK_ERROR of its level."""
    long = to_long(df, FEATS).where(~F.isnan("value"))
    marks = found.select("feature", "level_idx", "level", "quantile")
    counts = long.join(F.broadcast(marks), "feature").groupBy("feature", "level_idx", "level").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto"))
    target, slack = F.col("level") * F.col("n"), RANK_ERROR * F.col("n") + 1
    return counts.select("feature", F.col("level_idx").cast("int").alias("level_idx"), F.round("level", R).alias("level"), "n",
                         ((F.col("below") <= target + slack) & (F.col("upto") >= target - slack)).alias("within"))


def q_quantiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles by ``percentile_approx``, held against the exact ranks of the whole table."""
    df = with_nulls(table(spark, sf_dir, "lineitem"))
    return _rank_errors(df, quantiles(df, FEATS, DECILES, "approx"))


def q_quantiles_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles from KLL sketches of two halves of the table, merged as an incremental
    baseline is, held against the exact ranks of the whole table."""
    df = with_nulls(table(spark, sf_dir, "lineitem"))
    early = F.col("l_shipdate") < cutoff_col()
    halves = feature_sketches(df.where(early), FEATS, KLL_K).unionByName(feature_sketches(df.where(~early), FEATS, KLL_K))
    return _rank_errors(df, sketch_quantiles(merge_sketches(halves), DECILES))


SQL_QUANTILE_RANKS = f"""
WITH l AS (SELECT unnest([{", ".join(f"'{f}'" for f in FEATS)}]) AS feature, unnest([{", ".join(f"{f}::DOUBLE" for f in FEATS)}]) AS value FROM {NULLED_SQL})
SELECT feature, CAST(i AS INTEGER) AS level_idx, round(i / 10.0, {R}) AS level, count(value)::BIGINT AS n, true AS within
FROM l, (SELECT unnest(range(0, 11)) AS i) GROUP BY feature, i
"""


def q_histogram_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = _profile(spark, sf_dir, counts=False)
    return histogram_open(lineitem_new(spark, sf_dir), prof).select(
        "feature", F.col("bin").cast("int").alias("bin"), "n")


SQL_HISTOGRAM_OPEN = f"""
WITH prof AS ({S.profile_cte(BASE_SQL, FEATS, BINS, "exact")})
SELECT feature, CAST(bin AS INTEGER) AS bin, n FROM ({S.hist_open_cte(NEW_SQL, FEATS, 'prof')})
"""


def q_histogram_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    from tabwatch.operators.drift import raw_breakpoints
    bp = raw_breakpoints(lineitem_baseline(spark, sf_dir), FEATS, BINS)
    h = histogram_closed(lineitem_new(spark, sf_dir), bp, keep_outside=True)
    total = F.sum("n").over(Window.partitionBy("feature"))     # features x bins rows
    share = F.col("n").cast("double") / total.cast("double")
    h = h.withColumn("share", share).where("bin >= 0")
    return h.select("feature", F.col("bin").cast("int").alias("bin"), "n",
                    F.round(F.when(F.col("share") == 0, F.lit(RAW_SHARE_FLOOR)).otherwise(F.col("share")), R).alias("share"))


SQL_HISTOGRAM_CLOSED = f"""
WITH rb AS ({_sql_raw_edges()}),
     ah AS ({_sql_hist_closed(NEW_SQL)}),
     ntot AS (SELECT feature, count(*) AS tot FROM {S.long_values(NEW_SQL, FEATS)} GROUP BY feature)
SELECT feature, CAST(bin AS INTEGER) AS bin, n,
       round(CASE WHEN n = 0 THEN {S.dbl(RAW_SHARE_FLOOR)} ELSE n::DOUBLE / tot::DOUBLE END, {R}) AS share
FROM ah JOIN ntot USING (feature)
"""


def q_bin_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of total per bin of the baseline's own histogram."""
    from pyspark.sql import Window
    prof = _profile(spark, sf_dir, counts=False)
    h = histogram_open(lineitem_baseline(spark, sf_dir), prof)
    w = Window.partitionBy("feature")
    share = F.col("n").cast("double") / (F.sum("n").over(w).cast("double") + F.lit(PSI_EPS))
    return h.select("feature", F.col("bin").cast("int").alias("bin"), "n",
                    F.round(share, R).alias("share"))


SQL_BIN_SHARES = f"""
WITH prof AS ({S.profile_cte(BASE_SQL, FEATS, BINS, "exact")}),
     h AS ({S.hist_open_cte(BASE_SQL, FEATS, 'prof')})
SELECT feature, CAST(bin AS INTEGER) AS bin, n,
       round(n::DOUBLE / (sum(n) OVER (PARTITION BY feature)::DOUBLE + {S.dbl(PSI_EPS)}), {R}) AS share
FROM h
"""


def q_median_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_nulls(table(spark, sf_dir, "lineitem"))
    m = median_exact(df, FEATS)
    return m.select("feature", F.round("median", R).alias("median"), "n")


SQL_MEDIAN_EXACT = f"""
SELECT feature, round(quantile_cont(value, 0.5), {R}) AS median, count(*)::BIGINT AS n
FROM {S.long_values(NULLED_SQL, FEATS)} GROUP BY feature
"""


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


SQL_ROW_COUNT = "SELECT count(*)::BIGINT AS n_rows FROM lineitem"

# ---------------------------------------------------------------- status

def _status_cols(st: DataFrame) -> DataFrame:
    return st.select(F.round("max_psi", R).alias("max_psi"), "status", "trigger", "retrain",
                     "worst_feature", F.round("worst_psi", R).alias("worst_psi"), "n_features")


def q_drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-level status over the uniform-expectation report (compat mode)."""
    prof = _profile(spark, sf_dir, counts=False)
    rep = psi_report(prof, lineitem_new(spark, sf_dir), "uniform")
    return _status_cols(drift_status(rep, alert=0.25, warn=0.10))


def q_drift_status_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = psi_raw_sample(lineitem_baseline(spark, sf_dir), lineitem_new(spark, sf_dir), FEATS, BINS)
    return _status_cols(drift_status(rep, alert=0.25, warn=None))


def q_worst_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = _profile(spark, sf_dir)
    rep = psi_report(prof, lineitem_new(spark, sf_dir), "empirical")
    st = drift_status(rep, alert=0.25, warn=0.10)
    return st.select("worst_feature", F.round("worst_psi", R).alias("worst_psi"),
                     F.concat(F.lit("psi_"), F.col("worst_feature")).alias("metric_name"))


def _sql_status(report_sql: str, alert: float, warn: float | None) -> str:
    warn_case = f"WHEN bool_or(psi >= {S.dbl(warn)}) THEN 'WARN'" if warn is not None else ""
    warn_trig = f"WHEN bool_or(psi >= {S.dbl(warn)}) THEN '>= {warn}'" if warn is not None else ""
    return f"""
    WITH rep AS ({report_sql}),
         pos AS {S.features_values(FEATS)},
         w AS (SELECT feature, psi FROM rep JOIN pos USING (feature) ORDER BY psi DESC, pos ASC LIMIT 1)
    SELECT round(COALESCE(max(psi), 0.0), {R}) AS max_psi,
           CASE WHEN bool_or(psi >= {S.dbl(alert)}) THEN 'ALERT' {warn_case} ELSE 'OK' END AS status,
           CASE WHEN bool_or(psi >= {S.dbl(alert)}) THEN '>= {alert}' {warn_trig} END AS trigger,
           CASE WHEN bool_or(psi >= {S.dbl(alert)}) THEN 1 ELSE 0 END AS retrain,
           (SELECT feature FROM w) AS worst_feature,
           round((SELECT psi FROM w), {R}) AS worst_psi,
           count(*)::BIGINT AS n_features
    FROM rep
    """


SQL_PSI_UNIFORM = _sql_psi("uniform")
SQL_PSI_EMPIRICAL = _sql_psi("empirical")
SQL_DRIFT_STATUS = _sql_status(_sql_psi('uniform', False), 0.25, 0.10)
SQL_DRIFT_STATUS_TWO = _sql_status(_sql_psi_raw(False), 0.25, None)
SQL_WORST_FEATURE = f"""
WITH rep AS ({_sql_psi('empirical', False)}), pos AS {S.features_values(FEATS)}
SELECT feature AS worst_feature, round(psi, {R}) AS worst_psi, 'psi_' || feature AS metric_name
FROM rep JOIN pos USING (feature) ORDER BY psi DESC, pos ASC LIMIT 1
"""

def q_drift_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log rows of a monitor run; the run is named after the newest ship
    date of the batch (epoch seconds), so the rows are reproducible."""
    from tabwatch.operators.drift import monitor_log_rows, run_name
    from tabwatch.spec import DriftSpec
    new = lineitem_new(spark, sf_dir)
    from tabwatch.functions.timeparts import ntz_epoch_seconds
    ts = new.agg(F.max(ntz_epoch_seconds(F.col("l_shipdate"))).alias("t")).first()["t"]
    spec = DriftSpec(features=tuple(FEATS), n_bins=BINS, expected="uniform")
    rep = psi_report(_profile(spark, sf_dir, counts=False), new, "uniform")
    st = drift_status(rep, spec.alert, spec.warn)
    rows = monitor_log_rows(rep, st, spec, run_name(ts), model_name="lineitem_rf")
    return rows.select("run_id", "kind", "key", F.round("value", R).alias("value"), "text")


def _sql_run_log() -> str:
    rep = _sql_psi("uniform", False)
    st = _sql_status(rep, 0.25, 0.10)
    rid = f"'drift_' || CAST((SELECT max(epoch(l_shipdate)) FROM {NEW_SQL}) AS BIGINT)"
    return f"""
    WITH rep AS ({rep}), st AS ({st})
    SELECT {rid} AS run_id, 'metric' AS kind, 'psi_' || feature AS key, round(psi, {R}) AS value,
           NULL::VARCHAR AS text FROM rep
    UNION ALL SELECT {rid}, 'metric', 'psi_worst', max_psi, NULL FROM st
    UNION ALL SELECT {rid}, 'metric', 'retraining_triggered', CAST(retrain AS DOUBLE), NULL FROM st
    UNION ALL SELECT {rid}, 'param', 'drift_status', NULL, status FROM st
    UNION ALL SELECT {rid}, 'tag', 'psi_worst_feature', NULL, worst_feature FROM st
    UNION ALL SELECT {rid}, 'param', 'psi_bins', NULL, '10'
    UNION ALL SELECT {rid}, 'param', 'psi_warn', NULL, '0.1'
    UNION ALL SELECT {rid}, 'param', 'psi_alert', NULL, '0.25'
    UNION ALL SELECT {rid}, 'tag', 'model_name', NULL, 'lineitem_rf'
    UNION ALL SELECT {rid}, 'tag', 'model_stage', NULL, 'Production'
    """


SQL_DRIFT_RUN_LOG = _sql_run_log()

QUERIES = {
    "drift_run_log": q_drift_run_log,
    "psi_uniform": q_psi_uniform,
    "psi_empirical": q_psi_empirical,
    "psi_raw_sample": q_psi_raw_sample,
    "quantile_edges": q_quantile_edges,
    "quantiles_approx": q_quantiles_approx,
    "quantiles_sketch": q_quantiles_sketch,
    "histogram_open": q_histogram_open,
    "histogram_closed": q_histogram_closed,
    "bin_shares": q_bin_shares,
    "median_exact": q_median_exact,
    "row_count": q_row_count,
    "drift_status": q_drift_status,
    "drift_status_two_level": q_drift_status_two_level,
    "worst_feature": q_worst_feature,
}

ORACLES = {
    "drift_run_log": SQL_DRIFT_RUN_LOG,
    "psi_uniform": SQL_PSI_UNIFORM,
    "psi_empirical": SQL_PSI_EMPIRICAL,
    "psi_raw_sample": SQL_PSI_RAW,
    "quantile_edges": SQL_QUANTILE_EDGES,
    "quantiles_approx": SQL_QUANTILE_RANKS,
    "quantiles_sketch": SQL_QUANTILE_RANKS,
    "histogram_open": SQL_HISTOGRAM_OPEN,
    "histogram_closed": SQL_HISTOGRAM_CLOSED,
    "bin_shares": SQL_BIN_SHARES,
    "median_exact": SQL_MEDIAN_EXACT,
    "row_count": SQL_ROW_COUNT,
    "drift_status": SQL_DRIFT_STATUS,
    "drift_status_two_level": SQL_DRIFT_STATUS_TWO,
    "worst_feature": SQL_WORST_FEATURE,
}
