"""Population Stability Index (PSI) reports, drift status and the monitor job.

PSI = sum over bins of (p - q) * ln((p + eps) / (q + eps)) where p are the
expected (baseline) shares and q the new batch's shares, each share being
``count / (total + eps)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.functions.levels import quantile_levels
from tabwatch.operators.histogram import histogram_closed, histogram_open
from tabwatch.operators.profile import build_profile
from tabwatch.operators.quantiles import feature_quantiles
from tabwatch.operators.reshape import features_frame
from tabwatch.spec import (DRIFT_BATCH_ROWS, DRIFT_BATCH_SEED, PSI_EPS, RAW_LAST_EDGE_PAD,
                           RAW_SHARE_FLOOR, DriftSpec)
from tabwatch.session import local_frame


def psi_term(p: Column, q: Column, eps: float = PSI_EPS) -> Column:
    return (p - q) * F.ln((p + F.lit(eps)) / (q + F.lit(eps)))


def expected_grid(profile: DataFrame, expected: str = "empirical") -> DataFrame:
    """``(feature, pos, bin, bins, p_raw, p_sum)``: every bin of the profile with
    its unnormalised expected weight (1/bins, or the baseline's count) and their
    sum.  Empirical weights need a profile with counts for every feature."""
    if expected == "uniform":
        weights = F.array_repeat(F.lit(1.0) / F.col("bins").cast("double"), F.col("bins"))
    elif expected == "empirical":
        if "counts" not in profile.columns:
            raise ValueError("empirical shares need the baseline's bin counts, which this profile lacks")
        bare = [r["feature"] for r in profile.where("counts IS NULL").select("feature").collect()]   # of a row per feature
        if bare:
            raise ValueError(f"empirical shares need the baseline's bin counts; none stored for {bare}: "
                             "rebuild the baseline or score with uniform shares")
        weights = F.col("counts").cast("array<double>")
    else:
        raise ValueError(f"unknown expected mode {expected!r}")
    total = F.aggregate(weights, F.lit(0.0), lambda t, x: t + x)
    return profile.select("feature", "pos", "bins", total.alias("p_sum"),
                          F.posexplode(F.slice(weights, F.lit(1), F.col("bins"))).alias("bin", "p_raw"))


def score_counts(counts: DataFrame, grid: DataFrame, keys: Sequence[str] = (),
                 eps: float = PSI_EPS) -> DataFrame:
    """PSI per ``(*keys, feature)`` from observed ``(*keys, feature, bin, n)``
    counts and an expected grid.  Every group present in ``counts`` gets all
    of its feature's bins (missing ones count 0); without ``keys``, so does
    every feature of the grid.  ``counts`` is read once: a group's bins are
    gathered into one map, bounded by the bins of a feature.
    """
    keys = list(keys)
    groups = counts.groupBy(*keys, "feature").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct(F.col("bin").cast("int"), "n"))).alias("seen"))
    full = grid.join(groups, "feature", "inner" if keys else "left")
    n = F.coalesce(F.try_element_at("seen", F.col("bin").cast("int")), F.lit(0)).cast("bigint")
    total = F.coalesce("total", F.lit(0)).cast("double")
    full = full.withColumns({"n": n, "p": F.col("p_raw") / (F.col("p_sum") + F.lit(eps)),
                             "q": n.cast("double") / (total + F.lit(eps))})
    return full.groupBy(*keys, "feature", "pos", "bins").agg(
        F.sum(psi_term(F.col("p"), F.col("q"), eps)).alias("psi"),
        F.sum("n").cast("bigint").alias("new_total"))


def psi_report(profile: DataFrame, new_df: DataFrame, expected: str = "empirical",
               eps: float = PSI_EPS, annotate: bool = False) -> DataFrame:
    """``(feature, psi, bins, new_total)``, one row per profiled feature.

    expected="uniform": each bin expects 1/bins (compat; wrong under tied
    edges).  expected="empirical": the baseline's stored bin counts.
    ``annotate`` adds ``note``: 'unmeasurable' for a single bin, 'no_data' for
    an empty new column, else 'ok'.
    """
    grid = expected_grid(profile, expected)
    hist = histogram_open(new_df, profile, zero_fill=False)   # the grid fills zeros
    rep = score_counts(hist, grid, eps=eps)
    cols = ["feature", "psi", F.col("bins").cast("int").alias("bins"), "new_total", "pos"]
    if annotate:
        cols.append(F.when(F.col("bins") <= 1, "unmeasurable")
                     .when(F.col("new_total") == 0, "no_data").otherwise("ok").alias("note"))
    return rep.select(*cols)


def psi(baseline_df: DataFrame, new_df: DataFrame, spec: DriftSpec) -> DataFrame:
    """Build the baseline profile from ``baseline_df`` and score ``new_df``."""
    prof = build_profile(baseline_df, spec.features, spec.n_bins, spec.levels,
                         spec.quantile_method, with_counts=spec.expected == "empirical")
    return psi_report(prof, new_df, spec.expected, spec.eps)


def raw_breakpoints(expected_df: DataFrame, features: Sequence[str], buckets: int = 10,
                    levels: str = "percent") -> DataFrame:
    """``(feature, edges, e_counts, e_total)``: percentiles of the expected
    sample (duplicates kept, last breakpoint raised by 1e-6 so the maximum
    falls inside) and the expected sample's own rows per closed-range bin.

    The counts come from the exact selection's rows-below bookkeeping: bin i
    holds below(e_i+1) - below(e_i), the last bin every row from e_B-1 up;
    nothing lies below the first breakpoint (the minimum).  No extra scan.
    """
    q = feature_quantiles(expected_df, features, quantile_levels(buckets, levels))
    per: dict[str, list] = {}
    for r in q.select("feature", "level_idx", "quantile", "below", "n").collect():   # features x levels
        per.setdefault(r["feature"], []).append(
            (int(r["level_idx"]), float(r["quantile"]), int(r["below"]), int(r["n"])))
    rows = []
    for f, qs in per.items():
        qs.sort()
        e = [x for _, x, _, _ in qs]
        below = [b for _, _, b, _ in qs]
        n = qs[0][3]
        counts = [below[i + 1] - below[i] for i in range(len(e) - 2)] + [n - below[-2]]
        e[-1] = e[-1] + RAW_LAST_EDGE_PAD
        rows.append((f, e, counts, n))
    return local_frame(expected_df.sparkSession, rows,
                       "feature string, edges array<double>, e_counts array<bigint>, e_total bigint")


def psi_raw_sample(expected_df: DataFrame, actual_df: DataFrame, features: Sequence[str],
                   buckets: int = 10, levels: str = "percent") -> DataFrame:
    """PSI between two raw samples with closed-range percentile breakpoints.

    Shares are ``count / non-null rows`` (values outside the expected range
    are dropped from the counts but stay in the denominator); empty shares
    are floored to 1e-6.  A feature that is absent from the new data or all
    null there is skipped.  -> ``(feature, psi, bins, new_total)``

    Passes: the exact selection over the expected sample (its bin counts
    come with it) and one histogram pass over the new sample.
    """
    present = [f for f in features if f in actual_df.columns and f in expected_df.columns]
    bp = raw_breakpoints(expected_df, present, buckets, levels)
    e_h = bp.select("feature", F.posexplode("e_counts").alias("bin", "e_n"), "e_total") \
            .withColumn("bin", F.col("bin").cast("int"))
    # in-range bins plus an out-of-range bin (-1), whose sum is the new
    # sample's non-null total (the shares' denominator)
    a_h = histogram_closed(actual_df, bp, keep_outside=True).withColumnRenamed("n", "a_n")
    w = Window.partitionBy("feature")   # features x bins rows
    a_h = a_h.withColumn("a_total", F.sum("a_n").over(w))
    # a feature with no value in either sample is skipped (no division by zero)
    t = (e_h.join(a_h.where(F.col("bin") >= 0), ["feature", "bin"])
            .where((F.col("e_total") > 0) & (F.col("a_total") > 0)))
    floor = F.lit(RAW_SHARE_FLOOR)
    e_p = F.col("e_n").cast("double") / F.col("e_total").cast("double")
    a_p = F.col("a_n").cast("double") / F.col("a_total").cast("double")
    t = (t.withColumn("e_p", F.when(e_p == 0, floor).otherwise(e_p))
          .withColumn("a_p", F.when(a_p == 0, floor).otherwise(a_p)))
    pos = features_frame(expected_df, list(features))
    rep = t.groupBy("feature").agg(
        F.sum((F.col("a_p") - F.col("e_p")) * F.ln(F.col("a_p") / F.col("e_p"))).alias("psi"),
        F.count(F.lit(1)).cast("int").alias("bins"),
        F.max("a_total").cast("bigint").alias("new_total"))
    return rep.join(pos, "feature").select("feature", "psi", "bins", "new_total", "pos")


def drift_status(report: DataFrame, alert: float = 0.25, warn: float | None = 0.10,
                 pos_col: str = "pos") -> DataFrame:
    """One row: ``max_psi, status, trigger, retrain, worst_feature, worst_psi, n_features``.

    ALERT if any psi >= alert, else UNKNOWN if any psi is null (it could not be
    measured), else WARN if any psi >= warn (when warn is set), else OK.  The
    worst feature is the largest psi, first in feature order on ties.  An
    empty report gives OK with max_psi 0.
    """
    worst = F.max(F.struct(F.when(~F.isnan("psi"), F.col("psi")).alias("psi"), (-F.col(pos_col)).alias("neg_pos"),
                           F.col("feature").alias("feature")))
    agg = report.agg(
        F.coalesce(F.max(F.when(~F.isnan("psi"), F.col("psi"))), F.lit(0.0)).alias("max_psi"),
        F.coalesce(F.bool_or(~F.isnan("psi") & (F.col("psi") >= F.lit(alert))), F.lit(False)).alias("_a"),
        (F.coalesce(F.bool_or(F.col("psi") >= F.lit(warn)), F.lit(False)) if warn is not None
         else F.lit(False)).alias("_w"),
        F.coalesce(F.bool_or(F.col("psi").isNull() | F.isnan("psi")), F.lit(False)).alias("_u"),
        worst.alias("_worst"),
        F.count(F.lit(1)).alias("n_features"))
    status = F.when(F.col("_a"), "ALERT").when(F.col("_u"), "UNKNOWN").when(F.col("_w"), "WARN").otherwise("OK")
    trigger = (F.when(F.col("_a"), F.lit(f">= {alert}")).when(F.col("_u"), F.lit("no psi"))
                .when(F.col("_w"), F.lit(f">= {warn}")))
    return agg.select(
        "max_psi", status.alias("status"), trigger.alias("trigger"),
        F.when(F.col("_a"), 1).otherwise(0).alias("retrain"),
        F.col("_worst.feature").alias("worst_feature"),
        F.col("_worst.psi").alias("worst_psi"),
        "n_features")


def with_status(report: DataFrame, alert: float = 0.25, warn: float | None = 0.10) -> DataFrame:
    """The report with the overall status repeated on each row.

    The report has one row per configured feature, so the un-keyed window
    below stays configuration-sized.
    """
    w = Window.partitionBy()
    any_a = F.max((F.col("psi") >= F.lit(alert)).cast("int")).over(w) == 1
    any_u = F.max((F.col("psi").isNull() | F.isnan("psi")).cast("int")).over(w) == 1
    any_w = (F.max((F.col("psi") >= F.lit(warn)).cast("int")).over(w) == 1) if warn is not None else F.lit(False)
    return (report.withColumn("max_psi", F.max("psi").over(w))
                  .withColumn("status", F.when(any_a, "ALERT").when(any_u, "UNKNOWN").when(any_w, "WARN").otherwise("OK"))
                  .withColumn("retrain", F.when(any_a, 1).otherwise(0)))


def generate_drift_batch(df: DataFrame, key: str, n: int = DRIFT_BATCH_ROWS, seed: int = DRIFT_BATCH_SEED,
                         adjust: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """A synthetic drifted batch: exactly min(n, rows) rows chosen by key hash,
    then for each column present in ``adjust`` = {col: (scale, shift)}: nulls
    filled with the sample's interpolated median, then ``x * scale + shift``.
    """
    from tabwatch.operators.sampling import sample_exact_n
    from tabwatch.operators.prep import fill_median, shift_scale
    from tabwatch.session import materialize
    # the sample is bounded by n and read by several passes: written once
    sample = materialize(sample_exact_n(df, key, n, seed), "drift_sample")
    adjust = {c: v for c, v in (adjust or {}).items() if c in sample.columns}
    if not adjust:
        return sample
    filled = fill_median(sample, list(adjust))
    return shift_scale(filled, adjust)


def monitor(baseline_df: DataFrame, new_df: DataFrame, spec: DriftSpec,
            required: bool = True, formula: str = "binned") -> tuple[DataFrame, DataFrame]:
    """End-to-end drift check -> (report, status).

    formula="binned": equal-frequency baseline profile, PSI per feature with
    ``spec.expected`` shares, three-level status (warn and alert).
    formula="raw": the raw-sample formula (closed percentile breakpoints,
    1e-6 floor) with the two-level status (alert only).
    """
    from tabwatch.operators.prep import require_columns
    if required:
        require_columns(new_df, spec.features)
    if formula == "binned":
        report = psi(baseline_df, new_df, spec)
        return report, drift_status(report, spec.alert, spec.warn)
    if formula == "raw":
        report = psi_raw_sample(baseline_df, new_df, spec.features, spec.n_bins)
        return report, drift_status(report, spec.alert, None)
    raise ValueError(f"unknown formula {formula!r}")


def run_name(epoch_seconds: int, prefix: str = "drift") -> str:
    """``drift_<epoch seconds>``."""
    return f"{prefix}_{int(epoch_seconds)}"


def monitor_log_rows(report: DataFrame, status: DataFrame, spec: DriftSpec, run_id: str,
                     model_name: str = "model", model_stage: str = "Production",
                     paths: dict[str, str] | None = None) -> DataFrame:
    """Run-log rows ``(run_id, kind, key, value, text)`` of one monitor run:
    metrics ``psi_<feature>``, ``psi_worst``, ``retraining_triggered``;
    params ``psi_bins``, ``psi_warn``, ``psi_alert``, ``drift_status``;
    tags ``model_name``, ``model_stage``, ``psi_worst_feature`` and those of
    ``paths`` (``new_data_path``, ``baseline_path``)."""
    spark = report.sparkSession
    rid = F.lit(run_id)
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    metrics = report.select(rid.alias("run_id"), F.lit("metric").alias("kind"),
                            F.concat(F.lit("psi_"), F.col("feature")).alias("key"),
                            F.col("psi").alias("value"), none_s.alias("text"))
    def entry(kind, key, value, text):
        return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"),
                        value.cast("double").alias("value"), text.cast("string").alias("text"))

    st = status.select(
        F.explode(F.array(
            entry("metric", "psi_worst", F.col("max_psi"), none_s),
            entry("metric", "retraining_triggered", F.col("retrain"), none_s),
            entry("param", "drift_status", none_d, F.col("status")),
            entry("tag", "psi_worst_feature", none_d, F.col("worst_feature")),
        )).alias("r")).select(rid.alias("run_id"), "r.*")
    fixed = local_frame(spark, 
        [("param", "psi_bins", None, str(spec.n_bins)), ("param", "psi_warn", None, str(spec.warn)),
         ("param", "psi_alert", None, str(spec.alert)), ("tag", "model_name", None, model_name),
         ("tag", "model_stage", None, model_stage),
         *(("tag", k, None, v) for k, v in (paths or {}).items())],
        "kind string, key string, value double, text string").select(rid.alias("run_id"), "*")
    return metrics.unionByName(st).unionByName(fixed)


def psi_by_window(profile: DataFrame, df: DataFrame, time_col: str, window: str,
                  expected: str = "empirical", eps: float = PSI_EPS) -> DataFrame:
    """Batch PSI per tumbling event-time window ->
    ``(window_start bigint epoch seconds, feature, psi, bins, new_total)``;
    the batch counterpart of the windowed stream (same binning, same math)."""
    from tabwatch.functions.timeparts import ntz_as_instant
    from tabwatch.operators.histogram import binned
    feats = [r["feature"] for r in profile.select("feature").collect()]   # one row per feature
    timed = df.withColumn("_et", ntz_as_instant(F.col(time_col)))
    rows = binned(timed.select("_et", *[f for f in feats if f in timed.columns]), profile, ids=["_et"])
    counts = (rows.groupBy(F.window("_et", window).alias("w"), "feature", "bin")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.unix_seconds(F.col("w.start")).alias("window_start"), "feature", "bin", "n"))
    rep = score_counts(counts, expected_grid(profile, expected), ["window_start"], eps)
    return rep.select("window_start", "feature", "psi", F.col("bins").cast("int").alias("bins"), "new_total")
