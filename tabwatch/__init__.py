"""tabwatch: Spark-native operators for the data side of tabular ML.

Profiling and drift (quantile baselines, histograms, PSI, alert status),
feature preparation, reproducible splits and samples, training and
evaluation, batch/stream scoring, and run-log / model-version queries.
Every operator takes DataFrames and returns DataFrames.
"""

from tabwatch.spec import DriftSpec, FeatureSpec

_EXPORTS = {
    # drift
    "build_profile": "tabwatch.operators.profile",
    "saved_profile": "tabwatch.operators.profile",
    "quantile_edges": "tabwatch.operators.profile",
    "feature_quantiles": "tabwatch.operators.quantiles",
    "feature_sketches": "tabwatch.operators.quantiles",
    "merge_sketches": "tabwatch.operators.quantiles",
    "histogram_open": "tabwatch.operators.histogram",
    "histogram_closed": "tabwatch.operators.histogram",
    "psi_report": "tabwatch.operators.drift",
    "psi_raw_sample": "tabwatch.operators.drift",
    "psi_by_window": "tabwatch.operators.drift",
    "drift_status": "tabwatch.operators.drift",
    "monitor": "tabwatch.operators.drift",
    "generate_drift_batch": "tabwatch.operators.drift",
    # preparation, sampling, features, evaluation
    "to_long": "tabwatch.operators.reshape",
    "column_checks": "tabwatch.operators.prep",
    "fill_median": "tabwatch.operators.prep",
    "split_hash": "tabwatch.operators.sampling",
    "kfold_hash": "tabwatch.operators.sampling",
    "sample_exact_n": "tabwatch.operators.sampling",
    "fit_features": "tabwatch.operators.features",
    "auc_rank_sum": "tabwatch.operators.evaluate",
    "train_cv": "tabwatch.operators.train",
    "batch_score": "tabwatch.operators.score",
    "score_record": "tabwatch.operators.score",
    # sources
    "read_csv": "tabwatch.sources.csv",
    "write_csv": "tabwatch.sources.csv",
    "load_baseline": "tabwatch.sources.baseline",
    "save_baseline": "tabwatch.sources.baseline",
    # run log and versions
    "run_wide": "tabwatch.operators.runlog",
    "best_run": "tabwatch.operators.runlog",
    "next_version": "tabwatch.operators.runlog",
    "promote": "tabwatch.operators.runlog",
    "current_production": "tabwatch.operators.runlog",
}

__all__ = ["DriftSpec", "FeatureSpec", *sorted(_EXPORTS)]


def __getattr__(name):
    mod = _EXPORTS.get(name)
    if mod is None:
        raise AttributeError(name)
    import importlib
    return getattr(importlib.import_module(mod), name)
