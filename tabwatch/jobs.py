"""Runnable jobs: the end-to-end workflow composed from the operators.

preprocess -> train (CV, log, save) -> register (best run, new version,
promote) -> monitor (baseline, PSI, status, log) -> predict (production
model) -> runs (metric series).  Runs and versions are Parquet tables, not
a tracking service.  Usable as functions or from the command line::

    python -m tabwatch.jobs monitor --train data/train.csv --new data/new.csv \\
        --baseline out/baseline --features Age,SibSp,Parch,Fare --report out/psi
    python -m tabwatch.jobs register --runlog out/runs --versions out/versions --name model
    python -m tabwatch.jobs predict --versions out/versions --name model \\
        --input data/test.csv --out out/predictions
"""

from __future__ import annotations

import argparse
import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.operators.drift import (drift_status, generate_drift_batch, monitor_log_rows, psi_raw_sample, psi_report,
                                      run_name)
from tabwatch.operators.features import fit_features
from tabwatch.operators.prep import collapse_sql, require_columns
from tabwatch.operators.profile import saved_profile
from tabwatch.operators.runlog import (best_run, current_production, metric_series, next_version,
                                       promote, run_wide)
from tabwatch.operators.score import batch_score, load_model, production_model_path, save_model
from tabwatch.operators.train import train_cv, training_report
from tabwatch.sources.changes import append_change, missing, read_changes
from tabwatch.sources.csv import read_csv, write_csv
from tabwatch.spec import DriftSpec, FeatureSpec
from tabwatch.session import local_frame

RUN_COLS = "run_id string, kind string, key string, value double, text string, ts_ms bigint"
VERSION_COLS = "name string, version string, stage string, run_id string, path string, change bigint"


def _read(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return read_csv(spark, path, schema) if path.endswith(".csv") else spark.read.parquet(path)


def _log(spark, rows: DataFrame, runlog: str, ts_ms: int) -> None:
    cols = rows.columns
    out = rows.select("run_id", "kind", "key",
                      (F.col("value") if "value" in cols else F.lit(None)).cast("double").alias("value"),
                      (F.col("text") if "text" in cols else F.lit(None)).cast("string").alias("text"),
                      F.lit(int(ts_ms)).cast("bigint").alias("ts_ms"))
    out.write.mode("append").parquet(runlog)


def preprocess(spark, src: str, out: str, spec: FeatureSpec, schema=None,
               clean: tuple[str, str, str] | None = None, all_null: str = "error") -> int:
    """Fit the feature stages on ``src`` and write ``(features, label)``.
    ``all_null="drop"`` leaves out numeric columns without any value."""
    df = _read(spark, src, schema)
    model = fit_features(df, spec, clean_sql=collapse_sql(*clean) if clean else None, all_null=all_null)
    model.transform(df).select("features", "label").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out).count()


def train(spark, src: str, spec: FeatureSpec, model_out: str, runlog: str, schema=None,
          clean: tuple[str, str, str] | None = None, **cv) -> dict:
    """Cross-validate, save the best pipeline, log params and metrics.
    ``cv`` passes further settings (trees, depths, folds, parallelism, all_null, ...)."""
    df = _read(spark, src, schema)
    res = train_cv(df, spec, spec.key, clean_sql=collapse_sql(*clean) if clean else None, **cv)
    save_model(res.model, model_out)
    run_id = uuid.uuid4().hex
    rep = training_report(spark, res).withColumnRenamed("value_text", "text")
    rep = rep.unionByName(local_frame(spark, [("artifact", "model_path", None, model_out)],
                                                "kind string, key string, value double, text string"))
    _log(spark, rep.withColumn("run_id", F.lit(run_id)), runlog, int(time.time() * 1000))
    return {"run_id": run_id, "val_auc": res.val_auc, "model_path": model_out}


def read_versions(spark, versions: str) -> DataFrame:
    """The versions as of now: of the rows of each, the last change."""
    return _latest(read_changes(spark, versions, VERSION_COLS))


def _latest(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("name", "version").agg(F.max_by(F.struct("stage", "run_id", "path"), "change").alias("x"), F.max("change").alias("change"))
    return last.select("name", "version", "x.*", "change")


def add_version(spark, versions: str, name: str, run_id: str, path: str, archive_existing: bool = True,
                policy: str = "newest", scores: DataFrame | None = None) -> str:
    """The next version of ``name``; its number is returned.  It goes to Production
    (policy ``newest``), or that version does whose run has the best of ``scores``
    (``run_id, score``; policy ``best``).

    The version table only grows: the new version and the stages that change
    with it are rows of one change, and of several jobs at once each makes its
    change from the one before.  A missing table is the first registration; a
    table that cannot be read is an error."""
    made = {}

    def change(state: DataFrame, n: int) -> DataFrame:
        known = local_frame(spark, _latest(state.where(F.col("name") == name)).collect(), VERSION_COLS)     # versions of one model
        v = made["version"] = str(next_version(known, local_frame(spark, [(name,)], "name string")).first()["next_version"])
        before = known.select("name", "version", F.col("stage").alias("was"))
        row = local_frame(spark, [(name, v, "None", run_id, path, n)], VERSION_COLS)
        every = known.unionByName(row)
        metric = every.join(scores, "run_id").select("name", "version", "score") if policy == "best" else None
        after = promote(every, policy=policy, archive_existing=archive_existing, metric=metric)
        changed = after.join(before, ["name", "version"], "left").where(~F.col("stage").eqNullSafe(F.col("was"))).drop("was")
        return changed.select(*row.columns)

    append_change(spark, versions, VERSION_COLS, change)
    return made["version"]


def register(spark, runlog: str, versions: str, name: str, metric: str = "val_auc",
             archive_existing: bool = True, policy: str = "newest") -> dict:
    """Best run by ``metric`` -> next version of ``name`` -> Production.  With policy
    ``best``, the version with the best ``metric`` goes there, the new one or another."""
    log = spark.read.parquet(runlog)
    wide = run_wide(log.withColumn("seq", F.lit(0).cast("bigint")), [metric])
    best = best_run(wide, metric, require=True).first()
    path = (log.where((F.col("run_id") == best["run_id"]) & (F.col("key") == "model_path"))
               .select("text").first()["text"])
    scores = wide.select("run_id", F.col(metric).alias("score")) if policy == "best" else None
    v = add_version(spark, versions, name, best["run_id"], path, archive_existing, policy, scores)
    return {"name": name, "version": v, "run_id": best["run_id"], "path": path}


def _new_batch(spark, new: str, train_df: DataFrame | None, schema, synthesize: dict | None) -> DataFrame:
    """The new data, or, where it is absent and ``synthesize`` says how, a
    drifted sample of the training data."""
    try:
        return _read(spark, new, schema)
    except AnalysisException as e:
        if not missing(e) or not synthesize or train_df is None:
            raise
    return generate_drift_batch(train_df, synthesize["key"], adjust=synthesize.get("adjust"))


def monitor(spark, baseline: str, new: str, features: list[str], train_src: str | None = None,
            n_bins: int = 10, warn: float | None = 0.10, alert: float = 0.25,
            expected: str = "uniform", report_out: str | None = None, runlog: str | None = None,
            schema=None, levels: str = "linspace", formula: str = "binned", synthesize: dict | None = None) -> dict:
    """Baseline (reuse or build) -> PSI per feature -> status (-> log).

    The new data must have the columns of the baseline that is used.
    ``formula="raw"`` compares the training sample itself (closed ranges, two-level
    status).  ``synthesize`` = {"key": column, "adjust": {column: (scale, shift)}}
    makes the new batch when there is none."""
    spec = DriftSpec(features=tuple(features), n_bins=n_bins, warn=warn if formula == "binned" else None, alert=alert,
                     expected=expected, levels=levels)
    train_df = _read(spark, train_src, schema) if train_src else None
    if formula == "raw":
        if train_df is None:
            raise ValueError("the raw-sample formula needs the training data")
        new_df = _new_batch(spark, new, train_df, schema, synthesize)
        require_columns(new_df, features)
        report = psi_raw_sample(train_df, new_df, features, n_bins)
    elif formula == "binned":
        prof = saved_profile(spark, baseline, train_df, features, n_bins, levels=levels)
        new_df = _new_batch(spark, new, train_df, schema, synthesize)
        require_columns(new_df, [r["feature"] for r in prof.select("feature").collect()])      # a row per feature
        report = psi_report(prof, new_df, expected)
    else:
        raise ValueError(f"unknown formula {formula!r}")
    # a row per feature, read by the file, the status and the log: computed once
    report = report.select("feature", "psi", "bins", "new_total", "pos")
    rep = local_frame(spark, report.collect(), "feature string, psi double, bins int, new_total bigint, pos int")
    st = drift_status(rep, alert, spec.warn)
    if report_out:
        write_csv(rep.select("feature", "psi", "bins", "new_total").coalesce(1), report_out)
    s = st.first().asDict()
    if runlog:
        rid = run_name(int(time.time()))
        rows = monitor_log_rows(rep, st, spec, rid, paths={"new_data_path": new, "baseline_path": baseline})
        _log(spark, rows, runlog, int(time.time() * 1000))
        s["run_id"] = rid
    return s


def predict(spark, versions: str, name: str, src: str, out: str, schema=None) -> int:
    """Score ``src`` with the Production version of ``name``; inputs kept."""
    vt = read_versions(spark, versions)
    cur = current_production(vt).join(vt.select("name", "version", "path"), ["name", "version"])
    model = load_model(production_model_path(cur.withColumn("stage", F.lit("Production")), name))
    df = _read(spark, src, schema)
    write_csv(batch_score(model, df), out)
    return df.count()          # every row is scored; an observation would keep later models of the session from being sent to tasks


def runs(spark, runlog: str, metric: str) -> DataFrame:
    log = spark.read.parquet(runlog).withColumn("seq", F.lit(0).cast("bigint"))
    return metric_series(run_wide(log), metric)


def _adjustments(key: str | None, text: str) -> dict | None:
    if not key:
        return None
    parts = (x.split(":") for x in text.split(",") if x)
    return {"key": key, "adjust": {c: (float(scale), float(shift)) for c, scale, shift in parts}}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tabwatch.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("monitor")
    m.add_argument("--baseline", required=True)
    m.add_argument("--new", required=True)
    m.add_argument("--features", required=True)
    m.add_argument("--train")
    m.add_argument("--bins", type=int, default=10)
    m.add_argument("--warn", type=float, default=0.10)
    m.add_argument("--alert", type=float, default=0.25)
    m.add_argument("--expected", default="uniform", choices=["uniform", "empirical"])
    m.add_argument("--levels", default="linspace", choices=["linspace", "exact", "percent"])
    m.add_argument("--formula", default="binned", choices=["binned", "raw"])
    m.add_argument("--synthesize-key", help="without new data, sample the training data by this key")
    m.add_argument("--synthesize", default="", help="column:scale:shift, comma separated")
    m.add_argument("--report")
    m.add_argument("--runlog")
    for cmd in ("preprocess", "train"):
        x = sub.add_parser(cmd)
        x.add_argument("--input", required=True)
        x.add_argument("--out", required=True, help="feature table (preprocess) or model (train)")
        x.add_argument("--num", required=True, help="numeric columns, comma separated")
        x.add_argument("--cat", default="", help="categorical columns, comma separated")
        x.add_argument("--label", required=True)
        x.add_argument("--key", help="key column for splits and folds")
        x.add_argument("--clean", help="two-way category collapse col:keep:default")
        x.add_argument("--all-null", default="error", choices=["error", "drop"], help="numeric columns without any value")
        x.add_argument("--schema", help="types of a CSV's columns, as in SQL: 'id bigint, age double, ...'; without it a pass infers them")
        if cmd == "train":
            x.add_argument("--runlog", required=True)
    r = sub.add_parser("runs")
    r.add_argument("--runlog", required=True)
    r.add_argument("--metric", default="val_auc")
    g = sub.add_parser("register")
    g.add_argument("--runlog", required=True)
    g.add_argument("--versions", required=True)
    g.add_argument("--name", required=True)
    g.add_argument("--metric", default="val_auc")
    g.add_argument("--policy", default="newest", choices=["newest", "best"])
    g.add_argument("--keep-existing", action="store_true",
                   help="do not archive other Production versions")
    s_ = sub.add_parser("predict")
    s_.add_argument("--versions", required=True)
    s_.add_argument("--name", required=True)
    s_.add_argument("--input", required=True)
    s_.add_argument("--out", required=True)
    for x in (m, s_):
        x.add_argument("--schema", help="types of a CSV's columns, as in SQL; without it a pass infers them")
    a = p.parse_args(argv)
    from tabwatch.session import get_spark
    spark = get_spark()
    schema = T._parse_datatype_string(a.schema) if getattr(a, "schema", None) else None
    if a.cmd in ("preprocess", "train"):
        spec = FeatureSpec(num=tuple(c for c in a.num.split(",") if c),
                           cat=tuple(c for c in a.cat.split(",") if c), label=a.label, key=a.key)
        clean = tuple(a.clean.split(":")) if a.clean else None
        if a.cmd == "preprocess":
            print(json.dumps({"rows": preprocess(spark, a.input, a.out, spec, schema, clean, a.all_null)}))
        else:
            if not spec.key:
                raise SystemExit("train needs --key")
            print(json.dumps(train(spark, a.input, spec, a.out, a.runlog, schema, clean, all_null=a.all_null)))
    elif a.cmd == "monitor":
        out = monitor(spark, a.baseline, a.new, a.features.split(","), a.train, a.bins, a.warn,
                      a.alert, a.expected, a.report, a.runlog, schema, levels=a.levels, formula=a.formula,
                      synthesize=_adjustments(a.synthesize_key, a.synthesize))
        print(json.dumps(out, default=str))
    elif a.cmd == "runs":
        runs(spark, a.runlog, a.metric).show(truncate=False)
    elif a.cmd == "register":
        print(json.dumps(register(spark, a.runlog, a.versions, a.name, a.metric,
                                  archive_existing=not a.keep_existing, policy=a.policy)))
    elif a.cmd == "predict":
        print(json.dumps({"rows": predict(spark, a.versions, a.name, a.input, a.out, schema)}))


if __name__ == "__main__":
    main()
