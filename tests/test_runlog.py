from tabwatch.operators.runlog import best_run, current_production, next_version, promote, run_wide


def _log(spark):
    rows = [("r1", "metric", "val_auc", 0.8, 100, 1), ("r1", "metric", "val_auc", 0.85, 200, 2),
            ("r2", "metric", "val_auc", 0.9, 150, 3), ("r3", "metric", "accuracy", 0.7, 50, 4)]
    return spark.createDataFrame(rows, "run_id string, kind string, key string, value double, ts_ms bigint, seq bigint")


def test_wide_latest_value_and_missing_is_null(spark):
    w = {r["run_id"]: r for r in run_wide(_log(spark), ["val_auc", "accuracy"]).collect()}
    assert w["r1"]["val_auc"] == 0.85 and w["r1"]["accuracy"] is None and w["r1"]["start_time"] == 100
    assert w["r3"]["val_auc"] is None


def test_best_run_puts_missing_metric_last(spark):
    w = run_wide(_log(spark), ["val_auc", "accuracy"])
    assert best_run(w, "val_auc").first()["run_id"] == "r2"
    assert best_run(w, "accuracy").first()["run_id"] == "r3"


def _versions(spark):
    rows = [("m", "9", "Production"), ("m", "10", "None"), ("m", "2", "Production"), ("n", "1", "Staging")]
    return spark.createDataFrame(rows, "name string, version string, stage string")


def test_next_version_is_integer_max_plus_one(spark):
    got = {r["name"]: r["next_version"] for r in next_version(_versions(spark)).collect()}
    assert got == {"m": 11, "n": 2}


def test_promote_with_and_without_archiving(spark):
    a = {(r["name"], r["version"]): r["stage"] for r in promote(_versions(spark), archive_existing=True).collect()}
    assert a[("m", "10")] == "Production" and a[("m", "9")] == "Archived" and a[("m", "2")] == "Archived"
    k = {(r["name"], r["version"]): r["stage"] for r in promote(_versions(spark), archive_existing=False).collect()}
    assert k[("m", "9")] == "Production" and k[("m", "10")] == "Production"
    cur = {r["name"]: r["version"] for r in current_production(promote(_versions(spark))).collect()}
    assert cur == {"m": "10", "n": "1"}


def test_promote_best_metric_policy(spark):
    scores = spark.createDataFrame([("m", "9", 0.91), ("m", "10", 0.85), ("m", "2", 0.91), ("n", "1", 0.5)],
                                   "name string, version string, score double")
    got = {(r["name"], r["version"]): r["stage"]
           for r in promote(_versions(spark), policy="best", metric=scores).collect()}
    # best score wins; ties go to the lower version number
    assert got[("m", "2")] == "Production" and got[("m", "9")] == "Archived"
    assert got[("m", "10")] == "None" and got[("n", "1")] == "Production"


def test_nan_is_no_metric_and_all_runs_stay(spark):
    rows = [("r1", "metric", "auc", 0.8, 1, 1), ("r2", "metric", "auc", float("nan"), 2, 2), ("r3", "metric", "auc", 0.9, 3, 3),
            ("r4", "param", "depth", 5.0, 4, 4), ("r5", "metric", "loss", 0.1, 5, 5)]
    log = spark.createDataFrame(rows, "run_id string, kind string, key string, value double, ts_ms bigint, seq bigint")
    wide = run_wide(log)
    assert wide.columns == ["run_id", "start_time", "auc", "loss"]
    got = {r["run_id"]: r for r in wide.collect()}
    assert set(got) == {"r1", "r2", "r3", "r4", "r5"} and got["r4"]["auc"] is None and got["r4"]["start_time"] == 4
    assert best_run(wide, "auc").first()["run_id"] == "r3"
    versions = spark.createDataFrame([("m", "1", "None"), ("m", "2", "None"), ("m", str(2**40), "None")], "name string, version string, stage string")
    scores = spark.createDataFrame([("m", "1", 0.7), ("m", "2", float("nan"))], "name string, version string, score double")
    best = {r["version"]: r["stage"] for r in promote(versions, policy="best", metric=scores).collect()}
    assert best["1"] == "Production" and best["2"] == "None"
    assert next_version(versions).first()["next_version"] == 2**40 + 1
