"""The runnable workflow end to end on driver tables."""

import pytest
from pyspark.sql import functions as F

from tabwatch import jobs
from tabwatch.plans.feature_queries import DOC_SPEC, labeled_docs
from tabwatch.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_workflow(spark):
    src = scratch_path(spark, "t_docs")
    labeled_docs(spark, SF).write.parquet(src)
    n = spark.read.parquet(src).count()
    assert jobs.preprocess(spark, src, scratch_path(spark, "t_feat"), DOC_SPEC) == n
    runlog, versions = scratch_path(spark, "t_runs"), scratch_path(spark, "t_versions")
    grid = dict(trees=(5,), depths=(2, 3), folds=2, parallelism=2)
    r1 = jobs.train(spark, src, DOC_SPEC, scratch_path(spark, "t_m1"), runlog, **grid)
    assert 0.0 <= r1["val_auc"] <= 1.0
    v1 = jobs.register(spark, runlog, versions, "docs_rf")
    jobs.train(spark, src, DOC_SPEC, scratch_path(spark, "t_m2"), runlog, **grid)
    v2 = jobs.register(spark, runlog, versions, "docs_rf")
    assert (v1["version"], v2["version"]) == ("1", "2")
    stages = {r["version"]: r["stage"] for r in jobs.read_versions(spark, versions).collect()}
    assert stages == {"1": "Archived", "2": "Production"}
    assert jobs.predict(spark, versions, "docs_rf", src, scratch_path(spark, "t_pred")) == n
    assert jobs.runs(spark, runlog, "val_auc").count() == 2
    jobs.main(["register", "--runlog", runlog, "--versions", versions, "--name", "docs_rf",
               "--keep-existing"])
    stages = {r["version"]: r["stage"] for r in jobs.read_versions(spark, versions).collect()}
    assert stages == {"1": "Archived", "2": "Production", "3": "Production"}   # no archiving
    jobs.main(["predict", "--versions", versions, "--name", "docs_rf", "--input", src,
               "--out", scratch_path(spark, "t_pred_cli")])
    jobs.main(["preprocess", "--input", src, "--out", scratch_path(spark, "t_feat_cli"),
               "--num", "n_chars", "--cat", "lang,source", "--label", "quality",
               "--clean", "lang:en:other"])
    jobs.main(["train", "--input", src, "--out", scratch_path(spark, "t_m_cli"), "--runlog", runlog,
               "--num", "n_chars", "--cat", "lang,source", "--label", "quality", "--key", "doc_id"])
    assert jobs.runs(spark, runlog, "val_auc").count() == 3

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    base, new = scratch_path(spark, "t_base"), scratch_path(spark, "t_new")
    li.where(F.col("l_shipdate") < cut).write.parquet(base)
    li.where(F.col("l_shipdate") >= cut).write.parquet(new)
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    bl = scratch_path(spark, "t_bl")
    st = jobs.monitor(spark, bl, new, feats, train_src=base, runlog=runlog,
                      report_out=scratch_path(spark, "t_rep"))
    assert st["status"] in ("OK", "WARN", "ALERT") and st["n_features"] == 4
    again = jobs.monitor(spark, bl, new, feats)        # reuses the saved baseline
    assert again["max_psi"] == st["max_psi"]


def test_command_line_monitor(spark, capsys):
    import json
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    base, new = scratch_path(spark, "c_base"), scratch_path(spark, "c_new")
    li.where(F.col("l_shipdate") < cut).write.parquet(base)
    li.where(F.col("l_shipdate") >= cut).write.parquet(new)
    jobs.main(["monitor", "--baseline", scratch_path(spark, "c_bl"), "--new", new, "--train", base,
               "--features", "l_quantity,l_discount", "--expected", "empirical", "--levels", "exact"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["n_features"] == 2 and out["status"] in ("OK", "WARN", "ALERT")


def _csv(path, header, rows):
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def test_command_line_on_csv(spark, tmp_path, capsys):
    import json
    train = _csv(tmp_path / "train.csv", "id,age,name", [f'{i},{"NA" if i % 9 == 0 else i % 50 + 0.5},"a ""b""\nc"' for i in range(200)])
    new = _csv(tmp_path / "new.csv", "name,age,id", [f'x,{i % 50 + 20}.0,{i}.0' for i in range(100)])
    args = ["monitor", "--baseline", str(tmp_path / "base"), "--train", train, "--features", "age", "--runlog", str(tmp_path / "log")]
    jobs.main([*args, "--new", new])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["n_features"] == 1 and out["status"] == "ALERT"
    tags = {r.key: r.text for r in spark.read.parquet(str(tmp_path / "log")).where("kind = 'tag'").collect()}
    assert tags["new_data_path"] == new and tags["baseline_path"] == str(tmp_path / "base")
    jobs.main([*args, "--new", new, "--formula", "raw"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "ALERT"
    jobs.main([*args, "--new", str(tmp_path / "none.csv"), "--synthesize-key", "id", "--synthesize", "age:1.5:8"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["retrain"] == 1
    with pytest.raises(Exception, match="none.csv"):
        jobs.main([*args, "--new", str(tmp_path / "none.csv")])


def test_monitor_checks_the_baselines_own_features(spark, tmp_path):
    base, new = str(tmp_path / "bl"), str(tmp_path / "new.parquet")
    src = str(tmp_path / "src.parquet")
    spark.range(100).selectExpr("cast(id as double) a", "cast(id % 7 as double) b").write.parquet(src)
    spark.range(50).selectExpr("cast(id as double) a").write.parquet(new)
    jobs.monitor(spark, base, src, ["a", "b"], train_src=src)
    with pytest.raises(ValueError, match="b"):
        jobs.monitor(spark, base, new, ["a"])


def test_unreadable_version_table_is_not_a_first_registration(spark, tmp_path):
    log, versions = str(tmp_path / "log"), tmp_path / "versions"
    spark.createDataFrame([("r", "metric", "val_auc", 0.5, None, 1), ("r", "artifact", "model_path", None, "p", 1)], jobs.RUN_COLS).write.parquet(log)
    versions.mkdir()
    (versions / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        jobs.register(spark, log, str(versions), "m")
    assert (versions / "part.parquet").read_text() == "not parquet"


def test_policy_best_and_declared_types(spark, tmp_path, capsys):
    import json
    from tabwatch.session import local_frame
    log, versions = str(tmp_path / "log"), str(tmp_path / "versions")

    def run(run_id, auc):
        rows = [(run_id, "metric", "val_auc", auc, None, 1), (run_id, "artifact", "model_path", None, "/m/" + run_id, 1)]
        local_frame(spark, rows, jobs.RUN_COLS).write.mode("append").parquet(log)

    for run_id, auc in (("a", 0.7), ("b", 0.9)):
        run(run_id, auc)
        jobs.main(["register", "--runlog", log, "--versions", versions, "--name", "m", "--policy", "best"])
    out = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines() if line.startswith("{")]
    assert [(o["version"], o["run_id"]) for o in out] == [("1", "a"), ("2", "b")]
    assert jobs.add_version(spark, versions, "m", "a", "/m/a", policy="best", scores=spark.createDataFrame([("a", 0.7), ("b", 0.9)], "run_id string, score double")) == "3"
    assert {r.version: r.stage for r in jobs.read_versions(spark, versions).collect()} == {"1": "Archived", "2": "Production", "3": "None"}

    train = _csv(tmp_path / "t.csv", "id,age,none,y", [f"{i},{i % 40},,{i % 2}" for i in range(120)])
    args = ["preprocess", "--input", train, "--num", "age,none", "--label", "y", "--schema", "id bigint, age double, none double, y int"]
    with pytest.raises(Exception):
        jobs.main([*args, "--out", str(tmp_path / "f")])
    with pytest.warns(UserWarning, match="none"):
        jobs.main([*args, "--out", str(tmp_path / "f"), "--all-null", "drop"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == 120
