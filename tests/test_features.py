import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array

from tabwatch.operators.evaluate import auc_evaluator, auc_rank_sum
from tabwatch.operators.features import fit_features
from tabwatch.spec import FeatureSpec


def test_index_keep_null_and_unseen_get_the_extra_slot(spark):
    fit = spark.createDataFrame([("S",), ("S",), ("C",), ("Q",), ("C",), ("S",)], "e string")
    m = fit_features(fit, FeatureSpec(num=(), cat=("e",)), label_index=False)
    new = spark.createDataFrame([("S",), ("C",), ("Q",), ("X",), (None,)], "e string")
    out = m.transform(new).select("e_idx", vector_to_array("e_oh").alias("oh")).collect()
    assert [r["e_idx"] for r in out] == [0.0, 1.0, 2.0, 3.0, 3.0]
    assert all(len(r["oh"]) == 4 for r in out)
    assert out[4]["oh"] == [0.0, 0.0, 0.0, 1.0]     # null is its own slot, not all zeros


def test_frequency_ties_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    m = StringIndexer(inputCol="s", outputCol="i").fit(df)
    assert m.labels == ["c", "a", "b"]


def test_label_null_is_an_error(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "y int")
    m = StringIndexer(inputCol="y", outputCol="label").fit(df.where("y is not null"))
    with pytest.raises(Exception):
        m.transform(df).collect()


def test_imputer_all_null_column_fails_at_fit(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    with pytest.raises(Exception):
        fit_features(df, FeatureSpec(num=("x",)), label_index=False)


def test_auc_rank_sum_matches_evaluator_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.3), (1, 0.3), (0, 0.1), (1, 0.5), (0, 0.5), (0, 0.5)]
    df = spark.createDataFrame(rows, "y int, s double")
    a = auc_rank_sum(df, "y", "s").first()["auc"]
    from pyspark.ml.linalg import Vectors
    pred = spark.createDataFrame([(float(y), Vectors.dense([-s, s])) for y, s in rows],
                                 ["label", "rawPrediction"])
    assert a == pytest.approx(auc_evaluator(pred), abs=1e-12)
    # pairwise definition
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    pw = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert a == pytest.approx(pw, abs=1e-12)


def test_all_null_numeric_can_be_left_out(spark):
    df = spark.createDataFrame([(None, 1.0, "a"), (None, 2.0, "b")], "x double, z double, c string")
    with pytest.warns(UserWarning):
        m = fit_features(df, FeatureSpec(num=("x", "z"), cat=("c",)), label_index=False, all_null="drop")
    assert m.transform(df).select("features").count() == 2


def test_score_one_record(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier

    from tabwatch.operators.features import feature_stages
    from tabwatch.operators.score import score_record
    rows = [(float(i), "a" if i % 2 else "b", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, c string, y double")
    spec = FeatureSpec(num=("x",), cat=("c",), label="y")
    pipe = Pipeline(stages=feature_stages(spec, label_index=False)
                    + [RandomForestClassifier(labelCol="y", seed=42, numTrees=5)])
    model = pipe.fit(df)
    got = score_record(model, spark, {"x": 3.0, "c": "a"}, "x double, c string")
    assert got in (0, 1)
    assert score_record(model, spark, {"c": "zzz"}, "x double, c string") in (0, 1)   # null + unseen


def test_batch_score_keeps_the_callers_values(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassifier

    from tabwatch.operators.prep import collapse_sql
    from tabwatch.operators.score import batch_score
    df = spark.createDataFrame([("male" if i % 2 else "female", float(i % 2)) for i in range(40)], "sex string, y double")
    m = fit_features(df, FeatureSpec(num=(), cat=("sex",), label="y"), collapse_sql("sex", "male", "female"), label_index=False)
    rf = RandomForestClassifier(labelCol="y", seed=1, numTrees=3).fit(m.transform(df))
    new = spark.createDataFrame([("male", 1), ("Male", 2), (None, 3), ("it's \\", 4)], "sex string, prediction int")
    out = batch_score(PipelineModel(stages=[*m.stages, rf]), new)
    assert sorted(((r.sex or ""), r.prediction) for r in out.collect()) == [("", 0), ("Male", 0), ("it's \\", 0), ("male", 1)]


def test_collapse_sql_quotes_names_and_values(spark):
    from pyspark.ml.feature import SQLTransformer

    from tabwatch.operators.prep import collapse_sql
    df = spark.createDataFrame([("it's",), ("x\\y",), (None,)], "`a b` string")
    for keep in ("it's", "x\\y"):
        got = [r[0] for r in SQLTransformer(statement=collapse_sql("a b", keep, "o'")).transform(df).collect()]
        assert sorted(got) == sorted([keep, "o'", "o'"])


def test_auc_rejects_other_labels(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.4)], "y int, s double")
    with pytest.raises(Exception, match="neither 0 nor 1"):
        auc_rank_sum(df, "y", "s").collect()
