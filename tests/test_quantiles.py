import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.operators.quantiles import (approx_quantiles, feature_quantiles,
                                          median_exact)
from tabwatch.operators.reshape import to_long

LEVELS = [i / 10 for i in range(11)] + [0.25, 0.333, 0.999]


def _numpy(values, levels):
    return list(np.quantile(np.array(values, dtype=float), levels))


def _frame(spark, cols):
    n = max(len(v) for v in cols.values())
    rows = [tuple(float(cols[c][i]) if i < len(cols[c]) and cols[c][i] is not None else None for c in cols)
            for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))


@pytest.mark.parametrize("max_sort_rows", [1_000_000, 50, 7])
def test_exact_matches_numpy_with_heavy_ties(spark, max_sort_rows):
    rng = np.random.default_rng(7)
    heavy = [5.0] * 400 + list(rng.normal(size=500).round(2)) + list(rng.integers(0, 9, 300).astype(float))
    cont = list(rng.exponential(size=1200))
    df = _frame(spark, {"heavy": heavy, "cont": cont})
    q = feature_quantiles(df, ["heavy", "cont"], LEVELS, max_sort_rows=max_sort_rows).collect()
    exp = {"heavy": _numpy(heavy, LEVELS), "cont": _numpy(cont, LEVELS)}
    for r in q:
        assert r["quantile"] == exp[r["feature"]][r["level_idx"]], (r, max_sort_rows)
        assert r["n"] == len(heavy if r["feature"] == "heavy" else cont)


def test_nulls_nan_single_and_two_values(spark):
    df = spark.createDataFrame(
        [(None, 3.0, 1.0, float("nan")), (None, 3.0, 2.0, 4.0), (None, None, 1.0, 4.0)],
        "allnull double, one double, two double, withnan double")
    q = feature_quantiles(df, ["allnull", "one", "two", "withnan", "absent"], [0.0, 0.5, 1.0]).collect()
    got = {(r["feature"], r["level_idx"]): r["quantile"] for r in q}
    assert not any(f == "allnull" for f, _ in got)
    assert [got[("one", i)] for i in range(3)] == [3.0, 3.0, 3.0]
    assert [got[("two", i)] for i in range(3)] == _numpy([1.0, 2.0, 1.0], [0.0, 0.5, 1.0])
    assert [got[("withnan", i)] for i in range(3)] == [4.0, 4.0, 4.0]


def test_one_value_holding_a_third_of_rows_is_resolved_without_sorting(spark):
    vals = [42.0] * 3000 + [float(i) for i in range(6000)]
    df = _frame(spark, {"x": vals})
    q = feature_quantiles(df, ["x"], LEVELS, max_sort_rows=100).collect()
    exp = _numpy(vals, LEVELS)
    assert [r["quantile"] for r in sorted(q, key=lambda r: r["level_idx"])] == exp


def test_two_hundred_features(spark):
    n = 200
    df = spark.range(500).selectExpr(*[f"cast((id * {i + 3}) % {41 + i} as double) as f{i}" for i in range(n)])
    got = {(r["feature"], r["level_idx"]): r["quantile"] for r in feature_quantiles(df, df.columns, [0.1, 0.5], max_sort_rows=100).collect()}
    cols = df.toPandas()
    for c in df.columns:
        assert [got[c, 0], got[c, 1]] == pytest.approx(_numpy(cols[c], [0.1, 0.5]), rel=1e-12)


def test_median_and_approx(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert median_exact(df, ["x"]).first()["median"] == 2.5
    ap = approx_quantiles(to_long(df, ["x"]), ["feature"], [0.5], accuracy=1000).first()
    assert ap["quantile"] == 2.0   # an actual element


def test_sketch_mode_is_mergeable(spark):
    from tabwatch.operators.quantiles import feature_sketches, merge_sketches, sketch_quantiles
    vals = [float(i) for i in range(10000)]
    df = _frame(spark, {"x": vals})
    a, b = df.where("x < 5000"), df.where("x >= 5000")
    merged = merge_sketches(feature_sketches(a, ["x"]).unionByName(feature_sketches(b, ["x"])))
    q = {r["level"]: r["quantile"] for r in sketch_quantiles(merged, [0.1, 0.5, 0.9]).collect()}
    assert merged.first()["n"] == 10000
    for lv, v in q.items():
        assert abs(v - lv * 9999) <= 0.02 * 10000     # within the sketch's rank error


def test_counted_and_sketched_inputs_agree(spark, monkeypatch):
    """The same quantiles, ranks and counts whether an input is counted or sketched first."""
    from tabwatch.operators import quantiles as Q
    df = spark.range(5000).selectExpr("cast(id * 37 % 911 as double) as a", "if(id % 3 = 0, null, cast(id as double)) as b", "cast(null as double) as c", "if(id % 7 = 0, double('NaN'), 1.0D) as d")
    both = []
    for small in (Q.SMALL_BYTES, 0):
        monkeypatch.setattr(Q, "SMALL_BYTES", small)
        calls, plain = [], Q.sketch_cuts
        monkeypatch.setattr(Q, "sketch_cuts", lambda *a: calls.append(1) or plain(*a))
        both.append(sorted(map(tuple, feature_quantiles(df, ["a", "b", "c", "d"], LEVELS).collect())))
        monkeypatch.setattr(Q, "sketch_cuts", plain)
        assert bool(calls) == (small == 0)
    assert both[0] == both[1] and {r[0] for r in both[0]} == {"a", "b", "d"}
