"""Property tests against numpy on random inputs (heavy ties, nulls, NaNs)."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabwatch.operators.drift import psi_raw_sample
from tabwatch.operators.profile import build_profile
from tabwatch.operators.quantiles import feature_quantiles

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(
    st.one_of(st.sampled_from([0.0, 1.0, 1.5, -2.0, 7.0]),            # heavy ties
              st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
              st.none(), st.just(float("nan"))),
    min_size=1, max_size=400)
levels = st.lists(st.floats(0.0, 1.0), min_size=1, max_size=6)


def _df(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def _clean(xs):
    return np.array([x for x in xs if x is not None and not math.isnan(x)], dtype=float)


@settings(**SETTINGS)
@given(xs=values, lv=levels, msr=st.sampled_from([1_000_000, 25, 3]))
def test_exact_quantiles_equal_numpy(spark, xs, lv, msr):
    clean = _clean(xs)
    q = feature_quantiles(_df(spark, xs), ["x"], lv, max_sort_rows=msr).collect()
    if clean.size == 0:
        assert q == []
        return
    exp = np.quantile(clean, lv)
    for r in q:
        assert r["quantile"] == exp[r["level_idx"]]
        assert r["below"] == int(np.sum(clean < r["quantile"]))
        assert r["n"] == clean.size


@settings(**SETTINGS)
@given(xs=values, bins=st.integers(1, 12))
def test_profile_counts_equal_numpy_bins(spark, xs, bins):
    clean = _clean(xs)
    prof = build_profile(_df(spark, xs), ["x"], bins, levels="linspace").first()
    if clean.size == 0:
        assert prof["counts"] == [0] and prof["bins"] == 1
        return
    cuts = prof["cuts"]
    idx = np.searchsorted(np.array(cuts), clean, side="right")   # number of cuts <= v
    assert prof["counts"] == [int(np.sum(idx == k)) for k in range(len(cuts) + 1)]
    edges = np.unique(np.quantile(clean, np.linspace(0, 1, bins + 1)))
    assert cuts == (list(edges[1:-1]) if len(edges) >= 3 else [])


@settings(**SETTINGS)
@given(e=values, a=values)
def test_raw_sample_psi_equals_definition(spark, e, a):
    ce, ca = _clean(e), _clean(a)
    rows = psi_raw_sample(_df(spark, e), _df(spark, a), ["x"]).collect()
    if ce.size == 0 or ca.size == 0:
        assert rows == []
        return
    bp = np.percentile(ce, np.linspace(0, 100, 11))
    bp[-1] += 1e-6
    if np.any(bp[:-1] > bp[1:]):       # numpy refuses non-monotone edges (cannot happen)
        return
    ep = np.histogram(ce, bins=bp)[0] / ce.size
    ap = np.histogram(ca, bins=bp)[0] / ca.size
    ep[ep == 0] = 1e-6
    ap[ap == 0] = 1e-6
    exp = float(np.sum((ap - ep) * np.log(ap / ep)))
    assert abs(rows[0]["psi"] - exp) <= 1e-9 * max(1.0, abs(exp))
