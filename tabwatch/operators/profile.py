"""Baseline profiles: equal-frequency edges per feature (K1) and row counts.

A profile is one row per feature::

    feature string, pos int, edges array<double>, cuts array<double>,
    bins int, n bigint, counts array<bigint>

``edges`` are the sorted distinct quantiles before open-ending, ``cuts``
the inner edges that remain once the first and last edge become -inf/+inf
(fewer than three distinct edges leave a single open bin), ``counts`` the
baseline's own rows per bin (for empirical expected shares).

The quantiles and counts are computed by distributed jobs; the profile
itself is configuration-sized (one row per feature), so it is kept as a
small local table: no lineage back to the baseline scan, identical on
every read, cheap to broadcast or to turn into literal expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.levels import quantile_levels
from tabwatch.operators.histogram import histogram_open
from tabwatch.operators.quantiles import quantiles
from tabwatch.session import local_frame

NEG_INF = float("-inf")
POS_INF = float("inf")

EDGES_SCHEMA = "feature string, pos int, edges array<double>, n bigint"
PROFILE_SCHEMA = ("feature string, pos int, edges array<double>, cuts array<double>, "
                  "bins int, n bigint, counts array<bigint>")


def _edge_rows(df: DataFrame, features: Sequence[str], n_bins: int, levels: str,
               method: str) -> list[tuple]:
    """[(feature, pos, edges, n, below)] where ``below`` maps each edge to the
    number of rows strictly below it (exact method only, else None)."""
    features = list(features)
    present = [f for f in features if f in df.columns]
    got: dict[str, tuple[list[float], int, dict]] = {}
    if present:
        q = quantiles(df, present, quantile_levels(n_bins, levels), method=method)
        has_below = "below" in q.columns
        cols = ["feature", "quantile", "n"] + (["below"] if has_below else [])
        for r in q.select(*cols).collect():   # features x levels
            vals, _, bl = got.get(r["feature"], ([], 0, {}))
            vals.append(float(r["quantile"]))
            if has_below:
                bl[float(r["quantile"])] = int(r["below"])
            got[r["feature"]] = (vals, int(r["n"]), bl if has_below else None)
    rows = []
    for i, f in enumerate(features):
        vals, n, bl = got.get(f, ([], 0, {}))
        rows.append((f, i, sorted(set(vals)), n, bl))
    return rows


def _counts_from_ranks(cuts: list[float], n: int, below: dict) -> list[int]:
    """Rows per open-ended bin from the rows-below count of each cut."""
    b = [below[c] for c in cuts]
    return [b[0] - 0] + [b[k] - b[k - 1] for k in range(1, len(b))] + [n - b[-1]] if b else [n]


def quantile_edges(df: DataFrame, features: Sequence[str], n_bins: int = 10,
                   levels: str = "exact", method: str = "exact") -> DataFrame:
    """``(feature, pos, edges, n)``: sorted distinct quantiles at the level grid.

    Features with no non-null value (or absent) get ``edges = []``, ``n = 0``.
    """
    rows = [r[:4] for r in _edge_rows(df, features, n_bins, levels, method)]
    return local_frame(df.sparkSession, rows, EDGES_SCHEMA)


def _cuts(edges: list[float]) -> list[float]:
    return list(edges[1:-1]) if len(edges) >= 3 else []


def build_profile(df: DataFrame, features: Sequence[str], n_bins: int = 10,
                  levels: str = "exact", method: str = "exact",
                  with_counts: bool = True, stage_input: bool = False) -> DataFrame:
    """Equal-frequency baseline for every feature (small local table).

    With the exact method the baseline's own bin counts come from the rank
    bookkeeping of the quantile selection (no extra scan); the sketch modes
    count them with one histogram pass.  ``stage_input`` first writes the
    narrow feature projection to the shared folder (for inputs that are
    expensive to recompute, such as joins), and every pass reads that.
    """
    spark = df.sparkSession
    if stage_input:
        from tabwatch.session import materialize
        df = materialize(df.select(*[f for f in features if f in df.columns]), "profile_input")
    edge_rows = _edge_rows(df, features, n_bins, levels, method)
    rows, need_hist = [], False
    for f, i, e, n, bl in edge_rows:
        cuts = _cuts(e)
        counts = None
        if with_counts:
            if n == 0:
                counts = [0]
            elif bl is not None:
                counts = _counts_from_ranks(cuts, n, bl)
            else:
                need_hist = True
        rows.append((f, i, e, cuts, len(cuts) + 1, n, counts))
    prof = local_frame(spark, rows, PROFILE_SCHEMA)
    if not (with_counts and need_hist):
        return prof
    counts: dict[str, dict[int, int]] = {}
    for r in histogram_open(df, prof).collect():   # features x bins
        counts.setdefault(r["feature"], {})[int(r["bin"])] = int(r["n"])
    rows = [(f, i, e, c, b, n, cnt if cnt is not None else [counts.get(f, {}).get(k, 0) for k in range(b)])
            for f, i, e, c, b, n, cnt in rows]
    return local_frame(spark, rows, PROFILE_SCHEMA)


def open_edges(profile: DataFrame) -> DataFrame:
    """The open-ended edge list of each feature: [-inf, cuts..., +inf]."""
    return profile.select(
        "feature", "pos",
        F.concat(F.array(F.lit(NEG_INF)), F.col("cuts"), F.array(F.lit(POS_INF))).alias("bin_edges"))


def row_count(df: DataFrame) -> DataFrame:
    """``(n_rows bigint)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def saved_profile(spark, path: str, train_df: DataFrame | None, features: Sequence[str],
                  n_bins: int = 10, levels: str = "linspace", method: str = "exact") -> DataFrame:
    """Reuse the baseline file at ``path`` if there is one, else build it from
    ``train_df`` and save it (current shape, with bin counts).

    A reused baseline is taken as is even when its features or bin count
    differ from the request; the difference is reported as a warning.  A legacy
    file is written back in the current shape.  Only a missing path counts as no
    baseline; a file that cannot be read is an error.
    Returns a scoring profile ``(feature, pos, cuts, bins, counts)``.
    """
    import warnings

    from pyspark.errors import AnalysisException

    from tabwatch.sources.baseline import is_legacy, load_baseline, profile_from_edges, save_baseline
    try:
        loaded = load_baseline(spark, path, n_bins)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        loaded = None
    if loaded is not None:
        rows = loaded.select("feature", "pos", "bin_edges", "counts", "n_bins").collect()   # one row per feature
        loaded = local_frame(spark, rows, "feature string, pos int, bin_edges array<double>, counts array<bigint>, n_bins int")
        feats, nb = [r["feature"] for r in rows], {r["n_bins"] for r in rows}
        if is_legacy(spark, path):
            save_baseline(loaded.select("feature", "pos", "bin_edges", "counts"), path, n_bins)
        if sorted(feats) != sorted(features) or nb != {n_bins}:
            warnings.warn(f"baseline {path} has features {feats} and n_bins {sorted(nb)}; "
                          f"requested {list(features)} and {n_bins}; reusing it as is")
        return profile_from_edges(loaded)
    if train_df is None:
        raise FileNotFoundError(f"no baseline at {path} and no training data to build one from")
    prof = build_profile(train_df, features, n_bins, levels, method)
    save_baseline(open_edges(prof).join(prof.select("feature", "counts"), "feature"), path, n_bins)
    return prof.select("feature", "pos", "cuts", "bins", "counts")
