"""Reusable DuckDB SQL fragments for the oracle statements.

They restate each operator's definition in plain SQL (quantile_cont,
list functions, window sums) so the Spark plans are checked against an
independent engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from tabwatch.functions.levels import quantile_levels


def dbl(x: float) -> str:
    if x == float("inf"):
        return "'inf'::DOUBLE"
    if x == float("-inf"):
        return "'-inf'::DOUBLE"
    return f"'{x!r}'::DOUBLE"


def level_list(n_bins: int, mode: str) -> str:
    return "[" + ", ".join(dbl(x) for x in quantile_levels(n_bins, mode)) + "]"


def long_values(source: str, features: Sequence[str]) -> str:
    """(feature, value) non-null, non-NaN rows of ``source``."""
    parts = [f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source}"
             for f in features]
    u = " UNION ALL ".join(parts)
    return f"(SELECT * FROM ({u}) WHERE value IS NOT NULL AND NOT isnan(value))"


def features_values(features: Sequence[str]) -> str:
    rows = ", ".join(f"('{f}', {i})" for i, f in enumerate(features))
    return f"(SELECT * FROM (VALUES {rows}) AS t(feature, pos))"


def profile_cte(source: str, features: Sequence[str], n_bins: int, mode: str) -> str:
    """CTE body: (feature, pos, edges, cuts, bins, n)."""
    lv = level_list(n_bins, mode)
    return f"""
      SELECT f.feature, f.pos,
             COALESCE(q.edges, []::DOUBLE[]) AS edges,
             CASE WHEN len(COALESCE(q.edges, [])) >= 3
                  THEN q.edges[2:len(q.edges)-1] ELSE []::DOUBLE[] END AS cuts,
             COALESCE(q.n, 0) AS n
      FROM {features_values(features)} f
      LEFT JOIN (
        SELECT feature, list_sort(list_distinct(quantile_cont(value, {lv}))) AS edges,
               count(*) AS n
        FROM {long_values(source, features)} GROUP BY feature
      ) q USING (feature)
    """


def bins_cte(profile: str) -> str:
    """(feature, pos, bin) grid for every bin of the profile."""
    return f"""
      SELECT feature, pos, b.bin FROM {profile},
             LATERAL (SELECT unnest(range(0, len(cuts) + 1)) AS bin) b
    """


def hist_open_cte(source: str, features: Sequence[str], profile: str) -> str:
    """(feature, bin, n) counts over open-ended bins, zero-filled."""
    return f"""
      SELECT g.feature, g.bin, COALESCE(c.n, 0)::BIGINT AS n
      FROM ({bins_cte(profile)}) g
      LEFT JOIN (
        SELECT v.feature, len(list_filter(p.cuts, lambda x: x <= v.value)) AS bin,
               count(*) AS n
        FROM {long_values(source, features)} v JOIN {profile} p USING (feature)
        GROUP BY ALL
      ) c ON c.feature = g.feature AND c.bin = g.bin
    """
