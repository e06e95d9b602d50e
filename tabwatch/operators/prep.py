"""Column preparation: replace/collapse, checks, median fill, drift injection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.scalars import collapse_category
from tabwatch.functions.search import quoted, sql_text
from tabwatch.operators.quantiles import feature_quantiles
from tabwatch.operators.reshape import features_frame, to_long
from tabwatch.session import local_frame


def collapse(df: DataFrame, col: str, keep: str, default: str) -> DataFrame:
    """Two-way category collapse in place (null and other spellings -> default)."""
    return df.withColumn(col, collapse_category(F.col(col), keep, default))


def collapse_sql(col: str, keep: str, default: str, out: str | None = None) -> str:
    """The same collapse as a SQL statement for a ``SQLTransformer`` stage, so
    it travels with a fitted pipeline to scoring; into ``out``, which keeps the
    input column, or in place."""
    c, k, d = quoted(col), sql_text(keep), sql_text(default)
    value = f"CASE WHEN {c} = {k} THEN {k} ELSE {d} END"
    if out:
        return f"SELECT *, {value} AS {quoted(out)} FROM __THIS__"
    return f"SELECT * EXCEPT ({c}), {value} AS {c} FROM __THIS__"


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise ``ValueError`` naming every listed column that ``df`` lacks.  Case
    counts; a column that differs in case alone is pointed out."""
    have = set(df.columns)
    absent = [c for c in cols if c not in have]
    if absent:
        lower = {h.lower(): h for h in have}
        alike = [lower[c.lower()] for c in absent if c.lower() in lower]
        hint = f" (there are {alike})" if alike else ""
        raise ValueError(f"the data lacks the columns {sorted(absent)}{hint}")


def column_checks(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, pos, present, non_null, status)`` for each wanted feature.

    status: 'missing' (absent column), 'skipped' (all null or NaN), 'ok'.
    One pass over the present columns.
    """
    features = list(features)
    present = [f for f in features if f in df.columns]
    spec = features_frame(df, features)
    if present:
        counts = to_long(df, present).groupBy("feature").agg(
            F.count(F.lit(1)).alias("non_null"))
    else:
        counts = local_frame(df.sparkSession, [], "feature string, non_null bigint")
    present_lit = F.array(*[F.lit(p) for p in present]) if present else F.array().cast("array<string>")
    out = (spec.join(counts, "feature", "left")
               .withColumn("present", F.array_contains(present_lit, F.col("feature")))
               .withColumn("non_null", F.coalesce("non_null", F.lit(0).cast("bigint"))))
    status = (F.when(~F.col("present"), "missing")
               .when(F.col("non_null") == 0, "skipped").otherwise("ok"))
    return out.select("feature", "pos", "present", "non_null", status.alias("status"))


def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Interpolated (exact) median of each column, as scalars.

    One row per column comes back to the driver, as with any fitted
    imputer's surrogate values.
    """
    cols = list(cols)
    med = feature_quantiles(df, cols, [0.5])
    got = {r["feature"]: r["quantile"] for r in med.select("feature", "quantile").collect()}  # 1 per column
    return {c: got.get(c) for c in cols}


def fill_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls (and NaNs) of each column replaced by its interpolated median."""
    meds = column_medians(df, cols)
    out = df
    for c, m in meds.items():
        if m is None:
            continue
        x = F.col(c).cast("double")
        out = out.withColumn(c, F.when(x.isNull() | F.isnan(x), F.lit(m)).otherwise(x))
    return out


def shift_scale(df: DataFrame, adjust: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``x * scale + shift`` for each listed column that exists."""
    out = df
    for c, (scale, shift) in adjust.items():
        if c not in df.columns:
            continue
        x = F.col(c).cast("double")
        if scale != 1.0:
            x = x * F.lit(float(scale))
        if shift != 0.0:
            x = x + F.lit(float(shift))
        out = out.withColumn(c, x)
    return out
