"""Wide <-> long reshapes and per-feature null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tabwatch.session import local_frame


def to_long(df: DataFrame, features: Sequence[str], ids: Sequence[str] = (),
            feature_col: str = "feature", value_col: str = "value",
            drop_missing: bool = True) -> DataFrame:
    """Numeric columns -> rows ``(*ids, feature, value double)``.

    Nulls and NaNs are dropped per feature (not per row) when
    ``drop_missing``: a row with one missing feature still contributes its
    other features.  ``DataFrame.unpivot`` keeps null values, so the filter
    is explicit.
    """
    features = list(features)
    if not features:
        raise ValueError("no features to unpivot")
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in features])
    long = wide.unpivot(list(ids), features, feature_col, value_col)
    if drop_missing:
        v = F.col(value_col)
        long = long.where(v.isNotNull() & ~F.isnan(v))
    return long


def features_frame(df: DataFrame, features: Sequence[str],
                   feature_col: str = "feature") -> DataFrame:
    """A tiny ``(feature, pos)`` table from the spec (configuration, not data)."""
    spark = df.sparkSession
    rows = [(f, i) for i, f in enumerate(features)]
    return local_frame(spark, rows, f"{feature_col} string, pos int")
