"""JSON records -> typed DataFrame (one record per row of a text column)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def records_to_frame(df: DataFrame, text_col: str, schema: T.StructType,
                     keep: list[str] | None = None) -> DataFrame:
    """Parse each JSON record with a declared schema; missing fields are null."""
    keep = keep or []
    parsed = df.select(*keep, F.from_json(F.col(text_col), schema).alias("_r"))
    return parsed.select(*keep, "_r.*")


def frame_to_records(df: DataFrame, cols: list[str], keep: list[str] | None = None,
                     text_col: str = "payload") -> DataFrame:
    keep = keep or []
    return df.select(*keep, F.to_json(F.struct(*cols)).alias(text_col))
