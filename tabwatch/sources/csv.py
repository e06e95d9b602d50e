"""CSV with declared or inferred types and explicit missing-value tokens.

Every column is read as text under the name that the header gives it, the
missing-value tokens become null, then each column is parsed to its type.  A
declared column that the file lacks is an error, and so is a value that does not
parse (or, if asked for, a null).  Whole numbers may be written as ``3.0``, as
writers do whose integer columns hold missing values.  Quoted fields may hold
doubled quotes and line breaks.

A field with a line break begins on a line with an odd number of quotes, for
doubled ones are two.  One pass over the lines tells the files that have such a
line; only those are read whole, by one task each, all others in splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.functions.scalars import PANDAS_NULL_TOKENS, null_if_token
from tabwatch.functions.search import quoted

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _parsed(text: Column, dtype: T.DataType) -> Column:
    """The text as a value of the type, null where it is not one."""
    trimmed = F.trim(text)
    direct = trimmed.try_cast(dtype)
    if isinstance(dtype, _WHOLE):
        number = trimmed.try_cast("double")
        return F.coalesce(direct, F.when(number == F.floor(number), number.try_cast(dtype)))
    return direct


def _csv(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    return (spark.read.option("header", True).option("escape", '"').option("quote", '"').option("inferSchema", False)
            .option("multiLine", multi_line).option("mode", "FAILFAST").csv(path))


def files_with_breaks(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files of ``path`` that may hold a line break inside quotes, and the
    others: a line with an odd number of quotes tells.  One row per file is collected."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    found = (spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2).alias("odd"))
             .groupBy("file").agg(F.max("odd").alias("odd")).collect())
    name = lambda uri: re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))  # noqa: E731 - a path, not a pattern
    return tuple(sorted(name(r["file"]) for r in found if r["odd"] == odd) for odd in (1, 0))


def _text_columns(spark: SparkSession, path: str, multi_line: bool | None) -> DataFrame:
    if multi_line is not None:
        return _csv(spark, path, multi_line)
    whole, split = files_with_breaks(spark, path)
    if not (whole and split):
        return _csv(spark, path, bool(whole))
    return _csv(spark, split, False).unionByName(_csv(spark, whole, True))


def _inferred(raw: DataFrame, tokens: list[str]) -> T.StructType:
    """bigint, double or string for each column: the narrowest that all values
    parse to, in one pass over the file."""
    columns = [null_if_token(F.col(quoted(c)), tokens) for c in raw.columns]
    def misses(t: T.DataType) -> list[Column]:
        return [F.count(F.when(c.isNotNull() & F.trim(c).try_cast(t).isNull(), 1)) for c in columns]
    whole, number = misses(T.LongType()), misses(T.DoubleType())
    row = raw.agg(*whole, *number).first()
    n = len(columns)
    kinds = [T.LongType() if row[i] == 0 else T.DoubleType() if row[n + i] == 0 else T.StringType() for i in range(n)]
    return T.StructType([T.StructField(c, k) for c, k in zip(raw.columns, kinds)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_tokens: Iterable[str] = PANDAS_NULL_TOKENS, bad_values: str = "fail",
             multi_line: bool | None = None) -> DataFrame:
    """The columns of ``schema`` by header name, in its order; without one, all
    columns with inferred types.

    ``bad_values``: ``fail`` stops the job at a value that does not parse,
    ``null`` reads it as missing.  ``multi_line`` says whether there are line breaks
    inside quotes (a file is then read by one task); None finds out, file by file.
    """
    if bad_values not in ("fail", "null"):
        raise ValueError(f"unknown way with bad values: {bad_values!r}")
    raw, tokens = _text_columns(spark, path, multi_line), list(null_tokens)
    schema = schema or _inferred(raw, tokens)
    absent = [f.name for f in schema.fields if f.name not in raw.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; its header has {', '.join(raw.columns)}")
    columns = []
    for f in schema.fields:
        text = null_if_token(F.col(quoted(f.name)), tokens)
        value = text if isinstance(f.dataType, T.StringType) else _parsed(text, f.dataType)
        if value is not text and bad_values == "fail":
            message = F.concat(F.lit(f"column {f.name}: not a {f.dataType.simpleString()}: "), text)
            value = F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return raw.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, no index, nulls as empty fields, doubled quotes."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("quoteAll", False).csv(path))
