"""Pieces shared by the operators: word splitting, internal column names, row
keys that stay the same on every read, tokenizer files."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.session import ensure_checkpoint_dir, materialize

#: The white space that separates words (inside a character class).
SPACE = r"\x20\x09-\x0D"
_SPACE_CHARS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def words(text: Column) -> Column:
    """The words in order; an empty array for null and for blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Internal column names that no column of ``df`` has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"_{name}"
        while new.lower() in taken:
            new = "_" + new
        taken.add(new.lower())
        out.append(new)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return materialize(df, name)


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with a unique long ``row``: repeated and null ids stay apart.

    The key is written with the rows, so every later read sees the same one."""
    return stored(df.withColumn("row", F.monotonically_increasing_id()), name)


#: Rows of a batch that a Python step holds results of at a time.
TOGETHER = 1000


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of TOGETHER rows, so that neither a worker nor the JVM
    that reads its results holds them for a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp()       # the driver's own: Spark serves the file from there to its end
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/package", "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def tokenizer_path(file: str) -> str:
    """Where the tokenizer file of that name is installed."""
    import public_tokenizers
    return public_tokenizers.path(file)
