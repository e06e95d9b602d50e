"""Token ids as Parquet list columns, in order of the documents' ids.

The documents are dealt by range of id before they are encoded, each task sorts
and encodes its range, and Spark's writer makes the files: the ids are a list
column with a dictionary (an id takes two bytes or less), ids and counts of
documents are delta encoded, row groups are small enough to skip by id, and
pages carry their index.  Where a document begins is the sum of its file's
tokens before it (stored) and of the files before (a sum over a narrow column).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwatch.llm.bpe import default_files, encoder
from tabwatch.llm.common import ship
from tabwatch.session import ensure_checkpoint_dir, scratch_path

END_ID = 0
#: Bytes of a row group and of a page, and most rows of a page.
ROW_GROUP, PAGE, PAGE_ROWS = 16 << 20, 256 << 10, 2000


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 files: tuple[str, str] | None = None, row_group: int = ROW_GROUP, page: int = PAGE,
                 page_rows: int = PAGE_ROWS) -> None:
    """Write doc_id, part, place, file_start, n_tokens, tokens to ``path``.

    Rows are in ascending order of id, null first; rows of one id by their
    texts' hash.  ``place`` orders the rows of all files.  A null or empty text
    is the end id alone.  An empty table writes a file without rows."""
    ship(docs.sparkSession)
    files = files or default_files()
    end = np.array([end_id], dtype="<u4").tobytes()
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the third key deals rows of one id and text over several ranges
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("no"))
    rows = (rows.repartitionByRange("doc_id", "h", "no").sortWithinPartitions("doc_id", "h", "no")
            .select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("place")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at = encoder(*files), 0
        for batch in batches:
            ids = [encode.ids(t.as_py()) + end for t in batch.column(1)]
            counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(at + offsets[:-1]), pa.array(counts), tokens],
                                             names=["doc_id", "part", "place", "file_start", "n_tokens", "tokens"])
            at += int(offsets[-1])

    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, part long, place long, file_start long, n_tokens long, "
              "tokens array<int>")
    (rows.mapInArrow(run, schema).write.mode("overwrite").option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#tokens.list.element", "true")
     .option("parquet.block.size", row_group).option("parquet.page.size", page)
     .option("parquet.page.row.count.limit", page_rows).parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, place, start, n_tokens: reads the narrow columns alone.  ``start``
    counts the ids of all documents before."""
    meta = spark.read.parquet(path).select("doc_id", "part", "place", "file_start", "n_tokens")
    sums = meta.groupBy("part").agg(F.sum("n_tokens").alias("total"))      # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("ahead"))
    return meta.join(sums, "part").select("doc_id", "place", (F.col("ahead") + F.col("file_start")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """doc_id, n_tokens, tokens of the ids from ``first`` to ``last``: the
    range skips row groups and pages by their index."""
    rows = spark.read.parquet(path).select("doc_id", "n_tokens", "tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    return rows if last is None else rows.where(F.col("doc_id") <= last)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column(3)
        found = [zlib.crc32(t.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()) for t in tokens]
        counted = pc.list_value_length(tokens).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], counted, pa.array(found, pa.int64())],
                                         names=["doc_id", "part", "file_start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
               path: str | None = None) -> DataFrame:
    """Write the files (to ``path``, or a fresh shared folder) and read them
    back: doc_id, start, n_tokens, ids_crc32 of every row."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    path = path or scratch_path(spark, "token-files")
    write_tokens(docs, path, id_col, text_col, end_id)
    kind = spark.read.parquet(path).schema["doc_id"].dataType.simpleString()
    rows = spark.read.parquet(path).select("doc_id", "part", "file_start", "tokens").mapInArrow(
        _checksums, f"doc_id {kind}, part long, file_start long, n_tokens long, ids_crc32 long")
    sums = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("ahead"))
    return rows.join(sums, "part").select("doc_id", (F.col("ahead") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")
