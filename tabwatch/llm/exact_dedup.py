"""Exact duplicates by composable polynomial fingerprints.

A text without white space is a string of bytes ``b``; its fingerprint is
``sum (b_i + 1) * B^(n-1-i)`` modulo two primes.  Fingerprints compose: with
``h(xy) = h(x) * B^|y| + h(y)`` the chunks of one text can be hashed apart and
put together by length-shifted arithmetic.  Texts up to ``huge_chars`` do that
inside one row; longer ones are cut in one pass, dealt out as chunk rows over the
cluster and folded back.  Rows of equal fingerprint and length are then compared
chunk by chunk: of every chunk position only the least and the greatest chunk travel
(aggregated before the shuffle), and a class is one class only when they are
the same everywhere; otherwise it is divided by SHA-256.  Rows whose fingerprint
no other row has are not compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.llm.common import SPACE, fresh, ship, sliced, stored, with_row_key

PRIMES = (2147483647, 2147483629)
BASE = 1000003
CHUNK = 4096
#: Texts of more code points than this are hashed as chunk rows.
HUGE_CHARS = 1 << 22
#: Bytes of a chunk that is compared, and of a huge text's chunk row.
COMPARE = 1 << 16
#: Classes that are sent to every task (16 bytes each); more are joined by shuffle.
SENT_CLASSES = 2_000_000

_SPACES = b" \t\n\x0b\x0c\r"
# (b + 1) * power < 2^39, summed over 4096 bytes < 2^51: exact in float64
_POWERS = np.array([[pow(BASE, CHUNK - 1 - i, p) for p in PRIMES] for i in range(CHUNK)], dtype=np.float64)


def compose(left: tuple[int, ...], right: tuple[int, ...], right_len: int) -> tuple[int, ...]:
    """Fingerprint of two adjoining strings from those of its parts."""
    return tuple((a * pow(BASE, right_len, p) + b) % p for a, b, p in zip(left, right, PRIMES))


def fingerprint(data: bytes) -> tuple[int, ...]:
    """Fingerprint of a byte string, from the hashes of its chunks."""
    out = (0,) * len(PRIMES)
    a = np.frombuffer(data, dtype=np.uint8)
    whole = len(a) // CHUNK
    for lo in range(0, whole, 64):
        block = a[lo * CHUNK:min(lo + 64, whole) * CHUNK].reshape(-1, CHUNK).astype(np.float64) + 1
        for row in block @ _POWERS:
            out = compose(out, tuple(int(v) % p for v, p in zip(row, PRIMES)), CHUNK)
    tail = a[whole * CHUNK:].astype(np.float64) + 1
    if len(tail):
        row = tail @ _POWERS[CHUNK - len(tail):]
        out = compose(out, tuple(int(v) % p for v, p in zip(row, PRIMES)), len(tail))
    return out


def normalised(text: bytes | None) -> bytes:
    """The text's bytes without ASCII white space."""
    return (text or b"").translate(None, _SPACES)


def _mark(fp: tuple[int, ...]) -> int:
    return fp[0] << 31 | fp[1]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[], [], []]
        for value in batch.column(0).cast(pa.binary()):
            data = normalised(value.as_py())
            out[0].append(_mark(fingerprint(data)))
            out[1].append(len(data))
            out[2].append(hashlib.sha256(data).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
            names=[*batch.schema.names[1:], "fp", "n_bytes", "text_sha256"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows of huge texts, one text after the other."""
    for batch in batches:
        for i, value in enumerate(batch.column(0).cast(pa.binary())):
            data = normalised(value.as_py())
            sums = hashlib.sha256(data).hexdigest()
            chunks = [data[lo:lo + COMPARE] for lo in range(0, max(1, len(data)), COMPARE)]
            n = len(chunks)
            same = [c.take(pa.array([i] * n, pa.int64())) for c in batch.columns[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.binary()), *same, pa.array([sums] * n), pa.array(range(n), pa.int32())],
                                             names=["chunk", *batch.schema.names[1:], "text_sha256", "no"])


def _chunk_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = [[], [], [], [], []]
        for value in batch.column(0):
            data = value.as_py()
            fp = fingerprint(data)
            for i, p in enumerate(PRIMES):
                h[i].append(fp[i])
                h[2 + i].append(pow(BASE, len(data), p))
            h[4].append(len(data))
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(x, pa.int64()) for x in h)],
                                         names=[*batch.schema.names[1:], "h0", "h1", "s0", "s1", "chunk_bytes"])


def _folded(parts: str, i: int) -> Column:
    """The i-th part of the fingerprint that the ordered chunk rows make."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, x: (acc * x[f"s{i}"] + x[f"h{i}"]) % F.lit(PRIMES[i]))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            huge_chars: int = HUGE_CHARS) -> DataFrame:
    """doc_id, n_chars, fp, n_bytes, text_sha256 of every row.  Null text is empty."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(text.alias("text"), F.col(id_col).alias("doc_id"), F.length(text).cast("long").alias("n_chars"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {id_type}, n_chars long"
    plain = base.where(F.col("n_chars") <= huge_chars).mapInArrow(
        _digests, f"{fields}, fp long, n_bytes long, text_sha256 string")
    huge = (base.where(F.col("n_chars") > huge_chars).withColumn("key", F.monotonically_increasing_id())
            .mapInArrow(_cut, f"chunk binary, {fields}, key long, text_sha256 string, no int")
            .repartition("key", "no")
            .mapInArrow(_chunk_hashes, f"{fields}, key long, text_sha256 string, no int, h0 long, h1 long, s0 long, s1 long, chunk_bytes long"))
    folded = huge.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.first("text_sha256").alias("text_sha256"),
        F.sum("chunk_bytes").alias("n_bytes"), F.array_sort(F.collect_list(F.struct("no", "h0", "h1", "s0", "s1"))).alias("parts"))
    fp = F.shiftleft(_folded("parts", 0), 31) + _folded("parts", 1)
    return plain.unionByName(folded.select("doc_id", "n_chars", fp.alias("fp"), "n_bytes", "text_sha256"))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        data = [normalised(value.as_py()) for value in batch.column(0).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([_mark(fingerprint(d)) for d in data], pa.int64()), pa.array(map(len, data), pa.int64())], names=["fp", "n_bytes"])


def _sent(classes: DataFrame) -> DataFrame:
    """A stored table of classes, for a join: broadcast if it is small."""
    return F.broadcast(classes) if classes.count() <= SENT_CLASSES else classes


def _several(digests: DataFrame) -> DataFrame:
    """fp, n_bytes of the classes of two rows or more."""
    return stored(digests.groupBy("fp", "n_bytes").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp", "n_bytes"), "dedup-classes")


def _with_marks(docs: DataFrame, text_col: str, names: list[str]) -> DataFrame:
    """``docs`` with fingerprint and number of bytes in the columns ``names``."""
    at = docs.columns.index(text_col)
    columns = [*docs.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            marks = next(_marks(iter([pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *marks.columns], names=columns)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in names)]))


def collisions(docs: DataFrame, classes: DataFrame, text_col: str = "text") -> DataFrame:
    """fp, n_bytes of those ``classes`` whose texts differ in some chunk: their rows
    are compared chunk by chunk.  The texts are cut by Spark: a second Python step behind
    the join would be a second Python worker for each task."""

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            marks = next(_marks(iter([batch])))
            data = pa.array([normalised(value.as_py()) for value in batch.column(0).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([data, *marks.columns], names=["data", *marks.schema.names])

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(bare, "data binary, fp long, n_bytes long")
    last = F.floor(F.greatest(F.col("n_bytes") - 1, F.lit(0)) / COMPARE).cast("int")
    chunks = (rows.join(_sent(classes), ["fp", "n_bytes"], "left_semi")
              .select("data", "fp", "n_bytes", F.explode(F.sequence(F.lit(0), last)).alias("no"))
              .select("fp", "n_bytes", "no", F.substring("data", F.col("no") * COMPARE + 1, F.lit(COMPARE)).alias("chunk")))
    return (chunks.groupBy("fp", "n_bytes", "no").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
            .where(F.col("least") != F.col("most")).select("fp", "n_bytes").distinct())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     huge_chars: int = HUGE_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null is empty, and all
    empty texts form one class.  Of equal texts the row of most code points
    stays, then the smallest id (null ids last); of fully repeated rows
    exactly one stays.  An empty table gives an empty result.  Ids may be of any
    type that has an order."""
    rows = with_row_key(digests(docs, id_col, text_col, huge_chars), "dedup-digests")
    split = stored(collisions(docs, _several(rows), text_col), "dedup-collisions")
    keyed = (rows.join(split.withColumn("differs", F.lit(True)), ["fp", "n_bytes"], "left")
             .withColumn("split_by", F.when(F.col("differs"), F.col("text_sha256")).otherwise(F.lit(""))).drop("differs"))
    key = ["fp", "n_bytes", "split_by"]
    order = F.struct(F.negative("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), F.min_by(F.struct("doc_id", "row"), order).alias("keep"))
    copies = stored(groups.where("group_size > 1"), "dedup-groups")     # a plain table: its join can split a hot class
    return keyed.join(copies, key, "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact_duplicates() keeps, with all their columns.

    Null text is empty and one class with the empty texts; of equal rows one
    stays, null ids come last; an empty table gives an empty result.  Only rows
    whose fingerprint another row has are shuffled."""
    ship(docs.sparkSession)
    fp, size, whole, split_by = fresh(docs, "fp", "n_bytes", "whole", "split_by")
    text = F.coalesce(F.col(text_col), F.lit(""))
    classes = _several(docs.select(text.alias("text")).mapInArrow(_marks, "fp long, n_bytes long"))
    split = stored(collisions(docs, classes, text_col), "dedup-collisions").select(F.col("fp").alias(fp), F.col("n_bytes").alias(size), F.lit(True).alias(split_by))
    marked, named = _with_marks(docs, text_col, [fp, size]), _sent(classes).select(F.col("fp").alias(fp), F.col("n_bytes").alias(size))
    alone = marked.join(named, [fp, size], "left_anti").select(*docs.columns)
    norm = F.regexp_replace(text, f"[{SPACE}]+", "")
    keyed = (marked.join(named, [fp, size], "left_semi").join(split, [fp, size], "left")
             .withColumn(split_by, F.when(F.col(split_by), F.sha2(norm, 256)).otherwise(F.lit(""))))
    order = F.struct(F.negative(F.length(text)), F.col(id_col).isNull(), F.col(id_col))
    kept = keyed.groupBy(fp, size, split_by).agg(F.min_by(F.struct(*docs.columns), order).alias(whole))
    return alone.union(kept.select(f"{whole}.*"))
