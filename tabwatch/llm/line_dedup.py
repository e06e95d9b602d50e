"""Lines that several documents share, kept in the first document alone.

Every line that is long enough becomes a row (128-bit hash of its key, document,
position).  The rows are range-partitioned by hash, document and position, so
that a line of very many documents is dealt over several tasks, and sorted the
same way inside a task.  A task streams its range and marks what follows a
hash's first document.  Only a range's first hash may have begun in an earlier
range: its rows wait for the first document of that hash, which the ranges'
ends (two rows of each) tell.  What is dropped goes into compressed bitmaps of
kept lines, in containers of 32,768 lines; no text is sorted or sent
for them, and a reader may apply them to the texts at any later time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import fresh, ship, stored

#: Code points of the shortest key that is compared.
LEAST_CHARS = 10
#: Lines of a container of a bitmap (a power of two).
CONTAINER = 1 << 15

_SPACES = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes) -> list[bytes]:
    """The keys of a text's lines: stripped of white space, A-Z as a-z."""
    return [line.strip(_SPACES) for line in text.lower().split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return len(key.decode(errors="replace")) >= least


def _line_hashes(least: int):
    """Rows (h1, h2, doc_id, t, line) of the lines that are long enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owner, lines = [], [], []
            for i, text in enumerate(batch.column(2).cast(pa.binary())):
                found = 0
                for no, key in enumerate(line_keys(text.as_py())):
                    if _long_enough(key, least):
                        hashes.append(xxhash.xxh3_128_digest(key))
                        lines.append(no)
                        found += 1
                owner.append(found)
                if len(lines) > 500_000:
                    yield _hash_batch(batch, hashes, owner, lines)
                    hashes, owner, lines = [], [0] * len(owner), []
            yield _hash_batch(batch, hashes, owner, lines)
    return run


def _hash_batch(batch: pa.RecordBatch, hashes: list[bytes], owner: list[int], lines: list[int]) -> pa.RecordBatch:
    both = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
    rows = pa.array(np.repeat(np.arange(len(owner)), owner))
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column(0).take(rows), batch.column(1).take(rows),
                                       pa.array(lines, pa.int32())], names=["h1", "h2", "doc_id", "t", "line"])


def _differs(column: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Whether each value differs from the one before it; null equals null."""
    if before is not None:
        column = pa.concat_arrays([before, column])
    a, b = column[:-1], column[1:]
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    changed = ~same.to_numpy(zero_copy_only=False)
    return changed if before is not None else np.concatenate([[True], changed])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted range: (null, null, doc_id, t, line) of what is dropped; of the
    range's first hash all rows, with the hash; and (h1, h2, doc_id, null, null),
    the first document of the first hash and of the last."""
    last = None                                # hash and document of the row before, each an array of one
    first, past = True, False                  # whether the range's first hash goes on; whether its first document is over
    ends: list[tuple] = []                     # (h1, h2, doc_id) of the first row of the first run and of the latest
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, t, line = batch.columns
        new = _differs(h1, last and last[0]) | _differs(h2, last and last[1])
        step = new | _differs(doc, last and last[2])
        seg = np.cumsum(step)
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))      # where the row's run begins, -1: before the batch
        begun = seg[start]
        drop = np.where(start >= 0, seg > begun, past | (seg > 0))
        runs = np.cumsum(new)
        in_first = runs <= (1 if last is None else 0) if first else np.zeros(len(new), dtype=bool)
        if new.any():
            at = np.flatnonzero(new)
            for i in ([at[0]] if last is None else []) + [at[-1]]:
                ends = ends[:1] + [tuple(c.slice(i, 1) for c in (h1, h2, doc))]
            first = first and len(at) == (1 if last is None else 0)
        past = bool(drop[-1])
        last = tuple(c.slice(len(new) - 1, 1) for c in (h1, h2, doc))
        held = pa.array(in_first)
        keep = pa.array(in_first | drop)
        hashes = [pc.if_else(held, h, pa.scalar(None, pa.int64())) for h in (h1, h2)]
        yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (*hashes, doc, t, line)], names=["h1", "h2", "doc_id", "t", "line"])
    for a, b, doc in ends:
        yield pa.RecordBatch.from_arrays([a, b, doc, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32())], names=["h1", "h2", "doc_id", "t", "line"])


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for gone in batch.column(3):
            bits = np.ones(CONTAINER, dtype=bool)
            bits[gone.values.to_numpy()] = False
            maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.compute.list_value_length(batch.column(3)).cast(pa.int64()), pa.array(maps, pa.binary())],
                                         names=["doc_id", "t", "block", "gone", "bits"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, t (hash of the text), n_dropped, maps of every document that loses a
    line; ``maps`` are (block, bits): a zlib-compressed bitmap, lowest bit first, of
    the kept ones among lines 32768 * block and on.

    A line's key is the line without ASCII white space at its ends, A-Z as a-z.
    Keys of at least ``least_chars`` code points that several documents have stay in
    the document of smallest id, on all its lines.  Rows of one id are one document;
    rows without id are one document and come last.  Null text is empty; an empty
    text is one empty line.  An empty table gives an empty result.  Ids may be of
    any type that has an order."""
    ship(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"h1 long, h2 long, doc_id {kind}, t long, line int"
    lines = stored(rows.mapInArrow(_line_hashes(least_chars), schema), "line-hashes")
    order = ("h1", "h2", F.col("doc_id").isNull(), "doc_id", "t", "line")
    found = stored(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream, schema), "line-runs")
    ends = found.where("line is null").groupBy("h1", "h2").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("owner"))
    waiting = found.where("line is not null and h1 is not null").join(F.broadcast(ends), ["h1", "h2"])     # two rows a range at most
    dropped = found.where("line is not null and h1 is null").select("doc_id", "t", "line").union(
        waiting.where(~F.col("doc_id").eqNullSafe(F.col("owner.doc_id"))).select("doc_id", "t", "line"))
    block = F.col("line").bitwiseAND(F.lit(CONTAINER - 1))
    grouped = dropped.groupBy("doc_id", "t", F.shiftright("line", CONTAINER.bit_length() - 1).alias("block")).agg(F.collect_set(block).alias("gone"))
    maps = grouped.mapInArrow(_containers, f"doc_id {kind}, t long, block int, gone long, bits binary")
    return maps.groupBy("doc_id", "t").agg(F.sum("gone").alias("n_dropped"), F.collect_list(F.struct("block", "bits")).alias("maps"))


def kept_lines(text: bytes, maps: dict[int, bytes]) -> bytes:
    """The text's kept lines, joined."""
    lines = text.split(b"\n")
    keep = np.ones(-(-len(lines) // CONTAINER) * CONTAINER, dtype=bool)
    for block, bits in maps.items():
        keep[block * CONTAINER:(block + 1) * CONTAINER] = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8), bitorder="little")
    return b"\n".join(line for line, k in zip(lines, keep.tolist()) if k)


def _with_maps(docs: DataFrame, maps: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """``docs`` with the bitmaps of their rows in the columns ``names``."""
    n, m, own, t, of = names
    side = maps.select(F.col("doc_id").alias(own), F.col("t").alias(of), F.col("n_dropped").alias(n), F.col("maps").alias(m))
    docs = docs.withColumn(t, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return docs.join(side, (docs[t] == side[of]) & docs[id_col].eqNullSafe(side[own]), "left").drop(t, of, own)


def _texts(batch: pa.RecordBatch, text_at: int, maps_at: int) -> Iterator[tuple[bytes, bytes]]:
    for text, maps in zip(batch.column(text_at).cast(pa.binary()), batch.column(maps_at)):
        text = text.as_py() or b""
        yield text, kept_lines(text, {m["block"]: m["bits"] for m in maps.as_py()}) if maps.is_valid else text


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """The rows and columns of ``docs``, texts without the lines that keep_bitmaps()
    drops.  A null text stays null; a text that loses all lines is empty."""
    maps = stored(keep_bitmaps(docs, id_col, text_col, least_chars), "line-maps")
    names = fresh(docs, "n_dropped", "maps", "own", "t", "of")
    joined = _with_maps(docs, maps, id_col, text_col, names).drop(names[0])
    at, maps_at = joined.columns.index(text_col), joined.columns.index(names[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [kept if old.is_valid else None for old, (_, kept) in zip(batch.column(at), _texts(batch, at, maps_at))]
            columns = [pa.array(texts, pa.binary()).cast(pa.string()) if i == at else c for i, c in enumerate(batch.columns) if i != maps_at]
            yield pa.RecordBatch.from_arrays(columns, names=[c for i, c in enumerate(batch.schema.names) if i != maps_at])

    return joined.mapInArrow(run, docs.schema)


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256 (of the
    kept lines in UTF-8).  Null text is one empty line, which stays."""
    maps = stored(keep_bitmaps(docs, id_col, text_col, least_chars), "line-maps")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = _with_maps(rows, maps, "doc_id", "text", ["n_dropped", "maps", "own", "t", "of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sums = [], []
            for text, kept in _texts(batch, 1, 3):
                n.append(text.count(b"\n") + 1)
                sums.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pc.fill_null(batch.column(2), 0), pa.array(sums, pa.string())],
                                             names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")
