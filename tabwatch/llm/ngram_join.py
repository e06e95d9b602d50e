"""Similarity join on the Jaccard index of word n-gram sets, by vertical partitioning.

The global order of n-grams (by hash) is cut into fragments, and every
document's set into one segment per fragment.  A fragment sees all segments of
its range: it knows how many documents have each of its n-grams, and keeps of a segment
the n-grams that another document has too.  Summed over the fragments, that
bounds a document's overlap with any other, and most documents are out.  That is
done twice: first with the head of each set alone, of which similar sets share
some n-grams for sure, and then with the whole sets of the documents that are left.
The rest look for partners by the rarest n-grams of their sets (the prefix that two
similar sets must share), and a pair's overlap is counted in each fragment apart and
summed.

Equal sets are one class throughout.  Within the documents that share a rare
n-gram, first all are compared with one centre; then, once linked ones are a
component, only documents of different components.  That leaves no link out: a pair
that is never compared is in one component already.  n-grams that a notable
share of all documents have would make a fragment hot; they are found while
the sets are counted, a bounded list, and stay with their documents.

Sets are compared by 64-bit hashes of the n-grams.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.llm.common import SPACE, TOGETHER, fresh, ship, sliced, stored
from tabwatch.llm.components import components

WORDS, PERCENT = 4, 85
#: n-grams of a fragment, about, and the least number of fragments.
FRAGMENT, LEAST_FRAGMENTS = 1_000_000, 16
#: Parts of a set whose overlaps are counted apart.
PARTS = 4
#: The head of a set is the prefix that similar sets must share an n-gram of, and
#: this percentage of the set more; so they share that percentage, too.
AHEAD = 20
#: Bits of the table of documents that are left, and of one of its slices.
LISTED, SLICE = 1 << 25, 1 << 15
#: An n-gram is heavy when this share of all documents has it: of a set's average
#: length divided by the share there are so many heavy n-grams at most.
HEAVY, HEAVY_IN_BATCH = 0.005, 8
#: 64-bit words of the sketch of a set, one bit per n-gram that it shares.
SKETCH = 16
#: Entries of a worker's cache of word hashes.
CACHED = 150_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_word_hashes = _WordHashes()


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes.

    A-Z count as a-z; words are parted by ASCII white space.  A text of fewer
    words has its whole sequence as its one n-gram; one without words has none."""
    words = (text or "").encode().lower().split()        # of bytes: ASCII letters and white space alone
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(_word_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = (h ^ (h >> np.uint64(29))) * _MIX + w[i:len(w) - k + 1 + i]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return np.unique(h ^ (h >> np.uint64(29)))


def class_of(grams: np.ndarray) -> int:
    """One number for all documents of an equal set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n: Column, percent: int) -> Column:
    """The n-grams that a set of n must share with any similar one."""
    return F.floor((percent * n + 99) / 100)


def _digest(n: int):
    """Rows (doc_id, n, node, null), and (null, count, null, gram) of the n-grams
    that many of a few hundred documents have; sets are held for those alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [ngram_set(t.as_py(), n) for t in batch.column(1)]
            nodes = [class_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(len(sets), pa.int64())],
                                             names=["doc_id", "n", "node", "gram"])
            first = {node: s for node, s in zip(nodes, sets) if node is not None}
            if first:
                grams, counts = np.unique(np.concatenate(list(first.values())), return_counts=True)
                often = counts >= max(HEAVY_IN_BATCH, HEAVY * len(first))
                m = int(often.sum())
                yield pa.RecordBatch.from_arrays([pa.nulls(m, batch.schema.field(0).type), pa.array(counts[often].astype(np.int64)), pa.nulls(m, pa.int64()),
                                                  pa.array(grams[often].view(np.int64))], names=["doc_id", "n", "node", "gram"])
    return run


def _fragments(grams: np.ndarray, fragments: int) -> np.ndarray:
    """Fragment of each n-gram, by range of hash."""
    return (((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)


def _segments(n: int, deal):
    """What ``deal`` gives for the classes and sets of a batch's documents: of each
    fragment, the segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, sets = [], []
            for t in batch.column(0):
                s = ngram_set(t.as_py(), n)
                if len(s) and (node := class_of(s)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(s)
                if len(nodes) >= TOGETHER:
                    yield from deal(nodes, sets)
                    nodes, sets = [], []
            if nodes:
                yield from deal(nodes, sets)
    return run


def _is_heavy(grams: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    if not len(heavy):
        return np.zeros(len(grams), dtype=bool)
    return heavy[np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)] == grams


def _deal_heads(nodes: list[int], sets: list[np.ndarray], percent: int, fragments: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (f, nodes, wanted, lengths, ids): the heads of the sets, as the halves of
    the hashes that a fragment does not know.  Of a head, ``wanted`` n-grams are in
    the head of any similar set.

    Two similar sets of n and m share ``least`` n-grams or more, so the first
    ``k`` of these have, in either set's order, n - least + k at most before and
    with the last one.  Heavy n-grams come last in that order; they are not sent,
    as others have them for sure."""
    node, size = np.array(nodes, dtype=np.int64), np.array([len(s) for s in sets], dtype=np.int64)
    grams, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    least = (percent * size + 99) // 100
    head, wanted = size - least + 1 + AHEAD * size // 100, 1 + AHEAD * least // 100
    light = ~_is_heavy(grams, heavy)
    grams, doc = grams[light], doc[light]
    lights = np.bincount(doc, minlength=len(sets))
    wanted = wanted - np.clip(head - lights, 0, size - lights)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(lights) - lights, lights) < head[doc]
    grams, doc = grams[first], doc[first]
    f = _fragments(grams, fragments)
    order = np.lexsort((doc, f))
    f, doc, grams = f[order], doc[order], grams[order].astype(np.uint32)
    cuts = np.flatnonzero(np.diff(f, prepend=-1))
    out = [[], [], [], [], []]
    for lo, hi in zip(cuts, [*cuts[1:], len(f)]):
        docs, lengths = np.unique(doc[lo:hi], return_counts=True)
        for column, value in zip(out, (int(f[lo]), *(x.tobytes() for x in (node[docs], wanted[docs].astype(np.int32), lengths.astype(np.int32), grams[lo:hi])))):
            column.append(value)
    if len(bare := np.flatnonzero(lights == 0)):                                # of heavy n-grams alone
        for column, value in zip(out, (-1 - int(node[bare[0]] % fragments), *(x.tobytes() for x in (node[bare], wanted[bare].astype(np.int32), np.zeros(len(bare), dtype=np.int32))), b"")):
            column.append(value)
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
                                     names=["f", "nodes", "wanted", "lengths", "ids"])


def _deal(nodes: list[int], sets: list[np.ndarray], fragments: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (f, nodes, sizes, lengths, ids) of whole sets.  Heavy n-grams go to a
    fragment of their document's class, numbered below 0."""
    node, size = np.array(nodes, dtype=np.int64), np.array([len(s) for s in sets], dtype=np.int32)
    grams, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    f = _fragments(grams, fragments)
    hot = _is_heavy(grams, heavy)
    f[hot] = -1 - node[doc[hot]] % fragments
    order = np.lexsort((doc, f))
    f, doc, grams = f[order], doc[order], grams[order]
    cuts = np.flatnonzero(np.diff(f, prepend=f[0] - 1))
    out = [[], [], [], [], []]
    for lo, hi in zip(cuts, [*cuts[1:], len(f)]):
        docs, lengths = np.unique(doc[lo:hi], return_counts=True)
        out[0].append(int(f[lo]))
        for column, value in zip(out[1:], (node[docs], size[docs], lengths.astype(np.int32))):
            column.append(value.tobytes())
        out[4].append(grams[lo:hi].tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
                                     names=["f", "nodes", "sizes", "lengths", "ids"])


_HEADS = "b long, nodes binary, wanted binary, held binary"
_PACKETS = "b long, f long, nodes binary, sizes binary, lengths binary, ids binary, counts binary"
_SETS = "node long, n long, held long, parts array<struct<part:int,ids:array<long>,counts:array<int>>>"


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    """The values of a binary column, one after the other, as numbers; one copy."""
    parts = [np.empty(0, dtype=np.uint8)]
    for chunk in table.column(name).chunks:
        ends = np.frombuffer(chunk.buffers()[1], dtype=np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        if len(chunk) and ends[-1] > ends[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(parts).view(kind)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several ranges, one range after the other."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _counts(ids: np.ndarray) -> np.ndarray:
    """How many entries equal each one."""
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], ids[order][1:] != ids[order][:-1]])[:len(ids)])
    runs = np.diff(starts, append=len(ids))
    counts = np.empty(len(ids), dtype=np.int32)
    counts[order] = np.repeat(runs, runs)
    return counts


def _one_of_a_class(node: np.ndarray) -> np.ndarray:
    """Of a class that several tasks sent, one segment."""
    first = np.zeros(len(node), dtype=bool)
    first[np.unique(node, return_index=True)[1]] = True
    return first


def _heads_shared(buckets: int):
    """How many n-grams of each head in a fragment another class has, packed by
    bucket of their classes.  Different n-grams of equal halves count as shared,
    which puts a document on the list too many, and none too few."""
    def run(table: pa.Table) -> pa.Table:
        node, wanted, length, ids = (_joined(table, c, k) for c, k in (("nodes", np.int64), ("wanted", np.int32), ("lengths", np.int32), ("ids", np.uint32)))
        first = _one_of_a_class(node)
        ids = ids[np.repeat(first, length)]
        node, wanted, length = node[first], wanted[first], length[first]
        held = np.bincount(np.repeat(np.arange(len(node)), length)[_counts(ids) > 1], minlength=len(node)).astype(np.int32)
        bucket = np.mod(node, buckets)
        order = np.argsort(bucket, kind="stable")
        order = order[(held[order] > 0) | (wanted[order] <= 0)]
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        out = [[], [], [], []]
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            these = order[lo:hi]
            for column, value in zip(out, (int(bucket[these[0]]), *(x[these].tobytes() for x in (node, wanted, held)))):
                column.append(value)
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["b", "nodes", "wanted", "held"])
    return run


def _left(table: pa.Table) -> pa.Table:
    """The classes of a bucket whose heads share what they must."""
    node, wanted, held = (_joined(table, c, k) for c, k in (("nodes", np.int64), ("wanted", np.int32), ("held", np.int32)))
    found, first, at = np.unique(node, return_index=True, return_inverse=True)
    return pa.table({"node": pa.array(found[np.bincount(at, weights=held, minlength=len(found)) >= wanted[first]])})


def _bits(table: pa.Table) -> pa.Table:
    """A slice of the table of documents that are left, one bit for each of their keys."""
    bits = np.zeros(SLICE, dtype=bool)
    bits[table.column("bit").to_numpy()] = True
    return pa.table({"slice": table.column("slice").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def _listed(bits: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, key) whose key has its bit: those on the list, and a few more."""
    for batch in batches:
        key = np.mod(batch.column(1).to_numpy(), LISTED)
        yield batch.filter(pa.array((bits[key >> 3] >> (key & 7).astype(np.uint8) & 1).astype(bool)))


def _shared(heavy: np.ndarray, heavy_counts: np.ndarray, buckets: int):
    """Of a fragment's segments the n-grams that two classes or more have, packed
    by bucket of their classes.  ``heavy`` are the sorted heavy n-grams."""
    def run(table: pa.Table) -> pa.Table:
        fragment = table.column("f")[0].as_py()
        node, size, length, ids = (_joined(table, c, k) for c, k in (("nodes", np.int64), ("sizes", np.int32), ("lengths", np.int32), ("ids", np.uint64)))
        first = _one_of_a_class(node)
        ids = ids[np.repeat(first, length)]
        node, size, length = node[first], size[first], length[first]
        if fragment < 0:
            counts, keep = heavy_counts[np.searchsorted(heavy, ids)], np.ones(len(ids), dtype=bool)
        else:
            counts = _counts(ids)
            keep = counts > 1
        held = np.bincount(np.repeat(np.arange(len(node)), length)[keep], minlength=len(node)).astype(np.int32)
        ids, counts, starts = ids[keep], counts[keep], np.cumsum(held) - held
        bucket = np.mod(node, buckets)
        order = np.argsort(bucket, kind="stable")
        order = order[held[order] > 0]
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        out = [[], [], [], [], [], [], []]
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            these = order[lo:hi]
            at = _ranges(starts[these], held[these])
            for column, value in zip(out, (int(bucket[these[0]]), fragment, *(x.tobytes() for x in (node[these], size[these], held[these], ids[at], counts[at])))):
                column.append(value)
        return pa.Table.from_arrays([*(pa.array(x, pa.int64()) for x in out[:2]), *(pa.array(x, pa.binary()) for x in out[2:])],
                                    names=["b", "f", "nodes", "sizes", "lengths", "ids", "counts"])
    return run


def _gathered(percent: int):
    """The sets of a bucket that may have a partner, each as PARTS + 1 parts at most:
    fragments are dealt to parts, the heavy n-grams are one of their own."""
    def run(table: pa.Table) -> pa.Table:
        node, size, length, ids, counts = (_joined(table, c, k) for c, k in (("nodes", np.int64), ("sizes", np.int32), ("lengths", np.int32), ("ids", np.int64), ("counts", np.int32)))
        fragment = np.repeat(table.column("f").to_numpy(), pc.binary_length(table.column("nodes")).to_numpy() // 8)
        part = np.where(fragment < 0, PARTS, fragment % PARTS)
        order = np.lexsort((part, node))
        at = _ranges((np.cumsum(length) - length)[order], length[order])
        node, size, part, length, ids, counts = node[order], size[order], part[order], length[order].astype(np.int64), ids[at], counts[at]
        sets = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        held = np.add.reduceat(length, sets)
        able = held >= (percent * size[sets].astype(np.int64) + 99) // 100
        of = np.repeat(able, np.diff(sets, append=len(node)))                   # the segments of these sets
        ids, counts = ids[np.repeat(of, length)], counts[np.repeat(of, length)]
        node_of, part, length = node[of], part[of], length[of]
        first = np.flatnonzero(np.concatenate([[True], (node_of[1:] != node_of[:-1]) | (part[1:] != part[:-1])])[:len(part)])
        ends = pa.array(np.append((np.cumsum(length) - length)[first], length.sum()), pa.int32())
        entries = pa.StructArray.from_arrays([pa.array(part[first].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(ids)),
                                              pa.ListArray.from_arrays(ends, pa.array(counts))], names=["part", "ids", "counts"])
        chosen = node[sets][able]
        offsets = pa.array(np.append(np.flatnonzero(np.concatenate([[True], node_of[first][1:] != node_of[first][:-1]])[:len(first)]), len(first)), pa.int32())
        return pa.Table.from_arrays([pa.array(chosen), pa.array(size[sets][able].astype(np.int64)), pa.array(held[able]), pa.ListArray.from_arrays(offsets, entries)],
                                    names=["node", "n", "held", "parts"])
    return run


def _prefixes(percent: int):
    """Index rows (gram, node, n, held, rest): the prefix of each set in order of
    (count, id), less what no other document has, which comes first; ``rest``
    counts the set's n-grams from this one on.  A set's first row has its sketch
    and its whole prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sketches, wholes = [[], [], [], [], []], [], []
            for node, n, held, parts in zip(*(batch.column(i) for i in range(4))):
                node, n, held = node.as_py(), n.as_py(), held.as_py()
                parts = parts.values
                ids = np.concatenate([parts.field("ids")[i].values.to_numpy() for i in range(len(parts))])
                counts = np.concatenate([parts.field("counts")[i].values.to_numpy() for i in range(len(parts))])
                take = n - (percent * n + 99) // 100 + 1 - (n - held)
                grams = ids[np.lexsort((ids, counts))[:take]]
                rest = held - np.arange(len(grams), dtype=np.int64)
                for column, value in zip(found, (grams, *(np.full(len(grams), x, dtype=np.int64) for x in (node, n, held)), rest)):
                    column.append(value)
                if len(grams):
                    bits = np.zeros(64 * SKETCH, dtype=np.uint8)
                    bits[ids.astype(np.uint64) % np.uint64(64 * SKETCH)] = 1
                    sketches += [np.packbits(bits).view(np.int64).tolist(), *[None] * (len(grams) - 1)]
                    wholes += [grams, *[None] * (len(grams) - 1)]
            if found[0]:
                yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in found), pa.array(sketches, pa.list_(pa.int64())),
                                                  pa.array(wholes, pa.list_(pa.int64()))],
                                                 names=["gram", "node", "n", "held", "rest", "sketch", "prefix"])
    return run


def _overlaps(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """u, v of the pairs (u, v, n_u, n_v) that are similar: overlaps are counted
    in each part of the sets and summed."""
    left = parts.select(F.col("node").alias("u"), F.col("part").alias("p"), F.col("ids").alias("ids_u"))
    right = parts.select(F.col("node").alias("v"), "part", F.col("ids").alias("ids_v"))
    both = pairs.join(right, "v").join(left, (pairs["u"] == left["u"]) & (F.col("p") == F.col("part"))).drop(left["u"])
    counted = both.groupBy("u", "v", "n_u", "n_v").agg(F.sum(F.size(F.array_intersect("ids_u", "ids_v"))).alias("o"))
    return counted.where(100 * F.col("o") >= percent * (F.col("n_u") + F.col("n_v") - F.col("o"))).select("u", "v")


def _can_match(n_u: str, n_v: str, rest_u: str, rest_v: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar if the n-gram at hand is the
    first that they share, so that they overlap in what comes from it on at most.
    Similar sets pass at their first shared n-gram, wherever else they fail."""
    return F.least(rest_u, rest_v) * (100 + percent) >= percent * (F.col(n_u) + F.col(n_v))


def _sketches_allow(percent: int) -> Column:
    """Whether the sketches of two sets let them be similar: a bit that the
    other's sketch lacks is an n-gram, at least, that the other lacks."""
    def overlap(held: str, own: str, other: str) -> Column:
        return F.col(held) - sum(F.bit_count(F.col(own)[i].bitwiseAND(F.bitwise_not(F.col(other)[i]))) for i in range(SKETCH))
    most = F.least(overlap("held_u", "sketch_u", "sketch"), overlap("held", "sketch", "sketch_u"))
    return most * (100 + percent) >= percent * (F.col("n_u") + F.col("n"))


def _number_of_fragments(grams: int | None) -> int:
    return max(LEAST_FRAGMENTS, -(-(grams or 0) // FRAGMENT))


def _list_of(docs: DataFrame, digests: DataFrame, text_col: str, n: int, percent: int, grams: int | None, sent) -> tuple[np.ndarray, DataFrame]:
    """The documents that are left after the heads are compared, one of each class:
    the table of their keys' bits, and rows (key, n)."""
    heads = _number_of_fragments((grams or 0) * (100 - percent + AHEAD) // 100)

    def segments(batches):
        return _segments(n, lambda nodes, sets: _deal_heads(nodes, sets, percent, heads, sent.value[0]))(batches)

    segmented = docs.select(F.col(text_col)).mapInArrow(segments, "f long, nodes binary, wanted binary, lengths binary, ids binary")
    left = segmented.groupBy("f").applyInArrow(_heads_shared(heads), _HEADS).groupBy("b").applyInArrow(_left, "node long")
    classes = digests.where("gram is null and node is not null").groupBy("node").agg(F.min(F.xxhash64("doc_id")).alias("key"), F.max("n").alias("n"))
    keys = stored(classes.join(left, "node").select("key", "n"), "ngram-listed")
    slot = F.pmod("key", F.lit(LISTED))
    slices = keys.select(F.floor(slot / SLICE).cast("int").alias("slice"), F.pmod(slot, F.lit(SLICE)).cast("int").alias("bit")).groupBy("slice").applyInArrow(_bits, "slice int, bits binary")
    bits = np.zeros((LISTED // SLICE, SLICE // 8), dtype=np.uint8)
    for r in slices.collect():                                                  # LISTED / 8 bytes at most
        bits[r["slice"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bits.ravel(), keys


def _partners(docs: DataFrame, digests: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The index of prefixes and the sets' parts of the classes that may have a partner."""
    spark = docs.sparkSession
    real = digests.where("gram is null")
    total = real.agg(F.sum("n").alias("grams"), F.count("node").alias("docs")).first()
    heavy = (digests.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= max(4 * HEAVY_IN_BATCH, HEAVY * total.docs)).collect())      # bounded by average set / HEAVY
    listed = np.sort(np.array([r.gram for r in heavy], dtype=np.int64).view(np.uint64))
    counts = {r.gram: r.n for r in heavy}
    heavy_counts = np.array([min(counts[int(g)], 2**31 - 1) for g in listed.view(np.int64)], dtype=np.int32)
    sent = spark.sparkContext.broadcast((listed, heavy_counts))

    bits, keys = _list_of(docs, digests, text_col, n, percent, total.grams, sent)
    table = spark.sparkContext.broadcast(bits)
    fragments = _number_of_fragments(keys.agg(F.sum("n")).first()[0])

    def segments(batches):
        return _segments(n, lambda nodes, sets: _deal(nodes, sets, fragments, sent.value[0]))(_listed(table.value, batches))

    def shared(table):
        return _shared(*sent.value, fragments)(table)

    keyed = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("key"))
    segmented = keyed.mapInArrow(segments, "f long, nodes binary, sizes binary, lengths binary, ids binary")
    packets = segmented.groupBy("f").applyInArrow(shared, _PACKETS)
    able = stored(packets.groupBy("b").applyInArrow(_gathered(percent), _SETS), "ngram-sets")
    index = stored(able.mapInArrow(_prefixes(percent), "gram long, node long, n long, held long, rest long, sketch array<long>, prefix array<long>"), "ngram-index")
    # of every set PARTS + 1 rows, at most, whatever the number of fragments
    parts = able.select("node", F.explode("parts").alias("x")).select("node", "x.part", "x.ids")
    return index, parts


def _around_centres(index: DataFrame, percent: int) -> DataFrame:
    """Pairs of every document of an n-gram with the one of it whose set has
    least of its own, the likeliest to be what the others were made from."""
    centres = index.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.min_by(F.struct("node", "n", "rest"), F.struct(F.col("n") - F.col("held"), F.col("node"))).alias("x"))
    centres = stored(centres.where("c > 1").select("gram", F.col("x.node").alias("u"), F.col("x.n").alias("n_u"), F.col("x.rest").alias("rest_u")), "ngram-centres")
    joined = index.join(centres, "gram").where((F.col("node") != F.col("u")) & _can_match("n_u", "n", "rest_u", "rest", percent))
    return joined.select("u", F.col("node").alias("v"), "n_u", F.col("n").alias("n_v")).distinct()


def _size_band(n: str, percent: int) -> Column:
    """Similar sets are in one band of sizes or in neighbouring ones."""
    width = math.log(100 / percent) * 1.000001      # beyond what rounding may add
    return F.floor(F.log(n) / width) if percent < 100 else F.col(n)


def _across_components(index: DataFrame, parts_of: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs that share an indexed n-gram and are in different components, each
    at the first n-gram that they share: one of them is outside its n-gram's
    largest component.  The join is on the n-gram and the band of sizes, and only
    pairs that size, position and sketch allow leave it."""
    rows = index.join(parts_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = stored(rows, "ngram-index-components")
    sizes = rows.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("c"))
    largest = sizes.groupBy("gram").agg(F.count(F.lit(1)).alias("several"), F.max_by("component", F.struct("c", "component")).alias("largest"))
    open_ = stored(largest.where("several > 1").select("gram", "largest"), "ngram-open")
    sketches = index.where("sketch is not null").select("node", "sketch", "prefix")
    rows = stored(rows.drop("sketch", "prefix").join(open_, "gram").join(sketches, "node"), "ngram-open-rows")
    band = _size_band("n", percent)
    rows = rows.withColumn("band", band)
    outside = rows.where(F.col("component") != F.col("largest")).withColumn("band", F.explode(F.array(*(F.col("band") + i for i in (-1, 0, 1))))).select(
        "gram", "band", F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("held").alias("held_u"),
        F.col("rest").alias("rest_u"), F.col("sketch").alias("sketch_u"), F.col("prefix").alias("prefix_u"), F.col("component").alias("of"))
    met = outside.join(rows, ["gram", "band"]).where((F.col("component") != F.col("of")) & _can_match("n_u", "n", "rest_u", "rest", percent)
                                           & _sketches_allow(percent)
                                           & (F.get(F.array_intersect("prefix_u", "prefix"), F.lit(0)) == F.col("gram")))
    met = met.select(*(F.when(F.col("u") < F.col("node"), F.col(a)).otherwise(F.col(b)).alias(name) for name, a, b in (
        ("u", "u", "node"), ("v", "node", "u"), ("n_u", "n_u", "n"), ("n_v", "n", "n_u")))).distinct()
    known = done.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return met.join(known, ["u", "v"], "left_anti")


def similar_classes(docs: DataFrame, digests: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """node, component of the classes of equal sets that are linked to another."""
    index, parts = _partners(docs, digests, id_col, text_col, n, percent)
    first = stored(_around_centres(index, percent), "ngram-pairs")
    links = stored(_overlaps(first, parts, percent), "ngram-links")
    grouped = stored(components(links), "ngram-components")
    second = stored(_across_components(index, grouped, first, percent), "ngram-pairs")
    more = stored(_overlaps(second, parts, percent), "ngram-links")
    return stored(components(links.union(more)), "ngram-components") if more.limit(1).count() else grouped


def _digests(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(_digest(n), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, node long, gram long"), "ngram-digests")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when 100 * overlap >= percent * union of their n-gram sets;
    component_id is the smallest id reachable by links.  Null, empty and blank texts
    have no n-grams and are linked with nothing.  Null ids are reached by no
    component but their own.  An empty table gives an empty result."""
    digests = _digests(docs, id_col, text_col, n)
    linked = similar_classes(docs, digests, id_col, text_col, n, percent)
    real = digests.where("gram is null")
    least = real.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "ngram-classes")
    smallest = stored(named.groupBy("component").agg(F.min("least").alias("component_id")), "ngram-smallest")
    labels = stored(named.join(smallest, "component").select("node", "component_id"), "ngram-labels")
    return real.join(labels, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _with_class(names: list[str], text_at: int, node: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = (ngram_set(t.as_py(), n) for t in batch.column(text_at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())], names=[*names, node])
    return run


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies, with all their columns: of each
    component the row of smallest id stays (of one id, any one), and every row
    without n-grams."""
    digests = _digests(docs, id_col, text_col, n)
    linked = similar_classes(docs, digests, id_col, text_col, n, percent)
    least = digests.where("gram is null and node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    ranked = least.join(linked, "node").groupBy("component").agg(F.min_by("node", F.struct(F.col("least").isNull(), "least", "node")).alias("stays"))
    gone = linked.join(ranked, "component").where("node <> stays").select("node")
    node, row, out = fresh(docs, "node", "row", "gone")
    schema = T.StructType([*docs.schema.fields, T.StructField(node, T.LongType())])
    marked = docs.mapInArrow(_with_class(docs.columns, docs.columns.index(text_col), node, n), schema)
    gone = gone.select(F.col("node").alias(out))
    one = (marked.where(F.col(node).isNotNull()).groupBy(node)
           .agg(F.min_by(F.struct(*docs.columns), F.struct(F.col(id_col).isNull(), F.col(id_col))).alias(row)))
    one = one.join(gone, one[node] == gone[out], "left_anti").select(f"{row}.*")
    wordless = ~F.coalesce(F.col(text_col), F.lit("")).rlike(f"[^{SPACE}]")
    return one.unionByName(docs.where(wordless))
