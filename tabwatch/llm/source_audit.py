"""How far the sources of a language differ in their terms.

Counting is one pass: every task sums its own counts per source and term
before they are shuffled.  Each language keeps the terms of enough documents; they are
dealt to blocks of terms of a similar total, so that most blocks know few counts.
A block stores, per source and count, the bitset of the terms that the source
has so often.  Two sources meet in a block as sets of levels: AND and popcount give the
terms of every pair of counts, the joint cells, which are multiplied by the
term's value f for these counts.  Terms that one side lacks are the
complement, so only what both have is looked at.  No term is compared alone.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.common import ship, stored

#: Documents that a kept term must have in its language.
LEAST_DOCUMENTS = 10
#: Ranks of the terms that are returned.
TOP = 10
#: Terms of a block, about.
BLOCK = 512
SCALE, ADDED = 1_000_000_000, 2
#: Counts that a task holds before it sends them.
HELD = 400_000
#: 64-bit words that one AND makes at most.
WORDS_AT_ONCE = 1 << 20

# bytes that part terms become a space, A-Z become a-z; the bytes of other characters stay
_TABLE = bytes(32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) of a task's documents, and (lang, source, null,
    0, 0) of every group that it has seen."""
    groups: dict[tuple, dict[bytes, list]] = defaultdict(dict)
    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            group, own = groups[lang, source], Counter(text.as_py().translate(_TABLE).split())
            before = len(group)
            for term, n in own.items():
                entry = group.get(term)
                if entry is None:
                    group[term] = [n, 1]
                else:
                    entry[0] += n
                    entry[1] += 1
            held += len(group) - before
            if held > HELD:
                yield _count_batch(groups)
                groups, held = defaultdict(dict), 0
    yield _count_batch(groups)


def _count_batch(groups: dict) -> pa.RecordBatch:
    out = [[], [], [], [], []]
    for (lang, source), terms in groups.items():
        out[0] += [lang] * (len(terms) + 1)
        out[1] += [source] * (len(terms) + 1)
        out[2] += [None, *terms]
        out[3] += [0, *(n for n, _ in terms.values())]
        out[4] += [0, *(df for _, df in terms.values())]
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.binary()).cast(pa.string()),
                                       pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())], names=["lang", "source", "term", "n", "df"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), df (documents) of every group, and one
    row of null term for each group.  Null text, language and source count as ''."""
    ship(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    sent = rows.mapInArrow(_counts, "lang string, source string, term string, n long, df long")
    return sent.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column, total: Column, kept: Column, scale: int = SCALE, added: int = ADDED) -> Column:
    """1 + floor(scale * (count + added) / (total + added * kept)), in integers."""
    wide = lambda c: c.cast("decimal(24,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide(count + added) * F.lit(scale).cast("decimal(11,0)"), wide(total + added * kept))


def value(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)), in integers."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(counts: DataFrame, least_documents: int = LEAST_DOCUMENTS, block: int = BLOCK) -> DataFrame:
    """lang, term, all_n (in the language), size, bucket of the terms that enough
    documents of the language have.  ``size`` (the total's binary digits) and
    ``bucket`` name the term's block; there are as many buckets as the terms of
    that size need."""
    of_lang = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("df").alias("df"))
    kept = of_lang.where(F.col("df") >= least_documents).select("lang", "term", "all_n", F.length(F.bin("all_n")).alias("size"))
    kept = stored(kept, "audit-kept")
    dealt = kept.groupBy("lang", "size").agg(F.ceil(F.count(F.lit(1)) / block).alias("buckets"))     # 63 rows of a language at most
    return kept.join(dealt, ["lang", "size"]).withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets"))).drop("buckets")


def group_totals(counts: DataFrame, terms: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total, all_total, n_kept of every group, one without kept terms
    too.  ``kept`` are the groups' counts of the kept ``terms``."""
    groups = counts.where("term is null").select("lang", "source")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_kept"), F.sum("all_n").alias("all_total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *map(zero, ("total", "all_total", "n_kept")))


def _bitsets(table: pa.Table) -> pa.Table:
    """Of one block: the bitset of the terms of every source and count."""
    terms = table.column("term").combine_chunks().dictionary_encode()
    ids, n_terms = terms.indices.to_numpy(), len(terms.dictionary)
    sources = table.column("source").combine_chunks().dictionary_encode()
    source, n = sources.indices.to_numpy(), table.column("n").to_numpy()
    order = np.lexsort((ids, n, source))
    source, n, ids = source[order], n[order], ids[order]
    starts = np.flatnonzero(np.concatenate([[True], (source[1:] != source[:-1]) | (n[1:] != n[:-1])]))
    bits = np.zeros((len(starts), -(-n_terms // 64) * 64), dtype=bool)
    bits[np.cumsum(np.isin(np.arange(len(ids)), starts)) - 1, ids] = True
    m = len(starts)
    one = lambda name: pa.array([table.column(name)[0].as_py()] * m, table.schema.field(name).type)
    return pa.Table.from_arrays([one("lang"), one("size"), one("bucket"), pa.array(np.full(m, n_terms), pa.int64()), sources.dictionary.take(pa.array(source[starts])),
                                 pa.array(n[starts]), pa.array([row.tobytes() for row in np.packbits(bits, axis=1, bitorder="little")], pa.binary())],
                                names=["lang", "size", "bucket", "block_terms", "source", "n", "bits"])


def count_bitmaps(kept: DataFrame) -> DataFrame:
    """lang, size, bucket, block_terms, source, n, bits: per block, the bitset of
    the terms that a source has n times.  A term that a source lacks is in none of its bitsets."""
    rows = kept.select("lang", "size", "bucket", "source", "term", "n")
    return rows.groupBy("lang", "size", "bucket").applyInArrow(
        _bitsets, "lang string, size int, bucket long, block_terms long, source string, n long, bits binary")


def _value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q                      # at most a billion: the square is exact
    return d * d // (p + q)


def _share(count: int, total: int, kept: int) -> int:
    return 1 + SCALE * (count + ADDED) // (total + ADDED * kept)


class _Levels:
    """The levels of one source in a block: their bitsets, sizes and shares."""

    def __init__(self, total: int, kept: int, counts: list[int], bits: list[bytes], words: int):
        self.bits = np.frombuffer(b"".join(bits), dtype="<u8").reshape(len(bits), words)
        self.sizes = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.shares = np.array([_share(c, total, kept) for c in counts], dtype=np.int64)
        self.absent = np.int64(_share(0, total, kept))


def _joint(g: _Levels, others: list[_Levels], n_terms: int) -> np.ndarray:
    """Value of g against each of the others, summed over a block's terms."""
    bits, shares = np.concatenate([h.bits for h in others]), np.concatenate([h.shares for h in others])
    sizes, absent = np.concatenate([h.sizes for h in others]), np.array([h.absent for h in others])
    of = np.repeat(np.arange(len(others)), [len(h.sizes) for h in others])
    left = sizes.copy()                                                   # of each of their levels, what g lacks
    both = np.zeros(len(others), dtype=np.int64)                          # terms that g and the other have
    out = np.zeros(len(others), dtype=np.int64)
    step = max(1, WORDS_AT_ONCE // max(1, bits.size))
    for at in range(0, len(g.sizes), step):
        part = g.bits[at:at + step]
        cells = np.bitwise_count(part[:, None, :] & bits[None, :, :]).sum(axis=2, dtype=np.int64)
        share_g, size_g = g.shares[at:at + step], g.sizes[at:at + step]
        left -= cells.sum(axis=0)
        np.add.at(out, of, (cells * _value(share_g[:, None], shares[None, :])).sum(axis=0))
        shared = np.zeros((len(part), len(others)), dtype=np.int64)
        np.add.at(shared.T, of, cells.T)
        both += shared.sum(axis=0)
        out += ((size_g[:, None] - shared) * _value(share_g[:, None], absent[None, :])).sum(axis=0)
    np.add.at(out, of, left * _value(g.absent, shares))
    had = np.zeros(len(others), dtype=np.int64)
    np.add.at(had, of, sizes)
    return out + (n_terms - int(g.sizes.sum()) - had + both) * _value(g.absent, absent)


def _pair_values(table: pa.Table) -> pa.Table:
    """Of one block with a row, at least, of every source: (lang, source, other, value) of each pair."""
    rows = defaultdict(list)
    for source, total, kept, n, bits in zip(*(table.column(c).to_pylist() for c in ("source", "total", "n_kept", "n", "bits"))):
        rows[source, total, kept].append((n, bits))
    n_terms = table.column("block_terms")[0].as_py()
    words = -(-n_terms // 64)
    names, levels = [], []
    for (source, total, kept), found in sorted(rows.items()):
        found = [(n, b) for n, b in found if n is not None]
        names.append(source)
        levels.append(_Levels(total, kept, [n for n, _ in found], [b for _, b in found], words))
    out = [[], [], []]
    for i in range(len(names) - 1):
        out[0] += [names[i]] * (len(names) - i - 1)
        out[1] += names[i + 1:]
        out[2] += _joint(levels[i], levels[i + 1:], n_terms).tolist()
    lang = table.column("lang")[0].as_py()
    return pa.Table.from_arrays([pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                                names=["lang", "source", "other", "value"])


def pair_divergence(bitmaps: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, other, value of every ordered pair of a language's sources.
    Every block gets a row of every source, those without its terms too."""
    blocks = bitmaps.select("lang", "size", "bucket", "block_terms").distinct()
    every = blocks.join(totals.select("lang", "source", "total", "n_kept"), "lang")
    levels = every.join(bitmaps.drop("block_terms"), ["lang", "size", "bucket", "source"], "left")
    sums = (levels.groupBy("lang", "size", "bucket").applyInArrow(_pair_values, "lang string, source string, other string, value long")
            .groupBy("lang", "source", "other").agg(F.sum("value").alias("value")))
    sums = stored(sums, "audit-pairs")
    both = sums.union(sums.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    pairs = totals.select("lang", "source").join(totals.select("lang", F.col("source").alias("other")), "lang").where("source <> other")
    return pairs.join(both, ["lang", "source", "other"], "left").select("lang", "source", "other", F.coalesce("value", F.lit(0)).cast("long").alias("value"))


def term_divergence(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, term, value of the terms that a group uses more than its language."""
    rows = kept.join(totals, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("n_kept")), share(F.col("all_n"), F.col("all_total"), F.col("n_kept"))
    return rows.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q").select("lang", "source", "term", value(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: for every group the other sources of
    its language by divergence (part ``pair``, all), and the terms that mark it
    (part ``term``, ``top`` of them).

    Null text, language and source count as ''.  Every row is a document, repeated
    ones too.  Equal values rank by item.  A language without kept terms has
    pairs of value 0, and a language of one source none.  An empty table gives an
    empty result."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "audit-counts")
    terms = stored(kept_terms(counts, least_documents), "audit-terms")
    kept = stored(counts.where("term is not null").drop("df").join(terms, ["lang", "term"]), "audit-kept-counts")
    totals = stored(group_totals(counts, terms, kept), "audit-totals")
    bitmaps = stored(count_bitmaps(kept), "audit-bitmaps")
    pairs = pair_divergence(bitmaps, totals).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    marks = term_divergence(kept, totals).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(by))
    return ranked(pairs).union(ranked(marks).where(F.col("rank") <= top))
