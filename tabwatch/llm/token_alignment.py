"""Which tokens of two tokenizers stand for the same bytes.

Both tokenizers cut the bytes of a text.  Where both have an end the text can be
parted, and what lies between two such cuts is a group of tokens of A and of B.
The cuts are found by divide and conquer: of an interval, a common end near its
middle is located by bisecting B's ends for A's, and both halves are cut in the
same way; an interval without a common end inside is a leaf, a group.  The intervals of
many documents are cut side by side, level by level.

A document's links (pairs of ids that share a group) are written once, each
pair with its number of occurrences.  How many documents have a pair is a
count over that table; to bring the counts back, the most frequent pairs are
broadcast (a bounded table), and only links of other pairs are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.bpe import default_files, encoder
from tabwatch.llm.common import ship, stored, tokenizer_path

MODEL = "piece_bpe_32k.model"
#: Bytes of text that are aligned together, and pairs that are made at a time.
TOGETHER, PAIRS = 1 << 20, 4_000_000
#: A group with more links than this is reduced to its distinct ids first.
CROWDED = 1024
#: Probes of an interval that are made one at a time.
SINGLE = 16
#: Rows of the broadcast table of frequent pairs, at most.
TABLE = 400_000
#: Code points of the longest text that the piece model takes at once.
LONG = 1 << 20

_CUT = re.compile(r"(?<=[^ ]) (?=[^ ])")
_loaded: dict = {}


class PieceModel:
    """A piece model's ids and their bytes."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
                      for i in range(len(self.model))]

    def ids(self, text: str) -> list[int]:
        """The ids of a text.  No piece goes on past a space, so a long text is cut at some."""
        if len(text) <= LONG:
            return self.model.encode(text, num_threads=1)
        out, at = [], 0
        while len(text) - at > LONG:
            cut = _CUT.search(text, at + LONG)
            if cut is None:
                break
            out += self.model.encode(text[at:cut.start()], num_threads=1)
            at = cut.end()                      # the model puts the space before the next part itself
        return out + self.model.encode(text[at:], num_threads=1)


def common_intervals(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last-but-one positions (a_lo, a_hi, b_lo, b_hi) of the leaf groups.

    ``ends_*`` are ascending byte ends; documents begin at the positions
    ``starts_*``, and both sides end together where a document ends."""
    a_lo, b_lo = starts_a, starts_b
    a_hi, b_hi = np.append(starts_a[1:], len(ends_a)), np.append(starts_b[1:], len(ends_b))
    tries = np.zeros(len(a_lo), dtype=np.int64)
    leaves = [[], [], [], []]
    while len(a_lo):
        inner = a_hi - a_lo - 1                                        # ends of A inside the interval
        leaf = (inner <= tries) | (b_hi - b_lo == 1)
        for column, x in zip(leaves, (a_lo, a_hi, b_lo, b_hi)):
            column.append(x[leaf])
        a_lo, a_hi, b_lo, b_hi, tries, inner = (x[~leaf] for x in (a_lo, a_hi, b_lo, b_hi, tries, inner))
        middle = a_lo + (inner - 1) // 2
        probe = middle + np.where(tries % 2 == 1, (tries + 1) // 2, -(tries // 2))      # outwards from the middle
        at = np.searchsorted(ends_b, ends_a[probe])
        hit = ends_b[at] == ends_a[probe]
        tries = tries + 1
        for i in np.flatnonzero(~hit & (tries >= SINGLE)):             # nothing near: probe twice as many at once
            order = np.arange(tries[i], min(2 * tries[i], inner[i]))
            near = middle[i] + np.where(order % 2 == 1, (order + 1) // 2, -(order // 2))
            place = np.searchsorted(ends_b, ends_a[near])
            found = np.flatnonzero(ends_b[place] == ends_a[near])
            tries[i] += len(order)
            if len(found):
                probe[i], at[i], hit[i] = near[found[0]], place[found[0]], True
        # both halves of an interval stay side by side, so that every level is bisected in order
        halves = 1 + hit
        right = np.cumsum(halves)[hit] - 1
        a_lo, a_hi, b_lo, b_hi, tries = (np.repeat(x, halves) for x in (a_lo, a_hi, b_lo, b_hi, tries))
        a_hi[right - 1] = a_lo[right] = probe[hit] + 1
        b_hi[right - 1] = b_lo[right] = at[hit] + 1
        tries[right - 1] = tries[right] = 0
    order = np.argsort(np.concatenate(leaves[0]))
    return tuple(np.concatenate(x)[order] for x in leaves)


def _distinct(ids: np.ndarray, group: np.ndarray, crowded: np.ndarray, n_groups: int) -> tuple[np.ndarray, ...]:
    """Ids in order of group, distinct ones with weights in the crowded groups, and where each group begins."""
    weight = np.ones(len(ids), dtype=np.int64)
    if crowded.any():
        of = crowded[group]
        pairs, counts = np.unique(np.stack([group[of], ids[of]]), axis=1, return_counts=True)
        group, ids = np.concatenate([group[~of], pairs[0]]), np.concatenate([ids[~of], pairs[1]])
        weight = np.concatenate([weight[~of], counts])
        order = np.argsort(group, kind="stable")
        group, ids, weight = group[order], ids[order], weight[order]
    return ids, weight, group, np.searchsorted(group, np.arange(n_groups + 1))


def pair_weights(ids_a: np.ndarray, ids_b: np.ndarray, groups: tuple[np.ndarray, ...], doc_of_group: np.ndarray, size_b: int) -> Iterator[tuple]:
    """(doc, pair, weight) arrays of every distinct pair of a document's links, in
    order of document and pair in each; pair is ``a * size_b + b``.  Large ones are made in
    slices by the id of A."""
    a_lo, a_hi, b_lo, b_hi = groups
    n = len(a_lo)
    crowded = (a_hi - a_lo) * (b_hi - b_lo) > CROWDED
    a, weight_a, group_a, _ = _distinct(ids_a, np.repeat(np.arange(n), a_hi - a_lo), crowded, n)
    b, weight_b, _, first_b = _distinct(ids_b, np.repeat(np.arange(n), b_hi - b_lo), crowded, n)
    each = np.diff(first_b)[group_a]                                   # links of every token of A
    slices = max(1, -(-int(each.sum()) // PAIRS))
    pairs_of_doc = (int(ids_a.max()) + 1) * size_b                     # documents are few: the key is far below 2^63
    for s in range(slices):
        mine = slice(None) if slices == 1 else a % slices == s
        reps, groups_of = each[mine], group_a[mine]
        offset = np.cumsum(reps) - reps
        other = np.arange(int(reps.sum())) + np.repeat(first_b[groups_of] - offset, reps)
        key = np.repeat(doc_of_group[groups_of] * pairs_of_doc + a[mine] * size_b, reps) + b[other]
        if crowded.any():
            weight = np.repeat(weight_a[mine], reps) * weight_b[other]
            order = np.argsort(key, kind="stable")
            key, weight = key[order], weight[order]
        else:
            key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        if len(new):
            yield (*np.divmod(key[new], pairs_of_doc), np.add.reduceat(weight, new) if crowded.any() else np.diff(new, append=len(key)))


class Aligner:
    """Both tokenizers of a worker, and the tables that it looks up."""

    def __init__(self, files: tuple[str, str], model: str):
        self.a, self.b = encoder(*files), PieceModel(model)
        self.bytes_a = self.a.token_bytes()
        self.len_a, self.len_b = (np.array(list(map(len, t)), dtype=np.int64) for t in (self.bytes_a, self.b.bytes))
        texts = lambda n, end: np.array([f"{i}{end}" for i in range(n)], dtype=object)
        self.names_a = [texts(len(self.len_a), end) for end in ",|"]
        self.names_b = [texts(len(self.len_b), end) for end in (",", ";", "")]

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B; none where the joined bytes are not the text's.  A's
        tokens are runs of the text's bytes, so their length tells."""
        none = np.empty(0, dtype=np.int64)
        if not text or "▁" in text:
            return none, none
        whole = " " + text
        data, b = whole.encode(), self.b.ids(text)
        if b"".join(map(self.b.bytes.__getitem__, b)) != data:
            return none, none
        a = np.array(self.a.plain(whole), dtype=np.int64)
        return (a, np.array(b, dtype=np.int64)) if self.len_a[a].sum() == len(data) else (none, none)

    def group_texts(self, ids_a: np.ndarray, ids_b: np.ndarray, groups: tuple[np.ndarray, ...], starts_a: np.ndarray, starts_b: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every document that has tokens."""
        a_lo, a_hi, b_lo, b_hi = groups
        out = np.empty(len(ids_a) + len(ids_b), dtype=object)
        names = self.names_a[0][ids_a]
        names[a_hi - 1] = self.names_a[1][ids_a[a_hi - 1]]
        out[np.arange(len(ids_a)) + np.repeat(b_lo, a_hi - a_lo)] = names
        names = self.names_b[0][ids_b]
        names[b_hi - 1] = self.names_b[1][ids_b[b_hi - 1]]
        last = np.append(starts_b[1:], len(ids_b)) - 1
        names[last] = self.names_b[2][ids_b[last]]
        out[np.arange(len(ids_b)) + np.repeat(a_hi, b_hi - b_lo)] = names
        cuts = [*(starts_a + starts_b).tolist(), len(out)]
        return ["".join(out[lo:hi].tolist()) for lo, hi in zip(cuts, cuts[1:])]

    def align(self, rows: pa.Array, docs: pa.Array, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Rows (row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs,
        weights) of some documents; of further pairs, n_a is null."""
        n = len(found)
        n_a, n_b = (np.array([len(f[side]) for f in found], dtype=np.int64) for side in (0, 1))
        has = np.flatnonzero(n_a)
        n_groups, n_links, sums = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), [""] * n
        parts = iter(())
        if len(has):
            ids_a, ids_b = (np.concatenate([found[i][side] for i in has]) for side in (0, 1))
            starts_a, starts_b = np.cumsum(n_a[has]) - n_a[has], np.cumsum(n_b[has]) - n_b[has]
            groups = common_intervals(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]), starts_a, starts_b)
            doc = has[np.searchsorted(starts_a, groups[0], side="right") - 1]
            np.add.at(n_groups, doc, 1)
            np.add.at(n_links, doc, (groups[1] - groups[0]) * (groups[3] - groups[2]))
            for i, text in zip(has, self.group_texts(ids_a, ids_b, groups, starts_a, starts_b)):
                sums[i] = hashlib.sha256(text.encode()).hexdigest()
            parts = pair_weights(ids_a, ids_b, groups, doc, len(self.len_b))
        empty = (np.zeros(0, dtype=np.int64),) * 3
        own = [docs, *(pa.array(x) for x in (n_a, n_b, n_groups, n_links, sums))]
        yield _link_batch(rows, own, *next(parts, empty))
        for doc, pair, weight in parts:
            yield _link_batch(rows, [pa.nulls(n, c.type) for c in own], doc, pair, weight)


def _link_batch(rows: pa.Array, own: list[pa.Array], doc: np.ndarray, pair: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.searchsorted(doc, np.arange(len(rows) + 1)), pa.int32())
    return pa.RecordBatch.from_arrays([rows, *own, pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(weight, pa.int64()))],
                                      names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "weights"])


def document_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str] | None = None, model: str | None = None) -> DataFrame:
    """The table of links, written once: row, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs, weights.  Texts that are null, empty or not given back by the
    joined tokens have no tokens.  A document with very many pairs has further
    rows, whose n_a is null."""
    ship(docs.sparkSession)
    files, model = files or default_files(), model or tokenizer_path(MODEL)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _loaded.get("of") != (files, model):
            _loaded.update(of=(files, model), aligner=Aligner(files, model))
        aligner = _loaded["aligner"]
        for batch in batches:
            at, size, found = 0, 0, []
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                found.append(aligner.ids(text))
                size += len(text or "")
                if size >= TOGETHER or i == batch.num_rows - 1:
                    yield from aligner.align(batch.column(2)[at:i + 1], batch.column(0)[at:i + 1], found)
                    at, size, found = i + 1, 0, []

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                       "pairs array<long>, weights array<long>"), "alignment-links")


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """pair, n (documents), best: whether no other pair of its id of A has more."""
    counts = stored(links.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "alignment-counts")
    most = counts.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("most"))       # a row for an id of A
    return counts.join(F.broadcast(most), F.expr(f"pair div {size_b}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_pairs(counts: DataFrame, size: int = TABLE) -> DataFrame:
    """The pairs of most documents, ``size`` at most: the steps of an eighth of a
    binary order from the top that fit together."""
    step = F.floor(F.log2("n") * 8)
    below, taken = None, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):       # 504 steps at most
        taken += r["count"]
        if taken > size:
            break
        below = r["step"]
    return counts.where(F.lit(False) if below is None else step >= below)


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str] | None = None, model: str | None = None,
                 table: int = TABLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts whose joined tokens are not the text, have zeros
    and ''.  Special strings in a text are plain text.  Every row is a document, repeated ones
    and those without id too.  Ties of an id's highest count are all best.  An
    empty table gives an empty result."""
    model = model or tokenizer_path(MODEL)
    written = document_links(docs, id_col, text_col, files, model)
    size_b = len(PieceModel(model).bytes)
    links = (written.select("row", F.explode(F.arrays_zip("pairs", "weights")).alias("x"))
             .select("row", F.col("x.pairs").alias("pair"), F.col("x.weights").alias("weight")))
    counts = stored(pair_counts(links, size_b), "alignment-pairs")
    often = frequent_pairs(counts, table)
    counted = lambda df: df.select("row", (F.col("weight") * F.col("n")).alias("s"), F.when(F.col("best"), F.col("weight")).otherwise(F.lit(0)).alias("b"))
    seldom = links.join(F.broadcast(often.select("pair")), "pair", "left_anti").join(counts, "pair")
    sums = counted(links.join(F.broadcast(often), "pair")).union(counted(seldom)).groupBy("row").agg(F.sum("b").alias("n_best"), F.sum("s").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return written.where("n_a is not null").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
