"""Token counts of a piece model without a shuffle of pre-tokens.

No piece of the model continues past a space, so a text is a row of pre-tokens
(spaces and the word after them) that are encoded apart.  Two tiers: a table of
the frequent pre-tokens' lengths is made from the corpus (each task sends the
bounded head of its own counts) and broadcast; other pre-tokens are encoded once
per worker and kept in a bounded cache.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import ship, tokenizer_path

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Entries of the broadcast table, of a task's counts while it counts and when it is
#: done, and of a worker's cache; the longest pre-token that any of them holds.
TABLE, COUNTING, SENT, CACHED, LONGEST = 50_000, 200_000, 4_000, 250_000, 64

_SEGMENTS = re.compile(r" *[^ ]+| +")
_lengths: dict = {}


class Lengths(dict):
    """Pre-token (without its first space) to number of tokens."""

    def __init__(self, path: str, frequent: dict[str, int]):
        import sentencepiece
        super().__init__(frequent)
        self.before: dict[str, int] = {}        # the generation before: a piece in use moves over from it
        self.frequent, self.model = frequent, sentencepiece.SentencePieceProcessor(model_file=path)

    def __missing__(self, piece: str) -> int:
        n = self.before.get(piece)
        if n is None:
            n = len(self.model.encode(piece))
        if len(piece) <= LONGEST:
            if len(self) >= CACHED // 2:
                self.before = dict(self)
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a text, as the model gives them."""
        if not text:
            return 0
        text = text.replace("▁", " ")      # the model's sign for a space counts as one
        pieces = text.split(" ")
        if "" not in pieces:
            return sum(map(self.__getitem__, pieces))
        total = 0
        for segment in _SEGMENTS.findall(" " + text):
            total += 1 if segment == " " else self[segment[1:]]
        return total


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for value in batch.column(0):
            seen.update(value.as_py().split(" "))
            if len(seen) > COUNTING:
                seen = Counter(dict(seen.most_common(COUNTING // 3)))
    head = [(p, n) for p, n in seen.most_common(SENT) if p and n > 1 and len(p) <= LONGEST]
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in head], pa.string()), pa.array([n for _, n in head], pa.int64())], names=["piece", "n"])


def frequent_lengths(docs: DataFrame, text_col: str, path: str, size: int = TABLE) -> dict[str, int]:
    """Lengths of the corpus's ``size`` most frequent pre-tokens: what comes to
    the driver is bounded by ``size`` entries of ``LONGEST`` characters."""
    import sentencepiece
    heads = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(_frequent, "piece string, n long")
    top = [r.piece for r in heads.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size).collect()]
    return dict(zip(top, map(len, sentencepiece.SentencePieceProcessor(model_file=path).encode(top, num_threads=1)))) if top else {}


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = LIMIT, table: int = TABLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null counts as empty: no bytes, no tokens.  Special strings in a text are
    ordinary text.  An empty table gives an empty result."""
    ship(docs.sparkSession)
    path = path or tokenizer_path(MODEL)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text_col, path, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _lengths.get("of") != (path, shared.value):
            _lengths.update(of=(path, shared.value), counts=Lengths(path, shared.value))
        counts = _lengths["counts"]
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(counts.count(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
