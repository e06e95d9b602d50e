"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated as often as its
target needs.  A document's virtual finish time is the number of words of its
source up to and including it, divided by the source's target: at any virtual
time all queues are equally far along, and at time 1 the mix holds its whole
budget.  The mix is the documents in global order of finish time, truncated
there: a document that begins after time 1 is out, and the one document of each
source that is in service at time 1 is cut at its source's share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.common import fresh, stored, word_count
from tabwatch.operators.ordered import prefix_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = 17
#: About so many documents of a source are put in order in one task.
BUCKET_ROWS = 4000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """source, n_docs, source_size, target from rows of (source, size).

    Sources by code point, null last, take the weights in turn.  Targets share
    ``share`` times all words by weight; none is above ``repeats`` times its
    source, what is over goes to the others by weight.  In order of the ratio of
    cap to weight, a source is capped when its ratio is at most the level that
    the rest would reach.  The table has one row per source of the mix; its running
    sums are made by ranges, so the sources may be many."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    per = prefix_sums(per.withColumn("none", F.col("source").isNull()), ["none", "source"], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", repeats * F.col("source_size"))
    per = per.withColumn("ratio", F.col("cap") / F.col("weight"))
    per = stored(prefix_sums(per, ["ratio", "none", "source"], {"cap_before": F.col("cap"), "weight_before": F.col("weight")}), "mix-levels")
    words, weight_sum = per.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (share * F.lit(words) - F.col("cap_before")) / (F.lit(weight_sum) - F.col("weight_before"))
    per = per.withColumn("level", level).withColumn("capped", F.col("ratio") <= F.col("level"))
    reached = per.agg(F.max(F.when(~F.col("capped"), F.col("level")))).first()[0]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.lit(reached).cast("double") * F.col("weight"))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def _shuffle_key(id_col, size) -> F.Column:
    """60 bits that put the documents of a source in a fixed random order."""
    name = F.concat_ws(":", F.lit(str(SEED)), F.coalesce(id_col.cast("string"), F.lit("null")), size.cast("string"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def _queued(docs: DataFrame, sizes: DataFrame, targets: DataFrame, c: dict[str, str]) -> DataFrame:
    """``docs`` (with the columns c[source], c[id], c[size], c[key]) and, of each
    row, c[source_size], c[target] and c[before], the words of its source ahead.

    A source's documents are divided by ranges of the shuffle key: sums of the
    ranges first, then an order inside each, so that no task gets a source."""
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET_ROWS)).cast("long")
    t = targets.select(F.col("source").alias(c["t_source"]), n_buckets.alias(c["n"]),
                       F.col("source_size").alias(c["source_size"]), F.col("target").alias(c["target"]))

    def bucketed(df, source, key):
        joined = df.join(t, df[source].eqNullSafe(t[c["t_source"]]))
        return joined.withColumn(c["bucket"], F.shiftright(F.shiftright(F.col(key), 20) * F.col(c["n"]), 40)).drop(c["t_source"], c["n"])

    sums = bucketed(sizes, "source", "key").groupBy("source", c["bucket"]).agg(F.sum("size").alias("total"))
    ahead = Window.partitionBy("source").orderBy(c["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias(c["t_source"]), F.col(c["bucket"]).alias(c["t_bucket"]),
                          F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias(c["before"]))
    rows = bucketed(docs, c["source"], c["key"])
    inside = (Window.partitionBy(c["source"], c["bucket"]).orderBy(c["key"], c["id"], c["size"])
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn(c["inside"], F.coalesce(F.sum(c["size"]).over(inside), F.lit(0)))
    return (rows.join(offsets, rows[c["source"]].eqNullSafe(offsets[c["t_source"]]) & (rows[c["bucket"]] == offsets[c["t_bucket"]]))
            .withColumn(c["before"], F.col(c["before"]) + F.col(c["inside"]))
            .drop(c["t_source"], c["t_bucket"], c["bucket"], c["inside"]))


def _share(c: dict[str, str], turn) -> F.Column:
    """Words that the mix takes of a document in its turn-th repeat."""
    left = F.floor(c["target"]) - F.col(c["before"]) - turn * F.col(c["source_size"])
    return F.greatest(F.lit(0), F.least(F.col(c["size"]), left)).cast("long")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    return base.withColumn("key", _shuffle_key(F.col("doc_id"), F.col("size")))


def mix_shares(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``, in mix order: doc_id, size, source_size,
    target, taken, virtual_finish.

    Null and blank texts have size 0 and are never taken; null is a source of
    its own; a source without words has target 0 and no finish time.  Rows
    that repeat an id and size share a place in the shuffle; which comes first
    does not show in the result.  An empty table gives an empty result."""
    sizes = stored(_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, repeats), "mix-targets")
    c = {k: k for k in ("source", "key", "size", "source_size", "target", "before")} | {
        "id": "doc_id", "t_source": "t_source", "n": "n_buckets", "bucket": "bucket", "t_bucket": "t_bucket", "inside": "inside"}
    rows = _queued(sizes, sizes, targets, c)
    taken = sum((_share(c, turn) for turn in range(1, repeats)), _share(c, 0))
    finish = F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                       finish.alias("virtual_finish")).orderBy("virtual_finish")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          chars_col: str | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
          repeats: int = REPEATS) -> DataFrame:
    """The mix itself, with the columns of ``docs``, in order of virtual finish
    time: documents taken twice come twice, and the one document of each source
    at the end of its share is cut after the words taken (``chars_col``, if
    given, then counts the code points that are left).  Null and blank texts are
    not taken; null is a source of its own; an empty table gives an empty result."""
    sizes = _sizes(docs, id_col, text_col, source_col)
    targets = stored(source_targets(sizes, weights, share, repeats), "mix-targets")
    names = ("size", "key", "source_size", "target", "before", "t_source", "n", "bucket", "t_bucket", "inside", "turn", "finish", "taken")
    c = dict(zip(names, fresh(docs, *names))) | {"source": source_col, "id": id_col}
    rows = docs.withColumn(c["size"], word_count(F.col(text_col)))
    rows = rows.withColumn(c["key"], _shuffle_key(F.col(id_col), F.col(c["size"])))
    rows = _queued(rows, sizes, targets, c)
    rows = rows.withColumn(c["turn"], F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    rows = rows.withColumn(c["taken"], _share(c, F.col(c["turn"]))).where(F.col(c["taken"]) > 0)
    done = (F.col(c["before"]) + F.col(c["size"]) + F.col(c["turn"]) * F.col(c["source_size"])) / F.col(c["target"])
    cut = F.col(c["taken"]) < F.col(c["size"])
    # after each word: white space and the word that follows make one piece
    pieces = F.split(F.col(text_col), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(cut, F.array_join(F.slice(pieces, F.lit(1), F.col(c["taken"]).cast("int")), "")).otherwise(F.col(text_col))
    rows = rows.withColumn(c["finish"], done).withColumn(text_col, text)
    if chars_col:
        rows = rows.withColumn(chars_col, F.when(cut, F.length(text_col).cast("long")).otherwise(F.col(chars_col)))
    return rows.orderBy(c["finish"], id_col).select(*docs.columns)
