"""Quality classifier by attention over passages.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded from
its text alone (characters by class, word shapes, repetition, hashed words),
goes through one hidden layer, and gets a gated attention weight; the score is of
the weighted sum of the bag's passages.  Encoder, attention and classifier are
learned together from document labels (Ilse, Tomczak and Welling, 2018).
Bags are made and scored in tasks; a bounded sample of labelled bags is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import ship, stored

PASSAGE = 128
#: Most labelled documents that the model is fitted on, and most passages of all of
#: them together (documents are taken whole; scoring takes all).
MAX_LABELLED, MAX_PASSAGES = 6000, 384_000
HIDDEN, ATTENTION, STEPS, RATE, DECAY = 24, 12, 250, 0.02, 1e-4
SEED = 3
BUCKETS = 48
_MARKS = b".,;:'\"!?()-"

# character classes of a byte: lower, upper, digit, space, mark of a sentence, sign, beyond ASCII
_CLASS = np.full(256, 5, dtype=np.int64)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r", _MARKS)):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 6
#: One bit per class, for the classes that a word has.
_BIT = (1 << _CLASS).astype(np.uint8)
_LOWER, _UPPER, _SIGN, _BEYOND = 1, 2, 32, 64
_ENDS = np.isin(np.arange(256), list(b".,;:!?"))
_SHAPES = 6
#: The shapes of each set of shapes, as a row of ones and zeros.
_SHAPE_SETS = (np.arange(1 << _SHAPES)[:, None] >> np.arange(_SHAPES) & 1).astype(np.float64)
N_FEATURES = 7 + _SHAPES + BUCKETS + 5


def encode(text: str | None) -> np.ndarray:
    """One row of features per passage; a text without words is one empty passage.

    All words of the text are looked at together; of each, only the hash is made
    on its own, and the ends of one of over 15 bytes are stripped."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros((1, N_FEATURES), dtype=np.float32)
    n = -(-len(words) // PASSAGE)
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = _CLASS[raw]
    edges = np.flatnonzero(np.diff(kind != 3, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    length = end - start
    at = np.arange(len(words)) // PASSAGE
    first = np.arange(0, len(words), PASSAGE)
    size = np.diff(first, append=len(words)).astype(np.float64)
    # where passages begin: the first with the text, others with their first word
    begin = start[first]
    begin[0] = 0
    chars = np.bincount(np.repeat(np.arange(n) * 7, np.diff(begin, append=len(raw))) + kind, minlength=7 * n).reshape(n, 7).astype(np.float64)
    chars /= chars.sum(axis=1, keepdims=True)
    has = np.bitwise_or.reduceat(_BIT[raw], start)
    long = length > 15
    for i in np.flatnonzero(long):
        long[i] = len(words[i].strip(_MARKS)) > 15
    flags = ((has & (_LOWER | _UPPER) == _UPPER) & (length > 1), kind[start] == 1, _ENDS[raw[end - 1]], has & (_LOWER | _UPPER | _BEYOND) == 0,
             has & _SIGN != 0, long)
    shape = sum(f.astype(np.int64) << i for i, f in enumerate(flags))
    shapes = np.bincount(at << _SHAPES | shape, minlength=n << _SHAPES).reshape(n, -1) @ _SHAPE_SETS
    code = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    buckets = np.bincount(at * BUCKETS + (code % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
    again = np.bincount(at[1:][(code[1:] == code[:-1]) & (at[1:] == at[:-1])], minlength=n)
    # a row of codes per passage, the last one filled up with a code that it has
    rows = np.sort(np.concatenate([code, np.repeat(code[-1:], n * PASSAGE - len(code))]).reshape(n, PASSAGE), axis=1)
    distinct = 1 + np.count_nonzero(rows[:, 1:] != rows[:, :-1], axis=1)
    mean = np.add.reduceat(length, first) / size
    lines = np.add.reduceat(raw == 10, begin, dtype=np.int64)
    rest = np.stack([again / size, distinct / size, mean / 10, np.log(size), lines / size], axis=1)
    return np.concatenate([chars, shapes / size[:, None], buckets / size[:, None], rest], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionModel:
    """h = relu(x W); a = softmax(w . tanh(h V) * sigmoid(h U)); p = sigmoid(c . sum(a h) + b)."""

    def __init__(self, rng: np.random.Generator):
        scale = lambda a, b: rng.normal(0, (2 / a) ** 0.5, (a, b))
        self.p = {"W": scale(N_FEATURES + 1, HIDDEN), "V": scale(HIDDEN, ATTENTION) / 2, "U": scale(HIDDEN, ATTENTION) / 2,
                  "w": scale(ATTENTION, 1) / 2, "c": scale(HIDDEN, 1) / 2, "b": np.zeros(1)}
        self.mean, self.std = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        p = self.p
        x = np.concatenate([np.clip((x - self.mean) / self.std, -8, 8), np.ones((len(x), 1))], axis=1)
        h = np.maximum(x @ p["W"], 0)
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = np.clip((t * s) @ p["w"], -30, 30)[:, 0]
        bag = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(x)))
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "bag": bag, "z": z, "y": _sigmoid(z @ p["c"] + p["b"])[:, 0]}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        """Score of each bag; all of a bag's passages count."""
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return self._forward(np.concatenate(bags).astype(np.float64), starts)["y"] if bags else np.empty(0)

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> None:
        x = np.concatenate(bags).astype(np.float64)
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        self.mean, self.std = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            f, p, g = self._forward(x, starts), self.p, {}
            dy = ((f["y"] - labels) / len(labels))[:, None]
            g["c"], g["b"] = f["z"].T @ dy, dy.sum(axis=0)
            dz = (dy @ p["c"].T)[f["bag"]]
            da = (dz * f["h"]).sum(axis=1)
            de = (f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[f["bag"]]))[:, None]
            g["w"] = (f["t"] * f["s"]).T @ de
            dt, ds = de @ p["w"].T * f["s"] * (1 - f["t"] ** 2), de @ p["w"].T * f["t"] * f["s"] * (1 - f["s"])
            g["V"], g["U"] = f["h"].T @ dt, f["h"].T @ ds
            dh = (f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (f["h"] > 0)
            g["W"] = f["x"].T @ dh
            for k in p:
                m, v = moments[k]
                grad = g[k] + DECAY * p[k]
                m[...] = 0.9 * m + 0.1 * grad
                v[...] = 0.999 * v + 0.001 * grad ** 2
                p[k] = p[k] - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per batch: bags can be large."""
    for batch in batches:
        for at, value in enumerate(batch.column(2)):
            x = encode(value.as_py())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, 1) for i in (0, 1)), pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary())],
                                             names=["key", "label", "n", "bag"])


def _within(sizes: list, budget: int) -> list:
    """The keys of the first whole documents that the budget of passages holds;
    a document that is larger than the budget itself is passed over."""
    taken, total = [], 0
    for key, n in sizes:
        if n > budget:
            continue
        total += n
        if total > budget:
            break
        taken.append(key)
    return taken


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_labelled: int = MAX_LABELLED) -> AttentionModel:
    """The model of the labelled documents that are not held out: of more than
    ``max_labelled`` label rows, those of least id hash, and of these whole
    documents, in the same order, up to ``MAX_PASSAGES`` passages.  Of several documents of
    one id, the one of least text hash is learned from.  Null labels and labels
    without a document are left out; without any, every score is 0.5."""
    ship(docs.sparkSession)
    usable = labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("long").alias("label"))
    usable = usable.where("key is not null and label is not null").where(~held_out(F.col("key")))
    sample = usable.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("key"))
    rows = rows.groupBy("key").agg(F.first("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    bags = stored(rows.select("key", "label", "text").mapInArrow(_bags, f"key {kind}, label long, n long, bag binary"), "quality-bags")
    sizes = [tuple(r) for r in bags.select("key", "n").orderBy(F.xxhash64("key"), "key").collect()]      # max_labelled rows at most
    taken = _within(sizes, MAX_PASSAGES)
    some = bags if len(taken) == len(sizes) else bags.where(F.col("key").isin(taken))
    found = some.select("label", "bag").collect()     # bounded by max_labelled bags and MAX_PASSAGES passages
    model = AttentionModel(np.random.default_rng(SEED))
    if found:
        found.sort(key=lambda r: (r.label, bytes(r.bag)))
        model.fit([np.frombuffer(r.bag, dtype=np.float32).reshape(-1, N_FEATURES) for r in found], np.array([r.label for r in found], dtype=np.float64))
    else:
        model.p["c"] *= 0
    return model


def score(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and blank texts are scored as one empty passage.  An empty table gives
    an empty result."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, bags, held = [], [], 0
            for value in batch.column(1):
                bags.append(encode(value.as_py()))
                held += len(bags[-1])
                if held > 4000:
                    found.append(model.scores(bags))
                    bags, held = [], 0
            found.append(model.scores(bags))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
