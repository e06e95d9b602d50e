"""Personal data, and the terms that give it away.

Patterns find addresses, numbers and the like.  What is left after they are taken
out may still reveal them: a name that is found in the documents of one telephone
number and in no others.  Over the whole corpus, a term discloses an entity by the
share of the entity's information content that their co-occurrence carries,

    log(N * both / (df(term) * df(entity))) / log(N / df(entity)),

1 when the term is found with that entity only; all counts are of documents.  Terms
that disclose enough of an entity, in more than one text, are generalised wherever
they stand in the documents with that entity; those that disclose nearly all of it
are removed.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import ship, stored, with_row_key

KINDS = ("email", "ip", "card", "phone", "general", "remove")
#: Shares of an entity's information from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.5, 0.9
#: Different texts in which a term must be seen with an entity.
TEXTS = 2
#: Terms that a task counts before it sends them on.
COUNTING = 300_000
#: Terms of one text in a batch.
SENT = 20_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match cannot begin inside a run of digits that it could have begun before
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # without a match here, what stands before this @ cannot belong to a later one
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the personal data in a text, in order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def _terms_of(text: str) -> set[str]:
    return {t.lower() for t in _TERM.findall(text)}


def _free(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The terms of a text that do not touch any of its spans, in order."""
    taken: list[list[int]] = []      # the spans, those that overlap as one
    for s, _, e in spans:
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    at = 0
    for m in _TERM.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or m.end() <= taken[at][0]:
            yield m


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, spans and, of texts with any, the entities, the text and its hash."""
    for batch in batches:
        counts, bases, mentions, copies, hashes = [[], [], [], []], [], [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            spans = base_spans(text)
            here = Counter(k for _, k, _ in spans)
            for k, column in enumerate(counts):
                column.append(here[k])
            bases.append(span_text(spans))
            mentions.append(sorted({_hash(f"{k}:{text[s:e].lower() if k < 2 else _digits(text[s:e])}") for s, k, e in spans}))
            copies.append(text if spans else None)
            hashes.append(hashlib.sha256(text.encode()).digest()[:16] if spans else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in counts), pa.array(bases, pa.string()),
                                          pa.array(mentions, pa.list_(pa.int64())), pa.array(copies, pa.string()), pa.array(hashes, pa.binary())],
                                         names=["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base", "entities", "text", "same"])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each term, summed within the task as far as memory goes."""
    seen: Counter = Counter()

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(map(_hash, seen), pa.int64()), pa.array(seen.values(), pa.int64())], names=["term", "n"])

    for batch in batches:
        for value in batch.column(0):
            seen.update(_terms_of(value.as_py()))
            if len(seen) > COUNTING:
                yield sent()
                seen.clear()
    yield sent()


def _terms_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(same, n, term) of the terms outside the spans of each text."""
    for batch in batches:
        for same, n, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            terms = sorted({_hash(m[0].lower()) for m in _free(text, base_spans(text))})
            for at in range(0, len(terms), SENT):
                some = terms[at:at + SENT]
                yield pa.RecordBatch.from_arrays([pa.array([same] * len(some), pa.binary()), pa.array([n] * len(some), pa.int64()), pa.array(some, pa.int64())],
                                                 names=["same", "n", "term"])


def disclosures(docs: DataFrame, scanned: DataFrame, text_col: str = "text", generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """Two tables.  Told: same, entity, term, share of the entity's information that
    the term discloses, for the terms over the limit in each text that has both, by
    counts of documents over all of them.  Texts: same, n, text, one row for each
    distinct text with an entity of several texts.

    Pairs are of all terms of a text with all of its entities.  Since ``both`` is
    at most df(entity) and at most the term's documents with entities, a pair with
    min(df(entity), those) / df(term) < (df(entity) / N) ** (1 - generalise) cannot
    reach the limit: it is left out before it is counted, and loses nothing.  Nor
    does it to begin with all texts of an entity but the one of most terms: a pair
    that counts is in another text as well.  In that text, often a directory of
    many names and numbers, only such pairs are looked up."""
    n = scanned.count()
    mentioned = scanned.where(F.size("entities") > 0)
    per_text = mentioned.select(F.explode("entities").alias("entity"), "same").groupBy("entity", "same").agg(F.count(F.lit(1)).alias("n"))
    entities = per_text.groupBy("entity").agg(F.sum("n").alias("df_entity"), F.count(F.lit(1)).alias("texts"))
    entities = entities.where((F.col("texts") >= TEXTS) & (F.col("df_entity") < n)).drop("texts")
    held = stored(per_text.drop("n").join(entities, "entity"), "pii-held")
    distinct = mentioned.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    texts = stored(distinct.join(held.select("same").distinct(), "same", "left_semi"), "pii-texts")
    with_terms = stored(texts.select("same", "n", "text").mapInArrow(_terms_with, "same binary, n long, term long"), "pii-text-terms")
    several = with_terms.groupBy("term").agg(F.sum("n").alias("beside"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= TEXTS).drop("texts")
    several = stored(several, "pii-several")
    counted = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(_terms, "term long, n long")
    counted = counted if several.limit(1).count() else counted.where("false")
    # summed first: the tasks' counts of a term are many rows, and the join's need not be
    terms = stored(counted.groupBy("term").agg(F.sum("n").alias("df_term")).join(several, "term"), "pii-term-counts")
    bits = F.log2(F.lit(float(n)) / F.col("df_entity"))
    share = lambda both: F.log2(F.lit(float(n)) * both / (F.col("df_term") * F.col("df_entity"))) / bits
    can = share(F.least("df_entity", "beside")) >= generalise - 1e-9
    # no term can do better than with the entity that asks least of it
    most = held.agg(F.max("df_entity")).first()[0] or 1
    some = F.col("df_term") <= F.lit(float(most) ** generalise * float(n) ** (1 - generalise) * (1 + 1e-9))
    terms = terms.where(some)
    size = with_terms.groupBy("same").agg(F.count(F.lit(1)).alias("size"))
    sized = stored(held.join(size, "same"), "pii-held-sizes")
    largest = stored(sized.groupBy("entity").agg(F.max_by("same", F.struct("size", "same")).alias("same")), "pii-largest")
    others = sized.drop("size").join(largest, ["entity", "same"], "left_anti")
    pairs = with_terms.join(terms, "term").join(others, "same").where(can)
    pairs = stored(pairs.groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("texts"),
                                                       F.first("df_term").alias("df_term"), F.first("df_entity").alias("df_entity")), "pii-pairs")
    here = pairs.select("entity", "term").join(largest, "entity").join(with_terms, ["same", "term"]).select("entity", "term", F.col("n").alias("more"))
    pairs = pairs.join(here, ["entity", "term"], "left").withColumns(
        {"both": F.col("both") + F.coalesce("more", F.lit(0)), "texts": F.col("texts") + F.when(F.col("more").isNull(), 0).otherwise(1)})
    telling = pairs.where(F.col("texts") >= TEXTS).select("entity", "term", share(F.col("both")).alias("share")).where(F.col("share") >= generalise)
    telling = stored(telling, "pii-terms")
    return with_terms.select("same", "term").join(telling, "term").join(held.select("same", "entity"), ["same", "entity"]), texts


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All spans of each text: the patterns' and every occurrence of its terms."""
    for batch in batches:
        same, texts, terms = (batch.column(i) for i in range(3))
        out = []
        for text, told in zip(texts.to_pylist(), terms.to_pylist()):
            kind = {x["term"]: x["kind"] for x in told}
            spans = base_spans(text)
            more = [(m.start(), kind[h], m.end()) for m in _free(text, spans) if (h := _hash(m[0].lower())) in kind]
            out.append(span_text(sorted(spans + more)))
        yield pa.RecordBatch.from_arrays([same, pa.array(out, pa.string())], names=["same", "marked"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, marked = batch.column(5), batch.column(6).to_pylist()
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in base.to_pylist()]
        spans = [b if m is None else m for b, m in zip(base.to_pylist(), marked)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                                         names=[*batch.schema.names[:5], "base_sha256", "spans"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
                  remove: float = REMOVE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans.

    ``spans`` has the patterns' matches and, of kind ``general`` or ``remove``,
    every occurrence of the disclosing terms of the text's entities, outside of the
    matches.  Null text is empty and has none; repeated rows are rows of their own,
    and copies of one text are no evidence against a term; an entity that every
    document has is not protected.  An empty table gives an empty result."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS[:4])
    scanned = with_row_key(rows.mapInArrow(
        _scan, f"doc_id {kind}, {counts}, base string, entities array<long>, text string, same binary"), "pii-scan")
    told, texts = disclosures(rows, scanned, "text", generalise)
    action = F.when(F.col("share") >= remove, KINDS.index("remove")).otherwise(KINDS.index("general"))
    told = (told.groupBy("same", "term").agg(F.max(action).alias("kind"))
            .groupBy("same").agg(F.collect_list(F.struct("term", "kind")).alias("terms")))
    # a plain table: its join can split a text with many copies
    marks = stored(texts.join(told, "same").select("same", "text", "terms").mapInArrow(_mark, "same binary, marked string"), "pii-marks")
    columns = ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base"]
    plain = scanned.where("same is null").select(*columns, F.lit(None).cast("string").alias("marked"))
    whole = scanned.where("same is not null").join(marks, "same", "left").select(*columns, "marked").unionByName(plain)
    return whole.mapInArrow(_finish, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def redact(text: str | None, spans: str) -> str | None:
    """The text with its spans taken out: data by kind, general terms by a
    place holder, removed terms altogether.  Of overlapping spans the one that
    begins first goes, then the rest of the others."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in (x.split(":") for x in spans.split(",")):
        start, end = max(at, int(start)), int(end)
        if start < end:
            out += [text[at:start], {"general": "[term]", "remove": ""}.get(kind, f"[{kind}]")]
            at = end
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of personal_data() taken out of the text; a null text
    stays null, an empty one empty, and an empty table empty.

    Spans are joined by id and text hash: rows that agree in both have the same, null ids too."""
    ship(docs.sparkSession)
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("doc_id"), F.col(text_col).alias("text"))
    spans = personal_data(keyed).where("spans <> ''").select("doc_id", "spans").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [redact(t, s or "") for t, s in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    marks = spans.select(F.col("doc_id.id").alias("_span_id"), F.col("doc_id.h").alias("_span_h"), F.col("spans").alias("_spans"))
    joined = docs.join(marks, docs[id_col].eqNullSafe(marks["_span_id"]) & (F.xxhash64(docs[text_col]) == marks["_span_h"]), "left")
    return joined.select(*docs.columns, "_spans").mapInArrow(run, docs.schema)
