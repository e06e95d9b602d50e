"""Quality rules: how far a document's histograms are from its language's.

Two histograms per document: characters by class, and the language's common
words against all others.  The reference of a language is the sum over all of
its documents; documents without a language are a group of their own.  A document
whose Jensen-Shannon distance to its reference is over the limit goes; short
documents, whose histograms are noise, are not judged by it.  A language without a
word list is judged by its characters alone.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import SPACE, fresh, stored, words

#: The most common words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was be with as at this by are from".split(),
    "fr": "de la le et les des un en une que est pour dans qui du par au sur pas plus".split(),
    "de": "der die und das in den von zu mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
#: Character classes counted by pattern; white space and lower case are what is left.
CLASSES = ("[A-Z]", "[0-9]", "[#*$%&|<>]", r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]", r"[^\x00-\x7F]")
#: Words of a window that may repeat.
WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Distances over these are rejected, given so many characters or words.
MAX_CHAR_DISTANCE, MIN_JUDGED_CHARS = 0.34, 200
MAX_WORD_DISTANCE, MIN_JUDGED_WORDS = 0.30, 100

_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(ordered: Column) -> Column:
    """Words covered by windows that begin at these ordered positions."""
    return F.aggregate(F.transform(ordered, lambda p, i: F.least(F.lit(WINDOW), p - F.coalesce(F.get(ordered, i - 1), p - WINDOW))),
                       F.lit(0), lambda total, n: total + n)


def _measured(docs: DataFrame, text_col: str, lang_col: str, c: dict[str, str]) -> DataFrame:
    """``docs`` with the base measures and both histograms (c[classes], c[common])."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lists = F.create_map(*(x for lang, w in COMMON_WORDS.items() for x in (F.lit(lang), F.array(*map(F.lit, w)))))
    df = docs.withColumn(c["words"], words(F.col(text_col))).withColumn(c["list"], F.try_element_at(lists, F.col(lang_col)))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    n = F.size(c["words"])
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(c["words"], i, WINDOW)))
                     ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumns({
        c["lines"]: lines, c["windows"]: windows,
        c["hits"]: F.filter(c["words"], lambda w: F.array_contains(c["list"], w)),
        "_".join((c["classes"], "n")): F.array(*(F.regexp_count(text, F.lit(p)).cast("long") for p in CLASSES)),
    })
    counted = "_".join((c["classes"], "n"))
    # the windows that occur again, in order of hash: only for texts that have any
    again = F.when(F.size(F.array_distinct(c["windows"])) < F.size(c["windows"]),
                   F.sort_array(F.transform(c["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn(c["sorted"], again)
    at = F.transform(F.filter(F.transform(c["sorted"], lambda x, i: F.struct(x.i.alias("i"), (
        (F.coalesce(F.get(F.col(c["sorted"]), i - 1).h == x.h, F.lit(False)) | F.coalesce(F.get(F.col(c["sorted"]), i + 1).h == x.h, F.lit(False)))).alias("d"))),
        lambda x: x.d), lambda x: x.i)
    df = df.withColumn(c["at"], F.sort_array(at))
    length, word_chars = F.length(text).cast("long"), F.length(F.array_join(c["words"], "")).cast("long")
    found = F.aggregate(counted, F.lit(0).cast("long"), lambda total, k: total + k)
    commons = F.transform(c["list"], lambda w: F.size(F.filter(c["hits"], lambda x: x == w)).cast("long"))
    return df.withColumns({
        c["n_words"]: n.cast("long"), c["word_chars"]: word_chars, c["n_symbols"]: F.col(counted)[2],
        c["n_dup_lines"]: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long"),
        c["n_repeat_words"]: F.coalesce(_covered(F.col(c["at"])), F.lit(0)).cast("long"),
        c["classes"]: F.concat(F.array(word_chars - found, length - word_chars), counted),
        c["common"]: F.concat(commons, F.array((n - F.size(c["hits"])).cast("long"))),
    }).drop(counted, *(c[k] for k in ("words", "list", "lines", "windows", "hits", "sorted", "at")))


def _names(docs: DataFrame, keep: bool) -> dict[str, str]:
    """Internal names; the measures under their own names if they are results."""
    names = ("words", "list", "lines", "windows", "hits", "sorted", "at", "classes", "common", "ref_lang", "ref_classes", "ref_common", *_BASE)
    c = dict(zip(names, fresh(docs, *names)))
    return c | {k: k for k in _BASE} if keep else c


def references(measured: DataFrame, lang: str = "lang", classes: str = "classes", common: str = "common") -> DataFrame:
    """ref_lang, ref_classes, ref_common: the summed histograms of each language,
    null as one of them; ref_common is null without a word list.  The only
    document of an unlisted language has nothing to be compared with: its
    ref_classes is null."""
    sums = lambda name, n: F.array(*(F.sum(F.col(name)[i]) for i in range(n)))
    n_words = max(map(len, COMMON_WORDS.values())) + 1
    listed = F.coalesce(F.col("ref_lang").isin(*COMMON_WORDS), F.lit(False))
    return (measured.groupBy(F.col(lang).alias("ref_lang"))
            .agg(sums(classes, len(CLASSES) + 2).alias("ref_classes"), sums(common, n_words).alias("ref_common"), F.count(F.lit(1)).alias("n"))
            .select("ref_lang", F.when(listed | (F.col("n") > 1), F.col("ref_classes")).alias("ref_classes"),
                    F.when(listed, F.col("ref_common")).alias("ref_common")))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms; null without counts."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda t, x: t + x)
    part = lambda x, m: F.when(x > 0, x * F.ln(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(F.transform(counts, lambda x: x / total(counts)), F.transform(reference, lambda y: y / total(reference)),
                       lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    divergence = F.aggregate(terms, F.lit(0.0), lambda t, x: t + x) / F.lit(2.0) / F.ln(F.lit(2.0))
    return F.when((total(counts) > 0) & (total(reference) > 0), F.round(F.sqrt(F.greatest(divergence, F.lit(0.0))), 6))


def _verdict(df: DataFrame, c: dict[str, str]) -> tuple[Column, Column, Column, Column]:
    """base_failed, char distance, word distance, kept."""
    failed = (F.col(c["n_words"]) < MIN_WORDS) | (100 * F.col(c["n_repeat_words"]) > MAX_REPEATED_PERCENT * F.col(c["n_words"]))
    chars = distance(F.col(c["classes"]), F.col(c["ref_classes"]))
    words_ = distance(F.col(c["common"]), F.col(c["ref_common"]))
    n_chars = F.aggregate(c["classes"], F.lit(0).cast("long"), lambda t, x: t + x)
    far = (((n_chars >= MIN_JUDGED_CHARS) & (chars > MAX_CHAR_DISTANCE))
           | ((F.col(c["n_words"]) >= MIN_JUDGED_WORDS) & (words_ > MAX_WORD_DISTANCE)))
    # one term with the reference's columns in it: pushed below the join, its measures would be computed again per use
    return failed, chars, words_, ~F.coalesce(failed | far, failed)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept.

    Null text has no words and fails the base rules.  A null or unlisted
    language has no word distance; the only document of one has no distance.
    Windows of words are compared by 64-bit hash within a text.  An empty table
    gives an empty result."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    c = _names(rows, keep=True)
    measured = stored(_measured(rows, "text", "lang", c).drop("text"), "quality-measures")
    refs = stored(references(measured, "lang", c["classes"], c["common"]), "quality-references")      # a row per language: broadcast if they are few
    joined = measured.join(refs, measured["lang"].eqNullSafe(refs["ref_lang"]), "left")
    c |= {k: k for k in ("ref_classes", "ref_common")}
    failed, chars, words_, kept = _verdict(joined, c)
    return joined.select("doc_id", *_BASE, failed.alias("base_failed"), chars.alias("char_distance"),
                         words_.alias("word_distance"), kept.alias("kept"))


def passing(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that quality_rules() keeps, with all their columns; nulls,
    repeated rows and empty tables are as there.  The histograms are measured twice,
    for the references and for the verdict: written with their rows, they would be a
    copy of the corpus beside the one that a pipeline keeps."""
    c = _names(docs, keep=False)
    measured = _measured(docs, text_col, lang_col, c)
    refs = stored(references(measured.select(lang_col, c["classes"], c["common"]), lang_col, c["classes"], c["common"]), "quality-references")
    refs = refs.select(*(F.col(k).alias(c[k]) for k in ("ref_lang", "ref_classes", "ref_common")))
    joined = measured.join(refs, measured[lang_col].eqNullSafe(refs[c["ref_lang"]]), "left")
    return joined.where(_verdict(joined, c)[3]).select(*docs.columns)
