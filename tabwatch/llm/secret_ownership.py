"""Secret scan with corpus-wide ownership of the candidates.

Patterns find candidate values.  Each value's hash is counted over the whole
corpus by distinct repositories, owners and texts: a value that several owners,
many repositories or many different texts hold is a copied example; one that stays
with its holder, in few repositories and texts, and looks random is live.  Holders
are owners of different texts: a page that two sources mirror has one.
Counts go through aggregations by text, repository, owner and value, each
combined before its shuffle, so a value in a third of all files is a row per
task, text and repository.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.common import stored, with_row_key

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, group that holds the value, least length of the value.
BASE_KINDS = (("assign", _ASSIGN, 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]{16,}", 0, 16))
#: A further kind of the ownership method: runs that mix cases and digits.
OPAQUE = ("opaque", r"[A-Za-z0-9_-]{20,}", 0, 20)
#: A value of so many owners, repositories or different texts is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOS, EXAMPLE_TEXTS = 3, 5, 10
#: Different characters that a live-looking value has at least.
LIVE_VARIETY = 8

_KINDS = (*BASE_KINDS, OPAQUE)
_FOUND = "array<struct<gap:int,len:int,value:string>>"


def _found(text: Column, pattern: str, group: int) -> Column:
    """The matches, leftmost and not overlapping: characters between the match
    before and this one, its length, its value.  The last entry, after the last
    match, has no value."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.when(text.rlike(pattern), F.arrays_zip(gaps, F.transform(hits, F.length), values).cast(_FOUND)
                  ).otherwise(F.array().cast(_FOUND))


def candidates(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id) and their candidates (row, repo, owner, same, kind, k,
    start, end, secret), spans in code points, values as SHA-256; same is the
    text's hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    scanned = docs.select(F.col(id_col).alias("doc_id"), repo.alias("repo"), owner.alias("owner"), text.alias("text"))
    found = [_found(F.col("text"), pattern, group).alias(kind) for kind, pattern, group, _ in _KINDS]
    rows = with_row_key(scanned.select("doc_id", "repo", "owner", F.xxhash64("text").alias("same"), *found), "secret-scan")
    per_kind = []
    for k, (kind, _, _, least) in enumerate(_KINDS):
        one = rows.where(F.size(kind) > 0).select("row", "repo", "owner", "same", F.posexplode(kind).alias("no", "x")).where("x.value is not null")
        so_far = Window.partitionBy("row").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        end = F.sum(F.col("x.gap") + F.col("x.len")).over(so_far)
        one = one.withColumn("end", end).where(F.length("x.value") >= least)
        per_kind.append(one.select("row", "repo", "owner", "same", F.lit(kind).alias("kind"), F.lit(k).alias("k"), (F.col("end") - F.col("x.len")).alias("start"), "end",
                                   F.sha2("x.value", 256).alias("secret"), _looks_live(F.col("x.value")).alias("random"),
                                   ))
    out = per_kind[0]
    for df in per_kind[1:]:
        out = out.unionByName(df)
    opaque = (F.col("kind") != OPAQUE[0]) | F.col("random")
    return rows.select("row", "doc_id"), stored(out.where(opaque), "secret-candidates")


def _looks_live(value: Column) -> Column:
    variety = F.size(F.array_distinct(F.split(value, "")))
    return (variety >= LIVE_VARIETY) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def ownership(found: DataFrame) -> DataFrame:
    """secret, n_owners, n_repos, n_texts, n_holders: how many distinct owners,
    repositories of owners and texts hold each value, and how many owners its
    texts have if each text belongs to the first of its owners.  A null owner or
    repository counts as one, and comes first."""
    one = F.count(F.lit(1))
    held = found.groupBy("secret", "same", "owner", "repo").agg(one.alias("n"))
    by_repo = held.groupBy("secret", "owner", "repo").agg(one.alias("n"))
    by_owner = by_repo.groupBy("secret", "owner").agg(one.alias("repos"))
    owners = by_owner.groupBy("secret").agg(one.alias("n_owners"), F.sum("repos").alias("n_repos"))
    by_text = held.groupBy("secret", "same").agg(F.min(F.struct("owner")).alias("first"))
    by_first = by_text.groupBy("secret", F.col("first.owner").alias("owner")).agg(one.alias("texts"))
    return owners.join(by_first.groupBy("secret").agg(one.alias("n_holders"), F.sum("texts").alias("n_texts")), "secret")


def _spans(entries: Column) -> Column:
    ordered = F.sort_array(entries)
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
                 owner: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_live, n_copied.

    Base matches all stay.  The method adds the opaque runs that only one holder's
    files have and that are no copied examples, and counts the document's live and
    copied values.  A value of two holders is neither.
    Without ``repo`` and ``owner``, a source is an owner and its documents of a
    language are a repository.  Null text is empty; repeated rows are rows of
    their own; an empty table gives an empty result."""
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", F.col("source"), F.col("lang")) if repo is None else repo
    rows, found = candidates(docs, id_col, text_col, repo, owner)
    owned = stored(ownership(found.select("secret", "same", "owner", "repo")), "secret-owners")       # a plain table: its join can split a hot value
    judged = found.join(owned, "secret").withColumn(
        "copied", (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repos") >= EXAMPLE_REPOS) | (F.col("n_texts") >= EXAMPLE_TEXTS))
    judged = judged.withColumn("live", F.col("random") & (F.col("n_holders") == 1) & ~F.col("copied"))
    base = F.col("kind") != OPAQUE[0]
    entry = F.struct("start", "k", "end", "kind")
    count = lambda cond: F.count(F.when(cond, F.lit(1)))
    per_row = judged.where(base | F.col("live")).groupBy("row").agg(
        *(count(F.col("kind") == kind).alias(f"n_{kind}") for kind, *_ in BASE_KINDS),
        F.collect_list(F.when(base, entry)).alias("base"), F.collect_list(entry).alias("all"),
        count(F.col("live")).alias("n_live"), count(F.col("copied")).alias("n_copied"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    text_of = lambda name: F.coalesce(_spans(F.col(name)), F.lit(""))
    return rows.join(per_row, "row", "left").select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(text_of("base"), 256).alias("base_sha256"),
        text_of("all").alias("spans"), zero("n_live"), zero("n_copied"))
