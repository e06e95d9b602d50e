"""Quantiles per feature, exact and distributed.

``feature_quantiles`` returns the linear-interpolation quantile
between ``v[lo]`` and ``v[hi]`` at ``pos = level * (n - 1)``, with ``lo``/``hi``
its floor/ceiling ranks (numpy's default method), for every feature and level, by
iterative range refinement.  No task ever holds a whole column:

1. one aggregation gives, per feature (later: per open value interval
   still holding a wanted rank), its row count and ``buckets`` cut points
   from mergeable KLL sketches, merged as a two-level tree (per task-derived
   salt, then across salts) so no single task merges one sketch per split;
2. an interval larger than ``max_sort_rows`` is split: rows are counted
   per bucket with a binary-search expression over the literal cuts
   (codegen, map-side combined).  Every cut is its own single-value bucket,
   so a value that holds a third of all rows is resolved on the spot
   without any sort, and each open bucket shrinks by about ``buckets``;
3. once small enough, each interval holding a wanted rank is reduced to
   its distinct values and sorted in one task to pick the exact values.

At 100 TB this is about log_32(rows / max_sort_rows) rounds of two scans;
at small scale it is one scan for the row counts and one sort scan (an input
of few bytes is counted before it is sketched, and few rows need no sketch).  The driver only
sees configuration-sized metadata (cuts, bucket totals, the picked
values), the way an MLlib estimator collects its fitted parameters.

Inputs must be deterministic (a table scan and expressions over it): the
passes read them independently.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.functions.search import quoted, sql_double
from tabwatch.operators.ordered import prefix_sums
from tabwatch.session import local_frame, materialize

DEFAULT_BUCKETS = 32          # cut points per interval and round
MAX_SORT_ROWS = 1_000_000     # an interval this small is sorted in one task
DEFAULT_ACCURACY = 10000      # percentile_approx accuracy in the approx mode
KLL_K = 1024                  # KLL sketch size for the refinement cuts
SKETCH_SALTS = 256            # first-level merge groups of the sketch tree
SMALL_BYTES = 1 << 28         # an input of so many bytes is counted first

QUANTILE_SCHEMA_TAIL = "level_idx int, level double, quantile double, n bigint"


def sketch_cuts(df: DataFrame, columns: list[tuple[str, str]], fine: list[float], k: int,
                salts: int = SKETCH_SALTS) -> dict[int, tuple[list[float], int]]:
    """``{segment: (cut points at the fine ranks, rows)}``.

    ``columns`` are pairs of SQL expressions: a row's segment (null: none) and
    its value.  The rows are unpivoted to (segment, value) once and mergeable KLL
    sketches are built per segment and task-derived salt, then merged across
    salts: one aggregate however many segments there are, and no task merges
    one sketch per input split.  The cuts only steer bucketing, so their rank
    error affects balance, never the exact result.
    """
    k = max(8, min(int(k), 65535))
    names = [f"f{i}" for i in range(len(columns))]
    pairs = [F.struct(F.expr(seg).cast("int").alias("s"), F.expr(v).cast("double").alias("v")).alias(n)
             for n, (seg, v) in zip(names, columns)]
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt")
    rows = (df.select(salt, *pairs).unpivot(["_salt"], names, "_f", "_sv")
              .select("_salt", F.col("_sv.s").alias("s"), F.col("_sv.v").alias("v")).where(F.col("s").isNotNull()))
    parts = rows.groupBy("s", "_salt").agg(F.expr(f"kll_sketch_agg_double(v, {k})").alias("sketch"), F.count("v").alias("n"))
    whole = parts.groupBy("s").agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"), F.sum("n").alias("n"))
    lv = "array(" + ", ".join(sql_double(x) for x in fine) + ")"
    found = whole.where("n > 0").select("s", F.expr(f"kll_sketch_get_quantile_double(sketch, {lv})").alias("c"), "n").collect()
    return {r["s"]: (sorted({float(c) for c in r["c"]}), int(r["n"])) for r in found}


def lerp(a: float, b: float, t: float) -> float:
    """Linear interpolation as numpy's quantile does it (the form that is
    exact at both ends: from ``b`` backwards once t >= 0.5)."""
    if t == 0.0 or a == b:
        return a
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


class _Seg:
    """An open value interval (lo, hi) of one feature and its rank offset."""

    __slots__ = ("feature", "lo", "hi", "base", "n", "ranks")

    def __init__(self, feature, lo, hi, base, n, ranks):
        self.feature, self.lo, self.hi, self.base, self.n, self.ranks = feature, lo, hi, base, n, ranks

    def in_range(self, x: str) -> str:
        conds = [f"{x} IS NOT NULL", f"NOT isnan({x})"]
        if self.lo is not None:
            conds.append(f"{x} > {sql_double(self.lo)}")
        if self.hi is not None:
            conds.append(f"{x} < {sql_double(self.hi)}")
        return " AND ".join(conds)


def _small_counts(df: DataFrame, xs: dict[str, str], max_rows: int) -> dict[str, int] | None:
    """Row counts of the expressions, if the input is small and none has more than
    ``max_rows``: then nothing needs a sketch."""
    plan = getattr(df, "_jdf", None)
    if plan is None or int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes())) > SMALL_BYTES:
        return None
    row = df.agg(*(F.count_if(F.expr(f"{x} IS NOT NULL AND NOT isnan({x})")) for x in xs.values())).first()
    return dict(zip(xs, map(int, row))) if max(row, default=0) <= max_rows else None


def _point_tree(x: str, cuts: list[float]) -> str:
    """SQL: 2*(#cuts < x) + (1 if x is a cut): odd ids are single-value
    buckets, even ids the open intervals between cuts (binary search)."""
    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(2 * lo)
        mid = (lo + hi) // 2
        c = sql_double(cuts[mid])
        return (f"CASE WHEN {x} < {c} THEN {tree(lo, mid)} "
                f"WHEN {x} = {c} THEN {2 * mid + 1} ELSE {tree(mid + 1, hi)} END")
    return tree(0, len(cuts))


def select_ranks(df: DataFrame, exprs: dict[str, str], ranks_for: Callable[[str, int], set[int]],
                 buckets: int = DEFAULT_BUCKETS, accuracy: int | None = None,
                 max_sort_rows: int = MAX_SORT_ROWS):
    """Exact values at wanted ranks of one or more numeric expressions.

    ``exprs`` maps a name to a SQL expression over ``df`` (cast to double;
    nulls and NaNs are left out).  ``ranks_for(name, n)`` gives the wanted
    0-based ranks once the row count n is known.  Returns ``(at_rank,
    n_of)``: ``at_rank[(name, rank)] = (value, rank where that value
    starts)`` and ``n_of[name] = n``.  Iterative range refinement (module
    notes), as many rounds as it takes: a split leaves out the cut values
    themselves, so every round has fewer rows; the driver only sees cut points,
    bucket totals and picked values.
    """
    acc = accuracy or KLL_K
    fine = [i / buckets for i in range(1, buckets)]
    xs = dict(exprs)
    at_rank: dict[tuple[str, int], tuple[float, int]] = {}
    n_of: dict[str, int] = {}
    counted = _small_counts(df, xs, max_sort_rows) if xs else None
    active = [_Seg(f, None, None, 0, None, None) for f in xs] if counted is None else []
    final: list[_Seg] = []
    for f, n in (counted or {}).items():
        n_of[f] = n
        ranks = {r for r in ranks_for(f, n) if 0 <= r < n} if n else set()
        if ranks:
            final.append(_Seg(f, None, None, 0, n, ranks))
    while active:
        # sketch cuts and row count of every active segment: a feature's segments
        # are disjoint, so one column per feature carries (segment, value)
        columns = []
        for f in {sg.feature: None for sg in active}:
            arms = " ".join(f"WHEN {sg.in_range(xs[f])} THEN {i}" for i, sg in enumerate(active) if sg.feature == f)
            columns.append((f"CASE {arms} END", xs[f]))
        found = sketch_cuts(df, columns, fine, acc)
        split: list[tuple[_Seg, list[float]]] = []
        for i, sg in enumerate(active):
            cuts, n = found.get(i, ([], 0))
            if sg.n is None:               # first round: the whole column
                sg.n = n
                n_of[sg.feature] = n
                sg.ranks = {r for r in ranks_for(sg.feature, n) if 0 <= r < n} if n else set()
                if not sg.ranks:
                    continue
            if sg.n <= max_sort_rows or not cuts:
                final.append(sg)
            else:
                split.append((sg, cuts))
        if not split:
            break
        # rows per bucket of the segments being split: a feature's segments
        # are disjoint, so one column per feature carries (segment, bucket)
        sel, names = [], []
        for f in {sg.feature for sg, _ in split}:
            x = xs[f]
            arms = [(j, sg, cuts) for j, (sg, cuts) in enumerate(split) if sg.feature == f]
            seg = " ".join(f"WHEN {sg.in_range(x)} THEN {j}" for j, sg, _ in arms)
            bkt = " ".join(f"WHEN {sg.in_range(x)} THEN {_point_tree(x, cuts)}" for _, sg, cuts in arms)
            name = f"f{len(names)}"
            sel.append(F.struct(F.expr(f"CASE {seg} END").cast("int").alias("s"),
                                F.expr(f"CASE {bkt} END").cast("int").alias("b")).alias(name))
            names.append(name)
        bt = (df.select(*sel).unpivot([], names, "_f", "_sb")
                .select(F.col("_sb.s").alias("_seg"), F.col("_sb.b").alias("_b"))
                .where(F.col("_seg").isNotNull())
                .groupBy("_seg", "_b").agg(F.count(F.lit(1)).alias("_bn"))
                .collect())   # bucket totals: segments x (2 * buckets + 1) rows at most
        counts: dict[int, dict[int, int]] = {}
        for r in bt:
            counts.setdefault(int(r["_seg"]), {})[int(r["_b"])] = int(r["_bn"])
        nxt: dict[tuple, _Seg] = {}
        for j, (sg, cuts) in enumerate(split):
            off = sg.base
            spans = []
            for b in sorted(counts.get(j, {})):
                bn = counts[j][b]
                spans.append((b, off, bn))
                off += bn
            for r in sg.ranks:
                for b, o, bn in spans:
                    if o <= r < o + bn:
                        if b % 2 == 1:            # a single value: resolved
                            at_rank[(sg.feature, r)] = (cuts[b // 2], o)
                        else:
                            k = b // 2
                            lo = cuts[k - 1] if k >= 1 else sg.lo
                            hi = cuts[k] if k < len(cuts) else sg.hi
                            key = (sg.feature, lo, hi)
                            if key not in nxt:
                                nxt[key] = _Seg(sg.feature, lo, hi, o, bn, set())
                            nxt[key].ranks.add(r)
                        break
        # sub-intervals small enough to sort skip the next sketch round (their
        # row count is already known from the bucket totals)
        active = []
        for sg in nxt.values():
            (final if sg.n <= max_sort_rows else active).append(sg)

    # sort the final segments (distinct values only), one task per segment
    todo = [sg for sg in final if sg.n and any((sg.feature, r) not in at_rank for r in sg.ranks)]
    if todo:
        sel, names, targets = [], [], []
        for j, sg in enumerate(todo):
            targets += [(f"s{j}", r - sg.base, sg.feature, r, sg.base) for r in sg.ranks]
        for f in {sg.feature for sg in todo}:
            x = xs[f]
            seg = " ".join(f"WHEN {sg.in_range(x)} THEN 's{j}'" for j, sg in enumerate(todo)
                           if sg.feature == f)
            name = f"f{len(names)}"
            sel.append(F.struct(F.expr(f"CASE {seg} END").alias("s"), F.expr(x).alias("v")).alias(name))
            names.append(name)
        w = Window.partitionBy("_seg").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
        vc = (df.select(*sel).unpivot([], names, "_f", "_sv")
                .select(F.col("_sv.s").alias("_seg"), F.col("_sv.v").alias("_v"))
                .where(F.col("_seg").isNotNull())
                .groupBy("_seg", "_v").agg(F.count(F.lit(1)).alias("_c"))
                .withColumn("_s", F.coalesce(F.sum("_c").over(w), F.lit(0)))
                .withColumn("_e", F.col("_s") + F.col("_c")))
        tdf = local_frame(df.sparkSession, [(a, b) for a, b, _, _, _ in targets],
                          "_seg string, _lr bigint")
        picked = (vc.join(F.broadcast(tdf), "_seg")
                    .where((F.col("_lr") >= F.col("_s")) & (F.col("_lr") < F.col("_e")))
                    .select("_seg", "_lr", "_v", "_s").collect())   # one row per wanted rank
        got = {(r["_seg"], int(r["_lr"])): (float(r["_v"]), int(r["_s"])) for r in picked}
        for seg, lr, f, r, base in targets:
            v, start = got[(seg, lr)]
            at_rank[(f, r)] = (v, base + start)
    return at_rank, n_of


def _level_ranks(levels: list[float], n: int) -> list[tuple[float, int, int]]:
    out = []
    for lv in levels:
        pos = lv * float(n - 1)
        out.append((pos, int(math.floor(pos)), int(math.ceil(pos))))
    return out


def feature_quantiles(df: DataFrame, features: Sequence[str], levels: Sequence[float],
                      buckets: int = DEFAULT_BUCKETS, accuracy: int | None = None,
                      max_sort_rows: int = MAX_SORT_ROWS) -> DataFrame:
    """Exact interpolated quantiles of wide feature columns ->
    ``(feature, level_idx, level, quantile, n, below)`` (a small local table);
    ``below`` is the number of rows strictly below the quantile, which gives
    a baseline's bin counts without another scan.

    Nulls and NaNs are dropped per feature; features without values give no
    rows.  Selection by iterative range refinement (see the module notes).
    """
    spark = df.sparkSession
    features = [f for f in features if f in df.columns]
    levels = [float(x) for x in levels]
    schema = "feature string, " + QUANTILE_SCHEMA_TAIL + ", below bigint"
    if not features:
        return local_frame(spark, [], schema)
    xs = {f: f"CAST({quoted(f)} AS DOUBLE)" for f in features}

    def ranks_for(_name: str, n: int) -> set[int]:
        return {r for _, lo, hi in _level_ranks(levels, n) for r in (lo, hi)}

    at_rank, n_of = select_ranks(df, xs, ranks_for, buckets, accuracy, max_sort_rows)
    rows = []
    for f in features:
        n = n_of.get(f, 0)
        if n == 0:
            continue
        for i, (pos, lo, hi) in enumerate(_level_ranks(levels, n)):
            (vlo, slo), (vhi, shi) = at_rank[(f, lo)], at_rank[(f, hi)]
            q = lerp(vlo, vhi, pos - float(lo))
            # rows strictly below q: where its value starts, or every row up to lo
            below = slo if q == vlo else (shi if q == vhi else hi)
            rows.append((f, i, levels[i], q, n, below))
    return local_frame(spark, rows, schema)


def approx_quantiles(long_df: DataFrame, keys: Sequence[str], levels: Sequence[float],
                     value: str = "value", accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Sketch quantiles (actual elements, rank error about n/accuracy)."""
    keys = list(keys)
    agg = long_df.groupBy(*keys).agg(
        F.percentile_approx(value, [float(x) for x in levels], accuracy).alias("_q"),
        F.count(F.lit(1)).alias("n"))
    return agg.select(*keys, F.posexplode("_q").alias("level_idx", "quantile"), "n") \
              .withColumn("level", F.element_at(
                  F.array(*[F.lit(float(x)) for x in levels]), F.col("level_idx") + 1)) \
              .select(*keys, F.col("level_idx").cast("int"), "level", "quantile", "n")


def quantiles(df: DataFrame, features: Sequence[str], levels: Sequence[float],
              method: str = "exact", **kw) -> DataFrame:
    """Quantiles of wide feature columns -> ``(feature, level_idx, level, quantile, n)``.

    method: ``exact`` (distributed selection, equals numpy/SQL),
    ``approx`` (percentile_approx, actual elements, bounded memory),
    ``sketch`` (KLL sketches, mergeable across batches).
    """
    if method == "exact":
        return feature_quantiles(df, features, levels, **kw)
    if method == "approx":
        from tabwatch.operators.reshape import to_long
        present = [f for f in features if f in df.columns]
        return approx_quantiles(to_long(df, present), ["feature"], levels, **kw)
    if method == "sketch":
        return sketch_quantiles(feature_sketches(df, features, **kw), levels)
    raise ValueError(f"unknown quantile method {method!r}")


def median_exact(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Interpolated median of each feature column -> ``(feature, median, n)``."""
    q = feature_quantiles(df, features, [0.5])
    return q.select("feature", F.col("quantile").alias("median"), "n")


def element_quantile(long_df: DataFrame, keys: Sequence[str], level: float, value: str = "value",
                     max_rows: int = MAX_SORT_ROWS) -> DataFrame:
    """``(*keys, quantile, n)``: the least element of each group whose rank is
    ``level`` of the group's rows or more (no interpolation), exact at any size.

    Rows are reduced to one per distinct value, and ranks are prefix sums over the
    ordered values, so neither a group nor a value is one task's work.  Nulls are
    left out, NaN is above all numbers, a null key is a group."""
    names, long_df = list(keys), long_df.withColumn("_all", F.lit(0))
    keys = names or ["_all"]
    counts = long_df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_count"))
    ranked = materialize(prefix_sums(counts, [*keys, "_value"], {"_before": F.col("_count")}, max_rows), "element-ranks")
    groups = ranked.groupBy(*keys).agg(F.min("_before").alias("_first"), F.sum("_count").alias("n"))
    groups = groups.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), "_first", "n")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)))
    at, wanted = F.col("_before") - F.col("_first"), F.greatest(F.ceil(F.lit(float(level)) * F.col("n")) - 1, F.lit(0))
    return ranked.join(groups, same).where((at <= wanted) & (wanted < at + F.col("_count"))).select(*names, F.col("_value").alias("quantile"), "n")


def median_element(long_df: DataFrame, keys: Sequence[str], value: str = "value", max_rows: int = MAX_SORT_ROWS) -> DataFrame:
    """The median that is an actual element (the lower one of two), exact."""
    return element_quantile(long_df, keys, 0.5, value, max_rows).withColumnRenamed("quantile", "median")


# ------------------------------------------------------------ sketch mode

def feature_sketches(df: DataFrame, features: Sequence[str], k: int | None = None,
                     salts: int = SKETCH_SALTS) -> DataFrame:
    """``(feature, sketch binary, n)``: one mergeable KLL sketch per feature,
    built per task and merged as a two-level tree (task-derived salt, then
    across salts).  Sketch tables of different days can be appended and
    merged (``merge_sketches``) into an incremental baseline."""
    feats = [f for f in features if f in df.columns]
    karg = f", {int(k)}" if k else ""
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt")
    xs = [F.expr(f"CASE WHEN NOT isnan(CAST({quoted(f)} AS DOUBLE)) THEN CAST({quoted(f)} AS DOUBLE) END")
          .alias(f"_x{i}") for i, f in enumerate(feats)]
    lvl1 = (df.select(salt, *xs).groupBy("_salt")
              .agg(*[F.expr(f"kll_sketch_agg_double(_x{i}{karg})").alias(f"_s{i}") for i in range(len(feats))]))
    one = lvl1.agg(*[F.expr(f"kll_merge_agg_double(_s{i})").alias(f"_s{i}") for i in range(len(feats))])
    parts = [one.select(F.lit(f).alias("feature"), F.col(f"_s{i}").alias("sketch")) for i, f in enumerate(feats)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("n", F.expr("kll_sketch_get_n_double(sketch)"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Merge sketch rows per feature (e.g. daily sketches into one baseline)."""
    return (sketches.groupBy("feature").agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
                    .withColumn("n", F.expr("kll_sketch_get_n_double(sketch)")))


def sketch_quantiles(sketches: DataFrame, levels: Sequence[float]) -> DataFrame:
    """Quantiles read from sketches -> ``(feature, level_idx, level, quantile, n)``."""
    lv = "array(" + ", ".join(sql_double(float(x)) for x in levels) + ")"
    q = sketches.where(F.col("n") > 0).select(
        "feature", F.expr(f"kll_sketch_get_quantile_double(sketch, {lv})").alias("_q"), "n")
    lvl = F.array(*[F.lit(float(x)) for x in levels])
    return q.select("feature", F.posexplode("_q").alias("level_idx", "quantile"), "n").select(
        "feature", F.col("level_idx").cast("int").alias("level_idx"),
        F.element_at(lvl, F.col("level_idx") + 1).alias("level"), "quantile",
        F.col("n").cast("bigint").alias("n"))
