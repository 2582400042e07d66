"""Aggregation: tallies, exact order statistics, rarity, evidence and fits.

Ties are always settled by the smaller value.  Order statistics inside a group first collapse equal values, so the
window that follows sees distinct values only.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cols, counts, stored


def family_counts(df: DataFrame, key: str, text: str, families: dict[str, tuple[str, int]]) -> DataFrame:
    """A1: code points per family in a text, each worth its multiplicity: ``(key, family, n)``; families that are absent are left out."""
    per: dict[str, Column] = {}
    for ch, (family, worth) in families.items():
        times = F.length(text) - F.length(F.replace(F.col(text), F.lit(ch), F.lit("")))
        per[family] = per.get(family, F.lit(0)) + times * worth
    rows = F.array(*[F.struct(F.lit(f).alias("family"), c.cast("long").alias("n")) for f, c in per.items()])
    return df.where(F.col(text).isNotNull()).select(key, F.explode(rows).alias("r")).groupBy(key, "r.family").agg(F.sum("r.n").alias("n")).where("n > 0")


def budget_check(have: DataFrame, want: DataFrame, key: list[str], n: str = "n", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """A2: rows whose count lies outside [lo, hi]; a missing side counts 0, and nothing wanted nor had is no row."""
    j = have.select(*key, F.col(n).alias("have")).join(want.select(*key, F.col(lo).alias("lo"), F.col(hi).alias("hi")), key, "full_outer")
    j = j.select(*key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("have", "lo", "hi")])
    return j.where("(have < lo or have > hi) and not (have = 0 and hi = 0)")


def most_common(df: DataFrame, value: str, k: int, group: str | None = None) -> DataFrame:
    """A3: the k most frequent values, of each group if one is named."""
    if group is None:
        return counts(df, value).orderBy(F.col("n").desc(), value).limit(k)
    tally = counts(df, group, value)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col("n").desc(), value))
    return tally.withColumn("rank", rank).where(F.col("rank") <= k)


def modal(df: DataFrame, group: str | list[str], value: str, others: int = 3) -> DataFrame:
    """A4: ``(group, mode, n, total, share, kinds, alternatives)``; alternatives are the next values as an array."""
    g = cols(group)
    tally = counts(df.where(F.col(value).isNotNull()), *g, value)
    w = Window.partitionBy(*g)
    ranked = tally.withColumn("_r", F.row_number().over(w.orderBy(F.col("n").desc(), value))).withColumn("_t", F.sum("n").over(w)).withColumn("_k", F.count(F.lit(1)).over(w))
    top = F.col("_r") == 1
    more = F.sort_array(F.collect_list(F.when((F.col("_r") > 1) & (F.col("_r") <= 1 + others), F.struct("_r", F.col(value).alias("v")))))
    return ranked.where(F.col("_r") <= 1 + others).groupBy(*g).agg(
        F.max(F.when(top, F.col(value))).alias("mode"), F.max(F.when(top, F.col("n"))).alias("n"), F.max("_t").alias("total"),
        (F.max(F.when(top, F.col("n"))) / F.max("_t")).alias("share"), F.max("_k").alias("kinds"), F.transform(more, lambda x: x["v"]).alias("alternatives"),
    )


def minority_use(df: DataFrame, group: str, value: str, min_n: int = 50) -> DataFrame:
    """A5: rows whose value isn't their group's mode, in groups of at least ``min_n`` rows; with the mode and its share."""
    m = modal(df, group, value, 0).where(F.col("total") >= min_n).select(F.col(group).alias("_g"), "mode", "share")
    return df.join(m, F.col(group) == F.col("_g")).where(F.col(value) != F.col("mode")).drop("_g")


def hapax_deviation(
    df: DataFrame, form: str, axes: list[str], group: str, pos: str, min_n: int = 20, max_k: int = 1, reach: int = 2, review: tuple[str, ...] = (), counted: DataFrame | None = None
) -> DataFrame:
    """Values that differ from their form's mode and occur at most ``max_k`` times in it: ``(form, group, pos, axis, value, dev, grade)``.

    PAIRED if a row of the same group at most ``reach`` places (whole numbers) away deviates from its own form's mode the other way, on any
    axis and however often; else REVIEW on the axes ``review``, which a tight setting can fake, and HAPAX on others.  Forms with fewer
    than ``min_n`` rows deviate in nothing.  ``counted``: the same rows, if they are cheaper to read where ``pos`` isn't needed.

    Values are counted with their groups at hand, so that only rows of groups that hold a rare value meet the counts again.
    """
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("double").alias("value")) for a in axes])).alias("x")
    long = lambda d, *more: d.select(form, group, *more, each).select(form, group, *more, "x.axis", "x.value")
    ends = [F.min(group).alias("_first"), F.max(group).alias("_last")]
    tally = long(df if counted is None else counted).groupBy(form, "axis", "value").agg(F.count(F.lit(1)).alias("n"), *ends)
    w = Window.partitionBy(form, "axis")
    tally = tally.withColumn("_t", F.sum("n").over(w)).withColumn("mode", F.first("value").over(w.orderBy(F.col("n").desc(), "value")))
    off = tally.where((F.col("_t") >= min_n) & (F.col("value") != F.col("mode"))).withColumn("_rare", F.col("n") <= max_k)
    if max_k > 2:  # the first and the last group aren't all
        held = long(df).join(off.where("_rare").select(form, "axis", "value"), [form, "axis", "value"], "left_semi").select(F.col(group).alias("_g"))
    else:
        held = off.where("_rare").select(F.explode(F.array("_first", "_last")).alias("_g"))
    rows = df.where(F.col(group).isNotNull()).join(held.where("_g is not null").distinct(), F.col(group) == F.col("_g"), "left_semi")
    rows = rows.select(form, group, pos, *axes).unionByName(df.where(F.col(group).isNull()).select(form, group, pos, *axes))
    off = long(rows, pos).join(off.select(form, "axis", "value", "mode", "_rare"), [form, "axis", "value"]).withColumn("dev", F.col("value") - F.col("mode")).drop("mode")
    off = stored(off, "deviations")
    dev = off.where("_rare").drop("_rare")
    steps = F.explode(F.array(*[F.lit(k) for k in range(-reach, reach + 1) if k]))
    other = off.select(F.col(group).alias("_g"), F.col(pos).alias("_at"), steps.alias("_step"), (-F.signum("dev")).alias("_s"))
    other = other.select("_g", (F.col("_at") + F.col("_step")).alias("_p"), "_s").distinct()
    near = (F.col(group) == F.col("_g")) & (F.col(pos) == F.col("_p")) & (F.signum("dev") == F.col("_s"))
    alone = F.when(F.col("axis").isin(*review), "REVIEW").otherwise("HAPAX") if review else F.lit("HAPAX")
    return dev.join(other, near, "left").withColumn("grade", F.when(F.col("_g").isNotNull(), "PAIRED").otherwise(alone)).drop("_g", "_p", "_s")


#: Ranges of values that ``index_pick`` deals few large groups into.
RANGES = 512


def index_pick(df: DataFrame, group: str | list[str], value: str, index, few: bool = False) -> DataFrame:
    """The value at 0-based ``index(n)`` of each group's sorted values: ``(group, value, n)``.

    ``few``, for numbers in few large groups: rows are counted by range between quantiles of all values first, and only the rows of the
    range that a group's index falls into are sorted, so that no group is one task's.
    """
    g = cols(group)
    w = Window.partitionBy(*g)
    if few:
        df = df.where(F.col(value).isNotNull()).select(*g, value)
        cuts = sorted(set(df.approxQuantile(value, [k / RANGES for k in range(1, RANGES)], 0.5 / RANGES)) - {float("-inf"), float("inf")})
        ranged = df.withColumn("_v", F.col(value).cast("double"))
        if cuts:
            ranged = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_v", outputCol="_b", handleInvalid="keep").transform(ranged)
        else:
            ranged = ranged.withColumn("_b", F.lit(0.0))
        per = counts(ranged, *g, "_b", n="_k").withColumn("_to", F.sum("_k").over(w.orderBy("_b"))).withColumn("_n", F.sum("_k").over(w))
        per = per.withColumn("_at", index(F.col("_n"))).where((F.col("_to") > F.col("_at")) & (F.col("_to") - F.col("_k") <= F.col("_at")))
        # A row a group, stored, so that its size is known when the rows meet it.
        per = stored(per.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_b").alias("_r"), (F.col("_at") - F.col("_to") + F.col("_k")).alias("_at"), "_n"), "ranges")
        on = F.col("_b") == F.col("_r")
        for i, c in enumerate(g):
            on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        near = counts(ranged.join(per, on), *g, value, "_at", "_n").withColumn("_to", F.sum("n").over(w.orderBy(value)))
        return near.where((F.col("_to") > F.col("_at")) & (F.col("_to") - F.col("n") <= F.col("_at"))).select(*g, value, F.col("_n").alias("n"))
    ran = counts(df.where(F.col(value).isNotNull()), *g, value).withColumn("_to", F.sum("n").over(w.orderBy(value))).withColumn("_n", F.sum("n").over(w))
    at = index(F.col("_n"))
    return ran.where((F.col("_to") > at) & (F.col("_to") - F.col("n") <= at)).select(*g, value, F.col("_n").alias("n"))


def median_hi(df: DataFrame, group: str | list[str], value: str, min_n: int = 1, few: bool = False) -> DataFrame:
    """Upper median ``sorted[n // 2]`` of each group with at least ``min_n`` values: ``(group, median, n)``; ``few`` as in ``index_pick``."""
    return index_pick(df, group, value, lambda n: F.floor(n / 2), few).where(F.col("n") >= min_n).withColumnRenamed(value, "median")


def preferred_median(df: DataFrame, value: str, signature: str, family: str, min_n: int = 10) -> DataFrame:
    """``df`` with the upper ``median`` of its row's signature where that has ``min_n`` values at least, else of its family;
    ``by_signature`` says which.  Rows without either keep a null.  Families are few and large: their medians are stored, so that
    the planner knows their size and needn't bring a family's rows together."""
    sig = median_hi(df.where(F.col(signature).isNotNull()), signature, value, min_n).select(F.col(signature).alias("_s"), F.col("median").alias("_ms"))
    fam = stored(median_hi(df.where(F.col(family).isNotNull()), family, value, few=True).select(F.col(family).alias("_f"), F.col("median").alias("_mf")), "medians")
    j = df.join(sig, F.col(signature) == F.col("_s"), "left").join(fam, F.col(family) == F.col("_f"), "left")
    return j.select(*df.columns, F.coalesce("_ms", "_mf").alias("median"), F.col("_ms").isNotNull().alias("by_signature"))


def ratio_outlier(df: DataFrame, group: str, value: str, lo: float, hi: float, min_off: float = 0.0, min_n: int = 1) -> DataFrame:
    """Rows whose value over their group's upper median lies outside [lo, hi] and is off by ``min_off`` at least."""
    m = median_hi(df, group, value, min_n).select(F.col(group).alias("_g"), "median")
    r = df.join(m, F.col(group) == F.col("_g")).where("median <> 0").withColumn("ratio", F.col(value) / F.col("median"))
    return r.where(((F.col("ratio") < lo) | (F.col("ratio") > hi)) & (F.abs(F.col(value) - F.col("median")) >= min_off)).drop("_g")


def index_quantile(df: DataFrame, group: str | list[str], value: str, p: float, few: bool = False) -> DataFrame:
    """``sorted[min(n - 1, int(p n))]`` of each group; ``few`` as in ``index_pick``."""
    return index_pick(df, group, value, lambda n: F.least(n - 1, F.floor(n * p)), few).withColumnRenamed(value, "quantile")


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """A10: rows in each half-open bucket [lo, hi), empty ones too: ``(lo, hi, n)``."""
    pairs = list(zip(edges, edges[1:]))
    bucket = F.coalesce(*[F.when((F.col(value) >= a) & (F.col(value) < b), F.lit(k)) for k, (a, b) in enumerate(pairs)])
    got = df.select(bucket.alias("_b")).where("_b is not null").groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(pairs)], "_b int, lo double, hi double")
    return frame.join(got, "_b", "left").select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def capped_histogram(df: DataFrame, value: str, cap: int) -> DataFrame:
    """A10: rows by ``min(cap, int(value))``."""
    return df.where(F.col(value).isNotNull()).groupBy(F.least(F.lit(cap), F.floor(value)).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def empty_bands(df: DataFrame, value: str, min_gap: float, limit: float, top: int = 400) -> DataFrame:
    """Gaps wider than ``min_gap`` between neighbours among the ``top`` largest values, and whether ``limit`` lies inside."""
    best = df.select(value).where(F.col(value).isNotNull()).orderBy(F.col(value).desc()).limit(top)
    below = F.lead(value).over(Window.orderBy(F.col(value).desc()))  # `top` rows
    return best.select(F.col(value).alias("above"), below.alias("below")).where(F.col("above") - F.col("below") > min_gap).withColumn("holds_limit", (F.col("below") <= limit) & (F.col("above") >= limit))


def noisy_or(df: DataFrame, key: str | list[str], p: Column, proof: Column | None = None) -> DataFrame:
    """``1 - prod(1 - p)`` per key with p clamped to [0, 0.999999]; any proof makes it 1."""
    clamped = F.least(F.greatest(p, F.lit(0.0)), F.lit(0.999999))
    soft = 1 - F.exp(F.sum(F.log1p(-clamped)))
    sure = F.coalesce(F.bool_or(F.lit(False) if proof is None else proof), F.lit(False))
    return df.groupBy(*cols(key)).agg(F.when(sure, 1.0).otherwise(F.coalesce(soft, F.lit(0.0))).alias("p"))


def tier(p: Column, proven: Column) -> Column:
    """certain (proven), high from 0.5 on, review from 0.2 on, else clean; ``p`` to nine places."""
    p = F.round(p, 9)
    return F.when(proven, "certain").when(p >= 0.5, "high").when(p >= 0.2, "review").otherwise("clean")


def combined_evidence(evidence: DataFrame, keys: list[str], name: str = "name", p: str = "p", proof: str = "proof") -> DataFrame:
    """Evidence rows by ``keys``: ``proven``, ``soft`` (noisy or), ``names``, ``proofs`` and ``evidence`` of what fired."""
    clamped = F.least(F.greatest(F.col(p), F.lit(0.0)), F.lit(0.999999))
    sure = F.coalesce(F.col(proof), F.lit(False))
    fired = F.coalesce(F.col(p) > 0, F.lit(False)) | sure
    return evidence.groupBy(*keys).agg(
        F.bool_or(sure).alias("proven"), (1 - F.exp(F.sum(F.coalesce(F.log1p(-clamped), F.lit(0.0))))).alias("soft"),
        F.collect_set(F.when(fired & ~sure, F.col(name))).alias("names"), F.array_sort(F.collect_set(F.when(sure, F.col(name)))).alias("proofs"),
        F.array_sort(F.collect_list(F.when(fired, F.struct(F.col(name).alias("name"), F.round(p, 3).alias("p"))))).alias("evidence"),
    )


def score_entity(
    evidence: DataFrame, key: str, name: str = "name", p: str = "p", proof: str = "proof", child: str | None = None,
    fold_min: float = 0.15, width: str = "width", width_cap: float = 0.45,
) -> DataFrame:
    """Evidence rows -> ``(key, p, tier, proofs, evidence)``.

    Rows with a ``child`` are evidence of a part of the entity: a part's combined p counts as one piece of evidence, named ``mark``, if it is
    ``fold_min`` at least, and as a proof if it is proven; so many weak parts don't add up.  Any proof makes p 1 and the tier
    certain.  With soft evidence of ``width`` alone, p stops at ``width_cap``.
    """
    used = evidence.select(key, *([child] if child else []), F.col(name).alias("name"), F.col(p).alias("p"), F.col(proof).alias("proof"))
    if child:
        parts = combined_evidence(used.where(F.col(child).isNotNull()), [key, child])
        whole = F.round(F.when(F.col("proven"), 1.0).otherwise(F.col("soft")), 9)
        folded = parts.select(key, F.lit("mark").alias("name"), whole.alias("p"), F.col("proven").alias("proof")).where((F.col("p") >= fold_min) | F.col("proof"))
        # An entity whose parts are all clean still has a row.
        clean = parts.select(key).distinct().select(key, F.lit("none").alias("name"), F.lit(0.0).alias("p"), F.lit(False).alias("proof"))
        used = used.where(F.col(child).isNull()).drop(child).unionByName(folded).unionByName(clean)
    g = combined_evidence(used, [key])
    only = (F.size("names") > 0) & (F.size(F.array_remove("names", width)) == 0)
    value = F.when(F.col("proven"), 1.0).when(only, F.least(F.col("soft"), F.lit(width_cap))).otherwise(F.col("soft"))
    return g.withColumn("p", value).select(key, "p", tier(F.col("p"), F.col("proven")).alias("tier"), "proofs", "evidence")


def box_union(df: DataFrame, group: str, kind: Column | None = None) -> DataFrame:
    """The box around all boxes of a group, and around those where ``kind`` holds (nulls if none)."""
    aggs = [f(c).alias(c) for c, f in (("x0", F.min), ("x1", F.max), ("y0", F.min), ("y1", F.max))]
    if kind is not None:
        aggs += [f(F.when(kind, F.col(c))).alias(f"kind_{c}") for c, f in (("x0", F.min), ("x1", F.max), ("y0", F.min), ("y1", F.max))]
    return df.groupBy(group).agg(*aggs)


def group_summary(df: DataFrame, group: str, key: str, order: str | list[str], distinct: str, *more: Column) -> DataFrame:
    """Rows, first and last key in order, and the sorted distinct values of a column per group; and more aggregates of it."""
    o = F.struct(*cols(order))
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min_by(key, o).alias("first_key"), F.max_by(key, o).alias("last_key"), F.array_sort(F.collect_set(distinct)).alias("kinds"), *more)


def division_map(df: DataFrame, group: str, name: str, value: str, order: str | list[str]) -> DataFrame:
    """``(group, divisions)``: a map of a group's division names to the first value of each in order; rows with a null name or value
    name no division, and groups without any have no row."""
    first = df.where(F.col(name).isNotNull() & F.col(value).isNotNull()).groupBy(group, name).agg(F.min_by(value, F.struct(*cols(order))).alias("_v"))
    entry = F.struct(F.col(name).alias("k"), F.col("_v").alias("v"))
    return first.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("divisions"))


def first_seen(df: DataFrame, key: str | list[str], order: str | list[str], values: list[str]) -> DataFrame:
    """The values of each key's first row in order, then by value."""
    k, o = cols(key), cols(order)
    first = F.min(F.struct(*o, *[v for v in values if v not in o])).alias("_v")
    return df.groupBy(*k).agg(first).select(*k, *[f"_v.{v}" for v in values])


def ordered_text(df: DataFrame, group: str, order: list[str], token: str, line: str, sep: str = " ", line_sep: str = "\n") -> DataFrame:
    """A group's tokens joined in order; ``line_sep`` where the line changes; null tokens are skipped.  A group is one text."""
    w = Window.partitionBy(group).orderBy(*order)
    before = F.lag(line).over(w)
    glue = F.when(F.row_number().over(w) == 1, "").when(before == F.col(line), sep).otherwise(line_sep)
    rows = df.where(F.col(token).isNotNull()).select(group, F.struct(*order, F.concat(glue, F.col(token)).alias("_t")).alias("_s"))
    return rows.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["_t"]), "").alias("text"))


def completeness(df: DataFrame, group: str, n: str, expected: DataFrame, cut: str | None = None) -> DataFrame:
    """Against ``expected (group, n_expected[, cut])``: numbers of a group that are duplicate, missing from 1..N or above N.

    Where the boolean column ``cut`` says that the rows may begin late, a group that lacks 1 is ``partial``, and what it misses isn't a gap.
    With ``cut`` the result has the column ``partial``.  Numbers are counted, never listed: the size of a group doesn't matter.
    """
    have = counts(df.where(F.col(n).isNotNull()), group, n, n="_k").join(expected.select(F.col(group).alias("_g"), F.col("n_expected").alias("_e")), F.col(group) == F.col("_g"))
    agg = have.groupBy(group).agg(
        F.count_if(F.col("_k") > 1).alias("duplicates"), F.count_if(F.col(n).between(1, F.col("_e"))).alias("_in"), F.count_if(F.col(n) > F.col("_e")).alias("extra"), F.count_if(F.col(n) == 1).alias("_one")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    partial = F.coalesce(F.col(cut), F.lit(False)) & (zero("_one") == 0) & (F.col("n_expected") > 0) & F.col("_in").isNotNull() if cut else F.lit(False)
    missing = F.when(partial, 0).otherwise(F.greatest(F.col("n_expected").cast("long"), F.lit(0)) - zero("_in"))
    out = [group, zero("duplicates").alias("duplicates"), missing.alias("missing"), zero("extra").alias("extra")]
    return expected.join(agg, group, "left").select(*out, *([partial.alias("partial")] if cut else []))


def expected_counts(base: DataFrame, adjust: DataFrame, key: str, system: str) -> DataFrame:
    """Base count less the ends ``system`` omits plus the extra ends it counts: ``adjust (key, counted_by array, in_base)``."""
    counted = F.array_contains("counted_by", system)
    delta = F.when(counted & ~F.col("in_base"), 1).when(~counted & F.col("in_base"), -1).otherwise(0)
    d = adjust.groupBy(key).agg(F.sum(delta).alias("_d"))
    return base.join(d, key, "left").select(key, (F.col("n") + F.coalesce("_d", F.lit(0))).alias("expected"))


def grouped_tallies(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """One pass, several groupings; ``level`` tells which columns were grouped."""
    names = sorted({c for s in sets for c in s})
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*names).alias("level"))


def two_sided_score(df: DataFrame, a: str, b: str, expected: str) -> DataFrame:
    """Per side the mean of |log(measured / expected)|, its upper 0.9 index quantile and rows beyond 1.5 and 2 times; a verdict for side a."""
    side = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.abs(F.log(F.col(c) / F.col(expected))).alias("e")) for s, c in (("a", a), ("b", b))]))
    long = df.where(f"{a} > 0 and {b} > 0 and {expected} > 0").select(side.alias("s")).select("s.side", F.round("s.e", 9).alias("e"))
    q = index_quantile(long, "side", "e", 0.9, few=True).select("side", F.col("quantile").alias("p90"))
    out = long.groupBy("side").agg(F.avg("e").alias("mean"), F.count_if(F.col("e") > np.log(1.5)).alias("beyond_15"), F.count_if(F.col("e") > np.log(2.0)).alias("beyond_2"), F.count(F.lit(1)).alias("n")).join(q, "side")
    rival = F.sum("mean").over(Window.partitionBy()) - F.col("mean")  # two rows
    return out.withColumn("verdict", F.when(F.abs(rival - F.col("mean")) < 1e-9, "equal").when(F.col("mean") < rival, "better").otherwise("worse"))


def one_sided_keys(df: DataFrame, key: list[str], a: str, b: str, expected: str, factor: float = 1.5) -> DataFrame:
    """Rows of which exactly one side is more than ``factor`` times off what was expected, either way: ``(key, side, ratio, other)``,
    ``side`` being the one that is off, with both ratios.  Rows where a side or the expectation isn't above 0 can't be judged."""
    far = lambda c: F.round(F.abs(F.log(F.col(c) / F.col(expected))), 9) > float(np.log(factor))
    j = df.where(f"{a} > 0 and {b} > 0 and {expected} > 0").withColumns({"_a": far(a), "_b": far(b)}).where("_a <> _b")
    ratio = lambda yes, no: F.when(F.col("_a"), F.col(yes)).otherwise(F.col(no)) / F.col(expected)
    return j.select(*key, F.when(F.col("_a"), "a").otherwise("b").alias("side"), ratio(a, b).alias("ratio"), ratio(b, a).alias("other"))


def source_scoreboard(candidates: DataFrame, truth: DataFrame, key: list[str], name: str = "name", n: str = "n") -> DataFrame:
    """Candidate counts (name, key.., n) against truth (key.., n): groups exact, differing and without text, and the rate."""
    c = candidates.select(name, *key, F.col(n).alias("_c"))
    want = truth.select(*key, F.col(n).alias("_t"))
    tot = want.count()
    j = c.join(want, key, "left")
    g = j.groupBy(name).agg(F.count_if(F.col("_c") == F.col("_t")).alias("exact"), F.count_if(F.col("_c") != F.col("_t")).alias("differs"), F.count_if(F.col("_t").isNotNull()).alias("_m"))
    return g.select(name, "exact", "differs", (F.lit(tot) - F.col("_m")).alias("no_text"), (F.col("exact") / F.greatest(F.col("exact") + F.col("differs"), F.lit(1))).alias("rate"))


def composite_text(main: Column, other: Column, letters: str) -> Column:
    """A candidate of two sources: ``main`` without the characters of the class ``letters``, then those of ``other``."""
    return F.concat(F.regexp_replace(main, f"[{letters}]", ""), F.regexp_replace(F.coalesce(other, F.lit("")), f"[^{letters}]", ""))


def family_errors(candidates: DataFrame, truth: DataFrame, key: list[str], families: dict[str, str], name: str = "name", text: str = "text") -> DataFrame:
    """``name, key, text, truth, errors`` of every candidate text (name, key.., text) whose key the truth (key.., text) has: ``errors`` is an
    array of (family, got, want), empty where all families, character classes by name, occur equally often.  Empty texts are left out."""
    tally = lambda c: F.array(*[F.regexp_count(c, F.lit(f"[{letters}]")) for letters in families.values()])
    c = candidates.where(F.length(text) > 0).select(name, *key, F.col(text).alias("text"), tally(F.col(text)).alias("_got"))
    w = truth.where(F.col(text).isNotNull()).select(*[F.col(k).alias(f"_{k}") for k in key], F.col(text).alias("truth"), tally(F.col(text)).alias("_want"))
    on = F.lit(True)
    for k in key:
        on = on & (F.col(k) == F.col(f"_{k}"))
    one = lambda i, f: F.when(F.col("_got")[i] != F.col("_want")[i], F.struct(F.lit(f).alias("family"), F.col("_got")[i].alias("got"), F.col("_want")[i].alias("want")))
    errors = F.array_compact(F.array(*[one(i, f) for i, f in enumerate(families)]))
    return c.join(w, on).select(name, *key, "text", "truth", errors.alias("errors"))


def family_scoreboard(errors: DataFrame, truth: DataFrame, families: dict[str, str], name: str = "name", text: str = "text") -> DataFrame:
    """From ``family_errors``, per candidate ``name, exact, differs, no_text, rate`` and a column for each family: texts it goes wrong in."""
    total = truth.where(F.col(text).isNotNull()).count()
    wrong = [F.count_if(F.array_contains("errors.family", f)).alias(f) for f in families]
    same = F.size("errors") == 0
    g = errors.groupBy(name).agg(F.count_if(same).alias("exact"), F.count_if(~same).alias("differs"), *wrong)
    seen = F.col("exact") + F.col("differs")
    return g.select(name, "exact", "differs", (F.lit(total) - seen).alias("no_text"), (F.col("exact") / F.greatest(seen, F.lit(1))).alias("rate"), *families)


def family_examples(errors: DataFrame, key: list[str], most: int = 40, name: str = "name") -> DataFrame:
    """The first ``most`` texts, by key, of each candidate and family that it gets wrong: ``name, family, key, text, truth, got, want``."""
    e = errors.withColumn("_e", F.explode("errors")).select(name, "_e.family", *key, "text", "truth", "_e.got", "_e.want")
    return e.withColumn("_n", F.row_number().over(Window.partitionBy(name, "family").orderBy(*key))).where(F.col("_n") <= most).drop("_n")


def confusion_by_split(df: DataFrame, flag: Column, stratum: Column) -> DataFrame:
    """Defect rate inside and outside a stratum, and the lift."""
    hit, inside = F.coalesce(flag, F.lit(False)), F.coalesce(stratum, F.lit(False))
    g = df.agg(F.count_if(inside).alias("n_in"), F.count_if(~inside).alias("n_out"), F.count_if(inside & hit).alias("k_in"), F.count_if(~inside & hit).alias("k_out"))
    g = g.withColumns({"rate_in": F.try_divide("k_in", "n_in"), "rate_out": F.try_divide("k_out", "n_out")})
    return g.withColumn("lift", F.try_divide("rate_in", "rate_out"))


def fragment_histogram(df: DataFrame, entity: str, group: str) -> DataFrame:
    """Entities by number of parts, and how many groups those span at most."""
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("parts"), F.count_distinct(group).alias("spans"))
    return per.groupBy("parts").agg(F.count(F.lit(1)).alias("entities"), F.max("spans").alias("most_spans"))


def theil_slope(df: DataFrame, group: str, x: str, y: str, min_dx: float = 20.0, min_n: int = 8, min_slopes: int = 4, accept: tuple[float, float] = (0.6, 1.0), fallback: float = 0.75) -> DataFrame:
    """Per group of points: pair the i-th smallest x with the i-th largest, keep dx > ``min_dx``, median slope.

    A slope outside ``accept``, or too few points, is ``fallback``; offset: median residual; spread: median absolute residual.
    """
    w = Window.partitionBy(group)
    r = df.select(group, x, y).withColumns({"_i": F.row_number().over(w.orderBy(x, y)), "_n": F.count(F.lit(1)).over(w)})
    low = r.where("_i * 2 <= _n").select(group, F.col(x).alias("_x"), F.col(y).alias("_y"), "_i", "_n")
    high = r.select(F.col(group).alias("_g"), F.col(x).alias("_x2"), F.col(y).alias("_y2"), (F.col("_n") + 1 - F.col("_i")).alias("_i2"))
    pairs = low.join(high, (F.col(group) == F.col("_g")) & (F.col("_i") == F.col("_i2")) & (F.col("_x2") - F.col("_x") > min_dx))
    slopes = pairs.groupBy(group).agg(F.median((F.col("_y2") - F.col("_y")) / (F.col("_x2") - F.col("_x"))).alias("_s"), F.count(F.lit(1)).alias("_k"))
    sized = r.groupBy(group).agg(F.count(F.lit(1)).alias("n")).join(slopes, group, "left")
    ok = (F.col("n") >= min_n) & (F.col("_k") >= min_slopes) & (F.col("_s") > accept[0]) & (F.col("_s") < accept[1])
    fit = sized.select(F.col(group).alias("_f"), "n", F.when(ok, F.col("_s")).otherwise(fallback).alias("slope"), F.coalesce(ok, F.lit(False)).alias("fitted"))
    res = df.join(fit, F.col(group) == F.col("_f")).withColumn("_r", F.round(F.col(y) - F.col("slope") * F.col(x), 9))
    off = median_hi(res, group, "_r").select(F.col(group).alias("_o"), F.col("median").alias("offset"))
    away = res.join(off, F.col(group) == F.col("_o")).withColumn("_a", F.round(F.abs(F.col("_r") - F.col("offset")), 9))
    spread = median_hi(away, group, "_a").select(group, F.col("median").alias("spread"))
    return fit.join(off, F.col("_f") == F.col("_o")).withColumnRenamed("_f", group).join(spread, group).select(group, "n", "slope", "fitted", "offset", "spread")


def ols_refit(df: DataFrame, group: str, x: str, y: str, min_n: int = 12, times: float = 6.0) -> DataFrame:
    """Least squares per group of at least ``min_n`` points, refitted once without residuals above max(1, times x median)."""

    def fit(d: DataFrame, tag: str) -> DataFrame:
        return d.groupBy(F.col(group).alias(f"_g{tag}")).agg(F.count(F.lit(1)).alias(f"n{tag}"), F.regr_slope(y, x).alias(f"s{tag}"), F.regr_intercept(y, x).alias(f"i{tag}")).where(F.col(f"n{tag}") >= min_n)

    first = fit(df, "1")
    res = df.join(first, F.col(group) == F.col("_g1")).withColumn("_r", F.round(F.abs(F.col(y) - F.col("s1") * F.col(x) - F.col("i1")), 9))
    med = median_hi(res, group, "_r").select(F.col(group).alias("_m"), "median")
    kept = res.join(med, F.col(group) == F.col("_m")).where(F.col("_r") <= F.greatest(F.lit(1.0), F.col("median") * times)).select(group, x, y)
    out = first.join(fit(kept, "2"), F.col("_g1") == F.col("_g2"), "left")
    return out.select(F.col("_g1").alias(group), F.coalesce("n2", "n1").alias("n"), F.coalesce("s2", "s1").alias("slope"), F.coalesce("i2", "i1").alias("intercept"))


def modal_shift(a: DataFrame, b: DataFrame, group: str, x: str, y: str, size: str, grid: float = 1.0, most: int = 3) -> DataFrame:
    """Candidate pairs of equal rounded size (at most ``most`` partners) vote for a rounded shift; the most votes win."""
    bb = b.select(F.col(group).alias("_g"), F.round(size, 0).alias("_s"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    bb = bb.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("_g", "_s"))).where(F.col("_k") <= most)
    j = a.join(bb, (F.col(group) == F.col("_g")) & (F.round(size, 0) == F.col("_s")))
    votes = j.groupBy(group, (F.round((F.col("_x") - F.col(x)) / grid, 0) * grid).alias("dx"), (F.round((F.col("_y") - F.col(y)) / grid, 0) * grid).alias("dy")).agg(F.count(F.lit(1)).alias("votes"))
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.col("votes").desc(), "dx", "dy"))
    return votes.withColumn("_r", best).where("_r = 1").drop("_r")


#: Features up to which the normal equations are solved on the driver: their square is what it holds.
DENSE = 1000


def ridge_fit(samples: DataFrame, row: str, feature: str, n: str, y: str, lam: float = 0.5, dense: int = DENSE, tol: float = 1e-10) -> DataFrame:
    """``feature, weight, samples`` of ``y ~ sum(n x weight)`` over long samples (row, feature, n, y), with penalty ``lam`` on weights.

    The normal equations are summed in Spark.  Up to ``dense`` features the driver solves them; beyond that, conjugate gradients
    do, whose every step is a join of the sparse equations with a direction and whose state is stored, until the residual is ``tol``
    times the right side.  Samples with a null take no part.
    """
    samples = samples.select(F.col(row).alias("_row"), F.col(feature).alias(feature), F.col(n).cast("double").alias("_n"), F.col(y).cast("double").alias("_y")).dropna()
    sides = stored(samples.groupBy(feature).agg(F.sum(F.col("_n") * F.col("_y")).alias("b"), F.count(F.lit(1)).alias("samples")), "ridge-sides")
    pair = samples.select(F.col("_row").alias("_r"), F.col(feature).alias("_f"), F.col("_n").alias("_m"))
    square = samples.join(pair, F.col("_row") == F.col("_r")).groupBy(feature, "_f").agg(F.sum(F.col("_n") * F.col("_m")).alias("v"))
    if sides.count() <= dense:
        right = sides.orderBy(feature).collect()
        at = {r[0]: i for i, r in enumerate(right)}
        m = np.eye(len(at)) * lam
        for r in square.collect():
            m[at[r[0]], at[r[1]]] += float(r["v"])
        w = np.linalg.solve(m, np.array([float(r["b"]) for r in right])) if at else []
        kind = samples.schema[feature].dataType.simpleString()
        return samples.sparkSession.createDataFrame([(r[0], float(v), r["samples"]) for r, v in zip(right, w)], f"{feature} {kind}, weight double, samples long")
    square = stored(square, "ridge-square")
    state = sides.select(feature, "samples", F.lit(0.0).alias("w"), F.col("b").alias("r"), F.col("b").alias("p"))
    left = start = sides.agg(F.sum(F.col("b") * F.col("b"))).first()[0]
    while left > tol * tol * start:
        step = square.join(state.select(F.col(feature).alias("_f"), F.col("p").alias("_p")), "_f").groupBy(feature).agg(F.sum(F.col("v") * F.col("_p")).alias("_q"))
        moved = stored(state.join(step, feature).withColumn("q", F.col("_q") + lam * F.col("p")).drop("_q"), "ridge-step")
        along = left / moved.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
        moved = moved.withColumns({"w": F.col("w") + along * F.col("p"), "r": F.col("r") - along * F.col("q")})
        before, left = left, moved.agg(F.sum(F.col("r") * F.col("r"))).first()[0]
        state = stored(moved.select(feature, "samples", "w", "r", (F.col("r") + left / before * F.col("p")).alias("p")), "ridge-state")
    return state.select(feature, F.col("w").alias("weight"), "samples")


def ridge_residuals(samples: DataFrame, weights: DataFrame, row: str, feature: str, n: str, y: str) -> DataFrame:
    """``row, y, predicted, residual`` (absolute); features without a weight add nothing."""
    j = samples.join(weights.select(F.col(feature).alias("_f"), "weight"), F.col(feature) == F.col("_f"), "left")
    g = j.groupBy(row, F.col(y).cast("double").alias("y")).agg(F.coalesce(F.sum(F.col(n) * F.col("weight")), F.lit(0.0)).alias("predicted"))
    return g.withColumn("residual", F.abs(F.col("predicted") - F.col("y")))


def residual_summary(residuals: DataFrame) -> DataFrame:
    """``rows, median, p90, mean_y``, residuals to two places (so that the different ones stay few)."""
    q = F.percentile(F.round("residual", 2), F.array(F.lit(0.5), F.lit(0.9)))
    return residuals.agg(F.count(F.lit(1)).alias("rows"), q.alias("_q"), F.avg("y").alias("mean_y")).select("rows", F.col("_q")[0].alias("median"), F.col("_q")[1].alias("p90"), "mean_y")
