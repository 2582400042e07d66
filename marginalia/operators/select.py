"""Selection: selectors, rules, lanes, coverage guards and small lookups."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sent

KEY = r"^\d+:\d+:\d+$"


def select_words(df: DataFrame, keys: DataFrame | None = None, key: str = "key", **equal) -> DataFrame:
    """rows that meet every given condition (column=value or list); ``keys`` keeps those with a key in its first column."""
    tests = [F.col(c).isin(*v) if isinstance(v, (list, tuple)) else F.col(c) == v for c, v in equal.items() if v is not None]
    out = df.where(reduce(and_, tests)) if tests else df
    return out if keys is None else out.join(keys.select(F.col(keys.columns[0]).alias("_key")).distinct(), F.col(key) == F.col("_key"), "left_semi")


def resolve(df: DataFrame, targets: DataFrame, levels: list[str]) -> DataFrame:
    """targets ``a``, ``a:b``, ``a:b:c`` or ``*`` (column ``target``) -> their rows, duplicates kept, in one equi join per depth.
    Up to ``SMALL`` targets go to the rows, so that these aren't shuffled."""
    depth = F.size(F.split("target", ":"))
    out, targets = None, sent(targets)
    for d in range(1, len(levels) + 1):
        at = targets.where((F.col("target") != "*") & (depth == d)).select("target", *[F.element_at(F.split("target", ":"), i + 1).alias(f"_t{i}") for i in range(d)])
        part = df.join(at, reduce(and_, [F.col(levels[i]).cast("string") == F.col(f"_t{i}") for i in range(d)])).select(*df.columns, "target")
        out = part if out is None else out.unionByName(part)
    stars = targets.where("target = '*'").count()
    if stars:
        every = F.explode(F.array_repeat(F.lit("*"), stars))
        out = out.unionByName(df.withColumn("target", every))
    return out


def parse_key(df: DataFrame, key: str) -> DataFrame:
    """``valid`` (three numbers joined by colons) and the numbers ``k1, k2, k3`` to order by; null where invalid."""
    parts = F.split(key, ":")
    return df.withColumn("valid", F.coalesce(F.col(key).rlike(KEY), F.lit(False))).withColumns({f"k{i + 1}": F.when(F.col("valid"), parts[i].cast("int")) for i in range(3)})


def apply_rules(df: DataFrame, rules: list[dict]) -> DataFrame:
    """ordered rules ``{id, category, when, note[, fix][, chain][, stop]}`` -> one row per rule that fires: ``..., rule, category, note,
    proposed_fix`` (null where a rule proposes none; a text or a column).

    Rules of one ``chain`` exclude one another in order; once a ``stop`` rule fires, later ones don't.
    """
    stopped, chains, hits = F.lit(False), {}, []
    fix = lambda f: (f if isinstance(f, Column) else F.lit(f)).cast("string")
    for r in rules:
        fired = F.coalesce(r["when"], F.lit(False)) & ~stopped
        if r.get("chain"):
            before = chains.get(r["chain"], F.lit(False))
            chains[r["chain"]] = before | fired
            fired = fired & ~before
        hits.append(F.when(fired, F.struct(F.lit(r["id"]).alias("rule"), F.lit(r["category"]).alias("category"), F.lit(r["note"]).alias("note"), fix(r.get("fix")).alias("proposed_fix"))))
        if r.get("stop"):
            stopped = stopped | fired
    return df.withColumn("_hit", F.explode(F.array_compact(F.array(*hits)))).select(*df.columns, "_hit.*")


def route_lane(defects: DataFrame, key: str, family: str, auto: list[str], contested: DataFrame, label: str = "label") -> DataFrame:
    """per key: all families ``label`` -> label (auto unless the key is contested); all within ``auto`` -> auto; else judge."""
    g = defects.groupBy(key).agg(F.array_sort(F.collect_set(family)).alias("families"))
    c = contested.select(F.col(contested.columns[0]).alias("_c")).distinct()
    g = g.join(c, F.col(key) == F.col("_c"), "left")
    within = F.size(F.array_except("families", F.array(*map(F.lit, [*auto, label])))) == 0
    only = F.forall("families", lambda x: x == label)
    return g.select(key, "families", F.when(only & F.col("_c").isNotNull(), "label").when(only | within, "auto").otherwise("judge").alias("lane"))


def guard_coverage(df: DataFrame, group: str, expected: int, name: str = "coverage") -> DataFrame:
    """one status row: fail where fewer than ``expected`` groups are covered, or no row at all."""
    g = df.agg(F.count_distinct(group).alias("groups"), F.count(F.lit(1)).alias("rows"))
    ok = (F.col("groups") >= expected) & (F.col("rows") > 0)
    return g.select(F.lit(name).alias("check"), "groups", "rows", F.when(ok, "ok").otherwise("fail").alias("status"))


def fuzzy_dim_lookup(dim: DataFrame, query: str, number: str, folded: list[str], raw: str) -> DataFrame:
    """digits find by number; else a case-folded query without punctuation is sought in the folded columns, or raw in ``raw``."""
    if query.strip().isdigit():
        return dim.where(F.col(number) == int(query))
    fold = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    q = fold(F.lit(query))
    return dim.where(reduce(lambda a, b: a | b, [F.contains(fold(F.col(c)), q) for c in folded] + [F.contains(F.col(raw), F.lit(query))]))


def contested(occurrences: DataFrame, labels: DataFrame, sig: str, name: str, label: str, word: str) -> DataFrame:
    """F8: occurrences whose name differs from their signature's label, unless a composite label ``a+b`` contains it; by signature."""
    j = occurrences.join(labels.select(F.col(sig).alias("_s"), F.col(label).alias("_l")), F.col(sig) == F.col("_s"))
    odd = j.where((F.col(name) != F.col("_l")) & ~F.array_contains(F.split("_l", r"\+"), F.col(name)))
    return odd.groupBy(sig, F.col("_l").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(word).alias("words"), F.array_sort(F.collect_set(name)).alias("names"))


def mark_selector(df: DataFrame, registry: DataFrame, name: str, kind: str, wanted: str, **equal) -> DataFrame:
    """rows whose name the registry files under ``kind`` (name, family or category) = ``wanted``, and other conditions."""
    return select_words(df, **equal).join(registry.where(F.col(kind) == wanted).select(F.col("name").alias("_n")), F.col(name) == F.col("_n"), "left_semi")


# Sorting, limits and ranks


def worst_first(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows in an order that must end in a key, so that ties are stable."""
    return df.orderBy(*order).limit(n)


def examples_per_group(df: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def page_slice(df: DataFrame, order: list[str], offset: int, n: int) -> DataFrame:
    """Rows [offset, offset + n) in order, each with the total."""
    return df.orderBy(*order).offset(offset).limit(n).withColumn("total", F.lit(df.count()))


def two_level_rank(df: DataFrame, group: str, member: str, reviewed: str, pinned=None, top: int | None = None) -> DataFrame:
    """T4: groups by total (a pinned one first), the ``top`` ones only if given, members by count, and the share of each group reviewed.

    A group's rank is the number of groups with a larger total and its place among its equals, so no window holds all groups.
    """
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.avg(F.col(reviewed).cast("int")).alias("reviewed_share"))
    g = g.withColumn("_pin", F.coalesce(F.col(group) == F.lit(pinned), F.lit(False)) if pinned is not None else F.lit(False))
    totals = g.groupBy(F.col("_pin").alias("_p"), F.col("total").alias("_t")).agg(F.count(F.lit(1)).alias("_same"))
    up = Window.orderBy(F.col("_p").desc(), F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per different total
    totals = totals.withColumn("_above", F.coalesce(F.sum("_same").over(up), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_pin", "total").orderBy(group))
    best = g.join(totals, (F.col("_pin") == F.col("_p")) & (F.col("total") == F.col("_t")))
    best = best.withColumn("group_rank", (F.col("_above") + place).cast("int")).select(group, "total", "reviewed_share", "group_rank")
    best = best if top is None else best.where(F.col("group_rank") <= top)
    m = df.groupBy(group, member).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col("n").desc(), member))
    return m.join(best, group).withColumn("member_rank", rank)


def rank_by_detectors(flags: DataFrame, key: str, detector: str, top: int | None = None) -> DataFrame:
    """T5: entities by number of different detectors that convict them, then key; the first ``top`` only if given."""
    ranked = flags.groupBy(key).agg(F.count_distinct(detector).alias("detectors")).orderBy(F.col("detectors").desc(), key)
    return ranked if top is None else ranked.limit(top)
