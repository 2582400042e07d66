"""Set operations and comparison of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by, counts


def union_flags(*detectors: DataFrame) -> DataFrame:
    """Flags of several detectors under one schema; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), detectors)


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with their surplus: ``extra`` (more often in a) or ``missing`` (more often in b), ``n`` times.  No row: a and b are equal."""
    names = a.columns
    both = a.withColumn("_d", F.lit(1)).unionAll(b.select(*names).withColumn("_d", F.lit(-1)))
    g = both.groupBy(*names).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    return g.select(*names, F.when(F.col("_d") > 0, "extra").otherwise("missing").alias("side"), F.abs("_d").alias("n"))


def ambiguous_multiset_diff(have: DataFrame, want: DataFrame, key: str, token: str, options: str) -> DataFrame:
    """As X2 per key, where a wanted token may name alternatives (array ``options``): it becomes the first of them that ``have``
    has spare after the plain ones, else its first.  Several takers of one spare token queue in order of their first option."""
    single = want.where(F.size(options) == 1).select(key, F.element_at(options, 1).alias("t"))
    spare = counts(have.select(key, F.col(token).alias("t")), key, "t", n="_h").join(counts(single, key, "t", n="_s"), [key, "t"], "left")
    spare = spare.select(key, "t", (F.col("_h") - F.coalesce("_s", F.lit(0))).alias("_spare")).where("_spare > 0")
    vague = want.where(F.size(options) > 1).withColumn("_id", F.row_number().over(by(key).orderBy(options)))
    tries = vague.select(key, "_id", F.posexplode(options).alias("_o", "t")).join(spare, [key, "t"])
    first = tries.withColumn("_r", F.row_number().over(by(key, "_id").orderBy("_o"))).where("_r = 1")
    seated = first.withColumn("_q", F.row_number().over(by(key, "t").orderBy("_id"))).where("_q <= _spare").select(key, "_id", "t")
    solved = vague.join(seated, [key, "_id"], "left").select(key, F.coalesce("t", F.element_at(options, 1)).alias("t"))
    return multiset_diff(have.select(key, F.col(token).alias("t")), single.unionByName(solved))


def diff_runs(base: DataFrame, cand: DataFrame, group: str, family: str) -> DataFrame:
    """Over groups that both runs cover: flags per family before and after, the delta, and groups worse on the sum of all
    families or on this one only."""
    common = base.select(group).intersect(cand.select(group))
    tally = lambda d, n: counts(d.join(common, group, "left_semi"), group, family, n=n)
    j = tally(base, "before").join(tally(cand, "after"), [group, family], "full_outer").fillna(0, ["before", "after"])
    d = j.withColumn("_d", F.col("after") - F.col("before")).withColumn("_sum", F.sum("_d").over(by(group)))
    return d.groupBy(family).agg(
        F.sum("before").alias("before"), F.sum("after").alias("after"), F.sum("_d").alias("delta"), F.count_if(F.col("after") == 0).alias("clean"),
        F.count_if((F.col("_d") > 0) & (F.col("_sum") > 0)).alias("worse_on_sum"), F.count_if((F.col("_d") > 0) & (F.col("_sum") <= 0)).alias("worse_on_one"),
    )


def snapshot_equal(a: DataFrame, b: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys whose digests differ or that one side lacks."""
    j = a.select(key, F.col(digest).alias("_a")).join(b.select(key, F.col(digest).alias("_b")), key, "full_outer")
    return j.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(key, F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed").alias("change"))


def char_set_class(a: Column, b: Column, classes: list[tuple[str, str]], equal: str = "order", other: str = "other") -> Column:
    """The first class (name, characters) that holds all characters only one of two texts has; ``equal`` if there is none."""
    chars = lambda c: F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))
    diff = F.array_union(F.array_except(chars(a), chars(b)), F.array_except(chars(b), chars(a)))
    out = F.when(F.size(diff) == 0, equal)
    for name, allowed in classes:
        out = out.when(F.size(F.array_except(diff, F.array(*map(F.lit, allowed)))) == 0, name)
    return out.otherwise(other)
