"""Validation gates.  Every check is a row: ok, fail or skip; a skip is never a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import by_place, cols


def check(df: DataFrame, name: str, bad: Column | None = None, skip_empty: bool = True) -> DataFrame:
    """One row: rows that are bad; fail if there are any, skip if there was nothing to check."""
    n = F.count(F.lit(1))
    k = F.count_if(F.lit(True) if bad is None else F.coalesce(bad, F.lit(False)))
    status = F.when((n == 0) & F.lit(skip_empty), "skip").when(k > 0, "fail").otherwise("ok")
    return df.agg(F.lit(name).alias("check"), status.alias("status"), k.alias("bad"), n.alias("rows"))


def gate(checks: list[DataFrame]) -> DataFrame:
    """V1: all checks, and a row ``gate``: fail if one fails, skip if one is skipped, else ok."""
    rows = reduce(DataFrame.unionByName, checks)
    total = rows.agg(F.lit("gate").alias("check"), F.when(F.count_if(F.col("status") == "fail") > 0, "fail").when(F.count_if(F.col("status") == "skip") > 0, "skip").otherwise("ok").alias("status"), F.sum("bad").alias("bad"), F.sum("rows").alias("rows"))
    return rows.unionByName(total)


def behind(verdict: DataFrame, df: DataFrame) -> DataFrame:
    """V1: ``df`` if its ``gate`` is ok; nothing of it after a skip.  After a fail it can't be read: the error names the checks."""
    failed = F.array_join(F.collect_list(F.when((F.col("status") == "fail") & (F.col("check") != "gate"), F.col("check"))), ", ")
    total = verdict.agg(failed.alias("failed"), F.bool_and(F.col("status") == "ok").alias("ok"))
    passed = F.when(F.col("failed") != "", F.raise_error(F.concat(F.lit("gate failed: "), "failed"))).otherwise(F.col("ok"))
    return df.crossJoin(F.broadcast(total.where(passed).select(F.lit(True).alias("_ok")))).drop("_ok")


def unique_and_total(df: DataFrame, key: str, group: str, number: str) -> DataFrame:
    """V2: is the key unique; do rows, the sum over groups and the sum of group maxima agree; is each group 1..N exactly once."""
    per = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(number).alias("d"), F.max(number).alias("m"), F.min(number).alias("lo"))
    dense = (F.col("n") == F.col("d")) & (F.col("n") == F.col("m")) & (F.col("lo") == 1)
    g = per.agg(F.sum("n").alias("rows"), F.sum("m").cast("long").alias("by_maximum"), F.count_if(~dense).alias("broken_groups"))
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_k")).agg(F.count_if(F.col("_k") > 1).alias("duplicate_keys"), F.count(F.lit(1)).alias("keys"))
    out = g.unionByName(dup, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("rows", "by_maximum", "broken_groups", "duplicate_keys", "keys")])
    return out.withColumn("ok", (F.col("duplicate_keys") == 0) & (F.col("rows") == F.col("by_maximum")) & (F.col("broken_groups") == 0))


def reference_integrity(refs: DataFrame, key: str | list[str], targets: DataFrame, name: str) -> DataFrame:
    """V3: references without a target, and targets claimed more than once: one row each."""
    k = cols(key)
    lost = refs.join(targets.select(*k).distinct(), k, "left_anti")
    twice = refs.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return check(lost, f"{name}: reference exists", skip_empty=False).unionByName(check(twice, f"{name}: claimed once", skip_empty=False))


def relation_cardinality(relations: DataFrame, key: str, kind: str, member: str, sizes: dict[str, int]) -> DataFrame:
    """V3: relations whose number of members isn't the one of their kind."""
    want = reduce(lambda acc, kv: acc.when(F.col(kind) == kv[0], kv[1]), list(sizes.items())[1:], F.when(F.col(kind) == list(sizes)[0], list(sizes.values())[0]))
    return relations.groupBy(key, kind).agg(F.count(member).alias("n")).withColumn("want", want).where("n <> want")


def closed_vocabulary(df: DataFrame, value: str, registry: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """V4: per value: its rows and a problem: unknown, inactive, composite, or a count other than expected; null if none."""
    g = df.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    j = g.join(registry.select(F.col("name").alias("value"), "active"), "value", "left")
    if expected is not None:
        j = j.join(expected.select(F.col("name").alias("value"), F.col("n").alias("_e")), "value", "left")
    else:
        j = j.withColumn("_e", F.lit(None).cast("long"))
    why = F.when(F.contains(F.col("value"), F.lit("+")), "composite").when(F.col("active").isNull(), "unknown").when(~F.col("active"), "inactive").when(F.col("_e").isNotNull() & (F.col("n") != F.col("_e")), "count")
    return j.select("value", "n", why.alias("problem"))


def order_preserved(index: DataFrame, source: DataFrame, group: str, pos: str, key: str) -> DataFrame:
    """V5: groups whose index order isn't the source's, with the first place that differs."""
    j = by_place(index, source, group, pos, key)
    off = F.when(F.col("_alone"), F.col("_va") + F.col("_vb")).otherwise(F.col("_a") * F.col("_b") - F.col("_same") - F.col("_nulls"))
    return j.withColumn("_off", off).where("_off > 0").groupBy(group).agg(F.min(pos).alias("first_place"), F.sum("_off").alias("places"))


def schema_gate(df: DataFrame, schema: StructType, patterns: dict[str, str] | None = None, view: tuple[float, float, float, float] | None = None) -> DataFrame:
    """V6: violations as check rows: fields missing or of another type, nulls in required ones, patterns, and boxes that are degenerate or
    outside the view by more than 1."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    off = [f.name for f in schema if have.get(f.name) != f.dataType.simpleString()]
    rows = [df.sparkSession.createDataFrame([("schema", "fail" if off else "ok", len(off), len(schema))], "check string, status string, bad long, rows long")]
    rows += [check(df, f"{f.name}: present", F.col(f.name).isNull()) for f in schema if not f.nullable and f.name in have]
    rows += [check(df, f"{c}: pattern", ~F.col(c).rlike(p)) for c, p in (patterns or {}).items()]
    if view:
        a, b, c, d = view
        rows.append(check(df, "box: size", (F.col("x0") >= F.col("x1")) | (F.col("y0") >= F.col("y1"))))
        rows.append(check(df, "box: view", (F.col("x0") < a - 1) | (F.col("x1") > b + 1) | (F.col("y0") < c - 1) | (F.col("y1") > d + 1)))
    return reduce(DataFrame.unionByName, rows)


def preflight(needed: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """V7: every required input that isn't there, all at once."""
    return needed.select(name).join(present.select(name), name, "left_anti").orderBy(name)


def benchmark_score(df: DataFrame, groups: DataFrame, group: str, failed: Column, over_budget: Column, bad: Column, measured: str, expected: str) -> DataFrame:
    """V8: 100 x failures + 3 x over budget + 5 x bad + floor(1000 x mean |log(measured / expected)|) over fixed groups."""
    s = df.join(groups.select(group).distinct(), group, "left_semi")
    err = F.avg(F.when((F.col(measured) > 0) & (F.col(expected) > 0), F.abs(F.log(F.col(measured) / F.col(expected)))))
    g = s.agg(F.count_if(failed).alias("failures"), F.count_if(over_budget).alias("budget"), F.count_if(bad).alias("bad"), F.floor(F.round(1000 * F.coalesce(err, F.lit(0.0)), 6)).alias("drift"))
    return g.withColumn("score", 100 * F.col("failures") + 3 * F.col("budget") + 5 * F.col("bad") + F.col("drift"))
