"""Joins: reconciling sources, ranges, intervals, bands, rectangles and nearest matches.

Spark has no range or spatial join, so those become equi joins on a group and, where a group can be large, on
buckets of the axis, with the exact predicate on top.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import boxes
from marginalia.functions.text import split_identifier

from .common import by, cols, large_groups, of_groups, sent, stored


#: Buckets of ``asof_floor``, at most: their ends are sorted by one task.
MOST_BUCKETS = 4096


def suffixed(df: DataFrame, suffix: str = "2") -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}{suffix}") for c in df.columns])


def box(s: str = "") -> boxes.Box:
    return tuple(F.col(f"{c}{s}") for c in ("x0", "x1", "y0", "y1"))


def reconcile(a: DataFrame, b: DataFrame, key: str | list[str]) -> DataFrame:
    """``side`` (both, only-a, only-b) per key, with the columns of both sides; other columns must differ by name."""
    k = cols(key)
    j = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), k, "full_outer")
    side = F.when(F.col("_a").isNull(), "only-b").when(F.col("_b").isNull(), "only-a").otherwise("both")
    return j.withColumn("side", side).drop("_a", "_b")


def guarded_join(a: DataFrame, b: DataFrame, key: list[str], skel_a: str, skel_b: str) -> DataFrame:
    """Inner join on the key with ``status``: compared, or text_mismatch where the skeletons disagree."""
    return a.join(b, key).withColumn("status", F.when(F.col(skel_a).eqNullSafe(F.col(skel_b)), "compared").otherwise("text_mismatch"))


def lookup_with_fallback(df: DataFrame, key: str, sources: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """First non-null value over ordered lookups (name, table, key, value): adds ``value`` and ``source`` ("miss" if none)."""
    out, names = df, []
    for n, (_, t, k, v) in enumerate(sources):
        out = out.join(t.select(F.col(k).alias(f"_k{n}"), F.col(v).alias(f"_v{n}")).dropDuplicates([f"_k{n}"]), F.col(key) == F.col(f"_k{n}"), "left").drop(f"_k{n}")
        names.append(f"_v{n}")
    won = reduce(lambda acc, n: acc.when(F.col(names[n]).isNotNull(), sources[n][0]), range(1, len(names)), F.when(F.col(names[0]).isNotNull(), sources[0][0]))
    return out.withColumn("value", F.coalesce(*names)).withColumn("source", won.otherwise("miss")).drop(*names)


def neighbour_partition_join(a: DataFrame, b: DataFrame, partition: str, key: str, value: str, reach: int = 1) -> DataFrame:
    """The value of a key filed in partition p - reach .. p + reach; the latest partition wins."""
    look = b.select(F.col(key).alias("_k"), F.col(partition).alias("_p"), F.col(value).alias("_v"))
    look = look.withColumn("_at", F.explode(F.sequence(F.col("_p") - reach, F.col("_p") + reach)))
    best = look.groupBy("_k", "_at").agg(F.max_by("_v", "_p").alias("found"))
    return a.join(best, (F.col(key) == F.col("_k")) & (F.col(partition) == F.col("_at")), "left").drop("_k", "_at")


def anti_dirty(df: DataFrame, key: str, dirty: list[DataFrame]) -> DataFrame:
    """Rows whose key is in none of the dirty tables (each has the key as its first column)."""
    keys = reduce(DataFrame.unionAll, [d.select(F.col(d.columns[0]).alias("_dirty")) for d in dirty]).distinct()
    return df.join(keys, F.col(key) == F.col("_dirty"), "left_anti")


def range_expand(ranges: DataFrame, lo: str, hi: str, ids: DataFrame, id_: str) -> DataFrame:
    """One row per id of ``ids`` inside each closed range; ids the scheme lacks are skipped, and so are empty ranges.

    The planner takes the expanded ranges to be as small as the ranges are and would broadcast them, so the join is named."""
    rows = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_id", F.explode(F.sequence(lo, hi))).hint("merge")
    return rows.join(ids.select(F.col(id_).alias("_known")).distinct(), F.col("_id") == F.col("_known")).withColumnRenamed("_id", "expanded").drop("_known")


def asof_floor(facts: DataFrame, key: str, bounds: DataFrame, start: str, value: str, before: str = "null", per_bucket: int = 200_000) -> DataFrame:
    """The last boundary at or before each key, as ``floor``.  Before the first: null, or the first if ``before='first'``.

    Only the distinct keys are merged with the bounds, so a key of many facts is one row; they are in buckets between quantiles of the
    keys, one for each ``per_bucket``, and only bucket ends are carried over, so no task sorts it all.  A null key counts as before the first.
    """
    kind = bounds.schema[value].dataType
    keys = facts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.lit(1).alias("_fact"))
    keys = keys.withColumn("_d", F.col("_k").cast("double"))
    buckets = max(1, min(MOST_BUCKETS, keys.count() // per_bucket))
    inner = keys.approxQuantile("_d", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)) if buckets > 1 else []
    inner = sorted({x for x in inner if math.isfinite(x)}) or [0.0]
    splitter = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="_d", outputCol="_b", handleInvalid="keep")
    marks = bounds.where(F.col(start).isNotNull()).select(F.col(start).alias("_k"), F.col(value).alias("_v"), F.lit(0).alias("_fact"))
    marks = splitter.transform(marks.withColumn("_d", F.col("_k").cast("double")))
    both = splitter.transform(keys).withColumn("_v", F.lit(None).cast(kind)).unionByName(marks)
    ends = both.groupBy("_b").agg(F.max_by("_v", F.when(F.col("_fact") == 0, F.col("_k"))).alias("_e"))  # a row a bucket
    carried = ends.select("_b", F.last("_e", True).over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    w = by("_b").orderBy("_k", "_fact").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_in", F.last("_v", True).over(w)).where("_fact = 1").join(F.broadcast(carried), "_b")  # MOST_BUCKETS + 1 rows at most
    found = found.select(F.col("_k").alias("_key"), F.coalesce("_in", "_carry").alias("_floor"))
    first = bounds.agg(F.min_by(value, start)).first()[0] if before == "first" else None
    floor = F.coalesce("_floor", F.lit(first).cast(kind))
    return facts.join(found, F.col(key) == F.col("_key"), "left").select(*facts.columns, floor.alias("floor"))


def division_rollup(n: Column) -> dict[str, Column]:
    """Coarser ordinals of a fine division (four and eight to one)."""
    quarter = F.pmod(n - 1, F.lit(4)) + 1
    return {"hizb": F.floor((n + 3) / 4), "quarter": quarter, "juz": F.floor((n + 7) / 8), "first_half": quarter <= 2}


def interval_contains(points: DataFrame, x: str, ranges: DataFrame, lo: str, hi: str, width: float) -> DataFrame:
    """Point and range pairs with lo <= x <= hi, by buckets of ``width``; a null ``hi`` ends with the last point's bucket."""
    top = points.agg(F.max(x)).first()[0]
    r = ranges.withColumn("_hi", F.coalesce(F.col(hi), F.lit(top)))
    r = r.where(F.col("_hi") >= F.col(lo)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col("_hi") / width))))
    p = points.withColumn("_c", F.floor(F.col(x) / width))
    return p.join(r, (F.col("_b") == F.col("_c")) & (F.col(x) >= F.col(lo)) & (F.col(x) <= F.col("_hi"))).drop("_b", "_c", "_hi")


def interval_overlap(a: DataFrame, b: DataFrame, group: str, min_ov: float, width: float | None = None) -> DataFrame:
    """Pairs of a group (b's columns suffixed 2) whose x-intervals share more than ``min_ov``; ``width`` adds buckets for large groups."""
    bb = suffixed(b)
    ov = boxes.overlap(F.col("x0"), F.col("x1"), F.col("x02"), F.col("x12"))
    on = F.col(group) == F.col(f"{group}2")
    if width:
        cells = lambda s: F.explode(F.sequence(F.floor(F.col(f"x0{s}") / width), F.floor(F.col(f"x1{s}") / width)))
        a, bb = a.withColumn("_c", cells("")), bb.withColumn("_c2", cells("2"))
        # A pair is taken in the first bucket it shares.
        first = F.greatest(F.floor(F.col("x0") / width), F.floor(F.col("x02") / width))
        return a.join(bb, on & (F.col("_c") == F.col("_c2")) & (ov > min_ov) & (F.col("_c") == first)).withColumn("overlap", ov).drop("_c", "_c2")
    return a.join(bb, on & (ov > min_ov)).withColumn("overlap", ov)


def exclusive_owner(
    items: DataFrame, holders: DataFrame, group: str, item: str, owner: str, min_ov: float = 0.5, max_clear: float = 6.5, min_lead: float = 0.3, width: float | None = None
) -> DataFrame:
    """Items that touch exactly one holder, and not their own: own overlap <= ``min_ov`` and one other's above it, with
    vertical clearance <= ``max_clear`` and own gap - other gap >= ``min_lead``.

    An item meets its own holder by an equal key and the others by overlap alone; ``width`` adds J10's buckets for large groups.
    """
    h = suffixed(holders)
    own = items.join(h, (F.col(group) == F.col(f"{group}2")) & (F.col(owner) == F.col(f"{owner}2")))
    own = own.withColumns({"overlap": boxes.overlap(F.col("x0"), F.col("x1"), F.col("x02"), F.col("x12")), "_mine": F.lit(True)})
    others = interval_overlap(items, holders, group, min_ov, width).where(F.col(owner) != F.col(f"{owner}2")).withColumn("_mine", F.lit(False))
    j = own.unionByName(others).withColumn("_clear", boxes.gap(F.col("y0"), F.col("y1"), F.col("y02"), F.col("y12")))
    gap = F.greatest(-F.col("overlap"), F.lit(0.0))
    other = lambda c: F.max(F.when(~F.col("_mine"), c))
    g = j.groupBy(group, item, owner).agg(
        F.count_if(~F.col("_mine")).alias("_n"), F.max(F.when(F.col("_mine"), F.col("overlap"))).alias("_own"), F.min(F.when(F.col("_mine"), gap)).alias("_own_gap"),
        other(F.col(f"{owner}2")).alias("other"), other(F.col("_clear")).alias("clear"), other(gap).alias("_other_gap"),
    )
    keep = (F.col("_n") == 1) & (F.col("_own") <= min_ov) & (F.col("clear") <= max_clear) & (F.col("_own_gap") - F.col("_other_gap") >= min_lead)
    return g.where(keep).select(group, item, owner, "other", "clear")


def assign_band(items: DataFrame, bands: DataFrame, group: str, item: list[str], band: str, height: float | None = None) -> DataFrame:
    """The band (y0, y1) of a group that contains an item's vertical centre, else the nearest; ties to the smaller band.

    With ``height``, for groups of many bands, centres meet the bands that contain them in buckets of that height; the rest take the nearer
    of the last band that ends before them and the first that begins after, found in one pass in order.
    """
    b = suffixed(bands)
    c = (F.col("y0") + F.col("y1")) / 2
    away = F.greatest(F.col("y02") - c, c - F.col("y12"), F.lit(0.0))
    best = lambda d: d.withColumn("_r", F.row_number().over(by(group, *item).orderBy("_d", "_band"))).where("_r = 1")
    out = [*items.columns, F.col("_band").alias("band"), F.col("_d").alias("distance")]
    if not height:
        return best(items.join(b, F.col(group) == F.col(f"{group}2")).withColumns({"_d": F.round(away, 9), "_band": F.col(f"{band}2")})).select(*out)
    cells = F.explode(F.sequence(F.floor(F.col("y02") / height), F.floor(F.col("y12") / height)))
    inside = items.withColumn("_c", F.floor(c / height)).join(
        b.withColumn("_c2", cells), (F.col(group) == F.col(f"{group}2")) & (F.col("_c") == F.col("_c2")) & (c >= F.col("y02")) & (c <= F.col("y12"))
    )
    inside = best(inside.withColumns({"_d": F.lit(0.0), "_band": F.col(f"{band}2")})).select(*items.columns, "_band", "_d")
    same = F.lit(True)
    for name in (group, *item):  # null-safe: the key of an item may hold nulls
        same = same & F.col(name).eqNullSafe(F.col(f"_k_{name}"))
    rest = items.join(inside.select(*[F.col(n).alias(f"_k_{n}") for n in (group, *item)]), same, "left_anti").where(F.col(group).isNotNull())
    edge = lambda y, side: bands.where(F.col(group).isNotNull() & F.col("y0").isNotNull() & F.col("y1").isNotNull()).select(group, F.round(y, 9).alias("_y"), F.lit(side).alias("_side"), F.struct(y, F.col(band).alias("b")).alias("_e"))
    rows = rest.withColumns({"_y": F.round(c, 9), "_side": F.lit(1)}).unionByName(edge(F.col("y1").alias("y"), 0), allowMissingColumns=True)
    rows = rows.unionByName(edge(F.col("y0").alias("y"), 2), allowMissingColumns=True)
    # Of bands that end (begin) together, the smallest stands nearest in order.
    before = F.last(F.when(F.col("_side") == 0, F.col("_e")), True).over(by(group).orderBy("_y", "_side", F.col("_e.b").desc()).rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(F.when(F.col("_side") == 2, F.col("_e")), True).over(by(group).orderBy("_y", "_side", F.col("_e.b")).rowsBetween(0, Window.unboundedFollowing))
    near = rows.withColumns({"_before": before, "_after": after}).where("_side = 1")
    near = near.withColumn("_two", F.explode(F.filter(F.array("_before", "_after"), lambda e: e.isNotNull())))
    near = near.withColumns({"_d": F.round(F.abs(F.col("_two.y") - c), 9), "_band": F.col("_two.b")})
    return inside.select(*out).unionByName(best(near).select(*out))


def assign_band_by_overlap(items: DataFrame, bands: DataFrame, group: str, item: list[str], band: str, own: str | None = None, height: float = 50.0) -> DataFrame:
    """The band (y0, y1) of a group that an item overlaps most, as ``band``, and the length of the overlap; of equal overlaps the item's
    ``own`` band wins, then the smaller one.  Items that overlap none have nulls.  Both meet in buckets of ``height``, so a group is never
    joined with itself whole."""
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / height), F.floor(F.col(b) / height)))
    b = suffixed(bands.where("y0 <= y1")).withColumn("_c2", cells("y02", "y12"))
    length = F.round(F.least("y1", "y12") - F.greatest("y0", "y02"), 9)
    met = items.where("y0 <= y1").withColumn("_c", cells("y0", "y1")).join(b, (F.col(group) == F.col(f"{group}2")) & (F.col("_c") == F.col("_c2")))
    mine = F.coalesce(F.col(own) == F.col(f"{band}2"), F.lit(False)) if own else F.lit(False)
    best = F.min(F.struct((-length).alias("l"), (~mine).alias("o"), F.col(f"{band}2").alias("b"))).alias("_m")
    found = met.where(length > 0).groupBy(*[F.col(k).alias(f"_{k}") for k in (group, *item)]).agg(best)
    on = F.lit(True)
    for k in (group, *item):
        on = on & (F.col(k) == F.col(f"_{k}"))
    return items.join(found, on, "left").select(*items.columns, F.col("_m.b").alias("band"), (-F.col("_m.l")).alias("overlap"))


def span_bands(
    rects: DataFrame, bands: DataFrame, group: str, key: str, band: str, share: float = 0.5, same: float = 2.0, clash: float = 0.3, height: float | None = None, sizes: DataFrame | None = None
) -> DataFrame:
    """Credit every band a rect covers by more than ``share`` of the smaller height; merge x-spans per (band, key); drop the
    copy of a span in the next band (ends within ``same``) where it clashes with over ``clash`` of its width with another key there.
    ``height``, for groups of many bands: rects meet bands in buckets of that height, where a group is large; small groups meet as they are
    dealt, and so does what has no two ends in order.  ``sizes``: rows whose groups have no fewer rows or bands and are cheaper to count."""
    rules = (group, key, band, share, same, clash)
    if not height:
        return _span_bands(rects, bands, *rules)
    large = large_groups(group, *([rects, bands] if sizes is None else [sizes]))
    if large is None:
        return _span_bands(rects, bands, *rules, together=True)
    rest = _span_bands(of_groups(rects, group, large, False), of_groups(bands, group, large, False), *rules, together=True)
    return rest.unionByName(_span_bands(of_groups(rects, group, large, True), of_groups(bands, group, large, True), *rules, height))


def _span_bands(rects: DataFrame, bands: DataFrame, group: str, key: str, band: str, share: float, same: float, clash: float, height: float | None = None, together: bool = False) -> DataFrame:
    ov = boxes.overlap(F.col("y0"), F.col("y1"), F.col("y02"), F.col("y12"))
    on = (F.col(group) == F.col(f"{group}2")) & (ov > share * F.least(F.col("y12") - F.col("y02"), F.col("y1") - F.col("y0")))
    meet = lambda r, b, near=F.lit(True): r.join(suffixed(b), on & near).select(group, f"{band}2", key, "x0", "x1")
    if height:
        cells = F.explode(F.sequence(F.floor(F.col("y0") / height), F.floor(F.col("y1") / height)))
        lies = F.coalesce((F.col("y0") <= F.col("y1")) & ~F.isnan("y0") & ~F.isnan("y1"), F.lit(False))
        # A pair that shares several buckets comes several times, which changes no least or largest end.
        hit = meet(rects.where(lies).withColumn("_c", cells), bands.where(lies).withColumn("_c", cells), F.col("_c") == F.col("_c2"))
        hit = hit.unionByName(meet(rects.where(~lies), bands)).unionByName(meet(rects.where(lies), bands.where(~lies)))
    else:
        hit = meet(rects, bands)
    spans = hit.groupBy(group, F.col(f"{band}2").alias("band"), key).agg(F.min("x0").alias("lo"), F.max("x1").alias("hi"))
    w = by(group, key).orderBy("band")
    copy = (F.lag("band").over(w) == F.col("band") - 1) & (F.abs(F.lag("lo").over(w) - F.col("lo")) <= same) & (F.abs(F.lag("hi").over(w) - F.col("hi")) <= same)
    spans = spans.withColumn("copy", F.coalesce(copy, F.lit(False)))
    over = lambda k, lo, hi: (F.col(key) != k) & (boxes.overlap(F.col("lo"), F.col("hi"), lo, hi) > clash * (F.col("hi") - F.col("lo")))
    if together:
        # A small group's spans lie in a task already: a window, where a join by group and band would shuffle them.
        real = F.collect_list(F.when(~F.col("copy"), F.struct(F.col(key).alias("k"), "lo", "hi"))).over(by(group, "band"))
        spans = spans.withColumn("_real", real)
        return spans.where(~F.col("copy") | ~F.coalesce(F.exists("_real", lambda r: over(r["k"], r["lo"], r["hi"])), F.lit(False))).drop("copy", "_real")
    real = spans.where("not copy").select(F.col(group).alias("_g"), F.col("band").alias("_b"), F.col(key).alias("_k"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    clashes = (F.col(group) == F.col("_g")) & (F.col("band") == F.col("_b")) & over(F.col("_k"), F.col("_lo"), F.col("_hi"))
    return spans.where("not copy").unionByName(spans.where("copy").join(real, clashes, "left_anti")).drop("copy")


def _grid(s: str, cell: float) -> Column:
    """A row for each grid cell that a box touches."""
    along = lambda axis: F.sequence(F.floor(F.col(f"{axis}0{s}") / cell), F.floor(F.col(f"{axis}1{s}") / cell))
    return F.explode_outer(F.flatten(F.transform(along("x"), lambda i: F.transform(along("y"), lambda j: F.struct(i.alias("i"), j.alias("j"))))))


def _first_cell(cell: float) -> Column:
    """The first cell two boxes share: their pair is taken there."""
    at = lambda axis: F.greatest(F.floor(F.col(f"{axis}0") / cell), F.floor(F.col(f"{axis}02") / cell))
    return F.struct(at("x").alias("i"), at("y").alias("j"))


def rect_pairs(df: DataFrame, group: str, rid: str, owner: str, eps: float = 0.05, cell: float | None = None) -> DataFrame:
    """Unordered pairs of a group with different owners that overlap by more than ``eps`` on both axes, with the area."""
    b = suffixed(df)
    ox, oy = boxes.overlap(F.col("x0"), F.col("x1"), F.col("x02"), F.col("x12")), boxes.overlap(F.col("y0"), F.col("y1"), F.col("y02"), F.col("y12"))
    on = (F.col(group) == F.col(f"{group}2")) & (F.col(rid) < F.col(f"{rid}2")) & (F.col(owner) != F.col(f"{owner}2")) & (ox > eps) & (oy > eps)
    if cell:
        df, b = df.withColumn("_c", _grid("", cell)), b.withColumn("_c2", _grid("2", cell))
        on = on & (F.col("_c") == F.col("_c2")) & (F.col("_c") == _first_cell(cell))
    return df.join(b, on).select(group, rid, f"{rid}2", owner, f"{owner}2", (ox * oy).alias("area"))


def point_in_rect_nearest(points: DataFrame, rects: DataFrame, group: str, point: str, rid: str, max_d: float, gap_bias: float = 0.6, height: float | None = None) -> DataFrame:
    """The rect a point (x, y) lies in; else on the line (equal y0) vertically nearest: in a gap between neighbours the first
    ``gap_bias`` share goes to the preceding one, else the nearest end; null beyond ``max_d``.

    With ``height``, for large groups, a point meets only rects within ``max_d`` above or below it, in buckets of that height: if the
    nearest line is further off, nothing is hit.
    """
    w = by(group, "y0").orderBy("x0", rid)
    r = rects.withColumns({"_prev": F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1)), "_next": F.lead("x0").over(w)})
    left = F.when(F.col("_prev").isNotNull() & (F.col("_prev") < F.col("x0")), F.col("_prev") + gap_bias * (F.col("x0") - F.col("_prev"))).otherwise(F.lit(float("-inf")))
    right = F.when(F.col("_next").isNotNull() & (F.col("_next") > F.col("x1")), F.col("x1") + gap_bias * (F.col("_next") - F.col("x1"))).otherwise(F.lit(float("inf")))
    r = suffixed(r.withColumns({"_l": left, "_r": right}))
    on = F.col(group) == F.col(f"{group}2")
    dx, dy = F.greatest(F.col("x02") - F.col("x"), F.col("x") - F.col("x12"), F.lit(0.0)), F.greatest(F.col("y02") - F.col("y"), F.col("y") - F.col("y12"), F.lit(0.0))
    if height:
        reach = F.sequence(F.floor((F.col("y02") - max_d) / height), F.floor((F.col("y12") + max_d) / height))
        points, r = points.withColumn("_c", F.floor(F.col("y") / height)), r.withColumn("_c2", F.explode(reach))
        on = on & (F.col("_c") == F.col("_c2")) & (dy <= max_d + 1e-9)
    p = points.join(r, on, "left")
    mine = (F.col("x") > F.col("_l2")) & (F.col("x") <= F.col("_r2"))
    rank = F.row_number().over(by(group, point).orderBy(F.round(dy, 9), F.when((dx == 0) | mine, 0).otherwise(1), F.round(dx, 9), f"{rid}2"))
    d = F.sqrt(dx * dx + dy * dy)
    return p.withColumns({"_rank": rank, "_d": d}).where("_rank = 1").select(group, point, F.when(F.col("_d") <= max_d, F.col(f"{rid}2")).alias("hit"), F.when(F.col("_d") <= max_d, F.col("_d")).alias("distance"))


def best_iou(a: DataFrame, b: DataFrame, group: str, rid: str, value: str, floor: float = 0.35, nothing: str = "(nothing there)", cell: float | None = None) -> DataFrame:
    """For each row of a the value of the box of b with the highest IoU above ``floor``; ties to the smaller id; ``cell`` adds J14's grid for large groups."""
    u = F.round(boxes.iou(box(), box("2")), 9)
    on = (F.col(group) == F.col(f"{group}2")) & (F.col("x0") < F.col("x12")) & (F.col("x1") > F.col("x02"))
    left, right = a, suffixed(b)
    if cell:
        left, right = left.withColumn("_c", _grid("", cell)), right.withColumn("_c2", _grid("2", cell))
        on = on & (F.col("_c") == F.col("_c2")) & (F.col("_c") == _first_cell(cell))
    # A row of a in several cells may meet nothing in some of them: what it meets anywhere counts.
    j = left.join(right, on, "left").withColumn("_u", u)
    best = F.max_by(F.struct(F.col(f"{value}2").alias("v"), F.col("_u").alias("u")), F.when(F.col("_u") > floor, F.struct(F.col("_u"), -F.col(f"{rid}2"))))
    return j.groupBy(group, rid).agg(best.alias("_b")).select(group, rid, F.coalesce(F.col("_b.v").cast("string"), F.lit(nothing)).alias("match"), F.col("_b.u").alias("iou"))


def grid_match_1to1(a: DataFrame, b: DataFrame, group: str, rid: str, tol: float, size_tol: float, rounds: int | None = None, sizes: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One-to-one matches of centres within ``tol`` on both axes and sizes within ``size_tol``: mutual nearest, smaller ids
    on ties, repeated until no new pair, or ``rounds`` times.  (A greedy pass in input order would depend on that order.)
    Centres of large groups meet in cells of ``tol``; ``sizes``: rows whose groups have no fewer rows than a side's and are cheaper to count;
    ``keep``: columns of b that come with a match, with a 2 behind their names."""
    kept = [f"{c}2" for c in keep]

    def points(d: DataFrame, s: str) -> DataFrame:
        cx, cy, size = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
        return d.select(F.col(group).alias(f"_g{s}"), F.col(rid).alias(f"_i{s}"), cx.alias(f"_x{s}"), cy.alias(f"_y{s}"), size.alias(f"_s{s}"), *[F.col(c).alias(f"{c}2") for c in keep if s == "b"])

    def candidates(pa: DataFrame, pb: DataFrame, cells: bool = False) -> DataFrame:
        near = F.lit(True)
        if cells:
            around = F.explode(F.flatten(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda i: F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda j: F.struct(F.floor(F.col("_xa") / tol) + i, F.floor(F.col("_ya") / tol) + j)))))
            pa, pb = pa.withColumn("_ca", around), pb.withColumn("_cb", F.struct(F.floor(F.col("_xb") / tol), F.floor(F.col("_yb") / tol)))
            near = F.col("_ca") == F.col("_cb")
        far = F.greatest(F.abs(F.col("_xa") - F.col("_xb")), F.abs(F.col("_ya") - F.col("_yb")))
        met = pa.join(pb, (F.col("_ga") == F.col("_gb")) & near & (far <= tol) & (F.abs(F.col("_sa") - F.col("_sb")) <= size_tol))
        return met.select(F.col("_ga").alias("g"), F.col("_ia").alias("a"), F.col("_ib").alias("b"), F.round(far, 9).alias("d"), *kept)

    pa, pb = points(a, "a"), points(b, "b")
    large = large_groups(group, *([a, b] if sizes is None else [sizes]))
    if large is None:
        cand = candidates(pa, pb, False)
    else:
        (la, sa), (lb, sb) = ([of_groups(d, f"_g{s}", large, yes) for yes in (True, False)] for d, s in ((pa, "a"), (pb, "b")))
        # Without a place on an axis the other one counts: such rows are in no cell.
        there = lambda s: F.col(f"_x{s}").isNotNull() & F.col(f"_y{s}").isNotNull()
        cand = candidates(la.where(there("a")), lb.where(there("b")), True).unionByName(candidates(sa, sb))
        cand = cand.unionByName(candidates(la.where(~there("a")), lb)).unionByName(candidates(la.where(there("a")), lb.where(~there("b"))))
    cand = stored(cand, "match-candidates")
    found = None
    while rounds is None or rounds > 0:  # a round that finds no pair ends it, and any other leaves fewer candidates
        rounds = rounds and rounds - 1
        ra, rb = F.row_number().over(by("g", "a").orderBy("d", "b")), F.row_number().over(by("g", "b").orderBy("d", "a"))
        new = stored(cand.withColumns({"_ra": ra, "_rb": rb}).where("_ra = 1 and _rb = 1").select("g", "a", "b", "d", *kept), "match-round")
        if not new.head(1):
            break
        found = new if found is None else found.unionByName(new)
        cand = stored(cand.join(new.select("g", "a"), ["g", "a"], "left_anti").join(new.select("g", "b"), ["g", "b"], "left_anti"), "match-candidates")
    found = cand.limit(0) if found is None else found
    return found.select(F.col("g").alias(group), F.col("a").alias(rid), F.col("b").alias(f"{rid}2"), F.col("d").alias("distance"), *kept)


def pair_counterparts(rows: DataFrame, delta: str, group: str, family: str, rid: str, line: str, pos: str, most_gap: float = 3.0) -> DataFrame:
    """``(group, family, rid, other, role, rank, distance)``: each surplus row (delta > 0) takes the best deficit of its family and group,
    and both get a link.

    Ranks: 0 the same line and next in order, 1 the next line and next in order, 2 the next line with an x-overlap above -``most_gap``, 3 the
    same line.  Of equal ranks the smaller distance in order (``pos``) wins, then the smaller ``pos``, then the smaller id.  Rows meet
    on a line and its neighbours, never across a group; without a line there is no counterpart, without x no rank 2.
    """
    s = rows.where(F.col(delta) > 0).withColumn("_l", F.explode(F.array(*[F.col(line) + k for k in (-1, 0, 1)])))
    d = suffixed(rows.where(F.col(delta) < 0))
    apart = F.abs(F.col(pos) - F.col(f"{pos}2"))
    ov = boxes.overlap(F.col("x0"), F.col("x1"), F.col("x02"), F.col("x12"))
    own = F.col("_l") == F.col(line)
    spans = F.col("x0").isNotNull() & F.col("x1").isNotNull() & F.col("x02").isNotNull() & F.col("x12").isNotNull()
    rank = F.when(own & (apart == 1), 0).when(~own & (apart == 1), 1).when(~own & spans & (ov > -most_gap), 2).when(own, 3)
    same = (F.col(group) == F.col(f"{group}2")) & (F.col(family) == F.col(f"{family}2")) & (F.col("_l") == F.col(f"{line}2"))
    j = s.join(d, same & (F.col(rid) != F.col(f"{rid}2"))).withColumns({"_rank": rank, "_apart": apart}).where("_rank is not null")
    best = F.min(F.struct(F.col("_rank").alias("rank"), F.col("_apart").alias("distance"), F.col(f"{pos}2").alias("p"), F.col(f"{rid}2").alias("other")))
    links = j.groupBy(group, family, F.col(rid).alias("rid")).agg(best.alias("_b"))
    links = links.select(group, family, "rid", "_b.other", F.lit("surplus").alias("role"), "_b.rank", "_b.distance")
    back = links.select(group, family, F.col("other").alias("rid"), F.col("rid").alias("other"), F.lit("deficit").alias("role"), "rank", "distance")
    return links.unionByName(back)


#: Least p of a clean row with a counterpart (fixed value).
PAIRED = 0.25


def promote_counterparts(scores: DataFrame, links: DataFrame, keys: list[str], family: str, p: str = "p", tier: str = "tier", human: str | None = None) -> DataFrame:
    """``scores`` with ``pairs``, the families in which a row has a counterpart; clean rows that have one go to review, at p 0.25 at least,
    unless ``human`` says no-issue.  Other rows keep tier and p; ``pairs`` is empty where there is none."""
    mine = links.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.array_sort(F.collect_set(family)).alias("pairs"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    settled = F.coalesce(F.col(human) == "no-issue", F.lit(False)) if human else F.lit(False)
    up = F.col("pairs").isNotNull() & (F.col(tier) == "clean") & ~settled
    out = [F.when(up, F.greatest(F.col(p), F.lit(PAIRED))).otherwise(F.col(p)).alias(p) if c == p else F.when(up, "review").otherwise(F.col(tier)).alias(tier) if c == tier else F.col(c) for c in scores.columns]
    return scores.join(mine, on, "left").select(*out, F.coalesce("pairs", F.array().cast("array<string>")).alias("pairs"))


def nearest_other_line(items: DataFrame, holders: DataFrame, group: str, rid: str, line: str, max_gap: float = 8.0, lead: float = 3.0, own_min: float = 6.0) -> DataFrame:
    """Holders on the lines next to an item within ``max_gap`` in x; the least distance + x-gap wins; flagged if d + ``lead`` < own
    and own > ``own_min``, own being the distance to the nearest other box of its own line (an item is no part of its holder)."""
    h = suffixed(holders)
    xg, yg = boxes.gap(F.col("x0"), F.col("x1"), F.col("x02"), F.col("x12")), boxes.gap(F.col("y0"), F.col("y1"), F.col("y02"), F.col("y12"))
    near = items.withColumn("_l", F.explode(F.array(F.col(line) - 1, F.col(line) + 1))).join(h, (F.col(group) == F.col(f"{group}2")) & (F.col("_l") == F.col(f"{line}2")) & (xg <= max_gap))
    best = near.groupBy(group, rid).agg(F.min(F.struct(F.round(yg + xg, 9).alias("d"), F.col(f"{rid}2").alias("other"))).alias("_b"))
    mine = items.join(h, (F.col(group) == F.col(f"{group}2")) & (F.col(line) == F.col(f"{line}2")) & (F.col(rid) != F.col(f"{rid}2"))).groupBy(group, rid).agg(F.min(F.round(xg + yg, 9)).alias("own"))
    return best.join(mine, [group, rid]).where((F.col("_b.d") + lead < F.col("own")) & (F.col("own") > own_min)).select(group, rid, F.col("_b.other").alias("other"), F.col("_b.d").alias("distance"), "own")


def union_coverage(target: DataFrame, pieces: DataFrame, group: str) -> DataFrame:
    """Share of each group's target interval (lo, hi) that the union of its pieces (x0, x1) covers, merged before they are summed."""
    p = pieces.join(target, group).select(group, "lo", "hi", F.greatest("x0", "lo").alias("a"), F.least("x1", "hi").alias("b")).where("a < b")
    w = by(group).orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.col("b") - F.greatest(F.col("a"), F.coalesce(reach, F.col("a"))), F.lit(0.0))
    got = p.withColumn("_p", part).groupBy(group).agg(F.sum("_p").alias("_s"))
    return target.join(got, group, "left").select(group, F.when(F.col("hi") > F.col("lo"), F.coalesce("_s", F.lit(0.0)) / (F.col("hi") - F.col("lo"))).otherwise(0.0).alias("coverage"))


def union_coverage_2d(target: DataFrame, pieces: DataFrame, group: str) -> DataFrame:
    """J20 for boxes: the share of each group's target box that the union of its pieces covers.

    The plane of a group is cut into slabs at its pieces' left and right edges.  A piece lies in the slabs between the ranks of its own
    two edges, which need no join; in each slab the union of intervals is swept once.  So the work is that of pieces times the slabs they
    cross, and a large group is dealt out by slab.
    """
    t = target.select(group, *[F.col(c).alias(f"t{c}") for c in ("x0", "x1", "y0", "y1")])
    p = pieces.join(t, group).select(
        group, F.greatest("x0", "tx0").alias("x0"), F.least("x1", "tx1").alias("x1"), F.greatest("y0", "ty0").alias("y0"), F.least("y1", "ty1").alias("y1")
    ).where("x0 < x1 and y0 < y1").distinct()
    edge = F.explode(F.array(*[F.struct(F.col(c).alias("at"), "x0", "x1", "y0", "y1") for c in ("x0", "x1")]))
    edges = p.select(group, edge.alias("e")).withColumn("_r", F.dense_rank().over(by(group).orderBy("e.at")))
    ranked = edges.groupBy(group, "e.x0", "e.x1", "e.y0", "e.y1").agg(F.min("_r").alias("_from"), F.max("_r").alias("_to"))
    slabs = edges.groupBy(group, "_r").agg(F.first("e.at").alias("_at"))
    slabs = slabs.withColumn("_wide", F.lead("_at").over(by(group).orderBy("_r")) - F.col("_at")).where("_wide is not null").select(group, F.col("_r").alias("_slab"), "_wide")
    lying = ranked.select(group, "y0", "y1", F.explode(F.sequence("_from", F.col("_to") - 1)).alias("_slab"))
    w = by(group, "_slab").orderBy("y0", "y1")
    reach = F.max("y1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.col("y1") - F.greatest(F.col("y0"), F.coalesce(reach, F.col("y0"))), F.lit(0.0))
    tall = lying.withColumn("_p", part).groupBy(group, "_slab").agg(F.sum("_p").alias("_tall"))
    s = tall.join(slabs, [group, "_slab"]).groupBy(group).agg(F.sum(F.col("_tall") * F.col("_wide")).alias("_s"))
    whole = F.expr("(tx1 - tx0) * (ty1 - ty0)")
    return t.join(s, group, "left").select(group, F.when(whole > 0, F.coalesce("_s", F.lit(0.0)) / whole).otherwise(0.0).alias("coverage"))


def dictionary_match(tokens: DataFrame, terms: DataFrame, key: str, identifier: str, longest: int = 4) -> DataFrame:
    """Split identifiers into parts, match n-grams of at most ``longest`` parts (a plural s allowed) against ``terms (term, rule)``;
    longer matches win their span, then earlier ones.  ``(key, start, size, term, rule)``."""
    parts = tokens.select(key, split_identifier(F.col(identifier)).alias("_p")).where(F.size("_p") > 0)
    forms = sent(terms.select("term", "rule", F.explode(F.array("term", F.concat("term", F.lit("s")))).alias("_form")))
    spans = lambda size: F.transform(
        F.sequence(F.lit(0), F.size("_p") - size), lambda i: F.struct(i.alias("start"), F.lit(size).alias("size"), F.array_join(F.slice("_p", i + 1, size), " ").alias("gram"))
    )
    none = F.array().cast("array<struct<start:int,size:int,gram:string>>")
    grams = parts.select(key, F.explode(F.concat(*[F.when(F.size("_p") >= size, spans(size)).otherwise(none) for size in range(1, longest + 1)])).alias("g"))
    # All hits are found once; which of them count is settled among them alone.
    every = stored(grams.join(forms, F.col("g.gram") == F.col("_form")).select(key, "g.start", "g.size", "term", "rule"), "dictionary")
    found = None
    for size in range(longest, 0, -1):
        hit = every.where(F.col("size") == size)
        if found is not None:
            taken = found.groupBy(F.col(key).alias("_key")).agg(F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("size") - 1))).alias("_taken"))
            clear = F.col("_taken").isNull() | ~F.exists("_taken", lambda x: (x >= F.col("start")) & (x < F.col("start") + size))
            hit = hit.join(taken, F.col(key) == F.col("_key"), "left").where(clear).select(*every.columns)
        # Of overlapping hits of one size the earlier wins.
        w = by(key).orderBy("start", "term")
        hit = hit.withColumn("_r", F.row_number().over(by(key, "start").orderBy("term"))).where("_r = 1").drop("_r")
        if size > 1:
            hit = hit.withColumn("_gap", F.col("start") - F.coalesce(F.lag("start").over(w), F.lit(-size))).where(F.col("_gap") >= size).drop("_gap")
        found = hit if found is None else found.unionByName(hit)
    return found


#: Severity by rule, the rules that prose may break, and what marks a line to be left out (fixed values).
SEVERITIES = {
    "deprecated": "error", "spelling": "error", "arabic_plural": "error", "member": "error", "display_in_code": "warning", "gloss": "warning", "generic": "warning",
}
SOFT_IN_PROSE = ("display_in_code", "gloss", "generic")
GLOSSES = ("gloss", "generic")
IGNORE_LINE = r"(?i)terminology:\s*ignore"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_.\-]*"


def scoped_findings(lines: DataFrame, terms: DataFrame, path: str, number: str, line: str, prose: str, gloss_allowed: str | None = None, external: str | None = None) -> DataFrame:
    """J21 over lines of files: ``(path, number, identifier, term, rule, severity, n)``, a row for each identifier of a line and term in it.

    Lines that carry the ignore mark are left out; names that match the pattern ``external`` are blanked.  In files of ``prose`` display
    names, glosses and generic words are no findings, and where ``gloss_allowed`` holds glosses and generic words aren't; canonical terms
    never are.  Rules without a severity are warnings.  Each different identifier is matched once, wherever it stands.
    """
    allowed = F.coalesce(F.col(gloss_allowed), F.lit(False)) if gloss_allowed else F.lit(False)
    text = F.regexp_replace(line, external, " ") if external else F.col(line)
    live = lines.where(F.col(line).isNotNull() & ~F.col(line).rlike(IGNORE_LINE))
    found = live.select(path, number, F.coalesce(F.col(prose), F.lit(False)).alias("_prose"), allowed.alias("_allowed"), F.explode(F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0))).alias("identifier"))
    known = found.select(F.col("identifier").alias("_id")).distinct()
    hits = dictionary_match(known, terms, "_id", "_id").groupBy("_id", "term", "rule").agg(F.count(F.lit(1)).alias("_k"))
    # Names that hold a term, stored, so that their size is known; only what meets them is counted, before any shuffle where they are few.
    j = found.join(stored(hits.where("rule <> 'canonical'"), "hits"), F.col("identifier") == F.col("_id"))
    j = j.where(~(F.col("_prose") & F.col("rule").isin(*SOFT_IN_PROSE)) & ~(F.col("_allowed") & F.col("rule").isin(*GLOSSES)))
    j = j.groupBy(path, number, "identifier", "_prose", "_allowed", "term", "rule", "_k").agg(F.count(F.lit(1)).alias("_n"))
    severity = F.coalesce(F.create_map(*[F.lit(x) for kv in SEVERITIES.items() for x in kv])[F.col("rule")], F.lit("warning"))
    return j.select(path, number, "identifier", "term", "rule", severity.alias("severity"), (F.col("_n") * F.col("_k")).alias("n"))


def segment_to_interval_guard(items: DataFrame, times: DataFrame, group: str, order: str) -> DataFrame:
    """Join the i-th item of a group to its i-th time only where the counts agree; else one row for the whole group, ``guarded``."""
    def numbered(d: DataFrame) -> DataFrame:
        return d.withColumns({"_i": F.row_number().over(by(group).orderBy(order)), "_n": F.count(F.lit(1)).over(by(group))})

    a, b = numbered(items), suffixed(numbered(times))
    ok = a.join(b, (F.col(group) == F.col(f"{group}2")) & (F.col("_i") == F.col("_i2")) & (F.col("_n") == F.col("_n2")))
    ok = ok.select(group, F.col("_i").alias("rank"), F.col(order).alias("item"), F.col(f"{order}2").alias("time"), F.lit("paired").alias("status"))
    na, nb = items.groupBy(group).agg(F.count(F.lit(1)).alias("na")), times.groupBy(group).agg(F.count(F.lit(1)).alias("nb"))
    off = na.join(nb, group, "left").where(~F.col("na").eqNullSafe(F.col("nb")))
    none = F.lit(None)
    return ok.unionByName(off.select(group, F.lit(0).alias("rank"), none.cast(items.schema[order].dataType).alias("item"), none.cast(times.schema[order].dataType).alias("time"), F.lit("guarded").alias("status")))


def transfer_partition(pieces: DataFrame, matches: DataFrame, group: str, element: str, rid: str, partner: str) -> DataFrame:
    """The matched pieces of an element vote for their partner's group: mapped if unanimous, split if mixed, unpaired if none."""
    m = matches.select(F.col(group).alias("_g"), F.col(rid).alias("_i"), F.col(partner).alias("_v"))
    j = pieces.join(m, (F.col(group) == F.col("_g")) & (F.col(rid) == F.col("_i")), "left")
    g = j.groupBy(group, element).agg(F.count_distinct("_v").alias("_k"), F.count("_v").alias("votes"), F.min("_v").alias("_to"))
    return g.select(group, element, "votes", F.when(F.col("_k") == 1, F.col("_to")).alias("target"), F.when(F.col("_k") == 0, "unpaired").when(F.col("_k") == 1, "mapped").otherwise("split").alias("status"))


def correct_from_reference(df: DataFrame, best: DataFrame, convicted: DataFrame, need: DataFrame, key: list[str], name: str) -> DataFrame:
    """For convicted rows only: relabel to the partner's ``match`` if there is one, it differs and the row's group still needs
    that name (``need (name, spare)``); each row gets an outcome: relabelled, no-partner, same-name, no-need."""
    j = df.join(convicted.select(*key), key, "left_semi").join(best.select(*key, "match"), key, "left")
    j = j.join(need.select(F.col(name).alias("match"), "spare"), "match", "left")
    out = F.when(F.col("match").isNull() | (F.col("match") == "(nothing there)"), "no-partner").when(F.col("match") == F.col(name), "same-name").when(F.coalesce("spare", F.lit(0)) <= 0, "no-need").otherwise("relabelled")
    return j.withColumn("outcome", out).select(*key, name, F.when(F.col("outcome") == "relabelled", F.col("match")).otherwise(F.col(name)).alias("new_name"), "outcome")


def alias_coalesce(df: DataFrame, names: list[str], out: str) -> DataFrame:
    """One logical column published under several names: the first that is present and not null.  None present: ValueError."""
    there = [n for n in names if n in df.columns]
    if not there:
        raise ValueError(f"none of {names} is a column")
    return df.withColumn(out, F.coalesce(*there))
