"""Windows: order breaks, running maxima, islands, bands, shares and gap windows.  Every window is partitioned by a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import boxes

from .aggregates import median_hi, modal
from .common import by, cols
from .joins import assign_band, suffixed

BEFORE = (Window.unboundedPreceding, -1)


def order_breaks(df: DataFrame, group: str, seq: list[str], pos: str, tol: float = 1.0, y_gap: float = 2.0) -> DataFrame:
    """Rows that start more than ``tol`` left of where their predecessor in ``seq`` starts, unless their y-bands are ``y_gap`` apart."""
    w = by(group).orderBy(*seq)
    apart = boxes.gap(F.col("y0"), F.col("y1"), F.lag("y0").over(w), F.lag("y1").over(w)) >= y_gap
    broken = (F.col(pos) + tol < F.lag(pos).over(w)) & ~apart
    return df.withColumn("_b", F.coalesce(broken, F.lit(False))).where("_b").drop("_b")


def monotone_source(df: DataFrame, group: str, line: str, key: str) -> DataFrame:
    """``(group, ok)``: the first key of each line must not fall from line to line."""
    first = df.groupBy(group, line).agg(F.min(key).alias("_k"))
    ok = F.coalesce(F.col("_k") >= F.lag("_k").over(by(group).orderBy(line)), F.lit(True))
    return first.withColumn("_ok", ok).groupBy(group).agg(F.bool_and("_ok").alias("ok"))


def id_sequence(df: DataFrame, group: str, order: str, ident: str) -> DataFrame:
    """Rows whose id is neither the running maximum before them nor one more."""
    prev = F.max(ident).over(by(group).orderBy(order).rowsBetween(*BEFORE))
    return df.withColumn("prev_max", prev).where(F.col("prev_max").isNotNull() & (F.col(ident) != F.col("prev_max")) & (F.col(ident) != F.col("prev_max") + 1))


def propose_and_confirm(items: DataFrame, bands: DataFrame, group: str, rid: str, line: str, pos: str) -> DataFrame:
    """Geometry proposes a band for each item; per group with a move, ``misplaced`` if no order break is left after the moves, else ``review``."""
    placed = assign_band(items, bands, group, [rid], line)

    def breaks(d: DataFrame, at: str, name: str) -> DataFrame:
        broken = F.coalesce(F.col(pos) < F.lag(pos).over(by(group, at).orderBy(rid)), F.lit(False))
        return d.withColumn("_x", broken).groupBy(group).agg(F.count_if("_x").alias(name))

    moved = placed.groupBy(group).agg(F.count_if(F.col("band") != F.col(line)).alias("moves"))
    out = moved.join(breaks(placed, line, "before"), group).join(breaks(placed, "band", "after"), group).where("moves > 0")
    return out.withColumn("status", F.when(F.col("after") == 0, "misplaced").otherwise("review"))


def islands(df: DataFrame, group: str | list[str], lo: str, hi: str, slack: float = 0.0) -> DataFrame:
    """Intervals merged where one begins at or before the running end plus ``slack``: ``(group, island, lo, hi, n)``."""
    g = cols(group)
    w = by(*g).orderBy(lo, hi)
    reach = F.max(hi).over(w.rowsBetween(*BEFORE))
    new = F.when(reach.isNull() | (F.col(lo) > reach + slack), 1).otherwise(0)
    run = df.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*g, "island").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.count(F.lit(1)).alias("n"))


def jump_clusters(df: DataFrame, group: str, value: str, jump: float) -> DataFrame:
    """Numbers clusters of a group's sorted values; a new one begins where the value jumps by more than ``jump``."""
    w = by(group).orderBy(value)
    new = F.when(F.col(value) - F.lag(value).over(w) > jump, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0))).drop("_new")


def dominant_cluster(df: DataFrame, group: str, rid: str, gap: float = 6.0) -> DataFrame:
    """Clusters of y-intervals with gaps above ``gap``; the one with the largest area stays; items of the others are ``stray``, or
    ``flag`` if their x-interval lies within the dominant cluster's."""
    w = by(group).orderBy("y0", "y1", rid)
    reach = F.max("y1").over(w.rowsBetween(*BEFORE))
    run = df.withColumn("_new", F.when(F.col("y0") > reach + gap, 1).otherwise(0)).withColumn("_c", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = run.groupBy(group, "_c").agg(F.round(F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))), 6).alias("_a"), F.min("x0").alias("_x0"), F.max("x1").alias("_x1"))
    best = sizes.groupBy(F.col(group).alias("_g")).agg(F.max_by(F.struct("_c", "_x0", "_x1"), F.struct("_a", -F.col("_c"))).alias("_b"))
    j = run.join(best, F.col(group) == F.col("_g"))
    inside = (F.col("x0") >= F.col("_b._x0")) & (F.col("x1") <= F.col("_b._x1"))
    return j.select(group, rid, F.when(F.col("_c") == F.col("_b._c"), "kept").when(inside, "flag").otherwise("stray").alias("status"))


def largest_hole(df: DataFrame, group: str, lo: str, hi: str, limit: float) -> DataFrame:
    """The widest uncovered gap along a group's sorted intervals, and whether it exceeds ``limit``."""
    reach = F.max(hi).over(by(group).orderBy(lo, hi).rowsBetween(*BEFORE))
    return df.withColumn("_h", F.greatest(F.col(lo) - reach, F.lit(0.0))).groupBy(group).agg(F.coalesce(F.max("_h"), F.lit(0.0)).alias("hole")).withColumn("flagged", F.col("hole") > limit)


def group_order_law(df: DataFrame, page: str, group: str, edge: str, slack: float = 8.0) -> DataFrame:
    """Consecutive groups whose right edge rises by more than ``slack``."""
    g = df.groupBy(page, group).agg(F.max(edge).alias("edge"))
    return g.withColumn("prev", F.lag("edge").over(by(page).orderBy(group))).where(F.col("edge") > F.col("prev") + slack)


def pitch_bands(df: DataFrame, group: str, line: str) -> DataFrame:
    """A line's band runs to the midpoints between its centre and its neighbours'; ends mirror the one neighbour; a single line keeps its extent."""
    g = df.groupBy(group, line).agg(F.min("y0").alias("y0"), F.max("y1").alias("y1")).withColumn("_c", (F.col("y0") + F.col("y1")) / 2)
    w = by(group).orderBy(line)
    up, down = (F.col("_c") + F.lag("_c").over(w)) / 2, (F.col("_c") + F.lead("_c").over(w)) / 2
    top = F.coalesce(up, 2 * F.col("_c") - down, F.col("y0"))
    bottom = F.coalesce(down, 2 * F.col("_c") - up, F.col("y1"))
    return g.select(group, line, F.least(top, bottom).alias("top"), F.greatest(top, bottom).alias("bottom"))


def median_pitch_limit(df: DataFrame, group: str, pos: str, height: str, min_gap: float = 20.0, high: float = 1.05, low: float = 0.28) -> DataFrame:
    """Rows whose height is above ``high`` or below ``low`` times their group's upper-median gap (of gaps above ``min_gap``)."""
    gaps = df.select(group, (F.col(pos) - F.lag(pos).over(by(group).orderBy(pos))).alias("_gap")).where(F.col("_gap") > min_gap)
    pitch = median_hi(gaps, group, "_gap").select(F.col(group).alias("_g"), F.col("median").alias("pitch"))
    return df.join(pitch, F.col(group) == F.col("_g")).drop("_g").where((F.col(height) > high * F.col("pitch")) | (F.col(height) < low * F.col("pitch")))


def proportional_share(df: DataFrame, group: str, weight: str, actual: str) -> DataFrame:
    """``expected`` = weight / sum of weights x sum of actuals, over rows with a known weight; unknown ones drop from both sums."""
    known = F.col(weight).isNotNull()
    total = F.sum(F.when(known, F.col(actual))).over(by(group))
    weights = F.sum(F.when(known, F.col(weight))).over(by(group))
    return df.withColumn("expected", F.when(known & (weights != 0), F.col(weight) / weights * total))


def share_with_fallback(df: DataFrame, group: str, weight: str, fallback: str, actual: str, low: float = 0.45, high: float = 2.2) -> DataFrame:
    """As W12, but a group with an unknown weight, or a share ratio outside [low, high], shares by ``fallback`` instead."""
    w = by(group)
    share = F.col(weight) / F.sum(weight).over(w)
    plain = F.col(fallback) / F.sum(fallback).over(w)
    d = df.withColumns({"_s": share, "_f": plain})
    bad = F.col(weight).isNull() | F.col("_s").isNull() | (F.col("_s") / F.col("_f") < low) | (F.col("_s") / F.col("_f") > high)
    d = d.withColumn("fell_back", F.bool_or(F.coalesce(bad, F.lit(True))).over(w))
    return d.withColumn("expected", F.when(F.col("fell_back"), F.col("_f")).otherwise(F.col("_s")) * F.sum(actual).over(w)).drop("_s", "_f")


def suppress_constant_offset(df: DataFrame, group: str, delta: str, least: int = 5, share: float = 0.8) -> DataFrame:
    """Drop groups whose modal delta isn't 0 and holds for at least max(least, share x rows): a numbering artefact, not an error."""
    m = modal(df, group, delta, 0)
    off = m.where((F.col("mode") != 0) & (F.col("n") >= F.greatest(F.lit(float(least)), share * F.col("total"))))
    return df.join(off.select(F.col(group).alias("_g")), F.col(group).eqNullSafe(F.col("_g")), "left_anti")


def fragment_numbers(df: DataFrame, entity: str, order: list[str]) -> DataFrame:
    """1..N per entity in reading order, and N, on every row."""
    return df.withColumns({"fragment": F.row_number().over(by(entity).orderBy(*order)), "fragments": F.count(F.lit(1)).over(by(entity))})


def density_profile(df: DataFrame, group: str, lo: str, hi: str, step: float) -> DataFrame:
    """Number of intervals over each bin of width ``step`` that an interval begins or ends in, from a difference array, and the mass before it."""
    edge = F.explode(F.array(F.struct(F.floor(F.col(lo) / step).alias("bin"), F.lit(1).alias("d")), F.struct((F.floor(F.col(hi) / step) + 1).alias("bin"), F.lit(-1).alias("d"))))
    d = df.select(group, edge.alias("e")).groupBy(group, "e.bin").agg(F.sum("e.d").alias("_d"))
    w = by(group).orderBy("bin")
    prof = d.withColumn("weight", F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    area = F.lag("weight").over(w) * (F.col("bin") - F.lag("bin").over(w))
    return prof.withColumn("_a", F.coalesce(area, F.lit(0))).withColumn("mass_before", F.sum("_a").over(w.rowsBetween(Window.unboundedPreceding, 0))).select(group, "bin", "weight", "mass_before")


def blank_runs(profile: DataFrame, group: str) -> DataFrame:
    """Maximal runs of bins without mass between others: ``(group, from_bin, to_bin, length, widest)``."""
    w = by(group).orderBy("bin")
    runs = profile.withColumn("_next", F.lead("bin").over(w)).where("weight = 0 and _next is not null").select(group, F.col("bin").alias("from_bin"), (F.col("_next") - 1).alias("to_bin"))
    runs = runs.withColumn("length", F.col("to_bin") - F.col("from_bin") + 1)
    return runs.withColumn("widest", F.row_number().over(by(group).orderBy(F.col("length").desc(), "from_bin")) == 1)


def latest_by_key(log: DataFrame, key: str | list[str], order: list[str], values: list[str]) -> DataFrame:
    """The values of each key's last record; ties in time go to the later in ``order``."""
    k = cols(key)
    return log.groupBy(*k).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*k, "_v.*")


def fold_partial(log: DataFrame, key: str, order: list[str], fields: list[str], label: str = "label", sentinel: str = "reviewed-ok") -> DataFrame:
    """Per key and field the last non-null value; the sentinel sets ``reviewed`` and is never a label."""
    o = F.struct(*order)
    value = lambda f: F.when(F.col(f) != sentinel, F.col(f)) if f == label else F.col(f)
    aggs = [F.max_by(value(f), F.when(value(f).isNotNull(), o)).alias(f) for f in fields]
    return log.groupBy(key).agg(*aggs, F.coalesce(F.bool_or(F.col(label) == sentinel), F.lit(False)).alias("reviewed"))


def gap_to_owner(items: DataFrame, parts: DataFrame, group: str, rid: str, owner: str) -> DataFrame:
    """Least distance of an item to the other parts of its owner (0 if they overlap), and how far its centre lies outside their band."""
    p = suffixed(parts)
    j = items.join(p, (F.col(group) == F.col(f"{group}2")) & (F.col(owner) == F.col(f"{owner}2")) & (F.col(rid) != F.col(f"{rid}2")))
    c = (F.col("y0") + F.col("y1")) / 2
    d = boxes.gap2((F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1")), (F.col("x02"), F.col("x12"), F.col("y02"), F.col("y12")))
    g = j.groupBy(group, rid, c.alias("_c")).agg(F.min(d).alias("distance"), F.min("y02").alias("_lo"), F.max("y12").alias("_hi"))
    return g.select(group, rid, "distance", F.greatest(F.col("_lo") - F.col("_c"), F.col("_c") - F.col("_hi"), F.lit(0.0)).alias("outside"))


def merge_equal_spans(df: DataFrame, group: str, rid: str, eps: float = 0.01) -> DataFrame:
    """Consecutive rows that abut in y (within ``eps``) and share both x-edges become one."""
    w = by(group).orderBy("y0", "y1", rid)
    same = (F.abs(F.col("y0") - F.lag("y1").over(w)) <= eps) & (F.col("x0") == F.lag("x0").over(w)) & (F.col("x1") == F.lag("x1").over(w))
    run = df.withColumn("_n", F.when(same, 0).otherwise(1)).withColumn("_i", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(group, "_i").agg(*[f(c).alias(c) for c, f in (("x0", F.min), ("x1", F.max), ("y0", F.min), ("y1", F.max))], F.count(F.lit(1)).alias("merged")).drop("_i")


def repair_sequence(df: DataFrame, group: str, order: str, number: str) -> DataFrame:
    """A null running number becomes the next valid one less the distance, else the previous plus the distance: ``repaired``."""
    w = by(group).orderBy(order)
    d = df.withColumn("_i", F.row_number().over(w))
    at = F.when(F.col(number).isNotNull(), F.struct(F.col(number).alias("v"), F.col("_i").alias("i")))
    nxt, prv = F.first(at, True).over(w.rowsBetween(1, Window.unboundedFollowing)), F.last(at, True).over(w.rowsBetween(*BEFORE))
    d = d.withColumns({"_nx": nxt, "_pv": prv})
    value = F.coalesce(F.col(number), F.col("_nx.v") - (F.col("_nx.i") - F.col("_i")), F.col("_pv.v") + (F.col("_i") - F.col("_pv.i")))
    return d.withColumn("repaired", value).drop("_i", "_nx", "_pv")


def continuation_row(df: DataFrame, partition: str, order: str, key: str) -> DataFrame:
    """Partitions whose last row continues into the next: its key is the next one's first and occurs once in its own.

    Partitions are few (pages, days), so the step from one to the next is a window over one row per partition.
    """
    ends = df.groupBy(partition).agg(F.min_by(key, order).alias("_first"), F.max_by(key, order).alias("last_key"), F.max(order).alias("last_row"))
    times = df.groupBy(F.col(partition).alias("_p"), F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    nxt = ends.withColumn("_next", F.lead("_first").over(Window.orderBy(partition)))
    j = nxt.join(times, (F.col(partition) == F.col("_p")) & (F.col("last_key") == F.col("_k")))
    return j.where("last_key = _next and _n = 1").select(partition, "last_key", "last_row")


def side_order(df: DataFrame, group: str, side: str, drawn: str, want: str, item: str) -> DataFrame:
    """Per side of a group with at least two items: does the drawn order (right to left) equal the wanted one?"""
    pair = lambda c, sign: F.transform(F.array_sort(F.collect_list(F.struct((sign * F.col(c)).alias("o"), F.col(item).alias("i")))), lambda s: s["i"])
    g = df.groupBy(group, side).agg(F.count(F.lit(1)).alias("n"), pair(drawn, -1).alias("_d"), pair(want, 1).alias("_w"))
    return g.where("n >= 2").select(group, side, "n", (F.col("_d") == F.col("_w")).alias("in_order"))


def gap_window_search(slots: DataFrame, pieces: DataFrame, group: str, slot: str, filled: str, edge: float = 22.0, share: float = 0.6) -> DataFrame:
    """An empty slot's window runs between its filled neighbours, or ``edge`` beyond the last; reports the piece that lies in it by
    at least ``share`` of its width and overlaps it most."""
    w = by(group).orderBy(slot)
    lo, hi = F.last(F.when(F.col(filled), F.col("x1")), True).over(w.rowsBetween(*BEFORE)), F.first(F.when(F.col(filled), F.col("x0")), True).over(w.rowsBetween(1, Window.unboundedFollowing))
    e = slots.withColumns({"_lo": lo, "_hi": hi}).where(~F.col(filled) & (F.col("_lo").isNotNull() | F.col("_hi").isNotNull()))
    e = e.select(F.col(group).alias("_g"), F.col(slot).alias("slot"), F.coalesce("_lo", F.col("_hi") - edge).alias("_a"), F.coalesce("_hi", F.col("_lo") + edge).alias("_b"))
    ov = boxes.overlap(F.col("_a"), F.col("_b"), F.col("x0"), F.col("x1"))
    j = e.join(pieces, (F.col("_g") == F.col(group)) & (ov >= share * (F.col("x1") - F.col("x0"))) & (ov > 0)).withColumn("_ov", F.round(ov, 9))
    return j.groupBy(group, "slot").agg(F.max_by(F.struct("rid", "_ov"), F.struct(F.col("_ov"), -F.col("rid"))).alias("_b")).select(group, "slot", F.col("_b.rid").alias("piece"), F.col("_b._ov").alias("overlap"))
