"""The translation that carries one set of points into another, by consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def _numbered(points: DataFrame, group: str, x: str, y: str, number: str) -> DataFrame:
    """``g, x, y, <number>``: the different places of a group, numbered by x, then y."""
    p = points.select(F.col(group).alias("g"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna().distinct()
    return stored(p.withColumn(number, F.row_number().over(Window.partitionBy("g").orderBy("x", "y"))), "shift-points")


def _near(places: DataFrame, entries: DataFrame, tol: float) -> DataFrame:
    """``places (g, px, py, …)`` with every entry (``ex, ey, entry``) of the group nearer than ``tol`` on both axes.  Both are filed under cells a
    little wider than ``tol``, so a place looks into nine of them and never into the whole group."""
    wide = tol * (1 + 1e-9)
    cell = lambda c: F.floor(F.col(c) / wide)
    filed = entries.select(F.col("g").alias("_g"), cell("x").alias("_cx"), cell("y").alias("_cy"), F.col("x").alias("ex"), F.col("y").alias("ey"), "entry")
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    around = places.withColumn("_s", F.explode(steps)).withColumns({"_x": cell("px") + F.col("_s.i"), "_y": cell("py") + F.col("_s.j")})
    met = around.join(filed, (F.col("g") == F.col("_g")) & (F.col("_x") == F.col("_cx")) & (F.col("_y") == F.col("_cy")))
    return met.where((F.abs(F.col("ex") - F.col("px")) < tol) & (F.abs(F.col("ey") - F.col("py")) < tol)).drop("_s", "_x", "_y", "_g", "_cx", "_cy")


def _explaining(shifts: DataFrame, markers: DataFrame, entries: DataFrame, tol: float, most: int) -> DataFrame:
    """Of ``shifts (g, id, dx, dy)`` those that bring an entry within ``tol`` of every marker of their group.

    Markers are tried one, two, four … at a time, and a shift that misses one is dropped at once: few wrong ones live to see many.
    """
    live, low, size = shifts, 1, 1
    while low <= most:
        block = markers.where(F.col("marker").between(low, low + size - 1))
        tried = live.join(block, "g").withColumns({"px": F.col("x") + F.col("dx"), "py": F.col("y") + F.col("dy")})
        hit = _near(tried, entries, tol).groupBy("g", "id").agg(F.countDistinct("marker").alias("_hit"))
        need = block.groupBy("g").agg(F.count(F.lit(1)).alias("_need"))
        live = live.join(need, "g", "left").join(hit, ["g", "id"], "left").where(F.coalesce("_hit", F.lit(0)) >= F.coalesce("_need", F.lit(0)))
        live = stored(live.select("g", "id", "dx", "dy"), "shift-live")
        low, size = low + size, 2 * size
    return live


#: Pairs of markers and entries of a group, repeated places counted, up to which it is solved as one row.
SMALL = 1_024


def _places(points: DataFrame, group: str, x: str, y: str, name: str) -> DataFrame:
    p = points.select(F.col(group).alias("g"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    return p.select("g", F.struct("x", "y").alias(name))


def _split(markers: DataFrame, entries: DataFrame, group: str, x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """``(g, m, e)``, a row a group with its places in order, for groups of few pairs, and the other groups (``g``)."""
    both = _places(markers, group, x, y, "m").unionByName(_places(entries, group, x, y, "e"), allowMissingColumns=True)
    many = F.count("m") * F.count("e") > SMALL
    large = stored(both.groupBy("g").agg(many.alias("_many")).where("_many").select("g"), "shift-large")
    lists = both.join(large, "g", "left_anti") if large.head(1) else both
    return lists.groupBy("g").agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in ("m", "e")]), large


def _by(p: Column, q: Column, dx: Column, dy: Column, tol: float) -> Column:
    """Whether ``q`` lies nearer than ``tol`` to ``p`` moved by ``dx`` and ``dy``, on both axes."""
    return (F.abs(q["x"] - (p["x"] + dx)) < tol) & (F.abs(q["y"] - (p["y"] + dy)) < tol)


def consensus_shift(markers: DataFrame, entries: DataFrame, group: str, x: str, y: str, tol: float = 1.5) -> DataFrame:
    """``(group, dx, dy, markers)``: the shift, an entry's place less a marker's, under which every marker of the group has an entry nearer
    than ``tol`` on both axes.  Of several the one of the first marker, then the first entry counts (by x, then y).

    Groups in which no such shift explains every marker aren't trusted and have no row; neither have those without markers or entries.
    Points that repeat a place are one; points with a null aren't there.  A shift must bring some entry near the first marker, so
    only shifts that nearly do, within twice ``tol``, and explain all others within as much, are ever looked at closely: pairs of
    markers and entries aren't listed.  Groups of few pairs are a row each and need no join.
    """
    lists, large = _split(markers, entries, group, x, y)
    shifts = F.flatten(F.transform("m", lambda p: F.transform("e", lambda q: F.struct((q["x"] - p["x"]).alias("dx"), (q["y"] - p["y"]).alias("dy")))))
    explains = lambda s: F.forall("m", lambda p: F.exists("e", lambda q: _by(p, q, s["dx"], s["dy"], tol)))
    out = lists.select("g", F.get(F.filter(shifts, explains), 0).alias("s")).where("size(m) > 0 and s is not null").select("g", "s.dx", "s.dy")
    if large.head(1):
        held = [d.join(large.select(F.col("g").alias(group)), group, "left_semi") for d in (markers, entries)]
        out = out.unionByName(_shift_by_joins(*held, group, x, y, tol))
    total = markers.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("markers"))
    return out.join(total, "g").select(F.col("g").alias(group), "dx", "dy", "markers")


def _shift_by_joins(markers: DataFrame, entries: DataFrame, group: str, x: str, y: str, tol: float) -> DataFrame:
    """``consensus_shift`` of groups of any size, as ``(g, dx, dy)``."""
    m, e = _numbered(markers, group, x, y, "marker"), _numbered(entries, group, x, y, "entry")
    most = m.agg(F.max("marker")).first()[0] or 0
    first = m.where("marker = 1").select("g", F.col("x").alias("_x"), F.col("y").alias("_y"))
    rough = e.join(first, "g").select("g", F.col("entry").cast("long").alias("id"), (F.col("x") - F.col("_x")).alias("dx"), (F.col("y") - F.col("_y")).alias("dy"))
    rough = _explaining(rough, m, e, 2 * tol, most).drop("id")
    found, open_groups, low, size = [], stored(rough.select("g").distinct(), "shift-open"), 1, 1
    while low <= most and open_groups.head(1):
        block = m.where(F.col("marker").between(low, low + size - 1)).join(open_groups, "g", "left_semi")
        places = block.join(rough, "g").withColumns({"px": F.col("x") + F.col("dx"), "py": F.col("y") + F.col("dy")})
        exact = _near(places.drop("dx", "dy"), e, tol).select("g", "marker", "entry", (F.col("ex") - F.col("x")).alias("dx"), (F.col("ey") - F.col("y")).alias("dy")).distinct()
        exact = stored(exact.select("g", (F.col("marker") * (1 << 32) + F.col("entry")).cast("long").alias("id"), "dx", "dy"), "shift-exact")
        good = _explaining(exact, m, e, tol, most).groupBy("g").agg(F.min(F.struct("id", "dx", "dy")).alias("s"))
        found.append(stored(good.select("g", "s.dx", "s.dy"), "shift-found"))
        open_groups = stored(open_groups.join(found[-1], "g", "left_anti"), "shift-open")
        low, size = low + size, 2 * size
    out = rough.select("g", "dx", "dy").limit(0)
    for part in found:
        out = out.unionByName(part)
    return out


def recovered(markers: DataFrame, entries: DataFrame, shifts: DataFrame, group: str, x: str, y: str, apart: float = 2.0) -> DataFrame:
    """``(group, x, y)``, to three places: entries of trusted groups, carried back, that no marker lies nearer to than ``apart`` on both axes."""
    moves = shifts.select(F.col(group).alias("g"), "dx", "dy")
    lists, large = _split(markers, entries, group, x, y)
    lone = lambda p: ~F.exists("m", lambda q: (F.abs(q["x"] - p["x"]) < apart) & (F.abs(q["y"] - p["y"]) < apart))
    back = F.transform("e", lambda q: F.struct((q["x"] - F.col("dx")).alias("x"), (q["y"] - F.col("dy")).alias("y")))
    left = lists.join(moves, "g").select("g", F.explode(F.filter(back, lone)).alias("p")).select("g", F.col("p.x").alias("px"), F.col("p.y").alias("py"))
    if large.head(1):
        held = [d.join(large.select(F.col("g").alias(group)), group, "left_semi") for d in (markers, entries)]
        left = left.unionByName(_recovered_by_joins(*held, moves, group, x, y, apart))
    return left.select(F.col("g").alias(group), F.round("px", 3).alias(x), F.round("py", 3).alias(y)).distinct()


def _recovered_by_joins(markers: DataFrame, entries: DataFrame, moves: DataFrame, group: str, x: str, y: str, apart: float) -> DataFrame:
    """``recovered`` of groups of any size, as ``(g, px, py)``."""
    moved = entries.where(F.col(x).isNotNull() & F.col(y).isNotNull()).join(moves.select(F.col("g").alias(group), "dx", "dy"), group)
    moved = moved.select(F.col(group).alias("g"), (F.col(x) - F.col("dx")).alias("px"), (F.col(y) - F.col("dy")).alias("py")).distinct()
    drawn = markers.select(F.col(group).alias("g"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.lit(0).alias("entry")).dropna()
    known = _near(moved, drawn, apart).select("g", "px", "py").distinct()
    return moved.join(known, ["g", "px", "py"], "left_anti")
