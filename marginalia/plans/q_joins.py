"""Queries of the join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions.text import split_identifier
from marginalia.operators import joins as J

from .base import query
from .views import Tables

OV = "least(a.x1, b.x1) - greatest(a.x0, b.x0)"
OVY = "least(a.y1, b.y1) - greatest(a.y0, b.y0)"


def _orders(t: Tables):
    """An order's number for each of its lines: as many rows as any view of them has, without their number in the order."""
    return t.lineitem.select(F.col("l_orderkey").alias("grp"))


@query("SELECT k, amt_a, n, amt_b, CASE WHEN amt_a IS NULL THEN 'only-b' WHEN amt_b IS NULL THEN 'only-a' ELSE 'both' END AS side FROM src_a FULL JOIN src_b USING (k)", "src_a", "src_b")
def j1_reconcile(t: Tables):
    return J.reconcile(t.src_a, t.src_b, "k")


def _pair(t: Tables):
    a = t.tok.select("doc_id", "line_no", "pos", F.col("token").alias("ta"))
    b = t.tok.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "line_no", "pos", F.translate("token", ".,", "").alias("tb"))
    return a, b


@query("""SELECT doc_id, count(*) FILTER (s) AS compared, count(*) FILTER (NOT s) AS mismatched FROM (
  SELECT doc_id, replace(replace(lower(token), '.', ''), ',', '') = replace(replace(lower(token), '.', ''), ',', '') AND token NOT LIKE '%!%' AS s FROM tok WHERE doc_id IN (SELECT doc_id FROM labels)) GROUP BY 1""", "tok")
def j2_guarded_join(t: Tables):
    a, b = _pair(t)
    a = a.withColumn("sa", F.translate(F.lower("ta"), ".,", ""))
    b = b.withColumn("sb", F.translate(F.lower("tb"), "!", ""))
    g = J.guarded_join(a, b, ["doc_id", "line_no", "pos"], "sa", "sb")
    return g.groupBy("doc_id").agg(F.count_if(F.col("status") == "compared").alias("compared"), F.count_if(F.col("status") != "compared").alias("mismatched"))


@query("""SELECT l_orderkey, l_partkey, coalesce(a.p_brand, b.p_type) AS value, CASE WHEN a.p_brand IS NOT NULL THEN 'brand' WHEN b.p_type IS NOT NULL THEN 'type' ELSE 'miss' END AS source
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 20) a ON l_partkey = a.p_partkey LEFT JOIN (SELECT * FROM part WHERE p_size < 35) b ON l_partkey = b.p_partkey""")
def j3_lookup_with_fallback(t: Tables):
    return J.lookup_with_fallback(t.lineitem.select("l_orderkey", "l_partkey"), "l_partkey", [("brand", t.part.where("p_size < 20"), "p_partkey", "p_brand"), ("type", t.part.where("p_size < 35"), "p_partkey", "p_type")])


@query("""WITH b AS (SELECT user_id AS key, event_id // 1000 AS p, max(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1, 2), a AS (SELECT event_id, user_id AS key, event_id // 1000 AS p FROM events WHERE event_type = 'view')
SELECT event_id, a.key, a.p, arg_max(v, b.p) AS found FROM a LEFT JOIN b ON a.key = b.key AND b.p BETWEEN a.p - 1 AND a.p + 1 GROUP BY 1, 2, 3""")
def j4_neighbour_partition_join(t: Tables):
    e = t.events.select("event_id", F.col("user_id").alias("key"), F.floor(F.col("event_id") / 1000).alias("p"), "value", "event_type")
    b = e.where("event_type = 'click'").groupBy("key", "p").agg(F.max("value").alias("v"))
    return J.neighbour_partition_join(e.where("event_type = 'view'").select("event_id", "key", "p"), b, "p", "key", "v")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)")
def j5_anti_dirty(t: Tables):
    dirty = [t.orders.where("o_orderstatus = 'F'").select("o_orderkey"), t.lineitem.where("l_discount > 0.08").select("l_orderkey")]
    return J.anti_dirty(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey", dirty)


@query("SELECT c_custkey, o_orderkey AS expanded FROM customer JOIN orders ON o_orderkey BETWEEN c_custkey * 3 AND c_custkey * 3 + c_nationkey WHERE o_orderstatus = 'O'")
def j6_range_expand(t: Tables):
    r = t.customer.select("c_custkey", (F.col("c_custkey") * 3).alias("lo"), (F.col("c_custkey") * 3 + F.col("c_nationkey")).alias("hi"))
    return J.range_expand(r, "lo", "hi", t.orders.where("o_orderstatus = 'O'"), "o_orderkey").select("c_custkey", "expanded")


def _bounds(t: Tables):
    return t.log.where("seq % 250 = 100").select("ts", (F.col("seq") / 250).cast("long").alias("n"))


@query("SELECT seq, b.n AS floor FROM log ASOF LEFT JOIN (SELECT ts, seq // 250 AS n FROM log WHERE seq % 250 = 100) b ON log.ts >= b.ts", "log")
def j7_asof_floor(t: Tables):
    return J.asof_floor(t.log.select("seq", "ts"), "ts", _bounds(t), "ts", "n").select("seq", "floor")


@query("SELECT seq, coalesce(b.n, 0) AS floor FROM log ASOF LEFT JOIN (SELECT ts, seq // 250 AS n FROM log WHERE seq % 250 = 100) b ON log.ts >= b.ts", "log")
def j7_asof_floor_first(t: Tables):
    return J.asof_floor(t.log.select("seq", "ts"), "ts", _bounds(t), "ts", "n", before="first").select("seq", "floor")


@query("SELECT o_orderkey, (o_orderkey + 4) // 4 AS hizb, o_orderkey % 4 + 1 AS quarter, (o_orderkey + 8) // 8 AS juz, o_orderkey % 4 + 1 <= 2 AS first_half FROM orders")
def j8_division_rollup(t: Tables):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in J.division_rollup(F.col("o_orderkey") + 1).items()])


@query("""WITH r AS (SELECT n_nationkey AS r, n_nationkey * 4.0 AS lo, CASE WHEN n_nationkey < 24 THEN n_nationkey * 4.0 + 2.5 END AS hi FROM nation)
SELECT event_id, CAST(r AS BIGINT) AS r FROM events JOIN r ON value >= lo AND value <= coalesce(hi, (SELECT max(value) FROM events))""")
def j9_interval_contains(t: Tables):
    r = t.nation.select(F.col("n_nationkey").alias("r"), (F.col("n_nationkey") * 4.0).alias("lo"), F.when(F.col("n_nationkey") < 24, F.col("n_nationkey") * 4.0 + 2.5).alias("hi"))
    return J.interval_contains(t.events.select("event_id", "value"), "value", r, "lo", "hi", 5.0).select("event_id", "r")


@query(f"SELECT a.grp, a.rid, b.rid AS rid2, round({OV}, 6) AS overlap FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.rid < b.rid AND {OV} > 0.5", "ivl")
def j10_interval_overlap(t: Tables):
    return J.interval_overlap(t.ivl, t.ivl, "grp", 0.5, width=10.0).where("rid < rid2").select("grp", "rid", "rid2", "overlap")


@query(f"""WITH h AS (SELECT grp, owner, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM ivl WHERE rid % 2 = 0 GROUP BY 1, 2), i AS (SELECT * FROM ivl WHERE rid % 2 = 1),
p AS (SELECT a.grp, a.rid, a.owner, b.owner AS o2, {OV} AS ov, greatest(-({OVY}), 0) AS clear FROM i a JOIN h b USING (grp)),
g AS (SELECT grp, rid, owner, count(*) FILTER (o2 <> owner AND ov > 0.5) AS n, max(ov) FILTER (o2 = owner) AS own, min(greatest(-ov, 0)) FILTER (o2 = owner) AS og, max(o2) FILTER (o2 <> owner AND ov > 0.5) AS other, max(clear) FILTER (o2 <> owner AND ov > 0.5) AS clear, max(greatest(-ov, 0)) FILTER (o2 <> owner AND ov > 0.5) AS tg FROM p GROUP BY 1, 2, 3)
SELECT grp, rid, owner, other, round(clear, 6) + 0.0 AS clear FROM g WHERE n = 1 AND own <= 0.5 AND clear <= 6.5 AND og - tg >= 0.3""", "ivl")
def j11_exclusive_owner(t: Tables):
    h = t.ivl.where("rid % 2 = 0").groupBy("grp", "owner").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return J.exclusive_owner(t.ivl.where("rid % 2 = 1"), h, "grp", "rid", "owner", width=8.0)


@query("""WITH b AS (SELECT grp, line, min(y0) AS y0, max(y1) AS y1 FROM ivl WHERE rid % 2 = 0 GROUP BY 1, 2),
c AS (SELECT a.grp, a.rid, b.line AS band, round(greatest(b.y0 - (a.y0 + a.y1) / 2, (a.y0 + a.y1) / 2 - b.y1, 0), 9) AS d FROM ivl a JOIN b USING (grp))
SELECT grp, rid, band, round(d, 6) AS distance FROM c QUALIFY row_number() OVER (PARTITION BY grp, rid ORDER BY d, band) = 1""", "ivl")
def j12_assign_band(t: Tables):
    bands = t.ivl.where("rid % 2 = 0").groupBy("grp", "line").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return J.assign_band(t.ivl, bands, "grp", ["rid"], "line", height=4.0).select("grp", "rid", "band", "distance")


@query(f"""WITH b AS (SELECT grp, line, min(y0) AS y0, max(y1) AS y1 FROM ivl WHERE fam <> 'R' GROUP BY 1, 2),
c AS (SELECT a.grp, a.rid, b.line AS band, round({OVY}, 9) AS o, a.line = b.line AS own FROM ivl a JOIN b USING (grp) WHERE round({OVY}, 9) > 0),
m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY grp, rid ORDER BY o DESC, own DESC, band) = 1)
SELECT grp, rid, band, round(o, 6) AS overlap FROM ivl LEFT JOIN m USING (grp, rid)""", "ivl")
def j12_band_by_overlap(t: Tables):
    bands = t.ivl.where("fam <> 'R'").groupBy("grp", "line").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return J.assign_band_by_overlap(t.ivl, bands, "grp", ["rid"], "line", own="line", height=8.0).select("grp", "rid", "band", "overlap")


@query(f"""WITH b AS (SELECT grp, line AS band, min(y0) AS y0, max(y1) AS y1 FROM ivl GROUP BY 1, 2),
s AS (SELECT a.grp, b.band, a.owner, min(x0) AS lo, max(x1) AS hi FROM ivl a JOIN b USING (grp) WHERE {OVY} > 0.5 * least(b.y1 - b.y0, a.y1 - a.y0) GROUP BY 1, 2, 3),
c AS (SELECT *, coalesce(lag(band) OVER w = band - 1 AND abs(lag(lo) OVER w - lo) <= 2 AND abs(lag(hi) OVER w - hi) <= 2, false) AS cp FROM s WINDOW w AS (PARTITION BY grp, owner ORDER BY band))
SELECT grp, band, owner, lo, hi FROM c WHERE NOT cp OR NOT EXISTS (SELECT 1 FROM c r WHERE NOT r.cp AND r.grp = c.grp AND r.band = c.band AND r.owner <> c.owner AND least(r.hi, c.hi) - greatest(r.lo, c.lo) > 0.3 * (c.hi - c.lo))""", "ivl")
def j13_span_bands(t: Tables):
    ivl = t.ivl_by_order
    bands = ivl.groupBy("grp", F.col("line").alias("band")).agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return J.span_bands(ivl, bands, "grp", "owner", "band", height=8.0, sizes=_orders(t))


@query(f"SELECT a.grp, a.rid, b.rid AS rid2, a.owner, b.owner AS owner2, round(({OV}) * ({OVY}), 6) AS area FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.rid < b.rid AND a.owner <> b.owner AND {OV} > 0.05 AND {OVY} > 0.05", "ivl")
def j14_rect_pairs(t: Tables):
    return J.rect_pairs(t.ivl, "grp", "rid", "owner", cell=20.0)


@query("""WITH r AS (SELECT *, max(x1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv, lead(x0) OVER w AS nx FROM (SELECT grp, rid, x0, x1, floor(y0 / 4) * 4 AS y0, floor(y0 / 4) * 4 + 3 AS y1 FROM ivl) WINDOW w AS (PARTITION BY grp, y0 ORDER BY x0, rid)),
p AS (SELECT l_orderkey AS grp, rid AS point, l_quantity * 1.3 AS x, l_tax * 120 AS y FROM li),
c AS (SELECT p.grp, p.point, r.rid, round(greatest(y0 - y, y - y1, 0), 9) AS dy, round(greatest(x0 - x, x - x1, 0), 9) AS dx,
  CASE WHEN greatest(x0 - x, x - x1, 0) = 0 OR (x > CASE WHEN pv < x0 THEN pv + 0.6 * (x0 - pv) ELSE '-inf'::DOUBLE END AND x <= CASE WHEN nx > x1 THEN x1 + 0.6 * (nx - x1) ELSE 'inf'::DOUBLE END) THEN 0 ELSE 1 END AS m, sqrt(pow(greatest(x0 - x, x - x1, 0), 2) + pow(greatest(y0 - y, y - y1, 0), 2)) AS d FROM p LEFT JOIN r USING (grp))
SELECT grp, point, CASE WHEN d <= 12 THEN rid END AS hit, CASE WHEN d <= 12 THEN round(d, 6) END AS distance FROM c QUALIFY row_number() OVER (PARTITION BY grp, point ORDER BY dy, m, dx, rid) = 1""", "li", "ivl")
def j15_point_in_rect_nearest(t: Tables):
    rows = F.floor(F.col("y0") / 4) * 4.0
    r = t.ivl.select("grp", "rid", "x0", "x1", rows.alias("y0"), (rows + 3).alias("y1"))
    p = t.li.select(F.col("l_orderkey").alias("grp"), F.col("rid").alias("point"), (F.col("l_quantity") * 1.3).alias("x"), (F.col("l_tax") * 120).alias("y"))
    return J.point_in_rect_nearest(p, r, "grp", "point", "rid", 12.0, height=8.0)


IOU = f"greatest({OV}, 0) * greatest({OVY}, 0) / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - greatest({OV}, 0) * greatest({OVY}, 0))"
BEST = f"""u AS (SELECT a.grp, a.rid, b.fam, b.rid AS r2, round({IOU}, 9) AS u FROM (SELECT * FROM ivl WHERE rid % 2 = 1) a JOIN (SELECT * FROM ivl WHERE rid % 2 = 0) b ON a.grp = b.grp),
best AS (SELECT i.grp, i.rid, coalesce(arg_max(u.fam, (u, -r2)) FILTER (u > 0.35), '(nothing there)') AS match, max(u) FILTER (u > 0.35) AS iou FROM (SELECT * FROM ivl WHERE rid % 2 = 1) i LEFT JOIN u USING (grp, rid) GROUP BY 1, 2)"""


@query(f"WITH {BEST} SELECT grp, rid, match, round(iou, 6) AS iou FROM best", "ivl")
def j16_best_iou(t: Tables):
    return J.best_iou(t.ivl.where("rid % 2 = 1"), t.ivl.where("rid % 2 = 0"), "grp", "rid", "fam", cell=8.0)


def _matches(t: Tables, rounds: int, *keep: str):
    return J.grid_match_1to1(t.ivl_by_order.where("rid % 2 = 1"), t.ivl_by_order.where("rid % 2 = 0"), "grp", "rid", 6.0, 4.0, rounds, _orders(t), keep)


ROUND1 = """c AS (SELECT a.grp, a.rid, b.rid AS rid2, round(greatest(abs((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2), abs((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2)), 9) AS d FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.rid % 2 = 1 AND b.rid % 2 = 0
  AND greatest(abs((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2), abs((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2)) <= 6 AND abs(greatest(a.x1 - a.x0, a.y1 - a.y0) - greatest(b.x1 - b.x0, b.y1 - b.y0)) <= 4),
r1 AS (SELECT *, row_number() OVER (PARTITION BY grp, rid ORDER BY d, rid2) AS ra, row_number() OVER (PARTITION BY grp, rid2 ORDER BY d, rid) AS rb FROM c),
m1 AS (SELECT grp, rid, rid2, d FROM r1 WHERE ra = 1 AND rb = 1)"""


@query(f"WITH {ROUND1} SELECT grp, rid, rid2, round(d, 6) AS distance FROM m1", "ivl")
def j17_grid_match_one_round(t: Tables):
    return _matches(t, 1)


@query()
def j17_grid_match_1to1(t: Tables):
    return _matches(t, None)


def _surplus(t: Tables):
    return t.ivl.withColumn("delta", F.pmod("owner", F.lit(3)) - 1)


PAIRS = f"""s AS (SELECT *, owner % 3 - 1 AS delta FROM ivl),
c AS (SELECT a.grp, a.fam, a.rid, b.rid AS r2, CASE WHEN a.line = b.line AND abs(a.rid - b.rid) = 1 THEN 0 WHEN abs(a.line - b.line) = 1 AND abs(a.rid - b.rid) = 1 THEN 1 WHEN abs(a.line - b.line) = 1 AND {OV} > -3 THEN 2 WHEN a.line = b.line THEN 3 END AS rank, abs(a.rid - b.rid) AS d FROM s a JOIN s b ON a.grp = b.grp AND a.fam = b.fam AND a.delta > 0 AND b.delta < 0),
w AS (SELECT * FROM c WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY grp, fam, rid ORDER BY rank, d, r2) = 1),
links AS (SELECT grp, fam, rid, r2 AS other, 'surplus' AS role, CAST(rank AS BIGINT) AS rank, d AS distance FROM w UNION ALL SELECT grp, fam, r2, rid, 'deficit', rank, d FROM w)"""


@query(f"WITH {PAIRS} SELECT * FROM links", "ivl")
def j18_pair_counterparts(t: Tables):
    return J.pair_counterparts(_surplus(t), "delta", "grp", "fam", "rid", "line", "rid")


@query(f"""WITH {PAIRS}, k AS (SELECT grp, rid, string_agg(DISTINCT fam, ',' ORDER BY fam) AS pairs FROM links GROUP BY 1, 2),
z AS (SELECT grp, rid, x0 / 100 AS p, CASE WHEN x0 < 20 THEN 'clean' WHEN x0 < 40 THEN 'review' ELSE 'high' END AS tier, CASE WHEN owner % 11 = 0 THEN 'no-issue' END AS human FROM ivl),
m AS (SELECT z.*, coalesce(pairs, '') AS pairs, pairs IS NOT NULL AND tier = 'clean' AND human IS NULL AS up FROM z LEFT JOIN k USING (grp, rid))
SELECT grp, rid, round(CASE WHEN up THEN greatest(p, 0.25) ELSE p END, 6) AS p, CASE WHEN up THEN 'review' ELSE tier END AS tier, human, pairs FROM m""", "ivl")
def j18_promote_counterparts(t: Tables):
    links = J.pair_counterparts(_surplus(t), "delta", "grp", "fam", "rid", "line", "rid")
    tier = F.when(F.col("x0") < 20, "clean").when(F.col("x0") < 40, "review").otherwise("high")
    scores = t.ivl.select("grp", "rid", (F.col("x0") / 100).alias("p"), tier.alias("tier"), F.when(F.col("owner") % 11 == 0, "no-issue").alias("human"))
    return J.promote_counterparts(scores, links, ["grp", "rid"], "fam", human="human").withColumn("pairs", F.array_join("pairs", ","))


@query(f"""WITH n AS (SELECT a.grp, a.rid, round(greatest(-({OVY}), 0) + greatest(-({OV}), 0), 9) AS d, b.rid AS other FROM ivl a JOIN ivl b ON a.grp = b.grp AND abs(a.line - b.line) = 1 AND greatest(-({OV}), 0) <= 8),
b AS (SELECT grp, rid, min((d, other)) AS m FROM n GROUP BY 1, 2), o AS (SELECT a.grp, a.rid, min(round(greatest(-({OV}), 0) + greatest(-({OVY}), 0), 9)) AS own FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.line = b.line AND a.rid <> b.rid GROUP BY 1, 2)
SELECT grp, rid, m[2] AS other, round(m[1], 6) + 0.0 AS distance, round(own, 6) AS own FROM b JOIN o USING (grp, rid) WHERE m[1] + 3 < own AND own > 6""", "ivl")
def j19_nearest_other_line(t: Tables):
    return J.nearest_other_line(t.ivl, t.ivl, "grp", "rid", "line")


@query("""WITH p AS (SELECT grp, greatest(x0, 5.0) AS a, least(x1, 55.0) AS b FROM ivl WHERE greatest(x0, 5.0) < least(x1, 55.0)),
r AS (SELECT *, max(b) OVER (PARTITION BY grp ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p)
SELECT g.grp, round(coalesce(sum(greatest(b - greatest(a, coalesce(reach, a)), 0)), 0) / 50.0, 6) AS coverage FROM (SELECT DISTINCT grp FROM ivl) g LEFT JOIN r USING (grp) GROUP BY 1""", "ivl")
def j20_union_coverage(t: Tables):
    return J.union_coverage(t.ivl.select("grp").distinct().withColumns({"lo": F.lit(5.0), "hi": F.lit(55.0)}), t.ivl, "grp")


@query("""WITH p AS (SELECT grp, greatest(x0, 10.0) AS x0, least(x1, 50.0) AS x1, greatest(y0, 1.0) AS y0, least(y1, 9.0) AS y1 FROM ivl WHERE grp % 10 = 3), q AS (SELECT * FROM p WHERE x0 < x1 AND y0 < y1),
xs AS (SELECT grp, a, lead(a) OVER (PARTITION BY grp ORDER BY a) AS b FROM (SELECT DISTINCT grp, unnest([x0, x1]) AS a FROM q)), ys AS (SELECT grp, a, lead(a) OVER (PARTITION BY grp ORDER BY a) AS b FROM (SELECT DISTINCT grp, unnest([y0, y1]) AS a FROM q)),
c AS (SELECT xs.grp, (xs.b - xs.a) * (ys.b - ys.a) AS s FROM xs JOIN ys USING (grp) WHERE xs.b IS NOT NULL AND ys.b IS NOT NULL AND EXISTS (SELECT 1 FROM q WHERE q.grp = xs.grp AND q.x0 <= xs.a AND q.x1 >= xs.b AND q.y0 <= ys.a AND q.y1 >= ys.b))
SELECT grp, round(coalesce(sum(s), 0) / 320.0, 6) AS coverage FROM (SELECT DISTINCT grp FROM ivl WHERE grp % 10 = 3) LEFT JOIN c USING (grp) GROUP BY 1""".replace(" WHERE grp % 10 = 3", ""), "ivl")
def j20_union_coverage_2d(t: Tables):
    target = t.ivl_by_order.select("grp").distinct().withColumns({"x0": F.lit(10.0), "x1": F.lit(50.0), "y0": F.lit(1.0), "y1": F.lit(9.0)})
    return J.union_coverage_2d(target, t.ivl_by_order, "grp")


@query("""WITH RECURSIVE terms AS (SELECT DISTINCT p_name AS term, 'two' AS rule FROM part WHERE p_size % 2 = 0 UNION ALL SELECT DISTINCT string_split(p_name, ' ')[1], 'one' FROM part WHERE p_size % 3 = 0),
parts AS (SELECT p_partkey AS key, string_split(lower(p_name || ' ' || p_type), ' ') AS p FROM part),
g AS (SELECT key, CAST(i - 1 AS BIGINT) AS start, n AS size, array_to_string(p[i : i + n - 1], ' ') AS gram FROM parts, unnest([4, 3, 2, 1]) AS s(n), unnest(range(1, len(p) - n + 2)) AS r(i)),
h AS (SELECT key, start, size, term, rule FROM g JOIN terms ON gram = term OR gram = term || 's' QUALIFY row_number() OVER (PARTITION BY key, start, size ORDER BY term) = 1),
two AS (SELECT * FROM (SELECT *, start - coalesce(lag(start) OVER (PARTITION BY key ORDER BY start, term), -2) AS gap FROM h WHERE size = 2) WHERE gap >= 2)
SELECT key, start, CAST(size AS BIGINT) AS size, term, rule FROM two UNION ALL
SELECT key, start, CAST(size AS BIGINT), term, rule FROM h WHERE size = 1 AND NOT EXISTS (SELECT 1 FROM two WHERE two.key = h.key AND h.start BETWEEN two.start AND two.start + 1)""")
def j21_dictionary_match(t: Tables):
    first = F.element_at(F.split("p_name", " "), 1)
    terms = t.part.where("p_size % 2 = 0").select(F.col("p_name").alias("term")).distinct().withColumn("rule", F.lit("two")).unionByName(t.part.where("p_size % 3 = 0").select(first.alias("term")).distinct().withColumn("rule", F.lit("one")))
    tokens = t.part.select(F.col("p_partkey").alias("key"), F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("ident"))
    return J.dictionary_match(tokens, terms, "key", "ident")


@query(r"""WITH l AS (SELECT doc_id, i - 1 AS no, lang = 'en' AS prose, source IS NULL OR length(source) % 2 = 0 AS allowed, ls[i] AS line FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(i)),
w AS (SELECT doc_id, no, prose, allowed, unnest(regexp_extract_all(line, '[A-Za-z][A-Za-z0-9_.\-]*')) AS identifier FROM l WHERE NOT regexp_matches(line, '(?i)terminology:\s*ignore')),
g AS (SELECT doc_id, no, prose, allowed, identifier, count(*) AS k FROM w GROUP BY ALL),
d AS (SELECT identifier, list_filter(string_split_regex(lower(regexp_replace(identifier, '([a-z0-9])([A-Z])', '\1 \2', 'g')), '[_.\-\s]+'), lambda x: x <> '') AS ps FROM (SELECT DISTINCT identifier FROM g)),
t AS (SELECT * FROM (VALUES ('the', 'gloss'), ('and', 'deprecated'), ('der', 'generic'), ('que', 'canonical'), ('la', 'house')) v(term, rule)),
h AS (SELECT identifier, term, rule, count(*) AS m FROM (SELECT identifier, unnest(ps) AS part FROM d) JOIN t ON part = term OR part = term || 's' GROUP BY ALL)
SELECT doc_id, no, identifier, term, rule, CASE rule WHEN 'deprecated' THEN 'error' ELSE 'warning' END AS severity, k * m AS n FROM g JOIN h USING (identifier)
WHERE rule <> 'canonical' AND NOT (prose AND rule IN ('gloss', 'generic')) AND NOT (allowed AND rule IN ('gloss', 'generic'))""")
def j21_scoped_findings(t: Tables):
    """Lines of documents, English ones as prose; glosses are allowed in some sources."""
    terms = t.spark.createDataFrame([("the", "gloss"), ("and", "deprecated"), ("der", "generic"), ("que", "canonical"), ("la", "house")], "term string, rule string")
    d = t.documents.select("doc_id", (F.col("lang") == "en").alias("prose"), (F.col("source").isNull() | (F.length("source") % 2 == 0)).alias("allowed"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return J.scoped_findings(d, terms, "doc_id", "no", "line", "prose", "allowed")


@query("""WITH a AS (SELECT conv_id, turn AS o, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'user'),
b AS (SELECT conv_id, turn AS o, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant')
SELECT conv_id, a.i AS rank, a.o AS item, b.o AS time, 'paired' AS status FROM a JOIN b USING (conv_id, i, n)
UNION ALL SELECT x.conv_id, 0, NULL, NULL, 'guarded' FROM (SELECT DISTINCT conv_id, n FROM a) x LEFT JOIN (SELECT DISTINCT conv_id, n FROM b) y USING (conv_id) WHERE x.n IS DISTINCT FROM y.n""")
def j22_segment_to_interval_guard(t: Tables):
    c = t.conversations.select("conv_id", "turn", "role")
    return J.segment_to_interval_guard(c.where("role = 'user'").drop("role"), c.where("role = 'assistant'").drop("role"), "conv_id", "turn")


@query(f"""WITH {ROUND1}, v AS (SELECT i.grp, i.owner, p.owner AS vote FROM ivl i LEFT JOIN m1 USING (grp, rid) LEFT JOIN ivl p ON p.grp = m1.grp AND p.rid = m1.rid2 WHERE i.rid % 2 = 1)
SELECT grp, owner, count(vote) AS votes, CASE WHEN count(DISTINCT vote) = 1 THEN min(vote) END AS target, CASE count(DISTINCT vote) WHEN 0 THEN 'unpaired' WHEN 1 THEN 'mapped' ELSE 'split' END AS status FROM v GROUP BY 1, 2""", "ivl")
def j23_transfer_partition(t: Tables):
    # An item comes with its owner, so that order lines needn't be numbered again to find it.
    return J.transfer_partition(t.ivl_by_order.where("rid % 2 = 1"), _matches(t, 1, "owner"), "grp", "owner", "rid", "owner2")


@query(f"""WITH {BEST}, need AS (SELECT fam AS match, count(*) % 5 AS spare FROM ivl GROUP BY 1), j AS (SELECT i.grp, i.rid, i.fam, b.match, need.spare FROM ivl i JOIN best b USING (grp, rid) LEFT JOIN need USING (match) WHERE i.grp % 3 = 0),
o AS (SELECT *, CASE WHEN match IS NULL OR match = '(nothing there)' THEN 'no-partner' WHEN match = fam THEN 'same-name' WHEN coalesce(spare, 0) <= 0 THEN 'no-need' ELSE 'relabelled' END AS outcome FROM j)
SELECT grp, rid, fam, CASE WHEN outcome = 'relabelled' THEN match ELSE fam END AS new_name, outcome FROM o""", "ivl")
def j24_correct_from_reference(t: Tables):
    a = t.ivl.where("rid % 2 = 1")
    best = J.best_iou(a, t.ivl.where("rid % 2 = 0"), "grp", "rid", "fam").select("grp", "rid", "match")
    need = t.ivl.groupBy("fam").agg((F.count(F.lit(1)) % 5).alias("spare"))
    convicted = t.ivl.where("grp % 3 = 0 and rid % 2 = 1").select("grp", "rid")
    return J.correct_from_reference(a.select("grp", "rid", "fam"), best, convicted, need, ["grp", "rid"], "fam")


@query("SELECT page_id, coalesce(nullif(regexp_extract(html, '<html lang=\"([a-z]*)\"', 1), ''), 'none') AS lang FROM pages")
def j25_alias_coalesce(t: Tables):
    d = t.pages.select("page_id", F.nullif(F.regexp_extract("html", '<html lang="([a-z]*)"', 1), F.lit("")).alias("lang_attr"), F.lit("none").alias("default_lang"))
    return J.alias_coalesce(d, ["xml_lang", "lang_attr", "default_lang"], "lang").select("page_id", "lang")
