"""Queries of the window, selection, ranking and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.operators import select as S
from marginalia.operators import sets as X
from marginalia.operators import windows as W

from .base import query
from .views import Tables

BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
LI = "l_orderkey, rid, l_quantity"


@query("""SELECT grp, rid, x0 FROM (SELECT *, x0 + 1 < lag(x0) OVER w AND NOT greatest(greatest(y0, lag(y0) OVER w) - least(y1, lag(y1) OVER w), 0) >= 2 AS b FROM ivl WINDOW w AS (PARTITION BY grp ORDER BY line, rid)) WHERE b""", "ivl")
def w1_order_breaks(t: Tables):
    return W.order_breaks(t.ivl, "grp", ["line", "rid"], "x0").select("grp", "rid", "x0")


@query("""WITH f AS (SELECT o_custkey AS g, month(o_orderdate) AS line, min(o_orderkey) AS k FROM orders GROUP BY 1, 2), o AS (SELECT g, coalesce(k >= lag(k) OVER (PARTITION BY g ORDER BY line), true) AS ok FROM f) SELECT g, bool_and(ok) AS ok FROM o GROUP BY 1""")
def w2_monotone_source(t: Tables):
    return W.monotone_source(t.orders.select(F.col("o_custkey").alias("g"), F.month("o_orderdate").alias("line"), F.col("o_orderkey").alias("k")), "g", "line", "k")


@query(f"""WITH e AS (SELECT user_id, event_id, CAST(floor(value / 20) AS BIGINT) AS ident FROM events), p AS (SELECT *, max(ident) OVER (PARTITION BY user_id ORDER BY event_id {BEFORE}) AS prev_max FROM e)
SELECT * FROM p WHERE prev_max IS NOT NULL AND ident <> prev_max AND ident <> prev_max + 1""")
def w3_id_sequence(t: Tables):
    return W.id_sequence(t.events.select("user_id", "event_id", F.floor(F.col("value") / 20).alias("ident")), "user_id", "event_id", "ident")


@query("""WITH b AS (SELECT grp, line, min(y0) AS y0, max(y1) AS y1 FROM ivl WHERE rid % 2 = 0 GROUP BY 1, 2),
p AS (SELECT a.grp, a.rid, a.line, a.x0, b.line AS band FROM ivl a JOIN b USING (grp) QUALIFY row_number() OVER (PARTITION BY a.grp, a.rid ORDER BY round(greatest(b.y0 - (a.y0 + a.y1) / 2, (a.y0 + a.y1) / 2 - b.y1, 0), 9), b.line) = 1),
x AS (SELECT *, coalesce(x0 < lag(x0) OVER (PARTITION BY grp, line ORDER BY rid), false) AS b1, coalesce(x0 < lag(x0) OVER (PARTITION BY grp, band ORDER BY rid), false) AS b2 FROM p)
SELECT grp, count(*) FILTER (band <> line) AS moves, count(*) FILTER (b1) AS before, count(*) FILTER (b2) AS after, CASE WHEN count(*) FILTER (b2) = 0 THEN 'misplaced' ELSE 'review' END AS status FROM x GROUP BY 1 HAVING count(*) FILTER (band <> line) > 0""", "ivl")
def w4_propose_and_confirm(t: Tables):
    bands = t.ivl.where("rid % 2 = 0").groupBy("grp", "line").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return W.propose_and_confirm(t.ivl, bands, "grp", "rid", "line", "x0")


# Both windows need one order: among equal intervals only the first may begin an island.
ISL = f"""r AS (SELECT grp, rid, x0, x1, max(x1) OVER (PARTITION BY grp ORDER BY x0, x1, rid {BEFORE}) AS reach FROM ivl), n AS (SELECT *, sum(CASE WHEN reach IS NULL OR x0 > reach + 0.4 THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY x0, x1, rid ROWS UNBOUNDED PRECEDING) AS island FROM r)"""


@query(f"WITH {ISL} SELECT grp, CAST(island AS BIGINT) AS island, min(x0) AS lo, max(x1) AS hi, count(*) AS n FROM n GROUP BY 1, 2", "ivl")
def w5_islands(t: Tables):
    return W.islands(t.ivl, "grp", "x0", "x1", 0.4)


@query("""WITH d AS (SELECT id, seq, ts / 1000000.0 AS s FROM log), j AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY id ORDER BY s) > 3600 THEN 1 ELSE 0 END AS new FROM d)
SELECT id, seq, CAST(sum(new) OVER (PARTITION BY id ORDER BY s RANGE UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM j""", "log")
def w6_jump_clusters(t: Tables):
    return W.jump_clusters(t.log.select("id", "seq", (F.col("ts") / 1000000.0).alias("s")), "id", "s", 3600.0).select("id", "seq", "cluster")


@query(f"""WITH r AS (SELECT *, max(y1) OVER (PARTITION BY grp ORDER BY y0, y1, rid {BEFORE}) AS reach FROM (SELECT * REPLACE (y0 * 3 AS y0, y0 * 3 + 1 AS y1) FROM ivl)),
n AS (SELECT *, sum(CASE WHEN y0 > reach + 6 THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY y0, y1, rid ROWS UNBOUNDED PRECEDING) AS c FROM r),
s AS (SELECT grp, c, round(sum((x1 - x0) * (y1 - y0)), 6) AS a, min(x0) AS lo, max(x1) AS hi FROM n GROUP BY 1, 2), b AS (SELECT grp, arg_max(struct_pack(c := c, lo := lo, hi := hi), (a, -c)) AS b FROM s GROUP BY 1)
SELECT grp, rid, CASE WHEN n.c = b.b.c THEN 'kept' WHEN x0 >= b.b.lo AND x1 <= b.b.hi THEN 'flag' ELSE 'stray' END AS status FROM n JOIN b USING (grp)""", "ivl")
def w7_dominant_cluster(t: Tables):
    return W.dominant_cluster(t.ivl.withColumns({"y0": F.col("y0") * 3, "y1": F.col("y0") * 3 + 1}), "grp", "rid")


@query(f"""WITH r AS (SELECT grp, greatest(x0 - max(x1) OVER (PARTITION BY grp ORDER BY x0, x1 {BEFORE}), 0) AS h, row_number() OVER (PARTITION BY grp ORDER BY x0, x1) AS i FROM ivl) SELECT grp, round(coalesce(max(h) FILTER (i > 1), 0), 6) + 0.0 AS hole, coalesce(max(h) FILTER (i > 1), 0) > 8 AS flagged FROM r GROUP BY 1""", "ivl")
def w8_largest_hole(t: Tables):
    return W.largest_hole(t.ivl, "grp", "x0", "x1", 8.0)


@query("SELECT * FROM (SELECT grp, line, edge, lag(edge) OVER (PARTITION BY grp ORDER BY line) AS prev FROM (SELECT grp, line, max(x1) AS edge FROM ivl GROUP BY 1, 2)) WHERE edge > prev + 8", "ivl")
def w9_group_order_law(t: Tables):
    return W.group_order_law(t.ivl, "grp", "line", "x1")


@query("""WITH g AS (SELECT grp, line, min(y0) AS y0, max(y1) AS y1, (min(y0) + max(y1)) / 2 AS c FROM ivl GROUP BY 1, 2), m AS (SELECT *, (c + lag(c) OVER w) / 2 AS up, (c + lead(c) OVER w) / 2 AS dn FROM g WINDOW w AS (PARTITION BY grp ORDER BY line)),
e AS (SELECT grp, line, coalesce(up, 2 * c - dn, y0) AS a, coalesce(dn, 2 * c - up, y1) AS b FROM m) SELECT grp, line, round(least(a, b), 6) + 0.0 AS top, round(greatest(a, b), 6) + 0.0 AS bottom FROM e""", "ivl")
def w10_pitch_bands(t: Tables):
    return W.pitch_bands(t.ivl, "grp", "line")


@query("""WITH d AS (SELECT l_orderkey AS g, rid, rid * 10 + l_quantity AS pos, l_quantity AS h FROM li), p AS (SELECT g, list_sort(list(gap))[CAST(floor(count(gap) / 2) AS INT) + 1] AS pitch FROM (SELECT g, pos - lag(pos) OVER (PARTITION BY g ORDER BY pos) AS gap FROM d) WHERE gap > 20 GROUP BY 1)
SELECT d.g, rid, pos, h, pitch FROM d JOIN p USING (g) WHERE h > 1.05 * pitch OR h < 0.28 * pitch""", "li")
def w11_median_pitch_limit(t: Tables):
    return W.median_pitch_limit(t.li.select(F.col("l_orderkey").alias("g"), "rid", (F.col("rid") * 10 + F.col("l_quantity")).alias("pos"), F.col("l_quantity").alias("h")), "g", "pos", "h")


def _weighted(t: Tables):
    return t.li.select("l_orderkey", "rid", F.when(F.col("l_linenumber") < 6, F.col("l_quantity")).alias("w"), F.col("l_linenumber").cast("double").alias("fb"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))


@query("""WITH d AS (SELECT l_orderkey, rid, CASE WHEN l_linenumber < 6 THEN l_quantity END AS w, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM li)
SELECT l_orderkey, rid, round(CASE WHEN w IS NOT NULL AND sum(w) OVER p <> 0 THEN w / sum(w) OVER p * CAST(sum(CASE WHEN w IS NOT NULL THEN cents END) OVER p AS BIGINT) END, 4) AS expected FROM d WINDOW p AS (PARTITION BY l_orderkey)""", "li")
def w12_proportional_share(t: Tables):
    return W.proportional_share(_weighted(t), "l_orderkey", "w", "cents").select("l_orderkey", "rid", F.round("expected", 4).alias("expected"))


@query("""WITH d AS (SELECT l_orderkey, rid, CASE WHEN l_linenumber < 6 THEN l_quantity END AS w, CAST(l_linenumber AS DOUBLE) AS fb, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM li), s AS (SELECT *, w / sum(w) OVER p AS s, fb / sum(fb) OVER p AS f, CAST(sum(cents) OVER p AS BIGINT) AS tot FROM d WINDOW p AS (PARTITION BY l_orderkey)),
b AS (SELECT *, bool_or(coalesce(w IS NULL OR s IS NULL OR s / f < 0.45 OR s / f > 2.2, true)) OVER (PARTITION BY l_orderkey) AS fell_back FROM s) SELECT l_orderkey, rid, fell_back, round(CASE WHEN fell_back THEN f ELSE s END * tot, 4) AS expected FROM b""", "li")
def w13_share_with_fallback(t: Tables):
    return W.share_with_fallback(_weighted(t), "l_orderkey", "w", "fb", "cents").select("l_orderkey", "rid", "fell_back", F.round("expected", 4).alias("expected"))


@query("""WITH d AS (SELECT o_custkey AS g, o_orderkey, o_orderkey % 3 * (o_custkey % 4) // 2 AS delta FROM orders), c AS (SELECT g, delta, count(*) AS n FROM d GROUP BY 1, 2), m AS (SELECT g, arg_max(delta, (n, -delta)) AS mode, max(n) AS n, sum(n) AS tot FROM c GROUP BY 1)
SELECT g, o_orderkey, delta FROM d WHERE g NOT IN (SELECT g FROM m WHERE mode <> 0 AND n >= greatest(5, 0.4 * tot))""")
def w14_suppress_constant_offset(t: Tables):
    d = t.orders.select(F.col("o_custkey").alias("g"), "o_orderkey", F.floor(F.col("o_orderkey") % 3 * (F.col("o_custkey") % 4) / 2).alias("delta"))
    return W.suppress_constant_offset(d, "g", "delta", share=0.4)


@query("SELECT l_orderkey, rid, row_number() OVER (PARTITION BY l_orderkey ORDER BY rid DESC) AS fragment, count(*) OVER (PARTITION BY l_orderkey) AS fragments FROM li", "li")
def w15_fragment_numbers(t: Tables):
    return W.fragment_numbers(t.li.select("l_orderkey", "rid"), "l_orderkey", [F.col("rid").desc()])


PROF = """e AS (SELECT fam AS g, CAST(floor(x0 / 2.5) AS BIGINT) AS bin, 1 AS d FROM ivl WHERE grp % 50 = 1 UNION ALL SELECT fam, CAST(floor(x1 / 2.5) AS BIGINT) + 1, -1 FROM ivl WHERE grp % 50 = 1), s AS (SELECT g, bin, sum(d) AS d FROM e GROUP BY 1, 2),
p AS (SELECT g, bin, CAST(sum(d) OVER (PARTITION BY g ORDER BY bin) AS BIGINT) AS weight FROM s)""".replace(" WHERE grp % 50 = 1", "").replace("fam AS g", "owner AS g").replace("SELECT fam,", "SELECT owner,")


@query(f"WITH {PROF}, a AS (SELECT *, coalesce(lag(weight) OVER w * (bin - lag(bin) OVER w), 0) AS x FROM p WINDOW w AS (PARTITION BY g ORDER BY bin)) SELECT g, bin, weight, CAST(sum(x) OVER (PARTITION BY g ORDER BY bin) AS BIGINT) AS mass_before FROM a", "ivl")
def w16_density_profile(t: Tables):
    return W.density_profile(t.ivl.withColumnRenamed("owner", "g"), "g", "x0", "x1", 2.5)


@query(f"WITH {PROF}, r AS (SELECT *, lead(bin) OVER (PARTITION BY g ORDER BY bin) AS nx FROM p), b AS (SELECT g, bin AS from_bin, nx - 1 AS to_bin, nx - bin AS length FROM r WHERE weight = 0 AND nx IS NOT NULL) SELECT *, row_number() OVER (PARTITION BY g ORDER BY length DESC, from_bin) = 1 AS widest FROM b", "ivl")
def w17_blank_runs(t: Tables):
    return W.blank_runs(W.density_profile(t.ivl.withColumnRenamed("owner", "g"), "g", "x0", "x1", 2.5), "g")


@query("SELECT id, step, arg_max(action, (ts, seq)) AS action, arg_max(value, (ts, seq)) AS value FROM log GROUP BY 1, 2", "log")
def w18_latest_by_key(t: Tables):
    return W.latest_by_key(t.log, ["id", "step"], ["ts", "seq"], ["action", "value"])


@query("""SELECT id, arg_max(CASE WHEN action <> 'approve' THEN action END, (ts, seq)) FILTER (action <> 'approve') AS action, arg_max(v, (ts, seq)) FILTER (v IS NOT NULL) AS v, bool_or(action = 'approve') AS reviewed FROM (SELECT *, CASE WHEN value > 50 THEN value END AS v FROM log) GROUP BY 1""", "log")
def w19_fold_partial(t: Tables):
    d = t.log.withColumn("v", F.when(F.col("value") > 50, F.col("value")))
    return W.fold_partial(d, "id", ["ts", "seq"], ["action", "v"], label="action", sentinel="approve")


@query("""WITH j AS (SELECT a.grp, a.rid, (a.y0 + a.y1) / 2 AS c, sqrt(pow(greatest(greatest(a.x0, b.x0) - least(a.x1, b.x1), 0), 2) + pow(greatest(greatest(a.y0, b.y0) - least(a.y1, b.y1), 0), 2)) AS d, b.y0, b.y1 FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.fam = b.fam AND a.rid <> b.rid)
SELECT grp, rid, round(min(d), 6) AS distance, round(greatest(min(y0) - min(c), min(c) - max(y1), 0), 6) + 0.0 AS outside FROM j GROUP BY 1, 2""", "ivl")
def w20_gap_to_owner(t: Tables):
    return W.gap_to_owner(t.ivl, t.ivl, "grp", "rid", "fam")


@query("""WITH d AS (SELECT l_partkey AS grp, l_orderkey * 1000 + rid AS rid, l_linenumber * 1.0 AS x0, l_linenumber + 2.0 AS x1, floor(l_quantity / 10) AS y0, floor(l_quantity / 10) + 1 AS y1 FROM li),
f AS (SELECT *, CASE WHEN abs(y0 - lag(y1) OVER w) <= 0.01 AND x0 = lag(x0) OVER w AND x1 = lag(x1) OVER w THEN 0 ELSE 1 END AS n FROM d WINDOW w AS (PARTITION BY grp ORDER BY y0, y1, rid)), i AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY y0, y1, rid ROWS UNBOUNDED PRECEDING) AS i FROM f)
SELECT grp, CAST(min(x0) AS DOUBLE) AS x0, CAST(max(x1) AS DOUBLE) AS x1, CAST(min(y0) AS DOUBLE) AS y0, CAST(max(y1) AS DOUBLE) AS y1, count(*) AS merged FROM i GROUP BY grp, i""", "li")
def w21_merge_equal_spans(t: Tables):
    y = F.floor(F.col("l_quantity") / 10).cast("double")
    d = t.li_by_order.select(F.col("l_partkey").alias("grp"), (F.col("l_orderkey") * 1000 + F.col("rid")).alias("rid"), F.col("l_linenumber").cast("double").alias("x0"), (F.col("l_linenumber") + 2.0).alias("x1"), y.alias("y0"), (y + 1).alias("y1"))
    return W.merge_equal_spans(t.by_order(d), "grp", "rid")


@query(f"""WITH d AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, CASE WHEN event_id % 4 <> 0 THEN event_id * 2 END AS num FROM events),
x AS (SELECT *, first_value(CASE WHEN num IS NOT NULL THEN num - i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx, last_value(CASE WHEN num IS NOT NULL THEN num - i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id {BEFORE}) AS pv FROM d)
SELECT user_id, event_id, num, coalesce(num, nx + i, pv + i) AS repaired FROM x""")
def w22_repair_sequence(t: Tables):
    d = t.events.select("user_id", "event_id", F.when(F.col("event_id") % 4 != 0, F.col("event_id") * 2).alias("num"))
    return W.repair_sequence(d, "user_id", "event_id", "num")


@query("""WITH d AS (SELECT event_id, event_id // 20 AS p, user_id % 12 AS k FROM events), e AS (SELECT p, arg_min(k, event_id) AS f, arg_max(k, event_id) AS last_key, max(event_id) AS last_row FROM d GROUP BY 1), n AS (SELECT *, lead(f) OVER (ORDER BY p) AS nx FROM e)
SELECT n.p, last_key, last_row FROM n JOIN (SELECT p, k, count(*) AS c FROM d GROUP BY 1, 2) c ON c.p = n.p AND c.k = last_key WHERE last_key = nx AND c = 1""")
def w23_continuation_row(t: Tables):
    d = t.events.select("event_id", F.floor(F.col("event_id") / 20).alias("p"), (F.col("user_id") % 12).alias("k"))
    return W.continuation_row(d, "p", "event_id", "k")


@query("SELECT grp, fam AS side, count(*) AS n, list(rid ORDER BY -x1, rid) = list(rid ORDER BY line, rid) AS in_order FROM ivl GROUP BY 1, 2 HAVING count(*) >= 2", "ivl")
def w24_side_order(t: Tables):
    return W.side_order(t.ivl.withColumnRenamed("fam", "side"), "grp", "side", "x1", "line", "rid")


@query(f"""WITH s AS (SELECT grp, rid AS slot, x0, x1, rid % 3 <> 0 AS f FROM ivl), e AS (SELECT grp, slot, f, last_value(CASE WHEN f THEN x1 END IGNORE NULLS) OVER (PARTITION BY grp ORDER BY slot {BEFORE}) AS lo, first_value(CASE WHEN f THEN x0 END IGNORE NULLS) OVER (PARTITION BY grp ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi FROM s),
w AS (SELECT grp, slot, coalesce(lo, hi - 22) AS a, coalesce(hi, lo + 22) AS b FROM e WHERE NOT f AND (lo IS NOT NULL OR hi IS NOT NULL)),
j AS (SELECT w.grp, slot, rid, round(least(b, x1) - greatest(a, x0), 9) AS ov FROM w JOIN ivl ON w.grp = ivl.grp AND rid % 3 <> 0 AND least(b, x1) - greatest(a, x0) >= 0.6 * (x1 - x0) AND least(b, x1) - greatest(a, x0) > 0)
SELECT grp, slot, arg_max(rid, (ov, -rid)) AS piece, round(max(ov), 6) AS overlap FROM j GROUP BY 1, 2""", "ivl")
def w25_gap_window_search(t: Tables):
    slots = t.ivl.select("grp", F.col("rid").alias("slot"), "x0", "x1", (F.col("rid") % 3 != 0).alias("f"))
    return W.gap_window_search(slots, t.ivl.where("rid % 3 <> 0").select("grp", "rid", "x0", "x1"), "grp", "slot", "f")


# Selection


@query("SELECT doc_id, line_no, pos, token FROM tok WHERE line_no = 2 AND pos IN (0, 3, 5) AND doc_id IN (SELECT doc_id FROM labels)", "tok")
def f1_select_words(t: Tables):
    return S.select_words(t.tok, t.labels, key="doc_id", line_no=2, pos=[0, 3, 5])


TARGETS = "targets AS (SELECT unnest(['5', '7:2', '9:0:3', '9:0:3', '11:1', '5'] ) AS target)"


@query(f"""WITH {TARGETS} SELECT doc_id, line_no, pos, token, target FROM tok JOIN targets ON target = CAST(doc_id AS VARCHAR) OR target = doc_id || ':' || line_no OR target = doc_id || ':' || line_no || ':' || pos""", "tok")
def f2_resolve(t: Tables):
    targets = t.spark.createDataFrame([(x,) for x in ("5", "7:2", "9:0:3", "9:0:3", "11:1", "5")], "target string")
    return S.resolve(t.tok, targets, ["doc_id", "line_no", "pos"])


@query("""WITH k AS (SELECT CASE WHEN doc_id % 10 = 0 THEN doc_id || ':' || line_no ELSE doc_id || ':' || line_no || ':' || pos END AS key FROM tok)
SELECT key, regexp_full_match(key, '\\d+:\\d+:\\d+') AS valid, CASE WHEN regexp_full_match(key, '\\d+:\\d+:\\d+') THEN CAST(string_split(key, ':')[1] AS BIGINT) END AS k1, CASE WHEN regexp_full_match(key, '\\d+:\\d+:\\d+') THEN CAST(string_split(key, ':')[2] AS BIGINT) END AS k2, CASE WHEN regexp_full_match(key, '\\d+:\\d+:\\d+') THEN CAST(string_split(key, ':')[3] AS BIGINT) END AS k3 FROM k""", "tok")
def f3_parse_key(t: Tables):
    key = F.when(F.col("doc_id") % 10 == 0, F.concat_ws(":", "doc_id", "line_no")).otherwise(F.concat_ws(":", "doc_id", "line_no", "pos"))
    return S.parse_key(t.tok.select(key.alias("key")), "key")


@query("""WITH r AS (SELECT l_orderkey, rid, l_tax > 0.07 AS a, l_quantity > 45 AS b, l_quantity > 40 AS c, l_discount > 0.05 AS d FROM li)
SELECT l_orderkey, rid, 'R9' AS rule, 'tax' AS category, 'stops' AS note, NULL::VARCHAR AS proposed_fix FROM r WHERE a UNION ALL SELECT l_orderkey, rid, 'R1', 'size', 'very large', 'split at ' || rid FROM r WHERE NOT a AND b
UNION ALL SELECT l_orderkey, rid, 'R2', 'size', 'large', 'look' FROM r WHERE NOT a AND NOT b AND c UNION ALL SELECT l_orderkey, rid, 'R4', 'discount', 'deep', NULL FROM r WHERE NOT a AND d""", "li")
def f4_apply_rules(t: Tables):
    rules = [
        {"id": "R9", "category": "tax", "when": F.col("l_tax") > 0.07, "note": "stops", "stop": True},
        {"id": "R1", "category": "size", "when": F.col("l_quantity") > 45, "note": "very large", "chain": "size", "fix": F.concat(F.lit("split at "), "rid")},
        {"id": "R2", "category": "size", "when": F.col("l_quantity") > 40, "note": "large", "chain": "size", "fix": "look"},
        {"id": "R4", "category": "discount", "when": F.col("l_discount") > 0.05, "note": "deep"},
    ]
    return S.apply_rules(t.li, rules).select("l_orderkey", "rid", "rule", "category", "note", "proposed_fix")


@query("""WITH d AS (SELECT l_orderkey AS k, CASE WHEN l_returnflag = 'A' THEN 'label' WHEN l_returnflag = 'N' THEN 'dots' ELSE 'shape' END AS f FROM lineitem), g AS (SELECT k, list_sort(list(DISTINCT f)) AS fs FROM d GROUP BY 1)
SELECT k, array_to_string(fs, ',') AS families, CASE WHEN fs = ['label'] AND k IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') THEN 'label' WHEN NOT list_contains(fs, 'shape') THEN 'auto' ELSE 'judge' END AS lane FROM g""")
def f5_route_lane(t: Tables):
    d = t.lineitem.select(F.col("l_orderkey").alias("k"), F.when(F.col("l_returnflag") == "A", "label").when(F.col("l_returnflag") == "N", "dots").otherwise("shape").alias("f"))
    return S.route_lane(d, "k", "f", ["dots"], t.orders.where("o_orderstatus = 'O'").select("o_orderkey")).withColumn("families", F.array_join("families", ","))


@query("SELECT 'orders' AS \"check\", count(DISTINCT l_orderkey) AS groups, count(*) AS rows, CASE WHEN count(DISTINCT l_orderkey) >= 100 AND count(*) > 0 THEN 'ok' ELSE 'fail' END AS status FROM lineitem")
def f6_guard_coverage(t: Tables):
    return S.guard_coverage(t.lineitem, "l_orderkey", 100, "orders")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE contains(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 'allri') OR contains(regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g'), 'allri') OR contains(p_type, 'all-ri')")
def f7_fuzzy_dim_lookup(t: Tables):
    return S.fuzzy_dim_lookup(t.part, "all-ri", "p_partkey", ["p_name", "p_brand"], "p_type").select("p_partkey", "p_name", "p_brand")


@query("""WITH l AS (SELECT p_partkey AS s, CASE WHEN p_size < 10 THEN 'A+N' WHEN p_size < 30 THEN 'R' ELSE 'A' END AS label FROM part)
SELECT l_partkey, label, count(*) AS n, count(DISTINCT l_orderkey) AS words, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS names FROM lineitem JOIN l ON s = l_partkey WHERE l_returnflag <> label AND NOT list_contains(string_split(label, '+'), l_returnflag) GROUP BY 1, 2""")
def f8_contested(t: Tables):
    labels = t.part.select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") < 10, "A+N").when(F.col("p_size") < 30, "R").otherwise("A").alias("label"))
    return S.contested(t.lineitem, labels, "l_partkey", "l_returnflag", "label", "l_orderkey").withColumn("names", F.array_join("names", ","))


@query("SELECT p_partkey, p_name FROM part WHERE p_size = 7 AND p_name IN (SELECT p_name FROM part WHERE string_split(p_name, ' ')[1] = 'small')")
def f9_mark_selector(t: Tables):
    registry = t.part.select(F.col("p_name").alias("name"), F.element_at(F.split("p_name", " "), 1).alias("family")).distinct()
    return S.mark_selector(t.part, registry, "p_name", "family", "small", p_size=7).select("p_partkey", "p_name")


# Ranks


@query("SELECT l_orderkey, rid, l_extendedprice FROM li ORDER BY l_discount > 0.09 DESC, l_extendedprice DESC, l_orderkey, rid LIMIT 50", "li")
def t1_worst_first(t: Tables):
    return S.worst_first(t.li, 50, [(F.col("l_discount") > 0.09).desc(), F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("rid")]).select("l_orderkey", "rid", "l_extendedprice")


@query("SELECT l_partkey, l_orderkey, rid, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, rid) AS rank FROM li QUALIFY rank <= 3", "li")
def t2_examples_per_group(t: Tables):
    return S.examples_per_group(t.li.select("l_partkey", "l_orderkey", "rid"), "l_partkey", ["l_orderkey", "rid"], 3)


@query("SELECT event_id, user_id, (SELECT count(*) FROM events WHERE event_type = 'click') AS total FROM events WHERE event_type = 'click' ORDER BY event_id LIMIT 40 OFFSET 120")
def t3_page_slice(t: Tables):
    return S.page_slice(t.events.where("event_type = 'click'").select("event_id", "user_id"), ["event_id"], 120, 40)


@query("""WITH g AS (SELECT l_partkey, count(*) AS total, round(avg(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END), 6) AS reviewed_share FROM lineitem GROUP BY 1), b AS (SELECT *, row_number() OVER (ORDER BY l_partkey = 7 DESC, total DESC, l_partkey) AS group_rank FROM g)
SELECT l_partkey, l_suppkey, n, total, reviewed_share, group_rank, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) AS member_rank FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) JOIN b USING (l_partkey)""")
def t4_two_level_rank(t: Tables):
    d = t.lineitem.withColumn("r", F.col("l_linestatus") == "F")
    return S.two_level_rank(d, "l_partkey", "l_suppkey", "r", pinned=7)


FLAGS = "flags AS (SELECT l_orderkey AS key, 'tax' AS source FROM lineitem WHERE l_tax > 0.06 UNION ALL SELECT l_orderkey, 'quantity' FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT o_orderkey, 'priority' FROM orders WHERE o_orderpriority = '1-URGENT')"


def _flags(t: Tables):
    tax = t.lineitem.where("l_tax > 0.06").select(F.col("l_orderkey").alias("key"), F.lit("tax").alias("source"), F.col("l_tax").alias("detail"))
    qty = t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("key"), F.lit("quantity").alias("source"), F.col("l_quantity").alias("detail"))
    return X.union_flags(tax, qty, t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("key"), F.lit("priority").alias("source")))


@query(f"WITH {FLAGS} SELECT key, count(DISTINCT source) AS detectors FROM flags GROUP BY 1")
def t5_rank_by_detectors(t: Tables):
    return S.rank_by_detectors(_flags(t), "key", "source")


# Sets


@query("SELECT l_orderkey AS key, 'tax' AS source, l_tax AS detail FROM lineitem WHERE l_tax > 0.06 UNION ALL SELECT l_orderkey, 'quantity', l_quantity FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT o_orderkey, 'priority', NULL FROM orders WHERE o_orderpriority = '1-URGENT'")
def x1_union_flags(t: Tables):
    return _flags(t)


@query("""WITH a AS (SELECT l_partkey AS k, l_returnflag AS f FROM lineitem WHERE l_linenumber <> 2), b AS (SELECT l_partkey AS k, l_returnflag AS f FROM lineitem WHERE l_linenumber <> 3), d AS (SELECT k, f, sum(s) AS s FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY 1, 2)
SELECT k, f, CASE WHEN s > 0 THEN 'extra' ELSE 'missing' END AS side, CAST(abs(s) AS BIGINT) AS n FROM d WHERE s <> 0""")
def x2_multiset_diff(t: Tables):
    d = lambda n: t.lineitem.where(f"l_linenumber <> {n}").select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("f"))
    return X.multiset_diff(d(2), d(3))


@query("""WITH h AS (SELECT l_orderkey AS k, l_returnflag AS t FROM lineitem), w AS (SELECT l_orderkey AS k, CASE WHEN l_linestatus = 'F' THEN [l_returnflag] WHEN l_returnflag = 'A' THEN ['N', 'R'] ELSE ['A', 'R'] END AS o FROM lineitem),
sp AS (SELECT k, t, hn - coalesce(sn, 0) AS spare FROM (SELECT k, t, count(*) AS hn FROM h GROUP BY 1, 2) LEFT JOIN (SELECT k, o[1] AS t, count(*) AS sn FROM w WHERE len(o) = 1 GROUP BY 1, 2) USING (k, t) WHERE hn - coalesce(sn, 0) > 0),
v AS (SELECT k, o, row_number() OVER (PARTITION BY k ORDER BY o) AS id FROM w WHERE len(o) > 1), tr AS (SELECT v.k, id, i, o[i] AS t, spare FROM v, unnest([1, 2]) AS u(i) JOIN sp ON sp.k = v.k AND sp.t = o[i]),
f1 AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY k, id ORDER BY i) = 1), st AS (SELECT * FROM f1 QUALIFY row_number() OVER (PARTITION BY k, t ORDER BY id) <= spare),
s AS (SELECT k, o[1] AS t FROM w WHERE len(o) = 1 UNION ALL SELECT v.k, coalesce(st.t, o[1]) FROM v LEFT JOIN st ON st.k = v.k AND st.id = v.id), d AS (SELECT k, t, sum(x) AS s FROM (SELECT *, 1 AS x FROM h UNION ALL SELECT *, -1 FROM s) GROUP BY 1, 2)
SELECT k, t, CASE WHEN s > 0 THEN 'extra' ELSE 'missing' END AS side, CAST(abs(s) AS BIGINT) AS n FROM d WHERE s <> 0""")
def x3_ambiguous_multiset_diff(t: Tables):
    opts = F.when(F.col("l_linestatus") == "F", F.array("l_returnflag")).when(F.col("l_returnflag") == "A", F.array(F.lit("N"), F.lit("R"))).otherwise(F.array(F.lit("A"), F.lit("R")))
    return X.ambiguous_multiset_diff(t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("t")), t.lineitem.select(F.col("l_orderkey").alias("k"), opts.alias("o")), "k", "t", "o")


@query("""WITH b AS (SELECT user_id AS g, event_type AS f FROM events WHERE event_type <> 'error'), c AS (SELECT user_id AS g, event_type AS f FROM events WHERE value > 20), cm AS (SELECT g FROM b INTERSECT SELECT g FROM c),
j AS (SELECT g, f, count(*) FILTER (s = 0) AS b, count(*) FILTER (s = 1) AS a FROM (SELECT *, 0 AS s FROM b UNION ALL SELECT *, 1 FROM c) WHERE g IN (SELECT g FROM cm) GROUP BY 1, 2), d AS (SELECT *, a - b AS d, sum(a - b) OVER (PARTITION BY g) AS s FROM j)
SELECT f, CAST(sum(b) AS BIGINT) AS before, CAST(sum(a) AS BIGINT) AS after, CAST(sum(d) AS BIGINT) AS delta, count(*) FILTER (a = 0) AS clean, count(*) FILTER (d > 0 AND s > 0) AS worse_on_sum, count(*) FILTER (d > 0 AND s <= 0) AS worse_on_one FROM d GROUP BY 1""")
def x4_diff_runs(t: Tables):
    """A run that doesn't know errors against one that only knows large values."""
    e = t.events.select(F.col("user_id").alias("g"), F.col("event_type").alias("f"), "value")
    return X.diff_runs(e.where("f <> 'error'").drop("value"), e.where("value > 20").drop("value"), "g", "f")


@query("""WITH a AS (SELECT p_partkey AS k, md5(p_name) AS h FROM part WHERE p_partkey % 10 <> 1), b AS (SELECT p_partkey AS k, md5(CASE WHEN p_size = 3 THEN upper(p_name) ELSE p_name END) AS h FROM part WHERE p_partkey % 10 <> 2)
SELECT k, CASE WHEN a.h IS NULL THEN 'added' WHEN b.h IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b USING (k) WHERE a.h IS DISTINCT FROM b.h""")
def x5_snapshot_equal(t: Tables):
    a = t.part.where("p_partkey % 10 <> 1").select(F.col("p_partkey").alias("k"), F.md5("p_name").alias("h"))
    b = t.part.where("p_partkey % 10 <> 2").select(F.col("p_partkey").alias("k"), F.md5(F.when(F.col("p_size") == 3, F.upper("p_name")).otherwise(F.col("p_name"))).alias("h"))
    return X.snapshot_equal(a, b, "k", "h")


@query("""WITH p AS (SELECT doc_id, line_no, pos, list_distinct(string_split(token, '')) AS a, list_distinct(string_split(replace(replace(replace(token, '.', ''), ',', ''), 'th', ''), '')) AS b FROM tok), d AS (SELECT doc_id, line_no, pos, list_concat(list_filter(a, lambda x: NOT list_contains(b, x)), list_filter(b, lambda x: NOT list_contains(a, x) AND x <> '')) AS d FROM p),
c AS (SELECT CASE WHEN len(d) = 0 THEN 'order' WHEN len(list_filter(d, lambda x: x NOT IN ('.', ','))) = 0 THEN 'points' WHEN len(list_filter(d, lambda x: x NOT IN ('t', 'h'))) = 0 THEN 'letters' ELSE 'other' END AS class FROM d) SELECT class, count(*) AS n FROM c GROUP BY 1""", "tok")
def x6_char_set_class(t: Tables):
    b = F.regexp_replace(F.translate("token", ".,", ""), "th", "")
    return t.tok.select(X.char_set_class(F.col("token"), b, [("points", ".,"), ("letters", "th")]).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
