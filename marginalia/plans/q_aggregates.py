"""Queries of the aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions import text as U
from marginalia.operators import aggregates as A
from marginalia.operators import shifts as Z

from .base import query
from .views import Tables

FAMILIES = {"a": ("open", 1), "e": ("mid", 1), "o": ("mid", 1), "w": ("double", 2), "!": ("shout", 1)}
#: Median of sorted values at n // 2, as SQL over a list.
HI = "list_sort(list({0}))[CAST(floor(count({0}) / 2) AS INT) + 1]"


@query("""SELECT doc_id, family, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT doc_id, unnest(['open','mid','double','shout']) AS family,
    unnest([length(text)-length(replace(text,'a','')), 2*length(text)-length(replace(text,'e',''))-length(replace(text,'o','')), 2*(length(text)-length(replace(text,'w',''))), length(text)-length(replace(text,'!',''))]) AS n FROM documents WHERE text IS NOT NULL)
  GROUP BY 1, 2 HAVING sum(n) > 0""")
def a1_family_counts(t: Tables):
    return A.family_counts(t.documents, "doc_id", "text", FAMILIES)


@query("""WITH h AS (SELECT l_orderkey AS k, l_returnflag AS fam, count(*) AS n FROM lineitem GROUP BY 1, 2),
w AS (SELECT o_orderkey AS k, unnest(['A','N','R']) AS fam, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS lo, 2 AS hi FROM orders)
SELECT k, fam, CAST(coalesce(n,0) AS BIGINT) AS have, CAST(coalesce(lo,0) AS BIGINT) AS lo, CAST(coalesce(hi,0) AS BIGINT) AS hi FROM h FULL JOIN w USING (k, fam)
WHERE (coalesce(n,0) < coalesce(lo,0) OR coalesce(n,0) > coalesce(hi,0)) AND NOT (coalesce(n,0)=0 AND coalesce(hi,0)=0)""")
def a2_budget_check(t: Tables):
    have = t.lineitem.groupBy(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("fam")).agg(F.count(F.lit(1)).alias("n"))
    want = t.orders.select(F.col("o_orderkey").alias("k"), F.explode(F.array(*map(F.lit, "ANR"))).alias("fam"), F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("lo"), F.lit(2).alias("hi"))
    return A.budget_check(have, want, ["k", "fam"])


@query("SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 25")
def a3_most_common(t: Tables):
    return A.most_common(t.lineitem.select(F.col("l_partkey").alias("value")), "value", 25)


@query("""WITH c AS (SELECT p_brand, l_shipmode, n, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, l_shipmode) AS r, sum(n) OVER (PARTITION BY p_brand) AS t, count(*) OVER (PARTITION BY p_brand) AS k
  FROM (SELECT p_brand, l_linenumber AS l_shipmode, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2))
SELECT p_brand, CAST(max(CASE WHEN r=1 THEN l_shipmode END) AS BIGINT) AS mode, CAST(max(CASE WHEN r=1 THEN n END) AS BIGINT) AS n, CAST(max(t) AS BIGINT) AS total, round(max(CASE WHEN r=1 THEN n END) / max(t), 6) AS share, max(k) AS kinds,
  array_to_string(list(l_shipmode ORDER BY r) FILTER (r BETWEEN 2 AND 4), ',') AS alternatives FROM c GROUP BY 1""")
def a4_modal(t: Tables):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return A.modal(d, "p_brand", "l_linenumber").withColumn("alternatives", F.array_join(F.col("alternatives").cast("array<string>"), ","))


@query("""WITH c AS (SELECT l_partkey AS g, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
m AS (SELECT g, arg_max(v, (n, -ascii(v))) AS mode, max(n) / sum(n) AS share, sum(n) AS total FROM c GROUP BY 1)
SELECT l_orderkey, l_partkey, l_returnflag, mode, round(share, 6) AS share FROM lineitem JOIN m ON l_partkey = g WHERE total >= 20 AND l_returnflag <> mode""")
def a5_minority_use(t: Tables):
    return A.minority_use(t.lineitem, "l_partkey", "l_returnflag", 20).select("l_orderkey", "l_partkey", "l_returnflag", "mode", "share")


@query("""WITH x AS (SELECT form, grp, rid AS pos, unnest(['runs','n']) AS axis, unnest([CAST(runs AS DOUBLE), CAST(n AS DOUBLE)]) AS value FROM form),
c AS (SELECT form, axis, value, count(*) AS k FROM x GROUP BY ALL),
m AS (SELECT *, sum(k) OVER (PARTITION BY form, axis) AS tot, first_value(value) OVER (PARTITION BY form, axis ORDER BY k DESC, value) AS mode FROM c),
dd AS (SELECT x.*, x.value - m.mode AS dev, k FROM x JOIN m USING (form, axis, value) WHERE tot >= 20 AND value <> mode), d AS (SELECT * FROM dd WHERE k <= 1)
SELECT form, axis, value, grp, pos, dev, CASE WHEN EXISTS (SELECT 1 FROM dd o WHERE o.grp = d.grp AND abs(o.pos - d.pos) <= 2 AND o.pos <> d.pos AND sign(o.dev) = -sign(d.dev)) THEN 'PAIRED' WHEN axis = 'runs' THEN 'REVIEW' ELSE 'HAPAX' END AS grade FROM d""", "form")
def a6_hapax_deviation(t: Tables):
    return A.hapax_deviation(t.form_by_order.withColumnRenamed("rid", "pos"), "form", ["runs", "n"], "grp", "pos", review=("runs",), counted=t.form).select("form", "axis", "value", "grp", "pos", "dev", "grade")


@query(f"SELECT l_partkey, {HI.format('l_extendedprice')} AS median, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 10")
def a7_median_hi(t: Tables):
    return A.median_hi(t.lineitem, "l_partkey", "l_extendedprice", 10)


@query(f"""WITH s AS (SELECT l_partkey AS g, {HI.format('l_extendedprice')} AS m FROM lineitem GROUP BY 1 HAVING count(*) >= 10), f AS (SELECT l_returnflag AS g, {HI.format('l_extendedprice')} AS m FROM lineitem GROUP BY 1)
SELECT l_orderkey, rid, coalesce(s.m, f.m) AS median, s.m IS NOT NULL AS by_signature FROM li LEFT JOIN s ON s.g = l_partkey LEFT JOIN f ON f.g = l_returnflag""", "li")
def a7_preferred_median(t: Tables):
    return A.preferred_median(t.li, "l_extendedprice", "l_partkey", "l_returnflag").select("l_orderkey", "rid", "median", "by_signature")


@query(f"""WITH m AS (SELECT l_partkey AS g, {HI.format('l_extendedprice')} AS median FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_partkey, round(l_extendedprice, 6) AS l_extendedprice, round(median, 6) AS median, round(l_extendedprice / median, 6) AS ratio FROM lineitem JOIN m ON g = l_partkey
WHERE median <> 0 AND (l_extendedprice / median < 0.7 OR l_extendedprice / median > 1.45) AND abs(l_extendedprice - median) >= 4""")
def a8_ratio_outlier(t: Tables):
    return A.ratio_outlier(t.lineitem, "l_partkey", "l_extendedprice", 0.7, 1.45, 4.0).select("l_orderkey", "l_partkey", "l_extendedprice", "median", "ratio")


@query("SELECT l_returnflag, l_linestatus, list_sort(list(l_extendedprice))[CAST(least(count(*) - 1, floor(count(*) * 0.9)) AS INT) + 1] AS quantile, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a9_index_quantile(t: Tables):
    return A.index_quantile(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.9, few=True)


@query("""WITH e AS (SELECT unnest([0.0,10.0,20.0,20.5,30.0,45.0,60.0,80.0]) AS lo, unnest([10.0,20.0,20.5,30.0,45.0,60.0,80.0,90.0]) AS hi)
SELECT CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count(l_quantity) AS n FROM e LEFT JOIN lineitem ON l_quantity >= lo AND l_quantity < hi GROUP BY 1, 2""")
def a10_histogram(t: Tables):
    return A.histogram(t.lineitem, "l_quantity", [0, 10, 20, 20.5, 30, 45, 60, 80, 90])


@query("SELECT CAST(least(40, floor(l_quantity)) AS BIGINT) AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
def a10_capped_histogram(t: Tables):
    return A.capped_histogram(t.lineitem, "l_quantity", 40)


@query("""WITH x AS (SELECT o_totalprice AS v FROM orders ORDER BY v DESC LIMIT 400), g AS (SELECT v AS above, lead(v) OVER (ORDER BY v DESC) AS below FROM x)
SELECT above, below, below <= 400000 AND above >= 400000 AS holds_limit FROM g WHERE above - below > 100""")
def a11_empty_bands(t: Tables):
    return A.empty_bands(t.orders, "o_totalprice", 100.0, 400000.0)


@query("""SELECT user_id, round(CASE WHEN coalesce(bool_or(value > 95), false) THEN 1.0 ELSE 1 - exp(sum(ln(1 - least(greatest(value / 1000, 0), 0.999999)))) END, 6) AS p FROM events GROUP BY 1""")
def a12_noisy_or(t: Tables):
    return A.noisy_or(t.events, "user_id", F.col("value") / 1000, F.col("value") > 95)


def _evidence(t: Tables):
    """Orders as words and their lines as marks: size of a line against its part's or flag's median, distance, band, label, surplus of a
    flag; dots (open lines of a finished order), flag budgets, width (quantity a line) and a second total as evidence of the order."""
    marks = A.preferred_median(t.li.withColumn("area", F.col("l_extendedprice") + 20000), "area", "l_partkey", "l_returnflag")
    flags = t.li.groupBy(F.col("l_orderkey").alias("_k"), F.col("l_returnflag").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    m = marks.join(flags, (F.col("l_orderkey") == F.col("_k")) & (F.col("l_returnflag") == F.col("_g")))
    none, sure = F.lit(0.0), F.lit(False)
    part = lambda name, p, proof=sure: F.struct(F.lit(name).alias("name"), F.round(p, 9).alias("p"), proof.alias("proof"))
    label = F.when(F.col("l_linenumber") == 7, "none").when(F.col("l_linenumber") >= 5, "auto").otherwise("human")
    of_marks = F.array(
        part("size", *U.p_size(F.col("area") / F.col("median"), F.col("by_signature") & (F.col("l_returnflag") != "N"))),
        part("stray", *U.p_stray(F.greatest(F.col("l_quantity") - 42, F.lit(0.0)) * 6)), part("band", *U.p_band(F.col("l_tax") * 150)),
        part("label", U.p_label(label)), part("surplus", F.when(F.col("_n") > 2, U.WEIGHTS["surplus"]).otherwise(none)),
    )
    of_marks = m.select(F.col("l_orderkey").alias("key"), F.col("rid").alias("child"), F.explode(of_marks).alias("s")).select("key", "child", "s.*")
    words = t.li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_linestatus") == "O").alias("open"), F.sum("l_quantity").alias("q"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )
    w = words.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    over = flags.where("_n > 2").select(F.col("_k").alias("key"), F.lit("family").alias("name"), F.lit(U.WEIGHTS["family"]).alias("p"), sure.alias("proof"))
    flag = lambda name, c: part(name, F.when(c, U.WEIGHTS[name]).otherwise(none))
    of_words = F.array(
        flag("dots", (F.col("o_orderstatus") == "F") & (F.col("open") > 2)), flag("ref-line", F.col("total") > F.col("o_totalprice") * 6),
        part("width", U.p_width(F.col("q") / (25 * F.col("n")), F.abs(F.col("q") - 25 * F.col("n")))),
    )
    of_words = w.select(F.col("l_orderkey").alias("key"), F.explode(of_words).alias("s")).select("key", "s.*").unionByName(over)
    return of_marks.unionByName(of_words.withColumn("child", F.lit(None).cast("long")))


#: The same from the published numbers, in SQL of its own.
EVIDENCE = f"""li2 AS (SELECT *, l_extendedprice + 20000 AS area FROM li),
ms AS (SELECT l_partkey AS g, {HI.format('area')} AS m FROM li2 GROUP BY 1 HAVING count(*) >= 10), mf AS (SELECT l_returnflag AS g, {HI.format('area')} AS m FROM li2 GROUP BY 1),
fl AS (SELECT l_orderkey AS k, l_returnflag AS g, count(*) AS n FROM li GROUP BY 1, 2),
mk AS (SELECT l_orderkey AS key, rid, area / coalesce(ms.m, mf.m) AS r, ms.m IS NOT NULL AND l_returnflag <> 'N' AS ok, greatest(l_quantity - 42, 0) * 6 AS gap, l_tax * 150 AS d, l_linenumber AS no, fl.n AS same
  FROM li2 LEFT JOIN ms ON ms.g = l_partkey LEFT JOIN mf ON mf.g = l_returnflag JOIN fl ON fl.k = l_orderkey AND fl.g = l_returnflag),
mp AS (SELECT key, rid, ok AND (r >= 3 OR r <= 1 / 3.0::DOUBLE) OR gap >= 40 OR d >= 15 AS proof,
  [CASE WHEN r >= 3 OR r <= 1 / 3.0::DOUBLE THEN 0.6 WHEN r > 2 THEN 0.15 + 0.45 * (r - 2) WHEN r < 0.5 THEN 0.15 + 0.45 * (1 / r - 2) ELSE 0 END,
   CASE WHEN gap > 2 AND gap < 40 THEN 0.05 + 0.6 * (gap - 2) / 38 ELSE 0 END,
   CASE WHEN d > 10 AND d < 15 THEN 0.35 + 0.35 * (d - 10) / 5 WHEN d > 5 AND d <= 10 THEN 0.05 ELSE 0 END,
   CASE WHEN no = 7 THEN 0.15 WHEN no >= 5 THEN 0.03 ELSE 0 END, CASE WHEN same > 2 THEN 0.35 ELSE 0 END] AS ps FROM mk),
mq AS (SELECT key, rid, proof, CASE WHEN proof THEN 1.0 ELSE round(1 - exp(list_sum([ln(1 - round(x, 9)) for x in ps])), 9) END AS p FROM mp),
wd AS (SELECT l_orderkey AS key, count(*) AS n, count(*) FILTER (l_linestatus = 'O') AS op, sum(l_quantity) AS q, round(sum(l_extendedprice), 2) AS total FROM li GROUP BY 1),
wr AS (SELECT wd.*, o_orderstatus AS st, o_totalprice AS tp, q / (25 * n) AS r, abs(q - 25 * n) AS off FROM wd JOIN orders ON o_orderkey = key),
wp AS (SELECT key, 'dots' AS name, CASE WHEN st = 'F' AND op > 2 THEN 0.8 ELSE 0 END AS p FROM wr UNION ALL SELECT key, 'ref', CASE WHEN total > tp * 6 THEN 0.6 ELSE 0 END FROM wr
  UNION ALL SELECT k, 'family', 0.55 FROM fl WHERE n > 2
  UNION ALL SELECT key, 'width', round(CASE WHEN off < 4 OR r BETWEEN 0.70 AND 1.45 THEN 0 WHEN greatest(r, 1 / r) >= 2 THEN 0.85 ELSE 0.20 + 0.40 * (greatest(greatest(r, 1 / r), 1.45) - 1.45) / 0.55 END, 9) FROM wr),
ev AS (SELECT key, name, p, false AS proof FROM wp UNION ALL SELECT key, 'mark', CASE WHEN p >= 0.15 OR proof THEN p ELSE 0 END, proof FROM mq),
sc AS (SELECT key, bool_or(proof) AS sure, 1 - exp(sum(ln(1 - least(p, 0.999999)))) AS soft, bool_and(name = 'width') FILTER (p > 0) AS alone, count(*) FILTER (p > 0) AS signals FROM ev GROUP BY 1),
scored AS (SELECT key, sure, CASE WHEN sure THEN 1.0 WHEN coalesce(alone, false) THEN least(soft, 0.45) ELSE soft END AS p, signals FROM sc)"""
TIER = "CASE WHEN sure THEN 'certain' WHEN round(p, 9) >= 0.5 THEN 'high' WHEN round(p, 9) >= 0.2 THEN 'review' ELSE 'clean' END AS tier"


@query(f"WITH {EVIDENCE} SELECT key, round(p + 1e-9, 4) AS p, {TIER}, signals FROM scored", "li")
def a13_score_entity(t: Tables):
    return A.score_entity(_evidence(t), "key", child="child").select("key", F.round(F.col("p") + 1e-9, 4).alias("p"), "tier", F.size("evidence").alias("signals"))


@query("SELECT grp, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1, min(x0) FILTER (fam='A') AS kind_x0, max(x1) FILTER (fam='A') AS kind_x1, min(y0) FILTER (fam='A') AS kind_y0, max(y1) FILTER (fam='A') AS kind_y1 FROM ivl GROUP BY 1", "ivl")
def a14_box_union(t: Tables):
    return A.box_union(t.ivl, "grp", F.col("fam") == "A")


@query("SELECT o_custkey, count(*) AS n, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_key, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS kinds FROM orders GROUP BY 1")
def a15_group_summary(t: Tables):
    return A.group_summary(t.orders, "o_custkey", "o_orderkey", ["o_orderdate", "o_orderkey"], "o_orderstatus").withColumn("kinds", F.array_join("kinds", ","))


@query("""WITH f AS (SELECT o_custkey, o_orderstatus AS k, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS v FROM orders GROUP BY 1, 2)
SELECT o_custkey, string_agg(k || '=' || v, ',' ORDER BY k) AS divisions FROM f GROUP BY 1""")
def a15_division_map(t: Tables):
    d = A.division_map(t.orders, "o_custkey", "o_orderstatus", "o_orderkey", ["o_orderdate", "o_orderkey"])
    each = F.transform(F.array_sort(F.map_entries("divisions")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return d.select("o_custkey", F.array_join(each, ",").alias("divisions"))


@query("SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def a16_first_seen(t: Tables):
    return A.first_seen(t.events, ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])


@query("""WITH g AS (SELECT doc_id, line_no, pos, CASE WHEN lag(line_no) OVER w IS NULL THEN '' WHEN lag(line_no) OVER w = line_no THEN ' ' ELSE chr(10) END || token AS x FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY line_no, pos))
SELECT doc_id, md5(string_agg(x, '' ORDER BY line_no, pos)) AS digest FROM g GROUP BY 1""", "tok")
def a17_ordered_text(t: Tables):
    return A.ordered_text(t.tok, "doc_id", ["line_no", "pos"], "token", "line_no").select("doc_id", F.md5("text").alias("digest"))


@query("""WITH e AS (SELECT o_orderkey AS l_orderkey, 5 AS n, o_orderstatus = 'P' AS cut FROM orders), c AS (SELECT l_orderkey, l_linenumber AS v, count(*) AS k FROM lineitem GROUP BY 1, 2),
g AS (SELECT e.l_orderkey, any_value(cut) AS cut, count(v) AS there, count(*) FILTER (k > 1) AS duplicates, 5 - count(*) FILTER (v BETWEEN 1 AND 5) AS missing, count(*) FILTER (v > 5) AS extra, count(*) FILTER (v = 1) AS one FROM e LEFT JOIN c USING (l_orderkey) GROUP BY 1)
SELECT l_orderkey, duplicates, CASE WHEN cut AND one = 0 AND there > 0 THEN 0 ELSE missing END AS missing, extra, cut AND one = 0 AND there > 0 AS partial FROM g""")
def a18_partial_groups(t: Tables):
    expected = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(5).alias("n_expected"), (F.col("o_orderstatus") == "P").alias("cut"))
    return A.completeness(t.lineitem, "l_orderkey", "l_linenumber", expected, cut="cut")


@query("""WITH e AS (SELECT o_orderkey AS l_orderkey, 5 AS n FROM orders), c AS (SELECT l_orderkey, l_linenumber AS v, count(*) AS k FROM lineitem GROUP BY 1, 2)
SELECT e.l_orderkey, count(*) FILTER (k > 1) AS duplicates, 5 - count(*) FILTER (v BETWEEN 1 AND 5) AS missing, count(*) FILTER (v > 5) AS extra FROM e LEFT JOIN c USING (l_orderkey) GROUP BY 1""")
def a18_completeness(t: Tables):
    return A.completeness(t.lineitem, "l_orderkey", "l_linenumber", t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(5).alias("n_expected")))


@query("""SELECT b.p_brand, b.n + coalesce(CAST(sum(CASE WHEN list_contains(string_split(lower(p_type), ' '), 'small') AND p_size > 25 THEN 1 WHEN NOT list_contains(string_split(lower(p_type), ' '), 'small') AND p_size <= 25 THEN -1 ELSE 0 END) AS BIGINT), 0) AS expected
FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) b LEFT JOIN part USING (p_brand) GROUP BY b.p_brand, b.n""")
def a19_expected_counts(t: Tables):
    base = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    adjust = t.part.select("p_brand", F.split(F.lower("p_type"), " ").alias("counted_by"), (F.col("p_size") <= 25).alias("in_base"))
    return A.expected_counts(base, adjust, "p_brand", "small")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_linestatus, l_returnflag) AS level FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_returnflag, l_linestatus), ())")
def a20_grouped_tallies(t: Tables):
    return A.grouped_tallies(t.lineitem, [["l_returnflag"], ["l_linestatus", "l_returnflag"], []]).select("l_returnflag", "l_linestatus", "n", "level")


@query("""WITH x AS (SELECT l_quantity * p_retailprice AS e, l_extendedprice AS a, l_extendedprice * (1 - l_discount) AS b FROM lineitem JOIN part ON l_partkey = p_partkey),
l AS (SELECT unnest(['a','b']) AS side, round(unnest([abs(ln(a/e)), abs(ln(b/e))]), 9) AS v FROM x WHERE a > 0 AND b > 0 AND e > 0),
s AS (SELECT side, avg(v) AS mean, count(*) FILTER (v > ln(1.5)) AS beyond_15, count(*) FILTER (v > ln(2.0)) AS beyond_2, count(*) AS n, list_sort(list(v))[CAST(least(count(*) - 1, floor(count(*) * 0.9)) AS INT) + 1] AS p90 FROM l GROUP BY 1)
SELECT side, round(mean, 6) AS mean, beyond_15, beyond_2, n, round(p90, 6) AS p90, CASE WHEN abs(sum(mean) OVER () - 2 * mean) < 1e-9 THEN 'equal' WHEN mean < sum(mean) OVER () - mean THEN 'better' ELSE 'worse' END AS verdict FROM s""")
def a21_two_sided_score(t: Tables):
    return A.two_sided_score(_sides(t), "a", "b", "e")


@query("""WITH x AS (SELECT l_orderkey, rid, l_quantity * p_retailprice AS e, l_extendedprice AS a, l_extendedprice * (1 - l_discount) AS b FROM li JOIN part ON l_partkey = p_partkey),
y AS (SELECT *, round(abs(ln(a / e)), 9) > ln(1.5) AS fa, round(abs(ln(b / e)), 9) > ln(1.5) AS fb FROM x WHERE a > 0 AND b > 0 AND e > 0)
SELECT l_orderkey, rid, CASE WHEN fa THEN 'a' ELSE 'b' END AS side, round(CASE WHEN fa THEN a ELSE b END / e, 6) AS ratio, round(CASE WHEN fa THEN b ELSE a END / e, 6) AS other FROM y WHERE fa <> fb""", "li")
def a21_one_sided_keys(t: Tables):
    return A.one_sided_keys(_sides(t), ["l_orderkey", "rid"], "a", "b", "e")


def _sides(t: Tables):
    return t.li.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "rid", (F.col("l_quantity") * F.col("p_retailprice")).alias("e"), F.col("l_extendedprice").alias("a"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("b"))


@query("""WITH tr AS (SELECT doc_id, length(text) - length(replace(text, 'e', '')) AS n FROM documents WHERE text IS NOT NULL),
c AS (SELECT 'lower' AS name, doc_id, length(lower(text)) - length(replace(lower(text), 'e', '')) AS n FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 'plain', doc_id, length(text) - length(replace(translate(text, 'éèêë', 'eeee'), 'e', '')) FROM documents
  WHERE text IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels))
SELECT name, count(*) FILTER (c.n = tr.n) AS exact, count(*) FILTER (c.n <> tr.n) AS differs, (SELECT count(*) FROM tr) - count(*) FILTER (tr.n IS NOT NULL) AS no_text, round(count(*) FILTER (c.n = tr.n) / greatest(count(*) FILTER (tr.n IS NOT NULL), 1), 6) AS rate FROM c LEFT JOIN tr USING (doc_id) GROUP BY 1""")
def a22_source_scoreboard(t: Tables):
    d = t.documents.where("text is not null")
    n = lambda c: (F.length(c) - F.length(F.replace(c, F.lit("e"), F.lit("")))).alias("n")
    labelled = d.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi")
    cands = d.select(F.lit("lower").alias("name"), "doc_id", n(F.lower("text")))
    cands = cands.unionByName(labelled.select(F.lit("plain").alias("name"), "doc_id", n(F.translate("text", "éèêë", "eeee"))))
    return A.source_scoreboard(cands, d.select("doc_id", n(F.col("text"))), ["doc_id"])


CLASSES = {"vowels": "aeiou", "accents": "éèêë", "stops": ".!?", "capitals": "A-Z"}
CLASS_SQL = """tr AS (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL),
c AS (SELECT 'lower' AS name, doc_id, lower(t) AS x FROM tr UNION ALL SELECT 'plain', doc_id, translate(t, 'éèêë', 'eeee') FROM tr JOIN (SELECT DISTINCT doc_id FROM labels) USING (doc_id)
  UNION ALL SELECT 'mixed', doc_id, regexp_replace(lower(t), '[A-Z]', '', 'g') || regexp_replace(t, '[^A-Z]', '', 'g') FROM tr),
k AS (SELECT name, c.doc_id, u.f AS family, length(regexp_replace(x, u.neg, '', 'g')) AS got, length(regexp_replace(t, u.neg, '', 'g')) AS want FROM c JOIN tr USING (doc_id),
  (VALUES ('vowels', '[^aeiou]'), ('accents', '[^éèêë]'), ('stops', '[^.!?]'), ('capitals', '[^A-Z]')) u(f, neg) WHERE x <> '')"""


def _candidates(t: Tables):
    d = t.documents.where("text is not null").select("doc_id", "text")
    labelled = d.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi")
    of = lambda n, rows, c: rows.select(F.lit(n).alias("name"), "doc_id", c.alias("text"))
    c = of("lower", d, F.lower("text")).unionByName(of("plain", labelled, F.translate("text", "éèêë", "eeee")))
    return d, c.unionByName(of("mixed", d, A.composite_text(F.lower("text"), F.col("text"), "A-Z")))


@query(f"""WITH {CLASS_SQL}, g AS (SELECT name, doc_id, bool_and(got = want) AS same, bool_or(family = 'vowels' AND got <> want) AS v, bool_or(family = 'accents' AND got <> want) AS a, bool_or(family = 'stops' AND got <> want) AS s, bool_or(family = 'capitals' AND got <> want) AS cap FROM k GROUP BY 1, 2)
SELECT name, count(*) FILTER (same) AS exact, count(*) FILTER (NOT same) AS differs, (SELECT count(*) FROM tr) - count(*) AS no_text, round(count(*) FILTER (same) / count(*), 6) AS rate,
  count(*) FILTER (v) AS vowels, count(*) FILTER (a) AS accents, count(*) FILTER (s) AS stops, count(*) FILTER (cap) AS capitals FROM g GROUP BY 1""")
def a22_family_scoreboard(t: Tables):
    truth, candidates = _candidates(t)
    return A.family_scoreboard(A.family_errors(candidates, truth, ["doc_id"], CLASSES), truth, CLASSES)


@query(f"WITH {CLASS_SQL} SELECT name, family, doc_id, got, want FROM k WHERE got <> want QUALIFY row_number() OVER (PARTITION BY name, family ORDER BY doc_id) <= 40")
def a22_family_examples(t: Tables):
    truth, candidates = _candidates(t)
    return A.family_examples(A.family_errors(candidates, truth, ["doc_id"], CLASSES), ["doc_id"]).drop("text", "truth")


@query("""SELECT *, round(k_in / n_in, 6) AS rate_in, round(k_out / n_out, 6) AS rate_out, round((k_in / n_in) / (k_out / n_out), 6) AS lift FROM (SELECT count(*) FILTER (l_quantity > 40) AS n_in, count(*) FILTER (NOT l_quantity > 40) AS n_out, count(*) FILTER (l_quantity > 40 AND l_returnflag = 'R') AS k_in, count(*) FILTER (NOT l_quantity > 40 AND l_returnflag = 'R') AS k_out FROM lineitem)""")
def a23_confusion_by_split(t: Tables):
    return A.confusion_by_split(t.lineitem, F.col("l_returnflag") == "R", F.col("l_quantity") > 40)


@query("SELECT parts, count(*) AS entities, max(spans) AS most_spans FROM (SELECT l_orderkey, count(*) AS parts, count(DISTINCT l_suppkey) AS spans FROM lineitem GROUP BY 1) GROUP BY 1")
def a24_fragment_histogram(t: Tables):
    return A.fragment_histogram(t.lineitem, "l_orderkey", "l_suppkey")


@query(f"""WITH r AS (SELECT l_partkey AS g, l_quantity AS x, l_extendedprice / 1000 AS y, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity, l_extendedprice / 1000) AS i, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem),
s AS (SELECT a.g, median((b.y - a.y) / (b.x - a.x)) AS s, count(*) AS k FROM r a JOIN r b ON a.g = b.g AND b.i = a.n + 1 - a.i AND b.x - a.x > 20 WHERE a.i * 2 <= a.n GROUP BY 1),
f AS (SELECT z.g, z.n, CASE WHEN z.n >= 8 AND k >= 4 AND s > 0.6 AND s < 2.0 THEN s ELSE 0.75 END AS slope, coalesce(z.n >= 8 AND k >= 4 AND s > 0.6 AND s < 2.0, false) AS fitted FROM (SELECT DISTINCT g, n FROM r) z LEFT JOIN s USING (g)),
v AS (SELECT r.g, round(y - slope * x, 9) AS e FROM r JOIN f USING (g)), o AS (SELECT g, {HI.format('e')} AS offset_ FROM v GROUP BY 1),
w AS (SELECT v.g, round(abs(e - offset_), 9) AS a FROM v JOIN o USING (g)), p AS (SELECT g, {HI.format('a')} AS spread FROM w GROUP BY 1)
SELECT g, n, round(slope, 6) AS slope, fitted, round(offset_, 6) AS offset, round(spread, 6) AS spread FROM f JOIN o USING (g) JOIN p USING (g)""")
def a25_theil_slope(t: Tables):
    d = t.lineitem.select(F.col("l_partkey").alias("g"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    return A.theil_slope(d, "g", "x", "y", accept=(0.6, 2.0))


@query(f"""WITH d AS (SELECT l_partkey AS g, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem),
f AS (SELECT g, count(*) AS n, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM d GROUP BY 1 HAVING count(*) >= 12),
r AS (SELECT d.*, round(abs(y - s * x - i), 9) AS e FROM d JOIN f USING (g)), m AS (SELECT g, {HI.format('e')} AS md FROM r GROUP BY 1),
k AS (SELECT r.* FROM r JOIN m USING (g) WHERE e <= greatest(1.0, md * 6.0)), f2 AS (SELECT g, count(*) AS n2, regr_slope(y, x) AS s2, regr_intercept(y, x) AS i2 FROM k GROUP BY 1 HAVING count(*) >= 12)
SELECT f.g, coalesce(n2, n) AS n, round(coalesce(s2, s), 6) AS slope, round(coalesce(i2, i), 6) AS intercept FROM f LEFT JOIN f2 USING (g)""")
def a26_ols_refit(t: Tables):
    d = t.lineitem.select(F.col("l_partkey").alias("g"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    return A.ols_refit(d, "g", "x", "y")


@query("""WITH b AS (SELECT *, count(*) OVER (PARTITION BY grp, s) AS k FROM (SELECT grp, round(x1 - x0, 0) AS s, x0, y0 FROM ivl WHERE rid % 2 = 0)),
v AS (SELECT a.grp, round(b.x0 - a.x0, 0) + 0.0 AS dx, round(b.y0 - a.y0, 0) + 0.0 AS dy, count(*) AS votes FROM ivl a JOIN b ON a.grp = b.grp AND round(a.x1 - a.x0, 0) = b.s AND k <= 3 WHERE a.rid % 2 = 1 GROUP BY 1, 2, 3)
SELECT grp, dx, dy, votes FROM v QUALIFY row_number() OVER (PARTITION BY grp ORDER BY votes DESC, dx, dy) = 1""", "ivl")
def a27_modal_shift(t: Tables):
    d = t.ivl.withColumn("size", F.col("x1") - F.col("x0"))
    return A.modal_shift(d.where("rid % 2 = 1"), d.where("rid % 2 = 0"), "grp", "x0", "y0", "size")


SHIFTS = """WITH e AS (SELECT l_orderkey AS grp, round(l_quantity * 8 + l_orderkey % 50, 3) AS x, round(floor(l_extendedprice / 5) / 100 - l_orderkey % 30, 3) AS y FROM lineitem),
m AS (SELECT DISTINCT l_orderkey AS grp, round(l_quantity * 8 + l_discount * (CASE WHEN l_linenumber = 6 THEN 40 ELSE 8 END), 3) AS x, round(floor(l_extendedprice / 5) / 100 + l_tax * 8, 3) AS y FROM lineitem WHERE l_linestatus = 'F'),
mn AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY x, y) AS i, count(*) OVER (PARTITION BY grp) AS all_m FROM m), en AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY x, y) AS j FROM (SELECT DISTINCT * FROM e)),
c AS (SELECT mn.grp, i, j, en.x - mn.x AS dx, en.y - mn.y AS dy, all_m FROM mn JOIN en USING (grp)),
n AS (SELECT c.grp, c.i, c.j, any_value(dx) AS dx, any_value(dy) AS dy, any_value(c.all_m) AS all_m, count(DISTINCT k.i) AS hit FROM c JOIN mn k ON k.grp = c.grp JOIN en f ON f.grp = c.grp AND abs(f.x - (k.x + dx)) < 1.5 AND abs(f.y - (k.y + dy)) < 1.5 GROUP BY 1, 2, 3),
s AS (SELECT * FROM n WHERE hit = all_m QUALIFY row_number() OVER (PARTITION BY grp ORDER BY i, j) = 1)"""


def _pages(t: Tables):
    """Lines of an order as listed points, in a frame of the order's own, and those of finished lines as drawn ones, a little off."""
    n, wide = F.col("l_orderkey"), F.when(F.col("l_linenumber") == 6, 40).otherwise(8)
    at = lambda x, y: [F.col("l_orderkey").alias("grp"), F.round(x, 3).alias("x"), F.round(y, 3).alias("y")]
    entries = t.lineitem.select(*at(F.col("l_quantity") * 8 + n % 50, F.floor(F.col("l_extendedprice") / 5) / 100 - n % 30))
    drawn = t.lineitem.where("l_linestatus = 'F'").select(*at(F.col("l_quantity") * 8 + F.col("l_discount") * wide, F.floor(F.col("l_extendedprice") / 5) / 100 + F.col("l_tax") * 8))
    return drawn, entries


@query(f"{SHIFTS} SELECT grp, round(dx, 6) + 0.0 AS dx, round(dy, 6) + 0.0 AS dy, (SELECT count(*) FROM lineitem WHERE l_orderkey = grp AND l_linestatus = 'F') AS markers FROM s")
def a27_consensus_shift(t: Tables):
    return Z.consensus_shift(*_pages(t), "grp", "x", "y")


@query(f"""{SHIFTS} SELECT DISTINCT grp, round(e.x - dx, 3) + 0.0 AS x, round(e.y - dy, 3) + 0.0 AS y FROM e JOIN s USING (grp)
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.grp = e.grp AND abs(m.x - (e.x - dx)) < 2 AND abs(m.y - (e.y - dy)) < 2)""")
def a27_recovered(t: Tables):
    drawn, entries = _pages(t)
    return Z.recovered(drawn, entries, Z.consensus_shift(drawn, entries, "grp", "x", "y"), "grp", "x", "y")


@query()
def a28_ridge_fit(t: Tables):
    letters = t.documents.where("text is not null").select("doc_id", F.explode(F.array(*[F.struct(F.lit(c).alias("ch"), (F.length("text") - F.length(F.replace(F.col("text"), F.lit(c), F.lit("")))).cast("double").alias("n")) for c in "abcdefghijklmnopqrstuvwxyz "])).alias("x"), F.length("text").cast("double").alias("y"))
    return A.ridge_fit(letters.select("doc_id", "x.ch", "x.n", "y").where("n > 0"), "doc_id", "ch", "n", "y")


@query(f"WITH {EVIDENCE} SELECT key, round(p + 1e-9, 4) AS p, {TIER} FROM scored ORDER BY sure DESC, round(p + 1e-9, 4) DESC, key LIMIT 200", "li")
def confidence_board(t: Tables):
    """The flagship: evidence per order and line, combined, tiered, worst first."""
    s = A.score_entity(_evidence(t), "key", child="child").select("key", F.round(F.col("p") + 1e-9, 4).alias("p"), "tier")
    return s.orderBy((F.col("tier") == "certain").desc(), F.col("p").desc(), "key").limit(200)
