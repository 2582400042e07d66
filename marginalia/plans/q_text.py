"""Queries of the scalar functions: text, boxes and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions import boxes as B
from marginalia.functions import text as U
from marginalia.operators.joins import box, suffixed
from marginalia.operators.search import text_search

from .base import query
from .views import Tables

#: What folding drops, as RE2 reads it.
DROP = r"[\p{Mn}\p{Me}\p{Lm}\p{Sk}\p{So}\p{Cf}]"
KEY = rf"trim(regexp_replace(regexp_replace(nfc_normalize(text), '{DROP}', '', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({KEY}) AS digest FROM documents")
def u1_search_key(t: Tables):
    return t.documents.select("doc_id", F.md5(U.search_key(F.col("text"))).alias("digest"))


@query(f"SELECT doc_id, md5({KEY}) AS digest FROM documents")
def u2_match_fold(t: Tables):
    return t.documents.select("doc_id", F.md5(U.match_fold(F.col("text"))).alias("digest"))


@query(f"SELECT doc_id, length({KEY}) AS n FROM documents")
def u3_loose_key(t: Tables):
    return t.documents.select("doc_id", F.length(U.loose_key(F.col("text"))).alias("n"))


@query()
def u4_search_variants(t: Tables):
    return t.benchmark.select("item_id", F.size(U.search_variants(F.col("text"))).alias("variants"))


@query("SELECT sk, count(*) AS n FROM (SELECT regexp_replace(translate(lower(token), 'éèê', 'eee'), '[^a-z]', '', 'g') AS sk FROM tok) GROUP BY 1", "tok")
def u5_skeleton(t: Tables):
    return t.tok.select(U.skeleton(F.col("token"), source="éèê", target="eee").alias("sk")).groupBy("sk").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH d AS (SELECT doc_id, lower(text) AS x FROM documents) SELECT doc_id, instr(x, 'worthless') - 1 AS at, false AS approximate FROM d WHERE contains(x, 'worthless')""")
def u6_text_search(t: Tables):
    return text_search(t.documents, "doc_id", F.lower("text"), F.lower("text"), "worthless", "worthless")


@query("SELECT a = b AS same, replace(replace(a, 'th', 'z'), 'he', 'y') = replace(replace(b, 'th', 'z'), 'he', 'y') AS same_folded, count(*) AS n FROM (SELECT token AS a, replace(replace(token, 'th', 'z'), '.', '') AS b FROM tok) GROUP BY ALL", "tok")
def u7_fold_to_convention(t: Tables):
    a, b = F.col("token"), F.translate(F.replace(F.col("token"), F.lit("th"), F.lit("z")), ".", "")
    seq = [("th", "z"), ("he", "y")]
    return t.tok.select((a == b).alias("same"), (U.fold_to_convention(a, seq) == U.fold_to_convention(b, seq)).alias("same_folded")).groupBy("same", "same_folded").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey, rid, round(CASE WHEN r >= 3 OR r <= 1 / 3.0::DOUBLE THEN CASE WHEN l_returnflag = 'N' THEN 0.6 ELSE 1 END WHEN r > 2 THEN 0.15 + 0.45 * (r - 2) WHEN r < 0.5 THEN 0.15 + 0.45 * (1 / r - 2) ELSE 0 END, 6) AS size,
l_returnflag <> 'N' AND (r >= 3 OR r <= 1 / 3.0::DOUBLE) AS size_proof, round(CASE WHEN q >= 40 THEN 1 WHEN q <= 2 THEN 0 ELSE 0.05 + 0.60 * (q - 2) / 38 END, 6) AS stray, q >= 40 AS stray_proof,
round(CASE WHEN b >= 15 THEN 1 WHEN b <= 5 THEN 0 WHEN b <= 10 THEN 0.05 ELSE 0.35 + 0.35 * (b - 10) / 5 END, 6) AS band, b >= 15 AS band_proof, CASE l_linenumber % 4 WHEN 0 THEN 0.15 WHEN 1 THEN 0.03 ELSE 0 END + 0.0::DOUBLE AS label,
round(CASE WHEN off < 4 OR r BETWEEN 0.70 AND 1.45 THEN 0 WHEN greatest(r, 1 / r) >= 2 THEN 0.85 ELSE 0.20 + 0.40 * (greatest(greatest(r, 1 / r), 1.45) - 1.45) / 0.55 END, 6) AS width
FROM (SELECT *, l_quantity AS q, l_quantity / 20 AS r, abs(l_quantity - 20) AS off, l_linenumber * 2.5 AS b FROM li)""", "li")
def u8_ramps(t: Tables):
    r, status = F.col("l_quantity") / 20, F.element_at(F.array(F.lit("none"), F.lit("auto"), F.lit("human"), F.lit(None)), (F.col("l_linenumber") % 4 + 1).cast("int"))
    (s, sp), (y, yp), (b, bp) = U.p_size(r, F.col("l_returnflag") != "N"), U.p_stray(F.col("l_quantity")), U.p_band(F.col("l_linenumber") * 2.5)
    return t.li.select(
        "l_orderkey", "rid", s.alias("size"), sp.alias("size_proof"), y.alias("stray"), yp.alias("stray_proof"), b.alias("band"), bp.alias("band_proof"),
        U.p_label(status).alias("label"), U.p_width(r, F.abs(F.col("l_quantity") - 20)).alias("width"),
    )


@query("SELECT pieces, count(*) AS n FROM (SELECT len(regexp_extract_all(token, '[^aeiou]*[aeiou]|[^aeiou]+')) AS pieces FROM tok) GROUP BY 1", "tok")
def u9_segments(t: Tables):
    return t.tok.select(F.size(U.segments(F.col("token"), "aeiou")).alias("pieces")).groupBy("pieces").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT list_filter(string_split(token, ''), lambda x: x <> '') AS cs FROM tok WHERE token NOT LIKE '%&%'), e AS (SELECT cs[i] AS ch, CASE WHEN len(cs) = 1 THEN 'isolated' WHEN i = 1 THEN 'initial' WHEN i = len(cs) THEN 'final' ELSE 'medial' END AS place FROM c, unnest(range(1, len(cs) + 1)) AS u(i))
SELECT ch, place, count(*) AS n FROM e GROUP BY 1, 2""", "tok")
def u10_letter_positions(t: Tables):
    d = t.tok.where("token not like '%&%'").select(F.explode(U.letter_positions(F.col("token"))).alias("l"))
    return d.groupBy("l.ch", "l.place").agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT p_partkey, array_to_string(list_filter(string_split(lower(regexp_replace(regexp_replace(i, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '[_.\-\s]+', ' ', 'g')), ' '), lambda x: x <> ''), '|') AS parts FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '.' || replace(p_brand, '#', 'Nr') || '-' || p_type AS i FROM part)""")
def u11_split_identifier(t: Tables):
    ident = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("."), F.replace(F.col("p_brand"), F.lit("#"), F.lit("Nr")), F.lit("-"), "p_type")
    return t.part.select("p_partkey", F.array_join(U.split_identifier(ident), "|").alias("parts"))


@query("""WITH j AS (SELECT a.grp, a.rid, b.rid AS rid2, a.x0, a.x1, a.y0, a.y1, b.x0 AS p0, b.x1 AS p1, b.y0 AS q0, b.y1 AS q1, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS ox, least(a.y1, b.y1) - greatest(a.y0, b.y0) AS oy FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.rid + 1 = b.rid)
SELECT grp, rid, round((x1 - x0) * (y1 - y0), 6) AS area, round(ox, 6) + 0.0 AS overlap, round(sqrt(pow(greatest(-ox, 0), 2) + pow(greatest(-oy, 0), 2)), 6) AS gap, round(greatest(ox, 0) * greatest(oy, 0) / ((x1 - x0) * (y1 - y0) + (p1 - p0) * (q1 - q0) - greatest(ox, 0) * greatest(oy, 0)), 6) AS iou,
x0 <= p0 AND x1 >= p1 AND y0 <= q0 AND y1 >= q1 AS holds, round(x1 * -2 + 3, 6) AS tx0, round(x0 * -2 + 3, 6) + 0.0 AS tx1, round((x0 - 3) / -2, 6) + 0.0 AS back FROM j""", "ivl")
def u12_boxes(t: Tables):
    b = suffixed(t.ivl)
    j = t.ivl.join(b, (F.col("grp") == F.col("grp2")) & (F.col("rid") + 1 == F.col("rid2")))
    m, n = box(), box("2")
    tr = B.transform(m, -2.0, 3.0, 1.0, 0.0)
    return j.select("grp", "rid", B.area(m).alias("area"), B.overlap(m[0], m[1], n[0], n[1]).alias("overlap"), B.gap2(m, n).alias("gap"), B.iou(m, n).alias("iou"), B.contains(m, n).alias("holds"), tr[0].alias("tx0"), tr[1].alias("tx1"), B.affine_inverse(m[0], -2.0, 3.0).alias("back"))


@query("""WITH c AS (SELECT vec_id, points, list_reduce([p.x for p in points], lambda a, b: a + b) / 32 AS cx, list_reduce([p.y for p in points], lambda a, b: a + b) / 32 AS cy, greatest(list_max([p.x for p in points]) - list_min([p.x for p in points]), list_max([p.y for p in points]) - list_min([p.y for p in points])) AS s FROM shape)
SELECT vec_id, md5(array_to_string([CAST(CAST(round(round_even((p.x - cx) / s, 1) * 10) AS INT) AS VARCHAR) || ',' || CAST(CAST(round(round_even((p.y - cy) / s, 1) * 10) AS INT) AS VARCHAR) for p in points], ';'))[1:16] AS sig FROM c""", "shape")
def u13_shape_signature(t: Tables):
    return t.shape.select("vec_id", U.shape_signature(F.col("points")).alias("sig"))


@query("""SELECT a.vec_id, round(list_sum([sqrt(pow(a.points[i].x - b.points[i].x, 2) + pow(a.points[i].y - b.points[i].y, 2)) for i in range(1, 33)]) / 32, 6) AS distance FROM shape a JOIN shape b ON a.vec_id + 1 = b.vec_id""", "shape")
def u14_shape_distance(t: Tables):
    b = t.shape.select((F.col("vec_id") - 1).alias("_v"), F.col("points").alias("_p"))
    return t.shape.join(b, F.col("vec_id") == F.col("_v")).select("vec_id", U.shape_distance(F.col("points"), F.col("_p")).alias("distance"))


@query("SELECT l_orderkey, md5('review|' || array_to_string(list_sort(list(DISTINCT l_returnflag)), ','))[1:8] AS sig FROM lineitem GROUP BY 1")
def u15_content_sig(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("_n")).select("l_orderkey", U.content_sig(F.lit("review"), F.col("_n")).alias("sig"))
