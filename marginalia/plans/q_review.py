"""Queries of alignment, loops, logs, gates, sources and publication."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from marginalia.operators import aggregates as A
from marginalia.operators import align as G
from marginalia.operators import gates as V
from marginalia.operators import logs as L
from marginalia.operators.common import shared_dir
from marginalia.sources import publish as P
from marginalia.sources import readers as S
from marginalia.sources.store import ResultStore
from marginalia.streaming import queue

from .base import query
from .views import Tables


@query("""WITH a AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) AS n, token FROM tok),
b AS (SELECT doc_id, n + 0.0 AS n, left(token, CAST(length(token) // 2 AS INT)) AS token FROM a WHERE length(token) > 9 UNION ALL SELECT doc_id, n + 0.5, substr(token, CAST(length(token) // 2 + 1 AS INT)) FROM a WHERE length(token) > 9 UNION ALL SELECT doc_id, n, token FROM a WHERE length(token) <= 9),
ea AS (SELECT doc_id, cut, row_number() OVER (PARTITION BY doc_id ORDER BY cut) AS i FROM (SELECT doc_id, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY n) AS cut FROM a)), eb AS (SELECT doc_id, cut, row_number() OVER (PARTITION BY doc_id ORDER BY cut) AS i FROM (SELECT doc_id, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY n) AS cut FROM b)),
r AS (SELECT doc_id, cut, ea.i - coalesce(lag(ea.i) OVER w, 0) AS na, eb.i - coalesce(lag(eb.i) OVER w, 0) AS nb FROM ea JOIN eb USING (doc_id, cut) WINDOW w AS (PARTITION BY doc_id ORDER BY cut)), k AS (SELECT doc_id, CASE WHEN na = 1 AND nb = 1 THEN '1:1' WHEN nb = 1 THEN 'fuse' WHEN na = 1 THEN 'split' ELSE 'cannot-align' END AS kind FROM r)
SELECT doc_id, kind, count(*) AS n FROM k GROUP BY 1, 2""", "tok")
def g1_align_tokens(t: Tables):
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "pos"))
    a = t.tok_by_doc.select("doc_id", (n * 2).alias("n"), "token")
    half = F.floor(F.length("token") / 2).cast("int")
    both = F.array(F.struct(F.lit(0).alias("h"), F.substring("token", F.lit(1), half).alias("t")), F.struct(F.lit(1).alias("h"), F.substring("token", half + 1, F.length("token")).alias("t")))
    b = a.select("doc_id", "n", F.explode(F.when(F.length("token") > 9, both).otherwise(F.array(F.struct(F.lit(0).alias("h"), F.col("token").alias("t"))))).alias("x")).select("doc_id", (F.col("n") + F.col("x.h")).alias("n"), F.col("x.t").alias("token"))
    return G.align_tokens(a, b, "doc_id", "n", "token").groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT conv_id, turn, text, role = 'user' AS nx FROM conversations WHERE text IS NOT NULL), b AS (SELECT *, CASE WHEN lag(nx) OVER w THEN 0 ELSE 1 END AS b FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text, nx)), n AS (SELECT *, CAST(sum(b) OVER (PARTITION BY conv_id ORDER BY turn, text, nx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS number FROM b)
SELECT conv_id, number, md5(string_agg(text, '' ORDER BY turn, text)) AS digest, count(*) AS parts FROM n GROUP BY 1, 2""")
def g2_fold_numbering(t: Tables):
    c = t.conversations.where("text is not null").withColumn("o", F.struct("turn", "text", (F.col("role") == "user").alias("nx")))
    return G.fold_numbering(c, "conv_id", "o", "text", F.col("role") == "user", F.lit(False)).select("conv_id", "number", F.md5("text").alias("digest"), "parts")


@query("""WITH a AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) AS n, token FROM tok), b AS (SELECT doc_id, n, CASE WHEN doc_id % 3 = 1 AND n = 5 THEN token || 'x' ELSE token END AS token FROM a WHERE NOT (doc_id % 3 = 2 AND n > 20)),
j AS (SELECT doc_id, n, a.token AS ta, b.token AS tb FROM a FULL JOIN b USING (doc_id, n)), g AS (SELECT doc_id, count(*) FILTER (ta IS NULL OR tb IS NULL) AS m, count(*) FILTER (ta <> tb) AS p FROM j GROUP BY 1)
SELECT doc_id, CASE WHEN m > 0 THEN 'count-mismatch' WHEN p > 0 THEN 'skeleton-mismatch' ELSE 'equal' END AS status, CASE WHEN m > 0 THEN 0 ELSE p END AS places FROM g""", "tok")
def g3_segmentation_equal(t: Tables):
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "pos"))
    a = t.tok_by_doc.select("doc_id", n.alias("n"), "token")
    b = a.where("not (doc_id % 3 = 2 and n > 20)").withColumn("token", F.when((F.col("doc_id") % 3 == 1) & (F.col("n") == 5), F.concat("token", F.lit("x"))).otherwise(F.col("token")))
    return G.segmentation_equal(a, b, "doc_id", "n", "token")


@query()
def g4_partition_to_capacity(t: Tables):
    return G.partition_to_capacity(t.li.select("l_orderkey", "rid", "l_quantity"), 3, "l_orderkey", "rid", "l_quantity", 60.0)


@query()
def g4_anchored(t: Tables):
    """Bins that lines should be in by their tax; a group's first and last lines may stay out."""
    li = t.li.select("l_orderkey", "rid", "l_quantity", F.least(F.floor(F.col("l_tax") * 40) + 1, F.lit(3)).alias("at"))
    return G.partition_to_capacity(li, 3, "l_orderkey", "rid", "l_quantity", 40.0, anchor="at", free_ends=True)


@query("""WITH RECURSIVE e AS (SELECT a.grp, a.rid AS a, b.rid AS b FROM ivl a JOIN ivl b ON a.grp = b.grp AND a.rid <> b.rid AND least(a.x1, b.x1) + 0.2 - greatest(a.x0, b.x0) + 0.2 > 0 AND least(a.y1, b.y1) + 0.2 - greatest(a.y0, b.y0) + 0.2 > 0),
r AS (SELECT grp, rid AS v, rid AS o FROM ivl UNION SELECT r.grp, r.v, e.b FROM r JOIN e ON e.grp = r.grp AND e.a = r.o), c AS (SELECT grp, v AS rid, min(o) AS component FROM r GROUP BY 1, 2),
w AS (SELECT grp, component, fam, round(sum(x1 - x0), 6) AS w FROM c JOIN ivl USING (grp, rid) GROUP BY 1, 2, 3), l AS (SELECT grp, component, fam AS label FROM w QUALIFY row_number() OVER (PARTITION BY grp, component ORDER BY w DESC, fam) = 1)
SELECT grp, rid, component, label FROM c JOIN l USING (grp, component)""", "ivl")
def g5_connected(t: Tables):
    return G.connected(t.ivl_by_order.withColumn("w", F.col("x1") - F.col("x0")), "grp", "rid", 0.4, "w", "fam", cell=20.0).select("grp", "rid", "component", "label")


@query()
def g6_leader_cluster(t: Tables):
    return G.leader_cluster(t.shape, "vec_id", "points", "label", 0.2)


@query()
def g6_nearest_labelled(t: Tables):
    """Rows of clusters of two or more lend their label to the others, anywhere in the table: there are no blocks."""
    led = G.leader_cluster(t.shape, "vec_id", "points", "label", 0.2)
    large = led.groupBy("leader").agg((F.count(F.lit(1)) > 1).alias("large"))
    rows = t.shape.join(led, "vec_id").join(large, "leader").select("vec_id", "points", F.when(F.col("large"), F.col("label")).alias("named"))
    return G.nearest_labelled(rows, "vec_id", "points", None, "named", 0.2)


@query("""WITH m AS (SELECT l_partkey AS c, CASE WHEN l_quantity > 25 THEN l_returnflag END AS l FROM lineitem), v AS (SELECT c, l, count(*) AS votes FROM m WHERE l IS NOT NULL GROUP BY 1, 2), z AS (SELECT c, count(*) AS size FROM m GROUP BY 1)
SELECT c, CASE WHEN votes >= CASE WHEN size <= 5 THEN 2 ELSE 3 END THEN l END AS label, votes, size FROM v JOIN z USING (c) QUALIFY row_number() OVER (PARTITION BY c ORDER BY votes DESC, l) = 1""")
def g6_label_votes(t: Tables):
    m = t.lineitem.select(F.col("l_partkey").alias("c"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("l"))
    return G.label_votes(m, "c", "l").select("c", "label", "votes", "size")


def _moves(t: Tables):
    """Every order line as an item of its part, which may go to another part: moves, what parts hold, and budgets of two flags."""
    parts = t.part.agg(F.max("p_partkey").alias("_top"))
    kinds = [(F.col("l_linestatus") == "F").alias("body"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_returnflag").alias("family")]
    other = F.when(F.col("l_discount") > 0.06, F.pmod(F.col("l_partkey") * 7 + F.col("l_suppkey"), F.col("_top"))).otherwise(F.col("l_partkey"))
    li = t.li.join(F.broadcast(parts))  # one row
    moves = li.select((F.col("l_orderkey") * 1000 + F.col("rid")).alias("id"), F.col("l_partkey").alias("src"), other.alias("dst"), *kinds)
    held = t.li.select(F.col("l_partkey").alias("owner"), *kinds).groupBy("owner", "body", "line", "family").agg(F.count(F.lit(1)).alias("n"))
    family = F.explode(F.array(F.lit("A"), F.lit("R"))).alias("family")
    return moves, held, t.part.select(F.col("p_partkey").alias("owner"), family, F.pmod("p_size", F.lit(9)).cast("long").alias("cap"))


@query()
def g7_guarded_moves(t: Tables):
    return G.guarded_moves(*_moves(t))


@query()
def g4_skip_map(t: Tables):
    """Order lines as drawn, all but every sixth line number as listed, with a little other widths."""
    drawn = t.li.select("l_orderkey", "rid", F.col("l_quantity").alias("w"))
    listed = t.li.withColumn("w", F.col("l_quantity") + F.col("l_tax") * 50).where("l_linenumber % 6 <> 5").select("l_orderkey", "rid", "w")
    return G.skip_map(drawn, listed, "l_orderkey", "rid", "w")


@query()
def g4_partition_to_widths(t: Tables):
    """Order lines by quantity into bins of an order, as many as its status says, as wide as its price; head and tail free by priority."""
    n = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    bins = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), n)).alias("no"), (F.col("o_totalprice") / 10000).alias("w"),
        F.startswith("o_orderpriority", F.lit("1")).alias("head"), F.startswith("o_orderpriority", F.lit("2")).alias("tail"),
    ).withColumn("w", F.col("w") * F.col("no"))
    items = t.li.select("l_orderkey", "rid", "l_quantity")
    return G.partition_to_widths(items, bins, "l_orderkey", "rid", "l_quantity", "no", "w", free_head="head", free_tail="tail")


@query("""WITH d AS (SELECT l_orderkey, rid, CASE WHEN l_linenumber <> 7 THEN l_quantity END AS o, CASE WHEN l_linenumber <> 1 THEN l_quantity + l_tax * 100 END AS th, 25.0 AS b, p_size * 1.0 AS e FROM li JOIN part ON p_partkey = l_partkey),
v AS (SELECT *, greatest(1.5, 0.25 * abs(e)) AS c, abs(o - e) AS eo, abs(th - e) AS et FROM d)
SELECT l_orderkey, rid, CASE WHEN th IS NULL THEN 'OURS' WHEN o IS NULL THEN 'THEIRS' WHEN o = b AND th <> b THEN 'OURS' WHEN th = b AND o <> b THEN 'THEIRS' WHEN et - eo >= c THEN 'OURS' WHEN eo - et >= c THEN 'THEIRS' ELSE 'UNCLEAR' END AS verdict,
CASE WHEN th IS NULL OR o IS NULL THEN 'one-sided' WHEN (o = b) <> (th = b) THEN 'budget' WHEN abs(et - eo) >= c THEN 'error' ELSE 'margin' END AS reason FROM v""", "li")
def g8_adjudicate(t: Tables):
    d = t.li.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "rid", F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("o"), F.when(F.col("l_linenumber") != 1, F.col("l_quantity") + F.col("l_tax") * 100).alias("th"), F.lit(25.0).alias("b"), F.col("p_size").cast("double").alias("e"))
    return G.adjudicate(d, "o", "th", "b", "e").select("l_orderkey", "rid", "verdict", "reason")


@query("""WITH a AS (SELECT * FROM ivl WHERE rid % 2 = 1), b AS (SELECT * FROM ivl WHERE rid % 2 = 0), f AS (SELECT DISTINCT grp, fam FROM ivl WHERE x0 > 20),
m AS (SELECT grp, fam, count(*) FILTER (NOT EXISTS (SELECT 1 FROM b WHERE b.grp = a.grp AND b.fam = a.fam AND a.x0 <= b.x1 + 0.3 AND b.x0 <= a.x1 + 0.3)) AS l FROM a GROUP BY 1, 2), n AS (SELECT grp, fam, count(*) FILTER (NOT EXISTS (SELECT 1 FROM a WHERE b.grp = a.grp AND b.fam = a.fam AND a.x0 <= b.x1 + 0.3 AND b.x0 <= a.x1 + 0.3)) AS l FROM b GROUP BY 1, 2)
SELECT f.grp, f.fam, CASE WHEN m.l IS NULL OR n.l IS NULL THEN 'unclear' WHEN m.l = 0 AND n.l = 0 THEN 'artefact' ELSE 'ours' END AS vote FROM f LEFT JOIN m USING (grp, fam) LEFT JOIN n USING (grp, fam)""", "ivl")
def g9_three_way_vote(t: Tables):
    return G.three_way_vote(t.ivl.where("x0 > 20").select("grp", "fam").distinct(), t.ivl.where("rid % 2 = 1"), t.ivl.where("rid % 2 = 0"), ["grp", "fam"])


@query()
def g10_refine_until_settled(t: Tables):
    """Lines whose price is far from their part's upper median are halved towards it until the count settles."""
    base = t.li.select("l_orderkey", "rid", "l_partkey", "l_extendedprice")
    m = A.median_hi(base, "l_partkey", "l_extendedprice").select(F.col("l_partkey").alias("_p"), "median")
    state = base.join(m, F.col("l_partkey") == F.col("_p")).drop("_p")
    far = F.abs(F.log(F.col("l_extendedprice") / F.col("median"))) > 0.7
    step = lambda d, k: d.withColumn("l_extendedprice", F.when(far, (F.col("l_extendedprice") + F.col("median")) / 2).otherwise(F.col("l_extendedprice")))
    metric = lambda d: (d.where(far).count(), 0)
    _, log = G.refine_until_settled(state, step, metric)
    return t.spark.createDataFrame(log, "round int, ours double, theirs double, accepted boolean")


@query("""SELECT o_orderpriority AS change, round(sum(CASE WHEN o_orderkey % 2 = 0 THEN 10 ELSE -12 END * 1.0), 6) AS delta, sum(CASE WHEN o_orderkey % 2 = 0 THEN 10 ELSE -12 END) <= 0 AS kept FROM orders GROUP BY 1""".replace("* 1.0), 6)", "), 6) * 1.0::DOUBLE"))
def g11_bisect_changes(t: Tables):
    base = t.orders.select(F.col("o_orderkey").alias("k"), F.round(F.col("o_totalprice") * 100).alias("v"))
    changes = t.orders.select(F.col("o_orderpriority").alias("change"), F.col("o_orderkey").alias("k"), (F.round(F.col("o_totalprice") * 100) + F.when(F.col("o_orderkey") % 2 == 0, 10).otherwise(-12)).alias("new"))
    return G.bisect_changes(base, changes, "k", "v")


# Logs


def _edits(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 7).alias("page"), F.when(F.col("c_custkey") % 2 == 0, "even").otherwise("odd").alias("step"), F.col("c_name").alias("payload"))


LAST = "last AS (SELECT id, arg_max(action, (ts, seq)) AS action, arg_max('amended ' || seq, (ts, seq)) AS amended FROM log GROUP BY 1), ed AS (SELECT c_custkey AS id, c_custkey % 7 AS page, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS step, c_name AS payload FROM customer)"
STATE = "st AS (SELECT ed.*, CASE action WHEN 'approve' THEN 'approved' WHEN 'amend' THEN 'approved' WHEN 'reject' THEN 'rejected' WHEN 'withdraw' THEN 'withdrawn' ELSE 'proposed' END AS state FROM ed LEFT JOIN last USING (id))"


@query(f"WITH {LAST}, {STATE} SELECT id, state FROM st", "log")
def l1_edit_state(t: Tables):
    return L.edit_state(_edits(t), t.log, "id", ["ts", "seq"], "action").select("id", "state")


@query(f"WITH {LAST} SELECT id, CASE WHEN action = 'amend' THEN amended ELSE payload END AS payload, action = 'withdraw' AS withdrawn FROM ed JOIN last USING (id) WHERE action IN ('approve', 'amend', 'withdraw')", "log")
def l2_export_approved(t: Tables):
    log = t.log.withColumn("amended", F.concat(F.lit("amended "), "seq"))
    return L.export_approved(_edits(t), log, "id", ["ts", "seq"], "action", "payload", "amended")


@query(f"""WITH {LAST}, {STATE}, g AS (SELECT page, step, count(*) FILTER (state = 'proposed') AS pending, count(*) FILTER (state IN ('proposed', 'approved')) AS live, count(*) AS edits FROM st GROUP BY 1, 2), d AS (SELECT DISTINCT s_suppkey % 9 AS page, 'odd' AS step FROM supplier WHERE s_suppkey % 9 > 4)
SELECT page, step, CASE WHEN d.step IS NOT NULL THEN 'done' WHEN coalesce(live, 0) > 0 THEN 'in-review' ELSE 'pending' END AS status, coalesce(pending, 0) AS pending, coalesce(edits, 0) AS edits FROM g FULL JOIN d USING (page, step)""".replace("d.step IS NOT NULL", "d.z IS NOT NULL").replace("'odd' AS step FROM supplier", "'odd' AS step, 1 AS z FROM supplier"), "log")
def l3_page_status(t: Tables):
    states = L.edit_state(_edits(t), t.log, "id", ["ts", "seq"], "action")
    done = t.supplier.where("s_suppkey % 9 > 4").select((F.col("s_suppkey") % 9).alias("page"), F.lit("odd").alias("step"))
    return L.page_status(states, "page", "step", "state", done)


@query("""WITH o AS (SELECT p_partkey AS k, replace(p_name, ' ', '+') AS old FROM part WHERE p_partkey % 5 <> 0), n AS (SELECT p_partkey AS k, CASE WHEN p_size % 3 = 0 THEN replace(p_name, ' ', '+') WHEN p_size % 3 = 1 THEN 'a+b' ELSE 'single' END AS new FROM part WHERE p_partkey % 4 <> 0),
j AS (SELECT k, old, new, CASE WHEN new IS NULL THEN 'kept' WHEN old IS NULL THEN 'new' WHEN old = new THEN 'same' WHEN contains(old, '+') AND NOT contains(new, '+') THEN 'refused' ELSE 'changed' END AS outcome FROM o FULL JOIN n USING (k))
SELECT k, CASE WHEN outcome IN ('kept', 'refused') THEN old ELSE new END AS label, outcome FROM j""")
def l4_apply_labels(t: Tables):
    joined = F.replace(F.col("p_name"), F.lit(" "), F.lit("+"))
    old = t.part.where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("k"), joined.alias("label"))
    new = t.part.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") % 3 == 0, joined).when(F.col("p_size") % 3 == 1, "a+b").otherwise("single").alias("label"))
    return L.apply_labels(old, new, "k", "label")


@query("""WITH s AS (SELECT c_custkey AS id, c_acctbal / 10000 AS p, CASE WHEN c_acctbal < 2400 THEN 'clean' WHEN c_acctbal < 6000 THEN 'review' ELSE 'high' END AS tier, c_custkey % 3 AS sig FROM customer),
v AS (SELECT id, CASE arg_max(action, (ts, seq)) WHEN 'approve' THEN 'no-issue' WHEN 'reject' THEN 'reopened' ELSE 'confirmed' END AS st, arg_max(seq % 3, (ts, seq)) AS vs FROM log GROUP BY 1),
j AS (SELECT s.*, CASE WHEN st = 'reopened' THEN 'reopened' WHEN st = 'confirmed' AND tier = 'clean' THEN 'fixed' WHEN st IS NOT NULL AND vs IS DISTINCT FROM sig THEN 'stale' ELSE coalesce(st, 'open') END AS status FROM s LEFT JOIN v USING (id))
SELECT id, round(CASE status WHEN 'stale' THEN greatest(p, 0.5) WHEN 'reopened' THEN greatest(p, 0.6) ELSE p END, 6) AS p, CASE WHEN status = 'no-issue' THEN 'clean' WHEN status IN ('stale', 'reopened') THEN 'review' ELSE tier END AS tier, status FROM j""", "log")
def l5_merge_verdicts(t: Tables):
    s = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 10000).alias("p"), F.when(F.col("c_acctbal") < 2400, "clean").when(F.col("c_acctbal") < 6000, "review").otherwise("high").alias("tier"), (F.col("c_custkey") % 3).alias("sig"))
    last = t.log.groupBy("id").agg(F.max_by(F.struct("action", (F.col("seq") % 3).alias("sig")), F.struct("ts", "seq")).alias("l"))
    v = last.select("id", F.when(F.col("l.action") == "approve", "no-issue").when(F.col("l.action") == "reject", "reopened").otherwise("confirmed").alias("status"), "l.sig")
    return L.merge_verdicts(s, v, "id")


@query("""WITH o AS (SELECT event_id AS k, CASE WHEN user_id % 2 = 0 THEN 'ring' ELSE 'small' END AS fam FROM events), c AS (SELECT p_partkey AS k, p_name AS t FROM part)
SELECT k, fam, CASE WHEN t IS NULL THEN 'dead' ELSE 'contradiction' END AS problem FROM o LEFT JOIN c USING (k) WHERE t IS NULL OR NOT contains(t, fam)""")
def l6_check_overrides(t: Tables):
    o = t.events.select(F.col("event_id").alias("k"), F.when(F.col("user_id") % 2 == 0, "ring").otherwise("small").alias("fam"))
    return L.check_overrides(o, t.part.select(F.col("p_partkey").alias("k"), "p_name"), "k", "fam", "p_name")


@query("SELECT id, a AS action, CASE a WHEN 'approve' THEN 'approved' WHEN 'amend' THEN 'approved' WHEN 'reject' THEN 'rejected' WHEN 'withdraw' THEN 'withdrawn' ELSE 'proposed' END AS state FROM (SELECT id, arg_max(action, (ts, seq)) AS a FROM log GROUP BY 1)", "log")
def l7_live_queue(t: Tables):
    return queue.live_states(t.log)


@query("SELECT id, a AS action, CASE a WHEN 'approve' THEN 'approved' WHEN 'amend' THEN 'approved' WHEN 'reject' THEN 'rejected' WHEN 'withdraw' THEN 'withdrawn' ELSE 'proposed' END AS state, CAST(NULL AS VARCHAR) AS was FROM (SELECT id, arg_max(action, (ts, seq)) AS a FROM log GROUP BY 1)", "log")
def l7_change_feed(t: Tables):
    """The stream itself, over the events table as a file source: what it wrote, read back."""
    live = Tables(t.spark, t.dir)
    live.__dict__["events"] = t.spark.readStream.schema(t.events.schema).parquet(f"{t.dir}/event[s].parquet")  # a pattern may name a single file
    path = _scratch(t, "feed")
    queue.start_change_feed(live.log, f"{path}/changes", f"{path}/checkpoint", once=True).awaitTermination()
    return t.spark.read.parquet(f"{path}/changes").drop("batch")


@query("""WITH one AS (SELECT p_partkey AS k, CASE WHEN p_size % 3 = 0 THEN replace(p_name, ' ', '+') ELSE 'single' END AS label FROM part),
two AS (SELECT l_partkey AS k, CASE WHEN max(l_quantity) > 49 THEN 'a+b' ELSE 'single' END AS label FROM lineitem GROUP BY 1)
SELECT k, CASE WHEN one.label IS NULL OR two.label IS NULL OR NOT (contains(one.label, '+') AND NOT contains(two.label, '+')) THEN coalesce(two.label, one.label) ELSE one.label END AS label FROM one FULL JOIN two USING (k)""")
def l4_label_sink(t: Tables):
    """Two batches of decisions through the upsert sink, the second one twice."""
    sink = queue.LabelSink(_scratch(t, "labels"), "k", "label")
    one = t.part.select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") % 3 == 0, F.replace(F.col("p_name"), F.lit(" "), F.lit("+"))).otherwise("single").alias("label"))
    two = t.lineitem.groupBy(F.col("l_partkey").alias("k")).agg(F.when(F.max("l_quantity") > 49, "a+b").otherwise("single").alias("label"))
    for number, batch in enumerate((one, two, two)):
        sink(batch, min(number, 1))
    return sink.labels(t.spark)


# Gates


@query("""WITH c AS (SELECT 'quantity' AS "check", CASE WHEN count(*) FILTER (l_quantity <= 0) > 0 THEN 'fail' ELSE 'ok' END AS status, count(*) FILTER (l_quantity <= 0) AS bad, count(*) AS rows FROM lineitem UNION ALL SELECT 'discount', CASE WHEN count(*) FILTER (l_discount > 0.09) > 0 THEN 'fail' ELSE 'ok' END, count(*) FILTER (l_discount > 0.09), count(*) FROM lineitem UNION ALL SELECT 'none', 'skip', 0, 0)
SELECT * FROM c UNION ALL SELECT 'gate', CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 'fail' WHEN count(*) FILTER (status = 'skip') > 0 THEN 'skip' ELSE 'ok' END, CAST(sum(bad) AS BIGINT), CAST(sum(rows) AS BIGINT) FROM c""")
def v1_gate(t: Tables):
    li = t.lineitem
    return V.gate([V.check(li, "quantity", F.col("l_quantity") <= 0), V.check(li, "discount", F.col("l_discount") > 0.09), V.check(li.where("l_orderkey < 0"), "none", F.lit(True))])


@query("""WITH p AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS d, max(l_linenumber) AS m, min(l_linenumber) AS lo FROM lineitem GROUP BY 1), k AS (SELECT count(*) FILTER (c > 1) AS duplicate_keys, count(*) AS keys FROM (SELECT l_orderkey * 10 + l_linenumber AS k, count(*) AS c FROM lineitem GROUP BY 1)),
g AS (SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(m) AS BIGINT) AS by_maximum, count(*) FILTER (NOT (n = d AND n = m AND lo = 1)) AS broken_groups FROM p) SELECT *, duplicate_keys = 0 AND rows = by_maximum AND broken_groups = 0 AS ok FROM g, k""")
def v2_unique_and_total(t: Tables):
    d = t.lineitem.withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return V.unique_and_total(d, "k", "l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 9)), b AS (SELECT count(*) AS n FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))
SELECT 'part: reference exists' AS "check", CASE WHEN n > 0 THEN 'fail' ELSE 'ok' END AS status, CAST(n AS BIGINT) AS bad, n AS rows FROM a UNION ALL SELECT 'part: claimed once', CASE WHEN n > 0 THEN 'fail' ELSE 'ok' END, n, n FROM b""")
def v3_reference_integrity(t: Tables):
    return V.reference_integrity(t.lineitem.select(F.col("l_partkey").alias("k")), "k", t.part.where("p_size <> 9").select(F.col("p_partkey").alias("k")), "part")


@query("SELECT l_orderkey, l_returnflag, count(l_partkey) AS n, CAST(CASE l_returnflag WHEN 'A' THEN 2 ELSE 1 END AS BIGINT) AS want FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1, 2 HAVING count(l_partkey) <> CASE l_returnflag WHEN 'A' THEN 2 ELSE 1 END")
def v3_relation_cardinality(t: Tables):
    return V.relation_cardinality(t.lineitem.where("l_returnflag in ('A', 'N')"), "l_orderkey", "l_returnflag", "l_partkey", {"A": 2, "N": 1})


@query("SELECT event_type AS value, count(*) AS n, CASE WHEN event_type = 'view' THEN 'unknown' WHEN event_type = 'error' THEN 'inactive' WHEN event_type = 'click' AND count(*) <> 77 THEN 'count' END AS problem FROM events GROUP BY 1")
def v4_closed_vocabulary(t: Tables):
    registry = t.spark.createDataFrame([("click", True), ("error", False), ("purchase", True), ("signup", True)], "name string, active boolean")
    return V.closed_vocabulary(t.events, "event_type", registry, t.spark.createDataFrame([("click", 77)], "name string, n long"))


@query("""WITH a AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) AS n, token FROM tok), b AS (SELECT doc_id, n, CASE WHEN doc_id % 4 = 0 AND n = 3 THEN 'moved' ELSE token END AS token FROM a)
SELECT doc_id, min(n) AS first_place, count(*) AS places FROM a JOIN b USING (doc_id, n) WHERE a.token <> b.token GROUP BY 1""", "tok")
def v5_order_preserved(t: Tables):
    a = t.tok_by_doc.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "pos")).alias("n"), "token")
    b = a.withColumn("token", F.when((F.col("doc_id") % 4 == 0) & (F.col("n") == 3), "moved").otherwise(F.col("token")))
    return V.order_preserved(a, b, "doc_id", "n", "token")


@query("""SELECT 'schema' AS "check", 'fail' AS status, 1 AS bad, 4 AS rows UNION ALL SELECT 'grp: present', 'ok', 0, count(*) FROM ivl UNION ALL SELECT 'fam: pattern', CASE WHEN count(*) FILTER (fam = 'R') > 0 THEN 'fail' ELSE 'ok' END, count(*) FILTER (fam = 'R'), count(*) FROM ivl
UNION ALL SELECT 'box: size', CASE WHEN count(*) FILTER (x0 >= x1 OR y0 >= y1) > 0 THEN 'fail' ELSE 'ok' END, count(*) FILTER (x0 >= x1 OR y0 >= y1), count(*) FROM ivl UNION ALL SELECT 'box: view', CASE WHEN count(*) FILTER (x0 < -1 OR x1 > 51 OR y0 < -1 OR y1 > 11) > 0 THEN 'fail' ELSE 'ok' END, count(*) FILTER (x0 < -1 OR x1 > 51 OR y0 < -1 OR y1 > 11), count(*) FROM ivl""".replace("1 AS bad, 4 AS rows", "CAST(1 AS BIGINT) AS bad, CAST(4 AS BIGINT) AS rows"), "ivl")
def v6_schema_gate(t: Tables):
    want = StructType([StructField("grp", LongType(), False), StructField("fam", StringType()), StructField("x0", DoubleType()), StructField("z0", DoubleType())])
    return V.schema_gate(t.ivl, want, {"fam": "^[AN]$"}, (0.0, 50.0, 0.0, 10.0))


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS name FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)")
def v7_preflight(t: Tables):
    return V.preflight(t.orders.select(F.col("o_custkey").cast("string").alias("name")).distinct(), t.customer.where("c_nationkey <> 3").select(F.col("c_custkey").cast("string").alias("name")))


@query("""WITH s AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')), g AS (SELECT count(*) FILTER (l_tax > 0.07) AS failures, count(*) FILTER (l_quantity > 45) AS budget, count(*) FILTER (l_discount > 0.09) AS bad, CAST(floor(round(1000 * avg(abs(ln(l_quantity / 25))), 6)) AS BIGINT) AS drift FROM s)
SELECT *, 100 * failures + 3 * budget + 5 * bad + drift AS score FROM g""")
def v8_benchmark_score(t: Tables):
    d = t.lineitem.withColumn("want", F.lit(25.0))
    groups = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return V.benchmark_score(d, groups, "l_orderkey", F.col("l_tax") > 0.07, F.col("l_quantity") > 45, F.col("l_discount") > 0.09, "l_quantity", "want")


# Sources and publication


def _scratch(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query(r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?s)(<script[^>]*>|<style[^>]*>).*?</(script|style)>', '\1', 'g') AS h FROM pages WHERE html IS NOT NULL),
p AS (SELECT page_id, list_filter(list_transform(string_split(h, '<')[2:], lambda x: string_split(x, '>')[1]), lambda x: x <> '' AND x[1] BETWEEN 'a' AND 'z') AS ts FROM c),
o AS (SELECT page_id, i - 1 AS ordinal, ts[i] AS t FROM p, unnest(range(1, len(ts) + 1)) AS u(i))
SELECT page_id, ordinal, string_split(t, ' ')[1] AS tag, CASE WHEN t LIKE '% class="%' THEN string_split(string_split(t, ' class="')[2], '"')[1] END AS class,
  CASE WHEN t LIKE '% href="%' THEN string_split(string_split(t, ' href="')[2], '"')[1] END AS href, len(string_split(t, '="')) - 1 AS attributes FROM o""")
def s1_scan_markup(t: Tables):
    e = S.scan_markup(t.pages, "page_id", "html")
    return e.select("page_id", "ordinal", "tag", "class", F.try_element_at("attrs", F.lit("href")).alias("href"), F.size("attrs").alias("attributes"))


@query("SELECT 'd' || doc_id AS verse_key, pos AS position, line_no AS line_number, token AS text FROM tok WHERE token NOT LIKE '%.'", "tok")
def s2_scan_nested_json(t: Tables):
    word = F.struct(F.col("pos").alias("position"), F.when(F.endswith("token", F.lit(".")), "end").otherwise("word").alias("char_type_name"), F.col("line_no").alias("line_number"), F.col("token").alias("text"))
    verses = t.tok_by_doc.groupBy("doc_id").agg(F.collect_list(word).alias("words")).select(F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("d"), "doc_id").alias("verse_key"), F.lit(1).alias("juz_number"), "words")).alias("verses"))).alias("j"))
    return S.explode_words(verses.select(F.from_json("j", S.PAGE_WORDS).alias("p")).select("p.verses")).select("verse_key", "position", "line_number", "text")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 13 <> 0")
def s3_read_log(t: Tables):
    """The log as JSON lines in the shared folder, every 13th line broken, read back without the broken ones."""
    path = _scratch(t, "log")
    line = F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")))
    t.events.select(F.when(F.col("event_id") % 13 == 0, "{broken").otherwise(line).alias("value")).write.text(path)
    return S.read_log(t.spark, path, "event_id long, k long")


@query("SELECT pos AS position, token, doc_id FROM tok", "tok")
def s4_columnar_unpack(t: Tables):
    rows = t.tok_by_doc.groupBy("doc_id").agg(F.collect_list(F.array(F.col("token"), F.col("doc_id").cast("string"), F.col("pos").cast("string"))).alias("rows"))
    files = rows.select(F.to_json(F.struct(F.array(*map(F.lit, ("token", "doc_id", "position"))).alias("fields"), "rows")).alias("j"))
    return S.columnar_unpack(files, "j", {"position": "long", "token": "string", "doc_id": "long"})


@query("SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name FROM customer")
def s5_read_dim_tsv(t: Tables):
    path = _scratch(t, "dim")
    lines = t.customer.select(F.explode(F.array(F.concat_ws("\t", "c_custkey", "c_name"), F.lit("# remark"), F.lit(""))).alias("value"))
    lines.write.text(path)
    return S.read_dim_tsv(t.spark, path, "key long, name string")


@query()
def s6_write_partitioned(t: Tables):
    path = _scratch(t, "parts")
    P.write_partitioned(t.customer, "c_nationkey", ["c_custkey"], path)
    return P.manifest_files(t.spark, path).select("bytes", "sha256")


@query("""WITH h AS (SELECT l_orderkey, sha256(l_partkey || '|' || l_linenumber || '|' || CAST(l_quantity AS BIGINT) || '|' || l_returnflag) AS h FROM lineitem) SELECT l_orderkey, count(*) AS rows, sha256(string_agg(h, chr(10) ORDER BY h)) AS digest FROM h GROUP BY 1""")
def s7_manifest(t: Tables):
    row = F.concat_ws("|", "l_partkey", "l_linenumber", F.col("l_quantity").cast("long"), "l_returnflag")
    return P.manifest(t.lineitem, "l_orderkey", row)


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def s8_incremental_todo(t: Tables):
    return P.incremental_todo(t.lineitem, t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@query("SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1")
def s8_resumed(t: Tables):
    """A sweep over orders that breaks off in its third piece and is run again."""
    store = ResultStore(t.spark, _scratch(t, "sweep"), "l_orderkey", "long", "l_orderkey long, n long, q long")
    sums = lambda rows: rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    calls = iter(range(3))

    def breaks_off(rows):
        if next(calls) == 2:
            raise InterruptedError
        return sums(rows)

    try:
        store.process(t.lineitem, breaks_off, pieces=4)
    except InterruptedError:
        pass
    return store.process(t.lineitem, sums, pieces=4)


@query("SELECT arg_max(v, [CAST(x AS INT) for x in string_split(v, '.')]) AS latest FROM (SELECT p_size || '.' || (p_partkey % 97) || '.' || (p_partkey % 11) AS v FROM part)")
def s9_latest_version(t: Tables):
    return P.latest_version(t.part.select(F.concat_ws(".", "p_size", F.col("p_partkey") % 97, F.col("p_partkey") % 11).alias("version")))


@query()
def p1_build_index(t: Tables):
    """Documents as published: all of them behind the gate, with the number of words that no document before has."""
    words = t.tok_by_doc.select("doc_id", "line_no", "pos", "token", F.concat_ws(":", "doc_id", "line_no", "pos").alias("key"))
    parts = P.build_index(words, "doc_id", "token", "key", ["line_no", "pos"])
    return parts["published"].select("doc_id", "n", "first_key", "last_key", "digest", "first_seen")


@query("SELECT count(*) AS rows, 0::BIGINT AS differing FROM documents")
def p2_profile_projection(t: Tables):
    small, differing = P.profile_projection(t.documents, ["lang", "n_chars"], "doc_id", "text", _scratch(t, "profiles"))
    n = small.agg(F.count(F.lit(1)).alias("rows")).unionByName(differing.agg(F.count(F.lit(1)).alias("differing")), allowMissingColumns=True)
    return n.agg(F.max("rows").alias("rows"), F.max("differing").alias("differing"))


@query("""WITH s AS (SELECT doc_id, length(replace(text, chr(10), '')) AS size FROM documents WHERE lang IS NOT NULL)
SELECT coalesce(d.doc_id, s.doc_id) AS doc_id, CASE WHEN s.doc_id IS NULL THEN 'full only' WHEN d.doc_id IS NULL THEN 'small only' ELSE 'differs' END AS what
FROM documents d FULL JOIN s ON d.doc_id = s.doc_id WHERE s.doc_id IS NULL OR d.doc_id IS NULL OR d.n_chars IS DISTINCT FROM s.size""")
def p2_profiles_differ(t: Tables):
    """The profile of all documents beside one that joins their lines and leaves out documents without a language."""
    small = t.documents.where("lang is not null").select("doc_id", F.length(F.replace("text", F.lit("\n"), F.lit(""))).alias("size"))
    return P.profiles_differ(t.documents.select("doc_id", F.col("n_chars").alias("size")), small, "doc_id", "size")
