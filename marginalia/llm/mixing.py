"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow.  Its documents are shuffled by a hash, and a document's virtual finish time is the number of source
tokens up to it, divided by the source's target; tokens are counted to the document's middle, so that a long document at the cut
goes in where most of it fits.  All flows are range-sorted together by finish time, which serves them in proportion to their
targets, and the mix is cut where the running sum passes the total budget.

Nothing grows with one source: the running sum inside a source is taken over hash buckets of bounded size plus a prefix over
the buckets' sums, and the global one over the ranges of the sort plus a walk through the one range in which the budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, word_count

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MAX_REPEATS = 3
#: Rows per bucket and per range aimed at, and ranges at most.
ROWS_PER_BUCKET = 20_000
MOST_RANGES = 10_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Target of every source: ``(source, source_size)`` -> ``(source, source_size, target)``.

    Sources ordered by code point, null last, weigh ``weights`` in turn and share all sizes by weight.
    A target stops at ``max_repeats`` times its source's size and the excess is shared again by weight.
    With caps sorted by cap / weight this is one pass: the shared level is (total - caps before) /
    (weights from here on) at the first source whose own cap isn't below it; later levels are lower.
    One row per source.
    """
    cap = F.col("source_size") * max_repeats
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (pick + 1).cast("int")))
    by_cap = Window.orderBy(cap / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levelled = weighed.select(
        "source", "source_size", "_w", cap.alias("_cap"), ((F.sum("source_size").over(everything) - before) / left).alias("_level")
    )
    own = F.col("_cap") / F.col("_w")
    level = F.coalesce(F.max(F.when(F.col("_level") <= own, F.col("_level"))).over(everything), F.max(own).over(everything))
    return levelled.select("source", "source_size", F.least(F.col("_w") * level, F.col("_cap").cast("double")).alias("target"))


def mix(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken``.

    ``copies`` (0 to ``max_repeats``) is how often the mix takes the document, ``taken`` = copies x size.
    A source that must give more than it has is run through again.  Rows are taken in the global order of finish times until the
    next would pass the total budget, the sum of all sizes, so a source misses its target by about half a document.

    Null sizes count 0; a null source is a source of its own; null keys sort first among equals;
    equal rows are interchangeable and each gets its own place; an empty table gives no rows.
    """
    flow = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    flow = stored(flow.withColumn("_h", F.md5(name.cast("binary"))), "mix-sizes")
    rows = flow.count()
    # An order-preserving bucket: the first hex digits of the hash.
    digits = max(1, min(6, math.ceil(math.log(max(2, rows / ROWS_PER_BUCKET), 16))))
    flow = flow.withColumn("_b", F.substring("_h", 1, digits))
    sums = flow.groupBy("source", "_b").agg(F.sum("size").alias("_sum"))
    plan = targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, max_repeats)
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    prefix = (
        sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select(F.col("source").alias("_s"), F.col("_b").alias("_pb"), "_before", "source_size", "target")
    )
    inside = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        flow.withColumn("_cum", F.sum("size").over(inside))
        .join(prefix, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_pb")))
        .select("doc_id", "source", "size", "source_size", "target", "_h", (F.col("_before") + F.col("_cum")).alias("_end"))
    )
    placed = stored(placed, "mix-places")

    def ticket(copy: int) -> Column:
        """A copy's place in the global order; null where it begins past its source's target, so that it can't be in the mix."""
        end = F.col("_end") + copy * F.col("source_size")
        finish = (2 * end - F.col("size")) / F.when(F.col("target") > 0, 2 * F.col("target"))
        place = F.struct(
            finish.alias("finish"), F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("source"),
            F.col("_h").alias("h"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("_end").alias("end"),
        )
        return F.when((F.col("target") > 0) & (F.col("size") > 0) & (end - F.col("size") < F.col("target")), place)

    # The copies that begin below their targets sum to the budget at least.
    queue = placed.select("size", F.explode(F.array_compact(F.array(*map(ticket, range(max_repeats))))).alias("_t"))
    ranges = max(1, min(MOST_RANGES, rows // ROWS_PER_BUCKET))
    queue = stored(queue.repartitionByRange(ranges, "_t").withColumn("_range", F.spark_partition_id()), "mix-queue")
    budget = placed.agg(F.sum("size")).first()[0] or 0
    so_far = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    served = queue.groupBy("_range").agg(F.sum("size").alias("_sum"), F.max("_t").alias("_last"))
    served = served.withColumn("_before", F.coalesce(F.sum("_sum").over(so_far), F.lit(0))).where(F.col("_before") <= budget)
    # The range in which the budget ends, the last ticket before it, and the last one inside it that still fits.
    end = served.agg(F.max(F.struct("_range", "_before")).alias("at")).first()["at"]
    cut = None
    if end is not None:
        one = Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
        fits = queue.where(F.col("_range") == end["_range"]).withColumn("_run", F.sum("size").over(one))
        fits = fits.where(F.col("_run") + end["_before"] <= budget).select("_t")
        earlier = served.where(F.col("_range") < end["_range"]).select(F.col("_last").alias("_t"))
        cut = fits.unionByName(earlier).agg(F.max("_t").alias("t")).first()["t"]
    taken = F.lit(0)
    if cut is not None:
        kinds = {"finish": "double", "unnamed": "boolean", "source": "string", "h": "string", "doc_id": "long", "end": "long"}
        limit = F.struct(*[F.lit(cut[n]).cast(k).alias(n) for n, k in kinds.items()])
        taken = sum((F.when(ticket(c) <= limit, 1).otherwise(0) for c in range(max_repeats)), F.lit(0))
    taken = F.when(F.col("size") > 0, taken).otherwise(F.when(F.col("target") > 0, 1).otherwise(0)).cast("int")
    mixed = placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("copies"))
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: ``doc_id, size, source_size, target, taken``; sizes are words."""
    docs = table(spark, sf_dir, "documents")
    target = F.coalesce("target", F.lit(0.0)).alias("target")
    return mix(docs, word_count(F.col("text"))).select("doc_id", "size", "source_size", target, "taken")


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
flow AS (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)) AS h FROM sized),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM flow GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)] AS w, source_size * 3 AS cap
  FROM sizes),
levelled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER lower, 0)) / sum(w) OVER upper AS level FROM weighed
  WINDOW lower AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         upper AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
plan AS (
  SELECT source, source_size,
         least(w * coalesce(max(CASE WHEN level <= cap / w THEN level END) OVER (), max(cap / w) OVER ()), CAST(cap AS DOUBLE)) AS target
  FROM levelled),
placed AS (
  SELECT f.doc_id, f.source, f.size, f.h, p.source_size, p.target,
         sum(f.size) OVER (PARTITION BY f.source ORDER BY f.h, f.doc_id, f.size ROWS UNBOUNDED PRECEDING) AS "end"
  FROM flow f JOIN plan p ON f.source IS NOT DISTINCT FROM p.source),
queue AS (
  SELECT *, (2 * ("end" + c * source_size) - size) / (2 * target) AS finish
  FROM placed, (SELECT unnest([0, 1, 2]) AS c)
  WHERE size > 0 AND target > 0 AND "end" + c * source_size - size < target),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, coalesce(source, ''), h, coalesce(doc_id, -1), "end" ROWS UNBOUNDED PRECEDING) AS run
  FROM queue),
got AS (
  SELECT source, h, doc_id, "end", count(*) AS copies FROM served
  WHERE run <= (SELECT sum(size) FROM flow) GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(g.copies, 0) * p.size AS BIGINT) AS taken
FROM placed p LEFT JOIN got g
  ON p.source IS NOT DISTINCT FROM g.source AND p.doc_id IS NOT DISTINCT FROM g.doc_id AND p.h = g.h AND p."end" = g."end" AND p.size > 0
"""


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with all their columns.

    Rows alike in id, source and size share what the mix takes of them all as evenly as can be.
    """
    alike = ["__m_id", "__m_source", "__m_size"]
    took = mix(docs, word_count(F.col("text"))).groupBy(*[F.col(c).alias(a) for c, a in zip(("doc_id", "source", "size"), alike)])
    took = took.agg(F.sum("copies").alias("__m_copies"), F.count(F.lit(1)).alias("__m_rows")).where("__m_copies > 0")
    took = stored(took, "mix-copies")
    match = F.col("doc_id").eqNullSafe(F.col("__m_id")) & F.col("source").eqNullSafe(F.col("__m_source"))
    match &= word_count(F.col("text")) == F.col("__m_size")
    # As many rows as documents: never broadcast, so that the plan is the same at every size.
    out = docs.join(took.where("__m_rows = 1").hint("merge"), match).withColumn("__m_own", F.col("__m_copies"))
    shared = took.where("__m_rows > 1")
    if shared.head(1):
        turn = F.row_number().over(Window.partitionBy(*alike).orderBy("text"))
        extra = F.when(turn <= F.col("__m_copies") % F.col("__m_rows"), 1).otherwise(0)
        out = out.unionByName(docs.join(shared, match).withColumn("__m_own", F.floor(F.col("__m_copies") / F.col("__m_rows")) + extra))
    copies = F.explode(F.sequence(F.lit(1), F.col("__m_own").cast("int")))
    return out.where("__m_own > 0").withColumn("__m_copy", copies).select(*docs.columns)
