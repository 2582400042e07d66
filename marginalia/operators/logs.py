"""Operators on append-only review logs; they also serve as the body of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import latest_by_key

#: What a decision makes of an edit; anything else leaves it proposed (fixed values).
STATES = {"approve": "approved", "amend": "approved", "reject": "rejected", "withdraw": "withdrawn"}


def state_of(action: Column) -> Column:
    out = None
    for a, s in STATES.items():
        out = F.when(action == a, s) if out is None else out.when(action == a, s)
    return out.otherwise("proposed")


def edit_state(edits: DataFrame, decisions: DataFrame, key: str, order: list[str], action: str) -> DataFrame:
    """L1: every edit with the state its latest decision gives it."""
    last = latest_by_key(decisions, key, order, [action]).withColumnRenamed(action, "_a")
    return edits.join(last, key, "left").withColumn("state", state_of(F.col("_a"))).drop("_a")


def export_approved(edits: DataFrame, decisions: DataFrame, key: str, order: list[str], action: str, payload: str, amended: str) -> DataFrame:
    """L2: edits not rejected nor undecided; an amendment replaces the payload; withdrawn ones are kept and flagged."""
    last = latest_by_key(decisions, key, order, [action, amended])
    j = edits.join(last, key).where(F.col(action).isin("approve", "amend", "withdraw"))
    value = F.when(F.col(action) == "amend", F.coalesce(amended, payload)).otherwise(F.col(payload))
    return j.select(key, value.alias("payload"), (F.col(action) == "withdraw").alias("withdrawn"))


def page_status(states: DataFrame, page: str, step: str, state: str, done: DataFrame) -> DataFrame:
    """L3: per page and step: done (listed in ``done``) over in-review (any live edit) over pending; with the pending and all edits."""
    g = states.groupBy(page, step).agg(F.count_if(F.col(state) == "proposed").alias("pending"), F.count_if(F.col(state).isin("proposed", "approved")).alias("live"), F.count(F.lit(1)).alias("edits"))
    j = g.join(done.select(page, step).distinct().withColumn("_d", F.lit(True)), [page, step], "full_outer").fillna(0, ["pending", "live", "edits"])
    return j.select(page, step, F.when(F.col("_d"), "done").when(F.col("live") > 0, "in-review").otherwise("pending").alias("status"), "pending", "edits")


def apply_labels(table: DataFrame, decisions: DataFrame, key: str, label: str, force: bool = False) -> DataFrame:
    """L4: upsert labels: new, changed, same or refused (a composite ``a+b`` isn't replaced by a single name unless forced), or kept."""
    j = table.select(key, F.col(label).alias("_old")).join(decisions.select(key, F.col(label).alias("_new")), key, "full_outer")
    refused = F.lit(not force) & F.contains(F.col("_old"), F.lit("+")) & ~F.contains(F.col("_new"), F.lit("+"))
    out = F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col("_new"), "same").when(refused, "refused").otherwise("changed")
    j = j.withColumn("outcome", out)
    return j.select(key, F.when(F.col("outcome").isin("kept", "refused"), F.col("_old")).otherwise(F.col("_new")).alias(label), "outcome")


def merge_verdicts(scores: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Scores ``(key, p, tier, sig)`` under the latest verdicts ``(key, status, sig)``: no-issue -> clean; another signature ->
    stale, review at p >= .5; reopened -> review at p >= .6; confirmed and now clean -> fixed."""
    v = verdicts.select(key, F.col("status").alias("_st"), F.col("sig").alias("_vs"))
    j = scores.join(v, key, "left")
    stale = F.col("_st").isNotNull() & ~F.col("_vs").eqNullSafe(F.col("sig"))
    status = F.when(F.col("_st") == "reopened", "reopened").when((F.col("_st") == "confirmed") & (F.col("tier") == "clean"), "fixed").when(stale, "stale").otherwise(F.coalesce("_st", F.lit("open")))
    j = j.withColumn("status", status)
    p = F.when(F.col("status") == "stale", F.greatest("p", F.lit(0.5))).when(F.col("status") == "reopened", F.greatest("p", F.lit(0.6))).otherwise(F.col("p"))
    t = F.when(F.col("status") == "no-issue", "clean").when(F.col("status").isin("stale", "reopened"), "review").otherwise(F.col("tier"))
    return j.select(key, p.alias("p"), t.alias("tier"), "status")


def check_overrides(overrides: DataFrame, current: DataFrame, key: str, family: str, text: str) -> DataFrame:
    """Overrides whose key is gone (dead) or whose family the target's text lacks (contradiction)."""
    j = overrides.join(current.select(key, F.col(text).alias("_t"), F.lit(1).alias("_x")).dropDuplicates([key]), key, "left")
    why = F.when(F.col("_x").isNull(), "dead").when(~F.contains(F.col("_t"), F.col(family)), "contradiction")
    return j.withColumn("problem", why).where("problem is not null").select(*overrides.columns, "problem")
