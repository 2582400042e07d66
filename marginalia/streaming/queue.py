"""The live review queue: the latest decision of every edit over an unbounded log, its changes, and labels kept by a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marginalia.operators.logs import STATES, apply_labels, state_of
from marginalia.sources.store import stored_rows


def live_states(log: DataFrame, key: str = "id", order: tuple[str, ...] = ("ts", "seq"), action: str = "action") -> DataFrame:
    """State of each key by its latest record; works on a batch or a stream.  Records out of order are settled by ``order``, which is
    compared inside the aggregate, so state holds one record per key."""
    last = log.groupBy(key).agg(F.max(F.struct(*order, action)).alias("_l"))
    return last.select(key, F.col(f"_l.{action}").alias("action"), state_of(F.col(f"_l.{action}")).alias("state"))


def start_live_queue(log: DataFrame, sink, checkpoint: str, once: bool = False, **options) -> StreamingQuery:
    """Start the queue in update mode; ``sink(batch, number)`` gets the states that changed.  A restart resumes at the checkpoint."""
    writer = live_states(log, **options).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def live_changes(log: DataFrame, key: str = "id", order: tuple[str, ...] = ("ts", "seq"), action: str = "action") -> DataFrame:
    """``key, action, state, was`` over an unbounded log: a key appears only when its state changes, with the state before (null: none).

    What is kept for a key is its latest record alone.  Records out of order don't undo later ones; of records equal in ``order`` (nulls
    first) the one that came later counts.  A record that leaves the state as it was, or is seen again, emits nothing.
    """
    fields = {f.name: f.dataType.simpleString() for f in log.schema.fields}
    whole = {c: F.unix_micros(c) if fields[c] == "timestamp" else F.col(c) for c in order}
    kinds = {c: "bigint" if fields[c] == "timestamp" else fields[c] for c in order}
    # Nulls cross as a flag beside some value: a null would turn whole numbers into fractions.
    filler = {c: F.lit("").cast("string") if kinds[c] == "string" else F.lit(0).cast(kinds[c]) for c in order}
    ranks = [x for c in order for x in (f"_known_{c}", f"_at_{c}")]
    sent = [x for c in order for x in (F.col(c).isNotNull().alias(f"_known_{c}"), F.coalesce(whole[c], filler[c]).alias(f"_at_{c}"))]
    kept = ", ".join(x for c in order for x in (f"_known_{c} boolean", f"_at_{c} {kinds[c]}")) + ", action string, state string"

    def step(of: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        last = tuple(held.get) if held.exists else None
        was = last[-1] if last else None
        for f in frames:
            row = f.sort_values(ranks, kind="stable").iloc[-1]
            new = tuple(x.item() if hasattr(x, "item") else x for x in (row[c] for c in ranks))
            if last is None or new >= last[: len(ranks)]:
                done = None if pd.isna(row["_action"]) else row["_action"]
                last = (*new, done, STATES.get(done, "proposed"))
        held.update(last)
        if last[-1] != was:
            yield pd.DataFrame({key: pd.Series([of[0]], dtype=object), "action": pd.Series([last[-2]], dtype=object), "state": [last[-1]], "was": pd.Series([was], dtype=object)})

    rows = log.select(key, *sent, F.col(action).alias("_action")).groupBy(key)
    return rows.applyInPandasWithState(step, f"{key} {fields[key]}, action string, state string, was string", kept, "update", GroupStateTimeout.NoTimeout)


def start_change_feed(log: DataFrame, path: str, checkpoint: str, once: bool = False, **options) -> StreamingQuery:
    """Write the changes of each batch to ``path/batch=<number>``; a batch that runs again overwrites what it wrote."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = live_changes(log, **options).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


class LabelSink:
    """L4: labels kept by a stream of decisions, as a ``foreachBatch`` sink.

    Each batch writes what it makes new or changes to ``root/batch=<number>``, worked out from the batches before it alone; so a batch that
    runs again, whole or after half of it was written, leaves the same rows.  The latest batch of a key holds its label.  A batch
    costs its own decisions and the labels of their keys, never a rewrite of the table.
    """

    def __init__(self, root: str, key: str, label: str, key_type: str = "long", force: bool = False):
        self.root, self.key, self.label, self.force = root, key, label, force
        self.schema = f"{key} {key_type}, {label} string, outcome string, batch long"

    def labels(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """``key, label`` after all batches, or those before one."""
        rows = stored_rows(spark, self.root, self.schema)
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        return rows.groupBy(self.key).agg(F.max_by(self.label, "batch").alias(self.label))

    def __call__(self, decisions: DataFrame, number: int) -> None:
        """``decisions (key, label, *order)``: the last of a key in the order of the other columns counts; null labels decide nothing."""
        order = [c for c in decisions.columns if c not in (self.key, self.label)]
        last = decisions.where(F.col(self.label).isNotNull() & F.col(self.key).isNotNull()).groupBy(self.key)
        last = last.agg(F.max(F.struct(*order, self.label)).alias("_l")).select(self.key, F.col(f"_l.{self.label}").alias(self.label))
        known = self.labels(decisions.sparkSession, number).join(last.select(self.key), self.key, "left_semi")
        found = apply_labels(known, last, self.key, self.label, self.force).where("outcome in ('new', 'changed')")
        found.write.mode("overwrite").parquet(f"{self.root}/batch={number}")
