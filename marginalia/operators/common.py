"""Small helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def by(*names: str | Column) -> Window:
    return Window.partitionBy(*names)


#: Folders of local sessions without one, by application.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a temporary one in local mode where it is unset, as in tests."""
    at, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not at:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = _own.setdefault(context.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="marginalia-")
        _own[context.applicationId] = at
    return at.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once into the shared folder and read again: loops cut their lineage so, and survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/marginalia-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows up to which a table is sent to all tasks.
SMALL = 10_000


def sent(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it has ``SMALL`` rows at most, which are counted; else as it is, for a join that shuffles."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


#: Rows of a group up to which they meet by the group alone; in larger groups they meet in buckets or cells.
TOGETHER = 256


def large_groups(group: str, *rows: DataFrame) -> DataFrame | None:
    """``(_g)``, stored: groups of more than ``TOGETHER`` rows in any of ``rows``; None if there are none."""
    large = [counts(d, group).where(F.col("n") > TOGETHER).select(F.col(group).alias("_g")) for d in rows]
    found = stored(reduce(DataFrame.unionByName, large).distinct(), "large-groups")
    return found if found.head(1) else None


def of_groups(df: DataFrame, group: str, names: DataFrame, yes: bool) -> DataFrame:
    """Rows of the groups ``(_g)``, or all others."""
    return df.join(names, F.col(group).eqNullSafe(F.col("_g")), "left_semi" if yes else "left_anti")


def by_place(a: DataFrame, b: DataFrame, group: str, pos: str, value: str) -> DataFrame:
    """``group, pos`` of both sides with how the rows of a place pair: ``_a, _b`` rows of each side, ``_va, _vb`` those with a value, ``_same``
    pairs of equal values, ``_nulls`` pairs of nulls; ``_alone`` where a side has none (a null group or place meets nothing).

    Groupings in place of a join: sides that are dealt by group already aren't shuffled again, and copies of a place never multiply."""
    side = lambda d, x, y: d.select(group, pos, F.col(value).alias("_v"), F.lit(x).cast("long").alias("_a"), F.lit(y).cast("long").alias("_b"))
    each = side(a, 1, 0).unionByName(side(b, 0, 1)).groupBy(group, pos, "_v").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    there = lambda c, yes: F.coalesce(F.sum(F.when(F.col("_v").isNotNull() if yes else F.col("_v").isNull(), c)), F.lit(0))
    pairs = F.col("_a") * F.col("_b")
    g = each.groupBy(group, pos).agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"), there(F.col("_a"), True).alias("_va"), there(F.col("_b"), True).alias("_vb"), there(pairs, True).alias("_same"), there(pairs, False).alias("_nulls")
    )
    return g.withColumn("_alone", F.col(group).isNull() | F.col(pos).isNull() | (F.col("_a") == 0) | (F.col("_b") == 0))


def counts(df: DataFrame, *names: str, n: str = "n") -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(n))
