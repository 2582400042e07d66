"""Exact deduplication by skew-safe combining.

Digests are counted first, in narrow rows; only texts whose digest occurs again travel.  Those are deduplicated in the task that reads
them, copies of one text from many tasks meet in salted groups, and the winners of the salts meet once more.  Each of the three
steps groups by the text itself next to its digest, so texts are equal only where their contents are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import maybe, stored, table

#: Groups that the copies of one text are dealt to before their winners meet.
SALTS = 64


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def combined(texts: DataFrame, salts: int = SALTS) -> DataFrame:
    """``digest, text, keep_id, group_size`` of rows ``digest, text, id``: one row for each text, with its largest id and number of rows.

    The first aggregate combines within each task before it shuffles, then within each salt; the second combines at most ``salts``
    winners of a text.
    """
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    local = texts.withColumn("salt", salt).groupBy("digest", "salt", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return local.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(
    df: DataFrame, key: str, text: str, normalise: Callable[[Column], Column] | None = None, digest: Callable[[Column], Column] = sha256, salts: int = SALTS
) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256``: one row for each row of ``df``, dropped ones too.

    Texts are equal where they are identical after ``normalise`` (none: as they are); null counts as empty.  Of equal texts the row with
    the largest key stays, a null key being the least; of rows that repeat that key, one.  Other columns don't count, whatever
    their names.  An empty table gives no rows.  Texts that share a ``digest`` without being equal are told apart by content.
    """
    clean = F.coalesce(F.col(text), F.lit(""))
    clean = normalise(clean) if normalise else clean
    whole = df.select(F.col(key).alias("id"), clean.alias("text")).withColumn("digest", digest(F.col("text")))
    rows = stored(whole.select(F.monotonically_increasing_id().alias("row"), "id", "digest", sha256(F.col("text")).alias("text_sha256")), "dedup-rows")
    # The row to keep is the first of those with the largest key.
    last = F.max(F.struct("id", (-F.col("row")).alias("r")))
    again = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), last.alias("last")).where("n > 1").select("digest", F.negative("last.r").alias("keep_row"))
    again = stored(again, "dedup-again")
    suspects = maybe(whole.withColumn("_h", F.xxhash64("digest")), "_h", again.select(F.xxhash64("digest").alias("_id")))
    winners = stored(combined(suspects.select("digest", "text", "id"), salts), "dedup-winners")
    texts = winners.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    alike = stored(again.join(texts, "digest"), "dedup-alike")
    found = rows.join(alike, "digest", "left").where("texts is null or texts = 1")
    several, here = F.col("texts").isNotNull(), F.col("row") == F.col("keep_row")
    out = found.select(
        F.col("id").alias(key), F.when(several, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (~several | here).alias("kept"), "text_sha256",
    )
    clash = alike.where("texts > 1").select("digest")
    if not clash.head(1):
        return out
    # Different texts under one digest: their rows take the winner of the same content.
    mixed = whole.join(clash, "digest").join(winners, ["digest", "text"])
    first = F.row_number().over(Window.partitionBy("digest", "text", "id").orderBy(F.lit(1)))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (first == 1)
    return out.unionByName(mixed.select(F.col("id").alias(key), "keep_id", "group_size", kept.alias("kept"), sha256(F.col("text")).alias("text_sha256")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return exact_dedup(table(spark, sf_dir, "documents"), "doc_id", "text")


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
