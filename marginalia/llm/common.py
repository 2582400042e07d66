"""Shared helpers of the operators in this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import shared_dir, stored  # noqa: F401
from ..session import ship

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch, where the session has Spark's own default of 10,000: a batch holds whole texts, on both sides of the pipe.
BATCH_ROWS, DEFAULT_ROWS = "1000", "10000"


def prepared(spark: SparkSession) -> None:
    """Ship this package, and keep batches of texts small."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == DEFAULT_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of the table of ``maybe``.
FILTER_BITS = 1 << 25


def maybe(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``column`` isn't ``_id`` of a row of ``wanted`` (both longs).

    A hashed bit table says so, which has a fixed size whatever the input, so that it can be broadcast.  None of the wanted is lost; the
    more there are, the more of the others stay, for the join that follows.
    """
    place = lambda c: f"pmod(xxhash64({c}), {FILTER_BITS}L)"
    bits = wanted.select(F.expr(f"{place('_id')} div 64").alias("_word"), F.expr(f"shiftleft(1L, cast({place('_id')} % 64 as int))").alias("_b"))
    bits = bits.groupBy("_word").agg(F.bit_or("_b").alias("_bits"))
    found = rows.join(F.broadcast(bits), F.expr(f"{place(column)} div 64") == F.col("_word"))
    return found.where(F.expr(f"getbit(_bits, cast({place(column)} % 64 as int)) = 1")).select(*rows.columns)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def public_tokenizer(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file: in ``folder``, else where the installed ``public_tokenizers`` package has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
