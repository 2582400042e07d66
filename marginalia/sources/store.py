"""Results that are appended piece by piece: a run that breaks off goes on where it stopped, and nothing is stored twice."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "seq long, run string, kind string, rows long"


def stored_rows(spark: SparkSession, path: str, schema: str, source: str = "parquet") -> DataFrame:
    """The rows under a path; none where nothing was written yet."""
    try:
        return spark.read.schema(schema).format(source).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class ResultStore:
    """Results by key under ``root``, with a ledger of what was committed.

    A piece of work writes its rows, then the keys it has done, then a line in the ledger.  Only what the ledger names is ever read, so
    what a broken run leaves behind counts for nothing and needs no cleaning.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, key_type: str, schema: str):
        self.spark, self.root, self.key, self.schema = spark, root.rstrip("/"), key, schema
        self.keys = f"{key} {key_type}, run string"

    def ledger(self) -> list:
        """Its lines in order: one for each committed piece or clearing, so as few as those."""
        return stored_rows(self.spark, f"{self.root}/ledger", LEDGER, "json").orderBy("seq").collect()

    def _committed(self, what: str, schema: str) -> DataFrame:
        lines = self.ledger()
        cleared = max((r.seq for r in lines if r.kind == "clear"), default=-1)
        live = [r.run for r in lines if r.kind == "done" and r.seq > cleared]
        # The runs are partitions: others aren't even listed as files to read.
        return stored_rows(self.spark, f"{self.root}/{what}", schema).where(F.col("run").isin(live)).drop("run")

    def results(self) -> DataFrame:
        return self._committed("results", f"{self.schema}, run string")

    def done(self) -> DataFrame:
        return self._committed("keys", self.keys)

    def _note(self, run: str, kind: str, rows: int) -> None:
        line = [(max((r.seq for r in self.ledger()), default=-1) + 1, run, kind, rows)]
        self.spark.createDataFrame(line, LEDGER).coalesce(1).write.mode("append").json(f"{self.root}/ledger")

    def clear(self) -> None:
        """Earlier results count no longer."""
        self._note("", "clear", 0)

    def append(self, rows: DataFrame, keys: DataFrame) -> None:
        """Commit ``rows`` as the results of ``keys``, which may have several rows or none."""
        run = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/results/run={run}")
        keys.select(self.key).distinct().write.parquet(f"{self.root}/keys/run={run}")
        self._note(run, "done", stored_rows(self.spark, f"{self.root}/results/run={run}", self.schema).count())

    def process(self, every: DataFrame, work: Callable[[DataFrame], DataFrame], pieces: int = 8, force: bool = False) -> DataFrame:
        """Results of all keys of ``every``: ``work`` gets the rows of keys without one, in ``pieces`` by hash, each committed on its own.

        Run again after a failure, it does what is missing; ``force`` clears first and does all.  Rows with a null key take no part.
        """
        if force:
            self.clear()
        every = every.where(F.col(self.key).isNotNull()).withColumn("_piece", F.pmod(F.xxhash64(self.key), F.lit(pieces)))
        for n in range(pieces):
            todo = every.where(F.col("_piece") == n).drop("_piece").join(self.done(), self.key, "left_anti")
            if todo.head(1):
                self.append(work(todo), todo)
        return self.results()
