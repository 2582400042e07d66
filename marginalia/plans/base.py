"""Registering queries: a function of the tables, and the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Tables, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Columns as the SQL side has them: whole numbers as long, fractions rounded to 6 places."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint") or kind.startswith("decimal(20,0)"):
            c = c.cast("long")
        elif kind in ("double", "float"):
            c = F.round(c.cast("double"), 6) + 0.0
        out.append(c.alias(name))
    return df.select(*out)


def query(sql: str | None = None, *views: str):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(Tables(spark, sf_dir)))
        if sql:
            SQL[f.__name__] = duck(sql, *views)
        return f

    return register
