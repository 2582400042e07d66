"""Text search with a second, looser pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hit(value: Column, q: str, mode: str) -> Column:
    return {"includes": F.contains(value, F.lit(q)), "exact": value == q, "prefix": F.startswith(value, F.lit(q)), "regex": value.rlike(q)}[mode]


def text_search(df: DataFrame, key: str, strict: Column, loose: Column, q: str, q_loose: str, mode: str = "includes", limit: int | None = None) -> DataFrame:
    """Rows whose folded value matches, with the place of the match (from 0).  Only if no row at all matches strictly, and never for a
    regex, the loose values are searched, and those results are ``approximate``.  An empty query matches nothing."""
    if not q:
        return df.limit(0).select(key, F.lit(0).alias("at"), F.lit(False).alias("approximate"))
    where = lambda v, x: (F.instr(v, x) - 1 if mode != "regex" else F.regexp_instr(v, F.lit(x)) - 1).alias("at")
    hits = df.where(_hit(strict, q, mode)).select(key, where(strict, q), F.lit(False).alias("approximate"))
    if mode != "regex":
        none = hits.limit(1).agg((F.count(F.lit(1)) == 0).alias("_none"))
        second = df.where(_hit(loose, q_loose, mode)).select(key, where(loose, q_loose), F.lit(True).alias("approximate"), F.lit(True).alias("_none"))
        hits = hits.unionByName(second.join(F.broadcast(none), "_none", "left_semi").drop("_none"))  # one row
    return hits.orderBy(key).limit(limit) if limit else hits
