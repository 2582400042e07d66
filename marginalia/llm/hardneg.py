"""Hard-negative mining with Four-Russians scoring.

Candidates travel as bit planes: eight components give a byte for each binary digit, in two's complement.  An anchor has, for each
group of eight components, a table of the sums of all 256 subsets of its components; a plane's byte looks the sum of a group up,
and planes add up by doubling, from the sign down.  That is the whole inner product, exactly.

Anchors meet the rows of their own label for positives, then all other rows in blocks for negatives; each task keeps only
its best rows for an anchor or a window of scores, and the best of all tasks are ranked once more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table
from .knn import matrix, quantised

#: Rows of a data chunk and anchors of a block aimed at; a task holds one of each.
CHUNK = 8192
BLOCK = 8192
#: Anchors scored at once.
SCORED = 64
LONG = 1 << 63
#: Sorts behind every id, for rows without one.
LAST = np.iinfo(np.int64).max


def planes(q: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes of longs (rows, dim): as many planes as the largest value needs, the last being the sign."""
    depth = 1 + max((int(abs(int(v) + (v < 0))).bit_length() for v in (q.min(initial=0), q.max(initial=0))), default=0)
    return np.stack([np.packbits(((q >> b) & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(depth)], axis=1)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of eight components."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    padded = np.zeros((n, groups * 8), kind)
    padded[:, :dim] = anchors
    padded = padded.reshape(n, groups, 8)
    sums = np.zeros((groups, 256, n), kind)
    for j in range(8):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + padded[:, :, j].T[:, None, :]
    return sums


def kind_for(anchors: np.ndarray, depth: int) -> type:
    """Numbers that hold every score and every partial sum: 32 bits, 64 bits, or Python's where even those might not do."""
    most = (max(1, abs(int(anchors.min())), abs(int(anchors.max()))) * anchors.shape[1]) << depth if anchors.size else 1
    return np.int32 if most < 1 << 31 else np.int64 if most < LONG else object


def scores(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products (rows, anchors) of rows as ``planes`` with anchors (anchors, dim)."""
    n, depth, groups = bits.shape
    sums = subset_sums(anchors, kind_for(anchors, depth))
    total = np.zeros((n, len(anchors)), sums.dtype)
    for b in range(depth - 1, -1, -1):
        total += total
        for g in range(groups):
            found = sums[g].take(bits[:, b, g], axis=0)
            if b == depth - 1:
                total -= found
            else:
                total += found
    return total


def fitting(values: np.ndarray) -> np.ndarray:
    """As longs; a score that doesn't fit raises, as arithmetic does in ANSI mode."""
    if values.dtype == object and any(not -LONG <= v < LONG for v in values.tolist()):
        raise ArithmeticError("an inner product does not fit in a long")
    return values.astype(np.int64)


def first_of(s: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest of ``s``, largest first, ties to the earlier place."""
    if len(s) > k:
        at = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
    else:
        at = np.arange(len(s))
    return at[np.argsort(-s[at], kind="stable")][:k]


def windows_of(s: np.ndarray, bounds: list[tuple[int, int]], k: int) -> list[np.ndarray]:
    """For each (low, high): places of the first ``k`` of ``s`` between them, largest first, ties to the earlier place."""
    at = np.flatnonzero((s >= min(b[0] for b in bounds)) & (s <= max(b[1] for b in bounds)))
    at = at[np.argsort(-s[at], kind="stable")]
    falling = -s[at]
    out = []
    for low, high in bounds:
        i, j = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
        out.append(at[i : min(j, i + k)])
    return out


class Chunk:
    """Rows of a task in tie order: smaller ids first, those without an id last."""

    def __init__(self, rows: pa.Table):
        ids = rows.column("id").fill_null(LAST).to_numpy()
        no_id = rows.column("id").is_null().to_numpy()
        order = np.lexsort((rows.column("row").to_numpy(), ids, no_id))
        self.rows = rows.take(pa.array(order))
        self.row, self.label = self.rows.column("row").to_numpy(), self.rows.column("label").to_numpy()
        depth, dim = self.rows.column("depth").to_numpy(), self.rows.column("dim")[0].as_py()
        groups = -(-dim // 8)
        self.bits = np.zeros((len(depth), depth.max(), groups), np.uint8)
        for d in np.unique(depth):
            mine = np.flatnonzero(depth == d)
            raw = b"".join(self.rows.column("bits").take(pa.array(mine)).to_pylist())
            self.bits[mine, :d] = np.frombuffer(raw, np.uint8).reshape(len(mine), d, groups)
            self.bits[mine, d:] = self.bits[mine, d - 1 : d]  # the sign goes on

    def blocks(self, anchors: pa.Table, dim: int):
        """Numbers of some anchors, and their scores (rows, anchors)."""
        q = matrix(anchors.column("q"), dim)
        for at in range(0, len(q), SCORED):
            yield range(at, min(at + SCORED, len(q))), scores(self.bits, q[at : at + SCORED])


def bit_rows(df: DataFrame, key: str, vector: str, label: Column, anchors: Column) -> DataFrame:
    """``row, id, label, dim, q, depth, bits`` of the usable rows; ``q`` (the components as longs) only where ``anchors`` holds."""
    q = quantised(df.withColumn("_label", label), key, vector, "_label", null_ids=True).where("_label is not null")
    q = q.select(F.monotonically_increasing_id().alias("row"), "id", F.col("_label").alias("label"), "dim", "q", F.coalesce(anchors, F.lit(False)).alias("asks"))

    def pack(batches):
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                bits = planes(matrix(part.column(4), int(d)))
                raw = pa.array([x.tobytes() for x in bits], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(part), bits.shape[1], np.int32)), raw], names=[*part.schema.names, "depth", "bits"])

    kind = q.schema["label"].dataType.simpleString()
    packed = q.mapInArrow(pack, f"row long, id long, label {kind}, dim int, q array<long>, asks boolean, depth int, bits binary")
    return packed.withColumn("q", F.when(F.col("asks"), F.col("q")))


def dealt(rows: DataFrame, anchors: DataFrame, by: list[str], chunk: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors of each group of ``by`` sent to all pairs of its chunks and blocks: both with ``_chunk, _block``."""
    n = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    a = anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("_a"))
    sizes = n.join(a, by).select(*by, F.ceil(F.col("_n") / chunk).cast("int").alias("_chunks"), F.ceil(F.col("_a") / block).cast("int").alias("_blocks"))
    sizes = stored(sizes, "hardneg-sizes")
    place = lambda of: F.pmod(F.xxhash64("row"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    r = rows.join(sizes, by).withColumn("_chunk", place("_chunks")).withColumn("_block", every("_blocks"))
    q = anchors.join(sizes, by).withColumn("_block", place("_blocks")).withColumn("_chunk", every("_chunks"))
    return r.drop("_chunks", "_blocks"), q.drop("_chunks", "_blocks")


def hard_negatives(
    df: DataFrame, key: str, vector: str, label: Column, anchors: Column, positives: int = 5, negatives: int = 10,
    low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), chunk: int = CHUNK, block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for the rows that ``anchors`` (of ``id``) marks and each
    of their ``positives`` best other rows of the same label, the best rows of other labels whose score is at least ``low`` and at most
    ``high`` times the positive's (fractions).

    Scores are integer inner products of components floor(256 x); ties go to the smaller key, rows without a key come last, and rows that
    repeat others are rows like others.  Rows with a null label, a null vector or a null or non-finite component take no part, and
    vectors meet those of their own length only.  A component or a returned score that doesn't fit in a long raises an error.  No
    anchors, no positives or nothing between the bounds give no rows.
    """
    rows = stored(bit_rows(df, key, vector, label, anchors), "hardneg-rows")
    # Columns of their own: a table can't be grouped with itself.
    asked = rows.where("asks").select(*[F.col(c).alias(c) for c in ("row", "id", "label", "dim", "q")])
    rows = rows.select("row", "id", "label", "dim", "depth", "bits")
    kind = "anchor_row long, anchor_id long, id long, row long, score long"

    def nearest(asked: pa.Table, rows: pa.Table) -> pa.Table:
        found = [[], [], []]
        if len(asked) and len(rows):
            data = Chunk(rows)
            own = asked.column("row").to_numpy()
            for numbers, s in data.blocks(asked, asked.column("dim")[0].as_py()):
                for j, n in enumerate(numbers):
                    others = np.flatnonzero(data.row != own[n])
                    best = others[first_of(s[others, j], positives)]
                    found[0].append(np.full(len(best), n))
                    found[1].append(best)
                    found[2].append(fitting(s[best, j]))
            rows = data.rows
        a, r, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        took, met = asked.take(pa.array(a.astype(np.int64))), rows.take(pa.array(r.astype(np.int64)))
        columns = [took.column("row"), took.column("id"), met.column("id"), met.column("row"), pa.array(s, pa.int64())]
        return pa.table(columns, names=["anchor_row", "anchor_id", "id", "row", "score"])

    place = ["dim", "label", "_block", "_chunk"]
    r, q = dealt(rows, asked, ["dim", "label"], chunk, block)
    best = q.groupBy(*place).cogroup(r.groupBy(*place)).applyInArrow(nearest, kind)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    best = best.withColumn("no", F.row_number().over(Window.partitionBy("anchor_row").orderBy(*order))).where(F.col("no") <= positives)
    # At most ``positives`` entries each.
    wanted = best.groupBy(F.col("anchor_row").alias("row")).agg(F.array_sort(F.collect_list(F.struct("no", "id", "score"))).alias("wanted"))
    wanted = stored(asked.join(wanted, "row"), "hardneg-wanted")

    def between(asked: pa.Table, rows: pa.Table) -> pa.Table:
        found, windows = [[], [], []], [[], []]
        if len(asked) and len(rows):
            data = Chunk(rows)
            own, wanted = asked.column("label").to_numpy(), asked.column("wanted").to_pylist()
            for numbers, s in data.blocks(asked, asked.column("dim")[0].as_py()):
                for j, n in enumerate(numbers):
                    others = np.flatnonzero(data.label != own[n])
                    p = wanted[n]
                    bounds = [(-(-low[0] * w["score"] // low[1]), high[0] * w["score"] // high[1]) for w in p]
                    for w, at in zip(p, windows_of(s[others, j], bounds, negatives)):
                        found[0].append(np.full(len(at), n))
                        found[1].append(others[at])
                        found[2].append(fitting(s[others[at], j]))
                        windows[0] += [w["no"]] * len(at)
                        windows[1] += [(w["id"], w["score"])] * len(at)
            rows = data.rows
        a, r, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        took, met = asked.take(pa.array(a.astype(np.int64))), rows.take(pa.array(r.astype(np.int64)))
        positive = [pa.array([w[i] for w in windows[1]], pa.int64()) for i in (0, 1)]
        columns = [took.column("row"), took.column("id"), met.column("id"), met.column("row"), pa.array(s, pa.int64()), pa.array(windows[0], pa.int32()), *positive]
        return pa.table(columns, names=["anchor_row", "anchor_id", "id", "row", "score", "no", "positive_id", "positive_score"])

    place = ["dim", "_block", "_chunk"]
    r, q = dealt(rows, wanted, ["dim"], chunk, block)
    met = q.groupBy(*place).cogroup(r.groupBy(*place)).applyInArrow(between, kind + ", no int, positive_id long, positive_score long")
    met = met.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_row", "no").orderBy(*order))).where(F.col("rank") <= negatives)
    return met.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for every 100th vector and each of its five positives; where the id divides by 7, the label is the next one."""
    poisoned = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", poisoned, F.col("id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.r, b.vec_id, b.r AS other, a.label = b.label AS same,
         CAST(list_sum([a.q[i] * b.q[i] for i in range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS n FROM s WHERE same) WHERE n <= 5),
m AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.n ORDER BY s.score DESC, s.vec_id NULLS LAST, s.other) AS rank
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 10
"""
