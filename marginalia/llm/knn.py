"""Exact top-k search by inner product: a Voronoi kNN join.

Pivots cut the space into cells.  Each row joins the cell of its nearest pivot; per cell a summary
(rows, radius, longest vector) bounds every inner product of a query with the cell's rows from above and below:
q.p - |q| r <= q.x <= q.p + |q| r.  The lower bounds give each query a score that its k-th best row
reaches; a cell whose upper bound stays below it can't hold an answer.  Queries are grouped by cell
into blocks, rows of a cell into chunks, and only the pairs a bound can't rule out are sent anywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Pivots are as many as the root of the number of rows, within these bounds; the driver holds them and a line for each cell.
LEAST_PIVOTS, MOST_PIVOTS = 64, 16_384
#: Rows of a data chunk and of a query block aimed at; a task holds one of each.
CHUNK = 4096
BLOCK = 4096
SCALE = 256
#: Queries routed at once.
ROUTED = 512


def _usable(v: Column) -> Column:
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.coalesce(F.forall(v, ok), F.lit(False))


def quantised(df: DataFrame, key: str, vector: str, *more: str, scale: int = SCALE, null_ids: bool = False) -> DataFrame:
    """``id, dim, q`` and ``more``: components floor(scale * x) as longs; one that doesn't fit in a long raises an error.

    Rows with an unusable vector are left out, and those with a null id unless ``null_ids``.
    """
    v = F.col(vector).cast("array<double>")
    tall = F.raise_error(F.lit("a scaled component does not fit in a long")).cast("long")
    whole = F.transform(v, lambda x: F.when(F.abs(x * scale) < 2.0**63, F.floor(x * scale).cast("long")).otherwise(tall))
    known = _usable(v) if null_ids else F.col(key).isNotNull() & _usable(v)
    return df.where(known).select(F.col(key).cast("long").alias("id"), F.size(v).alias("dim"), whole.alias("q"), *more)


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _most(a: np.ndarray, b: np.ndarray) -> int:
    """No sum of products of a row of ``a`` and one of ``b`` is larger, either way."""
    top = lambda x: max(abs(int(x.min())), abs(int(x.max())))
    return top(a) * top(b) * a.shape[1]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows; in doubles where every sum stays below 2**53, in Python's integers where one might pass
    2**63.  One that does pass it raises an error, as arithmetic does in ANSI mode."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = _most(a, b)
    if most < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if any(not -(1 << 63) <= v < 1 << 63 for v in exact.ravel()):
        raise ArithmeticError("an inner product does not fit in a long")
    return exact.astype(np.int64)


def local_top(row_ids: np.ndarray, ids: pa.ChunkedArray, rows: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int):
    """Indices (query, row) and scores of each query's k best rows, its own row left out, ties to the smaller id, rows without one last."""
    order = np.lexsort((row_ids, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))
    row_ids, rows, found = row_ids[order], rows[order], []
    least = np.iinfo(np.int64).min
    for at in range(0, len(queries), 256):
        scores = products(queries[at : at + 256], rows)
        own = query_rows[at : at + 256, None] == row_ids[None, :]
        scores[own] = least
        kth = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), least)
        q, r = np.nonzero((scores >= kth[:, None]) & ~own)
        s = scores[q, r]
        best = np.lexsort((r, -s, q))
        q, r, s = q[best], r[best], s[best]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < k
        found.append((q[keep] + at, order[r[keep]], s[keep]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


class Pivots:
    """Pivots of one dimension in two levels: the first ones, as many as the root of all, lead the rest."""

    def __init__(self, row_ids: np.ndarray, at: np.ndarray):
        self.row_ids, self.at = row_ids, at
        self.leaders = at[: max(1, int(np.ceil(np.sqrt(len(at)))))].astype(float)
        self.led = self._nearest(at.astype(float), self.leaders)
        self.led[: len(self.leaders)] = np.arange(len(self.leaders))

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return ((centres**2).sum(1) - 2 * (x @ centres.T)).argmin(1)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A near pivot of each row, by way of the nearest leader, and the distance to it."""
        cell, leader = np.empty(len(x), np.int64), self._nearest(x, self.leaders)
        for k in np.unique(leader):
            mine, members = leader == k, np.flatnonzero(self.led == k)
            cell[mine] = members[self._nearest(x[mine], self.at[members].astype(float))]
        return cell, np.sqrt(((x - self.at[cell]) ** 2).sum(1))


class Cell:
    """What bounds a cell's rows, and where they go: data group ``group`` of ``parts`` chunks, query blocks from ``block`` on."""

    def __init__(self, dim: int, cell: int, n: int, radius: float, asked: int):
        self.dim, self.cell, self.n, self.radius, self.asked = dim, cell, n, radius, asked
        self.group = self.parts = self.block = self.blocks = 0


def dealt(cells: list[Cell], chunk: int, block: int) -> None:
    """Neighbouring small cells share a data group and a query block; a large cell is split into several."""
    group = at = rows = asked = 0
    for k, c in enumerate(cells):
        fresh = k and cells[k - 1].dim != c.dim
        if rows and (fresh or rows + c.n > chunk):
            group, rows = group + 1, 0
        if asked and (fresh or asked + c.asked > block):
            at, asked = at + 1, 0
        c.group, c.parts, c.block, c.blocks = group, max(1, -(-c.n // chunk)), at, max(1, -(-c.asked // block))
        group, rows = (group + 1, 0) if c.parts > 1 else (group, rows + c.n)
        at, asked = (at + c.blocks, 0) if c.blocks > 1 else (at, asked + c.asked)


def needed(pivots: Pivots, cells: list[Cell], row_ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """(queries, cells): whether a cell may hold one of the query's ``k`` best rows."""
    at, lengths = pivots.at.astype(float), np.sqrt((pivots.at.astype(float) ** 2).sum(1))
    near, long = x.astype(float) @ at.T, np.sqrt((x.astype(float) ** 2).sum(1))
    blur = 1e-15 * x.shape[1] * long[:, None] * lengths  # what rounding may add
    which, radius, number = (np.array([getattr(c, f) for c in cells]) for f in ("cell", "radius", "n"))
    slack = 1e-9 * (np.abs(near[:, which]) + long[:, None] * radius) + blur[:, which] + 1e-6
    high = near[:, which] + long[:, None] * radius + slack
    low = near[:, which] - long[:, None] * radius - slack
    # The k-th best row scores at least this: k + 1 rows, for one may be the query itself, in cells bounded from below ...
    order = np.argsort(-low, axis=1)
    enough = np.cumsum(number[order], axis=1) >= k + 1
    reached = np.take_along_axis(np.take_along_axis(low, order, 1), enough.argmax(1)[:, None], 1)[:, 0]
    floor = np.where(enough.any(1), reached, -np.inf)
    # ... or k of the pivots, which are rows themselves.
    if len(pivots.at) > k:
        scores = np.where(pivots.row_ids[None, :] == row_ids[:, None], -np.inf, near - blur)
        floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
    return high >= floor[:, None]


def knn_join(data: DataFrame, queries: Column, k: int, pivots: int | None = None, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, id, score``: each query row's ``k`` best rows of ``data`` (``id, dim, q``) by inner product.

    ``queries`` marks the rows that are queries too.  A query meets every row of its dimension but itself; rows that repeat
    it, or its id, are rows like others, and repeated query rows are answered one by one.  Ties go to the smaller id, rows without
    one come last; fewer rows than ``k`` give fewer answers.  A product that passes a long raises an error.
    """
    spark = data.sparkSession
    data = data.select("id", "dim", "q", F.coalesce(queries, F.lit(False)).alias("_query"), F.monotonically_increasing_id().alias("row"))
    data = stored(data, "knn-rows")
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, int(data.count() ** 0.5)))
    # A bounded sample of rows, by hash: only bounds depend on it, never the answers.
    sample = data.orderBy(F.xxhash64("row")).select("row", "dim", "q").limit(pivots).collect()
    distinct = {(r.dim, tuple(r.q)): r.row for r in sample}
    centres = {
        d: Pivots(np.array([r for (e, _), r in distinct.items() if e == d]), np.array([q for e, q in distinct if e == d], np.int64).reshape(-1, d))
        for d in {r.dim for r in sample}
    }

    def centre(d: int) -> Pivots:
        return centres.get(d) or Pivots(np.zeros(1, np.int64) - 1, np.zeros((1, d), np.int64))

    def assign(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                cell, away = centre(d).assign(matrix(part.column(2), d).astype(float))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=[*part.schema.names, "cell", "away"])

    assigned = "id long, dim int, q array<long>, _query boolean, row long, cell int, away double"
    rows = stored(data.mapInArrow(assign, assigned), "knn-cells")
    # One line per cell and dimension: bounded by the pivots.
    tallies = rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.count_if("_query").alias("asked"))
    cells = [Cell(**r.asDict()) for r in tallies.collect()]
    cells.sort(key=lambda c: (c.dim, int(centre(c.dim).led[c.cell]), c.cell))
    dealt(cells, chunk, block)
    summary = {d: [c for c in cells if c.dim == d] for d in {c.dim for c in cells}}

    def route(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims):
                whole, mine = batch.filter(pa.array(dims == d)), summary[d]
                groups = np.array([c.group for c in mine])
                starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
                home = {c.cell: c for c in mine}
                for at in range(0, len(whole), ROUTED):
                    part = whole.slice(at, ROUTED)
                    row_ids = part.column(3).to_numpy()
                    need = needed(centre(d), mine, row_ids, matrix(part.column(2), d), k)
                    query, place = np.nonzero(np.logical_or.reduceat(need, starts, axis=1))
                    own = [home[c] for c in part.column(4).to_pylist()]
                    blocks = np.array([c.block + int(r) % c.blocks for c, r in zip(own, row_ids)], np.int32)
                    offsets = pa.array(np.searchsorted(query, np.arange(len(part) + 1)).astype(np.int32))
                    met = pa.ListArray.from_arrays(offsets, pa.array(groups[starts][place].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(blocks), met], names=["id", "dim", "q", "row", "block", "groups"])

    routed = "id long, dim int, q array<long>, row long, block int, groups array<int>"
    asked = rows.where("_query").select("id", "dim", "q", "row", "cell").mapInArrow(route, routed)
    asked = stored(asked.withColumn("group", F.explode("groups")).drop("groups"), "knn-asked")
    wanted = asked.select(F.col("group").alias("_group"), F.col("block").alias("_block")).distinct()
    # Never more rows than pivots.
    homes = [(c.dim, c.cell, c.group, c.parts) for c in cells] or [(-1, -1, 0, 1)]
    homes = F.broadcast(spark.createDataFrame(homes, "dim int, cell int, group int, parts int"))
    sent = rows.join(homes, ["dim", "cell"]).join(wanted, F.col("group") == F.col("_group"))
    sent = sent.select("dim", "group", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("chunk"), F.col("_block").alias("block"), "id", "row", "q")
    several = F.broadcast(homes.groupBy("group").agg(F.max("parts").alias("parts")))
    chunks = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    come = asked.join(several, "group").select("dim", "group", chunks.alias("chunk"), "block", "id", "row", "q")
    place = ["dim", "group", "chunk", "block"]
    solved = come.groupBy(*place).cogroup(sent.groupBy(*place)).applyInArrow(_solver(k), "query_id long, query_row long, id long, row long, score long")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return solved.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _solver(k: int):
    def solve(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(queries) or not len(rows):
            q, r, s = (np.zeros(0, np.int64),) * 3
        else:
            dim = queries.column("dim")[0].as_py()
            ids, row_ids, query_rows = rows.column("id"), rows.column("row").to_numpy(), queries.column("row").to_numpy()
            q, r, s = local_top(row_ids, ids, matrix(rows.column("q"), dim), query_rows, matrix(queries.column("q"), dim), k)
        asked, found = queries.take(pa.array(q)), rows.take(pa.array(r))
        columns = [asked.column("id"), asked.column("row"), found.column("id"), found.column("row"), pa.array(s, pa.int64())]
        return pa.table(columns, names=["query_id", "query_row", "id", "row", "score"])

    return solve


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows of every 50th vector by integer inner product: ``query_id, rank, vec_id, score``."""
    data = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", null_ids=True)
    return knn_join(data, F.col("id") % 50 == 0, 5).withColumnRenamed("id", "vec_id")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS query_id, a.r, b.vec_id, b.r AS other,
         CAST(list_sum([a.q[i] * b.q[i] for i in range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM s) WHERE rank <= 5
"""
