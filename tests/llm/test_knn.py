import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import knn


def brute(vectors, k):
    """Every 50th id against every row but the query's own, one product after another."""
    q = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors]
    out = []
    for n, (i, v) in enumerate(q):
        if i % 50 == 0:
            others = [(-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(q) if m != n and len(w) == len(v)]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(others)[:k])]
    return sorted(out)


@pytest.mark.parametrize("shape", ["random", "clusters", "ties"])
def test_same_as_brute_force(spark, shape):
    rng = np.random.default_rng(1)
    n = 400
    if shape == "random":
        x = rng.normal(size=(n, 8))
    elif shape == "clusters":
        x = rng.normal(size=(5, 8))[rng.integers(0, 5, n)] * 4 + rng.normal(size=(n, 8)) * 0.05
    else:
        x = np.tile(rng.integers(-1, 2, size=(8, 8)), (50, 1)).astype(float)
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)] + [(1000, [1.0, 2.0]), (1001, [2.0, 1.0]), (1050, [3.0, -1.0]), (1100, [])]
    vectors += [(50, vectors[50][1])] * 3 + [(50, vectors[7][1]), (333, vectors[50][1])]  # rows that repeat a query, or its id
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    unusable = [(5000, None), (5050, [1.0, None] * 4), (5100, [float("nan")] * 8), (5150, [float("inf")] * 8), (None, [0.0] * 8)]
    odd = spark.createDataFrame(unusable, df.schema)
    data = knn.quantised(df.unionAll(odd), "vec_id", "embedding")
    got = knn.knn_join(data, F.col("id") % 50 == 0, 5, pivots=12, chunk=64, block=5)
    assert sorted(map(tuple, got.collect())) == brute(vectors, 5)
    assert sorted(map(tuple, knn.knn_join(data, F.col("id") % 50 == 0, 5).collect())) == brute(vectors, 5)


def test_few_rows_repeats_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    one = knn.quantised(spark.createDataFrame([(0, [1.0, 1.0])], schema), "vec_id", "embedding")
    assert knn.knn_join(one, F.col("id") % 50 == 0, 5).collect() == []
    assert knn.knn_join(one.limit(0), F.col("id") % 50 == 0, 5).collect() == []
    vectors = [(0, [1.0, 1.0])] * 2 + [(7, [1.0, 0.0])] * 3 + [(50, [0.0, 2.0])] * 3
    got = knn.knn_join(knn.quantised(spark.createDataFrame(vectors, schema), "vec_id", "embedding"), F.col("id") % 50 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute(vectors, 5)


def test_pivots_in_two_levels_bound_their_cells():
    rng = np.random.default_rng(2)
    x, at = rng.normal(size=(500, 6)) * 100, rng.integers(-99, 99, (40, 6))
    pivots = knn.Pivots(np.arange(40), at)
    cell, away = pivots.assign(x)
    assert np.allclose(away, np.sqrt(((x - at[cell]) ** 2).sum(1))) and set(pivots.led) <= set(range(7))
    cells = [knn.Cell(6, c, n, 1.0, 2) for c, n in enumerate([3, 9, 30, 4, 4, 1])]
    knn.dealt(cells, 10, 4)
    assert [(c.group, c.parts) for c in cells] == [(0, 1), (1, 1), (2, 3), (3, 1), (3, 1), (3, 1)]
    assert [c.block for c in cells] == [0, 0, 1, 1, 2, 2]


def test_large_numbers_stay_exact():
    a = np.array([[2**30 + 1, 3]], np.int64)
    assert knn.products(a, a)[0, 0] == (2**30 + 1) ** 2 + 9


def test_products_past_a_long_raise_and_never_wrap(spark):
    big = 3 * 10**9
    assert knn.products(np.array([[big, -big]], np.int64), np.array([[big, big]], np.int64))[0, 0] == 0
    with pytest.raises(ArithmeticError):
        knn.products(np.array([[big, big]], np.int64), np.array([[big, big]], np.int64))
    for x in (1e10, 1e300):
        df = spark.createDataFrame([(0, [x] * 8), (1, [x] * 8)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="does not fit in a long"):
            knn.knn_join(knn.quantised(df, "vec_id", "embedding"), F.col("id") % 50 == 0, 5).collect()


def test_a_row_without_an_id_is_a_candidate(spark):
    df = spark.createDataFrame([(0, [1.0]), (None, [1.0]), (7, [1.0])], "vec_id long, embedding array<double>")
    got = knn.knn_join(knn.quantised(df, "vec_id", "embedding", null_ids=True), F.col("id") % 50 == 0, 5)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 7, 65536), (0, 2, None, 65536)]
