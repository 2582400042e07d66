import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import hardneg

SF = "/root/testdata/sf0.01"


def brute(vectors, positives=5, negatives=10):
    """One product after another; every 100th id is an anchor."""
    rows = []
    for i, v, label in vectors:
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        rows.append((i, [int(np.floor(256 * float(x))) for x in v], label))
    place = lambda i: (i is None, i or 0)
    out = []
    for n, (i, v, label) in enumerate(rows):
        if i is None or i % 100:
            continue
        others = [(sum(a * b for a, b in zip(v, w)), j, lab) for m, (j, w, lab) in enumerate(rows) if m != n and len(w) == len(v)]
        others.sort(key=lambda x: (-x[0], place(x[1])))
        for s, j, _ in [x for x in others if x[2] == label][:positives]:
            met = [x for x in others if x[2] != label and 30 * s <= 100 * x[0] <= 90 * s]
            out += [(i, j, r + 1, k, s, t) for r, (t, k, _) in enumerate(met[:negatives])]
    return sorted(out, key=str)


def mined(df, **more):
    got = hardneg.hard_negatives(df, "vec_id", "embedding", F.col("label"), F.col("id") % 100 == 0, **more)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("shape", ["random", "ties", "large"])
def test_same_as_brute_force(spark, shape):
    rng = np.random.default_rng(4)
    n, dim = 500, 13
    x = rng.normal(size=(n, dim)) + 0.4
    if shape == "ties":
        x = np.tile(rng.integers(0, 3, size=(10, dim)), (50, 1)).astype(float)
    elif shape == "large":  # products beyond 32 and 53 bits
        x = x * np.where(np.arange(n) % 3, 1e6, 1.0)[:, None]
    vectors = [(i, [float(c) for c in v], int(rng.integers(0, 3))) for i, v in enumerate(x)]
    vectors += [(100, vectors[100][1], vectors[100][2])] * 2 + [(100, vectors[7][1], 2), (None, vectors[9][1], 1), (None, vectors[9][1], 2)]
    vectors += [(600, [1.0, 2.0], 1), (601, [1.0, 2.0], 1), (602, [0.5, 1.0], 2), (700, [], 1), (701, [], 1), (702, [], 2)]
    vectors += [(800, None, 1), (900, [1.0, None] * 6 + [1.0], 1), (1000, [float("nan")] * dim, 1), (1100, vectors[1][1], None)]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<double>, label int, id string, row int")
    want = brute(vectors)
    assert len(want) > 20
    assert mined(df, chunk=64, block=2) == want
    assert mined(df) == want


def test_planes_and_tables_give_exact_products():
    rng = np.random.default_rng(5)
    for high in (1, 200, 10**6, 2**40, 2**62):
        a, b = rng.integers(-high, high, (5, 20)), rng.integers(-high, high, (30, 20))
        want = b.astype(object) @ a.astype(object).T
        assert (hardneg.scores(hardneg.planes(b), a) == want).all()
    assert hardneg.planes(np.array([[-1], [0]])).shape == (2, 1, 1) and hardneg.planes(np.zeros((3, 0), np.int64)).shape == (3, 1, 0)
    with pytest.raises(ArithmeticError):
        hardneg.fitting(np.array([2**63], object))


def test_none(spark):
    df = spark.createDataFrame([(0, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert mined(df) == [] and mined(df.limit(0)) == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(map(tuple, con.sql(hardneg.OP12_SQL).fetchall()))
    assert want and sorted(map(tuple, hardneg.op12_hard_negatives(spark, SF).collect())) == want
