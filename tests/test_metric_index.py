import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import aggregates as A
from marginalia.operators import align as G
from marginalia.operators import joins as J


def outlines(rng, n, forms=30, points=32):
    """Noisy copies of a few forms, as drawn marks are, and some of other lengths."""
    base = [np.cumsum([(rng.uniform(-1, 1), rng.uniform(-1, 1)) for _ in range(points)], axis=0) / 8 for _ in range(forms)]
    return [(base[rng.randrange(forms)] + np.array([(rng.gauss(0, 0.01), rng.gauss(0, 0.01)) for _ in range(points)])).tolist() for _ in range(n)]


def distance(a, b):
    return np.sqrt(((np.array(a) - np.array(b)) ** 2).sum(-1)).mean() if len(a) == len(b) else np.inf


def test_near_shapes_equal_all_pairs_and_few_meet(spark):
    rng = random.Random(8)
    shapes = outlines(rng, 300) + [s[:7] for s in outlines(rng, 12, 2)] + [[(0.0, 0.0)], [(0.01, 0.0)], [(3.0, 0.0)], [], []]
    rows = [(i, [tuple(q) for q in s], i % 2 if i % 5 else None) for i, s in enumerate(shapes)]
    d = spark.createDataFrame(rows, "r long, p array<struct<x:double,y:double>>, g int")
    got = {(r.a, r.b) for r in G._near_shapes(d, d, F.col("a.r") < F.col("b.r"), 0.05).select(F.col("a.r").alias("a"), F.col("b.r").alias("b")).collect()}
    pairs = [(i, j) for i, s, g in rows for j, t, h in rows if i < j and g == h and len(s) == len(t)]
    want = {(i, j) for i, j in pairs if len(shapes[i]) and distance(shapes[i], shapes[j]) < 0.05}
    assert len(want) > 300 and got == want
    pivots = G.shape_pivots(d, "p")
    assert 2 <= len(pivots) <= G.PIVOTS and {len(q) for q in pivots} == {32}
    # Buckets of two pivots let few pairs meet that aren't near.
    key = lambda s: [int(distance(s, q) // 0.05) for q in pivots[:2]]
    keys = [key(s) if len(s) == 32 else [0, 0] for s in shapes]
    met = sum(max(abs(a - b) for a, b in zip(keys[i], keys[j])) <= 1 for i, j in pairs)
    assert met < len(pairs) / 5


def test_coverage_by_slabs_equals_a_fine_grid(spark):
    rng = random.Random(9)
    pieces = []
    for g in range(20):
        for _ in range(rng.randrange(0, 15)):
            x, y = rng.randrange(-3, 12), rng.randrange(-3, 12)
            pieces.append((g, float(x), float(x + rng.randrange(0, 6)), float(y), float(y + rng.randrange(0, 6))))
    pieces += pieces[:5]
    box = "g long, x0 double, x1 double, y0 double, y1 double"
    target = [(g, 0.0, 10.0, 0.0, 10.0) for g in range(20)] + [(20, 1.0, 1.0, 0.0, 5.0)]
    got = {r.g: r.coverage for r in J.union_coverage_2d(spark.createDataFrame(target, box), spark.createDataFrame(pieces, box), "g").collect()}
    for g, *_ in target[:-1]:
        mine = [p[1:] for p in pieces if p[0] == g]
        cells = sum(any(a <= x and x + 1 <= b and c <= y and y + 1 <= d for a, b, c, d in mine) for x in range(10) for y in range(10))
        assert got[g] == pytest.approx(cells / 100)
    assert got[20] == 0.0


def test_ridge_by_gradients_equals_the_dense_solve(spark):
    rng = random.Random(10)
    data = [(i, f, float(rng.randrange(1, 4)), 3.0 * (i % 11) + 1) for i in range(80) for f in rng.sample("abcdefgh", 4)] + [(None, "a", 1.0, 1.0), (5, None, 1.0, 1.0)]
    d = spark.createDataFrame(data, "i long, f string, n double, y double")
    fits = [{r.f: (r.weight, r.samples) for r in A.ridge_fit(d, "i", "f", "n", "y", dense=k).collect()} for k in (100, 3)]
    assert set(fits[0]) == set(fits[1]) == set("abcdefgh")
    for f, (w, n) in fits[0].items():
        assert fits[1][f] == (pytest.approx(w, abs=1e-7), n)
    known = d.where("i is not null and f is not null")
    res = A.ridge_residuals(known, A.ridge_fit(known, "i", "f", "n", "y"), "i", "f", "n", "y")
    off = {}
    for i, f, n, y in data:
        if i is not None and f is not None:
            off[i] = off.get(i, -y) + n * fits[0][f][0]
    assert {r.i: r.residual for r in res.collect()} == pytest.approx({i: abs(v) for i, v in off.items()})
    s = A.residual_summary(res).first()
    assert s.rows == 80 and s.median == pytest.approx(np.median([abs(v) for v in off.values()]), abs=0.02) and s.p90 == pytest.approx(np.percentile([abs(v) for v in off.values()], 90), abs=0.02)


def test_ridge_of_nothing(spark):
    assert A.ridge_fit(spark.createDataFrame([], "i long, f string, n double, y double"), "i", "f", "n", "y").collect() == []


def test_near_shapes_meet_in_chunks(spark, monkeypatch):
    """A block of alike outlines is many chunks, which meet as arrays and not pair by pair in a join."""
    monkeypatch.setattr(G, "CHUNK", 16)
    shapes = outlines(random.Random(4), 150)
    d = spark.createDataFrame([(i, [tuple(q) for q in s], 1) for i, s in enumerate(shapes)], "r long, p array<struct<x:double,y:double>>, g int")
    near = G._near_shapes(d, d, F.col("a.r") < F.col("b.r"), 0.05)
    assert "MapInArrow" in near._jdf.queryExecution().toString()
    got = sorted((r.a, r.b) for r in near.select(F.col("a.r").alias("a"), F.col("b.r").alias("b")).collect())
    assert got == [(i, j) for i in range(150) for j in range(i + 1, 150) if distance(shapes[i], shapes[j]) < 0.05] and got


def test_near_shapes_at_the_edges_of_buckets_and_far_out(spark):
    """Rounding may put outlines that are nearer than the threshold two buckets apart; outlines without end are near nothing."""
    far = [(0, -3.7), (1, -3.65), (2, 1e300), (3, 1e300), (4, float("inf")), (5, float("inf")), (6, float("nan")), (7, 1e9), (8, 1e9 + 0.03125)]
    at = [(10, 3.2499999999999996), (11, 3.2999999999999994), (12, 2.4), (13, 2.4499999999999997)]
    d = spark.createDataFrame([(i, [(x, 0.0)], 1) for i, x in far + at], "r long, p array<struct<x:double,y:double>>, g int")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(G, "shape_pivots", lambda *_: [[(-3.7, 0.0)]])
        got = {(r.a, r.b) for r in G._near_shapes(d, d, F.col("a.r") < F.col("b.r"), 0.05).select(F.col("a.r").alias("a"), F.col("b.r").alias("b")).collect()}
    assert got == {(i, j) for i, x in far + at for j, y in far + at if i < j and abs(x - y) < 0.05} and {(10, 11), (12, 13), (2, 3), (7, 8)} <= got
    assert all(np.isfinite(q).all() for q in G.shape_pivots(d, "p"))


def test_nearest_labelled_query_looks_at_the_whole_table(spark):
    import __spark_entry__

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").orderBy("vec_id").collect()
    points = {r.vec_id: np.array(r.embedding, float).reshape(-1, 2) for r in rows}
    clusters = {}
    for r in rows:
        near = [k for k in clusters if k[0] == r.label and distance(points[k[1]], points[r.vec_id]) < 0.2]
        clusters.setdefault(near[0] if near else (r.label, r.vec_id), []).append(r.vec_id)
    lent = [(v, label) for (label, _), members in clusters.items() if len(members) > 1 for v in members]
    want = {}
    for (_, v), members in clusters.items():
        near = [(round(d, 9), w, label) for w, label in lent if (d := distance(points[v], points[w])) < 0.2] if len(members) == 1 else []
        if near:
            want[v] = (min(near)[2], round(min(near)[0], 6))
    got = {r.vec_id: (r.suggested, r.distance) for r in __spark_entry__.queries()["g6_nearest_labelled"](spark, sf).collect()}
    assert {v: x[0] for v, x in got.items()} == {v: x[0] for v, x in want.items()} and len(got) > 20
    assert all(abs(got[v][1] - d) < 2e-6 for v, (_, d) in want.items())


def in_order(rows, tol, ratio=(0.0, 9e9), most_off=9e9):
    """Leaders of rows ``(r, p, g, s, f)`` by one pass."""
    leaders, want = [], {}
    for row in rows:
        fit = [q[0] for q in leaders if q[2] == row[2] and row[1] and distance(q[1], row[1]) < tol and ratio[0] <= row[3] / q[3] <= ratio[1] and abs(row[4] - q[4]) <= most_off]
        want[row[0]] = fit[0] if fit else row[0]
        if not fit:
            leaders.append(row)
    return want


def leader_rows(spark, rng, shapes):
    rows = [(i, [tuple(q) for q in s], i % 7 == 0, rng.choice([5.0, 6.0, 7.0]), rng.random() * 0.3) for i, s in enumerate(shapes)]
    return rows, spark.createDataFrame(rows, "r long, p array<struct<x:double,y:double>>, g boolean, s double, f double")


def test_leaders_of_large_blocks_part_by_part(spark, monkeypatch):
    """Blocks of several parts, in which heads are small and large, and rows are near many, few or none."""
    for name, value in (("HEAD", 8), ("TOGETHER_OUTLINES", 12), ("CHUNK", 8)):
        monkeypatch.setattr(G, name, value, raising=False)
    listed = []
    by_pairs = G._led_by_pairs
    monkeypatch.setattr(G, "_led_by_pairs", lambda df, *more: listed.append(df.count()) or by_pairs(df, *more))
    rng = random.Random(12)
    shapes = outlines(rng, 60, 3, 6) + [[(rng.uniform(-9, 9), rng.uniform(-9, 9))] * 6 for _ in range(60)] + [[(0.0, 0.0)], [(0.01, 0.0)], [], []]
    rng.shuffle(shapes)
    rows, d = leader_rows(spark, rng, shapes)
    assert dict(map(tuple, G.leader_cluster(d, "r", "p", "g", 0.05).collect())) == in_order(rows, 0.05)
    assert listed and max(listed) < 110
    got = dict(map(tuple, G.leader_cluster(d, "r", "p", "g", 0.3, size="s", attribute="f").collect()))
    assert got == in_order(rows, 0.3, (0.77, 1.3), 0.15) and len(set(got.values())) < 100


def test_leaders_and_nearest_list_no_near_pairs(spark, monkeypatch):
    """Rows of a block that are all alike meet its leaders, not one another; a row takes no more than its nearest from a chunk."""
    monkeypatch.setattr(G, "HEAD", 20, raising=False)
    monkeypatch.setattr(G, "_near_shapes", lambda *_: pytest.fail("near pairs are listed"))
    rng = random.Random(13)
    rows, d = leader_rows(spark, rng, outlines(rng, 200, 2, 5))
    want = in_order(rows, 0.2)
    assert dict(map(tuple, G.leader_cluster(d, "r", "p", "g", 0.2).collect())) == want and len(set(want.values())) < 12
    points = {r[0]: r[1] for r in rows}
    near = {i: min((round(distance(points[i], points[j]), 9), j) for j in points if j % 5) for i in points if i % 5 == 0}
    named = d.withColumn("l", F.when(F.col("r") % 5 != 0, F.concat(F.lit("of "), "r")))
    got = {r.r: (r.distance, r.suggested) for r in G.nearest_labelled(named, "r", "p", None, "l", 9.0).collect()}
    assert {i: x[1] for i, x in got.items()} == {i: f"of {j}" for i, (_, j) in near.items()}
    assert all(got[i][0] == pytest.approx(x, abs=2e-9) for i, (x, _) in near.items())
