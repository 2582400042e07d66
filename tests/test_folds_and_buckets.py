"""Text folds on given vectors, and joins with and without buckets on random boxes."""

import random
from itertools import combinations_with_replacement

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.functions import text as U
from marginalia.operators import aggregates as A
from marginalia.operators import align as G
from marginalia.operators import joins as J
from marginalia.sources import publish as P

#: A text, its search key, match fold and loose key (fixed values).
FOLDS = [
    ("ٱلرَّحۡمَٰنِ", "ٱلرحمن", "الرحمن", "لرحمن"),
    ("الرحمن", "الرحمن", "الرحمن", "لرحمن"),
    ("ٱلۡعَٰلَمِينَ", "ٱلعلمين", "العلمين", "لعلمين"),
    ("العالمين", "العالمين", "العالمين", "لعلمين"),
    ("ٱللَّهِ", "ٱلله", "الله", "لله"),
    ("أَنۡعَمۡتَ", "أنعمت", "انعمت", "نعمت"),
    ("ٱلضَّآلِّينَ", "ٱلضآلين", "الضالين", "لضلين"),
    ("ٱلصَّلَوٰةَ", "ٱلصلوة", "الصلوه", "لصلوه"),
    ("يُؤۡمِنُونَ", "يؤمنون", "يومنون", "يومنون"),
    ("أُوْلَٰٓئِكَ", "أولئك", "اوليك", "وليك"),
    ("سَوَآءٌ", "سوآء", "سواء", "سو"),
    ("رَغَدًا", "رغدا", "رغدا", "رغد"),
    ("أَنۢبُِٔونِي", "أنبوني", "انبوني", "نبوني"),
    ("أنبئوني", "أنبئوني", "انبيوني", "نبيوني"),
    ("۞ إِنَّ", "إن", "ان", "ن"),
    ("وَٱلۡأٓصَالِ۩", "وٱلأصال", "والاصال", "ولصل"),
    ("رَّبِّهِمۡۖ", "ربهم", "ربهم", "ربهم"),
    ("أَنۢبِـُٔونِي", "أنبوني", "انبوني", "نبوني"),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fold_vectors(spark):
    d = spark.createDataFrame([(i, v[0]) for i, v in enumerate(FOLDS)], "i long, t string")
    got = d.select("i", U.search_key(F.col("t")), U.match_fold(F.col("t")), U.loose_key(F.col("t"))).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [v[1:] for v in FOLDS]


def boxes(spark, n=150, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.randrange(-20, 60) / 2, rng.randrange(0, 40) / 2
        out.append((None if i % 40 == 39 else i % 2, i, rng.randrange(12), "f%d" % rng.randrange(5), x, x + rng.randrange(1, 20) / 2, y, y + rng.randrange(1, 8) / 2))
    return spark.createDataFrame(out, "g long, r long, o long, fam string, x0 double, x1 double, y0 double, y1 double")


def test_buckets_change_no_join(spark):
    for seed in (1, 2):
        a, b = boxes(spark, seed=seed), boxes(spark, 60, seed + 10)
        for width in (1.0, 7.0):
            assert rows(J.best_iou(a, b, "g", "r", "fam", 0.1)) == rows(J.best_iou(a, b, "g", "r", "fam", 0.1, cell=width))
            plain = J.exclusive_owner(a, b, "g", "r", "o", max_clear=20.0, min_lead=-9.0)
            assert rows(plain) == rows(J.exclusive_owner(a, b, "g", "r", "o", max_clear=20.0, min_lead=-9.0, width=width))
            bands = b.where("r % 3 = 0").select("g", F.col("r").alias("band"), "y0", "y1")
            assert rows(J.assign_band(a, bands, "g", ["r"], "band")) == rows(J.assign_band(a, bands, "g", ["r"], "band", width))
            p = a.select("g", F.col("r").alias("p"), F.col("x0").alias("x"), F.col("y1").alias("y"))
            assert rows(J.point_in_rect_nearest(p, b, "g", "p", "r", 3.0)) == rows(J.point_in_rect_nearest(p, b, "g", "p", "r", 3.0, height=width))


def test_an_item_has_one_other_holder(spark):
    schema = "g long, r long, o long, x0 double, x1 double, y0 double, y1 double"
    items = spark.createDataFrame([(1, 1, 1, 10.0, 12.0, 0.0, 1.0), (1, 2, 1, 0.0, 2.0, 0.0, 1.0), (1, 3, 1, 10.0, 25.0, 0.0, 1.0)], schema)
    holders = spark.createDataFrame([(1, 1, 1, 0.0, 5.0, 0.0, 1.0), (1, 2, 2, 9.0, 14.0, 2.0, 3.0), (1, 3, 3, 20.0, 24.0, 0.0, 1.0)], schema)
    for width in (None, 2.0):
        assert rows(J.exclusive_owner(items, holders, "g", "r", "o", width=width)) == [(1, 1, 1, 2, 1.0)]


def test_asof_with_many_buckets_and_one_hot_key(spark):
    rng = random.Random(3)
    facts = [None, -50, 2000] + [rng.randrange(-20, 1200) for _ in range(400)] + [500] * 200
    bounds = sorted(rng.sample(range(0, 1000), 60))
    f = spark.createDataFrame([(i, k) for i, k in enumerate(facts)], "i long, k long")
    b = spark.createDataFrame([(s, f"v{s}") for s in bounds], "s long, v string")
    for before in ("null", "first"):
        none = f"v{bounds[0]}" if before == "first" else None
        want = {i: next((f"v{s}" for s in reversed(bounds) if k is not None and s <= k), none) for i, k in enumerate(facts)}
        for size in (7, 10**6):
            assert {r.i: r.floor for r in J.asof_floor(f, "k", b, "s", "v", before, size).collect()} == want
    assert J.asof_floor(f.limit(0), "k", b, "s", "v").collect() == []


def test_partition_with_anchors_and_free_ends(spark):
    rng = random.Random(5)
    data = [(g, o, float(rng.randrange(1, 9)), rng.choice([1.0, 2.0, 3.0, None])) for g in range(6) for o in range(6)]
    d = spark.createDataFrame(data, "g long, o long, v double, at double")
    for free in (False, True):
        got = {r.g: r.cost for r in G.partition_to_capacity(d, 3, "g", "o", "v", 8.0, most=4, anchor="at", penalty=1.5, free_ends=free).collect()}
        for g in range(6):
            mine = [(v, at) for q, _, v, at in data if q == g]

            def cost(cuts):
                if any(b - a > 4 for a, b in zip(cuts, cuts[1:])) or not free and (cuts[0], cuts[-1]) != (0, len(mine)):
                    return np.inf
                c = 0.0
                for k, (a, b) in enumerate(zip(cuts, cuts[1:]), 1):
                    c += abs(sum(v for v, _ in mine[a:b]) - 8.0) + sum(1.5 * abs(at - k) for _, at in mine[a:b] if at is not None)
                return c

            assert np.isclose(got[g], min(cost(c) for c in combinations_with_replacement(range(len(mine) + 1), 4)))


def distance(p, q):
    return float(np.mean([np.hypot(a[0] - b[0], a[1] - b[1]) for a, b in zip(p, q)])) if len(p) == len(q) else np.inf


def shapes(spark):
    rng = random.Random(7)
    data = []
    for i in range(80):
        x, y = rng.randrange(5) * 0.3, rng.randrange(3) * 0.3
        data.append((i, rng.randrange(2), [(x + rng.random() * 0.2, y + rng.random() * 0.2) for _ in range(3)], rng.randrange(4), rng.choice([5.0, 6.0, 7.0, None]), rng.random() * 0.4, rng.choice(["a", None, None])))
    return data, spark.createDataFrame(data, "r long, b long, p array<struct<x: double, y: double>>, n long, s double, f double, l string")


def test_leaders_by_count_size_and_attribute(spark):
    data, d = shapes(spark)
    leaders, want = [], {}
    for row in sorted(data, key=lambda x: (-x[3], x[0])):
        i, b, p, _, s, f, _ = row
        fit = [q for q in leaders if q[1] == b and distance(p, q[2]) < 0.2 and s and q[4] and 0.77 <= s / q[4] <= 1.3 and abs(f - q[5]) <= 0.15]
        want[i] = fit[0][0] if fit else i
        if not fit:
            leaders.append(row)
    assert dict(rows(G.leader_cluster(d, "r", "p", "b", 0.2, "n", "s", attribute="f"))) == want and len(leaders) < 80


def test_unlabelled_rows_take_the_nearest_label(spark):
    data, d = shapes(spark)
    want = {}
    for i, b, p, *_, label in data:
        near = [(round(distance(p, q[2]), 9), q[0], q[6]) for q in data if q[6] and q[1] == b and distance(p, q[2]) < 0.15]
        if label is None and near:
            want[i] = (min(near)[2], min(near)[0])
    assert {r.r: (r.suggested, r.distance) for r in G.nearest_labelled(d, "r", "p", "b", "l", 0.15).collect()} == want and want


def test_profiles_are_compared_as_published(spark, tmp_path):
    d = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "c", "z")], "k long, t string, u string")
    small, differing = P.profile_projection(d, ["u"], "k", "t", f"file://{tmp_path}")
    assert small.columns == ["k", "t"] and differing.collect() == []
    other = spark.createDataFrame([(1, "A"), (2, None), (4, "d")], "k long, t string")
    assert rows(P.profiles_differ(d, other, "k", "t")) == [(1, "differs"), (3, "full only"), (4, "small only")]


def test_ridge_weights_solve_the_normal_equations(spark):
    rng = random.Random(9)
    data = [(i, f, float(rng.randrange(1, 4)), 2.0 * i % 7) for i in range(40) for f in rng.sample("abcde", 3)]
    x, y = np.zeros((40, 5)), np.zeros(40)
    for i, f, n, v in data:
        x[i, "abcde".index(f)], y[i] = n, v
    want = np.linalg.solve(x.T @ x + 0.5 * np.eye(5), x.T @ y)
    got = A.ridge_fit(spark.createDataFrame(data, "i long, f string, n double, y double"), "i", "f", "n", "y").orderBy("f").collect()
    assert [r.f for r in got] == list("abcde") and np.allclose([r.weight for r in got], want)
    assert [r.samples for r in got] == [sum(d[1] == f for d in data) for f in "abcde"]


def test_index_of_pages(spark):
    data = [(p, n, w, f"{p}:{n}") for p, text in ((1, "a b a"), (2, "b"), (3, "c a")) for n, w in enumerate(text.split())]
    parts = P.build_index(spark.createDataFrame(data, "page long, pos long, word string, key string"), "page", "word", "key", ["pos"])
    assert rows(parts["pages"].select("page", "n", "first_key", "last_key")) == [(1, 3, "1:0", "1:2"), (2, 1, "2:0", "2:0"), (3, 2, "3:0", "3:1")]
    assert {(r.word, r.page) for r in parts["index"].collect()} == {("a", 1), ("b", 1), ("c", 3)}
    assert parts["manifest"].count() == 3


def test_index_and_gate_decide_what_is_published(spark):
    schema = "page long, pos long, word string, key string"
    data = [(p, n, w, f"{p}:{n}") for p, text in ((1, "a b a"), (2, "b"), (3, "c a d")) for n, w in enumerate(text.split())]
    parts = P.build_index(spark.createDataFrame(data, schema), "page", "word", "key", ["pos"])
    digests = dict(rows(parts["manifest"].select("page", "digest")))
    assert rows(parts["published"].select("page", "n", "first_key", "digest", "first_seen")) == [(1, 3, "1:0", digests[1], 2), (2, 1, "2:0", digests[2], 0), (3, 3, "3:0", digests[3], 2)]
    for odd in ((3, 3, "e", None), (None, 0, "e", "x")):
        parts = P.build_index(spark.createDataFrame([*data, odd], schema), "page", "word", "key", ["pos"])
        assert {r.check: r.status for r in parts["gate"].collect()}["gate"] == "fail"
        with pytest.raises(Exception, match="gate failed: page and key present"):
            parts["published"].collect()
    assert P.build_index(spark.createDataFrame([], schema), "page", "word", "key", ["pos"])["published"].collect() == []
