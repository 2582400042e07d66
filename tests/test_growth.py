"""Steps whose cost must not come together in one task, and what they shuffle: plans and results on tables made for it."""

import random

from pyspark.sql import functions as F

from marginalia.operators import aggregates as A


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_few_large_groups_are_picked_by_range(spark, monkeypatch):
    monkeypatch.setattr(A, "RANGES", 16)
    r = random.Random(5)
    data = [(g, v) for g, n in (("a", 3000), (None, 700), ("b", 1)) for v in [round(r.gauss(0, 9), 2) for _ in range(n)] + [1.5] * (n // 2) + [None] * 3]
    data += [("n", float("nan")), ("n", 1.0), ("n", float("-inf")), ("e", None)]
    d = spark.createDataFrame(data, "g string, v double")
    assert rows(A.median_hi(d, "g", "v", few=True)) == rows(A.median_hi(d, "g", "v"))
    for p in (0.0, 0.37, 0.9, 1.0):
        assert str(rows(A.index_quantile(d, "g", "v", p, few=True))) == str(rows(A.index_quantile(d, "g", "v", p)))  # as text: NaN
    assert A.median_hi(d.limit(0), "g", "v", few=True).collect() == []


def test_rows_of_a_family_do_not_meet_in_one_task(spark):
    d = spark.range(4000).select(F.col("id"), (F.col("id") % 900).cast("string").alias("s"), F.lit("f").alias("f"), (F.col("id") % 77).cast("double").alias("v"))
    got = A.preferred_median(d, "v", "s", "f", 5)
    assert "hashpartitioning(f#" not in plan(got)
    assert got.where("not by_signature").select("median").distinct().collect() == [(38.0,)]


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_dealt_sides_are_not_shuffled_again(spark):
    from marginalia.operators import align as G
    from marginalia.operators import gates as V

    a = spark.range(90).select((F.col("id") % 7).alias("g"), F.col("id").alias("n"), F.lit("ab").alias("t")).repartition(5, "g")
    b = a.withColumn("t", F.when(F.col("n") % 11 == 0, "x").otherwise(F.col("t")))
    for got in (G.segmentation_equal(a, b, "g", "n", "t"), V.order_preserved(a, b, "g", "n", "t")):
        assert plan(got).count("Exchange ") <= 2 and "REPARTITION_BY_NUM" in plan(got) and "ENSURE_REQUIREMENTS" not in plan(got)
        assert got.count() == 7
    aligned = G.align_tokens(a, a, "g", "n", "t")
    assert "ENSURE_REQUIREMENTS" not in plan(aligned) and aligned.where("kind = '1:1'").count() == 90


def test_places_pair_as_a_full_join_does(spark):
    from marginalia.operators import align as G
    from marginalia.operators import gates as V

    r = random.Random(3)
    side = lambda: spark.createDataFrame([(r.choice([1, 2, 3, None]), r.choice([1, 2, 3, None]), r.choice(["x", "y", None])) for _ in range(40)], "g long, n long, t string")
    for a, b in ((side(), side()), (side().where("g = 1"), side()), (side().where("t = 'x'"), side().where("t is not null and g > 1"))):
        j = a.select("g", "n", F.col("t").alias("a")).join(b.select("g", "n", F.col("t").alias("b")), ["g", "n"], "full_outer")
        off = j.where(~F.col("a").eqNullSafe(F.col("b"))).groupBy("g").agg(F.min("n"), F.count(F.lit(1)))
        assert rows(V.order_preserved(a, b, "g", "n", "t")) == rows(off)
        m = j.groupBy("g").agg(F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("m"), F.count_if(F.col("a") != F.col("b")).alias("p"))
        want = m.selectExpr("g", "case when m > 0 then 'count-mismatch' when p > 0 then 'skeleton-mismatch' else 'equal' end", "if(m > 0, 0, p)")
        assert rows(G.segmentation_equal(a, b, "g", "n", "t")) == rows(want)


def test_few_targets_and_terms_do_not_shuffle_rows(spark):
    from marginalia.operators import joins as J
    from marginalia.operators import select as S

    words = spark.range(100).select(F.col("id").alias("d"), (F.col("id") % 3).alias("p"))
    got = S.resolve(words, spark.createDataFrame([("5",), ("7:1",), ("5",)], "target string"), ["d", "p"])
    assert "SortMergeJoin" not in plan(got) and rows(got) == [(5, 2, "5"), (5, 2, "5"), (7, 1, "7:1")]
    lines = spark.range(50).select(F.lit("f").alias("path"), "id", F.lit("the the cat").alias("line"), F.lit(False).alias("prose"))
    found = J.scoped_findings(lines, spark.createDataFrame([("the", "gloss"), ("dog", "gloss")], "term string, rule string"), "path", "id", "line", "prose")
    assert "SortMergeJoin" not in plan(found) and [x[-1] for x in rows(found)] == [2] * 50


def test_order_lines_are_dealt_by_their_number(spark, monkeypatch):
    from marginalia.plans import views

    monkeypatch.setattr(views, "LINES_A_TASK", 500)
    t = views.Tables(spark, "/root/testdata/sf0.001")
    n = -(-t.lineitem.count() // 500)
    assert n > 4 and "hashpartitioning(l_orderkey#" in plan(t.li_by_order) and f", {n}), REPARTITION_BY_NUM" in plan(t.li_by_order)
    assert "ENSURE_REQUIREMENTS" not in plan(t.li_by_order) and t.li_by_order.rdd.getNumPartitions() == n


def test_small_groups_are_connected_without_rounds(spark, monkeypatch):
    from marginalia.operators import align as G

    r = random.Random(8)
    boxes = []
    for g in range(25):
        for k in range(r.randrange(1, 12)):
            x, y = r.randrange(60) / 4, r.randrange(8) / 4
            boxes.append((g, k, x, x + r.randrange(8) / 4, y, y + 1.0, r.choice(["x", "y", "z", None]), r.choice([1.0, 0.5, 0.25, 0.1234565, None])))
    d = spark.createDataFrame(boxes, "g long, r long, x0 double, x1 double, y0 double, y1 double, f string, w double")
    odd = spark.createDataFrame([(99, 1, None, 1.0, 0.0, 1.0, "x", 1.0), (99, 2, 0.5, 1.0, 0.0, 1.0, "y", 1.0), (99, 3, 0.5, 1.0, 0.0, 1.0, "y", float("nan")), (None, 4, 0.5, 1.0, 0.0, 1.0, "y", 1.0)], d.schema)
    both = d.unionByName(odd)
    monkeypatch.setattr(G, "TOGETHER", 0)
    want, plain = (rows(G.connected(both, "g", "r", 0.5, *more, cell=2.0)) for more in (("w", "f"), ()))
    assert len({x[:2] for x in want}) < len(want)
    monkeypatch.setattr(G, "TOGETHER", 6)  # some groups are larger
    assert rows(G.connected(both, "g", "r", 0.5, "w", "f", cell=2.0)) == want and rows(G.connected(both, "g", "r", 0.5, cell=2.0)) == plain
    monkeypatch.setattr(G, "TOGETHER", 1_024)
    monkeypatch.setattr(G, "min_label_components", None)
    got = G.connected(d, "g", "r", 0.5, "w", "f", cell=2.0)
    assert exchanges(got) == 1 and rows(got) == [x for x in want if x[0] not in (99, None)]


def test_rounds_of_moves_carry_only_what_changes_owners(spark, monkeypatch):
    from marginalia.operators import align as G

    # A chain of bodies that unravels, and many items that stay with their owner.
    moves = spark.range(1, 5).selectExpr("id", "concat('o', id) as src", "concat('o', id + 1) as dst", "true as body", "1L as line", "'x' as family", "id as more")
    stay = spark.range(100, 400).selectExpr("id", "concat('o', id % 9) as src", "concat('o', id % 9) as dst", "id % 2 = 0 as body", "1L as line", "'x' as family", "id as more")
    held = spark.range(9).selectExpr("concat('o', id) as owner", "true as body", "1L as line", "'x' as family", "1L as n")
    written, write = [], G.stored

    def counting(df, label):
        got = write(df, label)
        written.append((label, got.count()))
        return got

    monkeypatch.setattr(G, "stored", counting)
    got = G.guarded_moves(moves.unionByName(stay), held, held.select("owner", "family", G.F.lit(9).cast("long").alias("cap")))
    assert max(n for label, n in written if label == "moves") == 4
    why = {r.id: r.dropped for r in got.collect()}
    # o1 to o4 would be emptied one after another as their own bodies stay; what stays with such an owner is named with it.
    assert got.columns[-2:] == ["more", "dropped"] and [why[k] for k in range(1, 5)] == ["starves"] * 4
    assert {k % 9 for k, v in why.items() if k >= 100 and v} == {1, 2, 3, 4} and len(why) == 304


def some_boxes(spark, seed, groups):
    r = random.Random(seed)
    one = lambda lo: (lo, None if r.random() < 0.1 else lo + r.randrange(1, 9) / 2)
    data = [(g, k, r.choice("pqr"), *one(r.randrange(24) / 2), *one(r.randrange(24) / 2)) for g in [*range(groups), None] for k in range(r.randrange(1, 14))]
    return spark.createDataFrame(data, "g long, r long, o string, x0 double, x1 double, y0 double, y1 double")


def test_small_groups_meet_bands_as_dealt(spark, monkeypatch):
    from marginalia.operators import common
    from marginalia.operators import joins as J

    d = some_boxes(spark, 4, 20).withColumn("o", F.when(F.col("r") % 9 < 8, F.col("o"))).repartition(5, "g")
    bands = d.groupBy("g", F.floor(F.col("y0") / 3).alias("band")).agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    bands = bands.unionByName(spark.createDataFrame([(1, 9, None, 4.0), (2, 9, 5.0, 2.0)], bands.schema))
    want = rows(J.span_bands(d, bands, "g", "o", "band"))
    assert 0 < len(want) < d.count()
    for most in (0, 7):
        monkeypatch.setattr(common, "TOGETHER", most)
        assert rows(J.span_bands(d, bands, "g", "o", "band", height=2.0)) == want
    monkeypatch.setattr(common, "TOGETHER", 256)
    got = J.span_bands(d, d.groupBy("g", "r").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1")), "g", "o", "r", height=2.0, sizes=d)
    assert "ENSURE_REQUIREMENTS" not in plan(got) and exchanges(got) <= 2
    assert rows(J.span_bands(d, bands, "g", "o", "band", height=2.0)) == want


def test_small_groups_match_without_cells(spark, monkeypatch):
    from marginalia.operators import common
    from marginalia.operators import joins as J

    d = some_boxes(spark, 6, 20)
    a, b = d.where("r % 2 = 1"), d.where("r % 2 = 0")
    got = []
    for most in (0, 3, 256):
        monkeypatch.setattr(common, "TOGETHER", most)
        got.append(rows(J.grid_match_1to1(a, b, "g", "r", 3.0, 2.0, 1, keep=("o",))))
        assert rows(J.grid_match_1to1(a, b, "g", "r", 3.0, 2.0, 1, sizes=d).drop("distance")) == rows(J.grid_match_1to1(a, b, "g", "r", 3.0, 2.0, 1).drop("distance"))
    assert got[0] == got[1] == got[2] and len(got[0]) > 9
    owner = {(x.g, x.r): x.o for x in d.collect()}
    assert all(owner[g, i2] == o for g, _, i2, _, o in got[0])
    # A box without x is as near as its y says, as greatest leaves nulls out.
    flat = spark.createDataFrame([(1, 1, None, 2.0, 0.0, 2.0), (1, 2, 50.0, 52.0, 0.5, 2.5)], "g long, r long, x0 double, x1 double, y0 double, y1 double")
    for most in (0, 256):
        monkeypatch.setattr(common, "TOGETHER", most)
        assert rows(J.grid_match_1to1(flat.where("r = 1"), flat.where("r = 2"), "g", "r", 3.0, 2.0)) == [(1, 1, 2, 0.5)]


def rare_by_hand(data, min_n, max_k, reach):
    from collections import Counter

    n = Counter((f, a, v) for f, _, _, *vs in data for a, v in zip("ab", vs))
    total, mode = Counter(), {}
    for (f, a, v), k in sorted(n.items(), key=lambda x: (-x[1], x[0][2])):
        total[f, a] += k
        mode.setdefault((f, a), v)
    off = [(f, g, p, a, v, v - mode[f, a]) for f, g, p, *vs in data for a, v in zip("ab", vs) if total[f, a] >= min_n and v != mode[f, a]]
    near = lambda d: any(g is not None and g == d[1] and 0 < abs(p - d[2]) <= reach and (dev > 0) != (d[5] > 0) for _, g, p, _, _, dev in off)
    return sorted(((*d, "PAIRED" if near(d) else "REVIEW" if d[3] == "a" else "HAPAX") for d in off if n[d[0], d[3], d[4]] <= max_k), key=str)


def test_only_groups_with_a_rare_value_meet_the_counts_again(spark, monkeypatch):
    r = random.Random(2)
    value = lambda: float(r.choice([5] * 12 + [4, 6, 3, 7] * 2 + [r.randrange(40)]))
    data = [(r.choice("xyz"), None if g == 30 else g, p, value(), value()) for g in range(31) for p in range(r.randrange(1, 9))]
    data += [("w", 50 + k // 4, k % 4, 1.0 + k % 2, 2.0) for k in range(80)]  # deviates often, and never rarely
    d = spark.createDataFrame(data, "f string, g long, p long, a double, b double")
    kept, write = [], A.stored

    def counting(df, label):
        kept.append(write(df, label))
        return kept[-1]

    monkeypatch.setattr(A, "stored", counting)
    for most in (1, 2, 3):
        got = A.hapax_deviation(d, "f", ["a", "b"], "g", "p", max_k=most, review=("a",), counted=d.drop("p") if most == 2 else None)
        want = rare_by_hand(data, 20, most, 2)
        assert {x[-1] for x in want} == {"PAIRED", "REVIEW", "HAPAX"} and any(x[1] is None for x in want)
        assert rows(got.select("f", "g", "p", "axis", "value", "dev", "grade")) == want
    assert len(kept) == 3 and all(k.where("g >= 50").count() == 0 for k in kept)
