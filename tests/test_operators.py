"""Small hand-made tables: ties, empty groups, even sizes, values on a threshold, nulls, one-sided keys, duplicates, touching intervals."""

import math
import random

import pytest
from pyspark.sql import functions as F

from marginalia.functions import text as U
from marginalia.operators import aggregates as A
from marginalia.operators import align as G
from marginalia.operators import gates as V
from marginalia.operators import joins as J
from marginalia.operators import logs as L
from marginalia.operators import select as S
from marginalia.operators import sets as X
from marginalia.operators import windows as W
from marginalia.operators.search import text_search
from marginalia.sources import publish as P
from marginalia.sources import readers as R
from marginalia.streaming import queue

BOX = "grp long, rid long, owner long, fam string, line long, x0 double, x1 double, y0 double, y1 double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def boxes(spark, *spans, grp=1):
    return frame(spark, [(grp, k, k, "A", 1, float(a), float(b), 0.0, 1.0) for k, (a, b) in enumerate(spans, 1)], BOX)


def test_upper_median_and_quantile(spark):
    d = frame(spark, [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("b", 5.0), ("c", None), ("d", 2.0), ("d", 2.0)], "g string, v double")
    assert rows(A.median_hi(d, "g", "v")) == [("a", 3.0, 4), ("b", 5.0, 1), ("d", 2.0, 2)]
    assert rows(A.index_quantile(d, "g", "v", 1.0)) == [("a", 10.0, 4), ("b", 5.0, 1), ("d", 2.0, 2)]
    assert rows(A.median_hi(d, "g", "v", 3)) == [("a", 3.0, 4)]
    assert A.median_hi(d.limit(0), "g", "v").collect() == []


def test_ratio_exactly_on_a_limit_is_no_outlier(spark):
    d = frame(spark, [(1, 10.0), (1, 10.0), (1, 14.5), (1, 14.6), (1, 6.9)], "g long, v double")
    assert sorted(r.v for r in A.ratio_outlier(d, "g", "v", 0.7, 1.45).collect()) == [6.9, 14.6]


def test_modal_ties_go_to_the_smaller_value(spark):
    d = frame(spark, [(1, "b"), (1, "a"), (1, None), (2, "z"), (2, "z"), (2, "y")], "g long, v string")
    got = {r.g: (r["mode"], r.n, r.total, r.kinds, r.alternatives) for r in A.modal(d, "g", "v").collect()}
    assert got == {1: ("a", 1, 2, 2, ["b"]), 2: ("z", 2, 3, 2, ["y"])}


def test_histogram_has_empty_buckets(spark):
    d = frame(spark, [(0.0,), (1.0,), (1.0,), (5.0,), (None,)], "v double")
    assert rows(A.histogram(d, "v", [0, 1, 2, 5])) == [(0.0, 1.0, 1), (1.0, 2.0, 2), (2.0, 5.0, 0)]


def test_noisy_or_and_tiers(spark):
    d = frame(spark, [(1, 0.5, False), (1, 0.5, False), (2, 0.1, True), (3, -1.0, False), (4, 2.0, False)], "k long, p double, proof boolean")
    got = {r.k: r.p for r in A.noisy_or(d, "k", F.col("p"), F.col("proof")).collect()}
    assert got[1] == pytest.approx(0.75) and got[2] == 1 and got[3] == 0 and got[4] == pytest.approx(0.999999)
    e = frame(spark, [(1, "width", 0.9, False), (1, "size", 0.0, False), (2, "width", 0.9, False), (2, "size", 0.1, False), (3, "size", 0.0, True)], "key long, name string, p double, proof boolean")
    got = {r.key: (round(r.p, 3), r.tier) for r in A.score_entity(e, "key").collect()}
    assert got == {1: (0.45, "review"), 2: (0.91, "high"), 3: (1.0, "certain")}


def test_budget_of_one_sided_keys(spark):
    have = frame(spark, [(1, "x", 2), (3, "x", 1)], "k long, f string, n long")
    want = frame(spark, [(1, "x", 1, 2), (2, "x", 1, 1), (4, "x", 0, 0)], "k long, f string, lo long, hi long")
    assert rows(A.budget_check(have, want, ["k", "f"])) == [(2, "x", 0, 1, 1), (3, "x", 1, 0, 0)]


def test_islands_touching_at_a_point_and_idempotent(spark):
    d = boxes(spark, (0, 2), (2, 3), (1, 1.5), (5, 6), (5, 6))
    got = W.islands(d, "grp", "x0", "x1")
    assert rows(got.select("lo", "hi", "n")) == [(0.0, 3.0, 3), (5.0, 6.0, 2)]
    again = W.islands(got, "grp", "lo", "hi")
    assert rows(again.select("lo", "hi")) == rows(got.select("lo", "hi"))


def test_coverage_counts_overlaps_once(spark):
    t = frame(spark, [(1, 0.0, 10.0), (2, 0.0, 0.0)], "grp long, lo double, hi double")
    assert rows(J.union_coverage(t, boxes(spark, (0, 4), (2, 5), (9, 20)), "grp")) == [(1, 0.6), (2, 0.0)]
    t2 = frame(spark, [(1, 0.0, 10.0, 0.0, 1.0)], "grp long, x0 double, x1 double, y0 double, y1 double")
    assert rows(J.union_coverage_2d(t2, boxes(spark, (0, 4), (2, 5), (9, 20)), "grp")) == [(1, 0.6)]


@pytest.mark.parametrize("width", [None, 1.0, 3.0])
def test_overlap_in_buckets_is_exact(spark, width):
    d = boxes(spark, (0, 4), (3, 9), (4, 5), (8.9, 12))
    got = J.interval_overlap(d, d, "grp", 0.5, width).where("rid < rid2").select("rid", "rid2")
    assert rows(got) == [(1, 2), (2, 3)]


@pytest.mark.parametrize("cell", [None, 0.7, 5.0])
def test_rect_pairs_in_cells_are_exact(spark, cell):
    d = boxes(spark, (0, 4), (3, 9), (4, 5), (8.9, 12))
    assert rows(J.rect_pairs(d, "grp", "rid", "owner", 0.05, cell).select("rid", "rid2")) == [(1, 2), (2, 3), (2, 4)]


def test_asof_before_the_first_on_a_boundary_and_without_any(spark):
    f, b = frame(spark, [(0,), (5,), (7,), (100,)], "k long"), frame(spark, [(5, "a"), (9, "b")], "s long, v string")
    assert rows(J.asof_floor(f, "k", b, "s", "v")) == [(0, None), (100, "b"), (5, "a"), (7, "a")]
    assert rows(J.asof_floor(f, "k", b, "s", "v", "first"))[0] == (0, "a")
    assert {r.floor for r in J.asof_floor(f, "k", b.limit(0), "s", "v").collect()} == {None}


def test_matching_uses_each_side_once(spark):
    a, b = boxes(spark, (0, 2), (1, 3)), boxes(spark, (1, 3), (1.2, 3.2), (30, 32))
    assert rows(J.grid_match_1to1(a, b, "grp", "rid", 3.0, 0.5).select("rid", "rid2")) == [(1, 2), (2, 1)]
    assert J.grid_match_1to1(a, b.limit(0), "grp", "rid", 3.0, 0.5).collect() == []


def test_reconcile_null_and_duplicate_keys(spark):
    a, b = frame(spark, [(1, "x"), (1, "y"), (None, "n")], "k long, a string"), frame(spark, [(1, "p"), (2, "q"), (None, "m")], "k long, b string")
    got = sorted((r.side, r.k) for r in J.reconcile(a, b, "k").select("side", F.coalesce("k", F.lit(-1)).alias("k")).collect())
    assert got == [("both", 1), ("both", 1), ("only-a", -1), ("only-b", -1), ("only-b", 2)]


def test_dictionary_longest_wins(spark):
    t = frame(spark, [("new york", "city"), ("york", "old"), ("hall", "place")], "term string, rule string")
    d = frame(spark, [(1, "NewYork_halls.york")], "key long, i string")
    assert rows(J.dictionary_match(d, t, "key", "i").select("start", "size", "term")) == [(0, 2, "new york"), (2, 1, "hall"), (3, 1, "york")]


def test_alias_needs_a_column(spark):
    with pytest.raises(ValueError):
        J.alias_coalesce(boxes(spark, (0, 1)), ["a", "b"], "c")


def test_multiset_diff_of_equal_tables_is_empty(spark):
    d = boxes(spark, (0, 1), (0, 1), (2, 3))
    assert X.multiset_diff(d, d).collect() == []
    a, b = frame(spark, [("x",), ("x",), (None,)], "v string"), frame(spark, [("x",), ("y",), (None,)], "v string")
    assert rows(X.multiset_diff(a, b)) == [("x", "extra", 1), ("y", "missing", 1)]


def test_ambiguous_wants_take_what_is_spare(spark):
    have = frame(spark, [(1, "b"), (1, "c")], "k long, t string")
    want = frame(spark, [(1, ["a", "b"]), (1, ["b", "c"]), (1, ["c"])], "k long, o array<string>")
    assert rows(X.ambiguous_multiset_diff(have, want, "k", "t", "o")) == [(1, "b", "missing", 1)]


def test_alignment(spark):
    def toks(*words):
        return frame(spark, [(1, n, w) for n, w in enumerate(words)], "g long, n long, t string")

    same = G.align_tokens(toks("ab", "c"), toks("ab", "c"), "g", "n", "t")
    assert [r.kind for r in same.collect()] == ["1:1", "1:1"]
    got = G.align_tokens(toks("ab", "c", "def", "g"), toks("abc", "d", "ef", "g"), "g", "n", "t")
    assert sorted((r.cut, r.kind) for r in got.collect()) == [(3, "fuse"), (6, "split"), (7, "1:1")]
    off = G.align_tokens(toks("ab", "cd"), toks("abc", "de"), "g", "n", "t", abort_group=True)
    assert [r.kind for r in off.collect()] == ["cannot-align"]


def test_capacity_partition_is_optimal(spark):
    d = frame(spark, [(1, k, float(v)) for k, v in enumerate([5, 5, 9, 1, 10])], "g long, o long, v double")
    got = sorted((r.o, r.bin) for r in G.partition_to_capacity(d, 3, "g", "o", "v", 10.0).collect())
    assert got == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]


def test_matching_goes_on_until_no_pair_is_left(spark):
    # gaps shrink along the chain, so that each round can settle one pair only
    at, spots = 0.0, []
    for k in range(32):
        spots.append(at)
        at += 2.0 - k * 0.05
    a, b = boxes(spark, *[(x, x + 1) for x in spots[0::2]]), boxes(spark, *[(x, x + 1) for x in spots[1::2]])
    assert J.grid_match_1to1(a, b, "grp", "rid", 2.5, 0.5, rounds=3).count() < 16
    assert J.grid_match_1to1(a, b, "grp", "rid", 2.5, 0.5).count() == 16


def test_leaders_equal_a_pass_in_order(spark):
    rng = random.Random(5)
    data = [(k, rng.choice(["b", "c", None]), [(rng.random(), rng.random()) for _ in range(rng.choice([2, 2, 3]))]) for k in range(240)]
    data += [(300 + k, "b", data[k][2]) for k in range(9)]
    tol, leaders, want = 0.25, [], []
    for r, g, p in data:
        near = [x for x, h, q in leaders if h == g and len(q) == len(p) and sum(math.dist(u, v) for u, v in zip(p, q)) / len(p) < tol]
        want.append((r, near[0] if near else r))
        if not near:
            leaders.append((r, g, p))
    d = frame(spark, data, "r long, b string, p array<struct<x:double,y:double>>")
    got = {tuple(x) for x in G.leader_cluster(d, "r", "p", "b", tol).collect()}
    assert got == set(want) and len(leaders) > 24 and len(want) - len(leaders) > 60
    assert G.leader_cluster(d.limit(0), "r", "p", "b", tol).collect() == []


def test_ranks_without_a_cap(spark):
    d = frame(spark, [("a", 1, True)] * 3 + [("b", 1, False)] * 3 + [("c", 2, True), (None, 2, False)], "g string, m int, r boolean")
    got = {r.g: r.group_rank for r in S.two_level_rank(d, "g", "m", "r", pinned="c").where("g is not null").collect()}
    assert got == {"c": 1, "a": 2, "b": 3}
    assert {r.g for r in S.two_level_rank(d, "g", "m", "r", top=2).collect()} == {"a", "b"}


def test_components_and_leaders(spark):
    got = G.connected(boxes(spark, (0, 1), (1.2, 2), (2.1, 3), (9, 10)), "grp", "rid", 0.5)
    assert rows(got.select("rid", "component")) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    pts = [(1, "b", [(0.0, 0.0)]), (2, "b", [(0.01, 0.0)]), (3, "b", [(5.0, 0.0)]), (4, None, [(0.0, 0.0)])]
    d = frame(spark, pts, "r long, b string, p array<struct<x:double,y:double>>")
    assert rows(G.leader_cluster(d, "r", "p", "b", 0.1)) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_every_order_line_is_a_move(spark):
    import __spark_entry__

    sf = "/root/testdata/sf0.001"
    assert __spark_entry__.queries()["g7_guarded_moves"](spark, sf).count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_refinement_rolls_back_a_round_that_fails(spark):
    d = frame(spark, [(4,)], "v long")
    step = lambda x, k: x.withColumn("v", F.col("v") - (1 if k < 3 else -5))
    out, log = G.refine_until_settled(d, step, lambda x: (x.first()[0], 0), 4)
    assert out.first()[0] == 2 and [x[3] for x in log] == [True, True, True, False]


def test_latest_is_independent_of_row_order(spark):
    data = [(1, 5, 1, "reject"), (1, 5, 2, "approve"), (1, 4, 9, "amend"), (2, 1, 1, "odd")]
    for d in (data, data[::-1]):
        log = frame(spark, d, "id long, ts long, seq long, action string")
        assert rows(queue.live_states(log)) == [(1, "approve", "approved"), (2, "odd", "proposed")]
        assert rows(W.latest_by_key(log, "id", ["ts", "seq"], ["action"])) == [(1, "approve"), (2, "odd")]


def test_stream_resumes_and_settles_late_records(spark, tmp_path):
    schema = "id long, ts long, seq long, action string"
    seen = {}

    def sink(batch, number):
        seen.update({r.id: r.state for r in batch.collect()})

    for part in ([(1, 5, 1, "approve"), (2, 1, 1, "reject")], [(1, 4, 0, "reject"), (3, 1, 1, "withdraw")]):
        frame(spark, part, schema).coalesce(1).write.mode("append").json(str(tmp_path / "log"))
        stream = R.read_log(spark, str(tmp_path / "log"), schema, stream=True)
        queue.start_live_queue(stream, sink, str(tmp_path / "checkpoint"), once=True).awaitTermination(60)
    assert seen == {1: "approved", 2: "rejected", 3: "withdrawn"}


def test_labels_refuse_a_single_name_for_a_composite(spark):
    old, new = frame(spark, [(1, "a+b"), (2, "c"), (3, "d")], "k long, label string"), frame(spark, [(1, "a"), (2, "c"), (4, "e")], "k long, label string")
    assert rows(L.apply_labels(old, new, "k", "label")) == [(1, "a+b", "refused"), (2, "c", "same"), (3, "d", "kept"), (4, "e", "new")]
    assert rows(L.apply_labels(old, new, "k", "label", force=True))[0] == (1, "a", "changed")


def test_a_check_of_nothing_is_skipped(spark):
    d = boxes(spark, (0, 1))
    got = {r.check: r.status for r in V.gate([V.check(d, "a", F.col("x0") > 5), V.check(d.limit(0), "b", F.lit(True))]).collect()}
    assert got == {"a": "ok", "b": "skip", "gate": "skip"}
    assert S.guard_coverage(d.limit(0), "grp", 0).first().status == "fail"


def test_rules_chain_and_stop(spark):
    d = frame(spark, [(1,), (5,), (9,), (None,)], "v long")
    rules = [dict(id="a", category="c", when=F.col("v") > 7, note="", stop=True), dict(id="b", category="c", when=F.col("v") > 3, note="", chain="x"), dict(id="c", category="c", when=F.col("v") > 0, note="", chain="x"), dict(id="d", category="c", when=F.col("v") < 6, note="")]
    assert rows(S.apply_rules(d, rules).select("v", "rule")) == [(1, "c"), (1, "d"), (5, "b"), (5, "d"), (9, "a")]


def test_folds(spark):
    d = frame(spark, [("été  x",), ("ﬁne ①",), ("  aـb ",), (None,)], "t string")
    assert [r[0] for r in d.select(U.search_key(F.col("t"))).collect()] == ["été x", "ﬁne ①", "ab", None]
    assert [r[0] for r in d.select(U.match_fold(F.col("t"))).collect()] == ["été x", "fine 1", "ab", None]
    v = frame(spark, [("سماء",), ("abc",)], "t string").select(U.search_variants(F.col("t"))).collect()
    assert v[0][0] == ["سماء", "سما", "سماي"] and v[1][0] == ["abc"]


def test_search_falls_back_only_without_a_strict_hit(spark):
    d = frame(spark, [(1, "colour"), (2, "color")], "k long, t string")
    loose = F.replace("t", F.lit("u"), F.lit(""))
    assert rows(text_search(d, "k", F.col("t"), loose, "colour", "color")) == [(1, 0, False)]
    assert rows(text_search(d, "k", F.col("t"), loose, "coloor", "color")) == [(1, 0, True), (2, 0, True)]
    assert text_search(d, "k", F.col("t"), loose, "", "").collect() == []


def test_files_and_versions(spark, tmp_path):
    d = boxes(spark, (0, 1), (2, 3))
    for n in "ab":
        P.write_partitioned(d, "rid", ["x0"], str(tmp_path / n))
    a, b = (rows(P.manifest_files(spark, str(tmp_path / n)).select("bytes", "sha256")) for n in "ab")
    assert a == b and len(a) == 2
    root = str(tmp_path / "v")
    assert P.publish_version(d, root, "1.9") and P.publish_version(d, root, "1.10") and not P.publish_version(d, root, "1.2")
    with pytest.raises(Exception, match="(?i)exists"):
        P.publish_version(d, root, "1.9")


def test_tsv_log_and_markup(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("# head\n\n1\ta\n2\tb\n")
    assert rows(R.read_dim_tsv(spark, str(tmp_path / "d.tsv"), "k long, n string")) == [(1, "a"), (2, "b")]
    (tmp_path / "l.json").write_text('{"id": 1}\n{broken\n{"id": 2}\n')
    assert rows(R.read_log(spark, str(tmp_path / "l.json"), "id long")) == [(1,), (2,)]
    with pytest.raises(Exception):
        R.read_log(spark, str(tmp_path / "l.json"), "id long", on_bad="fail").collect()
    h = frame(spark, [(1, '<p class="a" id="x">t<br/></p><img src="q" src="r">'), (2, None)], "k long, h string")
    assert [(r.ordinal, r.tag, r["class"], r.attrs) for r in R.scan_markup(h, "k", "h").collect()] == [(0, "p", "a", {"class": "a", "id": "x"}), (1, "br", None, {}), (2, "img", None, {"src": "q"})]
