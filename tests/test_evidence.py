import pytest
from pyspark.sql import functions as F

from marginalia.functions import text as U
from marginalia.operators import aggregates as A

#: (curve, input, probability, proof): values at and beside every edge.
EDGES = [
    ("size", 1 / 3, 1.0, True), ("size", 0.34, 0.15 + 0.45 * (1 / 0.34 - 2), False), ("size", 0.5, 0.0, False), ("size", 2.0, 0.0, False), ("size", 2.5, 0.375, False),
    ("size", 3.0, 1.0, True), ("size", 0.0, 0.0, False), ("size", None, 0.0, False),
    ("soft", 3.0, 0.60, False), ("soft", 0.2, 0.60, False), ("soft", 2.5, 0.375, False),
    ("stray", 2.0, 0.0, False), ("stray", 21.0, 0.35, False), ("stray", 40.0, 1.0, True), ("stray", 39.999, 0.65, False), ("stray", None, 0.0, False),
    ("band", 5.0, 0.0, False), ("band", 5.1, 0.05, False), ("band", 10.0, 0.05, False), ("band", 10.0001, 0.35, False), ("band", 12.5, 0.525, False), ("band", 15.0, 1.0, True),
    ("width", 0.70, 0.0, False), ("width", 1.45, 0.0, False), ("width", 0.69, 0.20, False), ("width", 1.725, 0.40, False), ("width", 2.0, 0.85, False), ("width", 0.5, 0.85, False), ("width", 0.0, 0.85, False),
]


def test_edges_of_the_curves(spark):
    d = spark.createDataFrame(EDGES, "curve string, v double, p double, proof boolean")
    v, none = F.col("v"), F.lit(False)
    curves = {"size": U.p_size(v), "soft": U.p_size(v, F.lit(False)), "stray": U.p_stray(v), "band": U.p_band(v), "width": (U.p_width(v, F.lit(4.0)), none)}
    for name, (p, proof) in curves.items():
        for r in d.where(F.col("curve") == name).select("v", "p", "proof", p.alias("got"), proof.alias("sure")).collect():
            assert r.got == pytest.approx(r.p, abs=1e-4) and r.sure == r.proof, (name, r)
    assert spark.range(1).select(U.p_width(F.lit(3.0), F.lit(3.9))).first()[0] == 0.0
    labels = spark.createDataFrame([("none",), ("auto",), ("human",), (None,)], "s string").select(U.p_label(F.col("s"))).collect()
    assert [r[0] for r in labels] == [0.15, 0.03, 0.0, 0.0]


def scored(spark, rows):
    d = spark.createDataFrame(rows, "key long, child long, name string, p double, proof boolean")
    return {r.key: (round(r.p, 6), r.tier, r.proofs, [(e.name, e.p) for e in r.evidence]) for r in A.score_entity(d, "key", child="child").collect()}


def test_weak_parts_are_not_folded_and_proven_ones_prove(spark):
    rows = [(1, c, "label", 0.03, False) for c in range(40)]  # each below the floor
    rows += [(2, 1, "label", 0.03, False), (2, 1, "stray", 0.2, False), (2, 2, "label", 0.03, False)]
    rows += [(3, 1, "band", 1.0, True), (3, None, "dots", 0.8, False)]
    rows += [(4, None, "width", 0.85, False), (4, 1, "label", 0.03, False)]
    rows += [(5, None, "width", 0.85, False), (5, 1, "label", 0.15, False)]
    rows += [(6, None, "width", 0.20, False), (7, None, "dots", 0.0, None), (8, None, "family", 0.55, False), (8, None, "ref-line", 0.6, False), (9, None, None, None, None)]
    got = scored(spark, rows)
    assert got[1] == (0.0, "clean", [], [])
    assert got[2] == (pytest.approx(1 - 0.97 * 0.8), "review", [], [("mark", pytest.approx(0.224))])
    assert got[3][:3] == (1.0, "certain", ["mark"])
    assert got[4][:2] == (0.45, "review") and got[5][:2] == (pytest.approx(1 - 0.15 * 0.85), "high")
    assert got[6][:2] == (0.2, "review") and got[7][:2] == (0.0, "clean") and got[8][:2] == (pytest.approx(0.82), "high") and got[9][:2] == (0.0, "clean")


def test_soft_evidence_never_makes_certain(spark):
    assert scored(spark, [(1, None, f"n{k}", 0.999999, False) for k in range(5)])[1][1] == "high"


def test_signature_median_needs_ten(spark):
    rows = [("s", "f", float(v)) for v in range(10)] + [("t", "f", 100.0 + v) for v in range(9)] + [(None, "f", 1.0), (None, None, 2.0)]
    d = spark.createDataFrame(rows, "sig string, fam string, v double")
    got = {(r.sig, r.fam): (r.median, r.by_signature) for r in A.preferred_median(d, "v", "sig", "fam").collect()}
    whole = sorted(r[2] for r in rows if r[1])
    assert got == {("s", "f"): (5.0, True), ("t", "f"): (whole[10], False), (None, "f"): (whole[10], False), (None, None): (None, False)}
