import re

from pyspark.sql import functions as F

from marginalia.operators import aggregates as A
from marginalia.operators import joins as J
from marginalia.operators import select as S
from marginalia.operators import windows as W
from marginalia.plans import registry


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counterparts_by_rank_then_order_and_promotion(spark):
    schema = "g long, f string, rid long, line long, pos long, delta long, x0 double, x1 double"
    d = spark.createDataFrame([
        (1, "f", 1, 1, 1, 1, 0.0, 1.0), (1, "f", 2, 1, 2, -1, 50.0, 51.0), (1, "f", 3, 2, 3, -1, 0.0, 1.0),  # next in order beats an overlap below
        (2, "f", 1, 1, 5, 1, 0.0, 1.0), (2, "f", 2, 2, 6, -1, 90.0, 91.0), (2, "f", 3, 2, 9, -1, 0.0, 1.0),  # over the line break
        (3, "f", 1, 1, 5, 1, 0.0, 1.0), (3, "f", 2, 2, 9, -1, 3.9, 5.0), (3, "f", 3, 1, 1, -1, 0.0, 1.0), (3, "f", 4, 2, 12, -1, 0.0, 1.0),  # overlap above -3; nearer in order
        (4, "f", 1, 1, 5, 1, 0.0, 1.0), (4, "f", 2, 1, 8, -1, 0.0, 1.0), (4, "f", 3, 1, 2, -1, 70.0, 71.0),  # equal distance: the smaller place
        (5, "f", 1, 1, 5, 1, 0.0, 1.0), (5, "f", 2, 4, 6, -1, 0.0, 1.0), (5, "g", 3, 1, 6, -1, 0.0, 1.0), (6, "f", 1, None, 1, 1, 0.0, 1.0), (6, "f", 2, None, 2, -1, 0.0, 1.0),
        (7, "f", 1, 1, 5, 1, None, None), (7, "f", 2, 2, 9, -1, 0.0, 1.0),
    ], schema)
    links = J.pair_counterparts(d, "delta", "g", "f", "rid", "line", "pos")
    assert rows(links.where("role = 'surplus'").select("g", "rid", "other", "rank", "distance")) == [(1, 1, 2, 0, 1), (2, 1, 2, 1, 1), (3, 1, 2, 2, 4), (4, 1, 3, 3, 3)]
    assert rows(links.where("role = 'deficit'").select("g", "rid", "other")) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 3, 1)]
    scores = spark.createDataFrame([(1, 1, 0.1, "clean", None), (1, 2, 0.1, "clean", "no-issue"), (2, 1, 0.3, "review", None), (2, 2, 0.19, "clean", None), (9, 9, 0.0, "clean", None)], "g long, rid long, p double, tier string, human string")
    got = J.promote_counterparts(scores, links, ["g", "rid"], "f", human="human")
    assert rows(got) == [
        (1, 1, 0.25, "review", None, ["f"]), (1, 2, 0.1, "clean", "no-issue", ["f"]), (2, 1, 0.3, "review", None, ["f"]), (2, 2, 0.25, "review", None, ["f"]), (9, 9, 0.0, "clean", None, []),
    ]


def test_band_by_overlap_prefers_its_own_on_ties(spark):
    bands = spark.createDataFrame([(1, k, 10.0 * k, 10.0 * k + 10) for k in range(5)], "g long, b long, y0 double, y1 double")
    items = spark.createDataFrame([(1, 1, 3, 25.0, 35.0), (1, 2, 0, 25.0, 35.0), (1, 3, 0, 21.0, 35.0), (1, 4, 0, 500.0, 501.0), (2, 5, 0, 0.0, 1.0), (1, 6, 0, None, 1.0)], "g long, i long, own long, y0 double, y1 double")
    for height in (4.0, 100.0):
        got = J.assign_band_by_overlap(items, bands, "g", ["i"], "b", own="own", height=height).select("i", "band", "overlap")
        assert rows(got) == [(1, 3, 5.0), (2, 2, 5.0), (3, 2, 9.0), (4, None, None), (5, None, None), (6, None, None)]


def test_findings_by_scope(spark):
    terms = spark.createDataFrame([("sura", "spelling"), ("verse", "gloss"), ("surah", "canonical"), ("house rule", "house")], "term string, rule string")
    lines = spark.createDataFrame([
        ("a.py", 1, "suraName = verse_of(verse) + SURAS", False, False), ("a.py", 2, "sura  # Terminology:  IGNORE", False, False), ("a.py", 3, None, False, False),
        ("b.md", 1, "the verse of a sura, sura", True, False), ("c.py", 1, "verse sura surah house_rule", None, True), ("d.py", 1, "sura_kept ext.Sura", False, None),
    ], "path string, no long, line string, prose boolean, allowed boolean")
    got = J.scoped_findings(lines, terms, "path", "no", "line", "prose", "allowed", external=r"ext\.\w+")
    assert rows(got.select("path", "no", "identifier", "term", "severity", "n")) == [
        ("a.py", 1, "SURAS", "sura", "error", 1), ("a.py", 1, "suraName", "sura", "error", 1), ("a.py", 1, "verse", "verse", "warning", 1), ("a.py", 1, "verse_of", "verse", "warning", 1),
        ("b.md", 1, "sura", "sura", "error", 2), ("c.py", 1, "house_rule", "house rule", "warning", 1), ("c.py", 1, "sura", "sura", "error", 1), ("d.py", 1, "sura_kept", "sura", "error", 1),
    ]


def test_grades_of_rare_values(spark):
    usual = [("f", k, 1, 3, 5) for k in range(100, 130)]
    odd = [("f", 1, 10, 3, 6), ("f", 2, 10, 4, 5), ("f", 3, 10, 3, 8), ("f", 3, 11, 2, 5), ("f", 3, 12, 2, 5)]
    d = spark.createDataFrame(usual + odd, "form string, g long, pos long, runs long, n long")
    got = A.hapax_deviation(d, "form", ["runs", "n"], "g", "pos", review=("runs",)).select("g", "axis", "value", "grade")
    # The neighbours of the third deviate the other way, though twice and so not rarely.
    assert rows(got) == [(1, "n", 6.0, "HAPAX"), (2, "runs", 4.0, "REVIEW"), (3, "n", 8.0, "PAIRED")]


def test_divisions_partial_groups_and_one_sided_keys(spark):
    d = spark.createDataFrame([(1, "juz", 3, 2), (1, "juz", 2, 1), (1, "hizb", 9, 1), (1, None, 1, 1), (2, "juz", None, 1)], "g long, k string, v long, o long")
    assert rows(A.division_map(d, "g", "k", "v", "o")) == [(1, {"hizb": 9, "juz": 2})]
    seen = spark.createDataFrame([(1, n) for n in (3, 4, 4, 7)] + [(2, n) for n in (1, 3)] + [(3, 3), (5, None)], "g long, n long")
    want = spark.createDataFrame([(1, 5, True), (2, 3, True), (3, 3, False), (4, 2, True), (5, 0, None)], "g long, n_expected int, cut boolean")
    assert rows(A.completeness(seen, "g", "n", want, cut="cut")) == [(1, 1, 0, 1, True), (2, 0, 1, 0, False), (3, 0, 2, 0, False), (4, 0, 2, 0, False), (5, 0, 0, 0, False)]
    assert rows(A.completeness(seen, "g", "n", want.drop("cut")))[0] == (1, 1, 3, 1)
    sides = spark.createDataFrame([(1, 2.0, 1.0, 1.0), (2, 1.0, 0.5, 1.0), (3, 2.0, 0.1, 1.0), (4, 1.5, 1.0, 1.0), (5, 0.0, 9.0, 1.0)], "k long, a double, b double, e double")
    assert rows(A.one_sided_keys(sides, ["k"], "a", "b", "e")) == [(1, "a", 2.0, 1.0), (2, "b", 0.5, 1.0)]


def test_rules_propose_fixes(spark):
    d = spark.createDataFrame([(1, 5), (2, 50)], "id long, v long")
    rules = [{"id": "A", "category": "c", "when": F.col("v") > 10, "note": "big", "fix": F.concat(F.lit("halve "), "id")}, {"id": "B", "category": "c", "when": F.lit(True), "note": "any", "fix": "look"}, {"id": "C", "category": "c", "when": F.lit(True), "note": "none"}]
    assert rows(S.apply_rules(d, rules).select("id", "rule", "proposed_fix")) == [(1, "B", "look"), (1, "C", None), (2, "A", "halve 2"), (2, "B", "look"), (2, "C", None)]


def test_scoreboard_by_family(spark):
    families = {"a": "a", "dots": ".!"}
    truth = spark.createDataFrame([(1, "aa."), (2, "b!"), (3, "a"), (4, None)], "k long, text string")
    texts = [("x", 1, "aa!"), ("x", 2, "b"), ("x", 3, ""), ("y", 1, "a."), ("y", 2, "ab"), ("y", 3, "a"), ("y", 4, "a"), ("y", 9, "a")]
    errors = A.family_errors(spark.createDataFrame(texts, "name string, k long, text string"), truth, ["k"], families)
    assert rows(A.family_scoreboard(errors, truth, families)) == [("x", 1, 1, 1, 0.5, 0, 1), ("y", 1, 2, 0, 1 / 3, 2, 1)]
    assert rows(A.family_examples(errors, ["k"], most=1).select("name", "family", "k", "got", "want")) == [("x", "dots", 2, 0, 1), ("y", "a", 1, 1, 2), ("y", "dots", 2, 0, 1)]
    assert spark.range(1).select(A.composite_text(F.lit("a.b!"), F.lit("!c?"), ".!?")).first()[0] == "ab!?"


def test_islands_of_equal_intervals(spark):
    """SQL whose two windows may order equal intervals differently would put one of them before the first island."""
    sql = registry.oracle_sql()["w5_islands"]
    assert re.findall(r"ORDER BY ([a-z0-9, ]+) ROWS", sql[sql.index("r AS (SELECT grp, ") :]) == ["x0, x1, rid"] * 2
    d = spark.range(3000).selectExpr("id div 6 as g", "1.0 as lo", "2.0 as hi")
    assert {tuple(r)[1:] for r in W.islands(d, "g", "lo", "hi", 0.4).collect()} == {(1, 1.0, 2.0, 6)}


def test_expanded_ranges_are_not_broadcast(spark):
    r = spark.createDataFrame([(1, 4), (3, 3), (9, 2)], "lo long, hi long")
    got = J.range_expand(r, "lo", "hi", spark.createDataFrame([(2,), (3,), (3,), (7,)], "i long"), "i")
    assert rows(got) == [(1, 4, 2), (1, 4, 3), (3, 3, 3)]
    assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
