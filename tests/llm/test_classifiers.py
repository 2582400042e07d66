import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import langid, toxicity

from .conftest import DOCS


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    en = ["the", "house", "with", "thing", "there", "water", "running", "should", "that", "each"]
    de = ["der", "haus", "nicht", "schön", "wasser", "laufen", "sollte", "einheit", "und", "jeder"]
    fr = ["le", "maison", "avec", "chose", "étaient", "eau", "courir", "devrait", "que", "chaque"]
    es = ["el", "casa", "con", "cosa", "estaban", "agua", "corriendo", "debería", "que", "cada"]
    rows = []
    for k in range(400):
        lang, words = rng.choice([("en", en), ("de", de), ("fr", fr), ("es", es)])
        rows.append((k, lang, [rng.choice(words) for _ in range(rng.randrange(8, 40))]))
    return rng, rows


def test_languages(spark, texts):
    _, rows = texts
    data = [(k, " ".join(w), lang, "s", 1) for k, lang, w in rows]
    data += [(900, None, "en", "s", 1), (901, "", "en", "s", 1), (902, "12 !? 34 ²", "en", "s", 1), (903, "haus", None, None, 1)]
    d = spark.createDataFrame(data, DOCS)
    model = langid.fit(d, F.col("doc_id") % 2 == 0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(d.select("doc_id", "text"), model).collect()}
    right = [got[k][0] == lang for k, lang, _ in rows if k % 2]
    assert np.mean(right) > 0.95
    assert all(got[k] == ("und", 0.0) for k in (900, 901, 902)) and got[903][0] == "de"
    assert all(0 <= s <= 1 for _, s in got.values())
    # nothing to learn, one language, an empty table
    assert langid.fit(d, F.lit(False)) is None
    assert {r.lang_pred for r in langid.identify(d.select("text"), None).collect()} == {"und"}
    only = langid.fit(d.where("lang = 'en'"), F.lit(True))
    assert {r.lang_pred for r in langid.identify(d.where("doc_id < 9").select("text"), only).collect()} == {"en"}
    assert langid.identify(d.limit(0).select("text"), model).collect() == []


def plain_features(word):
    """The features of one word, gram by gram, in plain integers."""
    base, top = int(langid.BASE), 2**64

    def bucket(h):
        h = (h ^ h >> 33) * 0xFF51AFD7ED558CCD % top
        h = (h ^ h >> 33) * 0xC4CEB9FE1A85EC53 % top
        return (h >> 33) % langid.DIMS

    w = [ord(c) for c in f"^{word}$"]
    found = [bucket(sum(c * base**i for i, c in enumerate(w)) % top)]
    found += [bucket((c + 1) % top) for c in w[1:-1]]
    for n in (2, 3):
        for k in range(len(w) - n + 1):
            found.append(bucket((sum(c * base ** (n - 1 - i) for i, c in enumerate(w[k : k + n])) + n) % top))
    return found


def plain_predict(model, text):
    """Family, then language, of one text: one gram and one duel after another."""
    grams = [g for w in langid._words(text) for g in plain_features(w)]
    if not grams:
        return "und", 0.0
    margin = model.weights[grams].sum(axis=0) / len(grams) + model.bias

    def choose(level, groups):
        total = dict.fromkeys(groups, 0.0)
        for (lv, a, b), k in model.machines.items():
            if lv == level:
                d = min(30, max(-30, 3 * margin[k]))
                total[a] -= np.log1p(np.exp(-d))
                total[b] -= np.log1p(np.exp(d))
        best = max(groups, key=lambda g: (total[g], g))
        return best, np.exp(total[best]) / sum(np.exp(v) for v in total.values())

    f, p = choose("", model.families)
    lang, q = choose(f, [v for v in model.langs if model.homes[v] == f])
    return lang, p * q


def test_scores_equal_a_plain_scorer(spark, texts, monkeypatch):
    rng, rows = texts
    d = spark.createDataFrame([(k, " ".join(w), lang, "s", 1) for k, lang, w in rows], DOCS)
    model = langid.fit(d, F.col("doc_id") % 2 == 0)
    bodies = [" ".join(w) for _, _, w in rows[:60]] + ["ÉTÉ Straße 中文 𝔘nd x", "a", "", "7", "Haus " * 5000, "Haus " * 5000]
    bodies += ["".join(rng.choice("abcßé中 \n9_-") for _ in range(40)) for _ in range(40)]
    monkeypatch.setattr(langid, "SLICE", 500)
    data = spark.createDataFrame([(k, t, "old", 7.0) for k, t in enumerate(bodies)], "k long, text string, lang_pred string, score double")
    got = {r.k: r for r in langid.identify(data, model).collect()}
    assert langid.identify(data, model).columns == ["k", "text", "lang_pred", "score"]
    for k, t in enumerate(bodies):
        lang, score = plain_predict(model, t)
        assert got[k].lang_pred == lang and got[k].score == pytest.approx(score, abs=1e-9)
    assert got[64][1:] == got[65][1:]
    grams, whole, starts, sizes = langid.features(["haus", "é", "中文"])
    for k, w in enumerate(["haus", "é", "中文"]):
        mine = grams[:, starts[k] : starts[k] + len(w) + 2].ravel()
        assert sorted([*mine[mine < langid.DIMS], whole[k]]) == sorted(plain_features(w)) and sizes[k] == len(plain_features(w))


def test_families():
    assert langid.family("de-AT") == langid.family("en") == "germanic" and langid.family("fr") == "romance" and langid.family("tlh") == "tlh"


def test_a_hundred_languages_without_a_family(spark):
    rng = random.Random(12)
    syllable = lambda: "".join(rng.choice(c) for c in ("bcdfghklmnprstvz", "aeiouy", "lmnrst"))
    roots = [[syllable() for _ in range(12)] for _ in range(10)]  # shared by ten languages each
    rows = []
    for n in range(100):
        own = roots[n % 10] + [syllable() for _ in range(12)]
        for _ in range(12):
            rows.append((len(rows), " ".join("".join(rng.choice(own) for _ in range(rng.randrange(1, 4))) for _ in range(60)), f"x{n:02d}", "s", 1))
    d = spark.createDataFrame(rows, DOCS)
    model = langid.fit(d, F.col("doc_id") % 4 != 0)
    sizes = [sum(h == f for h in model.homes.values()) for f in model.families]
    assert len(model.families) == 10 and max(sizes) == 10 and len(model.machines) == 45 + 10 * 45 == model.weights.shape[1]
    got = {r.doc_id: r.lang_pred for r in langid.identify(d.where("doc_id % 4 = 0").select("doc_id", "text"), model).collect()}
    assert np.mean([got[r[0]] == r[2] for r in rows if r[0] % 4 == 0]) > 0.9


def test_samples_are_sparse_and_likeness_is_bounded():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["the house the", None])], names=["lang", "text"])
    (out,) = langid._sample([batch])
    assert out.column("x")[1].as_py() is None and len(out.column("at")[0].as_py()) < 100
    x = langid.dense([out.column("at")[0].as_py()], [out.column("x")[0].as_py()])
    assert x.shape == (1, langid.DIMS) and x.sum() == pytest.approx(1, abs=1e-5)
    homes = langid.likened([f"l{k}" for k in range(23)], np.random.default_rng(0).random((23, 8)))
    assert len(homes) == 23 and len(set(homes.values())) == 5 and max(list(homes.values()).count(h) for h in homes.values()) <= 5


@pytest.fixture(scope="module")
def toxic(spark, texts):
    rng, rows = texts
    data, labels = [], []
    for k, lang, w in rows:
        bad = rng.random() < 0.25
        w = list(w)
        for _ in range(max(2, len(w) // 6) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grobian", "grobiant", "Grobianus!", "schnodder"]))
        data.append((k, " ".join(w), lang, "s", 1))
        if rng.random() < 0.6:
            labels.append((k, 1, int(bad)))
        data[-1] += (bad,)
    return data, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark, toxic):
    data, labels = toxic
    d = spark.createDataFrame([r[:5] for r in data] + [(900, None, None, None, None), (901, "", None, None, None)], DOCS)
    model = toxicity.fit(d, labels, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(d.select("doc_id", "text"), model).collect()}
    held = [(got[r[0]] >= 0.5, r[5]) for r in data if r[0] % 3 == 0]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901] < 0.5


def plain_score(model, text):
    """The averaged classifiers on one text: every word's features counted one by one."""
    words, counts = (text or "").lower().split(), {}
    for w in words:
        for f in toxicity.word_features(w):
            if f in model.place:
                counts[f] = counts.get(f, 0) + 1
    odds = []
    for w in model.weights:
        z = w[-1] + sum(w[model.place[f]] * np.log1p(100.0 * n / len(words)) for f, n in counts.items())
        odds.append(1 / (1 + np.exp(-z)))
    return float(np.mean(odds))


def test_toxicity_equals_a_plain_scorer(spark, toxic):
    data, labels = toxic
    d = spark.createDataFrame([r[:5] for r in data], DOCS)
    model = toxicity.fit(d, labels, F.lit(True))
    bodies = [r[1] for r in data[:40]] + ["", None, "grobian", "Grobianus! " * 9000, "haus grobian", "haus grobian", "  \n "]
    frame = spark.createDataFrame([(k, t, "mine", 3.0) for k, t in enumerate(bodies)], "k long, text string, _id string, score double")
    scored = toxicity.score(frame, model)
    assert scored.columns == ["k", "text", "_id", "score"]
    got = {r.k: r.score for r in scored.collect()}
    assert all(got[k] == pytest.approx(plain_score(model, t), abs=1e-6) for k, t in enumerate(bodies))
    assert got[44] == got[45] and len(got) == len(bodies)
    # the same model, whatever the partitions and however often a row is there
    again = toxicity.fit(d.unionByName(d.limit(7)).repartition(7), labels.repartition(3), F.lit(True))
    assert set(again.place) & set(model.place)


def test_the_stage_keeps_what_a_plain_scorer_keeps(spark, toxic, tmp_path):
    data, labels = toxic
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.createDataFrame([r[:5] for r in data] + [(None, "no id", None, None, None), (900, None, None, None, None)], DOCS)
    model = toxicity.fit(d, labels, F.col("doc_id").isNotNull())
    kept = toxicity.toxicity_stage(spark, d, str(tmp_path))
    want = sorted((r for r in map(tuple, d.collect()) if plain_score(model, r[1]) < 0.5), key=str)
    assert kept.columns == d.columns and sorted(map(tuple, kept.collect()), key=str) == want
    assert 0 < len(want) < len(data)


def test_without_labels_or_rows(spark, toxic):
    data, labels = toxic
    d = spark.createDataFrame([r[:5] for r in data[:9]], DOCS)
    model = toxicity.fit(d, labels.limit(0), F.lit(True))
    assert all(r.score < 0.5 for r in toxicity.score(d, model).collect())
    model = toxicity.fit(d.limit(0), labels, F.lit(True))
    assert toxicity.score(d.limit(0), model).collect() == []


def test_risk_never_fits_below_zero():
    rng = np.random.default_rng(0)
    p, u = np.ones((20, 1), np.float32), np.vstack([np.ones((20, 1)), np.zeros((180, 1))]).astype(np.float32)
    w = toxicity.train_nnpu(p, u, 0.1)
    assert w[0] + w[1] > 0 > w[1]
    assert np.isfinite(toxicity.train_nnpu(rng.random((5, 3)).astype(np.float32), rng.random((9, 3)).astype(np.float32), 0.9)).all()
