"""Language identification by hierarchical discrimination.

First the family: one-versus-one linear support vector machines between language families.  Then the language:
one-versus-one machines between the languages of that family only.  Features are shares of hashed character n-grams of
the words and of the words themselves, so a margin is a sum over words; n-grams are hashed by numpy, over the distinct
words of some MB of text at once.

Languages that no table names are put into families by their samples, about as many families as each has members, so machines
grow with the power 1.5 of the languages and not with their square.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import fold, stored, table

#: Hashed features, and rows of each language to learn from, at most about.
DIMS, ROWS = 4096, 800
#: Rows of a family that the machines between families learn from, at most about; machines trained in a task.
FAMILY_ROWS, MACHINES = 3 * ROWS, 64
#: So many languages without a family are families of their own; more are put into families by likeness.
LONERS = 8
#: Characters of text worked on at once, at most about.
SLICE = 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Families of languages by code (fixed values); a language that isn't named is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "mr", "ne", "pa", "gu", "ur"),
    "semitic": ("ar", "he", "mt", "am"),
    "sinitic": ("zh", "yue"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "gd", "br"),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}
_LETTERS = re.compile(r"[^\W\d_]+")


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].split("_")[0].lower(), lang)


def likened(langs: list[str], centres: np.ndarray) -> dict[str, str]:
    """Families of about the root of their number for languages without one: seeds far from one another, the most alike pairs of language
    and seed first, and no family above its share."""
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    count = int(np.ceil(np.sqrt(len(langs))))
    seeds = [0]
    while len(seeds) < count:
        seeds.append(int((unit @ unit[seeds].T).max(1).argmin()))
    alike, room, home = unit @ unit[seeds].T, [-(-len(langs) // count)] * count, {}
    for at in np.argsort(-alike, axis=None, kind="stable").tolist():
        lang, seed = langs[at // count], at % count
        if lang not in home and room[seed]:
            home[lang] = f"like {langs[seeds[seed]]}"
            room[seed] -= 1
    return home


def _bucket(h: np.ndarray) -> np.ndarray:
    """Polynomial hashes, mixed down to 0..DIMS-1."""
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((h >> np.uint64(33)) % np.uint64(DIMS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of lower-cased words, all at once: ``grams, whole, starts, sizes``.

    A word is marked at both ends.  ``grams`` holds, for each character of the marked words laid end to end, the features of
    the n-grams of 1, 2 and 3 characters that begin there, DIMS where there is none (a mark alone is none); ``whole`` has one
    feature for each word, ``starts`` its first character, ``sizes`` how many features it has in all.
    """
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    left = np.repeat(lengths, lengths) - place
    grams, h = np.empty((3, len(codes)), np.int64), codes
    for n in (1, 2, 3):
        if n > 1:
            h = h * BASE + np.concatenate((codes, np.zeros(n - 1, np.uint64)))[n - 1 :]
        there = (place >= 1) & (left >= 2) if n == 1 else left >= n
        grams[n - 1] = np.where(there, _bucket(h + np.uint64(n)), DIMS)
    power = np.full(int(lengths.max(initial=1)), BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    whole = np.add.reduceat(codes * power[place], starts) if len(words) else np.zeros(0, np.uint64)
    return grams, _bucket(whole), starts, 3 * lengths - 4


def _words(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def _sample(batches):
    """``lang, at, x``: the features a text has (two bytes each) and their shares, so a row is as long as its text has features."""
    for batch in batches:
        at, rows = [], []
        for t in batch.column(1):
            words = Counter(_words(t.as_py()))
            times = np.fromiter(words.values(), float, len(words))
            grams, whole, starts, sizes = features(list(words))
            counts = np.bincount(whole, times, DIMS + 1)
            for g in grams:
                counts += np.bincount(g, np.repeat(times, np.diff(np.append(starts, grams.shape[1]))), DIMS + 1)
            total, some = times @ sizes, np.flatnonzero(counts[:DIMS])
            at.append(some.astype(np.uint16).tobytes() if total else None)
            rows.append((counts[some] / total).astype(np.float32).tobytes() if total else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.binary()), pa.array(rows, pa.binary())], names=["lang", "at", "x"])


def dense(at: list[bytes], x: list[bytes]) -> np.ndarray:
    out = np.zeros((len(x), DIMS), np.float32)
    for k, (i, v) in enumerate(zip(at, x)):
        out[k, np.frombuffer(i, np.uint16)] = np.frombuffer(v, np.float32)
    return out


def _centre(rows: pa.Table) -> pa.Table:
    mean = dense(rows.column("at").to_pylist(), rows.column("x").to_pylist()).mean(0, dtype=np.float64)
    return pa.table({"lang": rows.column("lang")[:1], "centre": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def train_svm(x: np.ndarray, y: np.ndarray, rounds: int = 150, c: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine: squared hinge loss and an L2 penalty, by Adam; classes weigh the same."""
    scale = 1 / (x.std(axis=0) + 1e-4)
    z, y = (x * scale).astype(np.float32), y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, rounds + 1):
        slack = np.maximum(0, 1 - y * (z @ w + np.float32(b))) * weight * -y * np.float32(2 * c)
        g = np.append(slack @ z + w * np.float32(1e-2), slack.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
    return w * scale, float(b)


def duels(langs: list[str], homes: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """``(level, a, b)`` of every machine: families at level "" first, then the languages of one family."""
    home = lambda v: (homes or {}).get(v) or family(v)
    families = sorted({home(v) for v in langs})
    levels = [("", families), *((f, sorted(v for v in langs if home(v) == f)) for f in families)]
    return [(level, a, b) for level, groups in levels for a, b in combinations(groups, 2)]


def _trainer(tasks: dict[int, list[tuple[int, str, str]]]):
    """The machines ``(number, group, group)`` of one task from its rows ``task, side_of, at, x``; the order of rows doesn't matter."""

    def train(rows: pa.Table) -> pa.Table:
        groups: dict[str, list[tuple[bytes, bytes]]] = {}
        for g, at, x in zip(*(rows.column(c).to_pylist() for c in ("side_of", "at", "x"))):
            groups.setdefault(g, []).append((at, x))
        number, weights, bias = [], [], []
        for k, a, b in tasks[rows.column("task")[0].as_py()]:
            # In the order of the whole rows, whatever task they come from.
            sides = [(side, dense(*zip(*groups[g]))) for side, g in ((-1.0, b), (1.0, a)) if g in groups]
            x = np.concatenate([m[sorted(range(len(m)), key=lambda i, m=m: m[i].tobytes())] for _, m in sides])
            w, c = train_svm(x, np.concatenate([np.full(len(m), side, np.float32) for side, m in sides]))
            number.append(k)
            weights.append(w.astype(np.float64).tobytes())
            bias.append(c)
        return pa.table({"machine": pa.array(number, pa.int32()), "w": pa.array(weights, pa.binary()), "b": pa.array(bias, pa.float64())})

    return train


class Model:
    """All machines side by side: ``weights`` (DIMS + 1, machines; the last row is zero) and ``bias``, in the order of ``duels``."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, homes: dict[str, str] | None = None):
        self.langs, self.homes = sorted(langs), {v: (homes or {}).get(v) or family(v) for v in langs}
        self.families = sorted(set(self.homes.values()))
        self.machines = {d: k for k, d in enumerate(duels(self.langs, self.homes))}
        self.weights, self.bias = np.vstack([weights, np.zeros((1, weights.shape[1]))]), bias

    def choose(self, level: str, groups: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of margins the group that wins its duels by the largest sum of log probabilities, and its share."""
        total = np.zeros((len(margins), len(groups)))
        for (i, a), (j, b) in combinations(enumerate(groups), 2):
            d = np.clip(3 * margins[:, self.machines[level, a, b]], -30, 30)
            total[:, i] -= np.log1p(np.exp(-d))
            total[:, j] -= np.log1p(np.exp(d))
        best = len(groups) - 1 - total[:, ::-1].argmax(axis=1)
        odds = np.exp(total)
        return best, odds[np.arange(len(total)), best] / odds.sum(axis=1)

    def predict(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row of margins: the family first, then a language of it."""
        home, score = self.choose("", self.families, margins)
        langs = np.empty(len(margins), object)
        for k, f in enumerate(self.families):
            mine, members = home == k, [v for v in self.langs if self.homes[v] == f]
            best, share = self.choose(f, members, margins[mine])
            langs[mine] = np.array(members, object)[best]
            score[mine] *= share
        return langs, score

    def margins(self, texts: list[Counter]) -> np.ndarray:
        """Margins of texts given as counted words (at least one each): a word's weights are summed once for all of them."""
        place: dict[str, int] = {}
        ids = np.array([place.setdefault(w, len(place)) for t in texts for w in t], np.int64)
        times = np.array([n for t in texts for n in t.values()], float)
        grams, whole, starts, sizes = features(list(place))
        at = self.weights[grams[0]] + self.weights[grams[1]] + self.weights[grams[2]]
        worth = np.add.reduceat(at, starts, axis=0) + self.weights[whole]
        first = np.cumsum([0, *map(len, texts[:-1])])
        total = np.add.reduceat(times * sizes[ids], first)
        return np.add.reduceat(times[:, None] * worth[ids], first, axis=0) / total[:, None] + self.bias


def fit(docs: DataFrame, learn, rows: int = ROWS) -> Model | None:
    """Fit on rows where ``learn`` holds and neither text nor lang is null; about ``rows`` of each language, picked by hash.

    Up to ``MACHINES`` machines of a level are trained in a task, from one copy of the samples of their groups, so a sample is sent as often
    as its levels have tasks; only weights, and centres of languages without a family, come to the driver.
    """
    spark = docs.sparkSession
    usable = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    dice = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    rate = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, rows / n))])
    picked = usable.where(dice < rate[F.col("lang")]).select("lang", "text")
    sample = stored(picked.mapInArrow(_sample, "lang string, at binary, x binary").where("x is not null"), "langid-sample")
    drawn = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    langs = sorted(drawn)
    if not langs:
        return None
    homes, alone = {v: family(v) for v in langs}, [v for v in langs if family(v) == v]
    if len(alone) > LONERS:
        found = sample.where(F.col("lang").isin(alone)).groupBy("lang").applyInArrow(_centre, "lang string, centre binary").collect()
        centres = {r.lang: np.frombuffer(r.centre, np.float32) for r in found}
        homes |= likened(alone, np.stack([centres[v] for v in alone]).astype(float))
    machines = duels(langs, homes)
    if not machines:
        return Model(langs, np.zeros((DIMS, 0)), np.zeros(0), homes)
    tasks: dict[int, list[tuple[int, str, str]]] = {}
    task, last = -1, None
    for k, (level, a, b) in enumerate(machines):
        if level != last or len(tasks[task]) == MACHINES:
            task, last = task + 1, level
        tasks.setdefault(task, []).append((k, a, b))
    size = Counter()
    for v in langs:
        size[homes[v]] += drawn[v]
    needs = []
    for task, own in tasks.items():
        level, groups = machines[own[0][0]][0], {g for _, *pair in own for g in pair}
        for v in langs:
            group, share = (v, 1.0) if level else (homes[v], min(1.0, FAMILY_ROWS / size[homes[v]]))
            if group in groups:
                needs.append((v, task, group, share))
    # A row for each language and task it is needed in: bounded by the languages, whatever the input.
    needs = F.broadcast(spark.createDataFrame(needs, "lang string, task int, side_of string, share double"))
    again = F.pmod(F.xxhash64("x", F.lit("family")), F.lit(1 << 30)) / float(1 << 30)
    sent = sample.join(needs, "lang").where((F.col("share") >= 1) | (again < F.col("share"))).select("task", "side_of", "at", "x")
    trained = sent.groupBy("task").applyInArrow(_trainer(tasks), "machine int, w binary, b double").collect()
    trained = {r.machine: (np.frombuffer(r.w, np.float64), r.b) for r in trained}
    order = range(len(machines))
    return Model(langs, np.stack([trained[k][0] for k in order], 1), np.array([trained[k][1] for k in order]), homes)


def identify(docs: DataFrame, model: Model | None, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of every whole text and a score in 0..1, in place of columns of these names if there are any.

    ``und`` and 0 where the text is null or has no letter, or where there was nothing to learn from.  Equal texts agree.
    """
    if text in (pred, score) or pred == score:
        raise ValueError("text, pred and score must be three columns")
    docs = docs.drop(pred, score)
    schema, at = StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())]), docs.columns.index(text)

    def found(column):
        """Languages and scores of a column, a few MB of text at a time."""
        langs, scores = np.full(len(column), "und", object), np.zeros(len(column))
        some, held, size = [], [], 0
        for k, t in enumerate(column):
            body = t.as_py() or "" if model else ""
            words = Counter(_words(body))
            if any(c.isalpha() for w in words for c in w):
                some.append(k)
                held.append(words)
                size += len(body)
            if held and (size > SLICE or k == len(column) - 1):
                langs[some], scores[some] = model.predict(model.margins(held))
                some, held, size = [], [], 0
        return langs, scores

    def run(batches):
        for batch in batches:
            langs, scores = found(batch.column(at))
            columns = [*batch.columns, pa.array(langs.tolist(), pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, pred, score])

    return docs.mapInArrow(run, schema)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language: ``doc_id, held_out, lang_pred, score``; learned where crc32(doc_id) mod 4 isn't 2.
    A null id has no remainder: such rows aren't learned from, and count as held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    learn = F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(False))
    found = identify(docs.select("doc_id", "text"), fit(docs, learn))
    return found.select("doc_id", (~learn).alias("held_out"), "lang_pred", "score")
