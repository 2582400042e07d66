"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; every other text is unlabelled, toxic or not.  With class prior p and loss l, the
risk is  p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)]):  the negatives' part is the unlabelled risk corrected for the
positives hidden in it, and never falls below zero.  Several numpy classifiers, each on a resample, are averaged.

Features are words and beginnings of words, hashed, each worth the logarithm of its share of the text's words: a word
that a long text has once by chance says less than one in every ten.  The sample to learn from is bounded by parameters
and picked by hash; which features matter is counted over that sample by Spark.  Scoring is one map over the texts.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import fold, stored, table

#: Rows to learn from, at most about: confirmed toxic, and unlabelled.
POSITIVES, UNLABELLED = 3_000, 6_000
#: Features that the classifiers see, and confirmed texts that must have one.
FEATURES, LEAST = 512, 3
PREFIXES = (4, 5, 6)
MODELS = 3
EDGE = ".,;:!?\"'()[]{}<>*_-~|/\\#%&$+=@^`…«»“”‘’¿¡"


def word_features(word: str) -> list[int]:
    """Hashed features of one lower-cased word: itself without punctuation around it, and its beginnings."""
    word = word.strip(EDGE)
    if not word:
        return []
    return [zlib.crc32(f"={word}".encode()), *(zlib.crc32(f"^{word[:n]}".encode()) for n in PREFIXES if len(word) >= n)]


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and what each is worth."""
    counts = Counter(text.lower().split())
    found: Counter[int] = Counter()
    for w, c in counts.items():
        for f in word_features(w):
            found[f] += c
    n = max(1, sum(counts.values()))
    return np.fromiter(found, np.int64, len(found)), worth(np.fromiter(found.values(), np.float64, len(found)), n)


def worth(count: np.ndarray, words: int) -> np.ndarray:
    return np.log1p(100.0 * count / words).astype(np.float32)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else [], kind))


def _featurise(batches):
    for batch in batches:
        rows = [text_features(t.as_py() or "") for t in batch.column(1)]
        lists = _lists([r[0] for r in rows], pa.int64()), _lists([r[1] for r in rows], pa.float32())
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["positive", "features", "worth"])


def _densify(place: dict[int, int]):
    """Rows of the chosen features only."""
    chosen = np.array(sorted(place))

    def run(batches):
        for batch in batches:
            rows = []
            for features, value in zip(batch.column(1), batch.column(2)):
                f, v, x = features.values.to_numpy(), value.values.to_numpy(), np.zeros(len(place), np.float32)
                kept = np.isin(f, chosen)
                x[[place[k] for k in f[kept].tolist()]] = v[kept]
                rows.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["positive", "x"])

    return run


def train_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 250, rate: float = 0.1, decay: float = 1e-3, seed: int = 0
) -> np.ndarray:
    """Weights (the last is the bias) that minimise the non-negative risk with logistic loss, by Adam on resampled rows."""
    rng = np.random.default_rng(seed)
    p = np.hstack([positive, np.ones((len(positive), 1), np.float32)])[rng.integers(0, len(positive), len(positive))]
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1), np.float32)])[rng.integers(0, len(unlabelled), len(unlabelled))]
    w, m, v = (np.zeros(p.shape[1], np.float32) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for t in range(1, rounds + 1):
        fp, fu = p @ w, u @ w
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gradient = prior * (p.T @ (-sigmoid(-fp))) / len(p)
        correction = (u.T @ sigmoid(fu)) / len(u) - prior * (p.T @ sigmoid(fp)) / len(p)
        # Below zero the corrected part has fitted the positives themselves: step back from it.
        gradient = gradient + correction if negative >= 0 else -correction
        gradient[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class Model:
    """Averaged classifiers over hashed features; without anything to learn from, every score is the prior."""

    def __init__(self, features: list[int], weights: np.ndarray, prior: float):
        self.place = {f: k for k, f in enumerate(features)}
        self.weights, self.prior, self.known = weights, prior, {}

    def score(self, text: str | None) -> float:
        if not len(self.weights):
            return self.prior
        hits: dict[int, int] = {}
        known, words = self.known, (text or "").lower().split()
        for w, c in Counter(words).items():
            at = known.get(w)
            if at is None:
                if len(known) > 100_000:
                    known.clear()
                at = known[w] = tuple(self.place[f] for f in word_features(w) if f in self.place)
            for k in at:
                hits[k] = hits.get(k, 0) + c
        chosen = sorted(hits)
        value = worth(np.array([hits[k] for k in chosen], float), max(1, len(words)))
        f = self.weights[:, chosen] @ value + self.weights[:, -1]
        return float((1 / (1 + np.exp(-np.clip(f, -30, 30)))).mean())


def fit(docs: DataFrame, labels: DataFrame, learn, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on the rows of ``docs`` where ``learn`` holds; ``labels`` has doc_id and toxic (1: confirmed).

    The prior is the share of toxic among all labelled rows that may be learned from.  Rows that share an id count as one text to
    learn from.  The classifiers see at most ``FEATURES`` features, a size of the model; all counts cover all rows.
    """
    none = np.zeros((0, 0))
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    rows = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text")
    marked = rows.select("doc_id").join(known, F.col("doc_id") == F.col("_id"), "left")
    tallies = F.count(F.lit(1)).alias("n"), F.count_if(F.col("_toxic") == 1).alias("p"), F.count("_toxic").alias("l")
    seen = marked.agg(*tallies).first()
    prior = min(0.95, max(1e-4, seen.p / seen.l)) if seen.l else 1e-4
    if not seen.p or seen.n <= seen.p:
        return Model([], none, prior)
    dice = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    confirmed, in_u = F.coalesce(F.col("_toxic") == 1, F.lit(False)), dice < min(1.0, unlabelled / seen.n)
    in_p = confirmed & (dice < min(1.0, positives / seen.p))
    # A confirmed text may be drawn into the unlabelled part as well, as it is in the whole corpus.
    picked = marked.where(in_p | in_u).select(F.col("doc_id").alias("_id"), in_p.alias("_p"), in_u.alias("_u")).dropDuplicates(["_id"])
    picked = stored(picked, "toxicity-picked")
    roles = F.array_compact(F.array(F.when(F.col("_p"), F.lit(True)), F.when(F.col("_u"), F.lit(False))))
    # About positives + unlabelled ids, whatever the input: they go to the texts, and the corpus isn't shuffled.
    texts = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).groupBy("_id", "_p", "_u").agg(F.min("text").alias("text"))
    sample = texts.select(F.explode(roles).alias("positive"), "text")
    sample = stored(sample.mapInArrow(_featurise, "positive boolean, features array<long>, worth array<float>"), "toxicity-sample")
    n = sample.agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")).first()
    if not n.p or not n.u:
        return Model([], none, prior)
    with_it, without = F.count_if("positive"), F.count_if(~F.col("positive"))
    share = sample.select("positive", F.explode("features").alias("f")).groupBy("f")
    share = share.agg((with_it / n.p).alias("a"), (without / n.u).alias("b"), with_it.alias("n"))
    # How much more often among the confirmed than among the rest, which is the unlabelled less its hidden positives.
    rest = F.greatest((F.col("b") - prior * F.col("a")) / (1 - prior), F.lit(0.0)) + 1.0 / n.u
    gain = share.where(F.col("n") >= LEAST).withColumn("gain", F.col("a") * F.log(F.col("a") / rest)).where("gain > 0")
    features = [r.f for r in gain.orderBy(F.col("gain").desc(), "f").limit(FEATURES).collect()]
    if not features:
        return Model([], none, prior)
    place = {f: k for k, f in enumerate(features)}
    rows_ = sample.mapInArrow(_densify(place), "positive boolean, x binary").collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows_), np.float32).reshape(len(rows_), len(features))
    is_p = np.array([r.positive for r in rows_])
    order = np.lexsort((x @ np.random.default_rng(1).random(len(features)), is_p))  # the same order whatever the partitions were
    x, is_p = x[order], is_p[order]
    return Model(features, np.stack([train_nnpu(x[is_p], x[~is_p], prior, seed=s) for s in range(MODELS)]), prior)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score in 0..1 as its last column, in place of a column of this name if there is one.

    Null texts score as empty ones; equal texts score alike; repeated rows stay.
    """
    if name == "text":
        raise ValueError("the score can't take the place of the text")
    docs, model.known = docs.drop(name), {}
    schema, at = StructType([*docs.schema.fields, StructField(name, DoubleType())]), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity: ``doc_id, held_out, score, predicted``; learned where crc32(doc_id) mod 5 isn't 0.
    A null id has no remainder: such rows aren't learned from, and count as held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), learn)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return score(docs, model).select("doc_id", (~learn).alias("held_out"), "score", predicted)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns; it may learn from every label."""
    model = fit(docs, table(spark, sf_dir, "labels"), F.col("doc_id").isNotNull())
    return score(docs, model, "__m_toxicity").where("__m_toxicity < 0.5").drop("__m_toxicity")
