"""LM scoring with a weighted backoff automaton whose n-grams never leave the cluster.

The model is an interpolated n-gram model.  With c the counts over the training documents,

    p(w)      = (c(w) - D) / N for a known word, D V / N for the one class of unknown words   (D: absolute discount)
    p(w | h)  = (c(h w) + k p(w | h')) / (c(h) + k),   h' = h without its first word           (k: prior strength)

As an automaton: a known n-gram h is a state; h -> h w is an arc of weight log10 p(w | h) where h w was seen; else
the failure arc of h, of weight log10(k / (c(h) + k)), leads to the state of h'.  The root has an arc for each known
word and one for all unknown ones, so every walk goes on.

The counts of all n-grams of the corpus can't be held by a task.  So documents stay in chunks (parts of the scan's
partitions); a chunk sends its distinct n-grams, sorted, to ranges of the hash space; each range adds up the training
counts of all chunks and answers every chunk in the order it asked.  From the answers a chunk builds just the part of the
automaton its own documents can walk, which gives the same scores as the whole, and walks each of them once, from left
to right.  N-grams are known by 64-bit hashes.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, stored, table

ORDER = 2
PRIOR = 50.0
ADD = 0.1  # of the base model
#: Bytes of text of a chunk, and bytes of text that one range of the hash space answers for.
CHUNK_BYTES = 6 << 20
RANGE_BYTES = 12 << 20
#: Bytes of text hashed at once.
SLICE = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)  # an odd number for each byte
_CODE[65:91] = _CODE[97:123]  # A-Z count as a-z

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        x = np.full(max(n, SLICE), base, np.uint64)
        x[0] = 1
        _powers[base] = np.multiply.accumulate(x)
    return _powers[base][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of texts laid end to end, and the number of words of each text (from ``starts``).

    Hashes of all prefixes come from one running sum, so a word's hash is a difference: no loop over words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    gap = _SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[starts[starts < n]] = True
    cut[n] = True
    before = np.concatenate(([True], gap[:-1])) | cut[:n]
    after = np.concatenate((gap[1:], [True])) | cut[1:]
    first, last = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODE[data] * _power(_BASE, n), dtype=np.uint64)))
    h = (total[last + 1] - total[first]) * _power(_INVERSE, n)[first]
    return _mix(h + (last - first + 1).astype(np.uint64)), np.diff(np.append(np.searchsorted(first, starts), len(first)))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and one end, and the number of tokens of each text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    found, counts, at = [], [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        h, n = word_hashes(data[offsets[at] : offsets[to]], offsets[at:to] - offsets[at])
        found.append(h)
        counts.append(n)
        at = to
    words, sizes = (np.concatenate(found), np.concatenate(counts)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    out = np.full(len(words) + len(sizes), END)
    ends = np.cumsum(sizes + 1) - 1
    kept = np.ones(len(out), bool)
    kept[ends] = False
    out[kept] = words
    return out, sizes + 1


def ngrams(words: np.ndarray, sizes: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length 1..order: the hash of the n-gram that ends at each token, and whether there is one.

    A document begins with one begin mark, so n-grams reach back to it and no further.
    """
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(words)) - np.repeat(starts, sizes)
    out = [(words, np.ones(len(words), bool))]
    for m in range(2, order + 1):
        context = np.concatenate((np.full(1, BEGIN), out[-1][0][:-1]))
        if m == 2:
            context[starts] = BEGIN
        out.append((_mix(context * np.uint64(0xD6E8FEB86659FD93) + words + np.uint64(m)), place >= m - 2))
    return out


def _chunked(docs: DataFrame, key: str, text: str, train: Column) -> tuple[DataFrame, int]:
    """Rows with their chunk (a part of the scan's partition, chosen by the row's own values), and the number of hash ranges."""
    seen = docs.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length(F.col(text))).alias("b")).agg(F.max("b"), F.sum("b")).first()
    split = max(1, -(-(seen[0] or 0) // CHUNK_BYTES))
    ranges = 1 << max(0, ((seen[1] or 0) // RANGE_BYTES).bit_length())
    chunk = F.spark_partition_id() * split + F.pmod(F.xxhash64(F.col(key), F.octet_length(F.col(text))), F.lit(split)).cast("int")
    return docs.select(chunk.alias("chunk"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train")), ranges


def _asker(order: int, ranges: int):
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def ask(batches):
        held: dict[int, list] = {}
        for batch in batches:
            chunk, train = batch.column(0).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            for c in np.unique(chunk):
                mine = chunk == c
                words, sizes = tokens(batch.column(2).filter(pa.array(mine)))
                held.setdefault(int(c), []).append((words, sizes, train[mine]))
        for c, parts in held.items():
            words, sizes, train = (np.concatenate(x) for x in zip(*parts))
            learn = np.repeat(train, sizes)
            for m, (grams, there) in enumerate(ngrams(words, sizes, order), 1):
                taught, counts = np.unique(grams[there & learn], return_counts=True)
                keys = np.union1d(taught, grams[there & ~learn])
                known = np.zeros(len(keys), np.int32)
                known[np.searchsorted(keys, taught)] = counts
                part = (keys >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(keys), np.int64)
                bounds = np.searchsorted(part, np.arange(ranges + 1))
                some = np.flatnonzero(np.diff(bounds))
                for r in some:
                    a, b = bounds[r], bounds[r + 1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([m], pa.int32()), pa.array([r], pa.int32()), pa.array([c], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(keys[a:b].view(np.int64))), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(known[a:b])),
                    ], names=["m", "range", "chunk", "keys", "counts"])
            held[c] = None

    return ask


def _answer(asked: pa.Table) -> pa.Table:
    """Total counts of one range of n-grams, for each chunk in the order of its keys; and, for words, a row of tallies (chunk -1)."""
    m, r = asked.column("m")[0].as_py(), asked.column("range")[0].as_py()
    asked = asked.combine_chunks()
    lists, counts = asked.column("keys").combine_chunks(), asked.column("counts").combine_chunks()
    flat, sizes = lists.flatten().to_numpy().view(np.uint64), np.diff(np.asarray(lists.offsets))
    keys, place = np.unique(flat, return_inverse=True)
    totals = np.bincount(place, counts.flatten().to_numpy(), len(keys)).astype(np.int64)
    answer, chunks = totals[place], asked.column("chunk").to_numpy()
    if m == 1:
        answer = np.append(answer, [totals.sum(), np.count_nonzero(totals), np.count_nonzero(totals == 1), np.count_nonzero(totals == 2)])
        sizes, chunks = np.append(sizes, 4), np.append(chunks, -1)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    n = len(chunks)
    return pa.table({"m": pa.array([m] * n, pa.int32()), "range": pa.array([r] * n, pa.int32()), "chunk": pa.array(chunks.astype(np.int32)), "totals": pa.ListArray.from_arrays(offsets, pa.array(answer))})


class Automaton:
    """The part of the model that one chunk's texts can walk, from the counts of its own n-grams.

    State 0 is the root and the last one the begin mark; the others are the known n-grams shorter than ``order``.  An arc
    is known by ``state * width + word``, where word 0 stands for all unknown ones.
    """

    def __init__(self, words, sizes, counts: list[np.ndarray], order: int, prior: float, documents: int, word_weights: np.ndarray):
        starts = np.cumsum(sizes) - sizes
        keys, targets, weights, fails, fail_weights = [], [], [], [np.zeros(1, np.int64)], [np.zeros(1)]
        states, below = 1, None
        for m, (grams, there) in enumerate(ngrams(words, sizes, order), 1):
            at = np.flatnonzero(there)
            _, first, place = np.unique(grams[there], return_index=True, return_inverse=True)
            first, count = at[first], counts[m - 1]
            if len(count) != len(first):
                raise RuntimeError("the input was dealt out differently the second time; store it before scoring")
            known = np.flatnonzero(count)
            if m == 1:
                lower = np.zeros(len(count), np.int64)
                self.width = len(known) + 1
                kinds = np.zeros(len(count), np.int64)
                kinds[known] = np.arange(1, self.width)
                self.words = kinds[place]
                keys += [np.zeros(1, np.int64), kinds[known]]
                weight = word_weights(count)
                weights += [word_weights(np.zeros(1, np.int64)), weight[known]]
            else:
                lower, lower_weight = below[0][first], below[1][first]
                # The context is known where the n-gram is; a mere begin mark counts the documents.
                source, seen = below[0][first - 1], below[2][first - 1]
                if m == 2:
                    begins = np.isin(first, starts)
                    source, seen = np.where(begins, -1, source), np.where(begins, documents, seen)
                weight = np.log10((count + prior * 10**lower_weight) / (seen + prior))
                keys.append(source[known] * self.width + self.words[first[known]])
                weights.append(weight[known])
            # A known n-gram is a state of its own, or at full length that of its last words, and so is an unknown one.
            state = lower.copy()
            if m < order:
                state[known] = np.arange(states, states + len(known))
                states += len(known)
                fails.append(lower[known])
                fail_weights.append(np.log10(prior / (count[known] + prior)))
            targets += [np.zeros(1, np.int64), state[known]] if m == 1 else [state[known]]
            full = [np.zeros(len(words), x.dtype) for x in (state, weight, count)]
            for x, y in zip(full, (state, weight, count)):
                x[at] = y[place]
            below = full
        self.begin = states if documents and order > 1 else 0
        fails.append(np.zeros(1, np.int64))
        fail_weights.append(np.log10([prior / (documents + prior)]))
        joined = np.concatenate(keys)
        joined[joined < 0] += (states + 1) * self.width  # arcs of the begin mark, written as state -1 so far
        self.arcs = dict(zip(joined.tolist(), range(len(joined))))
        self.targets, self.weights = array("q", np.concatenate(targets).tobytes()), array("d", np.concatenate(weights).tobytes())
        self.fails, self.fail_weights = array("q", np.concatenate(fails).tobytes()), array("d", np.concatenate(fail_weights).tobytes())

    def walk(self, words: list[int]) -> float:
        """log10 probability of one text: left to right, the state carried on, failure arcs followed until a word has an arc."""
        arcs, targets, weights, fails, fail_weights, width = self.arcs, self.targets, self.weights, self.fails, self.fail_weights, self.width
        state, total = self.begin, 0.0
        for word in words:
            arc = arcs.get(state * width + word)
            while arc is None:
                total += fail_weights[state]
                state = fails[state]
                arc = arcs.get(state * width + word)
            total += weights[arc]
            state = targets[arc]
        return total


def _scorer(order: int, prior: float, stats: dict):
    n_train, kinds, documents = stats["tokens"], stats["words"], stats["documents"]
    twice = stats["once"] + 2 * stats["twice"]
    discount = min(0.9, max(0.1, stats["once"] / twice)) if twice else 0.5

    def word_weights(c: np.ndarray) -> np.ndarray:
        return np.log10(np.where(c > 0, c - discount, discount * kinds) / n_train) if n_train else np.zeros(len(c))

    def score(answers: pa.Table, docs: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        words, sizes = tokens(docs.column("text").combine_chunks() if isinstance(docs.column("text"), pa.ChunkedArray) else docs.column("text"))
        starts = np.cumsum(sizes) - sizes
        parts: list[list] = [[] for _ in range(order)]
        for row in range(len(answers)):
            parts[answers.column("m")[row].as_py() - 1].append((answers.column("range")[row].as_py(), answers.column("totals")[row].values.to_numpy()))
        counts = [np.concatenate([t for _, t in sorted(p, key=lambda x: x[0])] or [np.zeros(0, np.int64)]) for p in parts]
        model = Automaton(words, sizes, counts, order, prior, documents, word_weights)
        log = [model.walk(model.words[a : a + n].tolist()) for a, n in zip(starts.tolist(), sizes.tolist())]
        count = counts[0][np.unique(words, return_inverse=True)[1]]
        base = np.log10((count + ADD) / (n_train + ADD * (kinds + 1)))
        total = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        n = len(docs)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": pa.array(~docs.column("train").to_numpy()), "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(total((count > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array([n_train] * n, pa.int64()),
            "base_score": pa.array(total(base), pa.float64()), "score": pa.array(log, pa.float64()),
        })

    return score


def score_corpus(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """Score every text under a model of the rows where ``train`` (a boolean column) holds.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10).  ``docs`` must be a stored table: its
    partitions are read twice.  A null text is empty, one end token; a null ``train`` (of a null id) is false, and so held out; equal texts get equal
    scores; without training rows every probability is 1; an empty table gives no rows.
    """
    rows, ranges = _chunked(docs, key, text, train)
    asked = rows.mapInArrow(_asker(order, ranges), "m int, range int, chunk int, keys array<long>, counts array<int>")
    answers = stored(asked.groupBy("m", "range").applyInArrow(_answer, "m int, range int, chunk int, totals array<long>"), "lm-counts")
    t = F.col("totals")
    found = answers.where("chunk = -1").agg(*[F.coalesce(F.sum(t[i]), F.lit(0)).alias(n) for i, n in enumerate(("tokens", "words", "once", "twice"))]).first().asDict()
    found["documents"] = docs.where(F.coalesce(train, F.lit(False))).count()
    scored = answers.where("chunk >= 0").groupBy("chunk").cogroup(rows.groupBy("chunk"))
    return scored.applyInArrow(_scorer(order, prior, found), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under a bigram model of those whose crc32(doc_id) mod 10 isn't 0."""
    return score_corpus(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 10) != 0)
