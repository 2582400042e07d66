"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most r of 64 bits agree in at least two of r + 2 blocks of bits, so each pair of
blocks keys one candidate group: ten keys for a radius of 3.  Inside groups, fingerprints are stored
vertically: plane b holds bit b of 64 fingerprints a machine word.  Distances to many fingerprints
grow together in carry-save counters, and a word of 64 lanes is abandoned once all exceed the radius.
A large group is split into blocks, and pairs of blocks are compared by tasks of their own; each
returns a spanning forest of its links, not all pairs.

The pipeline's stage removes documents that share 0.8 or more of their five-word shingles.  There, bands of least hashes of the
shingle sets key the candidate groups, the same planes and counters find the candidates in a group whose SimHashes are near, and
a pair links once its two shingle sets are joined and their Jaccard similarity is counted.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import maybe, prepared, stored, table
from .components import connected_components

SEED = 42
RADIUS = 3
#: Least Jaccard similarity of two shingle sets that the pipeline's stage links.
SIMILARITY = 0.8
#: Bands of the stage's sketches and least hashes of a band: a pair at 0.8 shares a band with a chance of 1 - (1 - 0.8**5)**25, all
#: but 5 in 100,000.
BANDS, BAND_ROWS = 25, 5
#: Most bits in which the SimHashes of two candidates differ.  Pairs at 0.8 differ in 10 bits on average, or 12 if they have few
#: shingles, with a deviation of 3.
CANDIDATE_RADIUS = 26
#: Candidates that a member of a group has verified pair by pair; groups where some have more are verified as a whole.
TAKE = 8
#: Fingerprints of a block of a large group.
GROUP_BLOCK = 1024
#: Lanes compared at once.
LANES = 512
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes | None, width: int, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of ``width`` words of the lower-cased text; fewer words: of all of them; none: empty."""
    words = text.lower().split() if text else []  # on bytes: A-Z only, and ASCII white space only
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else []
    joined, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[width - 1 :])]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``sizes`` hashes: a bit is 1 if set in over half of the run; 0 for an empty run."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        won = (2 * ones > sizes[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(won, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, fp``: the fingerprint's 64 bits as a signed long.  A null text counts as empty: fingerprint 0."""

    def run(batches):
        for batch in batches:
            texts, prints, hashes, sizes = batch.column(1).cast(pa.binary()), [], [], []
            held = 0
            for t in texts:
                h = shingle_hashes(t.as_py(), width)
                hashes.append(np.array(h, np.uint64))
                sizes.append(len(h))
                held += len(h)
                if held > 200_000:
                    prints.append(majority(np.concatenate(hashes), np.array(sizes)))
                    hashes, sizes, held = [], [], 0
            if sizes:
                prints.append(majority(np.concatenate(hashes), np.array(sizes)))
            fp = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def near_pairs(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs i < j of fingerprints that differ in at most ``radius`` bits."""
    m = len(fps)
    words = -(-m // 64)
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.zeros((words * 64, 64), np.uint8)
    lanes[:m] = bits
    planes = np.packbits(np.ascontiguousarray(lanes.T), axis=1, bitorder="little").view(np.uint64)
    flips = (bits.T * np.uint64(0xFF)).astype(np.uint64) * np.uint64(0x0101010101010101)  # plane b of query i, spread over a word
    # A cell is one query against one word of 64 lanes.  Lanes up to the query itself, and past the end, count as exceeded.
    query, word = np.nonzero(np.arange(words)[None, :] >= (np.arange(m) // 64)[:, None])
    own = query // 64 == word
    upto = (query % 64).astype(np.uint64)
    over = np.where(own, FULL >> (np.uint64(63) - upto), np.uint64(0))
    if m % 64:
        over[word == words - 1] |= FULL << np.uint64(m % 64)
    # The counters start so far up that one bit more than the radius overflows them.
    depth = max(1, radius.bit_length())
    start = (1 << depth) - 1 - radius
    counters = [np.full_like(over, FULL if start >> k & 1 else 0) for k in range(depth)]
    for b in range(64):
        x = planes[b][word] ^ flips[b][query]
        for k, c in enumerate(counters):
            counters[k], x = c ^ x, c & x
        over = over | x  # never to come back
        if b % 8 == 7:
            alive = np.flatnonzero(over != FULL)
            if b < 63 and len(alive) < 0.75 * len(over):
                query, word, over = query[alive], word[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(alive):
                    break
    left = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") if len(over) else np.zeros((0, 64), np.uint8)
    cell, lane = np.nonzero(left)
    return query[cell], word[cell] * 64 + lane


def spanning(i: np.ndarray, j: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its component) that connect what the pairs connect."""
    label = np.arange(m)
    while len(i):
        np.minimum.at(label, j, label[i])
        np.minimum.at(label, i, label[j])
        label = label[label]
        if (label[i] == label[j]).all():
            break
    node = np.flatnonzero(label != np.arange(m))
    return node, label[node]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: edges that connect exactly the fingerprints linked by chains of at most ``radius`` differing bits."""

    edges = [64 * k // (radius + 2) for k in range(radius + 3)]
    width = 64 // (radius + 2) + 1

    def block(k: int) -> Column:
        return F.shiftrightunsigned("fp", edges[k]).bitwiseAND((1 << (edges[k + 1] - edges[k])) - 1)

    pairs = enumerate(combinations(range(radius + 2), 2))
    keys = F.array(*[F.shiftleft(block(x), width).bitwiseOR(block(y)).bitwiseOR(F.lit(n << 2 * width)) for n, (x, y) in pairs])
    probes = distinct.select("fp", F.explode(keys).alias("key"))
    crowds = probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / GROUP_BLOCK).cast("int")
    dealt = probes.join(crowds, "key").withColumn("_parts", parts).withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int"))
    met = dealt.select("key", "fp", "_own", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other"))
    groups = met.groupBy("key", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def compare(batches):
        for batch in batches:
            lists = batch.column(0)
            flat, bounds = lists.flatten().to_numpy().view(np.uint64), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            edges, at = [], 0
            while at < len(lists):
                # Whole groups until there are LANES fingerprints; a link between groups is a link too.
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + LANES, "right")) - 1)
                fps = np.unique(flat[bounds[at] : bounds[to]])
                node, root = spanning(*near_pairs(fps, radius), len(fps))
                edges.append((fps[root], fps[node]))
                at = to
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return groups.select("fps").mapInArrow(compare, "a long, b long")


def near_duplicates(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp`` -> the same rows with ``component_id``, the smallest doc_id reachable over links.

    Equal fingerprints, and so copies, are one node.  A component of null ids only has a null component_id.
    """
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("_least")), "simhash-nodes")
    roots = connected_components(links(nodes.select("fp"), radius), "simhash")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    joined = linked.groupBy("root").agg(F.min("_least").alias("component_id"))
    linked = linked.join(joined, "root").select("fp", "component_id")
    # Fingerprints without a link stay out of the join: as nulls they would all meet in one task.
    classes = linked.unionByName(nodes.join(roots, F.col("fp") == F.col("node"), "left_anti").select("fp", F.col("_least").alias("component_id")))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 3-word-shingle SimHash and class: ``doc_id, fingerprint, component_id``."""
    prints = stored(fingerprints(table(spark, sf_dir, "documents")), "simhash-prints")
    found = near_duplicates(prints)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    return np.unique(np.array(shingle_hashes(text, width), np.uint64))


def set_id(shingles: np.ndarray) -> int:
    """64-bit name of a shingle set, signed."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def multipliers() -> list[np.uint64]:
    """An odd number for each least hash, which permutes the 64-bit hashes: SplitMix64's outputs from ``SEED`` on."""
    out, mask = [], 2**64 - 1
    for k in range(1, BANDS * BAND_ROWS + 1):
        x = (SEED + k * 0x9E3779B97F4A7C15) & mask
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        out.append(np.uint64((x ^ x >> 31) | 1))
    return out


def band_keys(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys of shingle sets laid end to end; sets without a shingle have zeros."""
    out = np.zeros((len(sizes), BANDS), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.cumsum(sizes[some]) - sizes[some]
        for k, factor in enumerate(multipliers()):
            least = np.minimum.reduceat(flat * factor, starts)
            out[some, k // BAND_ROWS] = out[some, k // BAND_ROWS] * np.uint64(0x9E3779B97F4A7C15) + least
        out[some] = out[some] * np.uint64(0xD6E8FEB86659FD93) + np.arange(BANDS, dtype=np.uint64)
    return out


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, node, n, fp, keys``: name and size of the set of a text's shingles, its SimHash, and its candidate keys."""

    def run(batches):
        for batch in batches:
            nodes, sizes, prints, keys, held, n = [], [], [], [], [], 0
            texts = batch.column(1).cast(pa.binary())
            for at, t in enumerate(texts):
                h = shingle_set(t.as_py(), width)
                nodes.append(set_id(h))
                sizes.append(len(h))
                held.append(h)
                n += len(h)
                if n > 200_000 or at == len(texts) - 1:
                    flat, lengths = np.concatenate(held), np.array([len(x) for x in held])
                    prints.append(majority(flat, lengths))
                    keys.append(band_keys(flat, lengths))
                    held, n = [], 0
            fp = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
            bands = np.concatenate(keys) if keys else np.zeros((0, BANDS), np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))
            columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(fp.view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "fp", "keys"])

    schema = "doc_id long, node long, n int, fp long, keys array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


#: Sides of a group's members: pairs are of a left and a right one.
LEFT, RIGHT, BOTH = 1, 2, 3
MEMBER = "node", "n", "fp", "label", "side"


def candidates(group, node, size, fp, label, side, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs inside groups, of a left and a right member, that aren't in one component yet, with near SimHashes and set sizes
    that allow the similarity.  The second of a pair is the one with the larger name."""
    i, j = near_pairs(fp, CANDIDATE_RADIUS)
    low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    met = (group[i] == group[j]) & (label[i] != label[j]) & (low >= similarity * high - 1e-6)
    met &= ((side[i] & LEFT) & (side[j] & RIGHT) >> 1 | (side[i] & RIGHT) >> 1 & (side[j] & LEFT)) > 0
    i, j = i[met], j[met]
    return np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)


def proposed(groups: DataFrame, similarity: float) -> DataFrame:
    """``gid, g`` -> ``(gid, a, b, side)``: candidate pairs of nodes, each member's ``TAKE`` nearest among those before it in order of
    names.  Where a group has more of them, rows with a null ``b`` name its members and their sides."""

    def compare(batches):
        for batch in batches:
            gids, lists = batch.column(0).to_numpy(), batch.column(1)
            members, bounds = lists.flatten(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            columns = dict(zip(MEMBER, (members.field(k).to_numpy() for k in range(len(MEMBER)))))
            out, at = [], 0
            while at < len(lists):
                # Whole groups until there are LANES members.
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + LANES, "right")) - 1)
                group = np.repeat(np.arange(at, to), np.diff(bounds[at : to + 1]))
                node, size, fp, label, side = (columns[c][bounds[at] : bounds[to]] for c in MEMBER)
                fp = fp.view(np.uint64)
                i, j = candidates(group, node, size, fp, label, side, similarity)
                order = np.lexsort((node[i], np.bitwise_count(fp[i] ^ fp[j]), j))
                i, j = i[order], j[order]
                now = np.arange(len(j)) - np.searchsorted(j, j) < TAKE
                whole = np.isin(group, group[j[~now]])
                now &= ~whole[j]
                out.append((gids[group[i[now]]], node[i[now]], node[j[now]], np.zeros(now.sum(), np.int32), np.zeros(now.sum(), bool)))
                out.append((gids[group[whole]], node[whole], node[whole], side[whole], np.ones(whole.sum(), bool)))
                at = to
            gid, a, b, side, more = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4 + (np.zeros(0, bool),)
            columns = [pa.array(gid, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64(), mask=more), pa.array(side, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["gid", "a", "b", "side"])

    return groups.mapInArrow(compare, "gid long, a long, b long, side int")


def similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sets of each index pair have at least this Jaccard similarity."""
    sizes = np.array([len(x) for x in sets])
    kinds, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = times[code] > 1  # what only one set has is in no intersection
    code, owner = np.unique(code[shared], return_inverse=True)[1], owner[shared]
    kinds = int(code.max(initial=-1)) + 1
    if 2.0 * len(sets) ** 2 * kinds < 3e5 * len(i):  # by a matrix product where that is cheaper than pair by pair
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(code, kind="stable")
        for at in range(0, kinds, 4096):
            low, high = np.searchsorted(code[order], (at, at + 4096))
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[order[low:high]], code[order[low:high]] - at] = 1
            common += part @ part.T
        common = common[i, j].astype(np.int64)
    else:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    return common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9


def _whole_groups(similarity: float):
    """Links of one group's members ``gid, node, n, fp, label, side, _set``: a spanning forest of all that its candidates link."""

    def links(rows: pa.Table) -> pa.Table:
        node, size, fp, label, side = (rows.column(c).to_numpy() for c in MEMBER)
        sets = [x.values.to_numpy().view(np.uint64) for x in rows.column("_set")]
        i, j = candidates(np.zeros(len(node)), node, size, fp.view(np.uint64), label, side, similarity)
        good = similar(sets, i, j, similarity) if len(i) else np.zeros(0, bool)
        at, root = spanning(np.minimum(i[good], j[good]), np.maximum(i[good], j[good]), len(node))
        return pa.table({"a": pa.array(node[at], pa.int64()), "b": pa.array(node[root], pa.int64())})

    return links


class Links:
    """Verified links, and the component of every node they reach."""

    def __init__(self, nodes: DataFrame, docs: DataFrame, width: int, similarity: float):
        self.nodes, self.docs, self.width, self.similarity = nodes, docs, width, similarity
        self.edges = self.roots = None

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``_id, _set`` of the nodes wanted, from one text each."""
        width = self.width

        def run(batches):
            for batch in batches:
                sets = [shingle_set(t.as_py(), width) for t in batch.column(0).cast(pa.binary())]
                bounds = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), lists], names=["_id", "_set"])

        wanted = stored(wanted.distinct().join(self.nodes.select("node", "_least"), "node"), "simhash-wanted")
        asked = wanted.select(F.col("_least").alias("_id")).distinct()
        texts = maybe(self.docs.select("doc_id", "text"), "doc_id", asked).join(asked, F.col("doc_id") == F.col("_id")).select("text")
        sets = texts.mapInArrow(run, "_id long, _set array<long>").join(wanted, F.col("_id") == F.col("node"), "left_semi")
        return stored(sets.groupBy("_id").agg(F.any_value("_set").alias("_set")), "simhash-sets")

    def pairs(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs ``(a, b)`` of nodes, those whose shingle sets are similar."""
        similarity = self.similarity

        def compare(batches):
            for batch in batches:
                sets = [x.values.to_numpy() for c in (2, 3) for x in batch.column(c)]
                n = len(batch)
                good = [similar([sets[k], sets[n + k]], np.array([0]), np.array([1]), similarity)[0] for k in range(n)]
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        left, right = (sets.select(F.col("_id").alias(c), F.col("_set").alias(f"_{c}")) for c in ("a", "b"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b").mapInArrow(compare, "a long, b long")

    def add(self, edges: DataFrame) -> None:
        edges = stored(edges, "simhash-verified")
        self.edges = edges if self.edges is None else self.edges.unionByName(edges)
        self.roots = connected_components(self.edges, "simhash")

    def work_off(self, groups: DataFrame) -> None:
        """Link all that the candidates of groups link: pair by pair, and the groups with many candidates each in a task of its own,
        with the sets of its members, which are two blocks at most.  No pairs leave such a task but those of a spanning forest."""
        found = stored(proposed(groups, self.similarity), "simhash-proposed")
        pairs = stored(found.where("b is not null").select("a", "b").distinct(), "simhash-pairs")
        if self.roots is None or pairs.head(1):
            self.add(self.pairs(pairs))
        more = found.where("b is null").select("gid", F.col("a").alias("node"), "side")
        if more.head(1):
            members = self.labelled(more.join(self.nodes.select("node", "n", "fp"), "node"))
            members = members.join(self.sets(more.select("node")), F.col("node") == F.col("_id")).drop("_id")
            self.add(members.groupBy("gid").applyInArrow(_whole_groups(self.similarity), "a long, b long"))

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of their ``node``."""
        roots = self.roots.withColumnRenamed("node", "_node")
        return rows.join(roots, F.col("node") == F.col("_node"), "left").withColumn("label", F.coalesce("root", "node")).drop("root", "_node")


def gathered(members: DataFrame, *by: str) -> DataFrame:
    """``gid, g`` of groups with two members or more."""
    groups = members.groupBy(*by).agg(F.collect_list(F.struct(*MEMBER)).alias("g")).where(F.size("g") > 1)
    return groups.select(F.xxhash64(*by).alias("gid"), "g")


def similar_sets(prints: DataFrame, docs: DataFrame, width: int, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, component_id``: the smallest doc_id reachable over verified links.

    Equal shingle sets are one node.  A large group is dealt into blocks that are worked off first.  Then only members outside
    the group's largest component still have to meet the rest of it, so a group of near copies costs no square of its
    size, and no candidate between components is left out.
    """
    one = F.min("doc_id").alias("_least"), *[F.any_value(c).alias(c) for c in ("n", "fp", "keys")]
    nodes = stored(prints.groupBy("node").agg(*one), "simhash-nodes")
    probes = nodes.where("n > 0").select("node", "n", "fp", F.explode("keys").alias("key"))
    crowds = nodes.where("n > 0").select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_n") / GROUP_BLOCK).cast("int")
    met = probes.join(crowds, "key").withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int"))
    met = stored(met.drop("_n"), "simhash-met")
    links = Links(nodes, docs, width, similarity)
    links.work_off(gathered(met.withColumns({"label": F.col("node"), "side": F.lit(BOTH)}), "key", "own"))
    large = met.where("parts > 1")
    if large.head(1):
        large = stored(links.labelled(large), "simhash-large")
        most = large.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("most"))
        outside = large.join(most, "key").where("label <> most").drop("most")
        blocks = outside.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("blocks"))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = outside.join(blocks, "key").withColumn("i", F.pmod(F.xxhash64("key", "node"), F.col("blocks")).cast("int"))
        left = left.withColumn("j", every("parts")).withColumn("side", F.lit(LEFT))
        right = large.join(blocks, "key").withColumn("i", every("blocks")).withColumn("j", F.col("own")).withColumn("side", F.lit(RIGHT))
        columns = ["key", "i", "j", *MEMBER]
        links.work_off(gathered(left.select(*columns).unionByName(right.select(*columns)), "key", "i", "j"))
    roots = links.roots
    linked = nodes.select("node", "_least").join(roots, "node")
    joined = linked.groupBy("root").agg(F.min("_least").alias("component_id"))
    linked = linked.join(joined, "root").select("node", "component_id")
    # Nodes without a link stay out of the join: as nulls they would all meet in one task.
    alone = nodes.join(roots.select("node"), "node", "left_anti").select("node", F.col("_least").alias("component_id"))
    return prints.select("doc_id", "node").join(linked.unionByName(alone), "node").select("doc_id", "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, width: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id, with all its columns.

    Documents link whose sets of shingles of ``width`` words have at least this Jaccard similarity; texts without a word are one group.
    Rows without an id can't be told apart, so all of them stay and link nothing.  Where several rows carry the id that stays, one
    of them is kept.
    """
    prepared(spark)
    named = docs.where("doc_id is not null")
    prints = stored(sketches(named, width), "simhash-stage-prints")
    keep = similar_sets(prints, named, width, similarity).where("doc_id = component_id")
    keep = keep.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__m_rows"))
    keep = stored(keep.withColumnRenamed("doc_id", "__m_id"), "simhash-stage-keep")
    # As many rows as documents: never broadcast, so that the plan is the same at every size.
    kept = docs.join(keep.hint("merge"), F.col("doc_id") == F.col("__m_id"))
    once = kept.where("__m_rows = 1").select(*docs.columns)
    several = kept.where("__m_rows > 1").select(*docs.columns).dropDuplicates(["doc_id"])
    return once.unionByName(several).unionByName(docs.where("doc_id is null"))
