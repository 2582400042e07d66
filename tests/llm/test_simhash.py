import random

import numpy as np
import pytest
import xxhash

from marginalia.llm import simhash
from marginalia.llm.components import connected_components

from .conftest import DOCS


def fingerprint(text, width):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius=3):
    """doc -> smallest doc reachable, by comparing all pairs."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_and_components(docs, corpus):
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(simhash.fingerprints(docs)).collect()}
    want = {r[0]: fingerprint(r[1], 3) for r in corpus}
    assert {k: v[0] for k, v in got.items()} == want
    assert {k: v[1] for k, v in got.items()} == classes(want)


def test_all_pairs_within_the_radius_are_found():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce([np.uint64(1) << np.uint64(b) for b in rng.choice(64, n, replace=False)]) if n else np.uint64(0) for n in rng.integers(0, 10, 400)]
    fps = base[rng.integers(0, 40, 400)] ^ np.array(flips, np.uint64)
    for radius in range(8):
        i, j = simhash.near_pairs(fps, radius)
        want = {(a, b) for a in range(400) for b in range(a + 1, 400) if int(fps[a] ^ fps[b]).bit_count() <= radius}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_large_groups_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_BLOCK", 8)
    monkeypatch.setattr(simhash, "LANES", 16)
    rng = random.Random(2)
    prints = {0: 2**63}
    for k in range(1, 150):
        prints[k] = prints[rng.randrange(k)] ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40))
    df = spark.createDataFrame([(k, v - 2**64 if v >= 2**63 else v) for k, v in prints.items()], "doc_id long, fp long")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()} == classes(prints)
    rng = np.random.default_rng(9)
    sparse = {k: int(v) for k, v in enumerate(rng.integers(0, 2**64, 6, dtype=np.uint64))}
    for k in range(6, 120):
        sparse[k] = sparse[int(rng.integers(0, k))] ^ int(np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, int(rng.integers(4, 9)), replace=False).astype(np.uint64)))
    df = spark.createDataFrame([(k, v - 2**64 if v >= 2**63 else v) for k, v in sparse.items()], "doc_id long, fp long")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df, 6).collect()} == classes(sparse, 6)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300) if k % 50 != 49], "a long, b long")
    roots = {}
    for r in connected_components(edges).collect():
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(min, roots.values())) == [0, 50, 100, 150, 200, 250]


def test_stage_keeps_one_of_each_group(spark, docs):
    out = simhash.simhash_stage(spark, docs, "")
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    # all empty texts are one group; copies 100..109 go, their originals stay
    assert len(ids) == len(set(ids)) and set(range(80)) <= set(ids) and not set(ids) & set(range(100, 110))
    assert len({80, 81, 82} & set(ids)) == 1


def test_stage_with_repeated_rows_null_ids_and_none(spark):
    d = spark.createDataFrame([(5, "a b c d e f", None, None, None)] * 3 + [(None, "x", None, None, None)] * 2, DOCS)
    assert sorted(r.doc_id or -1 for r in simhash.simhash_stage(spark, d, "").collect()) == [-1, -1, 5]
    assert simhash.simhash_stage(spark, d.limit(0), "").collect() == []


def similar(a, b):
    """Jaccard similarity of the five-word shingles."""
    x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def changed(rng, text, n):
    w = text.split()
    for k in rng.sample(range(len(w) // 6), n):
        w[6 * k + 3] += "x"
    return " ".join(w)


def test_stage_links_at_similarity_and_nothing_below(spark):
    rng = random.Random(8)
    rows, near, far = [], set(), set()
    for k in range(120):
        text = " ".join(f"w{rng.randrange(5000)}" for _ in range(200))
        rows.append((k, text, "en", "s", 0))
        other = changed(rng, text, 3 if k % 2 else 6)
        rows.append((1000 + k, other, "en", "s", 0))
        (near if similar(text, other) >= 0.8 else far).add(1000 + k)
    assert len(near) == len(far) == 60
    kept = {r.doc_id for r in simhash.simhash_stage(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert far <= kept and set(range(120)) <= kept and not near & kept


def components(texts):
    """The least key of every text's component, by comparing all pairs."""
    parent = dict.fromkeys(texts)
    for start in texts:
        if parent[start] is None:
            parent[start], todo = start, [start]
            while todo:
                x = todo.pop()
                for y in texts:
                    if parent[y] is None and similar(texts[x], texts[y]) >= 0.8:
                        parent[y] = start
                        todo.append(y)
    return parent


@pytest.mark.parametrize(("block", "take"), [(1024, 1), (5, 1), (5, 99)])
def test_stage_works_off_groups_with_many_candidates(spark, monkeypatch, block, take):
    monkeypatch.setattr(simhash, "TAKE", take)
    monkeypatch.setattr(simhash, "GROUP_BLOCK", block)
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(240)) for _ in range(2)]
    texts = {k: changed(rng, base[k % 7 == 3], 1 + k % 4) for k in range(44)}
    docs = spark.createDataFrame([(k, v, "en", "s", 0) for k, v in texts.items()], DOCS)
    got = simhash.similar_sets(simhash.sketches(docs, 5).cache(), docs, 5).collect()
    assert {r.doc_id: r.component_id for r in got} == components(texts)
    kept = simhash.simhash_stage(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == set(components(texts).values())


def test_sketches_of_sets(spark):
    rng = np.random.default_rng(6)
    sets = [rng.integers(0, 2**64, n, dtype=np.uint64) for n in (1, 7, 0, 40, 3)]
    got = simhash.band_keys(np.concatenate(sets), np.array([len(x) for x in sets]))
    top, factors = 2**64, [int(m) for m in simhash.multipliers()]
    assert len(set(factors)) == simhash.BANDS * simhash.BAND_ROWS and all(m % 2 for m in factors)
    for row, x in zip(got, sets):
        for band in range(simhash.BANDS):
            h = 0
            for m in factors[band * simhash.BAND_ROWS : (band + 1) * simhash.BAND_ROWS]:
                h = (h * 0x9E3779B97F4A7C15 + min(int(v) * m % top for v in x)) % top if len(x) else 0
            assert int(row[band]) == ((h * 0xD6E8FEB86659FD93 + band) % top if len(x) else 0)


def test_similarity_of_sets_either_way():
    rng = np.random.default_rng(3)
    for n, high in ((4, 30), (40, 60), (40, 10**6)):
        sets = [np.unique(rng.integers(0, high, rng.integers(1, 50)).astype(np.uint64)) for _ in range(n)]
        i, j = np.triu_indices(n, 1)
        want = [len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= 0.4 for a, b in zip(i, j)]
        assert simhash.similar(sets, i, j, 0.4).tolist() == want
        assert [simhash.similar([sets[a], sets[b]], np.array([0]), np.array([1]), 0.4)[0] for a, b in zip(i, j)] == want
