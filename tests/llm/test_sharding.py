import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from marginalia.llm import sharding


def test_table_is_full_and_even():
    names = [f"s{k}" for k in range(10)]
    t = sharding.lookup_table(names, 1009)
    n = Counter(t)
    assert len(t) == 1009 and set(n) == set(range(10)) and max(n.values()) - min(n.values()) <= 1


def test_weights_and_small_changes():
    n = Counter(sharding.lookup_table(["a", "b"], 1009, [3, 1]))
    assert abs(n[0] - 3 * n[1]) <= 4
    names = [f"s{k}" for k in range(20)]
    a, b = sharding.lookup_table(names, 4001), sharding.lookup_table(names[:-1], 4001)
    moved = sum(x != y for x, y in zip(a, b) if x != 19)
    assert moved < 0.15 * 4001


def test_bad_tables():
    for args in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 7, [0])):
        with pytest.raises(ValueError):
            sharding.lookup_table(*args)


def test_placement(spark, docs):
    d = docs.withColumn("slot", F.lit("mine"))
    with pytest.raises(ValueError):
        sharding.shard(d, ["doc_id"], ["a", "b"], 101)
    out = sharding.shard(d.unionAll(d), ["doc_id"], ["a", "b"], 101, prefix="at_")
    assert out.columns == [*d.columns, "at_slot", "at_shard"] and out.count() == 2 * d.count()
    assert out.groupBy("doc_id").agg(F.count_distinct("at_shard").alias("n")).where("n > 1").count() == 0
    table = sharding.lookup_table(["a", "b"], 101)
    assert all(table[r.at_slot] == r.at_shard for r in out.collect())
    assert sharding.shard(docs.limit(0), ["doc_id", "source"], ["a"], 7).collect() == []


def test_turns_over_whole_permutations():
    """The fill once more, from permutations written out in full."""
    number = lambda name, salt: int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")
    for names, slots, weights in ((["a", "b", "c"], 31, None), ([f"s{k}" for k in range(9)], 211, [1, 2, 3] * 3), (["x"], 2, None)):
        wanted = [[(number(n, "offset") + i * (number(n, "skip") % (slots - 1) + 1)) % slots for i in range(slots)] for n in names]
        assert all(sorted(p) == list(range(slots)) for p in wanted)
        owner = {}
        while len(owner) < slots:
            for k, p in enumerate(wanted):
                for _ in range((weights or [1] * len(names))[k]):
                    slot = next((s for s in p if s not in owner), None)
                    if slot is not None:
                        owner[slot] = k
        assert sharding.lookup_table(names, slots, weights) == [owner[s] for s in range(slots)]


def test_slots_are_hashes_of_the_key_and_nulls_share_one(spark):
    ids = [0, 1, -5, 2**40, 7, 7, None, None]
    got = sharding.shard(spark.createDataFrame([(i,) for i in ids], "doc_id long"), ["doc_id"], ["a", "b", "c"], 101).collect()
    slot = lambda i: (42 if i is None else int.from_bytes(xxhash.xxh64(i.to_bytes(8, "little", signed=True), seed=42).digest(), "big", signed=True)) % 101
    table = sharding.lookup_table(["a", "b", "c"], 101)
    assert sorted((repr(r.doc_id), r.slot, r.shard) for r in got) == sorted((repr(i), slot(i), table[slot(i)]) for i in ids)
