import duckdb
import pytest
from pyspark.sql import functions as F

from marginalia.llm import mixing
from marginalia.llm.common import word_count


def run(d):
    return mixing.mix(d, word_count(F.col("text")))


def test_same_as_sql(spark, corpus, docs):
    con = duckdb.connect()
    documents = docs.toPandas().astype({"text": object, "source": object})
    con.register("raw", documents)
    columns = ["CAST(doc_id AS BIGINT) AS doc_id", *(f"CAST({c} AS VARCHAR) AS {c}" for c in ("text", "source"))]
    con.sql(f"CREATE VIEW documents AS SELECT {', '.join(columns)} FROM raw")
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    want = sorted(con.sql(mixing.OP2_SQL).project(", ".join(cols)).fetchall())
    got = sorted(tuple(r[c] for c in cols) for r in run(docs).collect())
    assert got == want


def test_targets_stop_at_three_times_a_source(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), ("c", 100), (None, 7)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 3 and sum(got.values()) == pytest.approx(208)
    assert got[None] == 21 and got["b"] / got["c"] == pytest.approx(2)


def test_buckets_and_ranges_change_nothing(docs, monkeypatch):
    want = sorted(map(tuple, run(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 5)
    assert sorted(map(tuple, run(docs).collect()), key=str) == want


def test_taken_is_near_the_target_and_bounded(docs):
    rows = run(docs).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)


def test_empty_and_repeated(spark, docs):
    assert run(docs.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a b c", None, None, None)] * 4 + [(None, None, None, "s", None)], docs.schema)
    got = run(twice).collect()
    assert len(got) == 5 and sum(r.taken for r in got) == 12


def test_stage_repeats_documents_and_keeps_columns(spark, docs):
    d = docs.withColumn("_copies", F.lit("mine"))
    out = mixing.mixing_stage(spark, d, "")
    assert out.columns == d.columns
    want = {r.doc_id: r.copies for r in run(docs).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def test_the_stage_takes_what_the_mix_takes_of_repeated_rows(spark, docs):
    d = docs.unionByName(docs.where("doc_id < 20")).unionByName(docs.where("doc_id < 9"))
    mixed = run(d).groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).where("n > 0")
    want = {(r.doc_id, r.source): r.n for r in mixed.collect()}
    got = {(r.doc_id, r.source): r["count"] for r in mixing.mixing_stage(spark, d, "").groupBy("doc_id", "source").count().collect()}
    assert got == want


def plain_mix(rows):
    """Finish times of all copies in one list, sorted and cut: {(doc_id, copies)} for rows (doc_id, source, size) without nulls."""
    import hashlib

    names = sorted({s for _, s, _ in rows})
    total = {s: sum(n for _, t, n in rows if t == s) for s in names}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(total.values()))
    while free:  # whoever is over its cap gets the cap; the rest share what is left
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * total[s]]
        for s in over or list(free):
            target[s] = 3 * total[s] if over else weight[s] * level
            left -= target[s]
            free.discard(s)
    tickets = []
    for s in names:
        flow = sorted((hashlib.md5(f"{d}:{n}".encode()).hexdigest(), d, n) for d, t, n in rows if t == s)
        for copy in range(3):
            at = copy * total[s]
            for h, d, n in flow:
                at += n
                if n:
                    tickets.append(((at - n / 2) / target[s], s, h, d, n))
    got, run = dict.fromkeys((d for d, _, _ in rows), 0), 0
    for _, _, _, d, n in sorted(tickets):
        run += n
        if run > sum(total.values()):
            break
        got[d] += 1
    return got


def test_same_as_one_sorted_list(spark, docs):
    named = docs.where("doc_id is not null and source is not null")
    rows = [(r.doc_id, r.source, r.size) for r in run(named).collect()]
    sized = {d for d, _, n in rows if n}
    want = {d: c for d, c in plain_mix(rows).items() if d in sized}
    assert {r.doc_id: r.copies for r in run(named).where("size > 0").collect()} == want
