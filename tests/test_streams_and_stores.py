import pytest
from pyspark.sql import functions as F

from marginalia.sources.store import ResultStore, stored_rows
from marginalia.streaming import queue

LOG = "id long, ts long, seq long, action string"


def feed(spark, tmp_path, number, rows):
    """One more file of the log, and the stream run until it is read."""
    log, out = str(tmp_path / "log"), str(tmp_path / "changes")
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").json(log)
    stream = spark.readStream.schema(LOG).json(log)
    queue.start_change_feed(stream, out, str(tmp_path / "checkpoint"), once=True).awaitTermination(120)
    return sorted((r.id, r.action, r.state, r.was) for r in spark.read.parquet(f"{out}/batch={number}").collect())


def test_a_key_appears_when_its_state_changes(spark, tmp_path):
    assert feed(spark, tmp_path, 0, [(1, 10, 1, "approve"), (1, 5, 2, "reject"), (2, 1, 3, "odd"), (3, None, 4, "reject")]) == [
        (1, "approve", "approved", None), (2, "odd", "proposed", None), (3, "reject", "rejected", None),
    ]
    # An equal state, an older record and a record seen again change nothing.
    assert feed(spark, tmp_path, 1, [(1, 11, 5, "amend"), (2, 0, 6, "reject"), (3, None, 4, "reject")]) == []
    assert feed(spark, tmp_path, 2, [(1, 12, 7, "reject"), (3, 1, 1, "approve"), (4, 2**53 + 1, 1, "withdraw"), (4, 2**53, 9, "approve"), (5, 1, 1, None)]) == [
        (1, "reject", "rejected", "approved"), (3, "approve", "approved", "rejected"), (4, "withdraw", "withdrawn", None), (5, None, "proposed", None),
    ]


def test_a_replayed_batch_of_labels_changes_nothing(spark, tmp_path):
    sink = queue.LabelSink(str(tmp_path / "labels"), "k", "label")
    batch = lambda *rows: spark.createDataFrame(rows, "k long, label string, at long")
    labels = lambda: {r.k: r.label for r in sink.labels(spark).collect()}
    assert labels() == {}
    sink(batch((1, "a", 1), (1, "b", 2), (2, "c+d", 1), (None, "x", 1), (3, None, 1)), 0)
    assert labels() == {1: "b", 2: "c+d"}
    sink(batch((1, "b", 1), (2, "c", 1), (4, "e", 1)), 1)  # same, refused, new
    assert labels() == {1: "b", 2: "c+d", 4: "e"}
    assert [(r.k, r.outcome) for r in spark.read.parquet(f"{sink.root}/batch=1").collect()] == [(4, "new")]
    sink(batch((4, "f", 1), (2, "g+h", 1)), 2)
    for number, rows in ((1, [(1, "b", 1), (2, "c", 1), (4, "e", 1)]), (2, [(4, "f", 1), (2, "g+h", 1)])):
        sink(batch(*rows), number)
        assert labels() == {1: "b", 2: "g+h", 4: "f"}
    forced = queue.LabelSink(sink.root, "k", "label", force=True)
    forced(batch((2, "single", 1)), 3)
    assert labels()[2] == "single"


def test_a_sweep_goes_on_where_it_broke_off(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    store = ResultStore(spark, str(tmp_path / "store"), "k", "long", "k long, s long")
    seen = []

    def work(d, breaks=None):
        seen.append(sorted(r.k for r in d.select("k").distinct().collect()))
        out = d.groupBy("k").agg(F.sum("v").alias("s")).where("k <> 3")  # no result for 3
        if breaks == len(seen):
            # Rows are written, and then the run is lost before its commit.
            out.write.parquet(f"{store.root}/results/run=lost")
            raise RuntimeError("lost")
        return out

    want = {k: sum(range(k, 40, 10)) for k in range(10) if k != 3}
    with pytest.raises(RuntimeError, match="lost"):
        store.process(rows, lambda d: work(d, 3), pieces=5)
    half = {r.k for r in store.done().collect()}
    assert half == {k for part in seen[:2] for k in part} and len(half) < 10
    seen.clear()
    assert {r.k: r.s for r in store.process(rows, work, pieces=5).collect()} == want
    assert half.isdisjoint(k for part in seen for k in part)
    seen.clear()
    assert store.process(rows, work, pieces=3).count() == 9 and seen == []
    more = rows.unionByName(spark.createDataFrame([(77, 1), (None, 2)], "k long, v long"))
    assert {r.k: r.s for r in store.process(more, work, pieces=2).collect()} == want | {77: 1} and seen == [[77]]
    seen.clear()
    assert {r.k: r.s for r in store.process(rows, work, pieces=1, force=True).collect()} == want and seen == [list(range(10))]
    assert [r.kind for r in store.ledger()].count("clear") == 1
    assert stored_rows(spark, str(tmp_path / "none"), "k long").count() == 0
