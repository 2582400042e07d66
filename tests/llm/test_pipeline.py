import corpus_pipeline
from marginalia.llm.common import stored, table
from marginalia.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_over_the_smallest_tables(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and ids and ids <= before
        before = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == before
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_queries_are_registered():
    import __spark_entry__

    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(ORACLE_SQL) <= set(QUERIES)
