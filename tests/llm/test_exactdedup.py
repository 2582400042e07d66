import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from marginalia.llm import exactdedup

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(key, keep, size, kept, sha256) with one row kept for each text; rows that repeat the kept key lose but once."""
    groups = defaultdict(list)
    for k, t in rows:
        groups[t or ""].append(k)
    out = []
    for t, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        left = 1
        for k in keys:
            here = k == keep and left > 0
            left -= here
            out.append((k, keep, len(keys), here, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(corpus):
    rows = [(r[0], r[1]) for r in corpus]
    rows += [(500 + k, "the very common text") for k in range(300)] + [(799, "the very common text")] * 3
    return rows + [(None, "x"), (None, "x"), (None, None), (9, "x "), (9, "x"), (900, "long " * 50_000), (901, "long " * 50_000), (902, "é"), (903, "é")]


@pytest.mark.parametrize("weak", [False, True])
def test_same_as_brute_force(spark, corpus, table_of, weak):
    rows = rows_of(corpus)
    df = table_of([(k, t, 1, "a") for k, t in rows], "doc_id long, text string, keep_id int, digest string", "clash")
    # A digest of few values makes different texts share it.
    digest = (lambda t: F.length(t) % 7) if weak else exactdedup.sha256
    got = exactdedup.exact_dedup(df, "doc_id", "text", digest=digest, salts=3)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_normalised_and_empty(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "k long, t string")
    got = exactdedup.exact_dedup(df, "k", "t", normalise=lambda t: F.lower(F.regexp_replace(t, " +", " ")))
    assert sorted((r.k, r.keep_id, r.group_size, r.kept) for r in got.collect()) == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]
    assert exactdedup.exact_dedup(df.limit(0), "k", "t").collect() == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(map(tuple, con.sql(exactdedup.OP13_SQL).fetchall()))
    assert sorted(map(tuple, exactdedup.op13_exact_dedup(spark, SF).collect())) == want
