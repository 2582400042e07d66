import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=60):
    return " ".join("w" + chr(97 + k % 26) * (1 + k // 26) for k in (rng.randrange(vocabulary) for _ in range(n)))


@pytest.fixture(scope="session")
def corpus():
    """Small documents with nulls, empty and long texts, copies, near copies, ties and repeated lines."""
    rng = random.Random(3)
    rows = [(k, "\n".join(words(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 5))), "en", f"s{k % 3}", 0) for k in range(80)]
    rows += [(80, None, None, None, None), (81, "", "en", "s1", 0), (82, "   \n\t ", "en", "s1", 0), (83, "One", "de", "s2", 3), (84, words(rng, 9000), "fr", "s0", 1)]
    rows += [(100 + k, rows[k][1], "en", "s0", 0) for k in range(10)]  # exact copies
    rows += [(120 + k, rows[k][1].replace("wa", "wq", 1), "en", "s1", 0) for k in range(10)]  # one word changed
    rows += [(200, "ÉTÉ Straße — naïve 中文  x", "fr", "s2", 9), (201, "a\x0bb\x0cc\rd", None, "s2", 7)]
    return rows


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


@pytest.fixture
def table_of(spark, tmp_path):
    """Rows as a Parquet table that an operator may read twice."""

    def write(rows, schema=DOCS, name="documents", files=3):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return write
