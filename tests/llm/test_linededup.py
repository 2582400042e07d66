import random

import pytest
from pyspark.sql import functions as F

from marginalia.llm import common, linededup

from .conftest import DOCS


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(rows, edits):
    places = {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")) if t is not None and i is not None else ():
            line = line.strip(" ")
            if line:
                places.setdefault(line, set()).add((i, n))
    lines = sorted(places)
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in lines:
        for b in lines:
            k = max([k for low, k in edits if low <= min(len(a), len(b))], default=0)
            if a < b and abs(len(a) - len(b)) <= k and distance(a, b) <= k:
                parent[find(b)] = find(a)
    first = {}
    for x in lines:
        r = find(x)
        first[r] = min(first.get(r, (9**9, 0)), min(places[x]))
    return {(i, n) for x in lines for i, n in places[x] if (i, n) != first[find(x)]}


def edited(rng, line, times):
    s = list(line)
    for _ in range(times):
        p, op = rng.randrange(len(s)), rng.randrange(3)
        if op == 0:
            s[p] = rng.choice("abcxyzé")
        elif op == 1:
            s.insert(p, rng.choice("abc"))
        else:
            del s[p]
    return "".join(s)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(8, 60))) for _ in range(60)]
    out = []
    for i in range(90):
        out.append((i, "\n".join(edited(rng, rng.choice(base), rng.choice((0, 0, 1, 1, 2, 3))) for _ in range(rng.randrange(1, 6)))))
    return [*out, (90, None), (91, ""), (92, "\n\n   \n"), (93, "short"), (94, "short")]


@pytest.mark.parametrize("edits", [(), ((10, 1),), ((10, 2),), ((10, 3),), ((6, 1), (20, 2), (40, 3)), ((8, 0), (30, 2))])
def test_same_as_all_pairs(spark, rows, edits):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no) for r in linededup.dropped_lines(d, edits=edits).collect()}
    assert got == brute(rows, edits)


def test_blocks_and_filter_bits_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(linededup, "GROUP_BLOCK", 2)
    monkeypatch.setattr(common, "FILTER_BITS", 256)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no) for r in linededup.dropped_lines(d, edits=((10, 2),)).collect()}
    assert got == brute(rows, ((10, 2),))


def test_text_loses_the_dropped_lines_only(spark):
    a, b = "this line is long enough", "another line, long enough"
    rows = [
        (1, f"{a}\nhi\n{b}", "en", "s", 1), (2, f"{b}\nho\n\n  {a}x ", "en", "s", 1), (3, None, None, None, None), (None, a, None, None, None),
        (4, "own words in this last line\n\nhi", None, None, None),
    ]
    d = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "_key")
    out = {r.doc_id: r for r in linededup.line_dedup_stage(spark, d, "").collect()}
    assert out[1].text == rows[0][1] and out[2].text == "ho\n" and out[2].n_chars == 3
    assert out[3].text is None and out[None].text == a and out[4].text == "own words in this last line\n"


def test_empty_table_and_bad_parameters(spark):
    d = spark.createDataFrame([], DOCS)
    assert linededup.line_dedup_stage(spark, d, "").collect() == []
    for edits in (((3, 3),), ((20, 1), (10, 2))):
        with pytest.raises(ValueError):
            linededup.line_classes(d, edits=edits)


def test_lines_are_cut_out_of_the_rows_that_have_them(spark):
    rows = [(1, "a\nb\nc\nb"), (1, "x\n b \nc\nq"), (2, "b"), (3, None), (None, "a\nb"), (4, ""), (5, "\n".join(f"l{k}" for k in range(30_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = spark.createDataFrame([(1, 1, "b"), (1, 3, "b"), (1, 0, "x"), (2, 0, "b"), (4, 0, "z"), *[(5, k, f"l{k}") for k in range(0, 30_000, 2)]], "doc_id long, line_no int, line string")
    gone = gone.select("doc_id", "line_no", F.xxhash64("line").alias("id"))
    got = {(r.doc_id, r.text) for r in linededup.dedup_text(docs, gone).collect()}
    want = {(1, "a\nc"), (1, "c\nq"), (2, ""), (3, None), (None, "a\nb"), (4, ""), (5, "\n".join(f"l{k}" for k in range(1, 30_000, 2)))}
    assert got == want
