import math
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from marginalia.llm import lm
from marginalia.llm.common import fold


def brute(rows, order, prior, train):
    """The automaton walked word by word with dictionaries."""
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    grams = [Counter() for _ in range(order + 1)]
    for i, _ in rows:
        if train(i):
            seq = ["<s>", *tokens[i]]
            for m in range(1, order + 1):
                for k in range(1, len(seq)):
                    if k - m + 1 >= 0:
                        grams[m][tuple(seq[k - m + 1 : k + 1])] += 1
    documents = sum(train(i) for i, _ in rows)
    n, v = sum(grams[1].values()), len(grams[1])
    cc = Counter(grams[1].values())
    d = min(0.9, max(0.1, cc[1] / (cc[1] + 2 * cc[2]))) if cc[1] + 2 * cc[2] else 0.5

    def p(context, w):
        if not context:
            c = grams[1][(w,)]
            return 1.0 if not n else (c - d) / n if c else d * v / n
        lower = p(context[1:], w)
        c = documents if context == ("<s>",) else grams[len(context)][context]
        return (grams[len(context) + 1][(*context, w)] + prior * lower) / (c + prior) if c else lower

    out = {}
    for i, _ in rows:
        seq = ["<s>", *tokens[i]]
        score = sum(math.log10(p(tuple(seq[max(0, k - order + 1) : k]), seq[k])) for k in range(1, len(seq)))
        base = sum(math.log10((grams[1][(w,)] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[i])
        out[i] = (len(tokens[i]), sum(grams[1][(w,)] > 0 for w in tokens[i]), n, base, score)
    return out


def check(got, want):
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        a, b, n, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (a, b, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9, abs_tol=1e-9)


def test_matches_the_automaton_walked_by_hand(corpus, table_of):
    d = table_of(corpus)
    rows = [(r[0], r[1]) for r in corpus]
    for order in (1, 2, 3):
        got = lm.score_corpus(d, fold(F.col("doc_id"), 10) != 0, order=order, prior=5.0).collect()
        check(got, brute(rows, order, 5.0, lambda i: zlib.crc32(str(i).encode()) % 10 != 0))


def test_small_chunks_and_ranges_change_nothing(corpus, table_of, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(lm, "RANGE_BYTES", 3000)
    got = lm.score_corpus(table_of(corpus), fold(F.col("doc_id"), 10) != 0).collect()
    check(got, brute([(r[0], r[1]) for r in corpus], lm.ORDER, lm.PRIOR, lambda i: zlib.crc32(str(i).encode()) % 10 != 0))


def test_empty_table_nothing_to_learn_and_repeated_rows(table_of):
    assert lm.score_corpus(table_of([]), F.lit(True)).collect() == []
    got = lm.score_corpus(table_of([(1, "a b", None, None, None)] * 3 + [(None, None, None, None, None)]), F.lit(None).cast("boolean")).collect()
    assert len(got) == 4 and all(r.score == 0 and r.held_out and r.n_known == 0 for r in got)


def test_words_are_split_and_lowered_as_bytes():
    texts = pa.array(["Ab\x0bC  É", None, "", "x"])
    words, sizes = lm.tokens(texts)
    assert sizes.tolist() == [4, 1, 1, 2]
    again, _ = lm.tokens(pa.array(["aB c  É"]))
    assert words[:4].tolist() == again.tolist()
