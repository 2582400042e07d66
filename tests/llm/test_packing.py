import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from marginalia.llm import packing
from marginalia.llm.common import public_tokenizer

from .conftest import DOCS


def test_tokens_pieces_and_places(docs, corpus):
    plain = Tokenizer.from_file(public_tokenizer("byte_bpe_50k.json"))
    want = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t, *_ in corpus}
    rows = packing.pack_documents(docs).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(got.setdefault(r.doc_id, [])) and len(r.ids) == r.length <= 2048
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.piece == 0 or r.length == 2048
        got[r.doc_id] += r.ids
    assert got == want
    for rows_of in by_sequence(rows).values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def by_sequence(rows):
    out = {}
    for r in rows:
        out.setdefault(r.sequence_id, []).append(r)
    return out


def test_fast_and_plain_ids_agree():
    path, ranks = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("byte_bpe_50k.tiktoken")
    fast, plain = packing.Encoder(path, ranks), packing.Encoder(path, None)
    for t in ["", " ", "a  b\n\n c", "ÉTÉ naïve 中文 🙂", "<|endoftext|> x", "x" * 5000, "\r\n\t" * 50, "don't we'll 123,456"]:
        assert fast.ids(t).tolist() == plain.ids(t).tolist()


def test_bounds_hold_and_best_fit_is_right():
    rng = random.Random(1)
    for cap in (10, 64, 2048):
        for _ in range(30):
            lengths = np.array([rng.randrange(1, cap + 1) for _ in range(rng.randrange(1, 60))])
            bins, offsets, n = packing.best_fit_decreasing(lengths, cap)
            assert packing.lower_bound(lengths, cap) <= n and set(bins.tolist()) == set(range(n))
            assert (np.bincount(bins, lengths) <= cap).all()
    assert packing.lower_bound(np.array([6] * 7), 10) == 7  # no two fit together
    assert packing.lower_bound(np.array([4] * 7), 10) == 4


def optimum(lengths, capacity):
    """The least number of bins, by trying every way."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[k]}:
            at = rooms.index(room)
            place(k + 1, [*rooms[:at], room - lengths[k], *rooms[at + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_certified_packings_are_the_optimum(spark):
    rng = random.Random(7)
    certified = 0
    for _ in range(60):
        lengths = np.array([rng.randrange(1, 13) for _ in range(rng.randrange(1, 9))])
        least, (_, _, n) = optimum(lengths.tolist(), 12), packing.best_fit_decreasing(lengths, 12)
        bound = packing.lower_bound(lengths, 12)
        assert bound <= least <= n
        certified += n == bound
    assert certified > 40
    lengths = [7, 7, 5, 5, 4, 4, 4, 3, 9]
    rows = packing.pack(spark.createDataFrame(list(enumerate(lengths)), "_slot long, length long"), 12).collect()
    assert all(r.certified for r in rows) and len({r.sequence_id for r in rows}) == optimum(lengths, 12) == 4


def test_groups_with_a_gap_exchange(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, rng.choice([700, 600, 400, 300, 900, 1200])) for k in range(3000)]
    items = spark.createDataFrame(rows, "_slot long, length long")
    monkeypatch.setattr(packing, "STALLED", 0.0)
    once = packing.pack(items, 2048, group_items=50).select("sequence_id").distinct().count()
    monkeypatch.setattr(packing, "STALLED", 0.9)
    again = packing.pack(items, 2048, group_items=50)
    n = again.select("sequence_id").distinct().count()
    bound = packing.lower_bound(np.array([r[1] for r in rows]), 2048)
    assert again.count() == 3000 and bound <= n <= once
    rows = [(k, rng.randrange(1, 900)) for k in range(3000)]
    items = spark.createDataFrame(rows, "_slot long, length long")
    n = packing.pack(items, 2048, group_items=300).select("sequence_id").distinct().count()
    assert n <= packing.lower_bound(np.array([r[1] for r in rows]), 2048) + 10  # a sequence for each group at most


def test_empty_table_and_repeated_rows(spark):
    d = spark.createDataFrame([], DOCS)
    assert packing.pack_documents(d).collect() == []
    d = spark.createDataFrame([(1, "a b c", None, None, None)] * 5 + [(None, None, None, None, None)], DOCS)
    rows = packing.pack_documents(d).collect()
    assert len(rows) == 6 and len(by_sequence(rows)) == 1 and len({r.offset for r in rows}) == 6
    assert len({r.row for r in rows}) == 6 and all(r.certified for r in rows)
