import hashlib
import os
import random
import zlib

import pytest

from marginalia.llm import matroska as M

from .conftest import DOCS


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 4096, 4160, 32767, 32768, 32769, 100_000])
def test_round_trip(n):
    payload = os.urandom(n)
    media = M.mux(payload)
    found = M.parse(media)
    assert b"".join(media[p.offset : p.offset + p.length] for p in found.packets) == payload
    assert [p.timestamp_ns for p in found.packets] == [k * 64_000_000 for k in range(len(found.packets))]
    assert all(media[at : at + 4] == bytes.fromhex("1f43b675") for _, _, at in found.cues) and len(found.cues) == found.clusters


def block(kind, frames):
    """A simple block of track 2 with any lacing."""
    head = b""
    if kind:
        head = bytes([len(frames) - 1])
        if kind == 1:
            for f in frames[:-1]:
                head += b"\xff" * (len(f) // 255) + bytes([len(f) % 255])
        elif kind == 3:
            head += M.write_vint(len(frames[0]))
            for a, b in zip(frames, frames[1:-1]):
                head += M.write_vint(len(b) - len(a) + (1 << 20) - 1, 3)
    return M.element(M.SIMPLE_BLOCK, b"\x82" + (-5).to_bytes(2, "big", signed=True) + bytes([kind << 1]) + head + b"".join(frames))


def head():
    return M.element(M.EBML, M.element(M.DOC_TYPE, b"webm"))


@pytest.mark.parametrize("kind", [0, 1, 2, 3])
def test_lacings(kind):
    rng = random.Random(kind)
    sizes = [700] if kind == 0 else [300] * 4 if kind == 2 else [rng.randrange(0, 900) for _ in range(6)]
    frames = [os.urandom(s) for s in sizes]
    body = M.element(M.CLUSTER, M.element(M.CLUSTER_TIME, b"\x64") + block(kind, frames))
    data = head() + M.element(M.SEGMENT, body)
    got = M.parse(data).packets
    assert [data[p.offset : p.offset + p.length] for p in got] == frames
    assert {(p.track, p.timestamp_ns, p.lacing) for p in got} == {(2, 95_000_000, kind)}


def test_unknown_sizes_block_groups_and_other_elements():
    group = M.element(M.BLOCK_GROUP, M.element(M.BLOCK, b"\x81\x00\x07\x00abc") + M.element(M.REFERENCE, b"\x01"))
    cluster = M.CLUSTER.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + M.element(M.CLUSTER_TIME, b"\x0a") + M.element(0xEC, b"void") + group
    data = head() + M.SEGMENT.to_bytes(4, "big") + b"\xff" + M.element(M.INFO, M.element(M.TIMESTAMP_SCALE, b"\x03\xe8")) + cluster + cluster + M.element(M.CUES, b"")
    got = M.parse(data)
    assert got.clusters == 2 and [(data[p.offset : p.offset + p.length], p.timestamp_ns, p.keyframe, p.block) for p in got.packets] == [(b"abc", 17_000, False, 0), (b"abc", 17_000, False, 1)]


def test_broken_files():
    whole = M.mux(bytes(2000))
    for bad in (b"", b"abc", whole[:40], whole[:-10], M.element(M.EBML, M.element(M.DOC_TYPE, b"avi"))):
        with pytest.raises(ValueError):
            M.parse(bad)


def test_vints():
    for v in (0, 1, 126, 127, 128, 16382, 16383, 2**21, 2**35, 2**55):
        data = M.write_vint(v)
        assert M.read_vint(data, 0) == (v, len(data), len(data))


def test_query_columns(spark, docs, corpus):
    got = {r.doc_id: r for r in M.digests(docs).collect()}
    for i, text, *_ in corpus:
        raw = (text or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_sha256 == hashlib.sha256(M.mux(payload)).hexdigest()
    assert M.digests(docs.limit(0)).collect() == []
    same = M.digests(spark.createDataFrame([(1, "x y", None, None, None), (2, "x y", None, None, None)], DOCS)).collect()
    assert same[0].feature == same[1].feature


def test_packet_and_cue_tables(spark):
    media = spark.createDataFrame([("a", M.mux(bytes(70_000)), 1), ("b", None, 1), ("a", M.mux(b"z"), 1)], "track string, media binary, block int")
    assert M.packets(media.withColumnRenamed("track", "name"), "name", "media").count() == 137 + 1
    assert {r.name: r["count"] for r in M.cue_table(media.withColumnRenamed("track", "name"), "name", "media").groupBy("name").count().collect()} == {"a": 4}


def test_a_key_named_like_a_column_is_refused(spark):
    df = spark.createDataFrame([(1, 2, bytearray(b""))], "track long, timestamp_ns long, media binary")
    with pytest.raises(ValueError, match="track"):
        M.packets(df, "track", "media")
    with pytest.raises(ValueError, match="timestamp_ns"):
        M.cue_table(df, "timestamp_ns", "media")
