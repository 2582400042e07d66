"""Media columns: Matroska files as tables of packets.

``parse`` walks the variable-length EBML elements of a file (sizes known or unknown), its tracks, clusters, simple blocks
and block groups with any lacing, and its cues, into packets with timestamps, tracks and byte ranges.  ``mux``
writes bytes as 8-bit PCM audio in clusters of laced blocks with cues.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Element ids of the format (fixed values).
EBML, DOC_TYPE = 0x1A45DFA3, 0x4282
SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, DURATION = 0x2AD7B1, 0x4489
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1
SAMPLING, CHANNELS, BIT_DEPTH, DEFAULT_DURATION = 0xB5, 0x9F, 0x6264, 0x23E383
CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
SEEK_HEAD, TAGS, CHAPTERS, ATTACHMENTS = 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469
TOP_LEVEL = {INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, TAGS, CHAPTERS, ATTACHMENTS}

RATE = 8000  # samples a second of the audio that mux() writes: one byte each
FRAME = 512  # bytes of a packet
LACED = 8  # packets of a block
CLUSTER_BYTES = 32_768


@dataclass
class Packet:
    track: int
    timestamp_ns: int
    keyframe: bool
    lacing: int
    block: int
    lace: int
    offset: int
    length: int


@dataclass
class Media:
    doc_type: str = ""
    scale_ns: int = 1_000_000
    duration: float | None = None
    tracks: list[dict] = field(default_factory=list)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time in ns, track, cluster's offset in the file
    clusters: int = 0


def read_vint(data: bytes, at: int, marked: bool = False) -> tuple[int, int, int]:
    """Value, next offset and width of a variable-length integer; ``marked`` keeps the length marker, as ids do."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length integer at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError(f"file ends inside the integer at byte {at}")
    value = int.from_bytes(data[at : at + width], "big")
    return (value if marked else value & ((1 << 7 * width) - 1)), at + width, width


def write_vint(value: int, width: int = 0) -> bytes:
    width = width or max(1, -(-(value + 1).bit_length() // 7))
    return (value | 1 << 7 * width).to_bytes(width, "big")


def elements(data: bytes, at: int, end: int):
    """(id, first byte of the element, of its body, end of its body) of the elements of one level; None: size unknown."""
    while at < end:
        start = at
        ident, at, _ = read_vint(data, at, marked=True)
        size, at, width = read_vint(data, at)
        unknown = size == (1 << 7 * width) - 1
        if not unknown and at + size > end:
            raise ValueError(f"element {ident:#x} at byte {start} passes the end of its parent")
        stop = yield ident, start, at, None if unknown else at + size
        at = stop if unknown else at + size


def _uint(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _float(data: bytes, a: int, b: int) -> float:
    return struct.unpack({4: ">f", 8: ">d"}[b - a], data[a:b])[0] if b > a else 0.0


def _laces(data: bytes, at: int, end: int, kind: int) -> list[tuple[int, int]]:
    """(offset, length) of every frame of a block's body."""
    if not kind:
        return [(at, end - at)]
    count, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == 1:  # runs of 255 and a rest
        for _ in range(count - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif kind == 3:  # the first size, then signed differences
        for k in range(count - 1):
            value, at, width = read_vint(data, at)
            sizes.append(value if not k else sizes[-1] + value - ((1 << (7 * width - 1)) - 1))
    else:
        if (end - at) % count:
            raise ValueError("a block of equal frames doesn't divide")
        sizes = [(end - at) // count] * (count - 1)
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise ValueError("frames pass the end of their block")
    out = []
    for size in [*sizes, last]:
        out.append((at, size))
        at += size
    return out


def parse(data: bytes) -> Media:
    """Tables of one file.  Raises ValueError where the bytes aren't a whole, well-formed file."""
    media = Media()
    ticks: dict[int, int] = {}  # nanoseconds of a packet of each track
    cue_ticks: list[tuple[int, int, int]] = []
    body = 0

    def block(a: int, b: int, base: int, key: bool | None) -> None:
        track, at, _ = read_vint(data, a)
        if at + 3 > b:
            raise ValueError(f"block at byte {a} is too short")
        relative, flags = struct.unpack(">hB", data[at : at + 3])
        kind = flags >> 1 & 3
        number = media.packets[-1].block + 1 if media.packets else 0
        for lace, (offset, length) in enumerate(_laces(data, at + 3, b, kind)):
            when = (base + relative) * media.scale_ns + lace * ticks.get(track, 0)
            media.packets.append(Packet(track, when, bool(flags & 0x80) if key is None else key, kind, number, lace, offset, length))

    def cluster(a: int, b: int | None) -> int:
        media.clusters += 1
        base, end = 0, len(data) if b is None else b
        for ident, start, x, y in elements(data, a, end):
            if b is None and ident in TOP_LEVEL:
                return start
            if y is None:
                raise ValueError(f"unknown size inside a cluster at byte {start}")
            if ident == CLUSTER_TIME:
                base = _uint(data, x, y)
            elif ident == SIMPLE_BLOCK:
                block(x, y, base, None)
            elif ident == BLOCK_GROUP:
                inner = {i: (p, q) for i, _, p, q in elements(data, x, y)}
                if BLOCK in inner:
                    block(*inner[BLOCK], base, REFERENCE not in inner)
        return end

    top = elements(data, 0, len(data))
    step = next(top, None)
    if step is None or step[0] != EBML:
        raise ValueError("no EBML header")
    for ident, _, x, y in elements(data, step[2], step[3]):
        if ident == DOC_TYPE:
            media.doc_type = data[x:y].decode("ascii")
    if media.doc_type not in ("matroska", "webm"):
        raise ValueError(f"document type {media.doc_type!r}")
    step = next(top, None)
    while step is not None:
        ident, _, x, y = step
        if ident == SEGMENT:
            body, end = x, len(data) if y is None else y
            walk = elements(data, x, end)
            inner = next(walk, None)
            while inner is not None:
                ident2, _, p, q = inner
                stop = q
                if ident2 == CLUSTER:
                    stop = cluster(p, q)
                elif q is None:
                    raise ValueError("unknown size of an element that must state it")
                elif ident2 == INFO:
                    for i, _, c, d in elements(data, p, q):
                        if i == TIMESTAMP_SCALE:
                            media.scale_ns = _uint(data, c, d)
                        elif i == DURATION:
                            media.duration = _float(data, c, d)
                elif ident2 == TRACKS:
                    for i, _, c, d in elements(data, p, q):
                        if i == TRACK_ENTRY:
                            entry = {k: data[e:f] for k, _, e, f in elements(data, c, d)}
                            sound = entry.get(AUDIO, b"")
                            audio = {k: sound[e:f] for k, _, e, f in elements(sound, 0, len(sound))}
                            number = int.from_bytes(entry.get(TRACK_NUMBER, b""), "big")
                            ticks[number] = int.from_bytes(entry.get(DEFAULT_DURATION, b""), "big")
                            media.tracks.append({
                                "track": number, "kind": int.from_bytes(entry.get(TRACK_TYPE, b""), "big"), "codec": entry.get(CODEC_ID, b"").decode("ascii", "replace"),
                                "rate": _float(audio.get(SAMPLING, b""), 0, len(audio.get(SAMPLING, b""))), "channels": int.from_bytes(audio.get(CHANNELS, b"\x01"), "big"), "bits": int.from_bytes(audio.get(BIT_DEPTH, b""), "big"),
                            })
                elif ident2 == CUES:
                    for i, _, c, d in elements(data, p, q):
                        if i == CUE_POINT:
                            parts = list(elements(data, c, d))
                            time = next((_uint(data, e, f) for k, _, e, f in parts if k == CUE_TIME), 0)
                            for k, _, e, f in parts:
                                if k == CUE_POSITIONS:
                                    pos = {m: _uint(data, g, h) for m, _, g, h in elements(data, e, f)}
                                    cue_ticks.append((time, pos.get(CUE_TRACK, 0), pos.get(CUE_CLUSTER, 0)))
                try:
                    inner = walk.send(stop)
                except StopIteration:
                    inner = None
            y = end
        elif y is None:
            raise ValueError("unknown size of an element that must state it")
        try:
            step = top.send(y)
        except StopIteration:
            step = None
    media.cues = [(t * media.scale_ns, track, body + at) for t, track, at in cue_ticks]
    return media


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes(-(-ident.bit_length() // 8), "big") + write_vint(len(body)) + body


def _number(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, -(-value.bit_length() // 8)), "big"))


def _lace_header(sizes: list[int]) -> tuple[int, bytes]:
    """Flags and header of a block of frames: equal sizes, or the first and signed differences."""
    if len(sizes) == 1:
        return 0x80, b""
    if len(set(sizes)) == 1:
        return 0x84, bytes([len(sizes) - 1])
    head = bytes([len(sizes) - 1]) + write_vint(sizes[0])
    for a, b in zip(sizes, sizes[1:-1]):
        width = next(w for w in range(1, 9) if abs(b - a) < (1 << (7 * w - 1)) - 1)
        head += write_vint(b - a + (1 << (7 * width - 1)) - 1, width)
    return 0x86, head


def mux(payload: bytes) -> bytes:
    """``payload`` as one track of unsigned 8-bit samples at 8 kHz: laced blocks in clusters, and a cue for each cluster."""
    frame_ns = FRAME * 1_000_000_000 // RATE
    audio = element(SAMPLING, struct.pack(">d", RATE)) + _number(CHANNELS, 1) + _number(BIT_DEPTH, 8)
    entry = _number(TRACK_NUMBER, 1) + _number(TRACK_UID, 1) + _number(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + _number(DEFAULT_DURATION, frame_ns) + element(AUDIO, audio)
    parts = [
        element(INFO, _number(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE))),
        element(TRACKS, element(TRACK_ENTRY, entry)),
    ]
    at, cues = sum(map(len, parts)), []
    for a in range(0, len(payload), CLUSTER_BYTES):
        start = a * 1000 // RATE
        blocks = [_number(CLUSTER_TIME, start)]
        for b in range(a, min(a + CLUSTER_BYTES, len(payload)), FRAME * LACED):
            body = payload[b : min(b + FRAME * LACED, a + CLUSTER_BYTES)]
            flags, head = _lace_header([min(FRAME, len(body) - c) for c in range(0, len(body), FRAME)])
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", b * 1000 // RATE - start, flags) + head + body))
        cues.append(element(CUE_POINT, _number(CUE_TIME, start) + element(CUE_POSITIONS, _number(CUE_TRACK, 1) + _number(CUE_CLUSTER, at))))
        parts.append(element(CLUSTER, b"".join(blocks)))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(cues)))
    return element(EBML, element(DOC_TYPE, b"matroska")) + element(SEGMENT, b"".join(parts))


PACKETS = "track int, timestamp_ns long, keyframe boolean, lacing int, block int, lace int, offset long, length long"


def _apart(key: str, names: list[str]) -> None:
    if key.lower() in names:
        raise ValueError(f"rename the key column {key!r}: the table has a column of that name")


def packets(df: DataFrame, key: str, media: str) -> DataFrame:
    """Packet table of a media column: ``<key>, track, timestamp_ns, keyframe, lacing, block, lace, offset, length``.

    Null media give no packets; a broken file raises ValueError, and so does a key named like another column.  Repeated rows repeat
    their packets.
    """
    names = [x.split()[0] for x in PACKETS.split(", ")]
    _apart(key, names)
    types = [pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, value in enumerate(batch.column(1)):
                found = parse(value.as_py()).packets if value.is_valid else []
                if found:
                    keys = pa.array([batch.column(0)[row].as_py()] * len(found), batch.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([keys, *(pa.array([getattr(p, n) for p in found], t) for n, t in zip(names, types))], names=[key, *names])

    return df.select(key, media).mapInArrow(run, f"`{key}` {kind}, {PACKETS}")


def cue_table(df: DataFrame, key: str, media: str) -> DataFrame:
    """Cue table of a media column: ``<key>, timestamp_ns, track, cluster_offset``; null media and keys as in ``packets``."""
    _apart(key, ["timestamp_ns", "track", "cluster_offset"])
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, value in enumerate(batch.column(1)):
                found = parse(value.as_py()).cues if value.is_valid else []
                if found:
                    keys = pa.array([batch.column(0)[row].as_py()] * len(found), batch.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([keys, *(pa.array([c[i] for c in found], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64())))], names=[key, "timestamp_ns", "track", "cluster_offset"])

    return df.select(key, media).mapInArrow(run, f"`{key}` {kind}, timestamp_ns long, track int, cluster_offset long")


def features(media: bytes, found: Media, payload: bytes) -> str:
    """What the packet table and the samples say, as text."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    crossings = int(np.count_nonzero(np.diff(x >= 128)))
    last = found.packets[-1]
    return (
        f"codec={found.tracks[0]['codec']};clusters={found.clusters};blocks={last.block + 1};packets={len(found.packets)};cues={len(found.cues)};"
        f"last_ns={last.timestamp_ns};first_byte={found.packets[0].offset};sum={int(x.sum())};energy={int((x * x).sum())};crossings={crossings}"
    )


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", pad: int = 64) -> DataFrame:
    """Every text as UTF-8, padded with zero bytes to a positive multiple of ``pad``, muxed, parsed and read back.

    ``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature``.  Null is empty.
    """
    columns = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches):
        for batch in batches:
            rows = []
            for value in batch.column(1).cast(pa.binary()):
                raw = value.as_py() or b""
                media = mux(raw + bytes(max(pad, -(-len(raw) // pad) * pad) - len(raw)))
                found = parse(media)
                back = b"".join(media[p.offset : p.offset + p.length] for p in found.packets)
                rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), features(media, found, back)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types))], names=["doc_id", *columns])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def op8_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text stored as a Matroska file and read back through its packet table."""
    return digests(table(spark, sf_dir, "documents"))
