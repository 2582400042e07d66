"""Best-fit packing with bound-certified repacking.

Documents become token sequences; every piece of at most ``capacity`` tokens gets a place in a packed
sequence.  Items are dealt into many groups of bounded size.  Each group packs its items by best-fit
decreasing and proves a lower bound on its number of sequences with dual-feasible functions.  Groups
that meet their bound are certified and closed.  The others close their full sequences and give the
documents of the rest into an exchange: these are dealt anew into groups and packed again, until one group holds them all or
a round hardly closes any.  Every row says whether its sequence is certified.
"""

from __future__ import annotations

import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepared, public_tokenizer, stored, table

#: Tokens of a sequence.
CAPACITY = 2048
#: The id that ends every document.
END = 0
#: Items per group aimed at.
GROUP_ITEMS = 8192
#: The exchange ends when a round leaves more than this share of its items open.
STALLED = 0.9
#: Bits of a sequence's number for its place in a group and for the group; the rest count rounds, which a tenth a round keeps below 256.
BIN_BITS, GROUP_BITS = 17, 38


class Encoder:
    """Ids of texts.  ``fast``: the same vocabulary as ranks, which gives the same ids several times faster."""

    def __init__(self, path: str, fast: str | None, special: tuple[str, ...] = ("<|endoftext|>",)):
        self.path, self.special, self.fast = path, special, None
        if fast:
            import base64

            import public_tokenizers
            import tiktoken

            with open(fast, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def slow(self):
        """Loaded by the first text that needs it: it takes as much memory as all else of a task."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        # Texts that spell a special token go the plain way, which decides what becomes of it.
        if self.fast and not any(s in text for s in self.special):
            try:
                return np.asarray(self.fast.encode_ordinary(text), dtype="<u4")
            except BaseException as e:  # noqa: BLE001  a panic of the native library on odd texts isn't an Exception
                if type(e).__name__ != "PanicException":
                    raise
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END,
    tokenizer: str = "byte_bpe_50k.json", ranks: str | None = "byte_bpe_50k.tiktoken", folder: str | None = None, keep_ids: bool = True,
) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32[, ids]`` and ``_slot``, a number of its own for every piece.

    ``row`` is a number of its own for every row of ``docs``, so that pieces of repeated rows can be told apart.

    A document is its ids and ``end``; a null text is empty, so it has one piece of one token.  Longer
    ones than ``capacity`` are cut into full pieces, the first taking the remainder.  Every task finds the vocabulary
    files by name, in ``folder`` or in the installed package.
    """
    def encode(batches):
        from pyspark import TaskContext

        path, fast = public_tokenizer(tokenizer, folder), ranks and public_tokenizer(ranks, folder)
        encoder, part, n = Encoder(path, fast), TaskContext.get().partitionId(), 0
        for batch in batches:
            out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32", "ids", "_slot")}
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(body.as_py() or ""), np.uint32(end)).astype("<u4")
                cuts, row = [*range(len(ids), 0, -capacity), 0][::-1], (part << 40) + n
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    kept = ids[a:b].astype("<i4") if keep_ids else None
                    for name, v in zip(out, (doc, row, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), kept, (part << 40) + n)):
                        out[name].append(v)
                    n += 1
                if keep_ids and len(out["ids"]) > 2000:
                    yield batch_of(out)
                    out = {k: [] for k in out}
            yield batch_of(out)

    types = dict.fromkeys(("doc_id", "row", "piece", "start", "length", "ids_crc32", "ids", "_slot"), pa.int64())
    types |= {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
    if not keep_ids:
        types.pop("ids")

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in types.items()], names=list(types))

    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, " + "ids array<int>, " * keep_ids + "_slot long"
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(encode, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every item, and the number of bins.  Lengths lie in 1..capacity."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # bit r of rooms: some open bin has exactly r tokens left
    for item in order.tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + ((fitting & -fitting).bit_length() - 1)
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, n = capacity, n, n + 1
        bins[item], offsets[item] = at, capacity - room
        if left := room - length:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins, offsets, n


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing can beat, by two families of dual-feasible functions.

    With x = length / capacity.  u_k keeps x where (k+1)x is whole, else floor((k+1)x)/k; U_e sends x > 1-e to 1,
    x < e to 0 and keeps the rest.  Each keeps every feasible bin's sum at most 1, so the sum over all items, rounded
    up, bounds the bins.  Worked out in integers.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int(counts @ x) // capacity)
    for k in range(1, 21):  # scaled by k * capacity
        u = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int(counts @ u) // (k * capacity)))
    # U_e for every e up to a half: items over 1-e count whole, those from e to 1-e by length.
    number, weight = np.cumsum(counts), np.cumsum(counts * x)
    e = np.arange(1, capacity // 2 + 1)
    total = (number[-1] - number[capacity - e]) * capacity + weight[capacity - e] - weight[e - 1]
    return max(best, int(-(-total.max() // capacity)))


def _packer(turn: int, last: bool, capacity: int):
    def one(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        full = (np.bincount(bins, lengths, used) == capacity)[bins]
        good = full if used > lower_bound(lengths, capacity) else np.ones(len(bins), bool)
        if used > 1 << BIN_BITS or turn >= 1 << 63 - BIN_BITS - GROUP_BITS:
            raise OverflowError("sequence numbers have no room for so many sequences of a group, or rounds")
        ids = bins + (turn << BIN_BITS + GROUP_BITS) + (np.int64(group.column("_group")[0].as_py()) << BIN_BITS)
        columns = [group.column("_slot"), group.column("length"), *map(pa.array, (ids, offsets, good, ~good & (not last)))]
        return pa.table(columns, names=["_slot", "length", "sequence_id", "offset", "certified", "_open"])

    return one


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``_slot, length`` (1..capacity) -> ``_slot, sequence_id, offset, certified``.

    Offsets in a sequence follow one another without a gap.  ``certified``: the sequence is full, or its group meets a bound that no
    packing of the group can beat.  Rounds go on while they close a tenth of what is left.  Memory of a task: one group's rows, about
    ``group_items`` (131,072 at most).  An empty table gives no rows;
    equal rows are items of their own.
    """
    schema = "_slot long, length long, sequence_id long, offset long, certified boolean, _open boolean"
    todo, done, n, turn, last = items.select("_slot", "length"), [], items.count(), 0, False
    while not done or n:
        groups = max(1, -(-n // group_items))
        last = last or groups == 1
        dealt = todo.withColumn("_group", F.pmod(F.xxhash64("_slot", F.lit(turn)), F.lit(groups)).cast("int"))
        packed = stored(dealt.groupBy("_group").applyInArrow(_packer(turn, last, capacity), schema), f"pack-{turn}")
        done.append(packed.where(~F.col("_open")))
        todo = packed.where("_open").select("_slot", "length")
        before, n, turn = n, 0 if last else todo.count(), turn + 1
        last = n > STALLED * before
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("_slot", "sequence_id", "offset", "certified")


def pack_documents(docs: DataFrame, keep_ids: bool = True, capacity: int = CAPACITY, **options) -> DataFrame:
    """Documents packed: ``doc_id, row, piece, start, length, ids_crc32[, ids], sequence_id, offset, certified``.

    Full pieces fill a sequence of their own and need no packing.  The tokens are made once and stored.
    """
    made = stored(pieces(docs, capacity=capacity, keep_ids=keep_ids, **options), "pieces")
    places = pack(made.where(F.col("length") < capacity), capacity)
    alone = {"sequence_id": F.lit(-1) - F.col("_slot"), "offset": F.lit(0).cast("long"), "certified": F.lit(True)}
    full = made.where(F.col("length") == capacity).withColumns(alone)
    return made.where(F.col("length") < capacity).join(places, "_slot").unionByName(full).drop("_slot")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, row, certified``.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "row", "certified"]
    return pack_documents(table(spark, sf_dir, "documents"), keep_ids=False).select(*columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences: every document's token ids, and where they lie.  Repeated documents have a ``row`` of their own each."""
    prepared(spark)
    return pack_documents(docs)
