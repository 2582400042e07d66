"""Conversation structure repair with a suffix-shared automaton.

A conversation's turns, as symbols of role and fault, are its signature.  The distinct signatures of all conversations are sorted from
their ends by range, so that those with a common ending lie next to one another, and become an automaton whose nodes are endings: a
node's arc leads to the ending one symbol shorter, and signatures that end alike share their nodes.  A node holds, for each state of
the grammar, the least cost of repairing what follows and the least audit of that cost; it is worked out once, when the sorted walk
first comes by.

Long conversations are cut into chunks.  A chunk that others follow is a signature with four endings, one for each state it may leave in;
two passes along the chunks, from the last back and from the first on, choose the states.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Turns of a signature; a conversation of more has several.
CHUNK = 1024
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
STATES = range(4)
#: The state a role leads to.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The one role of u and a that may come next, and where it leads.
FORCED = [("u", 2), ("u", 2), ("a", 3), ("u", 2)]
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()
#: Cost and audit of what follows, by state; None where no repair leads to the ending.
Node = list[tuple[int, str] | None]


def _with_inserts(node: Node) -> Node:
    """Also by inserting turns first; three in a row would come back to a state at a cost."""
    for _ in range(2):
        for g in STATES:
            follow = node[FORCED[g][1]]
            if follow and (node[g] is None or (follow[0] + INSERT, "I" + follow[1]) < node[g]):
                node[g] = (follow[0] + INSERT, "I" + follow[1])
    return node


def ending(symbol: str) -> Node:
    """``$``: the end of a conversation, where only states 0 and 3 may stop; ``0`` to ``3``: the next chunk, entered in that state."""
    if symbol == "$":
        return _with_inserts([(0, ""), None, None, (0, "")])
    return [(0, "") if g == int(symbol) else None for g in STATES]


def before(symbol: str, follow: Node) -> Node:
    """The node that puts ``symbol`` before an ending: a role's initial (upper case: truncated), or ``x``, a turn to be deleted."""
    node: Node = []
    role, more = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for g in STATES:
        ways = [follow[g] and (follow[g][0] + DELETE, "D" + follow[g][1])]
        if symbol != "x":
            kept, forced = NEXT.get((g, role)), FORCED[g][1]
            if kept is not None and follow[kept]:
                ways.append((follow[kept][0] + KEEP + more, "K" + follow[kept][1]))
            if follow[forced]:
                ways.append((follow[forced][0] + REROLE + more, "R" + follow[forced][1]))
        node.append(min((w for w in ways if w), default=None))
    return _with_inserts(node)


class Automaton:
    """Nodes of the signature read last, from the end; the next one keeps those of the ending they share."""

    def __init__(self):
        self.path, self.nodes, self.made = "", [], 0

    def entry(self, backward: str) -> Node:
        """The node of a whole signature, given its ending's symbol and then its symbols from the last to the first."""
        shared = 0
        while shared < min(len(self.path), len(backward)) and self.path[shared] == backward[shared]:
            shared += 1
        del self.nodes[shared:]
        for k in range(shared, len(backward)):
            self.nodes.append(before(backward[k], self.nodes[-1]) if k else ending(backward[0]))
            self.made += 1
        self.path = backward
        return self.nodes[-1]


def entries(words: DataFrame) -> DataFrame:
    """``backward, costs, audits`` of distinct ``backward`` signatures: least cost and its least audit from each state."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            found = [automaton.entry(w) for w in batch.column(0).to_pylist()]
            costs = pa.array([[x and x[0] for x in n] for n in found], pa.list_(pa.int64()))
            audits = pa.array([[x and x[1] for x in n] for n in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), costs, audits], names=["backward", "costs", "audits"])

    apart = words.repartitionByRange("backward").sortWithinPartitions("backward")
    return apart.mapInArrow(walk, "backward string, costs array<long>, audits array<string>")


def matched(a: DataFrame, b: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """``a`` with the columns of ``b`` where ``names`` are equal; nulls equal nulls."""
    on = None
    for n in names:
        b = b.withColumnRenamed(n, f"_{n}")
        same = F.col(n).eqNullSafe(F.col(f"_{n}"))
        on = same if on is None else on & same
    return a.join(b, on, how).drop(*[f"_{n}" for n in names])


def numbered(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, digest, initial, blank, cut, place``: turns without their texts, ``place`` rising in the order of a conversation.

    Turns are sorted by range, so that a conversation of any length is dealt to many tasks; ``place`` counts within a task's range.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"), F.monotonically_increasing_id().alias("_id"),
    )
    order = ["conv", "turn", "role", "digest", "_id"]
    return narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("_id").withColumn("place", F.monotonically_increasing_id())


def chunked(turns: DataFrame, size: int) -> DataFrame:
    """A row for each chunk of a conversation: its signature, its counts, and the key of its first turn."""
    again = turns.where("not blank").groupBy("conv", "role", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    t = matched(turns, again, ["conv", "role", "digest"]).withColumn("dup", ~F.col("blank") & F.coalesce(F.col("place") > F.col("first"), F.lit(False)))
    t = t.withColumn("trunc", ~F.col("blank") & ~F.col("dup") & F.col("cut"))
    symbol = F.when(F.col("blank") | F.col("dup"), "x").when(F.col("trunc"), F.upper("initial")).otherwise(F.col("initial"))
    row = F.struct("place", symbol.alias("symbol"), "initial")
    g = t.groupBy("conv", F.floor(F.col("place") / size).alias("chunk")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.min(F.struct("place", "turn", "role", "digest")).alias("at"), F.count(F.lit(1)).alias("n"),
        F.count_if("blank").alias("blank"), F.count_if("dup").alias("duplicate"), F.count_if("trunc").alias("truncated"),
    )
    word = lambda f: F.array_join(F.transform("rows", lambda x: x[f]), "")
    g = g.withColumns({"word": word("symbol"), "roles": word("initial")}).drop("rows")
    w = Window.partitionBy("conv").orderBy("chunk")
    legal = F.regexp_count(F.concat(F.coalesce(F.lag(F.substring("roles", -1, 1)).over(w), F.lit("")), "roles"), F.lit("(?=su|ua|au)"))
    pairs = F.col("n") - F.when(F.row_number().over(w) == 1, 1).otherwise(0)
    whole = F.lead("chunk").over(w).isNull() & (F.row_number().over(w) == 1)
    return g.withColumns({"illegal": pairs - legal, "final": F.lead("chunk").over(w).isNull(), "whole": whole}).drop("roles")


def along(df: DataFrame, order: list[Column], step: Callable, names: list[str], kind: str) -> DataFrame:
    """Rows of a conversation one after another: ``step(state, row)`` gives the next state and what to return beside ``conv, chunk``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = object(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    conv, state = row["conv"], None
                state, found = step(state, row)
                out.append((row["conv"], row["chunk"], *found))
            columns = [pa.array(c) for c in zip(*out)] if out else []
            if columns:
                yield pa.RecordBatch.from_arrays([columns[0].cast(batch.schema.field("conv").type), *columns[1:]], names=["conv", "chunk", *names])

    of = df.schema["conv"].dataType.simpleString()
    return df.repartition("conv").sortWithinPartitions("conv", *order).mapInArrow(walk, f"conv {of}, chunk long, {kind}")


def backward_step(after: list[int | None] | None, row: dict) -> tuple[list[int | None], tuple]:
    """Least cost from each state to the end of the conversation, and the state a chunk is best left in."""
    if row["final"]:
        return row["costs"][0], ([0] * 4,)
    best = []
    for g in STATES:
        ways = [(row["costs"][e][g] + after[e], row["ranks"][e][g], e) for e in STATES if row["costs"][e][g] is not None and after[e] is not None]
        best.append(min(ways, default=None))
    return [b and b[0] for b in best], ([b[2] if b else 0 for b in best],)


def forward_step(state: int | None, row: dict) -> tuple[int, tuple]:
    entered = state or 0
    return row["leaves"][entered], (entered, row["leaves"][entered])


def pieces(chunks: DataFrame) -> DataFrame:
    """``chunks`` with the cost and audit of each, and the state it is entered in."""
    endings = F.when(F.col("final"), F.array(F.lit("$"))).otherwise(F.array(*[F.lit(str(g)) for g in STATES]))
    asked = chunks.withColumn("_e", F.explode(endings)).withColumn("backward", F.concat("_e", F.reverse("word")))
    words = stored(entries(asked.select("backward").distinct()), "conversation-words")
    asked = asked.join(words, "backward").drop("backward")
    short = asked.where("whole").select(*chunks.columns, F.lit(0).cast("long").alias("entered"), F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    long = asked.where("not whole").groupBy("conv", "chunk", "final").agg(F.array_sort(F.collect_list(F.struct("_e", "costs", "audits"))).alias("ways"))
    long = stored(long, "conversation-chunks")
    # Audits of different endings differ before either is over, so their order in the chunk decides between equal costs.
    audits = F.col("ways.audits")
    rank = F.transform("ways", lambda x: F.transform(x["audits"], lambda a, g: F.size(F.filter(audits, lambda o: F.get(o, g) < a))))
    chain = long.select("conv", "chunk", "final", F.col("ways.costs").alias("costs"), rank.alias("ranks"))
    left = along(chain, [F.col("chunk").desc()], backward_step, ["leaves"], "leaves array<long>")
    taken = along(left, [F.col("chunk")], forward_step, ["entered", "left"], "entered long, left long")
    joined = matched(long, taken, ["conv", "chunk"], "inner")
    way = F.element_at("ways", F.when(F.col("final"), 1).otherwise(F.col("left") + 1).cast("int"))
    chosen = joined.select("conv", "chunk", "entered", F.get(way["costs"], F.col("entered").cast("int")).alias("cost"), F.get(way["audits"], F.col("entered").cast("int")).alias("audit"))
    return short.unionByName(matched(chunks.where("not whole"), chosen, ["conv", "chunk"], "inner"))


def repaired_rows(rows: DataFrame, found: DataFrame, order: Callable[[Column], Column]) -> DataFrame:
    """``conv, role, text`` of the repaired conversations: each lies in one partition, its turns together and in order.

    Texts are shuffled once, by conversation, and pass one by one beside the audits of their chunks.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    texts = rows.select("conv", "turn", "role", order(F.col("text")).alias("digest"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("chunk"), "text", F.lit(0).cast("long").alias("entered"))
    audits = found.select("conv", "at.turn", "at.role", "at.digest", F.lit(0).alias("kind"), "chunk", F.col("audit").alias("text"), "entered")
    one = texts.unionByName(audits).repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest", "kind", "chunk")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, audit, fresh = None, 0, deque(), True

        def insert(out: list) -> None:
            nonlocal state
            role, state = FORCED[state]
            out.append((conv, ROLES[role], ""))

        for batch in batches:
            out = []
            for c, role, k, text, entered in zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "kind", "text", "entered"))):
                if fresh or c != conv:
                    while audit:  # turns inserted at the end
                        audit.popleft()
                        insert(out)
                    conv, state, fresh = c, 0, False
                if k == 0:
                    audit.extend(text)
                    continue
                while (done := audit.popleft()) == "I":
                    insert(out)
                if done == "K":
                    out.append((c, role, text))
                    state = NEXT[state, role[0]]
                elif done == "R":
                    initial, state = FORCED[state]
                    out.append((c, ROLES[initial], text))
            if out:
                yield _batch(out, batch.schema.field("conv").type)
        out = []
        while audit:
            audit.popleft()
            insert(out)
        if out:
            yield _batch(out, batch.schema.field("conv").type)

    return one.mapInArrow(edit, f"conv {kind}, role string, text string")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, role, text = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv, kind), pa.array(role, pa.string()), pa.array(text, pa.string())], names=["conv", "role", "text"])


def digests(rows: DataFrame) -> DataFrame:
    """``conv, sha256`` of ``role:text``, joined by line feeds, of rows as ``repaired_rows`` returns them; a text passes once."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, of = None, None, None
        for batch in batches:
            out, of = [], batch.schema.field("conv").type
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "text"))):
                if sha is None or c != conv:
                    if sha is not None:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], of), pa.array([d for _, d in out])], names=["conv", "sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], of), pa.array([sha.hexdigest()])], names=["conv", "sha256"])

    return rows.mapInArrow(run, f"conv {kind}, sha256 string")


def repair(rows: DataFrame, conv: str, turn: str, role: str, text: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of each conversation to roles (system? (user assistant)+)?: ``(conversations, turns)``.

    conversations: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``; turns: ``conv, role, text`` as ``repaired_rows`` has them.
    Turns come by ``turn`` (nulls first, ties by role, then by the text's SHA-256; rows that repeat a turn, role and text are
    interchangeable).  A turn's first fault counts: blank (white space only), duplicate (role and text came earlier), truncated (its last
    letter isn't one of ``.!?``).  Keeping costs 0, another role of user and assistant 2, deleting 3 (blank and duplicate turns must go),
    inserting an empty turn 2, and a truncated turn that stays 1; of the cheapest audits (K, R, D, I in order) the least counts.  A role
    is known by its first letter; one that begins otherwise, or is empty, can't be kept.  Null roles and texts count as one space; a null
    ``conv`` is a conversation like others.  ``gaps`` are whole numbers missing between the least and the largest turn (nulls
    don't count).  Other columns don't count, whatever their names.  An empty table gives no rows.
    """
    blankless = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), blankless(role).alias("role"), blankless(text).alias("text"))
    turns = stored(numbered(rows), "conversation-turns")
    chunks = stored(chunked(turns, chunk), "conversation-signatures")
    found = stored(pieces(chunks), "conversation-pieces")
    spans = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    sums = found.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    out = matched(sums, spans, ["conv"]).select("conv", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return out, repaired_rows(rows, found, lambda t: F.unhex(F.sha2(t.cast("binary"), 256)))


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes out ``.!?``, 3 repeats
    it, 4 makes it the user's.  Nulls count as one space, but a null turn stays null for the order."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    d = df.select("conv_id", "turn", written("role").alias("role"), written("text").alias("text"), fault.alias("_f")).where("_f <> 0")
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    d = d.withColumns({"text": text, "role": F.when(F.col("_f") == 4, "user").otherwise(F.col("role"))})
    return d.withColumn("_n", F.explode(F.when(F.col("_f") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_f", "_n")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    Those that lose all rows have zeros, an empty audit and the hash of nothing."""
    df = table(spark, sf_dir, "conversations")
    found, turns = repair(damaged(df), "conv_id", "turn", "role", "text")
    every = df.select(F.col("conv_id").alias("conv")).distinct()
    out = matched(matched(every, found, ["conv"]), digests(turns), ["conv"])
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(EMPTY)).alias("repaired_sha256"))
