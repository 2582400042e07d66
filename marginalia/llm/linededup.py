"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line is kept where it occurs first (smallest document id, then line number); later copies are dropped, however short the
line is, and so are long enough lines within some edits of one already there, directly or over a chain of such lines.  How many
edits grows with the length of the shorter line: ``EDITS``.

Split a line into edits + 1 segments of nearly equal length: any line within that many edits contains at
least one of them whole, at a place that the two lengths bound.  So every distinct line files its own segments under
(length, number, text), and looks up just those of its substrings that such a segment of an equally long or shorter line can be.
Lines that meet under a key are verified by Spark's banded edit distance (2 x edits + 1 diagonals).

A line travels as a 64-bit hash with its keys; text is fetched only for lines that met another.  Copies collapse
before anything is joined, and a key with many lines is split into blocks whose pairs are verified apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import maybe, stored, table
from .components import connected_components

#: (least length, edits): shorter lines than the first are dropped as exact copies only.
EDITS = ((20, 1), (200, 2))
#: Lines of a block of a large group.
GROUP_BLOCK = 128


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, line_no, line, id`` of all lines but blank ones; ``line`` is without spaces around it."""
    parts = F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line")
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), parts)
    return rows.withColumn("line", F.trim("line")).where("line <> ''").withColumn("id", F.xxhash64("line"))


def _levels(edits) -> list[tuple[int, int, int]]:
    """(least length, most, edits) of the lengths that allow any edit."""
    levels = [(low, high - 1, k) for (low, k), (high, _) in zip(edits, [*edits[1:], (1 << 31, 0)])]
    if any(low <= k or k < 0 or high < low for low, high, k in levels):
        raise ValueError("edits must be fewer than the least length they hold for, and lengths must ascend")
    return [x for x in levels if x[2]]


def _allowed(length: Column, levels) -> Column:
    """Edits that a pair may need whose shorter line has this length."""
    found = F.lit(0)
    for low, _, k in levels:
        found = F.when(length >= low, k).otherwise(found)
    return found


def _keyed(lines: DataFrame, levels) -> DataFrame:
    """``lines`` with ``own``, the hashed keys of a line's own segments, and ``looked``, those of the substrings to look up."""
    lines = lines.withColumn("_n", F.length("line"))
    # Columns of their own, so that they are worked out once a line and not once a key.
    cuts = sorted({(k, shorter) for _, _, k in levels for shorter in range(k + 1)})
    quotients = {f"_q{k}_{d}": F.expr(f"cast((_n - {d}) div {k + 1} as int)") for k, d in cuts}
    rests = {f"_r{k}_{d}": F.expr(f"(_n - {d}) % {k + 1}") for k, d in cuts}
    cut = lines.select("*", *[c.alias(n) for n, c in (quotients | rests).items()])

    def segment(k: int, number: int, shorter: int, shift: int) -> Column:
        """Key of segment ``number`` of a line ``shorter`` characters shorter than this, as this line would have it ``shift`` on."""
        small, longer = F.col(f"_q{k}_{shorter}"), F.col(f"_r{k}_{shorter}")
        before = F.greatest(longer + (number - 1 - (k + 1)), F.lit(0))  # segments before this one that have a character more
        size = small + F.when(longer >= k + 2 - number, 1).otherwise(0)
        return F.xxhash64(F.lit(k), F.lit(number), F.col("_n") - shorter, F.substring("line", small * (number - 1) + before + (1 + shift), size))

    none = F.array().cast("array<bigint>")
    own, looked = none, []
    for low, high, k in levels:
        parts, inside = range(1, k + 2), F.col("_n").between(low, high)
        own = F.when(inside, F.array(*[segment(k, i, 0, 0) for i in parts])).otherwise(own)
        keys = []
        for shorter in range(k + 1):
            for i in parts:
                # Edits left of the segment shift it, and so do those right of it, counted from the end.
                first, last = max(-(i - 1), shorter - (k + 1 - i)), min(i - 1, shorter + (k + 1 - i))
                there = (F.col("_n") - shorter).between(low, high)
                keys += [F.when(there, segment(k, i, shorter, s)) for s in range(first, last + 1) if shorter or s]
        looked.append(F.when(F.col("_n").between(low, high + k), F.array_compact(F.array(*keys))).otherwise(none))
    looked = F.array_distinct(F.concat(*looked)) if looked else none
    return cut.select(*lines.columns, own.alias("own"), looked.alias("looked"))


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", edits=EDITS) -> DataFrame:
    """One row per distinct line: ``id, n, first, class, kept_at``.

    ``n`` is how often it occurs, ``first`` and ``kept_at`` are (doc_id, line_no) of its own first place and of its class's;
    ``class`` is the id of a line that stands for all lines linked to it.
    """
    levels = _levels(edits)
    lines = _lines(docs, key, text)
    sent = _keyed(lines, levels).select("id", F.struct("doc_id", "line_no").alias("at"), "own", "looked")
    one = F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("own").alias("own"), F.any_value("looked").alias("looked")
    distinct = stored(sent.groupBy("id").agg(*one), "lines")
    filed, asked = (distinct.select("id", F.explode(c).alias("key"), F.lit(n).alias("filed")) for c, n in (("own", 1), ("looked", 0)))
    rows = filed.unionByName(asked)
    # A key matters where someone filed it and someone else has it too.
    met = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.sum("filed").alias("_f")).where("_n > 1 and _f > 0")
    parts = F.ceil(F.col("_n") / GROUP_BLOCK).cast("int")
    members = rows.join(met, "key").select("key", "id", parts.alias("parts"), F.pmod(F.xxhash64("id", "key"), parts).cast("int").alias("own"))
    members = stored(members, "line-members")
    # Text comes from a line's first place only, so a line that a third of all documents share is fetched once.
    places = distinct.select(F.col("id").alias("_id"), F.col("first.doc_id").alias("_doc"), F.col("first.line_no").alias("_no"))
    wanted = stored(places.join(members.select(F.col("id").alias("_m")).distinct(), F.col("_id") == F.col("_m"), "left_semi"), "line-wanted")
    # How many lines met another has no bound, so they are never broadcast: the plan is the same at every size.
    at_first = (F.col("doc_id") == F.col("_doc")) & (F.col("line_no") == F.col("_no")) & (F.col("id") == F.col("_id"))
    texts = maybe(lines, "id", wanted).join(wanted.hint("merge"), at_first).groupBy("_id").agg(F.any_value("line").alias("line"))
    member = F.struct("id", "own", "line", F.length("line").alias("n")).alias("m")
    dealt = members.join(texts, F.col("id") == F.col("_id")).select("key", member, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    ends = F.least("m.own", "other").alias("i"), F.greatest("m.own", "other").alias("j")
    groups = dealt.groupBy("key", *ends).agg(F.collect_list("m").alias("g"))
    most = max((k for _, _, k in levels), default=0)

    def partners(x: Column, at: Column) -> Column:
        later = F.slice("g", at + 2, F.size("g"))

        def near(y: Column) -> Column:
            allowed = _allowed(F.least(x["n"], y["n"]), levels)
            apart = ((F.col("i") == F.col("j")) | (x["own"] != y["own"])) & (x["id"] != y["id"])
            return apart & (F.abs(x["n"] - y["n"]) <= allowed) & F.levenshtein(x["line"], y["line"], most).between(F.lit(0), allowed)

        return F.transform(F.filter(later, near), lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")))

    pairs = groups.where(F.size("g") > 1).select(F.explode(F.flatten(F.transform("g", partners))).alias("e"))
    edges = pairs.select(F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b"))
    roots = connected_components(edges, "line").select(F.col("node").alias("_node"), "root")
    known = distinct.select("id", "n", "first")
    linked = known.join(roots, F.col("id") == F.col("_node"))
    leaders = linked.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("_first"))
    linked = linked.join(leaders, F.col("root") == F.col("_root")).select("id", "n", "first", F.col("root").alias("class"), F.col("_first").alias("kept_at"))
    # Lines without a link stay out of the join: as nulls they would all meet in one task.
    alone = known.join(roots, F.col("id") == F.col("_node"), "left_anti")
    return linked.unionByName(alone.select("id", "n", "first", F.col("id").alias("class"), F.col("first").alias("kept_at")))


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits=EDITS) -> DataFrame:
    """``doc_id, line_no, id, class`` of every line to drop.

    Documents without an id, null texts and blank lines take no part.  Rows that share an id are one document; equal lines at one
    place of it are one line.  ``edits`` may be empty: exact copies only.
    """
    repeated = line_classes(docs, key, text, edits).where("n > 1 or kept_at <> first")
    places = _lines(docs, key, text).select("doc_id", "line_no", "id")
    joined = places.join(repeated.select(F.col("id").alias("_id"), "class", "kept_at"), F.col("id") == F.col("_id"))
    elsewhere = (F.col("doc_id") != F.col("kept_at.doc_id")) | (F.col("line_no") != F.col("kept_at.line_no"))
    return joined.where(elsewhere).select("doc_id", "line_no", "id", "class")


def dedup_text(docs: DataFrame, dropped: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text``; a text may become empty.  All rows and columns stay.

    What lies between two dropped lines is kept as one slice, so the work follows the number of lines.
    """
    mark = F.struct("line_no", "id")
    marks = dropped.groupBy(F.col("doc_id").alias("__m_key")).agg(F.array_sort(F.collect_set(mark)).alias("__m_marks"))
    out = docs.join(marks, F.col(key) == F.col("__m_key"), "left").withColumn("__m_parts", F.split(F.col(text), "\n", -1))
    # A row may share its id with others; only what its own lines are is dropped from it.
    there = F.filter("__m_marks", lambda m: F.xxhash64(F.trim(F.get("__m_parts", m["line_no"]))) == m["id"])
    out = out.withColumn("__m_gone", F.transform(there, lambda m: m["line_no"]))
    before = lambda i: F.coalesce(F.get("__m_gone", i - 1), F.lit(-1))
    after = lambda i: F.coalesce(F.get("__m_gone", i), F.size("__m_parts"))
    slices = F.transform(F.sequence(F.lit(0), F.size("__m_gone")), lambda i: F.slice("__m_parts", before(i) + 2, after(i) - before(i) - 1))
    kept = F.array_join(F.flatten(slices), "\n")
    cut = F.when(F.col("__m_marks").isNull(), F.col(text)).otherwise(kept).alias(text)
    return out.select(*[cut if c == text else F.col(c) for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup takes out of every document: ``doc_id, n_lines, n_dropped, dropped``.

    ``dropped`` lists line numbers from 0, in order, joined by commas.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dropped_lines(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.sort_array(F.collect_set("line_no")).alias("_dropped"))
    count = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    rows = docs.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(count).alias("n_lines"))
    numbers = F.coalesce(F.array_join(F.col("_dropped").cast("array<string>"), ","), F.lit("")).alias("dropped")
    rows = rows.join(out, F.col("doc_id") == F.col("_id"), "left")
    return rows.select("doc_id", "n_lines", F.coalesce(F.size("_dropped"), F.lit(0)).alias("n_dropped"), numbers)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their repeated lines cut out but for the first of each; ``n_chars`` follows the text."""
    cut = dedup_text(docs, dropped_lines(docs))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


#: DuckDB counts edits in bytes, so accented letters become single bytes first.
_LETTERS = "áàâäãåçéèêëíìîïñóòôöõúùûüßœ"
_BYTES = " || ".join(f"chr({c})" for c in [*range(1, 9), *range(14, 33 - 1), 127][: len(_LETTERS)])
OP4_SQL = rf"""
WITH RECURSIVE lines AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, trim(parts[i]) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL), unnest(range(1, len(parts) + 1)) AS u(i)
  WHERE trim(parts[i]) <> ''),
known AS (
  SELECT line, row_number() OVER (ORDER BY line) AS id, length(line) AS n, first,
         CASE WHEN length(line) < 20 THEN 0 WHEN length(line) < 200 THEN 1 ELSE 2 END AS k,
         translate(line, '{_LETTERS}', {_BYTES}) AS plain
  FROM (SELECT line, min((doc_id, line_no)) AS first FROM lines GROUP BY line)),
segments AS (
  SELECT id, k, n, plain, i, substring(line, (i - 1) * (n // (k + 1)) + greatest(i - 1 - (k + 1 - n % (k + 1)), 0) + 1,
         n // (k + 1) + CASE WHEN i > k + 1 - n % (k + 1) THEN 1 ELSE 0 END) AS part
  FROM known, unnest([1, 2, 3]) AS u(i) WHERE k > 0 AND i <= k + 1),
asked AS (
  SELECT id, line, plain, n - d AS l, CASE WHEN n - d < 20 THEN 0 WHEN n - d < 200 THEN 1 ELSE 2 END AS k, s
  FROM known, unnest([0, 1, 2]) AS u(d), unnest([-2, -1, 0, 1, 2]) AS v(s) WHERE n - d >= 20),
probes AS (
  SELECT id, plain, l, i, substring(line, (i - 1) * (l // (k + 1)) + greatest(i - 1 - (k + 1 - l % (k + 1)), 0) + 1 + s,
         l // (k + 1) + CASE WHEN i > k + 1 - l % (k + 1) THEN 1 ELSE 0 END) AS part
  FROM asked, unnest([1, 2, 3]) AS u(i)
  WHERE i <= k + 1 AND (i - 1) * (l // (k + 1)) + greatest(i - 1 - (k + 1 - l % (k + 1)), 0) + 1 + s >= 1),
met AS (
  SELECT DISTINCT a.id AS a, b.id AS b, a.plain AS x, b.plain AS y, a.k
  FROM segments a JOIN probes b ON a.n = b.l AND a.i = b.i AND a.part = b.part AND a.id <> b.id),
near AS (SELECT a, b FROM met WHERE levenshtein(x, y) <= k),
edges AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach AS (SELECT DISTINCT a AS id, a AS other FROM edges UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other),
kept AS (
  SELECT k.line, coalesce(m.at, k.first) AS at
  FROM known k LEFT JOIN (SELECT r.id, min(o.first) AS at FROM reach r JOIN known o ON o.id = r.other GROUP BY r.id) m ON m.id = k.id),
gone AS (SELECT l.doc_id, l.line_no FROM lines l JOIN kept USING (line) WHERE (l.doc_id, l.line_no) <> kept.at),
per AS (SELECT doc_id, list_sort(list(DISTINCT line_no)) AS dropped FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(p.dropped), 0) AS INTEGER) AS n_dropped, coalesce(array_to_string(p.dropped, ','), '') AS dropped
FROM documents d LEFT JOIN per p USING (doc_id)
"""
