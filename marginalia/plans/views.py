"""The given tables and views of them, for Spark and, as text, for DuckDB."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.session import ship

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ACTIONS = {"click": "approve", "error": "reject", "purchase": "amend", "signup": "withdraw", "view": "edit"}


#: Rows of order lines, and documents, that a task takes at most on average.
LINES_A_TASK, DOCUMENTS_A_TASK = 250_000, 1_000


class Tables:
    """``t.lineitem`` and the like read a given table; views are derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship(spark)
        self.spark, self.dir, self._counted = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def dealt(self, df: DataFrame, key: str, table: str, most: int) -> DataFrame:
        """``df`` by ``key`` in tasks of about ``most`` rows of ``table``, at least as many as Spark makes by itself: a task's share doesn't
        grow with the input, and windows, groups and joins by the key need no further shuffle."""
        usual = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(max(usual, -(-self._rows(table) // most)), key)

    def _rows(self, table: str) -> int:
        if table not in self._counted:
            self._counted[table] = getattr(self, table).count()
        return self._counted[table]

    def by_order(self, df: DataFrame, key: str = "grp") -> DataFrame:
        """Order lines, or rows of them, dealt by another key."""
        return self.dealt(df, key, "lineitem", LINES_A_TASK)

    def _tokens(self, documents: DataFrame) -> DataFrame:
        lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "_l"))
        return lines.select("doc_id", "line_no", F.posexplode(F.filter(F.split("_l", " "), lambda x: x != "")).alias("pos", "token"))

    @cached_property
    def tok(self) -> DataFrame:
        """Documents as tokens: doc_id, line_no, pos, token (places from 0)."""
        return self._tokens(self.documents)

    @cached_property
    def tok_by_doc(self) -> DataFrame:
        """The same, dealt by document before the texts are split, so that what goes on by document shuffles no tokens."""
        return self._tokens(self.dealt(self.documents.select("doc_id", "text"), "doc_id", "documents", DOCUMENTS_A_TASK))

    @cached_property
    def li(self) -> DataFrame:
        """Order lines with a row number in their order that depends on all columns, as the given key isn't unique."""
        return self._numbered(self.lineitem)

    @cached_property
    def li_by_order(self) -> DataFrame:
        """The same, dealt by order in tasks of bounded size; for queries that need the number, as lines are shuffled in any case."""
        return self._numbered(self.by_order(self.lineitem, "l_orderkey"))

    def _numbered(self, lines: DataFrame) -> DataFrame:
        return lines.withColumn("rid", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)).cast("long"))

    @cached_property
    def ivl(self) -> DataFrame:
        """Order lines as boxes: grp, rid, owner, fam, line, x0, x1, y0, y1."""
        return self._boxes(self.li)

    @cached_property
    def ivl_by_order(self) -> DataFrame:
        return self._boxes(self.li_by_order)

    def _boxes(self, li: DataFrame) -> DataFrame:
        r4 = lambda e: F.round(F.expr(e), 4)
        return li.select(
            F.col("l_orderkey").alias("grp"), "rid", F.col("l_partkey").alias("owner"), F.col("l_returnflag").alias("fam"), F.col("l_linenumber").cast("long").alias("line"),
            r4("l_quantity").alias("x0"), r4("l_quantity + 1 + l_discount * 100").alias("x1"), r4("l_tax * 100").alias("y0"), r4("l_tax * 100 + 1 + l_linenumber").alias("y1"),
        )

    @cached_property
    def log(self) -> DataFrame:
        """Events as a review log: id, seq, ts (microseconds), action, page, step."""
        action = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])[F.col("event_type")]
        return self.events.select(
            F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), action.alias("action"),
            F.pmod(F.floor("value"), F.lit(7)).cast("long").alias("page"), F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd").alias("step"), "value",
        )

    @cached_property
    def form(self) -> DataFrame:
        return self._forms(self.li)

    @cached_property
    def form_by_order(self) -> DataFrame:
        return self._forms(self.li_by_order)

    def _forms(self, li: DataFrame) -> DataFrame:
        return li.select(F.col("l_partkey").alias("form"), F.col("l_orderkey").alias("grp"), "rid", F.col("l_linenumber").cast("long").alias("n"), F.floor(F.col("l_quantity") / 10).alias("runs"))

    @cached_property
    def src_a(self) -> DataFrame:
        d = self.lineitem.where("l_shipdate < '1998-01-01'").groupBy(F.col("l_orderkey").alias("k"))
        return d.agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amt_a"), F.count(F.lit(1)).alias("n"))

    @cached_property
    def src_b(self) -> DataFrame:
        return self.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.round("o_totalprice", 2).alias("amt_b"))

    @cached_property
    def shape(self) -> DataFrame:
        pts = F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.struct(F.element_at("embedding", (2 * i - 1).cast("int")).cast("double").alias("x"), F.element_at("embedding", (2 * i).cast("int")).cast("double").alias("y")))
        return self.embeddings.select("vec_id", "label", pts.alias("points"))

    @cached_property
    def dict(self) -> DataFrame:
        """Words of part names: term, rule."""
        return self.part.select(F.explode(F.split("p_name", " ")).alias("term")).distinct().withColumn("rule", F.concat(F.lit("r-"), "term"))


#: The same views for DuckDB.
DUCK = {
    "tok": """SELECT doc_id, line_no, CAST(p - 1 AS BIGINT) AS pos, toks[p] AS token FROM (
      SELECT doc_id, CAST(l - 1 AS BIGINT) AS line_no, list_filter(string_split(ls[l], ' '), lambda x: x <> '') AS toks
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(l)), unnest(range(1, len(toks) + 1)) AS w(p)""",
    "li": """SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rid FROM lineitem""",
    "ivl": """SELECT l_orderkey AS grp, rid, l_partkey AS owner, l_returnflag AS fam, CAST(l_linenumber AS BIGINT) AS line, round(l_quantity, 4) AS x0,
      round(l_quantity + 1 + l_discount * 100, 4) AS x1, round(l_tax * 100, 4) AS y0, round(l_tax * 100 + 1 + l_linenumber, 4) AS y1 FROM li""",
    "log": """SELECT user_id AS id, event_id AS seq, epoch_us(ts) AS ts, CASE event_type WHEN 'click' THEN 'approve' WHEN 'error' THEN 'reject' WHEN 'purchase' THEN 'amend' WHEN 'signup' THEN 'withdraw' WHEN 'view' THEN 'edit' END AS action,
      CAST(floor(value) AS BIGINT) % 7 AS page, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS step, value FROM events""",
    "form": "SELECT l_partkey AS form, l_orderkey AS grp, rid, CAST(l_linenumber AS BIGINT) AS n, CAST(floor(l_quantity / 10) AS BIGINT) AS runs FROM li",
    "src_a": "SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt_a, count(*) AS n FROM lineitem WHERE l_shipdate < '1998-01-01' GROUP BY 1",
    "src_b": "SELECT o_orderkey AS k, round(o_totalprice, 2) AS amt_b FROM orders WHERE o_orderstatus <> 'P'",
    "shape": "SELECT vec_id, label, [{'x': CAST(embedding[2*i-1] AS DOUBLE), 'y': CAST(embedding[2*i] AS DOUBLE)} for i in range(1, 33)] AS points FROM embeddings",
    "dict": "SELECT term, 'r-' || term AS rule FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part)",
}
NEEDS = {"ivl": ["li"], "form": ["li"]}


def duck(sql: str, *views: str) -> str:
    """A query with the views it names in front of it."""
    names: list[str] = []
    for v in views:
        for n in [*NEEDS.get(v, []), v]:
            if n not in names:
                names.append(n)
    head = ",\n".join(f"{n} AS ({DUCK[n]})" for n in names)
    if not names:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head},\n{body[14:]}"
    return f"WITH {head},\n{body[4:]}" if body.upper().startswith("WITH ") else f"WITH {head}\n{body}"
