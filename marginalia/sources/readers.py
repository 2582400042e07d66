"""Readers: markup, nested JSON, logs, columnar JSON and small dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Attributes: double-quoted, single-quoted, unquoted or bare.  Repeats are possessive and stop at a ``<``, so no page is walked twice.
ATTRIBUTE = r"""(?s)([^\s/<>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s<>"'][^\s<>]*+)))?+"""
_BODY = r"""(?:[\s/=]++|[^\s/<>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>"'][^\s<>]*+))?+)*+"""
TAG = rf"(?is)<[a-z][^\s/<>]*+{_BODY}>"
#: Elements whose content is text, whatever it looks like (fixed values).
RAW_TEXT = "script|style|textarea|title|xmp|iframe|noembed|noframes"
#: In this order at each place: a comment, another declaration or an end tag, a raw-text element up to its end, any other tag.
MARKUP = rf"(?is)<!--.*?(?:-->|\z)|<[!?/][^<>]*+>|(<({RAW_TEXT})(?=[\s/>]){_BODY}>).*?(?:</\2(?=[\s/>])[^<>]*+>|\z)|(<[a-z][^\s/<>]*+{_BODY}>)"
PAGE_WORDS = "verses array<struct<verse_key:string,juz_number:int,words:array<struct<position:int,char_type_name:string,line_number:int,text:string>>>>"
COLUMNAR = "fields array<string>, rows array<array<string>>"


def scan_markup(df: DataFrame, key: str, html: str, tags: list[str] | None = None) -> DataFrame:
    """Every element of a page in document order: ``(key, ordinal, tag, class, attrs)``.

    One ordered alternation walks the page, so that what looks like a tag inside a comment, a quoted value or a raw-text element
    isn't one; comments and raw text without an end reach to the end of the page.  Tag and attribute names are lower-cased; a bare
    attribute has an empty value, of a repeated one the first counts, and values keep their entities.  A tag without its ``>``, or with
    a ``<`` outside of quotes, is text.
    Null pages have no elements.
    """
    page = df.where(F.col(html).isNotNull()).select(key, F.regexp_replace(html, MARKUP, " $1$3 ").alias("_h"))
    e = page.select(key, F.posexplode(F.regexp_extract_all("_h", F.lit(TAG), F.lit(0))).alias("ordinal", "_t"))
    e = e.withColumn("tag", F.lower(F.regexp_extract("_t", r"^<([^\s/>]+)", 1)))
    if tags:
        e = e.where(F.col("tag").isin(*tags))
    body = F.regexp_extract("_t", r"(?s)^<[^\s/>]+(.*)>$", 1)
    e = e.select(key, "ordinal", "tag", *[F.regexp_extract_all(body, F.lit(ATTRIBUTE), F.lit(g)).alias(f"_g{g}") for g in range(1, 5)])
    names = F.transform("_g1", F.lower)
    pairs = F.arrays_zip(names.alias("k"), F.col("_g2").alias("a"), F.col("_g3").alias("b"), F.col("_g4").alias("c"))
    first = F.filter(pairs, lambda x, i: F.array_position(names, x["k"]) == i + 1)
    attrs = F.map_from_entries(F.transform(first, lambda x: F.struct(x["k"], F.concat(x["a"], x["b"], x["c"]))))
    return e.withColumn("attrs", attrs).select(key, "ordinal", "tag", F.try_element_at("attrs", F.lit("class")).alias("class"), "attrs")


def scan_nested_json(spark: SparkSession, path: str, schema: str = PAGE_WORDS) -> DataFrame:
    """Page files ``verses[].words[]`` -> one row per word; items that aren't words are dropped."""
    return explode_words(spark.read.schema(schema).json(path, multiLine=True))


def explode_words(pages: DataFrame) -> DataFrame:
    v = pages.select(F.explode("verses").alias("v"))
    w = v.select("v.verse_key", "v.juz_number", F.explode("v.words").alias("w"))
    return w.where("w.char_type_name = 'word'").select("verse_key", "juz_number", "w.position", "w.line_number", "w.text")


def read_log(spark: SparkSession, path: str, schema: str | StructType, on_bad: str = "skip", stream: bool = False) -> DataFrame:
    """S3: a JSON-lines log; malformed lines are skipped, or raise with ``on_bad='fail'``; ``stream`` reads it as a stream."""
    mode = {"skip": "DROPMALFORMED", "fail": "FAILFAST"}[on_bad]
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("mode", mode).json(path)


def columnar_unpack(df: DataFrame, column: str, wanted: dict[str, str]) -> DataFrame:
    """``{fields, rows}`` JSON -> one row per entry with the wanted columns (name -> type), found by name, never by place."""
    d = df.select(F.from_json(column, COLUMNAR).alias("c")).select("c.fields", F.explode("c.rows").alias("r"))
    at = lambda n: F.try_element_at("r", F.nullif(F.array_position("fields", n), F.lit(0)).cast("int"))
    return d.select(*[at(n).cast(t).alias(n) for n, t in wanted.items()])


def read_dim_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated dimension; blank lines and lines that begin with # are skipped."""
    first = schema.split(",")[0].split()[0]
    return spark.read.schema(schema).csv(path, sep="\t", comment="#", mode="DROPMALFORMED").where(F.col(first).isNotNull())
