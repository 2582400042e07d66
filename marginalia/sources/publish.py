"""Writers and publication: deterministic partitions, manifests, incremental work, versions and the index chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators.aggregates import first_seen, group_summary
from marginalia.operators.common import counts, stored
from marginalia.operators.gates import behind, check, gate


def row_json(df: DataFrame, digits: int = 2) -> Column:
    """A row as compact JSON: keys sorted, floats rounded to ``digits``."""
    rounded = [F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in sorted(df.dtypes)]
    return F.to_json(F.struct(*rounded))


def write_partitioned(df: DataFrame, by: str, order: list[str], path: str) -> None:
    """One file per partition value with sorted JSON rows; the same input gives the same bytes."""
    rows = df.select(F.col(by).alias(f"{by}_"), F.struct(*order).alias("_o"), row_json(df).alias("value"))
    rows.repartition(f"{by}_").sortWithinPartitions(f"{by}_", "_o", "value").select(f"{by}_", "value").write.partitionBy(f"{by}_").text(path)


def manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """``(name, bytes, sha256)`` of every file under a path."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("name")


def digest(row: Column) -> Column:
    """SHA-256 over the sorted digests of a group's rows, so no group's text is held whole."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(F.sha2(row, 256))), "\n"), 256).alias("digest")


def manifest(df: DataFrame, group: str, row: Column) -> DataFrame:
    """A digest per group of rows."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), digest(row))


def incremental_todo(every: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Keys with no stored result; all of them with ``force``."""
    keys = every.select(key).distinct()
    return keys if force else keys.join(done.select(key), key, "left_anti")


def version_key(version: Column) -> Column:
    return F.transform(F.split(version, r"\."), lambda x: x.cast("int"))


def latest_version(versions: DataFrame, version: str = "version") -> DataFrame:
    """The highest version in natural order."""
    return versions.agg(F.max_by(version, version_key(F.col(version))).alias("latest"))


def publish_version(df: DataFrame, root: str, version: str) -> bool:
    """Write a version once (it is never overwritten); tells whether ``latest`` moves forward to it."""
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
    spark = df.sparkSession
    try:
        known = spark.read.json(f"{root}/latest")
        latest = latest_version(known.select("version").unionByName(spark.createDataFrame([(version,)], "version string"))).first()[0]
    except Exception as e:  # no pointer yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        latest = version
    if latest == version:
        spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(f"{root}/latest")
    return latest == version


def build_index(words: DataFrame, page: str, entity: str, key: str, order: list[str]) -> dict[str, DataFrame]:
    """The publish chain over a word table: page summaries, an entity index, a digest per page, the gate over all of them, and what is
    ``published`` behind it: the pages with their digests and the number of entities that are ``first_seen`` there.  What is to be published
    is written aside first (``spark.checkpoint.dir``), so that the gate looks at the same rows."""
    rows = F.concat_ws("\t", *[F.col(c).cast("string") for c in sorted(words.columns)])
    # One grouping for all that is by page, so that texts are split once for it.
    pages = group_summary(words, page, key, order, entity, F.count(key).alias("keys"), F.count(rows).alias("rows"), digest(rows))
    index = first_seen(words, entity, [page, *order], [page, key])
    whole = pages.drop("kinds").join(counts(index, page, n="_seen"), page, "left")
    whole = stored(whole.withColumn("first_seen", F.coalesce("_seen", F.lit(0))).drop("_seen"), "index")
    verdict = gate([check(whole, "page and key present", F.col(page).isNull() | (F.col("keys") < F.col("n"))), check(whole, "page has rows", F.col("n") == 0)])
    digests = pages.select(page, "rows", "digest")
    return {"pages": pages, "index": index, "manifest": digests, "gate": verdict, "published": behind(verdict, whole.drop("keys", "rows"))}


def profiles_differ(full: DataFrame, small: DataFrame, key: str, shared: str) -> DataFrame:
    """Keys (unique in each) of two published profiles whose ``shared`` column differs, or that one of them lacks, as ``(key, what)``."""
    # A sum of 256 bits for each text: values themselves needn't be shuffled.
    print_ = lambda: F.coalesce(F.sha2(F.col(shared).cast("string").cast("binary"), 256), F.lit("null"))
    a, b = full.select(F.col(key).alias("_ka"), print_().alias("_a")), small.select(F.col(key).alias("_kb"), print_().alias("_b"))
    j = a.join(b, F.col("_ka") == F.col("_kb"), "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    what = F.when(F.col("_b").isNull(), "full only").when(F.col("_a").isNull(), "small only").otherwise("differs")
    return j.select(F.coalesce("_ka", "_kb").alias(key), what.alias("what"))


def profile_projection(df: DataFrame, drop: list[str], key: str, shared: str, root: str) -> tuple[DataFrame, DataFrame]:
    """Publish ``df`` and its profile without some columns under ``root``; the small one as read again, and where the two differ."""
    df.write.mode("overwrite").parquet(f"{root}/full")
    df.drop(*drop).write.mode("overwrite").parquet(f"{root}/small")
    full, small = (df.sparkSession.read.parquet(f"{root}/{n}") for n in ("full", "small"))
    return small, profiles_differ(full, small, key, shared)
