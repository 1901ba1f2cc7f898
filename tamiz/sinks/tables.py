"""Repeatable loads: upserts, insert-if-absent, published versions, partition merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.operators.latest import keep_latest
from tamiz.runtime import null_safe_join

VERSION = "version"
BUCKET = "bucket"
BUCKET_MARKER = "_buckets_"
# Touched partitions named one by one in a scan filter; the join decides in any case.
MAX_LISTED = 1000


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    refreshed: dict[str, Column] | None = None,
    check: bool = True,
) -> DataFrame:
    """The target after inserting new keys and overwriting existing ones.

    Target columns the source lacks keep their value. `refreshed` columns are set on
    every written row. A source with repeated keys is an error, as in a database. NULL in a key
    equals NULL, so such a row is updated, not inserted again.
    """
    keys = list(keys)
    if check and not duplicate_keys(source, keys).isEmpty():
        raise ValueError(f"the source repeats keys {keys}")
    incoming = source.withColumns(refreshed or {})
    kept = [c for c in target.columns if c not in incoming.columns]
    if kept:
        incoming = null_safe_join(incoming, target.select(*keys, *kept), keys, "left")
    untouched = null_safe_join(target, source.select(*keys), keys, "left_anti")
    return untouched.unionByName(incoming.select(*target.columns))


def absent_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One source row per key that the target lacks (insert, ignore conflicts); NULL keys are equal."""
    fresh = source.dropDuplicates(list(keys))
    if target is None:
        return fresh
    return null_safe_join(fresh, target.select(*keys), keys, "left_anti")


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of a table, None before the first load."""
    newest = current_version(spark, path)
    if newest is None:
        return None
    return spark.read.parquet(f"{path}/{VERSION}={newest}")


def folder_of(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = folder_of(spark, path)
    return files.exists(folder)


def current_version(spark: SparkSession, path: str) -> int | None:
    """Highest version whose write was committed."""
    folder, files = folder_of(spark, path)
    if not files.exists(folder):
        return None
    versions = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{VERSION}=") and files.exists(marker):
            versions.append(int(name.split("=")[1]))
    return max(versions, default=None)


def publish(df: DataFrame, path: str) -> int:
    """Write the whole table as its next version; readers see it once it is complete.

    The version being read is never overwritten, so a failed or repeated task cannot
    lose data.
    """
    version = (current_version(df.sparkSession, path) or 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")
    return version


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest `keep` complete versions, for when no reader uses them."""
    newest = current_version(spark, path)
    folder, files = folder_of(spark, path)
    for status in files.listStatus(folder) if newest else []:
        name = status.getPath().getName()
        if name.startswith(f"{VERSION}=") and int(name.split("=")[1]) <= newest - keep:
            files.delete(status.getPath(), True)


def upsert_into(
    path: str, source: DataFrame, keys: Sequence[str], refreshed: dict[str, Column] | None = None
) -> DataFrame:
    """Upsert into the published table at `path` and return its new content."""
    spark = source.sparkSession
    target = read_current(spark, path)
    if target is None:
        first = source.withColumns(refreshed or {})
        if not duplicate_keys(source, keys).isEmpty():
            raise ValueError(f"the source repeats keys {list(keys)}")
        publish(first, path)
    else:
        publish(upsert(target, source, keys, refreshed), path)
    return read_current(spark, path)


def upsert_by_bucket(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int,
    refreshed: dict[str, Column] | None = None,
) -> None:
    """Upsert into a table stored in folders by key hash, rewriting only touched buckets.

    For targets much larger than a delivery. A table keeps the number of buckets it was
    first written with, which a marker beside the buckets remembers; another number is
    refused, as equal keys would then live in two buckets. Repeating a delivery changes
    nothing.
    """
    _remember_buckets(source.sparkSession, path, buckets)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    incoming = source.withColumns({**(refreshed or {}), BUCKET: bucket})
    if not duplicate_keys(incoming, keys).isEmpty():
        raise ValueError(f"the source repeats keys {list(keys)}")
    stored = existing_partitions(path, incoming, [BUCKET])
    merged = incoming if stored is None else upsert(stored, incoming, keys, check=False)
    overwrite_partitions(path, merged, [BUCKET])


def _remember_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    folder, files = folder_of(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    known = {int(n.removeprefix(BUCKET_MARKER)) for n in names if n.startswith(BUCKET_MARKER)}
    if known - {buckets}:
        raise ValueError(f"the table at {path} has {min(known)} buckets, not {buckets}")
    if not known:
        files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{BUCKET_MARKER}{buckets}"))


def append_absent(path: str, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the rows whose key is not there yet (a quarantine that never repeats)."""
    target = read_if_exists(source.sparkSession, path, source)
    absent_rows(target, source, keys).write.mode("append").parquet(path)
    return source.sparkSession.read.parquet(path)


def append(path: str, rows: DataFrame, **tags: Column) -> None:
    """Append without deduplication, with the given tag columns (run id, date, ...)."""
    rows.withColumns(tags).write.mode("append").parquet(path)


def read_if_exists(spark: SparkSession, path: str, like: DataFrame | None = None):
    """The stored rows, None if the folder is missing or holds no data file yet."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.schema(like.schema).parquet(path) if like else spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def merge_partitions(
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[Column],
    partitions: Sequence[str],
    rebuild: bool = False,
) -> None:
    """Latest-wins merge into a partitioned table, touching only the partitions concerned.

    Each touched partition is rewritten from its old rows and the incoming ones, one
    row per key; `rebuild` ignores the old rows. Repeating a merge changes nothing.
    """
    merged = incoming
    existing = None if rebuild else existing_partitions(path, incoming, partitions)
    if existing is not None:
        merged = incoming.unionByName(existing, allowMissingColumns=True)
    overwrite_partitions(path, keep_latest(merged, keys, newest_by), partitions)


def existing_partitions(path: str, incoming: DataFrame, partitions: Sequence[str]):
    """Stored rows of the partitions that `incoming` touches, None without a table.

    Partition values match NULL-safely. Up to MAX_LISTED partitions are also named in a
    filter, which prunes their folders.
    """
    stored = read_if_exists(incoming.sparkSession, path)
    if stored is None:
        return None
    # Folder names carry no types, so the partition columns take the incoming ones.
    typed = T.StructType(
        [incoming.schema[f.name] if f.name in partitions else f for f in stored.schema]
    )
    stored = incoming.sparkSession.read.schema(typed).parquet(path)
    touched = incoming.select(*partitions).distinct()
    named = touched.select(_folder(partitions)).limit(MAX_LISTED + 1).collect()
    if len(named) <= MAX_LISTED:
        stored = stored.filter(_folder(partitions).isin([row[0] for row in named]))
    return null_safe_join(stored, touched, partitions, "left_semi")


def _folder(partitions: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.col(p).cast("string") for p in partitions])


def overwrite_partitions(path: str, df: DataFrame, partitions: Sequence[str]) -> None:
    """Replace the partitions present in `df`, leave all others.

    Rows are spread over (partition, key hash) before writing, so a large partition is
    written by several tasks and a small one by few.
    """
    spread = df.hint("rebalance", *partitions)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partitions
    ).parquet(path)
