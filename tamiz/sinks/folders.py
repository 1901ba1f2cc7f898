"""Tables of bucket folders, switched by one small committed list.

Rows live in folders by key hash. A load writes the folders it changes beside the current ones, then
its change log, and last one file that names the folders that are current from then on. Readers follow
the newest such file, so a load that fails or is killed at any moment leaves content and log as they
were, and repeating it gives the same version.

All a load reads of the table are the folders of the buckets that the delivery touches. Each bucket
keeps a digest of its rows and of the delivery that changed it last: a bucket that a delivery
repeats is recognised by that, without reading rows. Only rows that are new or differ are written and logged.

Tables have one writer at a time. Keys compare as in a grouping: NULL equals NULL.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.operators.audit import log_rows
from tamiz.runtime import checkpoint, null_safe_join
from tamiz.sinks.tables import BUCKET, VERSION, duplicate_keys, folder_of, path_exists

COMMITS, DATA, CHANGES = "commits", "data", "changes"
# A bucket that consists of this many folders is rewritten as one.
MOST_FOLDERS = 16


@dataclass
class Folder:
    """What is current of one bucket: the versions that hold its rows, and digests."""

    versions: list[int]
    rows: int
    content: list[int]
    delivery: str


@dataclass
class Commit:
    version: int
    buckets: int
    keys: list[str]
    schema: str
    logged: bool
    folders: dict[int, Folder] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def current_commit(spark: SparkSession, path: str) -> Commit | None:
    """The newest committed list of folders, None before the first load."""
    folder, files = folder_of(spark, f"{path}/{COMMITS}")
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    newest = max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=None)
    if newest is None:
        return None
    raw = json.loads(spark.read.text(f"{path}/{COMMITS}/{newest}.json", wholetext=True).first()[0])
    raw["folders"] = {int(b): Folder(**held) for b, held in raw["folders"].items()}
    return Commit(**raw)


def _publish(spark: SparkSession, path: str, commit: Commit) -> None:
    """The list appears under its name at once, by a rename."""
    target, files = folder_of(spark, f"{path}/{COMMITS}/{commit.version}.json")
    if files.exists(target):
        raise RuntimeError(f"version {commit.version} of {path} was written by another load")
    draft, _ = folder_of(spark, f"{path}/{COMMITS}/{commit.version}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(asdict(commit)).encode()))
    out.close()
    if not files.rename(draft, target):
        raise RuntimeError(f"version {commit.version} of {path} could not be committed")


def folder_paths(path: str, commit: Commit, only: Iterable[int] | None = None) -> list[str]:
    chosen = commit.folders if only is None else [b for b in only if b in commit.folders]
    return [f"{path}/{DATA}/{VERSION}={v}/{BUCKET}={b}" for b in chosen for v in commit.folders[b].versions]


def read_folders(spark: SparkSession, path: str, only: Iterable[int] | None = None) -> DataFrame | None:
    """The current rows, of the buckets `only` if given; None before the first load."""
    commit = current_commit(spark, path)
    return None if commit is None else _rows(spark, path, commit, only)


def _rows(spark: SparkSession, path: str, commit: Commit, only: Iterable[int] | None) -> DataFrame:
    paths = folder_paths(path, commit, only)
    if not paths:
        return spark.createDataFrame([], commit.columns)
    return spark.read.schema(commit.columns).parquet(*paths)


def read_changes(spark: SparkSession, path: str) -> DataFrame | None:
    """The change log of all committed versions, None without one."""
    commit = current_commit(spark, path)
    if commit is None or not path_exists(spark, f"{path}/{CHANGES}"):
        return None
    return spark.read.parquet(f"{path}/{CHANGES}").filter(F.col(VERSION) <= commit.version)


def digest(columns: Sequence[Column], when: Column | None = None) -> list[Column]:
    """Aggregates that describe a multiset of rows whatever their order: two sums of row hashes.

    Sums of parts add up to that of the whole. NULL and its place in the row count.
    """
    flags = [c.isNull() for c in columns]
    hashes = [F.xxhash64(*columns, *flags), F.xxhash64(F.lit(1), *flags, *columns)]
    if when is not None:
        hashes = [F.when(when, h) for h in hashes]
    return [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"_d{i}") for i, h in enumerate(hashes)]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_folders(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int = 64,
    refreshed: dict[str, Column] | None = None,
    logged: bool = False,
) -> int:
    """Insert new keys, overwrite rows that differ; returns the current version.

    Columns the source lacks keep their value (NULL in new rows). `refreshed` columns are set on
    rows that are new or differ. A source with repeated keys is an error. With `logged`, every row written goes
    to the change log of its version, with both images.
    """
    if not duplicate_keys(source, keys).isEmpty():
        raise ValueError(f"the source repeats keys {list(keys)}")
    return _load(path, source, list(keys), buckets, refreshed or {}, logged, insert_only=False)


def insert_absent_folders(path: str, source: DataFrame, keys: Sequence[str], buckets: int = 64) -> int:
    """Add one row for every key that is not there yet, as further folders; old ones stay as they are."""
    return _load(path, source.dropDuplicates(list(keys)), list(keys), buckets, {}, False, insert_only=True)


def _load(
    path: str, source: DataFrame, keys: list[str], buckets: int, refreshed: dict[str, Column], logged: bool, insert_only: bool
) -> int:
    spark = source.sparkSession
    commit = current_commit(spark, path)
    if commit is None:
        schema = source.withColumns(refreshed).schema
        commit = Commit(0, buckets, keys, schema.json(), logged)
    names = _checked(commit, source, keys, buckets, refreshed, logged)
    arrived = source.select(*names).withColumn(BUCKET, bucket_of(keys, buckets))
    # One row a bucket, so no more than `buckets` of them.
    sums = arrived.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), *digest([F.col(c) for c in names])).collect()
    mode = "insert" if insert_only else "upsert"
    marks = {r[BUCKET]: json.dumps([mode, names, r["n"], int(r["_d0"]), int(r["_d1"])]) for r in sums}
    whole = len(names) == len(commit.columns.names)
    touched = []
    for r in sums:
        held = commit.folders.get(r[BUCKET])
        same = held is not None and whole and [held.rows, *held.content] == [r["n"], int(r["_d0"]), int(r["_d1"])]
        if held is None or not (same or held.delivery == marks[r[BUCKET]]):
            touched.append(r[BUCKET])
    if not touched and commit.version:
        return commit.version
    stored = _rows(spark, path, commit, touched)
    delta = checkpoint(_delta(stored, arrived.filter(F.col(BUCKET).isin(touched)), keys, names, refreshed, insert_only))
    columns = commit.columns.names
    old, new = ([F.col(f"{side}.{c}") for c in columns] for side in ("_old", "_new"))
    there = F.col("_old").isNotNull()
    gone = [d.alias(f"_g{i}") for i, d in enumerate(digest(old, there))]
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(there).alias("updates")]
    changed = delta.groupBy(BUCKET).agg(*counts, *digest(new), *gone).collect()
    if not changed and commit.version:
        return commit.version
    version = commit.version + 1
    folders, rewritten = dict(commit.folders), []
    for r in changed:
        held = folders.get(r[BUCKET], Folder([], 0, [0, 0], ""))
        rewrite = r["updates"] > 0 or len(held.versions) >= MOST_FOLDERS
        if rewrite and held.versions:
            rewritten.append(r[BUCKET])
        folders[r[BUCKET]] = Folder(
            [version] if rewrite else [*held.versions, version],
            held.rows + r["n"] - r["updates"],
            [held.content[i] + int(r[f"_d{i}"]) - int(r[f"_g{i}"]) for i in range(2)],
            marks[r[BUCKET]],
        )
    fresh = delta.select("_new.*", BUCKET)
    if rewritten:
        older = _rows(spark, path, commit, rewritten)
        kept = null_safe_join(older, fresh.select(*keys), keys, "left_anti")
        fresh = fresh.unionByName(kept.withColumn(BUCKET, bucket_of(keys, buckets)))
    spread = fresh.hint("rebalance", BUCKET)
    spread.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{DATA}/{VERSION}={version}")
    if commit.logged:
        shown = log_rows(delta, keys, columns)
        shown.write.mode("overwrite").parquet(f"{path}/{CHANGES}/{VERSION}={version}")
    _publish(spark, path, Commit(version, buckets, keys, commit.schema, commit.logged, folders))
    return version


def _checked(
    commit: Commit, source: DataFrame, keys: list[str], buckets: int, refreshed: dict[str, Column], logged: bool
) -> list[str]:
    """The source's columns in the table's order. Whatever would put equal keys into two buckets is refused."""
    if (commit.buckets, commit.keys, commit.logged) != (buckets, keys, logged):
        raise ValueError(f"the table has {commit.buckets} buckets of {commit.keys}, logged: {commit.logged}")
    kinds = {f.name: f.dataType.simpleString() for f in commit.columns}
    wrong = [f.name for f in source.schema if kinds.get(f.name) != f.dataType.simpleString()]
    wrong += [c for c in refreshed if c not in kinds] + [c for c in keys if c not in source.columns]
    if wrong:
        raise ValueError(f"columns that do not fit the table: {wrong}")
    return [c for c in kinds if c in source.columns and c not in refreshed]


def _delta(
    stored: DataFrame, arrived: DataFrame, keys: list[str], names: list[str], refreshed: dict[str, Column], insert_only: bool
) -> DataFrame:
    """_old (NULL for new keys) and _new image, and bucket, of rows that are new or differ."""
    held = stored.select(*keys, F.struct(*stored.columns).alias("_old"))
    came = arrived.select(*keys, BUCKET, F.struct(*names).alias("_in"))
    both = null_safe_join(came, held, keys, "left")
    before = F.struct(*[F.col(f"_old.{c}").alias(c) for c in names])
    absent = F.col("_old").isNull()
    wanted = absent if insert_only else absent | ~F.col("_in").eqNullSafe(before)

    def value(name: str) -> Column:
        if name in refreshed:
            return refreshed[name].cast(stored.schema[name].dataType)
        return F.col(f"_in.{name}") if name in names else F.col(f"_old.{name}")

    image = F.struct(*[value(c).alias(c) for c in stored.columns])
    return both.filter(wanted).select(BUCKET, "_old", image.alias("_new"))


def drop_unused(spark: SparkSession, path: str) -> int:
    """Delete the data folders of versions that nothing current refers to, for when no reader uses
    them; returns how many."""
    commit = current_commit(spark, path)
    used = {v for held in commit.folders.values() for v in held.versions} if commit else set()
    folder, files = folder_of(spark, f"{path}/{DATA}")
    dropped = 0
    for status in files.listStatus(folder) if commit else []:
        version = int(status.getPath().getName().split("=")[1])
        if version not in used:
            dropped += bool(files.delete(status.getPath(), True))
    return dropped
