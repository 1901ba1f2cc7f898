"""Session helpers: where intermediate tables go and when a join side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Join sides up to this many rows are broadcast. The sides concerned are narrow
# (keys plus a few numbers), so this is tens of megabytes at most.
BROADCAST_ROWS = 200_000


def local_session(app: str = "tamiz", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    chosen = tempfile.mkdtemp(prefix="tamiz-")
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder."""
    return f"{shared_dir(spark)}/tamiz/{label}-{uuid.uuid4().hex[:12]}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage there.

    It is staged as Parquet, so later reads prune columns and push filters down.
    """
    spark = df.sparkSession
    path = work_dir(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all that was staged below the shared folder, for when no result is read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tamiz")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def join_side(df: DataFrame, limit: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """Compute a join side once; hint a broadcast only if its measured size allows it.

    Above the limit the plan is left to a shuffled join, where adaptive execution
    splits skewed partitions of the other side.
    """
    return small_side(checkpoint(df), limit, weight)


def small_side(
    staged: DataFrame, limit: int = BROADCAST_ROWS, weight: Column | None = None
) -> DataFrame:
    """The same for a side that is already staged. Rows count 1 each, or `weight` if their
    width varies."""
    size = staged.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0]
    return F.broadcast(staged) if (size or 0) <= limit else staged


def null_safe_join(
    left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a NULL key equals NULL, as it does in a grouping."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{c}" for c in columns])


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) columns that later filters must not compute again.

    A plain projection lets the optimizer copy its expressions into every filter that
    is pushed below it. A generator over one row is a border such filters stop at. The
    expressions themselves stay in a projection below it, where code generation shares
    their common parts; column pruning still works across the border.
    """
    kept = [F.col(c) for c in df.columns if c not in columns]
    hidden = {name: f"_once_{name}" for name in columns}
    ready = df.withColumns({hidden[name]: value for name, value in columns.items()})
    row = F.struct(*[F.col(hidden[name]).alias(name) for name in columns])
    return ready.select(*kept, F.inline(F.array(row)))
