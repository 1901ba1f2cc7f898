"""Run audit and row-level change log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.rows import row_json
from tamiz.functions.units import elapsed_seconds

RUN_SCHEMA = (
    "id_ejecucion bigint, fecha_inicio timestamp_ntz, fecha_fin timestamp_ntz, "
    "registros_leidos bigint, registros_insertados bigint, registros_error bigint, "
    "origen string, estado string, observaciones string"
)


def run_started(spark: SparkSession, run_id: int, started: datetime) -> DataFrame:
    row = (run_id, started, None, 0, 0, 0, None, "EN_PROCESO", None)
    return spark.createDataFrame([row], RUN_SCHEMA)


def run_finished(
    started: DataFrame,
    ended: datetime,
    read: int = 0,
    inserted: int = 0,
    errors: int = 0,
    origin: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """The started row completed: OK with its duration, or ERROR with the message."""
    # As text, so that no session time zone shifts it.
    end = F.lit(ended.isoformat(sep=" ")).cast("timestamp_ntz")
    seconds = elapsed_seconds(F.col("fecha_inicio"), end)
    note = F.lit(error) if error else F.format_string("Duracion: %d s", seconds)
    return started.withColumns(
        {
            "fecha_fin": end,
            "registros_leidos": F.lit(read).cast("long"),
            "registros_insertados": F.lit(inserted).cast("long"),
            "registros_error": F.lit(errors).cast("long"),
            "origen": F.lit(origin).cast("string"),
            "estado": F.lit("ERROR" if error else "OK"),
            "observaciones": note,
        }
    )


def change_log(
    before: DataFrame,
    after: DataFrame,
    key: str,
    user: str | Column = "current_user",
    at: Column | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """INSERT / UPDATE / DELETE between two snapshots, with both images as JSON.

    Rows that did not change are not logged, unless their key is in `touched` (an
    upsert that rewrites equal values still counts as an update there).
    """
    columns = before.columns
    old = before.select(key, F.struct(*columns).alias("_old"))
    new = after.select(key, F.struct(*columns).alias("_new"))
    both = old.join(new, key, "full")
    changed = ~F.col("_old").eqNullSafe(F.col("_new"))
    if touched is not None:
        marks = touched.select(key).distinct().withColumn("_touched", F.lit(True))
        both = both.join(marks, key, "left")
        changed = changed | F.coalesce(F.col("_touched"), F.lit(False))
    return log_rows(both.filter(changed), [key], columns, user, at)


def log_rows(
    changed: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    user: str | Column = "current_user",
    at: Column | None = None,
) -> DataFrame:
    """Log entries of changed rows, given as images `_old` and `_new` (NULL where there is none)."""
    operation = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("_new").isNull(), "DELETE")
        .otherwise("UPDATE")
    )

    def image(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), row_json(*[f"{name}.{c}" for c in columns]))

    def key(name: str) -> Column:
        return F.when(F.col("_new").isNull(), F.col(f"_old.{name}")).otherwise(F.col(f"_new.{name}"))

    return changed.select(
        operation.alias("operacion"),
        *[key(k).alias(k) for k in keys],
        image("_old").alias("datos_anteriores"),
        image("_new").alias("datos_nuevos"),
        (F.expr(f"{user}()") if isinstance(user, str) else user).alias("usuario_bd"),
        (F.current_timestamp() if at is None else at).alias("fecha_operacion"),
    )


def replay_log(steps: Sequence[tuple[DataFrame, DataFrame]], key: str, **options) -> DataFrame:
    """Change logs of consecutive snapshots, numbered by step."""
    logs = [
        change_log(a, b, key, **options).withColumn("step", F.lit(i))
        for i, (a, b) in enumerate(steps, 1)
    ]
    result = logs[0]
    for log in logs[1:]:
        result = result.unionByName(log)
    return result
