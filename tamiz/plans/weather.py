"""Weather medallion: raw envelopes to a clean hourly table to three marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.fixed_values import (
    BATCH_ORIGINS,
    CITY_CATALOG,
    HOURLY_VARIABLES,
    MOVING_AVERAGE_ROWS,
    VALID_RANGES,
)
from tamiz.functions.rows import new_batch
from tamiz.operators.contract import Contract, Rule, split_by_reason
from tamiz.operators.latest import keep_latest, newest_first
from tamiz.operators.partials import ROWS, merged, moments, part, partials
from tamiz.operators.timeseries import daily_summary, moving_average, zscore, zscore_against
from tamiz.runtime import checkpoint, null_safe_join
from tamiz.sinks.files import land_envelopes
from tamiz.sinks.folders import current_commit, digest, read_folders, upsert_folders
from tamiz.sinks.tables import append, append_absent, existing_partitions, merge_partitions, overwrite_partitions
from tamiz.sources.envelope import (
    DOCUMENT_BREAK,
    arbitrate_origin,
    as_envelopes,
    envelopes_of,
    existing_batches,
    flatten_envelopes,
    has_series,
    newest_usable,
    split_envelopes,
)
from tamiz.sources.relational import catalog_problems, flag_in_box
from tamiz.streaming.incremental import stream_merge

KEYS = ["ciudad", "fecha_hora_utc"]
PARTITIONS = ["ciudad", "anio", "mes"]
NEWEST = ("timestamp_ingesta_utc", "id_lote")
QUARANTINE = "_cuarentena"
SHOWN_PROBLEMS = 20
# Summaries per city and day, kept beside the clean table.
PARTIALS = "_parciales"
DAY = ["ciudad", "fecha"]
MEASURES = ["temperature_2m", "precipitation", "wind_speed_10m"]
DIGESTS = ["huella_0", "huella_1"]
UNUSABLE = "_documentos_rechazados"
# A file stream forgets files older than this, counted from the newest one: none may be.
ANY_AGE = "36500d"


def hourly_contract(
    cities: Sequence[str] = tuple(name for name, _, _ in CITY_CATALOG),
    ranges: dict[str, tuple[float, float]] = VALID_RANGES,
) -> Contract:
    return Contract(
        [
            Rule("ciudad", allowed=cities),
            Rule("fecha_hora_utc", "timestamp_ntz"),
            *[Rule(v, "double", between=ranges[v]) for v in HOURLY_VARIABLES],
            Rule("id_lote"),
            Rule("origen", allowed=BATCH_ORIGINS),
            Rule("timestamp_ingesta_utc"),
        ]
    )


def ingest(
    requested: DataFrame,
    fetched: DataFrame,
    raw: str,
    batch: tuple[str, str] | None = None,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Land one envelope per city from fetched bodies or the newest earlier ones.

    With a catalog (ciudad, lat, lon), requested cities that it lacks and listed ones outside
    the peninsula are an error. Returns the summary (ciudad, origen, ...) of the batch.
    """
    batch_id, stamp = batch or new_batch()
    spark = requested.sparkSession
    if catalog is not None:
        problems = catalog_problems(flag_in_box(catalog), requested).take(SHOWN_PROBLEMS)
        if problems:
            raise ValueError("catalog: " + ", ".join(f"{p.ciudad} {p.problem}" for p in problems))
    # Only cities without a usable body need what landed before; if there is none, no file is opened.
    answered = fetched.filter(has_series(F.col("datos_api"))).select("ciudad")
    waiting = [r.ciudad for r in requested.select("ciudad").distinct().join(answered, "ciudad", "left_anti").collect()]
    landed, _ = newest_usable(spark, raw, waiting)
    summary = checkpoint(arbitrate_origin(requested, fetched, landed.drop("ciudad"), batch_id, stamp))
    land_envelopes(as_envelopes(summary), raw)
    return summary.select("ciudad", "origen", "id_lote", "timestamp_ingesta_utc")


def with_period(clean: DataFrame) -> DataFrame:
    return clean.withColumns({"anio": F.year("fecha_hora_utc"), "mes": F.month("fecha_hora_utc")})


def clean(raw_rows: DataFrame, contract: Contract | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of flattened rows."""
    return (contract or hourly_contract()).split(raw_rows)


def load_clean(
    raw: str,
    silver: str,
    contract: Contract | None = None,
    rebuild: bool = False,
    since: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Newest landed batch of every city into the partitioned clean table.

    Day folders are searched newest first until every city has a usable batch; `since` limits the
    search to the folders from that day. Returns (valid, quarantine) of this run; rejected rows accumulate. Documents
    met on the way that could not be used at all are filed beside them, each once.
    """
    newest, unusable = newest_usable(SparkSession.active(), raw, since=since)
    append_absent(f"{silver}/{UNUSABLE}", unusable, ["path", "documento"])
    rows = flatten_envelopes(newest)
    # Judged once; the merge reads the valid rows twice and the quarantine the others.
    valid, rejected = split_by_reason(checkpoint((contract or hourly_contract()).tag(rows)))
    merge_partitions(silver, with_period(valid), KEYS, newest_first(*NEWEST), PARTITIONS, rebuild)
    append(f"{silver}/{QUARANTINE}", rejected)
    return valid, rejected


def reload_cities(requested: DataFrame, raw: str, silver: str, contract: Contract | None = None) -> DataFrame:
    """Load the requested cities from what has landed; (ciudad, path, origen) tells what was found."""
    names = [r.ciudad for r in requested.select("ciudad").distinct().collect()]
    newest, _ = newest_usable(requested.sparkSession, raw, names)
    valid, rejected = split_by_reason(
        checkpoint((contract or hourly_contract()).tag(flatten_envelopes(newest)))
    )
    merge_partitions(silver, with_period(valid), KEYS, newest_first(*NEWEST), PARTITIONS)
    append(f"{silver}/{QUARANTINE}", rejected)
    return existing_batches(requested, newest.drop("ciudad"))


def stream_clean(
    raw: str,
    silver: str,
    checkpoint: str,
    contract: Contract | None = None,
    files_per_batch: int = 10_000,
    max_file_age: str = ANY_AGE,
):
    """The same load as a stream over all raw files not yet taken, however old they are.

    Documents that cannot be used are filed per batch with their reason; the others go on.
    """
    files = (
        SparkSession.active()
        .readStream.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_file_age)
        .option("lineSep", DOCUMENT_BREAK)
        .text(raw)
    )

    def split(batch: DataFrame, batch_id: int):
        usable, unusable = split_envelopes(batch)
        unusable.write.mode("overwrite").parquet(f"{silver}/{UNUSABLE}/batch={batch_id}")
        valid, rejected = clean(flatten_envelopes(usable), contract)
        return with_period(valid), rejected

    return stream_merge(
        envelopes_of(files),
        split,
        silver,
        f"{silver}/{QUARANTINE}",
        KEYS,
        newest_first(*NEWEST),
        PARTITIONS,
        checkpoint,
    )


def daily_mart(hourly: DataFrame) -> DataFrame:
    return daily_summary(
        hourly, "ciudad", "fecha_hora_utc", "temperature_2m", "precipitation", "wind_speed_10m"
    ).withColumnsRenamed(
        {
            "level_mean": "temperatura_media_c",
            "level_min": "temperatura_minima_c",
            "level_max": "temperatura_maxima_c",
            "total_sum": "precipitacion_total_mm",
            "mean_mean": "viento_medio_kmh",
        }
    )


def moving_average_mart(hourly: DataFrame, rows: int = MOVING_AVERAGE_ROWS) -> DataFrame:
    return moving_average(
        hourly.select("ciudad", "fecha_hora_utc", "temperature_2m"),
        "ciudad",
        ["fecha_hora_utc"],
        "temperature_2m",
        rows,
        f"media_movil_{rows}h_c",
    )


def zscore_mart(hourly: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Scores against the history of the hours, or one that is at hand (`city_history`)."""
    chosen = hourly.select("ciudad", "fecha_hora_utc", "temperature_2m")
    if history is None:
        scored = zscore(chosen, "ciudad", "temperature_2m")
    else:
        scored = zscore_against(chosen, history, "ciudad", "temperature_2m")
    return scored.withColumnsRenamed(
        {
            "history_mean": "media_historica_c",
            "history_std": "desviacion_historica_c",
            "z_score": "z_score_temperatura",
        }
    )


def day_rows(silver: str, days: DataFrame) -> DataFrame | None:
    """Clean hours of the given (ciudad, fecha); only folders of their months are read, None without a table."""
    first, last = days.agg(F.min("fecha"), F.max("fecha")).first()
    months = days.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    stored = existing_partitions(silver, months, PARTITIONS)
    if stored is None:
        return None
    hour = F.col("fecha_hora_utc")
    between = (hour >= F.lit(str(first)).cast("timestamp_ntz")) & (hour < F.lit(f"{last} 23:59:59.999999").cast("timestamp_ntz"))
    dated = stored.filter(between).withColumn("fecha", F.to_date(hour))
    return null_safe_join(dated, days, DAY, "left_semi")


def refresh_partials(silver: str, loaded: DataFrame, rebuild: bool = False) -> int:
    """Bring the summaries up to date after `loaded` rows were merged into the clean table.

    Latest-wins merges replace rows, so the days that the rows touch are summarised anew, from their
    own rows; all other days keep what is stored. After a `rebuild` every known day of the touched months counts as
    touched, and one without rows is kept with a count of 0. Days whose rows did not change are recognised by a
    digest and not written. Repeating it, also after a failure, changes nothing; returns the version.
    """
    spark = loaded.sparkSession
    path = f"{silver}/{PARTIALS}"
    known = read_folders(spark, path)
    days = loaded.select("ciudad", F.to_date("fecha_hora_utc").alias("fecha")).distinct()
    if rebuild and known is not None:
        month = F.trunc("fecha", "month").alias("_mes")
        months = days.select("ciudad", month).distinct()
        earlier = null_safe_join(known.select(*DAY, month), months, ["ciudad", "_mes"], "left_semi")
        days = days.unionByName(earlier.drop("_mes")).distinct()
    days = checkpoint(days)
    commit = current_commit(spark, path)
    rows = None if days.isEmpty() else day_rows(silver, days)
    if rows is None:
        return commit.version if commit else 0
    marks = [d.alias(name) for d, name in zip(digest([F.col(c) for c in ("fecha_hora_utc", *MEASURES)]), DIGESTS)]
    sums = null_safe_join(days, partials(rows, DAY, MEASURES, marks), DAY, "left").fillna({ROWS: 0})
    if known is not None:
        same = [*DAY, ROWS, *DIGESTS]
        sums = null_safe_join(sums, known.select(*same), same, "left_anti")
    return upsert_folders(path, checkpoint(sums), DAY)


def read_partials(silver: str) -> DataFrame:
    """The summary of every day that has rows."""
    return read_folders(SparkSession.active(), f"{silver}/{PARTIALS}").filter(F.col(ROWS) > 0)


def daily_from_partials(days: DataFrame) -> DataFrame:
    """The daily mart, without reading an hour."""
    temperature, rain, wind = MEASURES
    return days.select(
        *DAY,
        F.col(part(temperature, "mean")).alias("temperatura_media_c"),
        F.col(part(temperature, "min")).alias("temperatura_minima_c"),
        F.col(part(temperature, "max")).alias("temperatura_maxima_c"),
        F.col(part(rain, "sum")).alias("precipitacion_total_mm"),
        F.col(part(wind, "mean")).alias("viento_medio_kmh"),
    )


def city_history(days: DataFrame) -> DataFrame:
    """(ciudad, history_mean, history_std) of the temperature, merged from the days."""
    whole = merged(days, ["ciudad"], MEASURES[:1])
    return moments(whole, ["ciudad"], MEASURES[0], "history_mean", "history_std")


def marts(hourly: DataFrame) -> dict[str, DataFrame]:
    return {
        "resumen_diario": daily_mart(hourly),
        "media_movil_temp": moving_average_mart(hourly),
        "zscore_horario": zscore_mart(hourly),
    }


def load_marts(silver: str, gold: str) -> dict[str, DataFrame]:
    """Recompute and replace the three marts, one folder per city."""
    spark = SparkSession.active()
    hourly = spark.read.parquet(silver)
    for name, mart in marts(hourly).items():
        overwrite_partitions(f"{gold}/{name}", mart, ["ciudad"])
    return {name: spark.read.parquet(f"{gold}/{name}") for name in marts_names()}


def marts_names() -> list[str]:
    return ["resumen_diario", "media_movil_temp", "zscore_horario"]


def cities(daily: DataFrame) -> DataFrame:
    return daily.select("ciudad").distinct().orderBy("ciudad")


def last_day(daily: DataFrame, city: str | None = None) -> DataFrame:
    """Figures of the last available day, for one city (folder pruned) or for each."""
    chosen = daily.filter(F.col("ciudad") == city) if city else daily
    return keep_latest(chosen, ["ciudad"], newest_first("fecha"))
