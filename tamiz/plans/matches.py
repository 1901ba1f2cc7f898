"""Match statistics: a delimited file to players, matches and one fact per pair."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.fixed_values import EXCLUDED_COUNTRIES
from tamiz.functions import parse
from tamiz.functions.rows import key_values
from tamiz.functions.text import capitalise, split_first, trim_columns
from tamiz.operators.contract import first_reason
from tamiz.operators.star import fact_rows, insert_new_members
from tamiz.runtime import checkpoint, computed_once
from tamiz.sinks.files import write_staging
from tamiz.sinks.folders import insert_absent_folders, read_folders, upsert_folders
from tamiz.sinks.tables import append, read_if_exists
from tamiz.sources.delimited import read_staged, read_text_table

SOURCE_COLUMNS = ["jugador_equipo", "partido", "goles", "asistencias", "fecha_partido"]
PLAYER_KEY = ["nombre_jugador", "pais"]
MATCH_KEY = ["equipo_local", "equipo_visitante", "fecha_partido"]
MEASURES = ["goles", "asistencias"]
FACT_BUCKETS = 16
ERROR_BUCKETS = 16
STAGED_TYPES = (
    "nombre_jugador string, pais string, equipo_local string, equipo_visitante string, "
    "fecha_partido date, goles int, asistencias int"
)
ERROR_TYPES = "motivo_rechazo string, tabla_origen string, datos_raw string, fecha_deteccion date"
CONVERSION_REASON = "RF-04: error de conversion de fecha (fila descartada por seguridad)"


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.lower(text).contains(word)
    return found


def tag_rows(raw: DataFrame, excluded: Sequence[str] = EXCLUDED_COUNTRIES) -> DataFrame:
    """Split, type and judge every row in one projection chain.

    A failed conversion comes before every other reason; after it the rules apply in
    order: player or country empty, excluded country, date layout, match layout.
    """
    kept = raw.select(*SOURCE_COLUMNS, *[F.col(c).alias(f"_{c}") for c in SOURCE_COLUMNS])
    kept = trim_columns(kept, *SOURCE_COLUMNS)
    player, match = split_first(F.col("jugador_equipo"), "-"), split_first(F.col("partido"), " vs ")
    split = kept.withColumns(
        {
            "nombre_jugador": player["left"],
            "pais": player["right"],
            "equipo_local": match["left"],
            "equipo_visitante": match["right"],
            "_candidate": parse.iso_candidate(F.col("fecha_partido")),
        }
    )
    typed = split.withColumns(
        {
            "pais": capitalise(F.col("pais")),
            # A month or day that cannot be fails the cast; the range check is cheaper.
            "_date": parse.in_calendar_range(F.col("_candidate")).try_cast("date"),
            "_goals": F.col("goles").try_cast("int"),
            "_assists": parse.count_or_zero(F.col("asistencias")),
        }
    )
    failed_cast = (
        (F.col("_candidate").isNotNull() & F.col("_date").isNull())
        | F.col("_goals").isNull()
        | F.col("_assists").isNull()
    )
    country = F.col("pais")
    reason = first_reason(
        [
            (failed_cast, F.lit(CONVERSION_REASON)),
            (
                ~player["found"] | (F.col("nombre_jugador") == "") | (country == ""),
                F.concat(F.lit("RF-01: jugador o pais vacio en '"), "jugador_equipo", F.lit("'")),
            ),
            (
                F.lower(country).isin(list(excluded)) | _contains_any(F.col("partido"), excluded),
                F.format_string("RF-03: pais fuera del mundial (%s / %s)", country, F.col("partido")),
            ),
            (
                parse.in_calendar_range(F.col("_candidate")).isNull(),
                F.concat(F.lit("RF-04: formato de fecha no reconocido: "), "fecha_partido"),
            ),
            (
                ~match["found"],
                F.concat(F.lit("Formato de partido no reconocido: "), "partido"),
            ),
        ]
    )
    return computed_once(typed, {"motivo_rechazo": reason})


def stage_rows(tagged: DataFrame) -> DataFrame:
    """The valid rows, typed, as they are staged."""
    return tagged.filter(F.col("motivo_rechazo").isNull()).select(
        "nombre_jugador",
        "pais",
        "equipo_local",
        "equipo_visitante",
        F.col("_date").alias("fecha_partido"),
        F.col("_goals").alias("goles"),
        F.col("_assists").alias("asistencias"),
    )


def error_file(tagged: DataFrame, source: str, detected: date | None = None) -> DataFrame:
    """The rejected rows with their source, reason and original text."""
    stamp = F.current_date() if detected is None else F.lit(detected)
    return tagged.filter(F.col("motivo_rechazo").isNotNull()).select(
        "motivo_rechazo",
        F.lit(source).alias("tabla_origen"),
        key_values({c: F.col(f"_{c}") for c in SOURCE_COLUMNS}).alias("datos_raw"),
        stamp.alias("fecha_deteccion"),
    )


def _grow(path: str, staged: DataFrame, key: list[str], id: str) -> DataFrame:
    """Append the members the dimension lacks; without any, nothing is written."""
    spark = staged.sparkSession
    known = read_if_exists(spark, path)
    new = insert_new_members(known, staged, key, id)
    if known is None or not new.isEmpty():
        append(path, new)
    return spark.read.parquet(path)


def _merge_facts(path: str, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert the facts that are new or differ; only the buckets they belong to are read."""
    upsert_folders(path, facts, keys, FACT_BUCKETS)
    return read_folders(facts.sparkSession, path)


def load(staged: DataFrame, errors: DataFrame, target: str) -> dict[str, DataFrame]:
    """Grow both dimensions, upsert the facts, file new errors. A rerun changes nothing.

    The staged rows are materialised once, as three tables are built from them.
    """
    staged = checkpoint(staged)
    players = _grow(f"{target}/dim_jugadores", staged, PLAYER_KEY, "jugador_id")
    matches = _grow(f"{target}/dim_partidos", staged, MATCH_KEY, "partido_id")
    facts = fact_rows(
        staged, [(players, PLAYER_KEY, "jugador_id"), (matches, MATCH_KEY, "partido_id")], MEASURES
    )
    stored = _merge_facts(f"{target}/fact_estadisticas", facts, ["jugador_id", "partido_id"])
    quarantine = f"{target}/tb_errores_migracion"
    insert_absent_folders(quarantine, errors, ["tabla_origen", "datos_raw", "motivo_rechazo"], ERROR_BUCKETS)
    filed = read_folders(staged.sparkSession, quarantine)
    return {
        "dim_jugadores": players,
        "dim_partidos": matches,
        "fact_estadisticas": stored,
        "tb_errores_migracion": filed,
    }


def run(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """The whole load from the delimited file: staging files, star tables, run audit."""
    started = datetime.now()
    tagged = checkpoint(tag_rows(read_text_table(spark, source, SOURCE_COLUMNS, ";")))
    staging, rejects = f"{target}/staging/estadisticas", f"{target}/staging/errores"
    write_staging(stage_rows(tagged), staging)
    write_staging(error_file(tagged, source.rstrip("/").rsplit("/", 1)[-1]), rejects)
    load(
        read_staged(spark, staging, STAGED_TYPES),
        read_staged(spark, rejects, ERROR_TYPES),
        target,
    )
    valid = F.count_if(F.col("motivo_rechazo").isNull())
    read = tagged.agg(F.count(F.lit(1)).alias("n"), valid.alias("ok")).first()
    counts = {
        "registros_leidos": read["n"],
        "registros_insertados": read["ok"],
        "registros_error": read["n"] - read["ok"],
    }
    times = spark.createDataFrame(
        [(started, datetime.now())], "fecha_inicio timestamp, fecha_fin timestamp"
    )
    append(f"{target}/tb_ejecuciones_etl", times, **{k: F.lit(v) for k, v in counts.items()})
    return counts
