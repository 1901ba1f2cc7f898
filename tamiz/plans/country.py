"""Country indicators: noisy legacy reports to one row per country."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.fixed_values import SQ_MI_TO_KM2
from tamiz.functions.text import country_key, strip_space
from tamiz.functions.units import area_km2, to_eur
from tamiz.operators.audit import RUN_SCHEMA, run_finished, run_started
from tamiz.operators.consolidate import consolidate, indicators, translate_codes
from tamiz.operators.contract import first_reason, split_by_reason
from tamiz.runtime import checkpoint, computed_once
from tamiz.sinks.tables import append, read_current, upsert_into
from tamiz.sources.payloads import country_populations, with_fallback
from tamiz.sources.relational import country_synonyms, currency_rates, seed_populations

NOT_EUROPEAN = "Entidad territorial no perteneciente a la region europea"
BAD_GDP = "Valor de PIB incoherente (PIB <= 0)"
UNKNOWN_CURRENCY = "Error de transformacion: Divisa no soportada en la estructura de cambio: "
REPORT_COLUMNS = [
    "pais_nombre_local",
    "superficie_valor",
    "superficie_unidad",
    "pib_valor",
    "pib_divisa",
]


def clean_reports(
    reports: DataFrame,
    valid_countries: DataFrame | None = None,
    rates: DataFrame | None = None,
    synonyms: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). The first of region, GDP and currency to fail gives the reason.

    The default lookups are literal tables of a few dozen rows and are broadcast; for
    given ones the join strategy is left to the optimizer. `stage` may materialise the
    judged reports, from which both results are taken.
    """
    spark = reports.sparkSession

    def lookup(given: DataFrame | None, literal: DataFrame) -> DataFrame:
        return F.broadcast(literal) if given is None else given

    valid_countries = lookup(valid_countries, seed_populations(spark))
    rates = lookup(rates, currency_rates(spark))
    synonyms = lookup(synonyms, country_synonyms(spark))
    keyed = reports.select(*REPORT_COLUMNS, country_key(F.col("pais_nombre_local")).alias("_key"))
    named = translate_codes(keyed, "_key", synonyms, "variante", "canonico", "nombre_pais")
    known = valid_countries.select("nombre_pais", F.lit(True).alias("_known"))
    coded = (
        named.join(known, "nombre_pais", "left")
        .withColumn("divisa", F.upper(strip_space(F.coalesce("pib_divisa", F.lit("")))))
        .join(rates, "divisa", "left")
    )
    gdp = F.when(~F.isnan("pib_valor"), F.col("pib_valor"))
    reason = first_reason(
        [
            (F.col("_known").isNull(), F.lit(NOT_EUROPEAN)),
            (gdp.isNull() | (gdp <= 0), F.lit(BAD_GDP)),
            (F.col("tasa").isNull(), F.concat(F.lit(UNKNOWN_CURRENCY), "divisa")),
        ]
    )
    tagged = stage(computed_once(coded, {"motivo_rechazo": reason}))
    valid, rejected = split_by_reason(tagged)
    area = area_km2(F.col("superficie_valor"), F.col("superficie_unidad"), SQ_MI_TO_KM2)
    valid = valid.select(
        "nombre_pais",
        area.alias("superficie_km2"),
        to_eur(F.col("pib_valor"), F.col("tasa")).alias("pib_total_eur"),
    )
    originals = {
        "pais_nombre_local": "pais_original",
        "superficie_valor": "superficie_valor_orig",
        "superficie_unidad": "superficie_unidad_orig",
        "pib_valor": "pib_valor_orig",
        "pib_divisa": "pib_divisa_orig",
    }
    rejected = rejected.select(*REPORT_COLUMNS, "motivo_rechazo").withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("superficie_valor", "pib_valor")}
    )
    rejected = rejected.withColumnsRenamed(originals)
    return valid, rejected


def populations(countries: DataFrame | None, order: str = "position") -> tuple[DataFrame, str]:
    """(population per country, origin) from parsed payload rows, or the seed table."""
    seed = seed_populations(SparkSession.active())
    if countries is None:
        return seed, "FALLBACK"
    return with_fallback(country_populations(countries, order), seed)


def country_indicators(
    valid: DataFrame, population: DataFrame, origin: str
) -> tuple[DataFrame, DataFrame]:
    """(indicators, countries without population) from valid reports."""
    figures = consolidate(valid, "nombre_pais", "superficie_km2", "pib_total_eur")
    return indicators(
        figures, population, "nombre_pais", "superficie_km2", "pib_total_eur", F.lit(origin)
    )


def as_stored(found: DataFrame) -> DataFrame:
    """The target table's columns and decimal types."""
    return found.select(
        "nombre_pais",
        "poblacion_total",
        F.col("superficie_km2").cast("decimal(14,3)"),
        F.col("pib_total_eur").cast("decimal(20,2)"),
        F.col("densidad_poblacional").cast("decimal(12,4)"),
        F.col("pib_per_capita_eur").cast("decimal(14,2)"),
        "fuente_poblacion",
    )


def load(
    reports: DataFrame, population: DataFrame, origin: str, tables: str, run_id: int
) -> DataFrame:
    """The whole run: clean, consolidate, upsert, quarantine, audit. Returns the target."""
    spark, started = reports.sparkSession, datetime.now()
    runs = f"{tables}/tb_ejecuciones_etl"
    row = run_started(spark, run_id, started)
    upsert_into(runs, row, ["id_ejecucion"])
    try:
        valid, rejected = clean_reports(reports, stage=checkpoint)
        found = checkpoint(country_indicators(valid, population, origin)[0])
        target = upsert_into(
            f"{tables}/tb_indicadores_europa",
            as_stored(found),
            ["nombre_pais"],
            {"fecha_actualizacion": F.current_timestamp()},
        )
        append(
            f"{tables}/tb_cuarentena_geodatos",
            rejected,
            id_ejecucion=F.lit(run_id),
            fecha_insercion=F.current_timestamp(),
        )
        errors, loaded = rejected.count(), found.count()
        read = valid.count() + errors
        done = run_finished(row, datetime.now(), read, loaded, errors, origin)
        upsert_into(runs, done, ["id_ejecucion"])
        return target
    except Exception as error:
        failed = run_finished(row, datetime.now(), error=str(error))
        upsert_into(runs, failed, ["id_ejecucion"])
        raise


def last_run(spark, tables: str) -> DataFrame:
    runs = read_current(spark, f"{tables}/tb_ejecuciones_etl")
    runs = spark.createDataFrame([], RUN_SCHEMA) if runs is None else runs
    return runs.orderBy(F.desc("id_ejecucion")).limit(1)


def richest(found: DataFrame, n: int = 10) -> DataFrame:
    return found.orderBy(F.desc("pib_per_capita_eur"), "nombre_pais").limit(n)
