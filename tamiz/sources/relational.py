"""Relational tables, with a replica to fall back on, and literal seed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.fixed_values import (
    CITY_CATALOG,
    COUNTRY_POPULATION,
    COUNTRY_SYNONYMS,
    CURRENCY_PER_EUR,
    DISTRICTS,
    FALLBACK_STATIONS,
    PENINSULA_LAT,
    PENINSULA_LON,
)
from tamiz.functions.units import in_box

Tables = dict[str, DataFrame]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 2000,
    **options: str,
) -> DataFrame:
    """A full JDBC scan; with a numeric split column it runs as parallel range scans."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize=str(fetch_rows), **options
    )
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def read_parquet_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> Tables:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def read_first_available(
    sources: Mapping[str, Callable[[], Tables]],
) -> tuple[Tables, str]:
    """(tables, mode) of the first source that answers, in order.

    Readers are lazy, so each table is probed for one row before its source counts
    as available. If none answers, the last error is raised.
    """
    error: Exception | None = None
    for mode, read in sources.items():
        try:
            tables = read()
            for table in tables.values():
                table.limit(1).count()
            return tables, mode
        except Exception as failure:  # any reader or driver error moves on to the next source
            error = failure
    raise RuntimeError(f"no source available: {list(sources)}") from error


def row_totals(tables: Tables) -> DataFrame:
    """(table_name, rows) of every table."""
    totals = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        totals = one if totals is None else totals.unionByName(one)
    return totals


def city_catalog(spark: SparkSession, cities=CITY_CATALOG) -> DataFrame:
    return flag_in_box(spark.createDataFrame(cities, "ciudad string, lat double, lon double"))


def flag_in_box(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    inside = in_box(F.col(lat), F.col(lon), PENINSULA_LAT, PENINSULA_LON)
    return points.withColumn("en_peninsula", inside)


def catalog_problems(catalog: DataFrame, required: DataFrame) -> DataFrame:
    """(ciudad, problem): required cities that are missing, listed ones outside the box."""
    missing = required.select("ciudad").join(catalog.select("ciudad"), "ciudad", "left_anti")
    outside = catalog.filter(~F.col("en_peninsula")).select("ciudad")
    return missing.withColumn("problem", F.lit("missing")).unionByName(
        outside.withColumn("problem", F.lit("outside"))
    )


def currency_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CURRENCY_PER_EUR, "divisa string, tasa double")


def country_synonyms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_SYNONYMS, "variante string, canonico string")


def seed_populations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_POPULATION, "nombre_pais string, poblacion_total bigint")


def district_seed(spark: SparkSession) -> DataFrame:
    schema = "nombre_distrito string, poblacion_total bigint, renta_media_neta_persona bigint"
    return spark.createDataFrame(sorted(DISTRICTS), schema)


def fallback_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FALLBACK_STATIONS, "nombre string, lat double, lon double, potencia_kw double"
    )
