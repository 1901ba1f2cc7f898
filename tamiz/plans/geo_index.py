"""District opportunity index from polygons, income, population and charging points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.fixed_values import DISTRICT_POPULATION_TOTAL, DISTRICTS, SEARCH_CENTRE, SEARCH_RADIUS_KM
from tamiz.functions.text import district_key
from tamiz.functions.units import haversine_km, round_even
from tamiz.operators.constraints import expectations, key_difference
from tamiz.operators.numbering import rank_positions
from tamiz.operators.scoring import min_max, opportunity_index
from tamiz.operators.spatial import (
    district_master,
    polygon_validity,
    power_by_district,
    split_by_polygon,
    within_join,
)
from tamiz.sinks.files import labelled_union
from tamiz.sources.payloads import charging_points, with_fallback
from tamiz.sources.relational import district_seed, fallback_stations

NAME = "nombre_distrito"


def keyed_districts(features: DataFrame) -> DataFrame:
    return features.select(district_key(F.col("feature_name")).alias(NAME), "rings")


def place_stations(
    stations: DataFrame, districts: DataFrame, cell: float = 0.01
) -> tuple[DataFrame, DataFrame]:
    """(stations with their district, quarantined stations outside all districts)."""
    placed = within_join(stations, districts, NAME, "lon", "lat", cell)
    return split_by_polygon(placed, NAME)


def district_index(districts: DataFrame, socio: DataFrame, placed: DataFrame) -> DataFrame:
    """Districts with density, both normalised measures and the index."""
    power = power_by_district(placed, socio, NAME, "potencia_kw")
    master = district_master(districts.select(NAME), socio, power, NAME)
    scaled = min_max(
        master,
        {"renta_media_neta_persona": "renta_norm", "densidad_energetica": "densidad_norm"},
    )
    return scaled.withColumn(
        "IOI", opportunity_index(F.col("renta_norm"), F.col("densidad_norm"))
    )


def run(
    features: DataFrame, pois: DataFrame | None, socio: DataFrame | None = None, cell: float = 0.01
) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """(index, placed stations, quarantined stations, origin of the stations).

    Without usable points of interest the seed stations are taken.
    """
    spark = features.sparkSession
    socio = district_seed(spark) if socio is None else socio
    stations, origin = fallback_stations(spark), "FALLBACK"
    if pois is not None:
        fetched = charging_points(pois).drop("fecha_creacion")
        stations, origin = with_fallback(fetched, stations)
    districts = keyed_districts(features)
    placed, outside = place_stations(stations, districts, cell)
    return district_index(districts, socio, placed), placed, outside, origin


def findings(
    districts: DataFrame,
    socio: DataFrame,
    stations: DataFrame,
    expected_districts: int = len(DISTRICTS),
    expected_population: int = DISTRICT_POPULATION_TOTAL,
    centre: tuple[float, float] = SEARCH_CENTRE,
    radius_km: float = SEARCH_RADIUS_KM,
) -> DataFrame:
    """(check_name, subject, detail) of all that is wrong with the inputs of a run; empty if nothing is.

    Polygons with open rings or rings that meet themselves; districts that only one side has or that a
    side repeats; numbers that differ from the expected ones; stations beyond the search radius or without a place.
    """

    def found(df: DataFrame, check: str, subject, detail) -> DataFrame:
        return df.select(F.lit(check).alias("check_name"), subject.alias("subject"), detail.alias("detail"))

    name = F.col(NAME)
    shapes = polygon_validity(districts, NAME).filter(~F.col("is_valid")).distinct()
    unlike = key_difference(districts, socio, NAME)
    figures = expectations(
        socio,
        {
            "districts": (F.count(F.lit(1)), expected_districts),
            "population": (F.coalesce(F.sum("poblacion_total"), F.lit(0)), expected_population),
        },
    ).filter(~F.col("passed"))
    distance = haversine_km(F.lit(centre[0]), F.lit(centre[1]), F.col("lat"), F.col("lon"))
    far = stations.filter(F.coalesce(distance > radius_km, F.lit(True)))
    nowhere = F.col("lat").isNull() | F.col("lon").isNull()
    numbers = [F.col(c).cast("bigint") for c in ("expected", "actual")]
    rows = [
        found(shapes, "polygon", name, F.when(F.col("is_closed"), "meets itself").otherwise("open ring")),
        found(unlike, "district", name, F.when(F.col("side") == "left", "no figures").otherwise("no polygon")),
        found(figures, "figure", F.col("expectation"), F.format_string("expected %d, found %d", *numbers)),
        found(far, "station", F.col("nombre"), F.when(nowhere, "no place").otherwise("outside the search radius")),
    ]
    for side, df in (("polygon", districts), ("figures", socio)):
        repeated = df.groupBy(NAME).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows.append(found(repeated, "district", name, F.lit(f"repeated {side}")))
    return reduce(DataFrame.unionByName, rows)


def checked_run(
    features: DataFrame, pois: DataFrame | None, socio: DataFrame | None = None, cell: float = 0.01
) -> tuple[tuple[DataFrame, DataFrame, DataFrame, str], DataFrame]:
    """(what `run` returns, findings about its inputs)."""
    socio = district_seed(features.sparkSession) if socio is None else socio
    result = run(features, pois, socio, cell)
    _, placed, outside, _ = result
    # A station in two polygons is placed twice.
    stations = placed.drop(NAME).distinct().unionByName(outside.drop("motivo_rechazo"))
    return result, findings(keyed_districts(features), socio, stations)


def unmatched_districts(index: DataFrame) -> DataFrame:
    """Districts for which the socio-economic table has no row."""
    return index.filter(F.col("poblacion_total").isNull()).select(NAME)


def result_table(index: DataFrame) -> DataFrame:
    """Ranking by index, rounded for display."""
    ranked = rank_positions(index, "IOI", NAME)
    rounded = [
        "densidad_energetica",
        "potencia_total_kw",
        "renta_norm",
        "densidad_norm",
        "IOI",
    ]
    return ranked.withColumns({c: round_even(F.col(c), 2) for c in rounded}).orderBy("position")


def station_export(valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """Valid and rejected stations as one labelled table."""
    both = labelled_union(
        valid.withColumnRenamed(NAME, "distrito"),
        rejected,
        {
            "valid": {"estado": "Valido"},
            "rejected": {"estado": "Cuarentena", "distrito": "Fuera de distrito"},
        },
    )
    columns = ["nombre", "distrito", "lat", "lon", "potencia_kw", "estado"]
    return both.select(*columns).orderBy("estado", "distrito", "nombre")
