"""Units, currencies, ratios and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.fixed_values import DENSITY_FACTOR, SQ_MI_TO_KM2
from tamiz.functions.text import strip_space

EARTH_RADIUS_KM = 6371.0


def area_km2(value: Column, unit: Column, factor: float = SQ_MI_TO_KM2) -> Column:
    """Square miles to km2; any other or missing unit already is km2."""
    miles = F.coalesce(F.lower(strip_space(unit)) == "sq_mi", F.lit(False))
    return F.round(F.when(miles, value * F.lit(factor)).otherwise(value), 3)


def round_even(value: Column, digits: int) -> Column:
    """Round in binary floating point with ties to even, as array libraries do."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def to_eur(value: Column, units_per_eur: Column) -> Column:
    return value / units_per_eur


def population_density(population: Column, area: Column) -> Column:
    return round_even(F.try_divide(population, area), 4)


def per_capita(total: Column, population: Column) -> Column:
    return round_even(F.try_divide(total, population), 2)


def energy_density(power: Column, population: Column, factor: int = DENSITY_FACTOR) -> Column:
    """Installed power per `factor` inhabitants."""
    return F.try_divide(power, population) * F.lit(factor)


def in_box(lat: Column, lon: Column, lat_range, lon_range) -> Column:
    return lat.between(*lat_range) & lon.between(*lon_range)


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    rise = F.radians(lat_b - lat_a) / 2
    run = F.radians(lon_b - lon_a) / 2
    chord = F.pow(F.sin(rise), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(
        F.sin(run), 2
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)
