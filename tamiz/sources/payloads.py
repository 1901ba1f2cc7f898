"""JSON payloads of public services: features, charging points, countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.fixed_values import DEFAULT_POWER_KW, UNNAMED_STATION
from tamiz.functions.text import country_key
from tamiz.operators.latest import keep_latest

POI_TYPE = (
    "struct<AddressInfo:struct<Title:string,Latitude:double,Longitude:double>,"
    "Connections:array<struct<PowerKW:double>>,DateCreated:string>"
)
COUNTRY_TYPE = "struct<name:struct<common:string>,population:bigint>"
POLYGON_FEATURE = (
    "type string, features array<struct<properties:map<string,string>,"
    "geometry:struct<type:string,coordinates:string>>>"
)


def parse_payload(text: Column, schema: str) -> Column:
    """A JSON array (or one object) of the given type; unreadable text gives NULL."""
    return F.from_json(text, f"array<{schema}>")


def usable_payload(items: Column) -> Column:
    return F.coalesce(F.size(items) > 0, F.lit(False))


def read_geojson(
    spark: SparkSession, path: str, name_property: str, multi_line: bool = True
) -> DataFrame:
    """(feature_name, rings): one row per feature, polygons and multipolygons alike."""
    features = (
        spark.read.schema(POLYGON_FEATURE)
        .json(path, multiLine=multi_line)
        .select(F.explode("features").alias("f"))
    )
    text, shape = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    single = F.from_json(text, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    vertex = lambda v: F.struct(v[0].alias("lon"), v[1].alias("lat"))
    rings = F.transform(
        F.when(shape == "MultiPolygon", multi).otherwise(single),
        lambda ring: F.transform(ring, vertex),
    )
    return features.select(
        F.col("f.properties")[name_property].alias("feature_name"), rings.alias("rings")
    )


def fastest_connector(powers: Column, default: float = DEFAULT_POWER_KW) -> Column:
    """Largest non-zero power; the default if there is none."""
    return F.coalesce(
        F.array_max(F.filter(powers, lambda p: p.isNotNull() & (p != 0))), F.lit(default)
    )


def charging_points(pois: DataFrame, poi: str = "poi") -> DataFrame:
    """(nombre, lat, lon, potencia_kw, fecha_creacion) from parsed points of interest."""
    p = F.col(poi)
    address = p["AddressInfo"]
    located = pois.filter(address["Latitude"].isNotNull() & address["Longitude"].isNotNull())
    return located.select(
        F.coalesce(address["Title"], F.lit(UNNAMED_STATION)).alias("nombre"),
        address["Latitude"].alias("lat"),
        address["Longitude"].alias("lon"),
        fastest_connector(F.transform(p["Connections"], lambda c: c["PowerKW"])).alias(
            "potencia_kw"
        ),
        p["DateCreated"].try_cast("timestamp").alias("fecha_creacion"),
    )


def country_populations(countries: DataFrame, order: str, country: str = "country") -> DataFrame:
    """(nombre_pais, poblacion_total) by normalised name; of equal names the last one counts."""
    c = F.col(country)
    usable = countries.filter((c["name"]["common"] != "") & c["population"].isNotNull())
    keyed = usable.select(
        country_key(c["name"]["common"]).alias("nombre_pais"),
        c["population"].alias("poblacion_total"),
        F.col(order).alias("_order"),
    )
    return keep_latest(keyed, ["nombre_pais"], [F.desc("_order")]).drop("_order")


def recent(df: DataFrame, time: str, reference: Column, days: int) -> DataFrame:
    """Rows at most `days` before the reference time, newest first."""
    since = reference - F.make_interval(days=F.lit(days))
    return df.filter(F.col(time) >= since).orderBy(F.desc(time))


def with_fallback(primary: DataFrame, fallback: DataFrame) -> tuple[DataFrame, str]:
    """The primary rows if there is at least one, else the seed rows; and the origin."""
    if primary.isEmpty():
        return fallback, "FALLBACK"
    return primary, "API"
