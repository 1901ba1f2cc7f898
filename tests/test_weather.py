"""Hourly contract, marts, raw landing and fallback."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tamiz.operators.contract import split_by_reason
from tamiz.plans import weather
from tamiz.runtime import work_dir
from tamiz.sinks.files import land_envelopes
from tamiz.sinks.tables import read_if_exists
from tamiz.sources import relational
from tamiz.sources.envelope import (
    as_envelopes,
    body_type,
    existing_batches,
    flatten_envelopes,
    latest_batch,
    read_envelopes,
)

RAW = (
    "ciudad string, fecha_hora_utc string, temperature_2m string, relative_humidity_2m double, "
    "precipitation double, wind_speed_10m double, surface_pressure double, id_lote string, "
    "origen string, timestamp_ingesta_utc string"
)
# An hour of our own making; only the column names have to be these.
GOOD_HOUR = ("Bilbao", "2026-03-08T17:00", "11.4", 71.5, 0.3, 6.25, 987.0, "b7", "FALLBACK", "2026-03-09T05:00:00+00:00")


def raw(spark, *changes):
    columns = [c.split()[0] for c in RAW.split(", ")]
    rows = [tuple(c.get(name, value) for name, value in zip(columns, GOOD_HOUR)) for c in changes]
    return spark.createDataFrame(rows, RAW)


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"temperature_2m": "999.0"}, "temperature_2m: in_range(-50.0, 60.0)"),
        ({"temperature_2m": "abc"}, "temperature_2m: not_nullable"),
        ({"temperature_2m": "NaN"}, "temperature_2m: not_nullable"),
        ({"relative_humidity_2m": 150.0}, "relative_humidity_2m: in_range(0.0, 100.0)"),
        ({"precipitation": -1.0}, "precipitation: in_range(0.0, 1000.0)"),
        ({"fecha_hora_utc": "yesterday"}, "fecha_hora_utc: not_nullable"),
        ({"origen": "OTRO"}, "origen: isin(['API', 'FALLBACK'])"),
        (
            {"ciudad": "CiudadInventada", "wind_speed_10m": -5.0},
            "ciudad: isin(['Madrid', 'Barcelona', 'Valencia', 'Sevilla', 'Bilbao']); "
            "wind_speed_10m: in_range(0.0, 400.0)",
        ),
    ],
)
def test_bad_rows_are_quarantined_with_all_reasons(spark, change, reason):
    valid, rejected = weather.clean(raw(spark, {}, change))
    assert valid.count() == 1
    assert [r.motivo_rechazo for r in rejected.collect()] == [reason]


def test_range_ends_and_extra_columns_are_accepted(spark):
    rows = raw(spark, {"temperature_2m": "-50"}, {"temperature_2m": "60"}).withColumn("nota", F.lit("x"))
    valid, rejected = weather.clean(rows)
    assert valid.count() == 2 and rejected.count() == 0
    assert "nota" in valid.columns


def test_no_row_is_lost(spark):
    changes = [{"fecha_hora_utc": f"2026-01-01T{h:02d}:00"} for h in range(5)]
    changes[2]["temperature_2m"], changes[4]["wind_speed_10m"] = "-999", -5.0
    valid, rejected = split_by_reason(weather.hourly_contract().tag(raw(spark, *changes)))
    assert (valid.count(), rejected.count()) == (3, 2)


def test_missing_contract_column_is_an_error(spark):
    with pytest.raises(ValueError, match="origen"):
        weather.clean(raw(spark, {}).drop("origen"))


def series(spark):
    start = dt.datetime(2026, 2, 1)
    rows = [("X", start + dt.timedelta(hours=i), 10.0 + (i % 24) * 0.5, 1.0, 5.0) for i in range(48)]
    return spark.createDataFrame(
        rows,
        "ciudad string, fecha_hora_utc timestamp_ntz, temperature_2m double, precipitation double, wind_speed_10m double",
    )


def test_marts_match_hand_calculation(spark):
    marts = weather.marts(series(spark))
    days = marts["resumen_diario"].orderBy("fecha").collect()
    assert len(days) == 2
    assert days[0].temperatura_media_c == 15.75
    assert (days[0].temperatura_minima_c, days[0].temperatura_maxima_c) == (10.0, 21.5)
    assert days[0].precipitacion_total_mm == 24.0
    moving = marts["media_movil_temp"].orderBy("fecha_hora_utc").toPandas()
    expected = moving.temperature_2m.rolling(24, min_periods=1).mean()
    assert (moving.media_movil_24h_c.round(6) == expected.round(6)).all()
    scores = marts["zscore_horario"].toPandas()
    assert abs(scores.z_score_temperatura.mean()) < 1e-9
    assert abs(scores.z_score_temperatura.std(ddof=0) - 1) < 1e-6
    assert scores.loc[scores.temperature_2m.idxmin(), "z_score_temperatura"] < 0


def test_constant_series_scores_zero(spark):
    flat = series(spark).withColumn("temperature_2m", F.lit(4.0))
    assert {r.z_score_temperatura for r in weather.zscore_mart(flat).collect()} == {0.0}


def hourly_value(i, lat):
    angle = (i % 24) / 24 * 2 * math.pi
    return {
        "temperature_2m": round(26 - (lat - 37) * 0.9 + 6 * math.sin(angle - math.pi / 2) + (i // 24) * 0.05, 1),
        "relative_humidity_2m": round(60 + 20 * math.cos(angle), 1),
        "precipitation": round(max(0, math.sin(i / 17)) * 0.8, 2),
        "wind_speed_10m": round(8 + 4 * math.sin(i / 11) ** 2, 1),
        "surface_pressure": round(1015 + 3 * math.sin(i / 29), 1),
    }


def bodies(spark, cities, hours=336, shift=0.0):
    start, rows = dt.datetime(2026, 1, 25), []
    for city, lat, _ in cities:
        values = [hourly_value(i, lat - shift) for i in range(hours)]
        times = [(start + dt.timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(hours)]
        rows.append((city, ({"time": times, **{k: [v[k] for v in values] for k in (values[0] if values else hourly_value(0, 0))}},)))
    schema = spark.createDataFrame([], "ciudad string").schema.add("datos_api", body_type())
    return spark.createDataFrame(rows, schema)


def test_ingest_clean_and_marts_end_to_end(spark):
    catalog = relational.city_catalog(spark)
    cities = [tuple(r)[:3] for r in catalog.collect()]
    raw_path, silver, gold = (work_dir(spark, n) for n in ("raw", "silver", "gold"))
    first = weather.ingest(catalog, bodies(spark, cities), raw_path, ("aaaaaaaaaaaa", "2026-01-25T08:00:00+00:00"))
    assert {r.origen for r in first.collect()} == {"API"}
    weather.load_clean(raw_path, silver)
    tables = weather.load_marts(silver, gold)
    assert {k: v.count() for k, v in tables.items()} == {
        "resumen_diario": 70,
        "media_movil_temp": 1680,
        "zscore_horario": 1680,
    }
    assert [r.ciudad for r in weather.cities(tables["resumen_diario"]).collect()] == sorted(c for c, _, _ in cities)
    assert weather.last_day(tables["resumen_diario"], "Madrid").first().fecha == dt.date(2026, 2, 7)

    # A second run with warmer values wins; one city's body is empty and falls back.
    warmer = bodies(spark, [c for c in cities if c[0] != "Bilbao"], shift=1.0).unionByName(
        bodies(spark, [c for c in cities if c[0] == "Bilbao"], hours=0)
    )
    second = weather.ingest(catalog, warmer, raw_path, ("bbbbbbbbbbbb", "2026-01-26T08:00:00+00:00"))
    origins = {r.ciudad: r.origen for r in second.collect()}
    assert origins.pop("Bilbao") == "FALLBACK" and set(origins.values()) == {"API"}
    weather.load_clean(raw_path, silver)
    weather.load_clean(raw_path, silver)
    hourly = spark.read.parquet(silver)
    assert hourly.count() == 1680
    assert [r.id_lote for r in hourly.select("id_lote").distinct().collect()] == ["bbbbbbbbbbbb"]
    assert {r.origen for r in hourly.filter("ciudad = 'Bilbao'").select("origen").distinct().collect()} == {"FALLBACK"}


def test_no_data_is_invented(spark):
    raw_path = work_dir(spark, "raw")
    requested = spark.createDataFrame([("Nowhere",)], "ciudad string")
    summary = weather.ingest(requested, bodies(spark, []).limit(0), raw_path, ("b", "2026-01-01T00:00:00+00:00"))
    assert [r.origen for r in summary.collect()] == ["SIN_DATOS"]
    assert read_if_exists(spark, raw_path) is None


def test_newest_batch_goes_by_embedded_time(spark):
    raw_path = work_dir(spark, "raw")
    requested = spark.createDataFrame([("Madrid",), ("Lugo",)], "ciudad string")
    madrid = [("Madrid", 40.4, -3.7)]
    # The batch id that sorts last is the older one.
    for batch, stamp in (("zzz", "2026-01-01T00:00:00+00:00"), ("aaa", "2026-01-02T00:00:00+00:00")):
        weather.ingest(requested, bodies(spark, madrid, 2), raw_path, (batch, stamp))
    landed = read_envelopes(spark, [raw_path])
    assert [r.metadata.id_lote for r in latest_batch(landed).collect()] == ["aaa"]
    later = read_envelopes(spark, [raw_path], since="2026-01-02")
    assert later.count() == 1 and later.columns == landed.columns
    found = {r.ciudad: r.origen for r in existing_batches(requested, landed).collect()}
    assert found == {"Madrid": "BRONZE_EXISTENTE", "Lugo": "SIN_DATOS"}


def test_unequal_arrays_are_an_error(spark):
    doc = '{"hourly":{"time":["2026-01-01T00:00"],"temperature_2m":[1.0,2.0]}}'
    body = F.from_json(F.lit(doc), "struct<hourly:struct<time:array<string>,temperature_2m:array<double>>>")
    meta = F.from_json(F.lit('{"ciudad":"X"}'), "struct<id_lote:string,timestamp_ingesta_utc:string,ciudad:string,origen:string>")
    rows = spark.range(1).select(meta.alias("metadata"), body.alias("datos_api"))
    with pytest.raises(Exception, match="hourly arrays differ in length: X"):
        flatten_envelopes(rows, ["temperature_2m"]).collect()


def test_no_envelopes_give_no_rows(spark):
    assert flatten_envelopes(read_envelopes(spark, [])).count() == 0


def test_single_document_files(spark):
    path = work_dir(spark, "docs")
    doc = '{\n "metadata": {"ciudad": "X", "id_lote": "b"},\n "datos_api": {"hourly": {"time": ["t"], ' + ", ".join(
        f'"{v}": [1.0]' for v in weather.HOURLY_VARIABLES
    ) + "}}\n}"
    spark.createDataFrame([(doc,)], "value string").write.text(path)
    rows = flatten_envelopes(read_envelopes(spark, [path])).collect()
    assert [(r.ciudad, r.fecha_hora_utc, r.surface_pressure) for r in rows] == [("X", "t", 1.0)]


def test_stream_equals_batch_and_survives_a_rerun(spark):
    raw_path, silver, state = (work_dir(spark, n) for n in ("raw", "silver", "state"))
    cities = [tuple(r)[:3] for r in relational.city_catalog(spark).collect()]
    envelope = bodies(spark, cities, 48).selectExpr(
        "'API' AS origen", "ciudad", "'b1' AS id_lote", "'2026-01-25T00:00:00' AS timestamp_ingesta_utc", "datos_api"
    )
    land_envelopes(as_envelopes(envelope), raw_path)
    for _ in range(2):
        weather.stream_clean(raw_path, silver, state, files_per_batch=2).awaitTermination()
    columns = ["ciudad", "fecha_hora_utc", "temperature_2m"]
    streamed = spark.read.parquet(silver).select(*columns).toPandas()
    batch, _ = weather.clean(flatten_envelopes(read_envelopes(spark, [raw_path])))
    expected = batch.select(*columns).toPandas()
    key = ["ciudad", "fecha_hora_utc"]
    pd.testing.assert_frame_equal(
        streamed.sort_values(key, ignore_index=True).astype({"ciudad": str}),
        expected.sort_values(key, ignore_index=True).astype({"ciudad": str}),
    )


def test_catalog(spark):
    catalog = relational.city_catalog(spark)
    assert relational.catalog_problems(catalog, catalog).isEmpty()
    assert catalog.filter("NOT en_peninsula").isEmpty()
    outside = [("Tenerife", 28.4636, -16.2518), ("Paris", 48.8566, 2.3522), ("Madrid", 40.4168, -3.7038)]
    found = relational.catalog_problems(relational.city_catalog(spark, outside), catalog).collect()
    problems = {(r.ciudad, r.problem) for r in found}
    assert problems == {(c, "missing") for c in ("Barcelona", "Valencia", "Sevilla", "Bilbao")} | {
        ("Tenerife", "outside"),
        ("Paris", "outside"),
    }
