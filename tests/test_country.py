"""Country reports: first-match rules, medians, indicators, load and audit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tamiz.functions.text import country_key, district_key, title_case
from tamiz.functions.units import area_km2, to_eur
from tamiz.operators.audit import run_finished, run_started
from tamiz.plans import country
from tamiz.runtime import work_dir
from tamiz.sources.payloads import COUNTRY_TYPE, country_populations, parse_payload, with_fallback
from tamiz.sources.relational import seed_populations

REPORT = (
    "pais_nombre_local string, superficie_valor double, superficie_unidad string, "
    "pib_valor double, pib_divisa string"
)


def reports(spark, *rows):
    return spark.createDataFrame(list(rows), REPORT)


def noisy(spark):
    return reports(
        spark,
        ("  Monaco ", 2.0, "km2", 8.50e9, "EUR"),
        ("MÓNACO", 2.0, "km2", 8.52e9, "eur "),
        ("monaco", None, None, 8.55e9, "EUR"),
        ("francia", 643801.0, "km2", 2.78e12, "EUR"),
        ("FRANCE", 643801.0, "km2", 2.79e12, "EUR"),
        ("France", 643801.0, "km2", 2.80e12, "EUR"),
        ("Luxembourg", 998.0, "sq_mi", 1161.4, "USD"),
        ("Narnia", 1.0, "km2", -1.0, "JPY"),
        ("España", 1.0, "km2", 0.0, "JPY"),
        ("ESPAÑA", 1.0, "km2", float("nan"), "EUR"),
        ("Italia", 1.0, "km2", 5.0, "JPY"),
        (None, 1.0, "km2", 5.0, "EUR"),
    )


def test_first_failing_rule_gives_the_reason(spark):
    valid, rejected = country.clean_reports(noisy(spark))
    assert valid.count() == 7
    reasons = [(r.pais_original, r.motivo_rechazo) for r in rejected.collect()]
    assert sorted(reasons, key=str) == sorted(
        [
            ("Narnia", country.NOT_EUROPEAN),
            (None, country.NOT_EUROPEAN),
            ("España", country.BAD_GDP),
            ("ESPAÑA", country.BAD_GDP),
            ("Italia", country.UNKNOWN_CURRENCY + "JPY"),
        ],
        key=str,
    )
    luxembourg = valid.filter("nombre_pais = 'LUXEMBOURG'").first()
    assert luxembourg.superficie_km2 == 2584.81 and abs(luxembourg.pib_total_eur - 1000) < 1e-9


@pytest.mark.parametrize("options", [{}, {"buffered_rows": 1, "bins": 2}])
def test_medians(spark, options):
    from tamiz.operators.consolidate import consolidate

    valid, _ = country.clean_reports(noisy(spark))
    figures = consolidate(valid, "nombre_pais", "superficie_km2", "pib_total_eur", **options)
    rows = {r.nombre_pais: r for r in figures.collect()}
    assert rows["MONACO"].pib_total_eur == 8.52e9 and rows["MONACO"].n_reportes == 3
    assert rows["FRANCE"].pib_total_eur == 2.79e12 and rows["FRANCE"].superficie_km2 == 643801.0


def test_indicators_drop_and_report_countries_without_population(spark):
    valid, _ = country.clean_reports(noisy(spark))
    people = seed_populations(spark).filter("nombre_pais <> 'LUXEMBOURG'")
    found, missing = country.country_indicators(valid, people, "FALLBACK")
    assert [r.nombre_pais for r in missing.collect()] == ["LUXEMBOURG"]
    monaco = found.filter("nombre_pais = 'Monaco'").first()
    assert monaco.pib_per_capita_eur == round(8.52e9 / 38341, 2)
    assert monaco.densidad_poblacional == round(38341 / 2.0, 4)
    assert [r.nombre_pais for r in country.richest(found, 1).collect()] == ["Monaco"]


def test_load_upserts_files_and_audits(spark):
    tables, people = work_dir(spark, "country"), seed_populations(spark)
    for run in (1, 2):
        target = country.load(noisy(spark), people, "FALLBACK", tables, run)
        assert target.count() == 3
    assert dict(target.dtypes)["pib_per_capita_eur"] == "decimal(14,2)"
    quarantine = spark.read.parquet(f"{tables}/tb_cuarentena_geodatos")
    assert quarantine.filter("isnan(pib_valor_orig)").isEmpty()
    assert quarantine.groupBy("id_ejecucion").count().filter("count = 5").count() == 2
    last = country.last_run(spark, tables).first()
    assert (last.id_ejecucion, last.estado, last.registros_leidos, last.registros_insertados) == (2, "OK", 12, 3)
    broken = noisy(spark).withColumn("pib_valor", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        country.load(broken, people, "API", tables, 3)
    assert country.last_run(spark, tables).first().estado == "ERROR"


def test_run_times_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        begun, ended = dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 3, 1, 10, 0, 7)
        row = run_finished(run_started(spark, 1, begun), ended, 3, 2, 1, "API").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.fecha_inicio, row.fecha_fin, row.observaciones) == (begun, ended, "Duracion: 7 s")


def test_payload_and_fallback(spark):
    text = (
        '[{"name":{"common":"Spain"},"population":1},{"name":{"common":" spain"},"population":2},'
        '{"name":{"common":"Malta"}},{"name":{},"population":9},{"name":{"common":"France"},"population":0}]'
    )
    rows = spark.createDataFrame([(text,)], "t string").select(
        F.posexplode(parse_payload(F.col("t"), COUNTRY_TYPE)).alias("pos", "country")
    )
    found = {r.nombre_pais: r.poblacion_total for r in country_populations(rows, "pos").collect()}
    assert found == {"SPAIN": 2, "FRANCE": 0}
    broken = spark.createDataFrame([('{"success": false}',)], "t string").select(
        F.explode(parse_payload(F.col("t"), COUNTRY_TYPE)).alias("country")
    )
    usable = broken.filter("country.population IS NOT NULL")
    seed, origin = with_fallback(usable, seed_populations(spark))
    assert origin == "FALLBACK" and seed.count() == 44
    assert country.populations(rows, "pos")[1] == "API"
    assert country.populations(None)[0].count() == 44


def test_keys_and_units(spark):
    row = spark.range(1).select(
        district_key(F.lit("San Pablo -  Santa\tJusta ")).alias("d"),
        country_key(F.lit("  España ")).alias("c"),
        country_key(F.lit(None).cast("string")).alias("n"),
        title_case(F.lit("CERRO-AMATE o'neil")).alias("t"),
        area_km2(F.lit(998.0), F.lit("SQ_MI ")).alias("a"),
        area_km2(F.lit(56594.0), F.lit(None).cast("string")).alias("b"),
        F.round(to_eur(F.lit(1000.0), F.lit(1.1614)), 2).alias("e"),
    ).first()
    assert tuple(row) == ("SAN PABLO-SANTA JUSTA", "ESPANA", "", "Cerro-Amate O'Neil", 2584.81, 56594.0, 861.03)
