"""Match statistics: the 30-row source file and its expected rows."""

import glob
import os
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tamiz.functions.text import capitalise, split_first
from tamiz.plans import matches
from tamiz.runtime import work_dir
from tamiz.sources.delimited import read_staged, read_text_table
from tamiz.sinks.folders import read_folders
from tamiz.sinks.files import write_staging

# The source rows that results must agree on.
SOURCE = """\
jugador_equipo;partido;goles;asistencias;fecha_partido
 Vinicius Jr - Brasil ;Brasil vs España;1;1;2026-06-20
Kylian Mbappé - Francia ;Francia vs Argentina;2;0;15/07/2026
 Vinicius Jr - Brasil ;Brasil vs España;1;1;2026-06-20
 Lamine Yamal - ESPAÑA ;Brasil vs España;1;NULL;2026-06-20
Endrick - brasil;Brasil vs España;1;0;06-20-2026
Santiago Giménez - México;México vs Sudáfrica;2;;2026/06/11
 Christian Pulisic - Estados Unidos;EEUU vs Australia;1;2;2026-06-14
 Jude Bellingham - Inglaterra;Inglaterra vs Colombia;0;1;2026-06-28
Lionel Messi - ARGENTINA;Francia vs Argentina;1;1;2026-07-15
 Lautaro Martinez - Argentina ;Argentina vs Marruecos;2;0;2026-06-18
Erling Haaland - Noruega;Noruega vs Japón;3;0;2026-06-12
 Takefusa Kubo - Japón ;Noruega vs Japón;1;NULL;12/06/2026
Federico Valverde - Uruguay;Uruguay vs Portugal;1;0;2026-06-22
Cristiano Ronaldo - PORTUGAL;Uruguay vs Portugal;0;1;2026-06-22
Jamal Musiala - Alemania;Alemania vs Nigeria;2;1;2026-06-15
 Florian Wirtz - Alemania ;Alemania vs Nigeria;1;2;2026-06-15
 Victor Osimhen - Nigeria ;Alemania vs Nigeria;1;;15-06-2026
Alphonso Davies - Canadá;Canadá vs Suiza;0;1;2026-06-13
Harry Kane - Inglaterra;Inglaterra vs Colombia;2;0;2026-06-28
Luis Díaz - Colombia;Inglaterra vs Colombia;1;0;2026-06-28
 Julian Alvarez - Argentina ;Argentina vs Marruecos;1;1;2026-06-18
 Achraf Hakimi - Marruecos ;Argentina vs Marruecos;0;1;2026-06-18
 Pedri - España ;Brasil vs España;0;2;2026-06-20
Kylian Mbappé - Francia ;Francia vs Argentina;2;0;15/07/2026
 Edson Alvarez - MÉXICO ;México vs Sudáfrica;0;1;2026/06/11
Moises Caicedo - Ecuador;Ecuador vs Holanda;0;1;2026-06-16
Cody Gakpo - Holanda;Ecuador vs Holanda;1;0;2026-06-16
 Son Heung-min - Corea del Sur ;Corea vs Italia;1;;2026-06-21
Nicolò Barella - Italia;Corea vs Italia;1;1;2026-06-21
 Bruno Fernandes - Portugal;Uruguay vs Portugal;1;1;2026-06-22
"""
RAW_OF = "jugador_equipo={}; partido={}; goles={}; asistencias={}; fecha_partido={}"
RF03 = "RF-03: pais fuera del mundial ({} / {})"
EXPECTED_ERRORS = {
    "Endrick - brasil": "RF-04: error de conversion de fecha (fila descartada por seguridad)",
    "Jamal Musiala - Alemania": RF03.format("Alemania", "Alemania vs Nigeria"),
    " Florian Wirtz - Alemania ": RF03.format("Alemania", "Alemania vs Nigeria"),
    " Victor Osimhen - Nigeria ": RF03.format("Nigeria", "Alemania vs Nigeria"),
    " Son Heung-min - Corea del Sur ": RF03.format("Min - corea del sur", "Corea vs Italia"),
    "Nicolò Barella - Italia": RF03.format("Italia", "Corea vs Italia"),
    "Santiago Giménez - México": "RF-04: formato de fecha no reconocido: 2026/06/11",
    " Edson Alvarez - MÉXICO ": "RF-04: formato de fecha no reconocido: 2026/06/11",
}


@pytest.fixture(scope="module")
def source(spark):
    path = work_dir(spark, "matches")
    spark.createDataFrame([(SOURCE.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    return path


@pytest.fixture(scope="module")
def tagged(spark, source):
    return matches.tag_rows(read_text_table(spark, source, matches.SOURCE_COLUMNS, ";"))


def test_errors(tagged):
    rows = matches.error_file(tagged, "lines.csv", dt.date(2026, 8, 25)).collect()
    lines = [line.split(";") for line in SOURCE.splitlines()[1:]]
    expected = {RAW_OF.format(*f): EXPECTED_ERRORS[f[0]] for f in lines if f[0] in EXPECTED_ERRORS}
    assert {r.datos_raw: r.motivo_rechazo for r in rows} == expected
    assert len(rows) == 8
    assert {(r.tabla_origen, r.fecha_deteccion) for r in rows} == {
        ("lines.csv", dt.date(2026, 8, 25))
    }


def test_staged_rows(tagged):
    rows = [tuple(r) for r in matches.stage_rows(tagged).collect()]
    assert len(rows) == 22
    assert rows.count(("Kylian Mbappé", "Francia", "Francia", "Argentina", dt.date(2026, 7, 15), 2, 0)) == 2
    assert ("Lamine Yamal", "España", "Brasil", "España", dt.date(2026, 6, 20), 1, 0) in rows
    assert ("Christian Pulisic", "Estados unidos", "EEUU", "Australia", dt.date(2026, 6, 14), 1, 2) in rows
    assert ("Takefusa Kubo", "Japón", "Noruega", "Japón", dt.date(2026, 6, 12), 1, 0) in rows


def written(path):
    """Data files of the dimensions and facts, with their times."""
    tables = ("dim_jugadores", "dim_partidos", "fact_estadisticas")
    found = [f for t in tables for f in glob.glob(f"{path}/{t}/**/*.parquet", recursive=True)]
    return {f: os.stat(f).st_mtime_ns for f in found}


def test_star_grows_once(spark, tagged):
    staged, errors, path = matches.stage_rows(tagged), matches.error_file(tagged, "lines.csv"), work_dir(spark, "star")
    first = matches.load(staged, errors, path)
    keys = {r.jugador_id: r.nombre_jugador for r in first["dim_jugadores"].collect()}
    assert sorted(keys) == list(range(1, 21))
    extra = spark.createDataFrame(
        [("Aaron", "Gales", "Gales", "Suiza", dt.date(2026, 6, 30), 4, 0)], staged.schema
    )
    files = written(path)
    second = matches.load(staged, errors, path)
    assert written(path) == files
    counts = {name: table.count() for name, table in second.items()}
    assert counts == {
        "dim_jugadores": 20,
        "dim_partidos": 9,
        "fact_estadisticas": 20,
        "tb_errores_migracion": 8,
    }
    third = matches.load(staged.unionByName(extra), errors, path)
    later = {r.jugador_id: r.nombre_jugador for r in third["dim_jugadores"].collect()}
    assert later.pop(21) == "Aaron" and later == keys


def test_whole_run(spark, source):
    target = work_dir(spark, "run")
    for _ in range(2):
        counts = matches.run(spark, source, target)
    assert counts == {"registros_leidos": 30, "registros_insertados": 22, "registros_error": 8}
    assert read_folders(spark, f"{target}/fact_estadisticas").count() == 20
    assert read_folders(spark, f"{target}/tb_errores_migracion").count() == 8
    assert spark.read.parquet(f"{target}/tb_ejecuciones_etl").count() == 2


def test_staging_file_roundtrip(spark, tagged):
    path = work_dir(spark, "staging")
    write_staging(matches.stage_rows(tagged), path)
    assert sorted(map(tuple, read_staged(spark, path, matches.STAGED_TYPES).collect())) == sorted(
        map(tuple, matches.stage_rows(tagged).collect())
    )
    bad = work_dir(spark, "bad")
    spark.createDataFrame([("n\nx",)], "value string").write.text(bad)
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED"):
        read_staged(spark, bad, "n int").collect()


@pytest.mark.parametrize(
    "line, reason",
    [
        ("Solo;A vs B;1;1;2026-01-01", "RF-01: jugador o pais vacio en 'Solo'"),
        (" - X;A vs B;1;1;2026-01-01", "RF-01: jugador o pais vacio en '- X'"),
        ("P - X;A v B;1;1;2026-01-01", "Formato de partido no reconocido: A v B"),
        ("P - X;A vs Italianos;1;1;2026-01-01", "RF-03: pais fuera del mundial (X / A vs Italianos)"),
        ("P - X;A vs B;uno;1;2026/01/01", matches.CONVERSION_REASON),
        ("P - X;A vs B;;1;2026-01-01", matches.CONVERSION_REASON),
        ("P - X;A vs B;1;x;2026-01-01", matches.CONVERSION_REASON),
        ("P - X;A vs B;1;1;", "RF-04: formato de fecha no reconocido: "),
        ("P - X;A vs B;1;null;01-02-2026", None),
    ],
)
def test_reasons(spark, line, reason):
    raw = spark.createDataFrame([tuple(line.split(";"))], matches.SOURCE_COLUMNS)
    assert matches.tag_rows(raw).first().motivo_rechazo == reason


def test_split_and_capitalise(spark):
    row = spark.createDataFrame([("a-b-c", "áBC", "")], "s string, t string, e string").select(
        split_first(F.col("s"), "-").alias("s"),
        split_first(F.col("t"), "-").alias("n"),
        capitalise(F.col("t")).alias("c"),
        capitalise(F.col("e")).alias("e"),
    ).first()
    assert tuple(row.s) == (True, "a", "b-c") and tuple(row.n) == (False, "", "")
    assert (row.c, row.e) == ("Ábc", "")
