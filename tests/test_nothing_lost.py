"""Inputs that used to vanish or change with size: NULL keys, NaN, blanks, bad documents, old files."""

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tamiz.functions.rows import raw_cell
from tamiz.operators.consolidate import consolidate, translate_codes
from tamiz.operators.contract import Contract, Rule
from tamiz.operators.latest import newest_first
from tamiz.operators.star import fact_rows, insert_new_members
from tamiz.plans import weather
from tamiz.runtime import work_dir
from tamiz.sinks import tables
from tamiz.sinks.files import export_csv, write_staging
from tamiz.sinks.tables import append_absent, read_current, upsert, upsert_into
from tamiz.sources import envelope
from tamiz.sources.delimited import read_staged, split_text_table
from tamiz.sources.envelope import latest_batch, read_envelopes, split_envelopes

NAN = float("nan")


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_consolidation_is_the_same_on_both_paths(spark, limit):
    rows = [("a", 1.0, NAN), ("a", 2.0, None), ("b", 4.0, 1.0), ("b", NAN, 2.0), ("b", 6.0, 3.0), (None, 8.0, 8.0), (None, 8.0, NAN)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    found = {r.k: (r.x, r.y, r.n_reportes) for r in consolidate(df, "k", "x", "y", buffered_rows=limit).collect()}
    assert found == {"a": (1.5, None, 0), "b": (5.0, 2.0, 3), None: (8.0, 8.0, 1)}


def test_repeated_codes_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "raw string")
    codes = spark.createDataFrame([("x", "B"), ("x", "A")], "code string, canon string")
    found = translate_codes(df, "raw", codes, "code", "canon", "out").collect()
    assert sorted((r.raw or "", r.out or "") for r in found) == [("", ""), ("x", "A"), ("y", "y")]


@pytest.mark.parametrize("limit", [1000, 0])
def test_merge_keeps_rows_of_a_null_partition(spark, monkeypatch, limit):
    monkeypatch.setattr(tables, "MAX_LISTED", limit)
    path = work_dir(spark, "merge")
    first = spark.createDataFrame([(1, None, 1), (2, None, 1), (3, "p", 1), (4, "q", 1)], "k int, part string, v int")
    later = spark.createDataFrame([(2, None, 2), (5, None, 2), (3, "p", 2)], "k int, part string, v int")
    for rows in (first, later, later):
        tables.merge_partitions(path, rows, ["k"], newest_first("v"), ["part"])
    found = {(r.k, r.part, r.v) for r in spark.read.parquet(path).collect()}
    assert found == {(1, None, 1), (2, None, 2), (5, None, 2), (3, "p", 2), (4, "q", 1)}


def test_rejected_cell_without_key_keeps_its_text(spark):
    df = spark.createDataFrame([(None, "x1"), (None, "x2"), (7, None)], "id int, cell string")
    found = [r[0] for r in df.select(raw_cell("ID", F.col("id"), "c", F.col("cell"))).collect()]
    assert found == ["ID=None c='x1'", "ID=None c='x2'", "ID=7 c='None'"]


def test_files_keep_blanks_quotes_and_separators(spark):
    rows = [(1, "  a  "), (2, 'q"x'), (3, "p|q,r;s"), (4, '"whole"'), (5, " "), (6, "back\\slash")]
    df = spark.createDataFrame(rows, "k int, t string")
    path = work_dir(spark, "staging")
    write_staging(df, path)
    assert sorted(map(tuple, read_staged(spark, path, "k int, t string").collect())) == rows
    assert export_csv(df, work_dir(spark, "csv")) == len(rows)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    assert '"q""x"' in text and "  a  " in text


def test_members_with_null_parts_keep_their_keys(spark):
    staged = spark.createDataFrame([("a", None, 1), ("a", "b", 2), (None, None, 3)], "x string, y string, v int")
    first = insert_new_members(None, staged, ["x", "y"], "id")
    assert insert_new_members(first, staged, ["x", "y"], "id").count() == 0
    facts = fact_rows(staged, [(first, ["x", "y"], "id")], ["v"]).collect()
    assert sorted(r.v for r in facts) == [1, 2, 3] and len({r.id for r in facts}) == 3


def test_another_number_of_buckets_is_refused(spark):
    path = work_dir(spark, "buckets")
    rows = spark.range(20).withColumnRenamed("id", "k")
    tables.upsert_by_bucket(path, rows, ["k"], 16)
    tables.upsert_by_bucket(path, rows, ["k"], 16)
    with pytest.raises(ValueError, match="16 buckets, not 8"):
        tables.upsert_by_bucket(path, rows, ["k"], 8)
    assert spark.read.parquet(path).count() == 20


def test_patterns_start_at_the_beginning(spark):
    df = spark.createDataFrame([("AB12",), ("xAB12",)], "code string")
    valid, rejected = Contract([Rule("code", pattern="AB|CD")]).split(df)
    assert [r.code for r in valid.collect()] == ["AB12"] and rejected.count() == 1


def document(city, hours, batch="b1", stamp="2026-01-02T00:00:00+00:00", cut=0):
    series = {v: [1.0 + 0 * h for h in range(hours - cut)] for v in weather.HOURLY_VARIABLES}
    series["surface_pressure"] = [1000.0] * (hours - cut)
    times = [f"2026-01-01T{h:02d}:00" for h in range(hours)]
    head = {"id_lote": batch, "timestamp_ingesta_utc": stamp, "ciudad": city, "origen": "API"}
    return json.dumps({"metadata": head, "datos_api": {"hourly": {"time": times, **series}}})


def test_unusable_documents_are_filed_and_the_others_go_on(spark):
    raw, silver, state = (work_dir(spark, label) for label in ("raw", "silver", "state"))
    os.makedirs(raw)
    texts = [document("Madrid", 3), document("Bilbao", 2), document("Sevilla", 3)[:-40], "no json", document("Valencia", 4, cut=1), document("Madrid", 0)]
    for k, text in enumerate(texts):
        with open(f"{raw}/d{k}.json", "w") as out:
            out.write(text)
    usable, rejected = split_envelopes(read_envelopes(spark, [raw]))
    assert usable.count() == 2
    reasons = sorted(r.motivo_rechazo for r in rejected.collect())
    assert reasons == ["hourly arrays differ in length", "no hourly series", "unreadable document", "unreadable document"]
    assert all(r.path and r.documento for r in rejected.collect())
    weather.stream_clean(raw, silver, state).awaitTermination()
    assert spark.read.parquet(silver).count() == 5
    # A backfill that keeps its old times is taken too.
    with open(f"{raw}/old.json", "w") as out:
        out.write(document("Barcelona", 6))
    long_ago = time.time() - 30 * 86400
    os.utime(f"{raw}/old.json", (long_ago, long_ago))
    weather.stream_clean(raw, silver, state).awaitTermination()
    assert spark.read.parquet(silver).count() == 11
    assert spark.read.parquet(f"{silver}/{weather.UNUSABLE}").count() == 4
    batch, target = weather.load_clean(raw, work_dir(spark, "batch")), work_dir(spark, "batch")
    assert batch[0].count() == 11 and target


def test_equal_ingest_times_are_decided_by_the_batch(spark):
    raw = work_dir(spark, "raw")
    os.makedirs(raw)
    for name, batch in (("a", "lote_2"), ("b", "lote_1")):
        with open(f"{raw}/{name}.json", "w") as out:
            out.write(document("Madrid", 2, batch))
    found = latest_batch(read_envelopes(spark, [raw])).select("metadata.id_lote").collect()
    assert [r.id_lote for r in found] == ["lote_2"]


def test_chosen_cities_are_reloaded_from_what_has_landed(spark):
    raw, silver = work_dir(spark, "raw"), work_dir(spark, "silver")
    os.makedirs(raw)
    for k, city in enumerate(("Madrid", "Bilbao", "Sevilla")):
        with open(f"{raw}/d{k}.json", "w") as out:
            out.write(document(city, 2 + k))
    asked = spark.createDataFrame([("Madrid",), ("Sevilla",), ("Lugo",)], "ciudad string")
    found = {r.ciudad: r.origen for r in weather.reload_cities(asked, raw, silver).collect()}
    assert found == {"Madrid": "BRONZE_EXISTENTE", "Sevilla": "BRONZE_EXISTENTE", "Lugo": "SIN_DATOS"}
    rows = spark.read.parquet(silver).groupBy("ciudad").count().collect()
    assert {tuple(r) for r in rows} == {("Madrid", 2), ("Sevilla", 4)}


def test_ingest_checks_the_catalog(spark):
    catalog = spark.createDataFrame([("Madrid", 40.4, -3.7), ("Tenerife", 28.5, -16.3)], "ciudad string, lat double, lon double")
    asked = spark.createDataFrame([("Madrid",), ("Lugo",)], "ciudad string")
    with pytest.raises(ValueError, match="Lugo missing, Tenerife outside"):
        weather.ingest(asked, None, work_dir(spark, "raw"), catalog=catalog)


def indented(text):
    return json.dumps(json.loads(text), indent=2, ensure_ascii=False)


def test_documents_are_found_however_files_are_laid_out(spark):
    raw, silver, state = (work_dir(spark, label) for label in ("raw", "silver", "state"))
    os.makedirs(raw)
    files = [
        indented(document("Madrid", 3)),
        document("Bilbao", 2) + "\n" + document("Sevilla", 4) + "\n",
        indented(document("Valencia", 5))[:-60],
        indented(document("Valencia", 2)) + "\r\n" + indented(document("Barcelona", 1)) + "\n\n",
        document("Madrid", 2, "old", "2020-01-01") + "\nnot json\n" + document("Bilbao", 1, "old", "2020-01-01"),
        " \n",
        document("Madrid", 1) + " and more",
    ]
    for k, text in enumerate(files):
        with open(f"{raw}/d{k}.json", "w", newline="") as out:
            out.write(text)
    usable, rejected = split_envelopes(read_envelopes(spark, [raw]))
    assert usable.count() == 7 and rejected.count() == 4
    assert {r.motivo_rechazo for r in rejected.collect()} == {"unreadable document"}
    weather.stream_clean(raw, silver, state).awaitTermination()
    streamed = spark.read.parquet(silver).groupBy("ciudad").count().collect()
    assert {tuple(r) for r in streamed} == {("Madrid", 3), ("Bilbao", 2), ("Sevilla", 4), ("Valencia", 2), ("Barcelona", 1)}
    assert spark.read.parquet(f"{silver}/{weather.UNUSABLE}").count() == 4
    batch = work_dir(spark, "batch")
    for _ in range(2):
        valid, _ = weather.load_clean(raw, batch)
        assert valid.count() == 12
    # Documents that cannot be used are filed once, not on every run.
    assert spark.read.parquet(f"{batch}/{weather.UNUSABLE}").count() == 4


def test_documents_are_read_one_at_a_time(spark):
    raw = work_dir(spark, "raw")
    os.makedirs(raw)
    one, large = indented(document("Madrid", 3)), indented(document("Bilbao", 24))
    files = {
        "indented": "\n".join([one, large, one[:-60], large, one]) + "\n",
        "lines": "\n".join([document("Madrid", 2), "not json", document("Vigo", 9)[:-20], "{", document("Lugo", 1)]),
        "junk": "\n \nhead\n" + one + "\r\n\n" + "between\n" + large + " after\n\n",
        "first": "  " + document("Lugo", 2) + "\n{{" + one + "\n\n{",
        "bytes": one + "\n{caf\udce9\n" + one,
        "blank": " \n\n",
        "brace": "{",
        "cut": large[:-9] + "\n",
    }
    for name, text in files.items():
        with open(f"{raw}/{name}.json", "w", newline="", errors="surrogateescape") as out:
            out.write(text)
    with gzip.open(f"{raw}/packed.json.gz", "wt", newline="") as out:
        out.write("\n".join([one, large, one[:-60], large]) + "\n")
    whole = spark.read.text(raw, wholetext=True).select(
        F.explode(envelope.split_documents(F.col("value"))).alias("_piece"), F.col("_metadata.file_path").alias("path")
    )

    def shown(frame, text="_piece"):
        return sorted(map(tuple, frame.select(F.hex(text), F.regexp_extract("path", "[^/]*$", 0)).collect()))

    by_document = spark.read.option("lineSep", envelope.DOCUMENT_BREAK).text(raw)
    # No record holds two documents that can be read.
    assert by_document.filter(F.length("value") > len(large) + 20).isEmpty()
    assert shown(envelope.document_texts(by_document)) == shown(whole)
    again = spark.read.option("lineSep", envelope.DOCUMENT_BREAK).text([raw, raw])
    plain = ~F.col("path").endswith(".gz")
    assert shown(envelope.document_texts(again).filter(plain)) == shown(whole.union(whole).filter(plain))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (97, 512, 1500):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = envelope.document_texts(spark.read.option("lineSep", envelope.DOCUMENT_BREAK).text(raw))
            # A brace alone at the end of a file need not be told if the file is more than one block.
            kept = F.regexp_replace("_piece", r"\s+$", "")
            others = ~(F.col("path").endswith("first.json") & (kept == "{"))
            assert shown(found.filter(others), kept) == shown(whole.filter(others), kept)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_needed_day_folders_are_opened(spark, monkeypatch):
    raw, opened = work_dir(spark, "raw"), []
    for day in range(1, 7):
        for city in ("Madrid", "Vigo=a b", "Lugo"):
            folder = f"{raw}/ciudad={city.replace('=', '%3D')}/fecha_ingesta=2026-01-0{day}"
            os.makedirs(folder)
            hours = 2 if city == "Madrid" or (city == "Vigo=a b" and day == 2) else 0
            with open(f"{folder}/d.json", "w") as out:
                out.write(indented(document(city, hours, f"b{day}", f"2026-01-0{day}T05:00:00")))
    real = envelope.read_envelopes
    monkeypatch.setattr(envelope, "read_envelopes", lambda spark, paths, *a, **k: opened.append(list(paths)) or real(spark, paths, *a, **k))
    newest, rejected = envelope.newest_usable(spark, raw, ["Madrid"])
    assert [r.metadata.id_lote for r in newest.collect()] == ["b6"] and [len(p) for p in opened] == [0, 1]
    opened.clear()
    newest, rejected = envelope.newest_usable(spark, raw)
    assert {r.ciudad: r.metadata.id_lote for r in newest.collect()} == {"Madrid": "b6", "Vigo=a b": "b2"}
    assert [len(p) for p in opened] == [0, 3, 4, 6] and rejected.count() == 11
    opened.clear()
    fetched = spark.createDataFrame([(json.loads(document("Madrid", 3)),)], "d struct<datos_api:" + envelope.body_type().simpleString() + ">")
    fetched = fetched.select(F.lit("Madrid").alias("ciudad"), "d.datos_api")
    asked = spark.createDataFrame([("Madrid",)], "ciudad string")
    summary = weather.ingest(asked, fetched, raw, ("b7", "2026-01-07T05:00:00"))
    assert [r.origen for r in summary.collect()] == ["API"] and opened == [[]]
    asked = spark.createDataFrame([("Madrid",), ("Vigo=a b",), ("Lugo",)], "ciudad string")
    summary = weather.ingest(asked, fetched, raw, ("b8", "2026-01-08T05:00:00"))
    assert {r.ciudad: r.origen for r in summary.collect()} == {"Madrid": "API", "Vigo=a b": "FALLBACK", "Lugo": "SIN_DATOS"}


def test_null_keys_are_updated_not_repeated(spark):
    path, quarantine = work_dir(spark, "target"), work_dir(spark, "errors")
    rows = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.0), (None, None, 3.0)], "k int, j string, v double")
    for turn in range(3):
        upsert_into(path, rows.withColumn("v", F.col("v") + turn), ["k", "j"])
        append_absent(quarantine, rows, ["k", "j"])
    assert sorted(r.v for r in read_current(spark, path).collect()) == [3.0, 4.0, 5.0]
    assert spark.read.parquet(quarantine).count() == 3
    assert {r.v for r in upsert(rows, rows.select("k", "j"), ["k", "j"]).collect()} == {1.0, 2.0, 3.0}


def test_ragged_lines_are_filed(spark):
    path = work_dir(spark, "lines")
    os.makedirs(path)
    for name, lines in (("a", ["\ufeffx;y", "1;2", "3", "4;5;6", "", ";", "7;8\r"]), ("b", ["x;y", "9;é"])):
        with open(f"{path}/{name}.csv", "w", newline="") as out:
            out.write("\n".join(lines))
    rows, ragged = split_text_table(spark, path, ["x", "y"])
    assert sorted(map(tuple, rows.collect())) == [("", ""), ("1", "2"), ("7", "8"), ("9", "é")]
    assert sorted(map(tuple, ragged.collect())) == [("1 fields instead of 2", "3"), ("3 fields instead of 2", "4;5;6")]
