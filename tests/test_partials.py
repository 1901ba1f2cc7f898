"""Summaries kept per city and day against full recomputation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tamiz.operators.latest import newest_first
from tamiz.operators.partials import ROWS, merged, moments, partials
from tamiz.plans import weather
from tamiz.runtime import work_dir
from tamiz.sinks import folders
from tamiz.sinks.tables import merge_partitions

HOURS = (
    "ciudad string, fecha_hora_utc timestamp_ntz, temperature_2m double, precipitation double, "
    "wind_speed_10m double, id_lote string, timestamp_ingesta_utc string"
)


def hours(spark, days, shift=0.0, batch="b1", cities=("Bilbao", "Sevilla"), per_day=24):
    rows = [
        (city, dt.datetime.combine(day, dt.time(h)), 1e6 + shift + h * 0.37 + i, h * 0.1, 3.0 + h + shift, batch, f"2026-04-0{batch[1]}")
        for i, city in enumerate(cities) for day in days for h in range(per_day)
    ]
    return spark.createDataFrame(rows, HOURS)


def load(silver, rows, rebuild=False):
    merge_partitions(silver, weather.with_period(rows), weather.KEYS, newest_first(*weather.NEWEST), weather.PARTITIONS, rebuild)
    return weather.refresh_partials(silver, rows, rebuild)


def assert_like_recomputed(spark, silver):
    hourly = spark.read.parquet(silver)
    days = weather.read_partials(silver)
    shown = lambda df, keys: df.toPandas().sort_values(keys).reset_index(drop=True)
    kept, anew = shown(weather.daily_from_partials(days), weather.DAY), shown(weather.daily_mart(hourly), weather.DAY)
    pd.testing.assert_frame_equal(kept, anew[kept.columns], rtol=1e-12)
    kept = shown(weather.zscore_mart(hourly, weather.city_history(days)), weather.KEYS)
    anew = shown(weather.zscore_mart(hourly), weather.KEYS)
    pd.testing.assert_frame_equal(kept, anew[kept.columns], rtol=1e-9, atol=1e-9)


def test_only_touched_days_are_summarised_anew(spark, monkeypatch):
    silver = work_dir(spark, "silver")
    march = [dt.date(2026, 3, d) for d in range(1, 6)]
    april = [dt.date(2026, 4, 1)]
    assert load(silver, hours(spark, march + april)) == 1
    assert_like_recomputed(spark, silver)
    read = []
    whole = weather.day_rows
    monkeypatch.setattr(weather, "day_rows", lambda *a: read.append(whole(*a)) or read[-1])
    update = hours(spark, [march[1]], 5.0, "b2", ["Bilbao"], 7).unionByName(hours(spark, [dt.date(2026, 3, 9)], 1.0, "b2", ["Sevilla"]))
    assert load(silver, update) == 2
    assert {r.fecha for r in read[0].select("fecha").distinct().collect()} == {march[1], dt.date(2026, 3, 9)}
    plan = spark._jvm.PythonSQLUtils.explainString(read[0]._jdf.queryExecution(), "formatted")
    scan = next(part for part in plan.split("Scan parquet") if "PartitionFilters" in part)
    pruned = next(line for line in scan.splitlines() if "PartitionFilters" in line)
    assert "Bilbao/2026/3" in pruned and "Sevilla/2026/3" in pruned and "/2026/4" not in pruned
    assert "GreaterThanOrEqual(fecha_hora_utc" in scan
    assert_like_recomputed(spark, silver)
    # The same delivery, an older one and an empty one change nothing.
    assert load(silver, update) == load(silver, hours(spark, march, -9.0, "b0")) == 2
    assert weather.refresh_partials(silver, update.limit(0)) == 2
    assert_like_recomputed(spark, silver)


def test_failed_refresh_is_made_up_for(spark, monkeypatch):
    silver = work_dir(spark, "silver")
    days = [dt.date(2026, 3, 30), dt.date(2026, 4, 2)]
    load(silver, hours(spark, days))
    later = hours(spark, days[:1], 2.0, "b2")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(folders, "_publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            load(silver, later)
    assert load(silver, later) == 2
    assert_like_recomputed(spark, silver)


def test_days_lost_by_a_rebuild(spark):
    silver = work_dir(spark, "silver")
    days = [dt.date(2026, 3, d) for d in (1, 2, 3)]
    load(silver, hours(spark, [*days, dt.date(2026, 4, 4)]))
    load(silver, hours(spark, days[:1], 1.0, "b2", ["Bilbao"]), rebuild=True)
    assert_like_recomputed(spark, silver)
    kept = {(r.ciudad, r.fecha) for r in weather.read_partials(silver).collect()}
    assert ("Bilbao", days[1]) not in kept and ("Sevilla", days[1]) in kept and ("Bilbao", dt.date(2026, 4, 4)) in kept


def test_without_a_clean_table(spark):
    assert weather.refresh_partials(work_dir(spark, "silver"), hours(spark, [])) == 0


def test_merged_moments(spark):
    """Groups of any size, NULL keys and values, a large mean with small deviations."""
    rng = np.random.default_rng(3)
    rows = [(k, int(rng.integers(0, 40)), None if rng.random() < 0.1 else 1e9 + float(rng.normal())) for k in ("a", "b", None) for _ in range(300)]
    rows += [("one", 1, 4.0), ("empty", 1, None), ("empty", 2, None)]
    df = spark.createDataFrame(rows, "k string, part int, v double")
    whole = merged(partials(df, ["k", "part"], ["v"]), ["k"], ["v"])
    shown = moments(whole, ["k"], "v", "mean", "std").collect()
    got = {r.k: {**r.asDict(), **next(s for s in shown if s.k == r.k).asDict()} for r in whole.collect()}
    for key in ("a", "b", None, "one", "empty"):
        mine = [v for k, _, v in rows if k == key]
        values = np.array([v for v in mine if v is not None])
        r = got[key]
        assert (r[ROWS], r["v_n"]) == (len(mine), len(values))
        if len(values):
            assert (r["v_min"], r["v_max"]) == (values.min(), values.max())
            assert r["mean"] == pytest.approx(values.mean(), rel=1e-12) and r["std"] == pytest.approx(values.std(), abs=1e-6)
        else:
            assert r["mean"] is None and r["std"] is None
