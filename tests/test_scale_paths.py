"""The paths taken for very large keys must give the same results as the plain ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tamiz.operators.consolidate import consolidate
from tamiz.operators.latest import keep_latest, newest_first
from tamiz.operators.numbering import number_rows
from tamiz.operators.quantiles import exact_quantiles
from tamiz.operators.scoring import class_breaks, min_max, ramp_colour
from tamiz.operators.timeseries import moving_average
from tamiz.queries.quality import country_reports
from tamiz.runtime import BROADCAST_ROWS, computed_once, join_side, shared_dir

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def hot_series(seed, rows=3000):
    """One key holds most rows, with bursts, gaps and equal timestamps."""
    rng = np.random.default_rng(seed)
    burst = rng.random(rows) < 0.5
    seconds = np.where(burst, rng.integers(0, 40, rows), rng.integers(0, 5_000_000, rows))
    return pd.DataFrame(
        {
            "id": np.arange(rows),
            "k": np.where(rng.random(rows) < 0.7, "hot", rng.integers(0, 60, rows).astype(str)),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(seconds, unit="s"),
            "v": rng.integers(0, 1000, rows).astype(float),
        }
    )


@pytest.mark.parametrize("seed, window, max_rows", [(1, 24, 200), (2, 5, 30), (3, 24, 7), (4, 1, 50)])
def test_moving_average_cut_into_stretches(spark, seed, window, max_rows):
    data = hot_series(seed)
    df = spark.createDataFrame(data)
    got = moving_average(df, "k", ["ts", "id"], "v", window, "ma", max_rows=max_rows).toPandas()
    ordered = data.sort_values(["k", "ts", "id"])
    want = ordered.groupby("k")["v"].rolling(window, min_periods=1).mean().reset_index(level=0, drop=True)
    assert len(got) == len(data)
    merged = got.set_index("id")["ma"].sort_index()
    np.testing.assert_allclose(merged.to_numpy(), want.sort_index().to_numpy(), rtol=1e-12)


def test_cut_series_ignore_clock_changes(spark):
    # Local times around a spring clock change, where zoned conversion is not monotonic.
    start = pd.Timestamp("2024-03-31 00:00")
    data = pd.DataFrame({"id": range(600), "ts": start + pd.to_timedelta(np.arange(600) * 30, unit="s")})
    data["k"], data["v"] = "a", np.arange(600.0)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        local = spark.createDataFrame(data, "id int, ts timestamp_ntz, k string, v double")
        got = moving_average(local, "k", ["ts", "id"], "v", 24, "ma", max_rows=40).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    want = data["v"].rolling(24, min_periods=1).mean()
    np.testing.assert_allclose(got.set_index("id")["ma"].sort_index(), want)


def shapes(seed):
    rng = np.random.default_rng(seed)
    return {
        "uniform": rng.random(2000) * 100 - 50,
        "ties": rng.integers(0, 3, 2000).astype(float),
        "one": np.full(500, 7.5),
        "wide": np.exp(rng.normal(0, 40, 1500)) * rng.choice([-1, 1], 1500),
        "few": rng.random(3),
        "single": np.array([3.25]),
    }


@pytest.mark.parametrize("bins, buffered", [(2, 1), (7, 10), (64, 100)])
def test_quantiles_narrowed_down_per_key(spark, bins, buffered):
    groups = shapes(bins)
    data = pd.concat([pd.DataFrame({"k": k, "v": v}) for k, v in groups.items()])
    gaps = pd.DataFrame({"k": ["few", "none"], "v": [np.nan, np.nan]})
    nameless = pd.DataFrame({"k": None, "v": groups["uniform"] * 2})
    rows = pd.concat([data, gaps, nameless]).astype({"k": object})
    groups[None] = groups["uniform"] * 2
    df = spark.createDataFrame([(k, float(v)) for k, v in rows.itertuples(index=False)], "k string, v double")
    found = exact_quantiles(df, ["k"], "v", PROBABILITIES, "q", buffered_rows=buffered, bins=bins)
    got = {r.k: (r.n, r.q) for r in found.collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k][0] == len(v)
        np.testing.assert_allclose(got[k][1], np.quantile(v, PROBABILITIES), rtol=1e-12)


@pytest.mark.parametrize("name", ["uniform", "ties", "one", "wide"])
def test_quantiles_narrowed_down_over_everything(spark, name):
    values = shapes(5)[name]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    row = exact_quantiles(df, [], "v", PROBABILITIES, "q", buffered_rows=20, bins=16).first()
    np.testing.assert_allclose(row.q, np.quantile(values, PROBABILITIES), rtol=1e-12)


def test_empty_input_has_no_quantiles(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(empty, ["k"], "v", [0.5]).count() == 0


def test_numbering_is_gapless_and_ordered(spark):
    data = hot_series(9, 5000)
    numbered = number_rows(spark.createDataFrame(data).repartition(13), ["ts", "id"], "n", 101).toPandas()
    expected = data.sort_values(["ts", "id"])["id"].tolist()
    assert numbered.sort_values("n")["id"].tolist() == expected
    assert sorted(numbered["n"]) == list(range(101, 5101))


def test_keep_latest_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_series(3))
    newest = keep_latest(df, ["k"], newest_first("ts", "id"))
    plan = newest._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert "Final" in lines[0] and "Exchange" in lines[1] and "Partial" in lines[2]
    want = hot_series(3).sort_values(["ts", "id"]).groupby("k")["id"].last().to_dict()
    assert {r.k: r.id for r in newest.collect()} == want


def test_join_side_is_broadcast_only_when_small(spark):
    left = spark.range(1000).withColumn("k", F.col("id") % 10)
    right = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("x"))

    def strategy(limit):
        return left.join(join_side(right, limit), "k")._jdf.queryExecution().toString()

    assert "strategy=broadcast" in strategy(BROADCAST_ROWS)
    assert "strategy=broadcast" not in strategy(5)


def test_filters_stop_at_computed_columns(spark):
    df = spark.createDataFrame([("a1",), ("b",)], "t string")
    tagged = computed_once(df, {"digits": F.regexp_extract("t", r"(\d)", 1)}).filter("digits = '1'")
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1
    assert [r.t for r in tagged.collect()] == ["a1"]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_class_breaks_strictly_increase_and_colours(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 5]], "v double")
    breaks = class_breaks(df, "v").first().breaks
    assert breaks == pytest.approx([1, 1 + 1e-6, 1 + 2e-6, 1 + 3e-6, 5])
    five = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0, 4.0],)], "b array<double>")
    values = F.explode(F.array(*[F.lit(x) for x in (-1.0, 0.0, 0.5, 1.0, 4.0, 9.0)]))
    rows = five.select("b", values.alias("v")).select(ramp_colour(F.col("v"), F.col("b")).alias("c"))
    assert [r.c for r in rows.collect()] == ["#ffffb2", "#ffffb2", "#ffec94", "#fed976", "#bd0026", "#bd0026"]


def test_min_max_keeps_missing_values(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, 3.0), (3, None, None)], "i int, a double, b double")
    rows = {r.i: (r.x, r.y) for r in min_max(df, {"a": "x", "b": "y"}).collect()}
    assert rows == {1: (0.0, 0.0), 2: (1.0, 0.0), 3: (None, None)}


def test_customers_are_not_broadcast_to_their_reports(spark, tmp_path):
    for name, columns in {
        "orders": "1L AS o_orderkey, 7L AS o_custkey, 'F' AS o_orderstatus, 10.0D AS o_totalprice, '4-LOW' AS o_orderpriority",
        "customer": "7L AS c_custkey, 3 AS c_nationkey, 5.0D AS c_acctbal, 'BUILDING' AS c_mktsegment",
        "nation": "3 AS n_nationkey, 'NATION_3' AS n_name, 1 AS n_regionkey",
    }.items():
        spark.range(1).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    reports = country_reports(spark, str(tmp_path))
    assert reports.select("pais_nombre_local", "pib_valor").collect() == [("NATION_3", 10.0)]
    plan = reports._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [o_custkey" in plan and "BroadcastHashJoin [o_custkey" not in plan


def test_reports_of_large_groups_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(600).selectExpr("id % 2 AS k", "CAST(id AS double) AS a", "CAST(id * 2 AS double) AS b")
    found = consolidate(rows.mapInArrow(watched, rows.schema), "k", "a", "b", buffered_rows=50).collect()
    assert {tuple(r) for r in found} == {(0, 299.0, 598.0, 300), (1, 300.0, 600.0, 300)}
    # Once for the sizes of the groups, once to be staged.
    assert seen.value <= 1200
