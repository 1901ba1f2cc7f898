"""Keyed series over the events: summaries, moving averages, z-scores, latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators.latest import keep_latest, newest_first
from tamiz.operators.timeseries import daily_summary, moving_average, zscore, zscore_selfcheck
from tamiz.queries.base import query, table

DAILY_SQL = """
    SELECT user_id, CAST(ts AS DATE) AS fecha, avg(value) AS level_mean, min(value) AS level_min,
           max(value) AS level_max, sum(value) AS total_sum, avg(value) AS mean_mean
    FROM events GROUP BY user_id, CAST(ts AS DATE)"""
DAILY_COLUMNS = ["level_mean", "level_min", "level_max", "total_sum", "mean_mean"]
ROUNDED_DAILY = ", ".join(f"round({c}, 6) AS {c}" for c in DAILY_COLUMNS)


def _daily(spark, sf_dir):
    return daily_summary(table(spark, sf_dir, "events"), "user_id", "ts", "value", "value", "value")


def _rounded(df, columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"SELECT user_id, fecha, {ROUNDED_DAILY} FROM ({DAILY_SQL}) ORDER BY user_id, fecha")
def daily_series(spark, sf_dir):
    return _rounded(_daily(spark, sf_dir), DAILY_COLUMNS).orderBy("user_id", "fecha")


@query(
    f"""SELECT user_id, fecha, {ROUNDED_DAILY} FROM ({DAILY_SQL})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY fecha DESC) = 1"""
)
def latest_day(spark, sf_dir):
    daily = _rounded(_daily(spark, sf_dir), DAILY_COLUMNS)
    return keep_latest(daily, ["user_id"], newest_first("fecha"))


MOVING_SQL = """
    SELECT event_id, user_id, ts, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6) AS moving_average
    FROM events"""


def _moving(spark, sf_dir, **options):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    averaged = moving_average(events, "user_id", ["ts", "event_id"], "value", 24, **options)
    return averaged.select("event_id", "user_id", "ts", F.round("moving_average", 6).alias("moving_average"))


@query(MOVING_SQL)
def moving_average_24(spark, sf_dir):
    return _moving(spark, sf_dir)


@query(MOVING_SQL)
def moving_average_cut(spark, sf_dir):
    """The same with the longer series cut into stretches, as is done for hot keys."""
    return _moving(spark, sf_dir, max_rows=66)


Z_SQL = """
    SELECT event_id, user_id, value, history_mean, history_std,
           CASE WHEN history_std = 0 OR history_std IS NULL THEN 0.0
                ELSE (value - history_mean) / history_std END AS z_score
    FROM events JOIN (SELECT user_id, avg(value) AS history_mean, stddev_pop(value) AS history_std
                      FROM events GROUP BY user_id) USING (user_id)"""


def _scored(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return zscore(events, "user_id", "value")


@query(
    f"""SELECT event_id, user_id, value, round(history_mean, 6) AS history_mean,
    round(history_std, 6) AS history_std, round(z_score, 6) AS z_score FROM ({Z_SQL})"""
)
def zscore_history(spark, sf_dir):
    return _rounded(_scored(spark, sf_dir), ["history_mean", "history_std", "z_score"])


@query(
    f"""SELECT user_id, abs(round(avg(z_score), 6)) AS z_mean, round(stddev_pop(z_score), 6) AS z_std,
    TRUE AS passed FROM ({Z_SQL}) GROUP BY user_id"""
)
def zscore_check(spark, sf_dir):
    checked = zscore_selfcheck(_scored(spark, sf_dir), "user_id")
    return checked.select(
        "user_id",
        F.abs(F.round("z_mean", 6)).alias("z_mean"),
        F.round("z_std", 6).alias("z_std"),
        "passed",
    )


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query(
    f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY {', '.join(LINE_KEYS)}
    ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) = 1"""
)
def keep_latest_line(spark, sf_dir):
    return keep_latest(table(spark, sf_dir, "lineitem"), LINE_KEYS, newest_first(*LINE_ORDER))


@query("SELECT DISTINCT event_type FROM events ORDER BY event_type")
def distinct_entities(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type").distinct().orderBy("event_type")


@query(
    """SELECT event_id, ts, value FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 4 DAY ORDER BY ts DESC"""
)
def recency_filter(spark, sf_dir):
    from tamiz.sources.payloads import recent

    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    reference = events.agg(F.max("ts")).scalar()
    return recent(events, "ts", reference, 4)
