"""Medians, quantiles, indicators, rankings and colour classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.fixed_values import RAMP_COLOURS
from tamiz.operators.consolidate import consolidate
from tamiz.operators.numbering import rank_positions
from tamiz.operators.quantiles import exact_median, exact_quantiles
from tamiz.operators.scoring import break_class, class_breaks, column_profile, min_max, ramp_colour
from tamiz.plans import country
from tamiz.queries.base import query, table
from tamiz.queries.quality import (
    REPORTS_SQL,
    clean_country_reports,
    country_reports,
    european_nations,
)

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]


@query(
    """SELECT o_custkey, round(median(o_totalprice), 6) AS o_totalprice, median(o_orderkey) AS o_orderkey,
    count(o_orderkey) AS n_reportes FROM orders GROUP BY o_custkey"""
)
def median_consolidation(spark, sf_dir):
    found = consolidate(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", "o_orderkey")
    return found.withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    """SELECT l_returnflag, round(median(l_extendedprice), 6) AS middle, count(l_extendedprice) AS n
    FROM lineitem GROUP BY l_returnflag"""
)
def median_narrowed(spark, sf_dir):
    """Medians of groups treated as too large for one task."""
    line = table(spark, sf_dir, "lineitem")
    found = exact_median(line, ["l_returnflag"], "l_extendedprice", "middle", buffered_rows=500, bins=64)
    return found.withColumn("middle", F.round("middle", 6))


QUANTILE_SQL = """
    SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS p,
           unnest(quantile_cont({column}, [0.0, 0.25, 0.5, 0.75, 1.0])) AS q FROM {table}"""


def _as_rows(found):
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in PROBABILITIES]).alias("p"), F.col("q").alias("q"))
    return found.select(F.inline(pairs)).select("p", F.round("q", 6).alias("q"))


@query(
    f"""SELECT p::DOUBLE AS p, round(q, 6) AS q
    FROM ({QUANTILE_SQL.format(column='c_acctbal', table='customer')})"""
)
def quantiles(spark, sf_dir):
    return _as_rows(exact_quantiles(table(spark, sf_dir, "customer"), [], "c_acctbal", PROBABILITIES, "q"))


@query(
    f"""SELECT p::DOUBLE AS p, round(q, 6) AS q
    FROM ({QUANTILE_SQL.format(column='l_extendedprice', table='lineitem')})"""
)
def quantiles_narrowed(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    found = exact_quantiles(line, [], "l_extendedprice", PROBABILITIES, "q", buffered_rows=500, bins=64)
    return _as_rows(found)


# Red, green and blue of the ramp, as the SQL sees them.
RAMP_CHANNELS = [[int(colour[k : k + 2], 16) for colour in RAMP_COLOURS] for k in (1, 3, 5)]
RAMP_SQL = f"""
    WITH breaks AS (SELECT quantile_cont(c_acctbal, [0.0, 0.25, 0.5, 0.75, 1.0]) AS b FROM customer),
    placed AS (SELECT c_custkey, c_acctbal AS v, b,
                 CASE WHEN c_acctbal <= b[2] THEN 1 WHEN c_acctbal <= b[3] THEN 2
                      WHEN c_acctbal <= b[4] THEN 3 ELSE 4 END AS class FROM customer, breaks),
    shares AS (SELECT *, (v - b[class]) / (b[class + 1] - b[class]) AS p,
                 {RAMP_CHANNELS[0]} AS r, {RAMP_CHANNELS[1]} AS g, {RAMP_CHANNELS[2]} AS bl FROM placed)
    SELECT c_custkey, class, lower(printf('#%02x%02x%02x',
      floor(((1 - p) * r[class] + p * r[class + 1]) / 255 * 255.9999::DOUBLE)::INT,
      floor(((1 - p) * g[class] + p * g[class + 1]) / 255 * 255.9999::DOUBLE)::INT,
      floor(((1 - p) * bl[class] + p * bl[class + 1]) / 255 * 255.9999::DOUBLE)::INT)) AS colour FROM shares"""


@query(RAMP_SQL)
def quantile_classes(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    breaks = class_breaks(customer, "c_acctbal").select("breaks").scalar()
    value = F.col("c_acctbal")
    classed = customer.withColumn("breaks", breaks)
    return classed.select(
        "c_custkey",
        break_class(value, F.col("breaks")).alias("class"),
        ramp_colour(value, F.col("breaks")).alias("colour"),
    )


@query(
    """SELECT s_suppkey, round(CASE WHEN hi = lo THEN 0 ELSE (s_acctbal - lo) / (hi - lo) END, 9) AS scaled,
    0.0::DOUBLE AS flat FROM supplier, (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier)"""
)
def min_max_scaling(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").withColumn("same", F.lit(7.0))
    scaled = min_max(supplier, {"s_acctbal": "scaled", "same": "flat"})
    return scaled.select("s_suppkey", F.round("scaled", 9).alias("scaled"), "flat")


@query(
    """SELECT min(c_acctbal) AS min, max(c_acctbal) AS max, round(sum(c_acctbal), 2) AS sum,
    round(avg(c_acctbal), 6) AS mean FROM customer"""
)
def balance_profile(spark, sf_dir):
    profile = column_profile(table(spark, sf_dir, "customer"), "c_acctbal")
    return profile.withColumns({"sum": F.round("sum", 2), "mean": F.round("mean", 6)})


@query(
    """SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position
    FROM customer"""
)
def balance_ranking(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rank_positions(customer, "c_acctbal", "c_custkey")


def populations(spark, sf_dir):
    """Customers per nation as population; two nations have no figure."""
    nation, customer = european_nations(spark, sf_dir), table(spark, sf_dir, "customer")
    counted = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("poblacion_total"))
    joined = nation.join(counted, nation.n_nationkey == counted.c_nationkey)
    return joined.filter("n_nationkey NOT IN (6, 11)").select("nombre_pais", "poblacion_total")


INDICATOR_SQL = f"""
    WITH reports AS ({REPORTS_SQL}),
    medians AS (SELECT nombre_pais, median(superficie_km2) AS superficie_km2, median(pib_total_eur) AS pib_total_eur,
                  count(pib_total_eur) AS n_reportes FROM reports WHERE motivo_rechazo IS NULL GROUP BY nombre_pais),
    people AS (SELECT CASE WHEN n_name = 'NATION_5' THEN 'FIFTH' ELSE n_name END AS nombre_pais,
                 count(*) AS poblacion_total FROM customer JOIN nation ON c_nationkey = n_nationkey
               WHERE n_nationkey NOT IN (6, 11) GROUP BY n_name)
    SELECT upper(nombre_pais[1]) || lower(nombre_pais[2:]) AS nombre_pais, superficie_km2,
      round(pib_total_eur, 6) AS pib_total_eur, n_reportes, poblacion_total,
      round_even(poblacion_total / superficie_km2 * 10000, 0) / 10000 AS densidad_poblacional,
      round_even(pib_total_eur / poblacion_total * 100, 0) / 100 AS pib_per_capita_eur,
      'FALLBACK' AS fuente_poblacion FROM medians JOIN people USING (nombre_pais)"""


def _indicators(spark, sf_dir):
    valid, _ = clean_country_reports(spark, sf_dir)
    return country.country_indicators(valid, populations(spark, sf_dir), "FALLBACK")


@query(INDICATOR_SQL)
def country_indicators(spark, sf_dir):
    found, _ = _indicators(spark, sf_dir)
    return found.withColumn("pib_total_eur", F.round("pib_total_eur", 6))


@query(
    f"""WITH reports AS ({REPORTS_SQL}) SELECT DISTINCT nombre_pais FROM reports
    WHERE motivo_rechazo IS NULL AND nombre_pais IN ('NATION_6', 'NATION_11')"""
)
def countries_without_population(spark, sf_dir):
    return _indicators(spark, sf_dir)[1]


@query(f"SELECT * FROM ({INDICATOR_SQL}) ORDER BY pib_per_capita_eur DESC, nombre_pais LIMIT 10")
def top_ten_per_capita(spark, sf_dir):
    return country.richest(country_indicators(spark, sf_dir))


@query(
    """SELECT c_mktsegment, c_custkey, c_acctbal FROM customer
    ORDER BY c_mktsegment, c_acctbal, c_custkey"""
)
def multi_key_sort(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return customer.orderBy("c_mktsegment", "c_acctbal", "c_custkey")


@query("SELECT count(*) AS reports FROM orders")
def report_count(spark, sf_dir):
    return country_reports(spark, sf_dir).agg(F.count(F.lit(1)).alias("reports"))
