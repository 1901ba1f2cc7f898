"""Contracts, reasons, splits and constraints over dirtied copies of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators import constraints
from tamiz.operators.contract import (
    Contract,
    Rule,
    conservation,
    counted,
    reason_frequency,
    scope_filter,
)
from tamiz.operators.timeseries import daily_summary
from tamiz.plans import country, matches, shop
from tamiz.queries.base import query, table

KNOWN_TYPES = ["error", "click", "view", "purchase"]


def event_contract() -> Contract:
    return Contract(
        [
            Rule("event_type", allowed=KNOWN_TYPES),
            Rule("ts", "timestamp_ntz"),
            Rule("value", "double", between=(1.0, 400.0)),
            Rule("amount", "double", between=(0.0, 300.0)),
        ]
    )


def dirty_events(spark, sf_dir):
    """Events with a text amount that is unreadable or not a number for extreme values."""
    v = F.col("value")
    amount = F.when(v < 2, "NaN").when(v > 350, "n/a").otherwise(v.cast("string"))
    return table(spark, sf_dir, "events").withColumn("amount", amount)


TAGGED_SQL = """
    SELECT event_id, user_id, ts, event_type, value,
           CASE WHEN value < 2 OR value > 350 THEN NULL ELSE value END AS amount,
           nullif(concat_ws('; ',
             CASE WHEN event_type NOT IN ('error', 'click', 'view', 'purchase')
                  THEN 'event_type: isin([''error'', ''click'', ''view'', ''purchase''])' END,
             CASE WHEN value NOT BETWEEN 1 AND 400 THEN 'value: in_range(1.0, 400.0)' END,
             CASE WHEN value < 2 OR value > 350 THEN 'amount: not_nullable'
                  WHEN value > 300 THEN 'amount: in_range(0.0, 300.0)' END), '') AS motivo_rechazo
    FROM events"""


@query(f"SELECT event_id, amount, motivo_rechazo FROM ({TAGGED_SQL})")
def contract_reasons(spark, sf_dir):
    tagged = event_contract().tag(dirty_events(spark, sf_dir))
    return tagged.select("event_id", "amount", "motivo_rechazo")


@query(
    f"""SELECT user_id, CAST(ts AS DATE) AS fecha, round(avg(value), 6) AS level_mean,
    min(value) AS level_min, max(value) AS level_max, round(sum(amount), 6) AS total_sum,
    round(avg(amount), 6) AS mean_mean
    FROM ({TAGGED_SQL}) WHERE motivo_rechazo IS NULL GROUP BY user_id, CAST(ts AS DATE)"""
)
def clean_daily_series(spark, sf_dir):
    valid, _ = event_contract().split(dirty_events(spark, sf_dir))
    daily = daily_summary(valid, "user_id", "ts", "value", "amount", "amount")
    return daily.withColumns({c: F.round(c, 6) for c in ("level_mean", "total_sum", "mean_mean")})


@query(
    f"""SELECT motivo_rechazo, count(*) AS total FROM ({TAGGED_SQL})
    WHERE motivo_rechazo IS NOT NULL GROUP BY motivo_rechazo ORDER BY total DESC, motivo_rechazo"""
)
def reason_counts(spark, sf_dir):
    _, rejected = event_contract().split(dirty_events(spark, sf_dir))
    return reason_frequency(rejected)


@query(
    f"""SELECT count(*) AS input_rows, count(*) FILTER (motivo_rechazo IS NULL) AS valid_rows,
    count(motivo_rechazo) AS rejected_rows, TRUE AS conserved FROM ({TAGGED_SQL})"""
)
def conserved_rows(spark, sf_dir):
    return conservation(event_contract().tag(dirty_events(spark, sf_dir)))


@query(
    f"""SELECT motivo_rechazo IS NULL AS is_valid, count(*) AS written, (SELECT count(*) FROM events) AS rows,
    (SELECT count(*) FROM ({TAGGED_SQL}) WHERE motivo_rechazo IS NULL) AS valid,
    (SELECT count(*) FROM ({TAGGED_SQL}) WHERE motivo_rechazo IS NOT NULL) AS rejected
    FROM ({TAGGED_SQL}) GROUP BY motivo_rechazo IS NULL"""
)
def observed_counters(spark, sf_dir):
    """Counters read off the stream of rows while it is written."""
    from tamiz.runtime import work_dir

    reason = F.col("motivo_rechazo")
    watched, seen = counted(
        event_contract().tag(dirty_events(spark, sf_dir)),
        "load",
        valid=reason.isNull(),
        rejected=reason.isNotNull(),
    )
    path = work_dir(spark, "observed")
    watched.select("event_id", reason.isNull().alias("is_valid")).write.parquet(path)
    written = spark.read.parquet(path).groupBy("is_valid").agg(F.count(F.lit(1)).alias("written"))
    return written.withColumns({name: F.lit(value) for name, value in seen.get.items()})


def country_reports(spark, sf_dir):
    """Orders as noisy country reports: spaces and case by priority, currency by status."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    name, priority = F.col("n_name"), F.col("o_orderpriority")
    # Customers grow with the orders: however well their file is compressed, they are not broadcast.
    return (
        orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.when(priority == "1-URGENT", F.concat(F.lit("  "), F.lower(name)))
            .when(priority == "2-HIGH", F.concat(F.initcap(name), F.lit("\t ")))
            .when(priority == "5-LOW", F.regexp_replace(name, "NATION", "Nátìoñ"))
            .otherwise(name)
            .alias("pais_nombre_local"),
            F.col("o_totalprice").alias("superficie_valor"),
            F.when(priority == "3-MEDIUM", " SQ_MI").when(priority != "5-LOW", "km2").alias("superficie_unidad"),
            F.when(F.col("c_acctbal") < 0, F.lit(0.0))
            .when(F.col("c_acctbal") > 9800, F.lit(float("nan")))
            .otherwise(F.col("o_totalprice"))
            .alias("pib_valor"),
            F.when(F.col("o_orderstatus") == "F", " usd ")
            .when(F.col("o_orderstatus") == "O", "EUR")
            .when(F.col("c_mktsegment") == "BUILDING", "JPY")
            .otherwise("Sek")
            .alias("pib_divisa"),
        )
    )


def european_nations(spark, sf_dir):
    """Nations of all regions but one count as in scope, one of them under another name."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    kept = nation.join(region.filter("r_name <> 'ASIA'"), nation.n_regionkey == region.r_regionkey)
    alias = F.when(F.col("n_name") == "NATION_5", "FIFTH").otherwise(F.col("n_name"))
    return kept.select(alias.alias("nombre_pais"), "n_nationkey")


def nation_synonyms(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").filter("n_name = 'NATION_5'")
    return nation.select(F.col("n_name").alias("variante"), F.lit("FIFTH").alias("canonico"))


def clean_country_reports(spark, sf_dir):
    return country.clean_reports(
        country_reports(spark, sf_dir),
        european_nations(spark, sf_dir),
        synonyms=nation_synonyms(spark, sf_dir),
    )


REPORTS_SQL = """
    SELECT CASE WHEN n_name = 'NATION_5' THEN 'FIFTH' ELSE n_name END AS nombre_pais,
           r_name, o_totalprice, c_acctbal, o_orderpriority,
           CASE WHEN o_orderstatus = 'F' THEN 'USD' WHEN o_orderstatus = 'O' THEN 'EUR'
                WHEN c_mktsegment = 'BUILDING' THEN 'JPY' ELSE 'SEK' END AS divisa,
           CASE WHEN o_orderpriority = '3-MEDIUM' THEN round(o_totalprice * 2.58999::DOUBLE, 3)
                ELSE round(o_totalprice, 3) END AS superficie_km2,
           o_totalprice / CASE WHEN o_orderstatus = 'F' THEN 1.1614::DOUBLE
                               WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE
                               ELSE 11.1520::DOUBLE END AS pib_total_eur,
           CASE WHEN r_name = 'ASIA' THEN 'Entidad territorial no perteneciente a la region europea'
                WHEN c_acctbal < 0 OR c_acctbal > 9800 THEN 'Valor de PIB incoherente (PIB <= 0)'
                WHEN o_orderstatus = 'P' AND c_mktsegment = 'BUILDING'
                THEN 'Error de transformacion: Divisa no soportada en la estructura de cambio: JPY'
                END AS motivo_rechazo
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""


@query(
    f"""SELECT motivo_rechazo, count(*) AS total, min(divisa_orig) AS first_currency
    FROM (SELECT motivo_rechazo, CASE o_orderstatus WHEN 'F' THEN ' usd ' WHEN 'O' THEN 'EUR'
                 ELSE CASE divisa WHEN 'JPY' THEN 'JPY' ELSE 'Sek' END END AS divisa_orig
          FROM ({REPORTS_SQL.replace('c_acctbal, o_orderpriority', 'c_acctbal, o_orderstatus, o_orderpriority')}))
    WHERE motivo_rechazo IS NOT NULL GROUP BY motivo_rechazo"""
)
def first_match_reasons(spark, sf_dir):
    _, rejected = clean_country_reports(spark, sf_dir)
    return rejected.groupBy("motivo_rechazo").agg(
        F.count(F.lit(1)).alias("total"), F.min("pib_divisa_orig").alias("first_currency")
    )


@query(
    f"""SELECT nombre_pais, superficie_km2, round(pib_total_eur, 6) AS pib_total_eur
    FROM ({REPORTS_SQL}) WHERE motivo_rechazo IS NULL"""
)
def first_match_valid(spark, sf_dir):
    valid, _ = clean_country_reports(spark, sf_dir)
    return valid.withColumn("pib_total_eur", F.round("pib_total_eur", 6))


def shop_tables(spark, sf_dir):
    """Line items as dirty sales, parts as products, suppliers as clients."""
    part, supplier, line = (table(spark, sf_dir, t) for t in ("part", "supplier", "lineitem"))
    types = part.select(F.col("p_type").alias("NombreCategoria")).distinct()
    price = F.col("p_retailprice")
    text = F.format_string("%.2f", price)
    products = part.select(
        F.col("p_partkey").alias("ProductoID"),
        F.col("p_name").alias("NombreProducto"),
        F.col("p_type").alias("CategoriaID"),
        F.concat(text, F.lit(" €")).alias("Precio_Compra"),
        F.when(F.col("p_size") > 45, F.lit(None))
        .when(F.col("p_size") > 40, F.lit("gratis"))
        .when(F.col("p_size") > 20, F.concat(F.lit("$"), text))
        .otherwise(F.translate(text, ".", ","))
        .alias("Precio_Venta"),
        F.col("p_size").alias("Stock"),
    )
    key = F.lpad(F.col("s_suppkey").cast("string"), 8, "0")
    clients = supplier.select(
        F.col("s_suppkey").alias("ClienteID"),
        F.when(F.col("s_acctbal") < 0, F.col("s_name"))
        .when(F.col("s_acctbal") < 1000, F.concat("s_name", F.lit(", Ana")))
        .when(F.col("s_acctbal") < 2000, F.concat("s_name", F.lit(", Ana - "), key))
        .otherwise(F.concat(F.lit(" "), "s_name", F.lit(", Ana María - "), key, F.lit("z ")))
        .alias("Cliente_Data"),
        F.concat(F.lit("  "), "s_name", F.lit("@x.es ")).alias("Email"),
        F.lit("ES").alias("Pais"),
    )
    day, n = F.col("l_shipdate"), F.col("l_linenumber")
    amount = F.format_string("%.2f", F.col("l_extendedprice"))
    sales = line.select(
        F.col("l_orderkey").alias("VentaID"),
        F.when(n <= 2, F.date_format(day, "yyyy-MM-dd"))
        .when(n <= 4, F.date_format(day, "dd/MM/yyyy"))
        .when(n <= 6, F.date_format(day, "M/d/yyyy"))
        .otherwise(F.lit("INVALID_DATE"))
        .alias("Fecha"),
        F.col("l_partkey").alias("ProductoID"),
        F.col("l_linenumber").alias("VendedorID"),
        F.col("l_suppkey").alias("ClienteID"),
        F.col("l_linenumber").alias("UbicacionID"),
        F.col("l_quantity").cast("int").alias("Cantidad"),
        F.when(F.col("l_tax") >= 0.08, F.lit("NULL"))
        .when(F.col("l_discount") >= 0.1, F.concat(F.lit("-"), amount, F.lit(" €")))
        .when(F.col("l_returnflag") == "A", F.concat(amount, F.lit(" USD")))
        .when(F.col("l_returnflag") == "N", F.concat(F.translate(amount, ".", ","), F.lit(" €")))
        .otherwise(F.concat(F.lit("€ "), amount))
        .alias("MontoTotal_Raw"),
    )
    categories = types.select(F.col("NombreCategoria").alias("CategoriaID"), "NombreCategoria")
    return {"Productos": products, "Categorias": categories, "Clientes": clients, "Ventas": sales}


IN_SCOPE = ["ECONOMY", "SMALL", "PROMO"]


def clean_shop(spark, sf_dir):
    return shop.clean(shop_tables(spark, sf_dir), IN_SCOPE)


# The same texts in SQL, parsed with the SQL engine's own functions.
SHOP_SQL = """
    WITH sales AS (
      SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_returnflag,
        CASE WHEN l_linenumber <= 2 THEN strftime(l_shipdate, '%Y-%m-%d')
             WHEN l_linenumber <= 4 THEN strftime(l_shipdate, '%d/%m/%Y')
             WHEN l_linenumber <= 6 THEN month(l_shipdate) || '/' || day(l_shipdate) || '/' || year(l_shipdate)
             ELSE 'INVALID_DATE' END AS fecha,
        CASE WHEN l_tax >= 0.08::DOUBLE THEN 'NULL'
             WHEN l_discount >= 0.1::DOUBLE THEN '-' || printf('%.2f', l_extendedprice) || ' €'
             WHEN l_returnflag = 'A' THEN printf('%.2f', l_extendedprice) || ' USD'
             WHEN l_returnflag = 'N' THEN replace(printf('%.2f', l_extendedprice), '.', ',') || ' €'
             ELSE '€ ' || printf('%.2f', l_extendedprice) END AS monto
      FROM lineitem),
    parsed AS (
      SELECT *, CASE WHEN fecha LIKE '%/%' THEN coalesce(try_strptime(fecha, '%d/%m/%Y'), try_strptime(fecha, '%m/%d/%Y'))
                     ELSE try_strptime(fecha, '%Y-%m-%d') END AS dia,
             try_cast(replace(regexp_replace(monto, '[^0-9,.-]', '', 'g'), ',', '.') AS DOUBLE) AS importe
      FROM sales),
    products AS (SELECT p_partkey FROM part
                 WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO') AND p_size <= 40),
    clients AS (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 2000),
    checked AS (
      SELECT *, l_partkey NOT IN (SELECT p_partkey FROM products) AS bad_product,
             l_suppkey NOT IN (SELECT s_suppkey FROM clients) AS bad_client
      FROM parsed)"""


@query(
    SHOP_SQL
    + """
    SELECT l_orderkey AS venta_id, CAST(dia AS DATE) AS fecha, l_partkey AS producto_id, l_suppkey AS cliente_id,
           round(CASE WHEN monto LIKE '%USD%' THEN importe / 1.15::DOUBLE ELSE importe END, 2) AS monto_eur
    FROM checked WHERE dia IS NOT NULL AND importe >= 0 AND NOT bad_product AND NOT bad_client"""
)
def shop_valid_sales(spark, sf_dir):
    return clean_shop(spark, sf_dir).sales.select(
        F.col("VentaID").alias("venta_id"),
        F.col("fecha_parseada").alias("fecha"),
        F.col("ProductoID").alias("producto_id"),
        F.col("ClienteID").alias("cliente_id"),
        "monto_eur",
    )


@query(
    SHOP_SQL
    + """
    SELECT 'Ventas' AS tabla_origen, 'VentaID=' || l_orderkey || ' Fecha=''' || fecha || '''' AS datos_raw,
           'Fecha inválida: ' || fecha AS motivo_rechazo FROM checked WHERE fecha = 'INVALID_DATE'
    UNION ALL SELECT 'Ventas', 'VentaID=' || l_orderkey || ' MontoTotal_Raw=''' || monto || '''',
           CASE WHEN monto = 'NULL' THEN 'MontoTotal_Raw nulo o vacío: NULL'
                ELSE 'MontoTotal_Raw negativo: ' || monto END FROM checked WHERE importe IS NULL OR importe < 0
    UNION ALL SELECT 'Ventas', 'VentaID=' || l_orderkey || ' ProductoID=' || l_partkey,
           'Producto fuera de alcance (categoría no moda) o inexistente' FROM checked WHERE bad_product
    UNION ALL SELECT 'Ventas', 'VentaID=' || l_orderkey || ' ClienteID=' || l_suppkey,
           'Cliente en cuarentena (RF-01) o inexistente' FROM checked WHERE bad_client
    UNION ALL SELECT 'Productos', 'ProductoID=' || p_partkey || ' Precio_Venta=''' ||
           CASE WHEN p_size > 45 THEN 'None' ELSE 'gratis' END || '''',
           CASE WHEN p_size > 45 THEN 'Precio_Venta nulo o vacío: None'
                ELSE 'Precio_Venta no numérico: gratis' END
    FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO') AND p_size > 40
    UNION ALL SELECT 'Clientes', 'ClienteID=' || s_suppkey || ' Cliente_Data=''' || texto || '''',
           CASE WHEN s_acctbal < 0 THEN 'Formato Cliente_Data no reconocido: ' || texto
                WHEN s_acctbal < 1000 THEN 'DNI ausente: ' || texto
                ELSE 'DNI con formato inválido: ' || lpad(s_suppkey::VARCHAR, 8, '0') END
    FROM (SELECT *, s_name || CASE WHEN s_acctbal < 0 THEN '' WHEN s_acctbal < 1000 THEN ', Ana'
                 ELSE ', Ana - ' || lpad(s_suppkey::VARCHAR, 8, '0') END AS texto FROM supplier)
    WHERE s_acctbal < 2000"""
)
def shop_error_rows(spark, sf_dir):
    return clean_shop(spark, sf_dir).errors


@query(
    """SELECT 's' AS kept, count(*) AS products FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO')
    UNION ALL SELECT 'skipped', count(*) FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'PROMO')"""
)
def scope_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    scope = part.select("p_type").distinct().filter(F.col("p_type").isin(IN_SCOPE))
    kept, skipped = scope_filter(part, ["p_type"], scope)
    sides = kept.select(F.lit("s").alias("kept")).unionByName(
        skipped.select(F.lit("skipped").alias("kept"))
    )
    return sides.groupBy("kept").agg(F.count(F.lit(1)).alias("products"))


def match_lines(spark, sf_dir):
    """Orders as a dirty match file: mixed date layouts, spaces, missing separators."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    other = nation.select(F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("k"), F.col("n_name").alias("away"))
    day, status, price = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_totalprice")
    segment, priority = F.col("c_mktsegment"), F.col("o_orderpriority")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(other, F.col("n_regionkey") == other.k)
        .select(
            "o_orderkey",
            F.when(segment == "BUILDING", F.concat(F.lit(" "), "c_name", F.lit(" - "), F.upper("n_name"), F.lit(" ")))
            .when((segment == "MACHINERY") & (price > 400000), F.concat(F.lit("- "), "n_name"))
            .when((segment == "MACHINERY") & (price > 300000), F.col("c_name"))
            .otherwise(F.concat("c_name", F.lit(" - "), F.lower("n_name")))
            .alias("jugador_equipo"),
            F.when((segment == "FURNITURE") & (price < 50000), F.concat("n_name", F.lit(" v "), "away"))
            .otherwise(F.concat("n_name", F.lit(" vs "), "away"))
            .alias("partido"),
            F.when((status == "P") & (price < 40000), "dos").otherwise(F.substring(priority, 1, 1)).alias("goles"),
            F.when(status == "F", "NULL").when(status == "O", " ").otherwise("3").alias("asistencias"),
            F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
            .when(priority == "2-HIGH", F.date_format(day, "dd/MM/yyyy"))
            .when(priority == "3-MEDIUM", F.date_format(day, "dd-MM-yyyy"))
            .when(priority == "5-LOW", F.date_format(day, "MM-dd-yyyy"))
            .otherwise(F.date_format(day, "yyyy/MM/dd"))
            .alias("fecha_partido"),
        )
    )


MATCH_SQL = """
    WITH lines AS (
      SELECT o_orderkey, c_name, n.n_name, a.n_name AS away, o_totalprice, o_orderstatus, c_mktsegment,
        o_orderpriority, o_orderdate,
        CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' - ' || upper(n.n_name)
             WHEN c_mktsegment = 'MACHINERY' AND o_totalprice > 400000 THEN '- ' || n.n_name
             WHEN c_mktsegment = 'MACHINERY' AND o_totalprice > 300000 THEN c_name
             ELSE c_name || ' - ' || lower(n.n_name) END AS jugador_equipo,
        n.n_name || CASE WHEN c_mktsegment = 'FURNITURE' AND o_totalprice < 50000 THEN ' v ' ELSE ' vs ' END
          || a.n_name AS partido,
        CASE WHEN c_mktsegment = 'MACHINERY' AND o_totalprice > 300000 THEN ''
             ELSE upper(n.n_name[1]) || lower(n.n_name[2:]) END AS pais_de_linea,
        CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
             WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
             WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%d-%m-%Y')
             WHEN '5-LOW' THEN strftime(o_orderdate, '%m-%d-%Y')
             ELSE strftime(o_orderdate, '%Y/%m/%d') END AS fecha_partido
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n.n_nationkey
      JOIN nation a ON n.n_regionkey = a.n_nationkey),
    judged AS (
      SELECT *, CASE WHEN instr(jugador_equipo, '-') > 1 THEN c_name ELSE '' END AS nombre_jugador,
        CASE WHEN instr(jugador_equipo, '-') > 0
             THEN upper(n_name[1]) || lower(n_name[2:]) ELSE '' END AS pais,
        CASE WHEN (o_orderstatus = 'P' AND o_totalprice < 40000)
               OR (o_orderpriority = '5-LOW' AND day(o_orderdate) > 12)
             THEN 'RF-04: error de conversion de fecha (fila descartada por seguridad)'
             WHEN c_mktsegment = 'MACHINERY' AND o_totalprice > 300000
             THEN 'RF-01: jugador o pais vacio en ''' || jugador_equipo || ''''
             WHEN lower(n_name) IN ('nation_3', 'nation_12') OR lower(partido) LIKE '%nation\\_3%' ESCAPE '\\'
               OR lower(partido) LIKE '%nation\\_12%' ESCAPE '\\'
             THEN 'RF-03: pais fuera del mundial (' || pais_de_linea || ' / ' || partido || ')'
             WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'RF-04: formato de fecha no reconocido: ' || fecha_partido
             WHEN partido NOT LIKE '% vs %' THEN 'Formato de partido no reconocido: ' || partido
             END AS motivo_rechazo
      FROM lines)"""
EXCLUDED = ["nation_3", "nation_12"]


def tag_matches(spark, sf_dir):
    return matches.tag_rows(match_lines(spark, sf_dir), EXCLUDED)


@query(
    MATCH_SQL
    + """
    SELECT motivo_rechazo, jugador_equipo, partido, fecha_partido FROM judged WHERE motivo_rechazo IS NOT NULL"""
)
def ordered_split_rejected(spark, sf_dir):
    tagged = tag_matches(spark, sf_dir).filter(F.col("motivo_rechazo").isNotNull())
    return tagged.select("motivo_rechazo", "jugador_equipo", "partido", "fecha_partido")


@query(
    MATCH_SQL
    + """
    SELECT nombre_jugador, pais, n_name AS equipo_local, away AS equipo_visitante,
           CAST(CASE WHEN o_orderpriority = '5-LOW' THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
                ELSE o_orderdate END AS DATE) AS fecha_partido,
           CAST(o_orderpriority[1] AS INTEGER) AS goles,
           CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END AS asistencias
    FROM judged WHERE motivo_rechazo IS NULL"""
)
def ordered_split_valid(spark, sf_dir):
    tagged = tag_matches(spark, sf_dir).filter(F.col("motivo_rechazo").isNull())
    return tagged.select(
        "nombre_jugador",
        "pais",
        "equipo_local",
        "equipo_visitante",
        F.col("_date").alias("fecha_partido"),
        F.col("_goals").alias("goles"),
        F.col("_assists").alias("asistencias"),
    )


@query(
    """SELECT 'line key unique' AS constraint_name,
      (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'order key unique',
      (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
    UNION ALL SELECT 'sales have an in-scope part',
      (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40))
    UNION ALL SELECT 'orders have a customer',
      (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
    UNION ALL SELECT 'quantity above 0', (SELECT count(*) FROM lineitem WHERE l_quantity <= 0)
    UNION ALL SELECT 'discount below 0.1', (SELECT count(*) FROM lineitem WHERE l_discount >= 0.1::DOUBLE)
    UNION ALL SELECT 'part known', (SELECT count(*) FROM lineitem WHERE l_partkey IS NULL)
    UNION ALL SELECT 'balance not negative', (SELECT count(*) FROM customer WHERE c_acctbal < 0)"""
)
def constraint_violations(spark, sf_dir):
    line, orders, customer, part = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "part")
    )
    return constraints.violations(
        constraints.unique_check(line, "line key unique", ["l_orderkey", "l_linenumber"]),
        constraints.unique_check(orders, "order key unique", ["o_orderkey"]),
        constraints.foreign_key_check(
            line, "sales have an in-scope part", ["l_partkey"], part.filter("p_size <= 40"), ["p_partkey"]
        ),
        constraints.foreign_key_check(
            orders, "orders have a customer", ["o_custkey"], customer, ["c_custkey"]
        ),
        constraints.row_checks(
            line,
            {
                "quantity above 0": F.col("l_quantity") > 0,
                "discount below 0.1": F.col("l_discount") < 0.1,
                "part known": F.col("l_partkey").isNotNull(),
            },
        ),
        constraints.row_checks(customer, {"balance not negative": F.col("c_acctbal") >= 0}),
    )


@query(
    """WITH ordered AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'),
         indebted AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < 0)
    SELECT k, 'left' AS side FROM indebted WHERE k NOT IN (SELECT k FROM ordered)
    UNION ALL SELECT k, 'right' FROM ordered WHERE k NOT IN (SELECT k FROM indebted)"""
)
def key_set_difference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    customer = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return constraints.key_difference(
        customer.select(F.col("c_custkey").alias("k")),
        orders.select(F.col("o_custkey").alias("k")),
        "k",
    )


@query(
    """SELECT (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) = 0 AS is_subset"""
)
def key_subset(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return constraints.is_subset(
        orders.select(F.col("o_custkey").alias("k")),
        customer.select(F.col("c_custkey").alias("k")),
        "k",
    )


@query(
    """SELECT 'nations' AS expectation, 25.0::DOUBLE AS expected, count(*)::DOUBLE AS actual, count(*) = 25 AS passed FROM nation
    UNION ALL SELECT 'key total', 300.0::DOUBLE, sum(n_nationkey)::DOUBLE, sum(n_nationkey) = 300 FROM nation
    UNION ALL SELECT 'regions', 4.0::DOUBLE, count(DISTINCT n_regionkey)::DOUBLE, count(DISTINCT n_regionkey) = 4 FROM nation"""
)
def expected_figures(spark, sf_dir):
    return constraints.expectations(
        table(spark, sf_dir, "nation"),
        {
            "nations": (F.count(F.lit(1)), 25),
            "key total": (F.sum("n_nationkey"), 300),
            "regions": (F.count_distinct("n_regionkey"), 4),
        },
    )


@query(
    """SELECT event_type, ts, value FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL
    AND value <= 350 AND value >= 2"""
)
def complete_rows(spark, sf_dir):
    """Rows complete in a subset of columns, after unreadable amounts became NULL."""
    typed = event_contract().coerce(dirty_events(spark, sf_dir))
    return typed.dropna(subset=["event_type", "amount"]).select("event_type", "ts", "value")
