"""Text keys and dirty-value parsers over whole documents and decorated columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.functions import parse, text, units
from tamiz.functions.rows import json_field, key_values, row_json
from tamiz.operators.consolidate import translate_codes
from tamiz.queries.base import query, table
from tamiz.sources.delimited import sheet_rows
from tamiz.sources.relational import currency_rates

# White space as the text functions see it, for the SQL side.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


@query(
    rf"""SELECT doc_id, md5(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) AS stripped,
    md5(regexp_replace(text, '{WS}+', ' ', 'g')) AS collapsed,
    md5(regexp_replace(text, '{WS}*-{WS}*', '-', 'g')) AS hyphens,
    md5(trim(text)) AS trimmed, md5(upper(text[1]) || lower(text[2:])) AS capitalised
    FROM documents"""
)
def text_spacing(spark, sf_dir):
    raw = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text.strip_space(raw)).alias("stripped"),
        F.md5(text.collapse_space(raw)).alias("collapsed"),
        F.md5(text.tighten_hyphens(raw)).alias("hyphens"),
        F.md5(F.trim(raw)).alias("trimmed"),
        F.md5(text.capitalise(raw)).alias("capitalised"),
    )


@query(
    rf"""SELECT doc_id, md5(strip_accents(text)) AS plain,
    md5(upper(replace(strip_accents(regexp_replace(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'), '{WS}+', ' ', 'g')), 'ß', 'ss'))) AS country,
    md5(upper(replace(strip_accents(regexp_replace(regexp_replace(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'),
        '{WS}*-{WS}*', '-', 'g'), '{WS}+', ' ', 'g')), 'ß', 'ss'))) AS district
    FROM documents"""
)
def text_keys(spark, sf_dir):
    raw = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text.strip_accents(raw)).alias("plain"),
        F.md5(text.country_key(raw)).alias("country"),
        F.md5(text.district_key(raw)).alias("district"),
    )


@query(
    r"""SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(text, '\p{L}+|[^\p{L}]+'),
    lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), '')) AS titled FROM documents"""
)
def title_case_text(spark, sf_dir):
    titled = F.md5(text.title_case(F.col("text"))).alias("titled")
    return table(spark, sf_dir, "documents").select("doc_id", titled)


@query(
    """SELECT n_nationkey, coalesce(r_name, upper(trim(n_name))) AS canonical
    FROM nation LEFT JOIN region ON upper(trim(n_name)) = 'NATION_' || r_regionkey"""
)
def synonym_translation(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    noisy = nation.select(
        "n_nationkey", text.country_key(F.concat(F.lit(" "), F.lower("n_name"), F.lit("\t"))).alias("k")
    )
    codes = region.select(F.concat(F.lit("NATION_"), "r_regionkey").alias("variant"), "r_name")
    named = translate_codes(noisy, "k", codes, "variant", "r_name", "canonical")
    return named.select("n_nationkey", "canonical")


@query(
    """WITH dirty AS (SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN ' ' || printf('%.2f', o_totalprice) || ' €'
        WHEN '2-HIGH' THEN 'USD ' || printf('%.2f', o_totalprice)
        WHEN '3-MEDIUM' THEN replace(printf('%.2f', o_totalprice), '.', ',')
        WHEN '5-LOW' THEN '-' || printf('%.2f', o_totalprice) || '$'
        ELSE CASE o_orderstatus WHEN 'F' THEN 'null' WHEN 'O' THEN '1.234,56' ELSE NULL END END AS t FROM orders),
    parsed AS (SELECT *, try_cast(replace(regexp_replace(upper(t), '[^0-9,.-]', '', 'g'), ',', '.') AS DOUBLE) AS n FROM dirty)
    SELECT o_orderkey, CASE WHEN n >= 0 THEN round(CASE WHEN t LIKE '%USD%' OR t LIKE '%$%' THEN n / 1.15::DOUBLE ELSE n END, 2) END AS amount,
      CASE WHEN t IS NULL THEN 'Importe nulo o vacío: None' WHEN t = 'null' THEN 'Importe nulo o vacío: null'
           WHEN n IS NULL THEN 'Importe no numérico: ' || t WHEN n < 0 THEN 'Importe negativo: ' || t END AS reason
    FROM parsed"""
)
def parse_money(spark, sf_dir):
    price = F.format_string("%.2f", F.col("o_totalprice"))
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    dirty = (
        F.when(priority == "1-URGENT", F.concat(F.lit(" "), price, F.lit(" €")))
        .when(priority == "2-HIGH", F.concat(F.lit("USD "), price))
        .when(priority == "3-MEDIUM", F.translate(price, ".", ","))
        .when(priority == "5-LOW", F.concat(F.lit("-"), price, F.lit("$")))
        .when(status == "F", "null")
        .when(status == "O", "1.234,56")
    )
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", parse.money(dirty).alias("m"))
    return parsed.select("o_orderkey", F.col("m.value").alias("amount"), "m.reason")


@query(
    """WITH dirty AS (SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
        WHEN '3-MEDIUM' THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
        WHEN '5-LOW' THEN strftime(o_orderdate, '%Y.%m.%d')
        ELSE CASE o_orderstatus WHEN 'F' THEN 'invalid_date' WHEN 'O' THEN '30/02/2021' ELSE NULL END END AS t FROM orders),
    parsed AS (SELECT *, CASE WHEN t LIKE '%/%' THEN coalesce(try_strptime(t, '%d/%m/%Y'), try_strptime(t, '%m/%d/%Y'))
        ELSE try_strptime(trim(t), '%Y-%m-%d') END::DATE AS d FROM dirty)
    SELECT o_orderkey, d AS day, CASE WHEN t IS NULL THEN 'Fecha inválida: None'
        WHEN t = 'invalid_date' THEN 'Fecha inválida: ' || t
        WHEN d IS NULL THEN 'Formato de fecha no reconocido: ' || t END AS reason FROM parsed"""
)
def parse_dates(spark, sf_dir):
    day, priority, status = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    dirty = (
        F.when(priority == "1-URGENT", F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd")))
        .when(priority == "2-HIGH", F.date_format(day, "dd/MM/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(day, "M/d/yyyy"))
        .when(priority == "5-LOW", F.date_format(day, "yyyy.MM.dd"))
        .when(status == "F", "invalid_date")
        .when(status == "O", "30/02/2021")
    )
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", parse.date(dirty).alias("d"))
    return parsed.select("o_orderkey", F.col("d.value").alias("day"), "d.reason")


@query(
    """WITH dirty AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN c_name
          WHEN 'AUTOMOBILE' THEN ' De ' || c_mktsegment || ', ' || c_name
          WHEN 'MACHINERY' THEN 'Sur, Ana-María' WHEN 'FURNITURE' THEN 'Sur, ' || c_name || ' - ' || c_custkey
          ELSE 'Sur Este, José Luis - ' || lpad(c_custkey::VARCHAR, 8, '0') || 'z  ' END AS t,
          c_mktsegment, c_name, c_custkey AS k FROM customer)
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'Ana'
        WHEN 'AUTOMOBILE' THEN c_name WHEN 'FURNITURE' THEN c_name ELSE 'José Luis' END AS nombre,
      CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'AUTOMOBILE' THEN 'De AUTOMOBILE'
        WHEN 'MACHINERY' THEN 'Sur' WHEN 'FURNITURE' THEN 'Sur' ELSE 'Sur Este' END AS apellidos,
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'María' WHEN 'FURNITURE' THEN k::VARCHAR
        WHEN 'BUILDING' THEN NULL WHEN 'AUTOMOBILE' THEN NULL ELSE lpad(k::VARCHAR, 8, '0') || 'Z' END AS dni,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'Formato Cliente_Data no reconocido: ' || t
        WHEN 'AUTOMOBILE' THEN 'DNI ausente: ' || t WHEN 'MACHINERY' THEN 'DNI con formato inválido: María'
        WHEN 'FURNITURE' THEN 'DNI con formato inválido: ' || k END AS reason FROM dirty"""
)
def parse_clients(spark, sf_dir):
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    dirty = (
        F.when(segment == "BUILDING", F.col("c_name"))
        .when(segment == "AUTOMOBILE", F.concat(F.lit(" De "), segment, F.lit(", "), "c_name"))
        .when(segment == "MACHINERY", "Sur, Ana-María")
        .when(segment == "FURNITURE", F.concat(F.lit("Sur, "), "c_name", F.lit(" - "), key))
        .otherwise(F.concat(F.lit("Sur Este, José Luis - "), F.lpad(key, 8, "0"), F.lit("z  ")))
    )
    parsed = table(spark, sf_dir, "customer").select("c_custkey", parse.client(dirty).alias("c"))
    return parsed.select("c_custkey", "c.*")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice * 2.58999::DOUBLE, 3)
          ELSE round(o_totalprice, 3) END AS area,
      o_totalprice / CASE o_orderstatus WHEN 'F' THEN 1.1614::DOUBLE WHEN 'O' THEN 363.95::DOUBLE END AS euros,
      CASE WHEN o_totalprice / CASE o_orderstatus WHEN 'F' THEN 1.1614::DOUBLE WHEN 'O' THEN 363.95::DOUBLE END IS NULL
        THEN 'Divisa no soportada: JPY' END AS reason,
      round_even(o_totalprice / (o_custkey + 1) * 100, 0) / 100 AS per_head,
      round_even((o_custkey + 1) / o_totalprice * 10000, 0) / 10000 AS density,
      o_totalprice / (o_custkey + 1) * 10000 AS energy FROM orders"""
)
def units_and_currencies(spark, sf_dir):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    unit = F.when(F.col("o_orderpriority") == "1-URGENT", " SQ_MI ").otherwise(F.col("o_orderpriority"))
    code = F.when(status == "F", "USD").when(status == "O", "HUF").otherwise("JPY").alias("divisa")
    people = F.col("o_custkey") + 1
    orders = table(spark, sf_dir, "orders").select("*", code)
    rated = orders.join(F.broadcast(currency_rates(spark)), "divisa", "left")
    return rated.select(
        "o_orderkey",
        units.area_km2(price, unit).alias("area"),
        units.to_eur(price, F.col("tasa")).alias("euros"),
        F.when(F.col("tasa").isNull(), F.concat(F.lit("Divisa no soportada: "), "divisa")).alias("reason"),
        units.per_capita(price, people).alias("per_head"),
        units.population_density(people, price).alias("density"),
        units.energy_density(price, people).alias("energy"),
    )


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 9 < 9 THEN lpad(CAST(s_suppkey % 11 + 1 AS VARCHAR), 2, '0') END AS id,
       round(s_acctbal, 2) AS income FROM supplier WHERE s_nationkey < 20"""
)
def regex_sheet(spark, sf_dir):
    """District rows picked out of a text sheet made of every supplier."""
    number = F.lpad((F.col("s_suppkey") % 11 + 1).cast("string"), 2, "0")
    label = F.concat(F.lit("41091"), number, F.lit(" Sevilla distrito "), number)
    cell = F.when(F.col("s_nationkey") < 20, F.concat(F.lit(" "), label)).otherwise(
        F.concat(F.lit("41092"), number, F.lit(" Otro distrito "), number)
    )
    sheet = table(spark, sf_dir, "supplier").select(
        cell.alias("cell"), F.struct("s_suppkey", "s_acctbal").alias("row")
    )
    picked = sheet_rows(sheet, "cell", r"^41091(0[1-9]|1[01]) Sevilla distrito (\d{2})$", 2, "row")
    return picked.select("row.s_suppkey", "id", F.round("row.s_acctbal", 2).alias("income"))


@query(
    """SELECT c_custkey, 'clave=' || c_custkey || '; segmento=' || c_mktsegment || '; vacio=' AS raw_text,
    c_name AS name_field, CAST(NULL AS VARCHAR) AS empty_field, c_nationkey::VARCHAR AS nation_field FROM customer"""
)
def row_renderings(spark, sf_dir):
    """Rows as 'k=v' text and as JSON with NULL fields kept, read back field by field."""
    customer = table(spark, sf_dir, "customer")
    empty = F.lit(None).cast("string")
    document = row_json("c_name", "c_nationkey", empty.alias("missing"))
    pairs = {"clave": F.col("c_custkey"), "segmento": F.col("c_mktsegment"), "vacio": empty}
    return customer.select(
        "c_custkey",
        key_values(pairs).alias("raw_text"),
        json_field(document, "c_name").alias("name_field"),
        json_field(document, "missing").alias("empty_field"),
        json_field(document, "c_nationkey").alias("nation_field"),
    )


@query(
    """SELECT conv_id, turn, split_part(text, '.', 1) = text AS whole,
    '<b>' || upper(role[1]) || lower(role[2:]) || '</b>: ' || length(text) || ' car.' AS popup FROM conversations"""
)
def popup_labels(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    popup = text.label("<b>%s</b>: %d car.", text.title_case(F.col("role")), F.length("text"))
    return turns.select(
        "conv_id", "turn", (~F.col("text").contains(".")).alias("whole"), popup.alias("popup")
    )
