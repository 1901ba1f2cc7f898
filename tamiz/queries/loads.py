"""Upserts, dimension and fact loads, change logs, exports and run audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tamiz.functions.rows import json_field
from tamiz.operators.audit import change_log, run_finished, run_started
from tamiz.operators.constraints import same_content
from tamiz.operators.latest import newest_first
from tamiz.operators.star import fact_rows, insert_new_members
from tamiz.plans import matches, shop
from tamiz.queries.base import query, table
from tamiz.queries.quality import (
    IN_SCOPE,
    MATCH_SQL,
    SHOP_SQL,
    event_contract,
    dirty_events,
    match_lines,
    shop_tables,
)
from tamiz.runtime import checkpoint, work_dir
from tamiz.sinks.files import export_csv, write_staging
from tamiz.sinks.folders import current_commit, insert_absent_folders, read_changes, read_folders, upsert_folders
from tamiz.sinks.tables import (
    append,
    append_absent,
    merge_partitions,
    overwrite_partitions,
    publish,
    read_current,
    upsert,
    upsert_by_bucket,
    upsert_into,
)
from tamiz.sources.delimited import read_staged, read_text_table, split_text_table

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def stored_customers(spark, sf_dir):
    """The target before the load: customers of most segments, with a load day."""
    known = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'FURNITURE'")
    return known.withColumn("loaded", F.lit("2024-01-01").cast("date"))


def incoming_customers(spark, sf_dir):
    """The delivery: customers with a positive balance, builders with a higher one."""
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100)
    fresh = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return fresh.withColumn("c_acctbal", raised.otherwise(F.col("c_acctbal")))


INCOMING_SQL = """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
      CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
    FROM customer WHERE c_acctbal > 0"""
UPSERT_SQL = f"""
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, DATE '2024-02-02' AS loaded FROM ({INCOMING_SQL})
    UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, DATE '2024-01-01' FROM customer
    WHERE c_mktsegment <> 'FURNITURE' AND c_acctbal <= 0"""


@query(UPSERT_SQL)
def upsert_customers(spark, sf_dir):
    refreshed = {"loaded": F.lit("2024-02-02").cast("date")}
    return upsert(
        stored_customers(spark, sf_dir), incoming_customers(spark, sf_dir), ["c_custkey"], refreshed
    )


@query(UPSERT_SQL.replace("DATE '2024-02-02'", "CASE WHEN c_mktsegment <> 'FURNITURE' THEN DATE '2024-01-01' END"))
def upsert_keeping_columns(spark, sf_dir):
    """Columns the delivery lacks keep their stored value."""
    return upsert(stored_customers(spark, sf_dir), incoming_customers(spark, sf_dir), ["c_custkey"])


@query(UPSERT_SQL)
def upsert_in_buckets(spark, sf_dir):
    """The same upsert into a table stored by key hash, delivered twice."""
    path, key = work_dir(spark, "buckets"), ["c_custkey"]
    upsert_by_bucket(path, stored_customers(spark, sf_dir), key, 16)
    refreshed = {"loaded": F.lit("2024-02-02").cast("date")}
    for _ in range(2):
        upsert_by_bucket(path, incoming_customers(spark, sf_dir), key, 16, refreshed)
    return spark.read.parquet(path).select(*CUSTOMER, "loaded")


CHANGED_SQL = f"""
    SELECT n.c_custkey, o.c_custkey IS NULL AS fresh, o.c_acctbal AS before_balance, n.c_acctbal AS after_balance
    FROM ({INCOMING_SQL}) n LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'FURNITURE') o USING (c_custkey)
    WHERE o.c_custkey IS NULL OR o.c_acctbal <> n.c_acctbal"""


def _customer_folders(spark, sf_dir):
    """A logged table after its first load and three deliveries, of which the last two repeat the first."""
    path, key = work_dir(spark, "folders"), ["c_custkey"]
    incoming = incoming_customers(spark, sf_dir)
    days = {"loaded": F.lit("2024-02-02").cast("date")}
    upsert_folders(path, stored_customers(spark, sf_dir), key, 16, logged=True)
    for delivery in (incoming, incoming, incoming.repartition(3).sortWithinPartitions(F.desc("c_custkey"))):
        upsert_folders(path, delivery, key, 16, days, logged=True)
    return path


@query(
    f"""SELECT c_custkey, c_name, c_nationkey, c_mktsegment, coalesce(after_balance, c_acctbal) AS c_acctbal,
      CASE WHEN after_balance IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-02-02' END AS loaded, 2 AS version
    FROM customer LEFT JOIN ({CHANGED_SQL}) USING (c_custkey) WHERE c_mktsegment <> 'FURNITURE' OR c_acctbal > 0"""
)
def upsert_in_folders(spark, sf_dir):
    """Only rows that are new or differ take the new day; repeated deliveries make no further version."""
    path = _customer_folders(spark, sf_dir)
    version = current_commit(spark, path).version
    return read_folders(spark, path).select(*CUSTOMER, "loaded", F.lit(version).alias("version"))


@query(
    f"""SELECT CASE WHEN fresh THEN 'INSERT' ELSE 'UPDATE' END AS operacion, c_custkey, 2 AS version,
      before_balance, after_balance FROM ({CHANGED_SQL})
    UNION ALL SELECT 'INSERT', c_custkey, 1, NULL, c_acctbal FROM customer WHERE c_mktsegment <> 'FURNITURE'"""
)
def change_log_of_folders(spark, sf_dir):
    """Each row written, once, whatever is delivered again."""
    balances = {
        name: json_field(F.col(image), "c_acctbal").cast("double")
        for name, image in (("before_balance", "datos_anteriores"), ("after_balance", "datos_nuevos"))
    }
    log = read_changes(spark, _customer_folders(spark, sf_dir)).withColumns(balances)
    return log.select("operacion", "c_custkey", "version", *balances)


@query(
    """SELECT DISTINCT o_orderpriority, nullif(o_orderstatus, 'P') AS state FROM orders
    WHERE o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '1998-01-01'"""
)
def insert_absent_in_folders(spark, sf_dir):
    """Overlapping deliveries with NULL keys; each distinct key is added once."""
    orders = table(spark, sf_dir, "orders")
    keys, path = ["o_orderpriority", "state"], work_dir(spark, "absent-folders")
    state = F.nullif("o_orderstatus", F.lit("P")).alias("state")
    for where in ("o_orderstatus = 'P'", "o_orderdate >= '1998-01-01' OR o_orderstatus = 'P'", "o_orderstatus = 'P'"):
        insert_absent_folders(path, orders.filter(where).select("o_orderpriority", state), keys, 8)
    return read_folders(spark, path)


@query("SELECT 0 AS only_left, 0 AS only_right, (SELECT count(*) FROM customer WHERE c_mktsegment <> 'FURNITURE' OR c_acctbal > 0) AS rows")
def idempotent_reload(spark, sf_dir):
    """The same delivery upserted twice into a published table leaves the same content."""
    path = work_dir(spark, "reload")
    publish(stored_customers(spark, sf_dir).drop("loaded"), path)
    once = upsert_into(path, incoming_customers(spark, sf_dir), ["c_custkey"])
    twice = upsert_into(path, incoming_customers(spark, sf_dir), ["c_custkey"])
    rows = twice.agg(F.count(F.lit(1))).scalar()
    return same_content(once, twice).withColumn("rows", rows)


@query(
    """SELECT 'orders' AS tabla_origen, o_orderpriority || '/' || o_orderstatus AS datos_raw,
    CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'late' END AS motivo_rechazo
    FROM orders WHERE o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL"""
)
def insert_if_absent(spark, sf_dir):
    """Two overlapping error deliveries; each distinct error is filed once."""
    orders = table(spark, sf_dir, "orders")
    reason = F.when(F.col("o_orderstatus") == "P", "pending").otherwise("late")
    errors = orders.select(
        F.lit("orders").alias("tabla_origen"),
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("datos_raw"),
        reason.alias("motivo_rechazo"),
        "o_orderdate",
        "o_orderstatus",
    )
    keys, path = ["tabla_origen", "datos_raw", "motivo_rechazo"], work_dir(spark, "absent")
    append_absent(path, errors.filter("o_orderstatus = 'P'").select(*keys), keys)
    late = errors.filter("o_orderdate >= '1998-01-01' OR o_orderstatus = 'P'").select(*keys)
    return append_absent(path, late, keys)


@query(
    """WITH first AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 25),
    later AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 25)
    SELECT row_number() OVER (ORDER BY p_brand, p_type) AS kind_id, p_brand, p_type FROM first
    UNION ALL SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY p_brand, p_type), p_brand, p_type
    FROM (SELECT * FROM later EXCEPT SELECT * FROM first)"""
)
def dimension_keys(spark, sf_dir):
    """Two loads of a dimension: the second one only adds members, with following keys."""
    part, key = table(spark, sf_dir, "part"), ["p_brand", "p_type"]
    path = work_dir(spark, "dimension")
    publish(insert_new_members(None, part.filter("p_size <= 25"), key, "kind_id"), path)
    known = read_current(spark, path)
    return known.unionByName(insert_new_members(known, part, key, "kind_id"))


@query(
    """WITH kinds AS (SELECT row_number() OVER (ORDER BY p_brand, p_type) AS kind_id, p_brand, p_type
                   FROM (SELECT DISTINCT p_brand, p_type FROM part)),
    nations AS (SELECT row_number() OVER (ORDER BY n_name) AS nation_id, n_name FROM nation)
    SELECT kind_id, nation_id, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN kinds USING (p_brand, p_type) JOIN nations USING (n_name)
    GROUP BY kind_id, nation_id"""
)
def fact_upsert(spark, sf_dir):
    """Facts per pair of surrogate keys with maxima, upserted over an earlier load."""
    line, part, supplier, nation = (
        table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation")
    )
    staged = (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
    )
    kinds = insert_new_members(None, part, ["p_brand", "p_type"], "kind_id")
    nations = insert_new_members(None, nation, ["n_name"], "nation_id")
    dimensions = [(kinds, ["p_brand", "p_type"], "kind_id"), (nations, ["n_name"], "nation_id")]
    measures = ["l_quantity", "l_extendedprice"]
    earlier = fact_rows(staged.filter("l_returnflag = 'A'"), dimensions, measures)
    return upsert(earlier, fact_rows(staged, dimensions, measures), ["kind_id", "nation_id"], check=False)


def _snapshots(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return (
        customer.filter("c_mktsegment <> 'FURNITURE'"),
        incoming_customers(spark, sf_dir).select(*customer.columns),
    )


CHANGES_SQL = f"""
    WITH old AS (SELECT * FROM customer WHERE c_mktsegment <> 'FURNITURE'), new AS ({INCOMING_SQL})
    SELECT CASE WHEN o.c_custkey IS NULL THEN 'INSERT' WHEN n.c_custkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operacion,
      coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_acctbal AS before_balance, n.c_acctbal AS after_balance,
      o.c_name AS before_name, n.c_name AS after_name
    FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey"""


def _fields(log):
    old, new = F.col("datos_anteriores"), F.col("datos_nuevos")
    return log.select(
        "operacion",
        "c_custkey",
        json_field(old, "c_acctbal").cast("double").alias("before_balance"),
        json_field(new, "c_acctbal").cast("double").alias("after_balance"),
        json_field(old, "c_name").alias("before_name"),
        json_field(new, "c_name").alias("after_name"),
    )


@query(f"SELECT * FROM ({CHANGES_SQL}) WHERE before_balance IS DISTINCT FROM after_balance")
def change_log_fields(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return _fields(change_log(old, new, "c_custkey"))


@query(CHANGES_SQL)
def change_log_touched(spark, sf_dir):
    """Rewriting a row with equal values is logged as an update too."""
    old, new = _snapshots(spark, sf_dir)
    return _fields(change_log(old, new, "c_custkey", touched=new))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf_dir):
    """Delimited text without quoting, read back with '' for empty fields, then typed."""
    customer, path = table(spark, sf_dir, "customer"), work_dir(spark, "text")
    write_staging(customer, path, ";", quoted=False)
    lines = read_text_table(spark, path, CUSTOMER, ";")
    types = {"c_custkey": "long", "c_nationkey": "int", "c_acctbal": "double"}
    return lines.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


@query(
    """SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS kind,
    length(CASE WHEN event_type = 'view' THEN '' ELSE event_type END) AS letters FROM events"""
)
def empty_text_fields(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    path = work_dir(spark, "empty")
    events = table(spark, sf_dir, "events").select("event_id", kind.alias("kind"))
    write_staging(events, path, ";", quoted=False)
    read = read_text_table(spark, path, ["event_id", "kind"], ";")
    return read.select(F.col("event_id").cast("long"), "kind", F.length("kind").alias("letters"))


@query(
    """SELECT CASE event_id % 5 WHEN 1 THEN '2 fields instead of 3' WHEN 2 THEN '4 fields instead of 3' ELSE 'whole' END AS resultado,
      event_id || CASE event_id % 5 WHEN 1 THEN ';' || event_type WHEN 2 THEN ';' || event_type || ';;x' WHEN 3 THEN ';;'
                  ELSE ';' || event_type || ';' || user_id END AS datos_raw FROM events"""
)
def ragged_lines(spark, sf_dir):
    """Lines with too few or too many fields are filed with their text, the others read."""
    path, kind = work_dir(spark, "ragged"), F.col("event_id") % 5
    events = table(spark, sf_dir, "events")
    whole = F.concat_ws(";", "event_id", "event_type", "user_id")
    line = (
        F.when(kind == 1, F.concat_ws(";", "event_id", "event_type")).when(kind == 2, F.concat_ws(";", "event_id", "event_type", F.lit(""), F.lit("x")))
        .when(kind == 3, F.concat("event_id", F.lit(";;"))).otherwise(whole)
    )
    header = events.limit(1).select(F.lit("event_id;kind;user_id").alias("line"))
    header.unionByName(events.select(line.alias("line"))).write.text(path)
    rows, ragged = split_text_table(spark, path, ["event_id", "kind", "user_id"])
    good = rows.select(F.lit("whole").alias("resultado"), F.concat_ws(";", *rows.columns).alias("datos_raw"))
    return good.unionByName(ragged.withColumnRenamed("motivo_rechazo", "resultado"))


@query("SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_day FROM orders")
def bulk_staging(spark, sf_dir):
    """A typed pipe-separated bulk load; the staging area is replaced on every run."""
    orders, path = table(spark, sf_dir, "orders"), work_dir(spark, "staging")
    rows = orders.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_day"))
    write_staging(rows.filter("o_totalprice > 0"), path)
    write_staging(rows, path)
    return read_staged(spark, path, "o_orderkey bigint, o_totalprice double, o_day date")


@query("SELECT count(*) AS rows FROM supplier")
def csv_export(spark, sf_dir):
    rows = export_csv(table(spark, sf_dir, "supplier"), work_dir(spark, "export"))
    return spark.createDataFrame([(rows,)], "rows long")


TWO_LOADS_SQL = """
    SELECT event_id, user_id, event_type, month(ts)::INTEGER AS mes, year(ts)::INTEGER AS anio,
      CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1000 ELSE value END AS value,
      CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'b2' ELSE 'b1' END AS batch
    FROM events"""


def _loads(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumns(
        {"anio": F.year("ts"), "mes": F.month("ts")}
    )
    columns = ["event_id", "user_id", "event_type", "mes", "anio", "value", "batch"]
    first = events.filter("ts < '2024-01-20'").withColumn("batch", F.lit("b1")).select(*columns)
    second = (
        events.filter("ts >= '2024-01-15'")
        .withColumns({"batch": F.lit("b2"), "value": F.col("value") + 1000})
        .select(*columns)
    )
    return first, second


PARTS = ["event_type", "anio", "mes"]


@query(TWO_LOADS_SQL)
def partition_merge(spark, sf_dir):
    """Two overlapping loads merged latest-wins, the second one twice."""
    first, second = _loads(spark, sf_dir)
    path = work_dir(spark, "merge")
    for load in (first, second, second, first):
        merge_partitions(path, load, ["event_id"], newest_first("batch"), PARTS)
    columns = ["event_id", "user_id", "event_type", "mes", "anio", "value", "batch"]
    return spark.read.parquet(path).select(*columns)


@query(f"SELECT * FROM ({TWO_LOADS_SQL}) WHERE batch = 'b2' OR event_type = 'view'")
def partition_rebuild(spark, sf_dir):
    """A forced rebuild replaces the touched partitions and leaves the others alone."""
    first, second = _loads(spark, sf_dir)
    path = work_dir(spark, "rebuild")
    merge_partitions(path, first, ["event_id"], newest_first("batch"), PARTS)
    views = second.filter("event_type = 'view'")
    others = second.filter("event_type <> 'view'")
    merge_partitions(path, views, ["event_id"], newest_first("batch"), PARTS)
    merge_partitions(path, others, ["event_id"], newest_first("batch"), PARTS, rebuild=True)
    columns = ["event_id", "user_id", "event_type", "mes", "anio", "value", "batch"]
    return spark.read.parquet(path).select(*columns)


@query("SELECT event_id, value, event_type FROM events WHERE event_type = 'purchase'")
def pruned_scan(spark, sf_dir):
    """A table replaced per key folder, read for one key only."""
    events, path = table(spark, sf_dir, "events"), work_dir(spark, "mart")
    overwrite_partitions(path, events.select("event_id", "value", "event_type"), ["event_type"])
    return spark.read.parquet(path).filter("event_type = 'purchase'")


@query(
    """SELECT run, count(*) AS filed FROM events, (VALUES (1), (2)) r(run)
    WHERE value NOT BETWEEN 1 AND 400 OR value < 2 OR value > 300 OR event_type = 'signup' GROUP BY run"""
)
def quarantine_history(spark, sf_dir):
    """Rejected rows tagged with their run pile up over runs."""
    _, rejected = event_contract().split(dirty_events(spark, sf_dir))
    path = work_dir(spark, "quarantine")
    for run in (1, 2):
        append(path, rejected, run=F.lit(run))
    return spark.read.parquet(path).groupBy("run").agg(F.count(F.lit(1)).alias("filed"))


RUN_SQL = """
    SELECT 1 AS id_ejecucion, TIMESTAMP '2024-03-01 10:00:00' AS fecha_inicio, TIMESTAMP '2024-03-01 10:00:07' AS fecha_fin,
      (SELECT count(*) FROM orders) AS registros_leidos, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS registros_insertados,
      (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS registros_error, 'API' AS origen, 'OK' AS estado, 'Duracion: 7 s' AS observaciones
    UNION ALL SELECT 2, TIMESTAMP '2024-03-02 10:00:00', TIMESTAMP '2024-03-02 10:00:01', 0, 0, 0, NULL, 'ERROR', 'boom'"""


def _runs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    counts = orders.agg(
        F.count(F.lit(1)).alias("read"), F.count_if(F.col("o_orderstatus") == "P").alias("bad")
    ).first()
    path = work_dir(spark, "runs")
    first = run_started(spark, 1, datetime(2024, 3, 1, 10))
    upsert_into(path, first, ["id_ejecucion"])
    done = run_finished(
        first,
        datetime(2024, 3, 1, 10, 0, 7),
        counts["read"],
        counts["read"] - counts["bad"],
        counts["bad"],
        "API",
    )
    upsert_into(path, done, ["id_ejecucion"])
    second = run_started(spark, 2, datetime(2024, 3, 2, 10))
    failed = run_finished(second, datetime(2024, 3, 2, 10, 0, 1), error="boom")
    return upsert_into(path, failed, ["id_ejecucion"])


@query(RUN_SQL)
def run_audit(spark, sf_dir):
    return _runs(spark, sf_dir)


@query(f"SELECT * FROM ({RUN_SQL}) ORDER BY id_ejecucion DESC LIMIT 1")
def latest_run(spark, sf_dir):
    return _runs(spark, sf_dir).orderBy(F.desc("id_ejecucion")).limit(1)


@query(
    SHOP_SQL
    + """
    , valid AS (SELECT * FROM checked WHERE dia IS NOT NULL AND importe >= 0 AND NOT bad_product AND NOT bad_client)
    SELECT 'dim_categorias' AS target, count(DISTINCT p_type) AS rows FROM part
    UNION ALL SELECT 'dim_vendedores', count(*) FROM nation
    UNION ALL SELECT 'dim_ubicaciones', count(*) FROM region
    UNION ALL SELECT 'dim_productos', count(*) FROM products
    UNION ALL SELECT 'dim_clientes', count(*) FROM clients
    UNION ALL SELECT 'fact_ventas', count(DISTINCT l_orderkey) FROM valid"""
)
def shop_star(spark, sf_dir):
    """Dimensions and facts written as published tables, facts one per sale key."""
    tables = shop_tables(spark, sf_dir)
    tables["Vendedores"] = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("VendedorID"),
        F.col("n_name").alias("NombreVendedor"),
        F.lit("ES").alias("Pais"),
    )
    tables["Ubicaciones"] = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("UbicacionID"), F.col("r_name").alias("Ciudad"), F.lit("ES").alias("Pais")
    )
    cleaned = shop.clean(tables, IN_SCOPE, stage=checkpoint)
    path, counts = work_dir(spark, "shop"), None
    for name, (rows, keys) in shop.star_tables(tables, cleaned).items():
        # The test sales repeat order keys, so one row per key is loaded.
        loaded = upsert_into(f"{path}/{name}", rows.dropDuplicates(keys), keys)
        one = loaded.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("target"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    MATCH_SQL
    + """
    , valid AS (SELECT nombre_jugador, pais, n_name, away,
        CAST(CASE WHEN o_orderpriority = '5-LOW' THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
             ELSE o_orderdate END AS DATE) AS d, CAST(o_orderpriority[1] AS INTEGER) AS goles,
        CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END AS asistencias FROM judged WHERE motivo_rechazo IS NULL)
    SELECT nombre_jugador, pais, n_name AS equipo_local, away AS equipo_visitante, d AS fecha_partido,
      max(goles) AS goles, max(asistencias) AS asistencias FROM valid GROUP BY ALL"""
)
def match_star(spark, sf_dir):
    """The match plan loaded twice; facts joined back to their dimensions."""
    raw = match_lines(spark, sf_dir)
    tagged = matches.tag_rows(raw, ["nation_3", "nation_12"])
    staged, errors = matches.stage_rows(tagged), matches.error_file(tagged, "orders")
    path = work_dir(spark, "matches")
    matches.load(staged, errors, path)
    loaded = matches.load(staged, errors, path)
    return (
        loaded["fact_estadisticas"]
        .join(loaded["dim_jugadores"], "jugador_id")
        .join(loaded["dim_partidos"], "partido_id")
        .select(*matches.PLAYER_KEY, *matches.MATCH_KEY, *matches.MEASURES)
    )
