"""Raw documents: envelopes, payloads, batches, fallbacks, and the streamed load."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators.latest import newest_first
from tamiz.plans import weather
from tamiz.queries.base import query, table
from tamiz.runtime import work_dir
from tamiz.sinks.files import land_envelopes
from tamiz.sinks.tables import merge_partitions
from tamiz.sources import payloads
from tamiz.sources.envelope import (
    DOCUMENT_BREAK,
    arbitrate_origin,
    envelopes_of,
    existing_batches,
    flatten_envelopes,
    has_series,
    latest_batch,
    origin_counts,
    read_envelopes,
    split_envelopes,
)
from tamiz.sources.relational import (
    read_first_available,
    read_parquet_tables,
    row_totals,
)
from tamiz.streaming.incremental import stream_merge

HOURS = 3


def event_envelopes(spark, sf_dir, city="event_type"):
    """One envelope per event with three hours of values derived from it."""
    value, hour = F.col("value"), F.date_trunc("hour", F.col("ts").cast("timestamp"))
    steps = range(HOURS)
    series = {
        "time": [F.date_format(hour + F.make_interval(hours=F.lit(i)), "yyyy-MM-dd'T'HH:mm") for i in steps],
        "temperature_2m": [value / 10 + i for i in steps],
        "relative_humidity_2m": [value / 4 for _ in steps],
        "precipitation": [F.lit(float(i)) for i in steps],
        "wind_speed_10m": [value - i for i in steps],
        "surface_pressure": [F.lit(1013.0) for _ in steps],
    }
    hourly = F.struct(*[F.array(*values).alias(name) for name, values in series.items()])
    metadata = F.struct(
        F.concat(F.lit("lote_"), F.col("event_id").cast("string")).alias("id_lote"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp_ingesta_utc"),
        F.col(city).cast("string").alias("ciudad"),
        F.when(F.col("event_type") == "view", "FALLBACK").otherwise("API").alias("origen"),
    )
    return table(spark, sf_dir, "events").select(
        metadata.alias("metadata"),
        F.struct(hourly.alias("hourly")).alias("datos_api"),
        F.concat(F.lit("file_"), F.lpad(F.col("event_id").cast("string"), 20, "0")).alias("path"),
    )


HOURLY_SQL = """
    SELECT event_type AS ciudad, strftime(date_trunc('hour', ts) + to_hours(i), '%Y-%m-%dT%H:%M') AS fecha_hora_utc,
      value / 10 + i AS temperature_2m, value / 4 AS relative_humidity_2m, i::DOUBLE AS precipitation,
      value - i AS wind_speed_10m, 1013.0::DOUBLE AS surface_pressure, 'lote_' || event_id AS id_lote,
      CASE WHEN event_type = 'view' THEN 'FALLBACK' ELSE 'API' END AS origen,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_ingesta_utc, event_id
    FROM events, (SELECT unnest([0, 1, 2]) AS i)"""


@query(f"SELECT * EXCLUDE (event_id) FROM ({HOURLY_SQL})")
def envelope_flatten(spark, sf_dir):
    return flatten_envelopes(event_envelopes(spark, sf_dir))


@query(f"SELECT * EXCLUDE (event_id) FROM ({HOURLY_SQL})")
def landed_envelopes(spark, sf_dir):
    """The same rows after landing as JSON files below city and day folders."""
    path = work_dir(spark, "raw")
    land_envelopes(event_envelopes(spark, sf_dir).drop("path"), path)
    return flatten_envelopes(read_envelopes(spark, [path]))


DOCUMENT_SQL = f"""
    SELECT path_kind, resultado, count(*) AS documentos, sum(horas)::BIGINT AS horas FROM (
        SELECT CASE event_id % 3 WHEN 0 THEN 'lines' ELSE 'indented' END AS path_kind,
          CASE WHEN event_id % 7 = 3 THEN 'unreadable document' ELSE 'usable' END AS resultado,
          CASE WHEN event_id % 7 = 3 THEN 0 ELSE {HOURS} END AS horas FROM events)
    GROUP BY ALL"""


def _raw_documents(spark, sf_dir):
    """Files with a document in each line, and files with indented documents; every seventh document is cut short."""
    raw = work_dir(spark, "documents")
    envelope = F.struct("metadata", "datos_api")
    shown = event_envelopes(spark, sf_dir).select(
        F.regexp_extract("path", "([0-9]+)$", 1).cast("long").alias("event_id"),
        F.to_json(envelope).alias("flat"), F.to_json(envelope, {"pretty": "true"}).alias("indented"),
    )
    lines = F.col("event_id") % 3 == 0
    text = F.when(lines, F.col("flat")).otherwise(F.col("indented"))
    cut = F.when(F.col("event_id") % 7 == 3, F.expr("substring(text, 1, length(text) - 30)")).otherwise(F.col("text"))
    texts = shown.withColumn("text", text).select(F.when(lines, "lines").otherwise("indented").alias("kind"), cut.alias("value"))
    for kind in ("lines", "indented"):
        texts.filter(F.col("kind") == kind).select("value").write.text(f"{raw}/{kind}")
    return raw


def _documents_told(usable, rejected):
    """Documents and hours by kind of file and outcome."""
    kind = F.regexp_extract("path", "/(lines|indented)/[^/]*$", 1)
    good = usable.select(kind.alias("path_kind"), F.lit("usable").alias("resultado"), F.size("datos_api.hourly.time").alias("horas"))
    bad = rejected.select(kind.alias("path_kind"), F.col("motivo_rechazo").alias("resultado"), F.lit(0).alias("horas"))
    grouped = good.unionByName(bad).groupBy("path_kind", "resultado")
    return grouped.agg(F.count("*").alias("documentos"), F.sum("horas").alias("horas"))


@query(DOCUMENT_SQL)
def whole_documents(spark, sf_dir):
    """Line-wise, indented and truncated documents: every landed document is usable or rejected."""
    return _documents_told(*split_envelopes(read_envelopes(spark, [_raw_documents(spark, sf_dir)])))


@query(DOCUMENT_SQL)
def streamed_documents(spark, sf_dir):
    """The same through the streamed reader."""
    raw, out, state = _raw_documents(spark, sf_dir), work_dir(spark, "read"), work_dir(spark, "state")
    files = spark.readStream.option("recursiveFileLookup", "true").option("lineSep", DOCUMENT_BREAK).text(raw)
    writer = envelopes_of(files).writeStream.format("parquet").option("checkpointLocation", state)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return _documents_told(*split_envelopes(spark.read.parquet(out)))


@query(
    """SELECT user_id::VARCHAR AS ciudad, 'lote_' || max_by(event_id, (ts, event_id)) AS id_lote
    FROM events GROUP BY user_id"""
)
def newest_batch(spark, sf_dir):
    """Newest envelope per key by its embedded ingest time."""
    newest = latest_batch(event_envelopes(spark, sf_dir, "user_id"))
    return newest.select("ciudad", F.col("metadata.id_lote").alias("id_lote"))


@query(
    """WITH landed AS (SELECT user_id, max_by(event_id, (ts, event_id)) AS e FROM events WHERE value > 300 GROUP BY user_id)
    SELECT u.user_id::VARCHAR AS ciudad, 'file_' || lpad(e::VARCHAR, 20, '0') AS path,
      CASE WHEN e IS NULL THEN 'SIN_DATOS' ELSE 'BRONZE_EXISTENTE' END AS origen
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN landed USING (user_id)"""
)
def batch_inventory(spark, sf_dir):
    """Requested keys with their newest landed batch; only some keys have landed."""
    requested = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("ciudad")).distinct()
    landed = event_envelopes(spark, sf_dir, "user_id").filter("datos_api.hourly.temperature_2m[0] > 30")
    return existing_batches(requested, landed)


ARBITRATION_SQL = """
    WITH landed AS (SELECT user_id, max_by(event_id, (ts, event_id)) AS e, max_by(value, (ts, event_id)) AS v
                    FROM events WHERE value > 200 GROUP BY user_id),
    fetched AS (SELECT user_id, min_by(value, (ts, event_id)) AS v FROM events GROUP BY user_id)
    SELECT f.user_id::VARCHAR AS ciudad,
      CASE WHEN f.v > 40 THEN 'API' WHEN l.e IS NOT NULL THEN 'FALLBACK' ELSE 'SIN_DATOS' END AS origen,
      CASE WHEN f.v > 40 THEN f.v / 10 WHEN l.e IS NOT NULL THEN l.v / 10 END AS first_value
    FROM fetched f LEFT JOIN landed l USING (user_id)"""


def _arbitrated(spark, sf_dir):
    """The fetched body is each key's first event: empty below 20, without series below 40."""
    envelopes = event_envelopes(spark, sf_dir, "user_id")
    series = F.col("datos_api.hourly.temperature_2m")
    first = envelopes.select("metadata.ciudad", "metadata.timestamp_ingesta_utc", "path", "datos_api")
    first = first.groupBy("ciudad").agg(
        F.min_by("datos_api", F.struct("timestamp_ingesta_utc", "path")).alias("body")
    )
    value = F.col("body.hourly.temperature_2m")[0]
    hourly = F.col("body.hourly")
    no_times = F.struct(hourly.withField("time", F.slice(hourly["time"], 1, 0)).alias("hourly"))
    no_series = F.struct(F.when(F.lit(False), hourly).alias("hourly"))
    body = F.when(value <= 2, no_times).when(value <= 4, no_series).otherwise(F.col("body"))
    fetched = first.select("ciudad", body.alias("datos_api"))
    landed = envelopes.filter(series[0] > 20)
    return arbitrate_origin(fetched, fetched, landed, "b1", "2024-02-01T00:00:00")


@query(ARBITRATION_SQL)
def origin_arbitration(spark, sf_dir):
    first = F.col("datos_api.hourly.temperature_2m")[0]
    return _arbitrated(spark, sf_dir).select("ciudad", "origen", first.alias("first_value"))


@query(
    f"""SELECT count(*) FILTER (origen = 'API') AS from_api, count(*) FILTER (origen = 'FALLBACK') AS from_fallback,
    count(*) FILTER (origen = 'SIN_DATOS') AS without_data FROM ({ARBITRATION_SQL})"""
)
def origin_summary(spark, sf_dir):
    return origin_counts(_arbitrated(spark, sf_dir))


@query(
    """SELECT c_name AS nombre, c_acctbal AS lat, c_nationkey::DOUBLE AS lon,
      CASE c_mktsegment WHEN 'BUILDING' THEN 50.0::DOUBLE WHEN 'MACHINERY' THEN 22.5::DOUBLE ELSE 3.7::DOUBLE END AS potencia_kw
    FROM customer WHERE c_acctbal >= 0"""
)
def station_payloads(spark, sf_dir):
    """Points of interest parsed from JSON text; powers missing, zero or several."""
    segment = F.col("c_mktsegment")
    powers = (
        F.when(segment == "BUILDING", '[{"PowerKW":22},{"PowerKW":50.0},{"PowerKW":0}]')
        .when(segment == "MACHINERY", '[{"PowerKW":null},{"PowerKW":22.5}]')
        .when(segment == "FURNITURE", '[{"PowerKW":0}]')
        .otherwise("null")
    )
    lat = F.when(F.col("c_acctbal") < 0, "null").otherwise(F.col("c_acctbal").cast("string"))
    document = F.format_string(
        '[{"AddressInfo":{"Title":"%s","Latitude":%s,"Longitude":%d},"Connections":%s,'
        '"DateCreated":"2024-01-01T00:00:00Z"}]',
        F.col("c_name"),
        lat,
        F.col("c_nationkey"),
        powers,
    )
    parsed = table(spark, sf_dir, "customer").select(
        payloads.parse_payload(document, payloads.POI_TYPE).alias("items")
    )
    points = payloads.charging_points(parsed.select(F.explode("items").alias("poi")))
    return points.drop("fecha_creacion")


@query(
    """WITH named AS (SELECT s_suppkey, n_name, CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_suppkey * 10 END AS p
                      FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT n_name AS nombre_pais, max_by(p, s_suppkey) AS poblacion_total FROM named WHERE p IS NOT NULL GROUP BY n_name"""
)
def population_payloads(spark, sf_dir):
    """Country figures from JSON text: missing ones skipped, the last of equal names kept."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    number = F.when(F.col("s_acctbal") < 1000, "null").otherwise((F.col("s_suppkey") * 10).cast("string"))
    document = F.format_string(
        '[{"name":{"common":" %s "},"population":%s},{"name":{"common":""},"population":1}]',
        F.initcap("n_name"),
        number,
    )
    parsed = joined.select(
        "s_suppkey", F.explode(payloads.parse_payload(document, payloads.COUNTRY_TYPE)).alias("country")
    )
    return payloads.country_populations(parsed, "s_suppkey")


@query(
    """SELECT vec_id, coalesce(list_max(list_filter(embedding, lambda v: v <> 0)), 3.7)::DOUBLE AS largest,
    label FROM embeddings"""
)
def array_maximum(spark, sf_dir):
    powers = F.col("embedding").cast("array<double>")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", payloads.fastest_connector(powers).alias("largest"), "label"
    )


@query(
    """SELECT page_id, length(html) > 0 AND html LIKE '%<script>%' AS usable, FALSE AS broken FROM pages"""
)
def payload_checks(spark, sf_dir):
    """Shape checks on parsed bodies: usable list, and unreadable text."""
    wrapped = F.to_json(F.struct(F.struct(F.when(F.col("html").contains("<script>"), F.array("html")).alias("time")).alias("hourly")))
    body = F.from_json(wrapped, "struct<hourly:struct<time:array<string>>>")
    broken = payloads.parse_payload(F.col("html"), payloads.COUNTRY_TYPE)
    return table(spark, sf_dir, "pages").select(
        "page_id", has_series(body).alias("usable"), payloads.usable_payload(broken).alias("broken")
    )


@query(
    """WITH totals AS (SELECT 'customer' AS table_name, count(*) AS rows FROM customer
      UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
    SELECT mode, table_name, rows FROM totals, (VALUES ('PRIMARY'), ('REPLICA')) m(mode)"""
)
def replica_failover(spark, sf_dir):
    """Read once from the primary folder, once with that folder missing, so that all tables come from the replica."""
    names = ["customer", "orders", "lineitem"]

    def totals(primary):
        tables, mode = read_first_available(
            {
                "PRIMARY": lambda: read_parquet_tables(spark, primary, names),
                "REPLICA": lambda: read_parquet_tables(spark, sf_dir, names),
            }
        )
        return row_totals(tables).select(F.lit(mode).alias("mode"), "table_name", "rows")

    return totals(sf_dir).unionByName(totals(f"{sf_dir}/absent"))


@query(
    """SELECT 'FALLBACK' AS origin, s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'API', s_suppkey, s_name FROM supplier WHERE s_acctbal > 0"""
)
def seed_fallback(spark, sf_dir):
    """Without usable primary rows the seed table is taken as a whole, otherwise the primary rows alone."""
    seed = table(spark, sf_dir, "supplier")
    shown = []
    for usable in ("s_suppkey < 0", "s_acctbal > 0"):
        rows, origin = payloads.with_fallback(seed.filter(usable).select("s_suppkey", "s_name"), seed.select("s_suppkey", "s_name"))
        shown.append(rows.select(F.lit(origin).alias("origin"), "s_suppkey", "s_name"))
    return shown[0].unionByName(shown[1])


# Valid hours under the hourly contract; of equal (city, hour) the newest ingest counts.
CLEAN_SQL = f"""
    SELECT * FROM ({HOURLY_SQL}) WHERE ciudad <> 'signup' AND temperature_2m <= 40 AND relative_humidity_2m <= 100
      AND wind_speed_10m BETWEEN 0 AND 400
    QUALIFY row_number() OVER (PARTITION BY ciudad, fecha_hora_utc ORDER BY timestamp_ingesta_utc DESC, id_lote DESC) = 1"""
CITIES = ["error", "click", "view", "purchase"]


def _contract():
    from tamiz.fixed_values import VALID_RANGES

    return weather.hourly_contract(CITIES, {**VALID_RANGES, "temperature_2m": (-50.0, 40.0)})


def _stream_clean(spark, sf_dir):
    """Raw files of two landings taken by two runs of the stream."""
    raw, silver, state = (work_dir(spark, label) for label in ("raw", "silver", "state"))
    envelopes = event_envelopes(spark, sf_dir).drop("path")
    early = F.col("metadata.timestamp_ingesta_utc") < "2024-01-16"
    for landing in (envelopes.filter(~early), envelopes.filter(early)):
        land_envelopes(landing, raw)
        weather.stream_clean(raw, silver, state, _contract()).awaitTermination()
    return silver


@query(
    f"""SELECT ciudad, strptime(fecha_hora_utc, '%Y-%m-%dT%H:%M') AS fecha_hora_utc, temperature_2m, wind_speed_10m,
    id_lote, origen FROM ({CLEAN_SQL})"""
)
def streamed_clean_table(spark, sf_dir):
    rows = spark.read.parquet(_stream_clean(spark, sf_dir))
    return rows.select(
        "ciudad", "fecha_hora_utc", "temperature_2m", "wind_speed_10m", "id_lote", "origen"
    )


DAILY_SQL = f"""
    SELECT ciudad, strptime(fecha_hora_utc, '%Y-%m-%dT%H:%M')::DATE AS fecha, round(avg(temperature_2m), 8) AS temperatura_media_c,
      min(temperature_2m) AS temperatura_minima_c, max(temperature_2m) AS temperatura_maxima_c,
      round(sum(precipitation), 8) AS precipitacion_total_mm, round(avg(wind_speed_10m), 8) AS viento_medio_kmh
    FROM ({CLEAN_SQL}) GROUP BY ciudad, fecha"""


def _daily_shown(daily):
    rounded = ["temperatura_media_c", "precipitacion_total_mm", "viento_medio_kmh"]
    columns = ["ciudad", "fecha", "temperatura_minima_c", "temperatura_maxima_c", *rounded]
    return daily.withColumns({c: F.round(c, 8) for c in rounded}).select(*columns)


@query(DAILY_SQL)
def weather_marts(spark, sf_dir):
    """The daily mart written from a batch-loaded clean table."""
    silver, gold = work_dir(spark, "silver"), work_dir(spark, "gold")
    rows = flatten_envelopes(event_envelopes(spark, sf_dir))
    valid, _ = weather.clean(rows, _contract())
    merge_partitions(
        silver, weather.with_period(valid), weather.KEYS, newest_first(*weather.NEWEST), weather.PARTITIONS
    )
    daily = weather.load_marts(silver, gold)["resumen_diario"]
    return _daily_shown(daily)


def _maintained(spark, sf_dir):
    """Clean table and summaries after two deliveries, the newer one first."""
    silver = work_dir(spark, "silver")
    valid, _ = weather.clean(flatten_envelopes(event_envelopes(spark, sf_dir)), _contract())
    early = F.col("timestamp_ingesta_utc") < "2024-01-16"
    for delivery in (valid.filter(~early), valid.filter(early)):
        rows = weather.with_period(delivery)
        merge_partitions(silver, rows, weather.KEYS, newest_first(*weather.NEWEST), weather.PARTITIONS)
        weather.refresh_partials(silver, delivery)
    return silver


@query(DAILY_SQL)
def maintained_daily_mart(spark, sf_dir):
    """The daily mart from summaries that each delivery brought up to date for the days it touched."""
    return _daily_shown(weather.daily_from_partials(weather.read_partials(_maintained(spark, sf_dir))))


@query(
    f"""SELECT ciudad, strptime(fecha_hora_utc, '%Y-%m-%dT%H:%M') AS fecha_hora_utc, temperature_2m,
      round(avg(temperature_2m) OVER c, 8) AS media_historica_c, round(stddev_pop(temperature_2m) OVER c, 8) AS desviacion_historica_c,
      round((temperature_2m - avg(temperature_2m) OVER c) / stddev_pop(temperature_2m) OVER c, 7) AS z_score_temperatura
    FROM ({CLEAN_SQL}) WINDOW c AS (PARTITION BY ciudad)"""
)
def maintained_zscores(spark, sf_dir):
    """Scores of all clean hours against a history merged from the days."""
    silver = _maintained(spark, sf_dir)
    scored = weather.zscore_mart(spark.read.parquet(silver), weather.city_history(weather.read_partials(silver)))
    digits = {"media_historica_c": 8, "desviacion_historica_c": 8, "z_score_temperatura": 7}
    return scored.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    """SELECT event_id, user_id, event_type, value FROM events"""
)
def stream_latest_wins(spark, sf_dir):
    """Files of an older and a newer delivery streamed into one keyed table."""
    source, target = work_dir(spark, "files"), work_dir(spark, "table")
    columns = ["event_id", "user_id", "event_type", "value", "delivery"]
    events = table(spark, sf_dir, "events").withColumn("delivery", F.lit(2)).select(*columns)
    older = events.withColumns({"value": F.lit(-1.0), "delivery": F.lit(1)})
    for load in (events, older):
        load.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        stream_merge(
            stream,
            lambda batch, _: (batch, batch.filter("event_id IS NULL")),
            target,
            f"{target}/_rejected",
            ["event_id"],
            newest_first("delivery"),
            ["event_type"],
            f"{source}/_state",
        ).awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")
