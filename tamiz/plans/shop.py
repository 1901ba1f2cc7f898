"""Shop migration: six dirty source tables to a star schema with quarantine and audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.fixed_values import FASHION_CATEGORIES, USD_PER_EUR
from tamiz.functions import parse
from tamiz.functions.rows import raw_cell
from tamiz.functions.text import strip_space
from tamiz.operators.contract import error_rows
from tamiz.runtime import checkpoint, computed_once
from tamiz.sinks.files import export_csv
from tamiz.sinks.folders import current_commit, insert_absent_folders, read_changes, read_folders, upsert_folders
from tamiz.sinks.tables import append

# Tables whose changes are logged, as the target's triggers would.
LOGGED = ("dim_productos", "dim_clientes", "fact_ventas")
# Folders by key hash that each target table is kept in; a load reads and writes those it changes.
BUCKETS = 16
OUT_OF_SCOPE_PRODUCT = "Producto fuera de alcance (categoría no moda) o inexistente"
REJECTED_CLIENT = "Cliente en cuarentena (RF-01) o inexistente"
ERROR_KEYS = ["tabla_origen", "datos_raw", "motivo_rechazo"]


@dataclass
class Cleaned:
    products: DataFrame
    clients: DataFrame
    sales: DataFrame
    rejected_sales: DataFrame
    errors: DataFrame
    skipped_products: DataFrame


def clean_products(
    products: DataFrame, categories: DataFrame, scope: Sequence[str], rate: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid products, error rows, out-of-scope products). Scope is no quality error."""
    in_scope = categories.filter(F.col("NombreCategoria").isin(list(scope))).select("CategoriaID")
    kept = products.join(in_scope, "CategoriaID", "left_semi")
    skipped = products.join(in_scope, "CategoriaID", "left_anti")
    priced = computed_once(
        kept,
        {
            "_buy": parse.money(F.col("Precio_Compra"), "Precio_Compra", rate),
            "_sell": parse.money(F.col("Precio_Venta"), "Precio_Venta", rate),
        },
    )

    def cell(name: str):
        return raw_cell("ProductoID", F.col("ProductoID"), name, F.col(name))

    errors = error_rows(
        priced,
        "Productos",
        [
            (cell("Precio_Compra"), F.col("_buy.reason")),
            (cell("Precio_Venta"), F.col("_sell.reason")),
        ],
    )
    valid = priced.withColumns(
        {"precio_compra_eur": F.col("_buy.value"), "precio_venta_eur": F.col("_sell.value")}
    ).dropna(subset=["precio_compra_eur", "precio_venta_eur"])
    return valid.drop("_buy", "_sell"), errors, skipped


def clean_clients(clients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid clients, error rows)."""
    parsed = computed_once(
        clients,
        {"_c": parse.client(F.col("Cliente_Data")), "Email": strip_space(F.col("Email"))},
    )
    raw = raw_cell("ClienteID", F.col("ClienteID"), "Cliente_Data", F.col("Cliente_Data"))
    errors = error_rows(parsed, "Clientes", [(raw, F.col("_c.reason"))])
    valid = parsed.filter(F.col("_c.reason").isNull()).withColumns(
        {name: F.col(f"_c.{name}") for name in ("nombre", "apellidos", "dni")}
    )
    return valid.drop("_c"), errors


def clean_sales(
    sales: DataFrame,
    product_ids: DataFrame,
    client_ids: DataFrame,
    rate: float,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, rejected, error rows): one error row per broken rule of a sale.

    Both reference checks are left joins to distinct ids, so every sale is read once
    and stays one row. `stage` may materialise the judged sales, from which all three
    results are taken.
    """
    products = product_ids.select("ProductoID").distinct().withColumn("_product", F.lit(True))
    clients = client_ids.select("ClienteID").distinct().withColumn("_client", F.lit(True))
    linked = sales.join(products, "ProductoID", "left").join(clients, "ClienteID", "left")
    parsed = {
        "_date": parse.date(F.col("Fecha")),
        "_amount": parse.money(F.col("MontoTotal_Raw"), "MontoTotal_Raw", rate),
    }
    checked = stage(computed_once(linked, parsed))

    def cell(name: str, quoted: bool = True):
        return raw_cell("VentaID", F.col("VentaID"), name, F.col(name), quoted)

    checks = [
        (cell("Fecha"), F.col("_date.reason")),
        (cell("MontoTotal_Raw"), F.col("_amount.reason")),
        (cell("ProductoID", False), F.when(F.col("_product").isNull(), OUT_OF_SCOPE_PRODUCT)),
        (cell("ClienteID", False), F.when(F.col("_client").isNull(), REJECTED_CLIENT)),
    ]
    is_valid = F.coalesce(*[reason for _, reason in checks]).isNull()
    result = checked.withColumns(
        {"fecha_parseada": F.col("_date.value"), "monto_eur": F.col("_amount.value")}
    )
    helpers = ["_product", "_client", "_date", "_amount"]
    return (
        result.filter(is_valid).drop(*helpers),
        result.filter(~is_valid).drop(*helpers),
        error_rows(checked, "Ventas", checks),
    )


def clean(
    tables: dict[str, DataFrame],
    scope: Sequence[str] = tuple(FASHION_CATEGORIES),
    rate: float = USD_PER_EUR,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Cleaned:
    products, product_errors, skipped = clean_products(
        tables["Productos"], tables["Categorias"], scope, rate
    )
    clients, client_errors = clean_clients(tables["Clientes"])
    sales, rejected, sale_errors = clean_sales(tables["Ventas"], products, clients, rate, stage)
    errors = product_errors.unionByName(client_errors).unionByName(sale_errors)
    return Cleaned(products, clients, sales, rejected, errors, skipped)


def star_tables(tables: dict[str, DataFrame], cleaned: Cleaned) -> dict[str, tuple]:
    """Target name -> (rows, key), with the target's column names and types."""
    money = "decimal(10,2)"
    return {
        "dim_categorias": (
            tables["Categorias"].select(
                F.col("CategoriaID").alias("categoria_id"),
                F.col("NombreCategoria").alias("nombre_categoria"),
            ),
            ["categoria_id"],
        ),
        "dim_vendedores": (
            tables["Vendedores"].select(
                F.col("VendedorID").alias("vendedor_id"),
                F.col("NombreVendedor").alias("nombre_vendedor"),
                F.col("Pais").alias("pais"),
            ),
            ["vendedor_id"],
        ),
        "dim_ubicaciones": (
            tables["Ubicaciones"].select(
                F.col("UbicacionID").alias("ubicacion_id"),
                F.col("Ciudad").alias("ciudad"),
                F.col("Pais").alias("pais"),
            ),
            ["ubicacion_id"],
        ),
        "dim_productos": (
            cleaned.products.select(
                F.col("ProductoID").alias("producto_id"),
                F.col("NombreProducto").alias("nombre_producto"),
                F.col("CategoriaID").alias("categoria_id"),
                F.col("precio_compra_eur").cast(money).alias("precio_compra_eur"),
                F.col("precio_venta_eur").cast(money).alias("precio_venta_eur"),
                F.col("Stock").alias("stock"),
            ),
            ["producto_id"],
        ),
        "dim_clientes": (
            cleaned.clients.select(
                F.col("ClienteID").alias("cliente_id"),
                "nombre",
                "apellidos",
                "dni",
                F.col("Email").alias("email"),
                F.col("Pais").alias("pais"),
            ),
            ["cliente_id"],
        ),
        "fact_ventas": (
            cleaned.sales.select(
                F.col("VentaID").alias("venta_id_origen"),
                F.col("fecha_parseada").alias("fecha"),
                F.col("ProductoID").alias("producto_id"),
                F.col("VendedorID").alias("vendedor_id"),
                F.col("ClienteID").alias("cliente_id"),
                F.col("UbicacionID").alias("ubicacion_id"),
                F.col("Cantidad").alias("cantidad"),
                F.col("monto_eur").cast(money).alias("monto_total_eur"),
            ),
            ["venta_id_origen"],
        ),
    }


def load(tables: dict[str, DataFrame], target: str, detected: date | None = None) -> dict[str, int]:
    """Clean, export, upsert in foreign-key order, log changes, quarantine and audit; returns counts."""
    started = datetime.now()
    detected = detected or started.date()
    cleaned = clean(tables, stage=checkpoint)
    errors = cleaned.errors.withColumn("fecha_deteccion", F.lit(detected))
    for name, rows in (
        ("Ventas_Validas", cleaned.sales),
        ("Ventas_Invalidas", cleaned.rejected_sales),
        ("tb_errores_migracion", errors),
    ):
        export_csv(rows, f"{target}/csv/{name}")
    loaded = 0
    spark = errors.sparkSession
    for name, (rows, keys) in star_tables(tables, cleaned).items():
        rows = checkpoint(rows)
        upsert_folders(f"{target}/{name}", rows, keys, BUCKETS, logged=name in LOGGED)
        loaded += rows.count()
    insert_absent_folders(f"{target}/tb_errores_migracion", errors, ERROR_KEYS, BUCKETS)
    counts = {
        "registros_leidos": sum(t.count() for t in tables.values()),
        "registros_insertados": loaded,
        "registros_error": errors.count(),
    }
    run = spark.createDataFrame([(started, datetime.now())], "fecha_inicio timestamp, fecha_fin timestamp")
    append(f"{target}/tb_ejecuciones_etl", run, **{k: F.lit(v) for k, v in counts.items()})
    return counts


def changes(spark: SparkSession, target: str) -> DataFrame:
    """The change log of the logged tables: one entry for every row that a load inserted or changed."""
    logs = []
    for name in LOGGED:
        log, key = read_changes(spark, f"{target}/{name}"), current_commit(spark, f"{target}/{name}").keys[0]
        logs.append(log.withColumns({"tabla": F.lit(name), "clave": F.col(key).cast("string")}).drop(key))
    return reduce(DataFrame.unionByName, logs)


def fact_count(spark: SparkSession, target: str) -> int:
    return read_folders(spark, f"{target}/fact_ventas").count()
