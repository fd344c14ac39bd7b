"""A: scans, sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import Tables, query
from recordops.operators.aggregates import frequency
from recordops.operators.combine import stack_labelled
from recordops.operators.joins import lookup
from recordops.sources import readers, writers
from recordops.session import scratch_dir

CUT_DAY = dt.date(2026, 5, 26)
SERVICE_FILES = {
    "salud_mental": ["view"],
    "salud_bucal": ["click"],
    "planificacion_familiar": ["signup"],
    "consulta_externa": ["purchase", "error"],
}


def service_files(t: Tables) -> list[str]:
    """The events as one file per service; one of them lacks a column."""
    folder = scratch_dir(t.spark, "services")
    paths = readers.cut_date_paths(folder, list(SERVICE_FILES), CUT_DAY, 2026)
    for path, (service, kinds) in zip(paths, SERVICE_FILES.items()):
        part = t.events.filter(F.col("event_type").isin(kinds)).drop("props")
        writers.write_parquet(part.drop("value") if service == "salud_bucal" else part, path)
    return paths


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
""")
def a1_column_pick(t: Tables):
    path = f"{t.folder}/orders.parquet"
    return readers.read_columns(t.spark, path, "o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
    SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1
""")
def a2_latest_snapshot(t: Tables):
    folder = scratch_dir(t.spark, "snapshots")
    orders = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("Estatus Orden"))
    done, open_ = F.col("Estatus Orden") == "F", F.col("Estatus Orden") != "P"
    writers.write_parquet(orders.filter(done), f"{folder}/orders_20250131.parquet")
    writers.write_parquet(orders, f"{folder}/orders_20260215.parquet")
    writers.write_parquet(orders.filter(open_), f"{folder}/orders_20251231.parquet")
    latest = readers.read_latest(t.spark, folder, "orders")
    return frequency(latest, ["estatus_orden"]).withColumnRenamed("estatus_orden", "status")


@query("""
    SELECT event_type, '20_05' AS cut, count(*) AS n FROM events GROUP BY 1
""")
def a3_cut_date_files(t: Tables):
    paths = service_files(t)
    cut = readers.last_wednesday_of(CUT_DAY).strftime("%d_%m")
    counts = frequency(t.spark.read.parquet(*paths), ["event_type"])
    return counts.withColumn("cut", F.lit(cut))


@query("""
    SELECT CASE event_type WHEN 'view' THEN 'salud mental' WHEN 'click' THEN 'salud bucal'
             WHEN 'signup' THEN 'planificacion familiar' ELSE 'consulta externa' END AS source,
           event_type, count(*) AS n,
           count(CASE WHEN event_type <> 'click' THEN value END) AS with_value
    FROM events GROUP BY 1, 2
""")
def a4_labelled_files(t: Tables):
    df = readers.read_labelled(t.spark, service_files(t))
    return df.groupBy("source", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value")
    )


@query("""
    SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer WHERE c_acctbal >= 0 GROUP BY 1
""")
def a5_folder_of_extracts(t: Tables):
    folder = scratch_dir(t.spark, "extracts")
    error = F.when(F.col("c_acctbal") < 0, F.lit("sin datos")).alias("error")
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", error)
    rows.write.option("header", True).csv(folder)
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_mktsegment", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )
    df = readers.read_folder(t.spark, folder, schema)
    return df.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("""
    SELECT p_brand AS brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size
    FROM part WHERE trim(p_name) <> '' GROUP BY 1
""")
def a6_sheet_extract(t: Tables):
    folder = writers.write_csv(
        t.part.select("p_name", "p_brand", "p_size"), scratch_dir(t.spark, "sheet")
    )
    schema = T.StructType(
        [
            T.StructField("nombre", T.StringType()),
            T.StructField("marca", T.StringType()),
            T.StructField("talla", T.IntegerType()),
        ]
    )
    rows = F.col("nombre").isNotNull() & (F.trim("nombre") != "")
    df = readers.read_extract(t.spark, folder, schema, data_rows=rows)
    return df.groupBy(F.col("marca").alias("brand")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("talla").alias("size")
    )


@query("""
    SELECT s_suppkey, s_name, s_nationkey FROM supplier
""")
def a7_attribute_table(t: Tables):
    layer = t.supplier.select(
        F.col("s_suppkey").alias("S SuppKey"),
        F.col("s_name").alias("S Name"),
        F.col("s_nationkey").alias("s.NationKey"),
        F.encode(F.col("s_name"), "UTF-8").alias("geom"),
    )
    path = scratch_dir(t.spark, "layer")
    writers.write_parquet(layer, path)
    out = readers.read_attributes(t.spark, path)
    return out.withColumnsRenamed(
        {"s_supp_key": "s_suppkey", "s_nation_key": "s_nationkey"}
    )


@query("""
    SELECT c_custkey AS clave_cliente, c_name AS nombre, c_nationkey AS x10_nacion,
           round(c_acctbal, 2) AS saldo_percent, c_mktsegment AS nombre_3, c_custkey AS nombre_2
    FROM customer
""")
def a8_clean_names(t: Tables):
    messy = t.customer.select(
        "c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2), "c_mktsegment", "c_custkey"
    ).toDF("Clave  Cliente", "Nombre", "10 Nación", "Saldo %", "NOMBRE", "nombre_2")
    return readers.clean_names(messy)


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS counted,
           count(*) AS stored_or_kept
    FROM orders WHERE year(o_orderdate) IN (1999, 2000) GROUP BY 1
""")
def a9_year_split(t: Tables):
    path = scratch_dir(t.spark, "orders-1999")
    counts, kept = writers.split_year(t.orders, "o_orderdate", 1999, 2000, path)
    both = t.spark.read.parquet(path).unionByName(kept)
    rows = both.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("stored_or_kept")
    )
    return lookup(counts.withColumnRenamed("n", "counted"), rows, ["year"])


@query("""
    SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1
""")
def a10_parquet_sink(t: Tables):
    path = scratch_dir(t.spark, "nations")
    writers.write_parquet(frequency(t.customer, ["c_nationkey"]), path)
    return t.spark.read.parquet(path)


@query("""
    SELECT p_type, count(*) AS n FROM part GROUP BY 1
""")
def a11_csv_sink(t: Tables):
    path = writers.write_csv(frequency(t.part, ["p_type"]), scratch_dir(t.spark, "types"))
    return t.spark.read.schema("p_type string, n bigint").option("header", True).csv(path)


@query("""
    SELECT 'by_status' AS part, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1, 2
    UNION ALL
    SELECT 'by_priority', o_orderpriority, count(*) FROM orders GROUP BY 1, 2
""")
def a12_report_sink(t: Tables):
    report = {
        "by_status": frequency(t.orders.withColumnRenamed("o_orderstatus", "value"), ["value"]),
        "by_priority": frequency(
            t.orders.withColumnRenamed("o_orderpriority", "value"), ["value"]
        ),
    }
    paths = writers.write_report(report, scratch_dir(t.spark, "report"))
    return stack_labelled({n: t.spark.read.parquet(p) for n, p in paths.items()}, "part")


@query("""
    SELECT r_name, count(*) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def a13_named_views(t: Tables):
    readers.register({"v_customer": t.customer, "v_nation": t.nation, "v_region": t.region})
    return t.spark.sql("""
        SELECT r_name, count(*) AS customers
        FROM v_customer JOIN v_nation ON c_nationkey = n_nationkey
        JOIN v_region ON n_regionkey = r_regionkey GROUP BY r_name
    """)


@query("""
    SELECT 1 AS position, 'o_orderkey' AS name, 'bigint' AS type, count(o_orderkey) AS filled FROM orders
    UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
    UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
    UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders
""")
def a14_schema_listing(t: Tables):
    orders = t.orders
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns])
    names = [F.struct(F.lit(c).alias("name"), F.col(c).alias("filled")) for c in orders.columns]
    counts = filled.select(F.inline(F.array(*names)))
    return lookup(readers.describe(orders), counts, ["name"])


@query("""
    WITH kinds(event_type, spanish) AS (
      VALUES ('view', 'vista'), ('click', 'clic'), ('purchase', 'compra'), ('other', 'otro'))
    SELECT spanish, count(e.event_id) AS n
    FROM events e LEFT JOIN kinds USING (event_type) GROUP BY 1
""")
def a15_inline_table(t: Tables):
    kinds = readers.literal_table(
        t.spark,
        [("view", "vista"), ("click", "clic"), ("purchase", "compra"), ("other", "otro")],
        "event_type string, spanish string",
    )
    return frequency(lookup(t.events, kinds, ["event_type"]), ["spanish"])
