"""Scans: column picks, dated snapshots, labelled file sets, extracts."""

from __future__ import annotations

import datetime as dt
import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordops.fixed_values import SOURCE_LABELS
from recordops.functions.dates import last_wednesday_of


def read_columns(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet scan that reads only the named columns (A1)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, on whichever file system it names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in system.globStatus(path) or []]


def latest_snapshot(paths: list[str], name: str) -> str:
    """The path with the greatest date among `name_YYYYMMDD.parquet`."""
    wanted = re.compile(rf"(?:^|/){re.escape(name)}_(\d{{8}})\.parquet$")
    dated = []
    for path in paths:
        found = wanted.search(path)
        if found:
            try:
                day = dt.datetime.strptime(found.group(1), "%Y%m%d").date()
            except ValueError:
                continue
            dated.append((day, path))
    if not dated:
        raise FileNotFoundError(f"no dated snapshot of {name}")
    return max(dated)[1]


def read_latest(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Newest dated snapshot, with clean column names (A2)."""
    paths = list_paths(spark, f"{folder}/{name}_*.parquet")
    return clean_names(spark.read.parquet(latest_snapshot(paths, name)))


def cut_date_paths(folder: str, prefixes: list[str], day: dt.date, year: int) -> list[str]:
    """Names of the files that end at the last Wednesday before a day (A3)."""
    cut = last_wednesday_of(day).strftime("%d_%m")
    return [f"{folder}/{p}_01_01_{year}_a_{cut}_{year}.parquet" for p in prefixes]


def read_labelled(
    spark: SparkSession,
    paths: list[str],
    rules: list[tuple[str, str]] = tuple(SOURCE_LABELS),
    label: str = "source",
) -> DataFrame:
    """Several files as one table, by column name, labelled by file name (A4)."""
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    where = F.col("_metadata.file_path")
    chosen = F.lit(None).cast("string")
    for pattern, text in reversed(rules):
        chosen = F.when(where.like(pattern), text).otherwise(chosen)
    return df.withColumn(label, chosen)


def read_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files: str = "*.csv",
    error: str | None = "error",
) -> DataFrame:
    """All delimited extracts of a folder without their error rows (A5)."""
    reader = spark.read.schema(schema).option("header", True)
    df = reader.option("pathGlobFilter", files).csv(folder)
    return df.filter(F.col(error).isNull()) if error else df


def read_extract(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    data_rows: Column | None = None,
) -> DataFrame:
    """One delimited sheet with stated types.

    `data_rows` tells data from a preamble above the table.
    """
    df = spark.read.schema(schema).option("header", header).csv(path)
    return df if data_rows is None else df.filter(data_rows)


def read_attributes(spark: SparkSession, path: str, geometry: str = "geom") -> DataFrame:
    """A geo layer's attribute table, its geometry left unread."""
    return clean_names(spark.read.parquet(path).drop(geometry))


def clean_name(name: str) -> str:
    """ASCII snake case of one column name."""
    text = unicodedata.normalize("NFKD", name.replace("%", "_percent_").replace("#", "_number_"))
    text = text.encode("ascii", "ignore").decode()
    text = re.sub(r"['\"]", "", text)
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text or text[0].isdigit():
        text = f"x{text}"
    return text


def clean_names(df: DataFrame) -> DataFrame:
    """ASCII snake case column names, repeated ones numbered on to a free name."""
    given = [clean_name(name) for name in df.columns]
    taken = set(given)
    used: set[str] = set()
    names = []
    for name in given:
        free, n = name, 1
        while free in used or (n > 1 and free in taken):
            n += 1
            free = f"{name}_{n}"
        used.add(free)
        names.append(free)
    return df.toDF(*names)


def register(tables: dict[str, DataFrame]) -> None:
    """Named views for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def describe(df: DataFrame) -> DataFrame:
    """Names and types of the columns."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return literal_table(df.sparkSession, rows, "position int, name string, type string")


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table written in the code.

    Rows of literals, so that the optimiser knows the table is small.
    """
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
