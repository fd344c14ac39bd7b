"""Sinks: Parquet, CSV, several tables as one report, one year of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recordops.fixed_values import LOCAL_ZONE
from recordops.functions.dates import in_local_year
from recordops.session import scratch_dir


def write_parquet(df: DataFrame, path: str) -> str:
    """Parquet files below a path (A10)."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report(
    tables: dict[str, DataFrame], folder: str, kind: str = "parquet"
) -> dict[str, str]:
    """Several named tables, one folder each, below one report folder."""
    write = {"parquet": write_parquet, "csv": write_csv}[kind]
    return {name: write(df, f"{folder}/{name}") for name, df in tables.items()}


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows stored once in the shared folder; what is built on them reads that copy."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_parts(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows stored once, in folders by the values of some columns.

    For several outputs of one pipeline: it runs once, and an output that
    filters on these columns reads its own folders only.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    schema = df.select(*[c for c in df.columns if c not in by], *by).schema
    return df.sparkSession.read.schema(schema).parquet(path).select(*df.columns)


def split_year(
    df: DataFrame,
    time: str,
    stored_year: int,
    kept_year: int,
    path: str,
    zone: str = LOCAL_ZONE,
) -> tuple[DataFrame, DataFrame]:
    """Store the rows of one year, return those of another.

    Returns the row counts of both years and the kept rows. The year is that of
    the local clock of `zone`. The rows of both years are counted on their way
    to the files, so the source is read once; attempts of a task that fail or
    are repeated do not count, because the counts come from the tasks that
    commit their files. The kept rows are a filter on the source.
    """
    stored, kept = (in_local_year(df, time, year, zone) for year in (stored_year, kept_year))
    counts = Observation()
    both = df.filter(stored | kept).observe(
        counts, F.count_if(stored).alias("stored"), F.count_if(kept).alias("kept")
    )
    write_parquet(both.filter(stored), path)
    found = {stored_year: counts.get["stored"], kept_year: counts.get["kept"]}
    rows = [(year, n) for year, n in found.items() if n]
    return df.sparkSession.createDataFrame(rows, "year int, n bigint"), df.filter(kept)
