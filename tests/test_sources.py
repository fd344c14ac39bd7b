from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordops.session import checkpoint_dir, scratch_dir
from recordops.sources import readers, writers


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Año / Mes", "ano_mes"),
        ("apePat", "ape_pat"),
        ("CURP", "curp"),
        ("Código CNPM-26", "codigo_cnpm_26"),
        ("10 principal", "x10_principal"),
        ("% avance", "percent_avance"),
        ("# camas", "number_camas"),
        ("  ", "x"),
    ],
)
def test_clean_name(raw, clean):
    assert readers.clean_name(raw) == clean


def test_repeated_names_are_numbered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("A", "a ", "a.")
    assert readers.clean_names(df).columns == ["a", "a_2", "a_3"]


def test_latest_snapshot():
    paths = [
        "f:/x/moce_20251231.parquet",
        "f:/x/moce_20260105.parquet",
        "f:/x/moce_extra_20270101.parquet",
        "f:/x/moce_20269999.parquet",
        "f:/x/moce_2027.parquet",
    ]
    assert readers.latest_snapshot(paths, "moce") == paths[1]
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(paths, "uci")


def test_read_latest_without_files(spark):
    with pytest.raises(FileNotFoundError):
        readers.read_latest(spark, scratch_dir(spark, "empty"), "moce")


@pytest.mark.parametrize(
    "day, cut", [("2026-05-20", "13_05"), ("2026-05-21", "20_05"), ("2026-05-26", "20_05"), ("2026-01-01", "31_12")]
)
def test_cut_date_paths(day, cut):
    paths = readers.cut_date_paths("d", ["salud_mental"], dt.date.fromisoformat(day), 2026)
    assert paths == [f"d/salud_mental_01_01_2026_a_{cut}_2026.parquet"]


def test_labelled_files_differ_in_columns(spark):
    folder = scratch_dir(spark, "labelled")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{folder}/salud_bucal_a.parquet")
    spark.range(3).write.parquet(f"{folder}/otra.parquet")
    paths = [f"{folder}/salud_bucal_a.parquet", f"{folder}/otra.parquet"]
    out = readers.read_labelled(spark, paths).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("x").alias("x")
    )
    assert {tuple(r) for r in out.collect()} == {("salud bucal", 2, 2), (None, 3, 0)}


def test_extract_below_a_preamble(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Reporte mensual\n,\nclues,n\nAAIMB000001,5\nAAIMB000002,x\n")
    schema = T.StructType([T.StructField("clues", T.StringType()), T.StructField("n", T.IntegerType())])
    rows = F.col("clues").rlike("^[A-Z]{2}IMB[0-9]{6}$")
    df = readers.read_extract(spark, str(tmp_path), schema, header=False, data_rows=rows)
    assert sorted(map(tuple, df.collect())) == [("AAIMB000001", 5), ("AAIMB000002", None)]


def test_folder_of_extracts_takes_only_matching_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("curp,error\nA,\nB,bad\n")
    (tmp_path / "b.csv").write_text("curp,error\nC,\n")
    (tmp_path / "c.txt").write_text("curp,error\nD,\n")
    schema = T.StructType([T.StructField("curp", T.StringType()), T.StructField("error", T.StringType())])
    df = readers.read_folder(spark, str(tmp_path), schema)
    assert sorted(r["curp"] for r in df.collect()) == ["A", "C"]


def test_split_year_follows_the_local_clock(spark):
    df = spark.sql("""
        SELECT timestamp'2026-01-01 03:00:00Z' AS t UNION ALL SELECT timestamp'2026-01-01 09:00:00Z'
        UNION ALL SELECT timestamp'2024-06-01 00:00:00Z' UNION ALL SELECT NULL
    """)
    path = scratch_dir(spark, "year")
    counts, kept = writers.split_year(df, "t", 2025, 2026, path)
    assert {tuple(r) for r in counts.collect()} == {(2025, 1), (2026, 1)}
    assert kept.count() == 1 and kept.columns == ["t"]
    assert spark.read.parquet(path).count() == 1


def test_report_formats(spark):
    tables = {"a": spark.range(3), "b": spark.range(2)}
    for kind in ("parquet", "csv"):
        paths = writers.write_report(tables, scratch_dir(spark, "report"), kind)
        reader = spark.read.option("header", True)
        found = {n: reader.format(kind).load(p).count() for n, p in paths.items()}
        assert found == {"a": 3, "b": 2}


def test_views_and_literal_tables(spark):
    rows = [("a", 1, None), ("b", None, dt.date(2026, 1, 1))]
    df = readers.literal_table(spark, rows, "k string, n int, d date")
    readers.register({"literal_view": df})
    assert [tuple(r) for r in spark.sql("SELECT * FROM literal_view ORDER BY k").collect()] == rows
    assert [r["type"] for r in readers.describe(df).orderBy("position").collect()] == ["string", "int", "date"]


def test_scratch_folders_are_fresh_and_shared(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(checkpoint_dir(spark))
