"""Missing values, ties and blanks, which the given tables do not contain."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions import codes, coordinates, dates, nulls, text
from recordops.operators import aggregates, columns, combine, joins, ranking


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def one(spark, column, value=None):
    source = spark.createDataFrame([(value,)], "x string")
    return source.select(column.alias("y")).first()["y"]


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, w string")


def test_joins_match_missing_keys(left, right):
    assert rows(joins.matched(left, right, ["k"]), "v") == [(1, "a"), (None, "c")]
    assert rows(joins.unmatched(left, right, ["k"])) == [(2, "b")]
    assert joins.lookup(left, right, ["k"]).count() == 4


def test_plain_joins_do_not_match_missing_keys(left, right):
    assert rows(joins.matched(left, right, ["k"], null_safe=False)) == [(1, "a")]
    assert rows(joins.unmatched(left, right, ["k"], null_safe=False), "v") == [(2, "b"), (None, "c")]
    audit = joins.match_audit(left, right, ["k"]).first()
    assert tuple(audit) == (3, 1, 2)
    assert audit["total"] == audit["matched"] + audit["missing"]


def test_existence_joins_do_not_multiply(left, right):
    flagged = joins.flag_matches(left, right, ["k"], "f")
    assert rows(flagged, "v") == [(1, "a", True), (2, "b", False), (None, "c", True)]


def test_right_join_keeps_the_right(left, right):
    out = joins.lookup(left, right, ["k"], "right")
    assert out.columns == ["k", "v", "w"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a", "x"), (1, "a", "y"), (None, "c", "z")], key=str
    )


def test_full_join_keeps_both_sides(spark, left):
    other = spark.createDataFrame([(2, "p"), (9, "q"), (None, "r")], "k int, w string")
    out = sorted(map(tuple, joins.full_join(left, other, ["k"]).collect()), key=str)
    assert out == sorted(
        [(1, "a", None), (2, "b", "p"), (None, "c", "r"), (9, None, "q")], key=str
    )


def test_membership_and_its_opposite_split_all_rows(left):
    listed = nulls.member("k", [1])
    assert rows(left.filter(~listed), "v") == [(2, "b"), (None, "c")]


def test_split_with_and_without_unknown(left):
    yes, other = columns.split_rows(left, F.col("k") == 1)
    assert (yes.count(), other.count()) == (1, 2)
    _, strict = columns.split_rows(left, F.col("k") == 1, keep_unknown=False)
    assert strict.count() == 1


def test_distinct_counts(right, spark):
    counts = right.agg(nulls.distinct_with_null("k").alias("a"), F.count_distinct("k").alias("b"))
    assert tuple(counts.first()) == (2, 1)
    assert right.agg(aggregates.surplus("k").alias("s")).first()["s"] == 1
    empty = spark.createDataFrame([], "k int")
    assert empty.agg(nulls.distinct_with_null("k").alias("a")).first()["a"] == 0


def test_conditionals_with_unknown(spark):
    unknown = F.col("x") == "a"
    assert one(spark, nulls.strict_if(unknown, 1, 2)) is None
    assert one(spark, nulls.strict_if(unknown, 1, 2), "b") == 2
    assert one(spark, F.when(unknown, 1).otherwise(2)) == 2


def test_sort_puts_missing_last_both_ways(left):
    up = [r["k"] for r in left.orderBy(*nulls.nulls_last("k")).collect()]
    down = [r["k"] for r in left.orderBy(*nulls.nulls_last("-k")).collect()]
    assert (up, down) == ([1, 2, None], [2, 1, None])


def test_joined_text_skips_missing(spark):
    assert one(spark, nulls.join_text(" ", F.lit("a"), F.col("x"), F.lit("b"))) == "a b"
    assert one(spark, nulls.join_text(" ", F.col("x"), F.col("x"))) is None


def test_sums(left, spark):
    both = left.agg(nulls.strict_sum("k").alias("a"), nulls.sum_or_zero("k").alias("b"))
    assert tuple(both.first()) == (None, 3)
    empty = spark.createDataFrame([(None,)], "k int")
    assert empty.agg(nulls.sum_or_zero("k").alias("b")).first()["b"] == 0


def test_any_true_of_unknown_is_false(left):
    nothing = left.filter("k is null").agg(nulls.any_true(F.col("k") > 0).alias("a"))
    assert nothing.first()["a"] is False


def test_rounding_to_even(spark):
    assert one(spark, F.bround(F.lit(2.5), 0)) == 2.0
    assert one(spark, text.count_with_percent(F.lit(1234), F.lit(1234 * 8))) == "1,234 (12%)"


@pytest.mark.parametrize(
    "value, expected",
    [("12", True), (" -1.5e3 ", True), (".5", True), ("1d", False), ("", False), (None, False), ("1,5", False), ("5°", False)],
)
def test_is_number(spark, value, expected):
    assert one(spark, text.is_number("x"), value) is expected


@pytest.mark.parametrize(
    "value, expected",
    [("No. 1,234.5 m", 1234.5), ("110..26522", 110.0), ("-92.02061°", -92.02061), ("abc", None), (None, None), ("930138 1", 930138.0)],
)
def test_first_number(spark, value, expected):
    assert one(spark, text.first_number("x"), value) == expected


def test_unmatched_regex_is_missing(spark):
    assert one(spark, text.extract("x", "b+"), "aaa") is None
    assert one(spark, text.extract("x", "a(b?)", 1), "ac") is None


def test_spacing(spark):
    assert one(spark, text.squish("x"), "\t a \n  b ") == "a b"
    assert one(spark, text.trim_all("x"), "\n a  b\t") == "a  b"


def test_code_and_description(spark):
    assert one(spark, text.code_part("x"), "740X Cesárea ") == "740X"
    assert one(spark, text.description_part("x"), "740X Cesárea ") == "Cesárea"
    assert one(spark, text.code_part("x")) is None


def test_recode(spark):
    assert one(spark, text.recode("x", fixed.FACILITY_REMAP), "PLIMB003706") == "PLIMB002516"
    assert one(spark, text.recode("x", fixed.FACILITY_REMAP), "ZZ") == "ZZ"
    assert one(spark, text.recode("x", fixed.FACILITY_REMAP)) is None


def test_last_wednesday_for_every_weekday(spark):
    days = [dt.date(2026, 5, 18) + dt.timedelta(days=i) for i in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", dates.last_wednesday("d").alias("w")).collect():
        assert r["w"] == dates.last_wednesday_of(r["d"])
        assert r["w"].weekday() == 2 and 1 <= (r["d"] - r["w"]).days <= 7


def test_week_starts_on_monday(spark):
    df = spark.createDataFrame([(dt.date(2026, 5, 24),)], "d date")
    assert df.select(dates.week_start("d")).first()[0] == dt.date(2026, 5, 18)


def test_bad_dates_are_missing(spark):
    assert one(spark, dates.parse_date("x"), "no date") is None
    assert one(spark, dates.parse_date("x"), "2026-02-30") is None
    assert one(spark, dates.month_start(F.lit(2025), dates.month_number("x")), "Julio") == dt.date(2025, 7, 1)
    assert one(spark, dates.month_start(F.lit(2025), dates.month_number("x")), "Unknown") is None


def test_local_year_does_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            df = spark.sql("SELECT timestamp'2026-01-01 03:00:00Z' AS t, '2026-01-01 03:00:00' AS x")
            years = df.select(dates.local_year(df, "t"), dates.local_year(df, "x")).first()
            assert tuple(years) == (2025, 2026)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("14°47'", 14 + 47 / 60),
        ("92° 30' 36\" W", -(92 + 30 / 60 + 36 / 3600)),
        ("15.63065°", 15.63065),
        ("10°S", -10.0),
        ("16.5", None),
        (None, None),
    ],
)
def test_degrees(spark, value, expected):
    assert one(spark, coordinates.dms_to_decimal("x"), value) == pytest.approx(expected)


@pytest.mark.parametrize(
    "lat, lon, expected",
    [
        ("x", "16.5, -92.25", (16.5, -92.25)),
        ("x", "-92.4453267,13.92", (-92.4453267, 13.92)),
        ("16°30'N  92°15'W", None, (16.5, -92.25)),
        ("16°30'N", "92°15'W", (16.5, -92.25)),
        ("16.5 aprox", "-92.25.", (16.5, -92.25)),
        (None, "-92", (None, -92.0)),
        ("", "", (None, None)),
    ],
)
def test_coordinates_from_text(spark, lat, lon, expected):
    df = spark.createDataFrame([(lat, lon)], "lat string, lon string")
    out = coordinates.coordinates_from_text(df, "lat", "lon").first()
    assert (out["lat_num"], out["lon_num"]) == pytest.approx(expected)


@pytest.mark.parametrize(
    "value, expected",
    [(" 'abcd 01\t’x", "ABCD01X"), ("\x01a`b´c“d”", "ABCD"), (None, None), (" ", "")],
)
def test_clean_key(spark, value, expected):
    assert one(spark, codes.clean_key("x"), value) == expected


def test_role_rules(spark):
    df = spark.createDataFrame(
        [("OP057", "CHOFER POLIVALENTE"), (None, "OTRO"), ("ME001", "OTRO"), ("X", "MEDICINA GENERAL")],
        "c string, t string",
    )
    out = [tuple(r) for r in df.select(codes.role_code("c", "t"), codes.role_code("c", "t", False)).collect()]
    assert out == [("PA020", "PA022"), ("OTRO", "OTRO"), ("ME001", "ME001"), ("MG001", "MG001")]


def test_point_corrections(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "k string, v double")
    out = columns.correct_values(df, "v", {"a": 9.0}, by="k")
    assert [r["v"] for r in out.collect()] == [9.0, 2.0, 3.0]


def test_union_forms(left, right):
    assert combine.stack(left, right).columns == ["k", "v", "w"]
    with pytest.raises(ValueError):
        combine.stack_same(left, right)


def test_pivot_has_all_columns(left):
    out = aggregates.pivot_values(left, ["k"], "v", ["a", "zzz"], F.count(F.lit(1)))
    assert out.columns == ["k", "a", "zzz"]
    assert {r["zzz"] for r in out.collect()} == {0}


def test_row_minimum(spark):
    df = spark.createDataFrame([(1, None), (3, 2)], "a int, b int")
    loose, strict = (aggregates.row_minimum(["a", "b"], s) for s in (True, False))
    assert [tuple(r) for r in df.select(loose, strict).collect()] == [(1, None), (2, 2)]


def test_groups_with_missing_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    sized = ranking.attach_group(df, ["k"], n=F.count(F.lit(1)))
    assert [r["n"] for r in sized.orderBy("v").collect()] == [2, 2, 1]
    assert ranking.keep_groups(df, ["k"], F.count(F.lit(1)) > 1).count() == 2
    ids = ranking.duplicate_group_ids(df, ["k"], "g", size="n").orderBy("v").collect()
    assert [(r["g"], r["n"]) for r in ids] == [(1, 2), (1, 2), (0, 1)]


def test_frequency_forms(left):
    assert aggregates.frequency(left, ["k"]).count() == 3
    assert aggregates.frequency(left, ["k"], keep_null=False).count() == 2


def test_totals_keep_missing_dimensions_apart(spark):
    df = spark.createDataFrame([("x", None, 1), ("x", "p", 2)], "a string, b string, v int")
    out = aggregates.with_totals(df, ["a", "b"], {"v": F.sum("v")})
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("x", None, 1, 0), ("x", "p", 2, 0), ("x", "TOTAL", 3, 1), ("TOTAL", "TOTAL", 3, 2)], key=str
    )
