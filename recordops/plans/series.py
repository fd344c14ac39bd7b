"""Weekly events and monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.codes import surgical_kind
from recordops.functions.dates import month_number, month_start, week_start
from recordops.functions.nulls import any_true, distinct_with_null, member, sum_or_zero
from recordops.functions.text import thousands
from recordops.operators.joins import flag_matches, lookup, matched


def classify_procedures(
    procedures: DataFrame,
    stays: DataFrame,
    catalogue: DataFrame,
    keys: list,
    code: tuple[str, str],
    date: str,
    in_room: str,
    kind: str = "kind",
    unique_stays: bool = False,
) -> DataFrame:
    """Procedures of known stays with type, category and week.

    `code` pairs the code column of the procedures with that of the catalogue,
    whose type column is `kind`; `unique_stays` tells that `keys` identify a stay.
    """
    known = matched(procedures, stays, keys, unique=unique_stays)
    types = catalogue.select(code[1], kind)
    typed = lookup(known, types, [code])
    return typed.withColumns(
        {"category": surgical_kind(kind, in_room), "week": week_start(date)}
    )


def summarise_events(
    classified: DataFrame, event: list[str], number: str, in_room: str, kind: str = "kind"
) -> DataFrame:
    """One row per event: is it surgical, and its procedures by type and place."""
    td, q = member(kind, ["T", "D"]), F.col(kind) == "Q"
    inside, outside = F.col(in_room) == 1, F.col(in_room) != 1
    return classified.groupBy(*event, "week").agg(
        any_true(F.col("category") == fixed.SURGICAL).alias("surgical"),
        distinct_with_null(number).alias("procedures"),
        F.count_if(td).alias("td"),
        F.count_if(q).alias("q"),
        F.count_if(td & inside).alias("td_in"),
        F.count_if(td & outside).alias("td_out"),
        F.count_if(q & inside).alias("q_in"),
        F.count_if(q & outside).alias("q_out"),
    )


def weekly_events(events: DataFrame) -> DataFrame:
    """All, surgical and other events per week."""
    return events.groupBy("week").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("surgical")).alias("surgical_events"),
        F.count_if(~F.col("surgical")).alias("other_events"),
    )


def weekly_procedures(events: DataFrame) -> DataFrame:
    """Events and procedures of the surgical events per week."""
    sums = [F.sum(c).alias(c) for c in ("procedures", "td", "q")]
    surgical = events.filter("surgical").groupBy("week")
    return surgical.agg(F.count(F.lit(1)).alias("events"), *sums)


def weekly_room_split(events: DataFrame) -> DataFrame:
    """Procedures of the surgical events per week, inside and outside the room."""
    sums = [F.sum(c).alias(c) for c in ("td_in", "q_in", "td_out", "q_out")]
    return events.filter("surgical").groupBy("week").agg(*sums)


def monthly_series(
    df: DataFrame,
    members: DataFrame,
    member_key: tuple[str, str],
    year: str,
    month: str,
    measure: str,
    labels: tuple[str, str],
    total: str = "total",
) -> DataFrame:
    """Monthly totals of members and others, dated.

    One pass with a flag instead of one pass per set. Months are Spanish names;
    unknown ones are left out.
    """
    flagged = flag_matches(df, members, [member_key], "_member", null_safe=False)
    origin = F.when(F.col("_member"), labels[0]).otherwise(labels[1])
    sums = flagged.groupBy(year, month, origin.alias("origin")).agg(
        sum_or_zero(measure).alias(total)
    )
    known = sums.filter(F.col(month) != fixed.UNKNOWN_MONTH)
    return known.withColumn("date", month_start(year, month_number(month)))


def month_labels(series: DataFrame, month: int = 7, total: str = "total") -> DataFrame:
    """Rows of one calendar month with their total in thousands as text."""
    chosen = series.filter(F.month("date") == month)
    return chosen.withColumn("label", thousands(F.bround(F.col(total) / 1000, 0)))
