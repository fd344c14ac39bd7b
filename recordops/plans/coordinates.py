"""Cleaning of coordinate text, and an account of the rows that are lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.coordinates import (
    Bounds,
    coordinates_from_text,
    failure_cause,
    force_west,
    swap_reversed,
    untangle_axes,
)
from recordops.functions.nulls import holds
from recordops.functions.text import is_number, lookup_value
from recordops.operators.aggregates import stage_counts
from recordops.operators.columns import computed_once
from recordops.operators.combine import stack
from recordops.operators.joins import lookup, unmatched
from recordops.operators.ranking import first_per_key
from recordops.sources.writers import written_parts


def _numeric_longitude(lat: Column, lon: Column) -> Column:
    """Longitudes put right for known pairs."""
    out = lon
    for latitude, low, high, right in fixed.NUMERIC_LONGITUDE_FIXES:
        known = (lat == latitude) & lon.between(low, high)
        out = F.when(known, right).otherwise(out)
    return out


def read_coordinates(
    df: DataFrame,
    lat: str,
    lon: str,
    bounds: Bounds = Bounds(),
    known_fixes: bool = True,
    swap_first: bool = False,
) -> DataFrame:
    """Number, origin, validity and cause of failure for every row, in one pass.

    Adds `origin`, `lat_num`, `lon_num`, `is_valid`, `cause`. `is_valid` is NULL
    where a missing axis leaves the question open. `swap_first` exchanges axes
    that are each in the range of the other before the check; the default keeps
    that exchange after it, where it finds nothing to do.
    """
    number = {a: F.trim(F.col(a).cast("string")).try_cast("double") for a in (lat, lon)}
    out = coordinates_from_text(df, lat, lon, "_lat_text", "_lon_text")
    out = computed_once(
        out,
        _num=is_number(lat) & is_number(lon),
        _lat=number[lat],
        _lon=force_west(number[lon]),
    )
    lat_a, lon_a = untangle_axes("_lat", "_lon", bounds)
    lat_b, lon_b = F.col("_lat_text"), F.col("_lon_text")
    if known_fixes:
        lon_a = _numeric_longitude(lat_a, lon_a)
        lat_b = F.coalesce(
            lookup_value(lon, fixed.LATITUDE_FIXES_BY_LONGITUDE),
            lookup_value(lat, fixed.LATITUDE_FIXES_BY_LATITUDE),
            lat_b,
        )
        lon_b = F.coalesce(lookup_value(lon, fixed.LONGITUDE_FIXES_BY_LONGITUDE), lon_b)
    numeric = F.col("_num")
    out = computed_once(
        out,
        origin=F.when(numeric, fixed.NUMERIC_ORIGIN).otherwise(fixed.TEXT_ORIGIN),
        lat_num=F.when(numeric, lat_a).otherwise(lat_b),
        lon_num=F.when(numeric, lon_a).otherwise(lon_b),
    ).drop("_num", "_lat", "_lon", "_lat_text", "_lon_text")
    if swap_first:
        lat_s, lon_s = swap_reversed("lat_num", "lon_num", bounds)
        out = out.withColumns({"lat_num": lat_s, "lon_num": lon_s})
    return out.withColumns(
        {
            "is_valid": bounds.valid("lat_num", "lon_num"),
            "cause": failure_cause("lat_num", "lon_num", bounds),
        }
    )


PARTS = (
    "numeric_valid",
    "numeric_review",
    "text_valid",
    "text_review",
    "final_valid",
    "final_review",
)


def coordinate_tables(
    df: DataFrame,
    lat: str,
    lon: str,
    bounds: Bounds = Bounds(),
    known_fixes: bool = True,
    review_missing_text: bool = True,
    swap_first: bool = False,
) -> DataFrame:
    """The valid, review and final rows in one table, told apart by `part`.

    A valid row occurs twice: under its origin and in the final table, where
    exchanged axes are put right. Numeric rows with a missing axis go to no
    review unless the other axis is out of range; `review_missing_text` off
    treats text rows the same way.
    """
    read = read_coordinates(df, lat, lon, bounds, known_fixes, swap_first)
    numeric = F.col("origin") == fixed.NUMERIC_ORIGIN
    valid, bad = F.col("is_valid"), ~F.col("is_valid")
    text_bad = ~holds(valid) if review_missing_text else bad
    lat_s, lon_s = swap_reversed("lat_num", "lon_num", bounds)
    own = (
        F.when(numeric & valid, "numeric_valid")
        .when(numeric & bad, "numeric_review")
        .when(~numeric & valid, "text_valid")
        .when(~numeric & text_bad, "text_review")
    )
    final = F.when(bounds.valid(lat_s, lon_s), "final_valid").otherwise("final_review")

    def entry(part: Column, lat: Column, lon: Column) -> Column:
        cause = failure_cause(lat, lon, bounds)
        return F.struct(
            part.alias("part"), lat.alias("lat_num"), lon.alias("lon_num"), cause.alias("cause")
        )

    entries = F.array_compact(
        F.array(
            F.when(own.isNotNull(), entry(own, F.col("lat_num"), F.col("lon_num"))),
            F.when(valid, entry(final, lat_s, lon_s)),
        )
    )
    return read.select(*df.columns, "origin", F.inline(entries))


def clean_coordinates(df: DataFrame, lat: str, lon: str, **options) -> dict[str, DataFrame]:
    """The parts of `coordinate_tables` by name, from one pass whose result is stored by part."""
    tables = written_parts(coordinate_tables(df, lat, lon, **options), ["part"], "coordinates")
    return {p: tables.filter(F.col("part") == p).drop("part") for p in PARTS}


def coordinate_audit(df: DataFrame, lat: str, lon: str, **options) -> dict[str, DataFrame]:
    """What became of every input row, from one pass over it.

    `funnel`: rows per stage; `lost`: input rows missing from the result with
    their cause; `causes`: lost rows per origin and cause. A row that reached no
    review table is lost with the default cause and without origin.
    """
    read = read_coordinates(df, lat, lon, **options)
    numeric = F.col("origin") == fixed.NUMERIC_ORIGIN
    valid, bad = holds(F.col("is_valid")), holds(~F.col("is_valid"))
    reviewed = {c: F.when(bad, F.col(c)) for c in ("origin", "lat_num", "lon_num")}
    cause = F.when(bad, F.col("cause")).otherwise(fixed.CAUSE_LOST)
    lost = read.filter(~valid).withColumns({**reviewed, "cause": cause}).drop("is_valid")
    conditions = [F.lit(True), numeric & valid, numeric & bad, ~numeric & valid, ~numeric & bad]
    conditions += [valid, F.lit(False), ~valid]
    stages = dict(zip(fixed.LOSS_STAGES, conditions, strict=True))
    return {
        "funnel": stage_counts(read, stages),
        "lost": lost,
        "causes": lost.groupBy("origin", "cause")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("origin"), "cause"),
    }


def audit_losses(
    df: DataFrame,
    final: DataFrame,
    reviews: list[DataFrame],
    row_id: str,
    cause: str,
    default: str = fixed.CAUSE_LOST,
) -> dict[str, DataFrame]:
    """Input rows missing from a result, with the first known cause.

    For pipelines of any kind: `reviews` are the review tables in order of
    precedence, each with the row id, a cause and whatever else should be shown.
    """
    ranked = stack(*[r.withColumn("_stage", F.lit(i)) for i, r in enumerate(reviews)])
    known = first_per_key(ranked, [row_id], ["_stage", cause]).drop("_stage")
    lost = lookup(unmatched(df, final, [row_id]), known, [row_id])
    lost = lost.withColumn(cause, F.coalesce(F.col(cause), F.lit(default)))
    return {
        "lost": lost,
        "causes": lost.groupBy(cause).agg(F.count(F.lit(1)).alias("n")),
    }
