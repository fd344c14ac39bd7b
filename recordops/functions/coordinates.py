"""Coordinates in free text: reading, repair and causes of failure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.nulls import ColumnOrName, col
from recordops.functions.text import extract, first_number, squish
from recordops.operators.columns import computed_once


@dataclass(frozen=True)
class Bounds:
    latitude: tuple[float, float] = fixed.LATITUDE_RANGE
    longitude: tuple[float, float] = fixed.LONGITUDE_RANGE

    def like_latitude(self, c: Column) -> Column:
        return c.between(*self.latitude)

    def like_longitude(self, c: Column) -> Column:
        return c.between(*self.longitude)

    def valid(self, lat: ColumnOrName, lon: ColumnOrName) -> Column:
        return self.like_latitude(col(lat)) & self.like_longitude(col(lon))


def dms_to_decimal(c: ColumnOrName) -> Column:
    """Degrees, minutes and seconds as a decimal, south and west negative."""
    return _decimal(squish(c))


def _decimal(text: Column) -> Column:
    def part(group: int) -> Column:
        return extract(text, fixed.DMS_PATTERN, group).try_cast("double")

    size = (
        part(1)
        + F.coalesce(part(2), F.lit(0.0)) / 60
        + F.coalesce(part(3), F.lit(0.0)) / 3600
    )
    sign = F.when(F.regexp_extract(text, fixed.DMS_PATTERN, 4).isin("S", "W"), -1.0)
    return size * sign.otherwise(1.0)


def coordinates_from_text(
    df: DataFrame, lat: str, lon: str, lat_name: str = "lat_num", lon_name: str = "lon_num"
) -> DataFrame:
    """Latitude and longitude from free text; the first rule that fits wins.

    1. the longitude field holds a pair of numbers, 2. the latitude field holds
    two values in degrees, 3. the field holds one value in degrees, 4. the first
    number of the field.
    """
    pair, two = fixed.NUMBER_PAIR_PATTERN, fixed.DMS_PAIR_PATTERN
    out = computed_once(df, _lat=squish(lat), _lon=squish(lon))
    has_two = F.col("_lat").rlike(two)

    def degrees(text: str, half: int) -> Column:
        """The text to read in degrees, NULL when rule 4 applies."""
        marked = F.when(F.col(text).rlike(fixed.DMS_MARK_PATTERN), F.col(text))
        return F.when(has_two, F.regexp_extract("_lat", two, half)).otherwise(marked)

    out = computed_once(
        out,
        _pair=F.col("_lon").rlike(pair),
        _lat_dms=degrees("_lat", 1),
        _lon_dms=degrees("_lon", 2),
    )

    def read(text: str, half: int) -> Column:
        dms = F.col(f"{text}_dms")
        return (
            F.when(F.col("_pair"), extract("_lon", pair, half).try_cast("double"))
            .when(dms.isNotNull(), _decimal(dms))
            .otherwise(first_number(text))
        )

    out = computed_once(out, **{lat_name: read("_lat", 1), lon_name: read("_lon", 2)})
    return out.drop("_lat", "_lon", "_pair", "_lat_dms", "_lon_dms")


def force_west(lon: ColumnOrName) -> Column:
    """Longitudes are negative in this part of the world."""
    return F.when(col(lon) > 0, -col(lon)).otherwise(col(lon))


def untangle_axes(
    lat: ColumnOrName, lon: ColumnOrName, bounds: Bounds = Bounds()
) -> tuple[Column, Column]:
    """Exchange the axes when the latitude looks like a longitude.

    Both become NULL when both look like longitudes.
    """
    lat, lon = col(lat), col(lon)
    reversed_ = bounds.like_longitude(lat)
    both = reversed_ & bounds.like_longitude(lon)
    nothing = F.lit(None).cast("double")
    return (
        F.when(both, nothing).when(reversed_, lon).otherwise(lat),
        F.when(both, nothing).when(reversed_, lat).otherwise(lon),
    )


def swap_reversed(
    lat: ColumnOrName, lon: ColumnOrName, bounds: Bounds = Bounds()
) -> tuple[Column, Column]:
    """Exchange the axes when each lies in the range of the other."""
    lat, lon = col(lat), col(lon)
    reversed_ = bounds.like_longitude(lat) & bounds.like_latitude(lon)
    return (
        F.when(reversed_, lon).otherwise(lat),
        F.when(reversed_, lat).otherwise(lon),
    )


def failure_cause(
    lat: ColumnOrName, lon: ColumnOrName, bounds: Bounds = Bounds()
) -> Column:
    """Why a coordinate cannot be used."""
    lat, lon = col(lat), col(lon)
    lat_out, lon_out = ~bounds.like_latitude(lat), ~bounds.like_longitude(lon)
    return (
        F.when(lat.isNull() & lon.isNull(), fixed.CAUSE_BOTH_MISSING)
        .when(lat.isNull(), fixed.CAUSE_LAT_MISSING)
        .when(lon.isNull(), fixed.CAUSE_LON_MISSING)
        .when(lat_out & lon_out, fixed.CAUSE_BOTH_RANGE)
        .when(lat_out, fixed.CAUSE_LAT_RANGE)
        .when(lon_out, fixed.CAUSE_LON_RANGE)
        .otherwise(fixed.CAUSE_NONE)
    )
