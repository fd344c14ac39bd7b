"""Column sets, corrections and row splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordops.functions.nulls import holds
from recordops.functions.text import lookup_value

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _empty(kind: T.DataType) -> Column | None:
    """Some value of a type to stand in for a missing one."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return None


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Join condition in which a missing key equals a missing key.

    Written with one equality per key. The operator `<=>` would be planned as two,
    the value and its absence, which doubles the sort keys and rules out the fast
    sort of a single number; the absence is compared after the match instead.
    """
    condition = F.lit(True)
    for l, r in pairs:
        a, b = F.col(l), F.col(r)
        empty_a, empty_b = _empty(left.schema[l].dataType), _empty(right.schema[r].dataType)
        if empty_a is None or empty_b is None:
            condition &= a.eqNullSafe(b)
            continue
        alike = (a.isNull() & b.isNull()) | (a.isNotNull() & b.isNotNull())
        condition &= (F.coalesce(a, empty_a) == F.coalesce(b, empty_b)) & alike
    return condition


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist (B2)."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def shared_columns(left: DataFrame, right: DataFrame, skip=()) -> list[str]:
    """Names that occur on both sides, in the order of the left."""
    return [c for c in left.columns if c in right.columns and c not in skip]


def columns_only_in(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c not in right.columns]


def numeric_columns(df: DataFrame, skip=()) -> list[str]:
    """Columns of a numeric type."""
    return [
        name
        for name, kind in df.dtypes
        if name not in skip and (kind in NUMERIC or kind.startswith("decimal"))
    ]


def without_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Drop columns by the end of their name."""
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def lead_with(df: DataFrame, *first: str) -> DataFrame:
    """The given columns first, then all others."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def apply_each(df: DataFrame, names: list[str], f: Callable[[Column], Column]) -> DataFrame:
    """One expression over many columns."""
    return df.withColumns({c: f(F.col(c)) for c in names})


def computed_once(df: DataFrame, **values: Column) -> DataFrame:
    """Columns whose long expressions are worked out once per row.

    Neighbouring projections and filters are merged by substitution, which would
    repeat the expression for every use. A generated row is not merged.
    """
    row = F.struct(*[v.alias(n) for n, v in values.items()])
    return df.select("*", F.inline(F.array(row)))


def ensure_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add the missing ones of the named columns as typed NULLs."""
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def correct_values(df: DataFrame, target: str, fixes: dict, by: str | None = None) -> DataFrame:
    """Replace a value for exact values of a key column.

    The corrections are a literal mapping, so no join is needed.
    """
    fixed = lookup_value(by or target, fixes)
    return df.withColumn(target, F.coalesce(fixed, F.col(target)))


def split_rows(
    df: DataFrame, condition: Column, keep_unknown: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition, and the others.

    Rows for which the condition is unknown go to the others; with
    `keep_unknown` off they go nowhere, as two opposite filters would have it.
    """
    other = ~holds(condition) if keep_unknown else ~condition
    return df.filter(condition), df.filter(other)


def retype(df: DataFrame, name: str, kind: str) -> DataFrame:
    """All columns but one as they are, that one last in another type."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.col(name).cast(kind).alias(name))
