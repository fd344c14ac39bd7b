"""Late records added to a base table: by interval, by keys, by shared columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.codes import service_kind
from recordops.functions.nulls import not_blank
from recordops.functions.text import code_part, description_part
from recordops.operators.columns import apply_each, shared_columns
from recordops.operators.combine import stack, stack_by_position
from recordops.operators.joins import Keys, lookup, not_covered_by_interval, unmatched


def split_codes(df: DataFrame, texts: dict[str, tuple[str, str]], width: int = 4) -> DataFrame:
    """"code description" texts into two columns each."""
    parts: dict[str, Column] = {}
    for text, (code, description) in texts.items():
        parts[code] = code_part(text, width)
        parts[description] = description_part(text, width)
    return df.withColumns(parts)


def usable_late_rows(
    late: DataFrame, person: str, date: str, cancelled: str | None = None, year: int | None = None
) -> DataFrame:
    """Late rows that were not cancelled and carry a person and a date."""
    if cancelled is not None:
        late = late.filter(F.col(cancelled).isNull())
    late = late.filter(not_blank(F.col(person)) & not_blank(F.col(date).cast("string")))
    if year is not None:
        late = late.filter(F.year(F.col(date).try_cast("date")) == year)
    return late


def usable_consultations(
    late: DataFrame,
    status: str,
    service: str,
    time: str,
    year: int,
    no_show: str = fixed.NO_SHOW,
) -> DataFrame:
    """Consultations that took place in a year, with `visit_date` and `kind`.

    A missing status counts as kept; a time that cannot be read as not dated.
    """
    kept = late.filter(F.coalesce(F.col(status), F.lit("")) != no_show)
    day = F.col(time).try_cast("timestamp_ntz").cast("date")
    dated = kept.withColumns({"visit_date": day, "kind": service_kind(service)})
    return dated.filter(F.year("visit_date") == year)


def dated_until(
    df: DataFrame, inserted: str, visited: str, cut: Column, require_inserted: bool = True
) -> DataFrame:
    """Rows inserted up to a cut date, both dates as dates.

    A missing insertion date is replaced by the visit date, unless such rows are
    left out, which is the default.
    """
    df = apply_each(df, [inserted, visited], lambda c: c.cast("date"))
    if require_inserted:
        df = df.filter(F.col(inserted).isNotNull())
    df = df.withColumn(inserted, F.coalesce(inserted, visited))
    return df.filter(F.col(inserted) <= cut)


def supplement_by_interval(
    base: DataFrame,
    late: DataFrame,
    keys: Keys,
    late_date: str,
    start: str,
    end: str,
    aligned: dict[str, Column],
    labels: tuple[str, str],
    source: str = "source",
) -> DataFrame:
    """Late events outside every stay of their keys, added to the base.

    `aligned` gives the base columns of a late row; others become NULL.
    """
    missing = not_covered_by_interval(late, base, keys, late_date, start, end)
    missing = missing.select(*[c.alias(n) for n, c in aligned.items()])
    return stack(
        base.withColumn(source, F.lit(labels[0])),
        missing.withColumn(source, F.lit(labels[1])),
    )


def settle_dates(
    df: DataFrame, dates: list[str], inserted: str, fallback: str, fixes=fixed.DATE_FIXES
) -> DataFrame:
    """Dates of one type, a default for the insertion date, known errors put right."""
    df = apply_each(df, dates, lambda c: c.cast("date"))
    df = df.withColumn(inserted, F.coalesce(inserted, fallback))
    for wrong, right in fixes.items():
        bad, good = (F.lit(d).cast("date") for d in (wrong, right))
        df = apply_each(df, dates, lambda c: F.when(c == bad, good).otherwise(c))
    return df


def with_catalogue_type(
    df: DataFrame, catalogue: DataFrame, code: str, catalogue_code: str, kind: str, name: str
) -> DataFrame:
    """The catalogue's type of a code."""
    small = catalogue.select(catalogue_code, F.col(kind).alias(name))
    return lookup(df, small, [(code, catalogue_code)])


def supplement_by_keys(
    base: DataFrame,
    late: DataFrame,
    keys: list[str],
    labels: tuple[str | None, str],
    source: str = "source",
    null_safe: bool = False,
    present: Column | None = None,
) -> DataFrame:
    """Late rows whose keys the base does not have, added to it.

    Both sides have the same columns; the base keeps its own `source` when the
    first label is None. A missing key counts as not present. With `present`,
    only base rows that meet it count as present; the others stay in the result.
    """
    counted = base if present is None else base.filter(present)
    missing = unmatched(late, counted, keys, null_safe).withColumn(source, F.lit(labels[1]))
    if labels[0] is not None:
        base = base.withColumn(source, F.lit(labels[0]))
    return stack_by_position(base, missing.select(*base.columns))


def supplement_on_shared(
    base: DataFrame,
    late: DataFrame,
    keys: list[str],
    labels: tuple[str, str],
    skip: tuple[str, ...] = (),
    extra: dict[str, tuple[Column, Column]] | None = None,
    source: str = "source",
) -> DataFrame:
    """Late rows added on the columns both tables have.

    `extra` names further columns with their expression on the base and on the
    late side. Rows with a missing key are not taken from the late side.
    """
    extra = extra or {}
    shared = shared_columns(late, base, skip=(*skip, *extra))
    base_rows = base.select(
        *shared, *[b.alias(n) for n, (b, _) in extra.items()], F.lit(labels[0]).alias(source)
    )
    late_rows = late.dropna(subset=keys).select(
        *shared, *[e.alias(n) for n, (_, e) in extra.items()], F.lit(labels[1]).alias(source)
    )
    return stack_by_position(base_rows, unmatched(late_rows, base_rows, keys, null_safe=False))


def source_audit(df: DataFrame, dates: list[str], source: str = "source") -> DataFrame:
    """Rows and missing dates per source."""
    missing = [F.count_if(F.col(d).isNull()).alias(f"missing_{d}") for d in dates]
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("n"), *missing)


def before_and_added(df: DataFrame, labels: tuple[str, str], source: str = "source") -> DataFrame:
    """Rows of the base, rows added and their total."""
    return df.agg(
        F.count_if(F.col(source) == labels[0]).alias("before"),
        F.count_if(F.col(source) == labels[1]).alias("added"),
        F.count(F.lit(1)).alias("total"),
    )
