"""Text: spacing, numbers in text, codes, labels and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordops.functions.nulls import ColumnOrName, col

NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
FIRST_NUMBER = r"-?(\d+(\.\d*)?|\.\d+)"


def squish(c: ColumnOrName) -> Column:
    """Runs of white space become one blank; none at the ends (H3)."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def trim_all(c: ColumnOrName) -> Column:
    """White space of any kind removed at both ends (H3)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def is_number(c: ColumnOrName) -> Column:
    """True for text that is wholly a number; false for missing text (H1)."""
    text = col(c).cast("string")
    return F.coalesce(text.rlike(NUMBER), F.lit(False))


def first_number(c: ColumnOrName) -> Column:
    """First number in a text, thousands separators ignored (H2)."""
    found = F.regexp_substr(F.replace(col(c), F.lit(","), F.lit("")), F.lit(FIRST_NUMBER))
    return found.try_cast("double")


def extract(c: ColumnOrName, pattern: str, group: int = 0) -> Column:
    """Matched text or group; NULL without a match (H5)."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def remove(c: ColumnOrName, pattern: str) -> Column:
    return F.regexp_replace(col(c), pattern, "")


def code_part(c: ColumnOrName, width: int = 4) -> Column:
    """The code in "code description" text (H8)."""
    return F.substring(col(c), 1, width)


def description_part(c: ColumnOrName, width: int = 4) -> Column:
    """The description in "code description" text (H8)."""
    return trim_all(F.substr(col(c), F.lit(width + 2)))


def thousands(n: ColumnOrName) -> Column:
    return F.format_number(col(n), 0)


def count_with_percent(n: ColumnOrName, total: ColumnOrName) -> Column:
    """A count and its share: "1,234 (56%)" (H12)."""
    percent = F.bround(col(n) / F.nullif(col(total), F.lit(0)) * 100, 0).cast("int")
    return F.concat(thousands(n), F.lit(" ("), percent.cast("string"), F.lit("%)"))


def popup(df, columns: list[str], separator: str = "<br>") -> Column:
    """Text of whichever of the columns exist, in order."""
    present = [F.col(c).cast("string") for c in columns if c in df.columns]
    return F.concat_ws(separator, *present)


def recode(c: ColumnOrName, mapping: dict) -> Column:
    """Values found in the mapping are replaced, others kept."""
    return F.coalesce(lookup_value(c, mapping), col(c))


def lookup_value(c: ColumnOrName, mapping: dict) -> Column:
    """Value of a literal mapping; NULL outside it."""
    pairs = [F.lit(v) for pair in mapping.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), col(c))
