"""Person keys, role codes and service codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.nulls import ColumnOrName, col, member
from recordops.functions.text import lookup_value

QUOTES_BLANKS_CONTROLS = r"(?U)['\"`´“”‘’]|\s|\p{Cntrl}"


def clean_key(c: ColumnOrName) -> Column:
    """Person key without quotes, blanks and control characters, in capitals."""
    return F.upper(F.regexp_replace(col(c).cast("string"), QUOTES_BLANKS_CONTROLS, ""))


def key_fits(c: ColumnOrName, pattern: str = fixed.PERSON_KEY_PATTERN) -> Column:
    return col(c).rlike(pattern)


def role_code(code: ColumnOrName, text: ColumnOrName, code_first: bool = True) -> Column:
    """One role code from a code field and a text field.

    `code_first` tells which field wins when both name a role; the text is kept
    as the code when the code is missing and nothing fits.
    """
    by_code = lookup_value(code, fixed.ROLE_OF_CODE)
    by_text = lookup_value(text, fixed.ROLE_OF_TEXT)
    first, second = (by_code, by_text) if code_first else (by_text, by_code)
    return F.coalesce(first, second, col(code), col(text))


def role_code_other_extract(code: ColumnOrName, text: ColumnOrName) -> Column:
    """Role code for extracts in which a blank code is replaced by the text."""
    filled = F.when(col(code).isNull() | (col(code) == ""), col(text)).otherwise(col(code))
    return F.coalesce(lookup_value(filled, fixed.ROLE_OF_TEXT_OTHER_EXTRACT), filled)


def position_of_role(c: ColumnOrName) -> Column:
    """Team position of a role code."""
    return lookup_value(c, fixed.POSITION_OF_ROLE)


def position_from_fields(code: ColumnOrName, text: ColumnOrName) -> Column:
    """Team position from either field, as the gap report reads them; the code wins."""
    by_code = lookup_value(code, fixed.GAP_POSITION_OF_CODE)
    return F.coalesce(by_code, lookup_value(text, fixed.GAP_POSITION_OF_TEXT))


def service_kind(c: ColumnOrName, general=tuple(fixed.GENERAL_SERVICES)) -> Column:
    """General or specialty consultation, by service code."""
    return F.when(member(c, general), "general").otherwise("especialidad")


def surgical_kind(kind: ColumnOrName, in_room: ColumnOrName) -> Column:
    """Surgical or not: type Q always, types T and D only inside the room."""
    surgical = (member(kind, ["T", "D"]) & (col(in_room) == 1)) | (col(kind) == "Q")
    return F.when(surgical, fixed.SURGICAL).otherwise(fixed.NOT_SURGICAL)


def status_priority(c: ColumnOrName) -> Column:
    """1 approved, 2 without status, 3 any other."""
    blank = col(c).isNull() | (F.trim(col(c)) == "")
    return F.when(col(c) == fixed.APPROVED, 1).when(blank, 2).otherwise(3)
