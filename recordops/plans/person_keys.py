"""Validation of person keys and their match against a register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.codes import clean_key, key_fits
from recordops.functions.nulls import holds
from recordops.operators.aggregates import surplus
from recordops.operators.joins import lookup
from recordops.operators.ranking import attach_group
from recordops.sources.writers import written_parts


def validate_keys(
    df: DataFrame,
    key: str,
    pattern: str = fixed.PERSON_KEY_PATTERN,
    length: int = fixed.PERSON_KEY_LENGTH,
) -> DataFrame:
    """Cleaned key, what cleaning changed, and a status, for every row."""
    out = df.withColumn("key_clean", clean_key(key))
    out = out.withColumns(
        {
            "key_changed": F.col(key) != F.col("key_clean"),
            "key_blank": F.col("key_clean").isNull() | (F.col("key_clean") == ""),
            "key_length": F.char_length("key_clean"),
            "key_valid": key_fits("key_clean", pattern),
        }
    )
    status = (
        F.when(F.col("key_blank"), fixed.KEY_BLANK)
        .when(F.col("key_length") != length, fixed.KEY_BAD_LENGTH)
        .when(~F.col("key_valid"), fixed.KEY_BAD_FORMAT)
        .when(F.col("key_changed"), fixed.KEY_CORRECTED)
        .otherwise(fixed.KEY_UNCHANGED)
    )
    return out.withColumn("key_status", status)


def split_validated(validated: DataFrame) -> dict[str, DataFrame]:
    """Invalid and corrected keys, and counts per status."""
    return {
        "invalid": validated.filter(~F.col("key_valid")),
        "corrected": validated.filter(F.col("key_changed")),
        "status_counts": validated.groupBy("key_status").agg(F.count(F.lit(1)).alias("n")),
    }


def match_register(
    register: DataFrame, keys: DataFrame, key: str, found: str
) -> dict[str, DataFrame]:
    """A list of keys against a register (I4).

    `found` is a register column that is filled for every registered person, so a
    missing value tells that the key was not found. The matched table is stored
    once, by part; every output is a read of its parts.
    """
    seen = register.withColumn("_seen", F.lit(True))
    everything = lookup(seen, keys, [key], "right")
    known = F.col(found).isNotNull()
    part = F.when(known, "matched").when(F.col("_seen"), "unmatched").otherwise("never_seen")
    everything = everything.withColumn("_part", part)
    everything = attach_group(everything, [key], _n=F.count(F.lit(1)))
    everything = everything.withColumn("_repeated", (F.col("_n") > 1).cast("int")).drop("_seen", "_n")
    stored = written_parts(everything, ["_part", "_repeated"], "matches")
    rows = stored.drop("_part", "_repeated")
    chosen = lambda condition: stored.filter(condition).select(*rows.columns)
    return {
        "all": rows,
        "repeated": chosen("_repeated = 1"),
        "unmatched": chosen("_part <> 'matched'"),
        "matched": chosen("_part = 'matched'"),
        "never_seen": chosen("_part = 'never_seen'").select(*keys.columns),
        "summary": stored.agg(
            F.count(F.lit(1)).alias("total"),
            surplus(key).alias("surplus"),
            F.count_if(F.col("_part") != "matched").alias("unmatched"),
            F.count_if(F.col("_part") == "matched").alias("matched"),
        ),
    }


def recover_names(
    validated: DataFrame,
    previous: DataFrame,
    looked_up: DataFrame,
    previous_name: str = "name",
) -> dict[str, DataFrame]:
    """Names from an earlier list, then from lookup results (C17, I16).

    `previous`: `key_clean`, a name. `looked_up`: `key_clean`, `first_names`,
    `surname_1`, `surname_2`, one row per key; it is a finished table, no call is
    made. Rows with a well-formed key but no name anywhere are set apart.
    """
    previous = previous.select("key_clean", F.col(previous_name).alias("_previous"))
    previous = previous.filter(F.col("key_clean").isNotNull() & (F.col("key_clean") != ""))
    out = lookup(validated, previous, ["key_clean"], one_row_by=["_previous"])
    parts = ["first_names", "surname_1", "surname_2"]
    out = lookup(out, looked_up.select("key_clean", *parts), ["key_clean"], one_row_by=parts)
    joined = F.nullif(F.trim(F.regexp_replace(F.concat_ws(" ", *parts), r"\s+", " ")), F.lit(""))
    found = F.coalesce(*[F.col(p) for p in parts]).isNotNull()
    recovered = holds(F.col("_previous") != "")
    status = (
        F.when(~F.col("key_valid"), F.col("key_status"))
        .when(recovered, fixed.NAME_FROM_PREVIOUS)
        .when(found, fixed.NAME_FROM_LOOKUP)
        .otherwise(fixed.NAME_NOT_FOUND)
    )
    out = out.withColumns(
        {
            "name": F.coalesce(F.col("_previous"), joined),
            "name_recovered": recovered,
            "lookup_found": found,
            "lookup_status": status,
        }
    )
    out = out.drop("_previous", *parts)
    nameless = holds(F.col("key_valid")) & ~F.col("lookup_found") & F.col("name").isNull()
    return {
        "kept": out.filter(~nameless),
        "no_name": out.filter(nameless).withColumn("reason", F.lit(fixed.NO_NAME_REASON)),
        "status_counts": out.groupBy("lookup_status").agg(F.count(F.lit(1)).alias("n")),
    }
