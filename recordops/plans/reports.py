"""Module profiles, the exchange report, modes and goals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.nulls import (
    col,
    nulls_last,
    share_percent,
    strict_sum,
    sum_or_zero,
)
from recordops.functions.text import count_with_percent, extract, thousands
from recordops.operators.aggregates import sum_numeric
from recordops.operators.combine import stack, stack_same
from recordops.operators.joins import lookup, unmatched
from recordops.operators.ranking import top_per_key
from recordops.sources.readers import literal_table


@dataclass(frozen=True)
class Module:
    """One service module: its records and how to read them."""

    records: DataFrame
    facility: str
    covered: Column
    not_covered: Column
    person: str


def covered_by_code(c: str, pattern: str = fixed.NOT_COVERED_PATTERN) -> tuple[Column, Column]:
    """Covered and not covered by the form of a code."""
    return ~col(c).rlike(pattern), col(c).rlike(pattern)


def covered_by_flag(c: str) -> tuple[Column, Column]:
    """Covered and not covered by a yes/no text."""
    return col(c).isin(fixed.YES_VALUES), col(c) == fixed.NO_VALUE


def profile_measures(with_covered: bool = True) -> list[Column]:
    """Facilities, rows, covered rows and share not covered."""
    measures = [
        F.count_distinct("facility").alias("facilities"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("covered")).alias("covered"),
        F.bround(share_percent(F.col("not_covered")), 2).alias("percent_not_covered"),
    ]
    return measures if with_covered else [measures[0], measures[1], measures[3]]


def module_profile(modules: dict[str, Module], with_covered: bool = True) -> DataFrame:
    """One profile row per module from one grouped pass."""
    rows = stack(
        *[
            m.records.select(
                F.lit(name).alias("module"),
                F.col(m.facility).cast("string").alias("facility"),
                m.covered.alias("covered"),
                m.not_covered.alias("not_covered"),
            )
            for name, m in modules.items()
        ]
    )
    return rows.groupBy("module").agg(*profile_measures(with_covered))


def profile_sentences(profile: DataFrame) -> DataFrame:
    """The profile as one sentence per module (H9)."""
    begin, after_module, after_facilities, after_records, end = map(F.lit, fixed.PROFILE_SENTENCE)
    numbers = (F.col(c).cast("string") for c in ("facilities", "records", "percent_not_covered"))
    facilities, records, percent = numbers
    text = F.concat(
        begin, "module", after_module, facilities, after_facilities, records, after_records, percent, end
    )
    return profile.select("module", text.alias("text"))


def persons_by_module(modules: dict[str, Module]) -> DataFrame:
    """Distinct (person, module) pairs without blank keys."""
    keys = stack(
        *[
            m.records.select(
                F.col(m.person).cast("string").alias("person"), F.lit(name).alias("module")
            )
            for name, m in modules.items()
        ]
    )
    return keys.filter(F.col("person").isNotNull() & (F.col("person") != "")).distinct()


def unique_persons(modules: dict[str, Module], label: str = fixed.TOTAL) -> DataFrame:
    """Distinct persons per module and over all modules.

    Persons are reduced to one row with the set of their modules first, so the
    second step counts rows.
    """
    pairs = persons_by_module(modules)
    per_person = pairs.groupBy("person").agg(F.collect_set("module").alias("modules"))
    labels = F.explode(F.concat(F.array(F.lit(label)), F.col("modules"))).alias("module")
    return per_person.select(labels).groupBy("module").agg(F.count(F.lit(1)).alias("persons"))


def exchange_report(
    modules: dict[str, Module], lines: list[tuple[str, str, str | None]]
) -> DataFrame:
    """Totals and covered shares as formatted lines in a fixed order.

    `lines`: label, kind and module. Kinds: "persons" (of a module, or of all
    when the module is None), "records" (likewise), "blank".
    """
    profile = module_profile(modules).select("module", "records", "covered")
    both = stack(profile, unique_persons(modules))
    cells: dict[str, Column] = {}
    for i, name in enumerate(modules):
        where = F.col("module") == name
        cells[f"r{i}"] = F.max(F.when(where, F.col("records")))
        cells[f"c{i}"] = F.max(F.when(where, F.col("covered")))
        cells[f"p{i}"] = F.max(F.when(where, F.col("persons")))
    cells["r"], cells["c"] = sum_or_zero("records"), sum_or_zero("covered")
    cells["p"] = F.max(F.when(F.col("module") == fixed.TOTAL, F.col("persons")))
    one_row = both.agg(*[c.alias(n) for n, c in cells.items()])
    number = {m: str(i) for i, m in enumerate(modules)} | {None: ""}
    rows = []
    for position, (label, kind, module) in enumerate(lines, 1):
        total = covered = F.lit("")
        if kind == "persons":
            total, covered = thousands(f"p{number[module]}"), F.lit("---")
        elif kind == "records":
            records = f"r{number[module]}"
            total = thousands(records)
            covered = count_with_percent(f"c{number[module]}", records)
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(label).alias("label"),
                total.alias("total"),
                covered.alias("covered"),
            )
        )
    return one_row.select(F.inline(F.array(*rows)))


def mode_per_group(
    df: DataFrame, group: list[str], values: list[str], name: str = "n"
) -> DataFrame:
    """The most frequent value combination per group, ties by value order."""
    counts = df.groupBy(*group, *values).agg(F.count(F.lit(1)).alias(name))
    return top_per_key(counts, group, [f"-{name}", *values], 1, "_rank").drop("_rank")


def modal_positions(
    payroll: DataFrame, facilities: DataFrame, roles: DataFrame, positions: DataFrame
) -> dict[str, DataFrame]:
    """Most frequent position of each role with catalogue names.

    payroll: `facility, role, position`; facilities: `facility, category`;
    roles: `role, new_role, role_name`; positions: `position, position_name`.
    """
    code = extract(F.upper(F.trim("facility")), fixed.FACILITY_PATTERN)
    payroll = payroll.withColumn("facility", code)
    known = lookup(payroll, facilities, ["facility"])
    mode = mode_per_group(known, ["role"], ["position", "category"])
    mode = lookup(mode, roles, ["role"])
    mode = lookup(mode, positions, ["position"])
    mode = mode.select(
        "category", "new_role", "role_name", "position", "position_name", "n"
    ).orderBy(*nulls_last("category", "new_role", "position"))
    outside = unmatched(payroll, facilities, ["facility"]).select("facility").distinct()
    return {"modes": mode, "facilities_outside": outside}


def with_national_rows(
    df: DataFrame, by: list[str], facility: str, label: str = fixed.NATIONAL
) -> DataFrame:
    """National sums of every numeric column added to an indicator table."""
    national = sum_numeric(df, by, **{facility: label}).select(*df.columns)
    return stack_same(df, national).filter(F.col(facility).isNotNull())


def goals_with_totals(
    goals: DataFrame,
    state: str,
    facility: str,
    labels: list[str],
    status: str,
    unit: str,
    amounts: list[str],
) -> DataFrame:
    """Goals of facilities, of the nation and of the states in one table.

    National sums are NULL when a goal is missing; state sums skip missing ones.
    """
    nation = goals.agg(*[strict_sum(a).alias(a) for a in amounts]).withColumns(
        {c: F.lit(fixed.NATIONAL) for c in (state, facility, *labels)}
        | {status: F.lit(fixed.IN_OPERATION), unit: F.lit(fixed.NATIONAL_NAME)}
    )
    states = goals.groupBy(state).agg(*[sum_or_zero(a).alias(a) for a in amounts])
    states = states.withColumns(
        {c: F.col(state) for c in (facility, *labels, unit)}
        | {status: F.lit(fixed.IN_OPERATION)}
    )
    order = goals.columns
    return stack_same(goals, nation.select(*order), states.select(*order)).filter(
        F.col(state).isNotNull()
    )


def label_dictionary(facilities: DataFrame, facility: str, unit: str) -> DataFrame:
    """Value and shown text of every facility, the nation first."""
    text = F.concat_ws(" - ", facility, unit)
    shown = facilities.select(F.col(facility).alias("value"), text.alias("label"))
    first = (fixed.NATIONAL, f"{fixed.NATIONAL} - {fixed.NATIONAL_NAME}")
    nation = literal_table(facilities.sparkSession, [first], "value string, label string")
    return nation.unionByName(shown)


def goals_outside_catalogue(goals: DataFrame, facilities: DataFrame, facility: str) -> DataFrame:
    """Goal rows whose facility the catalogue does not have."""
    return unmatched(goals, facilities, [facility])
