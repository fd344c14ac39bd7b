"""Teams formed from people of given positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.nulls import distinct_with_null
from recordops.functions.text import recode
from recordops.operators.aggregates import pivot_values, row_minimum
from recordops.operators.joins import lookup, matched, natural_join


def _names_where(conditions: dict[str, Column]) -> Column:
    """Names whose condition holds, joined; '' when none or all do."""
    chosen = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))
    text = F.array_join(chosen, ", ")
    return F.when(F.size(chosen) < len(conditions), text).otherwise(F.lit(""))


def form_teams(
    people: DataFrame,
    group: list[str],
    position: str,
    person: str,
    positions: list[str] = tuple(fixed.POSITIONS),
    needed: list[str] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Complete teams per group.

    One column per position with its people (distinct ones unless `distinct` is
    off), `teams` as the smallest of the `needed` positions, `incomplete` when
    people are left over, `roles_without_surplus` (positions with nobody left
    once teams are formed; '' when none or all) and `roles_short` (positions with
    nobody at all).
    """
    positions = list(positions)
    needed = positions if needed is None else needed
    measure = distinct_with_null(person) if distinct else F.count(F.lit(1))
    known = people.filter(F.col(position).isin(positions))
    counts = known.groupBy(*group, position).agg(measure.alias("_people"))
    wide = pivot_values(counts, group, position, positions, F.sum("_people"))
    wide = wide.withColumn("teams", row_minimum([f"`{p}`" for p in needed]))
    left = {p: F.col(f"`{p}`") - F.col("teams") for p in positions}
    surplus = sum(left.values(), F.lit(0))
    return wide.withColumns(
        {
            "incomplete": (surplus > 0).cast("int"),
            "roles_without_surplus": _names_where({p: c < 1 for p, c in left.items()}),
            "roles_short": F.array_join(
                F.array_compact(
                    F.array(*[F.when(F.col(f"`{p}`") < 1, F.lit(p)) for p in positions])
                ),
                ", ",
            ),
        }
    )


def complete_members(
    people: DataFrame,
    group: list[str],
    position: str,
    person: str,
    positions: list[str] = tuple(fixed.POSITIONS),
    needed: list[str] | None = None,
) -> DataFrame:
    """The people of the groups that form at least one complete team."""
    formed = form_teams(people, group, position, person, positions, needed)
    complete = formed.filter(F.col("teams") >= 1).select(*group)
    return matched(people, complete, group, unique=True)


def attach_teams(people: DataFrame, teams: DataFrame, group: list[str]) -> DataFrame:
    """Team results put on every person, 0 and '' for groups without."""
    flag = (F.col("teams") >= 1).cast("int").alias("forms_team")
    result = teams.select(*group, "teams", "incomplete", "roles_without_surplus", flag)
    out = lookup(people, result, group)
    return out.fillna(0, subset=["teams", "incomplete", "forms_team"]).fillna(
        "", subset=["roles_without_surplus"]
    )


def missing_teams(teams: DataFrame, sites: DataFrame, group: list[str]) -> DataFrame:
    """Groups that form no team, with their sites."""
    none = teams.withColumn(
        "forms_team", F.when(F.col("teams") >= 1, fixed.FORMS_TEAM).otherwise(fixed.FORMS_NO_TEAM)
    ).filter(F.col("forms_team") == fixed.FORMS_NO_TEAM)
    return lookup(none, sites.distinct(), group).distinct()


def state_name(c, names: dict = fixed.STATE_NAMES) -> Column:
    """One spelling of a state's name."""
    known = F.when(F.col(c).isin(list(names)), recode(c, names))
    return known.otherwise(F.initcap(F.col(c)))


def team_gap(
    teams: DataFrame, anchors: DataFrame, state: str, anchor_state: str, cluster: str
) -> DataFrame:
    """Teams formed against clusters to serve, per state."""
    clusters = anchors.groupBy(anchor_state).agg(distinct_with_null(cluster).alias("clusters"))
    named = clusters.select(state_name(anchor_state).alias(state), "clusters")
    out = natural_join(teams, named)
    return out.withColumn("teams_missing", F.col("clusters") - F.col("teams"))
