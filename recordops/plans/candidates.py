"""Candidates: duplicates, preparation, slots and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.functions.codes import clean_key, position_of_role, role_code, status_priority
from recordops.functions.nulls import distinct_with_null, member, nulls_last, strict_if
from recordops.functions.text import recode
from recordops.operators.aggregates import count_of_counts, frequency, ordered_text
from recordops.operators.columns import apply_each
from recordops.operators.combine import stack
from recordops.operators.joins import (
    cross_with,
    flag_matches,
    full_join,
    lookup,
    matched,
    unmatched,
    unmatched_on_shared,
)
from recordops.operators.ranking import first_per_key, row_ids, top_per_key
from recordops.plans.person_keys import recover_names, split_validated, validate_keys
from recordops.plans.teams import form_teams
from recordops.sources.writers import written, written_parts


def dedupe_by_status(
    df: DataFrame,
    keys: list[str],
    link: str,
    status: DataFrame,
    original: DataFrame | None = None,
    original_keys: list | None = None,
    valid_sites: DataFrame | None = None,
    site: tuple[str, str] | None = None,
    not_anchor: str = fixed.NOT_ANCHOR_REASON,
) -> dict[str, DataFrame]:
    """Repeated records reduced to those with a working link.

    `status` has one row per link with a true/false column `works`. Records that
    occur once stay. Of a repeated record the rows with its first working link
    stay: none if no link works, several if they share it. With `original`, the
    rows of that table that are missing from the result are listed as well, with
    the reason. The first working link of a record is found in the aggregate
    that counts its rows, and all rows are stored once, by part.
    """
    works = flag_matches(df.select(*keys, link), status.filter("works"), [link], "_works")
    first = F.min(F.when(F.col("_works"), F.struct(F.col(link).isNull().alias("blank"), F.col(link).alias("link"))))
    groups = works.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
    groups = row_ids(groups.filter("_n > 1"), keys, "duplicates").drop("_n")
    flagged = lookup(df, groups, keys)
    good = F.col("_first").isNotNull() & F.col(link).eqNullSafe(F.col("_first.link"))
    part = F.when(F.col("duplicates").isNull() | good, "kept").otherwise("broken")
    flagged = flagged.withColumns({"duplicates": F.coalesce("duplicates", F.lit(0)), "_part": part})
    stored = written_parts(flagged.drop("_first"), ["_part"], "deduped")
    kept = stored.filter("_part = 'kept'").drop("_part")
    broken = stored.filter("_part = 'broken'").drop("_part")
    broken = broken.withColumn("reason", F.lit(fixed.BROKEN_LINK_REASON))
    if original is None:
        return {"kept": kept, "removed": broken}
    gone = unmatched(original, kept, original_keys)
    gone = flag_matches(gone, valid_sites, [site], "_site")
    reason = F.when(~F.col("_site"), not_anchor).otherwise(fixed.LATER_FILTER_REASON)
    gone = gone.withColumn("reason", reason).drop("_site")
    return {"kept": kept, "removed": stack(gone, broken)}


def prepare_candidates(
    register: DataFrame,
    placed: DataFrame,
    anchors: DataFrame,
    roles: DataFrame,
    link_status: DataFrame,
    clusters: DataFrame,
    previous_names: DataFrame,
    looked_up: DataFrame,
    valid_roles: list[str] = tuple(fixed.VALID_ROLES),
    facility_remap: dict[str, str] = fixed.FACILITY_REMAP,
    key_pattern: str = fixed.PERSON_KEY_PATTERN,
    key_length: int = fixed.PERSON_KEY_LENGTH,
) -> dict[str, DataFrame]:
    """Candidate base from a register of applications (I16).

    register: `state, facility, shift, phase, link, key, role_code, role_text,
    status`; placed: `key`; anchors: `facility`; roles: `role, role_name`;
    link_status: `link, works`; clusters: `facility, cluster, cluster_state,
    site_name`; previous_names: `key, name`; looked_up: see `recover_names`.
    """
    texts = [c for c, kind in register.dtypes if kind == "string" and c != "link"]
    df = apply_each(register, texts, lambda c: F.upper(F.trim(c)))
    df = df.withColumns(
        {"key_clean": clean_key("key"), "role": role_code("role_code", "role_text")}
    )
    placed = placed.select(clean_key("key").alias("key_clean"))
    df = unmatched(df, placed, ["key_clean"])
    df = flag_matches(df, anchors, ["facility"], "_anchor", null_safe=False)
    travelling = F.col("shift").rlike(fixed.TRAVELLING_SHIFT_PATTERN)
    df = df.filter(travelling | ((F.col("phase") == 3) & F.col("_anchor")))
    df = df.filter(member("role", valid_roles))
    df = df.filter(F.col("status").isNull() | (F.col("status") == fixed.APPROVED))
    df = lookup(df, roles, ["role"])
    df = df.select(
        "state", "facility", "phase", "shift", "link", "key", "role_name", "role", "status"
    )
    df = first_per_key(df, [c for c in df.columns if c != "link"], ["link"])
    df = lookup(df, link_status, ["link"], one_row_by=["-works"])
    df = df.withColumns(
        {
            "_status": status_priority("status"),
            "_link": strict_if(F.col("works"), 1, 2),
        }
    )
    rest = ["link", "role", "shift", "phase", "state", "status"]
    df = first_per_key(df, ["key", "facility"], ["_status", "_link", *rest])
    df = df.drop("_status", "_link").withColumn("facility", recode("facility", facility_remap))
    outside = unmatched(df.select("facility").distinct(), clusters, ["facility"])
    df = lookup(df, clusters, ["facility"], one_row_by=["cluster"])
    df = df.filter(F.col("cluster").isNotNull())
    df = df.withColumn("cluster_state", F.coalesce("cluster_state", "state"))
    same = ["cluster_state", "facility", "site_name", "key", "role_name", "role", "status"]
    same.append("cluster")
    # One row per key and facility is left, so a group has at most the facilities that one was mapped to.
    df = df.withColumn("n_duplicates", F.count(F.lit(1)).over(Window.partitionBy(*same)))
    checked = validate_keys(df, "key", key_pattern, key_length)
    previous = previous_names.filter(F.col("name").isNotNull())
    previous = previous.select(clean_key("key").alias("key_clean"), "name")
    named = recover_names(checked, previous, looked_up)
    splits = split_validated(checked)
    return {
        "candidates": named["kept"],
        "no_name": named["no_name"],
        "lookup_counts": named["status_counts"],
        "invalid": splits["invalid"],
        "corrected": splits["corrected"],
        "facilities_outside": outside,
    }


def required_slots(
    clusters: DataFrame, required: list[tuple] = fixed.REQUIRED_POSITIONS
) -> DataFrame:
    """Every cluster with every required position.

    A position listed several times gets slots 1, 2, ..
    """
    rows, seen = [], {}
    for order, (position, role, title) in enumerate(required, 1):
        seen[position] = seen.get(position, 0) + 1
        rows.append(
            {
                "position": position,
                "required_role": role,
                "required_title": title,
                "slot": seen[position],
                "position_order": order,
            }
        )
    return cross_with(clusters, rows)


def prepare_clusters(
    layer: DataFrame, complete_teams: DataFrame, name: str = "cluster_name"
) -> DataFrame:
    """Clusters that still need people, one row each.

    layer: the names of clusters, such as `SITE_3`, and their descriptions;
    complete_teams: `cluster`. Names found among the complete teams, as they are
    written, go out, and so do missing and blank names. `anchor` is the name
    without its number, `cluster` the trimmed name, `cluster_order` its number
    (missing where it has none). Of several rows the first by anchor and
    descriptions stays.
    """
    descriptions = [c for c in layer.columns if c != name]
    waiting = layer.filter(F.col(name).isNotNull())
    waiting = unmatched(waiting, complete_teams.select("cluster"), [(name, "cluster")])
    cluster = F.trim(name)
    number = F.nullif(F.regexp_extract(cluster, fixed.CLUSTER_NUMBER, 0), F.lit(""))
    out = waiting.select(
        cluster.alias("cluster"),
        F.regexp_replace(name, fixed.CLUSTER_SUFFIX, "").alias("anchor"),
        number.try_cast("int").alias("cluster_order"),
        *descriptions,
    )
    return first_per_key(out.filter(F.col("cluster") != ""), ["cluster"], ["anchor", *descriptions])


def rank_candidates(
    candidates: DataFrame, slots: int, second_choice: list[str] = fixed.SECOND_CHOICE_ROLES
) -> DataFrame:
    """The best candidates of each cluster and position, as many as slots.

    Order: approved first, then the preferred role code, then name and key.
    Candidates: `cluster, position, role, status, name, key`.
    """
    ranked = candidates.withColumns(
        {
            "_status": status_priority("status"),
            "_role": F.when(F.col("role").isin(list(second_choice)), 2).otherwise(1),
        }
    )
    order = ["_status", "_role", "name", "key", "role", "status"]
    top = top_per_key(ranked, ["cluster", "position"], order, slots, "slot")
    return top.drop("_status", "_role")


def allocate_slots(
    clusters: DataFrame,
    candidates: DataFrame,
    required: list[tuple] = fixed.REQUIRED_POSITIONS,
    second_choice: list[str] = fixed.SECOND_CHOICE_ROLES,
) -> dict[str, DataFrame]:
    """Required positions filled with ranked candidates.

    clusters: `cluster` and its descriptions, one row each. candidates:
    `cluster, position, role, status, name, key`, typed in any case and with
    blanks around; their `link` and `title` are kept where they have them, and
    the title of a slot is that of its person, the required one by default. One
    person may fill slots in several clusters; only the audit is per person. The
    slots are stored once, by whether they are filled; all outputs read them there.
    """
    texts = {"cluster": F.trim("cluster")} | {c: F.upper(F.trim(c)) for c in ("role", "status")}
    candidates = candidates.withColumns(texts)
    positions = [r[0] for r in required]
    per_position = max(positions.count(p) for p in positions)
    needs = required_slots(clusters, required)
    allowed = F.col("status").isNull() | F.col("status").isin("", fixed.APPROVED)
    usable = candidates.filter(allowed & F.col("position").isNotNull())
    usable = usable.filter(~F.col("cluster").isin("", fixed.NO_CLUSTER))
    best = rank_candidates(usable, per_position, second_choice)
    kept = [c for c in ("link", "title") if c in candidates.columns]
    best = best.select("cluster", "position", "slot", "role", "status", "name", "key", *kept)
    filled = lookup(needs, best, ["cluster", "position", "slot"])
    taken = F.col("key").isNotNull()
    filled = filled.withColumns(
        {
            "filled": taken,
            "candidate_source": F.when(taken, fixed.CANDIDATE_SOURCE),
            "occupation": F.when(taken, fixed.SLOT_FILLED).otherwise(fixed.SLOT_VACANT),
            "final_role": F.coalesce("role", "required_role"),
            "final_title": F.coalesce(*[c for c in kept if c == "title"], "required_title"),
        }
    )
    part = F.when(taken, "filled").otherwise("vacant")
    filled = written_parts(filled.withColumn("_part", part), ["_part"], "slots")
    assigned = filled.filter("_part = 'filled'").select("key", "cluster", "position")
    filled = filled.drop("_part")
    assigned = first_per_key(assigned, ["key"], ["cluster", "position"]).withColumnsRenamed(
        {"cluster": "assigned_cluster", "position": "assigned_position"}
    )
    audit = lookup(usable, assigned, ["key"])
    placed = F.col("assigned_cluster").isNotNull()
    audit = audit.withColumns(
        {
            "result": F.when(placed, fixed.PLACED).otherwise(fixed.NOT_PLACED),
            "reason": F.when(placed, fixed.PLACED_REASON).otherwise(fixed.NOT_PLACED_REASON),
        }
    )
    left_over = first_per_key(
        audit.filter(~placed), ["key"], ["cluster", "position", "role", "status", "name"]
    )
    descriptions = [c for c in clusters.columns if c != "cluster"]
    by_cluster = filled.groupBy("cluster", *descriptions).agg(
        F.count(F.lit(1)).alias("required"),
        F.count_if(F.col("filled")).alias("filled"),
        F.count_if(~F.col("filled")).alias("vacant"),
        ordered_text("required_title", "position_order", ~F.col("filled")).alias("vacant_titles"),
    )
    return {
        "slots": filled,
        "summary": filled.agg(
            F.count(F.lit(1)).alias("total"),
            distinct_with_null("cluster").alias("clusters"),
            F.count_if(F.col("filled")).alias("filled"),
            F.count_if(~F.col("filled")).alias("vacant"),
        ),
        "by_position": frequency(filled, ["position", "occupation"]),
        "rows_per_cluster": count_of_counts(filled, ["cluster"]),
        "by_cluster": by_cluster,
        "incomplete_clusters": by_cluster.filter(F.col("vacant") > 0),
        "unassigned": left_over,
        "audit": audit,
        "audit_counts": frequency(audit, ["result", "position"]),
        "unassigned_counts": frequency(left_over, ["position"]),
        "clusters_without_slots": unmatched(clusters, filled, ["cluster"]),
        "unknown_clusters": unmatched(usable.select("cluster").distinct(), clusters, ["cluster"]),
    }


def candidates_by_position(candidates: DataFrame) -> DataFrame:
    """Candidates with their team position, those without one left out."""
    out = candidates.withColumn("position", position_of_role("role"))
    return out.filter(F.col("position").isNotNull())


def candidate_teams(
    candidates: DataFrame,
    complete_teams: DataFrame | None = None,
    group: tuple[str, ...] = ("cluster_state", "cluster"),
    positions: list[str] = tuple(fixed.POSITIONS),
    needed: list[str] = tuple(fixed.TEAM_OF_CANDIDATES),
) -> dict[str, DataFrame]:
    """Candidates with the teams their cluster can form, and all teams (I16).

    Rows are counted, not persons. With `complete_teams`, candidates found there
    on all shared columns are left out after the teams are counted.
    """
    group = list(group)
    formed = form_teams(
        candidates, group, "position", "key", list(positions), list(needed), distinct=False
    ).select(*group, "teams")
    formed = written(formed, "teams")  # one row per group, read for the base and for the total
    base = lookup(candidates, formed, group)
    if complete_teams is not None:
        base = unmatched_on_shared(base, complete_teams)
    total = formed.agg(F.coalesce(F.sum("teams"), F.lit(0)).alias("teams"))
    return {"base": base, "total": total}


def without_placed(
    candidates: DataFrame, placed: DataFrame, teams: DataFrame | None = None
) -> DataFrame:
    """Candidates not yet placed, by person, nor in the team of their cluster.

    placed: `key`; teams: `cluster, key`. Keys are cleaned on both sides.
    """
    out = candidates.withColumn("key", clean_key("key"))
    out = unmatched(out, placed.select(clean_key("key").alias("key")), ["key"])
    if teams is None:
        return out
    members = teams.select("cluster", clean_key("key").alias("key"))
    return unmatched(out, members, ["cluster", "key"])


def with_complete_teams(
    slots: DataFrame, complete_teams: DataFrame, clusters: DataFrame, keys: list[str]
) -> dict[str, DataFrame]:
    """Slots and the members of complete teams in one table.

    Slots whose person already is in the cluster's complete team are dropped
    first. `clusters_left_out` are those found in neither table. The members, who
    are needed twice, and the result are stored once.
    """
    complete_teams = written(complete_teams, "members")
    people = complete_teams.withColumn("_key", clean_key("key"))
    open_slots = unmatched(slots.withColumn("_key", clean_key("key")), people, ["cluster", "_key"])
    everything = written(full_join(open_slots.drop("_key"), complete_teams, keys), "slots-and-teams")
    return {"all": everything, "clusters_left_out": unmatched(clusters, everything, ["cluster"])}


def coverage(
    universe: DataFrame, complete: DataFrame, incomplete: DataFrame, by: str, cluster: str
) -> DataFrame:
    """Complete and incomplete clusters per entity, with their shares."""
    out = universe.select(by, cluster).distinct()
    out = flag_matches(out, incomplete, [cluster], "_incomplete")
    out = flag_matches(out, complete, [cluster], "_complete")
    totals = out.groupBy(by).agg(
        F.count(F.lit(1)).alias("clusters"),
        F.count_if(F.col("_complete")).alias("complete"),
        F.count_if(F.col("_incomplete")).alias("incomplete"),
    )
    totals = totals.withColumns(
        {
            "share_complete": F.col("complete") / F.col("clusters"),
            "share_incomplete": F.col("incomplete") / F.col("clusters"),
        }
    )
    return totals.orderBy(*nulls_last("-share_incomplete", by))
