"""Pipelines: invariants and cases the given tables do not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recordops import fixed_values as fixed
from recordops.operators.trend import local_regression
from recordops.plans import candidates, coordinates, person_keys, reports, series, supplements, teams

PLACES = [
    (1, "16.5", "-92.5", "numeric_valid"),
    (2, "16.5", "92.5", "numeric_valid"),
    (3, "-92.5", "-16.5", "numeric_review"),
    (4, "24.15034", "-10.56551", "numeric_valid"),
    (5, "15.60042", "-931443414", "numeric_valid"),
    (6, "164403", "-92.5 aprox", "text_valid"),
    (13, "16.5", "-92.5°", "text_review"),
    (7, "16.5", "110..26522", "text_valid"),
    (8, "x", "-92.4453267,13.92", "text_review"),
    (9, None, "-92.5", "text_review"),
    (10, "-100", "-100", None),
    (11, "16°30'", "92°30'W", "text_valid"),
    (12, "40.5", "-92", "numeric_review"),
]


@pytest.fixture(scope="module")
def places(spark):
    rows = [p[:3] for p in PLACES]
    return spark.createDataFrame(rows, "id int, lat string, lon string")


def test_coordinates_reach_the_expected_table(places):
    tables = coordinates.clean_coordinates(places, "lat", "lon")
    found = {n: {r["id"] for r in df.collect()} for n, df in tables.items()}
    for name in ("numeric_valid", "numeric_review", "text_valid", "text_review"):
        assert found[name] == {i for i, _, _, part in PLACES if part == name}, name
    assert found["final_valid"] == found["numeric_valid"] | found["text_valid"]
    assert not found["final_review"]
    fixed_lon = {r["id"]: r["lon_num"] for r in tables["final_valid"].collect()}
    assert (fixed_lon[4], fixed_lon[5], fixed_lon[7]) == (-110.56551, -93.1443414, -110.26522)


def test_audit_accounts_for_every_row(places):
    audit = coordinates.coordinate_audit(places, "lat", "lon")
    funnel = {r["stage"]: r["records"] for r in audit["funnel"].collect()}
    assert funnel["Base original"] == len(PLACES)
    assert funnel["Final válido"] + funnel["Perdidos"] == len(PLACES)
    lost = {r["id"]: r["cause"] for r in audit["lost"].collect()}
    assert lost[10] == fixed.CAUSE_LOST and lost[9] == fixed.CAUSE_LOST
    assert lost[12] == fixed.CAUSE_LAT_RANGE
    # The same account made by joins with the review tables.
    parts = coordinates.clean_coordinates(places, "lat", "lon", review_missing_text=False)
    reviews = [parts[n].select("id", "cause") for n in ("numeric_review", "text_review", "final_review")]
    joined = coordinates.audit_losses(places, parts["final_valid"], reviews, "id", "cause")
    assert {r["id"]: r["cause"] for r in joined["lost"].collect()} == lost


def test_swap_before_the_check_rescues_reversed_text(places):
    plain = coordinates.clean_coordinates(places, "lat", "lon", known_fixes=False)
    swapped = coordinates.clean_coordinates(
        places, "lat", "lon", known_fixes=False, swap_first=True,
        bounds=coordinates.Bounds((13, 33), (-119, -86)),
    )
    assert 8 not in {r["id"] for r in plain["final_valid"].collect()}
    row = swapped["final_valid"].filter("id = 8").first()
    assert (row["lat_num"], row["lon_num"]) == (13.92, -92.4453267)


KEYS = [
    ("ABCD010203HXXXXX01", fixed.KEY_UNCHANGED),
    (" 'abcd010203hxxxxx01", fixed.KEY_CORRECTED),
    ("ABCD010203HXXXXX0", fixed.KEY_BAD_LENGTH),
    ("ABCD010203ZXXXXX01", fixed.KEY_BAD_FORMAT),
    ("  ' ", fixed.KEY_BLANK),
    (None, fixed.KEY_BLANK),
]


def test_key_statuses(spark):
    df = spark.createDataFrame([(k,) for k, _ in KEYS], "key string")
    out = person_keys.validate_keys(df, "key").collect()
    assert {r["key"]: r["key_status"] for r in out} == dict(KEYS)


def test_register_match(spark):
    register = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", None), (None, "s3")], "curp string, estado string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "curp string")
    found = person_keys.match_register(register, keys, "curp", "estado")
    assert tuple(found["summary"].first()) == (5, 1, 2, 3)
    assert {r["curp"] for r in found["never_seen"].collect()} == {"c"}
    assert found["repeated"].count() == 2
    assert found["all"].count() == found["matched"].count() + found["unmatched"].count()


def test_names_are_recovered_in_order(spark):
    people = spark.createDataFrame([("ABCD01020%dHXXXXX01" % i,) for i in range(4)] + [("bad",)], "key string")
    checked = person_keys.validate_keys(people, "key")
    key = "ABCD01020%dHXXXXX01"
    previous = spark.createDataFrame([(key % 0, "Ana"), (key % 0, "Zoe"), (key % 2, "")], "key_clean string, name string")
    looked = spark.createDataFrame(
        [(key % 1, "Eva", "Luz", None), (key % 0, "No", None, None), (key % 2, "Sol", None, None)],
        "key_clean string, first_names string, surname_1 string, surname_2 string",
    )
    out = person_keys.recover_names(checked, previous, looked)
    names = {r["key"]: (r["name"], r["lookup_status"]) for r in out["kept"].collect()}
    assert names[key % 0] == ("Ana", fixed.NAME_FROM_PREVIOUS)
    assert names[key % 1] == ("Eva Luz", fixed.NAME_FROM_LOOKUP)
    assert names[key % 2] == ("", fixed.NAME_FROM_LOOKUP)
    assert names["bad"] == (None, fixed.KEY_BAD_LENGTH)
    assert [r["key"] for r in out["no_name"].collect()] == [key % 3]
    assert out["kept"].count() + out["no_name"].count() == 5


def test_interval_supplement(spark):
    base = spark.createDataFrame([("p", "2026-01-01", "2026-01-05", None), ("q", "0203-03-08", "2026-03-08", "2026-03-09")], "k string, a string, b string, i string")
    late = spark.createDataFrame(
        [("p", "2026-01-05", None), ("p", "2026-01-06", None), ("p", "2026-01-07", "cancelled"), (" ", "2026-01-09", None), ("z", " ", None), ("z", "2025-01-01", None)],
        "k string, d string, why string",
    )
    late = supplements.usable_late_rows(late, "k", "d", "why", 2026)
    aligned = {"k": F.col("k"), "a": F.col("d"), "b": F.col("d"), "i": F.lit(None).cast("string")}
    both = supplements.supplement_by_interval(base, late, ["k"], "d", "a", "b", aligned, ("base", "late"))
    done = supplements.settle_dates(both, ["a", "b", "i"], "i", "b").orderBy("a").collect()
    assert [(r["k"], str(r["a"]), str(r["i"]), r["source"]) for r in done] == [
        ("p", "2026-01-01", "2026-01-05", "base"),
        ("p", "2026-01-06", "2026-01-06", "late"),
        ("q", "2026-03-08", "2026-03-09", "base"),
    ]


def test_key_supplement_adds_up(spark):
    base = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    late = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    both = supplements.supplement_by_keys(base, late, ["k"], ("base", "late"))
    assert tuple(supplements.before_and_added(both, ("base", "late")).first()) == (2, 2, 4)
    shared = supplements.supplement_on_shared(base, late.withColumn("extra", F.lit(1)), ["k"], ("base", "late"))
    assert shared.columns == ["k", "v", "source"]
    assert tuple(supplements.before_and_added(shared, ("base", "late")).first()) == (2, 1, 3)


def test_base_rows_that_do_not_count_as_present(spark):
    base = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    late = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    present = F.col("v").isNotNull()
    both = supplements.supplement_by_keys(base, late, ["k"], ("base", "late"), present=present)
    assert {tuple(r) for r in both.collect()} == {(1, "a", "base"), (2, None, "base"), (2, "y", "late"), (None, "z", "late")}


def people(spark, rows):
    return spark.createDataFrame(rows, "g string, position string, person string")


def test_teams(spark):
    counts = {"Anestesiologia": 2, "Cirugia": 1, "Medicina General": 1, "Enfermeria quirurgica": 3, "Chofer": 1}
    rows = [("one", p, f"{p}{i}") for p, n in counts.items() for i in range(n)]
    rows += [("one", "Chofer", "Chofer0"), ("none", "Cirugia", "c"), ("one", "Otro", "o")]
    rows += [("even", p, p) for p in counts]
    formed = teams.form_teams(people(spark, rows), ["g"], "position", "person")
    found = {r["g"]: r for r in formed.collect()}
    assert found["one"]["teams"] == 1 and found["one"]["incomplete"] == 1
    assert found["one"]["roles_without_surplus"] == "Cirugia, Medicina General, Chofer"
    assert (found["even"]["roles_without_surplus"], found["even"]["incomplete"]) == ("", 0)
    assert found["none"]["teams"] == 0
    assert found["none"]["roles_short"].split(", ") == [p for p in fixed.POSITIONS if p != "Cirugia"]
    attached = teams.attach_teams(people(spark, [*rows, ("far", "Cirugia", "f")]), formed.filter("g <> 'none'"), ["g"])
    far = attached.filter("g = 'far'").first()
    assert (far["teams"], far["forms_team"], far["roles_without_surplus"]) == (0, 0, "")
    by_rows = teams.form_teams(people(spark, rows), ["g"], "position", "person", distinct=False)
    assert {r["g"]: r["Chofer"] for r in by_rows.collect()}["one"] == 2


def test_state_names(spark):
    df = spark.createDataFrame([("MEXICO",), ("SAN LUIS POTOSI",), (None,)], "s string")
    names = [r[0] for r in df.select(teams.state_name("s")).collect()]
    assert names == ["Estado de Mexico", "San Luis Potosi", None]


def test_link_based_removal(spark):
    records = spark.createDataFrame(
        [("a", "l1", 1), ("a", "l2", 2), ("a", "l2", 3), ("b", "l3", 4), ("b", "l3", 5), ("c", "l9", 6)],
        "k string, link string, v int",
    )
    status = spark.createDataFrame([("l1", False), ("l2", True), ("l3", False)], "link string, works boolean")
    out = candidates.dedupe_by_status(records, ["k"], "link", status)
    assert sorted(r["v"] for r in out["kept"].collect()) == [2, 3, 6]
    assert sorted(r["v"] for r in out["removed"].collect()) == [1, 4, 5]
    original = records.unionByName(spark.createDataFrame([("d", "l1", 7)], records.schema))
    sites = spark.createDataFrame([("b",)], "site string")
    out = candidates.dedupe_by_status(records, ["k"], "link", status, original, ["k"], sites, ("k", "site"))
    reasons = {(r["v"], r["reason"]) for r in out["removed"].collect()}
    assert reasons == {
        (1, fixed.BROKEN_LINK_REASON), (4, fixed.BROKEN_LINK_REASON), (5, fixed.BROKEN_LINK_REASON),
        (4, fixed.LATER_FILTER_REASON), (5, fixed.LATER_FILTER_REASON), (7, fixed.NOT_ANCHOR_REASON),
    }


def test_slots(spark):
    clusters = spark.createDataFrame([("c1", "s1"), ("c2", "s2")], "cluster string, site string")
    rows = [
        ("c1", "ME002", None, "Beto", "b"), ("c1", "ME002", "APROBADO", "Zoe", "z"),
        ("c1", "EN002", "APROBADO", "Ana", "a"), ("c1", "EN005", "APROBADO", "Eva", "e"),
        ("c2", "ME002", "APROBADO", "Zoe", "z"), ("c2", "MG001", "RECHAZADO", "Leo", "l"),
        ("c3", "MG001", None, "Ivo", "i"), ("", "MG001", None, "Una", "u"), ("c1", "XX", None, "Ada", "d"),
    ]
    people = spark.createDataFrame(rows, "cluster string, role string, status string, name string, key string")
    out = candidates.allocate_slots(clusters, candidates.candidates_by_position(people))
    filled = {(r["cluster"], r["position"]): r["key"] for r in out["slots"].filter("filled").collect()}
    assert filled == {("c1", "Cirugia"): "z", ("c1", "Enfermeria quirurgica"): "e", ("c2", "Cirugia"): "z"}
    summary = out["summary"].first()
    assert tuple(summary) == (10, 2, 3, 7)
    assert summary["filled"] + summary["vacant"] == summary["total"]
    assert {r["key"] for r in out["unassigned"].collect()} == {"a", "b", "i"}
    assert [r["cluster"] for r in out["unknown_clusters"].collect()] == ["c3"]
    vacant = {r["cluster"]: r["vacant_titles"] for r in out["by_cluster"].collect()}
    assert vacant["c1"] == "Anestesiólogo, Chofer, Médico general"
    assert out["audit"].count() == 6


def test_slots_keep_link_and_title(spark):
    clusters = spark.createDataFrame([("c1",)], "cluster string")
    rows = [("c1", "ME002", "Ana", "a", "l1", "Cirujana"), ("c1", "ME001", "Eva", "e", None, None)]
    people = spark.createDataFrame(rows, "cluster string, role string, name string, key string, link string, title string")
    people = candidates.candidates_by_position(people.withColumn("status", F.lit(None).cast("string")))
    slots = candidates.allocate_slots(clusters, people)["slots"].collect()
    found = {r["position"]: (r["link"], r["final_title"]) for r in slots}
    assert found["Cirugia"] == ("l1", "Cirujana")
    assert found["Anestesiologia"] == (None, "Anestesiólogo") and found["Chofer"][1] == "Chofer"


def test_prepared_clusters(spark):
    rows = [("S_2", "b"), (" S_2", "a"), ("S_10 ", "a"), ("T", "a"), ("U_1", "a"), ("  ", "a"), (None, "a")]
    layer = spark.createDataFrame(rows, "cluster_name string, site string")
    done = spark.createDataFrame([("U_1",), (None,)], "cluster string")
    out = {tuple(r) for r in candidates.prepare_clusters(layer, done).collect()}
    assert out == {("S_2", " S", 2, "a"), ("S_10", "S_10 ", 10, "a"), ("T", "T", None, "a")}


def test_coverage(spark):
    universe = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "3"), ("y", "3")], "e string, c string")
    done = spark.createDataFrame([("1",)], "c string")
    todo = spark.createDataFrame([("2",), ("2",), ("3",)], "c string")
    out = candidates.coverage(universe, done, todo, "e", "c").collect()
    assert [tuple(r) for r in out] == [("y", 1, 0, 1, 0.0, 1.0), ("x", 2, 1, 1, 0.5, 0.5)]


def test_mode_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("r", "b"), ("r", "a"), ("r", None), ("q", None)], "g string, v string")
    out = {r["g"]: (r["v"], r["n"]) for r in reports.mode_per_group(df, ["g"], ["v"]).collect()}
    assert out == {"r": ("a", 1), "q": (None, 1)}


def test_goals(spark):
    goals = spark.createDataFrame(
        [("S1", "f1", "cat", "open", "u1", 5, None), ("S1", "f2", "cat", "open", "u2", 7, 2), (None, "f3", "cat", "open", "u3", 1, 1)],
        "state string, facility string, category string, status string, unit string, a int, b int",
    )
    out = reports.goals_with_totals(goals, "state", "facility", ["category"], "status", "unit", ["a", "b"])
    found = {r["facility"]: (r["unit"], r["a"], r["b"]) for r in out.collect()}
    assert found["NACIONAL"] == ("México", 13, None)
    assert found["S1"] == ("S1", 12, 2)
    assert "f3" not in found and len(found) == 4


def test_trend_of_a_parabola_is_the_parabola(spark):
    points = [("s", x, float(2 * x * x - 3 * x + 1)) for x in range(40)]
    df = spark.createDataFrame(points, "s string, x int, y double")
    out = local_regression(df, ["s"], "x", "y")
    assert all(r["trend"] == pytest.approx(r["y"], abs=1e-6) for r in out.collect())
    short = local_regression(df.filter("x < 3"), ["s"], "x", "y")
    assert {r["trend"] for r in short.collect()} == {None}


def test_monthly_series_leaves_out_unknown_months(spark):
    cube = spark.createDataFrame(
        [("a", 2025, "Julio", 10.0), ("b", 2025, "Julio", 1500.0), (None, 2025, "Julio", 5.0), ("a", 2025, "Unknown", 9.0), ("a", 2025, None, 9.0)],
        "clues string, anio int, mes string, n double",
    )
    members = spark.createDataFrame([("a",)], "clues string")
    out = series.monthly_series(cube, members, ("clues", "clues"), "anio", "mes", "n", ("in", "out"))
    found = {r["origin"]: (str(r["date"]), r["total"]) for r in out.collect()}
    assert found == {"in": ("2025-07-01", 10.0), "out": ("2025-07-01", 1505.0)}
    assert {r["label"] for r in series.month_labels(out).collect()} == {"0", "2"}
