"""Hot keys, ranges and intervals: exact results and plans that hold."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from recordops.functions.nulls import any_true
from recordops.operators import joins, ranking
from recordops.session import tune

SMALL_PARTS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def small_parts(spark):
    tune(spark)
    for k, v in SMALL_PARTS.items():
        spark.conf.set(k, v)
    yield
    for k in SMALL_PARTS:
        spark.conf.unset(k)


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_table(spark, n=900_000):
    """A third of all rows has the key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_000)
    text = F.sha1(F.col("id").cast("string"))
    return spark.range(n, numPartitions=16).select(key.alias("k"), text.alias("v"), "id")


def final_plan(df) -> str:
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_key_is_split_in_joins(spark, small_parts):
    df = hot_table(spark)
    right = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    cases = {
        "attach": ranking.attach_group(df, ["k"], n=F.count(F.lit(1))),
        "keep": ranking.keep_groups(df, ["k"], F.count(F.lit(1)) > 10),
        "unmatched": joins.unmatched(df, right.filter("k > 9"), ["k"]),
        "matched": joins.matched(df, right, ["k"], null_safe=False),
        "lookup": joins.lookup(df, right, ["k"]),
        "one row": joins.lookup(df, right, ["k"], one_row_by=["w"]),
        "flag": joins.flag_matches(df, right, ["k"], "f"),
    }
    for name, case in cases.items():
        assert "skew=true" in final_plan(case), name


def test_top_rows_are_limited_before_the_shuffle(spark):
    plan = final_plan(ranking.top_per_key(hot_table(spark, 9000), ["k"], ["v", "id"], 2))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in after and "Partial" in after


def test_row_ids_over_several_ranges(spark, many_ranges):
    df = hot_table(spark, 5000).withColumn("w", F.when(F.col("id") % 7 > 0, F.col("v")))
    out = ranking.row_ids(df, ["-k", "w", "id"], "n").select("k", "w", "id", "n").collect()
    expected = sorted(out, key=lambda r: (-r["k"], r["w"] is None, r["w"] or "", r["id"]))
    assert [r["n"] for r in expected] == list(range(1, 5001))


@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_ranks_of_a_hot_group_over_several_ranges(spark, many_ranges, keys):
    df = hot_table(spark, 6000).withColumn("j", F.when(F.col("id") % 2 == 0, "a"))
    out = ranking.rank_within(df, keys, ["v", "id"]).collect()
    groups = {}
    for r in sorted(out, key=lambda r: (r["v"], r["id"])):
        groups.setdefault(tuple(r[k] for k in keys), []).append(r["rank"])
    assert all(ranks == list(range(1, len(ranks) + 1)) for ranks in groups.values())
    assert max(map(len, groups.values())) >= 1000 and len(out) == 6000


def test_keep_groups_equals_window(spark):
    df = hot_table(spark, 3000)
    kept = ranking.keep_groups(df, ["k"], any_true(F.col("v") < "1"))
    chosen = {r["k"] for r in df.filter("v < '1'").select("k").collect()}
    assert kept.count() == df.filter(F.col("k").isin(list(chosen))).count()


@pytest.mark.parametrize("seed", range(4))
def test_intervals_against_brute_force(spark, seed):
    rng = random.Random(seed)
    keys = [None, 0, 1, 2]
    stays = []
    for _ in range(60):
        start = rng.randint(-400, 20_000 if seed == 0 else 400)
        stays.append((rng.choice(keys), start, start + rng.choice([-1, 0, 1, 5, 59, 60, 61, 200])))
    stays += [(1, None, 5), (2, 5, None)]
    events = [(i, rng.choice(keys), rng.randint(-500, 900)) for i in range(400)]
    events.append((400, 0, None))
    date = F.date_from_unix_date
    iv = spark.createDataFrame(stays, "k int, s int, e int")
    iv = iv.select("k", date("s").alias("s"), date("e").alias("e"))
    ev = spark.createDataFrame(events, "i int, k int, d int").withColumn("d", date("d"))

    def inside(k, d):
        return d is not None and any(
            k == a and s is not None and e is not None and s <= d <= e for a, s, e in stays
        )

    covered = {r["i"] for r in joins.covered_by_interval(ev, iv, ["k"], "d", "s", "e").collect()}
    rest = joins.not_covered_by_interval(ev, iv, ["k"], "d", "s", "e").collect()
    assert covered == {i for i, k, d in events if inside(k, d)}
    assert {r["i"] for r in rest} | covered == set(range(401))
    assert len(rest) + len(covered) == 401


def test_intervals_of_a_key_become_few_rows(spark):
    days = spark.range(20_000).select(
        F.lit("hot").alias("k"),
        F.date_from_unix_date((F.col("id") % 300).cast("int")).alias("s"),
        F.date_from_unix_date((F.col("id") % 300 + F.col("id") % 50).cast("int")).alias("e"),
    )
    assert joins.covered_days(days, ["k"], "s", "e").count() == 5


def test_filters_and_columns_reach_the_scan(spark):
    import __spark_entry__ as entry

    plan = final_plan(entry.queries()["c5_semi_join"](spark, "/root/testdata/sf0.001"))
    assert "Not(EqualTo(o_orderstatus,P))" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


@pytest.mark.parametrize("name", ["c13_crossing", "i8_exchange_report", "i17_slots", "i2_lost_rows"])
def test_no_cartesian_product(spark, name):
    import __spark_entry__ as entry

    plan = final_plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize(
    "name, scans, shuffles",
    [
        ("a9_year_split", 2, 3),
        ("c4_full_join", 2, 2),
        ("i2_audit_by_joins", 5, 10),
        ("i4_match_tables", 6, 8),
        ("i13_removed_with_reason", 8, 20),
        ("i16_prepare_candidates", 6, 20),
        ("i17_with_complete_teams", 8, 17),
    ],
)
def test_sources_are_not_read_once_per_output(spark, no_broadcast, name, scans, shuffles):
    import __spark_entry__ as entry

    query = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= scans
    assert plan.count("Exchange hashpartitioning") <= shuffles


def test_dates_are_looked_up_by_key_and_part(spark, no_broadcast):
    """A hot key with stays over a century: a date meets the rows of its own part only."""
    days = F.pmod(F.xxhash64("id"), F.lit(36_500)).cast("int")
    stays = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.date_from_unix_date(days).alias("s"),
        F.date_from_unix_date(days + 2).alias("e"),
    )
    events = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 60).alias("k"),
        F.date_from_unix_date(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(36_500)).cast("int")).alias("d"),
    )
    rest = joins.not_covered_by_interval(events, stays, ["k"], "d", "s", "e")
    plan = final_plan(rest)
    join = next(line for line in plan.splitlines() if "Join [" in line and "LeftAnti" in line)
    assert "_part" in join.split("], [", 1)[1].split("], LeftAnti")[0]
    per_part = joins.covered_days(stays, ["k"], "s", "e").groupBy("k", "_part").count()
    assert per_part.agg(F.max("count")).first()[0] <= joins.LOOK_UP / joins.STRETCH
    covered = {(r["k"], r["d"]) for r in spark_days(stays).collect()}
    want = sum((r["k"], r["d"]) not in covered for r in events.collect())
    assert rest.count() == want


def spark_days(stays):
    return stays.select("k", F.explode(F.sequence("s", "e")).alias("d")).distinct()


@pytest.mark.parametrize("how", [{}, {"split_hot": True}, {"unique": True}])
def test_full_join_forms_agree(spark, how):
    left = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.0), (2, None, None), (3, "c", 4.0)], "k int, j string, x double")
    right = spark.createDataFrame([(1, "a", "p"), (None, "b", "q"), (2, None, "r"), (None, None, "s"), (9, "c", None)], "k int, j string, y string")
    got = sorted(map(tuple, joins.full_join(left, right, ["k", "j"], **how).select("k", "j", "x", "y").collect()), key=str)
    want = [(1, "a", 1.0, "p"), (None, "b", 2.0, "q"), (2, None, None, "r"), (3, "c", 4.0, None), (None, None, None, "s"), (9, "c", None, None)]
    assert got == sorted(want, key=str)


def test_full_join_keeps_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r")], "k int, y string")
    for how in ({}, {"split_hot": True}):
        got = joins.full_join(left, right, ["k"], **how).collect()
        assert sorted(map(tuple, got), key=str) == sorted([(1, x, y) for x in "ab" for y in "pq"] + [(2, "c", None), (3, None, "r")], key=str)


def test_ids_of_whole_rows_with_ties(spark, many_ranges):
    """Only order columns are put into ranges; rows that tie in them share the lowest id and stay single."""
    rows = [(i % 7, i // 14, f"v{i}") for i in range(280)]
    df = spark.createDataFrame(rows, "a int, b int, v string")
    out = ranking.row_ids(df, ["-a", "b"], "n").collect()
    assert len(out) == 280
    order = sorted((-a, b) for a, b, _ in rows)
    assert all(r["n"] == order.index((-r["a"], r["b"])) + 1 for r in out)
    assert ranking.row_ids(df.limit(0), ["a"], "n").count() == 0


def test_outputs_read_their_own_part(spark):
    from recordops.sources.writers import written_parts

    df = spark.range(90).select(F.col("id").alias("a"), F.concat(F.lit("p/"), F.col("id") % 3).alias("part"), F.lit(None).cast("string").alias("z"))
    stored = written_parts(df, ["part"], "thirds")
    assert stored.dtypes == df.dtypes
    one = stored.filter("part = 'p/1'")
    assert sorted(r["a"] for r in one.collect()) == list(range(1, 90, 3))
    assert "PartitionFilters: [isnotnull(part" in final_plan(one)
    assert written_parts(df.limit(0), ["part"], "none").count() == 0


def test_checkpoint_dir_wants_a_shared_folder():
    from types import SimpleNamespace

    from recordops.session import checkpoint_dir

    bare = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
        conf=SimpleNamespace(get=lambda name, default=None: default),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(bare)
