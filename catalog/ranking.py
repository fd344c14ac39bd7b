"""E and F: windows, sorts and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Tables, query
from recordops.functions.nulls import any_true, nulls_last, value_order
from recordops.operators import ranking as ops
from recordops.operators.aggregates import frequency
from recordops.plans.reports import mode_per_group

def n_rows():
    return F.count(F.lit(1))


@query("""
    SELECT c_nationkey, c_mktsegment, c_custkey, CAST(slot AS INTEGER) AS slot FROM (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS slot
      FROM customer) WHERE slot <= 3
""")
def e1_ranked_slots(t: Tables):
    top = ops.top_per_key(
        t.customer, ["c_nationkey", "c_mktsegment"], ["-c_acctbal", "c_custkey"], 3, "slot"
    )
    return top.select("c_nationkey", "c_mktsegment", "c_custkey", "slot")


@query("""
    SELECT o_custkey, o_orderkey, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
""")
def e1_full_ranks(t: Tables):
    ranked = ops.rank_within(t.orders, ["o_custkey"], ["-o_totalprice", "o_orderkey"])
    return ranked.select("o_custkey", "o_orderkey", "rank")


@query("""
    SELECT p_brand, p_type, p_size, n FROM (SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY 1, 2, 3)
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type, p_size) = 1
""")
def e2_mode_per_group(t: Tables):
    return mode_per_group(t.part, ["p_brand"], ["p_type", "p_size"])


@query("""
    SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderpriority, '1-URGENT') NULLS LAST, o_orderdate, o_orderkey) = 1
""")
def e3_first_by_priorities(t: Tables):
    orders = t.orders.withColumn("_p", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    first = ops.first_per_key(orders, ["o_custkey"], ["_p", "o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_duplicates FROM lineitem
""")
def e4_group_size(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return ops.attach_group(rows, ["l_orderkey", "l_linenumber"], n_duplicates=n_rows())


@query("""
    WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
         ids AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id FROM g WHERE n > 1)
    SELECT l.l_orderkey, l.l_linenumber, coalesce(id, 0) AS duplicates, count(*) AS n_rows
    FROM lineitem l LEFT JOIN ids USING (l_orderkey, l_linenumber) GROUP BY 1, 2, 3
""")
def e5_duplicate_ids(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    ids = ops.duplicate_group_ids(t.lineitem.select(*keys), keys)
    return frequency(ids, [*keys, "duplicates"], "n_rows")


@query("""
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    QUALIFY bool_or(l_returnflag = 'R' AND l_quantity > 45) OVER (PARTITION BY l_orderkey)
""")
def e6_keep_qualifying_groups(t: Tables):
    large_return = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    rows = ops.keep_groups(t.lineitem, ["l_orderkey"], any_true(large_return))
    return rows.select("l_orderkey", "l_linenumber", "l_returnflag")


@query("""
    SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row_id FROM customer
""")
def e7_row_ids(t: Tables):
    return ops.row_ids(t.customer, ["-c_acctbal", "c_custkey"]).select("c_custkey", "row_id")


@query("""
    SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC, c_custkey
""")
def f1_multi_key_sort(t: Tables):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return rows.orderBy(*nulls_last("c_nationkey", "-c_acctbal", "c_custkey"))


@query("""
    SELECT c_mktsegment, people, CAST(row_number() OVER (ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 3 END, c_mktsegment) AS BIGINT) AS place
    FROM (SELECT c_mktsegment, count(*) AS people FROM customer GROUP BY 1)
""")
def f2_given_value_order(t: Tables):
    counts = frequency(t.customer, ["c_mktsegment"], "people")
    order = value_order("c_mktsegment", ["MACHINERY", "BUILDING"])
    numbered = ops.number_summary(counts, [order, "c_mktsegment"], "place")
    return numbered.withColumn("place", F.col("place").cast("long"))


@query("""
    SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1
""")
def f3_greatest_date(t: Tables):
    latest = F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey"))
    return t.orders.groupBy("o_custkey").agg(latest.alias("last_order"))
