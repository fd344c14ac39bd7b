"""C: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Tables, query
from recordops.operators import joins as ops
from recordops.operators.aggregates import frequency


@query("""
    SELECT p_type, count(*) AS n, sum(l_quantity) AS quantity
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def c1_left_lookup(t: Tables):
    parts = t.part.select("p_partkey", "p_type")
    joined = ops.lookup(t.lineitem, parts, [("l_partkey", "p_partkey")])
    return joined.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query("""
    SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def c2_natural_join(t: Tables):
    people = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    return frequency(ops.natural_join(people, t.nation), ["n_name"])


@query("""
    SELECT d.doc_id, lang, quality FROM labels RIGHT JOIN documents d USING (doc_id)
""")
def c3_right_join(t: Tables):
    labels = t.labels.select("doc_id", "quality")
    return ops.lookup(labels, t.documents.select("doc_id", "lang"), ["doc_id"], "right")


@query("""
    WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                      o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1, 2, 3),
         l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                      l_linestatus AS status, count(*) AS items FROM lineitem GROUP BY 1, 2, 3)
    SELECT year, month, status, orders, items FROM o FULL JOIN l USING (year, month, status)
""")
def c4_full_join(t: Tables):
    def monthly(df, date, status, name):
        parts = [F.year(date).alias("year"), F.month(date).alias("month")]
        return frequency(df.select(*parts, F.col(status).alias("status")), ["year", "month", "status"], name)

    orders = monthly(t.orders, "o_orderdate", "o_orderstatus", "orders")
    items = monthly(t.lineitem, "l_shipdate", "l_linestatus", "items")
    return ops.full_join(orders, items, ["year", "month", "status"], unique=True)


@query("""
    SELECT l_returnflag, count(*) AS n FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1
""")
def c5_semi_join(t: Tables):
    orders = t.orders.filter(F.col("o_orderstatus") != "P")
    kept = ops.matched(t.lineitem, orders, [("l_orderkey", "o_orderkey")], unique=True)
    return frequency(kept, ["l_returnflag"])


@query("""
    WITH d AS (SELECT *, CASE WHEN lang <> 'de' THEN doc_id END AS k FROM documents),
         l AS (SELECT doc_id, CASE WHEN toxic = 0 THEN doc_id END AS k FROM labels)
    SELECT doc_id, lang FROM d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.k IS NOT DISTINCT FROM d.k)
""")
def c6_anti_join_null_safe(t: Tables):
    d = t.documents.withColumn("k", F.when(F.col("lang") != "de", F.col("doc_id")))
    l = t.labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("k"))
    return ops.unmatched(d, l, ["k"]).select("doc_id", "lang")


@query("""
    SELECT doc_id, lang, source FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id = d.doc_id AND e.lang = d.lang AND e.n_chars > 1000)
""")
def c7_anti_join_shared(t: Tables):
    long = t.documents.filter(F.col("n_chars") > 1000).select("doc_id", "lang")
    return ops.unmatched_on_shared(t.documents.select("doc_id", "lang", "source"), long)


@query("""
    WITH d AS (SELECT *, CASE WHEN lang <> 'de' THEN doc_id END AS k FROM documents),
         l AS (SELECT DISTINCT CASE WHEN toxic = 0 THEN doc_id END AS k FROM labels)
    SELECT d.doc_id, d.lang FROM d LEFT JOIN l ON d.k = l.k WHERE l.k IS NULL
""")
def c8_sql_anti_join(t: Tables):
    d = t.documents.withColumn("k", F.when(F.col("lang") != "de", F.col("doc_id")))
    l = t.labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("k"))
    return ops.unmatched(d, l, ["k"], null_safe=False).select("doc_id", "lang")


@query("""
    WITH d AS (SELECT CASE WHEN lang <> 'de' THEN doc_id END AS k FROM documents),
         l AS (SELECT DISTINCT doc_id AS k FROM labels)
    SELECT count(*) AS total, count(l.k) AS matched, count(*) - count(l.k) AS missing
    FROM d LEFT JOIN l ON d.k = l.k
""")
def c9_match_audit(t: Tables):
    d = t.documents.select(F.when(F.col("lang") != "de", F.col("doc_id")).alias("k"))
    return ops.match_audit(d, t.labels.withColumnRenamed("doc_id", "k"), ["k"])


@query("""
    WITH l AS (SELECT l_orderkey, l_linenumber, l_linestatus, l_returnflag FROM lineitem)
    SELECT a.l_returnflag, count(*) AS n FROM l a
    WHERE NOT EXISTS (SELECT 1 FROM l b WHERE b.l_returnflag = 'R' AND a.l_orderkey = b.l_orderkey
                      AND a.l_linenumber = b.l_linenumber AND a.l_linestatus = b.l_linestatus)
    GROUP BY 1
""")
def c10_anti_join_three_keys(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_linestatus"]
    returned = t.lineitem.filter(F.col("l_returnflag") == "R")
    return frequency(ops.unmatched(t.lineitem, returned, keys, null_safe=False), ["l_returnflag"])


STAYS = """
    WITH stays AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 730 AS e FROM orders),
         items AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d FROM lineitem)
"""


def stays(t: Tables):
    start = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", start.alias("s"), F.date_add(start, 730).alias("e"))


@query(STAYS + """
    SELECT DISTINCT l_orderkey, strftime(d, '%Y-%m-%d') AS day FROM items
    JOIN stays ON l_orderkey = o_orderkey AND d >= s AND d <= e
""")
def c11_interval_join(t: Tables):
    keys = [("l_orderkey", "o_orderkey")]
    covered = ops.covered_by_interval(t.lineitem, stays(t), keys, "l_shipdate", "s", "e")
    days = covered.select("l_orderkey", F.col("l_shipdate").cast("date").alias("day")).distinct()
    return days.withColumn("day", F.col("day").cast("string"))


@query(STAYS + """
    SELECT l_orderkey, strftime(d, '%Y-%m-%d') AS day, count(*) AS n FROM items i
    WHERE NOT EXISTS (SELECT 1 FROM stays WHERE l_orderkey = o_orderkey AND d >= s AND d <= e)
    GROUP BY 1, 2
""")
def c12_interval_anti_join(t: Tables):
    keys = [("l_orderkey", "o_orderkey")]
    rest = ops.not_covered_by_interval(t.lineitem, stays(t), keys, "l_shipdate", "s", "e")
    rest = rest.select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"))
    days = frequency(rest, ["l_orderkey", "day"])
    return days.withColumn("day", F.col("day").cast("string"))


@query("""
    WITH need AS (SELECT n_nationkey, n_name, s.segment, s.place FROM nation,
                  (VALUES ('BUILDING', 1), ('MACHINERY', 2), ('AIRCRAFT', 3)) s(segment, place))
    SELECT n_name, segment, place, count(c_custkey) AS people
    FROM need LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = segment GROUP BY 1, 2, 3
""")
def c13_crossing(t: Tables):
    rows = [("BUILDING", 1), ("MACHINERY", 2), ("AIRCRAFT", 3)]
    need = ops.cross_with(t.nation, [{"segment": s, "place": p} for s, p in rows])
    people = frequency(t.customer, ["c_nationkey", "c_mktsegment"], "people")
    keys = [("n_nationkey", "c_nationkey"), ("segment", "c_mktsegment")]
    out = ops.lookup(need, people, keys).fillna(0, subset=["people"])
    return out.select("n_name", "segment", "place", "people")


@query("""
    SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN (
      SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
    ) ON c_custkey = o_custkey
""")
def c14_lookup_one_row_per_key(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    keys = [("c_custkey", "o_custkey")]
    out = ops.lookup(t.customer, orders, keys, one_row_by=["o_orderdate", "o_orderkey"])
    return out.select("c_custkey", "o_orderkey", "o_orderpriority")


@query("""
    SELECT lang, event_type, count(*) AS n FROM documents LEFT JOIN events ON doc_id = user_id GROUP BY 1, 2
""")
def c15_fan_out_join(t: Tables):
    events = t.events.select("user_id", "event_type")
    return frequency(ops.lookup(t.documents, events, [("doc_id", "user_id")]), ["lang", "event_type"])


@query("""
    SELECT lang, doc_id IN (SELECT doc_id FROM labels) AS labelled, count(*) AS n FROM documents GROUP BY 1, 2
""")
def c16_membership_flag(t: Tables):
    flagged = ops.flag_matches(t.documents, t.labels, ["doc_id"], "labelled")
    return frequency(flagged, ["lang", "labelled"])


@query("""
    SELECT lang, CASE WHEN quality IS NULL AND toxic IS NULL THEN 'not found' ELSE 'found' END AS status,
           count(*) AS n, CAST(sum(quality) AS BIGINT) AS good
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2
""")
def c17_enrichment(t: Tables):
    out = ops.lookup(t.documents, t.labels, ["doc_id"])
    found = F.coalesce("quality", "toxic").isNotNull()
    out = out.withColumn("status", F.when(found, "found").otherwise("not found"))
    return out.groupBy("lang", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good")
    )
