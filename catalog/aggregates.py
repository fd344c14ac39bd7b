"""D and G: grouped summaries and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Tables, query
from recordops.functions.dates import week_start
from recordops.functions.nulls import any_true, distinct_with_null, share_percent
from recordops.operators import aggregates as ops
from recordops.operators.combine import (
    distinct_values,
    stack,
    stack_by_position,
    stack_labelled,
    stack_same,
)
from recordops.operators.joins import lookup
from recordops.operators.ranking import first_per_key
from recordops.operators.trend import local_regression, regression_grid
from recordops.plans.reports import (
    Module,
    covered_by_code,
    covered_by_flag,
    module_profile,

    unique_persons,
)

def n_rows():
    return F.count(F.lit(1))


@query("""
    SELECT c_nationkey, c_mktsegment, count(*) AS people FROM customer GROUP BY 1, 2 ORDER BY people DESC
""")
def d1_grouped_count(t: Tables):
    return ops.frequency(t.customer, ["c_nationkey", "c_mktsegment"], "people", largest_first=True)


NULLED = "WITH d AS (SELECT source, CASE WHEN lang <> 'de' THEN lang END AS lang FROM documents)"


def nulled(t: Tables):
    lang = F.when(F.col("lang") != "de", F.col("lang")).alias("lang")
    return t.documents.select("source", lang)


@query(NULLED + """
    SELECT source, count(DISTINCT lang) AS langs FROM d GROUP BY 1
""")
def d2_distinct_count_skip_null(t: Tables):
    return nulled(t).groupBy("source").agg(F.count_distinct("lang").alias("langs"))


@query(NULLED + """
    SELECT source, count(DISTINCT coalesce(lang, '?')) AS langs FROM d GROUP BY 1
""")
def d3_distinct_count_with_null(t: Tables):
    return nulled(t).groupBy("source").agg(distinct_with_null("lang").alias("langs"))


CODED = """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority,
                      '0' || o_orderstatus || CASE WHEN o_orderstatus = 'P' THEN 'ND' ELSE 'AF' END AS code,
                      CASE o_orderstatus WHEN 'P' THEN 'No' WHEN 'F' THEN 'Si' ELSE 'Sí' END AS flag FROM orders),
         e AS (SELECT user_id, event_type,
                      '0' || event_type || CASE WHEN event_type = 'error' THEN 'ND' ELSE 'AF' END AS code,
                      CASE event_type WHEN 'error' THEN 'No' WHEN 'view' THEN NULL ELSE 'Si' END AS flag FROM events)
"""


def coded(t: Tables):
    status, kind = F.col("o_orderstatus"), F.col("event_type")
    o_end = F.when(status == "P", "ND").otherwise("AF")
    e_end = F.when(kind == "error", "ND").otherwise("AF")
    o_flag = F.when(status == "P", "No").when(status == "F", "Si").otherwise("Sí")
    e_flag = F.when(kind == "error", "No").when(kind != "view", "Si")
    orders = t.orders.withColumns(
        {"code": F.concat(F.lit("0"), status, o_end), "flag": o_flag}
    )
    events = t.events.withColumns({"code": F.concat(F.lit("0"), kind, e_end), "flag": e_flag})
    return orders, events


def modules(t: Tables, read):
    orders, events = coded(t)
    return {
        "orders": Module(orders, "o_orderpriority", *read(), person="o_custkey"),
        "events": Module(events, "event_type", *read(), person="user_id"),
    }




@query(CODED + """
    , m AS (SELECT 'orders' AS module, o_orderpriority AS facility, code FROM o
            UNION ALL SELECT 'events', event_type, code FROM e)
    SELECT module, count(DISTINCT facility) AS facilities, count(*) AS records,
           count(CASE WHEN NOT regexp_matches(code, '^0.*ND$') THEN 1 END) AS covered,
           round_even(avg(CAST(regexp_matches(code, '^0.*ND$') AS DOUBLE)) * 100, 2) AS percent_not_covered
    FROM m GROUP BY 1
""")
def d4_module_profile(t: Tables):
    return module_profile(modules(t, lambda: covered_by_code("code")))


@query(CODED + """
    , m AS (SELECT 'orders' AS module, o_orderpriority AS facility, code FROM o
            UNION ALL SELECT 'events', event_type, code FROM e)
    SELECT module, count(DISTINCT facility) AS facilities, count(*) AS records,
           round_even(avg(CAST(regexp_matches(code, '^0.*ND$') AS DOUBLE)) * 100, 2) AS percent_not_covered
    FROM m GROUP BY 1
""")
def d5_module_profile_without_covered(t: Tables):
    return module_profile(modules(t, lambda: covered_by_code("code")), with_covered=False)


@query(CODED + """
    , m AS (SELECT 'orders' AS module, o_orderpriority AS facility, flag FROM o
            UNION ALL SELECT 'events', event_type, flag FROM e)
    SELECT module, count(DISTINCT facility) AS facilities, count(*) AS records,
           count(CASE WHEN flag IN ('Si', 'Sí') THEN 1 END) AS covered,
           round_even(avg(CAST(flag = 'No' AS DOUBLE)) * 100, 2) AS percent_not_covered
    FROM m GROUP BY 1
""")
def d6_module_profile_by_flag(t: Tables):
    return module_profile(modules(t, lambda: covered_by_flag("flag")))


@query("""
    SELECT 'customer' AS module, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer
    UNION ALL SELECT 'supplier', count(*), round(sum(s_acctbal), 2) FROM supplier
""")
def d7_stacked_modules(t: Tables):
    tables = {
        "customer": t.customer.select(F.col("c_acctbal").alias("balance")),
        "supplier": t.supplier.select(F.col("s_acctbal").alias("balance")),
    }
    return stack_labelled(tables, "module").groupBy("module").agg(
        n_rows().alias("n"), F.round(F.sum("balance"), 2).alias("balance")
    )


@query("""
    WITH p AS (SELECT DISTINCT * FROM (SELECT o_custkey AS person, 'orders' AS module FROM orders
               UNION ALL SELECT user_id, 'events' FROM events))
    SELECT module, count(*) AS persons FROM p GROUP BY 1
    UNION ALL SELECT 'TOTAL', count(DISTINCT person) FROM p
""")
def d8_unique_persons(t: Tables):
    return unique_persons(modules(t, lambda: covered_by_code("code")))


@query("""
    SELECT count(*) AS total, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned,
           count(CASE WHEN l_quantity > 25 THEN 1 END) AS large FROM lineitem
""")
def d9_global_summary(t: Tables):
    return t.lineitem.agg(
        n_rows().alias("total"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_quantity") > 25).alias("large"),
    )


@query("""
    SELECT c_mktsegment, 'NACIONAL' AS unit, CAST(sum(c_custkey) AS BIGINT) AS c_custkey,
           CAST(sum(c_nationkey) AS BIGINT) AS c_nationkey, round(sum(c_acctbal), 2) AS c_acctbal
    FROM customer GROUP BY 1
""")
def d10_sum_every_numeric(t: Tables):
    sums = ops.sum_numeric(t.customer, ["c_mktsegment"], unit="NACIONAL")
    return sums.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("""
    SELECT CASE WHEN grouping(r_name) = 1 THEN 'TOTAL' ELSE r_name END AS r_name,
           CASE WHEN grouping(n_name) = 1 THEN 'TOTAL' ELSE n_name END AS n_name,
           round(sum(c_acctbal), 2) AS balance, count(*) AS people,
           CAST(grouping(r_name) + grouping(n_name) AS INTEGER) AS level
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name)
""")
def d11_detail_and_totals(t: Tables):
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")])
    people = lookup(t.customer, places, [("c_nationkey", "n_nationkey")])
    measures = {"balance": F.round(F.sum("c_acctbal"), 2), "people": n_rows()}
    return ops.with_totals(people, ["r_name", "n_name"], measures)


@query(NULLED + """
    SELECT 'with null' AS form, lang, count(*) AS n FROM d GROUP BY 2
    UNION ALL SELECT 'without', lang, count(*) FROM d WHERE lang IS NOT NULL GROUP BY 2
""")
def d12_frequency_table(t: Tables):
    d = nulled(t)
    forms = {
        "with null": ops.frequency(d, ["lang"]),
        "without": ops.frequency(d, ["lang"], keep_null=False),
    }
    return stack_labelled(forms, "form")


@query("""
    SELECT DISTINCT l_partkey, l_suppkey FROM lineitem
""")
def d13_distinct_rows(t: Tables):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("""
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
""")
def d14_keep_first_per_key(t: Tables):
    first = first_per_key(t.orders, ["o_custkey"], ["-o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
    SELECT c_nationkey, c_mktsegment, c_acctbal, min(c_name) AS c_name FROM customer GROUP BY 1, 2, 3
""")
def d15_distinct_but_one(t: Tables):
    rows = t.customer.drop("c_custkey")
    return first_per_key(rows, [c for c in rows.columns if c != "c_name"], ["c_name"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
""")
def d16_repeated_rows(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ops.repeated_rows(rows, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT l_linenumber, count(*) - count(DISTINCT l_orderkey) AS surplus FROM lineitem GROUP BY 1
""")
def d17_surplus_count(t: Tables):
    return t.lineitem.groupBy("l_linenumber").agg(ops.surplus("l_orderkey").alias("surplus"))


@query("""
    SELECT n, count(*) AS groups FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY 1
""")
def d18_count_of_counts(t: Tables):
    return ops.count_of_counts(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    WITH e AS (SELECT l_orderkey, date_trunc('week', l_shipdate) AS week, bool_or(l_returnflag = 'R') AS returned,
                      count(*) AS items FROM lineitem GROUP BY 1, 2)
    SELECT strftime(week, '%Y-%m-%d') AS week, count(*) AS events,
           count(CASE WHEN returned THEN 1 END) AS returned, CAST(sum(items) AS BIGINT) AS items FROM e GROUP BY 1
""")
def d19_two_levels(t: Tables):
    events = t.lineitem.groupBy("l_orderkey", week_start("l_shipdate").alias("week")).agg(
        any_true(F.col("l_returnflag") == "R").alias("returned"), n_rows().alias("items")
    )
    weeks = events.groupBy("week").agg(
        n_rows().alias("events"),
        F.count_if("returned").alias("returned"),
        F.sum("items").alias("items"),
    )
    return weeks.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@query("""
    SELECT o_custkey, coalesce(bool_or(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice > 400000 END), false) AS any_large
    FROM orders GROUP BY 1
""")
def d20_any_true(t: Tables):
    large = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice") > 400000)
    return t.orders.groupBy("o_custkey").agg(any_true(large).alias("any_large"))


@query("""
    WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
    SELECT p_brand, coalesce(string_agg(CASE WHEN n < 16 THEN p_type END, ', ' ORDER BY n, p_type), '') AS rare
    FROM c GROUP BY 1
""")
def d21_ordered_text(t: Tables):
    counts = ops.frequency(t.part, ["p_brand", "p_type"])
    order = F.struct("n", "p_type")
    rare = ops.ordered_text("p_type", order, F.col("n") < 16)
    return counts.groupBy("p_brand").agg(rare.alias("rare"))


@query("""
    SELECT c_nationkey, count(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 END) AS AUTOMOBILE,
      count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) AS BUILDING,
      count(CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 END) AS FURNITURE,
      count(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 END) AS HOUSEHOLD,
      count(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END) AS MACHINERY,
      count(CASE WHEN c_mktsegment = 'AIRCRAFT' THEN 1 END) AS AIRCRAFT
    FROM customer GROUP BY 1
""")
def d22_pivot(t: Tables):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "AIRCRAFT"]
    return ops.pivot_values(t.customer, ["c_nationkey"], "c_mktsegment", segments, n_rows())


@query("""
    WITH d AS (SELECT doc_id, n_chars, quality * 1000 AS q, toxic * 500 AS x FROM documents LEFT JOIN labels USING (doc_id))
    SELECT doc_id, least(n_chars, q, x) AS smallest,
           CASE WHEN q IS NOT NULL AND x IS NOT NULL THEN least(n_chars, q, x) END AS strict_smallest FROM d
""")
def d23_row_minimum(t: Tables):
    marks = t.labels.select(
        "doc_id",
        (F.col("quality") * 1000).cast("bigint").alias("q"),
        (F.col("toxic") * 500).cast("bigint").alias("x"),
    )
    d = lookup(t.documents, marks, ["doc_id"])
    columns = ["n_chars", "q", "x"]
    return d.select(
        "doc_id",
        ops.row_minimum(columns).alias("smallest"),
        ops.row_minimum(columns, skip_null=False).alias("strict_smallest"),
    )


@query("""
    WITH d AS (SELECT source, count(*) AS total, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
    SELECT source, total, labelled, labelled / total AS share FROM d
""")
def d24_coverage_ratio(t: Tables):
    d = lookup(t.documents, t.labels, ["doc_id"])
    counts = d.groupBy("source").agg(n_rows().alias("total"), F.count("quality").alias("labelled"))
    return counts.withColumn("share", F.col("labelled") / F.col("total"))


@query("""
    SELECT l_linestatus, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS a,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END) AS BIGINT) AS r_lines
    FROM lineitem GROUP BY 1
""")
def d25_conditional_sums(t: Tables):
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_linestatus").agg(
        n_rows().alias("n"),
        F.count_if(flag == "A").alias("a"),
        F.sum(F.when(flag == "R", F.col("l_linenumber")).otherwise(0)).alias("r_lines"),
    )


@query("""
    SELECT min(l_extendedprice) AS lon_min, min(l_quantity) AS lat_min,
           max(l_extendedprice) AS lon_max, max(l_quantity) AS lat_max FROM lineitem
""")
def d26_extent(t: Tables):
    return ops.extent(t.lineitem, "l_quantity", "l_extendedprice")


MONTHLY = """
    WITH m AS (SELECT o_orderstatus AS series, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS x,
                      CAST(count(*) AS DOUBLE) AS y FROM orders GROUP BY 1, 2),
    n AS (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM m),
    pairs AS (SELECT a.series, a.x, a.n, b.x AS bx, b.y AS v, abs(b.x - a.x) AS d,
                     row_number() OVER (PARTITION BY a.series, a.x ORDER BY abs(b.x - a.x), b.x) AS r
              FROM n a JOIN n b USING (series)),
    h AS (SELECT series, x, max(CASE WHEN r = floor(n * 0.35 + 1e-5) THEN d END) AS h FROM pairs GROUP BY 1, 2),
    w AS (SELECT p.series, p.x, (bx - p.x) / CAST(h AS DOUBLE) AS u, v,
                 pow(1 - pow(abs((bx - p.x) / CAST(h AS DOUBLE)), 3), 3) AS w
          FROM pairs p JOIN h ON p.series = h.series AND p.x = h.x WHERE d < h),
    s AS (SELECT series, x, sum(w) AS s0, sum(w*u) AS s1, sum(w*u*u) AS s2, sum(w*u*u*u) AS s3, sum(w*u*u*u*u) AS s4,
                 sum(w*v) AS t0, sum(w*u*v) AS t1, sum(w*u*u*v) AS t2 FROM w GROUP BY 1, 2)
    SELECT series, x, round((t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2))
                    / (s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2)), 4) AS trend FROM s
"""


@query(MONTHLY)
def d27_local_regression(t: Tables):
    x = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("x")
    monthly = t.orders.groupBy(F.col("o_orderstatus").alias("series"), x).agg(n_rows().alias("y"))
    fitted = local_regression(monthly, ["series"], "x", "y", span=0.35)
    return fitted.select("series", "x", F.round("trend", 4).alias("trend"))


#: From the points m (series, x, y): the grid g of 80 places with the cubic pieces they lie in.
GRID = """
    n AS (SELECT *, count(*) OVER (PARTITION BY series) AS n, row_number() OVER (PARTITION BY series ORDER BY x) AS number FROM m),
    v AS (SELECT *, floor(n * 0.35 + 1e-5) AS near FROM n WHERE (number - 1) % greatest(floor(floor(n * 0.35 + 1e-5) * 0.2), 1) = 0 OR number = n),
    pairs AS (SELECT v.series, v.x, v.near, b.x AS bx, b.y AS py, abs(b.x - v.x) AS d,
                     row_number() OVER (PARTITION BY v.series, v.x ORDER BY abs(b.x - v.x), b.x) AS r FROM v JOIN n b USING (series)),
    h AS (SELECT series, x, max(CASE WHEN r = near THEN d END) AS h FROM pairs GROUP BY 1, 2),
    w AS (SELECT p.series, p.x, h, (bx - p.x) / h AS u, py, pow(1 - pow(abs((bx - p.x) / h), 3), 3) AS w
          FROM pairs p JOIN h ON p.series = h.series AND p.x = h.x WHERE d < h),
    moments AS (SELECT series, x, h, sum(w) AS s0, sum(w*u) AS s1, sum(w*u*u) AS s2, sum(w*u*u*u) AS s3, sum(w*u*u*u*u) AS s4,
                 sum(w*py) AS t0, sum(w*u*py) AS t1, sum(w*u*u*py) AS t2 FROM w GROUP BY 1, 2, 3),
    f AS (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS det FROM moments),
    c AS (SELECT series, x, (t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2)) / det AS fit,
                 (s0*(t1*s4-s3*t2) - t0*(s1*s4-s2*s3) + s2*(s1*t2-t1*s2)) / det / h AS slope FROM f),
    pieces AS (SELECT *, lead(x) OVER o AS x2, lead(fit) OVER o AS fit2, lead(slope) OVER o AS slope2,
                      min(x) OVER (PARTITION BY series) AS lo, max(x) OVER (PARTITION BY series) AS hi FROM c WINDOW o AS (PARTITION BY series ORDER BY x)),
    grid AS (SELECT series, k AS place, lo + k * ((hi - lo) / 79.0::DOUBLE) AS gx
             FROM (SELECT DISTINCT series, lo, hi FROM pieces), (SELECT unnest(range(80)) AS k)),
    g AS (SELECT grid.*, p.*, (gx - x) / (x2 - x) AS u FROM grid JOIN pieces p ON p.series = grid.series AND x2 IS NOT NULL
          AND gx >= x - 1e-6 AND (gx < x2 - 1e-6 OR x2 = hi) QUALIFY row_number() OVER (PARTITION BY grid.series, place ORDER BY x) = 1)
"""


@query("""
    WITH m AS (SELECT o_orderstatus AS series, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) // 7 AS DOUBLE) AS x,
                      CAST(count(*) AS DOUBLE) AS y FROM orders GROUP BY 1, 2),""" + GRID + """    SELECT series, place, round(gx, 6) AS x,
      round(fit*(1+2*u)*(1-u)*(1-u) + slope*(x2-x)*u*(1-u)*(1-u) + fit2*u*u*(3-2*u) + slope2*(x2-x)*u*u*(u-1), 3) AS trend FROM g
""")
def d27_trend_grid(t: Tables):
    week = F.floor(F.unix_date(F.col("o_orderdate").cast("date")) / 7).alias("x")
    weekly = t.orders.groupBy(F.col("o_orderstatus").alias("series"), week).agg(n_rows().alias("y"))
    grid = regression_grid(weekly, ["series"], "x", "y", span=0.35, points=80)
    return grid.select("series", "place", F.round("x", 6).alias("x"), F.round("trend", 3).alias("trend"))


@query("""
    SELECT 1 AS position, 'all' AS stage, count(*) AS records FROM lineitem
    UNION ALL SELECT 2, 'returned', count(*) FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT 3, 'large returned', count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40
    UNION ALL SELECT 4, 'impossible', 0
""")
def d28_stage_counts(t: Tables):
    returned = F.col("l_returnflag") == "R"
    stages = {
        "all": F.lit(True),
        "returned": returned,
        "large returned": returned & (F.col("l_quantity") > 40),
        "impossible": F.col("l_quantity") < 0,
    }
    return ops.stage_counts(t.lineitem, stages)


@query("""
    SELECT n_name AS clues, n_name AS unit, 'EN OPERACION' AS status, count(*) AS people
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def d29_first_and_constants(t: Tables):
    people = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")])
    return people.groupBy(F.col("n_name").alias("clues")).agg(
        F.first("n_name").alias("unit"), F.lit("EN OPERACION").alias("status"), n_rows().alias("people")
    )


@query("""
    WITH p AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
    SELECT 'urgent' AS label, n, n / (SELECT sum(n) FROM p) AS share FROM p WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'low', n, n / (SELECT sum(n) FROM p) FROM p WHERE o_orderpriority = '5-LOW'
""")
def d30_scalars_in_cells(t: Tables):
    counts = ops.frequency(t.orders, ["o_orderpriority"])
    cells = {"urgent": "1-URGENT", "low": "5-LOW"}
    one_row = counts.agg(
        F.sum("n").alias("all"),
        *[F.max(F.when(F.col("o_orderpriority") == v, F.col("n"))).alias(k) for k, v in cells.items()],
    )
    rows = [
        F.struct(F.lit(k).alias("label"), F.col(k).alias("n"), (F.col(k) / F.col("all")).alias("share"))
        for k in cells
    ]
    return one_row.select(F.inline(F.array(*rows)))


@query("""
    SELECT lang, round(100 * avg(CAST(quality = 1 AS DOUBLE)), 6) AS good
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
""")
def d31_share_of_true(t: Tables):
    d = lookup(t.documents, t.labels, ["doc_id"])
    return d.groupBy("lang").agg(F.round(share_percent(F.col("quality") == 1), 6).alias("good"))


@query("""
    SELECT part, count(*) AS n, count(balance) AS balances, count(segment) AS segments FROM (
      SELECT 'c' AS part, c_acctbal AS balance, c_mktsegment AS segment FROM customer
      UNION ALL SELECT 's', s_acctbal, NULL FROM supplier UNION ALL SELECT 'p', NULL, NULL FROM part) GROUP BY 1
""")
def g1_union_by_name(t: Tables):
    c = t.customer.select(F.lit("c").alias("part"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_acctbal").alias("balance"), F.lit("s").alias("part"))
    p = t.part.select(F.lit("p").alias("part"))
    return stack(c, s, p).groupBy("part").agg(
        n_rows().alias("n"), F.count("balance").alias("balances"), F.count("segment").alias("segments")
    )


@query("""
    SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier
""")
def g2_union_same_columns(t: Tables):
    c = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return stack_same(c, s)


@query("""
    SELECT c_name, c_nationkey FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier
""")
def g3_union_by_position(t: Tables):
    return stack_by_position(
        t.customer.select("c_name", "c_nationkey"), t.supplier.select("s_name", "s_nationkey")
    )


@query("""
    SELECT DISTINCT value FROM (SELECT o_orderpriority AS value FROM orders
      UNION ALL SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END FROM orders) WHERE value IS NOT NULL
""")
def g4_distinct_union(t: Tables):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")
    return distinct_values(t.orders.select("o_orderpriority", status), ["o_orderpriority", "status"])
