"""B: projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Tables, query
from recordops.functions.nulls import member, not_blank, strict_if
from recordops.operators import columns as ops
from recordops.operators.aggregates import frequency
from recordops.operators.combine import stack_labelled
from recordops.operators.joins import flag_matches, lookup, matched


@query("""
    SELECT l_orderkey AS event, l_linenumber AS number,
           l_extendedprice * (1 - l_discount) AS net,
           l_returnflag || '-' || l_linestatus AS state
    FROM lineitem
""")
def b1_project_and_rename(t: Tables):
    return t.lineitem.withColumnsRenamed({"l_orderkey": "event", "l_linenumber": "number"}).select(
        "event",
        "number",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("state"),
    )


@query("""
    SELECT 'customer' AS part, c_custkey AS person, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
""")
def b2_rename_if_present(t: Tables):
    names = {"c_custkey": "person", "s_suppkey": "person"}
    names |= {"c_acctbal": "balance", "s_acctbal": "balance"}
    both = {"customer": t.customer, "supplier": t.supplier}
    renamed = {k: ops.rename_present(df, names) for k, df in both.items()}
    shared = ops.shared_columns(*renamed.values())
    return stack_labelled({k: df.select(*shared) for k, df in renamed.items()}, "part")


@query("""
    SELECT doc_id, 'lang,source' AS only_left, 'quality' AS only_right
    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
""")
def b3_shared_columns(t: Tables):
    left = t.documents.select("doc_id", "lang", "source")
    right = t.labels.select("doc_id", "quality")
    return matched(left, right, ops.shared_columns(left, right)).select(
        *ops.shared_columns(left, right),
        F.lit(",".join(ops.columns_only_in(left, right))).alias("only_left"),
        F.lit(",".join(ops.columns_only_in(right, left))).alias("only_right"),
    )


@query("""
    SELECT c_acctbal, c_custkey, c_nationkey FROM customer
""")
def b4_by_type_and_suffix(t: Tables):
    df = ops.without_suffix(t.customer, "_name")
    return ops.lead_with(df.select(*ops.numeric_columns(df)), "c_acctbal")


@query("""
    SELECT p_partkey, upper(trim(p_name)) AS p_name, upper(trim(p_brand)) AS p_brand,
           upper(trim(p_type)) AS p_type FROM part
""")
def b5_apply_to_each(t: Tables):
    df = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return ops.apply_each(df, ["p_name", "p_brand", "p_type"], lambda c: F.upper(F.trim(c)))


@query("""
    SELECT event_type, count(*) AS n FROM events
    WHERE trim(json_extract_string(props, '$.k')) <> '' AND value > 5 AND user_id IS NOT NULL
    GROUP BY 1
""")
def b6_conjunctive_filter(t: Tables):
    k = F.get_json_object("props", "$.k")
    kept = t.events.filter(not_blank(k) & (F.col("value") > 5) & F.col("user_id").isNotNull())
    return frequency(kept, ["event_type"])


@query("""
    WITH d AS (SELECT nullif(lang, 'de') AS lang FROM documents)
    SELECT lang, coalesce(lang IN ('en', 'es'), false) AS listed, count(*) AS n FROM d GROUP BY 1, 2
""")
def b7_membership(t: Tables):
    d = t.documents.select(F.nullif("lang", F.lit("de")).alias("lang"))
    return frequency(d.withColumn("listed", member("lang", ["en", "es"])), ["lang", "listed"])


@query("""
    WITH d AS (SELECT doc_id, n_chars, CASE WHEN lang <> 'de' THEN lang END AS lang FROM documents)
    SELECT doc_id,
      CASE WHEN n_chars > 2000 THEN 'long' WHEN lang = 'en' THEN 'english' ELSE 'other' END AS kind,
      CASE WHEN lang IS NULL THEN NULL WHEN lang = 'en' THEN 1 ELSE 2 END AS priority
    FROM d
""")
def b8_conditionals(t: Tables):
    lang = F.nullif("lang", F.lit("de"))
    kind = F.when(F.col("n_chars") > 2000, "long").when(lang == "en", "english")
    return t.documents.select(
        "doc_id",
        kind.otherwise("other").alias("kind"),
        strict_if(lang == "en", 1, 2).alias("priority"),
    )


@query("""
    SELECT o_orderpriority, count(*) AS n FROM orders
    WHERE regexp_matches(o_orderpriority, 'urgent', 'i')
       OR (o_orderstatus = 'P' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
    GROUP BY 1
""")
def b9_pattern_or_compound(t: Tables):
    debtors = t.customer.filter(F.col("c_acctbal") < 0)
    orders = flag_matches(t.orders, debtors, [("o_custkey", "c_custkey")], "debtor")
    urgent = F.col("o_orderpriority").rlike("(?i)urgent")
    kept = orders.filter(urgent | ((F.col("o_orderstatus") == "P") & F.col("debtor")))
    return frequency(kept, ["o_orderpriority"])


@query("""
    WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 0 ELSE 1 END AS deleted,
                      nullif(o_orderpriority, '5-LOW') AS status FROM orders)
    SELECT 'deleted = 0' AS filter, count(*) AS n FROM o WHERE deleted = 0 AND deleted IS NOT NULL
    UNION ALL SELECT 'deleted <> 1', count(*) FROM o WHERE deleted <> 1
    UNION ALL SELECT 'status', count(*) FROM o WHERE coalesce(status, '') <> '1-URGENT'
    UNION ALL SELECT 'no reason', count(*) FROM o WHERE status IS NULL
""")
def b10_soft_delete(t: Tables):
    status = F.col("o_orderstatus")
    deleted = F.when(status == "F", 0).when(status == "O", 1)
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    tests = {
        "deleted = 0": (deleted == 0) & deleted.isNotNull(),
        "deleted <> 1": deleted != 1,
        "status": F.coalesce(priority, F.lit("")) != "1-URGENT",
        "no reason": priority.isNull(),
    }
    counts = t.orders.agg(*[F.count_if(c).alias(n) for n, c in tests.items()])
    rows = [F.struct(F.lit(n).alias("filter"), F.col(f"`{n}`").alias("n")) for n in tests]
    return counts.select(F.inline(F.array(*rows)))


@query("""
    WITH d AS (SELECT CASE WHEN lang <> 'de' THEN n_chars END AS n_chars FROM documents)
    SELECT 'yes' AS part, count(*) AS n FROM d WHERE n_chars > 1000
    UNION ALL SELECT 'other', count(*) FROM d WHERE n_chars <= 1000 OR n_chars IS NULL
    UNION ALL SELECT 'strict other', count(*) FROM d WHERE n_chars <= 1000
""")
def b11_complementary_split(t: Tables):
    d = t.documents.select(F.when(F.col("lang") != "de", F.col("n_chars")).alias("n_chars"))
    yes, other = ops.split_rows(d, F.col("n_chars") > 1000)
    _, strict = ops.split_rows(d, F.col("n_chars") > 1000, keep_unknown=False)
    parts = stack_labelled({"yes": yes, "other": other, "strict other": strict}, "part")
    return frequency(parts, ["part"])


@query("""
    SELECT doc_id, coalesce(quality, toxic, -1) AS mark
    FROM documents LEFT JOIN (SELECT doc_id, nullif(quality, 0) AS quality, toxic FROM labels) USING (doc_id)
""")
def b12_first_non_null(t: Tables):
    labels = t.labels.select("doc_id", F.nullif("quality", F.lit(0)).alias("quality"), "toxic")
    joined = lookup(t.documents, labels, ["doc_id"])
    return joined.select("doc_id", F.coalesce("quality", "toxic", F.lit(-1)).alias("mark"))


@query("""
    SELECT p_partkey,
      CASE p_type WHEN 'PROMO' THEN 'OFFER' WHEN 'SMALL' THEN 'TINY' ELSE p_type END AS p_type,
      CASE p_brand WHEN 'Brand#1' THEN 1.5 WHEN 'Brand#2' THEN 2.5 ELSE p_retailprice END AS p_retailprice
    FROM part
""")
def b13_point_corrections(t: Tables):
    df = ops.correct_values(t.part, "p_type", {"PROMO": "OFFER", "SMALL": "TINY"})
    df = ops.correct_values(df, "p_retailprice", {"Brand#1": 1.5, "Brand#2": 2.5}, by="p_brand")
    return df.select("p_partkey", "p_type", "p_retailprice")


@query("""
    SELECT * EXCLUDE (o_orderdate, o_totalprice), strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS o_orderdate,
           CAST(o_totalprice AS BIGINT) >= 100000 AS large
    FROM orders
""")
def b14_all_but_one_retyped(t: Tables):
    df = ops.retype(t.orders, "o_orderdate", "date")
    df = ops.retype(df, "o_orderdate", "string")
    large = F.round("o_totalprice").cast("bigint") >= 100000
    return df.withColumn("large", large).drop("o_totalprice")


@query("""
    SELECT 'c_mktsegment' AS of, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2
""")
def b15_column_as_parameter(t: Tables):
    def counts(name: str):
        value = F.col(name).cast("string").alias("value")
        return frequency(t.customer.select(value), ["value"])

    return stack_labelled({n: counts(n) for n in ("c_mktsegment", "c_nationkey")}, "of")


@query("""
    SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS reviewer, CAST(NULL AS DOUBLE) AS score FROM labels
""")
def b16_guaranteed_columns(t: Tables):
    wanted = {"doc_id": "bigint", "toxic": "int", "reviewer": "string", "score": "double"}
    return ops.ensure_columns(t.labels, wanted)


@query("""
    SELECT o_orderstatus, count(*) AS n FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-09-01' AND TIMESTAMP '1998-12-31' GROUP BY 1
""")
def b17_date_range(t: Tables):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1996-09-01", "1998-12-31"))
    return frequency(t.orders.filter(F.col("o_orderdate").between(low, high)), ["o_orderstatus"])


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity * l_tax AS taxed, l_quantity * l_discount AS discounted
    FROM lineitem
""")
def b18_append_computed(t: Tables):
    def pair(a, b, c):
        return {"taxed": a * b, "discounted": a * c}

    return t.lineitem.withColumns(
        pair(F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"))
    ).select("l_orderkey", "l_linenumber", "taxed", "discounted")
