"""I: composed pipelines on stand-ins built from the given tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from catalog.aggregates import CODED, GRID, coded
from catalog.registry import Tables, query
from catalog.scalars import person_key, person_key_column
from recordops import fixed_values as fixed
from recordops.functions.text import lookup_value
from recordops.operators.aggregates import extent, frequency, with_group_total
from recordops.operators.combine import distinct_values, stack_labelled
from recordops.operators.joins import lookup, match_audit
from recordops.operators.ranking import row_ids
from recordops.operators.trend import local_regression, regression_grid
from recordops.plans import candidates, coordinates, person_keys, reports, series
from recordops.plans import supplements, teams
from recordops.sources.readers import literal_table
from recordops.sources.writers import written


def n_rows():
    return F.count(F.lit(1))


# --- I1, I2: coordinates -------------------------------------------------------

# Numbers east instead of west, number pairs, degrees, reversed and missing axes.
MESSY = """
    WITH s AS (SELECT c_custkey AS k, c_mktsegment AS g, c_acctbal AS b, c_nationkey AS n,
                      CAST(14 + c_nationkey * 0.5 AS VARCHAR) AS a, CAST(-119 + c_nationkey * 1.25 AS VARCHAR) AS o FROM customer),
    e AS (SELECT k, g,
      CASE WHEN g = 'FURNITURE' THEN CASE WHEN b > 5000 THEN 'none' ELSE 'numeric_review' END
           WHEN g = 'BUILDING' THEN 'numeric_valid' WHEN g = 'MACHINERY' THEN 'text_valid'
           WHEN g = 'HOUSEHOLD' AND n <= 15 THEN 'text_valid' ELSE 'text_review' END AS part,
      CASE WHEN g = 'FURNITURE' AND b <= 5000 THEN -CAST(a AS DOUBLE) WHEN g IN ('BUILDING', 'MACHINERY') THEN CAST(a AS DOUBLE)
           WHEN g = 'HOUSEHOLD' THEN CAST(15 + n AS DOUBLE) + 0.5 END AS lat_num,
      CASE WHEN g = 'FURNITURE' AND b <= 5000 THEN -100.5::DOUBLE WHEN g = 'BUILDING' THEN -95.25::DOUBLE WHEN g = 'MACHINERY' THEN CAST(o AS DOUBLE)
           WHEN g = 'HOUSEHOLD' AND n <= 15 THEN -100.26::DOUBLE WHEN g = 'AUTOMOBILE' THEN -95.5::DOUBLE END AS lon_num
    FROM s)
"""


def messy_places(t: Tables):
    g, n, b = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    a = (n.cast("decimal(10,0)") * F.lit(0.5).cast("decimal(2,1)") + 14).cast("decimal(10,1)")
    o = (n.cast("decimal(10,0)") * F.lit(1.25).cast("decimal(3,2)") - 119).cast("decimal(10,2)")
    a, o = a.cast("string"), o.cast("string")
    lat = (
        F.when(g == "FURNITURE", "-100.5")
        .when(g == "BUILDING", a)
        .when(g == "MACHINERY", "x")
        .when(g == "HOUSEHOLD", F.concat((n + 15).cast("string"), F.lit("°30'")))
        .otherwise("sin dato")
    )
    lon = (
        F.when((g == "FURNITURE") & (b > 5000), "-95")
        .when(g == "FURNITURE", a)
        .when((g == "BUILDING") & (b < 2000), "95.25")
        .when(g == "BUILDING", "-95.25")
        .when(g == "MACHINERY", F.concat(a, F.lit(" , "), o))
        .when((g == "HOUSEHOLD") & (n <= 15), "100°15'36\"W")
        .when(g == "AUTOMOBILE", "-95.5")
    )
    return t.customer.select(
        F.col("c_custkey").alias("k"), lat.alias("lat"), lon.alias("lon"), F.col("c_name").alias("name")
    )


@query(MESSY + """
    SELECT part, k, lat_num, lon_num FROM e WHERE part <> 'none'
    UNION ALL SELECT 'final_valid', k, lat_num, lon_num FROM e WHERE part IN ('numeric_valid', 'text_valid')
""")
def i1_clean_coordinates(t: Tables):
    tables = coordinates.coordinate_tables(messy_places(t), "lat", "lon")
    return tables.select("part", "k", "lat_num", "lon_num")


@query(MESSY + """
    SELECT min(lon_num) AS lon_min, min(lat_num) AS lat_min, max(lon_num) AS lon_max, max(lat_num) AS lat_max
    FROM e WHERE part IN ('numeric_valid', 'text_valid')
""")
def i1_map_extent(t: Tables):
    valid = coordinates.clean_coordinates(messy_places(t), "lat", "lon")["final_valid"]
    return extent(valid, "lat_num", "lon_num")


# Text rows with a missing axis fail neither check nor its opposite.
AUDIT = MESSY + """
    , f AS (SELECT *, CASE WHEN part IN ('numeric_valid', 'text_valid') THEN 'valid'
              WHEN part = 'numeric_review' THEN 'numeric' WHEN g = 'HOUSEHOLD' AND NOT lat_num BETWEEN 14 AND 33 THEN 'text'
              ELSE 'open' END AS fate FROM e)
"""


@query(AUDIT + """
    SELECT 1 AS position, 'Base original' AS stage, count(*) AS records FROM f
    UNION ALL SELECT 2, 'Numéricos válidos', count(*) FROM f WHERE part = 'numeric_valid'
    UNION ALL SELECT 3, 'Numéricos revisión', count(*) FROM f WHERE fate = 'numeric'
    UNION ALL SELECT 4, 'Texto válido', count(*) FROM f WHERE part = 'text_valid'
    UNION ALL SELECT 5, 'Texto revisión', count(*) FROM f WHERE fate = 'text'
    UNION ALL SELECT 6, 'Final válido', count(*) FROM f WHERE fate = 'valid'
    UNION ALL SELECT 7, 'Final revisión', 0
    UNION ALL SELECT 8, 'Perdidos', count(*) FROM f WHERE fate <> 'valid'
""")
def i2_loss_funnel(t: Tables):
    return coordinates.coordinate_audit(messy_places(t), "lat", "lon")["funnel"]


@query(AUDIT + """
    SELECT k, CASE fate WHEN 'numeric' THEN 'numérico' WHEN 'text' THEN 'texto' END AS origin,
      CASE fate WHEN 'open' THEN 'Se perdió en alguna transformación intermedia' WHEN 'numeric' THEN 'Latitud fuera de rango México'
        ELSE 'Longitud no convertida' END AS cause
    FROM f WHERE fate <> 'valid'
""")
def i2_lost_rows(t: Tables):
    lost = coordinates.coordinate_audit(messy_places(t), "lat", "lon")["lost"]
    return lost.select("k", "origin", "cause")


@query(AUDIT + """
    SELECT CASE fate WHEN 'open' THEN 'Se perdió en alguna transformación intermedia' WHEN 'numeric' THEN 'Latitud fuera de rango México'
        ELSE 'Longitud no convertida' END AS cause, count(*) AS n FROM f WHERE fate <> 'valid' GROUP BY 1
""")
def i2_audit_by_joins(t: Tables):
    df = written(row_ids(messy_places(t), ["k"], "id"), "places")
    parts = coordinates.clean_coordinates(df, "lat", "lon", review_missing_text=False)
    names = ["numeric_review", "text_review", "final_review"]
    reviews = [parts[n].select("id", "cause") for n in names]
    return coordinates.audit_losses(df, parts["final_valid"], reviews, "id", "cause")["causes"]


# --- I3, I4: person keys --------------------------------------------------------


@query(f"""
    WITH c AS (SELECT c_custkey, c_mktsegment AS g, {person_key('c_custkey', 'c_mktsegment')} AS key FROM customer)
    SELECT c_custkey, upper(regexp_replace(key, '[^A-Za-z0-9]', '', 'g')) AS key_clean,
      CASE WHEN g <> 'AUTOMOBILE' THEN g = 'MACHINERY' END AS key_changed, g = 'AUTOMOBILE' AS key_blank,
      CAST(CASE g WHEN 'AUTOMOBILE' THEN NULL WHEN 'FURNITURE' THEN 15 ELSE 18 END AS INTEGER) AS key_length,
      CASE WHEN g <> 'AUTOMOBILE' THEN g IN ('BUILDING', 'MACHINERY') END AS key_valid,
      CASE g WHEN 'AUTOMOBILE' THEN 'CURP vacía' WHEN 'FURNITURE' THEN 'Longitud distinta de 18' WHEN 'HOUSEHOLD' THEN 'Formato inválido'
        WHEN 'MACHINERY' THEN 'CURP corregida por limpieza' ELSE 'CURP válida sin cambios' END AS key_status
    FROM c
""")
def i3_validate_keys(t: Tables):
    keys = t.customer.withColumn("key", person_key_column("c_custkey", "c_mktsegment"))
    return person_keys.validate_keys(keys, "key").select(
        "c_custkey", "key_clean", "key_changed", "key_blank", "key_length", "key_valid", "key_status"
    )


@query("""
    SELECT part, c_mktsegment, count(*) AS n FROM customer, (VALUES ('invalid'), ('corrected')) p(part)
    WHERE (part = 'invalid' AND c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')) OR (part = 'corrected' AND c_mktsegment = 'MACHINERY') GROUP BY 1, 2
""")
def i3_invalid_and_corrected(t: Tables):
    keys = t.customer.withColumn("key", person_key_column("c_custkey", "c_mktsegment"))
    splits = person_keys.split_validated(person_keys.validate_keys(keys, "key"))
    both = stack_labelled({n: splits[n] for n in ("invalid", "corrected")}, "part")
    return frequency(both, ["part", "c_mktsegment"])


REGISTER = """
    WITH val AS (SELECT d.doc_id, lang, event_type FROM documents d LEFT JOIN events e ON e.user_id = d.doc_id)
"""


def register_match(t: Tables):
    register = t.events.select(F.col("user_id").alias("doc_id"), "event_type")
    return person_keys.match_register(
        register, t.documents.select("doc_id", "lang"), "doc_id", "event_type"
    )


@query(REGISTER + """
    SELECT count(*) AS total, count(*) - count(DISTINCT doc_id) AS surplus,
           count(*) - count(event_type) AS unmatched, count(event_type) AS matched FROM val
""")
def i4_match_summary(t: Tables):
    return register_match(t)["summary"]


@query(REGISTER + """
    , p AS (SELECT 'all' AS part, doc_id, event_type FROM val
      UNION ALL SELECT 'repeated', doc_id, event_type FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS c FROM val) WHERE c > 1
      UNION ALL SELECT 'unmatched', doc_id, event_type FROM val WHERE event_type IS NULL
      UNION ALL SELECT 'matched', doc_id, event_type FROM val WHERE event_type IS NOT NULL
      UNION ALL SELECT 'never_seen', doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events))
    SELECT part, event_type, count(*) AS n, count(DISTINCT doc_id) AS keys FROM p GROUP BY 1, 2
""")
def i4_match_tables(t: Tables):
    tables = register_match(t)
    tables.pop("summary")
    return stack_labelled(tables, "part").groupBy("part", "event_type").agg(
        n_rows().alias("n"), F.count_distinct("doc_id").alias("keys")
    )


# --- I5 - I7: late records ------------------------------------------------------

INTERVAL_SUPPLEMENT = """
    WITH base AS (SELECT o_orderkey AS event, CAST(o_orderdate AS DATE) AS admitted, CAST(o_orderdate AS DATE) + 730 AS discharged,
                         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS inserted, '1001' AS code FROM orders),
    late AS (SELECT l_orderkey AS event, CAST(l_shipdate AS DATE) AS d, CAST(1000 + l_linenumber AS VARCHAR) AS code FROM lineitem
             WHERE l_returnflag <> 'N'),
    missing AS (SELECT * FROM late l WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.event = l.event AND l.d BETWEEN b.admitted AND b.discharged)),
    both_ AS (SELECT event, admitted, discharged, coalesce(inserted, discharged) AS inserted, code, 'base' AS source FROM base
              UNION ALL SELECT event, d, d, d, code, 'late' FROM missing),
    cat(code, kind) AS (VALUES ('1001', 'Q'), ('1002', 'T'), ('1003', 'D')),
    done AS (SELECT * FROM both_ LEFT JOIN cat USING (code))
"""


@query(INTERVAL_SUPPLEMENT + """
    SELECT source, kind, code, CAST(year(inserted) AS INTEGER) AS year, count(*) AS n, count(DISTINCT event) AS events FROM done GROUP BY 1, 2, 3, 4
""")
def i5_supplement_by_interval(t: Tables):
    start = F.col("o_orderdate").cast("date")
    base = t.orders.select(
        F.col("o_orderkey").alias("event"),
        start.alias("admitted"),
        F.date_add(start, 730).alias("discharged"),
        F.when(F.col("o_orderstatus") == "F", start).alias("inserted"),
        F.lit("1001").alias("code"),
    )
    number = (F.col("l_linenumber") + 1000).cast("string")
    late = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("person"),
        F.col("l_orderkey").alias("event"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("done_on"),
        F.when(F.col("l_returnflag") == "N", "cancelled").alias("cancel_reason"),
        F.concat(number, F.lit(" "), F.col("l_returnflag")).alias("procedure"),
    )
    late = supplements.usable_late_rows(late, "person", "done_on", "cancel_reason")
    late = supplements.split_codes(late, {"procedure": ("code", "description")})
    aligned = {
        "event": F.col("event"),
        "admitted": F.col("done_on").cast("date"),
        "discharged": F.col("done_on").cast("date"),
        "code": F.col("code"),
    }
    both = supplements.supplement_by_interval(
        base, late, ["event"], "done_on", "admitted", "discharged", aligned, ("base", "late")
    )
    dates = ["admitted", "discharged", "inserted"]
    both = supplements.settle_dates(both, dates, "inserted", "discharged")
    kinds = [("1001", "Q"), ("1002", "T"), ("1003", "D")]
    catalogue = literal_table(t.spark, kinds, "catalog_key string, kind string")
    done = supplements.with_catalogue_type(both, catalogue, "code", "catalog_key", "kind", "kind")
    return done.groupBy("source", "kind", "code", F.year("inserted").alias("year")).agg(
        n_rows().alias("n"), F.count_distinct("event").alias("events")
    )


KEY_SUPPLEMENT = """
    WITH late AS (SELECT o_orderkey AS folio, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS person, o_orderstatus AS status,
        CAST(o_orderdate AS DATE) AS day, CASE WHEN o_custkey % 5 > 0 THEN 'X' || o_custkey END AS extract FROM orders),
    base AS (SELECT * FROM late WHERE status = 'F'),
    there AS (SELECT * FROM base WHERE extract IS NOT NULL),
    missing AS (SELECT l.* FROM late l LEFT JOIN there b ON l.folio = b.folio AND l.person = b.person AND l.day = b.day WHERE b.folio IS NULL)
"""


def base_and_late(t: Tables):
    person = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    late = t.orders.select(
        F.col("o_orderkey").alias("folio"),
        person.alias("person"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_custkey") % 5 > 0, F.concat(F.lit("X"), "o_custkey")).alias("extract"),
    )
    return late.filter(F.col("status") == "F"), late


def base_with_late(t: Tables):
    """Base rows without an extract stay, but do not count as present."""
    base, late = base_and_late(t)
    keys = ["folio", "person", "day"]
    there = F.col("extract").isNotNull()
    return supplements.supplement_by_keys(base, late, keys, ("base", "late"), present=there)


@query(KEY_SUPPLEMENT + """
    , both_ AS (SELECT *, 'base' AS source FROM base UNION ALL SELECT *, 'late' FROM missing)
    SELECT folio, person, status, strftime(day, '%Y-%m-%d') AS day, extract, source FROM both_
""")
def i6_supplement_by_keys(t: Tables):
    return base_with_late(t).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(KEY_SUPPLEMENT + """
    SELECT count(*) AS total, count(b.folio) AS matched, count(*) - count(b.folio) AS missing
    FROM late l LEFT JOIN there b ON l.folio = b.folio AND l.person = b.person AND l.day = b.day
""")
def i6_match_audit(t: Tables):
    base, late = base_and_late(t)
    there = base.filter(F.col("extract").isNotNull())
    return match_audit(late, there, ["folio", "person", "day"])


@query(KEY_SUPPLEMENT + """
    , both_ AS (SELECT person, 'base' AS source FROM base UNION ALL SELECT person, 'late' FROM missing)
    SELECT source, count(*) AS n, count(*) - count(person) AS missing_person FROM both_ GROUP BY 1
""")
def i6_source_audit(t: Tables):
    return supplements.source_audit(base_with_late(t), ["person"])


@query(KEY_SUPPLEMENT + """
    , both_ AS (SELECT 'base' AS source FROM base UNION ALL SELECT 'late' FROM missing)
    SELECT source, count(*) AS n FROM both_ GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*) FROM both_
""")
def i6_totals_by_source(t: Tables):
    return with_group_total(frequency(base_with_late(t), ["source"]), "source", "n")


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS visit_date,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'general' ELSE 'especialidad' END AS kind
    FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) = 1999
""")
def i6_usable_consultations(t: Tables):
    services = {"1-URGENT": "MG01", "2-HIGH": "PREC", "3-MEDIUM": "2201", "5-LOW": "3301"}
    status = F.col("o_orderstatus")
    late = t.orders.select(
        "o_orderkey",
        F.when(status == "P", fixed.NO_SHOW).when(status == "O", "Atendida").alias("status"),
        lookup_value("o_orderpriority", services).alias("service"),
        F.col("o_orderdate").cast("string").alias("time"),
    )
    out = supplements.usable_consultations(late, "status", "service", "time", 1999)
    return out.select("o_orderkey", F.col("visit_date").cast("string").alias("visit_date"), "kind")


@query("""
    WITH v AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT 'inserted' AS rule, o_orderkey, strftime(d, '%Y-%m-%d') AS inserted FROM v WHERE o_orderstatus <> 'P' AND d <= DATE '1998-06-30'
    UNION ALL SELECT 'any', o_orderkey, strftime(d, '%Y-%m-%d') FROM v WHERE d <= DATE '1998-06-30'
""")
def i6_dated_until(t: Tables):
    inserted = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    visits = t.orders.select("o_orderkey", inserted.alias("inserted"), F.col("o_orderdate").alias("visited"))
    cut = F.lit("1998-06-30").cast("date")
    rules = {
        name: supplements.dated_until(visits, "inserted", "visited", cut, required)
        for name, required in (("inserted", True), ("any", False))
    }
    out = stack_labelled(rules, "rule").select("rule", "o_orderkey", "inserted")
    return out.withColumn("inserted", F.col("inserted").cast("string"))


def discharges(t: Tables):
    day = F.col("o_orderdate").cast("date").alias("discharged")
    base = t.orders.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", day, F.col("o_orderdate").alias("inserted"), F.lit("A00").alias("code")
    )
    person = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey")
    late = t.orders.select("o_orderkey", person, day, F.col("o_orderpriority").alias("diagnosis"))
    return supplements.supplement_on_shared(
        base,
        late,
        ["o_orderkey", "o_custkey", "discharged"],
        ("final", "ece"),
        extra={
            "code": (F.col("code"), F.col("diagnosis")),
            "inserted": (F.col("inserted").cast("date"), F.col("discharged")),
        },
    )


@query("""
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS discharged, strftime(o_orderdate, '%Y-%m-%d') AS inserted,
      CASE o_orderstatus WHEN 'F' THEN 'A00' ELSE o_orderpriority END AS code, CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'ece' END AS source
    FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def i7_supplement_on_shared(t: Tables):
    both = discharges(t)
    dates = {c: F.date_format(c, "yyyy-MM-dd") for c in ("discharged", "inserted")}
    return both.withColumns(dates)


@query("""
    SELECT count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS before, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS added,
           count(*) AS total FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def i7_before_and_added(t: Tables):
    return supplements.before_and_added(discharges(t), ("final", "ece"))


# --- I8: exchange report ---------------------------------------------------------

LINES = [
    ("Personas atendidas", "persons", None),
    ("Atenciones ofrecidas", "records", None),
    ("", "blank", None),
    ("Personas en consulta", "persons", "orders"),
    ("Consultas", "records", "orders"),
    ("", "blank", None),
    ("Personas en urgencias", "persons", "events"),
    ("Atenciones", "records", "events"),
    ("", "blank", None),
    ("Eventos", "records", "items"),
]

MODULES = CODED + """
    , m AS (SELECT 'orders' AS module, o_orderpriority AS facility, CAST(o_custkey AS VARCHAR) AS person, NOT regexp_matches(code, '^0.*ND$') AS cov,
                   regexp_matches(code, '^0.*ND$') AS ncov FROM o
      UNION ALL SELECT 'events', event_type, CAST(user_id AS VARCHAR), flag IN ('Si', 'Sí'), flag = 'No' FROM e
      UNION ALL SELECT 'items', CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR), l_returnflag <> 'N', l_returnflag = 'N' FROM lineitem),
    p AS (SELECT module, count(DISTINCT facility) AS facilities, count(*) AS records, count(CASE WHEN cov THEN 1 END) AS covered,
                 round_even(avg(CAST(ncov AS DOUBLE)) * 100, 2) AS percent_not_covered, count(DISTINCT person) AS persons FROM m GROUP BY 1)
"""


def service_modules(t: Tables):
    orders, events = coded(t)
    returned = F.col("l_returnflag")
    return {
        "orders": reports.Module(orders, "o_orderpriority", *reports.covered_by_code("code"), "o_custkey"),
        "events": reports.Module(events, "event_type", *reports.covered_by_flag("flag"), "user_id"),
        "items": reports.Module(t.lineitem, "l_suppkey", returned != "N", returned == "N", "l_partkey"),
    }


@query(MODULES + """
    , a AS (SELECT CAST(sum(records) AS BIGINT) AS r, CAST(sum(covered) AS BIGINT) AS c, (SELECT count(DISTINCT person) FROM m) AS p FROM p),
    l(position, label, kind, module) AS (VALUES (1, 'Personas atendidas', 'pa', ''), (2, 'Atenciones ofrecidas', 'ra', ''), (3, '', 'b', ''),
      (4, 'Personas en consulta', 'p', 'orders'), (5, 'Consultas', 'r', 'orders'), (6, '', 'b', ''), (7, 'Personas en urgencias', 'p', 'events'),
      (8, 'Atenciones', 'r', 'events'), (9, '', 'b', ''), (10, 'Eventos', 'r', 'items'))
    SELECT position, label,
      CASE kind WHEN 'pa' THEN format('{:,}', a.p) WHEN 'ra' THEN format('{:,}', a.r) WHEN 'p' THEN format('{:,}', persons) WHEN 'r' THEN format('{:,}', records) ELSE '' END AS total,
      CASE kind WHEN 'ra' THEN format('{:,} ({}%)', a.c, CAST(round_even(a.c / a.r * 100, 0) AS INTEGER))
        WHEN 'r' THEN format('{:,} ({}%)', covered, CAST(round_even(covered / records * 100, 0) AS INTEGER)) WHEN 'b' THEN '' ELSE '---' END AS covered
    FROM l LEFT JOIN p USING (module), a
""")
def i8_exchange_report(t: Tables):
    return reports.exchange_report(service_modules(t), LINES)


@query(MODULES + """
    SELECT module, '- ' || module || ': ' || facilities || ' clues, ' || records || ' registros y ' || percent_not_covered || '% de no derechohabiencia' AS text FROM p
""")
def i8_profile_sentences(t: Tables):
    return reports.profile_sentences(reports.module_profile(service_modules(t)))


# --- I9, I10: series ----------------------------------------------------------------

WEEKLY = """
    WITH x AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, l_linenumber, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS room,
        CASE p_type WHEN 'PROMO' THEN 'Q' WHEN 'ECONOMY' THEN 'T' WHEN 'STANDARD' THEN 'D' WHEN 'SMALL' THEN NULL ELSE 'X' END AS kind
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')),
    ev AS (SELECT l_orderkey, day, strftime(date_trunc('week', day), '%Y-%m-%d') AS week, coalesce(bool_or((kind IN ('T', 'D') AND room = 1) OR kind = 'Q'), false) AS surgical,
        count(DISTINCT l_linenumber) AS procedures, count(CASE WHEN kind IN ('T', 'D') THEN 1 END) AS td, count(CASE WHEN kind = 'Q' THEN 1 END) AS q,
        count(CASE WHEN kind IN ('T', 'D') AND room = 1 THEN 1 END) AS td_in, count(CASE WHEN kind IN ('T', 'D') AND room <> 1 THEN 1 END) AS td_out,
        count(CASE WHEN kind = 'Q' AND room = 1 THEN 1 END) AS q_in, count(CASE WHEN kind = 'Q' AND room <> 1 THEN 1 END) AS q_out
      FROM x GROUP BY 1, 2, 3)
"""


def surgical_events(t: Tables):
    flag = F.col("l_returnflag")
    procedures = t.lineitem.select(
        F.col("l_orderkey").alias("folio"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_linenumber").alias("number"),
        F.when(flag == "A", 1).when(flag == "N", 0).alias("in_room"),
        F.col("l_partkey").alias("code"),
    )
    kinds = {"PROMO": "Q", "ECONOMY": "T", "STANDARD": "D", "MEDIUM": "X", "LARGE": "X"}
    catalogue = t.part.select("p_partkey", lookup_value("p_type", kinds).alias("kind"))
    stays = t.orders.filter(F.col("o_orderstatus") != "P")
    classified = series.classify_procedures(
        procedures, stays, catalogue, [("folio", "o_orderkey")], ("code", "p_partkey"), "day", "in_room",
        unique_stays=True,
    )
    return series.summarise_events(classified, ["folio", "day"], "number", "in_room")


def with_week_text(df):
    return df.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@query(WEEKLY + """
    SELECT week, count(*) AS events, count(CASE WHEN surgical THEN 1 END) AS surgical_events,
           count(CASE WHEN NOT surgical THEN 1 END) AS other_events FROM ev GROUP BY 1
""")
def i9_weekly_events(t: Tables):
    return with_week_text(series.weekly_events(surgical_events(t)))


@query(WEEKLY + """
    SELECT week, count(*) AS events, CAST(sum(procedures) AS BIGINT) AS procedures, CAST(sum(td) AS BIGINT) AS td, CAST(sum(q) AS BIGINT) AS q
    FROM ev WHERE surgical GROUP BY 1
""")
def i9_weekly_procedures(t: Tables):
    return with_week_text(series.weekly_procedures(surgical_events(t)))


@query(WEEKLY + """
    SELECT week, CAST(sum(td_in) AS BIGINT) AS td_in, CAST(sum(q_in) AS BIGINT) AS q_in, CAST(sum(td_out) AS BIGINT) AS td_out,
           CAST(sum(q_out) AS BIGINT) AS q_out FROM ev WHERE surgical GROUP BY 1
""")
def i9_weekly_room_split(t: Tables):
    return with_week_text(series.weekly_room_split(surgical_events(t)))


CUBE = """
    WITH members AS (SELECT DISTINCT k FROM (SELECT s_suppkey AS k FROM supplier WHERE s_nationkey < 8
                       UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000)),
    cube AS (SELECT CASE WHEN l_tax > 0 THEN l_suppkey END AS k, CAST(year(l_shipdate) AS INTEGER) AS year, date_trunc('month', l_shipdate) AS m, l_quantity FROM lineitem
             WHERE l_linenumber <> 7),
    s AS (SELECT year, m, CASE WHEN k IN (SELECT k FROM members) THEN 'in' ELSE 'out' END AS origin, sum(l_quantity) AS total FROM cube GROUP BY 1, 2, 3)
"""


def cube_series(t: Tables):
    names = F.array(*[F.lit(m) for m in fixed.MONTHS])
    month = F.when(F.col("l_linenumber") == 7, fixed.UNKNOWN_MONTH)
    cube = t.lineitem.select(
        F.when(F.col("l_tax") > 0, F.col("l_suppkey")).alias("facility"),
        F.year("l_shipdate").alias("year"),
        month.otherwise(F.element_at(names, F.month("l_shipdate"))).alias("month"),
        "l_quantity",
    )
    sites = t.supplier.select(
        F.when(F.col("s_nationkey") < 8, F.col("s_suppkey")).alias("one"),
        F.when(F.col("s_acctbal") > 9000, F.col("s_suppkey")).alias("two"),
    )
    members = distinct_values(sites, ["one", "two"], "facility")
    return series.monthly_series(
        cube, members, ("facility", "facility"), "year", "month", "l_quantity", ("in", "out")
    )


@query(CUBE + """
    SELECT year, strftime(m, '%Y-%m-%d') AS date, origin, total FROM s
""")
def i10_monthly_series(t: Tables):
    out = cube_series(t).select("year", "date", "origin", "total")
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(CUBE + """
    SELECT year, origin, format('{:,}', CAST(round_even(total / 1000, 0) AS BIGINT)) AS label FROM s WHERE month(m) = 7
""")
def i10_month_labels(t: Tables):
    return series.month_labels(cube_series(t)).select("year", "origin", "label")


@query(CUBE + """,
    t AS (SELECT origin AS series, CAST(m AS DATE) AS date, CAST(CAST(m AS DATE) - DATE '1970-01-01' AS DOUBLE) AS x, CAST(total AS DOUBLE) AS y FROM s),
    n AS (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM t),
    pairs AS (SELECT a.series, a.date, a.x, a.n, b.x AS bx, b.y AS v, abs(b.x - a.x) AS d,
                     row_number() OVER (PARTITION BY a.series, a.x ORDER BY abs(b.x - a.x), b.x) AS r
              FROM n a JOIN n b USING (series)),
    h AS (SELECT series, x, max(CASE WHEN r = floor(n * 0.35 + 1e-5) THEN d END) AS h FROM pairs GROUP BY 1, 2),
    w AS (SELECT p.series, p.date, (bx - p.x) / h AS u, v, pow(1 - pow(abs((bx - p.x) / h), 3), 3) AS w
          FROM pairs p JOIN h ON p.series = h.series AND p.x = h.x WHERE d < h),
    k AS (SELECT series, date, sum(w) AS s0, sum(w*u) AS s1, sum(w*u*u) AS s2, sum(w*u*u*u) AS s3, sum(w*u*u*u*u) AS s4,
                 sum(w*v) AS t0, sum(w*u*v) AS t1, sum(w*u*u*v) AS t2 FROM w GROUP BY 1, 2)
    SELECT series AS origin, date, round((t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2))
                    / (s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2)), 3) AS trend FROM k
""")
def i10_series_trend(t: Tables):
    monthly = cube_series(t).withColumn("day", F.unix_date("date"))
    fitted = local_regression(monthly, ["origin"], "day", "total")
    return fitted.select("origin", "date", F.round("trend", 3).alias("trend"))


@query(CUBE + """,
    m AS (SELECT origin AS series, CAST(CAST(m AS DATE) - DATE '1970-01-01' AS DOUBLE) AS x, CAST(total AS DOUBLE) / 1000 AS y FROM s),""" + GRID + """
    SELECT series AS origin, place, round(gx, 3) AS day,
      round(fit*(1+2*u)*(1-u)*(1-u) + slope*(x2-x)*u*(1-u)*(1-u) + fit2*u*u*(3-2*u) + slope2*(x2-x)*u*u*(u-1), 3) AS trend FROM g
""")
def i10_drawn_trend(t: Tables):
    monthly = cube_series(t).select(
        "origin", F.unix_date("date").alias("day"), (F.col("total") / 1000).alias("thousands")
    )
    grid = regression_grid(monthly, ["origin"], "day", "thousands", span=0.35, points=80)
    return grid.select("origin", "place", F.round("day", 3).alias("day"), F.round("trend", 3).alias("trend"))


# --- I11, I12, I14, I15: teams ----------------------------------------------------------

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

TEAMS = """
    WITH people AS (SELECT c_custkey, r_name AS state, n_name || '-' || c_custkey // 250 AS cluster, c_mktsegment AS position FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    c AS (SELECT state, cluster, count(DISTINCT CASE WHEN position = 'AUTOMOBILE' THEN c_custkey END) AS AUTOMOBILE,
      count(DISTINCT CASE WHEN position = 'BUILDING' THEN c_custkey END) AS BUILDING, count(DISTINCT CASE WHEN position = 'FURNITURE' THEN c_custkey END) AS FURNITURE,
      count(DISTINCT CASE WHEN position = 'HOUSEHOLD' THEN c_custkey END) AS HOUSEHOLD, count(DISTINCT CASE WHEN position = 'MACHINERY' THEN c_custkey END) AS MACHINERY
      FROM people GROUP BY 1, 2),
    d AS (SELECT *, least(AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY) AS teams FROM c),
    f AS (SELECT *, list_filter(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], lambda x, i: [AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY][i] - teams < 1) AS spent,
        CAST(CASE WHEN AUTOMOBILE + BUILDING + FURNITURE + HOUSEHOLD + MACHINERY > 5 * teams THEN 1 ELSE 0 END AS INTEGER) AS incomplete FROM d),
    g AS (SELECT *, CASE WHEN len(spent) = 5 THEN '' ELSE array_to_string(spent, ', ') END AS roles_without_surplus FROM f)
"""


def small_cluster(nation: str, key: str, size: int):
    """Clusters finer than a nation, as many as the keys ask for, so that some are short of a position."""
    return F.concat_ws("-", nation, F.floor(F.col(key) / size).cast("string"))


def team_people(t: Tables):
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")])
    people = lookup(t.customer, places, [("c_nationkey", "n_nationkey")])
    return people.select(
        "c_custkey",
        "c_name",
        F.col("r_name").alias("state"),
        small_cluster("n_name", "c_custkey", 250).alias("cluster"),
        F.col("c_mktsegment").alias("position"),
    )


def formed_teams(t: Tables):
    return teams.form_teams(
        team_people(t), ["state", "cluster"], "position", "c_custkey", SEGMENTS
    )


@query(TEAMS + """
    SELECT state, cluster, AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY, teams, incomplete, roles_without_surplus FROM g
""")
def i11_form_teams(t: Tables):
    return formed_teams(t).drop("roles_short")


@query(TEAMS + """
    SELECT state, cluster, least(BUILDING, FURNITURE, MACHINERY) AS teams FROM c
""")
def i11_teams_of_fewer_positions(t: Tables):
    formed = teams.form_teams(
        team_people(t), ["state", "cluster"], "position", "c_custkey", SEGMENTS,
        needed=["BUILDING", "FURNITURE", "MACHINERY"], distinct=False,
    )
    return formed.select("state", "cluster", "teams")


@query(TEAMS + """
    SELECT c_custkey, p.state, p.cluster, coalesce(teams, 0) AS teams, coalesce(incomplete, 0) AS incomplete,
      CAST(CASE WHEN teams >= 1 THEN 1 ELSE 0 END AS INTEGER) AS forms_team, coalesce(roles_without_surplus, '') AS roles_without_surplus
    FROM (SELECT c_custkey, n_name || '-' || c_custkey // 250 AS cluster, r_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) p LEFT JOIN g USING (state, cluster)
""")
def i12_attach_teams(t: Tables):
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")])
    people = lookup(t.customer, places, [("c_nationkey", "n_nationkey")]).select(
        "c_custkey", F.col("r_name").alias("state"), small_cluster("n_name", "c_custkey", 250).alias("cluster")
    )
    return teams.attach_teams(people, formed_teams(t), ["state", "cluster"])


DEDUPE = """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey AS link, l_quantity FROM lineitem),
    k AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM r),
    good AS (SELECT l_orderkey, l_linenumber, min(link) AS best FROM k JOIN part ON p_partkey = link WHERE n > 1 AND p_size > 25 GROUP BY 1, 2),
    f AS (SELECT k.*, n = 1 OR coalesce(link = best, false) AS keep FROM k LEFT JOIN good USING (l_orderkey, l_linenumber))
"""


def deduped(t: Tables):
    records = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("link"), "l_quantity"
    )
    works = (F.col("p_size") > 25).alias("works")
    status = t.part.select(F.col("p_partkey").alias("link"), works)
    known = t.orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey")
    return candidates.dedupe_by_status(
        records,
        ["l_orderkey", "l_linenumber"],
        "link",
        status,
        original=records,
        original_keys=["l_orderkey", "l_linenumber"],
        valid_sites=known,
        site=("l_orderkey", "o_orderkey"),
    )


@query(DEDUPE + """
    SELECT l_orderkey, l_linenumber, link, l_quantity FROM f WHERE keep
""")
def i13_dedupe_by_link(t: Tables):
    return deduped(t)["kept"].drop("duplicates")


@query(DEDUPE + """
    , x AS (SELECT 'Duplicado eliminado porque el link no abre' AS reason, l_quantity FROM f WHERE NOT keep
      UNION ALL SELECT CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') THEN 'Se eliminó en filtros posteriores'
             ELSE 'CLUES no pertenece a base_alex / no es ancla' END, l_quantity FROM r
           WHERE NOT EXISTS (SELECT 1 FROM f WHERE keep AND f.l_orderkey = r.l_orderkey AND f.l_linenumber = r.l_linenumber))
    SELECT reason, count(*) AS n, sum(l_quantity) AS quantity FROM x GROUP BY 1
""")
def i13_removed_with_reason(t: Tables):
    return deduped(t)["removed"].groupBy("reason").agg(
        n_rows().alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query(TEAMS + """
    SELECT state, cluster, 'No arma team QX' AS forms_team, s_suppkey AS site, teams, roles_without_surplus FROM g
    LEFT JOIN (SELECT s_suppkey, n_name || '-' || s_suppkey // 17 AS c FROM supplier JOIN nation ON s_nationkey = n_nationkey) ON c = cluster WHERE teams < 1
""")
def i14_missing_teams(t: Tables):
    sites = lookup(t.supplier, t.nation, [("s_nationkey", "n_nationkey")])
    sites = sites.select(small_cluster("n_name", "s_suppkey", 17).alias("cluster"), F.col("s_suppkey").alias("site"))
    missing = teams.missing_teams(formed_teams(t), sites, ["cluster"])
    return missing.select("state", "cluster", "forms_team", "site", "teams", "roles_without_surplus")


@query("""
    WITH a AS (SELECT CASE n_name WHEN 'NATION_0' THEN 'VERACRUZ DE IGNACIO DE LA LLAVE' ELSE n_name END AS state, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    b AS (SELECT CASE state WHEN 'VERACRUZ DE IGNACIO DE LA LLAVE' THEN 'Veracruz' ELSE upper(state[1]) || lower(state[2:]) END AS state, count(DISTINCT s_suppkey) AS clusters FROM a GROUP BY 1),
    p AS (SELECT CASE n_name WHEN 'NATION_0' THEN 'Veracruz' ELSE upper(n_name[1]) || lower(n_name[2:]) END AS state, c_mktsegment AS s FROM customer JOIN nation ON c_nationkey = n_nationkey),
    q AS (SELECT state, least(count(CASE WHEN s = 'AUTOMOBILE' THEN 1 END), count(CASE WHEN s = 'BUILDING' THEN 1 END), count(CASE WHEN s = 'FURNITURE' THEN 1 END),
       count(CASE WHEN s = 'HOUSEHOLD' THEN 1 END), count(CASE WHEN s = 'MACHINERY' THEN 1 END)) AS teams FROM p GROUP BY 1)
    SELECT state, teams, clusters, clusters - teams AS teams_missing FROM q JOIN b USING (state)
""")
def i15_team_gap(t: Tables):
    names = F.when(F.col("n_name") == "NATION_0", "VERACRUZ DE IGNACIO DE LA LLAVE").otherwise(F.col("n_name"))
    nations = t.nation.select("n_nationkey", names.alias("entity"))
    anchors = lookup(t.supplier, nations, [("s_nationkey", "n_nationkey")])
    people = lookup(t.customer, nations, [("c_nationkey", "n_nationkey")])
    people = people.withColumn("state", teams.state_name("entity"))
    formed = teams.form_teams(people, ["state"], "c_mktsegment", "c_custkey", SEGMENTS)
    gap = teams.team_gap(formed.select("state", "teams"), anchors, "state", "entity", "s_suppkey")
    return gap.select("state", "teams", "clusters", "teams_missing")


# --- I16 - I18: candidates ------------------------------------------------------------------

CANDIDATES = f"""
    WITH c AS (SELECT c_custkey, c_acctbal, c_mktsegment, c_name, {person_key('c_custkey', 'c_mktsegment')} AS key FROM customer),
    keyed AS (SELECT *, upper(regexp_replace(key, '[^A-Za-z0-9]', '', 'g')) AS key_clean FROM c),
    reg AS (SELECT o_orderkey, 'F' || o_orderpriority[1] AS facility, CASE o_orderstatus WHEN 'O' THEN 'MATUTINO' ELSE 'Equipo ITINERANTE' END AS shift,
        CASE WHEN o_totalprice > 250000 THEN 3 ELSE 1 END AS phase, 'L' || o_orderkey AS link, o_totalprice > 100000 AS works, key, key_clean,
        CASE WHEN year(o_orderdate) < 1998 THEN 'PA020' WHEN year(o_orderdate) < 2000 THEN 'PA022' WHEN year(o_orderdate) < 2001 THEN 'ME001' ELSE 'ZZ' END AS role,
        CASE WHEN month(o_orderdate) < 5 THEN NULL WHEN month(o_orderdate) < 9 THEN 'APROBADO' ELSE 'RECHAZADO' END AS status
      FROM orders JOIN keyed ON o_custkey = c_custkey),
    f AS (SELECT * FROM reg WHERE (key_clean IS NULL OR key_clean NOT IN (SELECT key_clean FROM keyed WHERE c_acctbal < 0 AND key_clean IS NOT NULL))
      AND NOT (key_clean IS NULL AND EXISTS (SELECT 1 FROM keyed WHERE c_acctbal < 0 AND key_clean IS NULL))
      AND (shift ILIKE '%itinerante%' OR (phase = 3 AND facility IN ('F1', 'F2'))) AND role <> 'ZZ' AND coalesce(status, 'APROBADO') = 'APROBADO'),
    l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY facility, phase, shift, key, role, status ORDER BY link) = 1),
    one AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY key, facility ORDER BY CASE WHEN status = 'APROBADO' THEN 1 ELSE 2 END, CASE WHEN works THEN 1 ELSE 2 END, link) = 1),
    cl AS (SELECT *, 'K' || facility AS cluster FROM one WHERE facility <> 'F5'),
    names AS (SELECT cl.*, c_name, CASE WHEN c_acctbal > 5000 THEN c_name WHEN c_acctbal > 2000 THEN c_name || ' ' || c_mktsegment END AS name, coalesce(c_acctbal > 5000, false) AS previous,
        regexp_full_match(cl.key_clean, '[A-Z]{{4}}[0-9]{{6}}[HM][A-Z]{{5}}[A-Z0-9]{{2}}') AS ok, coalesce(c_acctbal > 2000 AND c_acctbal <= 5000, false) AS found
      FROM cl LEFT JOIN keyed USING (key_clean))
"""


def prepared(t: Tables):
    key = person_key_column("c_custkey", "c_mktsegment")
    people = t.customer.withColumn("key", key)
    orders = lookup(t.orders, people.select("c_custkey", "key"), [("o_custkey", "c_custkey")])
    facility = F.concat(F.lit("F"), F.substring("o_orderpriority", 1, 1))
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    code = F.when(year < 1998, "OP057").when(year < 2000, None).when(year < 2001, "ME001")
    words = F.when((year >= 1998) & (year < 2000), " chofer Polivalente").otherwise("otro ")
    register = orders.select(
        F.lit("Estado").alias("state"),
        facility.alias("facility"),
        F.when(F.col("o_orderstatus") == "O", "MATUTINO").otherwise("Equipo ITINERANTE").alias("shift"),
        F.when(F.col("o_totalprice") > 250000, 3).otherwise(1).alias("phase"),
        F.concat(F.lit("L"), F.col("o_orderkey")).alias("link"),
        "key",
        code.otherwise("ZZ").alias("role_code"),
        words.alias("role_text"),
        F.when(month < 5, None).when(month < 9, "aprobado ").otherwise("RECHAZADO").alias("status"),
    )
    links = t.orders.select(
        F.concat(F.lit("L"), F.col("o_orderkey")).alias("link"),
        (F.col("o_totalprice") > 100000).alias("works"),
    )
    make = partial(literal_table, t.spark)
    clusters = [(f"F{i}", f"KF{i}", None, f"Sitio {i}") for i in range(1, 5)]
    balance = F.col("c_acctbal")
    cleaned = people.withColumn("key_clean", F.upper(F.regexp_replace("key", "[^A-Za-z0-9]", "")))
    looked_up = cleaned.filter((balance > 2000) & (balance <= 5000)).select(
        "key_clean",
        F.col("c_name").alias("first_names"),
        F.col("c_mktsegment").alias("surname_1"),
        F.lit(None).cast("string").alias("surname_2"),
    )
    return candidates.prepare_candidates(
        register,
        placed=people.filter(balance < 0),
        anchors=make([("F1",), ("F2",)], "facility string"),
        roles=make([("PA020", "Chofer"), ("ME001", "Anestesiólogo")], "role string, role_name string"),
        link_status=links,
        clusters=make(
            clusters, "facility string, cluster string, cluster_state string, site_name string"
        ),
        previous_names=people.filter(balance > 5000).select("key", F.col("c_name").alias("name")),
        looked_up=looked_up,
    )


@query(CANDIDATES + """
    SELECT link, facility, cluster, key_clean, role, status, name, previous AS name_recovered, found AS lookup_found FROM names
    WHERE NOT (coalesce(ok, false) AND NOT found AND name IS NULL)
""")
def i16_prepare_candidates(t: Tables):
    return prepared(t)["candidates"].select(
        "link", "facility", "cluster", "key_clean", "role", "status", "name", "name_recovered", "lookup_found"
    )


@query(CANDIDATES + """
    SELECT CASE WHEN coalesce(ok, false) THEN CASE WHEN previous THEN 'Nombre recuperado de base previa' WHEN found THEN 'CURP encontrada en endpoint'
         ELSE 'CURP válida en formato, no encontrada en endpoint' END
       WHEN length(key_clean) <> 18 THEN 'Longitud distinta de 18' WHEN key_clean IS NULL THEN CASE WHEN previous THEN 'Nombre recuperado de base previa' ELSE 'CURP válida en formato, no encontrada en endpoint' END
       ELSE 'Formato inválido' END AS lookup_status, count(*) AS n FROM names GROUP BY 1
""")
def i16_lookup_counts(t: Tables):
    return prepared(t)["lookup_counts"]


REQUIRED = [
    ("BUILDING", "B1", "Albañil"),
    ("MACHINERY", "M1", "Mecánico"),
    ("MACHINERY", "M1", "Mecánico"),
    ("FURNITURE", "F1", "Carpintero"),
]

SLOTS = """
    WITH need(position, required_role, title, slot, o) AS (VALUES ('BUILDING', 'B1', 'Albañil', 1, 1), ('MACHINERY', 'M1', 'Mecánico', 1, 2),
        ('MACHINERY', 'M1', 'Mecánico', 2, 3), ('FURNITURE', 'F1', 'Carpintero', 1, 4)),
    cand AS (SELECT n_name || '-' || c_custkey // 250 AS cluster, n_regionkey AS region, c_mktsegment AS position, CASE WHEN c_acctbal > 5000 THEN 'B1' ELSE 'B2' END AS role,
        CASE WHEN c_acctbal > 6000 THEN 'APROBADO' WHEN c_acctbal > 3000 THEN NULL ELSE 'RECHAZADO' END AS status, c_name AS name, CAST(c_custkey AS VARCHAR) AS key,
        'Carpeta/' || c_custkey AS link, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment || ' ' || c_custkey % 3 END AS job
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
    clusters AS (SELECT DISTINCT cluster, region FROM cand),
    u AS (SELECT *, row_number() OVER (PARTITION BY cluster, position ORDER BY CASE WHEN status = 'APROBADO' THEN 1 ELSE 2 END, CASE role WHEN 'B2' THEN 2 ELSE 1 END, name, key) AS slot
          FROM cand WHERE status IS NULL OR status = 'APROBADO'),
    slots AS (SELECT clusters.cluster AS cluster, clusters.region AS region, need.position AS position, need.slot AS slot, title, o, required_role, role, name, key, link, job, key IS NOT NULL AS filled
      FROM clusters CROSS JOIN need LEFT JOIN u ON u.cluster = clusters.cluster AND u.position = need.position AND u.slot = need.slot),
    audit AS (SELECT u.*, CASE WHEN key IN (SELECT key FROM slots WHERE filled) THEN 'Asignado en base' ELSE 'No asignado en base' END AS result FROM u)
"""


def slot_candidates(t: Tables):
    """Every customer; statuses and roles as typed by hand, with blanks and small letters."""
    people = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")])
    balance = F.col("c_acctbal")
    return people.select(
        F.concat(small_cluster("n_name", "c_custkey", 250), F.lit(" ")).alias("cluster"),
        F.col("c_mktsegment").alias("position"),
        F.when(balance > 5000, " b1").otherwise("B2 ").alias("role"),
        F.when(balance > 6000, "aprobado ").when(balance <= 3000, "RECHAZADO").alias("status"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").cast("string").alias("key"),
        F.concat(F.lit("Carpeta/"), "c_custkey").alias("link"),
        F.when(
            F.col("c_custkey") % 4 > 0,
            F.concat_ws(" ", "c_mktsegment", F.col("c_custkey") % 3),
        ).alias("title"),
    )


def slot_clusters(t: Tables):
    people = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")])
    cluster = small_cluster("n_name", "c_custkey", 250).alias("cluster")
    return people.select(cluster, F.col("n_regionkey").alias("region")).distinct()


def allocated(t: Tables):
    return candidates.allocate_slots(
        slot_clusters(t), slot_candidates(t), REQUIRED, second_choice=["B2"]
    )


@query(SLOTS + """
    SELECT cluster, position, slot, coalesce(role, required_role) AS final_role, coalesce(job, title) AS final_title, name, key, link, filled,
      CASE WHEN filled THEN 'Cubierto con candidato UAS' ELSE 'Vacante / sin candidato UAS' END AS occupation FROM slots
""")
def i17_slots(t: Tables):
    return allocated(t)["slots"].select(
        "cluster",
        "position",
        "slot",
        "final_role",
        "final_title",
        "name",
        "key",
        "link",
        "filled",
        "occupation",
    )


@query(r"""
    WITH layer AS (SELECT CASE WHEN c_custkey % 11 > 0 THEN n_name || '_' || c_custkey // 250 || CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE '' END END AS name, c_mktsegment AS site
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
    done AS (SELECT n_name || '_' || s_suppkey % 3 AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    waiting AS (SELECT trim(name) AS cluster, regexp_replace(name, '_\d+$', '') AS anchor, site FROM layer WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM done))
    SELECT cluster, anchor, CAST(nullif(regexp_extract(cluster, '\d+$'), '') AS INTEGER) AS cluster_order, site FROM waiting WHERE cluster <> ''
    QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY anchor, site) = 1
""")
def i17_prepared_clusters(t: Tables):
    people = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")])
    number = F.floor(F.col("c_custkey") / 250)
    blank = F.when(F.col("c_custkey") % 7 == 0, " ").otherwise("")
    typed = F.concat("n_name", F.lit("_"), number, blank)
    layer = people.select(
        F.when(F.col("c_custkey") % 11 > 0, typed).alias("cluster_name"),
        F.col("c_mktsegment").alias("site"),
    )
    done = lookup(t.supplier, t.nation, [("s_nationkey", "n_nationkey")])
    done = done.select(F.concat("n_name", F.lit("_"), F.col("s_suppkey") % 3).alias("cluster"))
    return candidates.prepare_clusters(layer, done)


@query("""
    WITH roles(segment, role, position) AS (VALUES ('AUTOMOBILE', 'MG001', 'Medicina General'), ('BUILDING', 'ME001', 'Anestesiologia'),
        ('FURNITURE', 'EN002', 'Enfermeria quirurgica'), ('HOUSEHOLD', 'PA020', 'Chofer'))
    SELECT c_custkey, role, position FROM customer JOIN roles ON c_mktsegment = segment
""")
def i17_candidates_by_position(t: Tables):
    codes = {"AUTOMOBILE": "MG001", "BUILDING": "ME001", "FURNITURE": "EN002", "HOUSEHOLD": "PA020"}
    role = lookup_value("c_mktsegment", codes)
    people = t.customer.select("c_custkey", F.coalesce(role, "c_mktsegment").alias("role"))
    return candidates.candidates_by_position(people)


@query(SLOTS + """
    SELECT count(*) AS total, count(DISTINCT cluster) AS clusters, count(CASE WHEN filled THEN 1 END) AS filled,
           count(CASE WHEN NOT filled THEN 1 END) AS vacant FROM slots
""")
def i17_summary(t: Tables):
    return allocated(t)["summary"]


@query(SLOTS + """
    SELECT position, CASE WHEN filled THEN 'Cubierto con candidato UAS' ELSE 'Vacante / sin candidato UAS' END AS occupation, count(*) AS n FROM slots GROUP BY 1, 2
""")
def i17_by_position(t: Tables):
    return allocated(t)["by_position"]


@query(SLOTS + """
    SELECT n, count(*) AS groups FROM (SELECT count(*) AS n FROM slots GROUP BY cluster) GROUP BY 1
""")
def i17_rows_per_cluster(t: Tables):
    return allocated(t)["rows_per_cluster"]


@query(SLOTS + """
    SELECT cluster, region, count(*) AS required, count(CASE WHEN filled THEN 1 END) AS filled, count(CASE WHEN NOT filled THEN 1 END) AS vacant,
           coalesce(string_agg(CASE WHEN NOT filled THEN title END, ', ' ORDER BY o), '') AS vacant_titles FROM slots GROUP BY 1, 2
""")
def i17_by_cluster(t: Tables):
    return allocated(t)["by_cluster"]


@query(SLOTS + """
    SELECT result, position, count(*) AS n FROM audit GROUP BY 1, 2
""")
def i17_audit_counts(t: Tables):
    return allocated(t)["audit_counts"]


@query(SLOTS + """
    SELECT cluster, position, key, name FROM audit WHERE result = 'No asignado en base'
""")
def i17_unassigned(t: Tables):
    return allocated(t)["unassigned"].select("cluster", "position", "key", "name")


def complete_people(people):
    """Everyone in a cluster that forms a complete team."""
    return teams.complete_members(people, ["state", "cluster"], "position", "c_custkey", SEGMENTS)


@query(TEAMS + SLOTS.replace("WITH", ",", 1) + """
    , done AS (SELECT cluster, CAST(c_custkey AS VARCHAR) AS key, c_name AS name, 'complete' AS team
               FROM people JOIN customer USING (c_custkey) WHERE cluster IN (SELECT cluster FROM g WHERE teams >= 1)),
    rest AS (SELECT cluster, key, name, position FROM slots s WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.cluster = s.cluster AND done.key = s.key))
    SELECT cluster, key, name, position, NULL AS team FROM rest UNION ALL SELECT cluster, key, name, NULL, team FROM done
""")
def i17_with_complete_teams(t: Tables):
    slots = allocated(t)["slots"].select("cluster", "key", "name", "position")
    members = complete_people(team_people(t)).select(
        "cluster",
        F.col("c_custkey").cast("string").alias("key"),
        F.col("c_name").alias("name"),
        F.lit("complete").alias("team"),
    )
    clusters = slot_clusters(t).select("cluster")
    both = candidates.with_complete_teams(slots, members, clusters, ["cluster", "key", "name"])
    return both["all"]


@query(TEAMS + """
    , done AS (SELECT cluster, c_custkey FROM people WHERE cluster IN (SELECT cluster FROM g WHERE teams >= 1)),
    n AS (SELECT cluster, least(BUILDING, FURNITURE, HOUSEHOLD, MACHINERY) AS teams FROM c)
    SELECT p.cluster, p.c_custkey AS key, p.position, n.teams, (SELECT CAST(sum(teams) AS BIGINT) FROM n) AS all_teams
    FROM people p JOIN n USING (cluster) WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.c_custkey = p.c_custkey)
""")
def i16_candidate_teams(t: Tables):
    everyone = written(team_people(t), "people")
    people = everyone.withColumnsRenamed({"c_custkey": "key", "state": "cluster_state"})
    complete = complete_people(everyone).select("cluster", F.col("c_custkey").alias("key"))
    made = candidates.candidate_teams(
        people, complete, positions=SEGMENTS, needed=[s for s in SEGMENTS if s != "AUTOMOBILE"]
    )
    total = made["total"].scalar()
    return made["base"].select("cluster", "key", "position", "teams", total.alias("all_teams"))


@query(SLOTS + """
    SELECT cluster, position, key FROM cand WHERE key NOT IN (SELECT key FROM slots WHERE filled)
""")
def i17_without_placed(t: Tables):
    people = slot_candidates(t).withColumn("cluster", F.trim("cluster"))
    placed = allocated(t)["slots"].filter("filled").select("cluster", "key")
    return candidates.without_placed(people, placed, placed).select("cluster", "position", "key")


@query("""
    WITH s AS (SELECT p_type, p_partkey IN (SELECT o_custkey FROM orders) AS inc, p_partkey IN (SELECT l_partkey FROM lineitem) AS com FROM part)
    SELECT p_type, count(*) AS clusters, count(CASE WHEN com THEN 1 END) AS complete, count(CASE WHEN inc THEN 1 END) AS incomplete,
      count(CASE WHEN com THEN 1 END) / count(*) AS share_complete, count(CASE WHEN inc THEN 1 END) / count(*) AS share_incomplete FROM s GROUP BY 1
""")
def i18_coverage(t: Tables):
    return candidates.coverage(
        t.part,
        t.lineitem.withColumnRenamed("l_partkey", "p_partkey"),
        t.orders.withColumnRenamed("o_custkey", "p_partkey"),
        "p_type",
        "p_partkey",
    )


# --- I19, I20: modes and goals ------------------------------------------------------------------

PAYROLL = """
    WITH pay AS (SELECT CASE WHEN p_size < 45 THEN 'BCIMB' || lpad(CAST(p_size AS VARCHAR), 6, '0') END AS facility, p_brand AS role, p_type AS position FROM part),
    fac AS (SELECT 'BCIMB' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS facility, 'CAT' || s_nationkey AS category FROM supplier WHERE s_acctbal > 2000)
"""


def payroll_modes(t: Tables):
    code = F.concat(F.lit(" bcimb"), F.lpad(F.col("p_size").cast("string"), 6, "0"), F.lit("-x"))
    payroll = t.part.select(
        F.when(F.col("p_size") < 45, code).otherwise("SIN CLUES").alias("facility"),
        F.col("p_brand").alias("role"),
        F.col("p_type").alias("position"),
    )
    site = F.concat(F.lit("BCIMB"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))
    facilities = t.supplier.filter(F.col("s_acctbal") > 2000).select(
        site.alias("facility"), F.concat(F.lit("CAT"), F.col("s_nationkey")).alias("category")
    )
    new = F.replace("p_brand", F.lit("Brand#"), F.lit("N"))
    roles = t.part.select("p_brand", new.alias("new_role")).distinct()
    roles = roles.select(
        F.col("p_brand").alias("role"), "new_role", F.lower("p_brand").alias("role_name")
    )
    positions = t.part.select(
        F.col("p_type").alias("position"), F.lower("p_type").alias("position_name")
    ).distinct()
    return reports.modal_positions(payroll, facilities, roles, positions)


@query(PAYROLL + """
    , c AS (SELECT role, position, category, count(*) AS n FROM pay LEFT JOIN fac USING (facility) GROUP BY 1, 2, 3)
    SELECT category, replace(role, 'Brand#', 'N') AS new_role, lower(role) AS role_name, position, lower(position) AS position_name, n FROM c
    QUALIFY row_number() OVER (PARTITION BY role ORDER BY n DESC, position, category NULLS LAST) = 1
""")
def i19_modal_positions(t: Tables):
    return payroll_modes(t)["modes"]


@query(PAYROLL + """
    SELECT DISTINCT facility FROM pay WHERE facility IS NULL OR facility NOT IN (SELECT facility FROM fac)
""")
def i19_codes_without_catalogue(t: Tables):
    return payroll_modes(t)["facilities_outside"]


GOALS = """
    WITH g AS (SELECT CASE WHEN s_nationkey < 24 THEN n_name END AS state, 'S' || s_suppkey AS facility, 'Hospital' AS category, s_name AS unit, 'ABIERTA' AS status,
        CAST(s_suppkey AS BIGINT) AS general, CASE WHEN s_acctbal > 0 THEN CAST(s_suppkey * 2 AS BIGINT) END AS special FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


def goals(t: Tables):
    sites = lookup(t.supplier, t.nation, [("s_nationkey", "n_nationkey")])
    return sites.select(
        F.when(F.col("s_nationkey") < 24, F.col("n_name")).alias("state"),
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("facility"),
        F.lit("Hospital").alias("category"),
        F.col("s_name").alias("unit"),
        F.lit("ABIERTA").alias("status"),
        F.col("s_suppkey").alias("general"),
        F.when(F.col("s_acctbal") > 0, F.col("s_suppkey") * 2).alias("special"),
    )


def goal_totals(t: Tables):
    return reports.goals_with_totals(
        goals(t), "state", "facility", ["category"], "status", "unit", ["general", "special"]
    )


@query(GOALS + """
    SELECT * FROM g WHERE state IS NOT NULL
    UNION ALL SELECT 'NACIONAL', 'NACIONAL', 'NACIONAL', 'México', 'EN OPERACION', CAST(sum(general) AS BIGINT),
        CASE WHEN count(special) = count(*) THEN CAST(sum(special) AS BIGINT) END FROM g
    UNION ALL SELECT state, state, state, state, 'EN OPERACION', CAST(sum(general) AS BIGINT), CAST(coalesce(sum(special), 0) AS BIGINT)
        FROM g WHERE state IS NOT NULL GROUP BY state
""")
def i20_goals_with_totals(t: Tables):
    return goal_totals(t)


@query("""
    WITH c AS (SELECT CASE WHEN l_linenumber < 7 THEN 'S' || l_suppkey END AS clues, CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(count(*) AS BIGINT) AS consultas,
                      sum(l_quantity) AS estudios FROM lineitem GROUP BY 1, 2)
    SELECT * FROM c WHERE clues IS NOT NULL UNION ALL SELECT 'NACIONAL', anio, CAST(sum(consultas) AS BIGINT), sum(estudios) FROM c GROUP BY anio
""")
def i20_indicators_with_national_rows(t: Tables):
    clues = F.when(F.col("l_linenumber") < 7, F.concat(F.lit("S"), F.col("l_suppkey")))
    cube = t.lineitem.groupBy(clues.alias("clues"), F.year("l_shipdate").alias("anio")).agg(
        n_rows().alias("consultas"), F.sum("l_quantity").alias("estudios")
    )
    return reports.with_national_rows(cube, ["anio"], "clues")


@query("""
    SELECT 'NACIONAL' AS value, 'NACIONAL - México' AS label UNION ALL SELECT 'S' || s_suppkey, 'S' || s_suppkey || ' - ' || s_name FROM supplier
""")
def i20_label_dictionary(t: Tables):
    return reports.label_dictionary(goals(t), "facility", "unit")


@query(GOALS + """
    SELECT 'NACIONAL' AS facility, 'México' AS unit UNION ALL SELECT DISTINCT state, state FROM g WHERE state IS NOT NULL
    UNION ALL SELECT facility, unit FROM g WHERE state IS NOT NULL AND special IS NULL
""")
def i20_goals_outside_catalogue(t: Tables):
    catalogue = goals(t).filter(F.col("special").isNotNull())
    return reports.goals_outside_catalogue(goal_totals(t), catalogue, "facility").select("facility", "unit")
