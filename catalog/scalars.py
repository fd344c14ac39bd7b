"""H: scalar functions, on text built from keys and on the given texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog.registry import Tables, query
from recordops import fixed_values as fixed
from recordops.functions import codes, coordinates, dates, text
from recordops.functions.nulls import join_text
from recordops.operators.aggregates import frequency
from recordops.operators.joins import lookup

# Both sides build the same messy texts from the keys of a table.
MESSY_NUMBER = """
    CASE c_mktsegment WHEN 'BUILDING' THEN CAST(c_custkey AS VARCHAR) || '.5'
      WHEN 'MACHINERY' THEN '-' || CAST(c_custkey AS VARCHAR) || ' '
      WHEN 'FURNITURE' THEN 'No. ' || CAST(c_custkey AS VARCHAR) || ',5 x'
      WHEN 'HOUSEHOLD' THEN '1d' ELSE NULL END
"""


def messy_number() -> Column:
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    return (
        F.when(segment == "BUILDING", F.concat(key, F.lit(".5")))
        .when(segment == "MACHINERY", F.concat(F.lit("-"), key, F.lit(" ")))
        .when(segment == "FURNITURE", F.concat(F.lit("No. "), key, F.lit(",5 x")))
        .when(segment == "HOUSEHOLD", "1d")
    )


def person_key(name: str, branch: str) -> str:
    """A made-up key text of 18 characters from a number, damaged by `branch`."""
    good = f"'ABCD' || lpad(CAST({name} AS VARCHAR), 6, '0') || 'HXXXXX01'"
    return f"""
      CASE {branch} WHEN 'BUILDING' THEN {good} WHEN 'MACHINERY' THEN ' ''' || lower({good}) || chr(9) || '"'
        WHEN 'FURNITURE' THEN substr({good}, 1, 15) WHEN 'HOUSEHOLD' THEN replace({good}, 'H', 'Z') ELSE NULL END
    """


def person_key_column(name: str, branch: str) -> Column:
    number = F.lpad(F.col(name).cast("string"), 6, "0")
    good = F.concat(F.lit("ABCD"), number, F.lit("HXXXXX01"))
    kind = F.col(branch)
    return (
        F.when(kind == "BUILDING", good)
        .when(kind == "MACHINERY", F.concat(F.lit(" '"), F.lower(good), F.lit('\t"')))
        .when(kind == "FURNITURE", F.substring(good, 1, 15))
        .when(kind == "HOUSEHOLD", F.translate(good, "H", "Z"))
    )


DMS = """
    CASE s_nationkey WHEN 1 THEN CAST(s_suppkey AS VARCHAR) WHEN 2 THEN '92°30''S'
      WHEN 3 THEN CAST(s_suppkey AS VARCHAR) || '° 15'' 36" W' WHEN 4 THEN NULL
      ELSE CAST(s_suppkey AS VARCHAR) || '°30''18.5"N' END
"""


def dms_text() -> Column:
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey")
    return (
        F.when(nation == 1, key)
        .when(nation == 2, "92°30'S")
        .when(nation == 3, F.concat(key, F.lit("° 15' 36\" W")))
        .when(nation != 4, F.concat(key, F.lit("°30'18.5\"N")))
    )


@query(f"""
    WITH c AS (SELECT c_custkey, {MESSY_NUMBER} AS x FROM customer)
    SELECT c_custkey, coalesce(regexp_matches(trim(x), '^-?[0-9]+(\\.[0-9]+)?$'), false) AS is_number FROM c
""")
def h1_is_numeric(t: Tables):
    return t.customer.select("c_custkey", text.is_number(messy_number()).alias("is_number"))


@query(f"""
    WITH c AS (SELECT c_custkey, {MESSY_NUMBER} AS x FROM customer)
    SELECT c_custkey, TRY_CAST(nullif(regexp_extract(replace(x, ',', ''), '-?[0-9]+(\\.[0-9]+)?'), '') AS DOUBLE) AS number FROM c
""")
def h2_first_number(t: Tables):
    return t.customer.select("c_custkey", text.first_number(messy_number()).alias("number"))


@query("""
    SELECT doc_id, md5(trim(regexp_replace(text, '[\\t\\n\\x0b\\f\\r ]+', ' ', 'g'))) AS squished,
           md5(regexp_replace('  ' || text || chr(10), '^[\\t\\n\\x0b\\f\\r ]+|[\\t\\n\\x0b\\f\\r ]+$', '', 'g')) AS trimmed
    FROM documents
""")
def h3_squish_and_trim(t: Tables):
    padded = F.concat(F.lit("  "), F.col("text"), F.lit("\n"))
    return t.documents.select(
        "doc_id",
        F.md5(text.squish("text")).alias("squished"),
        F.md5(text.trim_all(padded)).alias("trimmed"),
    )


@query("""
    SELECT p_partkey, upper(p_name) AS upper_name,
      array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title
    FROM part
""")
def h4_upper_and_title(t: Tables):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.initcap("p_name").alias("title")
    )


@query("""
    SELECT page_id, nullif(regexp_extract(url, '//([^/]+)/', 1), '') AS host,
           nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page FROM pages
""")
def h5_regex_extract(t: Tables):
    return t.pages.select(
        "page_id",
        text.extract("url", "//([^/]+)/", 1).alias("host"),
        text.extract("url", "[?&]page=([0-9]+)", 1).alias("page"),
    )


@query("""
    SELECT regexp_matches(url, '^https') AS secure, regexp_matches(url, '#') AS anchored, count(*) AS n FROM pages GROUP BY 1, 2
""")
def h6_regex_test(t: Tables):
    flags = t.pages.select(
        F.col("url").rlike("^https").alias("secure"), F.col("url").rlike("#").alias("anchored")
    )
    return frequency(flags, ["secure", "anchored"])


@query("""
    SELECT c_custkey, regexp_replace('C' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR), '_[0-9]+$', '') AS anchor
    FROM customer
""")
def h7_remove_suffix(t: Tables):
    code = F.concat(F.lit("C"), F.col("c_nationkey"), F.lit("_"), F.col("c_custkey"))
    return t.customer.select("c_custkey", text.remove(code, r"_\d+$").alias("anchor"))


@query("""
    SELECT p_partkey, substr(x, 1, 4) AS code, trim(substr(x, 6)) AS description
    FROM (SELECT p_partkey, CASE WHEN p_size > 5 THEN lpad(CAST(p_size AS VARCHAR), 4, '0') || '  ' || p_name || ' ' END AS x FROM part)
""")
def h8_split_code(t: Tables):
    code = F.lpad(F.col("p_size").cast("string"), 4, "0")
    joined = F.concat(code, F.lit("  "), F.col("p_name"), F.lit(" "))
    x = F.when(F.col("p_size") > 5, joined)
    return t.part.select(
        "p_partkey",
        text.code_part(x).alias("code"),
        text.description_part(x).alias("description"),
    )


@query("""
    SELECT doc_id, nullif(concat_ws(' - ', nullif(lang, 'de'), CASE WHEN n_chars > 1000 THEN source END), '') AS label FROM documents
""")
def h9_text_building(t: Tables):
    lang = F.nullif("lang", F.lit("de"))
    source = F.when(F.col("n_chars") > 1000, F.col("source"))
    return t.documents.select("doc_id", join_text(" - ", lang, source).alias("label"))


@query("""
    SELECT c_custkey, c_name || '<br>' || c_mktsegment || '<br>' || CAST(c_nationkey AS VARCHAR) AS popup FROM customer
""")
def h10_popup(t: Tables):
    shown = ["c_name", "c_mktsegment", "not_there", "c_nationkey"]
    return t.customer.select("c_custkey", text.popup(t.customer, shown).alias("popup"))


@query("""
    SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents
""")
def h11_text_length(t: Tables):
    return t.documents.select("doc_id", F.char_length("text").alias("n"))


@query("""
    WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderpriority, format('{:,}', n) AS shown,
      format('{:,} ({}%)', n, CAST(round_even(n / (SELECT sum(n) FROM c) * 100, 0) AS INTEGER)) AS with_percent,
      (SELECT sum(n)::BIGINT FROM c) AS total FROM c
""")
def h12_thousands_and_percent(t: Tables):
    counts = frequency(t.orders, ["o_orderpriority"])
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("total", total).select(
        "o_orderpriority",
        "total",
        text.thousands("n").alias("shown"),
        text.count_with_percent("n", "total").alias("with_percent"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8, 1) AS one, round_even(l_quantity / 4, 0) AS none FROM lineitem
""")
def h13_rounding(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.bround(F.col("l_quantity") / 8, 1).alias("one"),
        F.bround(F.col("l_quantity") / 4, 0).alias("none"),
    )


@query("""
    SELECT doc_id, coalesce(quality, 0) AS quality, nullif(lang, 'de') AS lang FROM documents LEFT JOIN labels USING (doc_id)
""")
def h14_null_replacement(t: Tables):
    joined = lookup(t.documents, t.labels.select("doc_id", "quality"), ["doc_id"])
    filled = joined.fillna(0, subset=["quality"])
    return filled.select("doc_id", "quality", F.nullif("lang", F.lit("de")).alias("lang"))


@query("""
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'OBRA' WHEN 'MACHINERY' THEN 'EQUIPO' ELSE c_mktsegment END AS segment FROM customer
""")
def h15_code_remap(t: Tables):
    names = {"BUILDING": "OBRA", "MACHINERY": "EQUIPO"}
    return t.customer.select("c_custkey", text.recode("c_mktsegment", names).alias("segment"))


@query("""
    WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'sin fecha' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
                      strftime(o_orderdate, '%d/%m/%Y') AS e FROM orders)
    SELECT o_orderkey, strftime(TRY_CAST(d AS DATE), '%Y%m%d') AS iso, strftime(CAST(try_strptime(e, '%d/%m/%Y') AS DATE), '%Y%m%d') AS other FROM o
""")
def h16_date_parsing(t: Tables):
    iso = F.when(F.col("o_orderstatus") == "P", "sin fecha")
    iso = iso.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    other = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey",
        F.date_format(dates.parse_date(iso), "yyyyMMdd").alias("iso"),
        F.date_format(dates.parse_date(other, "dd/MM/yyyy"), "yyyyMMdd").alias("other"),
    )


@query("""
    SELECT o_orderkey, strftime(d - CAST((isodow(d) + 3) % 7 + 1 AS INTEGER), '%Y-%m-%d') AS wednesday
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
""")
def h17_last_wednesday(t: Tables):
    day = dates.last_wednesday(F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("wednesday"))


@query("""
    SELECT strftime(o_orderdate, '%d_%m') AS day, count(*) AS n FROM orders GROUP BY 1
""")
def h18_day_month_text(t: Tables):
    return frequency(t.orders.select(dates.day_month("o_orderdate").alias("day")), ["day"])


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(year(o_orderdate - INTERVAL 6 HOUR) AS INTEGER) AS local_year, count(*) AS n FROM orders GROUP BY 1, 2, 3
""")
def h19_year_and_month(t: Tables):
    # The instants of the orders' days in UTC, read on the clock of Mexico City.
    instant = F.make_timestamp_ltz(
        F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"),
        F.lit(0), F.lit(30), F.lit(0), F.lit("UTC"),
    )
    orders = t.orders.withColumn("instant", instant)
    parts = orders.select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        dates.local_year(orders, "instant").alias("local_year"),
    )
    return frequency(parts, ["year", "month", "local_year"])


@query("""
    SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*) AS n FROM events GROUP BY 1
""")
def h20_week_start(t: Tables):
    week = F.date_format(dates.week_start("ts"), "yyyy-MM-dd").alias("week")
    return frequency(t.events.select(week), ["week"])


MONTH_NAMES = ", ".join(f"'{m}'" for m in fixed.MONTHS)


@query(f"""
    WITH o AS (SELECT year(o_orderdate) AS y, [{MONTH_NAMES}][month(o_orderdate)] AS name, o_orderdate AS d, o_orderstatus FROM orders)
    SELECT CASE o_orderstatus WHEN 'P' THEN 'Unknown' ELSE name END AS name,
      CASE o_orderstatus WHEN 'P' THEN NULL ELSE strftime(date_trunc('month', d), '%Y-%m-%d') END AS first_day, count(*) AS n
    FROM o GROUP BY 1, 2
""")
def h21_month_names(t: Tables):
    names = F.array(*[F.lit(m) for m in fixed.MONTHS])
    name = F.when(F.col("o_orderstatus") == "P", fixed.UNKNOWN_MONTH)
    name = name.otherwise(F.element_at(names, F.month("o_orderdate")))
    first = dates.month_start(F.year("o_orderdate"), dates.month_number(name))
    parts = t.orders.select(
        name.alias("name"), F.date_format(first, "yyyy-MM-dd").alias("first_day")
    )
    return frequency(parts, ["name", "first_day"])


@query("""
    SELECT c_custkey, c_acctbal BETWEEN 0 AND 5000 AND c_nationkey BETWEEN 3 AND 20 AS inside FROM customer
""")
def h22_range_test(t: Tables):
    box = coordinates.Bounds((0, 5000), (3, 20))
    return t.customer.select("c_custkey", box.valid("c_acctbal", "c_nationkey").alias("inside"))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS user_id,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def h23_type_harmonising(t: Tables):
    return t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )


@query(f"""
    WITH s AS (SELECT s_suppkey, {DMS} AS x FROM supplier),
    p AS (SELECT s_suppkey, x, regexp_extract(x, '^([0-9.]+)°', 1) AS d,
       regexp_extract(x, '° ?([0-9.]+)''', 1) AS m, regexp_extract(x, ''' ?([0-9.]+)"', 1) AS s, right(x, 1) IN ('S', 'W') AS neg FROM s)
    SELECT s_suppkey, round(TRY_CAST(nullif(d, '') AS DOUBLE) * CASE WHEN neg THEN -1 ELSE 1 END
       + CASE WHEN neg THEN -1 ELSE 1 END * (coalesce(TRY_CAST(nullif(m, '') AS DOUBLE), 0) / 60 + coalesce(TRY_CAST(nullif(s, '') AS DOUBLE), 0) / 3600), 6) AS decimal
    FROM p
""")
def h24_dms_to_decimal(t: Tables):
    value = F.round(coordinates.dms_to_decimal(dms_text()), 6)
    return t.supplier.select("s_suppkey", value.alias("decimal"))


PLACES = """
    WITH s AS (SELECT c_custkey AS k, c_mktsegment AS g, CAST(14 + c_nationkey * 0.5 AS VARCHAR) AS a, CAST(-119 + c_nationkey * 1.25 AS VARCHAR) AS o,
               CAST(14 + c_nationkey AS VARCHAR) AS d FROM customer),
    p AS (SELECT k, g, CASE g WHEN 'BUILDING' THEN 'x' WHEN 'MACHINERY' THEN d || '°30''0"N  100°15''0"W' WHEN 'FURNITURE' THEN d || '°30''' ELSE ' ' || a || ' grados' END AS lat,
          CASE g WHEN 'BUILDING' THEN a || ' , ' || o WHEN 'MACHINERY' THEN '' WHEN 'FURNITURE' THEN '100°15''36"W' WHEN 'HOUSEHOLD' THEN NULL ELSE o END AS lon FROM s)
"""


def places(t: Tables):
    g, n = F.col("c_mktsegment"), F.col("c_nationkey")
    # Exact decimal texts, as in the SQL.
    a = (n.cast("decimal(10,0)") * F.lit(0.5).cast("decimal(2,1)") + 14).cast("decimal(10,1)").cast("string")
    o = (n.cast("decimal(10,0)") * F.lit(1.25).cast("decimal(3,2)") - 119).cast("decimal(10,2)").cast("string")
    d = (n + 14).cast("string")
    lat = (
        F.when(g == "BUILDING", "x")
        .when(g == "MACHINERY", F.concat(d, F.lit("°30'0\"N  100°15'0\"W")))
        .when(g == "FURNITURE", F.concat(d, F.lit("°30'")))
        .otherwise(F.concat(F.lit(" "), a, F.lit(" grados")))
    )
    lon = (
        F.when(g == "BUILDING", F.concat(a, F.lit(" , "), o))
        .when(g == "MACHINERY", "")
        .when(g == "FURNITURE", "100°15'36\"W")
        .when(g != "HOUSEHOLD", o)
    )
    return t.customer.select(F.col("c_custkey").alias("k"), lat.alias("lat"), lon.alias("lon"))


@query(PLACES + """
    SELECT k, CASE g WHEN 'BUILDING' THEN TRY_CAST(split_part(lon, ' , ', 1) AS DOUBLE)
        WHEN 'MACHINERY' THEN CAST(split_part(lat, '°', 1) AS DOUBLE) + 0.5 WHEN 'FURNITURE' THEN CAST(split_part(lat, '°', 1) AS DOUBLE) + 0.5
        ELSE CAST(split_part(trim(lat), ' ', 1) AS DOUBLE) END AS lat_num,
      CASE g WHEN 'BUILDING' THEN TRY_CAST(split_part(lon, ' , ', 2) AS DOUBLE) WHEN 'MACHINERY' THEN -100.25
        WHEN 'FURNITURE' THEN -100.26 WHEN 'HOUSEHOLD' THEN NULL ELSE CAST(lon AS DOUBLE) END AS lon_num FROM p
""")
def h25_coordinates_from_text(t: Tables):
    return coordinates.coordinates_from_text(places(t), "lat", "lon").drop("lat", "lon")


POINTS = """
    WITH c AS (SELECT c_custkey AS k, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL WHEN 'FURNITURE' THEN -100.5 ELSE c_nationkey + 12.5 END AS lat,
        CASE WHEN c_nationkey > 20 THEN NULL WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 5000 THEN -90.0
             WHEN c_mktsegment = 'FURNITURE' THEN 20.5 WHEN c_mktsegment = 'MACHINERY' THEN 80.0 + c_nationkey ELSE -95.0 - c_nationkey * 2 END AS lon FROM customer)
"""


def points(t: Tables):
    g, n = F.col("c_mktsegment"), F.col("c_nationkey")
    lat = F.when(g == "FURNITURE", -100.5).when(g != "HOUSEHOLD", n + 12.5)
    lon = (
        F.when((n <= 20) & (g == "FURNITURE") & (F.col("c_acctbal") > 5000), -90.0)
        .when((n <= 20) & (g == "FURNITURE"), 20.5)
        .when((n <= 20) & (g == "MACHINERY"), 80.0 + n)
        .when(n <= 20, -95.0 - n * 2)
    )
    return t.customer.select(F.col("c_custkey").alias("k"), lat.alias("lat"), lon.alias("lon"))


@query(POINTS + """
    , v AS (SELECT k, lat, lon, lat BETWEEN 14 AND 33 AS a, lon BETWEEN -119 AND -86 AS o FROM c)
    SELECT k, CASE WHEN lat IS NULL AND lon IS NULL THEN 'Latitud y longitud no convertidas' WHEN lat IS NULL THEN 'Latitud no convertida'
      WHEN lon IS NULL THEN 'Longitud no convertida' WHEN NOT a AND NOT o THEN 'Latitud y longitud fuera de rango México'
      WHEN NOT a THEN 'Latitud fuera de rango México' WHEN NOT o THEN 'Longitud fuera de rango México' ELSE 'Sin causa identificada' END AS cause FROM v
""")
def h26_failure_cause(t: Tables):
    return points(t).select("k", coordinates.failure_cause("lat", "lon").alias("cause"))


@query(POINTS + """
    , w AS (SELECT k, CAST(lat AS DOUBLE) AS lat, CAST(CASE WHEN lon > 0 THEN -lon ELSE lon END AS DOUBLE) AS west, CAST(lon AS DOUBLE) AS lon FROM c)
    SELECT k, west,
      CASE WHEN lat BETWEEN -119 AND -86 THEN CASE WHEN west BETWEEN -119 AND -86 THEN NULL ELSE west END ELSE lat END AS lat_u,
      CASE WHEN lat BETWEEN -119 AND -86 THEN CASE WHEN west BETWEEN -119 AND -86 THEN NULL ELSE lat END ELSE west END AS lon_u,
      CASE WHEN lat BETWEEN -119 AND -86 AND lon BETWEEN 14 AND 33 THEN lon ELSE lat END AS lat_s,
      CASE WHEN lat BETWEEN -119 AND -86 AND lon BETWEEN 14 AND 33 THEN lat ELSE lon END AS lon_s FROM w
""")
def h27_coordinate_repair(t: Tables):
    df = points(t).withColumn("west", coordinates.force_west("lon"))
    lat_u, lon_u = coordinates.untangle_axes("lat", "west")
    lat_s, lon_s = coordinates.swap_reversed("lat", "lon")
    return df.select(
        "k",
        "west",
        lat_u.alias("lat_u"),
        lon_u.alias("lon_u"),
        lat_s.alias("lat_s"),
        lon_s.alias("lon_s"),
    )


@query(f"""
    SELECT c_custkey, upper(regexp_replace({person_key('c_custkey', 'c_mktsegment')}, '[^A-Za-z0-9]', '', 'g')) AS key_clean FROM customer
""")
def h28_clean_key(t: Tables):
    key = codes.clean_key(person_key_column("c_custkey", "c_mktsegment"))
    return t.customer.select("c_custkey", key.alias("key_clean"))


@query(f"""
    SELECT c_custkey, regexp_full_match({person_key('c_custkey', 'c_mktsegment')}, '[A-Z]{{4}}[0-9]{{6}}[HM][A-Z]{{5}}[A-Z0-9]{{2}}') AS fits FROM customer
""")
def h29_key_format(t: Tables):
    key = person_key_column("c_custkey", "c_mktsegment")
    return t.customer.select("c_custkey", codes.key_fits(key).alias("fits"))


ROLES = """
    WITH c AS (SELECT c_custkey,
      CASE WHEN c_nationkey < 5 THEN 'OP057' WHEN c_nationkey < 10 THEN 'OP065' WHEN c_nationkey < 15 THEN NULL WHEN c_nationkey < 20 THEN '' ELSE 'EN002' END AS code,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'CHOFER POLIVALENTE' WHEN 'MACHINERY' THEN 'ANESTESIOLOGIA' WHEN 'FURNITURE' THEN 'OP057 CHOFER PROMOTOR POLIVALENTE'
        WHEN 'HOUSEHOLD' THEN 'OTRO' END AS txt FROM customer),
    r AS (SELECT *, CASE code WHEN 'OP057' THEN 'PA020' WHEN 'OP065' THEN 'PA022' END AS by_code,
      CASE txt WHEN 'CHOFER POLIVALENTE' THEN 'PA022' WHEN 'ANESTESIOLOGIA' THEN 'ME001' WHEN 'OP057 CHOFER PROMOTOR POLIVALENTE' THEN 'PA020' END AS by_text FROM c)
"""


def roles(t: Tables):
    n, g = F.col("c_nationkey"), F.col("c_mktsegment")
    code = F.when(n < 5, "OP057").when(n < 10, "OP065").when(n < 15, None).when(n < 20, "")
    words = {
        "BUILDING": "CHOFER POLIVALENTE",
        "MACHINERY": "ANESTESIOLOGIA",
        "FURNITURE": "OP057 CHOFER PROMOTOR POLIVALENTE",
        "HOUSEHOLD": "OTRO",
    }
    return t.customer.select(
        "c_custkey", code.otherwise("EN002").alias("code"), text.lookup_value(g, words).alias("txt")
    )


@query(ROLES + """
    SELECT c_custkey, coalesce(by_code, by_text, code, txt) AS code_first, coalesce(by_text, by_code, code, txt) AS text_first,
      CASE WHEN code IS NULL OR code = '' THEN CASE txt WHEN 'OP057 CHOFER PROMOTOR POLIVALENTE' THEN 'PA022' ELSE txt END ELSE code END AS other_extract,
      CASE WHEN txt = 'ANESTESIOLOGIA' THEN 'Anestesiologia' WHEN txt LIKE '%CHOFER%' THEN 'Chofer' END AS position FROM r
""")
def h30_role_harmonising(t: Tables):
    return roles(t).select(
        "c_custkey",
        codes.role_code("code", "txt").alias("code_first"),
        codes.role_code("code", "txt", code_first=False).alias("text_first"),
        codes.role_code_other_extract("code", "txt").alias("other_extract"),
        codes.position_from_fields("code", "txt").alias("position"),
    )


@query(ROLES + """
    , p AS (SELECT coalesce(by_code, by_text, code, txt) AS role FROM r)
    SELECT role, CASE role WHEN 'PA020' THEN 'Chofer' WHEN 'PA022' THEN 'Chofer' WHEN 'ME001' THEN 'Anestesiologia'
      WHEN 'EN002' THEN 'Enfermeria quirurgica' END AS position, count(*) AS n FROM p GROUP BY 1, 2
""")
def h31_role_to_position(t: Tables):
    role = roles(t).select(codes.role_code("code", "txt").alias("role"))
    return frequency(role.withColumn("position", codes.position_of_role("role")), ["role", "position"])


@query("""
    WITH e AS (SELECT CASE event_type WHEN 'view' THEN 'MG01' WHEN 'click' THEN '6301' WHEN 'signup' THEN NULL ELSE event_type END AS service FROM events)
    SELECT service, CASE WHEN service IN ('MG01', '6301', '9999', 'PREC', '5001', '6601') THEN 'general' ELSE 'especialidad' END AS kind, count(*) AS n FROM e GROUP BY 1, 2
""")
def h32_service_kind(t: Tables):
    kind = F.col("event_type")
    service = F.when(kind == "view", "MG01").when(kind == "click", "6301").when(kind != "signup", kind)
    rows = t.events.select(service.alias("service"))
    return frequency(rows.withColumn("kind", codes.service_kind("service")), ["service", "kind"])
