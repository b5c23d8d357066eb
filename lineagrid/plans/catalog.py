"""Registered queries of the surveillance operators over the driver's tables, with equivalent DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineagrid.functions import scalars as S
from lineagrid.operators import aggregates as A
from lineagrid.operators import curate as C
from lineagrid.operators import forecast as M
from lineagrid.operators import frequencies as K
from lineagrid.operators import link as J
from lineagrid.operators import quality as U
from lineagrid.operators import sequences as Q
from lineagrid.operators import trees as T
from lineagrid.operators import windows as W

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def values(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def day(column: str):
    return F.to_date(column)


def L(*columns: str):  # noqa: N802
    return [F.col(c).cast("long").alias(c) for c in columns]


def R(*columns: str, digits: int = 4):  # noqa: N802
    return [F.round(c, digits).alias(c) for c in columns]


AS_OF = "2024-02-01"

# -- counting recent records, the flagship ------------------------------------------------------------------------


@query(f"""
WITH recent AS (
  SELECT event_type, CASE WHEN d BETWEEN 0 AND 7 THEN '0-7' WHEN d > 7 AND d <= 14 THEN '8-14' WHEN d > 14 AND d <= 31 THEN '15-31' ELSE 'undefined' END AS recency
  FROM (SELECT *, date_diff('day', ts::DATE, DATE '{AS_OF}') AS d FROM events)
  WHERE user_id IN (SELECT o_custkey FROM orders))
SELECT recency, coalesce(event_type, 'total') AS event_type, count(*)::BIGINT AS n
FROM recent WHERE recency <> 'undefined' GROUP BY GROUPING SETS ((recency, event_type), (recency))""")
def recent_counts(spark, sf):
    """Recent records of known subjects by recency and kind, with totals."""
    e = read(spark, sf, "events").withColumn("recency", S.bin_days(day("ts"), F.to_date(F.lit(AS_OF)), [0, 7, 14, 31], ["0-7", "8-14", "15-31"])).where("recency <> 'undefined'")
    e = C.include_by_value(e, "user_id", read(spark, sf, "orders"), "o_custkey")
    return e.groupBy("recency", "event_type").agg(F.count("*").alias("n")).unionByName(e.groupBy("recency").agg(F.count("*").alias("n")).withColumn("event_type", F.lit("total")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_counts(spark, sf_dir)


# -- projections and filters --------------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, coalesce(c_name, '') AS name, coalesce(c_mktsegment, '') AS segment, '' AS note FROM customer")
def conform_fields(spark, sf):
    df = C.rename_fields(read(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})
    out, _ = C.conform(df, ["id", "name", "segment", "note"])
    return out.withColumn("id", F.col("id").cast("long"))


@query("SELECT *, 'reference' AS source, 1::BIGINT AS version FROM region")
def annotate_constants(spark, sf):
    return C.annotate_constants(read(spark, sf, "region"), {"source": "reference"}).withColumn("version", F.lit(1).cast("long"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def include_by_value(spark, sf):
    return C.include_by_value(read(spark, sf, "orders"), "o_custkey", read(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'"), "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def exclude_by_value(spark, sf):
    return C.exclude_by_value(read(spark, sf, "orders"), "o_custkey", read(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'"), "c_custkey").select("o_orderkey", "o_custkey")


_SUBTYPE = "concat('H', p_size % 6, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('N', p_partkey % 4) END)"


@query(f"""SELECT p_partkey, s AS subtype FROM (SELECT *, {_SUBTYPE} AS s FROM part)
WHERE (regexp_extract(s, '^H(\\d+)', 1) = '5' OR (regexp_extract(s, '^H(\\d+)', 1) = '3' AND NOT contains(s, 'N')) OR regexp_extract(s, 'N(\\d+)', 1) = '2' OR s = 'H1N1') AND lower(p_type) IN ('economy', 'standard')""")
def lineage_filter(spark, sf):
    df = read(spark, sf, "part").withColumn("subtype", F.expr(_SUBTYPE))
    return C.filter_records(df, "subtype", ["H5Nx", "h3", "HxN2", "h1n1"], "p_type", ["Economy", "Standard"]).select("p_partkey", "subtype")


@query("SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' OR o_orderpriority <> '1-URGENT') OR o_custkey = 7")
def exclude_where(spark, sf):
    return C.exclude_where(read(spark, sf, "orders"), ["o_orderstatus=f", "o_orderpriority!=1-urgent"], ["o_custkey=7"]).select("o_orderkey")


_AMBIGUOUS = "CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 2 THEN strftime(o_orderdate, '%Y-XX-XX') ELSE strftime(o_orderdate, '%Y') END"


def _ambiguous(df: DataFrame) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-MM-'XX'")).when(k == 2, F.date_format(d, "yyyy-'XX-XX'")).otherwise(F.date_format(d, "yyyy"))
    return df.withColumn("date", text)


@query(f"""WITH d AS (SELECT o_orderkey, o_orderdate, o_orderkey % 4 AS k, {_AMBIGUOUS} AS date FROM orders),
r AS (SELECT *, CASE WHEN k = 0 THEN o_orderdate::DATE WHEN k = 1 THEN date_trunc('month', o_orderdate)::DATE ELSE date_trunc('year', o_orderdate)::DATE END AS lo,
  CASE WHEN k = 0 THEN o_orderdate::DATE WHEN k = 1 THEN last_day(o_orderdate)::DATE ELSE (date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE END AS hi FROM d)
SELECT o_orderkey, date FROM r WHERE hi >= DATE '1997-06-01' AND lo <= DATE '1999-05-18'""")
def date_between(spark, sf):
    df = _ambiguous(read(spark, sf, "orders"))
    return C.date_between(df, "date", "24M", "2W", F.to_date(F.lit("1999-06-01"))).select("o_orderkey", "date")


@query(f"SELECT o_orderkey, date FROM (SELECT o_orderkey, {_AMBIGUOUS} AS date FROM orders) WHERE NOT regexp_matches(date, '^[^-]*X|^[^-]*-[^-]*X')")
def exclude_ambiguous(spark, sf):
    return C.exclude_ambiguous(_ambiguous(read(spark, sf, "orders")), "date", "month").select("o_orderkey", "date")


@query("SELECT l_returnflag, l_linestatus, round(CASE WHEN s >= 0.2 THEN s / sum(CASE WHEN s >= 0.2 THEN s ELSE 0 END) OVER () ELSE 0 END, 6) AS share FROM (SELECT l_returnflag, l_linestatus, sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem) AS s FROM lineitem GROUP BY ALL)")
def floor_and_renormalise(spark, sf):
    df = read(spark, sf, "lineitem")
    shares = df.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("s")).withColumn("t", df.agg(F.sum("l_quantity")).scalar()).select("l_returnflag", "l_linestatus", (F.col("s") / F.col("t")).alias("share"))
    return C.floor_and_renormalise(shares, "share", 0.2).select("l_returnflag", "l_linestatus", *R("share", digits=6))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, 'nation' AS level, n_name AS place FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def missing_places(spark, sf):
    nation = read(spark, sf, "nation")
    known = nation.join(read(spark, sf, "supplier"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.lit("nation").alias("level"), F.col("n_name").alias("place")).distinct()
    out = C.missing_places(nation.withColumnRenamed("n_name", "nation"), "nation", known)
    return out.join(nation, F.col("place") == F.col("n_name")).select(*L("n_nationkey"), "level", "place")


# -- scalar functions ---------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, (year(w) * 100 + floor((dayofyear(w) - 1) / 7) + 1)::BIGINT AS epiweek, strftime(o_orderdate, '%Y-%m') AS month,
round(year(o_orderdate) + (dayofyear(o_orderdate) - 1) / 365.25, 6) AS decimal_year
FROM (SELECT *, o_orderdate::DATE + (3 - dayofweek(o_orderdate))::INTEGER AS w FROM orders)""")
def calendar(spark, sf):
    d = day("o_orderdate")
    return read(spark, sf, "orders").select("o_orderkey", S.epiweek(d).cast("long").alias("epiweek"), S.year_month(d).alias("month"), F.round(S.to_decimal_year(d), 6).alias("decimal_year"))


@query("""SELECT p_partkey, substr(sha256(p_name), 1, 7) AS short, lower(p_type) AS kind, split_part(p_brand, '#', 1) AS centre,
CASE WHEN p_size = 0 THEN '0' WHEN p_size <= 5 THEN '1-5' WHEN p_size <= 10 THEN '6-10' ELSE '>10' END AS band,
CASE WHEN contains(p_name, 'ring') THEN 'True' ELSE 'False' END AS flag,
CASE WHEN abs(p_size / 50.0 - 0.5) < 0.05 THEN 'persist' WHEN p_size / 50.0 - 0.5 < 0 THEN 'decline' ELSE 'grow' END AS status,
translate(regexp_replace(lower(concat('A/', p_name, '/00', p_size, '_x')), '/0+(\\d)', '/\\1', 'g'), '/_(),- ;.', '') AS simple
FROM part""")
def labels_of_parts(spark, sf):
    size = F.col("p_size")
    name = F.concat(F.lit("A/"), "p_name", F.lit("/00"), F.col("p_size").cast("string"), F.lit("_x"))
    return read(spark, sf, "part").select(
        "p_partkey", S.short_hash(F.col("p_name")).alias("short"), F.lower("p_type").alias("kind"), F.split_part("p_brand", F.lit("#"), F.lit(1)).alias("centre"), S.count_band(size).alias("band"),
        S.flag_substring(F.col("p_name"), "ring").alias("flag"), S.growth_status(size / 50.0 - 0.5).alias("status"), S.simplify_name(name).alias("simple"),
    )


_PASSAGE_SQL = " ".join(f"WHEN regexp_matches(p, '{p}') THEN '{c}'" for p, c in S.PASSAGE_PATTERNS)


@query(f"""SELECT p_partkey, CASE {_PASSAGE_SQL} ELSE 'undetermined' END AS category FROM
(SELECT p_partkey, upper(CASE p_partkey % 6 WHEN 0 THEN concat('E', p_size) WHEN 1 THEN 'original' WHEN 2 THEN concat('MDCK', p_size) WHEN 3 THEN p_type WHEN 4 THEN 'throat swab' ELSE p_name END) AS p FROM part)""")
def passage_category(spark, sf):
    k = F.col("p_partkey") % 6
    text = F.when(k == 0, F.concat(F.lit("E"), F.col("p_size").cast("string"))).when(k == 1, "original").when(k == 2, F.concat(F.lit("MDCK"), F.col("p_size").cast("string"))).when(k == 3, F.col("p_type")).when(k == 4, "throat swab").otherwise(F.col("p_name"))
    return read(spark, sf, "part").select("p_partkey", S.passage_category(text).alias("category"))


@query("""SELECT page_id, coalesce(trim(p[1]), '') AS region, coalesce(trim(p[2]), '') AS country, coalesce(trim(p[3]), '') AS division, coalesce(trim(p[4]), '') AS location,
array_to_string(list_filter(list_transform(p, lambda x: trim(x)), lambda x: NOT regexp_matches(x, '[0-9]')), '|') AS words
FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)""")
def split_location(spark, sf):
    parts = S.split_location(F.col("url"))
    trimmed = F.transform(F.split("url", "/"), lambda x: F.trim(x))
    return read(spark, sf, "pages").select("page_id", parts.alias("s"), F.array_join(S.drop_numeric_parts(trimmed), "|").alias("words")).select("page_id", "s.*", "words")


@query("""SELECT p_partkey, CASE WHEN TRY_CAST(a AS INTEGER) IS NULL THEN '?' ELSE concat(TRY_CAST(a AS INTEGER), u) END AS age,
CASE WHEN u = 'm' THEN round(TRY_CAST(a AS DOUBLE) / 12, 6) ELSE TRY_CAST(a AS DOUBLE) END AS years
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE p_size::VARCHAR END AS a, CASE WHEN p_partkey % 2 = 0 THEN 'm' ELSE 'y' END AS u FROM part)""")
def ages(spark, sf):
    k = F.col("p_partkey")
    age = S.combine_age(F.when(k % 5 == 0, "n/a").otherwise(F.col("p_size").cast("string")), F.when(k % 2 == 0, "M").otherwise(""))
    return read(spark, sf, "part").select("p_partkey", age.alias("age")).withColumn("years", F.round(S.age_in_years(F.col("age")), 6))


# -- joins --------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 'True' ELSE 'False' END AS urgent FROM customer")
def flag_members(spark, sf):
    return J.flag_members(read(spark, sf, "customer"), read(spark, sf, "orders").where("o_orderpriority = '1-URGENT'"), "c_custkey", "urgent", "o_custkey").select("c_custkey", "urgent")


@query("""SELECT id, coalesce(nullif(s.s_name, ''), nullif(c.c_name, '')) AS name, c.c_mktsegment AS segment, c.c_custkey IS NOT NULL AS in_customer, s.s_suppkey IS NOT NULL AS in_supplier
FROM (SELECT coalesce(c_custkey, s_suppkey) AS id, c_custkey AS ck, s_suppkey AS sk FROM customer FULL OUTER JOIN supplier ON c_custkey = s_suppkey) k
LEFT JOIN customer c ON c.c_custkey = ck LEFT JOIN supplier s ON s.s_suppkey = sk""")
def merge_metadata(spark, sf):
    a = read(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = read(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return J.merge_metadata([("customer", a, "c_custkey"), ("supplier", b, "s_suppkey")], "id", flags=True)


@query("""SELECT o_orderkey, c.c_mktsegment AS c_mktsegment_o_custkey, s.s_name AS s_name_l_suppkey, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c.c_custkey JOIN supplier s ON l_suppkey = s.s_suppkey""")
def star_join(spark, sf):
    facts = J.join_on(read(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity"), read(spark, sf, "orders").select("o_orderkey", "o_custkey").withColumn("k", F.col("o_orderkey")), "l_orderkey", "k")
    out = J.star(facts, [("o_custkey", read(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey"), ("l_suppkey", read(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey")])
    return out.select("o_orderkey", "c_mktsegment_o_custkey", "s_name_l_suppkey", "l_quantity")


@query("SELECT c_custkey, coalesce(arg_min(o_orderpriority, o_orderkey), 'unknown') AS source FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def attach_first_source(spark, sf):
    raw = read(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("source"), "o_orderkey")
    return J.attach_first_source(read(spark, sf, "customer").select("c_custkey"), raw, ["c_custkey"], "source", "o_orderkey")


_RULES = [(["*", "NATION_3"], ["*", "Three"], 0), (["REGION_1", "*"], ["First", "*"], 1), (["REGION_0", "NATION_3"], ["never", "never"], 2), (["REGION_2", "NATION_7"], ["Second", "Seven"], 3)]
_PLACES = "SELECT n_nationkey::BIGINT AS id, r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey"


@query(f"""SELECT id, CASE WHEN n_name = 'NATION_3' THEN r_name WHEN r_name = 'REGION_1' THEN 'First' WHEN r_name = 'REGION_2' AND n_name = 'NATION_7' THEN 'Second' ELSE r_name END AS region,
CASE WHEN n_name = 'NATION_3' THEN 'Three' WHEN r_name = 'REGION_1' THEN n_name WHEN r_name = 'REGION_2' AND n_name = 'NATION_7' THEN 'Seven' ELSE n_name END AS nation FROM ({_PLACES})""")
def location_rules(spark, sf):
    places = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(*[F.col("n_nationkey").cast("long").alias("id")], F.array("r_name", "n_name").alias("parts"))
    rules = values(spark, "raw array<string>, new array<string>, rule_order int", *_RULES)
    return J.apply_location_rules(places, "parts", rules, "id").select("id", F.get("parts", F.lit(0)).alias("region"), F.get("parts", F.lit(1)).alias("nation"))


@query(f"""SELECT id, CASE WHEN r_name = 'REGION_0' AND n_name = 'NATION_3' THEN 'never' WHEN n_name = 'NATION_3' THEN r_name WHEN r_name = 'REGION_1' THEN 'First' WHEN r_name = 'REGION_2' AND n_name = 'NATION_7' THEN 'Second' ELSE r_name END AS region,
CASE WHEN r_name = 'REGION_0' AND n_name = 'NATION_3' THEN 'never' WHEN n_name = 'NATION_3' THEN 'Three' WHEN r_name = 'REGION_1' THEN n_name WHEN r_name = 'REGION_2' AND n_name = 'NATION_7' THEN 'Seven' ELSE n_name END AS nation FROM ({_PLACES})""")
def geolocation_rules(spark, sf):
    places = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("long").alias("id"), F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    rules = values(spark, "raw array<string>, new array<string>, rule_order int", *_RULES)
    return J.apply_geolocation_rules(places, rules, "id", ["region", "nation"]).select("id", "region", "nation")


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 10 = 0 THEN 'FIXED' END, c_mktsegment) AS c_mktsegment FROM customer""")
def apply_annotations(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    notes = df.where("c_custkey % 10 = 0").select("c_custkey", F.lit("c_mktsegment").alias("field"), F.explode(F.array(F.struct(F.lit("first").alias("value"), F.lit(0).alias("rule_order")), F.struct(F.lit("FIXED").alias("value"), F.lit(1).alias("rule_order")))).alias("x")).select("c_custkey", "field", "x.*")
    return J.apply_annotations(df, notes, "c_custkey", ["c_mktsegment"])


@query("""WITH w AS (SELECT i AS no, DATE '2024-01-01' + (7 * i)::INTEGER AS window_start, DATE '2024-01-06' + (7 * i)::INTEGER AS window_end FROM range(0, 4) t(i)),
e AS (SELECT event_id, ts::DATE AS d FROM events),
p AS (SELECT event_id, d, coalesce((SELECT min(window_end) FROM w WHERE window_end > d), (SELECT max(window_end) FROM w)) AS we FROM e)
SELECT event_id, CASE WHEN w.window_start <= d THEN we END AS window_end FROM p JOIN w ON w.window_end = we""")
def asof_window(spark, sf):
    windows = spark.range(4).select(F.date_add(F.to_date(F.lit("2024-01-01")), (7 * F.col("id")).cast("int")).alias("window_start"), F.date_add(F.to_date(F.lit("2024-01-06")), (7 * F.col("id")).cast("int")).alias("window_end"))
    return J.asof_window(read(spark, sf, "events").select("event_id", day("ts").alias("d")), "d", windows, "event_id").select("event_id", "window_end")


_MONTHS = "SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS m, count(*)::BIGINT AS n FROM orders GROUP BY ALL"


def _months(spark, sf):
    return read(spark, sf, "orders").groupBy("o_orderpriority", F.trunc(day("o_orderdate"), "month").alias("m")).agg(F.count("*").alias("n"))


@query(f"SELECT a.o_orderpriority, a.m, a.n, b.n AS other_n FROM ({_MONTHS}) a JOIN ({_MONTHS}) b ON a.o_orderpriority = b.o_orderpriority AND b.m = a.m + INTERVAL 12 MONTH")
def join_offset(spark, sf):
    m = _months(spark, sf)
    return J.join_offset(m, m, "m", 12, ["o_orderpriority"]).select("o_orderpriority", "m", "n", "other_n")


@query("""SELECT a.o_orderkey, count(*)::BIGINT AS n_past, max(b.o_orderkey) AS last_past FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate < a.o_orderdate AND b.o_orderdate >= a.o_orderdate - INTERVAL 12 MONTH GROUP BY a.o_orderkey""")
def join_past(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("d"))
    return J.join_past(o, o, "d", 1, ["o_custkey"]).groupBy("o_orderkey").agg(F.count("*").alias("n_past"), F.max("past_o_orderkey").alias("last_past"))


@query("""WITH q AS (SELECT DISTINCT concat('A/', replace(p_name, ' ', '/'), '/0', p_size) AS name FROM part), s AS (SELECT DISTINCT concat('a/', replace(p_name, ' ', '-'), '/', p_size) AS strain FROM part),
k AS (SELECT translate(regexp_replace(lower(strain), '/0+(\\d)', '/\\1', 'g'), '/_(),- ;.', '') AS k, min(strain) AS m FROM s GROUP BY 1 HAVING count(*) = 1)
SELECT name, m AS matched, CASE WHEN m IS NULL THEN 'none' ELSE 'simplified' END AS stage FROM q LEFT JOIN k ON translate(regexp_replace(lower(name), '/0+(\\d)', '/\\1', 'g'), '/_(),- ;.', '') = k.k""")
def match_names(spark, sf):
    p = read(spark, sf, "part")
    size = F.col("p_size").cast("string")
    names = p.select(F.concat(F.lit("A/"), F.replace("p_name", F.lit(" "), F.lit("/")), F.lit("/0"), size).alias("name"))
    meta = p.select(F.concat(F.lit("a/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/"), size).alias("strain"))
    none = values(spark, "name string, strain string")
    return J.match_names(names, "name", meta, "strain", none, values(spark, "old_name string, new_name string"), F.col("name"))


@query("""WITH n AS (SELECT o_orderkey AS id, concat('s', o_custkey) AS nm FROM orders WHERE o_orderkey % 3 > 0), o AS (SELECT o_orderkey AS id, concat('s', CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_custkey END) AS nm FROM orders)
SELECT o.id, o.nm AS old_name, n.nm AS new_name, CASE WHEN n.nm IS NULL THEN 'missing' WHEN o.nm = n.nm THEN 'unchanged' ELSE 'changed' END AS status FROM o LEFT JOIN n ON o.id = n.id""")
def name_map_by_id(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    name = lambda c: F.concat(F.lit("s"), c.cast("string")).alias("nm")
    return J.name_map_by_id(o.select("id", name(F.when(F.col("id") % 7 == 0, 0).otherwise(F.col("o_custkey")))), o.where("id % 3 > 0").select("id", name(F.col("o_custkey"))), "id", "nm")


@query("""WITH q AS (SELECT DISTINCT p_name AS a FROM part WHERE p_partkey % 100 = 0), n AS (SELECT DISTINCT concat(p_name, 's') AS b FROM part),
s AS (SELECT a, b, round(1 - levenshtein(x, y) / greatest(length(x), length(y), 1), 6) AS similarity FROM (SELECT a, b, translate(regexp_replace(lower(a), '/0+(\\d)', '/\\1', 'g'), '/_(),- ;.', '') AS x, translate(regexp_replace(lower(b), '/0+(\\d)', '/\\1', 'g'), '/_(),- ;.', '') AS y FROM q, n))
SELECT a, rank, b, similarity FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b)::BIGINT AS rank FROM s WHERE similarity >= 0.8) WHERE rank <= 3""")
def fuzzy_candidates(spark, sf):
    p = read(spark, sf, "part")
    out = J.fuzzy_candidates(p.where("p_partkey % 100 = 0").select(F.col("p_name").alias("a")), p.select(F.concat("p_name", F.lit("s")).alias("b")), "a", "b")
    return out.select("a", *L("rank"), "b", "similarity")


# -- aggregations -------------------------------------------------------------------------------------------------


@query("SELECT coalesce(o_orderpriority, 'total') AS o_orderpriority, count(*)::BIGINT AS n FROM orders GROUP BY ROLLUP (o_orderpriority)")
def count_with_total(spark, sf):
    return A.count_with_total(read(spark, sf, "orders"), "o_orderpriority")


@query("""SELECT p_brand, count(*)::BIGINT AS n, count(DISTINCT p_type)::BIGINT AS n_p_type, max(p_size)::BIGINT AS latest, first(p_name ORDER BY p_retailprice DESC, p_partkey) AS best_p_name, round(avg(p_retailprice), 4) AS mean_p_retailprice FROM part GROUP BY p_brand""")
def summarise_haplotypes(spark, sf):
    out = A.summarise_haplotypes(read(spark, sf, "part"), "p_brand", "p_size", ["p_type"], ["p_name"], "p_retailprice", "p_partkey", ["p_retailprice"])
    return out.select("p_brand", "n", "n_p_type", *L("latest"), "best_p_name", *R("mean_p_retailprice"))


@query("SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM (SELECT user_id, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL)) WHERE r = 1")
def modal_value(spark, sf):
    return A.modal_value(read(spark, sf, "events"), "user_id", "event_type")


@query("SELECT p_brand, n, round(n / t, 6) AS proportion FROM (SELECT p_brand, count(DISTINCT p_type)::BIGINT AS n FROM part GROUP BY 1), (SELECT count(DISTINCT p_type) AS t FROM part)")
def proportion_of_total(spark, sf):
    return A.proportion_of_total(read(spark, sf, "part"), "p_brand", "p_type").select("p_brand", "n", *R("proportion", digits=6))


@query("SELECT user_id, count(*)::BIGINT AS n, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS items FROM events GROUP BY user_id")
def count_and_collect(spark, sf):
    return A.count_and_collect(read(spark, sf, "events"), "user_id", "event_type").withColumn("items", F.array_join("items", ","))


@query("""SELECT user_id, count(*)::BIGINT AS n, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, CASE WHEN count(DISTINCT event_type) > 1 THEN 'ERROR' ELSE min(event_type) END AS kind FROM events GROUP BY user_id""")
def merge_missing(spark, sf):
    e = read(spark, sf, "events")
    part = lambda k: e.where(f"event_id % 2 = {k}").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).select("user_id", "n", F.col("event_type").alias("types"), F.col("event_type").alias("kind"))
    return A.merge_missing([part(0), part(1)], "user_id", ["n"], ["types"], ["kind"])


_STATUS = "CASE event_type WHEN 'view' THEN 'match' WHEN 'click' THEN 'potential' ELSE 'none' END"


@query(f"""WITH e AS (SELECT year(ts) * 100 + week(ts) AS y, user_id AS v, (event_id % 5)::BIGINT AS s, {_STATUS} AS st FROM events),
a AS (SELECT coalesce(y::VARCHAR, 'total') AS y, count(*)::BIGINT AS strains_total, (count(*) FILTER (st = 'match'))::BIGINT AS strains_match FROM (SELECT DISTINCT y, v, st FROM e) GROUP BY ROLLUP (y)),
b AS (SELECT coalesce(y::VARCHAR, 'total') AS y, count(*)::BIGINT AS pairs_total, (count(*) FILTER (st = 'potential'))::BIGINT AS pairs_potential FROM (SELECT DISTINCT y, v, s, st FROM e) GROUP BY ROLLUP (y))
SELECT y, strains_total, strains_match, pairs_total, pairs_potential, round(100 * pairs_potential / pairs_total, 4) AS pairs_potential_pct FROM a JOIN b USING (y)""")
def match_statistics(spark, sf):
    e = read(spark, sf, "events").select((F.year("ts") * 100 + F.weekofyear("ts")).alias("y"), F.col("user_id").alias("v"), (F.col("event_id") % 5).alias("s"), F.expr(_STATUS).alias("st"))
    stats = A.match_stats(e, "y", "v", "s", "st")
    return stats.join(A.match_rates(stats, "y").select("y", *R("pairs_potential_pct")), "y").select("y", "strains_total", "strains_match", "pairs_total", "pairs_potential", "pairs_potential_pct")


@query("SELECT o_orderpriority, round(median(o_totalprice), 4) AS median_o_totalprice, round(median(o_totalprice) - stddev_samp(o_totalprice), 4) AS low_o_totalprice, round(median(o_totalprice) + stddev_samp(o_totalprice), 4) AS high_o_totalprice FROM orders GROUP BY 1")
def median_band(spark, sf):
    c = "o_totalprice"
    return A.median_band(read(spark, sf, "orders"), "o_orderpriority", [c]).select("o_orderpriority", *R(f"median_{c}", f"low_{c}", f"high_{c}"))


@query("""WITH s AS (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS t FROM lineitem GROUP BY ALL), l AS (SELECT l_suppkey, avg(t) + 1 * stddev_samp(t) AS lv FROM s GROUP BY 1)
SELECT l_linenumber::BIGINT AS site, count(*)::BIGINT AS n_sera FROM s JOIN l USING (l_suppkey) WHERE t >= lv GROUP BY 1""")
def threshold_sites(spark, sf):
    return A.threshold_sites(read(spark, sf, "lineitem"), "l_suppkey", "l_linenumber", "l_quantity", 1.0).select(F.col("l_linenumber").cast("long").alias("site"), "n_sera")


@query("SELECT l_returnflag, l_linestatus, round(avg(l_tax), 6) AS mean_weight, round(quantile_cont(l_tax, 0.8), 6) AS high_weight FROM lineitem GROUP BY ALL")
def weights_by_substitution(spark, sf):
    return A.weights_by_substitution(read(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_tax").select("l_returnflag", "l_linestatus", *R("mean_weight", "high_weight", digits=6))


@query("SELECT w AS mutation, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1 ORDER BY n DESC, mutation LIMIT 5")
def recurrent_mutations(spark, sf):
    return A.recurrent_mutations(read(spark, sf, "part").select(F.split("p_name", " ").alias("m")), "m", 5)


@query("""SELECT p_brand, p_type, round(avg(m), 4) AS titer FROM (SELECT p_brand, p_type, p_name, exp(avg(ln(p_retailprice))) AS m FROM part GROUP BY ALL) GROUP BY ALL""")
def titer_by_clade(spark, sf):
    return A.titer_by_clade(read(spark, sf, "part"), "p_brand", "p_name", "p_type", "p_retailprice").select("p_brand", "p_type", *R("titer"))


@query("""SELECT c_nationkey::BIGINT AS c_nationkey, round(avg(m), 4) AS coverage FROM (SELECT c_nationkey, 0 AS s, avg(c_acctbal) AS m FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS r FROM customer) WHERE r <= 3 GROUP BY 1
UNION ALL SELECT s_nationkey, 1, avg(s_acctbal) FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS r FROM supplier) WHERE r <= 3 GROUP BY 1) GROUP BY 1""")
def coverage(spark, sf):
    a = read(spark, sf, "customer").select("c_nationkey", F.col("c_custkey").alias("y"), F.col("c_acctbal").alias("v"))
    b = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("y"), F.col("s_acctbal").alias("v"))
    return A.coverage([a, b], "c_nationkey", "y", "v").select(*L("c_nationkey"), *R("coverage"))


@query("SELECT p_partkey, round(ln(p_retailprice / (SELECT sum(p_retailprice * p_size) / sum(p_size) FROM part)), 6) AS relative_fitness FROM part")
def relative_fitness(spark, sf):
    return A.relative_fitness(read(spark, sf, "part"), "p_retailprice", "p_size").select("p_partkey", *R("relative_fitness", digits=6))


@query("""WITH s AS (SELECT p_partkey, 2.0 * p_size + length(p_name) AS s, p_retailprice AS f FROM part), g AS (SELECT median(s) AS m, max(abs(f)) AS t FROM s)
SELECT p_partkey, round(s / (m + s) + f / t + 0.5, 6) AS score FROM s, g""")
def score_haplotypes(spark, sf):
    df = read(spark, sf, "part").withColumns({"n": F.length("p_name"), "share": F.lit(0.5)})
    return A.score_haplotypes(df, {"p_size": 2.0, "n": 1.0}, "p_retailprice", "share").select("p_partkey", *R("score", digits=6))


@query("SELECT user_id, (count(*) FILTER (event_type = 'view'))::BIGINT AS view, (count(*) FILTER (event_type = 'click'))::BIGINT AS click FROM events GROUP BY user_id")
def pivot_results(spark, sf):
    long = read(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return A.pivot_results(long, ["user_id"], "event_type", "n", ["view", "click"]).select("user_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("view", "click")])


@query("""SELECT event_type, value, user_id FROM (SELECT event_type, user_id, round(sum(value), 4) AS value FROM events GROUP BY ALL)
UNION ALL SELECT 'base', 1.0, user_id FROM (SELECT DISTINCT user_id FROM events)""")
def add_pivot_variant(spark, sf):
    long = read(spark, sf, "events").groupBy("event_type", "user_id").agg(F.round(F.sum("value"), 4).alias("value"))
    return A.add_pivot_variant(long, "event_type", "user_id", ["value"], "base")


@query("SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag) AS seq FROM lineitem WHERE l_linenumber IN (1, 2, 3) GROUP BY 1")
def concat_genes(spark, sf):
    df = read(spark, sf, "lineitem").withColumn("gene", F.col("l_linenumber").cast("string"))
    return A.concat_genes(df, "l_orderkey", "gene", "l_returnflag", ["1", "2", "3"])


# -- set operations -----------------------------------------------------------------------------------------------


@query("SELECT c_nationkey::BIGINT AS item FROM customer INTERSECT SELECT s_nationkey FROM supplier INTERSECT SELECT n_nationkey FROM nation")
def intersect_items(spark, sf):
    return A.intersect_items([read(spark, sf, t).select(F.col(c).alias("item")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))]).select(*L("item"))


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'a' WHEN a.k IS NULL THEN 'b' ELSE 'both' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a FULL OUTER JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') b ON a.k = b.k")
def key_difference(spark, sf):
    o = read(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    return A.key_difference(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), "k")


@query("SELECT DISTINCT item FROM (SELECT l_suppkey AS item FROM lineitem WHERE l_quantity > 49 UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) WHERE item NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def select_references(spark, sf):
    s = read(spark, sf, "supplier").withColumnRenamed("s_suppkey", "item")
    return A.select_references(read(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("item")), s.where("s_acctbal < 0"), s.where("s_acctbal > 5000").select("item"))


@query("""WITH v AS (SELECT floor(c_acctbal)::BIGINT AS y FROM customer UNION SELECT floor(s_acctbal)::BIGINT FROM supplier)
SELECT y, y IN (SELECT y FROM v) AS observed FROM (SELECT unnest(range(min(y), max(y) + 1)) AS y FROM v)""")
def contiguous_years(spark, sf):
    whole = lambda table, c: read(spark, sf, table).select(F.floor(c).cast("long").alias("y"))
    return A.contiguous_years([whole("customer", "c_acctbal"), whole("supplier", "s_acctbal")], "y")


# -- windows and sampling -----------------------------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def dedup_first(spark, sf):
    return W.dedup_first(read(spark, sf, "events"), "user_id", ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'error' DESC, value > 50 DESC, event_id) AS r FROM events) WHERE r = 1")
def prioritise(spark, sf):
    return W.prioritise(read(spark, sf, "events"), "user_id", "event_id", [F.col("event_type") == "error", F.col("value") > 50]).select("user_id", "event_id")


_HALF = 500


@query(f"""WITH s AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY n, lang, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, count(*) OVER (ORDER BY n, lang, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s),
q AS (SELECT coalesce(arg_min(floor(({_HALF} - below) / rest), n), {_HALF}) AS q FROM r WHERE floor(({_HALF} - below) / rest) < n),
t AS (SELECT lang, source, least(n, q) AS take, n > q AS open FROM s, q),
z AS (SELECT *, {_HALF} - (SELECT sum(take) FROM t) AS spare, count(*) FILTER (open) OVER (ORDER BY lang, source ROWS UNBOUNDED PRECEDING) AS place FROM t),
f AS (SELECT lang, source, take + CASE WHEN open AND place <= spare THEN 1 ELSE 0 END AS take FROM z)
SELECT doc_id, d.lang, d.source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, md5(concat(doc_id, '0')), doc_id) AS rn FROM documents) d JOIN f ON d.lang = f.lang AND d.source = f.source WHERE rn <= take""")
def subsample(spark, sf):
    return W.subsample(read(spark, sf, "documents").drop("text"), ["lang", "source"], _HALF, "doc_id", F.col("n_chars")).select("doc_id", "lang", "source")


@query("SELECT DISTINCT item FROM (SELECT * FROM (SELECT l_suppkey AS item FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10) UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) WHERE item NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000)")
def top_references(spark, sf):
    s = read(spark, sf, "supplier").withColumnRenamed("s_suppkey", "item")
    return W.top_references(read(spark, sf, "lineitem"), "l_suppkey", 10, s.where("s_acctbal < 0"), s.where("s_acctbal > 9000"))


@query("SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS a, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS b FROM part) WHERE a <= 2 OR b <= 15")
def top_per_group(spark, sf):
    return W.top_per_group(read(spark, sf, "part"), "p_brand", [F.desc("p_retailprice"), F.asc("p_partkey")], 2, 15).select("p_partkey", "p_brand")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND value > 20")
def latest_per_key(spark, sf):
    out = W.latest_per_key(read(spark, sf, "events"), ["user_id", "event_type"], "ts", "event_id")
    return out.where("value > 20").select("user_id", "event_type", "event_id", "value")


@query("SELECT translate(lower(p_name), '/_(),- ;.', '') AS key, count(*)::BIGINT AS n, array_to_string(list(p_partkey ORDER BY p_partkey), ',') AS sources FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicates(spark, sf):
    return W.duplicates(read(spark, sf, "part"), S.simplify_name(F.col("p_name")), "p_partkey").withColumn("sources", F.array_join(F.col("sources").cast("array<string>"), ","))


_DAILY = "SELECT event_type, ts::DATE AS d, count(*)::BIGINT AS n FROM events GROUP BY ALL"


def _daily(spark, sf):
    return read(spark, sf, "events").groupBy("event_type", day("ts").alias("d")).agg(F.count("*").alias("n"))


@query(f"""SELECT event_type, d, (n - lag(n, 3) OVER w)::BIGINT AS delta, round(n / sum(n) OVER (PARTITION BY d), 6) AS share,
round(sum(n) OVER (PARTITION BY event_type ORDER BY d ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) / 6, 6) AS smoothed,
round(avg(CASE WHEN n < 70 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY event_type ORDER BY d ROWS UNBOUNDED PRECEDING), 6) AS beats_naive FROM ({_DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY d)""")
def trajectories(spark, sf):
    df = W.delta(_daily(spark, sf), ["event_type"], "d", "n", 3)
    df = W.smooth(W.normalise(df, ["d"], "n", "share"), ["event_type"], "d", "n")
    df = W.beats_naive(df.withColumn("naive", F.lit(70)), ["event_type"], "d", "n", "naive")
    return df.select("event_type", "d", *L("delta"), *R("share", "smoothed", "beats_naive", digits=6))


@query(f"""SELECT event_type, round(avg(n), 6) AS mean, (max_by(n, d) - min_by(n, d))::BIGINT AS rise, round((max_by(n, d) - min_by(n, d)) / (min_by(n, d) + 0.01), 6) AS log_derivative
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS r FROM ({_DAILY})) WHERE r <= 6 GROUP BY 1 ORDER BY (max_by(n, d) - min_by(n, d)) / (min_by(n, d) + 0.01) DESC, 1 LIMIT 3""")
def rising(spark, sf):
    return W.rising(_daily(spark, sf), "event_type", "d", "n", 6, 3).select("event_type", *R("mean", digits=6), *L("rise"), *R("log_derivative", digits=6))


# -- sequences ----------------------------------------------------------------------------------------------------


@query("SELECT item_id, i::BIGINT AS site, substr(base, i, 1) AS ref, substr(seq, i, 1) AS alt FROM (SELECT item_id, text AS seq, (SELECT text FROM benchmark WHERE item_id = 0) AS base FROM benchmark), range(1, (SELECT max(length(text)) + 1 FROM benchmark)) t(i) WHERE i <= least(length(seq), length(base)) AND substr(base, i, 1) <> substr(seq, i, 1)")
def sequence_diff(spark, sf):
    b = read(spark, sf, "benchmark").select("item_id", F.col("text").alias("seq"))
    df = b.withColumn("base", b.where("item_id = 0").select("seq").scalar())
    return df.select("item_id", F.explode(S.sequence_diff(F.col("base"), F.col("seq"))).alias("x")).select("item_id", F.col("x.site").cast("long").alias("site"), "x.ref", "x.alt")


@query("""WITH s AS (SELECT event_id AS s, ts::DATE AS t, concat(event_type, lpad((value * 100)::BIGINT::VARCHAR, 12, '0')) AS q FROM events)
SELECT a.s AS sample, b.s AS other_sample, (list_sum(list_transform(range(1, greatest(length(a.q), length(b.q)) + 1), lambda i: CASE WHEN substr(a.q, i, 1) = substr(b.q, i, 1) THEN 0 ELSE 1 END)))::BIGINT AS distance FROM s a JOIN s b ON a.s % 100 = 0 AND a.s <> b.s AND (a.t = b.t OR b.t = a.t + INTERVAL 1 MONTH)""")
def pairwise_hamming(spark, sf):
    s = read(spark, sf, "events").select("event_id", day("ts").alias("t"), F.concat("event_type", F.lpad(F.round(F.col("value") * 100).cast("long").cast("string"), 12, "0")).alias("q"))
    return Q.pairwise_hamming(s, "t", 1, "event_id", "q", F.col("event_id") % 100 == 0).select("sample", "other_sample", *L("distance"))


@query("""WITH c AS (SELECT i::BIGINT AS site, substr(s, i, 1) AS ch, count(*) AS n FROM (SELECT text AS s FROM documents), range(1, (SELECT max(length(text)) + 1 FROM documents)) t(i) WHERE i <= length(s) GROUP BY ALL)
SELECT site, abs(round(-sum(n / t * ln(n / t + 1e-15)), 6)) AS entropy FROM c JOIN (SELECT site, sum(n) AS t FROM c GROUP BY 1) USING (site) GROUP BY site""")
def site_entropy(spark, sf):
    return Q.site_entropy(read(spark, sf, "documents").select(F.col("text").alias("s")), "s").select(*L("site"), F.abs(F.round("entropy", 6)).alias("entropy"))


@query("""SELECT p_partkey, CASE WHEN list_has_all(w, ['blue']) AND p_type = 'ECONOMY' THEN 'b' WHEN list_has_all(w, ['small', 'ring']) THEN 'sr' WHEN list_has_all(w, ['small']) THEN 's' ELSE p_type END AS haplotype FROM (SELECT *, string_split(p_name, ' ') AS w FROM part)""")
def assign_haplotypes(spark, sf):
    defs = values(spark, "haplotype string, required array<string>, rule_order int, clade string", ("s", ["small"], 0, None), ("sr", ["small", "ring"], 1, ""), ("b", ["blue"], 2, "ECONOMY"))
    return Q.assign_haplotypes(read(spark, sf, "part"), defs, "p_partkey", F.split("p_name", " "), "p_type", F.col("p_type")).select("p_partkey", "haplotype")


@query("""SELECT p_partkey, (length(p_name) - length(replace(p_name, ' ', '')) + 1)::BIGINT AS mutations, concat(p_type, ':', replace(p_name, ' ', '-')) AS haplotype, (length(p_name) - length(translate(p_name, 'ae', '')))::BIGINT AS gaps, len(regexp_extract_all(p_name, '[aeiou][^aeiou ]'))::BIGINT AS motifs FROM part""")
def mutation_features(spark, sf):
    names = F.replace("p_name", F.lit(" "), F.lit(","))
    df = Q.mutation_counts(read(spark, sf, "part").withColumn("m", names), "m", {})
    return df.select("p_partkey", *L("mutations"), S.derived_haplotype(F.col("p_type"), F.col("m")).alias("haplotype"), S.gap_count(F.col("p_name"), "ae").cast("long").alias("gaps"), S.motif_count(F.col("p_name"), "[aeiou][^aeiou ]").cast("long").alias("motifs"))


@query("""WITH p AS (SELECT a.item_id AS a, b.item_id AS b, a.text AS x, b.text AS y FROM benchmark a, benchmark b WHERE a.item_id % 100 = 0 AND a.item_id <> b.item_id)
SELECT a, b, round(sum(CASE WHEN i > least(length(x), length(y)) OR substr(x, i, 1) = substr(y, i, 1) THEN 0 WHEN i = 3 AND substr(x, i, 1) = 'a' AND substr(y, i, 1) = 't' THEN 2.5 WHEN i % 2 = 0 THEN 0.5 ELSE 1.0 END), 6) AS distance FROM p, range(1, (SELECT max(length(text)) + 1 FROM benchmark)) t(i) WHERE i <= greatest(length(x), length(y)) GROUP BY a, b""")
def substitution_distance(spark, sf):
    b = read(spark, sf, "benchmark").select("item_id", F.col("text").alias("s"))
    pairs = Q.query_pairs(b, "item_id", "s", F.col("item_id") % 100 == 0)  # a stated query set against all rows
    even = b.agg(F.max(F.length("s")).alias("n")).select(F.explode(F.sequence(F.lit(2), F.greatest("n", F.lit(2)), F.lit(2))).alias("site"))
    weights = even.select("site", F.lit(None).cast("string").alias("from"), F.lit(None).cast("string").alias("to"), F.lit(0.5).alias("weight")).union(values(spark, "site int, `from` string, `to` string, weight double", (3, "a", "t", 2.5)))
    return Q.substitution_distance(pairs, "x", "y", weights, ["a", "b"], 1.0).select("a", "b", *R("distance", digits=6))


# -- trees --------------------------------------------------------------------------------------------------------

_TREE = "SELECT s_suppkey + 1 AS node, CASE WHEN s_suppkey > 0 THEN (s_suppkey + 1) // 2 END AS parent FROM supplier"
_CLOSURE = f"RECURSIVE e AS ({_TREE}), c(node, ancestor, hops) AS (SELECT node, node, 0 FROM e UNION ALL SELECT c.node, e.parent, c.hops + 1 FROM c JOIN e ON c.ancestor = e.node WHERE e.parent IS NOT NULL)"


def _tree(spark, sf):
    node = F.col("s_suppkey") + 1
    n = read(spark, sf, "supplier").select(node.alias("node"), F.when(node > 1, F.floor(node / 2)).alias("parent"), "s_acctbal")
    inner = n.select(F.col("parent").alias("node"), F.lit(False).alias("t")).where("node is not null").distinct()
    return n.join(inner, "node", "left").select("node", "parent", F.coalesce("t", F.lit(True)).alias("is_terminal"), F.col("node").alias("preorder"), "s_acctbal")


@query(f"WITH {_CLOSURE} SELECT node, ancestor, hops::BIGINT AS hops FROM c")
def tree_closure(spark, sf):
    return T.closure(_tree(spark, sf)).select("node", "ancestor", *L("hops"))


@query(f"""WITH {_CLOSURE}, t AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL))
SELECT ancestor AS node, round(sum(s_acctbal), 2) AS total, count(*)::BIGINT AS n FROM c JOIN t USING (node) JOIN supplier ON s_suppkey + 1 = node GROUP BY 1""")
def sum_descendants(spark, sf):
    e = _tree(spark, sf)
    return T.sum_descendants(T.closure(e), T.tips_only(e).select("node", "s_acctbal"), "s_acctbal").select(F.col("ancestor").alias("node"), *R("total", digits=2), "n")


@query(f"""WITH {_CLOSURE}, t AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL)),
a AS (SELECT ancestor, avg(s_acctbal) AS a, count(*) AS n FROM c JOIN t USING (node) JOIN supplier ON s_suppkey + 1 = node GROUP BY 1 HAVING count(*) > 5)
SELECT node, round(arg_min(a, hops), 4) AS average FROM c JOIN a USING (ancestor) GROUP BY node""")
def clade_average(spark, sf):
    e = _tree(spark, sf)
    return T.clade_average(T.closure(e), T.tips_only(e).select("node", "s_acctbal"), F.col("s_acctbal"), 5).select("node", *R("average"))


@query(f"WITH {_CLOSURE} SELECT c.node, round(sum(s_acctbal), 2) AS total FROM c JOIN supplier ON s_suppkey + 1 = c.ancestor GROUP BY 1")
def path_sum(spark, sf):
    e = _tree(spark, sf)
    return T.path_sum(e, e, "s_acctbal").select("node", *R("total", digits=2))


@query(f"""WITH {_CLOSURE}, s AS (SELECT c.node, sum(abs(s_acctbal)) AS t FROM c JOIN supplier ON s_suppkey + 1 = c.ancestor GROUP BY 1),
p AS (SELECT x.node AS a, y.node AS b FROM e x JOIN e y ON y.node = x.node + 7),
m AS (SELECT p.a, p.b, arg_min(x.ancestor, x.hops) AS m FROM p JOIN c x ON x.node = p.a JOIN c y ON y.node = p.b AND y.ancestor = x.ancestor GROUP BY ALL)
SELECT a, b, round(sa.t + sb.t - 2 * sm.t, 2) AS distance FROM m JOIN s sa ON sa.node = a JOIN s sb ON sb.node = b JOIN s sm ON sm.node = m""")
def path_distance(spark, sf):
    e = _tree(spark, sf).withColumn("v", F.abs("s_acctbal"))
    n = e.select("node")
    pairs = n.select(F.col("node").alias("a")).join(n.select(F.col("node").alias("b")), F.col("b") == F.col("a") + 7)
    return T.path_distance(e, e, "v", pairs).select("a", "b", *R("distance", digits=2))


@query(f"""WITH {_CLOSURE}, l AS (SELECT node, concat('c', node % 4) AS label FROM e WHERE node % 3 = 0) SELECT c.node, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM c JOIN l ON l.node = c.ancestor GROUP BY 1""")
def inherited_labels(spark, sf):
    e = _tree(spark, sf)
    labels = e.where("node % 3 = 0").select("node", F.concat(F.lit("c"), (F.col("node") % 4).cast("string")).alias("label"))
    return T.inherited_labels(T.closure(e), labels, "label").withColumn("labels", F.array_join("labels", ","))


@query(f"""WITH {_CLOSURE}, l AS (SELECT node, floor(node / 3) AS label FROM e), t AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL)),
k AS (SELECT label FROM l JOIN t USING (node) GROUP BY 1 HAVING count(*) >= 3), u AS (SELECT node, label FROM l WHERE label IN (SELECT label FROM k) OR node = 1)
SELECT c.node, arg_min(label, hops)::BIGINT AS label FROM c JOIN u ON u.node = c.ancestor GROUP BY 1""")
def collapse_rare(spark, sf):
    e = _tree(spark, sf)
    return T.collapse_rare(e, e.select("node", F.floor(F.col("node") / 3).alias("label")), "label", 3)


# -- frequencies --------------------------------------------------------------------------------------------------


@query("""WITH x AS (SELECT event_id, user_id, (epoch(ts) - epoch(TIMESTAMP '2024-01-01')) / 86400 AS x FROM events), g AS (SELECT i AS p FROM range(0, 31, 3) t(i)),
m AS (SELECT user_id, p, sum(0.8 * exp(-0.5 * pow((x - p) / 1.0, 2)) / (1.0 * sqrt(2 * pi())) + 0.2 * exp(-0.5 * pow((x - p) / 3.0, 2)) / (3.0 * sqrt(2 * pi()))) AS m FROM x JOIN g ON abs(x - p) <= 24 GROUP BY ALL)
SELECT user_id, p::BIGINT AS pivot, round(m / sum(m) OVER (PARTITION BY p), 6) AS frequency FROM m WHERE m > 0""")
def kde_frequencies(spark, sf):
    x = F.timestamp_diff("microsecond", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / 86_400_000_000
    df = read(spark, sf, "events").select("user_id", x.alias("x"))
    return K.kde_frequencies(df, "user_id", "x", spark.range(0, 31, 3).withColumnRenamed("id", "pivot"), 1.0, 3.0, 0.8).select("user_id", *L("pivot"), *R("frequency", digits=6))


@query(f"""SELECT o_orderpriority, m AS month, coalesce(n, 0)::BIGINT AS n FROM (SELECT o_orderpriority, unnest(generate_series(min(m)::TIMESTAMP, max(m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM ({_MONTHS}) WHERE n > 0 GROUP BY 1) LEFT JOIN (SELECT * FROM ({_MONTHS}) WHERE n > 0) USING (o_orderpriority, m)""")
def monthly_counts(spark, sf):
    o = read(spark, sf, "orders").select("o_orderpriority", day("o_orderdate").alias("d"))
    return K.monthly_counts(o, ["o_orderpriority"], "d")


@query("""WITH c AS (SELECT o_orderstatus AS region, o_orderpriority AS clade, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT region, month, sum(n) AS t FROM c GROUP BY ALL),
g AS (SELECT t.region, k.clade, t.month, CASE WHEN t.t >= 5 THEN coalesce(c.n, 0) / t.t END AS share FROM t JOIN (SELECT DISTINCT region, clade FROM c) k USING (region) LEFT JOIN c ON c.region = t.region AND c.clade = k.clade AND c.month = t.month)
SELECT region, clade, month, round(share, 6) AS share FROM g WHERE clade IN (SELECT clade FROM g GROUP BY 1 HAVING max(share) > 0.05)""")
def monthly_share(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderstatus").alias("region"), F.col("o_orderpriority").alias("clade"), day("o_orderdate").alias("d"))
    return K.monthly_share(o, "region", "clade", "d").select("region", "clade", "month", *R("share", digits=6))


@query("""WITH f AS (SELECT c_mktsegment AS v, c_nationkey % 5 AS region, sum(c_acctbal) AS s FROM customer GROUP BY ALL)
SELECT v, round(sum(s * (region + 1)) / 20, 4) AS frequency FROM f WHERE region < 4 GROUP BY v""")
def global_frequency(spark, sf):
    f = read(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("v"), (F.col("c_nationkey") % 5).alias("region")).agg(F.sum("c_acctbal").alias("s"))
    weights = values(spark, "region int, weight double", *[(i, i + 1.0) for i in range(4)], (9, 10.0))
    return K.global_frequency(f, weights, ["v"], "region", "s").select("v", *R("frequency"))


@query(f"""WITH f AS (SELECT event_type, d, n FROM ({_DAILY})), l AS (SELECT event_type, sum(CASE WHEN r = 1 THEN n END) AS c, sum(CASE WHEN r = 4 THEN n END) AS p FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS r FROM f) GROUP BY 1)
SELECT event_type, c::BIGINT AS current, p::BIGINT AS previous, (c - p)::BIGINT AS delta FROM l""")
def group_frequency_delta(spark, sf):
    return K.group_frequency_delta(_daily(spark, sf), "event_type", "d", "n", 3)


@query(f"""WITH s AS (SELECT event_type, 2 * date_diff('day', DATE '2024-01-01', d) AS x0, n AS y0, 2 * lead(date_diff('day', DATE '2024-01-01', d)) OVER w AS x1, lead(n) OVER w AS y1 FROM ({_DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY d))
SELECT event_type, t::BIGINT AS timepoint, round(y0 + (y1 - y0) * (t - x0) / (x1 - x0), 6) AS n FROM s JOIN range(1, 53) g(t) ON t >= x0 AND t < x1""")
def interpolate(spark, sf):
    d = _daily(spark, sf).select("event_type", (2 * F.datediff("d", F.lit("2024-01-01"))).alias("x"), F.col("n").cast("double").alias("n"))
    return K.interpolate(d, "event_type", "x", "n", spark.range(1, 53).withColumnRenamed("id", "timepoint")).select("event_type", "timepoint", *R("n", digits=6))


@query(f"""WITH f AS (SELECT event_type, d, n / sum(n) OVER (PARTITION BY d) AS p FROM ({_DAILY})), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS r FROM f)
SELECT event_type, round(regr_slope(ln(p / (1 - p)), date_diff('day', DATE '2024-01-01', d)), 6) AS slope FROM r WHERE r <= 10 GROUP BY 1""")
def logit_slope(spark, sf):
    f = W.normalise(_daily(spark, sf), ["d"], "n", "p").withColumn("x", F.datediff("d", F.lit("2024-01-01")))
    return K.logit_slope(f, "event_type", "x", "p", 10).select("event_type", *R("slope", digits=6))


# -- forecasts ----------------------------------------------------------------------------------------------------

_PANEL = """p AS (SELECT date_trunc('month', l_shipdate)::DATE AS t, l_suppkey % 12 AS strain, l_suppkey % 3 AS clade, sum(l_quantity) AS q, avg(l_discount) AS d, avg(l_tax) AS x FROM lineitem GROUP BY ALL),
f AS (SELECT *, q / sum(q) OVER (PARTITION BY t) AS f FROM p),
g AS (SELECT *, sum(f) OVER (PARTITION BY t) AS w, sum(f * d) OVER (PARTITION BY t) AS d1, sum(f * d * d) OVER (PARTITION BY t) AS d2, sum(f * x) OVER (PARTITION BY t) AS x1, sum(f * x * x) OVER (PARTITION BY t) AS x2 FROM f),
s AS (SELECT t, strain, clade, f, CASE WHEN sqrt(greatest(d2 / w - (d1 / w) * (d1 / w), 0)) > 1e-12 THEN (d - d1 / w) / sqrt(greatest(d2 / w - (d1 / w) * (d1 / w), 0)) ELSE d END AS d, CASE WHEN sqrt(greatest(x2 / w - (x1 / w) * (x1 / w), 0)) > 1e-12 THEN (x - x1 / w) / sqrt(greatest(x2 / w - (x1 / w) * (x1 / w), 0)) ELSE x END AS x FROM g)"""


def _panel(spark, sf):
    p = read(spark, sf, "lineitem").groupBy(F.trunc(day("l_shipdate"), "month").alias("t"), (F.col("l_suppkey") % 12).alias("strain"), (F.col("l_suppkey") % 3).alias("clade")).agg(F.sum("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("x"))
    return W.normalise(p, ["t"], "q", "f").select("t", "strain", "clade", "f", "d", "x")


@query(f"WITH {_PANEL} SELECT t, clade, strain, round(d, 5) AS d, round(x, 5) AS x FROM s")
def standardise(spark, sf):
    return M.standardise(_panel(spark, sf), ["d", "x"], "f", "t").select("t", "clade", "strain", *R("d", "x", digits=5))


@query(f"WITH {_PANEL}, j AS (SELECT *, f * exp((0.4 * d - 0.3 * x) * 0.5) AS e FROM s), n AS (SELECT *, e / sum(e) OVER (PARTITION BY t) AS pr FROM j) SELECT t, clade, round(sum(f), 6) AS initial, round(sum(pr), 6) AS projected FROM n GROUP BY t, clade")
def project_clades(spark, sf):
    return M.project_clades(_panel(spark, sf), "t", "clade", {"d": 0.4, "x": -0.3}, "f", 0.5).select("t", "clade", *R("initial", "projected", digits=6))


@query(f"WITH {_PANEL}, h AS (SELECT s.*, h, f * exp(0.4 * d * h / 12.0) AS e FROM s, range(1, 4) r(h)) SELECT t, strain, clade, h::BIGINT AS horizon, (t + h * INTERVAL 1 MONTH)::DATE AS future_timepoint, round(e / sum(e) OVER (PARTITION BY t, h), 6) AS projected FROM h")
def forecast(spark, sf):
    fit = M.fitness(M.standardise(_panel(spark, sf), ["d", "x"], "f", "t"), {"d": 0.4})
    return M.forecast(fit, "f", "fitness", "t", [1, 2, 3]).select("t", "strain", "clade", *L("horizon"), "future_timepoint", *R("projected", digits=6))


@query(f"""WITH {_PANEL}, c AS (SELECT t, clade, sum(f) AS f FROM s GROUP BY ALL), k AS (SELECT DISTINCT (t - INTERVAL 12 MONTH)::DATE AS t FROM c)
SELECT c.t, c.clade, round(c.f, 6) AS frequency, round(coalesce(n.f, 0), 6) AS future FROM c JOIN k ON k.t = c.t LEFT JOIN c n ON n.clade = c.clade AND n.t = (c.t + INTERVAL 12 MONTH)::DATE""")
def future_frequency(spark, sf):
    return K.future_frequency(_panel(spark, sf), "t", "clade", "f", 12).select("t", "clade", *R("frequency", "future", digits=6))


@query(f"""WITH {_PANEL}, n AS (SELECT t, clade, count(*) AS c FROM s GROUP BY ALL), u AS (SELECT s.*, f + 0.1 / c AS u FROM s JOIN n USING (t, clade)) SELECT t, strain, clade, round(u / sum(u) OVER (PARTITION BY t), 6) AS f FROM u""")
def add_pseudocounts(spark, sf):
    return K.add_pseudocounts(_panel(spark, sf), "t", "clade", "f", 0.1).select("t", "strain", "clade", *R("f", digits=6))


_SCORED = f"""WITH {_PANEL}, j AS (SELECT *, f * exp((0.4 * d - 0.3 * x) * 1.0) AS e FROM s), n AS (SELECT *, e / sum(e) OVER (PARTITION BY t) AS pr FROM j), c AS (SELECT t, clade, sum(f) AS i, sum(pr) AS e FROM n GROUP BY ALL),
o AS (SELECT c.t, c.clade, c.i, c.e, coalesce(z.i, 0) AS o FROM c LEFT JOIN c z ON z.clade = c.clade AND z.t = (c.t + INTERVAL 12 MONTH)::DATE)"""


def _scored(spark, sf):
    c = M.project_clades(_panel(spark, sf), "t", "clade", {"d": 0.4, "x": -0.3}, "f", 1.0).select("t", "clade", F.col("initial").alias("i"), F.col("projected").alias("e"))
    observed = c.select(F.add_months("t", -12).alias("t"), "clade", F.col("i").alias("observed"))
    return M.align_observed(c, observed, ["t", "clade"])


@query(f"{_SCORED} SELECT 'all' AS split, round(sum((o - e) * (o - e)), 5) AS sse, round(sqrt(avg((o - e) * (o - e))), 6) AS rmse, round(avg(abs(o - e)), 6) AS mae, round(-sum(CASE WHEN o <> 0 THEN o * ln(e / i) END), 5) AS information_gain, round(sum(o - e), 5) AS difference FROM o")
def losses(spark, sf):
    s = _scored(spark, sf).withColumn("split", F.lit("all"))
    return s.groupBy("split").agg(*[F.round(f(F.col("observed"), F.col("e"), F.col("i")), 6 if n in ("rmse", "mae") else 5).alias(n) for n, f in M.LOSSES.items()])


@query(f"{_SCORED}, k AS (SELECT count(*) FILTER (o > i AND e > i) AS tp, count(*) FILTER (o <= i AND e <= i) AS tn, count(*) FILTER (o <= i AND e > i) AS fp, count(*) FILTER (o > i AND e <= i) AS fn FROM o) SELECT tp::BIGINT AS tp, tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, round((tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc FROM k")
def growth_mcc(spark, sf):
    return M.growth_mcc(_scored(spark, sf), "i", "observed", "e").select("tp", "tn", "fp", "fn", *R("mcc", digits=6))


@query(f"{_SCORED} SELECT round(corr(i, o), 5) AS initial_observed, round(corr(o, e), 5) AS observed_estimated, round(corr(o / i, e / i), 5) AS growth FROM o")
def correlations(spark, sf):
    return M.correlations(_scored(spark, sf), "i", "observed", "e").select(*R("initial_observed", "observed_estimated", "growth", digits=5))


@query("""WITH t AS (SELECT DISTINCT date_trunc('month', l_shipdate)::DATE AS t FROM lineitem), v AS (SELECT t AS validate, (t - INTERVAL 12 MONTH)::DATE AS l, (t - INTERVAL 48 MONTH)::DATE AS f FROM t)
SELECT validate, t.t AS train FROM v JOIN t ON t.t <= l AND t.t >= f WHERE f >= (SELECT min(t) FROM t)""")
def train_validate_splits(spark, sf):
    t = read(spark, sf, "lineitem").select(F.trunc(day("l_shipdate"), "month").alias("t")).distinct()
    return M.train_validate_splits(t, "t", 12, 3)


_CANDIDATES = [("a", 0.0, 0.0), ("b", 0.4, -0.3), ("c", -0.2, 0.1), ("d", 1.0, 1.0)]


@query(f"""WITH {_PANEL}, b(candidate, bd, bx) AS (VALUES {", ".join(str(c) for c in _CANDIDATES)}), j AS (SELECT s.*, candidate, bd, bx, f * exp((bd * d + bx * x) * 1.0) AS e FROM s, b), n AS (SELECT *, e / sum(e) OVER (PARTITION BY candidate, t) AS pr FROM j),
c AS (SELECT candidate, bd, bx, t, clade, sum(f) AS i, sum(pr) AS e FROM n GROUP BY ALL), z AS (SELECT t, clade, sum(f) AS o FROM s GROUP BY ALL)
SELECT candidate, round(avg(abs(coalesce(o, 0) - e)) + 0.1 * (abs(bd) + abs(bx)), 6) AS loss FROM c LEFT JOIN z ON z.clade = c.clade AND z.t = (c.t + INTERVAL 12 MONTH)::DATE GROUP BY candidate, bd, bx""")
def search_coefficients(spark, sf):
    p = _panel(spark, sf)
    observed = p.groupBy("t", "clade").agg(F.sum("f").alias("observed")).select(F.add_months("t", -12).alias("t"), "clade", "observed")
    return M.search_coefficients(p, values(spark, "candidate string, d double, x double", *_CANDIDATES), ["d", "x"], "t", "clade", "f", observed, 1.0, "mae", 0.1).select("candidate", *R("loss", digits=6))


# -- comparison ---------------------------------------------------------------------------------------------------

_NEW = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 17 > 0"
_OLD = "SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 19 > 0"


def _versions(spark, sf):
    o = read(spark, sf, "orders")
    new = o.where("o_orderkey % 17 > 0").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 11 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END").alias("p"), F.col("o_orderstatus").alias("s"))
    return o.where("o_orderkey % 19 > 0").select("o_orderkey", F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s")), new


_DIFF = f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'removed record' WHEN a.o_orderkey IS NULL THEN 'added record' WHEN nullif(b.p, '') IS NULL THEN 'removed' ELSE 'modified' END AS change,
CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'p' END AS field, CASE WHEN b.o_orderkey IS NOT NULL THEN a.p END AS was, CASE WHEN a.o_orderkey IS NOT NULL THEN nullif(b.p, '') END AS now
FROM ({_OLD}) a FULL OUTER JOIN ({_NEW}) b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.p IS DISTINCT FROM b.p"""


@query(_DIFF)
def diff_records(spark, sf):
    return U.diff_records(*_versions(spark, sf), "o_orderkey")


@query(f"SELECT change, field, count(DISTINCT o_orderkey)::BIGINT AS n, CASE WHEN count(DISTINCT o_orderkey) = 1 THEN min(o_orderkey::VARCHAR) END AS only FROM ({_DIFF}) GROUP BY ALL")
def diff_summary(spark, sf):
    return U.diff_summary(U.diff_records(*_versions(spark, sf), "o_orderkey"), "o_orderkey")


@query(f"SELECT a.o_orderkey, 'p' AS field, a.p AS was, b.p AS now, CASE WHEN lower(a.p) = lower(b.p) THEN 'case_only' ELSE 'different' END AS kind FROM ({_OLD}) a JOIN ({_NEW}) b ON a.o_orderkey = b.o_orderkey WHERE a.p <> '' AND a.p IS DISTINCT FROM b.p")
def diff_one_sided(spark, sf):
    return U.diff_one_sided(*_versions(spark, sf), "o_orderkey", ["p", "s"])


@query(f"SELECT (SELECT count(*) FROM ({_NEW}))::BIGINT AS records, (SELECT count(*) FROM ({_OLD}))::BIGINT AS previous, ((SELECT count(*) FROM ({_NEW})) - (SELECT count(*) FROM ({_OLD})))::BIGINT AS delta, true AS changed")
def record_change(spark, sf):
    old, new = _versions(spark, sf)
    return U.record_change(new, old)

# -- further operators --------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name, c_mktsegment AS c_mktsegment_ha, CASE WHEN s_suppkey IS NULL THEN NULL ELSE s_name END AS c_name_na, true AS ha, s_suppkey IS NOT NULL AS na FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def join_segments(spark, sf):
    a = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment")
    b = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("c_name"))
    out = J.join_segments({"ha": a, "na": b.withColumn("c_mktsegment", F.lit(None).cast("string"))}, "id", ["c_name", "c_mktsegment"], "left")
    return out.select("id", F.col("c_name_ha").alias("c_name"), "c_mktsegment_ha", "c_name_na", "ha", "na")


_HOSTS = {"economy": "Human", "standard": "Avian", "promo": "Nonhuman Mammal", "red": "Cattle"}


@query("""SELECT p_partkey, CASE WHEN h = 'economy' THEN 'Human' WHEN h = 'standard' THEN 'Avian' WHEN h = 'promo' THEN CASE WHEN g = 'red' THEN 'Cattle' ELSE 'Nonhuman Mammal' END WHEN h = 'red' THEN 'Cattle' ELSE host END AS host
FROM (SELECT *, CASE WHEN host = '' THEN g ELSE replace(lower(host), ' ', '') END AS h FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS host, CASE WHEN p_partkey % 2 = 0 THEN lower(split_part(p_name, ' ', 1)) ELSE '' END AS g FROM part))""")
def classify_host(spark, sf):
    classes = F.create_map(*[F.lit(x) for kv in _HOSTS.items() for x in kv])
    k = F.col("p_partkey")
    strain = F.when(k % 2 == 0, F.concat(F.lit("A/"), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit("/x/1/2000"))).otherwise("A/x/1/2000")
    df = read(spark, sf, "part").select("p_partkey", F.when(k % 4 == 0, "").otherwise(F.col("p_type")).alias("h"), strain.alias("s"))
    return df.select("p_partkey", S.classify_host(F.col("h"), F.col("s"), classes).alias("host"))


@query("""SELECT c_custkey, CASE WHEN s = 'machinery' THEN 'A' WHEN s = 'building' THEN 'B' ELSE 'tbd' END AS type, CASE WHEN s = 'machinery' THEN 'mach' WHEN s = 'building' THEN 'build' ELSE 'tbd' END AS standard_lineage FROM (SELECT c_custkey, lower(c_mktsegment) AS s FROM customer)""")
def map_lineage(spark, sf):
    dim = values(spark, "subtype string, lineage string, type string, name string", ("machinery", "", "A", "mach"), ("building", "", "B", "build"))
    df = read(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.lit("seasonal").alias("l"))
    return J.map_lineage(df, "c_mktsegment", "l", F.lit(""), dim).select("c_custkey", "type", "standard_lineage")


@query("""WITH a AS (SELECT c_custkey AS a, floor(c_acctbal)::BIGINT AS c, c_acctbal AS p FROM customer), b AS (SELECT s_suppkey AS b, floor(s_acctbal)::BIGINT AS c, s_acctbal AS p FROM supplier),
s AS (SELECT x.a, y.b, 'balance' AS stage FROM (SELECT p, min(a) AS a FROM a GROUP BY p) x JOIN (SELECT p, min(b) AS b FROM b GROUP BY p) y USING (p)),
s1 AS (SELECT min(a) AS a, b FROM (SELECT a, min(b) AS b FROM s GROUP BY a) GROUP BY b),
t AS (SELECT x.a, y.b FROM (SELECT c, min(a) AS a FROM a WHERE a NOT IN (SELECT a FROM s1) GROUP BY c) x JOIN (SELECT c, min(b) AS b FROM b WHERE b NOT IN (SELECT b FROM s1) GROUP BY c) y USING (c))
SELECT a, b, 'balance' AS stage FROM s1 UNION ALL SELECT min(a), b, 'whole' FROM (SELECT a, min(b) AS b FROM t GROUP BY a) GROUP BY b""")
def link_in_stages(spark, sf):
    side = lambda table, k, bal: read(spark, sf, table).select(k, F.floor(bal).cast("string").alias("c"), F.format_string("%.2f", F.col(bal).cast("double")).alias("p"))
    a, b = side("customer", "c_custkey", "c_acctbal").withColumnRenamed("c_custkey", "a"), side("supplier", "s_suppkey", "s_acctbal").withColumnRenamed("s_suppkey", "b")
    return J.link_in_stages(a, b, "a", "b", [("balance", F.col("p"), F.col("p")), ("whole", F.col("c"), F.col("c"))])



@query("SELECT l_suppkey::BIGINT AS virus, sum(CASE WHEN r = 'virus' THEN 1 ELSE 0 END)::BIGINT AS virus_count, sum(CASE WHEN r = 'serum' THEN 1 ELSE 0 END)::BIGINT AS serum_count, min(l_returnflag) AS candidate FROM (SELECT l_suppkey, 'virus' AS r, l_returnflag FROM lineitem UNION ALL SELECT l_partkey, 'serum', l_returnflag FROM lineitem) GROUP BY 1")
def missing_strains(spark, sf):
    df = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("virus"), F.col("l_partkey").alias("serum"), F.col("l_returnflag").alias("candidate"))
    return A.missing_strains(df, ["virus", "serum"], "candidate").select(F.col("name").alias("virus"), "virus_count", "serum_count", "candidate")


@query("""WITH r AS (SELECT l_returnflag AS region, l_linenumber AS site, l_linestatus AS wildtype, l_returnflag AS mutant, round(avg(l_tax), 6) AS weight FROM lineitem GROUP BY ALL)
SELECT region AS gene, CASE WHEN region = 'A' THEN site + (SELECT max(site) FROM r WHERE region <> 'A') ELSE site END::BIGINT AS site, wildtype AS "from", mutant AS "to", weight FROM r WHERE wildtype <> mutant AND weight IS NOT NULL""")
def phenotype_to_map(spark, sf):
    r = read(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("region"), F.col("l_linenumber").alias("site"), F.col("l_linestatus").alias("wildtype"), F.col("l_returnflag").alias("mutant")).agg(F.round(F.avg("l_tax"), 6).alias("weight"))
    return A.phenotype_to_map(r, "weight", "A").select("gene", *L("site"), "from", "to", "weight")


@query("SELECT p_brand, round(median(p_retailprice), 4) AS autologous FROM part WHERE p_size % 25 = TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) GROUP BY 1")
def autologous(spark, sf):
    df = read(spark, sf, "part").withColumn("test", F.concat(F.lit("Brand#"), (F.col("p_size") % 25).cast("string")))
    return A.autologous(df, "p_brand", "test", "p_retailprice").select("p_brand", *R("autologous"))


@query("""WITH c AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, avg(p_retailprice), p_type) AS o FROM part GROUP BY 1)
SELECT p_brand, p_type, round(avg(p_retailprice), 4) AS mean, round(stddev_samp(p_retailprice), 4) AS sd, any_value(o)::BIGINT AS clade_order FROM part JOIN c USING (p_type) GROUP BY p_brand, p_type""")
def reference_profile(spark, sf):
    return A.reference_profile(read(spark, sf, "part"), "p_brand", "p_type", "p_retailprice").select("p_brand", "p_type", *R("mean", "sd"), *L("clade_order"))


@query("SELECT user_id, round(count(*) FILTER (event_type = 'view') / count(DISTINCT event_id % 9), 6) AS view, round(count(*) FILTER (event_type = 'error') / count(DISTINCT event_id % 9), 6) AS error FROM events GROUP BY 1")
def status_share(spark, sf):
    e = read(spark, sf, "events").withColumn("sample", F.col("event_id") % 9)
    return A.status_share(e, "user_id", "event_type", ["view", "error"], "sample").select("user_id", *R("view", "error", digits=6))


@query("SELECT c_mktsegment, concat('{\"target\":\"', c_mktsegment, '\",\"values\":[', string_agg(n::VARCHAR, ',' ORDER BY c_nationkey), ']}') AS record FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL) GROUP BY 1")
def prediction_records(spark, sf):
    df = read(spark, sf, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    return A.prediction_records(df, "c_mktsegment", "c_nationkey", "n")


@query("""WITH g AS (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) AS i FROM g)
SELECT l_suppkey, (i - 1)::BIGINT AS pivot_idx, l_linenumber::BIGINT AS pivot, q AS frequency, l_linenumber <= 4 AS observed FROM r""")
def explode_frequencies(spark, sf):
    sums = read(spark, sf, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum("l_quantity").alias("frequency"))
    long = sums.select("l_suppkey", F.col("l_linenumber").alias("pivot"), "frequency", F.col("l_linenumber").alias("pivot_idx"))
    arrays = A.collect_frequencies(long, "l_suppkey").withColumn("projection", F.lit(4))
    return A.explode_frequencies(arrays, "l_suppkey", "pivots", "frequencies", "projection").select("l_suppkey", *L("pivot_idx", "pivot"), "frequency", "observed")


@query("""SELECT item_id, (SELECT count(*) FROM range(1, 41) t(i) WHERE i % 2 = 1 AND i <= length(text) AND substr(text, i, 1) <> substr(base, i, 1))::BIGINT AS distance FROM (SELECT item_id, text, (SELECT text FROM benchmark WHERE item_id = 0) AS base FROM benchmark)""")
def masked_distance(spark, sf):
    b = read(spark, sf, "benchmark")
    df = b.withColumn("base", b.where("item_id = 0").select("text").scalar())
    return df.select("item_id", Q.masked_distance(F.col("text"), F.col("base"), "10" * 20).cast("long").alias("distance"))


@query("""WITH b AS (SELECT item_id, text AS s, (SELECT text FROM benchmark WHERE item_id = 0) AS base FROM benchmark), m(map, site, f, t, w) AS (VALUES ('one', 2, NULL, NULL, 1.0), ('one', 5, 'a', 'e', 2.0), ('two', 3, NULL, 'e', 0.5), ('two', 7, NULL, NULL, 4.0))
SELECT item_id, map, round(sum(CASE WHEN substr(s, site, 1) <> substr(base, site, 1) AND site <= length(s) AND (f IS NULL OR f = substr(base, site, 1)) AND (t IS NULL OR t = substr(s, site, 1)) THEN w ELSE 0 END), 6) AS distance FROM b, m GROUP BY ALL""")
def distance_to(spark, sf):
    b = read(spark, sf, "benchmark").select("item_id", F.col("text").alias("s"))
    df = b.withColumn("base", b.where("item_id = 0").select("s").scalar())
    maps = values(spark, "map string, site int, `from` string, `to` string, weight double", ("one", 2, None, None, 1.0), ("one", 5, "a", "e", 2.0), ("two", 3, None, "e", 0.5), ("two", 7, None, None, 4.0))
    return Q.distance_to(df, "item_id", "s", "base", maps).select("item_id", "map", *R("distance", digits=6))


@query("""WITH c AS (SELECT i::BIGINT AS site, substr(s, i, 1) AS char, sum(w) AS n FROM (SELECT p_name AS s, p_retailprice AS w FROM part), range(1, (SELECT max(length(p_name)) + 1 FROM part)) t(i) WHERE i <= length(s) GROUP BY ALL) SELECT site, char, round(n / sum(n) OVER (PARTITION BY site), 6) AS frequency FROM c""")
def allele_frequencies(spark, sf):
    return Q.allele_frequencies(read(spark, sf, "part").select(F.col("p_name").alias("s"), "p_retailprice"), "s", "p_retailprice").select(*L("site"), "char", *R("frequency", digits=6))


@query(f"""WITH {_CLOSURE}, t AS (SELECT 1 + s_suppkey AS node, CASE WHEN s_acctbal > 5000 THEN 'high' ELSE 'low' END AS label FROM supplier) SELECT label, min(node) AS node FROM t GROUP BY 1""")
def first_node_per_label(spark, sf):
    e = _tree(spark, sf).withColumn("label", F.when(F.col("s_acctbal") > 5000, "high").otherwise("low"))
    return T.first_node_per_label(e, "label")


@query(f"""WITH {_CLOSURE}, d AS (SELECT s_suppkey + 1 AS node, DATE '2000-01-01' + (s_suppkey % 50)::INTEGER AS date FROM supplier) SELECT c.node, arg_min(ancestor, hops) AS past FROM c JOIN d ON d.node = c.ancestor WHERE hops > 0 AND date < DATE '2000-01-03' GROUP BY 1""")
def past_ancestor(spark, sf):
    e = _tree(spark, sf)
    dates = e.select("node", F.date_add(F.lit("2000-01-01").cast("date"), ((F.col("node") - 1) % 50).cast("int")).alias("date"))
    return T.past_ancestor(e, dates, F.lit("2000-01-03").cast("date"))


@query(f"WITH {_CLOSURE}, s AS (SELECT c.node, sum(abs(s_acctbal)) AS t FROM c JOIN supplier ON s_suppkey + 1 = c.ancestor GROUP BY 1) SELECT node, round(t / max(t) OVER (), 6) AS scaled FROM s")
def cumulative_scaled(spark, sf):
    e = _tree(spark, sf).withColumn("v", F.abs("s_acctbal"))
    return T.cumulative_scaled(e, e, "v").select("node", *R("scaled", digits=6))


@query(f"""WITH {_CLOSURE}, m AS (SELECT s_suppkey + 1 AS node, s_suppkey % 3 AS site, CASE WHEN s_suppkey % 4 < 2 THEN 'A' ELSE 'B' END AS alt FROM supplier),
al AS (SELECT c.node, site, arg_min(alt, hops) AS alt FROM c JOIN m ON m.node = c.ancestor GROUP BY c.node, site), d(clade, site, alt) AS (VALUES ('x', 0, 'A'), ('y', 0, 'A'), ('y', 1, 'B'), ('z', 2, 'B')),
k AS (SELECT node, clade, count(*) AS n FROM al JOIN d USING (site, alt) GROUP BY ALL), q AS (SELECT clade, count(*) AS need FROM d GROUP BY 1)
SELECT e.node, coalesce(w.clade, 'unassigned') AS clade FROM e LEFT JOIN (SELECT node, arg_max(clade, need * 1000 + ascii(clade)) AS clade FROM k JOIN q USING (clade) WHERE n = need GROUP BY node) w USING (node)""")
def assign_clades(spark, sf):
    e = _tree(spark, sf)
    k = F.col("node") - 1
    muts = e.select("node", (k % 3).cast("int").alias("site"), F.when(k % 4 < 2, "A").otherwise("B").alias("alt"))
    defs = values(spark, "clade string, site int, alt string", ("x", 0, "A"), ("y", 0, "A"), ("y", 1, "B"), ("z", 2, "B"))
    return T.assign_clades(e, muts, defs).select("node", "clade")


@query(f"""WITH {_PANEL}, c AS (SELECT t, strain, f FROM s) SELECT 'd' AS name, round(avg(sd), 6) AS value FROM (SELECT t, stddev_samp(d) AS sd FROM f GROUP BY t) UNION ALL SELECT 'x', round(avg(sd), 6) FROM (SELECT t, stddev_samp(x) AS sd FROM f GROUP BY t)""")
def mean_sd(spark, sf):
    one = M.mean_sd(_panel(spark, sf), ["d", "x"], "t")
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.round(c, 6).alias("value")) for c in ("d", "x")])).alias("x")).select("x.*")


@query("""WITH p AS (SELECT DISTINCT l_suppkey % 20 AS sample, l_suppkey % 4 AS k FROM lineitem), d AS (SELECT a.sample, b.sample AS other_sample, abs(a.sample - b.sample) AS distance FROM p a, p b WHERE a.sample <> b.sample),
f AS (SELECT sample, sum(l_quantity) / sum(sum(l_quantity)) OVER () AS f FROM (SELECT l_suppkey % 20 AS sample, l_quantity FROM lineitem) GROUP BY 1)
SELECT d.sample, round(sum(f * distance), 6) AS expected FROM d JOIN f ON f.sample = d.other_sample GROUP BY 1""")
def expected_distance(spark, sf):
    q = read(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("sample")).agg(F.sum("l_quantity").alias("q"))
    f = q.withColumn("t", q.agg(F.sum("q")).scalar()).select("sample", (F.col("q") / F.col("t")).alias("f"))
    d = f.select("sample").join(f.select(F.col("sample").alias("other_sample")), F.col("sample") != F.col("other_sample")).withColumn("distance", F.abs(F.col("sample") - F.col("other_sample")))
    return M.expected_distance(f, f, d, "sample", "f").select("sample", *R("expected", digits=6))


@query(f"""WITH o AS (SELECT o_orderkey AS cur, o_custkey AS c, o_orderdate::DATE AS d, o_totalprice AS p FROM orders), q AS (SELECT a.cur, a.d, b.d AS pd, abs(a.p - b.p) / 100000 AS dist FROM o a JOIN o b ON a.c = b.c AND b.d < a.d AND b.d >= a.d - INTERVAL 12 MONTH)
SELECT cur, round(-sum(greatest(1 - (year(d) + (dayofyear(d) - 1) / 365.25 - (year(pd) + (dayofyear(pd) - 1) / 365.25)) / 2.0, 0) * 0.5 * exp(-dist / 3.0)), 5) AS cross_immunity FROM q GROUP BY cur""")
def cross_immunity(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("cur"), F.col("o_custkey").alias("c"), day("o_orderdate").alias("d"), F.col("o_totalprice").alias("p"))
    pairs = J.join_past(o, o, "d", 1, ["c"]).select("cur", S.to_decimal_year(F.col("d")).alias("t"), S.to_decimal_year(F.col("past_d")).alias("tp"), (F.abs(F.col("p") - F.col("past_p")) / 100000).alias("dist"), F.lit(0.5).alias("mf"))
    return M.cross_immunity(pairs, "cur", "dist", "t", "tp", "mf", 3.0, 2.0).select("cur", *R("cross_immunity", digits=5))


@query(f"""WITH {_PANEL}, j AS (SELECT t, strain, f, d, f * exp(0.4 * d) AS e FROM s), r AS (SELECT t, round(avg(f), 8) AS f FROM s GROUP BY t) SELECT 'error' AS name, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd FROM (SELECT t, avg(f) * 10 AS v FROM s GROUP BY t) UNION ALL SELECT 'beta', round(avg(v), 6), round(stddev_pop(v), 6) FROM (SELECT t, sum(f * d) AS v FROM f GROUP BY t)""")
def summarise_scores(spark, sf):
    p = _panel(spark, sf).groupBy("t").agg((F.avg("f") * 10).alias("error"), F.sum(F.col("f") * F.col("d")).alias("beta"))
    return M.summarise_scores(p, "error", ["beta"]).select("name", *R("mean", "sd", digits=6))


@query(f"{_SCORED}, k AS (SELECT t, sum(e * (clade + 1)) AS e, sum(o * (clade + 1)) AS o, sum(i * (clade + 1)) AS i FROM o GROUP BY t) SELECT round(avg((e - o) / i), 6) AS score FROM k")
def distance_score(spark, sf):
    s = _scored(spark, sf).withColumn("dist", F.col("clade") + 1)
    return M.distance_score(s, "t", "dist", "e", "observed", "i").select(*R("score", digits=6))


@query(f"""{_DIFF.replace("SELECT coalesce", "WITH x AS (SELECT coalesce", 1)}) SELECT o_orderkey, field, CASE WHEN change LIKE '%record' THEN 'whole record' WHEN lower(was) = lower(now) THEN 'case' WHEN now IS NULL THEN 'emptied' ELSE 'unexplained' END AS reason FROM x""")
def explain_differences(spark, sf):
    d = U.diff_records(*_versions(spark, sf), "o_orderkey")
    return U.explain(d, [("whole record", F.col("change").endswith("record")), ("case", F.lower("was") == F.lower("now")), ("emptied", F.col("now").isNull())]).select("o_orderkey", "field", "reason")



def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Registers more queries; at the end, since it uses what this module defines.
from lineagrid.plans import flows, records, studies  # noqa: E402, F401
