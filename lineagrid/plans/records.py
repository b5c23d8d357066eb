"""More registered queries: cleaning of record fields, links, reshaping, and the compositions of trees and forecasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lineagrid.functions import scalars as S
from lineagrid.operators import aggregates as A
from lineagrid.operators import curate as C
from lineagrid.operators import forecast as M
from lineagrid.operators import frequencies as K
from lineagrid.operators import link as J
from lineagrid.operators import sequences as Q
from lineagrid.operators import trees as T
from lineagrid.operators import windows as W
from lineagrid.plans.catalog import _CLOSURE, _PANEL, L, R, _panel, _tree, day, query, read, values
from lineagrid.sources import files as IO

# -- fields of records --------------------------------------------------------------------------------------------


@query(r"""SELECT c_custkey, lower(c_name) AS c_name, trim(regexp_replace(concat('  ', c_mktsegment, '   x '), '\s+', ' ', 'g')) AS normal, CASE WHEN c_custkey % 5 = 0 THEN '?' ELSE lower(c_mktsegment) END AS gender,
split_part(concat(c_mktsegment, '_', c_name), '_', 1) AS centre, regexp_replace(c_name, '[^A-Za-z0-9_.\-/]', '', 'g') AS valid,
regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, replace(regexp_replace(c_name, '[^0-9]', '', 'g'), '0', '') AS no_zeros, regexp_matches(concat('AB', c_custkey), '^[A-Z]{2}[0-9]+(\.[0-9]+)?$') AS accession
FROM customer""")
def clean_fields(spark, sf):
    """Case, white space, closed domains, centres, characters and comparison keys of fields."""
    df = C.lowercase_fields(read(spark, sf, "customer").withColumn("name", F.col("c_name")), ["c_name"])
    keys = S.compare_keys(F.col("name"))
    return df.select(
        "c_custkey", "c_name", S.normalise_string(F.concat(F.lit("  "), "c_mktsegment", F.lit("   x "))).alias("normal"),
        S.standardise_gender(F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment"))).alias("gender"),
        S.source_centre(F.concat_ws("_", "c_mktsegment", "name")).alias("centre"), S.strip_invalid(F.col("name")).alias("valid"),
        keys["digits"].alias("digits"), keys["no_zeros"].alias("no_zeros"), S.is_accession(F.concat(F.lit("AB"), F.col("c_custkey").cast("string"))).alias("accession"),
    )


_TITLE = "list_transform(w, lambda x, i: CASE WHEN x = 'small' THEN upper(x) WHEN x IN ('widget', 'ring') AND i > 1 THEN x ELSE concat(upper(x[1]), x[2:]) END)"


@query(f"""SELECT p_partkey, array_to_string({_TITLE}, ' ') AS title,
CASE WHEN p_partkey % 7 = 0 THEN '?' WHEN len(w) > 1 THEN concat(w[1], ' et al.') ELSE w[1] END AS authors FROM (SELECT *, string_split(p_name, ' ') AS w FROM part)""")
def titles_and_authors(spark, sf):
    p = read(spark, sf, "part")
    authors = F.when(F.col("p_partkey") % 7 == 0, " ").otherwise(F.replace("p_name", F.lit(" "), F.lit("; ")))
    return p.select("p_partkey", S.titlecase(F.col("p_name"), ["widget", "ring"], ["small"]).alias("title"), S.abbreviate_authors(authors).alias("authors"))


_RAW_DATE = "CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'soon' END"


def _raw_dates(spark, sf):
    d, k = day("o_orderdate"), F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format(d, "dd/MM/yyyy")).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.date_format(d, "yyyy")).when(k == 3, F.date_format(d, "yyyy-MM-dd")).otherwise("soon")
    return read(spark, sf, "orders").withColumn("raw", raw)


@query("""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-XX') WHEN 2 THEN strftime(o_orderdate, '%Y-XX-XX') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders)
SELECT o_orderkey, iso, replace(iso, 'XX', '01') AS whole FROM d""")
def format_dates(spark, sf):
    iso = S.format_date(F.col("raw"), [(r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd")])
    return _raw_dates(spark, sf).select("o_orderkey", iso.alias("iso")).withColumn("whole", S.first_of_month(F.col("iso")))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders WHERE o_orderkey % 5 IN (0, 3) AND strftime(o_orderdate, '%Y-%m-%d') <> '1996-01-01'")
def drop_bad_dates(spark, sf):
    iso = S.format_date(F.col("raw"), [(r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd")])
    return C.drop_bad_dates(_raw_dates(spark, sf).select("o_orderkey", iso.alias("iso")), "iso", ["1996-01-01"])


@query("""SELECT o_orderkey, CASE WHEN y > 1997 THEN 'unknown' WHEN y <= 1995 THEN '<=1995' ELSE y::VARCHAR END AS year, round(greatest(1 - (y - 1990) / 6.0, 0), 6) AS waning, round(exp(-(o_orderkey % 9) / 2.0), 6) AS immunity, round(ln(greatest(o_orderkey % 4, 1e-6)), 6) AS log_floor
FROM (SELECT *, year(o_orderdate) AS y FROM orders)""")
def years_and_weights(spark, sf):
    """The year of a name (from its last part where the record has none) and the weights that fall with time and distance."""
    year = F.year("o_orderdate")
    meta = F.when(F.col("o_orderkey") % 2 == 0, year.cast("string"))
    name = F.concat(F.lit("A/x/"), F.col("o_orderkey").cast("string"), F.lit("/"), year.cast("string"), F.lit("-egg"))
    return read(spark, sf, "orders").select(
        "o_orderkey", S.strain_year(name, meta, 1997, floor=1995).alias("year"), F.round(S.waning(year, F.lit(1990), 6.0), 6).alias("waning"),
        F.round(S.cross_immunity_weight(F.col("o_orderkey") % 9, 2.0), 6).alias("immunity"), F.round(S.log_floor((F.col("o_orderkey") % 4).cast("double")), 6).alias("log_floor"),
    )


@query("""SELECT c_custkey, array_to_string(CASE WHEN c_custkey % 3 = 0 THEN [r_name, n_name] WHEN c_custkey % 3 = 1 THEN [r_name, c_mktsegment, n_name] ELSE [r_name, 'a', 'b', 'c'] END, '/') AS place,
CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE r_name END AS division, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 4 = 0 THEN 'x, y' WHEN c_custkey % 4 = 2 THEN 'z' ELSE '' END AS location
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def places(spark, sf):
    """Places of names appended to short locations, and divisions split at their first comma."""
    c = read(spark, sf, "customer").join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("c_custkey")
    parts = F.when(k % 3 == 0, F.array("r_name")).when(k % 3 == 1, F.array("r_name", "c_mktsegment")).otherwise(F.array("r_name", F.lit("a"), F.lit("b"), F.lit("c")))
    name = F.concat_ws("/", F.lit("A"), "n_name", k.cast("string"), F.lit("2009"))
    cut = S.split_division(F.when(k % 2 == 0, F.concat("n_name", F.lit(", x, y"))).otherwise(F.col("r_name")), F.when(k % 4 == 2, "z").otherwise(""))
    return c.select("c_custkey", F.array_join(S.append_strain_location(parts, name), "/").alias("place"), cut["division"].alias("division"), cut["location"].alias("location"))


_NOTES = ["H1N1pdm09", "type: Victoria", "lineage: yamagata", "none", "Influenza A(H1N1) pandemic 09"]


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 4) THEN 'pdm09' WHEN o_orderkey % 5 = 1 THEN 'victoria' WHEN o_orderkey % 5 = 2 THEN 'yamagata' ELSE '' END AS lineage, replace(replace(concat(o_orderpriority, 'Ã¼ Ã©'), 'Ã¼', 'ü'), 'Ã©', 'é') AS repaired, concat(o_orderpriority, ' 中 Ã¼') AS kept FROM orders -- {len(_NOTES)} notes")
def notes(spark, sf):
    """Lineages that notes name, and text whose encoding was read wrongly."""
    note = F.get(F.array(*[F.lit(n) for n in _NOTES]), (F.col("o_orderkey") % 5).cast("int"))
    return read(spark, sf, "orders").select("o_orderkey", S.lineage_from_note(F.concat(note, F.when(note == "H1N1pdm09", "").otherwise(" "))).alias("lineage"), S.repair_utf8(F.concat("o_orderpriority", F.lit("Ã¼ Ã©"))).alias("repaired"), S.repair_utf8(F.concat("o_orderpriority", F.lit(" 中 Ã¼"))).alias("kept"))


# -- names --------------------------------------------------------------------------------------------------------

_PLACE = ["TEXAS", "new york", "Hong Kong", "NJ", "Lyon"]
_NAMES = f"SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS seasonal, [{', '.join(repr(p) for p in _PLACE)}][o_orderkey % 5 + 1] AS place, lpad((o_orderkey % 97)::VARCHAR, 4, '0') AS num, right(year(o_orderdate)::VARCHAR, 2) AS yy FROM orders"


def _names(spark, sf):
    k = F.col("o_orderkey")
    place = F.get(F.array(*[F.lit(p) for p in _PLACE]), (k % 5).cast("int"))
    return read(spark, sf, "orders").select(k.alias("k"), (k % 3 == 0).alias("seasonal"), place.alias("place"), F.lpad((k % 97).cast("string"), 4, "0").alias("num"), F.substring(F.year("o_orderdate").cast("string"), 3, 2).alias("yy"))


_TITLED = "CASE WHEN place = upper(place) OR place = lower(place) THEN array_to_string(list_transform(string_split(lower(place), ' '), lambda x: concat(upper(x[1]), x[2:])), ' ') ELSE place END"


@query(f"""WITH n AS ({_NAMES}) SELECT k, concat('A/', place, '/', num, '/', CASE WHEN yy::INT < 96 THEN '20' ELSE '19' END, yy) AS expanded,
concat('A/', {_TITLED}, '/', ltrim(num, '0'), '/', ltrim(yy, '0')) AS tidy,
concat('A/', CASE WHEN place = 'Hong Kong' THEN 'HK' WHEN place = 'new york' THEN 'NY' ELSE place END, '/', num) AS parts,
concat(CASE WHEN k % 2 = 0 THEN 'B' ELSE 'A' END, '/', place, '/', num, CASE WHEN seasonal AND k % 4 = 0 THEN '-egg' ELSE '' END) AS finished FROM n""")
def name_steps(spark, sf):
    """The steps of name repair one by one: century, four-part names, spelling of parts, passage suffix and type."""
    n, fixes = _names(spark, sf), F.create_map(F.lit("hongkong"), F.lit("HK"), F.lit("newyork"), F.lit("NY"))
    name = F.concat_ws("/", F.lit("A"), "place", "num")
    return n.select(
        "k", S.expand_year(F.concat_ws("/", name, "yy"), 96).alias("expanded"), S.tidy_four_part(F.concat_ws("/", name, "yy")).alias("tidy"), S.fix_name_parts(name, fixes).alias("parts"),
        S.finalise_strain(name, F.when(F.col("k") % 4 == 0, "egg").otherwise("cell"), F.when(F.col("k") % 2 == 0, "b").otherwise("a"), F.col("seasonal")).alias("finished"),
    )


def _literals(x: str) -> str:
    return reduce(lambda s, p: f"replace({s}, '{p[0].replace(chr(39), chr(39) * 2)}', '{p[1]}')", S.NAME_LITERALS, x)


def _rewritten(x: str) -> str:
    rule = lambda s, p: f"regexp_replace({s}, '{p[0]}', '{p[1].replace('$', chr(92))}')"
    return reduce(rule, S.SEASONAL_REWRITES, x)


@query(f"""WITH n AS ({_NAMES}), raw AS (SELECT *, concat('A/', place, CASE k % 4 WHEN 0 THEN '/CHU' WHEN 1 THEN '/DE-DHSS' WHEN 2 THEN '-like' ELSE '' END, '/', num, '/20', yy, ' (H3N2)') AS name FROM n)
SELECT k, {_literals('name')} AS plain, CASE WHEN seasonal THEN {_rewritten(_literals('name'))} ELSE {_literals('name')} END AS rewritten FROM raw""")
def name_rewrites(spark, sf):
    """Texts removed from names and the ordered rewrites of seasonal ones."""
    k = F.col("k")
    mark = F.when(k % 4 == 0, "/CHU").when(k % 4 == 1, "/DE-DHSS").when(k % 4 == 2, "-like").otherwise("")
    plain = S.replace_substrings(F.concat(F.lit("A/"), "place", mark, F.lit("/"), "num", F.lit("/20"), "yy", F.lit(" (H3N2)")), S.NAME_LITERALS)
    return _names(spark, sf).select("k", plain.alias("plain"), S.apply_rewrites(plain, S.SEASONAL_REWRITES, F.col("seasonal")).alias("rewritten"))


@query(f"""WITH n AS ({_NAMES}) SELECT k, concat('A/', CASE WHEN place = 'Hong Kong' THEN 'HongKong' WHEN place = 'new york' THEN 'Newyork' WHEN place = 'NJ' THEN 'Nj' WHEN place = 'TEXAS' THEN 'Texas' ELSE 'Lyon' END, '/', CASE WHEN k % 97 = 0 THEN '' ELSE ltrim(num, '0') END, '/', CASE WHEN yy::INT >= 90 THEN '19' ELSE '20' END, yy) AS name FROM n""")
def fix_names(spark, sf):
    """Whole repair of four-part names with accents, subtypes, spaces, leading zeros and places in one case."""
    raw = F.concat(F.lit("A/"), "place", F.lit("/"), "num", F.lit("/"), F.when(F.col("yy").cast("int") >= 90, "19").otherwise("20"), "yy", F.lit("(H3N2)"))
    return _names(spark, sf).select("k", S.fix_name(raw, F.lit(False)).alias("name"))


# -- projections and filters --------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_acctbal > 0 AS ha, c_mktsegment AS accession_ha FROM customer")
def subset_columns(spark, sf):
    df = C.drop_fields(read(spark, sf, "customer").withColumn("ha", F.col("c_acctbal") > 0).withColumn("accession", F.col("c_mktsegment")), ["c_nationkey", "none"])
    return C.subset(C.suffix_columns(df, ["accession"], "ha"), ["c_custkey", "c_name"], ["ha"])


@query("""SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'O')""")
def filter_by_expression(spark, sf):
    return C.query(read(spark, sf, "orders"), "o_totalprice > 100000 AND o_orderstatus IN ('F', 'O')").select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') OR c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')")
def select_listed(spark, sf):
    lists = [read(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("item")), read(spark, sf, "events").where("event_type = 'error'").select(F.col("user_id").alias("item"))]
    return C.select_strains(read(spark, sf, "customer"), "c_custkey", lists).select("c_custkey", "c_name")


@query("SELECT 'ferret' AS host, count(*)::BIGINT AS n FROM part WHERE NOT contains(lower(p_name), 'mouse') AND NOT contains(lower(p_name), 'human') UNION ALL SELECT 'ring', count(*)::BIGINT FROM part WHERE contains(lower(p_name), 'ring')")
def by_host(spark, sf):
    p = read(spark, sf, "part")
    one = lambda host: C.select_by_host(p, "p_name", host).agg(F.count("*").alias("n")).select(F.lit(host).alias("host"), "n")
    return one("ferret").union(one("ring"))


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'nuc' ELSE 'HA1' END AS gene, CASE WHEN l_returnflag = 'N' THEN l_partkey + 16 ELSE l_partkey END AS site FROM lineitem")
def offset_sites(spark, sf):
    df = read(spark, sf, "lineitem").select("l_orderkey", *L("l_linenumber"), F.when(F.col("l_returnflag") == "N", "nuc").otherwise("HA1").alias("gene"), F.col("l_partkey").alias("site"))
    return C.offset_sites(df, 16)


@query("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'domain' END, CASE WHEN o_totalprice IS NULL OR o_totalprice < 50000 THEN 'price' END], lambda x: x IS NOT NULL), ',') AS broken
FROM orders WHERE o_orderstatus NOT IN ('F', 'O') OR o_totalprice < 50000""")
def quarantine(spark, sf):
    rules = {"domain": F.col("o_orderstatus").isin("F", "O"), "price": F.col("o_totalprice") >= 50000}
    return C.check(read(spark, sf, "orders"), rules, "quarantine")[1].select("o_orderkey", F.array_join("broken", ",").alias("broken"))


# -- links --------------------------------------------------------------------------------------------------------

_LINKED = """i AS (SELECT o_orderkey AS k, list_sort(list({'n': length(p_name), 'a': p_partkey, 's': p_name}))[-1] AS best, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1)"""


def _linked(spark, sf):
    items = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.concat(F.lit("EPI"), F.col("l_partkey").cast("string"))), ",").alias("ha_ids"))
    meta = read(spark, sf, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("na_ids", F.lit(None).cast("string"))
    seqs = read(spark, sf, "part").select(F.concat(F.lit("EPI"), F.col("p_partkey").cast("string")).alias("accession"), F.col("p_name").alias("sequence"))
    return J.link_sequences(meta.select("o_orderkey", "ha_ids", "na_ids"), seqs, {"ha": "ha_ids", "na": "na_ids"}, "o_orderkey")


@query(f"WITH {_LINKED} SELECT k AS o_orderkey, 'True' AS ha, concat('EPI', best.a) AS accession_ha, 'False' AS na, 'N/A' AS accession_na, 1::BIGINT AS n_segments FROM i")
def split_segments(spark, sf):
    """Segments linked by comma-separated ids, one sequence chosen for each, flags and accessions in columns."""
    return W.split_segments(_linked(spark, sf), ["ha", "na"]).select("o_orderkey", "ha", "accession_ha", "na", "accession_na", *L("n_segments"))


@query(f"WITH {_LINKED} SELECT count(*)::BIGINT AS records, count(*) FILTER (n IS NULL)::BIGINT AS without_ha, count(*)::BIGINT AS without_na, count(*) FILTER (n IS NULL)::BIGINT AS without_any FROM orders LEFT JOIN i ON k = o_orderkey")
def link_report(spark, sf):
    return J.link_report(_linked(spark, sf), ["ha", "na"])


@query("SELECT o_custkey, max(c_name) AS c_name, max(c_mktsegment) AS c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def merge_header_fields(spark, sf):
    h = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return J.merge_header_fields(h, "o_custkey", ["c_name", "c_mktsegment"])


@query("SELECT o_orderkey, s::BIGINT AS segment, l_shipdate::DATE AS sequence FROM orders, range(1, 8) r(s) LEFT JOIN (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey AND l_linenumber = s")
def link_by_composite(spark, sf):
    seqs = read(spark, sf, "lineitem").groupBy(F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id")).agg(F.max(day("l_shipdate")).alias("sequence"))
    return J.link_by_composite(read(spark, sf, "orders").select("o_orderkey"), seqs, "o_orderkey", list(range(1, 8))).select("o_orderkey", *L("segment"), "sequence")


@query("SELECT coalesce(b.id, a.id) AS id, coalesce(b.name, a.name) AS name FROM (SELECT c_custkey AS id, c_name AS name FROM customer) a FULL JOIN (SELECT s_suppkey * 2 AS id, s_name AS name FROM supplier) b ON a.id = b.id")
def merge_sequences(spark, sf):
    a = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return J.merge_sequences([a, read(spark, sf, "supplier").select((F.col("s_suppkey") * 2).alias("id"), F.col("s_name").alias("name"))])


@query("SELECT k, n_name, c FROM (SELECT n_nationkey AS k, n_name FROM nation) LEFT JOIN (SELECT c_nationkey AS k, count(*)::BIGINT AS c FROM customer GROUP BY 1) USING (k)")
def join_tables(spark, sf):
    counts = A.count_by(read(spark, sf, "customer").withColumnRenamed("c_nationkey", "k"), "k", name="c")
    return J.join_tables(read(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), "n_name"), counts, "left", ["k"])


@query("SELECT count(*)::BIGINT AS n, sum(o_totalprice) AS total FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) AND o_custkey IN (SELECT user_id FROM events)")
def keep_common(spark, sf):
    o, c, e = (read(spark, sf, t).withColumnRenamed(k, "k") for t, k in (("orders", "o_custkey"), ("customer", "c_custkey"), ("events", "user_id")))
    return J.keep_common([o, c, e], "k")[0].agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


@query("SELECT s_nationkey, round(s, 2) AS s, round(c, 2) AS c FROM (SELECT s_nationkey, avg(s_acctbal) AS s FROM supplier GROUP BY 1) JOIN (SELECT c_nationkey AS s_nationkey, avg(c_acctbal) AS c FROM customer GROUP BY 1) USING (s_nationkey)")
def join_rounded(spark, sf):
    s = read(spark, sf, "supplier").groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("s"))
    return J.join_rounded(s, read(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.avg("c_acctbal").alias("c")), ["s_nationkey"], 2)


# -- sums, sets and shapes ----------------------------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ALL")
def sum_by(spark, sf):
    return A.sum_by(read(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "quantity").withColumn("quantity", F.round("quantity", 2))


@query("SELECT c_custkey AS item FROM customer UNION SELECT o_custkey FROM orders UNION SELECT user_id FROM events")
def union_items(spark, sf):
    return A.union_items([read(spark, sf, t).select(F.col(k).alias("item")) for t, k in (("customer", "c_custkey"), ("orders", "o_custkey"), ("events", "user_id"))])


@query("""SELECT year, n, row_number() OVER (ORDER BY CASE WHEN year = 'unknown' THEN 0 WHEN year LIKE '<=%' THEN 1 ELSE year::INT END DESC, n DESC, year)::BIGINT AS place
FROM (SELECT CASE WHEN year(o_orderdate) >= 1998 THEN 'unknown' WHEN year(o_orderdate) <= 1993 THEN '<=1993' ELSE year(o_orderdate)::VARCHAR END AS year, count(*)::BIGINT AS n FROM orders GROUP BY 1)""")
def order_missing(spark, sf):
    y = F.year("o_orderdate")
    counts = A.count_by(read(spark, sf, "orders").withColumn("year", F.when(y >= 1998, "unknown").when(y <= 1993, "<=1993").otherwise(y.cast("string"))), "year")
    listed = W.order_missing(counts, "year", F.col("n"), "year").coalesce(1).agg(F.collect_list(F.struct("year", "n")).alias("x"))
    return listed.select(F.posexplode("x").alias("place", "x")).select("x.year", "x.n", (F.col("place") + 1).cast("long").alias("place"))


_TIPS = f"WITH {_CLOSURE}, tips AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL))"


@query(f"{_TIPS} SELECT node, round(s_acctbal, 2) AS s_acctbal, s_name FROM tips JOIN supplier ON s_suppkey + 1 = node")
def node_table(spark, sf):
    e, s = _tree(spark, sf), read(spark, sf, "supplier")
    return A.node_table(e.select("node", F.round("s_acctbal", 2).alias("s_acctbal")), s.select((F.col("s_suppkey") + 1).alias("strain"), "s_name"), e)


@query("""SELECT coalesce(a.k, b.k) AS node, coalesce(b.name, a.name) AS name, a.bal, b.nation FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer) a
FULL JOIN (SELECT s_suppkey + 3 AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name, s_nationkey::BIGINT AS nation FROM supplier) b ON a.k = b.k""")
def merge_node_data(spark, sf):
    a = read(spark, sf, "customer").select(F.col("c_custkey").alias("node"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    b = read(spark, sf, "supplier").select((F.col("s_suppkey") + 3).alias("node"), F.expr("CASE WHEN s_suppkey % 2 = 0 THEN s_name END").alias("name"), F.col("s_nationkey").cast("long").alias("nation"))
    return A.merge_node_data([a, b])


@query("SELECT l_orderkey, arg_max(l_quantity, (l_linenumber, l_partkey, l_quantity)) AS last FROM lineitem GROUP BY 1")
def last_value(spark, sf):
    lists = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("x"))
    return A.last_value(lists.select("l_orderkey", F.col("x.l_quantity").alias("v")), "v", "last")


@query("SELECT concat('eu_', n_name) AS k, n_nationkey FROM nation WHERE n_regionkey = 3 UNION ALL SELECT concat('as_', n_name), n_nationkey FROM nation WHERE n_regionkey = 2")
def prefix_by_region(spark, sf):
    n = read(spark, sf, "nation")
    part = lambda r: n.where(F.col("n_regionkey") == r).select(F.col("n_name").alias("k"), "n_nationkey")
    return A.prefix_by_region({"eu": part(3), "as": part(2)}, "k")


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate::DATE AS d FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def keep_sera(spark, sf):
    return A.keep_sera(read(spark, sf, "lineitem"), "l_returnflag", ["A", "R"]).select("l_orderkey", *L("l_linenumber"), day("l_shipdate").alias("d"))


@query("SELECT s_nationkey::BIGINT AS clade, min(s_suppkey) AS node, arg_min(s_name, s_suppkey) AS seq FROM supplier GROUP BY 1")
def founder_sequences(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), *L("s_nationkey"), F.col("s_suppkey").alias("preorder"), F.col("s_name").alias("seq"))
    first = T.first_node_per_label(s.withColumnRenamed("s_nationkey", "clade"), "clade")
    return A.founder_sequences(first, s.select("node", "seq")).select("clade", "node", "seq")


# -- sequences ----------------------------------------------------------------------------------------------------

_MUTATIONS = "concat('HA1:A', p_size, 'T,', CASE WHEN p_partkey % 2 = 0 THEN 'bad,' ELSE '' END, 'G', p_partkey, '-')"


@query("""SELECT p_partkey, 'HA1' AS gene, 'A' AS ref, p_size::BIGINT AS site, 'T' AS alt FROM part UNION ALL SELECT p_partkey, '', 'G', p_partkey, '-' FROM part""")
def parse_mutations(spark, sf):
    k = F.col("p_partkey")
    text = F.concat(F.lit("HA1:A"), F.col("p_size").cast("string"), F.lit("T,"), F.when(k % 2 == 0, "bad,").otherwise(""), F.lit("G"), k.cast("string"), F.lit("-"))
    return read(spark, sf, "part").select("p_partkey", F.explode(S.parse_mutations(text)).alias("m")).select("p_partkey", "m.gene", "m.ref", F.col("m.site").cast("long").alias("site"), "m.alt")


@query("""SELECT p_partkey, round(p_size / 50.0, 4) AS ha1, 0.0 AS ha2, regexp_replace(upper(p_name), '[^ACGTN-]', 'N', 'g') AS masked FROM part""")
def coverage_and_masks(spark, sf):
    text = F.concat(F.lit("SigPep:1,HA1:"), F.round(F.col("p_size") / 50.0, 4).cast("string"))
    return read(spark, sf, "part").select("p_partkey", S.gene_coverage(text, "HA1").alias("ha1"), S.gene_coverage(text, "HA2").alias("ha2"), S.mask_invalid(F.col("p_name")).alias("masked"))


@query("SELECT o_orderkey, max(CASE WHEN l_returnflag = 'A' THEN x END) AS A, max(CASE WHEN l_returnflag = 'N' THEN x END) AS N FROM orders LEFT JOIN (SELECT l_orderkey, l_returnflag, max(l_partkey) AS x FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey GROUP BY 1")
def attach_sequences(spark, sf):
    seqs = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").agg(F.max("l_partkey").alias("x"))
    return Q.attach_sequences(read(spark, sf, "orders").select("o_orderkey"), seqs, "o_orderkey", "l_returnflag", "x", ["A", "N"])


@query("""WITH d AS (SELECT s_suppkey, i::BIGINT AS site, substr(s_name, i, 1) AS new, substr(concat(left(s_name, 12), '7', substr(s_name, 14)), i, 1) AS old FROM supplier, range(1, 19) r(i))
SELECT s_suppkey, round(sum(CASE WHEN new = old THEN 0 ELSE log2((CASE WHEN new IN ('0', '1') THEN 0.3 ELSE 1e-10 END) / 0.1) END), 6) AS score FROM d GROUP BY 1""")
def preference_score(spark, sf):
    parent = F.concat(F.substring("s_name", 1, 12), F.lit("7"), F.substring("s_name", 14, 100))
    prefs = values(spark, "site int, aa string, preference double", (13, "0", 0.3), (13, "1", 0.3), (13, "7", 0.1))
    return Q.preference_score(read(spark, sf, "supplier").withColumn("p", parent), "s_suppkey", "p", "s_name", prefs).select("s_suppkey", *R("score", digits=6))


@query("""WITH tips AS (SELECT n_regionkey AS region, s_suppkey % 2 AS hap, s_name AS seq FROM supplier JOIN nation ON n_nationkey = s_nationkey), refs AS (SELECT n_nationkey AS ref, concat('Supplier#', lpad((n_nationkey * 37)::VARCHAR, 9, '0')) AS seq FROM nation),
m AS (SELECT ref, region, hap, avg(list_sum(list_transform(range(1, 19), lambda i: CASE WHEN substr(r.seq, i, 1) = substr(t.seq, i, 1) THEN 0 WHEN i = 18 THEN 2.0 WHEN i = 17 THEN 0.5 ELSE 0.0 END))) AS d FROM refs r, tips t GROUP BY ALL)
SELECT ref::BIGINT AS ref, round(sum(d * (1 + hap) / 3.0) / (SELECT count(DISTINCT region) FROM tips), 6) AS distance_to_future FROM m GROUP BY ref""")
def distance_to_future(spark, sf):
    """Every reference against the sequences of every region, weighted by predicted frequencies."""
    n = read(spark, sf, "nation")
    tips = read(spark, sf, "supplier").join(n, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("n_regionkey").alias("region"), (F.col("s_suppkey") % 2).alias("haplotype"), F.col("s_name").alias("seq"))
    refs = n.select(F.col("n_nationkey").alias("ref"), F.concat(F.lit("Supplier#"), F.lpad((F.col("n_nationkey") * 37).cast("string"), 9, "0")).alias("seq"))
    forecasts = tips.select("region", "haplotype").distinct().withColumn("frequency", (1 + F.col("haplotype")) / 3.0)
    weights = values(spark, "site int, `from` string, `to` string, weight double", (18, None, None, 2.0), (17, None, None, 0.5))
    return Q.distance_to_future(refs, tips, forecasts, weights).select(*L("ref"), *R("distance_to_future", digits=6))


# -- trees --------------------------------------------------------------------------------------------------------


@query(f"""WITH {_CLOSURE}, v AS (SELECT c.node, g, k, sum(abs(s_acctbal) * (k + 1) * (k + 1) + g) AS s FROM c JOIN supplier ON s_suppkey + 1 = c.ancestor, range(0, 2) a(g), range(0, 10) b(k) GROUP BY ALL),
l AS (SELECT node, g, avg(s) AS mean, list_sort(list(s)) AS s FROM v GROUP BY ALL) SELECT node, g::BIGINT AS g, round(mean, 4) AS mean, round(s[1], 4) AS low, round(s[8], 4) AS high FROM l""")
def posterior_path(spark, sf):
    """Root-to-node sums of ten posterior samples in two groups, with the narrowest interval that holds eight."""
    e = _tree(spark, sf)
    some = e.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("v", F.abs("s_acctbal") * (F.col("k") + 1) * (F.col("k") + 1) + F.col("g"))
    return T.posterior_path(e, some, "v", "g", "k", 0.8).select("node", *L("g"), *R("mean", "low", "high"))


@query(f"""WITH {_CLOSURE} SELECT c.node, round(sum(CASE WHEN s_suppkey % 4 = 0 THEN abs(s_acctbal) ELSE 0 END), 2) AS total, count(*) FILTER (s_suppkey % 4 = 0)::BIGINT AS n_scored, count(*) FILTER (s_suppkey % 4 = 1)::BIGINT AS n_missing, count(*) FILTER (s_suppkey % 4 = 2)::BIGINT AS n_outside, count(*) FILTER (s_suppkey % 4 = 3)::BIGINT AS n_after
FROM c JOIN supplier ON s_suppkey + 1 = c.ancestor GROUP BY 1""")
def windowed_path_sum(spark, sf):
    e = _tree(spark, sf)
    k = (F.col("node") - 1) % 4
    scored = e.select("node", F.when(k == 0, F.abs("s_acctbal")).alias("v"), F.get(F.array(*[F.lit(x) for x in ("scored", "missing", "outside", "after")]), k.cast("int")).alias("s"))
    return T.windowed_path_sum(e, scored, "v", "s").withColumn("total", F.round("total", 2))


@query(f"WITH {_CLOSURE} SELECT node FROM c WHERE ancestor = (SELECT min(node) FROM e WHERE node % 3 = 0)")
def subtree(spark, sf):
    e = _tree(spark, sf)
    return T.subtree(e, T.closure(e), F.col("node") % 3 == 0).select("node")


@query("""WITH n AS (SELECT s_suppkey AS node, s_nationkey AS clade, s_name AS seq FROM supplier), f AS (SELECT clade, arg_min(seq, node) AS f FROM n GROUP BY 1),
d AS (SELECT node, clade, string_agg(concat(substr(f, i, 1), i, substr(seq, i, 1)), '-' ORDER BY i) AS m FROM n JOIN f USING (clade), range(1, 19) r(i) WHERE substr(f, i, 1) <> substr(seq, i, 1) GROUP BY ALL)
SELECT n.node, CASE WHEN m IS NULL THEN n.clade::VARCHAR ELSE concat(n.clade, ':', m) END AS haplotype FROM n LEFT JOIN d USING (node)""")
def founder_haplotype(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_suppkey").alias("preorder"), F.col("s_nationkey").cast("string").alias("clade"), F.col("s_name").alias("seq"))
    return T.founder_haplotype(s.select("node", "preorder", "clade"), s.select("node", "seq"))


# -- frequencies and forecasts ------------------------------------------------------------------------------------


@query("""WITH g AS (SELECT x::DATE AS p FROM generate_series(DATE '2024-01-01', DATE '2024-06-01', INTERVAL 1 MONTH) t(x)) SELECT p AS "pivot", row_number() OVER (ORDER BY p)::BIGINT - 1 AS pivot_idx, (SELECT count(*) FROM events WHERE ts::DATE <= p)::BIGINT AS known FROM g""")
def pivots(spark, sf):
    """Monthly pivots, with the events known by each."""
    p = K.pivots(spark, "2024-01-01", "2024-06-01", 1, "month")
    days = A.count_by(read(spark, sf, "events").withColumn("d", day("ts")), "d")
    known = p.join(days, F.col("d") <= F.col("pivot")).groupBy("pivot").agg(F.sum("n").alias("known"))
    return p.join(known, "pivot", "left").select("pivot", *L("pivot_idx"), F.coalesce("known", F.lit(0)).cast("long").alias("known"))


_MONTHS = "m AS (SELECT clade, (date_diff('month', DATE '1992-01-01', t))::DOUBLE AS x, sum(f) AS f FROM s GROUP BY ALL)"


def _months(spark, sf):
    return _panel(spark, sf).withColumn("x", F.months_between("t", F.lit("1992-01-01").cast("date")))


@query(f"WITH {_PANEL}, {_MONTHS}, r AS (SELECT clade, x, (f - lag(f, 2) OVER w) / (x - lag(x, 2) OVER w) AS d FROM m WINDOW w AS (PARTITION BY clade ORDER BY x)), z AS (SELECT clade, round(arg_max(d, x), 6) AS delta_frequency FROM r GROUP BY 1) SELECT strain, clade, delta_frequency FROM (SELECT DISTINCT strain, clade FROM s) LEFT JOIN z USING (clade)")
def delta_frequency(spark, sf):
    p = _months(spark, sf)
    return K.delta_frequency(p, "clade", "x", "f", 2, p.select("strain", "clade").distinct()).select("strain", "clade", *R("delta_frequency", digits=6))


@query("""WITH e AS (SELECT event_type AS k, date_diff('day', DATE '2024-01-01', ts::DATE)::DOUBLE AS x FROM events), p(t, v) AS (SELECT a.x::DOUBLE, b.y::DOUBLE FROM range(10, 40, 10) a(x), range(0, 40, 5) b(y) WHERE b.y <= a.x),
m AS (SELECT t, k, v, sum(0.8 * exp(-0.5 * ((x - v) / 3) ** 2) / (3 * sqrt(2 * pi())) + 0.2 * exp(-0.5 * ((x - v) / 9) ** 2) / (9 * sqrt(2 * pi()))) AS m FROM e, p WHERE x < t GROUP BY ALL)
SELECT t AS timepoint, k AS event_type, v AS pivot, round(m / sum(m) OVER (PARTITION BY t, v), 6) AS frequency FROM m""")
def censored_frequencies(spark, sf):
    e = read(spark, sf, "events").select("event_type", F.datediff(day("ts"), F.lit("2024-01-01")).cast("double").alias("x"))
    grid = values(spark, "pivot double", *[(float(x),) for x in range(0, 40, 5)])
    return K.censored_frequencies(e, "event_type", "x", values(spark, "timepoint double", (10.0,), (20.0,), (30.0,)), grid, 3.0, 9.0, 0.8).select("timepoint", "event_type", "pivot", *R("frequency", digits=6))


@query(f"WITH {_PANEL}, k AS (SELECT t, clade, strain // 3 AS sample, sum(f) AS f FROM s WHERE t = (SELECT max(t) FROM s WHERE t < DATE '1998-06-01') GROUP BY ALL) SELECT clade FROM k WHERE f BETWEEN 0.02 AND 0.2 GROUP BY clade HAVING count(DISTINCT sample) = (SELECT count(DISTINCT sample) FROM k)")
def active_clades(spark, sf):
    p = _panel(spark, sf).withColumn("sample", F.floor(F.col("strain") / 3))
    return K.active_clades(p, "clade", "sample", "t", "f", p.where("t < '1998-06-01'").agg(F.max("t")).scalar(), 0.02, 0.2)


@query(f"""WITH {_PANEL}, q AS (SELECT a.t, a.strain AS a, b.t AS u, b.f, abs(a.strain - b.strain) AS d FROM s a JOIN s b ON b.t = a.t OR b.t = (a.t + INTERVAL 1 MONTH)::DATE),
z AS (SELECT a || '@' || t AS sample, sum(f * d) FILTER (u = t) AS n, sum(f * d) FILTER (u > t) AS l FROM q GROUP BY ALL) SELECT sample, round(n, 6) AS to_present, round(l, 6) AS to_future, round(log2(l / n), 5) AS log2_ratio FROM z""")
def weighted_distances(spark, sf):
    p = _panel(spark, sf).withColumn("sample", F.concat_ws("@", F.col("strain").cast("string"), F.col("t").cast("string")))
    other = p.select(F.col("sample").alias("other_sample"), F.col("t").alias("_u"), F.col("strain").alias("_b"))
    near = p.select("sample", "t", "strain", F.explode(F.array("t", F.add_months("t", 1))).alias("_u"))
    d = near.join(other, "_u").select("sample", "other_sample", F.abs(F.col("strain") - F.col("_b")).alias("distance"))
    return M.weighted_distances(p, d, "t", 1, "sample", "f").select("sample", *R("to_present", "to_future", digits=6), F.round("log2_ratio", 5).alias("log2_ratio"))


@query(f"WITH {_PANEL}, c AS (SELECT t, round(avg(d), 6) AS d, round(avg(x), 6) AS x FROM p GROUP BY 1) SELECT t, 'd' AS predictor, d AS coefficient FROM c UNION ALL SELECT t, 'x', x FROM c")
def scores_by_timepoint(spark, sf):
    c = _panel(spark, sf).groupBy("t").agg(F.array(F.lit("d"), F.lit("x")).alias("names"), F.array(F.round(F.avg("d"), 6), F.round(F.avg("x"), 6)).alias("values"))
    return M.scores_by_timepoint(c, "t", "names", "values")


@query(f"""WITH {_PANEL}, b(candidate, bd, bx) AS (VALUES ('model', 0.4, -0.3), ('naive', 0.0, 0.0)), j AS (SELECT s.*, candidate, f * exp(bd * d + bx * x) AS e FROM s, b), n AS (SELECT *, e / sum(e) OVER (PARTITION BY candidate, t) AS pr FROM j),
c AS (SELECT candidate, t, clade, sum(pr) AS e FROM n GROUP BY ALL), z AS (SELECT t, clade, sum(f) AS o FROM s GROUP BY ALL) SELECT candidate, round(avg(abs(coalesce(o, 0) - e)), 6) AS loss FROM c LEFT JOIN z ON z.clade = c.clade AND z.t = (c.t + INTERVAL 12 MONTH)::DATE GROUP BY 1""")
def test_model(spark, sf):
    p = _panel(spark, sf)
    observed = p.groupBy("t", "clade").agg(F.sum("f").alias("observed")).select(F.add_months("t", -12).alias("t"), "clade", "observed")
    return M.test_model(p, {"d": 0.4, "x": -0.3}, "t", "clade", "f", observed, 1.0).select("candidate", *R("loss", digits=6))


@query(f"""{_TIPS}, w AS (SELECT node, abs(s_acctbal) / sum(abs(s_acctbal)) OVER () AS f, (node % 5) / 5.0 AS fit FROM tips JOIN supplier ON s_suppkey + 1 = node), g AS (SELECT node, d, f * exp(fit * d) AS g FROM w, (VALUES (0.25), (1.0)) v(d)), n AS (SELECT node, d, g / sum(g) OVER (PARTITION BY d) AS p FROM g)
SELECT ancestor AS node, d::DOUBLE AS delta, round(sum(p), 6) AS projected FROM c JOIN n USING (node) GROUP BY ALL""")
def project_tree(spark, sf):
    e = _tree(spark, sf)
    tips = T.tips_only(e).select("node", F.abs("s_acctbal").alias("f"), ((F.col("node") % 5) / 5.0).alias("fit"))
    total = tips.agg(F.sum("f").alias("_t"))
    tips = tips.withColumn("_t", total.scalar()).withColumn("f", F.col("f") / F.col("_t")).drop("_t")
    return M.project_tree(tips, T.closure(e), "node", "f", "fit", [0.25, 1.0]).select("node", "delta", *R("projected", digits=6))


@query(f"WITH {_CLOSURE}, t AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL)), w AS (SELECT node, abs(s_acctbal) / sum(abs(s_acctbal)) OVER () AS f FROM t JOIN supplier ON s_suppkey + 1 = node), n AS (SELECT ancestor AS node, sum(f) AS f FROM c JOIN w USING (node) GROUP BY 1) SELECT n.node, round(n.f, 6) AS frequency FROM n JOIN e USING (node) JOIN n p ON p.node = e.parent WHERE n.f BETWEEN 0.05 AND 0.6 AND n.f < p.f")
def clades_in_band(spark, sf):
    e, tips = _weighted_tips(spark, sf)
    return T.clades_in_band(e, T.closure(e), tips, "f", 0.05, 0.6).select("node", *R("frequency", digits=6))


def _weighted_tips(spark, sf):
    e = _tree(spark, sf)
    tips = T.tips_only(e).select("node", F.abs("s_acctbal").alias("v"))
    total = tips.agg(F.sum("v")).scalar()
    return e, tips.withColumn("_t", total).select("node", (F.col("v") / F.col("_t")).alias("f"))


@query(f"WITH {_CLOSURE}, k AS (SELECT node FROM e WHERE node % 2 = 1 AND node > 2) SELECT node FROM k WHERE node NOT IN (SELECT c.node FROM c JOIN k ON k.node = c.ancestor WHERE hops > 0)")
def separate_clades(spark, sf):
    e = _tree(spark, sf)
    dates = e.select("node", F.date_add(F.lit("2000-01-01").cast("date"), F.col("node").cast("int")).alias("date"))
    return T.separate_clades(T.closure(e), e.where("node % 2 = 1").select("node"), dates, F.lit("2000-01-04").cast("date"))


@query(f'''WITH RECURSIVE e AS (SELECT s_suppkey + 1 AS node, CASE WHEN s_suppkey > 0 THEN (s_suppkey + 1) // 2 END AS parent FROM supplier), t AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL) AND NOT (node > 4 AND node % 3 <> 0)),
u(node) AS (SELECT node FROM t UNION SELECT e.parent FROM u JOIN e USING (node) WHERE e.parent IS NOT NULL) SELECT node FROM u''')
def prune_outliers(spark, sf):
    """Tips dated after a year and not of a kind go, and inner nodes that led to nothing else."""
    e = _tree(spark, sf)
    outliers = e.where("node > 4 and node % 3 <> 0").select("node")
    return T.prune_tips(e, T.closure(e), outliers).select("node")


@query('''WITH t AS (SELECT o_orderkey AS node, CASE WHEN o_orderkey % 50 > 0 THEN 1990 + (o_orderkey % 37) / 10.0 END AS date, 1992.0 AS expected, 1991.0 + (o_orderkey % 3) AS parent_date, o_orderkey % 5 AS m FROM orders), z AS (SELECT *, (date - expected) / 1.5 / (SELECT stddev_pop((date - expected) / 1.5) FROM t) AS z FROM t)
SELECT node, round(z, 5) AS z, CASE WHEN date IS NULL THEN 'bad_date' WHEN z > 0 THEN 'date_too_late' WHEN abs(date - parent_date) > m / 2.0 THEN 'date_too_early' ELSE 'excess_mutations' END AS diagnosis FROM z WHERE date IS NULL OR abs(z) > 1.2''')
def diagnose_clock(spark, sf):
    k = F.col("o_orderkey")
    tips = read(spark, sf, "orders").select(k.alias("node"), F.when(k % 50 > 0, 1990 + (k % 37) / 10.0).alias("date"), F.lit(1992.0).alias("expected"), (1991.0 + k % 3).alias("parent_date"), (k % 5).alias("mutations"))
    return T.diagnose_clock(tips, 2.0, 1.5, 1.2).select("node", *R("z", digits=5), "diagnosis")


@query(f'''WITH {_CLOSURE}, o AS (SELECT c.node, arg_min(c.ancestor, c.hops) AS past FROM c WHERE hops > 0 AND ancestor < 6 GROUP BY 1)
SELECT o.node, past, (SELECT count(*) FROM range(1, 19) r(i) WHERE i % 2 = 0 AND substr(a.s_name, i, 1) <> substr(b.s_name, i, 1))::BIGINT AS distance FROM o JOIN supplier a ON a.s_suppkey + 1 = o.node JOIN supplier b ON b.s_suppkey + 1 = past''')
def distance_to_past_ancestor(spark, sf):
    e = _tree(spark, sf)
    dates = e.select("node", F.date_add(F.lit("2000-01-01").cast("date"), F.col("node").cast("int")).alias("date"))
    seqs = read(spark, sf, "supplier").select((F.col("s_suppkey") + 1).alias("node"), F.col("s_name").alias("seq"))
    return T.distance_to_past_ancestor(e, dates, F.lit("2000-01-07").cast("date"), seqs, "01" * 9).select("node", "past", *L("distance"))


@query(f'''WITH {_PANEL}, m AS (SELECT clade, date_diff('month', DATE '1992-01-01', t)::DOUBLE AS x, sum(f) AS f FROM s GROUP BY ALL), b AS (SELECT clade, f, d, date_diff('month', DATE '1992-01-01', t)::DOUBLE AS x FROM s),
d AS (SELECT b.*, v, f * exp(0.4 * d * greatest(v, 0)) AS g FROM b, (VALUES (-0.5), (0.0), (0.25), (1.0)) w(v)), n AS (SELECT *, g / sum(g) OVER (PARTITION BY x, v) AS p FROM d), q AS (SELECT x, clade, v, sum(p) AS p FROM n GROUP BY ALL),
o AS (SELECT q.*, l.x AS x0, l.f AS f0, h.x AS x1, h.f AS f1 FROM q JOIN m l ON l.clade = q.clade AND l.x <= q.x + q.v JOIN m h ON h.clade = q.clade AND h.x >= q.x + q.v QUALIFY row_number() OVER (PARTITION BY q.x, q.clade, q.v ORDER BY l.x DESC, h.x) = 1),
z AS (SELECT *, CASE WHEN x1 = x0 THEN f0 ELSE f0 + (x + v - x0) / (x1 - x0) * (f1 - f0) END AS o FROM o)
SELECT x, clade, v::DOUBLE AS delta, round(o, 6) AS observed, round(CASE WHEN v < 0 THEN o ELSE p END, 6) AS predicted FROM z''')
def validate_trajectories(spark, sf):
    p = M.fitness(M.standardise(_months(spark, sf), ["d"], "f", "t"), {"d": 0.4})
    lines = p.groupBy("clade", F.col("x").alias("pivot")).agg(F.sum("f").alias("frequency"))
    return M.validate_trajectories(p, lines, "x", "clade", "f", "fitness", [-0.5, 0.0, 0.25, 1.0]).select("x", "clade", "delta", *R("observed", "predicted", digits=6))


# -- what the record queries above leave out ----------------------------------------------------------------------


@query("WITH g AS (SELECT c_nationkey AS r FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1 HAVING count(DISTINCT o_orderpriority) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) = 3) SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND c_nationkey IN (SELECT r FROM g)")
def filter_by_region(spark, sf):
    o = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return C.filter_by_region(o, "c_nationkey", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey")


@query("SELECT c_custkey, concat(c_name, ' (', c_mktsegment, ', ', n_name, ')') AS label FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def compose_label(spark, sf):
    c = read(spark, sf, "customer").join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select("c_custkey", S.label("%s (%s, %s)", F.col("c_name"), F.col("c_mktsegment"), F.col("n_name")).alias("label"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'fixed' ELSE n_name END AS country, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS division FROM customer JOIN nation ON n_nationkey = c_nationkey")
def override_locations(spark, sf):
    c = read(spark, sf, "customer").join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    fixed = read(spark, sf, "customer").where("c_custkey % 4 = 0").select("c_custkey", F.lit("fixed").alias("country"), F.lit(None).cast("string").alias("division"))
    return J.override_locations(c, fixed, "c_custkey", ["country", "division"], {"country": F.col("n_name"), "division": F.col("c_mktsegment")}).select("c_custkey", "country", "division")


@query("WITH v AS (SELECT n_name, avg(s_acctbal) AS x FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_nationkey % 5 > 0 GROUP BY 1) SELECT c_custkey, round(x, 4) AS coverage FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN v USING (n_name)")
def coverage_for(spark, sf):
    """Customers of even keys name their country, others give its code."""
    n = read(spark, sf, "nation").withColumn("code", F.concat(F.lit("C"), F.col("n_nationkey").cast("string")))
    c = read(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("country", F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).otherwise(F.col("code")))
    covered = read(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).where("n_nationkey % 5 > 0").groupBy(F.col("n_name").alias("country")).agg(F.avg("s_acctbal").alias("coverage"))
    return J.coverage_for(c.select("c_custkey", "country"), "country", n.select("code", F.col("n_name").alias("country")), covered).select("c_custkey", *R("coverage"))


@query(f"WITH {_PANEL}, m AS (SELECT clade, date_diff('month', DATE '1992-01-01', t)::DOUBLE AS x, sum(f) AS f FROM s GROUP BY ALL), a AS (SELECT * FROM m UNION ALL SELECT clade, 9001.0, CASE WHEN clade = 1 THEN 0.25 ELSE 0.0 END FROM (SELECT DISTINCT clade FROM m) UNION ALL SELECT clade, 9002.0, CASE WHEN clade = 1 THEN 0.5 ELSE 0.0 END FROM (SELECT DISTINCT clade FROM m)) SELECT clade, count(*)::BIGINT AS n, round(max(x), 2) AS last, string_agg(round(f, 3)::VARCHAR, ',' ORDER BY x) FILTER (x > 9000) AS tail FROM a GROUP BY 1")
def extend_trajectories(spark, sf):
    m = _months(spark, sf).groupBy("clade", F.col("x").alias("pivot")).agg(F.sum("f").alias("frequency")).withColumn("pivot_idx", F.col("pivot").cast("int"))
    ahead = values(spark, "clade long, pivot double, frequency double", (1, 9001.0, 0.25), (1, 9002.0, 0.5))
    out = A.extend_trajectories(m, ahead, "clade", [9001.0, 9002.0])
    return out.select("clade", F.size("pivots").cast("long").alias("n"), F.element_at("pivots", -1).alias("last"), F.array_join(F.transform(F.slice("frequencies", -2, 2), lambda x: F.round(x, 3)), ",").alias("tail"))


# -- files: written to the session's shared folder and read back ---------------------------------------------------


def _folder(spark, name):
    return f"{IO.work_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


@query("SELECT concat('c', c_custkey) AS id, upper(replace(c_name, ' ', '')) AS seq FROM customer")
def fasta_round_trip(spark, sf):
    path = _folder(spark, "fasta")
    IO.write_fasta(read(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.replace("c_name", F.lit(" "), F.lit("")).alias("seq"), F.lit("ha").alias("segment")), path)
    return IO.read_fasta(spark, f"{path}/segment=ha").select("id", "seq")


@query("SELECT c_custkey::VARCHAR AS c_custkey, printf('%.3f', c_acctbal) AS c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN '?' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def table_round_trip(spark, sf):
    path = _folder(spark, "table")
    IO.write_table(read(spark, sf, "customer").select("c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("c_mktsegment")), path, "?", "%.3f")
    return IO.read_table(spark, path, comment=None)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def rejected_records(spark, sf):
    """Records that fail their check, written aside as JSON lines and read back."""
    path = _folder(spark, "rejected")
    IO.write_records(C.split_invalid(read(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus").isin("F", "O"))[1], path)
    return IO.read_records(spark, path, "o_orderkey long, o_orderstatus string")


@query("SELECT s_suppkey::VARCHAR AS node, s_name AS name, s_nationkey::VARCHAR AS nation FROM supplier")
def node_data_round_trip(spark, sf):
    path = _folder(spark, "node-data")
    lines = IO.to_node_data(read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("node"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")), "node")
    # A JSON document for each thousand nodes.
    lines.groupBy(F.floor(F.col("node").cast("long") / 1000).alias("bucket")).agg(F.concat(F.lit('{"nodes":{'), F.array_join(F.transform(F.collect_list(F.struct("node", "json")), lambda x: F.concat(F.lit('"'), x["node"], F.lit('":'), x["json"])), ","), F.lit("}}")).alias("value")).write.mode("overwrite").partitionBy("bucket").text(path)
    return IO.read_node_data(spark, path).select("node", F.col("attributes")["name"].alias("name"), F.col("attributes")["nation"].alias("nation"))


@query("SELECT c_custkey AS k, c_name AS name, 0::BIGINT AS batch_rank FROM customer UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier")
def union_batches(spark, sf):
    a, b = read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), read(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return IO.union_batches([a, b]).select("k", "name", *L("batch_rank"))


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def append_tables(spark, sf):
    a, b = read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), read(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    return IO.append_tables([a, b])
