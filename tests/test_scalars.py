"""Golden tables of scalar functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from lineagrid.functions import scalars as S


def values(spark, f, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(f).collect()]


CASES = [
    ("h5n1", "h5n1", True), ("h5n1", "h5n2", False), ("h5n1", "h5", False), ("h5n1", "tbd", False), ("h5n1pdm", "h5n1pdm", True), ("h5n1pdm", "h5n1", False),
    ("h5nx", "h5", True), ("h5nx", "h5n1", True), ("h5nx", "h7n9", False), ("h5nx", "n3", False), ("h5", "h5", True), ("h5", "h5n1", False), ("h5", "n3", False), ("h5", "tbd", False),
    ("hxn2", "h5", False), ("hxn2", "h3n2", True), ("hxn2", "h7n9", False), ("hxn2", "n2", True), ("hxn2", "n3", False), ("n2", "n2", True), ("n2", "n3", False), ("n2", "h3n2", False), ("n2", "h3", False),
]


def test_lineage_match(spark):
    df = spark.createDataFrame([(i, v) for i, (_, v, _) in enumerate(CASES)], "i int, v string")
    got = {r.i: r for r in df.select("i", *[S.lineage_match(F.col("v"), [p]).alias(p) for p in {c[0] for c in CASES}]).collect()}
    assert [got[i][p] for i, (p, _, _) in enumerate(CASES)] == [c[2] for c in CASES]


@pytest.mark.parametrize(("history", "want"), [("E1", "egg"), ("original", "unpassaged"), ("MDCK2", "cell"), ("cell", "cell"), ("throat", "unpassaged"), ("?", "undetermined"), ("unknown", "undetermined")])
def test_passage(spark, history, want):
    assert values(spark, S.passage_category(F.col("x")), [(history,)], "x string") == [want]


def test_epiweek(spark):
    days = [datetime.date(2014, 12, 28), datetime.date(2015, 1, 3), datetime.date(2025, 12, 31), datetime.date(2016, 1, 1)]
    assert values(spark, S.epiweek(F.col("d")), [(d,) for d in days], "d date") == [201453, 201453, 202553, 201552]


def test_ages_and_locations(spark):
    assert values(spark, S.combine_age(F.col("a"), F.col("u")), [("5", ""), ("5.0", "Y"), ("x", "m"), ("7", "M")], "a string, u string") == ["5y", "?", "?", "7m"]
    assert values(spark, S.split_location(F.col("x")), [("A / B",), (None,)], "x string") == [("A", "B", "", ""), ("", "", "", "")]
    assert values(spark, S.split_division(F.col("a"), F.col("b")), [("x, y", ""), ("x, y", "z"), ("x", "")], "a string, b string") == [("x", "y"), ("x", "z"), ("x", "")]


@pytest.mark.parametrize(("name", "want"), [
    ("b/sydney/508/2008", "B/Sydney/508/2008"), ("A/Egypt/51(S)/2006", "A/Egypt/51/2006"), ("A/Mali/013MOP/2015", "A/Mali/13MOP/2015"), ("B/Florida/1/96", "B/Florida/1/1996"),
    ("A/Iceland183/2009", "A/Iceland/183/2009"), ("B/California/12/2015BX59B", "B/California/12/2015"), ("B/clinicalisolateSA116Philippines/2002", "B/Philippines/SA116/2002"),
    ("12IRL26168", "A/Ireland/26168/2012"), ("A/NorthernTerritory/60/68//", "A/NorthernTerritory/60/1968"), ("B/WAKAYAMA-C/2/2016", "B/Wakayama-C/2/2016"), ("H1N1/Spain/PV-1/2025", "A/Spain/PV-1/2025"),
])
def test_names(spark, name, want):
    assert values(spark, S.fix_name(F.col("x"), F.lit(True)), [(name,)], "x string") == [want]


def test_sequences(spark):
    assert values(spark, S.sequence_diff(F.col("a"), F.col("b")), [("ACT", "AGA"), ("", "A")], "a string, b string") == [[(2, "C", "G"), (3, "T", "A")], []]
    assert values(spark, S.parse_mutations(F.col("x")), [("HA1:N145S,K3R,bad",)], "x string") == [[("HA1", "N", 145, "S"), ("", "K", 3, "R")]]
    assert values(spark, S.list_size(F.col("x")), [("",), ("a,b",)], "x string") == [1, 2]
    assert values(spark, S.motif_count(F.col("x")), [("NASANGTA",)], "x string") == [2]


def test_bins(spark):
    f = S.bin_days(F.col("d"), F.to_date(F.lit("2024-01-11")), [0, 1, 10], ["new", "old"])
    days = [datetime.date(2024, 1, x) for x in (11, 10, 9, 1)] + [datetime.date(2023, 12, 31)]
    assert values(spark, f, [(d,) for d in days], "d date") == ["new", "new", "old", "old", "undefined"]


def test_names_in_lower_case_end_with_their_letters(spark):
    rows = [("b/sydney/508/2008*x", "B/sydney/508/2008"), ("a/lyon/1/2001", "A/lyon/1/2001"), ("B/Sydney/508/2008*x", "B/Sydney/508/2008*x")]
    df = spark.createDataFrame(rows, "raw string, want string")
    got = df.select("want", S.fix_name(F.col("raw"), F.lit(False)).alias("got")).collect()
    assert [r.got.lower() for r in got] == [r.want.lower() for r in got] and [r.got[0] for r in got] == ["B", "A", "B"]
