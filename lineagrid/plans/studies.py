"""Registered queries of cross-validation, trees of any depth, distance maps, fingerprints, sampling and build matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineagrid.functions import scalars as S
from lineagrid.operators import builds as B
from lineagrid.operators import crossval as V
from lineagrid.operators import fingerprints as P
from lineagrid.operators import forecast as M
from lineagrid.operators import frequencies as K
from lineagrid.operators import link as J
from lineagrid.operators import predictors as N
from lineagrid.operators import quality as U
from lineagrid.operators import sequences as Q
from lineagrid.operators import trees as T
from lineagrid.operators import windows as W
from lineagrid.plans.catalog import _CLOSURE, _DIFF, _PANEL, L, R, _panel, _tree, _versions, query, read, values
from lineagrid.plans.records import _folder
from lineagrid.sources import files as IO

# -- cross-validation ---------------------------------------------------------------------------------------------

_GRID = [("a", 0.0, 0.0), ("b", 0.4, -0.3), ("c", -0.2, 0.1), ("d", 1.0, 1.0), ("e", 0.1, 0.05), ("f", -0.6, 0.2), ("g", 0.02, -0.01)]

#: Scored (candidate, t) rows: s is the sum of absolute errors over n clades; splits are windows of three years that end a year before.
_TRIALS = f"""{_PANEL}, b(candidate, bd, bx) AS (VALUES {", ".join(str(c) for c in [*_GRID, ("null", 0.0, 0.0)])}),
j AS (SELECT s.*, candidate, f * exp((bd * d + bx * x) * 1.0) AS e FROM s, b), nn AS (SELECT *, e / sum(e) OVER (PARTITION BY candidate, t) AS pr FROM j),
c AS (SELECT candidate, t, clade, sum(f) AS i, sum(pr) AS e FROM nn GROUP BY ALL), z AS (SELECT t, clade, sum(f) AS o FROM s GROUP BY ALL),
sc AS (SELECT c.candidate, c.t, count(*) AS n, sum(abs(coalesce(o, 0) - e)) AS s FROM c LEFT JOIN z ON z.clade = c.clade AND z.t = (c.t + INTERVAL 12 MONTH)::DATE GROUP BY ALL),
tp AS (SELECT DISTINCT t FROM s), v AS (SELECT t AS validate, (t - INTERVAL 12 MONTH)::DATE AS l, (t - INTERVAL 48 MONTH)::DATE AS f FROM tp),
sp AS (SELECT validate, t.t AS train FROM v JOIN tp t ON t.t <= l AND t.t >= f WHERE f >= (SELECT min(t) FROM tp)),
aged AS (SELECT *, row_number() OVER (PARTITION BY validate ORDER BY train DESC) AS age, count(*) OVER (PARTITION BY validate) AS k FROM sp)"""


def _folds(spark, sf):
    rows = _panel(spark, sf)
    observed = rows.groupBy("t", "clade").agg(F.sum("f").alias("observed")).select(F.add_months("t", -12).alias("t"), "clade", "observed")
    panel = V.Panel(rows, observed, ["d", "x"], "t", "clade", "f", 1.0, "mae")
    splits = M.train_validate_splits(rows.select("t").distinct(), "t", 12, 3)
    return panel, values(spark, "candidate string, d double, x double", *_GRID), splits


@query(f"""WITH {_TRIALS} SELECT candidate, validate, round(sum(s) / sum(n) + 0.1 * (abs(bd) + abs(bx)), 6) AS loss FROM sp JOIN sc ON sc.t = train JOIN b USING (candidate) WHERE candidate <> 'null' GROUP BY candidate, validate, bd, bx""")
def candidate_losses(spark, sf):
    """Every candidate on every split."""
    panel, candidates, splits = _folds(spark, sf)
    return V.search(panel, candidates, splits, l1=0.1).select("candidate", "validate", *R("loss", digits=6))


@query(f"""WITH {_TRIALS},
one AS (SELECT validate, candidate, sum(s) / sum(n) + 0.1 * (abs(bd) + abs(bx)) AS loss FROM aged JOIN sc ON sc.t = train JOIN b USING (candidate) WHERE candidate <> 'null' AND age <= ceil(k / 4) GROUP BY validate, candidate, bd, bx),
left1 AS (SELECT validate, candidate FROM one QUALIFY row_number() OVER (PARTITION BY validate ORDER BY loss, candidate) <= 4),
two AS (SELECT validate, candidate, sum(s) / sum(n) + 0.1 * (abs(bd) + abs(bx)) AS loss FROM aged JOIN left1 USING (validate) JOIN sc USING (candidate) JOIN b USING (candidate) WHERE sc.t = train AND age <= ceil(k / 2) GROUP BY validate, candidate, bd, bx),
left2 AS (SELECT validate, candidate FROM two QUALIFY row_number() OVER (PARTITION BY validate ORDER BY loss, candidate) <= 2)
SELECT validate, candidate, round(sum(s) / sum(n) + 0.1 * (abs(bd) + abs(bx)), 6) AS loss FROM sp JOIN left2 USING (validate) JOIN sc USING (candidate) JOIN b USING (candidate) WHERE sc.t = train GROUP BY validate, candidate, bd, bx""")
def successive_halving(spark, sf):
    """Seven candidates in three rounds: four, then two are left to each split."""
    panel, candidates, splits = _folds(spark, sf)
    return V.search(panel, candidates, splits, l1=0.1, rounds=3).select("validate", "candidate", *R("loss", digits=6))


_BEST = f"""WITH {_TRIALS}, tr AS (SELECT validate, candidate, sum(s) / sum(n) AS err, sum(n) AS n, sum(s) / sum(n) + 0.1 * (abs(bd) + abs(bx)) AS loss FROM sp JOIN sc ON sc.t = train JOIN b USING (candidate) GROUP BY validate, candidate, bd, bx),
best AS (SELECT * FROM tr WHERE candidate <> 'null' QUALIFY row_number() OVER (PARTITION BY validate ORDER BY loss, candidate) = 1),
cv AS (SELECT best.validate, best.candidate, best.err AS training_error, z.err AS null_training_error, best.n AS training_n, vm.s / vm.n AS validation_error, vz.s / vz.n AS null_validation_error, vm.n AS validation_n
FROM best JOIN tr z ON z.validate = best.validate AND z.candidate = 'null' JOIN sc vm ON vm.t = best.validate AND vm.candidate = best.candidate JOIN sc vz ON vz.t = best.validate AND vz.candidate = 'null')"""
_ERRORS = ("training_error", "null_training_error", "validation_error", "null_validation_error")


@query(f"""{_BEST} SELECT validate, candidate, training_n::BIGINT AS training_n, validation_n::BIGINT AS validation_n, {", ".join(f"round({e}, 6) AS {e}" for e in _ERRORS)} FROM cv""")
def cross_validation(spark, sf):
    """The best candidate of each split, scored where it was fitted and a year later."""
    panel, candidates, splits = _folds(spark, sf)
    return V.cross_validate(panel, candidates, splits, l1=0.1).select("validate", "candidate", "training_n", "validation_n", *R(*_ERRORS, digits=6))


@query(f"""{_BEST} SELECT validate, round(avg(CASE WHEN round(validation_error, 9) < round(null_validation_error, 9) THEN 1.0 ELSE 0.0 END) OVER (ORDER BY validate), 6) AS beats_naive FROM cv""")
def running_best(spark, sf):
    """The share of splits so far in which the fitted model beats the one without growth."""
    panel, candidates, splits = _folds(spark, sf)
    # A model of no growth and the naive one differ by the order of their sums.
    cv = V.cross_validate(panel, candidates, splits, l1=0.1).select("validate", *R("validation_error", "null_validation_error", digits=9))
    return W.beats_naive(cv, [], "validate", "validation_error", "null_validation_error").select("validate", *R("beats_naive", digits=6))


@query(f"""WITH {_TRIALS} SELECT m.t, round(m.s / m.n, 6) AS error, round(z.s / z.n, 6) AS null_error, m.n::BIGINT AS n FROM sc m JOIN sc z ON z.t = m.t AND z.candidate = 'null' WHERE m.candidate = 'b'""")
def model_by_timepoint(spark, sf):
    """A fixed model tested at every timepoint."""
    panel, _, _ = _folds(spark, sf)
    return V.score_model(panel, {"d": 0.4, "x": -0.3}).select("t", *R("error", "null_error", digits=6), "n")


# -- distance maps and preferences along trees --------------------------------------------------------------------

_MAPS = [("one", 17, None, None, 1.0), ("one", 18, "1", "3", 2.0), ("two", 18, None, "7", 0.5), ("two", 16, None, None, 4.0)]
#: Sequences of nodes, the root's, and each distance map's weight of a change.
_NODES = f"""{_CLOSURE}, q AS (SELECT s_suppkey + 1 AS node, s_name AS s FROM supplier), m(map, site, f, t, w) AS (VALUES {", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in m) + ")" for m in _MAPS)}),
pairs AS (SELECT e.node, 1 AS root, coalesce(e.parent, 1) AS parent, coalesce((SELECT ancestor FROM c WHERE c.node = e.node AND hops = 3), 1) AS third FROM e)"""


def _distances(base):
    return f"""SELECT p.node, map, sum(CASE WHEN substr(a.s, site, 1) <> substr(b.s, site, 1) AND (f IS NULL OR f = substr(b.s, site, 1)) AND (t IS NULL OR t = substr(a.s, site, 1)) THEN w ELSE 0 END)::DOUBLE AS distance
FROM pairs p JOIN q a ON a.node = p.node JOIN q b ON b.node = p.{base}, m GROUP BY ALL"""


def _sequences(spark, sf):
    seqs = read(spark, sf, "supplier").select((F.col("s_suppkey") + 1).alias("node"), F.col("s_name").alias("seq"))
    return _tree(spark, sf), seqs, values(spark, "map string, site int, `from` string, `to` string, weight double", *_MAPS)


@query(f"WITH {_NODES} {_distances('root')}")
def distances_to_root(spark, sf):
    return Q.map_distances(*_sequences(spark, sf), "root").select("node", "map", "distance")


@query(f"WITH {_NODES} {_distances('parent')}")
def distances_to_parent(spark, sf):
    return Q.map_distances(*_sequences(spark, sf), "parent").select("node", "map", "distance")


@query(f"WITH {_NODES} {_distances('third')}")
def distances_to_ancestor(spark, sf):
    """Against the ancestor three branches up, or the root."""
    return Q.map_distances(*_sequences(spark, sf), 3).select("node", "map", "distance")


@query(f"WITH {_NODES}, d AS ({_distances('parent')}) SELECT c.node, map, sum(distance) AS distance FROM c JOIN d ON d.node = c.ancestor GROUP BY ALL")
def distances_along_path(spark, sf):
    """Distances of branches added up from the root."""
    return Q.map_distances(*_sequences(spark, sf), "parent", cumulative=True).select("node", "map", "distance")


_PREFERENCES = [(17, "0", 0.4), (17, "1", 0.2), (17, "2", 0.1), (18, "1", 0.25), (18, "3", 0.5), (18, "5", 0.01)]
_PREFER = f"""{_NODES}, pr(site, aa, p) AS (VALUES {", ".join(str(p) for p in _PREFERENCES)}), al AS (SELECT node, i AS site, substr(s, i, 1) AS aa FROM q, range(1, 19) r(i)), lp AS (SELECT al.*, coalesce(p, 1e-10) AS p FROM al LEFT JOIN pr USING (site, aa))"""


@query(f"""WITH {_PREFER}, br AS (SELECT e.node, sum(CASE WHEN a.aa <> b.aa THEN log2(a.p / b.p) ELSE 0 END) AS v FROM e JOIN lp a ON a.node = e.node JOIN lp b ON b.node = coalesce(e.parent, e.node) AND b.site = a.site GROUP BY 1)
SELECT c.node, round(sum(v), 5) AS score FROM c JOIN br ON br.node = c.ancestor GROUP BY 1""")
def preference_path(spark, sf):
    """Effects of all changes from the root down."""
    edges, seqs, _ = _sequences(spark, sf)
    return Q.preference_path(edges, seqs, values(spark, "site int, aa string, preference double", *_PREFERENCES)).select("node", *R("score", digits=5))


@query(f"WITH {_PREFER} SELECT node, round(avg(ln(p)), 5) AS score FROM lp WHERE site > 9 GROUP BY 1")
def mean_preference(spark, sf):
    """The mean log preference over half of the sites."""
    edges, seqs, _ = _sequences(spark, sf)
    prefs = values(spark, "site int, aa string, preference double", *_PREFERENCES)
    return Q.preference_path(edges, seqs, prefs, "mean", range(10, 19)).select("node", *R("score", digits=5))


@query("""WITH f AS (SELECT l_suppkey % 20 AS clade, l_linenumber AS sample, year(l_shipdate) AS y, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), s AS (SELECT *, q / sum(q) OVER (PARTITION BY sample, y) AS v FROM f),
e AS (SELECT max(y) FILTER (y <= 1998) AS a, max(y) AS z FROM s), c AS (SELECT clade, sample, sum(v) FILTER (y = a) AS current, coalesce(sum(v) FILTER (y = z), 0) AS future FROM s, e GROUP BY ALL)
SELECT clade, sample, round(current, 6) AS current, round(future, 6) AS future FROM c WHERE clade IN (SELECT clade FROM c WHERE current BETWEEN 0.045 AND 0.07 GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT sample) FROM c WHERE current IS NOT NULL))""")
def active_futures(spark, sf):
    """Clades within a band in all samples at the last observed year, and their share in the last of all."""
    l = read(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("clade"), F.col("l_linenumber").alias("sample"), F.year("l_shipdate").alias("pivot")).agg(F.sum("l_quantity").alias("q"))  # noqa: E741
    shares = W.normalise(l, ["sample", "pivot"], "q", "v").withColumn("seen", F.col("pivot") <= 1998)
    return K.active_futures(shares, "clade", "sample", "pivot", "v", "seen", 0.045, 0.07).select("clade", "sample", *R("current", "future", digits=6))


# -- versions of tables -------------------------------------------------------------------------------------------

#: Orders of a customer by status as sets of keys, in two versions.
_PARTS = """SELECT o_custkey, o_orderstatus AS part, list(DISTINCT o_orderkey::VARCHAR) AS names FROM orders WHERE {} GROUP BY ALL"""


@query(f"""WITH a AS ({_PARTS.format("o_orderkey % 19 > 0")}), b AS ({_PARTS.format("o_orderkey % 17 > 0")}), k AS (SELECT o_custkey FROM a INTERSECT SELECT o_custkey FROM b),
j AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.part, b.part) AS part, list_sort(list_filter(coalesce(a.names, []), lambda x: NOT list_contains(coalesce(b.names, []), x))) AS gone, list_sort(list_filter(coalesce(b.names, []), lambda x: NOT list_contains(coalesce(a.names, []), x))) AS new
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.part = b.part)
SELECT o_custkey, 'orders changed' AS change, concat(part, ' removed') AS field, array_to_string(gone, ', ') AS was, NULL AS now FROM j WHERE len(gone) > 0 AND o_custkey IN (SELECT o_custkey FROM k)
UNION ALL SELECT o_custkey, 'orders changed', concat(part, ' added'), NULL, array_to_string(new, ', ') FROM j WHERE len(new) > 0 AND o_custkey IN (SELECT o_custkey FROM k)
UNION ALL SELECT DISTINCT o_custkey, 'removed record', NULL, NULL, NULL FROM a WHERE o_custkey NOT IN (SELECT o_custkey FROM k) UNION ALL SELECT DISTINCT o_custkey, 'added record', NULL, NULL, NULL FROM b WHERE o_custkey NOT IN (SELECT o_custkey FROM k)""")
def diff_nested(spark, sf):
    """Names added to and removed from the parts of records, beside records added and removed."""
    o = read(spark, sf, "orders")

    def version(keep):
        parts = o.where(keep).groupBy("o_custkey", "o_orderstatus").agg(F.collect_set(F.col("o_orderkey").cast("string")).alias("names"))
        return parts.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "names"))).alias("orders"))

    return U.diff_records(version("o_orderkey % 19 > 0"), version("o_orderkey % 17 > 0"), "o_custkey", sets=["orders"])


@query(f"""WITH d AS ({_DIFF}), w AS (SELECT *, CASE WHEN lower(was) = lower(now) THEN 2.0 ELSE 0 END + CASE WHEN change = 'modified' THEN 0.5 ELSE 0 END AS c, CASE WHEN now IS NULL AND was IS NOT NULL THEN 1.5 ELSE 0 END + CASE WHEN change = 'modified' THEN 0.5 ELSE 0 END AS e FROM d)
SELECT o_orderkey, CASE WHEN c > 0.25 AND c >= e THEN 'case' WHEN e > 0.25 THEN 'emptied' ELSE 'unexplained' END AS reason, CASE WHEN greatest(c, e) > 0.25 THEN greatest(c, e) ELSE 0 END::DOUBLE AS weight, CASE WHEN greatest(c, e) > 0.25 THEN greatest(c, e) - CASE WHEN least(c, e) > 0.25 THEN least(c, e) ELSE 0 END END::DOUBLE AS lead FROM w""")
def explain_weighted(spark, sf):
    """Differences with the reason for which most evidence adds up."""
    d = U.diff_records(*_versions(spark, sf), "o_orderkey")
    evidence = [("case", F.lower("was") == F.lower("now"), 2.0), ("emptied", F.col("now").isNull() & F.col("was").isNotNull(), 1.5), ("case", F.col("change") == "modified", 0.5), ("emptied", F.col("change") == "modified", 0.5)]
    return U.explain_weighted(d, evidence, 0.25).select("o_orderkey", "reason", "weight", "lead")


#: Statuses of orders as repeated rows; in the second version one in three is another.
_REPEATS = "SELECT o_custkey % 50 AS k, o_orderstatus AS s FROM orders", "SELECT o_custkey % 50 AS k, CASE WHEN o_custkey % 50 < 20 AND o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders"


def _repeats(spark, sf):
    o = read(spark, sf, "orders").withColumn("k", F.col("o_custkey") % 50)
    other = F.when((F.col("k") < 20) & (F.col("o_orderkey") % 3 == 0), "X").otherwise(F.col("o_orderstatus"))
    return o.select("k", F.col("o_orderstatus").alias("s")), o.select("k", other.alias("s"))


@query(f"""WITH a AS ({_REPEATS[0]}), b AS ({_REPEATS[1]}), d AS (SELECT DISTINCT k FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)))
SELECT k AS bucket, (SELECT count(*) FROM b WHERE b.k = d.k)::BIGINT AS records, (SELECT count(*) FROM a WHERE a.k = d.k)::BIGINT AS previous FROM d""")
def changed_buckets(spark, sf):
    """The buckets in which two versions with repeated rows differ, by their sums of row hashes."""
    a, b = _repeats(spark, sf)
    return P.changed_buckets(P.tree(b, F.col("k"), 8), P.tree(a, F.col("k"), 8), 8)


@query(f"""WITH a AS ({_REPEATS[0]}), b AS ({_REPEATS[1]}), d AS ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
SELECT (SELECT count(*) FROM b)::BIGINT AS records, (SELECT count(*) FROM a)::BIGINT AS previous, 0::BIGINT AS delta, (SELECT count(*) FROM d) > 0 AS changed
UNION ALL SELECT 2 * (SELECT count(*) FROM a)::BIGINT, 2 * (SELECT count(*) FROM a)::BIGINT, 0::BIGINT, false""")
def repeated_rows_change(spark, sf):
    """Versions of as many rows that repeat: other ones, and the same twice."""
    a, b = _repeats(spark, sf)
    return U.record_change(b, a).union(U.record_change(a.union(a), a.union(a).repartition(5)))


# -- build matrices and draws -------------------------------------------------------------------------------------


def _quota_sql(groups):
    """SQL from ``m`` (build, o_orderkey, o_totalprice, month, cap) to what builds take, with at most cap rows a build."""
    return f"""s AS (SELECT build, month, any_value(cap) AS cap, count(*) AS n FROM m GROUP BY build, month),
r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY build ORDER BY n, month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, count(*) OVER (PARTITION BY build ORDER BY n, month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s),
qq AS (SELECT build, arg_min(floor((cap - below) / rest), n) AS q FROM r WHERE floor((cap - below) / rest) < n GROUP BY build),
t AS (SELECT s.build, month, cap, least(n, coalesce(q, n)) AS take, n > coalesce(q, n) AS open FROM s LEFT JOIN qq USING (build)),
z AS (SELECT *, cap - sum(take) OVER (PARTITION BY build) AS spare, count(*) FILTER (open) OVER (PARTITION BY build ORDER BY month ROWS UNBOUNDED PRECEDING) AS place FROM t),
f AS (SELECT build, month, take + CASE WHEN open AND place <= spare THEN 1 ELSE 0 END AS take FROM z)
SELECT {groups} FROM (SELECT *, row_number() OVER (PARTITION BY build, month ORDER BY o_totalprice DESC, md5(concat(o_orderkey, '0')), o_orderkey) AS rn FROM m) x JOIN f USING (build, month) WHERE rn <= take"""


@query(f"""WITH st(s) AS (VALUES ('F'), ('O'), ('P'), (NULL)), pr(p) AS (VALUES ('1-URGENT'), ('3-MEDIUM'), ('5-LOW'), (NULL)),
m AS (SELECT concat_ws('_', coalesce(s, 'None'), coalesce(p, 'None')) AS build, o_orderkey, o_totalprice, month(o_orderdate::DATE) AS month, CASE WHEN s = 'F' THEN 25 ELSE 60 END AS cap
FROM st, pr, orders WHERE (s IS NULL OR o_orderstatus = s) AND (p IS NULL OR o_orderpriority = p) AND (o_totalprice >= CASE WHEN p = '5-LOW' THEN 100000 ELSE 0 END)),
{_quota_sql("build, o_orderkey")}""")
def build_matrix(spark, sf):
    """Sixteen builds of statuses and priorities, some over all values, each spread over months within its own cap."""
    orders = read(spark, sf, "orders").withColumn("month", F.month("o_orderdate"))
    builds = B.matrix(
        spark, {"status": ["F", "O", "P", None], "priority": ["1-URGENT", "3-MEDIUM", "5-LOW", None]}, "{status}_{priority}",
        lambda status, priority: 25 if status == "F" else 60, price=lambda status, priority: 100000.0 if priority == "5-LOW" else 0.0,
    )
    matched = B.match(orders, builds, {"o_orderstatus": "status", "o_orderpriority": "priority"}, F.col("o_totalprice") >= F.col("b_price"))
    return B.subsample_builds(matched, ["month"], "o_orderkey", F.col("o_totalprice")).select("build", "o_orderkey")


# -- predictors by name -------------------------------------------------------------------------------------------

_MASK = "0" * 16 + "10"


@query(f"""WITH {_PREFER}, df AS (SELECT e.node, al.site, al.aa, rt.aa AS root, pa.aa AS parent, al.p AS new, pa.p AS old FROM e JOIN lp al ON al.node = e.node JOIN lp rt ON rt.node = 1 AND rt.site = al.site JOIN lp pa ON pa.node = coalesce(e.parent, e.node) AND pa.site = al.site),
rr AS (SELECT node, count(*) FILTER (aa <> root AND site = 17) AS ep, count(*) FILTER (aa <> root AND site <> 17) AS ne, count(*) FILTER (aa <> parent) AS mu, coalesce(sum(log2(new / old)) FILTER (aa <> parent), 0) AS dms FROM df GROUP BY 1),
pp AS (SELECT c.node, sum(mu) AS mutations, sum(dms) AS dms, sum(abs(s_acctbal)) AS lbi FROM c JOIN rr ON rr.node = c.ancestor JOIN supplier ON s_suppkey + 1 = c.ancestor GROUP BY 1)
SELECT node, (ep - ne)::DOUBLE AS ep_excess, ne::DOUBLE AS ne, mutations::DOUBLE AS mutations, round(pp.dms, 5) AS dms, round(lbi, 2) AS cum_lbi, round(ln(greatest((node % 11) / 100.0, 1e-6)), 6) AS log_freq FROM rr JOIN pp USING (node)""")
def predictors_by_name(spark, sf):
    """Six predictors, one of which needs another two, from one climb of the tree."""
    edges, seqs, _ = _sequences(spark, sf)
    nodes = edges.select("node", F.abs("s_acctbal").alias("lbi"), ((F.col("node") % 11) / 100.0).alias("frequency"))
    inputs = N.Inputs(edges, seqs, nodes, _MASK, values(spark, "site int, aa string, preference double", *_PREFERENCES))
    out = N.compute(["ep_excess", "ne", "mutations", "dms", "cum_lbi", "log_freq"], inputs)
    whole = [F.col(c).cast("double").alias(c) for c in ("ep_excess", "ne", "mutations")]
    return out.select("node", *whole, *R("dms", digits=5), *R("cum_lbi", digits=2), *R("log_freq", digits=6))


# -- files written and read back ----------------------------------------------------------------------------------


def _documents(df, bucket, path):
    """JSON documents (bucket, value), a file each."""
    df.select(bucket, "value").write.mode("overwrite").partitionBy(bucket).text(path)
    return path


def _json_map(entries):
    """A JSON object of an array of (key, JSON text) structs, in the order of keys."""
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(entries), lambda x: F.concat(F.to_json(F.struct(x["k"].cast("string").alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(x["k"].cast("string").alias("k")))) - 6), F.lit(":"), x["v"])), ","), F.lit("}"))


@query("SELECT replace(c_name, '#', '-') AS item FROM customer")
def item_list(spark, sf):
    """A list of one item a line with comments and empty lines."""
    path = _folder(spark, "items")
    k, name = F.col("c_custkey") % 3, F.replace("c_name", F.lit("#"), F.lit("-"))
    lines = F.when(k == 0, F.concat(name, F.lit("  # of old"))).when(k == 1, F.concat(F.lit(" "), name)).otherwise(name)
    both = read(spark, sf, "customer").select(F.explode(F.array(lines, F.when(k == 2, "# nothing").otherwise(""))).alias("value"))
    both.write.mode("overwrite").text(path)
    return IO.read_items(spark, path)


@query("""WITH q AS (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), k AS (SELECT DISTINCT l_suppkey FROM lineitem)
SELECT concat('s', k.l_suppkey) AS node, i::BIGINT AS pivot_idx, 2000 + i / 4 AS pivot, coalesce(q, 0)::DOUBLE AS frequency FROM k, range(0, 7) r(i) LEFT JOIN q ON q.l_suppkey = k.l_suppkey AND q.l_linenumber = i + 1""")
def frequencies_round_trip(spark, sf):
    sums = read(spark, sf, "lineitem").groupBy("l_suppkey").pivot("l_linenumber", list(range(1, 8))).agg(F.sum("l_quantity")).fillna(0)
    values_ = F.to_json(F.struct(F.array(*[F.col(str(i)).cast("double") for i in range(1, 8)]).alias("frequencies")))
    entry = F.struct(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("k"), values_.alias("v"))
    pivots = F.struct(F.lit("pivots").alias("k"), F.lit("[" + ",".join(str(2000 + i / 4) for i in range(7)) + "]").alias("v"))
    docs = sums.groupBy(F.floor(F.col("l_suppkey") / 1000).alias("bucket")).agg(_json_map(F.concat(F.array(pivots), F.collect_list(entry))).alias("value"))
    return IO.read_frequencies(spark, _documents(docs, "bucket", _folder(spark, "frequencies"))).select("node", *L("pivot_idx"), "pivot", "frequency")


@query("SELECT l_suppkey::VARCHAR AS reference, l_linenumber::VARCHAR AS test, l_returnflag AS serum, round(avg(l_tax), 4) AS log2, sum(l_quantity)::DOUBLE AS raw FROM lineitem GROUP BY ALL")
def titer_model_round_trip(spark, sf):
    t = read(spark, sf, "lineitem").groupBy("l_suppkey", "l_linenumber", "l_returnflag").agg(F.to_json(F.array(F.round(F.avg("l_tax"), 4), F.sum("l_quantity").cast("double"))).alias("v"))
    sera = t.groupBy("l_suppkey", F.col("l_linenumber").alias("k")).agg(_json_map(F.collect_list(F.struct(F.col("l_returnflag").alias("k"), "v"))).alias("v"))
    tests = sera.groupBy(F.col("l_suppkey").alias("k")).agg(_json_map(F.collect_list(F.struct("k", "v"))).alias("v"))
    docs = tests.groupBy(F.floor(F.col("k") / 1000).alias("bucket")).agg(F.concat(F.lit('{"titers":'), _json_map(F.collect_list(F.struct("k", "v"))), F.lit("}")).alias("value"))
    return IO.read_titer_model(spark, _documents(docs, "bucket", _folder(spark, "titers"))).select("reference", "test", "serum", "log2", "raw")


@query("""SELECT 'freq' AS site, 'median' AS ps, o_orderpriority AS location, o_orderstatus AS variant, strftime(o_orderdate::DATE, '%Y-%m-01') AS date, count(*)::DOUBLE AS value FROM orders GROUP BY ALL""")
def model_results_round_trip(spark, sf):
    o = read(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("location"), F.col("o_orderstatus").alias("variant"), F.date_format(F.trunc(F.to_date("o_orderdate"), "month"), "yyyy-MM-dd").alias("date")).agg(F.count("*").cast("double").alias("value"))
    row = F.struct(F.lit("freq").alias("site"), F.lit("median").alias("ps"), "location", "variant", "date", "value")
    docs = o.groupBy(F.col("location").alias("bucket")).agg(F.to_json(F.struct(F.collect_list(row).alias("data"))).alias("value"))
    return IO.read_model_results(spark, _documents(docs, "bucket", _folder(spark, "model-results"))).select("site", "ps", "location", "variant", "date", "value")


@query("""SELECT p_brand AS map, p_type AS gene, p_size::BIGINT AS site, CASE WHEN p_size % 2 = 1 THEN 'A' END AS "from", CASE WHEN p_size % 2 = 1 THEN c END AS "to", round(CASE WHEN c = 'C' THEN avg(p_retailprice) ELSE 1 END, 2) AS weight
FROM part, (VALUES ('C'), ('T')) v(c) WHERE c = 'C' OR p_size % 2 = 1 GROUP BY p_brand, p_type, p_size, c""")
def distance_map_round_trip(spark, sf):
    """Maps of both forms: a weight a site, and a weight a substitution."""
    p = read(spark, sf, "part").groupBy("p_brand", "p_type", "p_size").agg(F.round(F.avg("p_retailprice"), 2).alias("w"))
    change = lambda to, w: F.struct(F.lit("A").alias("from"), F.lit(to).alias("to"), w.alias("weight"))
    v = F.when(F.col("p_size") % 2 == 1, F.to_json(F.array(change("C", F.col("w")), change("T", F.lit(1.0))))).otherwise(F.col("w").cast("string"))
    genes = p.groupBy("p_brand", F.col("p_type").alias("k")).agg(_json_map(F.collect_list(F.struct(F.col("p_size").alias("k"), v.alias("v")))).alias("v"))
    docs = genes.groupBy("p_brand").agg(F.concat(F.lit('{"name":"'), F.first("p_brand"), F.lit('","default":0,"map":'), _json_map(F.collect_list(F.struct("k", "v"))), F.lit("}")).alias("value")).withColumn("bucket", F.xxhash64("p_brand"))
    return IO.read_distance_map(spark, _documents(docs, "bucket", _folder(spark, "distance-maps"))).select("map", "gene", *L("site"), "from", "to", "weight")


@query("""WITH t AS (SELECT s_nationkey AS n, s_suppkey // 1000 AS b, s_suppkey AS k, row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 1000 ORDER BY s_suppkey) AS i FROM supplier)
SELECT concat('s', k) AS node, concat('n', n, '_', b) AS parent, true AS is_terminal, i::BIGINT AS preorder FROM t UNION ALL SELECT DISTINCT concat('n', n, '_', b), NULL, false, 0::BIGINT FROM t""")
def trees_round_trip(spark, sf):
    """A tree of suppliers for each nation and thousand keys, a file each, read in parallel."""
    s = read(spark, sf, "supplier").withColumn("b", F.floor(F.col("s_suppkey") / 1000))
    tips = F.array_join(F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda k: F.concat(F.lit("s"), k.cast("string"), F.lit(":0.5"))), ",")
    root = F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit("_"), F.col("b").cast("string"))
    docs = s.groupBy("s_nationkey", "b").agg(tips.alias("tips")).select(root.alias("bucket"), F.concat(F.lit("("), "tips", F.lit(")"), root, F.lit(":0;")).alias("value"))
    return IO.read_trees(spark, _documents(docs, "bucket", _folder(spark, "trees")) + "/*").select("node", "parent", "is_terminal", *L("preorder"))


@query("""WITH t AS (SELECT s_nationkey AS n, s_suppkey AS k, row_number() OVER (ORDER BY s_nationkey, s_suppkey) AS i, dense_rank() OVER (ORDER BY s_nationkey) AS g FROM supplier)
SELECT concat('s', k) AS node, concat('n', n) AS parent, true AS is_terminal, (i + g)::BIGINT AS preorder FROM t
UNION ALL SELECT DISTINCT concat('n', n), 'root', false, min(i + g - 1) OVER (PARTITION BY n)::BIGINT FROM t UNION ALL SELECT 'root', NULL, false, 0
UNION ALL SELECT 'last', 'root', true, (SELECT count(*) + count(DISTINCT n) + 1 FROM t)::BIGINT""")
def tree_by_ranges(spark, sf):
    """One tree of all suppliers below their nations, in one file, read by byte ranges."""
    s = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("n"), F.col("s_suppkey").alias("k"))
    ends = s.groupBy("n").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    opening = F.concat(F.when(F.col("n") == s.agg(F.min("n")).scalar(), "((").otherwise("("), F.lit("s"), F.col("k").cast("string"))
    name = F.when(F.col("k") == F.col("lo"), opening).otherwise(F.concat(F.lit("s"), F.col("k").cast("string")))
    line = F.concat(name, F.when(F.col("k") == F.col("hi"), F.concat(F.lit(":1)n"), F.col("n").cast("string"), F.lit(":0.5,"))).otherwise(","))
    lines = s.join(ends, "n").select("n", "k", line.alias("value")).union(spark.sql("SELECT cast(9e15 as long), 0L, 'last)root;'"))
    path = _folder(spark, "tree")
    lines.orderBy("n", "k").select("value").coalesce(1).write.mode("overwrite").text(path)
    return IO.read_tree(spark, path).select("node", "parent", "is_terminal", "preorder")


@query(f"""WITH {_CLOSURE}, t AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL)), k AS (SELECT DISTINCT ancestor AS node FROM c WHERE node IN (SELECT node FROM t WHERE node % 3 <> 0))
SELECT tree, node FROM k, (VALUES ('whole'), ('thinned')) v(tree)""")
def prune_to_common(spark, sf):
    """A tree and one that lacks a third of the tips, both cut down to the tips of both."""
    whole = _tree(spark, sf)
    thinned = whole.where("not is_terminal or node % 3 <> 0")
    x, y = T.prune_to_common([(e, T.closure(e)) for e in (whole, thinned)])
    return x.select(F.lit("whole").alias("tree"), "node").union(y.select(F.lit("thinned").alias("tree"), "node"))


# -- reports and tables that other operators lean on --------------------------------------------------------------


@query("SELECT c_custkey, 'c_mktsegment' AS field, c_mktsegment AS value FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 20 = 0")
def unnecessary_annotations(spark, sf):
    """Overrides that repeat what the record says."""
    df = read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    notes = df.where("c_custkey % 10 = 0").select("c_custkey", F.lit("c_mktsegment").alias("field"), F.when(F.col("c_custkey") % 20 == 0, F.col("c_mktsegment")).otherwise("FIXED").alias("value"))
    return J.unnecessary_annotations(df, notes, "c_custkey").select("c_custkey", "field", "value")


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r > 1")
def dropped_duplicates(spark, sf):
    return W.dropped_duplicates(read(spark, sf, "events"), "user_id", "event_id", ["ts", "event_id"]).select("event_id", "user_id")


@query("SELECT o_orderkey, o_orderdate::DATE AS d FROM orders")
def decimal_years(spark, sf):
    """Dates to decimal years and back."""
    return read(spark, sf, "orders").select("o_orderkey", S.from_decimal_year(S.to_decimal_year(F.to_date("o_orderdate"))).alias("d"))


@query("""WITH k AS (SELECT c_custkey, c_custkey % 24 AS h, c_custkey // 24 % 14 AS n FROM customer)
SELECT c_custkey, CASE WHEN h = 20 THEN 'b' WHEN h > 20 OR (h = 0 AND n = 0) OR n > 11 THEN 'tbd' ELSE 'a' END AS type, CASE WHEN h = 20 THEN CASE WHEN n % 2 = 0 THEN 'vic' ELSE 'n/a' END WHEN h > 20 OR (h = 0 AND n = 0) OR n > 11 THEN 'tbd' WHEN h = 1 AND n = 1 THEN 'h1n1pdm' ELSE concat(CASE WHEN h > 0 THEN concat('h', h) ELSE '' END, CASE WHEN n > 0 THEN concat('n', n) ELSE '' END) END AS standard_lineage FROM k""")
def lineage_dimension(spark, sf):
    """Lineages by the generated table of subtypes, with those it doesn't know."""
    h, n = F.col("c_custkey") % 24, F.floor(F.col("c_custkey") / 24) % 14
    subtype = F.when(h == 20, "B").otherwise(F.concat(F.lit("A / "), F.when(h > 0, F.concat(F.lit("H"), h.cast("string"))).otherwise(""), F.when(n > 0, F.concat(F.lit("N"), n.cast("string"))).otherwise("")))
    lineage = F.when((h == 20) & (n % 2 == 0), "Victoria").when((h == 1) & (n == 1), "pdm09").otherwise("")
    df = read(spark, sf, "customer").select("c_custkey", subtype.alias("s"), lineage.alias("l"))
    return J.map_lineage(df, "s", "l", F.lit(""), J.lineage_dimension(spark)).select("c_custkey", "type", "standard_lineage")
