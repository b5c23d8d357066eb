"""Readers and writers of the file formats of surveillance data."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_own: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The shared folder that the session names for its own tables; one of our own only where all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("a cluster needs spark.checkpoint.dir: a folder that its executors share")
        named = _own[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lineagrid-")
    return named.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder: its lineage ends there, and a lost executor costs none of its work."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark))
    return df.checkpoint()


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, description, seq) with upper-cased sequences; files are split at ``>``."""
    rows = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    return rows.select(F.regexp_extract(head, r"^(\S+)", 1).alias("id"), head.alias("description"), F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", "")).alias("seq"))


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str, sep: str = "\t", comment: str | None = "#") -> DataFrame:
    """A table with a header, all columns text, empty cells empty."""
    reader = spark.read.option("sep", sep).option("header", True).option("nullValue", "\u0000").option("emptyValue", "")
    df = (reader.option("comment", comment) if comment else reader).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One item a line, what follows ``#`` left out."""
    return spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("item")).where("item <> ''")


def _whole(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)


def read_node_data(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(node, attributes) of node-data JSON files; attribute values as text."""
    nodes = F.from_json("value", "nodes map<string,map<string,string>>")["nodes"]
    return _whole(spark, paths).select(F.explode(nodes).alias("node", "attributes"))


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """(node, pivot_idx, pivot, frequency) of a frequencies JSON."""
    pivots = F.from_json("value", "pivots array<double>")["pivots"]
    entries = F.from_json("value", "map<string,string>")
    rows = _whole(spark, path).select(pivots.alias("p"), F.explode(F.map_filter(entries, lambda k, v: v.startswith("{"))).alias("node", "v"))
    return rows.select("node", F.posexplode(F.arrays_zip("p", F.from_json("v", "frequencies array<double>")["frequencies"].alias("f"))).alias("pivot_idx", "x")).select("node", "pivot_idx", F.col("x.p").alias("pivot"), F.col("x.f").alias("frequency"))


def read_titer_model(spark: SparkSession, path: str) -> DataFrame:
    """(reference, test, serum, log2, raw) of nested titers."""
    titers = F.from_json("value", "titers map<string,map<string,map<string,array<double>>>>")["titers"]
    a = _whole(spark, path).select(F.explode(titers).alias("reference", "x")).select("reference", F.explode("x").alias("test", "y")).select("reference", "test", F.explode("y").alias("serum", "v"))
    return a.select("reference", "test", "serum", F.get("v", F.lit(0)).alias("log2"), F.get("v", F.lit(1)).alias("raw"))


def read_model_results(spark: SparkSession, path: str) -> DataFrame:
    """The long records of model-result JSON."""
    data = F.from_json("value", "data array<struct<site:string,ps:string,location:string,variant:string,date:string,value:double>>")["data"]
    return _whole(spark, path).select(F.explode(data).alias("x")).select("x.*")


def read_distance_map(spark: SparkSession, path: str) -> DataFrame:
    """(map, gene, site, from, to, weight); from and to are null where a site has one weight for all."""
    rows = _whole(spark, path).select(F.from_json("value", "name string, `default` double, map map<string,map<string,string>>").alias("j"))
    sites = rows.select(F.col("j.name").alias("map"), F.explode("j.map").alias("gene", "s")).select("map", "gene", F.explode("s").alias("site", "v"))
    plain = sites.where(~F.col("v").startswith("[")).select("map", "gene", F.col("site").cast("int").alias("site"), F.lit(None).cast("string").alias("from"), F.lit(None).cast("string").alias("to"), F.col("v").cast("double").alias("weight"))
    pairs = sites.where(F.col("v").startswith("[")).select("map", "gene", F.col("site").cast("int").alias("site"), F.explode(F.from_json("v", "array<struct<`from`:string,`to`:string,weight:double>>")).alias("x"))
    return plain.union(pairs.select("map", "gene", "site", "x.from", "x.to", "x.weight"))


def newick_edges(text: str) -> list[tuple[str, str | None, bool, int]]:
    """(node, parent, is_terminal, preorder) of one tree; unnamed inner nodes are numbered in preorder."""
    nodes: list[list] = [["", None, True]]
    here, name, i = 0, "", 0
    while i < len(text):
        ch = text[i]
        if ch == "(":
            nodes[here][2] = False
            nodes.append(["", here, True])
            here = len(nodes) - 1
        elif ch in ",)":
            parent = nodes[here][1]
            if ch == ",":
                nodes.append(["", parent, True])
                here = len(nodes) - 1
            else:
                here = parent
        elif ch == ":":
            while i + 1 < len(text) and text[i + 1] not in ",();":
                i += 1
        elif ch == "'":
            end = text.index("'", i + 1)
            nodes[here][0], i = text[i + 1 : end], end
        elif ch == "[":
            i = text.index("]", i)
        elif ch == ";":
            break
        elif not ch.isspace():
            start = i
            while i + 1 < len(text) and text[i + 1] not in ",():;[":
                i += 1
            name = text[start : i + 1].strip()
            nodes[here][0] = name
        i += 1
    names = [n or f"NODE_{k:07d}" for k, (n, _, _) in enumerate(nodes)]
    return [(names[k], None if p is None else names[p], t, k) for k, (_, p, t) in enumerate(nodes)]


def read_trees(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(tree_id, node, parent, is_terminal, preorder) of many Newick files, one tree each; trees are read in parallel."""
    def edges(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(tree, *e) for tree, text in zip(part["tree_id"], part["value"], strict=True) for e in newick_edges(text)]
            yield pd.DataFrame(rows, columns=["tree_id", "node", "parent", "is_terminal", "preorder"])

    files = _whole(spark, paths).select(F.input_file_name().alias("tree_id"), "value")
    return files.mapInPandas(edges, "tree_id string, node string, parent string, is_terminal boolean, preorder long")


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """(node, parent, is_terminal, preorder) of one Newick file of any size, read by byte ranges in many tasks.

    For names and comments without commas and brackets; :func:`read_trees` takes any.  The text is cut at commas.  A piece
    opens groups, names a tip and closes groups, so running sums over pieces give depths and preorder: within a byte
    range, plus what the ranges before it sum to.  The group that a node lies in, and the one that a closing bracket
    names, is the last opened at the depth above; it is looked up among the rows of that depth.
    """
    raw = spark.read.option("lineSep", ",").text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    text = F.regexp_replace("value", r"\[[^\]]*\]|[\r\n\t]|;\s*$", "")
    opens = F.length(F.replace(F.regexp_extract(text, r"^[ (]*", 0), F.lit(" "), F.lit("")))
    labels = F.transform(F.split(F.regexp_replace(text, r"^[ (]*", ""), r"\)"), lambda x: F.trim(F.replace(F.split_part(x, F.lit(":"), F.lit(1)), F.lit("'"), F.lit(""))))
    pieces = checkpointed(raw.select("block", "id", opens.alias("o"), labels.alias("labels")).withColumn("c", F.size("labels") - 1))
    ranges = pieces.groupBy("block").agg(F.sum(F.col("o") - F.col("c")).alias("rise"), F.sum(F.col("o") + 1).alias("nodes"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a byte range
    offsets = ranges.select("block", F.coalesce(F.sum("rise").over(before), F.lit(0)).alias("d0"), F.coalesce(F.sum("nodes").over(before), F.lit(0)).alias("p0"))
    own = Window.partitionBy("block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumns({"d": F.coalesce(F.sum(F.col("o") - F.col("c")).over(own), F.lit(0)), "p": F.coalesce(F.sum(F.col("o") + 1).over(own), F.lit(0))})
    placed = placed.join(offsets, "block").select("o", "c", "labels", (F.col("d") + F.col("d0")).alias("d"), (F.col("p") + F.col("p0")).alias("p"))
    # Rows by the depth of the group they ask for: groups opened there, then what lies in them, then their closing names.
    group = lambda i: F.struct((F.col("d") + i).alias("depth"), (F.col("p") + i).alias("pre"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("name"))
    inner = F.transform(F.sequence(F.lit(1), F.col("o")), lambda i: F.struct((F.col("d") + i - 2).alias("depth"), (F.col("p") + i - 1).alias("pre"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("name")))
    opened = F.transform(F.sequence(F.lit(1), F.col("o")), lambda i: group(i - 1))
    tip = F.struct((F.col("d") + F.col("o") - 1).alias("depth"), (F.col("p") + F.col("o")).alias("pre"), F.lit(2).alias("kind"), F.get("labels", F.lit(0)).alias("name"))
    closed = F.transform(F.sequence(F.lit(1), F.col("c")), lambda m: F.struct((F.col("d") + F.col("o") - m).alias("depth"), (F.col("p") + F.col("o")).alias("pre"), F.lit(3).alias("kind"), F.get("labels", m).alias("name")))
    none = F.slice(F.array(tip), F.lit(1), F.lit(0))
    rows = placed.select(F.explode(F.concat(F.when(F.col("o") > 0, F.concat(opened, inner)).otherwise(none), F.array(tip), F.when(F.col("c") > 0, closed).otherwise(none))).alias("x")).select("x.*")
    # A group opened at a place is known to what lies deeper at the same place, not to itself.
    order = Window.partitionBy("depth").orderBy("pre", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("up", F.last(F.when(F.col("kind") == 0, F.col("pre")), ignorenulls=True).over(order))
    names = found.where("kind = 3").select(F.col("up").alias("pre"), "name")
    nodes = found.where("kind in (1, 2)").select("pre", "up", (F.col("kind") == 2).alias("is_terminal"), F.col("name").alias("tip"))
    named = nodes.join(names, "pre", "left").select("pre", "up", "is_terminal", F.coalesce(F.nullif(F.coalesce("tip", "name"), F.lit("")), F.format_string("NODE_%07d", F.col("pre"))).alias("node"))
    named = checkpointed(named)
    return named.join(named.select(F.col("pre").alias("up"), F.col("node").alias("parent")), "up", "left").select("node", "parent", "is_terminal", F.col("pre").cast("long").alias("preorder"))


def write_fasta(df: DataFrame, folder: str, key: str = "id", seq: str = "seq", partition: str = "segment") -> None:
    df.select(partition, F.concat(F.lit(">"), F.col(key), F.lit("\n"), F.col(seq)).alias("value")).write.mode("overwrite").partitionBy(partition).text(folder)


def write_table(df: DataFrame, path: str, na_rep: str = "", float_format: str | None = None) -> None:
    """Delimited text; doubles by a printf format if given."""
    shown = [F.format_string(float_format, F.col(f.name)).alias(f.name) if float_format and f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema]
    df.select(*shown).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", na_rep).csv(path)


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def to_node_data(df: DataFrame, key: str) -> DataFrame:
    """(node, json) lines of the other columns."""
    return df.select(F.col(key).alias("node"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("json"))


def union_batches(tables: Sequence[DataFrame]) -> DataFrame:
    """Batches in order of priority with batch_rank, 0 first; missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("batch_rank", F.lit(i)) for i, df in enumerate(tables)])


def append_tables(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)
