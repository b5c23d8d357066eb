"""Helpers that the corpus operators share: intermediate tables, word expressions, table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the output contracts: a word is a run of characters other than these.
SPACE = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\f\r"


_own: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; one of our own only where all runs on one machine and none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("a cluster needs spark.checkpoint.dir: a folder that its executors share")
        app = spark.sparkContext.applicationId
        named = _own[app] = _own.get(app) or tempfile.mkdtemp(prefix="lineagrid-")
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage and outlives a lost executor."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete tables made by :func:`stored` that nothing reads any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)


def words(text: Column) -> Column:
    """The words of a text as an array (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """All rows where there are at most ``most``, else about as many, chosen by a hash of the key; marked for broadcast."""
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return F.broadcast(rows)
