"""Token counts kept up to date by signed changes.

A store is a folder of committed batches, ``batch=<id>``, each a small table of signed sums by source, language and
tokenizer version.  Committing a batch sums the signs of its changes (map-side first), writes the sums aside and renames
them into place, which fails where the folder is there already: of two writers of one batch, one commits.  So a batch that is delivered again, or retried
after a crash, counts once.  Totals are sums over all batches: inserts, deletes and revised counts rewrite nothing.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACE

#: Vocabulary files of public tokenizers by version name; rank files of byte-level BPE.
TOKENIZERS = {"byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken"}
#: Fixed: how these vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer"]


def word_tokens(text: Column) -> Column:
    """The tokenizer version ``words``: runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def count_tokens(docs: DataFrame, texts: list[str], path: str) -> DataFrame:
    """docs with each of the columns ``texts`` replaced by its number of tokens (null: null) under the rank file at path.

    The driver reads the vocabulary, whose size is fixed, and sends it to the tasks.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=sent.value, special_tokens={})
        for batch in batches:
            columns = list(batch.columns)
            for name in texts:
                i = batch.schema.get_field_index(name)
                counts = [None if (t := x.as_py()) is None else len(encoding.encode_ordinary(t)) for x in columns[i]]
                columns[i] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    schema = docs.withColumns({t: F.lit(None).cast("long") for t in texts}).schema
    return docs.mapInArrow(run, schema)


def signed(changes: DataFrame) -> DataFrame:
    """Sums of n_docs and n_tokens by source, lang and tokenizer of changes (op, source, lang, tokenizer, n_tokens, old_tokens).

    An insert adds a document and its tokens, a delete takes both away, a revision adds the difference of its tokens.
    Null counts are 0; null sources and languages are groups of their own; an unknown op is an error.
    """
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))).cast("int"))
    tokens = F.when(F.col("op") == "revise", new - old).otherwise(sign * new)
    return changes.groupBy(*KEYS).agg(F.sum(sign.cast("long")).alias("n_docs"), F.sum(tokens.cast("long")).alias("n_tokens"))


def commit(changes: DataFrame, store: str, batch_id: str) -> bool:
    """Commit a batch of changes; False, and nothing done, if this batch is there already.

    Sums are written aside and renamed without overwriting, so that readers see a whole batch or none.  On a file system
    whose renames are atomic (HDFS, local disks) a batch counts once whatever number of writers commit it at a time.
    """
    if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    spark = changes.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(f"{store}/batch={batch_id}")
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(target):
        return False
    aside = f"{store}/_aside/{batch_id}-{uuid.uuid4().hex}"
    signed(changes).write.parquet(aside)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), fs.getConf())
    no_overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    no_overwrite[0] = getattr(spark._jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(fs.makeQualified(path(aside)), fs.makeQualified(target), no_overwrite)
    except Py4JJavaError:
        fs.delete(path(aside), True)
        if fs.exists(target):
            return False
        raise
    return True


def totals(spark: SparkSession, store: str) -> DataFrame:
    """n_docs and n_tokens by source, lang and tokenizer over all committed batches; groups with neither are left out."""
    schema = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string"
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return spark.createDataFrame([], schema).drop("batch")
    sums = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(store).groupBy(*KEYS)
    return sums.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
