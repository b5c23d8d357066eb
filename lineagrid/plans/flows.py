"""Registered queries of the streams: tables fed in three parts, each to a stream that starts again where it ended."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lineagrid.plans.catalog import L, query, read
from lineagrid.plans.records import _folder
from lineagrid.streaming import streams

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _fed(spark, name, parts, run):
    """Each part is appended to a folder and the stream run over what is new; the folder of the results."""
    folder = _folder(spark, f"{name}-{uuid.uuid4().hex}")
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = streams.stream_batches(spark, f"{folder}/in", part.schema, per_trigger=1_000_000)
        run(stream, folder).awaitTermination()
    return folder


def _thirds(df):
    return [df.where(F.pmod("event_id", F.lit(3)) == k) for k in range(3)]


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, event_id) = 1")
def stream_upsert(spark, sf):
    """The first record of each user, by part and then by number."""
    rows = read(spark, sf, "events").select("user_id", "event_id", "event_type")
    folder = _fed(spark, "upsert", _thirds(rows), lambda s, f: streams.upsert_first(s, f"{f}/out", "user_id", ["event_id"], f"{f}/checkpoint"))
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_id", "event_type")


@query("SELECT event_id % 3 AS number, count(*)::BIGINT AS records FROM events GROUP BY 1")
def stream_deltas(spark, sf):
    """How many records each part brought."""
    rows = read(spark, sf, "events").select("event_id", "event_type")
    folder = _fed(spark, "deltas", _thirds(rows), lambda s, f: streams.record_delta(s, f"{f}/out", f"{f}/checkpoint"))
    return spark.read.parquet(f"{folder}/out").select(*L("number"), "records")


def _appended(df, f):
    return df.writeStream.format("parquet").option("path", f"{f}/out").option("checkpointLocation", f"{f}/checkpoint").trigger(availableNow=True).start()


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, event_id) = 1")
def stream_first_seen(spark, sf):
    """The first row of each user as a keyed processor sees it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = read(spark, sf, "events").select("user_id", "event_id")
    folder = _fed(spark, "first", _thirds(rows), lambda s, f: _appended(streams.stream_first_seen(s, "user_id"), f))
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_id")


_LATE = "o_orderkey % 29 = 0 AND o_orderdate::DATE < DATE '1995-01-01'"
_STREAMED = """(SELECT o_orderpriority AS k, date_trunc('month', o_orderdate::DATE)::DATE AS m, count(*) AS n FROM orders WHERE {} GROUP BY ALL)"""


@query(f"""WITH c AS {_STREAMED.format(f"NOT ({_LATE})")}, g AS (SELECT k, unnest(generate_series(min(m)::TIMESTAMP, max(m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM c GROUP BY k)
SELECT k AS o_orderpriority, m AS month, coalesce(n, 0)::BIGINT AS n, false AS late FROM g LEFT JOIN c USING (k, m) UNION ALL SELECT k, m, n::BIGINT, true FROM {_STREAMED.format(_LATE)}""")
def stream_monthly(spark, sf):
    """Orders a month and priority as their months end, empty months too; a part that comes when they have ended is late."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = read(spark, sf, "orders").select("o_orderpriority", F.to_timestamp(F.to_date("o_orderdate")).alias("ts"), (F.expr("o_orderkey % 29 = 0") & (F.to_date("o_orderdate") < F.lit("1995-01-01").cast("date"))).alias("_late"))
    after = rows.agg(F.add_months(F.max("ts"), 3).cast("timestamp").alias("ts")).select(F.lit(None).cast("string").alias("o_orderpriority"), "ts")
    parts = [rows.where("not _late").drop("_late"), after, rows.where("_late").drop("_late")]
    folder = _fed(spark, "monthly", parts, lambda s, f: _appended(streams.stream_monthly_counts(s, "ts", ["o_orderpriority"], "10 days"), f))
    return spark.read.parquet(f"{folder}/out").where("o_orderpriority is not null").select("o_orderpriority", "month", "n", "late")
