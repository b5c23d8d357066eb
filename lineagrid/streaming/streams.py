"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from lineagrid.operators.fingerprints import fingerprint


def stream_batches(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """Files of a folder, each read once; the query's checkpoint remembers which."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(folder)


#: Bits of a bucket's Bloom filter; with two bits a key, 5,000 keys a bucket let 7 % of new keys through to a lookup.
FILTER_BITS = 1 << 15


def _positions(key: str) -> list[Column]:
    """The places of a key's bits in its bucket's filter."""
    return [F.pmod(F.xxhash64(F.lit(seed), key), F.lit(FILTER_BITS)) for seed in (11, 12)]


def _has_bit(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def _filters(rows: DataFrame, key: str) -> DataFrame:
    """(bucket, bits) of the keys in rows (bucket, key)."""
    bits = rows.select("bucket", F.explode(F.array(*_positions(key))).alias("_p"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("_p").alias("bits"))


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches whose table in the folder is complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return []
    found = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("batch=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def upsert_first(stream: DataFrame, target: str, key: str, order: Sequence[str], checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Append to the table at ``target`` the first record of each key that it doesn't have, of equal keys in a batch the
    first by ``order``; null keys are one key.

    The table lies in folders by batch and by bucket of the key's hash (columns ``batch`` and ``bucket`` on reading), with
    a Bloom filter a bucket beside it.  A batch asks the filters first, and then reads the keys of only those buckets in
    which one of its keys may be known.  Batch folders are overwritten by a replay, which takes no account of what was
    written under its own number or later ones.
    """
    def write(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        one = df.groupBy(key).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("x")).select("x.*")
        first = one.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        state = f"{target}/_filters"
        before = [n for n in _versions(spark, state) if n < number]
        fresh, old = first, None
        if before:
            old = spark.read.schema("bucket int, bits binary").parquet(f"{state}/batch={before[-1]}")
            asked = first.join(old, "bucket", "left").withColumn("_maybe", F.coalesce(_has_bit(F.col("bits"), _positions(key)[0]) & _has_bit(F.col("bits"), _positions(key)[1]), F.lit(False))).drop("bits")
            hit = [r.bucket for r in asked.where("_maybe").select("bucket").distinct().collect()]  # no more than there are buckets
            if hit:
                kind = first.schema[key].dataType.simpleString()
                known = spark.read.schema(f"`{key}` {kind}, batch int, bucket int").option("basePath", target).parquet(*[f"{target}/batch={n}" for n in before])
                known = known.where(F.col("bucket").isin(hit) & (F.col("batch") < number)).select(F.col(key).alias("_known"))
                asked = asked.join(known, asked[key].eqNullSafe(F.col("_known")), "left_anti")
            fresh = asked.select(*first.columns)
        fresh = fresh.persist()
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch={number}")
        filters = _filters(fresh, key)
        if old is not None:
            filters = filters.union(old).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        filters.coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={number}")
        fresh.unpersist()
        first.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_within(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """One row of each key, forgotten when the watermark (``late`` behind) has passed it; a key that comes later is new."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def record_delta(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """A row a batch: its number, records and checksum, under ``target``; a replay overwrites its own row."""
    def write(df: DataFrame, number: int) -> None:
        fingerprint(df).withColumn("number", F.lit(number)).coalesce(1).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_counts(stream: DataFrame, ts: str, width: str, keys: Sequence[str], late: str) -> DataFrame:
    """Tumbling counts per key; rows later than the watermark are dropped."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


class MonthlyCounts(StatefulProcessor):
    """Counts per key and month; a month is emitted when the watermark passes its end, with months of 0 since the one before."""

    def __init__(self, keys: Sequence[str]) -> None:
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "month int", "n long")
        self.last = handle.getValueState("last", "month int")

    def _rows(self, key, months: list[int], counts: list[int], late: bool) -> pd.DataFrame:  # noqa: ANN001
        return pd.DataFrame({k: [v] * len(months) for k, v in zip(self.keys, key, strict=True)} | {"month": months, "n": counts, "late": late})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        watermark, late = timerValues.getCurrentWatermarkInMs(), {}
        for part in rows:
            for (month, end), n in part.groupby(["month", "end"]).size().items():
                if end <= watermark:
                    late[int(month)] = late.get(int(month), 0) + int(n)
                    continue
                known = self.open.containsKey((int(month),))
                self.open.updateValue((int(month),), ((self.open.getValue((int(month),))[0] if known else 0) + int(n),))
                if not known:
                    self.handle.registerTimer(int(end))
        if late:
            yield self._rows(key, list(late), list(late.values()), True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        # Timers of one key may fire in any order: all months that end by this one are closed.
        fired = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        closed = sorted(m for (m,) in self.open.keys() if m < 12 * fired.year + fired.month - 1)
        if not closed:
            return
        months, counts = [], []
        last = self.last.get()[0] if self.last.exists() else closed[0] - 1
        for m in closed:
            months += range(last + 1, m + 1)
            counts += [0] * (m - last - 1) + [self.open.getValue((m,))[0]]
            last = m
            self.open.removeKey((m,))
        self.last.update((last,))
        yield self._rows(key, months, counts, False)

    def close(self) -> None:
        pass


def stream_monthly_counts(stream: DataFrame, ts: str, keys: Sequence[str], late: str) -> DataFrame:
    """(keys, month, n, late): each key's counts a month, 0 in months between its first and last without rows.

    A month comes once, when the watermark (``late`` behind the latest time seen) has passed its end.  Rows of months that
    have ended by then come as counts marked ``late``.  A key holds its open months and the last one emitted.  Months are
    those of the session's time zone, which is to be UTC; needs the RocksDB state store.
    """
    month = F.col("_t")
    rows = stream.withWatermark(ts, late).withColumn("_t", F.date_trunc("month", ts))
    # Neither column is the one with the watermark, so Spark leaves late rows to the processor.
    rows = rows.select(*keys, (12 * F.year(month) + F.month(month) - 1).cast("int").alias("month"), F.unix_millis(F.add_months(month, 1).cast("timestamp")).alias("end"))
    fields = [rows.schema[k] for k in keys]
    out = StructType([*fields, StructField("month", IntegerType()), StructField("n", LongType()), StructField("late", BooleanType())])
    counts = rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=MonthlyCounts(keys), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return counts.withColumn("month", F.make_date(F.floor(F.col("month") / 12).cast("int"), (F.col("month") % 12 + 1).cast("int"), F.lit(1)))


def write_monthly_counts(counts: DataFrame, target: str, late_target: str, checkpoint: str) -> StreamingQuery:
    """Counts to one table and late ones to another, each in folders by batch that a replay overwrites."""
    def write(df: DataFrame, number: int) -> None:
        both = df.persist()
        for side, path in ((~F.col("late"), target), (F.col("late"), late_target)):
            both.where(side).drop("late").write.mode("overwrite").parquet(f"{path}/batch={number}")
        both.unpersist()

    return counts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class FirstSeen(StatefulProcessor):
    """Keeps, per key, that a row has been emitted, until the watermark is ``keep`` past the key's latest row."""

    def __init__(self, ts: str | None = None, keep: int | None = None) -> None:
        self.ts, self.keep = ts, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        first, latest = None, 0
        for part in rows:
            if self.ts:
                latest = max(latest, int(part[self.ts].max().timestamp() * 1000))
            part = part.sort_values(list(part.columns), kind="stable").head(1)
            first = part if first is None else pd.concat([first, part]).sort_values(list(part.columns), kind="stable").head(1)
        if first is None:
            return
        known = self.seen.exists()
        until = latest + (self.keep or 0)
        if known and self.keep is not None:
            # Timers fire after a batch's rows: a key that is due is forgotten here.
            old = self.seen.get()[0]
            known = old > timerValues.getCurrentWatermarkInMs()
            until = max(until, old) if known else until
            if until != old:
                self.handle.deleteTimer(old)
        self.seen.update((until,))
        if self.keep is not None:
            self.handle.registerTimer(until)
        if not known:
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_first_seen(stream: DataFrame, key: str, ts: str | None = None, late: str | None = None, keep_seconds: int | None = None) -> DataFrame:
    """The first row of each key; of rows in one batch, the smallest by its columns in order.  Needs the RocksDB state store.

    With ``ts``, ``late`` and ``keep_seconds``, rows later than the watermark are dropped, and a key is forgotten once the
    watermark is ``keep_seconds`` past its latest row: the next row of the key is a first one again.
    """
    if ts is None:
        return stream.groupBy(key).transformWithStateInPandas(statefulProcessor=FirstSeen(), outputStructType=stream.schema, outputMode="Append", timeMode="None")
    rows = stream.withWatermark(ts, late)
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=FirstSeen(ts, 1000 * keep_seconds), outputStructType=stream.schema, outputMode="Append", timeMode="EventTime")
