"""Structured Streaming: deduplicated intake, the ten-minute track and sight segments.

Late data beyond the watermark is left to the batch rebuild, which accepts it without limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewake.config import DEFAULT, Config
from tidewake.functions.classify import reading
from tidewake.operators import silver
from tidewake.operators.store import Warehouse, finish_routing, route, routed
from tidewake.schemas import RAW, SILVER, conform


def raw_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RAW).parquet(path)


def deduplicated(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Reports without repeats of (mmsi, msgtime) within the watermark."""
    timed = stream.withColumn("event_time", F.col("msgtime").cast("timestamp")).withWatermark("event_time", late)
    return timed.dropDuplicatesWithinWatermark(["mmsi", "msgtime"])


def track_stream(stream: DataFrame, late: str = "1 hour", slot: str = "10 minutes") -> DataFrame:
    timed = stream.withColumn("event_time", F.col("msgtime").cast("timestamp")).withWatermark("event_time", late)
    fields = ("latitude", "longitude", "speedOverGround")
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("event_time"))).alias(f) for f in fields]
    return timed.groupBy("mmsi", F.window("event_time", slot)).agg(F.max("event_time").alias("message_time"), *last).select("mmsi", F.col("window.start").alias("slot_start"), "message_time", *fields)


def sight_segments(stream: DataFrame, late: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    """mmsi, start, end, n of stretches without a gap over the limit."""
    timed = stream.withColumn("event_time", F.col("msgtime").cast("timestamp")).withWatermark("event_time", late)
    s = timed.groupBy("mmsi", F.session_window("event_time", gap).alias("s")).agg(F.min("event_time").alias("start"), F.max("event_time").alias("end"), F.count("*").alias("n"))
    return s.select("mmsi", "start", "end", "n")


CHANGES = "mmsi int, state string, start timestamp, end timestamp, n_readings long"


def state_changes(stream: DataFrame, c: Config = DEFAULT, late: str = "1 hour") -> DataFrame:
    """mmsi, state, start, end, n_readings of each run of a state that has ended: per-ship state that outlives a restart.

    Within a micro-batch a ship's readings are taken in order; one older than what the ship's state has seen is left to the batch rebuild.
    A run ends with another state or a gap; the state holds the run under way, a row a ship.
    """
    timed = stream.withColumn("event_time", F.col("msgtime").cast("timestamp")).withWatermark("event_time", late)
    state = reading(F.col("speedOverGround").cast("double"), F.col("navigationalStatus"), c)["state"].alias("state")
    classed = timed.filter("mmsi IS NOT NULL AND event_time IS NOT NULL").select("mmsi", "event_time", state)
    gap = pd.Timedelta(minutes=c.max_gap_minutes)

    def step(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.get if held.exists else None
        ended = []
        rows = pd.concat(list(frames)).sort_values(["event_time", "state"])
        for at, name in zip(rows["event_time"], rows["state"]):
            if now is None:
                now = (name, at, at, 1)
            elif at > now[2]:
                if name == now[0] and at - now[2] <= gap:
                    now = (name, now[1], at, now[3] + 1)
                else:
                    ended.append((key[0], *now))
                    now = (name, at, at, 1)
        if now is not None:
            held.update(now)
        yield pd.DataFrame(ended, columns=["mmsi", "state", "start", "end", "n_readings"])

    return classed.groupBy("mmsi").applyInPandasWithState(step, CHANGES, "state string, start timestamp, end timestamp, n_readings long", "append", GroupStateTimeout.NoTimeout)


#: State lies on the executors' disks, not in their heaps; an executor's stores share so much memory.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def drained(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream of aggregates over all that is there now; its whole result is stored at ``path`` and read from there.

    The executors write the files, so the result may be larger than the driver's memory.  A batch that is retried, or a later one, replaces what
    was there by the whole result.  Without input the table is empty.
    """
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.mode("ignore").parquet(path)
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)  # the query keeps the settings it was started with
        run = df.writeStream.foreachBatch(lambda out, _: out.write.mode("overwrite").parquet(path)).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def silver_stream(stream: DataFrame, house: Warehouse, checkpoint: str, as_of: datetime | None = None) -> StreamingQuery:
    """Validate each micro-batch against what was accepted before, and append both outcomes, once: a batch that is retried is known by its label."""
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def batch(df: DataFrame, number: int) -> None:
        when, label = as_of or datetime.now(timezone.utc).replace(tzinfo=None), f"stream-{name}-{number}"
        finish_routing(house)
        if not routed(house, label):
            route(house, silver.staged(conform(df, RAW), when, house.read("silver", SILVER)), label)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
