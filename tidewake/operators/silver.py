"""Validation: every raw report is accepted or quarantined under the first reason that holds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.classify import first_match
from tidewake.schemas import RENAMED

KEY = ("mmsi", "msgtime")
#: Parts in which rows without a whole key are ranked first.
PARTS = 64


def newer_than(bronze: DataFrame, since: datetime | None) -> DataFrame:
    """Rows received after the watermark, a literal: the filter reaches the scan."""
    return bronze if since is None else bronze.filter(F.col("received_at") > F.lit(since))


def watermark(*tables: DataFrame) -> datetime | None:
    """The latest received_at in any of the tables."""
    tops = [t.select("received_at") for t in tables]
    both = tops[0]
    for t in tops[1:]:
        both = both.unionByName(t)
    return both.agg(F.max("received_at")).first()[0]


def rejection(as_of: Column, repeated: Column, known: Column) -> Column:
    """The reason, or null; the order of the cases is part of the meaning."""
    lat, lon, speed, mmsi, at = (F.col(c) for c in ("latitude", "longitude", "speedOverGround", "mmsi", "msgtime"))
    return first_match(
        (repeated, "duplicate"),
        (known, "duplicate"),
        (mmsi.isNull(), "missing_mmsi"),
        (~mmsi.between(100000000, 999999999), "invalid_mmsi_range"),
        (lat.isNull(), "missing_latitude"),
        (~lat.between(-90, 90), "invalid_latitude"),
        (lon.isNull(), "missing_longitude"),
        (~lon.between(-180, 180), "invalid_longitude"),
        (speed.isNull(), "missing_speed"),
        (~speed.between(0, F.lit("102.2").cast("decimal(10,2)")), "invalid_speed"),
        (at.isNull(), "missing_msgtime"),
        (at > as_of, "future_timestamp"),
    )


def staged(batch: DataFrame, as_of: datetime, silver: DataFrame | None = None) -> DataFrame:
    """``batch`` with rejection_reason.

    Copies of (mmsi, msgtime) are ranked before anything is validated, null keys as one group; ``silver`` has
    the keys known from before (mmsi, message_time), of which those within the batch's times are looked at.  One shuffle by the key serves ranking and
    look-up; rows without a whole key, which may be many, are first ranked in parts.
    """
    tie = F.concat_ws("|", *[F.col(c).cast("string") for c in ("latitude", "longitude", "speedOverGround", "courseOverGround", "navigationalStatus", "name")])
    order = [F.col("received_at").asc_nulls_last(), tie]
    whole = F.col("mmsi").isNotNull() & F.col("msgtime").isNotNull()
    ranked = batch.filter(whole).withColumn("_rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)))
    parts = batch.filter(~whole).withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)))
    parts = parts.withColumn("_rank", F.row_number().over(Window.partitionBy(*KEY, "_part").orderBy(*order))).drop("_part")
    best = parts.filter("_rank = 1").withColumn("_rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)))
    known = F.lit(False)
    if silver is not None:
        ends = batch.agg(F.min("msgtime").alias("low"), F.max("msgtime").alias("high")).first()  # literals reach the scan
        keys = silver.select("mmsi", F.col("message_time").alias("msgtime"))
        if ends["low"] is not None:
            keys = keys.filter(F.col("msgtime").between(*(F.lit(x).cast("timestamp_ntz") for x in ends)))
        ranked = ranked.join(keys.distinct().withColumn("_known", F.lit(True)), list(KEY), "left")
        known = F.coalesce(F.col("_known"), F.lit(False))
    ranked = ranked.unionByName(best, allowMissingColumns=True).unionByName(parts.filter("_rank > 1"), allowMissingColumns=True)
    out = ranked.withColumn("rejection_reason", rejection(F.lit(as_of).cast("timestamp_ntz"), F.col("_rank") != 1, known))
    return out.select(*batch.columns, "rejection_reason")


def accepted(staged_: DataFrame) -> DataFrame:
    return staged_.filter(F.col("rejection_reason").isNull()).drop("rejection_reason").withColumnsRenamed(RENAMED)


def rejected(staged_: DataFrame) -> DataFrame:
    return staged_.filter(F.col("rejection_reason").isNotNull())


def assert_conserved(bronze: int, silver: int, quarantine: int) -> None:
    if silver + quarantine != bronze:
        raise RuntimeError(f"rows were lost or made: {bronze} raw, {silver} accepted, {quarantine} quarantined")


def field_coverage(df: DataFrame) -> DataFrame:
    """field, present, total: values that are neither null nor blank."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) for c in df.columns])
    return counts.unpivot("total", df.columns, "field", "present").select("field", "present", "total")
