"""Readers with explicit schemas, and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewake.schemas import LOCODES, RAW, conform


def read_csv(spark: SparkSession, path: str, schema: StructType = LOCODES) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_ndjson(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def utc(column: str):
    """Text with or without an offset as a time in UTC without zone; the session's zone is UTC."""
    return F.to_timestamp(column).cast("timestamp").cast("timestamp_ntz")


def raw_reports(spark: SparkSession, rows: list[dict], received_at) -> DataFrame:
    """Reports as delivered, missing keys null."""
    names = [f.name for f in RAW if f.name != "received_at"]
    text = spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    return conform(text.withColumn("msgtime", utc("msgtime")).withColumn("received_at", F.lit(received_at).cast("timestamp_ntz")), RAW)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def seaports(codes: DataFrame, countries: tuple[str, ...] = ("NO", "SJ")) -> DataFrame:
    """Sea ports with coordinates from the code list (Country, Location, Name, NameWoDiacritics, Subdivision, Status, Function, Coordinates)."""
    own = codes.filter(F.col("Country").isin(*countries) & (F.substring("Function", 1, 1) == "1") & (F.coalesce(F.col("Coordinates"), F.lit("")) != ""))
    return own.select(
        F.concat("Country", "Location").alias("locode"),
        F.col("Country").alias("country"),
        F.col("Location").alias("location"),
        F.coalesce(F.nullif(F.col("NameWoDiacritics"), F.lit("")), F.col("Name")).alias("port_name"),
        F.col("Subdivision").alias("subdivision"),
        F.col("Status").alias("status"),
        F.col("Function").alias("function"),
        F.col("Coordinates").alias("coordinates"),
    )
