"""The driver's tables in the roles of ours, as frames and as the same text in SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.config import DEFAULT

#: Thresholds that suit the events table: values up to a hundred, hours between a user's events.
CONFIG = replace(DEFAULT, stopped_below=50.0, underway_from=70.0, max_gap_minutes=24 * 60)
AS_OF = "2025-01-01 00:00:00"

READINGS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "mmsi": "CAST(257000000 + user_id AS INTEGER)",
    "message_time": "ts",
    "speed_over_ground": "value",
    "course_over_ground": "(event_id % 360) * 1e0",
    "navigational_status": "CASE event_type WHEN 'click' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 5 WHEN 'view' THEN 8 END",
    "latitude": "58e0 + (user_id % 40) * 0.25e0 + (event_id % 10) * 0.003e0",
    "longitude": "5e0 + (user_id % 30) * 0.4e0 + (event_id % 9) * 0.003e0",
    "name": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('SHIP ', CAST(user_id AS VARCHAR(20))) END",
    "ship_type": "CAST((user_id * 7) % 100 AS INTEGER)",
    "destination": "CASE event_id % 4 WHEN 0 THEN concat('til nordhavn  ', CAST(floor((user_id % 120) / 4e0) AS INTEGER), '!') WHEN 1 THEN concat('no ', lpad(CAST(CAST(floor((user_id % 120) / 4e0) AS INTEGER) AS VARCHAR(9)), 3, '0')) WHEN 2 THEN ' ' ELSE 'fishing grounds' END",
    "received_at": "ts + INTERVAL 1 HOUR",
}
RAW = {
    "mmsi": "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 1111 ELSE mmsi END",
    "name": "name",
    "latitude": "CAST(CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN 999e0 ELSE latitude END AS DECIMAL(10,6))",
    "longitude": "CAST(CASE WHEN event_id % 77 = 0 THEN NULL WHEN event_id % 59 = 0 THEN -181e0 ELSE longitude END AS DECIMAL(10,6))",
    "speedOverGround": "CAST(CASE WHEN event_id % 73 = 0 THEN NULL WHEN event_id % 71 = 0 THEN 500e0 ELSE floor(speed_over_ground) END AS DECIMAL(10,2))",
    "courseOverGround": "CAST(course_over_ground AS DECIMAL(10,2))",
    "navigationalStatus": "navigational_status",
    "msgtime": "CASE WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 61 = 0 THEN message_time + INTERVAL 10 YEAR ELSE message_time END",
    "received_at": "received_at",
}
#: A stop for each purchase; its length follows the value, at times a thousandfold.
CALLS = {
    "mmsi": "mmsi",
    "stop_type": "CASE WHEN event_id % 3 = 0 THEN 'anchored' ELSE 'berthed' END",
    "arrival_time": "message_time - INTERVAL 20 MINUTE",
    "berth_start": "message_time",
    "berth_end": "message_time + make_minutes",
    "departure_time": "message_time + make_minutes + INTERVAL 15 MINUTE",
    "minutes_alongside": "minutes",
    "n_readings": "CAST(3 + event_id % 5 AS INTEGER)",
    "confidence": "CAST((event_id % 10) * 0.1e0 AS DECIMAL(3,2))",
    "completeness": "CASE event_id % 4 WHEN 0 THEN 'departure_unobserved' WHEN 1 THEN 'both_unobserved' ELSE 'complete' END",
    "stop_latitude": "latitude",
    "stop_longitude": "longitude",
}
MINUTES = "CAST(floor(speed_over_ground) AS INTEGER) * CASE WHEN event_id % 41 = 0 THEN 60 ELSE 1 END + 1"
#: Ships keep to 120 spots, by user.  Ports lie at every fourth of the first hundred, places and farms at spots of their own, so that stops
#: alongside, at anchor, at a farm and in the open sea all occur.
_SPOT = {"latitude": "58e0 + ({0} % 40) * 0.25e0 + {1}", "longitude": "5e0 + ({0} % 30) * 0.4e0 + {1}"}


def _spot(number: str, off: str, name: str) -> str:
    return _SPOT[name].format(number, off)


PORTS = {
    "port_locode": "concat('NO', lpad(CAST(n_nationkey AS VARCHAR(9)), 3, '0'))",
    "port_name": "concat(CASE n_nationkey % 3 WHEN 0 THEN 'Nordhavn ' WHEN 1 THEN 'Sandvík ' ELSE 'Ålvøy ' END, CAST(n_nationkey AS VARCHAR(9)))",
    "latitude": _spot("(n_nationkey * 4)", "0.01e0", "latitude"),
    "longitude": _spot("(n_nationkey * 4)", "0.01e0", "longitude"),
}
PLACES = {
    "location_id": "s_suppkey",
    "locode": "concat('NO', lpad(CAST(s_suppkey % 1000 AS VARCHAR(9)), 3, '0'))",
    "location_name": "s_name",
    "kind": "CASE s_suppkey % 7 WHEN 0 THEN 'anchorage' WHEN 1 THEN 'ferry_quay' WHEN 2 THEN 'harbour' WHEN 3 THEN 'port_facility' ELSE 'quay' END",
    "latitude": _spot("s_suppkey", "0.012e0", "latitude"),
    "longitude": _spot("s_suppkey", "0.012e0", "longitude"),
}
BOXES = {
    "osm_id": "CAST(r_regionkey AS BIGINT)",
    "kind": "'fish farm'",
    "name": "CASE WHEN r_regionkey = 2 THEN NULL ELSE r_name END",
    "min_lat": _spot("(r_regionkey * 24 + 2)", "0e0", "latitude"),
    "min_lon": _spot("(r_regionkey * 24 + 2)", "0e0", "longitude"),
    "max_lat": _spot("(r_regionkey * 24 + 2)", "0.015e0", "latitude"),
    "max_lon": _spot("(r_regionkey * 24 + 2)", "0.015e0", "longitude"),
}
#: A mapped pier at most places.
PIERS = {
    "osm_id": "s_suppkey",
    "kind": "CASE WHEN s_suppkey % 2 = 0 THEN 'pier' ELSE 'dock' END",
    "name": "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name END",
    "min_lat": _spot("s_suppkey", "0.011e0", "latitude"),
    "min_lon": _spot("s_suppkey", "0.011e0", "longitude"),
    "max_lat": _spot("s_suppkey", "0.013e0", "latitude"),
    "max_lon": _spot("s_suppkey", "0.013e0", "longitude"),
}


def _sql(columns: dict[str, str], source: str, where: str = "") -> str:
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + f" FROM {source} {where}"


_MAKE = {"spark": "make_dt_interval(0, 0, minutes, 0)", "duckdb": "to_minutes(minutes)"}
_CALLS_FROM = f"(SELECT *, {MINUTES} AS minutes FROM readings WHERE navigational_status = 5)"

#: Common table expressions for the comparison SQL, in order.
CTES = {
    "readings": _sql(READINGS, "events"),
    "raw": _sql(RAW, "readings") + " UNION ALL " + _sql(RAW | {"received_at": "received_at + INTERVAL 2 HOUR"}, "readings", "WHERE event_id % 20 = 0"),
    "calls": _sql(CALLS, _CALLS_FROM).replace("make_minutes", _MAKE["duckdb"]),
    "ports": _sql(PORTS, "nation"),
    "places": _sql(PLACES, "supplier"),
    "boxes": _sql(BOXES, "region"),
    "piers": _sql(PIERS, "supplier", "WHERE s_suppkey % 3 <> 0"),
}


def with_ctes(names: list[str], more: dict[str, str], body: str) -> str:
    """The SQL with the named tables (``readings`` first) and further expressions."""
    own = {k: v for k, v in CTES.items() if k in names or k == "readings" and {"raw", "calls"} & set(names)} | more
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in own.items()) + " " + body


def _frame(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(v).alias(k) for k, v in columns.items()])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(load(spark, sf_dir, "events"), READINGS)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = readings(spark, sf_dir)
    return _frame(r, RAW).unionByName(_frame(r.filter("event_id % 20 = 0"), RAW | {"received_at": "received_at + INTERVAL 2 HOUR"}))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = readings(spark, sf_dir).filter("navigational_status = 5").withColumn("minutes", F.expr(MINUTES))
    return _frame(r, {k: v.replace("make_minutes", _MAKE["spark"]) for k, v in CALLS.items()})


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(load(spark, sf_dir, "nation"), PORTS)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(load(spark, sf_dir, "supplier"), PLACES)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(load(spark, sf_dir, "region"), BOXES)


def piers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(load(spark, sf_dir, "supplier").filter("s_suppkey % 3 <> 0"), PIERS)
