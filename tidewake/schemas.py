"""Schemas of the stored tables, and the checks that hold tables to them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(text: str) -> T.StructType:
    """A schema from "name type, ..."; works without a session."""
    out = []
    for name, kind in re.findall(r"(\w+) (\w+(?:\([0-9,]+\))?)", text):
        precise = re.fullmatch(r"decimal\(([0-9]+),([0-9]+)\)", kind)
        out.append(T.StructField(name, T.DecimalType(int(precise[1]), int(precise[2])) if precise else _TYPES[kind]))
    return T.StructType(out)


#: A raw position report as delivered: timestamps are text, names are the source's.
RAW = _schema(
    "mmsi int, name string, latitude decimal(10,6), longitude decimal(10,6), speedOverGround decimal(10,2), courseOverGround decimal(10,2), trueHeading decimal(10,2), "
    "rateOfTurn decimal(10,2), shipType int, navigationalStatus int, stream string, msgtime timestamp_ntz, received_at timestamp_ntz, destination string, eta string, imoNumber int, callSign string"
)

#: What each renamed column is called after validation.
RENAMED = {
    "speedOverGround": "speed_over_ground",
    "courseOverGround": "course_over_ground",
    "trueHeading": "true_heading",
    "rateOfTurn": "rate_of_turn",
    "shipType": "ship_type",
    "navigationalStatus": "navigational_status",
    "msgtime": "message_time",
    "imoNumber": "imo_number",
    "callSign": "call_sign",
}

SILVER = T.StructType([T.StructField(RENAMED.get(f.name, f.name), f.dataType) for f in RAW])
QUARANTINE = T.StructType([*RAW, T.StructField("rejection_reason", T.StringType())])
PERIODS = _schema("mmsi int, state string, start_time timestamp_ntz, end_time timestamp_ntz, n_readings int, confidence decimal(3,2), note string")
PORT_CALLS = _schema(
    "mmsi int, stop_type string, arrival_time timestamp_ntz, berth_start timestamp_ntz, berth_end timestamp_ntz, departure_time timestamp_ntz, minutes_alongside int, n_readings int, confidence decimal(3,2), completeness string"
)
PROGRESS = _schema("layer string, mmsi int, built_from_received_at timestamp_ntz")
RULES = _schema("layer string, version int")
BOXES = _schema("osm_id long, kind string, name string, min_lat double, min_lon double, max_lat double, max_lon double, fetched_at timestamp_ntz")
PLACES = _schema("location_id long, locode string, location_name string, kind string, latitude double, longitude double")
LOCODES = _schema("locode string, country string, location string, port_name string, subdivision string, status string, function string, coordinates string")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the schema's columns: missing ones are null, others go."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def assert_same_schema(new: DataFrame, stored: DataFrame) -> None:
    """Drift between a table and what is added to it is an error, not a guess."""
    kinds = lambda d: {f.name: f.dataType.simpleString() for f in d.schema}
    if kinds(new) != kinds(stored):
        raise ValueError(f"schema changed: {sorted(set(kinds(new).items()) ^ set(kinds(stored).items()))}")
