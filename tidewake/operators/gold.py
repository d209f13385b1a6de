"""The star schema: ports, vessels, dates, the ten-minute track and the port-call fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.config import DEFAULT, Config
from tidewake.functions.classify import evidence, ship_category, visit_type
from tidewake.functions.geo import haversine, locode_coordinate
from tidewake.operators.spatial import in_boxes, near_places, nearest, within

BERTH_KINDS = ("quay", "ferry_quay", "port_facility", "harbour")


def last_known(value: str, at: str):
    """The latest value that is not null."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at))).alias(value)


def dim_port(locodes: DataFrame) -> DataFrame:
    lat, lon = locode_coordinate(F.col("coordinates"))
    return locodes.select(F.col("locode").alias("port_locode"), "port_name", "subdivision", F.col("status").alias("locode_status"), lat.alias("latitude"), lon.alias("longitude"))


def dim_vessel(silver: DataFrame) -> DataFrame:
    v = silver.groupBy("mmsi").agg(
        last_known("name", "message_time").alias("vessel_name"),
        last_known("ship_type", "message_time"),
        F.min("message_time").alias("first_seen"),
        F.max("message_time").alias("last_seen"),
        F.count("*").alias("n_readings"),
    )
    return v.withColumn("ship_category", ship_category(F.col("ship_type")))


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last`` of the one-row frame ``bounds``."""
    d = bounds.select(F.explode(F.sequence(F.col("first").cast("date"), F.col("last").cast("date"))).alias("date_day"))
    return d.select(
        F.date_format("date_day", "yyyyMMdd").cast("int").alias("date_key"),
        "date_day",
        F.year("date_day").alias("calendar_year"),
        F.month("date_day").alias("calendar_month"),
        F.dayofmonth("date_day").alias("calendar_day"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        F.dayofweek("date_day").isin(1, 7).alias("is_weekend"),
    )


TRACK_FIELDS = ("latitude", "longitude", "speed_over_ground", "course_over_ground", "true_heading", "navigational_status")


def vessel_track(silver: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """The last reading of each ship in each ten-minute slot, over the days before the newest reading."""
    newest = silver.agg(F.max("message_time").alias("at")).first()["at"]  # as a literal it reaches the scan
    recent = silver.filter(F.col("message_time") > F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {c.track_days} DAYS"))
    slot = F.window("message_time", f"{c.slot_minutes} minutes")["start"].alias("slot_start")
    have = [f for f in TRACK_FIELDS if f in silver.columns]
    return recent.groupBy("mmsi", slot).agg(F.max("message_time").alias("message_time"), *[last_known(f, "message_time") for f in have])


def latest_position(track: DataFrame) -> DataFrame:
    """Each ship's newest slot."""
    cols = [c for c in track.columns if c != "mmsi"]
    return track.groupBy("mmsi").agg(F.max_by(F.struct(*cols), "slot_start").alias("s")).select("mmsi", "s.*")


def stop_centroids(calls: DataFrame, silver: DataFrame) -> DataFrame:
    """mmsi, berth_start, stop_latitude, stop_longitude: the mean of the readings during the stop."""
    spans = calls.select("mmsi", "berth_start", "berth_end")
    met = within(spans, silver.select("mmsi", "message_time", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon")), "mmsi", "berth_start", "berth_end", "message_time")
    return met.groupBy("mmsi", "berth_start").agg(F.avg("lat").alias("stop_latitude"), F.avg("lon").alias("stop_longitude"))


def stg_port_calls(calls: DataFrame, silver: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    out = calls.join(stop_centroids(calls, silver), ["mmsi", "berth_start"], "left")
    if progress is None:
        return out.withColumn("built_from_received_at", F.lit(None).cast("timestamp_ntz"))
    own = progress.filter("layer = 'port_calls'").select("mmsi", "built_from_received_at")
    return out.join(own, "mmsi", "left")


def fact_port_call(calls: DataFrame, ports: DataFrame, farms: DataFrame, places: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """The fact: each call with its visit type, port, berth, anchorage or farm and the confidence in it.

    ``calls`` as :func:`stg_port_calls` gives them.  Rules compare unrounded distances, stored ones are rounded.
    """
    key = ["mmsi", "berth_start"]
    stops = calls.select(*key, "stop_latitude", "stop_longitude").filter(F.col("stop_latitude").isNotNull() & F.col("stop_longitude").isNotNull())
    farm = in_boxes(stops, farms.select("name", "min_lat", "min_lon", "max_lat", "max_lon"), "stop_latitude", "stop_longitude", c.fish_farm_m)
    farm = farm.groupBy(*key).agg(F.min("name").alias("fish_farm_name")).withColumn("at_farm", F.lit(True))
    official = near_places(stops, places.select("location_name", "kind", "latitude", "longitude"), "stop_latitude", "stop_longitude", c.place_box_degrees)
    best = F.min(F.struct("metres", "location_name")).alias("b")
    berth = official.filter(F.col("kind").isin(*BERTH_KINDS)).groupBy(*key).agg(best).select(*key, F.col("b.location_name").alias("berth_name"), F.col("b.metres").alias("berth_metres"))
    anchor = official.filter((F.col("kind") == "anchorage") & (F.col("metres") <= c.anchorage_m)).groupBy(*key).agg(best).select(*key, F.col("b.location_name").alias("anchorage_name")).withColumn("at_anchorage", F.lit(True))
    port = nearest(stops, ports, key, "port_locode", "stop_latitude", "stop_longitude").withColumnsRenamed({"port_locode": "near_locode", "km": "port_km"})
    f = calls
    for part in (farm, berth, anchor, port):
        f = f.join(part, key, "left")
    no = F.lit(False)
    kind = visit_type(F.coalesce("at_farm", no), F.col("port_km"), F.col("berth_metres"), F.coalesce("at_anchorage", no), c)
    f = f.withColumn("visit_type", kind)
    return f.select(
        F.md5(F.concat_ws("|", F.col("mmsi").cast("string"), F.date_format("berth_start", "yyyy-MM-dd HH:mm:ss"))).alias("port_call_key"),
        "mmsi",
        F.when(F.col("visit_type") == "port_call", F.col("near_locode")).alias("port_locode"),
        "visit_type",
        "fish_farm_name",
        "berth_name",
        F.round("berth_metres").alias("berth_m"),
        "anchorage_name",
        F.round("port_km", 2).alias("nearest_port_km"),
        F.date_format("arrival_time", "yyyyMMdd").cast("int").alias("arrival_date_key"),
        *("stop_type", "completeness", "arrival_time", "berth_start", "berth_end", "departure_time", "minutes_alongside", "n_readings"),
        F.col("confidence").cast("double").alias("status_confidence"),
        evidence(F.col("confidence").cast("double"), F.col("port_km"), c).alias("confidence"),
        "stop_latitude",
        "stop_longitude",
        "built_from_received_at",
    )


def steps(silver: DataFrame) -> DataFrame:
    """Each reading with the time, distance and speed since the ship's reading before."""
    w = Window.partitionBy("mmsi").orderBy("message_time")
    s = silver.select("mmsi", "message_time", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    s = s.select("*", F.lag("message_time").over(w).alias("prev_time"), F.lag("lat").over(w).alias("prev_lat"), F.lag("lon").over(w).alias("prev_lon"))
    s = s.withColumn("gap_minutes", F.timestamp_diff("SECOND", F.col("prev_time"), F.col("message_time")) / F.lit(60.0)).withColumn("km", haversine(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon")))
    return s.withColumn("knots", F.try_divide(F.col("km"), F.col("gap_minutes") / 60.0) / 1.852)
