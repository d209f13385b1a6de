"""Extracts for the dashboard: positions, calls, routes, key figures, histograms, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.config import DEFAULT, Config
from tidewake.functions.classify import ship_group
from tidewake.operators.gold import latest_position
from tidewake.functions.text import search_rank
from tidewake.operators.sequence import thinned

PORT_ZONE = "Europe/Oslo"


def newest_reading(df: DataFrame, at: str = "message_time") -> DataFrame:
    return df.agg(F.max(at).alias("newest"))


def in_port_now(calls: DataFrame, newest: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """``calls`` with in_port_now: the departure was not seen and the stop was seen lately."""
    open_ = F.col("completeness").isin("departure_unobserved", "both_unobserved")
    return calls.join(F.broadcast(newest)).withColumn("in_port_now", open_ & (F.col("berth_end") >= F.col("newest") - F.expr(f"INTERVAL {c.in_port_hours} HOURS"))).drop("newest")


def port_calls_extract(fact: DataFrame, vessels: DataFrame, ports: DataFrame, newest: DataFrame) -> DataFrame:
    f = in_port_now(fact, newest).join(vessels.select("mmsi", "vessel_name", "ship_category"), "mmsi", "left").join(ports.select("port_locode", "port_name"), "port_locode", "left")
    return f.withColumn("ship_name", F.coalesce("vessel_name", F.concat(F.lit("MMSI "), F.col("mmsi")))).withColumn("ship_group", ship_group(F.col("ship_category"))).orderBy("berth_start", "mmsi")


def ships_extract(track: DataFrame, fact: DataFrame, vessels: DataFrame, newest: DataFrame) -> DataFrame:
    """Each ship's newest position with its newest call; in_port_now is null for a ship without a call."""
    call = in_port_now(fact, newest).groupBy("mmsi").agg(F.max_by(F.struct("visit_type", "port_locode", "in_port_now"), "berth_start").alias("call"))
    now = F.col("call.in_port_now") & (F.col("call.visit_type") == "port_call")
    s = latest_position(track).join(vessels.select("mmsi", "vessel_name", "ship_category"), "mmsi", "left").join(call, "mmsi", "left")
    return s.select("mmsi", "vessel_name", "ship_category", "message_time", F.round("latitude", 5).alias("latitude"), F.round("longitude", 5).alias("longitude"), "speed_over_ground", F.col("call.port_locode").alias("port_locode"), now.alias("in_port_now")).orderBy("mmsi")


def routes_extract(track: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """Thinned routes of the last days in narrow types."""
    newest = newest_reading(track, "slot_start").first()["newest"]
    recent = track.filter(F.col("slot_start") > F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {c.route_days} DAYS"))
    return thinned(recent, c).select(
        "mmsi",
        F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("message_time")).cast("int").alias("t"),
        F.round("latitude", 4).cast("float").alias("lat"),
        F.round("longitude", 4).cast("float").alias("lon"),
        F.round("speed_over_ground", 1).cast("float").alias("speed"),
        F.round("course_over_ground").cast("short").alias("course"),
        "after_gap",
    )


def key_figures(track: DataFrame, fact: DataFrame, vessels: DataFrame, group: str | None = None, c: Config = DEFAULT) -> DataFrame:
    """One row: live ships, ships under way and in port, calls and ports of the last seven days."""
    newest = newest_reading(track)
    own = vessels.select("mmsi", ship_group(F.col("ship_category")).alias("ship_group"))
    pick = (lambda d: d.join(own, "mmsi", "left")) if group is None else (lambda d: d.join(own.filter(F.col("ship_group") == group), "mmsi"))
    live = pick(latest_position(track)).join(F.broadcast(newest)).withColumn("live", F.col("message_time") >= F.col("newest") - F.expr(f"INTERVAL {c.live_hours} HOURS"))
    a = live.agg(F.count_if("live").alias("live_ships"), F.count_if(F.col("live") & (F.col("speed_over_ground") >= 1)).alias("under_way"))
    calls = pick(in_port_now(fact, newest)).join(F.broadcast(newest)).filter("visit_type = 'port_call'")
    week = F.col("berth_start") >= F.col("newest") - F.expr("INTERVAL 7 DAYS")
    b = calls.agg(F.count_distinct(F.when(F.col("in_port_now"), F.col("mmsi"))).alias("in_port"), F.count_if(week).alias("calls"), F.count_distinct(F.when(week, F.col("port_locode"))).alias("ports"))
    return a.join(b)  # one row each


def top_ports(fact: DataFrame, ports: DataFrame, k: int = 12) -> DataFrame:
    n = fact.filter("visit_type = 'port_call'").groupBy("port_locode").agg(F.count("*").alias("n"), F.count_distinct("mmsi").alias("ships"), F.median("minutes_alongside").alias("median_minutes"))
    return n.join(ports.select("port_locode", "port_name"), "port_locode", "left").orderBy(F.desc("n"), "port_locode").limit(k)


def stay_histogram(fact: DataFrame) -> DataFrame:
    """Calls in bins of two hours; the last bin has all longer ones."""
    hours = F.least(F.col("minutes_alongside") / F.lit(60.0), F.lit(47.9))
    return fact.groupBy((F.floor(hours / 2) * 2).cast("int").alias("from_hour")).agg(F.count("*").alias("n"))


def hour_histogram(fact: DataFrame, at: str = "arrival_time", zone: str = PORT_ZONE) -> DataFrame:
    local = F.hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(at)))
    return fact.groupBy(local.alias("hour")).agg(F.count("*").alias("n"))


def band_shares(df: DataFrame, bands: dict[str, Column]) -> DataFrame:
    """One row: the percentage of rows in each band."""
    return df.agg(*[F.round(F.try_divide(F.count_if(v) * F.lit(100.0), F.count("*")), 2).alias(k) for k, v in bands.items()])


def busiest_hours(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.dayofweek("berth_start").alias("weekday"), F.hour("berth_start").alias("hour")).agg(F.count("*").alias("n"))


def time_between_calls(fact: DataFrame) -> DataFrame:
    w = Window.partitionBy("mmsi").orderBy("berth_start")
    gap = F.timestamp_diff("SECOND", F.lag("berth_end").over(w), F.col("berth_start")) / F.lit(3600.0)
    return fact.withColumn("h", gap).groupBy("mmsi").agg(F.median("h").alias("median_hours"), F.count("h").alias("n"))


def freshness(silver: DataFrame, built_at: str) -> DataFrame:
    return silver.agg(F.max("message_time").alias("newest_reading")).withColumn("built_at", F.lit(built_at).cast("timestamp_ntz"))


def search(ports: DataFrame, ships: DataFrame, wanted: str, k: int = 8) -> DataFrame:
    """label, note, rank of the ``k`` ports and ships that a typed text finds: those that begin with it first, ports (port_name, calls) by
    falling calls, then ships (mmsi, vessel_name, ship_group) by name; a ship is found by its number too."""
    name = F.coalesce("vessel_name", F.concat(F.lit("MMSI "), F.col("mmsi")))
    own = ports.select(F.col("port_name").alias("label"), F.lit("Port").alias("note"), F.col("port_name").alias("_text"), F.lit(0).alias("_kind"), (-F.col("calls")).alias("_order"))
    own = own.unionByName(ships.select(name.alias("label"), F.col("ship_group").alias("note"), F.concat_ws(" ", name, "mmsi").alias("_text"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_order")))
    found = own.withColumn("rank", search_rank(F.col("_text"), F.lit(wanted))).filter("rank IS NOT NULL")
    return found.orderBy("rank", "_kind", "_order", "label").limit(k).select("label", "note", "rank")


def as_json(one_row: DataFrame, **lists: DataFrame) -> DataFrame:
    """One JSON document: the row's fields, and small frames as lists."""
    doc = one_row.select(F.struct("*").alias("_d"))
    for name, df in lists.items():
        doc = doc.join(df.agg(F.collect_list(F.struct("*")).alias(name)))
    return doc.select(F.to_json(F.struct("_d.*", *lists)).alias("json"))


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """Files with a header whose names ascend with the order, each sorted: no task has to hold a whole fact."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    laid.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path, header=True)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
