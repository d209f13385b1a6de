"""Data tests and the audit: named read-only checks, a failing one is reported in its place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.classify import banded
from tidewake.operators.gold import steps


def unique_violations(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationship_violations(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def value_violations(df: DataFrame, column: str, *allowed: str) -> DataFrame:
    return df.filter(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count("*").alias("n"))


def arcminute_violations(ports: DataFrame) -> DataFrame:
    off = lambda c: F.abs(F.col(c) * 60.0 - F.round(F.col(c) * 60.0)) > 1e-6
    return ports.filter(off("latitude") | off("longitude"))


def outside_violations(ports: DataFrame, boxes: dict[str, tuple[float, float, float, float]]) -> DataFrame:
    """Ports outside the (min_lat, max_lat, min_lon, max_lon) of their country, the first two letters of the code."""
    bad = F.lit(False)
    for country, (a, b, c, d) in boxes.items():
        bad = bad | (F.col("port_locode").startswith(country) & ~(F.col("latitude").between(a, b) & F.col("longitude").between(c, d)))
    return ports.filter(bad)


def visit_type_violations(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("visit_type") == "port_call") != F.col("port_locode").isNotNull())


def with_share(counts: DataFrame, n: str = "n") -> DataFrame:
    """``counts`` with the percentage of the total; the counts are few, so the whole-frame window is small."""
    return counts.withColumn("percent", F.round(100.0 * F.col(n) / F.sum(n).over(Window.partitionBy()), 3))


def shares(df: DataFrame, column: Column, name: str) -> DataFrame:
    return with_share(df.groupBy(column.alias(name)).agg(F.count("*").alias("n")))


#: The audit's bands, by upper border.
GAP_BANDS = ([(11, "a. up to 11 min"), (30, "b. 11-30 min"), (120, "c. 30 min - 2 h (breaks a stay)"), (720, "d. 2-12 h")], "e. over 12 h")
STAY_BANDS = ([(-1, "a. negative (bug)"), (0, "b. 0 min"), (9, "c. 1-9 min"), (59, "d. 10-59 min"), (359, "e. 1-6 h"), (1439, "f. 6-24 h"), (10079, "g. 1-7 days")], "h. over 7 days")
DISTANCE_BANDS = ([(2, "a. 0-2 km"), (5, "b. 2-5 km"), (10, "c. 5-10 km"), (25, "d. 10-25 km (no port)"), (50, "e. 25-50 km (no port)")], "f. over 50 km (at sea)")


def stay_band(minutes: Column) -> Column:
    return banded(minutes, *STAY_BANDS)


def distance_band(km: Column) -> Column:
    return F.when(km.isNull(), "g. no position").otherwise(banded(km, *DISTANCE_BANDS))


def gap_bands(silver: DataFrame, days: int = 3) -> DataFrame:
    """Shares of the times between a ship's readings, over the last days before the newest."""
    newest = silver.agg(F.max("message_time").alias("at")).first()["at"]
    s = steps(silver).filter(F.col("prev_time").isNotNull()).filter(F.col("message_time") >= F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS"))
    return shares(s, banded(F.col("gap_minutes"), *GAP_BANDS), "band")


def teleports(silver: DataFrame, knots: float = 50.0) -> DataFrame:
    """One row: impossible_jumps, ships_affected, percent_of_steps."""
    s = steps(silver).filter("prev_time IS NOT NULL")
    jump = (F.col("gap_minutes") > 0) & (F.col("knots") > knots)
    return s.agg(F.count_if(jump).alias("impossible_jumps"), F.count_distinct(F.when(jump, F.col("mmsi"))).alias("ships_affected"), F.round(100.0 * F.count_if(jump) / F.count("*"), 3).alias("percent_of_steps"))


def suspicious(silver: DataFrame) -> DataFrame:
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    tests = {
        "Outside Norwegian waters": ~(lat.between(55, 82) & lon.between(-15, 45)),
        "Exactly 0,0 (no GPS fix)": (lat == 0) & (lon == 0),
        "Reported speed over 50 knots": F.col("speed_over_ground") > 50,
        "Received over 1 day after it was sent": F.timestamp_diff("SECOND", F.col("message_time"), F.col("received_at")) > 86400,
    }
    return silver.agg(*[F.count_if(v).alias(k) for k, v in tests.items()]).unpivot([], list(tests), "problem", "n")


def period_summary(periods: DataFrame) -> DataFrame:
    return periods.groupBy("state").agg(
        F.count("*").alias("n"), F.round(F.avg("n_readings"), 1).alias("avg_readings"), F.round(100.0 * F.avg((F.col("n_readings") == 1).cast("int")), 2).alias("percent_single"), F.count_if(F.col("end_time") < F.col("start_time")).alias("ends_before_start")
    )


def time_order(fact: DataFrame, calls: DataFrame) -> DataFrame:
    """problem, n: six ways in which the fact can be wrong, the fifth against the visits that it comes from."""
    w = Window.partitionBy("mmsi").orderBy("berth_start")
    own = fact.withColumn("next_start", F.lead("berth_start").over(w))
    tests = {
        "Arrives after it stopped": F.col("arrival_time") > F.col("berth_start"),
        "Stop ends before it starts": F.col("berth_end") < F.col("berth_start"),
        "Leaves before the stop ends": F.col("departure_time") < F.col("berth_end"),
        "Overlaps the same ship's next visit": F.col("next_start") < F.col("berth_end"),
        "No stop position (no Silver rows inside)": F.col("stop_latitude").isNull(),
    }
    counted = own.agg(*[F.count_if(v).alias(k) for k, v in tests.items()]).unpivot([], list(tests), "problem", "n")
    missing = unmatched(calls, fact).agg(F.lit("In Python table but not in Gold").alias("problem"), F.count("*").alias("n"))
    return counted.unionByName(missing)


def unmatched(calls: DataFrame, fact: DataFrame) -> DataFrame:
    """Visits that the fact lacks."""
    return calls.join(fact.select("mmsi", "berth_start"), ["mmsi", "berth_start"], "left_anti")


def completeness_shares(fact: DataFrame) -> DataFrame:
    return with_share(fact.groupBy("completeness").agg(F.count("*").alias("n"), F.round(F.avg(F.col("confidence").cast("double")), 2).alias("avg_confidence")))


def stay_lengths(fact: DataFrame) -> DataFrame:
    return with_share(fact.groupBy(stay_band(F.col("minutes_alongside")).alias("stay")).agg(F.count("*").alias("n"), F.count_if(F.col("completeness") == "complete").alias("fully_observed")))


def away_from_ports(fact: DataFrame, vessels: DataFrame) -> DataFrame:
    """By kind of ship: stops, those without a port, their percentage, and those at anchor."""
    away = F.col("port_locode").isNull()
    kinds = fact.join(vessels.select("mmsi", "ship_category"), "mmsi", "left").groupBy(F.coalesce("ship_category", F.lit("unknown")).alias("ship_kind"))
    return kinds.agg(F.count("*").alias("n"), F.count_if(away).alias("away_from_port"), F.round(100.0 * F.count_if(away) / F.count("*"), 1).alias("pct_away"), F.count_if(away & (F.col("stop_type") == "anchored")).alias("away_and_anchored"))


def farthest_stops(fact: DataFrame, vessels: DataFrame, k: int = 10) -> DataFrame:
    """The k stops farthest from a port, with the ship (a report)."""
    far = fact.filter(F.col("nearest_port_km").isNotNull()).orderBy(F.desc("nearest_port_km"), "mmsi", "berth_start").limit(k)
    named = far.join(vessels.select("mmsi", "vessel_name", "ship_type"), "mmsi", "left")
    return named.select("mmsi", "vessel_name", "ship_type", "stop_type", "berth_start", "minutes_alongside", F.round("stop_latitude", 3).alias("lat"), F.round("stop_longitude", 3).alias("lon"), "nearest_port_km").orderBy(F.desc("nearest_port_km"), "mmsi", "berth_start")


def audit(t: dict[str, DataFrame]) -> dict[str, tuple[str, Callable[[], DataFrame]]]:
    """name -> (section, check) over the tables bronze, silver, quarantine, periods, port_calls, fact, vessels, ports."""
    layers = {"Bronze (raw)": "bronze", "Silver (clean)": "silver", "Quarantine (rejected)": "quarantine", "State periods": "periods", "Port calls (Python)": "port_calls", "Port calls (Gold fact)": "fact"}

    def tables() -> DataFrame:
        out = t["silver"].agg(F.lit("Ships seen").alias("layer"), F.count_distinct("mmsi").alias("n"))
        for title, name in layers.items():
            out = out.unionByName(t[name].agg(F.lit(title).alias("layer"), F.count("*").alias("n")))
        return out

    def span() -> DataFrame:
        days = t["silver"].groupBy(F.col("received_at").cast("date").alias("day"))
        return days.agg(F.count_distinct("received_at").alias("polls"), F.count("*").alias("readings"), F.count_distinct("mmsi").alias("ships"), F.min("message_time").alias("first_sighting"), F.max("message_time").alias("last_sighting")).orderBy("day")

    return {
        "what is in the warehouse": ("overview", tables),
        "silver time span": ("overview", span),
        "why rows were rejected": ("raw input", lambda: shares(t["quarantine"], F.col("rejection_reason"), "reason").orderBy(F.desc("n"), "reason")),
        "suspicious accepted values": ("raw input", lambda: suspicious(t["silver"])),
        "teleporting ships": ("raw input", lambda: teleports(t["silver"])),
        "gaps between sightings": ("sighting frequency", lambda: gap_bands(t["silver"]).orderBy("band")),
        "state periods": ("sighting frequency", lambda: period_summary(t["periods"]).orderBy("state")),
        "completeness": ("port calls", lambda: completeness_shares(t["fact"]).orderBy(F.desc("n"))),
        "length of stay": ("port calls", lambda: stay_lengths(t["fact"]).orderBy("stay")),
        "impossible order of times": ("port calls", lambda: time_order(t["fact"], t["port_calls"])),
        "distance to the nearest port": ("in a port", lambda: shares(t["fact"], distance_band(F.col("nearest_port_km")), "distance").orderBy("distance")),
        "who stops away from ports": ("in a port", lambda: away_from_ports(t["fact"], t["vessels"]).orderBy(F.desc("n"), "ship_kind")),
        "farthest stops": ("in a port", lambda: farthest_stops(t["fact"], t["vessels"])),
        "busiest ports": ("in a port", lambda: busiest_ports(t["fact"], t["ports"])),
    }


def busiest_ports(fact: DataFrame, ports: DataFrame, k: int = 15) -> DataFrame:
    """The k ports with most calls, with the median distance of the stops."""
    g = fact.filter(F.col("port_locode").isNotNull()).groupBy("port_locode").agg(F.count("*").alias("n"), F.round(F.median("nearest_port_km"), 1).alias("median_km"))
    return g.join(ports.select("port_locode", "port_name"), "port_locode").orderBy(F.desc("n"), "port_locode").limit(k)


def markdown(df: DataFrame, rows_shown: int = 1000) -> str:
    """A small result as a table in text; of a larger one the first rows, and a line that says so."""
    found = df.limit(rows_shown + 1).collect()
    rows = [list(map(str, r)) for r in found[:rows_shown]] + [["..."] * len(df.columns)] * (len(found) > rows_shown)
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)])


def report(t: dict[str, DataFrame]) -> str:
    out, section = ["# Audit"], None
    for name, (part, check) in audit(t).items():
        if part != section:
            out.append(f"## {part.capitalize()}")
            section = part
        try:
            body = markdown(check())
        except Exception as e:  # a check that fails is part of the report
            body = f"This check failed: {str(e).splitlines()[0]}"
        out.append(f"### {name.capitalize()}\n\n{body}")
    return "\n\n".join(out) + "\n"
