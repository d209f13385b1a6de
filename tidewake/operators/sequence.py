"""State periods, visits and routes as windows over one shuffle by ship.

Readings of a ship fall into sight segments (no gap over the limit inside); every merge of the sequential
rules needs such a gap to be small, so each rule is a running sum or a look at a neighbour within a segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.config import DEFAULT, Config
from tidewake.functions.classify import completeness, reading
from tidewake.functions.geo import haversine
from tidewake.operators.spatial import small

STOPPED = ("anchored", "berthed")


def minutes(a: Column, b: Column) -> Column:
    """Minutes from a to b as a double."""
    return F.timestamp_diff("SECOND", a, b).cast("double") / 60.0


def running(flag: Column, by: list[str], order: str) -> Column:
    return F.sum(flag.cast("int")).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def classified(readings: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """mmsi, message_time, state, tenths, note."""
    r = reading(F.col("speed_over_ground"), F.col("navigational_status"), c)
    return readings.select("mmsi", "message_time", r.alias("r")).select("mmsi", "message_time", "r.*")


def runs(readings: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """One row per run: readings of one state without a gap over the limit."""
    w = Window.partitionBy("mmsi").orderBy("message_time")
    r = classified(readings, c)
    gap = minutes(F.lag("message_time").over(w), F.col("message_time"))
    r = r.withColumn("_new", F.coalesce(gap > c.max_gap_minutes, F.lit(True))).withColumn("_turn", F.col("_new") | (F.lag("state").over(w) != F.col("state")))
    r = r.withColumn("seg", running(F.col("_new"), ["mmsi"], "message_time")).withColumn("run", running(F.col("_turn"), ["mmsi"], "message_time"))
    return r.groupBy("mmsi", "seg", "run").agg(
        F.first("state").alias("state"),
        F.min("message_time").alias("start_time"),
        F.max("message_time").alias("end_time"),
        F.count("*").alias("n_readings"),
        F.sum("tenths").alias("tenths"),
        F.min(F.struct("tenths", "message_time", "note")).alias("low"),
    )


def state_periods(readings: DataFrame, c: Config = DEFAULT, previous: DataFrame | None = None) -> DataFrame:
    """mmsi, state, start_time, end_time, n_readings, confidence, note.

    Runs shorter than the dwell are absorbed by the run before, or by the first believable one after; a segment without a
    believable run keeps its runs.  ``previous`` (mmsi, previous_state) is the state before a ship's first reading.
    """
    whole = Window.partitionBy("mmsi", "seg").orderBy("run")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    r = runs(readings, c).withColumn("sure", F.col("n_readings") >= c.dwell_readings)
    r = r.withColumn("last_sure", F.last(F.when(F.col("sure"), F.col("state")), ignorenulls=True).over(before))
    r = r.withColumn("_starts", F.col("sure") & (F.col("last_sure").isNull() | (F.col("last_sure") != F.col("state"))))
    r = r.withColumn("any_sure", F.max("sure").over(Window.partitionBy("mmsi", "seg")))
    counted = F.greatest(F.lit(1), F.sum(F.col("_starts").cast("int")).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.withColumn("grp", F.when(F.col("any_sure"), counted).otherwise(F.row_number().over(whole)))
    # Ties of the lowest confidence: readings of the first believable run, then of short runs before it, then later ones.
    leading = F.col("any_sure") & F.col("last_sure").isNull() & ~F.col("sure")
    order = F.when(F.col("_starts") | ~F.col("any_sure"), 0).when(leading, 1).otherwise(2)
    p = r.groupBy("mmsi", "seg", "grp").agg(
        F.coalesce(F.min_by("state", F.when(F.col("_starts"), F.col("run"))), F.min_by("state", "run")).alias("raw"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("n_readings").cast("int").alias("n_readings"),
        F.sum("tenths").alias("tenths"),
        F.min(F.struct(F.col("low.tenths"), order.alias("o"), F.col("low.message_time"), F.col("low.note"))).alias("low"),
    )
    ahead = F.lag("raw").over(Window.partitionBy("mmsi").orderBy("start_time"))
    if previous is not None:
        p = p.join(previous.select("mmsi", "previous_state"), "mmsi", "left")
        ahead = F.coalesce(ahead, F.col("previous_state"))
    named = F.when(F.col("raw") != "maneuvering", F.col("raw")).when(ahead.isin(*STOPPED), "departed").otherwise("approach")
    return p.select(
        "mmsi",
        named.alias("state"),
        "start_time",
        "end_time",
        "n_readings",
        F.round(F.col("tenths").cast("decimal(18,4)") / F.col("n_readings") / 10, 2).cast("decimal(3,2)").alias("confidence"),
        F.col("low.note").alias("note"),
    )


def visit_spans(periods: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """Periods with their visit ``v`` and neighbours; a visit ends at sea or at a gap over the limit."""
    w = Window.partitionBy("mmsi").orderBy("start_time")
    gap = minutes(F.lag("end_time").over(w), F.col("start_time"))
    p = periods.withColumn("_cut", F.coalesce(gap > c.max_gap_minutes, F.lit(True)) | (F.col("state") == "at_sea"))
    p = p.withColumn("v", running(F.col("_cut"), ["mmsi"], "start_time")).withColumn("i", F.row_number().over(w))
    near = lambda other, gap_: F.when(gap_ <= c.max_gap_minutes, other)
    gap_after = minutes(F.col("end_time"), F.lead("start_time").over(w))
    p = p.withColumn("before", near(F.struct(F.lag("state").over(w).alias("state"), F.lag("start_time").over(w).alias("start_time")), gap))
    return p.withColumn("after", near(F.struct(F.lead("state").over(w).alias("state"), F.lead("end_time").over(w).alias("end_time")), gap_after))


def port_calls(periods: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """One row per visit with at least three readings from its first to its last stop."""
    p = visit_spans(periods, c)
    stop = F.col("state").isin(*STOPPED)
    edge = Window.partitionBy("mmsi", "v")
    p = p.withColumn("first_i", F.min(F.when(stop, F.col("i"))).over(edge)).withColumn("last_i", F.max(F.when(stop, F.col("i"))).over(edge))
    p = p.filter(F.col("i").between(F.col("first_i"), F.col("last_i")))
    g = p.groupBy("mmsi", "v").agg(
        F.when(F.max(F.col("state") == "berthed"), "berthed").otherwise("anchored").alias("stop_type"),
        F.min("start_time").alias("berth_start"),
        F.max("end_time").alias("berth_end"),
        F.sum("n_readings").cast("int").alias("n_readings"),
        F.sum(F.col("confidence") * F.col("n_readings")).alias("weighted"),
        F.min_by("before", "i").alias("before"),
        F.max_by("after", "i").alias("after"),
    )
    g = g.filter(F.col("n_readings") >= c.min_visit_readings)
    return g.select(
        "mmsi",
        "stop_type",
        F.when(F.col("before.state") == "approach", F.col("before.start_time")).otherwise(F.col("berth_start")).alias("arrival_time"),
        "berth_start",
        "berth_end",
        F.when(F.col("after.state") == "departed", F.col("after.end_time")).otherwise(F.col("berth_end")).alias("departure_time"),
        F.floor(F.timestamp_diff("SECOND", F.col("berth_start"), F.col("berth_end")) / 60).cast("int").alias("minutes_alongside"),
        "n_readings",
        F.round(F.col("weighted") / F.col("n_readings"), 2).cast("decimal(3,2)").alias("confidence"),
        completeness(F.col("before").isNotNull(), F.col("after").isNotNull()).alias("completeness"),
    )


def restart_points(periods: DataFrame, new_readings: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """mmsi, since, previous_state: from where each ship with new readings is derived again.

    The start of the last period that begins before the earliest new reading and is followed by a sight gap, so
    that nothing before it can change; a ship without one is derived from its beginning (since null).
    """
    w = Window.partitionBy("mmsi").orderBy("start_time")
    p = periods.withColumn("previous_state", F.lag("state").over(w)).withColumn("_seg", F.coalesce(minutes(F.lag("end_time").over(w), F.col("start_time")) > c.max_gap_minutes, F.lit(True)))
    first = new_readings.groupBy("mmsi").agg(F.min("message_time").alias("first_new"))
    # A late reading may bridge the gap before it: the segment must end well before, or hold the reading.
    ends = p.withColumn("seg", running(F.col("_seg"), ["mmsi"], "start_time"))
    segs = ends.groupBy("mmsi", "seg").agg(F.min("start_time").alias("since"), F.max("end_time").alias("until"), F.min_by("previous_state", "start_time").alias("previous_state"))
    touched = segs.join(first, "mmsi").filter(minutes(F.col("until"), F.col("first_new")) <= c.max_gap_minutes)
    start = touched.groupBy("mmsi").agg(F.min(F.struct("since", "previous_state")).alias("s"))
    tail = segs.join(first, "mmsi").filter("until < first_new").groupBy("mmsi").agg(F.max_by("seg", "until").alias("tail_seg"))
    last_state = ends.groupBy("mmsi", "seg").agg(F.max_by("state", "start_time").alias("tail_state"))
    tail = tail.join(last_state, [tail["mmsi"] == last_state["mmsi"], tail["tail_seg"] == last_state["seg"]]).select(tail["mmsi"], "tail_state")
    out = first.join(start, "mmsi", "left").join(tail, "mmsi", "left")
    since = F.least(F.coalesce(F.col("s.since"), F.col("first_new")), F.col("first_new"))
    return out.select("mmsi", since.alias("since"), F.when((F.col("s.since") <= F.col("first_new")), F.col("s.previous_state")).otherwise(F.col("tail_state")).alias("previous_state"))


def thinned(track: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """Slots that show the route: first and last of a ship, borders of gaps, and moves; with after_gap."""
    w = Window.partitionBy("mmsi").orderBy("slot_start")
    slot = lambda a, b: F.timestamp_diff("MINUTE", a, b)
    t = track.select(
        "*",
        F.lag("latitude").over(w).alias("_lat"),
        F.lag("longitude").over(w).alias("_lon"),
        slot(F.lag("slot_start").over(w), F.col("slot_start")).alias("gap_before"),
        slot(F.col("slot_start"), F.lead("slot_start").over(w)).alias("gap_after"),
    )
    moved = haversine(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude")) > c.route_move_km
    keep = F.col("gap_before").isNull() | F.col("gap_after").isNull() | (F.col("gap_before") > c.max_gap_minutes) | (F.col("gap_after") > c.max_gap_minutes) | F.coalesce(moved, F.lit(False))
    return t.filter(keep).withColumn("after_gap", F.coalesce(F.col("gap_before") > c.max_gap_minutes, F.lit(True))).drop("_lat", "_lon", "gap_before", "gap_after")


def route_segments(route: DataFrame, order: str = "slot_start") -> DataFrame:
    """``route`` with the number of its unbroken part."""
    return route.withColumn("segment", running(F.col("after_gap"), ["mmsi"], order))


def sailed_km(route: DataFrame, order: str = "slot_start") -> DataFrame:
    """mmsi, km: over ground, without what lies in gaps."""
    w = Window.partitionBy("mmsi").orderBy(order)
    step = haversine(F.lag("latitude").over(w), F.lag("longitude").over(w), F.col("latitude"), F.col("longitude"))
    return route.withColumn("_km", F.when(~F.col("after_gap"), step)).groupBy("mmsi").agg(F.coalesce(F.sum("_km"), F.lit(0.0)).alias("km"))


#: Times up to which they are sent to every executor.
MOST_TIMES = 10_000


def as_of(route: DataFrame, times: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """For each of the ``times`` (t) and each ship its last point at or before; hidden if it is stale and the ship is out of sight.

    Points and times share one window by ship: times ride along as rows, so no point is paired with a time.
    """
    w = Window.partitionBy("mmsi").orderBy("message_time")
    points = route.select("mmsi", "message_time", "latitude", "longitude", F.lead("message_time").over(w).alias("next_time"), F.lead("after_gap").over(w).alias("next_after_gap"))
    asked = route.select("mmsi").distinct().crossJoin(F.broadcast(times.select("t")) if small(times, MOST_TIMES) else times.select("t"))  # a row per ship and time is the result
    own = points.select("mmsi", F.col("message_time").alias("t"), F.struct("message_time", "latitude", "longitude", "next_time", "next_after_gap").alias("p"), F.lit(0).alias("k"))
    rows = own.unionByName(asked.select("mmsi", "t", F.lit(None).cast(own.schema["p"].dataType).alias("p"), F.lit(1).alias("k")))
    held = rows.withColumn("at", F.last("p", ignorenulls=True).over(Window.partitionBy("mmsi").orderBy("t", "k").rowsBetween(Window.unboundedPreceding, 0)))
    seen = held.filter((F.col("k") == 1) & F.col("at").isNotNull()).select("mmsi", "t", "at.*")
    stale = minutes(F.col("message_time"), F.col("t")) > c.max_gap_minutes
    return seen.filter(~(stale & (F.col("next_time").isNull() | F.col("next_after_gap")))).select("mmsi", "t", "message_time", "latitude", "longitude")
