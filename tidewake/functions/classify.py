"""Classifications as Column functions: ships, readings, visits, bands and verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewake.config import DEFAULT, Config

#: Ship types by first match of [low, high].
CATEGORIES = ((30, 30, "fishing"), (31, 32, "towing / tug"), (52, 52, "towing / tug"), (50, 59, "pilot, rescue, service"), (60, 69, "passenger"), (70, 79, "cargo"), (80, 89, "tanker"), (36, 37, "leisure"))

#: The display group of each category; others are Other.
GROUPS = {"cargo": "Cargo", "tanker": "Tanker", "passenger": "Passenger & ferries", "fishing": "Fishing", "towing / tug": "Tugs & service", "pilot, rescue, service": "Tugs & service"}


def first_match(*cases: tuple[Column, Column | str], otherwise: Column | str | None = None) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    (cond, value), *rest = cases
    out = F.when(cond, lit(value))
    for cond, value in rest:
        out = out.when(cond, lit(value))
    return out.otherwise(lit(otherwise))


def ship_category(ship_type: Column) -> Column:
    return first_match(*[(ship_type.between(a, b), name) for a, b, name in CATEGORIES], (ship_type.isNull() | (ship_type == 0), "unknown"), otherwise="other")


def ship_group(category: Column) -> Column:
    return first_match(*[(category == k, v) for k, v in GROUPS.items()], otherwise="Other")


def movement(speed: Column, c: Config = DEFAULT) -> Column:
    return first_match((speed.isNull(), "unknown"), (speed < c.stopped_below, "stopped"), (speed < c.underway_from, "maneuvering"), otherwise="underway")


def reading(speed: Column, status: Column, c: Config = DEFAULT) -> Column:
    """Struct (state, tenths, note); tenths are ten times the confidence, so that sums are exact."""
    s, under = movement(speed, c), status.isin(0, 8)
    out = lambda state, tenths, note: F.struct(F.lit(state).alias("state"), F.lit(tenths).alias("tenths"), F.lit(note).alias("note"))
    return first_match(
        (s == "unknown", out("unknown", 0, "no_speed_reported")),
        ((s == "stopped") & (status == 1), out("anchored", 10, "speed_and_status_agree")),
        ((s == "stopped") & (status == 5), out("berthed", 10, "speed_and_status_agree")),
        ((s == "stopped") & under, out("berthed", 3, "status_claims_underway_but_stopped")),
        (s == "stopped", out("berthed", 5, "no_usable_status_needs_port_proximity")),
        ((s == "underway") & under, out("at_sea", 10, "speed_and_status_agree")),
        ((s == "underway") & status.isin(1, 5), out("at_sea", 3, "status_claims_stopped_but_moving")),
        (s == "underway", out("at_sea", 5, "no_usable_status")),
        otherwise=out("maneuvering", 5, "slow_transitional_speed"),
    )


def completeness(before: Column, after: Column) -> Column:
    return first_match((before & after, "complete"), (after, "arrival_unobserved"), (before, "departure_unobserved"), otherwise="both_unobserved")


def visit_type(at_farm: Column, port_km: Column, berth_m: Column, at_anchorage: Column, c: Config = DEFAULT) -> Column:
    """fish_farm, port_call, anchorage or at_sea; unknown distances count as far."""
    near = F.coalesce(port_km <= c.port_match_km, F.lit(False))
    alongside = F.coalesce(berth_m <= c.berth_match_m, F.lit(False))
    return first_match((at_farm, "fish_farm"), (near & alongside & ~at_anchorage, "port_call"), (near | at_anchorage, "anchorage"), otherwise="at_sea")


def evidence(status_confidence: Column, port_km: Column, c: Config = DEFAULT) -> Column:
    near = F.when(port_km <= c.port_close_km, 0.8).when(port_km <= c.port_near_km, 0.6).otherwise(0.0)
    return F.round(F.greatest(status_confidence, near), 2)


def banded(value: Column, borders: list[tuple[float, str]], beyond: str) -> Column:
    return first_match(*[(value <= top, name) for top, name in borders], otherwise=beyond)


def verdict(confirmed: Column, fixes: Column, harbour: Column, still: Column, c: Config = DEFAULT) -> Column:
    return first_match((confirmed, "confirmed"), (fixes < 2, "too_little_data"), (~harbour, "not_at_harbour"), (still < fixes * c.still_share, "moved"), otherwise="confirmed")
