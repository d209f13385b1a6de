"""All thresholds of the analytics, frozen in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # movement
    stopped_below: float = 0.5
    underway_from: float = 3.0
    dwell_readings: int = 3
    max_gap_minutes: int = 30
    # visits
    min_visit_readings: int = 3
    rules_version: int = 2
    # places
    earth_km: float = 6371.0
    metres_per_degree: float = 111320.0
    fish_farm_m: float = 300.0
    anchorage_m: float = 1500.0
    port_match_km: float = 10.0
    berth_match_m: float = 500.0
    port_close_km: float = 2.0
    port_near_km: float = 5.0
    place_box_degrees: float = 0.03
    # track
    track_days: int = 7
    slot_minutes: int = 10
    route_days: int = 3
    route_move_km: float = 0.15
    in_port_hours: int = 6
    live_hours: int = 2
    # anomalies
    stay_z: float = 3.5
    long_minutes: int = 24 * 60
    short_minutes: int = 15
    min_baseline: int = 10
    habit_stays: int = 3
    odd_minutes: int = 60
    odd_km: float = 20.0
    odd_alone_km: float = 3.0
    jump_minutes: tuple[int, int] = (5, 60)
    jump_km: float = 2.0
    jump_knots: float = 60.0
    no_speed_from: float = 100.0
    moving_from: float = 2.0
    day_slots: int = 12
    forest_days: int = 200
    forest_share: float = 0.003
    forest_trees: int = 200
    # reliability
    sample: int = 100
    check_hours: int = 6
    near_m: float = 300.0
    still_share: float = 0.9
    place_m: float = 2000.0
    voyage_hours: int = 12
    destination_hours: int = 24


DEFAULT = Config()
