"""Sources, spatial operators, reports and streams on small inputs."""

import math
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewake import schemas
from tidewake.functions import geo, text
from tidewake.operators import anomalies, quality, reliability, silver, spatial
from tidewake.operators.store import Warehouse, refresh_layer
from tidewake.sources import files, live, maps
from tidewake.streaming import live as stream

NOW = datetime(2024, 6, 1)


def raw(spark, *rows):
    return files.raw_reports(spark, list(rows), NOW)


FINE = {"mmsi": 311000417, "latitude": 63.41, "longitude": 10.38, "speedOverGround": 6.4, "navigationalStatus": 8, "msgtime": "2024-04-17T23:30:00+01:00"}


def other(ship, **changes):
    return FINE | {"mmsi": 311000000 + ship} | changes


def test_rejections(spark):
    reports = {
        "accepted": [FINE, other(1), other(2, speedOverGround=102.2, latitude=-90, longitude=180)],
        "duplicate": [FINE, other(1, latitude=10)],
        "invalid_latitude": [other(3, latitude=-90.5)],
        "invalid_longitude": [other(4, longitude=180.25)],
        "invalid_speed": [other(5, speedOverGround=102.3), other(6, speedOverGround=-1)],
        "invalid_mmsi_range": [FINE | {"mmsi": 99999999}],
        "future_timestamp": [other(7, msgtime="2031-07-01 12:00:00")],
        "missing_latitude": [{"mmsi": 311000008, "msgtime": "2024-04-17 00:00:00"}],
        "missing_speed": [other(9, speedOverGround=None)],
        "missing_msgtime": [other(10, msgtime=None)],
        "missing_mmsi": [FINE | {"mmsi": None}],
    }
    marked = silver.staged(raw(spark, *[r for rows in reports.values() for r in rows]), datetime(2025, 1, 1))
    got = Counter(r[0] or "accepted" for r in marked.select("rejection_reason").collect())
    assert got == {k: len(v) for k, v in reports.items()}
    assert silver.accepted(marked).filter("mmsi = 311000417").first()["message_time"] == datetime(2024, 4, 17, 22, 30)
    with pytest.raises(RuntimeError):
        silver.assert_conserved(3, 1, 1)


def km_between(a, b):
    (p, q), (r, s) = ((math.radians(x) for x in y) for y in (a, b))
    return 2 * 6371 * math.asin(min(1, math.sqrt(math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2)))


@pytest.mark.parametrize("where", [(58, 71, 4, 31), (-90, 90, -180, 180), (88.5, 90, -180, 180), (-2, 2, 179, 181)])
def test_nearest_and_radius_against_all_pairs(spark, where):
    """At home, over the whole globe, at a pole and across the date line: both ways of the join."""
    r = random.Random(4)
    wrapped = lambda x: (x + 180) % 360 - 180
    spot = lambda: (r.uniform(*where[:2]), wrapped(r.uniform(*where[2:])))
    points, places = [spot() for _ in range(50)] + [(float(where[0]), wrapped(float(where[2])))], [spot() for _ in range(30)]
    p = spark.createDataFrame([(i, *x) for i, x in enumerate(points)], "id int, lat double, lon double")
    q = spark.createDataFrame([(f"p{i:02d}", *x) for i, x in enumerate(places)], "code string, latitude double, longitude double")
    want = {i: min((km_between(x, y), f"p{j:02d}") for j, y in enumerate(places)) for i, x in enumerate(points)}
    for rows in (1000, 0):
        got = {x.id: (x.km, x.code) for x in spatial.nearest(p, q, ["id"], "code", "lat", "lon", broadcast_rows=rows).collect()}
        assert {i: c for i, (_, c) in got.items()} == {i: c for i, (_, c) in want.items()} and all(abs(got[i][0] - want[i][0]) < 1e-6 for i in want)
    owners = [i % 20 for i in range(len(points))]
    own = spark.createDataFrame([(i, o, *x) for i, (o, x) in enumerate(zip(owners, points))], "id int, owner int, lat double, lon double")
    for km in (5.0, 60.0, 120.0):
        lonely = {i for i, x in enumerate(points) if not any(owners[j] != owners[i] and km_between(x, y) <= km for j, y in enumerate(points))}
        assert {x.id for x in spatial.alone(own, "lat", "lon", "owner", km).collect()} == lonely, km


def test_place_boxes_widen_with_the_latitude(spark):
    """An anchorage 1.3 km east of a stop at 70 degrees north, one beyond the box, and places near a stop by radius."""
    stops = spark.createDataFrame([(1, 70.0, 20.0), (2, 60.0, 5.0)], "id int, lat double, lon double")
    places = spark.createDataFrame([("near", 70.0, 20.035), ("far", 70.0, 20.09), ("two", 60.0, 5.0325)], "name string, latitude double, longitude double")
    assert {(x.id, x.name, round(x.metres)) for x in spatial.near_places(stops, places, "lat", "lon").collect()} == {(1, "near", 1331), (2, "two", 1807)}


def test_maps(spark):
    payload = {"elements": [{"type": "node", "id": 1, "lat": 60.0, "lon": 5.0, "tags": {"seamark:type": "small_craft_facility", "name": "A"}}, {"type": "way", "id": 2, "bounds": {"minlat": 60, "minlon": 5, "maxlat": 61, "maxlon": 6}, "tags": {"seamark:type": "pier"}}, {"type": "way", "id": 3, "tags": {"seamark:type": "pier"}}]}
    tags = {"seamark:type": ["pier", "small_craft_facility"]}
    got = maps.features(spark, maps.payload_frame(spark, payload), tags).collect()
    assert [(r.osm_id, r.kind, r.min_lat, r.max_lat) for r in got] == [(1, "small craft facility", 60.0, 60.0)]
    assert '"seamark:type"~"^(pier|small_craft_facility)$"' in maps.layer_query(tags)
    tried = []

    def fetch(server, query):
        tried.append(server)
        return payload if server == "b" else {"elements": []}

    assert maps.download("q", ["a", "b"], fetch) == payload and tried == ["a", "b"]
    with pytest.raises(ConnectionError):
        maps.download("q", ["a"], fetch)


def test_layer_is_kept_when_fetching_fails(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    rows = [{"osm_id": 1, "kind": "pier", "name": None, "min_lat": 1.0, "min_lon": 1.0, "max_lat": 1.0, "max_lon": 1.0}]

    def broken():
        raise OSError

    with pytest.raises(OSError):
        refresh_layer(house, "boxes", broken, NOW, required=True)
    assert refresh_layer(house, "boxes", broken, NOW).count() == 0
    assert refresh_layer(house, "boxes", lambda: rows, NOW).count() == 1
    assert refresh_layer(house, "boxes", broken, datetime(2025, 1, 1)).count() == 1


def test_polls_are_due_at_fixed_times():
    time, asked = [50.0], []

    def fetch():
        asked.append(time[0])
        time[0] += 70  # an answer takes longer than a minute
        return answers[len(asked) - 1]()

    def fail():
        raise TimeoutError

    answers = [lambda: [{"mmsi": 4, "msgtime": "x"}, {"mmsi": 4, "msgtime": "x"}, {"mmsi": 5, "msgtime": "x"}], fail, lambda: [{"mmsi": 6, "msgtime": "x"}, "odd"], lambda: [{"mmsi": 5, "msgtime": "x"}], lambda: [{"mmsi": 6, "msgtime": "x"}, {"mmsi": 4, "msgtime": "y"}]]
    kept = live.poll(fetch, 20, 4, sleep=lambda s: time.__setitem__(0, time[0] + s), clock=lambda: time[0], now=lambda: NOW)
    assert asked == [50.0 + 240 * k for k in range(5)]
    # What came with the odd report is not lost: the next poll that has it brings it.
    assert [[(r["mmsi"], r["msgtime"]) for r in rows] for _, rows in kept] == [[(4, "x"), (5, "x")], [(6, "x"), (4, "y")]]


def test_service_calls(spark):
    with pytest.raises(SystemExit):
        live.collected(None, [])
    with pytest.raises(PermissionError):
        live.access_token(lambda *a: (401, {}), "x", "id", "secret")
    assert live.access_token(lambda *a: (200, {"access_token": "t"}), "x", "id", "secret") == "t"
    assert live.snapshot(lambda *a: (500, None), "x", "t") == [] and live.snapshot(lambda *a: (200, {"odd": 1}), "x", "t") == []
    assert live.snapshot(lambda *a: (200, [{"mmsi": 1}, {"mmsi": 2}]), "x", "t", 1) == [{"mmsi": 1}]
    assert live.track(lambda how, where, *a: (200, [{"at": where}]), "x", "t", 7) == [{"at": "x/7"}]
    asked = []

    def call(*a):
        asked.append(a)
        return 200, {"data": [{"mmsi": 1}], "success": True}

    assert live.voyages(call, "v", [3, 4], datetime(2024, 1, 2, 3, 4, 5, 6), datetime(2024, 1, 3)) == [{"mmsi": 1}]
    assert asked[0][:3] == ("POST", "v", {"mmsiIds": [3, 4], "startTime": "2024-01-02T03:04:05", "endTime": "2024-01-03T00:00:00"})
    assert live.voyages(lambda *a: (200, {"data": None}), "v", [], NOW, NOW) == []
    with pytest.raises(ConnectionError):
        live.voyages(lambda *a: (405, None), "v", [], NOW, NOW)
    polls = [(NOW, [FINE]), (datetime(2024, 6, 2), [other(1)])]
    assert {(r.mmsi, r.received_at) for r in live.collected(spark, polls).collect()} == {(311000417, NOW), (311000001, datetime(2024, 6, 2))}


def test_track_source(spark):
    class Tracks(live.TrackSource):
        fetch = staticmethod(lambda mmsi: [(mmsi, f"S{mmsi}", *[None] * 15)] * 2)

    spark.dataSource.register(Tracks)
    got = spark.read.format("ship_track").option("mmsis", "7,9").load()
    assert Counter((r.mmsi, r.name) for r in got.collect()) == {(7, "S7"): 2, (9, "S9"): 2}


def test_destinations(spark):
    rows = [("BERGEN", True), ("NO BGO", True), ("bgo", True), ("for bergen quay", True), ("bergens", False), ("", False), (None, False)]
    df = spark.createDataFrame(rows, "d string, want boolean").withColumn("got", text.destination_matches(F.col("d"), F.array(F.lit("Bergen")), F.array(F.lit("NOBGO"))))
    assert all(r.got == r.want for r in df.collect())


def test_forest_finds_the_planted_day():
    import numpy as np

    r = np.random.default_rng(1)
    x = np.vstack([r.normal(0, 1, (500, 5)), np.full((1, 5), 9.0)])
    assert anomalies.oddness(anomalies.grow_forest(x), x).argmax() == 500


def test_report_isolates_a_broken_check(spark):
    assert "This check failed" in quality.report({k: spark.createDataFrame([], schemas.SILVER) for k in ("bronze", "silver")})


def test_sample_repeats(spark):
    calls = spark.range(500).select(F.col("id").cast("string").alias("port_call_key"))
    a, b, c = (sorted(r[0] for r in reliability.sampled(calls, 20, s).collect()) for s in (1, 1, 2))
    assert a == b != c and len(a) == 20


def test_stream_validates_micro_batches(spark, tmp_path, monkeypatch):
    raw(spark, FINE, FINE, FINE | {"mmsi": 5}).write.parquet(str(tmp_path / "in"))
    house = Warehouse(spark, str(tmp_path / "house"))
    run = lambda: stream.silver_stream(stream.raw_stream(spark, str(tmp_path / "in")), house, str(tmp_path / "cp"), datetime(2025, 1, 1)).awaitTermination()
    real = Warehouse.append

    def lost(self, name, *more):
        if name == "quarantine":
            raise OSError("lost")
        real(self, name, *more)

    monkeypatch.setattr(Warehouse, "append", lost)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    run()  # the retried batch does not take its own accepted rows for repeats
    run()
    assert (house.read("silver").count(), house.read("quarantine").count()) == (1, 2)
    assert stream.deduplicated(stream.raw_stream(spark, str(tmp_path / "in"))).isStreaming


def drained(spark, df, name, mode="append", checkpoint=None):
    w = df.writeStream.format("memory").queryName(name).outputMode(mode)
    q = (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_windows_of_a_stream(spark, tmp_path):
    at = lambda minute, **k: other(1, msgtime=f"2024-05-01 10:{minute:02d}:00", **k)
    raw(spark, at(1), at(8, latitude=None), at(8), at(13, speedOverGround=1.5), at(55), at(59), other(2)).write.parquet(str(tmp_path / "in"))
    own = lambda: stream.raw_stream(spark, str(tmp_path / "in"))
    runs = drained(spark, stream.sight_segments(own()), "segments", "complete")
    assert sorted((r.mmsi, r.start.minute, r.end.minute, r.n) for r in runs.collect()) == [(311000001, 1, 13, 4), (311000001, 55, 59, 2), (311000002, 30, 30, 1)]
    slots = drained(spark, stream.track_stream(own()), "slots", "complete")
    assert sorted((r.mmsi, r.slot_start.minute, r.message_time.minute, float(r.latitude)) for r in slots.collect() if r.mmsi == 311000001) == [(311000001, 0, 8, 63.41), (311000001, 10, 13, 63.41), (311000001, 50, 59, 63.41)]
    once = drained(spark, stream.deduplicated(own()), "once")
    assert once.count() == 6


def test_a_drained_stream_is_whole_after_each_run(spark, tmp_path):
    at = lambda minute: other(1, msgtime=f"2024-05-01 10:{minute:02d}:00")
    (tmp_path / "in").mkdir()
    run = lambda: stream.drained(stream.sight_segments(stream.raw_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert run().count() == 0 and run().columns == ["mmsi", "start", "end", "n"]
    raw(spark, at(1), at(8), at(55)).write.mode("append").parquet(str(tmp_path / "in"))
    assert sorted((r.start.minute, r.end.minute, r.n) for r in run().collect()) == [(1, 8, 2), (55, 55, 1)]
    raw(spark, at(30)).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        assert [(r.start.minute, r.end.minute, r.n) for r in run().collect()] == [(1, 55, 4)]
    assert list((tmp_path / "cp" / "state").rglob("*.zip")) and spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_state_of_each_ship_outlives_a_restart(spark, tmp_path):
    at = lambda ship, hour, minute, speed: other(ship, msgtime=f"2024-05-01 {hour:02d}:{minute:02d}:00", speedOverGround=speed, navigationalStatus=0)
    batches = [[at(1, 10, 0, 9.0), at(1, 10, 5, 9.0), at(1, 10, 9, 1.0), at(2, 10, 0, 0.0)], [at(1, 10, 12, 1.0), at(1, 10, 20, 8.0), at(1, 10, 4, 0.0), at(2, 11, 0, 0.0)]]
    found = []
    for k, rows in enumerate(batches):
        raw(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = stream.state_changes(stream.raw_stream(spark, str(tmp_path / "in"))).writeStream.foreachBatch(lambda df, _: found.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted((r.mmsi - 311000000, r.state, r.start.strftime("%H:%M"), r.end.strftime("%H:%M"), r.n_readings) for r in found)
    assert got == [(1, "at_sea", "10:00", "10:05", 2), (1, "maneuvering", "10:09", "10:12", 2), (2, "berthed", "10:00", "10:00", 1)]
