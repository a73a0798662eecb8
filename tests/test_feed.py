import math
import threading
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.operators import entities as E
from transitlake.plans.lake import Lake, fetch_and_parse, wait_until
from transitlake.plans.config import ApiConfig, LakeConfig, ProviderConfig, StorageConfig
from transitlake.plans.schemas import SERVICES
from transitlake.sources import feed

AT = datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def message():
    m = feed.feed_message()()
    m.header.gtfs_realtime_version = "2.0"
    return m


def snapshots(spark, *contents):
    return spark.createDataFrame([("p", f"u{i}", AT, c) for i, c in enumerate(contents)], feed.SNAPSHOT)


def sample():
    m = message()
    e = m.entity.add(id="a", is_deleted=True)
    e.vehicle.position.latitude, e.vehicle.position.longitude, e.vehicle.position.bearing = 1.5, -2.0, math.nan
    e.vehicle.timestamp, e.vehicle.current_status = 1_700_000_000, 0
    e.trip_update.trip.trip_id = "t"
    e.trip_update.stop_time_update.add().arrival.time = -5
    e = m.entity.add(id="b")
    e.alert.severity_level = 3
    e.alert.active_period.add(start=10)
    e.alert.header_text.translation.add(text="x")
    e = m.entity.add(id="c")
    e.trip_modifications.start_times.append("10:00:00")
    e.trip_modifications.modifications.add(last_modified_time=7)
    m.entity.add(id="d").shape.shape_id = "s"
    e = m.entity.add(id="e")
    e.stop.stop_id, e.stop.stop_lat, e.stop.wheelchair_boarding = "q", 3.0, 1
    return m.SerializeToString()


def test_widths():
    assert {k: len(s.schema) for k, s in SERVICES.items()} == {"VehiclePosition": 26, "TripUpdate": 20, "Alert": 16, "TripModifications": 6, "Shape": 4, "Stop": 16}


def test_every_service(spark):
    entities = feed.decode(snapshots(spark, sample()))
    got = {n: [{k: v for k, v in r.asDict(True).items() if v is not None} for r in E.service_table(entities, n).collect()] for n in SERVICES}
    stamp = int(AT.timestamp())
    position = got["VehiclePosition"][0]
    assert math.isnan(position.pop("position_bearing"))
    assert position == {"entityId": "a", "fetchTime": stamp, "position_latitude": 1.5, "position_longitude": -2.0, "currentStatus": "INCOMING_AT", "timestamp": 1_700_000_000}
    assert got["TripUpdate"][0]["trip_tripId"] == "t" and got["TripUpdate"][0]["stopTimeUpdate"][0]["arrival"]["time"] == -5
    assert got["Alert"][0]["severityLevel"] == 3 and got["Alert"][0]["activePeriod"] == [{"start": 10, "end": None}] and got["Alert"][0]["headerText_translation"] == [{"text": "x", "language": None}]
    assert got["TripModifications"][0]["startTimes"] == ["10:00:00"] and got["TripModifications"][0]["modifications"][0]["lastModifiedTime"] == 7
    assert got["Shape"][0] == {"entityId": "d", "fetchTime": stamp, "shapeId": "s"}
    assert got["Stop"][0] == {"entityId": "e", "fetchTime": stamp, "stopId": "q", "stopLat": 3.0, "wheelchairBoarding": "AVAILABLE"}
    for n, s in SERVICES.items():
        assert [(f.name, f.dataType) for f in E.service_table(entities, n).schema] == [(f.name, f.dataType) for f in s.schema]
    assert {r.service: r.n for r in E.service_counts(entities).collect()} == dict.fromkeys(SERVICES, 1)


def test_only_requested_payloads(spark):
    entities = feed.decode(snapshots(spark, sample()), ["Alert"])
    assert entities.columns == ["provider", "url", "fetch_time", "entityId", "alert"]
    assert [r.entityId for r in entities.collect()] == ["b"]


def test_broken_and_empty_snapshots(spark):
    with pytest.raises(Exception, match="DecodeError"):
        feed.decode(snapshots(spark, b"\xff\xff\xff")).collect()
    assert feed.decode(snapshots(spark, b"\xff\xff\xff", None, message().SerializeToString()), on_error="skip").count() == 0
    with pytest.raises(ValueError, match="on_error"):
        feed.decode(snapshots(spark), on_error="x")


def test_flatten_is_one_level_and_renames_dots(spark):
    kind = T.StructType([T.StructField("a.b", T.IntegerType()), T.StructField("s", T.StructType([T.StructField("x", T.StructType([T.StructField("y", T.IntegerType())])), T.StructField("z.w", T.StringType())]))])
    flat = E.flatten(spark.createDataFrame([(1, ((2,), "q")), (3, None)], kind))
    assert flat.columns == ["a_b", "s_x", "s_z_w"]
    assert [tuple(r) for r in flat.collect()] == [(1, (2,), "q"), (3, None, None)]


def test_conform_casts_unsigned_numbers(spark):
    df = spark.range(1).select(F.lit("e").alias("entityId"), F.lit(5).cast("decimal(20,0)").alias("fetchTime"), F.lit("drop").alias("other"))
    assert tuple(E.conform(df, "Shape").first()) == ("e", 5, None, None)


def test_strictness_of_payloads(spark):
    rows = spark.createDataFrame([("e", AT, '{"shapeId": "s", "new": 1}'), ("f", AT, "{broken")], "entityId string, fetch_time timestamp, shape string")
    assert [tuple(r)[2:] for r in E.route(rows, "Shape").collect()] == [("s", None), (None, None)]
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        E.route(rows, "Shape", strict=True).collect()


class Handler(BaseHTTPRequestHandler):
    def do_GET(self):
        body = {"/feed": sample(), "/junk": b"\xff\xff\xff"}.get(self.path)
        self.send_response(200 if body is not None else 404)
        self.end_headers()
        self.wfile.write(body or b"")

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def server():
    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_http_source(spark, server):
    rows = feed.http_snapshots(spark, [("p", f"{server}/feed"), ("q", f"{server}/junk")], fetch_time=AT.timestamp()).orderBy("provider").collect()
    assert [(r.provider, r.content[:0] + r.content) for r in rows] == [("p", bytearray(sample())), ("q", bytearray(b"\xff\xff\xff"))]
    assert feed.http_snapshots(spark, [("p", f"{server}/feed")], fetch_time=AT.timestamp()).select(F.unix_seconds("fetch_time")).first()[0] == int(AT.timestamp())


def test_a_bad_url_does_not_sink_the_batch(spark, server):
    rows = feed.http_snapshots(spark, [("p", f"{server}/feed"), ("q", f"{server}/none"), ("r", "http://127.0.0.1:1/x"), ("s", "no url")], fetch_time=AT.timestamp())
    got = {r.provider: (r.content is not None, r.error) for r in rows.collect()}
    assert got["p"] == (True, None) and [got[k][0] for k in "qrs"] == [False] * 3 and "404" in got["q"][1] and got["r"][1] and got["s"][1]
    assert feed.decode(rows, ["Shape"]).count() == 1


def test_nothing_stays_cached(spark, server, tmp_path):
    held = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = held()
    lake = Lake(LakeConfig(StorageConfig("filesystem", {"base_directory": str(tmp_path)}), (ProviderConfig("p", (ApiConfig(f"{server}/feed", ("Alert",)),)),)), spark)
    assert len(lake.fetch_once("p", f"{server}/feed", ["Alert", "Shape", "Stop"])) == 3
    assert lake.fetch_once("p", f"{server}/none", ["Alert"]) == lake.fetch_once("p", f"{server}/junk", ["Alert"]) == []
    assert fetch_and_parse(spark, f"{server}/feed", ["Alert"])["Alert"].count() == 1 and held() == before


def test_file_source(spark, tmp_path):
    (tmp_path / "a.pb").write_bytes(sample())
    (tmp_path / "b.txt").write_bytes(b"no")
    entities = feed.decode(feed.file_snapshots(spark, str(tmp_path), "p"), ["Shape"])
    assert entities.count() == 1


def test_fetch_and_parse(spark, server):
    tables = fetch_and_parse(spark, f"{server}/feed", ["Alert", "Shape"], "p", AT)
    assert set(tables) == {"Alert", "Shape"} and "fetchTime" in tables["Alert"].columns
    assert fetch_and_parse(spark, f"{server}/none", ["Alert"]) == {}
    assert fetch_and_parse(spark, f"{server}/junk", ["Alert"]) == {}
    quiet = message()
    quiet.entity.add(id="d").shape.shape_id = "s"
    from transitlake.plans.lake import service_tables

    assert set(service_tables(snapshots(spark, quiet.SerializeToString()), ["Alert", "Shape"])) == {"Shape"}


def test_lake_lands_and_compacts(spark, server, tmp_path):
    api = ApiConfig(f"{server}/feed", ("VehiclePosition", "Alert"), refresh_seconds=1, frequency_minutes=15, check_interval_seconds=1)
    config = LakeConfig(StorageConfig("filesystem", {"base_directory": str(tmp_path)}), (ProviderConfig("p", (api,), "Europe/Amsterdam"),))
    lake = Lake(config, spark)
    first = lake.fetch_once("p", api.url, list(api.services), "Europe/Amsterdam")
    second = lake.fetch_once("p", api.url, ["Alert"], "Europe/Amsterdam")
    assert len(first) == 2 and all("/individual/" in x for x in first + second)
    assert lake.compact_once("p", ["Alert"], 15, "Europe/Amsterdam") == {"Alert": []}
    done = lake.compact_once("p", ["Alert"], 15, "Europe/Amsterdam", force=True)["Alert"]
    assert sum(c.n_rows for c in done) == 2
    assert lake.fetch_schedules()[0][0] == 1 and lake.compaction_schedules()[0][3]["minutes"] == 15
    held = lake.fetch_once("p", api.url, ["Alert"], accumulate=2)
    assert held == [] and len(lake.fetch_once("p", api.url, ["Alert"], accumulate=2)) == 2


def test_lake_runs_on_a_schedule(spark, server, tmp_path):
    from transitlake.plans.scheduler import Scheduler

    api = ApiConfig(f"{server}/feed", ("Shape",), refresh_seconds=1, check_interval_seconds=1)
    config = LakeConfig(StorageConfig("filesystem", {"base_directory": str(tmp_path)}), (ProviderConfig("p", (api,)),))
    landed = lambda: list(tmp_path.glob("p/Shape/individual/*.parquet"))
    lake = Lake(config, spark, Scheduler([("until a file is there", lambda: not landed())], pause=0.2))
    thread = threading.Thread(target=lake.start, daemon=True)
    thread.start()
    assert wait_until(landed, 30)
    thread.join(20)
    assert not thread.is_alive()
    lake.stop()
