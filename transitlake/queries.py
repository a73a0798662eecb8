"""The lake's operators as queries over the test tables, and the same in DuckDB's SQL.

``events`` stands in for landed rows: ``event_type`` is the service, ``user_id`` the entity, ``ts`` the fetch time, ``props``
the payload.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import timebucket as tb
from .operators import compact as C
from .operators import entities as E
from .operators import files as G
from .plans import config as conf
from .plans.schemas import SERVICES
from .sources import feed
from .sources.sinks import LandingBuffer
from .sources.storage import Storage, shared_root
from .streaming.windows import closed_counts

ZONE = "America/New_York"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _stamp(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def route_services(spark, sf_dir):
    """Entities to the tables of their services, for the requested ones: clicks come as vehicles, views as stops."""
    ev = _events(spark, sf_dir)
    vehicle = F.to_json(F.struct(F.struct(F.col("value").alias("odometer")).alias("position")))
    stop = F.to_json(F.struct(F.col("value").cast("string").alias("zoneId")))
    payload = lambda name, key, made: F.when(F.col("event_type") == name, made).alias(key)
    entities = ev.select(F.col("ts").alias("fetch_time"), F.col("event_id").cast("string").alias("entityId"), payload("click", "vehicle", vehicle), payload("view", "stop", stop))
    clicks = E.route(entities, "VehiclePosition").select(F.lit("click").alias("service"), F.col("entityId").cast("long").alias("entity_id"), F.col("position.odometer").alias("value"))
    views = E.route(entities, "Stop").select(F.lit("view").alias("service"), F.col("entityId").cast("long").alias("entity_id"), F.col("zoneId").cast("double").alias("value"))
    return C.union_all([clicks, views])


#: Which service the events of a type stand for.
STANDS_FOR = dict(zip(("click", "error", "purchase", "signup", "view"), SERVICES, strict=False))


def service_counts(spark, sf_dir):
    """Entities per service; an event is an entity of the service that its type stands for."""
    keys = [F.when(F.col("event_type") == kind, F.lit("{}")).alias(SERVICES[service].key) for kind, service in STANDS_FOR.items()]
    names = F.create_map(*[F.lit(x) for kind, service in STANDS_FOR.items() for x in (service, kind)])
    return E.service_counts(_events(spark, sf_dir).select(*keys)).select(names[F.col("service")].alias("service"), "n")


def stamp_fetch_time(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", tb.epoch_seconds(F.col("ts")).alias("fetch_time"))


def coerce_int(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", tb.parse_int(F.get_json_object("props", "$.k")).alias("k"), tb.parse_int(F.col("event_type")).isNull().alias("word_is_null"))


def flatten_one_level(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.struct("event_type", "value", F.struct("user_id").alias("deep")).alias("payload"))
    flat = E.flatten(ev)
    return flat.select("event_id", "payload_event_type", "payload_value", F.col("payload_deep.user_id").alias("deep_user_id"))


def rename_dots(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.col("value").alias("the.value"), F.struct(F.col("event_type").alias("its.type")).alias("event"))
    return E.flatten(ev)


def format_path(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", tb.landing_path(F.lit("p"), F.col("event_type"), F.col("ts")).alias("path"))


def parse_path(spark, sf_dir):
    return format_path(spark, sf_dir).select("event_id", _stamp(tb.parse_path(F.col("path"))).alias("local_time"), tb.parse_path(F.concat(F.col("path"), F.lit(".bad"))).isNull().alias("bad_is_null"))


def _bucket(minutes: int):
    def query(spark, sf_dir):
        start = tb.bucket(F.col("ts"), minutes)
        return _events(spark, sf_dir).select("event_id", _stamp(start).alias("group_time"), _stamp(tb.bucket_end(start, minutes)).alias("next_period"))

    return query


def bucket_local_tz(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", _stamp(tb.bucket(tb.local_time(F.col("ts"), ZONE), 50)).alias("group_time"))


def localise(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", F.unix_seconds(tb.instant(F.col("ts"), ZONE)).alias("instant"))


def _files(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("event_type").alias("service"), tb.landing_path(F.lit("p"), F.col("event_type"), F.col("ts")).alias("path")).distinct()


def group_files(spark, sf_dir):
    """Landed files by service and bucket, closed or not."""
    grouped = G.closed_groups(_files(spark, sf_dir), 15, force=True).withColumn("service", F.split("directory", "/")[1])
    return grouped.groupBy("service", _stamp("group_time").alias("group_time")).agg(F.count("path").cast("int").alias("n_files"), F.min("path").alias("first_path"))


def closed_groups(spark, sf_dir):
    grouped = G.closed_groups(_files(spark, sf_dir), 15).withColumn("service", F.split("directory", "/")[1])
    return grouped.groupBy("service", _stamp("group_time").alias("group_time")).agg(F.count("path").cast("int").alias("n_files"))


def output_label(spark, sf_dir):
    """Where the buckets of 50 minutes that have events would be compacted to."""
    starts = _events(spark, sf_dir).select(tb.wall_clock(tb.bucket(F.col("ts"), 50)).alias("g")).distinct().collect()  # 29 a day
    return spark.createDataFrame([(r["g"], tb.output_path("p", "S", datetime.fromisoformat(r["g"]), 50)) for r in starts], "group_time string, path string")


def _compacted(spark, sf_dir) -> DataFrame:
    rows = _events(spark, sf_dir).withColumn("group_time", tb.bucket(F.col("ts"), 60))
    done = G.closed(rows, 60, ["event_type"]).withColumn("next_period", tb.bucket_end(F.col("group_time"), 60))
    path = F.concat(F.lit("p/"), "event_type", F.lit("/"), F.date_format("group_time", "yyyy-MM-dd"), F.lit("/"), F.date_format("group_time", "HH-mm-ss"), F.lit("_to_"), F.date_format("next_period", "HH-mm-ss"), F.lit(".parquet"))
    return done.select("event_id", "event_type", "user_id", "value", _stamp("group_time").alias("group_time"), _stamp("next_period").alias("next_period"), path.alias("output_path"))


def compact_closed(spark, sf_dir):
    """Closed hours per service, each row with the object that it goes into."""
    return _compacted(spark, sf_dir)


def union_strict(spark, sf_dir):
    """Frames of equal columns, each of them whole."""
    ev = _events(spark, sf_dir).select("event_id", "event_type", "value")
    return C.union_all([ev, ev])


def union_promote(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return C.union_all([ev.select("event_id", "value"), ev.select("event_id", "event_type")], promote=True)


def schema_judgement(spark, sf_dir):
    """Files as (bucket, path, footer): which fit their bucket's first full one."""
    ev = _events(spark, sf_dir)
    files = ev.select(tb.bucket(F.col("ts"), 1440).alias("group_time"), F.format_string("f%010d", "event_id").alias("path"), (F.col("event_id") % 7 != 0).alias("readable"), (F.col("event_id") % 5).alias("n_rows"), (F.col("event_id") % 3).cast("string").alias("footer"))
    return C.judged(files).select("path", "good")


def effective_config(spark, sf_dir):
    """Provider values take the place of API values that are still the defaults."""
    out = []
    for p_freq, p_check in ((None, None), (15, None), (None, 10), (15, 10)):
        for freq, check in ((60, 300), (5, 300), (60, 20)):
            p = conf.ProviderConfig("p", (), frequency_minutes=p_freq, check_interval_seconds=p_check)
            a = conf.effective_api(p, conf.ApiConfig("u", ("Alert",), frequency_minutes=freq, check_interval_seconds=check))
            out.append((p_freq or 0, p_check or 0, freq, check, a.frequency_minutes, a.check_interval_seconds))
    return spark.createDataFrame(out, "p_freq int, p_check int, freq int, check_s int, eff_freq int, eff_check int")


def _snapshots(spark, sf_dir) -> DataFrame:
    """Events as feeds: a snapshot for each quarter of an hour, fetched at midnight, of vehicle positions and, for some events, other payloads."""
    ev = _events(spark, sf_dir).select(F.date_trunc("DAY", "ts").cast("timestamp").alias("day"), tb.bucket(F.col("ts"), 15).alias("quarter"), tb.epoch_seconds(F.col("ts")).alias("t"), "event_id", "user_id", "value")
    days = ev.groupBy("day", "quarter").agg(F.collect_list(F.struct("t", "event_id", "user_id", "value")).alias("rows"))  # a snapshot is one message

    def build(batches):
        for batch in batches:
            out = []
            for rows in batch.column("rows").to_pylist():
                m = feed.feed_message()()
                m.header.gtfs_realtime_version = "2.0"
                for r in rows:
                    e = m.entity.add(id=str(r["event_id"]))
                    e.vehicle.vehicle.id = str(r["user_id"])
                    e.vehicle.position.latitude, e.vehicle.position.longitude = r["event_id"] % 90, r["user_id"] % 180
                    e.vehicle.timestamp = r["t"]
                    if r["event_id"] % 10 == 0:
                        e.alert.severity_level = 1 + r["event_id"] % 4
                        e.alert.active_period.add(start=r["t"])
                    if r["event_id"] % 7 == 0:
                        e.trip_update.trip.trip_id = str(r["user_id"])
                        e.trip_update.stop_time_update.add().arrival.time = -r["t"] if r["event_id"] % 2 else r["t"]
                    if r["event_id"] % 11 == 0:
                        e.shape.shape_id = f"s{r['user_id']}"
                        if r["event_id"] % 2:
                            e.shape.encoded_polyline = f"_p{r['event_id']}"
                    if r["event_id"] % 13 == 0:
                        e.stop.stop_id, e.stop.stop_lat = f"q{r['user_id']}", r["event_id"] % 90
                        e.stop.wheelchair_boarding = r["event_id"] % 3
                        e.stop.stop_name.translation.add(text=f"é{r['event_id']}", language="fr")
                    if r["event_id"] % 17 == 0:
                        e.trip_modifications.start_times.append(f"{r['event_id'] % 24:02d}:00:00")
                        e.trip_modifications.selected_trips.add(shape_id=f"s{r['user_id']}").trip_ids.extend(["a", f"t{r['event_id']}"])
                        change = e.trip_modifications.modifications.add(last_modified_time=r["t"])
                        change.replacement_stops.add(travel_time_to_stop=r["event_id"] % 60 - 30)
                out.append(m.SerializeToString())
            yield pa.RecordBatch.from_arrays([batch.column("day"), pa.array(out, pa.binary())], ["fetch_time", "content"])

    made = days.mapInArrow(build, "fetch_time timestamp, content binary")
    return made.select(F.lit("p").alias("provider"), F.lit("u").alias("url"), "fetch_time", "content")


def decode_feed(spark, sf_dir):
    """Snapshots decoded to vehicle positions, typed and flattened."""
    table = E.service_table(feed.decode(_snapshots(spark, sf_dir), ["VehiclePosition"]), "VehiclePosition")
    return table.select(F.col("entityId").alias("entity_id"), F.col("fetchTime").alias("fetch_time"), "vehicle_id", F.col("position_latitude").cast("double").alias("latitude"), F.col("position_longitude").cast("double").alias("longitude"), "timestamp", F.col("position_bearing").isNull().alias("no_bearing"))


def decode_alerts(spark, sf_dir):
    table = E.service_table(feed.decode(_snapshots(spark, sf_dir), ["Alert"]), "Alert")
    return table.select(F.col("entityId").alias("entity_id"), F.col("severityLevel").alias("severity"), F.col("activePeriod")[0]["start"].alias("period_start"), F.col("activePeriod")[0]["end"].isNull().alias("open_end"))


def decode_trip_updates(spark, sf_dir):
    table = E.service_table(feed.decode(_snapshots(spark, sf_dir), ["TripUpdate"]), "TripUpdate")
    return table.select(F.col("entityId").alias("entity_id"), "trip_tripId", F.col("stopTimeUpdate")[0]["arrival"]["time"].alias("arrival"))


def decode_shapes(spark, sf_dir):
    table = E.service_table(feed.decode(_snapshots(spark, sf_dir), ["Shape"]), "Shape")
    return table.select(F.col("entityId").alias("entity_id"), F.col("shapeId").alias("shape_id"), F.col("encodedPolyline").alias("polyline"))


def decode_stops(spark, sf_dir):
    table = E.service_table(feed.decode(_snapshots(spark, sf_dir), ["Stop", "Alert"]), "Stop")
    return table.select(F.col("entityId").alias("entity_id"), F.col("stopId").alias("stop_id"), F.col("stopLat").cast("double").alias("latitude"), F.col("wheelchairBoarding").alias("boarding"), F.col("stopName_translation")[0]["text"].alias("name"), F.col("zoneId").alias("zone_id"))


def decode_trip_modifications(spark, sf_dir):
    table = E.service_table(feed.decode(_snapshots(spark, sf_dir)), "TripModifications")
    change = F.col("modifications")[0]
    return table.select(
        F.col("entityId").alias("entity_id"), F.col("startTimes")[0].alias("start_time"), F.col("selectedTrips")[0]["tripIds"][1].alias("trip_id"), F.col("selectedTrips")[0]["shapeId"].alias("shape_id"),
        change["lastModifiedTime"].alias("modified"), change["replacementStops"][0]["travelTimeToStop"].alias("travel_time"), change["serviceAlertId"].alias("alert_id"),
    )


def conform_schema(spark, sf_dir):
    """A foreign table under a service's schema: unsigned numbers cast, unknown columns dropped, missing ones null."""
    ev = _events(spark, sf_dir)
    table = ev.select(F.col("event_id").cast("string").alias("entityId"), tb.epoch_seconds(F.col("ts")).cast("decimal(20,0)").alias("fetchTime"), F.col("event_type").alias("shapeId"), "value")
    return E.conform(table, SERVICES["Shape"]).withColumn("encodedPolyline", F.col("encodedPolyline").isNull())


def _folder(spark, name: str) -> str:
    return f"{shared_root(spark)}/transitlake-{name}-{uuid.uuid4().hex}"


def _store(spark, name: str) -> Storage:
    folder = _folder(spark, name)
    return Storage(spark, folder if ":" in folder else f"file://{folder}")


def _land(store: Storage, rows: DataFrame) -> list[str]:
    """Lands rows as files, one per ``event_type``, the service, and ``stamp``; the services."""
    written = f"_written/{uuid.uuid4().hex}"
    rows.repartition("event_type", "stamp").write.partitionBy("event_type", "stamp").parquet(store.uri(written))
    named = [(p, *(x.split("=", 1)[1] for x in p.split("/")[-3:-1])) for p in store.list_files(written, "part-*.parquet", recursive=True)]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda n: store.rename_file(n[0], f"p/{n[1]}/individual/{n[2]}.parquet"), named))
    return sorted({service for _, service, _ in named})


def _compact_all(store: Storage, services: list[str], **options) -> dict[str, list[C.Compacted]]:
    """Compacts the days of all services, side by side."""
    with ThreadPoolExecutor(8) as pool:
        return dict(zip(services, pool.map(lambda s: C.compact(store, "p", s, 1440, **options), services), strict=True))


def _stored(store: Storage, paths: list[str], schema: str, *columns) -> DataFrame:
    """Rows of files: event_id, the service, which is the directory below the provider's, and ``columns``."""
    if not paths:
        rows = store.spark.createDataFrame([], schema).withColumn("path", F.lit(""))
    else:
        rows = store.spark.read.schema(schema).parquet(*map(store.uri, paths)).withColumn("path", F.col("_metadata.file_path"))
    parts = F.split("path", "/")
    return rows.withColumn("service", F.element_at(parts, -3)).withColumn("day", F.element_at(parts, -2)).select("event_id", "service", *columns)


def _six_hours(spark, sf_dir) -> DataFrame:
    start = tb.bucket(F.col("ts"), 360)
    return _events(spark, sf_dir).select("event_id", "event_type", "value", F.floor(F.hour("ts") / 6).alias("quarter"), F.date_format(start + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd_HH-mm-ss").alias("stamp"))


def compact_files(spark, sf_dir):
    """Events landed as files, one per service and six hours, and compacted by day: the rows of the objects made."""
    store = _store(spark, "lake")
    done = _compact_all(store, _land(store, _six_hours(spark, sf_dir).drop("quarter")))
    return _stored(store, [c.output for made in done.values() for c in made if c.output], "event_id long, value double", "value", "day")


def landing_buffer(spark, sf_dir):
    """Tables of six days each, added in turn to a buffer that lands two at a time: the rows that landed."""
    store = _store(spark, "buffer")
    ev = _events(spark, sf_dir).select("event_id", "event_type", F.date_format(F.date_trunc("DAY", "ts") - F.make_dt_interval((F.dayofmonth("ts") - 1) % 6), "yyyy-MM-dd").alias("first")).persist()
    try:
        tables = sorted(tuple(r) for r in ev.select("event_type", "first").distinct().collect())  # six a month and service

        def add(service: str) -> list[str]:
            buffer, out = LandingBuffer(store, 2), []
            for first in (f for s, f in tables if s == service):
                out += buffer.add(ev.where((F.col("event_type") == service) & (F.col("first") == first)).select("event_id"), "p", service, datetime.fromisoformat(first))
            return out

        with ThreadPoolExecutor(8) as pool:
            landed = [x for out in pool.map(add, sorted({s for s, _ in tables})) for x in out]
    finally:
        ev.unpersist()
    stamp = F.regexp_extract("path", r"([0-9-]+)_00-00-00\.parquet$", 1)
    return _stored(store, landed, "event_id long", stamp.alias("first"))


def quarantine_files(spark, sf_dir):
    """Days whose files of the second quarter have a column more, behind an empty file of other columns: which rows are compacted, which set aside."""
    store, rows = _store(spark, "quarantine"), _six_hours(spark, sf_dir)
    services = _land(store, rows.where("quarter <> 1").select("event_id", "event_type", "stamp"))
    services = sorted({*services, *_land(store, rows.where("quarter = 1").select("event_id", "event_type", "stamp", F.lit(True).alias("extra")))})
    empty = io.BytesIO()
    pq.write_table(pa.table({"other": pa.array([], pa.int32())}), empty)
    for service in services:
        for day in sorted({p.split("/")[-1][:10] for p in store.list_files(f"p/{service}/individual")}):
            store.save_bytes(empty.getvalue(), f"p/{service}/individual/{day}_00-00-00.parquet")
    done = _compact_all(store, services)
    objects = [c.output for made in done.values() for c in made if c.output]
    aside = [p for s in services for p in store.list_files(f"p/{s}/error", "*.parquet")]
    return C.union_all([_stored(store, paths, "event_id long", F.lit(place).alias("place")) for place, paths in (("object", objects), ("error", aside))])


def late_files(spark, sf_dir):
    """Days compacted without their third quarter, which then arrives and takes the place of what is there: the rows of the objects."""
    store, rows = _store(spark, "late"), _six_hours(spark, sf_dir)
    early = _land(store, rows.where("quarter <> 2").select("event_id", "event_type", "stamp"))
    done = _compact_all(store, early)
    late = _land(store, rows.where("quarter = 2").select("event_id", "event_type", "stamp"))
    again = _compact_all(store, late, late="overwrite")
    outputs = {c.output for made in [*done.values(), *again.values()] for c in made if c.output}
    return _stored(store, sorted(outputs), "event_id long", "day")


def stream_closed(spark, sf_dir):
    """Closed hours, counted by a stream with a watermark that runs until the files at hand are through."""
    schema = _events(spark, sf_dir).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folder = _folder(spark, "stream")
    q = closed_counts(stream, 60).writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("group_time timestamp, n long").parquet(f"{folder}/out").select(_stamp("group_time").alias("group_time"), "n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        route_services, service_counts, stamp_fetch_time, coerce_int, flatten_one_level, rename_dots, format_path, parse_path, bucket_local_tz, localise, group_files,
        closed_groups, output_label, compact_closed, union_strict, union_promote, schema_judgement, effective_config,
        decode_feed, decode_alerts, decode_trip_updates, decode_shapes, decode_stops, decode_trip_modifications, conform_schema,
        stream_closed, compact_files, landing_buffer, quarantine_files, late_files,
    )
} | {f"bucket_{m}": _bucket(m) for m in (15, 50, 60, 1440, 2880)}


def _start(minutes: int, ts: str = "ts") -> str:
    return f"(date_trunc('day', {ts}) + to_minutes(CAST((hour({ts}) * 60 + minute({ts})) // {minutes} * {minutes} AS BIGINT)))"


_FMT = "'%Y-%m-%d %H:%M:%S'"
_PATH = "'p/' || event_type || '/individual/' || strftime(ts, '%Y-%m-%d_%H-%M-%S') || '.parquet'"
_LOCAL = f"(ts AT TIME ZONE 'UTC' AT TIME ZONE '{ZONE}')"

ORACLE: dict[str, str] = {
    "route_services": "SELECT event_type AS service, event_id AS entity_id, value FROM events WHERE event_type IN ('click', 'view')",
    "service_counts": "SELECT event_type AS service, count(*) AS n FROM events GROUP BY 1",
    "stamp_fetch_time": "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS fetch_time FROM events",
    "coerce_int": "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, true AS word_is_null FROM events",
    "flatten_one_level": "SELECT event_id, event_type AS payload_event_type, value AS payload_value, user_id AS deep_user_id FROM events",
    "rename_dots": "SELECT event_id, value AS the_value, event_type AS event_its_type FROM events",
    "output_label": f"SELECT DISTINCT strftime({_start(50)}, {_FMT}) AS group_time, 'p/S/' || strftime({_start(50)}, '%Y-%m-%d/%H-%M-%S') || '_to_' || strftime({_start(50)} + to_minutes(50), '%H-%M-%S') || '.parquet' AS path FROM events",
    "decode_shapes": "SELECT CAST(event_id AS VARCHAR) AS entity_id, 's' || user_id AS shape_id, CASE WHEN event_id % 2 = 1 THEN '_p' || event_id END AS polyline FROM events WHERE event_id % 11 = 0",
    "decode_stops": "SELECT CAST(event_id AS VARCHAR) AS entity_id, 'q' || user_id AS stop_id, CAST(event_id % 90 AS DOUBLE) AS latitude, ['UNKNOWN', 'AVAILABLE', 'NOT_AVAILABLE'][event_id % 3 + 1] AS boarding, 'é' || event_id AS name, CAST(NULL AS VARCHAR) AS zone_id FROM events WHERE event_id % 13 = 0",
    "decode_trip_modifications": "SELECT CAST(event_id AS VARCHAR) AS entity_id, lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') || ':00:00' AS start_time, 't' || event_id AS trip_id, 's' || user_id AS shape_id, CAST(floor(epoch(ts)) AS BIGINT) AS modified, CAST(event_id % 60 - 30 AS INTEGER) AS travel_time, CAST(NULL AS VARCHAR) AS alert_id FROM events WHERE event_id % 17 = 0",
    "landing_buffer": "WITH t AS (SELECT event_id, event_type AS service, strftime(date_trunc('day', ts) - to_days(CAST((day(ts) - 1) % 6 AS INTEGER)), '%Y-%m-%d') AS first FROM events), k AS (SELECT service, first, row_number() OVER (PARTITION BY service ORDER BY first) AS i, count(*) OVER (PARTITION BY service) AS n FROM (SELECT DISTINCT service, first FROM t)) SELECT event_id, service, first FROM t JOIN k USING (service, first) WHERE i <= n // 2 * 2",
    "quarantine_files": "WITH r AS (SELECT event_id, event_type AS service, date_trunc('day', ts) AS b, hour(ts) // 6 AS q FROM events), f AS (SELECT service, b, min(q) = 1 AS odd, max(max(b)) OVER (PARTITION BY service) AS last FROM r GROUP BY 1, 2) SELECT event_id, service, CASE WHEN (q = 1) = odd THEN 'object' ELSE 'error' END AS place FROM r JOIN f USING (service, b) WHERE b < last",
    "late_files": "WITH r AS (SELECT event_id, event_type AS service, date_trunc('day', ts) AS b, hour(ts) // 6 = 2 AS late FROM events), l AS (SELECT service, max(b) FILTER (NOT late) AS one, max(b) AS two FROM r GROUP BY 1), made AS (SELECT event_id, service, b, late OR b = one AS again, late, one, two FROM r JOIN l USING (service)), new AS (SELECT DISTINCT service, b FROM made WHERE again AND b < two) SELECT event_id, service, strftime(b, '%Y-%m-%d') AS day FROM made AS m WHERE (again AND b < two) OR (NOT late AND b < one AND NOT EXISTS (SELECT 1 FROM new WHERE new.service = m.service AND new.b = m.b))",
    "format_path": f"SELECT event_id, {_PATH} AS path FROM events",
    "parse_path": f"SELECT event_id, strftime(ts, {_FMT}) AS local_time, true AS bad_is_null FROM events",
    "bucket_local_tz": f"SELECT event_id, strftime({_start(50, _LOCAL)}, {_FMT}) AS group_time FROM events",
    "localise": f"SELECT event_id, CAST(floor(epoch(ts AT TIME ZONE '{ZONE}')) AS BIGINT) AS instant FROM events",
    "group_files": f"SELECT event_type AS service, strftime({_start(15)}, {_FMT}) AS group_time, CAST(count(DISTINCT {_PATH}) AS INTEGER) AS n_files, min({_PATH}) AS first_path FROM events GROUP BY 1, 2",
    "closed_groups": f"WITH g AS (SELECT event_type AS service, {_start(15)} AS b, count(DISTINCT {_PATH}) AS n FROM events GROUP BY 1, 2) SELECT service, strftime(b, {_FMT}) AS group_time, CAST(n AS INTEGER) AS n_files FROM (SELECT *, max(b) OVER (PARTITION BY service) AS last FROM g) WHERE last >= b + to_minutes(15)",
    "compact_closed": f"WITH r AS (SELECT *, {_start(60)} AS b FROM events), c AS (SELECT *, b + to_minutes(60) AS e, max(b) OVER (PARTITION BY event_type) AS last FROM r) SELECT event_id, event_type, user_id, value, strftime(b, {_FMT}) AS group_time, strftime(e, {_FMT}) AS next_period, 'p/' || event_type || '/' || strftime(b, '%Y-%m-%d') || '/' || strftime(b, '%H-%M-%S') || '_to_' || strftime(e, '%H-%M-%S') || '.parquet' AS output_path FROM c WHERE last >= e",
    "union_strict": "SELECT event_id, event_type, value FROM events UNION ALL SELECT event_id, event_type, value FROM events",
    "union_promote": "SELECT event_id, value FROM events UNION ALL BY NAME SELECT event_id, event_type FROM events",
    "schema_judgement": f"WITH f AS (SELECT {_start(1440)} AS g, format('f{{:010d}}', event_id) AS path, event_id % 7 <> 0 AS readable, event_id % 5 AS n, CAST(event_id % 3 AS VARCHAR) AS footer FROM events), o AS (SELECT g, arg_min(footer, path) AS first_footer FROM f WHERE readable AND n > 0 GROUP BY g) SELECT path, readable AND (n = 0 OR coalesce(footer = first_footer, true)) AS good FROM f LEFT JOIN o USING (g)",
    "effective_config": "SELECT coalesce(p_freq, 0) AS p_freq, coalesce(p_check, 0) AS p_check, freq, check_s, CASE WHEN freq = 60 AND p_freq IS NOT NULL THEN p_freq ELSE freq END AS eff_freq, CASE WHEN check_s = 300 AND p_check IS NOT NULL THEN p_check ELSE check_s END AS eff_check FROM (VALUES (CAST(NULL AS INTEGER), CAST(NULL AS INTEGER)), (15, NULL), (NULL, 10), (15, 10)) AS p(p_freq, p_check), (VALUES (60, 300), (5, 300), (60, 20)) AS a(freq, check_s)",
    "decode_feed": "SELECT CAST(event_id AS VARCHAR) AS entity_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS fetch_time, CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude, CAST(floor(epoch(ts)) AS BIGINT) AS \"timestamp\", true AS no_bearing FROM events",
    "decode_alerts": "SELECT CAST(event_id AS VARCHAR) AS entity_id, CAST(1 + event_id % 4 AS INTEGER) AS severity, CAST(floor(epoch(ts)) AS BIGINT) AS period_start, true AS open_end FROM events WHERE event_id % 10 = 0",
    "decode_trip_updates": "SELECT CAST(event_id AS VARCHAR) AS entity_id, CAST(user_id AS VARCHAR) AS \"trip_tripId\", CAST(floor(epoch(ts)) AS BIGINT) * CASE WHEN event_id % 2 = 1 THEN -1 ELSE 1 END AS arrival FROM events WHERE event_id % 7 = 0",
    "conform_schema": "SELECT CAST(event_id AS VARCHAR) AS \"entityId\", CAST(floor(epoch(ts)) AS BIGINT) AS \"fetchTime\", event_type AS \"shapeId\", true AS \"encodedPolyline\" FROM events",
    "compact_files": "WITH d AS (SELECT *, date_trunc('day', ts) AS b, max(date_trunc('day', ts)) OVER (PARTITION BY event_type) AS last FROM events) SELECT event_id, value, event_type AS service, strftime(b, '%Y-%m-%d') AS day FROM d WHERE last > b",
    "stream_closed": "WITH w AS (SELECT date_trunc('hour', ts) AS b, count(*) AS n FROM events GROUP BY 1) SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS group_time, n FROM w WHERE b + to_minutes(60) <= (SELECT max(ts) FROM events)",
} | {f"bucket_{m}": f"SELECT event_id, strftime({_start(m)}, {_FMT}) AS group_time, strftime({_start(m)} + to_minutes({m}), {_FMT}) AS next_period FROM events" for m in (15, 50, 60, 1440, 2880)}
