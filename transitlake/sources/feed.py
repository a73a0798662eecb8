"""Feed snapshots: reading them from HTTP or files, and decoding them to entities.

A snapshot is a row (provider, url, fetch_time, content). The protobuf classes are built at run time from the public
feed specification, in each Python worker, so that no generated code and no further package is needed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import lru_cache
from http.client import HTTPException
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..plans.schemas import SERVICES

# The messages of the public feed specification, a line per field: label, type, name, number.
# "!" is required, "?" optional, "*" repeated; a name in angle brackets is an enumeration.
MESSAGES = {
    "FeedMessage": "! FeedHeader header 1; * FeedEntity entity 2",
    "FeedHeader": "! string gtfs_realtime_version 1; ? <Incrementality> incrementality 2; ? uint64 timestamp 3; ? string feed_version 4",
    "FeedEntity": "! string id 1; ? bool is_deleted 2; ? TripUpdate trip_update 3; ? VehiclePosition vehicle 4; ? Alert alert 5; ? Shape shape 6; ? Stop stop 7; ? TripModifications trip_modifications 8",
    "TripUpdate": "! TripDescriptor trip 1; * StopTimeUpdate stop_time_update 2; ? VehicleDescriptor vehicle 3; ? uint64 timestamp 4; ? int32 delay 5; ? TripProperties trip_properties 6",
    "StopTimeEvent": "? int32 delay 1; ? int64 time 2; ? int32 uncertainty 3; ? int64 scheduled_time 4",
    "StopTimeUpdate": "? uint32 stop_sequence 1; ? StopTimeEvent arrival 2; ? StopTimeEvent departure 3; ? string stop_id 4; ? <StopRelationship> schedule_relationship 5; ? StopTimeProperties stop_time_properties 6; ? <OccupancyStatus> departure_occupancy_status 7",
    "StopTimeProperties": "? string assigned_stop_id 1",
    "TripProperties": "? string trip_id 1; ? string start_date 2; ? string start_time 3; ? string shape_id 4",
    "VehiclePosition": "? TripDescriptor trip 1; ? Position position 2; ? uint32 current_stop_sequence 3; ? <VehicleStopStatus> current_status 4; ? uint64 timestamp 5; ? <CongestionLevel> congestion_level 6; ? string stop_id 7; ? VehicleDescriptor vehicle 8; ? <OccupancyStatus> occupancy_status 9; ? uint32 occupancy_percentage 10; * CarriageDetails multi_carriage_details 11",
    "CarriageDetails": "? string id 1; ? string label 2; ? <OccupancyStatus> occupancy_status 3; ? int32 occupancy_percentage 4; ? uint32 carriage_sequence 5",
    "Alert": "* TimeRange active_period 1; * EntitySelector informed_entity 5; ? <Cause> cause 6; ? <Effect> effect 7; ? TranslatedString url 8; ? TranslatedString header_text 10; ? TranslatedString description_text 11; ? TranslatedString tts_header_text 12; ? TranslatedString tts_description_text 13; ? <SeverityLevel> severity_level 14; ? TranslatedImage image 15; ? TranslatedString image_alternative_text 16; ? TranslatedString cause_detail 17; ? TranslatedString effect_detail 18",
    "TimeRange": "? uint64 start 1; ? uint64 end 2",
    "Position": "! float latitude 1; ! float longitude 2; ? float bearing 3; ? double odometer 4; ? float speed 5",
    "TripDescriptor": "? string trip_id 1; ? string start_time 2; ? string start_date 3; ? <TripRelationship> schedule_relationship 4; ? string route_id 5; ? uint32 direction_id 6; ? ModifiedTripSelector modified_trip 7",
    "ModifiedTripSelector": "? string modifications_id 1; ? string affected_trip_id 2; ? string start_time 3; ? string start_date 4",
    "VehicleDescriptor": "? string id 1; ? string label 2; ? string license_plate 3; ? <WheelchairAccessible> wheelchair_accessible 4",
    "EntitySelector": "? string agency_id 1; ? string route_id 2; ? int32 route_type 3; ? TripDescriptor trip 4; ? string stop_id 5; ? uint32 direction_id 6",
    "Translation": "! string text 1; ? string language 2",
    "TranslatedString": "* Translation translation 1",
    "LocalizedImage": "! string url 1; ! string media_type 2; ? string language 3",
    "TranslatedImage": "* LocalizedImage localized_image 1",
    "Shape": "? string shape_id 1; ? string encoded_polyline 2",
    "Stop": "? string stop_id 1; ? TranslatedString stop_code 2; ? TranslatedString stop_name 3; ? TranslatedString tts_stop_name 4; ? TranslatedString stop_desc 5; ? float stop_lat 6; ? float stop_lon 7; ? string zone_id 8; ? TranslatedString stop_url 9; ? string parent_station 11; ? string stop_timezone 12; ? <WheelchairBoarding> wheelchair_boarding 13; ? string level_id 14; ? TranslatedString platform_code 15",
    "TripModifications": "* SelectedTrips selected_trips 1; * string start_times 2; * string service_dates 3; * Modification modifications 4",
    "SelectedTrips": "* string trip_ids 1; ? string shape_id 2",
    "Modification": "? StopSelector start_stop_selector 1; ? StopSelector end_stop_selector 2; ? int32 propagated_modification_delay 3; * ReplacementStop replacement_stops 4; ? string service_alert_id 5; ? uint64 last_modified_time 6",
    "StopSelector": "? uint32 stop_sequence 1; ? string stop_id 2",
    "ReplacementStop": "? int32 travel_time_to_stop 1; ? string stop_id 2",
}
# Its enumerations, names in the order of their numbers; the first number stands before the colon.
ENUMS = {
    "Incrementality": "0: FULL_DATASET DIFFERENTIAL",
    "StopRelationship": "0: SCHEDULED SKIPPED NO_DATA UNSCHEDULED",
    "OccupancyStatus": "0: EMPTY MANY_SEATS_AVAILABLE FEW_SEATS_AVAILABLE STANDING_ROOM_ONLY CRUSHED_STANDING_ROOM_ONLY FULL NOT_ACCEPTING_PASSENGERS NO_DATA_AVAILABLE NOT_BOARDABLE",
    "VehicleStopStatus": "0: INCOMING_AT STOPPED_AT IN_TRANSIT_TO",
    "CongestionLevel": "0: UNKNOWN_CONGESTION_LEVEL RUNNING_SMOOTHLY STOP_AND_GO CONGESTION SEVERE_CONGESTION",
    "Cause": "1: UNKNOWN_CAUSE OTHER_CAUSE TECHNICAL_PROBLEM STRIKE DEMONSTRATION ACCIDENT HOLIDAY WEATHER MAINTENANCE CONSTRUCTION POLICE_ACTIVITY MEDICAL_EMERGENCY",
    "Effect": "1: NO_SERVICE REDUCED_SERVICE SIGNIFICANT_DELAYS DETOUR ADDITIONAL_SERVICE MODIFIED_SERVICE OTHER_EFFECT UNKNOWN_EFFECT STOP_MOVED NO_EFFECT ACCESSIBILITY_ISSUE",
    "SeverityLevel": "1: UNKNOWN_SEVERITY INFO WARNING SEVERE",
    "TripRelationship": "0: SCHEDULED ADDED UNSCHEDULED CANCELED - REPLACEMENT DUPLICATED DELETED NEW",
    "WheelchairAccessible": "0: NO_VALUE UNKNOWN WHEELCHAIR_ACCESSIBLE WHEELCHAIR_INACCESSIBLE",
    "WheelchairBoarding": "0: UNKNOWN AVAILABLE NOT_AVAILABLE",
}
PACKAGE = "transit_realtime"
SNAPSHOT = "provider string, url string, fetch_time timestamp, content binary"
#: What a fetch gives: one that failed has no content, but says why.
FETCHED = f"{SNAPSHOT}, error string"
#: Columns of decoded entities before the payload keys.
HEAD = ("provider", "url", "fetch_time", "entityId")


@lru_cache(maxsize=1)
def feed_message() -> type:
    """The class of a whole feed."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    kinds = descriptor_pb2.FieldDescriptorProto
    scalars = {"string": kinds.TYPE_STRING, "bool": kinds.TYPE_BOOL, "uint64": kinds.TYPE_UINT64, "int64": kinds.TYPE_INT64, "uint32": kinds.TYPE_UINT32, "int32": kinds.TYPE_INT32, "float": kinds.TYPE_FLOAT, "double": kinds.TYPE_DOUBLE}
    labels = {"!": kinds.LABEL_REQUIRED, "?": kinds.LABEL_OPTIONAL, "*": kinds.LABEL_REPEATED}
    file = descriptor_pb2.FileDescriptorProto(name=f"{PACKAGE}.proto", package=PACKAGE, syntax="proto2")
    for name, listed in ENUMS.items():
        first, _, values = listed.partition(":")
        # every enumeration has a message around it, so that equal value names do not clash
        enum = file.message_type.add(name=f"{name}Scope").enum_type.add(name=name)
        for i, value in enumerate(values.split(), int(first)):
            if value != "-":
                enum.value.add(name=value, number=i)
    for name, listed in MESSAGES.items():
        message = file.message_type.add(name=name)
        for line in listed.split("; "):
            label, kind, field, number = line.split()
            new = message.field.add(name=field, number=int(number), label=labels[label])
            if kind in scalars:
                new.type = scalars[kind]
            elif kind[0] == "<":
                new.type, new.type_name = kinds.TYPE_ENUM, f".{PACKAGE}.{kind[1:-1]}Scope.{kind[1:-1]}"
            else:
                new.type, new.type_name = kinds.TYPE_MESSAGE, f".{PACKAGE}.{kind}"
        message.extension_range.add(start=1000, end=2000)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.FeedMessage"))


def entities_of(content: bytes, keys: list[str]) -> Iterator[dict]:
    """Every entity of a feed as ``{"entityId": ..., key: JSON}`` with those payloads that it has among ``keys``. Broken data raises."""
    from google.protobuf.json_format import MessageToDict

    feed = feed_message()()
    feed.ParseFromString(content)
    for entity in feed.entity:
        row = {"entityId": entity.id}
        for field, value in entity.ListFields():
            if field.json_name in keys:
                row[field.json_name] = json.dumps(MessageToDict(value), ensure_ascii=False)
        yield row


def decode(snapshots: DataFrame, services: list[str] | None = None, on_error: str = "raise") -> DataFrame:
    """(provider, url, fetch_time, content) to one row per entity: ``HEAD`` and a JSON column per requested service's payload key.

    Only requested payloads are turned into JSON; entities without any are left out. A snapshot that cannot be decoded
    fails the query, or with ``on_error="skip"`` gives nothing at all, as does null content.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error is raise or skip, not {on_error!r}")
    keys = [SERVICES[s].key for s in services or SERVICES]
    own = snapshots.select("provider", "url", F.col("fetch_time").cast("timestamp").alias("fetch_time"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from google.protobuf.message import DecodeError

        for batch in batches:
            for i, content in enumerate(batch.column("content")):
                try:
                    rows = [r for r in entities_of(content.as_py(), keys) if len(r) > 1] if content.is_valid else []
                except DecodeError:
                    if on_error == "raise":
                        raise
                    rows = []
                for at in range(0, len(rows), 5000):
                    some = rows[at : at + 5000]
                    take = pa.array([i] * len(some))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(n).take(take) for n in HEAD[:3]), *(pa.array([r.get(k) for r in some], pa.string()) for k in ("entityId", *keys))], [*HEAD, *keys]
                    )

    return own.mapInArrow(run, "provider string, url string, fetch_time timestamp, " + ", ".join(f"{k} string" for k in ("entityId", *keys)))


def fetch(url: str, timeout: float = 60.0) -> bytes:
    """The body of a GET; an error status raises."""
    with urlopen(Request(url, headers={"User-Agent": "transitlake"}), timeout=timeout) as response:  # noqa: S310
        return response.read()


class _Url(InputPartition):
    def __init__(self, provider: str, url: str):
        self.provider, self.url = provider, url


class FeedSource(DataSource):
    """``spark.read.format("transit_feed")``: option ``urls`` is JSON, a list of [provider, url]; a task and a row per URL.

    A URL that cannot be fetched has null content, which decodes to nothing, and the reason in ``error``.

    ``fetch_time``, in epoch seconds, is one instant for all; without it, that of planning. ``timeout`` is in seconds.
    """

    @classmethod
    def name(cls) -> str:
        return "transit_feed"

    def schema(self) -> str:
        return FETCHED

    def reader(self, schema) -> DataSourceReader:
        return _FeedReader(dict(self.options))


class _FeedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        low = {k.lower(): v for k, v in options.items()}
        self.urls = json.loads(low["urls"])
        self.at = float(low.get("fetch_time") or datetime.now(timezone.utc).timestamp())
        self.timeout = float(low.get("timeout", 60))

    def partitions(self) -> list[InputPartition]:
        return [_Url(p, u) for p, u in self.urls]

    def read(self, partition: _Url) -> Iterator[tuple]:
        content = error = None
        try:
            content = fetch(partition.url, self.timeout)
        except (OSError, HTTPException, ValueError) as e:  # the other URLs of the batch are not to suffer
            error = f"{type(e).__name__}: {e}"
        yield partition.provider, partition.url, datetime.fromtimestamp(int(self.at), timezone.utc), content, error


def http_snapshots(spark: SparkSession, urls: list[tuple[str, str]], fetch_time: float | None = None, timeout: float = 60.0) -> DataFrame:
    """Snapshots fetched now, one per (provider, url)."""
    spark.dataSource.register(FeedSource)
    reader = spark.read.format("transit_feed").option("urls", json.dumps(urls)).option("timeout", str(timeout))
    return (reader.option("fetch_time", str(fetch_time)) if fetch_time is not None else reader).load()


def file_snapshots(spark: SparkSession, path: str, provider: str, pattern: str = "*.pb") -> DataFrame:
    """Snapshots from stored bodies; a file's change time is its fetch time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.lit(provider).alias("provider"), F.col("path").alias("url"), F.col("modificationTime").alias("fetch_time"), "content")
