"""Structured Streaming forms of the bucket operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timebucket as tb
from ..operators.entities import service_table
from ..plans.schemas import SERVICES
from ..sources import feed
from ..sources.sinks import parquet_options
from ..sources.storage import Storage


def closed_counts(events: DataFrame, minutes: int, time: str = "ts", keys: list[str] | None = None) -> DataFrame:
    """(keys, group_time, n): rows per closed bucket; in append mode a bucket comes out once, when a later one has begun.

    The watermark has no delay and is one for the whole query: a query per provider and service keeps a busy one from
    closing the buckets of a slow one. Later rows of a closed bucket are dropped. The bucket size must divide a day.
    """
    if 1440 % minutes:
        raise ValueError("streaming buckets must divide a day; others restart at midnight, which a window cannot")
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", "0 seconds")
    counted = timed.groupBy(*(keys or []), F.window("_t", f"{minutes} minutes")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*(keys or []), F.col("window.start").alias("group_time"), "n")


def bucketed(table: DataFrame, minutes: int, time: Column, zone: str = "UTC") -> DataFrame:
    """``table`` with ``date`` and ``group_time`` (a string) of a row's bucket, to partition a sink by."""
    start = tb.bucket(tb.local_time(time, zone), minutes)
    return table.withColumn("date", F.date_format(start, "yyyy-MM-dd")).withColumn("group_time", F.date_format(start, "HH-mm-ss"))


def land_stream(snapshots: DataFrame, storage: Storage, services: list[str], checkpoint: str, minutes: int = 60, zone: str = "UTC", trigger: dict | None = None, on_error: str = "skip"):
    """Lands a stream of snapshots: each micro-batch is decoded once and appended, by service, provider and bucket.

    A batch that is run again replaces its own files, named by its number, and nothing else.
    """

    def write(batch: DataFrame, number: int) -> None:
        entities = feed.decode(batch, services, on_error).persist()
        try:
            for service in services:
                rows = service_table(entities.select("provider", "url", "fetch_time", "entityId", SERVICES[service].key), service)
                out = bucketed(rows, minutes, F.timestamp_seconds("fetchTime"), zone)
                target = storage.uri(f"stream/{service}/batch={number}")
                out.write.mode("overwrite").partitionBy("date", "group_time").options(**parquet_options("snappy")).parquet(target)
        finally:
            entities.unpersist()

    return snapshots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def accumulate(stream: DataFrame, flush: Callable[[DataFrame, int], None], checkpoint: str, seconds: int):
    """The buffer as a stream: rows gather for so many seconds and are then flushed together, once."""
    return stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
