"""Grouping of landed files, and which groups are ready to be compacted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timebucket as tb


def with_buckets(files: DataFrame, minutes: int, zone: str = "UTC") -> DataFrame:
    """``files`` (path, ...) with ``local_time``, ``group_time`` and ``start``, the bucket's start as an instant on the file's own side of a change of clocks.

    Names without a time are left out.
    """
    rows = files.withColumn("local_time", tb.parse_path(F.col("path"))).where("local_time IS NOT NULL")
    rows = rows.withColumn("group_time", tb.bucket(F.col("local_time"), minutes))
    return rows.withColumn("start", tb.instant(F.col("local_time"), zone) - (F.col("local_time") - F.col("group_time")))


def closed(rows: DataFrame, minutes: int, keys: list[str], time: str = "group_time") -> DataFrame:
    """The rows whose bucket is closed: a row of the same keys lies in a bucket that begins at or after its end.

    One aggregation to a row per key and a join back on the keys, which broadcasts where the keys are few: no group is
    brought into one task, however large.
    """
    last = rows.groupBy(*keys).agg(F.max(time).alias("_last"))
    return rows.join(last, keys).where(F.col("_last") >= tb.bucket_end(F.col(time), minutes)).drop("_last")


def closed_groups(files: DataFrame, minutes: int, zone: str = "UTC", force: bool = False) -> DataFrame:
    """(directory, path, group_time) of the files whose bucket is closed within their directory; ``force`` closes all.

    A bucket whose files lie on both sides of a change of clocks ends with the later of them.
    """
    rows = with_buckets(files.select("path"), minutes, zone).withColumn("directory", F.regexp_replace("path", "/[^/]*$", ""))
    if not force:
        groups = rows.groupBy("directory", "group_time").agg(F.max("start").alias("start"))
        rows = rows.join(closed(groups, minutes, ["directory"], "start").select("directory", "group_time"), ["directory", "group_time"], "left_semi")
    return rows.select("directory", "path", "group_time")
