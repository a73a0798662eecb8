from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from transitlake.sources import feed
from transitlake.sources.storage import create_storage
from transitlake.streaming import windows as W


def test_a_stream_lands_snapshots_by_bucket(spark, tmp_path):
    source = tmp_path / "in"
    m = feed.feed_message()()
    m.header.gtfs_realtime_version = "2.0"
    m.entity.add(id="d").shape.shape_id = "s"
    rows = [("p", "u", datetime(2024, 1, 1, h, 10, tzinfo=timezone.utc), c) for h, c in ((1, m.SerializeToString()), (1, b"\xff\xff\xff"), (2, m.SerializeToString()))]
    spark.createDataFrame(rows, feed.SNAPSHOT).write.parquet(str(source))
    store = create_storage(spark, "filesystem", base_directory=str(tmp_path / "out"))
    for _ in range(2):  # a second run has nothing new
        stream = spark.readStream.schema(feed.SNAPSHOT).parquet(str(source))
        W.land_stream(stream, store, ["Shape"], str(tmp_path / "state"), 60, "Europe/Amsterdam").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out/stream/Shape")).select("entityId", "date", "group_time").orderBy("group_time").collect()
    assert [(r.entityId, str(r.date), r.group_time) for r in got] == [("d", "2024-01-01", "02-00-00"), ("d", "2024-01-01", "03-00-00")]


def test_buckets_must_divide_a_day(spark):
    with pytest.raises(ValueError, match="divide"):
        W.closed_counts(spark.range(1).withColumn("ts", F.current_timestamp()), 50)


def test_accumulate_flushes_together(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    q = W.accumulate(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "state"), 1)
    q.processAllAvailable()
    q.stop()
    assert sum(seen) == 5
