from datetime import datetime, timedelta

from pyspark.sql import functions as F

from transitlake.operators import files as G
from transitlake.operators.compact import judged, union_all
from transitlake.operators.files import closed_groups


def listing(spark, stamps, prefix=""):
    return spark.createDataFrame([(f"p/S/individual/{prefix}{t:%Y-%m-%d_%H-%M-%S}.parquet",) for t in stamps], "path string").withColumn("service", F.lit("S"))


def groups(files, minutes, zone="UTC", force=False):
    return {r.group_time: r.n for r in G.closed_groups(files, minutes, zone, force).groupBy("group_time").agg(F.count("path").alias("n")).collect()}


def test_an_hour_of_minutes_makes_four_groups(spark):
    start = datetime(2023, 1, 1, 12)
    files = listing(spark, [start + timedelta(minutes=i) for i in range(60)], "individual_")
    assert groups(files, 15, force=True) == {start + timedelta(minutes=15 * i): 15 for i in range(4)}
    assert groups(files, 15) == {start + timedelta(minutes=15 * i): 15 for i in range(3)}


def test_a_group_closes_when_a_later_one_begins(spark):
    start = datetime(2023, 1, 1)
    files = listing(spark, [start, start + timedelta(minutes=16), start + timedelta(minutes=29)])
    assert groups(files, 15) == {start: 1} and groups(files, 60) == {} and G.closed_groups(files, 60, force=True).count() == 3


def test_directories_close_for_themselves(spark):
    start = datetime(2023, 1, 1)
    files = listing(spark, [start, start + timedelta(minutes=20)])
    other = files.limit(1).withColumn("path", F.replace("path", F.lit("/S/"), F.lit("/T/")))
    assert {r.directory for r in G.closed_groups(files.union(other), 15).collect()} == {"p/S/individual"}


def test_unparseable_names_are_left_out(spark):
    bad = spark.createDataFrame([("p/S/individual/x.parquet", "S")], "path string, service string")
    assert G.with_buckets(bad, 15).isEmpty() and G.closed_groups(bad, 15, force=True).isEmpty()


def test_buckets_longer_than_a_day_close_after_their_minutes(spark):
    files = listing(spark, [datetime(2023, 1, 1, 5), datetime(2023, 1, 2, 5), datetime(2023, 1, 3, 1)])
    assert [r.group_time for r in closed_groups(files.select("path"), 2880).collect()] == [datetime(2023, 1, 1)]


def test_a_change_of_clocks_shortens_an_hour(spark):
    # 02:30 on that day is 01:30Z; the bucket of 01:00 began at 00:00Z... and the next begins an hour on
    files = listing(spark, [datetime(2023, 3, 26, 1, 10), datetime(2023, 3, 26, 3, 5)])
    found = closed_groups(files.select("path"), 60, "Europe/Amsterdam").collect()
    assert [r.group_time for r in found] == [datetime(2023, 3, 26, 1)]
    assert closed_groups(files.select("path"), 120, "Europe/Amsterdam").isEmpty()  # 00:00 to 02:00 is over only at 01:00Z, and 03:05's bucket began at 00:00Z


def test_judgement_of_schemas(spark):
    g = datetime(2024, 1, 1)
    rows = [(g, "1a", True, 0, "z"), (g, "1b", True, 3, "x"), (g, "1c", True, 3, "y"), (g, "1d", True, 0, "y"), (g, "1e", False, 0, ""), (g, "1f", True, 1, "x not null")]
    df = spark.createDataFrame(rows, "group_time timestamp, path string, readable boolean, n_rows long, footer string")
    assert {r.path: r.good for r in judged(df).collect()} == {"1a": True, "1b": True, "1c": False, "1d": True, "1e": False, "1f": False}
    assert {r.path: r.good for r in judged(df, "promote").collect()} == {"1a": True, "1b": True, "1c": True, "1d": True, "1e": False, "1f": True}
    merged = df.withColumn("path", F.concat(F.when(F.col("path") == "1b", "0").otherwise("1"), "path"))
    assert {r.path: r.good for r in judged(merged).collect()}["11f"]


def test_unions(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert sorted(tuple(r) for r in union_all([a, b], promote=True).collect()) == [(1, "x"), (2, None)]
    assert union_all([a, a]).count() == 2
    try:
        union_all([a, b])
    except ValueError as e:
        assert "differ" in str(e)
    else:
        raise AssertionError
