from datetime import datetime, timedelta

import pytest
import pytz
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlake.functions import timebucket as tb

NAIVE = st.datetimes(datetime(2020, 1, 1), datetime(2030, 1, 1)).map(lambda d: d.replace(microsecond=0))
few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def times(spark, values):
    return spark.createDataFrame([(v.strftime("%Y-%m-%d %H:%M:%S"),) for v in values], "s string").select(F.to_timestamp("s").alias("t"))


def text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@few
@given(st.lists(NAIVE, min_size=1, max_size=20), st.sampled_from([1, 5, 15, 50, 60, 77, 1440, 2880]))
def test_bucket_counts_from_local_midnight(spark, values, minutes):
    rows = times(spark, values).select("t", text(tb.bucket(F.col("t"), minutes)).alias("b"), text(tb.bucket_end(tb.bucket(F.col("t"), minutes), minutes)).alias("e")).collect()
    for v, r in zip(values, rows, strict=True):
        m = (v.hour * 60 + v.minute) // minutes * minutes
        start = datetime(v.year, v.month, v.day) + timedelta(minutes=m)
        assert r.b == str(start) and r.e == str(start + timedelta(minutes=minutes))


@few
@given(st.lists(NAIVE, min_size=1, max_size=20))
def test_path_round_trip(spark, values):
    path = tb.landing_path(F.lit("p"), F.lit("S"), F.col("t"))
    rows = times(spark, values).select(path.alias("p"), text(tb.parse_path(path)).alias("back"), text(tb.parse_path(F.regexp_replace(path, "individual/", "individual/individual_"))).alias("legacy"), text(tb.parse_path(F.regexp_replace(path, r"\.parquet", "~0a1b2c3d.parquet"))).alias("second")).collect()
    for v, r in zip(values, rows, strict=True):
        assert r.p == f"p/S/individual/{v:%Y-%m-%d_%H-%M-%S}.parquet"
        assert r.back == r.legacy == r.second == str(v)


@pytest.mark.parametrize("name", ["x.parquet", "2024-13-01_00-00-00.parquet", "2024-01-01.parquet", "", "2024-01-01_00-00-00.csv", "2024-01-01_00-00-0.parquet"])
def test_names_without_a_time_are_null(spark, name):
    assert spark.range(1).select(tb.parse_path(F.lit(f"a/{name}"))).first()[0] is None


@pytest.mark.parametrize("zone", ["Europe/Amsterdam", "America/New_York", "Europe/London", "Australia/Lord_Howe", "Asia/Kolkata"])
def test_instants_take_standard_time_when_ambiguous(spark, zone):
    values = [datetime(2023, m, d) + timedelta(minutes=10 * k) for m, d in ((3, 12), (3, 26), (4, 2), (10, 1), (10, 29), (11, 5), (6, 1)) for k in range(144)]
    rows = times(spark, values).select(F.unix_seconds(tb.instant(F.col("t"), zone)).alias("u")).collect()
    tz = pytz.timezone(zone)
    assert [r.u for r in rows] == [int(tz.localize(v).timestamp()) for v in values]


def test_parse_int(spark):
    rows = spark.createDataFrame([("5",), (" 7 ",), ("x",), (None,), ("-3",), ("1.5",)], "s string").select(tb.parse_int(F.col("s")).alias("v")).collect()
    assert [r.v for r in rows][:5] == [5, 7, None, None, -3]


def test_output_path():
    at = datetime(2024, 1, 31, 23, 0)
    assert tb.output_path("p", "S", at, 60) == "p/S/2024-01-31/23-00-00_to_00-00-00.parquet"
    assert tb.output_path("p", "S", at, 5, "{group_time}.pq", "%H%M") == "p/S/2024-01-31/2300.pq"


def test_bucket_refuses_no_minutes():
    with pytest.raises(ValueError, match="positive"):
        tb.bucket(None, 0)
