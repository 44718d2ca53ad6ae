import datetime as dt

from pyspark.sql import functions as F

from trendflow.functions.coerce import normalise_region, try_long
from trendflow.functions.dates import parse_trending_date
from trendflow.functions.metrics import engagement_rate, exact_avg, like_ratio
from trendflow.functions.paths import decode_key, region_from_path


def test_try_long_tolerant(spark):
    df = spark.createDataFrame([("1",), ("x",), ("1.5",), (None,), ("-7",), ("Infinity",),
                                ("9007199254740993",), ("1e3",)], "v string")
    got = [r[0] for r in df.select(try_long("v")).collect()]
    assert got == [1, None, 1, None, -7, None, 9007199254740993, 1000]


def test_parse_trending_date_edges(spark):
    rows = [("17.14.11",), ("2017-11-14",), ("17.32.13",), ("garbage",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    got = [r[0] for r in df.select(parse_trending_date("d")).collect()]
    assert got == [dt.date(2017, 11, 14), dt.date(2017, 11, 14), None, None, None]


def test_region_normalised(spark):
    df = spark.createDataFrame([(" US ",), ("gb",)], "r string")
    assert [r[0] for r in df.select(normalise_region("r")).collect()] == ["us", "gb"]


def test_ratios_zero_negative_and_null_views(spark):
    df = spark.createDataFrame(
        [(0, 5, 1, 1), (-5, 5, 1, 1), (3, 1, 0, 0), (200, 10, 2, 3)],
        "views long, likes long, dislikes long, comment_count long")
    got = df.select(like_ratio().alias("l"), engagement_rate().alias("e")).collect()
    assert [(r.l, r.e) for r in got] == [(0.0, 0.0), (0.0, 0.0), (33.3333, 33.3333), (5.0, 7.5)]


def test_exact_avg_order_free(spark):
    vals = [(0.1,), (0.2,), (0.3,), (None,)]
    df = spark.createDataFrame(vals, "x double")
    # exact decimal sum (0.6) as double, divided by the count
    assert df.agg(exact_avg("x").alias("a")).first().a == 0.6 / 3
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(exact_avg("x").alias("a")).first().a is None


def test_region_from_path(spark):
    keys = [("landing/raw/region=US/us_category_id.json",),
            ("landing/raw/region%3DGB/date%3D2024-01-01/x.json",),
            ("landing/raw/x.json",),
            ("region=ca/a.json",),
            ("landing/region=/x.json",)]
    df = spark.createDataFrame(keys, "k string")
    got = [r[0] for r in df.select(region_from_path("k")).collect()]
    assert got == ["us", "gb", "unknown", "ca", "unknown"]


def test_decode_key_plus_and_malformed(spark):
    df = spark.createDataFrame([("a+b%3Dc",), ("bad%ZZ",)], "k string")
    assert [r[0] for r in df.select(decode_key("k")).collect()] == ["a b=c", "bad%ZZ"]


def test_exact_avg_of_extreme_ratio(spark):
    from trendflow.functions.metrics import exact_avg, percent_of_views

    df = spark.createDataFrame([(900_000_000_000_000, 1)], "likes long, views long")
    row = df.select(percent_of_views(df["likes"], df["views"]).alias("r")).agg(exact_avg("r").alias("m")).first()
    assert row["m"] == 9e16
