import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from passgrid.functions import geo, json, text, time


def evaluate(spark, column, **values):
    """The value of ``column`` on one row with the given columns."""
    row = spark.range(1).select(*[v.alias(k) for k, v in values.items()]).select(column.alias("out")).first()
    return row[0]


def s(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "value, expected",
    [(None, False), ("", False), ("  ", False), ("　", False), (" \n\t", False), (" ", True), (" a", True),
     ("a\n", True)],
)
def test_has_text_follows_unicode_whitespace(spark, value, expected):
    assert evaluate(spark, text.has_text(F.col("c")), c=s(value)) is expected


@pytest.mark.parametrize(
    "code, expected",
    [(None, "未知车型"), ("1", "小型汽车"), (" 1 ", "小型汽车"), ("2\n", "大型汽车"), ("\x0013", "农用运输车"),
     ("-", "未知车型"), ("", ""), ("   ", ""), (" 新能源 ", "新能源"), ("　1", "　1")],
)
def test_vehicle_type(spark, code, expected):
    assert evaluate(spark, text.vehicle_type(F.col("c")), c=s(code)) == expected


@pytest.mark.parametrize(
    "mask, plate, detail, alert",
    [
        ("苏A**", "苏A12345", "苏A**", "苏A**"),
        (" ", "苏A12345", "苏A12****", "苏A12****"),
        (None, "苏A", "苏A****", "苏A****"),
        ("", "", "UNKNOWN", "UNKNOWN"),
        (None, None, "UNKNOWN", "UNKNOWN"),
        ("　", "   ", "   ****", "UNKNOWN"),
    ],
)
def test_mask_plate(spark, mask, plate, detail, alert):
    m, p = F.col("m"), F.col("p")
    assert evaluate(spark, text.mask_plate(m, p), m=s(mask), p=s(plate)) == detail
    assert evaluate(spark, text.mask_plate(m, p, blank_is_absent=True), m=s(mask), p=s(plate)) == alert


def test_dedup_key(spark):
    key = text.dedup_key(F.col("g"), F.col("p"), F.col("st"), F.col("t"))
    t = F.timestamp_micros(F.lit(5_999_999))
    one = dict(p=s("P"), st=F.lit(7), t=t)
    assert evaluate(spark, key, g=F.lit(12), **one) == "id:12"
    assert evaluate(spark, key, g=F.lit(0), **one) == "P|7|5"
    assert evaluate(spark, key, g=F.lit(-3), **{**one, "p": s(None)}) == "|7|5"


UTC = timezone.utc


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-01T00:00:00Z", datetime(2024, 1, 1, tzinfo=UTC)),
        ("2024-01-01t00:00:00z", datetime(2024, 1, 1, tzinfo=UTC)),
        ("2024-01-01T08:00:00+08:00", datetime(2024, 1, 1, tzinfo=UTC)),
        ("2024-01-01T00:00:00.123456789Z", datetime(2024, 1, 1, 0, 0, 0, 123456, tzinfo=UTC)),
        ("2024-12-31T23:59:60Z", datetime(2024, 12, 31, 23, 59, 59, tzinfo=UTC)),
        ("2024-01-01T24:00:00Z", datetime(2024, 1, 2, tzinfo=UTC)),
        ("1960-02-29T00:00:00.5-01:30", datetime(1960, 2, 29, 1, 30, 0, 500000, tzinfo=UTC)),
        ("2024-01-01 10:00:00", None),
        ("2024-01-01T10:00:00", None),
        ("2024-01-01T10:00Z", None),
        ("2024-01-01T24:00:01Z", None),
        ("2023-02-29T10:00:00Z", None),
        ("2024-01-01T10:00:00+08", None),
        ("2024-01-01T10:00:00+0800", None),
        ("2024-01-01T10:00:00Z\n", None),
        ("2024", None),
        ("1704067200", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_instant_is_strict(spark, value, expected):
    micros = evaluate(spark, F.unix_micros(time.parse_instant(F.col("c"))), c=s(value))
    if expected is None:
        assert micros is None
    else:
        assert micros == round(expected.timestamp() * 1_000_000)


@pytest.mark.parametrize("micros, bucket", [(1_999_999, 1), (0, 0), (-1_500_000, -1), (-999_000, 0)])
def test_second_bucket_truncates_toward_zero(spark, micros, bucket):
    assert evaluate(spark, time.second_bucket(F.col("t")), t=F.timestamp_micros(F.lit(micros))) == bucket


def test_time_gap_floors_each_side(spark):
    gap = time.time_gap_sec(F.col("a"), F.col("b"))
    at = lambda micros: F.timestamp_micros(F.lit(micros))
    assert evaluate(spark, gap, a=at(2_100_000), b=at(1_900_000)) == 1
    assert evaluate(spark, gap, a=at(1_000_000), b=at(1_900_000)) == 0
    assert evaluate(spark, gap, a=at(-500_000), b=at(500_000)) == 1


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine(spark):
    km = geo.haversine_km(*[F.col(c) for c in "abcd"])
    point = dict(a=F.lit(32.1), b=F.lit(118.7), c=F.lit(31.41), d=F.lit(120.82))
    assert evaluate(spark, km, **point) == pytest.approx(haversine(32.1, 118.7, 31.41, 120.82), abs=1e-9)
    assert evaluate(spark, km, **{**point, "c": F.lit(32.1), "d": F.lit(118.7)}) == 0.0
    assert evaluate(spark, km, **{**point, "d": F.lit(float("nan"))}) == 0.0


def test_speed_and_confidence(spark):
    speed = geo.implied_speed_kmh(F.col("d"), F.col("g"))
    assert evaluate(spark, speed, d=F.lit(100.0), g=F.lit(1800).cast("bigint")) == 200.0
    assert evaluate(spark, speed, d=F.lit(0.0), g=F.lit(0).cast("bigint")) == math.inf
    assert evaluate(spark, geo.is_overspeed(F.col("v"), 140.0), v=F.lit(140.0)) is False
    assert evaluate(spark, geo.is_overspeed(F.col("v"), 140.0), v=F.lit(math.nan)) is False
    assert evaluate(spark, geo.is_overspeed(F.col("v"), 140.0), v=F.lit(math.inf)) is True
    confidence = geo.clone_confidence(F.col("v"), 140.0)
    assert evaluate(spark, confidence, v=F.lit(154.0)) == pytest.approx(0.6)
    assert evaluate(spark, confidence, v=F.lit(math.inf)) == 1.0


def test_order_pair(spark):
    first, second = geo.order_pair(F.col("ct"), F.col("cs"), F.col("pt"), F.col("ps"))
    pair = F.concat_ws(",", first, second)
    at = lambda micros: F.timestamp_micros(F.lit(micros))
    stations = dict(cs=F.lit(1), ps=F.lit(2))
    assert evaluate(spark, pair, ct=at(10), pt=at(9), **stations) == "2,1"
    assert evaluate(spark, pair, ct=at(9), pt=at(10), **stations) == "1,2"
    assert evaluate(spark, pair, ct=at(10), pt=at(10), **stations) == "1,2"


def test_has_geo(spark):
    both = geo.has_geo(F.col("a"), F.col("b"))
    assert evaluate(spark, both, a=F.lit(0.0), b=F.lit(0.0)) is False
    assert evaluate(spark, both, a=F.lit(0.0), b=F.lit(1.0)) is True


def test_histogram_json_sorts_keys(spark):
    histogram = F.create_map(F.lit("b"), F.lit(2), F.lit(""), F.lit(1), F.lit("a"), F.lit(3))
    assert evaluate(spark, json.histogram_json(F.col("m")), m=histogram) == '{"":1,"a":3,"b":2}'


def test_json_text_strict_mode_fails(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert evaluate(spark, json.from_json_text(F.col("c"), schema)["a"], c=s("nope")) is None
    with pytest.raises(Exception, match="(?i)malformed"):
        evaluate(spark, json.from_json_text(F.col("c"), schema, strict=True)["a"], c=s("nope"))
