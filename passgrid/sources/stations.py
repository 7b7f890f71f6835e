"""The station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- Fixed values: the stations (id, name, latitude, longitude) ----------------------------------------------------

STATIONS = [
    (101, "南京江北站", 32.100, 118.700),
    (102, "苏州阳澄湖站", 31.410, 120.820),
    (103, "无锡惠山站", 31.650, 120.280),
    (104, "北京大兴机场站", 39.510, 116.410),
    (105, "上海浦东川沙站", 31.210, 121.690),
    (106, "广州花都站", 23.400, 113.220),
    (107, "深圳南山站", 22.540, 113.930),
    (108, "重庆绕城北站", 29.720, 106.630),
    (109, "成都绕城东站", 30.610, 104.120),
    (110, "济南东站", 36.670, 117.120),
    (111, "郑州航空港站", 34.530, 113.840),
    (112, "武汉北三环站", 30.760, 114.320),
    (113, "西安绕城南站", 34.000, 108.900),
    (114, "合肥肥东站", 31.870, 117.460),
    (115, "福州南通道站", 26.050, 119.300),
    (116, "杭州临安站", 30.230, 119.720),
    (117, "乌鲁木齐绕城站", 43.900, 87.500),
    (118, "拉萨柳梧站", 29.650, 91.120),
]

STATION_SCHEMA = T.StructType([
    T.StructField("stationId", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])


def default_stations(spark: SparkSession) -> DataFrame:
    """The built-in stations as ``station_id, name, lat, lon``."""
    return spark.createDataFrame(STATIONS, "station_id int, name string, lat double, lon double")


def load_stations(spark: SparkSession, path: str) -> DataFrame:
    """Stations from a JSON array ``[{stationId, name, lat, lon}, ...]``.

    Null entries are skipped, the last of several entries with one id wins, missing numbers are 0. Fails when nothing
    is left. The file is one document of bounded size, read whole so that entry order is known.
    """
    entry = F.posexplode(F.from_json("value", T.ArrayType(STATION_SCHEMA))).alias("pos", "s")
    stations = (
        spark.read.text(path, wholetext=True)
        .select(entry)
        .filter(F.col("s").isNotNull())
        .groupBy(F.coalesce("s.stationId", F.lit(0)).alias("station_id"))
        .agg(F.max_by("s", "pos").alias("s"))
        .select(
            "station_id",
            F.col("s.name").alias("name"),
            F.coalesce("s.lat", F.lit(0.0)).alias("lat"),
            F.coalesce("s.lon", F.lit(0.0)).alias("lon"),
        )
    )
    if stations.isEmpty():
        raise ValueError(f"no station found in {path}")
    return stations
