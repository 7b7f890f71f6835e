"""Passes derived from the ``events`` table by fixed rules; ``oracle.py`` states the same rules in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T0 = 1704067200000000  # 2024-01-01 UTC in microseconds

PASS_COLUMNS = [
    "event_id", "arrival_seq", "gcxh", "station_id", "hphm", "hphm_mask", "fxlx", "hpzl", "gcsj", "adcode", "xzqhmc",
    "kkmc", "clppxh", "ingest_time",
]


def passes(spark: SparkSession, sf_dir: str, *, dealt: bool = False) -> DataFrame:
    """All events as passes, plus a late second delivery of every eleventh. One scan of the table; ``dealt`` spreads what
    it reads over all cores, as a file of one row group is read by one task."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "props")
    if dealt:
        events = events.repartition(spark.sparkContext.defaultParallelism)
    e, u = F.col("event_id"), F.col("user_id")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int") % 6
    offset = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(T0)
    gcsj = F.timestamp_micros(F.lit(T0) + F.call_function("div", offset, F.lit(100).cast("bigint")))
    delivery = F.explode(F.when(e % 11 == 0, F.array(F.lit(0), F.lit(21))).otherwise(F.array(F.lit(0))))
    return (
        events.select("*", delivery.alias("delay"), gcsj.alias("gcsj"))
        .select(
            "event_id",
            (e * 2 + F.col("delay")).alias("arrival_seq"),
            F.when(e % 5 == 0, F.lit(0)).otherwise(e + 1).cast("bigint").alias("gcxh"),
            F.when(e % 97 == 0, F.lit(0)).otherwise(101 + (e * 7) % 20).cast("int").alias("station_id"),
            F.when(u % 50 == 0, F.lit(None))
            .when(u % 50 == 1, F.lit("   "))
            .otherwise(F.concat(F.lit("苏A"), F.lpad(u.cast("string"), 5, "0")))
            .alias("hphm"),
            F.when(e % 3 == 0, F.lit(None))
            .when(e % 3 == 1, F.lit(""))
            .otherwise(F.concat(F.lit("苏A***"), (u % 10).cast("string")))
            .alias("hphm_mask"),
            F.when(F.col("event_type").isin("view", "purchase"), F.lit("上行"))
            .when(F.col("event_type") == "error", F.lit(None))
            .otherwise(F.lit("下行"))
            .alias("fxlx"),
            F.when(k == 0, F.lit(None)).when(k == 1, F.lit(" 1 ")).when(k == 2, F.lit("2")).when(k == 3, F.lit("13"))
            .when(k == 4, F.lit("-")).otherwise(F.lit("新能源"))
            .alias("hpzl"),
            "gcsj",
            (320000 + u % 13).cast("int").alias("adcode"),
            F.when(u % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("D"), u % 13)).alias("xzqhmc"),
            F.when(e % 8 == 0, F.lit(None)).otherwise(F.concat(F.lit("K"), e % 20)).alias("kkmc"),
            F.when(e % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit("M"), e % 9)).alias("clppxh"),
            (F.col("gcsj") + F.expr("make_dt_interval(0, 0, 0, 2 + if(delay > 0, 30, 0))")).alias("ingest_time"),
        )
    )


def _text(name: str) -> Column:
    return F.concat(F.lit(f'"{name}":"'), F.col(name), F.lit('"'))


def message(df: DataFrame) -> Column:
    """JSON text of a pass, some of it spoilt by event id: no JSON, a bad time, numbers as text, no time."""
    e = F.col("event_id")
    quote = F.when((e % 47 == 0) & (e % 43 != 0), F.lit('"')).otherwise(F.lit(""))
    iso = F.date_format("gcsj", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    time = F.when(e % 43 == 0, F.lit('"gcsj":"bad-time"')).when((e % 53 == 0) & (e % 47 != 0), F.lit(None)).otherwise(
        F.concat(F.lit('"gcsj":"'), iso, F.lit('"'))
    )
    parts = F.concat_ws(
        ",",
        F.concat(F.lit('"gcxh":'), quote, F.col("gcxh"), quote),
        _text("xzqhmc"),
        F.concat(F.lit('"adcode":'), F.col("adcode")),
        _text("kkmc"),
        F.concat(F.lit('"station_id":'), quote, F.col("station_id"), quote),
        _text("fxlx"),
        time,
        _text("hpzl"),
        _text("hphm"),
        _text("hphm_mask"),
        _text("clppxh"),
    )
    return F.when(e % 41 == 0, F.lit("not-json")).otherwise(F.concat(F.lit("{"), parts, F.lit("}")))


def records(spark: SparkSession, sf_dir: str, *, dealt: bool = False) -> DataFrame:
    """The passes as source records ``value, ingest_time, arrival_seq``; ``dealt`` as in :func:`passes`."""
    df = passes(spark, sf_dir, dealt=dealt)
    return df.select(message(df).alias("value"), "ingest_time", "arrival_seq")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District dictionary from the nation and region tables, keyed by the passes' district codes."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    both = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    key = (F.lit(320000) + F.col("n_nationkey")).cast("int").alias("key")
    fields = F.explode(F.array(
        F.struct(F.lit("name").alias("field"), F.col("n_name").alias("value")),
        F.struct(F.lit("region").alias("field"), F.col("r_name").alias("value")),
    ))
    return both.select(key, fields.alias("f")).select("key", "f.field", "f.value")
