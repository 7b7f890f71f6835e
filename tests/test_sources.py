import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from passgrid.operators.dimension import fits_broadcast, join_dimension
from passgrid.operators.filters import filter_essential
from passgrid.sources.dictionary import dictionary_entries, lookup_entries, lookup_value
from passgrid.sources.passes import decode_passes, decode_passes_narrow, decode_rejects
from passgrid.sources.records import text_records
from passgrid.sources.stations import STATIONS, default_stations, load_stations

INGEST = datetime(2024, 5, 1, 12, 0, 0)


def records(spark, *values):
    return spark.createDataFrame([(i, v, INGEST) for i, v in enumerate(values)],
                                 "arrival_seq long, value string, ingest_time timestamp")


def decode_one(spark, message, decoder=decode_passes):
    rows = decoder(records(spark, message)).collect()
    return rows[0] if rows else None


REJECTS = ["not-json", "", "  ", None, "5", "[1]", '[{"station_id":5}]', "null", '{"station_id":101,"a":',
           "{'station_id':101}", '{"station_id":NaN}']


def test_rejects_are_the_rows_decoding_leaves_out(spark):
    good = ['{"station_id":101}', "{}", '{"station_id":101} trailing']
    df = records(spark, *REJECTS, *good)
    assert [r.value for r in decode_rejects(df).orderBy("arrival_seq").collect()] == REJECTS
    kept = decode_passes(df, keep=["arrival_seq"]).select("arrival_seq").collect()
    assert sorted(r[0] for r in kept) == list(range(len(REJECTS), len(REJECTS) + len(good)))
    assert filter_essential(decode_passes(df)).count() == 2


@pytest.mark.parametrize(
    "number, expected",
    [("101", 101), ('"101"', 101), ('" 101 "', 101), ("12.7", 12), ('"12.7"', 12), ("-3", -3), ("true", 1),
     ("false", 0), ('"true"', 0), ('"abc"', 0), ("null", 0), ("{}", 0), ("[7]", 0), ("1e2", 100), ('"99999999999"', 0),
     ('""', 0)],
)
def test_numbers_are_lenient(spark, number, expected):
    row = decode_one(spark, f'{{"gcxh":{number},"adcode":{number},"station_id":{number}}}')
    assert row.station_id == expected and row.adcode == expected
    if number != '"99999999999"':
        assert row.gcxh == expected


def test_text_fields(spark):
    row = decode_one(spark, '{"station_id":1,"hphm":"   ","fxlx":null,"hpzl":13,"kkmc":true,"kkmc":"last"}')
    assert (row.hphm, row.fxlx, row.hpzl, row.kkmc, row.clppxh) == ("   ", None, "13", "last", None)


@pytest.mark.parametrize(
    "time, full, narrow",
    [
        ('"2024-01-01T08:00:00+08:00"', datetime(2024, 1, 1), datetime(2024, 1, 1)),
        ("null", INGEST, INGEST),
        ('"2024-01-01 10:00:00"', INGEST, None),
        ('"bad"', INGEST, None),
        ("1704067200", INGEST, None),
    ],
)
def test_time_fallback(spark, time, full, narrow):
    message = f'{{"station_id":1,"gcsj":{time}}}'
    assert decode_one(spark, message).gcsj == full
    row = decode_one(spark, message, decode_passes_narrow)
    assert (row.gcsj if row else None) == narrow


def test_missing_time_is_the_ingest_time(spark):
    assert decode_one(spark, '{"station_id":1}').gcsj == INGEST
    assert decode_one(spark, '{"station_id":1}', decode_passes_narrow).gcsj == INGEST


def test_messages_are_parsed_once(spark):
    plan = filter_essential(decode_passes(records(spark, "{}")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_text_records(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"station_id":1}\nnope\n')
    df = text_records(spark, str(tmp_path), stream=False)
    assert df.columns == ["value", "ingest_time"]
    assert decode_passes(df).count() == 1 and decode_rejects(df).count() == 1


def test_kafka_options():
    """The Kafka package is not installed here, so only what is asked of it can be checked."""
    from passgrid.sources.records import kafka_records

    class Reader:
        def __init__(self):
            self.options = {}

        def format(self, name):
            self.options["format"] = name
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

        def load(self):
            raise LookupError

    class Session:
        read, readStream = Reader(), Reader()

    with pytest.raises(LookupError):
        kafka_records(Session, "kafka:9092", "passes", group_id="g", max_offsets_per_trigger=7)
    assert Session.readStream.options == {
        "format": "kafka", "kafka.bootstrap.servers": "kafka:9092", "subscribe": "passes",
        "startingOffsets": "earliest", "kafka.group.id": "g", "maxOffsetsPerTrigger": 7}
    with pytest.raises(LookupError):
        kafka_records(Session, "kafka:9092", "passes", starting_offsets="latest", stream=False)
    assert Session.read.options["startingOffsets"] == "latest"


def test_station_file(spark, tmp_path):
    path = tmp_path / "s.json"
    entries = [None, {"stationId": 1, "name": "old", "lat": 1.0, "lon": 2.0}, {"stationId": 2, "name": "x"},
               {"stationId": 1, "name": "new", "lat": 3.0, "lon": 4.0, "extra": True}]
    path.write_text(json.dumps(entries))
    rows = {r.station_id: tuple(r)[1:] for r in load_stations(spark, str(path)).collect()}
    assert rows == {1: ("new", 3.0, 4.0), 2: ("x", 0.0, 0.0)}
    path.write_text("[null]")
    with pytest.raises(ValueError, match="no station"):
        load_stations(spark, str(path))


def test_default_stations(spark):
    assert default_stations(spark).count() == len(STATIONS) == 18


def test_dimension_join_beyond_the_broadcast_bound(spark):
    # A third of the facts share one key.
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    assert fits_broadcast(dim) and not fits_broadcast(dim, max_rows=39) and not fits_broadcast(dim, max_bytes=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = facts.withColumn("nested", F.array(F.struct(F.create_map("id", "k").alias("m"))))
        twice = dim.unionByName(dim.filter("k < 3"))
        for how in ("inner", "left", "left_semi", "left_anti"):
            for d in (dim, twice):
                small = join_dimension(facts, d, "k", how=how)
                large = join_dimension(facts, d, "k", how=how, max_rows=10)
                assert "BroadcastHashJoin" not in large._jdf.queryExecution().toString()
                assert small.columns == large.columns
                assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
        with pytest.raises(ValueError, match="how"):
            join_dimension(facts, dim, "k", how="right")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dictionary(spark):
    table = spark.createDataFrame(
        [("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3"), ("a", "x", "0")], "key string, field string, value string")
    assert {r.key: r.entries for r in dictionary_entries(table).collect()} == {"a": {"x": "1", "y": "2"}, "b": {"x": "3"}}
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    plain = spark.createDataFrame([("a", "", "v"), ("a", "f", "w")], "key string, field string, value string")
    assert [r.v for r in lookup_value(df, plain, key="code", into="v").orderBy("code").collect()] == ["v", None, None]
    one = lookup_value(df, table, key="code", field="y", into="y")
    assert {r.code: r.y for r in one.collect()} == {"a": "2", "b": None, "c": None}
    every = lookup_entries(df, table, key="code", into="m", max_rows=0)
    assert {r.code: r.m for r in every.collect()} == {"a": {"x": "1", "y": "2"}, "b": {"x": "3"}, "c": {}}
