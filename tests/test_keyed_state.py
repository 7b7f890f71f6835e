"""Keyed state, watermarks per partition, the account of late passes."""

from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from passgrid.catalog import fixture as fx
from passgrid.catalog import streams
from passgrid.catalog.batch import QUERIES as BATCH
from passgrid.catalog.streams import _run, clone_alerts_in_buckets, keyed_state, stream_traffic_detail, wait_for_listeners
from passgrid.live.history import GROUPS, history_stream
from passgrid.live.late import LateCounts, read_late_counts
from passgrid.live.queries import file_writer, partitioned_stats_stream, start_alerts, start_stats, stats_stream
from passgrid.live.state import held_history, partition_rows
from passgrid.settings import DETAIL_SCHEMA, CloneSettings
from passgrid.sources.records import archived_records
from passgrid.sources.stations import default_stations

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
PASS = "arrival_seq long, hphm string, gcsj timestamp, station_id int"


def pass_rows(spark, rows):
    return spark.createDataFrame([(i, p, START + timedelta(seconds=s), 101) for i, p, s in rows], PASS)


def sizes_by_hand(rows, horizon=2700):
    held, out = {}, {}
    for i, plate, second in sorted(rows):
        held[plate] = [s for s in held.get(plate, []) if abs(s - second) <= horizon] + [second]
        out[i] = len(held[plate])
    return out, {p: sorted(s) for p, s in held.items()}


@pytest.fixture
def history(spark, tmp_path):
    def run(*triggers):
        for rows in triggers:
            pass_rows(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))
            with keyed_state(spark):
                stream = history_stream(spark.readStream.schema(PASS).parquet(str(tmp_path / "in")))
                query = stream.withColumn("shard", F.lit(0))
                query = file_writer(query, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).start()
                query.awaitTermination()
        got = {r.arrival_seq: r.history_size for r in spark.read.parquet(str(tmp_path / "out")).collect()}
        with keyed_state(spark):
            held = held_history(spark, str(tmp_path / "cp")).collect()
        state = {}
        for r in held:
            state.setdefault(r.hphm, []).append(r.second - int(START.timestamp()))
        return got, {p: sorted(s) for p, s in state.items()}

    return run


def test_a_straggler_purges_and_state_stays_bounded(history):
    first = [(1, "a", 0), (2, "a", 1000), (3, "a", 2700), (4, "a", 2701), (5, "b", 10), (6, "c", 50)]
    # A pass hours behind removes all newer ones; the next pass in time finds only itself.
    second = [(10, "a", -9000), (11, "a", 2710), (12, "a", 2720), (13, "b", 10), (14, "hot", 0)]
    second += [(100 + i, "hot", 30 * i) for i in range(400)]
    # Long after the horizon each list holds the new pass alone.
    third = [(1000, "a", 90_000), (1001, "b", 90_000), (1002, "hot", 90_000), (1003, "hot", 89_000)]
    want, held = sizes_by_hand(first + second + third)
    got, state = history(first, second, third)
    assert got == want and want[11] == 1 and want[12] == 2
    assert state == held == {"a": [90_000], "b": [90_000], "c": [50], "hot": [89_000, 90_000]}


def test_plates_share_lists_of_state(spark, history, tmp_path):
    """Far more plates than groups: sizes and what is held as by hand, a key of state per group at most."""
    first = [(i, f"p{i % 2500}", i % 7 * 600) for i in range(5000)]
    second = [(5000 + i, f"p{i}", 3600 + i % 5 * 900) for i in range(0, 2500, 2)]
    want, held = sizes_by_hand(first + second)
    got, state = history(first, second)
    assert got == want and state == held
    with keyed_state(spark):
        table = spark.read.format("statestore").option("stateVarName", "held").load(str(tmp_path / "cp"))
        assert table.select("key").distinct().count() <= GROUPS < 2500


def test_arrivals_are_dealt_over_files(spark, tmp_path):
    """One file of one row group would be decoded by one task, however large."""
    _run(spark, [spark.range(5000).coalesce(1)], str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in")).groupBy(F.input_file_name()).count().collect()
    assert len(rows) == spark.sparkContext.defaultParallelism and max(r["count"] for r in rows) < 2 * 5000 / len(rows)


def test_messages_are_made_by_all_tasks(spark, tmp_path):
    """Events of one row group: each core makes messages, and the same ones as a single task."""
    e = F.col("id")
    spark.range(4000).coalesce(1).select(
        e.alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        (e % 90).alias("user_id"), F.when(e % 4 > 0, "view").alias("event_type"), F.concat(F.lit('{"k": '), e, F.lit("}")).alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    dealt = fx.records(spark, str(tmp_path), dealt=True)
    rows = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(rows) == spark.sparkContext.defaultParallelism and max(r["count"] for r in rows) < 2 * 4364 / len(rows)
    whole = fx.records(spark, str(tmp_path))
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def detail(spark, rows):
    rows = [(START + timedelta(seconds=s), station) for s, station in rows]
    frame = spark.createDataFrame(rows, "gcsj timestamp, station_id int")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in DETAIL_SCHEMA if f.name not in frame.columns]
    return frame.select("*", *missing).select(*DETAIL_SCHEMA.names)


@pytest.mark.parametrize("apart", [True, False])
def test_a_lagging_partition_loses_nothing_under_its_own_watermark(spark, tmp_path, apart):
    """Partition 1 comes ten minutes behind partition 0."""
    for fast, slow in [((600, 630), (0, 30)), ((660, 690), (60, 90)), ((1500,), (120, 700)), ((7200,), (7200,)), ((9000,), (9000,))]:
        for i, (seconds, station) in enumerate([(fast, 101), (slow, 102)]):
            detail(spark, [(s, station) for s in seconds]).write.mode("append").parquet(str(tmp_path / f"in{i}"))
        parts = [spark.readStream.schema(DETAIL_SCHEMA).parquet(str(tmp_path / f"in{i}")) for i in (0, 1)]
        stream = partitioned_stats_stream(parts) if apart else stats_stream(parts[0].unionByName(parts[1]))
        file_writer(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).filter("window_start < timestamp'2024-01-01 01:00:00'")
    counts = {r.station_id: r.n for r in got.groupBy("station_id").agg(F.sum("cnt").alias("n")).collect()}
    assert counts[101] == 5 and (counts.get(102, 0) == 6) == apart


def test_late_passes_are_counted_one_by_one(spark, tmp_path):
    """Several late passes of one window and station count each; those of an open window don't."""
    base = str(tmp_path)
    listener = LateCounts(spark, f"{base}/counts")
    spark.streams.addListener(listener)
    try:
        for rows in [[(0, 101), (600, 101)], [(1200, 101)], [(5, 101), (5, 101), (6, 101), (1190, 101), (40, 102)], [(9000, 101)]]:
            frame = detail(spark, rows).withColumn("shard", F.lit(0))
            frame.write.mode("append").partitionBy("shard").parquet(f"{base}/detail")
            start_stats(spark, base, f"{base}/cp", name="counted", count_late=True, available_now=True).awaitTermination()
        wait_for_listeners(spark)
    finally:
        spark.streams.removeListener(listener)
    late = read_late_counts(spark, f"{base}/counts").collect()
    assert [(r.query, r.late) for r in late] == [("counted", 4)] and late[0].watermark is not None
    stats = spark.read.parquet(f"{base}/stats").agg(F.sum("cnt")).first()[0]
    assert stats == 4


def test_a_hot_plate_is_spread_over_state_partitions(spark, tmp_path):
    """A third of all passes under one plate: with the plate alone as key half of the state or more lies in one of eight
    partitions, in buckets of time none holds a third."""
    clone_alerts_in_buckets(spark, "/root/testdata/sf0.001", str(tmp_path))
    rows = {r.partition: r.rows for r in partition_rows(spark, f"{tmp_path}/checkpoint/alerts", side="left").collect()}
    assert len(rows) >= 6 and max(rows.values()) < sum(rows.values()) / 3


def test_the_first_delivery_of_a_message_is_the_one_kept(spark, tmp_path):
    """Messages without a time take that of their delivery, so the detail rows tell which of two was kept."""
    events = spark.range(2400).select(
        (F.col("id") * 583).alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, 100 * id)")).alias("ts"),
        (F.col("id") * 50 + 2).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    live, batch = stream_traffic_detail(spark, str(tmp_path)), BATCH["traffic_detail"](spark, str(tmp_path))
    columns = [c for c in batch.columns if c in live.columns]
    got, want = (sorted(map(str, df.select(columns).collect())) for df in (live, batch))
    assert len(want) > 1500 and "gcsj" in columns and got == want


@pytest.mark.parametrize("query", [streams.stream_traffic_stats, streams.stream_upsert_stats])
def test_what_the_traffic_queries_remember_lies_on_disk(spark, tmp_path, monkeypatch, query):
    """A day of dedup keys in an executor's heap outgrows it; a session that names no state store keeps them there."""
    events = spark.range(300).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, 100 * id)")).alias("ts"),
        (F.col("id") * 50 + 2).alias("user_id"), F.lit("view").alias("event_type"), F.lit('{"k": 1}').alias("props"),
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "shared_dir", lambda spark, label: str(tmp_path / "run"))
    before = {k: spark.conf.get(k, None) for k in streams.STORED_STATE}
    assert query(spark, str(tmp_path)).count() > 100
    files = [p for p in (tmp_path / "run/checkpoint").rglob("*") if "state" in p.parts and p.is_file()]
    kinds = {(p.relative_to(tmp_path / "run/checkpoint").parts[0].split("_")[0], p.suffix) for p in files if p.suffix in (".zip", ".delta")}
    assert kinds == {("detail", ".zip"), ("stats", ".zip")}
    assert {k: spark.conf.get(k, None) for k in streams.STORED_STATE} == before


@pytest.mark.parametrize("hot", [True, False])
def test_a_crowd_at_one_station_is_held_in_few_rows_and_its_alerts_come_in_runs(spark, tmp_path, hot):
    """2,000 passes of a plate at one station, 20 a second, and five at another: the crowd takes a row of state for some
    hundred passes and copy, and alerts alike in their gap follow each other, so that their table is small."""
    second = F.when(F.col("id") < 2000, F.floor(F.col("id") / 20)).otherwise(200 + (F.col("id") - 2000) * 10)
    iso = F.date_format(F.timestamp_seconds(second + int(START.timestamp())), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = F.struct(
        (F.col("id") + 1).alias("gcxh"), F.when(F.col("id") < 2000, 101).otherwise(111).alias("station_id"),
        F.lit("HOT").alias("hphm"), iso.alias("gcsj"),
    )
    records = spark.range(2005).select(
        F.to_json(fields).alias("value"), F.lit(START).alias("ingest_time"), F.col("id").alias("arrival_seq")
    )
    plates = spark.createDataFrame([("HOT", 4)], "hphm string, splits int") if hot else None
    query = _run(
        spark, [records], f"{tmp_path}/in",
        lambda: start_alerts(
            archived_records(spark, f"{tmp_path}/in"), default_stations(spark), str(tmp_path), f"{tmp_path}/cp",
            CloneSettings(bucket_s=None if hot else 900), plates, available_now=True,
        ),
    )[-1]
    gaps = [r.time_gap_sec for f in (tmp_path / "alerts").rglob("*.parquet") for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    assert Counter(gaps) == Counter(200 + 10 * j - i // 20 for i in range(2000) for j in range(5))
    assert sum(a != b for a, b in zip(gaps, gaps[1:])) < len(gaps) / 3
    held = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    assert held < 200


def test_live_tables_are_written_without_a_sort(spark, tmp_path):
    """A sort by shard of all that a trigger brings goes to disk where memory doesn't hold it."""
    name, found = "spark.sql.maxConcurrentOutputFileWriters", []

    def start():
        found.append(int(spark.conf.get(name)))
        stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in").withColumn("shard", (F.col("id") % 2).cast("int"))
        return file_writer(stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True).start()

    before = spark.conf.get(name)
    _run(spark, [spark.range(1000)], f"{tmp_path}/in", start)
    assert found[0] > 2 and spark.conf.get(name) == before
    assert spark.read.parquet(f"{tmp_path}/out").filter("shard = id % 2").count() == 1000
