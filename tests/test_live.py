import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from passgrid.settings import CloneSettings
from passgrid.sources.records import text_records
from passgrid.sources.stations import default_stations
from passgrid.live.queries import start_alerts, start_detail, start_stats, start_traffic

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(**offset):
    return (START + timedelta(**offset)).strftime("%Y-%m-%dT%H:%M:%SZ")


class Feed:
    """Message files whose modification time is the ingest time."""

    def __init__(self, folder):
        self.folder = folder
        self.folder.mkdir()
        self.n = 0

    def add(self, *messages, hours=0.0):
        self.n += 1
        path = self.folder / f"{self.n:04d}.txt"
        lines = [m if isinstance(m, str) else json.dumps(m, ensure_ascii=False) for m in messages]
        path.write_text("\n".join(lines) + "\n")
        ingest = (START + timedelta(hours=hours, seconds=self.n)).timestamp()
        os.utime(path, (ingest, ingest))


def traffic_run(spark, feed, base, clock=None):
    """Both queries once; how many passes were too late for the statistics."""
    query = None
    for start in (
        lambda: start_detail(text_records(spark, str(feed.folder)), base, f"{base}/cp", clock=clock, available_now=True),
        lambda: start_stats(spark, base, f"{base}/cp", available_now=True),
    ):
        query = start()
        query.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def message(gcxh, station, **fields):
    return {"gcxh": gcxh, "station_id": station, "hphm": "苏A12345", **fields}


def test_late_passes_reach_detail_but_not_statistics(spark, tmp_path):
    feed, base = Feed(tmp_path / "in"), str(tmp_path / "out")
    feed.add(message(1, 101, gcsj=at(seconds=5), fxlx="上行", hpzl="1"), message(2, 101, gcsj=at(seconds=29)),
             message(1, 101, gcsj=at(seconds=5)), "not-json", message(3, 0, gcsj=at(days=9)))
    traffic_run(spark, feed, base)
    feed.add(message(10, 102, gcsj=at(minutes=10)))
    traffic_run(spark, feed, base)
    feed.add(message(11, 102, gcsj=at(minutes=11)))
    traffic_run(spark, feed, base)
    feed.add(message(20, 101, gcsj=at(seconds=10)), message(1, 101, gcsj=at(seconds=5)))  # late, and a duplicate
    assert traffic_run(spark, feed, base) > 0
    feed.add(message(99, 103, gcsj=at(hours=2)))
    traffic_run(spark, feed, base)

    detail = spark.read.parquet(f"{base}/detail")
    assert {(r.station_id, r.n) for r in detail.groupBy("station_id").agg(F.count("*").alias("n")).collect()} == {
        (101, 3), (102, 2), (103, 1)}
    stats = {(r.station_id, r.window_start.strftime("%H:%M:%S")): (r.cnt, json.loads(r.by_dir), json.loads(r.by_type))
             for r in spark.read.parquet(f"{base}/stats").collect()}
    assert stats == {
        (101, "00:00:00"): (2, {"上行": 1, "": 1}, {"小型汽车": 1, "未知车型": 1}),
        (102, "00:10:00"): (1, {"": 1}, {"未知车型": 1}),
        (102, "00:11:00"): (1, {"": 1}, {"未知车型": 1}),
    }


def test_a_key_is_forgotten_after_a_day(spark, tmp_path):
    """Retention runs on the ingest clock from first sight; duplicates do not prolong it; old event times pass."""
    feed, base = Feed(tmp_path / "in"), str(tmp_path / "out")
    first = message(7, 101, gcsj=at(hours=0))
    for hours, messages in [
        (0, [first]),
        (12, [first, message(8, 101, gcsj=at(hours=-100))]),
        (23, [first]),
        (24.5, [message(9, 101, gcsj=at(hours=24))]),
        (25, [first, message(8, 101, gcsj=at(hours=1))]),
        (26, [first]),
    ]:
        feed.add(*messages, hours=hours)
        traffic_run(spark, feed, base, clock="ingest_time")
    got = spark.read.parquet(f"{base}/detail").groupBy("gcsj").count().collect()
    assert {int((r.gcsj.replace(tzinfo=timezone.utc) - START).total_seconds() // 3600): r["count"] for r in got} == {
        0: 2, 24: 1, -100: 1}


def test_no_new_key_is_late(spark, tmp_path):
    """On the trigger's clock neither a partition 20 hours behind nor an ingest time far ahead loses a pass."""
    feed, base = Feed(tmp_path / "in"), str(tmp_path / "out")
    feed.add(message(1, 101, gcsj=at(hours=48)), hours=48)
    query = start_detail(text_records(spark, str(feed.folder)), base, f"{base}/cp", available_now=True)
    query.awaitTermination()
    feed.add(message(2, 101, gcsj=at(days=9000)), hours=24 * 5)
    feed.add(message(3, 101, gcsj=at(hours=28)), message(1, 101, gcsj=at(hours=48)), hours=28)
    for _ in range(2):
        query = start_detail(text_records(spark, str(feed.folder)), base, f"{base}/cp", available_now=True)
        query.awaitTermination()
        assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
        feed.add(message(4, 101, gcsj=at(hours=1)), hours=1)
    assert spark.read.parquet(f"{base}/detail").count() == 4


def test_no_alert_is_lost_to_a_clock(spark, tmp_path):
    feed, base = Feed(tmp_path / "in"), str(tmp_path / "out")
    other = {"gcxh": 8, "station_id": 104, "hphm": "other"}
    feed.add({**other, "gcsj": at(days=3650)}, message(1, 101, gcsj=at(minutes=60)))
    alerts_run(spark, feed, base, ingest_clock=False)
    feed.add(message(2, 104, gcsj=at(minutes=70)))
    alerts_run(spark, feed, base, ingest_clock=False)
    # Two passes that arrive together, hours behind all others.
    late = [{"gcxh": k, "station_id": s, "hphm": "late", "gcsj": at(hours=-9, minutes=m)} for k, s, m in [(3, 101, 0), (4, 118, 20)]]
    feed.add(*late, hours=-8)
    query = alerts_run(spark, feed, base, ingest_clock=False)
    got = spark.read.parquet(f"{base}/alerts").collect()
    assert sorted((r.first_station_id, r.second_station_id) for r in got) == [(101, 104), (101, 118)]
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0


def alerts_run(spark, feed, base, hot_plates=None, ingest_clock=True):
    query = start_alerts(text_records(spark, str(feed.folder)), default_stations(spark), base, f"{base}/cp",
                         CloneSettings(), hot_plates, ingest_clock, available_now=True)
    query.awaitTermination()
    return query


def clone_feed(spark, folder, base, hot_plates=None):
    feed = Feed(folder)
    feed.add(message(1, 101, gcsj=at(minutes=60)), message(2, 104, gcsj=at(minutes=70)),
             message(3, 104, gcsj="bad-time"), {"gcxh": 4, "station_id": 105, "hphm": "　", "gcsj": at(minutes=61)})
    alerts_run(spark, feed, base, hot_plates)
    # 40 minutes out of order, then repeated
    feed.add(message(5, 118, gcsj=at(minutes=30)), message(6, 101, gcsj=at(minutes=70, seconds=10)))
    alerts_run(spark, feed, base, hot_plates)
    feed.add(message(5, 118, gcsj=at(minutes=30)), {"gcxh": 7, "station_id": 104, "hphm": "other", "gcsj": at(hours=9)},
             hours=0.1)
    alerts_run(spark, feed, base, hot_plates)
    # long after the history has gone
    feed.add({"gcxh": 8, "station_id": 104, "hphm": "other", "gcsj": at(hours=10)}, hours=10)
    alerts_run(spark, feed, base, hot_plates)
    feed.add(message(9, 117, gcsj=at(minutes=65)), hours=10)
    query = alerts_run(spark, feed, base, hot_plates)
    got = spark.read.parquet(f"{base}/alerts")
    return query, sorted((r.first_station_id, r.second_station_id, r.time_gap_sec) for r in got.collect())


EXPECTED = sorted([(101, 104, 600)] + 2 * [(118, 101, 1800), (118, 104, 2400), (118, 101, 2410)])


def test_clone_alerts_of_passes_out_of_order(spark, tmp_path):
    query, alerts = clone_feed(spark, tmp_path / "in", str(tmp_path / "out"))
    assert alerts == EXPECTED
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 4  # only the last two passes, each held once per side


def test_clone_alerts_with_busy_plates_spread(spark, tmp_path):
    hot = spark.createDataFrame([("苏A12345", 3)], "hphm string, splits int")
    _, alerts = clone_feed(spark, tmp_path / "in", str(tmp_path / "out"), hot)
    assert alerts == EXPECTED


def test_both_traffic_queries_run_side_by_side(spark, tmp_path):
    feed, base = Feed(tmp_path / "in"), str(tmp_path / "out")
    feed.add(*[message(i, 101, gcsj=at(seconds=i)) for i in range(1, 61)])
    detail, stats = start_traffic(text_records(spark, str(feed.folder)), base, f"{base}/cp", trigger="0 seconds")
    try:
        detail.processAllAvailable()
        stats.processAllAvailable()
        feed.add(message(1000, 101, gcsj=at(hours=1)))
        detail.processAllAvailable()
        stats.processAllAvailable()
    finally:
        detail.stop()
        stats.stop()
    assert spark.read.parquet(f"{base}/detail").count() == 61
    counts = spark.read.parquet(f"{base}/stats").select("window_start", "cnt").collect()
    assert sorted(r.cnt for r in counts) == [1, 29, 30]
