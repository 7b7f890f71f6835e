import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from passgrid.operators import enrich, pairs, stats
from passgrid.operators.dedup import dedup_passes, dedup_passes_ttl
from passgrid.operators.merge import upsert_stats
from passgrid.operators.shard import shard_by_station
from passgrid.plans import clones
from passgrid.settings import CloneSettings
from passgrid.sources.stations import STATIONS, default_stations
from test_functions import haversine

START = datetime(2024, 1, 1)


def pass_frame(spark, rows):
    """Rows of ``arrival_seq, gcxh, station_id, hphm, gcsj[, hphm_mask, fxlx, hpzl]``."""
    full = [tuple(r) + (None,) * (8 - len(r)) for r in rows]
    return spark.createDataFrame(
        full,
        "arrival_seq long, gcxh long, station_id int, hphm string, gcsj timestamp, hphm_mask string, fxlx string, "
        "hpzl string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("xzqhmc", "kkmc", "clppxh")}).withColumn(
        "adcode", F.lit(1))


def skewed_passes(seed, n=1500, hours=6, plates=40):
    """Random passes, a third of them of one plate, arriving out of order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        plate = "HOT" if rng.random() < 1 / 3 else f"P{rng.randrange(plates)}"
        at = START - timedelta(hours=1) + timedelta(seconds=rng.uniform(0, hours * 3600))
        rows.append((i, 0, rng.choice([101, 102, 103, 107, 118, 119, 0]), plate, at, None, rng.choice(["a", "b", None]),
                     rng.choice(["1", "2", "-", None, "z"])))
    return rows


def seconds(t):
    return int((t - datetime(1970, 1, 1)).total_seconds() // 1)


def brute_pairs(rows, min_gap, horizon, other_station=True):
    found = []
    timed = [(r[0], r[2], r[3], seconds(r[4])) for r in rows]
    for prev, prev_station, prev_plate, prev_sec in timed:
        for cur, station, plate, sec in timed:
            if (plate == prev_plate and prev < cur and min_gap <= abs(sec - prev_sec) <= horizon
                    and (not other_station or station != prev_station)):
                found.append((prev, cur))
    return sorted(found)


def pair_ids(df):
    return sorted((r.prev_arrival_seq, r.cur_arrival_seq)
                  for r in df.select("prev_arrival_seq", "cur_arrival_seq").collect())


@pytest.mark.parametrize("hot_rows", [None, 40])
@pytest.mark.parametrize("min_gap, horizon", [(20, 2700), (0, 300), (1, 10)])
def test_pairs_match_brute_force(spark, hot_rows, min_gap, horizon):
    rows = skewed_passes(horizon)
    df = pass_frame(spark, rows)
    splits = None
    if hot_rows:
        splits = pairs.hot_plate_splits(df, horizon_s=horizon, hot_rows=hot_rows)
        if horizon == 2700:
            assert {r.hphm for r in splits.collect()} == {"HOT"} and splits.agg(F.max("splits")).first()[0] > 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = pairs.plate_pairs(df, min_gap_s=min_gap, horizon_s=horizon, splits=splits)
        assert pair_ids(got) == brute_pairs(rows, min_gap, horizon)
        both = pairs.history_pairs(df, horizon_s=horizon, splits=splits)
        assert pair_ids(both) == brute_pairs(rows, 0, horizon, other_station=False)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pair_band_is_inclusive_in_whole_seconds(spark):
    at = lambda s: START + timedelta(seconds=s)
    rows = [(1, 0, 1, "P", at(0.9)), (2, 0, 2, "P", at(20.0)), (3, 0, 3, "P", at(2700.95)), (4, 0, 4, "P", at(-2700))]
    assert pair_ids(pairs.plate_pairs(pass_frame(spark, rows))) == [(1, 2), (1, 3), (1, 4), (2, 3)]


def test_pairs_without_arrival_use_event_time(spark):
    rows = skewed_passes(5, n=200)
    df = pass_frame(spark, rows)
    got = pairs.plate_pairs(df, order_col="gcsj", carry=["arrival_seq"])
    by_id = {r[0]: r for r in rows}
    found = got.select("prev_arrival_seq", "cur_arrival_seq").collect()
    assert sorted(tuple(sorted(r)) for r in found) == [tuple(sorted(p)) for p in brute_pairs(rows, 20, 2700)]
    assert all(by_id[a][4] < by_id[b][4] for a, b in found)
    with pytest.raises(ValueError):
        pairs.history_pairs(df, order_col="gcsj")


def test_plate_history(spark):
    rows = skewed_passes(7, n=300)
    df = pass_frame(spark, rows)
    sizes = Counter(cur for _, cur in brute_pairs(rows, 0, 2700, other_station=False))
    for hot_rows in (pairs.HOT_ROWS, 20, 1):
        got = {r.arrival_seq: r.history_size for r in pairs.plate_history(df, hot_rows=hot_rows).collect()}
        assert got == {r[0]: sizes[r[0]] + 1 for r in rows}


def test_plate_history_of_a_crowd_builds_no_pairs(spark):
    """A third of 30,000 passes under one plate within 1,000 seconds: 55 million pairs, if they were built."""
    df = spark.range(30_000).select(
        F.col("id").alias("arrival_seq"),
        F.when(F.col("id") % 3 == 0, F.lit("crowd")).otherwise(F.concat(F.lit("p"), F.col("id") % 9000)).alias("hphm"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 1000).alias("gcsj"),
        F.lit(1).alias("station_id"),
    )
    got = pairs.plate_history(df).filter("hphm = 'crowd'")
    assert got.filter("history_size <> arrival_seq / 3 + 1").isEmpty() and got.count() == 10_000


def test_plate_history_orders_no_crowded_cell_in_one_task(spark, monkeypatch):
    staged = {}
    monkeypatch.setattr(pairs, "stage", lambda df, label, real=pairs.stage: staged.setdefault(label, real(df, label)))
    df = spark.range(9_000).select(
        F.col("id").alias("arrival_seq"), F.lit("crowd").alias("hphm"), F.lit(1).alias("station_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7 % 1000).alias("gcsj"),
    )
    got = pairs.plate_history(df, hot_rows=500)
    assert got.filter("history_size <> arrival_seq + 1").isEmpty() and got.count() == 9_000
    assert staged["ranked"].groupBy("hphm", "cell", "part").count().agg(F.max("count")).first()[0] < 1_000
    plan = got._jdf.queryExecution().analyzed().toString()
    specs = re.findall(r"windowspecdefinition\((.*?) ASC", plan)
    assert specs and all("slice#" in spec for spec in specs)


@pytest.mark.parametrize("hot_rows, staged", [(None, False), (30, True)])
def test_clone_alerts_match_brute_force(spark, hot_rows, staged):
    rows = skewed_passes(11, n=400)
    where = {i: (lat, lon) for i, _, lat, lon in STATIONS}
    by_id = {r[0]: r for r in rows}
    expected = []
    known = [r for r in rows if r[2] in where]
    for a, b in brute_pairs(known, 20, 2700):
        prev, cur = by_id[a], by_id[b]
        gap = abs(seconds(cur[4]) - seconds(prev[4]))
        km = haversine(*where[cur[2]], *where[prev[2]])
        speed = km / (gap / 3600)
        if speed > 140:
            first, second = (prev, cur) if cur[4] > prev[4] else (cur, prev)
            expected.append((first[2], cur[3][:4] + "****", first[2], second[2], gap, round(km, 6), round(speed, 4),
                             round(min(1.0, (speed - 140) / 140 + 0.5), 6)))
    got = clones.clone_alerts(pass_frame(spark, rows), default_stations(spark), CloneSettings(), hot_rows=hot_rows,
                              staged=staged)
    got = got.withColumns({"distance_km": F.round("distance_km", 6), "speed_kmh": F.round("speed_kmh", 4),
                           "confidence": F.round("confidence", 6)})
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_blank_plates_and_stations_without_place_raise_no_alert(spark):
    at = lambda s: START + timedelta(seconds=s)
    rows = [(i, 0, station, plate, at(60 * i)) for i, (station, plate) in enumerate(
        [(101, "P"), (102, "P"), (103, "P"), (104, " "), (105, " "), (106, None), (0, "P"), (999, "P")])]
    stations = default_stations(spark).withColumns(
        {c: F.when(F.col("station_id") == 103, 0.0).otherwise(F.col(c)) for c in ("lat", "lon")})
    got = clones.clone_alerts(pass_frame(spark, rows), stations).collect()
    assert [(r.first_station_id, r.second_station_id) for r in got] == [(101, 102)]


def test_repeated_deliveries_multiply_alerts(spark):
    at = lambda s: START + timedelta(seconds=s)
    rows = [(1, 9, 101, "P", at(0)), (2, 9, 101, "P", at(0)), (3, 10, 104, "P", at(600))]
    assert clones.clone_alerts(pass_frame(spark, rows), default_stations(spark)).count() == 2


def test_dedup_keeps_first_arrival_and_cuts_hot_keys_before_the_shuffle(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 5, rng.randrange(1, 300)]), rng.randrange(1, 3), None,
             START + timedelta(seconds=rng.randrange(4))) for i in rng.sample(range(2000), 2000)]
    expected = {}
    for r in sorted(rows):
        key = r[1] or (r[2], r[4])
        expected.setdefault(key, r[0])
    got = dedup_passes(pass_frame(spark, rows))
    assert sorted(r.arrival_seq for r in got.collect()) == sorted(expected.values())
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(dedup_key")
    assert plan.index("row_number(), 1, Final") < exchange < plan.index("row_number(), 1, Partial")


def spaced_by_hand(rows, hours):
    """Arrivals kept: of (arrival, key, seconds or None), the first per key, then the first ``hours`` after each kept."""
    kept, last, untimed = [], {}, set()
    for arrival, key, at in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        if at is None:
            if key not in untimed:
                kept.append(arrival)
            untimed.add(key)
        elif key not in last or at - last[key] >= hours * 3600:
            last[key] = at
            kept.append(arrival)
    return sorted(kept)


def spaced_rows(seed):
    """Keys with long and short epochs, ties in time, no time, and a key with a third of all rows and long gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(1500):
        key = 77 if i % 3 == 0 else rng.randrange(1, 200)
        at = rng.choice([None, rng.randrange(0, 90) * 60, rng.randrange(0, 20) * 3600, rng.randrange(400_000)])
        if key == 77 and at is not None:
            at = at // 600 * 600 + 500_000 * rng.randrange(3)
        rows.append((i, key, at))
    return rows


@pytest.mark.parametrize("hours, crowded", [(0.5, 200_000), (24, 200_000), (10_000, 200_000), (48, 60)])
def test_dedup_with_retention_matches_brute_force(spark, hours, crowded):
    rows = spaced_rows(8)
    seconds_of = dict((r[0], r[2]) for r in rows)
    passes = pass_frame(spark, [(i, key, 1, "P", START) for i, key, _ in rows])
    times = spark.createDataFrame(
        [(i, None if s is None else START + timedelta(seconds=s)) for i, s in seconds_of.items()],
        "arrival_seq long, ingest_time timestamp")
    df = passes.join(times, "arrival_seq")
    got = dedup_passes_ttl(df, hours=hours, crowded_rows=crowded)
    assert sorted(r.arrival_seq for r in got.collect()) == spaced_by_hand(rows, hours)
    assert got.columns == df.columns


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning(dedup_key"), "Python" in plan or "MapInArrow" in plan


def test_dedup_with_retention_shuffles_passes_once(spark, tmp_path):
    """Also with a key that always returns; without Python, whether epochs are long or not."""
    at = lambda i: START + timedelta(hours=30 * i)
    rows = [(i, 5, 1, "P", at(0)) for i in range(400)] + [(1000, 6, 1, "P", at(0)), (1001, 6, 1, "P", at(0))]
    clock = F.when(F.col("gcxh") == 5, F.lit(START).cast("timestamp") + F.expr("make_dt_interval(0, arrival_seq * 30, 0, 0)"))
    df = pass_frame(spark, rows).withColumn("ingest_time", clock)
    df.write.parquet(str(tmp_path / "passes"))
    df = spark.read.parquet(str(tmp_path / "passes"))
    short = dedup_passes_ttl(df.filter("arrival_seq < 1 or arrival_seq >= 1000"))
    assert exchanges(short) == (1, False)
    long = dedup_passes_ttl(df)
    # Passes without a time: the first of a key stays.
    assert sorted(r.arrival_seq for r in long.collect()) == [*range(400), 1000]
    plan = long._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert plan.count("ReusedExchange") == 1 and "Python" not in plan and "MapInArrow" not in plan


def test_both_batch_dedups_keep_the_same_row(spark):
    rows = [(1, 7, 1, "late clock", START), (2, 7, 1, "early clock", START)]
    df = pass_frame(spark, rows).withColumn(
        "ingest_time", F.lit(START).cast("timestamp") - F.expr("make_dt_interval(0, 0, arrival_seq, 0)"))
    assert [r.arrival_seq for r in dedup_passes(df).collect()] == [2] == [
        r.arrival_seq for r in dedup_passes_ttl(df).collect()]


@pytest.mark.parametrize("window", [30, 1800])
def test_station_stats_match_brute_force(spark, window):
    rows = skewed_passes(13)
    clean = enrich.enrich_passes(pass_frame(spark, rows))
    groups = defaultdict(list)
    names = {"1": "小型汽车", "2": "大型汽车", "-": "未知车型", None: "未知车型"}
    for r in rows:
        groups[r[2], seconds(r[4]) // window * window].append((r[6] or "", names.get(r[7], r[7])))
    expected = {k: (len(v), dict(Counter(d for d, _ in v)), dict(Counter(t for _, t in v))) for k, v in groups.items()}
    w = f"{window} seconds"
    got = stats.station_stats(clean, w).withColumn("start", F.unix_seconds("window_start")).collect()
    assert {(r.station_id, r.start): (r.cnt, r.by_dir, r.by_type) for r in got} == expected
    assert all((r.window_end - r.window_start).total_seconds() == window for r in got)
    alone = stats.station_window_count(clean, w).withColumn("start", F.unix_seconds("window_start")).collect()
    assert {(r.station_id, r.start): r.cnt for r in alone} == {k: v[0] for k, v in expected.items()}
    dirs = stats.station_by_dir(clean, w).withColumn("start", F.unix_seconds("window_start")).collect()
    assert {(r.station_id, r.start): r.by_dir for r in dirs} == {k: v[1] for k, v in expected.items()}
    types = stats.station_by_type(clean, w).withColumn("start", F.unix_seconds("window_start")).collect()
    assert {(r.station_id, r.start): r.by_type for r in types} == {k: v[2] for k, v in expected.items()}


def test_enrich_masks_the_raw_plate(spark):
    row = enrich.enrich_passes(pass_frame(spark, [(1, 0, 1, None, START)])).first()
    assert (row.hphm, row.hphm_mask, row.fxlx, row.hpzl, row.tags) == ("", "UNKNOWN", "", "未知车型", {})
    detail = enrich.pass_detail(enrich.enrich_passes(pass_frame(spark, [(1, 0, 1, "苏A12345", START)])))
    assert "hphm" not in detail.columns and "gcxh" not in detail.columns
    assert detail.first().hphm_mask == "苏A12****"


def test_plateless_passes_of_one_second_collapse(spark):
    rows = [(1, 0, 5, None, START), (2, 0, 5, "", START + timedelta(milliseconds=400)),
            (3, 0, 5, None, START + timedelta(seconds=1)), (4, 0, 6, None, START)]
    got = dedup_passes(enrich.enrich_passes(pass_frame(spark, rows)))
    assert sorted(r.arrival_seq for r in got.collect()) == [1, 3, 4]


def test_upsert_replaces_and_adds(spark):
    schema = "station_id int, window_start timestamp, window_end timestamp, cnt long, by_dir string, by_type string"
    end = START + timedelta(seconds=30)
    current = spark.createDataFrame([(1, START, end, 5, "a", None), (2, START, end, 6, "b", "c")], schema)
    new = spark.createDataFrame([(2, START, end, 1, None, "n"), (3, START, end, 2, "x", "y")], schema)
    got = sorted(map(tuple, upsert_stats(current, new).collect()))
    assert got == [(1, START, end, 5, "a", None), (2, START, end, 1, None, "n"), (3, START, end, 2, "x", "y")]
    again = sorted(map(tuple, upsert_stats(upsert_stats(current, new), new).collect()))
    assert again == got


def test_output_types(spark):
    from passgrid.settings import ALERT_SCHEMA, DETAIL_SCHEMA, STATS_SCHEMA

    passes = pass_frame(spark, skewed_passes(1, n=5))
    alerts = clones.clone_alerts(passes, default_stations(spark), staged=False)
    for df, schema in (
        (enrich.pass_detail(enrich.enrich_passes(passes)), DETAIL_SCHEMA),
        (stats.stats_rows(stats.station_stats(passes)), STATS_SCHEMA),
        (alerts.withColumn("created_at", F.current_timestamp()), ALERT_SCHEMA),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_shards(spark):
    df = spark.createDataFrame([(101,), (102,), (-1,)], "station_id int")
    assert [r.shard for r in shard_by_station(df, 2).collect()] == [1, 0, 1]


@pytest.mark.parametrize("bucket_s", [None, 900])
def test_live_pairs_leave_out_the_crowd_of_one_station(spark, tmp_path, bucket_s):
    """A live plate nearly always at one station: the join meets no two passes of it there, a row is copied a bounded
    number of times, and the pairs are those of brute force."""
    rows = [(i, 0, 101 if i % 9 else 102 + i % 5, "HOT" if i % 2 else f"P{i % 3}", START + timedelta(seconds=37 * i))
            for i in range(400)]
    rows += [(400 + i, 0, s, "HOT", START + timedelta(seconds=40 * i)) for i, s in enumerate((118, 101, 118, 107))]
    df = pass_frame(spark, rows).withColumn("seen", F.current_timestamp())
    df.write.parquet(str(tmp_path / "in"))
    stations = spark.createDataFrame([(s,) for s in (101, 102, 103, 104, 105, 106, 107, 118)], "station_id int")
    bits = pairs.station_bits(stations)
    assert bits == [0, 1, 2, 3, 4]
    hot = None if bucket_s else spark.createDataFrame([("HOT", 500)], "hphm string, splits int")
    live = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withWatermark("seen", "1 hour")
    found = pairs.plate_pairs(live, splits=hot, bucket_s=bucket_s, bits=bits)
    query = (
        found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert pair_ids(spark.read.parquet(str(tmp_path / "out"))) == brute_pairs(rows, 20, 2700)
    held = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    assert held <= len(rows) * (len(bits) * 5 if bucket_s else 2 * len(bits) * pairs.LIVE_SPLITS)


@pytest.mark.parametrize("spread", ["plate", "bucket", "hot"])
def test_live_pairs_are_held_in_packets(spark, tmp_path, monkeypatch, spread):
    """Passes of one plate that come in one trigger take few rows of state, and meet as brute force has it."""
    monkeypatch.setattr(pairs, "PACKET", 16)
    plates = ["HOT", "HOT", "HOT", None, "P1", "P2", "P3"]
    rows = [(i, 0, 101 + i % 5, plates[i % 7], START + timedelta(seconds=61 * (i * 37 % 500))) for i in range(500)]
    parts = [[r for r in rows if r[0] % 2 == n and r[3]] for n in (0, 1)]
    hot = spark.createDataFrame([("HOT", 500)], "hphm string, splits int") if spread == "hot" else None
    options = {"splits": hot, "bucket_s": 900 if spread == "bucket" else None, "bits": () if spread == "plate" else [0, 1, 2, 3]}
    for part in parts:
        df = pass_frame(spark, part).withColumn("seen", F.current_timestamp())
        df.repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        live = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        found = pairs.plate_pairs(live, watermark_delay="1 hour", **options)
        query = (
            found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert pair_ids(spark.read.parquet(str(tmp_path / "out"))) == brute_pairs([r for r in rows if r[3]], 20, 2700)
    held = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    copies = {"plate": 2, "bucket": 4 * 5, "hot": 2 * 4 * pairs.LIVE_SPLITS}[spread]
    assert held < sum(map(len, parts)) * copies / (8 if spread == "plate" else 1)
