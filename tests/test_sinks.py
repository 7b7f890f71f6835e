import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from passgrid.plans.clones import run_clone_records, run_clones
from passgrid.plans.traffic import run_traffic, run_traffic_records, traffic_tables
from passgrid.sinks import files, rows
from passgrid.sources.stations import default_stations
from test_operators import START, pass_frame, skewed_passes

SCHEMA = "station_id int, window_start timestamp, window_end timestamp, cnt long, by_dir string, by_type string, shard int"
END = START + timedelta(seconds=30)


def stats_load(spark, *pairs):
    return spark.createDataFrame([(s, START, END, n, "{}", "{}", s % 2) for s, n in pairs], SCHEMA)


def counts(df):
    return {r.station_id: r.cnt for r in df.collect()}


def test_stats_table_takes_the_latest_load(spark, tmp_path):
    path = str(tmp_path / "stats")
    files.append_load(stats_load(spark, (1, 10), (2, 20)), path, 0)
    files.append_load(stats_load(spark, (2, 21), (3, 30)), path, 1)
    assert counts(files.read_latest(spark, path)) == {1: 10, 2: 21, 3: 30}
    files.append_load(stats_load(spark, (2, 21), (3, 30)), path, 1)  # replay
    assert counts(files.read_latest(spark, path)) == {1: 10, 2: 21, 3: 30}
    assert files.read_loads(spark, path).count() == 4
    files.append_load(stats_load(spark, (1, 99)), path, 2)
    merged = str(tmp_path / "merged")
    files.compact_loads(spark, path, merged, up_to=1)
    assert counts(files.read_loads(spark, merged)) == {1: 10, 2: 21, 3: 30}
    files.append_load(stats_load(spark, (1, 99)), merged, 2)
    assert counts(files.read_latest(spark, merged)) == counts(files.read_latest(spark, path)) == {1: 99, 2: 21, 3: 30}


def test_append_table_replay_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    load = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "v int, shard int")
    for load_id in (0, 1, 1, 0):
        files.append_load(load, path, load_id)
    assert sorted(r.v for r in files.read_loads(spark, path).collect()) == [1, 1, 1, 1, 2, 2]


@pytest.mark.parametrize("again", [[(9, 0)], []])
def test_a_load_written_again_replaces_all_of_it(spark, tmp_path, again):
    path = str(tmp_path / "t")
    kind = "v int, shard int"
    files.append_load(spark.createDataFrame([(1, 0), (2, 1)], kind), path, 0)
    files.append_load(spark.createDataFrame([(5, 1)], kind), path, 1)
    files.append_load(spark.createDataFrame(again, kind), path, 0)
    assert sorted(r.v for r in files.read_loads(spark, path).collect()) == sorted([5, *[v for v, _ in again]])
    assert not list((tmp_path / "t").rglob("*_new"))


def test_an_attempt_counts_once_it_is_committed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    kind = "v int, shard int"
    files.append_load(spark.createDataFrame([(1, 0)], kind), path, 0)

    def lost(*_, **__):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(files.CommitLog, "_put", lost)
        with pytest.raises(OSError):
            files.append_load(spark.createDataFrame([(7, 0)], kind), path, 0)
    assert [r.v for r in files.read_loads(spark, path).collect()] == [1]


def test_statements():
    assert rows.insert_statement("t", ["a", "b"], "?") == "INSERT INTO t (a,b) VALUES (?,?)"
    upsert = rows.upsert_statement(rows.STATS_TABLE, rows.STATS_COLUMNS, ["station_id", "window_start", "window_end"])
    assert upsert.endswith(
        "ON DUPLICATE KEY UPDATE cnt=VALUES(cnt),by_dir=VALUES(by_dir),by_type=VALUES(by_type)")


def test_write_rows_commits_per_batch(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        """A stand-in for a DB-API connection: every commit becomes a file."""
        import json
        import uuid

        class Connection:
            def __init__(self):
                self.pending = []

            def cursor(self):
                return self

            def executemany(self, statement, chunk):
                self.pending.append([statement, [list(r) for r in chunk]])

            def commit(self):
                with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
                    json.dump(self.pending, f)
                self.pending = []

            def close(self):
                pass

        return Connection()

    df = spark.range(0, 25, 1, 2).select((F.col("id") * 2).alias("b"), F.col("id").alias("a"))
    rows.write_rows(df, connect, "INSERT", ["a", "b"], batch_size=5)
    commits = [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]
    assert sorted(len(c[0][1]) for c in commits) == [2, 3, 5, 5, 5, 5]
    assert sorted(r for c in commits for r in c[0][1]) == [[i, 2 * i] for i in range(25)]
    rows.write_rows(df.limit(0), connect, "INSERT", ["a", "b"])
    assert len(list(tmp_path.glob("*.json"))) == 6


def test_batch_functions(spark, tmp_path):
    """Called as a stream would call them, a batch number at a time."""
    seen = []

    class Frame:
        def select(self, *columns):
            seen.append(columns)
            return self

        def coalesce(self, connections):
            seen.append(connections)
            return self

        def foreachPartition(self, function):
            seen.append(callable(function))

    rows.row_batches(lambda: None, "INSERT", rows.ALERT_COLUMNS)(Frame(), 3)
    assert seen == [tuple(rows.ALERT_COLUMNS), 32, True]
    options = rows.jdbc_options("jdbc:mysql://db/t", rows.DETAIL_TABLE, user="u", password="p")
    assert options["batchsize"] == "500" and options["dbtable"] == "traffic_pass_dev"


def test_run_traffic_writes_what_the_lazy_plan_gives(spark, tmp_path):
    passes = pass_frame(spark, skewed_passes(21, n=600))
    lazy = traffic_tables(passes, clock="gcsj")
    written = run_traffic(passes, str(tmp_path), clock="gcsj")
    drop = ["created_at", "shard", "dt"]
    for one, other in ((lazy.detail, written.detail), (lazy.stats, written.stats)):
        one, other = one.drop(*drop), other.drop(*drop).select(one.drop(*drop).columns)
        assert one.count() == other.count() and one.exceptAll(other).isEmpty()
    assert {r.shard for r in written.detail.select("shard").distinct().collect()} == {0, 1}


def test_traffic_honours_the_life_time(spark):
    rows = [(1, 7, 101, "P", START), (2, 7, 101, "P", START + timedelta(hours=30))]
    assert traffic_tables(pass_frame(spark, rows), clock="gcsj").detail.count() == 2
    rows[1] = (2, 7, 101, "P", START + timedelta(hours=23))
    assert traffic_tables(pass_frame(spark, rows), clock="gcsj").detail.count() == 1


def test_jobs_keep_what_they_leave_out(spark, tmp_path):
    good = '{"gcxh":1,"station_id":101,"hphm":"P","gcsj":"2024-01-01T00:00:00Z"}'
    messages = [good, "no json", "", '{"gcxh":2,"station_id":101,"hphm":"P","gcsj":"bad"}']
    records = spark.createDataFrame([(v, START, i) for i, v in enumerate(messages)],
                                    "value string, ingest_time timestamp, arrival_seq long")
    tables = run_traffic_records(records, str(tmp_path / "t"))
    run_clone_records(records, default_stations(spark), str(tmp_path / "c"))
    found = {
        job: {(r.value, r.reject) for r in spark.read.parquet(str(tmp_path / job / "rejects")).collect()}
        for job in "tc"
    }
    assert found["t"] == {("no json", "not json"), ("", "empty")} and tables.detail.count() == 2
    assert found["c"] == found["t"] | {(messages[3], "bad time")}


def test_run_clones_writes_shards_by_earlier_station(spark, tmp_path):
    alerts = run_clones(pass_frame(spark, skewed_passes(22, n=300)), default_stations(spark), str(tmp_path))
    assert alerts.count() > 0
    assert alerts.filter((F.col("station_id") != F.col("first_station_id"))
                         | (F.col("shard") != F.col("station_id") % 2)).isEmpty()


def test_rebalanced_write_keeps_few_files(spark, tmp_path):
    df = spark.range(0, 20000, 1, 16).select(
        F.col("id").alias("v"), (F.col("id") % 2).cast("int").alias("shard"),
        F.timestamp_seconds(F.col("id") % 2 * 86400).alias("t"))
    files.write_sharded(df, str(tmp_path / "out"), time_col="t")
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20000


@pytest.fixture(autouse=True)
def _utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert START == datetime(2024, 1, 1)


def test_many_loads_are_read_from_one_checkpoint_and_its_tail(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    files.append_load(spark.createDataFrame([(0, 0)], "v int, shard int"), path, 0)
    log = files.CommitLog(spark, path)
    first = log.read()
    own = first.parts["0"]
    for commit in range(1, 111):
        # Twenty loads at a time, whose file is that of the first, without the cost of writing them.
        log.commit({str(load): own for load in range(20 * commit - 19, 20 * commit + 1)}, first.columns)
    names = sorted(p.name for p in (tmp_path / "t" / "_log").iterdir() if not p.name.startswith("."))
    assert len(names) <= 45 and names[-1] == "000000000110.commit"
    reads = []
    monkeypatch.setattr(files.CommitLog, "_text", lambda self, name, f=files.CommitLog._text: (reads.append(name), f(self, name))[1])
    assert len(log.read().parts) == 2201 and len(reads) <= 21
    files.append_load(spark.createDataFrame([(5, 0), (6, 1)], "v int, shard int"), path, 7)
    assert log.read().parts["7"] != own and len(log.read().parts) == 2201


def test_orphans_are_cleaned_and_writers_collide(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "v int, shard int"
    for load, v in ((0, 1), (1, 2), (0, 3)):
        files.append_load(spark.createDataFrame([(v, 0)], kind), path, load)
    spark.createDataFrame([(9, 0)], kind).write.parquet(f"{path}/loads/load_id=5/attempt=dead/shard=0")
    assert files.clean_loads(spark, path) == 0
    assert files.clean_loads(spark, path, older_than_s=-60) >= 2
    assert sorted(r.v for r in files.read_loads(spark, path).collect()) == [2, 3]
    log = files.CommitLog(spark, path)
    seen = log.read()
    log.commit({"8": []}, seen.columns, seen=seen)
    with pytest.raises(Exception, match="(?i)exist"):
        log.commit({"9": []}, seen.columns, seen=seen)


def test_an_upsert_of_one_hour_touches_one_bucket(spark, tmp_path):
    from passgrid.sinks import keyed

    path = str(tmp_path / "k")
    kind = "station_id int, window_start timestamp, window_end timestamp, cnt long"
    hour = lambda h, s=0: datetime(2024, 1, 1, h, 0, s)
    rows_of = lambda cnt, hours: [(i, hour(h), hour(h, 30), cnt) for h in hours for i in range(3)]
    assert len(keyed.upsert_buckets(spark.createDataFrame(rows_of(1, range(10)), kind), path)) == 10
    before = files.CommitLog(spark, path).read().parts
    assert len(keyed.upsert_buckets(spark.createDataFrame(rows_of(2, [4])[:2] + [(9, None, None, 7)], kind), path, load_id=3)) == 2
    after = files.CommitLog(spark, path).read().parts
    assert sum(before.get(b) != own for b, own in after.items() if not b.startswith("_")) == 2
    got = {(r.station_id, r.window_start and r.window_start.hour): r.cnt for r in keyed.read_buckets(spark, path).collect()}
    want = {(i, h): 2 if h == 4 and i < 2 else 1 for h in range(10) for i in range(3)}
    assert got == {**want, (9, None): 7}
    assert keyed.upsert_buckets(spark.createDataFrame(rows_of(8, [4]), kind), path, load_id=3) == []
    at = int(datetime(2024, 1, 1, 4, tzinfo=timezone.utc).timestamp())
    part = keyed.read_buckets(spark, path, since=at, until=at + 3600)
    assert len(part.inputFiles()) <= 2 and part.count() == 3
    assert keyed.clean_buckets(spark, path, older_than_s=-60) >= 1
    assert keyed.read_buckets(spark, path).count() == 31
    assert keyed.upsert_buckets(spark.createDataFrame([], kind), path) == []
