"""Registered batch queries, one per operator."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.catalog import fixture as fx
from passgrid.functions import geo, text, time
from passgrid.functions.json import from_json_text, histogram_json, to_json_text
from passgrid.operators import enrich, filters, merge, pairs, shard, stats
from passgrid.operators.dedup import dedup_passes as dedup
from passgrid.operators.dedup import dedup_passes_ttl as dedup_ttl
from passgrid.operators.dimension import join_dimension
from passgrid.plans import clones, traffic
from passgrid.session import shared_dir
from passgrid.settings import CloneSettings
from passgrid.sinks import files, keyed
from passgrid.sources import dictionary as dicts
from passgrid.sources import passes as decoding
from passgrid.sources import stations as station_source

REPORT_WINDOW = "30 minutes"  # long windows, so that histograms get several entries on the small tables


def plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as other engines show them."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
    return df


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def _good(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_essential(fx.passes(spark, sf))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return traffic.clean_passes(fx.passes(spark, sf))


# ---- sources ----


def decode_passes(spark, sf):
    return plain_time(decoding.decode_passes(fx.records(spark, sf), keep=["arrival_seq"]))


def decode_passes_narrow(spark, sf):
    return plain_time(decoding.decode_passes_narrow(fx.records(spark, sf), keep=["arrival_seq"]))


def decode_rejects(spark, sf):
    return decoding.decode_rejects(fx.records(spark, sf)).select("arrival_seq", "value")


def parse_pass_time(spark, sf):
    """Time texts in several notations, made from the passes; only strict instants are read."""
    p = fx.passes(spark, sf)
    e = F.col("event_id") % 8
    local = F.date_format("gcsj", "yyyy-MM-dd'T'HH:mm:ss")
    raw = (
        F.when(e == 0, F.concat(local, F.lit("+00:00")))
        .when(e == 1, F.date_format("gcsj", "yyyy-MM-dd HH:mm:ss"))
        .when(e == 2, F.concat(F.date_format(F.expr("gcsj + INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                               F.lit("+08:00")))
        .when(e == 3, F.date_format("gcsj", "yyyy"))
        .when(e == 4, F.lower(F.concat(local, F.lit("Z"))))
        .when(e == 5, local)
        .when(e == 6, F.concat(local, F.lit(".25Z")))
        .otherwise(F.concat(local, F.lit("Z")))
    )
    return plain_time(p.select("arrival_seq", time.parse_instant(raw).alias("parsed")))


def station_dim(spark, sf):
    """The station file, with a null entry and an outdated one, and the passes seen at each station."""
    entries = [None, {"stationId": 101, "name": "old", "lat": 0.0, "lon": 0.0}]
    entries += [dict(zip(("stationId", "name", "lat", "lon"), s)) for s in station_source.STATIONS]
    path = f"{shared_dir(spark, 'stations')}/data"
    document = spark.range(1).select(F.lit(json.dumps(entries, ensure_ascii=False)).alias("value"))
    document.coalesce(1).write.text(path)
    stations = station_source.load_stations(spark, path)
    seen = fx.passes(spark, sf).groupBy("station_id").agg(F.count("*").alias("passes"))
    return stations.join(seen, "station_id", "left").withColumn("passes", F.coalesce("passes", F.lit(0)))


def dict_lookup(spark, sf):
    dictionary = fx.dictionary(spark, sf)
    p = fx.passes(spark, sf).select("arrival_seq", "adcode")
    p = dicts.lookup_value(p, dictionary, key="adcode", field="name", into="district")
    p = dicts.lookup_entries(p, dictionary, key="adcode", into="entries")
    return p.withColumn("entries", F.to_json("entries"))


def json_roundtrip(spark, sf):
    p = fx.passes(spark, sf).select("arrival_seq", "gcxh", "station_id", "hphm", "fxlx", "clppxh")
    encoded = p.select(to_json_text(F.struct("*")).alias("doc"))
    return encoded.select("doc", F.inline(F.array(from_json_text(F.col("doc"), p.schema)))).drop("doc")


# ---- filters and projections ----


def filter_essential(spark, sf):
    return _good(spark, sf).select("arrival_seq", "station_id")


def filter_plate_present(spark, sf):
    return filters.filter_plate_present(fx.passes(spark, sf)).select("arrival_seq", "hphm")


def fill_missing(spark, sf):
    return enrich.fill_missing(fx.passes(spark, sf)).select("arrival_seq", *enrich.FILLED)


def map_vehicle_type(spark, sf):
    return enrich.map_vehicle_type(fx.passes(spark, sf)).select("arrival_seq", "hpzl")


def mask_plate(spark, sf):
    p = fx.passes(spark, sf)
    mask, plate = F.col("hphm_mask"), F.col("hphm")
    return p.select(
        "arrival_seq",
        text.mask_plate(mask, plate).alias("detail_mask"),
        text.mask_plate(mask, plate, blank_is_absent=True).alias("alert_mask"),
    )


def enrich_passes(spark, sf):
    p = enrich.enrich_passes(_good(spark, sf)).drop("event_id", "ingest_time")
    return plain_time(p.withColumn("tags", F.to_json("tags")))


def empty_tags(spark, sf):
    p = enrich.add_empty_tags(fx.passes(spark, sf))
    return p.select("arrival_seq", F.to_json("tags").alias("tags"), F.size("tags").alias("n_tags"))


def dedup_key(spark, sf):
    return enrich.add_dedup_key(enrich.enrich_passes(_good(spark, sf))).select("arrival_seq", "dedup_key")


def station_has_geo(spark, sf):
    """Passes at stations with coordinates. Every sixth station gets none."""
    stations = station_source.default_stations(spark).withColumns(
        {c: F.when(F.col("station_id") % 6 == 0, F.lit(0.0)).otherwise(F.col(c)) for c in ("lat", "lon")}
    )
    located = filters.stations_with_geo(stations).select("station_id", "lat", "lon")
    joined = join_dimension(fx.passes(spark, sf), located, "station_id")
    return joined.select("arrival_seq", "station_id", "lat", "lon")


def pass_detail(spark, sf):
    return plain_time(enrich.pass_detail(enrich.enrich_passes(_good(spark, sf))).drop("created_at"))


# ---- joins ----


def _located(spark, sf):
    return clones.locate_passes(fx.passes(spark, sf), station_source.default_stations(spark))


def join_station(spark, sf):
    joined = clones.join_station(_good(spark, sf), station_source.default_stations(spark))
    return joined.select("arrival_seq", "station_id", "lat", "lon")


def _pairs(spark, sf, **options):
    located = _located(spark, sf)
    splits = pairs.hot_plate_splits(located)
    return pairs.plate_pairs(located, carry=["lat", "lon", "mask"], splits=splits, **options)


def plate_pairs(spark, sf):
    return plain_time(_pairs(spark, sf).select(
        "hphm", "prev_arrival_seq", "cur_arrival_seq", "prev_station_id", "cur_station_id", "prev_gcsj", "cur_gcsj"
    ))


def plate_history(spark, sf):
    usable = filters.filter_plate_present(_good(spark, sf))
    history = pairs.plate_history(usable)
    return history.select("arrival_seq", "hphm", "history_size")


# ---- aggregations ----


def station_window_count(spark, sf):
    return plain_time(stats.station_window_count(_clean(spark, sf)))


def station_by_dir(spark, sf):
    d = stats.station_by_dir(_clean(spark, sf), REPORT_WINDOW)
    return plain_time(d.withColumn("by_dir", histogram_json(F.col("by_dir"))))


def station_by_type(spark, sf):
    d = stats.station_by_type(_clean(spark, sf), REPORT_WINDOW)
    return plain_time(d.withColumn("by_type", histogram_json(F.col("by_type"))))


def station_stats(spark, sf):
    return plain_time(stats.stats_rows(stats.station_stats(_clean(spark, sf))))


def station_stats_30min(spark, sf):
    return plain_time(stats.stats_rows(stats.station_stats(_clean(spark, sf), REPORT_WINDOW)))


def histogram_json_(spark, sf):
    d = stats.station_by_type(_clean(spark, sf), REPORT_WINDOW)
    return plain_time(d.select("station_id", "window_start", histogram_json(F.col("by_type")).alias("histogram")))


def dedup_passes(spark, sf):
    return dedup(enrich.enrich_passes(_good(spark, sf))).select("arrival_seq", "gcxh", "station_id", "hphm")


def dedup_passes_ttl(spark, sf):
    """Serial ids in reuse: a thousand of them over the whole table, remembered for two hours."""
    p = _good(spark, sf).withColumn("gcxh", F.when(F.col("gcxh") > 0, F.col("gcxh") % 1000 + 1).otherwise(F.lit(0)))
    return dedup_ttl(enrich.enrich_passes(p), hours=2).select("arrival_seq", "gcxh", "station_id", "hphm")


def clean_passes_days(spark, sf):
    """The traffic job's dedup over a month: ingest times a hundred times as far apart, a thousand ids in reuse."""
    p = fx.passes(spark, sf).withColumn("gcxh", F.when(F.col("gcxh") > 0, F.col("gcxh") % 1000 + 1).otherwise(F.lit(0)))
    apart = F.timestamp_micros(F.lit(fx.T0) + (F.unix_micros("ingest_time") - F.lit(fx.T0)) * 100)
    clean = traffic.clean_passes(p.withColumn("ingest_time", apart))
    return clean.select("arrival_seq", "gcxh", "station_id", "hphm")


# ---- scalar functions ----


def haversine_km(spark, sf):
    """Distance from each pass's station to a point that depends on the pass; some points are NaN."""
    p = clones.join_station(fx.passes(spark, sf), station_source.default_stations(spark))
    e = F.col("event_id")
    lat2 = F.when(e % 71 == 0, F.lit(float("nan"))).otherwise(20 + (e % 300) / 10)
    lon2 = 90 + (e % 331) / 10
    d = p.select("arrival_seq", geo.haversine_km(F.col("lat"), F.col("lon"), lat2, lon2).alias("distance_km"))
    return rounded(d, "distance_km")


def _gap() -> Column:
    return time.time_gap_sec(F.col("cur_gcsj"), F.col("prev_gcsj"))


def _distance() -> Column:
    return geo.haversine_km(F.col("cur_lat"), F.col("cur_lon"), F.col("prev_lat"), F.col("prev_lon"))


_PAIR_ID = ["prev_arrival_seq", "cur_arrival_seq"]


def time_gap_sec(spark, sf):
    return _pairs(spark, sf).select(*_PAIR_ID, _gap().alias("time_gap_sec"))


def implied_speed_kmh(spark, sf):
    """Speeds of the candidate pairs, and the infinite one of a zero gap."""
    d = _pairs(spark, sf).select(*_PAIR_ID, _distance().alias("d"), _gap().alias("gap"))
    d = d.select(
        *_PAIR_ID,
        geo.implied_speed_kmh(F.col("d"), F.col("gap")).alias("speed_kmh"),
        (geo.implied_speed_kmh(F.col("d"), F.col("gap") - F.col("gap")) == float("inf")).alias("zero_gap_is_infinite"),
    )
    return rounded(d, "speed_kmh")


def is_overspeed(spark, sf):
    """The predicate at a limit of 160 km/h. Speeds that are no number or infinite stand in for some."""
    every = F.col("cur_arrival_seq") % 29
    speed = (
        F.when(every == 0, F.lit(float("nan"))).when(every == 1, F.lit(float("inf")))
        .otherwise(geo.implied_speed_kmh(_distance(), _gap()))
    )
    return _pairs(spark, sf).select(*_PAIR_ID, geo.is_overspeed(speed, 160.0).alias("overspeed"))


def clone_confidence(spark, sf):
    speed = geo.implied_speed_kmh(_distance(), _gap())
    d = _pairs(spark, sf).select(*_PAIR_ID, geo.clone_confidence(speed, 900.0).alias("confidence"))
    return rounded(d, "confidence")


def order_pair(spark, sf):
    first, second = geo.order_pair(
        F.col("cur_gcsj"), F.col("cur_station_id"), F.col("prev_gcsj"), F.col("prev_station_id")
    )
    return _pairs(spark, sf).select(*_PAIR_ID, first.alias("first_station_id"), second.alias("second_station_id"))


def second_bucket(spark, sf):
    """Buckets of the pass times and of times as far before 1970."""
    p = fx.passes(spark, sf)
    mirrored = F.timestamp_micros(-F.unix_micros("gcsj"))
    return p.select(
        "arrival_seq",
        time.second_bucket(F.col("gcsj")).alias("bucket"),
        time.second_bucket(mirrored).alias("mirrored_bucket"),
    )


# ---- sinks and whole jobs ----


def sink_pass_detail(spark, sf):
    """The detail table after writing its load twice, as after a replay."""
    path = shared_dir(spark, "detail")
    detail = shard.shard_by_station(enrich.pass_detail(_clean(spark, sf)))
    for _ in range(2):
        files.append_load(detail, path, 0)
    return plain_time(files.read_loads(spark, path).drop("created_at"))


def upsert_stats(spark, sf):
    """Two loads that overlap: passes up to hour four, then those from hour three (not on a window edge) on."""
    clean = _clean(spark, sf)
    until, since = F.expr("timestamp'2024-01-01 04:00:00'"), F.expr("timestamp'2024-01-01 03:00:15'")
    current = stats.stats_rows(stats.station_stats(clean.filter(F.col("gcsj") < until)))
    new = stats.stats_rows(stats.station_stats(clean.filter(F.col("gcsj") >= since)))
    return plain_time(merge.upsert_stats(current, new))


def upsert_stats_buckets(spark, sf):
    """The same two loads, merged into buckets of an hour as they are written; the second again under its number."""
    path = shared_dir(spark, "buckets")
    clean = _clean(spark, sf)
    until, since = F.expr("timestamp'2024-01-01 04:00:00'"), F.expr("timestamp'2024-01-01 03:00:15'")
    loads = [clean.filter(F.col("gcsj") < until), clean.filter(F.col("gcsj") >= since)]
    write = keyed.upsert_batches(path)
    for number, load in enumerate([*loads, loads[1]]):
        write(stats.stats_rows(stats.station_stats(load)), min(number, 1))
    return plain_time(keyed.read_buckets(spark, path))


def reload_stats(spark, sf):
    """A load of statistics written again with those of even stations only: nothing of the first attempt stays."""
    path = shared_dir(spark, "reload")
    rows = shard.shard_by_station(stats.stats_rows(stats.station_stats(_clean(spark, sf), REPORT_WINDOW)))
    files.append_load(rows, path, 0)
    files.append_load(rows.filter("shard = 0"), path, 0)
    return plain_time(files.read_latest(spark, path).drop("shard"))


ALERT_DOUBLES = ["distance_km", "speed_kmh", "confidence"]


def clone_alerts(spark, sf):
    alerts = clones.clone_alerts(fx.passes(spark, sf), station_source.default_stations(spark))
    return rounded(alerts, *ALERT_DOUBLES)


def clone_alerts_code_defaults(spark, sf):
    """Limits of 160 km/h and 10 s."""
    settings = CloneSettings(max_speed_kmh=160.0, min_gap_s=10)
    alerts = clones.clone_alerts(fx.passes(spark, sf), station_source.default_stations(spark), settings)
    return rounded(alerts, *ALERT_DOUBLES)


def sink_clone_alerts(spark, sf):
    """Alerts read back from their table, written twice under one load id."""
    path = shared_dir(spark, "alerts")
    alerts = clones.clone_alerts(fx.passes(spark, sf), station_source.default_stations(spark))
    for _ in range(2):
        files.append_load(shard.shard_by_station(alerts), path, 0)
    return rounded(files.read_loads(spark, path), *ALERT_DOUBLES)


def shard_by_station(spark, sf):
    return shard.shard_by_station(fx.passes(spark, sf)).select("arrival_seq", "station_id", "shard")


def _traffic_job(spark, sf):
    return traffic.run_traffic_records(fx.records(spark, sf), shared_dir(spark, "traffic"))


def traffic_detail(spark, sf):
    """Traffic job from messages to the written detail table."""
    return plain_time(_traffic_job(spark, sf).detail.drop("created_at", "dt"))


def traffic_stats(spark, sf):
    """Traffic job from messages to the written statistics table."""
    return plain_time(_traffic_job(spark, sf).stats.drop("dt"))


def clone_job(spark, sf):
    """Clone job from messages to the written alert table."""
    out = shared_dir(spark, "clones")
    alerts = clones.run_clone_records(fx.records(spark, sf), station_source.default_stations(spark), out)
    return rounded(alerts.drop("created_at"), *ALERT_DOUBLES)


def clone_rejects(spark, sf):
    """Messages that the clone job leaves out, and why; its decoder also drops bad times."""
    return decoding.split_narrow(fx.records(spark, sf), keep=["arrival_seq"])[1].select("arrival_seq", "reject")


QUERIES = {
    "decode_passes": decode_passes,
    "decode_passes_narrow": decode_passes_narrow,
    "decode_rejects": decode_rejects,
    "station_dim": station_dim,
    "dict_lookup": dict_lookup,
    "json_roundtrip": json_roundtrip,
    "filter_essential": filter_essential,
    "filter_plate_present": filter_plate_present,
    "fill_missing": fill_missing,
    "map_vehicle_type": map_vehicle_type,
    "mask_plate": mask_plate,
    "enrich_passes": enrich_passes,
    "empty_tags": empty_tags,
    "dedup_key": dedup_key,
    "station_has_geo": station_has_geo,
    "pass_detail": pass_detail,
    "join_station": join_station,
    "plate_pairs": plate_pairs,
    "station_window_count": station_window_count,
    "station_by_dir": station_by_dir,
    "station_by_type": station_by_type,
    "station_stats": station_stats,
    "station_stats_30min": station_stats_30min,
    "dedup_passes": dedup_passes,
    "dedup_passes_ttl": dedup_passes_ttl,
    "clean_passes_days": clean_passes_days,
    "plate_history": plate_history,
    "haversine_km": haversine_km,
    "time_gap_sec": time_gap_sec,
    "implied_speed_kmh": implied_speed_kmh,
    "is_overspeed": is_overspeed,
    "clone_confidence": clone_confidence,
    "order_pair": order_pair,
    "parse_pass_time": parse_pass_time,
    "second_bucket": second_bucket,
    "histogram_json": histogram_json_,
    "sink_pass_detail": sink_pass_detail,
    "upsert_stats": upsert_stats,
    "upsert_stats_buckets": upsert_stats_buckets,
    "reload_stats": reload_stats,
    "sink_clone_alerts": sink_clone_alerts,
    "shard_by_station": shard_by_station,
    "clone_alerts": clone_alerts,
    "clone_alerts_code_defaults": clone_alerts_code_defaults,
    "traffic_detail": traffic_detail,
    "traffic_stats": traffic_stats,
    "clone_job": clone_job,
    "clone_rejects": clone_rejects,
}
