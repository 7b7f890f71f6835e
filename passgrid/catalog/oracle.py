"""DuckDB SQL for the registered queries. Written from the rules, not from the Spark code."""

from __future__ import annotations

from passgrid.sources.stations import STATIONS

_PASSES = """
events_us AS (
  SELECT *, 1704067200000000 + (epoch_us(ts) - 1704067200000000) // 100 AS us,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 6 AS k
  FROM events
),
deliveries AS (
  SELECT *, 0 AS delay FROM events_us
  UNION ALL
  SELECT *, 21 AS delay FROM events_us WHERE event_id % 11 = 0
),
passes AS (
  SELECT event_id,
         event_id * 2 + delay AS arrival_seq,
         CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id + 1 END AS gcxh,
         CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 101 + (event_id * 7) % 20 END AS INTEGER) AS station_id,
         CASE user_id % 50 WHEN 0 THEN NULL WHEN 1 THEN '   '
              ELSE '苏A' || lpad(CAST(user_id AS VARCHAR), 5, '0') END AS hphm,
         CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ''
              ELSE '苏A***' || CAST(user_id % 10 AS VARCHAR) END AS hphm_mask,
         CASE WHEN event_type IN ('view', 'purchase') THEN '上行' WHEN event_type = 'error' THEN NULL
              ELSE '下行' END AS fxlx,
         CASE k WHEN 0 THEN NULL WHEN 1 THEN ' 1 ' WHEN 2 THEN '2' WHEN 3 THEN '13' WHEN 4 THEN '-'
              ELSE '新能源' END AS hpzl,
         make_timestamp(us) AS gcsj,
         CAST(320000 + user_id % 13 AS INTEGER) AS adcode,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'D' || CAST(user_id % 13 AS VARCHAR) END AS xzqhmc,
         CASE WHEN event_id % 8 = 0 THEN NULL ELSE 'K' || CAST(event_id % 20 AS VARCHAR) END AS kkmc,
         CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'M' || CAST(event_id % 9 AS VARCHAR) END AS clppxh,
         make_timestamp(us + CASE WHEN delay > 0 THEN 32000000 ELSE 2000000 END) AS ingest_time
  FROM deliveries
)"""

# The passes as the two decoders should see them.
_DECODED = """
full_decode AS (
  SELECT * REPLACE (CASE WHEN event_id % 43 = 0 OR (event_id % 53 = 0 AND event_id % 47 <> 0)
                         THEN ingest_time ELSE gcsj END AS gcsj)
  FROM passes WHERE event_id % 41 <> 0
),
narrow_decode AS (
  SELECT * REPLACE (CASE WHEN event_id % 53 = 0 AND event_id % 47 <> 0 THEN ingest_time ELSE gcsj END AS gcsj)
  FROM passes WHERE event_id % 41 <> 0 AND event_id % 43 <> 0
)"""

_MASK = "CASE WHEN trim(coalesce(hphm_mask, '')) <> '' THEN hphm_mask WHEN {absent} THEN 'UNKNOWN' " \
        "ELSE substr(hphm, 1, 4) || '****' END"
_DETAIL_MASK = _MASK.format(absent="coalesce(hphm, '') = ''")
_ALERT_MASK = _MASK.format(absent="trim(coalesce(hphm, '')) = ''")
_TYPE = """CASE WHEN hpzl IS NULL THEN '未知车型'
  ELSE CASE trim(hpzl) WHEN '1' THEN '小型汽车' WHEN '2' THEN '大型汽车' WHEN '13' THEN '农用运输车'
                       WHEN '-' THEN '未知车型' ELSE trim(hpzl) END END"""
_KEY = """CASE WHEN gcxh > 0 THEN 'id:' || CAST(gcxh AS VARCHAR)
  ELSE coalesce(hphm, '') || '|' || CAST(station_id AS VARCHAR) || '|' ||
       CAST(epoch_us(gcsj) // 1000000 AS VARCHAR) END"""


def _clean(source: str, prefix: str = "") -> str:
    return f"""
{prefix}good AS (SELECT * FROM {source} WHERE station_id > 0 AND gcsj IS NOT NULL),
{prefix}enriched AS (
  SELECT arrival_seq, gcxh, coalesce(xzqhmc, '') AS xzqhmc, adcode, coalesce(kkmc, '') AS kkmc, station_id,
         coalesce(fxlx, '') AS fxlx, gcsj, {_TYPE} AS hpzl, coalesce(hphm, '') AS hphm,
         {_DETAIL_MASK} AS hphm_mask, coalesce(clppxh, '') AS clppxh, {_KEY} AS dedup_key
  FROM {prefix}good
),
{prefix}clean AS (
  SELECT * FROM {prefix}enriched
  QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY arrival_seq) = 1
)"""


def _stats(source: str, seconds: int, name: str = "stats") -> str:
    def histogram(column: str) -> str:
        return f"""(SELECT station_id, w, '{{' || string_agg('"' || v || '":' || CAST(n AS VARCHAR), ',' ORDER BY v)
             || '}}' AS h
             FROM (SELECT station_id, epoch_us(gcsj) // {seconds}000000 AS w, {column} AS v, count(*) AS n
                   FROM {source} GROUP BY ALL) GROUP BY ALL)"""

    return f"""
{name} AS (
  SELECT c.station_id, make_timestamp(c.w * {seconds}000000) AS window_start,
         make_timestamp((c.w + 1) * {seconds}000000) AS window_end, c.cnt, d.h AS by_dir, t.h AS by_type
  FROM (SELECT station_id, epoch_us(gcsj) // {seconds}000000 AS w, count(*) AS cnt FROM {source} GROUP BY ALL) c
  JOIN {histogram('fxlx')} d ON d.station_id = c.station_id AND d.w = c.w
  JOIN {histogram('hpzl')} t ON t.station_id = c.station_id AND t.w = c.w
)"""


_STATION_ROWS = ", ".join(f"({i}, '{n}', {lat:.3f}::DOUBLE, {lon:.3f}::DOUBLE)" for i, n, lat, lon in STATIONS)
_STATIONS = f"""
stations AS (SELECT * FROM (VALUES {_STATION_ROWS}) AS s(station_id, name, lat, lon))"""

_HAVERSINE = """2 * 6371.0 * atan2(
  sqrt(pow(sin(radians({b1} - {a1}) / 2), 2)
       + cos(radians({a1})) * cos(radians({b1})) * pow(sin(radians({b2} - {a2}) / 2), 2)),
  sqrt(1 - (pow(sin(radians({b1} - {a1}) / 2), 2)
       + cos(radians({a1})) * cos(radians({b1})) * pow(sin(radians({b2} - {a2}) / 2), 2))))"""


def _pairs(source: str, min_gap: int = 20, earlier: str = "p.arrival_seq < c.arrival_seq") -> str:
    """Candidate pairs as a plain self-join on the plate."""
    km = _HAVERSINE.format(a1="c.lat", a2="c.lon", b1="p.lat", b2="p.lon")
    return f"""
located AS (
  SELECT x.arrival_seq, x.hphm, x.station_id, x.gcsj, {_ALERT_MASK} AS mask, lat, lon,
         epoch_us(x.gcsj) // 1000000 AS sec
  FROM {source} x JOIN stations USING (station_id)
  WHERE station_id > 0 AND gcsj IS NOT NULL AND trim(coalesce(hphm, '')) <> '' AND (lat <> 0 OR lon <> 0)
),
pairs AS (
  SELECT c.hphm, p.arrival_seq AS prev_arrival_seq, c.arrival_seq AS cur_arrival_seq,
         p.station_id AS prev_station_id, c.station_id AS cur_station_id, p.gcsj AS prev_gcsj, c.gcsj AS cur_gcsj,
         c.mask, abs(c.sec - p.sec) AS gap, {km} AS km
  FROM located c JOIN located p ON p.hphm = c.hphm AND {earlier} AND p.station_id <> c.station_id
   AND abs(c.sec - p.sec) BETWEEN {min_gap} AND 2700
),
speeds AS (SELECT *, km / (gap / 3600.0) AS kmh FROM pairs)"""


def _alerts(limit: float) -> str:
    return f"""
SELECT first_station_id AS station_id, mask AS hphm_mask, first_station_id, second_station_id, gap AS time_gap_sec,
       round(km, 6) AS distance_km, round(kmh, 6) AS speed_kmh,
       round(least(1.0, (kmh - {limit}) / {limit} + 0.5), 6) AS confidence
FROM (SELECT *, CASE WHEN cur_gcsj > prev_gcsj THEN prev_station_id ELSE cur_station_id END AS first_station_id,
             CASE WHEN cur_gcsj > prev_gcsj THEN cur_station_id ELSE prev_station_id END AS second_station_id
      FROM speeds WHERE kmh > {limit})"""


def _spaced(clock: str, hours: int) -> str:
    """Passes under a thousand ids that are kept again ``hours`` after the last one kept."""
    reused = "reused AS (SELECT * REPLACE (CASE WHEN gcxh > 0 THEN gcxh % 1000 + 1 ELSE 0 END AS gcxh) FROM passes)"
    chain = f"""
timed AS (SELECT e.*, p.seen FROM enriched e JOIN (SELECT arrival_seq, {clock} AS seen FROM passes) p USING (arrival_seq)),
chain AS (
  SELECT dedup_key, min(seen) AS t, arg_min(arrival_seq, (seen, arrival_seq)) AS arrival_seq
  FROM timed GROUP BY dedup_key
  UNION ALL
  SELECT c.dedup_key, min(e.seen), arg_min(e.arrival_seq, (e.seen, e.arrival_seq))
  FROM chain c JOIN timed e ON e.dedup_key = c.dedup_key AND e.seen >= c.t + INTERVAL {hours} HOUR
  GROUP BY c.dedup_key
)"""
    select = "SELECT e.arrival_seq, gcxh, station_id, hphm FROM chain JOIN enriched e USING (arrival_seq)"
    return "WITH RECURSIVE " + ",".join([_PASSES, reused, _clean("reused"), chain]) + "\n" + select


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_MESSAGE_PARTS = """concat_ws(',',
  '"gcxh":' || q || gcxh || q,
  '"xzqhmc":"' || xzqhmc || '"', '"adcode":' || adcode, '"kkmc":"' || kkmc || '"',
  '"station_id":' || q || station_id || q,
  '"fxlx":"' || fxlx || '"',
  CASE WHEN event_id % 43 = 0 THEN '"gcsj":"bad-time"' WHEN event_id % 53 = 0 AND event_id % 47 <> 0 THEN NULL
       ELSE '"gcsj":"' || strftime(gcsj, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"' END,
  '"hpzl":"' || hpzl || '"', '"hphm":"' || hphm || '"', '"hphm_mask":"' || hphm_mask || '"',
  '"clppxh":"' || clppxh || '"')"""

_DETAIL = "gcsj, xzqhmc, adcode, kkmc, station_id, fxlx, hpzl, hphm_mask, clppxh"
_STATS_SELECT = "SELECT station_id, window_start, window_end, cnt, by_dir, by_type FROM {name}"
_LATE = "event_id % 13 = 0"


def oracle_sql() -> dict[str, str]:
    clean = _clean("passes")
    decoded_clean = _clean("full_decode")
    pairs = _pairs("passes")
    sql = {
        "source_passes": _with(_PASSES, select=f"""
SELECT CASE WHEN event_id % 41 = 0 THEN 'not-json' ELSE '{{' || {_MESSAGE_PARTS} || '}}' END AS value
FROM (SELECT *, CASE WHEN event_id % 47 = 0 AND event_id % 43 <> 0 THEN '"' ELSE '' END AS q FROM passes)"""),
        "decode_passes": _with(_PASSES, _DECODED, select="""
SELECT arrival_seq, gcxh, xzqhmc, adcode, kkmc, station_id, fxlx, gcsj, hpzl, hphm, hphm_mask, clppxh
FROM full_decode"""),
        "decode_passes_narrow": _with(_PASSES, _DECODED, select="""
SELECT arrival_seq, gcxh, hphm, hphm_mask, station_id, gcsj, clppxh FROM narrow_decode"""),
        "decode_rejects": _with(_PASSES, select="""
SELECT arrival_seq, 'not-json' AS value FROM passes WHERE event_id % 41 = 0"""),
        "parse_pass_time": _with(_PASSES, select="""
SELECT arrival_seq, CASE event_id % 8
    WHEN 1 THEN NULL WHEN 3 THEN NULL WHEN 5 THEN NULL
    WHEN 6 THEN make_timestamp(epoch_us(gcsj) // 1000000 * 1000000 + 250000)
    ELSE make_timestamp(epoch_us(gcsj) // 1000000 * 1000000) END AS parsed
FROM passes"""),
        "station_dim": _with(_PASSES, _STATIONS, select="""
SELECT s.station_id, s.name, s.lat, s.lon, count(p.event_id) AS passes
FROM stations s LEFT JOIN passes p ON p.station_id = s.station_id GROUP BY ALL"""),
        "dict_lookup": _with(_PASSES, select="""
SELECT arrival_seq, adcode, n_name AS district,
       '{"name":"' || n_name || '","region":"' || r_name || '"}' AS entries
FROM passes LEFT JOIN nation ON 320000 + n_nationkey = adcode LEFT JOIN region ON r_regionkey = n_regionkey"""),
        "json_roundtrip": _with(_PASSES, select="""
SELECT arrival_seq, gcxh, station_id, hphm, fxlx, clppxh FROM passes"""),
        "filter_essential": _with(_PASSES, select="""
SELECT arrival_seq, station_id FROM passes WHERE station_id > 0 AND gcsj IS NOT NULL"""),
        "filter_plate_present": _with(_PASSES, select="""
SELECT arrival_seq, hphm FROM passes WHERE trim(hphm) <> ''"""),
        "fill_missing": _with(_PASSES, select="""
SELECT arrival_seq, coalesce(xzqhmc, '') AS xzqhmc, coalesce(kkmc, '') AS kkmc, coalesce(fxlx, '') AS fxlx,
       coalesce(hphm, '') AS hphm, coalesce(clppxh, '') AS clppxh FROM passes"""),
        "map_vehicle_type": _with(_PASSES, select=f"SELECT arrival_seq, {_TYPE} AS hpzl FROM passes"),
        "mask_plate": _with(_PASSES, select=f"""
SELECT arrival_seq, {_DETAIL_MASK} AS detail_mask, {_ALERT_MASK} AS alert_mask FROM passes"""),
        "enrich_passes": _with(_PASSES, clean, select="""
SELECT arrival_seq, gcxh, xzqhmc, adcode, kkmc, station_id, fxlx, gcsj, hpzl, hphm, hphm_mask, clppxh, '{}' AS tags
FROM enriched"""),
        "empty_tags": _with(_PASSES, select="SELECT arrival_seq, '{}' AS tags, 0 AS n_tags FROM passes"),
        "dedup_key": _with(_PASSES, clean, select="SELECT arrival_seq, dedup_key FROM enriched"),
        "station_has_geo": _with(_PASSES, _STATIONS, select="""
SELECT arrival_seq, station_id, lat, lon FROM passes JOIN stations USING (station_id) WHERE station_id % 6 <> 0"""),
        "pass_detail": _with(_PASSES, clean, select=f"SELECT {_DETAIL} FROM enriched"),
        "join_station": _with(_PASSES, _STATIONS, select="""
SELECT arrival_seq, station_id, lat, lon FROM passes JOIN stations USING (station_id)
WHERE station_id > 0 AND (lat <> 0 OR lon <> 0)"""),
        "plate_pairs": _with(_PASSES, _STATIONS, pairs, select="""
SELECT hphm, prev_arrival_seq, cur_arrival_seq, prev_station_id, cur_station_id, prev_gcsj, cur_gcsj FROM pairs"""),
        "plate_history": _with(_PASSES, select="""
SELECT c.arrival_seq, c.hphm, count(*) AS history_size
FROM passes c JOIN passes p ON p.hphm = c.hphm AND p.arrival_seq <= c.arrival_seq
  AND abs(epoch_us(c.gcsj) // 1000000 - epoch_us(p.gcsj) // 1000000) <= 2700
WHERE c.station_id > 0 AND p.station_id > 0 AND trim(c.hphm) <> '' GROUP BY ALL"""),
        "station_window_count": _with(_PASSES, clean, _stats("clean", 30), select="""
SELECT station_id, window_start, window_end, cnt FROM stats"""),
        "station_by_dir": _with(_PASSES, clean, _stats("clean", 1800), select="""
SELECT station_id, window_start, window_end, by_dir FROM stats"""),
        "station_by_type": _with(_PASSES, clean, _stats("clean", 1800), select="""
SELECT station_id, window_start, window_end, by_type FROM stats"""),
        "station_stats": _with(_PASSES, clean, _stats("clean", 30), select=_STATS_SELECT.format(name="stats")),
        "station_stats_30min": _with(_PASSES, clean, _stats("clean", 1800), select=_STATS_SELECT.format(name="stats")),
        "histogram_json": _with(_PASSES, clean, _stats("clean", 1800), select="""
SELECT station_id, window_start, by_type AS histogram FROM stats"""),
        "dedup_passes": _with(_PASSES, clean, select="SELECT arrival_seq, gcxh, station_id, hphm FROM clean"),
        "dedup_passes_ttl": _spaced("ingest_time", 2),
        "clean_passes_days": _spaced(
            "make_timestamp(1704067200000000 + (epoch_us(ingest_time) - 1704067200000000) * 100)", 24
        ),
        "haversine_km": _with(_PASSES, _STATIONS, select=f"""
SELECT arrival_seq, round(CASE WHEN event_id % 71 = 0 THEN 0.0 ELSE
  {_HAVERSINE.format(a1="lat", a2="lon", b1="lat2", b2="lon2")} END, 6) AS distance_km
FROM (SELECT *, 20 + (event_id % 300) / 10.0::DOUBLE AS lat2, 90 + (event_id % 331) / 10.0::DOUBLE AS lon2
      FROM passes JOIN stations USING (station_id))"""),
        "time_gap_sec": _with(_PASSES, _STATIONS, pairs, select="""
SELECT prev_arrival_seq, cur_arrival_seq, gap AS time_gap_sec FROM pairs"""),
        "implied_speed_kmh": _with(_PASSES, _STATIONS, pairs, select="""
SELECT prev_arrival_seq, cur_arrival_seq, round(kmh, 6) AS speed_kmh, true AS zero_gap_is_infinite FROM speeds"""),
        "is_overspeed": _with(_PASSES, _STATIONS, pairs, select="""
SELECT prev_arrival_seq, cur_arrival_seq,
       CASE cur_arrival_seq % 29 WHEN 0 THEN false WHEN 1 THEN true ELSE kmh > 160.0 END AS overspeed FROM speeds"""),
        "clone_confidence": _with(_PASSES, _STATIONS, pairs, select="""
SELECT prev_arrival_seq, cur_arrival_seq, round(least(1.0, (kmh - 900.0) / 900.0 + 0.5), 6) AS confidence
FROM speeds"""),
        "order_pair": _with(_PASSES, _STATIONS, pairs, select="""
SELECT prev_arrival_seq, cur_arrival_seq,
       CASE WHEN cur_gcsj > prev_gcsj THEN prev_station_id ELSE cur_station_id END AS first_station_id,
       CASE WHEN cur_gcsj > prev_gcsj THEN cur_station_id ELSE prev_station_id END AS second_station_id
FROM pairs"""),
        "second_bucket": _with(_PASSES, select="""
SELECT arrival_seq, epoch_us(gcsj) // 1000000 AS bucket,
       -((epoch_us(gcsj) + 999) // 1000 // 1000) AS mirrored_bucket FROM passes"""),
        "sink_pass_detail": _with(_PASSES, clean, select=f"SELECT {_DETAIL}, station_id % 2 AS shard FROM clean"),
        "upsert_stats": _with(
            _PASSES, clean,
            "early AS (SELECT * FROM clean WHERE gcsj < TIMESTAMP '2024-01-01 04:00:00')",
            "late AS (SELECT * FROM clean WHERE gcsj >= TIMESTAMP '2024-01-01 03:00:15')",
            _stats("early", 30, "stats_a"), _stats("late", 30, "stats_b"),
            select=_STATS_SELECT.format(name="stats_b") + " UNION ALL " + _STATS_SELECT.format(name="stats_a")
            + " WHERE (station_id, window_start) NOT IN (SELECT (station_id, window_start) FROM stats_b)"),
        "clone_alerts": _with(_PASSES, _STATIONS, pairs, select=_alerts(140.0)),
        "clone_alerts_code_defaults": _with(_PASSES, _STATIONS, _pairs("passes", 10), select=_alerts(160.0)),
        "sink_clone_alerts": _with(_PASSES, _STATIONS, pairs, select=f"""
SELECT *, station_id % 2 AS shard FROM ({_alerts(140.0)})"""),
        "shard_by_station": _with(_PASSES, select="""
SELECT arrival_seq, station_id, station_id % 2 AS shard FROM passes"""),
        "traffic_detail": _with(_PASSES, _DECODED, decoded_clean, select=f"""
SELECT {_DETAIL}, station_id % 2 AS shard FROM clean"""),
        "traffic_stats": _with(_PASSES, _DECODED, decoded_clean, _stats("clean", 30), select="""
SELECT *, station_id % 2 AS shard FROM stats"""),
        "clone_job": _with(_PASSES, _STATIONS, _DECODED, _pairs("narrow_decode"), select=f"""
SELECT *, station_id % 2 AS shard FROM ({_alerts(140.0)})"""),
        "clone_rejects": _with(_PASSES, select="""
SELECT arrival_seq, CASE WHEN event_id % 41 = 0 THEN 'not json' ELSE 'bad time' END AS reject
FROM passes WHERE event_id % 41 = 0 OR event_id % 43 = 0"""),
        "reload_stats": _with(_PASSES, clean, _stats("clean", 1800), select=_STATS_SELECT.format(name="stats")
                              + " WHERE station_id % 2 = 0"),
    }
    sql["upsert_stats_buckets"] = sql["upsert_stats"]
    # Streams give what the batch jobs give.
    sql["stream_dedup_passes"] = _with(_PASSES, clean, select="SELECT gcxh, station_id, hphm, gcsj FROM clean")
    sql["stream_station_stats"] = sql["station_stats"]
    sql["stream_traffic_detail"] = sql["traffic_detail"]
    sql["stream_traffic_stats"] = sql["traffic_stats"]
    sql["stream_upsert_stats"] = _with(_PASSES, _DECODED, decoded_clean, _stats("clean", 30),
                                       select=_STATS_SELECT.format(name="stats"))
    sql["stream_rejects"] = sql["clone_rejects"].replace("SELECT arrival_seq, CASE", "SELECT CASE", 1).replace(
        "WITH", "SELECT reject, count(*) AS messages FROM (WITH", 1) + ") GROUP BY reject"
    sql["stream_clone_alerts"] = sql["clone_job"]
    crowd = """
passes AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN '苏A99999' ELSE hphm END AS hphm,
    CASE WHEN event_id % 3 = 0 AND event_id % 150 <> 0 THEN 101 ELSE station_id END AS station_id) FROM plain
)"""
    sql["stream_clone_alerts_hot"] = sql["clone_job"].replace(_PASSES, _PASSES.replace("passes AS (", "plain AS (", 1) + ","
                                                              + crowd, 1)
    sql["stream_clone_alerts_spread"] = sql["stream_clone_alerts_hot"]
    sql["watermark_passes"] = _with(_PASSES, select="""
SELECT date_trunc('millisecond', max(gcsj)) - INTERVAL 120 SECOND AS watermark FROM passes WHERE station_id > 0""")
    # A pass is in the history until one arrives that lies beyond the horizon from it.
    sql["stream_plate_history"] = _with(_PASSES, _DECODED, """
usable AS (
  SELECT arrival_seq, hphm, epoch_us(gcsj) // 1000000 AS second FROM narrow_decode WHERE station_id > 0 AND trim(hphm) <> ''
),
gone AS (
  SELECT p.arrival_seq, min(x.arrival_seq) AS at
  FROM usable p JOIN usable x ON x.hphm = p.hphm AND x.arrival_seq > p.arrival_seq AND abs(x.second - p.second) > 2700
  GROUP BY p.arrival_seq
)""", select="""
SELECT c.arrival_seq, c.hphm, count(*) AS history_size
FROM usable c JOIN usable p ON p.hphm = c.hphm AND p.arrival_seq <= c.arrival_seq
  LEFT JOIN gone ON gone.arrival_seq = p.arrival_seq
WHERE gone.at IS NULL OR gone.at > c.arrival_seq GROUP BY ALL""")
    sql["stream_split"] = _with(_PASSES, select="""
SELECT arrival_seq, CASE WHEN event_id % 41 = 0 THEN 'not json' WHEN event_id % 43 = 0 THEN 'bad time' ELSE '' END AS reject
FROM passes""")
    sql["dedup_state_keys"] = _with(_PASSES, clean, select="SELECT dedup_key FROM clean")
    sql["stream_partition_stats"] = sql["station_stats"]
    sql["stream_late_counts"] = _with(_PASSES, select=f"""
SELECT count(*) AS late, CAST(1 AS BIGINT) AS triggers FROM passes WHERE station_id > 0 AND {_LATE}""")
    sql["stream_late_drop"] = _with(_PASSES, clean, select=f"""
SELECT 'stats' AS reached, count(*) AS passes FROM clean
UNION ALL
SELECT 'detail', (SELECT count(*) FROM clean) + (SELECT count(*) FROM passes WHERE station_id > 0 AND {_LATE})""")
    return sql
