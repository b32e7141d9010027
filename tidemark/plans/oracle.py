"""DuckDB SQL oracles for the named queries (same column names and types).

The relations are written out as CTEs over the given tables, exactly as
FIXTURES.md §3 defines them.
"""

from __future__ import annotations

RIDES = """rides AS (
  SELECT event_id AS ride_id, user_id,
         ['Columbus','Cleveland','Cincinnati','Toledo'][CAST(user_id % 4 AS INT) + 1] AS pickup_city,
         value AS fare, event_type AS status, ts AS event_time
  FROM events)"""

DELIVERIES = RIDES + """,
deliveries AS (
  SELECT *, CAST(user_id % 4 AS INT) AS part,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY ride_id, copy) - 1 AS off
  FROM (SELECT *, 0 AS copy FROM rides
        UNION ALL SELECT *, 1 AS copy FROM rides WHERE ride_id % 7 = 0))"""

FEED = RIDES + """,
feed AS (
  SELECT *, CAST(floor(epoch(event_time) / 86400) AS BIGINT)
            + CASE WHEN ride_id % 11 = 0 THEN 3 ELSE 0 END AS batch
  FROM rides)"""

ISO_MS = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%gZ')"
ISO_OFFSET = ("strftime({t}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({t}) % 1000000 = 0 "
              "THEN '' ELSE '.' || lpad(CAST(epoch_us({t}) % 1000000 AS VARCHAR), 6, '0') END "
              "|| '+00:00'")

SQL: dict[str, str] = {}

SQL["raw_scan"] = f"WITH {RIDES} SELECT ride_id, pickup_city, fare, event_time FROM rides"

SQL["bounded_scan"] = (f"WITH {RIDES} SELECT pickup_city AS city, fare FROM rides "
                       "ORDER BY ride_id LIMIT 5")

SQL["iso_format"] = (f"WITH {RIDES} SELECT ride_id, {ISO_MS.format(t='event_time')} AS event_time_text, "
                     f"{ISO_OFFSET.format(t='event_time')} AS event_time_offset_text FROM rides")

SQL["iso_parse"] = (f"WITH {RIDES} SELECT ride_id, date_trunc('milliseconds', event_time) AS parsed_ms, "
                    "event_time AS parsed_us FROM rides")

SQL["duplicate_audit"] = (f"WITH {DELIVERIES} SELECT count(*) AS processed, "
                          "count(DISTINCT ride_id) AS unique_rides, "
                          "count(*) - count(DISTINCT ride_id) AS duplicates FROM deliveries")

SQL["duplicate_flag"] = (f"WITH {DELIVERIES} SELECT ride_id, part, off, "
                         "row_number() OVER (PARTITION BY ride_id ORDER BY part, off) > 1 "
                         "AS is_duplicate FROM deliveries")

SQL["dedup_keep_first"] = (f"WITH {DELIVERIES} SELECT ride_id, pickup_city, fare, status, event_time, "
                           "part, off FROM deliveries "
                           "QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY part, off) = 1")

_LI_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate"))
SQL["dedup_keep_first_lineitem"] = (
    "SELECT * FROM lineitem QUALIFY row_number() OVER "
    f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ORDER}) = 1")

_CRASHED = DELIVERIES + """,
crashed AS (
  SELECT *, floor(end_offset * 0.5) AS processed, floor(end_offset * 0.45) AS committed
  FROM (SELECT *, max(off) OVER (PARTITION BY part) + 1 AS end_offset FROM deliveries))"""

_INCR = _CRASHED + """,
seen AS (SELECT ride_id FROM crashed WHERE off < processed),
inp AS (SELECT ride_id, part, off FROM crashed WHERE off >= committed),
fresh AS (
  SELECT ride_id, part, off FROM inp
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.ride_id IS NOT DISTINCT FROM inp.ride_id)
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY part, off) = 1)"""

SQL["dedup_incremental"] = f"WITH {_INCR} SELECT ride_id, part, off FROM fresh"

SQL["dedup_saved_state"] = SQL["dedup_incremental"]

SQL["run_summary"] = (f"WITH {_INCR} SELECT "
                      "(SELECT count(DISTINCT ride_id) FROM seen) AS known_before, "
                      "(SELECT count(*) FROM fresh) AS processed, "
                      "(SELECT count(*) FROM inp) - (SELECT count(*) FROM fresh) AS skipped")

SQL["crash_replay"] = (f"WITH {_CRASHED}, replay AS ("
                       "SELECT ride_id FROM crashed WHERE off < processed "
                       "UNION ALL SELECT ride_id FROM crashed WHERE off >= committed) "
                       "SELECT count(*) AS naive_processed, count(DISTINCT ride_id) AS idempotent_processed, "
                       "count(*) - count(DISTINCT ride_id) AS double_processed FROM replay")

SQL["resume_from_offsets"] = f"WITH {_CRASHED} SELECT ride_id, part, off FROM crashed WHERE off >= processed"


def _tumble_sql(width: str) -> str:
    return (f"SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start, "
            f"time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end, "
            "pickup_city, count(*) AS ride_count FROM rides "
            "WHERE event_time IS NOT NULL GROUP BY 1, 2, 3")


def _closed_sql(width: str) -> str:
    return (f"WITH {RIDES}, c AS ({_tumble_sql(width)}) SELECT * FROM c WHERE window_end <= "
            "(SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 5 SECOND FROM rides)")


SQL["tumble_count"] = f"WITH {RIDES} {_tumble_sql('10 seconds')}"
SQL["tumble_count_1h"] = f"WITH {RIDES} {_tumble_sql('1 hour')}"
SQL["tumble_count_closed"] = _closed_sql("10 seconds")
SQL["tumble_count_closed_1h"] = _closed_sql("1 hour")

def _trace(lag: int = 2) -> str:
    return FEED + f""",
trace AS (
  SELECT batch, batch_max,
         date_trunc('milliseconds', max(batch_max) OVER
           (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND {lag} PRECEDING))
           - INTERVAL 5 SECOND AS watermark
  FROM (SELECT batch, max(event_time) AS batch_max FROM feed GROUP BY batch))"""


_TRACE = _trace()

SQL["watermark_trace"] = f"WITH {_TRACE} SELECT batch, batch_max, watermark FROM trace"


def _classified(width: str, lag: int = 2) -> str:
    return _trace(lag) + f""",
classified AS (
  SELECT f.ride_id, f.batch, f.pickup_city, f.event_time,
         time_bucket(INTERVAL '{width}', f.event_time) AS window_start,
         time_bucket(INTERVAL '{width}', f.event_time) + INTERVAL '{width}' AS window_end,
         coalesce(time_bucket(INTERVAL '{width}', f.event_time) + INTERVAL '{width}'
                  <= t.watermark, false) AS is_late
  FROM feed f LEFT JOIN trace t ON f.batch = t.batch)"""


SQL["late_classify"] = (f"WITH {_classified('10 seconds')} "
                        "SELECT ride_id, batch, window_start, window_end, is_late FROM classified")

for _key, _w, _lag in (("late_drop_count", "10 seconds", 2), ("late_drop_count_1h", "1 hour", 2),
                       ("late_drop_count_1d", "1 day", 2),
                       ("late_drop_count_ideal", "10 seconds", 1)):
    SQL[_key] = (f"WITH {_classified(_w, _lag)} SELECT count(*) FILTER (WHERE NOT is_late AND event_time IS NOT NULL) "
                 "AS kept_rows, count(*) FILTER (WHERE is_late) AS dropped_rows, "
                 "count(*) FILTER (WHERE event_time IS NULL) AS no_event_time FROM classified")

_RECS = RIDES + f""",
recs AS (
  SELECT ride_id AS rid, CAST(ride_id AS VARCHAR) AS ride_id,
         'rider-' || CAST(user_id AS VARCHAR) AS rider_name, pickup_city,
         ['Columbus','Cleveland','Cincinnati','Toledo'][CAST((user_id + 1) % 4 AS INT) + 1] AS dropoff_city,
         fare, status, {ISO_MS.format(t='event_time')} AS event_time
  FROM rides)"""

_JSON = ("CAST(to_json({'ride_id': ride_id, 'rider_name': rider_name, 'pickup_city': pickup_city, "
         "'dropoff_city': dropoff_city, 'fare': fare, 'status': status, "
         "'event_time': event_time}) AS VARCHAR)")

SQL["json_topic_encode"] = (f"WITH {_RECS} SELECT rid AS ride_id, {_JSON} AS value_text, "
                            f"CAST(strlen({_JSON}) AS BIGINT) AS value_bytes FROM recs")

SQL["json_topic_decode"] = (f"WITH {_RECS} SELECT ride_id, rider_name, pickup_city, dropoff_city, "
                            "fare, status, event_time FROM recs")

SQL["raw_scan_declared"] = (f"WITH {RIDES} SELECT CAST(ride_id AS VARCHAR) AS ride_id, pickup_city, "
                            "fare, date_trunc('milliseconds', event_time) AS event_time FROM rides")

_VIOLATIONS = ("concat_ws(',', CASE WHEN ride_id % 13 = 0 THEN 'type:fare' END, "
               "CASE WHEN ride_id % 17 = 0 THEN 'missing:status' END)")

SQL["contract_validate"] = (f"WITH {RIDES} SELECT CAST(ride_id AS VARCHAR) AS ride_id, "
                            f"{_VIOLATIONS} AS violations FROM rides")

SQL["contract_accept"] = (f"WITH {_RECS} SELECT ride_id, rider_name, pickup_city, dropoff_city, "
                          "fare, status, event_time FROM recs WHERE rid % 13 <> 0 AND rid % 17 <> 0")

SQL["contract_quarantine"] = (f"WITH {RIDES} SELECT CAST(ride_id AS VARCHAR) AS ride_id, "
                              f"{_VIOLATIONS} AS violations FROM rides "
                              "WHERE ride_id % 13 = 0 OR ride_id % 17 = 0")

SQL["contract_summary"] = (f"WITH {RIDES} SELECT 'fare' AS field, 'type' AS kind, count(*) AS n "
                           "FROM rides WHERE ride_id % 13 = 0 UNION ALL "
                           "SELECT 'status', 'missing', count(*) FROM rides WHERE ride_id % 17 = 0")

SQL["evolve_union"] = (f"WITH {RIDES} SELECT ride_id, pickup_city, fare, "
                       "CASE WHEN ride_id % 2 = 1 THEN fare / 100 END AS driver_rating FROM rides")

SQL["frame_split"] = (f"WITH {RIDES} SELECT ride_id, 0 AS magic, 1 + ride_id % 2 AS schema_id, "
                      "CAST(strlen(pickup_city) AS BIGINT) AS body_len, "
                      "CAST(5 + strlen(pickup_city) AS BIGINT) AS frame_len, "
                      "pickup_city AS body_text, CAST(NULL AS VARCHAR) AS problem FROM rides")

SQL["frame_route"] = (f"WITH {RIDES} SELECT r.ride_id, 1 + r.ride_id % 3 AS schema_id, "
                      "g.subject, g.version FROM rides r LEFT JOIN "
                      "(VALUES (1, 'rides_avro-value', 1), (2, 'rides_avro-value', 2)) "
                      "g(schema_id, subject, version) ON 1 + r.ride_id % 3 = g.schema_id")

SQL["schema_latest"] = (f"WITH {RIDES} SELECT 'rides_avro-value' AS subject, 2 AS version, "
                        "CAST(2 AS BIGINT) AS schema_id, count(*) AS records "
                        "FROM rides WHERE 1 + ride_id % 2 = 2")

SQL["stream_tumble_count"] = (
    f"WITH {RIDES}, c AS ("
    "SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start, "
    "time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end, "
    "status, count(*) AS ride_count FROM rides WHERE event_time IS NOT NULL GROUP BY 1, 2, 3) "
    "SELECT * FROM c WHERE window_end <= "
    "(SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 5 SECOND FROM rides)")

SQL["stream_late_replay"] = (
    f"WITH {_classified('10 seconds')}, c AS ("
    "SELECT window_start, window_end, pickup_city, count(*) AS ride_count FROM classified "
    "WHERE NOT is_late GROUP BY 1, 2, 3) SELECT * FROM c WHERE window_end <= "
    "(SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 5 SECOND FROM feed)")

SQL["watermark_policy"] = (
    f"WITH {RIDES}, a AS (SELECT * FROM rides), "
    "b AS (SELECT * FROM rides WHERE dayofmonth(event_time) = 1), "
    "u AS (SELECT * FROM a UNION ALL SELECT * FROM b), "
    "m AS (SELECT (SELECT date_trunc('milliseconds', max(event_time)) FROM a) AS ma, "
    "(SELECT date_trunc('milliseconds', max(event_time)) FROM b) AS mb), "
    "c AS (SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start, "
    "time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end, "
    "pickup_city, count(*) AS ride_count FROM u GROUP BY 1, 2, 3) "
    "SELECT 'min' AS policy, c.* FROM c, m WHERE window_end <= least(ma, mb) - INTERVAL 5 SECOND "
    "UNION ALL "
    "SELECT 'max' AS policy, c.* FROM c, m WHERE window_end <= greatest(ma, mb) - INTERVAL 5 SECOND")

SQL["stream_dedup"] = f"WITH {DELIVERIES} SELECT DISTINCT ride_id FROM deliveries"
SQL["stream_dedup_bounded"] = SQL["stream_dedup"]

_ENDS = DELIVERIES + """,
ends AS (SELECT 'rides_chaos' AS topic, part, max(off) + 1 AS end_offset FROM deliveries GROUP BY part),
commits AS (
  SELECT 'naive-consumer-group' AS grp, topic, part, CAST(floor(end_offset * 0.9) AS BIGINT) AS committed FROM ends
  UNION ALL
  SELECT 'idempotent-consumer-group', topic, part,
         CASE WHEN part <> 3 THEN CAST(floor(end_offset * 0.75) AS BIGINT) END FROM ends)"""

SQL["consumer_lag"] = (f"WITH {_ENDS} SELECT c.grp, e.topic, e.part, e.end_offset, c.committed, "
                       "e.end_offset - c.committed AS lag FROM ends e JOIN commits c "
                       "ON e.topic = c.topic AND e.part = c.part")

SQL["topic_rate"] = (f"WITH {DELIVERIES}, s AS ("
    "SELECT status AS topic, part, time_bucket(INTERVAL '1 hour', event_time) AS ts, "
    "arg_max(off, (event_time, off)) AS value FROM deliveries GROUP BY 1, 2, 3), "
    "d AS (SELECT *, CAST(ts AS DATE) AS day, lag(value) OVER (PARTITION BY topic, part, "
    "CAST(ts AS DATE) ORDER BY ts) AS prev FROM s), "
    "r AS (SELECT topic, part, day, sum(CASE WHEN prev IS NULL THEN NULL WHEN value < prev "
    "THEN value ELSE value - prev END) AS incr, "
    "(epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS span FROM d GROUP BY 1, 2, 3) "
    "SELECT topic, day, round(sum(CASE WHEN span > 0 THEN incr / span END), 9) AS rate "
    "FROM r GROUP BY 1, 2")

SQL["offset_progress"] = (f"WITH {DELIVERIES}, p AS (SELECT 'rides_chaos' AS topic, part, "
                          "time_bucket(INTERVAL '1 hour', event_time) AS ts, "
                          "arg_max(off, (event_time, off)) + 1 AS held "
                          "FROM deliveries GROUP BY 1, 2, 3) "
                          "SELECT grp, topic, part, ts, CAST(floor(held * share) AS BIGINT) AS committed_offset "
                          "FROM p, (VALUES ('naive-consumer-group', 0.9), ('idempotent-consumer-group', 0.75)) "
                          "AS g(grp, share)")

# the log holds the seven fields of v1 in every accepted record
SQL["schema_compat"] = (
    f"WITH {_RECS}, ok AS (SELECT * FROM recs WHERE rid % 13 <> 0 AND rid % 17 <> 0), "
    "seen AS (SELECT count(*) AS n FROM ok), "
    "told AS (SELECT * FROM (VALUES "
    "(NULL, 'v1', 'compatible', ''), (NULL, 'v2_safe', 'compatible', ''), "
    "(NULL, 'v2_breaking', 'incompatible', 'missing:payment_method'), (NULL, 'v2_removed', 'compatible', ''), "
    "('rides_avro-value', 'v1', 'compatible', ''), ('rides_avro-value', 'v2_safe', 'compatible', ''), "
    "('rides_avro-value', 'v2_breaking', 'incompatible', "
    "'reader field ''payment_method'' has no default and is missing in writer'), "
    "('rides_avro-value', 'v2_removed', 'compatible', ''), "
    "('rides_new-value', 'v1', 'nothing_registered', ''), ('rides_new-value', 'v2_safe', 'nothing_registered', ''), "
    "('rides_new-value', 'v2_breaking', 'nothing_registered', ''), "
    "('rides_new-value', 'v2_removed', 'nothing_registered', '')) AS t(subject, candidate, status, problems)) "
    "SELECT CAST(subject AS VARCHAR) AS subject, candidate, status, problems FROM told, seen WHERE n > 0")

# a micro-batch runs under the newest event time of the batches before it
SQL["stream_progress"] = (
    f"WITH {FEED}, b AS (SELECT batch, count(*) AS n, max(event_time) AS newest FROM feed GROUP BY batch) "
    "SELECT row_number() OVER (ORDER BY batch) - 1 AS batch_id, n AS num_input_rows, "
    "coalesce(date_trunc('milliseconds', max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING)) - INTERVAL 5 SECOND, TIMESTAMP '1970-01-01 00:00:00') AS watermark FROM b")

SQL["gauge_latest"] = (f"WITH {RIDES} SELECT pickup_city AS city, max(event_time) AS latest_ts, "
                       "arg_max(fare, (event_time, ride_id)) AS latest_value FROM rides GROUP BY 1")

SQL["partition_total"] = (f"WITH {DELIVERIES}, g AS (SELECT status AS topic, CAST(event_time AS DATE) AS day, "
                          "count(DISTINCT part) AS partitions FROM deliveries GROUP BY 1, 2) "
                          "SELECT CAST(sum(v) AS BIGINT) AS partition_total FROM "
                          "(SELECT topic, arg_max(partitions, (day, partitions)) AS v FROM g GROUP BY 1)")

SQL["scrape_grid"] = (f"WITH {RIDES}, r AS (SELECT * FROM rides WHERE event_time > "
                      "(SELECT max(event_time) FROM rides) - INTERVAL 15 DAY) "
                      "SELECT pickup_city AS city, time_bucket(INTERVAL '5 seconds', event_time) AS ts, "
                      "arg_max(fare, (event_time, ride_id)) AS value FROM r GROUP BY 1, 2")

SQL["configured_ingest"] = SQL["raw_scan"]

SQL["flagship"] = (
    f"WITH {RIDES}, ok AS (SELECT * FROM rides WHERE ride_id % 13 <> 0 AND ride_id % 17 <> 0), "
    "c AS (SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start, "
    "time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end, "
    "pickup_city, count(*) AS ride_count FROM ok GROUP BY 1, 2, 3) "
    "SELECT * FROM c WHERE window_end <= "
    "(SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 5 SECOND FROM rides)")

SQL["avro_decode"] = (f"WITH {RIDES} SELECT ride_id, pickup_city, fare, status, "
                      "CASE WHEN ride_id % 2 = 1 THEN fare / 100 END AS driver_rating, "
                      "CAST(NULL AS VARCHAR) AS problem FROM rides")

SQL["stream_contract_split"] = (
    f"WITH {_RECS} SELECT 'accepted' AS side, ride_id, rider_name, pickup_city, dropoff_city, fare, status, "
    "event_time, CAST(NULL AS VARCHAR) AS violations FROM recs WHERE rid % 13 <> 0 AND rid % 17 <> 0 "
    "UNION ALL SELECT 'quarantined', CAST(rid AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, "
    "concat_ws(',', CASE WHEN rid % 13 = 0 THEN 'type:fare' END, CASE WHEN rid % 17 = 0 THEN 'missing:status' END) "
    "FROM recs WHERE rid % 13 = 0 OR rid % 17 = 0")

# five runs; a key is taken by the first run that reads it, at its first place among what that run reads
SQL["dedup_key_store"] = (
    f"WITH {DELIVERIES}, e AS (SELECT *, max(off) OVER (PARTITION BY part) + 1 AS end_offset FROM deliveries), "
    "runs AS (SELECT * FROM (VALUES (1, 0.0, 0.2), (2, 0.15, 0.4), (3, 0.35, 0.6), (4, 0.55, 0.8), (5, 0.75, 1.0)) "
    "AS r(run, low, high)) "
    "SELECT ride_id, part, off, run FROM e JOIN runs ON off >= floor(end_offset * low::DOUBLE) AND off < floor(end_offset * high::DOUBLE) "
    "QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY run, part, off) = 1")

SQL["resume_stored_log"] = (
    f"WITH {DELIVERIES}, e AS (SELECT *, max(off) OVER (PARTITION BY part) + 1 AS end_offset FROM deliveries) "
    "SELECT ride_id, part, off FROM e WHERE off >= floor(end_offset * 0.9)")

# ids in order of registration: rides v1, rides v2_safe, deliveries v2_breaking, deliveries v1
SQL["registry_usage"] = (
    f"WITH {RIDES}, u AS (SELECT 1 + ride_id % 5 AS schema_id, count(*) AS records FROM rides GROUP BY 1) "
    "SELECT u.schema_id, g.subject, g.version, records FROM u LEFT JOIN (VALUES (1, 'rides_avro-value', 1), "
    "(2, 'rides_avro-value', 2), (3, 'deliveries-value', 1), (4, 'deliveries-value', 2)) AS g(schema_id, subject, version) ON u.schema_id = g.schema_id")

_ARRIVALS = FEED + """,
arrivals AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY batch, ride_id) - 1 AS off
  FROM (SELECT *, CAST(CASE WHEN user_id % 4 = 3 AND dayofmonth(event_time) > 10 THEN 2 ELSE user_id % 4 END AS INT) AS part
        FROM feed)),
per AS (SELECT part, batch, max(event_time) AS newest FROM arrivals GROUP BY 1, 2),
days AS (SELECT unnest(range(min(batch), max(batch) + 1)) AS batch FROM per),
grid AS (SELECT d.batch, p.part, max(p.newest) AS newest, max(p.batch) AS seen
         FROM days d JOIN per p ON p.batch <= d.batch GROUP BY 1, 2),
least_of AS (SELECT batch, count(*) FILTER (WHERE batch - seen < 3) AS active,
                    min(newest) FILTER (WHERE batch - seen < 3) AS low, min(newest) AS low_held FROM grid GROUP BY batch),
ptrace AS (SELECT batch, active, date_trunc('milliseconds', max(low) OVER (ORDER BY batch)) - INTERVAL 5 SECOND AS watermark,
                  date_trunc('milliseconds', max(low_held) OVER (ORDER BY batch)) - INTERVAL 5 SECOND AS watermark_held FROM least_of),
told AS (SELECT a.*, time_bucket(INTERVAL '10 seconds', event_time) AS window_start,
                time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end,
                coalesce(time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' <= t.watermark, false) AS is_late,
                date_trunc('milliseconds', max(event_time) OVER (PARTITION BY part ORDER BY off)) - INTERVAL 5 SECOND AS own
         FROM arrivals a LEFT JOIN ptrace t ON t.batch = a.batch - 1)"""

SQL["watermark_by_partition"] = f"WITH {_ARRIVALS} SELECT batch, active, watermark, watermark_held FROM ptrace"

SQL["late_by_partition"] = (
    f"WITH {_ARRIVALS} SELECT part, count(*) AS records, count(*) FILTER (WHERE is_late) AS late_records, "
    "count(*) FILTER (WHERE event_time < own) AS behind_records FROM told GROUP BY part")

SQL["closed_by_partition_watermark"] = (
    f"WITH {_ARRIVALS}, ends AS (SELECT max(watermark) AS w, max(watermark_held) AS h FROM ptrace) "
    "SELECT window_start, window_end, pickup_city, count(*) AS ride_count, NOT coalesce(window_end <= any_value(h), false) AS held "
    "FROM told, ends WHERE NOT is_late AND window_end <= w GROUP BY 1, 2, 3")


def _rate_sql(seconds: int, step: int) -> str:
    span, grid = seconds * 1_000_000, step * 1_000_000
    return (f"WITH {DELIVERIES}, s AS (SELECT status AS topic, part, epoch_us(event_time) AS us, max(off) AS v "
            "FROM deliveries GROUP BY 1, 2, 3), "
            "i AS (SELECT *, lag(v) OVER (PARTITION BY topic, part ORDER BY us) AS p FROM s), "
            "u AS (SELECT topic, part, us, CASE WHEN p IS NULL THEN NULL WHEN v < p THEN v ELSE v - p END AS up FROM i), "
            f"e AS (SELECT DISTINCT topic, part, unnest(range(((us + {grid - 1}) // {grid}) * {grid}, us + {span}, {grid})) AS us FROM s), "
            "j AS (SELECT e.topic, e.part, e.us AS stp, u.us, u.up, row_number() OVER (PARTITION BY e.topic, e.part, e.us ORDER BY u.us) AS n "
            f"FROM e JOIN u ON e.topic = u.topic AND e.part = u.part AND u.us <= e.us AND u.us > e.us - {span}), "
            "r AS (SELECT topic, part, stp, sum(up) FILTER (WHERE n > 1) AS rise, max(us) - min(us) AS time FROM j GROUP BY 1, 2, 3) "
            "SELECT topic, make_timestamp(stp) AS ts, round(sum(rise / (time / 1e6)), 9) AS rate FROM r WHERE time > 0 GROUP BY 1, 2")


SQL["topic_rate_1m"] = _rate_sql(60, 15)
SQL["topic_rate_1h"] = _rate_sql(3600, 900)

SQL["held_fares"] = (
    f"WITH {RIDES}, k AS (SELECT (min(epoch_us(event_time)) + 59999999) // 60000000 AS a, "
    "(max(epoch_us(event_time)) + 59999999) // 60000000 AS b FROM rides), "
    "g AS (SELECT city, make_timestamp(n * 60000000) AS ts FROM (SELECT DISTINCT pickup_city AS city FROM rides), "
    "(SELECT unnest(range(a, b + 1)) AS n FROM k)), "
    "s AS (SELECT pickup_city AS city, event_time AS at, arg_max(fare, ride_id) AS fare FROM rides GROUP BY 1, 2) "
    "SELECT g.city, g.ts, CASE WHEN s.at > g.ts - INTERVAL 5 MINUTE THEN s.fare END AS fare "
    "FROM g ASOF LEFT JOIN s ON g.city = s.city AND g.ts >= s.at")

# a user is known until the watermark (newest of the periods before, less 4 days) reaches the
# accepted time plus 12 days
SQL["stream_dedup_outcomes"] = (
    f"WITH RECURSIVE {DELIVERIES}, d AS (SELECT ride_id, user_id, epoch_us(event_time) AS us, "
    "CAST(floor(floor(epoch(event_time) / 86400) / 10) AS BIGINT) + CASE WHEN ride_id % 11 = 0 THEN 1 ELSE 0 END + copy AS period FROM deliveries), "
    "w AS (SELECT period, max(max(us)) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest, "
    "row_number() OVER (ORDER BY period) AS b FROM d GROUP BY period), "
    "m AS (SELECT period, b, coalesce(newest // 1000 * 1000 - 4 * 86400000000, 0) AS mark FROM w), "
    "x AS (SELECT d.*, m.b, m.mark, us < mark AS late FROM d JOIN m USING (period)), "
    "c AS (SELECT user_id, b, min(us) AS cand FROM x WHERE NOT late GROUP BY 1, 2), "
    "r(user_id, b, since, took) AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), false FROM x UNION ALL "
    "SELECT r.user_id, m.b, CASE WHEN c.cand IS NOT NULL AND (since IS NULL OR mark >= since + 12 * 86400000000) THEN c.cand ELSE since END, "
    "c.cand IS NOT NULL AND (since IS NULL OR mark >= since + 12 * 86400000000) "
    "FROM r JOIN m ON m.b = r.b + 1 LEFT JOIN c ON c.user_id IS NOT DISTINCT FROM r.user_id AND c.b = m.b), "
    "o AS (SELECT x.ride_id, x.period, CASE WHEN late THEN 'late' WHEN took AND us = since AND row_number() OVER "
    "(PARTITION BY x.user_id, x.b, late ORDER BY us, CAST(ride_id AS VARCHAR)) = 1 THEN 'accepted' ELSE 'duplicate' END AS outcome "
    "FROM x JOIN r ON r.user_id IS NOT DISTINCT FROM x.user_id AND r.b = x.b) "
    "SELECT ride_id, period, outcome, count(*) AS copies FROM o GROUP BY 1, 2, 3")

SQL["quarantine_replay"] = (
    f"WITH {RIDES} SELECT 'accepted' AS side, CAST(ride_id AS VARCHAR) AS ride_id, fare, "
    "CASE WHEN ride_id % 17 <> 0 THEN status END AS status, CAST(NULL AS VARCHAR) AS violations FROM rides WHERE ride_id % 13 <> 0 "
    "UNION ALL SELECT 'refused', CAST(ride_id AS VARCHAR), NULL, NULL, 'type:fare' FROM rides WHERE ride_id % 13 = 0")

SQL["audit_ranges"] = (
    f"WITH {DELIVERIES}, b AS (SELECT *, off // 256 AS block, max(off // 256) OVER (PARTITION BY part) AS last FROM deliveries), "
    "s AS (SELECT unnest([0.25, 0.5, 1.0])::DOUBLE AS share) "
    "SELECT share, count(*) AS processed, count(DISTINCT ride_id) AS unique_rides, true AS within_error "
    "FROM b JOIN s ON block <= floor(last * share) GROUP BY share")

SQL["stream_state_keys"] = f"WITH {RIDES} SELECT DISTINCT ride_id, true AS counted FROM rides"
