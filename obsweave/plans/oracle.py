"""SQL for another engine that gives the result of each registered query.

The other engine reads the same Parquet tables, registered under their names.
"""

from __future__ import annotations

from .catalog import CITIES, METRICS


def _rnd(x: str, digits: int = 2) -> str:
    """Half away from zero; no negative zero."""
    return f"(ROUND({x}, {digits}) + 0.0)"


def _avg(x: str, over: str = "") -> str:
    """Mean from integer sums, so that the order of adding does not matter."""
    return (f"(CAST(SUM(CAST(SIGN({x}) * FLOOR(ABS({x}) * 1e9 + 0.5) AS BIGINT)){over} AS DOUBLE)"
            f" / 1e9 / COUNT({x}){over})")


def _mean(x: str, digits: int = 2) -> str:
    return _rnd(_avg(x), digits)


READINGS = """
    SELECT event_id AS reading_id,
           CASE WHEN event_id % 997 = 0 THEN '  ' ELSE event_type END AS city,
           ts AS collected_at, value - 40 AS temperature,
           CAST(user_id % 120 AS INTEGER) AS humidity,
           CAST(860 + event_id % 240 AS INTEGER) AS pressure,
           value / 3 AS wind_speed,
           CONCAT('shard-', CAST(user_id % 3 AS VARCHAR)) AS shard_id
    FROM events
"""


def _windows(source: str) -> str:
    return f"""
    SELECT city, date_trunc('hour', collected_at) AS window_start,
           date_trunc('hour', collected_at) + INTERVAL 1 HOUR AS window_end,
           COUNT(*) AS count,
           {_mean('temperature')} AS avg_temp, MIN(temperature) AS min_temp, MAX(temperature) AS max_temp,
           {_mean('humidity')} AS avg_humidity, {_mean('pressure')} AS avg_pressure,
           {_mean('wind_speed')} AS avg_wind_speed,
           ARG_MIN(shard_id, ROW(collected_at, shard_id)) AS shard_id
    FROM {source} GROUP BY city, date_trunc('hour', collected_at)
    """


# Weights of the comfort score; limits and message texts of the rules.
_SCORE = "100 - ABS(avg_temp - 18.0) * 2 - ABS(avg_humidity - 50.0) * 0.3::DOUBLE - avg_wind_speed * 1.5::DOUBLE"
_COMFORT = _rnd(f"LEAST(GREATEST({_SCORE}, 0.0), 100.0)", 1)
_ENRICHED = f"""
    SELECT *, {_rnd('(max_temp - min_temp)')} AS temp_range,
           date_diff('second', window_start, window_end) AS window_duration_sec,
           {_COMFORT} AS comfort_index
    FROM aggs
"""
_LATEST = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY city
        ORDER BY window_end DESC, window_start DESC, count DESC) AS rn FROM aggs) WHERE rn = 1
"""
_IN_CITIES = "city IN (" + ", ".join(f"'{c}'" for c in CITIES) + ")"

_LAG = "CAST(FLOOR(EPOCH(TIMESTAMP '2024-01-25 00:00:00')) - FLOOR(EPOCH(collected_at)) AS BIGINT)"
_RULES = {
    "city": ("TRIM(city) = ''", "'city name is empty'"),
    "temperature": ("(temperature < -80 OR temperature > 60)",
                    "PRINTF('temperature %.1f °C out of range [-80, 60]', temperature)"),
    "humidity": ("(humidity < 0 OR humidity > 100)",
                 "PRINTF('humidity %d out of range [0, 100]', humidity)"),
    "pressure": ("(pressure < 870 OR pressure > 1085)",
                 "PRINTF('pressure %d hPa out of range [870, 1085]', pressure)"),
    "wind_speed": ("(wind_speed < 0 OR wind_speed > 120)",
                   "PRINTF('wind_speed %.1f m/s out of range [0, 120]', wind_speed)"),
    "timestamp": (f"({_LAG} < 0 OR {_LAG} > 2000000)",
                  f"CASE WHEN {_LAG} < 0 THEN 'timestamp is in the future' ELSE "
                  f"PRINTF('timestamp is %d seconds old (max 2000000)', {_LAG}) END"),
}
_BROKEN = " OR ".join(cond for cond, _ in _RULES.values())
_GOOD = f"NOT ({_BROKEN})"
_ERROR_COUNT = " + ".join(f"CAST({cond} AS BIGINT)" for cond, _ in _RULES.values())

_KIND = "hour(window_start) % 4"
_REQUESTS = """
    SELECT CASE WHEN user_id % 2 = 0 THEN 'run-a' ELSE 'run-b' END AS name,
           strftime(ts, '%Y-%m-%d') AS round, value AS ms,
           event_type = 'error' AS failed, ts AS sent_at
    FROM events
"""


def _at(p: int) -> str:
    return f"MAX(CASE WHEN i = LEAST(n * {p} // 100, n - 1) THEN ms END)"


_BUSY = f"({_avg('ms')} * COUNT(ms) / 1000.0::DOUBLE)"
_WALL = "((epoch_us(MAX(sent_at)) - epoch_us(MIN(sent_at))) / 1e6::DOUBLE)"


def _summary(seconds: str) -> str:
    return f"""
    SELECT name, COUNT(*) AS total_requests, COUNT(*) FILTER (NOT failed) AS successful,
           COUNT(*) FILTER (failed) AS failed,
           {_rnd(seconds, 3)} AS total_time_sec,
           {_rnd(f'(COUNT(*) / {seconds})')} AS throughput_rps,
           {_mean('ms')} AS avg_latency_ms,
           {_rnd(_at(50))} AS p50_latency_ms, {_rnd(_at(95))} AS p95_latency_ms,
           {_rnd(_at(99))} AS p99_latency_ms,
           {_rnd('MIN(ms)')} AS min_latency_ms, {_rnd('MAX(ms)')} AS max_latency_ms
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY ms) - 1 AS i,
                 COUNT(*) OVER (PARTITION BY name) AS n FROM requests) GROUP BY name
"""


_SUMMARY = _summary(_BUSY)

_HIST = """
    ranges AS (SELECT city, CASE WHEN a = z THEN a - 0.5 ELSE a END AS low,
                      CASE WHEN a = z THEN z + 0.5 ELSE z END AS high
               FROM (SELECT city, MIN(avg_temp) AS a, MAX(avg_temp) AS z FROM aggs GROUP BY city)),
    edges AS (SELECT city, bin, low + bin * ((high - low) / 15.0) AS bin_start,
                     CASE WHEN bin = 14 THEN high ELSE low + (bin + 1) * ((high - low) / 15.0) END AS bin_end
              FROM ranges, (SELECT UNNEST(RANGE(15)) AS bin))
    SELECT e.city, e.bin, ANY_VALUE(bin_start) AS bin_start, ANY_VALUE(bin_end) AS bin_end,
           COUNT(avg_temp) AS n
    FROM edges e LEFT JOIN aggs a ON e.city = a.city AND avg_temp >= bin_start
         AND (avg_temp < bin_end OR bin = 14)
    GROUP BY e.city, e.bin
"""

# body, and the derived tables it needs
_BODIES: dict[str, tuple[str, str]] = {
    "tumbling_aggregate": ("a", "SELECT * FROM aggs"),
    "scan_aggregates": ("a", "SELECT * FROM aggs"),
    "stream_windows_drained": ("a", "SELECT * FROM aggs"),
    "city_timeline_sorted": ("a", "SELECT * FROM aggs"),
    "log_stream_replay": ("a", "SELECT * FROM aggs"),
    "mean_by_city_sql": ("a", f"SELECT city, {_mean('avg_temp')} AS mean_temp FROM aggs GROUP BY city"),
    "timeline_table": ("a", f"""SELECT city, window_end, avg_temp FROM aggs
        WHERE {_IN_CITIES} AND window_end >= TIMESTAMP '2024-01-28 00:00:00'"""),
    "percentile_sketches": ("a", """SELECT DISTINCT city, name, TRUE AS within FROM aggs,
        (SELECT UNNEST(['p05', 'p25', 'median', 'p75', 'p95']) AS name)"""),
    "arrow_roundtrip": ("a", "SELECT * REPLACE (CAST(count AS INTEGER) AS count) FROM aggs"),
    "stream_late_rows": ("r", f"""
        SELECT reading_id, CASE WHEN {_BROKEN} THEN 'rejected'
            WHEN reading_id % 2 = 1 AND date_trunc('hour', collected_at) + INTERVAL 1 HOUR <= (
                SELECT MAX(collected_at) FROM readings WHERE reading_id % 2 = 0 AND {_GOOD}) - INTERVAL 2 HOUR
            THEN 'late' ELSE 'on time' END AS kind
        FROM readings"""),
    "log_last_per_key": ("", "SELECT event_type AS key, MAX(event_id) AS event_id FROM events GROUP BY event_type"),
    "log_offsets": ("", "SELECT event_type AS key, COUNT(*) AS n, TRUE AS gapless FROM events GROUP BY event_type"),
    "enrich": ("a", _ENRICHED),
    "comfort_sql": ("a", f"SELECT city, window_start, {_COMFORT} AS comfort_index FROM aggs"),
    "city_summary": ("a", f"""
        SELECT city, {_mean('avg_temp')} AS overall_avg_temp, MIN(min_temp) AS overall_min_temp,
               MAX(max_temp) AS overall_max_temp, {_mean('avg_humidity', 1)} AS overall_avg_humidity,
               {_mean('avg_pressure', 1)} AS overall_avg_pressure,
               {_mean('avg_wind_speed')} AS overall_avg_wind,
               CAST(SUM(count) AS BIGINT) AS total_readings, COUNT(*) AS window_count,
               {_mean('comfort_index', 1)} AS avg_comfort
        FROM ({_ENRICHED}) GROUP BY city"""),
    "hourly_stats": ("a", f"""
        SELECT CAST(hour(window_start) AS BIGINT) AS hour_of_day, {_mean('avg_temp')} AS avg_temp,
               {_mean('avg_humidity', 1)} AS avg_humidity, {_mean('avg_wind_speed')} AS avg_wind,
               COUNT(*) AS samples
        FROM aggs GROUP BY hour(window_start)"""),
    "percentiles": ("a", "SELECT city, " + ", ".join(
        _rnd(f"PERCENTILE_CONT({p}) WITHIN GROUP (ORDER BY avg_temp)") + f" AS {n}"
        for n, p in {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}.items())
        + " FROM aggs GROUP BY city"),
    "anomalies": ("a+", f"""
        stats AS (SELECT city, {_avg('avg_temp')} AS m, STDDEV(avg_temp) AS s FROM aggs GROUP BY city)
        SELECT a.city, a.window_start, a.avg_temp,
               {_rnd('(ABS(a.avg_temp - m) / NULLIF(s, 0))')} AS z_score
        FROM aggs a JOIN stats ON a.city = stats.city WHERE ABS(a.avg_temp - m) / NULLIF(s, 0) > 2.0"""),
    "humidity_by_hour": ("a", f"""
        SELECT city, CAST(hour(window_end) AS BIGINT) AS hour, {_mean('avg_humidity', 1)} AS humidity
        FROM aggs GROUP BY city, hour(window_end)"""),
    "humidity_pivot": ("a", f"""
        SELECT city, {', '.join(f'MAX(CASE WHEN h = {h} THEN v END) AS h{h}' for h in range(24))}
        FROM (SELECT city, hour(window_end) AS h, {_mean('avg_humidity', 1)} AS v FROM aggs
              GROUP BY city, hour(window_end)) GROUP BY city"""),
    "comfort_by_city": ("a", f"SELECT city, {_mean('comfort_index', 1)} AS avg_comfort FROM ({_ENRICHED}) GROUP BY city"),
    "demo_summary": ("a", f"""SELECT city, {_mean('avg_temp')} AS mean_temp,
        CAST(SUM(count) AS BIGINT) AS total_readings FROM aggs GROUP BY city"""),
    "mean_by_city": ("a", f"SELECT city, {_mean('avg_temp')} AS mean_temp FROM aggs GROUP BY city"),
    "kpi_latest": ("a", f"""SELECT {_avg('avg_temp')} AS avg_temp, {_avg('avg_humidity')} AS avg_humidity,
        {_avg('avg_pressure')} AS avg_pressure, {_avg('avg_wind_speed')} AS avg_wind FROM ({_LATEST})"""),
    "distinct_cities": ("a", "SELECT DISTINCT city FROM aggs"),
    "table_counts": ("a", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT city) AS cities FROM aggs"),
    "histogram": ("a+", _HIST),
    "rolling_mean": ("a", "SELECT *, " + _rnd(_avg(
        "avg_temp", " OVER (PARTITION BY city ORDER BY window_end, window_start"
        " ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")) + " AS rolling_avg_temp_5w FROM aggs"),
    "latest_per_key": ("a", _LATEST),
    "current_temps": ("a", _LATEST),
    "scatter_points": ("a", f"""SELECT city, avg_humidity, avg_wind_speed, avg_temp,
        GREATEST(avg_temp + 50.0, 1.0) AS size FROM ({_LATEST})"""),
    "comfort_gauges": ("a", f"""
        SELECT city, comfort, CASE WHEN comfort >= 70 THEN 'green' WHEN comfort >= 40 THEN 'orange'
               ELSE 'red' END AS band
        FROM (SELECT city, {_COMFORT} AS comfort FROM ({_LATEST}) WHERE {_IN_CITIES})
        ORDER BY comfort DESC, city LIMIT 4"""),
    "latest_records": ("a", f"""
        SELECT city, window_end, {_rnd('avg_temp', 1)} AS avg_temp, {_rnd('min_temp', 1)} AS min_temp,
               {_rnd('max_temp', 1)} AS max_temp, CAST({_rnd('avg_humidity', 0)} AS BIGINT) AS avg_humidity,
               CAST({_rnd('avg_pressure', 0)} AS BIGINT) AS avg_pressure,
               {_rnd('avg_wind_speed', 1)} AS avg_wind_speed, count
        FROM (SELECT * FROM aggs ORDER BY window_end DESC, city DESC, window_start DESC LIMIT 20)"""),
    "timeline": ("a", f"""SELECT city, window_end, avg_temp FROM aggs
        WHERE {_IN_CITIES} AND window_end >= TIMESTAMP '2024-01-28 00:00:00'"""),
    "by_city": ("a", "SELECT * FROM aggs WHERE city = 'click'"),
    "union_diagonal": ("a", f"""SELECT *, CAST(NULL AS DOUBLE) AS temp_range,
        CAST(NULL AS BIGINT) AS window_duration_sec, CAST(NULL AS DOUBLE) AS comfort_index FROM aggs
        UNION ALL {_ENRICHED}"""),
    "top_cities": ("c", f"""
        SELECT city, {_mean('avg_temp')} AS mean_temp, {_rnd('MIN(min_temp)')} AS abs_min_temp,
               {_rnd('MAX(max_temp)')} AS abs_max_temp, CAST(SUM(count) AS BIGINT) AS total_readings,
               COUNT(*) AS window_count
        FROM aggs GROUP BY city ORDER BY mean_temp DESC, city LIMIT 5"""),
    "report_top10": ("a", f"""
        SELECT city, {_mean('avg_temp')} AS mean_temp, {_rnd('MIN(min_temp)')} AS abs_min_temp,
               {_rnd('MAX(max_temp)')} AS abs_max_temp, CAST(SUM(count) AS BIGINT) AS total_readings,
               COUNT(*) AS window_count
        FROM aggs GROUP BY city ORDER BY mean_temp DESC, city LIMIT 10"""),
    "sql_template": ("a", """SELECT city, COUNT(*) AS windows, MAX(max_temp) AS hottest
        FROM aggs WHERE count >= 2 GROUP BY city"""),
    "clean_rows": ("r", f"SELECT * FROM readings WHERE {_GOOD}"),
    "validate_rows": ("r", f"""SELECT reading_id, {_GOOD} AS is_valid, CONCAT_WS('; ', """ + ", ".join(
        f"CASE WHEN {cond} THEN '{field}: ' || {text} END" for field, (cond, text) in _RULES.items())
        + ") AS errors FROM readings"),
    "quarantine_rows": ("r", f"SELECT *, {_ERROR_COUNT} AS errors FROM readings WHERE {_BROKEN}"),
    "validation_errors": ("r", " UNION ALL ".join(
        f"SELECT reading_id, '{field}' AS field, {text} AS message FROM readings WHERE {cond}"
        for field, (cond, text) in _RULES.items())),
    "errors_by_field": ("r", " UNION ALL ".join(
        f"SELECT '{field}' AS field, COUNT(*) AS errors FROM readings WHERE {cond} HAVING COUNT(*) > 0"
        for field, (cond, _) in _RULES.items())),
    "validation_report": ("r", f"""
        SELECT COUNT(*) AS total, COUNT(*) FILTER ({_GOOD}) AS valid, COUNT(*) FILTER ({_BROKEN}) AS invalid,
               COALESCE(COUNT(*) FILTER ({_GOOD})::DOUBLE / NULLIF(COUNT(*), 0) * 100, 0.0) AS valid_pct
        FROM readings"""),
    "reduced_mask": ("r", """
        SELECT * FROM readings WHERE temperature BETWEEN -80 AND 60 AND humidity BETWEEN 0 AND 100
           AND pressure BETWEEN 870 AND 1085 AND wind_speed BETWEEN 0 AND 120 AND LENGTH(city) > 0"""),
    "to_celsius": ("r", """SELECT reading_id, city, temperature - 273.15::DOUBLE AS temperature,
        wind_speed - 273.15::DOUBLE AS wind_speed FROM readings"""),
    "decode_json": ("a", f"""
        SELECT * REPLACE (CASE WHEN {_KIND} = 2 THEN '' ELSE shard_id END AS shard_id)
        FROM aggs WHERE NOT ({_KIND} = 3 AND count <= 2)"""),
    "dead_letters": ("a", f"""
        SELECT CASE count WHEN 1 THEN 'not a JSON object' ELSE 'bad count' END AS reason, COUNT(*) AS n
        FROM aggs WHERE {_KIND} = 3 AND count <= 2 GROUP BY 1"""),
    "encode_json": ("a", "SELECT city, window_start, {json} AS value FROM aggs"),
    "kv_projection": ("a", "SELECT city AS key, {json} AS value FROM aggs"),
    "flatten_payload": ("", """
        SELECT event_id, event_type AS city, 'XX' AS country,
               CASE WHEN event_type = 'signup' THEN 0.0 ELSE 55.5 END::DOUBLE AS lat,
               CASE WHEN event_type = 'signup' THEN 0.0 ELSE 37.5 END::DOUBLE AS lon,
               value AS temperature, value - 1 AS feels_like, value - 2 AS temp_min, value + 2 AS temp_max,
               CAST(1013 AS INTEGER) AS pressure, CAST(user_id % 100 AS INTEGER) AS humidity,
               value / 3 AS wind_speed, CAST(user_id % 360 AS INTEGER) AS wind_deg,
               CAST(user_id % 101 AS INTEGER) AS clouds_all,
               CASE WHEN event_type = 'error' THEN '' ELSE props END AS description,
               ts AS collected_at, CONCAT('shard-', CAST(user_id % 3 AS VARCHAR)) AS shard_id
        FROM events WHERE event_id % 40 NOT IN (1, 2, 3)"""),
    "payload_dead_letters": ("", """
        SELECT event_id, 'payload cannot be read' AS reason FROM events WHERE event_id % 40 IN (1, 2, 3)"""),
    "epoch_roundtrip": ("a", """SELECT city, CAST(epoch(window_start) AS BIGINT) AS start_s, window_start,
        window_end, CAST(count AS INTEGER) AS count FROM aggs"""),
    "upsert_latest": ("a", f"""
        SELECT * REPLACE (CASE WHEN {_IN_CITIES} THEN window_end + INTERVAL 10 MINUTE ELSE window_end END
                          AS window_end,
                          CASE WHEN {_IN_CITIES} THEN count + 100 ELSE count END AS count) FROM aggs"""),
    "dedup_latest": ("", """
        SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                     l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
        FROM lineitem) WHERE rn = 1"""),
    "retain_last_by_time": ("", """SELECT * FROM lineitem
        ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC LIMIT 12000"""),
    "retain_last_n": ("", "SELECT * FROM events ORDER BY event_id DESC LIMIT 1000"),
    "sample_n": ("", """SELECT event_id, event_type, value FROM events
        ORDER BY md5(CONCAT(CAST(event_id AS VARCHAR), '-42')), event_id LIMIT 500"""),
    "assign_round_robin": ("", """
        SELECT event_id, event_type, r_name AS shard
        FROM events JOIN (SELECT r_name, ROW_NUMBER() OVER (ORDER BY r_name) - 1 AS rank,
                                 COUNT(*) OVER () AS n FROM region) ON event_id % n = rank"""),
    "dim_lookup": ("", """
        SELECT event_id, asked, n.n_nationkey IS NOT NULL AS found,
               COALESCE(n.n_nationkey, 0) AS n_nationkey, COALESCE(n.n_name, '') AS n_name
        FROM (SELECT event_id, CONCAT(' Nation_', CAST(user_id % 30 AS VARCHAR), ' ') AS asked FROM events) e
        LEFT JOIN nation n ON LOWER(TRIM(asked)) = LOWER(TRIM(n.n_name))"""),
    "request_stats": ("q", f"""
        SELECT round, COUNT(*) AS total, COUNT(*) FILTER (NOT failed) AS success,
               COUNT(*) FILTER (failed) AS errors,
               COALESCE({_mean('(CASE WHEN NOT failed THEN ms END)')}, 0.0) AS avg_response_ms
        FROM requests GROUP BY round"""),
    "latency_summary": ("q", _SUMMARY),
    "latency_wall_clock": ("q", _summary(_WALL)),
    "stream_quarantine": ("r", f"SELECT reading_id, {_ERROR_COUNT} AS errors FROM readings"),
    "stream_history": ("", "SELECT * FROM events ORDER BY event_id DESC LIMIT 300"),
    "throughput_ratio": ("q", f"""
        SELECT ARG_MAX(name, ROW(throughput_rps, name)) AS winner,
               {_rnd('(MAX(throughput_rps) / MIN(throughput_rps))', 1)} AS ratio
        FROM ({_SUMMARY}) HAVING COUNT(*) >= 2 AND MIN(throughput_rps) > 0"""),
    "success_rate": ("q", f"""
        SELECT name, successful + failed AS total,
               {_rnd('(successful * 100.0::DOUBLE / (successful + failed))', 1)} AS success_pct,
               {_rnd('(failed * 100.0::DOUBLE / (successful + failed))', 1)} AS failure_pct
        FROM ({_SUMMARY}) WHERE successful + failed > 0"""),
    "metric_matrix": ("q", " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, MAX(CASE WHEN name = 'run-a' THEN {m}::DOUBLE END) AS run_a,
            MAX(CASE WHEN name = 'run-b' THEN {m}::DOUBLE END) AS run_b FROM summary""" for m in METRICS)),
    "stream_latest": ("", """
        SELECT city, window_end, event_id, value FROM (
            SELECT event_type AS city, ts AS window_end, event_id, value,
                   ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
            FROM events) WHERE rn = 1"""),
}

_PARTS = {"top10": ("''", "mean_temp", "report_top10"),
          "timeline": ("strftime(window_end, '%Y-%m-%d %H:%M')", "avg_temp", "tumbling_aggregate"),
          "histogram": ("CAST(bin AS VARCHAR)", "CAST(n AS DOUBLE)", None),
          "humidity_by_hour": ("CAST(hour AS VARCHAR)", "humidity", "humidity_by_hour"),
          "comfort": ("''", "avg_comfort", "comfort_by_city"), "mean_by_city": ("''", "mean_temp", "mean_by_city")}
_BODIES["report_tables"] = ("a", " UNION ALL ".join(
    f"SELECT '{part}' AS part, city, {place} AS place, {value} AS value FROM "
    f"({_BODIES[source][1] if source else 'WITH ' + _HIST})" for part, (place, value, source) in _PARTS.items()))

_JSON = ("to_json({city: city, window_start: strftime(window_start, '%Y-%m-%dT%H:%M:%S'), "
         "window_end: strftime(window_end, '%Y-%m-%dT%H:%M:%S'), count: count, avg_temp: avg_temp, "
         "min_temp: min_temp, max_temp: max_temp, avg_humidity: avg_humidity, avg_pressure: avg_pressure, "
         "avg_wind_speed: avg_wind_speed, shard_id: shard_id})")

_AGGS = f"readings AS ({READINGS}), aggs AS ({_windows('readings')})"
_SOURCES = {
    "": "",
    "r": f"WITH readings AS ({READINGS}) ",
    "a": f"WITH {_AGGS} ",
    "a+": f"WITH {_AGGS}, ",
    "c": f"WITH readings AS ({READINGS}), good AS (SELECT * FROM readings WHERE {_GOOD}), "
         f"aggs AS ({_windows('good')}) ",
    "q": f"WITH requests AS ({_REQUESTS}), summary AS ({_SUMMARY}) ",
}


def oracle_sql() -> dict[str, str]:
    return {name: _SOURCES[needs] + body.replace("{json}", f"CAST({_JSON} AS VARCHAR)")
            for name, (needs, body) in _BODIES.items()}
