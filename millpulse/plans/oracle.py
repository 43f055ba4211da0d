"""The registered queries in plain SQL (DuckDB dialect) over the same tables."""

from __future__ import annotations

_READINGS = """
WITH e AS (
  SELECT event_id,
         ts AS event_time,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
         'machine_' || CAST(user_id % 10 + 1 AS VARCHAR) AS machine_id,
         (event_id % 120) / 10.0::DOUBLE AS vibration_mms,
         value AS temperature_c,
         CAST(json_extract_string(props, '$.k') AS INTEGER) / 33.0::DOUBLE AS pressure_bar,
         (event_id % 120) / 10.0::DOUBLE * 0.5::DOUBLE AS rms_vibration,
         value AS mean_temp,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fault_label
  FROM events
), r AS (
  SELECT *,
         CAST(event_time AS DATE) AS "date",
         CAST(hour(event_time) AS INTEGER) AS "hour",
         temperature_c * 9 / 5 + 32 AS temp_fahrenheit,
         pressure_bar * 14.5038::DOUBLE AS pressure_psi,
         fault_label > 0 AS is_fault,
         CASE WHEN temperature_c > 80 THEN 'HIGH' WHEN temperature_c < 20 THEN 'LOW'
              ELSE 'NORMAL' END AS temp_status,
         time_bucket(INTERVAL 15 minutes, event_time) AS time_window
  FROM e
), m AS (
  SELECT time_window AS window_start,
         time_window + INTERVAL 15 minutes AS window_end,
         machine_id,
         round(avg(temperature_c), 6) AS avg_temperature,
         round(max(temperature_c), 6) AS max_temperature,
         round(min(temperature_c), 6) AS min_temperature,
         round(avg(vibration_mms), 6) AS avg_vibration,
         round(max(vibration_mms), 6) AS max_vibration,
         round(avg(pressure_bar), 6) AS avg_pressure,
         count_if(is_fault)::BIGINT AS fault_count,
         count(*) AS total_readings,
         round(count_if(is_fault) * 100.0::DOUBLE / count(*), 6) AS fault_percentage
  FROM r GROUP BY ALL
)
"""

_FIELDS = """"timestamp", machine_id, vibration_mms, temperature_c, pressure_bar,
 rms_vibration, mean_temp, fault_label"""

_DERIVED = """event_time, "date", "hour", temp_fahrenheit, pressure_psi, is_fault,
 temp_status, time_window"""

_METRICS = _READINGS + "SELECT * FROM m"

_HIGH_FAULT = _READINGS + """
SELECT machine_id, window_start, window_end, avg_temperature, max_vibration,
       fault_percentage, total_readings
FROM m WHERE fault_percentage > 10
ORDER BY window_start DESC, fault_percentage DESC, machine_id
"""

_RECENT = """
SELECT event_time, machine_id, temperature_c, vibration_mms, pressure_bar, temp_status, is_fault
FROM r
WHERE temp_status = 'HIGH' OR vibration_mms > 8.0 OR pressure_bar > 2.5 {more}
ORDER BY event_time DESC, machine_id LIMIT 50
"""

_REASON = """
SELECT event_id,
       CASE event_id % 50 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_machine_id'
            WHEN 2 THEN 'bad_event_time' WHEN 3 THEN 'empty' ELSE 'valid' END AS reason
FROM events
"""


def _profile(column: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count({column}) AS non_null,
       round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std,
       round(min({column}), 6) AS min,
       round(quantile_cont({column}, 0.25), 6) AS p25,
       round(quantile_cont({column}, 0.5), 6) AS p50,
       round(quantile_cont({column}, 0.75), 6) AS p75,
       round(max({column}), 6) AS max
FROM r"""


def _info() -> str:
    kinds = {
        "timestamp": "string", "machine_id": "string", "vibration_mms": "double",
        "temperature_c": "double", "pressure_bar": "double", "rms_vibration": "double",
        "mean_temp": "double", "fault_label": "int",
    }
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f'count("{name}") AS non_null FROM r'
        for i, (name, kind) in enumerate(kinds.items())
    )


def _xxhash64() -> str:
    """xxHash64 of ``event_id`` with seed 42, step by step in 128-bit integers."""
    # The five primes of the published algorithm, and 2^64.
    p1, p2, p3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
    p4, p5, word = 9650029242287828579, 2870177450012600261, 18446744073709551616

    def times(a: str, b: int) -> str:
        return f"(({a}) * {b}::UHUGEINT % {word}::UHUGEINT)"

    def rotate(a: str, bits: int) -> str:
        high = f"(({a}) * {2**bits}::UHUGEINT % {word}::UHUGEINT)"
        return f"({high} + ({a}) // {2 ** (64 - bits)}::UHUGEINT)"

    def shift(a: str, bits: int) -> str:
        return f"(({a}) // {2**bits}::UHUGEINT)"

    mixed = times(rotate("k", 31), p1)
    steps = [
        f"SELECT event_id, {times('event_id::UHUGEINT', p2)} AS k FROM events",
        f"SELECT event_id, xor({(42 + p5 + 8) % word}::UHUGEINT, {mixed}) AS h FROM s0",
        f"SELECT event_id, ({times(rotate('h', 27), p1)} + {p4}::UHUGEINT) % {word}::UHUGEINT AS h"
        " FROM s1",
        f"SELECT event_id, {times(f'xor(h, {shift("h", 33)})', p2)} AS h FROM s2",
        f"SELECT event_id, {times(f'xor(h, {shift("h", 29)})', p3)} AS h FROM s3",
        f"SELECT event_id, xor(h, {shift('h', 32)}) AS h FROM s4",
        f"SELECT event_id, CASE WHEN h >= {word // 2}::UHUGEINT THEN h::HUGEINT - {word}::HUGEINT"
        " ELSE h::HUGEINT END AS h FROM s5",
    ]
    named = ", ".join(f"s{i} AS ({step})" for i, step in enumerate(steps))
    return (
        f"WITH {named} SELECT event_id, "
        "'machine_' || CAST((h % 10 + 10) % 10 + 1 AS VARCHAR) AS machine_id FROM s6"
    )


ORACLE: dict[str, str] = {
    "encode_messages": _READINGS + """
SELECT event_id,
       '{"timestamp":"' || rtrim_iso || '","machine_id":"' || machine_id
       || '","vibration_mms":' || CAST(vibration_mms AS VARCHAR)
       || ',"temperature_c":' || CAST(temperature_c AS VARCHAR)
       || ',"pressure_bar":' || CAST(pressure_bar AS VARCHAR)
       || ',"rms_vibration":' || CAST(rms_vibration AS VARCHAR)
       || ',"mean_temp":' || CAST(mean_temp AS VARCHAR)
       || ',"fault_label":' || CAST(fault_label AS VARCHAR) || '}' AS value
FROM (SELECT *, CASE WHEN "timestamp" LIKE '%.000000' THEN left("timestamp", 19)
                     ELSE "timestamp" END AS rtrim_iso FROM r)
""",
    "parse_messages": _READINGS + f"SELECT event_id, event_time, {_FIELDS} FROM r",
    "quarantine_counts": f"SELECT reason, count(*) AS messages FROM ({_REASON}) GROUP BY reason",
    "quarantined_messages": f"SELECT * FROM ({_REASON}) WHERE reason <> 'valid'",
    "csv_readings": _READINGS + """
SELECT event_time AS row_time, vibration_mms, temperature_c, pressure_bar, rms_vibration,
       mean_temp, fault_label
FROM r WHERE event_id % 97 <> 0
""",
    "csv_rejects": """
SELECT 'temperature_c' AS reject_reason, count(*) AS rejected FROM events WHERE event_id % 97 = 0
""",
    "csv_messages": _READINGS + """
SELECT event_id,
       CASE WHEN "timestamp" LIKE '%.000000' THEN left("timestamp", 19) ELSE "timestamp" END
         AS "timestamp",
       'machine_' || CAST(event_id % 5 + 1 AS VARCHAR) AS machine_id,
       vibration_mms, temperature_c, pressure_bar, rms_vibration, mean_temp, fault_label
FROM r WHERE event_id % 97 <> 0
""",
    "assign_machines": _xxhash64(),
    "fault_flags": """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'FAULT' ELSE 'OK' END AS fault_flag FROM events
""",
    "epoch_precisions": """
SELECT event_id, date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms,
       ts AS from_us, ts AS from_ns
FROM events
""",
    "enrich_readings": _READINGS + f"SELECT event_id, {_FIELDS}, {_DERIVED} FROM r",
    "temperature_trend": _READINGS + """
SELECT machine_id, event_time, temperature_c FROM r
WHERE event_time IS NOT NULL AND temperature_c IS NOT NULL ORDER BY event_time, machine_id
""",
    "fault_by_machine": _READINGS + """
SELECT machine_id, count(*) AS total_readings, count_if(is_fault)::BIGINT AS fault_count,
       round(count_if(is_fault) * 100.0::DOUBLE / count(*), 2) AS fault_percentage
FROM r GROUP BY machine_id ORDER BY fault_percentage DESC, machine_id
""",
    "hourly_patterns": _READINGS + """
SELECT "hour", round(avg(temperature_c), 6) AS avg_temperature,
       round(avg(vibration_mms), 6) AS avg_vibration, round(avg(pressure_bar), 6) AS avg_pressure,
       count(*) AS reading_count, count_if(is_fault)::BIGINT AS fault_count
FROM r GROUP BY "hour" ORDER BY "hour"
""",
    "recent_high_risk": _READINGS + _RECENT.format(more=""),
    "stored_recent_high_risk": _READINGS + _RECENT.format(more=""),
    "recent_risk_or_fault": _READINGS + _RECENT.format(more="OR is_fault"),
    "daily_temperature_stats": _READINGS + """
SELECT "date", machine_id, round(avg(temperature_c), 6) AS avg_temperature,
       round(max(temperature_c), 6) AS max_temperature,
       round(min(temperature_c), 6) AS min_temperature, count(temperature_c) AS reading_count
FROM r WHERE event_time >= (SELECT max(event_time) FROM r) - INTERVAL 7 days
GROUP BY "date", machine_id
""",
    "daily_temperature_stats_as_of": _READINGS + """
, t AS (SELECT min(event_time)::DATE + (max(event_time)::DATE - min(event_time)::DATE) // 2 * INTERVAL 1 day
               + INTERVAL 12 hours AS until FROM r)
SELECT "date", machine_id, round(avg(temperature_c), 6) AS avg_temperature,
       round(max(temperature_c), 6) AS max_temperature,
       round(min(temperature_c), 6) AS min_temperature, count(temperature_c) AS reading_count
FROM r, t WHERE event_time >= until - INTERVAL 7 days AND event_time <= until
GROUP BY "date", machine_id
""",
    "sample_readings": _READINGS + """
SELECT event_id, event_time, machine_id, temperature_c, vibration_mms, pressure_bar
FROM r ORDER BY event_time, event_id LIMIT 20
""",
    "profile_readings": _READINGS
    + " UNION ALL ".join(map(_profile, ("temperature_c", "vibration_mms", "pressure_bar"))),
    "column_info": _READINGS + _info(),
    "window_metrics": _METRICS,
    "high_fault_windows": _HIGH_FAULT,
    "merged_partials": _METRICS,
    "aggregates_v1_to_metrics": _METRICS,
    "ingested_readings": _READINGS + """
SELECT machine_id, vibration_mms, temperature_c, pressure_bar, rms_vibration, mean_temp,
       fault_label, event_time, "date", "hour", temp_fahrenheit, pressure_psi, is_fault,
       temp_status, time_window
FROM r
""",
    "two_streams_readings": _READINGS + """
SELECT machine_id, vibration_mms, temperature_c, pressure_bar, rms_vibration, mean_temp,
       fault_label, event_time, "date", "hour", temp_fahrenheit, pressure_psi, is_fault,
       temp_status, time_window
FROM r
""",
    "merged_window_metrics": _METRICS,
    "compacted_window_metrics": _METRICS,
    "ingested_quarantine": f"SELECT reason, count(*) AS messages FROM ({_REASON}) GROUP BY reason",
    "ingested_audit": f"""
SELECT count(*) AS offered, count(*) FILTER (reason = 'valid') AS readings,
       count(*) FILTER (reason <> 'valid') AS quarantined, count(*) FILTER (reason = 'valid') AS readings_held,
       count(*) FILTER (reason <> 'valid') AS quarantine_held, 0::BIGINT AS unaccounted
FROM ({_REASON})
""",
    "stream_window_metrics": _METRICS
    + " WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 minutes FROM r)",
    "windowed_table_metrics": _METRICS,
    "catalog_readings_in_range": _READINGS + """
SELECT event_time, "date", machine_id, temperature_c, vibration_mms, pressure_bar, time_window
FROM r, (SELECT min(event_time)::DATE AS a, max(event_time)::DATE AS b FROM r) d
WHERE event_time >= a + (b - a) // 3 * INTERVAL 1 day + INTERVAL 6 hours
  AND event_time < a + (b - a) // 3 * INTERVAL 1 day + INTERVAL 66 hours
""",
    "catalog_high_fault_windows": _HIGH_FAULT,
    "snapshot_diff": """
WITH t AS (SELECT (max(event_id) + 1) // 10 AS t FROM events),
a AS (SELECT event_id, value AS v FROM events WHERE event_id < (SELECT t FROM t) * 9),
b AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN value + 1 ELSE value END AS v
      FROM events WHERE event_id >= (SELECT t FROM t))
SELECT coalesce(a.event_id, b.event_id) AS event_id,
       CASE WHEN a.event_id IS NULL THEN 'added' WHEN b.event_id IS NULL THEN 'removed'
            ELSE 'changed' END AS change_type,
       a.v AS old_temperature_c, b.v AS new_temperature_c, 1::BIGINT AS copies
FROM a FULL OUTER JOIN b ON a.event_id = b.event_id
WHERE a.event_id IS NULL OR b.event_id IS NULL OR a.v IS DISTINCT FROM b.v
""",
    "evolve_v1_to_v2": _READINGS + f"SELECT event_id, {_FIELDS}, {_DERIVED} FROM r",
}
