"""DuckDB SQL that states each query independently of the Spark code.

Each statement is put together from named common table expressions.  Joins on windows are
written in their range form.
"""

from __future__ import annotations

_NUMBERED = """
numbered as (
  select *, cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k from events)"""

_FIRST_ARRIVALS = """
first_arrivals as (
  select event_id as src_id, event_id % 3 as batch_no,
    case when user_id % 50 = 7 then null
         when user_id % 50 = 8 then ''
         else concat('sensor-', lpad(cast(user_id % 20 as varchar), 2, '0')) end as sensor_id,
    case when k = 11 then ''
         else concat('factory-', substr('abcd', cast(k % 4 as integer) + 1, 1)) end as site,
    case when event_type = 'error' and k % 10 = 0 then null
         else cast(floor(value * 2) as double) / 4 end as temperature,
    case when event_type = 'signup' and k % 10 = 1 then null
         else cast(k as double) + cast(3.5 as double) end as humidity,
    case when event_type = 'view' and k = 13 then null
         else make_timestamp(1704067200000000
              + ((epoch_us(ts) - 1704067200000000) // 60000) * 1000) end as event_time
  from numbered)"""

_ARRIVALS = """
arrivals as (
  select * from first_arrivals
  union all
  select src_id, (src_id // 20) % 3, sensor_id, site, temperature, humidity, event_time
  from first_arrivals where src_id % 10 = 0)"""

_CLASSIFIED = """
classified as (
  select *,
    case when sensor_id is null or length(sensor_id) = 0 then 'missing_sensor_id'
         when site is null or length(site) = 0 then 'missing_site'
         when not (temperature between -50.0 and 80.0) then 'temperature_out_of_range'
         when not (humidity between 0.0 and 100.0) then 'humidity_out_of_range'
         when event_time is null then 'missing_event_time' end as validation_error
  from arrivals)"""

_VALID = """
valid as (
  select src_id, batch_no, sensor_id, site, temperature, humidity, event_time,
    sha256(concat_ws('||', sensor_id, site, printf('%.2f', temperature),
      printf('%.2f', humidity), strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ'))) as event_id,
    time_bucket(interval 1 minute, event_time) as window_start,
    time_bucket(interval 1 minute, event_time) + interval 1 minute as window_end
  from classified where validation_error is null)"""

_SILVER = """
silver as (
  select event_id, sensor_id, site, temperature, humidity, event_time, window_start, window_end
  from (select *, row_number() over (partition by event_id order by event_time,
          temperature nulls first, humidity nulls first, sensor_id, site) as copy from valid)
  where copy = 1)"""


def _rounded_average(column: str) -> str:
    return f"cast(round(cast(cast(avg({column}) as varchar) as decimal(28,15)), 2) as double)"


def _count_if(condition: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint)"


_SENSOR_MINUTE = f"""
sensor_minute as (
  select sensor_id, site, window_start, window_end, count(*) as event_count,
    {_rounded_average('temperature')} as avg_temperature,
    {_rounded_average('humidity')} as avg_humidity,
    max(event_time) as last_event_time
  from silver group by all)"""

_SITE_MINUTE = f"""
site_minute as (
  select site, window_start, window_end, count(*) as event_count,
    count(distinct sensor_id) as active_sensors,
    {_rounded_average('temperature')} as avg_temperature,
    {_rounded_average('humidity')} as avg_humidity,
    {_count_if('temperature >= 35.0')} as high_temp_events,
    {_count_if('temperature >= 45.0')} as critical_temp_events,
    {_count_if('humidity >= 85.0')} as high_humidity_events
  from silver group by site, window_start, window_end)"""

_SITE_ALERT = """
site_alert_minute as (
  select site, window_start, window_end, high_temp_events, critical_temp_events,
    high_humidity_events,
    case when critical_temp_events > 0 then 'critical'
         when high_temp_events > 0 or high_humidity_events > 0 then 'warning'
         else 'normal' end as alert_level
  from site_minute)"""

_LATEST = """
sensor_latest_status as (
  select sensor_id, site, event_time, temperature, humidity,
    case when temperature >= 45.0 then 'critical'
         when temperature >= 35.0 or humidity >= 85.0 then 'warning'
         else 'normal' end as status
  from (select *, row_number() over (partition by sensor_id
          order by event_time desc, event_id) as place from silver)
  where place = 1)"""

# When a row was last written: the last batch with a valid event of its key.
_STAMPS = """
event_stamps as (
  select event_id, min(batch_no) as batch_no from valid group by event_id),
sensor_window_stamps as (
  select sensor_id, site, window_start, max(batch_no) as batch_no from valid group by all),
site_window_stamps as (
  select site, window_start, max(batch_no) as batch_no from valid group by all),
sensor_stamps as (
  select sensor_id, max(batch_no) as batch_no from valid group by all)"""

_STAMP = "timestamp '2024-06-01 00:00:00' + to_seconds(batch_no) as processed_at"

_BASE = [_NUMBERED, _FIRST_ARRIVALS, _ARRIVALS, _CLASSIFIED, _VALID, _SILVER]
_GOLD = [_SENSOR_MINUTE, _SITE_MINUTE, _SITE_ALERT, _LATEST]


def _with(ctes: list[str], select: str) -> str:
    return f"with {','.join(ctes)}\n{select.strip()}"


def _base(select: str) -> str:
    return _with(_BASE, select)


def _gold(select: str) -> str:
    return _with(_BASE + _GOLD, select)


def _stamped(select: str) -> str:
    return _with(_BASE + _GOLD + [_STAMPS], select)


_SILVER_STAMPED = f"""
  select event_id, sensor_id, site, temperature, humidity, event_time, {_STAMP}
  from silver join event_stamps using (event_id)"""
_SENSOR_MINUTE_STAMPED = f"""
  select sensor_minute.*, {_STAMP}
  from sensor_minute join sensor_window_stamps using (sensor_id, site, window_start)"""
_SITE_MINUTE_STAMPED = f"""
  select site_minute.*, {_STAMP}
  from site_minute join site_window_stamps using (site, window_start)"""
_SITE_ALERT_STAMPED = f"""
  select site_alert_minute.*, {_STAMP}
  from site_alert_minute join site_window_stamps using (site, window_start)"""
_LATEST_STAMPED = f"""
  select sensor_latest_status.*, {_STAMP}
  from sensor_latest_status join sensor_stamps using (sensor_id)"""

_GOLD_COLUMNS = {
    "sensor_id": "varchar", "site": "varchar", "window_start": "timestamp", "window_end": "timestamp",
    "event_count": "bigint", "avg_temperature": "double", "avg_humidity": "double",
    "last_event_time": "timestamp", "active_sensors": "bigint", "high_temp_events": "bigint",
    "critical_temp_events": "bigint", "high_humidity_events": "bigint", "alert_level": "varchar",
    "event_time": "timestamp", "temperature": "double", "humidity": "double", "status": "varchar",
}
_EVENT = ["sensor_id", "site", "event_time", "temperature", "humidity"]
_HAS = {
    "sensor_minute": "sensor_id site window_start window_end event_count avg_temperature avg_humidity "
    "last_event_time",
    "site_minute": "site window_start window_end event_count active_sensors avg_temperature avg_humidity "
    "high_temp_events critical_temp_events high_humidity_events",
    "site_alert_minute": "site window_start window_end high_temp_events critical_temp_events "
    "high_humidity_events alert_level",
    "sensor_latest_status": "sensor_id site event_time temperature humidity status",
}


def _shape(name: str, has: str, also: str) -> str:
    columns = [c if c in has.split() else f"cast(null as {t}) as {c}" for c, t in _GOLD_COLUMNS.items()]
    return f"select '{name}' as table_name, {', '.join(columns)}{also}"


def _gold_rows(sources: dict[str, str], also: str = "") -> str:
    return " union all ".join(f"{_shape(t, _HAS[t], also)} from ({s})" for t, s in sources.items())


_STAMPED_ROWS = _gold_rows(
    {
        "sensor_minute": _SENSOR_MINUTE_STAMPED,
        "site_minute": _SITE_MINUTE_STAMPED,
        "site_alert_minute": _SITE_ALERT_STAMPED,
        "sensor_latest_status": _LATEST_STAMPED,
    },
    ", processed_at",
)
_ONE_STAMP = ", timestamp '2024-06-01 00:00:00' as processed_at"
_PLAIN = {t: f"select * from {t}" for t in _HAS}

# The second batch once more, eleven seconds after the first: its keys get that stamp.
_REPLAY_STAMPS = _STAMPS.replace("max(batch_no)", "max(if(batch_no = 1, 11, batch_no))")

_STRAY_ARRIVALS = _FIRST_ARRIVALS.replace(
    "case when event_type = 'view' and k = 13 then null",
    "case when event_id % 400 = 3 then make_timestamp(event_id * 1000000 * 1800)\n"
    "         when event_type = 'view' and k = 13 then null",
)
_STRAY = [_NUMBERED, _STRAY_ARRIVALS, _ARRIVALS, _CLASSIFIED, _VALID, _SILVER, *_GOLD, _STAMPS]

_LITERAL = """
seen_0 as (
  select * from valid where batch_no = 0),
seen_1 as (
  select * from seen_0
  union all
  select * from valid where batch_no = 1
    and event_id not in (select event_id from seen_0)),
seen_2 as (
  select * from seen_1
  union all
  select * from valid where batch_no = 2
    and event_id not in (select event_id from seen_1))"""

_REQUESTS = """
request_log as (
  select ts as started_at, event_type <> 'error' as ok,
    cast(case when event_type <> 'error' then 200 when k % 2 = 0 then 502 else 0 end as integer)
      as status,
    value as latency_ms
  from numbered)"""


def _silver_in(keys: str, columns: str) -> str:
    condition = " and ".join(f"s.{key} = w.{key}" for key in keys.split(", "))
    return f"""
      select s.event_id, {columns}, cast(w.batch_no as integer) as batch_no
      from silver s join (
        select distinct batch_no, {keys}, window_start, window_end from valid) w
      on {condition} and s.event_time >= w.window_start and s.event_time < w.window_end"""


def _equality(table: str) -> str:
    return (
        f"select '{table}' as table_name, cast(count(*) as bigint) as incremental_rows, "
        f"cast(count(*) as bigint) as rebuilt_rows, cast(0 as bigint) as different_rows "
        f"from {table}"
    )


ORACLES: dict[str, str] = {
    "parse_events": _base(
        "select src_id, batch_no, sensor_id, site, temperature, humidity, event_time from arrivals"
    ),
    "validation_errors": _base("select src_id, batch_no, validation_error from classified"),
    "validation_counts": _base(
        "select coalesce(validation_error, 'valid') as outcome, count(*) as events "
        "from classified group by all"
    ),
    "dlq_records": _base(
        "select sensor_id, site, temperature, humidity, event_time, validation_error, "
        "cast(batch_no as integer) as batch_id from classified where validation_error is not null"
    ),
    "events_with_id": _base("select src_id, batch_no, event_id from valid"),
    "silver_dedup": _base(
        "select event_id, sensor_id, site, temperature, humidity, event_time from silver"
    ),
    "silver_literal_merge": _with(
        _BASE + [_LITERAL],
        "select event_id, sensor_id, site, temperature, humidity, event_time, batch_no "
        "from seen_2",
    ),
    "affected_sensor_windows": _base(
        "select distinct sensor_id, site, window_start, window_end, "
        "cast(batch_no as integer) as batch_no from valid"
    ),
    "affected_site_windows": _base(
        "select distinct site, window_start, window_end, "
        "cast(batch_no as integer) as batch_no from valid"
    ),
    "affected_sensors": _base(
        "select distinct sensor_id, cast(batch_no as integer) as batch_no from valid"
    ),
    "silver_in_affected_sensor_windows": _base(
        _silver_in("sensor_id, site", "s.sensor_id, s.site, w.window_start")
    ),
    "silver_in_affected_site_windows": _base(_silver_in("site", "s.site, w.window_start")),
    "sensor_minute": _gold("select * from sensor_minute"),
    "site_minute": _gold("select * from site_minute"),
    "site_alert_minute": _gold("select * from site_alert_minute"),
    "sensor_latest_status": _gold("select * from sensor_latest_status"),
    "gold_rebuild": _gold(_gold_rows(_PLAIN, _ONE_STAMP)),
    "gold_large": _stamped(_STAMPED_ROWS),
    "gold_after_compaction": _stamped(_STAMPED_ROWS),
    "gold_stray_times": _with(_STRAY, _STAMPED_ROWS),
    "silver_stray_times": _with(_STRAY, _SILVER_STAMPED),
    "silver_insert_if_absent_large": _stamped(_SILVER_STAMPED),
    "batch_replay": _with(_BASE + _GOLD + [_REPLAY_STAMPS], _STAMPED_ROWS),
    "all_invalid_batch": _base(
        "select validation_error as name, count(*) as found from classified "
        "where validation_error is not null group by all union all "
        "select unnest(['sensor_events_validated', 'sensor_minute', 'site_minute', "
        "'site_alert_minute', 'sensor_latest_status']), 0"
    ),
    "dlq_reprocessed": _base(
        "select sensor_id, site, temperature, humidity, event_time, validation_error, "
        "cast(batch_no as integer) as batch_id from classified where validation_error is not null"
    ),
    "adhoc_sql": _gold(
        "select site, date_trunc('hour', a.window_start)::timestamp as hour, a.alert_level, "
        "count(*) as minutes, cast(sum(event_count) as bigint) as events "
        "from site_alert_minute a join site_minute s using (site, window_start) group by all"
    ),
    "silver_insert_if_absent": _stamped(_SILVER_STAMPED),
    "sensor_minute_upsert": _stamped(_SENSOR_MINUTE_STAMPED),
    "site_minute_upsert": _stamped(_SITE_MINUTE_STAMPED),
    "site_alert_minute_upsert": _stamped(_SITE_ALERT_STAMPED),
    "sensor_latest_status_upsert": _stamped(_LATEST_STAMPED),
    "gold_incremental_equals_rebuild": _gold(
        " union all ".join(
            _equality(t)
            for t in ("sensor_minute", "site_minute", "site_alert_minute", "sensor_latest_status")
        )
    ),
    "stream_end_to_end": _gold(
        f"select *, cast(null as varchar) as label from ({_gold_rows(_PLAIN)}) union all "
        f"{_shape('sensor_events_validated', ' '.join(_EVENT), ', event_id')} from silver union all "
        f"{_shape('dead_letters', ' '.join(_EVENT), ', validation_error')} from classified "
        "where validation_error is not null"
    ),
    "report_latest_events": _stamped(
        _SILVER_STAMPED + " order by event_time desc, event_id limit 20"
    ),
    "report_sensor_minute": _stamped(
        _SENSOR_MINUTE_STAMPED + " order by window_start desc, sensor_id, site limit 20"
    ),
    "report_site_minute": _stamped(
        _SITE_MINUTE_STAMPED + " order by window_start desc, site limit 20"
    ),
    "report_site_alerts": _stamped(
        _SITE_ALERT_STAMPED + " order by window_start desc, site limit 20"
    ),
    "report_sensor_status": _stamped(
        _LATEST_STAMPED + " order by processed_at desc, sensor_id limit 20"
    ),
    "ingest_contract": _base(
        """
  select src_id, batch_no,
    case when coalesce(sensor_id, '') = '' then 'sensor_id'
         when coalesce(site, '') = '' then 'site'
         when temperature is null then 'temperature'
         when humidity is null then 'humidity' end as reject_reason,
    reject_reason is null as accepted,
    coalesce(event_time, timestamp '2024-06-01 00:00:00') as event_time
  from arrivals"""
    ),
    "ingest_filled_times": _base(
        """
  select src_id, batch_no,
    coalesce(sensor_id, '') <> '' and coalesce(site, '') <> ''
      and temperature is not null and humidity is not null as accepted,
    event_time as given, true as as_expected
  from arrivals"""
    ),
    "request_log_report": _with(
        [_NUMBERED, _REQUESTS],
        """
  select count(*) as requests,
    count(*) filter (where ok) as successes,
    count(*) filter (where not ok) as failures,
    (max(epoch_us(started_at) + cast(round(latency_ms * 1000) as bigint))
      - min(epoch_us(started_at))) / 1000000 as duration_seconds,
    cast(round(cast(cast(avg(latency_ms) as varchar) as decimal(28,15)), 2) as double)
      as latency_avg_ms,
    count(*) / duration_seconds as throughput_rps,
    round((select latency_ms from
      (select latency_ms, row_number() over (order by latency_ms) as place from request_log)
      where place = (select greatest(cast(floor(count(*) * 0.95::double) as bigint), 1)
                     from request_log)), 2) as latency_p95_ms
  from request_log""",
    ),
    "request_log_status_counts": _with(
        [_NUMBERED, _REQUESTS],
        "select status, count(*) as requests from request_log group by status",
    ),
}
ORACLES["request_log_report_small_steps"] = ORACLES["request_log_report"]
