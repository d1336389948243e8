"""The same results in plain SQL over the given tables, written independently."""

from __future__ import annotations

EVENT_FIELDS = (
    "service_date, route_id, trip_id, direction_id, stop_id, stop_sequence, vehicle_id, "
    "vehicle_label, event_type, event_time, scheduled_headway, scheduled_tt"
)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": ((), """
        select case when o_orderstatus = 'P' then 'P' else '' end || cast(o_orderkey as varchar)
                   as trip_id, o_orderpriority as route_id,
               cast(case when o_orderkey % 17 <> 0 then o_custkey % 2 end as int) as direction_id,
               cast((o_custkey % 60) * 2 as varchar) as trip_short_name, o_orderkey as ord
        from orders"""),
    "stop_times": ((), """
        select cast(l_orderkey as varchar) as trip_id,
               'S' || lpad(cast(l_suppkey % 40 as varchar), 3, '0') as stop_id,
               l_linenumber * 100000000000000000 + l_partkey * 1000000 + l_suppkey
                   as stop_sequence,
               cast(l_orderkey * 7919 % 79200 + l_linenumber * 1800 + l_partkey % 60 as int)
                   as sec
        from lineitem"""),
    "running": ((), """
        select service_id, day from (
            select r_regionkey as service_id, cast(unnest(range(date '2024-01-01', date '2024-02-01',
                       interval 1 day)) as date) as day from region)
        where case service_id when 0 then true when 1 then isodow(day) < 6 when 2 then isodow(day) > 5
                   when 4 then isodow(day) < 6 and day <= date '2024-01-15' else false end
        union select n_regionkey, date '2024-01-06' + cast(n_nationkey // 10 as int)
              from nation where n_nationkey % 2 = 0
        except select n_regionkey, date '2024-01-06' + cast(n_nationkey // 10 as int)
               from nation where n_nationkey % 2 = 1"""),
    "day_sets": (("running",), """
        select day, min(day) over (partition by services) as day_type from (
            select day, list(service_id order by service_id) as services from running group by day)"""),
    "stops": (("trips", "stop_times"), """
        select s.trip_id, s.stop_id, s.stop_sequence, t.route_id, t.direction_id,
               case when s.sec < 86400 then s.sec end as arrival_time
        from stop_times s left join trips t on s.trip_id = t.trip_id"""),
    "metrics": (("stops",), """
        select *, cast(arrival_time - lag(arrival_time) over (
                   partition by route_id, direction_id, stop_id
                   order by arrival_time nulls first, trip_id, stop_sequence) as bigint)
                   as scheduled_headway,
               cast(arrival_time - min(arrival_time) over (partition by trip_id) as bigint)
                   as scheduled_tt
        from stops"""),
    "means": (("metrics",), """
        select stop_id, direction_id, avg(scheduled_headway) as scheduled_headway,
               avg(scheduled_tt) as scheduled_tt
        from metrics group by stop_id, direction_id"""),
    "last_stops": (("stop_times",), """
        select trip_id, stop_id as headsign_stop_id from (
            select *, row_number() over (
                partition by trip_id order by stop_sequence desc, stop_id desc) as n
            from stop_times) where n = 1"""),
    "lookup1": (("trips",), """
        select trip_short_name, direction_id from (
            select *, row_number() over (partition by trip_short_name order by ord) as n
            from trips) where n = 1"""),
    "lookup2": (("trips", "last_stops"), """
        select headsign_stop_id, direction_id from (
            select l.headsign_stop_id, t.direction_id, row_number() over (
                partition by l.headsign_stop_id order by t.ord) as n
            from trips t join last_stops l on t.trip_id = l.trip_id) where n = 1"""),
    "station_rows": ((), """
        select event_id, event_type, cast(user_id as varchar) as "trainNumRaw",
               'Route ' || (user_id % 7) as "routeName",
               'S' || lpad(cast(event_id % 45 as varchar), 3, '0') as code,
               'S' || lpad(cast(user_id % 45 as varchar), 3, '0') as "destCode",
               case user_id % 3 when 0 then 'Amtrak' when 1 then 'Via' else 'Brightline' end
                   as provider,
               event_type = 'error' as bus,
               case when event_type = 'view' then 'Enroute' else 'Departed' end as status,
               case when event_id % 11 <> 0 then
                   date_trunc('second', ts) - to_seconds(cast(floor(value) as int)) end as arr,
               case when event_id % 19 <> 0 then date_trunc('second', ts) end as dep
        from events"""),
    "trains": (("station_rows",), """
        select event_id // 8 as document_id, "trainNumRaw", "routeName", "destCode", provider,
               event_type, case when event_type = 'purchase' then 0 else count(*) end as stops
        from station_rows group by event_id // 8, "trainNumRaw", "routeName", "destCode", provider,
            event_type"""),
    "faults": (("trains",), """
        select document_id, cast(case document_id % 5 when 0 then sum(stops) when 1 then count(*)
                   when 2 then 1 else 0 end as int) as violations, count(*) as trains
        from trains group by document_id"""),
    "directed": (("station_rows", "lookup1", "lookup2"), """
        select r.*, coalesce(p.direction_id, s.direction_id) as direction_id,
               case when p.direction_id is not null then 'primary'
                    when s.direction_id is not null then 'secondary' end as lookup_method
        from station_rows r
        left join lookup1 p on r."trainNumRaw" = p.trip_short_name
        left join lookup2 s on r."destCode" = s.headsign_stop_id"""),
    "enriched": (("directed", "means"), """
        select d.*, cast(round_even(m.scheduled_headway, 0) as bigint) as scheduled_headway,
               cast(round_even(m.scheduled_tt, 0) as bigint) as scheduled_tt
        from directed d
        left join means m on d.code = m.stop_id and d.direction_id = m.direction_id"""),
    "redirected": (("directed", "means"), """
        select d.* exclude (direction_id),
               case when provider <> 'Brightline' then d.direction_id
                    when "destCode" in ('S002', 'S008') then 1
                    when "destCode" = 'S005' then 0 end as direction_id
        from directed d"""),
    "enriched3": (("redirected", "means"), """
        select d.*, cast(round_even(m.scheduled_headway, 0) as bigint) as scheduled_headway,
               cast(round_even(m.scheduled_tt, 0) as bigint) as scheduled_tt
        from redirected d
        left join means m on d.code = m.stop_id and d.direction_id = m.direction_id
        where not bus and status = 'Departed'"""),
    "raw": (("enriched3",), """
        select *, cast(year(moment) as int) as "Year", cast(month(moment) as int) as "Month", cast(day(moment) as int) as "Day" from (
            {events})"""),
    "daily": (("raw",), """
        select provider, {fields}, route_id || '_' || coalesce(cast(direction_id as varchar),
                   'None') || '_' || stop_id as stop_path,
               cast(year(svc) as int) as "Year", cast(month(svc) as int) as "Month", cast(day(svc) as int) as "Day",
               svc, cast(moment as date) as raw_day
        from (select * exclude ("Year", "Month", "Day"),
                  cast(moment - interval 3 hour as date) as svc from raw)"""),
    "month": (("daily",), """
        select * from daily where svc between date '2024-01-01' and date '2024-01-30'
            and raw_day between date '2024-01-01' and date '2024-01-31'"""),
}


def _half(source: str, kind: str, column: str) -> str:
    return f"""select provider,
        cast(cast({column} - interval 3 hour as date) as varchar) as service_date,
        "routeName" as route_id, "trainNumRaw" as trip_id, direction_id, code as stop_id,
        cast(null as bigint) as stop_sequence, "trainNumRaw" as vehicle_id,
        "trainNumRaw" as vehicle_label, '{kind}' as event_type,
        strftime({column}, '%Y-%m-%dT%H:%M:%S+00:00') as event_time,
        scheduled_headway, scheduled_tt, {column} as moment
        from {source} where {column} is not null"""


def _events(source: str) -> str:
    return f"{_half(source, 'ARR', 'arr')} union all {_half(source, 'DEP', 'dep')}"


def _ingested(condition: str) -> str:
    """Events of the departed trains of the default providers whose rows meet a condition."""
    return _events("them").replace("from them where", f"""from enriched where not bus
        and status = 'Departed' and event_type <> 'purchase' and provider in ('Amtrak', 'Via')
        and {condition} and""")


def _future(train: str) -> str:
    """The one event of the snapshot with a departure far ahead."""
    return f"""select 'Amtrak', '2035-06-01', 'Route 9', '{train}', cast(null as int), 'S999',
        cast(null as bigint), '{train}', '{train}', 'DEP', '2035-06-01T12:00:00+00:00',
        cast(null as bigint), cast(null as bigint)"""


def _with(query: str, *names: str) -> str:
    """Prefix a query with the named steps and all they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    steps = ", ".join(
        f"{name} as ({CTES[name][1].replace('{events}', _events('enriched3')).replace('{fields}', EVENT_FIELDS)})"
        for name in ordered)
    return f"with {steps} {query}" if steps else query


STOP_KEY = "trip_id, stop_sequence, stop_id"
TIMES = """strftime(arr, '%Y-%m-%d %H:%M:%S') as arr, strftime(dep, '%Y-%m-%d %H:%M:%S') as dep"""
PLANNED = "strftime(dep, '%Y-%m-%d %H:%M:%S')"
READ_ROWS = f"""select "routeName", "trainNumRaw", "destCode", provider, code,
    'America/Toronto' as tz, bus, {PLANNED} as "schArr", {PLANNED} as "schDep",
    {TIMES}, status from station_rows where event_type <> 'purchase'"""
EMPTY_ROWS = """select "routeName", "trainNumRaw", "destCode", provider, null as code,
    null as tz, null as bus, null as "schArr", null as "schDep", null as arr, null as dep,
    null as status from trains where event_type = 'purchase'"""
DAILY_COLUMNS = f"""provider, {EVENT_FIELDS}, stop_path, "Year", "Month", "Day" """
SUMMARY = """select provider, cast(svc as varchar) as service_day, count(*) as events_count,
    count(distinct stop_path) as files_uploaded from month group by provider, svc"""
STORED = """svc = raw_day and svc between date '2024-01-01' and date '2024-01-30'
    and svc not between date '2024-01-10' and date '2024-01-12'"""
RAW_ROWS = f"provider, {EVENT_FIELDS}"
AGENCIES = """with c as (
    select c_name as agency, c_mktsegment as segment,
        date '2025-11-01' + cast(c_custkey % 28 as int) as known,
        case when c_acctbal >= 0 then date '2025-11-01' + cast(c_custkey % 28 as int)
            + case when c_mktsegment in ('MACHINERY', 'BUILDING') then 1 else 0 end end as now
    from customer), m as (
    select agency, cast(now as varchar) || 'T10:00:00' as last_modified,
        case when segment <> 'FURNITURE' then cast(known as varchar) || 'T10:00:00' end
            as cached_modified from c)"""


def oracle_sql() -> dict[str, str]:
    pct = "case when count(*) > 0 then 100::double * {0} / count(*) else 0::double end"
    return {
        "gtfs_time_seconds": _with(
            f"""select {STOP_KEY}, lpad(cast(sec // 3600 as varchar), 2, '0') || ':'
                || lpad(cast(sec // 60 % 60 as varchar), 2, '0') || ':'
                || lpad(cast(sec % 60 as varchar), 2, '0') as arrival_time,
                case when sec < 86400 then sec end as seconds, sec as extended_seconds
                from stop_times""", "stop_times"),
        "gtfs_stop_times": _with(
            f"""select {STOP_KEY}, route_id, direction_id, arrival_time,
                arrival_time as departure_time from stops""", "stops"),
        "gtfs_csv_bundles": _with(
            f"""select case when cast(trip_id as bigint) % 2 = 0 then 'Amtrak' else 'Via' end as provider,
                {STOP_KEY}, route_id, direction_id, arrival_time, arrival_time as departure_time
                from stops""", "stops"),
        "scheduled_headway": _with(
            f"""select {STOP_KEY}, route_id, direction_id, arrival_time, scheduled_headway
                from metrics""", "metrics"),
        "scheduled_travel_time": _with(
            f"select {STOP_KEY}, arrival_time, scheduled_tt from metrics", "metrics"),
        "gtfs_metrics": _with(
            f"""select {STOP_KEY}, route_id, direction_id, arrival_time, scheduled_headway,
                scheduled_tt from metrics""", "metrics"),
        "scheduled_metric_means": _with(
            """select stop_id, direction_id, round(scheduled_headway, 6) as scheduled_headway,
                round(scheduled_tt, 6) as scheduled_tt from means""", "means"),
        "last_stop_per_trip": _with("select * from last_stops", "last_stops"),
        "direction_lookup_primary": _with("select * from lookup1", "lookup1"),
        "direction_lookup_secondary": _with("select * from lookup2", "lookup2"),
        "service_day_types": _with(
            """select cast(day as varchar) as service_day, cast(day_type as varchar) as day_type
                from day_sets""", "day_sets"),
        "scheduled_headway_by_day": _with(
            f"""select {STOP_KEY}, cast(d.service_id as bigint) as service_id,
                cast(day_type as varchar) as day_type,
                cast(arrival_time - lag(arrival_time) over (
                   partition by day_type, route_id, direction_id, stop_id
                   order by arrival_time nulls first, trip_id, stop_sequence) as bigint)
                   as scheduled_headway
                from stops s join orders o on s.trip_id = cast(o.o_orderkey as varchar)
                join (select distinct service_id, day_type from running join day_sets using (day)) d
                  on d.service_id = o.o_custkey % 5""", "stops", "day_sets"),
        "stop_sequence_fill": _with(
            """, timed as (select event_id, "trainNumRaw", code, coalesce(arr, dep) as seen from station_rows),
            calls as (select trip_short_name, stop_id, sec % 86400 as sec, stop_sequence
                      from stop_times s join trips t on s.trip_id = t.trip_id),
            late as (select event_id, sec, stop_sequence, (hour(seen) * 3600 + minute(seen) * 60
                            + second(seen) - sec + 129600) % 86400 - 43200 as off_plan
                     from timed join calls on trip_short_name = "trainNumRaw" and stop_id = code),
            nearest as (select * from late where abs(off_plan) <= 3600 qualify row_number() over (
                            partition by event_id order by abs(off_plan), sec, stop_sequence) = 1)
            select event_id, "trainNumRaw", code, stop_sequence, cast(sec as int) as planned_time,
                   cast(off_plan as int) as off_plan
            from timed left join nearest using (event_id)""", "station_rows", "stop_times", "trips"),
        "direction_id": _with(
            """select event_id, "trainNumRaw", "destCode", direction_id, lookup_method
                from directed""", "directed"),
        "direction_match_stats": _with(
            f"""select count(*) filter (lookup_method = 'primary') as primary_hits,
                count(*) filter (lookup_method = 'secondary') as secondary_hits,
                count(*) filter (direction_id is null) as misses,
                {pct.format("count(lookup_method)")} as match_rate_pct from directed""",
            "directed"),
        "direction_custom_headsign": _with(
            """select event_id, "destCode", case when "destCode" in ('S002', 'S008') then 1
                when "destCode" = 'S005' then 0 end as direction_id from station_rows""",
            "station_rows"),
        "scheduled_metrics": _with(
            """select event_id, code, direction_id, scheduled_headway, scheduled_tt
                from enriched""", "enriched"),
        "metric_match_stats": _with(
            f"""select count(scheduled_headway) as metrics_found,
                count(*) - count(scheduled_headway) as metrics_missing,
                {pct.format("count(scheduled_headway)")} as match_rate_pct from enriched""",
            "enriched"),
        "service_dates": _with(
            """select event_id,
                cast(cast(arr - interval 3 hour as date) as varchar) as service_date_arr,
                cast(cast(dep - interval 3 hour as date) as varchar) as service_date_dep
                from station_rows""", "station_rows"),
        "service_date_eastern": _with(
            """select event_id, cast(cast(timezone('America/New_York', timezone('UTC', dep))
                - interval 3 hour as date) as varchar) as service_date from station_rows""",
            "station_rows"),
        "parse_iso_timestamps": """select event_id, case when event_id % 4 <> 3 then
            strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') end as parsed from events""",
        "parse_http_date": """select event_id,
            strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as parsed from events""",
        "flatten_map_rows": _with(
            """select "routeName", "trainNumRaw", "destCode", provider, cast(stops as int) as stops
                from trains""", "trains"),
        "snapshot_validation": _with("select document_id, violations from faults", "faults"),
        "snapshot_counts": _with(
            """select count(*) as documents, count(*) filter (violations > 0) as rejected,
                coalesce(cast(sum(trains) filter (violations = 0) as bigint), 0) as trains
                from faults""", "faults"),
        "snapshot_quarantine": _with(
            "select document_id, violations from faults where violations > 0", "faults"),
        "explode_stations": _with(f"{READ_ROWS} union all {EMPTY_ROWS}", "trains"),
        "snapshot_read": _with(
            f"""{READ_ROWS} and station_rows.dep > timestamp '2024-01-15 00:00:00'
                and not bus and status = 'Departed'""", "station_rows"),
        "incremental_filter": _with(
            f"""select event_id, {PLANNED} as dep from station_rows
                where station_rows.dep > timestamp '2024-01-15 00:00:00'""", "station_rows"),
        "incremental_filter_first_run": _with(
            f"select event_id, {PLANNED} as dep from station_rows", "station_rows"),
        "departed_rail_only": _with(
            """select event_id, bus, status from station_rows
                where not bus and status = 'Departed'""", "station_rows"),
        "provider_split": _with(
            """select event_id, provider from station_rows
                where provider in ('Amtrak', 'Via')""", "station_rows"),
        "ingest_funnel": _with(
            """select count(*) as station_rows,
                count(*) filter (fresh) as rows_after_time_filter,
                count(*) filter (kept) as rows_after_bus_removal,
                count(*) filter (kept and provider = 'Amtrak') as rows_amtrak,
                count(*) filter (kept and provider = 'Via') as rows_via,
                count(*) filter (kept and provider = 'Brightline') as rows_brightline
                from (select *, dep > timestamp '2024-01-15 00:00:00' as fresh,
                    dep > timestamp '2024-01-15 00:00:00' and not bus and status = 'Departed'
                        as kept from station_rows)""", "station_rows"),
        "preview_service_dates": _with(
            f"""select "trainNumRaw", code, {TIMES},
                cast(cast(station_rows.arr - interval 3 hour as date) as varchar)
                    as service_date_arr,
                cast(cast(station_rows.dep - interval 3 hour as date) as varchar)
                    as service_date_dep
                from station_rows
                order by station_rows.dep nulls last, "trainNumRaw", code limit 10""", "station_rows"),
        "arr_dep_events": _with(
            f"""select {RAW_ROWS} from ({_events('gone')})""".replace(
                "from gone where", "from enriched where not bus and status = 'Departed' and"),
            "enriched"),
        "event_generation": _with(f"select {RAW_ROWS} from raw", "raw"),
        "event_counts": _with(
            """select provider, count(*) filter (event_type = 'ARR') as arrivals,
                count(*) filter (event_type = 'DEP') as departures, count(*) as events
                from raw group by provider""", "raw"),
        "event_dedupe": _with(f"select {RAW_ROWS} from raw", "raw"),
        "event_stream": _with(
            f"select distinct {RAW_ROWS} from ({_ingested('true')}) union all {_future('900001')}",
            "enriched"),
        "cutoff_stream": _with(
            f"""select distinct {RAW_ROWS} from ({_ingested('event_id // 8 % 2 = 0')})
                union all {_future('900001')} union all {_future('900002')}""", "enriched"),
        "ingest_runs": _with(
            f"""select * from (select distinct {RAW_ROWS} from ({_ingested('event_id // 8 % 2 = 0')}))
                union all select * from (select distinct {RAW_ROWS} from (
                    {_ingested("dep > timestamp '2024-01-15 00:00:00'")}))""", "enriched"),
        "raw_events_valid": _with(
            f"""select {RAW_ROWS} from raw union all
                select {RAW_ROWS} from raw where event_type = 'ARR'""", "raw"),
        "raw_event_store": _with(
            f"""select provider, "Year", "Month", "Day", {EVENT_FIELDS} from raw""", "raw"),
        "daily_events": _with(f"select {DAILY_COLUMNS} from daily", "daily"),
        "collate_range": _with(f"select {DAILY_COLUMNS} from month", "month"),
        "raw_store_compacted": _with(f"select {DAILY_COLUMNS} from month", "month"),
        "collate_same_day": _with(
            f"""select {DAILY_COLUMNS} from daily where svc = raw_day
                and svc between date '2024-01-01' and date '2024-01-30'""", "daily"),
        "service_day_slice": _with(
            f"select {DAILY_COLUMNS} from daily where svc = date '2024-01-15'", "daily"),
        "collation_summary": _with(SUMMARY, "month"),
        "daily_store": _with(f"select {DAILY_COLUMNS} from daily where {STORED}", "daily"),
        "daily_store_concurrent": _with(
            f"select {DAILY_COLUMNS} from month where provider <> 'Brightline'", "month"),
        "collation_report": _with(
            """select provider, case when svc between date '2024-01-01' and date '2024-01-30'
                    then 'kept' else 'other_day' end as kind, cast(svc as varchar) as day,
                count(*) as events_count from daily
                where raw_day between date '2024-01-01' and date '2024-01-31' and day(raw_day) <> 7
                group by provider, svc
                union all
                select provider, 'missing', cast(cast(d as date) as varchar), 0::bigint
                from (values ('Amtrak'), ('Via'), ('Brightline')) p(provider),
                    generate_series(date '2024-01-01', date '2024-01-30', interval 1 day) t(d)
                where (provider, cast(d as date)) not in (
                    select provider, raw_day from daily where day(raw_day) <> 7)""", "daily"),
        "daily_csv": _with(
            f"""select * replace (case provider when 'Via' then 'VIA' else provider end as provider)
                from (select {DAILY_COLUMNS} from daily where {STORED})""", "daily"),
        "collation_leftovers": _with(
            """select provider, cast(placed as varchar) as service_day,
                case when placed is null then 'unreadable_time'
                     when placed not between date '2024-01-01' and date '2024-01-30'
                     then 'other_day' end as left_out, count(*) as events_count
                from (select provider, case when cast(trip_id as int) % 97 <> 0 then svc end as placed
                    from daily where raw_day between date '2024-01-01' and date '2024-01-31')
                group by provider, placed""", "daily"),
        "missing_days": """with seen as (
                select distinct 'user ' || user_id as provider, cast(ts as date) as day
                from events),
            span as (select provider, unnest(generate_series(min(day), max(day),
                interval 1 day)) as day from seen group by provider)
            select provider, cast(cast(day as date) as varchar) as day, 1 as missing_day
            from (select provider, cast(day as date) as day from span
                except select provider, day from seen)""",
        "manifest_diff": f"""{AGENCIES} select * from m where last_modified is not null
            and last_modified is distinct from cached_modified""",
        "manifest_merge": f"""{AGENCIES} select agency,
            coalesce(last_modified, cached_modified) as last_modified from m
            where coalesce(last_modified, cached_modified) is not null""",
    }
