"""DuckDB SQL for every query, written the long way: per run day, per cohort, with ranking windows and plain joins."""

from __future__ import annotations

from checks.fixtures import sql
from checks.queries import AS_OF, CUT_DAYS, DELAYS, HOLIDAYS, LINK, LISTED_AS_OF, PROBLEM_TYPES, RANGE, SCAN_DAYS, SNAPSHOT_DAY, TICKET_DAY, WEEKDAY_TABLES
from kpi_shift.operators.impact import CAUSE_CODES, CAUSES_OF_ALERT
from kpi_shift.spec import RISING, Monitor

MONITOR = Monitor()
KPIS = MONITOR.kpis


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def chain(final: str, **steps: str) -> str:
    """CTEs in the order given, then the final select."""
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in steps.items()) + "\n" + final


def base(*names: str) -> dict[str, str]:
    return {name: sql(name, "duckdb") for name in names}


OLD_SUM = " + ".join(MONITOR.old_columns)
NEW_SUM = " + ".join(MONITOR.new_columns)

# one run day at a time: the 15 days up to it, activity sums, first day with new activity
EVENTS = {
    "ev": f"""
select tower, run_day as event_date from (
  select r.run_day, p.tower, sum({OLD_SUM}) as old_sum, sum({NEW_SUM}) as new_sum,
    min(case when not isnan({NEW_SUM}) and {NEW_SUM} > 0 then p.day end) as first_day
  from (select distinct day as run_day from kpi_panel) r
  join kpi_panel p on p.day between r.run_day - 14 and r.run_day
  group by r.run_day, p.tower)
where first_day = run_day and coalesce(old_sum <> 0, true) and coalesce(new_sum <> 0, true)"""
}


def silent(source: str, kpis: list[str], keys: str, other: str) -> str:
    total = " + ".join(kpis)
    nulled = ", ".join(f"case when {total} = 0 then null else {k} end as {k}" for k in kpis)
    return f"""
select {other}, {nulled} from (
  select *, max(case when {total} = 0 then 1 else 0 end) over (partition by {keys}) as key_silent from {source})
where key_silent = 0 or {total} = 0"""


def run_steps(panel: str, ids: str) -> dict[str, str]:
    """pre_rows, pre, baseline, post_rows, post, scored for a panel."""
    using = " and ".join(f"a.{i} = b.{i}" for i in ids.split(", "))
    pre_named = ", ".join(f"p.{k.old} as {k.name}" for k in KPIS)
    post_named = ", ".join(f"p.{k.new} as {k.name}" for k in KPIS)
    qualified = ", ".join(f"p.{i}" for i in ids.split(", "))
    names = MONITOR.names
    unshared = [k.name for k in KPIS if not k.shared]
    shared = ", ".join(k.name for k in KPIS if k.shared)
    stats = ", ".join(
        f"round(avg({k}), 6) as {k}_avg, round(stddev_samp({k}), 6) as {k}_std" for k in names
    )
    rates, flags = [], []
    for k in KPIS:
        x, a, s = k.name, k.avg, k.std
        if k.bad == RISING:
            r = f"({a} - {x}) / nullif({a}, 0)"
            rates.append(f"round(case when {r} < -1 then -1e0 else {r} end, 6) as {k.change_rate}")
            over = f"{x} > case when {a} + 2 * {s} > {a} + 0.1e0 * {a} then {a} + 2 * {s} else {a} + 0.1e0 * {a} end"
        else:
            r = f"({x} - {a}) / nullif({a}, 0)"
            rates.append(f"round(case when {r} > 1 then 1e0 else {r} end, 6) as {k.change_rate}")
            over = f"{x} < case when {a} - 2 * {s} < {a} - 0.1e0 * {a} then {a} - 2 * {s} else {a} - 0.1e0 * {a} end"
        flags.append(f"0 as {k.alert}" if k.quiet else f"case when {over} then 1 else 0 end as {k.alert}")
    count = " + ".join(k.alert for k in KPIS)
    rounded = ", ".join(f"round({n}, 6) as {n}" for n in names)
    columns = ", ".join(f"{k}_avg, {k}_std" for k in names)
    id_columns = ", ".join(f"a.{i}" for i in ids.split(", "))
    return {
        "pre_rows": f"""select {qualified}, p.day, p.region, p.site, {pre_named}, e.event_date
from {panel} p join ev e on e.tower = p.tower and p.day between e.event_date - 14 and e.event_date - 1""",
        "pre": silent("pre_rows", names, f"event_date, day, {ids}", f"{ids}, day, region, site, event_date"),
        "baseline": f"select {ids}, event_date, {stats} from pre group by {ids}, event_date",
        "post_rows": f"""select {qualified}, p.day, p.region, p.site, {post_named}, e.event_date
from {panel} p join ev e on e.tower = p.tower and p.day between e.event_date and e.event_date + 14""",
        "post": silent(
            "post_rows", unshared, f"event_date, day, {ids}", f"{ids}, day, region, site, event_date, {shared}"
        ),
        "judged": f"""select {id_columns}, a.event_date, a.day, a.region, a.site, {columns}, {rounded},
{", ".join(rates)}, {", ".join(flags)}
from post a join baseline b on {using} and a.event_date = b.event_date""",
        "scored": f"""select *, {count} as abnormal_kpi, case when {count} > 0 then 1 else 0 end as has_abnormal_kpi
from judged""",
    }


PANEL = base("kpi_panel")
RUN = PANEL | EVENTS | run_steps("kpi_panel", "tower")
PANEL_EVENTS = PANEL | EVENTS

ALL_ZERO = " and ".join(f"{n} = 0" for n in MONITOR.names)
OVERRIDDEN = f"""select * replace (case when {ALL_ZERO} then 0 else has_abnormal_kpi end as has_abnormal_kpi),
event_date as event_day from scored"""

COORDS = {
    "coords": """
select case when length(tower) < 6 then lpad(tower, 6, '0') else tower end as tower, latitude, longitude from (
  select *, row_number() over (partition by tower order by latitude desc, longitude desc) as rn from tower_coords)
where rn = 1"""
}

LATEST_ORDER = "modified_date desc, create_date desc, lat desc, lng desc, problem_type desc, assigned_group desc"
WANTED = f"(problem_type in ({listed(PROBLEM_TYPES)}) or assigned_group = 'NRB')"
LATEST = {
    "latest": f"""
select trouble_id, status, modified_date, create_date, lat, lng, problem_type, assigned_group from (
  select *, row_number() over (partition by trouble_id, status order by {LATEST_ORDER}) as rn from tickets
  where create_date <= date '{TICKET_DAY}' and modified_date <= date '{TICKET_DAY}')
where rn = 1"""
}

# every run day of every cohort, each with its own latest versions and its own nearest tower
RUN_DAYS = {"pairs": "select distinct event_date, event_date + cast(k as int) as day from ev, range(15) t(k)"}
MILES = """2 * 6371.7e0 * asin(sqrt(sin(radians(c.latitude - o.lat) / 2) * sin(radians(c.latitude - o.lat) / 2)
  + cos(radians(o.lat)) * cos(radians(c.latitude)) * sin(radians(c.longitude - o.lng) / 2)
  * sin(radians(c.longitude - o.lng) / 2))) / 1.60934e0"""
NEAR = {
    "as_of": f"""
select r.day, t.*, row_number() over (partition by r.day, trouble_id, status order by {LATEST_ORDER}) as rn
from (select distinct day from pairs) r join tickets t on t.create_date <= r.day and t.modified_date <= r.day""",
    "open_then": f"""
select o.* from as_of o where o.rn = 1 and lower(o.status) = 'open' and {WANTED} and not exists (
  select 1 from as_of c where c.day = o.day and c.trouble_id = o.trouble_id and c.rn = 1 and lower(c.status) <> 'open')""",
    "measured": f"""
select p.event_date, p.day, o.trouble_id, o.status, e.tower, {MILES} as miles
from pairs p join open_then o on o.day = p.day and o.create_date >= p.event_date
join ev e on e.event_date = p.event_date join coords c on c.tower = e.tower
where abs(c.latitude - o.lat) < 1""",
    "nearest": """
select *, row_number() over (partition by event_date, day, trouble_id, status order by round(miles, 6), tower) as rn
from measured where miles <= 5""",
    "near": "select tower, event_date, day, count(*) as nrb_ticket_counts from nearest where rn = 1 group by all",
}
ORDERS = {
    "order_rows": """
select noc_id, status, data_date, cast(substr(event_start, 1, 10) as date) as event_start,
  cast(substr(event_end, 1, 10) as date) as event_end, lat, lng,
  case when length(cell_id) > 8 then substr(cell_id, 1, length(cell_id) - 4) else cell_id end as tower
from work_orders where lower(status) = 'open' and cell_id is not null""",
    "order_versions": """
select p.event_date, p.day, o.*, row_number() over (partition by p.event_date, p.day, noc_id, status
  order by event_start desc, event_end desc, lat desc, lng desc, tower desc) as rn
from pairs p join order_rows o on o.data_date between p.event_date and p.day""",
    "orders_near": """
select o.tower, o.event_date, o.day, count(*) as w360_ticket_counts
from order_versions o join ev e on e.tower = o.tower and e.event_date = o.event_date
where o.rn = 1 and o.event_start >= o.event_date group by all""",
}
REPORT = (
    base("tower_coords", "tickets", "work_orders")
    | RUN
    | COORDS
    | RUN_DAYS
    | NEAR
    | ORDERS
    | {
        "overridden": OVERRIDDEN,
        "report": """
select s.*, c.latitude, c.longitude, n.nrb_ticket_counts, w.w360_ticket_counts
from overridden s left join coords c on c.tower = s.tower
left join near n on n.tower = s.tower and n.event_date = s.event_date and n.day = s.day
left join orders_near w on w.tower = s.tower and w.event_date = s.event_date and w.day = s.day""",
    }
)


def entity_report(panel: str, ids: str) -> str:
    using = " and ".join(f"z.{i} = s.{i}" for i in ids.split(", "))
    return chain(
        f"""select distinct s.* replace (coalesce(s.rtp_gap_change_rate, 0) as rtp_gap_change_rate), z.azimuth_deg
from overridden s left join azimuths z on {using} where s.sector <> '0'""",
        **base("kpi_panel", panel, "sector_azimuth"),
        **EVENTS,
        **run_steps(panel, ids),
        overridden=OVERRIDDEN,
        azimuths=f"select distinct {ids}, azimuth_deg from sector_azimuth",
    )


DOCUMENT = ", ".join(
    [f"case when {k.alert} <> 0 then {k.name} end as {k.name}" for k in KPIS] + [k.alert for k in KPIS]
)
NORMALISED = f"""
select day, cause_code as data_b_cause_code, enodeb as data_b_enodeb, msisdn as data_b_msisdn,
  from_uri as data_b_from_uri, substr(cause_code, 1, 4) as cause_code, split_part(enodeb, '_', 1) as tower,
  substr(msisdn, 2, 10) as msisdn_num, substr(from_uri, 7, 10) as fromuri_num
from call_failures where substr(cause_code, 1, 4) in ({listed(CAUSE_CODES)})"""
IMPACTED = " union all ".join(
    f"""select f.tower, f.day, f.fromuri_num, f.msisdn_num, f.cause_code, '{alert}' as abnormal_feature
from failures f join scored s on s.tower = f.tower and s.day = f.day
where s.has_abnormal_kpi = 1 and s.{alert} = 1 and f.cause_code = '{code}'"""
    for alert, codes in CAUSES_OF_ALERT.items()
    for code in codes
)

EXPECTED = f"date '{AS_OF}' - x.delay"
EXPECTED_TABLES = " union all ".join(f"select '{t}' as table_name, {d} as delay" for t, d in DELAYS.items())
FRESH = f"""
select x.table_name, max(p.day) as latest_day, {EXPECTED} as expected_day, cast({EXPECTED} - max(p.day) as int) as delayed_days
from ({EXPECTED_TABLES}) x left join partition_days p on p.table_name = x.table_name group by x.table_name, x.delay"""
MISSING = f"""
select x.table_name, {EXPECTED} - cast(k as int) as day from ({EXPECTED_TABLES}) x, range(20) r(k)
where not exists (select 1 from partition_days p where p.table_name = x.table_name and p.day = {EXPECTED} - cast(k as int))
  and (x.table_name not in ({listed(WEEKDAY_TABLES)})
    or (isodow({EXPECTED} - cast(k as int)) < 6 and cast({EXPECTED} - cast(k as int) as varchar) not in ({listed(HOLIDAYS)})))"""

PARSED = """
select cast(length(event_type) as int) as "eventType", epoch_us(ts) // 1000 as "timestamp", concat(event_type, '-', event_id) as data,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as date_parsed, cast(user_id % 90 as varchar) as latitude,
  cast(user_id % 180 as varchar) as longitude, cast(hour(ts) as int) as hour, cast(ts as date) as date
from events"""


# raw rows of the scanned days, and whether their day's file was cut
FILED = {
    **base("kpi_raw"),
    "filed": f"""select *, cast(strptime(day, '%m/%d/%Y') as date) as file_day,
  cast(cast(strptime(day, '%m/%d/%Y') as date) as varchar) in ({listed(CUT_DAYS)}) as is_cut
from kpi_raw where strptime(day, '%m/%d/%Y') between date '{SCAN_DAYS[0]}' and date '{SCAN_DAYS[1]}'""",
}

ORACLE = {
    "date_window": """
select run_day, run_day - cast(k as int) as day
from (select distinct cast(ts as date) as run_day from events), range(15) r(k)""",
    "clean_kpis": chain(
        """select tower, day, max(site) as site, market, kpi, 0e0 as rtp_gap from (
  select case when length(tower) < 6 then lpad(tower, 6, '0') else tower end as tower,
    cast(strptime(day, '%m/%d/%Y') as date) as day, site, market, try_cast(kpi as double) as kpi
  from kpi_raw where tower <> '*' and tower is not null)
group by tower, day, market, kpi""",
        **base("kpi_raw"),
    ),
    "vendor_activity": chain(
        f"select tower, day, round({OLD_SUM}, 6) as old_activity, round({NEW_SUM}, 6) as new_activity from kpi_panel",
        **PANEL,
    ),
    "silent_to_null": chain(
        silent(
            "kpi_panel",
            MONITOR.new_columns,
            "tower, day",
            ", ".join(["tower", "day", "region", "site", *MONITOR.old_columns, *MONITOR.shared_columns]),
        ),
        **PANEL,
    ),
    "detect_events": chain(
        f"""select p.*, e.event_date, round({OLD_SUM}, 6) as old_activity, round({NEW_SUM}, 6) as new_activity
from kpi_panel p join ev e on e.tower = p.tower and e.event_date = p.day""",
        **PANEL_EVENTS,
    ),
    "event_list_check": chain(
        """select d.event_date, count(ev.tower) as n_events, count(ev.tower) = 0 as is_empty
from (select date '2024-01-01' + cast(k as int) as event_date from range(30) r(k)) d
left join ev on ev.event_date = d.event_date group by d.event_date""",
        **PANEL_EVENTS,
    ),
    "events_by_level": chain(
        """select distinct z.tower, z.sector, z.carrier, e.event_date
from sector_azimuth z join ev e on e.tower = z.tower""",
        **base("sector_azimuth"),
        **PANEL_EVENTS,
    ),
    "pre_event_panel": chain("select * from pre", **RUN),
    "baseline_stats": chain("select * from baseline", **RUN),
    "post_event_panel": chain("select * from post", **RUN),
    "score_post_event": chain("select * from scored", **RUN),
    "zero_override": chain(OVERRIDDEN, **RUN),
    "tower_coords": chain("select * from coords", **base("tower_coords"), **COORDS),
    "sector_azimuth": chain("select distinct tower, sector, azimuth_deg from sector_azimuth", **base("sector_azimuth")),
    "tower_report": chain("select * from report", **REPORT),
    "sector_report": entity_report("sector_panel", "tower, sector"),
    "carrier_report": entity_report("carrier_panel", "tower, sector, carrier"),
    "latest_tickets": chain("select * from latest", **base("tickets"), **LATEST),
    "open_tickets": chain(
        f"""select * from latest o where lower(status) = 'open' and {WANTED} and not exists (
  select 1 from latest c where c.trouble_id = o.trouble_id and lower(c.status) <> 'open')""",
        **base("tickets"),
        **LATEST,
    ),
    "tickets_near_tower": chain(
        "select * from near", **base("tower_coords", "tickets"), **PANEL_EVENTS, **COORDS, **RUN_DAYS, **NEAR
    ),
    "work_orders_per_tower": chain(
        "select * from orders_near", **base("work_orders"), **PANEL_EVENTS, **RUN_DAYS, **ORDERS
    ),
    "ticket_counts_json": """
select lpad(cast(o_custkey % 150 as varchar), 6, '0') as tower, cast(o_orderdate as date) as day, count(*) as nrb_ticket_counts
from orders group by o_custkey % 150, cast(o_orderdate as date)""",
    "alert_documents": chain(
        f"""select tower as enodeb, day as alert_day, event_day, site, region, abnormal_kpi as abnormal_kpi_count,
  nrb_ticket_counts, w360_ticket_counts, 'new' as vendor, concat('{LINK}', tower) as link, {DOCUMENT}
from report where has_abnormal_kpi = 1""",
        **REPORT,
    ),
    "low_score_messages": "select event_id, event_type, value as score from events where value < 5",
    "flatten_nested": """
select label, vec_id as data_b_vec_id, unnest(embedding) as data_b_embedding from embeddings""",
    "cause_histogram": chain(
        'select cause_code as data_b_cause_code, count(*) as "count" from call_failures group by cause_code',
        **base("call_failures"),
    ),
    "normalise_failures": chain(NORMALISED, **base("call_failures")),
    "impacted_users": chain(IMPACTED, **base("call_failures"), failures=NORMALISED, **RUN),
    "table_freshness": chain(FRESH, **base("partition_days")),
    "missing_days": chain(MISSING, **base("partition_days")),
    "rows_per_day": """
select cast(ts as date) as day, count(*) as row_count from events group by 1 order by 1 desc limit 1""",
    "latest_days": "select distinct cast(ts as date) as day from events order by 1 desc limit 20",
    "completeness_report": chain(
        """select f.*, coalesce((select string_agg(cast(m.day as varchar), ',' order by m.day) from missing m
  where m.table_name = f.table_name), '') as missing_days,
  (select bool_and(coalesce(delayed_days = 0, false)) from fresh) as all_on_time
from fresh f""",
        **base("partition_days"),
        fresh=FRESH,
        missing=MISSING,
    ),
    "score_range": chain(f"select * from scored where day >= date '{RANGE[0]}' and day < date '{RANGE[1]}'", **RUN),
    "dated_scan": chain(
        f"""select distinct tower, day, site, market, kpi, cast(strptime(day, '%m/%d/%Y') as date) as file_day
from kpi_raw where strptime(day, '%m/%d/%Y') between date '{SCAN_DAYS[0]}' and date '{SCAN_DAYS[1]}'""",
        **base("kpi_raw"),
    ),
    "gzip_glob": chain("select * from kpi_raw where day like '01/0%/2024'", **base("kpi_raw")),
    "csv_tree": chain('select tower as "ENODEB", day, site, market, kpi as "RTP" from kpi_raw', **base("kpi_raw")),
    "csv_path_list": chain(
        f"""select day, market, count(*) as n, count(*) filter (kpi = 'n/a') as unknown
from kpi_raw where strptime(day, '%m/%d/%Y') between date '{SCAN_DAYS[0]}' and date '{SCAN_DAYS[1]}' group by day, market""",
        **base("kpi_raw"),
    ),
    "sound_rows": chain(
        """select tower, day, site, market, kpi, file_day from filed
where not is_cut and kpi is distinct from '7' and kpi is distinct from '9'""",
        **FILED,
    ),
    "rejects": chain(
        """select file_day as day, 'malformed record' as reason,
  case when kpi = '7' then concat(coalesce(tower, ''), ',', day, ',', site, ',', market, ',7,late') else concat(day, ',', market) end as record,
  count(*) as n
from filed where not is_cut and kpi in ('7', '9') group by 1, 2, 3
union all select distinct file_day, 'unreadable file', cast(null as varchar), 1 from filed where is_cut""",
        **FILED,
    ),
    "dated_partitions": chain(
        f"select * from snapshots where date between date '2024-01-01' and date '{SNAPSHOT_DAY}'", **base("tower_coords", "snapshots")
    ),
    "listed_days": chain(
        f"""select t.table_name, date '{LISTED_AS_OF}' - 1 - cast(k as int) as day
from (values ('raw files', false), ('other files', true)) t(table_name, weekdays), range(20) r(k)
where not (t.table_name = 'raw files' and exists (
    select 1 from kpi_raw p where cast(strptime(p.day, '%m/%d/%Y') as date) = date '{LISTED_AS_OF}' - 1 - cast(k as int)))
  and (not weekdays or (isodow(date '{LISTED_AS_OF}' - 1 - cast(k as int)) < 6
    and cast(date '{LISTED_AS_OF}' - 1 - cast(k as int) as varchar) not in ({listed(HOLIDAYS)})))""",
        **base("kpi_raw"),
    ),
    "latest_snapshot": chain(
        f"""select * from snapshots where date = (select max(date) from snapshots where date <= date '{SNAPSHOT_DAY}')""",
        **base("tower_coords", "snapshots"),
    ),
    "stream_parse": PARSED,
    "stream_to_files": PARSED,
    "queue_messages": PARSED,
    "compacted_messages": PARSED,
    "stream_score": chain("select * from scored where has_abnormal_kpi = 1", **RUN),
    "stream_withdrawn": chain("select * from scored where has_abnormal_kpi = 1", **RUN),
    "published_scores": chain(f"select * from scored where day >= date '{RANGE[0]}' and day < date '{RANGE[1]}'", **RUN),
    "colocated_scores": chain("select * from scored", **RUN),
    "kept_events": chain("select * from ev", **PANEL_EVENTS),
    "kept_baselines": chain("select * from baseline", **RUN),
    "ticket_history": chain(
        """select day, trouble_id, status, create_date, modified_date, problem_type, assigned_group from open_then""",
        pairs=f"select cast(date '{RANGE[0]}' + cast(k as int) as date) as day from range(date '{RANGE[1]}' - date '{RANGE[0]}') r(k)",
        **base("tickets"),
        as_of=NEAR["as_of"],
        open_then=NEAR["open_then"],
    ),
    "kept_tickets_near": chain(
        f"select * from near where day >= date '{RANGE[0]}' and day < date '{RANGE[1]}'",
        **base("tower_coords", "tickets"), **PANEL_EVENTS, **COORDS, **RUN_DAYS, **NEAR
    ),
}
