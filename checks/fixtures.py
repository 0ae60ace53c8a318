"""Monitoring tables derived from the star-schema test tables.

Each text runs on both engines, apart from the places in braces, which name what differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("events", "orders", "embeddings")

KPI_PANEL = """
with u as (select distinct user_id from events),
g as (select user_id, cast(ts as date) as day, count(*) as n,
  sum(case when event_type = 'view' then cast(value as decimal(18,2)) else 0 end) as v_view,
  sum(case when event_type = 'click' then cast(value as decimal(18,2)) else 0 end) as v_click,
  sum(case when event_type = 'purchase' then cast(value as decimal(18,2)) else 0 end) as v_purchase,
  sum(case when event_type = 'error' then cast(value as decimal(18,2)) else 0 end) as v_error,
  sum(case when event_type = 'signup' then cast(value as decimal(18,2)) else 0 end) as v_signup,
  sum(case when event_type = 'error' then 1 else 0 end) as n_error
  from events group by user_id, cast(ts as date)),
grid as ({grid}),
p as (select grid.user_id, grid.day, grid.day >= date '2024-01-16' + cast(grid.user_id % 10 as int) as switched,
  coalesce(n, 0) as n, coalesce(n_error, 0) as n_error,
  cast(coalesce(v_error, 0) as double) as bearer_drop_rate,
  cast(coalesce(v_signup, 0) as double) as rrc_setup_failure,
  case when n is null then 0e0 else 100e0 + cast(v_view as double) end as avgconnected_users,
  case when n is null then 0e0 else 100e0 + cast(v_click as double) end as dl_data_volume,
  case when n is null then 0e0 else 100e0 + cast(v_purchase as double) end as uptp
  from grid left join g on g.user_id = grid.user_id and g.day = grid.day)
select lpad(cast(user_id as string), 6, '0') as tower, day,
  concat('REGION ', cast(user_id % 5 as string)) as region,
  concat('SITE ', cast(user_id % 50 as string)) as site,
  case when switched then 0e0 else bearer_drop_rate end as old_bearer_drop_rate,
  case when switched then 0e0 else rrc_setup_failure end as old_rrc_setup_failure,
  case when switched then 0e0 else avgconnected_users end as old_avgconnected_users,
  case when switched then 0e0 else dl_data_volume end as old_dl_data_volume,
  case when switched then 0e0 else uptp end as old_uptp_user_perceived_throughput,
  case when switched then bearer_drop_rate else 0e0 end as new_bearer_drop_rate,
  case when switched then rrc_setup_failure else 0e0 end as new_rrc_setup_failure,
  case when switched then avgconnected_users else 0e0 end as new_avgconnected_users,
  case when switched and user_id % 3 = 0 then dl_data_volume * 1e-1
       when switched then dl_data_volume else 0e0 end as new_dl_data_volume,
  case when switched then uptp else 0e0 end as new_uptp_user_perceived_throughput,
  cast(n_error as double) as sip_dc_rate,
  cast(n as double) as rtp_gap
from p
"""
# every user on every day that has events; the list of days is one short array, so Spark needs no join for it
GRID = {
    "spark": "select user_id, explode((select array_agg(distinct cast(ts as date)) from events)) as day from u",
    "duckdb": "select user_id, day from u cross join (select distinct cast(ts as date) as day from events)",
}

_PARTS = ("rrc_setup_failure", "bearer_drop_rate", "avgconnected_users", "dl_data_volume", "uptp_user_perceived_throughput")


def _finer(ids: str, factor: str) -> str:
    measures = ", ".join(f"{side}_{k} * {factor} as {side}_{k}" for side in ("old", "new") for k in _PARTS)
    return f"""
select tower, {ids}, day, region, site, {measures}, sip_dc_rate * {factor} as sip_dc_rate, rtp_gap * {factor} as rtp_gap
from entities"""


# three sectors per tower, of which '0' is the placeholder; sector 2 loses three quarters of everything on switching
SECTOR_PANEL = """
with kpi_panel as ({kpi_panel}),
entities as (select *, {sectors} as sector from kpi_panel)
""" + _finer("sector", "(case when sector = '2' and new_avgconnected_users > 0 then 25e-2 else 1e0 end)")

CARRIER_PANEL = """
with kpi_panel as ({kpi_panel}),
sectors as (select *, {sectors} as sector from kpi_panel),
entities as (select *, {carriers} as carrier from sectors)
""" + _finer("sector, carrier", "(case when carrier = '2' and new_avgconnected_users > 0 then 5e-1 else 1e0 end)")

KPI_RAW = """
select case when event_id % 97 = 0 then '*' when event_id % 89 = 0 then null
            else cast(user_id as string) end as tower,
  concat(lpad(cast(month(ts) as string), 2, '0'), '/', lpad(cast(day(ts) as string), 2, '0'), '/',
         cast(year(ts) as string)) as day,
  site, event_type as market,
  case when event_id % 101 = 0 then 'n/a' else cast(cast(floor(value) as int) as string) end as kpi
from (select *, {sites} as site from events)
where site = 'NEW YORK CITY' or event_id % 2 = 0
"""

TOWER_COORDS = """
select distinct lpad(cast(user_id as string), 6, '0') as tower,
  30e0 + (user_id % 12) * 5e-2 as latitude, -97e0 + (user_id % 7) * 5e-2 as longitude
from events
"""

SECTOR_AZIMUTH = """
select tower, cast(sector as string) as sector, cast(carrier as string) as carrier,
  (user_id * 7 + sector * 120 + carrier) % 360 as azimuth_deg
from (select *, {two} as carrier from (
  select *, {two} as sector from (
    select distinct user_id, lpad(cast(user_id as string), 6, '0') as tower from events)))
"""

TICKETS = """
select cast(floor(o_orderkey / 3) as bigint) as trouble_id,
  case when o_orderstatus = 'F' then 'Closed' else 'Open' end as status,
  date '2024-01-10' + cast(o_orderkey % 20 as int) as create_date,
  date '2024-01-10' + cast(o_orderkey % 20 + o_custkey % 5 as int) as modified_date,
  30e0 + (o_custkey % 120) * 5e-3 as lat, -97e0 + (o_custkey % 70) * 5e-3 as lng,
  o_orderpriority as problem_type, case when o_custkey % 4 = 0 then 'NRB' else 'OTHER' end as assigned_group
from orders
"""

WORK_ORDERS = """
select cast(floor(o_orderkey / 2) as bigint) as noc_id,
  case when o_orderstatus = 'F' then 'closed' else 'OPEN' end as status,
  concat(cast(date '2024-01-10' + cast(o_orderkey % 20 as int) as string), ' 06:30:00') as event_start,
  concat(cast(date '2024-01-10' + cast(o_orderkey % 20 + o_custkey % 3 as int) as string), ' 18:00:00') as event_end,
  case when o_orderkey % 7 = 0 then lpad(cast(o_custkey % 150 as string), 6, '0')
       else concat(lpad(cast(o_custkey % 150 as string), 6, '0'),
                   lpad(cast(o_orderkey % 40 as string), 4, '0')) end as cell_id,
  30e0 + (o_custkey % 120) * 5e-3 as lat, -97e0 + (o_custkey % 70) * 5e-3 as lng,
  date '2024-01-10' + cast(o_orderkey % 20 as int) as data_date
from orders
"""

CALL_FAILURES = """
select concat(cast(8000 + event_id % 50 as string), '-cause') as cause_code,
  concat(lpad(cast(user_id as string), 6, '0'), '_', cast(event_id % 3 as string)) as enodeb,
  concat('1', lpad(cast(event_id as string), 10, '0')) as msisdn,
  concat('tel:+1', lpad(cast(event_id as string), 10, '0')) as from_uri,
  cast(ts as date) as day
from events
"""

PARTITION_DAYS = """
select distinct cast(ts as date) as day, event_type as table_name
from events
where (day(ts) + length(event_type)) % 6 <> 0
"""

# three inventory snapshots, each shifting the towers a little further north
SNAPSHOTS = """
select tower, latitude + n * 1e-3 as latitude, longitude, date '2024-01-06' + n * 4 as date
from (select *, {three} as n from ({tower_coords}))
"""

TEXTS = {
    "kpi_panel": KPI_PANEL,
    "sector_panel": SECTOR_PANEL,
    "carrier_panel": CARRIER_PANEL,
    "kpi_raw": KPI_RAW,
    "tower_coords": TOWER_COORDS,
    "sector_azimuth": SECTOR_AZIMUTH,
    "tickets": TICKETS,
    "work_orders": WORK_ORDERS,
    "call_failures": CALL_FAILURES,
    "partition_days": PARTITION_DAYS,
    "snapshots": SNAPSHOTS,
}


def _rows(values: tuple, engine: str) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"explode(array({listed}))" if engine == "spark" else f"unnest([{listed}])"


def sql(name: str, engine: str) -> str:
    """The text of a derived table for ``spark`` or ``duckdb``."""
    return (
        TEXTS[name]
        .replace("{kpi_panel}", KPI_PANEL)
        .replace("{tower_coords}", TOWER_COORDS)
        .replace("{grid}", GRID[engine])
        .replace("{sectors}", _rows(("0", "1", "2"), engine))
        .replace("{carriers}", _rows(("1", "2"), engine))
        .replace("{sites}", _rows(("NEW YORK CITY", "NEW YORK C"), engine))
        .replace("{two}", _rows((1, 2), engine))
        .replace("{three}", _rows((1, 2, 3), engine))
        .strip()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame."""
    text = sql(name, "spark")
    for source in TABLES:
        text = text.replace(f"from {source}", f"from parquet.`{sf_dir}/{source}.parquet`")
    return spark.sql(text)
