"""Independent SQL for the named queries, in the dialect of the checking database."""

from __future__ import annotations

import re

from citylake.schemas import AQ_METRICS, PARAMETERS


def _exact(expr: str, where: str = "") -> str:
    """Sum of doubles as 128-bit integers: multiplied by a power of two, which loses nothing, they are whole."""
    one = "1152921504606846976"
    total = f"sum(cast(({expr}) * {one}.0::double as hugeint)){where}"
    return f"(cast({total} // {one}::hugeint as double) + cast({total} % {one}::hugeint as double) / {one}.0::double)"


def _mean(expr: str, where: str = "") -> str:
    return f"({_exact(expr, where)} / count({expr}){where})"


RAW = """
raw as (
  select o_custkey as VendorID,
         case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type,
         o_orderdate as pickup_datetime, l_shipdate as dropoff_datetime,
         l_suppkey as pickup_location_id, l_partkey as dropoff_location_id,
         cast(l_linenumber - 1 as integer) as passenger_count,
         l_quantity as trip_distance, l_extendedprice as fare_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) as total_amount,
         case when l_linestatus = 'F' then l_extendedprice * l_tax end as tip_amount,
         cast(case l_returnflag when 'R' then 1 when 'A' then 2 else 3 end as integer) as payment_type,
         cast(case when l_linestatus = 'F' then 2 else 1 end as integer) as trip_type,
         cast(l_linenumber as integer) as RatecodeID
  from lineitem join orders on l_orderkey = o_orderkey)"""

TRIPS = (
    RAW
    + """,
trips as (
  select *, (epoch(dropoff_datetime)::bigint - epoch(pickup_datetime)::bigint) / 60.0::double
            as trip_duration_minutes
  from raw
  where trip_distance > 0 and total_amount > 0 and pickup_datetime < dropoff_datetime)"""
)

FACT = (
    TRIPS
    + f""",
fact as (
  select cast(pickup_datetime as date) as pickup_date, pickup_location_id, taxi_type,
         count(*) as total_trips, {_exact('total_amount')} as daily_revenue_usd,
         {_mean('trip_distance')} as avg_trip_distance, {_mean('tip_amount')} as avg_tip_amount
  from trips group by all)"""
)

FILLED_EVENTS = """
      select user_id, ts, event_id,
             last_value(case when event_type <> 'purchase' then value end ignore nulls) over (
               partition by user_id order by ts, event_id rows between unbounded preceding and current row) as value
      from events"""

DATES = """
dates as (
  select cast(d as date) as date_key, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
         monthname(d) as month_name, dayname(d) as day_name,
         cast(case when dayofweek(d) in (0, 6) then 1 else 0 end as integer) as is_weekend
  from generate_series(timestamp '1995-01-01', timestamp '2001-06-30', interval 1 day) as g(d))"""

ZONES = """
zones as (
  select s_suppkey as location_id, r_name as borough, s_name as zone_name, n_name as service_zone
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

MODEL = FACT + "," + DATES + "," + ZONES

# The daily fact with the attributes of its day and zone.
STAR = (
    MODEL
    + """,
star as (
  select fact.*, dates.*, zones.*
  from fact left join dates on pickup_date = date_key left join zones on pickup_location_id = location_id)"""
)

_REVENUE = _exact("daily_revenue_usd")
_TRIPS = "cast(sum(total_trips) as bigint)"
_FARE = f"{_REVENUE} / nullif({_TRIPS}, 0)"


def _star(*attributes: str, where: str = "") -> str:
    """The daily fact by attributes of days and zones, summed to days' attributes and zones before the zones join."""
    of_zone = [a for a in attributes if a in ("borough", "zone_name")]
    keys = [a for a in attributes if a not in of_zone] + (["pickup_location_id"] if of_zone else ["pickup_date"])
    days = "left join dates on pickup_date = date_key" if where or len(keys) > 1 else ""
    return MODEL + f""",
reduced as (
  select {', '.join(keys)}, {_TRIPS} as total_trips, {_REVENUE} as daily_revenue_usd
  from fact {days} {where} group by {', '.join(keys)}),
star as (select * from reduced {'left join zones on pickup_location_id = location_id' if of_zone else ''})"""


FX_ROWS = f"""
fx_rows as (
  select cast(o_orderdate as date) as fx_date, o_orderpriority as CURRENCY,
         case when dayofweek(o_orderdate) not in (0, 6)
              then {_exact('o_totalprice')} / count(*) / 1e5 end as rate
  from orders group by cast(o_orderdate as date), o_orderpriority, dayofweek(o_orderdate))"""

FX = (
    FX_ROWS
    + """,
fx as (
  select fx_date, CURRENCY,
         last_value(rate ignore nulls) over (partition by CURRENCY order by fx_date
           rows between unbounded preceding and current row) as exchange_rate_to_eur
  from fx_rows)"""
)

READINGS = """
readings as (
  select ts, user_id * 10 + case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2
           when 'signup' then 3 else 4 end as sensor_id,
         'loc-' || user_id as location_name,
         case event_type when 'click' then 'pm25' when 'error' then 'no2' when 'purchase' then 'o3'
           when 'signup' then 'temperature' else 'co' end as parameter,
         40.4::double + (user_id % 100) * 0.01::double as lat,
         -74.3::double + (user_id % 80) * 0.01::double as lon,
         value, 'ug/m3' as unit, strftime(ts - interval 25 year, '%Y-%m-%dT%H:%M:%SZ') as date_utc,
         cast(ts - interval 25 year as date) as reading_date
  from events)"""

_CELLS = ", ".join(_mean("value", f" filter (parameter = '{p}')") + f" as {p}" for p in PARAMETERS)
WIDE = READINGS + f""",
wide as (select location_name, reading_date, lat, lon, {_CELLS} from readings group by all)"""

_RENAMED = ", ".join(f"{s} as {n}" for s, n in AQ_METRICS.items())
AQ = WIDE + f""",
aq as (
  select reading_date, location_name, lat, lon, {_RENAMED} from wide
  where pm25 is not null or no2 is not null or o3 is not null)"""

GDP = f"""
gdp as (
  select n_name as country_name, 'N' || lpad(cast(n_nationkey as varchar), 2, '0') as countryiso3code,
         'GDP (current US$)' as indicator_name, cast(y as integer) as gdp_year,
         {_exact('spent')} as gdp_value, cast(null as varchar) as obs_status
  from (select o_custkey, year(o_orderdate) as y, {_exact('o_totalprice')} as spent from orders group by all)
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  group by n_name, n_nationkey, y)"""

WEATHER = """
weather as (
  select event_id as doc_id, make_timestamp((epoch(date_trunc('second', ts))::bigint + 3600 * h) * 1000000) as forecast_time,
         epoch(date_trunc('second', ts))::bigint + 3600 * h as dt,
         value + h as temperature, value - h as feels_like,
         cast(props->>'k' as bigint) as humidity, cast(props->>'k' as bigint) + 1000 as pressure,
         case when event_type <> 'error' then event_type end as condition, value / 2 as wind_speed
  from events cross join (values (0), (3)) as steps(h)
  where event_type <> 'signup')"""

SLOTS = """
found as (
  select l_returnflag as taxi_type, cast(date_trunc('month', l_shipdate) as date) as first_day,
         bool_or(l_linestatus = 'F') as has_yellow
  from lineitem group by all),
slots as (
  select taxi_type, cast(year(first_day) as varchar) as year, lpad(cast(month(first_day) as varchar), 2, '0') as month,
         has_yellow and month(first_day) not in (7, 11) as landed, month(first_day) <> 11 as available
  from found),
wanted as (
  select t.taxi_type, cast(year(m) as varchar) as year, lpad(cast(month(m) as varchar), 2, '0') as month
  from (select distinct taxi_type from found) t,
       (select unnest(generate_series(min(first_day)::timestamp, max(first_day)::timestamp, interval 1 month)) as m
        from found))"""


def _expanded(sql: str) -> str:
    """``xsum`` and ``xavg`` of a column, with an optional filter, written out as exact sums."""
    call = re.compile(r"\bx(sum|avg)\(([\w.]+)\)( filter \([^()]*\))?")
    return call.sub(lambda m: (_exact if m[1] == "sum" else _mean)(m[2], m[3] or ""), sql)


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _latest(cols: tuple[str, ...], source: str, by: str = "") -> str:
    """Latest time per group, and each column's value there when it is the only one."""
    same = f"using ({by})" if by else "on true"
    picked = ", ".join(
        f"case when count(distinct {c}) + max(case when {c} is null then 1 else 0 end) = 1 then max({c}) end as latest_{c}"
        for c in cols
    )
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""select {lead}max(t) as latest_time, {picked}
      from {source} join (select {lead}max(forecast_time) as t from {source} {group}) as newest {same}
      where forecast_time = t {group}"""


def _rates(by: str = "", where: str = "") -> str:
    lead, group = (f"{by}, ", f"group by {by}") if by else ("", "")
    return f"""rates as (
      select {lead}{_mean('exchange_rate_to_eur')} as average_rate
      from fx left join dates on fx_date = date_key {where} {group})"""


ORACLES: dict[str, str] = {
    "silver_trips": _with(TRIPS)
    + """ select VendorID, taxi_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
      passenger_count, trip_distance, fare_amount, total_amount, tip_amount, payment_type, trip_type, RatecodeID,
      trip_duration_minutes from trips""",
    "trip_duration": """
      select o_custkey as VendorID, o_orderdate as pickup_datetime, l_shipdate as dropoff_datetime,
             date_diff('second', o_orderdate, l_shipdate) / 60.0::double as trip_duration_minutes
      from lineitem join orders on l_orderkey = o_orderkey where o_orderdate < l_shipdate""",
    "union_missing_cols": """
      select l_orderkey as VendorID, l_quantity as trip_distance, l_suppkey as PULocationID,
             l_extendedprice as fare_amount, l_shipdate as tpep_dropoff_datetime,
             cast(l_linenumber - 1 as double) as passenger_count, l_discount as airport_fee,
             'yellow' as taxi_type, cast(null as timestamp) as lpep_dropoff_datetime, cast(null as double) as ehail_fee
      from lineitem where l_linestatus = 'F'
      union all
      select l_orderkey, l_quantity, l_suppkey, l_extendedprice, null, cast(l_linenumber - 1 as double), null,
             'green', l_shipdate, l_tax
      from lineitem where l_linestatus <> 'F'""",
    "zone_dedup": """
      select l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
      qualify row_number() over (partition by l_suppkey
        order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) = 1""",
    "gdp_flatten": _with(GDP) + " select * from gdp",
    "json_explode": _with(WEATHER)
    + """ select doc_id, dt, temperature, condition from weather
      union all select event_id, null, null, null from events where event_type = 'signup'""",
    "sensor_flatten_join": _with(READINGS)
    + " select sensor_id, location_name, parameter, lat, lon, value, unit, date_utc from readings",
    "bbox_recent": _with(READINGS)
    + """ select sensor_id, location_name, parameter, lat, lon, value, unit, date_utc from readings
      where ts >= timestamp '2024-01-16' and lon between -74.259 and -73.700 and lat between 40.477 and 40.917""",
    "fx_ffill": _with(FX) + " select fx_date, CURRENCY, exchange_rate_to_eur from fx",
    "fx_ffill_bucketed": FILLED_EVENTS,
    "fx_ffill_by_period": FILLED_EVENTS,
    "incremental_fill": FILLED_EVENTS,
    "aq_pivot": _with(WIDE) + f" select location_name, reading_date, lat, lon, {', '.join(PARAMETERS)} from wide",
    "aq_pivot_by_sensor": _with(READINGS)
    + """ select sensor_id, unit, xavg(value) filter (parameter = 'pm25') as pm25,
      xavg(value) filter (parameter = 'no2') as no2,
      xavg(value) filter (parameter = 'pm10') as pm10 from readings group by all""",
    "aq_daily": _with(AQ)
    + f" select reading_date, location_name, lat, lon, {', '.join(AQ_METRICS.values())} from aq",
    "trip_daily": _with(FACT)
    + """ select pickup_date, pickup_location_id, taxi_type, total_trips, daily_revenue_usd,
      avg_trip_distance, avg_tip_amount from fact""",
    "trip_daily_no_tip": _with(FACT)
    + """ select pickup_date, pickup_location_id, taxi_type, total_trips, daily_revenue_usd,
      avg_trip_distance, 0.0::double as avg_tip_amount from fact""",
    "trip_daily_by_zone": _with(FACT)
    + f""" select pickup_date, pickup_location_id as pickup_zone_id, cast(sum(total_trips) as bigint) as total_trips,
      {_exact('daily_revenue_usd')} as daily_revenue_usd,
      {_exact('avg_trip_distance * total_trips')} / cast(sum(total_trips) as bigint) as avg_trip_distance
      from fact group by pickup_date, pickup_location_id""",
    "dim_date": """
      select cast(d as date) as date_key, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
             monthname(d) as month_name, dayname(d) as day_name,
             cast(case when dayofweek(d) in (0, 6) then 1 else 0 end as integer) as is_weekend
      from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)""",
    "dim_zone": _with(ZONES) + " select location_id, borough, zone_name, service_zone from zones",
    "dim_gdp": _with(GDP) + " select * from gdp",
    "weather_table": _with(WEATHER)
    + """ select forecast_time, temperature, feels_like, humidity, pressure, condition, wind_speed from weather""",
    "manifest": _with(SLOTS) + " select * from wanted",
    "pending_slots": _with(SLOTS)
    + """ select * from wanted w
      where not exists (from slots s where s.landed and (s.taxi_type, s.year, s.month) = (w.taxi_type, w.year, w.month))
        and exists (from slots s where s.available and (s.taxi_type, s.year, s.month) = (w.taxi_type, w.year, w.month))""",
    "load_summary": _with(SLOTS)
    + """ select case when s.landed then 'skipped' when s.available and s.taxi_type = 'A' then 'failed'
        when s.available then 'loaded' else 'missing' end as status, count(*) as n
      from wanted w left join slots s using (taxi_type, year, month) group by 1""",
    "incremental_ingest": """
      select l_returnflag as taxi_type, cast(year(l_shipdate) as integer) as year,
             cast(month(l_shipdate) as integer) as month, count(*) as n, sum(l_quantity) as quantity
      from lineitem group by all""",
    "dq_counts": _with(TRIPS, WIDE, FX)
    + """, counted as (
        select 'bad_trips' as rule, count(*) as total,
               cast(count_if(passenger_count <= 0 or trip_distance <= 0) as bigint) as failed from trips
        union all select 'impossible_pm25', count(*), cast(count_if(pm25 < 0 or pm25 > 500) as bigint) from wide
        union all select 'fx_nulls', count(*), cast(count_if(exchange_rate_to_eur is null) as bigint) from fx)
      select *, cast(failed as double) / nullif(total, 0) as failure_rate from counted""",
    "dq_suite": _with(WEATHER)
    + """, counted as (
        select 'temperature between -50 and 60' as rule, count(*) as checked,
               cast(count_if(temperature not between -50 and 60) as bigint) as failed from weather
        union all select 'humidity not null', count(*), cast(count_if(humidity is null) as bigint) from weather
        union all select 'forecast_time not null', count(*), cast(count_if(forecast_time is null) as bigint) from weather)
      select *, failed = 0 as passed from counted""",
    "dq_suite_status": _with(WEATHER)
    + """, passed as (
        select unnest([bool_and(temperature between -50 and 60), bool_and(humidity is not null),
                       bool_and(forecast_time is not null)]) as ok from weather)
      select case when bool_and(ok) then 'Success' else 'Failure' end as status, count(*) as total_checks,
             count_if(ok) / count(*) * 100.0::double as success_percent from passed""",
    "quarantine": _with(RAW)
    + """ select VendorID, pickup_location_id as PULocationID, fare_amount,
      concat_ws(',', case when passenger_count <= 0 then 'no passengers' end,
                     case when trip_distance <= 0 then 'no distance' end,
                     case when tip_amount <= 0 then 'no tip' end) as reasons from raw""",
    "avg_fare_by_month": _with(_star("year", "month")) + f" select year, month, {_FARE} as avg_fare from star group by year, month",
    "avg_fare_totals": _with(_star("year", "month"))
    + f""" select year, month, cast(2 - grouping(year) - grouping(month) as integer) as level, {_FARE} as avg_fare
      from star group by rollup(year, month)""",
    "revenue_eur_totals": _with(_star("borough", "year"), FX, f"""rates as (
        select year, cast(1 - grouping(year) as integer) as rate_level, {_mean('exchange_rate_to_eur')} as average_rate
        from fx left join dates on fx_date = date_key group by rollup(year))""")
    + f""" select borough, s.year, level, revenue * average_rate as revenue_eur from (
        select borough, year, cast(2 - grouping(borough) - grouping(year) as integer) as level, {_REVENUE} as revenue
        from star group by rollup(borough, year)) s
      left join rates r on s.year is not distinct from r.year and rate_level = case when level = 2 then 1 else 0 end""",
    "incremental_gold": _with(FACT)
    + """ select pickup_date, pickup_location_id, taxi_type, total_trips, daily_revenue_usd, avg_trip_distance, avg_tip_amount,
      strftime(pickup_date, '%Y-%m') as pickup_month from fact""",
    "avg_fare_of_a_year": _with(f"""{MODEL},
      by_zone as (
        select pickup_date, pickup_location_id, {_TRIPS} as total_trips, {_REVENUE} as daily_revenue_usd from fact group by all),
      reduced as (select pickup_date, {_TRIPS} as total_trips, {_REVENUE} as daily_revenue_usd from by_zone group by all)""")
    + f""" select year, month, {_FARE} as avg_fare from reduced join dates on pickup_date = date_key where year = 1996
      group by year, month""",
    "avg_fare_by_borough": _with(_star("borough")) + f" select borough, {_FARE} as avg_fare from star group by borough",
    "avg_fare_by_zone_month": _with(_star("zone_name", "year", "month"))
    + f" select zone_name, year, month, {_FARE} as avg_fare from star group by zone_name, year, month",
    "avg_fare_weekends": _with(_star("borough", where="where is_weekend = 1 and year in (1996, 1997)"))
    + f""" select borough, {_FARE} as avg_fare from star group by borough""",
    "revenue_eur_by_month": _with(_star("year", "month"), FX, _rates("year, month"))
    + f""" select s.year, s.month, revenue * average_rate as revenue_eur
      from (select year, month, {_REVENUE} as revenue from star group by year, month) s
      left join rates r on s.year is not distinct from r.year and s.month is not distinct from r.month""",
    "revenue_eur_by_borough": _with(_star("borough"), FX, _rates())
    + f""" select borough, revenue * average_rate as revenue_eur
      from (select borough, {_REVENUE} as revenue from star group by borough), rates""",
    "revenue_eur_total": _with(STAR, FX, _rates())
    + f""" select revenue / average_rate as revenue_eur
      from (select {_REVENUE} as revenue from star), rates""",
    "revenue_eur_filtered": _with(_star("year", "borough", where="where day_name = 'Monday'"), FX, _rates("year", "where day_name = 'Monday'"))
    + f""" select s.year, borough, revenue * average_rate as revenue_eur
      from (select year, borough, {_REVENUE} as revenue from star group by year, borough) s
      left join rates r on s.year is not distinct from r.year""",
    "latest_values": _with(WEATHER)
    + """, steps as (
        select cast(forecast_time as date) as day, date_trunc('minute', forecast_time) as forecast_time,
               temperature, humidity, condition from weather) """
    + _latest(("temperature", "humidity", "condition"), "steps", "day"),
    "forecast_cards": _with(WEATHER) + " " + _latest(("temperature", "humidity", "condition"), "weather"),
    "forecast_series": _with(WEATHER)
    + """ select forecast_time, xsum(temperature) as temperature, xsum(feels_like) as feels_like,
      cast(sum(pressure) as bigint) as pressure from weather group by forecast_time""",
    "default_summary": _with(AQ)
    + " select location_name, "
    + ", ".join(f"xsum({c}) as {c}" for c in ["lat", "lon", *AQ_METRICS.values()])
    + " from aq group by location_name",
    "trip_volume": _with(_star("year", "month"))
    + f""" select year, month, cast(sum(total_trips) as bigint) as total_trips, {_REVENUE} as daily_revenue_usd
      from star group by year, month""",
    "busiest_zones": _with(STAR)
    + """ select pickup_location_id as pickup_zone_id, zone_name, borough,
      cast(sum(total_trips) as bigint) as total_trips
      from star group by all order by total_trips desc, pickup_zone_id limit 10""",
    "aq_hotspots": _with(AQ)
    + """ select location_name, xavg(avg_pm25) as avg_pm25, count(avg_pm25) as days from aq
      group by location_name having xavg(avg_pm25) is not null
      order by xavg(aq.avg_pm25) desc, location_name limit 10""",
    "aq_trend": _with(AQ, DATES)
    + """ select year, month, location_name, xavg(avg_pm25) as avg_pm25, xavg(avg_no2) as avg_no2,
      xavg(avg_o3) as avg_o3
      from aq left join dates on reading_date = date_key group by year, month, location_name""",
    "overlay": _with(FACT, AQ)
    + f""" select coalesce(pickup_date, reading_date) as day, total_trips, revenue_usd, avg_pm25
      from (select pickup_date, cast(sum(total_trips) as bigint) as total_trips, {_REVENUE} as revenue_usd
            from fact group by pickup_date) t
      full join (select reading_date, xavg(avg_pm25) as avg_pm25 from aq group by reading_date) a
        on pickup_date = reading_date""",
    "overlay_corr": _with(FACT, AQ)
    + """ select count(*) as days, round(corr(total_trips, avg_pm25), 9) as corr_trips_pm25
      from (select pickup_date, sum(total_trips) as total_trips from fact group by pickup_date) t
      join (select reading_date, xavg(avg_pm25) as avg_pm25 from aq group by reading_date) a
        on pickup_date = reading_date where avg_pm25 is not null""",
    "revenue_usd_eur": _with(_star("year", "month"), FX, _rates("year, month"))
    + f""" select s.year, s.month, revenue as revenue_usd, average_rate as average_rate,
        revenue * average_rate as revenue_eur, revenue / average_rate as revenue_eur_divided
      from (select year, month, {_REVENUE} as revenue from star group by year, month) s
      left join rates r on s.year is not distinct from r.year and s.month is not distinct from r.month""",
    "mobility_gdp": _with(FACT, GDP)
    + """, growing as (
        select *, lag(gdp_value) over (partition by country_name order by gdp_year) as before from gdp)
      select t.year, country_name, total_trips, gdp_value, (gdp_value - before) / before as gdp_growth
      from (select cast(year(pickup_date) as integer) as year, cast(sum(total_trips) as bigint) as total_trips
            from fact group by 1) t
      left join growing on t.year = gdp_year""",
    "daily_summary": _with(TRIPS, AQ)
    + """, days as (
        select cast(pickup_datetime as date) as day, count(*) as total_trips,
               cast(count_if(passenger_count <= 0 or trip_distance <= 0) as bigint) as bad_trips
        from trips group by 1),
      air as (select reading_date, xavg(avg_pm25) as avg_pm25 from aq group by reading_date)
      select day, total_trips, bad_trips, cast(bad_trips as double) / total_trips as failure_rate,
             case when cast(bad_trips as double) / total_trips > 0.15 then 'Failure' else 'Success' end as quality,
             avg_pm25
      from days left join air on day = reading_date""",
    "export_top_n": _with(WEATHER)
    + """ select forecast_time, temperature, feels_like, humidity, pressure, condition, wind_speed from weather
      order by forecast_time, temperature, condition nulls first, humidity limit 5""",
    "weather_documents": _with(WEATHER)
    + """ select condition, xsum(temperature) as temperature, xsum(feels_like) as feels_like,
      cast(sum(humidity) as bigint) as humidity, cast(sum(pressure) as bigint) as pressure,
      xsum(wind_speed) as wind_speed from weather group by condition""",
    "zone_csv": _with(ZONES) + " select location_id, borough, zone_name, service_zone from zones",
    "fx_csv": _with(FX_ROWS) + " select strftime(fx_date, '%Y-%m-%d') as TIME_PERIOD, CURRENCY, rate as OBS_VALUE from fx_rows",
    "forecast_json": _with(WEATHER) + " select dt, temperature, condition from weather",
    "broken_documents": """
      with docs as (
        select event_id // 100 as part, 2 * count_if(event_type <> 'signup') as steps from events group by 1)
      select part, case part % 4 when 1 then 'not JSON' when 2 then 'no list' when 3 then 'a value of another type' end as reason,
             cast(case part % 4 when 0 then steps when 3 then steps + 1 end as bigint) as steps
      from docs where steps > 0""",
    "gdp_file": _with(GDP) + " select countryiso3code, cast(gdp_year as varchar) as date, gdp_value as value from gdp",
    "append_new_column": """
      select l_orderkey, l_quantity, case when l_linestatus <> 'F' then l_tax end as l_tax from lineitem""",
    "replace_table": "select o_orderkey, o_totalprice as price from orders",
    "enforce_table": _with(ZONES)
    + """ select location_id::integer as location_id, borough, zone_name, service_zone,
      'missing columns [], unexpected columns [''extra'']' as refused from zones""",
    "report_file": _with(WEATHER)
    + """, passed as (
        select unnest([bool_and(temperature between -50 and 60), bool_and(humidity is not null),
                       bool_and(forecast_time is not null)]) as ok from weather)
      select case when bool_and(ok) then 'Success' else 'Failure' end as status, count(*) as total_checks,
             count_if(ok) / count(*) * 100.0::double as success_percent, '2024-02-01 00:00:00' as timestamp from passed""",
    "export_file": _with(WEATHER)
    + """ select forecast_time, temperature, feels_like, humidity, pressure, condition, wind_speed from weather
      order by forecast_time, temperature, condition nulls first, humidity limit 5""",
    "landed_files": """
      select distinct l_returnflag as taxi_type, '1998' as year,
             case l_returnflag when 'A' then '01' when 'N' then '02' else '03' end as month from lineitem""",
    "slot_ingest": """
      select l_returnflag as taxi_type, 1998::integer as year,
             cast(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as integer) as month,
             count(*) as n, sum(l_quantity) as quantity from lineitem group by 1, 3""",
    "drifting_ingest": """
      select case l_returnflag when 'A' then '01' when 'N' then '02' else '03' end as month,
             case l_returnflag when 'A' then l_linenumber::varchar when 'N' then l_quantity::varchar
                  else 'x' || l_linestatus end as surcharge,
             count(*) as n, sum(l_linenumber::double) as passengers from lineitem group by 1, 2""",
    "republished_ingest": """
      with published as (
        select '01' as month, l_linenumber from lineitem where l_returnflag = 'A' and l_quantity > 25
        union all select '02', l_linenumber from lineitem where l_returnflag = 'N'
        union all select '02', l_linenumber from lineitem where l_returnflag = 'N' and l_quantity < 5
        union all select '03', l_linenumber from lineitem where l_returnflag = 'R')
      select month, count(*) as n, sum(l_linenumber::double) as passengers, month = '03' as failed from published group by 1""",
    "counted_writes": _with(TRIPS)
    + """, kept as (
        select * from trips where year(pickup_datetime) <> 1996 or month(pickup_datetime) = 1 or trip_distance < 25)
      select 'bad_trips' as rule, count(*) as total, cast(count_if(passenger_count <= 0 or trip_distance <= 0) as bigint) as failed,
             count_if(passenger_count <= 0 or trip_distance <= 0)::double / count(*) as failure_rate from kept""",
    "manifest_as_of": """
      with wanted as (
        select t.taxi_type, strftime(m, '%Y') as year, strftime(m, '%m') as month
        from (values ('A'), ('N'), ('R')) as t(taxi_type),
             generate_series(timestamp '1996-01-01', timestamp '1997-05-01', interval 1 month) as g(m))
      select w.*, n from wanted w left join (
        select l_returnflag as taxi_type, strftime(l_shipdate, '%Y') as year, strftime(l_shipdate, '%m') as month, count(*) as n
        from lineitem group by all) using (taxi_type, year, month)""",
    "slot_paths": _with(SLOTS) + " select taxi_type || '/' || year || '/' || month as path, landed from slots",
    "audit_columns": """
      select o_orderkey, o_custkey::varchar as o_custkey, o_totalprice, timestamp '2024-02-01' as ingestion_timestamp,
             'orders.parquet' as source_file, 'yellow' as taxi_type from orders""",
    "months_in_order": """
      select month_name, cast(row_number() over (order by m) as integer) as rank
      from (select distinct monthname(o_orderdate) as month_name, month(o_orderdate) as m from orders)""",
    "gate_report": _with(TRIPS, FX)
    + """ select 'bad_trips' as rule, count_if(passenger_count <= 0 or trip_distance <= 0)::double / count(*) as value,
        0.01::double as bound, count_if(passenger_count <= 0 or trip_distance <= 0)::double / count(*) > 0.01 as halted from trips
      union all
      select 'fx_nulls', count_if(exchange_rate_to_eur is null)::double, 0.0::double, count_if(exchange_rate_to_eur is null) > 0 from fx""",
    "report_percent": _with(TRIPS, WIDE, FX)
    + """, counted as (
        select 'bad_trips' as rule, count(*) as total,
               cast(count_if(passenger_count <= 0 or trip_distance <= 0) as bigint) as failed from trips
        union all select 'impossible_pm25', count(*), cast(count_if(pm25 < 0 or pm25 > 500) as bigint) from wide
        union all select 'fx_nulls', count(*), cast(count_if(exchange_rate_to_eur is null) as bigint) from fx)
      select rule, total, failed, printf('%.4f', failed::double / total * 100) || '%' as failure_percent from counted""",
    "configured_regions": _with(ZONES)
    + """ select location_id, borough, zone_name, priority::integer as priority
      from zones join (values ('ASIA', 1), ('EUROPE', 2)) as w(borough, priority) using (borough)""",
    "sensor_history": _with(READINGS)
    + " select sensor_id, location_name, parameter, lat, lon, value, unit, date_utc from readings",
    "zone_changes": _with(ZONES)
    + """ select location_id::integer as location_id, borough, zone_name, service_zone, false as gone, 1::integer as version from zones
      union all
      select location_id::integer, borough, zone_name || case when location_id % 7 = 0 then '' else ' (new)' end, service_zone,
             location_id % 7 = 0, 2::integer
      from zones where location_id % 7 = 0 or location_id % 5 = 0""",
    "latest_measures": "select latest_temperature, latest_humidity, latest_condition from ("
    + _with(WEATHER) + " " + _latest(("temperature", "humidity", "condition"), "weather") + ")",
}

ORACLES = {name: _expanded(sql) for name, sql in ORACLES.items()}
