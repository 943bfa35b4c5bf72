"""Movements and airport traffic."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import (
    CODES, LINE_ORDER, SQL_DOMESTIC, SQL_FLIGHTS, SQL_MOVEMENTS, SQL_SERVED, SQL_TARGET, SQL_TRAFFIC,
    Tables, airport_of, day_text, lineitem_flights, lineitem_movements, order_traffic, query, sql_airport, sql_flagged,
)
from skyloom.functions.times import delay_and_advance, half_day_slot, half_day_slots
from skyloom.operators import congestion as cong
from skyloom.operators import movements as mov
from skyloom.schemas import RECORD_BOARD
from skyloom.session import shared_folder
from skyloom.sources.boards import read_boards


@query(
    "congestion_counts",
    f"""
with movements as (
  select strftime(ts, '%Y-%m-%d') as flight_date,
    case event_type when 'purchase' then 'departure' when 'click' then 'arrival' else event_type end as movement_type,
    {sql_airport('user_id')} as airport_origin, {sql_airport('event_id')} as airport_destination
  from events)
select flight_date, case movement_type when 'departure' then airport_origin else airport_destination end as airport,
  cast(count(*) filter (where movement_type = 'departure') as int) as nombre_departs,
  cast(count(*) filter (where movement_type = 'arrival') as int) as nombre_arrivees
from movements where movement_type in ('departure', 'arrival') group by 1, 2 order by 1, 2""",
)
def congestion_counts(t: Tables) -> DataFrame:
    kind = F.expr("case event_type when 'purchase' then 'departure' when 'click' then 'arrival' else event_type end")
    movements = t.events.select(
        day_text("ts").alias("movement_date"),
        kind.alias("movement_type"),
        airport_of(F.col("user_id")).alias("airport_origin"),
        airport_of(F.col("event_id")).alias("airport_destination"),
    )
    return cong.counts(movements).orderBy("flight_date", "airport")


@query(
    "congestion_scopes",
    f"""
with {SQL_MOVEMENTS},
own as (select *, case movement_type when 'departure' then airport_origin else airport_destination end as airport
  from movements where movement_type in ('departure', 'arrival')),
scoped as (
  select 'cible' as scope, * from own where {SQL_TARGET}
  union all select 'france', * from own where {SQL_DOMESTIC}
  union all select 'ww', * from own where {SQL_SERVED})
select scope, movement_date as flight_date, airport,
  cast(count(*) filter (where movement_type = 'departure') as int) as nombre_departs,
  cast(count(*) filter (where movement_type = 'arrival') as int) as nombre_arrivees
from scoped group by 1, 2, 3""",
)
def congestion_scopes(t: Tables) -> DataFrame:
    return cong.counts_by_scope(lineitem_movements(t))


@query(
    "route_filters",
    f"""
with {SQL_MOVEMENTS}
select airport_origin, airport_destination, {SQL_TARGET} as target, {SQL_DOMESTIC} as domestic, {SQL_SERVED} as served,
  count(*) as n from movements group by all""",
)
def route_filters(t: Tables) -> DataFrame:
    o, d = F.col("airport_origin"), F.col("airport_destination")
    return (
        lineitem_movements(t)
        .groupBy("airport_origin", "airport_destination")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "airport_origin", "airport_destination",
            mov.target_route(o, d).alias("target"),
            mov.domestic_route(o, d).alias("domestic"),
            mov.served_route(o, d).alias("served"),
            "n",
        )
    )


@query(
    "daily_counts",
    f"""
with m as (select strftime(o_orderdate, '%Y-%m-%d') as flight_date, {sql_airport('o_custkey')} as airport, o_orderstatus as s
  from orders where o_orderstatus in ('O', 'F'))
select flight_date, airport, cast(count(*) filter (where s = 'O') as int) as nombre_departs,
  cast(count(*) filter (where s = 'F') as int) as nombre_arrivees, cast(count(*) as int) as somme_depart_arrivee
from m group by 1, 2""",
)
def daily_counts(t: Tables) -> DataFrame:
    airport = airport_of(F.col("o_custkey"))
    return cong.daily_counts(
        t.orders.select(
            day_text("o_orderdate").alias("movement_date"),
            F.expr("case o_orderstatus when 'O' then 'departure' when 'F' then 'arrival' end").alias("movement_type"),
            airport.alias("airport_origin"),
            airport.alias("airport_destination"),
        )
    )


@query(
    "congestion_flag",
    f"""
with {SQL_TRAFFIC}, {sql_flagged('traffic')}
select flight_date, airport, nombre_departs, nombre_arrivees, somme_depart_arrivee, pourcentage_ecart_moyenne, congestion
from flagged""",
)
def congestion_flag(t: Tables) -> DataFrame:
    return cong.flagged(order_traffic(t))


@query(
    "congestion_trim",
    f"""
with {SQL_TRAFFIC},
trimmed as (
  select flight_date, airport, nombre_departs, nombre_arrivees from (
    select *, row_number() over (order by flight_date, airport) as up,
      row_number() over (order by flight_date desc, airport desc) as down from traffic) where up > 3 and down > 1),
{sql_flagged('trimmed')}
select flight_date, airport, nombre_departs, nombre_arrivees, somme_depart_arrivee, pourcentage_ecart_moyenne, congestion
from flagged""",
)
def congestion_trim(t: Tables) -> DataFrame:
    return cong.flagged(cong.trim_ends(order_traffic(t), ["flight_date", "airport"]))


@query(
    "congestion_lookup",
    f"""
with {SQL_TRAFFIC}, {sql_flagged('traffic')}, {SQL_FLIGHTS}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, f.flight_date, airport_origin, airport_destination,
  s.nombre_departs as nombre_departs_source, s.nombre_arrivees as nombre_arrivees_source,
  s.somme_depart_arrivee as somme_depart_arrivee_source, s.congestion as congestion_source,
  d.nombre_departs as nombre_departs_destination, d.nombre_arrivees as nombre_arrivees_destination,
  d.somme_depart_arrivee as somme_depart_arrivee_destination, d.congestion as congestion_destination
from flights f left join flagged s on s.flight_date = f.flight_date and s.airport = airport_origin
left join flagged d on d.flight_date = f.flight_date and d.airport = airport_destination""",
)
def congestion_lookup(t: Tables) -> DataFrame:
    table = cong.lookup_table(cong.flagged(order_traffic(t)))
    flights = lineitem_flights(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flight_date", "airport_origin", "airport_destination"
    )
    return cong.add_congestion(flights, table)


@query(
    "movement_counts",
    f"""
with {SQL_TRAFFIC}, {SQL_FLIGHTS}
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  s.nombre_departs as "NBVols_Depart_Airport_Origin", s.nombre_arrivees as "NBVols_Arrivee_Airport_Origin",
  d.nombre_departs as "NBVols_Depart_Airport_Destination", d.nombre_arrivees as "NBVols_Arrivee_Airport_Destination"
from flights f left join traffic s on s.flight_date = f.flight_date and s.airport = airport_origin
left join traffic d on d.flight_date = f.flight_date and d.airport = airport_destination""",
)
def movement_counts(t: Tables) -> DataFrame:
    out = cong.add_movement_counts(lineitem_flights(t), cong.lookup_table(order_traffic(t)))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[c for c in out.columns if "NBVol" in c])


@query(
    "twelve_hour_slots",
    """
with span as (select date_trunc('day', min(ts)) as a, max(ts) as b from events),
slots as (select s as slot_start, least(s + interval 12 hour, (select b from span)) as slot_end
  from (select unnest(generate_series((select a from span), (select b - interval 1 microsecond from span), interval 12 hour)) as s)),
counted as (select date_trunc('day', ts) + (case when hour(ts) < 12 then 0 else 12 end) * interval 1 hour as slot_start,
  count(*) as n from events group by 1)
select slot_start, slot_end, coalesce(n, 0) as n from slots left join counted using (slot_start)""",
)
def twelve_hour_slots(t: Tables) -> DataFrame:
    span = t.events.agg(F.date_trunc("day", F.min("ts")).alias("a"), F.max("ts").alias("b"))
    slots = span.select(F.explode(half_day_slots(F.col("a"), F.col("b"))).alias("s")).select("s.*")
    counted = t.events.groupBy(half_day_slot(F.col("ts")).alias("slot_start")).agg(F.count(F.lit(1)).alias("n"))
    return slots.join(counted, "slot_start", "left").fillna(0, "n")


_ORDER = ", ".join(LINE_ORDER)


@query(
    "record_merge",
    f"""
with base as (
  select l_orderkey, l_linenumber, {_ORDER},
    case when l_partkey % 3 = 0 then '' when l_partkey % 3 = 1 then null else 'P' || l_partkey end as terminal,
    case when l_suppkey % 2 = 0 then cast(l_quantity as int) end as delay,
    case when l_partkey % 5 = 0 then '' else l_linestatus end as status
  from lineitem),
o as (select *, row_number() over (order by {_ORDER}) as place from base)
select l_orderkey, l_linenumber,
  first(terminal order by place) filter (where terminal is not null and terminal <> '') as terminal,
  first(delay order by place) filter (where delay is not null) as delay,
  first(status order by place) filter (where status is not null and status <> '') as status
from o group by 1, 2""",
)
def record_merge(t: Tables) -> DataFrame:
    base = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber",
        "case when l_partkey % 3 = 0 then '' when l_partkey % 3 = 1 then null else concat('P', l_partkey) end as terminal",
        "case when l_suppkey % 2 = 0 then cast(l_quantity as int) end as delay",
        "case when l_partkey % 5 = 0 then '' else l_linestatus end as status",
        *[f"{c} as place_{i}" for i, c in enumerate(LINE_ORDER)],
    )
    return mov.merge_records(
        base, [f"place_{i}" for i in range(len(LINE_ORDER))], ["l_orderkey", "l_linenumber"]
    )


@query(
    "delay_advance",
    """
with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  (epoch(l_shipdate) + l_quantity * 7 - epoch(o_orderdate)) / 60 as m
  from lineitem join orders on l_orderkey = o_orderkey)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(greatest(trunc(m), 0) as int) as delay,
  cast(greatest(-trunc(m), 0) as int) as advance from x""",
)
def delay_advance(t: Tables) -> DataFrame:
    shipped = F.timestamp_add("SECOND", (F.col("l_quantity") * 7).cast("int"), F.col("l_shipdate"))
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("d", delay_and_advance(shipped, F.col("o_orderdate")))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "d.delay", "d.advance")
    )


_STATUS = "case o_orderstatus when 'O' then ' Arrived' when 'F' then 'DEPARTED ' else 'Expected' end"


@query(
    "actual_or_fallback",
    f"""
with x as (select o_orderkey, {_STATUS} as status,
  case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y-%m-%d %H:%M') || 'Z' when o_orderkey % 3 = 1 then '' end as actual,
  case when o_orderkey % 4 > 0 then strftime(o_orderdate + interval 5 minute, '%Y-%m-%d %H:%M') || 'Z' end as revised from orders)
select o_orderkey, lower(trim(status)) as status,
  coalesce(nullif(actual, ''), case when lower(trim(status)) in ('arrived', 'departed', 'landed') then revised end) as actual_time,
  case when nullif(actual, '') is not null then 'actualTime'
    when lower(trim(status)) in ('arrived', 'departed', 'landed') and revised is not null then 'revisedTime' end as actual_source
from x""",
)
def actual_or_fallback(t: Tables) -> DataFrame:
    x = t.orders.selectExpr(
        "o_orderkey", f"{_STATUS} as status",
        "case when o_orderkey % 3 = 0 then date_format(o_orderdate, \"yyyy-MM-dd HH:mm'Z'\") when o_orderkey % 3 = 1 then '' end as actual",
        "case when o_orderkey % 4 > 0 then date_format(o_orderdate + interval 5 minutes, \"yyyy-MM-dd HH:mm'Z'\") end as revised",
    )
    chosen = mov.actual_or_revised(F.col("actual"), F.col("revised"), F.col("status"))
    return x.withColumn("c", chosen).select(
        "o_orderkey", mov.status_key(F.col("status")).alias("status"),
        F.col("c.time").alias("actual_time"), F.col("c.source").alias("actual_source"),
    )


def boards(t: Tables) -> DataFrame:
    """Orders as board replies, landed as JSON files: each is seen leaving its origin and arriving at its destination."""
    moment = "date_format(o_orderdate + make_interval(0,0,0,0,0,{m}), \"yyyy-MM-dd HH:mm'+00:00'\")"
    planned = moment.format(m="cast(o_orderkey % 1200 as int)")
    landing = moment.format(m="cast(o_orderkey % 1200 + 90 as int)")
    moved = moment.format(m="cast(o_orderkey % 1200 + o_custkey % 61 - 20 as int)")
    touched = moment.format(m="cast(o_orderkey % 1200 + 90 + o_custkey % 61 - 20 as int)")
    codes = ", ".join(f"'{c}'" for c in CODES)
    # A reply is many times longer than its order, so few input files would leave few tasks to write them.
    flights = t.orders.repartition("o_orderkey").select(
        "o_orderkey",
        airport_of(F.col("o_orderkey")).alias("o"),
        airport_of(F.col("o_custkey")).alias("d"),
        F.expr(
            f"""named_struct(
  'number', concat('ZZ ', o_custkey % 500), 'status', {_STATUS},
  'airline', named_struct('name', o_orderpriority),
  'departure', named_struct('airport', named_struct('iata', element_at(array({codes}), cast(o_orderkey % 8 + 1 as int))),
     'scheduledTime', named_struct('local', {planned}),
     'revisedTime', case when o_orderkey % 3 > 0 then named_struct('local', {moved}) end,
     'terminal', case when o_custkey % 2 = 0 then '2F' end),
  'arrival', named_struct('airport', named_struct('iata', element_at(array({codes}), cast(o_custkey % 8 + 1 as int))),
     'scheduledTime', named_struct('local', {landing}),
     'actualTime', case when o_orderkey % 5 = 0 then named_struct('local', {touched}) end,
     'terminal', case when o_orderkey % 2 = 0 then '1' end))"""
        ).alias("f"),
    )
    # Each reply holds one flight, on the departures side of its origin and the arrivals side of its destination.
    slot = F.format_string("%012d", "o_orderkey")
    head = [F.lit('{"queried_airport":"'), F.lit('","slot_start":"'), F.lit('","departures":[')]
    sides = F.array(
        F.concat(head[0], "o", head[1], slot, head[2], "json", F.lit('],"arrivals":[]}')),
        F.concat(head[0], "d", head[1], slot, head[2], F.lit('],"arrivals":['), "json", F.lit("]}")),
    )
    landed = flights.withColumn("json", F.to_json("f")).select(F.explode(sides).alias("value"))
    path = f"{shared_folder(t.spark)}/boards-{uuid.uuid4().hex}"
    landed.write.text(path)
    return read_boards(t.spark, path, RECORD_BOARD)


def _moment(m: str) -> str:
    return f"strftime(o_orderdate + to_minutes(cast({m} as bigint)), '%Y-%m-%d %H:%M') || '+00:00'"


SQL_RECORDS = f"""
raw as (
  select o_orderkey, 'ZZ ' || (o_custkey % 500) as flight_number, o_orderpriority as airline, {_STATUS} as status,
    {sql_airport('o_orderkey')} as airport_origin, {sql_airport('o_custkey')} as airport_destination,
    case when o_custkey % 2 = 0 then '2F' end as terminal_departure, case when o_orderkey % 2 = 0 then '1' end as terminal_arrival,
    {_moment('o_orderkey % 1200')} as scheduled_departure, {_moment('o_orderkey % 1200 + 90')} as scheduled_arrival,
    case when o_orderkey % 3 > 0 then {_moment('o_orderkey % 1200 + o_custkey % 61 - 20')} end as revised_departure,
    case when o_orderkey % 5 = 0 then {_moment('o_orderkey % 1200 + 90 + o_custkey % 61 - 20')} end as actual_arrival,
    cast(o_custkey % 61 - 20 as int) as moved
  from orders),
timed as (
  select *, coalesce(revised_departure, scheduled_departure) as estimated_departure, scheduled_arrival as estimated_arrival,
    case when lower(trim(status)) in ('arrived', 'departed', 'landed') then revised_departure end as actual_departure
  from raw),
both_sides as (
  select *, 'departure' as movement_type, 0 as side_rank, airport_origin as queried_airport from timed
  union all select *, 'arrival', 1, airport_destination from timed),
records as (
  select substr(scheduled_departure, 1, 10) as flight_date,
    case movement_type when 'departure' then substr(scheduled_departure, 1, 10) else substr(scheduled_arrival, 1, 10) end as movement_date,
    flight_number, airline, airport_origin, airport_destination, terminal_departure, terminal_arrival, scheduled_departure, scheduled_arrival,
    estimated_departure, estimated_arrival, actual_departure, actual_arrival,
    case when actual_departure is not null then 'revisedTime' end as actual_source_departure,
    case when actual_arrival is not null then 'actualTime' end as actual_source_arrival,
    case when actual_departure is not null then greatest(moved, 0) end as departure_delay_min,
    case when actual_departure is not null then greatest(-moved, 0) end as departure_advance_min,
    case when actual_arrival is not null then greatest(moved, 0) end as arrival_delay_min,
    case when actual_arrival is not null then greatest(-moved, 0) end as arrival_advance_min,
    status, movement_type, queried_airport, lpad(cast(o_orderkey as varchar), 12, '0') as slot_start, side_rank
  from both_sides)"""

_COLUMNS = [
    "flight_date", "movement_date", "flight_number", "airline", "airport_origin", "airport_destination", "terminal_departure",
    "terminal_arrival", "scheduled_departure", "scheduled_arrival", "estimated_departure", "estimated_arrival", "actual_departure",
    "actual_arrival", "actual_source_departure", "actual_source_arrival", "departure_delay_min", "departure_advance_min",
    "arrival_delay_min", "arrival_advance_min", "status", "movement_type",
]


@query("movement_records", f"with {SQL_RECORDS} select {', '.join(_COLUMNS)} from records")
def movement_records(t: Tables) -> DataFrame:
    return mov.records(mov.board_flights(boards(t))).select(*_COLUMNS)


_KEYS = mov.MERGE_KEYS
MERGED = ", ".join(
    f"first({c} order by queried_airport, slot_start, side_rank) filter (where {c} is not null and cast({c} as varchar) <> '') as {c}"
    for c in _COLUMNS if c not in _KEYS
)


@query(
    "movement_table",
    f"""
with {SQL_RECORDS},
merged as (select {', '.join(_KEYS)}, {MERGED} from records where {SQL_TARGET} group by {', '.join(_KEYS)}),
numbered as (select *, row_number() over (partition by {', '.join(mov.IDENTITY)} order by airline nulls last, movement_date nulls last) as rn
  from merged where {SQL_TARGET})
select {', '.join(_COLUMNS)} from numbered where rn = 1""",
)
def movement_table(t: Tables) -> DataFrame:
    return mov.sorted_movements(mov.movement_table(boards(t)).select(*_COLUMNS))
