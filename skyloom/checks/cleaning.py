"""Repeated rows, repairs, profiles and fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import LINE_ORDER, SQL, Tables, query
from skyloom.constants import PLACEHOLDERS
from skyloom.operators import distinct as dis
from skyloom.operators import profile as prof
from skyloom.operators import repair as rep
from skyloom.operators.features import training_table
from skyloom.operators.slices import fill_both_ways, positions
from skyloom.sources.files import latest_snapshot

KEYS = ["l_orderkey", "l_linenumber"]
_ORDER = ", ".join(LINE_ORDER)


@query(
    "dedup_first",
    f"select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {_ORDER}) = 1",
)
def dedup_first(t: Tables) -> DataFrame:
    return dis.keep_first(t.lineitem, KEYS, LINE_ORDER)


@query("dedup_none", "select * from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) = 1")
def dedup_none(t: Tables) -> DataFrame:
    return dis.keep_unique(t.lineitem, KEYS)


@query("dup_report", "select * from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1")
def dup_report(t: Tables) -> DataFrame:
    return dis.repeated_rows(t.lineitem, KEYS)


@query("dup_keys", "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1")
def dup_keys(t: Tables) -> DataFrame:
    return dis.repeated_keys(t.lineitem, KEYS)


@query("value_counts", "select event_type, count(*) as n from events group by 1")
def value_counts(t: Tables) -> DataFrame:
    return dis.value_counts(t.events, "event_type")


@query(
    "latest_snapshot",
    "select o_orderkey, date_trunc('month', o_orderdate)::date as snapshot from orders where date_trunc('month', o_orderdate) = (select max(date_trunc('month', o_orderdate)) from orders)",
)
def latest(t: Tables) -> DataFrame:
    return latest_snapshot(t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("snapshot")), "snapshot")


def _two_sided(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.when(F.col("l_orderkey") % 97 > 0, F.concat(F.lit("ZZ "), "l_orderkey")).alias("flight_number"),
        F.expr("case l_returnflag when 'A' then 'departure' when 'R' then 'arrival' else 'other' end").alias("movement_type"),
        F.col("l_shipdate").alias("scheduled_departure"),
        F.col("l_shipdate").alias("scheduled_arrival"),
        F.expr("case when l_partkey % 3 > 0 then l_partkey end").alias("gate"),
        F.col("l_suppkey").alias("stand"),
        F.col("l_quantity").alias("load"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").alias("leg"),
        F.col("l_discount").alias("d"),
        F.col("l_tax").alias("x"),
        F.col("l_linestatus").alias("s"),
    )


_REST = ["scheduled_departure", "scheduled_arrival", "gate", "stand", "load", "price", "leg", "d", "x", "s"]
SQL_SIDES = f"""
src as (
  select case when l_orderkey % 97 > 0 then 'ZZ ' || l_orderkey end as flight_number,
    case l_returnflag when 'A' then 'departure' when 'R' then 'arrival' else 'other' end as movement_type,
    l_shipdate as scheduled_departure, l_shipdate as scheduled_arrival, case when l_partkey % 3 > 0 then l_partkey end as gate,
    l_suppkey as stand, l_quantity as load, l_extendedprice as price, l_linenumber as leg, l_discount as d, l_tax as x, l_linestatus as s
  from lineitem),
counted as (select *, count(*) over (partition by flight_number) as copies from src),
single as (select * exclude (copies) from counted where copies = 1),
dep as (select * exclude (copies), cast(row_number() over (partition by flight_number order by {", ".join(c + " nulls last" for c in _REST)}) - 1 as int) as n_vol
  from counted where copies > 1 and movement_type = 'departure'),
arr as (select * exclude (copies), cast(row_number() over (partition by flight_number order by {", ".join(c + " nulls last" for c in _REST)}) - 1 as int) as n_vol
  from counted where copies > 1 and movement_type = 'arrival')"""


@query(
    "repair_pairs",
    f"""with {SQL_SIDES},
pairs as (select d.flight_number, d.n_vol, {", ".join(f"d.{c} as {c}_dep, a.{c} as {c}_arr" for c in ["movement_type", *_REST])}
  from dep d join arr a on d.flight_number is not distinct from a.flight_number and d.n_vol = a.n_vol)
select * from single union all by name select * from pairs""",
)
def repair_pairs(t: Tables) -> DataFrame:
    return rep.repair_pairs(_two_sided(t), ["flight_number"])


@query(
    "repair_left",
    f"""with {SQL_SIDES},
pairs as (select d.flight_number, {", ".join(f"coalesce(d.{c}, a.{c}) as {c}" for c in ["movement_type", *_REST])}
  from dep d left join arr a on d.flight_number is not distinct from a.flight_number and d.n_vol = a.n_vol)
select * from single union all by name select * from pairs""",
)
def repair_left(t: Tables) -> DataFrame:
    return rep.repair_left(_two_sided(t), ["flight_number"])


@query("repair_pairs_sliced", SQL["repair_pairs"])
def repair_pairs_sliced(t: Tables) -> DataFrame:
    return rep.repair_pairs(_two_sided(t), ["flight_number"], rows_per_slice=t.lineitem.count() // 23 + 1)


# Times of different offsets within one flight, as when the clock changes: text order is not time order.
_INSTANT_REST = "scheduled_departure, scheduled_arrival, l_partkey, l_suppkey, l_linenumber, l_extendedprice"


@query(
    "repair_instants",
    f"""with src as (
  select 'ZZ ' || l_orderkey as flight_number, case when l_returnflag = 'A' then 'departure' else 'arrival' end as movement_type,
    timestamp '2025-10-26 00:00:00' + to_minutes(l_partkey % 240) as at_dep, timestamp '2025-10-26 00:00:00' + to_minutes(l_partkey % 90 + l_suppkey % 90) as at_arr,
    l_suppkey % 2 as summer, l_partkey, l_suppkey, l_linenumber, l_extendedprice from lineitem),
texts as (
  select *, strftime(at_dep + to_hours(1 + summer), '%Y-%m-%d %H:%M') || case summer when 1 then '+02:00' else '+01:00' end as scheduled_departure,
    strftime(at_arr + to_hours(1 + summer), '%Y-%m-%d %H:%M') || case summer when 1 then '+02:00' else '+01:00' end as scheduled_arrival,
    count(*) over (partition by flight_number) as copies from src),
dep as (select *, row_number() over (partition by flight_number order by at_dep, {_INSTANT_REST}) as n from texts where copies > 1 and movement_type = 'departure'),
arr as (select *, row_number() over (partition by flight_number order by at_arr, scheduled_arrival, {_INSTANT_REST}) as n from texts where copies > 1 and movement_type = 'arrival')
select flight_number, dep.l_partkey as l_partkey_dep, dep.l_suppkey as l_suppkey_dep, arr.l_partkey as l_partkey_arr, arr.l_suppkey as l_suppkey_arr
from dep join arr using (flight_number, n)""",
)
def repair_instants(t: Tables) -> DataFrame:
    def text(minutes: str) -> str:
        local = f"timestamp_ntz'2025-10-26 00:00:00' + make_dt_interval(0, 1 + cast(l_suppkey % 2 as int), cast({minutes} as int), 0)"
        return f"concat(date_format({local}, 'yyyy-MM-dd HH:mm'), case l_suppkey % 2 when 1 then '+02:00' else '+01:00' end)"

    sides = t.lineitem.selectExpr(
        "concat('ZZ ', l_orderkey) as flight_number", "case when l_returnflag = 'A' then 'departure' else 'arrival' end as movement_type",
        f"{text('l_partkey % 240')} as scheduled_departure", f"{text('l_partkey % 90 + l_suppkey % 90')} as scheduled_arrival",
        "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
    )
    pairs = rep.repair_pairs(sides, ["flight_number"]).where("n_vol is not null")
    return pairs.select("flight_number", "l_partkey_dep", "l_suppkey_dep", "l_partkey_arr", "l_suppkey_arr")


def _holey(t: Tables) -> DataFrame:
    """Events with missing values, empty text, placeholder words and infinite numbers."""
    return t.events.selectExpr(
        "event_id", "ts",
        "case when event_id % 7 = 0 then value end as value_dep",
        "case event_id % 9 when 0 then '' when 1 then 'None' when 2 then 'unknown' when 3 then null else event_type end as kind_arr",
        "case when event_id % 4 > 0 then user_id end as user_delay",
        "case when event_id % 13 = 0 then double('infinity') when event_id % 13 = 1 then double('nan') else value end as level_dep",
        "cast(event_id % 50 as string) as flight_number",
        "props",
    )


SQL_HOLEY = """
holey as (
  select event_id, ts, case when event_id % 7 = 0 then value end as value_dep,
    case event_id % 9 when 0 then '' when 1 then 'None' when 2 then 'unknown' when 3 then null else event_type end as kind_arr,
    case when event_id % 4 > 0 then user_id end as user_delay,
    case when event_id % 13 = 0 then 'infinity'::double when event_id % 13 = 1 then null else value end as level_dep,
    cast(event_id % 50 as varchar) as flight_number, props
  from events)"""
_HOLEY = ["event_id", "ts", "value_dep", "kind_arr", "user_delay", "level_dep", "flight_number", "props"]


@query(
    "null_profile",
    f"""with {SQL_HOLEY}, p as ({" union all ".join(f"select '{c}' as colonne, avg(cast({c} is null as int)) * 100 as pct_missing from holey" for c in _HOLEY)})
select * from p where pct_missing > 0 order by pct_missing desc, colonne limit 30""",
)
def null_profile(t: Tables) -> DataFrame:
    return prof.null_profile(_holey(t))


@query(
    "placeholder_scan",
    f"""with {SQL_HOLEY}
select {" + ".join(f"count(*) filter (where {c} is null)" for c in _HOLEY)} as nulls,
  {" + ".join(f"count(*) filter (where {c} = '')" for c in ("kind_arr", "flight_number", "props"))} as empty_texts,
  {" + ".join(f"count(*) filter (where {c} is null" + (f" or lower({c}) in {PLACEHOLDERS}" if c in ("kind_arr", "flight_number", "props") else "") + ")" for c in _HOLEY)} as placeholder_words,
  count(*) filter (where isinf(value_dep)) + count(*) filter (where isinf(level_dep)) as infinite_values from holey""",
)
def placeholder_scan(t: Tables) -> DataFrame:
    return prof.emptiness(_holey(t))


@query(
    "health",
    f"""with {SQL_HOLEY} select count(*) as n_rows, cast({len(_HOLEY)} as bigint) as n_columns,
  {" + ".join(f"count(*) filter (where {c} is null)" for c in _HOLEY)} as n_missing from holey""",
)
def health(t: Tables) -> DataFrame:
    return prof.health(_holey(t))


def _sql_fill(c: str) -> str:
    w = "over (order by ts, event_id rows between {})"
    return (
        f"coalesce(last_value({c} ignore nulls) {w.format('unbounded preceding and current row')}, "
        f"first_value({c} ignore nulls) {w.format('current row and unbounded following')}) as {c}"
    )


FILLED = ("value_dep", "kind_arr", "user_delay", "level_dep")


@query(
    "fill_both_ways",
    f"with {SQL_HOLEY} select event_id, ts, {', '.join(_sql_fill(c) for c in FILLED)} from holey",
)
def fill(t: Tables) -> DataFrame:
    return fill_both_ways(_holey(t).select("event_id", "ts", *FILLED), ["ts", "event_id"])


@query("fill_sliced", SQL["fill_both_ways"])
def fill_sliced(t: Tables) -> DataFrame:
    """The same fill cut into many slices, as for a large table."""
    return fill_both_ways(_holey(t).select("event_id", "ts", *FILLED), ["ts", "event_id"], rows_per_slice=t.events.count() // 23 + 1)


# value_dep is missing in six of seven rows and goes; user_delay is protected by its name.
@query(
    "purge_columns",
    f"with {SQL_HOLEY} select {', '.join(_sql_fill(c) for c in ('kind_arr', 'user_delay', 'flight_number'))}, round(lvl, 6) as level_dep from (select *, {_sql_fill('level_dep').replace(' as level_dep', ' as lvl')} from holey)",
)
def purge_columns(t: Tables) -> DataFrame:
    kept = prof.purge(_holey(t), ["ts", "event_id"])
    return kept.withColumn("level_dep", F.round("level_dep", 6))


@query(
    "row_positions",
    f"select l_orderkey, l_linenumber, {_ORDER}, row_number() over (order by {_ORDER}, l_orderkey, l_linenumber) - 1 as place from lineitem",
)
def row_positions(t: Tables) -> DataFrame:
    return positions(t.lineitem, [*LINE_ORDER, *KEYS], "place")


@query("row_positions_sliced", SQL["row_positions"])
def row_positions_sliced(t: Tables) -> DataFrame:
    return positions(t.lineitem, [*LINE_ORDER, *KEYS], "place", rows_per_slice=t.lineitem.count() // 23 + 1)


@query(
    "training_table",
    """
with src as (
  select 'N' || l_suppkey as flight_number, strftime(l_shipdate, '%Y-%m-%d') as flight_date, 'P' || (l_partkey % 40) as airport_origin,
    'Q' || (l_orderkey % 50) as airport_destination, case when l_partkey % 4 > 0 then l_quantity end as wind_dep,
    case when l_linenumber = 1 then l_tax end as rare_arr, case when l_partkey % 3 > 0 then cast(l_quantity as int) - 5 end as arrival_delay_min
  from lineitem),
uniq as (select * from src qualify count(*) over (partition by flight_number, flight_date, airport_origin, airport_destination) = 1),
filled as (
  select flight_number, flight_date, airport_origin, airport_destination,
    coalesce(last_value(wind_dep ignore nulls) over w, first_value(wind_dep ignore nulls) over v) as wind_dep,
    coalesce(last_value(arrival_delay_min ignore nulls) over w, first_value(arrival_delay_min ignore nulls) over v) as arrival_delay_min
  from uniq window w as (order by flight_number, flight_date, airport_origin, airport_destination rows between unbounded preceding and current row),
    v as (order by flight_number, flight_date, airport_origin, airport_destination rows between current row and unbounded following))
select *, cast(arrival_delay_min > 15 as int) as retard_arrivee from filled""",
)
def training(t: Tables) -> DataFrame:
    flights = t.lineitem.selectExpr(
        "concat('N', l_suppkey) as flight_number", "date_format(l_shipdate, 'yyyy-MM-dd') as flight_date",
        "concat('P', l_partkey % 40) as airport_origin", "concat('Q', l_orderkey % 50) as airport_destination",
        "case when l_partkey % 4 > 0 then l_quantity when l_partkey % 8 = 0 then double('nan') end as wind_dep", "case when l_linenumber = 1 then l_tax end as rare_arr",
        "case when l_partkey % 3 > 0 then cast(l_quantity as int) - 5 end as arrival_delay_min", "l_linestatus as airline",
    )
    return training_table(flights)
