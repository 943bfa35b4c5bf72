"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import Tables, query, quote
from skyloom.constants import FOLD_FROM, FOLD_TO
from skyloom.functions import text, times, values, weather
from skyloom.operators.features import date_parts, date_parts_wide
from skyloom.operators.shaping import flatten, key_value, recode

SQL_BLANKS = r"[\s\p{Z}\x1c-\x1f\x{85}]+"


def sql_plain(c: str, entities: bool = True) -> str:
    """SQL twin of ``plain_text`` for the references that occur in the tables; ``html_references`` has the others."""
    out = f"coalesce({c}, '')"
    if entities:
        for name, letter in {"&copy;": "©", "&middot;": "·", "&quot;": '"'}.items():
            out = f"replace({out}, {quote(name)}, {quote(letter)})"
        out = f"regexp_replace({out}, '&amp;?', '&', 'g')"
    out = f"translate(lower({out}), '{FOLD_FROM}', '{FOLD_TO}')"
    return f"trim(regexp_replace(replace({out}, 'œ', 'oe'), '{SQL_BLANKS}', ' ', 'g'))"


@query(
    "normalise_text",
    f"""select 'document' as kind, doc_id as id, md5({sql_plain('text')}) as folded, length({sql_plain('text')}) as n from documents
union all select 'page', page_id, md5({sql_plain('html')}), length({sql_plain('html')}) from pages""",
)
def normalise_text(t: Tables) -> DataFrame:
    def folded(df: DataFrame, kind: str, key: str, column: str) -> DataFrame:
        plain = df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), text.plain_text(F.col(column)).alias("t"))
        return plain.select("kind", "id", F.md5("t").alias("folded"), F.length("t").cast("bigint").alias("n"))

    return folded(t.documents, "document", "doc_id", "text").unionByName(folded(t.pages, "page", "page_id", "html"))


@query(
    "flight_number",
    r"""
with x as (select o_orderkey, case o_custkey % 4 when 0 then ' af ' || (o_custkey % 9999) when 1 then 'BA' || (o_custkey % 9999)
  when 2 then 'x-' || o_custkey when 3 then 'Lh  ' || o_custkey end as raw, 'NATION_' || (o_custkey % 25) || ' - ' || o_orderpriority as place from orders)
select o_orderkey, upper(trim(replace(raw, ' ', ''))) as code, trim(split_part(trim(place), ' - ', 1)) as airport, upper(trim(raw)) as key,
  regexp_full_match(upper(trim(raw)), '[A-Z0-9]{1,3}\s?[0-9]{1,4}') as valid from x""",
)
def flight_number(t: Tables) -> DataFrame:
    x = t.orders.selectExpr(
        "o_orderkey",
        """case o_custkey % 4 when 0 then concat(' af ', o_custkey % 9999) when 1 then concat('BA', o_custkey % 9999)
           when 2 then concat('x-', o_custkey) when 3 then concat('Lh  ', o_custkey) end as raw""",
        "concat('NATION_', o_custkey % 25, ' - ', o_orderpriority) as place",
    )
    raw = F.col("raw")
    return x.select(
        "o_orderkey",
        text.flight_code(raw).alias("code"),
        text.airport_code(F.col("place")).alias("airport"),
        text.upper_key(raw).alias("key"),
        text.valid_flight_number(raw).alias("valid"),
    )


@query(
    "hour_regex",
    r"""
with x as (select event_id, case event_id % 3 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') when 1 then strftime(ts, '%Y-%m-%d %H:%M') else strftime(ts, '%Y-%m-%d') end as raw from events)
select event_id, regexp_extract(raw, '(\d{2}:\d{2}(?::\d{2})?)', 1) as hour_text,
  coalesce(try_cast(regexp_extract(raw, '(\d{2}):(\d{2})', 1) as int), 0) as hour_number,
  substr(raw, 1, 10) as day, case when length(raw) = 10 then '00:00' else substr(raw, 12, 5) end as hour from x""",
)
def hour_regex(t: Tables) -> DataFrame:
    raw = F.expr(
        """case event_id % 3 when 0 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") when 1 then date_format(ts, 'yyyy-MM-dd HH:mm')
           else date_format(ts, 'yyyy-MM-dd') end"""
    )
    x = t.events.select("event_id", raw.alias("raw")).withColumn("dh", text.day_and_hour(F.col("raw")))
    return x.select(
        "event_id",
        text.hour_text(F.col("raw")).alias("hour_text"),
        text.hour_number(F.col("raw")).alias("hour_number"),
        "dh.day",
        "dh.hour",
    )


@query(
    "timestamps",
    """
with x as (select event_id, ts, date_trunc('minute', ts) as m from events)
select event_id, m as zulu, m - interval 2 hour as offset_two, m as clock, date_trunc('hour', m) as hour,
  date_trunc('second', ts) as feed, cast(abs(hour(m) * 60 + minute(m) - 605) as int) as gap from x""",
)
def timestamps(t: Tables) -> DataFrame:
    x = t.events.select(
        "event_id",
        F.expr("date_format(ts, \"yyyy-MM-dd HH:mm'Z'\")").alias("z"),
        F.expr("date_format(ts, \"yyyy-MM-dd HH:mm'+02:00'\")").alias("o"),
        F.expr("date_format(ts, \"EEE, d MMM yyyy HH:mm:ss 'GMT'\")").alias("f"),
    )
    ntz = "timestamp_ntz"
    return x.select(
        "event_id",
        times.instant(F.col("z")).cast(ntz).alias("zulu"),
        times.instant(F.col("o")).cast(ntz).alias("offset_two"),
        times.wall_clock(F.col("o")).alias("clock"),
        times.hour_floor(times.instant(F.col("z"))).cast(ntz).alias("hour"),
        times.feed_instant(F.col("f")).cast(ntz).alias("feed"),
        times.time_of_day_gap(F.col("o"), F.lit("10:05")).alias("gap"),
    )


@query(
    "late_label",
    """
with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case l_partkey % 6 when 0 then null when 1 then '' when 2 then 'Missing Value' when 3 then 'NaN' else cast(cast(l_quantity as int) as varchar) end as arr,
  case when l_suppkey % 7 > 0 then cast(cast(l_quantity as int) - 10 as varchar) end as dep from lineitem),
y as (select *, case when arr is null or lower(arr) in ('', 'nan', 'none', 'missing value') then dep else arr end as delay from x)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, delay, cast(coalesce(try_cast(delay as double) > 15, false) as int) as late,
  case when try_cast(delay as double) >= 60 then 'high' when try_cast(delay as double) >= 30 then 'medium' else 'low' end as risk,
  greatest(try_cast(delay as double), 0) as minutes from y""",
)
def late_label(t: Tables) -> DataFrame:
    x = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        """case l_partkey % 6 when 0 then null when 1 then '' when 2 then 'Missing Value' when 3 then 'NaN'
           else cast(cast(l_quantity as int) as string) end as arr""",
        "case when l_suppkey % 7 > 0 then cast(cast(l_quantity as int) - 10 as string) end as dep",
    )
    delay = values.arrival_delay(F.col("arr"), F.col("dep"))
    number = F.col("delay").try_cast("double")
    return x.withColumn("delay", delay).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "delay",
        values.late_label(F.col("delay")).alias("late"),
        values.risk_band(number).alias("risk"),
        values.not_negative(number).alias("minutes"),
    )


@query(
    "wind",
    """
with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as s1, cast(trunc(l_extendedprice) as bigint) % 360 as d1,
  case when l_partkey % 9 > 0 then l_quantity * 1.5 end as s2, cast(trunc(l_extendedprice) as bigint) * 7 % 360 as d2 from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(-s1 * sin(radians(d1)), 6) as u, round(-s1 * cos(radians(d1)), 6) as v,
  round_even(sqrt(pow(-s2 * sin(radians(d2)) + s1 * sin(radians(d1)), 2) + pow(-s2 * cos(radians(d2)) + s1 * cos(radians(d1)), 2)), 2) as shear from x""",
)
def wind(t: Tables) -> DataFrame:
    x = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity as s1", "cast(l_extendedprice as bigint) % 360 as d1",
        "case when l_partkey % 9 > 0 then l_quantity * 1.5 end as s2", "cast(l_extendedprice as bigint) * 7 % 360 as d2",
    )
    s1, d1, s2, d2 = map(F.col, ("s1", "d1", "s2", "d2"))
    return x.withColumn("w", weather.wind_uv(s1, d1)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round("w.u", 6).alias("u"), F.round("w.v", 6).alias("v"), weather.wind_shear(s1, d1, s2, d2).alias("shear"),
    )


@query(
    "icing",
    """
with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_partkey % 11 > 0 then l_quantity - 20 end as t,
  case when l_suppkey % 5 > 0 then l_discount * 1000 end as rh, case when l_partkey % 4 > 0 then l_tax - 0.04 end as p,
  cast(l_partkey % 100 as int) as code, l_quantity - 20 + l_linenumber - 3 as dew from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when t <= 2 and (coalesce(rh >= 90, false) or coalesce(p > 0, false) or code in (45, 48, 56, 57, 66, 67)) then 'Oui' else 'Non' end as icing,
  case when t <= 2 and (coalesce(rh >= 90, false) or coalesce(p > 0, false) or code in (45, 48, 56, 57, 66, 67) or abs(t - dew) <= 1) then 'Oui' else 'Non' end as icing_with_dew,
  case when coalesce(p, 0) > 0 then 'Oui' else 'Non' end as precipitation, case when code in (45, 48) then 'Oui' else 'Non' end as fog,
  case when code in (56, 57, 66, 67) then 'Oui' else 'Non' end as freezing_rain, case when code between 95 and 99 then 'Oui' else 'Non' end as thunderstorms from x""",
)
def icing(t: Tables) -> DataFrame:
    x = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "case when l_partkey % 11 > 0 then l_quantity - 20 end as t",
        "case when l_suppkey % 5 > 0 then l_discount * 1000 end as rh", "case when l_partkey % 4 > 0 then l_tax - 0.04D end as p",
        "cast(l_partkey % 100 as int) as code", "l_quantity - 20 + l_linenumber - 3 as dew",
    )
    measures = [F.col(c) for c in ("t", "rh", "p", "code")]
    return x.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        weather.icing(*measures).alias("icing"),
        weather.icing(*measures, dew_point=F.col("dew")).alias("icing_with_dew"),
        weather.has_precipitation(F.col("p")).alias("precipitation"),
        weather.fog(F.col("code")).alias("fog"),
        weather.freezing_rain(F.col("code")).alias("freezing_rain"),
        weather.thunderstorms(F.col("code")).alias("thunderstorms"),
    )


@query(
    "date_parts",
    """select o_orderkey, cast(month(o_orderdate) as int) as flight_month, cast(day(o_orderdate) as int) as flight_day,
  cast(isodow(o_orderdate) - 1 as int) as flight_dayofweek, cast(o_orderkey % 1440 // 60 as int) as sched_dep_hour,
  cast(o_orderkey % 60 as int) as sched_dep_minute, cast(o_custkey % 1440 // 60 as int) as sched_arr_hour, cast(o_custkey % 60 as int) as sched_arr_minute
from orders""",
)
def date_parts_query(t: Tables) -> DataFrame:
    clock = "date_format(o_orderdate + make_interval(0,0,0,0,0,cast({c} % 1440 as int)), \"yyyy-MM-dd HH:mm'+02:00'\")"
    x = t.orders.selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'yyyy-MM-dd') as flight_date",
        clock.format(c="o_orderkey") + " as scheduled_departure_dep", clock.format(c="o_custkey") + " as scheduled_arrival_arr",
    )
    return date_parts(x)


@query(
    "date_parts_wide",
    """select event_id, cast(month(ts) as int) as ts_month, cast(isodow(ts) - 1 as int) as ts_weekday, cast(hour(ts) as int) as ts_hour,
  cast(month(ts) as int) as day_month, cast(isodow(ts) - 1 as int) as day_weekday, 0 as day_hour from events""",
)
def date_parts_wide_query(t: Tables) -> DataFrame:
    x = t.events.select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return date_parts_wide(x, ["ts", "day", "absent"]).drop("ts", "day")


@query(
    "json_props",
    """select event_id, cast(json_extract(props, '$.k') as int) as "props.k", event_type as "what.type", value as "what.inner.value" from events""",
)
def json_props(t: Tables) -> DataFrame:
    nested = t.events.select(
        "event_id",
        F.from_json("props", "k int").alias("props"),
        F.struct(F.col("event_type").alias("type"), F.struct("value").alias("inner")).alias("what"),
    )
    return flatten(nested)


@query(
    "key_value",
    """
with x as (select c_custkey, cast(c_name as varchar) as c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer)
select c_custkey, 'c_name' as colonne, c_name as valeur from x union all select c_custkey, 'c_nationkey', c_nationkey from x
union all select c_custkey, 'c_mktsegment', c_mktsegment from x""",
)
def key_value_query(t: Tables) -> DataFrame:
    return key_value(t.customer.drop("c_acctbal"), ["c_custkey"])


@query(
    "recode",
    """select c_custkey, case c_mktsegment when 'BUILDING' then 'BLD' when 'MACHINERY' then 'MCH' when 'HOUSEHOLD' then 'HHD' else c_mktsegment end as c_mktsegment
from customer""",
)
def recode_query(t: Tables) -> DataFrame:
    codes = {"BUILDING": "BLD", "MACHINERY": "MCH", "HOUSEHOLD": "HHD"}
    return recode(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", codes)
