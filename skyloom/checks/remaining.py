"""Operators and branches that the other checks do not reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from skyloom.checks.base import SQL_TARGET, Tables, query, quote
from skyloom.checks.context import SQL_WEATHER, weather_rows
from skyloom.checks.traffic import MERGED, SQL_RECORDS, boards
from skyloom.functions import text, values
from skyloom.functions.times import easter
from skyloom.operators import features as ft
from skyloom.operators import movements as mov
from skyloom.operators import shaping as sh
from skyloom.operators.lookup import attach, sized
from skyloom.operators.signoff import LABEL, finish
from skyloom.operators.strikes import in_window
from skyloom.operators.weather import weather_on_day
from skyloom.plans.history import flight_history
from skyloom.sources.files import stamped

# Written-out pairs of text with references and the text they stand for.
REFERENCES = [
    ("a &copy; b", "a \u00a9 b"), ("&#128512;x", "\U0001f600x"), ("&#70000;", "\U00011170"), ("l&#146;avion", "l\u2019avion"),
    ("&eacute;t&eacute et", "\u00e9t\u00e9 et"), ("&amp;amp;", "&amp;"), ("&#0;&#xD800;", "\ufffd\ufffd"), ("&euro;&deg;&ntilde;", "\u20ac\u00b0\u00f1"),
    ("&unknown; & x", "&unknown; & x"), ("&notit;", "\u00acit;"), ("&#x80;&#X41;", "\u20acA"), ("&#1;b", "b"), ("no reference", "no reference"),
]


@query(
    "html_references",
    "select event_id, case event_id % {} {} end as plain from events".format(
        len(REFERENCES), " ".join(f"when {i} then {quote(plain)}" for i, (_, plain) in enumerate(REFERENCES))
    ),
)
def html_references(t: Tables) -> DataFrame:
    given = F.array(*[F.lit(coded) for coded, _ in REFERENCES])
    coded = F.get(given, (F.col("event_id") % len(REFERENCES)).cast("int"))
    return t.events.select("event_id", text.unescape(coded).alias("plain"))


@query(
    "labels_of_nan",
    """select event_id, cast(coalesce(value > 15 and event_id % 13 <> 1, false) as int) as late,
  case when event_id % 13 in (0, 1) then 0 else coalesce(cast(trunc(value) as int), 0) end as flag from events""",
)
def labels_of_nan(t: Tables) -> DataFrame:
    level = F.expr("case when event_id % 13 = 1 then double('nan') else value end")
    unreadable = F.expr("case event_id % 13 when 1 then double('nan') when 0 then double('infinity') else value end")
    return t.events.select("event_id", values.late_label(level).alias("late"), values.flag(unreadable).alias("flag"))


@query(
    "harmonised_names",
    """select o_orderkey, o_orderdate as movement_date, o_orderstatus as status, o_orderpriority as scheduled_departure, o_totalprice as scheduled_arrival,
  o_custkey as gate_dep from orders""",
)
def harmonised_names(t: Tables) -> DataFrame:
    repaired = t.orders.selectExpr(
        "o_orderkey", "o_orderdate as movement_date_dep", "o_orderstatus as status_dep", "o_orderpriority as scheduled_departure_dep",
        "o_totalprice as scheduled_arrival_arr", "o_custkey as gate_dep",
    )
    return sh.harmonize(repaired, wide=True)


@query("columns_without", "select o_orderkey, o_custkey from orders")
def columns_without(t: Tables) -> DataFrame:
    return sh.drop_matching(t.orders.selectExpr("o_orderkey", "o_totalprice as NBVol_total", "o_custkey", "o_orderstatus as statusNBVol"))


@query(
    "model_rows_with_target",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, cast(l_tax > 0.04 as int) as retard_arrivee,
  month(l_shipdate) as flight_month, day(l_shipdate) as flight_day, (dayofweek(l_shipdate) + 6) % 7 as flight_dayofweek
from lineitem where l_partkey % 5 > 0""",
)
def model_rows_with_target(t: Tables) -> DataFrame:
    """Rows without a target go, whatever form missing takes; so do the columns that give it away."""
    table = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "date_format(l_shipdate, 'yyyy-MM-dd') as flight_date",
        "l_extendedprice as arrival_delay_min",
        "case l_partkey % 10 when 0 then null when 5 then double('nan') else double(cast(l_tax > 0.04D as int)) end as retard_arrivee",
    )
    return ft.model_input(table).withColumn("retard_arrivee", F.col("retard_arrivee").cast("int"))


@query(
    "date_window",
    "select event_id from events where ts::date between date '2024-06-30' - 364 and date '2024-06-30'",
)
def date_window(t: Tables) -> DataFrame:
    return t.events.where(in_window(F.to_date("ts"), F.lit("2024-06-30").cast("date"))).select("event_id")


@query(
    "one_day",
    "select event_id from events where ts::date = (select min(ts::date) + 3 from events)",
)
def one_day(t: Tables) -> DataFrame:
    first = t.events.agg(F.min(F.to_date("ts")).alias("d")).first()["d"]
    hourly = t.events.withColumn("time", F.col("ts"))
    return weather_on_day(hourly, F.date_add(F.lit(first), 3)).select("event_id")


@query("aligned_columns", "select o_custkey::double as o_custkey, 0::bigint as absent, o_orderstatus, o_orderkey from orders")
def aligned_columns(t: Tables) -> DataFrame:
    layout = StructType([
        StructField("o_custkey", DoubleType()), StructField("absent", LongType()), StructField("o_orderstatus", StringType()), StructField("o_orderkey", LongType()),
    ])
    return ft.align(t.orders, layout)


@query(
    "key_value_lines",
    """select c_custkey, 0 as part, 'DATE_GENERATION' as colonne, '2026-04-16' as valeur from customer
union all select c_custkey, 1, 'LineNumber_' || c_custkey, cast(c_custkey as varchar) from customer
union all select c_custkey, 2, 'c_name', c_name from customer union all select c_custkey, 2, 'c_nationkey', cast(c_nationkey as varchar) from customer""",
)
def key_value_lines(t: Tables) -> DataFrame:
    return sh.key_value_report(t.customer.select("c_custkey", "c_name", "c_nationkey"), "c_custkey", "2026-04-16")


@query("lookup_shuffled", "select o_orderkey, c_name from orders left join customer on c_custkey = o_custkey and c_custkey % 3 > 0")
def lookup_shuffled(t: Tables) -> DataFrame:
    """A lookup table beyond the broadcast bound."""
    names = sized(t.customer.where("c_custkey % 3 > 0").select("c_custkey", "c_name"), max_rows=0)
    return attach(t.orders.select("o_orderkey", "o_custkey"), names, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_name")


@query(
    "history",
    f"""
with {SQL_RECORDS},
merged as (select {', '.join(mov.MERGE_KEYS)}, {MERGED} from records where {SQL_TARGET} group by {', '.join(mov.MERGE_KEYS)}),
flights as (select *, cast(coalesce(arrival_delay_min, departure_delay_min) as int) as delay from merged
  qualify row_number() over (partition by {', '.join(mov.IDENTITY)} order by airline nulls last, movement_date nulls last) = 1),
{SQL_WEATHER.replace('raw as (', 'readings as (', 1).replace('from raw)', 'from readings)')},
hourly as (select icao, date_trunc('hour', time) as hour, temperature_2m from weather
  qualify row_number() over (partition by icao, date_trunc('hour', time) order by time, relative_humidity_2m nulls last, dew_point nulls last) = 1)
select flight_number, flight_date, airport_origin, airport_destination, scheduled_departure, delay as arrival_delay_min,
  cast(coalesce(delay > 15, false) as int) as late, temperature_2m as temperature_2m_dep
from flights left join hourly on icao = airport_origin and hour = date_trunc('hour', strptime(substr(scheduled_departure, 1, 16), '%Y-%m-%d %H:%M'))
where coalesce(lower(trim(status)), '') <> 'unknown'""",
)
def history(t: Tables) -> DataFrame:
    """The whole build: landed boards, weather, calendar and news to the final table."""
    articles = t.documents.selectExpr(
        "substring(text, 1, 200) as title", "'' as description", "concat('http://a/', doc_id) as link", "source",
        "timestamp_seconds(1704067200 + doc_id * 3600) as pub_date",
    )
    table = finish(flight_history(boards(t), weather_rows(t), articles, "1992-01-01", "1998-12-31"))
    return table.select(
        "flight_number", "flight_date", "airport_origin", "airport_destination", "scheduled_departure", F.col("arrival_delay_min").cast("int").alias("arrival_delay_min"),
        F.col(f"`{LABEL}`").alias("late"), "temperature_2m_dep",
    )


# Known Easter Sundays, 1990 to 2030.
EASTERS = (
    "1990-04-15 1991-03-31 1992-04-19 1993-04-11 1994-04-03 1995-04-16 1996-04-07 1997-03-30 1998-04-12 1999-04-04 2000-04-23 "
    "2001-04-15 2002-03-31 2003-04-20 2004-04-11 2005-03-27 2006-04-16 2007-04-08 2008-03-23 2009-04-12 2010-04-04 2011-04-24 "
    "2012-04-08 2013-03-31 2014-04-20 2015-04-05 2016-03-27 2017-04-16 2018-04-01 2019-04-21 2020-04-12 2021-04-04 2022-04-17 "
    "2023-04-09 2024-03-31 2025-04-20 2026-04-05 2027-03-28 2028-04-16 2029-04-01 2030-04-21"
).split()


@query(
    "easter_dates",
    f"select o_orderkey, [{', '.join(f'date {quote(d)}' for d in EASTERS)}][cast(o_orderkey % {len(EASTERS)} + 1 as int)] as sunday from orders",
)
def easter_dates(t: Tables) -> DataFrame:
    year = (F.lit(1990) + F.col("o_orderkey") % len(EASTERS)).cast("int")
    return t.orders.select("o_orderkey", easter(year).alias("sunday"))


@query("stamped_rows", "select r_regionkey, timestamp '2026-04-16 23:30:18' as generated_at from region")
def stamped_rows(t: Tables) -> DataFrame:
    return stamped(t.region.select("r_regionkey"), "2026-04-16 23:30:18")
