"""Weather, calendar and news beside flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import SQL_FLIGHTS, SQL_TRAFFIC, Tables, lineitem_flights, order_traffic, query, quote, sql_flagged
from skyloom.checks.scalars import sql_plain
from skyloom.constants import (
    CALENDAR_CITIES, EASTER_HOLIDAYS, FIXED_HOLIDAYS, SCHOOL_PERIODS, SCHOOL_ZONES, SUMMER_LABEL,
)
from skyloom.functions.text import fold_word
from skyloom.operators import calendar as cal
from skyloom.operators import congestion as cong
from skyloom.operators import signoff as sign
from skyloom.operators import strikes as news
from skyloom.operators import weather as wx
from skyloom.schemas import RAW_WEATHER, conform


def _first_event(shift: str) -> str:
    return f"left join hourly h{shift} on h{shift}.event_type = e.event_type and h{shift}.hour = date_trunc('hour', e.ts + interval {shift} hour)"


@query(
    "hourly_join",
    f"""
with hourly as (
  select event_type, date_trunc('hour', ts) as hour, value, user_id from events
  qualify row_number() over (partition by event_type, date_trunc('hour', ts) order by ts, user_id, value) = 1)
select e.event_id, h0.value as value_dep, h0.user_id as user_id_dep, h5.value as value_arr, h5.user_id as user_id_arr
from events e {_first_event('0')} {_first_event('5')}""",
)
def hourly_join(t: Tables) -> DataFrame:
    weather = t.events.select(F.col("event_type").alias("icao"), F.col("ts").alias("time"), "user_id", "value")
    lookup = wx.hourly_lookup(weather)
    flights = t.events.select("event_id", F.col("event_type").alias("place"), "ts")
    dep = wx.join_hour(flights, lookup, "place", F.date_trunc("hour", "ts").cast("timestamp_ntz"), "_dep")
    late = F.date_trunc("hour", F.col("ts") + F.expr("interval 5 hours")).cast("timestamp_ntz")
    arr = wx.join_hour(dep, lookup, "place", late, "_arr")
    return arr.select("event_id", "value_dep", "user_id_dep", "value_arr", "user_id_arr")


def weather_rows(t: Tables) -> DataFrame:
    """Events as raw hourly readings of six airports, some named by city."""
    raw = t.events.selectExpr(
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") as time",
        "element_at(array('ORLY', 'CDG', 'NICE', 'LYON', 'MARSEILLE', 'TOULOUSE'), cast(event_id % 6 + 1 as int)) as icao",
        "value - 30 as temperature_2m", "case when event_id % 5 > 0 then cast(user_id as double) end as relative_humidity_2m",
        "value - 31 as dew_point_2m", "case when event_id % 7 = 0 then value end as precipitation", "value as wind_speed_10m",
        "cast(event_id % 360 as double) as wind_direction_10m", "value * 2 as wind_speed_100m",
        "case when event_id % 9 > 0 then cast(event_id * 7 % 360 as double) end as wind_direction_100m",
        "cast(event_id % 100 as int) as weather_code",
    )
    return wx.weather_table(conform(raw, RAW_WEATHER))


SQL_WEATHER = """
raw as (
  select date_trunc('second', ts) as time, ['ORY', 'CDG', 'NCE', 'LYS', 'MRS', 'TLS'][cast(event_id % 6 + 1 as int)] as icao, value - 30 as t,
    case when event_id % 5 > 0 then cast(user_id as double) end as rh, case when event_id % 7 = 0 then value end as p, value as s1,
    event_id % 360 as d1, value * 2 as s2, case when event_id % 9 > 0 then event_id * 7 % 360 end as d2, cast(event_id % 100 as int) as code, value - 31 as dew from events),
weather as (
  select time, icao, rh as relative_humidity_2m, dew as dew_point,
    case when t <= 2 and (coalesce(rh >= 90, false) or coalesce(p > 0, false) or code in (45, 48, 56, 57, 66, 67)) then 'Oui' else 'Non' end as icing_conditions,
    null::double as rain, case when code in (56, 57, 66, 67) then 'Oui' else 'Non' end as freezing_rain, null::double as snow,
    case when code between 95 and 99 then 'Oui' else 'Non' end as thunderstorms, null::double as pressure_msl,
    round_even(sqrt(pow(-s2 * sin(radians(d2)) + s1 * sin(radians(d1)), 2) + pow(-s2 * cos(radians(d2)) + s1 * cos(radians(d1)), 2)), 2) as wind_shear,
    null::double as wind_gusts_10m, s1 as wind_speed_10m, cast(d1 as double) as wind_direction_10m, p as precipitation,
    case when coalesce(p, 0) > 0 then 'Oui' else 'Non' end as has_precipitation, case when code in (45, 48) then 'Oui' else 'Non' end as fog,
    rh as humidity, t as temperature_2m, null::double as cloud_cover, null::double as cloud_base, null::double as visibility from raw)"""


@query("weather_table", f"with {SQL_WEATHER} select * from weather")
def weather_table(t: Tables) -> DataFrame:
    return weather_rows(t).withColumn("time", F.col("time").cast("timestamp_ntz"))


@query(
    "weather_audit",
    f"""with {SQL_WEATHER},
hourly as (select icao, date_trunc('hour', time) as hour, fog, temperature_2m from weather
  qualify row_number() over (partition by icao, date_trunc('hour', time) order by time, {", ".join(f"{c} nulls last" for c in wx.WEATHER.fieldNames() if c not in ("time", "icao"))}) = 1),
f as (select event_id, ['CDG', 'NCE', 'LYS'][cast(user_id % 3 + 1 as int)] as o, ['ORY', 'MRS', 'TLS'][cast(event_id % 3 + 1 as int)] as d, date_trunc('minute', ts) as m from events),
cells as (
  select 'fog_dep' as colonne, 'Non' is not distinct from fog as same from f left join hourly h on h.icao = o and h.hour = date_trunc('hour', m - interval 2 hour)
  union all select 'temperature_2m_arr', temperature_2m is null from f left join hourly h on h.icao = d and h.hour = date_trunc('hour', m + interval 1 hour))
select colonne, count(*) as cells, count(*) filter (where not same) as differing from cells group by 1
{" ".join(f"union all select '{c}{s}', count(*), 0 from events" for s in ("_dep", "_arr") for c in wx.WEATHER.fieldNames() if c != "icao" and c + s not in ("fog_dep", "temperature_2m_arr"))}""",
)
def weather_audit(t: Tables) -> DataFrame:
    """All weather columns of both ends, two of them overwritten after the join; the audit finds each changed cell."""
    clock = "date_format({}, \"yyyy-MM-dd HH:mm'{}'\")"
    flights = t.events.selectExpr(
        "event_id", "element_at(array('CDG', 'NCE', 'LYS'), cast(user_id % 3 + 1 as int)) as airport_origin",
        "element_at(array('ORY', 'MRS', 'TLS'), cast(event_id % 3 + 1 as int)) as airport_destination",
        clock.format("ts", "+02:00") + " as scheduled_departure", clock.format("ts + interval 1 hour", "Z") + " as scheduled_arrival",
    )
    weather = weather_rows(t)
    joined = wx.add_weather(flights, weather)
    changed = joined.withColumns({"fog_dep": F.lit("Non"), "temperature_2m_arr": F.lit(None).cast("double")})
    cells = wx.audit(changed, weather, ["event_id"])
    return cells.groupBy("colonne").agg(F.count(F.lit(1)).alias("cells"), F.count_if(~F.col("same")).alias("differing"))


# Orders carried 25 years on, into the years the school holidays are known for.
SHIFT_MONTHS = 300

SQL_CALENDAR = f"""
days as (select distinct cast(o_orderdate + interval {SHIFT_MONTHS} month as date) as date from orders),
periods as (select * from (values {", ".join(
    f"('{city}', {quote(label)}, date '{a}', date '{b}')"
    for city, zone in SCHOOL_ZONES.items() for label, a, b in SCHOOL_PERIODS[zone]
)}) v(city, label, start_date, end_date)),
easter0 as (select distinct year(date) as y from days),
easter1 as (select y, y // 100 as b, y % 100 as c from easter0),
easter2 as (select y, b, c, (19 * (y % 19) + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 as h from easter1),
easter3 as (select *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 as l from easter2),
easter as (select y, make_date(y, 3, 22) + cast(h + l - 7 * ((y % 19 + 11 * h + 22 * l) // 451) as int) as sunday from easter3),
named as (
  select date, case {" ".join(f"when date - sunday = {n} then {quote(l)}" for n, l in EASTER_HOLIDAYS)}
    {" ".join(f"when month(date) = {m} and day(date) = {d} then {quote(l)}" for m, d, l in FIXED_HOLIDAYS)} end as holiday
  from days join easter on y = year(date)),
school as (
  select d.date, {", ".join(f"max(label) filter (where city = '{c}') as label_{c}" for c in CALENDAR_CITIES)}
  from days d left join periods on d.date between start_date and end_date group by 1),
calendar as (
  select date, concat_ws(', ', {", ".join(f"case when label_{c} is not null then '{c}' end" for c in CALENDAR_CITIES)}) as "Vacances Scolaires",
    coalesce(array_to_string(list_sort(list_distinct([x for x in [{", ".join(f"label_{c}" for c in CALENDAR_CITIES)}] if x is not null])), ', '), '') as "Label des Vacances",
    cast(holiday is not null as int) as "Jour férié", coalesce(holiday, '') as "Label Jour Ferié", cast(isodow(date) >= 6 as int) as "Week End",
    {", ".join(f'cast(label_{c} is not null as int) as "{column}"' for c, column in CALENDAR_CITIES.items())}
  from school join named using (date))"""


def _calendar_days(t: Tables) -> DataFrame:
    return t.orders.select(F.add_months("o_orderdate", SHIFT_MONTHS).alias("date")).distinct()


@query("calendar", f"with {SQL_CALENDAR} select * from calendar")
def calendar(t: Tables) -> DataFrame:
    return cal.calendar(_calendar_days(t))


@query(
    "calendar_join",
    f"""with {SQL_CALENDAR}
select o_orderkey, c."Vacances Scolaires", c."Label des Vacances", c."Label Jour Ferié", c."Week End",
  cast(c."Label des Vacances" = {quote(SUMMER_LABEL)} as int) as is_summer_vacation
from orders left join calendar c on c.date = cast(o_orderdate + interval {SHIFT_MONTHS} month as date)""",
)
def calendar_join(t: Tables) -> DataFrame:
    flights = t.orders.select("o_orderkey", F.add_months("o_orderdate", SHIFT_MONTHS).cast("string").alias("flight_date"))
    joined = cal.add_calendar(flights, cal.calendar_for(flights))
    return joined.select(
        "o_orderkey", "Vacances Scolaires", "Label des Vacances", "Label Jour Ferié", "Week End", "is_summer_vacation"
    )


# Words that play strike keywords and airport names in the documents' invented prose.
KEYWORDS = ("thble", "eauxle", "schen", "ciónes", "réeau")
ALIASES = {
    "LYON": ("thtion", "maison"),
    "TOULOUSE": ("anea", "oiénn"),
    "NICE": ("nice", "schei"),
    "MARSEILLE": ("erwh", "vire"),
    "CDG": ("ensch", "cción"),
    "ORLY": ("ory", "ouer"),
}


def articles(t: Tables) -> DataFrame:
    """Documents as articles, one an hour; every eleventh has no date."""
    at = F.timestamp_add("HOUR", F.col("doc_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return t.documents.select(
        F.concat_ws(" ", F.lit(" Info"), "source", F.upper("lang")).alias("title"),
        F.concat(F.lit("http://"), "source").alias("link"),
        F.when(F.col("doc_id") % 11 != 10, at).alias("pub_date"),
        F.col("text").alias("description"),
        F.col("source").alias("source"),
    )


def _sql_any(words) -> str:
    return "(" + " or ".join(f"contains(t, {quote(fold_word(w))})" for w in words) + ")"


SQL_ARTICLES = f"""
articles as (
  select ' Info ' || source || ' ' || upper(lang) as title, 'http://' || source as link,
    case when doc_id % 11 <> 10 then timestamp '2024-01-01' + to_hours(doc_id) end as pub_date, text as description, source from documents),
folded as materialized (select *, {sql_plain("title || ' ' || description || ' ' || link || ' ' || source")} as t from articles where pub_date is not null),
found as ({" union all ".join(f"select *, '{a}' as airport from folded where {_sql_any(KEYWORDS)} and {_sql_any(words)}" for a, words in ALIASES.items())}),
uniq as (
  select airport, cast(pub_date as date) as day, link, pub_date, trim(title) as title from found
  qualify row_number() over (partition by airport, cast(pub_date as date), {sql_plain('title')}, link order by pub_date, trim(title)) = 1)"""


@query("keyword_articles", f"with {SQL_ARTICLES} select airport, day, link, title, pub_date from uniq")
def keyword_articles(t: Tables) -> DataFrame:
    found = news.unique_articles(news.relevant(articles(t), ALIASES, KEYWORDS))
    return found.withColumn("pub_date", F.col("pub_date").cast("timestamp_ntz"))


SQL_STRIKES = f"""
{SQL_ARTICLES},
titles as (select day, airport, title, min(pub_date) as seen from uniq where title <> '' group by 1, 2, 3),
labels as (select day, {", ".join(
    f"coalesce(string_agg(title, ' | ' order by seen, title) filter (where airport = '{a}'), '') as l_{a}" for a in ALIASES
)} from titles group by 1),
spine as (select cast(unnest(generate_series(min(pub_date)::date, max(pub_date)::date, interval 1 day)) as date) as date from articles),
strikes as (select date, {", ".join(
    f'''case when coalesce(l_{a}, '') <> '' then 'Oui' else 'Non' end as "GREVE_{a}", coalesce(l_{a}, '') as "LABEL_{a}"''' for a in ALIASES
)} from spine left join labels on day = date)"""


def _strikes(t: Tables) -> DataFrame:
    published = articles(t)
    span = published.agg(F.to_date(F.min("pub_date")).alias("a"), F.to_date(F.max("pub_date")).alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    unique = news.unique_articles(news.relevant(published, ALIASES, KEYWORDS))
    return news.strike_table(spine, news.daily_titles(unique))


@query("keyword_daily", f"with {SQL_STRIKES} select * from strikes")
def keyword_daily(t: Tables) -> DataFrame:
    return _strikes(t)


@query(
    "strike_join",
    f"""with {SQL_STRIKES} select event_id, {", ".join(f'"GREVE_{a}"' for a in ALIASES)}, "LABEL_NICE"
from events left join strikes on date = cast(ts as date) + 10""",
)
def strike_join(t: Tables) -> DataFrame:
    flights = t.events.select("event_id", F.date_add(F.to_date("ts"), 10).cast("string").alias("flight_date"))
    return news.add_strikes(flights, _strikes(t)).select("event_id", *[f"GREVE_{a}" for a in ALIASES], "LABEL_NICE")


def _final_flights(t: Tables) -> DataFrame:
    """Line items with congestion at both ends, a delay that is sometimes missing, and a status."""
    flights = lineitem_flights(t).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flight_date", "airport_origin", "airport_destination",
        "case when l_partkey % 3 > 0 then cast(l_quantity as int) end as arrival_delay_min",
        "case when l_partkey % 5 > 0 then cast(l_quantity as int) - 12 end as departure_delay_min",
        "case o_orderstatus when 'P' then ' Unknown' when 'O' then 'Arrived' end as status",
        "l_linenumber as `NBVols_any`",
    )
    return sign.signoff(flights, cong.lookup_table(cong.flagged(order_traffic(t))))


SQL_FINAL = f"""
{SQL_TRAFFIC}, {sql_flagged('traffic')}, {SQL_FLIGHTS},
final as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, f.flight_date, airport_origin, airport_destination,
    coalesce(case when l_partkey % 3 > 0 then cast(l_quantity as int) end, case when l_partkey % 5 > 0 then cast(l_quantity as int) - 12 end) as arrival_delay_min,
    case o_orderstatus when 'P' then ' Unknown' when 'O' then 'Arrived' end as status,
    coalesce(s.congestion, 0) as congestion_source, coalesce(d.congestion, 0) as congestion_destination
  from flights f left join flagged s on s.flight_date = f.flight_date and s.airport = airport_origin
  left join flagged d on d.flight_date = f.flight_date and d.airport = airport_destination),
labelled as (select *, cast(coalesce(arrival_delay_min > 15, false) as int) as late from final)"""


@query(
    "signoff_table",
    f"""with {SQL_FINAL} select l_orderkey, l_linenumber, l_partkey, l_suppkey, arrival_delay_min, status, congestion_source, congestion_destination,
  late as "retard arrivée" from labelled where coalesce(lower(trim(status)), '') <> 'unknown'""",
)
def signoff_table(t: Tables) -> DataFrame:
    done = sign.finish(_final_flights(t))
    return done.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "arrival_delay_min", "status",
        "congestion_source", "congestion_destination", sign.LABEL,
    )


def _pct(part: str, whole: str) -> str:
    return f"case when {whole} > 0 then {part} / {whole} * 100 else 0 end"


@query(
    "signoff_indicators",
    f"""with {SQL_FINAL},
n as (select count(*) as flights, count(*) filter (where late = 1) as l, count(*) filter (where congestion_source = 1) as s,
  count(*) filter (where congestion_destination = 1) as d, count(*) filter (where congestion_source = 1 and congestion_destination = 1) as b,
  count(*) filter (where congestion_source = 1 and late = 1) as sl, count(*) filter (where congestion_destination = 1 and late = 1) as dl,
  count(*) filter (where lower(trim(status)) = 'unknown') as u from labelled)
select flights, {_pct('l', 'flights')} as pct_late, {_pct('d', 'flights')} as pct_congested_destination, {_pct('s', 'flights')} as pct_congested_source,
  {_pct('b', 'flights')} as pct_congested_both, {_pct('sl', 'l')} as pct_source_when_late, {_pct('dl', 'l')} as pct_destination_when_late,
  {_pct('u', 'flights')} as pct_unknown_status from n""",
)
def signoff_indicators(t: Tables) -> DataFrame:
    return sign.indicators(_final_flights(t))
