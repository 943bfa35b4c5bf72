"""Requests matched to flights, scored, and streamed."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import LINE_ORDER, Tables, airport_of, query, sql_airport
from skyloom.checks.model import FEATURES, fitted_pair
from skyloom.operators import congestion as cong
from skyloom.operators.matching import codeshare_only, match, matches_number, prepared
from skyloom.plans import scoring as sc
from skyloom.functions.text import valid_request
from skyloom.functions.values import risk_band
from skyloom.session import shared_folder, stored
from skyloom.streaming import requests as rs

ORDER = [*LINE_ORDER, "l_orderkey", "l_linenumber"]
_ORDER = ", ".join(ORDER)


def flights(t: Tables) -> DataFrame:
    clock = "date_format(l_shipdate + make_interval(0,0,0,0,0,cast(l_partkey * 7 % 1440 as int)), \"yyyy-MM-dd HH:mm'+02:00'\")"
    return t.lineitem.select(
        *ORDER,
        F.concat(F.lit("ZZ "), "l_suppkey").alias("flight_number"),
        F.expr("case when l_partkey % 4 = 0 then array(concat('yy ', l_partkey % 100)) else array() end").alias("codeshares"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("flight_date"),
        airport_of(F.col("l_partkey")).alias("airport_origin"),
        airport_of(F.col("l_orderkey")).alias("airport_destination"),
        F.expr(f"case when l_linenumber = 7 then null else {clock} end").alias("scheduled_departure"),
    )


def requests(t: Tables) -> DataFrame:
    """Every order asks for a flight; some give a day only, some name a codeshare."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        F.expr("concat(case when o_orderkey % 3 > 0 then 'zz' else 'YY ' end, o_custkey % 100)").alias("flight_number"),
        F.expr(
            """concat(date_format(o_orderdate, 'yyyy-MM-dd'), case when o_orderkey % 10 = 0 then '' else
            concat('T', lpad(o_orderkey % 24, 2, '0'), ':', lpad(o_custkey % 60, 2, '0'), ':00') end)"""
        ).alias("date"),
        F.concat(airport_of(F.col("o_custkey")), F.lit(" - somewhere")).alias("departure_airport"),
        F.when(F.col("o_orderkey") % 4 > 0, airport_of(F.col("o_orderkey"))).alias("arrival_airport"),
    )


SQL_MATCH = f"""
flights as (
  select row_number() over (order by {_ORDER}) as place, 'ZZ ' || l_suppkey as flight_number, 'ZZ' || l_suppkey as principal,
    case when l_partkey % 4 = 0 then 'YY' || (l_partkey % 100) end as codeshare, strftime(l_shipdate, '%Y-%m-%d') as day,
    {sql_airport('l_partkey')} as o, {sql_airport('l_orderkey')} as d, case when l_linenumber <> 7 then l_partkey * 7 % 1440 end as minute,
    case when l_linenumber <> 7 then strftime(l_shipdate + to_minutes(l_partkey * 7 % 1440), '%Y-%m-%d %H:%M') || '+02:00' end as scheduled_departure
  from lineitem),
cand as (select principal as number, * from flights union all select codeshare, * from flights where codeshare is not null),
asked as (
  select cast(o_orderkey as varchar) as request_id, case when o_orderkey % 3 > 0 then 'ZZ' else 'YY' end || (o_custkey % 100) as number,
    strftime(o_orderdate, '%Y-%m-%d') as day, case when o_orderkey % 10 > 0 then o_orderkey % 24 * 60 + o_custkey % 60 end as asked_minute,
    {sql_airport('o_custkey')} as origin, case when o_orderkey % 4 > 0 then {sql_airport('o_orderkey')} end as destination from orders),
p1 as (select a.*, c.* exclude (number, day), abs(minute - asked_minute) as gap, o = origin as ok_o, coalesce(d = destination, false) as ok_d
  from asked a join cand c on c.number = a.number and c.day = a.day),
p2 as (select * from p1 qualify ok_o or not bool_or(ok_o) over (partition by request_id)),
p3 as (select * from p2 qualify ok_d or not bool_or(ok_d) over (partition by request_id)),
best as (select *, min(gap) over (partition by request_id) as best_gap,
  row_number() over (partition by request_id order by gap nulls last, place) as r_gap, row_number() over (partition by request_id order by place) as r_place from p3),
picked as (select * from best where case when best_gap is null then r_place = 1 else r_gap = 1 end),
matched as (
  select request_id, case when p.request_id is null then 'error_flight_not_found' when best_gap > 30 then 'error_time_mismatch'
      when principal <> a.number then 'success_with_warning_codeshare' else 'success' end as status,
    case when p.request_id is null then 'FLIGHT_NOT_FOUND' when best_gap > 30 then 'TIME_MISMATCH' end as error_code,
    case when coalesce(best_gap, 0) <= 30 then flight_number end as matched_flight_number,
    case when coalesce(best_gap, 0) <= 30 then scheduled_departure end as matched_scheduled_departure,
    case when coalesce(best_gap, 0) <= 30 then o end as matched_departure_airport,
    case when coalesce(best_gap, 0) <= 30 then d end as matched_arrival_airport, cast(best_gap as int) as best_time_diff_minutes
  from asked a left join picked p using (request_id))"""


@query("request_match", f"with {SQL_MATCH} select * from matched")
def request_match(t: Tables) -> DataFrame:
    return match(requests(t), flights(t), ORDER)


@query("request_outcomes", f"with {SQL_MATCH} select status, count(*) as n from matched group by 1")
def request_outcomes(t: Tables) -> DataFrame:
    return match(requests(t), flights(t), ORDER).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "codeshare_match",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  'ZZ' || l_suppkey = 'YY' || (l_orderkey % 100) or (l_partkey % 4 = 0 and l_partkey % 100 = l_orderkey % 100) as matches,
  l_partkey % 4 = 0 and l_partkey % 100 = l_orderkey % 100 as codeshare from lineitem""",
)
def codeshare_match(t: Tables) -> DataFrame:
    wanted = F.concat(F.lit("yy "), F.col("l_orderkey") % 100)
    args = F.col("flight_number"), F.col("codeshares"), wanted
    return flights(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        matches_number(*args).alias("matches"), codeshare_only(*args).alias("codeshare"),
    )


@query(
    "request_check",
    f"""select cast(o_orderkey as varchar) as request_id,
  ({sql_airport('o_custkey')} || ' - somewhere') is distinct from case when o_orderkey % 4 > 0 then {sql_airport('o_orderkey')} end as valid from orders""",
)
def request_check(t: Tables) -> DataFrame:
    ok = valid_request(F.col("flight_number"), F.col("departure_airport"), F.col("arrival_airport"))
    return requests(t).select("request_id", ok.alias("valid"))


@query(
    "reply_table",
    f"""
with r as (
  select l_orderkey as request, {_ORDER}, 'ZZ ' || l_suppkey as flight_number_principal, case when l_partkey % 4 = 0 then 'yy ' || (l_partkey % 100) else '' end as flight_number_codeshare,
    case l_returnflag when 'A' then 'departure' when 'R' then 'arrival' else 'none' end as kind, {sql_airport('l_partkey')} as o, {sql_airport('l_orderkey')} as d,
    case when l_linenumber <> 7 then strftime(l_shipdate + to_minutes(l_partkey * 7 % 1440), '%Y-%m-%d %H:%M') || '+02:00' end as s from lineitem),
home as (select request, first(o order by s nulls last, o) as h from r group by 1),
n as (select request, case kind when 'departure' then o else d end as a, count(*) filter (where kind = 'arrival') as x, count(*) filter (where kind = 'departure') as y
  from r where kind <> 'none' group by 1, 2)
select {_ORDER}, flight_number_principal, flight_number_codeshare, coalesce(x, 0) as total_global_arrivals_at_airport,
  coalesce(y, 0) as total_global_departures_from_airport from r join home using (request) left join n on n.request = r.request and a = h""",
)
def reply_table(t: Tables) -> DataFrame:
    kind = F.expr("case l_returnflag when 'A' then 'departure' when 'R' then 'arrival' else 'none' end")
    records = flights(t).withColumns(
        {"request": F.col("l_orderkey"), "movement_type": kind, "movement_date": F.col("flight_date")}
    )
    return cong.reply_table(records, "request").select(
        *ORDER, "flight_number_principal", "flight_number_codeshare",
        "total_global_arrivals_at_airport", "total_global_departures_from_airport",
    )


def _known(t: Tables) -> DataFrame:
    """Flights as answers name them, with what the models need of each."""
    return flights(t).selectExpr(
        "flight_number", "scheduled_departure", "airport_origin", "airport_destination", *ORDER,
        "l_returnflag as flag", "l_linestatus as status_code",
    )


def _scored(answers: DataFrame, known: DataFrame, models) -> DataFrame:
    classifier, regressor = models
    found = sc.answered_rows(answers, known, ORDER)
    rows = found.withColumnsRenamed({"status": "outcome", "status_code": "status"})
    rows = rows.withColumn("matched", F.col("matched_flight_number").isNotNull())
    rows = rows.select("request_id", "outcome", "matched", *[c for c in rows.columns if c in FEATURES])
    return sc.predictions(rows, ["request_id", "outcome"], classifier[0], classifier[1], regressor[0], regressor[1], "matched")


@query("score_requests", f"with {SQL_MATCH} select request_id, status as outcome, matched_flight_number is not null as scored, true as sound from matched")
def score_requests(t: Tables) -> DataFrame:
    """Every order's request matched and its flight scored by both models; those without a flight have no score.

    A score is sound when the probability and the minutes are in their ranges and flag and band follow from them.
    """
    models = fitted_pair(t)
    found = _scored(stored(match(requests(t), flights(t), ORDER)), _known(t), models)
    minutes = F.col("predicted_arrival_delay_minutes")
    sound = F.col("delay_probability").between(0, 1) & (minutes >= 0) & (F.col("is_delayed") == (F.col("delay_probability") > 0.5)) & (F.col("risk") == risk_band(minutes))
    return found.select("request_id", "outcome", F.col("delay_probability").isNotNull().alias("scored"), F.coalesce(sound, F.lit(True)).alias("sound"))


@query("request_stream", f"with {SQL_MATCH} select *, error_code is null as answered from matched")
def request_stream(t: Tables) -> DataFrame:
    """The requests landed as JSON files and answered as a stream; same answers as the batch.

    They carry different times, a tenth of them comes twice, and each batch is scored by a rule.
    """
    folder = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    asked = requests(t)
    at = F.timestamp_seconds(F.lit(1767225600) + F.col("request_id").cast("long") % 3000)
    landed = asked.unionByName(asked.where(F.col("request_id").cast("long") % 10 == 0)).withColumn(rs.EVENT_TIME, at)
    landed.repartition(4, "request_id").write.json(f"{folder}/in")
    job = rs.answer_stream(
        rs.read_requests(t.spark, f"{folder}/in"), flights(t), ORDER, f"{folder}/out", f"{folder}/state",
        score=lambda answers: answers.withColumn("answered", F.col("error_code").isNull()),
    )
    job.awaitTermination()
    return rs.read_answers(t.spark, f"{folder}/out")


SCORES = ["delay_probability", "predicted_arrival_delay_minutes", "is_delayed", "risk"]


@query(
    "request_stream_models",
    f"with {SQL_MATCH} select request_id, status as outcome, matched_flight_number is not null as scored, true as same from matched",
)
def request_stream_models(t: Tables) -> DataFrame:
    """The request stream scored by both fitted models, loaded from the shared folder by each batch writer.

    Requests land in two waves of files, one file a batch; a tenth of the ids comes again in the other wave, and the
    second wave's times reach back before the first's. The second batch fails once half-way through its write; the
    job is started again on its checkpoint and writes that batch anew. After the second wave lands the job is
    started a third time. ``same``: the stream's scores equal those of scoring the whole table with the same models.
    """
    folder = f"{shared_folder(t.spark)}/stream-models-{uuid.uuid4().hex}"
    # The three starts read one table of candidates, the batches one table of known flights; they are laid out while the fits run.
    with ThreadPoolExecutor(2) as pool:
        offering = pool.submit(inheritable_thread_target(prepared), flights(t), ORDER)
        knowing = pool.submit(inheritable_thread_target(stored), _known(t))
        rs.save_models(f"{folder}/models", *fitted_pair(t))
        offered, known = offering.result(), knowing.result()
    asked = requests(t)
    key = F.col("request_id").cast("long")
    at = F.timestamp_seconds(F.lit(1767225600) + (key * 7919) % 3000)
    first = asked.where(key % 2 == 0).unionByName(asked.where(key % 20 == 1))
    second = asked.where(key % 2 == 1).unionByName(asked.where(key % 20 == 0))
    marker = f"{folder}/fail-once"
    t.spark.createDataFrame([(1,)], "x int").write.parquet(marker)

    def score(answers: DataFrame, models) -> DataFrame:
        found = _scored(answers, known, models)
        jvm = t.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(marker)
        system = path.getFileSystem(t.spark._jsc.hadoopConfiguration())
        if system.exists(path) and answers.count():  # a batch with rows, first attempt: fail while writing
            system.delete(path, True)
            return found.withColumn("request_id", F.when(F.col("request_id").cast("long") % 2 == 1, F.raise_error(F.lit("lost in the write"))).otherwise(F.col("request_id")))
        return found

    def run() -> None:
        job = rs.answer_stream(
            rs.read_requests(t.spark, f"{folder}/in", files_per_batch=1), flights(t), ORDER, f"{folder}/out", f"{folder}/state",
            score=rs.model_scorer(f"{folder}/models", score), offered=offered,
        )
        job.awaitTermination()

    first.withColumn(rs.EVENT_TIME, at).repartition(4, "request_id").write.mode("append").json(f"{folder}/in")
    try:
        run()
    except Exception as error:  # the injected failure ends the first start
        if "lost in the write" not in str(error):
            raise
    run()
    second.withColumn(rs.EVENT_TIME, at - F.expr("INTERVAL 10 MINUTES")).repartition(4, "request_id").write.mode("append").json(f"{folder}/in")
    run()
    streamed = rs.read_answers(t.spark, f"{folder}/out")
    batch = _scored(stored(match(requests(t), flights(t), ORDER)), _known(t), rs.load_models(t.spark, f"{folder}/models"))
    both = streamed.select("request_id", *[F.col(c).alias(f"s_{c}") for c in SCORES]).join(batch, "request_id", "full")
    same = F.lit(True)
    for c in SCORES:
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(c))
    return both.select("request_id", "outcome", F.col("delay_probability").isNotNull().alias("scored"), same.alias("same"))
