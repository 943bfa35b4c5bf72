"""Registry of queries, table access, and the roles columns play in several queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The supplied tables of one scale."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under a name, with its SQL twin when there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# Airports played by numbers: six served ones and two others.
CODES = ("CDG", "ORY", "LYS", "NCE", "MRS", "TLS", "JFK", "LHR")
SQL_CODES = "[" + ", ".join(f"'{c}'" for c in CODES) + "]"


def airport_of(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CODES]), (number % len(CODES) + 1).cast("int"))


def sql_airport(number: str) -> str:
    return f"{SQL_CODES}[cast({number} % {len(CODES)} + 1 as int)]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def day_text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def lineitem_movements(t: Tables) -> DataFrame:
    """Line items as movements: supplier's nation to customer's nation on the ship date."""
    customer = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_nationkey"
    )
    return (
        t.lineitem.join(customer, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            day_text("l_shipdate").alias("movement_date"),
            F.expr("case l_returnflag when 'A' then 'departure' when 'R' then 'arrival' else 'none' end").alias("movement_type"),
            airport_of(F.col("s_nationkey")).alias("airport_origin"),
            airport_of(F.col("c_nationkey")).alias("airport_destination"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        )
    )


SQL_MOVEMENTS = f"""
movements as (
  select strftime(l_shipdate, '%Y-%m-%d') as movement_date,
    case l_returnflag when 'A' then 'departure' when 'R' then 'arrival' else 'none' end as movement_type,
    {sql_airport('s_nationkey')} as airport_origin, {sql_airport('c_nationkey')} as airport_destination,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
)"""

SERVED = "('CDG','ORY','LYS','NCE','MRS','TLS')"
PARIS = "('CDG','ORY')"
REGIONAL = "('LYS','NCE','MRS','TLS')"
SQL_TARGET = (
    f"((airport_origin in {PARIS} and airport_destination in {REGIONAL})"
    f" or (airport_origin in {REGIONAL} and airport_destination in {PARIS}))"
)
SQL_DOMESTIC = f"(airport_origin in {SERVED} and airport_destination in {SERVED})"
SQL_SERVED = f"(airport_origin in {SERVED} or airport_destination in {SERVED})"


def order_traffic(t: Tables) -> DataFrame:
    """Orders per day and nation: open ones as departures, others as arrivals."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(day_text("o_orderdate").alias("flight_date"), F.col("n_name").alias("airport"))
        .agg(
            F.count_if(F.col("o_orderstatus") == "O").cast("int").alias("nombre_departs"),
            F.count_if(F.col("o_orderstatus") != "O").cast("int").alias("nombre_arrivees"),
        )
    )


SQL_TRAFFIC = """
traffic as (
  select strftime(o_orderdate, '%Y-%m-%d') as flight_date, n_name as airport,
    cast(count(*) filter (where o_orderstatus = 'O') as int) as nombre_departs,
    cast(count(*) filter (where o_orderstatus <> 'O') as int) as nombre_arrivees
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  group by 1, 2
)"""


def sql_flagged(source: str, threshold: float = 20) -> str:
    return f"""
summed as (select *, nombre_departs + nombre_arrivees as somme_depart_arrivee from {source}),
deviation as (
  select *, round_even(100 * (somme_depart_arrivee - avg(somme_depart_arrivee) over (partition by airport))
    / nullif(avg(somme_depart_arrivee) over (partition by airport), 0), 2) as pourcentage_ecart_moyenne
  from summed),
flagged as (
  select *, cast(coalesce(pourcentage_ecart_moyenne > {threshold}, false) as int) as congestion from deviation)"""


def lineitem_flights(t: Tables) -> DataFrame:
    """Line items as flights from the supplier's nation to the customer's."""
    names = t.nation.select("n_nationkey", F.upper("n_name").alias("n_name"))
    customer = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(names, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderstatus", "o_orderdate", F.col("n_name").alias("airport_destination"))
    )
    supplier = t.supplier.join(names, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("airport_origin")
    )
    return (
        t.lineitem.join(customer, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
            "o_orderstatus", "o_orderdate", "l_shipdate",
            day_text("l_shipdate").alias("flight_date"), "airport_origin", "airport_destination",
        )
    )


SQL_FLIGHTS = """
flights as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
    o_orderstatus, o_orderdate, l_shipdate, strftime(l_shipdate, '%Y-%m-%d') as flight_date,
    upper(sn.n_name) as airport_origin, upper(cn.n_name) as airport_destination
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation cn on c_nationkey = cn.n_nationkey
  join supplier on l_suppkey = s_suppkey join nation sn on s_nationkey = sn.n_nationkey
)"""

# Columns that tell line items apart (orders and line numbers repeat).
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
