"""Tables written in each file format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import Tables, query
from skyloom.sources import articles, files
from skyloom.session import shared_folder


def _folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}"


@query("csv_comma", "select c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, '') as c_mktsegment from customer")
def csv_comma(t: Tables) -> DataFrame:
    path = _folder(t)
    files.write_csv(t.customer, path)
    return files.read_csv(t.spark, path, t.customer.schema)


@query(
    "csv_semicolon",
    "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey from customer",
)
def csv_semicolon(t: Tables) -> DataFrame:
    path = _folder(t)
    spaced = t.customer.select(
        F.col("c_custkey").alias(" c_custkey"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name "), "c_nationkey"
    )
    spaced.write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return files.read_csv(t.spark, path, sep=";", trim=True)


@query(
    "csv_stamp",
    "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, o_orderpriority from orders",
)
def csv_stamp(t: Tables) -> DataFrame:
    """An older file: its first data row is a generation stamp."""
    path = _folder(t)
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")
    stamp = t.spark.createDataFrame([("DATE_GENERATION", "2026-04-16 23:30:18", None)], rows.schema)
    files.write_csv(stamp.unionByName(rows), path)
    return files.without_stamp(files.read_csv(t.spark, path))


@query(
    "files_of_a_kind",
    """select cast(c_custkey as varchar) as id, c_name as name, null::varchar as balance from customer
union all select cast(s_suppkey as varchar), s_name, cast(cast(s_acctbal * 100 as bigint) as varchar) from supplier""",
)
def files_of_a_kind(t: Tables) -> DataFrame:
    path = _folder(t)
    files.write_csv(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), f"{path}/a")
    cents = F.round(F.col("s_acctbal") * 100).cast("bigint").alias("balance")
    files.write_csv(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), cents), f"{path}/b")
    return files.read_all(t.spark, [[f"{path}/a"], [f"{path}/b"]])


@query(
    "layers",
    """select o_orderkey, o_totalprice * 2 as o_totalprice from orders""",
)
def layers(t: Tables) -> DataFrame:
    """A run written twice: the second replaces the first, other runs stay."""
    root = _folder(t)
    rows = t.orders.select("o_orderkey", "o_totalprice")
    files.write_layer(rows, root, "processed", "2026-04-20", "r0")
    files.write_layer(rows, root, "processed", "2026-04-21", "r1")
    files.write_layer(rows.withColumn("o_totalprice", F.col("o_totalprice") * 2), root, "processed", "2026-04-21", "r1")
    return files.read_layer(t.spark, root, "processed", "2026-04-21", "r1").select("o_orderkey", "o_totalprice")


@query(
    "latest_file",
    "select count(*) as n_rows from customer",
)
def latest_file(t: Tables) -> DataFrame:
    root = _folder(t)
    t.orders.select("o_orderkey").coalesce(1).write.parquet(f"{root}/2026-04-20")
    t.customer.select("c_custkey").coalesce(1).write.parquet(f"{root}/2026-04-21")
    newest = files.latest_file(t.spark, root, "*.parquet", by="name")
    return files.read_table(t.spark, newest).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "feed_articles",
    """select 'Order ' || o_orderkey as title, 'http://x/' || o_custkey as link, o_orderdate + to_minutes(o_orderkey % 1440) as pub_date,
  o_orderpriority as description, o_orderstatus as source from orders""",
)
def feed_articles(t: Tables) -> DataFrame:
    path = _folder(t)
    at = F.timestamp_add("MINUTE", (F.col("o_orderkey") % 1440).cast("int"), F.col("o_orderdate"))
    items = t.orders.select(
        F.concat(F.lit("Order "), "o_orderkey").alias("title"),
        F.concat(F.lit("http://x/"), "o_custkey").alias("link"),
        F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("pubDate"),
        F.col("o_orderpriority").alias("description"),
        F.struct(F.col("o_orderstatus").alias("_VALUE"), F.lit("http://y").alias("_url")).alias("source"),
    )
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    feed = articles.read_feeds(t.spark, path)
    return feed.withColumn("pub_date", F.col("pub_date").cast("timestamp_ntz"))
