"""The corpus operators applied to the supplied tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.llm import decontaminate, embeddings, language, mixing, packing, periodic_runs, quality, simhash, spelling, suffix_array, token_counts, url_filter, warc
from skyloom.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


SQL_MIXING = r"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    md5(concat('7:', coalesce(cast(doc_id as varchar), 'null'))) as place_key
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size,
    [5.0::double, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from d group by source),
tried as (
  select *, greatest(1.5::double * (select sum(source_size) from s)
      - coalesce(sum(source_size * 2.0::double) over (order by source_size / weight range between unbounded preceding and current row exclude group), 0), 0)
    / sum(weight) over (order by source_size / weight range between current row and unbounded following) as level
  from s),
picked as (
  select min(level) as none, arg_min(level, source_size / weight) as level from tried where weight * level <= source_size * 2.0::double),
filled as (
  select source, source_size, case when weight * level > source_size * 2.0::double then source_size * 2.0::double else weight * level end as target
  from s, picked),
quota as (
  select *, case when source_size > 0 then cast(round(target) as bigint) // source_size else 0 end as whole,
    case when source_size > 0 then cast(round(target) as bigint) % source_size else 0 end as rest
  from filled),
upto as (
  select d.*, q.source_size, q.target, q.whole, q.rest,
    sum(size) over (partition by d.source order by place_key, doc_id, size rows unbounded preceding) as upto
  from d join quota q on d.source is not distinct from q.source)
select doc_id, size, source_size, target,
  cast(whole * size + greatest(0, least(size, rest - (upto - size))) as bigint) as taken
from upto"""


@query("op2_source_mixing", SQL_MIXING)
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Sources share one and a half times all words by weights 5, 2, 1; none is repeated more than twice."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents linked by fingerprints at two or fewer differing bits."""
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


SQL_URLS = r"""
with parsed as (
  select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
outcomes as (
  select doc_id as page_id, case when quality = 0 or toxic = 1 then 1 when quality is null or toxic is null then null else 0 end as bad from labels),
hosts as (select host, regexp_extract(host, '([^.]*[.])?[^.]*\z') as domain, regexp_extract(host, '[^.]*\z') as suffix from (select distinct host from parsed)),
h as (
  select host, domain, suffix, count(*)::double as n, sum(bad)::double as k
  from outcomes join (select distinct page_id, host from parsed) using (page_id) join hosts using (host)
  where bad is not null group by all),
d as (select domain, suffix, sum(n) as n, sum(k) as k from h group by all),
s as (select suffix, sum(n) as n, sum(k) as k from d group by all),
tot as (select sum(n) as n, sum(k) as k from s),
children as (
  select 1 as lvl, '' as parent, n, k from s union all select 2, suffix, n, k from d union all select 3, domain, n, k from h),
parents as (
  select lvl, parent, sum(k) / sum(n) as p, sum(n) as n, count(*) as c, sum(n * n) as nn, sum(k * k / n) as kk from children group by all),
moments as (
  select lvl, sum(kk - n * p * p) as spread, sum(p * (1 - p) * (c - 1)) as expected, sum(p * (1 - p) * (n - nn / n - (c - 1))) as room
  from parents group by lvl),
st as (
  select lvl, case when room > 0 then (case when rho * 1000 <= 1 - rho then 1000 else greatest((1 - rho) / rho, 1) end) else 1 end as strength
  from (select lvl, room, greatest((spread - expected) / room, 0) as rho from (select unnest([1, 2, 3]) as lvl) left join moments using (lvl))),
x as (
  select hosts.host, coalesce(h.n, 0) as nh, coalesce(h.k, 0) as kh, coalesce(d.n, 0) as nd, coalesce(d.k, 0) as kd, coalesce(s.n, 0) as ns, coalesce(s.k, 0) as ks
  from hosts left join h using (host) left join d on d.domain = hosts.domain left join s on s.suffix = hosts.suffix),
l0 as (select x.*, tot.n + 1 - ns as w0, (tot.k + 0.5 - ks) / (tot.n + 1 - ns) as m0 from x, tot),
l1 as (select *, greatest(1 / (1 / (s1 + 1) + 1 / (w0 + 1)) - 1, 1) as p1 from l0, (select strength as s1 from st where lvl = 1)),
l1b as (select *, ((ks - kd) + p1 * m0) / ((ns - nd) + p1) as m1, (ns - nd) + p1 as w1 from l1),
l2 as (select *, greatest(1 / (1 / (s2 + 1) + 1 / (w1 + 1)) - 1, 1) as p2 from l1b, (select strength as s2 from st where lvl = 2)),
l2b as (select *, ((kd - kh) + p2 * m1) / ((nd - nh) + p2) as m2, (nd - nh) + p2 as w2 from l2),
l3 as (select *, greatest(1 / (1 / (s3 + 1) + 1 / (w2 + 1)) - 1, 1) as p3 from l2b, (select strength as s3 from st where lvl = 3)),
mh as (select host, (kh + p3 * m2) / (nh + p3) as mean, nh + p3 as weight from l3),
bounds as (select host, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) as bound from mh),
ruled as (
  select *, case
      when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
  from parsed)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block' when bound > 0.25 then 'block' else 'allow' end as verdict
from ruled left join bounds using (host)"""


@query("op10_url_reputation", SQL_URLS)
def url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Pages judged by rules, else by their host; a page counts as bad when its label says low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNull() | F.col("toxic").isNull(), None).otherwise(0)
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    judged = url_filter.judge(table(spark, folder, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op1_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of which tiles cover at least half of a benchmark item."""
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "contaminated", "item_id", "coverage", "n_items")


@query("op4_embedding_near_duplicates")
def embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label linked by a cosine of 0.98 or more."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings").withColumnRenamed("embedding", "vector"))


def held_out(parts: int, part: int):
    """Whether a document's id falls in the part that is not learned from; false for a null id."""
    return F.coalesce(fold(F.col("doc_id"), parts) == part, F.lit(False))


@query("op7_quality")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels of four fifths of the ids."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    known = labels.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = quality.train(quality.labelled_rows(docs, known))
    return quality.score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query("op9_language")
def languages(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of the ids."""
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    return language.identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query("op3_repeated_strings")
def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document covered by a string of 200 bytes that also starts elsewhere."""
    found = suffix_array.deduplicate(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def sample_edits():
    """Three edits that each document's id and text give: up to 40 characters are replaced by up to 40 from elsewhere in it."""
    length = F.length("text")

    def one(turn: int):
        draw = lambda k, most: F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit(turn), F.lit(k)), most).cast("int")
        taken = F.substring(F.col("text"), draw(1, length + 1) + 1, draw(2, F.lit(41)))
        return F.struct(draw(3, length + 1).alias("start"), draw(4, F.lit(41)).alias("length"), taken.alias("insert"))

    return F.array(*[one(turn) for turn in range(3)])


@query("op6_token_counts")
def edited_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after three edits."""
    ranks = token_counts.ranks_of()
    trees = token_counts.build(table(spark, folder, "documents"), ranks).withColumn("edits", sample_edits())
    found = token_counts.apply_edits(trees, ranks)
    return found.select("doc_id", "tokens_before", F.col("n_tokens").alias("tokens_after"), F.size("tree.tokens").alias("pieces_after"), "encoded")


@query("op8_warc_derivatives")
def warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and conversion records of the response to every page."""
    found = warc.derive(warc.responses_of(table(spark, folder, "pages")))
    return found.select(
        "record_id", "record_type", "refers_to", "target_uri", "date", "content_type", F.length("content").cast("long").alias("content_length"),
        F.col("headers")["WARC-Block-Digest"].alias("block_digest"), F.col("headers")["WARC-Source-Payload-Digest"].alias("payload_digest"), F.col("content").cast("string").alias("content"),
    )


@query("op12_periodic_runs")
def periodic_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words of every whole document that repeat a block at least four times, and the text with each run cut to one block."""
    found = periodic_runs.periodic_runs(table(spark, folder, "documents"))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@query("op13_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens and separator, cut to 2,048 only where longer, packed into as few sequences of 2,048 as the search finds."""
    found = packing.pack(table(spark, folder, "documents"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op11_spelling_variants")
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of seven or more letters seen twice or more, with its near words and the common form it varies."""
    return spelling.spelling_variants(table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
