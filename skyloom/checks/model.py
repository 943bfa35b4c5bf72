"""Model inputs, metrics, rankings and fits."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from skyloom.checks.base import SQL, Tables, query, quote
from skyloom.operators import features as ft
from skyloom.operators import metrics as mt
from skyloom.operators import ranking as rk
from skyloom.plans import training as tr
from skyloom.session import shared_folder, stored


def _sql_hash(key: str, seed: int = 42) -> str:
    return f"md5({key} || '|' || '{seed}')"


def _coded_orders(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey", "case when o_orderkey % 5 > 0 then o_orderstatus end as status", "o_orderpriority as priority",
        "date_format(o_orderdate, 'yyyy-MM-dd') as day",
    )


_CATEGORIES = ("status", "priority", "day")


@query(
    "ordinal_encode",
    f"""
with o as (select o_orderkey, coalesce(case when o_orderkey % 5 > 0 then o_orderstatus end, 'nan') as status, o_orderpriority as priority,
  strftime(o_orderdate, '%Y-%m-%d') as day, row_number() over (order by {_sql_hash('o_orderkey')}) as r, count(*) over () as n from orders),
train as (select * from o where r > ceil(0.2 * n)),
{", ".join(f"c_{c} as (select {c} as v, cast(row_number() over (order by {c}) - 1 as double) as code from (select distinct {c} from train))" for c in _CATEGORIES)}
select o_orderkey, {", ".join(f"coalesce(c_{c}.code, -1) as {c}" for c in _CATEGORIES)}
from o {" ".join(f"left join c_{c} on c_{c}.v = o.{c}" for c in _CATEGORIES)}""",
)
def ordinal_encode(t: Tables) -> DataFrame:
    orders = _coded_orders(t)
    train, _ = ft.split(orders, ["o_orderkey"])
    return ft.apply_codes(orders, ft.fit_codes(train, _CATEGORIES), _CATEGORIES)


@query(
    "median_impute",
    """
with p as (select p_partkey, case when p_partkey % 4 > 0 then p_size end as size, case when p_partkey % 7 > 0 then p_retailprice end as price from part)
select p_partkey, coalesce(size, (select quantile_cont(size, 0.5) from p)) as size, coalesce(price, (select quantile_cont(price, 0.5) from p)) as price from p""",
)
def median_impute(t: Tables) -> DataFrame:
    p = t.part.selectExpr(
        "p_partkey", "case when p_partkey % 4 > 0 then p_size end as size", "case when p_partkey % 7 > 0 then p_retailprice end as price"
    )
    return ft.impute(p, ft.medians(p, ["size", "price"]).first().asDict())


@query(
    "medians",
    """select quantile_cont(l_quantity, 0.5) as l_quantity, quantile_cont(l_extendedprice, 0.5) as l_extendedprice,
  quantile_cont(l_discount, 0.5) as l_discount, quantile_cont(cast(l_partkey as double), 0.5) as l_partkey from lineitem""",
)
def medians(t: Tables) -> DataFrame:
    return ft.medians(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"])


@query("medians_bracketed", SQL["medians"])
def medians_bracketed(t: Tables) -> DataFrame:
    """The same medians narrowed in brackets, as for a large table."""
    return ft.medians(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"], exact_rows=100)


@query(
    "one_hot",
    """
with o as (select o_orderkey, coalesce(case when o_orderkey % 6 > 0 then o_orderpriority end, 'Unknown') as p from orders),
c as (select p, row_number() over (order by p) - 1 as slot from (select distinct p from o))
select o_orderkey, [cast(s = slot as double) for s in range((select count(*) from c))] as hot from o join c using (p)""",
)
def one_hot(t: Tables) -> DataFrame:
    o = ft.unknown_for_missing(
        t.orders.selectExpr("o_orderkey", "case when o_orderkey % 6 > 0 then o_orderpriority end as priority"), ["priority"]
    )
    return ft.one_hot(["priority"]).fit(o).transform(o).select("o_orderkey", vector_to_array("priority_hot").alias("hot"))


@query(
    "split",
    f"""select o_orderkey, case when row_number() over (partition by o_orderstatus order by {_sql_hash('o_orderkey')})
  <= ceil(0.2 * count(*) over (partition by o_orderstatus)) then 'test' else 'train' end as part from orders""",
)
def split(t: Tables) -> DataFrame:
    train, test = ft.split(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], by="o_orderstatus")
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("part"))
    )


_SQL_STATUS = "case when o_orderkey % 10 > 0 then o_orderstatus end"


def _with_missing_status(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", f"{_SQL_STATUS} as status")


@query(
    "split_missing_stratum",
    f"""select o_orderkey, case when row_number() over (partition by {_SQL_STATUS} order by {_sql_hash('o_orderkey')})
  <= ceil(0.2 * count(*) over (partition by {_SQL_STATUS})) then 'test' else 'train' end as part from orders""",
)
def split_missing_stratum(t: Tables) -> DataFrame:
    """Rows without a stratum are a stratum; the cuts are narrowed in several rounds, as for a large table."""
    train, test = ft.split(_with_missing_status(t), ["o_orderkey"], by="status", exact_cell=1)
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(test.select("o_orderkey", F.lit("test").alias("part")))


@query(
    "folds_missing_stratum",
    f"""
with r as (select o_orderkey, row_number() over (partition by {_SQL_STATUS} order by {_sql_hash('o_orderkey')}) as r,
  count(*) over (partition by {_SQL_STATUS}) as n from orders)
select o_orderkey, cast((r > ceil(0.2 * n)) as int) + cast((r > ceil(0.4 * n)) as int) + cast((r > ceil(0.6 * n)) as int) + cast((r > ceil(0.8 * n)) as int) as fold from r""",
)
def folds_missing_stratum(t: Tables) -> DataFrame:
    return ft.folds(_with_missing_status(t), ["o_orderkey"], by="status").drop("status")


@query(
    "folds",
    f"""
with r as (select o_orderkey, row_number() over (partition by o_orderstatus order by {_sql_hash('o_orderkey')}) as r,
  count(*) over (partition by o_orderstatus) as n from orders)
select o_orderkey, cast((r > ceil(0.2 * n)) as int) + cast((r > ceil(0.4 * n)) as int) + cast((r > ceil(0.6 * n)) as int) + cast((r > ceil(0.8 * n)) as int) as fold from r""",
)
def folds(t: Tables) -> DataFrame:
    return ft.folds(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], by="o_orderstatus").drop("o_orderstatus")


@query("seeded_sample", f"select o_orderkey, o_totalprice from orders order by {_sql_hash('o_orderkey')} limit 100")
def seeded_sample(t: Tables) -> DataFrame:
    return ft.seeded_sample(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)


NUMBERS = ("l_quantity", "l_extendedprice", "l_tax", "l_linenumber", "l_partkey", "l_constant")


def _numbers(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_quantity", "l_extendedprice", "case when l_partkey % 3 > 0 then l_tax end as l_tax", "l_linenumber", "l_partkey",
        "1.0D as l_constant", "cast(l_quantity > 15 as int) as late",
    )


SQL_NUMBERS = """
n as (select l_quantity, l_extendedprice, case when l_partkey % 3 > 0 then l_tax end as l_tax, l_linenumber, l_partkey,
  1.0::double as l_constant, cast(l_quantity > 15 as int) as late from lineitem),
c as ({})""".format(
    " union all ".join(
        f"select '{c}' as raw_feature, coalesce(case when stddev_pop({c}) > 0 then corr({c}, late) end, 0) as corr_with_target from n" for c in NUMBERS
    )
)


@query(
    "correlations",
    f"with {SQL_NUMBERS} select raw_feature, round(corr_with_target, 8) as corr_with_target, round(abs(corr_with_target), 8) as abs_corr from c",
)
def correlations(t: Tables) -> DataFrame:
    table = rk.by_strength(rk.correlations(_numbers(t), NUMBERS, "late"), "corr_with_target", "raw_feature")
    return table.select("raw_feature", F.round("corr_with_target", 8).alias("corr_with_target"), F.round("abs_corr", 8).alias("abs_corr"))


_FLAGS = ("A", "N", "R")


def _importance(t: Tables) -> DataFrame:
    """Shares in the line items as importances of encoded features."""
    row = t.lineitem.agg(
        *[F.avg((F.col("l_returnflag") == f).cast("double")).alias(f"cat__l_returnflag_{f}") for f in _FLAGS],
        *[(F.avg(c) / F.max(c)).alias(f"num__{c}") for c in ("l_quantity", "l_tax", "l_partkey")],
    )
    return row.unpivot([], row.columns, "encoded_feature", "importance")


SQL_IMPORTANCE = """
i as (select 'l_returnflag' as raw_feature, {} as importance from lineitem union all {})""".format(
    " + ".join(f"avg(cast(l_returnflag = '{f}' as double))" for f in _FLAGS),
    " union all ".join(f"select '{c}', avg({c}) / max({c}) from lineitem" for c in ("l_quantity", "l_tax", "l_partkey")),
)
_COLUMNS = ["l_returnflag", "l_return", "l_quantity", "l_tax", "l_partkey"]


@query(
    "feature_rank",
    f"""with {SQL_NUMBERS}, {SQL_IMPORTANCE},
j as (select coalesce(c.raw_feature, i.raw_feature) as raw_feature, coalesce(corr_with_target, 0) as corr_with_target,
  coalesce(abs(corr_with_target), 0) as abs_corr, coalesce(importance, 0) as importance from c full join i using (raw_feature)),
s as (select *, (abs_corr - min(abs_corr) over ()) / (max(abs_corr) over () - min(abs_corr) over ()) as cn,
  (importance - min(importance) over ()) / (max(importance) over () - min(importance) over ()) as im from j)
select raw_feature, round(corr_with_target, 8) as corr_with_target, round(importance, 8) as importance, round(0.7 * im + 0.3 * cn, 8) as final_score
from s order by 0.7 * im + 0.3 * cn desc, raw_feature limit 20""",
)
def feature_rank(t: Tables) -> DataFrame:
    scored = rk.combined(rk.correlations(_numbers(t), NUMBERS, "late"), rk.summed_importance(_importance(t), _COLUMNS))
    rounded = [F.round(c, 8).alias(c) for c in ("corr_with_target", "importance", "final_score")]
    return rk.top(scored, 20).select("raw_feature", *rounded)


@query(
    "feature_rank_by_max",
    f"""with {SQL_NUMBERS}, {SQL_IMPORTANCE},
j as (select raw_feature, abs(corr_with_target) as abs_corr, importance from c join i using (raw_feature))
select raw_feature, round(0.7 * importance / max(importance) over () + 0.3 * abs_corr / max(abs_corr) over (), 8) as final_score from j""",
)
def feature_rank_by_max(t: Tables) -> DataFrame:
    scored = rk.combined_by_max(rk.correlations(_numbers(t), NUMBERS, "late"), rk.summed_importance(_importance(t), _COLUMNS))
    return scored.select("raw_feature", F.round("final_score", 8).alias("final_score"))


def _judged(t: Tables) -> DataFrame:
    """A fixed rule as the prediction, so that SQL can follow."""
    return t.lineitem.selectExpr(
        "cast(l_tax > 0.04D as int) as label", "cast(l_discount > 0.05D as double) as prediction", "l_discount as probability",
        "l_linenumber", "l_quantity", "l_quantity * (0.9D + l_tax) as guess",
    )


SQL_JUDGED = """
j as (select cast(l_tax > 0.04 as int) as label, cast(l_discount > 0.05 as int) as prediction, l_discount as probability,
  l_linenumber, l_quantity, l_quantity * (0.9::double + l_tax) as guess from lineitem)"""


def _sql_metrics(where: str = "true") -> str:
    return f"""
  count(*) filter (where ({where}) and label = prediction) / count(*) filter (where {where}) as accuracy,
  count(*) filter (where ({where}) and label = 1 and prediction = 1) / count(*) filter (where ({where}) and prediction = 1) as "precision",
  count(*) filter (where ({where}) and label = 1 and prediction = 1) / count(*) filter (where ({where}) and label = 1) as recall,
  2 * count(*) filter (where ({where}) and label = 1 and prediction = 1) / (count(*) filter (where ({where}) and prediction = 1) + count(*) filter (where ({where}) and label = 1)) as f1"""


@query("class_metrics", f"with {SQL_JUDGED} select {_sql_metrics()} from j")
def class_metrics(t: Tables) -> DataFrame:
    return mt.class_metrics(_judged(t))


@query("confusion", f"with {SQL_JUDGED} select label, prediction, count(*) as n from j group by 1, 2")
def confusion(t: Tables) -> DataFrame:
    return mt.confusion(_judged(t))


@query(
    "class_report",
    f"""with {SQL_JUDGED}, k as (select unnest([0, 1]) as class)
select cast(class as int) as class, count(*) filter (where label = class and prediction = class) / count(*) filter (where prediction = class) as "precision",
  count(*) filter (where label = class and prediction = class) / count(*) filter (where label = class) as recall,
  2 * count(*) filter (where label = class and prediction = class) / (count(*) filter (where prediction = class) + count(*) filter (where label = class)) as f1,
  count(*) filter (where label = class) as support
from j, k group by class""",
)
def class_report(t: Tables) -> DataFrame:
    return mt.class_report(_judged(t))


@query(
    "roc_auc",
    f"""with {SQL_JUDGED}, r as (select label, rank() over (order by probability) + (count(*) over (partition by probability) - 1) / 2 as rank from j),
s as (select sum(rank) filter (where label = 1) as w, count(*) filter (where label = 1) as p, count(*) filter (where label = 0) as n from r)
select round((w - p * (p + 1) / 2) / (p * n), 9) as roc_auc from s""",
)
def roc_auc(t: Tables) -> DataFrame:
    return mt.roc_auc(_judged(t)).select(F.round("roc_auc", 9).alias("roc_auc"))


@query(
    "reg_metrics",
    f"""with {SQL_JUDGED} select round(avg(abs(l_quantity - guess)), 8) as mae, round(sqrt(avg(pow(l_quantity - guess, 2))), 8) as rmse,
  round(1 - sum(pow(l_quantity - guess, 2)) / (var_pop(l_quantity) * count(*)), 8) as r2 from j""",
)
def reg_metrics(t: Tables) -> DataFrame:
    row = mt.regression_metrics(_judged(t), "l_quantity", "guess")
    return row.select(*[F.round(c, 8).alias(c) for c in ("mae", "rmse", "r2")])


@query(
    "metric_gaps",
    f"""with {SQL_JUDGED}, a as (select {_sql_metrics('l_linenumber > 2')} from j), b as (select {_sql_metrics('l_linenumber <= 2')} from j)
{" union all ".join(f'''select '{m}' as metric, a."{m}" as train, b."{m}" as test, a."{m}" - b."{m}" as gap from a, b''' for m in ("accuracy", "precision", "recall", "f1"))}""",
)
def metric_gaps(t: Tables) -> DataFrame:
    judged = _judged(t)
    return mt.gaps(mt.class_metrics(judged.where("l_linenumber > 2")), mt.class_metrics(judged.where("l_linenumber <= 2")))


@query(
    "fold_spread",
    f"""with {SQL_JUDGED}, f as (select l_linenumber, {_sql_metrics()} from j group by 1)
{" union all ".join(f'''select '{m}' as metric, round(avg("{m}"), 9) as mean, round(stddev_pop("{m}"), 9) as std from f''' for m in ("accuracy", "recall"))}""",
)
def fold_spread(t: Tables) -> DataFrame:
    judged = _judged(t)
    y, p = F.col("label") == 1, F.col("prediction") == 1
    per_fold = judged.groupBy("l_linenumber").agg(
        F.avg((y == p).cast("int")).alias("accuracy"), (F.count_if(y & p) / F.count_if(y)).alias("recall")
    )
    spread = mt.across_folds(per_fold, ["accuracy", "recall"])
    return spread.select("metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


# Fits. Learners differ from engine to engine, so these have no SQL twin. -------------------

FEATURES = ["flag", "status", "l_quantity", "l_discount", "l_tax", "l_linenumber"]


def model_rows(t: Tables) -> DataFrame:
    """Line items with a delay that depends on quantity, discount and flag."""
    return t.lineitem.selectExpr(
        "xxhash64(*) as row_id", "l_returnflag as flag", "l_linestatus as status",
        "case when l_partkey % 9 > 0 then l_quantity end as l_quantity", "l_discount", "l_tax", "l_linenumber",
        "cast(l_quantity * (case l_returnflag when 'A' then 0.9D else 0.4D end) - 5 + 100 * l_discount as double) as arrival_delay_min",
    ).withColumn(ft.TARGET, F.expr("cast(arrival_delay_min > 15 as int)"))


_IGNORED = ["row_id", "arrival_delay_min", ft.TARGET]


def fitted(t: Tables, learner, by: str | None):
    train, test = (stored(part) for part in ft.split(model_rows(t), ["row_id"], by=by))  # each is read many times
    encoding = tr.fit_encoding(train, _IGNORED)
    train, test = encoding.apply(train), encoding.apply(test)
    return tr.assembled(learner, encoding.features).fit(train), encoding, train, test


def fitted_pair(t: Tables):
    """The boosted classifier and regressor with their encodings, fitted side by side: a boosted fit is a row of small
    jobs that leave most cores idle."""
    shared_folder(t.spark)  # set once, before two threads ask for it
    with ThreadPoolExecutor(2) as pool:
        classifier = pool.submit(inheritable_thread_target(fitted), t, tr.boosted_classifier(), ft.TARGET)
        regressor = pool.submit(inheritable_thread_target(fitted), t, tr.boosted_regressor(), None)
        return classifier.result()[:2], regressor.result()[:2]


def _ruled_rows(t: Tables) -> DataFrame:
    """Line items with a label that two cuts tell exactly."""
    return t.lineitem.selectExpr(
        "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) as row_id", "l_returnflag as flag", "l_linestatus as status",
        "l_discount", "l_tax", "l_linenumber", f"cast(l_returnflag = 'A' and l_linenumber <= 3 as int) as {ft.TARGET}",
    )


_SQL_RULE = "cast(l_returnflag = 'A' and l_linenumber <= 3 as int)"


def _rule_confusion(t: Tables, learner) -> DataFrame:
    rows = tr.balanced(stored(_ruled_rows(t)))  # read by the sizes, the encoding, the bins, the cells and the scores
    encoding = tr.fit_encoding(rows, [*_IGNORED, "weight"])
    coded = encoding.apply(rows)
    return mt.confusion(tr.assembled(learner, encoding.features).fit(coded).transform(coded), ft.TARGET, "prediction")


@query("boosted_rule", f"select {_SQL_RULE} as {ft.TARGET}, {_SQL_RULE} as prediction, count(*) as n from lineitem group by 1, 2")
def boosted_rule(t: Tables) -> DataFrame:
    """The boosted classifier with its defaults finds a rule that a tree can tell exactly."""
    return _rule_confusion(t, tr.boosted_classifier())


@query("forest_rule", f"select {_SQL_RULE} as {ft.TARGET}, {_SQL_RULE} as prediction, count(*) as n from lineitem group by 1, 2")
def forest_rule(t: Tables) -> DataFrame:
    """So does the forest with all its trees."""
    return _rule_confusion(t, tr.forest_classifier())


@query("fit_classifier")
def fit_classifier(t: Tables) -> DataFrame:
    model, _, train, test = fitted(t, tr.boosted_classifier(), ft.TARGET)
    return mt.gaps(tr.quality(tr.scored(model, train, ft.TARGET)), tr.quality(tr.scored(model, test, ft.TARGET)))


@query("fit_regressor")
def fit_regressor(t: Tables) -> DataFrame:
    model, _, _, test = fitted(t, tr.boosted_regressor(), None)
    return mt.regression_metrics(model.transform(test), "arrival_delay_min", "prediction")


@query("fit_forest_classifier")
def fit_forest_classifier(t: Tables) -> DataFrame:
    rows = tr.balanced(model_rows(t))
    train, test = (stored(part) for part in ft.split(rows, ["row_id"], by=ft.TARGET))
    encoding = tr.fit_encoding(train, [*_IGNORED, "weight"])
    model = tr.assembled(tr.forest_classifier(), encoding.features).fit(encoding.apply(train))
    return tr.quality(tr.scored(model, encoding.apply(test), ft.TARGET))


@query("fit_forest_regressor")
def fit_forest_regressor(t: Tables) -> DataFrame:
    model, _, _, test = fitted(t, tr.forest_regressor(), None)
    return mt.regression_metrics(model.transform(test), "arrival_delay_min", "prediction")


# The search and the fold report run on rows whose label a tree of depth two tells exactly: every setting below
# reaches F1 = 1 on every fold, so the twins know the scores, and the folds are pinned by their hash order.
# Rounds are fewer than the library's CLASSIFIER_SPACE (200 to 500): one tree already separates these rows.
SEARCH_SPACE = {
    "maxIter": [5, 10, 15, 20],
    "stepSize": [0.03, 0.05, 0.08, 0.1],
    "maxDepth": [3, 4, 5, 6],
    "minInstancesPerNode": [1, 3, 5, 7],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
}
SEARCH_DRAWS, SEARCH_FOLDS = 20, 5


def _prepared_rule_rows(t: Tables) -> DataFrame:
    rows = _ruled_rows(t)
    encoding = tr.fit_encoding(rows, _IGNORED)
    return tr.prepare(encoding.apply(rows), encoding.features, ["row_id"], ft.TARGET, SEARCH_FOLDS)


_SQL_RULE_ROWS = f"""rule_rows as (select concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) as row_id, {_SQL_RULE} as label from lineitem),
ranked as (select label, row_number() over (partition by label order by {_sql_hash('row_id')}) as r, count(*) over (partition by label) as n from rule_rows),
folded as (select label, {" + ".join(f"cast((r > ceil({i / SEARCH_FOLDS} * n)) as int)" for i in range(1, SEARCH_FOLDS))} as fold from ranked)"""


@query(
    "search_folds",
    f"with {_SQL_RULE_ROWS} select fold, label as {ft.TARGET}, count(*) as n from folded group by all",
)
def search_folds(t: Tables) -> DataFrame:
    """The stored folds every fit of the search reads: rows of each label in each fold."""
    return _prepared_rule_rows(t).groupBy("fold", ft.TARGET).agg(F.count(F.lit(1)).alias("n"))


@query(
    "search",
    "select * from (values "
    + ", ".join(f"({i}, {quote(tr.params_text(p))}, 1.0::double, 0.0::double, {str(i == 0).lower()})" for i, p in enumerate(tr.draws(SEARCH_SPACE, SEARCH_DRAWS, 42)))
    + ") as v(setting, params, score, score_std, chosen)",
)
def search(t: Tables) -> DataFrame:
    """Twenty seeded settings of the boosted classifier, each fitted on five folds of binned, stored vectors."""
    _, table = tr.search_prepared(_prepared_rule_rows(t), tr.boosted_classifier(), SEARCH_SPACE, SEARCH_DRAWS)
    return table.select("setting", "params", F.round("score", 9).alias("score"), F.round("score_std", 9).alias("score_std"), "chosen")


@query(
    "fold_metrics",
    "select * from (values "
    + ", ".join(f"('{m}', 1.0::double, 0.0::double)" for m in tr.FOLD_METRICS)
    + ") as v(metric, mean, std)",
)
def fold_metrics(t: Tables) -> DataFrame:
    """Cross-validated accuracy, precision, recall, F1 and AUC of one setting, from one stored out-of-fold table."""
    learner = tr.boosted_classifier(maxIter=20, maxDepth=4, stepSize=0.1)
    predictions = tr.out_of_fold(_prepared_rule_rows(t), learner, ["row_id"])
    report = tr.fold_report(predictions)
    return report.select("metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@query("model_importance")
def model_importance(t: Tables) -> DataFrame:
    model, encoding, train, _ = fitted(t, tr.boosted_classifier(), ft.TARGET)
    corr = rk.correlations(train, encoding.features, ft.TARGET)
    importance = tr.importances(model, encoding.features).withColumnRenamed("encoded_feature", "raw_feature")
    return rk.top(rk.combined(corr, importance), 20)


@query("saved_model", "select count(*) as n_rows, count(*) as n_equal from lineitem")
def saved_model(t: Tables) -> DataFrame:
    """Rows, and rows whose prediction is the same after storing and loading a model and its encoding."""
    model, encoding, _, _ = fitted(t, tr.boosted_regressor(), None)
    folder = f"{shared_folder(t.spark)}/saved-{uuid.uuid4().hex}"
    tr.save_encoding(encoding, f"{folder}/encoding")
    model.write().overwrite().save(f"{folder}/model")
    loaded, again = tr.PipelineModel.load(f"{folder}/model"), tr.load_encoding(t.spark, f"{folder}/encoding")
    before = F.struct(F.col("prediction").alias("before"))
    rows = model.transform(encoding.apply(model_rows(t).withColumn("key", F.struct(*FEATURES))))
    rows = rows.select("row_id", "key.*", before["before"].alias("before"))
    after = loaded.transform(again.apply(rows))
    return after.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") == F.col("prediction")).alias("n_equal"))
