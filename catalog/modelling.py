"""Fits, scoring, search and refit on the line items.

The numbers of a line item do not predict one another, so most queries here use a planted
label: it is 1 where a repeatable draw times 60 is below the quantity. With one feature the
fits have closed forms: a logistic regression on one category without a penalty gives each
category its weighted rate, a stump cuts where the weighted Gini impurity is least, and a
score that rises with the quantity orders the rows as the quantity does.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from catalog.cleaning import LINES_SQL, lines
from catalog.registry import metrics_ctes, query
from catalog.search import _pick_sql, _uniform_sql
from tabwright.functions import binary_label, bucket, safe_ratio, unit_uniform
from tabwright.operators.encode import build_pipeline, training_weights
from tabwright.operators.models import PLACE, forest, logistic, row_place, score
from tabwright.operators.search import (
    LOGISTIC_SPACE,
    Choice,
    best_trial,
    draw_trials,
    featurize,
    fit_model,
    refit,
    run_trials,
    training_set,
)
from tabwright.operators.split import staged_split
from tabwright.operators.stats import with_class_weight
from tabwright.scratch import scratch_path
from tabwright.sources.models import load_model, save_model

KEYS = ["l_orderkey", "l_linenumber"]
CATEGORICAL = ["l_linestatus", "quantity_group"]
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "unit_price"]
STUMP = {"numTrees": 1, "maxDepth": 1, "maxBins": 64, "bootstrap": False}
STUMP_SPACE = {"maxBins": Choice((64, 128)), "minInstancesPerNode": Choice((1, 2, 4))}
TRIALS = 6

TRAIN_ROWS = "md5(concat_ws('|', '42', l_orderkey::varchar, l_linenumber::varchar)) < 'cccccccd'"
TUNING_ROWS = "md5(concat_ws('|', 'validation-42', l_orderkey::varchar, l_linenumber::varchar)) < 'cccccccd'"


def _parts(spark, sf_dir):
    """Unique lines with features, staged and split by key."""
    rows = lines(spark, sf_dir).select(
        *KEYS,
        "l_linestatus",
        *NUMERIC[:4],
        bucket("l_quantity", [12, 24, 48], ["0-12", "13-24", "25-48", "49+"]).alias("quantity_group"),
        safe_ratio("l_extendedprice", "l_quantity", "l_tax").alias("unit_price"),
        binary_label("l_returnflag", "R").alias("label"),
    )
    return staged_split(rows, KEYS, "lines")


def _fit(spark, sf_dir, estimator, scale=True):
    parts = _parts(spark, sf_dir)
    training = training_set(parts.train, CATEGORICAL, NUMERIC)
    return fit_model(estimator, training, scale), training, parts.test


def _planted_parts(spark, sf_dir):
    """Unique lines with the planted label, staged and split by key."""
    noise = unit_uniform("noise", "l_orderkey", "l_linenumber", "l_partkey")
    label = F.when(noise * 60 < F.col("l_quantity"), 1.0).otherwise(0.0)
    rows = lines(spark, sf_dir).select(*KEYS, "l_returnflag", "l_linestatus", "l_quantity", label.alias("label"))
    return staged_split(rows, KEYS, "planted")


NOISE_SQL = """('0x' || substr(md5(concat_ws('|', 'noise', l_orderkey::varchar, l_linenumber::varchar,
    l_partkey::varchar)), 1, 8))::bigint / 4294967296::double"""
PARTS_SQL = f"""train as (select * from planted where {TRAIN_ROWS}), test as (select * from planted where not {TRAIN_ROWS}),
    tuning as (select * from train where {TUNING_ROWS}), validation as (select * from train where not {TUNING_ROWS})"""
PLANTED_SQL = f"""{LINES_SQL}, planted as (select l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity,
    case when {NOISE_SQL} * 60 < l_quantity then 1 else 0 end as label from lines), {PARTS_SQL}"""


def _rates_sql(column: str, rows: str = "train") -> str:
    """Weighted rate of each category: both classes weigh the same in all."""
    return f"""rates as (select {column}, sum(label / ones) / sum(label / ones + (1 - label) / zeros) as rate
    from {rows}, (select sum(label)::double as ones, sum(1 - label)::double as zeros from {rows}) group by {column})"""


def _stump_sql(rows: str) -> str:
    """The cut on quantity with the least weighted Gini impurity, and the rates of its sides."""
    return f"""sizes as (select sum(label)::double as ones, sum(1 - label)::double as zeros from {rows}),
    cuts as (select distinct l_quantity as cut from {rows}
      where l_quantity < (select max(l_quantity) from {rows})),
    sides as (select cut, l_quantity <= cut as low, sum(label / ones) as p, sum((1 - label) / zeros) as n
      from {rows}, cuts, sizes group by all),
    impurity as (select cut, sum(2 * p * n / (p + n)) as gini from sides group by cut),
    best as (select arg_min(cut, gini) as cut from impurity),
    leaves as (select low, p / (p + n) as rate, sides.cut from sides join best on sides.cut = best.cut)"""


@query(
    "logistic_fit",
    f"""with {PLANTED_SQL}, {_rates_sql('l_returnflag')},
    counts as (select l_returnflag, count(*) as n_rows from train group by l_returnflag)
    select l_returnflag, n_rows, round(rate, 4) as probability from rates join counts using (l_returnflag)""",
)
def logistic_fit(spark, sf_dir):
    """Without a penalty each category gets its weighted rate."""
    train = _planted_parts(spark, sf_dir).train
    model = fit_model(logistic(regParam=0.0, tol=1e-10), training_set(train, ["l_returnflag"], []), scale=True)
    scored = score(model, train, ["l_returnflag"])
    return scored.groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"), F.round(F.avg("probability"), 4).alias("probability")
    )


@query(
    "logistic_balance",
    f"""with {LINES_SQL}, slots as (select unnest(range(-1, {len(NUMERIC)}
      + (select count(distinct l_linestatus) + count(distinct case when l_quantity <= 12 then 0
          when l_quantity <= 24 then 1 when l_quantity <= 48 then 2 else 3 end) from lines where {TRAIN_ROWS})))
      ::int as slot)
    select slot, (select count(*) from lines where {TRAIN_ROWS}) as n_rows, true as balanced from slots""",
)
def logistic_balance(spark, sf_dir):
    """All conditions of the optimum: the slope of the penalised likelihood is 0 in every slot.

    Slot -1 is the intercept, which has no penalty; the others are penalised on the scale of
    their weighted deviation, as the estimator does it.
    """
    model, training, _ = _fit(spark, sf_dir, logistic(tol=1e-9))
    last = model.stages[-1]
    scored = model.transform(training.weighted)
    residual = F.col("classWeight") * (vector_to_array("probability")[1] - F.col("label"))
    slots = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    size = len(last.coefficients)
    sums = scored.select(residual.alias("r"), slots.alias("x"), "classWeight").agg(
        F.count("*").alias("n_rows"),
        F.sum("classWeight").alias("total"),
        *[F.sum(F.col("r") * F.col("x")[i]).alias(f"s{i}") for i in range(size + 1)],
        Summarizer.variance(array_to_vector("x"), F.col("classWeight")).alias("spread"),
    )
    row = sums.first()
    penalty = [0.0, *[last.getRegParam() * row["spread"][i + 1] * c for i, c in enumerate(last.coefficients)]]
    values = [
        (i - 1, row["n_rows"], bool(abs(row[f"s{i}"] / row["total"] + penalty[i]) < 1e-5)) for i in range(size + 1)
    ]
    return spark.createDataFrame(values, "slot int, n_rows long, balanced boolean")


@query(
    "forest_fit",
    f"""with {PLANTED_SQL}, {_stump_sql('train')}
    select l_quantity, round(rate, 6) as probability from (select distinct l_quantity from train)
    join leaves on low = (l_quantity <= cut)""",
)
def forest_fit(spark, sf_dir):
    """One tree of one cut on all rows: the cut of least impurity and the rates of its sides."""
    train = _planted_parts(spark, sf_dir).train
    model = fit_model(forest(**STUMP), training_set(train, [], ["l_quantity"]), scale=False)
    quantities = train.select("l_quantity").distinct()
    return score(model, quantities, ["l_quantity"]).select("l_quantity", F.round("probability", 6).alias("probability"))


@query(
    "batch_score",
    f"""with {PLANTED_SQL}, {_rates_sql('l_returnflag')}
    select l_orderkey, l_linenumber, label::double as label, round(rate, 4) as probability,
    case when rate > 0.5 then 1e0 else 0e0 end as prediction from test join rates using (l_returnflag)""",
)
def batch_score(spark, sf_dir):
    parts = _planted_parts(spark, sf_dir)
    train, test = parts.train, parts.test
    model = fit_model(logistic(regParam=0.0, tol=1e-10), training_set(train, ["l_returnflag"], []), scale=True)
    return score(model, test, [*KEYS, "label"]).withColumn("probability", F.round("probability", 4))


@query(
    "batch_score_checked",
    f"""with {PLANTED_SQL}, {_rates_sql('l_linestatus')}
    select l_linestatus, count(*) as n_rows, round(max(rate), 4) as probability, round(sum(label) / count(*), 6) as share
    from test join rates using (l_linestatus) group by l_linestatus""",
)
def batch_score_checked(spark, sf_dir):
    """Scores of the test rows by category, beside the share of ones among them."""
    parts = _planted_parts(spark, sf_dir)
    train, test = parts.train, parts.test
    model = fit_model(logistic(regParam=0.0, tol=1e-10), training_set(train, ["l_linestatus"], []), scale=True)
    scored = score(model, test, ["l_linestatus", "label"])
    return scored.groupBy("l_linestatus").agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg("probability"), 4).alias("probability"),
        F.round(F.avg("label"), 6).alias("share"),
    )


@query(
    "forest_score_checked",
    f"""with {PLANTED_SQL}, {_stump_sql('train')}
    select l_orderkey, l_linenumber, label::double as label, round(rate, 6) as probability,
    case when rate > 0.5 then 1e0 else 0e0 end as prediction from test join leaves on low = (l_quantity <= cut)""",
)
def forest_score_checked(spark, sf_dir):
    parts = _planted_parts(spark, sf_dir)
    train, test = parts.train, parts.test
    model = fit_model(forest(**STUMP), training_set(train, [], ["l_quantity"]), scale=False)
    return score(model, test, [*KEYS, "label"]).withColumn("probability", F.round("probability", 6))


@query(
    "model_roundtrip",
    f"with {LINES_SQL} select count(*) as n_rows, 0 as n_changed from lines where not {TRAIN_ROWS}",
)
def model_roundtrip(spark, sf_dir):
    """A stored and reloaded pipeline must score every test row as before."""
    model, _, test = _fit(spark, sf_dir, logistic())
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    before = model.transform(test).select(
        *CATEGORICAL, *NUMERIC, F.col("probability").alias("before"), F.col("prediction").alias("class_before")
    )
    after = loaded.transform(before)
    changed = (vector_to_array("before") != vector_to_array("probability")) | (
        F.col("class_before") != F.col("prediction")
    )
    return after.agg(F.count("*").alias("n_rows"), F.count_if(changed).cast("int").alias("n_changed"))


def _trial_rows(spark, parts, estimator, space):
    """Trials on the quantity alone, with their areas on the validation rows."""
    weighted = with_class_weight(parts.tuning, training_weights(parts.tuning, [], ["l_quantity"]))
    weighted = weighted.withColumn(PLACE, row_place(*KEYS))
    stages = build_pipeline([], ["l_quantity"]).fit(weighted)
    return run_trials(
        estimator,
        draw_trials(spark, TRIALS, space),
        space,
        featurize(stages, weighted, weight="classWeight"),
        featurize(stages, parts.validation),
    )


def _drawn(settings: str) -> str:
    """SQL of the settings that the trials draw."""
    return settings.replace("o_orderkey", "trial_id")


LOGISTIC_SQL = _drawn(
    f"""{_pick_sql("maxIter", "50, 100, 150", 3)},
    round(exp(ln(1e-4) + {_uniform_sql("regParam")} * (ln(1e-1) - ln(1e-4))), 9) as "regParam",
    {_pick_sql("elasticNetParam", "0e0, 0.25e0, 0.5e0, 0.75e0", 4)}"""
)
STUMPS_SQL = _drawn(f"""{_pick_sql("maxBins", "64, 128", 2)}, {_pick_sql("minInstancesPerNode", "1, 2, 4", 3)}""")
TRIAL_IDS = f"(select unnest(range({TRIALS})) as trial_id)"
ALL_TRIALS = f"select trial_id, {{}}, round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc from {TRIAL_IDS} t, metrics"


def _quantity_sql(rows: str) -> str:
    return f"select 1 as model, l_quantity as score, 0 as prediction, label from {rows}"


@query(
    "run_trials",
    f"with {PLANTED_SQL}, {metrics_ctes(_quantity_sql('validation'), 'model')} {ALL_TRIALS.format(LOGISTIC_SQL)}",
)
def trials(spark, sf_dir):
    """Six settings of the logistic regression with their validation areas."""
    parts = _planted_parts(spark, sf_dir)
    return _areas(_trial_rows(spark, parts, logistic(), LOGISTIC_SPACE), "trial_id", *LOGISTIC_SPACE)


def _areas(df, *keep):
    return df.select(*keep, F.round("roc_auc", 6).alias("roc_auc"), F.round("pr_auc", 6).alias("pr_auc"))


STUMP_SCORES = "select 1 as model, rate as score, 0 as prediction, label from validation join leaves on low = (l_quantity <= cut)"


@query(
    "run_trials_forest",
    f"""with {PLANTED_SQL}, {_stump_sql('tuning')}, {metrics_ctes(STUMP_SCORES, 'model')}
    {ALL_TRIALS.format(STUMPS_SQL)}""",
)
def forest_trials(spark, sf_dir):
    """Six settings of a forest of one stump with their validation areas."""
    parts = _planted_parts(spark, sf_dir)
    return _areas(_trial_rows(spark, parts, forest(**STUMP), STUMP_SPACE), "trial_id", *STUMP_SPACE)


@query(
    "refit_best",
    f"""with {PLANTED_SQL}, {metrics_ctes(_quantity_sql('test'), 'model')},
    best as (select trial_id, {LOGISTIC_SQL} from (select 0 as trial_id))
    select trial_id, "maxIter", "regParam", "elasticNetParam", round(roc_auc, 6) as roc_auc,
    round(pr_auc, 6) as pr_auc from best, metrics""",
)
def refit_best(spark, sf_dir):
    """The best logistic setting refitted on all training rows; the trials tie, so the first wins."""
    parts = _planted_parts(spark, sf_dir)
    tried = _areas(_trial_rows(spark, parts, logistic(), LOGISTIC_SPACE), "trial_id", *LOGISTIC_SPACE)
    best = best_trial(tried).first()
    settings = {name: best[name] for name in LOGISTIC_SPACE}
    _, metrics = refit(logistic(**settings), training_set(parts.train, [], ["l_quantity"]), parts.test)
    chosen = {"trial_id": best["trial_id"], **settings}
    return _areas(metrics.withColumns({k: F.lit(v) for k, v in chosen.items()}), *chosen)
