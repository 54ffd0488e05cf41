"""Trial settings, choices, comparison and the run log, on values derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import CANDIDATES_SQL, candidates, metrics_ctes, query, table
from tabwright.operators.evaluate import METRICS, evaluate_wide, to_long
from tabwright.operators.search import (
    FOREST_SPACE,
    LOGISTIC_SPACE,
    best_model,
    best_trial,
    compare_models,
    sample_space,
    selection_record,
)
from tabwright.scratch import scratch_path, stage
from tabwright.sources.runlog import log_run, read_runs
from tabwright.sources.tables import read_csv, write_csv

ROUNDED = ", ".join(f'round("{m}", 6) as "{m}"' for m in METRICS)
TRIALS_SQL = f"with {metrics_ctes(CANDIDATES_SQL)}"
MODELS = ["LogisticRegression", "RandomForest"]
# The first two candidates stand in for the two models.
MODELS_SQL = f"""with {metrics_ctes(CANDIDATES_SQL)},
    by_model as (select case trial_id when 0 then 'LogisticRegression' else 'RandomForest' end as model,
      trial_id, metric, value from metric_rows where trial_id < 2),
    winner as (select model from by_model where metric = 'roc_auc' order by value desc, trial_id limit 1)"""


def _uniform_sql(name: str) -> str:
    hexadecimal = f"substr(md5(concat_ws('|', '42|{name}', o_orderkey::varchar)), 1, 8)"
    return f"(('0x' || {hexadecimal})::bigint / 4294967296::double)"


def _pick_sql(name: str, values: str, size: int) -> str:
    return f"([{values}])[floor({_uniform_sql(name)} * {size})::int + 1] as \"{name}\""


@query(
    "search_space_lr",
    f"""select o_orderkey as trial_id, {_pick_sql("maxIter", "50, 100, 150", 3)},
    round(exp(ln(1e-4) + {_uniform_sql("regParam")} * (ln(1e-1) - ln(1e-4))), 9) as "regParam",
    {_pick_sql("elasticNetParam", "0e0, 0.25e0, 0.5e0, 0.75e0", 4)} from orders""",
)
def search_space_lr(spark, sf_dir):
    """One draw per order key: the draw is checked over many more ids than a search has."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trial_id"))
    return sample_space(ids, LOGISTIC_SPACE)


@query(
    "search_space_rf",
    f"""select o_orderkey as trial_id, {_pick_sql("numTrees", "50, 100, 150", 3)},
    {_pick_sql("maxDepth", "4, 6, 8, 10", 4)}, {_pick_sql("maxBins", "32, 64", 2)},
    {_pick_sql("minInstancesPerNode", "1, 2, 4", 3)} from orders""",
)
def search_space_rf(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trial_id"))
    return sample_space(ids, FOREST_SPACE)


def _trials(spark, sf_dir):
    return stage(evaluate_wide(candidates(spark, sf_dir), ["trial_id"]), "trials")


def _rounded(trials):
    return trials.select("trial_id", *[F.round(m, 6).alias(m) for m in METRICS])


def _models(spark, sf_dir):
    """Rows of (model, metric, value) of the two stand-ins."""
    name = F.when(F.col("trial_id") == 0, MODELS[0]).otherwise(MODELS[1])
    wide = stage(evaluate_wide(candidates(spark, sf_dir, 0, 1), ["trial_id"]), "models")
    return to_long(wide.withColumn("model", name).drop("trial_id"), ["model"])


@query("trials_csv", f"{TRIALS_SQL} select trial_id, {ROUNDED} from metrics")
def trials_csv(spark, sf_dir):
    path = scratch_path(spark, "trials-csv")
    write_csv(_trials(spark, sf_dir), path, single_file=True)
    schema = "trial_id bigint, " + ", ".join(f"{m} double" for m in METRICS)
    return _rounded(read_csv(spark, path, schema))


@query(
    "best_trial",
    f"{TRIALS_SQL} select trial_id, {ROUNDED} from metrics order by roc_auc desc, trial_id limit 1",
)
def top_trial(spark, sf_dir):
    return _rounded(best_trial(_trials(spark, sf_dir)))


@query(
    "compare_models",
    f"""{MODELS_SQL} select metric,
    round(max(case when model = 'LogisticRegression' then value end), 4) as "LogisticRegression",
    round(max(case when model = 'RandomForest' then value end), 4) as "RandomForest"
    from by_model group by metric""",
)
def compare(spark, sf_dir):
    return compare_models(_models(spark, sf_dir), MODELS)


@query(
    "best_model",
    f"""{MODELS_SQL} select model, metric, round(value, 6) as value from by_model
    where metric = 'roc_auc' and model = (select model from winner)""",
)
def choose(spark, sf_dir):
    return best_model(_models(spark, sf_dir), MODELS).withColumn("value", F.round("value", 6))


@query(
    "selection_record",
    f"""{MODELS_SQL} select 'tag' as kind, 'best_model' as key, model as value_str, null::double as value_dbl
    from winner
    union all select 'param', 'selection_metric', 'roc_auc', null
    union all select 'metric', 'best_model_' || metric, null, round(value, 6) from by_model
    where model = (select model from winner)""",
)
def record(spark, sf_dir):
    chosen = selection_record(_models(spark, sf_dir), MODELS)
    return chosen.withColumn("value_dbl", F.round("value_dbl", 6))


@query(
    "run_log",
    f"""with {metrics_ctes(CANDIDATES_SQL)}
    select 'Candidate_' || trial_id as run_name, 'metric' as kind, metric as key,
      null::varchar as value_str, round(value, 6) as value_dbl from metric_rows where trial_id < 2
    union all select 'Candidate_' || i, 'tag', 'model_type', 'candidate', null from range(2) t(i)
    union all select 'Candidate_' || i, 'param', 'rows', (select count(*) from lineitem)::varchar,
      (select count(*) from lineitem)::double from range(2) t(i)
    union all select 'Candidate_' || i, 'artifact', 'trials', 'trials/' || i, null from range(2) t(i)""",
)
def run_log(spark, sf_dir):
    """Two runs appended one after the other, and read back."""
    path = scratch_path(spark, "runs")
    rows = table(spark, sf_dir, "lineitem").count()
    wide = {r["trial_id"]: r for r in evaluate_wide(candidates(spark, sf_dir, 0, 1), ["trial_id"]).collect()}
    for i, metrics in sorted(wide.items()):
        log_run(
            spark,
            path,
            "candidates",
            f"Candidate_{i}",
            params={"rows": rows},
            metrics={m: metrics[m] for m in METRICS},
            tags={"model_type": "candidate"},
            artifacts={"trials": f"trials/{i}"},
        )
    log = read_runs(spark, path, "candidates")
    return log.select("run_name", "kind", "key", "value_str", F.round("value_dbl", 6).alias("value_dbl"))
