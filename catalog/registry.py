"""Registry of queries, and the views that several of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL when the result has one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A view of orders with padded, blank and missing cells; the same text on both engines.
DIRTY_COLUMNS = [
    "o_orderkey as cust_id",
    """case when o_orderkey % 11 = 0 then '   ' when o_orderkey % 23 = 0 then ''
       else concat('  ', cast(o_totalprice as string), ' ') end as total_raw""",
    """case when o_orderkey % 13 = 0 then null when o_orderkey % 29 = 0 then '  '
       else concat(' ', o_orderpriority, ' ') end as segment_raw""",
    "case when o_orderkey % 17 = 0 then null else cast(o_custkey % 73 as double) end as tenure",
    "case when o_orderkey % 7 = 0 then null when o_orderstatus = 'F' then 'Yes' else 'No' end as churn",
]
DIRTY_SQL = f"dirty as (select {', '.join(DIRTY_COLUMNS)} from orders)"


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*DIRTY_COLUMNS)


# Candidate scores for one outcome: a stand-in for trained models with known values.
CANDIDATES = [
    (0, "l_quantity / 50", "l_quantity > 25"),
    (1, "l_extendedprice", "l_extendedprice > 50000"),
    (2, "l_discount", "l_discount > 0.05D"),
    (3, "l_tax", "l_tax > 0.04D"),
]
CANDIDATES_SQL = " union all ".join(
    f"""select cast({i} as bigint) as trial_id, cast({score} as double) as score,
        case when {rule.replace('D', '::double')} then 1 else 0 end as prediction,
        case when l_linestatus = 'F' then 1 else 0 end as label from lineitem"""
    for i, score, rule in CANDIDATES
)


def candidates(spark: SparkSession, sf_dir: str, *ids: int) -> DataFrame:
    """trial_id, score, prediction and label of every line item under each candidate."""
    outcomes = F.array(
        *[
            F.struct(
                F.lit(i).cast("long").alias("trial_id"),
                F.expr(score).alias("score"),
                F.expr(rule).cast("double").alias("prediction"),
            )
            for i, score, rule in CANDIDATES
            if not ids or i in ids
        ]
    )
    label = F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("label")
    return table(spark, sf_dir, "lineitem").select(label, F.inline(outcomes))


def metrics_ctes(scored: str, by: str = "trial_id") -> str:
    """SQL for the six metrics per ``by`` from rows of (by, score, prediction, label)."""
    return f"""
    scored as ({scored}),
    points as (select {by}, score, sum(label) as pos, count(*) - sum(label) as neg
               from scored group by {by}, score),
    running as (select *,
        sum(pos) over (partition by {by} order by score desc) as hits,
        sum(neg) over (partition by {by} order by score desc) as misses,
        sum(pos) over (partition by {by}) as all_pos,
        sum(neg) over (partition by {by}) as all_neg from points),
    curve as (select *, hits / (hits + misses)::double as precision_here,
        lag(hits / (hits + misses)::double) over (partition by {by} order by score desc) as precision_before
        from running),
    areas as (select {by},
        sum(pos::double * (all_neg - misses + neg / 2)) / (max(all_pos)::double * max(all_neg)) as roc_auc,
        sum(pos::double / all_pos * (precision_here + coalesce(precision_before, precision_here)) / 2) as pr_auc
        from curve group by {by}),
    classes as (select * from (values (0), (1)) as c(class)),
    per_class as (select {by}, class,
        sum(case when label = class then 1 else 0 end)::double as actual,
        sum(case when prediction = class then 1 else 0 end)::double as predicted,
        sum(case when label = class and prediction = class then 1 else 0 end)::double as hit,
        count(*)::double as n from scored, classes group by {by}, class),
    rates as (select {by}, sum(hit) / max(n) as accuracy,
        sum(actual * coalesce(hit / nullif(predicted, 0), 0)) / max(n) as "precision",
        sum(actual * coalesce(hit / nullif(actual, 0), 0)) / max(n) as recall,
        sum(actual * 2 * hit / (predicted + actual)) / max(n) as f1
        from per_class group by {by}),
    metrics as (select {by}, accuracy, "precision", recall, f1, roc_auc, pr_auc
        from rates join areas using ({by})),
    metric_rows as (
        select {by}, 'accuracy' as metric, accuracy as value from metrics
        union all select {by}, 'precision', "precision" from metrics
        union all select {by}, 'recall', recall from metrics
        union all select {by}, 'f1', f1 from metrics
        union all select {by}, 'roc_auc', roc_auc from metrics
        union all select {by}, 'pr_auc', pr_auc from metrics)"""


def one_candidate(i: int) -> str:
    return f"select * from ({CANDIDATES_SQL}) where trial_id = {i}"
