"""Counts, medians, class shares and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.cleaning import BUCKET_BOUNDS, BUCKET_LABELS, LINES_SQL, lines
from catalog.registry import query, table
from tabwright.functions import binary_label, bucket, count_matching, safe_ratio
from tabwright.operators.impute import exact_medians, fit_medians
from tabwright.operators.stats import (
    class_counts,
    class_percentage,
    class_weights,
    fit_class_weights,
    row_count,
    with_class_weight,
)

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FEATURES_SQL = f"""{LINES_SQL}, feats as (select l_orderkey, l_linenumber,
    case when l_quantity <= 12 then '0-12' when l_quantity <= 24 then '13-24'
      when l_quantity <= 48 then '25-48' else '49+' end as quantity_group,
    case when l_returnflag in ('R', 'F') then 1 else 0 end
      + case when l_linestatus in ('R', 'F') then 1 else 0 end as matches,
    case when l_quantity > 0 then l_extendedprice / l_quantity else l_tax end as unit_price,
    case when l_returnflag = 'R' then 1e0 else 0e0 end as label from lines)"""


def line_features(spark, sf_dir):
    """Derived features and label of the unique line items."""
    return lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        bucket("l_quantity", BUCKET_BOUNDS, BUCKET_LABELS).alias("quantity_group"),
        count_matching(["l_returnflag", "l_linestatus"], ["R", "F"]).alias("matches"),
        safe_ratio("l_extendedprice", "l_quantity", "l_tax").alias("unit_price"),
        binary_label("l_returnflag", "R").alias("label"),
    )


@query("row_count", "select count(*) as n_rows from lineitem")
def count_rows(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "median_exact",
    " union all ".join(
        f"select '{c}' as column_name, quantile_disc({c}, 0.5) as median from lineitem" for c in MEASURES
    ),
)
def median_exact(spark, sf_dir):
    medians = exact_medians(table(spark, sf_dir, "lineitem"), MEASURES)
    return spark.createDataFrame(list(medians.items()), "column_name string, median double")


@query(
    "median_approx",
    " union all ".join(
        f"select '{c}' as column_name, count(*) as n_rows, true as within_bound from lineitem" for c in MEASURES
    ),
)
def median_approx(spark, sf_dir):
    """The sketched median's true rank is counted: it may be off by 1 % of the rows."""
    df = table(spark, sf_dir, "lineitem").select(*MEASURES)
    medians = fit_medians(df, MEASURES)
    ranks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n_rows"),
                (
                    (F.count_if(F.col(c) < medians[c]) <= F.count(c) * 0.51)
                    & (F.count_if(F.col(c) <= medians[c]) >= F.count(c) * 0.49)
                ).alias("within_bound"),
            )
            for c in MEASURES
        ]
    )
    return df.agg(ranks.alias("ranks")).select(F.inline("ranks"))


@query("class_counts", f"with {FEATURES_SQL} select label, count(*) as count from feats group by label")
def count_classes(spark, sf_dir):
    return class_counts(line_features(spark, sf_dir))


@query(
    "class_percentage",
    f"""with {FEATURES_SQL} select label, count(*) as count,
    count(*)::double / (select count(*) from feats) * 100 as percentage from feats group by label""",
)
def class_share(spark, sf_dir):
    return class_percentage(line_features(spark, sf_dir))


@query(
    "feature_distribution",
    f"""with {FEATURES_SQL} select quantity_group, matches, label, count(*) as n_rows,
    round(avg(unit_price), 4) as mean_unit_price from feats group by quantity_group, matches, label""",
)
def feature_distribution(spark, sf_dir):
    return (
        line_features(spark, sf_dir)
        .groupBy("quantity_group", "matches", "label")
        .agg(F.count("*").alias("n_rows"), F.round(F.avg("unit_price"), 4).alias("mean_unit_price"))
    )


WEIGHTS_SQL = """labelled as (select l_orderkey, l_linenumber,
    case when l_returnflag = 'R' then 1e0 else 0e0 end as label from lineitem),
    w as (select label, count(*) as count,
      (select count(*) from labelled) / (2e0 * count(*)) as weight from labelled group by label)"""


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", binary_label("l_returnflag", "R").alias("label")
    )


@query("class_weights", f"with {WEIGHTS_SQL} select label, count, weight from w")
def weights_table(spark, sf_dir):
    return class_weights(_labelled(spark, sf_dir))


@query(
    "class_weight_column",
    f"""with {WEIGHTS_SQL} select l_orderkey, l_linenumber, label, round(weight, 9) as "classWeight"
    from labelled join w using (label)""",
)
def weight_column(spark, sf_dir):
    df = _labelled(spark, sf_dir)
    weighted = with_class_weight(df, fit_class_weights(df))
    return weighted.withColumn("classWeight", F.round("classWeight", 9))
