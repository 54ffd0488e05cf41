"""What the physical plans must and must not hold."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from catalog.cleaning import DIRTY_TABLE
from catalog.registry import dirty
from tabwright.operators.evaluate import _ranged_curve, score_table
from tabwright.operators.stats import class_percentage
from tabwright.operators.split import hash_split
from tabwright.plans.clean import prepare
from tabwright.scratch import stage
from tabwright.sources.tables import read_parquet


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_is_asked_for(spark, sf_dir):
    text = plan(read_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey"]).filter("l_orderkey > 5"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "GreaterThan(l_orderkey,5)" in text


def test_dedup_drops_rows_before_the_shuffle(spark, sf_dir):
    text = plan(queries()["dedup_keyed"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_share_of_total_scans_once(spark, sf_dir):
    df = class_percentage(read_parquet(spark, f"{sf_dir}/lineitem.parquet"), "l_returnflag")
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_split_is_a_filter_without_shuffle(spark, sf_dir):
    first, _ = hash_split(read_parquet(spark, f"{sf_dir}/orders.parquet"), ["o_orderkey"])
    assert "Exchange" not in plan(first)


def test_row_expressions_stay_in_one_codegen_stage(spark, sf_dir):
    for name in ("trim_all", "blank_to_null", "count_matching", "safe_ratio", "bucket_tenure", "search_space_lr"):
        text = plan(queries()[name](spark, sf_dir))
        assert "Exchange" not in text and "Python" not in text, name
        assert "*(1) Project" in text or "WholeStageCodegen" in text, name


def test_scores_are_counted_before_the_shuffle(spark, sf_dir):
    df = read_parquet(spark, f"{sf_dir}/lineitem.parquet").select(
        F.col("l_quantity").alias("score"),
        F.lit(1.0).alias("label"),
        F.lit(0.0).alias("prediction"),
    )
    text = plan(score_table(df))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_score_ranges_share_one_partitioning(spark):
    """The join and the running sums use the same shuffle; no single task takes all scores."""
    points = spark.range(1000).selectExpr("id % 2 as m", "id / 1000 as score", "1L as pos", "1L as neg")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, -1)
    try:
        text = plan(_ranged_curve(points, ["m"], 4))
    finally:
        spark.conf.set(conf, before)
    assert "SinglePartition" not in text
    window, join = text.index("Window"), text.index("SortMergeJoin")
    assert "Exchange" not in text[window:join]
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_no_query_joins_without_keys(spark, sf_dir):
    for name in ("clean_table", "class_weights", "evaluate", "median_exact", "evaluate_many", "selection_record", "compare_models"):
        text = plan(queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_cleaned_parts_read_only_their_own_folder(spark, sf_dir):
    """The split column prunes below filling and feature derivation."""
    rows = stage(dirty(spark, sf_dir).withColumn("_part", F.lit("train")), "rows", ("_part",))
    text = plan(prepare(rows, {"tenure": 1.0}, DIRTY_TABLE).filter("_part = 'train'"))
    assert "PartitionFilters: [isnotnull(_part" in text
