import pytest
from pyspark.sql import functions as F

from tabwright.operators.stats import class_percentage, fit_class_weights, preview, profile, with_class_weight


def labels(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "label double")


def test_weights_balance_the_classes(spark):
    df = labels(spark, *[1.0] * 30, *[0.0] * 170)
    weighted = with_class_weight(df, fit_class_weights(df))
    sums = {r.label: r.w for r in weighted.groupBy("label").agg(F.sum("classWeight").alias("w")).collect()}
    assert sums[0.0] == pytest.approx(100) and sums[1.0] == pytest.approx(100)


def test_missing_class_and_strange_label_are_errors(spark):
    with pytest.raises(ValueError, match="both classes"):
        fit_class_weights(labels(spark, 0.0, 0.0))
    with pytest.raises(ValueError, match="0.0 or 1.0"):
        fit_class_weights(labels(spark, 0.0, 1.0, 2.0))
    with pytest.raises(ValueError, match="0.0 or 1.0"):
        fit_class_weights(labels(spark, 0.0, 1.0, None))


def test_percentages_add_up(spark):
    rows = class_percentage(labels(spark, 0.0, 0.0, 0.0, 1.0)).collect()
    assert {r.label: r.percentage for r in rows} == {0.0: 75.0, 1.0: 25.0}


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(10)], "a int, b string")
    assert [tuple(r) for r in profile(df).orderBy("position").collect()] == [(1, "a", "int", 10, 10), (2, "b", "string", 10, 5)]
    assert [r.a for r in preview(df, "a").collect()] == [0, 1, 2, 3, 4]


def test_profile_counts_rows_under_any_name(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "`a.b` int, n_rows string")
    rows = [tuple(r) for r in profile(df).collect()]
    assert rows == [(1, "a.b", "int", 3, 2), (2, "n_rows", "string", 3, 2)]
