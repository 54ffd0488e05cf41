import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators.encode import build_pipeline, category_table, feature_stages, index_categories, training_weights
from tabwright.operators.ranges import numbered


def frame(spark):
    rows = [("b", 1.0), ("a", 2.0), ("c", 3.0), ("c", 4.0)]
    return spark.createDataFrame(rows, "s string, x double")


def vector(df, column):
    return [r[0] for r in df.select(vector_to_array(column)).collect()]


def test_frequent_first_then_alphabetical(spark):
    df = frame(spark)
    out = build_pipeline(["s"], ["x"]).fit(df).transform(df)
    assert {r.s: r.s_index for r in out.collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_unseen_and_null_are_the_zero_vector(spark):
    df = frame(spark)
    other = spark.createDataFrame([("new", 1.0), (None, 1.0), ("a", 1.0)], "s string, x double")
    out = build_pipeline(["s"], ["x"], scale=False).fit(df).transform(other)
    assert vector(out, "unscaled_features") == [[1.0, 0, 0, 0], [1.0, 0, 0, 0], [1.0, 0, 1.0, 0]]


def test_scaler_only_on_request():
    assert len(feature_stages(["s"], ["x"])) == 4
    assert len(feature_stages(["s"], ["x"], scale=False)) == 3
    assert len(feature_stages([], ["x"], scale=False)) == 1


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "s string, x double, label double")
    return training_weights(df, ["s"], ["x"], **options)


def test_training_table_checks(spark):
    good = [("a", 1.0, 0.0), ("b", 2.0, 1.0), ("b", 2.0, 1.0), (None, 2.0, 1.0)]
    assert check(spark, good) == {0.0: 2.0, 1.0: pytest.approx(2 / 3)}
    with pytest.raises(ValueError, match="missing numbers in x"):
        check(spark, [*good, ("a", None, 0.0)])
    with pytest.raises(ValueError, match="missing numbers in x"):
        check(spark, [*good, ("a", float("nan"), 0.0)])
    with pytest.raises(ValueError, match="blank categories in s"):
        check(spark, [*good, ("", 1.0, 0.0)])
    with pytest.raises(ValueError, match="more than 1 categories in s"):
        check(spark, good, max_categories=1)
    with pytest.raises(ValueError, match="both classes"):
        check(spark, good[1:])


@pytest.mark.parametrize("on_driver", [0, 100])
def test_indices_equal_those_of_the_indexer(spark, on_driver):
    values = ["b", "a", "c", "c", "é", "é", "😀", "\uffee", "", None, "Z", "z"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")
    wanted = StringIndexer(inputCol="s", outputCol="s_index", handleInvalid="keep").fit(df).transform(df)
    got = index_categories(df, ["s"], on_driver=on_driver)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(map(tuple, wanted.collect()), key=lambda r: r[0])


def test_many_categories_stay_off_the_driver(spark):
    """Categories are ranked in ranges: no collected list, no task with all of them."""
    df = spark.range(200_000).selectExpr("id", "cast(pmod(id * 7919, 150001) as string) as s")
    table = category_table(df, "s")
    assert table.count() == 150_001
    facts = table.selectExpr("min(index)", "max(index)", "count(distinct index)", "sum(rows)").first()
    assert tuple(facts) == (0, 150_000, 150_001, 200_000)
    assert index_categories(df, ["s"], on_driver=1000).filter("s_index is null or s_index > 150000").count() == 0


def test_numbers_follow_the_order_over_many_ranges(spark):
    df = spark.range(1000).selectExpr("pmod(id * 37, 1000) as x", "id % 3 as y").repartition(5)
    rows = numbered(df, [F.desc("y"), "x"], "place", range_rows=30).collect()
    expected = sorted(rows, key=lambda r: (-r.y, r.x))
    assert [r.place for r in expected] == list(range(1000))
    assert numbered(df.limit(0), ["x"], "place").count() == 0
