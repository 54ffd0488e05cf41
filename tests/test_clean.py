import pytest
from pyspark.sql import functions as F

from tabwright.operators.clean import cast_doubles, dedup, fill_text, trim_all, trim_strings


def test_trim_all_turns_everything_to_text(spark):
    df = spark.createDataFrame([(" a ", 1, 2.5), ("   ", 2, None)], "s string, i int, d double")
    out = trim_all(df)
    assert [t for _, t in out.dtypes] == ["string"] * 3
    assert [tuple(r) for r in out.collect()] == [("a", "1", "2.5"), ("", "2", None)]


def test_trim_strings_keeps_numbers(spark):
    df = spark.createDataFrame([(" a ", 10000000.5)], "s string, d double")
    assert tuple(trim_strings(df).first()) == ("a", 10000000.5)


def test_cast_doubles_survives_malformed_text(spark):
    df = spark.createDataFrame([("1e3",), ("x",), ("",)], "s string")
    assert [r.s for r in cast_doubles(df, ["s"]).collect()] == [1000.0, None, None]


def test_blank_text_is_filled_only_on_request(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    assert [r.s for r in fill_text(df, ["s"], "Unknown").collect()] == ["", "Unknown", "a"]
    assert [r.s for r in fill_text(df, ["s"], "Unknown", blank_as_null=True).collect()] == ["Unknown", "Unknown", "a"]


@pytest.mark.parametrize("pieces", [1, 3, 7])
def test_dedup_keeps_the_same_rows_on_any_layout(spark, pieces):
    rows = [(i % 10, (i * 37) % 101, f"v{i}") for i in range(200)] + [(None, 5, "n1"), (None, 4, "n2")]
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(pieces)
    kept = {r.k: (r.o, r.v) for r in dedup(df, ["k"], ["o", "v"]).collect()}
    expected = {}
    for k, o, v in rows:
        expected[k] = min(expected.get(k, (o, v)), (o, v))
    assert kept == expected


def test_dedup_without_order_uses_the_other_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    assert {tuple(r) for r in dedup(df, ["k"]).collect()} == {(1, "a"), (2, None)}


def test_dedup_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("o")
    )
    out = dedup(df, ["k"], ["o"])
    assert out.count() == 20_001
    assert out.filter("k = 0").first().o == -29_997
