import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabwright.operators.split import VALIDATION_SALT, hash_split, random_split, staged_split


def keys(df):
    return {r[0] for r in df.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(share=st.floats(0, 1), salt=st.integers(0, 99), pieces=st.integers(1, 9))
def test_split_partitions_the_rows_whatever_the_layout(spark, share, salt, pieces):
    df = spark.range(2000)
    first, second = hash_split(df, ["id"], share, salt)
    again, _ = hash_split(df.repartition(pieces), ["id"], share, salt)
    assert keys(first) == keys(again)
    assert keys(first) | keys(second) == set(range(2000))
    assert not keys(first) & keys(second)
    assert abs(len(keys(first)) / 2000 - share) < 0.06


def test_extreme_shares(spark):
    df = spark.range(100)
    assert hash_split(df, ["id"], 1.0)[0].count() == 100
    assert hash_split(df, ["id"], 0.0)[0].count() == 0
    with pytest.raises(ValueError):
        hash_split(df, ["id"], 1.5)


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, v int")
    first, second = hash_split(df, ["k"])
    assert first.count() + second.count() == 3


def test_nested_split_is_independent_of_the_outer_one(spark):
    train, _ = hash_split(spark.range(20_000), ["id"])
    tuning, validation = hash_split(train, ["id"], salt=VALIDATION_SALT)
    assert 0.18 < validation.count() / train.count() < 0.22
    assert tuning.count() + validation.count() == train.count()


def test_random_split_keeps_every_row(spark):
    df = spark.range(1000)
    train, test = random_split(df)
    assert keys(train) | keys(test) == set(range(1000)) and not keys(train) & keys(test)
    assert keys(random_split(df)[0]) == keys(train)


def test_staged_parts_are_those_of_the_splits_and_read_no_digests(spark):
    df = spark.range(2000).selectExpr("id", "id % 7 as v").union(spark.sql("select cast(null as bigint), 1L"))
    parts = staged_split(df, ["id"], "parts")
    train, test = hash_split(df, ["id"])
    tuning, validation = hash_split(train, ["id"], salt=VALIDATION_SALT)
    for got, wanted in zip((parts.train, parts.test, parts.tuning, parts.validation), (train, test, tuning, validation)):
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
        assert "md5" not in got._jdf.queryExecution().optimizedPlan().toString()
