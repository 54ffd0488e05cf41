import pytest
from pyspark.sql import functions as F

from tabwright.scratch import (
    SHUFFLE_CLEANUP_SETTING,
    checkpoint,
    persisted,
    scoped_staging,
    scratch_path,
    shared_folder,
    short_lived_shuffles,
    stage,
)


def test_scratch_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    if named:
        assert folder == named.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(folder)


def test_stage_and_checkpoint_keep_the_rows(spark):
    df = spark.range(50).selectExpr("id", "id % 3 as part")
    for copy in (stage(df, "rows"), stage(df, "rows", ("part",)), checkpoint(df)):
        assert {(r.id, r.part) for r in copy.collect()} == {(r.id, r.part) for r in df.collect()}


def test_staged_partitions_are_pruned(spark):
    df = stage(spark.range(50).selectExpr("id", "id % 3 as part"), "rows", ("part",))
    assert "PartitionFilters: [isnotnull(part" in df.filter("part = 1")._jdf.queryExecution().toString()


def test_persisted_releases_even_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError):
        with persisted(df) as (held,):
            assert held.count() == 10 and held.is_cached
            raise RuntimeError
    assert not df.is_cached and not df.storageLevel.useMemory


def test_scoped_tables_go_with_the_block(spark):
    with scoped_staging(spark):
        inside, kept = stage(spark.range(5), "inside"), stage(spark.range(5), "kept", keep=True)
        assert inside.count() == 5
    assert kept.count() == 5
    outside = stage(spark.range(3), "outside")
    with pytest.raises(RuntimeError), scoped_staging(spark):
        failed = stage(spark.range(5), "failed")
        raise RuntimeError
    assert outside.count() == 3
    for gone in (inside, failed):
        with pytest.raises(Exception, match="(?i)does not exist|not.found"):
            gone.select("id").collect()


def test_shuffles_are_short_lived_inside_the_block_only(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP_SETTING, None)
    with pytest.raises(RuntimeError), short_lived_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP_SETTING) == "true"
        assert stage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counts").count() == 7
        raise RuntimeError
    assert spark.conf.get(SHUFFLE_CLEANUP_SETTING, None) == before
