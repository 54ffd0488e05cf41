import pytest

from tabwright import sizing


def test_partitions_follow_the_stored_size(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "b").write_bytes(b"x" * 500)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with sizing.sized_shuffles(spark, str(tmp_path)) as n:
        assert n == current
    monkeypatch.setattr(sizing, "PARTITION_BYTES", 10)
    with sizing.sized_shuffles(spark, str(tmp_path)) as n:
        assert n == 150 and spark.conf.get(sizing.SETTING) == "150"
        text = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()._jdf.queryExecution().toString()
        assert ", 150), ENSURE_REQUIREMENTS" in text
    assert spark.conf.get(sizing.SETTING, None) is None
    with sizing.sized_shuffles(spark, str(tmp_path / "a"), str(tmp_path / "b")) as n:
        assert n == 150


def test_sizes_of_wildcards(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x" * 1000)
    (tmp_path / "b.csv").write_bytes(b"x" * 500)
    assert sizing.stored_bytes(spark, f"{tmp_path}/*.csv") == 1500
    assert sizing.stored_bytes(spark, f"{tmp_path}/a*") == 1000
    with pytest.raises(FileNotFoundError):
        sizing.stored_bytes(spark, f"{tmp_path}/*.txt")
