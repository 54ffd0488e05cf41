import pytest

from tabwright.sources.runlog import log_run, read_runs
from tabwright.sources.tables import current_version, read_csv, read_parquet, write_csv, write_parquet, write_together


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text('k,v\n1,\n2,""\n3,"  "\n4," a "\n')
    rows = {r.k: r.v for r in read_csv(spark, str(path), "k int, v string").collect()}
    assert rows == {1: None, 2: None, 3: "  ", 4: " a "}


def test_csv_types_are_inferred_only_on_request(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text("k,v\n1,2.5\n")
    assert [t for _, t in read_csv(spark, str(path)).dtypes] == ["string", "string"]
    assert [t for _, t in read_csv(spark, str(path), infer=True).dtypes] == ["int", "double"]


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text("v,k\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(path), "k int, v int").collect()


def test_writes_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(5), path)
    write_parquet(spark.range(2), path)
    assert read_parquet(spark, path).count() == 2
    write_csv(spark.range(5), path + "c", single_file=True)
    assert len(list((tmp_path / "tc").glob("part-*"))) == 1


def test_csv_keeps_padding(spark, tmp_path):
    df = spark.createDataFrame([(1, "  a "), (2, "   "), (3, 'say "x", y')], "k int, v string")
    write_csv(df, str(tmp_path / "padded"))
    assert read_csv(spark, str(tmp_path / "padded"), "k int, v string").orderBy("k").collect() == df.collect()


def test_run_log_appends_and_prunes(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = log_run(spark, path, "one", "A", params={"depth": 8, "kind": "x"}, metrics={"f1": 0.5}, tags={"t": "y"})
    second = log_run(spark, path, "two", "B", artifacts={"model": "/m"})
    assert first != second
    rows = {(r.kind, r.key): (r.value_str, r.value_dbl) for r in read_runs(spark, path, "one").collect()}
    assert rows == {
        ("param", "depth"): ("8", 8.0),
        ("param", "kind"): ("x", None),
        ("metric", "f1"): (None, 0.5),
        ("tag", "t"): ("y", None),
    }
    assert read_runs(spark, path).count() == 5
    assert read_runs(spark, path, run_name="B").first().run_id == second
    plan = read_runs(spark, path, "one")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(experiment" in plan


def test_empty_run_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        log_run(spark, str(tmp_path), "one", "A")


def test_versioned_tables_change_together(spark, tmp_path):
    root = str(tmp_path / "out")
    assert write_together({"train": spark.range(5), "test": spark.range(2)}, root) == 1
    fails = spark.range(3).selectExpr("cast(raise_error('lost') as long) as id")
    with pytest.raises(Exception, match="lost"):
        write_together({"train": spark.range(9), "test": fails}, root)
    # The first of the two was written; the old pair is what readers see.
    assert [read_parquet(spark, f"{root}/{name}").count() for name in ("train", "test")] == [5, 2]
    assert len(list((tmp_path / "out" / "train").iterdir())) == 2
    assert write_together({"train": spark.range(7), "test": spark.range(3)}, root) == 2
    assert [read_parquet(spark, f"{root}/{name}/").count() for name in ("train", "test")] == [7, 3]
    assert write_together({"train": spark.range(8), "test": spark.range(4)}, root) == 3
    # Two versions are kept, and what no manifest names is gone.
    assert len(list((tmp_path / "out" / "train").iterdir())) == len(list((tmp_path / "out" / "test").iterdir())) == 2
    assert sorted(p.name for p in (tmp_path / "out" / "_manifest").glob("*.json")) == ["000000002.json", "000000003.json"]


def test_a_half_written_manifest_does_not_show(spark, tmp_path):
    root = str(tmp_path / "out")
    write_together({"a": spark.range(4)}, root)
    (tmp_path / "out" / "_manifest" / "000000002.draft").write_text('{"version": 2, "tab')
    assert read_parquet(spark, f"{root}/a").count() == 4
    assert write_together({"a": spark.range(6)}, root) == 2
    assert read_parquet(spark, f"{root}/a").count() == 6


def test_plain_tables_are_their_own_version(spark, tmp_path):
    write_parquet(spark.range(4), str(tmp_path / "plain"))
    assert current_version(spark, str(tmp_path / "plain")) == str(tmp_path / "plain")
