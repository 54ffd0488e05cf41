"""Raw CSV to chosen model, as a user runs it."""

from pathlib import Path

import pandas as pd
import pytest

from tabwright.__main__ import main
from tabwright.fixed import CUSTOMERS, MODELS
from tabwright.operators.evaluate import METRICS
from tabwright.operators import search
from tabwright.plans import clean as clean_plan
from tabwright.plans import train as train_plan
from tabwright.plans import tune as tune_plan
from tabwright.plans.clean import run_clean
from tabwright.plans.train import run_train
from tabwright.plans.tune import run_tune
from tabwright.operators.search import Choice
from tabwright.scratch import shared_folder
from tabwright.sources.models import load_model
from tabwright.sources.runlog import read_runs
from tests.customers import customers, untidy, write_csv


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    raw = write_csv(untidy(customers()), folder)
    run_clean(spark, raw, f"{folder}/train", f"{folder}/test", blank_as_null=True)
    return folder


def read(spark, folder, *names):
    return spark.read.parquet(*[f"{folder}/{n}" for n in names]).toPandas()


def test_clean_tables(spark, folder):
    both = read(spark, folder, "train", "test")
    assert len(both) == 3000
    assert set(both.columns) == {
        *CUSTOMERS.categorical,
        *CUSTOMERS.numeric,
        "label",
        "tenure_group",
        "service_count",
        "avg_monthly_spend",
    }
    assert not both.isna().any().any()
    assert not both.isin(["", " "]).any().any()
    assert (both.Partner == "Unknown").sum() >= 4
    assert "Zed" not in set(both.gender) or (both.gender == "Zed").sum() <= 10
    assert 0.77 < len(read(spark, folder, "train")) / 3000 < 0.83


def test_medians_of_train_or_of_everything(spark, tmp_path):
    df = untidy(customers())
    raw = write_csv(df, tmp_path)
    for source in ("train", "all"):
        run_clean(spark, raw, f"{tmp_path}/{source}-a", f"{tmp_path}/{source}-b", medians_from=source, median_error=0.0, keep_key=True)
    number = lambda s: pd.to_numeric(s, errors="coerce")
    everything = number(df.MonthlyCharges).dropna().sort_values().reset_index(drop=True)
    got = read(spark, tmp_path, "all-a", "all-b").set_index("customerID").MonthlyCharges["0016-C"]
    assert got == everything[(len(everything) + 1) // 2 - 1]
    train = read(spark, tmp_path, "train-a")
    got = read(spark, tmp_path, "train-a", "train-b").set_index("customerID").MonthlyCharges["0016-C"]
    known = train[train.customerID != "0016-C"].MonthlyCharges.sort_values().reset_index(drop=True)
    assert got == known[(len(known) + 1) // 2 - 1]


def test_several_files_and_wildcards(spark, tmp_path):
    df = customers(400)
    for i, part in enumerate((df[:150], df[150:])):
        part.to_csv(tmp_path / f"part{i}.csv", index=False)
    single = write_csv(df, tmp_path)
    shares = []
    for name, raw in (("one", single), ("glob", f"{tmp_path}/part*.csv"), ("list", [f"{tmp_path}/part{i}.csv" for i in (0, 1)])):
        run_clean(spark, raw, f"{tmp_path}/{name}-a", f"{tmp_path}/{name}-b", keep_key=True)
        shares.append(read(spark, tmp_path, f"{name}-a", f"{name}-b").sort_values("customerID", ignore_index=True))
    assert shares[0].equals(shares[1]) and shares[0].equals(shares[2])


def test_other_column_order_is_an_error(spark, tmp_path):
    raw = write_csv(customers(20)[["gender", "customerID", *CUSTOMERS.columns[2:]]], tmp_path)
    with pytest.raises(Exception, match="CSV header does not conform"):
        run_clean(spark, raw, f"{tmp_path}/a", f"{tmp_path}/b")


def test_rows_and_classes_per_part(spark, tmp_path):
    raw = write_csv(customers(300), tmp_path)
    rows = run_clean(spark, raw, f"{tmp_path}/a", f"{tmp_path}/b").collect()
    for part, path in (("train", "a"), ("test", "b")):
        labels = read(spark, tmp_path, path).label.value_counts()
        assert {r.label: r["count"] for r in rows if r.part == part} == labels.to_dict()
        assert sum(r.percentage for r in rows if r.part == part) == pytest.approx(100)


def test_blank_categories_are_told_of_early(spark, tmp_path):
    df = customers(60).astype(object)
    df.loc[3, "Partner"] = "  "
    raw = write_csv(df, tmp_path)
    with pytest.warns(UserWarning, match="blank categories in Partner"):
        run_clean(spark, raw, f"{tmp_path}/a", f"{tmp_path}/b")
    with pytest.raises(ValueError, match="blank categories in Partner"):
        run_clean(spark, raw, f"{tmp_path}/c", f"{tmp_path}/d", refuse_blanks=True)
    assert not (tmp_path / "c").exists()
    run_clean(spark, raw, f"{tmp_path}/e", f"{tmp_path}/f", refuse_blanks=True, blank_as_null=True)


def test_jobs_ask_for_the_shared_folder_first(spark, monkeypatch):
    def missing(_):
        raise ValueError("no shared folder")

    for module, call in (
        (clean_plan, lambda: run_clean(spark, "nowhere", "x", "y")),
        (train_plan, lambda: run_train(spark, "nowhere", "x", "y")),
        (tune_plan, lambda: run_tune(spark, "nowhere", "x", "y")),
    ):
        monkeypatch.setattr(module, "shared_folder", missing)
        with pytest.raises(ValueError, match="no shared folder"):
            call()


def staged(spark):
    root = Path(shared_folder(spark).removeprefix("file:")) / "tabwright"
    return {p.name.rsplit("-", 1)[0]: p for p in root.glob("*/*") if p.is_dir()}


def test_no_intermediate_table_remains(spark, folder, monkeypatch):
    small = {"numTrees": Choice((2,)), "maxDepth": Choice((2,)), "maxBins": Choice((32,)), "minInstancesPerNode": Choice((1,))}
    monkeypatch.setitem(tune_plan.SPACES, "RandomForest", small)
    before = set(staged(spark).values())
    raw = write_csv(customers(200), folder)
    run_clean(spark, raw, f"{folder}/small-train", f"{folder}/small-test", medians_from="all")
    assert set(staged(spark).values()) == before
    run_train(spark, f"{folder}/small-train", f"{folder}/small-test", f"{folder}/o1", forest_settings={"numTrees": 2})
    tuned = run_tune(spark, f"{folder}/small-train", f"{folder}/small-test", f"{folder}/o2", trials=1)
    left = {p.name.rsplit("-", 1)[0] for p in set(staged(spark).values()) - before}
    assert left <= {"metrics"}
    assert tuned.count() == 12


def test_checks_and_stages_are_shared(spark, folder, monkeypatch):
    calls = []
    for name in ("training_facts", "build_pipeline"):
        real = getattr(search, name)
        monkeypatch.setattr(search, name, lambda *a, _real=real, _name=name, **k: calls.append(_name) or _real(*a, **k))
    run_train(spark, f"{folder}/train", f"{folder}/test", f"{folder}/o3", forest_settings={"numTrees": 2})
    assert sorted(calls) == ["build_pipeline", "training_facts"]


def test_unknown_median_source_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        run_clean(spark, "x", "y", "z", medians_from="test")


def test_train_finds_the_signal(spark, folder):
    out = f"{folder}/train-out"
    metrics = run_train(
        spark, f"{folder}/train", f"{folder}/test", out, forest_settings={"numTrees": 10, "maxDepth": 5}
    ).collect()
    assert {(r.model, r.metric) for r in metrics} == {(m, x) for m in MODELS for x in METRICS}
    assert all(r.value > 0.75 for r in metrics if r.metric == "roc_auc")
    log = read_runs(spark, f"{out}/runs").toPandas()
    assert set(log.run_name) == set(MODELS)
    stored = log[(log.kind == "artifact") & (log.run_name == "LogisticRegression")].value_str.item()
    test = spark.read.parquet(f"{folder}/test")
    assert load_model(stored).transform(test).count() == test.count()


def test_tune_searches_refits_and_chooses(spark, folder, monkeypatch):
    small = {"numTrees": Choice((6, 12)), "maxDepth": Choice((3, 5)), "maxBins": Choice((32,)), "minInstancesPerNode": Choice((1, 2))}
    monkeypatch.setitem(tune_plan.SPACES, "RandomForest", small)
    out = f"{folder}/tune-out"
    metrics = run_tune(spark, f"{folder}/train", f"{folder}/test", out, trials=2).toPandas()
    assert set(metrics.model) == set(MODELS) and (metrics[metrics.metric == "roc_auc"].value > 0.75).all()

    log = read_runs(spark, f"{out}/runs").toPandas()
    assert set(log.run_name) == {
        "Search_LogisticRegression",
        "Search_RandomForest",
        "Final_LogisticRegression",
        "Final_RandomForest",
        "Best_Model_Selection",
    }
    areas = metrics[metrics.metric == "roc_auc"].set_index("model").value
    chosen = log[(log.run_name == "Best_Model_Selection") & (log.key == "best_model")].value_str.item()
    assert areas[chosen] == areas.max()
    trials = spark.read.option("header", True).csv(f"{out}/trials/RandomForest")
    assert trials.columns == ["trial_id", *small, *METRICS] and trials.count() == 2


def test_command_line(spark, tmp_path, capsys):
    raw = write_csv(customers(300), tmp_path)
    main(["profile", "--raw", raw])
    main(["clean", "--raw", raw, "--train", f"{tmp_path}/train", "--test", f"{tmp_path}/test"])
    shown = capsys.readouterr().out
    assert "TotalCharges" in shown and "percentage" in shown
    assert "n_rows" in shown and "double" in shown and "int" in shown
    assert spark.read.parquet(f"{tmp_path}/train", f"{tmp_path}/test").count() == 300
