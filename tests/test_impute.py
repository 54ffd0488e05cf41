import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabwright.operators import impute
from tabwright.operators.impute import apply_medians, exact_medians, fit_medians


def lower_median(values):
    ordered = sorted(v for v in values if v is not None and not np.isnan(v))
    return ordered[(len(ordered) + 1) // 2 - 1]


def frame(spark, **columns):
    names = list(columns)
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4)


@pytest.mark.parametrize("sampled", [300, 10**6])
def test_exact_median_by_narrowing_on_skewed_columns(spark, monkeypatch, sampled):
    monkeypatch.setattr(impute, "SAMPLED_ROWS", sampled)
    rng = np.random.default_rng(3)
    n = 20_000
    hot = np.where(rng.uniform(size=n) < 0.4, 5.0, rng.normal(size=n))
    columns = {
        "flat": rng.uniform(size=n).tolist(),
        "hot": hot.tolist(),
        "two": rng.choice([1.0, 2.0], n).tolist(),
        "same": [3.0] * n,
        "wide": np.exp(rng.normal(size=n) * 20).tolist(),
        "gaps": [None if u < 0.3 else float("nan") if u < 0.4 else u for u in rng.uniform(size=n).tolist()],
    }
    got = exact_medians(frame(spark, **columns), list(columns), exact_rows=50)
    assert got == {name: lower_median(values) for name, values in columns.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from([-2.0, 0.0, 1.0, 1.5, 9.0]) | st.floats(-100, 100), min_size=1, max_size=60))
def test_exact_median_of_any_list(spark, values):
    df = frame(spark, x=values)
    assert exact_medians(df, ["x"]) == {"x": lower_median(values)}
    assert exact_medians(df, ["x"], exact_rows=1) == {"x": lower_median(values)}


def test_approximate_median_is_within_one_percent(spark):
    rng = np.random.default_rng(5)
    values = rng.exponential(size=30_000)
    median = fit_medians(frame(spark, x=values.tolist()), ["x"])["x"]
    assert abs(np.mean(values <= median) - 0.5) <= 0.01


def test_column_without_values_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    for error in (0, 0.01):
        with pytest.raises(ValueError, match="no value in b"):
            fit_medians(df, ["a", "b"], error)


def test_fill_covers_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "a double")
    assert [r.a for r in apply_medians(df, {"a": 9.0}).collect()] == [1.0, 9.0, 9.0]
