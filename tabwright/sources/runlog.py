"""Append-only run log: one row per parameter, metric, tag or artifact of a named run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from numbers import Real

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = (
    "experiment string, run_name string, run_id string, kind string, key string, "
    "value_str string, value_dbl double, ts timestamp"
)


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    run_name: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
    artifacts: Mapping[str, str] | None = None,
) -> str:
    """Append one run to the log at ``path`` and return its id.

    An artifact is a name and the path where a table or model was stored.
    """
    run_id = uuid.uuid4().hex
    now = datetime.now(timezone.utc)
    entries = {"param": params, "metric": metrics, "tag": tags, "artifact": artifacts}
    rows = [
        (
            experiment,
            run_name,
            run_id,
            kind,
            key,
            None if kind == "metric" else str(value),
            float(value) if isinstance(value, Real) and not isinstance(value, bool) else None,
            now,
        )
        for kind, values in entries.items()
        for key, value in (values or {}).items()
    ]
    if not rows:
        raise ValueError("a run needs at least one parameter, metric, tag or artifact")
    log = spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1)
    log.write.mode("append").partitionBy("experiment").parquet(path)
    return run_id


def read_runs(
    spark: SparkSession, path: str, experiment: str | None = None, run_name: str | None = None
) -> DataFrame:
    """The log, narrowed to an experiment (prunes folders) and a run name when given."""
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    if experiment is not None:
        log = log.filter(F.col("experiment") == experiment)
    if run_name is not None:
        log = log.filter(F.col("run_name") == run_name)
    return log
