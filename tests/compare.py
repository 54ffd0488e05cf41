"""A local session, the driver's tables in DuckDB, and comparing two results."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession


def local_spark(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabwright-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, plain values, rows in order."""
    out = df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
    for c in out.columns:
        out[c] = [str(v.item() if hasattr(v, "item") else v) for v in out[c]]
    return out.sort_values(list(out.columns), ignore_index=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None when both hold the same rows in any order, else what differs first."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    kinds = [
        f"{c}: {spark_rows[c].dtype} / {sql_rows[c].dtype}"
        for c in spark_rows.columns
        if spark_rows[c].dtype.kind != sql_rows[c].dtype.kind
    ]
    left, right = _normal(spark_rows), _normal(sql_rows)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        at = unequal.idxmax()
        return f"{int(unequal.sum())} rows, first {dict(left.loc[at])} / {dict(right.loc[at])} {kinds}"
    return None
