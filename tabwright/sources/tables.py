"""CSV and Parquet tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header row; one path or several, with wildcards or without.

    With a schema the file is read once, and a header that does not match it is an
    error. Without one every column is text; ``infer`` spends a further pass over the
    whole file on guessing types.
    """
    reader = spark.read.option("header", True)
    path = path if isinstance(path, str) else list(path)
    if schema is not None:
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Parquet table, restricted to ``columns`` when given; the last whole version of a versioned one."""
    df = spark.read.parquet(current_version(spark, path))
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the Parquet table at ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


MANIFEST = "_manifest"


def _files(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, root: str) -> list[str]:
    """Names of the manifests below ``root``, the latest first."""
    folder, files = _files(spark, f"{root}/{MANIFEST}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted((n for n in names if n.endswith(".json")), reverse=True)


def _manifest(spark: SparkSession, root: str, name: str) -> dict:
    return json.loads("".join(r["value"] for r in spark.read.text(f"{root}/{MANIFEST}/{name}").collect()))


def write_together(tables: Mapping[str, DataFrame], root: str, keep: int = 2) -> int:
    """A new version of all ``tables`` (by name) below ``root``; its number.

    Every table goes to a folder of its own, and a manifest that names them all is written
    last, under a name that no other version has. Readers go by the latest manifest, so the
    tables change together, and a job that dies in between leaves the old ones readable.
    The versions before the last ``keep`` are removed; what no manifest names and is not the
    one being written too. Several writers at a time need roots of their own.
    """
    spark = next(iter(tables.values())).sparkSession
    known = _manifests(spark, root)
    version = int(known[0].removesuffix(".json")) + 1 if known else 1
    folders = {name: f"{name}/{version:09d}-{uuid.uuid4().hex}" for name in tables}
    for name, df in tables.items():
        df.write.parquet(f"{root}/{folders[name]}")
    # Written under another name first: a listing never shows half a manifest.
    text = json.dumps({"version": version, "tables": folders})
    draft, files = _files(spark, f"{root}/{MANIFEST}/{version:09d}.draft")
    files.mkdirs(draft.getParent())
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target, _ = _files(spark, f"{root}/{MANIFEST}/{version:09d}.json")
    if not files.rename(draft, target):
        raise OSError(f"version {version} of {root} exists already")
    _remove_old(spark, root, list(tables), keep)
    return version


def _remove_old(spark: SparkSession, root: str, names: Sequence[str], keep: int) -> None:
    known = _manifests(spark, root)
    held = {f for m in known[:keep] for f in _manifest(spark, root, m)["tables"].values()}
    for name in known[keep:]:
        path, files = _files(spark, f"{root}/{MANIFEST}/{name}")
        files.delete(path, False)
    for name in names:
        folder, files = _files(spark, f"{root}/{name}")
        for status in files.listStatus(folder):
            if f"{name}/{status.getPath().getName()}" not in held:
                files.delete(status.getPath(), True)


def current_version(spark: SparkSession, path: str) -> str:
    """Where the rows of the table at ``path`` are: itself, or a folder that its root's manifest names."""
    root, _, name = path.rstrip("/").rpartition("/")
    for manifest in _manifests(spark, root)[:1] if root else []:
        folder = _manifest(spark, root, manifest)["tables"].get(name)
        if folder:
            return f"{root}/{folder}"
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace the CSV table at ``path``, padding included.

    ``single_file`` is for small result tables only.
    """
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
