"""Small tables for the document operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list, langs: list | None = None, sources: list | None = None) -> DataFrame:
    """Documents with ids 0, 1, 2, ... (or with the ids of (id, text) pairs)."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (i, text)
        lang, source = langs[i] if langs else None, sources[i] if sources else None
        rows.append((doc_id, text, lang, source, len(text or "")))
    return spark.createDataFrame(rows, DOCUMENT)


def by_id(df: DataFrame) -> dict:
    return {r["doc_id"]: r for r in df.collect()}
