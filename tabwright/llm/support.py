"""What the operators share: the session's Python workers, words, and columns made from texts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# Rows of one Arrow batch; a long text then meets few neighbours in a worker's memory.
BATCH_ROWS = 400
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and keep their batches small."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root
    if int(spark.conf.get(BATCH_SETTING)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return spark


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_text(column: str) -> Column:
    """The id as text; a null id counts as the empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bounded(small: DataFrame, rows: int) -> DataFrame:
    """To be broadcast when counted and of at most ``rows`` rows; else Spark picks the join."""
    return F.broadcast(small) if small.count() <= rows else small


def text_column(function: Callable[[list[str]], list[dict]], fields: str) -> Callable[[Column], Column]:
    """A column of structs with the DDL ``fields``, from a function of a batch of texts."""
    kind = StructType.fromDDL(fields)
    arrow_kind = to_arrow_type(kind)

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array(function(texts.to_pylist()), type=arrow_kind)

    return F.arrow_udf(batch, kind)


def with_results(
    docs: DataFrame, column: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and the fields of ``column`` for every row; the text is read once."""
    prepare(docs.sparkSession)
    found = docs.select(F.col(id_col), column(text_or_empty(text_col)).alias("found"))
    return found.select(F.col(id_col), "found.*")


def lower_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; splitting bytes knows ASCII space only."""
    return text.lower().split()


class WordIds:
    """Small consecutive ids for the words of one task, and a 64-bit hash of each."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self._hashes = np.empty(0, np.uint64)

    def __call__(self, words: list[bytes]) -> list[int]:
        ids = self.ids
        return [ids.setdefault(w, len(ids)) for w in words]

    def hashes(self) -> np.ndarray:
        """Hash by id."""
        known = len(self._hashes)
        if known < len(self.ids):
            fresh = list(self.ids)[known:] if known else list(self.ids)
            more = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in fresh), np.uint64, len(fresh))
            self._hashes = np.concatenate([self._hashes, more])
        return self._hashes


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (multiply and shift, twice)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return values ^ (values >> np.uint64(32))


def chained(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` neighbouring hashes; order counts."""
    with np.errstate(over="ignore"):
        n = len(hashes) - length + 1
        out = mix(hashes[:n])
        for i in range(1, length):
            out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + n])
        return out
