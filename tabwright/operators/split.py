"""Repeatable splits by key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.fixed import SEED, TRAIN_SHARE
from tabwright.functions import digest
from tabwright.scratch import stage

# Salt of the nested split; it must differ from the outer seed, or the two would correlate.
VALIDATION_SALT = "validation-42"


def in_first_part(keys: Sequence[str], share: float = TRAIN_SHARE, salt: str | int = SEED) -> Column:
    """True for about ``share`` of the keys.

    Hexadecimal digests sort like the numbers they write, so comparing text with the
    share's first 32 bits is enough. Never null: each row is in one part only.
    """
    if not 0.0 <= share <= 1.0:
        raise ValueError("share must lie between 0 and 1")
    threshold = round(share * 2**32)
    if threshold == 2**32:
        return F.lit(True)
    return digest(salt, *keys) < F.lit(f"{threshold:08x}")


def hash_split(
    df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, salt: str | int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Two parts that depend on the key only: not on partitions, order or other rows."""
    first = in_first_part(keys, share, salt)
    return df.filter(first), df.filter(~first)


@dataclass(frozen=True)
class Parts:
    """The split, and the nested split of the training rows."""

    train: DataFrame
    test: DataFrame
    tuning: DataFrame
    validation: DataFrame

    def __iter__(self) -> Iterator[DataFrame]:
        """Train and test, to be unpacked like the result of ``hash_split``."""
        return iter((self.train, self.test))


def staged_split(df: DataFrame, keys: Sequence[str], name: str) -> Parts:
    """Both splits of ``df``, staged part by part: readers of a part compute no digests again."""
    part = (
        F.when(~in_first_part(keys), "test")
        .when(in_first_part(keys, salt=VALIDATION_SALT), "tuning")
        .otherwise("validation")
    )
    rows = stage(df.withColumn("_part", part), name, ("_part",))

    def of(*parts: str) -> DataFrame:
        return rows.filter(F.col("_part").isin(*parts)).select(*df.columns)

    return Parts(of("tuning", "validation"), of("test"), of("tuning"), of("validation"))


def random_split(df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Split without a key; repeats only on the same layout of the same rows."""
    first, second = df.randomSplit([share, 1.0 - share], seed=seed)
    return first, second
