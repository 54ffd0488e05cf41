"""Medians as fitted scalars, and filling with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.fixed import MEDIAN_ERROR, SEED

# Rows inside the bracket that one exact percentile may hold in memory.
EXACT_ROWS = 200_000
# About how many values to sample for narrowing the bracket, and how far around the
# wanted rank its ends lie: six standard deviations of a sampled rank.
SAMPLED_ROWS = 1_000_000
MARGIN = 0.003
SKETCH_ACCURACY = 10_000


def _number(df: DataFrame, column: str) -> Column:
    """The column as a double with NaN read as missing."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def _require(medians: Mapping[str, float | None]) -> dict[str, float]:
    empty = sorted(c for c, m in medians.items() if m is None)
    if empty:
        raise ValueError(f"no median: no value in {', '.join(empty)}")
    return dict(medians)


def fit_medians(
    df: DataFrame, columns: Sequence[str], relative_error: float = MEDIAN_ERROR
) -> dict[str, float]:
    """Medians of several columns in one job, each within ``relative_error`` of its rank.

    Nulls and NaN are left out. An error of 0 gives the exact lower median. Sketches
    are merged map-side, so one row per task reaches the last stage.
    """
    if relative_error == 0:
        return exact_medians(df, columns)
    accuracy = max(1, round(1 / relative_error))
    sketches = [F.percentile_approx(_number(df, c), 0.5, accuracy).alias(c) for c in columns]
    return _require(df.agg(*sketches).first().asDict())


@dataclass
class _Bracket:
    """The wanted value is number ``rank`` of the ``rows`` values between the two ends."""

    rows: int
    rank: int
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def inside(self, value: Column) -> Column:
        within = value.isNotNull()
        if self.low is not None:
            within = within & (value > self.low)
        if self.high is not None:
            within = within & (value < self.high)
        return within

    def sampled(self) -> Column:
        share = SAMPLED_ROWS / self.rows
        return F.lit(True) if share >= 1 else F.rand(SEED) < share

    @property
    def open(self) -> bool:
        return self.answer is None and self.rows > 0


def exact_medians(
    df: DataFrame, columns: Sequence[str], exact_rows: int = EXACT_ROWS
) -> dict[str, float]:
    """Exact lower medians, whatever the size and skew of the columns.

    Each round picks two values around the wanted rank from a sample and then counts,
    over all rows, what lies below, on and between them; the sample only decides how
    fast the search goes. A value that many rows share is settled by its count; what
    lies strictly between shrinks to a small part of the rows. Once few rows are left,
    an exact percentile over them ends the search. A round shuffles one row per task,
    and all its sketches together hold no more than the sampled values.
    """
    values = {c: _number(df, c) for c in columns}
    sizes = df.agg(*[F.count(v).alias(c) for c, v in values.items()]).first().asDict()
    brackets = {c: _Bracket(rows=n, rank=(n + 1) // 2) for c, n in sizes.items()}

    while any(b.open for b in brackets.values()):
        small = {c: b for c, b in brackets.items() if b.open and b.rows <= exact_rows}
        wide = {c: b for c, b in brackets.items() if b.open and b.rows > exact_rows}
        inside = df.select(
            [F.when(b.inside(values[c]), values[c]).alias(c) for c, b in small.items()]
            + [F.when(b.inside(values[c]) & b.sampled(), values[c]).alias(c) for c, b in wide.items()]
        )
        exact = [
            F.expr(f"percentile_disc({(b.rank - 0.5) / b.rows}D) within group (order by `{c}`)").alias(c)
            for c, b in small.items()
        ]
        sketched = [
            F.percentile_approx(
                F.col(f"`{c}`"),
                [max(b.rank / b.rows - MARGIN, 0.0), min(b.rank / b.rows + MARGIN, 1.0)],
                SKETCH_ACCURACY,
            ).alias(c)
            for c, b in wide.items()
        ]
        found = inside.agg(*exact, *sketched).first().asDict()
        for c, b in small.items():
            b.answer = found[c]
        if wide:
            _narrow(df, values, wide, {c: found[c] for c in wide})
    return _require({c: b.answer for c, b in brackets.items()})


def _narrow(
    df: DataFrame,
    values: Mapping[str, Column],
    brackets: Mapping[str, _Bracket],
    ends: Mapping[str, Sequence[float]],
) -> None:
    """Count around the picked ends and move each bracket to the part with its rank."""
    counts = []
    for c, b in brackets.items():
        v, (low, high) = values[c], ends[c]
        inside = b.inside(v)
        counts += [
            F.count_if(inside & (v < low)).alias(f"{c}:below"),
            F.count_if(inside & (v == low)).alias(f"{c}:low"),
            F.count_if(inside & (v > low) & (v < high)).alias(f"{c}:between"),
            F.count_if(inside & (v == high) & (v > low)).alias(f"{c}:high"),
        ]
    row = df.agg(*counts).first()
    for c, b in brackets.items():
        low, high = ends[c]
        below, at_low, between, at_high = (row[f"{c}:{p}"] for p in ("below", "low", "between", "high"))
        above = b.rows - below - at_low - between - at_high
        rank = b.rank
        if rank <= below:
            b.rows, b.high = below, low
        elif rank <= below + at_low:
            b.answer = low
        elif rank <= below + at_low + between:
            b.rows, b.rank, b.low, b.high = between, rank - below - at_low, low, high
        elif rank <= b.rows - above:
            b.answer = high
        else:
            b.rows, b.rank, b.low = above, rank - (b.rows - above), high


def apply_medians(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Fill null and NaN with the fitted medians."""
    return df.fillna(dict(medians))
