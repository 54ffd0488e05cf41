"""Hard negatives by inner products, with length buckets and coordinate pruning.

Vectors become whole numbers. Sorted by length they are cut into buckets, and each bucket
holds, for every coordinate, the list of its rows in the order of that coordinate of the
normalised vectors. A question is an anchor, an interval of scores and a number of rows
wanted; a score of ``low`` or more needs a cosine of at least ``low / (|anchor| * longest)``
in a bucket. A bucket where that is above 1 is skipped before any row travels. In the others
the cosine bounds every coordinate from both sides: the rows of a list inside its feasible
range are found by binary search. The narrowest ranges of an anchor (its focus coordinates)
are intersected, and what is left is verified by exact products. Where even the narrowest
range holds most of a bucket, lists cannot help, and the bucket is verified as a whole by
one matrix product.

Positives are asked for first, then negatives in the interval that each positive allows.
The lower ends start from the best rows of the anchor's own block, which are true rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.support import prepare
from tabwright.scratch import stage

# Rows of a length bucket and anchors of a block: what one task holds of either side.
BUCKET_ROWS = 8_192
BLOCK_ROWS = 4_096
# Coordinates whose lists are intersected, and the share of a bucket above which lists do not help.
FOCUS = 4
WHOLE_SHARE = 0.25
# Scores held at a time while a bucket is verified as a whole.
CHUNK_SCORES = 1_000_000
# Squared lengths (in units of 1 / scale) from which on scores could leave 64 bits.
LONGEST = 2**55
LEAST, MOST = -(2**62), 2**62
SLACK = 1e-7

INDEX = "bucket long, dim int, n int, longest double, kind string, ids binary, labels binary, vectors binary, lists binary"
BLOCK = (
    "block int, dim int, n int, needed double, kind string, ids binary, labels binary, vectors binary, "
    "owners binary, names binary, lows binary, highs binary"
)


def exact_type(first: float, second: float) -> type:
    """The cheapest number type in which products of vectors of these squared lengths are exact."""
    bound = np.sqrt(first * second)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


def _squares(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide * wide).sum(axis=1)


class Bucket:
    """Rows of similar length, and the sorted list of each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lists: np.ndarray | None = None) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.squares = _squares(vectors)
        lengths = np.sqrt(self.squares)
        self.longest = float(lengths.max(initial=0.0))
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        # A row per coordinate.
        self.unit = np.ascontiguousarray(unit.T)
        small = np.uint16 if len(ids) < 2**16 else np.uint32
        self.lists = np.argsort(self.unit, axis=1, kind="stable").astype(small) if lists is None else lists
        self.sorted = np.take_along_axis(self.unit, self.lists.astype(np.int64), axis=1)

    def __len__(self) -> int:
        return len(self.ids)


@dataclass
class Questions:
    """Anchors, and for each question its anchor's place, a name and the interval of scores."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    owners: np.ndarray
    names: np.ndarray
    lows: np.ndarray
    highs: np.ndarray

    def lengths(self) -> np.ndarray:
        return np.sqrt(_squares(self.vectors))


def feasible(anchors: np.ndarray, lengths: np.ndarray, lows: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the feasible range of every coordinate for a score of ``lows`` or more.

    Unit vectors at an angle of at most g differ in the angle to any axis by at most g.
    """
    reach = lengths * longest
    cosine = np.where((lows > 0) & (reach > 0), lows / np.where(reach > 0, reach, 1), -1.0)
    angle = np.arccos(np.clip(cosine, -1, 1))[:, None]
    own = np.arccos(np.clip(anchors / np.where(lengths > 0, lengths, 1)[:, None], -1, 1))
    return np.cos(np.minimum(np.pi, own + angle)) - SLACK, np.cos(np.maximum(0, own - angle)) + SLACK


def _first(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of each row: greater scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, rows))
    ordered = rows[order]
    starts = np.searchsorted(ordered, ordered, side="left")
    return order[np.arange(len(order)) - starts < k]


class Search:
    """Answers questions from one bucket; ``verified`` counts the exact products."""

    def __init__(self, bucket: Bucket, asked: Questions, same_label: bool, k: int) -> None:
        self.bucket, self.asked, self.same, self.k = bucket, asked, same_label, k
        widest = _squares(asked.vectors).max(initial=0.0)
        self.kind = exact_type(bucket.squares.max(initial=0.0), widest)
        self.matrix = bucket.vectors.astype(self.kind)
        self.anchors = asked.vectors.astype(self.kind)
        self.verified = 0

    def answers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Question, place in the bucket and score of at most ``k`` rows per question."""
        asked, bucket = self.asked, self.bucket
        found = [(np.empty(0, np.int64),) * 3]
        if len(bucket) and len(asked.owners):
            lengths = asked.lengths()[asked.owners]
            open_ = np.flatnonzero((asked.lows <= 0) | (asked.lows <= lengths * bucket.longest * (1 + SLACK)))
            for start in range(0, len(open_), 1024):
                some = open_[start : start + 1024]
                low, high = feasible(asked.vectors[asked.owners[some]], lengths[some], asked.lows[some], bucket.longest)
                begins = np.empty(low.shape, np.int64)
                ends = np.empty(low.shape, np.int64)
                for f in range(low.shape[1]):
                    begins[:, f] = np.searchsorted(bucket.sorted[f], low[:, f], side="left")
                    ends[:, f] = np.searchsorted(bucket.sorted[f], high[:, f], side="right")
                sizes = ends - begins
                least = sizes.min(axis=1, initial=len(bucket))
                whole = least > WHOLE_SHARE * len(bucket)
                found += self._all_rows(some[whole])
                for i in np.flatnonzero(~whole & (least > 0)):
                    found.append(self._listed(some[i], low[i], high[i], begins[i], ends[i]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _listed(self, question: int, low, high, begins, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By the lists of the focus coordinates."""
        focus = np.argsort(ends - begins, kind="stable")[:FOCUS]
        rows = self.bucket.lists[focus[0], begins[focus[0]] : ends[focus[0]]].astype(np.int64)
        for f in focus[1:]:
            at = self.bucket.unit[f, rows]
            rows = rows[(at >= low[f]) & (at <= high[f])]
        owner = self.asked.owners[question]
        self.verified += len(rows)
        scores = (self.matrix[rows] @ self.anchors[owner]).astype(np.int64)
        fits = (self.bucket.labels[rows] == self.asked.labels[owner]) == self.same
        fits &= self.bucket.ids[rows] != self.asked.ids[owner]
        fits &= (scores >= self.asked.lows[question]) & (scores <= self.asked.highs[question])
        rows, scores = rows[fits], scores[fits]
        keep = _first(np.zeros(len(rows), np.int64), scores, self.bucket.ids[rows], self.k)
        return np.full(len(keep), question), rows[keep], scores[keep]

    def _all_rows(self, questions: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By one product with the whole bucket; questions of one anchor share it."""
        bucket, asked = self.bucket, self.asked
        step = max(1, CHUNK_SCORES // len(bucket))
        for start in range(0, len(questions), step):
            some = questions[start : start + step]
            anchors, place = np.unique(asked.owners[some], return_inverse=True)
            scores = (self.anchors[anchors] @ self.matrix.T)[place]
            self.verified += len(anchors) * len(bucket)
            owners = asked.owners[some]
            fits = (bucket.labels[None, :] == asked.labels[owners][:, None]) == self.same
            fits &= bucket.ids[None, :] != asked.ids[owners][:, None]
            wide = scores if self.kind is np.int64 else scores.astype(np.float64)
            fits &= (wide >= asked.lows[some][:, None]) & (wide <= asked.highs[some][:, None])
            if len(bucket) > self.k and fits.sum() > 8 * self.k * len(some):
                # Only scores that reach the k-th best of their question need an order.
                floor = np.partition(np.where(fits, wide, LEAST), -self.k, axis=1)[:, -self.k]
                fits &= wide >= floor[:, None]
            row, column = np.nonzero(fits)
            value = scores[row, column].astype(np.int64)
            keep = _first(row, value, bucket.ids[column], self.k)
            yield some[row[keep]], column[keep], value[keep]


def raised(asked: Questions, same_label: bool, k: int) -> Questions:
    """The questions with lower ends from the anchors themselves: ``k`` of them already reach it."""
    question, _, scores = Search(Bucket(asked.ids, asked.labels, asked.vectors), asked, same_label, k).answers()
    full = np.flatnonzero(np.bincount(question, minlength=len(asked.owners)) == k)
    floor = np.full(len(asked.owners), MOST, np.int64)
    np.minimum.at(floor, question, scores)
    asked.lows[full] = np.maximum(asked.lows[full], floor[full])
    return asked


def _packed(vectors: np.ndarray) -> np.ndarray:
    """In the narrowest whole-number type of two bytes or more."""
    top = int(np.abs(vectors).max(initial=0))
    return vectors.astype("<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8")


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, dim)
    if batch.num_rows and _squares(vectors).max() >= LONGEST:
        raise ValueError(f"vectors must be shorter than {LONGEST**0.5:.0f} units: scores would not fit into a long")
    return vectors


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows equal in ``keys`` together, at most ``rows`` at a time; the input is sorted by them."""
    held: list[pa.RecordBatch] = []
    last, count = None, 0
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        start = 0
        for i, key in enumerate(zip(*columns, strict=True)):
            if key != last or count == rows:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.concat_batches(held)
                held, start, last, count = [], i, key, 0
            count += 1
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)


def _batch(schema: pa.Schema, values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _arrow(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])


def _numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy().astype(np.int64)


def index_buckets(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """A row per length bucket, with its vectors and its sorted lists packed."""
    schema = _arrow(INDEX)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for run in _runs(batches, ["dim"], bucket_rows):
            dim = run.column("dim")[0].as_py()
            vectors = _matrix(run, dim)
            bucket = Bucket(_numbers(run, "id"), _numbers(run, "label"), vectors)
            packed = _packed(vectors)
            values = [number, dim, len(bucket), bucket.longest, packed.dtype.str]
            yield _batch(schema, [*values, *[x.tobytes() for x in (bucket.ids, bucket.labels, packed, bucket.lists)]])
            number += 1

    parts = max(1, -(-rows.count() // bucket_rows))
    order = ["dim", F.desc("square"), "id"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select("id", "label", "dim", "vector").mapInArrow(pack, INDEX)


def _question_blocks(asked: DataFrame, block_rows: int, same_label: bool, k: int) -> DataFrame:
    """A row per block of anchors, with lower ends raised by the block's own rows.

    ``needed`` is the least length a row needs for any question of the block.
    """
    schema = _arrow(BLOCK)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["block", "dim"], 2**62):
            block, dim = run.column("block")[0].as_py(), run.column("dim")[0].as_py()
            sizes = np.diff(run.column("names").offsets.to_numpy())
            names, lows, highs = [run.column(c).flatten().to_numpy().astype(np.int64) for c in ("names", "lows", "highs")]
            vectors = _matrix(run, dim)
            owners = np.repeat(np.arange(run.num_rows), sizes)
            asked = Questions(_numbers(run, "id"), _numbers(run, "label"), vectors, owners, names, lows.copy(), highs)
            asked = raised(asked, same_label, k)
            lengths = asked.lengths()[owners]
            needed = np.where(asked.lows > 0, asked.lows / np.where(lengths > 0, lengths, 1), 0.0).min(initial=np.inf)
            packed = _packed(vectors)
            arrays = [asked.ids, asked.labels, packed, asked.owners, asked.names, asked.lows, asked.highs]
            yield _batch(schema, [block, dim, run.num_rows, needed, packed.dtype.str, *[x.tobytes() for x in arrays]])

    blocks = max(1, -(-asked.count() // block_rows))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).repartition("block")
    dealt = dealt.sortWithinPartitions("block", "dim", "id")
    return dealt.select("block", "dim", "id", "label", "vector", "names", "lows", "highs").mapInArrow(pack, BLOCK)


def _unpacked(row: dict, fields: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(row[f], np.int64) for f in fields]


def _answer(same_label: bool, k: int):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "name", "row_id", "score")])

    def answer(index: pa.Table, blocks: pa.Table) -> pa.Table:
        found = [schema.empty_table()]
        for row in index.to_pylist():
            ids, labels = _unpacked(row, ["ids", "labels"])
            vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(row["n"], row["dim"])
            lists = np.frombuffer(row["lists"], np.uint16 if row["n"] < 2**16 else np.uint32).reshape(row["dim"], row["n"])
            bucket = Bucket(ids, labels, vectors, lists)
            for block in blocks.to_pylist():
                ids, labels, *rest = _unpacked(block, ["ids", "labels", "owners", "names", "lows", "highs"])
                vectors = np.frombuffer(block["vectors"], block["kind"]).reshape(block["n"], block["dim"])
                asked = Questions(ids, labels, vectors, *rest)
                question, place, score = Search(bucket, asked, same_label, k).answers()
                columns = [asked.ids[asked.owners[question]], asked.names[question], bucket.ids[place], score]
                found.append(pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema))
        return pa.concat_tables(found)

    return answer


def best_rows(index: DataFrame, asked: DataFrame, same_label: bool, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, name, row_id, score and rank of each question's first ``k`` rows.

    ``index`` comes from ``index_buckets``; ``asked`` has id, label, dim, vector, and lists
    names, lows and highs, an entry per question. Rows of the same label as the anchor
    answer, or those of another label.
    """
    blocks = stage(_question_blocks(asked, block_rows, same_label, k), "questions")
    parts = blocks.agg(F.max("block")).first()[0]
    every = F.sequence(F.lit(0), F.lit(parts or 0))
    needed = blocks.select("block", "dim", "needed")
    # A bucket whose longest row is too short for a block's questions never meets it.
    pairs = (
        index.select("bucket", "dim", "longest", F.explode(every).alias("block"))
        .join(needed, ["block", "dim"]).filter(F.col("needed") <= F.col("longest") * (1 + SLACK))
        .select("bucket", "block", "dim")
    )
    pairs = stage(pairs, "pairs")
    keys = ["bucket", "block", "dim"]
    left = index.join(pairs, ["bucket", "dim"]).groupBy(*keys)
    right = blocks.join(pairs, ["block", "dim"]).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(_answer(same_label, k), "anchor_id long, name long, row_id long, score long")
    order = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    bucket_rows: int = BUCKET_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    A component x counts as floor(scale * x); a score is the whole-number inner product with
    the anchor. Rows that meet ``anchors`` (a condition on the table's columns) are anchors.
    An anchor's positives are its best ``positives`` other rows of the same label; for each,
    the best ``negatives`` rows of another label with a score between ``least_percent`` of
    the positive's and the positive's own are returned (none for a positive score below 0).
    Greater scores come first, ties by smaller id.

    Rows without id, label or vector, or with a null, NaN or infinite component, take no
    part. Rows that repeat an id count once, with the least (label, vector). Vectors meet
    vectors of their own length only; a zero or empty vector scores 0 with all. Vectors so
    long that scores leave 64 bits are an error. Other columns are not read; without rows or
    anchors there is no result. Every anchor meets every row, in blocks: the work grows with
    anchors times rows, and lists leave out what they can.
    """
    prepare(vectors.sparkSession)
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("wide")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), wide,
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).filter("id is not null and label is not null and wide is not null")
    bad = F.exists("wide", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("wide", lambda x: F.floor(x * scale)).alias("vector")
    rows = rows.filter(~bad).select("id", "is_anchor", F.struct("label", whole).alias("row"))
    rows = rows.groupBy("id").agg(F.min("row").alias("row"), F.max("is_anchor").alias("is_anchor"))
    square = F.aggregate("row.vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = stage(rows.select("id", "is_anchor", "row.*", F.size("row.vector").alias("dim"), square.alias("square")), "rows")

    index = stage(index_buckets(rows, bucket_rows), "buckets")
    chosen = rows.filter("is_anchor").select("id", "label", "dim", "vector")
    any_score = [F.array(F.lit(x).cast("long")).alias(c) for x, c in ((0, "names"), (LEAST, "lows"), (MOST, "highs"))]
    first = best_rows(index, chosen.select("*", *any_score), True, positives, block_rows)
    first = stage(first.select("anchor_id", F.col("row_id").alias("name"), F.col("score").alias("high")), "positives")

    low = F.expr(f"cast(ceil(cast(high * {least_percent} as decimal(38, 0)) / 100) as long)")
    asked = first.filter("high >= 0").withColumn("low", low)
    asked = asked.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("name", "low", "high")).alias("of"))
    lists = [F.col(f"of.{c}").alias(f"{c}s") for c in ("name", "low", "high")]
    found = best_rows(index, chosen.join(asked, "id").select("id", "label", "dim", "vector", *lists), False, negatives, block_rows)
    scored = first.select("anchor_id", "name", F.col("high").alias("positive_score"))
    return found.join(scored, ["anchor_id", "name"]).select(
        "anchor_id", F.col("name").alias("positive_id"), "rank", F.col("row_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
