"""Mixing sources to target weights by weighted sampling without replacement.

Each source gets a target number of words. Whole passes over the source come first; what
is left of the target is filled by documents in the order of exponential keys, -ln(u) / w,
with ``u`` a repeatable draw and ``w`` the document's quality weight: taking the least
keys first is weighted sampling without replacement. The order within a source is never
sorted as a whole: keys fall into ranges, range totals are summed up in order, and only
the range in which the budget ends is sorted. Draws come from id and text, so only rows
equal in both share a key; where the budget ends among such rows, as many of them are taken
as fit, counted file by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import digest
from tabwright.llm.support import WORD_PATTERN, bounded
from tabwright.scratch import stage

# Most times a document may be taken, and documents per range of keys.
MOST_PASSES = 3
RANGE_ROWS = 5_000
# A table of sources is broadcast only when it was counted and is not longer than this.
BROADCAST_SOURCES = 100_000


def draw(seed: int, *keys: str) -> Column:
    """Repeatable draw in (0, 1) from 52 bits of a digest."""
    bits = F.conv(F.substring(digest(seed, *keys), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(2**52))


def quality_weight(text: Column, words: Column) -> Column:
    """Between 1/4 and 1: the share of letters and spaces in the text, by quarters of weight.

    Prose is nearly all letters and spaces; markup, tables and digits are not.
    """
    clean = F.length(F.regexp_replace(text, r"[!-@\[-`{-~]+", ""))
    share = clean.cast("double") / F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.when(words == 0, F.lit(0.25)).otherwise(F.greatest(F.lit(0.25), share * share))


def source_targets(sized: DataFrame, most: int = MOST_PASSES, cycle: int = 3) -> DataFrame:
    """source, source_size, n_docs, mean_quality and target of each source.

    Sources in order of code points, null last, weigh 1, 2, ... ``cycle``, 1, ... and share
    all words by weight. A target stops at ``most`` times its source's words; the excess
    goes to the others by weight until no target is above. With sources in order of
    stopping level (limit by weight), those that stop come first, so the common level of
    the others follows from running sums.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), F.avg("quality").alias("mean_quality")
    )
    weighed = sources.withColumn("weight", (F.row_number().over(every) - 1) % cycle + 1)
    limit = F.col("source_size") * most
    by_level = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    # The level is that of the first source that does not stop.
    # It is the greatest of them, because taking a limit off lowers the level from there on.
    free = F.when(level <= limit / F.col("weight"), level)
    ranked = weighed.withColumn("free", free).withColumn("level", F.max("free").over(whole))
    target = F.least(limit.cast("double"), F.col("level") * F.col("weight"))
    return ranked.select(
        "source", "source_size", "n_docs", "mean_quality", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def sampling_key(seed: int, doc_id: Column, text: Column, quality: Column) -> Column:
    return -F.log(draw(seed, F.coalesce(doc_id.cast("string"), F.lit("")), text)) / quality


def measured(
    docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, keep: str | None = None
) -> DataFrame:
    """doc_id, source, size, quality and key of every row, and the column ``keep``."""
    kept = [keep] if keep else []
    texts = docs.select(
        *kept,
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("size", F.regexp_count("text", F.lit(WORD_PATTERN)).cast("long"))
    weighed = texts.withColumn("quality", quality_weight(F.col("text"), F.col("size")))
    key = sampling_key(seed, F.col("doc_id"), F.col("text"), F.col("quality"))
    return weighed.select(*kept, "doc_id", "source", "size", "quality", key.alias("key"))


def mixing_plan(sized: DataFrame, most: int = MOST_PASSES, cycle: int = 3) -> DataFrame:
    """of (the source), source_size, target, passes, cut, edge and extra of each source.

    A document is taken ``passes`` times, and once more if its place (key, doc_id) is at most
    ``cut``; a null cut takes none once more. The next place, ``edge``, does not fit as a
    whole: of its rows, which are equal, ``extra`` are taken once more.
    """
    targets = stage(source_targets(sized, most, cycle), "targets").withColumnRenamed("source", "of")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("passes", passes.cast("long")).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )
    joined = sized.join(bounded(plan, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("of")))
    # Keys lie in ranges of about RANGE_ROWS rows.
    ranges = F.ceil(F.col("n_docs") / RANGE_ROWS)
    dealt = joined.select(
        "source", "size", "rest", F.struct("key", "doc_id").alias("place"),
        F.floor((1 - F.exp(-F.col("key") * F.col("mean_quality"))) * ranges).alias("range"),
    )
    totals = dealt.groupBy("source", "range").agg(
        F.sum("size").alias("words"), F.max("place").alias("top"), F.first("rest").alias("rest")
    )
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # The range in which the budget ends: one per source.
    ends = (
        totals.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .withColumn("top_before", F.max("top").over(earlier))
        .filter("before <= rest and before + words > rest")
        .select(F.col("source").alias("of"), F.col("range").alias("last"), "before", "top_before")
    )
    ends = stage(ends, "ends")
    inside = dealt.join(bounded(ends, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("last")))
    # Rows of one place are one step: a place that holds many rows is summed up before it travels.
    steps = inside.groupBy("source", "before", "top_before", "rest", "place").agg(
        F.sum("size").alias("words"), F.max("size").alias("largest")
    )
    order = Window.partitionBy("source").orderBy("place")
    steps = steps.withColumn("reached", F.col("before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    left_over = F.col("rest") - (F.col("reached") - F.col("words"))
    outside = (F.col("reached") > F.col("rest")) & (left_over >= 0)
    cuts = steps.groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("reached") <= F.col("rest"), F.col("place"))), F.first("top_before")).alias("cut"),
        F.min(F.when(outside, F.col("place"))).alias("edge"),
        F.max(F.when(outside, F.floor(left_over / F.nullif("largest", F.lit(0))))).cast("long").alias("extra"),
    )
    cuts = cuts.withColumnRenamed("source", "cut_of")
    return plan.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").select(
        "of", "source_size", "target", "passes", "cut", "edge", F.coalesce("extra", F.lit(0)).alias("extra")
    )


def _tied(rows: DataFrame) -> DataFrame:
    """``rows`` of the places at which budgets end, with one more copy for ``extra`` rows of each source.

    They are numbered within the files they are stored in, and files are counted up, so no
    task sees all rows of a place.
    """
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")]
    run = stage(rows, "tied").select("*", *at)
    files = run.groupBy(F.col("of").alias("file_of"), "file").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("file_of").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file_of", F.col("file").alias("in_file"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("passed"))
    here = F.row_number().over(Window.partitionBy("of", "file").orderBy("row_index"))
    met = run.withColumn("here", here).join(files, F.col("of").eqNullSafe(F.col("file_of")) & (F.col("file") == F.col("in_file")))
    more = (F.col("passed") + F.col("here") <= F.col("extra")).cast("long")
    return met.withColumn("copies", F.col("copies") + more).select(rows.columns)


def with_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with source_size, target and copies of each row."""
    joined = sized.join(bounded(plan, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("of")), "left")
    place = F.struct("key", "doc_id")
    more = F.coalesce(place <= F.col("cut"), F.lit(False)).cast("long")
    copies = F.when(F.col("size") > 0, F.col("passes") + more).otherwise(0)
    joined = joined.withColumn("copies", copies.cast("long"))
    if not plan.filter("extra > 0").isEmpty():
        split = (F.col("extra") > 0) & place.eqNullSafe(F.col("edge")) & (F.col("size") > 0)
        joined = joined.filter(~F.coalesce(split, F.lit(False))).unionByName(_tied(joined.filter(split)))
    return joined.drop("of", "passes", "cut", "edge", "extra")


def mix_sources(
    docs: DataFrame,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most: int = MOST_PASSES,
    cycle: int = 3,
) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row.

    size counts words; taken is size * copies, the words that the mix takes. Every document
    of a source is taken ``floor(target / source_size)`` times, and once more while the
    running size in key order stays within the rest of the target. So a source misses its
    target by less than one document, no document is taken more than ``most`` times, and
    reruns agree, on any layout. Null text has size 0 and is never taken; a null source is a
    source; draws come from the id's text (null: empty) and the text, ties go by id. Of rows
    equal in id and text as many are taken as fit. Other columns are not read; an empty
    table gives no rows.
    """
    sized = stage(measured(docs, seed, id_col, text_col, source_col), "sized")
    plan = stage(mixing_plan(sized, most, cycle), "plan")
    return with_copies(sized, plan).select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )


def mixed_documents(
    docs: DataFrame,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most: int = MOST_PASSES,
    cycle: int = 3,
) -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as often as ``mix_sources`` takes it."""
    sized = stage(measured(docs, seed, id_col, text_col, source_col), "sized")
    plan = stage(mixing_plan(sized, most, cycle), "plan")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col), F.col(text_col), F.col(source_col))
    kept = measured(rows, seed, id_col, text_col, source_col, keep="row")
    taken = with_copies(kept, plan).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
