"""Quality rules with cutoffs whose false rejections are bounded on labelled documents.

A rule rejects a text whose feature lies above a cutoff. All rules together walk one path of
cutoffs, fixed before any label is seen: it begins without cutoffs, and each step gives one
rule its next, stricter one. In each stratum the steps are tested in order: of ``n`` good
labelled documents ``k`` would be rejected by any rule; the step passes when
P(Binomial(n, alpha) <= k) is at most delta / strata, the exact bound. Testing stops at the
first step that does not pass, which keeps the error of the path at that of one test, and
the last one that passed is used. So, with probability 1 - delta, the rules together wrongly
reject at most a share ``alpha`` of the good documents of every stratum. A stratum with too
few labels gets no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.support import WORD_PATTERN, bounded
from tabwright.scratch import stage

# Features and cutoffs, lenient ones first. Fixed before any label is seen.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "capital_share": (0.9, 0.8, 0.7, 0.6, 0.5),
    "exclamation_share": (0.4, 0.3, 0.2, 0.15, 0.1),
    "repeated_line_share": (0.9, 0.8, 0.7, 0.6, 0.5),
    "mean_word_chars": (40.0, 30.0, 25.0, 20.0, 18.0),
}
# A table of strata is broadcast only when it was counted and is not longer than this.
BROADCAST_STRATA = 100_000
WINDOW = 5
SPACE = r"[\x20\x09-\x0D]+"


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def _repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more, from the array of window hashes."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(sorted_windows: Column) -> Column:
        same = F.filter(
            sorted_windows,
            lambda w, i: F.coalesce(w["h"] == F.get(sorted_windows, i - 1)["h"], F.lit(False))
            | F.coalesce(w["h"] == F.get(sorted_windows, i + 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda w: w["i"]))

    def covered(first: Column) -> Column:
        steps = F.transform(first, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(first, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # One-element arrays bind a value once, so that it is not worked out again per element.
    bound = F.transform(F.array(placed), lambda p: F.transform(F.array(starts(p)), covered)[0])
    return bound[0]


def features(docs: DataFrame, id_col: str, text_col: str, stratum: Column) -> DataFrame:
    """The counts, the rules' features and the stratum of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(
        F.col(id_col).alias("doc_id"), stratum.alias("stratum"), text.alias("text"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_PATTERN)).alias("lines"),
    )
    window = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - WINDOW + 1, F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WINDOW)]),
    )
    counted = words.select(
        "doc_id", "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("text", r"[^!]+", "")).cast("long").alias("n_exclamations"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        window.alias("windows"),
    )
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    counted = counted.withColumn(
        "n_repeat_words", F.when(some, _repeated_words(F.col("windows"))).otherwise(0).cast("long")
    ).drop("windows")
    return counted.withColumns(
        {
            "symbol_share": _share(F.col("n_symbols"), F.col("word_chars")),
            "capital_share": _share(F.col("n_capitals"), F.col("word_chars")),
            "exclamation_share": _share(F.col("n_exclamations"), F.col("word_chars")),
            "repeated_line_share": _share(F.col("n_dup_lines"), F.col("n_lines")),
            "repeated_word_share": _share(F.col("n_repeat_words"), F.col("n_words")),
            "mean_word_chars": _share(F.col("word_chars"), F.col("n_words")),
            "base_failed": (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20),
        }
    )


def log_factorial(x: Column) -> Column:
    """ln(x!) of a whole number: exact below 16, else Stirling's series (error under 1e-12)."""
    y = F.greatest(x, F.lit(16)).cast("double")
    series = (
        y * F.log(y) - y + 0.5 * F.log(2 * math.pi * y)
        + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    )
    return F.when(x < 16, F.log(F.factorial(F.least(x, F.lit(16)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k below the mean n * p, and 1 from there on.

    The terms shrink from k downwards; those more than 12 standard deviations of the count
    away are under the precision of a double and left out.
    """
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    far = F.least(k, (F.sqrt(n * p) * 12 + 60).cast("long"))
    odds = (1 - p) / p

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] * (k - j).cast("double") / (n - k + j + 1).cast("double") * odds
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    steps = F.when(far > 0, F.sequence(F.lit(0).cast("long"), far - 1)).otherwise(F.array().cast("array<long>"))
    total = F.aggregate(steps, start, step)["total"]
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * total)


def path_of(rules: dict[str, tuple[float, ...]]) -> list[tuple[str, float]]:
    """The steps (rule, cutoff): the first cutoff of every rule, then the second, and so on."""
    longest = max(map(len, rules.values()), default=0)
    return [(r, cutoffs[i]) for i in range(longest) for r, cutoffs in rules.items() if i < len(cutoffs)]


def first_rejecting_step(rules: dict[str, tuple[float, ...]]) -> Column:
    """The first step, from 1, at which a row is rejected; null if none does."""
    steps = [F.when(F.col(r) > c, F.lit(t)) for t, (r, c) in enumerate(path_of(rules), 1)]
    return F.coalesce(*steps, F.lit(None).cast("int"))


def risk_controlled_cutoffs(
    good: DataFrame, alpha: float, delta: float, rules: dict[str, tuple[float, ...]] = RULES
) -> DataFrame:
    """stratum, n, steps and ``cutoff_<rule>`` per rule (null: none passed), from good labelled rows.

    Rows of one document are one trial: it is rejected at the first step at which any is.
    """
    path = path_of(rules)
    documents = good.groupBy("stratum", "doc_id").agg(F.min(first_rejecting_step(rules)).alias("first"))
    rejected = F.array(*[F.count_if(F.col("first") <= t) for t in range(1, len(path) + 1)]).alias("rejected")
    counts = documents.groupBy("stratum").agg(F.count("*").alias("n"), rejected)
    strata = counts.withColumn("n_strata", F.count("*").over(Window.partitionBy()))
    failed = F.transform("rejected", lambda k: binomial_tail(F.col("n"), k, alpha) > delta / F.col("n_strata"))
    # Nested: a step counts only if all before it passed.
    first_failed = F.array_position(failed, True)
    steps = F.when(first_failed > 0, first_failed - 1).otherwise(len(path))
    # Stored: each cutoff below reads the number of steps, which is dear to work out.
    walked = stage(strata.select("stratum", "n", steps.cast("int").alias("steps")), "walked")

    def cutoff(rule: str) -> Column:
        own = [F.when(F.col("steps") >= t, F.lit(c)) for t, (r, c) in enumerate(path, 1) if r == rule]
        return F.coalesce(*reversed(own), F.lit(None).cast("double"))

    return walked.select("stratum", "n", "steps", *[cutoff(r).alias(f"cutoff_{r}") for r in rules])


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    alpha: float = 0.025,
    delta: float = 0.1,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum: Column | None = None,
    rules: dict[str, tuple[float, ...]] = RULES,
) -> DataFrame:
    """Counts, base_failed, kept, stratum and rejected_by (failed rules, comma-joined) of every row.

    ``labels`` has doc_id and quality (1: good). Good documents that pass the base rules are
    the holdout of their stratum, the language unless another column is given (null is a
    stratum). An id that is labelled twice counts as good when all its labels say so; null
    labels and labels without a document count for nothing. Null text has no words, so it
    fails the base. Repeated rows repeat, and count once in the holdout. Other columns are
    not read. Without labels no rule has a cutoff; an empty table gives no rows.
    """
    stratum = F.col("lang").cast("string") if stratum is None else stratum
    found = stage(features(docs, id_col, text_col, stratum), "features")
    judged = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good_ids = judged.filter("quality = 1").select("doc_id")
    good = found.filter(~F.col("base_failed")).join(good_ids, "doc_id", "left_semi")
    cutoffs = stage(risk_controlled_cutoffs(good, alpha, delta, rules), "cutoffs").drop("n", "steps")
    cutoffs = cutoffs.withColumnRenamed("stratum", "of")
    joined = found.join(bounded(cutoffs, BROADCAST_STRATA), F.col("stratum").eqNullSafe(F.col("of")), "left")
    failed = [F.when(F.col(r) > F.col(f"cutoff_{r}"), F.lit(r)) for r in rules]
    rejected = F.when(F.col("base_failed"), F.lit("")).otherwise(F.concat_ws(",", *failed))
    return joined.withColumn("rejected_by", rejected).select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "stratum", "rejected_by",
    )
