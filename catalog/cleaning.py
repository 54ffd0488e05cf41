"""Trim, cast, fill, label, bucket, count, ratio, drop, deduplicate; and all of it in one table."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from catalog.registry import DIRTY_SQL, dirty, query, table
from tabwright.fixed import CustomerTable
from tabwright.functions import binary_label, bucket, count_matching, safe_ratio
from tabwright.operators.clean import blanks_to_null, cast_doubles, dedup, fill_text, trim_all, trim_strings
from tabwright.operators.impute import apply_medians, exact_medians
from tabwright.operators.split import in_first_part
from tabwright.plans.clean import part_counts, prepare, run_clean
from tabwright.scratch import scratch_path, stage
from tabwright.sources.tables import write_csv

TOTAL_SQL = "try_cast(nullif(trim(total_raw), '') as double)"
BUCKET_SQL = """case when tenure <= 12 then '0-12' when tenure <= 24 then '13-24'
    when tenure <= 48 then '25-48' else '49+' end"""
BUCKET_BOUNDS, BUCKET_LABELS = [12, 24, 48], ["0-12", "13-24", "25-48", "49+"]


@query(
    "trim_all",
    f"""with {DIRTY_SQL} select trim(cust_id::varchar) as cust_id, trim(total_raw) as total_raw,
    trim(segment_raw) as segment_raw, trim(tenure::varchar) as tenure, trim(churn) as churn from dirty""",
)
def trim_every_column(spark, sf_dir):
    return trim_all(dirty(spark, sf_dir))


@query(
    "trim_strings",
    f"""with {DIRTY_SQL} select cust_id, trim(total_raw) as total_raw,
    trim(segment_raw) as segment_raw, tenure, trim(churn) as churn from dirty""",
)
def trim_text_columns(spark, sf_dir):
    return trim_strings(dirty(spark, sf_dir))


@query(
    "blank_to_null",
    f"""with {DIRTY_SQL} select cust_id, {TOTAL_SQL} as total,
    nullif(trim(segment_raw), '') as segment from dirty""",
)
def blank_cells(spark, sf_dir):
    df = trim_strings(dirty(spark, sf_dir)).select(
        "cust_id", F.col("total_raw").alias("total"), F.col("segment_raw").alias("segment")
    )
    return cast_doubles(blanks_to_null(df, ["total", "segment"]), ["total"])


@query(
    "cast_numeric",
    f"""with {DIRTY_SQL} select cust_id::double as cust_id, try_cast(total_raw as double) as total_raw,
    try_cast(churn as double) as churn, tenure from dirty""",
)
def cast_numeric(spark, sf_dir):
    """Malformed text ('Yes', blanks) must come out null, padded numbers as numbers."""
    df = dirty(spark, sf_dir).select("cust_id", "total_raw", "churn", "tenure")
    return cast_doubles(df, df.columns)


@query(
    "fill_categorical",
    f"""with {DIRTY_SQL} select cust_id, coalesce(trim(segment_raw), 'Unknown') as segment_raw,
    coalesce(churn, 'Unknown') as churn from dirty""",
)
def fill_categorical(spark, sf_dir):
    df = trim_strings(dirty(spark, sf_dir).select("cust_id", "segment_raw", "churn"))
    return fill_text(df, ["segment_raw", "churn"], "Unknown")


@query(
    "fill_categorical_blanks",
    f"""with {DIRTY_SQL} select cust_id,
    coalesce(nullif(trim(segment_raw), ''), 'Unknown') as segment_raw from dirty""",
)
def fill_categorical_blanks(spark, sf_dir):
    df = trim_strings(dirty(spark, sf_dir).select("cust_id", "segment_raw"))
    return fill_text(df, ["segment_raw"], "Unknown", blank_as_null=True)


@query(
    "fill_median",
    f"""with {DIRTY_SQL}, typed as (select cust_id, tenure, {TOTAL_SQL} as total from dirty),
    m as (select quantile_disc(tenure, 0.5) as tenure_m, quantile_disc(total, 0.5) as total_m from typed)
    select cust_id, coalesce(tenure, tenure_m) as tenure, coalesce(total, total_m) as total from typed, m""",
)
def fill_median(spark, sf_dir):
    df = dirty(spark, sf_dir).select("cust_id", "tenure", F.col("total_raw").alias("total"))
    df = cast_doubles(trim_strings(df), ["total"])
    return apply_medians(df, exact_medians(df, ["tenure", "total"]))


@query(
    "label_binary",
    f"with {DIRTY_SQL} select cust_id, case when churn = 'Yes' then 1e0 else 0e0 end as label from dirty",
)
def label_binary(spark, sf_dir):
    return dirty(spark, sf_dir).select("cust_id", binary_label("churn", "Yes").alias("label"))


@query("bucket_tenure", f"with {DIRTY_SQL} select cust_id, {BUCKET_SQL} as tenure_group from dirty")
def bucket_tenure(spark, sf_dir):
    return dirty(spark, sf_dir).select(
        "cust_id", bucket("tenure", BUCKET_BOUNDS, BUCKET_LABELS).alias("tenure_group")
    )


@query(
    "count_matching",
    """select l_orderkey, l_linenumber,
    case when l_returnflag in ('R', 'F') then 1 else 0 end
      + case when l_linestatus in ('R', 'F') then 1 else 0 end as matches from lineitem""",
)
def count_matches(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", count_matching(["l_returnflag", "l_linestatus"], ["R", "F"]).alias("matches")
    )


@query(
    "safe_ratio",
    f"""with {DIRTY_SQL} select cust_id, case when tenure > 0 then {TOTAL_SQL} / tenure
    else cust_id::double end as ratio from dirty""",
)
def ratio(spark, sf_dir):
    df = cast_doubles(trim_strings(dirty(spark, sf_dir)), ["total_raw"])
    return df.select("cust_id", safe_ratio("total_raw", "tenure", F.col("cust_id").cast("double")).alias("ratio"))


@query("drop_columns", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop("o_orderstatus", "o_orderdate")


LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINES_SQL = f"""lines as (select {', '.join(LINE_COLUMNS)} from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
    order by {', '.join(c + ' nulls first' for c in LINE_COLUMNS[2:])}) = 1)"""


def lines(spark, sf_dir):
    """Line items with one row per order and line number."""
    return dedup(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), ["l_orderkey", "l_linenumber"])


@query("dedup_keyed", f"with {LINES_SQL} select * from lines")
def dedup_keyed(spark, sf_dir):
    return lines(spark, sf_dir)


@query(
    "dedup_latest",
    """select user_id, event_id, event_type, value from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def dedup_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return dedup(events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query(
    "dedup_null_keys",
    f"""with {DIRTY_SQL} select tenure, cust_id from dirty
    qualify row_number() over (partition by tenure order by cust_id) = 1""",
)
def dedup_null_keys(spark, sf_dir):
    return dedup(dirty(spark, sf_dir).select("tenure", "cust_id"), ["tenure"], ["cust_id"])


DIRTY_TABLE = CustomerTable(
    key="cust_id",
    target="churn",
    tenure="tenure",
    monthly="tenure",
    total="total_raw",
    flags=(),
    categorical=("segment_raw",),
    services=("segment_raw", "churn"),
    columns=("cust_id", "total_raw", "segment_raw", "tenure", "churn"),
)


def clean_sql(medians_from: str = "where part = 'train'") -> str:
    """The steps of the cleaning job, with medians of the rows that are named."""
    return f"""with {DIRTY_SQL},
    typed as (select cust_id, trim(segment_raw) as segment_raw, tenure, {TOTAL_SQL} as total_raw, churn,
        case when md5(concat_ws('|', '42', cust_id::varchar)) < 'cccccccd' then 'train' else 'test' end as part
        from dirty),
    m as (select quantile_disc(tenure, 0.5) as tenure_m, quantile_disc(total_raw, 0.5) as total_m
        from typed {medians_from}),
    filled as (select cust_id, part, churn, coalesce(segment_raw, 'Unknown') as segment_raw,
        coalesce(tenure, tenure_m) as tenure, coalesce(total_raw, total_m) as total_raw from typed, m)
    select cust_id, part, segment_raw, tenure, total_raw,
        case when churn = 'Yes' then 1e0 else 0e0 end as label, {BUCKET_SQL} as tenure_group,
        case when churn = 'Yes' then 1 else 0 end as service_count,
        case when tenure > 0 then total_raw / tenure else tenure end as avg_monthly_spend
    from filled"""


CLEAN_SQL = clean_sql()


@query("clean_table", CLEAN_SQL)
def clean_table(spark, sf_dir):
    """The steps of the cleaning job: typed, unique, split, medians of the training part, features."""
    part = F.when(in_first_part(["cust_id"]), "train").otherwise("test")
    typed = cast_doubles(trim_strings(dirty(spark, sf_dir)), ["tenure", "total_raw"])
    rows = stage(dedup(typed, ["cust_id"]).withColumn("part", part), "clean", ("part",))
    medians = exact_medians(rows.filter("part = 'train'"), ["tenure", "total_raw"])
    return prepare(rows, medians, DIRTY_TABLE).drop("churn")


def _cleaned(spark, sf_dir, files, **options):
    """The cleaning job from CSV files to the two written tables."""
    raw, train, test = (scratch_path(spark, name) for name in ("raw-csv", "train", "test"))
    rows = dirty(spark, sf_dir)
    write_csv(rows.repartition(files, "cust_id") if files > 1 else rows, raw)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the view has blank segments on purpose
        run_clean(spark, f"{raw}/*.csv", train, test, DIRTY_TABLE, median_error=0.0, keep_key=True, **options)
    both = [
        spark.read.parquet(path).withColumn("part", F.lit(part)) for part, path in (("train", train), ("test", test))
    ]
    return both[0].unionByName(both[1]).withColumn("cust_id", F.col("cust_id").cast("long"))


@query("clean_job", CLEAN_SQL)
def clean_job(spark, sf_dir):
    """The cleaning job itself, from several CSV files named by a wildcard."""
    return _cleaned(spark, sf_dir, files=4)


@query("clean_job_all", clean_sql(""))
def clean_job_all(spark, sf_dir):
    """The same with medians of all rows."""
    return _cleaned(spark, sf_dir, files=1, medians_from="all")


@query(
    "part_counts",
    f"""with cleaned as ({CLEAN_SQL}) select part, label, count(*) as count,
    round(count(*) * 100 / sum(count(*)) over (partition by part), 6) as percentage from cleaned group by part, label""",
)
def rows_per_part(spark, sf_dir):
    """Rows and classes of each part, as the cleaning job returns them."""
    rows = clean_table(spark, sf_dir)
    counts = part_counts(rows.filter("part = 'train'"), rows.filter("part = 'test'"))
    return counts.withColumn("percentage", F.round("percentage", 6))
