"""Train, test and validation parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table
from tabwright.operators.split import VALIDATION_SALT, hash_split, random_split

COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice"]
IN_TRAIN = "md5(concat_ws('|', '42', o_orderkey::varchar)) < 'cccccccd'"
IN_TUNING = "md5(concat_ws('|', 'validation-42', o_orderkey::varchar)) < 'cccccccd'"
SELECT = f"select {', '.join(COLUMNS)} from orders"


def order_split(spark, sf_dir):
    return hash_split(table(spark, sf_dir, "orders").select(*COLUMNS), ["o_orderkey"])


@query("split_train", f"{SELECT} where {IN_TRAIN}")
def split_train(spark, sf_dir):
    return order_split(spark, sf_dir)[0]


@query("split_test", f"{SELECT} where not {IN_TRAIN}")
def split_test(spark, sf_dir):
    return order_split(spark, sf_dir)[1]


@query(
    "split_validation",
    f"""select o_orderkey, case when {IN_TUNING} then 'tuning' else 'validation' end as part
    from orders where {IN_TRAIN}""",
)
def split_validation(spark, sf_dir):
    train, _ = order_split(spark, sf_dir)
    tuning, validation = hash_split(train.select("o_orderkey"), ["o_orderkey"], salt=VALIDATION_SALT)
    return tuning.withColumn("part", F.lit("tuning")).unionByName(validation.withColumn("part", F.lit("validation")))


@query("split_random", "select count(*) as n_rows, count(distinct o_orderkey) as n_keys, true as near_share from orders")
def split_random(spark, sf_dir):
    """Which rows fall where has no SQL form; that no row is lost or doubled has."""
    train, test = random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    both = train.withColumn("first", F.lit(1)).unionByName(test.withColumn("first", F.lit(0)))
    return both.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.sum("first").alias("first")).agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.abs(F.sum("first") / F.sum("n") - 0.8).between(0.0, 0.05).alias("near_share"),
    )
