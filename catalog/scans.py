"""Scans, sinks and looking at a table."""

from __future__ import annotations

from contextlib import suppress

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog.registry import DIRTY_SQL, dirty, query, table
from tabwright.operators.stats import preview, profile
from tabwright.scratch import checkpoint, persisted, scratch_path, stage
from tabwright.sources.tables import read_csv, read_parquet, write_csv, write_parquet, write_together

CUSTOMER_TYPES = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"
CUSTOMER_NAMES = [field.split()[0] for field in CUSTOMER_TYPES.split(", ")]


def _customer_csv(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, sf_dir, "customer").select(*CUSTOMER_NAMES), path)
    return path


@query("csv_scan", CUSTOMER_SQL)
def csv_scan(spark, sf_dir):
    return read_csv(spark, _customer_csv(spark, sf_dir), CUSTOMER_TYPES)


@query("csv_scan_inferred", CUSTOMER_SQL)
def csv_scan_inferred(spark, sf_dir):
    df = read_csv(spark, _customer_csv(spark, sf_dir), infer=True)
    return df.select([df[name].cast(kind) for name, kind in (f.split() for f in CUSTOMER_TYPES.split(", "))])


@query("parquet_scan", "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem")
def parquet_scan(spark, sf_dir):
    return read_parquet(
        spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    )


@query("parquet_roundtrip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def parquet_roundtrip(spark, sf_dir):
    """Written twice, so that the second write must replace the first."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    write_parquet(orders.select("o_orderkey"), path)
    write_parquet(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    return read_parquet(spark, path)


@query(
    "versioned_tables",
    """select o_orderkey, o_orderstatus, case when o_orderkey % 5 = 0 then 'test' else 'train' end as part, 2::bigint as version
    from orders""",
)
def versioned_tables(spark, sf_dir):
    """Two tables that change together, written twice; a third version dies half-way and must not show."""
    root = scratch_path(spark, "versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    split = {"test": orders.filter("o_orderkey % 5 = 0"), "train": orders.filter("o_orderkey % 5 > 0")}
    write_together({name: df.limit(10) for name, df in split.items()}, root)
    version = write_together(split, root)
    broken = split["train"].withColumn("o_orderkey", F.raise_error(F.lit("lost")).cast("long"))
    with suppress(PySparkException):
        write_together({"test": split["test"].limit(1), "train": broken}, root)
    parts = [read_parquet(spark, f"{root}/{name}").withColumn("part", F.lit(name)) for name in split]
    return parts[0].unionByName(parts[1]).withColumn("version", F.lit(version).cast("long"))


@query(
    "profile",
    f"""with {DIRTY_SQL}
    select 1 as position, 'cust_id' as column_name, 'bigint' as data_type, count(*) as n_rows,
      count(cust_id) as non_null from dirty
    union all select 2, 'total_raw', 'string', count(*), count(total_raw) from dirty
    union all select 3, 'segment_raw', 'string', count(*), count(segment_raw) from dirty
    union all select 4, 'tenure', 'double', count(*), count(tenure) from dirty
    union all select 5, 'churn', 'string', count(*), count(churn) from dirty""",
)
def profile_table(spark, sf_dir):
    return profile(dirty(spark, sf_dir))


@query("preview", "select o_orderkey, o_totalprice, o_orderpriority from orders order by o_orderkey limit 5")
def preview_table(spark, sf_dir):
    return preview(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), "o_orderkey"
    )


CHECKPOINT_SQL = "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer"


@query("checkpointed", CHECKPOINT_SQL)
def checkpointed(spark, sf_dir):
    return checkpoint(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    )


@query("staged", CHECKPOINT_SQL)
def staged(spark, sf_dir):
    return stage(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"),
        "customer",
        ("c_nationkey",),
    ).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "persisted",
    """select o_orderstatus, count(*) as n_orders, (select count(*) from orders) as n_all,
    min(o_orderkey) as first_key from orders group by o_orderstatus""",
)
def held(spark, sf_dir):
    """Rows kept for two readers and let go after both."""
    with persisted(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")) as (orders,):
        total = orders.count()
        groups = orders.groupBy("o_orderstatus").agg(
            F.count("*").alias("n_orders"), F.lit(total).cast("long").alias("n_all"), F.min("o_orderkey").alias("first_key")
        )
        return stage(groups, "held")
