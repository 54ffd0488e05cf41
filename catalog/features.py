"""Feature stages, checked value by value."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.registry import DIRTY_SQL, dirty, query, table
from catalog.splits import IN_TRAIN
from tabwright.operators.clean import blanks_to_null, trim_strings
from tabwright.operators.encode import feature_stages, index_categories
from tabwright.operators.split import hash_split

# Ranks of a category: most frequent first, ties in alphabetical order.
SEGMENT_SQL = f"""{DIRTY_SQL}, seg as (select cust_id, tenure, nullif(trim(segment_raw), '') as segment from dirty),
    ranks as (select segment, row_number() over (order by count(*) desc, segment) - 1 as pos
      from seg where segment is not null group by segment)"""


def _segments(spark, sf_dir):
    df = trim_strings(dirty(spark, sf_dir).select("cust_id", "tenure", "segment_raw"))
    return blanks_to_null(df.withColumnRenamed("segment_raw", "segment"), ["segment"])


def _fitted(df, *numeric, scale=False):
    stages = feature_stages(["segment"], numeric, scale)
    return Pipeline(stages=stages).fit(df).transform(df)


@query(
    "string_index",
    f"""with {SEGMENT_SQL} select cust_id,
    coalesce(pos, (select count(*) from ranks))::double as segment_index
    from seg left join ranks using (segment)""",
)
def string_index(spark, sf_dir):
    """Null segments take the index after the last category."""
    return _fitted(_segments(spark, sf_dir), "cust_id").select("cust_id", "segment_index")


@query(
    "string_index_distributed",
    """with ranks as (select p, row_number() over (order by count(*) desc, p) - 1 as pos
      from (select case when l_partkey % 7 > 0 then l_partkey::varchar end as p from lineitem) where p is not null group by p)
    select l_orderkey, l_linenumber, l_partkey, coalesce(pos, (select count(*) from ranks))::double as part_index
    from lineitem left join ranks on p = l_partkey::varchar""",
)
def string_index_distributed(spark, sf_dir):
    """Many categories: ranked in ranges and joined to the rows, none of them on the driver."""
    part = F.when(F.col("l_partkey") % 7 > 0, F.col("l_partkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", part.alias("part"))
    return index_categories(rows, ["part"], on_driver=0).drop("part")


def _slots(vector):
    """The filled slots of a vector column as (slot, value), in order."""
    placed = F.transform(vector_to_array(vector), lambda x, i: F.struct(i.alias("slot"), x.alias("value")))
    return F.filter(placed, lambda s: F.isnan(s["value"]) | (s["value"] != 0.0))


def _at(slots, place, field):
    return F.get(slots, F.lit(place))[field]


@query(
    "one_hot",
    f"""with {SEGMENT_SQL} select cust_id, coalesce(pos, -1)::int as slot,
    case when pos is null then 0 else 1 end as n_filled, (select count(*) from ranks)::int as n_slots
    from seg left join ranks using (segment)""",
)
def one_hot(spark, sf_dir):
    """The one filled slot; a null segment fills none (-1)."""
    encoded = _fitted(_segments(spark, sf_dir), "cust_id")
    filled = _slots("segment_encoded")
    return encoded.select(
        "cust_id",
        F.coalesce(_at(filled, 0, "slot"), F.lit(-1)).alias("slot"),
        F.size(filled).alias("n_filled"),
        F.size(vector_to_array("segment_encoded")).alias("n_slots"),
    )


@query(
    "assemble",
    f"""with {SEGMENT_SQL} select cust_id, coalesce(tenure, -1) as number, coalesce(pos + 1, -1)::int as slot,
    (select count(*) + 1 from ranks)::int as n_slots from seg left join ranks using (segment)""",
)
def assemble(spark, sf_dir):
    """A missing number stays in the vector as NaN; it is shown as -1 here."""
    vectors = _fitted(_segments(spark, sf_dir), "tenure")
    values = vector_to_array("unscaled_features")
    category = F.filter(_slots("unscaled_features"), lambda s: s["slot"] > 0)
    return vectors.select(
        "cust_id",
        F.nanvl(values[0], F.lit(-1.0)).alias("number"),
        F.coalesce(_at(category, 0, "slot"), F.lit(-1)).alias("slot"),
        F.size(values).alias("n_slots"),
    )


@query(
    "scale",
    """with s as (select stddev_samp(o_totalprice) as a, stddev_samp(o_custkey) as b from orders)
    select o_orderkey, round(o_totalprice / a, 6) as price, round(o_custkey / b, 6) as customer,
    0e0 as constant from orders, s""",
)
def scale(spark, sf_dir):
    """Unit deviation without centring; a constant column becomes 0."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey", F.lit(7.0).alias("seven"))
    model = Pipeline(stages=feature_stages([], ["o_totalprice", "o_custkey", "seven"])).fit(df)
    values = vector_to_array("features")
    return model.transform(df).select(
        "o_orderkey",
        F.round(values[0], 6).alias("price"),
        F.round(values[1], 6).alias("customer"),
        values[2].alias("constant"),
    )


@query(
    "feature_stages",
    f"""with train as (select * from orders where {IN_TRAIN}), test as (select * from orders where not {IN_TRAIN}),
    p as (select o_orderpriority as name, row_number() over (order by count(*) desc, o_orderpriority) as slot
      from train group by o_orderpriority),
    s as (select o_orderstatus as name, (select count(*) from p)
        + row_number() over (order by count(*) desc, o_orderstatus) as slot
      from train group by o_orderstatus),
    dev as (
      select slot, stddev_samp(case when o_orderpriority = name then 1e0 else 0e0 end) as d
        from train, p group by slot
      union all
      select slot, stddev_samp(case when o_orderstatus = name then 1e0 else 0e0 end) from train, s group by slot)
    select o_orderkey, round(o_totalprice / (select stddev_samp(o_totalprice) from train), 6) as price,
      p.slot::int as priority_slot, round(1 / dp.d, 6) as priority_value,
      s.slot::int as status_slot, round(1 / ds.d, 6) as status_value
    from test join p on o_orderpriority = p.name join dev dp on dp.slot = p.slot
      join s on o_orderstatus = s.name join dev ds on ds.slot = s.slot""",
)
def fitted_stages(spark, sf_dir):
    """All stages learnt on the training part and applied to the test part: the filled slots."""
    train, test = hash_split(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"),
        ["o_orderkey"],
    )
    model = Pipeline(stages=feature_stages(["o_orderpriority", "o_orderstatus"], ["o_totalprice"])).fit(train)
    filled = model.transform(test).select("o_orderkey", _slots("features").alias("filled"))
    return filled.select(
        "o_orderkey",
        F.round(_at("filled", 0, "value"), 6).alias("price"),
        _at("filled", 1, "slot").alias("priority_slot"),
        F.round(_at("filled", 1, "value"), 6).alias("priority_value"),
        _at("filled", 2, "slot").alias("status_slot"),
        F.round(_at("filled", 2, "value"), 6).alias("status_value"),
    )
