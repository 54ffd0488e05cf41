"""Whole forests: their nodes as a table, rows routed by joins, and trees grown again in SQL.

``forest_full`` and ``forest_leaves`` fit on all features and hold what must be true of every
forest. ``forest_tree`` and ``trials_by_depth`` fit one tree on all rows and all features of
few values, whose greedy splits SQL finds again: the least weighted Gini impurity at each
node, ties to the first feature and the least value; sibling leaves of one class are merged.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.cleaning import LINES_SQL, lines
from catalog.modelling import (
    CATEGORICAL,
    KEYS,
    NOISE_SQL,
    NUMERIC,
    PARTS_SQL,
    TRAIN_ROWS,
    TRIAL_IDS,
    TRIALS,
    _areas,
    _drawn,
    _fit,
    _parts,
)
from catalog.registry import metrics_ctes, query
from catalog.search import _pick_sql
from tabwright.functions import unit_uniform
from tabwright.operators.encode import RAW_VECTOR, build_pipeline, training_weights
from tabwright.operators.models import PLACE, forest, row_place, score
from tabwright.operators.search import (
    Choice, best_trial, draw_trials, featurize, fit_model, refit, run_trials, training_set,
)
from tabwright.operators.split import staged_split
from tabwright.operators.stats import with_class_weight
from tabwright.operators.trees import forest_grid, forest_nodes, leaf_rates, route, routed_probability
from tabwright.scratch import stage

# One tree of all rows and all features, so that its splits do not hang on draws.
TREE = {"numTrees": 1, "maxBins": 64, "bootstrap": False, "featureSubsetStrategy": "all"}
# Features of the grown trees, in the order of the vector.
GROWN = ["l_quantity", "l_discount", "l_tax"]
DEPTH_SPACE = {"maxDepth": Choice((1, 2, 3)), "minInstancesPerNode": Choice((1, 400, 1600))}


@query(
    "forest_full",
    f"""with {LINES_SQL} select l_orderkey, l_linenumber, 100::bigint as n_trees, true as agrees
    from lines where not {TRAIN_ROWS}""",
)
def forest_full(spark, sf_dir):
    """The default forest on all features; its nodes, joined to the test rows, give its probabilities."""
    model, _, test = _fit(spark, sf_dir, forest(), scale=False)
    nodes = forest_nodes(spark, model)
    grid = forest_grid(nodes)
    scored = score(model, test, [*KEYS, RAW_VECTOR]).withColumnRenamed("probability", "expected").drop("prediction")
    scored = stage(grid.of(scored), "scored")
    # Rows of one cell take the same way, so it is routed once.
    cells = scored.select(*grid.columns).distinct().withColumn(RAW_VECTOR, grid.vector())
    routed = routed_probability(route(cells, nodes, grid.columns), grid.columns)
    agrees = F.abs(F.col("probability") - F.col("expected")) < 1e-9
    return scored.join(routed, grid.columns).select(*KEYS, "n_trees", agrees.alias("agrees"))


LEAF_TREES = 20


@query(
    "forest_leaves",
    f"""with {LINES_SQL} select tree, count(*) as n_rows, 0.5::double as root_impurity, true as leaves_hold_their_rows,
    true as leaves_have_their_rates, true as splits_gain from lines, (select unnest(range({LEAF_TREES}))::int as tree)
    where {TRAIN_ROWS} group by tree""",
)
def forest_leaves(spark, sf_dir):
    """Trees of depth 8 on all rows and features: each leaf holds the routed rows and their weighted rate."""
    training = training_set(_parts(spark, sf_dir).train, CATEGORICAL, NUMERIC)
    model = fit_model(forest(numTrees=LEAF_TREES, bootstrap=False), training, scale=False)
    nodes = forest_nodes(spark, model)
    vectors = model.transform(training.weighted).select("label", "classWeight", RAW_VECTOR)
    grid = forest_grid(nodes)
    cells = grid.of(vectors).groupBy("label", "classWeight", *grid.columns).agg(F.count("*").alias("n"))
    cells = cells.withColumn(RAW_VECTOR, grid.vector())
    leaves = leaf_rates(route(cells, nodes, ["label", "classWeight", "n"]), nodes, count="n")
    roots = nodes.groupBy("tree").agg(
        F.round(F.max(F.when(F.col("node") == 0, F.col("impurity"))), 6).alias("root_impurity"),
        (F.min(F.coalesce("gain", F.lit(1.0))) > 0).alias("splits_gain"),
    )
    held = leaves.groupBy("tree").agg(
        F.sum("routed_rows").alias("n_rows"),
        F.bool_and(F.col("rows") == F.col("routed_rows")).alias("leaves_hold_their_rows"),
        F.bool_and(F.abs(F.col("rate") - F.col("probability")) < 1e-9).alias("leaves_have_their_rates"),
    )
    return held.join(roots, "tree")


def tree_ctes(name: str, rows: str, depth: int, least: int = 1) -> str:
    """SQL that grows a tree on ``rows``: ``{name}_s0`` ... hold its splits, ``{name}_n`` its nodes by heap number."""
    pairs = ", ".join(f"{{'f': {i}, 'v': {c}::double}}" for i, c in enumerate(GROWN))
    parts = [f"""{name}_size as (select count(*) / (2e0 * sum(label)) as w1, count(*) / (2e0 * sum(1 - label)) as w0 from {rows}),
    {name}_r0 as (select {', '.join(GROWN)}, label, case label when 1 then w1 else w0 end as w, 1 as node
        from {rows}, {name}_size)"""]
    for d in range(depth):
        parts.append(f"""{name}_v{d} as (select node, f, v, sum(w * label) as p, sum(w * (1 - label)) as n, count(*) as c
        from (select node, label, w, unnest([{pairs}], recursive := true) from {name}_r{d}) group by all),
    {name}_c{d} as (select *, sum(p) over below as lp, sum(n) over below as ln, sum(c) over below as lc,
        sum(p) over whole as tp, sum(n) over whole as tn, sum(c) over whole as tc from {name}_v{d}
        window below as (partition by node, f order by v), whole as (partition by node, f)),
    {name}_g{d} as (select node, f, v, 2 * tp * tn / ((tp + tn) * (tp + tn))
        - 2 * (lp * ln / (lp + ln) + (tp - lp) * (tn - ln) / (tp + tn - lp - ln)) / (tp + tn) as gain from {name}_c{d}
        where lc >= {least} and tc - lc >= {least} and lc < tc),
    {name}_s{d} as (select node, f, v as cut from {name}_g{d} where gain > 1e-12
        qualify row_number() over (partition by node order by round(gain, 12) desc, f, v) = 1),
    {name}_r{d + 1} as (select r.* replace (coalesce(case when [{', '.join(GROWN)}][f + 1] <= cut then 2 * r.node
        else 2 * r.node + 1 end, r.node) as node) from {name}_r{d} r left join {name}_s{d} s on r.node = s.node)""")
    levels = " union ".join(f"select node, sum(w * label) / sum(w) as rate from {name}_r{d} group by node" for d in range(depth + 1))
    # The same node at several levels differs by rounding only.
    parts.append(f"{name}_n as (select node, any_value(rate) as rate from ({levels}) group by node)")
    return ",\n    ".join(parts)


def scored_ctes(name: str, rows: str, depth: int) -> str:
    """SQL for ``{name}_t{depth}``: ``rows`` with the rate of their leaf in the tree cut at ``depth``, leaves merged."""
    parts = [f"""{name}_k{depth} as (select n.node, rate, rate > 0.5 as class,
        n.node >= {2**depth} or not exists (select 1 from {name}_n c where c.node = 2 * n.node) as leaf
        from {name}_n n where n.node < {2 ** (depth + 1)})"""]
    last = f"{name}_k{depth}"
    for d in range(depth - 1, -1, -1):
        parts.append(f"""{name}_m{depth}_{d} as (select k.node, k.rate, k.class, k.leaf or coalesce(a.leaf and b.leaf
        and a.class = b.class and k.node >= {2**d} and k.node < {2 ** (d + 1)}, false) as leaf
        from {last} k left join {last} a on a.node = 2 * k.node left join {last} b on b.node = 2 * k.node + 1)""")
        last = f"{name}_m{depth}_{d}"
    at = "1"
    joins = ""
    for d in range(depth):
        joins += f" left join {name}_s{d} s{d} on s{d}.node = {at}"
        step = f"case when [{', '.join('r.' + c for c in GROWN)}][s{d}.f + 1] <= s{d}.cut then 2 * ({at}) else 2 * ({at}) + 1 end"
        at = f"case when s{d}.node is null then {at} else {step} end"
    walked = " union all ".join(f"select *, leaf_node >> {d} as ancestor from {name}_w{depth}" for d in range(depth + 1))
    parts.append(f"""{name}_w{depth} as (select r.*, {at} as leaf_node from {rows} r{joins}),
    {name}_t{depth} as (select w.l_orderkey, w.l_linenumber, w.label, arg_min(k.rate, k.node) as rate
        from ({walked}) w join {last} k on k.node = w.ancestor and k.leaf group by all)""")
    return ",\n    ".join(parts)


# A label whose chance hangs on quantity, discount and tax one within another, so that depth pays.
CHANCE = """case when l_quantity <= 20 then case when l_discount <= 0.03 then 0.85 else 0.25 end
    when l_tax <= 0.04 then case when l_discount <= 0.05 then 0.1 else 0.6 end else 0.7 end"""
GROWN_SQL = f"""{LINES_SQL}, planted as (select l_orderkey, l_linenumber, {", ".join(GROWN)},
    case when {NOISE_SQL} < {CHANCE} then 1 else 0 end as label from lines), {PARTS_SQL}"""


def _grown_parts(spark, sf_dir):
    noise = unit_uniform("noise", "l_orderkey", "l_linenumber", "l_partkey")
    label = F.when(noise < F.expr(CHANCE), 1.0).otherwise(0.0)
    return staged_split(lines(spark, sf_dir).select(*KEYS, *GROWN, label.alias("label")), KEYS, "grown")


@query(
    "forest_tree",
    f"""with {GROWN_SQL}, {tree_ctes('tree', 'train', 3)}, {scored_ctes('tree', 'test', 3)}
    select l_orderkey, l_linenumber, label::double as label, round(rate, 6) as probability,
    case when rate > 0.5 then 1e0 else 0e0 end as prediction from tree_t3""",
)
def forest_tree(spark, sf_dir):
    """One tree of depth 3 on three features; SQL grows it again."""
    parts = _grown_parts(spark, sf_dir)
    model = fit_model(forest(**TREE, maxDepth=3), training_set(parts.train, [], GROWN), scale=False)
    return score(model, parts.test, [*KEYS, "label"]).withColumn("probability", F.round("probability", 6))


DEPTH_SETTINGS = [(d, m) for m in DEPTH_SPACE["minInstancesPerNode"].values for d in DEPTH_SPACE["maxDepth"].values]


def _depth_sql(fitted_on: str, scored: str) -> str:
    """CTEs of the metrics per setting (``model``: its place in DEPTH_SETTINGS)."""
    deepest = max(DEPTH_SPACE["maxDepth"].values)
    ctes, scores = [], []
    for m in DEPTH_SPACE["minInstancesPerNode"].values:
        ctes.append(tree_ctes(f"t{m}", fitted_on, deepest, m))
    for i, (d, m) in enumerate(DEPTH_SETTINGS):
        ctes.append(scored_ctes(f"t{m}", scored, d))
        scores.append(f"select {i} as model, rate as score, 0 as prediction, label from t{m}_t{d}")
    listed = ", ".join(f"({i}, {d}, {m})" for i, (d, m) in enumerate(DEPTH_SETTINGS))
    drawn = _drawn(f"{_pick_sql('maxDepth', '1, 2, 3', 3)}, {_pick_sql('minInstancesPerNode', '1, 400, 1600', 3)}")
    return f"""{', '.join(ctes)}, {metrics_ctes(' union all '.join(scores), 'model')},
    settings as (select * from (values {listed}) as s(model, d, m)),
    drawn as (select trial_id, {drawn} from {TRIAL_IDS} t),
    trials as (select trial_id, "maxDepth", "minInstancesPerNode", round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc
        from drawn join settings on d = "maxDepth" and m = "minInstancesPerNode" join metrics using (model))"""


def _depth_trials(spark, parts):
    weighted = with_class_weight(parts.tuning, training_weights(parts.tuning, [], GROWN)).withColumn(PLACE, row_place(*KEYS))
    stages = build_pipeline([], GROWN, scale=False).fit(weighted)
    found = run_trials(
        forest(**TREE), draw_trials(spark, TRIALS, DEPTH_SPACE), DEPTH_SPACE,
        featurize(stages, weighted, weight="classWeight"), featurize(stages, parts.validation),
    )
    return _areas(found, "trial_id", *DEPTH_SPACE)


@query("trials_by_depth", f"with {GROWN_SQL}, {_depth_sql('tuning', 'validation')} select * from trials")
def trials_by_depth(spark, sf_dir):
    """Trees of unlike depth and leaf size; each setting has areas of its own, which SQL finds again."""
    return _depth_trials(spark, _grown_parts(spark, sf_dir))


@query(
    "refit_by_depth",
    f"""with {GROWN_SQL}, found as (with {_depth_sql('tuning', 'validation')} select * from trials),
    again as (with {_depth_sql('train', 'test').replace('trials as', 'refits as')} select * from refits)
    select again.* from again where trial_id = (select trial_id from found order by roc_auc desc, trial_id limit 1)""",
)
def refit_by_depth(spark, sf_dir):
    """The best of those trials on validation rows, fitted on all training rows and measured on the test rows."""
    parts = _grown_parts(spark, sf_dir)
    best = best_trial(_depth_trials(spark, parts)).first()
    settings = {name: best[name] for name in DEPTH_SPACE}
    _, metrics = refit(forest(**{**TREE, **settings}), training_set(parts.train, [], GROWN), parts.test, scale=False)
    chosen = {"trial_id": best["trial_id"], **settings}
    return _areas(metrics.withColumns({k: F.lit(v) for k, v in chosen.items()}), *chosen)
