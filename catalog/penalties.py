"""A search whose trials differ, with the optimum of every trial found again by SQL.

The only feature is a category of thirty values of unlike sizes. Its slots are disjoint, so once the
intercept is known each slot's coefficient solves an equation of its own, and the intercept
is where the residuals of all slots add up to 0. SQL solves both by halving intervals. Slots
are penalised on the scale of their weighted deviation; a strong penalty sets the
coefficients of weak slots to 0 and changes the order of the others, so the areas differ
from setting to setting.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.cleaning import LINES_SQL, lines
from catalog.modelling import (
    KEYS,
    NOISE_SQL,
    PARTS_SQL,
    TRIAL_IDS,
    TRIALS,
    _areas,
    _drawn,
)
from catalog.registry import metrics_ctes, query
from catalog.search import _pick_sql, _uniform_sql
from tabwright.functions import unit_uniform
from tabwright.operators.encode import build_pipeline, training_weights
from tabwright.operators.models import PLACE, logistic, row_place
from tabwright.operators.search import (
    Choice, LogUniform, best_trial, draw_trials, featurize, refit, run_trials, training_set,
)
from tabwright.operators.split import staged_split
from tabwright.operators.stats import with_class_weight

CATEGORY = "kind"
HALVINGS = 60
# A lasso part in every trial: a ridge alone keeps the order of the slots.
PENALTY_SPACE = {
    "maxIter": Choice((200, 300)),
    "regParam": LogUniform(0.002, 0.05),
    "elasticNetParam": Choice((0.25, 0.5, 0.75)),
}
PENALTY_SQL = _drawn(
    f"""{_pick_sql("maxIter", "200, 300", 2)},
    round(exp(ln(2e-3) + {_uniform_sql("regParam")} * (ln(5e-2) - ln(2e-3))), 9) as "regParam",
    {_pick_sql("elasticNetParam", "0.25e0, 0.5e0, 0.75e0", 3)}"""
)
# Kinds of 1, 3, 5, ... parts in 900; the chance of the label goes up and down a little with the kind.
KIND = "floor(sqrt((l_orderkey * 7 + l_partkey) % 900))"
CHANCE = f"0.4e0 + 0.2e0 * (({KIND} * 11) % 30) / 29e0"
PLANTED_SQL = f"""{LINES_SQL}, planted as (select l_orderkey, l_linenumber, {KIND}::int::varchar as kind,
    case when {NOISE_SQL} < {CHANCE} then 1 else 0 end as label from lines), {PARTS_SQL}"""


def solved_ctes(name: str, rows: str, settings: str) -> str:
    """SQL for ``{name}_scores`` (trial_id, kind, score): the optimum on ``rows`` for each row of ``settings``."""
    slope = """(size / (1 + exp(-(b + u / spread))) - ones) / spread + ridge * u"""

    def at(u: str, b: str) -> str:
        return slope.replace("b + u", f"{b} + {u}").replace("* u", f"* {u}")

    def coefficient(b: str) -> str:
        # 0 where the slope there is within the lasso's reach, else by halving towards the sign it asks for.
        start = f"({at('0e0', b)})"
        halved = f"""list_reduce(list_prepend({{'lo': case when {start} > lasso then -1e3 else 0e0 end,
            'hi': case when {start} > lasso then 0e0 else 1e3 end}}, list_transform(range({HALVINGS}), lambda i: {{'lo': 0e0, 'hi': 0e0}})),
            lambda a, x: case when {at("((a.lo + a.hi) / 2)", b)} + case when {start} > lasso then -lasso else lasso end > 0
            then {{'lo': a.lo, 'hi': (a.lo + a.hi) / 2}} else {{'lo': (a.lo + a.hi) / 2, 'hi': a.hi}} end)"""
        return f"case when abs({start}) <= lasso then 0e0 else ({halved}).lo end"

    return f"""{name}_size as (select count(*)::double as total, sum(label)::double as ones, sum(1 - label)::double as zeros from {rows}),
    {name}_slots as (select kind, sum(label) * any_value(total / (2 * s.ones)) as a, sum(1 - label) * any_value(total / (2 * zeros)) as c,
        any_value(total) as total,
        any_value(total - (s.ones * pow(total / (2 * s.ones), 2) + zeros * pow(total / (2 * zeros), 2)) / total) as freedom
        from {rows}, {name}_size s group by kind),
    {name}_terms as materialized (select trial_id, kind, a / total as ones, (a + c) / total as size,
        sqrt((a + c) / total * (1 - (a + c) / total) * total / freedom) as spread,
        "regParam" * (1 - "elasticNetParam") as ridge, "regParam" * "elasticNetParam" as lasso from {name}_slots, {settings}),
    {name}_steps as (select 0 as step, trial_id, -20e0 as low, 20e0 as high from {settings}
        union all
        select any_value(step) + 1, trial_id,
            case when sum(size / (1 + exp(-(b + u / spread))) - ones) > 0 then any_value(low) else any_value(b) end,
            case when sum(size / (1 + exp(-(b + u / spread))) - ones) > 0 then any_value(b) else any_value(high) end
        from (select *, {coefficient('b')} as u from (select *, (low + high) / 2 as b from {name}_steps join {name}_terms using (trial_id)
            where step < {HALVINGS})) group by trial_id),
    {name}_found as (select trial_id, low as b from {name}_steps where step = {HALVINGS}),
    {name}_scores as (select trial_id, kind, b + {coefficient('b')} / spread as score from {name}_terms join {name}_found using (trial_id))"""


DRAWN_SQL = f"drawn as materialized (select trial_id, {PENALTY_SQL} from {TRIAL_IDS} t)"


def _areas_sql(name: str, fitted_on: str, scored: str) -> str:
    rows = f"select trial_id, score, 0 as prediction, label from {scored} join {name}_scores using (kind)"
    return f"{solved_ctes(name, fitted_on, 'drawn')}, {metrics_ctes(rows)}"


def _rows(spark, sf_dir):
    noise = unit_uniform("noise", "l_orderkey", "l_linenumber", "l_partkey")
    label = F.when(noise < F.expr(CHANCE), 1.0).otherwise(0.0)
    kind = F.expr(KIND).cast("int").cast("string")
    return staged_split(lines(spark, sf_dir).select(*KEYS, kind.alias(CATEGORY), label.alias("label")), KEYS, "kinds")


def _trials(spark, parts):
    weighted = with_class_weight(parts.tuning, training_weights(parts.tuning, [CATEGORY], [])).withColumn(PLACE, row_place(*KEYS))
    stages = build_pipeline([CATEGORY], []).fit(weighted)
    return run_trials(
        logistic(tol=1e-12), draw_trials(spark, TRIALS, PENALTY_SPACE), PENALTY_SPACE,
        featurize(stages, weighted, weight="classWeight"), featurize(stages, parts.validation),
    )


SHOWN = 'trial_id, "maxIter", "regParam", "elasticNetParam", round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc'


@query(
    "trials_by_penalty",
    f"with recursive {PLANTED_SQL}, {DRAWN_SQL}, {_areas_sql('fit', 'tuning', 'validation')} select {SHOWN} from drawn join metrics using (trial_id)",
)
def trials_by_penalty(spark, sf_dir):
    """Six settings of the penalised regression on one category with their validation areas."""
    parts = _rows(spark, sf_dir)
    return _areas(_trials(spark, parts), "trial_id", *PENALTY_SPACE)


@query(
    "refit_by_penalty",
    f"""with recursive {PLANTED_SQL}, {DRAWN_SQL},
    tried as (with recursive {_areas_sql('fit', 'tuning', 'validation')} select {SHOWN} from drawn join metrics using (trial_id)),
    again as (with recursive {_areas_sql('fit', 'train', 'test')} select {SHOWN} from drawn join metrics using (trial_id))
    select * from again where trial_id = (select trial_id from tried order by roc_auc desc, trial_id limit 1)""",
)
def refit_by_penalty(spark, sf_dir):
    """The best setting by its validation area, refitted on all training rows, with its test areas."""
    parts = _rows(spark, sf_dir)
    best = best_trial(_areas(_trials(spark, parts), "trial_id", *PENALTY_SPACE)).first()
    settings = {name: best[name] for name in PENALTY_SPACE}
    _, metrics = refit(logistic(tol=1e-12, **settings), training_set(parts.train, [CATEGORY], []), parts.test)
    chosen = {"trial_id": best["trial_id"], **settings}
    return _areas(metrics.withColumns({k: F.lit(v) for k, v in chosen.items()}), *chosen)
