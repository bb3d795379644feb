"""Forecast preparation and regression queries over entity-quarter features."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import flows, forecast
from quarterdeck.plans.shapes import bank_panel
from quarterdeck.session import materialize

FEATURES = ["LNCI", "LNRECONS", "LNRERES", "NACI", "DEP", "EQ", "LNATRES"]
TARGET = "target"


def features(spark, sf):
    """Panel balances with the next quarter's change of loans in percent as the target; text and gaps included."""
    df = bank_panel(spark, sf, ["LNLS", *FEATURES])
    nxt = F.lead("LNLS").over(flows.by_entity())
    return df.select(
        F.col("CERT").cast("string").alias("Ticker"),
        F.concat(F.lit("Q"), F.quarter("REPDTE")).alias("Fiscal_Period"),
        "REPDTE",
        *[(F.col(c) / 1000000).alias(c) for c in FEATURES],
        ((F.try_divide(nxt, F.col("LNLS")) - 1) * 100).alias(TARGET),
    )


def ready(spark, sf):
    df = forecast.zero_fill(features(spark, sf), FEATURES).filter(F.col(TARGET).isNotNull())
    return forecast.one_hot(df, "Fiscal_Period", ["Q1", "Q2", "Q3", "Q4"])


INPUTS = [*FEATURES, "Fiscal_Period_Q1", "Fiscal_Period_Q2", "Fiscal_Period_Q3", "Fiscal_Period_Q4"]


def ticker_rows(spark, sf):
    df = features(spark, sf).withColumn("LNCI", F.concat(F.lit(" "), F.col("LNCI").cast("string")))
    return forecast.prepare(df, ["LNCI", "NACI", TARGET], ticker="1").select("Ticker", "REPDTE", "LNCI", "NACI", TARGET)


def target_histogram(spark, sf):
    return forecast.histogram(features(spark, sf), TARGET)


def feature_correlations(spark, sf):
    return forecast.correlations(features(spark, sf), [*FEATURES, TARGET]).withColumn("correlation", F.round("correlation", 6))


def corr_topk(spark, sf):
    return forecast.top_correlations(features(spark, sf), FEATURES, TARGET, 3).withColumn("correlation", F.round("correlation", 6))


def one_hot_zero_fill(spark, sf):
    return ready(spark, sf)


def regression_scores(spark, sf):
    df = materialize(ready(spark, sf), "features")
    models = {
        "linear": forecast.linear_model(INPUTS, TARGET),
        "linear_scaled": forecast.linear_model(INPUTS, TARGET, scaled=True),
        "forest": forecast.forest_model(INPUTS, TARGET),
    }
    return forecast.fit_and_score(df, INPUTS, TARGET, ["Ticker", "REPDTE"], models)


def linear_scores(spark, sf):
    df = forecast.linear_scores(materialize(ready(spark, sf), "features"), INPUTS, TARGET, ["Ticker", "REPDTE"])
    return df.withColumns({c: F.round(c, 6) for c in ("rmse", "mse", "mae")})


def regression_coefficients(spark, sf):
    df = forecast.coefficients(materialize(ready(spark, sf), "features"), FEATURES, TARGET)
    return df.withColumn("coefficient", F.round("coefficient", 9))


QUERIES = {
    "ticker_rows": ticker_rows,
    "target_histogram": target_histogram,
    "feature_correlations": feature_correlations,
    "corr_topk": corr_topk,
    "one_hot_zero_fill": one_hot_zero_fill,
    "regression_scores": regression_scores,
    "linear_scores": linear_scores,
    "regression_coefficients": regression_coefficients,
}

register(
    "features",
    f"""select cast(CERT as varchar) as Ticker, 'Q' || quarter(REPDTE) as Fiscal_Period, REPDTE, {', '.join(f'{c} / 1000000 as {c}' for c in FEATURES)},
        (lead(LNLS) over (partition by CERT order by REPDTE) / nullif(LNLS, 0) - 1) * 100 as target from panel""",
    ("panel",),
)
_PAIRS = [(a, b) for i, a in enumerate([*FEATURES, TARGET]) for b in [*FEATURES, TARGET][i + 1 :]]
_CORR = " union all ".join(f"select '{c}' as feature, round(corr({c}, target), 6) as correlation from features" for c in FEATURES)


def solved(rows: str, xs: dict[str, str], y: str) -> str:
    """The normal equations of ``y`` on ``xs`` (name: expression) over ``rows``, solved by elimination: one row with a column per name."""
    names, k = list(xs), len(xs)
    cells = [f"sum(({xs[a]}) * ({xs[b]})) as a{i}_{j}" for i, a in enumerate(names) for j, b in enumerate(names)] + [f"sum(({xs[a]}) * ({y})) as a{i}_{k}" for i, a in enumerate(names)]
    text = f"select {', '.join(cells)} from {rows}"
    for p in range(k):
        cells = [f"a{p}_{j} / a{p}_{p} as a{p}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p} as a{i}_{j}" for i in range(k) for j in range(p + 1, k + 1)]
        text = f"select {', '.join(cells)} from ({text})"
    return f"select {', '.join(f'a{i}_{k} as {n}' for i, n in enumerate(names))} from ({text})"


register(
    "ready",
    f"""select Ticker, REPDTE, {', '.join(f'coalesce({c}, 0.0) as {c}' for c in FEATURES)}, target, {', '.join(f"cast(Fiscal_Period = 'Q{q}' as integer)::double as Fiscal_Period_Q{q}" for q in range(1, 5))},
        ('0x' || substr(md5(Ticker || '|' || REPDTE::varchar || '|42'), 1, 8))::bigint % 10000 < 7000 as train from features where target is not null""",
    ("features",),
)


def score_sql():
    """Both fits on the training rows, scored on the others."""
    scaled = f"""select train, target, {', '.join(f'case when hi_{c} = lo_{c} then 0.5 else ({c} - lo_{c}) / (hi_{c} - lo_{c}) end as {c}' for c in INPUTS)} from ready,
        (select {', '.join(f'min({c}) filter (train) as lo_{c}, max({c}) filter (train) as hi_{c}' for c in INPUTS)} from ready)"""
    out = []
    for name, rows in (("linear", "select * from ready"), ("linear_scaled", scaled)):
        fit = solved(f"({rows}) where train", {c: c for c in INPUTS}, "target")
        gap = "target - (" + " + ".join(f"r.{c} * f.{c}" for c in INPUTS) + ")"
        out.append(f"""select '{name}' as model, round(sqrt(avg(g * g)), 6) as rmse, round(avg(g * g), 6) as mse, round(avg(abs(g)), 6) as mae
            from (select {gap} as g from ({rows}) r, ({fit}) f where not train)""")
    return " union all ".join(out)


ORACLES = {
    "linear_scores": with_ctes(score_sql(), "ready"),
    "regression_coefficients": with_ctes(
        " union all ".join(f"select '{c}' as feature, round({c}, 9) as coefficient from ({solved('ready', {x: x for x in FEATURES}, 'target')})" for c in FEATURES), "ready"
    ),
    "ticker_rows": with_ctes("select Ticker, REPDTE, LNCI, NACI, target from features where Ticker = '1' and LNCI is not null and NACI is not null and target is not null", "features"),
    "target_histogram": with_ctes(
        "select least(cast(floor((target - lo) / ((hi - lo) / 100)) as bigint) + 1, 100) as bin, count(*) as rows from features, (select min(target) as lo, max(target) as hi from features) where target is not null group by 1", "features"
    ),
    "feature_correlations": with_ctes(" union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as correlation from features" for a, b in _PAIRS), "features"),
    "corr_topk": with_ctes(
        f"select * from (select *, 'positive' as side from ({_CORR}) where correlation > 0 order by correlation desc limit 3) union all select * from (select *, 'negative' as side from ({_CORR}) where correlation < 0 order by correlation limit 3)", "features"
    ),
    "one_hot_zero_fill": with_ctes(
        f"select Ticker, REPDTE, {', '.join(f'coalesce({c}, 0.0) as {c}' for c in FEATURES)}, target, {', '.join(f"cast(Fiscal_Period = 'Q{q}' as integer) as Fiscal_Period_Q{q}" for q in range(1, 5))} from features where target is not null", "features"
    ),
}
