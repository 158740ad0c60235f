"""Group features, series windows, lags, encodings and offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query
from panelwright.operators import encoding, groups, lags, offsets, series
from panelwright.operators.rows import with_log_target
from panelwright.operators.series import Frame
from panelwright.sources import fixture

SPEC, BOUNDS = fixture.SPEC, fixture.BOUNDS
KEYS = list(SPEC.keys)
CATS, PRICES, FLAGS = fixture.CATEGORICAL, fixture.PRICES, fixture.FLAGS
W = "OVER (PARTITION BY center_id, meal_id ORDER BY week"


def _group_sql(expression: str, out: str) -> str:
    return f"""
SELECT p.id, g.{out} FROM enriched p LEFT JOIN
  (SELECT region_code, week, {expression} AS {out} FROM enriched GROUP BY region_code, week) g USING (region_code, week)"""


def _group(spark, sf_dir, how: str, column: str, out: str) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir).select("id", "week", "region_code", column)
    return groups.add_group_stats(rows, {("region_code", "week"): {out: groups.Stat(how, column)}}).select("id", out)


@query("group_mean", "enriched", sql=_group_sql("avg(checkout_price)", "price_mean"))
def group_mean(spark, sf_dir) -> DataFrame:
    return _group(spark, sf_dir, "mean", "checkout_price", "price_mean")


@query("group_count", "enriched", sql=_group_sql("CAST(count(num_orders) AS BIGINT)", "row_count"))
def group_count(spark, sf_dir) -> DataFrame:
    return _group(spark, sf_dir, "count", "num_orders", "row_count")


@query("group_median", "enriched", sql=_group_sql("median(checkout_price)", "price_median"))
def group_median(spark, sf_dir) -> DataFrame:
    return _group(spark, sf_dir, "median", "checkout_price", "price_median")


@query("group_sum", "enriched", sql=_group_sql("CAST(coalesce(sum(num_orders), 0) AS BIGINT)", "order_sum"))
def group_sum(spark, sf_dir) -> DataFrame:
    return _group(spark, sf_dir, "sum", "num_orders", "order_sum")


@query("group_any", "enriched", sql=_group_sql("coalesce(bool_or(emailer_for_promotion <> 0), false)", "promoted"))
def group_any(spark, sf_dir) -> DataFrame:
    return _group(spark, sf_dir, "any", "emailer_for_promotion", "promoted")


def _by_category(outputs: dict[str, str], joins: dict[tuple[str, ...], dict[str, str]]) -> str:
    """SQL that joins one aggregate per key set and selects the outputs."""
    text = "SELECT p.id, " + ", ".join(f"{e} AS {o}" for o, e in outputs.items()) + " FROM enriched p"
    for i, (keys, aggregates) in enumerate(joins.items()):
        inner = ", ".join(f"{e} AS {o}" for o, e in aggregates.items())
        text += f"\nLEFT JOIN (SELECT {', '.join(keys)}, {inner} FROM enriched GROUP BY ALL) g{i} ON "
        text += " AND ".join(f"p.{k} = g{i}.{k}" for k in keys)
    return text


_COUNT = "CAST(count(id) AS BIGINT)"
COUNTS = {(c, "week"): {f"{c}_week_count": _COUNT} for c in CATS} | {("week",): {"week_count": _COUNT}}
RATES = {(c, "week"): {f"{c}_{f}_mean": f"avg({f})" for f in FLAGS} for c in CATS}
MEANS = {(c, "week"): {f"m_{c}_{p}": f"avg({p})" for p in PRICES} for c in CATS}
RATIOS = {f"{c}_week_{p}_ratio": f"p.{p} / m_{c}_{p}" for c in CATS for p in PRICES}
COUNT_NAMES = {o: o for outs in COUNTS.values() for o in outs}
RATE_NAMES = {o: o for outs in RATES.values() for o in outs}


@query("week_counts", "enriched", sql=_by_category(COUNT_NAMES, COUNTS))
def week_counts(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir)
    return groups.panel_features(rows, CATS, SPEC.time, SPEC.id).select("id", *COUNT_NAMES)


@query("price_ratios", "enriched", sql=_by_category(RATIOS, MEANS))
def price_ratios(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir)
    return groups.panel_features(rows, CATS, SPEC.time, SPEC.id, prices=PRICES, counts=False).select("id", *RATIOS)


@query("promo_rates", "enriched", sql=_by_category(RATE_NAMES, RATES))
def promo_rates(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir)
    return groups.panel_features(rows, CATS, SPEC.time, SPEC.id, flags=FLAGS, counts=False).select("id", *RATE_NAMES)


_ALL = {k: COUNTS.get(k, {}) | RATES.get(k, {}) | MEANS.get(k, {}) for k in COUNTS}


@query("panel_features", "enriched", sql=_by_category(COUNT_NAMES | RATIOS | RATE_NAMES, _ALL))
def panel_features(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir)
    wide = groups.panel_features(rows, CATS, SPEC.time, SPEC.id, PRICES, FLAGS)
    return wide.select("id", *COUNT_NAMES, *RATIOS, *RATE_NAMES)


@query("expanding_mean", "panel", sql="SELECT id, " + ", ".join(
    f"avg({c}) {W}) AS {c}_mean_ts" for c in (*PRICES, *FLAGS)) + " FROM panel")
def expanding_mean(spark, sf_dir) -> DataFrame:
    columns = {f"{c}_mean_ts": c for c in (*PRICES, *FLAGS)}
    return series.expanding_means(fixture.panel(spark, sf_dir), SPEC, columns).select("id", *columns)


@query("expanding_density", "panel", sql=f"SELECT id, CAST(count(id) {W}) AS DOUBLE) / week AS ts_mean FROM panel")
def expanding_density(spark, sf_dir) -> DataFrame:
    return series.density(fixture.panel(spark, sf_dir), SPEC, "ts_mean").select("id", "ts_mean")


STATES = {
    "num_orders_ts": (),
    "num_orders_ts_email": ("emailer_for_promotion",),
    "num_orders_ts_homepage": ("homepage_featured",),
    "num_orders_ts_email_homepage": ("emailer_for_promotion", "homepage_featured"),
}


@query("expanding_target_by_promo", "full_panel", sql="SELECT id, " + ", ".join(
    f"avg(num_orders) OVER (PARTITION BY {', '.join(('center_id', 'meal_id', *extra))} ORDER BY week) AS {out}"
    for out, extra in STATES.items()) + " FROM full_panel")
def expanding_target_by_promo(spark, sf_dir) -> DataFrame:
    rows = fixture.with_future(spark, sf_dir)
    return series.expanding_means_by_state(rows, SPEC, "num_orders", STATES).select("id", *STATES)


def _frames(spark, sf_dir, frames: dict[str, Frame]) -> DataFrame:
    return series.add_frames(fixture.panel(spark, sf_dir), SPEC, frames).select("id", *frames)


@query("row_lag", "panel", sql=f"SELECT id, CAST(lag(num_orders, 3) {W}) AS DOUBLE) AS lag3 FROM panel")
def row_lag(spark, sf_dir) -> DataFrame:
    return _frames(spark, sf_dir, {"lag3": Frame("num_orders", -3)})


@query("row_lead", "panel", sql=f"SELECT id, CAST(lead(checkout_price, 2) {W}) AS DOUBLE) AS lead2 FROM panel")
def row_lead(spark, sf_dir) -> DataFrame:
    return _frames(spark, sf_dir, {"lead2": Frame("checkout_price", 2)})


@query("rolling_mean", "panel", sql=f"SELECT id, avg(num_orders) {W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS roll4 FROM panel")
def rolling_mean(spark, sf_dir) -> DataFrame:
    return _frames(spark, sf_dir, {"roll4": Frame("num_orders", 0, 4)})


def _shifted(out: str, column: str, step: int, window: int) -> str:
    move = f"lag({column}, {-step})" if step < 0 else f"lead({column}, {step})"
    return f"""
SELECT id, avg(x) {W} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS {out}
FROM (SELECT *, {move} {W}) AS x FROM panel)"""


@query("lag_rolling", "panel", sql=_shifted("lag_roll", "num_orders", -2, 3))
def lag_rolling(spark, sf_dir) -> DataFrame:
    return _frames(spark, sf_dir, {"lag_roll": Frame("num_orders", -2, 3)})


@query("lead_rolling", "panel", sql=_shifted("lead_roll", "checkout_price", 2, 3))
def lead_rolling(spark, sf_dir) -> DataFrame:
    return _frames(spark, sf_dir, {"lead_roll": Frame("checkout_price", 2, 3)})


@query("age_lag", "panel", sql=f"""
SELECT id, week - avg(x) {W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS age
FROM (SELECT *, lag(week, 2) {W}) AS x FROM panel)""")
def age_lag(spark, sf_dir) -> DataFrame:
    framed = series.add_frames(fixture.panel(spark, sf_dir), SPEC, {"_week": Frame("week", -2, 3)})
    return framed.select("id", (F.col("week") - F.col("_week")).alias("age"))


@query("rolling_deviation", "panel", sql=f"""
SELECT id, num_orders - CASE WHEN count(num_orders) {W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) = 10
  THEN avg(num_orders) {W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS num_orders_d FROM panel""")
def rolling_deviation(spark, sf_dir) -> DataFrame:
    rows = fixture.panel(spark, sf_dir)
    return series.rolling_deviation(rows, SPEC, "num_orders", BOUNDS.tstep, "num_orders_d").select("id", "num_orders_d")


# Lag settings in the published form; the plans they lead to are written out in the SQL below.
SETTINGS = (
    lags.LagSpec(-1, -14, 4, 0.79375, ("num_orders",), ("checkout_price", "week")),
    lags.LagSpec(-2, -9, 4, 0.48928, ("num_orders",), ("base_price",)),
    lags.LagSpec(-10, -14, -9, 0.20068, ("num_orders",), ("homepage_featured",)),
)
PLANS = (
    (-1, ((-12, 7), (-7, 5), (-4, 3), (-2, 2), (-1, 1)), ((1, 1), (3, 2))),
    (-2, ((-8, 2), (-6, 2), (-4, 2), (-3, 1), (-2, 1)), ((-1, 1), (1, 1), (2, 1), (3, 1))),
    (-10, ((-13, 1), (-12, 1), (-11, 1), (-10, 1)), ((-9, 1),)),
)


def _reach_sql() -> str:
    rows = [(i, s, w, k) for i, past, ahead in PLANS for k, tiles in (("observed", past), ("known", ahead)) for s, w in tiles]
    values = ", ".join(f"({i}, {s}, {w}, '{k}')" for i, s, w, k in rows)
    return f"""
SELECT g.istep, g.step, g.window_rows, g.kind, CAST(sum(CASE
         WHEN g.step < 0 THEN greatest(n + g.step, 0)
         ELSE greatest(least(n - g.step + g.window_rows - 1, n), 0) END) AS BIGINT) AS rows_reached
FROM (VALUES {values}) g(istep, step, window_rows, kind),
     (SELECT center_id, meal_id, count(*) AS n FROM panel GROUP BY ALL) s
GROUP BY ALL"""


@query("lag_grid", "panel", sql=_reach_sql())
def lag_grid(spark, sf_dir) -> DataFrame:
    """Planned steps and windows of every setting, with the panel rows for which they yield a value."""
    entries = []
    for s in SETTINGS:
        past = lags.lag_plan(s.t_min, s.istep, s.istep, BOUNDS.tstep, s.power)
        for step, window in lags.lag_plan(s.t_min, s.t_max, s.istep, BOUNDS.tstep, s.power):
            entries.append((s.istep, step, window, "observed" if (step, window) in past else "known"))
    frames = {f"r{i}": Frame("num_orders", step, window) for i, (_, step, window, _) in enumerate(entries)}
    counts = series.add_frames(fixture.panel(spark, sf_dir), SPEC, frames).agg(*[F.count(c).alias(c) for c in frames])
    rows = [
        F.struct(F.lit(i).alias("istep"), F.lit(s).alias("step"), F.lit(w).alias("window_rows"), F.lit(k).alias("kind"),
                 F.col(f"r{n}").alias("rows_reached"))
        for n, (i, s, w, k) in enumerate(entries)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _lag_features_sql() -> str:
    moved, picked = [], []
    columns = {-1: ("num_orders", ("checkout_price", "week")), -2: ("num_orders", ("base_price",)),
               -10: ("num_orders", ("homepage_featured",))}
    seen = set()
    for istep, past, ahead in PLANS:
        target, known = columns[istep]
        for column, tiles in ((target, past), *[(k, past + ahead) for k in known]):
            for step, window in tiles:
                name = f"{column}_{abs(step)}{'n' if step < 0 else 'p'}{window}"
                if name in seen:
                    continue
                seen.add(name)
                source = "ln(num_orders + 1)" if column == "num_orders" else column
                move = f"lag({source}, {-step})" if step < 0 else f"lead({source}, {step})"
                moved.append(f"{move} {W}) AS x_{name}")
                mean = f"avg(x_{name}) {W} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
                mean = f"week - {mean}" if column == "week" else mean
                picked.append(f"round({mean}, 6) AS {name}")
    return f"SELECT id, {', '.join(picked)} FROM (SELECT *, {', '.join(moved)} FROM full_panel)"


@query("lag_features", "full_panel", sql=_lag_features_sql())
def lag_features(spark, sf_dir) -> DataFrame:
    rows = with_log_target(fixture.with_future(spark, sf_dir), SPEC.target)
    wide = lags.add_lags(rows, SPEC, SETTINGS, BOUNDS.tstep)
    names = dict.fromkeys(n for s in SETTINGS for n in lags.lag_frames(s, BOUNDS.tstep))
    return wide.select("id", *[F.round(n, 6).alias(n) for n in names])


@query("series_offsets", "panel", sql="""
SELECT center_id, meal_id, CAST(row_number() OVER o - 1 AS BIGINT) AS series_no, CAST(sum(n) OVER o - n AS BIGINT) AS start_row,
       CAST(sum(n) OVER o - n + train AS BIGINT) AS train_end_row, CAST(sum(n) OVER o - n + known AS BIGINT) AS test_end_row,
       CAST(sum(n) OVER o AS BIGINT) AS end_row
FROM (SELECT center_id, meal_id, count(*) AS n, count(*) FILTER (week <= 63) AS train, count(*) FILTER (week <= 73) AS known
      FROM panel GROUP BY ALL) WINDOW o AS (ORDER BY center_id, meal_id)""")
def series_offsets(spark, sf_dir) -> DataFrame:
    return offsets.series_offsets(fixture.panel(spark, sf_dir), SPEC, BOUNDS.train_time, BOUNDS.test_time)


@query("series_phase", "panel", sql="""
SELECT id, center_id, meal_id, week, CASE WHEN week <= 63 THEN 'train' WHEN week <= 73 THEN 'test' ELSE 'future' END AS phase FROM panel""")
def series_phase(spark, sf_dir) -> DataFrame:
    tagged = offsets.series_phase(fixture.panel(spark, sf_dir), SPEC, BOUNDS.train_time, BOUNDS.test_time)
    return tagged.select("id", *KEYS, "week", "phase")


@query("category_dictionary", "enriched", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(v AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT {c} AS v FROM enriched)""" for c in CATS))
def category_dictionary(spark, sf_dir) -> DataFrame:
    return encoding.category_dictionary(fixture.enriched(spark, sf_dir), CATS).select("column", "value", "code")


@query("encode_categories", "enriched", sql="SELECT id, " + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS BIGINT) AS {c}" for c in CATS) + " FROM enriched")
def encode_categories(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir).select("id", *CATS)
    return encoding.encode_categories(rows, CATS)


@query("category_sizes", "enriched", sql="""
SELECT center_type, category, CAST(count(*) AS BIGINT) AS rows FROM enriched GROUP BY ALL ORDER BY center_type, category""")
def category_sizes(spark, sf_dir) -> DataFrame:
    return encoding.category_sizes(fixture.enriched(spark, sf_dir), ["center_type", "category"])


@query("category_page", "panel", sql="""
SELECT center_id, rows, position, CAST((position - 4) // 4 AS BIGINT) AS page, total FROM (
  SELECT center_id, CAST(count(*) AS BIGINT) AS rows, CAST(row_number() OVER (ORDER BY center_id) - 1 AS BIGINT) AS position,
         CAST(count(*) OVER () AS BIGINT) AS total FROM panel GROUP BY center_id) WHERE position >= 4 AND position < 14""")
def category_page(spark, sf_dir) -> DataFrame:
    return encoding.category_page(fixture.panel(spark, sf_dir), ["center_id"], 4, 14, 4)
