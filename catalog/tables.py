"""Sources, contracts, filters, joins and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query
from panelwright.functions.columns import lattice_index, lattice_value, on_lattice
from panelwright.operators import contracts, encoding, joins, profile, rows, scoring, series, splits
from panelwright.operators.ordering import row_ranks
from panelwright.sources import fixture, readers, writers
from panelwright.spec import PanelSpec
from panelwright.storage import materialize, new_path

SPEC, BOUNDS = fixture.SPEC, fixture.BOUNDS
KEYS = list(SPEC.keys)


@query("scan_panel", "panel", sql="SELECT * FROM panel ORDER BY center_id, meal_id, week")
def scan_panel(spark, sf_dir) -> DataFrame:
    return fixture.panel(spark, sf_dir).orderBy(*KEYS, SPEC.time)


@query("scan_dims", "center_info", "meal_info", sql="""
SELECT 'center_id' AS key, CAST(center_id AS VARCHAR) AS key_value, center_type AS a, CAST(city_code AS VARCHAR) AS b FROM center_info
UNION ALL SELECT 'meal_id', CAST(meal_id AS VARCHAR), category, cuisine FROM meal_info""")
def scan_dims(spark, sf_dir) -> DataFrame:
    center, meal = fixture.center_info(spark, sf_dir), fixture.meal_info(spark)
    text = lambda c: F.col(c).cast("string")
    left = center.select(F.lit("center_id").alias("key"), text("center_id").alias("key_value"),
                         F.col("center_type").alias("a"), text("city_code").alias("b"))
    right = meal.select(F.lit("meal_id").alias("key"), text("meal_id").alias("key_value"),
                        F.col("category").alias("a"), F.col("cuisine").alias("b"))
    return left.unionByName(right)


@query("dimension_files", "enriched", sql="SELECT * REPLACE (CAST(city_code AS BIGINT) AS city_code, CAST(region_code AS BIGINT) AS region_code) FROM enriched")
def dimension_files(spark, sf_dir) -> DataFrame:
    """Write both dimensions as files, read them by their key map, and join them to the facts."""
    paths = {key: f"{new_path(spark, 'dimension')}.csv" for key in ("center_id", "meal_id")}
    writers.write_csv(fixture.center_info(spark, sf_dir), paths["center_id"])
    writers.write_csv(fixture.meal_info(spark), paths["meal_id"])
    dims = readers.read_dimensions(
        spark, {"center_id": (paths["center_id"], readers.CENTER_SCHEMA), "meal_id": (paths["meal_id"], readers.MEAL_SCHEMA)}
    )
    return joins.enrich(fixture.panel(spark, sf_dir), dims)


@query("submission_files", "baseline", sql="""
SELECT CAST(row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR))) AS BIGINT) AS place, id, CAST(round_even(forecast, 0) AS BIGINT) AS num_orders
FROM baseline""")
def submission_files(spark, sf_dir) -> DataFrame:
    """Read facts and a template in its own order from files, and write the submission in the template's row order."""
    root = new_path(spark, "files")
    parts = fixture.split(spark, sf_dir)
    writers.write_csv(parts.history.select(*[c.split()[0] for c in readers.FACT_SCHEMA.split(", ")]), f"{root}/history.csv")
    writers.write_csv(parts.future.select(*[c.split()[0] for c in readers.FUTURE_SCHEMA.split(", ")]), f"{root}/future.csv")
    writers.write_csv(parts.truth.orderBy(F.md5(F.col("id").cast("string"))).coalesce(1), f"{root}/template.csv")
    history = readers.read_table(spark, f"{root}/history.csv", readers.FACT_SCHEMA)
    future = readers.read_table(spark, f"{root}/future.csv", readers.FUTURE_SCHEMA)
    template = materialize(readers.read_ordered(spark, f"{root}/template.csv", readers.TEMPLATE_SCHEMA), "template")
    forecasts = scoring.mean_baseline(history, future, KEYS, SPEC.target).withColumnRenamed(scoring.FORECAST, SPEC.target)
    wanted = rows.empty_result(template, SPEC.target)
    forecasts = forecasts.select(SPEC.id, SPEC.target)
    writers.write_submission(wanted, forecasts.join(wanted.select(SPEC.id), SPEC.id), SPEC.id, SPEC.target, ["_row"], f"{root}/submission.csv")
    written = readers.read_ordered(spark, f"{root}/submission.csv", readers.TEMPLATE_SCHEMA)
    return row_ranks(written, ["_row"], "place").select("place", SPEC.id, SPEC.target)


@query("series_without_keys", "panel", sql="""
SELECT id, CASE WHEN k IS NOT NULL AND week % 7 <> 0 THEN round(avg(num_orders) OVER (PARTITION BY way, k, week % 7 = 0 ORDER BY week, id ROWS UNBOUNDED PRECEDING), 8) END AS mean_so_far,
       CASE WHEN k IS NOT NULL AND week % 7 <> 0 THEN CAST(lag(num_orders) OVER (PARTITION BY way, k, week % 7 = 0 ORDER BY week, id) AS DOUBLE) END AS before, way
FROM (SELECT *, CASE WHEN center_id % 5 <> 0 THEN center_id END AS k FROM panel) CROSS JOIN (VALUES ('bounded'), ('cut')) w(way)""")
def series_without_keys(spark, sf_dir) -> DataFrame:
    """Series windows over rows that miss keys or periods, by both ways of handling a series."""
    holes = fixture.panel(spark, sf_dir).selectExpr(
        "id", "nullif(center_id, center_id DIV 5 * 5) AS k", "CASE WHEN week % 7 <> 0 THEN week END AS t", "num_orders"
    )
    found = []
    for way, most in (("bounded", 1000), ("cut", None)):
        spec = PanelSpec(("k",), "t", "id", "num_orders", max_rows=most)
        wide = series.expanding_means(holes, spec, {"mean_so_far": "num_orders"}, block_rows=50)
        wide = series.add_frames(wide, spec, {"before": series.Frame("num_orders", -1)}, block_rows=50)
        found.append(wide.select("id", F.round("mean_so_far", 8).alias("mean_so_far"), "before", F.lit(way).alias("way")))
    return found[0].unionByName(found[1])


@query("holdout_split", "history", "future", "truth", sql="""
SELECT 'history' AS part, week, CAST(count(*) AS BIGINT) AS row_count, CAST(count(num_orders) AS BIGINT) AS targets,
       CAST(sum(num_orders) AS BIGINT) AS total FROM history GROUP BY week
UNION ALL SELECT 'future', week, count(*), count(num_orders), CAST(sum(num_orders) AS BIGINT) FROM future GROUP BY week
UNION ALL SELECT 'truth', CAST(NULL AS INT), count(*), count(num_orders), CAST(sum(num_orders) AS BIGINT) FROM truth""")
def holdout_split(spark, sf_dir) -> DataFrame:
    parts = fixture.split(spark, sf_dir)
    return _describe(parts.history, parts.future, parts.truth)


def _describe(history: DataFrame, future: DataFrame, truth: DataFrame) -> DataFrame:
    facts = [F.count(F.lit(1)).alias("row_count"), F.count("num_orders").alias("targets"), F.sum("num_orders").alias("total")]
    named = [
        history.groupBy("week").agg(*facts).withColumn("part", F.lit("history")),
        future.groupBy("week").agg(*facts).withColumn("part", F.lit("future")),
        truth.agg(*facts).withColumn("part", F.lit("truth")).withColumn("week", F.lit(None).cast("int")),
    ]
    a, b, c = (d.select("part", "week", "row_count", "targets", "total") for d in named)
    return a.unionAll(b).unionAll(c)


@query("holdout_roundtrip", "history", "future", "truth", sql="""
SELECT 'history' AS part, week, CAST(count(*) AS BIGINT) AS row_count, CAST(count(num_orders) AS BIGINT) AS targets,
       CAST(sum(num_orders) AS BIGINT) AS total FROM history GROUP BY week
UNION ALL SELECT 'future', week, count(*), count(num_orders), CAST(sum(num_orders) AS BIGINT) FROM future GROUP BY week
UNION ALL SELECT 'truth', CAST(NULL AS INT), count(*), count(num_orders), CAST(sum(num_orders) AS BIGINT) FROM truth""")
def holdout_roundtrip(spark, sf_dir) -> DataFrame:
    stem = new_path(spark, "holdout")
    parts = fixture.split(spark, sf_dir)
    tables = {"train": parts.history, "test": parts.future, "sample": parts.truth}
    paths = writers.write_holdout(parts, *[f"{stem}/{n}.csv" for n in tables])
    history, future, truth = (
        readers.read_table(spark, path, table.schema) for path, table in zip(paths.values(), tables.values(), strict=True)
    )
    return _describe(history, future, truth)


@query("check_ids", "future", "truth", sql="""
SELECT CAST(count(*) FILTER (d > 0) AS BIGINT) AS only_left, CAST(count(*) FILTER (d < 0) AS BIGINT) AS only_right,
       coalesce(bool_and(d = 0), true) AS same_ids
FROM (SELECT id, sum(s) AS d FROM (SELECT id, 1 AS s FROM future UNION ALL SELECT id, -1 FROM truth) GROUP BY id)""")
def check_ids(spark, sf_dir) -> DataFrame:
    parts = fixture.split(spark, sf_dir)
    return contracts.check_same_ids(parts.future, parts.truth, SPEC.id)


@query("check_time_order", "history", "future", sql="""
SELECT CAST((SELECT max(week) FROM history) AS BIGINT) AS last_known, CAST((SELECT min(week) FROM future) AS BIGINT) AS first_future,
       (SELECT min(week) FROM future) > (SELECT max(week) FROM history) AS in_order""")
def check_time_order(spark, sf_dir) -> DataFrame:
    parts = fixture.split(spark, sf_dir)
    return contracts.check_time_order(parts.history, parts.future, SPEC.time)


@query("check_missing", "baseline", sql="""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count(forecast) AS BIGINT) AS missing, count(*) = count(forecast) AS complete
FROM baseline""")
def check_missing(spark, sf_dir) -> DataFrame:
    return contracts.check_missing(baseline(spark, sf_dir), scoring.FORECAST)


@query("check_unique_series", "panel", sql="""
SELECT CAST(count(*) AS BIGINT) AS pairs, CAST(count(*) FILTER (n > 1) AS BIGINT) AS repeated, count(*) FILTER (n > 1) = 0 AS "unique"
FROM (SELECT center_id, meal_id, week, count(*) AS n FROM panel GROUP BY ALL)""")
def check_unique_series(spark, sf_dir) -> DataFrame:
    return contracts.check_unique_series(fixture.panel(spark, sf_dir), KEYS, SPEC.time)


@query("prune_columns", "enriched", sql="SELECT id, week, num_orders, checkout_price, category, center_type FROM enriched")
def prune_columns(spark, sf_dir) -> DataFrame:
    return rows.prune_columns(fixture.enriched(spark, sf_dir), ["id", "week", "num_orders"],
                              ["checkout_price", "category", "center_type"])


@query("time_slice", "panel", sql="SELECT * FROM panel WHERE week > 63 AND week <= 73")
def time_slice(spark, sf_dir) -> DataFrame:
    return rows.time_slice(fixture.panel(spark, sf_dir), SPEC.time, BOUNDS.train_time, BOUNDS.test_time)


@query("filter_equals", "enriched", sql="""
SELECT id, week, center_id, meal_id, num_orders FROM enriched WHERE center_type = 'TYPE_B' AND category = 'Size' AND homepage_featured = 1""")
def filter_equals(spark, sf_dir) -> DataFrame:
    wanted = {"center_type": "TYPE_B", "category": "Size", "homepage_featured": 1}
    return rows.filter_equals(fixture.enriched(spark, sf_dir), wanted).select("id", "week", *KEYS, "num_orders")


@query("valid_rows", "panel", sql="SELECT id, emailer_for_promotion FROM panel WHERE emailer_for_promotion <> 0")
def valid_rows(spark, sf_dir) -> DataFrame:
    return rows.valid_rows(fixture.panel(spark, sf_dir), ["emailer_for_promotion"], 0).select("id", "emailer_for_promotion")


@query("valid_rows_2d", "full_panel", sql="""
SELECT id, week, num_orders FROM full_panel WHERE num_orders IS NOT NULL AND checkout_price IS NOT NULL""")
def valid_rows_2d(spark, sf_dir) -> DataFrame:
    valid = rows.valid_rows(fixture.with_future(spark, sf_dir), ["num_orders", "checkout_price"])
    return valid.select("id", "week", "num_orders")


@query("log_target", "full_panel", sql="SELECT id, round(ln(num_orders + 1), 8) AS num_orders FROM full_panel")
def log_target(spark, sf_dir) -> DataFrame:
    logged = rows.with_log_target(fixture.with_future(spark, sf_dir), SPEC.target)
    return logged.select("id", F.round(SPEC.target, 8).alias(SPEC.target))


@query("log_profile", "panel", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(count(x) AS BIGINT) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
       round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS max
FROM (SELECT ln(CAST({c} AS DOUBLE)) AS x FROM panel)""" for c in ("checkout_price", "base_price", "num_orders")))
def log_profile(spark, sf_dir) -> DataFrame:
    columns = ["checkout_price", "base_price", "num_orders"]
    logged = rows.log_columns(fixture.panel(spark, sf_dir).select(*columns), columns)
    return _rounded(profile.profile_numeric(logged, columns), 6)


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema])


@query("head_rows", "panel", sql="SELECT * FROM panel ORDER BY id LIMIT 10")
def head_rows(spark, sf_dir) -> DataFrame:
    return rows.head_rows(fixture.panel(spark, sf_dir), [SPEC.id], 10)


@query("enrich", "enriched", sql="SELECT * FROM enriched")
def enrich(spark, sf_dir) -> DataFrame:
    return fixture.enriched(spark, sf_dir)


@query("union_future", "history", "future", sql="SELECT * FROM history UNION ALL SELECT * FROM future")
def union_future(spark, sf_dir) -> DataFrame:
    parts = fixture.split(spark, sf_dir)
    return rows.union_future(parts.history, parts.future.drop(SPEC.target))


@query("scored_rows", "baseline", "panel", sql="SELECT * FROM panel WHERE id IN (SELECT id FROM baseline WHERE forecast IS NOT NULL)")
def scored_rows(spark, sf_dir) -> DataFrame:
    forecasts = baseline(spark, sf_dir).where(F.col(scoring.FORECAST).isNotNull())
    return joins.scored_rows(fixture.panel(spark, sf_dir), forecasts, SPEC.id)


@query("backfill_truth", "panel", sql="SELECT * FROM panel")
def backfill_truth(spark, sf_dir) -> DataFrame:
    truth = fixture.split(spark, sf_dir).truth
    return joins.backfill_truth(fixture.with_future(spark, sf_dir), truth, SPEC.id, SPEC.target)


def baseline(spark, sf_dir) -> DataFrame:
    stage = {"final": (BOUNDS.test_time, BOUNDS.end)}
    found = scoring.origin_baseline(fixture.with_future(spark, sf_dir), SPEC, stage)
    return found.select("id", "week", *KEYS, scoring.FORECAST)


@query("submission", "baseline", sql="""
SELECT id, CAST(round_even(forecast, 0) AS BIGINT) AS num_orders FROM baseline ORDER BY id""")
def submission(spark, sf_dir) -> DataFrame:
    # Stored, as the ids of the template and the forecasts come from the same pass.
    stored = materialize(baseline(spark, sf_dir), "baseline")
    forecasts = stored.withColumnRenamed(scoring.FORECAST, SPEC.target)
    return writers.submission(stored.select(SPEC.id), forecasts, SPEC.id, SPEC.target, [SPEC.id])


@query("time_bounds", "panel", sql="""
SELECT CAST(min(week) AS INT) AS start_time, 63 AS train_time, CAST(max(CASE WHEN week <= 73 THEN week END) AS INT) AS test_time,
       CAST(max(week) AS INT) AS end_time, CAST(max(week) - 73 AS INT) AS tstep,
       CAST(count(DISTINCT (center_id, meal_id)) AS BIGINT) AS series FROM panel""")
def time_bounds(spark, sf_dir) -> DataFrame:
    parts = fixture.split(spark, sf_dir)
    return splits.time_bounds(parts.history, parts.future, SPEC.time, KEYS)


@query("gap_split", "panel", sql="""
SELECT id, week, CASE WHEN week <= 60 THEN 'train' ELSE 'test' END AS role FROM panel WHERE week <= 60 OR (week > 63 AND week <= 73)""")
def gap_split(spark, sf_dir) -> DataFrame:
    return splits.gap_roles(fixture.panel(spark, sf_dir), SPEC.time, BOUNDS, gap=3).select("id", "week", "role")


@query("cv_folds", "foldrows", sql="SELECT id, week, fold, role FROM foldrows")
def cv_folds(spark, sf_dir) -> DataFrame:
    folds = splits.causal_folds(fixture.history(spark, sf_dir), SPEC.time, 5, BOUNDS.tstep, BOUNDS.test_time)
    return folds.select("id", "week", "fold", "role")


@query("distinct_values", "panel", sql="SELECT DISTINCT num_orders FROM panel")
def distinct_values(spark, sf_dir) -> DataFrame:
    return encoding.distinct_values(fixture.panel(spark, sf_dir), SPEC.target)


@query("scalar_math", "panel", sql="""
SELECT id, round(ln(num_orders), 8) AS log_value, round(exp(ln(num_orders + 1)) - 1, 8) AS back, round(sqrt(num_orders), 8) AS root,
       CAST(num_orders AS DOUBLE) * num_orders AS square, abs(base_price - checkout_price - 100000) AS gap,
       greatest(num_orders - 50, 0) AS clamped, CAST(round_even(num_orders / 2.0, 0) AS BIGINT) AS half,
       CAST(ceil(num_orders / 5.0) AS BIGINT) AS pages FROM panel""")
def scalar_math(spark, sf_dir) -> DataFrame:
    from panelwright.functions.columns import half_even, invert_log_target
    from panelwright.functions.columns import log_target as logged

    y = F.col("num_orders")
    return fixture.panel(spark, sf_dir).select(
        "id",
        F.round(F.ln(y), 8).alias("log_value"),
        F.round(invert_log_target(logged(y)), 8).alias("back"),
        F.round(F.sqrt(y), 8).alias("root"),
        F.pow(y, F.lit(2.0)).alias("square"),
        F.abs(F.col("base_price") - F.col("checkout_price") - 100000).alias("gap"),
        F.greatest(y - 50, F.lit(0)).cast("bigint").alias("clamped"),
        half_even(y / 2).alias("half"),
        F.ceil(y / 5).alias("pages"),
    )


@query("value_lattice", "panel", sql="""
SELECT num_orders, CAST(row_number() OVER (ORDER BY num_orders) - 1 AS BIGINT) AS position,
       num_orders >= 13 AND (num_orders - 13) % 27 IN (0, 1, 2, 13, 14, 15) AS on_lattice,
       CASE WHEN num_orders >= 13 AND (num_orders - 13) % 27 IN (0, 1, 2, 13, 14, 15) THEN CAST((num_orders - 13) // 27 * 6
         + CASE (num_orders - 13) % 27 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 13 THEN 3 WHEN 14 THEN 4 ELSE 5 END AS BIGINT) END AS lattice_index,
       CAST(13 + (row_number() OVER (ORDER BY num_orders) - 1) % 3 + (row_number() OVER (ORDER BY num_orders) - 1) // 6 * 27
         + (row_number() OVER (ORDER BY num_orders) - 1) // 3 % 2 * 13 AS BIGINT) AS expected
FROM (SELECT DISTINCT num_orders FROM panel)""")
def value_lattice(spark, sf_dir) -> DataFrame:
    values = row_ranks(encoding.distinct_values(fixture.panel(spark, sf_dir), SPEC.target), [SPEC.target], "_rank")
    position = F.col("_rank") - 1
    return values.select(
        SPEC.target,
        position.alias("position"),
        on_lattice(SPEC.target).alias("on_lattice"),
        F.when(on_lattice(SPEC.target), lattice_index(SPEC.target)).alias("lattice_index"),
        lattice_value(position).alias("expected"),
    )


@query("series_label", "panel", sql="""
SELECT center_id, meal_id, CASE WHEN count(DISTINCT week) < count(*) THEN 'Averaged ' ELSE '' END || 'center_id:' || center_id
       || '  meal_id:' || meal_id || '  ' AS label FROM panel GROUP BY center_id, meal_id""")
def series_labels(spark, sf_dir) -> DataFrame:
    from panelwright.operators.timeseries import ts_average_flag

    return ts_average_flag(fixture.panel(spark, sf_dir), SPEC.time, KEYS).select(*KEYS, "label")
