"""Profiles, histograms, correlations, samples and averaged series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query
from panelwright.operators import correlations, histograms, profile, samples, timeseries
from panelwright.sources import fixture

SPEC, BOUNDS = fixture.SPEC, fixture.BOUNDS
KEYS = list(SPEC.keys)
NUMBERS = ("id", "week", "center_id", "meal_id", "checkout_price", "base_price", "emailer_for_promotion",
           "homepage_featured", "num_orders")
TEXTS = ("center_type", "category", "cuisine")


def _round(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema])


@query("profile_numeric", "full_panel", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(count(x) AS BIGINT) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
       min(x) AS min, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75, max(x) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM full_panel)""" for c in NUMBERS))
def profile_numeric(spark, sf_dir) -> DataFrame:
    return _round(profile.profile_numeric(fixture.with_future(spark, sf_dir), NUMBERS), 4)


@query("profile_string", "enriched", sql=" UNION ALL ".join(f"""
SELECT "column", CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS "unique",
       arg_min(v, (-n, v)) AS top, CAST(max(n) AS BIGINT) AS freq
FROM (SELECT '{c}' AS "column", {c} AS v, count(*) AS n FROM enriched GROUP BY {c}) GROUP BY "column" """ for c in TEXTS))
def profile_string(spark, sf_dir) -> DataFrame:
    return profile.profile_string(fixture.enriched(spark, sf_dir), TEXTS)


@query("profile_quality", "enriched", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(count(*) FILTER ({'false' if c in TEXTS else c + ' = 0'}) AS BIGINT) AS zero_count,
       CAST(count(*) - count({c}) AS BIGINT) AS missing_count, CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count
FROM (SELECT * REPLACE (CASE WHEN week <= 73 THEN num_orders END AS num_orders) FROM enriched)"""
    for c in (*NUMBERS, *TEXTS, "city_code", "region_code", "op_area")))
def profile_quality(spark, sf_dir) -> DataFrame:
    return profile.profile_quality(fixture.enriched(spark, sf_dir, fixture.with_future(spark, sf_dir)))


_TYPES = {"id": "bigint", "week": "int", "center_id": "bigint", "meal_id": "int", "checkout_price": "bigint",
          "base_price": "bigint", "emailer_for_promotion": "int", "homepage_featured": "int", "num_orders": "bigint"}


@query("schema_report", "full_panel", sql=" UNION ALL ".join(f"""
SELECT CAST({i} AS BIGINT) AS position, '{c}' AS "column", CAST(count({c}) AS BIGINT) AS non_null, '{t}' AS type FROM full_panel"""
    for i, (c, t) in enumerate(_TYPES.items())))
def schema_report(spark, sf_dir) -> DataFrame:
    return profile.schema_report(fixture.with_future(spark, sf_dir))


CORRELATED = ("week", "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured", "op_area", "num_orders")
_KNOWN = "(SELECT * REPLACE (CASE WHEN week <= 73 THEN num_orders END AS num_orders) FROM enriched)"


@query("corr_pearson", "enriched", sql=" UNION ALL ".join(f"""
SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 2) AS r FROM {_KNOWN}""" for a in CORRELATED for b in CORRELATED))
def corr_pearson(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir, fixture.with_future(spark, sf_dir))
    return correlations.pearson(rows, CORRELATED).withColumn("r", F.round("r", 2))


def _spearman_pair(a: str, b: str) -> str:
    return f"""
SELECT '{a}' AS a, '{b}' AS b, round(corr(ra, rb), 6) AS r FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
  FROM known WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query("corr_spearman", "enriched", sql=f"SELECT * FROM (WITH known AS {_KNOWN}" + " UNION ALL ".join(
    _spearman_pair(a, b) for a in CORRELATED for b in CORRELATED) + ")")
def corr_spearman(spark, sf_dir) -> DataFrame:
    rows = fixture.enriched(spark, sf_dir, fixture.with_future(spark, sf_dir)).select(*CORRELATED)
    return correlations.spearman(rows, CORRELATED).withColumn("r", F.round("r", 6))


def _histogram_sql(column: str, nbins: int, source: str) -> str:
    """Bins by the rule: half-unit bins around whole values if there are few, else equal bins from minimum to maximum."""
    return f"""
SELECT '{column}' AS "column", categorical, bin, round(low + width * bin, 6) AS bin_low, round(low + width * (bin + 1), 6) AS bin_high,
       CAST(count(h.x) AS BIGINT) AS rows, round(avg(h.y), 8) AS mean_target
FROM (SELECT *, unnest(range(CAST(0 AS BIGINT), bins)) AS bin FROM plan_{column}) p
LEFT JOIN (SELECT x, y, CAST(least(floor((x - low) / width), bins - 1) AS BIGINT) AS b
           FROM (SELECT CAST({column} AS DOUBLE) AS x, num_orders AS y FROM {source}), plan_{column} WHERE x IS NOT NULL) h ON h.b = p.bin
GROUP BY ALL"""


def _plan_sql(column: str, nbins: int, source: str) -> str:
    return f"""plan_{column} AS (
  SELECT categorical, CASE WHEN categorical THEN lo - 0.25 ELSE lo END AS low,
         CASE WHEN categorical THEN 0.5 ELSE (hi - lo) / {nbins} END AS width,
         CASE WHEN categorical THEN CAST(2 * (hi - lo) + 1 AS BIGINT) ELSE {nbins} END AS bins
  FROM (SELECT count(DISTINCT x) < {nbins} AND min(x) >= 0 AND bool_and(abs(x - round(x)) <= 1e-8 + 1e-5 * abs(round(x))) AS categorical,
               min(x) AS lo, max(x) AS hi FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source})))"""


def _histograms_sql(columns, nbins: int, source: str) -> str:
    plans = ", ".join(_plan_sql(c, nbins, source) for c in columns)
    return f"SELECT * FROM (WITH {plans} " + " UNION ALL ".join(_histogram_sql(c, nbins, source) for c in columns) + ")"


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({"bin_low": F.round("bin_low", 6), "bin_high": F.round("bin_high", 6),
                           "mean_target": F.round("mean_target", 8)})


@query("histogram", "full_panel", sql=_histograms_sql(["checkout_price"], 40, "full_panel"))
def histogram(spark, sf_dir) -> DataFrame:
    return _shown(histograms.histograms(fixture.with_future(spark, sf_dir), ["checkout_price"], "num_orders", 40))


@query("histogram_categorical", "full_panel", sql=_histograms_sql(["meal_id", "homepage_featured"], 40, "full_panel"))
def histogram_categorical(spark, sf_dir) -> DataFrame:
    rows = fixture.with_future(spark, sf_dir)
    return _shown(histograms.histograms(rows, ["meal_id", "homepage_featured"], "num_orders", 40))


@query("histogram_all", "full_panel", sql=_histograms_sql(NUMBERS, 40, "full_panel"))
def histogram_all(spark, sf_dir) -> DataFrame:
    return _shown(histograms.histograms(fixture.with_future(spark, sf_dir), NUMBERS, "num_orders", 40))


_PLOTTED = ("num_orders", "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured")


@query("ts_average", "full_panel", sql="SELECT week, " + ", ".join(f"avg({c}) AS {c}" for c in _PLOTTED) + " FROM full_panel GROUP BY week")
def ts_average(spark, sf_dir) -> DataFrame:
    return timeseries.ts_average(fixture.with_future(spark, sf_dir), SPEC.time, _PLOTTED)


@query("ts_average_by", "enriched", sql="SELECT region_code, week, " + ", ".join(f"avg({c}) AS {c}" for c in _PLOTTED) + """
FROM enriched WHERE center_type = 'TYPE_B' GROUP BY region_code, week""")
def ts_average_by(spark, sf_dir) -> DataFrame:
    from panelwright.operators.rows import filter_equals

    rows = filter_equals(fixture.enriched(spark, sf_dir), {"center_type": "TYPE_B"})
    return timeseries.ts_average(rows, SPEC.time, _PLOTTED, ["region_code"])


@query("ts_average_flag", "enriched", sql="""
SELECT region_code, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT week) AS BIGINT) AS periods,
       count(DISTINCT week) < count(*) AS averaged,
       CASE WHEN count(DISTINCT week) < count(*) THEN 'Averaged ' ELSE '' END || 'region_code:' || region_code || '  ' AS label
FROM enriched GROUP BY region_code""")
def ts_average_flag(spark, sf_dir) -> DataFrame:
    return timeseries.ts_average_flag(fixture.enriched(spark, sf_dir), SPEC.time, ["region_code"])


@query("systematic_sample", "history", sql="""
SELECT id, num_orders, checkout_price FROM (
  SELECT *, row_number() OVER (ORDER BY id) - 1 AS place, count(*) OVER () // 10000 + 1 AS step FROM history) WHERE place % step = 0""")
def systematic_sample(spark, sf_dir) -> DataFrame:
    rows = fixture.history(spark, sf_dir).select("id", "num_orders", "checkout_price")
    return samples.systematic_sample(rows, SPEC.id, ["num_orders", "checkout_price"])


_XS = ("week", "center_id", "meal_id", "base_price", "emailer_for_promotion", "homepage_featured", "num_orders")


@query("scatter_extract", "full_panel", sql=" UNION ALL ".join(f"""
SELECT '{x}' AS x_column, id AS row_id, CAST({x} AS DOUBLE) AS x, CAST(checkout_price AS DOUBLE) AS y, CAST(num_orders AS DOUBLE) AS target
FROM (SELECT *, row_number() OVER (ORDER BY id) - 1 AS place, count(*) OVER () // 10000 + 1 AS step FROM full_panel WHERE {x} IS NOT NULL)
WHERE place % step = 0""" for x in _XS))
def scatter_extract(spark, sf_dir) -> DataFrame:
    return samples.scatter_extract(fixture.with_future(spark, sf_dir), SPEC.id, "checkout_price", _XS, "num_orders")


@query("sample_series", "panel", sql="""
SELECT center_id, meal_id FROM (SELECT DISTINCT center_id, meal_id FROM panel)
ORDER BY md5('1-' || center_id || '-' || meal_id), center_id, meal_id LIMIT 5""")
def sample_series(spark, sf_dir) -> DataFrame:
    return samples.sample_series(fixture.panel(spark, sf_dir), KEYS, 5, 1)
