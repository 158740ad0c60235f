"""Functions, filters, contracts, splits, scores, and files."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.functions import columns
from panelwright.operators import contracts, joins, rows, scoring, splits
from panelwright.sources import readers, writers
from panelwright.sources.fixture import panel
from panelwright.storage import materialize, new_path, scratch, shared_folder


def values(df):
    return [tuple(r) for r in df.collect()]


def test_valid_rows_published_cases(spark):
    one = spark.sql("SELECT * FROM VALUES (6D), (0D), (-1D), (-1D), (2D) AS v(x)")
    assert values(rows.valid_rows(one, ["x"], -1)) == [(6,), (0,), (2,)]
    two = spark.sql("SELECT * FROM VALUES (2D, 0D), (0D, 0D), (3D, 2D), (0D, 2D), (4D, 4D) AS v(x, y)")
    assert values(rows.valid_rows(two, ["x", "y"], 0)) == [(3, 2), (4, 4)]
    nan = "double('NaN')"
    three = spark.sql(f"SELECT * FROM VALUES (1D, 2D), ({nan}, {nan}), (3D, 5D), (1D, NULL), ({nan}, 4D) AS v(x, y)")
    assert values(rows.valid_rows(three, ["x", "y"])) == [(1, 2), (3, 5)]


def test_scalar_functions(spark):
    df = spark.sql("SELECT * FROM VALUES (2.5D), (3.5D), (-0.4D), (CAST(NULL AS DOUBLE)) AS v(x)")
    assert [r[0] for r in df.select(columns.half_even("x")).collect()] == [2, 4, 0, None]
    back = [r[0] for r in df.select(columns.invert_log_target("x")).collect()]
    assert back[2] == 0.0 and back[3] is None and back[0] == pytest.approx(math.expm1(2.5))
    nan = df.union(spark.sql("SELECT double('NaN')"))
    assert columns.nan_to_null(nan).where("x IS NULL").count() == 2
    assert spark.range(1).select(columns.ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_lattice(spark):
    got = spark.range(12).select(columns.lattice_value("id").alias("v"))
    assert [r.v for r in got.orderBy("v").collect()] == [13, 14, 15, 26, 27, 28, 40, 41, 42, 53, 54, 55]
    both = got.select("v", columns.lattice_index("v").alias("i"), columns.on_lattice("v").alias("on")).orderBy("v").collect()
    assert [r.i for r in both] == list(range(12)) and all(r.on for r in both)
    off = spark.sql("SELECT * FROM VALUES (12), (16), (29), (39) AS v(x)").select(columns.on_lattice("x"))
    assert not any(r[0] for r in off.collect())


def test_suffixed():
    assert columns.suffixed("a/b.csv", "_virtual") == "a/b_virtual.csv"


def test_contracts(spark):
    a, b = spark.range(5), spark.range(4).union(spark.range(1))
    assert tuple(contracts.check_same_ids(a, b, "id").first()) == (1, 1, False)
    assert contracts.check_same_ids(a, a, "id").first().same_ids
    with pytest.raises(ValueError):
        contracts.require(contracts.check_same_ids(a, b, "id"), "same_ids")
    assert not contracts.check_time_order(spark.range(5), spark.range(4, 9), "id").first().in_order
    assert contracts.check_time_order(spark.range(5), spark.range(5, 9), "id").first().in_order
    holes = spark.sql("SELECT * FROM VALUES (1D), (NULL), (double('NaN')) AS v(x)")
    assert contracts.check_missing(holes, "x").first().missing == 2
    assert contracts.check_unique_series(b, [], "id").first().repeated == 1


def test_folds(spark):
    weeks = spark.range(1, 61).withColumnRenamed("id", "t")
    for gap, ends in ((0, [10, 20, 30, 40, 50]), (3, [7, 17, 27, 37, 47])):
        folds = splits.causal_folds(weeks, "t", 5, 10, 60, gap)
        got = folds.groupBy("fold", "role").agg(F.min("t").alias("a"), F.max("t").alias("b")).collect()
        assert {r.fold: r.b for r in got if r.role == "train"} == dict(enumerate(ends))
        assert {r.fold: (r.a, r.b) for r in got if r.role == "test"} == {k: (11 + 10 * k, 20 + 10 * k) for k in range(5)}


@given(st.integers(1, 6), st.integers(1, 12), st.integers(0, 5))
def test_fold_starts_end_at_the_last_period(nfold, tstep, extra):
    last = nfold * tstep + extra
    starts = splits.fold_starts(nfold, tstep, last)
    assert [s + tstep for _, s in starts][-1] == last and starts[0][1] == extra


def test_bounds_and_holdout(spark):
    df = spark.sql("SELECT id, cast(id % 80 + 1 as int) AS t, cast(id as bigint) AS y FROM range(800)")
    parts = splits.holdout_split(df, "t", "id", "y", last=80, periods=10)
    assert parts.history.count() == 700 and parts.future.where("y IS NULL").count() == 100
    assert parts.truth.columns == ["id", "y"] and parts.truth.where("y IS NOT NULL").count() == 100
    bounds = splits.read_bounds(parts.history, parts.future, "t")
    assert (bounds.start, bounds.train_time, bounds.test_time, bounds.end, bounds.tstep) == (1, 60, 70, 80, 10)


def test_scores_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p, w = rng.integers(1, 50, 300), rng.uniform(0, 50, 300), rng.uniform(0.1, 2, 300)
    df = spark.createDataFrame([(int(a), float(b), float(c), int(i % 3)) for i, (a, b, c) in enumerate(zip(y, p, w, strict=True))],
                               "actual long, forecast double, w double, fold int")
    row = scoring.score_sheet(df.withColumn("g", F.lit(1)), ["g"]).first()
    assert row.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row.rmsle == pytest.approx(np.sqrt(np.mean(np.log((y + 1) / (p + 1)) ** 2)))
    assert row.r2 == pytest.approx(1 - np.mean((y - p) ** 2) / np.var(y))
    mean = np.average(y, weights=w)
    want = 1 - np.mean(w * (y - p) ** 2) / np.mean(w * (y - mean) ** 2)
    assert scoring.r2_weighted(df, "w").first().r2_weighted == pytest.approx(want)
    assert scoring.cv_score(df).first().score == pytest.approx(1 - np.var(p - y) / np.var(y))
    errors = [np.mean((y[k::3] - p[k::3]) ** 2) for k in range(3)]
    assert scoring.cv_score_spread(df, 3).first().score_std == pytest.approx(np.std(errors) / np.var(y) / np.sqrt(2))
    constant = df.withColumn("actual", F.lit(3))
    assert constant.agg(scoring.r2().alias("r")).first().r is None


def test_backfill_and_order(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 5), (2, NULL), (3, NULL) AS v(id, y)")
    truth = spark.sql("SELECT * FROM VALUES (2, 7), (9, 9) AS v(id, y)")
    assert sorted(values(joins.backfill_truth(df, truth, "id", "y")), key=str) == [(1, 5), (2, 7), (3, None)]
    template = spark.sql("SELECT * FROM VALUES (3, 0), (1, 1), (2, 2) AS v(id, place)")
    forecasts = spark.sql("SELECT * FROM VALUES (1, 2.5D), (2, 3.5D), (3, 0.2D) AS v(id, y)")
    ordered = writers.submission(template, forecasts, "id", "y", ["place"])
    assert values(ordered.select("id", "y")) == [(3, 0), (1, 2), (2, 4)]
    path = new_path(spark, "submission")
    writers.write_submission(template, forecasts, "id", "y", ["place"], path + ".csv")
    assert sorted(values(readers.read_table(spark, path + ".csv", "id int, y int"))) == [(1, 2), (2, 4), (3, 0)]
    with pytest.raises(ValueError):
        writers.write_submission(template, forecasts.where("id < 3"), "id", "y", ["place"], path + "-2.csv")


def test_csv_needs_a_schema_and_loses_nan(spark):
    path = new_path(spark, "csv") + ".csv"
    writers.write_csv(spark.sql("SELECT * FROM VALUES (1, 2D), (2, double('NaN')) AS v(a, b)"), path)
    assert sorted(values(readers.read_table(spark, path, "a int, b double"))) == [(1, 2.0), (2, None)]
    with pytest.raises(ValueError):
        readers.read_table(spark, path)


def test_columns_reach_the_scan(spark):
    plan = panel(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "p_name" not in plan


def test_every_month_and_a_unique_id(spark):
    rows = panel(spark, "/root/testdata/sf0.001")
    facts = rows.selectExpr("count(*) AS n", "count(DISTINCT id) AS ids", "min(week) AS first", "max(week) AS last").first()
    assert facts.n == facts.ids and (facts.first, facts.last) == (1, 83)


def test_a_gap_split_filters_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).selectExpr("id", "cast(id as int) AS t").write.parquet(path)
    roles = splits.gap_roles(spark.read.parquet(path), "t", splits.Bounds(1, 50, 60, 70), 3)
    plan = roles._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(t,47)" in plan and roles.count() == 58


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = FakeContext(master), conf


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("spark://x", **{"spark.checkpoint.dir": "/shared"})) == "/shared"


def test_scratch_tables_are_deleted(spark):
    with scratch(spark):
        kept = materialize(spark.range(5), "block")
        folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file:").removeprefix("//"))
        assert kept.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)
