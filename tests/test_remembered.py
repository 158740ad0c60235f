"""Searches and forecasts keep the vector that their fits read in the executors' memory."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import catalog.models as catalog_models
from catalog import QUERIES
from panelwright.operators.lags import LagSpec
from panelwright.operators.splits import Bounds
from panelwright.plans import models, search, validation
from panelwright.spec import PanelSpec
from panelwright.storage import materialize

SF_DIR = "/root/testdata/sf0.001"
PANEL = PanelSpec(("k",), "t", "id", "y")
SPECS = [LagSpec(-h, -h - 2, 1, 0.5, ("y",), ("x",)) for h in (1, 2)]


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.range(600).select(
        "id", (F.col("id") % 20).cast("int").alias("k"), F.floor(F.col("id") / 20).cast("int").alias("t"),
        ((F.col("id") * 7) % 11).cast("double").alias("x"),
    )
    rows = materialize(rows.withColumn("y", F.col("x") * 2 + F.col("k")), "small")
    return validation.Problem(rows, "t", "y", Bounds(0, 20, 24, 29), models.TreeParams(rounds=2, depth=2, min_rows=2), parallelism=2)


@pytest.fixture
def reads(monkeypatch):
    """Whether the rows of every fit were kept in memory."""
    seen, fit = [], models.fit_trees

    def kept(train, *args, **named):
        plan = train._jdf.queryExecution().withCachedData().toString()
        seen.append("InMemoryRelation" in plan)
        return fit(train, *args, **named)

    monkeypatch.setattr(validation, "fit_trees", kept)
    monkeypatch.setattr("panelwright.plans.forecast.fit_trees", kept)
    return seen


def test_settings_share_one_table_in_memory(spark, small, reads, monkeypatch):
    # every setting stored a table of its own, and every pass of every fit read its files.
    stored, build = [], search.with_lags
    monkeypatch.setattr(search, "with_lags", lambda *args: stored.append(build(*args)) or stored[-1])
    together = search.compare_settings(small, PANEL, SPECS, ["k"], 2)
    assert len(stored) == 1 and len(reads) == 12 and all(reads)
    assert not stored[0].rows.storageLevel.useMemory
    assert together == [search.compare_lags(small, PANEL, s, ["k"], 2) for s in SPECS]


def test_a_large_vector_is_read_from_its_files(spark, small, reads, monkeypatch):
    near = search.compare_lags(small, PANEL, SPECS[0], ["k"], 2)
    reads.clear()
    monkeypatch.setattr(validation, "MEMORY_BYTES", 0)
    assert search.compare_lags(small, PANEL, SPECS[0], ["k"], 2) == near and not any(reads)


def test_memory_is_given_back_where_a_fit_fails(spark, small):
    rows, matrix = models.stored_matrix(small.rows, ["k"], ["t", "y"])
    held = validation.replace(small, rows=rows, matrix=matrix)
    with pytest.raises(ZeroDivisionError), validation.remembered(held):
        assert rows.storageLevel.useMemory
        raise ZeroDivisionError
    assert not rows.storageLevel.useMemory


@pytest.mark.parametrize("name", ["param_search", "forecast_direct"])
def test_fits_of_a_query_read_memory(spark, reads, monkeypatch, name):
    # F3, F8: as F1, for the other queries of many fits.
    monkeypatch.setattr(catalog_models, "HORIZONS", catalog_models.HORIZONS[:1])
    monkeypatch.setattr(catalog_models, "SPECS", catalog_models.SPECS[:1])
    monkeypatch.setattr(catalog_models, "TRIALS", 1)
    QUERIES[name](spark, SF_DIR).collect()
    assert reads and all(reads)


def test_fits_run_together_as_memory_allows(spark, small, monkeypatch):
    rows, matrix = models.stored_matrix(small.rows, ["k", "x"], ["t", "y"])
    wide = validation.replace(small, rows=rows, matrix=matrix, parallelism=8)
    assert validation.fits_at_once(wide, 2) == 8
    monkeypatch.setattr(validation, "MEMORY_BYTES", 3 * 600 * (4 * 2 + validation.ROW_BYTES))
    assert validation.fits_at_once(wide, 2) == 3 and validation.fits_at_once(small, 2) == 2
    monkeypatch.setattr(validation, "MEMORY_BYTES", 1)
    assert validation.fits_at_once(wide, 2) == 2
