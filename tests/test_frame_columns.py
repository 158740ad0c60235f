"""Queries that read few features store only these."""

from __future__ import annotations

import catalog.models as catalog_models
import pytest
from catalog import QUERIES
from panelwright.plans import frames, validation
from panelwright.storage import materialize
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
START = catalog_models.START


@pytest.mark.parametrize(("query", "features"), [("gbt_fit", [*START, "ts_mean", "week_count"]), ("model_roundtrip", START)])
def test_query_stores_the_columns_it_reads(spark, monkeypatch, query, features):
    # all 54 features of every row were written to a table of which few were read.
    stored = {}

    def kept(df, label, *args):
        stored[label] = materialize(df, label, *args)
        return stored[label]

    monkeypatch.setattr(frames, "materialize", kept)
    QUERIES[query](spark, SF_DIR).collect()
    spec = catalog_models.SPEC
    assert set(stored["frame"].columns) == {spec.id, *spec.keys, spec.time, spec.target, f"log_{spec.target}", *features}


def test_narrow_frame_has_the_rows_and_the_fit_of_the_whole_one(spark):
    features = [*START, "ts_mean", "week_count", "center_id_week_base_price_ratio"]
    whole = catalog_models.problem(spark, SF_DIR)
    narrow = catalog_models.problem(spark, SF_DIR, keep=features)
    same = whole.rows.select(*narrow.rows.columns)
    assert same.exceptAll(narrow.rows).isEmpty() and narrow.rows.exceptAll(same).isEmpty()
    # Few rows, so that Spark reads all of them for its splits.
    assert narrow.rows.where(F.col(narrow.target).isNotNull()).count() <= 10_000
    fits = [validation.validate(p, features) for p in (whole, narrow)]
    assert fits[0].scores == pytest.approx(fits[1].scores, abs=1e-9) and fits[0].rounds == fits[1].rounds
