"""How the stored table of features is made."""

from __future__ import annotations

import catalog.models as catalog_models
from panelwright.operators import groups
from panelwright.plans import frames

SF_DIR = "/root/testdata/sf0.001"


def test_windows_shuffle_only_raw_columns(spark, monkeypatch):
    # the windows took the rows with all group statistics through a second shuffle.
    plans = {}

    def kept(df, label, *args, store=frames.materialize):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, label, *args)

    monkeypatch.setattr(frames, "materialize", kept)
    monkeypatch.setattr(groups, "materialize", lambda df, label, partition_by=None: kept(df, label, partition_by))
    rows = catalog_models.problem(spark, SF_DIR).rows
    assert "Window" not in plans["frame"] and "Window" in plans["group-rows"]
    ends = [f"{c}_mean_ts" for c in (*catalog_models.fixture.PRICES, *catalog_models.fixture.FLAGS)]
    assert rows.columns[-6:] == [*ends, "ts_mean", "log_num_orders"]
