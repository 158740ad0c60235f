"""Rank correlations of many rows use more tasks, not larger ones."""

from __future__ import annotations

import pandas as pd
import pytest

from panelwright.operators import correlations


@pytest.mark.parametrize("ranks_sent", [64 << 20, 0])
def test_tasks_grow_with_the_cells(spark, monkeypatch, ranks_sent):
    # all rows of a file, or of one of the session's shuffle partitions, were grouped in one task.
    monkeypatch.setattr(correlations, "TASK_CELLS", 100, raising=False)
    monkeypatch.setattr(correlations, "RANK_BYTES", ranks_sent, raising=False)
    seen, summed = [], correlations._long

    def counted(df, sets, names):
        seen.append(df.rdd.getNumPartitions())
        return summed(df, sets, names)

    monkeypatch.setattr(correlations, "_long", counted)
    rows = pd.DataFrame({"a": [i % 17 for i in range(600)], "b": [float(i * i % 101) for i in range(600)], "c": range(600)}).astype("Float64")
    rows.loc[rows.index % 5 == 0, "b"] = None
    found = correlations.spearman(spark.createDataFrame(rows.astype(object).where(rows.notna(), None), "a double, b double, c double"), list("abc"))
    expected = rows.astype(float).corr("spearman")
    assert {(r["a"], r["b"]): round(r["r"], 9) for r in found.collect()} == {
        (x, y): round(expected.loc[x, y], 9) for x in "abc" for y in "abc"
    }
    assert seen == [18]
