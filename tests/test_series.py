"""Series windows against pandas, for bounded series and for series cut into pieces."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from panelwright.operators import series
from panelwright.operators.lags import LagSpec, add_lags, lag_frames
from panelwright.operators.series import Frame
from panelwright.spec import PanelSpec

PLAIN = PanelSpec(("k",), "t", "id", "y", max_rows=200)
CUT = PanelSpec(("k",), "t", "id", "y")
FRAMES = {
    "a": Frame("y", -1), "b": Frame("y", -2, 3), "c": Frame("y", 2), "d": Frame("y", 2, 3), "e": Frame("y", 0, 4),
    "f": Frame("y", -5, 6), "g": Frame("y", 4, 2), "h": Frame("y", 0, 3, full=True),
}


def panel(seed=3, lengths=(120, 1, 17, 40)) -> pd.DataFrame:
    """Gappy series with missing values; the first one holds most of the rows."""
    rng, parts = np.random.default_rng(seed), []
    for k, n in enumerate(lengths):
        t = np.sort(rng.choice(np.arange(1, 3 * n + 2), n, replace=False))
        y = rng.integers(0, 100, n).astype(float)
        y[rng.random(n) < 0.2] = np.nan
        parts.append(pd.DataFrame({"k": k, "t": t, "y": y}))
    df = pd.concat(parts, ignore_index=True)
    df["id"] = np.arange(len(df))
    return df


def frame_of(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.selectExpr("cast(k as int) k", "cast(t as int) t", "nullif(y, double('NaN')) y", "id")


def shifted(y: pd.Series, step: int, window: int) -> pd.Series:
    return y.shift(-step).rolling(window, min_periods=1).mean()


def expected(pdf: pd.DataFrame, frames) -> pd.DataFrame:
    out = pdf.copy()
    for name, f in frames.items():
        if f.full:
            out[name] = pdf.groupby("k")["y"].transform(lambda y, f=f: y.rolling(f.window).mean())
        else:
            out[name] = pdf.groupby("k")["y"].transform(lambda y, f=f: shifted(y, f.step, f.window))
    return out


def same(got, want, columns):
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    want = want.sort_values("id").reset_index(drop=True)
    assert len(got) == len(want)
    for c in columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-12, err_msg=c)


@pytest.mark.parametrize("spec, pieces", [(PLAIN, {}), (CUT, {"block_rows": 5}), (CUT, {})])
def test_frames(spark, spec, pieces):
    pdf = panel()
    same(series.add_frames(frame_of(spark, pdf), spec, FRAMES, **pieces), expected(pdf, FRAMES), FRAMES)


def test_published_shift_then_roll(spark):
    pdf = pd.DataFrame({"k": 0, "t": range(1, 7), "y": [10, 20, np.nan, 40, 50, 60], "id": range(6)})
    frames = {"a": Frame("y", -1), "b": Frame("y", -2, 3), "c": Frame("y", 2), "d": Frame("y", 2, 3)}
    want = {
        "a": [None, 10, 20, None, 40, 50], "b": [None, None, 10, 15, 15, 30],
        "c": [None, 40, 50, 60, None, None], "d": [None, 40, 45, 50, 55, 60],
    }
    for spec, pieces in ((PLAIN, {}), (CUT, {"block_rows": 2})):
        rows = series.add_frames(frame_of(spark, pdf), spec, frames, **pieces).orderBy("id").collect()
        assert {n: [r[n] for r in rows] for n in frames} == want


@pytest.mark.parametrize("spec, piece", [(PLAIN, 10_000), (CUT, 7), (CUT, 10_000)])
def test_expanding_mean_and_density(spark, spec, piece):
    pdf = panel(5)
    want = pdf.copy()
    want["m"] = pdf.groupby("k")["y"].transform(lambda y: y.expanding().mean())
    want["d"] = (pdf.groupby("k").cumcount() + 1) / pdf["t"]
    got = series.expanding_means(frame_of(spark, pdf), spec, {"m": "y"}, block_rows=piece)
    same(series.density(got, spec, "d"), want, ["m", "d"])


def test_expanding_mean_ends_at_the_series_mean(spark):
    pdf = panel(8)
    got = series.expanding_means(frame_of(spark, pdf), CUT, {"m": "y"}, block_rows=11).toPandas().sort_values("t")
    last = got.groupby("k")["m"].last()
    np.testing.assert_allclose(last, pdf.groupby("k")["y"].mean().reindex(last.index))


def test_expanding_by_state(spark):
    pdf = panel(6)
    pdf["s"] = np.random.default_rng(1).integers(0, 2, len(pdf))
    want = pdf.copy()
    want["all"] = pdf.groupby("k")["y"].transform(lambda y: y.expanding().mean())
    want["by"] = pdf.groupby(["k", "s"])["y"].transform(lambda y: y.expanding().mean())
    df = frame_of(spark, pdf).join(spark.createDataFrame(pdf[["id", "s"]]), "id")
    for spec, piece in ((PLAIN, 10_000), (CUT, 9)):
        same(series.expanding_means_by_state(df, spec, "y", {"by": ("s",), "all": ()}, piece), want, ["all", "by"])


NULL_ROWS = [
    (1, 1, 1.0, 0), (1, 2, 3.0, 1), (1, 3, None, 2), (None, 1, 5.0, 3), (None, 2, 7.0, 4), (1, None, 9.0, 5), (2, 4, 2.0, 6),
]


@pytest.mark.parametrize("spec, blocks", [(PLAIN, {}), (CUT, {"block_rows": 2}), (CUT, {})])
def test_null_keys_and_periods_give_null(spark, spec, blocks):
    df = spark.createDataFrame(NULL_ROWS, "k int, t int, y double, id int")
    wide = series.expanding_means(df, spec, {"m": "y"}, **blocks)
    wide = series.add_frames(wide, spec, {"before": Frame("y", -1), "two": Frame("y", 0, 2), "next": Frame("y", 1)}, **blocks)
    wide = series.density(series.row_numbers(wide, spec, "n"), spec, "d")
    rows = {r["id"]: (r["m"], r["before"], r["two"], r["next"], r["n"], r["d"]) for r in wide.collect()}
    nothing = (None,) * 6
    assert rows == {
        0: (1.0, None, 1.0, 3.0, 1, 1.0), 1: (2.0, 1.0, 2.0, None, 2, 1.0), 2: (2.0, 3.0, 3.0, None, 3, 1.0),
        3: nothing, 4: nothing, 5: nothing, 6: (2.0, None, 2.0, None, 1, 0.25),
    }


def test_many_rows_of_one_period_are_cut_as_well(spark):
    pdf = pd.DataFrame({"k": 0, "t": 1, "y": np.arange(50.0), "id": np.arange(50)})
    want = pdf.assign(m=pdf["y"].expanding().mean(), b=pdf["y"].shift(3))
    df = series.expanding_means(frame_of(spark, pdf), CUT, {"m": "y"}, block_rows=4)
    same(series.add_frames(df, CUT, {"b": Frame("y", -3)}, block_rows=4), want, ["m", "b"])


def test_rolling_deviation(spark):
    pdf = panel(9)
    want = pdf.copy()
    want["dev"] = pdf["y"] - pdf.groupby("k")["y"].transform(lambda y: y.rolling(3).mean())
    for spec in (PLAIN, CUT):
        same(series.rolling_deviation(frame_of(spark, pdf), spec, "y", 3, "dev"), want, ["dev"])


def test_add_lags_of_several_settings(spark):
    pdf = panel(4)
    specs = [LagSpec(-1, -6, 2, 0.5, ("y",), ("t",)), LagSpec(-3, -8, 1, 0.3, ("y",), stats=("y",))]
    want = pdf.copy()
    names = {n: f for s in specs for n, f in lag_frames(s, 10).items()}
    for n, f in names.items():
        moved = pdf.groupby("k")[f.column].transform(lambda y, f=f: shifted(y, f.step, f.window))
        want[n] = pdf["t"] - moved if f.column == "t" else moved
    same(add_lags(frame_of(spark, pdf), PLAIN, specs, 10), want, names)
    same(add_lags(frame_of(spark, pdf), CUT, specs, 10, block_rows=10), want, names)


def test_one_shuffle_serves_all_frames(spark):
    wide = series.add_frames(frame_of(spark, panel()), PLAIN, FRAMES)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
