"""Ordering, quantiles, groups, profiles, histograms, correlations and samples against pandas and numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright.operators import correlations, encoding, groups, histograms, offsets, profile, samples
from panelwright.operators.groups import Stat
from panelwright.operators.lags import LagSpec, add_lags
from panelwright.operators.ordering import OrderedRows, row_ranks, running_totals
from panelwright.operators.quantiles import quantiles
from panelwright.spec import PanelSpec


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 'hot' holds a third of the rows or more; keys and values miss some entries."""
    rng = np.random.default_rng(0)
    n = 3000
    pdf = pd.DataFrame({
        "id": rng.permutation(n),
        "g": np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdef"), n)),
        "w": rng.integers(0, 5, n),
        "x": np.round(rng.normal(0, 10, n), 1),
        "flag": rng.integers(0, 2, n),
    })
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.05, "g"] = None
    return pdf, spark.createDataFrame(pdf).selectExpr(
        "id", "nullif(g, 'NaN') g", "cast(w as int) w", "nullif(x, double('NaN')) x", "cast(flag as int) flag"
    ).repartition(6)


def test_ranks_and_running_totals(skewed):
    pdf, df = skewed
    got = running_totals(df, ["id"], {"upto": "w", "cnt": F.lit(1)}).toPandas().sort_values("id")
    want = pdf.sort_values("id")
    assert list(got["upto"]) == list(want["w"].cumsum()) and list(got["cnt"]) == list(range(1, len(want) + 1))
    ranks = row_ranks(df, ["id"], "r").toPandas()
    assert (ranks["r"] == ranks["id"] + 1).all()
    ordered = OrderedRows(df, ["id"], {"w_upto": "w"})
    assert ordered.count() == len(pdf) and ordered.totals() == {"w_upto": pdf["w"].sum()}


def test_quantiles_by_group_and_overall(skewed):
    pdf, df = skewed
    ps = {"lo": 0.05, "mid": 0.5, "hi": 0.95, "max": 1.0, "min": 0.0}
    got = quantiles(df, ["g", "w"], "x", ps).toPandas().set_index(["g", "w"]).sort_index()
    want = pdf.dropna().groupby(["g", "w"])["x"]
    for name, p in ps.items():
        np.testing.assert_allclose(got[name], want.quantile(p).sort_index(), rtol=1e-12, atol=1e-12)
    overall = quantiles(df, [], "x", {"q": 0.37}).first()["q"]
    assert overall == pytest.approx(pdf["x"].quantile(0.37), rel=1e-12)


def test_group_stats_join_back_both_ways(skewed):
    pdf, df = skewed
    requests = {
        ("g", "w"): {"mean": Stat("mean", "x"), "n": Stat("count", "x"), "med": Stat("median", "x"), "total": Stat("sum", "x"),
                     "any": Stat("any", "flag")},
        ("w",): {"w_n": Stat("count", "id")},
    }
    by = pdf.groupby(["g", "w"])
    want = pdf.assign(
        mean=by["x"].transform("mean"), n=by["x"].transform("count"), med=by["x"].transform("median"), total=by["x"].transform("sum"),
        any=by["flag"].transform("any"), w_n=pdf.groupby("w")["id"].transform("count"),
    ).sort_values("id")
    for limit in (10_000, 0):
        got = groups.add_group_stats(df, requests, limit).toPandas().sort_values("id")
        assert len(got) == len(pdf)
        for c in ("mean", "n", "med", "total", "w_n"):
            np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)
        assert got["any"].isna().sum() == pdf["g"].isna().sum()


def test_a_group_without_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS DOUBLE)), (1, CAST(NULL AS DOUBLE)), (2, 3D) AS v(k, x)")
    got = groups.add_group_stats(df, {("k",): {"s": Stat("sum", "x"), "a": Stat("any", "x"), "m": Stat("mean", "x")}})
    assert {(r.k, r.s, r.a, r.m) for r in got.collect()} == {(1, 0.0, False, None), (2, 3.0, True, 3.0)}


def test_profile_against_describe(skewed):
    pdf, df = skewed
    got = profile.profile_numeric(df, ["x", "w", "id"]).toPandas().set_index("column")
    want = pdf[["x", "w", "id"]].describe().T
    for ours, theirs in zip(["count", "mean", "std", "min", "q25", "q50", "q75", "max"], want.columns, strict=True):
        np.testing.assert_allclose(got.loc[want.index, ours].astype(float), want[theirs], rtol=1e-9)
    quality = profile.profile_quality(df).toPandas().set_index("column")
    assert quality.loc["x", "missing_count"] == pdf["x"].isna().sum()
    assert quality.loc["x", "unique_count"] == pdf["x"].nunique() and quality.loc["w", "zero_count"] == (pdf["w"] == 0).sum()
    text = profile.profile_string(df, ["g"]).first()
    assert (text.top, text.freq) == ("hot", (pdf["g"] == "hot").sum()) and text.unique == pdf["g"].nunique()


def test_correlations_against_pandas(skewed):
    pdf, df = skewed
    pdf = pdf.assign(y=pdf["x"] * 2 + pdf["w"], c=1.0, z=np.where(pdf["id"] % 7 == 0, np.nan, pdf["w"] - pdf["flag"]))
    df = df.selectExpr("*", "x * 2 + w AS y", "1.0D AS c", "CASE WHEN id % 7 = 0 THEN double('NaN') ELSE w - flag END AS z")
    names = ["id", "x", "y", "w", "z", "c"]
    for method, got in (("pearson", correlations.pearson(df, names)), ("spearman", correlations.spearman(df, names))):
        want = pdf[names].corr(method=method)
        table = got.toPandas().pivot(index="a", columns="b", values="r").loc[names, names].astype(float)
        np.testing.assert_allclose(table, want, atol=1e-9, err_msg=method)


def test_histograms_against_numpy(skewed):
    pdf, df = skewed
    got = histograms.histograms(df, ["x", "w"], "id", 20).toPandas()
    x = got[got["column"] == "x"].sort_values("bin")
    counts, edges = np.histogram(pdf["x"].dropna(), bins=20)
    np.testing.assert_allclose(x["bin_low"], edges[:-1], atol=1e-9)
    assert x["rows"].sum() == counts.sum() and np.abs(x["rows"].to_numpy() - counts).sum() <= 2
    w = got[got["column"] == "w"].sort_values("bin")
    assert w["categorical"].all() and list(w["rows"])[::2] == list(pdf["w"].value_counts().sort_index())
    assert list(w["rows"])[1::2] == [0, 0, 0, 0]
    np.testing.assert_allclose(w["mean_target"].dropna(), pdf.groupby("w")["id"].mean())
    masked = histograms.histograms(df, ["w"], "id", 20, no_data=0).toPandas()
    assert masked["rows"].sum() == (pdf["w"] != 0).sum()


def test_histogram_of_a_constant(spark):
    got = histograms.histograms(spark.sql("SELECT 2.5D AS x, 1 AS y FROM range(4)"), ["x"], "y", 4).toPandas()
    assert got["rows"].sum() == 4 and got["bin_low"].min() == 2.0 and got["bin_high"].max() == 3.0


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_encoding_against_factorize(skewed, limit):
    pdf, df = skewed
    got = encoding.encode_categories(df, ["g", "w"], limit=limit).toPandas().sort_values("id")
    want = pdf.sort_values("id")
    assert list(got["g"]) == list(want["g"].factorize(sort=True)[0])
    assert list(got["w"]) == list(want["w"].factorize(sort=True)[0])


def test_numbers_are_coded_in_number_order(spark):
    df = spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT)), (10), (9), (100) AS v(x)")
    assert {(r.x, r.code) for r in df.select("x", F.col("x").alias("code")).transform(
        lambda d: encoding.encode_categories(d, ["code"])).collect()} == {(None, -1), (9, 0), (10, 1), (100, 2)}


def test_systematic_sample(skewed):
    pdf, df = skewed
    valid = pdf.dropna(subset=["x"]).sort_values("id")
    step = len(valid) // 100 + 1
    got = samples.systematic_sample(df, "id", ["x"], max_points=100).toPandas().sort_values("id")
    assert list(got["id"]) == list(valid["id"].iloc[::step])
    points = samples.scatter_extract(df, "id", "w", ["x", "flag"], "id", max_points=100).toPandas()
    assert sorted(points[points["x_column"] == "x"]["row_id"]) == list(valid["id"].iloc[::step])
    assert len(points[points["x_column"] == "flag"]) == len(pdf.iloc[:: len(pdf) // 100 + 1])


def test_series_offsets_against_sorted_rows(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 400), "b": rng.integers(0, 3, 400), "t": rng.integers(1, 30, 400)})
    pdf = pdf.drop_duplicates().sort_values(["a", "b", "t"]).reset_index(drop=True)
    spec = PanelSpec(("a", "b"), "t", "id", "y")
    got = offsets.series_offsets(spark.createDataFrame(pdf), spec, 10, 20).orderBy("series_no").collect()
    for number, ((a, b), rows) in enumerate(pdf.groupby(["a", "b"])):
        start = rows.index[0]
        want = (a, b, number, start, start + (rows["t"] <= 10).sum(), start + (rows["t"] <= 20).sum(), start + len(rows))
        assert tuple(got[number]) == want


def test_signed_zero_is_one_category(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 0D), (2, -0D), (3, double('NaN')), (4, 2.5D) AS v(id, x)")
    df = df.selectExpr("id", "CASE WHEN id = 2 THEN x * -1 ELSE x END AS x")
    got = encoding.encode_categories(df, ["x"]).orderBy("id").collect()
    assert [r.x for r in got] == [0, 0, -1, 1]


ODD = ["unit price", "order", "a.b", "it's", "back`tick"]


@pytest.fixture(scope="module")
def odd(spark):
    cells = ", ".join(f"id * {i + 1} % 7 + 0.5 AS `{c.replace('`', '``')}`" for i, c in enumerate(ODD))
    return spark.sql(f"SELECT id, id % 3 AS `k 1`, cast(id % 4 as string) AS `a.c`, {cells} FROM range(60)")


def test_any_column_name_works(odd):
    names = ODD
    assert profile.profile_numeric(odd, names).count() == len(names)
    assert profile.profile_quality(odd).count() == len(odd.columns) == profile.schema_report(odd).count()
    assert profile.profile_string(odd, ["a.c"]).first().unique == 4
    for found in (correlations.pearson(odd, names), correlations.spearman(odd, names)):
        assert found.where("a = b AND abs(r - 1) < 1e-9").count() == len(names)
    stats = {("k 1", "a.c"): {"the mean": groups.Stat("mean", "unit price"), "mid": groups.Stat("median", "a.b")}}
    wide = groups.add_group_stats(odd, stats)
    assert wide.columns == [*odd.columns, "the mean", "mid"] and wide.where("mid IS NULL").count() == 0
    coded = encoding.encode_categories(odd, ["a.c", "it's"])
    assert coded.columns == odd.columns and {r[0] for r in coded.select("`a.c`").collect()} == {0, 1, 2, 3}
    spec = PanelSpec(("k 1",), "order", "id", "unit price", max_rows=100)
    for one in (spec, PanelSpec(("k 1",), "order", "id", "unit price")):
        lagged = add_lags(odd, one, [LagSpec(-1, -3, 0, 0.0, ("a.b",), ("order",))], 2)
        assert "a.b_1n1" in lagged.columns and lagged.count() == 60


def test_infinite_values_give_no_correlation(spark):
    df = spark.sql("SELECT cast(id as double) AS x, CASE WHEN id = 3 THEN double('Infinity') ELSE id * 2D END AS y, id % 5 * 1D AS z FROM range(9)")
    got = {(r.a, r.b): r.r for r in correlations.pearson(df, ["x", "y", "z"]).collect()}
    assert got["x", "y"] is None and got["y", "y"] is None and got["x", "z"] is not None


def test_far_apart_categories_have_bins_in_a_range(spark):
    df = spark.sql("SELECT * FROM VALUES (0D, 1), (5D, 2), (100000D, 4) AS v(x, y)")
    bins = histograms.histograms(df, ["x"], "y", 10)
    assert bins.count() == 200_001 and bins.where("rows > 0").count() == 3


def test_late_page_of_categories(spark):
    df = spark.range(1000).selectExpr("id % 500 AS a")
    rows = encoding.category_page(df, ["a"], 495, 600, 3).orderBy("position").collect()
    assert [(r.a, r.rows, r.position, r.page, r.total) for r in rows] == [(495 + i, 2, 495 + i, i // 3, 500) for i in range(5)]
