"""The stored table of features that all model fits read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from panelwright.functions.columns import log_target
from panelwright.functions.names import quoted
from panelwright.operators.encoding import category_dictionary, encode_categories
from panelwright.operators.groups import panel_features
from panelwright.operators.joins import enrich
from panelwright.operators.series import density, expanding_means
from panelwright.spec import PanelSpec
from panelwright.storage import materialize


@dataclass(frozen=True)
class TrainingFrame:
    """Features, the target, and its logarithm (``log_target``) for every row."""

    rows: DataFrame
    log_target: str


def training_frame(
    rows: DataFrame,
    dimensions: dict[str, DataFrame],
    spec: PanelSpec,
    categorical: Sequence[str],
    prices: Sequence[str],
    flags: Sequence[str],
    engineered: bool = True,
    order_upto: int | None = None,
    keep: Sequence[str] | None = None,
) -> TrainingFrame:
    """Join dimensions, encode categories, add the engineered features and store the result once.

    Category codes follow the mean logarithm of the target over the rows up to period ``order_upto``, which should lie
    before every test part; without it they follow the values. Statistics and expanding means use inputs that are known for future rows as well; only the target is not.
    With ``keep`` the stored table has these columns next to id, keys, period and target, and no others; the rows are the same.
    """
    wide = materialize(enrich(rows, dimensions), "enriched")
    score = None
    if order_upto is not None:
        score = f"CASE WHEN {quoted(spec.time)} <= {order_upto} THEN ln(1 + {quoted(spec.target)}) END"
    wide = encode_categories(wide, categorical, category_dictionary(wide, categorical, score))
    logged = f"log_{spec.target}"
    if engineered:
        # The windows come first: their shuffle carries the raw columns only, and the statistics follow without another one.
        raw = wide.columns
        wide = expanding_means(wide, spec, {f"{c}_mean_ts": c for c in (*prices, *flags)})
        wide = density(wide, spec, "ts_mean")
        windows = wide.columns[len(raw):]
        wide = panel_features(wide, categorical, spec.time, spec.id, prices, flags)
        statistics = [c for c in wide.columns if c not in raw and c not in windows]
        wide = wide.select(*[quoted(c) for c in (*raw, *statistics, *windows)])
    wide = wide.withColumn(logged, log_target(spec.target))
    if keep is not None:
        wide = wide.select(*[quoted(c) for c in dict.fromkeys([spec.id, *spec.keys, spec.time, spec.target, *keep, logged])])
    return TrainingFrame(materialize(wide, "frame"), logged)


def raw_groups(features: Sequence[str]) -> list[list[str]]:
    """Every raw feature is a group of its own."""
    return [[f] for f in features]


def engineered_groups(categorical: Sequence[str], prices: Sequence[str], flags: Sequence[str], time: str) -> list[list[str]]:
    """Engineered columns with the raw columns they need; a group enters or leaves a model as a whole."""
    groups = [[f"{c}_mean_ts", c] for c in (*prices, *flags)]
    groups += [[f"{c}_{time}_count", c] for c in categorical]
    groups += [[f"{time}_count"], ["ts_mean"]]
    for c in categorical:
        groups += [[f"{c}_{time}_{p}_ratio", c, p] for p in prices]
        groups += [[f"{c}_{f}_mean", c, f] for f in flags]
    return groups
