"""Group statistics joined back to the rows they came from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.names import quoted
from panelwright.operators.quantiles import quantiles
from panelwright.storage import BROADCAST_BYTES, BroadcastBudget, materialize, stored_bytes


@dataclass(frozen=True)
class Stat:
    """One statistic of one column: ``how`` is mean, count, median, sum or any."""

    how: str
    column: str

    def sql(self) -> str:
        forms = {
            "mean": "avg({c})",
            "count": "count({c})",
            "sum": "coalesce(sum({c}), 0)",
            "any": "coalesce(bool_or({c} != 0), false)",
        }
        return forms[self.how].format(c=quoted(self.column))


def add_group_stats(
    df: DataFrame, requests: dict[tuple[str, ...], dict[str, Stat]], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add group statistics as columns; ``requests`` maps key columns to {output column: statistic}.

    The rows are stored once and then aggregated for all key sets in one pass. The stored sizes of the statistics decide
    which are broadcast back, ``limit`` bytes at most in all; the others are joined by a shuffle. A row with a NULL key
    gets NULL.
    """
    medians = {keys: {o: s for o, s in outs.items() if s.how == "median"} for keys, outs in requests.items()}
    simple = {keys: {o: s for o, s in outs.items() if s.how != "median"} for keys, outs in requests.items()}
    simple = {keys: outs for keys, outs in simple.items() if outs}
    rows = materialize(df, "group-rows")
    result, budget = rows, BroadcastBudget(limit)
    if simple:
        needed = list(dict.fromkeys(s for outs in simple.values() for s in outs.values()))
        names = {s: f"_stat{i}" for i, s in enumerate(needed)}
        columns = list(dict.fromkeys(k for keys in simple for k in keys))
        sets = {keys: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for keys in simple}
        keyed = rows.select(*[F.col(quoted(c)).alias(f"_key{i}") for i, c in enumerate(columns)], "*")
        place = {c: f"_key{i}" for i, c in enumerate(columns)}
        stored = materialize(
            keyed.groupingSets([[place[k] for k in keys] for keys in simple], *place.values()).agg(
                F.grouping_id().alias("_set"), *[F.expr(f"{s.sql()} AS {n}") for s, n in names.items()]
            ),
            "group-stats",
            partition_by="_set",
        )
        for keys, outs in simple.items():
            side = stored.where(F.col("_set") == sets[keys]).dropna(subset=[place[k] for k in keys])
            size = stored_bytes(side, f"_set={sets[keys]}")
            side = side.selectExpr(*[place[k] for k in keys], *[f"{names[s]} AS {quoted(o)}" for o, s in outs.items()])
            result = _joined(result, budget.sized(side, size), keys, [place[k] for k in keys])
    for keys, outs in medians.items():
        for out, stat in outs.items():
            place = {c: f"_key{i}" for i, c in enumerate(keys)}
            slim = rows.select(*[F.col(quoted(c)).alias(n) for c, n in place.items()], F.col(quoted(stat.column)).alias("_value"))
            side = materialize(quantiles(slim, list(place.values()), "_value", {out: 0.5}), "medians")
            result = _joined(result, budget.sized(side, stored_bytes(side)), keys, list(place.values()))
    added = [o for outs in requests.values() for o in outs]
    return result.select(*[quoted(c) for c in (*df.columns, *added)])


def _joined(rows: DataFrame, side: DataFrame, keys: Sequence[str], named: Sequence[str]) -> DataFrame:
    """Join the statistics in ``side``, keyed by ``named``, to the rows."""
    same = [F.col(quoted(k)) == F.col(n) for k, n in zip(keys, named, strict=True)]
    return rows.join(side, same, "left").drop(*named)


def week_count_requests(categories: Sequence[str], time: str, id_col: str) -> dict[tuple[str, ...], dict[str, Stat]]:
    """Rows by (category, period) for every category, and by period alone."""
    wanted = {(c, time): {f"{c}_{time}_count": Stat("count", id_col)} for c in categories}
    wanted[(time,)] = {f"{time}_count": Stat("count", id_col)}
    return wanted


def mean_requests(categories: Sequence[str], time: str, columns: dict[str, str]) -> dict[tuple[str, ...], dict[str, Stat]]:
    """Means by (category, period); ``columns`` maps column to a name pattern with ``{}`` for the category."""
    return {(c, time): {p.format(c): Stat("mean", col) for col, p in columns.items()} for c in categories}


def merge_requests(*parts: dict[tuple[str, ...], dict[str, Stat]]) -> dict[tuple[str, ...], dict[str, Stat]]:
    """Put several request sets together, so that one pass serves all of them."""
    merged: dict[tuple[str, ...], dict[str, Stat]] = {}
    for part in parts:
        for keys, outs in part.items():
            merged.setdefault(keys, {}).update(outs)
    return merged


def panel_features(
    df: DataFrame,
    categories: Sequence[str],
    time: str,
    id_col: str,
    prices: Sequence[str] = (),
    flags: Sequence[str] = (),
    counts: bool = True,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Weekly counts, price ratios and promotion rates of every category, from one aggregation pass.

    ``<category>_<time>_count`` and ``<time>_count`` count rows, ``<category>_<time>_<price>_ratio`` divides a price by
    its mean in the category and period, ``<category>_<flag>_mean`` is the share of promoted rows there.
    """
    parts = [week_count_requests(categories, time, id_col)] if counts else []
    ratio_names = {p: "{}_" + f"{time}_{p}_ratio" for p in prices}
    flag_names = {f: "{}_" + f"{f}_mean" for f in flags}
    parts.append(mean_requests(categories, time, {**ratio_names, **flag_names}))
    wide = add_group_stats(df, merge_requests(*parts), limit)
    ratios = {name.format(c): p for p, name in ratio_names.items() for c in categories}
    divided = {n: f"try_divide(cast({quoted(p)} as double), {quoted(n)}) AS {quoted(n)}" for n, p in ratios.items()}
    return wide.selectExpr(*[divided.get(n, quoted(n)) for n in wide.columns])
