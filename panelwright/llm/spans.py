"""Spans of regular expressions inside texts as columns, by built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CHUNK = 256


def added_up(lengths: Column) -> Column:
    """Running totals of an array of integers, each without its own element.

    An array is extended element by element, which copies it; chunks keep that cheap for very long arrays.
    """

    def running(items: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        return F.aggregate(items, start, step)

    size = F.size(lengths)
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(size / _CHUNK) - 1, F.lit(0)).cast("int")),
        lambda c: running(F.slice(lengths, c * _CHUNK + 1, _CHUNK)),
    )

    def combined(parts: Column) -> Column:
        before = running(F.transform(parts, lambda p: p["at"]))["out"]
        return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p["out"], lambda s: s + b)))

    # transform over a one-element array gives the chunks a name, so that they are computed once
    return F.transform(F.array(chunks), combined)[0]


def with_spans(
    df: DataFrame, text: str, patterns: dict[str, str], context: int = 0, needs: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Add per pattern the array of its leftmost non-overlapping matches in ``text``.

    An element has start and end (code points from 0, end exclusive), the matched value, and with ``context`` that many
    characters before and after it, up to the neighbouring match. A null text has no matches. The value is the whole
    match; patterns must not match the empty text. ``needs`` names strings of which every match holds one, so that a
    plain search spares the expression for texts without them.
    """
    seen = {}
    for k in patterns:
        t = F.coalesce(F.col(text), F.lit(""))
        if needs and k in needs:
            t = F.when(any_of([t.contains(x) for x in needs[k]]), t).otherwise(F.lit(""))
        seen[k] = t
    raw = df.withColumns(
        {f"_f_{k}": F.regexp_extract_all(seen[k], F.lit(p), F.lit(0)) for k, p in patterns.items()}
        | {f"_p_{k}": F.split(seen[k], p, -1) for k, p in patterns.items()}
    )
    lengths = {
        f"_l_{k}": F.zip_with(f"_p_{k}", f"_f_{k}", lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
        for k in patterns
    }
    raw = raw.withColumns(lengths)
    raw = raw.withColumns({f"_a_{k}": F.when(F.size(f"_f_{k}") > 0, added_up(F.col(f"_l_{k}"))) for k in patterns})
    out: dict[str, Column] = {}
    for k in patterns:
        found, pieces, at = F.col(f"_f_{k}"), F.col(f"_p_{k}"), F.col(f"_a_{k}")

        out[k] = F.transform(found, _span(pieces, at, context))
    kept = [F.col(f"`{c}`") for c in df.columns]
    return raw.select(*kept, *[F.coalesce(v, F.array().cast(_kind(context))).alias(k) for k, v in out.items()])


def _span(pieces: Column, at: Column, context: int):
    def span(m: Column, i: Column) -> Column:
        start = at[i] + F.length(pieces[i])
        fields = [start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value")]
        if context:
            fields.append(F.right(pieces[i], F.lit(context)).alias("before"))
            fields.append(F.left(pieces[i + 1], F.lit(context)).alias("after"))
        return F.struct(*fields)

    return span


def _kind(context: int) -> str:
    more = ",before:string,after:string" if context else ""
    return f"array<struct<start:int,end:int,value:string{more}>>"


def labelled(kinds: dict[str, Column]) -> Column:
    """One array of (start, order, end, kind) of all kinds, sorted by start and then in the order of ``kinds``."""
    parts = [
        F.transform(
            spans,
            _labels(name, order),
        )
        for order, (name, spans) in enumerate(kinds.items())
    ]
    return F.array_sort(F.concat(*parts))


def _labels(name: str, rank: int):
    def label(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind"))

    return label


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions)
