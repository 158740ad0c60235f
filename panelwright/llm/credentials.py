"""Secrets in whole texts: sure ones by their form, weak ones by the company they keep.

A sure secret is reported wherever it stands. Weak candidates (short or unlabelled keys, login names, endpoints) occur
in ordinary text too; one is reported only when a complementary part stands in the same scope: a key needs an
identifier or an endpoint, an identifier or an endpoint needs a secret. A scope reaches ``scope`` characters to either
side, from the end of one part to the start of the other. Complementary parts are found by an interval join on all cells
of the scope's width that a part reaches, as a semi join, so that dense texts do not multiply rows. Only DataFrame
operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import text_of
from panelwright.llm.spans import labelled, overlaps, with_spans, written
from panelwright.storage import materialize

_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""

#: Sure kinds, in the order in which spans with one start are listed.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)""" + _ASSIGNED + r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
_VALUE = r"""(?i:password|passwd|secret|token|api_?key)""" + _ASSIGNED + r"([A-Za-z0-9+/_.=-]+)"

_NEEDS = {"assign": (":", "="), "access": ("AKIA",), "login": (":", "="), "endpoint": (":", "=")}

#: Weak kinds: the part that each plays, and its form.
WEAK = {
    "key": (
        "secret",
        r"""(?<![A-Za-z0-9_])(?i:pwd|pass|passphrase|auth|credential|(?:private|access|account|shared)_?key|key)"""
        + _ASSIGNED
        + r"[A-Za-z0-9+/_.=!@#$%^&*-]{4,}+"
        + r"|(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]*[0-9])(?=[0-9A-Z+/]*[a-z])(?=[0-9a-z+/]*[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])",
    ),
    "login": (
        "identifier",
        r"""(?<![A-Za-z0-9_])(?i:user|user_?name|login|account|client_?id|access_?key_?id)"""
        + _ASSIGNED
        + r"[A-Za-z0-9+/_.@-]{2,}+",
    ),
    "endpoint": (
        "endpoint",
        r"""(?<![A-Za-z0-9_])(?:(?i:host|hostname|server|endpoint|bucket)"""
        + _ASSIGNED
        + r"""[A-Za-z0-9_.:/-]{3,}+|[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]++)""",
    ),
}
#: Parts that make a weak part worth reporting.
COMPLEMENTS = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
KEYS = ["doc_id", "_hash", "_chars"]


def _sure(kind: str, spans: Column) -> Column:
    if kind == "assign":
        return F.filter(spans, lambda s: F.length(F.regexp_extract(s["value"], _VALUE, 1)) >= 6)
    if kind == "access":
        return F.filter(spans, lambda s: s["end"] - s["start"] >= 20)
    return spans


def find_parts(documents: DataFrame) -> DataFrame:
    """Sure and weak spans of every document as arrays, with keys that tell different texts apart; no text."""
    slim = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    slim = slim.withColumns({"_hash": F.xxhash64("text"), "_chars": F.length("text")})
    found = with_spans(slim, "text", BASE | {k: p for k, (_, p) in WEAK.items()}, needs=_NEEDS).drop("text")
    found = found.withColumns({k: _sure(k, F.col(k)) for k in BASE})
    sure = F.concat(*[F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in BASE])
    weak = {k: F.filter(k, lambda s: ~F.exists(F.col("_sure"), lambda b: overlaps(s, b))) for k in WEAK}
    return found.withColumn("_sure", sure).withColumns(weak).drop("_sure")


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak spans with a complementary part in their scope: the keys and one array ``weak`` per document with any.

    ``parts`` has ``KEYS`` and the arrays of ``find_parts``. Repeated rows are taken once.
    """
    roles = {"assign": "secret", "hex": "secret", "access": "identifier"} | {k: r for k, (r, _) in WEAK.items()}
    some = parts.filter(F.size(F.concat(*[F.transform(k, lambda s: s["start"]) for k in WEAK])) > 0)
    every = [F.transform(k, _part(k, role)) for k, role in roles.items()]
    rows = some.select(*KEYS, F.explode(F.concat(*every)).alias("s")).select(*KEYS, "s.*").dropDuplicates()
    rows = materialize(rows, "parts")

    def cells(reach: int) -> Column:
        return F.explode(F.sequence(F.floor((F.col("start") - reach) / scope), F.floor((F.col("end") + reach) / scope)))

    weak = rows.filter(F.col("kind").isin(*WEAK)).withColumn("_cell", cells(scope)).alias("w")
    others = rows.withColumn("_cell", cells(0)).alias("o")
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"o.{k}")) for k in KEYS] + [F.col("w._cell") == F.col("o._cell")]
    near = F.greatest("w.start", "o.start") - F.least("w.end", "o.end") <= scope
    fits = F.lit(False)
    for role, partners in COMPLEMENTS.items():
        fits = fits | ((F.col("w.role") == role) & F.col("o.role").isin(*partners))
    condition = near & fits
    for one in same:
        condition = condition & one
    reported = weak.join(others, condition, "left_semi").select(*KEYS, "kind", "start", "end")
    span = F.struct("start", "end", "kind")
    return reported.groupBy(*KEYS).agg(F.collect_set(span).alias("weak"))


def _part(kind: str, role: str):
    def part(s: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(role).alias("role"), s["start"].alias("start"), s["end"].alias("end")
        )

    return part


def find_secrets(documents: DataFrame, scope: int = 300) -> DataFrame:
    """One row per document: doc_id, the arrays of sure spans, and ``spans``, all reported spans in order.

    An element of ``spans`` has start, rank, end and kind. A null or empty text has none; repeated rows each get theirs;
    ids may be null or repeat with other texts. Spans are code points of the whole text.
    """
    parts = materialize(find_parts(documents), "secrets")
    weak = linked(parts, scope)
    weak = weak.select(*[F.col(k).alias(f"_{k}") for k in KEYS], "weak")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    joined = parts.drop(*WEAK).join(weak, same, "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    joined = joined.withColumn("weak", F.coalesce("weak", none))
    more = {k: F.filter("weak", _of_kind(k)) for k in WEAK}
    return joined.select("doc_id", *BASE, labelled({k: F.col(k) for k in BASE} | more).alias("spans"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def digests(found: DataFrame) -> DataFrame:
    """Counts of the sure kinds, the checksum of their spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(written(labelled({k: F.col(k) for k in BASE})), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
