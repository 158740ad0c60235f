"""Personal data in whole texts: sure forms, and candidates judged by boosted trees.

Mail and network addresses, card numbers and phone numbers are reported by their form alone. Generators of high recall
propose further spans, which overlap freely: veiled mail addresses, runs of digits, account numbers, long network
addresses. Account numbers and network addresses bear their own evidence: an IBAN has the length of its country and a
check number, an IPv6 address has valid groups; one that holds is reported in any case. Boosted trees judge the others
by the format of the span and the words beside it. They learn from the corpus itself: sure spans rewritten into the
generators' formats and proven proposals against proposals that nothing supports. Held-out rows set a threshold per
generator. Only DataFrame and ML pipeline operations are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import text_of
from panelwright.llm.spans import labelled, overlaps, with_spans, written
from panelwright.storage import materialize, shared_folder

# A match can start only where a run of its first characters starts or where the last match ended; saying so spares
# the search a try at every character of a long run.
#: Sure kinds, in the order in which spans with one start are listed.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"\x20?(?:\[at\]|\(at\)|\{at\}|\x20at\x20|@)\x20?"
_DOT = r"\x20?(?:\[dot\]|\(dot\)|\{dot\}|\x20dot\x20|\.)\x20?"
#: Generators of candidates.
PROPOSED = {
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+" + _AT + r"[A-Za-z0-9-]{1,63}+(?:" + _DOT + r"[A-Za-z0-9-]{1,63}+){1,5}+",
    "number": r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?",
    "network": r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)",
}
#: Length of an IBAN by country.
_IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Kinds whose proposals are proven or disproven by themselves.
PROVABLE = ("account", "network")
_NEEDS = {"email": ("@",), "ip": (".",), "phone": ("+",), "contact": ("@", "at]", "at)", "at}", " at "), "network": (":",)}
CONTEXT = 24
KEYS = ["doc_id", "_hash", "_chars"]


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""

    def weigh(d: Column, i: Column) -> Column:
        x = d.try_cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.when(i % 2 == 1, twice).otherwise(x)

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    total = F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return (F.length(digits) > 0) & (total % 10 == 0)


def is_iban(value: Column) -> Column:
    """Whether a value of capitals, digits and spaces has the length of its country and a valid check number."""
    compact = F.regexp_replace(value, " ", "")
    size = F.element_at(_iban_sizes(), F.left(compact, F.lit(2)))
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.left(compact, F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        digit = c.try_cast("int")
        return F.when(digit.isNotNull(), (rest * 10 + digit) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)
    return F.coalesce((F.length(compact) == size) & (rest == 1), F.lit(False))


def _iban_sizes() -> Column:
    return F.create_map(*[F.lit(x) for n, names in _IBAN.items() for c in names.split() for x in (c, n)])


def is_ipv6(value: Column) -> Column:
    """Whether groups of up to four hex digits make an address: eight, or fewer around one double colon.

    Words of code such as ``a::b`` are short: with a double colon, the first group needs three digits or three groups
    must be written, and one decimal digit must be among them.
    """
    groups = F.size(F.filter(F.split(value, ":"), lambda g: g != ""))
    short = value.contains("::") & (groups <= 7) & value.rlike("[0-9]")
    return (~value.contains("::") & (groups == 8)) | (short & ((groups >= 3) | value.rlike("^[0-9A-Fa-f]{3}")))


def _proven(kind: Column, value: Column, after: Column) -> Column:
    """Whether a proposal shows by itself that it is an account number or a network address."""
    whole = ~after.rlike("^[0-9A-Za-z]")
    account = (kind == "account") & whole & is_iban(value)
    return account | ((kind == "network") & whole & ~after.rlike("^::?[0-9A-Fa-f]") & is_ipv6(value))


def _cut(s: Column) -> Column:
    """An account proposal without the words after a valid IBAN that look like more groups of it."""
    size = F.element_at(_iban_sizes(), F.left(s["value"], F.lit(2)))
    form = F.concat(F.lit("^(?:[A-Z0-9] ?){"), (size - 1).cast("string"), F.lit("}[A-Z0-9](?= )"))
    head = F.when(size.isNotNull(), F.call_function("regexp_extract", s["value"], form, F.lit(0)))
    end = s["start"] + F.length(head)
    after = F.left(F.concat(F.substring(s["value"], F.length(head) + 1, F.length(s["value"])), s["after"]), F.lit(CONTEXT))
    cut = F.struct(
        s["start"].alias("start"), end.alias("end"), head.alias("value"), s["before"].alias("before"), after.alias("after")
    )
    return F.when((F.length(head) > 0) & is_iban(head), cut).otherwise(s)


def _sure(kind: str, spans: Column) -> Column:
    def between(least: int, most: int):
        return lambda s: F.length(digits_of(s["value"])).between(least, most)

    def small_parts(s: Column) -> Column:
        parts = F.transform(F.split(s["value"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))

    if kind == "ip":
        return F.filter(spans, small_parts)
    if kind == "card":
        return F.filter(F.filter(spans, between(12, 19)), lambda s: passes_luhn(digits_of(s["value"])))
    return F.filter(spans, between(9, 15)) if kind == "phone" else spans


def find_candidates(documents: DataFrame) -> DataFrame:
    """Sure and proposed spans of every document as arrays, with keys that tell different texts apart; no text.

    Proposals that overlap a sure span are left out, but for a valid IBAN, whose digits can look like a card's.
    """
    slim = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    slim = slim.withColumns({"_hash": F.xxhash64("text"), "_chars": F.length("text")})
    found = with_spans(slim, "text", BASE | PROPOSED, CONTEXT, _NEEDS).drop("text")
    found = found.withColumns({k: _sure(k, F.col(k)) for k in BASE})
    sure = F.concat(*[F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in BASE])
    found = found.withColumn("account", F.transform("account", _cut))

    def free_of(kind: str):
        def free(s: Column) -> Column:
            apart = ~F.exists(F.col("_sure"), lambda b: overlaps(s, b))
            return apart | _proven(F.lit(kind), s["value"], s["after"]) if kind in PROVABLE else apart

        return free

    free = {k: F.filter(k, free_of(k)) for k in PROPOSED}
    return found.withColumn("_sure", sure).withColumns(free).drop("_sure")


def _features() -> dict[str, Column]:
    """Numbers from the span's value, its generator and the text beside it."""
    value, before, after = F.col("value"), F.lower("before"), F.lower("after")
    digits = digits_of(value)
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    longest = F.aggregate(groups, F.lit(0), lambda a, g: F.greatest(a, F.length(g)))

    def count(pattern: str) -> Column:
        return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))

    found = {
        "chars": F.length(value),
        "digits": F.length(digits),
        "groups": F.size(groups),
        "longest": longest,
        "shortest": F.aggregate(groups, F.lit(99), lambda a, g: F.least(a, F.length(g))),
        "spaces": count(" "),
        "points": count("[.]"),
        "dashes": count("-"),
        "brackets": count(r"[()\[\]{}]"),
        "slashes": count("/"),
        "signs": count("@"),
        "capitals": count("[A-Z]"),
        "letters": count("[A-Za-z]"),
        "words": F.size(F.filter(F.split(value, "[^A-Za-z]+"), lambda g: g != "")),
        "veiled": value.rlike(r"[\[({]at[\])}]|[\[({]dot[\])}]|\x20dot\x20"),
        "luhn": passes_luhn(digits),
        "proven": _proven(F.col("kind"), value, F.col("after")),
        "says_phone": before.rlike("phone|tel|call|mobile|cell|fax|dial"),
        "says_mail": before.rlike("mail|contact|write|reach"),
        "says_card": before.rlike("card|visa|account|iban|bank|passport|ssn|social"),
        "says_other": before.rlike("order|invoice|isbn|page|version|serial|item|part|ref"),
        "money_before": before.rlike("[$€£#%*]\\x20?$"),
        "joined_after": after.rlike("^[a-z%@]"),
    }
    found |= {f"is_{k}": F.col("kind") == k for k in PROPOSED}
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in found.items()}


NAMES = [
    "chars", "digits", "groups", "longest", "shortest", "spaces", "points", "dashes", "brackets", "slashes", "signs",
    "capitals", "letters", "words", "veiled", "luhn", "proven", "says_phone", "says_mail", "says_card", "says_other",
    "money_before", "joined_after", *[f"is_{k}" for k in PROPOSED],
]


def _exploded(candidates: DataFrame, kinds: list[str]) -> DataFrame:
    spans = F.concat(*[F.transform(k, _named(k)) for k in kinds])
    return candidates.select(*KEYS, F.explode(spans).alias("s")).select(*KEYS, "s.*").dropDuplicates()


def _named(kind: str):
    names = ("start", "end", "value", "before", "after")
    return lambda s: F.struct(F.lit(kind).alias("kind"), *[s[n].alias(n) for n in names])


def examples(candidates: DataFrame) -> DataFrame:
    """All labelled spans of the corpus, with a hash ``h`` that deals them out.

    Positives are sure spans written the way the generators see them, and account numbers and network addresses that
    are proven by themselves. Negatives are proposals that nothing supports, but for those in the shape of a positive,
    which may well be personal data; a number as long as a card's that fails the check digit, an account number and a
    network address that fail are negatives in any shape.
    """
    value = F.col("value")
    local = F.regexp_replace(value, r"^\+[0-9]{1,2}[\x20.-]*", "")
    group = F.regexp_replace(F.regexp_replace(local, r"[()]", ""), r"[\x20.-]+", "-")
    veiled = F.regexp_replace(F.regexp_replace(value, "@", " [at] "), r"\.", " [dot] ")
    spoken = F.regexp_replace(F.regexp_replace(value, "@", " at "), r"\.", " dot ")
    round_ = F.regexp_replace(value, "@", "(at)")

    def variants(kind: str, *forms: Column) -> Column:
        return F.array(*[F.struct(F.lit(kind).alias("as"), f.alias("v")) for f in forms])

    written_as = (
        F.when(F.col("kind") == "email", variants("contact", veiled, spoken, round_))
        .when(F.col("kind") == "phone", variants("number", local, group, F.regexp_replace(group, "-", ".")))
        .when(F.col("kind") == "card", variants("number", F.regexp_replace(digits_of(value), "(.{4})(?=.)", "$1 ")))
    )
    sure = _exploded(candidates, list(BASE)).withColumn("w", F.explode(written_as))
    sure = sure.select(F.col("w.as").alias("kind"), F.col("w.v").alias("value"), "before", "after", F.lit(1.0).alias("label"))
    free = _exploded(candidates, list(PROPOSED)).select(
        "kind", "value", "before", "after", _proven(F.col("kind"), value, F.col("after")).cast("double").alias("label")
    )
    sure = sure.unionByName(free.filter("label = 1"))
    free = free.filter("label = 0")
    seen = ["kind", "value", "before", "after"]

    positive = materialize(sure.withColumn("h", F.xxhash64(*seen)), "positives")
    shape = F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), r"[A-Za-z_%+-]+", "a")
    shapes = positive.select("kind", shape.alias("_shape")).distinct()
    broken = F.length(digits_of(value)).between(12, 19) & ~passes_luhn(digits_of(value)) | F.col("kind").isin(*PROVABLE)
    unlike = free.withColumns({"_shape": shape, "_broken": broken}).alias("f")
    same = (F.col("f.kind") == F.col("s.kind")) & (F.col("f._shape") == F.col("s._shape")) & ~F.col("f._broken")
    negative = unlike.join(shapes.alias("s"), same, "left_anti").drop("_shape", "_broken")
    return positive.unionByName(negative.withColumn("h", F.xxhash64(*seen)))


def learn(
    candidates: DataFrame, rounds: int = 10, depth: int = 4, false_rate: float = 0.002
) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """Fit the trees on three quarters of all examples; thresholds from the held-out quarter.

    Both classes weigh the same, however many examples they have. The trees take as many bins as the examples need for
    Spark to read all of them, not a sample, when it looks for splits.
    A generator's threshold is the smallest probability, in steps of a hundredth and at least one half, that lets at
    most ``false_rate`` of its held-out negatives pass. None where one of the classes has no example.
    """
    shared_folder(candidates.sparkSession)
    stored = materialize(examples(candidates).select("kind", "label", "h", *[v.alias(k) for k, v in _features().items()]), "examples")
    assembled = VectorAssembler(inputCols=NAMES, outputCol="features").transform(stored)
    held = F.pmod(F.shiftright("h", 8), F.lit(4)) == 0
    train = assembled.filter(~held)
    classes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return None
    total = sum(classes.values())
    weight = F.when(F.col("label") == 1, total / 2 / classes[1.0]).otherwise(total / 2 / classes[0.0])
    bins = max(32, math.ceil(math.sqrt(total)))
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, maxBins=bins, weightCol="weight")
    model = trees.fit(train.select("features", "label", weight.alias("weight")))
    scored = model.transform(assembled.filter(held)).select("kind", "label", vector_to_array("probability")[1].alias("p"))
    step = F.floor(F.col("p") * 100).cast("int").alias("step")
    rows = scored.filter("label = 0").groupBy("kind", step).agg(F.count(F.lit(1)).alias("n")).collect()
    thresholds = {}
    for kind in PROPOSED:
        steps = {r["step"]: r["n"] for r in rows if r["kind"] == kind}
        total, passing, best = sum(steps.values()), 0, 1.01
        for at in range(100, 49, -1):
            passing += steps.get(at, 0)
            if passing > false_rate * total:
                break
            best = at / 100
        thresholds[kind] = best
    return model, thresholds


def judged(candidates: DataFrame, learned: tuple[GBTClassificationModel, dict[str, float]] | None) -> DataFrame:
    """Proposals that are proven or that the model, if there is one, takes for personal data.

    The keys and one array ``more`` per document with any.
    """
    rows = _exploded(candidates, list(PROPOSED))
    rows = rows.select(*KEYS, "kind", "start", "end", *[v.alias(k) for k, v in _features().items()])
    passes = F.col("proven") == 1
    if learned is not None:
        model, thresholds = learned
        rows = model.transform(VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows))
        p = vector_to_array("probability")[1]
        passes = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (p >= t) for k, t in thresholds.items()], passes)
    chosen = rows.filter(passes).select(*KEYS, F.struct("start", "end", "kind").alias("s"))
    return chosen.groupBy(*KEYS).agg(F.collect_set("s").alias("more"))


def find_personal(documents: DataFrame) -> DataFrame:
    """One row per document: ``KEYS``, the arrays of sure spans, and ``spans``, all reported spans in order.

    An element of ``spans`` has start, rank, end and kind. A null or empty text has none; repeated rows each get theirs;
    ids may be null or repeat with other texts. Spans are code points of the whole text.
    """
    candidates = materialize(find_candidates(documents), "candidates")
    more = judged(candidates, learn(candidates)).select(*[F.col(k).alias(f"_{k}") for k in KEYS], "more")
    kept = candidates.select(*KEYS, *[F.transform(k, _places).alias(k) for k in BASE])
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    kept = kept.join(more, same, "left").drop(*[f"_{k}" for k in KEYS]).withColumn("more", F.coalesce("more", none))
    kinds = {k: F.col(k) for k in BASE} | {k: F.filter("more", _of_kind(k)) for k in PROPOSED}
    return kept.select(*KEYS, *BASE, labelled(kinds).alias("spans"))


def _places(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["end"].alias("end"))


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


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first stays."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        added = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(s)).alias("out"))
        return F.when(s["start"] >= acc["at"], added).otherwise(acc)

    apart = F.aggregate(spans, start, step)["out"]

    def rebuilt(kept: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(kept, lambda s: s["end"]))

        def piece(s: Column, i: Column) -> Column:
            return F.concat(F.substring(text, ends[i] + 1, s["start"] - ends[i]), F.lit("["), F.upper(s["kind"]), F.lit("]"))

        rest = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(kept, piece), ""), rest)

    # transform over a one-element array gives the kept spans a name, so that they are computed once
    return F.when(F.size(spans) > 0, F.transform(F.array(apart), rebuilt)[0]).otherwise(text)


def redact(documents: DataFrame) -> DataFrame:
    """The documents with personal data replaced in ``text`` and ``n_chars``, if there, set to the new length.

    Rows whose text has no personal data are as they were, null texts included. The spans, without text, are joined to
    the documents that have any; all columns stay.
    """
    found = find_personal(documents).filter(F.size("spans") > 0)
    found = found.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("spans").alias("_spans")).dropDuplicates(
        [f"_{k}" for k in KEYS]
    )
    packed = documents.select(F.struct("*").alias("_row"))
    keyed = packed.withColumns(
        {"_k0": F.col("_row.doc_id").cast("bigint"), "_k1": F.xxhash64(_text()), "_k2": F.length(_text())}
    )
    same = [F.col(f"_k{i}").eqNullSafe(F.col(f"_{k}")) for i, k in enumerate(KEYS)]
    joined = keyed.join(found, same, "left")
    changed = redacted(_text(), F.col("_spans"))
    text = F.when(F.col("_spans").isNull(), F.col("_row.text").cast("string")).otherwise(changed)
    joined = joined.withColumn("_text", text)
    columns = []
    for name in documents.columns:
        column = F.col("_row")[name]
        if name == "text":
            column = F.col("_text")
        elif name == "n_chars":
            kind = documents.schema[name].dataType
            column = F.when(F.col("_spans").isNull(), column).otherwise(F.length("_text").cast(kind))
        columns.append(column.alias(name))
    return joined.select(*columns)


def _text() -> Column:
    return F.coalesce(F.col("_row.text").cast("string"), F.lit(""))
