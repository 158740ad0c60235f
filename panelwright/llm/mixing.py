"""Mix sources to target weights by whole copies of documents: pivotal dependent rounding in a reduction tree.

A source that is to give ``target`` of its ``source_size`` words repeats every document target / source_size times on
average. The whole part is certain. The fractional parts are rounded against each other in pairs: one document gains
the words that the other loses until one of them is whole, and which one gains is drawn so that every document keeps
its expected number of copies. The words of a pair never change, so a source misses its target by less than one
document, and by far less after a few documents of fitting size have been turned over. Pairs are formed inside small random groups; the one document that a group leaves open moves to the next
level of the tree. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import WORD, text_of
from panelwright.storage import materialize

#: Rows that one task unfolds at a time from a group of equal rows.
_CHUNK = 1 << 16


def _keys(prefix: str = "") -> dict[str, Column]:
    words = F.size(F.regexp_extract_all(text_of(f"{prefix}text"), F.lit(WORD + "+"), F.lit(0)))  # possessive: never tried again
    return {
        "doc_id": F.col(f"{prefix}doc_id").cast("bigint"),
        "source": F.col(f"{prefix}source").cast("string"),
        "size": words.cast("bigint"),
    }


def with_size(documents: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of every document; a null text has none."""
    return documents.select(*[v.alias(k) for k, v in _keys().items()])


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0) -> DataFrame:
    """Words that each source is to give, from one row per source with its ``source_size``.

    Sources ordered by code point, null last, take the weights in turn and share all words. A target stops at ``most``
    times its source; what is cut is shared again by weight, which ends at target = min(cap, level x weight) with one
    level for all. The level follows from running sums over the sources sorted by cap / weight. These windows see one
    row per source. A source without words has target 0.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    by_cap = Window.orderBy("_full", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()

    def left(column: str) -> Column:
        return F.sum(column).over(everything) - F.coalesce(F.sum(column).over(by_cap), F.lit(0.0))

    shared = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(by_cap), F.lit(0.0))
    table = sizes.withColumns({"_weight": weight, "_cap": cap}).withColumn("_full", F.col("_cap") / F.col("_weight"))
    table = table.withColumn("_level", shared / left("_weight"))
    # Of the sources whose cap the level does not reach, the first by cap / weight has the right level. Sources that tie
    # there are told apart by their place in the order, not by their levels, which subtract the tied caps one by one.
    table = table.withColumn("_place", F.row_number().over(Window.orderBy("_full", F.col("source").asc_nulls_last())))
    fits = F.when(F.col("_full") >= F.col("_level"), F.struct("_place", "_level"))
    table = table.withColumn("_level", F.min(fits).over(everything)["_level"])
    target = F.least(F.col("_cap"), F.col("_level") * F.col("_weight"))
    return table.select("source", "source_size", F.coalesce(target, F.col("_cap"), F.lit(0.0)).alias("target"))


def _uniform(*keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) * F.lit(2.0**-53)


def _pivot(items: Column, seed: int) -> Column:
    """Round the items of an array against each other: the one left open, and the decided ones with their copies."""
    done_type = "array<struct<doc_id:bigint,size:bigint,copy:int>>"
    item_type = "struct<key:bigint,doc_id:bigint,size:bigint,p:double>"

    def decided(x: Column, copy: int) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), F.lit(copy).alias("copy"))

    def moved(x: Column, words: Column) -> Column:
        p = F.least(F.greatest(x["p"] + words / x["size"], F.lit(0.0)), F.lit(1.0))
        return F.struct(x["key"].alias("key"), x["doc_id"].alias("doc_id"), x["size"].alias("size"), p.alias("p"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["open"]
        a_has, a_lacks = a["p"] * a["size"], (1 - a["p"]) * a["size"]
        x_has, x_lacks = x["p"] * x["size"], (1 - x["p"]) * x["size"]
        up, down = F.least(a_lacks, x_has), F.least(a_has, x_lacks)
        gains = _uniform(F.lit(seed), a["key"], x["key"]) * (up + down) < down

        def state(still: Column, done: Column) -> Column:
            return F.struct(still.alias("open"), F.concat(acc["done"], F.array(done)).alias("done"))

        return (
            F.when(a.isNull(), F.struct(x.alias("open"), acc["done"].alias("done")))
            .when(gains & (a_lacks <= x_has), state(moved(x, -a_lacks), decided(a, 1)))
            .when(gains, state(moved(a, x_has), decided(x, 0)))
            .when(a_has <= x_lacks, state(moved(x, a_has), decided(a, 0)))
            .otherwise(state(moved(a, -x_lacks), decided(x, 1)))
        )

    start = F.struct(F.lit(None).cast(item_type).alias("open"), F.array().cast(done_type).alias("done"))
    return F.aggregate(items, start, step)


def dependent_rounding(open_units: DataFrame, seed: int = 0, group: int = 128) -> DataFrame:
    """Round the fractions ``p`` of rows (source, doc_id, size, p); one row with ``copy`` 0 or 1 for each.

    Groups hold about ``group`` rows of one source, dealt by a hash, so a source with most of the rows is spread over
    many tasks. Every level of the tree is stored; there are log_group(rows of the largest source) levels. The last
    open row of a source is rounded to the nearest copy.
    """
    counts = open_units.groupBy("source").agg(F.count(F.lit(1)).alias("_rows"))
    groups = F.ceil(F.col("_rows") / group)
    level = open_units.join(counts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    level = level.select("source", "doc_id", "size", "p", groups.alias("_groups"))
    most = (counts.agg(F.max("_rows")).first()[0] or 0) + group - 1
    most //= group
    decided = None
    depth = 0
    while True:
        key = F.xxhash64(F.lit(seed), F.lit(depth), "doc_id", "size", "source")
        keyed = level.withColumn("_key", key).withColumn("_bucket", F.pmod(F.shiftright("_key", 20), F.col("_groups")))
        item = F.struct(F.col("_key").alias("key"), "doc_id", "size", "p")
        grouped = keyed.groupBy("source", "_groups", "_bucket").agg(F.array_sort(F.collect_list(item)).alias("_items"))
        rounded = grouped.select("source", "_groups", _pivot(F.col("_items"), seed).alias("_r"))
        stored = materialize(rounded.select("source", "_groups", "_r.open", "_r.done"), f"rounding-{depth}")
        rows = stored.select("source", F.explode("done").alias("d")).select("source", "d.*")
        decided = rows if decided is None else decided.unionByName(rows)
        if most <= 1:
            last = stored.select("source", "open.doc_id", "open.size", (F.col("open.p") >= 0.5).cast("int").alias("copy"))
            return decided.unionByName(last)
        level = stored.select("source", "open.*", F.ceil(F.col("_groups") / group).alias("_groups")).drop("key")
        most = -(-most // group)
        depth += 1


def settle(rounded: DataFrame, open_units: DataFrame, rounds: int = 3) -> DataFrame:
    """Bring every source nearer to its words by turning over at most one document per round.

    The tree leaves a source off by a part of one document. A round takes, per source, the document whose size is
    closest to what is missing (or too much) and turns its copy over if that helps.
    """
    wanted = open_units.groupBy("source").agg(F.sum(F.col("p") * F.col("size")).alias("_wanted"))
    wanted = wanted.withColumnRenamed("source", "_s")
    keys = ["source", "doc_id", "size"]
    now = rounded
    for turn in range(rounds):
        taken = now.groupBy("source").agg(F.sum(F.col("copy") * F.col("size")).alias("_taken"))
        off = taken.join(wanted, F.col("source").eqNullSafe(F.col("_s")))
        off = off.select("_s", (F.col("_wanted") - F.col("_taken")).alias("_off"))
        usable = now.join(off, F.col("source").eqNullSafe(F.col("_s")))
        usable = usable.filter("(_off > 0 AND copy = 0) OR (_off < 0 AND copy = 1)")
        usable = usable.withColumn("_left", F.abs(F.col("size") - F.abs("_off"))).filter("_left < abs(_off)")
        closest = F.min(F.struct("_left", F.xxhash64(*keys).alias("h"), "doc_id", "size")).alias("c")
        turned = usable.groupBy("source").agg(closest).select(
            F.col("source").alias("_source"), F.col("c.doc_id").alias("_doc_id"), F.col("c.size").alias("_size")
        )
        turned = materialize(turned, f"settle-{turn}")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        copy = F.when(F.col("_size").isNull(), F.col("copy")).otherwise(1 - F.col("copy"))
        now = now.join(turned, same, "left").select(*keys, copy.alias("copy"))
    return now


def mix(documents: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, seed: int = 0) -> DataFrame:
    """Copies of every document so that the sources reach their targets.

    Returns one row per document: doc_id, source, size, source_size, target, copies and taken = copies x size. Documents
    without words (null or empty text) have size 0, one copy and taken 0. A null source is a source of its own, ordered last.
    Equal rows (same id, source and size) are counted first and rounded together, so a row that repeats very often is
    neither gathered in one group nor unfolded by one array. Results depend on the rows and the seed alone.
    """
    keys = ["doc_id", "source", "size"]
    units = materialize(with_size(documents).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "_s")
    joined = units.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(share + 1e-12)
    joined = joined.withColumns({"_whole": whole, "_p": F.greatest(share - whole, F.lit(0.0))})
    mass = F.col("_n") * F.when(F.col("_p") > 1e-12, F.col("_p")).otherwise(F.lit(0.0))
    # Of equal rows, floor(n p) take one copy more; a single one keeps the fraction that remains.
    joined = joined.withColumns({"_more": F.floor(mass), "_rest": mass - F.floor(mass)})
    planned = materialize(joined.drop("_p"), "mix-planned")
    still = planned.filter("size > 0 AND _rest > 0").select("source", "doc_id", "size", F.col("_rest").alias("p"))
    copies = settle(materialize(dependent_rounding(still, seed), "rounded"), still)
    copies = copies.select(*[F.col(k).alias(f"_{k}") for k in keys], "copy")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    placed = planned.join(copies, same, "left").drop(*[f"_{k}" for k in keys])
    placed = placed.withColumn("_more", F.col("_more") + F.coalesce(F.col("copy"), F.lit(0)))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _CHUNK)))
    chunks = placed.select("*", chunk.alias("_chunk"))
    first = F.col("_chunk") * _CHUNK
    turn = F.explode(F.sequence(first + 1, F.least(first + _CHUNK, F.col("_n"))))
    rows = chunks.select("*", turn.alias("_turn"))
    taken = F.col("_whole") + F.when(F.col("_turn") <= F.col("_more"), 1).otherwise(0)
    taken = F.when(F.col("size") > 0, taken).otherwise(F.lit(1))
    rows = rows.withColumn("copies", taken.cast("bigint"))
    return rows.select(*keys, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat_documents(documents: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, seed: int = 0) -> DataFrame:
    """The documents of the mix: each as often as ``mix`` says, with all its columns.

    Documents that the mix does not take are left out; documents without words stay once. Equal rows are numbered, so
    that together they give the copies that were decided for them.
    """
    keys = ["doc_id", "source", "size"]
    counted = mix(documents, weights, most, seed).groupBy(*keys).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")
    )
    counted = counted.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "_copies", "_rows")
    packed = documents.select(F.struct("*").alias("_row"))
    packed = packed.withColumns({f"_k_{k}": v for k, v in _keys("_row.").items()})
    same = [F.col(f"_k_{k}").eqNullSafe(F.col(f"_m_{k}")) for k in keys]
    joined = packed.join(counted, same).filter("_copies > 0")
    equal = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy(F.xxhash64("_row.text"))
    turn = F.row_number().over(equal)
    own = F.floor(F.col("_copies") / F.col("_rows")) + F.when(turn <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    placed = joined.select("_row", own.alias("_own")).filter("_own > 0")
    return placed.select("_row", F.explode(F.sequence(F.lit(1), F.col("_own").cast("int"))).alias("_copy")).select("_row.*")
