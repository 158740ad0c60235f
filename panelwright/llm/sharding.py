"""Balanced label propagation: documents that belong together meet in one shard, and all shards stay equally large.

Linked documents start in shards dealt by a hash. In every round a document looks at the shards of the documents that
it is linked with, through the hubs they share, and asks for the shard that holds most of them, if that is more than its
own holds. Of what is asked for, quotas admit what keeps every shard within its capacity, counting what leaves it, and
documents with the most to gain go first. Links are never expanded into pairs: a hub counts its members by shard, and
its members join these counts. Ties go the same way for all members of a hub, so that a group which is split evenly
still agrees on a shard, and a move always joins more documents than it parts.

At the end unlinked documents fill the room that is left, and the documents in the order of their shards are cut into
equal parts. Small unlinked documents stand at both ends of every shard's run, so that the cuts shift hardly anything
else. Only DataFrame operations are used; the driver sees sums by pair of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import text_of
from panelwright.operators.ordering import row_ranks, running_totals
from panelwright.storage import materialize

#: Ties between shards are broken by so many bits of a hash.
_TIE = 1 << 20


def with_nodes(documents: DataFrame) -> DataFrame:
    """(node, doc_id, size, text_crc32, digest): documents numbered in the order of their texts' digests and ids.

    A null text is the empty text. Equal rows are told apart by their numbers alone.
    """
    text = text_of()
    slim = documents.select(
        F.col("doc_id").cast("bigint"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    return row_ranks(materialize(slim, "sizes"), ["digest", "doc_id"], "node")


def equal_texts(nodes: DataFrame) -> DataFrame:
    """(node, hub): documents whose text others hold as well; the hub is the first node with that text."""
    groups = nodes.groupBy("digest").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return nodes.select("node", "digest").join(groups, "digest").select("node", "hub")


def _votes(links: DataFrame, labels: DataFrame, shards: int) -> DataFrame:
    """(node, hub, votes): how many members the hubs of a node have in every shard, the node itself included."""
    placed = links.join(labels.select("node", "label"), "node")
    here = [F.count(F.when(F.col("label") == s, 1)).alias(f"_{s}") for s in range(shards)]
    tally = placed.groupBy("hub").agg(*here)
    sums = [F.sum(f"_{s}").alias(f"_{s}") for s in range(shards)]
    seen = links.join(tally, "hub").groupBy("node").agg(F.min("hub").alias("hub"), *sums)
    return seen.select("node", "hub", F.array(*[f"_{s}" for s in range(shards)]).alias("votes"))


def _wishes(links: DataFrame, labels: DataFrame, shards: int, opened: list[bool]) -> DataFrame:
    """(node, size, hub, label, to, gain): nodes that would rather be in another, open shard.

    Among shards with equally many neighbours an open one is better, as the neighbours can follow there.
    """
    may = F.array(*[F.lit(o) for o in opened])
    tie = lambda s: F.pmod(F.xxhash64("hub", s.cast("bigint")), F.lit(_TIE))
    score = F.transform("votes", lambda v, s: (2 * v + F.element_at(may, s + 1).cast("int")) * _TIE + tie(s))
    known = _votes(links, labels, shards).join(labels, "node").withColumn("score", score)
    own = F.element_at("score", F.col("label") + 1)
    better = F.filter(
        F.transform("score", lambda x, s: F.struct(x.alias("score"), s.alias("to"))),
        lambda x: (x["score"] > own) & F.element_at(may, x["to"] + 1),
    )
    best = F.array_max(better)
    wished = known.withColumn("best", best).where("best IS NOT NULL")
    gain = F.element_at("votes", F.col("best.to") + 1) - F.element_at("votes", F.col("label") + 1)
    return wished.select("node", "size", "hub", "label", F.col("best.to").cast("int").alias("to"), gain.alias("gain"))


def admitted(asked: dict[tuple[int, int], int], load: list[int], capacity: float) -> dict[tuple[int, int], float]:
    """How much of what is asked for, by pair of shards, keeps every shard within ``capacity``.

    What enters a full shard must be matched by what leaves it. Starting from everything, the moves into a shard that would be too full
    are scaled down until none is; scaling only ever lowers a flow, so this ends.
    """
    flow = {pair: float(size) for pair, size in asked.items()}
    for _ in range(1000):
        changed = False
        for shard in range(len(load)):
            into = sum(v for (_, to), v in flow.items() if to == shard)
            out = sum(v for (label, _), v in flow.items() if label == shard)
            room = max(capacity - load[shard] + out, 0.0)
            if into > room * (1 + 1e-9):
                changed = True
                flow = {(a, b): v * room / into if b == shard else v for (a, b), v in flow.items()}
        if not changed:
            break
    return flow


def _granted(wishes: DataFrame, flow: dict[tuple[int, int], float], asked: dict[tuple[int, int], int]) -> DataFrame:
    """The wishes that fit into the flows: those with the most to gain first, whole hubs before parts of others."""
    full = {pair for pair, size in asked.items() if flow[pair] < size}
    pair = F.struct(F.col("label").cast("int").alias("a"), F.col("to").alias("b"))
    tight = F.lit(False)
    for a, b in sorted(full):
        tight = tight | ((F.col("label") == a) & (F.col("to") == b))
    easy = wishes.where(~tight).select("node", "to")
    if not full:
        return easy
    ordered = wishes.where(tight).select("node", "to", "size", "label", "hub", (-F.col("gain")).alias("_less"))
    running = running_totals(ordered, ["label", "to", "_less", "hub", "node"], {"_upto": "size"})
    before, limit = 0, F.lit(None).cast("double")
    for a, b in sorted(full):
        limit = F.when((F.col("label") == a) & (F.col("to") == b), F.lit(before + flow[a, b])).otherwise(limit)
        before += asked[a, b]
    return easy.unionByName(running.where(F.col("_upto") <= limit).select("node", "to"))


def _by_shard(labels: DataFrame, shards: int) -> list[int]:
    load = [0] * shards
    for row in labels.groupBy("label").agg(F.sum("size").alias("size")).collect():
        load[row["label"]] = row["size"]
    return load


def propagate(nodes: DataFrame, links: DataFrame, capacity: float, shards: int = 8, rounds: int = 30) -> DataFrame:
    """(node, size, label) of the linked nodes after label propagation under quotas.

    ``nodes`` has node and size, ``links`` has node and hub; a node may have several hubs, and two nodes are linked once
    for every hub that they share. A shard that could admit nothing of what it was asked for is not asked again until it
    has more room. Rounds end when no node wants to move to a shard that may be asked, or after ``rounds``.
    """
    links = materialize(links.distinct(), "links")
    linked = nodes.join(links.select("node").distinct(), "node").select("node", "size")
    start = F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")
    labels = materialize(linked.withColumn("label", start), "labels")
    closed: dict[int, float] = {}
    for _ in range(rounds):
        load = _by_shard(labels, shards)
        rooms = [capacity - x for x in load]
        opened = [s not in closed or rooms[s] > closed[s] for s in range(shards)]
        wishes = materialize(_wishes(links, labels, shards, opened), "wishes")
        asked = {(r["label"], r["to"]): r["size"] for r in wishes.groupBy("label", "to").agg(F.sum("size").alias("size")).collect()}
        if not asked:
            break
        granted = _granted(wishes, admitted(asked, load, capacity), asked)
        moved = materialize(granted, "moves")
        served = {r["to"] for r in moved.select("to").distinct().collect()}
        closed |= {b: rooms[b] for _, b in asked if b not in served}
        if served:
            labels = labels.join(moved, "node", "left").select("node", "size", F.coalesce("to", "label").alias("label"))
            labels = materialize(labels, "labels")
    return labels


def _fill(load: list[int], capacity: float) -> Column:
    """Shard of an unlinked node, by a hash: shards get shares in proportion to the room that is left in them."""
    free = [max(capacity - x, 0.0) for x in load]
    total = sum(free) or 1.0
    edges, upto = [], 0.0
    for x in free[:-1]:
        upto += x / total
        edges.append(F.lit(upto))
    drawn = F.pmod(F.xxhash64("node"), F.lit(1 << 32)) / float(1 << 32)
    return F.size(F.filter(F.array(*edges), lambda e: e <= drawn)) if edges else F.lit(0)


def shard_documents(documents: DataFrame, shards: int = 8, law: str = "bytes", links: DataFrame | None = None, slack: float = 0.05) -> DataFrame:
    """Shard and place of every document; documents with equal texts are linked.

    Input columns: doc_id, text; others are ignored. A null text is empty; its size is 1, that of any text its UTF-8
    bytes and 1. Rows with null or equal ids are documents of their own. ``links`` (node, hub) may link the rows of
    ``with_nodes`` differently. ``law`` says what the shards hold equally much of: ``bytes`` (to about one document) or
    ``rows`` (to one row). ``slack`` is the part by which a shard may exceed its share before the final cut, which gives
    moves room where all documents are linked. A group that exceeds a shard fills several. No documents give no rows. Returns doc_id, size, text_crc32, law, shard, slot
    (0, 1, ... inside a shard) and grown_shard, which is null.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law {law}")
    nodes = materialize(with_nodes(documents).withColumn("weight", F.col("size") if law == "bytes" else F.lit(1).cast("bigint")), "nodes")
    total = nodes.agg(F.sum("weight")).first()[0] or 0
    links = equal_texts(nodes) if links is None else links
    weighed = nodes.select("node", F.col("weight").alias("size"))
    labels = propagate(weighed, links, total / shards * (1 + slack), shards)
    first = links.groupBy("node").agg(F.min("hub").alias("hub"))
    load = _by_shard(labels, shards)
    known = nodes.drop("digest").join(labels.select("node", "label").join(first, "node"), "node", "left")
    # In a shard's run: small unlinked documents, large ones, linked ones, large and small unlinked ones.
    free = F.col("label").isNull()
    end = F.when(F.pmod(F.xxhash64("node", F.lit("end")), F.lit(2)) == 0, -1).otherwise(1)
    part = F.when(free, end).otherwise(0)
    placed = known.withColumns({"_part": part, "_label": F.coalesce("label", _fill(load, total / shards)), "_hub": F.coalesce("hub", F.lit(0))})
    placed = placed.withColumn("_by_size", -F.col("_part") * F.col("weight")).drop("label", "hub")
    order = ["_label", "_part", "_by_size", "_hub", "node"]
    run = running_totals(materialize(placed, "placed"), order, {"_upto": "weight", "_rank": F.lit(1)})
    shard = F.expr(f"int((2 * _upto - weight) * {shards} div {2 * max(total, 1)})")  # of the document's middle
    run = materialize(run.select("doc_id", "size", "text_crc32", "_rank", shard.alias("shard")), "cut")
    starts = F.broadcast(run.groupBy("shard").agg(F.min("_rank").alias("_first")))  # one row per shard
    return run.join(starts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("_rank") - F.col("_first")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
