"""Prefix trie of conversations by vertical bitmaps.

A conversation is a sequence of turns, and every distinct sequence of first turns is a node. Conversations are cut into
records of at most ``WINDOW`` turns, and records in the order of their ids into shards of a bounded number of turns.
Inside a shard every pair of place and turn has a bitset of the records that hold it. A depth-first walk intersects the
bitset of a node with these postings: the parts are its children, their bit counts the numbers of members, and the
members without a further turn its end list.

A node is known by a chained hash of its turns, so the parts that shards found of it are added up. What belongs to whole
subtrees is gathered by doubling: after k rounds a node holds the sums of all nodes less than 2^k below it, so there are
log2(depth) rounds, over the nodes of two or more conversations alone: below a node of one conversation lies one path.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import partitions_for
from panelwright.operators.ordering import row_ranks
from panelwright.storage import materialize

#: Turns of one record; a longer conversation has several, which different tasks may handle.
WINDOW = 512
#: Turns that a shard holds, besides its last record.
SHARD_TURNS = 32_768
#: Conversations whose ids share the quotient by this number share first turns.
FAMILY = 5
#: A conversation shares fewer than this many turns.
MOST_SHARED = 9
KEY_BYTES = 16
ROOT = bytes(KEY_BYTES)
_NOTHING = hashlib.sha256(b"").hexdigest()
_NODES = (
    "node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, turn_bytes bigint, first_end bigint, ends binary"
)


def turn_keys(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, bytes): slim rows, where ``key`` stands for role and text; null ones are empty.

    Rows without a conversation id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.unhex(F.sha2(whole, 256)), 1, KEY_BYTES)
    rows = conversations.where(F.col("conv_id").isNotNull())
    return rows.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), key.alias("key"), F.octet_length(text).cast("bigint").alias("bytes")
    )


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, key, bytes): the turns of every conversation as 1, 2, ...

    Turns are ordered by their number, null first; turns with equal numbers by their keys, and equal rows are all kept.
    Places come from a global order, so a conversation with most of the rows is spread over many tasks.
    """
    slim = materialize(turn_keys(conversations), "turns")
    ranked = materialize(row_ranks(slim, ["conv_id", "turn", "key"], "_rank"), "ranked-turns")
    first = ranked.groupBy("conv_id").agg(F.min("_rank").alias("_first"))
    return ranked.join(first, "conv_id").select("conv_id", (F.col("_rank") - F.col("_first") + 1).alias("place"), "key", "bytes")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first one of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns from the first conversation of its family.

    Returns the turns like ``numbered`` and one row (conv_id, n_turns) per conversation, also for those left without
    turns. A family has at most five conversations and shares at most eight turns, so a turn is copied at most five times.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    sizes = materialize(numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversation-sizes")
    member = F.struct("conv_id", shared_turns(F.col("conv_id")).alias("h"), "n")
    families = sizes.groupBy(base.alias("base")).agg(
        F.coalesce(F.max(F.when(F.col("conv_id") == base, F.col("n"))), F.lit(0)).alias("base_turns"),
        F.array_sort(F.collect_list(member)).alias("members"),
    )
    families = materialize(families, "families")
    kept = lambda m: F.least(m["h"], F.col("base_turns"))
    rest = lambda m: F.greatest(m["n"] - m["h"], F.lit(0))
    counts = families.select(F.inline(F.transform("members", lambda m: F.struct(
        m["conv_id"].alias("conv_id"), (kept(m) + rest(m)).cast("bigint").alias("n_turns")))))
    rows = numbered.withColumn("base", base).join(families, "base")
    place, conv = F.col("place"), F.col("conv_id")
    own = F.transform(F.filter("members", lambda m: (m["conv_id"] == conv) & (place > m["h"])), lambda m: F.struct(
        m["conv_id"].alias("conv_id"), (kept(m) + place - m["h"]).cast("bigint").alias("place")))
    lent = F.transform(F.filter("members", lambda m: (F.col("base") == conv) & (place <= m["h"])), lambda m: F.struct(
        m["conv_id"].alias("conv_id"), place.cast("bigint").alias("place")))
    turns = rows.select(F.explode(F.concat(own, lent)).alias("to"), "key", "bytes").select("to.*", "key", "bytes")
    return turns, counts


def _hash(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=KEY_BYTES).digest()


def _chain(keys: list[bytes]) -> bytes:
    """Hash of all turns of a record, as the walk reaches it one by one."""
    q = b""
    for key in keys:
        q = _hash(q, key)
    return q


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chained = [_chain(x) for x in batch.column("keys").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("window"), pa.array(chained, pa.binary())], names=["conv_id", "window", "chained"]
        )


def _starts(table: pa.Table) -> pa.Table:
    """Hash of everything before each record of one conversation; the rows are one per ``WINDOW`` turns."""
    table = table.sort_by("window")
    now, starts = ROOT, []
    for q in table.column("chained").to_pylist():
        starts.append(now)
        now = _hash(now, q)
    return pa.table({"conv_id": table.column("conv_id"), "window": table.column("window"), "start": pa.array(starts, pa.binary())})


def records(turns: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, conv_id, start, last, keys, bytes): at most ``window`` turns each, with the hash of all turns before.

    ``last`` says that the conversation ends in this record. Conversations without turns have one empty record.
    """
    cell = F.struct("place", "key", "bytes")
    number = F.floor((F.col("place") - 1) / window).cast("bigint")
    cut = turns.withColumn("window", number).groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    cut = cut.select("conv_id", "window", F.col("cells.key").alias("keys"), F.col("cells.bytes").alias("bytes"))
    idle = counts.where("n_turns = 0").select(
        "conv_id", F.lit(0).cast("bigint").alias("window"), F.array().cast("array<binary>").alias("keys"), F.array().cast("array<bigint>").alias("bytes")
    )
    cut = materialize(cut.unionByName(idle), "records")
    long = counts.where(F.col("n_turns") > window)
    chained = cut.join(long, "conv_id", "left_semi").mapInArrow(_window_hashes, "conv_id bigint, window bigint, chained binary")
    starts = chained.groupBy("conv_id").applyInArrow(_starts, "conv_id bigint, window bigint, start binary")
    last = F.col("window") == F.floor((F.greatest(F.col("n_turns"), F.lit(1)) - 1) / window)
    joined = cut.join(counts, "conv_id").join(starts, ["conv_id", "window"], "left")
    return joined.select("window", "conv_id", F.coalesce("start", F.lit(ROOT)).alias("start"), last.alias("last"), "keys", "bytes")


class Shard:
    """Vertical bitmaps of some records in ascending order of their conversations, and the walk over them."""

    def __init__(self, window: int):
        self.window = window
        self.rows: list[tuple] = []
        self.turns = 0

    def add(self, number: int, conv_id: int, start: bytes, last: bool, keys: list[bytes], sizes: list[int]) -> None:
        self.rows.append((number, conv_id, start, last, keys, sizes))
        self.turns += len(keys)

    def nodes(self) -> Iterator[tuple]:
        """One row per node that the records reach: node, parent, depth, smallest conversation, members, bytes, ends."""
        postings: dict[tuple[int, bytes], int] = defaultdict(int)
        tops: dict[tuple[int, bytes], int] = defaultdict(int)
        ending: dict[int, int] = defaultdict(int)
        for r, (number, _, start, last, keys, _) in enumerate(self.rows):
            bit = 1 << r
            tops[number, start] |= bit
            if last:
                ending[len(keys)] |= bit
            for place, key in enumerate(keys):
                postings[place, key] |= bit
        for (number, start), members in tops.items():
            at = number * self.window
            if number == 0:
                yield self._row(ROOT, None, 0, members, 0, members & ending[0])
            stack = [(members, 0, b"", start)]
            while stack:
                members, place, q, parent = stack.pop()
                left = members & ~ending[place]
                while left:
                    r = (left & -left).bit_length() - 1
                    keys, sizes = self.rows[r][4], self.rows[r][5]
                    if place >= len(keys):  # the conversation goes on in its next record
                        left ^= 1 << r
                        continue
                    child = left & postings[place, keys[place]]
                    left ^= child
                    chained = _hash(q, keys[place])
                    node = _hash(start, chained)
                    yield self._row(node, parent, at + place + 1, child, sizes[place], child & ending[place + 1])
                    stack.append((child, place + 1, chained, node))

    def _row(self, node: bytes, parent: bytes | None, depth: int, members: int, size: int, ends: int) -> tuple:
        first = self.rows[(members & -members).bit_length() - 1][1]
        ids = self._ids(ends)
        packed = np.array(ids, "<i8").tobytes() if ids else None
        return node, parent, depth, first, members.bit_count(), size, ids[0] if ids else None, packed

    def _ids(self, bits: int) -> list[int]:
        if not bits:
            return []
        if bits & (bits - 1) == 0:
            return [self.rows[bits.bit_length() - 1][1]]
        raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
        return [self.rows[r][1] for r in np.flatnonzero(np.unpackbits(raw, bitorder="little"))]


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def shard_nodes(cut: DataFrame, window: int = WINDOW, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """What every shard finds of every node; shards are runs of records with ascending conversation ids.

    ``ends`` holds the ids of the conversations of the shard that end at the node, as 64-bit integers in order.
    """
    schema = pa.schema([
        ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("turn_bytes", pa.int64()), ("first_end", pa.int64()), ("ends", pa.binary()),
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            shard = Shard(window)
            for batch in batches:
                columns = [batch.column(c) for c in ("window", "conv_id", "start", "last", "keys", "bytes")]
                for i in range(batch.num_rows):
                    shard.add(*(c[i].as_py() for c in columns))
                    if shard.turns >= shard_turns or len(shard.rows) >= shard_turns:
                        yield from shard.nodes()
                        shard = Shard(window)
            yield from shard.nodes()

        yield from _in_batches(rows(), schema)

    spark = cut.sparkSession
    stored = materialize(cut, "started-records")
    total = stored.agg(F.sum(F.size("keys") + 1)).first()[0] or 0
    ordered = stored.repartitionByRange(partitions_for(spark, total, 4 * shard_turns), "window", "conv_id")
    return ordered.sortWithinPartitions("window", "conv_id").mapInArrow(walk, _NODES)


def end_hashes(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end.

    The ids of a node are fed to the hash in ascending order as they arrive sorted, so memory is that of one part of one
    shard, also for a node at which most conversations end. The order of a hash's input cannot be split.
    """
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, state = None, None
            for batch in batches:
                nodes, ends = batch.column("node"), batch.column("ends")
                for i in range(batch.num_rows):
                    node, ids = nodes[i].as_py(), np.frombuffer(ends[i].as_py(), "<i8")
                    text = ",".join(map(str, ids.tolist())).encode()
                    if node != now:
                        if now is not None:
                            yield now, state.hexdigest()
                        now, state = node, hashlib.sha256(text)
                    else:
                        state.update(b"," + text)
            if now is not None:
                yield now, state.hexdigest()

        yield from _in_batches(rows(), schema)

    ended = parts.where(F.col("ends").isNotNull()).select("node", "first_end", "ends")
    return ended.repartition("node").sortWithinPartitions("node", "first_end").mapInArrow(digest, "node binary, ends_sha256 string")


def subtree_sums(tree: DataFrame, sums: list[str]) -> DataFrame:
    """(node, sums) over all nodes below and at each node of ``tree`` (node, parent, sums), by doubling.

    A round adds what the nodes 2^k below hold and moves every pointer to the ancestor twice as far. Sums are partial
    before they are shuffled, so a node with very many others below it is no burden.
    """
    now = materialize(tree.select("node", F.col("parent").alias("up"), *sums), "subtrees")
    while not now.where(F.col("up").isNotNull()).isEmpty():
        gained = now.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
        further = now.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        added = [(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in sums]
        moved = now.join(further, "up", "left").join(gained, "node", "left")
        now = materialize(moved.select("node", F.col("_up").alias("up"), *added), "subtrees")
    return now.drop("up")


def prefix_trie(conversations: DataFrame, window: int = WINDOW, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations.

    Input columns: conv_id, turn, role, text; others are ignored. Null roles and texts are empty, null turns come first,
    turns with equal numbers are ordered by content, repeated rows are turns of their own, and rows without a conversation
    id are left out. No conversations give no rows. Returns per node: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the keys ``node`` and ``parent``.
    """
    turns, counts = rebuilt_turns(numbered_turns(conversations))
    counts = materialize(counts, "rebuilt-sizes")
    parts = materialize(shard_nodes(records(turns, counts, window), window, shard_turns), "shard-nodes")
    found = parts.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.first("turn_bytes").alias("turn_bytes"),
    )
    found = materialize(found, "nodes")
    # What a node gets from its children: how many there are, and how many of them one conversation alone reaches.
    single = F.count(F.when(F.col("n_convs") == 1, 1))
    below = found.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), single.alias("_single")
    )
    wide = found.join(below, "node", "left").fillna(0, ["n_children", "_single"])
    above = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    wide = materialize(wide.join(above, "parent", "left"), "linked-nodes")
    leaves = F.col("_single") + (F.col("n_children") == 0).cast("bigint")
    saved = (F.col("n_convs") - 1) * F.col("turn_bytes")
    shared = wide.where("n_convs > 1").select("node", "parent", leaves.alias("n_leaves"), saved.alias("saved_tokens"))
    whole = wide.join(subtree_sums(shared, ["n_leaves", "saved_tokens"]), "node", "left").join(end_hashes(parts), "node", "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"), "node", "parent",
    )
