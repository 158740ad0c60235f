"""Shortest-pack-first packing over the histogram of piece lengths.

The plan needs only the histogram, which has one entry per length up to the capacity, whatever the size of the corpus.
Lengths are placed longest first; each goes into the open packing pattern with the most room, and whole counts of equal
packs are moved at once. Where no pattern has room, packs are opened and filled with pieces of the length one after the
other. A length splits at most one pattern or opens at most two, so there are at most two patterns per length.
Pieces then find their place by their rank among the pieces of the same length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import text_of
from panelwright.llm.tokens import crc, encoder, in_slices
from panelwright.storage import materialize

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
#: More pieces of one length than any corpus has.
_RANKS = 1 << 48


@dataclass
class Plan:
    """Where the pieces of every length go: intervals of ranks, each belonging to one pattern.

    Intervals are sorted by ``key``, the length and the first rank in one number. Interval i starts at rank ``rank[i]``
    and puts ``times[i]`` pieces side by side from ``offset[i]`` on, into sequences counted from ``sequence[i]``.
    """

    key: np.ndarray
    rank: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    sequence: np.ndarray
    sequences: int


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(count, {length: times}) of all packs, by shortest-pack-first over the histogram."""
    rooms: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]  # by room left: (count, lengths placed)
    for length in sorted(histogram, reverse=True):
        waiting, room = histogram[length], capacity
        while waiting:
            while room >= length and not rooms[room]:
                room -= 1
            if room < length:
                fit = capacity // length
                for count, times in ((waiting // fit, fit), (1, waiting % fit)):
                    if count and times:
                        placed = None
                        for _ in range(times):
                            placed = (length, placed)
                        rooms[capacity - times * length].append((count, placed))
                break
            count, placed = rooms[room].pop()
            moved = min(count, waiting)
            if count > moved:
                rooms[room].append((count - moved, placed))
            rooms[room - length].append((moved, (length, placed)))
            waiting -= moved
    packs = []
    for entries in rooms:
        for count, placed in entries:
            times: dict[int, int] = {}
            while placed is not None:
                length, placed = placed
                times[length] = times.get(length, 0) + 1
            packs.append((count, times))
    return packs


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Give every rank of every length a sequence and an offset."""
    rows: list[tuple[int, int, int, int, int]] = []  # length, times, offset, sequence, pieces
    sequence = 0
    for count, times in patterns(histogram, capacity):
        offset = 0
        for length in sorted(times, reverse=True):
            rows.append((length, times[length], offset, sequence, times[length] * count))
            offset += length * times[length]
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    starts = np.cumsum(table[:, 4]) - table[:, 4]
    if len(starts):
        starts = starts - starts[np.searchsorted(table[:, 0], table[:, 0])]  # ranks begin anew for every length
    return Plan(table[:, 0] * _RANKS + starts, starts, table[:, 1], table[:, 2], table[:, 3], sequence)


def token_pieces(documents: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """Tokenize whole texts, append ``end_id``, and cut every document into pieces of at most ``capacity`` ids.

    A null text is the empty text and gives one piece with the end id alone. Rows with a null or repeated ``doc_id``
    are cut like any other. Only the sizes and checksums of pieces are kept, not the ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for lo, hi in in_slices(texts):
                for doc_id, ids in zip(ids_of[lo:hi], tokens.encode(texts[lo:hi]), strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        out.append((doc_id, start, len(piece), crc(piece), len(ids)))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    slim = documents.select(F.col("doc_id").cast("bigint"), text_of())
    return slim.mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int, rows_per_salt: int = 200_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces``, which are read three times and so should be a stored table.

    ``length`` must lie between 1 and ``capacity``; the other columns are carried along. Ranks inside a length are
    counted in salted parts of about ``rows_per_salt`` rows, so that a length shared by most pieces (full ones) is
    ranked by many tasks. Equal rows share their places in any order. No pieces give no rows.
    """
    spark = pieces.sparkSession
    keys = ["length", "_salt"]
    order = [c for c in pieces.columns if c != "length"]
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = {k: -(-n // rows_per_salt) for k, n in histogram.items() if n > rows_per_salt}
    parts = F.lit(1)
    if salts:
        by_length = F.create_map(*[F.lit(int(x)) for pair in salts.items() for x in pair])
        parts = F.coalesce(F.element_at(by_length, F.col("length").cast("int")), F.lit(1))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), parts))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = salted.withColumn("_inside", inside).join(starts, keys)
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_inside") - 1).cast("bigint").alias("_rank"))
    placed = spark.sparkContext.broadcast(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = placed.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(where.key, length * _RANKS + rank, side="right") - 1
            turn = rank - where.rank[at]
            sequence = where.sequence[at] + turn // where.times[at]
            offset = where.offset[at] + turn % where.times[at] * length
            kept = [batch.column(c) for c in batch.schema.names if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            places = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([*kept, *places.values()], names=[*names, *places])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece with its place."""
    return pack(materialize(token_pieces(documents, vocabulary, capacity, end_id), "pieces"), capacity)
