"""Repeated passages across documents, by content-defined chunking with a gear rolling hash.

The gear hash of the last 16 bytes decides on boundaries, so they move with the text: an insertion changes the chunks
around it and no others. A chunk starts at a strong boundary (one in ``strong`` bytes on average) and ends at the first
weak boundary (one in ``weak``) at least ``least`` bytes later and not before the next chunk starts, so chunks vary in
size, overlap and cover the text, and a passage of twice that size almost surely holds a whole one. Runs of words are
chunks as well: of every 26 runs of 26 words in a row the one with the smallest hash, so any passage of 51 words holds
a whole one, whatever its bytes. A text of fewer than ``least`` bytes is one chunk. A chunk whose digest occurs in two
places is a repeat; overlapping repeats of a document are joined to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import mix64, text_of
from panelwright.llm.tokens import in_slices

CHUNKS = "doc_id bigint, start int, end int, digest bigint, more int, again boolean"
_WINDOW = 16
#: Longest stretch without a boundary; beyond it one is set, counted from the last.
_MOST = 512
#: Words of a run, and runs among which one is chosen; a passage of ``2 * _RUN - 1`` words holds a chosen run.
_RUN = 26
#: A number for every byte at every place of a word; places beyond the last count like it.
_PLACES = mix64(np.arange(1, 64 * 256 + 1, dtype=np.uint64)).reshape(64, 256)
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum of the gears of the last 16 live bytes, each shifted by its distance."""
    h = np.where(live, _GEAR[data], np.uint16(0))
    step = 1
    while step < _WINDOW:
        h[step:] += h[:-step] << np.uint16(step)
        step *= 2
    return h


def _boundaries(small: np.ndarray, can: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions with a small hash where a boundary can be; stretches longer than ``_MOST`` inside a text are cut."""
    found = np.flatnonzero(small & can)
    marks = np.sort(np.concatenate([found, starts, ends]))
    gaps = np.diff(marks)
    wide = gaps > _MOST
    if wide.any():
        forced = [np.arange(m + _MOST, m + g, _MOST) for m, g in zip(marks[:-1][wide], gaps[wide], strict=True)]
        chars = np.flatnonzero(can | np.isin(np.arange(len(can)), starts))
        forced = chars[np.searchsorted(chars, np.concatenate(forced), side="right") - 1]
        found = np.unique(np.concatenate([found, forced]))
    return found


def chunks(texts: list[bytes], least: int, strong: int, weak: int) -> tuple[np.ndarray, ...]:
    """Chunks of many texts: text number, start and end in bytes, start and end in characters.

    A text's start counts as a strong boundary and its end as a weak one, and one more chunk reaches from the last weak
    boundary far enough before the end to the end; a text of fewer than ``least`` bytes has no chunk. Texts lie in one buffer with a gap of dead bytes after each, longer than the hash looks back, so every text is
    cut as it would be alone.
    """
    gap = bytes(_WINDOW)
    raw = np.frombuffer(b"".join(x for text in texts for x in (text, gap)), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + _WINDOW) - sizes - _WINDOW
    ends = starts + sizes
    edge = np.zeros(len(raw) + 1, np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    live = np.cumsum(edge[:-1], dtype=np.int8) > 0
    char = live & ((raw & 0xC0) != 0x80)
    before = np.concatenate([[0], np.cumsum(char)])
    h = gear(raw, live)
    # The hash that decides on a position is that of the byte before it; a run of one byte decides on none.
    can = char.copy()
    can[starts[sizes > 0]] = False
    can[:2] = False
    can[2:] &= h[1:-1] != h[:-2]
    hashed = np.concatenate([[np.uint16(65535)], h[:-1]])
    weaks = _boundaries(hashed < 65536 // weak, can, starts, ends)
    stops = np.unique(np.concatenate([weaks, ends]))
    opens = np.unique(np.concatenate([weaks, starts]))
    last = opens[np.searchsorted(opens, (ends - least)[sizes >= least], side="right") - 1]
    begins = np.unique(np.concatenate([_boundaries(hashed < 65536 // strong, can, starts, ends), starts, last]))
    owner = np.searchsorted(starts, begins, side="right") - 1
    long = begins + least <= ends[owner]
    begins, owner = begins[long], owner[long]
    following = np.zeros_like(begins)  # the next chunk of the same text, 0 for the last one
    following[:-1] = np.where(owner[1:] == owner[:-1], begins[1:], 0)
    stops = stops[np.searchsorted(stops, np.maximum(begins + least, following))]
    stops[following == 0] = ends[owner[following == 0]]
    first = starts[owner]
    return owner, begins - first, stops - first, before[begins] - before[first], before[stops] - before[first]


def word_chunks(texts: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """Runs of words and short texts, like ``chunks``.

    The first and the last run of a text are chunks too, so that runs cover the words of a text of at least ``_RUN``. A
    text with words and fewer than ``least`` bytes is a chunk. Which run is chosen depends on its words alone.
    """
    raw = np.frombuffer(b"".join(x for text in texts for x in (text, b" ")), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    black = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(np.concatenate([[False], black]).astype(np.int8))
    opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(first, opens, side="right") - 1
    words = np.bincount(owner, minlength=len(texts))
    begin, stop = [first[(sizes < least) & (words > 0)]], [(first + sizes)[(sizes < least) & (words > 0)]]
    if len(opens) >= _RUN:
        place = np.arange(len(raw))
        place[opens[0] :] -= np.repeat(opens, np.diff(np.append(opens, len(raw))))
        named = np.where(black, _PLACES[np.minimum(place, 63), raw], np.uint64(0))
        word = np.add.reduceat(named, opens)
        last = len(opens) - _RUN
        hashed = np.zeros(last + 1, np.uint64)
        for i in range(4):
            hashed = mix64(hashed + word[i : i + last + 1])
        whole = np.flatnonzero(owner[: last + 1] == owner[_RUN - 1 :])
        hashed, own = hashed[whole], owner[whole]
        chosen = np.empty(0, np.int64)
        if len(whole) >= _RUN:
            smallest = np.arange(len(whole) - _RUN + 1)
            smallest = smallest + np.lib.stride_tricks.sliding_window_view(hashed, _RUN).argmin(axis=1)
            chosen = np.unique(smallest[own[: len(smallest)] == own[_RUN - 1 :]])
        edges = np.flatnonzero(np.diff(np.concatenate([[-1], own, [-1]])))
        ends = np.concatenate([edges[:-1], edges[1:] - 1]) if len(whole) else np.empty(0, np.int64)
        runs = whole[np.unique(np.concatenate([chosen, ends]))]
        begin.append(opens[runs])
        stop.append(closes[runs + _RUN - 1])
    begins, stops = np.concatenate(begin), np.concatenate(stop)
    owner = np.searchsorted(first, begins, side="right") - 1
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    at = first[owner]
    return owner, begins - at, stops - at, before[begins] - before[at], before[stops] - before[at]


def all_chunks(texts: list[bytes], least: int, strong: int, weak: int) -> tuple[np.ndarray, ...]:
    """The chunks of ``chunks`` and ``word_chunks`` in the order of their places, each place once."""
    found = [np.concatenate(x) for x in zip(chunks(texts, least, strong, weak), word_chunks(texts, least), strict=True)]
    order = np.lexsort(found[2::-1])
    found = [x[order] for x in found]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0) | (np.diff(found[2]) != 0)
    return tuple(x[new] for x in found)


def chunk_documents(documents: DataFrame, least: int = 96, strong: int = 32, weak: int = 8) -> DataFrame:
    """Chunks of every whole text: doc_id, start and end in characters, and 95 bits of digest (digest, more).

    ``again`` marks a chunk that the same text holds before.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_intdigest
        low, high = (1 << 64) - 1, (1 << 31) - 1
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in in_slices(texts):
                data = [t.encode("utf-8", "surrogatepass") for t in texts[lo:hi]]
                owner, begins, stops, start, end = all_chunks(data, least, strong, weak)
                rows = [digest(data[o][b:e]) for o, b, e in zip(owner.tolist(), begins.tolist(), stops.tolist(), strict=True)]
                seen: set[tuple[int, int]] = set()
                again = []
                for key in zip(owner.tolist(), rows, strict=True):
                    again.append(key in seen)
                    seen.add(key)
                columns = [
                    ids.slice(lo, hi - lo).take(pa.array(owner)),
                    pa.array(start.astype(np.int32)),
                    pa.array(end.astype(np.int32)),
                    pa.array(np.array([r & low for r in rows], np.uint64).view(np.int64)),
                    pa.array(np.array([(r >> 64) & high for r in rows], np.int32)),
                    pa.array(again, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "end", "digest", "more", "again"])

    slim = documents.select(F.col("doc_id").cast("bigint"), text_of())
    return slim.mapInArrow(cut, CHUNKS)


def repeated_chunks(chunked: DataFrame) -> DataFrame:
    """Chunks that occur earlier: doc_id, start, end and the smallest document that holds them, first_doc_id.

    A chunk is kept in its smallest document (null counts as the largest) at its first place there, and returned
    everywhere else. Rows that share an id count as one document.
    """
    docs = chunked.groupBy("digest", "more").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.bool_or("again").alias("twice"),
        F.bool_or(F.col("doc_id").isNull()).alias("unnamed"),
    )
    several = docs.filter("first <> last OR twice OR (unnamed AND first IS NOT NULL)").select("digest", "more", "first")
    joined = chunked.join(several, ["digest", "more"]).filter("again OR NOT (doc_id <=> first)")
    return joined.select("doc_id", "start", "end", F.col("first").alias("first_doc_id"))


def repeated_passages(documents: DataFrame, least: int = 96, strong: int = 32, weak: int = 8) -> DataFrame:
    """Passages that an earlier document (or place) holds as well: doc_id, start, end, first_doc_id, n_chunks.

    Positions are characters of the whole text, the end exclusive. Overlapping and touching repeats of a document are
    one passage; ``first_doc_id`` is the smallest document that holds one of its chunks first. Null texts and texts
    below ``least`` bytes without words have none.
    """
    repeats = repeated_chunks(chunk_documents(documents, least, strong, weak))
    return join_spans(repeats)


def join_spans(repeats: DataFrame) -> DataFrame:
    """Join overlapping and touching spans of each document."""
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    numbered = repeats.withColumn("_opens", opens).withColumn("_span", F.sum("_opens").over(order))
    return numbered.groupBy("doc_id", "_span").agg(
        F.min("start").cast("bigint").alias("start"),
        F.max("end").cast("bigint").alias("end"),
        F.min("first_doc_id").alias("first_doc_id"),
        F.count(F.lit(1)).alias("n_chunks"),
    ).drop("_span")


def without_repeats(documents: DataFrame, least: int = 96) -> DataFrame:
    """The documents with repeated passages cut out of ``text``; all columns stay, null texts stay null.

    ``doc_id`` should tell texts apart: rows that share one lose each other's passages.
    """
    spans = repeated_passages(documents, least).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    spans = spans.withColumnRenamed("doc_id", "_id")
    packed = documents.select(F.struct("*").alias("_row"))
    joined = packed.join(spans, F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_id")), "left")
    text, kept = F.col("_row.text").cast("string"), F.col("_spans")

    def piece(s: Column, i: Column) -> Column:
        at = F.when(i > 0, F.get(kept, i - 1)["end"]).otherwise(F.lit(0))
        return F.substring(text, (at + 1).cast("int"), (s["start"] - at).cast("int"))

    rest = F.substring(text, (F.element_at(kept, -1)["end"] + 1).cast("int"), F.length(text))
    cut = F.when(kept.isNull(), text).otherwise(F.concat(F.array_join(F.transform(kept, piece), ""), rest))
    joined = joined.withColumn("_text", cut)
    return joined.select(*[(F.col("_text") if c == "text" else F.col("_row")[c]).alias(c) for c in documents.columns])
