"""SimHash fingerprints of whole texts and the search for all fingerprints within a Hamming radius.

A text's terms are its five-word shingles (all its words as one term when there are fewer), weighted by how often they
occur. Every term's 64-bit hash votes with its weight for or against each bit of the fingerprint.

The search cuts fingerprints into blocks. Two of them that differ in at most ``radius`` bits agree in at least
``blocks - radius`` blocks, so one table per choice of that many blocks, keyed by their bits, finds every pair. Of all
tables that hold a pair, only that of its first equal blocks reports it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import partitions_for, text_of, window_hashes, word_hashes
from panelwright.llm.tokens import in_slices
from panelwright.storage import materialize

BITS = 64
SHINGLE = 5
ROWS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint bigint, edited_fingerprint bigint, "
    "next_fingerprint bigint, part int, first boolean, last boolean, text string"
)


def fingerprints(texts: list[str]) -> np.ndarray:
    """64-bit fingerprint of every text; 0 for a text without words. Equal words give equal fingerprints."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    out = np.zeros(len(texts), np.uint64)
    hashed = word_hashes([w for words in split for w in words])
    ends = np.cumsum(counts)
    # Windows over all words in a row; those that reach into the next document are left out below.
    windows = window_hashes(hashed, SHINGLE)
    long = np.flatnonzero(counts >= SHINGLE)
    if len(long):
        inside = np.zeros(len(windows) + 1, np.int64)
        np.add.at(inside, ends[long] - counts[long], 1)
        np.add.at(inside, ends[long] - SHINGLE + 1, -1)
        terms = windows[np.cumsum(inside[:-1]) > 0]
        sizes = counts[long] - SHINGLE + 1
        out[long] = _vote(terms, sizes)
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        out[i] = window_hashes(hashed[ends[i] - counts[i] : ends[i]], int(counts[i]))[0]
    return out


def _vote(terms: np.ndarray, sizes: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """Majority of every bit over each run of ``sizes`` terms; a tie gives 0. Bits are unpacked a block at a time."""
    ones = np.zeros((len(sizes), BITS), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for lo in range(0, len(terms), block):
        bits = np.unpackbits(terms[lo : lo + block].astype(">u8").view(np.uint8)).reshape(-1, BITS)
        own = owner[lo : lo + block]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(pairs: list[tuple[str, str]]) -> list[tuple[str, int]]:
    texts = [edited(*p) for p in pairs]
    marks = fingerprints(texts).view(np.int64).tolist()
    return [(hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), m) for t, m in zip(texts, marks, strict=True)]


def fingerprint_documents(documents: DataFrame, part_bytes: int = 16 << 20) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, which ends like the next document begins.

    The next document is the next smaller ``doc_id``; after the last comes the first. A null text is the empty text, a
    null id comes last, and rows with one id follow each other by a hash of their text and the text. Documents are
    range sorted once; a task sees the next document as the next row, and only the last document of every task, which
    is kept with its text, is completed by a join with the first document of the following task.

    Returns doc_id, n_chars, edited_sha256 and the 64-bit fingerprint, edited_fingerprint and next_fingerprint.
    """
    spark = documents.sparkSession
    slim = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    total = slim.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h")]
    ranged = slim.withColumn("_h", F.xxhash64("text"))
    ranged = ranged.repartitionByRange(partitions_for(spark, total, part_bytes), *order)
    ranged = ranged.sortWithinPartitions(*order, F.col("text")).select("doc_id", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: tuple | None = None  # the last row seen, whose next document is not known yet
        opening = True
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in in_slices(texts):
                marks = fingerprints(texts[lo:hi]).view(np.int64).tolist()
                rows = [] if waiting is None else [waiting]
                rows += zip(ids[lo:hi], texts[lo:hi], marks, strict=True)
                ended = _rows([(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False)])
                out = []
                for (doc_id, text, mark), following, (digest, changed) in zip(rows, rows[1:], ended, strict=False):
                    kept = text if opening else None
                    out.append((doc_id, len(text), digest, mark, changed, following[2], part, opening, False, kept))
                    opening = False
                waiting = rows[-1]
                if out:
                    yield _batch(out)
        if waiting is not None:
            doc_id, text, mark = waiting
            yield _batch([(doc_id, len(text), None, mark, None, None, part, opening, True, text)])

    walked = materialize(ranged.mapInArrow(walk, ROWS), "fingerprints")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    lasts = walked.filter("last").select("doc_id", "n_chars", "fingerprint", "part", "text")
    # One row per task: the task with rows that follows it, the last one going on with the first.
    parts = walked.filter("last").select("part")
    whole = Window.orderBy("part")
    following = F.coalesce(F.lead("part").over(whole), F.min("part").over(Window.partitionBy()))
    firsts = walked.filter("first").select(
        F.col("part").alias("next_part"), F.col("fingerprint").alias("next_fingerprint"), F.col("text").alias("next_text")
    )
    joined = lasts.join(parts.select("part", following.alias("next_part")), "part").join(firsts, "next_part")
    joined = joined.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", "text", "next_text")

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            ended = _rows([(r["text"], r["next_text"]) for r in rows])
            out = [
                (r["doc_id"], r["n_chars"], digest, r["fingerprint"], changed, r["next_fingerprint"])
                for r, (digest, changed) in zip(rows, ended, strict=True)
            ]
            yield _batch(out, 6)

    fields = ", ".join(ROWS.split(", ")[:6])
    return walked.filter("NOT last").select(columns).unionByName(joined.mapInArrow(complete, fields))


def _batch(rows: list[tuple], width: int = 10) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
    names = [field.split()[0] for field in ROWS.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * width
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds[:width], strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names[:width])


def likeness(a: Column, b: Column) -> Column:
    """Share of the bits that two fingerprints have in common."""
    return (F.lit(BITS) - F.bit_count(a.bitwiseXOR(b))) / F.lit(float(BITS))


def within_radius(queries: DataFrame, corpus: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs of a query fingerprint and a corpus fingerprint that differ in at most ``radius`` bits.

    Both sides have distinct, non-null fingerprints in ``fingerprint`` (bigint); equal texts are counted before, so a
    group of copies is one row. Returns query, fingerprint and distance; a fingerprint is found by itself if it is in
    the corpus. Larger ``blocks`` give longer keys and more tables: C(blocks, radius).
    """
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << edges[k + 1]) - (1 << edges[k])) for k in range(blocks)]
    tables = list(combinations(range(blocks), blocks - radius))

    def signed(mask: int) -> Column:
        return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("bigint")

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = [
            F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(signed(sum(masks[b] for b in chosen))).alias("key"))
            for t, chosen in enumerate(tables)
        ]
        return df.select(F.col("fingerprint").alias(name), F.explode(F.array(*keys)).alias("k")).select(name, "k.*")

    left, right = keyed(queries, "query"), keyed(corpus, "found")
    differ = F.col("query").bitwiseXOR(F.col("found"))
    equal = [F.when(differ.bitwiseAND(signed(m)) == 0, 1 << b).otherwise(0) for b, m in enumerate(masks)]
    equal_blocks = sum(equal[1:], equal[0])
    upto = F.array(*[F.lit((1 << (c[-1] + 1)) - 1) for c in tables])
    exact = F.array(*[F.lit(sum(1 << b for b in c)) for c in tables])
    near = F.bit_count(differ) <= radius
    left, right = left.alias("l"), right.alias("r")
    place = (F.col("l.t") + 1).cast("int")
    first_table = equal_blocks.bitwiseAND(F.element_at(upto, place)) == F.element_at(exact, place)
    same = (F.col("l.t") == F.col("r.t")) & (F.col("l.key") == F.col("r.key"))
    pairs = left.join(right, same & near & first_table)
    return pairs.select("query", F.col("found").alias("fingerprint"), F.bit_count(differ).alias("distance"))


def near_counts(marked: DataFrame, asked: Column, radius: int = 3, blocks: int = 6) -> DataFrame:
    """For every fingerprint of the rows that ``asked`` selects: how many rows have one within the radius (itself too)."""
    counted = marked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_n"), F.max(asked.cast("int")).alias("_asked"))
    found = within_radius(counted.filter("_asked = 1"), counted, radius, blocks)
    totals = found.join(counted, "fingerprint").groupBy("query").agg(F.sum("_n").alias("n_near"))
    return totals.withColumnRenamed("query", "fingerprint")
