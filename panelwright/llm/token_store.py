"""Token ids of a corpus in files: one zstandard frame per document, with a shared dictionary and an offset index.

A shard holds a range of documents in ascending order:

    magic (8 bytes) | frame of document 0 | frame of document 1 | ... | index | footer

A frame is the document's ids as little-endian unsigned integers of ``width`` bytes, compressed on its own with the
shared dictionary, so a short document is read without its neighbours. The index holds per document its id, a flag
whether the id is null, the frame's offset and size, and its number of ids. The fixed-size footer names the index,
the width and the SHA-256 of the dictionary, which a reader compares with the dictionary that it was given.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import partitions_for, text_of
from panelwright.llm.tokens import crc, encoder, in_slices
from panelwright.storage import materialize, new_path

MAGIC = b"PWTOKEN1"
INDEX = np.dtype([("doc_id", "<i8"), ("null", "<u1"), ("offset", "<u8"), ("size", "<u8"), ("n_tokens", "<u8")])
FOOTER = "<QQB32s8s"  # index offset, documents, width, dictionary hash, magic
SHARDS = "part bigint, path string, n_docs bigint, n_tokens bigint, n_bytes bigint"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _opened(path: str):
    system, place = pafs.FileSystem.from_uri(path)
    return system, place


def train_dictionary(
    documents: DataFrame, vocabulary: str, end_id: int, samples: int = 1000, longest: int = 16_384, size: int = 65_536
) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes, trained on the serialized ids of a bounded sample.

    The sample is the ``samples`` documents of at most ``longest`` bytes with the smallest hashes, the same in every
    run. Too few or too uniform samples give the empty dictionary, with which frames are compressed plainly.
    """
    import zstandard

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        dtype = f"<u{id_width(tokens)}"
        for batch in batches:
            ids = tokens.encode(batch.column(0).to_pylist())
            values = [np.append(x, end_id).astype(dtype).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["ids"])

    short = documents.select(text_of().alias("text"), F.xxhash64("text", "doc_id").alias("h"))
    short = short.filter(F.octet_length("text").between(1, longest)).orderBy("h", "text").limit(samples).select("text")
    rows = [bytes(r["ids"]) for r in short.mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, sorted(rows)).as_bytes()
    except zstandard.ZstdError:
        return b""


def id_width(tokens) -> int:
    return 2 if tokens.tokenizer.get_vocab_size() <= 1 << 16 else 4


def _codec(dictionary: bytes):
    import zstandard

    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (
        zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True),
        zstandard.ZstdDecompressor(dict_data=trained),
    )


def write_shards(
    documents: DataFrame, vocabulary: str, folder: str, dictionary: bytes, end_id: int = 1, shard_bytes: int = 24 << 20
) -> DataFrame:
    """Tokenize whole documents and write them in ascending ``doc_id`` order; returns the stored list of shards.

    A null text is the empty text; a null ``doc_id`` comes first; rows with the same id are ordered by a hash of their
    text and then by the text itself. A shard is written by one task under a name of its own attempt and counts only
    when its row is in the list, so a repeated or lost task does no harm. ``shard_bytes`` is the text that goes into a
    shard on average. The dictionary lies beside the shards, named by its hash.
    """
    spark = documents.sparkSession
    slim = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    total = slim.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    name = hashlib.sha256(dictionary).hexdigest()
    system, place = _opened(folder)
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/dictionary-{name}.zdict") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _opened(folder)
        context = TaskContext.get()
        path = f"{place}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.bin"
        tokens = encoder(vocabulary)
        width = id_width(tokens)
        compress = _codec(shared.value)[0].compress
        index: list[tuple] = []
        at = len(MAGIC)
        with system.open_output_stream(path) as out:
            out.write(MAGIC)
            for batch in batches:
                ids_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for lo, hi in in_slices(texts):
                    for doc_id, ids in zip(ids_of[lo:hi], tokens.encode(texts[lo:hi]), strict=True):
                        ids = np.append(ids, np.uint32(end_id))
                        frame = compress(ids.astype(f"<u{width}").tobytes())
                        out.write(frame)
                        index.append((doc_id or 0, doc_id is None, at, len(frame), len(ids)))
                        at += len(frame)
            entries = np.array(index, dtype=INDEX)
            out.write(entries.tobytes())
            out.write(struct.pack(FOOTER, at, len(index), width, bytes.fromhex(name), MAGIC))
        if index:
            row = [context.partitionId(), path, len(index), int(entries["n_tokens"].sum()), at]
            names = ["part", "path", "n_docs", "n_tokens", "n_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=names)

    parts = partitions_for(spark, total, shard_bytes)
    ordered = slim.withColumn("_h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "_h")
    shards = materialize(ordered.sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text").mapInArrow(write, SHARDS), "shards")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_index(handle, dictionary: bytes) -> tuple[np.ndarray, int]:
    """Index and id width of an open shard; refuses a shard that was written with another dictionary."""
    size = handle.size()
    handle.seek(size - struct.calcsize(FOOTER))
    at, n_docs, width, name, magic = struct.unpack(FOOTER, handle.read(struct.calcsize(FOOTER)))
    if magic != MAGIC:
        raise ValueError("not a token shard")
    if name != hashlib.sha256(dictionary).digest():
        raise ValueError("the shard was written with another dictionary")
    handle.seek(at)
    return np.frombuffer(handle.read(n_docs * INDEX.itemsize), dtype=INDEX), width


def read_document(path: str, doc_id: int, dictionary: bytes) -> list[np.ndarray]:
    """Ids of every document with this id in the shard, reading only the index and their frames."""
    system, place = _opened(path)
    with system.open_input_file(place) as handle:
        index, width = read_index(handle, dictionary)
        expand = _codec(dictionary)[1].decompress
        found = []
        for entry in index[(index["doc_id"] == doc_id) & (index["null"] == 0)]:
            handle.seek(int(entry["offset"]))
            frame = handle.read(int(entry["size"]))
            found.append(np.frombuffer(expand(frame), dtype=f"<u{width}").astype(np.uint32))
        return found


def read_shards(shards: DataFrame, dictionary: bytes) -> DataFrame:
    """Read every document back: id, ids before it, number of ids and their checksum. A shard is read by one task."""
    shared = shards.sparkSession.sparkContext.broadcast(dictionary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = _codec(shared.value)[1].decompress
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, place = _opened(path)
                with system.open_input_file(place) as handle:
                    index, width = read_index(handle, shared.value)
                    handle.seek(0)
                    data = io.BytesIO(handle.read()).getbuffer()
                sums = []
                for entry in index:
                    lo = int(entry["offset"])
                    ids = np.frombuffer(expand(data[lo : lo + int(entry["size"])]), dtype=f"<u{width}")
                    if len(ids) != entry["n_tokens"]:
                        raise ValueError(f"{path}: a frame does not match the index")
                    sums.append(crc(ids))
                counts = index["n_tokens"].astype(np.int64)
                columns = [
                    pa.array(index["doc_id"], mask=index["null"] == 1),
                    pa.array(start + np.cumsum(counts) - counts),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = shards.sparkSession
    parts = partitions_for(spark, shards.count(), 4)
    return shards.select("path", "start").repartition(parts).mapInArrow(read, READ)


def store_documents(documents: DataFrame, vocabulary: str, end_id: int = 1) -> tuple[DataFrame, bytes]:
    """Train the dictionary and write all documents to a new folder; the list of shards and the dictionary."""
    dictionary = train_dictionary(documents, vocabulary, end_id)
    folder = new_path(documents.sparkSession, "tokens")
    return write_shards(documents, vocabulary, folder, dictionary, end_id), dictionary
