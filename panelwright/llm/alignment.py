"""Alignment of two tokenizers over a corpus: every distinct text is tokenized and aligned once.

Documents are shuffled by their full text and counted, so copies cost nothing after that. Both tokenizers cut the same
bytes; where both cut, groups of tokens end, and every stretch between two neighbouring cuts of either is one link
between the tokens that hold it. How many documents hold a pair of linked ids is counted over the distinct texts, each
weighted by its copies.

A task handles its texts in blocks of a bounded number of links. A block keeps its distinct pairs once, in order, and a
text refers to them by number. The counts of all pairs come back to a block as one row per pair, in a cogroup with its
texts, so the links themselves are never exploded into rows.

The first tokenizer never merges across the pieces that its own pattern cuts a text into, so every distinct piece is
encoded once per worker. Texts with characters beyond Latin Extended-B, or odd white space, are encoded whole: there the
pattern could mean something else to another library.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import text_of
from panelwright.llm.tokens import in_slices
from panelwright.storage import materialize

#: Characters whose classes no version of Unicode disputes; any other sends the text to the tokenizer as a whole.
_SURE = re.compile("[\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
#: Pieces that a worker remembers with their ids.
_MOST_PIECES = 400_000
#: A pair is one number, with the id of the second vocabulary in its lower bits.
_ID_BITS = 32
#: Links of one block, besides those of its last slice of texts.
BLOCK_LINKS = 2_000_000
_ALIGNED = (
    "block bigint, digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "held binary, pairs binary, weights binary"
)
_MEASURED = "digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
_MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The byte behind every letter of a byte-level vocabulary: printable ones stand for themselves, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, with the bytes of each of their tokens. One per worker process."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from public_tokenizers import PATTERN
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.pieces = regex.compile(PATTERN).findall
        self.known: dict[str, list[int]] = {}
        self.a = Tokenizer.from_file(vocabulary_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=vocabulary_b)
        letters = _byte_letters()
        size_a, size_b = self.a.get_vocab_size(), self.b.vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(size_a)]
        special = {i for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = [x.encode() if i in special else bytes(letters[c] for c in x) for i, x in enumerate(names)]
        pieces = [self.b.id_to_piece(i) for i in range(size_b)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.size_a, self.size_b = size_a, size_b
        self.numbers = list(range(size_a))
        # How a token is written in the list of groups: ids inside a group, and the last ids of both sides.
        written = [f"{i}{end}" for end in ",|" for i in range(size_a)] + [f"{i}{end}" for end in ",;" for i in range(size_b)]
        self.written = np.array(written, object)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text by the first tokenizer, special tokens being plain text."""
        if len(self.known) > _MOST_PIECES:
            self.known = {}
        split = [self.pieces(t) if _SURE.fullmatch(t) else None for t in texts]
        fresh = [p for p in dict.fromkeys(chain.from_iterable(x for x in split if x is not None)) if p not in self.known]
        whole = [t for t, x in zip(texts, split, strict=True) if x is None]
        encoded = [x.ids for x in self.a.encode_batch_fast(fresh + whole, add_special_tokens=False)]
        share = self.numbers.__getitem__  # lists of remembered pieces share their numbers
        self.known.update((p, list(map(share, x))) for p, x in zip(fresh, encoded, strict=False))
        rest, find = iter(encoded[len(fresh) :]), self.known.__getitem__
        return [next(rest) if x is None else list(chain.from_iterable(map(find, x))) for x in split]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of every text by both tokenizers; none for a text whose tokens do not give back its bytes."""
        found_a = self.encode_a([" " + t for t in texts])
        found_b = self.b.encode(texts, num_threads=1) if texts else []
        ids_a, ids_b, none = [], [], np.empty(0, np.int64)
        for text, a, b in zip(texts, found_a, found_b, strict=True):
            whole = (" " + text).encode()
            same = bool(text) and b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
            ids_a.append(np.array(a, np.int64) if same else none)
            ids_b.append(np.array(b, np.int64) if same else none)
        return ids_a, ids_b


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(vocabularies: tuple[str, str]) -> Aligner:
    if vocabularies not in _ALIGNERS:
        _ALIGNERS[vocabularies] = Aligner(*vocabularies)
    return _ALIGNERS[vocabularies]


@dataclass
class Aligned:
    """Alignment of some texts, one entry per text; ``pairs`` and ``times`` are its distinct links and how often each occurs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    hashes: list[str]
    pairs: list[np.ndarray]
    times: list[np.ndarray]


def _found_in(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the ascending ``values`` are among the ascending ``others``."""
    if not len(others):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(others, values), len(others) - 1)
    return others[at] == values


def align(tokens: Aligner, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> Aligned:
    """Align all texts at once: laid end to end, texts end where both tokenizers cut, so no link crosses two of them."""
    n = len(ids_a)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([*ids, np.empty(0, np.int64)]) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(tokens.len_a[a]), np.cumsum(tokens.len_b[b])
    text_a = np.repeat(np.arange(n), n_a)
    # A group ends with every token of A whose end is one of B, too.
    last_a, last_b = _found_in(ends_a, ends_b), _found_in(ends_b, ends_a)
    n_groups = np.bincount(text_a[last_a], minlength=n)
    cuts = np.sort(np.concatenate([ends_a, ends_b[~last_b]]), kind="stable")
    of_a, of_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    text_of_link = text_a[of_a]
    n_links = np.bincount(text_of_link, minlength=n)
    hashes = _group_hashes(tokens, a, b, last_a, last_b, n_a + n_b)
    # Distinct pairs by text; links of a text are neighbours, and its number goes before the pair.
    codes = a[of_a] * tokens.size_b + b[of_b]
    space = tokens.size_a * tokens.size_b
    keys, times = np.unique(text_of_link * space + codes, return_counts=True)
    bounds = np.searchsorted(keys, np.arange(1, n) * space) if n else []
    codes = keys % space
    pairs = (codes // tokens.size_b << _ID_BITS) + codes % tokens.size_b
    return Aligned(n_a, n_b, n_groups, n_links, hashes, np.split(pairs, bounds), np.split(times, bounds))


def _group_hashes(tokens: Aligner, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Hash of the list of groups of every text; a text without tokens has the empty string instead."""
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    # Before a token of A stand the tokens of B of earlier groups; before one of B, those of A up to its own group.
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.concatenate([[0], ends_b])[group_a]] = a + tokens.size_a * last_a
    order[np.arange(len(b)) + ends_a[group_b]] = 2 * tokens.size_a + b + tokens.size_b * last_b
    words = tokens.written[order].tolist()
    out, at = [], 0
    for size in sizes.tolist():
        listed = "".join(words[at : at + size])[:-1]
        out.append(hashlib.sha256(listed.encode()).hexdigest() if size else "")
        at += size
    return out


def _planes(values: np.ndarray) -> bytes:
    """Small whole numbers with their low bytes first, all higher bytes after that: mostly zeros, which compress to nothing."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Block:
    """Aligned texts with their pairs, up to a bounded number of links."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.copies: list[int] = []
        self.links = 0

    def add(self, digests: list[bytes], copies: list[int], found: Aligned) -> None:
        columns = (found.n_a, found.n_b, found.n_groups, found.n_links)
        self.rows += zip(digests, *(c.tolist() for c in columns), found.hashes, strict=True)
        self.pairs += found.pairs
        self.times += found.times
        self.copies += copies
        self.links += int(found.n_links.sum())

    def batch(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        """One row per text, and one with the block's pairs and how many documents of the block hold each."""
        sizes = np.array([len(p) for p in self.pairs], np.int64)
        pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, at, np.repeat(np.array(self.copies, np.int64), sizes))
        held, first = [], 0
        for size, times in zip(sizes.tolist(), self.times, strict=True):
            mine = at[first : first + size]
            held.append(_planes(np.concatenate([np.diff(mine, prepend=0), times])))
            first += size
        columns = [[number] * (len(self.rows) + 1)]
        columns += [[*c, None] for c in zip(*self.rows, strict=True)]
        columns += [[*held, None], [None] * len(held) + [pairs.astype("<i8").tobytes()], [None] * len(held) + [weights.astype("<i8").tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in text.split(", "))])


def aligned_texts(texts: DataFrame, vocabularies: tuple[str, str], block_links: int = BLOCK_LINKS) -> DataFrame:
    """Rows of texts and of blocks from distinct texts (digest, text, n)."""
    schema = _schema(_ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = aligner(vocabularies)
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            digests, values, copies = (batch.column(c).to_pylist() for c in ("digest", "text", "n"))
            for lo, hi in in_slices(values):
                found = align(tokens, *tokens.encode(values[lo:hi]))
                block.add(digests[lo:hi], copies[lo:hi], found)
                if block.links >= block_links:
                    yield block.batch(number, schema)
                    number, block = number + 1, Block()
        if block.rows:
            yield block.batch(number, schema)

    return texts.select("digest", "text", "n").mapInArrow(run, _ALIGNED)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair of a block: block, place in the block, pair, documents of the block that hold it."""
    for batch in batches:
        for block, pairs, weights in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "weights")), strict=True):
            pairs, weights = np.frombuffer(pairs, "<i8"), np.frombuffer(weights, "<i8")
            for lo in range(0, len(pairs), 50_000):
                part = pairs[lo : lo + 50_000]
                columns = [np.full(len(part), block), np.arange(lo, lo + len(part), dtype=np.int32), part, weights[lo : lo + 50_000]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "place", "pair", "weight"])


def _measure(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Measures of the texts of one block from the counts of its pairs."""
    schema = _schema(_MEASURED)
    if not texts.num_rows:
        return schema.empty_table()
    place = answers.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
    held = [_from_planes(x) for x in texts.column("held").to_pylist()]
    n_best, count_sum = [], []
    for values in held:
        half = len(values) // 2
        at, times = np.cumsum(values[:half]), values[half:]
        n_best.append(int((times * best[at]).sum()))
        count_sum.append(int((times * count[at]).sum()))
    columns = {c: texts.column(c) for c in ("digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    columns |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.table({f.name: columns[f.name] for f in schema})


def align_documents(documents: DataFrame, vocabularies: tuple[str, str] | None = None, block_links: int = BLOCK_LINKS) -> DataFrame:
    """How two tokenizers cut every document, and how common its pairs of linked ids are in the corpus.

    Input columns: doc_id, text; others are ignored. Null and empty texts, and texts that one of the tokenizers does not
    give back byte by byte, have no tokens: zeros and an empty ``groups_sha256``. Rows with null or equal ids are
    documents of their own and count as such. No documents give no rows. Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.
    """
    vocabularies = vocabularies or default_vocabularies()
    slim = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    full = slim.where("text <> ''")
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    distinct = full.groupBy("text").agg(F.count(F.lit(1)).alias("n")).select(digest, "text", "n")
    aligned = materialize(aligned_texts(distinct, vocabularies, block_links), "aligned")
    blocks = aligned.where(F.col("pairs").isNotNull()).select("block", "pairs", "weights")
    rows = blocks.mapInArrow(_block_pairs, "block bigint, place int, pair bigint, weight bigint")
    counts = materialize(rows.groupBy("pair").agg(F.sum("weight").alias("count")), "pair-counts")
    # One row per id of the first vocabulary.
    token = F.shiftright("pair", _ID_BITS)
    highest = counts.groupBy(token.alias("a")).agg(F.max("count").alias("most"))
    judged = counts.withColumn("a", token).join(F.broadcast(highest), "a")
    judged = judged.select("pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best"))
    answers = rows.select("block", "place", "pair").join(judged, "pair").select("block", "place", "count", "best")
    texts = aligned.where(F.col("held").isNotNull()).drop("pairs", "weights")
    measured = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_measure, _MEASURED)
    found = full.select("doc_id", digest).join(measured, "digest").drop("digest")
    nothing = slim.where("text = ''").select("doc_id", *[F.lit(0).cast("bigint").alias(c) for c in _MEASURES], F.lit("").alias("groups_sha256"))
    return found.select(*nothing.columns).unionByName(nothing)
