"""Exact Jaccard join on word shingles with signature trees.

1. Every document becomes a set of 64-bit shingle hashes; equal sets are one from here on.
2. A first pass counts, over the smaller hashes of every set, how many occur in another set. Two sets that are similar
   enough share a known number of them, so sets with fewer have no partner and are left out.
3. The sets that stay are grouped by shared prefix hashes into clusters; only sets of one cluster can be similar.
4. Inside a cluster a signature tree is built: nodes hold the union of their sets' bitmaps, the range of sizes and the
   most tokens that share a bit with another. A dual traversal drops node pairs whose largest possible overlap is too
   small; pairs of sets that are left are compared exactly unless they are already known to be connected. Large
   clusters are cut into blocks of neighbouring sizes and every pair of blocks is a task of its own.
5. Components of the links, joined back to all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.names import quoted
from panelwright.llm.common import mix64, partitions_for, text_of, window_hashes, word_hashes
from panelwright.llm.graph import components
from panelwright.llm.tokens import in_slices
from panelwright.operators.ordering import running_totals
from panelwright.storage import materialize

SHINGLE = 5
#: A link needs 100 x intersection >= PERCENT x union.
PERCENT = 75
_CHUNK_TOKENS = 1 << 19
_BITS = 40  # of a hash that the first pass compares, besides those that deal it out
_FIRST = "pid int, doc_id bigint, hash bigint, n int, set_a bigint, set_b bigint, payload binary"
_COUNTED = "doc_id bigint, hash bigint, n int, set_a bigint, set_b bigint, pid int, payload binary"


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; A-Z are lower-cased, a short text is one shingle."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    hashed = word_hashes([w for words in split for w in words])
    windows = window_hashes(hashed, SHINGLE)
    ends = np.cumsum(counts)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if n >= SHINGLE:
            out.append(np.unique(windows[end - n : end - SHINGLE + 1]))
        else:
            out.append(window_hashes(hashed[end - n : end], n) if n else np.empty(0, np.uint64))
    return out


def set_names(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of every set, which do not depend on an order."""
    a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    for i, s in enumerate(sets):
        a[i], b[i] = mix64(s).sum(dtype=np.uint64), mix64(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return a.view(np.int64), b.view(np.int64)


def least_overlap(n, percent: int):
    """Shingles that a set of ``n`` shares with any set it links with."""
    return -(-n * percent // 100)


def _expected(n, percent: int):
    """Shared hashes asked of the first pass: more than one, so that single common passages do not count."""
    return np.maximum(1, least_overlap(n, percent) // 5)


def first_part(n, percent: int):
    """Hashes of a set that the first pass compares. If A and B share at least k hashes, the smallest |A| - k + j of A
    and |B| - k + j of B have at least j of them in common."""
    return np.minimum(n, n - least_overlap(n, percent) + _expected(n, percent))


def least_shared(n, percent: int):
    """Fewest of them that a set with a partner finds elsewhere; the partner may be smaller and expect fewer."""
    return _expected(least_overlap(n, percent), percent)


def _deal(tokens: np.ndarray, owner: np.ndarray, names: np.ndarray, pids: int) -> Iterator[tuple[int, bytes]]:
    """Payloads of one chunk of sets, by the hash range they belong to.

    Hashes found in two sets of the chunk are counted here and sent on once, without a name.
    """
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    again = np.concatenate([[False], tokens[1:] == tokens[:-1]])
    multiple = again | np.append(again[1:], False)
    counts = np.bincount(owner[multiple], minlength=len(names))
    known = np.flatnonzero(counts)
    if len(known):
        yield int(names[known[0]] % pids), _pack(1, names[known], counts[known], np.empty(0, np.uint64))
    once = ~multiple
    for kept, named in ((once, True), (multiple & ~again, False)):
        part_tokens, part_owner = tokens[kept], owner[kept]
        pid = ((part_tokens >> np.uint64(32)) * np.uint64(pids)) >> np.uint64(32)
        edges = np.searchsorted(pid, np.arange(pids + 1))
        for p in np.flatnonzero(np.diff(edges)):
            lo, hi = edges[p], edges[p + 1]
            if named:
                present, places = np.unique(part_owner[lo:hi], return_inverse=True)
                yield int(p), _pack(0, names[present], places, part_tokens[lo:hi])
            else:
                yield int(p), _pack(2, np.empty(0, np.int64), np.empty(0, np.int64), part_tokens[lo:hi])


def _pack(kind: int, names: np.ndarray, places: np.ndarray, tokens: np.ndarray) -> bytes:
    head = np.array([kind, len(names), len(places), len(tokens)], "<u4").tobytes()
    short = np.ascontiguousarray(tokens, "<u8").view(np.uint8).reshape(-1, 8)[:, : _BITS // 8]
    return head + names.astype("<i8").tobytes() + places.astype("<u4").tobytes() + short.tobytes()


def _unpack(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    kind, n_names, n_places, n_tokens = np.frombuffer(data, "<u4", 4)
    names = np.frombuffer(data, "<i8", n_names, 16)
    at = 16 + 8 * int(n_names)
    places = np.frombuffer(data, "<u4", n_places, at)
    short = np.frombuffer(data, np.uint8, offset=at + 4 * int(n_places)).reshape(int(n_tokens), _BITS // 8)
    tokens = np.zeros((int(n_tokens), 8), np.uint8)
    tokens[:, : _BITS // 8] = short
    return int(kind), names, places, tokens.view("<u8").ravel()


def _shared_in_range(payloads: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(set name, hashes of it that occur in another set) over the payloads of some hash ranges."""
    names, counts, token_parts, name_parts, pid_parts = [], [], [], [], []
    for pid, data in payloads:
        kind, own, places, tokens = _unpack(data)
        if kind == 1:
            names.append(own)
            counts.append(places.astype(np.int64))
            continue
        token_parts.append(tokens)
        name_parts.append(own[places] if kind == 0 else np.zeros(len(tokens), np.int64))
        pid_parts.append(np.full(len(tokens), pid, np.uint64))
    if token_parts:
        token = np.concatenate(token_parts) | (np.concatenate(pid_parts) << np.uint64(_BITS))
        name = np.concatenate(name_parts)
        order = np.lexsort((name, token))
        token, name = token[order], name[order]
        lead = np.concatenate([[True], token[1:] != token[:-1]])
        repeated = np.concatenate([[False], (token[1:] == token[:-1]) & (name[1:] == name[:-1])])
        group = np.cumsum(lead) - 1
        kinds = np.bincount(group, weights=~repeated)
        nameless = np.bincount(group, weights=name == 0)
        shared = ((kinds > 1) | (nameless > 0))[group] & ~repeated & (name != 0)
        found, times = np.unique(name[shared], return_counts=True)
        names.append(found)
        counts.append(times)
    if not names:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    every, at = np.unique(np.concatenate(names), return_inverse=True)
    return every, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def count_shared(documents: DataFrame, percent: int) -> DataFrame:
    """One row per document (with its set), and payloads of counts of shared hashes, which ``shared_counts`` adds up."""
    spark = documents.sparkSession
    slim = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    total = slim.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = partitions_for(spark, total, 8 << 20)
    pids = 4 * parts

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            names = np.array(list(waiting), np.int64)
            owner = np.repeat(np.arange(len(names)), [len(x) for x in waiting.values()])
            dealt = list(_deal(np.concatenate(list(waiting.values())), owner, names, pids))
            empty = pa.nulls(len(dealt), pa.int64())
            columns = [
                pa.array([p for p, _ in dealt], pa.int32()), empty, empty, pa.nulls(len(dealt), pa.int32()), empty, empty,
                pa.array([d for _, d in dealt], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=fields)

        fields = [f.split()[0] for f in _FIRST.split(", ")]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in in_slices(texts):
                own = shingle_sets(texts[lo:hi])
                a, b = set_names(own)
                n = np.array([len(s) for s in own], np.int64)
                for name, s, part in zip(a.tolist(), own, first_part(n, percent).tolist(), strict=True):
                    if part and name not in waiting:
                        waiting[name] = s[:part]
                        held += part
                columns = [
                    pa.array((a % pids).astype(np.int32)), batch.column(0).slice(lo, hi - lo),
                    batch.column(2).slice(lo, hi - lo), pa.array(n.astype(np.int32)), pa.array(a), pa.array(b),
                    pa.nulls(hi - lo, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=fields)
                if held >= _CHUNK_TOKENS:
                    yield flush()
                    waiting, held = {}, 0
        if waiting:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads: list[tuple[int, bytes]] = []
        names = [f.split()[0] for f in _COUNTED.split(", ")]
        for batch in batches:
            is_set = batch.column(6).is_null()
            rows = batch.filter(is_set)
            nothing = [pa.nulls(rows.num_rows, pa.int32()), pa.nulls(rows.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(1, 6)), *nothing], names=names)
            dealt = batch.filter(pa.compute.invert(is_set))
            payloads += zip(dealt.column(0).to_pylist(), dealt.column(6).to_pylist(), strict=True)
        found, shared = _shared_in_range(payloads)
        owner = found % pids
        order = np.argsort(owner, kind="stable")
        found, shared, owner = found[order], shared[order], owner[order]
        edges = np.searchsorted(owner, np.arange(pids + 1))
        places = np.flatnonzero(np.diff(edges))
        none = np.empty(0, np.uint64)
        packed = [_pack(1, found[edges[p] : edges[p + 1]], shared[edges[p] : edges[p + 1]], none) for p in places]
        empty, short = pa.nulls(len(packed), pa.int64()), pa.nulls(len(packed), pa.int32())
        columns = [empty, empty, short, empty, empty, pa.array(places.astype(np.int32)), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    hashed = slim.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    return hashed.mapInArrow(sets, _FIRST).repartition(parts, "pid").mapInArrow(count, _COUNTED)


def shared_counts(counted: DataFrame) -> DataFrame:
    """(set_a, shared) from the payloads of ``count_shared``, which should be stored."""
    spark = counted.sparkSession
    payloads = counted.filter("payload IS NOT NULL").select("pid", "payload")
    size = payloads.agg(F.sum(F.octet_length("payload").cast("bigint"))).first()[0] or 0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(data)[1:3] for batch in batches for data in batch.column(1).to_pylist()]
        if parts:
            names, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            shared = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(shared)], names=["set_a", "shared"])

    dealt = payloads.repartition(partitions_for(spark, size, 4 << 20), "pid")
    return dealt.mapInArrow(add, "set_a bigint, shared bigint")


class SignatureTree:
    """Sets in order of size below nodes that hold bitmap unions, size ranges and the most tokens beyond their bits."""

    def __init__(self, sets: list[np.ndarray], width: int, fanout: int = 8):
        self.fanout = fanout
        n = np.array([len(s) for s in sets], np.int64)
        bits = np.zeros((len(sets), width // 8), np.uint8)
        for i, s in enumerate(sets):
            marks = np.zeros(width, np.uint8)
            marks[(s & np.uint64(width - 1)).astype(np.int64)] = 1
            bits[i] = np.packbits(marks)
        words = bits.view(np.uint64)
        beyond = n - np.bitwise_count(words).sum(axis=1).astype(np.int64)
        self.levels = [(words, n, n, beyond)]  # bitmap, smallest and largest size, tokens beyond the bits; leaves first
        while len(self.levels[-1][1]) > 1:
            words, low, high, beyond = self.levels[-1]
            first = np.arange(0, len(low), fanout)
            self.levels.append((
                np.bitwise_or.reduceat(words, first, axis=0), np.minimum.reduceat(low, first),
                np.maximum.reduceat(high, first), np.maximum.reduceat(beyond, first),
            ))

    def possible(self, level: int, x: np.ndarray, other: SignatureTree, y: np.ndarray, percent: int) -> np.ndarray:
        """Whether sets below the nodes x and y can overlap enough, from sizes and then from bitmaps."""
        words, low, high, beyond = self.levels[level]
        o_words, o_low, o_high, o_beyond = other.levels[level]
        fits = (100 * high[x] >= percent * o_low[y]) & (100 * o_high[y] >= percent * low[x])
        at = np.flatnonzero(fits)
        for lo in range(0, len(at), 4096):
            part = at[lo : lo + 4096]
            i, j = x[part], y[part]
            most = np.bitwise_count(words[i] & o_words[j]).sum(axis=1).astype(np.int64) + np.minimum(beyond[i], o_beyond[j])
            # intersection >= percent / (100 + percent) x (both sizes)
            fits[part] = (100 + percent) * most >= percent * (low[i] + o_low[j])
        return fits

    def children(self, level: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and end of the children of the nodes x, one level down."""
        below = len(self.levels[level - 1][1])
        return x * self.fanout, np.minimum((x + 1) * self.fanout, below)


class Roots:
    """Which sets are known to be connected."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = self.of[a], self.of[b]
        if x != y:
            self.of[self.of == max(x, y)] = min(x, y)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def linked_sets(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Root of every set (those of ``left``, then of ``right``) under the links between them.

    With ``right`` None all pairs inside ``left`` are looked at, otherwise only pairs across.
    """
    sets = left if right is None else left + right
    roots = Roots(len(sets))
    largest = max(len(s) for s in sets)
    width = max(512, 1 << min(16, (4 * largest - 1).bit_length()))
    a = SignatureTree(left, width)
    b = a if right is None else SignatureTree(right, width)
    shift = 0 if right is None else len(left)
    top = min(len(a.levels), len(b.levels)) - 1
    x, y = (g.ravel() for g in np.meshgrid(np.arange(len(a.levels[top][1])), np.arange(len(b.levels[top][1])), indexing="ij"))
    for level in range(top, 0, -1):
        if right is None:
            x, y = x[x <= y], y[x <= y]
        fits = a.possible(level, x, b, y, percent)
        x, y = x[fits], y[fits]
        if level > 1:
            x, y = _below(a, b, level, x, y)
    if top == 0:
        _compare(sets, roots, x, y + shift, right is None, a, b, shift, percent)
        return roots.of
    near = np.argsort(np.abs(x - y), kind="stable")  # neighbours first: they connect most of a group of copies
    x, y = x[near], y[near]
    step = max(1, (1 << 16) // a.fanout**2)
    for lo in range(0, len(x), step):
        i, j = _below(a, b, 1, x[lo : lo + step], y[lo : lo + step])
        _compare(sets, roots, i, j + shift, right is None, a, b, shift, percent)
    return roots.of


def _below(a: SignatureTree, b: SignatureTree, level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the node pairs."""
    (xl, xh), (yl, yh) = a.children(level, x), b.children(level, y)
    steps = np.arange(a.fanout)
    i = (xl[:, None, None] + steps[None, :, None]) + 0 * steps[None, None, :]
    j = (yl[:, None, None] + steps[None, None, :]) + 0 * steps[None, :, None]
    inside = (i < xh[:, None, None]) & (j < yh[:, None, None])
    return i[inside], j[inside]


def _compare(sets, roots, i, j, within, a, b, shift, percent) -> None:
    """Connect the similar pairs among (i, j), leaving out pairs that are connected already."""
    if within:
        i, j = i[i < j], j[i < j]
    open_ = roots.of[i] != roots.of[j]
    i, j = i[open_], j[open_]
    fits = a.possible(0, i, b, j - shift, percent)
    i, j = i[fits], j[fits]
    batch = 64
    while len(i):
        for p, q in zip(i[:batch].tolist(), j[:batch].tolist(), strict=True):
            if roots.of[p] != roots.of[q] and similar(sets[p], sets[q], percent):
                roots.join(p, q)
        i, j = i[batch:], j[batch:]
        open_ = roots.of[i] != roots.of[j]
        i, j = i[open_], j[open_]
        batch *= 2


def candidate_sets(documents: DataFrame, sets: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """The sets that may have a partner, with their hashes: node, n, set_a, set_b, tokens; one row per set, stored."""
    spark = documents.sparkSession
    n = F.col("n")
    least = F.ceil(n * percent / F.lit(100)).cast("bigint")
    again = F.floor(F.ceil(least * percent / F.lit(100)) / 5)
    wanted = sets.join(shared, "set_a").filter(F.col("shared") >= F.greatest(F.lit(1), again))
    wanted = wanted.select(
        F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_hash"), F.col("set_a").alias("_a"), F.col("set_b").alias("_b")
    )
    texts = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    same = (F.col("hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    chosen = texts.join(wanted.hint("shuffle_hash"), same).select("text", "_a", "_b")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            texts, a, b = (batch.column(i).to_pylist() for i in range(3))
            for lo, hi in in_slices(texts):
                own = shingle_sets(texts[lo:hi])
                names = [x.tolist() for x in set_names(own)]
                rows = []
                for key, want, s in zip(zip(*names, strict=True), zip(a[lo:hi], b[lo:hi], strict=True), own, strict=True):
                    if key == want and key not in seen:
                        seen.add(key)
                        rows.append((len(s), *key, s.tobytes()))
                if rows:
                    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["n", "set_a", "set_b", "tokens"])

    found = chosen.mapInArrow(fetch, "n int, set_a bigint, set_b bigint, tokens binary")
    return materialize(found.withColumn("node", F.monotonically_increasing_id()), "sets")


def candidate_clusters(members: DataFrame, percent: int) -> DataFrame:
    """(node, root): sets that share one of their smallest hashes, directly or through others."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, tokens = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            parts = []
            for data in tokens:
                s = np.frombuffer(data, np.uint64)
                parts.append(s[: len(s) - least_overlap(len(s), percent) + 1])
            owner = np.repeat(nodes, [len(p) for p in parts])
            token = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(owner)], names=["token", "node"])

    postings = members.select("node", "tokens").mapInArrow(prefixes, "token bigint, node bigint")
    ends = postings.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    edges = postings.join(ends.select("token", "a"), "token").filter("node <> a")
    return components(edges.select("a", F.col("node").alias("b")))


def placed_sets(members: DataFrame, clusters: DataFrame, block: int, shingles: int) -> DataFrame:
    """node, n, root and the block of every set; the blocks of a cluster are in order of size.

    A block has at most ``block`` sets, and fewer than ``shingles`` shingles besides its last set: a set counts as its
    shingles, or as its share of a full block if that is more, and the running total is cut at even steps.
    """
    slim = members.select("node", "n").join(clusters, "node")
    weighed = slim.withColumn("_weight", F.greatest(F.col("n").cast("bigint"), F.lit(-(-shingles // block)).cast("bigint")))
    summed = materialize(running_totals(weighed, ["root", "n", "node"], {"_total": "_weight"}), "ranked")
    start = F.col("_total").cast("bigint") - F.col("_weight")
    first = summed.groupBy("root").agg(F.min(start).alias("_first"))
    at = F.floor((start - F.col("_first")) / shingles)
    return summed.join(first, "root").select("node", "n", "root", at.alias("block"))


def links(members: DataFrame, clusters: DataFrame, percent: int, block: int = 2048, shingles: int = 1 << 21) -> DataFrame:
    """Edges (a, b) between nodes that span every group of linked sets.

    A task holds two blocks, which are bounded by sets and by shingles, 16 MB each besides their last sets.
    """
    spark = members.sparkSession
    placed = placed_sets(members, clusters, block, shingles)
    blocks = placed.groupBy("root", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = blocks.select("root", F.col("block").alias("with"), F.col("low").alias("low_2"), F.col("high").alias("high_2"))
    # Blocks are in order of size: a later block is too large once its smallest set is.
    pairs = blocks.join(other, "root").filter(f"with >= block AND 100 * high >= {percent} * low_2")
    tasks = pairs.select("root", "block", "with", F.explode(F.array_distinct(F.array("block", "with"))).alias("_b"))
    tasks = tasks.select("root", F.col("block").alias("i"), F.col("with").alias("j"), F.col("_b").alias("block"))
    rows = placed.join(tasks, ["root", "block"]).select("node", "root", "i", "j", "block")
    bytes_ = members.agg(F.sum(F.octet_length("tokens").cast("bigint"))).first()[0] or 0
    rows = rows.join(members.select("node", "n", "tokens"), "node")
    rows = rows.repartition(partitions_for(spark, bytes_, 8 << 20), "root", "i", "j").sortWithinPartitions("root", "i", "j", "n", "node")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, nodes, blocks, tokens in _tasks(batches):
            sets = [np.frombuffer(t, np.uint64) for t in tokens]
            side = np.array(blocks) == key[1]
            order = np.concatenate([np.flatnonzero(side), np.flatnonzero(~side)])
            left = [sets[i] for i in np.flatnonzero(side)]
            right = [sets[i] for i in np.flatnonzero(~side)] or None
            if right is None and key[1] != key[2]:
                continue
            root = linked_sets(left, right, percent)
            node = np.array(nodes, np.int64)[order]
            joined = root != np.arange(len(root))
            yield pa.RecordBatch.from_arrays([pa.array(node[root[joined]]), pa.array(node[joined])], names=["a", "b"])

    return rows.select("root", "i", "j", "node", "block", "tokens").mapInArrow(join, "a bigint, b bigint")


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of one (root, i, j) together, from batches sorted by it."""
    key, nodes, blocks, tokens = None, [], [], []
    for batch in batches:
        for root, i, j, node, block, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (root, i, j) != key:
                if key is not None:
                    yield key, nodes, blocks, tokens
                key, nodes, blocks, tokens = (root, i, j), [], [], []
            nodes.append(node)
            blocks.append(block)
            tokens.append(data)
    if key is not None:
        yield key, nodes, blocks, tokens


def _labelled(documents: DataFrame, percent: int) -> DataFrame:
    """doc_id, hash of the text, n_shingles, component_id, and the names a and b of the component, null without words.

    One row per document. A component is named after one of its sets, so ids that repeat do not mix components.
    """
    counted = materialize(count_shared(documents, percent), "counted")
    rows = counted.filter("payload IS NULL")
    shared = shared_counts(counted)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    sets = materialize(rows.filter("n > 0").groupBy("set_a", "set_b", "n").agg(first), "set-table")
    members = candidate_sets(documents, sets, shared, percent)
    linked = components(links(members, candidate_clusters(members, percent), percent))
    named = members.select("node", "set_a", "set_b").join(linked, "node")
    own = named.join(sets.select("set_a", "set_b", F.col("first.doc_id").alias("doc_id")), ["set_a", "set_b"])
    name = F.min(F.struct("set_a", "set_b")).alias("name")
    lowest = own.groupBy("root").agg(F.min("doc_id").alias("lowest"), name)
    reached = own.join(lowest, "root").select(F.col("set_a").alias("_a"), F.col("set_b").alias("_b"), "lowest", "name")
    same = (F.col("set_a") == F.col("_a")) & (F.col("set_b") == F.col("_b"))
    labelled = sets.join(reached, same, "left").select(
        F.col("set_a").alias("_a"), F.col("set_b").alias("_b"), F.coalesce("lowest", "first.doc_id").alias("component"),
        F.coalesce("name.set_a", "set_a").alias("a"), F.coalesce("name.set_b", "set_b").alias("b"),
    )
    joined = rows.filter("n > 0").join(labelled, same)
    size = F.col("n").cast("bigint").alias("n_shingles")
    out = joined.select("doc_id", "hash", size, F.col("component").alias("component_id"), "a", "b")
    none = F.lit(None).cast("bigint")
    return out.union(rows.filter("n = 0").select("doc_id", "hash", F.lit(0).cast("bigint"), "doc_id", none, none))


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Component of every document under links of at least ``percent`` per cent Jaccard similarity.

    Returns one row per document: doc_id, n_shingles and component_id, the smallest doc_id that links reach, its own
    included. Documents without words (null or empty text) have no shingles and no links. Repeated rows and ids are kept
    and judged by their text; null ids take part in links, but a component_id is null only where no id is known.
    """
    return _labelled(documents, percent).select("doc_id", "n_shingles", "component_id")


def keep_one(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of every component, that with the smallest id; all columns stay.

    Documents without words are linked with nothing and stay, as do rows with a null id. Rows that share an id are judged
    by their texts: one row stays of every component that has the id as its smallest, that with the smallest hash of its
    text, and one of rows that repeat both id and text, chosen by the other columns.
    """
    found = _labelled(documents, percent).filter("doc_id = component_id")
    least = found.filter("a IS NOT NULL").groupBy("a", "b").agg(F.min(F.struct("doc_id", "hash")).alias("k")).select("k.*")
    kept = least.union(found.filter("a IS NULL").select("doc_id", "hash")).distinct()
    kept = kept.select(F.col("doc_id").alias("_kept"), F.col("hash").alias("_text"))
    plain = [F.col(quoted(f.name)) for f in documents.schema if "map<" not in f.dataType.simpleString()]
    packed = documents.select(
        F.struct("*").alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64(text_of()).alias("_hash"),
        F.xxhash64(*plain).alias("_order"),
    )
    same = (F.col("_id") == F.col("_kept")) & (F.col("_hash") == F.col("_text"))
    chosen = packed.join(kept.hint("shuffle_hash"), same, "left_semi")
    chosen = chosen.groupBy("_id", "_hash").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")
    return chosen.union(packed.filter("_id IS NULL").select("_row.*"))
