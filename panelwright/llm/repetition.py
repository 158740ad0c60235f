"""Quality rules on the repetition inside a document, from a suffix array over its words.

The suffixes of many documents are sorted together by prefix doubling, with the document in front of every key so that
nothing matches across documents; a round sorts only the suffixes that are still tied. The ranks of every round are
kept and give the common prefix of neighbouring suffixes. The longest repeat that starts at a word is the larger of
the common prefixes with its two neighbours, which is the depth of its smallest prefix interval; the union of these
spans is the union of all maximal repeated substrings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import text_of
from panelwright.llm.tokens import in_slices

SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")


def longest_repeats(words: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """Words of the longest repeat that starts at each position; 0 where it has fewer than ``least`` words.

    ``words`` are word numbers, ``doc`` the document number of each, not descending. A repeat occurs at two places of
    one document at least; the places may overlap.
    """
    n = len(words)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    after = np.append(np.flatnonzero(np.diff(doc)) + 1, n)
    stop = after[np.searchsorted(after, np.arange(n), side="right")]  # end of the own document
    active = np.arange(n)
    rank = np.zeros(n, np.int64)
    keys = doc.astype(np.int64) * (int(words.max()) + 1) + words
    levels: list[np.ndarray] = []
    step = 0
    while len(active):
        order = np.argsort(keys, kind="stable")
        active, keys = active[order], keys[order]
        same = np.concatenate([[False], keys[1:] == keys[:-1]])
        lead = np.flatnonzero(~same)  # first row of every new group
        was = rank[active]
        old = np.concatenate([[True], was[1:] != was[:-1]])
        old_lead = np.maximum.accumulate(np.where(old, np.arange(len(active)), 0))
        new_lead = np.repeat(lead, np.diff(np.append(lead, len(active))))
        rank[active] = was + new_lead - old_lead
        levels.append(rank.copy())
        tied = same | np.append(same[1:], False)
        active = active[tied]
        step = 1 << (len(levels) - 1)
        ahead = active + step
        inside = ahead < stop[active]
        following = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = rank[active] * (n + 1) + following
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    a, b = suffixes[:-1], suffixes[1:]
    hint = max(0, least.bit_length() - 1)  # repeats of at least 2^hint words are looked at
    if hint >= len(levels):
        return out
    close = levels[hint][a] == levels[hint][b]
    a, b = a[close], b[close]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        both = (i < stop[a]) & (j < stop[b])
        equal = both & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        common += equal.astype(np.int64) << k
    common[common < least] = 0
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def covered(spans: np.ndarray) -> np.ndarray:
    """Whether each position lies in a span; ``spans`` holds the length of the span that starts at each position."""
    edge = np.zeros(len(spans) + 1, np.int64)
    starts = np.flatnonzero(spans)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + spans[starts], -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str], least: int = 5) -> np.ndarray:
    """One row of ``COUNTS`` for every text."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    words: list[int] = []
    for i, text in enumerate(texts):
        own = text.encode("utf-8", "surrogatepass").split()
        words.extend([number(w, len(numbers)) for w in own])
        lines = [line for line in text.split("\n") if line.strip(SPACE)]
        out[i, :4] = (
            len(own),
            len(text) - sum(text.count(c) for c in SPACE),
            sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)),
        )
    doc = np.repeat(np.arange(len(texts)), out[:, 0])
    repeats = longest_repeats(np.array(words, np.int64), doc, least)
    out[:, 4] = np.bincount(doc[covered(repeats)], minlength=len(texts))
    np.maximum.at(out[:, 5], doc, repeats)
    return out


def verdicts(counts: np.ndarray, least_words: int, most_covered: int, most_repeat: int) -> tuple[np.ndarray, np.ndarray]:
    """(base rules failed, document kept) from rows of ``COUNTS``."""
    n_words, repeated, longest = counts[:, 0], counts[:, 4], counts[:, 5]
    failed = (n_words < least_words) | (100 * repeated > most_covered * n_words)
    return failed, ~failed & (longest <= most_repeat)


def repetition(documents: DataFrame, least_words: int = 10, most_covered: int = 20, most_repeat: int = 100) -> DataFrame:
    """Counts and verdict of every document: doc_id, ``COUNTS``, base_failed and kept.

    A document fails the base rules with fewer than ``least_words`` words or when repeats of five words and more cover
    over ``most_covered`` per cent of them; it is also rejected when one repeat is longer than ``most_repeat`` words.
    Null and empty texts have no words and fail. Every row is judged by itself, so repeated rows agree.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in in_slices(texts):
                counts = measure(texts[lo:hi])
                failed, kept = verdicts(counts, least_words, most_covered, most_repeat)
                columns = [ids.slice(lo, hi - lo), *[pa.array(c) for c in counts.T], pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept"])

    schema = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in COUNTS], "base_failed boolean", "kept boolean"])
    return documents.select(F.col("doc_id").cast("bigint"), text_of()).mapInArrow(judge, schema)


def keep_good(documents: DataFrame, least_words: int = 10, most_covered: int = 20, most_repeat: int = 100) -> DataFrame:
    """The documents that ``repetition`` keeps, with all their columns."""
    place = documents.columns.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for lo, hi in in_slices(texts):
                kept = verdicts(measure(texts[lo:hi]), least_words, most_covered, most_repeat)[1]
                yield batch.slice(lo, hi - lo).filter(pa.array(kept))

    return documents.mapInArrow(judge, documents.schema)
