"""Token ids of whole texts, with every word encoded once per worker.

Encoding a text equals encoding its white-space separated words one after the other: no pre-token of this kind of
vocabulary crosses white space. Texts for which that is not certain (characters beyond Latin Extended-B, odd control
characters, a capital dotted I, strings that could be special tokens) are encoded as a whole.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, islice

import numpy as np

from panelwright.llm.common import concat_ranges

#: Anything but these characters sends the text to the tokenizer as a whole.
_SURE = re.compile("[\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
_SURE_BYTES = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])
_TAIL = ".,!?;:%#$*&|"
_JOINED = 256


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _sure(text: str) -> bool:
    """Whether the text is the sequence of its words to the tokenizer, in any case."""
    if "<|" in text:
        return False
    try:
        return not text.encode("latin-1").translate(None, _SURE_BYTES)
    except UnicodeEncodeError:
        return _SURE.fullmatch(text) is not None


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class WordEncoder:
    """Encodes texts with a lower-casing BPE vocabulary whose tokens mark the end of a word.

    A word is a core and a tail of punctuation, each a range of ids in ``flat``. ``max_words`` bounds the remembered
    words; when it is reached the memory starts anew, results do not change.
    """

    def __init__(self, vocabulary: str, max_words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.max_words = max_words
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.parts = {"": 0}  # cores and tails, by their row in ``ranges``
        self.ranges = _Growing(np.zeros((1, 2), np.int64))
        self.words = _Growing(np.zeros((0, 2), np.int64))  # rows of core and tail
        self.flat = _Growing(np.zeros(0, np.uint32))

    def _learn_parts(self, fresh: list[str]) -> None:
        """Encode cores and tails; runs of letters many at a time, cut at the word ends."""
        letters = [p for p in fresh if p.isalpha()]
        batches = [letters[i : i + _JOINED] for i in range(0, len(letters), _JOINED)]
        encoded = self.tokenizer.encode_batch_fast([" ".join(b) for b in batches], add_special_tokens=False)
        single = [p for p in fresh if not p.isalpha()]
        for batch, text in zip(batches, encoded, strict=True):
            ids = np.array(text.ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(batch) and stops[-1] == len(ids):
                self._add(batch, ids, np.diff(stops, prepend=0))
            else:
                single += batch
        ids_of = [x.ids for x in self.tokenizer.encode_batch_fast(single, add_special_tokens=False)]
        flat = np.array([i for ids in ids_of for i in ids], np.uint32)
        self._add(single, flat, np.array([len(x) for x in ids_of], np.int64))

    def _add(self, parts: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.ranges)
        self.ranges.extend(np.stack([len(self.flat) + np.cumsum(lengths) - lengths, lengths], axis=1))
        self.flat.extend(ids)
        self.parts.update(zip(parts, range(first, first + len(parts)), strict=True))

    def _learn_words(self, words: list[str]) -> None:
        cores = [w.rstrip(_TAIL) for w in words]
        # a tail is cut off only where letters end, which is the end of a pre-token
        cores = [c if c[-1:].isalpha() else w for c, w in zip(cores, words, strict=True)]
        tails = [w[len(c) :] for c, w in zip(cores, words, strict=True)]
        fresh = list(dict.fromkeys(p for p in (*cores, *tails) if p not in self.parts))
        if fresh:
            self._learn_parts(fresh)
        find = self.parts.__getitem__
        rows = np.fromiter(map(find, cores), np.int64, len(cores)), np.fromiter(map(find, tails), np.int64, len(tails))
        self.words.extend(np.stack(rows, axis=1))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, as the tokenizer gives them without special tokens."""
        if len(self.numbers) > self.max_words:
            self._forget()
        whole = [i for i, text in enumerate(texts) if not _sure(text)]
        skipped = set(whole)
        split = [[] if i in skipped else text.lower().split() for i, text in enumerate(texts)]
        counts = np.array([len(w) for w in split], np.int64)
        known = len(self.numbers)
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if len(self.numbers) > known:
            self._learn_words(list(islice(reversed(self.numbers), len(self.numbers) - known))[::-1])
        ranges = self.ranges.values[self.words.values[at].ravel()]
        ids = self.flat.values[concat_ranges(ranges[:, 0], ranges[:, 1])]
        sizes = np.concatenate([[0], np.cumsum(ranges[:, 1])])[2 * np.cumsum(counts)]
        results = np.split(ids, sizes[:-1]) if len(texts) else []
        for i in whole:
            results[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return results


class _Growing:
    """Array that is extended at its end."""

    def __init__(self, values: np.ndarray):
        self.room, self.used = values, len(values)

    def __len__(self) -> int:
        return self.used

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.used]

    def extend(self, more: np.ndarray) -> None:
        need = self.used + len(more)
        if need > len(self.room):
            room = np.zeros((max(need, 2 * len(self.room)), *self.room.shape[1:]), self.room.dtype)
            room[: self.used] = self.values
            self.room = room
        self.room[self.used : need] = more
        self.used = need


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def in_slices(texts: list[str], chars: int = 1_000_000):
    """Ranges of rows with at most ``chars`` characters each (one row may exceed it), to bound memory."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)
