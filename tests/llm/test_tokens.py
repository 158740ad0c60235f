"""Word-wise tokens, packing and the token files."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm.packing import pack, pack_documents, patterns, plan
from panelwright.llm.token_store import read_document, read_shards, store_documents, train_dictionary, write_shards
from panelwright.llm.tokens import WordEncoder, crc, default_vocabulary
from panelwright.storage import new_path

ODD = [
    "", " ", "don't it's 'S 'tis a'll I'M", "naïve café. Ça!! x's,", "ΑΣ ΣΑΣ. İstanbul", "a\xa0b\x1cc d​e", "é = ̸",
    "<|endoftext|> <|ENDOFTEXT|> x", "123abc 4.5,6 a_b-c+d ª º ß", "日本語 テスト 한국어", "\x00 a\x0bb\x0cc", "ŉ Ŀ ſ Dž Ⅷ",
    "hello...world!!! ###abc abc### a$%b",
]


def whole(texts):
    encoder = WordEncoder(default_vocabulary())
    return [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_give_the_tokens_of_whole_texts(odd_rows):
    texts = ODD + [r[1] or "" for r in odd_rows]
    small = WordEncoder(default_vocabulary(), max_words=5)  # forgets after every call
    assert [x.tolist() for x in small.encode(texts)] == whole(texts)
    assert [small.encode([t])[0].tolist() for t in texts] == whole(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    encoder = _ENCODER
    assert [x.tolist() for x in encoder.encode(texts)] == [
        encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


_ENCODER = WordEncoder(default_vocabulary())


def documents_ids(rows, end):
    return [(r[0], np.array([*ids, end], "<u4")) for r, ids in zip(rows, whole([r[1] or "" for r in rows]), strict=True)]


def test_pieces_cover_every_document_once(odd, odd_rows):
    got = pack_documents(odd, default_vocabulary(), capacity=64, end_id=2).collect()
    want = Counter()
    for doc_id, ids in documents_ids(odd_rows, 2):
        for start in range(0, len(ids), 64):
            piece = ids[start : start + 64]
            want[(doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    gapless(got, 64)


def gapless(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_no_documents_give_no_pieces(empty):
    assert pack_documents(empty, default_vocabulary()).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=15))
def test_patterns_use_every_length_and_fit(histogram):
    packs = patterns(histogram, 40)
    used = Counter()
    for count, times in packs:
        assert count > 0 and sum(length * t for length, t in times.items()) <= 40
        for length, t in times.items():
            used[length] += t * count
    assert used == Counter(histogram)
    assert len(packs) <= 2 * len(histogram) + 1
    assert plan(histogram, 40).sequences == sum(c for c, _ in packs)


def test_packs_are_filled_with_pieces_of_one_length():
    assert plan({100: 1000}, 4096).sequences == 25
    assert plan({4096: 3, 1: 4097}, 4096).sequences == 5
    hot = {700: 40, 350: 50_000, 90: 30, 33: 2}  # 11 of 350 a sequence
    assert plan(hot, 4096).sequences <= -(-50_000 // 11) + 8
    for histogram in ({7: 500}, {3: 1000, 2: 1}, {20: 5, 9: 400}):
        used = Counter()
        for count, times in patterns(histogram, 40):
            assert sum(length * t for length, t in times.items()) <= 40
            used.update({length: t * count for length, t in times.items()})
        assert used == Counter(histogram)


def test_a_length_that_most_pieces_share_is_ranked_in_parts(spark):
    pieces = spark.range(500).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE 20 END AS length", "'x' AS `an extra`")
    rows = pack(pieces, 32, rows_per_salt=16).collect()
    gapless(rows, 32)
    assert len(rows) == 500 and {r["an extra"] for r in rows} == {"x"}


def test_token_files_round_trip(spark, odd, odd_rows):
    shards, dictionary = store_documents(odd, default_vocabulary(), end_id=1)
    got = read_shards(shards, dictionary).orderBy("start").collect()
    want = documents_ids(odd_rows, 1)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(i), crc(i)) for d, i in want)
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    starts = np.cumsum([0, *[r.n_tokens for r in got]])[:-1]
    assert [r.start for r in got] == starts.tolist()
    found = [x.tolist() for s in shards.collect() for x in read_document(s.path, 0, dictionary)]
    assert found == [i.tolist() for d, i in want if d == 0]
    with pytest.raises(ValueError, match="another dictionary"):
        read_document(shards.first().path, 0, dictionary + b"x")


def test_a_trained_dictionary_helps_short_documents(spark):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows = [(i, " ".join(rnd.choice(words[: 40 + i % 30]) for _ in range(60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    vocabulary = default_vocabulary()
    trained = train_dictionary(docs, vocabulary, 1, samples=300, size=8192)
    assert 0 < len(trained) <= 8192 and trained == train_dictionary(docs, vocabulary, 1, samples=300, size=8192)
    sizes = [
        write_shards(docs, vocabulary, new_path(spark, "tokens"), d).agg(F.sum("n_bytes")).first()[0] for d in (b"", trained)
    ]
    assert sizes[1] < sizes[0]


def test_no_documents_give_no_shards(empty):
    shards, dictionary = store_documents(empty, default_vocabulary())
    assert shards.count() == 0 and dictionary == b"" and read_shards(shards, dictionary).count() == 0
