"""Token alignment against a loop over bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import alignment
from panelwright.llm.alignment import align_documents, aligner, default_vocabularies

from .conftest import SCHEMA, prose

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens_of(text):
    """(id, bytes) of both tokenizers, from their own decoders where these keep single tokens."""
    import public_tokenizers as P
    import sentencepiece
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(P.path("byte_bpe_50k.tiktoken"))
    a = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    from_a = [(i, a.decode_single_token_bytes(i)) for i in a.encode_ordinary(" " + text)]
    from_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        from_b.append((i, bytes.fromhex(piece[3:5]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return from_a, from_b


def by_hand(documents):
    """Rows of the contract, from spans of bytes."""
    seen, linked, counts = {}, {}, Counter()
    for text in {t for _, t in documents if t}:
        a, b = tokens_of(text)
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        links, j0 = [], 0
        for lo, hi, i in spans[0]:
            while spans[1][j0][1] <= lo:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][0] < hi:
                links.append((i, spans[1][j][2]))
                j += 1
        ends = sorted({hi for _, hi, _ in spans[0]} & {hi for _, hi, _ in spans[1]})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo < e <= hi) for side in spans))
            lo = hi
        seen[text] = (len(a), len(b), len(ends), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest())
        linked[text] = links
    for _, t in documents:
        counts.update(set(linked.get(t, [])))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    rows = []
    for d, t in documents:
        if t not in seen:
            rows.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = linked[t]
        n_best = sum(counts[p] == best[p[0]] for p in links)
        rows.append((d, *seen[t][:4], n_best, sum(counts[p] for p in links), seen[t][4]))
    return Counter(rows)


def run(df, **sizes):
    return Counter(tuple(r) for r in align_documents(df, **sizes).select("doc_id", *NAMES).collect())


def test_against_a_loop(spark):
    rnd = random.Random(8)
    texts = [prose(rnd, rnd.randint(1, 80)) for _ in range(40)]
    texts += [f"  Mixed\n\ttext {i}!! don't, 12.5% <s> </s> <0x41> \r\n x" for i in range(5)] + ["é 日本語 😀 ​", "a▁b", " "]
    documents = [(i, rnd.choice(texts)) for i in range(150)]
    df = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(6)
    want = by_hand(documents)
    assert run(df) == want
    assert run(df, block_links=100) == want
    assert sum(r[1] == 0 for r in want) > 0  # the text with U+2581 has no tokens


def test_odd_documents(spark, odd, odd_rows, empty):
    assert run(odd) == by_hand([(r[0], r[1]) for r in odd_rows])
    assert align_documents(empty).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, ""), (None, "a▁b")], "doc_id bigint, text string")
    assert run(nothing) == Counter([(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2, None)])
    assert odd.schema.simpleString() == empty.schema.simpleString() and SCHEMA


def test_special_strings_are_plain_text(spark):
    documents = [(1, "one <|endoftext|> two"), (2, "<|endoftext|>")]
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    assert run(df) == by_hand(documents)


@pytest.mark.parametrize("text", ["word " * 60000, "x" * 20000, "\n" * 3000])
def test_long_texts(text):
    tokens = aligner(default_vocabularies())
    ids_a, ids_b = tokens.encode([text, "short"])
    found = alignment.align(tokens, ids_a, ids_b)
    assert found.n_a[0] + found.n_b[0] - found.n_groups[0] == found.n_links[0] > 0
    assert found.times[0].sum() == found.n_links[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \t\n\r'sdtmlrve09.,!<|>\u00e9\u0130\u00a0\x1c\x85\u2028"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    tokens = aligner(default_vocabularies())
    whole = [x.ids for x in tokens.a.encode_batch(texts, add_special_tokens=False)]
    assert tokens.encode_a(texts) == whole


def test_planes_give_the_numbers_back():
    values = np.array([0, 1, 255, 256, 70000, 2**31], np.int64)
    assert alignment._from_planes(alignment._planes(values)).tolist() == values.tolist()
    assert len(alignment._from_planes(b"")) == 0
