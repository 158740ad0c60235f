"""The trie of rebuilt conversations against a walk over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from panelwright.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, node int, _row int"


def by_hand(rows):
    """Rows of the contract from (conv_id, turn, role, text); turns with equal numbers by the hash that orders them."""
    def key(role, text):
        role, text = (role or "").encode(), (text or "").encode()
        return hashlib.sha256(str(len(role)).encode() + b":" + role + text).digest()[:16]

    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, key(role, text), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, who in members.items():
        listed = ",".join(map(str, sorted(ends.get(p, [])))).encode()
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
                    hashlib.sha256(listed).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "d", 1, 2) for r in rows], SCHEMA).repartition(4)
    found = pt.prefix_trie(df, **sizes)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r) for r in found.select(*names).collect()], key=repr)


def random_rows(rnd, convs, most, words):
    rows = []
    for c in rnd.sample(range(-20, 5 * convs), convs):
        for turn in range(rnd.randint(1, most)):
            rows.append((c, turn, rnd.choice(["user", "assistant"]), rnd.choice(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_all_prefixes(spark, seed):
    rnd = random.Random(seed)
    rows = random_rows(rnd, 60, 14, ["a", "bé", "", "ccc"])
    assert run(spark, rows, window=4, shard_turns=30) == by_hand(rows)


def test_odd_conversations(spark):
    rows = [
        (0, None, None, None), (0, 0, "user", "hello"), (0, 0, "user", "hello"), (0, 0, "assistant", "é" * 50000),
        (1, 3, "user", ""), (2, 3, None, ""), (3, -1, "", "x"), (3, None, "", "x"), (4, 1, "u", "t"), (None, 1, "u", "t"),
        (10, 1, "u", None), (7, 1, "1:u", "t"), (8, 1, "1:", "ut"), (2**62, 1, "u", "t"), (-6, 1, "u", "t"),
    ]
    assert run(spark, rows) == by_hand(rows)


def test_one_long_conversation_and_its_copy(spark):
    rnd = random.Random(3)
    long = [rnd.choice("ab") for _ in range(700)]
    rows = [(c, i, "user", t) for c in (5, 10) for i, t in enumerate(long)] + [(c, 0, "user", "a") for c in range(20, 40)]
    rows.append((10, 700, "user", "more"))
    assert run(spark, rows, window=64, shard_turns=500) == by_hand(rows)


def test_many_conversations_end_at_one_node(spark):
    rows = [(c, t, "user", "same") for c in range(0, 900) for t in range(9)]
    assert run(spark, rows, shard_turns=400) == by_hand(rows)


def test_no_conversations(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert run(spark, [(None, 1, "u", "t")]) == []
