import hashlib
import random
import re
import zlib

import pytest
from sql import assert_matches

from ledgerlens.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, place string"
SHOWN = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def brute(rows):
    """The contract in plain Python."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    members = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        path = (*own.get(int(conv / 20) * 20, [])[:h], *turns[h:])
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append((conv, len(path) == depth))
    children = {node: [] for node in members}
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved = (len(members[node]) - 1) * words + sum(totals[child][0] for child in children[node])
        leaves = sum(totals[child][1] for child in children[node]) or 1
        totals[node] = saved, leaves
    result = []
    for node, found in members.items():
        ends = ",".join(str(conv) for conv in sorted(conv for conv, end in found if end))
        parent = min(conv for conv, _ in members[node[:-1]]) if node else None
        result.append((
            min(conv for conv, _ in found), len(node), parent, len(found), len(children[node]),
            totals[node][1], totals[node][0], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return result


def key(row):
    return [(value is None, value or 0) if not isinstance(value, str) else (False, value) for value in row]


def check(spark, rows):
    table = spark.createDataFrame([(*row, 7, "x", "y") for row in rows], SCHEMA)
    found = conversation_trie.prefix_trie(table).select(*SHOWN).collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def some_rows(seed, conversations, longest, choices):
    rng = random.Random(seed)
    return [
        (conv, turn, rng.choice(["user", "model"]), " ".join(rng.choices(["a", "b c"], k=rng.randint(1, choices))))
        for conv in conversations
        for turn in range(rng.randint(1, longest))
    ]


def test_equals_brute_force(spark):
    check(spark, some_rows(1, range(0, 130), 6, 2))


@pytest.mark.parametrize("band,block", [(2, 4), (3, 6)])
def test_small_bands_and_blocks(spark, monkeypatch, band, block):
    monkeypatch.setattr(conversation_trie, "BAND", band)
    monkeypatch.setattr(conversation_trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(conversation_trie, "ID_BLOCK", 7)
    copies = [(conv, turn, "user", "same words") for conv in range(40, 70) for turn in range(14)]
    check(spark, some_rows(2, range(0, 40), 30, 1) + copies)


def test_odd_rows(spark):
    rows = some_rows(3, [0, 1, 2, 25, 47, 10**12, -5, -20], 5, 1)
    rows += [(None, 1, "user", "no id"), (7, None, None, None), (7, None, "user", ""), (7, 3, None, "x\t\x0by z")]
    rows += [(20, 5, "user", "again")] * 3 + [(61, -4, "user", "early"), (61, 0, "user", "café two"), (99, 1, "user", "")]
    rows += [(8, 1, "user", "word " * 50_000), (8, 2, "", "   ")]
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])


def test_given_table_equals_sql(spark, sf_dir):
    assert_matches(spark, "op12_conversation_trie", sf_dir)


def test_deep_conversation(spark):
    check(spark, [(conv, turn, "user", "t") for conv in (0, 20) for turn in range(150 + conv)])
