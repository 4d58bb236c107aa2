import random

import numpy as np
import pytest

from brute import Groups, overlap, shingles
from ledgerlens.llm import bag_minhash, near_dedup
from ledgerlens.llm.components import components
from ledgerlens.sources.scratch import Scratch

SCHEMA = "doc_id long, text string, weight string, digest string"


def expected(rows):
    rows = {i: t for i, t in rows}
    bags = {i: shingles(t) for i, t in rows.items() if t and t.split()}
    groups, ids = Groups(rows), sorted(bags)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sum(bags[i].values()), sum(bags[j].values())
            if min(a, b) >= 0.8 * max(a, b) and groups.root(i) != groups.root(j) and overlap(bags[i], bags[j]) >= 0.8:
                groups.link(i, j)
    return {i: groups.root(i) for i in rows}


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "w", "d") for i, t in rows], SCHEMA)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["kept"] == (row["doc_id"] is None or row["doc_id"] == row["component_id"])
    return {row["doc_id"]: row["component_id"] for row in found}


def test_same_as_all_pairs(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert run(spark, rows) == expected(rows)


def family(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    texts = []
    for i in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(words)] = f"e{seed}_{i}_{rng.randint(0, 99)}"
        texts.append(" ".join(copy))
    return texts


def test_large_group_of_near_copies_and_groups_just_below(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    texts = family(120, 300, 3, 1) + family(60, 200, 8, 2) + family(60, 200, 4, 3)
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    assert run(spark, rows) == expected(rows)


def test_nulls_empty_short_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "two one"), (None, "one two"), (7, "same " * 3000), (8, "same " * 2900), (9, "same " * 1000)]
    assert run(spark, rows) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, None: None, 7: 7, 8: 7, 9: 9}
    docs = spark.createDataFrame([(4, "one two", "w", "d")] * 2 + [(5, "x y z", "w", "d")], SCHEMA)
    assert {r["component_id"] for r in near_dedup.near_duplicates(docs).collect()} == {4, 5}
    kept = near_dedup.distinct_documents(spark.createDataFrame([(i, t, "w", "d") for i, t in rows], SCHEMA))
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_signatures_estimate_weighted_overlap():
    hashes, misses = bag_minhash.WordHashes(), []
    for seed in range(40):
        rng = np.random.default_rng(seed)
        texts = [[f"{seed}_{i}" for i in rng.integers(0, 3, 300)] for _ in range(2)]
        bags = [bag_minhash.shingle_hashes(hashes.of(t)) for t in texts]
        signature = bag_minhash.signatures(bag_minhash.Bags.of(bags))
        assert np.isfinite(signature).all()
        exact = bag_minhash.similarity(*[bag_minhash.items(b) for b in bags])
        assert exact == pytest.approx(overlap(shingles(" ".join(texts[0])), shingles(" ".join(texts[1]))))
        misses.append((signature[0] == signature[1]).mean() - exact)
    assert abs(np.mean(misses)) < 0.02


def test_packing():
    numbers = np.array([0, 1, 2**47, 2**48 - 1], dtype=np.uint64)
    assert (bag_minhash.unpacked(bag_minhash.packed(numbers)) == numbers).all()


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500)]
    groups = Groups(range(600))
    for a, b in edges:
        groups.link(a, b)
    found = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"))
    rows = {row["node"]: row["component"] for row in found.collect()}
    assert rows == {n: groups.root(n) for n in {x for e in edges for x in e if e[0] != e[1]}}
