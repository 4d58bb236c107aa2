import numpy as np
import pytest

from brute import Groups, cosine
from ledgerlens.llm import embedding_join

SCHEMA = "vec_id long, embedding array<float>, label int, copies int"


def check(spark, rows, threshold=0.93):
    df = spark.createDataFrame([(i, v, l, 1) for i, v, l in rows], SCHEMA)
    usable = [
        (i, np.array(v, dtype=np.float32).astype(float), l)
        for i, v, l in rows
        if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    groups, links = Groups({i for i, _, _ in usable}), {}
    for a in range(len(usable)):
        for b in range(a):
            (i, v, k), (j, w, m) = usable[a], usable[b]
            if k == m and len(v) == len(w) and cosine(v, w) >= threshold:
                links[a] = links.get(a, 0) + 1
                links[b] = links.get(b, 0) + 1
                groups.link(i, j)
    expected = sorted((i, links.get(n, 0), groups.root(i)) for n, (i, _, _) in enumerate(usable))
    found = embedding_join.near_duplicates(df, threshold).collect()
    assert len(found) == len(rows)
    used = {i for i, _, _ in usable}
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found if r["vec_id"] in used) == expected
    for row in found:
        if row["vec_id"] not in used:
            assert row["n_links"] == 0 and row["component_id"] == row["vec_id"]
        assert row["kept"] == (None if row["vec_id"] is None else row["vec_id"] == row["component_id"])


def test_same_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "ROWS_PER_BLOCK", 24)
    monkeypatch.setattr(embedding_join, "SMALL_INTERVAL", 8)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        centre = np.random.default_rng(i % 9).normal(size=8)
        rows.append((i, [float(x) for x in centre + rng.normal(size=8) * 0.22], i % 2))
    check(spark, rows)
    check(spark, rows, 0.8)


def test_one_vector_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(5)
    same = [float(x) for x in rng.normal(size=6)]
    rows = [(i, same if i % 3 == 0 else [float(x) for x in rng.normal(size=6)], 1) for i in range(90)]
    check(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (None, [1.0, 0.0], 1),
        (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.01, 0.0], 1), (12, [], 1), (13, [5.0], 3), (14, [2.0], 3),
    ]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0], 1)]])
def test_tiny_tables(spark, rows):
    check(spark, rows)
