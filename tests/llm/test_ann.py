import math

import numpy as np
from pyspark.sql import functions as F

from brute import cosine
from ledgerlens.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def test_recall_and_scores(spark, sf_dir):
    vectors = spark.read.parquet(sf_dir.replace("sf0.01", "sf0.1") + "/embeddings.parquet")
    rows = vectors.collect()
    ids = np.array([row["vec_id"] for row in rows])
    matrix = np.array([row["embedding"] for row in rows], dtype=float)
    norms = np.linalg.norm(matrix, axis=1)
    found = {}
    for row in ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0)).collect():
        found.setdefault(row["query_id"], []).append(row)
    hits = total = 0
    for query in np.flatnonzero(ids % 50 == 0):
        score = matrix @ matrix[query] / (norms * norms[query])
        score[query] = -2
        nearest = set(ids[np.lexsort((ids, -score))[:5]])
        answer = sorted(found[ids[query]], key=lambda row: row["rank"])
        assert [row["rank"] for row in answer] == [1, 2, 3, 4, 5]
        order = [(-row["score"], row["vec_id"]) for row in answer]
        assert order == sorted(order)
        for row in answer:
            assert math.isclose(row["score"], cosine(matrix[query], matrix[ids == row["vec_id"]][0]), rel_tol=1e-12)
        hits += len(nearest & {row["vec_id"] for row in answer})
        total += 5
    assert hits / total >= 0.9


def test_shards_and_blocks_are_merged(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_PER_SHARD", 50)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 10)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    vectors = table(spark, rows)
    exact = {i: np.array(v, dtype=np.float32) for i, v in rows}
    hits = 0
    found = ann.search(vectors, vectors.filter("vec_id < 40")).collect()
    assert len(found) == 200
    for i in range(40):
        best = sorted((-cosine(exact[i], v), j) for j, v in exact.items() if j != i)[:5]
        hits += len({j for _, j in best} & {row["vec_id"] for row in found if row["query_id"] == i})
    assert hits >= 190


def test_recall_on_vectors_without_structure(spark):
    rng = np.random.default_rng(11)
    for shift in (0.0, 0.2):
        matrix = (rng.normal(size=(3000, 256)) + shift).astype(np.float32)
        vectors = table(spark, [(i, v) for i, v in enumerate(matrix.tolist())])
        found = ann.search(vectors, vectors.filter("vec_id < 60")).collect()
        assert len(found) == 300
        exact = matrix.astype(float)
        hits = 0
        for i in range(60):
            score = ann.cosines(exact, exact[i])
            score[i] = -2
            answer = {row["vec_id"] for row in found if row["query_id"] == i}
            hits += len(set(np.argsort(-score)[:5].tolist()) & answer)
        assert hits >= 285


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0]), (4, None),
        (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]),
        (100, None), (150, [0.0, 0.0]), (10, []),
    ]
    vectors = table(spark, rows)
    found = ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0)).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [
        (50, 1, 1, 1.0), (50, 2, 2, 1.0), (50, 3, 3, 0.0)
    ]
    assert ann.search(vectors.limit(0), vectors.limit(0)).collect() == []
    assert ann.search(vectors, vectors.limit(0)).collect() == []
