import hashlib
import math

import numpy as np
import pytest
from sql import assert_matches

from ledgerlens.llm import vector_codes
from ledgerlens.llm.heavy_join import attach

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, row long, part int"


def brute(rows, entries=16, rounds=6, parts=8):
    """The contract in plain Python, one vector at a time."""
    kept = [
        (vec_id, [math.floor(4096 * x) for x in vector], label)
        for vec_id, vector, label in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))
    dims = len(first[0][1]) if first else 0
    if not dims or dims % parts:
        return []
    kept = [r for r in kept if len(r[1]) == dims]
    first = [r for r in first if len(r[1]) == dims][:entries]
    width = dims // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[1], p) for r in first] for p in range(parts)]

    def nearest(p, v):
        away = [sum((a - b) ** 2 for a, b in zip(v, entry)) for entry in books[p]]
        return min(range(len(away)), key=lambda e: (away[e], e)), min(away)

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for r in kept:
                members.setdefault(nearest(p, cut(r[1], p))[0], []).append(cut(r[1], p))
            for e, vectors in members.items():
                books[p][e] = [sum(axis) // len(vectors) for axis in zip(*vectors)]
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    coded, labels = [], {}
    for vec_id, vector, label in kept:
        found = [nearest(p, cut(vector, p)) for p in range(parts)]
        error = sum(d for _, d in found)
        labels[label] = labels.get(label, 0) + error
        coded.append((vec_id, "".join(f"{e:02x}" for e, _ in found), error, label))
    return [(v, c, e, labels[label], digest) for v, c, e, label in coded]


def order(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r])


def check(spark, rows, block_rows=7):
    table = [(*row, "code", 1, 2, 3) for row in rows]
    found = vector_codes.compress(spark.createDataFrame(table, SCHEMA), block_rows=block_rows)
    assert order(map(tuple, found.collect())) == order(brute(rows))


def vectors(rng, n, dims, spread=1.0):
    return [(int(i), (rng.normal(size=dims) * spread).tolist(), int(i) % 3) for i in range(n)]


@pytest.mark.parametrize("dims", [8, 16, 24])
def test_equals_brute_force(spark, dims):
    check(spark, vectors(np.random.default_rng(dims), 150, dims))


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = vectors(rng, 60, 16)
    rows += [rows[3]] * 40 + [(3, rows[9][1], None), (None, rows[5][1], None), (500, None, 1)]
    rows += [(501, [*rows[0][1][:15], x], 1) for x in (None, math.nan, math.inf, -math.inf)]
    rows += [(502, [0.5] * 8, 1), (503, [], 1), (504, [0.0] * 16, None), (505, [-0.0001] * 16, 2)]
    check(spark, rows)


def test_few_rows_and_none(spark):
    rng = np.random.default_rng(2)
    check(spark, vectors(rng, 5, 8))
    check(spark, [])
    check(spark, [(1, None, 1)])
    check(spark, [(1, [0.5] * 9, 1), (2, [0.5] * 8, 1)])


def test_ties_go_to_the_lower_entry(spark):
    grid = [(i, [float(i % 2), float(i // 2 % 2)] * 4, 0) for i in range(64)]
    check(spark, grid, block_rows=5)


@pytest.mark.parametrize("spread", [100.0, 3e5])
def test_large_components_stay_exact(spark, spread):
    check(spark, vectors(np.random.default_rng(3), 80, 8, spread))


def test_errors_beyond_a_long_are_null(spark):
    rows = [(i, [float(i) * 1e12] * 8, i) for i in range(18)]
    found = vector_codes.compress(
        spark.createDataFrame([(*row, "", 0, 0, 0) for row in rows], SCHEMA), rounds=0
    )
    errors = {row.vec_id: row.error for row in found.collect()}
    assert errors[3] == 0 and errors[17] is None


@pytest.mark.parametrize(("axes", "bits"), [(2, 3), (3, 2), (4, 2), (1, 5)])
def test_hilbert_curve_visits_neighbours(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
    keys = vector_codes.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shortlist_keeps_every_nearest_entry():
    rng = np.random.default_rng(4)
    layout = vector_codes.Layout(8, 1, [-50] * 8, [50] * 8)
    for _ in range(50):
        book = rng.integers(-50, 50, (16, 8))
        members = rng.integers(-50, 50, 8) + rng.integers(-9, 9, (30, 8))
        assigner = vector_codes.Assigner(layout, [book.tolist()])
        some = assigner.shortlist(0, members.min(axis=0), members.max(axis=0))
        everyone = np.arange(16)
        assert (assigner.codes(0, members, some) == assigner.codes(0, members, everyone)).all()


def test_given_table_equals_sql(spark, sf_dir):
    assert_matches(spark, "op13_vector_codes", sf_dir)


def test_heavy_keys_are_joined_apart(spark):
    rows = spark.createDataFrame(
        [(i, None if i % 3 else i % 7) for i in range(300)], "id long, k long"
    )
    table = rows.groupBy(rows.k.alias("key")).count().withColumnRenamed("count", "n")
    table = table.selectExpr("key", "n", "n * 2 as twice")
    joined = attach(rows, table, {"k": "key"}, "n", most_heavy=10, least_rows=5)
    assert joined.count() == 300
    assert joined.filter("k is null").agg({"twice": "max"}).first()[0] == 400
