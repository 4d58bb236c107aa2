import re

import pytest

from ledgerlens.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, size int"


def rows_of(df):
    return [row.asDict() for row in df.collect()]


def expected_targets(sizes):
    """Targets by literally resharing what is above the limit."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


def test_targets_and_copies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = rows_of(mixing.mix(docs))
    texts = {row["doc_id"]: row for row in docs.collect()}
    assert sorted(row["doc_id"] for row in found) == sorted(texts)
    sizes, taken = {}, {}
    for row in found:
        doc = texts[row["doc_id"]]
        assert row["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", doc["text"] or ""))
        assert 0 <= row["taken"] <= 2 * row["size"] and row["taken"] == row["copies"] * row["size"]
        sizes[doc["source"]] = sizes.get(doc["source"], 0) + row["size"]
        taken[doc["source"]] = taken.get(doc["source"], 0) + row["taken"]
    target = expected_targets(sizes)
    for row in found:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]], rel=1e-9)
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.05)
    again = rows_of(mixing.mix(docs.repartition(3)))
    key = lambda row: row["doc_id"]
    assert sorted(again, key=key) == sorted(found, key=key)


def test_rates_meet_the_constraints_before_rounding(spark, sf_dir):
    sums = {}
    for row in rows_of(mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))):
        assert 0.0 <= row["rate"] <= 2.0
        entry = sums.setdefault(row["source"], [0.0, row["target"]])
        entry[0] += row["rate"] * row["size"]
    for found, target in sums.values():
        assert found == pytest.approx(target, rel=1e-6)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    data = [
        (1, "a b c", "x", "t", 9), (1, "a b c", "x", "t", 9), (None, "a  b\tc", None, "t", 9),
        (2, None, "x", None, None), (3, "", None, "t", 9), (4, "a b c", "y", "t", 9), (5, " \n", "z", "t", 9),
    ]
    docs = spark.createDataFrame(data, SCHEMA)
    found = rows_of(mixing.mix(docs))
    assert len(found) == len(data)
    assert all(row["taken"] <= 2 * row["size"] for row in found)
    assert {row["target"] for row in found if row["source"] == "z"} == {0.0}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(row["copies"] for row in found)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(mixing.mix(empty)) == [] and mixing.mixed_documents(empty).count() == 0
