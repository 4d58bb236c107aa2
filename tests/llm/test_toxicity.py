import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import toxicity

DOCS = "doc_id long, text string, severity string"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.01", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    fitted = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    rows = (
        toxicity.with_severity(docs, fitted).join(labels.filter("doc_id % 2 = 1"), "doc_id")
        .select("toxic", (F.col("severity") >= toxicity.REJECT_AT).alias("found")).collect()
    )
    toxic = [row["found"] for row in rows if row["toxic"]]
    clean = [row["found"] for row in rows if not row["toxic"]]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.03


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    grade = np.digitize(x @ [2.0, -1.0, 0.0] + rng.logistic(size=600) * 0.3, [-1.0, 0.5, 2.0])
    weights, thresholds = toxicity.fit_ordinal(x, grade)
    assert weights[0] > 0 > weights[1] and abs(weights[2]) < 0.3 * weights[0]
    assert list(thresholds) == sorted(thresholds) and len(thresholds) == 3
    model = toxicity.SeverityModel([], weights, thresholds)
    severity = model.expected(x @ weights)
    assert np.corrcoef(severity, grade)[0, 1] > 0.85
    assert severity.min() >= 0 and severity.max() <= 3


def small(spark):
    docs = [(i, "you idiot scum " * (1 + i % 3) + f"word{i}", "s") for i in range(12)]
    docs += [(i, f"a friendly word{i} here", "s") for i in range(12, 40)]
    labels = [(i, 1, int(i < 12)) for i in range(40)]
    odd = [(100, None, None), (101, "", "s"), (None, "idiot scum", "s"), (102, "idiot scum " * 5000, "s"), (0, docs[0][1], "s")]
    return (
        spark.createDataFrame(docs + odd, DOCS),
        spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (999, 1, 1)], LABELS),
    )


def test_nulls_long_and_repeated_texts(spark):
    docs, labels = small(spark)
    rows = toxicity.grade_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    found = {row["doc_id"]: row for row in rows}
    assert all(found[i]["toxic"] for i in (*range(12), None, 102))
    assert not any(found[i]["toxic"] for i in (*range(12, 40), 100, 101))
    assert found[100]["severity"] == found[101]["severity"] < 0.5
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 28 + 2


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0)]])
def test_without_both_classes_nothing_is_toxic(spark, labels):
    docs, _ = small(spark)
    rows = toxicity.grade_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert {row["severity"] for row in rows} == {0.0}


def test_empty_table(spark):
    docs, labels = small(spark)
    assert toxicity.grade_documents(docs.limit(0), labels).collect() == []
