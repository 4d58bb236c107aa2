import math
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import duplicates
from ledgerlens.operators.duplicates import rank_copies
from ledgerlens.operators.quality import (
    bad_rows,
    check_results,
    clean_rows,
    quality_totals,
    quarantine,
    score_quality,
)
from ledgerlens.operators.silver import silver_transactions
from ledgerlens.schema import QUALITY_CHECKS, RAW_COLUMNS
from ledgerlens.sources.scratch import Scratch

TYPED = (
    "source_row_number int, step int, type string, amount double, nameOrig string, "
    "oldbalanceOrg double, newbalanceOrig double, nameDest string, oldbalanceDest double, "
    "newbalanceDest double, isFraud int, isFlaggedFraud int, step_day int, "
    "ingested_at timestamp, source_file string"
)
TEXT = "source_row_number string, " + ", ".join(f"{name} string" for name in RAW_COLUMNS) + (
    ", step_day int, ingested_at timestamp, source_file string"
)


def bronze(spark, rows, schema=TYPED):
    return spark.createDataFrame([(*row, 1, None, "t.csv") for row in rows], schema)


def issues_of(scored):
    return {
        row["source_row_number"]: [issue for issue in row["quality_issues"].split(",") if issue]
        for row in scored.collect()
    }


FOUR_ROWS = [
    (1, 1, "PAYMENT", 100.0, "C1", 200.0, 100.0, "M1", 0.0, 0.0, 0, 0),
    (2, 1, "WIRE", -5.0, "", -1.0, 0.0, None, 0.0, 0.0, 2, 0),
    (3, 2, "TRANSFER", 50.0, "C2", 50.0, 0.0, "C3", 0.0, 50.0, 1, 0),
    (4, 2, "TRANSFER", 50.0, "C2", 50.0, 0.0, "C3", 0.0, 50.0, 1, 0),
]


def test_bad_rows_and_duplicates_are_found(spark):
    scored = score_quality(bronze(spark, FOUR_ROWS))
    assert issues_of(scored) == {
        1: [],
        2: [
            "amount_not_positive",
            "invalid_transaction_type",
            "missing_sender_account",
            "missing_receiver_account",
            "invalid_fraud_flag",
            "negative_or_null_balance",
        ],
        3: [],
        4: ["duplicate_transaction"],
    }
    totals = quality_totals(scored).first()
    assert (totals["total_rows"], totals["quarantine_rows"]) == (4, 2)
    results = {row["check_name"]: row for row in check_results(scored).collect()}
    assert list(results) == list(QUALITY_CHECKS)
    assert results["valid_flagged_fraud_flag"]["status"] == "PASS"
    assert results["duplicate_transaction"]["failed_rows"] == 1
    from_quarantine = check_results(quarantine(scored), total_rows=4)
    assert sorted(from_quarantine.collect()) == sorted(results.values())


def test_text_columns_are_read_tolerantly(spark):
    good = ("9", "1", "PAYMENT", "1", "C1", "0", "0", "M1", "0", "0", "0", "0")

    def row(number, **changes):
        names = ("source_row_number", *RAW_COLUMNS)
        return tuple(changes.get(name, value) for name, value in zip(names, (number, *good[1:])))

    rows = [
        row("1", amount="abc"),
        row("2", amount=""),
        row("3", amount="nan"),
        row("4", isFraud="1.5"),
        row("5", isFraud="0.6"),
        row("6", step=None),
        row("7", step="0"),
        row("8", type=" payment "),
        row("9", nameOrig="\t"),
        row("10", step="2.5"),
        row("11", oldbalanceOrg="x"),
        row("12", amount="1e3"),
    ]
    scored = score_quality(bronze(spark, rows, TEXT)).cache()
    issues = issues_of(scored)
    assert issues["1"] == issues["2"] == ["amount_not_positive"]
    assert issues["3"] == []  # NaN is greater than zero
    assert issues["4"] == ["invalid_fraud_flag"]  # rounds to 2
    assert issues["5"] == []  # rounds to 1
    assert issues["6"] == issues["7"] == issues["8"] == issues["9"] == issues["12"] == []
    assert issues["11"] == ["negative_or_null_balance"]
    silver = {row["source_row_number"]: row for row in silver_transactions(scored).collect()}
    assert silver["6"]["transaction_day"] is None and silver["6"]["transaction_hour"] is None
    assert silver["7"]["transaction_day"] == 0 and silver["7"]["transaction_hour"] == -1
    assert silver["8"]["transaction_type"] == "PAYMENT"
    assert silver["10"]["transaction_step"] == 3
    assert math.isnan(silver["3"]["amount"])
    assert silver["5"]["is_fraud"] is True
    scored.unpersist()


def test_twins_in_other_spelling_share_an_id_but_are_no_duplicates(spark):
    row = FOUR_ROWS[2]
    twins = [row, (5, row[1], " transfer ", *row[3:])]
    silver = silver_transactions(score_quality(bronze(spark, twins))).collect()
    assert len(silver) == 2 and silver[0]["transaction_id"] == silver[1]["transaction_id"]


def test_null_and_empty_text_are_the_same_duplicate_key(spark):
    first = (1, 1, "PAYMENT", 1.0, "C1", 0.0, 0.0, None, 0.0, 0.0, 0, 0)
    second = (2, *first[1:7], "", *first[8:])
    assert issues_of(score_quality(bronze(spark, [first, second])))[2] == [
        "missing_receiver_account",
        "duplicate_transaction",
    ]


def test_empty_input(spark):
    scored = score_quality(bronze(spark, []))
    assert scored.count() == 0
    assert {row["failed_rows"] for row in check_results(scored).collect()} == {0}
    assert quality_totals(scored).first()["total_rows"] == 0


@pytest.mark.parametrize("rows_per_block", [1, 7, 1000])
def test_a_hot_group_of_copies_is_ranked_block_by_block(spark, rows_per_block):
    """A third of the rows are one record; ranks equal those of a plain count in Python."""
    rows = []
    for i in range(300):
        value = "hot" if i % 3 == 0 else f"v{i % 50}" if i % 3 == 1 else f"u{i}"
        rows.append((300 - i, value, i))
    df = spark.createDataFrame(rows, "n long, k string, i int").repartition(5)
    ranked = rank_copies(df, ("k",), "n", Scratch(spark, "t"), rows_per_block)
    assert ranked.columns == ["n", "k", "i", "duplicate_count", "duplicate_rank"]
    expected = []
    for n, value, i in rows:
        group = sorted(m for m, other, _ in rows if other == value)
        expected.append((n, value, i, len(group), group.index(n) + 1))
    assert sorted(tuple(row) for row in ranked.collect()) == sorted(expected)


def test_rows_without_number_rank_last_and_only_once(spark):
    rows = [(None, "a", i) for i in range(40)] + [(3, "a", 100), (1, "a", 101)]
    df = spark.createDataFrame(rows, "n long, k string, i int").repartition(3)
    ranked = rank_copies(df, ("k",), "n", Scratch(spark, "t"), 10).collect()
    assert sorted(row["duplicate_rank"] for row in ranked) == list(range(1, 43))
    by_i = {row["i"]: row["duplicate_rank"] for row in ranked}
    assert (by_i[101], by_i[100]) == (1, 2)


def test_equal_hashes_do_not_make_duplicates(spark, monkeypatch):
    monkeypatch.setattr(duplicates.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n long, k string")
    ranked = {
        row["n"]: (row["duplicate_count"], row["duplicate_rank"])
        for row in rank_copies(df, ("k",), "n", Scratch(spark, "t")).collect()
    }
    assert ranked == {1: (2, 1), 2: (1, 1), 3: (2, 2)}


def test_large_repeated_list_is_joined_without_broadcast(spark, sf_dir):
    """The way beyond the broadcast limit gives the same rows."""
    from ledgerlens.sources.events import transactions_from_events

    bronze_rows = transactions_from_events(spark, sf_dir)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    columns = ["source_row_number", "duplicate_rank", "duplicate_count", "quality_issues"]
    with_broadcast = sorted(score_quality(bronze_rows).select(*columns).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        without = sorted(score_quality(bronze_rows).select(*columns).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert with_broadcast == without and len(without) == 10044


def test_one_wide_shuffle_without_broadcasts(spark, tmp_path):
    """Only the rows the filter knows are shuffled, once; all others stay where they are."""
    rows = [(n, f"k{n % 700}" if n < 1400 else f"u{n}", f"wide{n}") for n in range(3000)]
    spark.createDataFrame(rows, "n long, k string, payload string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ranked = rank_copies(df, ("k",), "n", Scratch(spark, "t"), rows_per_block=100)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        formatted = ranked._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        found = sorted(ranked.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan  # with the filter, whose size is bounded
    exchanges = [
        part for part in formatted.split("\n\n") if re.match(r"\s*\(\d+\) Exchange", part)
    ]
    wide = [part for part in exchanges if "payload" in part]
    assert len(wide) == 1 and "hashpartitioning(key_hash" in wide[0] and "block" in wide[0]
    groups = {}
    for n, k, _ in rows:
        groups.setdefault(k, []).append(n)
    assert [(r["n"], r["duplicate_count"], r["duplicate_rank"]) for r in found] == [
        (n, len(groups[k]), groups[k].index(n) + 1) for n, k, _ in rows
    ]


@pytest.mark.parametrize("words", [1, 2, 64])
def test_a_full_filter_changes_nothing(spark, monkeypatch, words):
    monkeypatch.setattr(duplicates, "FILTER_WORDS", words)
    rows = [(n, f"k{n % 90}" if n % 2 else f"u{n}") for n in range(400)]
    df = spark.createDataFrame(rows, "n long, k string")
    ranked = rank_copies(df, ("k",), "n", Scratch(spark, "t"), 50).collect()
    groups = {}
    for n, k in rows:
        groups.setdefault(k, []).append(n)
    assert sorted((r["n"], r["duplicate_count"], r["duplicate_rank"]) for r in ranked) == [
        (n, len(groups[k]), groups[k].index(n) + 1) for n, k in rows
    ]


def test_clean_and_bad_rows_are_everything(spark, sf_dir):
    from ledgerlens.sources.events import transactions_from_events

    scored = score_quality(transactions_from_events(spark, sf_dir))
    assert (clean_rows(scored).count(), bad_rows(scored).count()) == (9755, 289)


def test_key_text_decides_equality(spark):
    """0.0 and -0.0 differ in text, NaN equals NaN, NULL equals NULL."""
    values = [0.0, -0.0, 0.0, float("nan"), float("nan"), None, None, 1.5, 1.5, 2.5]
    rows = [(n, value, None if n % 2 else "") for n, value in enumerate(values)]
    df = spark.createDataFrame(rows, "n long, x double, t string")
    ranked = rank_copies(df, ("x", "t"), "n", Scratch(spark, "t"))
    found = {row["n"]: (row["duplicate_count"], row["duplicate_rank"]) for row in ranked.collect()}
    assert found == {
        0: (2, 1), 1: (1, 1), 2: (2, 2), 3: (2, 1), 4: (2, 2), 5: (2, 1), 6: (2, 2), 7: (2, 1),
        8: (2, 2), 9: (1, 1),
    }


@pytest.mark.parametrize("rows_per_block", [1, 1_000_000])
def test_writers_of_a_layout_do_not_rank_again(spark, rows_per_block):
    """Groups ranked whole or by block, rows with a repeated number or none included."""
    rows = [(n if n % 9 else None, f"k{n % 40}" if n % 3 else f"u{n}", n % 4, n) for n in range(600)]
    rows += [(1, "k1", 1, 600), (None, None, 0, 601), (7, "", 3, 602)]
    df = spark.createDataFrame(rows, "n long, k string, day int, i int").repartition(4)
    ranked = rank_copies(df, ("k",), "n", Scratch(spark, "t"), rows_per_block, layout="day")
    assert "Window" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    groups = {}
    for row in ranked.collect():
        groups.setdefault(row["k"] or "", []).append(row)
    assert sorted(row["i"] for group in groups.values() for row in group) == list(range(603))
    for group in groups.values():
        group.sort(key=lambda row: row["duplicate_rank"])
        assert [row["duplicate_rank"] for row in group] == list(range(1, len(group) + 1))
        assert {row["duplicate_count"] for row in group} == {len(group)}
        numbers = [math.inf if row["n"] is None else row["n"] for row in group]
        assert numbers == sorted(numbers)
