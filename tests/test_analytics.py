import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import accounts, analytics, gold, rules, silver
from ledgerlens.sources.scratch import Scratch

SILVER = (
    "transaction_id string, transaction_step int, transaction_day int, transaction_hour int, "
    "transaction_type string, amount double, sender_account string, receiver_account string, "
    "sender_old_balance double, sender_new_balance double, receiver_old_balance double, "
    "receiver_new_balance double, is_fraud boolean, is_flagged_fraud boolean, "
    "source_row_number long, ingested_at timestamp, source_file string"
)


def transactions(spark, rows):
    """rows: (type, amount, sender, receiver, old, new, receiver_old, fraud, flagged)"""
    full = [
        (
            f"id{n}", n, (n + 23) // 24, (n - 1) % 24, kind, amount, sender, receiver, old, new,
            receiver_old, 0.0, fraud, flagged, n, None, "t.csv",
        )
        for n, (kind, amount, sender, receiver, old, new, receiver_old, fraud, flagged)
        in enumerate(rows, start=1)
    ]
    return spark.createDataFrame(full, SILVER)


ROWS = [
    ("TRANSFER", 100.0, "C1", "C2", 100.0, 0.0, 0.0, True, True),
    ("TRANSFER", 96.0, "C1", "C2", 100.0, 0.0, 5.0, True, False),
    ("CASH_OUT", 94.0, "C3", "M1", 100.0, 0.0, 5.0, False, False),
    ("PAYMENT", 10.0, "C4", "M1", 50.0, 40.0, 0.0, False, False),
    ("DEBIT", 5.0, "C5", "C5", 9.0, 4.0, 1.0, False, True),
]


def test_type_selection(spark):
    df = transactions(spark, ROWS)
    assert analytics.filter_transactions(df, 1, 1).count() == 5
    assert analytics.filter_transactions(df, 1, 1, ("DEBIT", "NONSENSE")).count() == 1
    assert analytics.filter_transactions(df, 1, 1, ("NONSENSE",)).count() == 0
    assert analytics.filter_transactions(df, 1, 1, ()).count() == 0
    assert analytics.filter_transactions(df, 2, 9).count() == 0


def test_signals(spark):
    found = {row["signal"]: row for row in analytics.behavior_signals(transactions(spark, ROWS)).collect()}
    drained = found["Sender drained to zero"]
    assert (drained["signal_transactions"], drained["signal_frauds"]) == (2, 2)
    assert (drained["fraud_lift"], drained["fraud_capture_pct"]) == (2.5, 100.0)
    assert found["Amount equals prior sender balance"]["signal_transactions"] == 1
    assert found["Receiver is customer account"]["signal_transactions"] == 3
    assert found["Receiver starts with zero balance"]["signal_transactions"] == 2
    assert found["Source isFlaggedFraud rule"]["signal_frauds"] == 1
    assert found["Top 1% amount"]["signal_transactions"] == 1


def test_signals_nobody_shows_are_absent(spark):
    plain = [("PAYMENT", 10.0, "C4", "M1", 50.0, 40.0, 3.0, False, False)]
    rows = analytics.behavior_signals(transactions(spark, plain)).collect()
    assert [row["signal"] for row in rows] == ["Top 1% amount"]
    assert rows[0]["fraud_lift"] is None and rows[0]["fraud_capture_pct"] is None


def test_no_fraud_gives_nulls(spark):
    df = transactions(spark, ROWS[2:])
    by_type = analytics.type_risk(df).collect()
    assert {row["fraud_lift"] for row in by_type} == {None}
    assert {row["avg_fraud_amount"] for row in by_type} == {None}
    daily = gold.fraud_summary_daily(gold.activity(df)).first()
    assert daily["avg_fraud_amount"] is None and daily["fraud_amount"] == 0.0
    assert analytics.account_risk(df).count() == 0
    assert rules.source_flag_performance(df).first()["recall_pct"] is None


def test_empty_input(spark):
    df = transactions(spark, [])
    overview = analytics.overview_metrics(df).first()
    assert overview["total_transactions"] == 0 and overview["fraud_rate_pct"] == 0.0
    assert overview["fraud_transactions"] is None and overview["p99_amount"] is None
    for empty in (
        analytics.type_risk(df), analytics.daily_trend(df), analytics.hourly_heatmap(df),
        analytics.behavior_signals(df), analytics.amount_decile_risk(df),
        analytics.account_risk(df), rules.suspicious_transactions(df),
        gold.large_transaction_alerts(df), gold.hourly_fraud_trend(gold.activity(df)),
    ):
        assert empty.count() == 0
    row = rules.rule_performance(df).first()
    assert row["amount_threshold"] is None and row["alerts"] is None and row["f1_pct"] is None


def test_rule_edge_cases(spark):
    df = transactions(spark, ROWS)
    rule = rules.AlertRule(percentile=0.90, types=("TRANSFER",))
    row = rules.rule_performance(df, rule).first()
    assert (row["alerts"], row["true_positives"], row["false_negatives"]) == (1, 1, 1)
    assert (row["precision_pct"], row["recall_pct"], row["f1_pct"]) == (100.0, 50.0, 66.67)
    assert row["fraud_amount_captured"] == 100.0 and row["fraud_amount_recall_pct"] == 51.02

    none = rules.rule_performance(df, rules.AlertRule(types=())).first()
    assert (none["alerts"], none["precision_pct"], none["f1_pct"]) == (0, None, None)
    assert none["recall_pct"] == 0.0 and none["false_negatives"] == 2

    misses = rules.AlertRule(types=("DEBIT",), percentile=0.0, require_sender_drained=False)
    row = rules.rule_performance(df, misses).first()
    assert (row["alerts"], row["false_positives"], row["precision_pct"]) == (1, 1, 0.0)
    assert row["f1_pct"] is None  # zero precision and recall

    loose = rules.AlertRule(percentile=0.0, require_sender_drained=False, require_customer_receiver=True)
    assert rules.rule_performance(df, loose).first()["alerts"] == 2


def test_confusion_adds_up(spark):
    performance = rules.source_flag_performance(transactions(spark, ROWS))
    counts = {row["outcome"]: row["transactions"] for row in rules.confusion(performance).collect()}
    assert counts == {"True positives": 1, "False positives": 1, "False negatives": 1}


def test_a_transfer_to_oneself_counts_twice(spark):
    metrics = accounts.account_metrics(accounts.account_events(transactions(spark, ROWS)))
    row = silver.silver_accounts(metrics).filter("account_id = 'C5'").first()
    assert (row["total_transactions_touched"], row["total_amount_touched"]) == (2, 10.0)
    assert (row["sent_transactions"], row["received_transactions"]) == (1, 1)


def test_money_totals_are_exact_and_keep_nan(spark):
    from ledgerlens.functions.measures import Money

    rows = [("a", 0.1)] * 10 + [("a", 1e11), ("b", 1e300), ("b", 1.5), ("c", float("nan"))]
    rows += [("c", 1.0), ("d", None), ("e", -0.3), ("e", 0.1), ("e", 0.2)]
    df = spark.createDataFrame(rows, "k string, x double")
    money = Money.measured(df, "x")
    totals = {
        row["k"]: row["total"]
        for row in money.on(df).groupBy("k").agg(money.total().alias("total")).collect()
    }
    assert totals["a"] == 100000000001.0 and totals["b"] == 1e300 and totals["e"] == 0.0
    assert totals["c"] != totals["c"] and totals["d"] is None
    assert money.on(df).filter("k = 'd'").agg(money.mean()).first()[0] is None


def test_double_text(spark):
    from ledgerlens.functions.casts import double_text

    expected = {
        100.0: "100.0", 0.0: "0.0", -5.25: "-5.25", 1e7: "10000000.0",
        92445516.64: "92445516.64", 0.0005: "0.0005", 123456789012.5: "123456789012.5",
        9999999.5: "9999999.5",
    }
    df = spark.createDataFrame([(x,) for x in expected], "x double")
    assert {row[0]: row[1] for row in df.select("x", double_text(F.col("x"))).collect()} == expected


def test_account_ranking_on_skewed_data(spark):
    """One merchant receives a third of everything; compared with plain Python."""
    rows = []
    for i in range(900):
        receiver = "M0" if i % 3 == 0 else f"C{i % 40}"
        fraud = i % 7 == 0
        rows.append(
            ("TRANSFER", float(i % 50 + 1), f"C{i % 60}", receiver, 10.0, 0.0, 0.0, fraud, False)
        )
    ranked = analytics.account_risk(transactions(spark, rows), limit=20).collect()

    fraud_amounts, touched, frauds, sent = {}, {}, {}, {}
    for _, amount, sender, receiver, _, _, _, fraud, _ in rows:
        for account in (sender, receiver):
            touched[account] = touched.get(account, 0) + 1
            frauds[account] = frauds.get(account, 0) + fraud
            fraud_amounts[account] = fraud_amounts.get(account, 0.0) + amount * fraud
        sent[sender] = sent.get(sender, 0) + 1

    def score(account):
        rate = round(100 * frauds[account] / touched[account], 4)
        return round(
            40 * frauds[account] + min(fraud_amounts[account] / 100000, 75)
            + min(2 * rate, 50) + (0 if sent.get(account) else 5), 2,
        )

    risky = [account for account in frauds if frauds[account]]
    by_risk = sorted(risky, key=lambda a: (-score(a), -fraud_amounts[a], a))[:20]
    assert [row["account_id"] for row in ranked] == by_risk
    assert [row["risk_rank"] for row in ranked] == list(range(1, 21))
    by_loss = sorted(risky, key=lambda a: (-fraud_amounts[a], a))
    total = sum(fraud_amounts[a] for a in risky)
    for row in ranked:
        upto = by_loss[: by_loss.index(row["account_id"]) + 1]
        share = 100 * sum(fraud_amounts[a] for a in upto) / total
        assert row["cumulative_loss_pct"] == pytest.approx(share, abs=0.0051)
    assert ranked[0]["total_transactions_touched"] == touched[by_risk[0]]


def test_high_risk_accounts_agree_with_all_account_metrics(spark):
    df = transactions(spark, ROWS)
    every = gold.high_risk_accounts(accounts.account_metrics(accounts.account_events(df)))
    narrowed = gold.high_risk_accounts(accounts.fraud_account_metrics(df))
    assert every.collect() == narrowed.collect()
    assert [row["account_id"] for row in every.collect()] == ["C1", "C2"]
