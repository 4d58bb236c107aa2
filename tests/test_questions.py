import pytest

import __spark_entry__ as registered
from ledgerlens.operators import analytics, rules, selection
from ledgerlens.operators.questions import Questions, account_sketches, amount_slices
from test_analytics import transactions


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return registered._lake(spark, sf_dir)


@pytest.fixture
def asked(lake):
    return Questions.on(lake, 5, 20, ("CASH_OUT", "TRANSFER"))


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_same_values_as_without_the_handle(asked):
    rows = asked.transactions
    fractions = (0.0, 0.25, 0.9, 0.95, 0.99, 0.995, 1.0)
    assert asked.quantiles(fractions) == selection.exact_quantiles(rows, "amount", fractions)
    assert asked.row_count() == rows.count()
    assert asked.behavior_signals().collect() == analytics.behavior_signals(rows).collect()
    assert asked.amount_decile_risk().collect() == analytics.amount_decile_risk(rows).collect()
    assert asked.suspicious_transactions().collect() == rules.suspicious_transactions(rows).collect()
    found, plain = asked.overview_metrics().first(), analytics.overview_metrics(rows).first()
    assert list(found.asDict()) == list(plain.asDict())
    for side in ("approx_senders", "approx_receivers"):
        assert found[side] == pytest.approx(plain[side], rel=0.1)


def test_four_questions_cost_one_search(spark, asked):
    def ask():
        return [
            asked.overview_metrics(),
            asked.behavior_signals(),
            asked.rule_performance(rules.AlertRule(percentile=0.95)),
            asked.suspicious_transactions(),
        ]

    _, search = jobs_of(spark, "search", lambda: asked.quantiles((0.99,)))
    frames, questions = jobs_of(spark, "questions", ask)
    assert search > 0 and questions == 0 and len(frames) == 4


def test_search_reads_only_slices_that_hold_a_rank(asked, monkeypatch):
    passes = []
    count_parts = selection._count_parts

    def spy(df, x, slots):
        passes.append(len(slots))
        return count_parts(df, x, slots)

    monkeypatch.setattr(selection, "_count_parts", spy)
    asked.quantiles((0.99,))
    # the slices replace the pass over everything; one narrow pass counts single values
    assert len(passes) == 1


def test_slices_of_a_skewed_column(spark):
    rows = [("TRANSFER", 50.0 if n % 3 else 10.0 + n, "C1", "C2", 1.0, 0.0, 0.0, n % 7 == 0, False) for n in range(300)]
    rows += [("DEBIT", float("nan"), "C1", "C2", 1.0, 0.0, 0.0, False, False)]
    df = transactions(spark, rows)
    asked = Questions(df, amount_slices(df), account_sketches(df), 1, 99)
    fractions = (0.1, 0.5, 0.95, 0.99)
    assert asked.quantiles(fractions) == selection.exact_quantiles(df, "amount", fractions)
    assert asked.approx_accounts().first().asDict() == {"approx_senders": 1, "approx_receivers": 1}


def test_nothing_selected(lake):
    asked = Questions.on(lake, 5, 20, ())
    assert asked.quantiles((0.99,)) == {0.99: None} and asked.row_count() == 0
    assert asked.approx_accounts().first().asDict() == {"approx_senders": 0, "approx_receivers": 0}
    assert asked.overview_metrics().first()["total_transactions"] == 0
    assert asked.rule_grid().count() == 0


def test_grid_equals_every_rule(asked):
    grid = {
        (row["percentile"], row["require_sender_drained"], row["require_customer_receiver"]): row
        for row in asked.rule_grid(("TRANSFER",)).collect()
    }
    assert len(grid) == 16
    for setting in ((0.9, True, False), (0.995, False, True), (0.99, False, False)):
        rule = rules.AlertRule(("TRANSFER",), *setting)
        plain = asked.rule_performance(rule).first().asDict()
        assert {name: grid[setting][name] for name in plain} == plain


def test_grid_reads_transactions_once(asked):
    asked.quantiles((0.99,))
    plan = asked.rule_grid()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_offered_percentiles():
    assert rules.AlertRule.chosen(0.995, types=("DEBIT",)).types == ("DEBIT",)
    with pytest.raises(ValueError, match="one of"):
        rules.AlertRule.chosen(0.5)
    with pytest.raises(ValueError, match="between"):
        rules.AlertRule(percentile=99)


def test_sketches_do_not_read_transactions(asked):
    files = asked.approx_accounts().inputFiles()
    assert files and all("account_sketches" in path for path in files)
