import __spark_entry__ as registered
import corpus_pipeline
from ledgerlens.llm import queries, secret_scan
from ledgerlens.sources.scratch import Scratch


def test_stages_take_effect(spark, sf_dir):
    scratch = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts, seen = docs.columns, [docs.count()], {}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = scratch.table(stage(spark, docs, sf_dir), name)
        counts.append(docs.count())
        if name != "pieces":
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[4] == counts[5]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = labels.filter("toxic = 0").join(seen["toxicity"], "doc_id").count()
    known = labels.filter("toxic = 0").join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").count()
    assert clean > 0.97 * known
    assert seen["secrets"].filter(f"text LIKE '%{secret_scan.REDACTED}%'").count() > 0
    assert seen["secrets"].filter(r"text RLIKE 'token = \"[0-9a-f]{40}'").count() == 0
    assert seen["pieces"].filter("NOT round_trip").count() == 0


def test_run_and_registration(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    assert corpus_pipeline.run(spark, small).count() > 0
    names = registered.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLE) <= set(queries.QUERIES)


DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, severity double, "
    "copies int, kept boolean, `_id` string, size long, doc string, `a.b` int"
)


def odd_documents(spark):
    words = "one two three four five six seven eight nine ten eleven twelve"
    texts = [
        (1, words), (2, words), (2, "another text with the same id and enough words to be compared"),
        (3, None), (4, ""), (None, words), (None, None), (5, "   "), (6, "word " * 30_000),
        (7, 'token = "' + "0123456789abcdef" * 2 + '" and more words to follow it'), (1, words),
    ]
    rows = [(i, t, "en", None if i == 6 else "web", None, 1.5, 7, False, "x", 3, "d", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def test_stages_on_odd_rows_and_clashing_names(spark, sf_dir):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, sf_dir)
            if name != "pieces":
                assert found.columns == docs.columns, name
            rows = found.count()
            assert rows <= docs.count() or name == "mix", name


def test_two_texts_of_one_id_are_two_documents(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, odd_documents(spark), sf_dir)
    found = [(row["doc_id"], (row["text"] or "-")[:7]) for row in kept.collect()]
    # the copy of document 1 goes, the other text with its id stays; rows of no id stay
    assert sorted(found, key=str) == sorted(
        [(1, "one two"), (1, "one two"), (2, "another"), (3, "-"), (4, "-"), (5, "   "), (6, "word wo"),
         (7, "token ="), (None, "one two"), (None, "-")], key=str
    )


def test_given_findings_train_the_scan(spark):
    lines = [f"ticket {n} was opened by agent CASE{n:020d}XQ today" for n in range(40)]
    labelled = [secret_scan.finding(line, f"CASE{n:020d}XQ", True) for n, line in enumerate(lines)]
    hexadecimal = [f"{n:040x}" for n in range(10**30, 10**30 + 40)]
    labelled += [secret_scan.finding(f"commit {v} was merged", v, False) for v in hexadecimal]
    docs = spark.createDataFrame([(1, lines[3]), (2, f"commit {hexadecimal[5]} was merged")], "doc_id long, text string")
    found = {row["doc_id"]: row["n_secrets"] for row in secret_scan.scan(docs, labelled).collect()}
    assert found == {1: 1, 2: 0}
