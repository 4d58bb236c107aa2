import pyarrow as pa
import pytest

from ledgerlens.llm import token_counts

MODEL = open(token_counts.default_model(), "rb").read()
SCHEMA = "doc_id long, text string, n_tokens string, row int, part string"


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(MODEL)


def expected(counter, text):
    return len(counter.encoder.encode(text or ""))


TEXTS = [
    "", None, " ", "  a  b ", "x" * 200_000, "ab " * 60_000, "naïve 漢字かな交じり文 " * 9_000, "漢" * 70_000,
    "<s> plain </s><unk>", "▁a ▁ b", "a\nb\n\nc\t\0d", "\n" * 70_000, " " * 70_000,
    "https://host/" + "aZ09+/" * 20_000, "🙂👩‍👩‍👧" * 9_000, "no space" + "-" * 90_000 + " end ",
]


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_parts_add_up_to_the_whole(counter, size):
    for text in TEXTS:
        text = (text or "")[:5000]
        parts = list(counter.cut(text, size))
        assert "".join(parts) == text
        counts = counter.part_counts(parts, [at > 0 for at in range(len(parts))])
        assert sum(counts) == expected(counter, text)


def test_counts_are_those_of_whole_texts(spark, counter):
    rows = [(at, text, "clash", at, "clash") for at, text in enumerate(TEXTS)]
    rows += [(0, "once more " * 20_000, None, None, None), (None, "no id", None, None, None)] + rows[:5]
    found = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [
        (row[0], len((row[1] or "").encode()), n := expected(counter, row[1]), n > 4096) for row in rows
    ]
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_table_against_the_library(spark, sf_dir, counter):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    found = token_counts.count_tokens(docs).collect()
    assert {row.doc_id: row.n_tokens for row in found} == {
        doc: expected(counter, text) for doc, text in texts.items()
    }


def test_batches_hold_about_as_many_bytes():
    texts = pa.array(["a" * 10] * 7 + [None, "b" * 100, "", "c"])
    slices = list(token_counts.by_bytes(texts, 30))
    assert [len(part) for part in slices] == [3, 3, 2, 1, 2]
    assert pa.concat_arrays(slices).equals(texts)


def test_models_that_cannot_be_cut_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="BPE"):
        token_counts._check(proto.SerializeToString())
