import random

import pytest
from sentencepiece import SentencePieceProcessor

from ledgerlens.llm import piece_codec
from ledgerlens.llm.piece_codec import Codec, PieceTable, border_states, normalised

SCHEMA = "doc_id long, text string, token_ids string"
ODD = ["", " ", "  two  spaces ", "a\nb\tc\r\n", "\x00", "日本🎉é́", "x" * 300, "=" * 70 + "a b", "ﬁ ①"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=piece_codec.MODEL_FILE)


@pytest.fixture(scope="module")
def table():
    return PieceTable.load()


def random_texts(table, n):
    rng = random.Random(4)
    pieces = list(table.ids)
    for _ in range(n):
        yield rng.choice(
            (
                "".join(rng.choices("abcde  htn", k=rng.randint(1, 200))),
                "".join(rng.choices(" ab日语🎉é\t\n-=/0123", k=rng.randint(1, 200))),
                "".join(rng.choices(pieces, k=rng.randint(1, 60))).replace("▁", rng.choice((" ", ""))),
            )
        )


def test_same_ids_as_the_library(library, table):
    codec = Codec(table)
    for text in [*ODD, *random_texts(table, 400)]:
        ids = codec.encode(text).tolist()
        assert ids == library.encode(text)
        assert codec.decode(ids) == text


@pytest.mark.parametrize("size", [17, 40, 133])
def test_chunks_give_the_same_path(library, table, size):
    codec = Codec(table)
    for text in [*ODD, *random_texts(table, 150)]:
        whole = normalised(text)
        chunks = []
        for start in range(0, len(whole), size):
            left = max(0, start - table.longest)
            end = min(start + size, len(whole))
            chunks.append((whole[left : end + table.longest], start - left, end - left, start == 0))
        if not chunks:
            continue
        states = border_states([codec.transfer(*chunk) for chunk in chunks])
        ids = []
        for chunk, entry, exit_ in zip(chunks, states, states[1:]):
            ids += codec.trace(*chunk, entry, exit_).tolist()
        assert ids == library.encode(text)


def test_table_with_giants(spark, library, monkeypatch):
    monkeypatch.setattr(piece_codec, "CHUNK_CHARS", 64)
    texts = [*ODD, None, "one two three " * 40, "nospaces" * 50, "one two three " * 40]
    docs = spark.createDataFrame([(i or None, t, "c") for i, t in enumerate(texts)], SCHEMA)
    found = {row["doc_id"]: row for row in piece_codec.encode(docs).collect()}
    for i, text in enumerate(texts):
        row = found[i or None]
        assert row["token_ids"] == (library.encode(text) if text else [])
        assert row["n_tokens"] == len(row["token_ids"])
        assert row["round_trip"] == (None if text is None else True)
    assert piece_codec.encode(docs.limit(0)).collect() == []


def test_decoding(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (2, ""), (3, "日本 🎉")], "doc_id long, text string")
    back = piece_codec.decode(piece_codec.encode(docs)).collect()
    assert sorted((row["doc_id"], row["text"]) for row in back) == [(1, "ab cd"), (2, ""), (3, "日本 🎉")]


def test_space_symbol_is_the_one_text_that_does_not_come_back(spark):
    docs = spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    assert piece_codec.encode(docs).first()["round_trip"] is False


def test_words_side_by_side_and_one_by_one(library, table, monkeypatch):
    texts = [*ODD, *random_texts(table, 300), "ő" * 30, "x漢y é🎉 " * 20]
    together = [ids.tolist() for ids in Codec(table).encode_all([None, *texts])]
    monkeypatch.setattr(piece_codec, "WORDS_SIDE_BY_SIDE", 1 << 60)
    assert together == [ids.tolist() for ids in Codec(table).encode_all([None, *texts])]
    assert together == [[], *library.encode(texts)]


def test_a_full_cache_changes_nothing(library, table, monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHED_WORDS", 50)
    codec = Codec(table)
    texts = list(random_texts(table, 200))
    found = [ids.tolist() for at in range(0, 200, 20) for ids in codec.encode_all(texts[at : at + 20])]
    assert found == library.encode(texts)


def test_unknown_numbers_are_replaced(table):
    codec = Codec(table)
    ids = codec.encode("one two").tolist()
    assert codec.decode([*ids, None, 10**6, -1]) == "one two" + "\ufffd" * 3


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(piece_codec.MODEL_FILE, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="BPE"):
        PieceTable.load(str(tmp_path / "other.model"))


def test_decoding_of_arrays_and_lists(table):
    codec = Codec(table)
    for text, ids in zip(texts := [*ODD, "\x7f\n\t", *random_texts(table, 100)], codec.encode_all(texts), strict=True):
        assert codec.decode(ids) == codec.decode(ids.tolist()) == text
