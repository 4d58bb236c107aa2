import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from ledgerlens.llm import repeated_text

SCHEMA = "doc_id long, text string, mark string, spans int"
PASSAGE = (
    "This long passage was copied from somewhere else into many documents of the corpus. "
    "It has several sentences, so that it can be found wherever it was put. "
    "No one wants to read all of it again and again in every document! "
    "Therefore only the first copy should stay where it is."
)


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "m", 1) for i, t in rows], SCHEMA)
    return [row.asDict(recursive=True) for row in repeated_text.without_repeats(docs).collect()]


def test_later_copies_go_and_offsets_are_the_original(spark):
    texts = {
        1: f"Alpha beginning.\n{PASSAGE}\nAlpha end.",
        2: f"Beta starts here and {PASSAGE} Then beta ends in its own way.",
        3: f"{PASSAGE.upper()}",
        4: "A clean document with its own sentences. Nothing of it stands anywhere else in here.",
    }
    found = {row["doc_id"]: row for row in run(spark, texts.items())}
    assert found[1]["text"] == texts[1] and found[1]["removed"] == []
    assert found[4]["text"] == texts[4]
    assert found[3]["text"] == ""
    # in 2 the first sentence has other words in front, the rest is found
    rest = PASSAGE[PASSAGE.index("It has") :]
    (span,) = found[2]["removed"]
    assert texts[2][span["start"] : span["end"]] == rest
    assert found[2]["text"] == texts[2].replace(rest, "")


def test_earliest_is_by_id_then_place_and_null_is_last(spark):
    found = run(spark, [(None, PASSAGE), (7, f"{PASSAGE}\n\n{PASSAGE}"), (9, PASSAGE)])
    by_id = {row["doc_id"]: row["text"] for row in found}
    assert by_id == {None: "", 7: f"{PASSAGE}\n\n", 9: ""}


def test_short_repeats_stay(spark):
    rows = [(1, "Read more about this topic now."), (2, "Read more about this topic now.")]
    assert {row["text"] for row in run(spark, rows)} == {rows[0][1]}


def test_nulls_empty_and_repeated_rows(spark):
    found = run(spark, [(1, None), (2, ""), (3, PASSAGE), (3, PASSAGE), (None, None)])
    assert sorted(str(row["text"]) for row in found) == sorted(["None", "None", "", PASSAGE, PASSAGE])
    assert run(spark, []) == []


def test_nothing_is_lost_from_the_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    kept_units, all_units = set(), set()
    for row in repeated_text.without_repeats(docs).collect():
        text, at, kept = texts[row["doc_id"]], 0, ""
        for span in row["removed"]:
            kept += text[at : span["start"]]
            at = span["end"]
        assert row["text"] == kept + text[at:]
        spans = [(s["start"], s["end"]) for s in row["removed"]]
        for start, end, words in repeated_text.units_of(text):
            if len(words) >= repeated_text.UNIT_WORDS:
                all_units.add(" ".join(words))
                if not any(a <= start and end <= b for a, b in spans):
                    kept_units.add(" ".join(words))
    assert kept_units == all_units


def numbered(first, n):
    return [f"w{i}" for i in range(first, first + n)]


def test_passages_inside_sentences(spark):
    passage = " ".join(numbered(0, 60))
    texts = {
        1: f"One begins so {passage} and one goes on.",
        2: f"Two has other words, then {passage}, which differs at the last word",
        3: " ".join(numbered(500, 30) + numbered(20, 24) + numbered(600, 30)),
        4: " ".join(numbered(30, 30) + numbered(700, 30)),
        5: " ".join(numbered(700, 30) + numbered(800, 30)),
    }
    found = {row["doc_id"]: row for row in run(spark, texts.items())}
    assert found[1]["text"] == texts[1] and found[3]["text"] == texts[3]
    assert found[2]["text"] == "Two has other words, then  w59, which differs at the last word"
    assert found[4]["text"] == " " + " ".join(numbered(700, 30))
    assert found[5]["text"] == " " + " ".join(numbered(800, 30))


def test_copies_of_short_sentences_and_unspaced_texts(spark):
    short = " ".join(f"A{i}!! B{i} c.\nD{i} e{i} f g?" for i in range(12))
    chinese = "".join(chr(0x4E00 + 7 * i) + ("。" if i % 9 == 8 else "") for i in range(80))
    found = run(spark, [(1, short), (2, short), (3, chinese), (4, f"前言{chinese}后记")])
    texts = {row["doc_id"]: row["text"] for row in found}
    assert texts == {1: short, 2: "", 3: chinese, 4: "前言后记"}


def test_uncovered():
    assert repeated_text.uncovered([(0, 10), (5, 20), (30, 40)], [(8, 12), (30, 40)]) == [(0, 8), (12, 20)]
    assert repeated_text.uncovered([], [(1, 2)]) == []


def test_words_and_their_hashes():
    pattern = re.compile(f"[{repeated_text.UNSPACED}]|[^\\s{repeated_text.UNSPACED}]+")
    rng = random.Random(5)
    pool = "aB cÉİΣΑΣ \n\t 　漢字カナ.x-7\U00020001ก 🎉\u001c"
    texts = ["", " ", "a", "漢", *("".join(rng.choices(pool, k=rng.randint(1, 80))) for _ in range(400))]
    hashes = {}
    for text in texts:
        words, starts, ends = repeated_text.words_of(text)
        places = [(m.start(), m.end()) for m in pattern.finditer(text)]
        assert list(zip(starts.tolist(), ends.tolist())) == places
        assert [word for word in words] == [text[a:b].lower() for a, b in places]
        values, *_ = repeated_text.word_hashes(text)
        for word, value in zip(words, values.tolist(), strict=True):
            assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)


def test_lowest_places_of_all_windows():
    rng = np.random.default_rng(3)
    for n in (16, 17, 40, 500):
        values = rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1)
        values[rng.integers(0, n, n // 3)] = values[0]  # ties go to the leftmost
        for width in (1, 3, 15, 16):
            windows = np.lib.stride_tricks.sliding_window_view(values, width)
            expected = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
            assert repeated_text.lowest_places(values, width).tolist() == expected.tolist()


def test_uncovered_rows_are_those_of_single_places():
    """Spans in any order, that overlap, touch or repeat, in rows side by side."""
    generator = np.random.default_rng(5)
    rows = []
    for _ in range(200):
        starts = generator.integers(0, 60, (2, 6))
        rows.append(
            [
                [(int(a), int(a + size)) for a, size in zip(some[:n], generator.integers(1, 9, 6))]
                for some, n in zip(starts, generator.integers(0, 7, 2))
            ]
        )
    sides = [
        pa.array([[{"start": a, "end": b} for a, b in row[side]] for row in rows], repeated_text.SPANS)
        for side in (0, 1)
    ]
    # a slice, whose offsets do not begin at zero
    found = repeated_text.uncovered_rows(*[side.slice(3) for side in sides]).to_pylist()
    for (later, kept), spans in zip(rows[3:], found, strict=True):
        open_ = {x for a, b in later for x in range(a, b)} - {x for a, b in kept for x in range(a, b)}
        assert {x for s in spans for x in range(s["start"], s["end"])} == open_
        assert all(a["end"] < b["start"] or a["end"] in {x for x, _ in kept} | {y for _, y in kept} for a, b in zip(spans, spans[1:]))
    empty = pa.array([], repeated_text.SPANS)
    assert repeated_text.uncovered_rows(empty, empty).to_pylist() == []


def test_windows_are_digests_of_their_words(spark):
    """Texts whose lower case is longer, characters of several bytes, and words without spaces."""
    texts = [
        " ".join(f"Word{i % 7}" for i in range(60)),
        "İstanbul " * 30 + "ÉTÉ  été\n" * 10,
        "漢字かな" * 12,
        "too short",
    ]
    rows = [(n, n * 10, text, [0, 40], None) for n, text in enumerate(texts)]
    schema = "doc_id long, mark long, text string, marks array<int>, spans array<struct<start:int,end:int>>"
    found = repeated_text._windows(spark.createDataFrame([*rows, (None, 7, texts[0], [0], None)], schema)).collect()
    assert {row["doc_id"] for row in found} == {0, 1, 2, None}
    for row in found:
        text = texts[row["doc_id"] or 0]
        words, starts, ends = repeated_text.words_of(text)
        first = starts.tolist().index(row["start"])
        assert row["end"] == ends[first + repeated_text.LEAST_WORDS - 1]
        digest = xxhash.xxh3_128_digest(" ".join(words[first : first + repeated_text.LEAST_WORDS]))
        assert np.frombuffer(digest, np.int64).tolist() == [row["high"], row["low"]]
