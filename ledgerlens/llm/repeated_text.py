"""Remove passages that stand elsewhere already: hashing of lines, their sentences, and words.

A text is cut into units, the sentences of its lines. Units are normalised and hashed; digests
are grouped over the corpus, and of equal units the earliest ranked (smallest doc_id, then
earliest place) stays. Stretches of later units are removed if they hold enough words.

What is left is compared by words, wherever sentences begin and end: any LEAST_WORDS words in a
row that stand earlier as well are removed. Winnowing marks the places to look at (two equal
windows always share a mark), windows around repeated marks are hashed at every word. What
stays is unchanged, and the removed spans carry their offsets in the original text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.heavy_join import attach
from ledgerlens.sources.scratch import Scratch

#: Units of fewer words are not hashed; they go with the repeated units around them.
UNIT_WORDS = 5
#: Words that a stretch of repeated units must hold to be removed.
LEAST_WORDS = 25
UNIT = re.compile(r"\S(?:[^\n]*?[.!?…。！？]+(?=\s|\Z)|[^\n]*)")

#: Words of a mark; of the marks that fit into LEAST_WORDS words the one of lowest hash is taken.
MARK_WORDS = 10
MARKS = LEAST_WORDS - MARK_WORDS + 1

#: Scripts written without spaces between words: every character counts as a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15

UNITS = "doc_id long, mark long, number int, start int, end int, words int, high long, low long"
MARK_ROWS = "doc_id long, mark long, start int, end int, value long"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
WINDOWS = "doc_id long, mark long, start int, end int, high long, low long"


def units_of(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of the sentences of each line, in order."""
    lower = text.lower()
    if len(lower) != len(text):
        return [(m.start(), m.end(), m[0].lower().split()) for m in UNIT.finditer(text)]
    # the characters that end a unit are the same in lower case
    return [(a, b, lower[a:b].split()) for a, b in map(re.Match.span, UNIT.finditer(text))]


def _units(docs: DataFrame) -> DataFrame:
    """Units of UNIT_WORDS or more with the digest of their words."""

    def cut(text: str) -> list[np.ndarray]:
        rows = [
            (number, start, end, len(words), " ".join(words))
            for number, (start, end, words) in enumerate(units_of(text))
            if len(words) >= UNIT_WORDS
        ]
        *places, units = zip(*rows, strict=True) if rows else [()] * 5
        return [*[np.array(column, np.int32) for column in places], *_digests(units)]

    return docs.mapInArrow(_per_text(cut, ["text"], UNITS), UNITS)


def _digests(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower half of the digest of every text."""
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), dtype=np.int64)
    return halves[::2], halves[1::2]


def _per_text(cut: Callable[..., list[np.ndarray]], given: list[str], schema: str):
    """An Arrow function of the rows, as columns, that cut finds in the given values of a text.

    The first two columns of the schema are doc_id and mark of the text, which are added.
    """
    names = [column.split()[0] for column in schema.split(", ")]

    def batch_of(keys: list[tuple], found: list[list[np.ndarray]]) -> pa.RecordBatch:
        of_text = pa.array(np.repeat(np.arange(len(found)), [len(columns[0]) for columns in found]))
        same = [pa.array(values, pa.int64()).take(of_text) for values in zip(*keys, strict=True)]
        columns = [pa.array(np.concatenate(parts)) for parts in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays([*same, *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found, rows = [], [], 0
        for batch in batches:
            # one text at a time, since a batch may hold large ones
            values = [(x.as_py() for x in batch[name]) for name in ("doc_id", "mark", *given)]
            for doc_id, mark, *rest in zip(*values, strict=True):
                columns = cut(*rest)
                if len(columns[0]):
                    keys.append((doc_id, mark))
                    found.append(columns)
                    rows += len(columns[0])
                if rows > 100_000:
                    yield batch_of(keys, found)
                    keys, found, rows = [], [], 0
        if found:
            yield batch_of(keys, found)

    return run


def stretches(units: list[tuple[int, int, int, int]], total: list[int] | None = None) -> list[tuple[int, int]]:
    """Spans to remove, from the repeated units (number, start, end, words) of a text in order.

    total holds the numbers of the units that were hashed but are not repeated: they part
    stretches, shorter units do not.
    """
    parting = np.array(sorted(total or []))
    spans, start, end, words, last = [], 0, 0, 0, None
    for number, begin, stop, count in units:
        apart = last is None or np.searchsorted(parting, last) != np.searchsorted(parting, number)
        if apart:
            if words >= LEAST_WORDS:
                spans.append((start, end))
            start, words = begin, 0
        end, words, last = stop, words + count, number
    if words >= LEAST_WORDS:
        spans.append((start, end))
    return spans


SPACE_KIND, SINGLE_KIND = 1, 2


@cache
def _kinds() -> np.ndarray:
    """Kind of every character: white space, a word of its own, or 0 for a part of a word."""
    kinds = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    kinds[[code for code in range(0x3001) if chr(code).isspace()]] = SPACE_KIND
    for at in range(0, len(UNSPACED), 3):
        kinds[ord(UNSPACED[at]) : ord(UNSPACED[at + 2]) + 1] = SINGLE_KIND
    return kinds


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of BASE modulo 2**64 and of its inverse."""

    def first(factor: int) -> np.ndarray:
        factors = np.full(size, factor, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    return first(BASE), first(pow(BASE, -1, 1 << 64))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs without white space, and every unspaced character."""
    kinds = _kinds()[_codes(text)]
    in_word, single = kinds != SPACE_KIND, kinds == SINGLE_KIND
    # whether a word begins or ends between a character and the next one
    border = ~(in_word[:-1] & in_word[1:]) | single[:-1] | single[1:]
    edge = np.ones(min(len(kinds), 1), dtype=bool)
    starts = np.flatnonzero(in_word & np.concatenate([edge, border]))
    ends = np.flatnonzero(in_word & np.concatenate([border, edge])) + 1
    return starts.astype(np.int32), ends.astype(np.int32)


def words_of(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words in lower case, their starts and their ends."""
    starts, ends = word_places(text)
    lower = text.lower()
    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
    if len(lower) == len(text):
        return [lower[a:b] for a, b in pairs], starts, ends
    return [text[a:b].lower() for a, b in pairs], starts, ends


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words in lower case, their starts and their ends.

    A word's hash is its part of a running sum of characters times powers of BASE, moved to the
    sum's beginning, so all words of a text are hashed at once.
    """
    starts, ends = word_places(text)
    lower, first, last = text.lower(), starts, ends
    if len(lower) != len(text):
        # some characters become two; words are put together anew
        words = [text[a:b].lower() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        lower = "".join(words)
        last = np.cumsum([len(word) for word in words], dtype=np.int64)
        first = last - [len(word) for word in words]
    size = 1 << max(16, len(lower).bit_length())
    powers, inverses = _powers(size)
    sums = np.zeros(len(lower) + 1, dtype=np.uint64)
    np.cumsum((_codes(lower).astype(np.uint64) + np.uint64(1)) * powers[: len(lower)], out=sums[1:])
    values = (sums[last] - sums[first]) * inverses[first]
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29)), starts, ends


def marked_words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the marks, from the hashes of a text's words.

    Every LEAST_WORDS words in a row hold one, the same wherever they stand.
    """
    if len(values) < LEAST_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(values) - MARK_WORDS + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(MARK_WORDS):
        mixed = mixed * np.uint64(BASE) + values[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    at = lowest_places(mixed, MARKS)
    return at, mixed[at].view(np.int64)


def lowest_places(values: np.ndarray, width: int) -> np.ndarray:
    """Places that are the lowest of some width values in a row, by their upper bits, then leftmost.

    The place is put into the lower bits, so a rolling minimum, by doubling, finds both at once.
    """
    bits = np.uint64(len(values).bit_length())
    lowest = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        size += step
    places = (lowest & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # the leftmost lowest place never moves back
    return places[np.concatenate([[True], places[1:] != places[:-1]])]


def _marks(docs: DataFrame) -> DataFrame:
    """Marks of every text with their offsets."""

    def cut(text: str) -> list[np.ndarray]:
        values, starts, ends = word_hashes(text)
        at, marks = marked_words(values)
        return [starts[at], ends[at + MARK_WORDS - 1], marks]

    return docs.mapInArrow(_per_text(cut, ["text"], MARK_ROWS), MARK_ROWS)


def window_places(words: list[str], starts: np.ndarray, ends: np.ndarray, marks: list[int], removed: list[tuple[int, int]]) -> list[int]:
    """First words of the windows of LEAST_WORDS words that hold one of the marks (by start) and no removed word."""
    n = len(words) - LEAST_WORDS + 1
    if n <= 0:
        return []
    wanted = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.searchsorted(starts, np.asarray(marks))
    np.add.at(wanted, np.maximum(at - MARKS + 1, 0), 1)
    np.add.at(wanted, at + 1, -1)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, end in removed:
        gone[np.searchsorted(ends, start, "right") + 1 : np.searchsorted(starts, end) + 1] = 1
    gone = np.cumsum(gone)
    return np.flatnonzero((np.cumsum(wanted)[:n] > 0) & (gone[LEAST_WORDS:] == gone[:n])).tolist()


def _windows(texts: DataFrame) -> DataFrame:
    """Windows of the texts around their repeated marks, with the digest of their words."""

    def cut(text: str, marks: list[int], spans: list[dict] | None) -> list[np.ndarray]:
        words, starts, ends = words_of(text)
        removed = [(s["start"], s["end"]) for s in spans or []]
        first = np.array(window_places(words, starts, ends, marks, removed), np.int64)
        last = first + LEAST_WORDS - 1
        # a window's words with spaces between them are a part of all words with spaces between them
        joined = " ".join(words)
        stops = np.cumsum([len(word) + 1 for word in words], dtype=np.int64) - 1
        begins = np.concatenate([np.zeros(1, np.int64), stops + 1])
        pairs = zip(begins[first].tolist(), stops[last].tolist(), strict=True)
        return [starts[first], ends[last], *_digests(joined[a:b] for a, b in pairs)]

    return texts.mapInArrow(_per_text(cut, ["text", "marks", "spans"], WINDOWS), WINDOWS)


def uncovered(later: list[tuple[int, int]], kept: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans of later cover and those of kept do not, as spans in order."""
    rows = [pa.array([[{"start": a, "end": b} for a, b in spans]], SPANS) for spans in (later, kept)]
    return [(span["start"], span["end"]) for span in uncovered_rows(*rows)[0].as_py()]


def uncovered_rows(later: pa.Array, kept: pa.Array) -> pa.Array:
    """uncovered for every row of two arrays of SPANS."""
    places, steps = [], []
    for spans, step in ((later, np.array([1, 0])), (kept, np.array([0, 1]))):
        row = pc.list_parent_indices(spans).to_numpy(zero_copy_only=False).astype(np.int64) << 32
        flat = pc.list_flatten(spans)
        for name, sign in (("start", 1), ("end", -1)):
            places.append(row + pc.struct_field(flat, name).to_numpy(zero_copy_only=False))
            steps.append(np.broadcast_to(sign * step, (len(row), 2)))
    place, step = np.concatenate(places), np.concatenate(steps)
    order = np.argsort(place, kind="stable")
    place, depth = place[order], np.cumsum(step[order], axis=0)
    at_last = np.append(place[1:] != place[:-1], True)[: len(place)]
    place, depth = place[at_last], depth[at_last]
    # every span of a row ends in it, so nothing is open between rows
    open_ = (depth[:, 0] > 0) & (depth[:, 1] == 0)
    before = np.concatenate([np.zeros(1, bool), open_])[: len(open_)]
    start, end = place[open_ & ~before], place[~open_ & before]
    ends = np.cumsum(np.bincount(start >> 32, minlength=len(later)))
    offsets = pa.array(np.concatenate([np.zeros(1, np.int64), ends]).astype(np.int32))
    low = np.int64((1 << 32) - 1)
    parts = [pa.array((side & low).astype(np.int32)) for side in (start, end)]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, names=["start", "end"]))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter("text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text"
    )


def _keyed(spans: DataFrame) -> DataFrame:
    return spans.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})


SAME_TEXT = "mark = _mark AND doc_id <=> _id"


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text) and spans of the texts that have passages to remove."""
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = _texts(docs)
    units = scratch.table(_units(texts), "units")
    first = scratch.table(_first_of_repeated(units), "first")
    sentences = _sentence_spans(units, first, scratch)
    words = _word_spans(texts, units, first, sentences, scratch)
    found = sentences.unionByName(words).groupBy("doc_id", "mark")
    return scratch.table(found.agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "all")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "mark", "start")


def _first_of_repeated(rows: DataFrame) -> DataFrame:
    """Digests (high, low) that stand at two places or more, with the first place."""
    place = _place()
    return (
        rows.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first != last")
        .select("high", "low", "first")
    )


def _word_spans(texts: DataFrame, units: DataFrame, first: DataFrame, removed: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, mark and spans of repeated words outside of the removed spans.

    Of equal windows the first keeps all its words; they stay even where another window covers
    them that is a later one. A whole sentence that stands nowhere earlier as a sentence of its
    own stays too, so that no sentence is lost from the corpus.
    """

    def repeated(marks: DataFrame) -> DataFrame:
        values = marks.groupBy(F.col("value").alias("_value")).agg(F.count(F.lit(1)).alias("n"))
        often = scratch.table(values.filter("n > 1"), "values")
        return attach(marks, often, {"value": "_value"}, "n", hint="merge").drop("_value")

    inside = "NOT exists(coalesce(spans, array()), s -> s.start < end AND start < s.end)"
    left = (
        repeated(scratch.table(_marks(texts), "marks"))
        .join(_keyed(removed).hint("merge"), F.expr(SAME_TEXT), "left")
        .filter(inside)
        .select("doc_id", "mark", "start", "value")
    )
    near = repeated(scratch.table(left, "left")).groupBy("doc_id", "mark").agg(F.collect_set("start").alias("marks"))
    around = _keyed(near).join(
        removed.hint("merge"), F.expr(SAME_TEXT), "left"
    ).select("_id", "_mark", "marks", "spans")
    wide = texts.join(around.hint("merge"), F.expr(SAME_TEXT)).select("doc_id", "mark", "text", "marks", "spans")
    windows = scratch.table(_windows(wide), "windows")
    span = F.struct("start", "end")
    later = ~_place().eqNullSafe(F.col("first"))
    per_text = (
        windows.join(_first_of_repeated(windows), ["high", "low"])
        .select("doc_id", "mark", span.alias("span"), later.alias("later"))
        .groupBy("doc_id", "mark")
        .agg(
            F.collect_set(F.when(F.col("later"), F.col("span"))).alias("later"),
            F.collect_set(F.when(~F.col("later"), F.col("span"))).alias("kept"),
        )
        .filter(F.size("later") > 0)
    )

    spans = F.arrow_udf(uncovered_rows, "array<struct<start:int,end:int>>")
    found = per_text.select("doc_id", "mark", spans("later", "kept").alias("spans"))
    found = scratch.table(found.filter(F.size("spans") > 0), "covered")
    whole = (
        units.join(_keyed(found).hint("merge"), F.expr(SAME_TEXT))
        .filter("exists(spans, s -> s.start <= start AND end <= s.end)")
        .select("doc_id", "mark", "start", "end", "high", "low")
    )
    own = (
        whole.join(first, ["high", "low"], "left")
        .filter(F.col("first").isNull() | _place().eqNullSafe(F.col("first")))
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(span).alias("own"))
    )
    judged = found.join(_keyed(own).hint("merge"), F.expr(SAME_TEXT), "left")
    own_spans = F.coalesce("own", F.array().cast("array<struct<start:int,end:int>>"))
    found = judged.select("doc_id", "mark", spans("spans", own_spans).alias("spans"))
    return scratch.table(found.filter(F.size("spans") > 0), "word_spans")


def _sentence_spans(units: DataFrame, first: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, mark and spans of repeated whole sentences."""
    judged = units.join(first, ["high", "low"], "left").select(
        "doc_id", "mark", "number", "start", "end", "words",
        (F.col("first").isNotNull() & ~_place().eqNullSafe(F.col("first"))).alias("later"),
    )
    numbers = F.array_sort(
        F.collect_set(F.when(F.col("later"), F.struct("number", "start", "end", "words")))
    )
    per_text = (
        judged.groupBy("doc_id", "mark")
        .agg(
            numbers.alias("later"),
            F.collect_set(F.when(~F.col("later"), F.col("number"))).alias("own"),
        )
        .filter(F.size("later") > 0)
    )

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def spans(later: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"start": start, "end": end}
                    for start, end in stretches(
                        [(u["number"], u["start"], u["end"], u["words"]) for u in units], list(others)
                    )
                ]
                for units, others in zip(later, own, strict=True)
            ]
        )

    found = per_text.select("doc_id", "mark", spans("later", "own").alias("spans"))
    return scratch.table(found.filter(F.size("spans") > 0), "spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (what stays), removed (spans of the original text) and n_removed of every row.

    Rows with the same doc_id and text count as one document; a null doc_id ranks last. A null
    text stays null and an empty one empty; both have no spans. An empty table gives no rows;
    other columns are not looked at. Starts jobs when called.
    """
    spans = _keyed(repeated_spans(docs))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn(
        "mark", F.xxhash64("text")
    )
    # merged at any size, so that the plan does not turn when the list outgrows a broadcast
    joined = rows.join(spans.hint("merge"), F.expr(SAME_TEXT), "left")
    removed = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    # what stands before the first span, between spans, and after the last one
    starts = F.concat(F.array(F.lit(0)), F.col("removed.end"))
    ends = F.concat(F.col("removed.start"), F.array(F.length("text")))
    kept = F.array_join(
        F.transform(
            F.arrays_zip(starts.alias("a"), ends.alias("b")),
            lambda z: F.substring(F.col("text"), z["a"] + 1, z["b"] - z["a"]),
        ),
        "",
    )
    return (
        joined.withColumn("removed", removed)
        .select(
            "doc_id",
            F.when(F.size("removed") > 0, kept).otherwise(F.col("text")).alias("text"),
            "removed",
            F.size("removed").alias("n_removed"),
        )
    )
