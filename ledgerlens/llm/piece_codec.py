"""Encode texts with a SentencePiece BPE model, and decode them, as a max-plus scan.

A sequence of pieces is the model's encoding of a text exactly if each two neighbours are the
encoding of their own concatenation. So encoding is a best path: a pair of neighbouring pieces
weighs 0 if the model leaves it as it is and minus infinity if it would merge it otherwise. A
state is a piece together with where it ends.

Giant texts are cut into chunks. A chunk yields the transfer matrix between the states at its
two borders (pieces that end at or reach over them), sparse as all other entries are minus
infinity. Matrices are combined associatively, in a prefix scan from the left and one from the
right; the state that both reach is the one at the border, and each chunk is then traced back
on its own. Nothing reaches over the start of a word, so the words between the first and the
last start in a chunk stand alone; short ones are encoded by the model's merging rule itself.

The model file is read on the driver only; its table of pieces goes to the executors.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import Scratch

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Longer texts are cut into chunks of so many characters.
CHUNK_CHARS = 32768
CACHED_WORDS = 600_000
NEVER = float("-inf")
CACHED_PAIRS = 200_000
#: Texts whose tokens are handed over at once.
ROWS_AT_ONCE = 256
#: Longer words are encoded as a path, whose work grows with the length alone.
LONGEST_MERGED = 48
#: From so many new words on they are merged side by side.
WORDS_SIDE_BY_SIDE = 32
#: Slots of a table of pairs, as a power of two.
TABLE_BITS = 19
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
WORD_START = re.compile(f"(?<=[^{SPACE}]){SPACE}")

State = tuple[int, str]
Matrix = dict[State, set[State]]


def _slot(keys: np.ndarray, factor: np.uint64) -> np.ndarray:
    return (keys.astype(np.uint64) * factor >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Merges:
    """The model's merging rule on numbered symbols: pieces, and the characters in them.

    keys are left * size + right of all pairs that make a piece, in order; ranks (the higher the
    better, from the scores) and results belong to them. A character in no piece is minus its
    code, the room behind a word's end 0.
    """

    size: int
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    characters: np.ndarray
    ids: np.ndarray
    lengths: list[int]

    @staticmethod
    def of(scores: dict[str, float], ids: dict[str, int]) -> Merges:
        symbols: dict[str, int] = {}
        for piece in scores:
            for symbol in (piece, *piece):
                symbols.setdefault(symbol, len(symbols) + 1)
        size = len(symbols) + 1
        rank = {score: at for at, score in enumerate(sorted(set(scores.values())))}
        pairs = sorted(
            (symbols[piece[:cut]] * size + symbols[piece[cut:]], rank[score], symbols[piece])
            for piece, score in scores.items()
            for cut in range(1, len(piece))
            if piece[:cut] in symbols and piece[cut:] in symbols
        )
        keys, ranks, results = (np.array(column, dtype=np.int64) for column in zip(*pairs, strict=True))
        characters = -np.arange(sys.maxunicode + 1, dtype=np.int32)
        numbers = np.full(size, -1, dtype=np.int32)
        for symbol, number in symbols.items():
            numbers[number] = ids.get(symbol, -1)
            if len(symbol) == 1:
                characters[ord(symbol)] = number
        return Merges(
            size, keys, ranks.astype(np.int32), results.astype(np.int32), characters, numbers,
            [0, *map(len, symbols)],
        )

    @cached_property
    def _slots(self) -> list[tuple[np.uint64, np.ndarray]]:
        """Places of the pairs in tables of TABLE_BITS, each for the pairs the one before has no room for."""
        left, tables = np.arange(len(self.keys)), []
        factor = 0x9E3779B97F4A7C15
        while len(left):
            at = _slot(self.keys[left], np.uint64(factor))
            _, first = np.unique(at, return_index=True)
            table = np.full(1 << TABLE_BITS, -1, dtype=np.int32)
            table[at[first]] = left[first]
            tables.append((np.uint64(factor), table))
            left = np.delete(left, first)
            factor = factor * 0xD6E8FEB86659FD93 % (1 << 64) | 1
        return tables

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the pieces that pairs make; -1 and 0 where they make none."""
        ranks, results = np.full(left.shape, -1, dtype=np.int32), np.zeros(left.shape, dtype=np.int32)
        open_ = np.flatnonzero((left > 0) & (right > 0))
        wanted = left.ravel()[open_].astype(np.int64) * self.size + right.ravel()[open_]
        for factor, table in self._slots:
            at = table[_slot(wanted, factor)]
            hit = self.keys[at] == wanted
            found, place = at[hit], open_[hit]
            ranks.ravel()[place], results.ravel()[place] = self.ranks[found], self.results[found]
            # an empty slot here means that no later table has the pair either
            more = ~hit & (at >= 0)
            wanted, open_ = wanted[more], open_[more]
        return ranks, results

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols each word ends with (a row, 0 behind its end) and their number.

        A round joins the best neighbours, the leftmost first, in every word that has some; only
        the pairs beside a join are looked up again.
        """
        counts = np.array([len(word) for word in words])
        width = int(counts.max())
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
        final = np.zeros((len(words), width + 1), dtype=np.int32)
        final[np.arange(width + 1) < counts[:, None]] = self.characters[codes]
        active, rows = np.arange(len(words)), final
        ranks, results = self.look_up(rows[:, :-1], rows[:, 1:])
        while True:
            best = ranks.argmax(axis=1)
            going = np.flatnonzero(ranks[np.arange(len(rows)), best] >= 0)
            if len(going) < len(rows):
                done = np.ones(len(rows), dtype=bool)
                done[going] = False
                final[active[done], : rows.shape[1]] = rows[done]
                final[active[done], rows.shape[1] :] = 0
                active, rows, ranks, results, best = (
                    part[going] for part in (active, rows, ranks, results, best)
                )
            if not len(going):
                return final, counts
            counts[active] -= 1
            # no word reaches farther after its join; a row keeps one place behind its end
            width = int(counts[active].max())
            everyone, columns = np.arange(len(active)), np.arange(width)
            joined = results[everyone, best]
            # what stands behind the join moves up by one place, pairs with it
            behind = columns > best[:, None]
            moved = np.zeros((len(active), width + 1), dtype=np.int32)
            moved[:, :width] = np.where(behind, rows[:, 1 : width + 1], rows[:, :width])
            moved[everyone, best] = joined
            behind |= columns == best[:, None]
            after = np.minimum(columns + 1, ranks.shape[1] - 1)
            ranks = np.where(behind, ranks[:, after], ranks[:, :width])
            results = np.where(behind, results[:, after], results[:, :width])
            # a row's last pair reaches behind its end
            ranks[everyone, counts[active] - 1] = -1
            rows = moved
            ranks[everyone, best], results[everyone, best] = self.look_up(
                rows[everyone, best], rows[everyone, best + 1]
            )
            some = everyone[best > 0]
            at = best[some] - 1
            ranks[some, at], results[some, at] = self.look_up(rows[some, at], rows[some, at + 1])


@dataclass(frozen=True)
class PieceTable:
    """What encoding and decoding need of a model."""

    scores: dict[str, float]
    ids: dict[str, int]
    texts: list[str]
    byte_ids: list[int]
    longest: int
    merges: Merges

    @staticmethod
    def load(path: str = MODEL_FILE) -> PieceTable:
        # the driver alone needs the library
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        normaliser = proto.normalizer_spec
        as_it_is = not (normaliser.precompiled_charsmap or normaliser.remove_extra_whitespaces)
        if proto.trainer_spec.model_type != 2 or not as_it_is or not normaliser.add_dummy_prefix:
            raise ValueError("only BPE models without normaliser are supported")
        model = SentencePieceProcessor(model_proto=proto.SerializeToString())
        scores, ids, texts, byte_ids = {}, {}, [], [0] * 256
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                byte_ids[int(piece[3:5], 16)] = number
                texts.append("")
            elif model.is_control(number) or model.is_unknown(number):
                texts.append("")
            else:
                scores[piece], ids[piece] = model.get_score(number), number
                texts.append(piece)
        if any(SPACE in piece.lstrip(SPACE) for piece in scores):
            raise ValueError("pieces that hold a space after another character are not supported")
        longest = max(map(len, scores))
        return PieceTable(scores, ids, texts, byte_ids, longest, Merges.of(scores, ids))


def normalised(text: str) -> str:
    """The text as the model sees it: a space in front, spaces as their own symbol."""
    return (SPACE + text.replace(" ", SPACE)) if text else ""


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """Encoding of a short text by the model's rule: join the best neighbours, the leftmost first."""
    parts = list(text)
    score = scores.get
    pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = max(pairs)
        if best == NEVER:
            break
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = score(parts[at] + parts[at + 1], NEVER)
        if at:
            pairs[at - 1] = score(parts[at - 1] + parts[at], NEVER)
    return parts


class Codec:
    """Encoder and decoder of one task, with caches of bounded size."""

    def __init__(self, table: PieceTable) -> None:
        self.table = table
        self._pairs: dict[tuple[str, str], bool] = {}
        self._words: dict[str, bytes] = {}
        self._bytes = {number: value for value, number in enumerate(table.byte_ids)}
        # bytes below 128 are characters by themselves, the others only together
        self._texts = list(table.texts)
        for value in range(128):
            self._texts[table.byte_ids[value]] = chr(value)
        self._is_part = np.zeros(len(table.texts), dtype=bool)
        self._is_part[table.byte_ids[128:]] = True

    def fits(self, before: str, piece: str) -> bool:
        """Whether the pair weighs 0; before is empty at the start of a text or word."""
        key = (before, piece)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            parts = merged(before + piece, self.table.scores)
            known = parts == ([before, piece] if before else [piece])
            self._pairs[key] = known
        return known

    def _forward(self, text: str, starts: dict[int, dict[str, int]], stop: int) -> dict[int, dict[str, int]]:
        """States reached from starts (position: piece: mask); those at stop or beyond end a path.

        The mask of a state tells which starts lead to it.
        """
        reached = {at: dict(states) for at, states in starts.items()}
        scores, longest, size = self.table.scores, self.table.longest, len(text)
        for at in range(min(reached, default=stop), stop):
            states = reached.get(at)
            if not states:
                continue
            for end in range(at + 1, min(at + longest, size) + 1):
                piece = text[at:end]
                if piece in scores or end == at + 1:
                    for before, mask in states.items():
                        if self.fits(before, piece):
                            target = reached.setdefault(end, {})
                            target[piece] = target.get(piece, 0) | mask
        return reached

    def _path(self, text: str, start: int, before: str, end: int, last: str | None = None) -> list[str]:
        """The one path of pieces from state (start, before) to end; last names its last piece."""
        if start == end:
            return []
        stop = end if last is None else end - len(last) + 1
        reached = self._forward(text, {start: {before: 1}}, min(stop, end))
        path: list[str] = []
        at, piece = end, last if last is not None else next(iter(reached[end]))
        while True:
            path.append(piece)
            at -= len(piece)
            if at == start:
                return path[::-1]
            piece = next(iter(reached[at]))

    def _numbers(self, pieces: list[str]) -> array:
        result = array("i")
        ids, byte_ids = self.table.ids, self.table.byte_ids
        for piece in pieces:
            number = ids.get(piece)
            if number is None:
                result.extend(byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
            else:
                result.append(number)
        return result

    def _pieces(self, word: str) -> list[str]:
        """The one path from the start of a word: at each place one piece can end."""
        scores, longest, fits = self.table.scores, self.table.longest, self.fits
        last = [""]
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - longest), end):
                piece = word[begin:end]
                if (piece in scores or begin == end - 1) and fits(last[begin], piece):
                    last.append(piece)
                    break
        path: list[str] = []
        at = len(word)
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet, the short ones side by side."""
        new = words - self._words.keys()
        if len(self._words) + len(new) > CACHED_WORDS:
            # those of this batch are needed in a moment
            self._words = {word: self._words[word] for word in words - new}
        # words of like length together, so that rows have little room behind their end
        short = sorted((word for word in new if len(word) <= LONGEST_MERGED), key=len)
        if len(short) < WORDS_SIDE_BY_SIDE:
            for word in short:
                self._words[word] = self._numbers(merged(word, self.table.scores)).tobytes()
        else:
            for start in range(0, len(short), 4096):
                self._learn_side_by_side(short[start : start + 4096])
        for word in new:
            if len(word) > LONGEST_MERGED:
                self._words[word] = self._numbers(self._pieces(word)).tobytes()

    def _learn_side_by_side(self, words: list[str]) -> None:
        merges = self.table.merges
        symbols, counts = merges.merged(words)
        used = np.arange(symbols.shape[1]) < counts[:, None]
        numbers = np.where(symbols > 0, merges.ids[np.maximum(symbols, 0)], -1)
        in_bytes = (used & (numbers < 0)).any(axis=1)
        ids = numbers[used].tobytes()
        ends = (counts.cumsum() * 4).tolist()
        for word, start, end in zip(words, [0, *ends], ends):
            self._words[word] = ids[start:end]
        for at in np.flatnonzero(in_bytes).tolist():
            parts, place = [], 0
            for symbol in symbols[at, : counts[at]].tolist():
                length = merges.lengths[symbol] if symbol > 0 else 1
                parts.append(words[at][place : place + length])
                place += length
            self._words[words[at]] = self._numbers(parts).tobytes()

    def _joined(self, words: list[str]) -> array:
        result = array("i")
        result.frombytes(b"".join(map(self._words.__getitem__, words)))
        return result

    def words(self, text: str) -> array:
        """Encoding of normalised text that starts and ends at word borders."""
        words = WORD.findall(text)
        self.learn(set(words))
        return self._joined(words)

    def encode(self, text: str | None) -> array:
        return self.words(normalised(text)) if text else array("i")

    def encode_all(self, texts: list[str | None]) -> list[array]:
        """Encodings of several texts, whose new words are learnt together."""
        split = [WORD.findall(normalised(text)) if text else [] for text in texts]
        self.learn(set().union(*split))
        return [self._joined(words) for words in split]

    def decode(self, numbers) -> str:
        """Text of piece numbers; bytes that are no UTF-8 become replacement characters.

        So does a null or a number that the model does not have.
        """
        texts, as_bytes = self.table.texts, self._bytes
        if isinstance(numbers, array) and not self._is_part[np.frombuffer(numbers, np.int32)].any():
            # numbers of this encoder, without parts of characters
            whole = "".join(map(self._texts.__getitem__, numbers))
            return whole.replace(SPACE, " ").removeprefix(" ")
        parts: list[str] = []
        raw = bytearray()
        for number in numbers:
            if number in as_bytes:
                raw.append(as_bytes[number])
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            known = number is not None and 0 <= number < len(texts)
            parts.append(texts[number] if known else "\ufffd")
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts).replace(SPACE, " ").removeprefix(" ")

    # chunks: text is a window, start and end are the chunk's borders in it

    def _entries(self, text: str, start: int) -> list[State]:
        """States possible at a border: (how far the piece reaches over it, piece)."""
        states = []
        for begin in range(max(0, start - self.table.longest), start):
            for end in range(start, min(begin + self.table.longest, len(text)) + 1):
                piece = text[begin:end]
                if (piece in self.table.scores or len(piece) == 1) and self.fits("", piece):
                    states.append((end - start, piece))
        return states

    def transfer(self, text: str, start: int, end: int, first: bool) -> Matrix:
        """Which states at the chunk's end each state at its start leads to."""
        entries = [(0, "")] if first else self._entries(text, start)
        starts: dict[int, dict[str, int]] = {}
        for number, (over, piece) in enumerate(entries):
            starts.setdefault(start + over, {})[piece] = (
                starts.get(start + over, {}).get(piece, 0) | 1 << number
            )
        head, tail = self._word_borders(text, start, end, first)
        matrix: Matrix = {}
        if head is None:
            reached = self._forward(text, starts, end)
            exits = [(at - end, piece, mask) for at in reached if at >= end for piece, mask in reached[at].items()]
        else:
            to_head = self._forward(text, starts, head).get(head, {}) if head > start else starts.get(head, {})
            alive = 0
            for mask in to_head.values():
                alive |= mask
            reached = self._forward(text, {tail: {"": 1}}, end)
            exits = [(at - end, piece, alive) for at in reached if at >= end for piece in reached[at]]
        for number, entry in enumerate(entries):
            matrix[entry] = {(over, piece) for over, piece, mask in exits if mask >> number & 1}
        return matrix

    def _word_borders(self, text: str, start: int, end: int, first: bool) -> tuple[int | None, int]:
        """First and last word start in the chunk, or None where it has none."""
        found = WORD_START.search(text, start, end)
        head = found.start() if found else None
        tail = end
        if found:
            # the last start: a space whose character before is none
            tail = text.rindex(SPACE, start, end)
            while text[tail - 1] == SPACE:
                tail -= 1
        if first:
            head, tail = start, tail if found else start
        return head, tail

    def trace(self, text: str, start: int, end: int, first: bool, entry: State, exit_: State) -> array:
        """Numbers of the pieces after the entry's up to and with the exit's."""
        head, tail = self._word_borders(text, start, end, first)
        at, target = start + entry[0], end + exit_[0]
        if head is None:
            if at == target:
                return array("i")
            return self._numbers(self._path(text, at, entry[1], target, exit_[1]))
        result = self._numbers(self._path(text, at, entry[1], head)) if head > at else array("i")
        result.extend(self.words(text[head:tail]))
        result.extend(self._numbers(self._path(text, tail, "", target, exit_[1])))
        return result


def combine(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product of two transfer matrices whose entries are 0 or minus infinity."""
    return {
        entry: set().union(*[b.get(middle, set()) for middle in middles])
        for entry, middles in a.items()
    }


def prefix_scan(items: list, product: Callable) -> list:
    """Products of the first 1, 2, ... items; pairs are combined first, as in a parallel scan."""
    if len(items) < 2:
        return list(items)
    pairs = [product(items[i], items[i + 1]) for i in range(0, len(items) - 1, 2)]
    inner = prefix_scan(pairs, product)
    result = [items[0]]
    for i in range(1, len(items)):
        result.append(inner[i // 2] if i % 2 else product(inner[i // 2 - 1], items[i]))
    return result


def border_states(matrices: list[Matrix]) -> list[State]:
    """The states on the one path at all borders, that of the text's start and end included."""
    ahead = prefix_scan(matrices, combine)
    behind = prefix_scan(matrices[::-1], lambda a, b: combine(b, a))[::-1]
    start = (0, "")
    states = [start]
    for at in range(1, len(matrices)):
        reached = ahead[at - 1][start]
        states.append(next(s for s in reached if any(e[0] == 0 for e in behind[at].get(s, ()))))
    states.append(next(e for e in ahead[-1][start] if e[0] == 0))
    return states


def _as_rows(matrix: Matrix) -> list[dict]:
    return [
        {"over": entry[0], "piece": entry[1], "to_over": exit_[0], "to_piece": exit_[1]}
        for entry, exits in matrix.items()
        for exit_ in exits
    ]


CHUNK = "row long, chunk int, last boolean, start int, end int, text string"
LINK = "array<struct<over:int,piece:string,to_over:int,to_piece:string>>"


def _chunks(giants: DataFrame, longest: int) -> DataFrame:
    """Chunks of normalised texts with the context that pieces at their borders need."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, text in zip(batch["row"], batch["text"], strict=True):
                whole = normalised(text)
                count = -(-len(whole) // CHUNK_CHARS)
                for chunk in range(count):
                    start, end = chunk * CHUNK_CHARS, min((chunk + 1) * CHUNK_CHARS, len(whole))
                    left = max(0, start - longest)
                    yield pd.DataFrame(
                        [(row, chunk, chunk == count - 1, start - left, end - left, whole[left : end + longest])],
                        columns=["row", "chunk", "last", "start", "end", "text"],
                    )

    return giants.select("row", "text").mapInPandas(cut, CHUNK)


def _encoded_giants(giants: DataFrame, table: PieceTable, scratch: Scratch) -> DataFrame:
    """row and token_ids of texts of any length."""
    chunks = scratch.table(
        _chunks(giants, table.longest).repartition("row", "chunk"), "chunks"
    )

    def transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(table)
        for batch in batches:
            links = [
                _as_rows(codec.transfer(c.text, c.start, c.end, c.chunk == 0))
                for c in batch.itertuples()
            ]
            yield batch[["row", "chunk"]].assign(links=links)

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        matrices: list[Matrix] = []
        for links in group["links"]:
            matrix: Matrix = {}
            for link in links:
                matrix.setdefault((link["over"], link["piece"]), set()).add(
                    (link["to_over"], link["to_piece"])
                )
            matrices.append(matrix)
        states = border_states(matrices)
        return group[["row", "chunk"]].assign(
            over=[s[0] for s in states[:-1]],
            piece=[s[1] for s in states[:-1]],
            to_over=[s[0] for s in states[1:]],
            to_piece=[s[1] for s in states[1:]],
        )

    borders = (
        chunks.mapInPandas(transfers, f"row long, chunk int, links {LINK}")
        .groupBy("row")
        .applyInPandas(scan, "row long, chunk int, over int, piece string, to_over int, to_piece string")
    )

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(table)
        for batch in batches:
            ids = [
                np.frombuffer(
                    codec.trace(c.text, c.start, c.end, c.chunk == 0, (c.over, c.piece), (c.to_over, c.to_piece)),
                    dtype=np.int32,
                )
                for c in batch.itertuples()
            ]
            yield batch[["row", "chunk"]].assign(ids=ids)

    traced = chunks.join(borders, ["row", "chunk"]).mapInPandas(
        trace, "row long, chunk int, ids array<int>"
    )
    parts = F.array_sort(F.collect_list(F.struct("chunk", "ids")))
    return traced.groupBy("row").agg(F.flatten(parts.getField("ids")).alias("token_ids"))


def encode(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, n_tokens, token_ids and round_trip of every row of docs (doc_id, text).

    token_ids are those of the SentencePiece library with the same model. round_trip tells
    whether decoding them gives the text back; it does for every text without the character
    U+2581, which the model uses for spaces. Null and empty texts have no tokens (round_trip is
    true for the empty one and null for null); repeated rows are encoded each; an empty table gives no
    rows; other columns are not looked at. Starts jobs when called, as texts longer than
    CHUNK_CHARS are written in chunks.
    """
    table = PieceTable.load(model_file)
    scratch = Scratch(docs.sparkSession, "pieces")
    giant = F.length("text") > CHUNK_CHARS
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(table)
        for whole in batches:
            for at in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.iloc[at : at + ROWS_AT_ONCE]
                yield _result(codec, batch, codec.encode_all(batch["text"].tolist()))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(table)
        for whole in batches:
            for at in range(len(whole)):
                batch = whole.iloc[at : at + 1]
                yield _result(codec, batch, [array("i", ids) for ids in batch["token_ids"]])

    encoded = base.filter(~F.coalesce(giant, F.lit(False))).mapInPandas(short, RESULT)
    giants = scratch.table(
        base.filter(giant).withColumn("row", F.monotonically_increasing_id()), "giants"
    )
    if giants.isEmpty():
        return encoded
    traced = giants.join(_encoded_giants(giants, table, scratch), "row")
    return encoded.unionByName(traced.mapInPandas(check, RESULT))


RESULT = "doc_id long, n_tokens int, token_ids array<int>, round_trip boolean"


def _result(codec: Codec, batch: pd.DataFrame, ids: list[array]) -> pd.DataFrame:
    back = [
        None if text is None else codec.decode(numbers) == text
        for text, numbers in zip(batch["text"], ids, strict=True)
    ]
    return pd.DataFrame(
        {
            "doc_id": batch["doc_id"].astype("Int64").array,
            "n_tokens": [len(numbers) for numbers in ids],
            "token_ids": [np.frombuffer(numbers, dtype=np.int32) for numbers in ids],
            "round_trip": pd.Series(back, dtype=object),
        }
    )


def decode(tokens: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """tokens with the text of token_ids; null for null, empty for no ids.

    A null or unknown number among the ids gives a replacement character.
    """
    table = PieceTable.load(model_file)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(table)
        for batch in batches:
            yield pd.Series([None if i is None else codec.decode(i.tolist()) for i in batch], dtype=object)

    return tokens.withColumn("text", text_of("token_ids"))
