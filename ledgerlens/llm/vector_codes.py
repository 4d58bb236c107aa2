"""Product codes of vectors: integer codebooks by rounds of nearest-entry assignment.

Vectors become integers and are cut into equal parts. The parts of each position are sorted along
a Hilbert curve of their own space and stored as flat blocks of consecutive ones, with the box
(least and greatest value per component) and the sum of the block. In a round, the distances of a
box to the codebook's entries give the block's shortlist: an entry that is farther from the
nearest corner than another is from the farthest one is nearest to no member. A block with one
entry left is assigned as a whole from its sum; the members of the others are compared with the
shortlist alone, in integers. Only codebooks and their sums pass the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.heavy_join import attach
from ledgerlens.sources.scratch import Scratch

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Members of a block.
BLOCK_ROWS = 512
#: Below this size squared distances of parts fit 64 bits; larger ones use Python's integers.
LARGEST_FAST = 1 << 26
KEY_BITS = 62

RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cells (unsigned, below 2**bits).

    Works on the bits in place: turns of the curve are undone from the highest bit on, a Gray
    code puts the cells of one level in order, and the bits of all axes are interleaved.
    """
    axes = [column.astype(np.int64) for column in cells.T]
    for level in range(bits - 1, 0, -1):
        below = np.int64((1 << level) - 1)
        for axis in axes:
            upper = (axis >> level & 1).astype(bool)
            swap = np.where(upper, 0, (axes[0] ^ axis) & below)
            flip = np.where(upper, below, swap)
            if axis is axes[0]:
                axis ^= flip
            else:
                axes[0] ^= flip
                axis ^= swap
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    turned = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] >> level & 1, np.int64((1 << level) - 1), 0)
    keys = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << 1 | ((axis ^ turned) >> level & 1)
    return keys


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Layout:
    """How parts are stored: their length, the extent of every component, the stored type."""

    dims: int
    parts: int
    low: list[int]
    high: list[int]

    @property
    def width(self) -> int:
        return self.dims // self.parts

    @property
    def kind(self) -> str:
        size = max(max(self.high), -min(self.low))
        return "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"

    @property
    def is_fast(self) -> bool:
        size = max(max(self.high), -min(self.low))
        return size < LARGEST_FAST and self.width <= 256

    def exact(self, values: np.ndarray) -> np.ndarray:
        return values.astype(np.int64 if self.is_fast else object)

    def keys(self, values: np.ndarray, part: int) -> np.ndarray:
        """Hilbert keys of the parts at one position, from as many leading axes as fit a key."""
        axes = min(self.width, KEY_BITS)
        bits = max(1, min(16, KEY_BITS // axes))
        at = slice(part * self.width, part * self.width + axes)
        low = np.array(self.low[at], dtype=np.float64)
        extent = np.maximum(np.array(self.high[at], dtype=np.float64) - low, 1.0)
        share = (values[:, :axes].astype(np.float64) - low) / extent
        cells = np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1)
        return hilbert_keys(cells, bits)


def _integers(vectors: DataFrame, scale: int, parts: int, scratch: Scratch) -> DataFrame:
    """row, vec_id, label and integer components of the vectors that take part."""
    x = F.col("embedding")
    usable = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return scratch.table(
        vectors.filter(x.isNotNull() & usable).select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            "label",
            F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale)))).alias("components"),
        ),
        "integers",
    )


def _extents(integers: DataFrame, dims: int) -> tuple[list[int], list[int]]:
    """Least and greatest value of every component; a task adds one row per component."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            values = _matrix(batch["components"], dims)
            if len(values):
                least, most = values.min(axis=0), values.max(axis=0)
                low = least if low is None else np.minimum(low, least)
                high = most if high is None else np.maximum(high, most)
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high)],
                names=["at", "low", "high"],
            )

    rows = (
        integers.select("components")
        .mapInArrow(of_task, "at int, low long, high long")
        .groupBy("at")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    rows.sort(key=lambda row: row["at"])
    return [row["low"] for row in rows], [row["high"] for row in rows]


BLOCK = "part int, n int, rows binary, members binary, low binary, high binary, sums binary"


def _blocks(integers: DataFrame, layout: Layout, block_rows: int, scratch: Scratch) -> DataFrame:
    """Flat blocks of parts that are neighbours on the Hilbert curve of their position.

    Parts are dealt out by ranges of the curve, equal ones by row, so many equal vectors fill many
    blocks in many tasks.
    """
    width, kind = layout.width, np.dtype(layout.kind)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch["components"], layout.dims)
            for part in range(layout.parts):
                members = values[:, part * width : (part + 1) * width]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(members), part, dtype=np.int32)),
                        pa.array(layout.keys(members, part)),
                        batch["row"],
                        _binary(members.astype(kind)),
                    ],
                    names=["part", "key", "row", "member"],
                )

    def flat(part: int, rows: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
        # sums are only used where they fit; long ones are made of the members again
        sums = members.astype(np.int64).sum(axis=0) if layout.is_fast else np.zeros(0, np.int64)
        ends = [members.min(axis=0).astype("<i8"), members.max(axis=0).astype("<i8"), sums]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([len(rows)], pa.int32()),
                *[pa.array([array.tobytes()], pa.binary()) for array in (rows, members, *ends)],
            ],
            names=["part", "n", "rows", "members", "low", "high", "sums"],
        )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, members = -1, np.zeros(0, "<i8"), np.zeros((0, width), kind)
        for batch in batches:
            position = batch["part"].to_numpy()
            batch_rows = batch["row"].to_numpy()
            data = b"".join(batch["member"].to_pylist())
            batch_members = np.frombuffer(data, kind).reshape(-1, width)
            borders = [0, *(np.flatnonzero(np.diff(position)) + 1).tolist(), len(position)]
            for start, end in zip(borders, borders[1:]):
                if start == end:
                    continue
                if position[start] != current:
                    if len(rows):
                        yield flat(current, rows, members)
                    current, rows, members = int(position[start]), rows[:0], members[:0]
                rows = np.concatenate([rows, batch_rows[start:end]])
                members = np.concatenate([members, batch_members[start:end]])
                while len(rows) >= block_rows:
                    yield flat(current, rows[:block_rows], members[:block_rows])
                    rows, members = rows[block_rows:], members[block_rows:]
        if len(rows):
            yield flat(current, rows, members)

    order = ["part", "key", "row"]
    parts = integers.select("row", "components").mapInArrow(
        keyed, "part int, key long, row long, member binary"
    )
    sorted_parts = parts.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.table(
        sorted_parts.select("part", "row", "member").mapInArrow(fill, BLOCK), "blocks"
    )


class Assigner:
    """Nearest entries of the members of blocks."""

    def __init__(self, layout: Layout, codebooks: list[list[list[int]]]) -> None:
        self.layout = layout
        kind = np.int64 if layout.is_fast else object
        self.codebooks = [np.array(book, dtype=kind) for book in codebooks]
        self.squares = [(book * book).sum(axis=1) for book in self.codebooks]

    def shortlist(self, part: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries that can be nearest to a point of the box, equal ones included, ascending."""
        book = self.codebooks[part]
        outside = np.maximum(np.maximum(low - book, book - high), 0)
        reach = np.maximum(abs(book - low), abs(book - high))
        nearest, farthest = (outside * outside).sum(axis=1), (reach * reach).sum(axis=1)
        return np.flatnonzero(nearest <= farthest.min())

    def distances(self, part: int, members: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Exact squared distances of members to entries, without the members' own squares."""
        book = self.codebooks[part][entries]
        return self.squares[part][entries] - 2 * members.dot(book.T)

    def codes(self, part: int, members: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Nearest entry of every member, the lower of equal ones."""
        return entries[self.distances(part, members, entries).argmin(axis=1)]

    def read(self, block: dict) -> tuple[int, np.ndarray, np.ndarray]:
        """Position, shortlist and members of a block."""
        part, width = block["part"], self.layout.width
        low, high = (self.layout.exact(np.frombuffer(block[end], "<i8")) for end in ("low", "high"))
        members = np.frombuffer(block["members"], self.layout.kind).reshape(-1, width)
        return part, self.shortlist(part, low, high), members

    def totals(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members and sum of their components per entry that any block of the task uses."""
        count: dict[tuple[int, int], int] = {}
        total: dict[tuple[int, int], np.ndarray] = {}

        def add(part: int, entry: int, n: int, sums: np.ndarray) -> None:
            key = (part, entry)
            count[key] = count.get(key, 0) + n
            # Python's integers have room for any number of rows
            total[key] = total.get(key, 0) + sums.astype(object)

        for batch in batches:
            for block in batch.to_pylist():
                part, entries, members = self.read(block)
                if len(entries) == 1 and self.layout.is_fast:
                    add(part, int(entries[0]), block["n"], np.frombuffer(block["sums"], "<i8"))
                    continue
                members = self.layout.exact(members)
                codes = self.codes(part, members, entries)
                for entry in np.unique(codes):
                    own = members[codes == entry]
                    add(part, int(entry), len(own), own.sum(axis=0))
        for (part, entry), sums in total.items():
            width = len(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * width, pa.int32()),
                    pa.array([entry] * width, pa.int32()),
                    pa.array(range(width), pa.int32()),
                    pa.array([count[part, entry]] * width, pa.int64()),
                    pa.array([str(value) for value in sums]),
                ],
                names=["part", "entry", "at", "n", "total"],
            )

    def coded(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """row, its code at this position shifted to its place, and the squared distance."""
        for batch in batches:
            for block in batch.to_pylist():
                part, entries, members = self.read(block)
                members = self.layout.exact(members)
                codes = self.codes(part, members, entries)
                away = members - self.codebooks[part][codes]
                errors = (away * away).sum(axis=1)
                shift = 8 * (self.layout.parts - 1 - part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(block["rows"], "<i8")),
                        pa.array(codes.astype(np.int64) << shift),
                        pa.array(errors)
                        if self.layout.is_fast
                        else pa.array([Decimal(int(value)) for value in errors], pa.decimal128(38, 0)),
                    ],
                    names=["row", "code", "error"],
                )


def _updated(blocks: DataFrame, layout: Layout, codebooks: list[list[list[int]]]) -> list[list[list[int]]]:
    """Codebooks after a round; entries without members stay."""
    totals = (
        blocks.select("part", "n", "members", "low", "high", "sums")
        .mapInArrow(Assigner(layout, codebooks).totals, "part int, entry int, at int, n long, total string")
        .groupBy("part", "entry", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    )
    result = [[list(entry) for entry in book] for book in codebooks]
    for row in totals.collect():  # at most one row per number of the codebooks
        result[row["part"]][row["entry"]][row["at"]] = int(row["total"]) // row["n"]
    return result


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row of vectors.

    vectors has vec_id, embedding and label; other columns are not looked at. Vectors that are
    null or hold null or non-finite components are dropped. All vectors must have the length of
    the first one by vec_id, a multiple of parts; those of other lengths are dropped too, and no
    row is returned if the first one cannot be cut. Codebooks start from the smallest vec_ids, null
    last, rows of one vec_id by their components; with fewer rows than entries all rows start one. Repeated rows are
    coded each. Errors are exact, null where one does not fit a long; components are exact up to
    2**51 in size. An empty table gives no rows. Runs several jobs when called.
    """
    if parts > 8 or entries > 127:
        raise ValueError("codes have room for 8 parts and 127 entries")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vector-codes")
    integers = _integers(vectors, scale, parts, scratch)
    in_order = [F.asc_nulls_last("vec_id"), F.asc("components")]
    first = integers.orderBy(*in_order).limit(1).collect()
    dims = len(first[0]["components"]) if first else 0
    if not dims or dims % parts:
        return spark.createDataFrame([], RESULT)
    integers = integers.filter(F.size("components") == dims)
    seeds = [row["components"] for row in integers.orderBy(*in_order).limit(entries).collect()]
    layout = Layout(dims, parts, *_extents(integers, dims))
    blocks = _blocks(integers, layout, block_rows, scratch)

    width = layout.width
    codebooks = [[seed[part * width : (part + 1) * width] for seed in seeds] for part in range(parts)]
    for _ in range(rounds):
        codebooks = _updated(blocks, layout, codebooks)

    numbers = ",".join(str(value) for book in codebooks for entry in book for value in entry)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    kind = "long" if layout.is_fast else "decimal(38,0)"
    codes = (
        blocks.select("part", "rows", "members", "low", "high")
        .mapInArrow(Assigner(layout, codebooks).coded, f"row long, code long, error {kind}")
        .groupBy("row")
        .agg(
            F.lower(F.lpad(F.hex(F.sum("code")), 2 * parts, "0")).alias("code"),
            F.sum("error").try_cast("long").alias("error"),
        )
    )
    coded = scratch.table(
        integers.select("row", "vec_id", "label").join(codes, "row").drop("row"), "coded"
    )
    of_label = scratch.table(
        coded.groupBy(F.col("label").alias("of_label")).agg(
            F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"),
            F.count(F.lit(1)).alias("n"),
        ),
        "labels",
    )
    return attach(coded, of_label, {"label": "of_label"}, "n").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
