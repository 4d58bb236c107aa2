"""Near duplicates among embeddings by an epsilon grid order join.

Cosine >= t between unit vectors means a distance <= eps = sqrt(2 - 2 t). Vectors are turned to
their principal axes, which keeps distances; on the leading axes they fall into a grid of cells
of side eps. Sorted by cells (epsilon grid order) the vectors of a label form a sequence that is
cut into blocks. Blocks whose bounding boxes on the leading axes are further apart than eps are
skipped; of the others, sequence intervals are joined recursively, skipping distant halves,
down to small intervals that are compared exactly.

A pair of blocks returns, per vector, how many others it links to, and of the links only as many
as span the same groups; so a dense group costs no quadratic output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.ann import usable
from ledgerlens.llm.components import components
from ledgerlens.sources.scratch import Scratch

THRESHOLD = 0.93
AXES = 6
ROWS_PER_BLOCK = 512
ROWS_PER_RANGE = 2048
SMALL_INTERVAL = 128
SLACK = 1e-9


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector its AXES leading axes, from all rows (dims, embedding).

    Partial sums of products are combined by Spark; dims * dims numbers reach the driver.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, rows in batch.groupby("dims"):
                unit = np.hstack([_unit(_matrix(rows["embedding"])), np.ones((len(rows), 1))])
                product = unit.T @ unit
                total[dims] = total[dims] + product if dims in total else product
        for dims, product in total.items():
            yield pd.DataFrame(
                {"dims": dims, "cell": np.arange(product.size), "value": product.ravel()}
            )

    rows = (
        vectors.select("dims", "embedding")
        .mapInPandas(sums, "dims int, cell int, value double")
        .groupBy("dims", "cell").agg(F.sum("value").alias("value")).collect()
    )
    products: dict[int, np.ndarray] = {}
    for row in rows:
        side = row["dims"] + 1
        products.setdefault(row["dims"], np.zeros(side * side))[row["cell"]] = row["value"]
    axes = {}
    for dims, flat in products.items():
        product = flat.reshape(dims + 1, dims + 1)
        n = product[-1, -1]
        mean = product[-1, :-1] / n
        _, vectors_ = np.linalg.eigh(product[:-1, :-1] / n - np.outer(mean, mean))
        axes[dims] = vectors_[:, ::-1][:, :AXES]
    return axes


def _with_cells(vectors: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Adds place (coordinates on the leading axes) and cells (their grid numbers)."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place: list = [None] * len(batch)
            for dims, rows in batch.groupby("dims"):
                found = _unit(_matrix(rows["embedding"])) @ axes[dims]
                for at, coordinates in zip(batch.index.get_indexer(rows.index), found):
                    place[at] = coordinates
            yield batch.assign(
                place=place, cells=[np.floor(p / eps).astype(np.int32) for p in place]
            )

    schema = vectors.schema.simpleString()[7:-1]
    return vectors.mapInPandas(project, f"{schema},place:array<double>,cells:array<int>")


def _in_blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Adds block: runs of at most ROWS_PER_BLOCK rows of a label and length in grid order."""
    ranges = max(1, -(-rows // ROWS_PER_RANGE))
    order = ["dims", "label", "cells", "rep"]
    sequence = vectors.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    fields = vectors.schema.simpleString()[7:-1]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = (TaskContext.get().partitionId() << 32) - 1
        held, last = ROWS_PER_BLOCK, None
        for batch in batches:
            numbers = []
            for key in zip(batch["dims"], batch["label"]):
                if held == ROWS_PER_BLOCK or key != last:
                    block, held, last = block + 1, 0, key
                held += 1
                numbers.append(block)
            yield batch.assign(block=np.array(numbers, dtype=np.int64))

    return sequence.mapInPandas(cut, f"{fields},block:bigint")


def _block_pairs(rows: DataFrame, eps: float) -> DataFrame:
    """Pairs (first, second) of blocks of a label that may hold vectors within eps, first <= second.

    Blocks meet by the grid cells of the first axis that they reach, and stay together if their
    boxes on all leading axes are near enough.
    """
    low = [F.min(F.get("place", F.lit(i))).alias(f"low{i}") for i in range(AXES)]
    high = [F.max(F.get("place", F.lit(i))).alias(f"high{i}") for i in range(AXES)]
    boxes = rows.groupBy("dims", "label", "block").agg(
        *low, *high, F.min(F.col("cells")[0]).alias("from"), F.max(F.col("cells")[0]).alias("to")
    )
    a = boxes.withColumn("cell", F.explode(F.sequence("from", "to"))).alias("a")
    b = boxes.withColumn(
        "cell", F.explode(F.sequence(F.col("from") - 1, F.col("to") + 1))
    ).alias("b")
    gaps = [
        F.greatest(
            F.col(f"b.low{i}") - F.col(f"a.high{i}"), F.col(f"a.low{i}") - F.col(f"b.high{i}"), F.lit(0.0)
        )
        for i in range(AXES)
    ]
    # vectors shorter than AXES have no coordinate there, and no gap
    distance = sum((gap * gap for gap in gaps), F.lit(0.0))
    meet = (
        (F.col("a.dims") == F.col("b.dims"))
        & (F.col("a.label") == F.col("b.label"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.block") <= F.col("b.block"))
    )
    return (
        a.join(b, meet)
        .filter(distance <= (eps + SLACK) ** 2)
        .select(F.col("a.block").alias("first"), F.col("b.block").alias("second"))
        .distinct()
    )


class _IntervalJoin:
    """Joins the rows of two blocks, or of one with itself."""

    def __init__(self, rows: pd.DataFrame, threshold: float, eps: float) -> None:
        self.vectors = _matrix(rows["embedding"])
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.place = _matrix(rows["place"])
        self.copies = rows["copies"].to_numpy()
        self.threshold, self.reach = threshold, (eps + SLACK) ** 2
        self.links = np.zeros(len(rows), dtype=np.int64)
        self.parent = np.arange(len(rows))

    def _root(self, at: int) -> int:
        while self.parent[at] != at:
            self.parent[at] = self.parent[self.parent[at]]
            at = self.parent[at]
        return at

    def _compare(self, a: slice, b: slice) -> None:
        cosine = (self.vectors[a] @ self.vectors[b].T) / np.outer(self.norms[a], self.norms[b])
        linked = cosine >= self.threshold
        if a == b:
            linked = np.triu(linked, 1)
        if not linked.any():
            return
        self.links[a] += linked @ self.copies[b]
        self.links[b] += self.copies[a] @ linked
        # each row takes its first link; the others only where they join something new
        for i in np.flatnonzero(linked.any(axis=1)):
            others = np.flatnonzero(linked[i]) + b.start
            roots = {self._root(o) for o in np.unique(self.parent[others])}
            mine = self._root(i + a.start)
            for root in roots - {mine}:
                self.parent[max(root, mine)] = min(root, mine)
                mine = min(root, mine)

    def join(self, a: slice, b: slice) -> None:
        gap = np.maximum(
            np.maximum(
                self.place[b].min(axis=0) - self.place[a].max(axis=0),
                self.place[a].min(axis=0) - self.place[b].max(axis=0),
            ),
            0.0,
        )
        if a != b and (gap**2).sum() > self.reach:
            return
        wide, other = a.stop - a.start, b.stop - b.start
        if max(wide, other) <= SMALL_INTERVAL:
            self._compare(a, b)
        elif a == b:
            middle = (a.start + a.stop) // 2
            self.join(slice(a.start, middle), slice(a.start, middle))
            self.join(slice(a.start, middle), slice(middle, a.stop))
            self.join(slice(middle, a.stop), slice(middle, a.stop))
        elif wide >= other:
            middle = (a.start + a.stop) // 2
            self.join(slice(a.start, middle), b)
            self.join(slice(middle, a.stop), b)
        else:
            middle = (b.start + b.stop) // 2
            self.join(a, slice(b.start, middle))
            self.join(a, slice(middle, b.stop))


def _joined(rows: DataFrame, pairs: DataFrame, threshold: float, eps: float) -> DataFrame:
    """rep, links and, where a link is needed to span a group, other, for each pair of blocks."""
    sides = pairs.select(
        "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block")
    )
    members = rows.select("block", "rep", "copies", "cells", "embedding", "place").join(sides, "block")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        first, second = group["first"].iloc[0], group["second"].iloc[0]
        group = group.assign(
            _cells=group["cells"].map(tuple), _later=group["block"] != first
        ).sort_values(["_later", "_cells", "rep"], ignore_index=True)
        work = _IntervalJoin(group, threshold, eps)
        cut = int((group["block"] == first).sum())
        whole = slice(0, cut)
        work.join(whole, whole if first == second else slice(cut, len(group)))
        reps = group["rep"].to_numpy()
        roots = np.array([work._root(i) for i in range(len(group))])
        used = work.links > 0
        return pd.DataFrame({"rep": reps[used], "other": reps[roots[used]], "links": work.links[used]})

    return members.groupBy("first", "second").applyInPandas(
        compare, "rep long, other long, links long"
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, label, n_links, component_id and kept of every row of vectors (vec_id, embedding, label).

    Two vectors link if their labels are equal and their cosine in double precision is at least
    threshold. n_links counts the other rows linked directly; component_id is the smallest vec_id
    reachable by links; kept is vec_id = component_id. Rows without label or vec_id, and vectors
    that are not `usable`, link with nothing: 0 links, their own component, kept (null without a
    vec_id). Equal vectors of a label are compared once and counted as often as they stand there,
    repeated ids included. Vectors of different lengths never link. An empty table gives no
    rows. Starts jobs when called.
    """
    scratch = Scratch(vectors.sparkSession, "grid-order")
    eps = float(np.sqrt(2.0 - 2.0 * threshold))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    takes_part = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    )
    distinct = scratch.table(
        rows.filter(takes_part)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dims", F.size("embedding")),
        "distinct",
    )
    placed = _with_cells(distinct, principal_axes(distinct), eps)
    blocks = scratch.table(_in_blocks(placed, distinct.count()), "blocks")
    found = scratch.table(_joined(blocks, _block_pairs(blocks, eps), threshold, eps), "links")
    groups = components(found.select(F.col("rep").alias("u"), F.col("other").alias("v")), scratch)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        distinct.select("label", "embedding", "rep", "copies")
        .join(links, "rep", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = rows.filter(takes_part).join(known, ["label", "embedding"])
    alone = rows.filter(~takes_part).select(
        "label", "embedding", "vec_id", F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").alias("component_id"),
    )
    return (
        linked.select(*alone.columns)
        .unionByName(alone)
        .select(
            "vec_id", "label", "n_links", "component_id",
            (F.col("vec_id") == F.col("component_id")).alias("kept"),
        )
    )
