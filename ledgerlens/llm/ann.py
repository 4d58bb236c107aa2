"""Approximate nearest neighbours by a forest of hash-prefix trees (LSH forest).

Every vector gets one long hash string per tree: the sides of random hyperplanes through the
mean that it lies on. A tree is the sorted array of its strings. A query finds its longest
matching prefixes by binary search (descent), then all trees shorten the prefix together
(synchronous ascent) until they hold enough candidates, and on until a row nearer than the k-th
of these is missed with a small chance only, whatever the vectors; they are ranked by exact cosine.

All rows are indexed. The index is cut into shards of bounded size by hash; blocks of queries
visit every shard, and the nearest of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 32
BITS = 24
ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 1024
#: Candidates that all trees of a shard gather per query, repeats counted, as a share of
#: TREES * rows of the shard, and at least so many per tree.
CANDIDATE_SHARE = 1 / 32
LEAST_CANDIDATES = 64
#: Highest chance that the trees of a shard hold no copy of one of its nearest rows.
MISSED = 0.02
SEED = 5


def usable(vector: Column) -> Column:
    """Whether a vector is not null, has no null or non-finite component, and is not zero."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with query; equal rows get equal values."""
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


class PrefixForest:
    """Sorted hash strings of one shard, a column per tree, and its unit vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.unit = unit
        self.centre = unit.mean(axis=0)
        far = np.linalg.norm(unit - self.centre, axis=1)
        self.least_far, self.most_far = far.min(), far.max()
        self.planes = np.random.default_rng(SEED).normal(size=(vectors.shape[1], TREES * BITS))
        codes = self._codes(unit)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=0)

    def _codes(self, unit: np.ndarray) -> np.ndarray:
        sides = ((unit - self.centre) @ self.planes > 0).reshape(len(unit), TREES, BITS)
        return sides @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def candidates(
        self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int
    ) -> list[np.ndarray]:
        """Row numbers for each query (of id own), k of other ids wanted among the rows' ids.

        A first ascent stops at the longest prefix at which the trees hold enough. The k-th
        nearest found there bounds the angle of every nearer row, and so the chance that no tree
        holds it; where this is above MISSED, the trees ascend to the prefix at which it is not.
        """
        rows = len(self.codes)
        enough = min(
            TREES * max(LEAST_CANDIDATES, int(CANDIDATE_SHARE * rows)), TREES * rows
        )
        asked = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        codes = self._codes(asked)
        low = np.zeros((len(queries), TREES), dtype=np.int64)
        high = np.zeros_like(low)
        bits = np.zeros(len(queries), dtype=np.int64)

        def ascend(some: np.ndarray, length: int) -> None:
            dropped = BITS - length
            first = (codes[some] >> dropped) << dropped
            for tree in range(TREES):
                low[some, tree] = np.searchsorted(self.codes[:, tree], first[:, tree])
                high[some, tree] = np.searchsorted(
                    self.codes[:, tree], first[:, tree] + (1 << dropped)
                )
            bits[some] = length

        waiting = np.arange(len(queries))
        for length in range(BITS, -1, -1):
            ascend(waiting, length)
            held = (high[waiting] - low[waiting]).sum(axis=1)
            waiting = waiting[held < enough]
            if not len(waiting):
                break

        def held_rows(query: int) -> np.ndarray:
            chosen = np.zeros(rows, dtype=bool)
            for tree in range(TREES):
                chosen[self.order[low[query, tree] : high[query, tree], tree]] = True
            return np.flatnonzero(chosen)

        found = [held_rows(query) for query in range(len(queries))]
        safe = np.array(
            [
                self._safe_bits(query, at[ids[at] != mine], ids, k)
                for query, mine, at in zip(asked, own, found, strict=True)
            ],
            dtype=np.int64,
        )
        for length in np.unique(safe[safe < bits]):
            some = np.flatnonzero((safe == length) & (safe < bits))
            ascend(some, int(length))
            for query in some:
                found[query] = held_rows(query)
        return found

    def _safe_bits(self, query: np.ndarray, at: np.ndarray, ids: np.ndarray, k: int) -> int:
        """Longest prefix at which a row nearer than the k-th of the rows at is hardly missed.

        Hyperplanes go through the centre: a row at an angle seen from there shares a prefix of
        a tree with chance (1 - angle / pi) ** bits. The angle follows from the distance and from
        how far the query and the row are from the centre.
        """
        squared = 2 - 2 * (self.unit[at] @ query)
        order = np.argsort(squared)
        # a few copies of an id may stand in front, so k distinct ids are looked for
        _, first = np.unique(ids[at][order], return_index=True)
        if len(first) < k:
            return 0
        reach = max(squared[order[np.sort(first)[k - 1]]], 0.0) + 1e-12
        apart = ((query - self.centre) ** 2).sum()
        # where the angle is widest
        far = np.clip(np.sqrt(max(apart - reach, 0.0)), self.least_far, self.most_far)
        if apart == 0 or far == 0:
            return 0
        cosine = (apart + far * far - reach) / (2 * np.sqrt(apart) * far)
        share = 1 - np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi
        if share <= 0:
            return 0
        return int(min(BITS, np.log(1 - MISSED ** (1 / TREES)) / min(np.log(share), -1e-9)))


def _nearest(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int):
    """Ids and cosines of the k nearest rows of another id, ties to the smaller id."""
    other = ids != own
    vectors, ids = vectors[other], ids[other]
    if not len(ids):
        return []
    rough = (vectors @ query) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))
    # a few copies of an id may stand in front, so k distinct ids are looked for
    least = rough.min() if len(rough) <= k else np.partition(rough, -k)[-k] - 1e-9
    while True:
        near = np.flatnonzero(rough >= least)
        if len(np.unique(ids[near])) >= k or len(near) == len(ids):
            break
        least = rough[rough < least].max() - 1e-9
    scores = cosines(vectors[near], query)
    result, seen = [], set()
    for at in np.lexsort((ids[near], -scores)):
        vec_id = int(ids[near][at])
        if vec_id not in seen:
            seen.add(vec_id)
            result.append((vec_id, float(scores[at])))
            if len(result) == k:
                break
    return result


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest candidates found for each query: query_id, rank, vec_id, score.

    vectors and queries: vec_id, embedding. Nearness is the largest cosine in double precision
    on the given vectors, ties to the smaller vec_id. A row's own vec_id is no candidate. Rows
    without vec_id and vectors that are not `usable` take no part; vectors of different lengths
    are never compared; identical rows count once; a query that stands in several rows with
    different vectors is answered for each of them. An empty table gives no rows. Starts jobs when
    called, to count.
    """
    def clean(rows: DataFrame) -> DataFrame:
        return (
            rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
            .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .distinct()
            .withColumn("dims", F.size("embedding"))
        )

    base, asked = clean(vectors), clean(queries)
    shards = max(1, -(-base.count() // ROWS_PER_SHARD))
    blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    mark = F.xxhash64("vec_id", "embedding")
    left = base.withColumn("shard", F.pmod(mark, F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = asked.withColumn("mark", mark).withColumn("block", F.pmod(mark, F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    schema = "query_id long, mark long, vec_id long, score double"

    def visit(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(rows) and len(asked):
            matrix = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
            questions = np.stack(asked["embedding"].to_numpy()).astype(np.float64)
            ids = rows["vec_id"].to_numpy()
            chosen = PrefixForest(matrix).candidates(
                questions, ids, asked["vec_id"].to_numpy(), k
            )
            for own, mark, query, at in zip(asked["vec_id"], asked["mark"], questions, chosen):
                for vec_id, score in _nearest(matrix[at], ids[at], query, own, k):
                    found.append((own, mark, vec_id, score))
        return pd.DataFrame(found, columns=["query_id", "mark", "vec_id", "score"])

    key = ["dims", "shard", "block"]
    merged = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(visit, schema)
    # one id may come from several shards with different vectors: its best counts
    best = merged.groupBy("query_id", "mark", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
