"""Near duplicates among texts: BagMinHash signatures, bands, and verified multiset overlap.

1. Texts with the same words are one class each (exact copies), found by digest.
2. Signatures of the classes are cut into bands; classes that share a band's hash meet.
3. In every such bucket all members are compared with its smallest one, first each member
   with the bucket leader it meets most often, then with the other leaders it is not yet linked to.
4. In buckets whose members are still not all linked, blocks of members are compared with each
   other in one task each: first on one byte per slot, then, if that looks similar enough, exactly.

A pair is verified on the exact overlap of the multisets of five-word shingles. Links make
components. No bucket is gathered in one task and no dense group gives all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import bag_minhash as bags
from ledgerlens.llm.components import components
from ledgerlens.operators.prefix_scan import prefix_scan
from ledgerlens.sources.scratch import Scratch

SIMILARITY = 0.8
#: Estimate below which a pair is not verified: over four standard errors under SIMILARITY.
LEAST_ESTIMATE = SIMILARITY - 4.2 * (SIMILARITY * (1 - SIMILARITY) / bags.SLOTS) ** 0.5
BLOCK_ROWS = 256

SIGNED = "doc_id long, digest binary, weight long, bands array<long>, sketch binary"


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words))


def _signed(docs: DataFrame) -> DataFrame:
    """Digest of the words, number of shingles, bands and sketch of each text with words."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = bags.WordHashes()
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].to_numpy()
            for start, end, words in bags.sized_batches(texts):
                shingles = [bags.shingle_hashes(hashes.of(w)) for w in words]
                signature = bags.signatures(bags.Bags.of(shingles))
                rows = np.array([bool(w) for w in words])
                if not rows.any():
                    continue
                yield pd.DataFrame(
                    {
                        "doc_id": ids[start:end][rows],
                        "digest": [_digest(w) for w in words if w],
                        "weight": [len(s) for s in shingles if len(s)],
                        "bands": list(bags.bands(signature)[rows]),
                        "sketch": [s.tobytes() for s in bags.sketch(signature)[rows]],
                    }
                )

    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    ).mapInPandas(sign, SIGNED)


def _items(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and packed shingle items of the documents in ids (doc_id, digest)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = bags.WordHashes()
        for batch in batches:
            rows = []
            for doc_id, digest, text in zip(batch["doc_id"], batch["digest"], batch["text"], strict=True):
                words = bags.words_of(text)
                if _digest(words) == bytes(digest):  # else a repeated id with another text
                    numbers = bags.items(bags.shingle_hashes(hashes.of(words)))
                    rows.append((doc_id, bags.packed(numbers)))
            yield pd.DataFrame(rows, columns=["doc_id", "items"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(
        "text IS NOT NULL"
    )
    found = texts.join(ids, "doc_id").mapInPandas(pack, "doc_id long, items binary")
    return found.dropDuplicates(["doc_id"])


def _verified(pairs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose multisets overlap enough."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = np.array(
                [
                    bags.similarity(bags.unpacked(a), bags.unpacked(b)) >= threshold
                    for a, b in zip(batch["a"], batch["b"], strict=True)
                ],
                dtype=bool,
            )
            yield batch.loc[linked, ["u", "v"]]

    left = items.select(F.col("doc_id").alias("u"), F.col("items").alias("a"))
    right = items.select(F.col("doc_id").alias("v"), F.col("items").alias("b"))
    return pairs.join(left, "u").join(right, "v").mapInPandas(verify, "u long, v long")


def _labelled(rows: DataFrame, groups: DataFrame, node: str, label: str) -> DataFrame:
    """rows with the component of column node, itself if it has no link."""
    named = groups.select(F.col("node").alias(node), F.col("component").alias("_component"))
    return rows.join(named, node, "left").withColumn(
        label, F.coalesce("_component", node)
    ).drop("_component")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    both = _labelled(_labelled(pairs, groups, "u", "_u"), groups, "v", "_v")
    return both.filter("_u != _v").drop("_u", "_v")


def _mixed_buckets(met: DataFrame, groups: DataFrame) -> DataFrame:
    """key, band, blocks of the buckets of three or more whose members are not all linked.

    Buckets of the same members count once, in their lowest band.
    """
    return (
        _labelled(met.filter("n > 2").select("key", "band", "doc_id"), groups, "doc_id", "component")
        .groupBy("key", "band")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("doc_id")).alias("mark"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .filter("low != high")
        .groupBy("n", "mark").agg(F.min(F.struct("band", "key")).alias("b"))
        .select("b.key", "b.band", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    )


def _bucket_links(
    members: DataFrame, groups: DataFrame, classes: DataFrame, items: DataFrame, threshold: float
) -> DataFrame:
    """Links (u, v) between different components in buckets that hold several of them.

    members: key, band, blocks, doc_id. Each bucket is cut into blocks by hash, and each pair of
    blocks is worked on by itself. A pair is looked at in the first band in which it meets, and
    verified if its sketches look alike; only links that join something are returned.
    """
    least = LEAST_ESTIMATE
    dealt = (
        _labelled(members, groups, "doc_id", "component")
        .join(classes.select("doc_id", "bands", "sketch"), "doc_id")
        .join(items, "doc_id")
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", "band", "doc_id", "component", "bands", "sketch", "items", "own",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sketch = np.frombuffer(b"".join(group["sketch"]), dtype=np.uint8).reshape(len(group), -1)
        earlier = np.stack(group["bands"].to_numpy())[:, : group["band"].iloc[0]]
        ids, own = group["doc_id"].to_numpy(), group["own"].to_numpy()
        component = group["component"].to_numpy().copy()
        numbers = [bags.unpacked(data) for data in group["items"]]
        sizes = np.array([len(n) for n in numbers])
        split = group["i"].iloc[0] != group["j"].iloc[0]
        found = []
        for at in range(len(group)):
            fits = (component != component[at]) & (ids > ids[at])
            fits &= np.minimum(sizes, sizes[at]) >= threshold * np.maximum(sizes, sizes[at])
            if split:
                fits &= own != own[at]
            other = np.flatnonzero(fits)
            other = other[~(earlier[other] == earlier[at]).any(axis=1)]
            alike = (sketch[other] == sketch[at]).mean(axis=1)
            for to in other[np.argsort(-alike, kind="stable")][: int((alike >= least).sum())]:
                if component[to] != component[at] and bags.similarity(numbers[at], numbers[to]) >= threshold:
                    found.append((ids[at], ids[to]))
                    component[component == component[to]] = component[at]
        return pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    return dealt.groupBy("key", "band", "i", "j").applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, component_id and kept of every row of docs (doc_id, text).

    class_id is the smallest doc_id of the texts with the same words, component_id the smallest
    one reachable by links, a link being a similarity of at least threshold between the
    multisets of five-word shingles; kept is doc_id = component_id. A text of fewer words is one
    shingle. Texts without words, null ones and rows without doc_id link with nothing: they are
    their own class and kept (kept is true, the ids null, without a doc_id). Rows that repeat a
    doc_id count as one document, with the text of the smallest digest. An empty table gives no rows. Starts jobs when called.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    signed = scratch.table(_signed(docs), "signed")
    if not signed.groupBy("doc_id").count().filter("count > 1").isEmpty():
        one = signed.groupBy("doc_id").agg(F.min_by(F.struct(*signed.columns), "digest").alias("r"))
        signed = scratch.table(one.select("r.*"), "signed")
    chosen = signed.groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "weight", "bands", "sketch"), "doc_id").alias("c")
    )
    classes = scratch.table(chosen.select("digest", "c.*"), "classes")

    entries = classes.select("doc_id", F.posexplode("bands").alias("band", "key"))
    buckets = (
        entries.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("leader"))
        .filter("n > 1")
    )
    met = scratch.table(
        entries.join(buckets, "key").select("key", "band", "n", "leader", "doc_id"), "met"
    )
    sizes = classes.select("doc_id", "weight")

    def near_in_size(pairs: DataFrame) -> DataFrame:
        a = sizes.select(F.col("doc_id").alias("u"), F.col("weight").alias("_a"))
        b = sizes.select(F.col("doc_id").alias("v"), F.col("weight").alias("_b"))
        fits = F.least("_a", "_b") >= threshold * F.greatest("_a", "_b")
        return pairs.join(a, "u").join(b, "v").filter(fits).drop("_a", "_b")

    stars = scratch.table(
        near_in_size(
            met.filter("doc_id != leader")
            .groupBy(F.col("leader").alias("u"), F.col("doc_id").alias("v"))
            .agg(F.count(F.lit(1)).alias("times"))
        ),
        "stars",
    )
    digests = classes.select("doc_id", "digest")
    ids = stars.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    items = scratch.table(_items(docs, ids.join(digests, "doc_id")), "items")

    best = stars.groupBy("v").agg(F.max_by("u", F.struct("times", -F.col("u"))).alias("u"))
    links = scratch.table(_verified(best.select("u", "v"), items, threshold), "links")
    groups = scratch.table(components(links, scratch), "groups")

    tried = best.select("u", "v")
    others = _apart(stars.select("u", "v").join(tried, ["u", "v"], "left_anti"), groups)
    more = scratch.table(_verified(others, items, threshold), "links")
    links = links.unionByName(more)
    if not more.isEmpty():
        groups = scratch.table(components(links, scratch), "groups")

    mixed = met.select("key", "doc_id").join(_mixed_buckets(met, groups), "key")
    mixed = scratch.table(mixed, "mixed")
    if not mixed.isEmpty():
        ids = mixed.select("doc_id").distinct().join(items, "doc_id", "left_anti")
        extra = scratch.table(_items(docs, ids.join(digests, "doc_id")), "items")
        more = _bucket_links(mixed, groups, classes, items.unionByName(extra), threshold)
        more = scratch.table(more, "links")
        if not more.isEmpty():
            groups = scratch.table(components(links.unionByName(more), scratch), "groups")

    named = _labelled(
        classes.select("digest", F.col("doc_id").alias("class_id")), groups, "class_id", "component_id"
    )
    known = signed.select("doc_id", "digest").join(named, "digest").drop("digest")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.join(known, "doc_id", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """docs without the documents that are not the first of their component.

    Rows that share a doc_id but not the text are documents of their own, ranked by doc_id and then
    by a hash of the text; rows that repeat both stay or go together. Rows with a null text or
    doc_id, and texts without words, stay. An empty table stays empty; all columns are kept,
    whatever their names.
    """
    text = F.xxhash64(F.col("text"))
    reused = (
        docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.min(text) != F.max(text)).alias("reused"))
        .filter("reused")
    )
    if reused.isEmpty():
        dropped = near_duplicates(docs, threshold).filter(~F.col("kept")).select("doc_id").distinct()
        kept = docs.join(dropped, "doc_id", "left_anti")
        return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
    # every text gets a number of its own, in the order of doc_id
    scratch = Scratch(docs.sparkSession, "reused-ids")
    texts = (
        docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
        .groupBy(F.col("doc_id").alias("id"), text.alias("mark"))
        .agg(F.first("text").alias("text"))
    )
    numbered = prefix_scan(scratch.table(texts, "texts"), [F.asc("id"), F.asc("mark")], [], scratch)
    numbered = scratch.table(numbered.withColumnRenamed("row_rank", "doc_id"), "numbered")
    found = near_duplicates(numbered.select("doc_id", "text"), threshold).filter(~F.col("kept"))
    gone = numbered.join(found.select("doc_id"), "doc_id").select("id", "mark")
    # the rows as one column, so that no name of theirs clashes
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    this_text = (F.col("doc.doc_id") == F.col("id")) & (F.xxhash64("doc.text") == F.col("mark"))
    return rows.join(gone, this_text, "left_anti").select(*[F.col(f"doc.`{c}`") for c in docs.columns])
