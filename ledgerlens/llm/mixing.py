"""Mix sources to target weights by entropy balancing.

Every source s gets a target of words T(s). The rates r of its documents are those closest to
"half of the two allowed copies" in relative entropy that meet the constraint
sum(r * size) = T(s) with 0 <= r <= 2. The convex dual has one unknown per source, the tilt t:

    r = 2 / (1 + exp(-t * size / mean size of the source))

Newton steps on all duals at once run as one aggregation over the (source, size) histogram
each, safeguarded by bisection. Rates become whole copies by systematic rounding: documents
are put into small blocks by hash, and within a block, in order of size, the running sum of
rates is rounded. Of a fixed set of rounding offsets each source takes the one whose words come
nearest to its target.

Only DataFrame functions are used. Nothing is collected but one residual per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_COPIES = 2
ROWS_PER_BLOCK = 512
OFFSETS = 32
STEPS = 80
TOLERANCE = 1e-8
TILT_LIMIT = 1e9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds weight and target to rows (source, source_size), one per source.

    Sources in code point order, null last, get the WEIGHTS in turn. They share BUDGET times all
    words by weight; no target exceeds MOST_COPIES times its source's size, and what is above is
    shared again by weight. In order of limit per weight that is one level: a source is full
    if the words left, shared by the weights left, reach its limit.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]),
        (F.pmod(F.row_number().over(every) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"),
    )
    limit = (F.lit(float(MOST_COPIES)) * F.col("source_size")).alias("limit")
    by_need = Window.orderBy("need", F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = (
        sources.withColumn("weight", place)
        .select("*", limit)
        .withColumn("need", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.lit(BUDGET) * F.sum("source_size").over(whole))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn(
            "weights_left",
            F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        )
        .withColumn("level", F.col("left") / F.col("weights_left"))
    )
    # levels fall from the first source that is not full on, so the largest of these is its own
    open_level = F.max(F.when(F.col("need") > F.col("level"), F.col("level"))).over(whole)
    level = F.coalesce(open_level, F.lit(float("inf")))
    return rows.withColumn(
        "target", F.least(F.col("limit"), level * F.col("weight"))
    ).select("source", "source_size", "n_docs", "weight", "target")


def _rate(tilt: Column, scaled: Column) -> Column:
    return F.lit(float(MOST_COPIES)) / (F.lit(1.0) + F.exp(-tilt * scaled))


def _exact_sum(values: Column) -> Column:
    """A sum that does not depend on the order of rows, so that reruns round alike."""
    return F.sum(values.cast("decimal(38,10)")).cast("double")


def solve_tilts(histogram: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds the tilt whose rates meet each source's target.

    histogram: source, size, n. A source whose target is its limit gets the rate
    MOST_COPIES by an infinite tilt; a source without words gets tilt 0.
    """
    full = F.col("target") >= F.lit(float(MOST_COPIES)) * F.col("source_size")
    state = targets.withColumn("mean", F.col("source_size") / F.col("n_docs")).select(
        "*",
        F.when(F.col("source_size") == 0, 0.0).when(full, float("inf")).otherwise(0.0).alias("tilt"),
        F.lit(-TILT_LIMIT).alias("low"),
        F.lit(TILT_LIMIT).alias("high"),
        ((F.col("source_size") == 0) | full).alias("done"),
    )
    state = scratch.table(state, "tilts")
    cells = histogram.filter(F.col("size") > 0)
    for _ in range(STEPS):
        if state.filter(~F.col("done")).isEmpty():
            break
        scaled = F.try_divide(F.col("size"), F.col("mean"))
        rate = _rate(F.col("tilt"), scaled)
        slope = rate * (F.lit(1.0) - rate / F.lit(float(MOST_COPIES))) * scaled
        words = F.col("n") * F.col("size")
        sums = (
            cells.alias("c")
            .join(state.filter(~F.col("done")).alias("s"), F.expr("c.source <=> s.source"))
            .groupBy(F.col("c.source").alias("key"))
            .agg(_exact_sum(words * rate).alias("value"), _exact_sum(words * slope).alias("slope"))
        )
        error = F.col("value") - F.col("target")
        low = F.when(error < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(error > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.try_divide(error, F.col("slope"))
        moved = state.join(sums, F.expr("source <=> key"), "left").select(
            "source", "source_size", "n_docs", "weight", "target", "mean", "tilt",
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            (F.col("done") | (F.abs(error) <= TOLERANCE * F.col("source_size"))).alias("done"),
            step.alias("step"),
        )
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        moved = moved.withColumn(
            "tilt",
            F.when(F.col("done"), F.col("tilt"))
            .when(inside, F.col("step"))
            .otherwise((F.col("low") + F.col("high")) / 2),
        ).drop("step")
        state = scratch.table(moved, "tilts")
    return state.select("source", "source_size", "n_docs", "target", "mean", "tilt")


def _placed(sized: DataFrame, tilts: DataFrame) -> DataFrame:
    """Adds rate, the block's hashed start, and the running rate within the block."""
    plan = tilts.withColumnRenamed("source", "_source")
    blocks = F.ceil(F.col("n_docs") / ROWS_PER_BLOCK)
    rows = (
        sized.join(plan, F.expr("_source <=> _key"))
        .withColumn("_block", F.pmod(F.col("_mark"), blocks))
        .withColumn(
            "rate",
            F.when(F.col("_size") == 0, F.lit(0.0)).otherwise(
                _rate(F.col("tilt"), F.try_divide(F.col("_size"), F.col("mean")))
            ),
        )
    )
    order = (
        Window.partitionBy("_key", "_block")
        .orderBy("_size", "_mark", "_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start = F.pmod(F.xxhash64(F.col("_key"), F.col("_block")), F.lit(1 << 20)) / float(1 << 20)
    return rows.withColumn("_sum", F.sum("rate").over(order) + start)


def _copies(offset: Column) -> Column:
    after, before = F.col("_sum") + offset, F.col("_sum") - F.col("rate") + offset
    return F.least(
        F.greatest(F.floor(after) - F.floor(before), F.lit(0)), F.lit(MOST_COPIES)
    ).cast("bigint")


def mix(docs: DataFrame, payload: bool = False) -> DataFrame:
    """How often each document goes into the mix.

    docs: doc_id, text, source and any others. Returns one row per document: doc_id, source,
    size, source_size, target, rate, copies and taken = copies * size; with payload all columns
    of docs stand first in the struct `doc`. Starts jobs when called.

    A null text has size 0 and gets no copy, like an empty one; a null source is a source of its
    own; a null doc_id is a document like any other; repeated rows each count; an empty table
    gives no rows. Documents of equal size are told apart by a hash of id and text, so reruns
    agree.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    base = docs.select(
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_key"),
        word_count(F.col("text")).alias("_size"),
        F.xxhash64("doc_id", "text").alias("_mark"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if payload else []),
    )
    sized = scratch.table(base.drop("doc"), "sizes")
    histogram = scratch.table(
        sized.groupBy(F.col("_key").alias("source"), F.col("_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("n")),
        "histogram",
    )
    sources = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")
    )
    targets = scratch.table(source_targets(sources), "targets")
    tilts = solve_tilts(histogram, targets, scratch)

    offsets = [F.lit(j / OFFSETS) for j in range(OFFSETS)]
    placed = _placed(sized, tilts)
    sums = placed.groupBy("_source", "target").agg(
        *[F.sum(_copies(offset) * F.col("_size")).alias(f"w{j}") for j, offset in enumerate(offsets)]
    )
    miss = F.array(
        *[
            F.struct(F.abs(F.col(f"w{j}") - F.col("target")), offset.alias("offset"))
            for j, offset in enumerate(offsets)
        ]
    )
    chosen = sums.select(
        F.col("_source").alias("_chosen"), F.array_min(miss)["offset"].alias("_offset")
    )
    chosen = scratch.table(tilts.join(chosen, F.expr("source <=> _chosen")).drop("_chosen"), "plan")
    result = _placed(base if payload else sized, chosen).withColumn("copies", _copies(F.col("_offset")))
    return result.select(
        *(["doc"] if payload else []),
        F.col("_id").alias("doc_id"),
        F.col("_key").alias("source"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("_size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of docs as often as its copies say, same columns.

    Texts without words (null and empty ones too) have no size and are not taken. A null source
    is a source; repeated rows are taken each; an empty table stays empty; columns are kept
    whatever their names.
    """
    rows = mix(docs, payload=True).filter(F.col("copies") > 0)
    return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_n")).select(
        *[F.col(f"doc.`{c}`") for c in docs.columns]
    )
