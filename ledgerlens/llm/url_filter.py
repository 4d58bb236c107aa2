"""Filter URLs by rules and by a ratio of character language models.

Two variable-order Markov models over the bytes of host and path, one of accepted and one of
rejected URLs, are smoothed by Witten-Bell interpolation from order ORDER down to a uniform
byte. A URL's score is its log-likelihood as a rejected URL minus that as an accepted one, per
byte. The threshold is calibrated on the part of the labelled URLs the models have not seen.

Every labelled URL counts. The counts of byte strings (grams) are a table, and a byte's chance
depends on the ORDER bytes before it only, so chances are found once for every distinct window of
ORDER + 1 bytes, order by order, and joined back to the places of the URLs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.heavy_join import attach
from ledgerlens.operators.prefix_scan import prefix_scan
from ledgerlens.sources.scratch import Scratch

ORDER = 5
#: Of the labelled URLs so many of 4 fit the models; the rest calibrates.
FIT_QUARTERS = 3
START = b"\x00" * ORDER
CLASSES = ("accepted", "rejected")

# Host words that mark a URL as an example of a rejected one.
SEED_WORDS = (
    "ad", "ads", "adult", "bet", "bets", "betting", "casino", "gambling", "pills", "poker",
    "porn", "sex", "spam", "viagra", "warez", "xxx",
)


@dataclass(frozen=True)
class Rule:
    """`allow` or `block` for a host with its subdomains and all paths that start with path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Text after the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    Of rules of one length the one with the longer host wins, then the first in code point
    order. The rules are a parameter and become one expression.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text, r.verdict))[::-1]:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


class MarkovModel:
    """Byte n-gram counts up to ORDER + 1, smoothed by Witten-Bell."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.kinds: dict[bytes, int] = {}
        self.total: dict[bytes, int] = {}

    def add(self, text: bytes) -> None:
        padded = START + text
        for at in range(ORDER, len(padded)):
            for order in range(ORDER + 1):
                gram = padded[at - order : at + 1]
                context = gram[:-1]
                count = self.seen.get(gram, 0)
                self.seen[gram] = count + 1
                self.total[context] = self.total.get(context, 0) + 1
                if not count:
                    self.kinds[context] = self.kinds.get(context, 0) + 1

    @classmethod
    def of(cls, counts: list[tuple[int, int]]) -> MarkovModel:
        """Model from gram numbers and how often each gram stands in the texts."""
        model = cls()
        for number, seen in counts:
            if seen:
                gram = number.to_bytes(ORDER + 2)[-((number.bit_length() - 1) // 8) :]
                context = gram[:-1]
                model.seen[gram] = seen
                model.total[context] = model.total.get(context, 0) + seen
                model.kinds[context] = model.kinds.get(context, 0) + 1
        return model

    def log_likelihood(self, text: bytes) -> float:
        padded = START + text
        result = 0.0
        for at in range(ORDER, len(padded)):
            chance = 1 / 256
            for order in range(ORDER + 1):
                context = padded[at - order : at]
                total = self.total.get(context)
                if total is None:
                    break
                kinds = self.kinds[context]
                seen = self.seen.get(padded[at - order : at + 1], 0)
                chance = (seen + kinds * chance) / (total + kinds)
            result += log(chance)
        return result


@F.pandas_udf(T.ArrayType(T.LongType()))
def windows_of(addresses: pd.Series) -> pd.Series:
    """The last ORDER + 1 bytes up to every byte of an address, as gram numbers."""

    def windows(address: str) -> np.ndarray:
        padded = START + address.encode("utf-8", "surrogatepass")
        codes = np.frombuffer(padded, dtype=np.uint8).astype(np.int64)
        size = len(codes) - ORDER
        found = np.full(size, 1, dtype=np.int64)
        for at in range(ORDER + 1):
            found = (found << 8) | codes[at : at + size]
        return found

    return addresses.map(windows)


def _suffix(gram: Column, size: int) -> Column:
    """The last bytes of a gram. Grams are numbers: a one, then the bytes, so no two are equal."""
    return gram.bitwiseAND(F.lit((1 << 8 * size) - 1)).bitwiseOR(F.lit(1 << 8 * size))


def _grams(window: Column) -> Column:
    """The grams of all orders that end where a window ends."""
    return F.explode(F.array(*[_suffix(window, size) for size in range(1, ORDER + 2)]))


def _counted(grams: DataFrame) -> DataFrame:
    return grams.groupBy("gram").agg(*[F.sum(name).alias(name) for name in CLASSES])


def _ratios(counts: DataFrame, windows: DataFrame, scratch: Scratch) -> DataFrame:
    """_window and ratio: log-likelihood of its last byte as rejected minus that as accepted.

    A gram has at most 256 longer ones and a context 256 bytes after it, so no key is heavy.
    """
    none = [F.lit(0).cast("bigint").alias(name) for name in CLASSES]
    wanted = windows.select(_grams(F.col("window")).alias("gram"), *none)
    context = Window.partitionBy(F.shiftright("gram", 8))
    grams = scratch.table(
        _counted(counts.unionByName(wanted)).select(
            "*",
            *[F.sum(name).over(context).alias(f"{name}_total") for name in CLASSES],
            *[F.sum((F.col(name) > 0).cast("bigint")).over(context).alias(f"{name}_kinds") for name in CLASSES],
        ),
        "grams",
    )

    def chance(name: str, shorter: Column) -> Column:
        total, kinds = F.col(f"{name}_total"), F.col(f"{name}_kinds")
        seen = (F.col(name) + kinds * shorter) / (total + kinds)
        return F.when(total == 0, shorter).otherwise(seen).alias(f"{name}_chance")

    chances = None
    for size in range(1, ORDER + 2):
        first = 1 << 8 * size
        longer = grams.filter(F.col("gram").between(first, 2 * first - 1))
        if chances is None:
            chances = longer.select("gram", *[chance(name, F.lit(1 / 256)) for name in CLASSES])
            continue
        shorter = chances.withColumnsRenamed({c: f"shorter_{c}" for c in chances.columns})
        chances = longer.join(
            shorter, _suffix(F.col("gram"), size - 1) == F.col("shorter_gram")
        ).select("gram", *[chance(name, F.col(f"shorter_{name}_chance")) for name in CLASSES])
    return chances.select(
        F.col("gram").alias("_window"),
        (F.log("rejected_chance") - F.log("accepted_chance")).alias("ratio"),
    )


def _scored(counts: DataFrame, addresses: DataFrame, scratch: Scratch) -> DataFrame:
    """addresses, which differ and are not empty, with their score."""
    listed = scratch.table(addresses.withColumn("_id", F.monotonically_increasing_id()), "addresses")
    places = scratch.table(
        listed.select("_id", F.posexplode(windows_of(F.col("address"))).alias("at", "window")), "places"
    )
    windows = scratch.table(places.groupBy("window").agg(F.count(F.lit(1)).alias("n")), "windows")
    ratios = _ratios(counts, windows, scratch)
    weighed = windows.join(ratios, F.col("window") == F.col("_window")).select("_window", "ratio", "n")
    valued = attach(places, scratch.table(weighed, "ratios"), {"window": "_window"}, "n")
    # added in the order of the bytes, so that reruns agree
    parts = F.array_sort(F.collect_list(F.struct("at", "ratio")))
    whole = F.aggregate("parts", F.lit(0.0), lambda so_far, part: so_far + part["ratio"])
    sums = valued.groupBy("_id").agg(parts.alias("parts"))
    return listed.join(sums.select("_id", (whole / F.size("parts")).alias("score")), "_id").drop("_id")


@dataclass(frozen=True)
class UrlModel:
    """counts: how often every gram stands in accepted and in rejected URLs."""

    counts: DataFrame
    threshold: float

    def scored(self, addresses: DataFrame) -> DataFrame:
        """Rows of addresses, which must differ and not be empty, with their score."""
        return _scored(self.counts, addresses, Scratch(addresses.sparkSession, "url-scores"))

    def score(self, address: str) -> float:
        """Log-likelihood difference per byte of one address; 0 for an empty one. Starts a job."""
        text = address.encode("utf-8", "surrogatepass")
        if not text:
            return 0.0
        padded = START + text
        contexts = {
            1 << 8 * order | int.from_bytes(padded[at - order : at])
            for at in range(ORDER, len(padded))
            for order in range(ORDER + 1)
        }
        known = self.counts.filter(F.shiftright("gram", 8).isin(list(contexts))).collect()
        accepted, rejected = (MarkovModel.of([(row["gram"], row[name]) for row in known]) for name in CLASSES)
        return (rejected.log_likelihood(text) - accepted.log_likelihood(text)) / len(text)


def _calibrated(held: DataFrame, scratch: Scratch) -> float:
    """The threshold with the least mean of both error rates, in the middle of its interval.

    held: rows (score, rejected). Of equally good intervals the widest counts, then the lowest.
    """
    points = scratch.table(
        held.groupBy("score").agg(
            F.count_if(~F.col("rejected")).alias("accepted"), F.count_if("rejected").alias("rejected")
        ),
        "points",
    )
    accepted, rejected = points.agg(F.sum("accepted"), F.sum("rejected")).first()
    if not accepted or not rejected:
        return 0.0
    ranked = scratch.table(prefix_scan(points, [F.col("score")], list(CLASSES), scratch), "ranked")
    following = ranked.select((F.col("row_rank") - 1).alias("row_rank"), F.col("score").alias("following"))
    cost = F.col("rejected_upto") / rejected + (accepted - F.col("accepted_upto")) / accepted
    best = (
        ranked.join(following, "row_rank", "left")
        .withColumn("following", F.coalesce("following", F.col("score") + 1e-9))
        .agg(
            F.min("score").alias("least"),
            F.min(F.struct(cost.alias("cost"), F.col("score") - F.col("following"), "score", "following")).alias("cut"),
        )
        .first()
    )
    if best["cut"]["cost"] > 1.0:
        return best["least"] - 1e-9
    return (best["cut"]["score"] + best["cut"]["following"]) / 2


def fit(labelled: DataFrame) -> UrlModel | None:
    """Model from rows (address, rejected boolean), or None where one class has no rows.

    All distinct addresses of each class are used. Starts jobs when called.
    """
    scratch = Scratch(labelled.sparkSession, "url-model")
    quarter = F.pmod(F.xxhash64(F.lit("quarter"), "address"), F.lit(4))
    known = scratch.table(
        labelled.filter("address != '' AND rejected IS NOT NULL")
        .select("address", "rejected", (quarter < FIT_QUARTERS).alias("fits"))
        .distinct(),
        "labelled",
    )
    # whether any address of a class fits
    classes = {row[0]: row[1] for row in known.groupBy("rejected").agg(F.bool_or("fits")).collect()}
    if len(classes) < 2:
        return None
    unfit = [rejected for rejected, some in classes.items() if not some]
    fitting = known.filter(reduce(lambda a, b: a | b, [F.col("rejected") == r for r in unfit], F.col("fits")))
    windows = fitting.select("rejected", F.explode(windows_of(F.col("address"))).alias("window"))
    grouped = windows.groupBy("window").agg(
        F.count_if(~F.col("rejected")).alias("accepted"), F.count_if("rejected").alias("rejected")
    )
    counts = scratch.table(
        _counted(grouped.select(_grams(F.col("window")).alias("gram"), *CLASSES)), "counts"
    )
    # an address that stands in both classes is scored once
    held = known.filter("NOT fits").groupBy("address").agg(F.collect_list("rejected").alias("rejected"))
    scores = _scored(counts, held, scratch).select("score", F.explode("rejected").alias("rejected"))
    return UrlModel(counts, _calibrated(scores, scratch))


def seed_rejected(host: Column) -> Column:
    """Whether one of the host's words is a seed word."""
    return F.arrays_overlap(
        F.split(host, r"[^a-z0-9]+"), F.array(*[F.lit(word) for word in SEED_WORDS])
    )


def judge(pages: DataFrame, rules: tuple[Rule, ...], labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of pages (page_id, url).

    The verdict is that of the longest rule that fits, else `block` if the score is above the
    calibrated threshold. labelled (address, rejected) defaults to the pages' own hosts and
    paths: those with a seed word in the host as rejected, the others that no rule blocks as
    accepted. Without examples of both classes, and for a null URL or one without ://, the
    method allows. Repeated rows are judged each; an empty table gives no rows. Starts jobs
    when called.
    """
    parsed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("_found", matching_rule(F.col("host"), F.col("path"), rules))
    address = F.concat("host", "path")
    if labelled is None:
        seeded = seed_rejected(F.col("host"))
        blocked = F.coalesce(F.col("_found.verdict") == "block", F.lit(False))
        labelled = parsed.filter(seeded | ~blocked).select(
            address.alias("address"), seeded.alias("rejected")
        )
    model = fit(labelled)
    if model is None:
        scored = parsed.withColumn("score", F.lit(0.0))
        by_method = F.lit("allow")
    else:
        addressed = parsed.withColumn("address", address)
        asked = addressed.filter("address != ''").groupBy("address").agg(F.count(F.lit(1)).alias("n"))
        scores = Scratch(pages.sparkSession, "url-scored").table(model.scored(asked), "scores")
        found = scores.withColumnRenamed("address", "_address")
        scored = attach(addressed, found, {"address": "_address"}, "n", how="left").withColumn(
            "score", F.coalesce("score", F.lit(0.0))
        )
        by_method = F.when(
            (F.col("address") != "") & (F.col("score") > model.threshold), "block"
        ).otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("_found.rule").alias("rule"),
        F.coalesce(F.col("_found.verdict"), by_method).alias("verdict"),
        "score",
    )
