"""Find secrets in texts: wide candidate patterns, then a random forest against false positives.

Candidates are values assigned to a name such as `password`, long unbroken strings of letters
and digits, and private key blocks. The forest judges each by its length, its character
transitions, how much of it dictionary words cover, whether it is part of a path or address, and
the words next to it. It is trained from labelled findings; `labelled_findings` makes some from
words of the corpus, real ones can be given instead.
"""

from __future__ import annotations

import math
import random
import re
import string
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.forest import Tree, fit_forest, predict_forest
from ledgerlens.sources.scratch import Scratch

#: Bound of the dictionary that every task holds, some tens of MB.
DICTIONARY_WORDS = 250_000
#: Levels of document counts for each doubling.
LEVELS = 8
FINDINGS_PER_KIND = 250
#: A candidate is a secret from this share of the forest's votes.
LEAST_SCORE = 0.5
KINDS = ("key_block", "token_format", "assigned", "long_string")
LEAST_RUN = 20
LEAST_VALUE = 6
#: What may join two secrets in one unbroken string.
JOINTS = "/._-+~:|&#"
REDACTED = "[secret]"
CONTEXT = 48

# Names that announce a secret, words that speak against one, public token formats.
SECRET_NAMES = (
    "password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key",
    "access_key", "access-key", "accesskey", "private_key", "auth_key", "credential",
)
HARMLESS_WORDS = (
    "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "commit", "etag", "uuid", "guid",
    "revision", "version", "build", "id", "integrity", "fingerprint",
)
PLACEHOLDERS = ("example", "changeme", "your", "dummy", "sample", "placeholder", "xxx", "redacted", "none", "null", "test")
TOKEN_FORMATS = (
    r"A(?:KIA|SIA)[0-9A-Z]{16}", r"gh[pousr]_[0-9A-Za-z]{36,}", r"xox[abprs]-[0-9A-Za-z-]{10,}",
    r"sk_(?:live|test)_[0-9A-Za-z]{16,}", r"AIza[0-9A-Za-z_-]{35}",
    r"eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]*", r"glpat-[0-9A-Za-z_-]{20,}",
)

KNOWN = re.compile("|".join(f"(?:{p})" for p in TOKEN_FORMATS))
RUN = re.compile(r"[A-Za-z0-9+/_.~-]{%d,}={0,2}" % LEAST_RUN)
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.S)
NAME_BEFORE = re.compile(r"([A-Za-z0-9_.\-]+)[\"']?\s{0,3}\Z")
VALUE_AFTER = re.compile(r"[=>:]?\s{0,3}[\"']?([^\s\"'<>,;]+)")
SEPARATOR = re.compile(r"[=:]")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: str


def candidates(text: str | None) -> list[Candidate]:
    """Possible secrets of the whole text in order.

    Of overlapping ones the more specific kind stays (KINDS), then the first; what the other has
    beside it stays a candidate of its own.
    """
    if not text:
        return []
    found: list[Candidate] = []
    if "-----BEGIN" in text:
        found += [Candidate(m.start(), m.end(), "key_block") for m in KEY_BLOCK.finditer(text)]
    for mark in SEPARATOR.finditer(text):
        name = NAME_BEFORE.search(text[max(0, mark.start() - CONTEXT) : mark.start()])
        if name and any(part in name[1].lower() for part in SECRET_NAMES):
            value = VALUE_AFTER.match(text, mark.end())
            if value and value.end(1) - value.start(1) >= LEAST_VALUE:
                found.append(Candidate(value.start(1), value.end(1), "assigned"))
    if any(len(piece) >= LEAST_RUN for piece in text.split()):
        for run in RUN.finditer(text):
            for known in KNOWN.finditer(run[0]):
                found.append(Candidate(run.start() + known.start(), run.start() + known.end(), "token_format"))
            if _mixed(run[0]):
                found.append(Candidate(run.start(), run.end(), "long_string"))
    kept: list[Candidate] = []
    starts: list[int] = []
    for candidate in sorted(found, key=lambda c: (KINDS.index(c.kind), c.start, -c.end)):
        for part in _beside(text, candidate, kept, starts):
            at = bisect(starts, part.start)
            kept.insert(at, part)
            starts.insert(at, part.start)
    return kept


def _mixed(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def _beside(text: str, candidate: Candidate, kept: list[Candidate], starts: list[int]) -> list[Candidate]:
    """candidate, or its parts outside of kept (in order, not overlapping) that could be secrets."""
    at = max(0, bisect(starts, candidate.start) - 1)
    borders = [candidate.start]
    while at < len(kept) and kept[at].start < candidate.end:
        if kept[at].end > candidate.start:
            borders += [kept[at].start, kept[at].end]
        at += 1
    if len(borders) == 1:
        return [candidate]
    borders.append(candidate.end)
    least = LEAST_VALUE if candidate.kind == "assigned" else LEAST_RUN
    parts = []
    for start, end in zip(borders[::2], borders[1::2]):
        while start < end and text[start] in JOINTS:
            start += 1
        while end > start and text[end - 1] in JOINTS:
            end -= 1
        if end - start >= least and _mixed(text[start:end]):
            parts.append(Candidate(start, end, candidate.kind))
    return parts


def _kind(char: str) -> int:
    if char.isdigit():
        return 0
    if char.islower():
        return 1
    return 2 if char.isupper() else 3


def _coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of the letters that the longest dictionary words from the left cover."""
    letters = covered = 0
    for part in WORD.findall(value.lower()):
        letters += len(part)
        at = 0
        while at < len(part):
            for length in range(min(14, len(part) - at), 3, -1):
                if part[at : at + length] in dictionary:
                    covered += length
                    at += length
                    break
            else:
                at += 1
    return covered / letters if letters else 0.0


def features(text: str, candidate: Candidate, dictionary: frozenset[str]) -> list[float]:
    value = text[candidate.start : candidate.end]
    n = len(value)
    kinds = [_kind(c) for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    counts = Counter(value)
    entropy = -sum(c / n * np.log2(c / n) for c in counts.values())
    pairs = Counter(zip(value, value[1:]))
    before = text[max(0, candidate.start - CONTEXT) : candidate.start].lower()
    after = text[candidate.end : candidate.end + CONTEXT].lower()
    near = re.findall(r"[a-z0-9_-]+", before)[-3:]
    lower = value.lower()
    return [
        n,
        changes / max(1, n - 1),
        entropy,
        len(pairs) / max(1, n - 1),
        kinds.count(0) / n,
        kinds.count(1) / n,
        kinds.count(2) / n,
        kinds.count(3) / n,
        float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None),
        float(re.fullmatch(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", value) is not None),
        _coverage(value, dictionary),
        value.count("/") + value.count("."),
        float(before.endswith(("/", "\\", "@", ".")) or "://" in before[-24:]),
        float(after.startswith(("/", "@", "(", "."))),
        float(any(part in word for word in near for part in SECRET_NAMES)),
        float(any(word in HARMLESS_WORDS for word in near)),
        float(any(word in lower for word in PLACEHOLDERS)),
        float(candidate.kind == "assigned"),
        float(candidate.kind == "token_format"),
        float(candidate.kind == "key_block"),
    ]


def labelled_findings(words: list[str]) -> list[tuple[str, Candidate, bool]]:
    """Findings (text, candidate, is a secret), FINDINGS_PER_KIND of each kind, always the same."""
    rng = random.Random(11)
    words = sorted(words) or ["word", "text", "name", "value"]
    hexadecimal, alphanumeric = "0123456789abcdef", string.ascii_letters + string.digits

    def some(alphabet: str, least: int, most: int) -> str:
        return "".join(rng.choices(alphabet, k=rng.randint(least, most)))

    def prose(n: int) -> str:
        return " ".join(rng.choices(words, k=n))

    def name() -> str:
        return rng.choice(("", "db_", "my_", "aws_", "client_", "user.")) + rng.choice(SECRET_NAMES)

    def assigned(value: str, key: str) -> str:
        key = rng.choice((key, key.upper(), key.title()))
        return rng.choice(('%s = "%s"', "%s=%s", "%s: %s", "%s='%s'", '"%s": "%s"')) % (key, value)

    def random_value() -> str:
        value = rng.choice(
            (some(hexadecimal, 16, 64), some(alphanumeric, 12, 48), some(alphanumeric + "+/", 20, 64))
        )
        return value.upper() if rng.random() < 0.2 else value

    def identifier() -> str:
        return rng.choice(("_", "-", "")).join(rng.choices(words, k=3)) + str(rng.randint(1, 99))

    kinds = [
        (True, lambda: assigned(random_value(), name())),
        (True, lambda: assigned(some(alphanumeric + "!@#$%^&*", 10, 20), name())),
        (True, lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16, 16)),
        (True, lambda: rng.choice(("ghp_", "gho_")) + some(alphanumeric, 36, 36)),
        (True, lambda: "sk_live_" + some(alphanumeric, 24, 24)),
        (True, lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + some(alphanumeric, 64, 640) + "\n-----END RSA PRIVATE KEY-----"),
        (False, lambda: rng.choice(HARMLESS_WORDS) + rng.choice((" ", ": ", "=")) + some(hexadecimal, 32, 64)),
        (False, lambda: some(hexadecimal, 32, 40)),
        (False, lambda: "-".join(some(hexadecimal, k, k) for k in (8, 4, 4, 4, 12))),
        (False, lambda: "/" + "/".join(rng.choices(words, k=4)) + str(rng.randint(1, 9)) + ".txt"),
        (False, lambda: "https://" + rng.choice(words) + ".org/" + "/".join(rng.choices(words, k=3)) + some(hexadecimal, 8, 24)),
        (False, identifier),
        (False, lambda: assigned(rng.choice(words) + rng.choice(words), name())),
        (False, lambda: assigned(rng.choice(PLACEHOLDERS) + rng.choice(("", "_", "-")) + rng.choice([*words, "", "me", "123"]), name())),
        (False, lambda: assigned(identifier(), name())),
        (False, lambda: prose(2) + rng.choice((" password: ", " token = ", " secret: ")) + prose(3)),
    ]
    result = []
    for secret, make in kinds:
        made = tries = 0
        while made < FINDINGS_PER_KIND and tries < 20 * FINDINGS_PER_KIND:
            tries += 1
            head = prose(rng.randint(1, 6)) + " "
            text = head + make() + rng.choice((" ", "\n", ". ")) + prose(rng.randint(0, 5))
            found = [c for c in candidates(text) if c.end > len(head)]
            if found:
                result.append((text, found[0], secret))
                made += 1
    return result


@dataclass(frozen=True)
class SecretModel:
    trees: list[Tree]
    dictionary: frozenset[str]

    def secrets(self, text: str | None) -> tuple[int, list[tuple[Candidate, float]]]:
        """Number of candidates, and those the forest confirms with their score."""
        found = candidates(text)
        if not found:
            return 0, []
        x = np.array([features(text, c, self.dictionary) for c in found])
        scores = predict_forest(self.trees, x)
        return len(found), [(c, float(s)) for c, s in zip(found, scores) if s >= LEAST_SCORE]


def corpus_words(docs: DataFrame) -> list[str]:
    """Words of 4 to 14 letters that stand in least_documents texts or more, counted over all texts.

    At most DICTIONARY_WORDS: if there are more, the least number of texts is raised until they fit.
    """
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("text").alias("_text"))
    words = F.explode(
        F.array_distinct(F.regexp_extract_all(F.lower("_text"), F.lit(r"(\p{L}{4,14})"), 1))
    ).alias("word")
    scratch = Scratch(docs.sparkSession, "words")
    counts = scratch.table(texts.select(words).groupBy("word").count(), "counts")
    level = F.floor(F.log2("count") * LEVELS).cast("int").alias("level")
    # one row per level, some hundreds at any size
    levels = counts.groupBy(level).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).collect()
    least = least_documents(texts.count(), [(row["least"], row["n"]) for row in levels])
    return [row["word"] for row in counts.filter(F.col("count") >= least).select("word").collect()]


def least_documents(documents: int, levels: list[tuple[int, int]]) -> int:
    """Texts that must hold a word, from (fewest texts, words) of each level of counts.

    It grows with the square root of the corpus, so that pieces of secrets stay out, and further
    if more than DICTIONARY_WORDS words would be left.
    """
    least = max(1, math.ceil(math.sqrt(documents) / 10))
    words = 0
    for fewest, n in sorted(levels, reverse=True):
        words += n
        if words > DICTIONARY_WORDS:
            # this level does not fit: the words of the levels above it, and no other
            above = [f for f, _ in levels if f > fewest]
            return max(least, min(above) if above else fewest + 1)
        if fewest <= least:
            break
    return least


def train(words: list[str], findings: list[tuple[str, Candidate, bool]] | None = None) -> SecretModel:
    """Forest from labelled findings; those of labelled_findings unless others are given."""
    dictionary = frozenset(words)
    labelled = findings if findings is not None else labelled_findings(words)
    x = np.array([features(text, candidate, dictionary) for text, candidate, _ in labelled])
    y = np.array([secret for _, _, secret in labelled])
    return SecretModel(fit_forest(x, y), dictionary)


Findings = list[tuple[str, Candidate, bool]]


def finding(text: str, value: str, secret: bool) -> tuple[str, Candidate, bool]:
    """A labelled finding for training: the candidate of a text that holds a value."""
    at = text.index(value)
    for candidate in candidates(text):
        if candidate.start < at + len(value) and at < candidate.end:
            return text, candidate, secret
    raise ValueError("no candidate holds the value")


def scan(docs: DataFrame, labelled: Findings | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_candidates, n_secrets and findings in order.

    labelled are findings (see finding) to train from instead of labelled_findings.

    A finding has start and end (code points of the whole text), kind and score. Null and empty
    texts have no findings; repeated rows are scanned each; an empty table gives no rows; other
    columns are not looked at. Starts jobs when called, to gather the dictionary.
    """
    model = train(corpus_words(docs), labelled)
    schema = (
        "n_candidates int, n_secrets int,"
        "findings array<struct<start:int,end:int,kind:string,score:double>>"
    )

    @F.pandas_udf(schema)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                n, found = model.secrets(text)
                rows.append(
                    (n, len(found), [{"start": c.start, "end": c.end, "kind": c.kind, "score": s} for c, s in found])
                )
            yield pd.DataFrame(rows, columns=["n_candidates", "n_secrets", "findings"])

    return docs.select("doc_id", scanned("text").alias("s")).select("doc_id", "s.*")


def redacted_documents(docs: DataFrame, labelled: Findings | None = None) -> DataFrame:
    """docs with every secret in text replaced by REDACTED, and n_chars counted anew.

    Null and empty texts stay as they are; repeated rows are redacted alike; an empty table stays
    empty; other columns are kept, whatever their names. labelled as in scan.
    """
    model = train(corpus_words(docs), labelled)

    @F.pandas_udf("string")
    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = []
            for text in batch:
                _, found = model.secrets(text)
                if found:
                    parts, at = [], 0
                    for candidate, _ in found:
                        parts += [text[at : candidate.start], REDACTED]
                        at = candidate.end
                    text = "".join(parts) + text[at:]
                texts.append(text)
            yield pd.Series(texts, dtype=object)

    columns = {"text": redacted("text")}
    result = docs.withColumns(columns)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast("bigint"))
    return result
