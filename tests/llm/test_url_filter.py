import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import url_filter
from ledgerlens.llm.queries import URL_RULES
from ledgerlens.llm.url_filter import MarkovModel

SCHEMA = "page_id long, url string, host string, html string"


def parts(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not match:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in match[1]), match[2]


def rule_of(host, path):
    fits = [
        r for r in URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "example.org/en/1", "http://Example.ORG/en/12", "https://a.example.org/es/x?y=/z", "http://org", "http://x.org/",
    "http://notorg/", "http://a.b.com/fr/1#t", "http://com/de/9", "https://net/de/?q", "x://y://z/p", "http://ÄB.org/é", "://h/p",
    "http://casino-win.example.net/en/1", "http://example.org?x", "http://e.com/\nfr/",
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, url, "h", "x") for i, url in enumerate(URLS)] + [(None, URLS[3], "h", "x")] * 2
    found = url_filter.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    assert len(found) == len(rows)
    for row in found:
        url = URLS[row["page_id"]] if row["page_id"] is not None else URLS[3]
        host, path = parts(url)
        assert (row["host"], row["path"]) == (host, path)
        rule = rule_of(host, path)
        assert row["rule"] == (rule.text if rule else None)
        if rule:
            assert row["verdict"] == rule.verdict
        assert row["verdict"] in ("allow", "block")
    assert url_filter.judge(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []


def test_method_tells_seed_hosts_from_others(spark, sf_dir):
    pages = spark.read.parquet(sf_dir.replace("sf0.01", "sf0.1") + "/pages.parquet")
    rows = [r for r in url_filter.judge(pages, URL_RULES).collect() if r["rule"] is None]
    seeded = [bool(set(re.split(r"[^a-z0-9]+", r["host"])) & set(url_filter.SEED_WORDS)) for r in rows]
    blocked = [r["verdict"] == "block" for r in rows]
    assert sum(s and b for s, b in zip(seeded, blocked)) > 0.95 * sum(seeded) > 0
    assert sum(b and not s for s, b in zip(seeded, blocked)) < 0.01 * len(rows)


def test_held_out_urls(spark):
    data = [(f"good{i % 7}.org/read/{i}", False) for i in range(200)]
    data += [(f"bad{i % 5}.biz/win-cash/{i}", True) for i in range(200)]
    model = url_filter.fit(spark.createDataFrame(data[:150] + data[200:350], "address string, rejected boolean"))
    right = sum((model.score(a) > model.threshold) == r for a, r in data[150:200] + data[350:])
    assert right >= 98


def test_every_labelled_url_counts(spark):
    good = [f"read{i % 97}.org/{i * 7919 % 100003}" for i in range(7000)]
    bad = [f"spam{i % 89}.biz/{i * 104729 % 100003}" for i in range(6000)]
    rows = [(a, False) for a in good] + [(a, True) for a in bad] + [(None, True), ("", False), ("x.org", None)]
    labelled = spark.createDataFrame(rows + rows[:50], "address string, rejected boolean")
    model = url_filter.fit(labelled)
    known = labelled.filter("address != '' AND rejected IS NOT NULL").distinct()
    quarter = F.pmod(F.xxhash64(F.lit("quarter"), "address"), F.lit(4))
    fitted, held = {False: MarkovModel(), True: MarkovModel()}, []
    for address, rejected, at in known.select("address", "rejected", quarter).collect():
        if at < url_filter.FIT_QUARTERS:
            fitted[rejected].add(address.encode())
        else:
            held.append((address, rejected))

    def expected(address):
        text = address.encode()
        return (fitted[True].log_likelihood(text) - fitted[False].log_likelihood(text)) / len(text)

    starts = {row["gram"]: row for row in model.counts.filter(f"gram < {1 << 16}").collect()}
    assert sum(row["accepted"] for row in starts.values()) == fitted[False].total[b""]
    assert sum(row["rejected"] for row in starts.values()) == fitted[True].total[b""]
    asked = [good[5], bad[7], "never.seen/ßé", "x"]
    scores = model.scored(spark.createDataFrame([(a,) for a in asked], "address string"))
    for row in scores.collect():
        assert row["score"] == pytest.approx(expected(row["address"]), rel=1e-9)
        assert model.score(row["address"]) == pytest.approx(row["score"], rel=1e-9)

    def errors(threshold):
        wrong = {False: 0, True: 0}
        for score, rejected in points:
            wrong[rejected] += (score > threshold) != rejected
        return sum(wrong[r] / sum(x == r for _, x in held) for r in wrong)

    points = [(expected(a), r) for a, r in held]
    assert errors(model.threshold) <= min(errors(score) for score, _ in sorted(points)[::20]) + 1e-9


def test_model_is_a_distribution():
    model = MarkovModel()
    for text in (b"abcabc", b"abd"):
        model.add(text)
    from math import exp
    assert sum(exp(model.log_likelihood(b"ab" + bytes([c]))) for c in range(256)) == pytest.approx(exp(model.log_likelihood(b"ab")))


def test_one_class_only_allows(spark):
    rows = [(1, "http://casino.net/", "h", "x")]
    assert url_filter.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).first()["verdict"] == "allow"
