from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from tidemark.llm import url_model as m

SF = "/root/testdata/sf0.001"


def split(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (found[1].lower(), found[2]) if found else ("", "")


def rule_of(url):
    host, path = split(url)
    fitting = [r for r in m.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.name), default=None)


def letters(url):
    rest = re.sub(r"(?s)^.*?://", "", url or "", count=1)
    return re.sub("[0-9]", "0", re.sub(r"[^a-z0-9./-]", "_", rest.lower()))


class Markov:
    def __init__(self, texts, order):
        self.order, self.counts = order, [defaultdict(Counter) for _ in range(order + 1)]
        for text in texts:
            filled = "@" * order + text
            for i in range(order, len(filled)):
                for k in range(order + 1):
                    self.counts[k][filled[i - k : i]][filled[i]] += 1

    def chance(self, context, symbol):
        chance = 1 / 32
        for k in range(self.order + 1):
            seen = self.counts[k].get(context[self.order - k :])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                chance = (seen[symbol] + kinds * chance) / (n + kinds)
        return chance


def score(accepted, rejected, text):
    if not text:
        return 0
    filled, total = "@" * m.ORDER + text, 0
    for i in range(m.ORDER, len(filled)):
        context = filled[i - m.ORDER : i]
        total += round((math.log(accepted.chance(context, filled[i])) - math.log(rejected.chance(context, filled[i]))) * m.UNIT)
    return math.floor(total / len(text))


def test_against_a_plain_model(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    rows = {r.page_id: r for r in m.judge_urls(pages).collect()}
    urls = {r.page_id: r.url for r in pages.collect()}
    ruled = {i: rule_of(u) for i, u in urls.items()}
    held = {i: int(hashlib.md5(u.encode()).hexdigest()[:4], 16) % m.CALIBRATION == 0 for i, u in urls.items()}
    train = [(i, ruled[i].verdict) for i in urls if ruled[i] and not held[i]]
    accepted = Markov([letters(urls[i]) for i, v in train if v == "allow"], m.ORDER)
    rejected = Markov([letters(urls[i]) for i, v in train if v == "block"], m.ORDER)
    for i, row in rows.items():
        assert (row.host, row.path) == split(urls[i])
        assert row.rule == (ruled[i].name if ruled[i] else None)
        assert abs(row.score - score(accepted, rejected, letters(urls[i]))) <= 1
        if ruled[i]:
            assert row.verdict == ruled[i].verdict
    free = [row for row in rows.values() if row.rule is None]
    allowed = [row.score for row in free if row.verdict == "allow"]
    blocked = [row.score for row in free if row.verdict == "block"]
    assert free and max(blocked, default=-1e9) < min(allowed, default=1e9)


def test_edges(spark):
    urls = [
        None, "", "no-scheme.com/en/", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/", "http://com",
        "http://a.net/es/?q=://b.com/", "http://xcom/", "ftp://é.net/fr/ü#f", "http://" + "a" * 50_000 + ".org/",
        "http://a.com/x\ny",
    ]
    docs = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] * 2, "page_id INT, url STRING, rule STRING, code STRING")
    found = m.judge_urls(docs).orderBy("page_id").collect()
    assert len(found) == 2 * len(urls) and all(a == b for a, b in zip(found[::2], found[1::2], strict=True))
    rules = [row.rule for row in found[::2]]
    assert rules == [None, None, None, None, "www.example.com/en/", "example.com/en/", None, "net/es/", None, "net/fr/", None, "com/"]
    assert (found[0].host, found[0].path, found[0].score) == ("", "", 0)
    assert all(row.verdict in ("allow", "block") for row in found)


def test_empty_table(spark):
    assert m.judge_urls(spark.createDataFrame([], "page_id INT, url STRING")).collect() == []
