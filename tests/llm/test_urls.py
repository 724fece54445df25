from __future__ import annotations

import math
import re
from collections import Counter

from samples import rows_of

from ridgeway.llm import urls

RULES = [(h, p, v) for h, p, v in urls.RULES]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def ruled(url):
    host, path = parts(url)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def table(spark, all_urls):
    rows = [(None if i == 1 else i, u, None, 3) for i, u in enumerate(all_urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, run int").repartition(3)


AWKWARD = [
    None, "", "no scheme", "://", "http://COM", "http://com/", "http://a.Example.COM/en/x?q#f", "http://www.example.com/en/",
    "http://x.www.example.com/en/1", "http://notcom/", "http://example.com:80/en/", "ftp://a.net/fr/é", "http://b.net/es",
    "http://b.net?x://c.com/", "x://y://z.com/", "http://c.net#/fr/", "http://d.org/de/\n", "http://d.org/" + "a" * 3000,
]


def test_hosts_paths_and_rules(spark):
    found = urls.url_verdicts(table(spark, AWKWARD))
    want = []
    for i, u in enumerate(AWKWARD):
        rule = ruled(u)
        want.append((None if i == 1 else i, *parts(u), rule and rule[0] + rule[1]))
    assert rows_of(found, "page_id", "host", "path", "rule") == sorted(want, key=repr)
    for row in found.where("rule is not null").collect():
        assert row.verdict == next(v for h, p, v in RULES if h + p == row.rule)
    assert found.where("verdict not in ('allow', 'block')").count() == 0


def test_ratio_is_that_of_the_markov_models(spark):
    given = [f"http://{a}.com/{b}" for a in ("shop", "news", "blog") for b in range(20)]
    given += [f"http://{a}.net/fr/{b}" for a in ("spin", "wins") for b in range(20)]
    asked = ["http://shop.org/3", "http://spin.org/fr/9", "http://é.org", "http://spin.org/fr/9"]
    pages = table(spark, given + asked)
    found = {r.page_id: r for r in urls.url_verdicts(pages).collect()}
    parted = {r.url: r.p for r in pages.selectExpr("url", f"pmod(xxhash64(url), {urls.CALIBRATE}) AS p").collect()}
    counts = {"allow": Counter(), "block": Counter()}
    for u in given:
        if parted[u] > 0:
            text = " " * (urls.ORDER - 1) + u.partition("://")[2]
            for i in range(urls.ORDER, len(text) + 1):
                for n in range(1, urls.ORDER + 1):
                    counts[ruled(u)[2]][text[i - n : i], "gram"] += 1
                    counts[ruled(u)[2]][text[i - n : i - 1], n, "context"] += 1

    def ratio(u):
        text, total, n_chars = " " * (urls.ORDER - 1) + u.partition("://")[2], 0.0, 0
        for i in range(urls.ORDER, len(text) + 1):
            p = {}
            for kind, c in counts.items():
                p[kind] = 1 / urls.LETTERS
                for n in range(1, urls.ORDER + 1):
                    context = c[text[i - n : i - 1], n, "context"]
                    p[kind] = (c[text[i - n : i], "gram"] + urls.WEIGHT * p[kind]) / (context + urls.WEIGHT)
            total, n_chars = total + math.log(p["allow"] / p["block"]), n_chars + 1
        return total / n_chars

    for k, u in enumerate(asked):
        assert abs(found[len(given) + k].log_ratio - ratio(u)) < 1e-9
    assert [found[len(given) + k].verdict for k in (0, 1, 3)] == ["allow", "block", "block"]


def test_nothing_to_learn_from(spark):
    found = urls.url_verdicts(table(spark, ["http://a.org/", None, "http://b.com/"]))
    assert {r.verdict for r in found.collect()} == {"allow"}
    assert urls.url_verdicts(table(spark, [])).count() == 0
