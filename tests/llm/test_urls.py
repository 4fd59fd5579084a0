"""URL rules against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from simplexa.llm import urls
from simplexa.llm.bits import Filter

SCHEMA = "page_id long, url string, host string, key string, keys string, verdict string"


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(ends, default=len(rest))]
    path = rest[len(host) :]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def checked(spark, addresses, rules, **settings):
    pages = spark.createDataFrame([(i, u, "x", "y", "z", "w") for i, u in enumerate(addresses)], SCHEMA).repartition(3)
    got = urls.judged(pages, urls.rule_table(spark, rules), **settings).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter(
        (i, *brute(u, rules)) for i, u in enumerate(addresses))


ODD = [
    None, "", "no scheme", "://", "http://", "http://COM/", "http://example.com", "http://example.com/en/",
    "http://www.example.com/en/a?b#c", "http://wwwexample.com/en/", "http://a.www.EXAMPLE.com/en/", "x://net/es/?q=://com/",
    "http://a.net/fr/x", "http://a.net?/fr/", "http://a.net/FR/", "http://.com/", "http://com./", "http://a..com/\nx",
    "http://É.com/é", "http://" + "a." * 5000 + "com/" + "p" * 50000, "http://com/", "http://com/",
]


@pytest.mark.parametrize("segment_keys", [1000, 2])
def test_rules_of_the_query(spark, segment_keys):
    checked(spark, ODD, urls.RULES, segment_keys=segment_keys)


def test_many_rules(spark):
    rng = random.Random(3)
    names = ["a", "b", "co", "com", "net", "x-y", "é"]
    hosts = [".".join(rng.choice(names) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    paths = ["/" + "/".join(rng.choice("pqr") for _ in range(rng.randint(0, 3))) for _ in range(400)]
    seen = {(h, rng.choice([p, p, ""])): rng.choice(["allow", "block"]) for h, p in zip(hosts, paths)}
    rules = [(v, h, p) for (h, p), v in seen.items()]
    addresses = [f"http://{rng.choice(['', 'm.', 'a.b.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice('pqr/')}"
                 for _ in range(1500)]
    checked(spark, addresses, rules)
    checked(spark, addresses[:300], rules, segment_keys=100)


def test_odd_rules(spark):
    """Block comes first for one key; nulls are empty; other verdicts are refused."""
    pages = spark.createDataFrame([(None, "http://a.com/x"), (1, None)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judged(pages, urls.rule_table(
        spark, [("allow", "com", "/"), ("block", "COM", "/"), ("allow", None, None)])).collect()}
    assert got == {None: ("com/", "block"), 1: ("", "allow")}
    assert urls.judged(pages, urls.rule_table(spark, [])).where("rule IS NULL AND verdict = 'allow'").count() == 2
    assert urls.judged(pages.limit(0), urls.rule_table(spark)).count() == 0
    with pytest.raises(Exception, match="unknown verdict"):
        urls.judged(pages, urls.rule_table(spark, [("maybe", "com", "/")]))


def test_cascade_is_exact_where_filters_err(spark):
    """Filters that let half of the other keys pass still tell all keys apart, in several levels."""
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, (3000, 2)).astype(np.uint64)
    sides, levels = [h[:300], h[300:]], []
    while len(sides[0]):
        each = Filter(urls.MOST_BITS and 1 << 15, 1, len(levels))
        each.bits[:] = rng.integers(0, 256, len(each.bits)) if len(levels) < 4 else 0  # random bits err more
        each.add(*sides[0].T)
        levels.append(each)
        sides = [sides[1][each.has(*sides[1].T)], sides[0]]
    assert len(levels) > 4
    assert urls.contained(levels, *h.T).tolist() == [True] * 300 + [False] * 2700
