import random
from collections import defaultdict

import pytest

from pairloom.llm import host_filter
from pairloom.llm.queries import URL_RULES

URLS = [
    (1, "HTTP://A.Example.ORG/es/1?q#f", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "https://org/x", "org", "/x", "org/", "allow"),
    (5, "https://notexample.org", "notexample.org", "", None, None),
    (6, "x://shop.com/fr/", "shop.com", "/fr/", "com/fr/", "allow"),
    (7, "x://shop.com/de/?/fr/", "shop.com", "/de/", "com/de/", "block"),
    (8, "x://shop.com?a=/de/", "shop.com", "", None, None),
    (9, "no scheme.org/", "", "", None, None),
    (10, None, "", "", None, None),
    (11, "", "", "", None, None),
    (12, "x://É.ORG/é://org/", "É.org", "/é://org/", "org/", "allow"),
    (13, "x:///p#f", "", "/p", None, None),
    (13, "x:///p#f", "", "/p", None, None),
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(u[0], u[1], "clash") for u in URLS], "page_id long, url string, host string")
    rows = host_filter.judge_urls(pages, URL_RULES).collect()
    assert len(rows) == len(URLS)
    expected = {u[0]: u[2:] for u in URLS}
    for r in rows:
        host, path, rule, verdict = expected[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def posterior(counts, priors):
    """Shrink {key: (good, n)} around {key: prior}; the plain form of the estimate."""
    seen = [(g, n, priors[k]) for k, (g, n) in counts.items() if n]
    more = sum(n - 1 for _, n, _ in seen)
    wide = sum(n * (g / n - p) ** 2 / (p * (1 - p)) for g, n, p in seen)
    if not more:
        strength = 10.0
    elif wide <= len(seen):
        strength = 1000.0
    else:
        strength = min(max(more / (wide - len(seen)) - 1, 1.0), 1000.0)
    return {k: (g + strength * priors[k], n - g + strength * (1 - priors[k])) for k, (g, n) in counts.items()}


@pytest.mark.parametrize("hot_rows", [1, 10_000])
def test_reputation_equals_plain_python(spark, hot_rows):
    rnd = random.Random(7)
    hosts = [f"{s}.{d}.{t}" for s in "abc" for d in ("x", "y", "z") for t in ("aa", "bb")]
    rows = []
    for i in range(900):
        host = rnd.choice(hosts[:3] * 10 + hosts)
        kind = "good" if rnd.random() < (0.9 if ".x." in host else 0.3) else "bad"
        rows.append((i, f"http://{host}/{kind if rnd.random() < 0.3 else 'new'}/"))
    rules = [("allow", "aa/good"), ("block", "aa/bad"), ("allow", "bb/good"), ("block", "bb/bad")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = host_filter.judge_urls(pages, rules, hot_rows=hot_rows).collect()
    levels = [defaultdict(lambda: (0, 0)) for _ in range(3)]
    for r in found:
        n, good = r.rule is not None, r.verdict == "allow" and r.rule is not None
        for level, key in zip(levels, (r.host.split(".")[-1], ".".join(r.host.split(".")[-2:]), r.host)):
            level[key] = (level[key][0] + good, level[key][1] + n)
    good, n = (sum(x) for x in zip(*levels[0].values()))
    rate = {k: (good + 1) / (n + 2) for k in levels[0]}
    for i, level in enumerate(levels):
        post = posterior(level, rate)
        if i < 2:
            rate = {k: (lambda a, b: a / (a + b))(*post[k.split(".", 1)[1] if i else ".".join(k.split(".")[-1:])])
                    for k in levels[i + 1]}
    for r in found:
        a, b = post[r.host]
        mean = a / (a + b)
        bound = mean - (mean * (1 - mean) / (a + b + 1)) ** 0.5
        assert r.bound == pytest.approx(bound)
        if r.rule is None:
            assert r.verdict == ("allow" if bound >= 0.5 else "block")


def test_no_python_in_the_plan_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = host_filter.judge_urls(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert host_filter.judge_urls(pages.filter("page_id < 0"), URL_RULES).count() == 0


def test_clashing_columns_repeated_rows_and_long_urls(spark):
    long_url = "http://example.org/es/" + "x" * 200_000
    rows = [(1, "http://a.org/x", 5, "k", 0.5, 1, "r", "h")] * 2 + [(2, long_url, 6, "l", 1.5, 0, "s", "i"),
            (3, None, 7, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rows long, a string, b double, good long, "
                                        "rows_of_host string, host string")
    for hot_rows in (1, 10_000):
        judged = host_filter.judge_urls(pages, URL_RULES, hot_rows=hot_rows)
        assert judged.columns == [*pages.columns[:-1], "host", "path", "rule", "verdict", "bound"]
        found = sorted(judged.collect(), key=lambda r: r.page_id)
        assert [tuple(r)[:7] for r in found] == [r[:7] for r in rows]
        assert [(r.host, r.rule, r.verdict) for r in found[:3]] == [
            ("a.org", "org/", "allow"), ("a.org", "org/", "allow"), ("example.org", "example.org/es/", "block")]
        assert found[2].path == long_url[len("http://example.org"):]
        assert (found[3].host, found[3].path, found[3].rule) == ("", "", None)
