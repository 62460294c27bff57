"""URL filters against every rule tried on every url."""

from collections import Counter

import pytest

from customer_canon.llm import urls

RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("allow", "net/es/ok"),
    ("block", "Org"),
    ("block", "a.b.c.d.net/es/okay/no"),
    ("block", "xample.com/"),
]
URLS = [
    "https://www.example.com/en/x?q#f",
    "http://WWW.Example.COM/en/",
    "http://example.com/en/1",
    "http://notexample.com/en/1",
    "http://x.xample.com/",
    "http://a.example.com/EN/",
    "http://example.com",
    "http://example.com?x=/en/",
    "http://net/es/1",
    "http://a.b.c.d.net/es/okay/no/1",
    "http://a.b.c.d.net/es/okay/",
    "http://d.net/es/ok://twice",
    "http://some.org",
    "http://some.org/p",
    "http://ÄÖ.com/é",
    "http://a.com./x",
    "http://.com/x",
    "no scheme",
    "",
    None,
    "http://example.com/" + "long/" * 20_000,
]


def judged(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = (-1, None, default)
    for verdict, rule in rules:
        of_host, slash, of_path = rule.partition("/")
        of_host = of_host.lower()
        if (host == of_host or host.endswith("." + of_host)) and path.startswith(slash + of_path):
            best = max(best, (len(rule), rule, verdict))
    return host, path, best[1], best[2]


def rule_table(spark, rules):
    return spark.createDataFrame(rules, "verdict string, rule string")


@pytest.mark.parametrize("runs", [1, 7])
def test_longest_rule_wins(spark, runs):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3])] * 4 + [(None, URLS[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS node", "2 AS run")
    got = urls.judge_urls(pages, rule_table(spark, RULES), runs=runs).drop("url").collect()
    assert Counter(map(tuple, got)) == Counter((i, *judged(u, RULES)) for i, u in rows)


def test_many_nested_rules(spark):
    rules = [("block" if n % 2 else "allow", ".".join(["h"] * n) + "/" + "p/" * m) for n in range(1, 9) for m in range(6)]
    rows = [(n * 10 + m, "http://" + ".".join(["h"] * n) + "/" + "p/" * m) for n in range(1, 10) for m in range(8)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rule_table(spark, rules))
    assert Counter(map(tuple, got.drop("url").collect())) == Counter((i, *judged(u, rules)) for i, u in rows)


def test_no_rows_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, rule_table(spark, RULES)).collect() == []
    one = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    (row,) = urls.judge_urls(one, rule_table(spark, []), default="block").collect()
    assert (row.rule, row.verdict) == (None, "block")


def test_two_rules_of_one_text(spark):
    one = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert urls.judge_urls(one, rule_table(spark, [("allow", "a/"), ("block", "a/")])).first().verdict == "block"
