from bazaar.llm.queries import URL_RULES
from bazaar.llm.url_filter import judge_urls, rule_index, url_host, url_path
from pyspark.sql import functions as F
from tests.llm.util import clashing, frame, rows

RULES = "host string, path string, action string"
URLS = [
    (1, "http://a.example.org/es/x?y#z"), (2, "https://EXAMPLE.org/en/100"), (3, "http://example.org"),
    (4, "http://badexample.org/es/"), (5, "http://x.com/fr/1"), (6, "http://x.com/de/"), (7, None), (8, "no scheme"),
    (9, ""), (None, "http://q.com/de/9"), (9, "http://x.com/de/"), (9, "http://x.com/de/"),
    (10, "http://a.net/" + "p/" * 50_000), (11, "ftp://u:p@example.org:80/es/"), (12, "http://example.org?es/"),
    (13, "http://ÄX.ORG/a\nb"), (14, "a://b://example.org/es/"), (15, "http://example.org/es"),
]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), len(h), h + p, a) for h, p, a in rules
           if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def check(spark, urls, rules):
    got = rows(judge_urls(clashing(frame(spark, urls, "page_id long, url string")), frame(spark, rules, RULES)))
    want = [(i, *brute(u, rules)) for i, u in urls]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_against_brute_force(spark):
    check(spark, URLS, URL_RULES)


def test_ties_rules_without_tokens_and_special_characters(spark):
    check(spark, URLS, [("", "/es/", "block"), ("com", "", "block"), ("com", "", "allow"), ("x.com", "/", "allow"),
                        ("a.net", "/p/p", "block"), ("", "/", "allow"), ("example.org", "/e", "block"),
                        ("u:p@example.org:80", "/es/", "block"), ("xacom", "/", "block"), ("b:", "/", "block")])


def test_empty_tables(spark):
    none = frame(spark, [], "page_id long, url string")
    assert rows(judge_urls(none, frame(spark, URL_RULES, RULES))) == []
    check(spark, URLS, [])
    assert rows(judge_urls(frame(spark, URLS[:1], "page_id long, url string"),
                           frame(spark, [(None, None, None)], RULES)))[0][4] == "allow"


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = frame(spark, [("http://a.org/es/",), ("http://b.org/en/",), ("http://b.org/en/",)], "url string")
    urls = urls.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    index = rule_index(urls, frame(spark, [("org", "/es/", "block"), ("b.org", "/en/", "block"), ("", "", "allow"),
                                           ("never.org", "/", "block")], RULES))
    assert {r["rule"]: r["token"] for r in index.collect()} == {
        "org/es/": "p:es", "b.org/en/": "h:b", "": "*", "never.org/": "h:never"}
