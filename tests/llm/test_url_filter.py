import random
import time

import pytest

from ordermill.llm.queries import URL_RULES
from ordermill.llm.url_filter import Trie, filter_urls, parse_rule
from tests.conftest import rows


def brute(rules, url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    best = None
    for rule in rules:
        fits = host == rule.host or host.endswith("." + rule.host)
        if fits and path.startswith(rule.path):
            key = (rule.host.count("."), len(rule.path), rule.action == "block")
            best = max(best or (key, rule), (key, rule))
    rule = best and best[1]
    return host, path, rule and rule.host + rule.path, rule.action if rule else "allow"


URLS = [
    None, "", "nothing", "http://", "http://net", "http://a.net/", "https://X.EXAMPLE.net/en/1?q#f", "http://example.net/english",
    "http://notexample.net/en/1", "http://a.example.com/de/x", "http://example.com/den", "http://org/fr/", "http://a.org/fr",
    "http://a.net?x=/en/", "ftp://b.org/fr/#://c.net/", "http://.net/", "http://a.net./", "http://é.net/ü", "http://a.net:80/",
]


@pytest.mark.parametrize("limit", [1, 2, 100])
def test_rules_of_the_contract(spark, limit):
    pages = spark.createDataFrame(
        [(k, u, "x", "y") for k, u in enumerate(URLS)] + [(None, "http://a.net/", "x", "y")],
        "page_id long, url string, rule string, _url string",
    )
    found = filter_urls(pages, URL_RULES, max_rules=limit)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert rows(found) == sorted(
        ((k, *brute(URL_RULES, u)) for k, u in [*enumerate(URLS), (None, "http://a.net/")]), key=repr
    )
    assert filter_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in filter_urls(pages, [], default="block").collect()} == {"block"}


def test_random_rules_equal_brute_force():
    rng = random.Random(5)
    label, segment = ["a", "b", "c"], ["", "x", "xy", "y"]
    for _ in range(200):
        rules = [
            parse_rule(rng.choice(["allow", "block"]), ".".join(rng.choices(label, k=rng.randint(1, 3)))
                       + rng.choice(["", "/", "/x", "/x/", "/x/y", "/xy/"]))
            for _ in range(rng.randint(0, 6))
        ]
        trie = Trie(rules)
        for _ in range(20):
            url = "h://" + ".".join(rng.choices(label, k=rng.randint(1, 4))) + rng.choice(["", "/"]) + "/".join(rng.choices(segment, k=2))
            host, path, rule, verdict = brute(rules, url)
            found = trie.longest(host, path)
            assert (found and (found[1].host + found[1].path, found[1].action)) == (rule and (rule, verdict))


def test_unknown_actions_are_refused():
    with pytest.raises(ValueError):
        parse_rule("maybe", "net/")


def test_many_path_rules_of_one_host():
    trie = Trie([parse_rule("block", f"a.net/x/page{k:05}") for k in range(50_000)] + [parse_rule("allow", "a.net/x/p")])
    start = time.process_time()
    for k in range(0, 50_000, 25):
        assert trie.longest("www.a.net", f"/x/page{k:05}-more")[1].path == f"/x/page{k:05}"
        assert trie.longest("a.net", f"/x/pag{k}")[1].path == "/x/p"
    assert time.process_time() - start < 1
