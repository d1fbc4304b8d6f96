"""The trie against a scan of all rules."""

import random

from paneflow.llm import url_filter as u


def brute(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == u.BLOCK), default=None)
    return (best.name, best.verdict) if best else None


def test_random_rules():
    rng = random.Random(9)
    hosts = ["net", "a.net", "b.a.net", "org", "x.org", "net.org"]
    paths = ["/", "/en", "/en/", "/en/x", "/en/x/", "/e", "", "/en//"]
    for _ in range(300):
        rules = [u.Rule(rng.choice(hosts), rng.choice(paths), rng.choice([u.ALLOW, u.BLOCK]))
                 for _ in range(rng.randrange(8))]
        trie = u.build_trie(rules)
        for _ in range(20):
            host = rng.choice(["", "z."]) + rng.choice([*hosts, "anet", "net.", ""])
            path = rng.choice([*paths, "/en/xy", "/english", "/en/x/y", "/q"])
            assert u.longest_match(trie, host, path) == brute(rules, host, path), (rules, host, path)


def test_odd_urls_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "no scheme", "x"), (3, "http://A.Net", "x"), (4, "http://a.NET/?q", "x"),
            (5, "a://b.org/fr/x#y://z", "x"), (5, "a://b.org/fr/x#y://z", "x"), (None, "://", "x"),
            (6, "http://e.net/" + "a/" * 50_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = [u.Rule("net", "/", u.BLOCK), u.Rule("org", "/fr/", u.ALLOW)]
    got = {(r.page_id, r.host, r.path[:9], r.rule, r.verdict) for r in u.judge(pages, rules).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.net", "", None, "allow"),
        (4, "a.net", "/", "net/", "block"), (5, "b.org", "/fr/x", "org/fr/", "allow"),
        (None, "", "", None, "allow"), (6, "e.net", "/a/a/a/a/", "net/", "block"),
    }
    assert u.judge(pages.limit(0), rules).count() == 0
