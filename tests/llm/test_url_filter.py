import random

import pytest

from callscore.llm import url_filter as U
from callscore.llm.queries import URL_RULES

URLS = ["http://a.example.net/en/1", "https://example.net/fr/", "http://NET/", "http://fnet/", "http://net", "x://y.org/fr/?q#f", "http://org/de/", None, "", "no scheme/at/all",
        "http://user@example.com:80/de/1", "http://a.b.example.com/de/x#y", "HTTP://EXAMPLE.COM/DE/", "a://b://c.net/x", "http://?q", "http://.net/", "http://É.NET/é", "://net/"]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].encode().lower().decode(), rest[cut:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(h.count("."), len(p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_trie_matches_brute_force():
    rng = random.Random(8)
    hosts = ["net", "a.net", "b.a.net", "com", "x.com", "org"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/a", "/en/a/", "/en//"]
    for _ in range(150):
        rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(rng.randrange(1, 9)))}.values())
        trie = U.UrlTrie(rules)
        for _ in range(40):
            url = f"http://{rng.choice(['', 'z.', 'b.'])}{rng.choice(hosts)}{rng.choice([*paths, '/en/a/b?c', '/end', '/en/ab'])}"
            host, path = U.split_url(url)
            node = trie.match(host, path)
            assert (host, path, node and node["rule"], node["verdict"] if node else "allow") == brute(url, rules), (url, rules)


def test_judge_urls(spark):
    df = spark.createDataFrame([(k, u, "clash", "clash", 1) for k, u in enumerate(URLS * 2)], "page_id long, url string, host string, Rule string, _judged int")
    got = U.judge_urls(df, URL_RULES)
    assert got.columns == ["page_id", "url", "_judged", "host", "path", "rule", "verdict"]
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], URL_RULES), r["url"]
    assert U.judge_urls(df.where("false"), URL_RULES).count() == 0
    assert {r["verdict"] for r in U.judge_urls(df, [], default="block").collect()} == {"block"}


def test_rules_are_checked(monkeypatch):
    assert U.UrlTrie([("allow", "net", "/"), ("block", "net", "/")]).match("net", "/")["verdict"] == "block"
    with pytest.raises(ValueError):
        U.UrlTrie([("maybe", "net", "/")])
    monkeypatch.setattr(U, "MAX_RULES", 1)
    with pytest.raises(ValueError):
        U.UrlTrie([("allow", "net", "/"), ("block", "org", "/")])


def test_rules_in_a_table(spark):
    rng = random.Random(21)
    hosts, paths = ["net", "a.net", "b.a.net", "com", "x.com", "org", "NET"], ["", "/", "/e", "/en", "/en/", "/en/a", "/en/a/", "/en//"]
    rules = list({(h.lower(), p): (rng.choice(["allow", "block"]), h.lower(), p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(25))}.values())
    urls = URLS + [f"http://{rng.choice(['', 'z.', 'b.'])}{rng.choice(hosts)}{rng.choice([*paths, '/en/a/b?c', '/end', '/en/ab'])}" for _ in range(200)]
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls * 2)], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = U.judge_urls_by_table(df, table)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"] and got.count() == 2 * len(urls)
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], rules), r["url"]
