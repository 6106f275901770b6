import random

from fleetgrain.llm import url_rules
from fleetgrain.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0].split("?", 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if c.isascii() else c for c in host), slash + path


def plain(url, rules):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, "allow")


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", "r") for i, u in enumerate(urls)], "page_id long, url string, key string, rule string")
    table = spark.createDataFrame([(*r, "x") for r in rules], "host string, path string, verdict string, key string")
    rows = url_rules.apply_rules(pages, table).collect()
    assert len(rows) == len(urls)
    return [tuple(r)[1:] for r in sorted(rows)]


def test_against_all_rules(llm):
    rng = random.Random(2)
    labels, paths = ["a", "b", "co", "com", "example", "www", "x-y", "é"], ["", "/", "/a", "/a/", "/a/b", "/ab", "/é"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = [(host(), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [("com", "/", "allow"), ("", "/", "block")]
    urls = [f"http://{host()}{rng.choice(paths)}{rng.choice(['', '?a://b', '#c', 'z'])}" for _ in range(1500)]
    urls += ["http://WWW.Example.COM/a/", "x", "", None, "://", "http://", "http://com", "http://com?x", "http://com#/", "a://b://com/"]
    urls += ["http://hot.example.com/a/b"] * 700
    assert judged(llm, urls, rules) == [plain(u, rules) for u in urls]


def test_the_fixed_rules(llm):
    urls = ["https://www.example.com/en/1", "http://m.example.com/en/2?x", "http://example.com/fr/", "http://a.b.net/es/1", "http://net/fr"]
    urls += ["http://example.org/en/", "http://notexample.com/en/", "http://example.com.evil.org/en/"]
    got = judged(llm, urls, URL_RULES)
    assert [g[2] for g in got] == ["www.example.com/en/", "example.com/en/", "com/", "net/es/", None, None, "com/", None]
    assert got == [plain(u, URL_RULES) for u in urls]


def test_empty_tables(llm):
    assert judged(llm, [], URL_RULES) == []
    assert judged(llm, ["http://a.com/x", None], []) == [("a.com", "/x", None, "allow"), ("", "", None, "allow")]


def test_long_urls_and_null_ids(llm):
    long = "http://" + "a." * 2000 + "com/" + "p" * 50_000
    pages = llm.createDataFrame([(None, long), (None, long)], "page_id long, url string")
    rules = llm.createDataFrame([("com", "/" + "p" * 49_000, "block")], "host string, path string, verdict string")
    rows = url_rules.apply_rules(pages, rules).collect()
    assert [(r["page_id"], r["verdict"]) for r in rows] == [(None, "block")] * 2
