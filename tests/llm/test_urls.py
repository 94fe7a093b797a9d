import random

from quarry.llm import op1_urls as U


def judge(spark, urls, rules, **kw):
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id int, url string, host string, verdict string")
    got = U.url_filter(df, spark.createDataFrame(rules, "verdict string, host string, path string"), **kw)
    return [(r.host, r.path, r.rule, r.verdict) for r in got.orderBy("page_id").collect()]


def plain(url, rules):
    """Every rule tried on its own."""
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if not fits:
        return host, path, None, "allow"
    v, h, p = max(fits, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0] == "block"))
    return host, path, h + p, v


URLS = [None, "", "no scheme/x", "http://", "http://example.org", "http://example.org/", "HTTPS://WWW.Example.ORG/es/a?x=/de/",
        "http://a.example.org/en/1234", "http://a.example.org/en/2", "http://badexample.org/es/", "http://x.com/fr/1",
        "http://x.com/de/1#/fr/", "http://x.com?/fr/", "http://com/fr/", "http://org.com/fr/", "x://y://z.org/a",
        "http://example.org:80/es/", "http://.org/a", "http://a..org/a", "http://\u00c9.org/\u00e9" + "/p" * 3000]


def test_trie_and_join_agree_with_every_rule_tried(spark):
    want = [plain(u, U.RULES) for u in URLS]
    assert judge(spark, URLS, U.RULES) == want
    assert judge(spark, URLS, U.RULES, trie_bytes=0) == want


def test_random_rules(spark):
    rng = random.Random(3)
    labels, segments = ["a", "b", "com"], ["", "x", "xy", "x/y", "y/"]
    rules = [(rng.choice(["allow", "block"]), ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4))),
              "/" + rng.choice(segments)) for _ in range(60)] + [("block", "a.com", "/x"), ("allow", "a.com", "/x")]
    urls = ["http://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) + "/" + rng.choice(segments) + rng.choice(["", "/z", "?q"])
            for _ in range(200)]
    want = [plain(u, rules) for u in urls]
    assert judge(spark, urls, rules) == want
    assert judge(spark, urls, rules, trie_bytes=0) == want


def test_no_rules_and_no_rows(spark):
    empty = spark.createDataFrame([], "page_id int, url string")
    rules = spark.createDataFrame(U.RULES, "verdict string, host string, path string")
    assert U.url_filter(empty, rules).collect() == []
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id int, url string")
    assert U.url_filter(pages, none, default="block").select("rule", "verdict").collect() == [(None, "block")]
