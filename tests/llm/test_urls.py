from gridlake.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
SHAPE = "host string, path string, verdict string"


def brute(url, rules=RULES, default="allow"):
    tail = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([tail.find(c) for c in "/?#" if c in tail] or [len(tail)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in tail[:cut])
    path = tail[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def judged(spark, pages, rules=RULES):
    df = spark.createDataFrame([(i, u, "h") for i, u in pages], "page_id long, url string, host string").repartition(4)
    got = urls.judge(df, spark.createDataFrame(rules, SHAPE))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def expected(pages, rules=RULES):
    return sorted(((i, *brute(u, rules)) for i, u in pages), key=repr)


def test_urls_and_edges(spark):
    pages = list(enumerate([
        "http://WWW.Example.com/en/1?x=/fr/", "https://example.com/en/2", "http://a.example.com/en", "http://b.net/es/x#y",
        "http://notexample.com/en/", "http://com/", "http://com", "http://net/fr/", "nothing", "", None, "x://y://z/en/",
        "http://a..com/", "http://.com/", "http://example.com:80/en/", "http://" + "a." * 60 + "net/fr/" + "p" * 5000, "http://É.com/"]))
    pages += [(3, pages[3][1]), (None, "http://example.com/en/9")]
    assert judged(spark, pages) == expected(pages)


def test_hot_host_is_cut_and_nested_rules_hold(spark):
    rules = RULES + [("example.com", "/en/a", "allow"), ("x.example.com", "/en/a/b", "block"), ("example.org", "", "block")]
    pages = [(k, f"http://example.com/en/{'ab'[k % 2]}/{k}") for k in range(400)]
    pages += [(1000 + k, f"http://{'x.' * (k % 3)}example.{('com', 'org', 'net')[k % 3]}/en/a/b{k}") for k in range(200)]
    assert judged(spark, pages, rules) == expected(pages, rules)


def test_empty_tables(spark):
    assert judged(spark, []) == []
    assert judged(spark, [(1, "http://a.com/")], []) == [(1, "a.com", "/", None, "allow")]
    assert judged(spark, [(1, "http://a.com/")], [(None, "/", "block"), ("", "/", "block"), ("a.com", None, "block")]) == [
        (1, "a.com", "/", "a.com", "block")]
