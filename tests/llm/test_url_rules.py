from threadlake.llm import url_rules
from threadlake.llm.url_rules import ALLOW, BLOCK, Rule, Trie, filter_urls, host_and_path

RULES = [
    Rule("com", "/", ALLOW), Rule("example.com", "/en/", BLOCK), Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK), Rule("net", "/fr/", BLOCK), Rule("a.org", "/x", BLOCK), Rule("a.org", "/x/y", ALLOW),
    Rule("a.org", "/x/y/", BLOCK), Rule("b.org", "/", BLOCK), Rule("b.org", "/", ALLOW), Rule("a.org", "//", ALLOW),
]
URLS = [
    None, "", "no scheme", "http://", "http://example.com", "http://EXAMPLE.com/en/1?a=/b", "https://www.example.com/en/",
    "https://m.www.example.com/en/x#t", "http://notexample.com/en/", "http://x.net/es", "http://x.net/es/1", "http://net/fr/",
    "http://a.org/xyz", "http://a.org/x/yz", "http://a.org/x/y/z", "http://a.org/x/", "http://b.org/", "http://a.org//q",
    "ftp://a.b://c.net/es/", "http://example.com?x=://y.net/es/", "http://É.com/", "x://com/en/",
]


def brute(url):
    host, path = host_and_path(url)
    fitting = [
        r for r in RULES if f".{host}".endswith(f".{r.host}") and path.startswith(r.path)
    ]
    return max(fitting, key=lambda r: (r.host.count("."), len(r.path), r.verdict == BLOCK), default=None)


def test_parts_of_urls():
    assert host_and_path("http://EXAMPLE.com/A?b#c") == ("example.com", "/A")
    assert host_and_path("a://b#/c") == ("b", "")
    assert host_and_path("a:/b") == host_and_path(None) == ("", "")
    assert host_and_path("x://ÀB/") == ("Àb", "/")


def test_trie_finds_what_trying_all_rules_finds():
    trie = Trie(RULES)
    for url in URLS:
        assert trie.find(*host_and_path(url)) == brute(url), url


def test_rows_and_slices(spark, monkeypatch):
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    df = df.union(df)
    want = []
    for i, url in enumerate(URLS):
        rule = brute(url)
        row = (i, *host_and_path(url), rule.name if rule else None, rule.verdict if rule else BLOCK)
        want += [row, row]
    for size in (200_000, 3):
        monkeypatch.setattr(url_rules, "TRIE_RULES", size)
        got = sorted(map(tuple, filter_urls(df, RULES, default=BLOCK).collect()), key=repr)
        assert got == sorted(want, key=repr)
    assert {r.verdict for r in filter_urls(df, []).collect()} == {ALLOW}
    assert filter_urls(df.limit(0), RULES).count() == 0
