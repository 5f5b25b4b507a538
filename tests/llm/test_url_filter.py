from tracewright.llm import url_filter
from tracewright.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://a.com", "HTTP://A.COM/", "x://example.com/en/x?y#z",
    "x://WWW.example.com/en/", "x://m.www.example.com/en/q/r", "x://example.com/en", "x://example.com/english",
    "x://a.net/es/", "x://a.net/fr", "x://net/fr/", "x://a.org/", "x://.com/", "x://a.com:80/", "x://com?/en/",
    "x://a.com/://b.net/fr/", "x://" + "a." * 3000 + "com/" + "p/" * 3000,
]


def plain(host, path):
    fits = [
        (len(h), len(p), h + p, v) for h, p, v in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, "allow")


def test_against_plain_search(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id int, url string, rule string")
    rows = url_filter.judged(pages, URL_RULES).collect()
    assert len(rows) == len(URLS)
    assert all((r.rule, r.verdict) == plain(r.host, r.path) for r in rows)
    assert rows[0].host == rows[2].host == "" and rows[5].host == "a.com" and rows[5].path == "/"
    table = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    joined = url_filter.judged_by_table(pages, table, "page_id").collect()
    assert {(r.page_id, r.rule, r.verdict) for r in joined} == {(r.page_id, r.rule, r.verdict) for r in rows}
    assert url_filter.judged(pages.limit(0), URL_RULES).count() == 0


def test_partial_segments_and_ties():
    trie = url_filter.build_trie([
        ("a.com", "/x/ab", "block"), ("a.com", "/x/a", "allow"), ("a.com", "", "allow"), ("com", "/x/abc", "block"),
        ("b.com", "/", "allow"), ("b.com", "/", "block"),
    ] + [("c.com", f"/{i}", "block") for i in range(20)])
    assert url_filter.longest_match(trie, "a.com", "/x/abcd") == ("a.com/x/ab", "block")
    assert url_filter.longest_match(trie, "z.a.com", "/x/ac") == ("a.com/x/a", "allow")
    assert url_filter.longest_match(trie, "a.com", "") == ("a.com", "allow")
    assert url_filter.longest_match(trie, "b.com", "/q") == ("b.com/", "block")
    assert url_filter.longest_match(trie, "c.com", "/19x") == ("c.com/19", "block")
    assert url_filter.longest_match(trie, "", "/") is None
