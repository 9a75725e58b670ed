"""URL filters against a plain reading of the rules, with awkward URLs."""

import re

from inkgraph.llm import url_filters

URLS = [
    "http://example.org/es/x", "https://WWW.Example.ORG/en/17?q=1", "https://example.org/en/2", "http://a.b.example.org/es/",
    "http://notexample.org/es/", "http://x.org", "http://x.org/", "http://org/", "https://shop.com/fr/", "https://shop.com/FR/",
    "https://shop.com/de/a#b", "http://com/de", "ftp://host.com/de/?x=/de/", "no scheme at all", "", None, "://org/",
    "http://a.org:8080/x", "http://ads.example.net/x", "http://site.net/banner/1", "http://site.net/file.EXE",
    "http://site.net/get/tool.exe", "http://site.net/wp-login.php", "http://site.net/x/wp-login.php?r=1",
    "http://example.org/es/http://com/de/", "http://" + "a." * 5000 + "org/" + "b/" * 5000, "HTTP://EXAMPLE.COM/de/",
    "http://example.org/ES/", "http://e.org/#/es/", "http://tracker.site.org/es/",
]


def plain(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url[url.index("://") + 3:]
        host = re.match(r"[^/?#]*", rest).group(0).translate(str.maketrans(url_filters.UPPER, url_filters.LOWER))
        path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fitting = [(len(h + p), v == "block", h + p, v) for v, h, p in url_filters.BASE_RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fitting) if fitting else None
    own = [r.number for r in url_filters.rules() if r.text is None and re.search(r.pattern, host + path)]
    verdict = best[3] if best else ("block" if own else "allow")
    return host, path, best[2] if best else None, verdict, min(own) if own else None


def test_rules_as_written(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, "http://x.org/", None), (1, URLS[1], "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")   # a clashing column
    got = {(r.page_id, r.host, r.path): r for r in url_filters.judge(pages).collect()}
    assert len(url_filters.judge(pages).collect()) == len(rows)
    for page_id, url, _ in rows:
        host, path, rule, verdict, own = plain(url)
        row = got[(page_id, host, path)]
        assert (row.rule, row.verdict, row.own_rule) == (rule, verdict, own), url


def test_index_files_under_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://s{i}.example.org/en/{i}") for i in range(30)] + [(99, "http://x.org/es/")],
                                  "page_id long, url string")
    index = url_filters.index_tokens(pages, url_filters.rules())
    # example.org/es/: "es" is the rarest of example, org, es; example.org/en/1: "en" is rarer than example and org? no: 30 each
    assert 1 in index["es"]
    assert all(2 not in numbers for token, numbers in index.items() if token not in ("en", "example", "org"))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(pages).collect() == []
