"""Operators on pages and vectors against brute force, edge cases included."""

import math

import numpy as np

from cadence.llm import html_extract, topk, url_filter
from cadence.llm.queries import URL_RULES

PAGE = (
    '<html><head><title>t</title><script>var x="</p>";</script></head><body><header><h1>Site</h1></header>'
    '<nav><ul><li><a href="/">home {i}</a></li></ul></nav><div class="cookie-notice">ok</div>{ad}'
    "<article><h1>Title {i}</h1><p><b>First &amp; <i>second</i><br><p>Two\n  words {i}</article>"
    '<section id="comments"><p>reader {i}</p></section><form>q</form><footer>foot</footer></body></html>'
)
URLS = ["http://A.Example.com/en/x?q#f", "https://www.example.com/en/1", "http://example.com", "ftp://x.net/es/", "http://x.net/de/",
        "nothing", "", None, "http://casino.org/x", "http://sub.casino.org:80/x", "x://casino.org", "http:///en/", "http://com/"]


def test_pages_of_a_host(spark):
    data = [(i, "http://h.org/x", PAGE.format(i=i, ad='<div class="ad">buy</div>' if i % 2 else "")) for i in range(6)]
    data += [(90, "http://h.org/cut", "<article><p>cut &eacute; here<p>and <a hr"), (91, None, PAGE.format(i=9, ad=""))]
    data += [(92, "http://h.org/", None), (93, "x", ""), (94, "http://plain.org/", "just text"), (0, data[0][1], data[0][2])]
    pages = spark.createDataFrame([(*r, "extra") for r in data], "page_id int, url string, html string, host_ string")
    out = html_extract.extract_pages(pages)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    for i in range(6):
        text = f"Title {i}\nFirst & second\nTwo words {i}"
        assert got[i] == (text, len(text))
    assert got[90][0] == "cut é here\nand" and got[91][0].startswith("Title 9")
    assert got[92] == got[93] == ("", 0) and got[94][0] == "just text"
    assert out.count() == len(data) and html_extract.extract_pages(pages.limit(0)).count() == 0


def test_every_page_of_a_mixed_host_has_its_article(spark):
    said = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(60)]
    shapes = ["<article><p>{}</p></article>", '<div class="post"><p>{}</p></div>', "<p>{}</p>", "<table><tr><td>{}</table>"]
    data, want = [], {}
    for host, turns in {"http://two.org/": (0, 1, 1), "http://few.org/": (1,) * 9 + (0,), None: (0, 1, 2, 3), "http://p.org/": (0, 2, 2)}.items():
        for i in range(20):
            want[len(data)] = said[i]
            data.append((len(data), host, f"<body><nav>top</nav>{shapes[turns[i % len(turns)]].format(said[i])}</body>"))
    for i in range(5):  # copies of one page, and copies that differ in a date
        for host, more in (("http://copies.org/", ""), ("http://dated.org/", f"<p>day {i}</p>")):
            want[len(data)] = "\n".join([said[50], *([f"day {i}"] if more else [])])
            data.append((len(data), host, f"<body><div><p>{said[50]}</p></div>{more}</body>"))
    pages = spark.createDataFrame(data, "page_id int, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    for i, host, _ in data:
        # A date beside the element that holds the article may stay out.
        assert got[i] == want[i] or host == "http://dated.org/" and got[i] == said[50], (host, got[i])


def judge(url, blocked):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end].lower(), rest[end:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.key))
        return host, path, best.key, best.verdict
    hit = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, None, "block" if hit else "allow"


def test_urls_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(URLS + URLS[:2])], "page_id int, url string, keys_ string")
    for blocked in (["Casino.org", None], []):
        hosts = spark.createDataFrame([(b,) for b in blocked], "host string")
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, URL_RULES, hosts).collect()}
        assert got == {i: judge(u, [b.lower() for b in blocked if b]) for i, u in enumerate(URLS + URLS[:2])}
    assert url_filter.judge_urls(pages.limit(0), URL_RULES, hosts).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).selectExpr("concat('k', id) as key")
    listed = spark.range(0, 4000, 7).selectExpr("concat('k', id) as key")
    cascade = url_filter.build_cascade(universe, listed, bits_per_key=2.0)
    assert len(cascade.levels) > 2
    assert all(cascade.has(f"k{i}") == (i % 7 == 0) for i in range(4000))


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=4).astype(float).tolist()) for i in range(60)]
    data += [(60 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(20)] + [(60, [0.5, 0.5, 0.0, 0.0]), (10, data[10][1])]
    odd = [(None, data[0][1]), (100, None), (110, [1.0, None, 0.0, 0.0]), (120, [math.nan, 0.0, 0.0, 0.0]), (130, [math.inf, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in data + odd], "vec_id long, embedding array<double>, q int").repartition(4)
    got = topk.search(df, df.where("vec_id % 10 = 0"), 5, query_block=4).collect()
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in data]
    want = []
    for n, (i, v) in enumerate(vectors):
        if i % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(vectors) if m != n)[:5]
            want += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.search(df.limit(0), df.limit(0), 5).count() == 0
