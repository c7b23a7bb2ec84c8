import random

from cohortlens.llm.url_filter import url_verdicts


def page(url, links=""):
    return f"<html><head>{links}</head><body>{url}</body></html>"


def canonical(href):
    return f'<LINK href="{href}" rel="canonical">'


def refresh(href):
    return f"<meta http-equiv='refresh' content='0; url={href}'>"


def test_rules_and_parts(spark):
    urls = {
        1: ("https://A.Example.com/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        2: ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("http://m.www.example.com/en/1", "m.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        4: ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"), 5: ("http://x.net/en/1", "x.net", "/en/1", None, "allow"),
        6: ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"), 7: (None, "", "", None, "allow"),
        8: ("no scheme", "", "", None, "allow"), 9: ("", "", "", None, "allow"), 10: ("ftp://com", "com", "", None, "allow"),
        11: ("x://h.net?a=://z", "h.net", "", None, "allow"), 12: ("http://E\u00c9.net/fr/", "e\u00c9.net", "/fr/", "net/fr/", "block")}
    df = spark.createDataFrame([(i, u[0], None, "r", "h") for i, u in urls.items()] + [(5, "http://x.net/en/1", "", "", "")],
                               "page_id long, url string, html string, rule string, host string")
    rows = url_verdicts(df).collect()
    assert len(rows) == 13
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:], r.page_id


def test_blocks_reach_aliases_unless_one_is_allowed(spark):
    rows = [
        (1, "http://a.org/1", page("", canonical("http://bad.net/es/9"))),           # alias of a blocked url
        (2, "http://b.org/2?x", page("", refresh("http://a.org/1#top"))),             # alias of an alias
        (3, "http://c.org/dir/3", page("", canonical("../x"))),
        (4, "http://d.org/4", page("", canonical("//bad.net/fr/1") + refresh("https://good.com/1"))),  # blocked and allowed
        (5, "http://e.org/5", page("", canonical("/same"))), (6, "https://e.org/same", page("", canonical("http://q.net/es/"))),
        (7, "http://f.com/7", page("", canonical("http://q.net/es/2"))),              # own allow rule stands
        (8, "http://g.org/8", None), (9, "http://h.org/9", '<link rel="stylesheet" href="http://bad.net/es/9">')]
    want = {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block", 7: "allow", 8: "allow", 9: "allow"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_verdicts(df).collect()} == want
    moved = spark.createDataFrame([("http://g.org/8", "http://z.net/fr/1"), (None, "x")], "from_url string, to_url string")
    got = {r.page_id: r.verdict for r in url_verdicts(df, redirects=moved).collect()}
    assert got == {**want, 8: "block"}
    assert url_verdicts(df.limit(0)).collect() == []


def test_random_graph_against_union_find(spark):
    r = random.Random(3)
    hosts = ["a.org", "b.org", "bad.net", "good.com", "m.example.com"]
    urls = [f"http://{r.choice(hosts)}/{r.choice(['es/', 'fr/', 'en/', 'x/', ''])}{i}" for i in range(120)]
    links = {i: [r.choice(urls) for _ in range(r.choice([0, 0, 1, 1, 2]))] for i in range(120)}
    rows = [(i, u, page("", "".join(r.choice([canonical, refresh])(x) for x in links[i]))) for i, u in enumerate(urls)]

    def judged(url):
        host, path = url[7:].split("/", 1)
        fits = [(len(rule), verdict) for rule, verdict in
                (("com/", "allow"), ("example.com/en/", "block"), ("net/es/", "block"), ("net/fr/", "block"))
                if ("." + host).endswith("." + rule.split("/")[0]) and ("/" + path).startswith(rule[rule.index("/"):])]
        return max(fits)[1] if fits else None

    root = {u: u for u in urls}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, own in links.items():
        for x in own:
            root[find(urls[i])] = find(x)
    want = {}
    for i, u in enumerate(urls):
        said = {judged(x) for x in urls if find(x) == find(u)}
        want[i] = judged(u) or ("block" if "block" in said and "allow" not in said else "allow")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {x.page_id: x.verdict for x in url_verdicts(df).collect()} == want
    assert len({find(u) for u in urls}) < 100 and set(want.values()) == {"allow", "block"}


def test_long_urls_and_pages(spark):
    long = "http://x.net/es/" + "a/" * 50_000
    rows = [(1, long, page("", "x" * 300_000 + canonical("http://y.org/1"))), (2, "http://y.org/1", "y" * 300_000), (2, "http://y.org/1", None)]
    got = url_verdicts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, len(r.path), r.verdict) for r in got) == [(1, 100_004, "block"), (2, 2, "block"), (2, 2, "block")]
