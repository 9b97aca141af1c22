import duckdb
from landweave.llm import url_filters as uf
from landweave.llm.sql import url_filter_sql

FOLLOW = 0.6
SCHEMA = "page_id long, url string, html string, host string, rule int"


def link(*urls):
    return " ".join(f'<a class="x" href="{u}">t</a>' for u in urls)


def brute(edges, seeds, follow):
    """Trust (along links) or distrust (against them) by many plain rounds."""
    total = {}
    for (a, _), n in edges.items():
        total[a] = total.get(a, 0) + n
    rank = dict(seeds)
    for _ in range(400):
        rank = {h: seeds[h] + follow * sum(rank[a] * n / total[a] for (a, b), n in edges.items() if b == h) for h in seeds}
    return rank


PAGES = [
    (1, "http://a.net/x", link("http://b.example/1", "http://b.example/2", "//c.example/", "/own"), "h", 1),
    (2, "https://B.Example/p?q", link("http://a.net/", "http://a.net/", "mailto:x@y", "rel"), "h", 1),
    (3, "https://c.example/", link("http://d.org/", "http://b.example/"), "h", 1),
    (4, "http://d.org/fr/1", link("http://c.example/", "https://e.example/"), "h", 1),
    (5, "http://e.example/#f", link("http://a.net"), "h", 1),
    (6, "http://e.example/#f", link("http://a.net"), "h", 1),
    (7, "http://fr.example.com/de/", None, "h", 1),
    (8, "http://example.net/en/1", "", "h", 1),
    (9, None, link("http://a.net/"), "h", 1),
    (10, "no scheme", link("http://a.net/"), "h", 1),
    (11, "http://example.com", "x" * 50_000, "h", 1),
    (12, "http://h.example/", link("http://z.net/", "/more"), "h", 1),
    (13, "http://z.net/", None, "h", 1),
    (None, "http://f.example/", link("http://g.example/"), "h", 1),
]


def judged(spark, rows, **options):
    return {(r.page_id, r.host): r for r in uf.judge_urls(spark.createDataFrame(rows, SCHEMA), **options).collect()}


def test_propagation_matches_plain_rounds(spark):
    got = judged(spark, PAGES, follow=FOLLOW)
    edges = {("a.net", "b.example"): 2, ("a.net", "c.example"): 1, ("b.example", "a.net"): 2, ("c.example", "d.org"): 1, ("c.example", "b.example"): 1}
    edges |= {("d.org", "c.example"): 1, ("d.org", "e.example"): 1, ("e.example", "a.net"): 2, ("f.example", "g.example"): 1, ("h.example", "z.net"): 1}
    hosts = {h for e in edges for h in e} | {"fr.example.com", "example.net", "example.com"}
    trust = brute(edges, {h: float(h in ("d.org", "example.net")) for h in hosts}, FOLLOW)
    distrust = brute({(b, a): n for (a, b), n in edges.items()}, {h: float(h in ("a.net", "z.net", "fr.example.com")) for h in hosts}, FOLLOW)
    for (_, host), r in got.items():
        if host:
            assert abs(r.trust - trust[host]) < 1e-4 and abs(r.distrust - distrust[host]) < 1e-4
            if r.rule is None:
                assert (r.verdict == "block") == (distrust[host] >= uf.LEAST and distrust[host] > trust[host])
    assert got[12, "h.example"].verdict == "block" and got[12, "h.example"].rule is None  # it links to a blocked host only
    assert got[2, "b.example"].verdict == got[3, "c.example"].verdict == "allow"  # trusted hosts lead to them
    assert got[7, "fr.example.com"].rule == "example.com/de/" and got[8, "example.net"].rule == "example.net/en/"
    assert got[9, ""].verdict == got[10, ""].verdict == "allow" and got[9, ""].path == ""
    assert got[2, "b.example"].path == "/p" and got[11, "example.com"].path == ""


def test_sql_agrees_on_links_between_hosts(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).toPandas()
    con = duckdb.connect()
    con.register("pages", pages)
    con.execute("CREATE TABLE p AS SELECT CAST(page_id AS BIGINT) AS page_id, url, html FROM pages")
    con.unregister("pages")
    con.execute("ALTER TABLE p RENAME TO pages")
    want = con.execute(url_filter_sql(FOLLOW)).fetchall()
    got = [tuple(r) for r in uf.judge_urls(spark.createDataFrame(PAGES, SCHEMA), follow=FOLLOW).collect()]
    for x, y in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert x[:5] == y[:5] and all(abs((p or 0) - (q or 0)) < 2e-4 and (p is None) == (q is None) for p, q in zip(x[5:], y[5:], strict=True))


def test_empty_table(spark):
    assert judged(spark, []) == {}
