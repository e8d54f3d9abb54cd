import duckdb

from lakestrata.llm.queries import URL_RULES
from lakestrata.llm.sql import url_filters_sql
from lakestrata.llm.url_filters import Rule, alias_edges, judge_pages
from tests.llm.helpers import rows
from tests.oracle import compare

PAGES = "page_id long, url string, html string, rule string"


def judged(spark, pages, rules=URL_RULES):
    df = spark.createDataFrame([(i, u, h, "extra") for i, u, h in pages], PAGES)
    return {(r["page_id"], i): r for i, r in enumerate(sorted(rows(judge_pages(df, rules)), key=lambda r: (r["page_id"] or -1, str(r["verdict"]))))}


def one(spark, url, rules=URL_RULES):
    return next(iter(judged(spark, [(1, url, None)], rules).values()))


def test_rules(spark):
    cases = {
        "http://Example.COM/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/1?x=/fr/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "https://a.net/es/x#y": ("a.net", "/es/x", "net/es/", "block"),
        "https://a.net/espresso": ("a.net", "/espresso", None, "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://example.com?q=://b.net/es/": ("example.com", "", None, "allow"),
    }
    for url, want in cases.items():
        got = one(spark, url)
        assert (got["host"], got["path"], got["rule"], got["verdict"]) == want, url


def test_equally_long_rules(spark):
    rules = [Rule("allow", "a.org/xy/"), Rule("block", "ba.org/x/")]
    assert one(spark, "http://ba.org/x/1", rules)["verdict"] == "block"
    assert one(spark, "http://ba.org/x/1", [])["rule"] is None


def test_block_reaches_aliases_and_allow_wins(spark):
    link = '<html><head><LINK rel="canonical" href="{}"></head>'
    meta = "<meta content='0; URL={}' http-equiv='Refresh'>"
    pages = [
        (1, "http://a.org/1", link.format("http://b.org/2")),  # a chain to a blocked page
        (2, "http://b.org/2", meta.format("https://c.net/es/3")),
        (3, "http://c.net/es/3", ""),
        (4, "http://d.org/4#part", link.format("http://x.net/fr/1")),  # blocked and allowed alias
        (5, "https://d.org/4", link.format("http://y.com/ok")),
        (6, "http://e.com/5", link.format("http://x.net/fr/9")),  # an allowed member passes that on
        (7, "http://f.org/6", link.format("/7")),  # aliases without any rule
        (8, "http://g.org/8", None),
        (9, "http://h.org/9", link.format("../x") + link.format("//i.net/es/q")),
        (1, "http://a.org/1", link.format("http://b.org/2")),  # repeated row
    ]
    got = [(r["page_id"], r["verdict"], r["passed_on"]) for r in judged(spark, pages).values()]
    assert got == [
        (1, "block", "block"),
        (1, "block", "block"),
        (2, "block", "block"),
        (3, "block", "block"),
        (4, "allow", "allow"),
        (5, "allow", "allow"),
        (6, "allow", "allow"),
        (7, "allow", None),
        (8, "allow", None),
        (9, "block", "block"),
    ]


def test_long_chain_hub_and_empty_table(spark):
    link = '<link href="{}" rel=canonical>'
    chain = [(i, f"http://n.org/{i}", link.format(f"http://n.org/{i + 1}")) for i in range(60)]
    hub = [(100 + i, f"http://m{i}.org/", link.format("http://z.net/fr/hub")) for i in range(200)]
    pages = chain + [(60, "http://n.org/60", link.format("http://k.net/es/end"))] + hub
    assert {r["verdict"] for r in judged(spark, pages).values()} == {"block"}
    assert judged(spark, []) == {}


def test_relative_links(spark):
    page = "http://S.org/a/b?q"
    html = "".join(f'<link rel="canonical" href="{h}">' for h in ("c", "/d", "?e", "#f", "//t.org", "HTTP://U.org/%20", "g?x=1&amp;y=2"))
    df = spark.createDataFrame([(1, page, html, "")], PAGES)
    assert {r["target"] for r in rows(alias_edges(df))} == {
        "s.org/a/c", "s.org/d", "s.org/a/b?e", "t.org/", "u.org/%20", "s.org/a/g?x=1&y=2",
    }


def test_sql_agrees_on_links(spark, tmp_path):
    link = '<link rel="canonical" href="{}">'
    hrefs = ("c", "/d", "?e", "#f", "//t.net/es/1", "HTTP://U.net/fr/%20", "http://b.org/2", "")
    pages = [(i, f"http://a{i}.org/p/{i}?q", link.format(h), "") for i, h in enumerate(hrefs)]
    pages += [(50, "http://b.org/2", "<meta http-equiv=refresh content='0;url=http://v.net/es/9'>", ""), (51, None, None, ""), (52, "x", "", "")]
    df = spark.createDataFrame(pages, PAGES)
    df.toPandas().to_parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    assert compare(judge_pages(df, URL_RULES), con, url_filters_sql(URL_RULES)) == []


def test_dot_segments_and_base(spark):
    link = '<link rel=canonical href="{}">'
    pages = [
        (1, "http://a.net/x/y/1", link.format("../../es/2")),
        (2, "http://b.org/p/../q", ""),
        (3, "http://c.net/es/3", link.format("http://b.org/./q")),
        (4, "http://d.org/x/y", '<base target=_blank><base href="//e.net/fr/z/">' + link.format("./4")),
        (5, "http://f.org/5", "<base href='data:x'><meta http-equiv=refresh content='0; url=/../g/..'>"),
    ]
    df = spark.createDataFrame([(*p, "") for p in pages], PAGES)
    assert {(r["source"], r["target"]) for r in rows(alias_edges(df))} == {
        ("a.net/x/y/1", "a.net/es/2"), ("c.net/es/3", "b.org/q"), ("d.org/x/y", "e.net/fr/z/4"), ("f.org/5", "f.org/"),
    }
    got = {r["page_id"]: r["verdict"] for r in judged(spark, pages).values()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}
