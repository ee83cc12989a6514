"""URL rules and redirect equivalence (the query has a SQL check besides)."""

import re

import pytest
from pyspark.sql import functions as F

from tunedata.llm import urls

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def judged(spark, pages, rules=RULES):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)],
                               "page_id bigint, url string, html string, host string, rule string")
    return {r["page_id"]: tuple(r)[1:] for r in urls.judge(df, rules).collect()}


def test_rules_hosts_and_paths(spark):
    got = judged(spark, [
        ("https://a.Example.NET/en/x?q=1#f", None), ("http://example.net/en", None), ("http://net/", None),
        ("http://fakenet/", None), ("https://x.example.com/de/", None), ("https://example.com/fr/de/", None),
        ("https://b.org/fr/1", None), (None, "<link rel=canonical href='http://a.net/'>"), ("no scheme", None),
        ("https://c.net", None), ("://d.net/p", None), ("https://e.net?x=/", None), ("", "")])
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/en", "net/", "block") and got[2] == ("net", "/", "net/", "block")
    assert got[3] == ("fakenet", "/", None, "allow")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == (None, "allow")
    assert got[6][2:] == ("org/fr/", "allow")
    assert got[7] == ("", "", None, "allow") == got[8] == got[12]
    assert got[9] == ("c.net", "", None, "allow")  # no path, so no rule, and no alias
    assert got[10][:2] == ("d.net", "/p") and got[11] == ("e.net", "", None, "allow")


def test_aliases_share_a_block_and_allow_goes_first(spark):
    got = judged(spark, [
        ("https://c.net", None), ("http://c.net/", None),  # one form: the second is blocked by its rule
        ("https://short.example/a", "<META HTTP-EQUIV=refresh CONTENT='0; url=https://mid.example/b?utm_source=x'>"),
        ("https://mid.example/b#top", '<link href="/c?x=1&amp;y=2" rel="canonical">'),
        ("https://mid.example/c?x=1&y=2", "<link rel='canonical' href='//bad.net/z'>"),
        ("https://other.example/", None),
        ("https://m.example/1", "<link rel=canonical href=https://x.org/fr/2>"),
        ("https://n.example/1", '<link rel="canonical" href="https://m.example/1"><link rel=canonical href="http://q.net/9">'),
        ("https://bad.net/z", None), ("https://rel.example/d/e", '<link rel="canonical" href="f">'),
        ("https://rel.example/d/f", '<link rel="canonical" href="http://q2.net/">'),
        ("https://style.example/", '<link rel="stylesheet" href="http://q3.net/">')])
    verdict = {i: v[3] for i, v in got.items()}
    assert verdict == {0: "block", 1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow",
                       8: "block", 9: "block", 10: "block", 11: "allow"}


def test_long_chains_and_repeated_rows(spark):
    chain = [(f"https://h{i}.example/p", f'<link rel="canonical" href="https://h{i + 1}.example/p">') for i in range(40)]
    chain += [("https://h40.example/p", '<link rel="canonical" href="http://end.net/p">')] + [chain[3]] * 3
    got = judged(spark, chain)
    assert len(got) == len(chain) and {v[3] for v in got.values()} == {"block"}


def test_longest_rule_of_many(spark):
    rules = [("a.b.com/x", "allow"), ("b.com/x/y/zz", "block"), ("com/", "block"), ("a.b.com/", "allow")]
    pages = [f"https://{h}{p}" for h in ("a.b.com", "b.com", "c.com", "xa.b.com", "com") for p in ("/x", "/x/y/zz/1", "/", "")]
    got = judged(spark, [(u, None) for u in pages], rules)
    for i, u in enumerate(pages):
        host, path = re.match(r"https://([^/]*)(.*)", u).groups()
        fits = [r for r, _ in rules for h, p in [(r[:r.index("/")], r[r.index("/"):])]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i][2] == max(fits, key=len, default=None)


def test_canonical_form_and_empty_table(spark):
    df = spark.createDataFrame([("HTTP://Ex.Com/a/?utm_source=f&b=2&ref=q&c#x",), ("https://ex.com",), ("mailto:x",)], "u string")
    assert [r[0] for r in df.select(urls.canonical(F.col("u"))).collect()] == ["https://ex.com/a?b=2&c", "https://ex.com", None]
    assert judged(spark, []) == {}


# Each page links to a blocked url, or looks as if it did.
ODD_LINKS = [
    ("https://c1.example/", '<link rel="alternate canonical" href="https://x.net/1">', "block"),
    ("https://c2.example/", "<link href='https://x.net/2' REL=' Canonical  nofollow '>", "block"),
    ("https://c3.example/a/b", '<link rel="canonical" href="../q">', "block"),
    ("https://c3.example/q", '<link rel="canonical" href="https://x.net/a/./../3">', "block"),
    ("https://c4.example/", '<link title="a > b" rel="canonical" href="https://x.net/4">', "block"),
    ("https://c5.example/", '<!-- <link rel="canonical" href="https://x.net/5"> -->', "allow"),
    ("https://c6.example/", '<!-- open <link rel="canonical" href="https://x.net/6">', "allow"),
    ("https://c7.example/", '<link rel="canonical" href="/r?u=https://x.net/b">', "allow"),
    ("https://c8.example/", '<meta http-equiv="Refresh" content="5;URL=\'https://x.net/8\'">', "block"),
    ("https://c9.example/", '<meta name="d" content="0; url=https://x.net/9">', "allow"),
    ("https://c10.example/", '<link rel="canonically" href="https://x.net/10">', "allow"),
    ("https://c11.example/", '<link data-x="rel=canonical" href="https://x.net/11">', "allow"),
    ("https://c12.example/", '<!--a--><link rel=canonical href=https://x.net/12><!--b-->', "block"),
    ("https://c13.example/", '<link rel="canonical" href="' + "y" * 50_000 + '"><link rel=canonical href=//x.net/13>', "block"),
    ("https://c14.example/", '<linkrel="canonical" href="https://x.net/14">', "allow"),
    ("https://c15.example/", "<link/rel='canonical'/href='https://x.net/15'/>", "block"),
]


def test_odd_links(spark):
    got = judged(spark, [(u, h) for u, h, _ in ODD_LINKS])
    assert {u: got[i][3] for i, (u, _, _) in enumerate(ODD_LINKS)} == {u: v for u, _, v in ODD_LINKS}


def test_odd_links_by_sql(spark):
    import duckdb

    from tunedata.llm import queries
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(i, u, h) for i, (u, h, _) in enumerate(ODD_LINKS)])
    rows = con.execute(queries.oracle_sql()["op4_redirects"]).fetchall()
    assert {r[0]: r[4] for r in rows} == {i: v for i, (_, _, v) in enumerate(ODD_LINKS)}


def test_tags_of_many_quotes(spark):
    """A tag of many attributes neither ends the regular expression's stack nor takes long."""
    html = "<link " + 'a="1" ' * 100_000 + 'rel="canonical" href="https://x.net/">'
    assert judged(spark, [("https://m.example/", html + "<link " * 20_000)])[0][3] == "block"


@pytest.mark.parametrize("link,want", [("../x/./y?p=/../q#/..", "https://h/x/y?p=/../q#/.."), ("..", "https://h/"),
                                       ("../../../z/", "https://h/z/"), (".", "https://h/a/"), ("/c/..", "https://h/"),
                                       ("https://k/a/../b", "https://k/b"), ("/r?u=http://k/x", "https://h/r?u=http://k/x"),
                                       ("x", "https://h/a/x"), ("/x", "https://h/x"), ("//k/x", "https://k/x"),
                                       ("?q", "https://h/a/b?q"), ("#f", "https://h/a/b"), ("ftp://z/", "ftp://z/")])
def test_resolve(spark, link, want):
    df = spark.createDataFrame([("https://h/a/b", link)], "b string, l string")
    assert df.select(urls.resolve(F.col("b"), F.col("l"))).first()[0] == want
