import re

import pytest

from tallyworks.llm import urls

PAGES = "page_id long, url string, html string, host string"
RULES = "host string, path string, action string"


def parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = found[1].translate({c: c + 32 for c in range(65, 91)}) if found else ""
    return host, found[2] if found else ""


def rule_by_hand(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0] + r[1]), r[2] == "allow"), default=None)


RULE_ROWS = [("com", "/", "allow"), ("a.com", "/x/", "block"), ("b.a.com", "/x/", "allow"), ("net", "", "block"),
             ("org", "/bad", "block"), ("org", "/bad", "allow")]
URLS = ["http://a.com/x/1", "https://B.A.com/x/1?y#z", "http://c.a.com/x", "http://xa.com/x/", "ftp://net", "http://q.NET?x",
        "http://net.org/bad/x", "http://é.org/ok", "no scheme", "", None, "://", "http:///x", "http://a.com/\n/x/ ://b", "a://b://c/d"]


def test_parts_and_rules_equal_brute_force(frame):
    df = frame([(i, u, None, "clash") for i, u in enumerate(URLS)] + [(0, URLS[0], None, "clash")], PAGES)
    got = urls.filter_pages(df, frame(RULE_ROWS, RULES)).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        rule = rule_by_hand(r.url, RULE_ROWS)
        assert (r.host, r.path) == parts(r.url), r
        assert r.rule == (rule[0] + rule[1] if rule else None), r
        assert r.verdict == (rule[2] if rule else "allow"), r


def linked(target, kind="canonical"):
    if kind == "canonical":
        return f'<head><link href="{target}" rel="canonical"></head>'
    return f"<META http-equiv='refresh' content='0; url={target}'>"


def test_block_spreads_to_aliases_but_allow_goes_first(frame):
    pages = [
        (1, "http://spam.net/1", None), (2, "http://one.org/", linked("https://spam.net/1#x")),
        (3, "http://two.org", linked("http://one.org", "refresh")), (4, "http://free.org/", linked("http://a.com/x/9")),
        (5, "http://a.com/x/9", None), (6, "http://b.a.com/x/9", linked("http://a.com/x/9")), (7, "http://far.org/p?utm_a=1", None),
        (8, "https://far.org/p/?ref=x#f", None), (9, "http://clean.org", linked("http://else.org/p?q=1")), (10, None, linked("http://net")),
        (11, "http://allowed.com/", linked("https://spam.net/1")),
    ]
    redirects = frame([("http://far.org/p", "http://moved.net/"), (None, "http://x.net"), ("http://hop.org", None)], "source string, target string")
    df = frame([(*p, "h") for p in pages] + [(12, "http://moved.net/", None, "h")], PAGES)
    got = {r.page_id: r for r in urls.filter_pages(df, frame(RULE_ROWS, RULES), redirects).collect()}
    verdicts = {i: r.verdict for i, r in got.items()}
    # page 11 is allowed and in the component of 1, 2 and 3: explicit allow goes first for 2 and 3
    assert verdicts == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "block", 6: "allow", 7: "block", 8: "block",
                        9: "allow", 10: "allow", 11: "allow", 12: "block"}
    fewer = df.where("page_id <> 11 and page_id <> 6")
    again = {r.page_id: r.verdict for r in urls.filter_pages(fewer, frame(RULE_ROWS, RULES), redirects).collect()}
    assert again == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 7: "block", 8: "block", 9: "allow",
                     10: "allow", 12: "block"}
    assert got[1].alias_of == got[3].alias_of and got[9].alias_of == "clean.org"


@pytest.mark.parametrize("pages, rules", [([], RULE_ROWS), ([(1, "http://net/", None, "")], [])])
def test_empty_tables(frame, pages, rules):
    got = urls.filter_pages(frame(pages, PAGES), frame(rules, RULES)).collect()
    assert [r.verdict for r in got] == ["allow"] * len(pages)


def test_no_python(frame):
    df = urls.filter_pages(frame([(1, "http://net/", None, "")], PAGES), frame(RULE_ROWS, RULES))
    assert "Python" not in df._jdf.queryExecution().toString()


BASE = "https://h.org:8/a/b?q=1#f"
LINKS = ["http://x.org/p", "//x.org/p", "/en/7817", "page2", "../up", "./c/./d/../e", "?p=2", "", "#g", "mailto:a@b.c", "HTTPS://X.org",
         "../../../far", "p?a=/../b", "..", "/a:b"]


def test_links_are_resolved_against_the_page(frame):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    df = frame([(x, BASE) for x in LINKS] + [("p", "http://h.org")], "link string, base string")
    for r in df.withColumn("to", urls.resolved(F.col("link"), F.col("base"))).collect():
        wanted = "" if r.link in ("", "mailto:a@b.c") else urljoin(r.base, r.link)
        if r.link == "HTTPS://X.org":
            wanted = r.link
        assert r.to == wanted, r
    assert df.limit(1).select(urls.resolved(F.lit("/x"), F.lit(None).cast("string"))).first()[0] == ""


@pytest.mark.parametrize("page", [
    '<link rel="canonical" href="/1?a=1&amp;b=2">', "<link href='1?a=1&#38;b=2' rel = 'canonical' >", "<LINK REL=canonical HREF=//spam.net/1?a=1&b=2>",
    "<meta http-equiv = refresh content='0; url=/1?a=1&amp;b=2'>", '<meta http-equiv="refresh" content="0;URL=\'1?a=1&b=2\'">',
    '<link rel="canonical" href = " https://spam.net/1?a=1&amp;b=2 ">',
])
def test_written_links_join_their_page(frame, page):
    rules = [("spam.net", "/1", "block")]
    df = frame([(1, "http://spam.net/alias", page, "h"), (2, "http://spam.net/1?a=1&b=2", None, "h"), (3, "http://spam.net/2", page[:20], "h")], PAGES)
    got = {r.page_id: r.verdict for r in urls.filter_pages(df, frame(rules, RULES)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}
