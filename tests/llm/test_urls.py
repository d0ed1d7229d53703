"""Rules and aliases against a plain version."""

import re

import pytest

from emberlink.llm import urls

PAGES = [
    ("http://www.Example.COM/en/1?x=1#y", None), ("https://m.example.com/en/2", ""), ("http://example.com/EN/2", None), ("http://example.com", "x"),
    ("http://a.net/es/1", None), ("http://a.net/es", None), ("http://net/fr/x", None), ("http://xnet/fr/x", None), ("http://b.org?q=http://c.net/fr/", None),
    (None, "<link rel=canonical href=http://a.net/fr/9>"), ("no scheme.net/fr/", None), ("", None), ("://net/es/\n1", None), ("ftp://A.NET/fr/#net", None),
    # aliases: org pages know no rule
    ("http://one.org/a", '<link rel="canonical" href="http://x.net/fr/7">'), ("http://two.org/b", "<LINK href='http://one.org/a?u=1' data-x=1 rel='canonical'>"),
    ("http://three.org/c", '<meta http-equiv="refresh" content="0; URL=\'http://two.org/b#z\'">'), ("http://four.org/d", '<meta http-equiv=Refresh content="5">'),
    ("http://five.org/e", '<link rel="canonical" href="http://y.net/es/1"><meta http-equiv="refresh" content="0;url=http://fine.com/">'),
    ("http://six.com/s", '<link rel="canonical" href="http://y.net/es/2">'), ("http://seven.org/p/q", '<link rel="canonical" href="../z">'),
    ("http://eight.net/es/r", '<link rel="canonical" href="/s">'), ("http://eight.net/s", None), ("http://eight.net/es/t", '<link rel="canonical" href="//nine.org/n">'),
    ("https://nine.org/n", None), ("http://ten.org/", '<link rel="stylesheet" href="http://x.net/fr/7">'), ("http://ten.org/j", '<link rel=canonical href="javascript:x">'),
    ("http://one.org/a", None),
]


def _split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def _rule(host, path):
    fitting = [
        (len(text), text, kind) for kind, text in urls.RULES for domain, _, rest in [text.partition("/")]
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest)
    ]
    return max(fitting)[1:] if fitting else (None, None)


BLOCKED_ALIASES = {"one.org/a", "two.org/b", "three.org/c", "eight.net/s", "nine.org/n"}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h, "kept", "x") for i, (u, h) in enumerate(PAGES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, HIT string, rule string")


def test_verdicts(spark, pages, tmp_path):
    pages.repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r for r in urls.op6_url_verdicts(spark, str(tmp_path)).collect()}
    assert len(got) == len(PAGES)
    for i, (url, _) in enumerate(PAGES):
        host, path = _split(url)
        rule, kind = _rule(host, path)
        want = kind or ("block" if host + path in BLOCKED_ALIASES else "allow")
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, want), url


def test_columns_and_empty_table(pages):
    judged = urls.judge(pages)
    assert judged.columns == ["page_id", "url", "HIT", "host", "path", "rule", "verdict"]
    assert {r["HIT"] for r in judged.collect()} == {"kept"}
    assert urls.judge(pages.where("false")).count() == 0


def test_edges(pages):
    got = {(r["a"], r["b"]) for r in urls.page_edges(pages).collect() if r["b"]}
    assert ("two.org/b", "one.org/a") in got and ("three.org/c", "two.org/b") in got
    assert ("eight.net/es/t", "nine.org/n") in got and ("seven.org/p/q", "seven.org/p/../z") in got
    assert not any(a.startswith(("ten.org", "four.org")) for a, _ in got)


def test_many_aliases_of_one_page(spark):
    rows = [(i, f"http://a{i}.org/x", '<link rel=canonical href="http://hub.org/">') for i in range(400)]
    rows += [(400, "http://hub.org/", '<meta http-equiv=refresh content="0;url=http://bad.net/fr/">')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["verdict"] for r in urls.judge(df).collect()} == {"block"}
