"""Main text of small pages, what style trees find, and the given pages against their plain shape."""

import html
import random
import re
from pathlib import Path

import pytest

from emberlink.llm import html_text as ht

SF = "/root/testdata/sf0.001"

CASES = [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"), ("<article><h1>T</h1><p><b>x<br>y</b> z</article>", "T\nx y z"),
    ("<nav>m</nav><main><p>k &amp;&lt; &copy;&eacute; &#65;&#x42; &am</p></main><footer>f</footer>", "k &< ©é AB &am"),
    ("<body><div class='site-header'>h</div><article>a<div class=\"comments\">c</div><aside>s</aside><form>f</form>b</article>t</body>", "a\nb"),
    ("<article><p>one<script>var a='</p>';</script> two<style>x{}</style></p><!-- no <p>no</p> --><p>three</article>", "one two\nthree"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<ARTICLE><P CLASS=ad>x</P><P data-class='ad'>y</P><p id='cookie-bar'>z</p></ARTICLE>", "y"),
    ("<article><p>white \n\t space&nbsp;here</p><p> </p><p>wor<i>d</i>s</p>", "white space here\nwords"),
    ("<article><p title='a > b'>q</p><p title=\"x>r</p><p>s</p>", "q\nr\ns"),
    ("<div role=navigation>n</div><div role=main><p>m</p></div>", "m"),
    ("<article><header><h1>Head</h1></header><p>x</p></article>", "Head\nx"),
    ("<title>t</title><p>x</p><textarea>no</textarea><noscript>no</noscript>", "x"),
    ("<article class='post'><p>p</p></article><article class='comment'><p>c</p></article>", "p"),
    ("<p>unclosed <!-- comment", "unclosed"), ("<script>never closed <p>x", ""), ("a < b and c > d", "a < b and c > d"), ("</p></div>x</b>", "x"),
    ("<article><![CDATA[a<b]]></article>", "a<b"), ("<?xml v?><!doctype html><p>x", "x"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_main_text(source, want):
    assert ht.main_text(source) == want


NAMED = [
    ("<body class='has-sidebar right-sidebar'><p>x</p></body>", "x"), ("<body class='sidebar'><article>x</article></body>", "x"), ("<html id=widget><p>x", "x"),
    ("<article class='post sponsored'><section id='social-effects'><h2 id='related-work'>h</h2><p id=comments-on-the-method>p</p></section></article>", "h\np"),
    ("<article><h2 id=comments>h</h2><section id=share><p>p</p></section><section class=share>s</section></article>", "h\np"),
    ("<form id=f><div>menu</div><fieldset><article><p>x</p><form>f</form></article></fieldset></form>", "x"), ("<form>f</form><p>x</p>", "x"),
    ("<div class=widget><form><main>x</main></form></div>", "x"), ("<div class=related><article>r</article></div><article>x</article>", "x"),
    ("<div class=comments><article>c</article></div><p>x</p>", "x"), ("<aside><article>a</article></aside><p>x</p>", "x"),
    ("<div class='box site-footer'>f</div><div class=ad-slot>a</div><div id=cookie_banner>c</div><ul class='social-links'><li>s</ul><p>x</p>", "x"),
]


@pytest.mark.parametrize("source,want", NAMED)
def test_names_are_whole_and_spare_the_article(source, want):
    assert ht.main_text(source) == want


def test_long_pages_take_linear_time():
    for source in ("<div>" * 60_000, "<p>x" * 100_000, "<li>" * 50_000, "<!--" * 50_000, "<a href=\"" * 50_000, "&amp;" * 100_000, "<" * 100_000, "<b>" * 50_000 + "</p>" * 50_000):
        ht.main_text(source)


def _pages(n, host="h.org", seed=1):
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) + str(rng.randrange(1000)) for _ in range(k))
    out = []
    for i in range(n):
        body, own = text(20), text(12)
        out.append((f"http://{host}/{i}", f"<div class=x1>Welcome to us</div><div class=x2><p>{body}</p><div class=x3>Read more soon</div></div><div class=x4>{own}</div>", f"{body}\n{own}"))
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "kept", 1) for i, (u, h, *_) in enumerate(rows)], "page_id long, url string, html string, removed string, HOST int")


@pytest.mark.parametrize("rows", [ht.BROADCAST_ROWS, 0])
def test_style_tree_removes_what_repeats(spark, rows):
    pages = _pages(40)
    got = {r["page_id"]: r["text"] for r in ht.extract(_frame(spark, pages), broadcast_rows=rows).collect()}
    assert [got[i] for i in range(40)] == [want for *_, want in pages]


def test_few_pages_are_not_judged(spark):
    pages = _pages(ht.LEAST_PAGES - 1)
    got = {r["page_id"]: r["text"] for r in ht.extract(_frame(spark, pages)).collect()}
    assert got[0].startswith("Welcome to us\n")


def test_copies_of_an_article_stay(spark):
    rows = [(f"http://h.org/{i}", "<article><p>The same article</p><div class=box>Subscribe now</div></article>" if i < 30 else f"<article><p>Other {i}</p><div class=box>Subscribe now</div></article>") for i in range(40)]
    got = {r["page_id"]: r["text"] for r in ht.extract(_frame(spark, rows)).collect()}
    assert got[0] == "The same article" and got[35] == "Other 35"


def _texts(spark, sources):
    rows = [(f"http://h.org/{i}", s) for i, s in enumerate(sources)]
    return {r["page_id"]: r["text"] for r in ht.extract(_frame(spark, rows)).collect()}


def test_own_articles_of_a_hot_host_stay(spark, monkeypatch):
    # Six looks on a thousand pages weigh here as forty on a million do.
    monkeypatch.setattr(ht, "DECAY", 0.5)
    n = 1000
    sequence = lambda i: "<h3>t</h3>" * (i % 6)
    got = _texts(spark, [f"<div class=x1>Welcome</div><div class=content>{sequence(i)}<p>article {i}</p></div>" for i in range(n)])
    assert all(got[i].endswith(f"article {i}") and "Welcome" not in got[i] for i in range(n))


def test_copies_do_not_empty_the_other_pages(spark):
    got = _texts(spark, [f"<div class=x1>Welcome</div><div class=content><p>{'the article' if i % 5 else f'other {i}'}</p></div>" for i in range(1000)])
    assert all(got[i] == ("the article" if i % 5 else f"other {i}") for i in range(1000))


def test_rare_text_in_a_template_stays(spark):
    # Pages differ, so they are not copies; five of the boxes hold a text of their own, ten an important container.
    inner = lambda i: f"<p>own {i}</p>" if i < 5 else f"<div class=story>story {min(i, 90)}</div>" if i < 100 else "Subscribe"
    got = _texts(spark, [f"<div class=box>{inner(i)}</div><p>page {i}</p>" for i in range(1000)])
    assert got[3] == "own 3\npage 3" and got[20] == "story 20\npage 20" and got[95] == "story 90\npage 95" and got[500] == "page 500"


def test_columns_and_empty_table(spark, tmp_path):
    rows = [(None, "<p>x</p>"), ("no host", None), ("http://a.b/", ""), (None, "<p>x</p>")]
    out = ht.extract(_frame(spark, rows), text_col="body")
    assert out.columns == ["page_id", "url", "html", "removed", "HOST", "body"]
    assert sorted(r["body"] for r in out.collect()) == ["", "", "x", "x"]
    _frame(spark, rows).where("false").write.parquet(str(tmp_path / "pages.parquet"))
    assert ht.op5_main_text(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_given_pages(spark):
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in ht.op5_main_text(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert r["text"] == want and r["n_chars"] == len(want)
