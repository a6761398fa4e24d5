"""Main text of pages: hand-written pages, a site's templates, odd markup."""

import pytest

from scoreloom.llm import pages

DDL = "page_id long, url string, html string, text string, host int"
LOREM = ["Words of page %d make up a paragraph that is longer than all else, since it says %s." % (k, "so again and again " * (k % 7 + 3)) for k in range(40)]


def text(html, host="h", template=()):
    return pages.Page(html, host).text(set(template))


@pytest.mark.parametrize(("html", "want"), [
    ("", ""),
    ("plain &amp; simple\n text", "plain & simple text"),
    ("<p>a<b>b</b>c<br>d<p> <p>e&eacute;&#233;&#x41;&nbsp;f&unknown;", "abc d\n\neééA f&unknown;"),
    ("<html><head><title>T</title><style>p{}</style><body><header>H</header><article><header><h1>A &lt;b&gt;</h1></header><p>x</p>"
     "<section class='comments'><article><p>c</p></article></section><aside>s</aside><form>f</form><footer>g</footer></article>out", "A <b>\n\nx"),
    ("<article><p>one<script>var t='</p><p>two';</script>three</p><!-- <p>no</p> --><noscript>n</noscript></article>", "onethree"),
    ("<article><ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\n\nb\n\nc\n\n1\n\n2\n\n3"),
    ("<div class='main-nav'>n</div><div class=ad>a</div><div id=cookieNotice>c</div><div class='no-sidebar'><p>x<span class=promo>y</span></div>", "x"),
    ("<div role=main><p>m</p></div><p>o</p>", "m"),
    ("<div role='navigation'>n</div><main><div class='post'>a<div>b</div>c</div></main>", "a\n\nb\n\nc"),
    ("<p>kept</b></i></div></p>more", "kept\n\nmore"),
    ("<p>a<!-- no end <p>b", "a"), ("<p>a<script>b", "a"), ("<p>a<b title='no end", "a"), ("<p>1 < 2 <3 &amp", "1 < 2 <3 &"),
    ("<P CLASS=\"x\">Upper</P><IMG SRC=a.png ALT='q>r'><p>z", "Upper\n\nz"),
    ("<article></article><p>not in it", ""),
])
def test_markup(html, want):
    assert text(html) == want


def test_long_and_deep():
    assert text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert text("<p>" + "word " * 400_000).count("word") == 400_000
    assert text("<!--" * 50_000) == "" and text("</p>" * 50_000 + "a") == "a" and text("<a '" * 50_000) == ""


def rows():
    """A site without articles: a menu and a note that no name gives away, one passage that a third of all pages quote."""
    out = []
    for k in range(30):
        quote = "<p>A passage that is quoted.</p>" if k % 3 == 0 else ""
        out.append((k, f"https://Site.example/{k}", f"<html><body><div><ul><li>Home</li><li>News</li></ul></div><div><h1>Title {k}</h1>"
                    f"<p>{LOREM[k]}</p>{quote}<p>End {k}.</p></div><p>All rights reserved.</p><div><span>Written with care</span></div></body></html>"))
    wanted = {k: "\n\n".join([f"Title {k}", LOREM[k], *(["A passage that is quoted."] if k % 3 == 0 else []), f"End {k}."]) for k in range(30)}
    article = "<article><div><p>Same story on all copies, long enough to be the longest block.</p><ul><li>a</li></ul></div></article>"
    for k in range(100, 120):  # copies of a page are no template
        out.append((k, "http://copies.example/x?y", article))
        wanted[k] = "Same story on all copies, long enough to be the longest block.\n\na"
    for k in range(200, 210):  # a box inside each article
        out.append((k, f"//odd/{k}" if k == 209 else f"http://box.example#{k}", f"<article><p>{LOREM[k - 190]}</p><div><p>Our letter</p><p>Get it</p></div></article>"))
        wanted[k] = LOREM[k - 190] + ("\n\nOur letter\n\nGet it" if k == 209 else "")
    out += [(300, None, "<p>no url</p>"), (301, "http://site.example/a", None), (302, "", ""), (303, "x", "<p>x"), (303, "x", "<p>x"), (None, None, None)]
    return out, wanted | {300: "no url", 301: "", 302: "", 303: "x", None: ""}


@pytest.mark.parametrize("shared", [True, False])
def test_templates_of_a_site(spark, shared, monkeypatch):
    if not shared:
        monkeypatch.setattr(pages, "MOST_KEYS", 0)
    given, wanted = rows()
    found = pages.main_text(spark.createDataFrame([(*r, "clash", 1) for r in given], DDL).repartition(4))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert sorted(map(str, ((r.page_id, r.url) for r in got))) == sorted(map(str, ((r[0], r[1]) for r in given)))
    for r in got:
        assert (r.page_id, r.text, r.n_chars) == (r.page_id, wanted[r.page_id], len(wanted[r.page_id]))


def test_empty(spark):
    assert pages.main_text(spark.createDataFrame([], DDL)).collect() == []
