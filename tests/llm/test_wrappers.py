"""Wrappers: what the inference generalises, and the articles that it reads."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quoteloom.llm import markup, wrappers
from quoteloom.llm.wrappers import Field, Reader, align, expression

NOISE = (
    '<header><a href="/">Site name</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>'
    '<div class="cookie-notice">We use cookies.</div><aside><p>Side text</p></aside>'
)
TAIL = (
    '<section id="comments"><article class="comment"><p>Nice read!</p></article></section>'
    '<form action="/s"><p>Your mail</p><input name=q></form><footer><p>&copy; someone</p></footer>'
)


def page(body, head=NOISE, tail=TAIL):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{head}{body}{tail}</body></html>"


def inferred(pages):
    wrapper = Field()
    for html in pages:
        align(wrapper, markup.tokens(html))
    return wrapper


def read(pages, html=None):
    reader = Reader(inferred(pages))
    return [reader.read(markup.tokens(h)) for h in ([html] if html is not None else pages)]


def test_expression():
    pages = [
        "<body><div><h1>a</h1><p>x</div>",
        "<body><div><h1>b</h1><p>y<p>z<ul><li>1<li>2</ul></div>",
        "<body><div><h1>b</h1><h2>s</h2><p>y</p><p>q</p><h2>t</h2><p>z</p></div><table><tr><td>1<td>2<tr><td>3</table>",
    ]
    want = "body(div(h1(#) (h2(#)? p(#)?)+ ul(li(#)+)?) table(tr(td(#)+)+)?)"
    assert expression(inferred(pages)) == want
    for order in ([1, 0, 2], [2, 1, 0], [2, 0, 1]):
        assert expression(inferred([pages[k] for k in order])) == want


def test_parts_merge_to_the_whole():
    rng = random.Random(4)
    bits = ["<h2>x</h2>", "<p>y</p>", "<ul><li>z</ul>", "<blockquote>q</blockquote>", "<p class=lead>l</p>"]
    pages = [f"<body><main>{''.join(rng.choices(bits, k=rng.randint(0, 9)))}</main>" for _ in range(60)]
    whole = inferred(pages)
    parts = [inferred(pages[k::7]) for k in range(7)]
    rng.shuffle(parts)
    merged = Field()
    for part in parts:
        merged.merge(Field.unpacked(json.loads(json.dumps(part.packed()))))
    assert expression(merged) == expression(whole)
    assert (merged.times, merged.size()) == (60, whole.size())
    assert wrappers.article_paths(merged) == wrappers.article_paths(whole)


ARTICLES = [
    ("<article><h1>A &amp; B</h1><p>One <b>bold</b>ly&nbsp;said,\n two.</p><p>Three<br>four</p></article>", ["A & B", "One boldly said, two.", "Three four"]),
    ("<article><h1>T</h1><p><b>Unclosed<br><p>Next</article>", ["T", "Unclosed", "Next"]),
    ("<main><h1>T</h1><div class='ad'>Buy</div><p>Text <a href=x>with a link</a> in it.</p><script>var t='</p>';</script></main>", ["T", "Text with a link in it."]),
    ("<article><header><h1>Title</h1></header><p>Body</p><aside>Related</aside><div class=share-buttons>Tweet</div></article>", ["Title", "Body"]),
    ("<article><h1>L</h1><ul><li>one<li>two <ol><li>deep</ol></ul><table><tr><td>a<td>b</table><pre>x   y\nz</pre></article>", ["L", "one", "two", "deep", "a", "b", "x y z"]),
    ("<article><p>1 &lt; 2 &#38; 3 &#x3e; 2</p><p hidden>no</p><p style='display: none'>no</p><!-- no --><p>a<!-- x -->b</p></article>", ["1 < 2 & 3 > 2", "ab"]),
    ("<div itemprop=articleBody><p>Named by property</p></div>", ["Named by property"]),
    ("<article><p>Before<button>Press</button><span class=advert>Buy</span> after</p></article>", ["Before after"]),
]


@pytest.mark.parametrize("body,want", ARTICLES)
def test_article(body, want):
    assert read([page(body)]) == [want]
    assert read([page(body)] + [page("<article><p>Another page</p></article>")] * 3, page(body)) == [want]


def test_page_without_names():
    """Three boxes without any class: menu, text, template line."""
    rng = random.Random(9)
    words = "river stone walking quietly towards evening light under trees".split()

    def story(k):
        return [" ".join(rng.choices(words, k=30)) + f" {k}{j}." for j in range(4)]

    stories = [story(k) for k in range(8)]
    pages = [
        page(
            "<table><tr><td><a href=/>Home</a><br><a href=/x>News</a></td><td>"
            + "".join(f"<p>{p}</p>" for p in s) + "</td></tr></table><p>All rights reserved by the owner.</p>", "", "",
        )
        for s in stories
    ]
    assert read(pages) == stories


def test_shared_lines_stay():
    """What many articles hold is still article text."""
    pages = [page(f"<article><h1>Same title</h1><p>The same passage everywhere.</p><p>Own {k}</p></article>") for k in range(10)]
    assert read(pages) == [["Same title", "The same passage everywhere.", f"Own {k}"] for k in range(10)]
    same = [page("<article><h1>T</h1><p>Copy</p></article>")] * 6
    assert read(same) == [["T", "Copy"]] * 6


def test_page_of_another_kind():
    """A host's page without the field that its other pages have."""
    usual = [page(f"<article><p>Text {k}</p></article>") for k in range(5)]
    assert read(usual, page("<div><p>Only this</p></div>")) == [["Only this"]]


def test_broken_markup():
    for html in ("", "   ", "<", "<p", "<p class='x", "a < b", "</p></div>", "<!-- open", "<script>alone", "<a title='>' href=\"x>y\">t</a>", "<p>" * 50_000 + "x"):
        assert isinstance(markup.tokens(html), list)
        balance = 0
        for token in markup.tokens(html):
            balance += {markup.OPEN: 1, markup.CLOSE: -1}.get(token[0], 0)
            assert 0 <= balance <= markup.MAX_DEPTH
        assert balance == 0
    deep = "<div>" * 20_000 + "bottom" + "</div>" * 20_000
    assert [t[1] for t in markup.tokens(deep) if t[0] == markup.TEXT] == ["bottom"]
    assert read([page(f"<article>{deep}</article>")]) == [["bottom"]]
    assert [t[1] for t in markup.tokens("a < b and c > d<p>x<y>z") if t[0] == markup.TEXT] == ["a < b and c > d", "xz"]


def test_many_labels_stay_bounded():
    wrapper = inferred(f"<body><div class='{chr(97 + k % 26) * (1 + k // 26)}'>t{k}</div>" for k in range(600))
    assert len(wrapper.kids["body"].kids) <= wrappers.SAME_ELEMENT + 1


def test_extract(spark):
    body = "<article><h1>Title {0}</h1><p>Text {0}</p></article>"
    rows = [(k, f"http://hot.example/{k}", page(body.format(k)), "x", 1) for k in range(150)]
    rows += [(200 + k, f"https://u:p@H{k}.example:80?q=1", page(body.format(k)), "x", 1) for k in range(10)]
    rows += [(300, None, page(body.format(1)), "x", 1), (301, "no address", None, "x", 1), (302, "//h1.example/x", "", "x", 1), (None, "http://hot.example/7", page(body.format(7)), "x", 1)]
    rows += [rows[0], rows[0], (303, "http://long.example", page(f"<article><p>{'word ' * 100_000}</p></article>"), "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt int").repartition(5)
    found = wrappers.extract(pages, cell_pages=16)
    assert found.columns == ["page_id", "url", "text"]
    got = sorted((tuple(r) for r in found.collect()), key=str)

    def want(page_id, url, html):
        text = "\n".join(f"{w} {html.split('Title ')[1].split('<')[0]}" for w in ("Title", "Text")) if html and "Title" in html else ""
        return page_id, url, text

    expected = [want(*r[:3]) if r[0] != 303 else (303, r[1], ("word " * 100_000).strip()) for r in rows]
    assert got == sorted(expected, key=str)
    hosts = wrappers.infer(pages)
    assert hosts.where("host = 'hot.example'").collect()[0].pages == 153
    assert {r.host for r in hosts.collect()} >= {"", "h1.example", "h9.example"}
    assert hosts.select(F.countDistinct("host") == F.count("*")).first()[0]
    assert wrappers.extract(pages.limit(0)).count() == 0
