import random

import pytest

from pergamon.llm.html_text import Page, main_texts

ARTICLE = "<h1>Head</h1><p>First <b>bold</b> &amp; more&nbsp;text that is long enough.</p><p>Second<br>line, with a comma.</p>"
TEXT = "Head\nFirst bold & more text that is long enough.\nSecond line, with a comma."
CHROME = ("<nav><ul><li><a href='/a'>menu</a></li></ul></nav><header>site name</header>", "<footer>&copy; 2020</footer>")


@pytest.mark.parametrize("html, text", [
    (f"<html><body>{CHROME[0]}<article>{ARTICLE}</article>{CHROME[1]}</body></html>", TEXT),
    (f"<body>{CHROME[0]}<div class='post-12'>{ARTICLE}</div><div class=sidebar><p>{'side ' * 90}</p></div>{CHROME[1]}", TEXT),
    (f"<article>{ARTICLE}<div class='comments'><p>I disagree with all of it.</p></div><aside>ad</aside></article>", TEXT),
    (f"<article>{ARTICLE}<script>var a = '<p>no</p>';</script><style>p{{}}</style><form><p>mail?</p></form></article>", TEXT),
    (f"<div class='ad'>never closed <article>{ARTICLE}</article>", TEXT),
    (f"<article>{ARTICLE}<!-- <p>hidden</p> --><p style='display: none'>x</p><p hidden>y</p>", TEXT),
    (f"<ARTICLE CLASS=a>{ARTICLE.upper()}</ARTICLE>".replace("&AMP;", "&amp;").replace("&NBSP;", "&nbsp;"), TEXT.upper()),
    (f"<main><div><div>{ARTICLE}</div></div></main>", TEXT),
    ("", ""), ("   ", ""), ("plain text,\n no tags", "plain text, no tags"), ("<p>one<p>two", "one\ntwo"),
    ("<article><p>a &lt;b&gt; &amp;amp; &#233;&#x41; 1 < 2</p></article>", "a <b> &amp; éA 1 < 2"),
    ("<article><ul><li>x</li><li>y <i>z</i></li></ul><table><tr><td>1</td><td>2</td></tr></table></article>", "x\ny z\n1\n2"),
    ("<article><p>it<i>al</i>ic</p></article><article><p>next</p></article>", "italic\nnext"),
    ("<article></div></p><p>stray</span> ends</article>", "stray ends"),
    ("<article><div class='post-header'><h1>T</h1></div><h2 id='search-algorithms'>A</h2><p id='notice'>B</p>"
     "<h2 id=header-files>C</h2><section id='related-work'><p>D</p></section><div id='social-history'>E</div></article>",
     "T\nA\nB\nC\nD\nE"),
    ("<article><p>A</p><div id='cookie-notice'>x</div><div id=site-footer>x</div><div class='js-cookie-wall'>x</div><p class=ad>x</p>"
     "<ul class='nav-links'><li>x</li></ul><div class='post-comments'>x</div><div id='comments'>x</div><div role=banner>x</div></article>", "A"),
])
def test_text_of_one_page(html, text):
    page = Page(html)
    votes = page.votes()
    best = min(votes, key=lambda p: (-votes[p], p)) if votes else None
    assert page.text(best) == text


def test_long_and_deep_pages_take_linear_time():
    assert Page("<div>" * 3_000 + "x" + "</div>" * 3_000).text(None) == "x"
    assert len(Page("<article>" + "<p><b>word</b>" * 60_000).text("article")) == 60_000 * 5 - 1
    Page("<" * 100_000), Page("<a " * 30_000), Page("<a href='" * 10_000), Page("<!--" * 50_000)


def test_a_host_agrees_on_a_path(spark):
    good = f"<body><div class='c3'><p>{'boiler plate, ' * 3}</p></div><div class='post p7'>{ARTICLE}</div></body>"
    odd = f"<body><div class='c4'><p>{'much longer here, ' * 40}</p></div><div class='post p8'>{ARTICLE}</div></body>"
    rows = [(i, f"https://A.example.com/{i}", good) for i in range(9)] + [
        (9, "http://a.EXAMPLE.com/odd", odd), (10, None, None), (11, "no host", ""), (11, "no host", ""),
        (12, "http://b.org", "<article><p>own path</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as path")
    for limit in (None, -1):
        with pytest.MonkeyPatch.context() as patch:
            if limit:
                patch.setattr("pergamon.llm.html_text.BROADCAST_BYTES", limit)
            found = main_texts(pages).collect()
        assert len(found) == len(rows)
        text = {r.page_id: r.text for r in found}
        assert {text[i] for i in range(10)} == {TEXT} and text[10] == text[11] == "" and text[12] == "own path"
        assert all(r.n_chars == len(r.text) for r in found)
    assert main_texts(pages.limit(0)).count() == 0


def _template(rng):
    """A page builder of one host: (article blocks, page number) -> html, with the article split over containers."""
    split = rng.choice(["one", "intro", "head", "deep"])
    wrap, inner = rng.choice(["content", "post", "c12 w-1/2", "story"]), rng.choice(["text", "body", "copy x9"])
    boiler = "".join(f"<div class='b{k}'><p>{'words of the site ' * rng.randint(1, 3)}{k}</p></div>" for k in range(rng.randint(0, 2)))
    slug = rng.choice(["", " id='search-results'", " id='header-files'", " id='notice'"])
    end = "<div class='sidebar'><p>side</p></div><div class='comment-list'><p>I object to it.</p></div><footer>end</footer>"

    def page(blocks):
        head, intro, *rest = blocks
        rest = "".join(f"<p{slug}>{b}</p>" for b in rest)
        body = {
            "one": f"<div class='{wrap}'><h1{slug}>{head}</h1><p>{intro}</p>{rest}</div>",
            "intro": f"<div class='{wrap}'><h1>{head}</h1><div class='intro'><p>{intro}</p></div><div class='{inner}'>{rest}</div></div>",
            "head": f"<div class='{wrap}'><div class='post-header'><h1>{head}</h1></div><div class='{inner}'><p>{intro}</p>{rest}</div></div>",
            "deep": f"<div class=p><div class='{wrap}'><h1>{head}</h1><div class='{inner}'><div class=z><p>{intro}</p>{rest}</div></div></div></div>",
        }[split]
        return f"<html><body><nav><a href=/>home</a></nav>{boiler}{body}{end}</body></html>"

    return page


def test_whole_articles_of_generated_hosts(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, wanted = [], {}
    for host in range(40):
        page = _template(rng)
        for i in range(rng.choice([1, 5, 12])):
            blocks = [" ".join(word() for _ in range(n)) for n in (4, 12, *[rng.randint(30, 60) for _ in range(rng.randint(2, 5))])]
            wanted[len(rows)] = "\n".join(blocks)
            rows.append((len(rows), f"http://h{host}.example/{i}", page(blocks)))
    pages = spark.createDataFrame([*rows, *rows], "page_id long, url string, html string")
    found = main_texts(pages).collect()
    wrong = [(r.page_id, r.host_path, r.text[:200], wanted[r.page_id][:200]) for r in found if r.text != wanted[r.page_id]]
    assert len(found) == 2 * len(rows) and not wrong, wrong[:3]


def test_text_beside_the_article_that_all_pages_share_stays_out(spark):
    article = lambda i: f"<p>{f'sentence {i} of this page, ' * 12}</p>"
    rows = [(i, "http://h.example/x", f"<body><div class=wrap><div class=t><p>{'All about our company. ' * 3}</p></div>"
             f"<div class=body>{article(i)}</div></div></body>") for i in range(6)]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.host_path for r in found} == {"body/div.wrap/div.body"}
    assert all("company" not in r.text and f"sentence {r.page_id} " in r.text for r in found)
