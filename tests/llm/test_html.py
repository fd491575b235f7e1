from cytoframe.llm import html as H
from cytoframe.llm.html_pages import labelled_pages

W = dict(H.learned_weights())


def test_words_are_positive_and_tags_negative():
    assert W["word"] > 0 and all(v < 0 for k, v in W.items() if k not in ("word", "link"))


def test_labelled_pages_and_others_of_their_kind():
    assert all(H.extract(p, W) == "\n".join(b) for p, b in labelled_pages())
    other = labelled_pages(60, seed=99)
    assert sum(H.extract(p, W) == "\n".join(b) for p, b in other) >= 55


def test_furniture_goes_and_text_is_clean():
    page = """<html><head><title>T</title></head><body><nav>menu here</nav><div class="sidebar"><p>side text is quite long really</p></div><main><h1>Title &amp; more</h1><p>First   para with<br>break &lt;b&gt; caf&eacute;.</p>
    <ul><li>item one is here</li><li>item two</li></ul><div class="ad">buy now a lot of words here for you</div><p>Second para<script>bad("</p>")</script> continues<style>p{}</style>.</p><!-- no --><section id="comments"><p>reader says hello there</p></section></main>
    <div class="cookie-notice">we use cookies</div><form><p>sub scribe</p></form><footer>foot</footer></body></html>"""
    assert H.extract(page, W) == "Title & more\nFirst para with break <b> café.\nitem one is here\nitem two\nSecond para continues."


def test_names_of_classes():
    page = '<div class="layout has-sidebar"><div class="post-body"><p>The text of the page is this one here.</p></div><ol class="commentlist"><li>a reader says many words about it all</li></ol></div>'
    assert H.extract(page, W) == "The text of the page is this one here."


def test_names_alone_do_not_take_a_page():
    text = "The text of the page is this one here, and it has some words more."
    for page in (
        f'<body><form id=aspnetForm><div><nav><a href=x>Home</a></nav><p>{text}</p></div></form></body>',
        f'<body><form id="aspnetForm"><div class="header">Site</div><article><p>{text}</p></article></form></body>',
        f'<body><div class="side-by-side"><article><p>{text}</p></article></div></body>',
        f"<body><header><main><p>{text}</p></main></header><footer>Foot</footer></body>",
        f'<article><div id="form-factor"><p>{text}</p></div></article>',
        f'<article><section id="related-work"><p>{text}</p></section></article>',
        f'<div class="page-header"><div id="search"><p>{text}</p></div></div>',
    ):
        assert H.extract(page, W) == text, page
    assert H.extract(f'<article><h2 class="section-header">Its heading</h2><p>{text}</p></article>', W) == f"Its heading\n{text}"
    assert H.extract(f"<article><header><h1>Title</h1></header><p>{text}</p></article>", W) == f"Title\n{text}"
    assert H.extract("<body><article><p>" + "long " * 40 + "text.</p></article> <article><p>Second short part.</p></article></body>", W).endswith("text.\nSecond short part.")


def test_furniture_that_is_longer_than_the_text_goes():
    text, much = "The text of the page is this one here.", "many words of others " * 30
    for tag in ('div class="sidebar"', 'div class="side"', 'div class="side-col"', 'div id="comments"', "form", "header", "aside", "footer", 'div class="related-posts"', "nav"):
        name = tag.split()[0]
        assert H.extract(f"<body><article><p>{text}</p></article><{tag}><p>{much}</p></{name}></body>", W) == text, tag
    for tag in ('div id="related-posts"', 'div class="related"', 'section id="comments"', 'h3 class="comments-title"', 'div id="search-box"'):
        name = tag.split()[0]
        assert H.extract(f"<body><article><p>{text}</p><{tag}><b>{much}</b></{name}></article></body>", W) == text, tag


def brute_force_run(scored):
    best, top = (0, 0), 0.0
    for i in range(len(scored)):
        for j in range(i + 1, len(scored) + 1):
            total = sum(w for _, w, _ in scored[i:j]) + sum(t for t, _, _ in scored[i + 1 : j])
            if total > top:
                best, top = (i, j), total
    return best


def test_best_run_is_the_best_of_all():
    import random

    r = random.Random(3)
    for _ in range(300):
        scored = [(-float(r.randint(1, 9)), float(r.randint(0, 9)), "x") for _ in range(r.randint(0, 12))]
        i, j = H.best_run(scored)
        a, b = brute_force_run(scored)
        total = lambda i, j, s=scored: sum(w for _, w, _ in s[i:j]) + sum(t for t, _, _ in s[i + 1 : j])
        assert total(i, j) == total(a, b)


def test_words_of_attributes_that_hide_nothing():
    text = "The text of the page is this one here."
    for tag in ('article style="overflow:hidden"', 'div class="content overflow-hidden"', 'div class="is-hidden-mobile"', 'div class="post hidden-xs"', 'article data-x="hidden"', "article title='a hidden place' data-a=\"display:none\"", 'article data-hidden="1"', "div hidden=false", 'article aria-hidden="false"'):
        name = tag.split()[0]
        assert H.extract(f"<html><body><{tag}><p>{text}</p></{name}></body></html>", W) == text, tag
        assert H.extract(f"<html><body><article><{tag}><p>{text}</p></{name}></article></body></html>", W) == text, tag
    for attributes in ('style="overflow:hidden"', 'class="overflow-hidden"', 'data-x="hidden"'):
        assert H.extract(f"<html><body {attributes}><p>{text}</p></body></html>", W) == text
    for tag in ("div hidden", 'div class="x" hidden', "div hidden=''", "div HIDDEN='until-found'", "div aria-hidden=true", 'div aria-hidden = "true"', 'div style="color:red; display : none"', "div style='visibility:hidden'", 'div class="hidden"', 'div class="a visually-hidden"', "section id=x hidden"):
        assert H.extract(f"<html><body><article><p>{text}</p><{tag}><p>Words that are not to be seen at all.</p></{tag.split()[0]}></article></body></html>", W) == text, tag


def test_odd_pages():
    assert H.extract("", W) == "" and H.extract("<html><body></body></html>", W) == "" and H.extract("just text here", W) == "just text here"
    assert H.extract("<p>one <b>two<p>three &nbsp; four", W) == "one two\nthree four"
    assert H.extract("a < b and <notatag", W)
    assert len(H.extract("<article>" + "<p>word word word</p>" * 20000 + "</article>", W)) == 20000 * 15 - 1


def test_table(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<article><p>Some text of a page.</p></article>", "x"), (3, "u", "<article><p>Some text of a page.</p></article>", "x"), (None, "u", "<p>é</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [tuple(r) for r in H.extract_pages(df).collect()]
    assert got == [(1, "u", "", 0), (2, None, "", 0), (3, "u", "Some text of a page.", 20), (3, "u", "Some text of a page.", 20), (None, "u", "é", 1)]
    assert H.extract_pages(df.limit(0)).count() == 0


def test_work_grows_with_the_length():
    import time

    n = 200_000
    parts = ["<a", "<div>", "<a<b>", "<!", "<!-", "<p><b>", "<svg>", "<iframe>", "</span><div>", "<b></p>", "<b><li>", "<a \"", "<a '\">", "<nav><p></p>", "</", "&#1", "&", "<a href=x>", "<textarea", "<article>", "</svg", "<a \"'>", "<![CDATA["]
    for part in parts:
        began = time.perf_counter()
        H.extract("<p>word</p>" + part * n, W)
        H.extract("<b>" * n + part * n + ">", W)
        assert time.perf_counter() - began < 25, part


def test_long_references():
    assert H.extract("<p>a &#" + "1" * 6000 + "; b &#" + "0" * 6000 + "65; c &#65; &#x41; &#0000000000000000000000066; &#00000000000000000000; d</p>", W) == "a \ufffd b A c A A B \ufffd d"


def test_text_of_formulas_and_fallbacks_stays():
    assert H.extract("<article><p>one <math><mi>x</mi><mo>+</mo><mn>1</mn></math> two <canvas>drawn</canvas> and <object>held</object></p></article>", W) == "one x+1 two drawn and held"
