import random
import time

import pytest

from stratus.llm import html_extraction as h

WEIGHTS = h.learn([h.events(p, h.MARKER) for p in h.labelled_pages()])


def test_signs_of_the_weights():
    assert WEIGHTS["word:plain"] > 0 and all(x < 0 for n, x in WEIGHTS.items() if n.startswith("tag"))


def test_linear_scan_finds_the_best_stretch():
    rng = random.Random(2)
    for _ in range(200):
        sequence = [h.Event(rng.choice(["word:plain", "word:link", "tag:paragraph"]), 0, "", 0, 0, False, True)
                    for _ in range(rng.randrange(0, 14))]
        sequence = [h.Event(e.feature, rng.randrange(1, 5) if e.feature.startswith("word") else 0, "", 0, 0, False, True)
                    for e in sequence]

        def score(a, b, sequence=sequence):
            return sum(WEIGHTS[e.feature] * (e.words or 1) for e in sequence[a:b])

        a, b = h.best_region(sequence, WEIGHTS)
        best = max([0.0, *(score(i, j) for i in range(len(sequence)) for j in range(i + 1, len(sequence) + 1))])
        assert abs(score(a, b) - best) < 1e-9


PAGE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Page title</title><style>p{{margin:0}}</style>
<script>var t="<p>no</p>";</script></head><body class="has-sidebar"><header><h2>Site name</h2></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- a comment <p>x</p> -->
<div class="ad">Buy this now and be happy.</div><div id="cookie-notice"><p>We use cookies on this site, accept them all.</p></div>
{main}
<section class="comments"><h3>Comments</h3><div class="comment"><p>I disagree with this long piece of text entirely.</p></div></section>
<aside><p>Related things to read about in the sidebar.</p></aside><form><p>Your mail</p><input name=m><button>Go</button></form>
<footer>&copy; site &middot; all rights</footer></body></html>"""
BODY = "<h1>The   title &amp; more</h1><p><b>First words.<br>Next line.<p>It&#39;s a se<i>cond</i>\n paragraph &lt;here&gt; &nbsp;ok.</p>" \
       "<div class=\"advert\">Inline advert text</div><ul><li>one thing<li>two <a href='#'>things</a></ul><p>Last &eacute;nd" + " more" * 30 + ".</p>"
TEXT = "The title & more\nFirst words. Next line.\nIt's a second paragraph <here> ok.\none thing\ntwo things\nLast énd" + " more" * 30 + "."


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>',
                                  '<div id="wrap"><section class="post">{}</section></div>',
                                  "<article><header>{}</header></article>"])
def test_article_of_a_page(wrap):
    assert h.extract(PAGE.format(main=wrap.format(BODY)), WEIGHTS) == TEXT


def test_short_article_is_widened_to_its_element():
    page = "<body><nav><a href=x>a b c d e f</a></nav><article><h1>Tit</h1><p>Of.</p></article><footer>x y z</footer>"
    assert h.extract(page, WEIGHTS) == "Tit\nOf."


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open", "<script>var x", "<a href='x", "<p></p>", "&", "<//>", "< p>"])
def test_odd_pages_do_not_crash(page):
    assert isinstance(h.extract(page, WEIGHTS), str)


def test_long_and_unclosed_markup_is_read_in_linear_time():
    assert len(h.extract("<p>word " * 40_000, WEIGHTS)) > 150_000
    h.extract("<p a=\"" * 3000, WEIGHTS)
    h.extract("<!--" * 3000 + "<b" * 3000, WEIGHTS)


@pytest.mark.parametrize("tag", ['<svg class="i"/>', "<video-player></video-player>", "<select-box>", "<button-group id='a'/>",
                                 "<svg viewBox='0 0 1 1'><path d='M0'/><text>no</text></svg>", "<button>", "<object>",
                                 "<script>no</script>", "<SELECT><option>no</SELECT >", "<script a='x>no</script>", "<svg\n/>"])
def test_dropped_elements_do_not_take_the_rest_of_the_page(tag):
    page = f"<body><article><p>first words here</p>{tag}<p>rest of the page</p></article></body>"
    assert h.extract(page, WEIGHTS) == "first words here\nrest of the page"


def test_formulas_are_text_and_open_scripts_end_with_the_page():
    assert h.extract("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for all</p></article>",
                     WEIGHTS) == "so x=2 holds for all"
    for name in ("script", "style", "textarea", "template"):
        assert h.extract(f"<article><p>first words here</p><{name} a='>'>no</p></article>", WEIGHTS) == "first words here"
    assert h.extract("<svg><button>" * 30_000 + "<p>last words here", WEIGHTS) == "last words here"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div role="main">{}</div>'])
@pytest.mark.parametrize("part", [
    '<section id="social-history">{}</section>', '<section id="discussion">{}</section>', '<h2 id="related-work">{}</h2>',
    '<h2 id="search-algorithms">{}</h2>', '<p class="byline">{}</p>', '<li id="comment">{}</li>', '<p class="legal">{}</p>',
    '<div class="legal-history" data-id="ad">{}</div>', '<table><tr id="nav"><td id="footer">{}</td></tr></table>',
    '<article id="ad-hoc-networks">{}</article>', '<section id="cookies">{}</section>'])
def test_text_with_a_hint_in_its_name_stays_in_an_article(wrap, part):
    page = wrap.format("<p>first words of it</p>" + part.format("words in between") + "<p>last words of it</p>")
    assert h.extract(f"<body>{page}</body>", WEIGHTS) == "first words of it\nwords in between\nlast words of it"


def test_sections_and_headings_of_an_article_without_an_element():
    page = '<div class="content"><p>first words</p><section id="social-history"><h2 id="legal">two</h2><p>more words</p></section></div>'
    assert h.extract(f"<body>{page}</body>", WEIGHTS) == "first words\ntwo\nmore words"


@pytest.mark.parametrize("part", [
    '<div class="ad">{}</div>', '<div class="ad-slot-12">{}</div>', '<section class="related-posts">{}</section>',
    '<div id="sidebar-left">{}</div>', '<div class="socialMedia">{}</div>', '<section id="comments">{}</section>',
    '<div role="search">{}</div>', '<li class="comment">{}</li>', '<div id="related" class="related">{}</div>',
    '<p class="ad">{}</p>', "<aside>{}</aside>", '<article class="comment" id="comment-3">{}</article>'])
def test_parts_that_are_no_text_go_inside_an_article(part):
    page = "<article><p>first words of it</p>" + part.format("words in between") + "<p>last words of it</p></article>"
    assert h.extract(f"<body>{page}</body>", WEIGHTS) == "first words of it\nlast words of it"


def test_held_out_template_pages():
    right = 0
    for page in h.labelled_pages(60, seed=99):
        sequence = h.events(page, h.MARKER)
        marked = [i for i, e in enumerate(sequence) if e.marked and e.words and not e.unwanted]
        want = h.region_text(sequence, (marked[0], marked[-1] + 1))
        got, wanted = set(h.extract(page, WEIGHTS).split("\n")), set(want.split("\n"))
        right += 2 * len(got & wanted) / (len(got) + len(wanted))
    assert right / 60 > 0.93


@pytest.mark.parametrize("piece", ["<div>a b ", "<form><p>", "<td><form>", "<div><p>x</div>", "<li><a href=x>y ", "</div><div>", "<span class='ad'>x",
                                   "<section class='s'>word word</section>", "<ul><li>"])
def test_nested_markup_is_read_in_linear_time(piece):
    begun = time.time()
    h.extract("<body>" + piece * 100_000, WEIGHTS)
    assert time.time() - begun < 25


def test_deep_nesting_with_late_cells():
    begun = time.time()
    h.extract("<td><div>" + "<form>" * 30_000 + "<td></td>" * 30_000, WEIGHTS)
    assert time.time() - begun < 10


def prose(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_a_container_is_kept_whole_around_a_list_of_links():
    first, last = prose(60, 1), prose(40, 2)
    links = "".join(f"<li><a href='/{k}'>item {k}</a></li>" for k in range(40))
    text = h.extract(f"<body><ul><li><a href=x>Home</a></ul><div><p>{first}</p><ul>{links}</ul><p>{last}</p></div></body>", WEIGHTS)
    assert text.startswith(first) and text.endswith(last) and "Home" not in text


def test_like_siblings_with_a_gallery_between():
    first, last = prose(60, 3), prose(50, 4)
    gallery = "".join(f"<a href='/{k}'>picture {k}</a>" for k in range(300))
    page = f"<body><div class='part'><p>{first}</p></div><div class='gallery'>{gallery}</div><div class='part'><p>{last}</p></div>" \
           f"<div class='foot'><p>{prose(5, 5)}</p></div></body>"
    text = h.extract(page, WEIGHTS)
    assert text.startswith(first) and text.endswith(last)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
@pytest.mark.parametrize("inline", ['<ins class="adsbygoogle">BUY</ins>', '<span class="ad">AD</span>', '<b class="sponsored-text">AD</b>',
                                    '<span class="ad">AD'])
def test_inline_adverts_go(wrap, inline):
    text = h.extract("<body>" + wrap.format(f"<p>{prose(30, 6)} {inline}</p><p>last words of the text</p>") + "</body>", WEIGHTS)
    assert text == f"{prose(30, 6)}\nlast words of the text"


@pytest.mark.parametrize("inline", ['<span class="legal">{}</span>', '<em id="ad">{}</em>', '<span class="byline">{}</span>', '<b class="main">{}</b>'])
def test_inline_text_stays(inline):
    text = h.extract(f"<article><p>first words {inline.format('in between')} and last</p></article>", WEIGHTS)
    assert text == "first words in between and last"


def test_a_closing_copyright_line_goes_after_an_unmarked_article():
    body = prose(80, 7)
    assert h.extract(f"<body><div><p>{body}</p><p>Copyright 2020 Some Body. All rights reserved</p></div></body>", WEIGHTS) == body
    kept = f"<article><p>{body}</p><p>Copyright 2020 was a year.</p></article>"
    assert h.extract(kept, WEIGHTS).endswith("was a year.")


def test_pages_table(spark):
    rows = [(1, "u", PAGE.format(main=f"<article>{BODY}</article>")), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "a " * 50_000),
            (3, "w", "<p>" + "a " * 50_000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, order string")
    out = h.extract_pages(pages, h.Learner(sample=2).fit(pages).weights)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(out.collect(), key=lambda r: (r.page_id or 0, r.n_chars))
    assert [(r.page_id, r.n_chars) for r in got] == [(None, 0), (1, len(TEXT)), (2, 0), (3, 99_999), (3, 99_999)]
    assert got[1].text == TEXT
    empty = spark.createDataFrame([], pages.schema)
    assert h.extract_pages(empty, h.Learner().fit(empty).weights).count() == 0
