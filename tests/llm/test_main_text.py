"""Main text of pages: blocks, boilerplate, hostile pages."""

import random
import time

import pytest

from reelhouse.llm import main_text as mt

WORDS = "river green stone bread window morning paper garden walk house lamp road cloud".split()


def _text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def _page(rng, i):
    blocks = [_text(rng, rng.randrange(1, 80)) for _ in range(rng.randrange(1, 12))]
    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[: rng.randrange(3, 13)])
    body = "".join(f"<p>{b}</p>" for b in blocks)
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul>{links}</ul></nav>"
            f"<div class=\"ad\">{_text(rng, 20)}</div><article>{body}</article><section class='comments'><p>{_text(rng, 150)}</p></section>"
            f"<footer>&copy; {_text(rng, 10)}</footer></body></html>"), "\n".join(blocks)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(1)
    pages = spark.createDataFrame([(i, _page(rng, i)[0]) for i in range(120)], "page_id long, html string")
    return mt.learn(pages)


def test_articles_are_found_exactly(spark):
    rng = random.Random(2)
    made = [_page(rng, i) for i in range(150)]
    pages = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(made)], "page_id long, html string")
    got = {r.page_id: r.text for r in mt.extract(pages).collect()}
    assert [got[i] for i in range(150)] == [t for _, t in made]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words only", "plain words only"), ("<p>one<p>two", "one\ntwo"),
    ("<div><p>a&amp;b &#233; &lt;i&gt;</p></div>", "a&b é <i>"), ("<p>some <b>bo</b>ld\n\t text<br>here</p>", "some bold text here"),
    ("<article><h1>Head</h1><p>one two</p><aside>not this</aside><p>three four</p></article>", "Head\none two\nthree four"),
    ("<div id='cookie-notice'>we use cookies on this site</div><main><p>real words stand here</p></main>", "real words stand here"),
    ("<main><ul><li>first<li>second</ul></main>", "first\nsecond"),
    ("<article><p>kept words</p><form><label>Name</label><textarea>no</textarea></form></article>", "kept words"),
    ("<article><p>good words</p><!-- not <p>this</p> --><script>x='</article>'</script><p>more words</p></article>", "good words\nmore words"),
    ("<article><p>5 < 6 and words</p></article>", "5 < 6 and words"), ("<p title=\"a>b\">quoted words", "quoted words"),
    ("<article><p>left open <div class='share-buttons'>tweet</div> words", "left open\nwords"),
    ("<div style='display:none'>hidden words here</div><p>seen words here</p>", "seen words here"),
])
def test_odd_pages(learned, page, text):
    assert mt.main_text(page, learned) == text


def test_long_adverts_do_not_split_an_article(learned):
    advert = "<div class='ad'>" + "buy this now " * 200 + "</div>"
    page = f"<article><p>{'first part ' * 10}</p>{advert}<p>{'second part ' * 10}</p></article>"
    assert mt.main_text(page, learned) == ("first part " * 10).strip() + "\n" + ("second part " * 10).strip()


def test_comments_that_are_articles_are_not_main_text(learned):
    own, said = "these are the twelve words of the article that we want", "somebody wrote a reply about it " * 5
    page = f"<body><article><p>{own}</p><article class='comment'><p>{said}</p></article><article class='comment'><p>{said}</p></article></article></body>"
    assert mt.main_text(page, learned) == own


def test_end_tags_without_a_start_take_no_search(learned):
    started = time.perf_counter()
    assert mt.main_text("<article><p>" + "<span>word " * 60_000 + "</b>" * 60_000, learned).count("word") == 60_000
    assert time.perf_counter() - started < 10


def test_very_long_and_broken_pages(learned):
    assert len(mt.main_text("<article>" + "<p>word " * 50_000, learned).split("\n")) == 50_000
    assert mt.main_text("<" * 20_000 + "a", learned) is not None
    assert mt.main_text('<a href="' * 5000, learned) is not None
    assert mt.main_text("<div>" * 5000 + "deep words" + "</div>" * 5000, learned) in ("deep words", "")


def test_tables_without_marked_pages(spark):
    pages = spark.createDataFrame([(1, "<p>only words</p>"), (2, None)], "page_id long, html string")
    assert {r.page_id: r.text for r in mt.extract(pages).collect()} == {1: "only words", 2: ""}
    assert mt.extract(pages.limit(0)).count() == 0


def test_plain_pages_beside_marked_pages_with_stray_text(spark):
    """Marked pages with text beside their article don't cost pages without such an element theirs."""
    rng = random.Random(5)
    marked = [_page(rng, i) for i in range(60)]
    stray = [p.replace("<body>", "<body class='home'><p>skip to the content of this page</p><div class='wrap'>copyright of the owner ").replace("</body>", "</div></body>")
             for p, _ in marked]
    blocks = [[_text(rng, rng.randrange(15, 80)) for _ in range(4)] for _ in range(40)]
    bodies = ["".join(f"<p>{b}</p>" for b in own) for own in blocks]
    plain = [f"<html><body>{b}</body></html>" if i % 3 == 0 else f"<html><body class='home'><div class='wrap'>{b}</div></body></html>" if i % 3 == 1 else b
             for i, b in enumerate(bodies)]
    pages = spark.createDataFrame(list(enumerate(stray + plain)), "page_id long, html string")
    got = {r.page_id: r.text for r in mt.extract(pages).collect()}
    assert [got[60 + i] for i in range(40)] == ["\n".join(own) for own in blocks]
    assert [got[i] for i in range(60)] == [t for _, t in marked]


@pytest.mark.parametrize("known", [True, False])
def test_one_name_does_not_cost_a_page_its_text(learned, known):
    weights = learned if known else mt.Weights(dict(mt.PRIOR), {})
    rng = random.Random(6)
    blocks = [_text(rng, 60) for _ in range(8)]
    body, text = "".join(f"<p>{b}</p>" for b in blocks), "\n".join(blocks)
    nav = "<nav><ul><li><a href='/'>home</a></li><li><a href='/a'>about</a></li></ul></nav>"
    hidden = "<div class='sidebar' style='display:none'>" + "not shown " * 400 + "</div>"
    assert mt.main_text(f"<body>{nav}<div class='content has-sidebar'>{body}</div><footer>imprint</footer></body>", weights) == text
    assert mt.main_text(f"<body><p>skip to content</p>{nav}<div class='content has-sidebar'>{body}</div>{hidden}</body>", weights).endswith(text)
    assert mt.main_text(f"<body><form id='whole'>{nav}{body}</form></body>", weights) == text
    comments = f"<div class='comments'>{'they said so ' * 200}</div>"
    assert mt.main_text(f"<body>{body}{comments}</body>", weights) == text
    assert mt.main_text(f"<body>{nav}</body>", weights) == ""
    assert mt.main_text(f"<body>{hidden}</body>", weights) == ""
