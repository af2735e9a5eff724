import html
import random
import re

from footfall.llm import html_text as H
from tests.conftest import SF_ORACLE

PROSE = ("This is the long text of the article and it has a lot of stop words in it, as is usual for the language, so that it "
         "is found to be content by the rules of the first pass.")


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        parts = re.split(r"</?(?:p|h1)>", article.group(1)) if article else []
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", p)).split()) for p in parts]
        assert got[r.page_id] == "\n".join(x for x in lines if x)


def test_boilerplate_goes_and_short_blocks_inherit():
    page = f"""<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><a href=x>Menu</a></nav>
    <div class="cookie-notice">{PROSE}</div><main><article><header><h1>My title</h1></header><p>Short.</p><p>{PROSE}</p>
    <aside>Buy the thing</aside><form><p>Sign up to the list</p><input name=a><button>Go</button></form>
    <div class="ad">Ad of the day</div><ul><li>One</li><li>Two &lt;3 &#233;</li></ul>
    <section id="comments"><h2>Comments</h2><div class=comment>{PROSE}</div></section></article></main>
    <div class=sidebar><p>{PROSE}</p></div><footer>f</footer><script>var a = "<p>no</p>";</script></body></html>"""
    assert H.main_text(page).split("\n") == ["My title", "Short.", PROSE, "One", "Two <3 é"]


def test_pages_without_an_article_element():
    page = f"<body><div class=menu>{PROSE}</div><div><p>Intro.</p><p>{PROSE}</p><p>{PROSE}<p>End.</div><div class=footer>x</div>"
    assert H.main_text(page).split("\n") == ["Intro.", PROSE, PROSE, "End."]
    links = "".join(f"<li><a href=/{i}>the link number {i} of the list and the rest of it</a>" for i in range(9))
    assert H.main_text(f"<ul>{links}</ul><p>{PROSE}</p>") == PROSE


LINE = "The council said that the plan for the bridge is not what the people of the town had in mind at all"


def test_blocks_of_an_article_stay_whatever_they_look_like():
    link = f"<a href=x>{LINE}</a>"
    assert H.main_text(f"<article><p>{LINE}</p><p>{link}</p><p>{LINE}</p></article>").split("\n") == [LINE] * 3
    assert H.main_text(f"<article><h1><a href=y>Headline</a></h1><p>{LINE}</p></article>").split("\n") == ["Headline", LINE]
    items = "".join(f"<li><a href=/{i}>part {i}</a></li>" for i in range(5))
    assert H.main_text(f"<article><p>Short.</p><ul>{items}</ul><p>End.</p></article>").split("\n") == [
        "Short.", *[f"part {i}" for i in range(5)], "End."]
    assert H.main_text(f"<p>Short.</p><ul>{items}</ul><p>End.</p>").split("\n") == ["Short.", "End."]
    assert H.main_text(f"<h1><a href=y>Headline</a></h1><p>{LINE}</p>").split("\n") == ["Headline", LINE]
    for names in ("search-results-analysis", "share-prices", "related-work", "header-wrap", "comment-free"):
        assert H.main_text(f"<article><section class='{names}'><p>{LINE}</p></section></article>") == LINE, names
        assert H.main_text(f"<body><div class='{names}'><p>{PROSE}</p></div></body>") == PROSE, names
    for names in ("menu-item", "footer-links", "adBox", "site_footer", "comment-list"):
        assert H.main_text(f"<article><div class='{names}'>{PROSE}</div><p>{LINE}</p></article>") == LINE, names


def test_forms_go_unless_they_wrap_the_page():
    assert H.main_text(f"<body><form><div><p>{PROSE}</p><p>Short.</p></div></form></body>").split("\n") == [PROSE, "Short."]
    assert H.main_text(f"<form><nav>Menu</nav><article><p>{LINE}</p></article></form>") == LINE
    assert H.main_text(f"<article><p>{PROSE}</p><p>{PROSE}</p><form><p>Sign up</p><p>{PROSE}</p></form></article>").split("\n") == [PROSE] * 2
    assert H.main_text(f"<p>{PROSE}</p><form>Your name <input> and your town</form>") == PROSE
    assert H.main_text("<form><p>Your name</p></form>") == ""


def test_second_pass_equals_a_plain_search():
    rng = random.Random(6)
    for _ in range(300):
        labels = [rng.choice([H.GOOD, H.BAD, None, None, None]) for _ in range(rng.randint(0, 12))]
        blocks = [H.Block("x", 0, False, 0) for _ in labels]
        for b, label in zip(blocks, labels):
            b.label = label
        H._second_pass(blocks)
        for k, b in enumerate(blocks):
            decided = [(abs(k - j), -lab) for j, lab in enumerate(labels) if lab is not None]
            want = labels[k] if labels[k] is not None else H.GOOD if H.GOOD not in labels else -min(decided)[1]
            assert b.label == want


def test_every_rule_changes_a_result(monkeypatch):
    links = "".join(f"<li><a href=/{i}>the link number {i} of the list and of all the rest of it</a></li>" for i in range(4))
    code = "<p>" + "lorem dolor amet sed eiusmod " * 8 + "</p>"
    page = f"<ul>{links}</ul><p>More.</p>{code}<ul>{links}</ul><p>Intro.</p><p>{PROSE}</p><p>{LINE}</p><p>Coda.</p><ul>{links}</ul>"
    normal = H.main_text(page)
    assert normal.split("\n") == ["Intro.", PROSE, LINE, "Coda."]
    for name, value in (("LINK_DENSITY", 1.1), ("STOP_DENSITY", 0.0), ("LONG_CHARS", 10_000)):
        with monkeypatch.context() as changed:
            changed.setattr(H, name, value)
            changed.setattr(H, "SHORT_CHARS", 10_000 if name == "LONG_CHARS" else H.SHORT_CHARS)
            assert H.main_text(page) != normal, name
    with monkeypatch.context() as changed:
        changed.setattr(H, "_second_pass", lambda found: None)
        assert H.main_text(page) != normal


def test_odd_markup():
    assert H.main_text(None) == H.main_text("") == H.main_text(" \n ") == H.main_text("<p></p>") == ""
    assert H.main_text("just text") == "just text"
    assert H.main_text('<p>a < b and "c"<p>d<a href="x') == 'a < b and "c"\nd'
    assert H.main_text("<p>Hello.</p><script>x") == H.main_text("<p>Hello.</p><!-- x") == "Hello."
    assert H.main_text("<p>one<br>two&nbsp;three\n four</p>") == "one two three four"
    assert H.main_text('<p title="a>b">x</p><p class="y>z</p>tail').startswith("x")
    assert len(H.main_text("<div>" * 20_000 + "deep")) == 4
    assert H.main_text("<p>" + "word " * 300_000 + "</p>").count("word") == 300_000


def test_edge_rows(spark):
    rows = [(1, "u", "<p>Hello</p>", "old", 5), (1, "u", "<p>Hello</p>", "old", 5), (None, None, None, None, None), (2, "v", "", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    out = H.extract(pages)
    assert "html" not in out.columns and out.columns.count("text") == 1
    assert sorted((r.page_id or 0, r.text) for r in out.collect()) == [(0, ""), (1, "Hello"), (1, "Hello"), (2, "")]
    assert H.extract(pages.limit(0)).count() == 0


def test_names_of_page_and_state_are_no_boilerplate():
    for tag, names in (("body", "has-sidebar"), ("body", "header-fixed"), ("html", "no-sidebar"), ("main", "content search"),
                       ("article", "post comments-open"), ("div", "content with-ads"), ("div", "page no-sidebar")):
        assert H.main_text(f"<{tag} class='{names}'><p>{PROSE}</p></{tag}>") == " ".join(PROSE.split()), (tag, names)
    for names in ("sidebar", "left-sidebar", "menu is-open", "site-footer", "comments"):
        assert H.main_text(f"<body><div class='{names}'><p>{PROSE}</p></div></body>") == "", names
