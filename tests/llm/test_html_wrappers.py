"""Pages whose content stands in elements that elsewhere are adverts, forms or side columns."""

import pytest

from trendlake.llm import html_text

TEXT = [f"Paragraph {i} tells in plain words what happened on that day, and what came of it later on." for i in range(8)]
BODY = "".join(f"<p>{t}</p>" for t in TEXT)
SIDE = '<div class="sidebar"><p>Read this side story with many words too.</p></div><div id="comments"><p>A reader says something at length here.</p></div>'
WANT = "\n".join(TEXT)
WRAPPERS = [
    '<div class="elementor-widget-container">%s</div>',
    '<div class="content has-sidebar">%s</div>',
    '<div class="search-results">%s</div>',
    '<div class="related-article">%s</div>',
    '<form id="aspnetForm" method="post">%s</form>',
    '<div class="comments-open">%s</div>',
    '<div role="dialog"><div class="modal widget"><form>%s</form></div></div>',
    '<article><div class="related-article">%s</div></article>',
    '<div class="has-sidebar"><main>%s</main></div>',
    '<article class="post"><form>%s</form></article>',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrapped_content_stays(wrapper):
    page = "<html><body><nav><a href=/>Home</a></nav>%s<footer>foot</footer></body></html>"
    assert html_text.main_text(page % (wrapper % BODY)) == WANT
    if "comments" not in wrapper:
        assert html_text.main_text(page % (wrapper % (BODY + SIDE))) == WANT
        assert html_text.main_text(page % (wrapper % BODY + SIDE)) == WANT


def test_each_part_in_a_wrapper_of_its_own():
    parts = "".join(f'<div class="elementor-widget elementor-element-{i}"><div class="elementor-widget-container"><p>{t}</p></div></div>' for i, t in enumerate(TEXT))
    assert html_text.main_text(f"<body><div class=page>{parts}</div></body>") == WANT


@pytest.mark.parametrize("page", ["<article>%s</article>", "<div><div>%s</div></div>"])
@pytest.mark.parametrize("tag", ["header", "div"])
def test_title_in_an_entry_header(page, tag):
    title = f'<{tag} class="entry-header"><h1>The title</h1></{tag}>'
    site = '<header class="site-header"><h1>Site name</h1></header>'
    assert html_text.main_text(site + page % (title + f"<div>{BODY}</div>")) == "The title\n" + WANT


def test_formula():
    page = f"<article>{BODY}<p>Here <math><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn></mrow></math> holds.</p></article>"
    assert html_text.main_text(page) == WANT + "\nHere x2=4 holds."


@pytest.mark.parametrize("words", ["comments", "cookie-notice", "related"])
def test_long_blocks_beside_a_short_text_go(words):
    short = "<article><p>A short text, with enough words in it to be the content of a page of its own, and no more.</p>%s</article>%s"
    block = f'<div class="{words}">{BODY * (2 if words == "related" else 5)}</div>'
    assert html_text.main_text(short % ("", block)).startswith("A short text") and "Paragraph" not in html_text.main_text(short % ("", block))
    if words == "comments":
        plain = f"<div><p>{'A short text with some more words. ' * 5}</p></div>{block}"
        assert "Paragraph" not in html_text.main_text(plain)


def test_deep_wrappers_take_linear_time():
    assert html_text.main_text('<div class="widget">' * 20000 + "deep") == "deep"
