"""Text of an article that must not be cut before the scan."""

from __future__ import annotations

import pytest

from tallyhouse.llm.html_extract import extract

HEAD, TAIL = "<p>First words of the article, long enough to be kept.</p>", "<p>Last words of the article, long enough to be kept.</p>"
FIRST, LAST = "First words of the article, long enough to be kept.", "Last words of the article, long enough to be kept."


@pytest.mark.parametrize("inner, kept", [
    ('<svg class="i"/>', ""), ("<svg />", ""), ("<math/>", ""), ("<svg><text>drawn</text></svg>", ""),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x{=}1</annotation></math> holds</p>", "so x=1 holds"),
    ("<object data=a.pdf><p>the text of an object</p></object>", "the text of an object"),
    ('<section id="discussion"><h2>Discussion</h2><p>What the results mean, at some length.</p></section>', "Discussion\nWhat the results mean, at some length."),
    ('<h2 id="related-work">Related work</h2>', "Related work"), ('<h2 id="navigation">Navigation</h2>', "Navigation"), ('<div class="alert">Never mix the two.</div>', "Never mix the two."),
    ('<div class="alert"><nav>a menu</nav>Never mix the two.</div>', "Never mix the two."), ('<div id="comments">A reader says so</div>', ""), ('<div class="social ads">Buy this now</div>', ""),
])
@pytest.mark.parametrize("main", ["article", "main"])
def test_text_inside_the_main_element(main, inner, kept):
    page = f"<html><body><nav>Menu one</nav><{main}>{HEAD}{inner}{TAIL}</{main}><footer>Copyright</footer></body></html>"
    assert extract(page, {}) == "\n".join(x for x in (FIRST, kept, LAST) if x)


def test_an_ambiguous_part_at_the_end_is_weighed():
    page = "<body><article>{}<section id='discussion'>{}</section></article></body>"
    assert extract(page.format(HEAD, TAIL), {}) == f"{FIRST}\n{LAST}"
    assert extract(page.format(HEAD, "<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>"), {}) == FIRST


def test_outside_the_main_element_the_word_is_a_cut():
    assert extract(f"<body>{HEAD}<div class='alert'>Some notice</div>{TAIL}</body>", {}) == f"{FIRST}\n{LAST}"
