"""The scan and the learned weights of the HTML extractor decide."""

from __future__ import annotations

import random
import time

import pytest

from tallyhouse.llm import html_extract
from tallyhouse.llm.html_extract import best_region, extract, learn_weights, maximal_runs

HEAD, TAIL = "First words of the article, long enough to be kept.", "Last words of the article, long enough to be kept."
SHORT = "Some words that nobody asked for stand here, see more."
LONG = " ".join(f"word{i} of an essay" for i in range(60))
LINKS = "".join(f"<li><a href=/{i}>Page number {i}</a></li>" for i in range(8))


def article(inner, main="article"):
    return f"<body><nav>Menu one</nav><{main}><p>{HEAD}</p>{inner}<p>{TAIL}</p></{main}></body>"


@pytest.mark.parametrize("main", ["article", "main"])
@pytest.mark.parametrize("name", [
    "cookie-notice", "sponsor", "promo", "related", "comment", "subscribe", "social share", "menu", "banner", "disclaimer", "footer", "copyright",
])
def test_furniture_inside_an_article(main, name):
    for inner in (f"<div class='{name}'>{SHORT}</div>", f"<div id='{name}'><p>{SHORT}</p></div>", f"<section class='{name}'><h2>{SHORT}</h2><ul>{LINKS}</ul></section>"):
        assert extract(article(inner, main), {}) == f"{HEAD}\n{TAIL}"


def test_prose_under_an_ambiguous_name_stays():
    inner = "<section id='discussion'><h2>Discussion</h2><p>What the results mean.</p><div class=reply>I don't agree with it at all</div></section>"
    assert extract(article(inner), {}) == f"{HEAD}\nDiscussion\nWhat the results mean.\n{TAIL}"
    for name in ("menu", "related", "disclaimer"):  # long prose speaks for itself, the links behind it don't
        assert extract(article(f"<div class={name}><p>{LONG}</p><ul>{LINKS}</ul></div>"), {}) == f"{HEAD}\n{LONG}\n{TAIL}"
    for name in ("comment", "reply", "sponsored"):  # these are prose by nature
        assert extract(article(f"<div class={name}><p>{LONG}</p></div>"), {}) == f"{HEAD}\n{TAIL}"
    assert extract(article("<h2 id=related><a href=#related>Related work</a></h2>"), {}) == f"{HEAD}\nRelated work\n{TAIL}"
    assert extract(article("<article class=comment>A reader says</article>", "main"), {}) == f"{HEAD}\n{TAIL}"
    assert extract("<body><article class=comment-free><p>Own words</p></article></body>", {}) == "Own words"


def test_pages_without_a_main_element():
    page = f"<body><div><ul>{LINKS}</ul></div><div id=content><h1>Title</h1><p>{HEAD}</p><p>{LONG} <a href=/x>this page</a></p><p>{TAIL}</p></div><div><ul>{LINKS}</ul></div></body>"
    want = f"Title\n{HEAD}\n{LONG} this page\n{TAIL}"
    assert extract(page, {}) == want
    everything = {k: 1.0 for k in ("link content", "word content")}
    assert extract(page, everything) != want  # the weights choose the region
    section = f"<body><div><p>{HEAD}</p><section id=discussion><p>{LONG}</p></section><section class=related><h2>Read on</h2><ul>{LINKS}</ul></section></div></body>"
    assert extract(section, {}) == f"{HEAD}\n{LONG}"


def test_the_scan_changes_the_answer(monkeypatch):
    page = f"<body><div><ul>{LINKS}</ul></div><p>{LONG}</p><div><ul>{LINKS}</ul></div></body>"
    assert extract(page, {}) == LONG
    monkeypatch.setattr(html_extract, "best_region", lambda scores: (0, len(scores)))
    assert extract(page, {}) != LONG


def test_learned_weights_change_the_answer(spark):
    inner = f"<div class=related><p>{' '.join(['word'] * 60)}</p></div>"
    inside = [(i, f"<body><article><p>{HEAD}</p>{inner}</article></body>") for i in range(40)]
    outside = [(i, f"<body><article><p>{HEAD}</p></article>{inner}</body>") for i in range(40)]
    got = []
    for rows in (inside, outside):
        weights = learn_weights(spark.createDataFrame(rows, "page_id long, html string"), "html")
        got.append(extract(article(f"<div class=related>{' '.join(['here'] * 60)}</div>"), weights) == f"{HEAD}\n{TAIL}")
    assert got == [False, True]


def test_maximal_runs():
    def brute(scores, lo, hi):
        if hi <= lo:
            return []
        best = max(((sum(scores[a:b]), -a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), key=lambda x: (x[0], x[1], -x[2]))
        if best[0] <= 0:
            return []
        a, b = -best[1], best[2]
        return [*brute(scores, lo, a), (a, b), *brute(scores, b, hi)]

    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.uniform(-2, 2) for _ in range(rng.randrange(14))]
        got = maximal_runs(scores)
        assert got == brute(scores, 0, len(scores))
        if got:
            a, b = best_region(scores)
            assert abs(sum(scores[a:b]) - max(sum(scores[x:y]) for x, y in got)) < 1e-9


def test_long_pages_take_linear_time():
    inner = "".join(f"<div class=related><a href=/>link</a> words {i}</div>" for i in range(20_000))
    start = time.time()
    assert extract(article(inner), {}) == f"{HEAD}\n{TAIL}"
    assert extract(article(f"<div class=related>{'a <a href=/>b</a> ' * 50_000}</div>"), {}).startswith(HEAD)
    assert time.time() - start < 20
