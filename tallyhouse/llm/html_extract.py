"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Every token has a context: the nearest container on its
stack that says what it is (menu, header, footer, sidebar, advert, notice, form, comments, or
content). Words score positive and tags negative, both weighted per context (and tag), with
weights learned from labelled pages. Scores are added up per block (so that no block is cut in two),
and a single scan (Kadane) finds the contiguous region of greatest total. The text of the region's
content blocks is the result.

Labelled pages are those of the table whose own markup marks the main region (an ``article`` or
``main`` element): Spark counts the tokens of each kind, and the words under each class word, inside and
outside it; the log odds are the weights. What is never seen keeps a prior by context. The model is at
most contexts x known tags, and known class words.

Ambiguous parts. A class or id may name page furniture or a part of the article (related, notice,
menu ...). Inside the main element, and on sections and headings anywhere, such an element is no cut: its
words score by what the class word stands for, its learned odds and the length of its prose, words in
links negative. The runs of greatest total on the negated scores (the same scan, all maximal runs) are
removed from the region: a short cookie notice or a list of links goes, an essay in a ``div`` called
menu stays. A section or heading whose *id* is such a word is a topic and scores higher.

Cut without a score: elements of CONTEXT_TAGS and CONTEXT_ROLES, hidden elements, class words outside the
main element, FURNITURE words (not on headings), and the text of RAW elements (svg, noscript, select, iframe
...; of math only its annotations). ``<svg/>`` and ``<math/>`` are empty.

Scale: two passes over the pages in Arrow batches; the first shuffles only partial counts of
token kinds. No group of pages ever meets, so no host can be hot. A page takes time linear in its length.

Defined cases: null and empty html and pages without a positive region give an empty text;
unclosed tags, comments and scripts end with the page; repeated rows get equal results; extra
columns stay.
"""

from __future__ import annotations

import html as entities
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import own_columns, shield

# fixed values: the element names of HTML that the extractor treats alike
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea svg annotation annotation-xml iframe select canvas audio video".split())
EMPTY_IF_CLOSED = frozenset("svg math".split())  # "<svg/>" has no end tag; elsewhere HTML ignores the "/"
HEAD = frozenset("head title".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTEXT_TAGS = {"nav": "menu", "menu": "menu", "aside": "sidebar", "form": "form", "button": "form", "footer": "footer", "dialog": "notice", "head": "header"}
CONTEXT_ROLES = {
    "navigation": "menu", "menubar": "menu", "menu": "menu", "banner": "header", "contentinfo": "footer", "complementary": "sidebar",
    "search": "form", "form": "form", "dialog": "notice", "alertdialog": "notice", "alert": "notice",
}
CONTEXT_WORDS = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager toc",
    "header": "masthead topbar siteheader",
    "footer": "footer foot colophon copyright",
    "sidebar": "sidebar aside related recommended widget widgets share sharing social trending",
    "advert": "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion",
    "notice": "notice notices cookie cookies consent gdpr alert alerts disclaimer popup modal overlay",
    "form": "form newsletter subscribe subscription signup login search searchbox",
    "comment": "comment comments reply replies discussion disqus respond commentlist",
}
WORD_CONTEXT = {w: c for c, ws in CONTEXT_WORDS.items() for w in ws.split()}
#: words that name nothing but page furniture; the others can also name a part of an article
FURNITURE = frozenset(
    "nav navbar topnav breadcrumb breadcrumbs pagination pager masthead topbar siteheader colophon sidebar widget widgets"
    " ad ads adv advert adverts advertisement adsense gdpr popup newsletter signup searchbox comments commentlist disqus".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
SECTIONS = HEADINGS | {"section"}
CONTENT = "content"
MAYBE = "maybe"  # an ambiguous class word: scored, not a cut
TEXT_CONTEXTS = (CONTENT, MAYBE)
CONTEXTS = [CONTENT, MAYBE, *dict.fromkeys([*CONTEXT_TAGS.values(), *CONTEXT_ROLES.values(), *CONTEXT_WORDS])]
#: score of a word under an ambiguous class word, before length and learned odds
MAYBE_PRIOR = {"menu": -0.5, "header": -0.5, "footer": -0.75, "sidebar": -0.5, "advert": -1.5, "notice": -0.75, "form": -0.75, "comment": -2.0}
OWN_WORDS = {"discussion": 0.0, "alert": 1.25, "alerts": 1.25}  # as often a chapter as a thread; the author's own warnings
TOPIC = 1.5  # the id of a section or heading
LONG = 40  # words of prose under one ambiguous element that neither speak for it nor against it
LINKED = -1.0
LEARNED = (-1.0, 0.4)  # bounds of a class word's learned odds; a comment or advert stays negative

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[/a-zA-Z][^>]*\Z|(?P<text>[^<]+|<)",
    re.S,
)
ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=\d)")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def context_of(name: str, attrs: str, inside_main: bool, nested: bool = False) -> tuple[str | None, str, str]:
    """(what a container says about what it holds or None, the class word that says so, the element if it is a topic)."""
    if name == "header":
        return (None if inside_main else "header"), "", ""
    if name in CONTEXT_TAGS:
        return CONTEXT_TAGS[name], "", ""
    if not attrs or name in ("html", "body", "main") or name == "article" and not nested:
        return None, "", ""
    found, topic = "", ""
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "role" and value in CONTEXT_ROLES:
            return CONTEXT_ROLES[value], "", ""
        if key in ("class", "id"):
            for w in SPLIT.split(re.sub(r"(?<=[a-z])([A-Z])", r"-\1", m[2] or m[3] or m[4] or "").lower()):
                if w in WORD_CONTEXT:
                    cut = w in FURNITURE and name not in HEADINGS
                    if cut or not inside_main and name not in SECTIONS:
                        return WORD_CONTEXT[w], w, ""
                    topic = name if name in HEADINGS or key == "id" and name == "section" else topic
                    found = min(found or w, w, key=maybe_prior)
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value):
            return "notice", "", ""
    return (MAYBE if found else None), found, topic


def maybe_prior(word: str) -> float:
    return OWN_WORDS.get(word, MAYBE_PRIOR[WORD_CONTEXT[word]])


def tokens(page: str):
    """(kind, value, context, inside main element, part): kind is "tag" (name), "break", "text" or "link"
    (text in a link); part names the ambiguous or cut element by (number, class word, topic)."""
    stack: list[tuple[str, str, bool, tuple]] = []  # element, context, inside main, part
    at, n, parts, linked = 0, len(page), 0, False
    while at < n:
        m = TOKEN.match(page, at)
        if m is None:  # a lone "<" of an unfinished tag: the rest of the page is markup
            return
        at = m.end()
        context, main, part = stack[-1][1:] if stack else (CONTENT, False, (0, "", ""))
        text = m["text"] or m["cdata"]
        if text:
            yield "link" if linked else "text", text, context, main, part
            continue
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, attrs, close = name.lower(), m["attrs"] or m["attrs2"] or "", m["close"] or m["close2"]
        if name == "a" or name in BLOCKS and close:  # an unclosed link ends with its block
            linked = name == "a" and not close
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            yield "tag", name, context, main, part
            if name in BLOCKS:
                yield "break", "", context, main, part
            continue
        if name in EMPTY_IF_CLOSED and attrs.rstrip().endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in BLOCKS:
            yield "break", "", context, main, part
        if name == "body":
            stack.clear()  # an unclosed head ends here
            context, main, part = CONTENT, False, (0, "", "")
        if name not in VOID and name not in INLINE and name not in ("p", "html") and not attrs.rstrip().endswith("/"):
            nested, main = main, main or name in ("article", "main")
            if context in TEXT_CONTEXTS:
                own, word, topic = ("header", "", "") if name in HEAD else context_of(name, attrs, main, nested and name == "article")
                if own:
                    parts += 1
                    context, part = own, (parts, word, topic)
            stack.append((name, context, main, part))
        yield "tag", name, context, main, part
        if name == "br":
            yield "link" if linked else "text", " ", context, main, part


def kind_of(kind: str, value: str, context: str) -> str:
    """The feature of a token: its context, and the tag name if HTML knows it."""
    if kind == "tag":
        known = value in BLOCKS or value in INLINE or value in VOID
        return f"tag {context} {value if known else 'other'}"
    return f"{'link' if kind == 'link' else 'word'} {context}"


def prior(feature: str) -> float:
    kind, context = feature.split(" ")[:2]
    if kind == "class":
        return 0.0
    if kind == "link":
        return -0.5 if context == CONTENT else -1.0
    if kind == "word":
        return 1.0 if context == CONTENT else -1.0
    return -0.05 if context in TEXT_CONTEXTS else -1.0


def learn_weights(pages: DataFrame, html: str) -> dict[str, float]:
    """Weights of token kinds: log odds of standing inside the marked main region of labelled pages."""

    def count(batches):
        inside: dict[str, int] = {}
        outside: dict[str, int] = {}
        for b in batches:
            for page in b["html"]:
                low = page.lower() if isinstance(page, str) else ""
                if low.count("<article") + low.count("<main") != 1:
                    continue
                for kind, value, context, main, (_, word, _) in tokens(page):
                    if kind == "break":
                        continue
                    n = 1 if kind == "tag" else len(value.split())
                    own = inside if main else outside
                    for f in (kind_of(kind, value, context), f"class {word}") if word and kind != "tag" else (kind_of(kind, value, context),):
                        own[f] = own.get(f, 0) + n
        names = sorted({*inside, *outside})
        yield pd.DataFrame({"f": pd.Series(names, dtype="str"), "inside": [inside.get(f, 0) for f in names], "outside": [outside.get(f, 0) for f in names]})

    rows = pages.select(F.col(f"`{html}`").alias("html")).mapInPandas(count, "f string, inside long, outside long")
    got = rows.groupBy("f").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect()  # contexts x known tags, known class words
    return {r["f"]: weigh(r["f"], r["i"], r["o"]) for r in got}


def weigh(feature: str, inside: int, outside: int) -> float:
    """Log odds within bounds: words of content stay positive, and small costs keep its tags from splitting it."""
    kind, context = feature.split(" ")[:2]
    if kind == "class":
        return min(LEARNED[1], max(LEARNED[0], math.log((inside + LONG) / (outside + LONG)) / 2))
    odds = math.log((inside + 1) / (outside + 1))
    if context == MAYBE:
        return prior(feature)  # its words are weighed by class word
    if kind == "link":
        return max(-1.0, min(odds / 4, -0.25)) if context == CONTENT else min(-0.5, max(odds, -3.0))
    if kind == "word":
        return max(0.5, min(odds, 2.0)) if context == CONTENT else min(-0.5, max(odds, -3.0))
    if context == CONTENT:
        return -0.05 if odds > -2 else max(odds, -3.0) / 10
    return min(-0.5, max(odds, -3.0))


def best_region(scores: list[float]) -> tuple[int, int]:
    """[first, last) of greatest total; the earliest and longest on ties, (0, 0) if none is positive."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or total == best and start == at[0] and at[1]:
            best, at = total, (start, i + 1)
    return at


def maximal_runs(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal-scoring runs [first, last) in order (Ruzzo and Tompa), in linear time."""
    runs: list[tuple[int, int, float, float, int]] = []  # first, last, total before and behind, last run that starts lower
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, j = i, len(runs) - 1
        while True:
            while j >= 0 and runs[j][2] >= before:
                j = runs[j][4]
            if j < 0 or runs[j][3] >= total:
                break
            first, before = runs[j][0], runs[j][2]
            del runs[j:]
            j -= 1
        runs.append((first, i + 1, before, total, j))
    return [r[:2] for r in runs]


def removed_parts(own: list[tuple], weights: dict[str, float]) -> tuple[dict[int, float], set[int]]:
    """Scores of the words of ambiguous parts, and the positions that their negative runs remove."""
    texts: dict[tuple, list[int]] = {}
    sizes: dict[int, int] = {}
    for i, (kind, value, context, _, part) in enumerate(own):
        if context == MAYBE and kind in ("text", "link") and (n := len(value.split())):
            texts.setdefault(part, []).append(i)
            sizes[i] = n
    scores, removed = {}, set()
    for (_, word, topic), at in texts.items():
        prose = sum(sizes[i] for i in at if own[i][0] == "text")
        length = max(-1.0, min(math.log2((prose + 1) / LONG) / 2, 1.0))
        each = (TOPIC if topic else maybe_prior(word)) + weights.get(f"class {word}", 0.0) + length
        # a heading may be a link
        part = [sizes[i] * (each if own[i][0] == "text" or topic in HEADINGS else LINKED) for i in at]
        scores.update(zip(at, part, strict=True))
        for first, last in maximal_runs([-x for x in part]):
            removed.update(at[first:last])
    return scores, removed


def extract(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    own = list(tokens(page))
    maybe, removed = removed_parts(own, weights)
    blocks, scores, start = [], [], 0
    total = 0.0
    for i, (kind, value, context, main, _) in enumerate(own):
        if kind == "break":
            blocks.append((start, i))
            scores.append(total)
            start, total = i + 1, 0.0
        elif i in maybe:
            # what the main element holds of other things is removed anyway, it must not split the region
            total += max(maybe[i], 0.0) if main else maybe[i]
        elif not main or context == CONTENT:
            f = kind_of("text" if main and kind == "link" else kind, value, context)
            w = weights[f] if f in weights else prior(f)
            total += w if kind == "tag" else w * len(value.split())
    blocks.append((start, len(own)))
    scores.append(total)
    first, last = best_region(scores)
    texts = []
    for lo, hi in blocks[first:last]:
        part = [v for i, (kind, v, context, _, _) in enumerate(own[lo:hi], lo) if kind in ("text", "link") and context in TEXT_CONTEXTS and i not in removed]
        if text := " ".join(entities.unescape("".join(part)).split()):
            texts.append(text)
    return "\n".join(texts)


def extract_pages(pages: DataFrame, html: str = "html", out: str = "_main_text", weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with a string column ``out``: the main text."""
    weights = learn_weights(pages, html) if weights is None else weights

    @F.pandas_udf("string")
    def f(htmls: pd.Series) -> pd.Series:
        return pd.Series([extract(h if isinstance(h, str) else None, weights) for h in htmls], dtype="str")

    d, names = shield(pages)
    return d.withColumn("_th_x", f(F.col(names[html]))).select(*own_columns(names, out), F.col("_th_x").alias(out))
