"""Every operator against a brute-force version, with the cases its docstring defines."""

from __future__ import annotations

import base64
import hashlib
import html as entities
import math
import random
import re
import zlib

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyhouse.llm import components, html_extract, language_id, license_scan, packing, quality_model, simhash, url_filter, warc
from tallyhouse.llm.common import table
from tallyhouse.llm.decontaminate import decontaminate
from tallyhouse.llm.quality_rules import quality_rules
from tallyhouse.llm.queries import URL_RULES, word_tokenizer
from tallyhouse.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, kept string, _th_w string"
LINE = "a line that many different pages of one host repeat below their own text\n"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with results and working columns."""
    return spark.createDataFrame([(i, t, lang, src, "extra", "own") for i, t, lang, src in rows], DOCS)


def odd_rows():
    return [
        (900, None, "en", "s"), (901, "", None, "s"), (902, " \n\t", "en", None), (None, "some words here", "en", "s"),
        (903, "x " * 6000 + "mit license", "en", "s"), (903, "x " * 6000 + "mit license", "en", "s"), (904, "a b a b a b a b\nd\nd", "de", "s"),
    ]


@pytest.fixture(scope="module")
def sample(spark):
    got = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang", "source").collect()
    return [tuple(r) for r in got]


def words_of(i, n):
    """``n`` words of letters that no other ``i`` has."""
    return [f"{i}x{j}".translate(str.maketrans("0123456789", "abcdefghij")) for j in range(n)]


def by_row(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_quality_rules(spark, sample):
    rows = sample[:120] + odd_rows()
    rows += [(1000 + i, f"{LINE}{' '.join(words_of(i, i % 40))}\n", "en", "h") for i in range(120)]
    rows += [(2000 + i, LINE * 3 + " ".join(words_of(5000, 60)), "en", "copies") for i in range(80)]
    got = quality_rules(docs_of(spark, rows), out="kept")
    assert got.columns == ["doc_id", "text", "lang", "source", "_th_w", "kept"]
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept"]
    want = [(i, *brute.quality_base(t), *k) for (i, t, _, _), k in zip(rows, brute.quality_kept([(i, s, t) for i, t, _, s in rows], 50, 0.01, 0.4), strict=True)]
    assert by_row(got, "doc_id", *[f"kept.{c}" for c in cols]) == sorted(want, key=repr)
    assert any(w[7] for w in want) and all(w[8] for w in want if w[0] and w[0] >= 2000)  # lines removed; copies stay
    assert quality_rules(docs_of(spark, []).limit(0)).count() == 0


def test_quality_rules_count_documents_by_all_their_other_lines(spark):
    """Different documents that share boilerplate count one by one for each shared line; exact copies count once."""
    low = min((f"menu entry {' '.join(words_of(i, 3))}" for i in range(3000)), key=lambda x: hashlib.md5(x.encode()).digest())
    shared = "a second line that the same pages hold as well"
    rows = [(i, f"{low}\n{shared}\n{' '.join(words_of(i, 60))}", "en", "h") for i in range(60)]
    rows += [(100 + i, f"{shared}\n{low}\n{' '.join(words_of(7000, 60))}\n{low}", "en", "copies") for i in range(60)]
    sets = [{*t.split("\n")} for _, t, _, _ in rows]
    seen = {}
    for (_, _, _, host), lines in zip(rows, sets, strict=True):
        for x in lines:
            seen.setdefault((host, x), set()).add(frozenset(lines - {x}))
    assert len(seen["h", shared]) == len(seen["h", low]) == 60 and len(seen["copies", shared]) == 1
    want = [(i, sum(len(x.split()) for x in t.split("\n") if len(seen[host, x]) > 50)) for i, t, _, host in rows]
    got = quality_rules(docs_of(spark, rows), out="kept")
    assert by_row(got, "doc_id", "kept.n_removed_words") == sorted(want, key=repr)


def test_license_scan(spark, sample):
    texts = [
        "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0.", "MIT License MIT License", "the mit license.",
        "released under the GNU Lesser General Public License version 2.1", "CC BY-NC-SA 4.0 and creative commons attribution share alike 4.0",
        "This is free and unencumbered software in the public domain", "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "Eclipse Public License 2.0, Mozilla Public License 2.0; general public license", "license is mit",
    ]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + odd_rows() + sample[:60]
    got = {}
    for r in license_scan.scan_licenses(docs_of(spark, rows)).collect():
        got.setdefault((r["doc_id"], r["text"]), []).append(r["_license"])
    for i, t, _, _ in rows:
        for x in got[i, t]:
            found, kept = brute.license_detections(t, license_scan.RULES)
            assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == brute.license_base(t)
            assert x["labels"] == ",".join(sorted({y[3] for y in kept} | {y[3] for y in found if y[5]}))
            assert x["score"] == max([y[4] for y in kept], default=0.0)
            assert sorted((d["first_word"], -d["last_word"], d["priority"], d["label"]) for d in x["detections"]) == sorted(y[:4] for y in kept)
    assert len(license_scan.RULES) > 300
    assert license_scan.scan_licenses(docs_of(spark, []).limit(0)).count() == 0


def test_every_rule_can_fire():
    """A rule's anchor and keyword stand in some text that its regex matches."""
    for r in license_scan.RULES:
        plain = re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", r.regex))
        plain = re.sub(r"\[([a-z0-9])[^]]*\]\+?", r"\1", plain)
        for text in (plain, re.sub(r" \?", " ", plain), re.sub(r" ?(.)\?", r"\1", plain), re.sub(r".\?", "", plain)):
            if re.fullmatch(r.regex, text):
                assert r.keyword in text and (r.anchor in text), r
                break


def test_html_extraction(spark):
    pages = table(spark, SF_SMALL, "pages")
    got = {r["page_id"]: r["_main_text"] for r in html_extract.extract_pages(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        want = (" ".join(entities.unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", " ", b)).split()) for b in blocks)
        assert got[r["page_id"]] == "\n".join(x for x in want if x)
    weights = html_extract.learn_weights(pages, "html")
    odd = """<html><head><title>t</title><script>if (a<b) "</p>"</script></head><body><header>Site name</header>
      <nav><a href=/x>Menu one</a></nav><div class="cookie-notice">We use cookies to serve you</div>
      <main><h1>A title of some words</h1><p>First &amp; best&nbsp;paragraph of the text, with <b>bold</b>
      words <!-- hidden words --> in it.<p>Second paragraph of the text, as long as it must be here.
      <form><input name=q> search words</form><aside>Related things to read</aside><ul><li>one</li><li>two more words</li></ul>
      <div id="comments">A reader says something long about it</div></main><footer>Copyright of someone</footer>"""
    want = "A title of some words\nFirst & best paragraph of the text, with bold words in it.\nSecond paragraph of the text, as long as it must be here.\none\ntwo more words"
    assert html_extract.extract(odd, weights) == want
    assert [html_extract.extract(x, weights) for x in (None, "", "<p", "<!-- x", "<nav>only a menu</nav>")] == [""] * 5
    frame = spark.createDataFrame([(1, None, "x"), (2, "<p>Just text</p>", "y"), (2, "<p>Just text</p>", "y")], "page_id long, html string, _th_x string")
    assert by_row(html_extract.extract_pages(frame, out="_th_x"), "_th_x") == [("",), ("Just text",), ("Just text",)]
    assert html_extract.extract_pages(frame.limit(0)).count() == 0


def test_best_region_is_the_maximum():
    rng = random.Random(5)
    for _ in range(200):
        s = [rng.choice([-2.0, -1.0, 0.0, 1.0, 2.0]) for _ in range(rng.randrange(12))]
        a, b = html_extract.best_region(s)
        assert sum(s[a:b]) == max([0.0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_url_filter(spark):
    urls = [
        "http://a.net", "http://a.net/", "https://www.Example.NET/en/1?utm_source=x", "http://sub.example.com/de/x#y", "ftp://x.org/fr/", "x.org/fr/",
        None, "", "://", "http://notnet/", "http://spam.example.org/p/?b=2&a=1&utm_medium=z", "http://example.org/fr", "http://h/?://x.net/",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)], "page_id long, url string, listed string")
    listed = spark.createDataFrame([("https://www.spam.example.org:443/p?a=1&b=2",), (None,), ("",), ("http://other.org/q",)], "url string")
    got = {r["page_id"]: r["_url"] for r in url_filter.filter_urls(pages, listed, URL_RULES).collect()}
    assert len(got) == len(urls) * 2
    for i, u in enumerate(urls * 2):
        host = path = ""
        if u and "://" in u:
            m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1])
            host, path = m[1].translate(brute.LOWER), m[2]
        fits = [r for r in URL_RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        on_list = bool(u) and "spam" in u
        verdict = URL_RULES[rule] if rule else "block" if on_list else "allow"
        assert tuple(got[i])[:5] == (host, path, rule, verdict, on_list)
    # a saturated filter lets everything through, and the exact join still decides
    many = spark.range(5000).select(F.concat(F.lit("http://h"), "id", F.lit(".org/")).alias("url"))
    filt, blocks = url_filter.bloom_filter(many, "url", max_blocks=1)
    assert blocks == 1 and filt.count() == 1
    marked = url_filter.mark_listed(many, many.where("url like '%7.org/'"))
    assert marked.where("_listed").count() == many.where("url like '%7.org/'").count()
    assert url_filter.filter_urls(pages.limit(0), listed.limit(0), URL_RULES).count() == 0


def brute_fingerprint(text):
    w = brute.SPACE_WORD.findall((text or "").translate(brute.LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, bits):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_simhash_documents(spark, sample, monkeypatch, hot_rows):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot_rows)
    rows = sample + odd_rows()
    got = simhash.near_duplicates(docs_of(spark, rows)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    prints = [brute_fingerprint(t) for _, t, _, _ in rows]
    roots = brute_components(prints, 2)
    least = {}
    for (i, _, _, _), c in zip(rows, roots, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = [(i, format(p, "016x"), least.get(c)) for (i, _, _, _), p, c in zip(rows, prints, roots, strict=True)]
    assert by_row(got, *got.columns) == sorted(want, key=repr)
    kept = simhash.drop_near_duplicates(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, []).columns and kept.count() == len(set(roots))
    assert simhash.near_duplicates(docs_of(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("cap", [2, 32])
def test_simhash_links_connect_exactly_the_near_fingerprints(spark, cap):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {0, (1 << 64) - 1}
    for c in centres:
        values.add(c)
        for _ in range(12):
            c2 = c
            for _ in range(rng.randrange(5)):
                c2 ^= 1 << rng.randrange(64)
            values.add(c2)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r["node"]: r["component"] for r in components.components(simhash.links(fps, 2, cap)).collect()}
    roots = brute_components(values, 2)
    groups = {}
    for v, c in zip(signed, roots, strict=True):
        groups.setdefault(c, set()).add(v)
    mine = {}
    for v in signed:
        mine.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_threshold_allocation_keeps_the_pigeonhole_sum():
    for n in (10, 10**5, 10**9, 10**12):
        plan = simhash.allocate(n, np.full(64, 0.5), np.eye(64), 2)
        assert sum(t + 1 for _, t in plan) == 3
    skewed = np.full(64, 0.5)
    skewed[:20] = 0.01
    plan = simhash.allocate(10**6, skewed, np.eye(64), 2)
    assert sum(t + 1 for _, t in plan) == 3
    with pytest.raises(ValueError):
        simhash.near_duplicates(None, max_bits=3)


def test_warc_round_trip(spark):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n"
    rows = [
        (1, "http://a/\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b/?q#f", None), (4, "x", ""), (5, "y", tricky), (6, "z", tricky),
        (7, "u", "z" * 300_000), (None, "n", "alone"), (None, "n", "<p>é</p>"), (8, "r", "twice"), (8, "r", "twice"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages, path, file_bytes=100_000)
    got = warc.captures(spark, path)
    view = got.select(
        F.col("metadata.page_id").alias("id"), F.col("metadata.payload_length").alias("n"), F.col("response.digest").alias("d"), F.col("response.kind").alias("k"), "refers_to"
    )
    want = []
    for i, _, t in rows:
        data = (t or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (t or "") and r[0] is not None]
        top = max(same, default=None)
        revisit = top is not None and i != top
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    assert by_row(view, *view.columns) == sorted(want, key=repr)
    bodies = {bytes(r["b"]) for r in got.where("response.kind = 'response'").select(F.col("response.body").alias("b")).collect()}
    assert any(b.endswith(b"\r\n\r\n" + tricky.encode()) for b in bodies)
    requests = got.select("request.concurrent_to", "response.record_id", "metadata.concurrent_to").collect()
    assert all(r[0] == r[1] == r[2] for r in requests) and len({r[1] for r in requests}) == len(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


def test_quality_classifier(spark, sample):
    labels = table(spark, SF_SMALL, "labels")
    docs = table(spark, SF_SMALL, "documents")
    got = quality_model.score_quality(docs, labels).select("doc_id", "_quality_score.*")
    known = got.join(labels, "doc_id").toPandas()
    crc = known["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (known["held_out"] == crc).all()
    held = known[known["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.9
    assert known["score"].between(0, 1).all() and ((known["score"] >= 0.3) == (known["predicted"] == 1)).all()
    odd = quality_model.score_quality(docs_of(spark, odd_rows()), labels.limit(0)).select("_quality_score.score").collect()
    assert [r[0] for r in odd] == [0.5] * len(odd_rows())
    assert quality_model.score_quality(docs.limit(0), labels).count() == 0


def test_compiled_rules_equal_the_model(spark):
    rng = np.random.default_rng(3)
    x = rng.random((400, len(quality_model.FEATURES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    intercept, rules = quality_model.fit(x, y)
    total = intercept + sum(w * quality_model.holds(r, x) for r, w in rules)
    want = 1 / (1 + np.exp(-total))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], quality_model.FEATURES).select(F.struct("*").alias("f"))
    got = [r[0] for r in frame.select(quality_model.compile_rules(intercept, rules, "f")).collect()]
    assert np.allclose(sorted(got), sorted(want))
    assert ((want >= 0.5) == (y == 1)).mean() > 0.97


def test_packing(spark, sample):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(word_tokenizer())
    tok.encode_special_tokens = True
    rows = sample[:150] + odd_rows()
    got = [r.asDict() for r in packing.pack(docs_of(spark, rows), word_tokenizer(), with_ids=True).collect()]
    seen = sorted((str(r["doc_id"]), r["start"], tuple(r["ids"]), r["doc_tokens"]) for r in got)
    want = []
    for i, t, _, _ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(str(i), s, tuple(ids[s : s + 2048]), len(ids)) for s in range(0, len(ids), 2048)]
    assert seen == sorted(want)
    sequences = {}
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= 2048
    assert packing.pack(docs_of(spark, []).limit(0), word_tokenizer()).count() == 0


def test_word_tokenizer_is_exact():
    w = packing.WordTokenizer(word_tokenizer())
    rng = random.Random(1)
    letters = "aZé'sΣİǰ J̌́  \x1c1²½<|endoftext|>#$.,\n\t日本ñÑß-ſ"
    odd = ["".join(rng.choice(letters) for _ in range(50)) for _ in range(300)] + ["it's We'LL", "<|startoftext|> a", "", "  "]
    assert w.encode_batch(odd) == w.encode(odd)


def test_cutting_stock_covers_the_demand():
    rng = np.random.default_rng(2)
    for _ in range(20):
        m = int(rng.integers(1, 30))
        sizes = np.sort(rng.choice(np.arange(1, 65), m, replace=False))
        demand = rng.integers(1, 200, m).astype(float)
        plan = packing.cutting_stock(sizes, demand, 64)
        made = np.zeros(m)
        for pattern, times in plan:
            assert sum(sizes[k] * n for k, n in pattern.items()) <= 64
            for k, n in pattern.items():
                made[k] += n * times
        assert (made == demand).all()
        assert sum(t for _, t in plan) <= 1.15 * math.ceil(demand @ sizes / 64) + m or sizes.max() > 32
    assert packing.cutting_stock(np.array([], dtype=int), np.array([]), 64) == []


def test_language_id(spark, sample):
    docs = table(spark, SF_SMALL, "documents")
    got = language_id.identify(docs).select("doc_id", "lang", "_language.*").toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.95
    odd = language_id.identify(docs_of(spark, [*odd_rows(), (1, "123 !?", "en", "s")]), out="kept").select("doc_id", "text", "kept.*").collect()
    for r in odd:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language_id.identify(docs.limit(0)).count() == 0


def test_bundles_equal_the_plain_definition():
    own = language_id.Letters(64)
    text = "Ab, çd1e"
    got, some = language_id.bundles([text, None, "12"], own)
    padded = " ab çd e "
    want = np.zeros(64)
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        want += np.roll(own.letter(ord(a)), 2).astype(int) * np.roll(own.letter(ord(b)), 1) * own.letter(ord(c))
    assert (got[0] == want).all() and list(some) == [True, False, False]


def test_decontamination(spark, sample):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    items += [(500, "two words"), (501, "x"), (502, None), (503, ""), (500, "two words"), (None, "nothing like it at all"), (504, "the the the the " * 5)]
    long = items[0][1].split()
    rows = sample + odd_rows() + [
        (3000, " ".join(["pad"] * 300 + long[3:17]), "en", "s"), (3001, " ".join(long[:12]), "en", "s"), (3002, "The THE the, " * 30, "en", "s"),
        (3003, "Two-words!", "en", "s"), (3004, "nothing like it at all", "en", "s"), (3005, " ".join(long[-13:] + long[:13]), "en", "s"),
    ]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate(docs_of(spark, rows), bench)
    cols = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = []
    for i, t, _, _ in rows:
        n, hit, _, _, bad = brute.contamination(t, items)
        _, _, n_items, digest, _ = brute.contamination(t, [x for x in items if x[0] is not None])  # null ids aren't counted
        want.append((i, n, hit, n_items, digest, bad))
    assert by_row(got, "doc_id", *[f"_contamination.{c}" for c in cols]) == sorted(want, key=repr)
    none = decontaminate(docs_of(spark, rows[:3]), bench.limit(0)).select("_contamination.*").collect()
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in none)
    assert decontaminate(docs_of(spark, []).limit(0), bench).count() == 0


def test_a_filter_on_a_result_stays_above_it(spark, sample):
    """The verdict's expression isn't repeated inside per-word lambdas by the optimizer."""
    plan = quality_rules(docs_of(spark, sample[:5])).where("_quality.kept").select("doc_id")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in text and text.index("Filter") < text.index("Generate explode")
