"""Each pass over the texts normalises a text once, whatever white space it holds."""

from __future__ import annotations

import brute

from tallyhouse.llm.common import add_key
from tallyhouse.llm.quality_rules import line_rows, quality_rules

SCHEMA = "doc_id long, text string, source string"
SPACES = [" ", "  ", "\t", "\n", "\n\n", "\x0b", "\x0c", "\r", "\r\n", " \t ", " ", "\u0085"]


def test_a_line_pass_normalises_each_text_once(spark):
    docs = add_key(spark.createDataFrame([(1, "Some 12 words\nand a line", "h")], SCHEMA), "doc_id", "source", "text")
    plan = line_rows(docs, "text", "source").select("host", "line", "doc1", "doc2").distinct()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("md5(") == 1  # two when a filter on the lines repeats their expression


def test_counts_by_any_white_space(spark):
    def text(i):
        parts = [f"{w}{SPACES[(i * k + j) % len(SPACES)]}" for j, (k, w) in enumerate([(1, "One"), (5, "two2"), (7, "É#"), (3, "three"), (2, "<p>")] * (1 + i % 13))]
        return "".join(parts) + f"{SPACES[i % 12]}top  MENU\t{i}\r\n"

    rows = [(i, text(i), "h") for i in range(150)]
    rows += [(200 + 3 * i + k, s * (k + 1), None) for i, s in enumerate([*SPACES, "", "a b", "a b c a b c"]) for k in range(3)] + [(300, None, "h")]
    got = quality_rules(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "_quality.*").collect()
    lines = {i: brute.norm_lines(t) for i, t, _ in rows}
    seen = {}
    for i, _, host in rows:
        for x in lines[i]:
            seen.setdefault((host, x), set()).add(frozenset(lines[i]) - {x})
    want = {i: (*brute.quality_base(t), sum(len(x.split(" ")) for x in lines[i] if len(seen[host, x]) > 50)) for i, t, host in rows}
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words"]
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in got} == want
    assert sum(w[6] > 0 for w in want.values()) > 50 and any(w[3] for w in want.values()) and any(w[4] for w in want.values())
