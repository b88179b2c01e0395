"""Texts that hold the tokenizer's special strings, against an untouched tokenizer."""

from __future__ import annotations

import random

from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tallyhouse.llm.queries import word_tokenizer

TEXTS = [
    "the end <|endoftext|> next", "the end<|endoftext|>next", "x<|endoftext|><|endoftext|>y", "<|startoftext|>", "<|ENDOFTEXT|> a", "<|endoftext|", "e<|endoftext|>\u0301 x",
    "<|end<|endoftext|>oftext|>", "a\u2003<|startoftext|>\u2003b", "it'<|endoftext|>s \u65e5\u672c<|startoftext|>\u00e9", "<|endoftext|\u226f b", "<|endoftext|>\u0338 b",
]


def test_special_strings_get_their_own_ids():
    tok = Tokenizer.from_file(word_tokenizer())
    rng = random.Random(3)
    bits = ["<|endoftext|>", "<|startoftext|>", "a", "Z\u00e9", " ", "\n", "'s", "1", "<|", "|>", "\u0301", "\u0130", "\u2003", "endoftext"]
    texts = TEXTS + ["".join(rng.choice(bits) for _ in range(12)) for _ in range(300)]
    got = packing.WordTokenizer(word_tokenizer()).encode_batch(texts)
    for t, ids in zip(texts, got, strict=True):
        assert ids == b"".join(i.to_bytes(4, "little") for i in tok.encode(t, add_special_tokens=False).ids), t


def test_pack_uses_the_special_ids(spark):
    rows = [(1, "the end <|endoftext|> next")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), word_tokenizer(), with_ids=True).collect()
    assert [list(r["ids"]) for r in got] == [[518, 806, 49407, 1131, 1]]
