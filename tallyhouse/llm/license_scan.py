"""License scan: ordered signature rules, in DataFrame operations only.

The text is reduced to lower-cased words joined by one space. Every rule has an
anchor and a keyword; plain substring tests decide which rules run at all (most documents run none). A rule's
regex marks its matches in the word string, and the marks give word intervals. Overlapping
detections are resolved by priority and interval containment: a detection that lies inside the
interval of another one with the same or a better priority is suppressed.

The rules come from templates over licence families: each family states its names, versions and
identifiers, each template one way to cite them (identifier line, notice, title, mention). Short names
(GPL, Apache, MPL, BSD ...) also count without the noun in notices, with a version, and before "licensed". They
are a bounded literal; nothing is joined or shuffled, so hot keys don't exist here, and the work
is linear in the text. ``base`` rules are the plain phrases; they count every place, suppressed or
not, and their labels always stay.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows get equal
results; extra columns stay (the result is one struct column).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ascii_lower, own_columns, shield, with_result
from tallyhouse.llm.decontaminate import NON_WORD

CHUNK = 256  # detections whose suppression is gathered in one array
OPEN, CLOSE = "\x01", "\x02"  # can't occur in the word string


@dataclass(frozen=True)
class Rule:
    rule_id: str
    label: str
    anchor: str  # first gate: one of a few strings looked up in every document
    keyword: str  # second gate: must also stand in the word string for the rule to run
    regex: str  # over the word string; word boundaries are added
    priority: int  # 1 is best
    confidence: float
    base: bool = False


#: phrase -> label, counted at every place
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label: (names as regexes over words, versions, identifier regexes, anchor)
FAMILIES = {
    "mit": (["mit(?: x11)?", "expat"], [], ["mit(?: 0)?"], "licen"),
    "apache": (["apache(?: software)?", "asf"], ["1 0", "1 1", "2 0", "2"], ["apache (?:1 [01]|2 0)", "asl 2"], "licen"),
    "gpl": (["(?:gnu )?general public", "(?:gnu )?gpl"], ["1", "2", "2 0", "3", "3 0"], ["gpl [123](?: 0)?(?: only| or later)?"], "licen"),
    "lgpl": (["(?:gnu )?(?:lesser|library) general public", "(?:gnu )?lgpl"], ["2", "2 1", "3", "3 0"], ["lgpl (?:2 [01]|3 0)(?: only| or later)?"], "licen"),
    "agpl": (["(?:gnu )?affero general public", "(?:gnu )?agpl"], ["3", "3 0"], ["agpl 3 0(?: only| or later)?"], "licen"),
    "fdl": (["(?:gnu )?free documentation"], ["1 1", "1 2", "1 3"], ["gfdl 1 [123](?: only| or later)?"], "licen"),
    "bsd": (["(?:new |modified |simplified |revised )?bsd", "(?:two|three|four|[0234]) clause bsd", "bsd [0234] clause"], [], ["(?:0bsd|bsd [1234] clause(?: clear)?)"], "licen"),
    "mpl": (["mozilla public", "mpl"], ["1 0", "1 1", "2 0"], ["mpl (?:1 [01]|2 0)"], "licen"),
    "epl": (["eclipse public", "epl"], ["1 0", "2 0"], ["epl [12] 0"], "licen"),
    "eupl": (["european union public", "eupl"], ["1 0", "1 1", "1 2"], ["eupl 1 [012]"], "licen"),
    "cddl": (["common development and distribution", "cddl"], ["1 0", "1 1"], ["cddl 1 [01]"], "licen"),
    "cpl": (["common public", "ibm public"], ["1 0"], ["(?:cpl|ipl) 1 0"], "licen"),
    "artistic": (["(?:perl )?artistic"], ["1 0", "2 0"], ["artistic [12] 0"], "licen"),
    "isc": (["isc", "internet systems consortium"], [], ["isc"], "licen"),
    "zlib": (["zlib(?: libpng)?"], [], ["zlib"], "licen"),
    "boost": (["boost software"], ["1 0"], ["bsl 1 0"], "licen"),
    "busl": (["business source"], ["1 0", "1 1"], ["busl 1 [01]"], "licen"),
    "sspl": (["server side public"], ["1"], ["sspl 1 0"], "licen"),
    "elastic": (["elastic"], ["2 0"], ["elastic 2 0"], "licen"),
    "unlicense": (["un"], [], ["unlicense"], "licen"),
    "wtfpl": (["do what the [a-z]+ you want to public", "wtfpl"], ["2"], ["wtfpl"], "licen"),
    "postgresql": (["postgresql"], [], ["postgresql"], "licen"),
    "python": (["python software foundation", "psf"], ["2"], ["(?:psf|python) 2 0"], "licen"),
    "php": (["php"], ["3 0", "3 01"], ["php 3 01?"], "licen"),
    "ruby": (["ruby"], [], ["ruby"], "licen"),
    "openssl": (["openssl", "ssleay"], [], ["openssl"], "licen"),
    "ofl": (["(?:sil )?open font"], ["1 0", "1 1"], ["ofl 1 [01]"], "licen"),
    "odbl": (["open (?:data commons open )?database"], ["1 0"], ["odbl 1 0"], "licen"),
    "odc-by": (["open data commons attribution"], ["1 0"], ["odc by 1 0"], "licen"),
    "afl": (["academic free"], ["2 0", "2 1", "3 0"], ["afl [123] [01]"], "licen"),
    "osl": (["open software"], ["1 0", "2 0", "3 0"], ["osl [123] 0"], "licen"),
    "ms-pl": (["microsoft public", "ms pl"], [], ["ms (?:pl|rl)"], "licen"),
    "apsl": (["apple public source"], ["1 0", "1 1", "2 0"], ["apsl (?:1 [012]|2 0)"], "licen"),
    "upl": (["universal permissive"], ["1 0"], ["upl 1 0"], "licen"),
    "ncsa": (["ncsa", "university of illinois"], [], ["ncsa"], "licen"),
    "cecill": (["cecill"], ["1 0", "2 0", "2 1"], ["cecill(?: [12] [01])?"], "licen"),
    "openrail": (["(?:bigscience |creativeml )?open ?rail(?: m)?"], ["1", "1 0"], ["openrail"], "licen"),
    "llama": (["llama [1234](?: [1234])? community"], [], ["llama [1234](?: [1234])?"], "licen"),
    "cc-by": (["creative commons attribution", "cc by"], ["1 0", "2 0", "2 5", "3 0", "4 0"], ["cc by [1234] [05]"], ""),
    "cc-by-sa": (["creative commons attribution share ?alike", "cc by sa"], ["1 0", "2 0", "2 5", "3 0", "4 0"], ["cc by sa [1234] [05]"], ""),
    "cc-by-nc": (["creative commons attribution non ?commercial", "cc by nc"], ["1 0", "2 0", "2 5", "3 0", "4 0"], ["cc by nc [1234] [05]"], ""),
    "cc-by-nd": (["creative commons attribution no ?derivatives", "cc by nd"], ["1 0", "2 0", "2 5", "3 0", "4 0"], ["cc by nd [1234] [05]"], ""),
    "cc-by-nc-sa": (["creative commons attribution non ?commercial share ?alike", "cc by nc sa"], ["2 0", "2 5", "3 0", "4 0"], ["cc by nc sa [1234] [05]"], ""),
    "cc-by-nc-nd": (["creative commons attribution non ?commercial no ?derivatives", "cc by nc nd"], ["2 0", "2 5", "3 0", "4 0"], ["cc by nc nd [1234] [05]"], ""),
    "cc0": (["creative commons zero", "cc0"], ["1 0"], ["cc0 1 0"], ""),
}

#: label: names that stand for the licence without the noun ("GPL v3", "Apache-2.0 licensed")
SHORT_NAMES = {
    "mit": ["mit(?: x11)?", "expat"], "apache": ["apache(?: software)?", "asf", "asl"], "gpl": ["(?:gnu )?gpl"], "lgpl": ["(?:gnu )?lgpl"],
    "agpl": ["(?:gnu )?agpl"], "fdl": ["(?:gnu )?g?fdl"], "bsd": FAMILIES["bsd"][0], "mpl": ["mpl"], "epl": ["epl"], "eupl": ["eupl"], "cddl": ["cddl"], "cpl": ["cpl"],
    "artistic": ["(?:perl )?artistic"], "isc": ["isc"], "zlib": ["zlib(?: libpng)?"], "busl": ["busl"], "sspl": ["sspl"], "wtfpl": ["wtfpl"], "python": ["psf"],
    "ofl": ["(?:sil )?ofl"], "odbl": ["odbl"], "afl": ["afl"], "osl": ["osl"], "ms-pl": ["ms pl"], "apsl": ["apsl"], "upl": ["upl"], "ncsa": ["ncsa"], "cecill": ["cecill"],
    "openrail": FAMILIES["openrail"][0], "llama": FAMILIES["llama"][0],
}
#: names of products: without the noun they are licences only where something is licensed under them
PRODUCTS = {"php": "php", "ruby": "ruby", "elastic": "elastic", "postgresql": "postgresql", "openssl": "openssl"}
#: labels whose short names mean nothing else: a number behind them is a version even without a mark
ONLY_LICENCES = {"gpl", "lgpl", "agpl", "fdl", "mpl", "eupl", "cddl"}
UNDER = "under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
ANY_VERSION = "(?:(?: (?:version|v))? ?v?[0-9]+(?: [0-9]+)?)?"

#: rules that belong to no family: (label, keyword, regex, priority, confidence)
SINGLE_RULES = [
    ("mit", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy", 1, 0.95),
    ("isc", "without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee", 1, 0.95),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 1, 0.95),
    ("zlib", "as is", "this software is provided as is without any express or implied warranty", 2, 0.7),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it", 1, 0.9),
    ("lgpl", "this library", "this library is free software you can redistribute it and or modify it", 1, 0.9),
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public license", 1, 0.95),
    ("apache", "apache org", "(?:https? )?(?:www )?apache org licenses(?: license 2 0)?", 1, 0.9),
    ("gpl", "gnu org", "(?:https? )?(?:www )?gnu org licenses(?: gpl(?: [23] 0)?)?", 2, 0.8),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1234] [05]", 1, 0.95),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1234] [05]", 1, 0.95),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1234] [05]", 1, 0.95),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1234] [05]", 1, 0.95),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1234] [05]", 1, 0.95),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1234] [05]", 1, 0.95),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0", 1, 0.95),
    ("cc-by-nc", "noncommercial", "attribution noncommercial(?: [1234] [05])?(?: international)?", 2, 0.7),
    ("public-domain", "public domain", "(?:dedicated to|released into|placed in|in) the public domain", 2, 0.7),
    ("proprietary", "all rights reserved", "all rights reserved", 3, 0.4),
    ("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary", 2, 0.6),
    ("proprietary", "may not be", "may not be (?:reproduced|copied|distributed) without(?: prior written)? permission", 2, 0.6),
]


def literal_part(regex: str) -> str:
    """The longest run of plain words that every match of ``regex`` holds ("" if none)."""
    plain = re.sub(r"\(\?:[^()]*\)\??|\[[^]]*\][+*?]?|.\?", "\x00", regex)
    return max((x.strip() for x in plain.split("\x00")), key=len, default="")


def build_rules() -> list[Rule]:
    """The ordered rules: families x templates, then the single rules, then the base phrases."""
    rules: list[Rule] = []

    def add(label, template, anchor, keyword, regex, priority, confidence):
        rules.append(Rule(f"{label}:{template}:{len(rules)}", label, anchor, keyword, regex, priority, confidence))

    for label, (names, versions, ids, family_anchor) in FAMILIES.items():
        noun = " ?licen[cs]e" if family_anchor else "(?: licen[cs]e)?"
        for ident in ids:
            add(label, "identifier", "spdx", "identifier", f"spdx license identifier {ident}", 1, 1.0)
            add(label, "package", "licen", "license", f"license (?:is )?{ident}", 3, 0.6)
        for name in names:
            word = literal_part(name)
            gate = (family_anchor or word, word)
            for v in versions:
                version = f"(?: (?:version|v))? ?v?{v}"
                add(label, "notice", *gate, f"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{name}{noun}{version}", 1, 0.95)
                add(label, "version", *gate, f"{name}{noun}{version}", 2, 0.85)
            add(label, "notice", *gate, f"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{name}{noun}", 2, 0.9)
            add(label, "title", *gate, f"{name}{noun}", 3, 0.6)
    # the noun is left out: gated by the name itself, as "licen" needn't stand in the text
    shorts = [(label, name, FAMILIES[label][1], "(?:licensed|released|distributed|available|published)") for label, names in SHORT_NAMES.items() for name in names]
    for label, name, versions, verb in [*shorts, *[(label, name, [], "licensed") for label, name in PRODUCTS.items()]]:
        word = literal_part(name)
        add(label, "short notice", word, "under", f"{verb} {UNDER}{name}{ANY_VERSION}", 2, 0.9)
        add(label, "licensed", "licen", word, f"{name}{ANY_VERSION} licen[cs]ed", 2, 0.85)
        for v in versions:
            add(label, "marked version", word, v, f"{name}(?: (?:version |v ?){v}| {v} (?:only|or later))(?! [0-9])", 3, 0.6)
            if label in ONLY_LICENCES:
                add(label, "short version", word, v, f"{name} ?{v}(?! [0-9])", 3, 0.6)
    for label, keyword, regex, priority, confidence in SINGLE_RULES:
        add(label, "text", keyword, keyword, f"(?:{regex})", priority, confidence)
    for phrase, label in BASE_PHRASES.items():
        rules.append(Rule(f"base:{label}", label, "licen", phrase, phrase, 4, 0.5, base=True))
    return rules


RULES = build_rules()


def _rule_literal(rules: list[Rule]) -> Column:
    rows = [
        {"label": r.label, "anchor": r.anchor, "keyword": r.keyword, "regex": f"(?<![^ ])(?:{r.regex})(?![^ ])",
         "priority": r.priority, "confidence": r.confidence, "base": r.base}
        for r in rules
    ]
    kind = "array<struct<label:string,anchor:string,keyword:string,regex:string,priority:int,confidence:double,base:boolean>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)  # a constant: folded once


def scan_licenses(docs: DataFrame, text: str = "text", out: str = "_license", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with a struct ``out``: counts, base places, labels, score and the kept detections."""
    rules = RULES if rules is None else rules
    n_priorities = max([r.priority for r in rules], default=1)
    d, names = shield(docs)
    norm = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col(names[text]), F.lit(""))), NON_WORD, " "))
    anchors = F.array(*[F.lit(k) for k in sorted({r.anchor for r in rules})]).cast("array<string>")
    d = d.withColumn("_th_n", norm)
    d = d.withColumn("_th_k", F.filter(anchors, lambda k: F.contains(F.col("_th_n"), k)))
    gated = F.filter(
        _rule_literal(rules),
        lambda r: F.array_contains(F.col("_th_k"), r["anchor"])
        & F.contains(F.col("_th_n"), r["keyword"])
        & F.rlike(F.col("_th_n"), r["regex"]),
    )
    # the marks: each match starts a word with OPEN and ends a word with CLOSE
    marked = F.transform(
        gated,
        lambda r: F.struct(r.alias("r"), F.split(F.regexp_replace(F.col("_th_n"), r["regex"], F.lit(f"{OPEN}$0{CLOSE}")), " ").alias("w")),
    )
    places = F.transform(
        marked,
        lambda m: F.transform(
            F.arrays_zip(
                F.filter(F.transform(m["w"], lambda x, i: F.when(x.startswith(OPEN), i)), lambda x: x.isNotNull()).alias("a"),
                F.filter(F.transform(m["w"], lambda x, i: F.when(x.endswith(CLOSE), i)), lambda x: x.isNotNull()).alias("b"),
            ),
            lambda p: F.struct(
                p["a"].alias("first"), (-p["b"]).alias("neg_last"), m["r"]["priority"].alias("priority"),
                m["r"]["label"].alias("label"), m["r"]["confidence"].alias("confidence"), m["r"]["base"].alias("base"),
            ),
        ),
    )
    kind = "array<struct<first:int,neg_last:int,priority:int,label:string,confidence:double,base:boolean>>"
    d = d.withColumn(
        "_th_d",
        F.when((F.size("_th_k") > 0) & F.col("_th_n").isNotNull(), F.sort_array(F.flatten(places))).otherwise(F.array().cast(kind)).cast(kind),
    )
    # sweep in order of start, longer first: per priority the furthest end so far. Appending copies an array, so
    # the kept ones are gathered in pieces of CHUNK detections and the pieces joined at the end
    no_ends, none = F.array_repeat(F.lit(-1), n_priorities), F.array().cast(kind)

    def step(acc: Column, x: Column) -> Column:
        covered = F.array_max(F.slice(acc["ends"], F.lit(1), x["priority"])) >= -x["neg_last"]
        ends = F.transform(acc["ends"], lambda e, i: F.when(i + 1 == x["priority"], F.greatest(e, -x["neg_last"])).otherwise(e))
        return F.struct(ends.alias("ends"), F.when(covered, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(x))).alias("kept"))

    def piece(acc: Column, at: Column) -> Column:
        empty = F.struct(acc["ends"].alias("ends"), none.alias("kept"))
        one = F.aggregate(F.slice(F.col("_th_d"), at + 1, F.lit(CHUNK)), empty, step)
        # a lambda over one element names the result, which would be computed twice otherwise
        return F.get(
            F.transform(F.array(one), lambda r: F.struct(r["ends"].alias("ends"), F.concat(acc["pieces"], F.array(r["kept"])).alias("pieces"))), F.lit(0)
        )

    starts = F.when(F.size("_th_d") > 0, F.sequence(F.lit(0), F.size("_th_d") - 1, F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
    begin = F.struct(no_ends.alias("ends"), F.array().cast(f"array<{kind}>").alias("pieces"))
    swept = F.aggregate(starts, begin, piece, lambda acc: F.flatten(acc["pieces"]))
    base = F.filter("_th_d", lambda x: x["base"])
    d = d.withColumn("_th_kept", swept).withColumn("_th_base", base)
    b, kept = F.col("_th_base"), F.col("_th_kept")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base_labels = F.transform(b, lambda x: x["label"])
    result = F.struct(
        F.when(F.col("_th_n") == "", F.lit(0)).otherwise(F.size(F.split("_th_n", " "))).cast("long").alias("n_words"),
        F.size(b).cast("long").alias("n_base"),
        F.array_min(F.transform(b, lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(b, lambda x: x["first"])).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform(kept, lambda x: x["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda x: x["confidence"])), F.lit(0.0)).alias("score"),
        F.transform(
            kept, lambda x: F.struct(x["label"].alias("label"), x["first"].alias("first_word"), (-x["neg_last"]).alias("last_word"), x["priority"].alias("priority"))
        ).alias("detections"),
    )
    return with_result(d, own_columns(names, out), result, out)
