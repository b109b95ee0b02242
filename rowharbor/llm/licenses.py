"""License detection by ordered signature rules over the words of whole texts.

A text is reduced to its words (A-Z in lower case, single blanks between). Rules are regular expressions over those
words, written per license as ways of naming it and per statement as ways of granting it; each has a label, a priority and a
weight. A rule is tried only where one of the keywords of its license stands in the text, at the start of a word; no rule
matches without. Every place where a rule matches is a detection from word to word; a detection inside another one of higher priority, or of equal priority and greater
length, is suppressed. What is left gives the labels and the score. The base phrases are never suppressed.

Everything is SQL expressions in one pass over the documents, without a shuffle.

Defined cases: a NULL or empty text has no words, no places, empty labels and score 0; NULL ids are kept; repeated rows give repeated
results; of detections with equal span and priority the label first in the alphabet stays; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.native_text import lower_ascii, spans_of

#: Phrases and the labels they stand for.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: License, keywords of which one must be present from the start of a word on, and ways of naming it in words. Each way holds a keyword.
NAMES = {
    "0bsd": (["0bsd", "zero clause"], ["0bsd", "bsd zero clause", "zero clause bsd"]),
    "afl-3.0": (["afl", "academic free"], ["afl(?: v)? ?3(?: 0)?", "academic free license(?: version| v)? ?3(?: 0)?"]),
    "agpl-3.0": (["agpl", "affero"], ["agpl ?v?3(?: 0)?(?: only| or later)?", "gnu affero general public license(?: as published by the free software foundation)?(?:(?: version| v)? ?3)?"]),
    "apache-1.1": (["apache"], ["apache(?: software)? license(?: version| v)? ?1 1", "apache 1 1"]),
    "apache-2.0": (["apache", "asl 2", "asl2"], ["apache(?: software)? license(?: version| v)? ?2(?: 0)?", "apache ?2(?: 0)?", "asl ?2(?: 0)?"]),
    "artistic-2.0": (["artistic"], ["artistic license(?: version| v)?(?: ?2(?: 0)?)?", "artistic 2(?: 0)?"]),
    "beerware": (["beerware", "beer ware"], ["beer ?ware(?: license)?"]),
    "bsd-2-clause": (["bsd", "freebsd"], ["bsd 2 clause", "2 clause bsd", "two clause bsd", "simplified bsd", "freebsd license"]),
    "bsd-3-clause": (["bsd"], ["bsd 3 clause", "3 clause bsd", "three clause bsd", "new bsd", "modified bsd", "revised bsd"]),
    "bsd-4-clause": (["bsd"], ["bsd 4 clause", "4 clause bsd", "four clause bsd", "original bsd"]),
    "bsl-1.0": (["boost", "bsl"], ["boost software license(?:(?: version| v)? ?1(?: 0)?)?", "bsl 1 0"]),
    "busl-1.1": (["business source", "busl"], ["business source license(?:(?: version| v)? ?1 1)?", "busl 1 1"]),
    "cc0-1.0": (["cc0", "creative commons zero"], ["cc0(?: 1 0)?(?: universal)?", "creative commons zero(?: v?1 0)?"]),
    "cc-by": (["cc by", "creative commons"], ["cc by(?: [1-4] [05])?", "creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?"]),
    "cc-by-nc": (["cc by nc", "creative commons"], ["cc by nc(?: [1-4] [05])?", "creative commons attribution non ?commercial(?: [1-4] [05])?(?: international)?"]),
    "cc-by-nc-nd": (["cc by nc nd", "creative commons"], ["cc by nc nd(?: [1-4] [05])?", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"]),
    "cc-by-nc-sa": (["cc by nc sa", "creative commons"], ["cc by nc sa(?: [1-4] [05])?", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"]),
    "cc-by-nd": (["cc by nd", "creative commons"], ["cc by nd(?: [1-4] [05])?", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"]),
    "cc-by-sa": (["cc by sa", "creative commons"], ["cc by sa(?: [1-4] [05])?", "creative commons attribution share ?alike(?: [1-4] [05])?(?: international)?"]),
    "cddl-1.0": (["cddl", "common development"], ["cddl(?: 1 [01])?", "common development and distribution license(?:(?: version| v)? ?1 [01])?"]),
    "cecill-2.1": (["cecill"], ["cecill(?: [bc])?(?:(?: version| v)? ?2 1)?"]),
    "cpal-1.0": (["cpal", "common public"], ["cpal(?: 1 0)?", "common public attribution license(?: 1 0)?"]),
    "ecl-2.0": (["ecl", "educational community"], ["ecl 2 0", "educational community license(?: 2 0)?"]),
    "epl-2.0": (["epl", "eclipse"], ["epl(?: v)? ?[12](?: 0)?", "eclipse public license(?:(?: version| v)? ?[12](?: 0)?)?"]),
    "eupl-1.2": (["eupl", "european union"], ["eupl(?:(?: v)? ?1 [12])?", "european union public licen[cs]e(?:(?: version| v)? ?1 [12])?"]),
    "fdl-1.3": (["gfdl", "gnu free documentation"], ["gfdl(?: 1 [23])?", "gnu free documentation license(?:(?: version| v)? ?1 [23])?"]),
    "gpl": (["gpl", "gnu general"], ["gpl", "gnu general public license"]),
    "gpl-2.0": (["gpl", "gnu general"], ["gpl ?v?2(?: 0)?(?: only| or later)?", "gnu general public license(?: as published by the free software foundation)?(?: version| v)? ?2(?: 0)?"]),
    "gpl-3.0": (["gpl", "gnu general"], ["gpl ?v?3(?: 0)?(?: only| or later)?", "gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?"]),
    "isc": (["isc", "internet systems"], ["isc(?: license)?", "internet systems consortium license"]),
    "lgpl-2.1": (["lgpl", "lesser general", "library general"], ["lgpl ?v?2(?: [01])?(?: only| or later)?", "gnu (?:lesser|library) general public license(?:(?: version| v)? ?2(?: [01])?)?"]),
    "lgpl-3.0": (["lgpl", "lesser general"], ["lgpl ?v?3(?: 0)?(?: only| or later)?", "gnu lesser general public license(?: version| v)? ?3(?: 0)?"]),
    "lppl-1.3": (["lppl", "latex project"], ["lppl(?: 1 3)?c?", "latex project public license(?:(?: version| v)? ?1 3)?"]),
    "mit": (["mit", "expat"], ["mit", "mit x11", "expat"]),
    "mpl-1.1": (["mpl", "mozilla"], ["mpl ?v?1 1", "mozilla public license(?: version| v)? ?1 1"]),
    "mpl-2.0": (["mpl", "mozilla"], ["mpl ?v?2(?: 0)?", "mozilla public license(?: version| v)? ?2(?: 0)?"]),
    "ms-pl": (["ms pl", "microsoft public"], ["ms pl", "microsoft public license"]),
    "ncsa": (["ncsa"], ["ncsa(?: open source)?", "university of illinois ncsa"]),
    "odbl-1.0": (["odbl", "open database", "open data base"], ["odbl(?: 1 0)?", "open data ?base license(?:(?: version| v)? ?1(?: 0)?)?"]),
    "ofl-1.1": (["ofl 1 1", "open font"], ["sil open font license(?:(?: version| v)? ?1 1)?", "ofl 1 1"]),
    "osl-3.0": (["osl 3 0", "open software"], ["osl 3 0", "open software license(?:(?: version| v)? ?3(?: 0)?)?"]),
    "php-3.01": (["php"], ["php license(?:(?: version| v)? ?3 01)?", "php 3 01"]),
    "postgresql": (["postgresql"], ["postgresql(?: license)?"]),
    "psf-2.0": (["psf", "python software"], ["psf(?: license)?(?: 2(?: 0)?)?", "python software foundation license(?:(?: version| v)? ?2)?"]),
    "sspl-1.0": (["sspl", "server side"], ["sspl(?: ?v?1(?: 0)?)?", "server side public license(?:(?: version| v)? ?1)?"]),
    "unlicense": (["unlicense"], ["unlicense"]),
    "upl-1.0": (["upl", "universal permissive"], ["upl(?: 1 0)?", "universal permissive license(?:(?: version| v)? ?1(?: 0)?)?"]),
    "wtfpl": (["wtfpl", "do what the"], ["wtfpl(?: ?v?2)?", "do what the f[a-z]* you want to public license"]),
    "zlib": (["zlib"], ["zlib(?: libpng)?"]),
    "zpl-2.1": (["zpl", "zope"], ["zpl 2 1", "zope public license(?:(?: version| v)? ?2 1)?"]),
}

#: Ways of granting a license, from the surest to the weakest: weight and pattern.
STATEMENTS = [
    (1.0, "spdx license identifier {name}"),
    (0.95, "(?:licensed|released|distributed|available|published|provided|redistributed|covered|offered) under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?"),
    (0.9, "(?:under|by) the (?:terms of the )?(?:conditions of the )?{name}(?: licen[cs]e)?"),
    (0.85, "licen[cs]ed? (?:is |as |type |text )?(?:the )?{name}"),
    (0.7, "{name} licen[cs]ed?"),
]

#: Wordings of license texts themselves, which name no license: label, keyword, priority and pattern.
WORDINGS = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd-3-clause", "neither the name", "redistribution and use in source and binary forms(?: [^ ]+){1,120} neither the name"),
    ("gpl", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("zlib", "provided as is without", "this software is provided as is without any express or implied warranty"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("public-domain", "public domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("no-commercial-use", "commercial", "(?:not for|no|non) commercial use"),
]

FAMILY = "array<struct<label:string,keywords:array<string>,rules:array<struct<priority:int,weight:double,pattern:string>>>>"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _whole_words(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def rule_table() -> list[dict]:
    """Every license with its keywords and its rules, one per name and statement."""
    families = []
    for label, (keywords, names) in NAMES.items():
        rules = [
            {"priority": len(STATEMENTS) - i, "weight": weight, "pattern": _whole_words(statement.format(name=f"(?:{name})(?: international| unported| generic)?"))}
            for name in names
            for i, (weight, statement) in enumerate(STATEMENTS)
        ]
        families.append({"label": label, "keywords": keywords, "rules": rules})
    for label, keyword, pattern in WORDINGS:
        families.append({"label": label, "keywords": [keyword], "rules": [{"priority": len(STATEMENTS) + 1, "weight": 0.9, "pattern": _whole_words(pattern)}]})
    return families


def keyword_pattern() -> str:
    """A keyword of any license after a blank. Alternatives share their first letter, as most words start with none or few of them."""
    by_letter: dict[str, set[str]] = {}
    for keyword in (k for f in rule_table() for k in f["keywords"]):
        by_letter.setdefault(keyword[0], set()).add(keyword[1:])
    return f" (?:{'|'.join(f'{first}(?:{"|".join(sorted(rests))})' for first, rests in sorted(by_letter.items()))})"


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _last(pieces: Column) -> Column:
    return F.element_at(pieces, -1)


def detections(words: Column) -> Column:
    """All detections ``struct<start, stop, priority, weight, label>``; words from 0, ``stop`` exclusive."""
    families = F.from_json(F.lit(json.dumps(rule_table())), FAMILY)
    tried = F.filter(families, lambda f: F.exists(f["keywords"], lambda k: F.contains(words, F.concat(F.lit(" "), k))))

    def of_rule(label: Column, rule: Column) -> Column:
        spans = F.when(F.regexp_like(words, rule["pattern"]), spans_of(words, rule["pattern"], _blanks))
        return F.transform(
            F.coalesce(spans, F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")),
            lambda s: F.struct(
                (s["start"] - 1).alias("start"), s["end"].alias("stop"), rule["priority"].alias("priority"), rule["weight"].alias("weight"), label.alias("label")
            ),
        )

    per_family = F.transform(tried, lambda f: F.flatten(F.transform(f["rules"], lambda r: of_rule(f["label"], r))))
    return F.array_distinct(F.flatten(per_family))


def unsuppressed(found: Column) -> Column:
    """The detections that lie in no other one of more weight in the order of rules."""

    def beats(b: Column, a: Column) -> Column:
        covers = (b["start"] <= a["start"]) & (b["stop"] >= a["stop"])
        longer = (b["stop"] - b["start"]) > (a["stop"] - a["start"])
        same = (b["stop"] - b["start"]) == (a["stop"] - a["start"])
        equal = b["priority"] == a["priority"]
        return covers & ((b["priority"] > a["priority"]) | (equal & longer) | (equal & same & (b["label"] < a["label"])))

    return F.filter(found, lambda a: ~F.exists(found, lambda b: beats(b, a)))


def detect_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections`` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(text), NOT_WORD, " ")), F.lit(" "))
    base = docs.select("doc_id", words.alias("words"))
    # One blank before every word and one at the end; without words there are two.
    n_words = F.when(F.col("words") == "  ", F.lit(0)).otherwise(_blanks(F.col("words")) - 1).cast("bigint")
    places = [F.when(F.contains("words", F.lit(f" {p} ")), F.split("words", _whole_words(p), -1)).otherwise(F.array("words")).alias(f"p{i}") for i, p in enumerate(BASE_PHRASES)]
    base = base.select("doc_id", n_words.alias("n_words"), "words", *places)
    # What :func:`detections` asks first, in generated code: without a keyword of any license nothing is found.
    any_keyword = F.regexp_like(F.col("words"), F.lit(keyword_pattern()))
    base = base.withColumn("found", F.when(any_keyword, detections(F.col("words"))).otherwise(F.array()))
    base = base.withColumn("detections", unsuppressed(F.col("found")))
    count, first, last, labels = [], [], [], []
    for i, (phrase, label) in enumerate(BASE_PHRASES.items()):
        pieces = F.col(f"p{i}")
        n = F.size(pieces).cast("bigint") - 1
        count.append(n)
        first.append(F.when(n > 0, _blanks(pieces[0]) - 1))
        # The last piece starts with the blank after the phrase and has one blank per word more.
        last.append(F.when(n > 0, F.col("n_words") - _blanks(_last(pieces)) + 1 - len(phrase.split())))
        labels.append(F.when(n > 0, F.lit(label)))
    base_labels = F.array_compact(F.array(*labels))
    all_labels = F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("detections", lambda d: d["label"]))))
    weight = F.array_max(F.transform("detections", lambda d: d["weight"]))
    return base.select(
        "doc_id",
        "n_words",
        sum(count[1:], count[0]).alias("n_base"),
        F.least(*first).alias("first_word"),
        F.greatest(*last).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(F.coalesce(weight, F.lit(0.0))).alias("score"),
        "detections",
    )
