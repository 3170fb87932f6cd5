"""License scans by ordered signature rules.

Rules are regular expressions over a text's plain words (lower case, one blank
between words). A rule is tried only on texts that hold its keywords; detections
that lie inside others, and the weaker of two that overlap, are suppressed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contestry.llm.columns import only, plain_words, whole_text
from contestry.session import materialize


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, str]  # plain words that every match holds; the second may be empty
    pattern: str  # over plain words, from the start of a word to the end of one
    priority: int  # of overlapping detections the one with the higher priority stays
    score: float  # how sure a match is, 0 to 1
    base: bool = False


#: label: names in plain words
FAMILIES = {
    "mit": ("mit", "expat"),
    "apache": ("apache", "apache software"),
    "gpl": ("gnu general public", "gpl", "gnu gpl"),
    "lgpl": ("gnu lesser general public", "lesser general public", "library general public", "lgpl"),
    "agpl": ("gnu affero general public", "affero general public", "agpl"),
    "bsd": ("bsd", "berkeley software distribution"),
    "mpl": ("mozilla public", "mpl"),
    "epl": ("eclipse public", "epl"),
    "cddl": ("common development and distribution", "cddl"),
    "cpl": ("common public",),
    "isc": ("isc", "internet systems consortium"),
    "zlib": ("zlib", "zlib libpng"),
    "boost": ("boost software", "bsl"),
    "artistic": ("artistic", "perl artistic"),
    "python": ("python software foundation", "psf"),
    "openssl": ("openssl",),
    "ofl": ("sil open font", "open font", "ofl"),
    "eupl": ("european union public", "eupl"),
    "ms-pl": ("microsoft public", "ms pl"),
    "ms-rl": ("microsoft reciprocal", "ms rl"),
    "cecill": ("cecill",),
    "postgresql": ("postgresql",),
    "zpl": ("zope public", "zpl"),
    "ncsa": ("university of illinois ncsa open source", "ncsa"),
    "afl": ("academic free", "afl"),
    "osl": ("open software", "osl"),
    "qpl": ("q public", "qpl"),
    "php": ("php",),
    "ruby": ("ruby",),
    "vim": ("vim",),
    "tcl": ("tcl tk", "tcl"),
    "x11": ("x11",),
    "unlicense": ("the unlicense", "unlicense"),
    "wtfpl": ("wtfpl",),
    "fdl": ("gnu free documentation", "gfdl"),
    "odbl": ("open database", "odbl"),
    "cc0": ("cc0", "creative commons zero"),
    "cc-by": ("cc by", "creative commons attribution"),
    "cc-by-sa": ("cc by sa", "creative commons attribution sharealike"),
    "cc-by-nc": ("cc by nc", "creative commons attribution noncommercial"),
    "cc-by-nd": ("cc by nd", "creative commons attribution noderivatives"),
    "cc-by-nc-sa": ("cc by nc sa", "creative commons attribution noncommercial sharealike"),
    "cc-by-nc-nd": ("cc by nc nd", "creative commons attribution noncommercial noderivatives"),
}
#: a version after a name or joined to it
_VERSION = r"(?:(?: version | v| |v|)[0-9]+(?: [0-9]+)*(?: or later| only)?)?"
#: words between a name and "license"
_BETWEEN = r"(?: (?:[0234]|zero|two|three|four) clause| new| modified| simplified| revised| original| style| type| software)?"
_NAME = "{name}" + _BETWEEN + _VERSION
_AFTER = _NAME + r"(?: licen[sc]e)?" + _VERSION
#: what stands around a name: keyword, pattern, priority, score
PHRASES = (
    ("spdx", r"spdx licen[sc]e identifier " + _NAME, 100, 1.0),
    ("licensed", r"(?:dual )?licensed under (?:the |a |an )?(?:terms of the )?" + _AFTER, 90, 0.95),
    ("under", r"(?:released|distributed|published|provided) under (?:the |a |an )?(?:terms of the )?" + _AFTER, 85, 0.9),
    ("terms of", r"terms of (?:the )?" + _AFTER, 80, 0.8),
    ("license", r"licen[sc]e " + _NAME, 60, 0.7),
    ("licen", _NAME + r" licen[sc]e" + _VERSION, 70, 0.75),
)
_GPL_NOTICE = "is free software you can redistribute it and or modify it under the terms of the gnu {} public license"
_GPL_WARRANTY = "merchantability or fitness for a particular purpose see the gnu {} public license"
_BINARY = "redistributions in binary form must reproduce the above copyright notice"
#: label, phrase: what stands in the body or the notice of a license
BODIES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", _BINARY),
    (
        "bsd-2-clause",
        _BINARY + " this list of conditions and the following disclaimer in the documentation and or other"
        " materials provided with the distribution this software is provided by",
    ),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org"),
    ("gpl", _GPL_NOTICE.format("general")),
    ("lgpl", _GPL_NOTICE.format("lesser general")),
    ("lgpl", _GPL_NOTICE.format("library general")),
    ("agpl", _GPL_NOTICE.format("affero general")),
    ("gpl", _GPL_WARRANTY.format("general")),
    ("lgpl", _GPL_WARRANTY.format("lesser general")),
    ("lgpl", _GPL_WARRANTY.format("library general")),
    ("agpl", _GPL_WARRANTY.format("affero general")),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
_YEARS = "(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])*"
#: other statements
STATEMENTS = (
    Rule("all-rights-reserved", ("all rights reserved", ""), "all rights reserved", 50, 0.6),
    Rule("public-domain", ("public domain", ""), r"(?:released |dedicated )?(?:in|into|to) the public domain", 50, 0.7),
    Rule("public-domain", ("public domain", ""), "public domain dedication", 55, 0.8),
    Rule("copyright", ("copyright", ""), "copyright (?:c |© ?)?" + _YEARS, 40, 0.4),
    Rule("copyright", ("©", ""), "© ?(?:copyright )?" + _YEARS, 40, 0.4),
    Rule(
        "bsd-3-clause",
        ("neither the name of", "names of its contributors may be used to endorse or promote"),
        "neither the name of(?: [^ ]+){1,16} nor the names of its contributors may be used to endorse or promote products",
        95,
        0.95,
    ),
    Rule("proprietary", ("proprietary", ""), r"proprietary (?:and confidential|software|licen[sc]e)", 50, 0.6),
)
#: label: phrase
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def default_rules() -> list[Rule]:
    """Base phrases, one rule for each family, name and phrase, bodies and statements."""
    named = [
        Rule(label, (keyword, name), pattern.replace("{name}", name), priority, score)
        for label, names in FAMILIES.items()
        for name in names
        for keyword, pattern, priority, score in PHRASES
    ]
    base = [Rule(label, (phrase, ""), phrase, 65, 0.75, True) for label, phrase in BASE.items()]
    bodies = [Rule(label, (phrase, ""), phrase, 95, 0.95) for label, phrase in BODIES]
    return base + named + bodies + list(STATEMENTS)


#: a text without any of these holds no match of ``default_rules``
GATE = ("licens", "licenc", "spdx", " under ", "terms of", "rights reserved", "public domain", "copyright", "proprietary")
GATE += ("hereby granted", "redistributi", "advertising materials", "neither the name of", "free software", "fitness for a particular", "without any express", "©")

_OPEN, _CLOSE = "\x01", "\x02"


def scan_words(docs: DataFrame, gate: tuple[str, ...] = GATE) -> DataFrame:
    """(_row, doc_id, n_words, words) of every row; words only if the text passes the gate."""
    words = plain_words(whole_text("text"))
    blanks = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    gated = F.col("words").rlike("|".join(gate)) if gate else F.lit(True)
    rows = only(docs, doc_id="doc_id", text="text").select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", words.alias("words")
    )
    return rows.select(
        "_row",
        "doc_id",
        F.when(F.col("words") == " ", F.lit(0)).otherwise(blanks - 1).cast("long").alias("n_words"),
        F.when(gated, F.col("words")).alias("words"),
    )


def detections(scanned: DataFrame, rules: list[Rule]) -> DataFrame:
    """(_row, rule, first, last, label, priority, score, base): every match of every
    rule, with its first and last word counted from 0. Matches of one rule don't overlap."""
    table = F.array(
        *(
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(f" {r.keywords[0]}").alias("keyword"),
                F.lit(f" {r.keywords[1]}").alias("name"),
                F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.score).alias("score"),
                F.lit(r.base).alias("base"),
            )
            for i, r in enumerate(rules)
        )
    )
    holds = lambda word: F.contains(F.col("words"), word)
    tried_on = lambda r: holds(r["keyword"]) & holds(r["name"])
    tried = (
        scanned.filter(F.col("words").isNotNull())
        .select("_row", "words", F.explode(F.filter(table, tried_on)).alias("r"))
        .select("_row", "r", F.regexp_replace("words", F.col("r.pattern"), F.lit(f"{_OPEN}$0{_CLOSE}")).alias("marked"))
        .filter(F.contains("marked", F.lit(_OPEN)))
        .select("_row", "r", F.split(F.substring("marked", 2, 2**31 - 1), " ").alias("marked"))
    )
    opens = _places(F.col("marked"), lambda w: F.startswith(w, F.lit(_OPEN)))
    closes = _places(F.col("marked"), lambda w: F.endswith(w, F.lit(_CLOSE)))
    placed = tried.select("_row", "r", opens.alias("first"), closes.alias("last"))
    return (
        placed.select("_row", "r", F.explode(F.arrays_zip("first", "last")).alias("at"))
        .select(
            "_row", F.col("at.first").cast("long").alias("first"), F.col("at.last").cast("long").alias("last"), "r.*"
        )
        .drop("keyword", "name", "pattern")
    )


def _places(words: Column, holds) -> Column:
    at = F.transform(words, lambda w, i: F.when(holds(w), i).otherwise(F.lit(-1)))
    return F.filter(at, lambda i: i >= 0)


def suppressed(found: DataFrame) -> DataFrame:
    """The detections that stay.

    First those go that lie inside a longer one, or inside an equal one of higher
    priority (then: of an earlier rule). What is left has rising starts and ends;
    of those, one goes if a neighbour that it overlaps has a higher priority.
    Both steps run over a text's detections in order; none gathers them.
    """
    text = Window.partitionBy("_row")
    inside = text.orderBy("first", F.desc("last"), F.desc("priority"), "rule").rowsBetween(
        Window.unboundedPreceding, -1
    )
    outer = found.withColumn("_reach", F.max("last").over(inside)).filter(
        F.col("_reach").isNull() | (F.col("_reach") < F.col("last"))
    )
    in_order = text.orderBy("first")
    before, after = (lambda c: F.lag(c).over(in_order)), (lambda c: F.lead(c).over(in_order))
    weaker = (
        ((before("last") >= F.col("first")) & (before("priority") > F.col("priority")))
        | ((after("first") <= F.col("last")) & (after("priority") > F.col("priority")))
    )
    return outer.withColumn("_weaker", F.coalesce(weaker, F.lit(False))).filter("NOT _weaker").drop("_reach", "_weaker")


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (rows with n_words, all detections, detections that stay).

    Null texts count as empty and have no words. A row's detections are found by
    ``_row``, so repeated ids don't mix.
    """
    custom = rules is not None
    scanned = materialize(scan_words(docs, () if custom else GATE), "license-words")
    found = materialize(detections(scanned, rules or default_rules()), "license-matches")
    return scanned.drop("words"), found, materialize(suppressed(found), "licenses")


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of
    every row. Labels are distinct and sorted, and empty where there are none; the
    score is that of the surest detection that stays, or 0."""
    rows, found, stay = scan_licenses(docs)
    base = found.filter("base").groupBy("_row").agg(
        F.count("*").alias("n_base"),
        F.min("first").alias("first_word"),
        F.max("first").alias("last_word"),
        F.collect_set("label").alias("base_set"),
    )
    own = stay.groupBy("_row").agg(F.collect_set("label").alias("own_set"), F.max("score").alias("score"))
    none = F.array().cast("array<string>")
    base_set, own_set = F.coalesce("base_set", none), F.coalesce("own_set", none)
    return (
        rows.join(base, "_row", "left")
        .join(own, "_row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            "first_word",
            "last_word",
            F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(base_set, own_set)), ",").alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
