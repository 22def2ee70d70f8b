"""License scan: ordered signature rules behind a keyword gate.

The text is reduced to its words with one space between. Rows that hold none of the keywords
are done. Of the other rows every rule runs whose own keyword occurs. Its matches are intervals of
characters; an interval inside another of the same or a higher priority is suppressed (of equal
intervals the first rule stays). All of it is one expression per row: no shuffle, no Python.

Contract: null text counts as empty: no words, no labels, score 0, null places. Every row gives a
row; repeated rows repeat; empty tables give empty results; long texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.spans import gathered, once, spans

# What is not part of a word, and the base phrases with their labels.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Families: label, the keyword that gates the rules (the beginning of a word or of several), and the
# words of the name.
FAMILIES = (
    ("gpl", "gnu", "gnu general public licen[sc]e"),
    ("gpl", "gpl", "gpl"),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public licen[sc]e"),
    ("lgpl", "lgpl", "lgpl"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e"),
    ("agpl", "agpl", "agpl"),
    ("gfdl", "gnu", "gnu free documentation licen[sc]e"),
    ("apache", "apache", "apache(?: software)? licen[sc]e"),
    ("mit", "mit licen", "mit licen[sc]e"),
    ("mit", "mit x11", "mit x11 licen[sc]e"),
    ("bsd", "bsd", "(?:(?:0|1|2|3|4) clause )?bsd(?: (?:0|1|2|3|4) clause)?(?: licen[sc]e)?"),
    ("mpl", "mozilla", "mozilla public licen[sc]e"),
    ("mpl", "mpl", "mpl"),
    ("epl", "eclipse", "eclipse public licen[sc]e"),
    ("cddl", "distribution", "common development and distribution licen[sc]e"),
    ("cpl", "common", "common public licen[sc]e"),
    ("eupl", "european", "european union public licen[sc]e"),
    ("artistic", "artistic", "artistic licen[sc]e"),
    ("boost", "boost", "boost software licen[sc]e"),
    ("isc", "isc", "isc licen[sc]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("python", "python", "(?:psf|python(?: software foundation)?) licen[sc]e"),
    ("ofl", "ofl", "(?:sil )?(?:open font licen[sc]e|ofl)"),
    ("cc-by", "cc", "cc by"),
    ("cc-by-sa", "cc", "cc by sa"),
    ("cc-by-nc", "cc", "cc by nc"),
    ("cc-by-nd", "cc", "cc by nd"),
    ("cc-by-nc-sa", "cc", "cc by nc sa"),
    ("cc-by-nc-nd", "cc", "cc by nc nd"),
    ("cc0", "cc0", "cc0"),
    ("cc-by", "creative", "creative commons attribution"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("odbl", "database", "open (?:data ?commons open )?database licen[sc]e"),
    ("upl", "universal", "universal permissive licen[sc]e"),
    ("afl", "academic", "academic free licen[sc]e"),
    ("osl", "open", "open software licen[sc]e"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e"),
)
# Identifiers: label, keyword and words of short names that are too common to stand alone; they count behind
# an SPDX tag (gated by "spdx") and behind "licensed under" and the like.
IDENTIFIERS = (
    ("apache", "apache", r"apache(?: version)? v?(?:1 [01]|2(?: 0)?)(?! \d)"),
    ("mit", "mit ", "mit(?: 0)?"),
    ("isc", "isc ", "isc"),
    ("zlib", "zlib", "zlib"),
    ("epl", "epl ", "epl"),
    ("cddl", "cddl ", "cddl"),
    ("cpl", "cpl ", "cpl"),
    ("eupl", "eupl ", "eupl"),
    ("gfdl", "gfdl ", "gfdl"),
    ("artistic", "artistic", r"artistic [12] 0"),
    ("boost", "bsl ", "bsl 1 0"),
    ("python", "psf ", "psf"),
    ("python", "python 2 0", r"python 2 0(?: \d)?(?! \d)"),
    ("odbl", "odbl ", "odbl"),
    ("upl", "upl ", "upl"),
    ("afl", "afl ", "afl"),
    ("osl", "osl ", "osl"),
    ("ms-pl", "ms pl ", "ms pl"),
)
# Forms around a name: priority (higher wins), what stands before and after the name. Longer first.
VERSION = r"(?:,? ?(?:version|v|ver|release))? ?\d+(?: \d+){0,2}"
FORMS = (
    (5, r"spdx licen[sc]e identifier ", r"(?: %s)?(?: (?:only|or later))?" % VERSION),
    (4, r"(?:is |are |was |were )?(?:licen[sc]ed|released|distributed|published|made available|available|provided) (?:under|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", r" %s(?: or(?: \(?at your option\)?)? (?:any )?later(?: version)?)?(?: only| unported| international)?" % VERSION),
    (3, r"(?:is |are |was |were )?(?:licen[sc]ed|released|distributed|published|made available|available|provided) (?:under|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", r""),
    (2, r"", r" %s" % VERSION),
    (1, r"", r""),
)
# Whole-sentence signatures without a family name.
SENTENCES = (
    (4, "mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    (4, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    (4, "gpl", "free", "this program is free software you can redistribute it and or modify it"),
    (4, "lgpl", "free", "this library is free software you can redistribute it and or modify it"),
    (4, "isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    (4, "zlib", "implied", "this software is provided as is without any express or implied warranty"),
    (4, "boost", "boost", "boost software license version 1 0 august 17th 2003"),
    (4, "unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    (3, "public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    (3, "proprietary", "reserved", "all rights reserved"),
    (3, "proprietary", "confidential", "proprietary and confidential"),
)
# How sure a detection of a priority is.
WEIGHTS = (0.0, 0.5, 0.7, 0.8, 0.9, 1.0)

_FOUND = "array<struct<start:bigint,past:bigint,priority:int,order:int,label:string>>"


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern), in the order that decides between equal intervals."""
    named = [
        (priority, label, keyword, f"(?i)(?<= ){before}{name}{after}(?= )")
        for priority, before, after in FORMS
        for label, keyword, name in FAMILIES
    ]
    short = [
        (priority, label, "spdx" if priority == 5 else keyword, f"(?i)(?<= ){before}{name}{after}(?= )")
        for priority, before, after in FORMS
        if priority >= 3
        for label, keyword, name in IDENTIFIERS
    ]
    return named + short + [(p, label, keyword, f"(?i)(?<= ){words}(?= )") for p, label, keyword, words in SENTENCES]


def _rules_column() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(priority).alias("priority"), F.lit(order).alias("order"), F.lit(label).alias("label"),
                F.lit(keyword).alias("keyword"), F.lit(pattern).alias("pattern"),
            )
            for order, (priority, label, keyword, pattern) in enumerate(rules())
        ]
    )


def keywords() -> list[str]:
    return sorted({keyword for _, _, keyword, _ in rules()})


def _present(words: Column) -> Column:
    """The keywords that occur."""
    return F.filter(F.array(*map(F.lit, keywords())), lambda k: F.contains(words, F.concat(F.lit(" "), k)))


def _detections(words: Column, present: Column) -> Column:
    """All intervals of the rules whose keyword is present."""
    gated = F.filter(_rules_column(), lambda r: F.array_contains(present, r["keyword"]))
    return F.flatten(
        F.transform(
            gated,
            lambda r: F.transform(
                spans(words, r["pattern"]),
                # -end first: of two that start together the longer comes first.
                lambda x: F.struct(x["start"], (-x["end"]).alias("past"), (-r["priority"]).alias("priority"), r["order"], r["label"]),
            ),
        )
    ).cast(_FOUND)


def _unsuppressed(found: Column) -> Column:
    """Without intervals inside another of the same or a higher priority.

    In order of (start, longest, highest priority, first rule) an interval lies inside an earlier
    one exactly if an earlier end is not before its own; the furthest end is kept per priority.
    """
    top = len(WEIGHTS)
    def step(done: Column, x: Column) -> Column:
        end, own = -x["past"], -x["priority"]
        covered = F.get(done["reach"], own) >= end
        # reach[p] is the furthest end among priorities of p and above.
        reach = F.transform(done["reach"], lambda far, p: F.when((p <= own) & (far < end), end).otherwise(far))
        return F.struct(
            reach.alias("reach"),
            F.when(covered, done["out"]).otherwise(F.concat(done["out"], F.array(x))).alias("out"),
        )

    reach = F.array_repeat(F.lit(-1).cast("bigint"), top)
    return gathered(F.array_sort(found), {"reach": reach}, step, _FOUND.removeprefix("array<").removesuffix(">"))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), NOT_WORD, " ")), F.lit(" "))
    words = F.col("words")
    phrase = "(?i)(?<= )(?:" + "|".join(p for p, _ in BASE) + ")(?= )"
    gate = "(?i) (?:" + "|".join(sorted({*keywords(), *(p for p, _ in BASE)})) + ")"
    gated = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), once("words", padded)).select(
        "doc_id", "words", once("low", F.when(words.rlike(gate), F.lower(words)))
    )
    gated = gated.select("doc_id", "words", once("present", F.when(F.col("low").isNotNull(), _present(F.col("low")))))
    some_rules = F.size("present") > 0
    hits = F.when(F.col("present").isNotNull(), F.regexp_extract_all(words, F.lit(phrase), F.lit(0)))
    kept = F.when(some_rules, _unsuppressed(_detections(words, F.col("present"))))
    none, unkept = F.array().cast("array<string>"), F.array().cast(_FOUND)
    found = F.struct(F.coalesce(hits, none).alias("hits"), F.coalesce(kept, unkept).alias("kept"))
    scanned = gated.select("doc_id", "words", once("found", found))
    found = F.col("found.hits")
    label = F.create_map(*[F.lit(x) for pair in BASE for x in pair])
    base_labels = F.array_sort(F.array_distinct(F.transform(found, lambda x: F.element_at(label, F.lower(x)))))
    labels = F.array_sort(F.array_union(base_labels, F.transform("found.kept", lambda x: x["label"])))
    # " " has one space and no word; every word adds one.
    n_words = F.greatest(_spaces(words) - 1, F.lit(0))
    n_words = F.when(F.trim(words) == "", 0).otherwise(n_words).cast("bigint")
    some = F.size(found) > 0
    after = F.element_at(F.split(words, phrase, -1), -1)
    last = n_words - (_spaces(after) - 1) - (_spaces(F.element_at(found, -1)) + 1)
    weight = F.array(*[F.lit(x) for x in WEIGHTS])
    score = F.array_max(F.transform("found.kept", lambda x: F.get(weight, -x["priority"])))
    return scanned.select(
        "doc_id",
        n_words.alias("n_words"),
        F.size(found).cast("bigint").alias("n_base"),
        F.when(some, _spaces(F.get(F.split(words, phrase, -1), F.lit(0))) - 1).alias("first_word"),
        F.when(some, last).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce(score, F.lit(0.0)), F.when(some, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
        F.transform("found.kept", lambda x: F.struct(x["label"], F.get(weight, -x["priority"]).alias("score"))).alias("detections"),
    )
