"""License scan by ordered signature rules, with DataFrame functions only.

A rule is a pattern over the normalised words of a text with one anchor word, written in braces.
Rules are filed by anchor: a text is looked at only if it holds one of a few hint strings, and a
rule only where its anchor stands. Each match gives a word interval, a label and a priority.
Detections are sorted by start, longer first, higher priority first; one that lies inside an
earlier interval of the same or a higher priority is suppressed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and labels. Fixed values.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_LIC = "licen[cs]e"
_V = "(?:version |v |ver )?"
#: Names by label; the anchor word in braces. A name alone has priority 2.
NAMES: dict[str, tuple[str, ...]] = {
    "mit": ("{mit} " + _LIC, "{expat} " + _LIC, _LIC + " {mit}", "{mit} style " + _LIC, "{mit} x11 " + _LIC),
    "mit-0": ("{mit} no attribution " + _LIC, "{mit} 0 " + _LIC),
    "x11": ("{x11} " + _LIC, "x {consortium} " + _LIC),
    "apache-1": ("{apache} (?:software )?" + _LIC + " " + _V + "1(?: [01])?", "{apache} 1(?: [01])?"),
    "apache-2": ("{apache} (?:software )?" + _LIC + " " + _V + "2(?: 0)?", "{apache} 2(?: 0)?(?: " + _LIC + ")?", "{asl} 2(?: 0)?", "apache org {licenses} license 2 0"),
    "gpl-1": ("{gnu} general public " + _LIC + " " + _V + "1(?: 0)?", "{gpl} " + _V + "1(?: 0)?", "{gplv1}"),
    "gpl-2": ("{gnu} general public " + _LIC + " " + _V + "2(?: 0)?", "{gpl} " + _V + "2(?: 0)?", "{gplv2}", "{gnu} gpl " + _V + "2"),
    "gpl-3": ("{gnu} general public " + _LIC + " " + _V + "3(?: 0)?", "{gpl} " + _V + "3(?: 0)?", "{gplv3}", "{gnu} gpl " + _V + "3"),
    "gpl": ("{gnu} general public " + _LIC, "{gnu} gpl", "{gpl} " + _LIC),
    "lgpl-2": ("{gnu} (?:library|lesser) general public " + _LIC + " " + _V + "2(?: [01])?", "{lgpl} " + _V + "2(?: [01])?", "{lgplv2}(?: 1)?"),
    "lgpl-3": ("{gnu} lesser general public " + _LIC + " " + _V + "3(?: 0)?", "{lgpl} " + _V + "3(?: 0)?", "{lgplv3}"),
    "lgpl": ("{gnu} (?:library|lesser) general public " + _LIC, "{lgpl} " + _LIC),
    "agpl-3": ("{gnu} affero general public " + _LIC + "(?: " + _V + "3(?: 0)?)?", "{agpl} " + _V + "3(?: 0)?", "{agplv3}"),
    "gfdl": ("{gnu} free documentation " + _LIC, "{gfdl}(?: 1 [0-3])?"),
    "bsd-2": ("{bsd} 2 clause(?: " + _LIC + ")?", "2 clause {bsd}(?: " + _LIC + ")?", "two clause {bsd}(?: " + _LIC + ")?", "simplified {bsd} " + _LIC, "{freebsd} " + _LIC),
    "bsd-3": ("{bsd} 3 clause(?: " + _LIC + ")?", "3 clause {bsd}(?: " + _LIC + ")?", "three clause {bsd}(?: " + _LIC + ")?", "(?:new|revised|modified) {bsd} " + _LIC),
    "bsd-4": ("{bsd} 4 clause(?: " + _LIC + ")?", "4 clause {bsd}(?: " + _LIC + ")?", "original {bsd} " + _LIC),
    "bsd": ("{bsd} " + _LIC, "{bsd} style " + _LIC),
    "0bsd": ("{0bsd}", "zero clause {bsd}(?: " + _LIC + ")?"),
    "mpl-1": ("{mozilla} public " + _LIC + " " + _V + "1(?: [01])?", "{mpl} " + _V + "1(?: [01])?"),
    "mpl-2": ("{mozilla} public " + _LIC + " " + _V + "2(?: 0)?", "{mpl} " + _V + "2(?: 0)?"),
    "mpl": ("{mozilla} public " + _LIC,),
    "epl-1": ("{eclipse} public " + _LIC + " " + _V + "1(?: 0)?", "{epl} " + _V + "1(?: 0)?"),
    "epl-2": ("{eclipse} public " + _LIC + " " + _V + "2(?: 0)?", "{epl} " + _V + "2(?: 0)?"),
    "edl": ("{eclipse} distribution " + _LIC,),
    "cddl": ("{cddl}(?: 1 [01])?", "common development and {distribution} " + _LIC),
    "cpl": ("common {public} " + _LIC + "(?: 1 0)?",),
    "eupl": ("{eupl}(?: 1 [0-2])?", "european {union} public " + _LIC),
    "isc": ("{isc} " + _LIC, _LIC + " {isc}"),
    "zlib": ("{zlib} " + _LIC, "{zlib} libpng " + _LIC, "{libpng} " + _LIC),
    "unlicense": ("the {unlicense}", "{unlicense} org", _LIC + " {unlicense}"),
    "wtfpl": ("{wtfpl}", "do what the fuck you want to public {license}"),
    "artistic-1": ("{artistic} " + _LIC + " " + _V + "1(?: 0)?",),
    "artistic-2": ("{artistic} " + _LIC + " " + _V + "2(?: 0)?",),
    "boost": ("{boost} software " + _LIC + "(?: " + _V + "1(?: 0)?)?", "{bsl} 1 0"),
    "python": ("{python} software foundation " + _LIC, "{psf} " + _LIC, "{psfl}"),
    "openssl": ("{openssl} " + _LIC, "{ssleay} " + _LIC),
    "postgresql": ("{postgresql} " + _LIC,),
    "php": ("{php} " + _LIC + "(?: " + _V + "3(?: [01])?)?",),
    "ruby": ("{ruby} " + _LIC,),
    "ofl": ("sil {open} font " + _LIC, "{ofl}(?: 1 1)?"),
    "ms-pl": ("{microsoft} public " + _LIC,),
    "ms-rl": ("{microsoft} reciprocal " + _LIC,),
    "odbl": ("{odbl}(?: 1 0)?", "open {database} " + _LIC),
    "odc-by": ("open data {commons} attribution " + _LIC,),
    "pddl": ("{pddl}", "public domain {dedication} and " + _LIC),
    "bsl": ("{business} source " + _LIC,),
    "sspl": ("{sspl}", "server side {public} " + _LIC),
    "elastic": ("{elastic} " + _LIC,),
    "cc0": ("{cc0}(?: 1 0)?", "{creative} commons (?:cc0|zero)(?: 1 0)?", "{creativecommons} org publicdomain zero"),
    "cc-by": ("{cc} by(?: [1-4] [05])?(?! nc| nd| sa)", "{creative} commons attribution(?: [1-4] [05])?(?: international)?(?! non| no| share)", "{creativecommons} org licenses by(?! nc| nd| sa)"),
    "cc-by-sa": ("{cc} by sa(?: [1-4] [05])?", "{creative} commons attribution share ?alike(?: [1-4] [05])?", "{creativecommons} org licenses by sa"),
    "cc-by-nd": ("{cc} by nd(?: [1-4] [05])?", "{creative} commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?", "{creativecommons} org licenses by nd"),
    "cc-by-nc": ("{cc} by nc(?: [1-4] [05])?(?! nd| sa)", "{creative} commons attribution non ?commercial(?: [1-4] [05])?(?! no| share)", "{creativecommons} org licenses by nc(?! nd| sa)"),
    "cc-by-nc-sa": ("{cc} by nc sa(?: [1-4] [05])?", "{creative} commons attribution non ?commercial share ?alike(?: [1-4] [05])?", "{creativecommons} org licenses by nc sa"),
    "cc-by-nc-nd": ("{cc} by nc nd(?: [1-4] [05])?", "{creative} commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?", "{creativecommons} org licenses by nc nd"),
    "public-domain": ("(?:in|into|to) the public {domain}", "{domain} of the public"),
    "all-rights-reserved": ("all {rights} reserved", "alle {rechte} vorbehalten", "tous {droits} réservés", "todos los {derechos} reservados"),
    "copyright": ("{copyright} (?:c )?(?:19|20)[0-9]{2}", "{copyright} c"),
}
#: A grant in front of a name has priority 3.
_GRANTS = (
    "(?:released|licensed|distributed|available|published|provided|covered) (?:only |also )?under (?:the |a |an )?(?:terms of the |terms and conditions of the )?",
    "(?:subject to|governed by|in accordance with|compliance with) (?:the |a |an )?(?:terms of the )?",
    _LIC + " (?:is |as )?(?:the |a |an )?",
)
#: Identifier lines have priority 4.
_IDENTIFIER = "spdx " + _LIC + " identifier "
IDS = {
    "mit": "{mit}", "mit-0": "{mit} 0", "apache-1": "{apache} 1 [01]", "apache-2": "{apache} 2 0", "gpl-1": "{gpl} 1 0",
    "gpl-2": "{gpl} 2 0", "gpl-3": "{gpl} 3 0", "lgpl-2": "{lgpl} 2 [01]", "lgpl-3": "{lgpl} 3 0", "agpl-3": "{agpl} 3 0",
    "bsd-2": "{bsd} 2 clause", "bsd-3": "{bsd} 3 clause", "bsd-4": "{bsd} 4 clause", "0bsd": "{0bsd}", "mpl-1": "{mpl} 1 [01]",
    "mpl-2": "{mpl} 2 0", "epl-1": "{epl} 1 0", "epl-2": "{epl} 2 0", "cddl": "{cddl} 1 [01]", "eupl": "{eupl} 1 [0-2]",
    "isc": "{isc}", "zlib": "{zlib}", "unlicense": "{unlicense}", "wtfpl": "{wtfpl}", "artistic-2": "{artistic} 2 0",
    "boost": "{bsl} 1 0", "ofl": "{ofl} 1 [01]", "odbl": "{odbl} 1 0", "pddl": "{pddl} 1 0", "cc0": "{cc0} 1 0",
    "cc-by": "{cc} by [1-4] [05]", "cc-by-sa": "{cc} by sa [1-4] [05]", "cc-by-nd": "{cc} by nd [1-4] [05]",
    "cc-by-nc": "{cc} by nc [1-4] [05]", "cc-by-nc-sa": "{cc} by nc sa [1-4] [05]", "cc-by-nc-nd": "{cc} by nc nd [1-4] [05]",
}
#: Sentences of license texts have priority 3.
SENTENCES = {
    "mit": ("permission is hereby {granted} free of charge to any person obtaining a copy",
            "the software is provided as is without {warranty} of any kind",
            "the above copyright notice and this {permission} notice shall be included in all copies"),
    "isc": ("{permission} to use copy modify and or distribute this software for any purpose",),
    "bsd": ("{redistribution} and use in source and binary forms with or without modification",
            "redistributions of source code must {retain} the above copyright notice",
            "redistributions in binary form must {reproduce} the above copyright notice"),
    "bsd-3": ("may be used to {endorse} or promote products derived from this software",),
    "bsd-4": ("all advertising {materials} mentioning features or use of this software must display",),
    "gpl": ("this program is free software you can {redistribute} it and or modify it",
            "either version [23] of the {license} or at your option any later version",
            "{gnu} general public license as published by the free software foundation"),
    "lgpl": ("this {library} is free software you can redistribute it and or modify it",
             "gnu {lesser} general public license as published by the free software foundation"),
    "agpl": ("gnu {affero} general public license as published by the free software foundation",
             "all users {interacting} with it remotely through a computer network"),
    "mpl-2": ("this source code form is subject to the terms of the {mozilla} public license v 2 0",
              "if a copy of the {mpl} was not distributed with this file"),
    "epl": ("this program and the accompanying materials are made available under the terms of the {eclipse} public license",),
    "cddl": ("the contents of this file are subject to the terms of the common {development} and distribution license",),
    "boost": ("free of charge to any person or organization {obtaining} a copy of the software and accompanying documentation",),
    "ofl": ("any person obtaining a copy of the {font} software to use study copy merge embed modify redistribute",
            "any of its individual components in original or modified versions may be {sold} by itself"),
    "openssl": ("this product includes software developed by the {openssl} project for use in the openssl toolkit",),
    "postgresql": ("permission to use copy modify and distribute this software and its {documentation} for any purpose without fee",),
    "ms-pl": ("if you bring a patent claim against any {contributor} over patents that you claim are infringed",),
    "bsl": ("the {licensor} hereby grants you the right to copy modify create derivative works redistribute and make non production use",),
    "elastic": ("you may not provide the software to third parties as a {hosted} or managed service",),
    "creative-commons": ("by {exercising} the licensed rights defined below you accept and agree to be bound by the terms",),
    "zlib": ("this software is provided as is without any express or implied {warranty}",
             "{altered} source versions must be plainly marked as such"),
    "unlicense": ("this is free and {unencumbered} software released into the public domain",),
    "apache-2": ("you may not use this file except in compliance with the {license}",
                 "distributed on an as is {basis} without warranties or conditions of any kind"),
    "cc0": ("{waived} all copyright and related or neighboring rights",),
    "proprietary": ("{confidential} and proprietary", "{unauthorized} (?:copying|use|reproduction) of this file"),
}

_LEFT, _RIGHT = 14, 18
_NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same as a complement of the ASCII non-word characters, which Java matches far slower.
_WORD_ANY_CASE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"


def rules() -> list[tuple[str, str, str, str, int]]:
    """(anchor, pattern before it, pattern from it on, label, priority) of all rules."""
    def of(pattern: str, label: str, priority: int) -> tuple[str, str, str, str, int]:
        before, rest = pattern.split("{", 1)
        anchor, after = rest.split("}", 1)
        return anchor, before, anchor + after, label, priority

    out = []
    for label, names in NAMES.items():
        for name in names:
            out.append(of(name, label, 2))
            if label not in ("copyright", "all-rights-reserved", "public-domain"):
                out += [of(grant + name, label, 3) for grant in _GRANTS]
    out += [of(_IDENTIFIER + i, label, 4) for label, i in IDS.items()]
    out += [of(s, label, 3) for label, sentences in SENTENCES.items() for s in sentences]
    return out


def needs(rule: tuple[str, str, str, str, int]) -> str:
    """A string that any match of the rule holds: ``licen`` if the pattern can't do without it, that
    is, if each alternative of one of its groups holds it or the text outside groups does; else the
    anchor."""
    pattern, shorter = None, f"{rule[1]} {rule[2]}"
    while pattern != shorter:  # leave out what is optional
        pattern, shorter = shorter, re.sub(r"\(\?:[^()]*\)\?|\(\?![^()]*\)", "", shorter)
    pattern = None
    while pattern != shorter:  # of a group only what all of its alternatives hold
        pattern, shorter = shorter, re.sub(r"\(\?:([^()]*)\)(?!\?)", lambda m: "licen" if all(
            "licen" in a for a in m[1].split("|")) else " ", re.sub(r"\(\?:[^()]*\)\?", "", shorter))
    return "licen" if "licen" in pattern else rule[0]


def _filed(table: list[tuple[str, str, str, str, int]]) -> Column:
    """Map from anchor to its rules, a constant."""
    by: dict[str, list[Column]] = {}
    for rule in table:
        anchor, left, right, label, priority = rule
        before = f"(?:^| )(?:{left})$" if left else ""
        by.setdefault(anchor, []).append(F.struct(
            F.lit(needs(rule)).alias("need"), F.lit(before).alias("left"),
            F.lit(f"^(?:{right})(?= |$)").alias("right"), F.lit(label).alias("label"),
            F.lit(priority).alias("priority")))
    return F.create_map(*[x for k, v in by.items() for x in (F.lit(k), F.array(*v))])


def hinted(low: Column, table: list[tuple[str, str, str, str, int]]) -> Column:
    """False if the lower-cased text can hold neither a rule's match nor a base phrase: it has
    neither ``licen`` nor, as a word, the anchor of a rule that does without."""
    words = sorted({r[0] for r in table if needs(r) != "licen"} | {p.split()[0] for p in PHRASES if "licen" not in p})
    return F.contains(low, F.lit("licen")) | low.rlike(rf"(?<![0-9a-z])(?:{'|'.join(words)})(?![0-9a-z])")


def _count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^ ]+")).cast("int")


def detections(words: Column, table: list[tuple[str, str, str, str, int]]) -> Column:
    """All rule matches of a text's words: array of (start, minus_end, minus_priority, label)."""
    filed, anchors = _filed(table), sorted({r[0] for r in table})
    marked = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                      lambda p: p.w.isin(anchors))
    places = F.transform(marked, lambda p: F.struct(
        p.w.alias("w"), p.i.alias("i"),
        F.concat(F.array_join(F.slice(words, F.greatest(p.i - _LEFT, F.lit(0)) + 1, F.least(p.i, F.lit(_LEFT))), " "),
                 F.lit(" ")).alias("before"),
        F.array_join(F.slice(words, p.i + 1, F.lit(_RIGHT)), " ").alias("behind")))

    def at(p: Column) -> Column:
        def tried(r: Column) -> Column:
            left = F.when(r.left == "", F.lit("")).otherwise(F.regexp_substr(p.before, r.left))
            right = F.when(left.isNotNull(), F.regexp_substr(p.behind, r.right))
            return F.when(right.isNotNull(), F.struct(
                (p.i - _count(left)).alias("start"), (-(p.i + _count(right))).alias("minus_end"),
                (-r.priority).alias("minus_priority"), r.label.alias("label")))
        possible = F.filter(F.try_element_at(filed, p.w), lambda r: (r.need == p.w) | F.contains(
            p.before, r.need) | F.contains(p.behind, r.need))
        return F.filter(F.transform(possible, tried), lambda d: d.isNotNull())
    return F.flatten(F.transform(places, at))


def unsuppressed(found: Column) -> Column:
    """Detections that don't lie inside another of the same or a higher priority; of equal intervals
    and priorities the first label stays. One pass in order of start, longer first."""
    def step(s: Column, d: Column) -> Column:
        inside = F.exists(s.ends, lambda e: (e.priority >= -d.minus_priority) & (e.end >= -d.minus_end))
        ends = F.transform(s.ends, lambda e: F.struct(e.priority.alias("priority"), F.when(
            e.priority == -d.minus_priority, F.greatest(e.end, -d.minus_end)).otherwise(e.end).alias("end")))
        return F.struct(ends.alias("ends"), F.when(inside, s.kept).otherwise(F.concat(s.kept, F.array(
            F.struct(d.label.alias("label"), (-d.minus_priority).alias("priority"), d.start.alias("start"),
                     (-d.minus_end).alias("end"))))).alias("kept"))
    start = F.struct(F.array(*[F.struct(F.lit(p).alias("priority"), F.lit(-1).alias("end")) for p in (2, 3, 4)]).alias("ends"),
                     F.array().cast("array<struct<label:string,priority:int,start:int,end:int>>").alias("kept"))
    return F.aggregate(F.array_sort(found), start, step, lambda s: s.kept)


def scanned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    ``detections`` (label, priority, start, end in words).

    ``score`` is a quarter of the highest priority found; a base phrase counts 3. Null, empty and
    wordless texts have no words, no labels and score 0. Repeated rows get equal results; other
    columns aren't read. An empty table gives an empty result."""
    t = F.col("text")
    table = rules()
    hint = hinted(F.lower(t), table)
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    norm = F.trim(F.regexp_replace(F.translate(t, upper, upper.lower()), _NON_WORD, " "))
    d = d.select("doc_id", F.regexp_count(t, F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"),
                 F.when(hint, F.concat(F.lit(" "), norm, F.lit(" "))).alias("norm"))
    # a column of its own, so that a place's context is cut from it without splitting the text again
    d = d.select("doc_id", "n_words", F.split(F.trim("norm"), " ").alias("words"), *[
        F.when(F.contains("norm", F.lit(f" {p} ")), F.split("norm", f"(?<= ){p}(?= )", -1)).alias(f"parts{i}")
        for i, p in enumerate(PHRASES)])
    d = d.withColumn("found", F.when(F.col("words").isNotNull(), unsuppressed(detections(F.col("words"), table))))
    parts = [F.col(f"parts{i}") for i in range(len(PHRASES))]
    count = [F.when(p.isNotNull(), F.size(p) - 1).otherwise(0) for p in parts]
    first = [_count(p[0]).cast("long") for p in parts]
    last = [F.col("n_words") - _count(F.element_at(p, -1)) - len(name.split())
            for p, name in zip(parts, PHRASES, strict=True)]
    base = F.array_compact(F.array(*[F.when(p.isNotNull(), F.lit(label))
                                     for p, label in zip(parts, PHRASES.values(), strict=True)]))
    found = F.coalesce("found", F.array().cast("array<struct<label:string,priority:int,start:int,end:int>>"))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    best = F.aggregate(found, F.lit(0), lambda a, x: F.greatest(a, x.priority))
    return d.select(
        "doc_id", "n_words", sum(count[1:], count[0]).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform(found, lambda x: x.label))).alias("labels"),
        (F.greatest(best, F.when(F.size(base) > 0, 3).otherwise(0)) / 4.0).alias("score"),
        found.alias("detections"))
