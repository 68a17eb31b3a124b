"""Operator 1, license scans: ordered signature rules behind a keyword prefilter.

A text becomes its words, lower-cased and joined by single spaces. A rule is a
hand-written regex over those words in which ``@`` marks its keyword. Texts that
hold none of the keyword stems are not looked at again; in the others every
place of a keyword (an *anchor*) is matched against the rules of that keyword
whose second word, the *needle*, also stands in the window around the anchor.
Work is so proportional to the anchors, and no row leaves its task: the
operator is a projection without a shuffle.

Overlaps are resolved by priority and interval containment: of the detections
ordered by start, longest first, one is dropped if an earlier one of the same
or a better tier contains it. Base rules are counted and labelled before that.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table

#: Tiers, best first: grant and condition texts, names with versions, bare names.
TEXT, NAMED, GENERIC = 1, 2, 3


class Rule(NamedTuple):
    label: str
    tier: int
    keyword: str
    needle: str  # another word that every match of the pattern holds, or ""
    pattern: str
    weight: float
    base: bool = False


# Base phrases and their labels.
_BASE = [("mit", "mit", "mit @license"), ("apache", "apache", "apache @license"), ("gpl", "general", "general public @license")]

# label, SPDX words after normalization, needle, regex of its written name
_FAMILIES = [
    ("mit", "mit", "mit", "mit"),
    ("mit-0", "mit 0", "attribution", "mit no attribution"),
    ("x11", "x11", "", "x11|x consortium"),
    ("expat", "expat", "expat", "expat"),
    ("isc", "isc", "", "isc|internet systems consortium"),
    ("apache-1.1", "apache 1 1", "apache", "apache(?: software)? (?:license )?(?:version )?1 1"),
    ("apache-2.0", "apache 2 0", "apache", "apache(?: software)? (?:license )?(?:version |v )?v?2(?: 0)?"),
    ("bsd-2-clause", "bsd 2 clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause"),
    ("bsd-3-clause", "bsd 3 clause", "bsd", "(?:new|revised|modified|3 clause|three clause) bsd|bsd (?:3|three) clause"),
    ("bsd-4-clause", "bsd 4 clause", "bsd", "(?:original|old|4 clause|four clause) bsd|bsd (?:4|four) clause"),
    ("0bsd", "0bsd", "bsd", "zero clause bsd|bsd zero clause|0 clause bsd"),
    ("bsd", "bsd", "bsd", "bsd"),
    ("gpl-1.0", "gpl 1 0", "general", "(?:gnu )?general public license (?:version |v )?v?1(?: 0)?"),
    ("gpl-2.0", "gpl 2 0", "general", "(?:gnu )?general public license (?:version |v )?v?2(?: 0)?"),
    ("gpl-3.0", "gpl 3 0", "general", "(?:gnu )?general public license (?:version |v )?v?3(?: 0)?"),
    ("lgpl-2.0", "lgpl 2 0", "library", "(?:gnu )?library general public license(?: (?:version |v )?v?2(?: 0)?)?"),
    ("lgpl-2.1", "lgpl 2 1", "lesser", "(?:gnu )?lesser general public license (?:version |v )?v?2 1"),
    ("lgpl-3.0", "lgpl 3 0", "lesser", "(?:gnu )?lesser general public license (?:version |v )?v?3(?: 0)?"),
    ("agpl-3.0", "agpl 3 0", "affero", "(?:gnu )?affero general public license(?: (?:version |v )?v?3(?: 0)?)?"),
    ("mpl-1.1", "mpl 1 1", "mozilla", "mozilla public license (?:version |v )?v?1 1"),
    ("mpl-2.0", "mpl 2 0", "mozilla", "mozilla public license (?:version |v )?v?2(?: 0)?"),
    ("epl-1.0", "epl 1 0", "eclipse", "eclipse public license (?:version |v )?v?1(?: 0)?"),
    ("epl-2.0", "epl 2 0", "eclipse", "eclipse public license (?:version |v )?v?2(?: 0)?"),
    ("cddl-1.0", "cddl 1 0", "distribution", "common development and distribution license(?: (?:version |v )?v?1(?: 0)?)?"),
    ("cpl-1.0", "cpl 1 0", "common", "common public license(?: (?:version |v )?v?1(?: 0)?)?"),
    ("eupl-1.2", "eupl 1 2", "european", "european union public licen[cs]e(?: (?:version |v )?v?1 [12])?"),
    ("artistic-1.0", "artistic 1 0", "artistic", "artistic license (?:version )?1(?: 0)?|perl artistic"),
    ("artistic-2.0", "artistic 2 0", "artistic", "artistic license (?:version )?2(?: 0)?"),
    ("bsl-1.0", "bsl 1 0", "boost", "boost software(?: license(?: (?:version )?1(?: 0)?)?)?"),
    ("busl-1.1", "busl 1 1", "business", "business source license(?: (?:version )?1 1)?"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)?"),
    ("libpng", "libpng", "libpng", "libpng"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "", "wtfpl|do what the fuck you want to public license"),
    ("cc0-1.0", "cc0 1 0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-4.0", "cc by 4 0", "attribution", "creative commons attribution(?: 4 0)?(?: international)?"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "attribution", "creative commons attribution share ?alike(?: 4 0)?"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "attribution", "creative commons attribution non ?commercial(?: 4 0)?"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "attribution", "creative commons attribution no ?deriv(?:ative)?s(?: 4 0)?"),
    ("ofl-1.1", "ofl 1 1", "sil", "sil open font(?: license(?: (?:version )?1 1)?)?"),
    ("psf-2.0", "psf 2 0", "python", "python software foundation(?: license(?: (?:version )?2)?)?"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("ncsa", "ncsa", "", "ncsa|university of illinois"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("php-3.01", "php 3 01", "php", "php license (?:version )?3 01|php"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("vim", "vim", "vim", "vim"),
    ("w3c", "w3c", "w3c", "w3c(?: software)?(?: notice and)?"),
    ("ms-pl", "ms pl", "microsoft", "microsoft public"),
    ("ms-rl", "ms rl", "microsoft", "microsoft reciprocal"),
    ("odbl-1.0", "odbl 1 0", "database", "open (?:data commons open )?database license(?: v?1 0)?"),
    ("afl-3.0", "afl 3 0", "academic", "academic free license(?: (?:version |v )?3(?: 0)?)?"),
    ("osl-3.0", "osl 3 0", "open", "open software license (?:version |v )?3(?: 0)?"),
    ("upl-1.0", "upl 1 0", "universal", "universal permissive license(?: (?:version |v )?1(?: 0)?)?"),
    ("sspl-1.0", "sspl 1 0", "server", "server side public license(?: (?:version |v )?1)?"),
    ("elastic-2.0", "elastic 2 0", "elastic", "elastic license(?: (?:version |v )?2(?: 0)?)?"),
    ("unicode", "unicode dfs 2016", "unicode", "unicode(?: data files and software)?"),
]

_G = "(?: \\S+){0,%d}"

# label, keyword, needle, regex: sentences of license texts and notices
_SENTENCES = [
    ("mit", "permission", "hereby", "@permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "copyright", "substantial", "the above @copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "warranty", "provided", "the software is provided as is without @warranty of any kind express or implied"),
    ("isc", "permission", "modify", "@permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "warranties", "disclaims", "the software is provided as is and the author disclaims all @warranties"),
    ("mit-0", "permission", "restriction", "@permission is hereby granted" + _G % 14 + " without restriction"),
    ("bsd-2-clause", "redistribution", "binary", "@redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", "redistributions", "source", "@redistributions of source code must retain the(?: above)? copyright notice"),
    ("bsd-2-clause", "redistributions", "binary", "@redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "permission", "endorse", "neither the names? of" + _G % 10 + " may be used to endorse or promote products derived from this software without specific prior written @permission"),
    ("bsd-4-clause", "advertising", "mentioning", "all @advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "licensed", "apache", "@licensed under the apache license version 2 0"),
    ("apache-2.0", "license", "compliance", "you may not use this file except in compliance with the @license"),
    ("apache-2.0", "license", "obtain", "you may obtain a copy of the @license at(?: https?)? www apache org licenses license 2 0"),
    ("apache-2.0", "warranties", "basis", "distributed on an as is basis without @warranties or conditions of any kind"),
    ("apache-2.0", "license", "grant", "grant of (?:copyright|patent) @license subject to the terms"),
    ("gpl-2.0", "license", "either", "gnu general public @license as published by the free software foundation either version 2 of the license"),
    ("gpl-3.0", "license", "either", "gnu general public @license as published by the free software foundation either version 3 of the license"),
    ("gpl", "redistribute", "free", "this program is free software you can @redistribute it and or modify it under the terms of"),
    ("gpl", "warranty", "hope", "this program is distributed in the hope that it will be useful but without any @warranty"),
    ("gpl", "license", "received", "you should have received a copy of the gnu general public @license along with this program"),
    ("lgpl", "license", "lesser", "you should have received a copy of the gnu lesser general public @license"),
    ("lgpl", "redistribute", "library", "this library is free software you can @redistribute it and or modify it"),
    ("lgpl-2.1", "license", "lesser", "gnu lesser general public @license as published by the free software foundation either version 2 1"),
    ("agpl-3.0", "license", "affero", "gnu affero general public @license as published by the free software foundation"),
    ("mpl-2.0", "license", "mozilla", "this source code form is subject to the terms of the mozilla public @license v 2 0"),
    ("mpl-2.0", "copyright", "mpl", "if a copy of the mpl was not distributed with this file" + _G % 20 + " @copyright"),
    ("epl-1.0", "licensed", "eclipse", "made available under the terms of the eclipse public license" + _G % 12 + " @licensed"),
    ("bsl-1.0", "license", "boost", "boost software @license version 1 0"),
    ("bsl-1.0", "permission", "organization", "@permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", "warranty", "implied", "this software is provided as is without any express or implied @warranty"),
    ("zlib", "permission", "alter", "@permission is granted to anyone to use this software for any purpose including commercial applications and to alter it"),
    ("unlicense", "domain", "unencumbered", "this is free and unencumbered software released into the public @domain"),
    ("unlicense", "copyright", "dedicate", "dedicate any and all @copyright interest in the software to the public domain"),
    ("wtfpl", "license", "fuck", "do what the fuck you want to public @license"),
    ("beerware", "license", "beer", "the beer ware @license"),
    ("cc0-1.0", "copyright", "waived", "has waived all @copyright and related or neighboring rights"),
    ("cc", "licensed", "creative", "(?:this work is )?@licensed under (?:a|the) creative commons"),
    ("cc", "licenses", "creativecommons", "creativecommons org @licenses \\S+(?: \\d){0,2}"),
    ("public-domain", "domain", "public", "(?:placed|released|is) in(?:to)? the public @domain"),
    ("public-domain", "domain", "dedicated", "dedicated to the public @domain"),
    ("proprietary", "rights", "reserved", "all @rights reserved"),
    ("proprietary", "proprietary", "confidential", "(?:confidential and @proprietary|@proprietary and confidential)"),
    ("proprietary", "permission", "strictly", "strictly prohibited without(?: the)?(?: prior)?(?: express)?(?: written)? @permission"),
    ("proprietary", "licensed", "sold", "this software is @licensed not sold"),
    ("copyright-notice", "copyright", "", "@copyright(?: c)? (?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?"),
    ("copyright-notice", "copyright", "held", "@copyright is held by"),
    ("spdx-expression", "spdx", "identifier", "@spdx license identifier \\S+(?: \\d){0,2}(?: (?:or|and|with) \\S+)?"),
    ("eula", "license", "user", "end user @license agreement"),
    ("noassertion", "license", "see", "see(?: the)? @license(?: file| txt| md)?(?: for(?: more)? details)?"),
    ("noassertion", "licensed", "terms", "@licensed under the(?: same)? terms of"),
    ("noassertion", "license", "agreement", "@license agreement"),
]

# label, keyword, regex: abbreviations and short tags
_TAGS = [
    ("gpl-2.0", "gplv2", "@gplv2"), ("gpl-3.0", "gplv3", "@gplv3"), ("lgpl-2.1", "lgplv2", "@lgplv2(?: 1)?"), ("lgpl-3.0", "lgplv3", "@lgplv3"),
    ("agpl-3.0", "agplv3", "@agplv3"), ("gpl", "gpl", "(?:gnu )?@gpl"), ("gpl-2.0", "gpl", "(?:gnu )?@gpl (?:version |v )?v?2(?: 0)?"),
    ("gpl-3.0", "gpl", "(?:gnu )?@gpl (?:version |v )?v?3(?: 0)?"), ("lgpl", "lgpl", "(?:gnu )?@lgpl"), ("agpl", "agpl", "(?:gnu )?@agpl"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?@lgpl (?:version |v )?v?2 1"), ("lgpl-3.0", "lgpl", "(?:gnu )?@lgpl (?:version |v )?v?3(?: 0)?"),
    ("wtfpl", "wtfpl", "@wtfpl"), ("cc0-1.0", "cc0", "@cc0"), ("unlicense", "unlicense", "the @unlicense"), ("gfdl", "gfdl", "(?:gnu )?@gfdl"),
]


def _anchored(name: str) -> str:
    """A name with its keyword marked in every alternative, as a match is placed by its anchor."""
    parts, depth = [""], 0
    for c in name:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    for n, part in enumerate(parts):
        if "(?: license" in part:  # an optional end
            head, _, tail = part.partition("(?: license")
            parts[n] = f"{head} @license{tail.removesuffix(')?')}"
        else:
            parts[n] = part.replace(" license", " @license", 1) if " license" in part else f"{part} @license"
    return "|".join(parts)


def rules() -> list[Rule]:
    """All rules in priority order."""
    out = [Rule(x, GENERIC, "license", needle, p, 0.9, True) for x, needle, p in _BASE]
    out += [Rule(x, TEXT, k, needle, p, 1.0) for x, k, needle, p in _SENTENCES]
    for label, spdx, needle, name in _FAMILIES:
        versioned = NAMED if label[-1].isdigit() or "clause" in label else GENERIC
        first = spdx.split(" ")[0]
        out += [
            Rule(label, TEXT, "spdx", first, f"@spdx license identifier {spdx}(?: only| or later)?", 1.0),
            Rule(label, TEXT, "licensed", needle, f"@licensed under (?:the |a )?(?:terms of the )?(?:{name})(?: licen[cs]e)?", 0.95),
            Rule(label, TEXT, "released", needle, f"@released under (?:the |a )?(?:terms of the )?(?:{name})(?: licen[cs]e)?", 0.95),
            Rule(label, versioned, "licence", needle, f"(?:the )?(?:{name}) @licence", 0.85),
        ]
        if " license" in name:
            out.append(Rule(label, versioned, "license", needle, f"(?:the )?(?:{_anchored(name)})", 0.85))
        else:
            out.append(Rule(label, versioned, "license", needle, f"(?:the )?(?:{name}) @license", 0.85))
    out += [Rule(x, NAMED if x[-1].isdigit() else GENERIC, k, "", p, 0.7) for x, k, p in _TAGS]
    return out


def _span(found: list[Rule]) -> tuple[int, int]:
    """Words before an anchor, and from it on, that hold every match of the rules, or more."""
    # each word is written with one space, repeated ones as often as they may be there
    written = [re.sub(r"\(\?: \\[Sd]\+?\)\{0,(\d+)\}", lambda m: " " * int(m[1]), r.pattern) for r in found]
    return max(p[: p.rindex("@")].count(" ") for p in written), max(p[p.index("@") :].count(" ") for p in written) + 1


#: Words of the window before and after an anchor; no rule spans more.
BEFORE, AFTER = _span(rules())


def _stems(keywords: list[str]) -> list[str]:
    """Substrings of which every text with a keyword holds at least one."""
    short = sorted({k[:6] for k in keywords}, key=lambda k: (len(k), k))
    return [s for i, s in enumerate(short) if not any(x in s for x in short[:i])]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(found: list[Rule]) -> str:
    """SQL of the matches at the anchor ``a``: those of its keyword's rules, each with a pattern of its own in the plan.

    A pattern is compiled once for each task, and asked only where its needle is.
    """
    by: dict[str, list[str]] = {}
    for n, r in enumerate(found):
        match = (
            f"named_struct('i', a.i, 'n', {n}, 'label', {_text(r.label)}, 'tier', {r.tier}, 'weight', {r.weight}D, 'base', {str(r.base).lower()}, "
            f"'m', regexp_extract(a.window, {_text(f' (?:{r.pattern}) ')}, 0))"
        )
        by.setdefault(r.keyword, []).append(f"if(contains(a.plain, {_text(f' {r.needle} ')}), {match}, null)" if r.needle else match)
    return "case a.w " + " ".join(f"when {_text(k)} then array({', '.join(v)})" for k, v in by.items()) + " end"


def normalized(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, joined by single spaces; null is empty.

    Only A-Z may change into ASCII letters: the Kelvin sign and the dotted
    capital I, whose lower case holds one, are replaced by another letter first.
    """
    words = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    return F.lower(F.trim(F.regexp_replace(words, "[Kİ]", "ķ")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License detections of every row of ``docs``.

    Returns ``id, n_words, base, hits``: ``base`` holds all places of the base
    phrases, ``hits`` the detections that survive suppression, as structs
    ``(first, last, n, label, tier, weight)`` of word positions (``last``
    exclusive) and rule number. Null and empty texts have no words and no hits;
    repeated rows give repeated results; a null id stays null; other columns
    are not read. One row per input row, no shuffle.
    """
    found = rules()
    keywords = sorted({r.keyword for r in found})
    gate = " or ".join(f"contains(norm, {_text(s)})" for s in _stems(keywords))
    some = ", ".join(_text(k) for k in keywords)
    out = docs.select(F.col(id_col).alias("id"), normalized(F.col(text_col)).alias("norm"))
    out = out.select(
        "id",
        F.expr("if(norm = '', 0L, cast(length(norm) - length(replace(norm, ' ', '')) + 1 as bigint))").alias("n_words"),
        F.expr(f"if({gate}, split(norm, ' '), array())").alias("words"),
    )
    out = out.withColumn(
        "anchors",
        F.expr(
            f"transform(filter(transform(words, (w, i) -> named_struct('i', i, 'w', w)), a -> a.w in ({some})), a -> named_struct("
            f"'i', a.i, 'w', a.w, 'window', concat(' ', array_join(transform(slice(words, greatest(a.i - {BEFORE}, 0) + 1, least(a.i, {BEFORE})), w -> concat(w, ' ')), ''), "
            f"'@', array_join(slice(words, a.i + 1, {AFTER}), ' '), ' ')))"
        ),
    )
    out = out.withColumn("anchors", F.expr("transform(anchors, a -> named_struct('i', a.i, 'w', a.w, 'window', a.window, 'plain', replace(a.window, '@', '')))"))
    out = out.withColumn("hits", F.expr(f"filter(flatten(transform(anchors, a -> {_matches(found)})), h -> h.m <> '')"))
    spaces = "(length({0}) - length(replace({0}, ' ', '')))"
    left, right = spaces.format("substring_index(h.m, '@', 1)"), spaces.format("substring_index(h.m, '@', -1)")
    out = out.withColumn(
        "hits",
        F.expr(
            f"array_sort(transform(hits, h -> named_struct('first', h.i - {left} + 1, 'back', - h.i - {right}, 'n', h.n, "
            "'label', h.label, 'tier', h.tier, 'weight', h.weight, 'base', h.base)))"
        ),
    )
    whole = "named_struct('first', h.first, 'last', - h.back, 'n', h.n, 'label', h.label, 'tier', h.tier, 'weight', h.weight)"
    kind = "array<struct<first: int, last: int, n: int, label: string, tier: int, weight: double>>"
    tops = ", ".join(f"'t{t}', if(h.tier <= {t}, greatest(s.t{t}, - h.back), s.t{t})" for t in (TEXT, NAMED, GENERIC))
    return out.select(
        "id",
        "n_words",
        F.expr(f"transform(filter(hits, h -> h.base), h -> {whole})").alias("base"),
        F.expr(
            f"aggregate(hits, named_struct('t1', 0, 't2', 0, 't3', 0, 'kept', cast(array() as {kind})), (s, h) -> named_struct({tops}, "
            f"'kept', if(case h.tier when 1 then s.t1 when 2 then s.t2 else s.t3 end >= - h.back, s.kept, concat(s.kept, array({whole}))))).kept"
        ).alias("hits"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 1 over all of ``documents``."""
    found = scan(table(spark, sf_dir, "documents"))
    label = "array_join(array_sort(array_distinct(transform({0}, h -> h.label))), ',')"
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.expr("cast(size(base) as bigint)").alias("n_base"),
        F.expr("cast(array_min(transform(base, h -> h.first)) as bigint)").alias("first_word"),
        F.expr("cast(array_max(transform(base, h -> h.first)) as bigint)").alias("last_word"),
        F.expr(label.format("base")).alias("base_labels"),
        F.expr(label.format("concat(base, hits)")).alias("labels"),
        F.expr("coalesce(array_max(transform(concat(base, hits), h -> h.weight)), 0D)").alias("score"),
    )


def _duck_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _oracle() -> str:
    found = rules()
    values = ", ".join(
        f"({n}, {_duck_text(r.label)}, {r.tier}, {_duck_text(r.keyword)}, {_duck_text(f' {r.needle} ' if r.needle else '')}, {_duck_text(f' (?:{r.pattern}) ')}, {r.weight}::DOUBLE, {str(r.base).lower()})"
        for n, r in enumerate(found)
    )
    return f"""
WITH rules(n, label, tier, keyword, needle, pattern, weight, base) AS (VALUES {values}),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
anchors AS (
  SELECT doc_id, i, words[i + 1] AS w, ' ' || list_aggregate([x || ' ' for x in words[greatest(i - {BEFORE}, 0) + 1 : i]] || ['@'], 'string_agg', '') || list_aggregate(words[i + 1 : i + {AFTER}], 'string_agg', ' ') || ' ' AS win
  FROM (SELECT doc_id, words, unnest(range(len(words))) AS i FROM docs) WHERE words[i + 1] IN (SELECT keyword FROM rules)),
matched AS (
  SELECT a.doc_id, a.i, r.*, regexp_extract(a.win, r.pattern, 0) AS m FROM anchors a JOIN rules r ON a.w = r.keyword AND (r.needle = '' OR contains(replace(a.win, '@', ''), r.needle))),
hits AS (
  SELECT *, i - (len(split_part(m, '@', 1)) - len(replace(split_part(m, '@', 1), ' ', ''))) + 1 AS first,
    i + (len(split_part(m, '@', 2)) - len(replace(split_part(m, '@', 2), ' ', ''))) AS last FROM matched WHERE m <> ''),
kept AS (
  SELECT h.* FROM hits h WHERE h.base OR NOT EXISTS (
    SELECT 1 FROM hits k WHERE k.doc_id = h.doc_id AND k.tier <= h.tier AND k.first <= h.first AND k.last >= h.last
      AND (k.first < h.first OR k.last > h.last OR k.n < h.n))),
per AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(first) FILTER (WHERE base) AS first_word, max(first) FILTER (WHERE base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(weight) AS score
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(p.n_base, 0)::BIGINT AS n_base, p.first_word::BIGINT AS first_word, p.last_word::BIGINT AS last_word,
  coalesce(p.base_labels, '') AS base_labels, coalesce(p.labels, '') AS labels, coalesce(p.score, 0)::DOUBLE AS score
FROM docs d LEFT JOIN per p USING (doc_id)"""


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLE_SQL = {"op1_license_scan": _oracle()}
