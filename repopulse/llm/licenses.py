"""License scan by ordered signature rules (operator 9).

A text is reduced to its words (see ``WORD``), and rules are regular expressions over
the words with one blank between them. A rule runs only on texts that have its keyword
and, where it has names, one of them, which one automaton finds for all rules. Every match
of a rule contains both, so no detection is lost by it. Rules are ordered by priority:
a full notice goes before a statement of use, that before an identifier, that before a
bare name. Of overlapping detections the one of better priority wins, and a detection
that lies within another of equal priority goes. The three base phrases are always
counted, whatever overlaps them.

Texts of licenses, headers of source files, fields of package files and terms of dual
licensing are written out; names, versions and places follow templates over a table of
licenses. ``signature_rules`` gives them all. "All rights reserved" stands in most free
licenses too, so it counts only where no license is found. Defined cases: a null text is the empty text, without words; a null ``doc_id``
stays null; repeated rows are scanned each; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

from pyspark.sql import DataFrame

from repopulse.llm.common import per_row, texts_of

# Base phrases and their labels. Words are runs of letters, digits and
# all beyond ASCII, A-Z in lower case.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# label; how a text names the license; version words; where its text lies
_FAMILIES = (
    ("apache", "apache(?: software)?", ("1 0", "1 1", "2 0"), "apache org licenses license"),
    ("gpl", "(?:gnu )?(?:gpl|general public)", ("1 0", "2 0", "3 0", "2", "3"), "gnu org licenses gpl"),
    ("lgpl", "(?:gnu )?(?:lgpl|(?:lesser|library) general public)", ("2 0", "2 1", "3 0", "3"), "gnu org licenses lgpl"),
    ("agpl", "(?:gnu )?(?:agpl|affero general public)", ("1 0", "3 0", "3"), "gnu org licenses agpl"),
    ("gfdl", "(?:gnu )?(?:gfdl|free documentation)", ("1 1", "1 2", "1 3"), "gnu org licenses fdl"),
    ("mpl", "(?:mpl|mozilla public)", ("1 0", "1 1", "2 0"), "mozilla org mpl"),
    ("epl", "(?:epl|eclipse public)", ("1 0", "2 0"), "eclipse org legal epl"),
    ("eupl", "(?:eupl|european union public)", ("1 1", "1 2"), "joinup ec europa eu eupl"),
    ("cddl", "(?:cddl|common development and distribution)", ("1 0", "1 1"), "opensource org licenses cddl"),
    ("cpl", "(?:cpl|common public)", ("1 0",), "opensource org licenses cpl"),
    ("osl", "(?:osl|open software)", ("2 1", "3 0"), "opensource org licenses osl"),
    ("afl", "(?:afl|academic free)", ("2 1", "3 0"), "opensource org licenses afl"),
    ("artistic", "artistic", ("1 0", "2 0"), "opensource org licenses artistic"),
    ("bsl", "(?:bsl|boost software)", ("1 0",), "boost org license"),
    ("ofl", "(?:ofl|(?:sil )?open font)", ("1 0", "1 1"), "scripts sil org ofl"),
    ("psf", "(?:psf|python software foundation)", ("2 0", "2"), "docs python org license"),
    ("zpl", "(?:zpl|zope public)", ("2 0", "2 1"), "zope org resources zpl"),
    ("cc-by", "(?:cc|creative commons) (?:by|attribution)", ("2 0", "3 0", "4 0"), "creativecommons org licenses by"),
    ("cc-by-sa", "(?:cc|creative commons) (?:by sa|attribution share ?alike)", ("2 0", "3 0", "4 0"), "creativecommons org licenses by sa"),
    ("cc-by-nc", "(?:cc|creative commons) (?:by nc|attribution non ?commercial)", ("2 0", "3 0", "4 0"), "creativecommons org licenses by nc"),
    ("cc-by-nd", "(?:cc|creative commons) (?:by nd|attribution no ?derivatives)", ("2 0", "3 0", "4 0"), "creativecommons org licenses by nd"),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)", ("2 0", "3 0", "4 0"), "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?derivatives)", ("2 0", "3 0", "4 0"), "creativecommons org licenses by nc nd"),
    ("cc0", "(?:cc0|creative commons zero)", ("1 0",), "creativecommons org publicdomain zero"),
    ("odbl", "(?:odbl|open database)", ("1 0",), "opendatacommons org licenses odbl"),
    ("mit", "(?:mit|expat)", (), "opensource org licenses mit"),
    ("bsd", "bsd", (), "opensource org licenses bsd license"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", (), "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|(?:new|modified|revised) bsd)", (), "opensource org licenses bsd 3 clause"),
    ("isc", "isc", (), "opensource org licenses isc"),
    ("zlib", "zlib(?: libpng)?", (), "opensource org licenses zlib"),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", (), "wtfpl net"),
    ("unlicense", "unlicense", (), "unlicense org"),
    ("openssl", "openssl", (), "openssl org source license"),
    ("ncsa", "(?:ncsa|university of illinois)", (), "opensource org licenses ncsa"),
    ("postgresql", "postgresql", (), "opensource org licenses postgresql"),
    ("ruby", "ruby", (), "ruby lang org license"),
    ("curl", "curl", (), "curl se docs copyright"),
    ("beerware", "beer ?ware", (), "people freebsd org phk"),
)
# label; words of the license's own text
_NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of .{1,60}? nor the names of its contributors"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("lgpl", "this library is free software you can redistribute it and or modify it"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "altered source versions must be plainly marked as such"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "unauthorized copying of this file"),
    ("no-warranty", "provided as is without (?:any )?warrant(?:y|ies)"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies"),
)
# label; words of a header, of a package file or of a choice between licenses
_STATEMENTS = (
    ("gpl-2.0-or-later", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2.0-or-later", "gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl-2.1-or-later", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3.0-or-later", "gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3.0-or-later", "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0-only", "gnu general public license version 2 as published by the free software foundation"),
    ("gpl-2.0-only", "gnu general public license as published by the free software foundation version 2"),
    ("gpl-3.0-only", "gnu general public license version 3 as published by the free software foundation"),
    ("gpl-3.0-only", "gnu general public license as published by the free software foundation version 3"),
    ("agpl-3.0-only", "gnu affero general public license version 3 as published by the free software foundation"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license"),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "license apache license version 2 0"),
    ("apache-2.0", "license osi approved apache software license"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2.0", "license osi approved mozilla public license 2 0 mpl 2 0"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0 which"),
    ("epl-1.0", "made available under the terms of the eclipse public license v1 0 which"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("mit", "license osi approved mit license"),
    ("mit", "use of this source code is governed by an mit style license"),
    ("mit", "this software is distributed under the mit license"),
    ("mit", "this project is mit licensed"),
    ("bsd", "license osi approved bsd license"),
    ("bsd", "use of this source code is governed by a bsd style license"),
    ("bsd-2-clause", "redistributions of source code must retain the above copyright notice this list of conditions"),
    ("isc", "license osi approved isc license iscl"),
    ("gpl-2.0-only", "license osi approved gnu general public license v2 gplv2"),
    ("gpl-2.0-or-later", "license osi approved gnu general public license v2 or later gplv2"),
    ("gpl-3.0-only", "license osi approved gnu general public license v3 gplv3"),
    ("gpl-3.0-or-later", "license osi approved gnu general public license v3 or later gplv3"),
    ("lgpl-3.0-only", "license osi approved gnu lesser general public license v3 lgplv3"),
    ("agpl-3.0-only", "license osi approved gnu affero general public license v3"),
    ("unlicense", "license osi approved the unlicense unlicense"),
    ("psf", "license osi approved python software foundation license"),
    ("apache-2.0-or-mit", "licensed under either of apache license version 2 0"),
    ("apache-2.0-or-mit", "dual licensed under (?:the )?mit and apache 2 0"),
    ("apache-2.0-or-mit", "(?:mit or apache 2 0|apache 2 0 or mit)"),
    ("apache-2.0-or-mit", "dual licensed under (?:the )?apache 2 0 and mit"),
    ("gpl-or-mit", "dual licensed under (?:the )?mit and gpl"),
    ("gpl-or-bsd", "dual bsd gpl"),
    ("gpl-or-bsd", "alternatively this software may be distributed under the terms of the gnu general public license"),
    ("bsl", "distributed under the boost software license version 1 0"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("openssl", "this product includes software developed by the openssl project"),
    ("artistic", "you may distribute under the terms of either the gnu general public license or the artistic license"),
    ("proprietary", "this software is proprietary and confidential"),
    ("proprietary", "no part of this (?:software|code|file) may be reproduced"),
)
_RESERVED = ("proprietary", "all rights reserved")
NOTICE, STATEMENT, IDENTIFIER, NAME, RESERVED = range(5)
CONFIDENCE = {NOTICE: 1.0, STATEMENT: 0.9, IDENTIFIER: 0.8, NAME: 0.5, RESERVED: 0.5}
# The license goes on to later versions, or does not; after a version.
_EXTENTS = (
    ("-or-later", "(?: or later| or newer| or any later version| or at your option any later version)"),
    ("-only", " only"),
)
_WITH_EXTENT = ("gpl", "lgpl", "agpl", "gfdl")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str
    names: tuple[str, ...] = ()


@dataclass(frozen=True)
class Detection:
    label: str
    priority: int
    first_word: int
    end_word: int


@cache
def signature_rules() -> tuple[Rule, ...]:
    """All rules in order of priority."""
    rules = [Rule(label, NOTICE, _longest_word(words), words) for label, words in _NOTICES]
    rules += [Rule(label, NOTICE, _longest_word(words), words) for label, words in _STATEMENTS]
    rules.append(Rule(_RESERVED[0], RESERVED, "reserved", _RESERVED[1]))
    under = "(?:licen[sc]ed|released|distributed|available|provided|published|covered) under"
    for label, name, versions, url in _FAMILIES:
        names, place = tuple(f" {text}" for text in _spellings(name)), (f" {url}",)
        for version in versions:
            full = f"{label}-{version.replace(' ', '.')}"
            named = f"(?:the )?(?:terms of (?:the )?)?{name}(?: licen[sc]e)?(?: version| v|v)? ?{version}"
            for extent, words in _EXTENTS if label in _WITH_EXTENT else ():
                rules += [
                    Rule(full + extent, STATEMENT, "under", f"{under} {named}{words}", names),
                    Rule(full + extent, IDENTIFIER, "spdx", f"spdx license identifier {label} {version}{words}"),
                    Rule(full + extent, NAME, version.split()[0], f"{name}(?: licen[sc]e)?(?: version| v|v)? ?{version}{words}", names),
                ]
            rules += [
                Rule(full, STATEMENT, "under", f"{under} {named}", names),
                Rule(full, IDENTIFIER, "spdx", f"spdx license identifier {label.replace('-', ' ')} {version}"),
                Rule(full, IDENTIFIER, url.split()[-1], f"{url} {version}", place),
                Rule(full, NAME, version.split()[0], f"{name}(?: licen[sc]e)?(?: version| v|v)? ?{version}", names),
            ]
        rules += [
            Rule(label, STATEMENT, "under", f"{under} (?:the )?(?:terms of (?:the )?)?{name}(?: licen[sc]e)?", names),
            Rule(label, IDENTIFIER, "spdx", f"spdx license identifier {label.replace('-', ' ')}"),
            Rule(label, IDENTIFIER, url.split()[-1], url, place),
            Rule(label, NAME, "licen", f"{name} licen[sc]e", names),
        ]
    return tuple(sorted(rules, key=lambda rule: rule.priority))


def _longest_word(pattern: str) -> str:
    return max(re.findall(r"(?<![(|?])\b[a-z]+\b(?![)|?])", pattern), key=len)


def _spellings(pattern: str) -> list[str]:
    """All texts of a pattern that has groups, alternatives, classes and ``?`` only."""

    def either(at: int) -> tuple[list[str], int]:
        out, at = series(at)
        while pattern[at : at + 1] == "|":
            more, at = series(at + 1)
            out = out + more
        return out, at

    def series(at: int) -> tuple[list[str], int]:
        out = [""]
        while at < len(pattern) and pattern[at] not in "|)":
            if pattern.startswith("(?:", at):
                part, at = either(at + 3)
                at += 1
            elif pattern[at] == "[":
                end = pattern.index("]", at)
                part, at = list(pattern[at + 1 : end]), end + 1
            else:
                part, at = [pattern[at]], at + 1
            if pattern[at : at + 1] == "?":
                part, at = [*part, ""], at + 1
            out = [a + b for a in out for b in part]
        return out, at

    return either(0)[0]


def _flat(text: str) -> bytes:
    return text.encode("utf-8", "replace").translate(_TO_WORDS)


def words_of(text: str) -> list[bytes]:
    """The words of a text as UTF-8."""
    return _flat(text).split()


class Scanner:
    def __init__(self) -> None:
        import ahocorasick

        self._rules = [
            (rule, re.compile(rf"(?<= )(?:{rule.pattern})(?= )")) for rule in signature_rules()
        ]
        sought: dict[str, list[int]] = {}
        for k, (rule, _) in enumerate(self._rules):
            for words in rule.names or (rule.keyword,):
                sought.setdefault(words, []).append(k)
        self._sought = ahocorasick.Automaton()
        for words, rules in sought.items():
            self._sought.add_word(words, tuple(rules))
        self._sought.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[str, int]], list[Detection]]:
        """Number of words, base phrases as (label, first word), detections."""
        flat = _flat(text)
        words = flat.split()
        line = " " + b" ".join(words).decode("utf-8", "replace") + " "
        phrases = [(phrase, label) for phrase, label in BASE if f" {phrase} " in line]
        rules = self._running(line)
        if not phrases and not rules:
            return len(words), [], []
        starts = [0, *accumulate(len(word) + 1 for word in line[1:-1].split(" "))]
        base = [
            (label, bisect_right(starts, match.start()) - 1)
            for phrase, label in phrases
            for match in re.finditer(f"(?= {phrase} )", line)
        ]
        return len(words), base, resolve(self._detections(line, starts, rules))

    def _running(self, line: str) -> list[int]:
        found = {k for rules in {rules for _, rules in self._sought.iter(line)} for k in rules}
        return sorted(k for k in found if self._rules[k][0].keyword in line)

    def _detections(self, line: str, starts: list[int], rules: list[int]) -> list[Detection]:
        return [
            Detection(
                rule.label,
                rule.priority,
                bisect_right(starts, match.start() - 1) - 1,
                bisect_right(starts, match.end() - 1),
            )
            for rule, pattern in map(self._rules.__getitem__, rules)
            for match in pattern.finditer(line)
        ]


def resolve(found: list[Detection]) -> list[Detection]:
    """Better priority first, then the longer; one that lies within a kept one, or that
    overlaps a kept one of better priority, goes; so do reserved rights beside a license."""
    kept: dict[int, list[Detection]] = {}
    longest = max((d.end_word - d.first_word for d in found), default=0)
    for d in sorted(
        set(found), key=lambda d: (d.priority, d.first_word - d.end_word, d.first_word, d.label)
    ):
        near = [
            k for at in range(d.first_word - longest, d.end_word) for k in kept.get(at, ())
        ]
        if not any(
            (k.first_word <= d.first_word and d.end_word <= k.end_word)
            or (k.priority < d.priority and d.first_word < k.end_word)
            for k in near
        ):
            kept.setdefault(d.first_word, []).append(d)
    every = [d for places in kept.values() for d in places]
    if any(d.priority < RESERVED and d.label not in ("no-warranty", "proprietary") for d in every):
        every = [d for d in every if d.priority < RESERVED]
    return sorted(every, key=lambda d: (d.first_word, d.label))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: words, base phrases and detections, with word places."""

    def scanner():
        scan = Scanner().scan

        def rows_of(doc_id, text):
            n_words, base, found = scan(text)
            return [
                (
                    doc_id,
                    n_words,
                    [{"label": label, "first_word": at} for label, at in base],
                    [
                        {
                            "label": d.label, "first_word": d.first_word, "end_word": d.end_word,
                            "confidence": CONFIDENCE[d.priority],
                        }
                        for d in found
                    ],
                )
            ]

        return rows_of

    schema = (
        "doc_id long, n_words long, base array<struct<label:string,first_word:long>>, "
        "detections array<struct<label:string,first_word:long,end_word:long,confidence:double>>"
    )
    return per_row(texts_of(docs, id_col, text_col), schema, ("doc_id", "text"), scanner)


def license_digest(found: DataFrame) -> DataFrame:
    return found.selectExpr(
        "doc_id",
        "n_words",
        "cast(size(base) as long) AS n_base",
        "array_min(base.first_word) AS first_word",
        "array_max(base.first_word) AS last_word",
        "array_join(array_sort(array_distinct(base.label)), ',') AS base_labels",
        "array_join(array_sort(array_union(base.label, detections.label)), ',') AS labels",
        "greatest(coalesce(array_max(detections.confidence), 0D), "
        f"if(size(base) > 0, {CONFIDENCE[NAME]}D, 0D)) AS score",
    )
