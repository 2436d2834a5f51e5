"""License scan with ordered signature rules.

A text becomes its lower-cased words joined by one space.  Rules are regular
expressions on that form: license names and SPDX ids under statement templates,
ids joined by "or" or "and", and phrases of license bodies and notices; a rule
only runs when its keywords occur in the text.  Overlapping detections are
resolved by priority: a detection inside the interval of one that is at least
as strong is dropped.  Fixed base phrases are always reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_arrow, utf8, WORD_TABLE

# Phrases that count as base detections, and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# License label, keyword, names as patterns on lower-cased words.
NAMES = (
    ("mit", "mit", ("mit license", "mit licence", "mit x11 license")),
    ("apache-1", "apache", ("apache (?:software )?license (?:version |v ?)?1(?: [01])?", "apache 1 [01]")),
    ("apache-2", "apache", ("apache (?:software )?license (?:version |v ?)?2(?: 0)?", "apache 2 0")),
    ("apache", "apache", ("apache (?:software )?license",)),
    ("gpl-2", "general public", ("gnu general public license (?:version |v ?)2(?: 0)?",)),
    ("gpl-3", "general public", ("gnu general public license (?:version |v ?)3(?: 0)?",)),
    ("gpl", "general public", ("gnu general public licen[cs]e",)),
    ("gpl-2", "gpl", ("gpl ?v?2(?: 0)?(?: only| or later)?",)),
    ("gpl-3", "gpl", ("gpl ?v?3(?: 0)?(?: only| or later)?",)),
    ("gpl", "gpl", ("gnu gpl", "the gpl")),
    ("lgpl-2.1", "lesser general", ("gnu lesser general public license (?:version |v ?)2 1",)),
    ("lgpl-3", "lesser general", ("gnu lesser general public license (?:version |v ?)3(?: 0)?",)),
    ("lgpl-2", "library general", ("gnu library general public license (?:version |v ?)2(?: 0)?",)),
    ("lgpl", "general public", ("gnu (?:lesser|library) general public licen[cs]e",)),
    ("lgpl-2.1", "lgpl", ("lgpl ?v?2 1(?: only| or later)?",)),
    ("lgpl-3", "lgpl", ("lgpl ?v?3(?: 0)?(?: only| or later)?",)),
    ("lgpl", "lgpl", ("gnu lgpl", "the lgpl")),
    ("agpl-3", "affero", ("gnu affero general public license (?:version |v ?)3(?: 0)?",)),
    ("agpl", "affero", ("(?:gnu )?affero general public licen[cs]e",)),
    ("agpl-3", "agpl", ("agpl ?v?3(?: 0)?(?: only| or later)?",)),
    ("gfdl", "free documentation", ("gnu free documentation licen[cs]e(?: version 1 [123])?",)),
    ("bsd-2-clause", "bsd", ("bsd 2 clause(?: license)?", "2 clause bsd(?: license)?", "simplified bsd license", "freebsd license")),
    ("bsd-3-clause", "bsd", ("bsd 3 clause(?: license)?", "3 clause bsd(?: license)?", "new bsd license", "modified bsd license", "revised bsd license")),
    ("bsd-4-clause", "bsd", ("bsd 4 clause(?: license)?", "4 clause bsd(?: license)?", "original bsd license")),
    ("0bsd", "0bsd", ("0bsd", )),
    ("bsd", "bsd", ("bsd licen[cs]e", "bsd style licen[cs]e")),
    ("isc", "isc licen", ("isc licen[cs]e",)),
    ("mpl-1.1", "mozilla public", ("mozilla public license (?:version |v ?)1 [01]",)),
    ("mpl-2", "mozilla public", ("mozilla public license (?:version |v ?)2(?: 0)?",)),
    ("mpl", "mozilla public", ("mozilla public licen[cs]e",)),
    ("mpl-2", "mpl", ("mpl ?v?2(?: 0)?",)),
    ("epl-1", "eclipse public", ("eclipse public license (?:version |v ?)?1(?: 0)?",)),
    ("epl-2", "eclipse public", ("eclipse public license (?:version |v ?)?2(?: 0)?",)),
    ("epl", "eclipse public", ("eclipse public licen[cs]e",)),
    ("edl-1", "eclipse distribution", ("eclipse distribution license(?: (?:version |v ?)?1(?: 0)?)?",)),
    ("cddl-1", "common development", ("common development and distribution license(?: (?:version |v ?)?1(?: [01])?)?",)),
    ("cpl-1", "common public", ("common public license(?: (?:version |v ?)?1(?: 0)?)?",)),
    ("eupl", "european union public", ("european union public licen[cs]e(?: (?:version |v ?)?1 [012])?",)),
    ("artistic-2", "artistic license", ("artistic license (?:version |v ?)?2(?: 0)?",)),
    ("artistic", "artistic license", ("artistic license",)),
    ("bsl-1", "boost software", ("boost software license(?: (?:version |v ?)?1(?: 0)?)?",)),
    ("zlib", "zlib", ("zlib licen[cs]e", "zlib libpng license")),
    ("unlicense", "unlicense", ("the unlicense",)),
    ("wtfpl", "wtfpl", ("wtfpl",)),
    ("psf-2", "python software", ("python software foundation license(?: (?:version |v ?)?2)?",)),
    ("php-3", "php license", ("php license(?: (?:version |v ?)?3(?: 0| 01)?)?",)),
    ("ruby", "ruby license", ("ruby license",)),
    ("postgresql", "postgresql licen", ("postgresql licen[cs]e",)),
    ("openssl", "openssl license", ("openssl license",)),
    ("ofl-1.1", "open font", ("sil open font license(?: (?:version |v ?)?1 1)?", "open font license(?: (?:version |v ?)?1 1)?")),
    ("ms-pl", "microsoft public", ("microsoft public license",)),
    ("ms-rl", "microsoft reciprocal", ("microsoft reciprocal license",)),
    ("upl-1", "universal permissive", ("universal permissive license(?: (?:version |v ?)?1(?: 0)?)?",)),
    ("ncsa", "ncsa", ("university of illinois ncsa open source license", "ncsa open source license")),
    ("afl-3", "academic free", ("academic free license(?: (?:version |v ?)?3(?: 0)?)?",)),
    ("osl-3", "open software license", ("open software license(?: (?:version |v ?)?3(?: 0)?)?",)),
    ("blueoak-1", "blue oak", ("blue oak model license(?: 1 0 0)?",)),
    ("odbl-1", "open database", ("open database license(?: (?:version |v ?)?1(?: 0)?)?",)),
    ("odc-by-1", "open data commons", ("open data commons attribution license",)),
    ("pddl-1", "public domain dedication", ("open data commons public domain dedication and license",)),
    ("cc0", "cc0", ("cc0(?: 1 0)?(?: universal)?",)),
    ("public-domain", "public domain", ("(?:in|into|to) the public domain", "public domain dedication")),
    ("elastic-2", "elastic license", ("elastic license(?: 2 0| v2)?",)),
    ("sspl-1", "server side public", ("server side public license(?: (?:version |v ?)?1)?",)),
    ("busl-1.1", "business source", ("business source license(?: 1 1)?",)),
    ("polyform-nc", "polyform", ("polyform noncommercial license(?: 1 0 0)?",)),
    ("openrail-m", "openrail", ("(?:creativeml |bigscience )?openrail(?: m)?",)),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
    ("mit", "expat licen", ("expat licen[cs]e",)),
)

# License label, keyword, SPDX ids and short names, which count only after a statement's words.
IDS = (
    ("mit", "mit", ("(?:the )?mit(?! (?:de[rmn]|diese[rmn]|eine[rmn]?) )",)),
    ("mit", "expat", ("expat",)),
    ("mit-0", "mit ", ("mit 0", "mit no attribution")),
    ("apache-1", "apache", ("apache ?v?1 [01]",)),
    ("apache-2", "apache", ("apache ?(?:version |v)?2(?: 0)?",)),
    ("apache-2", "asl", ("asl 2 0",)),
    ("apache", "apache", ("apache",)),
    ("gpl-1", "gpl", ("(?:gnu )?gpl ?(?:version |v)?1(?: 0)?(?: only| or later)?",)),
    ("gpl-2", "gpl", ("(?:gnu )?gpl ?(?:version |v)?2(?: 0)?(?: only| or later)?",)),
    ("gpl-3", "gpl", ("(?:gnu )?gpl ?(?:version |v)?3(?: 0)?(?: only| or later)?",)),
    ("gpl", "gpl", ("(?:gnu )?gpl",)),
    ("lgpl-2", "lgpl", ("(?:gnu )?lgpl ?(?:version |v)?2(?: 0)?(?! 1 )(?: only| or later)?",)),
    ("lgpl-2.1", "lgpl", ("(?:gnu )?lgpl ?(?:version |v)?2 1(?: only| or later)?",)),
    ("lgpl-3", "lgpl", ("(?:gnu )?lgpl ?(?:version |v)?3(?: 0)?(?: only| or later)?",)),
    ("lgpl", "lgpl", ("(?:gnu )?lgpl",)),
    ("agpl-1", "agpl", ("agpl 1 0(?: only| or later)?",)),
    ("agpl-3", "agpl", ("(?:gnu )?agpl ?(?:version |v)?3(?: 0)?(?: only| or later)?",)),
    ("agpl", "agpl", ("(?:gnu )?agpl",)),
    ("gfdl", "fdl", ("(?:gnu )?g?fdl(?: 1 [123])?(?: (?:no )?invariants)?(?: only| or later)?",)),
    ("bsd-2-clause", "bsd", ("bsd 2(?: clause)?",)),
    ("bsd-3-clause", "bsd", ("bsd 3(?: clause)?",)),
    ("bsd-4-clause", "bsd", ("bsd 4(?: clause)?",)),
    ("0bsd", "0bsd", ("0bsd",)),
    ("bsd", "bsd", ("bsd",)),
    ("isc", "isc", ("isc",)),
    ("hpnd", "hpnd", ("hpnd",)),
    ("mpl-1.1", "mpl", ("mpl ?(?:version |v)?1 [01]",)),
    ("mpl-2", "mpl", ("mpl ?(?:version |v)?2(?: 0)?(?: no copyleft exception)?",)),
    ("mpl", "mpl", ("mpl",)),
    ("epl-1", "epl", ("epl ?(?:version |v)?1(?: 0)?",)),
    ("epl-2", "epl", ("epl ?(?:version |v)?2(?: 0)?",)),
    ("epl", "epl", ("epl",)),
    ("edl-1", "edl", ("edl ?v?1(?: 0)?",)),
    ("cddl-1", "cddl", ("cddl(?: ?v?1(?: [01])?)?",)),
    ("cpl-1", "cpl", ("cpl(?: ?v?1(?: 0)?)?",)),
    ("eupl", "eupl", ("eupl(?: ?v?1 [012])?",)),
    ("artistic-2", "artistic", ("artistic ?v?2(?: 0)?",)),
    ("artistic", "artistic", ("artistic 1 0(?: perl| cl8)?",)),
    ("bsl-1", "bsl", ("bsl 1 0",)),
    ("zlib", "zlib", ("zlib(?: acknowledgement| libpng)?",)),
    ("unlicense", "unlicen", ("unlicen[cs]e",)),
    ("wtfpl", "wtfpl", ("wtfpl",)),
    ("psf-2", "psf", ("psf(?: 2(?: 0)?)?",)),
    ("psf-2", "python 2", ("python 2 0(?: 1)?",)),
    ("php-3", "php 3", ("php 3 0?[01]",)),
    ("ruby", "ruby", ("ruby",)),
    ("postgresql", "postgresql", ("postgresql",)),
    ("openssl", "openssl", ("openssl(?: standalone)?",)),
    ("ofl-1.1", "ofl", ("(?:sil )?ofl(?: 1 1)?(?: no rfn| rfn)?",)),
    ("ms-pl", "ms pl", ("ms pl",)),
    ("ms-rl", "ms rl", ("ms rl",)),
    ("upl-1", "upl", ("upl(?: 1 0)?",)),
    ("ncsa", "ncsa", ("ncsa",)),
    ("afl-3", "afl", ("afl ?v?3(?: 0)?",)),
    ("osl-3", "osl", ("osl ?v?3(?: 0)?",)),
    ("blueoak-1", "blueoak", ("blueoak 1 0 0",)),
    ("odbl-1", "odbl", ("odbl(?: ?v?1(?: 0)?)?",)),
    ("odc-by-1", "odc by", ("odc by(?: 1 0)?",)),
    ("pddl-1", "pddl", ("pddl(?: 1 0)?",)),
    ("cc0", "cc0", ("cc0(?: 1 0)?",)),
    ("elastic-2", "elastic", ("elastic 2 0",)),
    ("elastic-2", "elv2", ("elv2",)),
    ("sspl-1", "sspl", ("sspl(?: ?v?1(?: 0)?)?",)),
    ("busl-1.1", "busl", ("busl 1 1",)),
    ("polyform-nc", "polyform", ("polyform noncommercial(?: 1 0 0)?",)),
)

# License label, keyword, phrases of license bodies and notices; later ones of a label's kin hold more.
_BSD = "redistribution and use in source and binary forms with or without modification(?: [^ ]+){0,6} permitted provided that the following conditions are met"
_ON = "(?:(?!licen[cs]e|redistribution and use in source|permission is hereby).){1,1500}?"
_FREE = "is free software (?:[^ ]+ ){0,4}redistribute it and or modify it under the terms of "
_GNU = (("gpl-2", "general public", "general public", "2(?! 1 )(?: 0)?"), ("gpl-3", "general public", "general public", "3(?: 0)?"),
        ("lgpl-2", "general public", "(?:library|lesser) general public", "2(?! 1 )(?: 0)?"),
        ("lgpl-2.1", "lesser general", "lesser general public", "2 1"), ("lgpl-3", "lesser general", "lesser general public", "3(?: 0)?"),
        ("agpl-3", "affero", "affero general public", "3(?: 0)?"))
_FSF = "as published by the free software foundation"
BODIES = (
    ("mit", "obtaining a copy of", ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",)),
    ("ncsa", "to deal with the software", (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction",)),
    ("ofl-1.1", "font software", ("permission is hereby granted free of charge to any person obtaining a copy of the font software",)),
    ("bsl-1", "person or organization", ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation",)),
    ("upl-1", "documentation and or data", ("permission is hereby granted to any person obtaining a copy of this software associated documentation and or data",)),
    ("isc", "with or without fee", ("permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that",)),
    ("0bsd", "with or without fee", ("permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?! provided that )",)),
    ("hpnd", "and its documentation", ("permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose(?: and)?(?: is hereby granted)? without fee(?! and without a written agreement )",)),
    ("postgresql", "written agreement", ("permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted",)),
    ("bsd-2-clause", "redistribution and use", (_BSD,)),
    ("bsd-3-clause", "redistribution and use", (f"{_BSD}{_ON} (?:neither the names? of|the names? of [^.]{{1,80}}? (?:may|must) not be used to endorse)",)),
    ("bsd-4-clause", "advertising materials", (f"{_BSD}{_ON} all advertising materials mentioning features or use of this software(?:{_ON} (?:neither the names? of|the names? of [^.]{{1,80}}? (?:may|must) not be used to endorse))?",)),
    ("apache-1", "apache software foundation", (f"{_BSD}{_ON} this product includes software developed by the apache software foundation",)),
    ("openssl", "openssl project", (f"{_BSD}{_ON} this product includes software developed by the openssl project",)),
    ("php-3", "php", (f"{_BSD}{_ON} the name php must not be used to endorse",)),
    ("zlib", "any purpose including commercial", ("permission is granted to anyone to use this software for any purpose including commercial applications",)),
    ("zlib", "be held liable", ("this software is provided as is without any express or implied warranty in no event will the authors? be held liable",)),
    *((label, keyword, (f"{_FREE}(?:the )?gnu {name} licen[cs]e {_FSF} (?:either )?version {v}",
                        f"{_FREE}(?:the )?gnu {name} licen[cs]e version {v} {_FSF}",
                        f"{_FREE}version {v} of the gnu {name} licen[cs]e"))
      for label, keyword, name, v in _GNU),
    ("gpl", "general public", (f"{_FREE}(?:the )?gnu general public licen[cs]e(?! version| {_FSF} (?:either )?version)",)),
    ("gpl", "is free software", ("this (?:program|file|software|package) is free software you can redistribute it and or modify it(?! under the terms of )",)),
    ("gpl-2", "freedom to share", ("freedom to share and change it by contrast the gnu general public license is intended to guarantee",)),
    ("gpl-3", "copyleft license", ("the gnu general public license is a free copyleft license for software and other kinds of works",)),
    ("agpl-3", "copyleft license", ("the gnu affero general public license is a free copyleft license for software and other kinds of works",)),
    ("lgpl", "freedom to share", ("freedom to share and change it by contrast the gnu general public licenses are intended to guarantee",)),
    ("lgpl-3", "incorporates the terms", ("this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license",)),
    ("gfdl", "textbook", ("the purpose of this license is to make a manual textbook or other functional and useful document free",)),
    ("apache-2", "contributor license", ("licensed to the apache software foundation asf under one or more contributor license agreements",)),
    ("apache-2", "sections 1 through 9", ("license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document",)),
    ("apache-2", "you may not use this file", ("you may not use this file except in compliance with the license(?: (?:[^ ]+ ){0,20}?apache org licenses license 2 0)?",)),
    ("mpl-1.1", "contents of this file", ("the contents of this file are subject to the mozilla public license version 1 [01]",)),
    ("mpl-2", "source code form", ("this source code form is subject to the terms of the mozilla public license(?: v ?| version )2 0",
                                   "covered software means source code form to which the initial contributor has attached the notice in exhibit a")),
    ("epl", "eclipse public", ("the accompanying program is provided under the terms of this eclipse public license",)),
    ("cpl-1", "common public", ("the accompanying program is provided under the terms of this common public license",)),
    ("cddl-1", "covered software means", ("covered software means a the original software or b modifications",)),
    ("artistic", "intent of this document", ("the intent of this document is to state the conditions under which a package may be copied",)),
    ("artistic-2", "given free software package", ("this license establishes the terms under which a given free software package may be copied modified distributed",)),
    ("unlicense", "unencumbered", ("this is free and unencumbered software released into the public domain",)),
    ("wtfpl", "what the fuck", ("do what the fuck you want to",)),
    ("cc0", "neighboring rights", ("waived all copyright and related or neighboring rights",)),
    ("cc0", "affirmer hereby", ("affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders",)),
    ("psf-2", "python software", ("this license agreement is between the python software foundation(?: psf)? and the individual or organization",)),
    ("ms-pl", "accept this license", ("this license governs use of the accompanying software if you use the software you accept this license",)),
    ("ms-rl", "reciprocal grants", ("this license governs use of the accompanying software if you use the software you accept this license(?:.){1,4000}? reciprocal grants",)),
    ("odbl-1", "odbl", ("the open database license odbl is a license agreement intended to allow users to freely share modify and use this database",)),
    ("busl-1.1", "non production use", ("grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work",)),
    ("sspl-1", "as a service", ("make the functionality of the program or a modified version available to third parties as a service",)),
    ("elastic-2", "managed service", ("you may not provide the software to third parties as a hosted or managed service",)),
    ("polyform-nc", "permitted purpose", ("any noncommercial purpose is a permitted purpose",)),
    ("blueoak-1", "as much permission", ("this license gives everyone as much permission to work with this software as possible",)),
    ("openrail-m", "use restrictions", ("use restrictions you agree not to use the model or derivatives of the model",)),
    ("proprietary", "proprietary information", ("confidential and proprietary information of",)),
)
#: A reservation of rights that leads to a license body belongs to that body.
_RESERVED = r"(?:all rights reserved (?:(?!licen|spdx|permission|public|redistribution|confidential)[^ ]+ ){0,40}?)?"

# Creative Commons elements, as the words of their short and long names.
CC_ELEMENTS = (("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution share ?alike"),
               ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative|ativ)e?s"),
               ("cc-by-nc", "by nc", "attribution non ?commercial"),
               ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
               ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative|ativ)e?s"))

# Statement templates as (name, priority, confidence, words before the license name, a part of these).
STATEMENTS = (
    ("spdx", 50, 1.0, "spdx license identifier ", "spdx license identifier "),
    ("licensed", 40, 0.95, "(?:is |are )?(?:dual )?licen[cs]ed (?:to you )?under (?:the )?(?:terms of )?(?:the |a |an )?", "ed under "),
    ("released", 40, 0.95, "(?:released|distributed|published|available|provided|redistributed) under (?:the )?(?:terms of )?(?:the |a |an )?", " under "),
    ("permission", 35, 0.9, "(?:terms|conditions) of (?:the |a |an )?", "s of "),
    ("stated", 30, 0.85, "(?:license|licence|license type) (?:is )?", "licen"),
    ("named", 10, 0.6, "", ""),
)


@dataclass(frozen=True)
class Signature:
    name: str
    label: str
    priority: int
    confidence: float
    keyword: bytes
    pattern: re.Pattern
    also: bytes = b""      # a second keyword


def signatures() -> list[Signature]:
    """All rules, strongest first: every license name under every statement template,
    every id under all but the bare one and after "or" and "and", every body."""
    names = list(NAMES)
    for label, short, long in CC_ELEMENTS:
        versions = r"(?: (?:version )?[1-4] [05])?(?: international)?"
        names.append((label, "cc " + short, (f"cc {short}(?! (?:nc|nd|sa)\\b){versions}",)))
        names.append((label, "creative commons", (
            f"creative commons {long}(?! (?:non|no|share))(?: license)?{versions}",)))
    out = []

    def add(name, label, priority, confidence, keyword, also, words):
        out.append(Signature(name, label, priority, confidence, keyword.encode(),
                             re.compile(rf"(?<= ){words}(?= )".encode()), also.encode()))

    for i, (label, keyword, patterns) in enumerate(names):
        for kind, priority, confidence, before, also in STATEMENTS:
            add(f"{label}/{kind}/{i}", label, priority, confidence, keyword, also, f"{before}(?:{'|'.join(patterns)})")
    every = "|".join(p for _, _, patterns in IDS for p in patterns)
    for i, (label, keyword, patterns) in enumerate(IDS):
        body = "|".join(patterns)
        for kind, priority, confidence, before, also in STATEMENTS[:-1]:
            add(f"{label}/{kind}-id/{i}", label, priority, confidence, keyword, also, f"{before}(?:{body})")
        add(f"{label}/joined-id/{i}", label, 45, 0.95, keyword, "spdx license identifier ", f"(?:{every}) (?:or|and) (?:{body})")
    for i, (label, keyword, patterns) in enumerate(BODIES):
        add(f"{label}/body/{i}", label, 60 + i, 0.95, keyword, "", f"{_RESERVED}(?:{'|'.join(patterns)})")
    return sorted(out, key=lambda s: (-s.priority, -s.confidence, s.name))


@dataclass(frozen=True)
class Detection:
    begin: int
    end: int
    signature: Signature


def detect(canonical: bytes, rules: list[Signature]) -> list[Detection]:
    """Detections in ``b" words joined by one space "`` that no stronger one contains, in text order.

    Stronger is a higher priority, then a longer interval, then the earlier rule."""
    present: dict[bytes, bool] = {}
    found = []
    for order, rule in enumerate(rules):
        if rule.keyword not in present:
            present[rule.keyword] = rule.keyword in canonical
        if present[rule.keyword] and rule.also not in present:
            present[rule.also] = rule.also in canonical
        if present[rule.keyword] and present[rule.also]:
            found += [(-rule.priority, m.start() - m.end(), order, Detection(m.start(), m.end(), rule))
                      for m in rule.pattern.finditer(canonical)]
    found.sort(key=lambda x: x[:3] + (x[3].begin,))
    kept: list[Detection] = []
    reach: list[tuple[int, int]] = []     # kept intervals, sorted by begin
    from bisect import bisect_right, insort
    for *_, d in found:
        # an interval that contains d begins at or before it; kept ones never contain each other,
        # so of those the last to begin reaches furthest
        at = bisect_right(reach, (d.begin, 1 << 62))
        if at and reach[at - 1][1] >= d.end:
            continue
        kept.append(d)
        lo = at
        while lo < len(reach) and reach[lo][1] <= d.end:   # weaker reach is covered by d from now on
            reach.pop(lo)
        if not at or reach[at - 1][1] < d.end:
            insort(reach, (d.begin, d.end))
    return sorted(kept, key=lambda d: (d.begin, d.end))


def _places(canonical: bytes, phrase: bytes) -> list[int]:
    """Byte offsets of the phrase's first word, for every place."""
    out, at = [], canonical.find(b" " + phrase + b" ")
    while at >= 0:
        out.append(at + 1)
        at = canonical.find(b" " + phrase + b" ", at + 1)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, detections`` (an array of label, rule, first word, words, confidence).

    ``score`` is the chance that one detection at least is right, if each is with
    its confidence and independently (base phrases: 0.95); 0 without any.  Null
    and empty texts have no words.  Rows are independent: nulls elsewhere, ties
    and repeated rows change nothing; an empty table stays empty.  Other columns
    are not read."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    detection = T.StructType([T.StructField("label", T.StringType()), T.StructField("rule", T.StringType()),
                              T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
                              T.StructField("confidence", T.DoubleType())])
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("detections", T.ArrayType(detection))])
    kind = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("first_word", pa.int64()),
                               ("n_words", pa.int64()), ("confidence", pa.float64())]))
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), kind]

    def one(text: bytes, rules: list[Signature]):
        words = text.translate(WORD_TABLE).split()
        canonical = b" " + b" ".join(words) + b" "
        # a word starting at byte b is word number: spaces before b, less the leading one
        blanks = np.flatnonzero(np.frombuffer(canonical, np.uint8) == 0x20)
        word = lambda b: int(np.searchsorted(blanks, b)) - 1
        places = [(p, label) for phrase, label in BASE_PHRASES for p in _places(canonical, phrase.encode())]
        base = {label for _, label in places}
        kept = detect(canonical, rules)
        doubt = 1.0
        for d in kept:
            doubt *= 1.0 - d.signature.confidence
        for _ in base:
            doubt *= 0.05
        rows = [{"label": d.signature.label, "rule": d.signature.name,
                 "first_word": word(d.begin), "n_words": word(d.end) - word(d.begin) + 1,
                 "confidence": d.signature.confidence} for d in kept]
        at = sorted(p for p, _ in places)
        return (len(words), len(places), word(at[0]) if at else None, word(at[-1]) if at else None, ",".join(sorted(base)),
                ",".join(sorted(base | {d.signature.label for d in kept})), 1.0 - doubt, rows)

    def run(batches):
        rules = signatures()
        for b in batches:
            made = list(zip(*[one(t, rules) for t in utf8(b.column(1))])) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(v), k) for v, k in zip(made, kinds))],
                                             names=schema.names)

    return map_arrow(rows, run, schema)
