"""Licence signatures: ordered rules over lower-case words joined by one space.

A rule starts at its keyword, the first word it matches; its pattern goes on from
there. Tier 1 is a full notice, tier 2 an explicit grant or identifier, tier 3 a
bare name; a lower tier wins. Within a tier the order of `RULES` decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


def _first_word(pattern: str) -> str:
    return re.match("[a-z0-9]+", pattern)[0]


@dataclass(frozen=True)
class Rule:
    label: str
    tier: int
    name: str  # without the keyword's own anchors; the first word is literal
    grant: str = ""  # what stands before the name, if anything

    @property
    def pattern(self) -> str:
        return f"{self.grant} {self.name}" if self.grant else self.name

    @property
    def keyword(self) -> str:
        return _first_word(self.pattern)

    @property
    def name_keyword(self) -> str:
        return _first_word(self.name)


# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

VER = r"(?: version)?(?: v)?"
LATER = r"(?: or (?:any )?later(?: version)?)?"

# Label and name of each licence, more special names first. The first word is literal.
NAMES: list[tuple[str, str]] = [
    ("agpl-3.0", rf"gnu affero general public license{VER} v?3(?: 0)?{LATER}"),
    ("agpl", r"gnu affero general public license"),
    ("agpl-3.0", r"agpl (?:v ?)?v?3(?: 0)?(?: only| or later)?"),
    ("lgpl-3.0", rf"gnu lesser general public license{VER} v?3(?: 0)?{LATER}"),
    ("lgpl-2.1", rf"gnu lesser general public license{VER} v?2 1{LATER}"),
    ("lgpl-2.0", rf"gnu library general public license{VER} v?2(?: 0)?{LATER}"),
    ("lgpl", r"gnu (?:lesser|library) general public license"),
    ("lgpl-3.0", r"lgpl (?:v ?)?v?3(?: 0)?(?: only| or later)?"),
    ("lgpl-2.1", r"lgpl (?:v ?)?v?2 1(?: only| or later)?"),
    ("gpl-3.0", rf"gnu general public license{VER} v?3(?: 0)?{LATER}"),
    ("gpl-2.0", rf"gnu general public license{VER} v?2(?: 0)?{LATER}"),
    ("gpl-1.0", rf"gnu general public license{VER} v?1(?: 0)?{LATER}"),
    ("gpl-3.0", r"gnu gpl (?:v ?)?v?3(?: 0)?"),
    ("gpl-2.0", r"gnu gpl (?:v ?)?v?2(?: 0)?"),
    ("gpl-3.0", r"gpl (?:v ?)?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-2.0", r"gpl (?:v ?)?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-3.0", r"gplv3"),
    ("gpl-2.0", r"gplv2"),
    ("gfdl-1.3", rf"gnu free documentation license{VER} 1 3{LATER}"),
    ("gfdl", r"gnu free documentation license"),
    ("apache-2.0", rf"apache (?:software )?license{VER} 2(?: 0)?"),
    ("apache-1.1", rf"apache (?:software )?license{VER} 1 1"),
    ("apache-1.0", rf"apache (?:software )?license{VER} 1 0"),
    ("apache-2.0", r"apache 2(?: 0)?(?: license)?"),
    ("apache-2.0", r"asl 2 0"),
    ("mpl-2.0", rf"mozilla public license{VER} 2(?: 0)?"),
    ("mpl-1.1", rf"mozilla public license{VER} 1 1"),
    ("mpl", r"mozilla public license"),
    ("mpl-2.0", r"mpl 2 0"),
    ("epl-2.0", rf"eclipse public license{VER} 2(?: 0)?"),
    ("epl-1.0", rf"eclipse public license{VER} 1(?: 0)?"),
    ("epl", r"eclipse public license"),
    ("cddl-1.0", rf"common development and distribution license{VER} 1 0"),
    ("cddl", r"common development and distribution license"),
    ("cpl-1.0", r"common public license(?: version)? 1 0"),
    ("eupl-1.2", rf"european union public licen[cs]e{VER} 1 2"),
    ("eupl", r"european union public licen[cs]e"),
    ("bsd-2-clause", r"bsd 2 clause(?: simplified)?(?: license)?"),
    ("bsd-3-clause", r"bsd 3 clause(?: new| revised| modified)?(?: license)?"),
    ("bsd-4-clause", r"bsd 4 clause(?: original)?(?: license)?"),
    ("bsd-3-clause", r"new bsd license"),
    ("bsd-3-clause", r"modified bsd license"),
    ("bsd-2-clause", r"simplified bsd license"),
    ("0bsd", r"zero clause bsd(?: license)?"),
    ("bsd", r"bsd(?: style)? license"),
    ("isc", r"isc license"),
    ("mit-0", r"mit no attribution(?: license)?"),
    ("x11", r"x11 license"),
    ("mit", r"mit(?: x11| expat)? license"),
    ("mit", r"expat license"),
    ("zlib", r"zlib(?: libpng)? license"),
    ("boost-1.0", rf"boost software license{VER}(?: 1(?: 0)?)?"),
    ("artistic-2.0", rf"artistic license{VER} 2(?: 0)?"),
    ("artistic", r"artistic license"),
    ("psf-2.0", r"python software foundation license(?: version 2)?"),
    ("php-3.01", r"php license(?: version)? 3 01"),
    ("openssl", r"openssl license"),
    ("ofl-1.1", r"sil open font license(?: version)?(?: 1 1)?"),
    ("wtfpl", r"wtfpl(?: version 2)?"),
    ("unlicense", r"unlicense"),
    ("ms-pl", r"microsoft public license"),
    ("ms-rl", r"microsoft reciprocal license"),
    ("bsl-1.1", r"business source license(?: version)?(?: 1 1)?"),
    ("sspl-1.0", r"server side public license(?: version)?(?: 1)?"),
    ("elastic-2.0", r"elastic license(?: version)?(?: 2 0)?"),
    ("odbl-1.0", r"open database license(?: version)?(?: 1 0)?"),
    ("odc-by-1.0", r"open data commons attribution license(?: v?1 0)?"),
    ("pddl-1.0", r"public domain dedication and license(?: v?1 0)?"),
    ("cc0-1.0", r"cc0(?: 1 0)?(?: universal)?"),
    ("public-domain", r"public domain"),
]

# Creative Commons terms as written short and in full.
CC_TERMS = [
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by", "by", "attribution"),
]
CC_VERSIONS = ["4.0", "3.0", "2.0"]


def _creative_commons() -> list[tuple[str, str]]:
    names = []
    for term, short, full in CC_TERMS:
        for version in CC_VERSIONS:
            digits = version.replace(".", " ")
            names.append((f"cc-{term}-{version}", rf"cc {short} {digits}(?: international| unported| generic)?"))
            names.append((f"cc-{term}-{version}",
                          rf"creative commons {full} {digits}(?: international| unported| generic)?(?: public)?(?: license)?"))
        names.append((f"cc-{term}", rf"cc {short}"))
        names.append((f"cc-{term}", rf"creative commons {full}"))
    return names


# Words before a name that make it a grant; tier 2.
GRANTS = [
    r"licensed under(?: the)?(?: terms of)?(?: the)?(?: a)?",
    r"released under(?: the)?(?: terms of)?(?: the)?(?: a)?",
    r"spdx license identifier",
]

# Openings and clauses of full notices; tier 1.
NOTICES: list[tuple[str, str]] = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("x11", r"permission to use copy modify distribute and sell this software and its documentation"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display"),
    ("gpl-3.0", rf"free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3{LATER}"),
    ("gpl-2.0", rf"free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2{LATER}"),
    ("lgpl", r"free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", r"free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-3.0", r"gnu general public license version 3 29 june 2007"),
    ("gpl-2.0", r"gnu general public license version 2 june 1991"),
    ("apache-2.0", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance"),
    ("apache-2.0", r"http www apache org licenses license 2 0"),
    ("apache-2.0", r"https www apache org licenses license 2 0"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("boost-1.0", r"distributed under the boost software license version 1 0"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", r"free and unencumbered software released into the public domain"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license"),
    ("all-rights-reserved", r"copyright (?:\S+ ){1,10}all rights reserved"),
    ("warranty-disclaimer", r"provided as is without warranty of any kind express or implied"),
]


def _rules() -> list[Rule]:
    names = [*NAMES, *_creative_commons()]
    rules = [Rule(label, 1, pattern) for label, pattern in NOTICES]
    rules += [Rule(label, 2, name, grant) for grant in GRANTS for label, name in names]
    rules += [Rule(label, 3, name) for label, name in names]
    return rules


RULES: list[Rule] = _rules()
#: More words than any rule can match.
REACH = 56
