"""The signature rules of the license scan.

Rules match normalised text: lower-case words with one space between. Each license
family gives its name as a pattern (words), the version pattern, its SPDX
identifiers as words, and a phrase of its own where it has one; every form
of mention is one rule with a tier (1 is the strongest) and a confidence.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    keyword: str        # literal text without which the pattern cannot match
    pattern: str        # matches whole words
    label: str
    tier: int
    confidence: float
    base: bool = False


# label, keyword, name, version, SPDX identifier as words
FAMILIES = [
    ("mit", "mit", r"mit", None, r"mit"),
    ("mit-0", "mit", r"mit no attribution", None, r"mit 0"),
    ("apache", "apache", r"apache(?: software)?", r"[12](?: [01])?", r"apache 2 0"),
    ("gpl", "general public", r"(?:gnu )?general public", r"[123](?: 0)?", r"gpl [123] 0(?: only| or later)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl", r"v?[123](?: 0)?", r"gpl [123] 0"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public", r"[23](?: [01])?", r"lgpl [23] [01](?: only| or later)?"),
    ("lgpl", "library general", r"(?:gnu )?library general public", r"2(?: 0)?", r"lgpl 2 0"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", r"v?[23](?: [01])?", r"lgpl [23] [01]"),
    ("agpl", "affero", r"(?:gnu )?affero general public", r"[13](?: 0)?", r"agpl [13] 0(?: only| or later)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl", r"v?[13](?: 0)?", r"agpl [13] 0"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", r"1 [123]", r"gfdl 1 [123]"),
    ("bsd", "bsd", r"bsd", r"[01234]", r"0?bsd(?: [0234] clause)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", None, r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", None, r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", None, r"bsd 4 clause"),
    ("mpl", "mozilla", r"mozilla public", r"[12] [01]", r"mpl [12] [01]"),
    ("epl", "eclipse", r"eclipse public", r"[12] 0", r"epl [12] 0"),
    ("edl", "eclipse", r"eclipse distribution", r"1 0", r"edl 1 0"),
    ("cddl", "common development", r"common development and distribution", r"1 [01]", r"cddl 1 [01]"),
    ("cpl", "common public", r"common public", r"1 0", r"cpl 1 0"),
    ("cpal", "common public attribution", r"common public attribution", r"1 0", r"cpal 1 0"),
    ("eupl", "european union", r"european union public", r"1 [012]", r"eupl 1 [012]"),
    ("isc", "isc", r"isc", None, r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?", None, r"zlib"),
    ("boost", "boost", r"boost(?: software)?", r"1 0", r"bsl 1 0"),
    ("artistic", "artistic", r"(?:perl )?artistic", r"[12] 0", r"artistic [12] 0"),
    ("unlicense", "unlicense", r"unlicense", None, r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"2", r"wtfpl"),
    ("osl", "open software", r"open software", r"[123] [01]", r"osl [123] [01]"),
    ("afl", "academic free", r"academic free", r"[123] [012]", r"afl [123] [012]"),
    ("ofl", "open font", r"(?:sil )?open font", r"1 [01]", r"ofl 1 [01]"),
    ("ms-pl", "microsoft public", r"microsoft public", None, r"ms pl"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal", None, r"ms rl"),
    ("python", "python", r"python(?: software foundation)?", r"[23](?: [0-9])?", r"(?:psf|python) 2 0"),
    ("php", "php", r"php", r"[23] [0-9]+", r"php 3 0[01]?"),
    ("ruby", "ruby", r"ruby", None, r"ruby"),
    ("postgresql", "postgresql", r"postgresql", None, r"postgresql"),
    ("openssl", "openssl", r"openssl", None, r"openssl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", None, r"ncsa"),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)?", None, r"w3c"),
    ("zope", "zope", r"zope public", r"[12] [01]", r"zpl [12] [01]"),
    ("odbl", "open database", r"open database", r"1 0", r"odbl 1 0"),
    ("odc-by", "open data commons", r"open data commons attribution", r"1 0", r"odc by 1 0"),
    ("pddl", "public domain dedication", r"public domain dedication and", r"1 0", r"pddl 1 0"),
    ("vim", "vim", r"vim", None, r"vim"),
    ("x11", "x11", r"x11", None, r"x11"),
    ("unicode", "unicode", r"unicode", None, r"unicode dfs 201[56]"),
    ("sspl", "server side public", r"server side public", r"v?1", r"sspl 1 0"),
    ("busl", "business source", r"business source", r"1 1", r"busl 1 1"),
    ("elastic", "elastic", r"elastic", r"2 0", r"elastic 2 0"),
]

# The Creative Commons family is named by its clauses.
CC_CLAUSES = [("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nc", "attribution non ?commercial"),
              ("by nd", "attribution no ?deriv(?:ative)?s?"), ("by nc sa", "attribution non ?commercial share ?alike"),
              ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?")]

# phrases that are evidence by themselves: label, keyword, pattern, tier, confidence
PHRASES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 2, 0.95),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose", 2, 0.95),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification", 2, 0.95),
    ("apache", "apache org licenses", r"(?:www )?apache org licenses(?: license 2 0)?", 2, 0.95),
    ("gpl", "gnu org licenses", r"(?:www )?gnu org licenses gpl", 2, 0.95),
    ("lgpl", "gnu org licenses", r"(?:www )?gnu org licenses lgpl", 2, 0.95),
    ("agpl", "gnu org licenses", r"(?:www )?gnu org licenses agpl", 2, 0.95),
    ("mit", "opensource org licenses", r"opensource org licenses mit", 2, 0.95),
    ("bsd", "opensource org licenses", r"opensource org licenses bsd", 2, 0.95),
    ("isc", "opensource org licenses", r"opensource org licenses isc", 2, 0.95),
    ("mpl", "mozilla org mpl", r"(?:www )?mozilla org mpl", 2, 0.95),
    ("cc", "creativecommons org licenses", r"creativecommons org licenses", 3, 0.9),
    ("cc0", "creativecommons org publicdomain", r"creativecommons org publicdomain zero", 2, 0.95),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 3, 0.9),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 3, 0.8),
    ("public-domain", "public domain", r"(?:is|are) in the public domain", 4, 0.6),
    ("proprietary", "all rights reserved", r"all rights reserved", 5, 0.3),
    ("proprietary", "proprietary license", r"proprietary license", 4, 0.6),
    ("unlicense", "free and unencumbered", r"free and unencumbered software released into the public domain", 2, 0.95),
]

# the fixed phrases of the contract, and their labels
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

_UNDER = (r"(?:licensed|released|distributed|available|published|provided|covered|made available) "
          r"under (?:the )?(?:terms of )?(?:the )?(?:conditions of )?(?:the )?")
_LICENSE = r"licen[sc]e"


def rules() -> list[Rule]:
    """All rules, strongest tier first; the position is the last tie-break."""
    out = []
    for label, keyword, name, version, spdx in FAMILIES:
        out.append(Rule("spdx", rf"spdx {_LICENSE} identifier {spdx}", label, 1, 0.99))
        if version:
            v = rf"(?:version |v )?{version}"
            out.append(Rule(keyword, rf"{_UNDER}{name}(?: {_LICENSE})?(?: agreement)? {v}", label, 1, 0.98))
            out.append(Rule(keyword, rf"{name} {_LICENSE} {v}(?: or(?: any)? later(?: version)?)?", label, 2, 0.95))
        out.append(Rule(keyword, rf"{_UNDER}{name}(?: {_LICENSE})?", label, 2, 0.95))
        out.append(Rule(keyword, rf"(?:the )?{name} {_LICENSE}", label, 3, 0.9))
        out.append(Rule(keyword, rf"{_LICENSE}s? {name}", label, 4, 0.6))
    for clauses, words in CC_CLAUSES:
        label = "cc-" + clauses.replace(" ", "-")
        out.append(Rule("spdx", rf"spdx {_LICENSE} identifier cc {clauses} [1234] [05]", label, 1, 0.99))
        out.append(Rule(f"cc {clauses}", rf"{_UNDER}cc {clauses}(?: [1234] [05])?", label, 1, 0.98))
        out.append(Rule("creative commons", rf"{_UNDER}(?:a )?creative commons {words}(?: {_LICENSE})?", label, 1, 0.98))
        out.append(Rule("creative commons", rf"creative commons {words}(?: [1234] [05])?(?: international| generic| unported)?(?: {_LICENSE})?", label, 2, 0.95))
        out.append(Rule(f"cc {clauses}", rf"cc {clauses}(?: [1234] [05])?(?: {_LICENSE})?", label, 3, 0.9))
    for label, keyword, pattern, tier, confidence in PHRASES:
        out.append(Rule(keyword, pattern, label, tier, confidence))
    for phrase, label in BASE:
        out.append(Rule(phrase, phrase, label, 3, 0.9, base=True))
    return sorted(out, key=lambda r: r.tier)


# A text without any of these matches no rule (tested rule by rule).
GATES = ["licen", "spdx", "cc by", "cc0", "creative commons", "creativecommons", "public domain", "all rights reserved",
         "permission", "redistribution", "mozilla org", "gnu org", "opensource", "d under ", "able under "]
