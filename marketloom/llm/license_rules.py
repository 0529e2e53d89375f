"""Licence signatures: hand-written patterns over normalised words.

Texts are lower-cased words joined by single blanks ("Apache-2.0" reads "apache 2 0"), and so
are the patterns. Each licence names words that must all occur before its patterns are tried,
a pattern for its name, and further patterns for sentences of its text or for its web address.
Every licence gives a rule for its tag, its name, a notice ("licensed under the ...") and each
further pattern; a higher priority wins where detections overlap.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    words: frozenset[bytes]
    pattern: re.Pattern[bytes]
    priority: int
    confidence: float


#: Phrases whose every place counts, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_L = r"(?:license|licence)"
_V = r"(?: (?:version|v))? "
_LATER = r"(?: (?:or|and) (?:any |at your option any )?(?:later|newer)(?: version)?| or later)"

# label, words that must occur for the name, pattern of the name, further patterns, which begin
# with two plain words that must occur for them
LICENCES: tuple[tuple[str, str, str, tuple[str, ...]], ...] = (
    ("mit", "mit", rf"(?:the )?mit(?: expat)? {_L}", (r"opensource org licenses mit",)),
    ("mit", "permission charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software", ()),
    ("mit-0", "mit", rf"mit (?:no attribution {_L}|0 {_L})", (r"opensource org licenses mit 0",)),
    ("apache-1", "apache", rf"apache (?:software )?{_L}{_V}1 [01]", (r"apache org licenses license 1 [01]",)),
    ("apache-2", "apache", rf"apache(?: software)?(?: {_L})?{_V}2(?: 0)?(?: {_L})?", (r"apache org licenses license 2 0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis")),
    ("apache-2", "asl", r"asl 2(?: 0)?", ()),
    ("bsd-0", "bsd", rf"(?:zero|0) clause bsd(?: {_L})?|bsd zero clause(?: {_L})?", (r"opensource org licenses 0bsd",)),
    ("bsd-1", "bsd", rf"(?:1|one) clause bsd(?: {_L})?|bsd 1 clause(?: {_L})?", ()),
    ("bsd-2", "bsd", rf"(?:2|two) clause bsd(?: {_L})?|bsd (?:2|two) clause(?: {_L})?|(?:simplified|freebsd) bsd {_L}", (r"opensource org licenses bsd 2 clause",)),
    ("bsd-3", "bsd", rf"(?:3|three) clause bsd(?: {_L})?|bsd (?:3|three) clause(?: {_L})?|(?:new|modified|revised) bsd {_L}", (r"opensource org licenses bsd 3 clause",)),
    ("bsd-3", "endorse contributors", r"neither the name of .{1,80}? nor the names of (?:its|his|their) contributors may be used to endorse", ()),
    ("bsd-4", "bsd", rf"(?:4|four) clause bsd(?: {_L})?|(?:original|old) bsd {_L}", ()),
    ("bsd-4", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", ()),
    ("bsd", "bsd", rf"bsd(?: style)? {_L}", ()),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", ()),
    ("isc", "isc", rf"isc {_L}", (r"opensource org licenses isc",)),
    ("isc", "permission fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ()),
    ("gpl-1", "general", rf"(?:gnu )?general public {_L}{_V}1(?: 0)?", ()),
    ("gpl-1", "gpl", rf"(?:gnu )?gpl(?:{_V}|)1(?: 0)?", ()),
    ("gpl-2", "general", rf"(?:gnu )?general public {_L}{_V}2(?: 0)?", (r"gnu org licenses(?: old licenses)? gpl 2 0",)),
    ("gpl-2", "gpl", rf"(?:gnu )?gpl(?:{_V}|)2(?: 0)?", ()),
    ("gpl-2", "gplv2", r"gplv2", ()),
    ("gpl-2-or-later", "general", rf"(?:gnu )?general public {_L}{_V}2(?: 0)?{_LATER}", ()),
    ("gpl-2-or-later", "general", r"general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version", ()),
    ("gpl-3", "general", rf"(?:gnu )?general public {_L}{_V}3(?: 0)?", (r"gnu org licenses gpl 3 0",)),
    ("gpl-3", "gpl", rf"(?:gnu )?gpl(?:{_V}|)3(?: 0)?", ()),
    ("gpl-3", "gplv3", r"gplv3", ()),
    ("gpl-3-or-later", "general", rf"(?:gnu )?general public {_L}{_V}3(?: 0)?{_LATER}", ()),
    ("gpl-3-or-later", "general", r"general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version", ()),
    ("gpl", "general", rf"(?:gnu )?general public {_L}", (r"gnu org licenses gpl",)),
    ("gpl", "gpl", rf"(?:gnu )?gpl(?: {_L})?", ()),
    ("lgpl-2", "general", rf"(?:gnu )?library general public {_L}(?:{_V}2(?: 0)?)?", ()),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public {_L}{_V}2 1", (r"gnu org licenses(?: old licenses)? lgpl 2 1",)),
    ("lgpl-2.1", "lgpl", rf"(?:gnu )?lgpl(?:{_V}|)2 1", ()),
    ("lgpl-2.1-or-later", "lesser", rf"(?:gnu )?lesser general public {_L}{_V}2 1{_LATER}", ()),
    ("lgpl-3", "lesser", rf"(?:gnu )?lesser general public {_L}{_V}3(?: 0)?", (r"gnu org licenses lgpl 3 0",)),
    ("lgpl-3", "lgpl", rf"(?:gnu )?lgpl(?:{_V}|)3(?: 0)?", ()),
    ("lgpl-3-or-later", "lesser", rf"(?:gnu )?lesser general public {_L}{_V}3(?: 0)?{_LATER}", ()),
    ("lgpl", "lesser", rf"(?:gnu )?lesser general public {_L}", (r"gnu org licenses lgpl",)),
    ("lgpl", "lgpl", rf"(?:gnu )?lgpl(?: {_L})?", ()),
    ("agpl-3", "affero", rf"(?:gnu )?affero general public {_L}{_V}3(?: 0)?", (r"gnu org licenses agpl 3 0",)),
    ("agpl-3", "agpl", rf"(?:gnu )?agpl(?:{_V}|)3(?: 0)?", ()),
    ("agpl-3-or-later", "affero", rf"(?:gnu )?affero general public {_L}{_V}3(?: 0)?{_LATER}", ()),
    ("agpl", "affero", rf"(?:gnu )?affero general public {_L}", ()),
    ("gfdl-1.1", "documentation", rf"(?:gnu )?free documentation {_L}{_V}1 1", ()),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation {_L}{_V}1 2", ()),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation {_L}{_V}1 3", (r"gnu org licenses fdl 1 3",)),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation {_L}", (r"gnu org licenses fdl",)),
    ("mpl-1.0", "mozilla", rf"mozilla public {_L}{_V}1 0", (r"mozilla org mpl 1 0",)),
    ("mpl-1.1", "mozilla", rf"mozilla public {_L}{_V}1 1", (r"mozilla org mpl mpl 1 1",)),
    ("mpl-2", "mozilla", rf"mozilla public {_L}{_V}2(?: 0)?", (r"mozilla org (?:en us )?mpl 2 0", r"this source code form is subject to the terms of the mozilla public license v 2 0")),
    ("mpl-2", "mpl", rf"mpl(?:{_V}|)2(?: 0)?", ()),
    ("mpl", "mozilla", rf"mozilla public {_L}", ()),
    ("epl-1", "eclipse", rf"eclipse public {_L}{_V}1(?: 0)?", (r"eclipse org legal epl v10",)),
    ("epl-2", "eclipse", rf"eclipse public {_L}{_V}2(?: 0)?", (r"eclipse org legal epl (?:v20|2 0)",)),
    ("epl", "eclipse", rf"eclipse public {_L}", ()),
    ("edl-1", "eclipse", rf"eclipse distribution {_L}(?:{_V}1(?: 0)?)?", ()),
    ("cpl-1", "common", rf"common public {_L}(?:{_V}1(?: 0)?)?", ()),
    ("cddl-1.0", "cddl", rf"cddl(?:{_V}|)1 0", ()),
    ("cddl-1.0", "development", rf"common development and distribution {_L}(?: cddl)?{_V}1 0", ()),
    ("cddl-1.1", "development", rf"common development and distribution {_L}(?: cddl)?{_V}1 1", ()),
    ("cddl", "development", rf"common development and distribution {_L}", ()),
    ("cecill-2.1", "cecill", rf"cecill(?: free software)?(?: {_L})?{_V}2 1", ()),
    ("cecill-b", "cecill", rf"cecill b(?: {_L})?", ()),
    ("cecill-c", "cecill", rf"cecill c(?: {_L})?", ()),
    ("eupl-1.1", "european", rf"european union public {_L}{_V}1 1", ()),
    ("eupl-1.2", "european", rf"european union public {_L}{_V}1 2", ()),
    ("eupl", "european", rf"european union public {_L}", ()),
    ("artistic-1", "artistic", rf"artistic {_L}{_V}1(?: 0)?", (r"opensource org licenses artistic 1 0",)),
    ("artistic-2", "artistic", rf"artistic {_L}{_V}2(?: 0)?", (r"opensource org licenses artistic 2 0",)),
    ("artistic", "artistic", rf"(?:perl )?artistic {_L}", ()),
    ("zlib", "zlib", rf"zlib(?: libpng)? {_L}", (r"opensource org licenses zlib",)),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", ()),
    ("libpng", "libpng", rf"libpng {_L}", ()),
    ("boost-1", "boost", rf"boost software {_L}(?:{_V}1(?: 0)?)?", (r"boost org license 1 0 txt",)),
    ("unlicense", "unlicense", rf"(?:the )?unlicense(?: {_L})?", (r"unlicense org",)),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", ()),
    ("wtfpl", "wtfpl", r"wtfpl", (r"wtfpl net",)),
    ("wtfpl", "fuck", rf"do what the fuck you want to public {_L}", ()),
    ("psf-2", "python", rf"python software foundation {_L}(?:{_V}2(?: 0)?)?", ()),
    ("psf-2", "psf", rf"psf {_L}(?:{_V}2(?: 0)?)?", ()),
    ("python-2", "python", rf"python {_L}{_V}2(?: 0)?", ()),
    ("php-3", "php", rf"php {_L}{_V}3(?: 0)?(?! 1)", ()),
    ("php-3.01", "php", rf"php {_L}{_V}3 01", (r"php net license 3 01 txt",)),
    ("ruby", "ruby", rf"ruby {_L}|ruby s {_L}", ()),
    ("openssl", "openssl", rf"openssl {_L}", (r"this product includes software developed by the openssl project",)),
    ("sleepycat", "sleepycat", rf"sleepycat {_L}", ()),
    ("postgresql", "postgresql", rf"postgresql {_L}", (r"opensource org licenses postgresql",)),
    ("ofl-1.1", "sil", rf"sil open font {_L}(?:{_V}1 1)?", (r"scripts sil org ofl",)),
    ("ofl-1.1", "ofl", rf"ofl(?:{_V}|)1 1", ()),
    ("ms-pl", "microsoft", rf"microsoft public {_L}", (r"opensource org licenses ms pl",)),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {_L}", (r"opensource org licenses ms rl",)),
    ("upl-1", "universal", rf"universal permissive {_L}(?:{_V}1(?: 0)?)?", ()),
    ("ncsa", "ncsa", rf"(?:university of illinois )?ncsa open source {_L}", ()),
    ("ncsa", "illinois", rf"university of illinois open source {_L}", ()),
    ("afl-3", "academic", rf"academic free {_L}(?:{_V}3(?: 0)?)?", ()),
    ("osl-3", "open", rf"open software {_L}{_V}3(?: 0)?", ()),
    ("ecl-2", "educational", rf"educational community {_L}(?:{_V}2(?: 0)?)?", ()),
    ("mulan-2", "mulan", rf"mulan (?:psl|permissive software {_L})(?:{_V}|)2", ()),
    ("bsl-1.1", "business", rf"business source {_L}(?:{_V}1 1)?", ()),
    ("sspl-1", "server", rf"server side public {_L}(?:{_V}1)?", ()),
    ("elastic-2", "elastic", rf"elastic {_L}{_V}2(?: 0)?", (r"elastic co licensing elastic license",)),
    ("polyform-nc-1", "polyform", rf"polyform noncommercial {_L}(?: 1 0 0)?", ()),
    ("odbl-1", "database", rf"open database {_L}(?:{_V}1(?: 0)?)?", (r"opendatacommons org licenses odbl",)),
    ("odc-by-1", "commons", rf"open data commons attribution {_L}(?:{_V}1(?: 0)?)?", (r"opendatacommons org licenses by",)),
    ("pddl-1", "dedication", rf"(?:open data commons )?public domain dedication and {_L}", (r"opendatacommons org licenses pddl",)),
    ("ogl-uk-3", "government", rf"open government {_L}(?:{_V}3(?: 0)?)?", (r"nationalarchives gov uk doc open government licence",)),
    ("openrail", "rail", rf"(?:creativeml |bigscience )?open rail(?: m)?(?: {_L})?", ()),
    ("public-domain", "public domain", r"(?:dedicated to|released (?:in)?to|placed in(?:to)?|in) the public domain", ()),
    ("proprietary", "rights reserved", r"all rights reserved", ()),
)

# parts of the Creative Commons names: label, words of the short name, words of the long name
_CC = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution sharealike|attribution share alike"),
    ("cc-by-nd", "by nd", "attribution noderivatives|attribution no derivatives|attribution noderivs"),
    ("cc-by-nc", "by nc", "attribution noncommercial|attribution non commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution noncommercial sharealike|attribution non commercial share alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution noncommercial noderivatives|attribution non commercial no derivatives|attribution noncommercial noderivs"),
)

# SPDX tag words and label
TAGS: tuple[tuple[str, str], ...] = (
    ("mit", "mit"), ("mit 0", "mit-0"), ("apache 1 1", "apache-1"), ("apache 2 0", "apache-2"), ("0bsd", "bsd-0"),
    ("bsd 2 clause", "bsd-2"), ("bsd 3 clause", "bsd-3"), ("bsd 4 clause", "bsd-4"), ("isc", "isc"),
    ("gpl 2 0(?: only)?", "gpl-2"), ("gpl 2 0 or later", "gpl-2-or-later"), ("gpl 3 0(?: only)?", "gpl-3"),
    ("gpl 3 0 or later", "gpl-3-or-later"), ("lgpl 2 1(?: only)?", "lgpl-2.1"), ("lgpl 2 1 or later", "lgpl-2.1-or-later"),
    ("lgpl 3 0(?: only)?", "lgpl-3"), ("lgpl 3 0 or later", "lgpl-3-or-later"), ("agpl 3 0(?: only)?", "agpl-3"),
    ("agpl 3 0 or later", "agpl-3-or-later"), ("mpl 1 1", "mpl-1.1"), ("mpl 2 0", "mpl-2"), ("epl 1 0", "epl-1"),
    ("epl 2 0", "epl-2"), ("cddl 1 0", "cddl-1.0"), ("cddl 1 1", "cddl-1.1"), ("eupl 1 2", "eupl-1.2"),
    ("artistic 1 0", "artistic-1"), ("artistic 2 0", "artistic-2"), ("zlib", "zlib"), ("bsl 1 0", "boost-1"),
    ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("python 2 0", "python-2"), ("psf 2 0", "psf-2"), ("ofl 1 1", "ofl-1.1"),
    ("ms pl", "ms-pl"), ("ms rl", "ms-rl"), ("upl 1 0", "upl-1"), ("ncsa", "ncsa"), ("postgresql", "postgresql"),
    ("openssl", "openssl"), ("gfdl 1 3(?: only| or later)?", "gfdl-1.3"), ("cc0 1 0", "cc0"), ("odbl 1 0", "odbl-1"),
    ("busl 1 1", "bsl-1.1"), ("sspl 1 0", "sspl-1"), ("elastic 2 0", "elastic-2"), ("afl 3 0", "afl-3"),
)

_NOTICE = (
    r"(?:licensed|released|distributed|available|published|provided|covered|governed|licence|license|shared|offered)"
    r"(?: to you)? (?:under|by|with)(?: (?:the|a|an|terms|conditions|term|and|of|version)){0,6}"
)


# an SPDX expression up to one of its later licences; an unknown licence has up to four words
_KNOWN = "|".join([*(tag for tag, _ in sorted(TAGS, reverse=True)), *(rf"cc {short} [1-4] [05]" for _, short, _ in _CC)])
_WORD = r"(?!(?:or|and|with|later) )[a-z0-9]+"
_OPERAND = rf"(?:(?:{_KNOWN})|(?!(?:{_KNOWN}) ){_WORD}(?: {_WORD}){{0,3}})(?: with {_WORD}(?: {_WORD}){{0,5}})?"
_EXPRESSION = rf"spdx license identifier (?:{_OPERAND} (?:or|and) ){{1,30}}?"


def _whole(tag: str) -> str:
    """The tag where no longer one begins."""
    short = tag.split("(")[0]
    return tag + "".join(f"(?!{longer.removeprefix(short)} )" for longer, _ in TAGS if longer.startswith(f"{short} "))


def _rule(label: str, words: str, pattern: str, priority: int, confidence: float) -> Rule:
    compiled = re.compile(rf" (?:{pattern})(?= )".encode())
    return Rule(label, frozenset(w.encode() for w in words.split()), compiled, priority, confidence)


def rules() -> list[Rule]:
    """Every signature, the highest priority first."""
    out = []
    for label, words, name, more in LICENCES:
        # notices and names are tried where the words of the name occur
        if label != "proprietary":
            out.append(_rule(label, words, rf"{_NOTICE} (?:{name})", 80, 0.95))
        out.append(_rule(label, words, name, 60 if any(c.isdigit() for c in label) else 50, 0.3 if label == "proprietary" else 0.7))
        out += [_rule(label, " ".join(p.split()[:2]), p, 70, 0.9) for p in more]
    for label, short, long in _CC:
        later = r"(?:{_V}[1-4] [05])?".replace("{_V}", _V)
        last = short.split()[-1]
        out.append(_rule(label, f"cc {last}", rf"cc {short}{later}(?! (?:sa|nd|nc))", 60, 0.7))
        out.append(_rule(label, f"cc {last}", rf"{_NOTICE} cc {short}{later}(?! (?:sa|nd|nc))", 80, 0.95))
        out.append(_rule(label, "creative commons", rf"creative commons (?:{long})(?: (?:[1-4] 0|international|unported|generic|public|{_L}))*(?! (?:noncommercial|non|share|sharealike|no|noderivatives|noderivs))", 60, 0.8))
        out.append(_rule(label, f"creativecommons {last}", rf"creativecommons org licenses {short} [1-4] [05]", 70, 0.9))
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out.append(_rule(label, f"spdx cc {last}", rf"spdx license identifier cc {short} {version}", 100, 1.0))
    out.append(_rule("cc0", "cc0", rf"cc0(?: 1 0)?(?: universal)?(?: {_L})?", 60, 0.8))
    out.append(_rule("cc0", "creative commons", r"creative commons (?:zero|0)(?: 1 0)?(?: universal)?", 60, 0.8))
    out.append(_rule("cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0", 70, 0.9))
    out.append(_rule("public-domain", "creativecommons", r"creativecommons org publicdomain mark 1 0", 70, 0.9))
    out.append(_rule("creative-commons", "creative commons", rf"creative commons(?: {_L})?", 20, 0.4))
    for tag, label in TAGS:
        out.append(_rule(label, "spdx", rf"spdx license identifier {tag}", 100, 1.0))
        out.append(_rule(label, "spdx", rf"spdx license identifier [a-z0-9 ]{{1,60}}? (?:or|and) {_whole(tag)}", 90, 1.0))
        # of a later licence only its own words count, since the ones before it are detections of their own
        out.append(_rule(label, "spdx", rf"{_EXPRESSION}(?P<own>{_whole(tag)})", 95, 1.0))
        out.append(_rule(label, "license", rf"(?:project|package|module|crate|software) license {tag}", 65, 0.85))
    out += [_rule(label, phrase, phrase, 40, 0.9) for phrase, label in BASE]
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern.pattern))
