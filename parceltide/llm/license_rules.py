"""Signature rules of the license scan.

Patterns are written over normalised text: lower-case words joined by one space. A rule is tried
only if all its keywords occur as words, so each has to be a word of every text that the pattern
matches; this is checked on the parsed pattern. Rules of one license differ by the phrase around the name,
so they come from templates; whole-sentence signatures are written out.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterable
from functools import cache
from itertools import product
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int  # smaller wins
    weight: float
    keywords: frozenset[bytes]
    pattern: re.Pattern[bytes]


_V = r"(?: version| v)?"

# label, keywords of the name, name, SPDX identifier as words, web address as words (or "").
LICENSES = [
    ("mit", "mit", r"mit licen[sc]e", "mit", "opensource org licenses mit"),
    ("mit-0", "mit", r"mit no attribution", "mit 0", ""),
    ("mit-modern", "mit modern", r"mit licen[sc]e modern variant", "mit modern variant", ""),
    ("x11", "x11", r"x11 licen[sc]e", "x11", ""),
    ("isc", "isc", r"isc licen[sc]e", "isc", "opensource org licenses isc"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", "opensource org licenses zlib"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", "apache", "apache org licenses"),
    ("apache-1.0", "apache 1", rf"apache(?: software)? licen[sc]e{_V} 1 0", "apache 1 0", "apache org licenses license 1 0"),
    ("apache-1.1", "apache 1", rf"apache(?: software)? licen[sc]e{_V} 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache 2", rf"apache(?: software)? licen[sc]e{_V} 2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", "gpl", "gnu org licenses gpl"),
    ("gpl-1.0", "general public 1", rf"(?:gnu )?general public licen[sc]e{_V} 1(?: 0)?", "gpl 1 0", "gnu org licenses gpl 1 0"),
    ("gpl-2.0", "general public 2", rf"(?:gnu )?general public licen[sc]e{_V} 2(?: 0)?", "gpl 2 0", "gnu org licenses gpl 2 0"),
    ("gpl-3.0", "general public 3", rf"(?:gnu )?general public licen[sc]e{_V} 3(?: 0)?", "gpl 3 0", "gnu org licenses gpl 3 0"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e", "lgpl", "gnu org licenses lgpl"),
    ("lgpl-2.0", "library general", r"(?:gnu )?library general public licen[sc]e", "lgpl 2 0", "gnu org licenses lgpl 2 0"),
    ("lgpl-2.1", "lesser general 2", rf"(?:gnu )?lesser general public licen[sc]e{_V} 2 1", "lgpl 2 1", "gnu org licenses lgpl 2 1"),
    ("lgpl-3.0", "lesser general 3", rf"(?:gnu )?lesser general public licen[sc]e{_V} 3(?: 0)?", "lgpl 3 0", "gnu org licenses lgpl 3 0"),
    ("agpl", "affero general", r"(?:gnu )?affero general public licen[sc]e", "agpl", "gnu org licenses agpl"),
    ("agpl-1.0", "affero general 1", rf"(?:gnu )?affero general public licen[sc]e{_V} 1(?: 0)?", "agpl 1 0", ""),
    ("agpl-3.0", "affero general 3", rf"(?:gnu )?affero general public licen[sc]e{_V} 3(?: 0)?", "agpl 3 0", "gnu org licenses agpl 3 0"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", "gfdl", "gnu org licenses fdl"),
    ("gfdl-1.2", "free documentation 1", rf"(?:gnu )?free documentation licen[sc]e{_V} 1 2", "gfdl 1 2", ""),
    ("gfdl-1.3", "free documentation 1", rf"(?:gnu )?free documentation licen[sc]e{_V} 1 3", "gfdl 1 3", "gnu org licenses fdl 1 3"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", "bsd", ""),
    ("0bsd", "bsd", r"(?:zero clause|0 clause) bsd(?: licen[sc]e)?", "0bsd", "opensource org licenses 0bsd"),
    ("bsd-2-clause", "bsd", r"(?:2 clause|two clause|simplified|freebsd) bsd(?: licen[sc]e)?", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:3 clause|three clause|new|revised|modified) bsd(?: licen[sc]e)?", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:4 clause|four clause|original) bsd(?: licen[sc]e)?", "bsd 4 clause", ""),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "mpl", "mozilla org mpl"),
    ("mpl-1.0", "mozilla 1", rf"mozilla public licen[sc]e{_V} 1 0", "mpl 1 0", "mozilla org mpl 1 0"),
    ("mpl-1.1", "mozilla 1", rf"mozilla public licen[sc]e{_V} 1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla 2", rf"mozilla public licen[sc]e{_V} 2 0", "mpl 2 0", "mozilla org mpl 2 0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "epl", "eclipse org legal epl"),
    ("epl-1.0", "eclipse 1", rf"eclipse public licen[sc]e{_V} 1 0", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse 2", rf"eclipse public licen[sc]e{_V} 2 0", "epl 2 0", "eclipse org legal epl 2 0"),
    ("edl-1.0", "eclipse distribution", r"eclipse distribution licen[sc]e", "edl 1 0", "eclipse org org documents edl v10"),
    ("cddl", "common distribution", r"common development and distribution licen[sc]e", "cddl", ""),
    ("cddl-1.0", "common distribution 1", rf"common development and distribution licen[sc]e{_V} 1 0", "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cddl-1.1", "common distribution 1", rf"common development and distribution licen[sc]e{_V} 1 1", "cddl 1 1", ""),
    ("cpl-1.0", "common public", r"common public licen[sc]e", "cpl 1 0", "opensource org licenses cpl"),
    ("cpal-1.0", "common attribution", r"common public attribution licen[sc]e", "cpal 1 0", ""),
    ("epl-european", "european union", r"european union public licen[sc]e", "eupl", "joinup ec europa eu software page eupl"),
    ("eupl-1.1", "european union 1", rf"european union public licen[sc]e{_V} 1 1", "eupl 1 1", ""),
    ("eupl-1.2", "european union 1", rf"european union public licen[sc]e{_V} 1 2", "eupl 1 2", ""),
    ("artistic", "artistic", r"artistic licen[sc]e", "artistic", ""),
    ("artistic-1.0", "artistic 1", rf"artistic licen[sc]e{_V} 1 0", "artistic 1 0", ""),
    ("artistic-2.0", "artistic 2", rf"artistic licen[sc]e{_V} 2 0", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e", "bsl 1 0", "boost org license 1 0"),
    ("busl-1.1", "business source", r"business source licen[sc]e", "busl 1 1", "mariadb com bsl11"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e", "sspl 1 0", ""),
    ("elastic-2.0", "elastic", rf"elastic licen[sc]e(?:{_V} 2 0)?", "elastic 2 0", ""),
    ("unlicense", "unlicense", r"the unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "fuck public", r"do what the fuck you want to public licen[sc]e", "wtfpl", "wtfpl net"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "cc by", r"cc by", "cc by", "creativecommons org licenses by"),
    ("cc-by-3.0", "cc by 3", r"cc by 3 0", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-4.0", "cc by 4", r"cc by 4 0", "cc by 4 0", "creativecommons org licenses by 4 0"),
    ("cc-by-sa", "cc by sa", r"cc by sa", "cc by sa", "creativecommons org licenses by sa"),
    ("cc-by-sa-3.0", "cc by sa 3", r"cc by sa 3 0", "cc by sa 3 0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4", r"cc by sa 4 0", "cc by sa 4 0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc", "cc by nc", r"cc by nc", "cc by nc", "creativecommons org licenses by nc"),
    ("cc-by-nc-3.0", "cc by nc 3", r"cc by nc 3 0", "cc by nc 3 0", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nc-4.0", "cc by nc 4", r"cc by nc 4 0", "cc by nc 4 0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd", r"cc by nd(?: 4 0)?", "cc by nd 4 0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", r"cc by nc sa(?: 4 0)?", "cc by nc sa 4 0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", r"cc by nc nd(?: 4 0)?", "cc by nc nd 4 0", "creativecommons org licenses by nc nd 4 0"),
    ("cc-attribution", "creative commons attribution", r"creative commons attribution(?: licen[sc]e)?", "", ""),
    ("cc-attribution-sa", "creative commons attribution", r"creative commons attribution share ?alike(?: licen[sc]e)?", "", ""),
    ("cc-attribution-nc", "creative commons attribution", r"creative commons attribution non ?commercial(?: licen[sc]e)?", "", ""),
    ("cc-attribution-nd", "creative commons attribution", r"creative commons attribution no ?derivatives(?: licen[sc]e)?", "", ""),
    ("odbl-1.0", "open database", r"(?:odc )?open database licen[sc]e", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "commons attribution", r"open data commons attribution licen[sc]e", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "domain dedication", r"public domain dedication and licen[sc]e", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("ofl-1.1", "sil", r"sil open font licen[sc]e", "ofl 1 1", "scripts sil org ofl"),
    ("psf-2.0", "python", r"python software foundation licen[sc]e", "psf 2 0", ""),
    ("psf-2.0", "psf", r"psf licen[sc]e", "", ""),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql", ""),
    ("php-3.01", "php", r"php licen[sc]e", "php 3 01", "php net license"),
    ("ruby", "ruby", r"ruby licen[sc]e", "ruby", ""),
    ("openssl", "openssl", r"openssl licen[sc]e", "openssl", ""),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "ms pl", ""),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "ms rl", ""),
    ("osl-3.0", "open software", r"open software licen[sc]e", "osl 3 0", ""),
    ("afl-3.0", "academic", r"academic free licen[sc]e", "afl 3 0", ""),
    ("ecl-2.0", "educational", r"educational community licen[sc]e", "ecl 2 0", ""),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[sc]e", "ncsa", ""),
    ("vim", "vim", r"vim licen[sc]e", "vim", ""),
    ("json", "json", r"json licen[sc]e", "json", "json org license"),
    ("openrail", "openrail", r"(?:creativeml |bigscience )?openrail(?: m)? licen[sc]e", "openrail", ""),
    ("openrail-m", "open rail", r"(?:creativeml |bigscience )?open rail(?: m)? licen[sc]e", "", ""),
    ("lppl-1.3c", "latex", r"latex project public licen[sc]e", "lppl 1 3c", "latex project org lppl"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[sc]e", "upl 1 0", ""),
    ("blueoak-1.0.0", "blue oak", r"blue oak model licen[sc]e", "blueoak 1 0 0", "blueoakcouncil org license"),
    ("mulan-psl-2.0", "mulan", r"mulan (?:psl|permissive software licen[sc]e)(?: v2)?", "mulanpsl 2 0", ""),
]

_GRANT = (r"(?:licen[sc]ed|released|distributed|published|available|provided|covered|offered|shared)"
          r" (?:under|by|subject to)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? ")

# label, keywords, sentence of a license text.
TEXTS = [
    ("mit", "hereby obtaining", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "noninfringement", r"warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-0", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("isc", "fee granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("x11", "advertising promote", r"shall not be used in advertising or otherwise to promote the sale"),
    ("zlib", "origin misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered plainly", r"altered source versions must be plainly marked as such"),
    ("bsd", "redistribution binary", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", "redistributions reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse promote", r"may be used to endorse or promote products derived from"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "unless applicable", r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("gpl", "redistribute modify", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "merchantability implied", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "received copy", r"you should have received a copy of the gnu general public license"),
    ("lgpl", "received lesser", r"you should have received a copy of the gnu lesser general public license"),
    ("lgpl", "redistribute lesser", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "received affero", r"you should have received a copy of the gnu affero general public license"),
    ("agpl", "redistribute affero", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-or-later", "later option", r"(?:either version \d+ of the license )?or at your option any later version"),
    ("gfdl", "invariant sections", r"with no invariant sections"),
    ("mpl-2.0", "obtain mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "source mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ("epl", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse"),
    ("cddl", "contents subject", r"the contents of this file are subject to the terms of the common development"),
    ("bsl-1.0", "boost distributed", r"distributed under the boost software license version 1 0"),
    ("bsl-1.0", "organization obtaining", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|dedicate|is) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"public domain"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("cc0-1.0", "waived copyright", r"(?:has|have) waived all copyright and related or neighboring rights"),
    ("ofl-1.1", "font reserved", r"with reserved font name"),
    ("postgresql", "written agreement", r"without a written agreement is hereby granted"),
    ("openssl", "openssl developed", r"this product includes software developed by the openssl project"),
    ("python", "python licensee", r"python software foundation is making python available to licensee"),
    ("json", "good evil", r"the software shall be used for good not evil"),
    ("copyright", "rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary confidential", r"proprietary and confidential"),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this (?:file|software|document)"),
    ("proprietary", "without written", r"without (?:the )?(?:express |prior )*written (?:permission|consent) of"),
    ("no-commercial", "non commercial", r"for non commercial (?:use|purposes) only"),
    ("no-commercial", "noncommercial", r"for noncommercial (?:use|purposes) only"),
    ("no-commercial", "commercial use", r"not for commercial use"),
    ("no-derivatives", "derivative works", r"no derivative works"),
    ("share-alike", "share alike", r"share alike"),
    ("warranty-disclaimer", "warranty kind", r"without warranty of any kind"),
    ("warranty-disclaimer", "warranties express", r"any express or implied warranties"),
    ("liability-disclaimer", "event liable", r"in no event shall .{1,80} be liable for any"),
    ("dual", "dual licensed", r"dual licensed under"),
    ("see-license", "license file", r"see the (?:accompanying )?license file"),
    ("see-license", "license txt", r"see (?:the )?license txt"),
]


_UNKNOWN = "\0"  # text that the pattern does not spell out


def forms(parsed: Iterable[tuple]) -> set[str]:
    """The texts a parsed pattern matches, with ``_UNKNOWN`` for what is open; a part that may repeat
    stands as often as it must and once more."""
    found = {""}
    for kind, value in parsed:
        if kind is sre.LITERAL:
            part = {chr(value)}
        elif kind is sre.SUBPATTERN:
            part = forms(value[-1])
        elif kind is sre.BRANCH:
            part = set().union(*map(forms, value[1]))
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            part = {chr(c) for _, c in value}
        elif kind is sre.MAX_REPEAT:
            low, high, body = value
            part = {"".join(p) for n in {low, min(low + 1, high)} for p in product(forms(body), repeat=n)}
        else:
            part = {_UNKNOWN}
        found = {a + b for a in found for b in part}
    return found


@cache
def required_words(pattern: str) -> frozenset[str]:
    """The words that every text has that ``pattern`` matches."""
    return frozenset.intersection(*(
        frozenset(w for w in text.split(" ") if w and _UNKNOWN not in w)
        for text in forms(sre_parser.parse(pattern))))


def _rule(label: str, priority: int, weight: float, keywords: str, pattern: str) -> Rule:
    gate = frozenset(w.encode() for w in keywords.split())
    return Rule(label, priority, weight, gate,
                re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode()))


def build_rules() -> list[Rule]:
    """Rules in order: whole sentences, identifiers, grants, addresses, bare names."""
    for words, pattern in [r[1:3] for r in (*TEXTS, *LICENSES)]:
        _require(words, pattern)
    rules = [_rule(label, 0, 1.0 if "-disclaimer" not in label else 0.4, words, text)
             for label, words, text in TEXTS]
    for label, words, name, spdx, web in LICENSES:
        if spdx:
            rules.append(_rule(label, 1, 1.0, f"spdx {spdx}",
                               rf"spdx licen[sc]e identifier {spdx}(?: only| or later)?"))
            rules.append(_rule(label, 1, 0.9, f"licence {spdx}", rf"licence {spdx}"))
            rules.append(_rule(label, 1, 0.9, f"license {spdx}", rf"license {spdx}"))
        rules.append(_rule(label, 2, 1.0, words, _GRANT + name))
        if web:
            rules.append(_rule(label, 3, 0.9, web, web))
        rules.append(_rule(label, 4, 0.8, words, name))
    return rules


def _require(words: str, pattern: str) -> None:
    """A pattern is gated only by words that each of its matches has. A grant ends in a space, so
    what holds for a name holds after a grant."""
    missing = set(words.split()) - required_words(pattern)
    if missing or not words:
        raise ValueError(f"keywords {sorted(missing)} are not in every match of {pattern!r}")
