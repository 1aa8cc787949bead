"""License scans: ordered signature rules behind a keyword prefilter.

Written signatures - grants, disclaimers, addresses, names and their short forms - and names in
the contexts that refer to a license are regular expressions in order of priority.  One pass of
an Aho-Corasick automaton finds which keywords a text holds; only rules of those keywords
run, over the text with its white space and comment marks at line starts made single blanks.
Of two detections of which one contains the other, that of the earlier rule stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))

#: label, keywords (in lower case, parted by blanks) of which any mention holds one, the name as a pattern.
LICENSES = (
    ("agpl-3.0", "affero", r"gnu affero general public licen[cs]e,? (?:version|v\.?)? ?3(?:\.0)?"),
    ("agpl-3.0", "agpl", r"agpl[- ]?v?3(?:\.0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public licen[cs]e,? (?:version|v\.?)? ?2\.1"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public licen[cs]e,? (?:version|v\.?)? ?3(?:\.0)?"),
    ("lgpl-2.1", "lgpl", r"lgpl[- ]?v?2\.1"),
    ("lgpl-3.0", "lgpl", r"lgpl[- ]?v?3(?:\.0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl-2.0", "library", r"gnu library general public licen[cs]e"),
    ("gpl-2.0", "gnu", r"gnu general public licen[cs]e,? (?:version|v\.?)? ?2(?:\.0)?"),
    ("gpl-3.0", "gnu", r"gnu general public licen[cs]e,? (?:version|v\.?)? ?3(?:\.0)?"),
    ("gpl-2.0", "gpl", r"gpl[- ]?v?2(?:\.0)?"),
    ("gpl-3.0", "gpl", r"gpl[- ]?v?3(?:\.0)?"),
    ("gpl", "gnu", r"gnu general public licen[cs]e"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[cs]e,? ?\(?(?:version|v\.?)? ?2(?:\.0)?\)?"),
    ("apache-2.0", "apache", r"apache[- ]2(?:\.0)?(?: licen[cs]e)?"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e,? (?:version|v\.?)? ?1\.1"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("mit", "mit", r"(?:the )?mit licen[cs]e"),
    ("mit", "expat", r"(?:the )?expat licen[cs]e|mit[-/ ]expat"),
    ("bsd-2-clause", "bsd", r"(?:2[- ]clause|simplified|freebsd)[- ]bsd(?: licen[cs]e)?|bsd[- ]2[- ]clause"),
    ("bsd-3-clause", "bsd", r"(?:3[- ]clause|new|modified|revised)[- ]bsd(?: licen[cs]e)?|bsd[- ]3[- ]clause"),
    ("bsd-4-clause", "bsd", r"(?:4[- ]clause|original)[- ]bsd(?: licen[cs]e)?|bsd[- ]4[- ]clause"),
    ("bsd", "bsd berkeley", r"bsd licen[cs]e|berkeley software distribution"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e,? (?:version|v\.?)? ?2(?:\.0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e,? (?:version|v\.?)? ?1\.1"),
    ("mpl-2.0", "mpl", r"mpl[- ]?v?2(?:\.0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e,? (?:version|v\.?|-)? ?2(?:\.0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e,? (?:version|v\.?|-)? ?1(?:\.0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("cddl", "development", r"common development and distribution licen[cs]e"),
    ("isc", "isc", r"(?:the )?isc licen[cs]e"),
    ("zlib", "zlib", r"(?:the )?zlib(?:/libpng)? licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?:,? (?:version|v\.?)? ?1(?:\.0)?)?"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?:,? (?:version|v\.?)? ?2(?:\.0)?)?"),
    ("python-2.0", "python psf", r"python software foundation licen[cs]e|psf licen[cs]e"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e(?:,? (?:version|v\.?)? ?1\.1)?"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?:,? (?:version|v\.?)? ?1\.2)?"),
    ("odbl-1.0", "database", r"open database licen[cs]e"),
    ("openrail-m", "rail", r"(?:creativeml )?open ?rail(?:\+\+)?-m"),
    ("proprietary", "proprietary", r"proprietary (?:and confidential )?licen[cs]e"),
)
#: label, weight, keywords parted by | (a match holds one) and pattern: sentences of license texts, addresses and short forms.
SIGNATURES = (
    ("mit", 0.95, "permission is hereby granted, free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 0.8, "permission is hereby granted, free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", 0.7, "without restriction", r"deal in the software without restriction, including without limitation the rights to use, copy, modify"),
    ("mit", 0.7, "substantial portions", r"(?:the )?above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("mit", 0.6, "as is", r"the software is provided ['\"“]?as is['\"”]?, without warranty of any kind, express or implied"),
    ("mit-0", 0.95, "mit no attribution|mit-0", r"mit no attribution|mit-0"),
    ("isc", 0.95, "for any purpose with or without fee", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", 0.95, "0bsd|zero-clause", r"0bsd|(?:bsd )?zero-clause bsd(?: licen[cs]e)?|bsd zero-clause licen[cs]e"),
    ("bsd", 0.9, "redistribution and use", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", 0.7, "redistributions", r"redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright notice"),
    ("bsd-3-clause", 0.9, "endorse or promote", r"(?:neither the names? of|the names? of).{0,120}? may(?: not)? be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 0.9, "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-3-clause-clear", 0.9, "no express or implied licenses", r"no express or implied licenses to any party'?s patent rights are granted"),
    ("apache-2.0", 0.97, "apache.org/licenses", r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", 0.9, "apache.org/licenses", r"apache\.org/licenses/license-1\.1"),
    ("apache", 0.8, "apache.org/licenses", r"apache\.org/licenses"),
    ("apache-2.0", 0.95, "this file except in compliance", r"licensed under the apache license, version 2\.0 \(the ['\"“]?license['\"”]?\); you may not use this file except in compliance"),
    ("apache-2.0", 0.6, "this file except in compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", 0.6, "as is", r"distributed under the license is distributed on an ['\"“]?as is['\"”]? basis, without warranties or conditions of any kind"),
    ("apache-2.0", 0.7, "apache|asl", r"apache[- ]?v?2(?:\.0)?|asl[- ]?2(?:\.0)?"),
    ("gpl", 0.95, "free software", r"this program is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu general public license"),
    ("gpl-2.0-or-later", 0.97, "either version", r"gnu general public license as published by the free software foundation[;,] either version 2 of the license, or \(at your option\) any later version"),
    ("gpl-3.0-or-later", 0.97, "either version", r"gnu general public license as published by the free software foundation[;,] either version 3 of the license, or \(at your option\) any later version"),
    ("lgpl-2.1-or-later", 0.97, "either version", r"gnu lesser general public license as published by the free software foundation[;,] either version 2\.1 of the license, or \(at your option\) any later version"),
    ("lgpl-3.0-or-later", 0.97, "either version", r"gnu lesser general public license as published by the free software foundation[;,] either version 3 of the license, or \(at your option\) any later version"),
    ("agpl-3.0-or-later", 0.97, "either version", r"gnu affero general public license as published by the free software foundation[;,] either version 3 of the license, or \(at your option\) any later version"),
    ("gpl", 0.7, "without any warranty", r"in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability"),
    ("gpl", 0.7, "received a copy of the gnu", r"you should have received a copy of the gnu general public license"),
    ("lgpl", 0.7, "received a copy of the gnu", r"you should have received a copy of the gnu lesser general public license"),
    ("agpl", 0.7, "received a copy of the gnu", r"you should have received a copy of the gnu affero general public license"),
    ("gpl-3.0", 0.95, "gnu.org/licenses", r"gnu\.org/licenses/(?:gpl-3\.0|gplv3)"),
    ("gpl-2.0", 0.95, "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("lgpl-3.0", 0.95, "gnu.org/licenses", r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl-2.1", 0.95, "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("agpl-3.0", 0.95, "gnu.org/licenses", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl-1.3", 0.95, "gnu.org/licenses", r"gnu\.org/licenses/fdl-1\.3"),
    ("agpl", 0.9, "gnu.org/licenses", r"gnu\.org/licenses/agpl"),
    ("lgpl", 0.9, "gnu.org/licenses", r"gnu\.org/licenses/lgpl"),
    ("gfdl", 0.9, "gnu.org/licenses", r"gnu\.org/licenses/fdl"),
    ("gpl", 0.7, "gnu.org/licenses", r"gnu\.org/licenses"),
    ("gpl", 0.9, "gpl", r"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:gnu )?gpl"),
    ("lgpl", 0.9, "lgpl", r"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:gnu )?lgpl"),
    ("agpl", 0.9, "agpl", r"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:gnu )?agpl"),
    ("gpl", 0.9, "gpl", r"(?:gnu )?gpl licen[cs]e|(?:licen[cs]ed|released|distributed|available|published) under the (?:gnu )?gpl"),
    ("lgpl", 0.9, "lgpl", r"(?:gnu )?lgpl licen[cs]e|(?:licen[cs]ed|released|distributed|available|published) under the (?:gnu )?lgpl"),
    ("gfdl", 0.9, "documentation license", r"gnu free documentation license|(?:gnu )?free documentation license"),
    ("gfdl", 0.8, "gfdl", r"gfdl(?:-?v?1\.[123])?"),
    ("mit", 0.9, "under mit|under the mit", r"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?mit"),
    ("mit", 0.95, "opensource.org/license", r"opensource\.org/licenses?/mit(?:-license)?"),
    ("mit", 0.8, "mit-licensed|mit licensed", r"mit[- ]licensed"),
    ("bsd", 0.8, "bsd", r"bsd[- ](?:licensed|style licen[cs]e)"),
    ("bsd", 0.9, "opensource.org/license", r"opensource\.org/licenses?/bsd-license"),
    ("mpl-2.0", 0.97, "mozilla.org/mpl", r"mozilla\.org/mpl/2\.0"),
    ("mpl-2.0", 0.97, "source code form is subject", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-1.1", 0.95, "mozilla.org/mpl", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("mpl", 0.8, "mozilla.org/mpl", r"mozilla\.org/mpl"),
    ("epl-2.0", 0.95, "eclipse.org/legal", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("epl-1.0", 0.95, "eclipse.org/legal", r"eclipse\.org/legal/epl-(?:1\.0|v10)"),
    ("epl", 0.8, "epl-", r"epl-[12]\.0"),
    ("unlicense", 0.95, "released into the public domain", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 0.9, "unlicense.org", r"unlicense\.org"),
    ("cc0-1.0", 0.97, "creativecommons.org/publicdomain", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", 0.9, "creativecommons.org/publicdomain", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("public-domain", 0.6, "public domain", r"(?:released|placed|dedicated|put|is) (?:in|into|to) the public domain"),
    ("creative-commons", 0.6, "creative commons", r"creative commons licen[cs]e"),
    ("creative-commons", 0.5, "creativecommons.org", r"creativecommons\.org"),
    ("zlib", 0.9, "altered source versions", r"altered source versions must be plainly marked as such, and must not be misrepresented"),
    ("zlib", 0.7, "misrepresented", r"the origin of this software must not be misrepresented"),
    ("bsl-1.0", 0.95, "boost.org", r"boost\.org/license_1_0"),
    ("wtfpl", 0.95, "do what the fuck", r"do what the fuck you want to(?: public licen[cs]e)?"),
    ("artistic", 0.8, "artistic", r"(?:perl )?artistic licen[cs]e"),
    ("artistic-1.0-perl", 0.8, "same terms as perl", r"under the same terms as perl itself"),
    ("python-2.0", 0.9, "psf-2.0|psf license", r"psf-2\.0|psf license agreement"),
    ("php-3.01", 0.95, "php license", r"php license,? (?:version|v\.?) ?3\.01"),
    ("php", 0.8, "php license", r"php license"),
    ("ruby", 0.8, "ruby licen", r"ruby licen[cs]e"),
    ("json", 0.9, "for good, not evil", r"the software shall be used for good, not evil"),
    ("beerware", 0.95, "beer", r"beer-?ware licen[cs]e|buy me a beer in return"),
    ("ofl-1.1", 0.95, "scripts.sil.org", r"scripts\.sil\.org/ofl"),
    ("ofl-1.1", 0.8, "sil ofl", r"sil ofl(?:,? (?:version|v\.?)? ?1\.1)?"),
    ("odbl-1.0", 0.95, "opendatacommons.org", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", 0.95, "opendatacommons.org", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", 0.95, "opendatacommons.org", r"opendatacommons\.org/licenses/pddl"),
    ("odc-by-1.0", 0.9, "open data commons", r"open data commons attribution licen[cs]e"),
    ("pddl-1.0", 0.9, "public domain dedication", r"public domain dedication (?:and|&) licen[cs]e"),
    ("cc0", 0.8, "public domain dedication", r"cc0(?: 1\.0)?(?: universal)? (?:\(cc0 1\.0\) )?public domain dedication"),
    ("eupl-1.2", 0.95, "eupl", r"eupl[- ]?v?\.?(?: ?1\.2)?|eupl-1\.2"),
    ("cddl-1.0", 0.9, "cddl", r"cddl[- ]?v?1\.0"),
    ("cddl", 0.8, "cddl", r"cddl"),
    ("cecill-2.1", 0.95, "cecill", r"cecill(?:-| version | v)2\.1"),
    ("cecill", 0.9, "cecill", r"cecill(?:-[bc])?(?: licen[cs]e)?"),
    ("osl-3.0", 0.95, "open software licen", r"open software licen[cs]e,? (?:version|v\.?)? ?3\.0"),
    ("afl-3.0", 0.95, "academic free", r"academic free licen[cs]e,? (?:version|v\.?)? ?3\.0"),
    ("ms-pl", 0.9, "microsoft public", r"microsoft public licen[cs]e(?: \(ms-pl\))?"),
    ("ms-rl", 0.9, "microsoft reciprocal", r"microsoft reciprocal licen[cs]e(?: \(ms-rl\))?"),
    ("ncsa", 0.9, "illinois", r"university of illinois(?:/| )ncsa open source licen[cs]e"),
    ("postgresql", 0.9, "postgresql licen", r"postgresql licen[cs]e"),
    ("openssl", 0.9, "openssl licen", r"openssl licen[cs]e"),
    ("qpl-1.0", 0.9, "q public", r"q public licen[cs]e"),
    ("upl-1.0", 0.9, "universal permissive", r"universal permissive licen[cs]e(?:,? (?:version|v\.?)? ?1\.0)?"),
    ("vim", 0.8, "vim licen", r"vim licen[cs]e"),
    ("w3c", 0.9, "w3c", r"w3c software (?:notice|licen[cs]e|and document)"),
    ("blueoak-1.0.0", 0.9, "blue oak", r"blue oak model licen[cs]e"),
    ("mulanpsl-2.0", 0.9, "mulan", r"mulan psl v2|mulan permissive software licen[cs]e"),
    ("sspl-1.0", 0.95, "server side public", r"server side public licen[cs]e"),
    ("busl-1.1", 0.95, "business source", r"business source licen[cs]e(?:,? (?:version|v\.?)? ?1\.1)?"),
    ("elastic-2.0", 0.95, "elastic licen", r"elastic licen[cs]e(?: (?:version |v)?2\.0)?"),
    ("commons-clause", 0.9, "commons clause", r"commons clause(?: licen[cs]e condition)?"),
    ("polyform", 0.9, "polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter|free trial)(?: licen[cs]e)?"),
    ("llama-community", 0.9, "llama", r"llama ?[23](?:\.[0-9])? community licen[cs]e"),
    ("openrail", 0.8, "rail", r"(?:big(?:science|code) )?(?:open ?)?rail licen[cs]e|bigscience-openrail-m"),
    ("ogl-uk-3.0", 0.95, "open government", r"open government licen[cs]e(?:,? (?:version|v\.?)? ?3(?:\.0)?)?"),
    ("proprietary", 0.9, "proprietary and confidential|confidential and proprietary", r"proprietary and confidential|confidential and proprietary"),
    ("proprietary", 0.7, "all rights reserved", r"all rights reserved"),
    ("proprietary", 0.8, "unauthori", r"unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: (?:and|or) (?:copying|reproduction|distribution))? of (?:this|these) (?:file|software|work|material|document)s?"),
    ("proprietary", 0.8, "end user|end-user", r"end[- ]user licen[cs]e agreement"),
    ("non-commercial", 0.7, "non-commercial|noncommercial", r"(?:for |only for )?non-?commercial (?:use|purposes) only"),
    ("research-only", 0.7, "research", r"(?:for |only for )?research (?:use|purposes) only"),
)
#: Identifiers of the public SPDX list, in lower case, as manifests and headers name licenses.
SPDX_IDS = frozenset(
    "0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0-perl artistic-2.0 blueoak-1.0.0 bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c ecl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0+ gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0+ gpl-3.0-only gpl-3.0-or-later ijg isc json lgpl-2.0 lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 odc-by-1.0 ofl-1.1 openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sspl-1.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl zlib zpl-2.1".split()
)
#: Where an identifier stands: weight and pattern with the identifiers, parted by or, and, with.
_ID = r"[\[({'\"`\s]*+[a-z0-9][a-z0-9.+-]*[a-z0-9+]"
_PLACES = (
    (0.99, re.compile(rf"spdx-license-identifier:((?:{_ID})(?:[)\s]++(?:or|and|with)[\s(]++(?:{_ID}))*)")),
    (0.95, re.compile(r"(?:spdx|opensource|choosealicense)\.org/licenses?/([a-z0-9][a-z0-9.+-]*[a-z0-9+])")),
    (0.9, re.compile(rf"(?<![a-z0-9])licen[cs]es?['\"`]?\s*[:=]((?:{_ID})(?:[)\s]++(?:or|and|with)[\s(]++(?:{_ID}))*)")),
    (0.97, re.compile(rf"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?((?:{_ID})(?:[)\s]++(?:or|and|with)[\s(]++(?:{_ID}))*)")),
)
_ID_WORDS = re.compile(r"spdx-license-identifier|\.org/licenses?/|licen[cs]es?['\"`]?\s*[:=]|(?:licen[cs]ed|released|distributed|available|published) under")
_NAMED = re.compile(r" licen[cs]e(?![a-z0-9])")
_URL = re.compile(r"creativecommons\.org/licenses/(by(?:-nc)?(?:-sa|-nd)?)(?:/([1-4]\.[05]))?")
#: The parts of a Creative Commons name, and its versions.
_CC_PARTS = ("by-nc-sa", "by-nc-nd", "by-nc", "by-sa", "by-nd", "by", "zero")
_CC_WORDS = {"by": "attribution", "nc": "non-?commercial", "sa": "share-?alike", "nd": "no-?deriv(?:atives|s)", "zero": "zero"}
_CC_VERSIONS = ("4.0", "3.0", "2.5", "2.0", "1.0", "")
#: How a text refers to a name: weight of the evidence and the words around it, strongest first.
FORMS = (
    (0.97, r"(?:re)?licensed\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{name}"),
    (0.97, r"(?:released|distributed|available|published|provided|covered)\s+(?:under|by)\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{name}"),
    (0.95, r"under\s+the\s+(?:terms|conditions)\s+of\s+(?:the\s+)?{name}"),
    (0.9, r"licen[cs]e\s*[:=]\s*['\"]?{name}"),
    (0.7, r"{name}"),
)


@dataclass(frozen=True)
class Rule:
    """A signature: its place in the order, label, evidence, keywords (a match holds one), and pattern over lower-case text."""

    order: int
    label: str
    weight: float
    keywords: tuple[str, ...]
    pattern: re.Pattern


def _creative_commons() -> Iterator[tuple[str, str, str]]:
    for parts in _CC_PARTS:
        words = r"[- ]+".join(_CC_WORDS[p] for p in parts.split("-"))
        for v in _CC_VERSIONS:
            label = "cc0" if parts == "zero" else f"cc-{parts}"
            number = rf"(?:\s+|-){re.escape(v)}" if v else ""
            short = r"cc0|cc[- ]zero" if parts == "zero" else r"cc[- ]" + r"[- ]".join(parts.split("-"))
            label = f"{label}-{v}" if v else label
            yield label, ("cc-by", "cc by", "cc0", "cc-zero", "cc zero"), rf"(?:{short}){number}"
            yield label, ("creative commons",), rf"creative\s+commons\s+{words}(?:\s+licen[cs]e)?{number}"


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority: by weight, then as written (exact versions first)."""
    names = [*((label, tuple(keywords.split()), name) for label, keywords, name in LICENSES), *_creative_commons()]
    found = [(weight, label, keywords, form.format(name="(?:" + name.replace("[- ]", r"[-\s]").replace(" ?", r"\s*").replace(" ", r"\s+") + ")")) for weight, form in FORMS for label, keywords, name in names]
    found += [(weight, label, tuple(keywords.split("|")), f"(?:{pattern})") for label, weight, keywords, pattern in SIGNATURES]
    found.sort(key=lambda x: -x[0])
    return tuple(Rule(k, label, weight, keywords, re.compile(rf"(?<![a-z0-9]){body}(?![a-z0-9])")) for k, (weight, label, keywords, body) in enumerate(found))


@cache
def _automaton():
    auto = ahocorasick.Automaton()
    by_keyword: dict[str, list[Rule]] = {}
    for r in rules():
        for k in r.keywords:
            by_keyword.setdefault(k, []).append(r)
    for k, group in by_keyword.items():
        auto.add_word(k, (k, group))
    auto.make_automaton()
    return auto


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    rule: Rule


_BREAK = re.compile(r"[\r\n]\s*(?:(?:[#;%*]+|//+|--+)(?=\s)\s*)?")


def plain(low: str) -> str:
    """Lower-case text with single blanks for its white space, and without marks that begin comment lines."""
    return " ".join(_BREAK.sub(" ", low).split())


def named(low: str) -> Iterator[Detection]:
    """Licenses given by an identifier or an address, where one is said to stand."""
    if "creativecommons.org/licenses/" in low:
        for m in _URL.finditer(low):
            yield Detection(*m.span(), Rule(-1, f"cc-{m[1]}-{m[2]}" if m[2] else f"cc-{m[1]}", 0.97, (), _URL))
    if _ID_WORDS.search(low):
        for weight, place in _PLACES:
            for m in place.finditer(low):
                for part in re.finditer(r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]", m[1]):
                    if part[0] in SPDX_IDS:
                        end = m.start(1) + part.end()
                        after = _NAMED.match(low, end)
                        yield Detection(m.start(), after.end() if after else end, Rule(-1, part[0], weight, (), place))


def detect(low: str) -> list[Detection]:
    """claim() of all rules in plain() text; only those run of which the text holds a keyword."""
    low = plain(low)
    found = {k: group for _, (k, group) in _automaton().iter(low)}
    return claim(low, {r.order: r for g in found.values() for r in g}.values())


def claim(low: str, some: Iterable[Rule]) -> list[Detection]:
    """Detections of some rules in lower-case text, in order of place, after suppression.

    Rules claim text in order of priority: a detection is dropped if its interval lies in that of an earlier
    one, or has it in its own.  No two intervals that stay contain one another, so
    both ends ascend together and containment is one look at the neighbours.  Identifiers come first, and
    one interval may name several licenses.
    """
    from bisect import bisect_left, bisect_right

    given: list[Detection] = []
    spread: dict[str, tuple[list[int], list[int]]] = {}  # of each label: starts and ends, both ascending, of what no other holds
    for d in sorted(named(low), key=lambda d: -d.rule.weight):
        begun, ended = spread.setdefault(d.rule.label, ([], []))
        k = bisect_right(begun, d.start) - 1
        if k >= 0 and ended[k] >= d.end:
            continue
        given.append(d)
        a, b = bisect_left(begun, d.start), bisect_right(ended, d.end)
        begun[a : max(a, b)], ended[a : max(a, b)] = [d.start], [d.end]
    kept: list[Detection] = []
    starts: list[int] = []
    spans = [(d.start, d.end, d.rule) for d in given]
    spans += [(*m.span(), rule) for rule in sorted(some, key=lambda r: r.order) for m in rule.pattern.finditer(low)]
    for a, b, rule in spans:
        k = bisect_right(starts, a) - 1
        if rule.order >= 0 and ((k >= 0 and kept[k].end >= b) or ((n := bisect_left(starts, a)) < len(kept) and kept[n].end <= b)):
            continue
        at = bisect_right(starts, a)
        if rule.order < 0 and ((k >= 0 and kept[k].end >= b) or (at < len(kept) and kept[at].end <= b) or (k >= 0 and kept[k].start == a)):
            continue
        kept.insert(at, Detection(a, b, rule))
        starts.insert(at, a)
    chosen = {(d.start, d.end, d.rule.label) for d in kept}
    return sorted([*kept, *(d for d in given if (d.start, d.end, d.rule.label) not in chosen)], key=lambda d: (d.start, d.end))


_WORDS = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
_ASCII_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


#: Labels that grant nothing, and the weight up to which one of them yields to a grant in the same text.
_NO_GRANT, _RESERVED = {"proprietary", "non-commercial", "research-only"}, 0.7


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a whole text."""
    raw = (text or "").encode()
    words = raw.translate(_WORDS).split()
    starts, base = [], set()
    if b"license" in words:
        at = -1
        for _ in range(words.count(b"license")):
            at = words.index(b"license", at + 1)
            for phrase, label in BASE:
                a = at - len(phrase) + 1
                if a >= 0 and words[a:at] == [w.encode() for w in phrase[:-1]]:
                    starts.append(a)
                    base.add(label)
    labels, weight = set(base), {}
    found = detect(raw.translate(_ASCII_LOWER).decode())
    granted = bool(base) or any(d.rule.label not in _NO_GRANT for d in found)
    for d in found:
        if granted and d.rule.label == "proprietary" and d.rule.weight <= _RESERVED:
            continue  # a license keeps its author's other rights
        labels.add(d.rule.label)
        weight[d.start] = max(weight.get(d.start, 0.0), d.rule.weight)
    miss = 1.0 if weight or not base else 0.3
    for start in sorted(weight):
        miss *= 1 - weight[start]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1 - miss


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id with the columns of scan_text() for every whole text.

    Null counts as empty: no words, no labels, score 0.  Words are runs of
    digits, letters and characters beyond ASCII, A-Z as a-z.  n_base counts every place of a
    base phrase.  labels has the base ones and those of the rules; score is the
    chance that some mention holds, each counted once with the weight of its detection and taken as independent (0.7 for base
    phrases that no rule detects).  Only doc_id and text are read, so other columns may have any name.
    Repeated rows and null ids stay; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
