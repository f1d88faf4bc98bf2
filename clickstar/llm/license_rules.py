"""License signatures: priority, label, keyword and pattern of each rule.

Patterns are matched against normalised text: lower case, words joined by single blanks,
so ``2.0`` reads ``2 0`` and ``CC-BY`` reads ``cc by``. A match must start and end at word
borders. The keyword is a word that every match contains; the scan looks for it first.
"""

from __future__ import annotations

# Exact phrases; their labels and places are reported apart from the other rules.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Families whose members differ by version: label, names, versions, keyword.
VERSIONED = (
    ("gpl", "(?:gnu )?(?:general public licen[cs]e|gpl)", ("1 0", "2 0", "3 0", "1", "2", "3"), "gpl|general"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public licen[cs]e", ("2 0", "2 1", "3 0", "2", "3"), "general"),
    ("agpl", "(?:gnu )?affero general public licen[cs]e", ("1 0", "3 0", "1", "3"), "affero"),
    ("gfdl", "(?:gnu )?free documentation licen[cs]e", ("1 1", "1 2", "1 3"), "documentation"),
    ("apache", "apache (?:software )?licen[cs]e", ("1 0", "1 1", "2 0", "2"), "apache"),
    ("mpl", "mozilla public licen[cs]e", ("1 0", "1 1", "2 0"), "mozilla"),
    ("epl", "eclipse public licen[cs]e", ("1 0", "2 0"), "eclipse"),
    ("cddl", "common development and distribution licen[cs]e", ("1 0", "1 1"), "distribution"),
    ("cpl", "common public licen[cs]e", ("1 0",), "common"),
    ("eupl", "european union public licen[cs]e", ("1 0", "1 1", "1 2"), "european"),
    ("osl", "open software licen[cs]e", ("1 0", "2 0", "2 1", "3 0"), "software"),
    ("afl", "academic free licen[cs]e", ("1 1", "1 2", "2 0", "2 1", "3 0"), "academic"),
    ("artistic", "artistic licen[cs]e", ("1 0", "2 0"), "artistic"),
    ("cecill", "cecill(?: free software)? licen[cs]e", ("1 0", "1 1", "2 0", "2 1"), "cecill"),
    ("odbl", "open (?:data commons )?(?:open )?database licen[cs]e", ("1 0",), "database"),
    ("odc-by", "open data commons attribution licen[cs]e", ("1 0",), "commons"),
    ("python", "python (?:software foundation )?licen[cs]e", ("2 0", "2", "3"), "python"),
    ("php", "php licen[cs]e", ("3 0", "3 01"), "php"),
    ("zpl", "zope public licen[cs]e", ("1 1", "2 0", "2 1"), "zope"),
    ("ofl", "sil open font licen[cs]e", ("1 0", "1 1"), "font"),
    ("lppl", "latex project public licen[cs]e", ("1 0", "1 1", "1 2", "1 3"), "latex"),
    ("ms-pl", "microsoft (?:public|reciprocal) licen[cs]e", ("1 0",), "microsoft"),
    ("ogl", "open government licen[cs]e", ("1 0", "2 0", "3 0"), "government"),
    ("apsl", "apple public source licen[cs]e", ("1 0", "1 1", "1 2", "2 0"), "apple"),
    ("npl", "netscape public licen[cs]e", ("1 0", "1 1"), "netscape"),
    ("sspl", "server side public licen[cs]e", ("1", "1 0"), "server"),
    ("busl", "business source licen[cs]e", ("1 0", "1 1"), "business"),
    ("bsl", "boost software licen[cs]e", ("1 0",), "boost"),
    ("openssl", "openssl licen[cs]e", ("1 0",), "openssl"),
    ("elastic", "elastic licen[cs]e", ("1 0", "2 0"), "elastic"),
)

# Creative Commons members: label, element words.
COMMONS = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Rules on their own: priority, label, keyword, pattern.
SINGLE = (
    (60, "mit", "mit", "mit licen[cs]e"),
    (60, "mit", "mit", "released under (?:the )?mit"),
    (60, "mit", "merchantability", "warranties of merchantability fitness for a particular purpose and noninfringement"),
    (70, "mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    (60, "x11", "x11", "x11 licen[cs]e"),
    (60, "isc", "isc", "isc licen[cs]e"),
    (70, "isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    (60, "bsd", "bsd", "bsd licen[cs]e"),
    (65, "bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[cs]e)?"),
    (65, "bsd-2", "freebsd", "freebsd(?: licen[cs]e)?"),
    (65, "bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[cs]e)?"),
    (65, "bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?"),
    (70, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    (75, "bsd-3", "endorse", "may be used to endorse or promote products derived from this software"),
    (75, "bsd-4", "advertising", "all advertising materials mentioning features or use of this software must display"),
    (60, "zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    (70, "zlib", "altered", "altered source versions must be plainly marked as such"),
    (60, "unlicense", "unlicense", "(?:the )?unlicense"),
    (70, "unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    (60, "wtfpl", "wtfpl", "wtfpl"),
    (60, "cc0", "cc0", "cc0(?: 1 0)?"),
    (65, "cc0", "waive", "waive all copyright and related (?:or|and) neighbou?ring rights"),
    (65, "cc0", "zero", "creative commons zero"),
    (50, "public-domain", "domain", "(?:in|into|to) the public domain"),
    (55, "public-domain", "domain", "dedicated to the public domain"),
    (55, "public-domain", "domain", "public domain (?:mark|dedication|work)"),
    (60, "beerware", "beerware", "beerware(?: licen[cs]e)?"),
    (60, "json", "json", "json licen[cs]e"),
    (70, "json", "evil", "shall be used for good not evil"),
    (60, "icu", "icu", "icu licen[cs]e"),
    (60, "ntp", "ntp", "ntp licen[cs]e"),
    (60, "curl", "curl", "curl licen[cs]e"),
    (60, "ruby", "ruby", "ruby licen[cs]e"),
    (60, "perl", "perl", "same terms as perl(?: itself)?"),
    (60, "postgresql", "postgresql", "postgresql licen[cs]e"),
    (60, "vim", "vim", "vim licen[cs]e"),
    (60, "unicode", "unicode", "unicode (?:inc )?licen[cs]e(?: agreement)?"),
    (60, "w3c", "w3c", "w3c (?:software|document)(?: notice and)? licen[cs]e"),
    (60, "ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    (60, "mulan", "mulan", "mulan (?:permissive software|psl|publ)(?: licen[cs]e)?"),
    (60, "bittorrent", "bittorrent", "bittorrent open source licen[cs]e"),
    (60, "intel", "intel", "intel open source licen[cs]e"),
    (60, "ibm", "ibm", "ibm public licen[cs]e"),
    (60, "sun", "sun", "sun (?:industry standards source|public) licen[cs]e"),
    (60, "qpl", "q", "q public licen[cs]e"),
    (60, "upl", "upl", "upl licen[cs]e"),
    (60, "upl", "universal", "universal permissive licen[cs]e"),
    (60, "ecl", "educational", "educational community licen[cs]e"),
    (60, "fsl", "functional", "functional source licen[cs]e"),
    (60, "commons-clause", "commons", "commons clause"),
    (60, "polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter)"),
    (60, "openrail", "openrail", "openrail(?: m| s)?"),
    (60, "rail", "responsible", "responsible ai licen[cs]e"),
    (60, "llama", "llama", "llama (?:2 |3 )?community licen[cs]e"),
    (60, "gemma", "gemma", "gemma terms of use"),
    (40, "reserved", "rights", "all rights (?:are )?reserved"),
    (40, "reserved", "rights", "(?:some|no) rights reserved"),
    (45, "reserved", "reproduced", "(?:may|must) not be reproduced"),
    (45, "reserved", "reproduced", "no part of this (?:publication|book|work|document) may be reproduced"),
    (45, "reserved", "permission", "(?:reproduction|used|reprinted|published) (?:only )?(?:with|by) permission"),
    (45, "reserved", "permission", "without (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
    (45, "reserved", "prohibited", "(?:unauthori[sz]ed )?(?:copying|reproduction|distribution|duplication) (?:is )?(?:strictly )?prohibited"),
    (45, "proprietary", "proprietary", "proprietary and confidential"),
    (45, "proprietary", "proprietary", "proprietary (?:software|licen[cs]e|information)"),
    (45, "proprietary", "confidential", "strictly (?:private and )?confidential"),
    (45, "proprietary", "commercial", "commercial licen[cs]e (?:agreement|required)"),
    (45, "eula", "end", "end user licen[cs]e agreement"),
    (45, "eula", "eula", "eula"),
    (35, "copyright", "copyright", "copyright (?:c )?(?:19|20)\\d\\d"),
    (34, "copyright", "copyright", "copyright (?:by|of|holders?|owners?|notice)"),
    (35, "copyright", "copyrighted", "copyrighted (?:material|work|by)"),
    (30, "generic", "licensed", "licensed under (?:the )?terms"),
    (30, "generic", "license", "(?:subject to|under|see) the licen[cs]e"),
    (30, "generic", "license", "terms of (?:the|this) license"),
    (30, "generic", "licence", "(?:subject to|under|see) the licence"),
    (30, "generic", "licence", "terms of (?:the|this) licence"),
)

# SPDX tags and license addresses: label, tag words, address words.
TAGGED = (
    ("mit", "mit", "opensource org licenses mit"), ("isc", "isc", "opensource org licenses isc"),
    ("apache", "apache 2 0", "apache org licenses license 2 0"),
    ("gpl", "gpl 2 0(?: only| or later)?", "gnu org licenses gpl 2 0"),
    ("gpl", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("lgpl", "lgpl 2 1(?: only| or later)?", "gnu org licenses lgpl 2 1"),
    ("lgpl", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("agpl", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("gfdl", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    ("mpl", "mpl 2 0", "mozilla org mpl 2 0"), ("epl", "epl 2 0", "eclipse org legal epl 2 0"),
    ("bsd-2", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("unlicense", "unlicense", "unlicense org"), ("cc0", "cc0 1 0", "publicdomain zero 1 0"),
    ("zlib", "zlib", "opensource org licenses zlib"), ("bsl", "bsl 1 0", "boost org license 1 0"),
    ("artistic", "artistic 2 0", "opensource org licenses artistic"),
    ("ofl", "ofl 1 1", "scripts sil org ofl"), ("cddl", "cddl 1 0", "opensource org licenses cddl"),
    ("eupl", "eupl 1 2", "joinup ec europa eu eupl"), ("osl", "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl", "afl 3 0", "opensource org licenses afl 3 0"), ("postgresql", "postgresql", "opensource org licenses postgresql"),
    ("python", "python 2 0", "docs python org license"), ("wtfpl", "wtfpl", "wtfpl net"),
    ("ncsa", "ncsa", "opensource org licenses ncsa"), ("upl", "upl 1 0", "opensource org licenses upl"),
    ("odbl", "odbl 1 0", "opendatacommons org licenses odbl"), ("odc-by", "odc by 1 0", "opendatacommons org licenses by"),
)


def rules() -> list[dict]:
    """All rules in order of priority: the more exact a signature, the higher."""
    found: list[tuple[int, str, str, str]] = list(SINGLE)
    for label, names, versions, keywords in VERSIONED:
        for keyword in keywords.split("|"):
            found.append((60, label, keyword, names))
            for version in versions:
                exact = f"{label}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
                found.append((80, exact, keyword, f"{names}(?: version| v)? {version}"))
                found.append((82, f"{exact}+", keyword,
                              f"{names}(?: version| v)? {version} or (?:any )?later"))
    for label, short, name in COMMONS:
        found.append((60, label, "cc", f"cc {short}"))
        found.append((60, label, "commons", f"creative commons {name}"))
        for version in COMMONS_VERSIONS:
            tagged = f"{label}-{version.replace(' ', '.')}"
            found.append((80, tagged, "cc", f"cc {short} {version}"))
            found.append((80, tagged, "commons",
                          f"creative commons {name}(?: international| unported| generic)? {version}"))
            found.append((85, tagged, "creativecommons",
                          f"creativecommons org licenses {short} {version}"))
    for label, tag, address in TAGGED:
        found.append((90, label, "spdx", f"spdx license identifier {tag}"))
        found.append((85, label, address.split()[0], address))
    return [{"rule": n, "priority": p, "label": label, "keyword": k, "pattern": f"(?<= )(?:{x})(?= )"}
            for n, (p, label, k, x) in enumerate(sorted(set(found), key=lambda f: (-f[0], f[1:])))]
