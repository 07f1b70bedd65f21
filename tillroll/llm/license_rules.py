"""License signatures: names of licenses times the forms in which texts refer to them.

Every rule is a regular expression over normalised text: words of lower-case letters,
digits and other characters, each after one blank. Rules are ordered by priority; the
first priority is the most explicit form.
"""

from __future__ import annotations

# Label, keywords of which every text that the names match holds at least one
# as a word, names as expressions, identifier as words (its first is its keyword), or empty.
FAMILIES = [
    ("mit", "mit", "mit|expat mit|mit expat|mit x11", "mit"),
    ("x11", "x11 consortium", "x11|x consortium", "x11"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version| v)? 2(?: 0)?|apache(?: software)? license 2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version| v)? 1 1", "apache 1 1"),
    ("apache", "apache", "apache(?: software)?", ""),
    ("gpl-3", "gpl gpl3 gplv gplv3 gplversion", "(?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", "gpl gpl2 gplv gplv2 gplversion", "(?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl", "gpl", "(?:gnu )?gpl", ""),
    ("gpl-3", "gnu", "gnu general public license(?: gpl)?(?: as published by the free software foundation either)?(?: version| v) ?3(?: 0)?", ""),
    ("gpl-2", "gnu", "gnu general public license(?: gpl)?(?: as published by the free software foundation either)?(?: version| v) ?2(?: 0)?", ""),
    ("gpl", "gnu", "gnu general public license", ""),
    ("lgpl-3", "lgpl lgpl3 lgplv lgplv3 lgplversion", "(?:gnu )?lgpl ?(?:version |v ?)?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl lgpl2 lgplv lgplv2 lgplversion", "(?:gnu )?lgpl ?(?:version |v ?)?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ""),
    ("lgpl-3", "lesser", "gnu lesser general public license(?: lgpl)?(?: version| v) ?3(?: 0)?", ""),
    ("lgpl-2.1", "lesser", "gnu lesser general public license(?: lgpl)?(?: version| v) ?2 1", ""),
    ("lgpl", "lesser", "gnu lesser general public license", ""),
    ("agpl-3", "agpl agpl3 agplv agplv3 agplversion", "(?:gnu )?agpl ?(?:version |v ?)?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl", "agpl", "(?:gnu )?agpl", ""),
    ("agpl-3", "affero", "gnu affero general public license(?: agpl)?(?: version| v) ?3(?: 0)?", ""),
    ("agpl", "affero", "gnu affero general public license", ""),
    ("gfdl", "documentation", "gnu free documentation license(?: version| v)?(?: 1 [123])?", "gfdl 1 [123](?: only| or later)?"),
    ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", "bsd 3 clause"),
    ("bsd-2", "bsd freebsd", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd 2 clause"),
    ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", "bsd 4 clause"),
    ("0bsd", "zero 0bsd", "(?:zero clause bsd|0bsd)", "0bsd"),
    ("bsd", "bsd", "bsd", ""),
    ("isc", "isc", "isc", "isc"),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? 2(?: 0)?", ""),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? 1 1", ""),
    ("mpl", "mozilla", "mozilla public", ""),
    ("mpl-2", "mpl mpl2 mplv mplv2 mplversion", "mpl ?(?:version |v ?)?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", "mpl mpl1 mplv mplv1 mplversion", "mpl ?(?:version |v ?)?1 1", "mpl 1 1"),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0"),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0"),
    ("epl", "eclipse", "eclipse public", ""),
    ("edl-1", "eclipse", "eclipse distribution license(?: version| v)?(?: 1(?: 0)?)?", ""),
    ("cddl-1", "cddl cddl1 cddlv cddlv1 cddlversion", "cddl ?(?:version |v ?)?1(?: [01])?", "cddl 1 [01]"),
    ("cddl-1", "distribution", "common development and distribution license", ""),
    ("cpl-1", "common", "common public license(?: version| v)?(?: 1(?: 0)?)?", "cpl 1 0"),
    ("ms-pl", "microsoft", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal", "ms rl"),
    ("artistic-2", "artistic", "artistic license(?: version| v)? 2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "(?:perl )?artistic", "artistic 1 0"),
    ("bsl-1", "boost", "boost software(?: license)?(?: version| v)?(?: 1(?: 0)?)?", "bsl 1 0"),
    ("busl-1.1", "business", "business source license(?: version| v)?(?: 1 1)?", "busl 1 1"),
    ("sspl-1", "server", "server side public license(?: version| v)?(?: 1(?: 0)?)?", "sspl 1 0"),
    ("elastic-2", "elastic", "elastic license(?: version| v)?(?: 2(?: 0)?)?", "elastic 2 0"),
    ("eupl-1.2", "eupl eupl1 euplv euplv1 euplversion", "eupl ?(?:version |v ?)?(?:1 2)?", "eupl 1 2"),
    ("eupl-1.2", "european", "european union public license(?: version| v)?(?: 1 2)?", ""),
    ("ofl-1.1", "font", "(?:sil )?open font license(?: version| v)?(?: 1 1)?", "ofl 1 1"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("python-2", "python psf", "python software foundation|psf", "python 2 0"),
    ("php-3", "php", "php(?: license)?(?: version| v)?(?: 3(?: 0[01])?)?", "php 3 01"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("odbl-1", "database", "open database license(?: version| v)?(?: 1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1", "data", "open data commons attribution", "odc by 1 0"),
    ("ncsa", "illinois", "university of illinois(?: ncsa)?(?: open source)?", "ncsa"),
    ("afl-3", "academic", "academic free license(?: version| v)?(?: 3(?: 0)?)?", "afl 3 0"),
    ("osl-3", "open", "open software license(?: version| v)?(?: 3(?: 0)?)?", "osl 3 0"),
    ("cc0-1", "cc0 creative", "(?:cc0|creative commons zero|creative commons cc0)(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "cc", "cc by(?: [1234] [05])?", "cc by [1234] [05]"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] [05])?", "cc by sa [1234] [05]"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] [05])?", "cc by nd [1234] [05]"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] [05])?", "cc by nc [1234] [05]"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] [05])?", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] [05])?", "cc by nc nd [1234] [05]"),
    ("cc-by", "creative", "creative commons attribution(?: [1234] [05])?(?: international| unported)?", ""),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?", ""),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported)?", ""),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?", ""),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported)?", ""),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported)?", ""),
]

# Priority, confidence and expression of every form; {} is the name.
FORMS = [
    (1, 1.0, "spdx license identifier (?:{})"),
    (2, 0.95, "(?:licen[cs]ed|released|distributed|available|published|provided|redistributed) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{})(?: public)?(?: licen[cs]e)?"),
    (3, 0.85, "(?:{})(?: public)? licen[cs]e(?: version [0-9]+(?: [0-9]+)?)?"),
    (4, 0.7, "licen[cs]e(?: type| name| is| under)? (?:{})"),
]

# Label, keywords, priority, confidence, expression of texts that name no license.
TEXTS = [
    ("mit", "hereby", 2, 0.95, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution", 2, 0.9, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "purpose", 2, 0.9, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "warranty", 2, 0.9, "this software is provided as is without any express or implied warranty"),
    ("unlicense", "unencumbered", 2, 0.95, "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", 3, 0.8, "(?:released |dedicated |placed )?(?:into |in |to )the public domain"),
    ("all-rights-reserved", "reserved", 4, 0.6, "all rights reserved"),
    ("gpl-3", "gnu", 1, 1.0, "gnu org licenses gpl 3 0(?: en)?(?: html| txt)?"),
    ("gpl-2", "gnu", 1, 1.0, "gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?"),
    ("apache-2", "apache", 1, 1.0, "apache org licenses license 2 0(?: html| txt)?"),
    ("mit", "opensource", 1, 1.0, "opensource org licenses mit"),
    ("cc-by-nc", "creativecommons", 1, 1.0, "creativecommons org licenses by nc(?: [1234] [05])?"),
    ("cc-by-sa", "creativecommons", 1, 1.0, "creativecommons org licenses by sa(?: [1234] [05])?"),
    ("cc-by", "creativecommons", 1, 1.0, "creativecommons org licenses by(?: [1234] [05])?"),
]

#: Parts of which every normalised text that a rule can match holds at least one.
GATES = ["licen", "spdx", "under", "public domain", "all rights reserved", "permission", "redistribution", "as is"]


def rules() -> list[tuple[tuple[str, ...], list[tuple[int, float, str, str]]]]:
    """(keywords, [(priority, confidence, label, expression)]) of all rules, hundreds of them."""
    found: dict[tuple[str, ...], list[tuple[int, float, str, str]]] = {}
    for label, keywords, names, identifier in FAMILIES:
        for priority, confidence, form in FORMS:
            name = identifier if priority == 1 else names
            if name:
                # Names that end in "license" themselves need no other word for it.
                expression = f"(?:{name})(?: licen[cs]e)?" if priority == 3 and " license" in name else form.format(name)
                words = tuple(name.split()[:1] if priority == 1 else keywords.split())
                found.setdefault(words, []).append((priority, confidence, label, expression))
    for label, keywords, priority, confidence, expression in TEXTS:
        found.setdefault(tuple(keywords.split()), []).append((priority, confidence, label, expression))
    return sorted(found.items())
