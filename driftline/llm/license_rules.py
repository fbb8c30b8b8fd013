"""Signature rules for licences, as data.

A pattern is a regular expression over lower-cased text in which a blank stands for any run of characters that are not
word characters, and which must begin and end at word borders.  Each rule is gated by a keyword (one word or part of a
word that every match needs, so never across a gap): it only runs on texts that contain the keyword.  Reference rules
are the exception: "released under the" refers to a licence only in a text that mentions one, so theirs is a condition.
Priorities order the rules when detections overlap.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    kind: str
    keyword: str
    pattern: str


# Kind: (priority, confidence).
KINDS = {
    "spdx": (60, 1.0),
    "notice": (50, 0.95),
    "url": (45, 0.95),
    "title": (40, 0.9),
    "name": (30, 0.8),
    "hint": (20, 0.6),
    "reference": (10, 0.4),
}

# Identifiers after an SPDX tag, in the writing of the SPDX list.
SPDX_IDS = """
0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0
BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0
CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0
EFL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0
GPL-3.0-only GPL-3.0-or-later HPND ICU IPL-1.0 ISC LGPL-2.0 LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only
LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0
PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby RPL-1.5 SSPL-1.0 UPL-1.0 Unicode-DFS-2016 Unlicense Vim W3C WTFPL X11
Zlib ZPL-2.1
""".split()

# label | keyword | title or name of the licence.  Versioned titles are "title" rules, others "name" rules.
TITLES = """
gpl-1.0 | general | (?:gnu )?general public licen[cs]e,? ?(?:version|v) ?1(?:\\.0)?
gpl-2.0 | general | (?:gnu )?general public licen[cs]e,? ?(?:version|v) ?2(?:\\.0)?
gpl-3.0 | general | (?:gnu )?general public licen[cs]e,? ?(?:version|v) ?3(?:\\.0)?
gpl-2.0 | gplv2 | (?:gnu )?gplv2
gpl-3.0 | gplv3 | (?:gnu )?gplv3
gpl-2.0 | gpl | (?:gnu )?gpl (?:version|v)? ?2(?:\\.0)?
gpl-3.0 | gpl | (?:gnu )?gpl (?:version|v)? ?3(?:\\.0)?
gpl | general | gnu general public licen[cs]e
gpl | gnu | gnu gpl
lgpl-2.0 | library | (?:gnu )?library general public licen[cs]e(?: version 2)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e,? ?(?:version|v) ?2\\.1
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e,? ?(?:version|v) ?3(?:\\.0)?
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl-2.1 | lgpl | lgpl ?v?2\\.1
lgpl-3.0 | lgpl | lgpl ?v?3(?:\\.0)?
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e,? ?(?:version|v) ?3(?:\\.0)?
agpl | affero | (?:gnu )?affero general public licen[cs]e
agpl-3.0 | agpl | agpl ?v?3(?:\\.0)?
gfdl-1.3 | documentation | (?:gnu )?free documentation licen[cs]e,? ?(?:version|v) ?1\\.3
gfdl-1.2 | documentation | (?:gnu )?free documentation licen[cs]e,? ?(?:version|v) ?1\\.2
gfdl | documentation | gnu free documentation licen[cs]e
apache-1.0 | apache | apache (?:software )?licen[cs]e,? ?(?:version|v)? ?1\\.0
apache-1.1 | apache | apache (?:software )?licen[cs]e,? ?(?:version|v)? ?1\\.1
apache-2.0 | apache | apache (?:software )?licen[cs]e,? ?(?:version|v)? ?2(?:\\.0)?
apache-2.0 | apache | apache 2(?:\\.0)? licen[cs]e
apache | apache | apache (?:software |public )?licen[cs]e
mit | licen | mit licen[cs]e
mit | expat | expat licen[cs]e
mit | style | mit style licen[cs]e
x11 | x11 | x11 licen[cs]e
isc | isc | isc licen[cs]e
bsd-2-clause | clause | (?:simplified |freebsd )?bsd 2 clause(?: licen[cs]e)?
bsd-2-clause | simplified | simplified bsd licen[cs]e
bsd-2-clause | freebsd | freebsd licen[cs]e
bsd-3-clause | clause | bsd 3 clause(?: licen[cs]e)?
bsd-3-clause | bsd | new bsd licen[cs]e
bsd-3-clause | modified | modified bsd licen[cs]e
bsd-4-clause | clause | bsd 4 clause(?: licen[cs]e)?
bsd | bsd | (?:berkeley )?bsd (?:style )?licen[cs]e
0bsd | clause | zero clause bsd(?: licen[cs]e)?
mpl-1.0 | mozilla | mozilla public licen[cs]e,? ?(?:version|v)? ?1\\.0
mpl-1.1 | mozilla | mozilla public licen[cs]e,? ?(?:version|v)? ?1\\.1
mpl-2.0 | mozilla | mozilla public licen[cs]e,? ?(?:version|v)? ?2(?:\\.0)?
mpl | mozilla | mozilla public licen[cs]e
epl-1.0 | eclipse | eclipse public licen[cs]e,? ?(?:version|v)? ?1\\.0
epl-2.0 | eclipse | eclipse public licen[cs]e,? ?(?:version|v)? ?2\\.0
epl | eclipse | eclipse public licen[cs]e
edl-1.0 | eclipse | eclipse distribution licen[cs]e
cddl-1.0 | development | common development and distribution licen[cs]e(?: version 1\\.0)?
cddl-1.1 | development | common development and distribution licen[cs]e version 1\\.1
cpl-1.0 | common | common public licen[cs]e(?: version 1\\.0)?
ipl-1.0 | ibm | ibm public licen[cs]e(?: version 1\\.0)?
bsl-1.0 | boost | boost software licen[cs]e(?: version 1\\.0)?
busl-1.1 | business | business source licen[cs]e(?: version)?(?: 1\\.1)?
sspl-1.0 | server | server side public licen[cs]e(?: version 1)?
elastic-2.0 | elastic | elastic licen[cs]e(?: version)?(?: 2\\.0)?
cc0-1.0 | cc0 | cc0(?: 1\\.0)?(?: universal)?
cc0-1.0 | dedication | (?:cc0 )?public domain dedication
cc-by-1.0 | cc | cc by 1\\.0
cc-by-2.0 | cc | cc by 2\\.0
cc-by-2.5 | cc | cc by 2\\.5
cc-by-3.0 | cc | cc by 3\\.0
cc-by-4.0 | cc | cc by 4\\.0
cc-by-sa-2.0 | cc | cc by sa 2\\.0
cc-by-sa-3.0 | cc | cc by sa 3\\.0
cc-by-sa-4.0 | cc | cc by sa 4\\.0
cc-by-nc-2.0 | cc | cc by nc 2\\.0
cc-by-nc-3.0 | cc | cc by nc 3\\.0
cc-by-nc-4.0 | cc | cc by nc 4\\.0
cc-by-nd-3.0 | cc | cc by nd 3\\.0
cc-by-nd-4.0 | cc | cc by nd 4\\.0
cc-by-nc-sa-3.0 | cc | cc by nc sa 3\\.0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4\\.0
cc-by-nc-nd-3.0 | cc | cc by nc nd 3\\.0
cc-by-nc-nd-4.0 | cc | cc by nc nd 4\\.0
cc-by-sa | cc | cc by sa
cc-by-nc | cc | cc by nc
cc-by-nd | cc | cc by nd
cc-by-nc-sa | cc | cc by nc sa
cc-by-nc-nd | cc | cc by nc nd
cc-by | cc | cc by
cc-by-4.0 | creative | creative commons attribution 4\\.0(?: international)?(?: licen[cs]e)?
cc-by-3.0 | creative | creative commons attribution 3\\.0(?: unported)?(?: licen[cs]e)?
cc-by-sa-4.0 | creative | creative commons attribution share ?alike 4\\.0(?: international)?(?: licen[cs]e)?
cc-by-sa-3.0 | creative | creative commons attribution share ?alike 3\\.0(?: unported)?(?: licen[cs]e)?
cc-by-nc-4.0 | creative | creative commons attribution non ?commercial 4\\.0(?: international)?(?: licen[cs]e)?
cc-by-nd-4.0 | creative | creative commons attribution no ?deriv(?:ative)?s 4\\.0(?: international)?(?: licen[cs]e)?
cc-by-nc-sa-4.0 | creative | creative commons attribution non ?commercial share ?alike 4\\.0(?: international)?(?: licen[cs]e)?
cc-by-nc-nd-4.0 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4\\.0(?: international)?(?: licen[cs]e)?
cc-by | creative | creative commons attribution(?: licen[cs]e)?
creative-commons | creative | creative commons licen[cs]e
afl-3.0 | academic | academic free licen[cs]e(?: version)?(?: 3\\.0)?
osl-3.0 | open | open software licen[cs]e(?: version)?(?: 3\\.0)?
artistic-1.0 | artistic | artistic licen[cs]e(?: version)? 1\\.0
artistic-2.0 | artistic | artistic licen[cs]e(?: version)? 2(?:\\.0)?
artistic | artistic | artistic licen[cs]e
perl | perl | same terms as perl(?: itself)?
eupl-1.1 | european | european union public licen[cs]e(?: version)? 1\\.1
eupl-1.2 | european | european union public licen[cs]e(?: version)? 1\\.2
eupl | european | european union public licen[cs]e
cecill-2.1 | cecill | cecill(?: 2\\.1)?(?: licen[cs]e)?
ecl-2.0 | educational | educational community licen[cs]e(?: version)?(?: 2\\.0)?
lppl-1.3c | latex | latex project public licen[cs]e(?: version)?(?: 1\\.3c?)?
ms-pl | microsoft | microsoft public licen[cs]e
ms-rl | microsoft | microsoft reciprocal licen[cs]e
mulanpsl-2.0 | mulan | mulan p(?:ermissive )?s(?:oftware )?l(?:icen[cs]e)?(?: v)?(?: ?2)?
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
odbl-1.0 | database | open (?:data commons open )?database licen[cs]e(?: v)?(?: ?1\\.0)?
odc-by-1.0 | commons | open data commons attribution licen[cs]e
pddl-1.0 | commons | open data commons public domain dedication(?: and licen[cs]e)?
ofl-1.1 | font | (?:sil )?open font licen[cs]e(?: version)?(?: 1\\.1)?
openssl | openssl | openssl licen[cs]e
php-3.01 | php | php licen[cs]e(?: version)?(?: 3\\.01)?
postgresql | postgresql | postgresql licen[cs]e
psf-2.0 | python | python software foundation licen[cs]e(?: version)?(?: 2)?
qpl-1.0 | public | q public licen[cs]e(?: version)?(?: 1\\.0)?
rpl-1.5 | reciprocal | reciprocal public licen[cs]e(?: version)?(?: 1\\.5)?
ruby | ruby | ruby licen[cs]e
unicode | unicode | unicode(?: inc)? licen[cs]e(?: agreement)?
unlicense | unlicense | (?:the )?unlicense
upl-1.0 | permissive | universal permissive licen[cs]e(?: version)?(?: 1\\.0)?
vim | vim | vim licen[cs]e
w3c | w3c | w3c software (?:notice and )?licen[cs]e
wtfpl | wtfpl | wtfpl(?: version)?(?: 2)?
wtfpl | want | do what the f\\S{1,12} you want to public licen[cs]e
zlib | zlib | zlib (?:libpng )?licen[cs]e
zpl-2.1 | zope | zope public licen[cs]e(?: version)?(?: 2\\.1)?
llama-2 | llama | llama 2 community licen[cs]e(?: agreement)?
openrail | rail | (?:creativeml )?open ?rail(?: m)?(?: licen[cs]e)?
proprietary | rights | all rights reserved
proprietary | proprietary | proprietary(?: and confidential)? licen[cs]e
public-domain | domain | (?:released|placed|dedicated|is) (?:into|in|to) the public domain
"""

# label | keyword | sentence that grants the licence or opens its text.
NOTICES = """
gpl | software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
lgpl | software | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e
agpl | affero | under the terms of the gnu affero general public licen[cs]e
gpl-2.0-or-later | option | either version 2 of the licen[cs]e or at your option any later version
gpl-3.0-or-later | option | either version 3 of the licen[cs]e or at your option any later version
gpl-3.0 | general | licen[cs]ed under the gnu general public licen[cs]e,? ?(?:version|v) ?3(?:\\.0)?
gpl-2.0 | general | licen[cs]ed under the gnu general public licen[cs]e,? ?(?:version|v) ?2(?:\\.0)?
gpl | warranty | without even the implied warranty of merchantability or fitness for a particular purpose
apache-2.0 | apache | licen[cs]ed under the apache licen[cs]e,? version 2\\.0
apache-2.0 | compliance | you may not use this file except in compliance with the licen[cs]e
mit | licen | (?:released|licen[cs]ed|distributed|available) under the (?:terms of the )?mit licen[cs]e
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse | be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e v 2\\.0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public licen[cs]e version 1\\.1
epl-2.0 | eclipse | are made available under the terms of the eclipse public licen[cs]e (?:v )?2\\.0
epl-1.0 | eclipse | are made available under the terms of the eclipse public licen[cs]e v1\\.0
bsl-1.0 | boost | distributed under the boost software licen[cs]e version 1\\.0
zlib | warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense | unencumbered | this is free and unencumbered software released into the public domain
cc-by-4.0 | cc | licen[cs]ed under (?:a )?cc by 4\\.0
cc-by-sa-4.0 | cc | licen[cs]ed under (?:a )?cc by sa 4\\.0
cc-by-nc-4.0 | cc | licen[cs]ed under (?:a )?cc by nc 4\\.0
cc-by-nc-sa-4.0 | cc | licen[cs]ed under (?:a )?cc by nc sa 4\\.0
cc-by-nd-4.0 | cc | licen[cs]ed under (?:a )?cc by nd 4\\.0
cc-by | creative | licen[cs]ed under a creative commons attribution
ofl-1.1 | font | this font software is licen[cs]ed under the sil open font licen[cs]e version 1\\.1
proprietary | confidential | proprietary and confidential
"""

# label | keyword | address.
URLS = """
apache-2.0 | apache | apache org licenses license 2\\.0(?: txt| html)?
gpl-2.0 | gnu | gnu org licenses (?:old licenses )?gpl 2\\.0(?: txt| html)?
gpl-3.0 | gnu | gnu org licenses gpl 3\\.0(?: txt| html)?
lgpl-2.1 | gnu | gnu org licenses (?:old licenses )?lgpl 2\\.1(?: txt| html)?
lgpl-3.0 | gnu | gnu org licenses lgpl 3\\.0(?: txt| html)?
agpl-3.0 | gnu | gnu org licenses agpl 3\\.0(?: txt| html)?
gfdl-1.3 | gnu | gnu org licenses fdl 1\\.3(?: txt| html)?
gpl | gnu | gnu org licenses gpl
mit | opensource | opensource org licenses mit(?: license)?(?: php)?
bsd-2-clause | opensource | opensource org licenses bsd 2 clause
bsd-3-clause | opensource | opensource org licenses bsd 3 clause
isc | opensource | opensource org licenses isc
artistic-2.0 | opensource | opensource org licenses artistic 2\\.0
mpl-2.0 | mozilla | mozilla org mpl 2\\.0
epl-1.0 | eclipse | eclipse org (?:legal|org documents) epl v ?10
epl-2.0 | eclipse | eclipse org legal epl (?:v ?20|2\\.0)
bsl-1.0 | boost | boost org license 1 0 txt
cc-by-3.0 | creativecommons | creativecommons org licenses by 3\\.0
cc-by-4.0 | creativecommons | creativecommons org licenses by 4\\.0
cc-by-sa-3.0 | creativecommons | creativecommons org licenses by sa 3\\.0
cc-by-sa-4.0 | creativecommons | creativecommons org licenses by sa 4\\.0
cc-by-nc-4.0 | creativecommons | creativecommons org licenses by nc 4\\.0
cc-by-nd-4.0 | creativecommons | creativecommons org licenses by nd 4\\.0
cc-by-nc-sa-4.0 | creativecommons | creativecommons org licenses by nc sa 4\\.0
cc-by-nc-nd-4.0 | creativecommons | creativecommons org licenses by nc nd 4\\.0
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1\\.0
ofl-1.1 | scripts | scripts sil org ofl
unlicense | unlicense | unlicense org
wtfpl | wtfpl | wtfpl net
odbl-1.0 | opendatacommons | opendatacommons org licenses odbl
"""

REFERENCES = """
unknown-license | licen | (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms (?:and conditions )?of )?
unknown-license | licen | see (?:the )?(?:accompanying )?licen[cs]e (?:file )?for (?:more )?(?:details|information)
"""


def _table(text: str, kind: str) -> list[Rule]:
    rules = []
    for line in text.strip().splitlines():
        label, keyword, pattern = (part.strip() for part in line.split(" | ", 2))
        versioned = any(c.isdigit() for c in label)
        rules.append(Rule(label, ("title" if versioned else "name") if kind == "title" else kind, keyword, pattern))
    return rules


def rules() -> list[Rule]:
    """All rules, in the order in which equal priorities are resolved."""
    tagged = [
        Rule(x.lower(), "spdx", "spdx", f"spdx licen[cs]e identifier {x.lower().replace('.', chr(92) + '.').replace('-', ' ')}")
        for x in sorted(SPDX_IDS, key=lambda x: -len(x))
    ]
    return [
        *tagged, *_table(NOTICES, "notice"), *_table(URLS, "url"), *_table(TITLES, "title"), *_table(REFERENCES, "reference"),
    ]
