"""The signature rules of the license scan, written by hand: sentences of license texts, notices, identifiers and mentions.

A line is ``label: signature``; headings say the rank. In a signature ``word`` must be there, ``word?`` may be, ``a|b`` is one of several (``a|b?`` one or none), ``_`` joins
words of one alternative, and ``*3`` stands for up to three words of any kind. Words are those of the scan: ASCII letters lower-cased, digits, and other letters.
"""

from __future__ import annotations

#: Parts of words of which every signature has one that must be there; a text without any is not looked at further.
GATES = (
    "licen", "spdx", "copy", "permi", "warrant", "redistribut", "reserved", "domain", "gnu", "gpl", "commons", "cc0",
    "confidential", "proprietary", "merchantab", "wtfpl", "openrail", "acknowledgement", "misrepresented", "altered", "mozilla", "eclipse", "copied", "scripts", "openssl", "consortium", "evil", "mulan", "gemma", "decompile",
)

IDENTIFIERS = """
mit: spdx license identifier mit
mit: spdx license identifier mit 0
mit: spdx license identifier mit modern|advertising|feh|cmu|enna
apache: spdx license identifier apache 2 0
apache: spdx license identifier apache 1 0|1
gpl: spdx license identifier gpl 1 0 only|or_later?
gpl: spdx license identifier gpl 2 0 only|or_later?
gpl: spdx license identifier gpl 3 0 only|or_later?
gpl: spdx license identifier gpl 2 0 with *4 exception
gpl: spdx license identifier gpl 3 0 with *4 exception
lgpl: spdx license identifier lgpl 2 0 only|or_later?
lgpl: spdx license identifier lgpl 2 1 only|or_later?
lgpl: spdx license identifier lgpl 3 0 only|or_later?
agpl: spdx license identifier agpl 3 0 only|or_later?
agpl: spdx license identifier agpl 1 0 only|or_later?
bsd: spdx license identifier bsd 2 clause patent|views?
bsd: spdx license identifier bsd 3 clause clear|lbnl|attribution?
bsd: spdx license identifier bsd 4 clause uc?
bsd: spdx license identifier 0bsd
bsd: spdx license identifier bsd 1 clause
bsd: spdx license identifier bsd source code
isc: spdx license identifier isc
zlib: spdx license identifier zlib acknowledgement?
mpl: spdx license identifier mpl 1 0|1
mpl: spdx license identifier mpl 2 0 no?
epl: spdx license identifier epl 1|2 0
cddl: spdx license identifier cddl 1 0|1
cpl: spdx license identifier cpl|ipl 1 0
bsl: spdx license identifier bsl 1 0
artistic: spdx license identifier artistic 1|2 0
unlicense: spdx license identifier unlicense
wtfpl: spdx license identifier wtfpl
cc0: spdx license identifier cc0 1 0
cc-by: spdx license identifier cc by 1|2|3|4 0|5
cc-by-sa: spdx license identifier cc by sa 1|2|3|4 0|5
cc-by-nc: spdx license identifier cc by nc 1|2|3|4 0|5
cc-by-nd: spdx license identifier cc by nd 1|2|3|4 0|5
cc-by-nc-sa: spdx license identifier cc by nc sa 1|2|3|4 0|5
cc-by-nc-nd: spdx license identifier cc by nc nd 1|2|3|4 0|5
odbl: spdx license identifier odbl 1 0
odc-by: spdx license identifier odc by 1 0
pddl: spdx license identifier pddl 1 0
ofl: spdx license identifier ofl 1 0|1
gfdl: spdx license identifier gfdl 1 1|2|3 only|or_later|invariants_only|no_invariants_only?
eupl: spdx license identifier eupl 1 0|1|2
ms-pl: spdx license identifier ms pl
ms-rl: spdx license identifier ms rl
python: spdx license identifier psf|python 2 0
php: spdx license identifier php 3 0|01
ruby: spdx license identifier ruby
openssl: spdx license identifier openssl
postgresql: spdx license identifier postgresql
x11: spdx license identifier x11
ncsa: spdx license identifier ncsa
vim: spdx license identifier vim
json: spdx license identifier json
beerware: spdx license identifier beerware
afl: spdx license identifier afl 1|2|3 0|1|2
osl: spdx license identifier osl 1|2|3 0|1
upl: spdx license identifier upl 1 0
sspl: spdx license identifier sspl 1 0
busl: spdx license identifier busl 1 1
elastic: spdx license identifier elastic 2 0
curl: spdx license identifier curl
icu: spdx license identifier icu
libpng: spdx license identifier libpng 2 0
w3c: spdx license identifier w3c
cecill: spdx license identifier cecill 1|2 0|1
mulan: spdx license identifier mulanpsl 1|2 0
blueoak: spdx license identifier blueoak 1 0 0
apache: apache license version? 2|v2|2_0|v2_0
apache: apache license version 1 0|1
gpl: gnu general public license version? 1|2|3|v1|v2|v3
gpl: gnu general public license as published by the free software foundation
lgpl: gnu lesser general public license version? 2|3|v2|v3
lgpl: gnu library general public license version? 2|v2
agpl: gnu affero general public license version? 3|v3
mpl: mozilla public license version? 1|2|v1|v2 0|1
epl: eclipse public license version? 1|2|v1|v2 0
cddl: common development and distribution license version? 1 0|1
cpl: common public license version? 1 0
eupl: european union public licence|license version? 1 0|1|2
bsl: boost software license version? 1 0
artistic: artistic license version? 1|2 0
cc-by: creative commons attribution 1|2|3|4 0|5 *2 license
cc-by: creative commons attribution license version? 1|2|3|4 0|5
cc-by-sa: creative commons attribution sharealike|share_alike license? version? 1|2|3|4 0|5
cc-by-nc: creative commons attribution noncommercial|non_commercial license? version? 1|2|3|4 0|5
cc-by-nd: creative commons attribution noderivatives|no_derivatives|noderivs license? version? 1|2|3|4 0|5
cc-by-nc-sa: creative commons attribution noncommercial|non_commercial sharealike|share_alike license? version? 1|2|3|4 0|5
cc-by-nc-nd: creative commons attribution noncommercial|non_commercial noderivatives|no_derivatives|noderivs license? version? 1|2|3|4 0|5
cc0: creative commons zero license? version? 1 0
cc0: cc0 1 0 universal
ofl: sil open font license version? 1 0|1
gfdl: gnu free documentation license version? 1 1|2|3
odbl: open database license version? 1 0
python: python software foundation license version? 2
php: php license version? 3 0|01
sspl: server side public license version? 1
busl: business source license version? 1 1
elastic: elastic license version? 2 0?
upl: universal permissive license version? 1 0
osl: open software license version? 2|3 0|1
afl: academic free license version? 2|3 0|1
"""

TEXTS = """
mit: permission is hereby granted free of charge to any person obtaining a copy
mit: to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
mit: the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit: in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit: released|distributed|licensed|available|provided under *3 mit|expat|x11 license|licence
mit: licensed under *2 mit
mit: opensource org licenses mit
mit: the? mit license mit
mit: mit style license
mit: see *4 license *4 mit license
mit: dual licensed under *3 mit and|or
apache: licensed under the apache license
apache: you may not use this file except in compliance with the license
apache: you may obtain a copy of the license at
apache: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache: without warranties or conditions of any kind either express or implied see the license for the specific language
apache: licensed to the apache software foundation asf? under one or more contributor license agreements
apache: see the notice file distributed with this work for additional information regarding copyright ownership
apache: apache org licenses license 2|1 0|1
apache: opensource org licenses apache 2 0
apache: this product includes software developed by the apache software foundation *4 license
apache: redistribution and use *30 apache software foundation
apache: the names apache and apache software foundation must not be used to endorse or promote products *12 permission
apache: released|distributed|available|provided under *3 apache license|licence
apache: grant of patent license subject to the terms and conditions of this license
apache: asl 2 0 license
gpl: you can redistribute it and or modify it under the terms of the gnu general public license
gpl: you should have received a copy of the gnu general public license along with
gpl: without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl: either version 1|2|3 of the license or at your option any later version
gpl: this program comes with absolutely no warranty
gpl: this is free software and you are welcome to redistribute it under certain conditions
gpl: released|distributed|licensed|available|provided under *4 gpl|gplv2|gplv3
gpl: licensed under *3 gnu gpl|general_public_license
gpl: gnu org licenses gpl 1|2|3? 0?
gpl: opensource org licenses gpl 2|3 0
gpl: gnu gpl version? 1|2|3|v1|v2|v3
gpl: gpl version 1|2|3
gpl: gplv2|gplv3 license
gpl: gpl compatible license
gpl: the licenses for most software are designed to take away your freedom to share and change it
gpl: everyone is permitted to copy and distribute verbatim copies of this license document
gpl: gpl 2 0 or later license
gpl: dual licensed under *3 gpl
gpl: as a special exception *30 gnu general public license
lgpl: you can redistribute it and or modify it under the terms of the gnu lesser|library general public license
lgpl: you should have received a copy of the gnu lesser|library general public license
lgpl: without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser|library general public license
lgpl: released|distributed|licensed|available|provided under *4 lgpl|lgplv2|lgplv3
lgpl: licensed under *3 gnu lesser general public license
lgpl: gnu org licenses lgpl 2|3? 0|1?
lgpl: opensource org licenses lgpl 2|3 0|1
lgpl: gnu lgpl version? 2|3|v2|v3
lgpl: lesser gpl license
lgpl: this license the lesser general public license applies to some specially designated software packages
agpl: you can redistribute it and or modify it under the terms of the gnu affero general public license
agpl: you should have received a copy of the gnu affero general public license
agpl: released|distributed|licensed|available|provided under *4 agpl|agplv3
agpl: gnu org licenses agpl 3? 0?
agpl: opensource org licenses agpl 3 0
agpl: gnu agpl version? 3|v3
bsd: redistribution and use in source and binary forms with or without modification are permitted provided
bsd: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd: redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd: neither the name of *12 nor the names of its contributors may be used to endorse or promote products *10 permission
bsd: all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd: this software is provided by the copyright holders and contributors as is
bsd: this product includes software developed by the university of california berkeley *4 contributors? copyright
bsd: released|distributed|licensed|available|provided under *4 bsd license|licence
bsd: licensed under *3 bsd
bsd: 2|3|4|two|three|four clause bsd license|licence
bsd: bsd 2|3|4 clause license|licence
bsd: new|modified|revised|simplified bsd license|licence
bsd: bsd style license
bsd: use of this source code is governed by a bsd style license that can be found in the license file
bsd: opensource org licenses bsd 2|3? clause|license?
bsd: bsd license *4 license file
isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc: provided that the above copyright notice and this permission notice appear in all copies
isc: the software is provided as is and the author|isc disclaims all warranties with regard to this software
isc: released|distributed|licensed|available under *3 isc license|licence
isc: opensource org licenses isc
isc: internet systems consortium license
zlib: this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib: the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib: permission is granted to anyone to use this software for any purpose including commercial applications
zlib: altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib: this notice may not be removed or altered from any source distribution
zlib: released|distributed|licensed|available under *3 zlib libpng? license|licence
zlib: opensource org licenses zlib
mpl: this source code form is subject to the terms of the mozilla public license
mpl: if a copy of the mpl was not distributed with this file you can obtain one at *6 mozilla org mpl
mpl: the contents of this file are subject to the mozilla public license
mpl: software distributed under the license is distributed on an as is basis without warranty of any kind
mpl: mozilla org mpl 2|1 0|1 license?
mpl: incompatible with secondary licenses
mpl: licensed under *4 mpl
mpl: opensource org licenses mpl 1|2 0|1
epl: this program and the accompanying materials are made available under the terms of the eclipse public license
epl: all rights reserved this program and the accompanying materials
epl: eclipse org legal epl v10|v20|2? license?
epl: licensed under *4 epl|eclipse_public_license
epl: opensource org licenses epl 1|2 0
epl: eclipse distribution license *3 1 0
cddl: the contents of this file are subject to the terms of the common development and distribution license
cddl: you can obtain a copy of the license at *10 opensolaris license
cddl: licensed under *4 cddl
cddl: opensource org licenses cddl 1? 0?
cpl: this program and the accompanying materials are made available under the terms of the common public license
cpl: ibm public license version? 1 0
bsl: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
bsl: distributed under the boost software license
bsl: boost org license 1 0
bsl: opensource org licenses bsl 1 0
artistic: released|distributed|licensed|available under *4 artistic license|licence
artistic: the intent of this document is to state the conditions under which a package may be copied
artistic: same terms as perl itself *6 license
artistic: you may redistribute it and or modify it under the same terms as perl
artistic: perlfoundation org artistic license 2 0
unlicense: this is free and unencumbered software released into the public domain
unlicense: anyone is free to copy modify publish use compile sell or distribute this software
unlicense: in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest
unlicense: unlicense org
unlicense: released|distributed|licensed|available under *3 unlicense
wtfpl: do what the fuck you want to public license
wtfpl: wtfpl version? 1|2
wtfpl: licensed under *3 wtfpl
cc0: has waived all copyright and related or neighboring rights
cc0: creativecommons org publicdomain zero 1 0
cc0: released|distributed|licensed|available|dedicated|waived under *4 cc0
cc0: creative commons public domain dedication
cc0: cc0 public domain dedication
cc-by: creativecommons org licenses by 1|2|3|4 0|5
cc-by: licensed under *3 cc by 1|2|3|4 0|5
cc-by: licensed under *4 creative commons attribution
cc-by-sa: creativecommons org licenses by sa 1|2|3|4 0|5
cc-by-sa: licensed under *3 cc by sa
cc-by-sa: licensed under *4 creative commons attribution sharealike|share_alike
cc-by-sa: if you remix transform or build upon the material you must distribute your contributions under the same license
cc-by-nc: creativecommons org licenses by nc 1|2|3|4 0|5
cc-by-nc: licensed under *3 cc by nc
cc-by-nc: licensed under *4 creative commons attribution noncommercial|non_commercial
cc-by-nd: creativecommons org licenses by nd 1|2|3|4 0|5
cc-by-nd: licensed under *3 cc by nd
cc-by-nc-sa: creativecommons org licenses by nc sa 1|2|3|4 0|5
cc-by-nc-sa: licensed under *3 cc by nc sa
cc-by-nc-nd: creativecommons org licenses by nc nd 1|2|3|4 0|5
cc-by-nc-nd: licensed under *3 cc by nc nd
creative-commons: licensed under *2 creative commons license
creative-commons: some rights reserved
odbl: made available under the open database license
odbl: opendatacommons org licenses odbl
odc-by: open data commons attribution license
odc-by: opendatacommons org licenses by
pddl: open data commons public domain dedication and license
ofl: this font software is licensed under the sil open font license
ofl: scripts sil org ofl
ofl: reserved font name
gfdl: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl: with no invariant sections no front cover texts and no back cover texts a copy of the license
gfdl: gnu org licenses fdl
eupl: licensed under the eupl
eupl: licensed under *4 european union public licence|license
ms-pl: microsoft public license ms pl
ms-pl: licensed under *3 microsoft public license
ms-rl: microsoft reciprocal license ms rl
python: psf license agreement for python
python: this license agreement is between the python software foundation
php: this source file is subject to version 3 0|01 of the php license
ruby: released|distributed|licensed under *3 ruby s? license|licence
openssl: this product includes software developed by the openssl project for use in the openssl toolkit
openssl: openssl and? ssleay? license
openssl: redistribution and use *40 openssl toolkit
postgresql: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
postgresql: released|distributed|licensed under *3 postgresql license|licence
x11: except as contained in this notice the name of the x consortium shall not be used
x11: x consortium *4 permission
ncsa: university of illinois ncsa open source license
ncsa: redistributions of source code *10 university of illinois
vim: vim license version? 7?
json: the software shall be used for good not evil
beerware: the beer ware license revision 42
openrail: creativeml open rail m license
openrail: bigscience openrail m license?
openrail: licensed under *4 openrail|openrail_m
sspl: offering the program as a service *40 service source code *10 license
busl: use limitation *20 additional use grant *20 license
busl: change license *10 change date
elastic: licensed under the elastic license
curl: permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided
w3c: permission to copy modify and distribute this software *20 w3c
w3c: w3c software notice and license
cecill: this software is governed by the cecill *4 license
cecill: soumis a? la licence cecill
mulan: you can use this software according to the terms and conditions of the mulan psl
mulan: mulan permissive software license
blueoak: blue oak model license
llama: llama 2|3|4? community license agreement?
gemma: gemma terms of use
public-domain: released into the public domain
public-domain: dedicated to the public domain
public-domain: this work is in the public domain
public-domain: placed in|into the public domain
public-domain: no copyright is claimed
public-domain: creativecommons org publicdomain mark 1 0
proprietary: all rights reserved
proprietary: unauthorized copying of this file
proprietary: proprietary and confidential
proprietary: confidential and proprietary
proprietary: no part of this *6 may be reproduced *12 without *4 permission
proprietary: this software is licensed not sold
proprietary: end user license agreement
proprietary: use of this software is governed by *6 license agreement
proprietary: reverse engineer decompile or disassemble
proprietary: strictly prohibited *8 proprietary
proprietary: trade secret *10 proprietary
"""

MENTIONS = """
mit: mit|expat license|licence|licenses|licensed
apache: apache|asf license|licence|licenses|licensed
apache: apache 2 0 license
gpl: gnu? general public license|licence|licenses
gpl: gpl|gplv2|gplv3 license|licensed|licence
lgpl: gnu? lesser|library general public license|licence
lgpl: lgpl|lgplv2|lgplv3 license|licensed|licence
agpl: gnu? affero general public license|licence
agpl: agpl|agplv3 license|licensed|licence
bsd: bsd|freebsd license|licence|licenses|licensed
isc: isc license|licence
zlib: zlib libpng? license|licence
mpl: mozilla public license|licence
mpl: mpl license|licensed|licence
epl: eclipse public license|licence
cddl: common development and distribution license|licence
cpl: common|ibm public license|licence
bsl: boost software? license|licence
artistic: perl? artistic license|licence
unlicense: the? unlicense
cc0: cc0 license|licence|licensed
cc-by: creative commons attribution
cc-by-sa: creative commons attribution sharealike|share_alike
cc-by-nc: creative commons attribution noncommercial|non_commercial
cc-by-nd: creative commons attribution noderivatives|no_derivatives|noderivs
cc-by-nc-sa: creative commons attribution noncommercial|non_commercial sharealike|share_alike
cc-by-nc-nd: creative commons attribution noncommercial|non_commercial noderivatives|no_derivatives|noderivs
creative-commons: creative commons license|licence|licenses
odbl: open database license|licence
ofl: sil? open font license|licence
gfdl: gnu? free documentation license|licence
eupl: european union public license|licence
ms-pl: microsoft public license|licence
ms-rl: microsoft reciprocal license|licence
python: python software foundation license|licence
python: psf license|licence
php: php license|licence
ruby: ruby license|licence
openssl: openssl|ssleay license|licence
postgresql: postgresql license|licence
x11: x11 license|licence
ncsa: ncsa license|licence
vim: vim license|licence
json: json license|licence
openrail: open responsible ai license|licence|licenses
openrail: openrail license|licence
sspl: server side public license|licence
busl: business source license|licence
elastic: elastic license|licence
upl: universal permissive license|licence
osl: open software license|licence
afl: academic free license|licence
proprietary: proprietary license|licence|software
proprietary: commercial license|licence
"""


def compiled(signature: str) -> tuple[str, list[str], str]:
    """(gate, keys, pattern): a signature as a regular expression over words that each lie between two spaces of their own, the gate that every match has, and
    plain strings of which every match has one: the longest run of words that must be there, or the ways of the alternative that has the longest ones."""
    out, groups, runs = [], [], [[]]
    for token in signature.split():
        if token.startswith("*"):
            out.append("(?: [^ ]+ ){0," + token[1:] + "}")
            runs.append([])
            continue
        optional, token = token.endswith("?"), token.rstrip("?")
        ways = ["".join(f" {w} " for w in way.split("_")) for way in token.split("|")]
        if not optional:
            groups.append(ways)
        if optional or len(ways) > 1:
            out.append("(?:" + "|".join(sorted(ways, key=lambda x: (-len(x), x))) + ")" + ("?" if optional else ""))
            runs.append([])
        else:
            out += ways
            runs[-1] += ways
    gate = next((g for g in GATES if any(all(g in way for way in ways) for ways in groups)), None)
    if gate is None:
        raise ValueError(f"no gate for the signature {signature!r}")
    phrase = max(("".join(r) for r in runs), key=len)
    spread = [ways for ways in groups if len(ways) > 1 and not all("licen" in way for way in ways)]
    keys = [phrase] if phrase and (len(phrase) > 12 or not spread) else min(spread, key=len) if spread else [gate]
    return gate, sorted(keys), "".join(out)


def listed() -> list[tuple[int, str, str]]:
    """(rank, label, signature) of all rules, in order."""
    out = []
    for rank, block in ((1, IDENTIFIERS), (2, TEXTS), (3, MENTIONS)):
        for line in block.strip().splitlines():
            label, signature = line.split(":", 1)
            out.append((rank, label.strip(), signature.strip()))
    return out
