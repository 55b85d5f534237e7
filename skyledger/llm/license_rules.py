"""Ordered signature rules of licences over normalised words.

A normalised text is its words (letters and digits, A-Z lower-cased) with one space
between them, so a version "2.0" reads "2 0" and an address "opensource.org/licenses/MIT"
reads "opensource org licenses mit". Every pattern begins and ends at a word.

LICENCES names each licence once: label, the words of which one occurs in every match
(the keyword prefilter), its name, its SPDX identifier and the words of its address.
From each come rules of five kinds (tag, notice, address, grant, name); SIGNATURES are
sentences of licence texts and WEAK are hints. RULES is in order of priority: kinds in
the order of KINDS, then as listed; of two licences the more specific one comes first.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    kind: str
    keywords: frozenset
    pattern: re.Pattern
    confidence: float


#: kinds in order of priority, with the confidence of a match
KINDS = {"tag": 1.0, "signature": 0.95, "notice": 0.9, "address": 0.85, "grant": 0.8, "name": 0.6, "weak": 0.3}

_V = r"(?:version |v |v)?"        # "version 2", "v 2", "v2", "2"
_L = r"(?:software )?licen[sc]e"
_GPL = r"(?:gnu )?general public licen[sc]e"
_CC = r"(?:creative commons|cc) "
_NC, _ND, _SA = r"(?:nc|non ?commercial)", r"(?:nd|no ?deriv(?:s|atives|ative works)?)", r"(?:sa|share ?alike)"
_BY = r"(?:by|attribution)"

# label | keywords | name | SPDX identifier | address (empty: none)
LICENCES = [row.split(" | ") for row in f"""
apache-2 | apache | apache {_L} {_V}2(?: 0)?|apache {_V}2(?: 0)? {_L}|apache 2(?: 0)? | apache 2 0 | apache org licenses license 2 0
apache-1.1 | apache | apache {_L} {_V}1 1 | apache 1 1 | apache org licenses license 1 1
apache-1 | apache | apache {_L} {_V}1(?: 0)? | apache 1 0 | apache org licenses license 1 0
mit-0 | mit | mit (?:no attribution|0) {_L}|mit no attribution | mit 0 | github com aws mit 0
mit | mit expat | (?:mit|expat)(?: x11)?(?: style)? {_L} | mit | opensource org licenses? mit
x11 | x11 | x11 {_L}|mit x11 {_L} | x11 | x org docs xfree86
isc | isc | isc {_L} | isc | opensource org licenses? isc
zlib | zlib libpng | (?:zlib|libpng|zlib libpng) {_L} | zlib | zlib net zlib license
0bsd | 0bsd bsd | (?:zero clause bsd|0bsd|bsd zero clause|bsd 0 clause) {_L} | 0bsd | opensource org licenses? 0bsd
bsd-2-clause | bsd freebsd | (?:simplified|2 clause|two clause) bsd {_L}|freebsd {_L}|bsd 2 clause(?: {_L})?|bsd two clause(?: {_L})? | bsd 2 clause | opensource org licenses? bsd 2 clause
bsd-3-clause | bsd | (?:new|modified|revised|3 clause|three clause) bsd {_L}|bsd 3 clause(?: {_L})?|bsd three clause(?: {_L})? | bsd 3 clause | opensource org licenses? bsd 3 clause
bsd-4-clause | bsd | (?:original|4 clause|four clause) bsd {_L}|bsd 4 clause(?: {_L})? | bsd 4 clause | directory fsf org wiki license bsd 4clause
bsd | bsd | bsd(?: style| type)? {_L} | bsd | opensource org licenses? bsd license
agpl-3 | agpl agplv3 agpl3 affero | (?:gnu )?affero general public licen[sc]e {_V}3(?: 0)?|(?:gnu )?agpl ?{_V}3(?: 0)? | agpl 3 0(?: only| or later)? | gnu org licenses agpl 3 0
agpl-1 | agpl agplv1 agpl1 affero | affero general public licen[sc]e {_V}1(?: 0)?|agpl ?{_V}1(?: 0)? | agpl 1 0(?: only| or later)? | affero org oagpl
agpl | agpl affero | (?:gnu )?affero general public licen[sc]e|(?:gnu )?agpl | agpl | gnu org licenses agpl
lgpl-2.1 | lgpl lgplv2 lgpl2 lesser library | (?:gnu )?(?:lesser|library) general public licen[sc]e {_V}2 1|(?:gnu )?lgpl ?{_V}2 1 | lgpl 2 1(?: only| or later)? | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-2 | lgpl lgplv2 lgpl2 lesser library | (?:gnu )?(?:lesser|library) general public licen[sc]e {_V}2(?: 0)?|(?:gnu )?lgpl ?{_V}2(?: 0)? | lgpl 2 0(?: only| or later)? | gnu org licenses (?:old licenses )?lgpl 2 0
lgpl-3 | lgpl lgplv3 lgpl3 lesser | (?:gnu )?lesser general public licen[sc]e {_V}3(?: 0)?|(?:gnu )?lgpl ?{_V}3(?: 0)? | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl 3 0
lgpl | lgpl lesser library | (?:gnu )?(?:lesser|library) general public licen[sc]e|(?:gnu )?lgpl | lgpl | gnu org licenses lgpl
gpl-1 | gpl gplv1 gpl1 general | {_GPL} {_V}1(?: 0)?|(?:gnu )?gpl ?{_V}1(?: 0)? | gpl 1 0(?: only| or later)? | gnu org licenses (?:old licenses )?gpl 1 0
gpl-2 | gpl gplv2 gpl2 general | {_GPL} {_V}2(?: 0)?|(?:gnu )?gpl ?{_V}2(?: 0)? | gpl 2 0(?: only| or later)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3 | gpl gplv3 gpl3 general | {_GPL} {_V}3(?: 0)?|(?:gnu )?gpl ?{_V}3(?: 0)? | gpl 3 0(?: only| or later)? | gnu org licenses gpl 3 0
gpl | gpl general | {_GPL}|gnu gpl|gpl {_L} | gpl | gnu org (?:copyleft|licenses) gpl
gfdl-1.3 | gfdl documentation | (?:gnu )?free documentation licen[sc]e {_V}1 3|(?:gnu )?gfdl {_V}1 3 | gfdl 1 3(?: only| or later)? | gnu org licenses fdl 1 3
gfdl-1.2 | gfdl documentation | (?:gnu )?free documentation licen[sc]e {_V}1 2|(?:gnu )?gfdl {_V}1 2 | gfdl 1 2(?: only| or later)? | gnu org licenses (?:old licenses )?fdl 1 2
gfdl-1.1 | gfdl documentation | (?:gnu )?free documentation licen[sc]e {_V}1 1|(?:gnu )?gfdl {_V}1 1 | gfdl 1 1(?: only| or later)? | gnu org licenses (?:old licenses )?fdl 1 1
gfdl | gfdl documentation | (?:gnu )?free documentation licen[sc]e|(?:gnu )?gfdl | gfdl | gnu org (?:copyleft|licenses) fdl
mpl-2 | mpl mplv2 mpl2 mozilla | mozilla public licen[sc]e {_V}2(?: 0)?|mpl ?{_V}2(?: 0)? | mpl 2 0 | mozilla org (?:en us )?mpl 2 0
mpl-1.1 | mpl mozilla | mozilla public licen[sc]e {_V}1 1|mpl {_V}1 1 | mpl 1 1 | mozilla org (?:en us )?mpl 1 1
mpl-1 | mpl mozilla | mozilla public licen[sc]e {_V}1(?: 0)?|mpl {_V}1(?: 0)? | mpl 1 0 | mozilla org (?:en us )?mpl 1 0
mpl | mozilla | mozilla public licen[sc]e | mpl | mozilla org (?:en us )?mpl
epl-2 | epl eclipse | eclipse public licen[sc]e {_V}2(?: 0)?|epl {_V}2(?: 0)? | epl 2 0 | eclipse org legal epl 2 0
epl-1 | epl eclipse | eclipse public licen[sc]e {_V}1(?: 0)?|epl {_V}1(?: 0)? | epl 1 0 | eclipse org legal epl v10
edl-1 | eclipse | eclipse distribution licen[sc]e(?: {_V}1(?: 0)?)? | edl 1 0 | eclipse org org documents edl v10
epl | eclipse | eclipse public licen[sc]e | epl | eclipse org legal epl
cddl-1.1 | cddl development | common development and distribution licen[sc]e {_V}1 1|cddl {_V}1 1 | cddl 1 1 | glassfish java net public cddl gpl 1 1
cddl-1 | cddl development | common development and distribution licen[sc]e(?: {_V}1(?: 0)?)?|cddl(?: {_V}1(?: 0)?)? | cddl 1 0 | opensource org licenses? cddl1
cpl-1 | cpl common | common public licen[sc]e(?: {_V}1(?: 0)?)? | cpl 1 0 | opensource org licenses? cpl1
cpal-1 | cpal attribution | common public attribution licen[sc]e(?: {_V}1(?: 0)?)?|cpal 1 0 | cpal 1 0 | opensource org licenses? cpal
ipl-1 | ibm | ibm public licen[sc]e(?: {_V}1(?: 0)?)? | ipl 1 0 | opensource org licenses? ibmpl
eupl-1.2 | eupl european | european union public licen[sc]e {_V}1 2|eupl {_V}1 2 | eupl 1 2 | joinup ec europa eu collection eupl eupl text eupl 12
eupl-1.1 | eupl european | european union public licen[sc]e {_V}1 1|eupl {_V}1 1 | eupl 1 1 | joinup ec europa eu software page eupl
eupl | eupl european | european union public licen[sc]e|eupl | eupl | joinup ec europa eu collection eupl
cecill-b | cecill | cecill b(?: {_L})? | cecill b | cecill info licences licence cecill b
cecill-c | cecill | cecill c(?: {_L})? | cecill c | cecill info licences licence cecill c
cecill | cecill | cecill(?: {_L})?(?: {_V}[12](?: [01])?)? | cecill 2 [01] | cecill info licences
cc-by-nc-sa | cc creative | {_CC}{_BY} {_NC} {_SA}(?: [1-4] [05])? | cc by nc sa [1-4] [05] | creativecommons org licenses by nc sa
cc-by-nc-nd | cc creative | {_CC}{_BY} {_NC} {_ND}(?: [1-4] [05])? | cc by nc nd [1-4] [05] | creativecommons org licenses by nc nd
cc-by-nc | cc creative | {_CC}{_BY} {_NC}(?: [1-4] [05])? | cc by nc [1-4] [05] | creativecommons org licenses by nc
cc-by-sa | cc creative | {_CC}{_BY} {_SA}(?: [1-4] [05])? | cc by sa [1-4] [05] | creativecommons org licenses by sa
cc-by-nd | cc creative | {_CC}{_BY} {_ND}(?: [1-4] [05])? | cc by nd [1-4] [05] | creativecommons org licenses by nd
cc-by | cc creative | {_CC}{_BY}(?: [1-4] [05])? | cc by [1-4] [05] | creativecommons org licenses by
cc0 | cc0 cc creative | (?:cc0|cc 0|cc zero|creative commons zero)(?: 1 0)?(?: universal)? | cc0 1 0 | creativecommons org publicdomain zero
cc-pdm | creative | creative commons public domain mark | cc pdm 1 0 | creativecommons org publicdomain mark
odbl | odbl database | open (?:data commons )?(?:open )?database licen[sc]e|odbl(?: 1 0)? | odbl 1 0 | opendatacommons org licenses odbl
odc-by | odc opendata commons | open data commons attribution licen[sc]e|odc by(?: 1 0)? | odc by 1 0 | opendatacommons org licenses by
pddl | pddl commons | open data commons public domain dedication(?: and {_L})?|pddl(?: 1 0)? | pddl 1 0 | opendatacommons org licenses pddl
cdla-permissive | cdla community | community data licen[sc]e agreement permissive(?: {_V}[12] 0)?|cdla permissive | cdla permissive [12] 0 | cdla dev permissive
cdla-sharing | cdla community | community data licen[sc]e agreement sharing(?: {_V}1 0)?|cdla sharing | cdla sharing 1 0 | cdla dev sharing
unlicense | unlicense | (?:the )?unlicense | unlicense | unlicense org
wtfpl | wtfpl wtf | (?:do what the fuck you want to|wtf) public licen[sc]e|wtfpl | wtfpl | wtfpl net
bsl-1 | boost | boost {_L}(?: {_V}1(?: 0)?)? | bsl 1 0 | boost org license 1 0
busl-1.1 | busl business | business source licen[sc]e(?: {_V}1 1)?|busl 1 1 | busl 1 1 | mariadb com bsl11
sspl-1 | sspl server | server side public licen[sc]e(?: {_V}1(?: 0)?)?|sspl(?: {_V}1)? | sspl 1 0 | mongodb com licensing server side public license
elastic-2 | elastic | elastic licen[sc]e(?: {_V}2(?: 0)?)? | elastic 2 0 | elastic co licensing elastic license
commons-clause | clause | commons clause(?: licen[sc]e condition)? | commons clause | commonsclause com
artistic-2 | artistic | (?:perl )?artistic licen[sc]e {_V}2(?: 0)? | artistic 2 0 | opensource org licenses? artistic license 2 0
artistic-1 | artistic | (?:perl )?artistic licen[sc]e(?: {_V}1(?: 0)?)? | artistic 1 0 | opensource org licenses? artistic license 1 0
psf-2 | python psf | python software foundation licen[sc]e(?: {_V}2)?|psf licen[sc]e|python licen[sc]e | psf 2 0 | python org psf license
php-3 | php | php licen[sc]e(?: {_V}3(?: 0[01])?)? | php 3 0[01]? | php net license 3 0
ruby | ruby | ruby (?:s )?licen[sc]e | ruby | ruby lang org en about license
postgresql | postgresql | postgresql licen[sc]e | postgresql | postgresql org about licence
openssl | openssl | openssl licen[sc]e | openssl | openssl org source license
curl | curl | curl licen[sc]e | curl | curl se docs copyright
ncsa | ncsa illinois | (?:university of illinois )?ncsa open source licen[sc]e|university of illinois open source licen[sc]e | ncsa | otm illinois edu uiuc openSource
w3c | w3c | w3c software (?:notice and )?licen[sc]e|w3c licen[sc]e | w3c | w3 org consortium legal copyright software
ofl-1.1 | ofl sil | sil open font licen[sc]e(?: {_V}1 [01])?|ofl(?: {_V}1 [01])? | ofl 1 [01] | scripts sil org ofl
upl-1 | upl universal | universal permissive licen[sc]e(?: {_V}1(?: 0)?)?|upl 1 0 | upl 1 0 | oss oracle com licenses upl
osl-3 | osl software | open software licen[sc]e(?: {_V}3(?: 0)?)?|osl 3 0 | osl 3 0 | opensource org licenses? osl 3 0
afl-3 | afl academic | academic free licen[sc]e(?: {_V}[23](?: [01])?)?|afl 3 0 | afl [23] [01] | opensource org licenses? afl 3 0
ms-pl | microsoft ms | microsoft public licen[sc]e|ms pl licen[sc]e | ms pl | opensource org licenses? ms pl
ms-rl | microsoft ms | microsoft reciprocal licen[sc]e|ms rl licen[sc]e | ms rl | opensource org licenses? ms rl
ecl-2 | ecl educational | educational community licen[sc]e(?: {_V}2(?: 0)?)? | ecl 2 0 | opensource org licenses? ecl 2 0
lppl | lppl latex | latex project public licen[sc]e(?: {_V}1 [0-3]c?)?|lppl(?: {_V}1 [0-3]c?)? | lppl 1 [0-3][ac]? | latex project org lppl
vim | vim | vim licen[sc]e | vim | vimhelp org uganda
beerware | beerware beer | beer ?ware licen[sc]e | beerware | people freebsd org phk
json | json | json licen[sc]e | json | json org license
apsl-2 | apsl apple | apple public source licen[sc]e(?: {_V}[12](?: [012])?)? | apsl [12] [012] | opensource apple com apsl
sleepycat | sleepycat | sleepycat (?:public )?licen[sc]e | sleepycat | opensource org licenses? sleepycat
qpl-1 | qpl q | q public licen[sc]e(?: {_V}1(?: 0)?)? | qpl 1 0 | doc qt nokia com 3 3 license
zpl-2 | zpl zope | zope public licen[sc]e(?: {_V}2(?: [01])?)? | zpl 2 [01] | zope org resources zpl
hpnd | hpnd historical | historical permission notice and disclaimer | hpnd | opensource org licenses? hpnd
tcl | tcl | tcl tk licen[sc]e|tcl licen[sc]e | tcl | tcl tk software tcltk license
nposl-3 | nposl profit | non profit open software licen[sc]e(?: {_V}3(?: 0)?)? | nposl 3 0 | opensource org licenses? nposl 3 0
rpl-1.5 | rpl reciprocal | reciprocal public licen[sc]e(?: {_V}1 [15])? | rpl 1 [15] | opensource org licenses? rpl 1 5
blueoak-1 | blueoak oak | blue oak model licen[sc]e(?: {_V}?1 0 0)? | blueoak 1 0 0 | blueoakcouncil org license 1 0 0
mulan-psl-2 | mulan | mulan permissive software licen[sc]e(?: {_V}2)?|mulan psl v?2 | mulanpsl 2 0 | license coscl org cn mulanpsl2
unicode | unicode | unicode (?:inc )?licen[sc]e agreement|unicode licen[sc]e | unicode (?:dfs 2016|3 0) | unicode org copyright
openrail | openrail rail | (?:bigscience |creativeml )?open ?rail(?: [msda])?(?: licen[sc]e)? | openrail | huggingface co spaces bigscience license
llama | llama | llama [234](?: [123])? community licen[sc]e(?: agreement)? | llama [234] | ai meta com llama license
ogl-uk | ogl government | open government licen[sc]e(?: {_V}[123](?: 0)?)? | ogl uk [123] 0 | nationalarchives gov uk doc open government licence
etalab-2 | etalab ouverte | licence ouverte(?: open licence)?(?: etalab)?(?: {_V}2(?: 0)?)?|etalab licen[sc]e | etalab 2 0 | etalab gouv fr licence ouverte
dl-de-by | datenlizenz | datenlizenz deutschland(?: namensnennung)?(?: {_V}2(?: 0)?)? | dl de by 2 0 | govdata de dl de by 2 0
public-domain | domain gemeinfrei | (?:released|placed|dedicated|given) (?:in|into|to) the public domain|public domain dedication|gemeinfrei | public domain | creativecommons org licenses publicdomain
""".strip().split("\n")]

# label | keywords | sentence of the licence text
SIGNATURES = [row.split(" | ") for row in """
mit | granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | substantial | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
isc | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd | purpose | permission to use copy modify and distribute this software and its documentation for any purpose
bsd-3-clause | endorse | neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
apache-2 | apache | you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2 | basis | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
zlib | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
gpl | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license
lgpl | redistribute | you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
agpl | redistribute | you can redistribute it and or modify it under the terms of the gnu affero general public license
gpl-3 | general | under the terms of the gnu general public license as published by the free software foundation either version 3
gpl-2 | general | under the terms of the gnu general public license as published by the free software foundation either version 2
mpl-2 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | fuck | you just do what the fuck you want to
bsl-1 | boost | distributed under the boost software license version 1 0
cc0 | waived | has waived all copyright and related or neighboring rights
cc-by | attribution | this work is licensed under (?:a|the) creative commons attribution [1-4] [05]
ofl-1.1 | font | this font software is licensed under the sil open font license version 1 1
gfdl | document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
beerware | beer | you can buy me a beer in return
json | evil | the software shall be used for good not evil
artistic-2 | package | this package is free software you can redistribute it and or modify it under the terms of the artistic license
epl-2 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0
sspl-1 | service | make the service source code available via network download to everyone at no charge
unicode | unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
""".strip().split("\n")]

# label | keywords | hint
WEAK = [row.split(" | ") for row in """
proprietary | reserved | all rights reserved
proprietary | vorbehalten | alle rechte vorbehalten
proprietary | réservés | tous droits réservés
proprietary | reservados | todos los derechos reservados
proprietary | proprietary | proprietary and confidential
proprietary | redistribute distribute | do not (?:copy or )?(?:re)?distribute without (?:written )?permission
proprietary | consent | without the prior written consent of the (?:author|owner|publisher|copyright holder)
open-source | open | open source licen[sc]e
copyleft | copyleft | copyleft
apache | apache | apache licen[sc]e
creative-commons | creative | creative commons(?: licen[sc]e)?
gpl | gpl gplv2 gplv3 | gpl(?:v[23])?
""".strip().split("\n")]

_GRANT = (r"(?:licen[sc]ed|released|distributed|redistributed|available|published|provided|offered|shared|covered|governed|lizenziert|veröffentlicht) "
          r"(?:under|by|with|to|unter) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an |der )?")


def _rule(label: str, kind: str, keywords: str, pattern: str) -> Rule:
    return Rule(label, kind, frozenset(keywords.split()), re.compile(f"(?<= )(?:{pattern})(?= )"), KINDS[kind])


def build() -> list[Rule]:
    """All rules in order of priority."""
    rules = {kind: [] for kind in KINDS}
    for label, keywords, name, spdx, address in LICENCES:
        rules["tag"].append(_rule(label, "tag", "spdx", f"spdx license identifier {spdx.lower()}"))
        rules["notice"].append(_rule(label, "notice", keywords, f"(?:this|the) (?:work|software|file|document|package|project|program|text|dataset) is {_GRANT}(?:{name})"))
        rules["address"].append(_rule(label, "address", address.split(" ")[0], address.lower()))
        rules["grant"].append(_rule(label, "grant", keywords, f"{_GRANT}(?:{name})"))
        rules["name"].append(_rule(label, "name", keywords, name))
    rules["signature"] = [_rule(label, "signature", keywords, text) for label, keywords, text in SIGNATURES]
    rules["weak"] = [_rule(label, "weak", keywords, text) for label, keywords, text in WEAK]
    return [rule for kind in KINDS for rule in rules[kind]]


RULES = build()
