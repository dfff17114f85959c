"""Signature rules of licences, written by hand.

A rule stands on one line: the label it gives, its kind, words of which one is
in all that it matches, and a regular expression over the words of a text.
Words are lower-case runs of letters and digits, one space apart, so
"Apache License, Version 2.0" is read as "apache license version 2 0".  Every
repetition in a rule is bounded.

The kinds, by falling priority: a machine-readable tag, a sentence of the
licence itself, a notice that something is under the licence, its title, its
short name.
"""

from __future__ import annotations

from dataclasses import dataclass

# Kind -> priority and score.
KINDS = {"tag": (5, 1.0), "text": (4, 0.95), "notice": (3, 0.9), "title": (2, 0.8), "name": (1, 0.6)}

# Words of a rule's longest match; a test holds the rules to it.
LONGEST = 40


@dataclass(frozen=True)
class Signature:
    label: str
    kind: str
    words: str
    regex: str

    @property
    def keywords(self) -> tuple[str, ...]:
        return tuple(self.words.split("/"))

    @property
    def priority(self) -> int:
        return KINDS[self.kind][0]

    @property
    def score(self) -> float:
        return KINDS[self.kind][1]

    @property
    def pattern(self) -> str:
        """The expression for words with a space before and one after each, so that it matches whole words only."""
        return f" (?:{self.regex.replace(' ', '  ')}) "


LINES = r"""
mit | tag | spdx | spdx license identifier mit
mit-0 | tag | spdx | spdx license identifier mit 0
apache-1.1 | tag | spdx | spdx license identifier apache 1 1
apache-2.0 | tag | spdx | spdx license identifier apache 2 0
apache-2.0-llvm | tag | spdx | spdx license identifier apache 2 0 with llvm exception
gpl-1.0 | tag | spdx | spdx license identifier gpl 1 0( only| or later)?
gpl-2.0 | tag | spdx | spdx license identifier gpl 2 0( only)?
gpl-2.0-or-later | tag | spdx | spdx license identifier gpl 2 0 or later
gpl-3.0 | tag | spdx | spdx license identifier gpl 3 0( only)?
gpl-3.0-or-later | tag | spdx | spdx license identifier gpl 3 0 or later
lgpl-2.0 | tag | spdx | spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1 | tag | spdx | spdx license identifier lgpl 2 1( only)?
lgpl-2.1-or-later | tag | spdx | spdx license identifier lgpl 2 1 or later
lgpl-3.0 | tag | spdx | spdx license identifier lgpl 3 0( only)?
lgpl-3.0-or-later | tag | spdx | spdx license identifier lgpl 3 0 or later
agpl-3.0 | tag | spdx | spdx license identifier agpl 3 0( only)?
agpl-3.0-or-later | tag | spdx | spdx license identifier agpl 3 0 or later
bsd-1-clause | tag | spdx | spdx license identifier bsd 1 clause
bsd-2-clause | tag | spdx | spdx license identifier bsd 2 clause
bsd-2-clause-patent | tag | spdx | spdx license identifier bsd 2 clause patent
bsd-3-clause | tag | spdx | spdx license identifier bsd 3 clause
bsd-3-clause-clear | tag | spdx | spdx license identifier bsd 3 clause clear
bsd-4-clause | tag | spdx | spdx license identifier bsd 4 clause
0bsd | tag | spdx | spdx license identifier 0bsd
isc | tag | spdx | spdx license identifier isc
mpl-1.1 | tag | spdx | spdx license identifier mpl 1 1
mpl-2.0 | tag | spdx | spdx license identifier mpl 2 0( no copyleft exception)?
epl-1.0 | tag | spdx | spdx license identifier epl 1 0
epl-2.0 | tag | spdx | spdx license identifier epl 2 0
cddl-1.0 | tag | spdx | spdx license identifier cddl 1 0
cddl-1.1 | tag | spdx | spdx license identifier cddl 1 1
eupl-1.1 | tag | spdx | spdx license identifier eupl 1 1
eupl-1.2 | tag | spdx | spdx license identifier eupl 1 2
cc0-1.0 | tag | spdx | spdx license identifier cc0 1 0
cc-by-3.0 | tag | spdx | spdx license identifier cc by 3 0
cc-by-4.0 | tag | spdx | spdx license identifier cc by 4 0
cc-by-sa-3.0 | tag | spdx | spdx license identifier cc by sa 3 0
cc-by-sa-4.0 | tag | spdx | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | tag | spdx | spdx license identifier cc by nc 4 0
cc-by-nd-4.0 | tag | spdx | spdx license identifier cc by nd 4 0
cc-by-nc-sa-4.0 | tag | spdx | spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 | tag | spdx | spdx license identifier cc by nc nd 4 0
bsl-1.0 | tag | spdx | spdx license identifier bsl 1 0
busl-1.1 | tag | spdx | spdx license identifier busl 1 1
unlicense | tag | spdx | spdx license identifier unlicense
wtfpl | tag | spdx | spdx license identifier wtfpl
zlib | tag | spdx | spdx license identifier zlib
artistic-1.0 | tag | spdx | spdx license identifier artistic 1 0( perl)?
artistic-2.0 | tag | spdx | spdx license identifier artistic 2 0
postgresql | tag | spdx | spdx license identifier postgresql
python-2.0 | tag | spdx | spdx license identifier (python|psf) 2 0
openssl | tag | spdx | spdx license identifier openssl
ofl-1.1 | tag | spdx | spdx license identifier ofl 1 1( rfn| no rfn)?
odbl-1.0 | tag | spdx | spdx license identifier odbl 1 0
upl-1.0 | tag | spdx | spdx license identifier upl 1 0
ncsa | tag | spdx | spdx license identifier ncsa
mulanpsl-2.0 | tag | spdx | spdx license identifier mulanpsl 2 0
blueoak-1.0.0 | tag | spdx | spdx license identifier blueoak 1 0 0
ms-pl | tag | spdx | spdx license identifier ms pl
ms-rl | tag | spdx | spdx license identifier ms rl
sspl-1.0 | tag | spdx | spdx license identifier sspl 1 0
elastic-2.0 | tag | spdx | spdx license identifier elastic 2 0
gfdl-1.3 | tag | spdx | spdx license identifier gfdl 1 3( only| or later)?
curl | tag | spdx | spdx license identifier curl
x11 | tag | spdx | spdx license identifier x11
mit | text | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | text | merchantability | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit | text | permission | the above copyright notice and this permission notice( including the next paragraph)? shall be included in all copies
apache-2.0 | text | perpetual | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2.0 | text | reproduction | terms and conditions for use reproduction and distribution 1 definitions
apache-1.1 | text | apache | this product includes software developed by the apache software foundation
apache-1.1 | text | apache | products derived from this software may not be called apache
gpl | text | freedom | the licenses for most software are designed to take away your freedom to share and change it
gpl-3.0 | text | copyleft | the gnu general public license is a free copyleft license for software and other kinds of works
gpl-3.0 | text | convey | to convey a work means any kind of propagation that enables other parties to make or receive copies
gpl | text | warranty | there is no warranty for the program to the extent permitted by applicable law
lgpl-2.1 | text | license/licence | this license the lesser general public license applies to some specially designated software packages
lgpl-3.0 | text | incorporates | this version of the gnu lesser general public license incorporates the terms and conditions of version 3
agpl-3.0 | text | cooperation | specifically designed to ensure cooperation with the community in the case of network server software
agpl-3.0 | text | interacting | your modified version must prominently offer all users interacting with it remotely through a computer network
bsd | text | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | text | redistributions | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | text | redistributions | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | text | endorse | neither the names? of( \S+){1,8} nor the names of (its|any)( \S+){0,2} contributors may be used to endorse or promote products
bsd-3-clause-clear | text | patent | no express or implied licenses to any party s patent rights are granted by this license
bsd-4-clause | text | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
0bsd | text | fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
isc | text | fee | permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted provided that
isc | text | disclaims | the software is provided as is and the author disclaims all warranties with regard to this software
mpl-2.0 | text | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | text | mpl | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | text | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 | text | mozilla | the contents of this file are subject to the mozilla public license version 1 0
epl-1.0 | text | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | text | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license (v )?2 0
epl-2.0 | text | secondary | this source code may also be made available under the following secondary licenses
cddl-1.0 | text | license/licence | the contents of this file are subject to the terms of the common development and distribution license
cpl-1.0 | text | accompanying | the accompanying program is provided under the terms of this common public license
cc0-1.0 | text | waives | affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders
cc-by | text | redistribute | you are free to share copy and redistribute the material in any medium or format
cc-by-sa | text | remix | if you remix transform or build upon the material you must distribute your contributions under the same license
cc-by-nc | text | commercial | you may not use the material for commercial purposes
cc-by-nd | text | distribute | if you remix transform or build upon the material you may not distribute the modified material
bsl-1.0 | text | organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
busl-1.1 | text | licensor | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
unlicense | text | unencumbered | this is free and unencumbered software released into the public domain
unlicense | text | dedicate | the author or authors of this software dedicate any and all copyright interest in the software to the public domain
wtfpl | text | fuck | you just do what the fuck you want to
zlib | text | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | text | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
artistic-1.0 | text | intent | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | text | package | this license establishes the terms under which a given free software package may be copied modified distributed
postgresql | text | agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
python-2.0 | text | psf | psf hereby grants licensee a nonexclusive royalty free world wide license
openssl | text | openssl | this product includes software developed by the openssl project
ofl-1.1 | text | font | the font software may not be sold by itself|neither the font software nor any of its individual components in original or modified versions may be sold by itself
ofl-1.1 | text | license/licence | this font software is licensed under the sil open font license version 1 1
odbl-1.0 | text | database | you are free to share create and adapt this database as long as you attribute
upl-1.0 | text | obtaining | any person obtaining a copy of this software associated documentation and or data collectively the software free of charge
ncsa | text | deal | to deal with the software without restriction including without limitation the rights to use copy modify merge
ms-pl | text | infringed | if you bring a patent claim against any contributor over patents that you claim are infringed by the software
ms-rl | text | reciprocal | reciprocal grants for any file you distribute that contains code from the software
sspl-1.0 | text | functionality | if you make the functionality of the program or a modified version available to third parties as a service
elastic-2.0 | text | hosted | you may not provide the software to third parties as a hosted or managed service
commons-clause | text | sell | the grant of rights under the license will not include and the license does not grant to you the right to sell the software
gfdl | text | invariant | with no invariant sections( with)? no front cover texts and( with)? no back cover texts
gfdl | text | license/licence | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
ijg | text | jpeg | this software is based in part on the work of the independent jpeg group
libpng | text | png | the png reference library is supplied as is
curl | text | daniel | copyright c( \S+){1,4} daniel stenberg( \S+){0,8} all rights reserved permission to use copy modify
json | text | evil | the software shall be used for good not evil
beerware | text | beer | you can buy me a beer in return
icu | text | unicode | unicode data files and software
w3c | text | licensee | by obtaining using and or copying this work you the licensee agree that you have read understood
zpl-2.1 | text | zope | zope public license zpl version 2 1 a copyright notice accompanies this license document
ecl-2.0 | text | license/licence | licensed under the educational community license version 2 0
vim | text | vim | there are no restrictions on distributing unmodified copies of vim
proprietary | text | proprietary | this software is( the)? (confidential and )?proprietary( information)? (of|and confidential)
proprietary | text | unauthorized | unauthorized (copying|reproduction|use|distribution)( \S+){0,12} is strictly prohibited
proprietary | text | reproduced | no part of this( \S+){1,4} may be reproduced( \S+){0,16} without( the)?( prior)?( express)?( written)? permission
mit | notice | license/licence | (licensed|released|distributed|available|published) under( the)?( terms of the)? mit licen[sc]e
mit | notice | license/licence | under the terms of the mit licen[sc]e
apache-2.0 | notice | apache | (licensed|released|distributed|available|published) under( the)?( terms of the)? apache licen[sc]e( version| v)? (2 0|2|v2)
apache-2.0 | notice | apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | notice | apache | http(s)?( www)? apache org licenses license 2 0( txt| html)?
gpl-2.0 | notice | gnu | gnu general public license( as published by the free software foundation)?( either)? version 2( of the license)?
gpl-2.0-or-later | notice | gnu | gnu general public license as published by the free software foundation either version 2 of the license or( at your option)? any later version
gpl-3.0 | notice | gnu | gnu general public license( as published by the free software foundation)?( either)? version 3( of the license)?
gpl-3.0-or-later | notice | gnu | gnu general public license as published by the free software foundation either version 3 of the license or( at your option)? any later version
gpl | notice | gnu | you should have received a copy of the gnu general public license
lgpl | notice | gnu | you should have received a copy of the gnu (lesser|library) general public license
agpl | notice | gnu | you should have received a copy of the gnu affero general public license
lgpl-2.1 | notice | gnu | gnu lesser general public license( as published by the free software foundation)?( either)? version 2 1( of the license)?
lgpl-2.0 | notice | gnu | gnu library general public license( as published by the free software foundation)?( either)? version 2( of the license)?
lgpl-3.0 | notice | gnu | gnu lesser general public license( as published by the free software foundation)?( either)? version 3( of the license)?
agpl-3.0 | notice | affero | gnu affero general public license( as published by the free software foundation)?( either)? version 3( of the license)?
bsd | notice | bsd | (licensed|released|distributed|available|published) under( the| a)?( terms of the)?( new| modified| simplified| revised)? bsd( style)? licen[sc]e
bsd | notice | bsd | use of this source code is governed by a bsd style license that can be found in the license file
isc | notice | isc | (licensed|released|distributed|available) under( the)?( terms of the)? isc licen[sc]e
mpl-2.0 | notice | mozilla | (licensed|released|distributed|available) under( the)?( terms of the)? mozilla public licen[sc]e( version)?( v)? 2 0
mpl-2.0 | notice | mozilla | http(s)?( www)? mozilla org mpl 2 0
epl-2.0 | notice | eclipse | http(s)?( www)? eclipse org legal epl (2 0|v20)( html)?
epl-1.0 | notice | eclipse | http(s)?( www)? eclipse org legal epl v10( html)?
cc-by-4.0 | notice | creativecommons | creativecommons org licenses by 4 0
cc-by-3.0 | notice | creativecommons | creativecommons org licenses by 3 0
cc-by-sa-4.0 | notice | creativecommons | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | notice | creativecommons | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | notice | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | notice | creativecommons | creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0 | notice | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | notice | creativecommons | creativecommons org licenses by nc nd 4 0
cc0-1.0 | notice | creativecommons | creativecommons org publicdomain zero 1 0
public-domain-mark | notice | creativecommons | creativecommons org publicdomain mark 1 0
cc | notice | license/licence | (licensed|released|published|available) under( a| the)?( terms of the)? creative commons( \S+){0,6} licen[sc]e
bsl-1.0 | notice | boost | distributed under the boost software license version 1 0
wtfpl | notice | wtfpl | (licensed|released|distributed) under( the)?( terms of the)? wtfpl
unlicense | notice | unlicense | (licensed|released|distributed) under( the)?( terms of the)? unlicense
unlicense | notice | unlicense | http(s)? unlicense org
zlib | notice | zlib | (licensed|released|distributed) under( the)?( terms of the)? zlib( libpng)? licen[sc]e
artistic | notice | artistic | under the( terms of the)? artistic licen[sc]e
perl | notice | perl | you can redistribute it and or modify it under the same terms as perl( 5)? itself
python-2.0 | notice | license/licence | (licensed|released|distributed) under( the)?( terms of the)? (psf|python software foundation) licen[sc]e
ofl-1.1 | notice | ofl | scripts sil org ofl
gfdl | notice | gnu | gnu org (licenses fdl|copyleft fdl)( html)?
gfdl | notice | gfdl | (licensed|released) under( the)? gfdl
public-domain | notice | domain | (placed|released|dedicated|is|are)( in| into| to)? the public domain
dual | notice | dual | dual licensed under( the)? (mit|apache|gpl|lgpl|bsd|mpl)( \S+){0,4} (and|or)( the)? (mit|apache|gpl|lgpl|bsd|mpl)
all-rights-reserved | notice | reserved | copyright( c)?( \S+){1,12} all rights reserved
mit | title | license/licence | mit licen[sc]e
mit-0 | title | attribution | mit no attribution( licen[sc]e)?
x11 | title | license/licence | x11 licen[sc]e
apache-1.1 | title | apache | apache( software)? licen[sc]e( version)? 1 1
apache-2.0 | title | apache | apache( software)? licen[sc]e( version)?( v)? (2 0|2|v2|v2 0)
apache | title | apache | apache( software)? licen[sc]e
gpl | title | license/licence | (gnu )?general public licen[sc]e
gpl-2.0 | title | license/licence | (gnu )?general public licen[sc]e( version)? (2|v2|2 0)
gpl-3.0 | title | license/licence | (gnu )?general public licen[sc]e( version)? (3|v3|3 0)
lgpl | title | license/licence | (gnu )?(lesser|library) general public licen[sc]e
lgpl-2.1 | title | license/licence | (gnu )?lesser general public licen[sc]e( version)? (2 1|v2 1)
lgpl-3.0 | title | license/licence | (gnu )?lesser general public licen[sc]e( version)? (3|v3|3 0)
agpl | title | affero | (gnu )?affero general public licen[sc]e
agpl-3.0 | title | affero | (gnu )?affero general public licen[sc]e( version)? (3|v3|3 0)
bsd | title | bsd | bsd( style)? licen[sc]e
bsd-2-clause | title | bsd | (2 clause|two clause|simplified|freebsd)( \S+)? bsd( licen[sc]e)?|bsd( licen[sc]e)? (2|two) clause( licen[sc]e)?|simplified bsd licen[sc]e
bsd-3-clause | title | clause | (3|three) clause( \S+)? bsd( licen[sc]e)?|bsd( licen[sc]e)? (3|three) clause( licen[sc]e)?
bsd-4-clause | title | clause | (4|four) clause bsd( licen[sc]e)?|bsd (4|four) clause( licen[sc]e)?
0bsd | title | zero | zero clause bsd( licen[sc]e)?|bsd zero clause licen[sc]e
isc | title | isc | isc licen[sc]e
mpl-2.0 | title | mozilla | mozilla public licen[sc]e( version)?( v)? (2 0|2)
mpl-1.1 | title | mozilla | mozilla public licen[sc]e( version)?( v)? 1 1
mpl | title | mozilla | mozilla public licen[sc]e
epl | title | eclipse | eclipse public licen[sc]e
epl-1.0 | title | eclipse | eclipse public licen[sc]e( version| v)? (1 0|v1 0)
epl-2.0 | title | eclipse | eclipse public licen[sc]e( version| v)? (2 0|v2 0|2)
edl-1.0 | title | eclipse | eclipse distribution licen[sc]e( version| v)? (1 0|v1 0)
cddl | title | license/licence | common development and distribution licen[sc]e
cpl-1.0 | title | license/licence | common public licen[sc]e( version| v)? 1 0
eupl | title | license/licence | european union public licen[sc]e
cc0-1.0 | title | cc0 | cc0( 1 0)?( universal)?( public domain dedication)?
cc-by | title | creative | creative commons attribution( (2 0|2 5|3 0|4 0))?( international| unported)?( public)?( licen[sc]e)?
cc-by-sa | title | creative | creative commons attribution (sharealike|share alike)( (2 0|2 5|3 0|4 0))?( international| unported)?
cc-by-nc | title | creative | creative commons attribution (noncommercial|non commercial)( (2 0|2 5|3 0|4 0))?( international| unported)?
cc-by-nd | title | creative | creative commons attribution (noderivs|noderivatives|no derivatives|no derivative works)( (2 0|2 5|3 0|4 0))?( international| unported)?
cc-by-nc-sa | title | creative | creative commons attribution (noncommercial|non commercial) (sharealike|share alike)( (2 0|2 5|3 0|4 0))?( international| unported)?
cc-by-nc-nd | title | creative | creative commons attribution (noncommercial|non commercial) (noderivs|noderivatives|no derivatives|no derivative works)( (2 0|2 5|3 0|4 0))?
bsl-1.0 | title | boost | boost software licen[sc]e
busl-1.1 | title | license/licence | business source licen[sc]e
wtfpl | title | license/licence | do what the fuck you want to public licen[sc]e
zlib | title | zlib | zlib( libpng)? licen[sc]e
libpng | title | libpng | libpng licen[sc]e
artistic | title | artistic | (perl )?artistic licen[sc]e
artistic-2.0 | title | artistic | artistic licen[sc]e( version)? 2 0
postgresql | title | postgresql | postgresql licen[sc]e
python-2.0 | title | license/licence | python software foundation licen[sc]e|psf licen[sc]e( agreement)?
openssl | title | openssl | openssl licen[sc]e
ssleay | title | ssleay | (original )?ssleay licen[sc]e
ofl-1.1 | title | license/licence | sil open font licen[sc]e
odbl-1.0 | title | license/licence | open (database|data commons open database) licen[sc]e
odc-by-1.0 | title | license/licence | open data commons attribution licen[sc]e
upl-1.0 | title | permissive | universal permissive licen[sc]e
ncsa | title | ncsa | university of illinois ncsa open source licen[sc]e|ncsa open source licen[sc]e
ms-pl | title | license/licence | microsoft public licen[sc]e
ms-rl | title | license/licence | microsoft reciprocal licen[sc]e
sspl-1.0 | title | license/licence | server side public licen[sc]e
elastic | title | license/licence | elastic licen[sc]e( 2 0)?
gfdl | title | license/licence | (gnu )?free documentation licen[sc]e
mulanpsl | title | mulan | mulan (psl|permissive software licen[sc]e)( v2| version 2)?
blueoak | title | license/licence | blue oak model licen[sc]e
beerware | title | license/licence | (beerware|beer ware) licen[sc]e
osl-3.0 | title | license/licence | open software licen[sc]e( version| v)? 3 0
afl-3.0 | title | license/licence | academic free licen[sc]e( version| v)? 3 0
qpl-1.0 | title | license/licence | q public licen[sc]e
nasa-1.3 | title | nasa | nasa open source agreement
apsl-2.0 | title | license/licence | apple public source licen[sc]e
ibm-pl | title | license/licence | ibm public licen[sc]e
npl-1.1 | title | netscape | netscape public licen[sc]e
sun-pl | title | license/licence | sun public licen[sc]e
zpl | title | zope | zope public licen[sc]e
ecl-2.0 | title | license/licence | educational community licen[sc]e
cecill | title | cecill | cecill( b| c)?( free software)? licen[sc]e
hippocratic | title | hippocratic | hippocratic licen[sc]e
openrail | title | openrail/rail | (creativeml )?(openrail|open rail)( m)?( licen[sc]e)?
llama | title | llama | llama( 2| 3)? community licen[sc]e( agreement)?
ruby | title | license/licence | ruby licen[sc]e
php-3.01 | title | license/licence | php licen[sc]e( version)?( 3 0| 3 01)?
vim | title | license/licence | vim licen[sc]e
w3c | title | license/licence | w3c software( notice)?( and)? licen[sc]e
gpl | name | gpl/gplv2/gplv3 | gpl
gpl-2.0 | name | gpl/gplv2/gplv3 | gpl( v| version)? (2|2 0|v2)|gplv2
gpl-3.0 | name | gpl/gplv2/gplv3 | gpl( v| version)? (3|3 0|v3)|gplv3
lgpl | name | lgpl/lgplv2/lgplv3 | lgpl
lgpl-2.1 | name | lgpl/lgplv2/lgplv3 | lgpl( v| version)? (2 1|v2 1)|lgplv2 1|lgplv2
lgpl-3.0 | name | lgpl/lgplv2/lgplv3 | lgpl( v| version)? (3|3 0|v3)|lgplv3
agpl | name | agpl/agplv3 | agpl
agpl-3.0 | name | agpl/agplv3 | agpl( v| version)? (3|3 0|v3)|agplv3
apache-2.0 | name | apache/apache2 | apache( v)? (2 0|2|v2)|apache2
bsd-3-clause | name | bsd/bsd2/bsd3 | bsd 3 clause|bsd3
bsd-2-clause | name | bsd/bsd2/bsd3 | bsd 2 clause|bsd2
mpl-2.0 | name | mpl/mplv2 | mpl 2 0|mplv2
cc-by-sa | name | cc | cc by sa( (2 0|2 5|3 0|4 0))?
cc-by-nc | name | cc | cc by nc( (2 0|2 5|3 0|4 0))?
cc-by-nc-sa | name | cc | cc by nc sa( (2 0|2 5|3 0|4 0))?
cc-by | name | cc | cc by( (2 0|2 5|3 0|4 0))
copyleft | name | copyleft | copyleft
fair-use | name | fair | fair use
open-source | name | license/licence | (open source|free software) licen[sc]e
public-domain | name | domain | public domain
"""


def _read(lines: str) -> tuple[Signature, ...]:
    return tuple(Signature(*line.split(" | ")) for line in lines.strip().split("\n"))


SIGNATURES = _read(LINES)
