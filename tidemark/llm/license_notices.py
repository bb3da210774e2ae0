"""Hand-written license signatures, by license: notices, headers, clauses and tags.

Each is priority, confidence, the words of which every match holds one (joined by |), and a regex over
lower-cased words joined by single spaces. Longer and more telling texts have a higher priority, so
that they stand against the shorter ones that they contain.
"""

from __future__ import annotations

NOTICES: dict[str, tuple[tuple[float, float, str, str], ...]] = {
    "mit": (
        (3, 0.9, "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
        (5, 0.97, "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        (3, 0.9, "sublicense", r"without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
        (3, 0.85, "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
        (3, 0.85, "noninfringement", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
        (3, 0.85, "tort", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
        (4, 0.95, "opensource", r"opensource org licenses mit(?: license)?(?: php| html)?"),
    ),
    "x11": ((5, 0.95, "consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),),
    "mit-0": ((4, 0.95, "mit", r"mit no attribution"), (4, 0.95, "mit", r"mit 0")),
    "bsd": (
        (3, 0.9, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
        (3, 0.85, "redistributions", r"redistributions of source code must retain the above copyright notice"),
        (3, 0.85, "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
        (3, 0.85, "exemplary", r"be liable for any direct indirect incidental special exemplary or consequential damages"),
        (4, 0.9, "regents", r"copyright (?:c )?(?:[0-9]+ )+the regents of the university of california"),
    ),
    "bsd-3-clause": (
        (5, 0.95, "endorse", r"neither the name of the (?:copyright holder|author|company|university|organization|project) nor the names of its contributors may be used to endorse or promote products"),
        (5, 0.95, "endorse", r"(?:the )?names? of the (?:author|copyright holder|contributors) may not be used to endorse or promote products derived from this software"),
        (4, 0.95, "opensource", r"opensource org licenses bsd 3 clause"),
    ),
    "bsd-4-clause": ((5, 0.95, "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),),
    "bsd-2-clause": ((4, 0.95, "opensource", r"opensource org licenses bsd 2 clause"),),
    "0bsd": ((4, 0.95, "0bsd", r"(?:the )?0bsd(?: licen[cs]e)?"), (4, 0.9, "bsd", r"(?:bsd zero clause|zero clause bsd)(?: licen[cs]e)?")),
    "isc": (
        (3, 0.9, "fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
        (4, 0.95, "opensource", r"opensource org licenses isc"),
    ),
    "apache-2": (
        (5, 0.97, "apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
        (3, 0.9, "compliance", r"you may not use this file except in compliance with the license"),
        (3, 0.9, "basis", r"software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
        (4, 0.95, "apache", r"apache org licenses license 2 0(?: txt| html)?"),
        (3, 0.85, "apache", r"to apply the apache license to your work"),
        (3, 0.85, "governing", r"see the license for the specific language governing permissions and limitations"),
        (3, 0.85, "licensor", r"licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the license"),
        (3, 0.85, "perpetual", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent|except as stated in this section patent) license"),
    ),
    "apache-1.1": ((4, 0.9, "apache", r"this product includes software developed by the apache software foundation"),),
    "gpl": (
        (3, 0.9, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
        (3, 0.85, "gnu", r"you should have received a copy of the gnu general public license"),
        (3, 0.85, "gnu", r"see the gnu general public license for more details"),
        (3, 0.8, "program", r"this program is free software you can redistribute it"),
        (3, 0.8, "hope", r"(?:is )?distributed in the hope that it will be useful but without any warranty"),
        (3, 0.8, "copyleft", r"copyleft (?:license|software|notice)"),
        (3, 0.9, "gnu", r"gnu org licenses(?: gpl(?: html| txt)?)?"),
        (3, 0.6, "franklin", r"free software foundation inc 51 franklin (?:st|street) fifth floor boston"),
        (3, 0.6, "temple", r"free software foundation inc 59 temple place suite 330 boston"),
        (3, 0.85, "restrictions", r"you may not impose any further restrictions on the exercise of the rights granted or affirmed under this license"),
    ),
    "gpl-2": (
        (5, 0.95, "version", r"under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2(?: of the license)?"),
        (4, 0.95, "gnu", r"gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?"),
    ),
    "gpl-3": (
        (5, 0.95, "version", r"under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3(?: of the license)?"),
        (4, 0.95, "gnu", r"gnu org licenses gpl 3 0(?: html| txt)?"),
    ),
    "lgpl": (
        (5, 0.95, "lesser", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
        (5, 0.95, "library", r"you can redistribute it and or modify it under the terms of the gnu library general public licen[cs]e"),
        (4, 0.9, "lesser", r"see the gnu lesser general public license for more details"),
        (4, 0.95, "gnu", r"gnu org licenses lgpl(?: html| txt| [23] [01](?: html)?)?"),
        (3, 0.85, "library", r"this library is free software you can redistribute it"),
    ),
    "agpl": (
        (5, 0.95, "affero", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
        (4, 0.9, "affero", r"see the gnu affero general public license for more details"),
        (4, 0.95, "gnu", r"gnu org licenses agpl(?: html| txt| 3 0(?: html)?)?"),
        (3, 0.85, "interacting", r"offer all users interacting with it remotely through a computer network an opportunity to receive the corresponding source"),
    ),
    "gfdl": (
        (5, 0.95, "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
        (3, 0.9, "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ),
    "mpl-2": (
        (5, 0.97, "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
        (4, 0.95, "mozilla", r"mozilla org mpl 2 0"),
        (3, 0.85, "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one"),
    ),
    "mpl-1.1": ((5, 0.95, "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),),
    "epl": (
        (5, 0.95, "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
        (4, 0.95, "eclipse", r"eclipse org (?:legal|org documents) epl v ?[12]0(?: html)?"),
    ),
    "cddl": (
        (5, 0.95, "distribution", r"the contents of this file are subject to the terms of the common development and distribution license"),
        (3, 0.85, "cddl", r"when distributing covered code include this cddl header in each file"),
    ),
    "eupl": ((5, 0.95, "eupl", r"licensed under the eupl version 1 [012] or as soon they will be approved by the european commission"),),
    "cpl": ((5, 0.95, "common", r"this program and the accompanying materials are made available under the terms of the common public license"),),
    "boost": (
        (5, 0.97, "boost", r"distributed under the boost software license version 1 0"),
        (4, 0.95, "boost", r"boost org license 1 0 txt"),
    ),
    "zlib": (
        (3, 0.9, "altered", r"altered source versions must be plainly marked as such"),
        (3, 0.9, "misrepresented", r"the origin of this software must not be misrepresented"),
        (3, 0.85, "express", r"this software is provided as is without any express or implied warranty"),
    ),
    "artistic": ((4, 0.9, "perl", r"(?:you can redistribute it and or modify it )?under the same terms as perl(?: itself)?"), (3, 0.85, "package", r"you may make and give away verbatim copies of the source form of the standard version of this package")),
    "psf": ((4, 0.95, "python", r"this is the official license for the python programming language"), (4, 0.9, "psf", r"psf license agreement(?: for python [0-9 ]+)?"), (4, 0.9, "python", r"python software foundation license version [0-9]+")),
    "openssl": ((4, 0.95, "openssl", r"this product includes software developed by the openssl project"), (3, 0.9, "openssl", r"openssl license"), (4, 0.95, "ssleay", r"original ssleay license")),
    "curl": ((3, 0.9, "curl", r"(?:the )?curl license"),),
    "ncsa": ((4, 0.95, "ncsa", r"(?:university of illinois )?ncsa open source license"),),
    "unicode": ((4, 0.95, "unicode", r"unicode license agreement data files and software"), (3, 0.9, "unicode", r"unicode (?:license|terms of use)")),
    "ofl": ((5, 0.95, "font", r"this font software is licensed under the sil open font license"), (3, 0.85, "reserved", r"with reserved font name")),
    "unlicense": (
        (5, 0.97, "unencumbered", r"this is free and unencumbered software released into the public domain"),
        (4, 0.95, "unlicense", r"(?:for more information please refer to )?(?:http |https )?unlicense org"),
    ),
    "wtfpl": ((4, 0.95, "wtfpl", r"wtfpl net"), (4, 0.95, "fuck", r"you just do what the fuck you want to")),
    "beerware": ((4, 0.95, "beerware|beer", r"(?:the )?beer ?ware license(?: revision 42)?"), (3, 0.9, "beer", r"you can buy me a beer in return")),
    "cc0": (
        (3, 0.95, "cc0", r"(?:creative commons )?cc0(?: 1(?: 0)?)?(?: universal)?"),
        (4, 0.95, "waived", r"has waived all copyright and related or neighboring rights"),
        (4, 0.95, "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ),
    "cc-by": (
        (4, 0.95, "creativecommons", r"creativecommons org licenses by [1-4] [05]"),
        (3, 0.85, "creative", r"creative commons attribution licen[cs]e"),
    ),
    "cc-by-sa": (
        (4, 0.95, "creativecommons", r"creativecommons org licenses by sa [1-4] [05]"),
        (4, 0.9, "wikipedia|creative", r"text is available under the creative commons attribution share ?alike license additional terms may apply|wikipedia text under cc by sa"),
    ),
    "cc-by-nc": ((4, 0.95, "creativecommons", r"creativecommons org licenses by nc [1-4] [05]"), (3, 0.8, "noncommercial", r"for noncommercial (?:use|purposes) only")),
    "cc-by-nd": ((4, 0.95, "creativecommons", r"creativecommons org licenses by nd [1-4] [05]"),),
    "cc-by-nc-sa": ((4, 0.95, "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]"),),
    "cc-by-nc-nd": ((4, 0.95, "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]"),),
    "odbl": ((4, 0.95, "opendatacommons", r"opendatacommons org licenses odbl(?: 1 0)?"), (4, 0.9, "openstreetmap", r"(?:c )?openstreetmap contributors")),
    "odc-by": ((4, 0.95, "attribution", r"open data commons attribution license"), (4, 0.95, "opendatacommons", r"opendatacommons org licenses by(?: 1 0)?")),
    "pddl": ((4, 0.95, "dedication", r"(?:odc )?(?:open data commons )?public domain dedication and licen[cs]e"),),
    "public-domain": (
        (2, 0.7, "domain", r"(?:dedicated to|placed in|released into) the public domain"),
        (3, 0.8, "domain", r"this (?:work|file|code|software) is in the public domain"),
        (3, 0.8, "government", r"a work of the (?:united states|u s|us) government"),
    ),
    "sspl": ((4, 0.95, "sspl", r"sspl(?: v ?1| 1 0)?"), (4, 0.95, "server", r"server side public license(?: version 1| v1)?")),
    "busl": ((4, 0.95, "business", r"business source license(?: 1 1| version 1 1)?"), (4, 0.95, "busl", r"busl 1 1")),
    "elastic": ((4, 0.95, "elastic", r"elastic license(?: 2 0| v2| version 2)?"),),
    "commons-clause": ((4, 0.95, "clause", r"commons clause(?: license condition(?: v1 0)?)?"),),
    "llama": ((4, 0.95, "llama", r"(?:meta )?llama [234](?: [0-9])? community license(?: agreement)?"),),
    "openrail": ((4, 0.95, "openrail", r"(?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?"), (4, 0.9, "responsible", r"responsible ai licen[cs]e")),
    "json": ((4, 0.95, "evil", r"the software shall be used for good not evil"),),
    "ms-rl": ((4, 0.95, "microsoft", r"microsoft reciprocal licen[cs]e"),),
    "postgresql": ((4, 0.95, "postgresql", r"(?:the )?postgresql licen[cs]e"),),
    "vim": ((3, 0.9, "vim", r"(?:the )?vim licen[cs]e"),),
    "ogl": ((4, 0.95, "government", r"open government licen[cs]e(?: v ?[123](?: 0)?)?"),),
    "afl": (
        (5, 0.95, "academic", r"licensed under the academic free licen[cs]e version [123](?: [01])?"),
        (3, 0.85, "attribution", r"you must retain in the source code of any derivative works that you create all copyright patent or trademark notices from the source code of the original work and all attribution notices"),
    ),
    "osl": ((5, 0.95, "open", r"licensed under the open software licen[cs]e version [123](?: [01])?"),),
    "apsl": (
        (5, 0.95, "apple", r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license"),
        (4, 0.95, "apsl|apple", r"apple public source licen[cs]e(?: version)?(?: [12](?: [012])?)?"),
    ),
    "qpl": ((4, 0.95, "qpl|public", r"(?:the )?q public licen[cs]e(?: version 1(?: 0)?)?"), (4, 0.9, "qpl", r"qpl(?: 1 0)?")),
    "sissl": ((4, 0.95, "sun", r"sun industry standards source licen[cs]e(?: version 1 [12])?"), (4, 0.95, "sissl", r"sissl")),
    "spl": ((5, 0.95, "sun", r"the contents of this file are subject to the sun public license version 1 0"), (4, 0.95, "sun", r"sun public licen[cs]e")),
    "npl": ((5, 0.95, "netscape", r"the contents of this file are subject to the netscape public license version 1 [01]"), (4, 0.95, "netscape", r"netscape public licen[cs]e")),
    "ipl": ((4, 0.95, "ibm", r"ibm public licen[cs]e(?: version 1(?: 0)?| 1 0)?"), (5, 0.95, "ibm", r"the accompanying program is provided under the terms of this ibm public license agreement")),
    "rpl": ((4, 0.95, "reciprocal", r"reciprocal public licen[cs]e(?: 1 [15])?"), (5, 0.95, "rpl", r"unless explicitly acquired and licensed from licensor under another license the contents of this file are subject to the reciprocal public license rpl")),
    "cpal": ((4, 0.95, "attribution", r"common public attribution licen[cs]e(?: version 1(?: 0)?)?"), (5, 0.95, "attribution", r"the contents of this file are subject to the common public attribution license version 1 0")),
    "cecill": (
        (4, 0.95, "cecill", r"cecill(?: [bc])?(?: free software)? licen[cs]e(?: agreement)?"),
        (5, 0.95, "cecill", r"this software is governed by the cecill(?: [bc])? license under french law and abiding by the rules of distribution of free software"),
        (4, 0.95, "cecill", r"http www cecill info"),
    ),
    "eudatagrid": ((4, 0.95, "datagrid", r"eu datagrid software licen[cs]e"),),
    "ecl": ((4, 0.95, "educational|ecl", r"(?:educational community licen[cs]e|ecl)(?: version)? [12](?: 0)"), (5, 0.95, "educational", r"licensed under the educational community license version [12] 0")),
    "efl": ((4, 0.95, "eiffel", r"eiffel forum licen[cs]e(?: version [12])?"),),
    "entessa": ((4, 0.95, "entessa", r"entessa public licen[cs]e"),),
    "fair": ((4, 0.9, "instrument", r"usage of the works is permitted provided that this instrument is retained with the works so that any entity that uses the works is notified of this instrument"),),
    "frameworx": ((4, 0.95, "frameworx", r"frameworx open licen[cs]e(?: 1 0)?"),),
    "intel": ((4, 0.95, "intel", r"intel open source licen[cs]e"), (4, 0.95, "intel", r"intel simplified software licen[cs]e"), (4, 0.9, "intel", r"neither the name of intel corporation nor the names of its contributors may be used to endorse or promote products")),
    "lucent": ((4, 0.95, "lucent", r"lucent public licen[cs]e(?: version 1(?: 0| 02)?)?"),),
    "miros": ((4, 0.95, "miros", r"(?:the )?miros licen[cs]e"),),
    "motosoto": ((4, 0.95, "motosoto", r"motosoto open source licen[cs]e"),),
    "multics": ((4, 0.95, "multics", r"multics licen[cs]e"),),
    "nasa": ((4, 0.95, "nasa", r"nasa open source agreement(?: version 1 3)?"),),
    "naumen": ((4, 0.95, "naumen", r"naumen public licen[cs]e"),),
    "nethack": ((4, 0.95, "nethack", r"nethack general public licen[cs]e"),),
    "nokia": ((4, 0.95, "nokia", r"nokia open source licen[cs]e"),),
    "ntp": ((4, 0.9, "ntp", r"(?:the )?ntp licen[cs]e"), (4, 0.85, "suitability", r"makes no representations about the suitability (?:of )?this software for any purpose it is provided as is without express or implied warranty")),
    "oclc": ((4, 0.95, "oclc", r"oclc research public licen[cs]e(?: 2 0)?"),),
    "ogtsl": ((4, 0.95, "group", r"open group test suite licen[cs]e"),),
    "php": ((4, 0.95, "php", r"this source file is subject to version [23](?: [01]+)? of the php license"), (4, 0.9, "php", r"(?:the )?php licen[cs]e(?: version)?(?: [23] [01]+)?"), (4, 0.9, "php", r"this product includes php software freely available from")),
    "zend": ((4, 0.95, "zend", r"this source file is subject to version 2 00 of the zend license"), (4, 0.9, "zend", r"zend engine licen[cs]e")),
    "realnetworks": ((4, 0.95, "realnetworks", r"realnetworks public source licen[cs]e"), (4, 0.95, "rpsl", r"rpsl(?: 1 0)?")),
    "ricoh": ((4, 0.95, "ricoh", r"ricoh source code public licen[cs]e"),),
    "simple-public": ((4, 0.95, "simple", r"simple public licen[cs]e(?: 2 0)?"),),
    "sleepycat": ((4, 0.95, "sleepycat", r"(?:the )?sleepycat (?:public )?licen[cs]e"), (4, 0.9, "accompanying", r"redistributions in any form must be accompanied by information on how to obtain complete source code for the (?:db )?software and any accompanying software that uses the (?:db )?software")),
    "sybase": ((4, 0.95, "sybase", r"sybase open watcom public licen[cs]e"),),
    "upl": ((4, 0.95, "universal", r"(?:the )?universal permissive licen[cs]e(?: upl)?(?: v(?:ersion)? ?1 0)?"), (4, 0.95, "upl", r"oss oracle com licenses upl")),
    "vovida": ((4, 0.95, "vovida", r"vovida software licen[cs]e(?: v 1 0)?"),),
    "w3c": ((4, 0.95, "w3c", r"w3c software (?:notice and licen[cs]e|and document (?:notice and )?licen[cs]e)"), (4, 0.9, "w3c", r"w3c document licen[cs]e")),
    "watcom": ((4, 0.95, "watcom", r"open watcom public licen[cs]e"),),
    "xnet": ((4, 0.95, "xnet|net", r"x ?net licen[cs]e"),),
    "icu": ((4, 0.9, "icu", r"icu licen[cs]e(?: icu 1 8 1 and later)?"),),
    "libpng": ((4, 0.95, "libpng|png", r"(?:this code is released under the )?libpng licen[cs]e"), (4, 0.9, "png", r"png reference library (?:license )?version [12]")),
    "libtiff": ((4, 0.9, "leffler", r"the names of sam leffler and silicon graphics may not be used in any advertising or publicity relating to the software"),),
    "ijg": ((4, 0.95, "jpeg", r"this software is based in part on the work of the independent jpeg group"),),
    "freetype": ((4, 0.95, "freetype", r"(?:the )?freetype (?:project )?licen[cs]e(?: ftl)?"), (4, 0.95, "freetype", r"portions of this software are copyright (?:c )?(?:[0-9]+ )?the freetype project")),
    "bzip2": ((4, 0.9, "bzip2", r"bzip2 licen[cs]e"), (4, 0.9, "seward", r"this program bzip2 the associated library libbzip2 and all documentation are copyright (?:c )?(?:[0-9]+ )+julian (?:r )?seward")),
    "info-zip": ((4, 0.95, "zip", r"info zip licen[cs]e"),),
    "tcl": ((4, 0.9, "tcl", r"tcl tk licen[cs]e"), (4, 0.85, "verbatim", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose provided that existing copyright notices are retained in all copies and that this notice is included verbatim")),
    "ruby": ((4, 0.95, "ruby", r"ruby is copyrighted free software by yukihiro matsumoto"), (4, 0.9, "ruby", r"under the same terms as ruby(?: itself)?")),
    "lppl": ((5, 0.95, "latex", r"this work may be distributed and or modified under the conditions of the latex project public license"), (4, 0.9, "lppl", r"this work has the lppl maintenance status (?:author )?(?:maintained|unmaintained)")),
    "zpl": ((4, 0.9, "zope", r"this software consists of contributions made by zope corporation"), (5, 0.95, "zope", r"this software is subject to the provisions of the zope public license version 2 [01] zpl")),
    "ms-pl": ((4, 0.95, "microsoft", r"microsoft public licen[cs]e ms pl"), (4, 0.9, "opensource", r"opensource org licenses ms pl")),
    "ms-lpl": ((4, 0.95, "microsoft", r"microsoft limited public licen[cs]e"),),
    "mulan": ((4, 0.95, "mulan", r"mulan (?:psl|publ|permissive software licen[cs]e)(?: v ?[12])?"), (5, 0.95, "mulan", r"is licensed under mulan psl v ?2 you can use this software according to the terms and conditions of the mulan psl v ?2")),
    "blueoak": ((4, 0.95, "oak", r"blue oak model licen[cs]e(?: 1 0 0)?"),),
    "parity": ((4, 0.95, "parity", r"(?:the )?parity public licen[cs]e(?: [67] 0 0)?"),),
    "polyform": ((4, 0.95, "polyform", r"polyform (?:noncommercial|small business|perimeter|shield|strict|free trial|internal use) licen[cs]e(?: 1 0 0)?"),),
    "prosperity": ((4, 0.95, "prosperity", r"(?:the )?prosperity public licen[cs]e(?: [23] 0 0)?"),),
    "hippocratic": ((4, 0.95, "hippocratic", r"(?:the )?hippocratic licen[cs]e(?: [123] [0-9])?"),),
    "anti-996": ((4, 0.95, "996", r"anti 996 licen[cs]e(?: version 1 0)?"),),
    "fsl": ((4, 0.95, "functional", r"functional source licen[cs]e(?: version 1 [01])?"),),
    "timescale": ((4, 0.95, "timescale", r"timescale licen[cs]e(?: agreement)?"),),
    "confluent": ((4, 0.95, "confluent", r"confluent community licen[cs]e(?: agreement)?(?: version 1 0)?"),),
    "redis": ((4, 0.95, "redis", r"redis source available licen[cs]e(?: agreement)?"),),
    "gemma": ((4, 0.95, "gemma", r"gemma (?:terms of use|licen[cs]e)"),),
    "falcon": ((4, 0.95, "falcon", r"tii falcon (?:[0-9]+b )?licen[cs]e"),),
    "bigcode": ((4, 0.95, "bigcode", r"bigcode open rail m(?: v1)?(?: licen[cs]e)?(?: agreement)?"),),
    "cdla": ((4, 0.95, "community", r"community data licen[cs]e agreement (?:permissive|sharing)(?: version [12] 0)?"), (4, 0.95, "cdla", r"cdla (?:permissive|sharing) [12] 0")),
    "dl-de": ((4, 0.95, "datenlizenz", r"datenlizenz deutschland (?:namensnennung|zero)(?: version)?(?: 2 0)?"), (4, 0.95, "govdata", r"govdata de dl de (?:by|zero) 2 0")),
    "etalab": ((4, 0.95, "ouverte", r"licence ouverte(?: etalab)?(?: 2 0| version 2 0)?"),),
    "nlod": ((4, 0.95, "norwegian", r"norwegian licen[cs]e for open government data"),),
    "ogl-canada": ((4, 0.95, "canada", r"open government licen[cs]e canada"),),
    "fal": ((4, 0.95, "art|libre", r"(?:free art licen[cs]e|licence art libre)(?: 1 [23])?"),),
    "gust": ((4, 0.95, "gust", r"gust font licen[cs]e"),),
    "bitstream": ((4, 0.95, "bitstream", r"bitstream vera fonts copyright"), (4, 0.9, "typefaces", r"the fonts may be sold as part of a larger software package but no copy of one or more of the (?:bitstream vera )?font software typefaces may be sold by itself")),
    "ubuntu-font": ((4, 0.95, "ubuntu", r"ubuntu font licen[cs]e(?: version)?(?: 1 0)?"),),
    "arphic": ((4, 0.95, "arphic", r"arphic public licen[cs]e"),),
    "dsdp": ((4, 0.9, "dsdp", r"dsdp licen[cs]e"),),
    "gsoap": ((4, 0.95, "gsoap", r"gsoap public licen[cs]e"),),
    "imagemagick": ((4, 0.95, "imagemagick", r"imagemagick (?:studio )?licen[cs]e"),),
    "jasper": ((4, 0.95, "jasper", r"jasper (?:software )?licen[cs]e(?: version 2 0)?"),),
    "glide": ((4, 0.95, "3dfx", r"3dfx glide source code general public licen[cs]e"),),
    "sgi-b": ((4, 0.95, "sgi", r"sgi free software licen[cs]e b(?: version [12] [01])?"),),
    "saxpath": ((4, 0.9, "saxpath", r"saxpath licen[cs]e"),),
    "spencer": ((4, 0.9, "spencer", r"copyright (?:c )?(?:[0-9]+ )+henry spencer"), (4, 0.85, "responsible", r"the author is not responsible for the consequences of use of this software no matter how awful even if they arise from flaws in it")),
    "hpnd": ((4, 0.95, "historical", r"historical permission notice and disclaimer"), (3, 0.85, "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appears? in all copies")),
    "wxwindows": ((4, 0.95, "wxwindows|windows", r"wx ?windows library licen[cs]e(?: version 3 1)?"),),
    "xfree86": ((4, 0.95, "xfree86", r"xfree86 (?:project )?licen[cs]e(?: 1 1)?"), (4, 0.9, "xfree86", r"this product includes software developed by the xfree86 project inc")),
    "yahoo": ((4, 0.95, "yahoo", r"yahoo public licen[cs]e(?: 1 1)?"),),
    "zimbra": ((4, 0.95, "zimbra", r"zimbra public licen[cs]e(?: 1 [34])?"),),
    "proprietary": (
        (2, 0.6, "confidential", r"(?:strictly )?confidential and proprietary"),
        (2, 0.6, "unauthorized", r"unauthorized (?:copying|reproduction|distribution) (?:of this \w+ )?is (?:strictly )?prohibited"),
        (2, 0.6, "prior", r"may (?:not )?be (?:reproduced|copied|distributed) (?:in any form )?without (?:the )?prior written (?:permission|consent)"),
        (2, 0.6, "secrets", r"contains? (?:valuable )?trade secrets"),
        (2, 0.6, "eula", r"end user licen[cs]e agreement eula|eula"),
        (2, 0.55, "property", r"(?:is|remains) the (?:sole |exclusive )?property of"),
        (2, 0.55, "internal", r"for internal use only"),
    ),
}
