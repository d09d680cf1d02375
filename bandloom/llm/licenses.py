"""License scans by ordered signature rules.

A text is reduced to words (A-Z lower-cased; runs of letters, digits and non-ASCII characters) joined by one space.
Rules are regular expressions over that form, each behind a keyword that must occur first and each with a priority and
a confidence. Of overlapping detections one contained in another's words is dropped if the other has the same or a
higher priority; of equal intervals the earlier rule stays. The fixed base phrases are reported whatever the rules do.

A license has three expressions of its own: its name, its short tag (beside a word that makes it a license) and its
address. The other rules are sentences that are peculiar to one license or family.
"""

from __future__ import annotations

import bisect
import functools
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
_TABLE = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

V = r"(?: v(?:ersion)? ?| )"
#: label, keyword, name as written, short tag, address; all on the reduced form.
LICENSES = (
    ("gpl-3.0", "gnu", rf"gnu general public license{V}3(?: 0)?", r"gpl ?v? ?3(?: 0)?(?: only| or later)?", r"gnu org licenses gpl 3 0"),
    ("gpl-2.0", "gnu", rf"gnu general public license{V}2(?: 0)?", r"gpl ?v? ?2(?: 0)?(?: only| or later)?", r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-1.0", "gnu", rf"gnu general public license{V}1(?: 0)?", r"gpl ?v? ?1(?: 0)?(?: only| or later)?", r"gnu org licenses old licenses gpl 1 0"),
    ("lgpl-3.0", "gnu", rf"gnu lesser general public license{V}3(?: 0)?", r"lgpl ?v? ?3(?: 0)?(?: only| or later)?", r"gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", "gnu", rf"gnu lesser general public license{V}2 1", r"lgpl ?v? ?2 1(?: only| or later)?", r"gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-2.0", "gnu", rf"gnu library general public license{V}2(?: 0)?", r"lgpl ?v? ?2(?: 0)?(?: only| or later)?", r"gnu org licenses old licenses lgpl 2 0"),
    ("agpl-3.0", "gnu", rf"gnu affero general public license{V}3(?: 0)?", r"agpl ?v? ?3(?: 0)?(?: only| or later)?", r"gnu org licenses agpl 3 0"),
    ("gfdl-1.3", "gnu", rf"gnu free documentation license{V}1 3", r"gfdl 1 3", r"gnu org licenses fdl 1 3"),
    ("gfdl-1.2", "gnu", rf"gnu free documentation license{V}1 2", r"gfdl 1 2", r"gnu org licenses old licenses fdl 1 2"),
    ("apache-2.0", "apache", rf"apache (?:software )?license{V}2(?: 0)?", r"apache ?2(?: 0)?", r"apache org licenses license 2 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?license{V}1 1", r"apache 1 1", r"apache org licenses license 1 1"),
    ("apache-1.0", "apache", rf"apache (?:software )?license{V}1 0", r"apache 1 0", r"apache org licenses license 1 0"),
    ("mit", "mit", r"mit (?:x11 )?license", r"mit", r"opensource org licenses mit"),
    ("mit-0", "mit", r"mit no attribution(?: license)?", r"mit 0", r"opensource org licenses mit 0"),
    ("x11", "x11", r"x11 license", r"x11", r"xfree86 org (?:(?:current|legal|\d) ){0,3}licenses?"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause) bsd license", r"bsd 2 clause", r"opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause) bsd license", r"bsd 3 clause", r"opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original|4 clause) bsd license", r"bsd 4 clause", r"spdx org licenses bsd 4 clause"),
    ("0bsd", "bsd", r"zero clause bsd license", r"0bsd", r"opensource org licenses 0bsd"),
    ("isc", "isc", r"isc license", r"isc", r"opensource org licenses isc"),
    ("mpl-2.0", "mozilla", rf"mozilla public license{V}2(?: 0)?", r"mpl ?2(?: 0)?", r"mozilla org mpl 2 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public license{V}1 1", r"mpl ?1 1", r"mozilla org mpl (?:mpl )?1 1"),
    ("epl-2.0", "eclipse", rf"eclipse public license{V}2(?: 0)?", r"epl ?2(?: 0)?", r"eclipse org legal epl (?:v20|2 0)"),
    ("epl-1.0", "eclipse", rf"eclipse public license{V}1(?: 0)?", r"epl ?1(?: 0)?", r"eclipse org legal epl v10"),
    ("cddl-1.0", "common development", rf"common development and distribution license{V}1(?: 0)?", r"cddl ?1(?: 0)?", r"opensource org licenses cddl 1 0"),
    ("cddl-1.1", "common development", rf"common development and distribution license{V}1 1", r"cddl ?1 1", r"glassfish (?:dev )?java net public cddl"),
    ("cc-by-4.0", "creative commons", rf"creative commons attribution{V}4 0(?: international)?", r"cc by 4 0", r"creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "creative commons", rf"creative commons attribution{V}3 0(?: unported)?", r"cc by 3 0", r"creativecommons org licenses by 3 0"),
    ("cc-by-2.0", "creative commons", rf"creative commons attribution{V}2 0", r"cc by 2 0", r"creativecommons org licenses by 2 0"),
    ("cc-by-sa-4.0", "creative commons", rf"creative commons attribution share ?alike{V}4 0(?: international)?", r"cc by sa 4 0", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "creative commons", rf"creative commons attribution share ?alike{V}3 0(?: unported)?", r"cc by sa 3 0", r"creativecommons org licenses by sa 3 0"),
    ("cc-by-nd-4.0", "creative commons", rf"creative commons attribution no ?deriv(?:ative)?s{V}4 0", r"cc by nd 4 0", r"creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-4.0", "creative commons", rf"creative commons attribution non ?commercial{V}4 0", r"cc by nc 4 0", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-3.0", "creative commons", rf"creative commons attribution non ?commercial{V}3 0", r"cc by nc 3 0", r"creativecommons org licenses by nc 3 0"),
    ("cc-by-nc-sa-4.0", "creative commons", rf"creative commons attribution non ?commercial share ?alike{V}4 0", r"cc by nc sa 4 0", r"creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-sa-3.0", "creative commons", rf"creative commons attribution non ?commercial share ?alike{V}3 0", r"cc by nc sa 3 0", r"creativecommons org licenses by nc sa 3 0"),
    ("cc-by-nc-nd-4.0", "creative commons", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s{V}4 0", r"cc by nc nd 4 0", r"creativecommons org licenses by nc nd 4 0"),
    ("cc0-1.0", "cc0", rf"cc0{V}1 0(?: universal)?", r"cc0(?: 1 0)?", r"creativecommons org publicdomain zero 1 0"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense", r"unlicense org"),
    ("wtfpl", "want to public", r"do what the f[a-z]{0,8} you want to public license", r"wtfpl", r"wtfpl net"),
    ("zlib", "zlib", r"zlib(?: libpng)? license", r"zlib", r"zlib net zlib license"),
    ("bsl-1.0", "boost", rf"boost software license{V}1 0", r"bsl ?1 0", r"boost org license 1 0"),
    ("artistic-2.0", "artistic", rf"artistic license{V}2(?: 0)?", r"artistic 2 0", r"opensource org licenses artistic 2 0"),
    ("artistic-1.0", "artistic", rf"artistic license{V}1 0", r"artistic 1 0", r"opensource org licenses artistic 1 0"),
    ("afl-3.0", "academic", rf"academic free license{V}3(?: 0)?", r"afl ?3 0", r"opensource org licenses afl 3 0"),
    ("osl-3.0", "open software", rf"open software license{V}3(?: 0)?", r"osl ?3 0", r"opensource org licenses osl 3 0"),
    ("eupl-1.2", "european union", rf"european union public licen[cs]e{V}1 2", r"eupl ?1 2", r"joinup ec europa eu (?:(?:software|page|collection|community|sites|default|files|custom page) ){0,4}eupl"),
    ("eupl-1.1", "european union", rf"european union public licen[cs]e{V}1 1", r"eupl ?1 1", r"ec europa eu idabc eupl"),
    ("ms-pl", "microsoft", r"microsoft public license", r"ms pl", r"opensource org licenses ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", r"ms rl", r"opensource org licenses ms rl"),
    ("ofl-1.1", "open font", rf"sil open font license{V}1 1", r"ofl ?1 1", r"scripts sil org ofl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", r"ncsa", r"opensource org licenses ncsa"),
    ("php-3.01", "php", rf"php license{V}3 01", r"php 3 01", r"php net license 3 01"),
    ("python-2.0", "python", r"python software foundation license(?: version 2)?", r"psf 2 0", r"docs python org (?:\d{1,2} ){0,3}license"),
    ("ruby", "ruby", r"ruby license", r"ruby", r"ruby lang org en about license"),
    ("openssl", "openssl", r"openssl license", r"openssl", r"openssl org source license"),
    ("postgresql", "postgresql", r"postgresql license", r"postgresql", r"opensource org licenses postgresql"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database license(?: v?1 0)?", r"odbl ?1 0", r"opendatacommons org licenses odbl"),
    ("odc-by-1.0", "data commons", r"open data commons attribution license(?: v?1 0)?", r"odc by ?1 0", r"opendatacommons org licenses by"),
    ("pddl-1.0", "public domain", r"public domain dedication and license(?: v?1 0)?", r"pddl ?1 0", r"opendatacommons org licenses pddl"),
    ("bsl-1.1", "business source", rf"business source license{V}1 1", r"busl ?1 1", r"mariadb com bsl11"),
    ("sspl-1.0", "server side", rf"server side public license(?:{V}1)?", r"sspl ?1(?: 0)?", r"mongodb com licensing server side public license"),
)
#: label, keyword, expression of a sentence that only this license or family has.
SENTENCES = (
    ("mit", "person obtaining", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "without restriction", r"to deal in the software without restriction including without limitation the rights"),
    ("mit", "substantial portions", r"shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", r"warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors"),
    ("mit", "dealings", r"out of or in connection with the software or the use or other dealings in the software"),
    ("x11", "advertising", r"shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authori[sz]ation from"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("isc", "tortious", r"loss of use data or profits whether in an action of contract negligence or other tortious action"),
    ("hpnd", "copyright notice", r"provided that the above copyright notice appears? in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("hpnd", "without fee", r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:is hereby granted )?without fee"),
    ("ntp", "suitability", r"no representations about the suitability (?:of )?this software for any purpose it is provided as is"),
    ("bsd", "source and binary", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source", r"redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "binary form must", r"redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "neither the name", r"neither the name of (?:the )?(?:copyright holder|university|author|\w{1,30}) nor the names of its contributors"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-4-clause", "this product includes", r"this product includes software developed by (?:the )?(?:university of california|\w{1,30})"),
    ("bsd-3-clause-clear", "patent rights", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-3-clause-no-nuclear", "nuclear facility", r"not designed licensed or intended for use in the design construction operation or maintenance of any nuclear facility"),
    ("gpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "implied warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gpl", "received a copy", r"you should have received a copy of the gnu general public license"),
    ("gpl", "licenses for most", r"the licenses for most software (?:and other practical works )?are designed to take away your freedom"),
    ("gpl-2.0-or-later", "any later version", r"version 2 of the license or (?:at your option )?any later version"),
    ("gpl-2.0-or-later", "either version 2", r"either version 2 (?:of the license )?or at your option any later version"),
    ("gpl-3.0-or-later", "either version 3", r"either version 3 of the license or at your option any later version"),
    ("gpl-2.0-only", "version 2 as published", r"version 2 as published by the free software foundation"),
    ("gpl-3.0", "install and execute", r"methods procedures authori[sz]ation keys or other information required to install and execute modified versions"),
    ("gpl-3.0", "propagate", r"to propagate a work means to do anything with it that without permission would make you directly or secondarily liable"),
    ("gpl-2.0", "based on the program", r"a work based on the program means either the program or any derivative work under copyright law"),
    ("gpl-classpath", "independent modules", r"permission to link this library with independent modules to produce an executable"),
    ("gcc-exception", "runtime library exception", r"gcc runtime library exception"),
    ("gpl-font", "special exception", r"as a special exception if you create a document which uses this font"),
    ("autoconf-exception", "configuration script", r"as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script"),
    ("openssl-exception", "link", r"permission to link the code of portions of this program with the openssl library"),
    ("lgpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", "received a copy", r"you should have received a copy of the gnu lesser general public license"),
    ("lgpl", "no derivative", r"a program that contains no derivative of any portion of the library"),
    ("lgpl-3.0", "combined work", r"a combined work is a work produced by combining or linking an application with the library"),
    ("agpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "received a copy", r"you should have received a copy of the gnu affero general public license"),
    ("agpl-3.0", "remotely through", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "invariant sections", r"with no invariant sections (?:with )?no front cover texts and (?:with )?no back cover texts"),
    ("gfdl", "copy distribute and", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", "except in compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "conditions of any kind", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", "subject to the terms", r"subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache-2.0", "notice text file", r"if the work includes a notice text file as part of its distribution"),
    ("apache-2.0", "governing permissions", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-1.1", "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl-2.0", "was not distributed", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "incompatible with", r"this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("mpl-1.1", "original code is", r"the original code is .{0,60}the initial developer of the original code is"),
    ("mpl-1.1", "contents of this file", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl-1.0", "constitutes recipient", r"any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("cpl-1.0", "common public license", r"the accompanying program is provided under the terms of this common public license"),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", "cddl header", r"when distributing covered code include this cddl header notice in each file"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such"),
    ("zlib", "express or implied warranty", r"provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("libpng", "png reference", r"the png reference library is supplied as is"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("bsl-1.0", "machine executable", r"in the form of machine executable object code generated by a source language processor"),
    ("bsl-1.0", "accompanying documentation", r"copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit"),
    ("cc0-1.0", "all copyright", r"(?:has|have) (?:waived|dedicated) all copyright and related or neighbou?ring rights"),
    ("cc0-1.0", "affirmer", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc-by", "redistribute the material", r"you are free to share copy and redistribute the material .{0,80}adapt remix transform and build upon the material"),
    ("cc-by", "appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-nc", "commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-by-nc", "commercial advantage", r"not primarily intended for or directed towards commercial advantage or monetary compensation"),
    ("cc-by-nd", "modified material", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by-sa", "same license", r"you must distribute your contributions under the same license as the original"),
    ("cc", "exercising the licensed rights", r"by exercising the licensed rights (?:defined below )?you accept and agree to be bound by the terms and conditions of this creative commons"),
    ("cc", "some rights reserved", r"some rights reserved"),
    ("artistic", "package", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", "package", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms under which a given free software package may be copied"),
    ("afl-3.0", "academic free license", r"licensed under the academic free license version 3 0"),
    ("osl-3.0", "open software license", r"licensed under the open software license version 3 0"),
    ("eupl", "eupl", r"licensed under the eupl"),
    ("eupl", "software distributed under the licence", r"unless required by applicable law or agreed to in writing software distributed under the licence is distributed on an as is basis"),
    ("ms-pl", "contributor grants you", r"each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution prepare derivative works of its contribution"),
    ("ms-pl", "use the software", r"if you use the software you accept this license if you do not accept the license do not use the software"),
    ("ofl-1.1", "font software", r"the font software may be sold as part of a larger software package but no copy of one or more of the font software typefaces may be sold by itself"),
    ("ofl-1.1", "reserved font", r"no modified version of the font software may use the reserved font name"),
    ("ofl-1.1", "open font license", r"this font software is licensed under the sil open font license"),
    ("ncsa", "illinois", r"neither the names of .{0,80}university of illinois .{0,40}nor the names of its contributors may be used"),
    ("php", "php", r"this product includes php (?:software )?freely available from"),
    ("python-2.0", "python software foundation", r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("python-2.0", "psf is making", r"psf is making python available to licensee on an as is basis"),
    ("ruby", "at least one of the following", r"you may redistribute this software in source or binary form provided that you do at least one of the following"),
    ("openssl", "openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "eric young", r"this product includes cryptographic software written by eric young"),
    ("postgresql", "without a written agreement", r"without fee and without a written agreement is hereby granted"),
    ("odbl-1.0", "database", r"made available under the open database license"),
    ("odbl-1.0", "contains information", r"contains information from .{0,60}which is made available (?:here )?under the open database license"),
    ("odc-by-1.0", "individual contents", r"any rights in individual contents of the database are licensed under"),
    ("pddl-1.0", "public domain", r"made available under the public domain dedication and license"),
    ("bsl-1.1", "change date", r"on the change date .{0,60}the licensor hereby grants you rights under the terms of the change license"),
    ("bsl-1.1", "production use", r"the licensor may make an additional use grant above permitting limited production use"),
    ("sspl-1.0", "service source code", r"you must make the service source code available via network download to everyone at no charge"),
    ("elastic-2.0", "hosted or managed", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "provided to you by the licensor", r"the software is provided to you by the licensor under the license (?:as defined below )?subject to the following condition"),
    ("polyform-noncommercial", "noncommercial purpose", r"any noncommercial purpose is a permitted purpose"),
    ("json", "good not evil", r"the software shall be used for good not evil"),
    ("beerware", "beer", r"you can buy me a beer in return"),
    ("wtfpl", "want to", r"you just do what the f[a-z]{0,8} you want to"),
    ("vim", "vim", r"if you distribute a modified version of vim including when distributed with other software"),
    ("w3c", "is being provided", r"this (?:work|document|software) (?:and or accompanying documentation )?is being provided by the copyright holders under the (?:following license|w3c)"),
    ("curl", "with or without fee", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("icu", "unicode", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("unicode", "data files", r"associated documentation the data files or unicode software"),
    ("tcl", "authors hereby grant", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose provided that existing copyright notices are retained in all copies"),
    ("intel-acpi", "intel", r"intel grants free of charge to any person"),
    ("bzip2", "bzip2", r"this program bzip2 the associated library libbzip2 and all documentation"),
    ("ijg", "jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype", r"portions of this software are copyright .{0,40}the freetype project"),
    ("lppl", "latex project", r"it may be distributed and or modified under the conditions of the latex project public license"),
    ("lppl", "lppl maintenance", r"this work has the lppl maintenance status"),
    ("sleepycat", "complete source code", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("qpl", "q public license", r"you may redistribute it under the terms of the q public license"),
    ("watcom", "sybase", r"sybase open watcom public license"),
    ("ogl-uk", "government licence", r"contains public sector information licensed under the open government licence"),
    ("ogl-uk", "crown copyright", r"crown copyright and database right"),
    ("etalab", "licence ouverte", r"licence ouverte open licence"),
    ("us-government", "united states government", r"this (?:work|software) was (?:created|produced|developed|prepared) by (?:an? )?(?:employees? )?(?:of )?the united states government"),
    ("us-government", "title 17", r"not subject to copyright protection (?:and is in the public domain )?(?:pursuant to|under) title 17"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"this (?:work|file|document|image|text|book) is (?:now )?in the public domain"),
    ("public-domain", "no known copyright", r"no known copyright restrictions"),
    ("gutenberg", "use of anyone", r"this ebook is for the use of anyone anywhere (?:in the united states and most other parts of the world )?at no cost and with almost no restrictions whatsoever"),
    ("gutenberg", "gutenberg", r"under the terms of the project gutenberg license"),
    ("llama", "llama", r"licensed under the llama \d(?: \d)? community license"),
    ("openrail", "derivatives of the model", r"you shall not use the model or derivatives of the model for the restrictions? set forth"),
    ("openrail", "open rail", r"(?:creativeml )?open rail (?:m|s|d|ams)"),
    ("cdla-permissive", "community data license", r"community data license agreement permissive"),
    ("cdla-sharing", "community data license", r"community data license agreement sharing"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "trade secret", r"contains (?:the )?(?:confidential|proprietary|valuable)(?: and (?:confidential|proprietary))? trade secrets? (?:of|and)"),
    ("proprietary", "strictly prohibited", r"unauthori[sz]ed (?:copying|reproduction|distribution) (?:of this file |of this software |or distribution )?(?:via any medium )?is strictly prohibited"),
    ("proprietary", "no part of this", r"no part of this (?:publication|book|document|work) may be reproduced .{0,100}without the (?:prior )?written permission"),
    ("proprietary", "agree to be bound", r"by (?:installing|downloading|using) (?:or using )?(?:the|this) software you agree to be bound by the terms of this (?:end user )?(?:license )?agreement"),
    ("proprietary", "evaluation", r"licensed (?:solely )?for (?:internal )?evaluation (?:purposes )?only"),
    ("proprietary", "may not be", r"may not be (?:copied|reproduced|published|broadcast) (?:rewritten )?or redistributed without (?:prior )?(?:written )?permission"),
    ("proprietary", "reverse engineer", r"you may not reverse engineer decompile or disassemble"),
    ("noncommercial", "use only", r"(?:free )?for (?:personal|non ?commercial|private) (?:and non ?commercial )?use only"),
    ("noncommercial", "commercial", r"not for commercial use"),
    ("noncommercial", "only", r"for (?:academic|research)(?: (?:and|or) (?:academic|research|educational))?(?: use| purposes) only"),
)
FAMILIES = (("gpl", "gnu general public license"), ("lgpl", "gnu lesser general public license"), ("agpl", "gnu affero general public license"), ("gfdl", "gnu free documentation license"), ("apache", "apache license"), ("mpl", "mozilla public license"), ("epl", "eclipse public license"), ("cddl", "common development and distribution license"), ("bsd", "bsd license"), ("artistic", "artistic license"), ("mit", "mit license"), ("cc", "creative commons license"), ("cc-by", "cc by"), ("cc-by-sa", "cc by sa"), ("cc-by-nc", "cc by nc"), ("cc-by-nd", "cc by nd"), ("cc-by-nc-sa", "cc by nc sa"), ("cc-by-nc-nd", "cc by nc nd"))
REFERS = r"(?:(?:re)?licen[cs]ed|released|distributed|available|published|provided|covered) under (?:the )?(?:terms of )?(?:the )?"
#: What makes a tag a license: words before it, or one behind it.
TAGGED = r"(?:spdx license identifier |licen[cs]e(?:d|s)? (?:is |as )?|{refers}){tag}|{tag} licen[cs]ed?"
_REFERS = re.compile(REFERS.encode())


class Rule(NamedTuple):
    label: str
    keywords: tuple[bytes, ...]  # every match contains one of them
    pattern: re.Pattern
    priority: int
    confidence: float
    source: str


def first_words(pattern: str) -> str:
    """The literal words, two at most, with which a pattern begins."""
    return " ".join(w for w in pattern.split(" ")[:2] if w.isalnum())


def rule(label: str, keywords: tuple[str, ...], pattern: str, priority: int, confidence: float) -> Rule:
    return Rule(label, tuple(k.encode() for k in keywords), re.compile(rf"(?<= )(?:{pattern})(?= )".encode()), priority, confidence, pattern)


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules by falling priority, then in the order of the tables; patterns match whole words."""
    out = []
    for label, key, name, tag, address in LICENSES:
        out.append(rule(label, (f" {key}",), f"(?:{REFERS})?{name}", 3, 0.9))
        out.append(rule(label, ("licen", " under "), TAGGED.format(refers=REFERS, tag=f"(?:{tag})"), 4, 0.95))
        out.append(rule(label, (f" {first_words(address)}",), address, 3, 0.95))
    out += [rule(label, (f" {key}",), pattern, 4, 0.97) for label, key, pattern in SENTENCES]
    out += [rule(label, (f" {name.split(' ')[0]}",), f"(?:{REFERS})?{name}", 0, 0.6) for label, name in FAMILIES]
    return tuple(sorted(out, key=lambda r: -r.priority))


@functools.cache
def keywords() -> tuple[tuple[bytes, tuple[tuple[int, Rule], ...]], ...]:
    """Each keyword with its rules and their numbers."""
    by: dict[bytes, list[tuple[int, Rule]]] = {}
    for i, r in enumerate(rules()):
        for k in r.keywords:
            by.setdefault(k, []).append((i, r))
    return tuple((k, tuple(v)) for k, v in by.items())


def reduced(text: str) -> bytes:
    """Words joined and surrounded by single spaces."""
    words = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return b" %s " % b" ".join(words) if words else b" "


#: Bytes around a keyword in which its rules search; no expression can match so many, which a test holds.
AROUND = 320


def regions(text: bytes, keyword: bytes) -> list[tuple[int, int]]:
    """Merged surroundings of all places of keyword."""
    out: list[tuple[int, int]] = []
    at = text.find(keyword)
    while at >= 0:
        a, b = max(0, at - AROUND), at + len(keyword) + AROUND
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        at = text.find(keyword, at + 1)
    return out


class Detection(NamedTuple):
    label: str
    start: int  # bytes of the reduced form
    end: int
    priority: int
    confidence: float
    rule: int


def detections(text: bytes) -> list[Detection]:
    """All matches of all rules in a reduced text; a name after words that refer to a license counts for more."""
    found = set()
    for key, of in keywords():
        if key in text and (key != b" under " or _REFERS.search(text)):
            for a, b in regions(text, key):
                for i, r in of:
                    for m in r.pattern.finditer(text, a, b):
                        refers = r.priority <= 3 and _REFERS.match(text, m.start(), m.end())
                        found.add(Detection(r.label, *m.span(), r.priority + bool(refers), max(r.confidence, 0.8 if r.priority == 0 else 0.98) if refers else r.confidence, i))
    return sorted(found)


def stay(found: list[Detection]) -> list[Detection]:
    """Without those contained in one of the same or a higher priority; of equal intervals and priorities the earlier
    rule stays. Takes n log n steps: a tree over the starts holds the farthest end of what stays up to each."""
    starts = sorted({x.start for x in found})
    far, kept = [-1] * (len(starts) + 1), []
    for x in sorted(found, key=lambda x: (-x.priority, x.start - x.end, x.start, x.rule)):
        i = place = bisect.bisect_left(starts, x.start) + 1
        most = -1
        while i:
            most = max(most, far[i])
            i &= i - 1
        if most < x.end:
            kept.append(x)
            while place < len(far):
                far[place] = max(far[place], x.end)
                place += place & -place
    return sorted(kept)


def base(text: bytes) -> list[tuple[int, str]]:
    """(number of the first word, label) of each base phrase, overlapping ones too, by place."""
    out = []
    for phrase, label in BASE:
        at = text.find(p := b" %s " % phrase.encode())
        while at >= 0:
            out.append((at, label))
            at = text.find(p, at + 1)
    word, last, places = 0, 0, []
    for at, label in sorted(out):
        word += text.count(b" ", last, at)
        last = at
        places.append((word, label))
    return places


def scan(text: str) -> tuple:
    t = reduced(text)
    places, kept = base(t), stay(detections(t))
    mine = {label for _, label in places}
    # a base place that no detection covers still counts as a weak one
    score = max([x.confidence for x in kept] + [0.5] * bool(places), default=0.0)
    first, last = (places[0][0], places[-1][0]) if places else (None, None)
    return t.count(b" ") - 1, len(places), first, last, ",".join(sorted(mine)), ",".join(sorted(mine | {x.label for x in kept})), score


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_FIELDS = (("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()))


def licenses(docs: DataFrame) -> DataFrame:
    """One row of SCHEMA for every row of docs(doc_id, text), over whole texts.

    Null and empty texts have no words, no labels and score 0. score is the greatest confidence of the detections that
    stay. Repeated rows get equal results, an empty table an empty one; other columns are ignored.
    """
    common.arrow(docs.sparkSession)

    def run(batches):
        for b in batches:
            rows = [scan(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_FIELDS))], ["doc_id", *(n for n, _ in _FIELDS)])

    return common.id_text(docs).mapInArrow(run, SCHEMA)
