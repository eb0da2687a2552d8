"""License scans with ordered signature rules (DataFrame operators only).

**Words.**  Texts are cut into words: maximal runs of digits, A-Z, a-z and characters
from U+0080.  Rules are regular expressions over the words joined by single
spaces, compared without regard to the case of A-Z; a place is an interval of
words, from 0, end exclusive.

**Prefilter.**  Every rule names keywords that each of its places contains.  A text's
words are intersected once with all keywords (hashed); only rules whose keywords
are all there run their expression, and a text without any rule's longest keyword
skips the rules altogether.

**Resolution.**  Rules are ordered by priority, then by position in the list.  A
detection is suppressed if its interval lies inside that of another detection of
a higher priority, or of the same priority and longer, or of the same interval
and an earlier rule.  The detections of one text are swept in order of their
start; the sweep remembers the furthest end per priority, so its cost is linear
in the number of detections.

Everything happens inside a row: no shuffle, no join, nothing leaves the JVM, and
repeated rows or null ids need no care.  Null and empty texts have no words and
no detections.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import ROW, pick

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OPEN, CLOSE = "\x01", "\x02"    # mark places; separators, so no word contains them
BUFFER = 256                    # detections that the sweep gathers before it moves them on
DETECTION = "struct<start:int,neg_end:int,neg_priority:int,rule:int,label:string,base:boolean>"


@dataclass(frozen=True)
class Rule:
    label: str
    regex: str                  # over lower-cased words joined by single spaces
    keywords: tuple[str, ...]   # words that every place contains
    priority: int
    base: bool = False


# --- fixed values: base phrases of the registered query ----------------------------------------
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# --- families: label, title as it is written in prose, words that the title always has; several
# --- titles of one licence stand in lines of their own ------------------------------------------
FAMILIES = (
    ("gpl-1.0", "gnu general public license (?:version|v) 1(?: 0)?", "gnu general public license"),
    ("gpl-2.0", "gnu general public license (?:version|v) 2(?: 0)?", "gnu general public license"),
    ("gpl-2.0", "gnu gpl (?:version |v)?2", "gnu gpl"),
    ("gpl-2.0", "gplv2", "gplv2"),
    ("gpl-3.0", "gnu general public license (?:version|v) 3(?: 0)?", "gnu general public license"),
    ("gpl-3.0", "gnu gpl (?:version |v)?3", "gnu gpl"),
    ("gpl-3.0", "gplv3", "gplv3"),
    ("lgpl-2.1", "gnu (?:lesser|library) general public license (?:version|v) 2(?: [01])?", "gnu general public license"),
    ("lgpl-3.0", "gnu lesser general public license (?:version|v) 3(?: 0)?", "gnu lesser general public license"),
    ("lgpl", "gnu (?:lesser|library) general public license", "gnu general public license"),
    ("agpl-3.0", "gnu affero general public license(?: (?:version|v) 3(?: 0)?)?", "gnu affero general public license"),
    ("gfdl", "gnu free documentation license(?: version 1 [1-3])?", "gnu free documentation license"),
    ("apache-1.1", "apache (?:software )?license (?:version )?1 1", "apache license"),
    ("apache-2.0", "apache (?:software )?license (?:version )?2(?: 0)?", "apache license"),
    ("mit", "mit license", "mit license"),
    ("mit", "expat license", "expat license"),
    ("mit-0", "mit no attribution(?: license)?", "mit attribution"),
    ("x11", "x11 license", "x11 license"),
    ("isc", "isc license", "isc license"),
    ("bsd-2-clause", "(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd bsd)(?: license)?", "bsd"),
    ("bsd-3-clause", "(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd)(?: license)?", "bsd"),
    ("bsd-4-clause", "(?:4 clause bsd|bsd 4 clause|original bsd)(?: license)?", "bsd"),
    ("bsd", "bsd(?: style)? license", "bsd license"),
    ("0bsd", "(?:zero clause bsd|bsd zero clause)(?: license)?", "bsd zero clause"),
    ("0bsd", "0bsd(?: license)?", "0bsd"),
    ("mpl-1.1", "mozilla public license (?:version |v)?1 1", "mozilla public license"),
    ("mpl-2.0", "mozilla public license (?:version |v)?2(?: 0)?", "mozilla public license"),
    ("mpl", "mozilla public license", "mozilla public license"),
    ("epl-1.0", "eclipse public license (?:version |v )?1(?: 0)?", "eclipse public license"),
    ("epl-2.0", "eclipse public license (?:version |v )?2(?: 0)?", "eclipse public license"),
    ("edl-1.0", "eclipse distribution license", "eclipse distribution license"),
    ("cddl-1.0", "common development and distribution license", "common development distribution license"),
    ("cpl-1.0", "common public license(?: version 1 0)?", "common public license"),
    ("eupl-1.2", "european union public licen[cs]e(?: (?:version |v )?1 [0-2])?", "european union public"),
    ("ms-pl", "microsoft public license", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal license"),
    ("artistic-1.0", "artistic license 1(?: 0)?", "artistic license"),
    ("artistic-2.0", "artistic license (?:version )?2(?: 0)?", "artistic license"),
    ("artistic", "(?:perl |clarified )?artistic license", "artistic license"),
    ("bsl-1.0", "boost software license(?: version 1(?: 0)?)?", "boost software license"),
    ("zlib", "zlib(?: libpng)? license", "zlib license"),
    ("unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license", "fuck public license"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql licen[cs]e", "postgresql"),
    ("python-2.0", "python software foundation license(?: version 2)?", "python software foundation license"),
    ("php-3.01", "php license(?: version 3 0 ?1)?", "php license"),
    ("ruby", "ruby license", "ruby license"),
    ("openssl", "openssl license", "openssl license"),
    ("ncsa", "university of illinois (?:ncsa )?open source license", "university illinois open source license"),
    ("ofl-1.1", "sil open font license(?: (?:version )?1 [01])?", "sil open font license"),
    ("odbl-1.0", "open database license", "open database license"),
    ("odc-by", "open data commons attribution license", "open data commons attribution license"),
    ("pddl-1.0", "public domain dedication and license", "public domain dedication license"),
    ("cc0-1.0", "cc0(?: 1 0)?(?: universal)?", "cc0"),
    ("cc0-1.0", "creative commons zero", "creative commons zero"),
    ("cc-by-4.0", "cc by 4(?: 0)?(?: international)?", "cc 4"),
    ("cc-by-4.0", "creative commons attribution 4(?: 0)?(?: international)?", "creative commons attribution"),
    ("cc-by-3.0", "cc by 3(?: 0)?(?: unported)?", "cc 3"),
    ("cc-by-3.0", "creative commons attribution 3(?: 0)?(?: unported)?", "creative commons attribution"),
    ("cc-by-sa", "cc by sa(?: [1-4] [05])?", "cc sa"),
    ("cc-by-sa", "creative commons attribution share ?alike(?: [1-4] [05])?", "creative commons attribution"),
    ("cc-by-nc", "cc by nc(?: [1-4] [05])?", "cc nc"),
    ("cc-by-nc", "creative commons attribution non ?commercial(?: [1-4] [05])?", "creative commons attribution"),
    ("cc-by-nd", "cc by nd(?: [1-4] [05])?", "cc nd"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?", "creative commons attribution"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] [05])?", "cc nc sa"),
    ("cc-by-nc-nd", "cc by nc nd(?: [1-4] [05])?", "cc nc nd"),
    ("vim", "vim license", "vim license"),
    ("afl-3.0", "academic free license(?: (?:version |v )?3(?: 0)?)?", "academic free license"),
    ("osl-3.0", "open software license(?: (?:version |v )?3(?: 0)?)?", "open software license"),
    ("upl-1.0", "universal permissive license", "universal permissive license"),
    ("apsl-2.0", "apple public source license", "apple public source license"),
    ("busl-1.1", "business source license(?: 1 1)?", "business source license"),
    ("sspl-1.0", "server side public license", "server side public license"),
    ("proprietary", "proprietary and confidential", "proprietary confidential"),
    ("all-rights-reserved", "all rights reserved", "rights reserved"),
)
# --- clauses and notices: label, regular expression over words, as the public texts have them -----
# (a gap of the form (?:\S+ ){0,9} stands for names and years)
NOTICES = (
    ("gpl-2.0-or-later", r"under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version"),
    ("gpl-3.0-or-later", r"under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version"),
    ("gpl-2.0-only", r"under the terms of the gnu general public license version 2 (?:only )?as published by the free software foundation"),
    ("gpl-3.0-only", r"under the terms of the gnu general public license version 3 (?:only )?as published by the free software foundation"),
    ("lgpl-2.1-or-later", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version"),
    ("lgpl-2.0-or-later", r"under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version"),
    ("lgpl-3.0-or-later", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version"),
    ("agpl-3.0-or-later", r"under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version"),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license along with this library"),
    ("agpl", r"you should have received a copy of the gnu affero general public license along with this program"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", r"you may not use this (?:file|software|work) except in compliance with the license"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.0", r"the contents of this file are subject to the mozilla public license version 1 0"),
    ("npl-1.1", r"the contents of this file are subject to the netscape public license version 1 1"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl-2.0", r"secondary licenses when the conditions for such availability set forth in the eclipse public license"),
    ("cpl-1.0", r"this program and the accompanying materials are made available under the terms of the common public license"),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", r"licensed under the eupl"),
    ("afl", r"licensed under the academic free license version"),
    ("osl", r"licensed under the open software license version"),
    ("bsl-1.0", r"distributed under the boost software license version 1 0"),
    ("bsd", r"use of this source code is governed by a bsd style license that can be found in the license file"),
    ("mit", r"use of this source code is governed by an mit style license that can be found in the license file"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license version 1 1"),
    ("cc-by-4.0", r"this work is licensed under (?:a|the) creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", r"this work is licensed under (?:a|the) creative commons attribution share ?alike 4 0 international license"),
    ("cc-by-nc-4.0", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial 4 0 international license"),
    ("cc-by-nd-4.0", r"this work is licensed under (?:a|the) creative commons attribution no ?derivatives 4 0 international license"),
    ("cc-by-nc-sa-4.0", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike 4 0 international license"),
    ("cc-by-nc-nd-4.0", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial no ?derivatives 4 0 international license"),
    ("public-domain", r"this (?:work|file|code|software|program) (?:is|has been) (?:hereby )?(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", r"this software is the confidential and proprietary information of"),
    ("all-rights-reserved", r"no part of this (?:publication|document|book|work) may be reproduced (?:\S+ ){0,20}without (?:the )?prior written permission"),
)

CLAUSES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)?"),
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", r"except as contained in this notice the names? of (?:\S+ ){1,12}shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("json", r"the software shall be used for good not evil"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", r"this software is provided by the (?:copyright holders and contributors|author|regents and contributors) as is and any express or implied warranties"),
    ("bsd-3-clause", r"neither the names? of (?:\S+ ){1,12}nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", r"the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause-clear", r"subject to the limitations in the disclaimer below provided that the following conditions are met"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", r"the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("hpnd", r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:and )?(?:without fee )?is hereby granted without fee"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("zlib", r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", r"this notice may not be removed or altered from any source distribution"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsl-1.0", r"the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", r"we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("apache-2.0", r"license shall mean the terms and conditions for use reproduction and distribution as defined by"),
    ("apache-2.0", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache-2.0", r"you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache-1.1", r"products derived from this software may not be called apache"),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl-2.0", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-2.0", r"this license applies to any program or other work which contains a notice placed by the copyright holder"),
    ("gpl-2.0", r"activities other than copying distribution and modification are not covered by this license"),
    ("gpl-3.0", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-3.0", r"to propagate a work means to do anything with it that without permission would make you directly or secondarily liable"),
    ("gpl-3.0", r"installation information for a user product means any methods procedures authorization keys or other information"),
    ("lgpl", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl-2.1", r"a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("lgpl-3.0", r"incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions"),
    ("lgpl-3.0", r"a combined work is a work produced by combining or linking an application with the library"),
    ("agpl-3.0", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("agpl-3.0", r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2.0", r"covered software is provided under this license on an as is basis without warranty of any kind"),
    ("mpl-2.0", r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", r"software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied"),
    ("epl", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("cpl-1.0", r"the accompanying program is provided under the terms of this common public license"),
    ("cddl-1.0", r"when distributing covered (?:code|software) include this cddl header in each file"),
    ("eupl", r"this european union public licence the eupl applies to the work"),
    ("artistic-1.0", r"the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("artistic-2.0", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("wtfpl", r"you just do what the fuck you want to"),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("python-2.0", r"psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly"),
    ("php-3.01", r"this product includes php software freely available from"),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", r"this product includes cryptographic software written by eric young"),
    ("ncsa", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("ofl-1.1", r"the fonts and derivatives however cannot be released under any other type of license"),
    ("ofl-1.1", r"reserved font name refers to any names specified as such after the copyright statement"),
    ("cc0-1.0", r"has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("cc0-1.0", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders all of affirmer s copyright and related rights"),
    ("cc-by-4.0", r"to be bound by the terms and conditions of this creative commons attribution 4 0 international public license"),
    ("cc-by-sa-4.0", r"to be bound by the terms and conditions of this creative commons attribution sharealike 4 0 international public license"),
    ("cc-by-nc-4.0", r"to be bound by the terms and conditions of this creative commons attribution noncommercial 4 0 international public license"),
    ("cc-by-nd-4.0", r"to be bound by the terms and conditions of this creative commons attribution noderivatives 4 0 international public license"),
    ("cc-by-nc-sa-4.0", r"to be bound by the terms and conditions of this creative commons attribution noncommercial sharealike 4 0 international public license"),
    ("cc-by-nc-nd-4.0", r"to be bound by the terms and conditions of this creative commons attribution noncommercial noderivatives 4 0 international public license"),
    ("cc-by", r"the work as defined below is provided under the terms of this creative commons public license"),
    ("cc-by-nc", r"noncommercial means not primarily intended for or directed towards commercial advantage or monetary compensation"),
    ("cc-by-nd", r"you do not have permission under this public license to share adapted material"),
    ("cc-by-sa", r"the adapter s license you apply must be a creative commons license with the same license elements"),
    ("odbl-1.0", r"the open database license odbl is a license agreement intended to allow users to freely share modify and use this database"),
    ("odc-by", r"intended to allow users to freely share modify and use this database subject only to the attribution requirements"),
    ("ms-pl", r"if you use the software you accept this license if you do not accept the license do not use the software"),
    ("ms-rl", r"reciprocal grants for any file you distribute that contains code from the software"),
    ("upl-1.0", r"to any person obtaining a copy of this software associated documentation and or data collectively the software"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", r"the license does not grant to you the right to sell the software"),
    ("openrail", r"you agree not to use the model or derivatives of the model"),
)
NOTICE_PRIORITY, CLAUSE_PRIORITY = 95, 75


def literal_words(regex: str) -> tuple[str, ...]:
    """The three longest words that every match of an expression without alternatives at the top contains."""
    plain = re.sub(r"\((?:[^()]|\([^()]*\))*\)(?:[?*+]|\{[^}]*\})?", " ", regex)
    words = {w for w in plain.split() if w.isalnum()}
    return tuple(sorted(sorted(words, key=lambda w: (-len(w), w))[:3]))


# --- ways in which a license is named: priority, expression, keywords besides the title's ---------
TERMS = "(?:the )?(?:terms of (?:the )?)?"
FORMS = (
    (100, "spdx license identifier {spdx}", "spdx identifier", False),
    (90, "licen[cs]ed under " + TERMS + "{title}", "", True),
    (80, "(?:released|distributed|available|published|provided) under " + TERMS + "{title}", "", True),
    (70, "(?:opensource|spdx) org licenses {spdx}", "org licenses", False),
    (50, "{title}", "", True),
)
BASE_PRIORITY = 40


def default_rules() -> tuple[Rule, ...]:
    """Every family in every form, notices, clauses, then the base phrases."""
    rules: dict[tuple[str, str], Rule] = {}
    for label, title, title_words in FAMILIES:
        spdx = label.replace("-", " ").replace(".", " ")
        for priority, regex, keywords, titled in FORMS:
            words = set(keywords.split()) | set(title_words.split() if titled else spdx.split())
            rule = Rule(label, regex.format(spdx=spdx, title=title), tuple(sorted(words)), priority)
            rules.setdefault((rule.label, rule.regex), rule)
    bodies = [Rule(label, regex, literal_words(regex), priority)
              for table, priority in ((NOTICES, NOTICE_PRIORITY), (CLAUSES, CLAUSE_PRIORITY)) for label, regex in table]
    base = [Rule(label, phrase, tuple(sorted(phrase.split())), BASE_PRIORITY, True) for phrase, label in BASE_PHRASES]
    return (*rules.values(), *bodies, *base)


# --- expressions ---------------------------------------------------------------------------------

def _literal(rules: Sequence[Rule]) -> Column:
    return F.array(*[F.struct(
        F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(f"(?i)(?<= )({r.regex})(?= )").alias("regex"),
        F.array(*[F.lit(k) for k in r.keywords]).cast("array<string>").alias("keywords"),
        F.lit(r.priority).alias("priority"), F.lit(r.base).alias("base")) for i, r in enumerate(rules)])


def _detections(joined: Column, candidates: Column) -> Column:
    """All places of all candidate rules, in sweep order: start, end descending, priority, rule.

    Places are marked in the joined words; marked words then give starts and ends.
    """
    marked = F.transform(candidates, lambda r: F.struct(r.alias("r"), F.split(F.trim(F.regexp_replace(
        joined, r["regex"], F.lit(OPEN + "$1" + CLOSE))), " ").alias("w")))

    def places(x: Column) -> Column:
        starts = F.filter(F.transform(x["w"], lambda w, i: F.when(F.startswith(w, F.lit(OPEN)), i)), F.isnotnull)
        ends = F.filter(F.transform(x["w"], lambda w, i: F.when(F.endswith(w, F.lit(CLOSE)), i + 1)), F.isnotnull)
        r = x["r"]
        return F.zip_with(starts, ends, lambda s, e: F.struct(s, -e, -r["priority"], r["rule"], r["label"],
                                                              r["base"]).cast(DETECTION))

    return F.array_sort(F.flatten(F.transform(marked, places)))


def _unsuppressed(detections: Column, priorities: Sequence[int]) -> Column:
    """Detections that no other of at least their priority contains."""
    levels = sorted(set(priorities), reverse=True)
    state = f"struct<ends:array<int>,full:array<array<{DETECTION}>>,part:array<{DETECTION}>>"
    zero = F.struct(F.array(*[F.lit(-1) for _ in levels]), F.array().cast(f"array<array<{DETECTION}>>"),
                    F.array().cast(f"array<{DETECTION}>")).cast(state)

    def reach(acc: Column, d: Column) -> Column:
        """Furthest end of an earlier detection of at least this priority."""
        return F.greatest(F.lit(-1), F.lit(-1), *[F.when(-d["neg_priority"] <= level, acc["ends"][k]).otherwise(-1)
                                                 for k, level in enumerate(levels)])

    def step(acc: Column, d: Column) -> Column:
        end = -d["neg_end"]
        ends = F.array(*[F.when(-d["neg_priority"] == level, F.greatest(acc["ends"][k], end)).otherwise(acc["ends"][k])
                         for k, level in enumerate(levels)])
        stays = reach(acc, d) < end
        room = F.size(acc["part"]) < BUFFER
        full = F.when(stays & ~room, F.concat(acc["full"], F.array(acc["part"]))).otherwise(acc["full"])
        part = (F.when(~stays, acc["part"]).when(room, F.concat(acc["part"], F.array(d))).otherwise(F.array(d)))
        return F.struct(ends, full, part).cast(state)

    return F.aggregate(detections, zero, step,
                       lambda acc: F.concat(F.flatten(acc["full"]), acc["part"]))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None,
         carry: bool = False) -> DataFrame:
    """Every row with doc_id, n_words, ``found`` (all places) and ``kept`` (those not suppressed).

    Places are structs: start, neg_end, neg_priority (negated, for their order), rule (its number),
    label, base.
    """
    rules = tuple(default_rules() if rules is None else rules)
    src = pick(df, carry=carry, doc_id=id_col, text=text_col)
    rest = [ROW] if carry else []
    words = src.select("doc_id", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), SEPARATORS, " "))
                       .alias("words"), *rest)
    if not all(r.keywords for r in rules):
        raise ValueError("every rule needs a keyword")
    keywords = sorted({k for r in rules for k in r.keywords})
    # one keyword of each rule: a text without any of these has no candidates at all
    anchors = sorted({max(r.keywords, key=lambda k: (len(k), k)) for r in rules})
    words = words.select(
        "doc_id", "words", F.array_intersect(F.split(F.lower("words"), " "), F.lit(keywords)).alias("present"), *rest)
    spaces = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    gated = F.filter(_literal(rules), lambda r: F.forall(
        r["keywords"], lambda k: F.array_contains(F.col("present"), k)))
    places = words.select(
        "doc_id", F.when(F.col("words") == "", 0).otherwise(spaces + 1).cast("long").alias("n_words"),
        F.when(F.arrays_overlap("present", F.lit(anchors)), gated).alias("candidates"), "words", *rest)
    found = places.select("doc_id", "n_words", F.when(
        F.size("candidates") > 0, _detections(F.concat(F.lit(" "), F.col("words"), F.lit(" ")), F.col("candidates")))
        .otherwise(F.array().cast(f"array<{DETECTION}>")).alias("found"), *rest)
    return found.select("doc_id", "n_words", "found", F.when(
        F.size("found") > 0, _unsuppressed(F.col("found"), [r.priority for r in rules]))
        .otherwise(F.col("found")).alias("kept"), *rest)


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_kept.

    ``score`` is the highest priority among the kept and base places, as a share of 100.
    """
    def labels(places: Column) -> Column:
        return F.array_distinct(F.transform(places, lambda d: d["label"]))

    base = scanned.select("*", F.filter("found", lambda d: d["base"]).alias("base"))
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    every = F.array_union(labels(F.col("base")), labels(F.col("kept")))
    best = F.array_max(F.transform(F.concat("base", "kept"), lambda d: -d["neg_priority"])) / 100
    return base.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(labels(F.col("base"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"), F.coalesce(best, F.lit(0.0)).alias("score"),
        F.size("kept").cast("long").alias("n_kept"))
