"""Licence scans: known sentences, and ordered rules over them.

A text is cut into sentences, at punctuation, lines without a letter or digit (as between the
paragraphs of a comment), copyright lines and web addresses; each is normalised (small letters and digits, one space between
words) and looked up among known licence sentences. A sentence that goes over several lines is
looked up whole and, if it is not known, line by line. The identifiers found, in order, are matched
against the rules: a rule's identifiers must come up in its order, others may lie between. All of it
is one projection of SQL functions; the lists are fixed in the code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of tags, as in "SPDX-License-Identifier: MIT".
TAGS = ("MIT", "Apache-2.0", "GPL-3.0-only", "GPL-2.0-only", "BSD-2-Clause", "BSD-3-Clause", "ISC",
        "MPL-2.0", "Unlicense", "GPL-3.0-or-later", "GPL-2.0-or-later", "LGPL-3.0-only",
        "LGPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "AGPL-3.0-only",
        "AGPL-3.0-or-later", "0BSD", "AFL-3.0", "Apache-1.1", "Artistic-2.0", "BSD-4-Clause", "BSL-1.0",
        "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "LPPL-1.3c", "MIT-0", "MPL-1.1",
        "MS-PL", "NCSA", "OFL-1.1", "PostgreSQL", "Python-2.0", "WTFPL", "X11", "Zlib")
#: Tags that say no more than a version; they mean that version only.
BARE_TAGS = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
TAG = "spdx license identifier "
_FREE = ("this {} is free software you can redistribute it and or modify it under the terms of the gnu "
         "{} general public license as published by the free software foundation")
_TERMS = ("you can redistribute it and or modify it under the terms of the gnu {}general public "
          "license as published by the free software foundation")
_LATER = "either version {} of the license or at your option any later version"
#: Notices that go on after "free software;".
GNU = [(name, kind, version) for name, kind, versions in (
    ("gpl", "", ("2", "3")), ("lgpl", "lesser ", ("2.1", "3")), ("agpl", "affero ", ("3",)))
    for version in versions]
#: Sentences of public licence texts and notices.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this "
                 "software and associated documentation files the software to deal in the software "
                 "without restriction including without limitation the rights to use copy modify "
                 "merge publish distribute sublicense and or sell copies of the software and to "
                 "permit persons to whom the software is furnished to do so subject to the "
                 "following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all "
                  "copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied "
             "including but not limited to the warranties of merchantability fitness for a "
             "particular purpose and noninfringement",
    "mit-name": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mit-project": "this project is licensed under the mit license",
    "mit-title": "mit license",
    "apache-header": "licensed under the apache license version 2 0",
    "apache-header-long": "licensed under the apache license version 2 0 the license you may not use "
                          "this file except in compliance with the license",
    "apache-header-named": "licensed under the apache license version 2 0 the license",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-unless": "unless required by applicable law or agreed to in writing software distributed "
                     "under the license is distributed on an as is basis without warranties or "
                     "conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations "
                  "under the license",
    "gpl-3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-2-work": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the "
                "terms of the gnu general public license as published by the free software foundation",
    "gpl-free-3-later": "this program is free software you can redistribute it and or modify it "
                        "under the terms of the gnu general public license as published by the free "
                        "software foundation either version 3 of the license or at your option any "
                        "later version",
    "gpl-free-2-later": "this program is free software you can redistribute it and or modify it "
                        "under the terms of the gnu general public license as published by the free "
                        "software foundation either version 2 of the license or at your option any "
                        "later version",
    "either-3-later": "either version 3 of the license or at your option any later version",
    "either-2-later": "either version 2 of the license or at your option any later version",
    "either-2.1-later": "either version 2 1 of the license or at your option any later version",
    "lgpl-free": _FREE.format("library", "lesser"),
    "lgpl-free-program": _FREE.format("program", "lesser"),
    "lgpl-free-program-3-later": _FREE.format("program", "lesser") + " either version 3 of the license "
                                 "or at your option any later version",
    "lgpl-free-2.1-later": _FREE.format("library", "lesser") + " either version 2 1 of the license or "
                           "at your option any later version",
    "agpl-free": _FREE.format("program", "affero"),
    "lgpl-free-3-later": "this library is free software you can redistribute it and or modify it "
                         "under the terms of the gnu lesser general public license as published by "
                         "the free software foundation either version 3 of the license or at your "
                         "option any later version",
    "agpl-free-3-later": "this program is free software you can redistribute it and or modify it "
                         "under the terms of the gnu affero general public license as published by "
                         "the free software foundation either version 3 of the license or at your "
                         "option any later version",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are "
                 "permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of "
                  "conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list "
                  "of conditions and the following disclaimer in the documentation and or other "
                  "materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be "
                 "used to endorse or promote products derived from this software without specific "
                 "prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with "
                 "or without fee is hereby granted provided that the above copyright notice and this "
                 "permission notice appear in all copies",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license version "
                "2 0",
    "mpl-form-short": "this source code form is subject to the terms of the mozilla public license v",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "spdx": "spdx license identifier",
    "apache-title": "apache license version 2 0 january 2004",
    "gpl-2-title": "gnu general public license version 2 june 1991",
    "gpl-3-title": "gnu general public license version 3 29 june 2007",
    "lgpl-2.1-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl-3-title": "gnu lesser general public license version 3 29 june 2007",
    "agpl-3-title": "gnu affero general public license version 3 19 november 2007",
    "mpl-title": "mozilla public license version 2 0",
    "epl-2-title": "eclipse public license v 2 0",
    "boost-title": "boost software license version 1 0 august 17th 2003",
    "boost-grant": "permission is hereby granted free of charge to any person or organization "
                   "obtaining a copy of the software and accompanying documentation covered by this "
                   "license the software to use reproduce display distribute execute and transmit "
                   "the software and to prepare derivative works of the software and to permit "
                   "third parties to whom the software is furnished to do so all subject to the "
                   "following",
    "boost-header": "distributed under the boost software license version 1 0",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including "
                  "commercial applications and to alter it and redistribute it freely subject to "
                  "the following restrictions",
    "wtfpl-copies": "everyone is permitted to copy and distribute verbatim or modified copies of "
                    "this license document and changing it is allowed as long as the name is changed",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose "
                  "with or without fee is hereby granted",
    "cc0-title": "cc0 1 0 universal",
} | {f"cc-{kind}-{version}-{how}": words.format(kind.replace("-", " "), version.replace(".", " "))
     for kind in ("by", "by-sa", "by-nc", "by-nc-sa", "by-nd", "by-nc-nd")
     for version in ("3.0", "4.0")
     for how, words in (("short", "licensed under cc {} {}"),
                        ("work", "this work is licensed under cc {} {}"),
                        ("tag", "spdx license identifier cc {} {}"))} \
  | {f"{name}-terms": _TERMS.format(kind) for name, kind, _ in GNU} \
  | {f"{name}-terms-{v}-later": f"{_TERMS.format(kind)} {_LATER.format(v.replace('.', ' '))}"
     for name, kind, v in GNU} \
  | {f"spdx-{name.lower()}": TAG + name.lower().replace("-", " ").replace(".", " ")
     for name in (*TAGS, *BARE_TAGS)}

#: (licence, identifiers in order, licences that include this one and take its place)
RULES: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = [
    ("MIT", ("mit-grant", "mit-notice"), ()),
    *(("MIT", (i,), ()) for i in ("mit-name", "mit-under", "mit-project", "mit-title")),
    ("Apache-2.0", ("apache-header",), ()),
    ("Apache-2.0", ("apache-header-long",), ()),
    ("Apache-2.0", ("apache-header-named",), ()),
    ("Apache-2.0", ("apache-may-not", "apache-unless", "apache-see"), ()),
    ("GPL-3.0-only", ("gpl-3-work",), ()),
    ("GPL-2.0-only", ("gpl-2-work",), ()),
    ("GPL-3.0-or-later", ("gpl-free-3-later",), ()),
    ("GPL-3.0-or-later", ("gpl-free", "either-3-later"), ()),
    ("GPL-2.0-or-later", ("gpl-free-2-later",), ()),
    ("GPL-2.0-or-later", ("gpl-free", "either-2-later"), ()),
    ("LGPL-3.0-or-later", ("lgpl-free-3-later",), ()),
    ("LGPL-3.0-or-later", ("lgpl-free-program-3-later",), ()),
    ("LGPL-3.0-or-later", ("lgpl-free", "either-3-later"), ()),
    ("LGPL-3.0-or-later", ("lgpl-free-program", "either-3-later"), ()),
    ("LGPL-2.1-or-later", ("lgpl-free-2.1-later",), ()),
    ("LGPL-2.1-or-later", ("lgpl-free", "either-2.1-later"), ()),
    ("LGPL-2.1-or-later", ("lgpl-free-program", "either-2.1-later"), ()),
    ("AGPL-3.0-or-later", ("agpl-free-3-later",), ()),
    ("AGPL-3.0-or-later", ("agpl-free", "either-3-later"), ()),
    *((f"{name.upper()}-{v if '.' in v else v + '.0'}-or-later", ids, ()) for name, _, v in GNU
      for ids in ((f"{name}-terms", f"either-{v}-later"), (f"{name}-terms-{v}-later",))),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"), ("BSD-3-Clause",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), ()),
    ("ISC", ("isc-grant",), ()),
    ("MPL-2.0", ("mpl-form",), ()),
    ("MPL-2.0", ("mpl-form-short",), ()),
    ("Unlicense", ("unlicense",), ()),
    *((f"CC-{i[3:].rsplit('-', 1)[0].upper()}", (i,), ()) for i in SENTENCES if i.startswith("cc-")),
    *((name, (f"spdx-{name.lower()}",), ()) for name in TAGS),
    *((f"{name}-only", (f"spdx-{name.lower()}",), ()) for name in BARE_TAGS),
    *((name, (i,), ()) for name, i in (
        ("Apache-2.0", "apache-title"), ("GPL-2.0-only", "gpl-2-title"),
        ("GPL-3.0-only", "gpl-3-title"), ("LGPL-2.1-only", "lgpl-2.1-title"),
        ("LGPL-3.0-only", "lgpl-3-title"), ("AGPL-3.0-only", "agpl-3-title"),
        ("MPL-2.0", "mpl-title"), ("EPL-2.0", "epl-2-title"), ("BSL-1.0", "boost-title"),
        ("BSL-1.0", "boost-grant"), ("BSL-1.0", "boost-header"), ("WTFPL", "wtfpl-copies"),
        ("0BSD", "0bsd-grant"), ("CC0-1.0", "cc0-title"))),
    ("Zlib", ("zlib-as-is", "zlib-grant"), ()),
]

#: Every known sentence has one of these; a text without them has none and is not cut.
ANCHORS = ("licens", "permi", "copyright", "redistribut", "warrant", "license", "public domain",
           "free software", "version", "universal")

END = (r"[.;!?]+(\s|$)|:(\s*(\r?\n|$))|\r?\n[^\p{L}\p{N}\n]*\n|https?://\S+"
       r"|(?:[Cc]opyright|COPYRIGHT)[^\p{L}\p{N}\n]+(?:[cC]\)|[0-9]{4})[^\n.;!?]*")
MARK = "\u0001"


def normalise(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _lookup() -> Column:
    return F.create_map(*(F.lit(x) for i, s in SENTENCES.items() for x in (s, i)))


def _of_line(line: Column, known: Column) -> Column:
    """Identifiers of a line: of a known sentence, or of each licence of a tag's expression, as in
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0+"."""
    plain = normalise(line)
    # "+" is an older way to say "or later", whose "or" joins no two licences
    later = F.replace(normalise(F.regexp_replace(line, r"([0-9])\+", "$1 or later")),
                      F.lit(" or later"), F.lit(" orlater"))
    parts = F.split(F.substr(later, F.lit(len(TAG) + 1)), " (or|and|with) ")
    return F.when(plain.startswith(TAG), F.transform(parts, lambda p: known[
        F.concat(F.lit(TAG), F.replace(p, F.lit(" orlater"), F.lit(" or later")))])).otherwise(
        F.array(known[plain]))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = _lookup()
    whole = F.split(F.regexp_replace(text, END, MARK), MARK)
    by_line = F.flatten(F.transform(whole, lambda s: F.when(
        known[normalise(s)].isNotNull() & ~normalise(s).startswith(TAG),
        F.array(known[normalise(s)])).otherwise(
        F.flatten(F.transform(F.split(s, r"\r?\n"), lambda line: _of_line(line, known))))))
    has = F.lit(False)
    low = F.lower(text)
    for a in ANCHORS:
        has = has | low.contains(a)
    return F.when(has, F.filter(by_line, lambda i: i.isNotNull())).otherwise(
        F.array().cast("array<string>"))


def licences(sequence: Column) -> Column:
    """Sorted licences of the rules that a string of identifiers (",a,b,") satisfies."""
    hit = {}
    for name, ids, _ in RULES:
        pattern = "," + ",(?:[^,]+,)*?".join(i.replace(".", r"\.") for i in ids) + ","
        one = sequence.rlike(pattern) if len(ids) > 1 else sequence.contains(f",{ids[0]},")
        hit[name] = hit[name] | one if name in hit else one
    named = []
    for name, found in hit.items():
        for other in {o for other_name, _, by in RULES if other_name == name for o in by}:
            found = found & ~hit[other]
        named.append(F.when(found, name))
    return F.array_sort(F.filter(F.array(*named), lambda n: n.isNotNull()))


def scan(docs: DataFrame) -> DataFrame:
    """The rows of (text, ...) with ``sentence_ids`` and ``licences`` (arrays of string, the latter
    sorted). A null or empty text has neither. A sentence that comes up again is listed again, a
    licence once; of licences that include each other the larger one stands, others stand side
    by side. Rows that repeat come back as often, an empty table gives none. Other columns come
    back; columns named as the new ones are replaced."""
    others = [c for c in docs.columns if c not in ("sentence_ids", "licences")]
    ids = F.coalesce(sentence_ids(F.col("text").cast("string")), F.array().cast("array<string>"))
    found = docs.select(*others, ids.alias("sentence_ids"))
    sequence = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    none = F.array().cast("array<string>")
    return found.withColumn("licences", F.when(F.size("sentence_ids") > 0, licences(sequence))
                            .otherwise(none))
