import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tutela.llm import licences, revisits

SCHEMA = ("record_id long, url string, ts timestamp, kind string, status int, "
          "headers map<string,string>, payload_digest string")


@pytest.mark.parametrize("url, canonical", [
    ("http://www.A.org/x/?utm_source=f#top", "a.org/x"), ("https://a.org/x", "a.org/x"),
    ("https://u:p@A.org:443/X?b=2&a=1&gclid=9", "a.org/X?a=1&b=2"), ("a.org", "a.org"),
    (" http://m.a.org/ ", "m.a.org"), ("http://a.org/?page=2", "a.org?page=2"), ("", "")])
def test_canonical_urls(spark, url, canonical):
    got = spark.createDataFrame([(url,)], "u string").select(revisits.canonical_url(F.col("u")))
    assert got.first()[0] == canonical


def brute(rows):
    out = Counter()
    for i, url, ts, kind, _, headers, digest in rows:
        if kind != "revisit":
            continue
        before = [r for r in rows if r[3] == "response" and r[4] == 200 and url is not None
                  and ts is not None and r[1] == url and r[2] is not None and r[2] < ts]
        if not before:
            out[i, None, "no earlier response", None] += 1
            continue
        of = max(before, key=lambda r: (r[2], r[0] is not None, r[0]))
        mine, theirs = headers or {}, of[5] or {}
        tags = (mine.get("etag"), theirs.get("etag"))
        dates = (mine.get("last-modified"), theirs.get("last-modified"))
        agrees = None
        for a, b in (dates, tags):
            if a is not None and b is not None:
                agrees = a.removeprefix("W/") == b.removeprefix("W/")
        if digest is not None and of[6] is not None:
            agrees = False if digest != of[6] else True if agrees is None else agrees
        name = {None: "no validator", True: "resolved", False: "validator mismatch"}[agrees]
        merged = None
        if agrees:
            merged = theirs | {k: v for k, v in mine.items() if k in revisits.PERMITTED}
            merged = tuple(sorted(merged.items()))
        out[i, of[0], name, merged] += 1
    return out


def test_resolution_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        hot = rng.random() < 0.4  # one URL has much of the table
        url = "a.org/hot" if hot else f"a.org/{rng.randrange(20)}"
        ts = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(0, 200))
        headers = {k: rng.choice(vs) for k, vs in {
            "etag": ["1", "W/1", "2"], "last-modified": ["d1", "d2"], "vary": ["x", "y"],
            "content-type": ["text/html", "text/plain"]}.items() if rng.random() < 0.7}
        kind = rng.choice(["response", "revisit"])
        rows.append((i, url if rng.random() > 0.03 else None, ts if rng.random() > 0.03 else None,
                     kind, rng.choice([200, 200, 301]) if kind == "response" else 304,
                     headers if rng.random() > 0.05 else None,
                     rng.choice(["p", "q", None])))
    rows += [rows[5], rows[5], (None, "a.org/1", datetime(2024, 1, 3), "revisit", 304, None, None)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("outcome", F.lit("clash"))
    for seconds, most in ((3600, 50_000), (10 ** 9, 50_000), (10 ** 9, 7), (36_000, 2)):
        got = Counter((r.record_id, r.refers_to, r.outcome,
                       tuple(sorted(r.headers.items())) if r.headers is not None else None)
                      for r in revisits.resolve(table, seconds, most).collect())
        assert got == brute(rows)
    assert revisits.resolve(table.limit(0)).collect() == []


# ------------------------------------------------------------------- licences --
def test_full_blocks_are_cut_by_count(spark):
    start = datetime(2024, 1, 1)
    rows = [("hot", start + timedelta(seconds=7 * i)) for i in range(3000)] + [
        (f"u{i}", start) for i in range(50)] + [("old", datetime(1969, 12, 31, 23, 59))]
    table = spark.createDataFrame(rows, "canonical string, ts timestamp")
    cut = revisits._blocks(table, 6 * 3600, 100)
    most = cut.groupBy("canonical", "block").count().agg(F.max("count")).first()[0]
    assert most <= 110 and cut.count() == 3051 and cut.columns == ["canonical", "ts", "block"]
    order = [r.block for r in cut.filter("canonical = 'hot'").orderBy("ts").collect()]
    assert order == sorted(order)
    assert cut.filter("canonical = 'old'").first().block == -revisits.SPANS


def test_lists_are_in_normal_form_and_every_sentence_has_an_anchor(spark):
    known = spark.createDataFrame(list(licences.SENTENCES.items()), "id string, s string")
    assert known.filter(licences.normalise(F.col("s")) != F.col("s")).count() == 0
    assert all(any(a in s for a in licences.ANCHORS) for s in licences.SENTENCES.values())
    assert len(set(licences.SENTENCES.values())) == len(licences.SENTENCES)
    assert {i for _, ids, _ in licences.RULES for i in ids} <= set(licences.SENTENCES)


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


@pytest.mark.parametrize("text, found", [
    ("Some prose.\nReleased under the MIT License.", ["MIT"]),
    ("no full stop before\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
    ("x. LICENSED under CC BY-NC 4.0!\nMIT License", ["CC-BY-NC-4.0", "MIT"]),
    (BSD, ["BSD-2-Clause"]), (BSD + NAMES, ["BSD-3-Clause"]),
    ("\n".join(reversed(BSD.split("\n"))), []),
    ("SPDX-License-Identifier: BSD-3-Clause\n", ["BSD-3-Clause"]),
    ("not released under the MIT License at all", []), ("", []), (None, [])])
def test_rules(docs, text, found):
    table = docs([text]).withColumn("licences", F.lit("clash"))
    assert licences.scan(table).first().licences == found


APACHE = """Copyright 2020 Some Body

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """The tool
Copyright (c) 2019 A Body and others

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
GPL = """tool.py - does a thing
Copyright (C) 2021 Some Body

This {1} is free software{2} you can redistribute it and/or modify
it under the terms of the GNU {3}General Public License as published by
the Free Software Foundation{4} either version {0} of the License, or
(at your option) any later version."""


@pytest.mark.parametrize("mark", ["# ", "// ", " * "])
@pytest.mark.parametrize("text, found", [
    (APACHE, "Apache-2.0"), (APACHE[APACHE.index("you may not"):], "Apache-2.0"),
    (MIT, "MIT"), (GPL.format(3, "program", ":", "", ","), "GPL-3.0-or-later"),
    (GPL.format(2, "program", ";", "", ";"), "GPL-2.0-or-later"),
    (GPL.format("2.1", "library", ";", "Lesser ", ";"), "LGPL-2.1-or-later"),
    (GPL.format(3, "program", ":", "Affero ", ","), "AGPL-3.0-or-later"),
    ("Copyright (c) 2020 Body\n" + MIT[MIT.index("Permission"):], "MIT")])
def test_commented_headers(docs, mark, text, found):
    lines = "\n".join(mark.rstrip() if not line else mark + line for line in text.split("\n"))
    assert licences.scan(docs([f"import os\n{lines}\n\nx = 1"])).first().licences == [found]


@pytest.mark.parametrize("tag", ["GPL-3.0-or-later", "LGPL-2.1-only", "AGPL-3.0-or-later"])
def test_tags(docs, tag):
    assert licences.scan(docs([f"# SPDX-License-Identifier: {tag}\nx"])).first().licences == [tag]
    # a sentence on the line of a copyright notice stays
    assert licences.scan(docs(["Copyright 2020 X. Released under the MIT License."])) \
        .first().licences == ["MIT"]


def test_order_of_sentences_matters(docs):
    parts = [licences.SENTENCES[i] for i in ("bsd-source", "bsd-grant", "bsd-binary")]
    assert licences.scan(docs([". ".join(parts)])).first().licences == []
    assert licences.scan(docs([])).collect() == []


@pytest.mark.parametrize("tag, found", [
    ("MIT OR Apache-2.0", ["Apache-2.0", "MIT"]), ("(MIT AND BSD-3-Clause)", ["BSD-3-Clause", "MIT"]),
    ("GPL-2.0+", ["GPL-2.0-or-later"]), ("GPL-3.0", ["GPL-3.0-only"]), ("0BSD", ["0BSD"]),
    ("CC0-1.0", ["CC0-1.0"]), ("GPL-3.0-or-later OR MIT", ["GPL-3.0-or-later", "MIT"]),
    ("LGPL-2.1+ OR (MPL-2.0 AND Zlib)", ["LGPL-2.1-or-later", "MPL-2.0", "Zlib"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0-only"]), ("BSL-1.0", ["BSL-1.0"]),
    ("LicenseRef-own OR MIT", ["MIT"]), ("LicenseRef-own", [])])
def test_tag_expressions(docs, tag, found):
    for text in (f"// SPDX-License-Identifier: {tag}", f"/* SPDX-License-Identifier: {tag} */\nint x;",
                 f"# a file\n# SPDX-License-Identifier: {tag}\n# more"):
        assert licences.scan(docs([text])).first().licences == found


@pytest.mark.parametrize("text, found", [
    ("        Apache License\n   Version 2.0, January 2004\n  http://www.apache.org/licenses/\n",
     ["Apache-2.0"]),
    ("  GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n Copyright (C) 2007 Free",
     ["GPL-3.0-only"]),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is", ["BSL-1.0"]),
    ("This software is provided 'as-is', without any express or implied warranty. In no event\n"
     "will it. Permission is granted to anyone to use this software for any purpose,\nincluding "
     "commercial applications, and to alter it and redistribute it\nfreely, subject to the "
     "following restrictions:\n", ["Zlib"])])
def test_heads_of_texts(docs, text, found):
    assert licences.scan(docs([text])).first().licences == found


def test_long_and_repeated_texts_are_scanned_whole(docs):
    long = "word " * 300_000 + "\nSPDX-License-Identifier: MIT\n"
    got = licences.scan(docs([(1, long), (1, long), (2, "a")]).withColumn("licences", F.lit(3)))
    assert sorted((r.doc_id, tuple(r.licences)) for r in got.collect()) == [
        (1, ("MIT",)), (1, ("MIT",)), (2, ())]
