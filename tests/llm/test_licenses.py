"""License scans over hand-written notices."""

import random
import re

from pyspark.sql import functions as F

from scoreloom.llm import licenses

CASES = [
    (None, "", ""), ("", "", ""), ("No notice here. None at all.", "", ""),
    ("x y. Licensed under the Apache License, Version 2.0. z", "ApacheVer:2.0", "Apache-2.0"),
    ("// Released under\tthe MIT License.", "MITname:", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPLVer:3", "GPL-3"),
    ("Licensed under the GNU General Public License, version 2.\nEither version 2 or (at your option) any later version.",
     "GPLVer:2,OrLater:2", "GPL-2-or-later"),
    ("Licensed under CC BY-NC 4.0.", "CC:BY-NC-4.0", "CC-BY-NC-4.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy.\n"
     "The above copyright notice and this permission notice shall be included.\nThe software is provided \"as is\", without warranty of any kind.",
     "MITgrant:,MITnotice:,AsIs:", "MIT"),
    ("Your license is your own.", "UNKNOWN", ""),
    ("Released under the MIT License. Released under the MIT License.\nLicensed under the Apache License, Version 2.0.",
     "MITname:,MITname:,ApacheVer:2.0", "MIT,Apache-2.0"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public\n"
     " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.",
     "LGPLterms:,OrLater:2.1", "LGPL-2.1-or-later"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version.", "AGPLterms:,OrLater:3", "AGPL-3-or-later"),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. */", "MPLVer:2.0", "MPL-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
     "the above\ncopyright notice and this permission notice appear in all copies.", "ISCgrant:,ISCnotice:", "ISC"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.", "ISCgrant:", "0BSD"),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", "BSLVer:1.0,UNKNOWN", "BSL-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense:", "Unlicense"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
     "EPLVer:2.0", "EPL-2.0"),
    ("Text: Creative Commons Attribution 4.0 International", "CCBYVer:4.0", "CC-BY-4.0"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported; CC0 1.0 Universal", "CCBYNCSAVer:3.0,CC0Ver:1.0", "CC-BY-NC-SA-3.0,CC0-1.0"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND CC-BY-4.0", "SPDX:(MIT OR APACHE-2.0) AND CC-BY-4.0", "SPDX-(MIT OR APACHE-2.0) AND CC-BY-4.0"),
    ("SPDX-License-Identifier: MIT" + " OR MIT" * 20_000, "SPDX:MIT" + " OR MIT" * 20_000, "SPDX-MIT" + " OR MIT" * 20_000),
    ("long " * 50000 + ". Released under the MIT License.", "MITname:", "MIT"),
]


def test_scan(spark):
    rows = [(n, t, "x") for n, (t, _, _) in enumerate(CASES)] * 2 + [(None, "Released under the MIT License.", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    want = [(n, i, x) for n, (_, i, x) in enumerate(CASES)] * 2 + [(None, "MITname:", "MIT")]
    got = [(r.doc_id, r.sentence_ids, r.licenses) for r in licenses.license_table(table).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert licenses.license_table(table.where(F.lit(False))).count() == 0


def plain_scan(text):
    """The scan again, in Python, a sentence at a time."""
    if not re.search(licenses.SPEAKS, text or ""):
        return []
    lines = re.sub(r"(?im)^[^\w\n]*(?:(?:rem|dnl)\b[^\w\n]*)?", "", re.sub(r"\r\n?", "\n", text))
    said = []
    for sentence in re.split(r"\n{2,}|(?<=[.!?;])(?<!\b[vV]\.)\s+", lines):
        if not re.search(licenses.SPEAKS, sentence):
            continue
        bare = re.sub(r"(?<!\w)-|-(?!\w)", " ", re.sub(r"[^\w.-]+|_|(?<![0-9])\.|\.(?![0-9])", " ", sentence.lower()))
        bare, at, found = " ".join(bare.split()), 0, []
        while hits := [(m.start(), k, m, name) for k, (p, name) in enumerate(licenses.SENTENCES) if (m := re.compile(licenses.dashed(p)).search(bare, at))]:
            _, _, m, name = min(hits, key=lambda h: h[:2])
            found.append((name, re.sub(" +", "-", m[1].rstrip()).upper() if m.re.groups else ""))
            at = m.end()
        said += found or ([("UNKNOWN", None)] if re.search("licen[sc]e", bare) else [])
    return said


def plain_rules(said):
    out, left = [], list(said)
    for names, licence in licenses.RULES:
        k = 0
        while k < len(left):
            part = left[k:k + len(names)]
            if [p and p[0] for p in part] == names:
                version = next((v for n, v in part if n.endswith("Ver") or n in ("OrLater", "CC")), "")
                out.append(licence.replace("{}", version))
                left[k:k + len(names)] = [None]
            k += 1
    return list(dict.fromkeys(out))


def test_equals_a_plain_scan(spark):
    """Notices cut into sentences, shuffled and mixed, against the same rules in Python."""
    random.seed(8)
    pool = [x for t, _, _ in CASES if t and len(t) < 1000 and "SPDX" not in t for x in re.split(r"(?<=[.!?;])(?<!v\.)\s+", t)]
    texts = [random.choice(["\n", " ", "\n\n"]).join(random.choice(pool) for _ in range(random.randint(1, 7))) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.license_table(table).collect():
        said = plain_scan(texts[r.doc_id])
        assert r.sentence_ids == ",".join(n if v is None else f"{n}:{v}" for n, v in said), texts[r.doc_id]
        assert r.licenses == ",".join(plain_rules(said)), texts[r.doc_id]
