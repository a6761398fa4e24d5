"""License scan by sentence rules, in DataFrame functions.

1. Comment marks at line starts go, and texts are cut into sentences at blank lines and at stops before white space (but for that of
   "v. 2"), so that a sentence may be wrapped over lines.  A line with an SPDX tag is a sentence of its own.  Sentences are normalised: lower
   case, punctuation gone but for dashes inside names, one space between words; known sentences take a dash for a space.
2. A normalised sentence gives the identifiers of all known licence sentences in it, in order; a version one names becomes part of
   it.  All other sentences that speak of licences at all are UNKNOWN; the rest say nothing.
3. Rules are tried in order on the sequence of identifiers: the first rule whose identifiers follow one another (other
   sentences may not come between) gives its licence, and its sentences are used up.  Sentences left over give no licence.

The rule base knows some forty sentences: the grants and headers of common licences, not their full texts.

A null or empty text has no sentences.  Tags may have any number of operands.  Repeated rows are rows of their own.  Texts without a word that licence sentences need
are not cut at all.  A licence found twice counts once; licences come in the order of the rules.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences, as patterns over normalised text, and their identifiers; the first that fits counts.
SENTENCES = [
    (r"licensed under the apache license version ([0-9.]+)", "ApacheVer"),
    (r"you may not use this file except in compliance with the license", "ApacheUse"),
    (r"you may obtain a copy of the license at", "ApacheCopy"),
    (r"(?:licensed|released) under the (?:terms of the )?mit license", "MITname"),
    (r"permission is hereby granted free of charge to any person obtaining a copy", "MITgrant"),
    (r"the above copyright notice and this permission notice shall be included", "MITnotice"),
    (r"licensed under the gnu (?:lesser|library) general public license version ([0-9.]+)", "LGPLVer"),
    (r"licensed under the gnu affero general public license version ([0-9.]+)", "AGPLVer"),
    (r"licensed under the gnu general public license version ([0-9.]+)", "GPLVer"),
    (r"terms of the gnu (?:lesser|library) general public license as published by the free software foundation", "LGPLterms"),
    (r"terms of the gnu affero general public license as published by the free software foundation", "AGPLterms"),
    (r"terms of the gnu general public license as published by the free software foundation", "GPLterms"),
    (r"either version ([0-9.]+) (?:of the license )?or at your option any later version", "OrLater"),
    (r"subject to the terms of the mozilla public license v(?:ersion)? ?([0-9.]+)", "MPLVer"),
    (r"terms of the eclipse public license (?:v|version )? ?([0-9.]+)", "EPLVer"),
    (r"distributed under the boost software license version ([0-9.]+)", "BSLVer"),
    (r"licensed under the sil open font license version ([0-9.]+)", "OFLVer"),
    (r"licensed under the eupl (?:v|version )? ?([0-9.]+)", "EUPLVer"),
    (r"subject to the terms of the common development and distribution license", "CDDLterms"),
    (r"permission to use copy modify and (?:or )?distribute this software(?: and its documentation)? for any purpose with or without fee is hereby granted", "ISCgrant"),
    (r"the above copyright notice and this permission notice appear in all copies", "ISCnotice"),
    (r"permission is granted to anyone to use this software for any purpose", "ZlibGrant"),
    (r"altered source versions must be plainly marked as such", "ZlibMarked"),
    (r"this is free and unencumbered software released into the public domain", "Unlicense"),
    (r"licensed under (?:a )?(?:cc|creative commons) ((?:by|0)[a-z -]*[0-9.]+)", "CC"),
    (r"creative commons attribution non ?commercial share ?alike ([0-9.]+)", "CCBYNCSAVer"),
    (r"creative commons attribution non ?commercial no ?deriv(?:ative)?s ([0-9.]+)", "CCBYNCNDVer"),
    (r"creative commons attribution non ?commercial ([0-9.]+)", "CCBYNCVer"),
    (r"creative commons attribution share ?alike ([0-9.]+)", "CCBYSAVer"),
    (r"creative commons attribution no ?deriv(?:ative)?s ([0-9.]+)", "CCBYNDVer"),
    (r"creative commons attribution ([0-9.]+)", "CCBYVer"),
    (r"cc0 ([0-9.]+) universal", "CC0Ver"),
    (r"redistribution and use in source and binary forms with or without modification are permitted", "BSDpre"),
    (r"redistributions of source code must retain the above copyright notice", "BSDsource"),
    (r"redistributions in binary form must reproduce the above copyright notice", "BSDbinary"),
    (r"all advertising materials mentioning features or use of this software must display the following acknowledgement", "BSDads"),
    (r"neither the name of .*? may be used to endorse or promote products", "BSDendorse"),
    (r"the software is provided as is without warranty of any kind", "AsIs"),
]
# Sequences of identifiers and the licence each stands for, longer ones before their parts.
RULES = [
    (["MITgrant", "MITnotice", "AsIs"], "MIT"), (["MITgrant", "MITnotice"], "MIT"), (["MITgrant"], "MIT"), (["MITname"], "MIT"),
    (["ApacheVer", "ApacheUse", "ApacheCopy"], "Apache-{}"), (["ApacheVer"], "Apache-{}"),
    (["BSDpre", "BSDsource", "BSDbinary", "BSDads", "BSDendorse"], "BSD-4-Clause"),
    (["BSDpre", "BSDsource", "BSDbinary", "BSDendorse"], "BSD-3-Clause"), (["BSDpre", "BSDsource", "BSDbinary"], "BSD-2-Clause"),
    (["GPLterms", "OrLater"], "GPL-{}-or-later"), (["GPLVer", "OrLater"], "GPL-{}-or-later"), (["GPLVer"], "GPL-{}"),
    (["LGPLterms", "OrLater"], "LGPL-{}-or-later"), (["LGPLVer", "OrLater"], "LGPL-{}-or-later"), (["LGPLVer"], "LGPL-{}"),
    (["AGPLterms", "OrLater"], "AGPL-{}-or-later"), (["AGPLVer", "OrLater"], "AGPL-{}-or-later"), (["AGPLVer"], "AGPL-{}"),
    (["MPLVer"], "MPL-{}"), (["EPLVer"], "EPL-{}"), (["BSLVer"], "BSL-{}"), (["OFLVer"], "OFL-{}"), (["EUPLVer"], "EUPL-{}"),
    (["CDDLterms"], "CDDL"), (["ISCgrant", "ISCnotice"], "ISC"), (["ISCgrant"], "0BSD"),
    (["ZlibGrant", "ZlibMarked"], "Zlib"), (["ZlibGrant"], "Zlib"), (["Unlicense"], "Unlicense"),
    (["CC"], "CC-{}"), (["CCBYNCSAVer"], "CC-BY-NC-SA-{}"), (["CCBYNCNDVer"], "CC-BY-NC-ND-{}"), (["CCBYNCVer"], "CC-BY-NC-{}"),
    (["CCBYSAVer"], "CC-BY-SA-{}"), (["CCBYNDVer"], "CC-BY-ND-{}"), (["CCBYVer"], "CC-BY-{}"), (["CC0Ver"], "CC0-{}"), (["SPDX"], "SPDX-{}"),
]
SPEAKS = (r"(?i)licen[sc]e|permission|redistribution|warranty|at[\W_]+your[\W_]+option|endorse|the[\W_]+above[\W_]+copyright|"
          r"unencumbered|creative[\W_]+commons|cc0|altered[\W_]+source|advertising[\W_]+materials|eupl")
#: A tag's expression, in which upper and lower case are alike.  Possessive repeats take a step for each operand and no stack.
SPDX = r"(?i)spdx[ -]license[ -]identifier[:\s]\s*"
SPDX_ID = r"\(*+[a-z0-9](?:[a-z0-9.+:-]*[a-z0-9+])?\)*+"
SPDX_TAG = rf"{SPDX}({SPDX_ID}(?:\s++(?:or|and|with)\s++{SPDX_ID})*+)"
UNKNOWN = "UNKNOWN"
BORDER = "|"


def normalised(sentence: Column) -> Column:
    """Lower case; letters, digits, and the stops and dashes inside versions and names stay, other runs are one space."""
    bare = F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}.-]+|(?<![0-9])\.|\.(?![0-9])", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?<![\p{L}\p{N}])-|-(?![\p{L}\p{N}])", " "), r"\s+", " "))


def sentences(text: Column) -> Column:
    """Sentences without the comment marks of their lines; lines within a sentence are joined."""
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"(?im)^[^\p{L}\p{N}\n]*+(?:(?:rem|dnl)\b[^\p{L}\p{N}\n]*+)?", "")
    return F.split(F.regexp_replace(lines, rf"(?m)^(.*{SPDX}.*)$", "\n\n$1\n\n"), r"\n{2,}|(?<=[.!?;])(?<!\b[vV]\.)\s+")


def dashed(pattern: str) -> str:
    """`pattern` with a dash allowed for each space outside brackets."""
    return re.sub(r" (?![^\[]*\])", "[ -]", pattern)


KNOWN = [(dashed(pattern), name) for pattern, name in SENTENCES]
ANY_KNOWN = "|".join(f"(?:{pattern})" for pattern, _ in KNOWN)


def identifier(known: Column) -> Column:
    """Identifier:version of a known sentence."""
    found = None
    for pattern, name in KNOWN:
        version = F.regexp_replace(F.rtrim(F.regexp_extract(known, pattern, 1) if "(" in pattern.replace("(?:", "") else F.lit("")), " +", "-")
        value = F.concat(F.lit(f"{name}:"), F.upper(version))
        found = F.when(known.rlike(pattern), value) if found is None else found.when(known.rlike(pattern), value)
    return found


def tag(expression: Column) -> Column:
    """Identifier:expression of an SPDX tag; a bracket that closes nothing is left out."""
    closed = F.when(F.contains(expression, F.lit("(")), expression).otherwise(F.regexp_replace(expression, r"\)", ""))
    return F.concat(F.lit("SPDX:"), F.upper(F.regexp_replace(closed, r"\s+", " ")))


def identifiers(sentence: Column) -> Column:
    """The identifiers of a sentence: its tags' and known sentences', else UNKNOWN or none by whether it speaks of licences."""
    plain = F.transform(F.array(normalised(sentence)), lambda s: F.when(
        s.rlike(ANY_KNOWN), F.transform(F.regexp_extract_all(s, F.lit(ANY_KNOWN), F.lit(0)), identifier)).when(
        s.rlike(r"licen[sc]e"), F.array(F.lit(UNKNOWN))).otherwise(F.array().cast("array<string>")))
    tags = F.transform(F.regexp_extract_all(sentence, F.lit(SPDX_TAG), F.lit(1)), tag)
    return F.when(sentence.rlike(SPDX_TAG), F.concat(tags, F.filter(F.flatten(plain), lambda x: x != UNKNOWN))).otherwise(F.flatten(plain))


def scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with sentence_ids (array, in order) and licenses (array, in order of the rules, each once)."""
    body = F.coalesce(F.col(text), F.lit(""))
    said = F.flatten(F.transform(F.filter(sentences(body), lambda s: s.rlike(SPEAKS)), identifiers))
    ids = F.when(body.rlike(SPEAKS), said).otherwise(F.array().cast("array<string>"))
    found = documents.withColumn("sentence_ids", ids)
    # |id:version|id:version|, from which rules take their sequences, first rule first
    left = F.concat(F.lit(BORDER), F.array_join(F.transform("sentence_ids", lambda x: F.concat(x, F.lit(BORDER))), BORDER))
    licenses = []
    for names, licence in RULES:
        sequence = r"\|" + r"\|\|".join(f"{n}:([^|]*)" for n in names) + r"\|"
        which = next((k for k, n in enumerate(names, 1) if n.endswith("Ver") or n in ("OrLater", "CC", "SPDX")), 0) if "{}" in licence else 0
        hits = F.regexp_extract_all(left, F.lit(sequence), F.lit(which))
        licenses.append(F.transform(hits, _named(licence, which)))
        left = F.regexp_replace(left, sequence, BORDER)
    return found.withColumn("licenses", F.when(F.size("sentence_ids") > 0, F.array_distinct(F.concat(*licenses))).otherwise(
        F.array().cast("array<string>")))


def _named(licence: str, which: int):
    before, _, after = licence.partition("{}")
    return lambda version: F.concat(F.lit(before), version, F.lit(after)) if which else F.lit(licence)


def license_table(documents: DataFrame) -> DataFrame:
    """doc_id, n_sentences (that speak of licences), sentence_ids and licenses, comma-joined."""
    found = scan(documents.select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"))
