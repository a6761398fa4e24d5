"""Cases that an operator once left out."""

import random

import numpy as np

from scoreloom.llm import benchmarks, language, licenses, maxent


def test_edited_copy_beside_a_verbatim_one(spark):
    item = [f"w{n}" for n in range(40)]
    copy = [f"x{n}" if n in (2, 11, 20, 29, 37) else w for n, w in enumerate(item)]
    texts = spark.createDataFrame([(1, " ".join(item)), (2, "so it goes " + " ".join(copy)), (3, " ".join(item[:9]) + " end")], "doc_id long, text string")
    found = benchmarks.contaminated(texts, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, round(r.score, 4)) for r in found) == [(1, 7, 1.0), (2, 7, 0.8438)]
    # edits every 7 to 9 words
    for step in (7, 8, 9):
        copy = [f"x{n}" if n % step == step - 1 else w for n, w in enumerate(item)]
        texts = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(copy))], "doc_id long, text string")
        found = benchmarks.contaminated(texts, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
        assert sorted(r.doc_id for r in found) == [1, 2]


def test_languages_of_many_letters():
    dice = random.Random(3)
    # zh and zz share all their letters and differ in their words only; zz has the smaller sample
    letters = {"ja": [chr(c) for c in range(0x3042, 0x3090)], "ko": [chr(0xAC00 + 29 * k) for k in range(300)],
               "zh": [chr(0x4E00 + 7 * k) for k in range(400)], "zz": [chr(0x4E00 + 7 * k) for k in range(400)],
               "un": [chr(0x20000 + 5 * k) for k in range(300)], "de": list("abcdeinrstuü")}
    vocabulary = {n: ["".join(dice.choices(letters[n], k=dice.randint(2, 5))) for _ in range(200)] for n in letters}
    prose = {n: lambda k, n=n: " ".join(dice.choices(vocabulary[n], k=k)) for n in letters}
    model = language.Languages({n: [prose[n](60) for _ in range(8 if n == "zz" else 24)] for n in letters})
    texts, want = zip(*[(prose[n](25), n) for n in letters for _ in range(10)], strict=True)
    names, score = model.predict(list(texts))
    assert names == list(want)
    assert min(score) > 0
    # three symbols for each letter from U+3000 up
    code, lens = language.spelled(*language.code_points(["a日é", "", "\U00020005 Ａ"]))
    assert lens.tolist() == [5, 0, 7] and code.max() < language.SPELLED and code[0] == ord("a") and code[4] == ord("é")


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{0} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
"""
ENDORSE = """{0} Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from this
   software without specific prior written permission.
"""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{0} either version {1} of the License, or
(at your option) any later version.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, to use, copy, sublicense, and/or sell copies
of it, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND.
"""


def commented(mark, text):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.splitlines())


def test_wrapped_notices(spark):
    cases = [
        (BSD.format("1."), "BSD-2-Clause"), (commented(" *", BSD.format("-") + ENDORSE.format("-")), "BSD-3-Clause"),
        (commented(";;", BSD.format("2.") + ENDORSE.format("3.")).replace("\n", "\r\n"), "BSD-3-Clause"),
        (GPL.format(";", 2), "GPL-2-or-later"), (commented("//", GPL.format(",", 3)), "GPL-3-or-later"), (commented("dnl", GPL.format(";", 2)), "GPL-2-or-later"),
        (commented("#", MIT), "MIT"),
        ("# SPDX-License-Identifier: MIT\n# Copyright and all", "SPDX-MIT"),
        ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */\nint x;", "SPDX-GPL-2.0-ONLY WITH LINUX-SYSCALL-NOTE"),
        ("<!-- SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0+ -->", "SPDX-(MIT OR APACHE-2.0) AND GPL-2.0+"),
        ("(SPDX-License-Identifier: MIT)", "SPDX-MIT"),
        ("SPDX-License-Identifier: MIT, also licensed under the Apache License, Version 2.0", "Apache-2.0,SPDX-MIT"),
        ("Licensed under CC-BY-4.0.", "CC-BY-4.0"), ("licensed under\nCC-BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
        # lines without stops are joined, and none of their notices is lost
        ("Released under the MIT License\nLicensed under the Apache License, Version 2.0\nand more", "MIT,Apache-2.0"),
        ("Either version 2 or (at your\n * option) any later", ""),
    ]
    table = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_table(table).collect()}
    assert [got[n].licenses for n in range(len(cases))] == [x for _, x in cases]
    assert got[3].sentence_ids == "GPLterms:,OrLater:2"


def test_every_context_feature_learns_from_every_token(spark):
    texts = spark.createDataFrame([(n, " ".join(f"w{k * (n + 1) % 97}" for k in range(300))) for n in range(4)], "doc_id long, text string")
    vocabulary = maxent.learn_vocabulary(maxent.word_counts(texts))
    model = maxent.train(texts.coalesce(1), vocabulary)
    coded = maxent.Coded([r.text.encode() for r in texts.collect()], maxent.Ranks(vocabulary))
    rows, _ = model.classes(coded.context)
    assert all((model.by_class[row] != 0).any(axis=1).all() for row in rows)


def test_context_tells_rare_words_apart(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 1500)
    # 3000 pairs: the second word always follows the first; all but 1024 words are others
    texts = spark.createDataFrame([(n, " ".join(f"a{k} b{k}" for k in range(n % 30, 3000, 30))) for n in range(600)], "doc_id long, text string")
    vocabulary = maxent.learn_vocabulary(counts := maxent.word_counts(texts).cache())
    model = maxent.train(texts.coalesce(1), vocabulary)
    ranks = maxent.Ranks(vocabulary)
    known = {r.word for r in counts.collect()}

    def log10(text):
        c = maxent.Coded([text.encode()], ranks)
        return (model.log10(c.context, c.group, c.member, c.leaf) - (c.group == maxent.OTHER) * vocabulary.others_in(c.leaf))[1]

    rare = [k for k in range(3000) if f"b{k}".encode() not in vocabulary.words[:1024] and f"b{k}" in known]
    gain = [log10(f"a{k} b{k}") - log10(f"zz b{k}") for k in rare[:200]]
    assert sum(gain) / len(gain) > 0.1
    # probabilities of all leaves and classes sum to one
    c = maxent.Coded([b"a1"], ranks)
    everywhere = np.arange(len(vocabulary.leaf_mass))
    total = 10 ** model.log10(np.repeat(c.context[:, :1], len(everywhere), axis=1), np.full(len(everywhere), maxent.OTHER), 0 * everywhere, everywhere)
    assert abs(total.sum() - model.classes(c.context[:, :1])[1][0, maxent.OTHER]) < 1e-4
    assert vocabulary.levels == 2 and (vocabulary.leaf_mass >= 1).all()


def test_training_tasks_follow_the_text_not_the_files(spark, monkeypatch):
    asked = []
    changes = maxent.weight_changes
    monkeypatch.setattr(maxent, "weight_changes", lambda documents, *more: asked.append(documents.rdd.getNumPartitions()) or changes(documents, *more))
    texts = spark.createDataFrame([(n, f"some words {n}") for n in range(80)], "doc_id long, text string").repartition(40)
    vocabulary = maxent.learn_vocabulary(maxent.word_counts(texts))
    maxent.train(texts, vocabulary)
    monkeypatch.setattr(maxent, "TASK_TOKENS", 1)
    maxent.train(texts, vocabulary)
    assert asked == [1] * maxent.ROUNDS + [40] * maxent.ROUNDS


def test_gradient_steps_average_over_a_rows_tokens():
    some = np.random.default_rng(5)
    row = np.minimum(some.geometric(0.02, 4096) ** 2, 5000).astype(np.uint16)
    gradient, weights = some.normal(size=(4096, 33)).astype(np.float32), np.zeros((8192, 33), np.float32)
    maxent.Model.ascend(weights, row, gradient)
    total, times = np.zeros((8192, 33)), np.bincount(row, minlength=8192)
    np.add.at(total, row, gradient.astype(float))
    assert times.max() > 50 and np.allclose(weights, maxent.RATE * total / (1 + times)[:, None], atol=1e-4)


def test_scores_by_factors_are_those_of_the_softmaxes(spark):
    texts = spark.createDataFrame([(n, " ".join(f"w{k * (n + 7) % 4001}" for k in range(2000))) for n in range(20)], "doc_id long, text string")
    vocabulary = maxent.learn_vocabulary(maxent.word_counts(texts))
    model = maxent.train(texts.coalesce(1), vocabulary)
    model.by_class *= 10  # some sums of products get very small
    c = maxent.Coded([r.text.encode() for r in texts.limit(3).collect()], vocabulary.ranks())
    every = np.arange(len(c.group))
    classes, members = model.classes(c.context)[1], model.members(c.context, np.minimum(c.group, maxent.CLASSES - 1))[1]
    want = classes[every, c.group].astype(float) * np.where(c.group < maxent.OTHER, members[every, c.member], 1)
    rest = np.flatnonzero(c.group == maxent.OTHER)
    assert 0 < len(rest) < len(every)
    for _, p, branch in model.branches(c.context[:, rest], c.leaf[rest]):
        want[rest] *= p[np.arange(len(rest)), branch]
    got = model.log10(c.context, c.group, c.member, c.leaf)
    factor, bias = model.factors["class"]
    assert (factor[model.class_rows(c.context)].prod(axis=0) * bias).sum(axis=1).min() < maxent.SMALL
    assert np.isfinite(got).all() and np.allclose(got, np.log10(np.maximum(want, 1e-30)), atol=1e-3)
    before = got.sum()
    model.learn(c.context[:, :500], c.group[:500], c.member[:500], c.leaf[:500])
    assert model.log10(c.context, c.group, c.member, c.leaf).sum() != before  # new weights, new factors


def test_word_counts_split_as_plain_bytes_do(spark, monkeypatch):
    texts = [None, "", " \x0bA\x1c b\x85c d e \x00f  ", "\t\n", "É ß\x0cİ a a", "a\r\nB b"]
    table = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    want: dict[str, int] = {"\n": len(texts)}
    for word in b"\n".join((t or "").encode().lower() for t in texts).split():
        want[word.decode()] = want.get(word.decode(), 0) + 1
    for counted in (maxent.COUNTED, 0):
        monkeypatch.setattr(maxent, "COUNTED", counted)
        assert {r.word: r.n for r in maxent.word_counts(table).collect()} == want
