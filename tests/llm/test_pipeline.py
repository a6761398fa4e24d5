"""The stages on the smallest tables, each next to what its operator says."""

import itertools
import re

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near copies", "benchmark", "private data", "tokens"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == corpus_pipeline.COLUMNS
        rows = {r.doc_id: r.text for r in after.collect()}
        if name == "language":
            assert set(rows) == {i for i, t in texts.items() if any(map(str.isalpha, t or ""))}
        if name == "benchmark":
            assert not any(item in text for item in items for text in rows.values())
            assert all(any(item in texts[i] for item in items) for i in set(texts) - set(rows))
        if name == "private data":
            assert set(rows) == set(texts) and not any("@mail" in t for t in rows.values())
        texts, docs = rows, spark.createDataFrame(after.collect(), after.schema)
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in tokens.collect()} == set(texts)


def test_stages_keep_odd_rows(spark):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 1), (None, "The only one of its kind here", "en", "s", 3, 1),
            (3, "Hello there my friend", "en", "s", 3, 1), (3, "Hello there my friend", "en", "s", 3, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 3]


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def test_without_labels_only_texts_without_letters_go(spark):
    docs = spark.createDataFrame([(1, "Some words", None, "s", 10), (2, "12 !", None, "s", 4), (3, None, None, None, None), (4, "日本", None, "s", 2)], DDL)
    assert sorted(r.doc_id for r in corpus_pipeline.with_language(spark, docs, FOLDER).collect()) == [1, 4]


def test_near_copies_are_told_apart_by_row(spark):
    """Copies and texts of their own that share ids, equal rows, and the least id of a group."""
    base = " ".join(f"word{n}" for n in range(120))
    near = base.replace("word60 ", "")
    two_words_only = " ".join(w if n % 20 else f"x{n}" for n, w in enumerate(base.split()))  # 0.8 by two words, not by five
    rows = [(7, base, "en", "s", 1), (7, near, "en", "s", 1), (7, "a text of its own " * 3, "en", "s", 1), (5, near + " end", "en", "t", 2),
            (9, base, "en", "s", 1), (9, base, "en", "s", 1), (None, base, "en", "s", 1), (8, two_words_only, "en", "s", 1), (6, "", "en", "s", 0),
            (6, None, "en", "s", 0), (6, None, "en", "s", 0), (6, "one", "en", "s", 0)]
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, DDL), FOLDER).collect()
    want = [(5, near + " end"), (7, "a text of its own " * 3), (8, two_words_only), (6, ""), (6, None), (6, "one")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, want))


def test_empty_documents(spark):
    docs = spark.createDataFrame([], DDL)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []


def test_near_copies_equal_brute_force(spark):
    """The documents that stay, next to all pairs of five-word sets."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    texts = {r.doc_id: r.text for r in docs.collect()}

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, min(len(words), 1)))}

    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = corpus_pipeline.one_of_each(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i in texts if find(i) == i) and len(got) < len(texts)
