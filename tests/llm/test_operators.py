"""The text operators next to brute-force versions, on small tables with nulls, ties, repeated rows and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreloom.llm import benchmarks, bpe, chat, language, loser, maxent, near, private, repeats, vectors

WORD = r"[^\x20\x09-\x0D]+"
random.seed(4)
VOCABULARY = {k: ["".join(random.choice(letters) for _ in range(random.randint(2, 7))) for _ in range(300)]
              for k, letters in {"aa": "abcdefgh", "bb": "mnopqrsé"}.items()}


def prose(lang, n):
    return " ".join(random.choice(VOCABULARY[lang]) for _ in range(n))


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


PASSAGE, BASE = prose("aa", 70), prose("aa", 120)


def edited(text, every):
    split = text.split()
    split[::every] = ["x%d" % random.randrange(10**6) for _ in split[::every]]
    return " ".join(split)


TEXTS = (
    [None, "", " \n\t", "one", "One", "a b", "A  B", "!!! 12", "Σας İI <|endoftext|> it's 日本語", "x" * 900, "ab " * 4000]
    + [prose(random.choice(["aa", "bb"]), random.randint(30, 200)) for _ in range(40)]
    + [BASE] * 12 + [edited(BASE, 40) for _ in range(12)]
    + [prose("bb", 20) + " " + PASSAGE + " " + prose("bb", 20) for _ in range(6)]
    + ["mail a.b@c.de now", "a@b.c_d@e.f, 1.2.3.4.5.6.7.8 and 999.1.1.1", "+1 (243) 555-5526 4111 1111 1111 1111",
       "4111111111111111 5500005555555559", "é +44 20 7946 0958 4 1-2", "é" * 300 + prose("bb", 5) + "é" * 300]
)
ROWS = [(n, t, "aa" if t and not set(t) & set("mnopqrs") else "bb" if n % 9 else None, "s", 7, "clash", n) for n, t in enumerate(TEXTS)]
ROWS += [ROWS[-1], ROWS[20], (None, TEXTS[30], "aa", "s", 7, "clash", 0), (None, None, None, None, None, None, None)]
DDL = "doc_id long, text string, lang string, source string, n_chars long, digest string, row long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(ROWS, DDL).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(documents):
    return documents.where(F.lit(False))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def same(got, want):
    assert collections.Counter(got) == collections.Counter(want)


def test_tokens_equal_the_library(documents, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, want = Tokenizer.from_file(path), []
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    same([tuple(r) for r in bpe.round_trip_digest(documents, path).collect()], want)
    assert bpe.round_trip_digest(nothing, path).count() == 0


def test_language(documents, nothing):
    got = language.predict_languages(documents).collect()
    assert len(got) == len(ROWS)
    long_ones = {n: "aa" if set(t) <= set("abcdefgh ") else "bb" for n, t in enumerate(TEXTS[11:51], 11)}
    assert all(r.lang_pred == long_ones[r.doc_id] for r in got if r.doc_id in long_ones)
    assert all(0 <= r.score <= 1 for r in got)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {0, 1, 2, 7, TEXTS.index("4111111111111111 5500005555555559"), TEXTS.index("+1 (243) 555-5526 4111 1111 1111 1111"), None} & und | {0, 1, 2, 7}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert language.predict_languages(nothing).count() == 0


def test_automaton_gives_longest_matches():
    sample = [random.randrange(2, 5) for _ in range(200)]
    table = language.automaton(sample, 5)
    joined = "".join(map(str, sample))
    for _ in range(200):
        probe = [random.randrange(2, 5) for _ in range(12)]
        state, n = 0, 0
        while n < 12 and table[state, probe[n]]:
            state, n = table[state, probe[n]], n + 1
        text = "".join(map(str, probe))
        assert text[:n] in joined and (n == 12 or text[:n + 1] not in joined)


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    def good(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
    return [f"{k}:{m.start()}:{m.end()}" for k in KINDS for m in re.finditer(KINDS[k], text or "") if good(k, m[0])]


def test_private_base_spans(spark, documents, nothing):
    pool = ["a.b@c.de", "@", ".", "+1 (243) 555-5526", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", " ", " ", "-", "é", "12", "_", "+", "5-5", "\n", "😀"]
    texts = ["".join(random.choice(pool) for _ in range(random.randint(1, 30))) for _ in range(400)]
    mixed = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    for frame, source in ((mixed, list(enumerate(texts))), (documents, [r[:2] for r in ROWS])):
        got = private.private_digest(frame).collect()
        same([(r.doc_id, r.base_sha256) for r in got], [(n, sha(",".join(base_spans(t)))) for n, t in source])
        by_id = dict(source)
        for r in got:
            if r.doc_id is not None:
                assert set(base_spans(by_id[r.doc_id])) <= set(r.spans.split(",")) | {""}
                assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(base_spans(by_id[r.doc_id]))
    assert private.private_digest(nothing).count() == 0
    odd = documents.select("doc_id", "text", "digest", F.lit(1).alias("found_id"), F.lit(2).alias("found_spans"), F.lit(3).alias("Found_Digest"))
    assert private.redacted(odd).columns == odd.columns and private.redacted(odd).count() == odd.count()
    hidden = private.redacted(documents.select("doc_id", "text")).where("doc_id = %d" % TEXTS.index("mail a.b@c.de now")).first()
    assert hidden.text == "mail <email> now"


CLEAN = ["part 243 456-7890 in stock", "serial 99 4000000000000002x", "id 4000 0000 0000 0002 1", "write jo [at] example.com", "version 1.2.3"]
SEEN = ["call +1 (243) 555-5526 now", "card 4111 1111 1111 1111 ok", "mail a.b@c.de", "host 10.0.0.1 up"]


@pytest.mark.parametrize("copies", [25, 400])
def test_an_odd_row_changes_no_span(spark, copies):
    """Clean texts stay clean, with and without a row that holds a wrong address."""
    texts = [f"{t} {n}." for n in range(copies) for t in SEEN[n % 4:n % 4 + 1]] + CLEAN
    found = []
    for more in ([], ["host 999.1.1.1"]):
        rows = spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")
        got = {r.doc_id: r.spans for r in private.private_digest(rows).collect()}
        found.append([got[n] for n in range(len(texts))])
        assert all(got[len(texts) - 1 - k] == "" for k in range(len(CLEAN)))
    assert found[0] == found[1]


def test_spans_are_added_where_both_halves_bear_it_out(spark, monkeypatch):
    """Addresses written with [at]: kept where like ones are addresses, not in the middle of other words."""
    monkeypatch.setattr(private, "LEAST_SUPPORT", 10)
    random.seed(3)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    texts = [f"write {word()}.{word()}@{word()}.com today {n}" for n in range(120)] + [f"see {word()} [at] {word()}.com_{word()} {n}" for n in range(120)]
    texts += [f"write {word()} [at] {word()}.com today" for _ in range(5)] + [f"see {word()} [at] {word()}.com there" for _ in range(5)]
    got = {r.doc_id: r.spans for r in private.private_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[n] for n in range(120)) and not any(got[n] for n in range(120, 240))
    assert [got[n] for n in range(240, 245)] == ["email:6:26"] * 5 and not any(got[n] for n in range(245, 250))


def test_chat_round_trip(spark):
    bits = ["[INST]", "[/INST]", "</s>", "\\", "\\e", "\\i", "e", "s", " ", "[", "<", "/INST]", "é"]
    rows = [(c, t, random.choice(["user", "assistant", "[INST]", None]), "".join(random.choice(bits) for _ in range(random.randint(0, 9))) or None)
            for c in (1, 2, 3, None) for t in (0, 1, 1, None)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    chats = chat.format_chats(table)
    assert chats.where("not identical").count() == 0
    got = {r.conv_id: r for r in chat.read_back(chats).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert got[conv].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in own)) and got[conv].n_turns == len(own)
        assert got[conv].loss_sha256 == sha("".join(x for _, _, r, x in own if r == "assistant"))
    for r in chats.collect():  # the mask selects the escaped assistant texts
        assert all(r.formatted[s.end:s.end + 4] == "</s>" and r.formatted[:s.start].endswith("[/INST]") for s in r.loss_spans)
    assert chat.read_back(chat.format_chats(table.where("conv_id = 99"))).count() == 0


def test_scores(documents, nothing):
    got = maxent.score_documents(documents).collect()
    tokens = [[*words(r[1]), "\n"] for r in ROWS]
    out = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in ROWS]
    counts = collections.Counter(w for t, o in zip(tokens, out) if not o for w in t)
    total, distinct = sum(counts.values()), len(counts)
    want = [(r[0], o, len(t), sum(counts[w] > 0 for w in t), total,
             round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t), 5)) for r, o, t in zip(ROWS, out, tokens)]
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got], want)
    assert all(r.score < 0 for r in got) and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert maxent.score_documents(nothing).count() == 0


def components(ids, links):
    root = {i: i for i in ids}
    for _ in range(len(ids)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_near_duplicates(documents, nothing):
    sets = []
    for r in ROWS:
        w = words(r[1])
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)]) if w else frozenset())
    keys = [r[0] if r[0] is not None else 10**6 + k for k, r in enumerate(ROWS)]
    links = [(keys[a], keys[b]) for a in range(len(ROWS)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = components(keys, links)
    want = []
    for key, row, s in zip(keys, ROWS, sets):
        component = root[key] if root[key] < 10**6 else None
        want.append((row[0], len(s), component, component == row[0]))
    same([tuple(r) for r in near.near_duplicates(documents).collect()], want)
    assert near.near_duplicates(nothing).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    near_to = rng.normal(size=16)
    rows = [(n, (near_to + 0.05 * rng.normal(size=16)).tolist(), n % 2, "x") for n in range(60)]
    rows += [(100 + n, rng.normal(size=16).tolist(), 0, "x") for n in range(60)] + [(200 + n, rows[0][1], 0, "x") for n in range(5)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(300 + n, v, 0, "x") for n, v in enumerate(odd)] + [(310, rows[0][1], None, "x"), (311, rows[0][1][:8], 0, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, class string")

    def usable(v):
        return v and None not in v and np.isfinite(np.linalg.norm(v)) and np.linalg.norm(v) > 0

    links = [(a[0], b[0]) for k, a in enumerate(rows) for b in rows[:k] if a[2] == b[2] is not None and usable(a[1]) and usable(b[1])
             and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98]
    degree, root = collections.Counter(x for pair in links for x in pair), components([r[0] for r in rows], links)
    got = vectors.near_vectors(table).collect()
    assert sum(r.n_links for r in got) >= 0.9 * 2 * len(links) and all(r.n_links <= degree[r.vec_id] for r in got)
    same([(r.vec_id, r.component_id, r.kept) for r in got], [(i, root[i], root[i] == i) for i in root])
    assert vectors.near_vectors(table.where(F.lit(False))).count() == 0


def test_benchmark_copies(spark, documents, nothing):
    item = " ".join(words(PASSAGE)[:40])
    items = [(1, item), (2, None), (3, ""), (4, prose("aa", 30)), (5, "abc"), (None, item)]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, row int")
    extra = [(900, "start " + edited(item, 15) + " end"), (901, " ".join(item.split()[:20])), (902, item.upper().replace(" ", ", "))]
    texts = documents.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = benchmarks.contaminated(texts, benchmark).collect()
    holders = {n for n, t in enumerate(TEXTS) if t and PASSAGE in t} | {900, 902}
    assert {(r.doc_id, r.item_id) for r in got} == {(n, i) for n in holders for i in (1, None)}
    assert all(r.score == pytest.approx(1) for r in got if r.doc_id != 900)
    assert benchmarks.contaminated(nothing, benchmark).count() == 0
    assert benchmarks.contaminated(texts, benchmark.where(F.lit(False))).count() == 0


def test_alignment_equals_plain_dynamic_programming():
    for _ in range(30):
        a, b = [np.array([random.randrange(4) for _ in range(random.randint(1, 12))]) for _ in range(2)]
        best, table = 0.0, np.zeros((len(a) + 1, len(b) + 1))
        for i in range(len(a)):
            for j in range(len(b)):
                step = 1.0 if a[i] == b[j] else -benchmarks.PENALTY
                table[i + 1, j + 1] = max(0, table[i, j] + step, table[i, j + 1] - benchmarks.PENALTY, table[i + 1, j] - benchmarks.PENALTY)
                best = max(best, table[i + 1, j + 1])
        assert benchmarks.align([a], [b])[0][0] == pytest.approx(best)


def kept_bytes(raws):
    counts = collections.Counter(r[s:s + 200] for r in raws for s in range(len(r) - 199))
    for raw in raws:
        gone = np.zeros(len(raw) + 1, int)
        for s in range(len(raw) - 199):
            if counts[raw[s:s + 200]] > 1:
                gone[s] += 1
                gone[s + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        yield int(gone.sum()), spans, sha(np.frombuffer(raw, np.uint8)[~gone].tobytes())


@pytest.mark.parametrize("kind", ["documents", "edges"])
def test_repeats(spark, documents, nothing, kind):
    rows = [r[:2] for r in ROWS]
    if kind == "edges":  # matches of 199 to 230 bytes, at text borders, inside one text, and between differing neighbours
        shared = prose("aa", 400)
        rows = [(n, (prose("bb", 9) if n % 3 else "") + shared[k:k + 199 + n % 32] + (prose("bb", 9) if n % 2 else ""))
                for n, k in enumerate(random.randrange(0, 900) for _ in range(70))]
        rows += [(100, shared[:250] + "é" + shared[100:400]), (101, "z" * 450), (102, "z" * 199)]
    table = documents if kind == "documents" else spark.createDataFrame(rows, "doc_id long, text string")
    raws = [(t or "").encode() for _, t in rows]
    want = [(i, len(raw), *k) for (i, _), raw, k in zip(rows, raws, kept_bytes(raws))]
    same([tuple(r) for r in repeats.digest(table).collect()], want)
    assert repeats.digest(nothing).count() == 0


def test_loser_tree_merges_in_order():
    runs = [sorted(random.choice("ab") * 3 + "".join(random.choice("ab") for _ in range(5)) for _ in range(random.randint(0, 40))) for _ in range(7)]
    coded = [loser.front_code([s.encode() for s in sorted(set(r))]) for r in runs]
    place, out, before = [0] * 7, [], ""
    for common, k in loser.merge(coded, 8):
        text = sorted(set(runs[k]))[place[k]]
        place[k] += 1
        assert common == len(before) - len(before[loser.shared_prefix(before.encode(), text.encode(), 0):]) if before else common == 0
        out.append(text)
        before = text
    assert out == sorted(s for r in runs for s in set(r))
