"""Personal data by candidate gradient boosting, in DataFrame functions only.

1. Base rules find e-mail addresses, IP addresses, card and phone numbers; what they find is always kept.
2. Looser generators propose further spans of the same kinds, which may overlap.
3. Candidates that a base rule found count as positive.  Of the others those that their surroundings or their kind's rule contradict
   count as negative: in the middle of a longer word or run of digits, a wrong check sum or range.  What is left is open.  The trees do
   not see what made the label, only the format of the span and the word before it.
4. Candidates are counted by feature vector, so boosted trees learn from a table whose size the features bound, whatever the number
   of documents.  They learn from the documents of one half (by a digest of the text), and the threshold of each kind comes from the
   other half: the lowest score from which nearly all labelled candidates are positive.  Open candidates from there on that overlap
   no base span of their kind are added.

A kind with fewer than LEAST_SUPPORT positives or negatives in either half has no threshold, and nothing of it is added: a few odd
rows decide nothing.  Which open candidates are added depends on the whole table otherwise, as with any learned model.

Positions are code points, ends exclusive.  A null text is empty: no spans.  Repeated rows are rows of their own.  Texts are scanned
whole.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.session import staged

KINDS = ["email", "ip", "card", "phone"]
#: Same matches as the plain forms of these rules, written so that no text makes them backtrack: possessive repeats, and starts
#: only where a longer match could not have begun.  Card runs outside 13 to 19 digits, which would be dropped, don't match.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates: parts of longer runs, other ways of writing.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+\.[0-9]{1,3}+\.[0-9]{1,3}+\.[0-9]{1,3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}+[\x20.-]?)?(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: Texts without these hold no match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TREES, DEPTH = 10, 3
PRECISION, LEAST_SUPPORT = 0.995, 20
FEATURES = ["kind_no", "digits", "separators", "plus", "parens", "repeated", "size_band", "cue"]
# Words before a span that speak of persons and machines, and of things that are numbered.
CUES = [
    "tel phone telephone call fax mobile cell sms contact card visa mastercard payment mail email write reply ip host address server".split(),
    "id no nr number part serial item order ref reference version sku model code isbn page case lot build".split(),
]
CUE_ROOM = 24  # characters before a span in which the word is looked for


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """Array of (start, match) for the non-overlapping matches, left to right."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern), lambda x: F.length(x))
    step = F.zip_with(F.slice(between, 1, F.size(between) - 1), found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,match:string>>").alias("out"))
    scan = F.aggregate(
        step, start,
        lambda acc, x: F.struct(
            (acc.at + x.gap + F.length(x.match)).alias("at"),
            F.concat(acc.out, F.array(F.struct((acc.at + x.gap).alias("start"), x.match.alias("match")))).alias("out")),
        lambda acc: acc.out)
    return F.when(possible & text.rlike(pattern), scan).otherwise(F.array().cast("array<struct<start:int,match:string>>"))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.length(digits_of(match)).between(13, 19) & F.call_function("luhn_check", digits_of(match))
    if kind == "phone":
        return F.length(digits_of(match)).between(9, 15)
    return F.lit(True)


def cue_of(before: Column) -> Column:
    """The kind of the last word in `before`: 0 none, 1 and 2 as in CUES, 3 any other."""
    word = F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}\p{N}]*$", 1))
    return F.when(word == "", 0).when(word.isin(CUES[0]), 1).when(word.isin(CUES[1]), 2).otherwise(3)


def spans(text: Column, kind: str, pattern: str, keep_all: bool) -> Column:
    """Array of spans: kind_no, start, end, match, and what the surroundings say: doubtful (contradicted), cue."""
    need = NEEDS[kind] if not keep_all or kind != "email" else "at"
    if kind == "phone" and keep_all:
        need = None
    possible = F.lit(True) if need is None else F.contains(text, F.lit(need))

    def span(m: Column) -> Column:
        end = m.start + F.length(m.match)
        room = F.least(m.start, F.lit(CUE_ROOM))
        before, after = F.substr(text, m.start - room + 1, room), F.substr(text, end + 1, F.lit(2))
        inside = before.rlike(r"[\p{L}\p{N}_]$|[0-9][\x20.-]$") | after.rlike(r"^[\p{L}\p{N}_]|^[\x20.-][0-9]")
        return F.struct(F.lit(KINDS.index(kind)).alias("kind_no"), m.start.alias("start"), end.alias("end"), m.match.alias("match"),
                        (inside | ~valid(kind, m.match)).alias("doubtful"), cue_of(before).alias("cue"))

    found = matches(text, pattern, possible)
    return F.transform(found if keep_all else F.filter(found, lambda m: valid(kind, m.match)), span)


def overlaps(a: Column, b: Column) -> Column:
    return (a.kind_no == b.kind_no) & (a.start < b.end) & (b.start < a.end)


def with_features(candidates: DataFrame) -> DataFrame:
    """Small integers that describe a candidate's format, and the word before it."""
    match = F.col("c.match")
    digits, distinct = digits_of(match), F.size(F.array_distinct(F.split(digits_of(match), "")))
    return candidates.withColumns({
        "kind_no": F.col("c.kind_no"),
        "digits": F.least(F.length(digits), F.lit(20)),
        "separators": F.least(F.length(F.regexp_replace(match, r"[^\x20.@-]", "")), F.lit(8)),
        "plus": F.contains(match, F.lit("+")).cast("int"),
        "parens": F.contains(match, F.lit("(")).cast("int"),
        "repeated": (distinct <= 2).cast("int"),
        "size_band": F.least((F.length(match) / 8).cast("int"), F.lit(8)),
        "cue": F.col("c.cue"),
    })


def candidates_of(documents: DataFrame) -> DataFrame:
    """row, doc_id, digest, base (spans), loose (further candidates) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text"), F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row"))
    own = F.col("text")
    base = F.concat(*[F.array_sort(spans(own, k, BASE[k], False)) for k in KINDS])
    loose = F.concat(*[spans(own, k, LOOSE[k], True) for k in KINDS])
    return rows.select("row", "doc_id", "digest", base.alias("base"), loose.alias("loose"))


def added_spans(found: DataFrame) -> DataFrame:
    """row, c: the candidates that the model adds to the base spans."""
    in_base = lambda c: F.exists("base", lambda b: overlaps(b, c))
    same = lambda c: F.exists("base", lambda b: (b.kind_no == c.kind_no) & (b.start == c.start) & (b.end == c.end))
    each = found.where((F.size("base") > 0) | (F.size("loose") > 0)).select("row", F.pmod("digest", F.lit(2)).alias("half"), F.explode(F.concat(
        F.transform("base", lambda c: F.struct(c.alias("c"), F.lit(1).alias("label"))),
        F.transform(F.filter("loose", lambda c: ~same(c)), lambda c: F.struct(
            c.alias("c"), F.when(c.doubtful, F.lit(0)).when(in_base(c), F.lit(None)).otherwise(F.lit(-1)).alias("label"))),
    )).alias("x")).select("row", "half", "x.c", "x.label").where(F.col("label").isNotNull())
    each = with_features(each)
    counts = [F.count_if((F.col("label") == label) & (F.coalesce("half", F.lit(0)) == half)).alias(f"{name}_{half}")
              for label, name in ((1, "positive"), (0, "negative")) for half in (0, 1)]
    vectors = staged(each.groupBy(*FEATURES).agg(*counts, F.count_if(F.col("label") == -1).alias("open")), "pii-vectors")
    names = [f"{name}_{half}" for name in ("positive", "negative") for half in (0, 1)]
    totals = vectors.groupBy("kind_no").agg(F.sum("open").alias("open"), *[F.sum(n).alias(n) for n in names])
    kinds = [r.kind_no for r in totals.collect() if r.open and min(r[n] for n in names) >= LEAST_SUPPORT]  # a row for each kind at most
    if not kinds:  # nothing to learn from, or nothing to decide
        return each.where(F.lit(False)).select("row", "c")
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(vectors.where(F.col("kind_no").isin(kinds)))
    labelled = assembled.select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("positive_0").cast("double").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), F.col("negative_0").cast("double").alias("weight")))).alias("x")).select("features", "x.*")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.5, weightCol="weight", seed=1).fit(labelled.where("weight > 0"))
    scored = staged(model.transform(assembled).select(
        *FEATURES, "positive_1", "negative_1", "open", vector_to_array("probability")[1].alias("score")), "pii-scores")
    above = Window.partitionBy("kind_no").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0)
    positive, both = F.sum("positive_1").over(above), F.sum(F.col("positive_1") + F.col("negative_1")).over(above)
    limits = scored.withColumn("good", (positive >= LEAST_SUPPORT) & (positive >= PRECISION * both)).where("good").groupBy("kind_no").agg(
        F.min("score").alias("limit"))
    chosen = scored.where("open > 0").join(limits, "kind_no").where("score >= limit").select(*FEATURES)
    # at most one row per feature vector, a number that the features bound
    return each.where("label = -1").join(F.broadcast(chosen), FEATURES).select("row", "c")


def find_private(documents: DataFrame) -> DataFrame:
    """doc_id, digest of the text, base and spans (kind_no, start, end) of every document; spans holds the base ones and what the model adds."""
    found = staged(candidates_of(documents), "pii-candidates")
    slim = lambda c: F.struct(c.kind_no.alias("kind_no"), c.start.alias("start"), c.end.alias("end"))
    extra = added_spans(found).groupBy("row").agg(F.sort_array(F.collect_list(slim(F.col("c")))).alias("extra"))
    # of overlapping additions the first stays, of those that start together the shorter
    disjoint = F.aggregate("extra", F.array().cast("array<struct<kind_no:int,start:int,end:int>>"), lambda acc, x: F.when(
        F.exists(acc, lambda y: overlaps(x, y)), acc).otherwise(F.concat(acc, F.array(x))))
    base = F.transform("base", slim)
    return found.join(extra, "row", "left").select("doc_id", "digest", base.alias("base"), F.sort_array(
        F.concat(base, F.coalesce(disjoint, F.array().cast("array<struct<kind_no:int,start:int,end:int>>")))).alias("spans"))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as make it new to `df`."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def redacted(documents: DataFrame) -> DataFrame:
    """`documents` with the spans found replaced in `text`; all rows and columns stay, whatever the columns are called."""
    own, digest, found = (free_name(documents, name) for name in ("found_id", "found_digest", "found_spans"))
    items = find_private(documents).where(F.size("spans") > 0)
    # rows that are equal in id and text have equal spans; a null id counts as a value
    once = items.groupBy(F.col("doc_id").alias(own), F.col("digest").alias(digest)).agg(F.first("spans").alias(found))
    same = [F.col("doc_id").eqNullSafe(F.col(own)), F.xxhash64("text") == F.col(digest)]
    joined = documents.join(once, same, "left")
    text = F.when(F.col(found).isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col(found)))
    return joined.withColumn("text", text).select(*documents.columns)


def written(items: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", F.get(names, s.kind_no), s.start, s.end)), ",")


def private_digest(documents: DataFrame) -> DataFrame:
    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s.kind_no == number)).cast("long").alias(f"n_{KINDS[number]}")

    return find_private(documents).select(
        "doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(text: Column, items: Column) -> Column:
    """The text with every span (kind_no, start, end) replaced by its kind in angle brackets; overlapping spans merge."""
    ordered = F.array_sort(F.transform(items, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind_no.alias("kind_no"))))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda acc, s: F.when(s.start < acc.at, F.struct(F.greatest(acc.at, s.end).alias("at"), acc.out.alias("out"))).otherwise(
        F.struct(s.end.alias("at"), F.concat(acc.out, F.array(F.substr(text, acc.at + 1, s.start - acc.at), F.get(names, s.kind_no))).alias("out")))
    done = F.aggregate(ordered, first, step)
    rest = F.concat(F.array_join(done["out"], ""), F.substr(text, done["at"] + 1))
    return F.when(F.size(items) > 0, rest).otherwise(text)


