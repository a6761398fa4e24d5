"""Linking article titles to companies.

A company can only match where its name stands in the title as a whole word, so every run of
letters in the name is a run of letters in the title.  That turns the title x company comparison
into a hash join on one run of the name, the one that the fewest titles hold; the literal check
follows on the few candidates.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.text import clean_title
from scoreloom.operators.joins import lookup
from scoreloom.operators.keyed import first_per_key
from scoreloom.session import discard, staged

# Match threshold, what counts as a short name, names that are common words.
THRESHOLD = 80
SHORT_NAME = 6
COMMON_WORDS = ["OPTION", "FOCUS", "DIRECT", "CAPITAL", "CONTACT", "VISION"]

LETTER = r"a-zA-ZÀ-ɏ"
LETTERS = rf"[{LETTER}]+"
NO_LETTERS = rf"[^{LETTER}]+"
PIECE = 3
#: A token that more than a SHARE-th of all title tokens are is dealt to several tasks, in proportion.
SHARE = 256


def _runs(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def _pieces(title: Column) -> Column:
    """All pieces of one to three characters of the letterless parts, marked '#'.

    Only names without a single Latin letter are looked up by these.
    """
    parts = F.filter(F.transform(_runs(title, NO_LETTERS), lambda r: F.trim(r)), lambda r: F.length(r) > 0)
    lengths = F.array(*[F.lit(n) for n in range(1, PIECE + 1)])

    def cut(part: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(part))
        return F.flatten(F.transform(starts, lambda i: F.transform(lengths, lambda n: F.substr(part, i, n))))

    return F.transform(F.flatten(F.transform(parts, cut)), lambda p: F.concat(F.lit("#"), F.trim(p)))


def title_tokens(title: Column, with_pieces: Column) -> Column:
    """The letter runs of a title, and the pieces of its other parts if some name needs them."""
    runs = F.transform(_runs(title, LETTERS), F.lower)
    return F.array_distinct(F.when(with_pieces, F.concat(runs, _pieces(title))).otherwise(runs))


def name_tokens(name: Column) -> Column:
    """The letter runs of a name; for a name without letters its first characters."""
    runs = F.array_distinct(F.transform(_runs(name, LETTERS), F.lower))
    bare = F.concat(F.lit("#"), F.trim(F.substring(F.trim(name), 1, PIECE)))
    return F.when(F.size(runs) > 0, runs).when(F.length(F.trim(name)) > 0, F.array(bare)).otherwise(F.array().cast("array<string>"))


def marked(text: Column) -> Column:
    """Lower case, with a mark on both sides of each letter run.

    A name that begins and ends with letters stands in a title as a whole word exactly where the
    marked name is a part of the marked title.
    """
    return F.lower(F.regexp_replace(text, f"({LETTERS})", "\u0001$1\u0002"))


def whole_word(name: Column) -> Column:
    """Pattern for the literal name with no letter next to it."""
    literal = F.concat(F.lit(r"\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    return F.concat(F.lit(f"(?iu)(?<![{LETTER}])"), literal, F.lit(f"(?![{LETTER}])"))


def distinct_words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"(?U)\s+")), "")


def words(text: Column) -> Column:
    return F.array_sort(distinct_words(text))


def common_subsequence(short: Column, text: Column) -> Column:
    """Length of the longest common subsequence of `text` and a string of at most SHORT_NAME characters.

    Bit by bit: a zero at place k says that the sequence grows at the short string's k-th character.
    One step for each character of the text, each a few operations on a whole number.
    """
    full = (1 << SHORT_NAME) - 1

    def step(row: Column, char: Column) -> Column:
        held = F.lit(0)
        for k in range(SHORT_NAME):
            held = held + F.when(F.substring(short, k + 1, 1) == char, 1 << k).otherwise(0)
        both = row.bitwiseAND(held)
        return (row + both).bitwiseOR(row - both).bitwiseAND(full)

    row = F.aggregate(F.filter(F.split(text, ""), lambda x: x != ""), F.lit(full), step)
    return SHORT_NAME - F.bit_count(row)


def _ratio(shared: Column, a: Column, b: Column) -> Column:
    """Twice the characters shared over both lengths, in percent."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 100.0).otherwise(200.0 * shared / both)


def with_words(titles: DataFrame, threshold: float) -> DataFrame:
    """Add what scores need of a `cleaned` title, once per title.

    `_spaced` is the title in lower case with one space around each word.  `_few` are its distinct
    words if they are so few characters that a short name can reach the threshold by them, else NULL.
    """
    most = int(SHORT_NAME * (200 / max(threshold, 1) - 1))
    held = distinct_words(F.col("cleaned"))  # sorted only where they are few
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower("cleaned"), r"(?U)\s+", " "), F.lit(" "))
    return titles.withColumn("_spaced", spaced).withColumn("_few", F.when(F.length(F.array_join(held, " ")) <= most, F.array_sort(held)))


def match_scores(candidates: DataFrame) -> DataFrame:
    """Add `score` to pairs (of `with_words`) whose name already stands in the title as a whole word.

    A long name is then a part of the title: 100.  So is a short name whose words are words of the
    title.  Of the others ("lisi" in "lisi:") the score is the best similarity of the shared words
    and the rest of the name, the shared words and the rest of the title, and the shared words alone;
    the shared words begin both others, so they are the common subsequence with them.
    """
    short = F.length("name") <= SHORT_NAME
    parts = candidates.withColumn("_name", F.when(short, words(F.col("name")))).withColumn(
        "_common", F.filter("_name", lambda w: F.contains("_spaced", F.concat(F.lit(" "), w, F.lit(" ")))))
    core, first, second = (F.array_join(x, " ") for x in (
        F.col("_common"), F.concat("_common", F.array_except("_name", "_common")), F.concat("_common", F.array_except("_few", "_common"))))
    some = F.size("_common") > 0
    with_title = F.when(F.col("_few").isNull(), 0.0).when(some & (F.size(F.array_except("_few", "_common")) == 0), 100.0).otherwise(
        F.greatest(_ratio(common_subsequence(first, second), first, second), F.when(some, _ratio(F.length(core), core, second))))
    score = F.when(~short | some & (F.size("_common") == F.size("_name")), F.lit(100.0)).otherwise(
        F.greatest(with_title, F.when(some, _ratio(F.length(core), core, first))))
    return parts.withColumn("score", score)


def _by_word(titles: DataFrame, with_pieces: Column, threshold: float) -> DataFrame:
    """The `tokens` of each `cleaned` title, first the `alone` ones that are also words between white space; `few` says
    whether a short name that is no word of the title may still reach the threshold."""
    read = with_words(titles, threshold).withColumn("_tokens", title_tokens(F.col("cleaned"), with_pieces))
    held = F.split(F.trim("_spaced"), " ")
    alone, others = F.array_intersect("_tokens", held), F.array_except("_tokens", held)
    return read.select("_key", "copies", F.concat(alone, others).alias("tokens"), F.size(alone).alias("alone"),
                       (F.col("_few").isNotNull() | F.lit(threshold <= 0)).alias("few"))


def _blocks(names: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The names (with `tokens`) and the titles (with `tokens`), each by (token, salt) of one token per name.

    A name goes by the token that the fewest titles hold; names with a token that no title holds
    cannot match.  A token is dealt to as many salts as it is frequent, for which its names are
    repeated: a salt holds about a SHARE-th of all title tokens at most.  Titles get the token's `place`.
    """
    tokens = titles.select(*[c for c in titles.columns if c != "tokens"], F.posexplode("tokens").alias("place", "token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))  # partial counts first: no hot key
    total = counts.agg(F.sum("n")).scalar()
    salts = F.ceil(F.col("n") * SHARE / total).cast("int")
    wanted = staged(names.select("name", F.explode("tokens").alias("token")).join(counts, "token", "left").groupBy("name").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("token")).alias("length"), "token")).alias("rarest")
    ).select("name", "rarest.token", "rarest.n").where("n > 0").withColumn("salts", salts).drop("n"), "rarest")
    named = names.drop("tokens").join(wanted, "name").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    frequent = F.broadcast(wanted.where("salts > 1").select("token", "salts").distinct())  # fewer than SHARE
    dealt = tokens.join(frequent, "token", "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("_key"), F.col("salts"))).cast("int"))
    return named.drop("salts"), dealt.drop("salts")


def entity_link(
    entries: DataFrame, referential: DataFrame, threshold: float = THRESHOLD, blocklist: list = COMMON_WORDS,
) -> DataFrame:
    """Add matched_name, match_score, isin, ticker_bourso; unmatched entries stay with NULLs.

    `referential` is (name, isin, ticker_bourso, ordinal); equal scores go to the lowest ordinal, which
    may be of any type that sorts.  Titles are linked once however often they repeat.  Tokens travel
    with the title's digest, not its text.

    A name that is one run of letters stands in a title exactly where the run is a token of it, so it
    is settled without the text: it scores 100 if it is long, or a word of the title.  Nothing scores
    more, so of all other names only those of a lower ordinal than a title's first settled name are
    looked for in its text.
    """
    letters = F.col("name").rlike(f"[{LETTER}]")
    edges = F.col("name").rlike(rf"^[{LETTER}]") & F.col("name").rlike(rf"[{LETTER}]$")
    names = (
        first_per_key(referential, ["name"], [F.col("ordinal")])  # a repeated name means its first row
        .where(~F.upper("name").isin(blocklist))
        .select("name", F.struct("name", "isin", "ticker_bourso").alias("company"), "ordinal",
                F.when(edges, marked(F.col("name"))).alias("marked"), F.when(~edges, whole_word(F.col("name"))).alias("pattern"),
                F.col("name").rlike(rf"\A{LETTERS}\z").alias("one_run"), name_tokens(F.col("name")).alias("tokens"))
    )
    bare_names = referential.agg(F.coalesce(F.bool_or(~letters), F.lit(False))).scalar()
    kept = entries.drop("matched_name", "match_score", "isin", "ticker_bourso").withColumn("_key", F.md5("title"))
    titles = kept.where(F.col("title").isNotNull()).groupBy("_key").agg(
        F.first("title").alias("title"), F.count(F.lit(1)).alias("copies"))
    cleaned = titles.select("_key", "copies", clean_title(F.col("title")).alias("cleaned"))
    read = staged(_by_word(cleaned, bare_names, threshold), "title-tokens")
    named, dealt = _blocks(names, read)
    pairs = dealt.withColumn("alone", F.col("place") < F.col("alone")).drop("place").join(named, ["token", "salt"]).drop("token", "salt")

    long = F.length("name") > SHORT_NAME
    settled = pairs.where(F.col("one_run") & (long | F.col("alone")) & F.lit(threshold <= 100)).groupBy("_key").agg(
        F.max("copies").alias("copies"), F.min(F.struct("ordinal", "company")).alias("first"))
    open_pairs = pairs.where(~F.col("one_run") | ~long & ~F.col("alone") & F.col("few")).drop("copies", "few", "alone", "one_run")
    settled = staged(settled, "settled")
    better = staged(open_pairs.join(settled.select("_key", F.col("first.ordinal").alias("_limit")), "_key", "left").where(
        F.col("_limit").isNull() | (F.col("ordinal") < F.col("_limit"))).drop("_limit"), "open")
    wanted = cleaned.join(better.select("_key").distinct(), "_key", "left_semi")
    texts = with_words(wanted.withColumn("_marked", marked(F.col("cleaned"))), threshold)
    found = better.join(texts, "_key").where(
        F.when(F.col("marked").isNotNull(), F.contains("_marked", "marked")).otherwise(F.rlike("cleaned", F.col("pattern")))
    ).select("_key", "copies", "name", "company", "ordinal", "_spaced", "_few")
    scored = match_scores(found).where(F.col("score") >= threshold).select("_key", "copies", "score", "ordinal", "company")
    candidates = settled.select("_key", "copies", F.lit(100.0).alias("score"), "first.*").unionByName(scored)
    best = staged(candidates.groupBy("_key").agg(
        F.max("copies").alias("copies"), F.min(F.struct((-F.col("score")).alias("under"), "ordinal", "company")).alias("best"),
    ).select(
        "_key", "copies", F.col("best.company.name").alias("matched_name"), (-F.col("best.under")).alias("match_score"),
        F.col("best.company.isin").alias("isin"), F.col("best.company.ticker_bourso").alias("ticker_bourso"),
    ), "links")  # read twice by the lookup
    discard(read, settled, better)
    return lookup(kept, best, ["_key"], copies="copies").drop("_key")
