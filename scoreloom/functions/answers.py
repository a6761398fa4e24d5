"""Reading model answers and embedded JSON: answers are data, a bad one never fails the job."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.numbers import blank_to_null

# The alternative names each listing figure may have.
LISTING_ALIASES = {
    "last": ["last", "lastPrice", "price", "value"],
    "variation": ["variation", "change", "pctChange", "variationPercent"],
    "high": ["high", "dayHigh", "highPrice"],
    "low": ["low", "dayLow", "lowPrice"],
    "volume": ["volume", "tradedVolume", "turnover"],
}

#: Levels of nested JSON that are walked.
LEVELS = 32


def json_block(raw: Column) -> Column:
    """Drop code fences, keep the text from the first '{' to the last '}'."""
    bare = F.trim(F.regexp_replace(raw, r"```(?:json)?\s*|\s*```", ""))
    return blank_to_null(F.regexp_extract(bare, r"(?s)\{.*\}", 0))


def usable_answers(df: DataFrame, raw: str) -> DataFrame:
    """Add `score` and `reason` read from the answer column, without the rows that lack either.

    A score is an integer from 0 to 10.  Unusable rows vanish in an inline() of zero or one
    struct: as a filter the condition would be pushed below and parse every answer twice.
    """
    doc = df.withColumn("_doc", F.try_parse_json(json_block(F.col(raw))))
    fields = doc.withColumns(
        {
            "_score": F.try_variant_get("_doc", "$.score", "variant"),
            "_reason": F.try_variant_get("_doc", "$.reason", "variant"),
        }
    )
    parts = fields.withColumns(
        {"_kind": F.schema_of_variant("_score"), "_text": F.trim(F.try_variant_get("_score", "$", "string"))}
    )
    # a JSON string must be an integer, a JSON number is truncated, true counts as 1
    text = F.col("_text")
    score = (
        F.when(F.col("_kind") == "STRING", F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int")))
        .when(F.col("_kind") == "BOOLEAN", text.try_cast("boolean").cast("int"))
        .otherwise(text.try_cast("double").try_cast("int"))
    )
    reason = F.coalesce(F.try_variant_get("_reason", "$", "string"), F.lit("None"))
    answer = F.when(
        F.col("_value").between(0, 10) & F.col("_reason").isNotNull(),
        F.struct(F.col("_value").alias("score"), reason.alias("reason")),
    )
    return parts.withColumn("_value", score).select(*df.columns, F.inline(F.array_compact(F.array(answer))))


def unescape(text: Column) -> Column:
    """HTML character references to characters; only rows that hold an '&' reach Python."""

    def decode(texts):
        import html

        return texts.map(lambda t: None if t is None else html.unescape(t))

    decode.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    decoded = F.pandas_udf(decode, "string")(F.when(text.contains("&"), text))
    return F.coalesce(decoded, text)


def _members(text: Column) -> Column:
    """The members of a JSON object or array in order: place, name (NULL in an array), text and kind of the value."""
    is_object = text.startswith("{")
    texts, kinds = (F.from_json(text, f"map<string,{kind}>") for kind in ("string", "variant"))
    items, item_kinds = (F.from_json(text, f"array<{kind}>") for kind in ("string", "variant"))

    def member(place: Column, name: Column, value: Column, typed: Column) -> Column:
        return F.struct(place.alias("place"), name.alias("name"), F.ltrim(value).alias("text"), F.schema_of_variant(typed).alias("kind"))

    of_object = F.transform(F.map_entries(texts), lambda e, i: member(i, e["key"], e["value"], F.element_at(kinds, e["key"])))
    of_array = F.transform(items, lambda v, i: member(i, F.lit(None).cast("string"), v, F.get(item_kinds, i)))
    return F.when(is_object, of_object).otherwise(of_array)


def json_objects(document: Column) -> Column:
    """All objects of a JSON document in the order of the text, outer ones before those in them: (path, members).

    One step a level, whatever the document's width; the order of members is that of the text, which VARIANT
    would not keep.  A document nested deeper than LEVELS raises an error.
    """
    nodes = "array<struct<path:array<int>,text:string>>"
    objects = "array<struct<path:array<int>,members:array<struct<place:int,name:string,text:string,kind:string>>>>"
    text = F.ltrim(document)
    root = F.when(text.rlike(r"^[\[{]"), F.array(F.struct(F.array().cast("array<int>").alias("path"), text.alias("text"))))
    begin = F.struct(F.coalesce(root, F.array()).cast(nodes).alias("nodes"), F.array().cast(objects).alias("objects"))

    def level(state: Column, _: Column) -> Column:
        opened = F.transform(state["nodes"], lambda n: F.struct(
            n["path"].alias("path"), n["text"].startswith("{").alias("is_object"), _members(n["text"]).alias("members")))

        def onward(opened: Column) -> Column:
            held = F.filter(opened, lambda o: o["is_object"])
            below = F.flatten(F.transform(opened, lambda o: F.transform(
                F.filter(o["members"], lambda m: m["kind"].rlike("^(OBJECT|ARRAY)")),
                lambda m: F.struct(F.concat(o["path"], F.array(m["place"])).alias("path"), m["text"].alias("text")))))
            found = F.transform(held, lambda o: F.struct(o["path"].alias("path"), o["members"].alias("members")))
            return F.struct(below.alias("nodes"), F.concat(state["objects"], found).alias("objects"))

        return F.get(F.transform(F.array(opened), onward), F.lit(0))  # `opened` is computed once

    def deeper(state: Column, _: Column) -> Column:
        return F.when(F.size(state["nodes"]) > 0, level(state, _)).otherwise(state)  # most documents end after a few levels

    end = F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), begin, deeper)
    too_deep = F.raise_error(F.lit(f"JSON nested deeper than {LEVELS} levels")).cast(objects)
    checked = F.transform(F.array(end), lambda e: F.when(F.size(e["nodes"]) > 0, too_deep).otherwise(F.array_sort(e["objects"])))
    return F.get(checked, F.lit(0))


def listing_figures(blob: Column) -> Column:
    """struct(last, variation, high, low, volume) from an escaped JSON attribute.

    The blob is a document, or has one between its outermost braces.  The figures may sit at any depth and under several
    names: the outermost, first object that has a value under one of the names gives it.  Numbers stay as they are written.
    """
    text = F.trim(unescape(blob))
    block = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    document = F.when(F.try_parse_json(text).isNotNull(), text).when(F.try_parse_json(block).isNotNull(), block)

    def value(members: Column, name: str) -> Column:
        blank = lambda m: (m["kind"] == "VOID") | (m["text"] == "") & (m["kind"] == "STRING") | (
            m["kind"].rlike("^(OBJECT|ARRAY)") & m["text"].rlike(r"^[\[{]\s*[\]}]$"))
        return F.get(F.filter(members, lambda m: (m["name"] == name) & ~blank(m)), F.lit(0))["text"]

    def figures(known: Column) -> Column:
        found = {f: F.array_compact(F.transform(known, lambda o: F.coalesce(*[value(o["members"], n) for n in names])))
                 for f, names in LISTING_ALIASES.items()}
        return F.struct(*[F.get(values, F.lit(0)).alias(f) for f, values in found.items()])

    return F.get(F.transform(F.array(json_objects(document)), figures), F.lit(0))
