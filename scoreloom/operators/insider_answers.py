"""Insider filings: which to read, and the transactions in the answers about them."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.numbers import plain_number
from scoreloom.functions.text import collapse
from scoreloom.operators.keyed import without

# The filing type and status that are read, and their age.
FILING_TYPE = "Informations réglementées continues"
RECENT_DAYS = 90


@dataclass(frozen=True)
class InsiderRules:
    """Which titles are read, and which transactions are believed."""

    titles: tuple = ("DIRIGEANT", "ARTICLE 19")
    not_titles: tuple = ()
    text_chars: int = 3500
    forbidden_words: tuple = ("ancien", "dirigeant", "membre", "société", "groupe", "fondation")
    banned_names: tuple = ()
    max_words: int | None = None
    min_year: int | None = None
    any_shape: bool = False
    compute_amount: bool = False
    method: str = "groq-llama-3.1-8b"


# The scheduled rules and the strict ones.
SCHEDULED = InsiderRules()
STRICT = InsiderRules(
    titles=("DIRIGEANT", "PERSONNE EXERÇANT", "ARTICLE 19"),
    not_titles=("ACTIONS PROPRES", "RACHAT", "DROITS DE VOTE"),
    text_chars=3000,
    forbidden_words=("ancien", "dirigeant", "membre", "société", "groupe", "direction", "representant", "permanent",
                     "fondation"),
    banned_names=("carbios", "nestlé", "pepsico", "l'oréal", "suntory"),
    max_words=3,
    min_year=2025,
    any_shape=True,
    compute_amount=True,
    method="groq-llama-3.1-8b-instant",
)


def _mentions(text: Column, words: tuple) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w))
    return hit


def insider_titles(filings: DataFrame, as_of: dt.datetime, rules: InsiderRules = SCHEDULED) -> DataFrame:
    """Downloaded recent filings whose title announces an insider transaction."""
    title = F.upper("titre")
    recent = F.col("publication_ts").cast("date") >= F.date_sub(clock.local_date(as_of), RECENT_DAYS)
    return filings.where(
        (F.col("type_information") == FILING_TYPE)
        & (F.col("pdf_download_status") == "success")
        & recent
        & _mentions(title, rules.titles)
        & ~_mentions(title, rules.not_titles)
    )


def insider_filings(
    filings: DataFrame, signals: DataFrame, as_of: dt.datetime, rules: InsiderRules = SCHEDULED, limit: int | None = None
) -> DataFrame:
    """Filings to read, without those that already gave signals: all, or the newest `limit`."""
    rows = without(insider_titles(filings, as_of, rules), signals, ["record_id"], ["source_record_id"])
    return rows if limit is None else rows.orderBy(F.desc("publication_ts"), "record_id").limit(limit)


def model_input(text: Column, rules: InsiderRules = SCHEDULED) -> Column:
    return collapse(text, rules.text_chars)


def parse_signals(filings: DataFrame, rules: InsiderRules = SCHEDULED, answer: str = "raw_response") -> DataFrame:
    """One row per transaction object in the answer, as column `_signal` (a variant).

    The transactions are the list under "signals"; with `any_shape` also a bare list or a single
    object.  Anything else gives no rows.
    """
    doc = F.try_parse_json(answer)
    shape = F.schema_of_variant(doc)
    listed = F.try_variant_get(doc, "$.signals", "array<variant>")
    has_key = F.try_variant_get(doc, "$.signals", "variant").isNotNull()
    if rules.any_shape:
        listed = (
            F.when(shape.startswith("ARRAY"), F.try_variant_get(doc, "$", "array<variant>"))
            .when(has_key, listed)
            .when(shape.startswith("OBJECT"), F.array(doc))
        )
    rows = filings.withColumn("_signal", F.explode(listed))
    return rows.where(F.schema_of_variant("_signal").startswith("OBJECT"))


def _text(name: str) -> Column:
    """str() of a value: 'Unknown' for a missing key, 'None' for a null."""
    value = F.try_variant_get("_signal", f"$.{name}", "variant")
    return F.when(value.isNull(), "Unknown").otherwise(
        F.coalesce(F.try_variant_get("_signal", f"$.{name}", "string"), F.lit("None"))
    )


def _answered(name: str) -> Column:
    return F.try_variant_get("_signal", f"$.{name}", "string")


def _given_amount() -> tuple[Column, Column]:
    kind = F.schema_of_variant(F.try_variant_get("_signal", "$.montant", "variant"))
    return F.coalesce(kind, F.lit("VOID")), F.try_variant_get("_signal", "$.montant", "string")


def amount() -> Column:
    """The amount, else quantity times price; 0 where neither can be read."""
    kind, text = _given_amount()
    number = F.when(kind == "BOOLEAN", text.try_cast("boolean").cast("double")).otherwise(text.try_cast("double"))
    empty = (kind == "VOID") | ((kind == "STRING") & (text == "")) | ((kind != "STRING") & (number == 0))
    quantity = F.when(_text("nombre_actions") == "Unknown", "0").otherwise(_text("nombre_actions"))
    price = F.when(_text("prix_moyen") == "Unknown", "0").otherwise(_text("prix_moyen"))
    product = plain_number(F.translate(quantity, " ,", "")) * plain_number(
        F.replace(F.replace(price, F.lit("€"), F.lit("")), F.lit(","), F.lit("."))
    )
    written = plain_number(F.translate(text, ",€ ", "."))
    value = F.when(empty, product).when(kind == "STRING", written).otherwise(number)
    return F.coalesce(value, F.lit(0.0))


def given_amount() -> Column:
    """The amount as answered: a number, or a text that is one."""
    kind, text = _given_amount()
    return F.when(kind == "STRING", plain_number(text)).otherwise(text.try_cast("double"))


def valid_insider(name: Column, operation: Column, day: Column, rules: InsiderRules = SCHEDULED) -> Column:
    """A plausible person's name; under strict rules also a real operation and a recent date."""
    lowered = F.lower(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""))
    words = F.filter(F.split(lowered, r"(?U)\s+"), lambda w: w != "")
    ok = (F.size(words) >= 2) & ~F.arrays_overlap(words, F.array(*[F.lit(w) for w in rules.forbidden_words]))
    if rules.max_words is not None:
        ok = ok & (F.size(words) <= rules.max_words)
    if rules.banned_names:
        ok = ok & ~_mentions(lowered, rules.banned_names)
    if rules.min_year is not None:
        real = F.when(day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), day.try_cast("date"))
        ok = ok & (F.length(operation) > 0) & F.coalesce(F.year(real) >= rules.min_year, F.lit(False))
    return F.coalesce(ok, F.lit(False))


def insider_signals(
    filings: DataFrame, as_of: dt.datetime, rules: InsiderRules = SCHEDULED, answer: str = "raw_response"
) -> DataFrame:
    """Believable transactions, with company, code and record taken from the filing.

    The strict rules write 'Unknown' for what an answer lacks, and the company code for its ticker; the scheduled ones
    leave NULL.
    """
    rows = parse_signals(filings, rules, answer)
    strict = rules.compute_amount
    fields = ("date_signal", "dirigeant", "qualite", "type_operation")
    rows = rows.withColumns(
        {
            **{name: _text(name) if strict else _answered(name) for name in fields},
            "montant": amount() if rules.compute_amount else given_amount(),
            "_ticker": F.nullif(F.nullif(_text("ticker"), F.lit("Unknown")), F.lit("")) if strict else _answered("ticker"),
        }
    ).where(valid_insider(F.col("dirigeant"), F.col("type_operation"), F.col("date_signal"), rules))
    return rows.select(
        (F.coalesce("_ticker", "isin", F.lit("Unknown")) if strict else F.col("_ticker")).alias("ticker"),
        "date_signal", "dirigeant", "qualite", "type_operation", "montant",
        F.col("record_id").alias("source_record_id"),
        F.col("pdf_url").alias("url_doc"),
        "societe", "isin",
        clock.at(as_of).alias("processed_at"),
        F.lit(rules.method).alias("extraction_method"),
    )
