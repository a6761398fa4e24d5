"""Filing documents: relevance of titles, scored text blocks, the excerpt sent for extraction.

A document is one row, so its blocks are handled inside the row with array functions: no
exchange, and no group that grows with the data.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.text import matchable
from scoreloom.operators.keyed import without

# Points per keyword.
KEYWORDS = {
    "chiffre d'affaires": 3, "chiffre d affaires": 3, "revenu": 2, "revenues": 2, "revenue": 2, "sales": 2,
    "net sales": 2,
    "ebitda": 4, "ebit": 2, "résultat opérationnel": 3, "resultat operationnel": 3, "operating income": 3,
    "operating profit": 3, "marge opérationnelle": 4, "marge operationnelle": 4, "marge op": 3,
    "operating margin": 4,
    "dette nette": 4, "endettement net": 4, "net debt": 4, "gross debt": 2, "free cash flow": 4, "fcf": 3,
    "cash flow": 2, "cash flow libre": 4, "flux de trésorerie disponible": 4, "flux de tresorerie disponible": 4,
    "flux de trésorerie": 2, "flux de tresorerie": 2,
    "clos le": 3, "exercice clos": 3, "premier semestre clos": 3, "deuxième semestre clos": 3,
    "for the year ended": 3, "for the period ended": 3, "as of": 2, "ended": 1, "financial year": 2,
    "fiscal year": 2, "half-year": 2, "first half": 2, "second half": 2,
    "croissance": 2, "growth": 2, "year-on-year": 2, "yoy": 2, "%": 2,
}
MONEY_POINTS, YEAR_POINTS = 3, 1
MONEY = r"(?iU)\b\d+(?:[.,]\d+)?\s*(?:k€|m€|md€|keur|meur|million|millions|thousand|billion|eur|€)\b"
YEAR = r"(?U)\b20\d{2}\b"

# Relevance ladders, first match wins.
TITLE_LADDER = [
    ("résultat annuel|resultat annuel|annual results|full[- ]year results", 5),
    ("rapport financier annuel|annual financial report", 5),
    ("résultat semestriel|resultat semestriel|half[- ]year results|half year results|interim results", 4),
    ("rapport financier semestriel|half[- ]year financial report|interim financial report", 4),
    ("chiffre d'affaires|chiffre d affaires|revenue|revenues|sales|net sales", 4),
    ("résultat|resultat|results", 3),
    ("rapport financier|financial report", 3),
    ("mise à disposition|mise a disposition|publication du rapport|disponibilité du rapport|availability of", -4),
]
SUBTYPE_LADDER = [
    ("annuel|annual|full[- ]year|fiscal year", 2),
    ("semestriel|half[- ]year|half year|interim", 1),
    ("résultat|resultat|results|revenue|sales", 1),
]
TYPE_LADDER = [("information réglementée|information reglementee|regulated information", 1)]

MIN_RELEVANCE, RECENT_DAYS = 4, 90
MAX_CHARS, MAX_BLOCKS, EXCERPT_CHARS = 2500, 15, 10_000
SEPARATOR = "\n\n---\n\n"

FIGURES = ["ca_raw", "ebitda_raw", "marge_op_raw", "dette_nette_raw", "fcf_raw"]
ANSWERS = ["date_cloture_exercice_raw", "ca_raw", "ca_growth_raw", "ebitda_raw", "marge_op_raw", "dette_nette_raw",
           "fcf_raw"]


def _ladder(text: Column, steps: list) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    points = F.when(lowered.rlike(steps[0][0]), steps[0][1])
    for pattern, value in steps[1:]:
        points = points.when(lowered.rlike(pattern), value)
    return points.otherwise(0)


def relevance(title: Column, subtype: Column, kind: Column, penalise: bool = True) -> Column:
    """Points of a filing; the threshold test leaves the penalty out, the ordering has it in."""
    steps = [s for s in TITLE_LADDER if penalise or s[1] > 0]
    return _ladder(title, steps) + _ladder(subtype, SUBTYPE_LADDER) + _ladder(kind, TYPE_LADDER)


def doc_relevance(filings: DataFrame) -> DataFrame:
    parts = (F.col("titre"), F.col("sous_type"), F.col("type_information"))
    return filings.withColumn("relevance_score", relevance(*parts)).withColumn(
        "threshold_score", relevance(*parts, penalise=False)
    )


def relevant_documents(
    filings: DataFrame, done: DataFrame, as_of: dt.datetime, days: int = RECENT_DAYS,
    min_score: int = MIN_RELEVANCE, limit: int | None = None,
) -> DataFrame:
    """Downloaded recent filings of the last run that look financial and are not done yet."""
    if days <= 0 or min_score < 0:
        raise ValueError(f"days must be positive and min_score not negative: {days}, {min_score}")
    last_run = filings.agg(F.max("run_id")).scalar()
    base = filings.where(
        (F.col("run_id") == last_run)
        & (F.col("pdf_download_status") == "success")
        & F.col("pdf_gcs_uri").isNotNull()
        & (F.col("publication_ts") >= clock.days_before(as_of, days))
    )
    finished = done.where(F.col("extraction_status").isin("success", "no_financial_data"))
    rows = without(doc_relevance(base).where(F.col("threshold_score") >= min_score), finished, ["record_id"])
    rows = rows.orderBy(F.desc("relevance_score"), F.desc("publication_ts"), "record_id")
    return rows if limit is None else rows.limit(limit)


def split_blocks(text: Column) -> Column:
    """Paragraphs: parts between blank lines, trimmed, without empty ones."""
    stripped = F.transform(
        F.split(text, r"(?U)\n\s*\n"), lambda b: F.regexp_replace(b, r"(?U)^\s+|\s+$", "")
    )
    return F.filter(stripped, lambda b: b != "")


def _points(text: Column, keywords: dict[str, int]) -> Column:
    score = F.when(text.rlike(MONEY), MONEY_POINTS).otherwise(0) + F.when(text.rlike(YEAR), YEAR_POINTS).otherwise(0)
    for word, points in keywords.items():
        score = score + F.when(F.contains(text, F.lit(word)), points).otherwise(0)
    return score


def scored_blocks(text: Column, keywords: dict[str, int] = KEYWORDS) -> Column:
    """array(struct(score, place, block)) of a text's blocks in reading order.

    A block earns the points of all keywords it contains, each once, plus points for an amount and
    for a year.  Its comparable form is made once, before the keywords look at it.
    """
    prepared = F.transform(split_blocks(text), lambda b: F.struct(b.alias("block"), matchable(b).alias("text")))
    return F.transform(
        prepared,
        lambda b, i: F.struct(_points(b["text"], keywords).alias("score"), i.alias("place"), b["block"].alias("block")),
    )


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def financial_context(
    docs: DataFrame, text: str, name: str, max_chars: int = MAX_CHARS, max_blocks: int = MAX_BLOCKS,
    keywords: dict[str, int] = KEYWORDS,
) -> DataFrame:
    """Add the best blocks of a text, best first, joined up to `max_chars`.

    Taking stops at the first block that does not fit.  A first block that does not fit is cut, if
    `max_chars` is above 100.  Without any scoring block it is the start of the text.
    """
    found = F.filter(scored_blocks(F.col(text), keywords), lambda b: b["score"] > 0)
    ordered = F.array_sort(
        F.transform(found, lambda b: F.struct((-b["score"]).alias("order"), b["place"].alias("place"), b["block"].alias("block")))
    )
    start = F.struct(F.lit("").alias("text"), F.lit(True).alias("open"))

    def take(state: Column, best: Column) -> Column:
        glue = F.when(state["text"] == "", "").otherwise(SEPARATOR)
        fits = state["open"] & (F.length(state["text"]) + F.length(glue) + F.length(best["block"]) <= max_chars)
        return F.struct(
            F.when(fits, F.concat(state["text"], glue, best["block"])).otherwise(state["text"]).alias("text"),
            fits.alias("open"),
        )

    first = _strip(F.substring(F.col("_best")[0]["block"], 1, max_chars)) if max_chars > 100 else F.lit("")
    context = (
        F.when(F.size("_best") == 0, _strip(F.substring(text, 1, max_chars)))
        .when(F.col("_taken") == "", first)
        .otherwise(_strip(F.col("_taken")))
    )
    return (
        docs.withColumn("_best", F.slice(ordered, 1, max_blocks))
        .withColumn("_taken", F.aggregate("_best", start, take, lambda state: state["text"]))
        .withColumn(name, context)
        .drop("_best", "_taken")
    )


def _answer(doc: Column, field: str) -> Column:
    return F.try_variant_get(doc, f"$.{field}", "string")


def extraction(docs: DataFrame, as_of: dt.datetime, max_chars: int = MAX_CHARS) -> DataFrame:
    """Staging rows of answered documents, with the outcome as a status instead of an exception.

    `docs` has the text, the raw answer, and the HTTP status of a failed call (NULL when it
    succeeded).  Figures are kept for successful rows only.
    """
    body = F.regexp_replace("document_text", r"(?U)^\s+|\s+$", "")
    rows = financial_context(docs, "document_text", "_context", max_chars)
    rows = rows.withColumn("_doc", F.try_parse_json("raw_response")).withColumns(
        {f"_{f}": _answer(F.col("_doc"), f) for f in ANSWERS}
    )
    found = F.coalesce(*[F.col(f"_{f}") for f in FIGURES]).isNotNull()
    is_object = F.schema_of_variant("_doc").startswith("OBJECT")
    status = (
        F.when(F.col("document_text").isNull(), "pdf_parse_or_process_error")
        .when(body == "", "empty_text")
        .when(F.col("http_status") == 429, "llm_rate_limited")
        .when(F.col("http_status").isNotNull(), "llm_error")
        .when(F.col("raw_response").isNull(), "pdf_parse_or_process_error")
        .when(F.col("_doc").isNull(), "llm_invalid_json")
        .when(~is_object, "pdf_parse_or_process_error")
        .when(~found, "no_financial_data")
        .otherwise("success")
    )
    answered = F.col("extraction_status").isin("success", "no_financial_data")
    rows = rows.withColumn("extraction_status", status)
    return rows.withColumns(
        {
            **{f: F.when(F.col("extraction_status") == "success", F.col(f"_{f}")) for f in ANSWERS},
            "document_text_excerpt": F.when(answered, F.substring("_context", 1, EXCERPT_CHARS)),
            "text_length": F.length("document_text").cast("bigint"),
            "raw_llm_response": F.when(answered, F.col("raw_response")),
            "error_message": F.when(F.col("extraction_status") == "empty_text", "Extracted PDF text is empty.").when(
                F.col("extraction_status") == "no_financial_data", "All financial fields are null."
            ),
            "extracted_at": clock.at(as_of),
        }
    ).drop("_doc", "_context", "raw_response", *[f"_{f}" for f in ANSWERS])
