import json
import random
import re

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import documents, insider_answers
from scoreloom.operators import entity_link as links
from scoreloom.operators.entity_link import entity_link, match_scores
from scoreloom.plans import news
from tests.conftest import AS_OF

COMPANIES = ["THERMADOR", "MAISONS DU MONDE", "VALLOUREC", "LISI", "CLARANOVA"]
REFERENTIAL = "name string, isin string, ticker_bourso string, ordinal int"


def link(spark, titles, names, **options):
    entries = spark.createDataFrame([(n, t) for n, t in enumerate(titles)], "n int, title string")
    referential = spark.createDataFrame([(x, f"I-{k}", f"T-{k}", k) for k, x in enumerate(names)], REFERENTIAL)
    return entity_link(entries, referential, **options).orderBy("n").collect()


LINKS = [
    ("THERMADOR annonce ses résultats", "THERMADOR"), ("Maisons du Monde publie son chiffre d'affaires", "MAISONS DU MONDE"),
    ("Résultats d'une société inconnue XYZ Corp", None), ("LISI annonce une acquisition majeure", "LISI"),
    ("CLARANOVA lève des fonds", "CLARANOVA"), ("Analyse des marchés financiers mondiaux", None),
    ("LISI: résultats", None), ("lisi:", "LISI"), ("THERMADORIX grimpe", None), ("éLISI", None), (None, None), ("", None),
]


def test_links(spark):
    got = link(spark, [t for t, _ in LINKS], COMPANIES)
    assert [r.matched_name for r in got] == [m for _, m in LINKS]
    assert got[7].match_score == pytest.approx(200 * 4 / 9)
    assert got[0].isin == "I-0" and got[0].ticker_bourso == "T-0" and got[2].match_score is None


@pytest.mark.parametrize(
    "name, title, matched",
    [("OPTION", "La France et l'Europe prennent de nouvelles mesures - Option Finance", False),
     ("NEURONES", "Euronext Growth All Share | Cours Indice en direct - Investing.com", False),
     ("ER CAPITAL", "les actions sont le choix stratégique de l'année - capital.fr", False),
     ("2CRSI", "Pourquoi 2CRSi monte", True), ("1000", "Le cap des 1000 euros", True), ("3 6", "mesure 3 6 9", True),
     (r"A\E+B (C)", r"le groupe A\E+B (C) monte", True)],
)
def test_special_names(spark, name, title, matched):
    assert (link(spark, [title], [name])[0].matched_name is not None) == matched


def test_hot_title_links_every_row(spark):
    titles = ["le co: ab"] * 150 + ["ab.", "site - co.fr"]
    got = link(spark, titles, ["ab", "co", "zz"])
    assert [(r.matched_name, r.match_score) for r in got[:150]] == [("ab", 100.0)] * 150
    assert got[151].matched_name is None  # the ending names the site, not the company


def test_short_names_score_as_the_longest_common_subsequence(spark):
    """Against a table of all prefixes, for names and titles of few letters, shared words among them."""
    random.seed(5)
    draw = lambda n: "".join(random.choice("aab é,") for _ in range(n))
    pairs = [(draw(random.randint(1, 6)), draw(random.randint(0, 14))) for _ in range(300)] + [("日本株", "x日本,株"), ("ab", "")]

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
        return row[-1]

    def score(name, title):
        left, right = ({w for w in x.split()} for x in (name, title))
        both = left & right
        if both and (left == both or right == both):
            return 100.0
        core, first, second = (" ".join(sorted(both) + sorted(x - both)) for x in (set(), left, right))
        ratio = lambda a, b: 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0
        return max([ratio(first, second)] + ([ratio(core, first), ratio(core, second)] if both else []))

    df = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(pairs)], "n int, name string, cleaned string")
    want = [score(a, b) for a, b in pairs]
    for threshold in (0, 80):  # titles too long to reach the threshold need no comparison
        plan = match_scores(links.with_words(df, threshold))
        got = [r.score for r in plan.orderBy("n").collect()]
        assert [g if g >= threshold else 0 for g in got] == pytest.approx([w if w >= threshold else 0 for w in want])
        assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "title, score", [("lisi:", 200 * 4 / 9), ("lisi.", 200 * 4 / 9), ("(lisi)", 80.0), ("«lisi» !", None), ("lisi, lisi", 100.0)])
def test_short_names_below_100(spark, title, score):
    got = link(spark, [title], ["LISI"])[0]
    assert got.match_score == (pytest.approx(score) if score and score >= 80 else None)


def test_a_name_goes_by_the_token_that_fewest_titles_hold(spark, monkeypatch):
    """A word that a third of all titles hold costs nothing where a name has a rarer one, and is dealt out where it has not."""
    monkeypatch.setattr(links, "SHARE", 100)
    titles = spark.range(3000).select(F.col("id").cast("string").alias("_key"), F.when(
        F.col("id") % 3 == 0, F.array(F.lit("groupe"), F.concat(F.lit("t"), "id"))).otherwise(F.array(F.concat(F.lit("t"), "id"))).alias("tokens"))
    names = spark.createDataFrame([("Groupe T9", ["groupe", "t9"]), ("Groupe", ["groupe"]), ("Absent T9", ["absent", "t9"])], "name string, tokens array<string>")
    named, dealt = links._blocks(names, titles)
    by_name = {r.name: (r.tokens, r.salts) for r in named.groupBy("name").agg(F.collect_set("token").alias("tokens"), F.count_distinct("salt").alias("salts")).collect()}
    assert by_name == {"Groupe T9": (["t9"], 1), "Groupe": (["groupe"], 25)}
    sizes = dealt.groupBy("token", "salt").count().orderBy(F.desc("count")).first()
    assert dealt.count() == 4000 and sizes["count"] < 2 * 4000 / 100


def test_only_names_that_can_win_are_looked_for_in_the_text(spark, monkeypatch):
    """Runs of letters are settled by the tokens; of the others only those of a lower ordinal need the text."""
    seen, scores = [], links.match_scores
    monkeypatch.setattr(links, "match_scores", lambda pairs: seen.append(pairs.count()) or scores(pairs))
    names = ["beta,", "alpha", "gammas", "beta, gammas", "delta", "epsilon"]
    titles = ["alpha beta, gammas", "gammas alpha", "delta-epsilon delta.", "delta, beta,x", "lepsilon", "EPSILON."]
    got = [(r.matched_name, r.match_score) for r in link(spark, titles, names)]
    assert got == [("beta,", 100.0), ("alpha", 100.0), ("epsilon", 100.0), (None, None), (None, None), ("epsilon", 100.0)]
    assert seen == [1]


def test_link_plan_has_no_cross_join(spark):
    entries = spark.range(10).select(F.col("id").cast("string").alias("title"))
    referential = spark.createDataFrame([("A", "B", "C", 1)], REFERENTIAL)
    plan = entity_link(entries, referential)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_block_scores(spark):
    # ebitda 4 and ebit 2, an amount 3, a year 1; a keyword inside a longer one counts too
    cases = [("EBITDA 10\xa0millions en 2023", 10), ("chiffre d’affaires", 3), ("cash flow libre", 6), ("croissance de 4 %", 4),
             ("le groupe", 0), ("x2023", 0)]
    df = spark.createDataFrame([("\n \n".join(b for b, _ in cases),)], "text string")
    got = df.select(documents.scored_blocks(F.col("text")).alias("b")).first().b
    assert [(b.block, b.score) for b in got] == cases


def test_context(spark):
    best, next_best = "EBITDA 10 millions en 2023", "croissance de 4 %"
    text = f"le groupe\n\n{next_best}\n\n{best}"
    cases = [(text, 300, f"{best}\n\n---\n\n{next_best}"), (text, 50, f"{best}\n\n---\n\n{next_best}"), (text, 49, best), (text, 20, ""),
             ("rien ici\n\nni là", 300, "rien ici\n\nni là"), ("", 300, ""), ("EBITDA " * 40, 110, ("EBITDA " * 40)[:110].strip())]
    for source, limit, want in cases:
        df = spark.createDataFrame([(source,)], "text string")
        assert documents.financial_context(df, "text", "context", limit).first().context == want, (source, limit)


def test_relevance(rows):
    titles = [("Résultats annuels", None, None, 3), ("Résultat annuel", "Rapport annuel", "Information réglementée", 8), ("Mise à disposition", None, None, -4),
              ("Mise à disposition des résultats", None, None, 3), (None, "Interim", None, 1), ("Full-year results", "", "", 5)]
    df = rows("titre string, sous_type string, type_information string, want int", titles)
    got = documents.doc_relevance(df).collect()
    assert [r.relevance_score for r in got] == [r.want for r in got]
    assert [r.threshold_score for r in got] == [max(r.want, 0) for r in got]


def test_extraction_statuses(rows):
    ok = json.dumps({"ca_raw": "1 EUR", "ca_growth_raw": None})
    data = [("success", "text", ok, None), ("empty_text", " \n", ok, None), ("llm_rate_limited", "t", None, 429), ("llm_error", "t", None, 500),
            ("llm_invalid_json", "t", "{", None), ("no_financial_data", "t", '{"ca_growth_raw": "3 %"}', None),
            ("pdf_parse_or_process_error", None, ok, None), ("pdf_parse_or_process_error", "t", "[1]", None)]
    df = rows("want string, document_text string, raw_response string, http_status int", data)
    got = documents.extraction(df, AS_OF).collect()
    assert [r.extraction_status for r in got] == [r.want for r in got]
    assert got[0].ca_raw == "1 EUR" and got[0].document_text_excerpt == "text" and got[5].ca_growth_raw is None


def signals(rows, answer, rules):
    df = rows("record_id string, societe string, isin string, pdf_url string, raw_response string", [("R1", "ACME", "FR1", "u", answer)])
    return insider_answers.insider_signals(df, AS_OF, rules).collect()


@pytest.mark.parametrize(
    "fields, amount",
    [('"montant": 31000', 31000.0), ('"montant": "1 250,5 €"', 1250.5), ('"montant": 0, "nombre_actions": "2 000", "prix_moyen": "15,50€"', 31000.0),
     ('"nombre_actions": 2000, "prix_moyen": 15.5', 31000.0), ('"montant": null, "nombre_actions": null, "prix_moyen": 3', 0.0),
     ('"montant": "0", "nombre_actions": 3, "prix_moyen": 3', 0.0), ('"montant": "", "nombre_actions": 3, "prix_moyen": 3', 9.0),
     ('"montant": true', 1.0), ('"montant": false, "nombre_actions": 3, "prix_moyen": 3', 9.0), ('"montant": "5d"', 0.0), ('"x": 1', 0.0)],
)
def test_amounts(rows, fields, amount):
    answer = '{"signals": [{"dirigeant": "Jean Dupont", "type_operation": "Achat", "date_signal": "2026-01-02", %s}]}' % fields
    assert [r.montant for r in signals(rows, answer, insider_answers.STRICT)] == [amount]


def test_answer_shapes(rows):
    one = '{"dirigeant": "Jean Dupont", "type_operation": "Achat", "date_signal": "2026-01-02", "montant": 1.5}'
    for answer, strict, scheduled in [(f'{{"signals": [{one}, 3, {one}]}}', 2, 2), (f"[{one}]", 1, 0), (one, 1, 0), ("{", 0, 0), ('{"signals": null}', 0, 0), ("3", 0, 0)]:
        assert len(signals(rows, answer, insider_answers.STRICT)) == strict, answer
        assert len(signals(rows, answer, insider_answers.SCHEDULED)) == scheduled, answer
    got = signals(rows, f"[{one}]", insider_answers.STRICT)[0]
    assert (got.ticker, got.societe, got.isin, got.source_record_id, got.qualite) == ("FR1", "ACME", "FR1", "R1", "Unknown")


def test_names_and_dates(rows):
    cases = [("Jean Dupont", "Achat", "2025-01-01", True, True), ("Jean Marie Dupont Durand", "Achat", "2026-01-01", False, True),
             ("Ancien Directeur", "Achat", "2026-01-01", False, False), ("Direction Groupe", "Achat", "2026-01-01", False, False),
             ("Fonds Direction", "Achat", "2026-01-01", False, True), ("Dupont", "Achat", "2026-01-01", False, False),
             ("Nestlé Holding", "Achat", "2026-01-01", False, True), ("Jean Dupont", "Achat", "2024-12-31", False, True),
             ("Jean Dupont", "Achat", "2026-02-30", False, True), ("Jean Dupont", "Achat", "inconnue", False, True), ("Jean Dupont", "", "2026-01-01", False, True),
             ("  jean  dupont ", "Achat", "2026-1-5", True, True), (None, "Achat", "2026-01-01", False, False)]
    df = rows("n string, o string, d string, strict boolean, scheduled boolean", cases)
    for rules, column in ((insider_answers.STRICT, "strict"), (insider_answers.SCHEDULED, "scheduled")):
        valid = insider_answers.valid_insider(F.col("n"), F.col("o"), F.col("d"), rules)
        for r in df.withColumn("got", valid).collect():
            assert r.got == r[column], (column, r)


def test_unseen_entries_and_first_title(rows):
    ddl = "category string, guid string, link string, title string, summary string, isin_tag string, n int"
    entries = rows(ddl, [("a", "1", "l", "t", "s", None, 0), ("a", None, "l2", "on FR0000120271", "s", "", 1), ("a", None, "l2", "t", "s", None, 2), ("b", "1", "l", "t", "s", "X", 3)])
    got = news.unseen_entries(entries, rows("category string, guid string", [("a", "1")]), [F.col("n")]).collect()
    assert {(r.category, r.guid, r.feed_isin) for r in got} == {("a", "l2", "FR0000120271"), ("b", "1", "X")}
    assert {r.n for r in news.first_title(entries, [F.col("n")]).collect()} == {0, 1}
