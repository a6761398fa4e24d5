import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scoreloom.functions import answers, clock, numbers, text


def test_money(evaluate):
    cases = {
        "12.5 million EUR": Decimal("12500000"), "3 EUR": Decimal(3), " -4.25 thousand EUR ": Decimal("-4250"),
        "1 billion EUR": Decimal(10**9), "0.123456789 EUR": Decimal("0.123456789"), "12 million USD": None, "12 Million EUR": None,
        "about 3 EUR": None, "1,5 EUR": None, "": None, None: None, "99999999999999999999999999 billion EUR": None,
    }
    assert evaluate(numbers.money_to_eur, list(cases)) == list(cases.values())


def test_numbers_in_text(evaluate):
    assert evaluate(numbers.first_number, ["-3.2 %", "about 12%", "none", None, ""]) == [-3.2, 12.0, None, None, None]
    assert evaluate(numbers.version_number, ["v2", "prompt-v10-b", "draft", None]) == [2, 10, 0, 0]
    assert evaluate(numbers.plain_number, ["1e3", " 4.5 ", "5d", "NaN", "1 2", ".5"]) == [1000.0, 4.5, None, None, None, 0.5]


def test_null_and_zero(evaluate):
    assert evaluate(lambda x: numbers.divide(F.lit(1.0), x), [2.0, 0.0, None], "double") == [0.5, None, None]
    assert evaluate(lambda x: numbers.clip(x, F.lit(0.0), F.lit(1.0)), [-1.0, 0.5, 9.0, None], "double") == [0.0, 0.5, 1.0, None]
    assert evaluate(lambda x: numbers.round_half_away(x, 2), [1.005, -1.005, 2.675, 1e27, None], "double") == [1.01, -1.01, 2.68, 1e27, None]
    assert evaluate(numbers.rescale_1_10, [1.0, 5.5, 10.0], "double") == [0.0, 5.0, 10.0]


def test_feed_dates(evaluate):
    cases = {
        "Thu, 02 Apr 2026 15:30:00 GMT": dt.datetime(2026, 4, 2, 15, 30),
        "Thu, 02 Apr 2026 15:30:00 +0200": dt.datetime(2026, 4, 2, 13, 30),
        "02 Apr 2026 00:30:00 EST": dt.datetime(2026, 4, 2, 5, 30),
        "Thu, 31 Feb 2026 15:30:00 GMT": None, "yesterday": None, "": None, None: None,
    }
    assert evaluate(clock.feed_timestamp, list(cases)) == list(cases.values())


def test_iso_dates(evaluate):
    cases = {
        "2025-01-31": dt.datetime(2025, 1, 31), "2025-01-31T10:15:00+00:00": dt.datetime(2025, 1, 31, 10, 15),
        "2025-01-31T10:15:00Z": dt.datetime(2025, 1, 31, 10, 15), "2025-01-31T10:15:00-01:30": dt.datetime(2025, 1, 31, 11, 45),
        None: None, "": None, "   ": None, "not-a-date": None, "2025-13-31": None,
    }
    assert evaluate(clock.iso_timestamp, list(cases)) == list(cases.values())
    assert evaluate(clock.strict_date, ["2024-02-29", "2023-02-29", "24-01-01", None]) == [dt.date(2024, 2, 29), None, None, None]


@pytest.mark.parametrize(
    "as_of, day",
    [(dt.datetime(2024, 1, 31, 16, 59), dt.date(2024, 1, 30)), (dt.datetime(2024, 1, 31, 17, 0), dt.date(2024, 1, 31)),
     (dt.datetime(2024, 7, 31, 16, 0), dt.date(2024, 7, 31)), (dt.datetime(2024, 7, 31, 23, 0), dt.date(2024, 7, 31))],
)
def test_market_close(spark, as_of, day):
    assert spark.range(1).select(clock.last_closed_session(as_of)).first()[0] == day


def test_nothing_depends_on_the_session_zone(spark, evaluate):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert evaluate(clock.feed_timestamp, ["Thu, 02 Apr 2026 15:30:00 +0200"]) == [dt.datetime(2026, 4, 2, 13, 30)]
        late = lambda x: clock.utc_date(clock.instant(x.cast("timestamp_ntz")))
        assert evaluate(late, ["2026-03-08 02:30:00", "2026-04-02 23:59:59.999999"]) == [dt.date(2026, 3, 8), dt.date(2026, 4, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_codes(evaluate):
    cases = {"FR0000120271": True, "US0378331005": True, "GB0002634946": True, "fr0000120271": True, "": False, "123": False,
             "FR000012027": False, "FR00001202711": False, "FR00001202$1": False}
    assert evaluate(text.is_code, list(cases)) == list(cases.values())
    found = evaluate(text.code_in_text, ["see FR0000120271.", "éFR0000120271", "xFR0000120271", "FR0000120271A", None])
    assert found == ["FR0000120271", None, None, None, None]


def test_titles(evaluate):
    cases = {
        "THERMADOR annonce ses résultats - lefigaro.fr": "THERMADOR annonce ses résultats",
        "Hexaom prévoit une hausse - Ouest-France": "Hexaom prévoit une hausse - Ouest-France",
        "NFL Biosciences s'introduit en bourse - euronext.com": "NFL Biosciences s'introduit en bourse",
    }
    assert evaluate(text.clean_title, list(cases)) == list(cases.values())
    assert evaluate(text.matchable, ["Chiffre d’Affaires É"]) == ["chiffre d'affaires é"]
    assert evaluate(lambda x: text.collapse(x, 5), ["a \n\t b  c"]) == ["a b c"]


def test_code_in_html(evaluate):
    pages = ['<p>XX0000000000</p><h2 class="x c-faceplate__isin">ISIN FR0000120271 &bull;</h2>',
             "<script>FR0000000000</script><!-- FR0000000001 --><b>US0378331005</b>", "<p>none</p>"]
    assert evaluate(text.code_in_html, pages) == ["FR0000120271", "US0378331005", None]


def test_listing_figures(evaluate):
    blobs = ['{&quot;a&quot;:[{&quot;last&quot;:&quot;&quot;,&quot;price&quot;:&quot;12,5&quot;}],&quot;change&quot;:1.5}', 'x={"high": 3};', "broken", "", None]
    got = evaluate(answers.listing_figures, blobs)
    assert [(g.last, g.variation, g.high) for g in got] == [("12,5", "1.5", None), (None, None, "3")] + [(None,) * 3] * 3


def test_usable_answers(rows):
    raw = ['```json\n{"score": 7, "reason": "a"}\n```', 'ok {"score": "3", "reason": "b"} bye', '{"score": 11, "reason": "c"}',
           '{"score": 4}', '{"score": 7.9, "reason": null}', '{"score": "7.5", "reason": "x"}', "none", None, '{"score": [1], "reason": "x"}']
    got = answers.usable_answers(rows("id int, raw string", list(enumerate(raw))), "raw").orderBy("id").collect()
    assert [(r.id, r.score, r.reason) for r in got] == [(0, 7, "a"), (1, 3, "b"), (4, 7, "None")]


def test_entry_code_and_labels(rows, evaluate):
    df = rows("tag string, title string, summary string", [("A", "x", "y"), ("", "on FR0000120271", None), (None, "x", "US0378331005"), (None, None, None)])
    got = [r[0] for r in df.select(text.entry_code(F.col("tag"), F.col("title"), F.col("summary"))).collect()]
    assert got == ["A", "FR0000120271", "US0378331005", None]
    assert evaluate(text.signal_label, [0.0, 1.0, 2.0], "double") == ["bearish", "neutral", "bullish"]
