"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from scoreloom.session import build_session  # noqa: E402

HEADLINE = [
    "jn1_sco14_company_scores", "win5_sco6_stocks_score", "ind4_ind5_macd", "win2_clean_bars", "sco11_financials_score",
    "silver_financial_signal", "sco12_score_insider", "sco13_score_news", "win2_set1_rss_articles",
    "txt1_jn8_entity_link", "txt5_score_blocks", "txt6_financial_context", "txt10_txt11_strict_insider_signals",
    "sc17_sco15_article_sentiment", "snk4_merge_upsert", "snk7_insert_overwrite_month", "win7_percent_rank_global",
    "agg4_win8_exact_percentiles", "str1_running_indicators", "str2_stream_daily_bars",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                      "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    from catalogue.queries import QUERIES

    names = sys.argv[1:] or HEADLINE
    times = {}
    for run in ("warm-up", "timed"):  # the first pass starts Python workers and compiles plans
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
