"""Insider purchases per company and day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.numbers import greatest_or_null, least_or_null, round_half_away

# What counts as a purchase, the bonus per further operation, the scale's top amount.
PURCHASE = "Achat"
CLUSTER_BONUS, MAX_LOG_AMOUNT = 0.5, 6


def score_insider(signals: DataFrame, bonus: float = CLUSTER_BONUS, max_log: float = MAX_LOG_AMOUNT) -> DataFrame:
    """Purchases of a day: amount on a log scale, raised when several operations coincide.

    Rows shrink to one per person and operation before the names of a day meet.
    """
    day = ["isin", "societe", "signal_date"]
    buys = signals.where(F.col("type_operation") == PURCHASE).withColumn(
        "signal_date", F.substring("date_signal", 1, 10).try_cast("date")
    )
    single = buys.groupBy(*day, "dirigeant", "source_record_id").agg(F.sum("montant").alias("amount"))
    daily = single.groupBy(*day).agg(
        F.array_join(F.array_sort(F.collect_set("dirigeant")), ", ").alias("insider_names"),
        F.count_distinct("source_record_id").alias("num_operations"),
        F.sum("amount").alias("total_amount"),
    )
    raw = F.log10(F.col("total_amount") + 1) * (1 + (F.col("num_operations") - 1) * bonus)
    scaled = round_half_away(F.col("raw_score") / max_log * 10, 1)
    return daily.withColumn("raw_score", raw).withColumn(
        "score_1_10", least_or_null(F.lit(10.0), greatest_or_null(F.lit(1.0), scaled))
    )
