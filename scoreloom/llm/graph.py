"""Connected components of a link table, by least labels with pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.session import discard, staged


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in `links` (a, b): root is the least id reachable.

    Every round is written to the shared folder and ends with one count; the round before it is discarded then.
    """
    directions = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("link")
    both = staged(links.select(directions).select("link.a", "link.b").distinct(), "links")  # one evaluation gives both directions
    labels = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("root")), "labels")
    while True:
        around = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("root").alias("near"))
        nearer = labels.join(around, labels.id == around.a).select("id", F.least("root", "near").alias("next"), F.col("root").alias("was"))
        jump = labels.select(F.col("id").alias("next"), F.col("root").alias("far"))
        after = staged(nearer.join(jump, "next").select("id", F.least("next", "far").alias("root"), "was"), "labels")
        changed = not after.where("root < was").isEmpty()
        discard(labels)
        labels = after
        if not changed:
            discard(both)
            return labels.drop("was")
