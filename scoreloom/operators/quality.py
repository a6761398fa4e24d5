"""Data-quality checks: each returns rows (rule, severity, failures), and a table's rules share passes."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowRule:
    """A condition on single rows; NULL passes unless the rule is about NULL."""

    name: str
    broken: Column
    severity: str = "error"


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null({column})", F.col(column).isNull())


def accepted_values(column: str, values: list) -> RowRule:
    return RowRule(f"accepted_values({column})", ~F.col(column).isin(values))


def accepted_range(column: str, low: float, high: float, severity: str = "warn") -> RowRule:
    return RowRule(f"accepted_range({column})", ~F.col(column).between(low, high), severity)


def check_rows(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """All row rules in one pass, as one line per rule."""
    counts = df.agg(*[F.count_if(r.broken).alias(f"_{i}") for i, r in enumerate(rules)])
    lines = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"_{i}").alias("failures"))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.explode(lines).alias("line")).select("line.*")


def unique(df: DataFrame, keys: list, severity: str = "error", tasks: int | None = None) -> DataFrame:
    """Keys that occur more than once; rows with a NULL in the key are left to not_null.

    Most keys should occur once, so counting before the exchange saves nothing.  With `tasks` (see `session.tasks_for`)
    the keys are dealt to that many tasks first, each of which counts its own.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = df.where(present).select(*keys)
    if tasks:
        rows = rows.repartition(tasks, *keys)
    repeated = rows.groupBy(*keys).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(f"unique({', '.join(keys)})").alias("rule"), F.lit(severity).alias("severity"), "failures"
    )


def min_rows(df: DataFrame, floor: int, severity: str = "error") -> DataFrame:
    missing = F.greatest(F.lit(floor) - F.count(F.lit(1)), F.lit(0))
    return df.agg(missing.alias("failures")).select(
        F.lit(f"min_rows({floor})").alias("rule"), F.lit(severity).alias("severity"), "failures"
    )


def check(
    df: DataFrame, rules: list[RowRule], grain: list | None = None, uniques: list = (), floor: int | None = None
) -> DataFrame:
    """All checks of a table in one report."""
    parts = [check_rows(df, rules)] if rules else []
    parts += [unique(df, keys) for keys in ([grain] if grain else []) + [[u] for u in uniques]]
    if floor is not None:
        parts.append(min_rows(df, floor))
    return reduce(lambda a, b: a.unionByName(b), parts)


# The range percentages must lie in, as a warning.
PERCENT_RANGE = (-1000, 10000)


def financial_signal_rules() -> list[RowRule]:
    required = ["record_id", "financial_signal_run_id", "extracted_at", "loaded_at"]
    return [not_null(c) for c in required] + [accepted_range(c, *PERCENT_RANGE) for c in ("ca_growth", "marge_op")]


def article_rules(sources: list) -> list[RowRule]:
    return [not_null(c) for c in ("row_id", "isin", "title", "source")] + [accepted_values("source", sources)]
