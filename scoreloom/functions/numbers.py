"""Number expressions: parsing figures out of text, null-safe arithmetic, rounding, rescaling."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only accepted currency units and their factor to EUR.
UNIT_FACTORS = {"EUR": 1, "thousand EUR": 1_000, "million EUR": 1_000_000, "billion EUR": 1_000_000_000}

# A run of digits of any length, as Python's float() would read it, with optional exponent.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def blank_to_null(text: Column) -> Column:
    """regexp_extract returns '' where nothing matched; every caller wants NULL."""
    return F.nullif(text, F.lit(""))


def money_to_eur(text: Column) -> Column:
    """'12.5 million EUR' -> 12500000 as DECIMAL(38,9); NULL for any other wording."""
    whole = r"^\s*(-?\d+(?:\.\d+)?)\s+((?:thousand |million |billion )?EUR)\s*$"
    amount = blank_to_null(F.regexp_extract(text, whole, 1)).try_cast("decimal(38,9)")
    unit = F.regexp_extract(text, whole, 2)
    value = F.when(unit == "EUR", amount)  # unscaled: a product would drop digits 7 to 9
    for name, factor in UNIT_FACTORS.items():
        if factor > 1:
            scaled = F.try_multiply(amount, F.lit(factor).cast("decimal(10,0)"))
            value = value.when(unit == name, scaled.try_cast("decimal(38,9)"))
    return value


def first_number(text: Column) -> Column:
    """The first signed number in a text, as double: '-3.2 %' -> -3.2."""
    return blank_to_null(F.regexp_extract(text, r"(-?\d+(?:\.\d+)?)", 1)).try_cast("double")


def version_number(text: Column) -> Column:
    """'v12-beta' -> 12; 0 where there is no version."""
    return F.coalesce(blank_to_null(F.regexp_extract(text, r"v(\d+)", 1)).try_cast("bigint"), F.lit(0))


def plain_number(text: Column) -> Column:
    """A text that is a number and nothing else, as double; NULL otherwise."""
    bare = F.trim(text)
    return F.when(bare.rlike(PLAIN_NUMBER), bare.try_cast("double"))


def divide(top: Column, bottom: Column) -> Column:
    """NULL instead of an error for a zero or missing divisor."""
    return F.try_divide(top, F.nullif(bottom, F.lit(0)))


def _unless_any_null(columns, value: Column) -> Column:
    present = columns[0].isNotNull()
    for c in columns[1:]:
        present = present & c.isNotNull()
    return F.when(present, value)


def greatest_or_null(*columns: Column) -> Column:
    """greatest() skips NULLs in Spark; here one NULL makes the result NULL."""
    return _unless_any_null(columns, F.greatest(*columns))


def least_or_null(*columns: Column) -> Column:
    return _unless_any_null(columns, F.least(*columns))


def clip(value: Column, low: Column, high: Column) -> Column:
    return greatest_or_null(low, least_or_null(high, value))


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero by its decimal digits, not its binary ones.

    From 1e25 on a double has no decimals, and stays as it is, as do NaN and the infinities.
    """
    rounded = F.round(F.when(F.abs(value) < 1e25, value).cast("decimal(38,12)"), digits).cast("double")
    return F.coalesce(rounded, value.cast("double"))


def rescale_1_10(score: Column) -> Column:
    """A 1..10 score on the 0..10 scale."""
    return (score - F.lit(1)) / F.lit(9.0) * F.lit(10)


def decimals_to_double(df):
    """DECIMAL amounts become doubles where scoring starts."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
