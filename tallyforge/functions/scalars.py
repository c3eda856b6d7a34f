"""Column functions with the exact value rules of the parse and share steps. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts accepted as whole numbers and as dates.
INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
DATE_TEXT = r"^(?!0000)[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])\z"
DATE_PREFIX_LENGTH = 10
BATCH_STAMP = "yyyyMMdd_HHmmss"

# A share is a double; twelve decimals remove its noise and still tell apart every ratio of two 32-bit counts.
SHARE_SCALE = "decimal(18,12)"


def safe_int(text: Column) -> Column:
    """Whole number in a text, else NULL: '12', ' 12 ', '+5' and '1_000' count; '12.0', '1e3' and '1,234' do not.

    The pattern decides first: a failing try_cast costs an exception per value, which dirty data would pay often.
    """
    return F.when(text.rlike(INT_TEXT), _digits(text).try_cast("int"))


def int_overflows(text: Column) -> Column:
    """True for a whole number that a 32-bit integer cannot hold."""
    return F.coalesce(text.rlike(INT_TEXT) & _digits(text).try_cast("int").isNull(), F.lit(False))


def _digits(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def safe_date(text: Column) -> Column:
    """Date in the first ten characters of a text, else NULL; one-digit months and days are accepted."""
    head = F.substring(text, 1, DATE_PREFIX_LENGTH)
    return F.when(head.rlike(DATE_TEXT), F.replace(head, F.lit(" "), F.lit("")).try_cast("date"))


def any_flag(flags: Iterable[Column]) -> Column:
    """True if any flag text is present and not empty; '0' and ' ' count as set."""
    result = F.lit(False)
    for flag in flags:
        result = result | (F.coalesce(flag, F.lit("")) != "")
    return result


def share_pct(part: Column, total: Column) -> Column:
    """part / total in percent, two decimals, halves away from zero; NULL when the total is 0 or NULL."""
    ratio = part.cast("double") / F.nullif(total, F.lit(0)) * 100
    return F.round(ratio.cast(SHARE_SCALE), 2).cast("decimal(5,2)")


def exact_mean(total: Column, n: Column) -> Column:
    """total / n for whole numbers, two decimals, without going through double."""
    return F.round(total.cast("decimal(20,0)") / F.nullif(n, F.lit(0)), 2).cast("decimal(10,2)")


def batch_id(stamp: Column, prefix: str = "full_") -> Column:
    """Batch name made of a prefix and a UTC time to the second."""
    return F.concat(F.lit(prefix), F.date_format(stamp, BATCH_STAMP))


def variant_text(value: Column) -> Column:
    """Text of a variant: a string as it is, anything else as its JSON."""
    return F.try_variant_get(value, "$", "string")


def _is_fraction(kind: Column) -> Column:
    return kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")


def typed_int(value: Column) -> Column:
    """Whole number in a variant by its JSON type: numbers are truncated, true is 1, texts go through safe_int."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", safe_int(variant_text(value)))
        .when(kind == "BIGINT", F.try_variant_get(value, "$", "int"))
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("int"))
        .when(_is_fraction(kind), F.try_variant_get(value, "$", "double").try_cast("int"))
    )


def typed_int_overflows(value: Column) -> Column:
    """True for a whole number in a variant that a 32-bit integer cannot hold: a JSON number, or a text that `safe_int` knows."""
    kind = F.schema_of_variant(value)
    is_number = (kind == "BIGINT") | _is_fraction(kind)
    too_large = F.when(kind == "STRING", int_overflows(variant_text(value))).when(is_number, typed_int(value).isNull())
    return F.coalesce(too_large, F.lit(False))


def typed_flag(value: Column) -> Column:
    """Truth of a variant by its JSON type: absent, null, '', 0, false, [] and {} are false."""
    kind = F.schema_of_variant(value)
    truth = (
        F.when(kind == "STRING", variant_text(value) != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when((kind == "BIGINT") | _is_fraction(kind), F.try_variant_get(value, "$", "double") != 0)
        .when(kind.isNotNull() & (kind != "VOID"), ~F.to_json(value).isin("[]", "{}"))
    )
    return F.coalesce(truth, F.lit(False))
