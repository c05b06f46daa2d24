"""Tolerant text-to-number conversion: dirty text gives NULL, it never raises."""
from pyspark.sql import Column, functions as F

# What a lenient Spark cast ignores around a number.
_PADDING = r"^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+$"


def whole_number(text: Column) -> Column:
    """Integer value of ``text``, any decimal part cut off (``1.5`` gives 1).

    The rule of a cast with ANSI mode off: ``.5`` gives 0, ``1e3`` and anything
    outside the range of an INT give NULL.
    """
    bare = F.regexp_replace(text, _PADDING, "")
    return F.when(bare.rlike(r"^[+-]?\.[0-9]*$"), F.lit(0)).otherwise(
        F.regexp_extract(bare, r"^([+-]?[0-9]+)(?:\.[0-9]*)?$", 1).try_cast("int")
    )


def finite_double(text: Column) -> Column:
    """Double value of ``text``; NULL for bad text and for NaN and infinities.

    One NaN would turn a whole revenue sum into NaN.
    """
    value = text.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)
