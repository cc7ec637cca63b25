"""Wire text to typed values, in built-in expressions only (no Python worker, never raises on bad input)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import Field

_TWO_64 = "18446744073709551616"


def decimal_from_base64(text: Column, precision: int = 12, scale: int = 2) -> Column:
    """Base64 of a big-endian two's-complement unscaled integer -> ``decimal(precision, scale)``.

    NULL for text that is not base64, for more than 16 bytes and for values beyond the target; '' is 0.
    """
    target = f"decimal({precision},{scale})"
    digits = F.hex(F.try_to_binary(text, F.lit("base64")))
    filler = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")

    def scaled(number: Column) -> Column:
        return F.concat(number, F.lit(f"E-{scale}")).try_cast(target)

    # Up to 8 bytes: one signed conversion.
    short = scaled(F.conv(F.lpad(digits, 16, filler), 16, -10))
    # Up to 16 bytes: signed high half * 2^64 + unsigned low half.
    wide_digits = F.lpad(digits, 32, filler)
    high = F.conv(F.substring(wide_digits, 1, 16), 16, -10).cast("decimal(20,0)")
    low = F.conv(F.substring(wide_digits, 17, 16), 16, 10).cast("decimal(20,0)")
    wide = scaled(F.try_add(F.try_multiply(high, F.lit(_TWO_64).cast("decimal(20,0)")), low).cast("string"))

    size = F.length(digits)
    return (
        F.when(text == "", F.lit(0).cast(target))
        .when(F.length(text) % 4 != 0, F.lit(None).cast(target))
        .when(size <= 16, short)
        .when(size <= 32, wide)
    )


def micro_timestamp(text: Column) -> Column:
    """Microseconds since the epoch -> timestamp."""
    return F.timestamp_micros(text.try_cast("bigint"))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text, with or without a UTC offset -> timestamp."""
    return text.try_cast("timestamp")


def decode_field(field: Field, text: Column) -> Column:
    """The typed value of one wire column."""
    match field.kind:
        case "decimal":
            return decimal_from_base64(text, field.precision, field.scale)
        case "micros":
            return micro_timestamp(text)
        case "iso":
            return iso_timestamp(text)
        case "string":
            return text
        case _:
            return text.try_cast(field.data_type)
