"""Big-endian cell values of key-value stores, decoded and encoded in SQL expressions.

Whole-number arithmetic on doubles is exact here: a 52-bit fraction and a power of two
both fit, so no value is rounded on the way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unsigned(value: Column, first: int, count: int) -> Column:
    """``count`` bytes from byte ``first`` (1-based) as a non-negative BIGINT (up to 7 bytes)."""
    return F.conv(F.hex(F.substring(value, first, count)), 16, 10).cast("bigint")


def _has_length(value: Column, size: int, result: Column) -> Column:
    return F.when(F.octet_length(value) == size, result)


def decode_int(value: Column) -> Column:
    raw = _unsigned(value, 1, 4)
    return _has_length(value, 4, F.when(raw >= 2**31, raw - 2**32).otherwise(raw).cast("int"))


def decode_long(value: Column) -> Column:
    high, low = _unsigned(value, 1, 4), _unsigned(value, 5, 4)
    return _has_length(value, 8, F.when(high >= 2**31, high - 2**32).otherwise(high) * 2**32 + low)


def _ieee(negative: Column, exponent: Column, fraction: Column, bits: int, bias: int) -> Column:
    top = 2 * bias + 1
    sign = F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))
    part = fraction.cast("double") / float(2**bits)
    two = F.lit(2.0)
    return (
        F.when((exponent == top) & (fraction == 0), sign * F.lit(float("inf")))
        .when(exponent == top, F.lit(float("nan")))
        .when(exponent == 0, sign * part * F.pow(two, F.lit(float(1 - bias))))
        .otherwise(sign * (part + 1.0) * F.pow(two, (exponent - bias).cast("double")))
    )


def decode_double(value: Column) -> Column:
    head = _unsigned(value, 1, 2)
    exponent = F.shiftright(head, 4) % 2048
    fraction = (head % 16) * 2**48 + _unsigned(value, 3, 6)
    return _has_length(value, 8, _ieee(head >= 2**15, exponent, fraction, 52, 1023))


def decode_float(value: Column) -> Column:
    word = _unsigned(value, 1, 4)
    exponent = F.shiftright(word, 23) % 256
    fraction = word % 2**23
    return _has_length(value, 4, _ieee(word >= 2**31, exponent, fraction, 23, 127).cast("float"))


def encode_int(value: Column) -> Column:
    return F.unhex(F.right(F.hex(value.cast("bigint") + F.lit(2**32)), F.lit(8)))


def encode_long(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def encode_double(value: Column) -> Column:
    """IEEE-754 bytes of a double."""
    size = F.abs(value)
    normal = (size >= F.lit(2.0**-1022)) & (size < F.lit(float("inf")))
    safe = F.when(normal, size).otherwise(F.lit(1.0))
    guess = F.floor(F.log2(safe)).cast("double")
    two = F.lit(2.0)
    # log2 may round across a power of two; the ratio tells.
    ratio = safe / F.pow(two, guess)
    exponent = F.when(ratio >= 2, guess + 1).when(ratio < 1, guess - 1).otherwise(guess)
    fraction = ((safe / F.pow(two, exponent) - 1.0) * float(2**52)).cast("bigint")
    magnitude = (
        F.when(F.isnan(value), F.lit(0x7FF8 * 2**48))
        .when(size == float("inf"), F.lit(0x7FF0 * 2**48))
        .when(normal, (exponent.cast("bigint") + 1023) * 2**52 + fraction)
        .otherwise((size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint"))
    )
    # Zero carries its sign only in its text form.
    negative = (value < 0) | ((value == 0) & value.cast("string").startswith("-"))
    sign = F.when(negative, F.lit(-(2**63))).otherwise(F.lit(0).cast("bigint"))
    return encode_long(magnitude.bitwiseOR(sign))


def encode_text(value: Column) -> Column:
    return F.encode(value, "UTF-8")


def cell_name(qualifier: Column) -> Column:
    """The name after the type prefix, for qualifiers of the form ``<type>_<name>``."""
    return F.when(qualifier.rlike(r"\A[isdf]_[^_]+\z"), F.substring(qualifier, 3, 2**31 - 1))


def cell_text(qualifier: Column, value: Column) -> Column:
    """The value as text, read by the qualifier's type prefix ``i``, ``s``, ``d`` or ``f``."""
    prefix = F.substring(qualifier, 1, 1)
    return (
        F.when(prefix == "i", decode_int(value).cast("string"))
        .when(prefix == "s", F.decode(value, "UTF-8"))
        .when(prefix == "d", decode_double(value).cast("string"))
        .when(prefix == "f", decode_float(value).cast("string"))
    )
