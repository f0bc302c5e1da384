"""Column expressions: recodes, ratios and the hash bucket used for reproducible splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.spec import ATTACK, NORMAL

# Numeric codes of the protocol and connection-flag names; other names take the
# default.
PROTOCOL_CODES = {"tcp": 0, "udp": 1}
PROTOCOL_DEFAULT = 2
FLAG_CODES = {
    "SF": 0,
    "S0": 1,
    "S1": 2,
    "S2": 3,
    "S3": 4,
    "SH": 5,
    "OTH": 6,
    "REJ": 7,
    "RSTO": 8,
    "RSTOS0": 9,
}
FLAG_DEFAULT = 10


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def map_codes(value: Column | str, codes: Mapping[str, int], default: int) -> Column:
    """The code of ``value``; unknown and null values take ``default``."""
    result = F.lit(default)
    for name, code in reversed(codes.items()):
        result = F.when(_column(value) == name, F.lit(code)).otherwise(result)
    return result.cast("int")


def protocol_code(value: Column | str) -> Column:
    return map_codes(value, PROTOCOL_CODES, PROTOCOL_DEFAULT)


def flag_code(value: Column | str) -> Column:
    return map_codes(value, FLAG_CODES, FLAG_DEFAULT)


def class_binarize(value: Column | str, normal: str = NORMAL, other: str = ATTACK) -> Column:
    """Every class but ``normal`` becomes ``other``; a null class stays null."""
    return F.when(_column(value) != normal, F.lit(other)).otherwise(_column(value))


def coded_connection(df: DataFrame) -> DataFrame:
    """Connection records with numbers in place of protocol and flag names."""
    return df.withColumns({"protocol_type": protocol_code("protocol_type"), "flag": flag_code("flag")})


# Recodes that a saved model can name, to be applied to raw records before its encoding.
RECODES = {"coded_connection": coded_connection}


def class_to_numeric(value: Column | str, normal: str = NORMAL) -> Column:
    """1.0 for ``normal``, 0.0 for any other class; a null class counts as normal."""
    return F.when(_column(value) != normal, F.lit(0.0)).otherwise(F.lit(1.0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """The quotient as a double; null where the denominator is zero."""
    return F.try_divide(
        _column(numerator).cast("double"), _column(denominator).cast("double")
    )


# Stands for a null part of a key, so that it differs from an empty or missing one.
NULL_PART = "\x00null"


def key_number(key: str | Sequence[str], part: int = 0, salt: str | None = None) -> Column:
    """A number in ``[0, 2^32)`` that depends only on the key's text.

    ``part`` picks one of four independent numbers of the same key, ``salt`` another family.
    Unlike sampling by seed, it does not change with the partitioning of the input.
    """
    columns = [key] if isinstance(key, str) else list(key)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART)) for c in columns]
    salted = texts if salt is None else [F.lit(salt), *texts]
    digest = F.md5(F.concat_ws("|", *salted))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint")


def hash_bucket(key: str | Sequence[str], buckets: int = 100, part: int = 0) -> Column:
    """A bucket in ``[0, buckets)`` that depends only on the key's text."""
    return F.pmod(key_number(key, part), F.lit(buckets)).cast("int")
