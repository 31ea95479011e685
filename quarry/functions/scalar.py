"""Column helpers built only from JVM-side built-ins (stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_decimals(c: str | Column, places: int = 2) -> Column:
    """Cut (not round) a double to ``places`` decimals: multiply, cast long, divide."""
    scale = 10 ** places
    return (_c(c) * scale).cast("long") / scale


def micros_to_timestamp(c: str | Column) -> Column:
    """Epoch microseconds (bigint) -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_micros(_c(c).cast("bigint")).cast("timestamp_ntz")


def seconds_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds (number or numeric text) -> TIMESTAMP_NTZ, sub-second dropped."""
    return F.timestamp_seconds(_c(c).cast("double").cast("long")).cast("timestamp_ntz")


def email_domain(c: str | Column) -> Column:
    """Text after the '@' (look-behind regex, as the cleaning lesson does)."""
    return F.regexp_extract(_c(c), r"(?<=@).+", 0)


def first_letter(c: str | Column) -> Column:
    """First character: the native twin of the lesson's Python UDF."""
    return F.substring(_c(c), 1, 1)


def mask_keep_last(c: str | Column, keep: int = 2, fill: str = "*") -> Column:
    """Replace all but the last ``keep`` characters with ``fill``.

    Strings shorter than ``keep`` are returned unchanged (no negative repeat).
    """
    s = _c(c)
    n = F.length(s)
    return F.when(n <= keep, s).otherwise(
        F.concat(F.repeat(F.lit(fill), (n - keep).cast("int")), F.right(s, F.lit(keep))))


# The email-validity pattern of the customers pipeline.
EMAIL_PATTERN = r"^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$"


def valid_email(c: str | Column) -> Column:
    """True when the text looks like handle@domain.tld (``rlike``)."""
    return _c(c).rlike(EMAIL_PATTERN)
