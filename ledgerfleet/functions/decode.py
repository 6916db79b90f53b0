"""Text-cell decoding of ledger values.

An external database hands the ledger over as text (S6); these turn the
cells back into typed columns with built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# Timestamp text forms tried in order: RFC 3339 (with Z or an offset), then
# 'YYYY-MM-DD HH:MM:SS' and the same with a fraction.
RFC3339 = r"^(\d{4}-\d{2}-\d{2})[Tt](\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?)([Zz]|[+-]\d{2}:\d{2})$"
PLAIN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{1,9})?$"
# Text read as boolean true (compared lower-cased); anything else is false.
TRUE_WORDS = ["true", "1", "t", "yes", "y"]
# Ranges of the whole numbers a ledger holds.
U32_MAX, I32_MIN, I32_MAX = 4294967295, -2147483648, 2147483647
# -------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decode_timestamp(text) -> Column:
    """The instant as TIMESTAMP_NTZ in UTC, NULL when the text has none
    of the forms (the reference substitutes the current time, SURVEY Q14).
    Works without the session time zone: the local part is cast to NTZ and
    an RFC 3339 offset is subtracted as an interval."""
    text = _c(text)
    local = F.concat(F.regexp_extract(text, RFC3339, 1), F.lit(" "), F.regexp_extract(text, RFC3339, 2))
    off = F.regexp_extract(text, RFC3339, 3)
    secs = (F.when(F.upper(off) == "Z", F.lit(0))
            .otherwise((F.substring(off, 2, 2).cast("int") * 3600 + F.substring(off, 5, 2).cast("int") * 60)
                       * F.when(off.startswith("-"), F.lit(-1)).otherwise(F.lit(1))))
    rfc = local.try_cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    plain = text.try_cast("timestamp_ntz")
    return (F.when(text.rlike(RFC3339), rfc)
            .when(text.rlike(PLAIN), plain))


def decode_boolean(text) -> Column:
    """P14."""
    return F.coalesce(F.lower(_c(text)).isin(*TRUE_WORDS), F.lit(False))


def decode_int_or_zero(text, low: int = 0, high: int = U32_MAX) -> Column:
    """An optionally signed run of digits within [low, high], else 0.
    Versions are unsigned 32-bit numbers (the default), durations signed ones
    (``low=I32_MIN, high=I32_MAX``)."""
    number = F.when(_c(text).rlike(r"^[+-]?[0-9]+$"), _c(text).try_cast("bigint"))
    return F.when(number.between(low, high), number).otherwise(F.lit(0).cast("bigint"))
