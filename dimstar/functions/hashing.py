"""Row fingerprint: SHA-256 hex of the fields joined by '|', NULL as ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field_text(c: Column | str) -> Column:
    """Text of one field; NULL becomes '' so the separators stay in place."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def ts_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def money_text(c: Column | str) -> Column:
    """``%.2f`` of a price (half-up on the decimal text, equal for prices with
    at most two decimals)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.format_string("%.2f", col)


def hash_record(*fields: Column | str) -> Column:
    """``sha2(concat_ws('|', coalesce(f1,''), ...), 256)``."""
    return F.sha2(F.concat_ws("|", *[field_text(f) for f in fields]), 256)
