"""Epoch milliseconds and the three kinds of time column."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

# Fixed value: largest epoch-millisecond magnitude a request may carry.
MAX_EPOCH_MS = 8_640_000_000_000_000

_DAY = 86_400_000
# Fixed value: what counts as a number in request text.
_NUMERIC = r"^\s*-?\d+(\.\d+)?\s*$"


def is_time(kind: DataType) -> bool:
    return isinstance(kind, (DateType, TimestampType, TimestampNTZType))


def ntz_from_ms(ms: int) -> Column:
    """Zone-free timestamp of an epoch-millisecond value, whatever the session time zone."""
    return ntz_from_epoch(F.lit(ms).cast("long"))


def ntz_from_epoch(ms: Column) -> Column:
    """The same for a column; days and the rest apart, so that the whole request range fits."""
    rest = F.pmod(ms, F.lit(_DAY))
    days, seconds = ((ms - rest) / _DAY).cast("int"), (rest.cast("decimal(10,0)") / 1000).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def time_literal(ms: int, kind: DataType) -> Column:
    """A literal of the column's own type, so that the comparison reaches the scan."""
    if isinstance(kind, DateType):
        return ntz_from_ms(ms).cast("date")
    if isinstance(kind, TimestampNTZType):
        return ntz_from_ms(ms)
    if isinstance(kind, TimestampType):
        return F.timestamp_millis(F.lit(ms).cast("long"))
    if isinstance(kind, StringType):
        at = datetime.fromtimestamp(ms / 1000, timezone.utc)
        return F.lit(at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z")
    raise ValueError(f"Time column cannot be of type {kind.simpleString()}")


def epoch_ms(column: Column, kind: DataType) -> Column:
    """Epoch milliseconds; dates and zone-free timestamps are read as UTC, whatever the session time zone."""
    if isinstance(kind, TimestampType):
        return F.unix_millis(column)
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("long") * _DAY
    minutes = (F.hour(column) * 60 + F.minute(column)).cast("long")
    rest = F.floor(F.extract(F.lit("SECOND"), column) * 1000).cast("long")
    return F.unix_date(column.cast("date")).cast("long") * _DAY + minutes * 60_000 + rest


def utc_date(column: Column, kind: DataType) -> Column:
    """Day of a time value in UTC."""
    return ntz_from_epoch(F.unix_millis(column)).cast("date") if isinstance(kind, TimestampType) else column.cast("date")


def parse_instant(text: str) -> int | None:
    """Epoch milliseconds of one request value; None for an open end; ValueError when unreadable."""
    word = text.strip()
    if word == "" or word.lower() == "null":
        return None
    if not re.fullmatch(r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?", word):
        raise ValueError(word)
    ms = int(float(word))
    if abs(ms) > MAX_EPOCH_MS:
        raise ValueError(word)
    return ms


def is_epoch_text(text: Column) -> Column:
    """Numeric text that stands for an epoch-millisecond instant."""
    return text.rlike(_NUMERIC) & (F.abs(text.try_cast("double")) <= MAX_EPOCH_MS)


def coerce_time(text: Column, kind: DataType) -> Column:
    """Edit value for a date or timestamp column: epoch milliseconds or ISO text; NULL when unreadable."""
    ms = F.when(is_epoch_text(text), text.try_cast("double").cast("long"))
    iso = F.regexp_replace(text, r"(?i)z\s*$", "")
    if isinstance(kind, TimestampType):
        zoned = F.when(text.rlike(r"(?i)(z|[-+]\d\d:?\d\d)\s*$"), text).otherwise(F.concat(text, F.lit("Z")))
        return F.when(ms.isNotNull(), F.timestamp_millis(ms)).otherwise(zoned.try_cast("timestamp"))
    moment = ntz_from_epoch(ms)
    return F.when(ms.isNotNull(), moment.cast(kind)).otherwise(iso.try_cast("timestamp_ntz").cast(kind))
