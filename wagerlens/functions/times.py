"""Moments passed between Python and Spark. A naive datetime means UTC throughout."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def stamp(moment: datetime) -> Column:
    """A timestamp literal, independent of the time zone Python runs in."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(" ", "microseconds") + "+00:00").cast("timestamp")


def moment_of(df: DataFrame, value: Column) -> datetime | None:
    """The one value of an aggregate as a naive UTC datetime."""
    text = df.agg(F.date_format(F.to_utc_timestamp(value, F.current_timezone()), _FORMAT)).first()[0]
    return None if text is None else datetime.fromisoformat(text)
