"""Row filters over investigations."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DAYS = 3

# First messages containing one of these, in any case, are noise.
NOISE = ("timeout", "cancelled", "aborted")


def positive_days(value: int | str) -> int:
    """A look-back in whole days; anything but a positive number is an error."""
    try:
        days = int(value)
    except ValueError:
        days = 0
    if days <= 0:
        raise ValueError(f"invalid days value {value!r}: must be a positive number")
    return days


def first_message() -> Column:
    """Message of the first exception, NULL when there is none.

    Taken from the ``exceptions_data.message`` array, so a columnar scan reads
    only that leaf and not the function lists beside it.
    """
    return F.get(F.col("exceptions_data.message"), F.lit(0))


def cutoff(days: int, as_of: datetime | Column | None = None) -> Column:
    """Earliest timestamp of a look-back ending at ``as_of`` (default: now)."""
    end = F.current_timestamp() if as_of is None else as_of
    end = end if isinstance(end, Column) else F.lit(end)
    return end - F.make_dt_interval(F.lit(positive_days(days)))


def lookback(
    investigations: DataFrame,
    days: int = DEFAULT_DAYS,
    as_of: datetime | Column | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Rows of the last ``days`` days.

    ``date_column`` names a partition column holding the date of ``timestamp``;
    partitions before the cut-off are then never listed or read.
    """
    start = cutoff(days, as_of)
    recent = investigations.where(F.col("timestamp") >= start)
    if date_column:
        recent = recent.where(F.col(date_column) >= F.to_date(start))
    return recent


def with_exceptions(investigations: DataFrame) -> DataFrame:
    """Rows with at least one exception, a payload pointer and a first message."""
    return investigations.where(
        (F.size("exceptions_data.message") > 0)
        & (F.col("s3_pointer") != "")
        & (first_message() != "")
    )


def without_noise(investigations: DataFrame, noise: tuple[str, ...] = NOISE) -> DataFrame:
    """Rows whose first message contains none of the plain-text ``noise`` tokens."""
    if not noise:
        return investigations
    message = F.lower(first_message())
    hits = [F.contains(message, F.lit(token.lower())) for token in noise]
    return investigations.where(~reduce(or_, hits))


def actionable(investigations: DataFrame, noise: tuple[str, ...] = NOISE) -> DataFrame:
    """All row filters but the look-back; stateless, so also usable on a stream."""
    return without_noise(with_exceptions(investigations), noise)
