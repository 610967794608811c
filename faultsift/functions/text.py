"""Text projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_text(text: Column) -> Column:
    return F.upper(text)
