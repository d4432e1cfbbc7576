"""Table maintenance: time-based retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pylonflow.functions.timeutil import as_time, duration_us, shift_time, time_literal


def retain(df: DataFrame, time_col: str, keep: str = "8 hours",
           as_of: datetime | str | Column | None = None) -> DataFrame:
    """Rows newer than ``as_of - keep`` (strictly).

    ``as_of`` defaults to the newest ``time_col`` value, planned as a scalar
    subquery (one partial max per partition, no cross join, nothing collected
    by the caller). The filter is pushed into the parquet scan when ``as_of``
    is a literal.
    """
    t, ntz = as_time(df, time_col)
    now = df.select(F.max(t)).scalar() if as_of is None else time_literal(as_of, ntz)
    return df.filter(t > shift_time(now, -duration_us(keep), ntz))
