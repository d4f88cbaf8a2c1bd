"""Latest-row-per-key selection (the ``QUALIFY ROW_NUMBER() ... = 1`` idiom).

``row_number() = 1`` over a window is planned with a partial
WindowGroupLimit before the shuffle, so even a key that holds a third of all
rows sends only one row per map task to the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, ts_col: str, tie_breakers: Sequence[str]) -> list[Column]:
    """``ts DESC NULLS LAST`` then the tie-breaker columns, descending; all of them must be there, as the
    answer would depend on the order of the input without one."""
    missing = [c for c in (ts_col, *tie_breakers) if c not in df.columns]
    if missing:
        raise ValueError(f"newest row of a key needs the columns {', '.join(missing)}")
    return [F.col(c).desc_nulls_last() for c in (ts_col, *tie_breakers)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """Rows ranked ``<= n`` within each key by ``order`` (ties must be broken by the caller)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
