"""Result order: nulls last ascending, nulls first descending, ties broken by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, *keys: str, top_n: int | None = None) -> DataFrame:
    """Sort by ``keys``; a leading "-" means descending.

    Pass a unique trailing key when the leading one has heavy ties: range
    partitioning can then split rows that share a value.  With ``top_n`` Spark
    keeps only n rows per task instead of sorting everything.
    """
    cols = [
        F.col(k[1:]).desc_nulls_first() if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in keys
    ]
    out = df.orderBy(*cols)
    return out if top_n is None else out.limit(top_n)
