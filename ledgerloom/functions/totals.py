"""Total rows formed in the same pass as the detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_totals(df: DataFrame, keys: list[str], per: list[str], sums: list[str],
                label: str, text: str) -> DataFrame:
    """Sums by ``keys`` and, in total rows, by ``per`` (a part of ``keys``).

    A total row has ``text`` in column ``label``.  Call it on aggregated rows:
    grouping sets duplicate their input.
    """
    grouped = df.groupingSets([keys, per], *keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.grouping(label).alias("_total"))
    shown = F.when(F.col("_total") == 1, text).otherwise(F.col(label))
    return grouped.withColumn(label, shown).drop("_total")
