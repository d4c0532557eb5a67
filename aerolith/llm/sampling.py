"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCALE = 1 << 30


def sample_by_label(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of ``key``: the same rows whatever the partitioning.

    Counts the labels first; a label's expected share of the sample is exactly ``per_label`` rows, or all it has.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("n")).collect()  # one row a label
    shares = {row[label]: min(1.0, per_label / row.n) for row in counts}
    chosen = F.lit(False)
    spread = F.pmod(F.xxhash64(key), F.lit(_SCALE))
    for value, share in sorted(shares.items(), key=lambda x: str(x[0])):
        if value is not None:
            chosen = F.when(F.col(label) == F.lit(value), spread < int(share * _SCALE) + (share == 1.0)).otherwise(chosen)
    return rows.where(chosen)
