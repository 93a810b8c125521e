"""Bounded, repeatable samples of labelled rows for training on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(rows: DataFrame, label: str, bound: int, key: str = "doc_id") -> tuple[DataFrame, dict]:
    """About ``bound`` rows of each label, chosen by a hash of the key; and the share taken of each label.

    All rows of a label are taken if there are no more than ``bound``.  The choice
    depends on neither partitions nor order.  One count over the two columns finds
    the shares; rows with a null label are left out.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    shares = {k: min(1.0, bound / n) for k, n in counts.items()}
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1_000_000))
    limit = F.lit(0)
    for k, share in shares.items():
        limit = F.when(F.col(label) == F.lit(k), int(share * 1_000_000)).otherwise(limit)
    return rows.where(draw < limit), shares
