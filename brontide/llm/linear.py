"""What the two text classifiers share: bounded training samples and the order in which rows enter them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(n))


def sample(rows: DataFrame, by: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class, at most twice that and all of a small class, by a hash of doc_id.

    A class is thinned by a threshold on the hash that follows from its count, so no class meets in
    one task and the choice doesn't depend on order. Counts are needed, and broadcast, only of classes
    that are thinned: at most one for each ``per_class`` rows. All rows of the others stay.
    """
    sizes = rows.groupBy(by).agg(F.count("*").alias("_n"))
    lucky = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < F.lit(per_class * float(1 << 30)) / F.col("_n")
    large = sizes.where(F.col(by).isNotNull() & (F.col("_n") > per_class))
    return rows.where(F.col(by).isNotNull()).join(F.broadcast(large), by, "left").where(F.col("_n").isNull() | lucky).drop("_n")
