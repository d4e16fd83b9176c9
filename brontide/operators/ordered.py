"""Windows over long sequences in two levels: inside chunks of a key, then over one row a chunk.

A market is one key with terabytes of rows; a window over it would be one sort in one task. Here a
window is over (key, chunk), chunks being runs of the order (a day, a million numbers), and what goes
from one chunk into the next is a small table of the chunks' ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds and numbers of a chunk.
DAY, MILLION = 86_400_000, 1_000_000


def by_day(ts: str = "ts") -> Column:
    return F.floor(F.col(ts) / DAY)


def by_million(number: str) -> Column:
    return F.floor(F.col(number) / MILLION)


def _with_heads(rows: DataFrame, heads: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with what their chunk begins with; chunks are far fewer than rows."""
    return rows.join(heads, [*by, "_c"])


def with_previous(rows: DataFrame, by: list[str], order: list[str], names: dict[str, Column], chunk: Column) -> DataFrame:
    """``rows`` with each name: its column at the row before in ``order``; null at the first. ``chunk`` rises with the order."""
    rows = rows.withColumns({"_c": chunk, "_v": F.struct(*(x.alias(n) for n, x in names.items()))})
    ends = rows.groupBy(*by, "_c").agg(F.max_by("_v", F.struct(*order)).alias("_v"))
    heads = ends.select(*by, "_c", F.lag("_v").over(Window.partitionBy(*by).orderBy("_c")).alias("_h"))
    own = F.lag("_v").over(Window.partitionBy(*by, "_c").orderBy(*order))
    rows = _with_heads(rows.withColumn("_p", own), heads, by).withColumn("_p", F.coalesce("_p", "_h"))
    return rows.withColumns({n: F.col("_p")[n] for n in names}).drop("_c", "_v", "_h", "_p")


def with_running(rows: DataFrame, by: list[str], order: list[str], name: str, x: Column, chunk: Column, how: str = "sum", strict: bool = False) -> DataFrame:
    """``rows`` with the running sum or max of ``x`` in ``order``, up to the row, or to the one before it (``strict``)."""
    f = {"sum": F.sum, "max": F.max}[how]
    rows = rows.withColumns({"_c": chunk, "_x": x})
    before = Window.partitionBy(*by).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy(*by, "_c").agg(f("_x").alias("_x")).select(*by, "_c", f("_x").over(before).alias("_h"))
    inside = f("_x").over(Window.partitionBy(*by, "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if strict else 0))
    rows = _with_heads(rows.withColumn("_r", inside), heads, by)
    both = F.col("_r") + F.col("_h") if how == "sum" else F.greatest("_r", "_h")
    return rows.withColumn(name, F.coalesce(both, "_r", "_h")).drop("_c", "_x", "_h", "_r")


def with_last(rows: DataFrame, by: list[str], order: list[str], name: str, x: Column, chunk: Column) -> DataFrame:
    """``rows`` with the last ``x`` that isn't null, up to the row in ``order``."""
    rows = rows.withColumns({"_c": chunk, "_x": x})
    ends = rows.groupBy(*by, "_c").agg(F.max_by("_x", F.when(F.col("_x").isNotNull(), F.struct(*order))).alias("_x"))
    before = Window.partitionBy(*by).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    heads = ends.select(*by, "_c", F.last("_x", ignorenulls=True).over(before).alias("_h"))
    inside = F.last("_x", ignorenulls=True).over(Window.partitionBy(*by, "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return _with_heads(rows.withColumn("_r", inside), heads, by).withColumn(name, F.coalesce("_r", "_h")).drop("_c", "_x", "_h", "_r")
