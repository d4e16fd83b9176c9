"""Quality checks: gaps, order, duplicates, completeness, conservation and archive proofs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import window_start
from .ordered import by_day, by_million, with_previous


def time_gaps(rows: DataFrame, factor: float = 1.75) -> DataFrame:
    """market, gap_start, gap_end where consecutive times lie more than ``factor`` median steps apart."""
    steps = with_previous(rows.select("market", "ts").distinct(), ["market"], ["ts"], {"prev": F.col("ts")}, by_day()).where("prev is not null")
    usual = steps.groupBy("market").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY ts - prev)").cast("long").alias("step"))
    return steps.join(usual, "market").where(F.col("ts") - F.col("prev") > factor * F.col("step")).select("market", (F.col("prev") + F.col("step")).alias("gap_start"), F.col("ts").alias("gap_end"))


def sequence_gaps(rows: DataFrame, by: str, seq: str, order: str) -> DataFrame:
    """For each ``by``: rows, gaps (a step over 1), repeats (a step of 0 or less) of a sequence number in ``order``."""
    step = F.col(seq) - F.col("_before")
    return with_previous(rows, [by], [order], {"_before": F.col(seq)}, by_million(order)).withColumn("step", step).groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col("step") > 1).alias("gaps"), F.count_if(F.col("step") <= 0).alias("repeats"))


def inversions(rows: DataFrame, by: str, order: str) -> DataFrame:
    """For each ``by``: rows and how many have a time before that of the row in front of them."""
    back = F.col("ts") < F.col("_before")
    return with_previous(rows, [by], [order], {"_before": F.col("ts")}, by_million(order)).withColumn("back", back).groupBy(by).agg(F.count("*").alias("n"), F.count_if("back").alias("inversions"))


def audit(rows: DataFrame, step: int) -> DataFrame:
    """Rows, first and last time, repeated times and gaps over ``step`` of each market."""
    times = rows.groupBy("market", "ts").agg(F.count("*").alias("n"))
    times = with_previous(times, ["market"], ["ts"], {"_before": F.col("ts")}, F.coalesce(by_day(), F.lit(-1))).withColumn("gap", F.col("ts") - F.col("_before"))
    return times.groupBy("market").agg(F.sum("n").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("gap") > step).alias("gaps"))


def shared_times(rows: DataFrame) -> DataFrame:
    """Times at which more than one market has rows."""
    return rows.groupBy("ts").agg(F.count_distinct("market").alias("markets")).where("markets > 1")


def complete(status: DataFrame, required: list[str]) -> DataFrame:
    """data_complete: every required market is running and not degraded; true if none is required; absent ones are not."""
    need = status.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, required)).cast("array<string>")).alias("market"))
    ok = F.coalesce((F.col("state") == "running") & ~F.col("degraded"), F.lit(False))
    return need.join(status, "market", "left").agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("data_complete"))


def conservation(cells: DataFrame, trades: DataFrame, width: int) -> DataFrame:
    """For each (market, window): whether the cells of a footprint hold all trades and their notional."""
    a = cells.groupBy("market", "window").agg(F.sum("n").alias("cell_n"), F.sum("notional").alias("cell_notional"))
    b = trades.groupBy("market", window_start(F.col("ts"), width).alias("window")).agg(F.count("*").alias("n"), F.sum(F.col("price") * F.col("qty")).alias("notional"))
    tolerance = F.greatest(F.lit(0.01), F.col("notional") * 1e-9)
    ok = (F.col("cell_n") == F.col("n")) & (F.abs(F.col("cell_notional") - F.col("notional")) <= tolerance)
    return b.join(a, ["market", "window"], "left").select("market", "window", "n", F.coalesce(ok, F.lit(False)).alias("conserved"))


def archive_proof(lines: DataFrame, block: int = 1_000) -> DataFrame:
    """market, block, lines, sha256: a digest of every ``block`` consecutive lines (market, id, line) in order.

    Blocks bound what one task gathers; equal blocks have equal digests, so a round trip is proved block by block.
    """
    parts = lines.groupBy("market", F.floor(F.col("id") / block).alias("block")).agg(F.count("*").alias("lines"), F.array_sort(F.collect_list(F.struct("id", "line"))).alias("l"))
    return parts.select("market", "block", "lines", F.sha2(F.array_join(F.col("l.line"), "\n"), 256).alias("sha256"))


def counter_deltas(rows: DataFrame, width: int) -> DataFrame:
    """For each (market, window) with two samples or more: the rise of a counter, at least 0."""
    return rows.groupBy("market", window_start(F.col("ts"), width).alias("window")).agg(F.count("*").alias("n"), F.greatest(F.max("counter") - F.min("counter"), F.lit(0)).alias("delta")).where("n >= 2")


def rates(rows: DataFrame, samples: int) -> DataFrame:
    """The latest rate of each market over its last ``samples`` samples of a counter, per second."""
    # the last of each day first: Spark keeps ``samples`` rows a day before the shuffle, then of a market's days
    latest = lambda by: Window.partitionBy(*by).orderBy(F.desc("ts"), F.desc("counter"))
    last = rows.withColumn("day", by_day()).withColumn("k", F.row_number().over(latest(["market", "day"]))).where(F.col("k") <= samples)
    last = last.withColumn("k", F.row_number().over(latest(["market"]))).where(F.col("k") <= samples)
    ends = last.groupBy("market").agg(F.max("ts").alias("b"), F.min("ts").alias("a"), F.max_by("counter", F.struct("ts", "counter")).alias("cb"), F.min_by("counter", F.struct("ts", "counter")).alias("ca"))
    return ends.where("b > a").select("market", (F.greatest(F.col("cb") - F.col("ca"), F.lit(0)) / ((F.col("b") - F.col("a")) / 1000)).alias("rate"))
