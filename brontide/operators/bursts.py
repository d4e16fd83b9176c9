"""Bursts: maximal same-side runs of trades with a gap and a duration limit, and what is derived from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import tick_size, window_start
from ..sources.scratch import staged
from .ordered import by_day, with_previous, with_running

GAP_MS, CAP_MS = 50, 5_000


def greedy_starts(times: DataFrame, cap: int) -> DataFrame:
    """market, seg, ts, burst_start for different (market, seg, ts): a start is the first time more than ``cap`` after the one before.

    Inherently sequential in a segment, so each is streamed in order with its start as the only state.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        market = seg = start = None
        for batch in batches:
            starts = np.empty(batch.num_rows, np.int64)
            for i, (m, g, t) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("market", "seg", "ts")), strict=True)):
                if m != market or g != seg or t - start > cap:
                    market, seg, start = m, g, t
                starts[i] = start
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("market", "seg", "ts")), pa.array(starts)], ["market", "seg", "ts", "burst_start"])

    rows = times.select("market", "seg", "ts").repartition("market", "seg").sortWithinPartitions("market", "seg", "ts")
    return rows.mapInArrow(told, f"market {times.schema['market'].dataType.simpleString()}, seg long, ts long, burst_start long")


def with_bursts(trades: DataFrame, gap: int = GAP_MS, cap: int = CAP_MS) -> DataFrame:
    """``trades`` with burst_start (ts) and burst (number in its market).

    Side changes and gaps cut by the trade before and a running sum, day by day. The duration limit is greedy - a
    burst starts at the first trade more than ``cap`` after the start of the one before - so the different times of
    a segment are folded in order; only segments longer than the limit are.
    """
    order, day = ["ts", "idx"], by_day()
    rows = with_previous(trades, ["market"], order, {"p_ts": F.col("ts"), "p_side": F.col("side")}, day)
    cut = F.coalesce((F.col("side") != F.col("p_side")) | (F.col("ts") - F.col("p_ts") > gap), F.lit(True))
    rows = with_running(rows, ["market"], order, "seg", cut.cast("long"), day).drop("p_ts", "p_side")
    rows = staged(rows, "segments")
    spans = rows.groupBy("market", "seg").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    long = rows.join(spans.where(F.col("b") - F.col("a") > cap), ["market", "seg"], "left_semi").select("market", "seg", "ts").distinct()
    rows = rows.join(spans.drop("b"), ["market", "seg"]).join(greedy_starts(long, cap), ["market", "seg", "ts"], "left")
    rows = rows.withColumn("burst_start", F.coalesce("burst_start", "a")).drop("a")
    rows = with_previous(rows, ["market"], order, {"p": F.struct("seg", "burst_start")}, day)
    new = F.coalesce(F.struct("seg", "burst_start") != F.col("p"), F.lit(True))
    return with_running(rows, ["market"], order, "burst", new.cast("long"), day).withColumn("burst", F.col("burst").cast("int")).drop("p", "seg")


def bursts(trades: DataFrame, gap: int = GAP_MS, cap: int = CAP_MS) -> DataFrame:
    """One row per burst: side, times, notional, prints, prices and span in ticks."""
    return burst_table(with_bursts(trades, gap, cap))


def burst_table(rows: DataFrame) -> DataFrame:
    """``bursts`` from trades that have their burst already."""
    out = rows.groupBy("market", "burst", "side").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.sum(F.col("price") * F.col("qty")).alias("notional"), F.count("*").alias("prints"),
        F.min("price").alias("low"), F.max("price").alias("high"), F.count_distinct("price").alias("prices"),
    )
    span = F.when(F.col("prices") >= 2, F.round((F.col("high") - F.col("low")) / tick_size(F.col("market")))).otherwise(0).cast("long")
    return out.withColumns({"duration": F.col("end") - F.col("start"), "span_ticks": span})


def same_price_runs(trades: DataFrame, gap: int = GAP_MS, cap: int = CAP_MS) -> DataFrame:
    """Runs of equal price inside each burst."""
    order = Window.partitionBy("market", "burst").orderBy("ts", "idx")
    change = F.coalesce(F.col("price") != F.lag("price").over(order), F.lit(True)).cast("int")
    rows = with_bursts(trades, gap, cap).withColumn("run", F.sum(change).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("market", "burst", "run").agg(F.first("price").alias("price"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("prints"), F.sum(F.col("price") * F.col("qty")).alias("notional"))


def touched_windows(bursts_: DataFrame, width: int) -> DataFrame:
    """Each burst once for every window it touches: an interval-overlap join as an equi-join on window starts."""
    seconds = F.sequence(window_start(F.col("start"), width), window_start(F.col("end"), width), F.lit(width))
    return bursts_.withColumn("second", F.explode(seconds))


def burst_features(trades: DataFrame, width: int = 1000, length: int = 30, gap: int = GAP_MS, cap: int = CAP_MS) -> DataFrame:
    """The burst features of every grid window; windows without bursts have zeros."""
    from .trades import trailing_notional

    n, one, buy = F.col("notional"), F.col("prices") == 1, F.col("side") == "buy"
    add = lambda c, x=n: F.sum(F.when(c, x).otherwise(0.0))
    bps = F.when(~one, (F.col("high") - F.col("low")) / ((F.col("high") + F.col("low")) / 2) * 1e4)
    sums = touched_windows(bursts(trades, gap, cap), width).groupBy("market", F.col("second").alias("ts")).agg(
        F.count("*").alias("burst_count"), F.sum(n).alias("total"), F.max(n).alias("largest"), F.max("prints").alias("max_prints"), F.max("duration").alias("max_duration"),
        add(buy).alias("buy"), add(~buy).alias("sell"), F.count_if(one).alias("same_price"), F.count_if(~one).alias("multilevel"),
        F.max(F.when(one, F.col("prints"))).alias("same_price_prints"), add(one).alias("same_price_notional"),
        F.max(F.when(~one, F.col("span_ticks"))).alias("multilevel_ticks"), F.max(bps).alias("multilevel_bps"), add(~one).alias("multilevel_notional"),
    )
    rows = trailing_notional(trades, width, length).drop("notional").join(sums, ["market", "ts"], "left")
    zeros = [c for c in sums.columns if c not in ("market", "ts")]
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in zeros})
    total = F.col("total")
    return rows.select(
        "market", "ts", *zeros, ((F.col("buy") - F.col("sell")) / (F.col("buy") + F.col("sell") + 1e-10)).alias("imbalance"),
        F.when(total > 0, F.col("largest") / total).otherwise(0.0).alias("largest_share"), F.when(F.col("trailing") > 0, total / F.col("trailing")).otherwise(0.0).alias("vs_trailing"),
        F.when(total > 0, F.col("same_price_notional") / total).otherwise(0.0).alias("absorption"), (F.col("buy") - F.col("sell")).alias("delta"),
        ((F.col("burst_count") > 0) & (F.col("largest") > 5 * total / F.greatest(F.col("burst_count"), F.lit(1)))).alias("outlier"),
    )


def window_summary(trades: DataFrame, width: int = 30_000, gap: int = GAP_MS, cap: int = CAP_MS) -> DataFrame:
    """OHLC, delta and the bursts that start in each window; prints outside bursts of two or more are counted apart."""
    key, value = F.struct("ts", "idx"), F.col("price") * F.col("qty")
    rows = staged(with_bursts(trades, gap, cap), "bursts")
    table = staged(burst_table(rows), "burst-table")
    rows = rows.join(table.select("market", "burst", (F.col("prints") == 1).alias("alone")), ["market", "burst"])
    flow = rows.groupBy("market", window_start(F.col("ts"), width).alias("window")).agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"), F.sum("qty").alias("volume"),
        F.sum(F.when(F.col("side") == "buy", value).otherwise(-value)).alias("delta"), F.count_if("alone").alias("lone_prints"), F.sum(F.when(F.col("alone"), 0.0).otherwise(value)).alias("burst_value"),
    )
    b = table.groupBy("market", window_start(F.col("start"), width).alias("window")).agg(F.count("*").alias("bursts"), F.max("notional").alias("max_notional"), F.max("span_ticks").alias("max_ticks"), F.count_if(F.col("prices") >= 2).alias("multilevel"))
    return flow.join(b, ["market", "window"], "left").na.fill(0, ["bursts", "multilevel"])


def side_runs(trades: DataFrame, width: int = 1000) -> DataFrame:
    """The longest run of one side within each window, and whose it is (the earliest of equals)."""
    order = Window.partitionBy("market", "second").orderBy("ts", "idx")
    rows = trades.withColumn("second", window_start(F.col("ts"), width))
    change = F.coalesce(F.col("side") != F.lag("side").over(order), F.lit(True)).cast("int")
    runs = rows.withColumn("run", F.sum(change).over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("market", "second", "run", "side").agg(F.count("*").alias("n"))
    best = runs.groupBy("market", F.col("second").alias("ts")).agg(F.max_by(F.struct("side", "n"), F.struct("n", -F.col("run"))).alias("b"))
    return best.select("market", "ts", F.col("b.side").alias("side"), F.col("b.n").alias("longest"))
