"""Trade bars and trade-flow features per market and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import signed, size_class, window_start
from .ordered import by_day, with_previous, with_running

_EPS = 1e-12
#: Windows of a grid that one row makes.
RUN = 10_000


def _with_flow(trades: DataFrame, width: int) -> DataFrame:
    return trades.withColumns({"notional": F.col("price") * F.col("qty"), "second": window_start(F.col("ts"), width), "key": F.struct("ts", "idx")})


def _if(condition: Column, x: Column) -> Column:
    return F.sum(F.when(condition, x).otherwise(F.lit(0.0)))


def bars(trades: DataFrame, width: int = 1000) -> DataFrame:
    """One row per market and window: OHLC, vwap, counts and quantities by side and size class, first and last trade.

    One shuffle on (market, window) with partial aggregation; first and last are minima and maxima of
    the (ts, idx) key, so no sort is needed.
    """
    rows = _with_flow(trades, width).withColumns({"size": size_class(F.col("notional")), "buy": F.col("side") == "buy"})
    buy, qty, n = F.col("buy"), F.col("qty"), F.col("notional")
    sized = [
        f(side, size).alias(f"{name}_{size}_{what}")
        for name, side in (("buy", buy), ("sell", ~buy))
        for size in ("small", "medium", "large")
        for what, f in (("count", lambda s, z: F.count_if(s & (F.col("size") == z))), ("qty", lambda s, z: _if(s & (F.col("size") == z), qty)))
    ]
    out = rows.groupBy("market", F.col("second").alias("ts")).agg(
        F.min_by("price", "key").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "key").alias("close"),
        F.count("*").alias("trades"), F.count_if(buy).alias("buys"), F.count_if(~buy).alias("sells"),
        _if(buy, qty).alias("buy_qty"), _if(~buy, qty).alias("sell_qty"), _if(buy, n).alias("buy_notional"), _if(~buy, n).alias("sell_notional"),
        *sized, F.min_by("idx", "key").alias("first_id"), F.max_by("idx", "key").alias("last_id"),
    )
    total, notional = F.col("buy_qty") + F.col("sell_qty"), F.col("buy_notional") + F.col("sell_notional")
    return out.withColumns({
        "vwap": F.when(total > 0, notional / total).otherwise(0.0), "delta_qty": F.col("buy_qty") - F.col("sell_qty"),
        "delta_notional": F.col("buy_notional") - F.col("sell_notional"), "imbalance": F.when(total > 0, (F.col("buy_qty") - F.col("sell_qty")) / total).otherwise(0.0),
        "mean_qty": total / F.col("trades"), "mean_notional": notional / F.col("trades"),
    })


def upserted(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """For each key the row of the highest version, as an insert-or-replace leaves it; by a maximum, without a sort."""
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("r"))
    return newest.select(*keys, "r.*")


def trade_flow(trades: DataFrame, width: int = 1000, large: float = 100_000.0) -> DataFrame:
    """The trade-flow features of each window that has trades.

    Interarrival times and side flips look at the trade before, over the market's whole history, day by
    day. Percentiles are nearest-rank.
    """
    rows = with_previous(_with_flow(trades, width), ["market"], ["ts", "idx"], {"p_ts": F.col("ts"), "p_side": F.col("side")}, by_day())
    rows = rows.withColumns({"gap": F.greatest(F.col("ts") - F.col("p_ts"), F.lit(0)), "flip": F.col("side") != F.col("p_side")})
    rank = lambda x, p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {x})")
    buy, qty, value = F.col("side") == "buy", F.col("qty"), F.col("notional")
    out = rows.groupBy("market", F.col("second").alias("ts")).agg(
        F.min_by("price", "key").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "key").alias("close"),
        F.count("*").alias("trades"), F.count_if(buy).alias("buys"), F.count_if(~buy).alias("sells"), F.sum(qty).alias("qty"), F.sum(value).alias("notional"),
        _if(buy, qty).alias("buy_qty"), _if(~buy, qty).alias("sell_qty"), _if(buy, value).alias("buy_notional"), _if(~buy, value).alias("sell_notional"),
        rank("notional", 0.5).alias("median_notional"), F.max(value).alias("max_notional"), F.count_if(value >= large).alias("large_trades"), _if(value >= large, value).alias("large_notional"),
        F.avg("gap").alias("mean_gap"), rank("gap", 0.5).cast("long").alias("median_gap"), rank("gap", 0.95).cast("long").alias("p95_gap"), F.count_if("flip").alias("flips"),
    )
    share = lambda a, b: F.when(F.col(b) > _EPS, a / F.col(b)).otherwise(0.0)
    volume, value = F.col("buy_qty") - F.col("sell_qty"), F.col("buy_notional") - F.col("sell_notional")
    return out.withColumns({
        "signed_volume": volume, "signed_notional": value, "imbalance_qty": share(volume, "qty"), "imbalance_notional": share(value, "notional"),
        "mean_notional": F.col("notional") / F.col("trades"), "large_share": share(F.col("large_notional"), "notional"),
    })


def realized_volatility(trades: DataFrame, width: int = 1000, length: int = 10) -> DataFrame:
    """market, ts, volatility: population deviation of log returns between trades of the ``length`` windows before each window.

    A return belongs to a window if both its trades lie in the frame; it is dealt to those windows by
    its own times, so no frame is ever collected. Windows with fewer than two returns are absent.
    """
    rows = with_previous(trades, ["market"], ["ts", "idx"], {"prior": F.col("ts"), "p_price": F.col("price")}, by_day())
    rows = rows.select("market", "ts", "prior", F.log(F.col("price") / F.col("p_price")).alias("r"))
    first, last = window_start(F.col("ts"), width) + width, window_start(F.col("prior"), width) + width * length
    spread = rows.where("r is not null").where(first <= last).select("market", "r", F.explode(F.sequence(first, last, F.lit(width))).alias("second"))
    return spread.groupBy("market", F.col("second").alias("ts")).agg(F.count("*").alias("returns"), F.stddev_pop("r").alias("volatility")).where("returns >= 2")


def dense_grid(rows: DataFrame, width: int) -> DataFrame:
    """market, ts: every window from the first to the last of each market.

    Runs of windows are made first and dealt to tasks, so no market's grid is one array or one task.
    """
    ends = rows.groupBy("market").agg(F.min(window_start(F.col("ts"), width)).alias("a"), F.max(window_start(F.col("ts"), width)).alias("b"))
    runs = ends.select("market", "b", F.explode(F.sequence("a", "b", F.lit(width * RUN))).alias("c")).repartition("market", "c")
    return runs.select("market", F.explode(F.sequence("c", F.least(F.col("c") + width * (RUN - 1), F.col("b")), F.lit(width))).alias("ts"))


def dense_volume(trades: DataFrame, width: int) -> DataFrame:
    """Trades and notional of every window of the grid; windows without trades count 0 and have null prices."""
    sums = trades.groupBy("market", window_start(F.col("ts"), width).alias("ts")).agg(F.count("*").alias("trades"), F.sum(F.col("price") * F.col("qty")).alias("notional"), F.max("price").alias("high"))
    out = dense_grid(trades, width).join(sums, ["market", "ts"], "left")
    return out.select("market", "ts", F.coalesce("trades", F.lit(0)).alias("trades"), F.coalesce("notional", F.lit(0.0)).alias("notional"), "high")


def missing_windows(trades: DataFrame, width: int) -> DataFrame:
    """market, ts of grid windows without a trade."""
    return dense_grid(trades, width).join(trades.select("market", window_start(F.col("ts"), width).alias("ts")).distinct(), ["market", "ts"], "left_anti")


def trailing_notional(trades: DataFrame, width: int, length: int = 30) -> DataFrame:
    """For each grid window the notional of the ``length`` windows before it.

    Sums per window first; the frame then runs over one row per window, however many trades there are, in
    chunks of windows that also hold the ``length`` windows before them.
    """
    size = width * RUN
    rows = dense_volume(trades, width).select("market", "ts", "notional")
    chunk = F.floor(F.col("ts") / size)
    reach = F.floor((F.col("ts") + width * length) / size)  # the last windows of a chunk stand in the next too
    rows = rows.withColumn("own", chunk).withColumn("c", F.explode(F.when(reach > chunk, F.sequence(chunk, reach)).otherwise(F.array(chunk))))
    frame = Window.partitionBy("market", "c").orderBy("ts").rowsBetween(-length, -1)
    rows = rows.withColumn("trailing", F.coalesce(F.sum("notional").over(frame), F.lit(0.0))).where("own = c")
    return rows.select("market", "ts", "notional", "trailing")


def candles(bars_: DataFrame, width: int) -> DataFrame:
    """OHLC and volumes of larger windows from bars (market, ts, open, high, low, close, buy_qty, sell_qty)."""
    return bars_.groupBy("market", window_start(F.col("ts"), width).alias("candle")).agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
        F.sum("buy_qty").alias("buy_qty"), F.sum("sell_qty").alias("sell_qty"), F.count("*").alias("n"),
    )


def cumulative_delta(bars_: DataFrame, width: int) -> DataFrame:
    """Running signed volume per market over windows of ``width``."""
    sums = bars_.groupBy("market", window_start(F.col("ts"), width).alias("bucket")).agg(F.sum(F.col("buy_qty") - F.col("sell_qty")).alias("delta"))
    chunk = F.floor(F.col("bucket") / (width * RUN))
    rows = with_running(sums, ["market"], ["bucket"], "total", F.col("delta"), chunk)
    rows = with_previous(rows, ["market"], ["bucket"], {"p": F.col("bucket")}, chunk)
    gap = F.coalesce(F.col("bucket") - F.col("p") > width, F.lit(False))
    return rows.select("market", "bucket", "delta", F.when(gap, None).otherwise(F.col("total")).alias("cvd"))


def footprint(trades: DataFrame, width: int = 300_000, step: float = 1.0) -> DataFrame:
    """Traded quantity, notional and count by side in cells of window x price step."""
    cell = (F.floor(F.col("price") / step) * step).cast("double")
    buy, qty, value = F.col("side") == "buy", F.col("qty"), F.col("price") * F.col("qty")
    return trades.groupBy("market", window_start(F.col("ts"), width).alias("window"), cell.alias("cell")).agg(
        _if(buy, qty).alias("buy_qty"), _if(~buy, qty).alias("sell_qty"), F.sum(value).alias("notional"), F.count("*").alias("n"), F.sum(signed(F.col("side"), qty)).alias("delta"),
    )


def size_counts(trades: DataFrame) -> DataFrame:
    """Trades and notional by market, side and size class."""
    value = F.col("price") * F.col("qty")
    return trades.groupBy("market", "side", size_class(value).alias("size")).agg(F.count("*").alias("n"), F.sum(value).alias("notional"), F.sum(signed(F.col("side"), value)).alias("signed_notional"))


def last_premium(trades: DataFrame, width: int, left: str, right: str) -> DataFrame:
    """Difference of two markets' last prices per window, and in basis points of the right one."""
    last = trades.where(F.col("market").isin(left, right)).groupBy(window_start(F.col("ts"), width).alias("window")).pivot("market", [left, right]).agg(F.max_by("price", F.struct("ts", "idx")))
    a, b = F.col(left), F.col(right)
    return last.where(a.isNotNull() & b.isNotNull()).select("window", a.alias("left_price"), b.alias("right_price"), (a - b).alias("premium"), F.round((a - b) / b * 10_000, 2).alias("premium_bps"))
