"""Order-book state and features from level changes, in relational form.

A level's versions are validity intervals [ts, next ts); the state at an anchor is the set of versions
that began before it and had not ended. Anchors never see events of their own time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import window_start

_LEVEL = ("market", "side", "price")


def level_versions(changes: DataFrame) -> DataFrame:
    """The last change of each level at each time, with the time of the next (null: still valid) and the quantity before."""
    last = changes.groupBy(*_LEVEL, "ts").agg(F.max_by("qty", "ord").alias("qty"))
    w = Window.partitionBy(*_LEVEL).orderBy("ts")
    return last.withColumns({"until": F.lead("ts").over(w), "before": F.coalesce(F.lag("qty").over(w), F.lit(0.0))})


def state_at(changes: DataFrame, anchors: DataFrame, width: int) -> DataFrame:
    """market, anchor, side, price, qty: the levels before each anchor, anchors being multiples of ``width``.

    ``anchors`` has market, first, last. Each version is dealt to the anchors it is valid at.
    """
    v = level_versions(changes).where("qty > 0").join(F.broadcast(anchors), "market")
    start = F.greatest(window_start(F.col("ts"), width) + width, F.col("first"))
    # valid at anchors a with ts < a <= until
    end = F.when(F.col("until").isNotNull(), F.least(window_start(F.col("until"), width), F.col("last"))).otherwise(F.col("last"))
    return v.where(start <= end).select("market", "side", "price", "qty", F.explode(F.sequence(start, end, F.lit(width))).alias("anchor"))


def anchor_range(changes: DataFrame, width: int) -> DataFrame:
    """market, first, last anchor: one row per market."""
    return changes.groupBy("market").agg((window_start(F.min("ts"), width) + width).alias("first"), (window_start(F.max("ts"), width) + width).alias("last"))


def with_mid(state: DataFrame) -> DataFrame:
    """``state`` with best_bid, best_ask and mid, where both sides are there.

    One shuffle by (market, anchor), whose book is small; what is grouped by these two afterwards needs no other.
    """
    book = Window.partitionBy("market", "anchor")
    price = lambda s: F.when(F.col("side") == s, F.col("price"))
    rows = state.withColumns({"best_bid": F.max(price("bid")).over(book), "best_ask": F.min(price("ask")).over(book)})
    return rows.where("best_bid is not null and best_ask is not null").withColumn("mid", (F.col("best_bid") + F.col("best_ask")) / 2)


def features(state: DataFrame, near: float = 100.0, far: float = 1000.0) -> DataFrame:
    """Best prices, mid, spread, microprice, depth near the mid and imbalance for each (market, anchor) with both sides."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    value, off = F.col("price") * F.col("qty"), F.abs(F.col("price") - F.col("mid"))
    depth = lambda s, d: F.sum(F.when(s & (off <= d), value).otherwise(0.0))
    rows = with_mid(state).groupBy("market", "anchor").agg(
        F.first("best_bid").alias("best_bid"), F.max_by(F.when(bid, F.col("qty")), F.when(bid, F.col("price"))).alias("bid_qty"),
        F.first("best_ask").alias("best_ask"), F.min_by(F.when(ask, F.col("qty")), F.when(ask, F.col("price"))).alias("ask_qty"), F.first("mid").alias("mid"),
        depth(bid, near).alias("bid_near"), depth(ask, near).alias("ask_near"), depth(bid, far).alias("bid_far"), depth(ask, far).alias("ask_far"),
    )
    ratio = lambda a, b: F.when(F.col(a) + F.col(b) > 0, (F.col(a) - F.col(b)) / (F.col(a) + F.col(b)))
    total = F.col("bid_qty") + F.col("ask_qty")
    return rows.withColumns({
        "spread_bps": F.when(F.col("mid") > 0, (F.col("best_ask") - F.col("best_bid")) / F.col("mid") * 1e4),
        "microprice": F.when(total > 0, (F.col("best_ask") * F.col("bid_qty") + F.col("best_bid") * F.col("ask_qty")) / total),
        "imbalance_near": ratio("bid_near", "ask_near"), "imbalance_far": ratio("bid_far", "ask_far"),
        "top_depth": F.col("best_bid") * F.col("bid_qty") + F.col("best_ask") * F.col("ask_qty"),
    })


def snapshots(state: DataFrame) -> DataFrame:
    """market, anchor, seeded, crossed and the levels as parallel lists, bids descending and asks ascending."""
    level = F.struct("price", "qty")
    rows = state.groupBy("market", "anchor").agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == "bid", level)), asc=False).alias("b"), F.sort_array(F.collect_list(F.when(F.col("side") == "ask", level))).alias("a")
    )
    seeded = (F.size("b") > 0) & (F.size("a") > 0)
    return rows.select(
        "market", "anchor", seeded.alias("seeded"), F.coalesce(seeded & (F.get(F.col("b"), F.lit(0))["price"] >= F.get(F.col("a"), F.lit(0))["price"]), F.lit(False)).alias("crossed"),
        F.col("b.price").alias("bid_prices"), F.col("b.qty").alias("bid_qtys"), F.col("a.price").alias("ask_prices"), F.col("a.qty").alias("ask_qtys"),
    )


def top_levels(state: DataFrame, n: int) -> DataFrame:
    """The ``n`` best levels of each side; every (market, anchor, side) is small, so ranks need no extra shuffle."""
    toward = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    rank = F.row_number().over(Window.partitionBy("market", "anchor", "side").orderBy(toward))
    return state.withColumn("level", rank).where(F.col("level") <= n)


def binned(state: DataFrame, step: float, limit: float) -> DataFrame:
    """Quantities by price bin of ``step``, within ``limit`` of the mid before and after flooring."""
    bin_ = (F.floor(F.col("price") / step) * step).cast("double")
    near = (F.abs(F.col("price") - F.col("mid")) <= limit) & (F.abs(F.col("bin") - F.col("mid")) <= limit)
    rows = with_mid(state).withColumn("bin", bin_).where(near)
    return rows.groupBy("market", "anchor", "side", "bin").agg(F.round(F.sum("qty"), 8).alias("qty"))


def heatmap_rows(state: DataFrame, limit: float = 10_000.0) -> DataFrame:
    """One row per (market, anchor) with both sides: $1 buckets and quantities as parallel lists, ascending."""
    level = F.struct("bin", "qty")
    side = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, level)))
    rows = binned(state, 1.0, limit).groupBy("market", "anchor").agg(side("bid").alias("b"), side("ask").alias("a"))
    return rows.select("market", "anchor", F.col("b.bin").alias("bid_prices"), F.col("b.qty").alias("bid_qtys"), F.col("a.bin").alias("ask_prices"), F.col("a.qty").alias("ask_qtys"))


def pressure(state: DataFrame) -> DataFrame:
    """Each side's share of all quantity, in percent."""
    q = lambda s: F.sum(F.when(F.col("side") == s, F.col("qty")).otherwise(0.0))
    rows = state.groupBy("market", "anchor").agg(q("bid").alias("bid"), q("ask").alias("ask"))
    total = F.col("bid") + F.col("ask")
    return rows.where(total > 0).select("market", "anchor", (F.col("bid") / total * 100).alias("bid_pct"), (F.col("ask") / total * 100).alias("ask_pct"))


def level_flow(changes: DataFrame, width: int) -> DataFrame:
    """Quantity added and cancelled per side and window: positive and negative changes of each level, in event order."""
    w = Window.partitionBy(*_LEVEL).orderBy("ord")
    delta = F.col("qty") - F.coalesce(F.lag("qty").over(w), F.lit(0.0))
    rows = changes.withColumn("delta", delta).withColumn("window", window_start(F.col("ts"), width))
    return rows.groupBy("market", "window", "side").agg(F.sum(F.greatest("delta", F.lit(0.0))).alias("added"), F.sum(F.greatest(-F.col("delta"), F.lit(0.0))).alias("cancelled"))


def best_flow(state: DataFrame) -> DataFrame:
    """Order-flow imbalance, replenishment and pulling between consecutive anchors, from the series of best quotes."""
    w = Window.partitionBy("market").orderBy("anchor")
    f = features(state).select("market", "anchor", "best_bid", "bid_qty", "best_ask", "ask_qty", "spread_bps", "top_depth")
    prev = {c: F.lag(c).over(w) for c in f.columns[2:]}
    f = f.withColumns({f"p_{c}": x for c, x in prev.items()}).where("p_best_bid is not null")
    db, da = F.col("bid_qty") - F.col("p_bid_qty"), F.col("ask_qty") - F.col("p_ask_qty")
    ofi = F.when(F.col("best_bid") >= F.col("p_best_bid"), db).otherwise(0.0) - F.when(F.col("best_ask") <= F.col("p_best_ask"), da).otherwise(0.0)
    zero = F.lit(0.0)
    return f.select("market", "anchor", ofi.alias("ofi"), (F.greatest(db, zero) + F.greatest(da, zero)).alias("replenished"), (F.greatest(-db, zero) + F.greatest(-da, zero)).alias("pulled"),
                    (F.col("spread_bps") - F.col("p_spread_bps")).alias("spread_delta"), (F.col("top_depth") - F.col("p_top_depth")).alias("depth_delta"))


def trade_interaction(trades: DataFrame, quotes: DataFrame, width: int) -> DataFrame:
    """Trades against the quote before them, per market and window; windows with a trade that has no quote are null.

    ``quotes`` has market, ts, best_bid, bid_qty, best_ask, ask_qty. Strict as-of: a quote of the trade's
    own millisecond isn't seen.
    """
    from .asof import as_of

    fields = ["best_bid", "bid_qty", "best_ask", "ask_qty"]
    joined = as_of(trades, quotes.withColumn("_n", F.lit(0)), ["market"], fields, "_n", strict=True)
    buy, price, qty = F.col("side") == "buy", F.col("price"), F.col("qty")
    touch = F.when(buy, F.col("best_ask")).otherwise(F.col("best_bid"))
    through = F.when(buy, price > touch).otherwise(price < touch)
    mid = (F.col("best_bid") + F.col("best_ask")) / 2
    slip = F.when(mid > 0, F.when(buy, price - touch).otherwise(touch - price) / mid * 1e4)
    top = F.when(buy, F.col("ask_qty")).otherwise(F.col("bid_qty"))
    out = joined.groupBy("market", window_start(F.col("ts"), width).alias("window")).agg(
        F.count("*").alias("trades"), F.bool_and(F.col("sample_ts").isNotNull()).alias("seen"), F.sum(F.when(price == touch, qty).otherwise(0.0)).alias("at_touch"),
        F.sum(F.when(through, qty).otherwise(0.0)).alias("through"), F.avg(slip).alias("slippage_bps"), F.sum(F.when(top > 0, qty / top).otherwise(0.0)).alias("over_top"),
    )
    return out.select("market", "window", "trades", *(F.when(F.col("seen"), F.col(c)).alias(c) for c in ("at_touch", "through", "slippage_bps", "over_top")))
