"""More of the order book: what a trade sweeps, depth near the best price, board ratios and flow per update."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import window_start
from .book import level_versions, state_at
from .ordered import DAY, by_day


def swept(trades: DataFrame, changes: DataFrame, grain: int = DAY) -> DataFrame:
    """market, idx, levels, notional: the levels of the other side that each trade (market, ts, idx, side, price) reaches, in the book before it.

    A level's versions are intervals; both are dealt to cells of time, so this is an equi-join with the interval's ends as a filter.
    """
    v = level_versions(changes).where("qty > 0").select("market", F.col("side").alias("book_side"), F.col("price").alias("level"), "qty", F.col("ts").alias("since"), "until")
    last = trades.groupBy("market").agg(F.max("ts").alias("end"))
    v = v.join(F.broadcast(last), "market").where("since < end").withColumn("to", F.least(F.coalesce("until", F.col("end")), F.col("end")))
    v = v.withColumn("cell", F.explode(F.sequence(F.floor(F.col("since") / grain), F.floor(F.col("to") / grain))))
    t = trades.select("market", "idx", "ts", "side", "price", F.floor(F.col("ts") / grain).alias("cell"))
    buy = F.col("side") == "buy"
    hit = t.join(v, ["market", "cell"]).where((F.col("since") < F.col("ts")) & (F.col("until").isNull() | (F.col("ts") <= F.col("until"))) & (F.col("book_side") == F.when(buy, "ask").otherwise("bid")))
    hit = hit.where(F.when(buy, F.col("level") <= F.col("price")).otherwise(F.col("level") >= F.col("price")))
    sums = hit.groupBy("market", "idx").agg(F.count("*").alias("levels"), F.sum(F.col("level") * F.col("qty")).alias("notional"))
    return trades.select("market", "idx").join(sums, ["market", "idx"], "left").na.fill(0, ["levels", "notional"])


def depth_within(state: DataFrame, share: float) -> DataFrame:
    """market, anchor, bid_depth, ask_depth, imbalance of levels within ``share`` of the best price of their side."""
    book = Window.partitionBy("market", "anchor", "side")
    best = F.when(F.col("side") == "bid", F.max("price").over(book)).otherwise(F.min("price").over(book))
    near = state.withColumn("best", best).where(F.abs(F.col("price") - F.col("best")) <= F.col("best") * share)
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col("qty")).otherwise(0.0))
    out = near.groupBy("market", "anchor").agg(side("bid").alias("bid_depth"), side("ask").alias("ask_depth"))
    total = F.col("bid_depth") + F.col("ask_depth")
    return out.withColumn("imbalance", F.when(total > 0, (F.col("bid_depth") - F.col("ask_depth")) / total))


def board(rows: DataFrame) -> DataFrame:
    """``rows`` (total, trailing, best_bid, bid_qty, best_ask, ask_qty) with the burst notional against the top of the book; null without a whole book."""
    top = F.col("best_bid") * F.col("bid_qty") + F.col("best_ask") * F.col("ask_qty")
    seen = F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull()
    ratio = F.when(seen & (top > 0), F.col("total") / top)
    return rows.withColumns({
        "top_depth": F.when(seen, top), "board_top_depth_ratio": ratio, "board_vs_depth": ratio, "board_vs_30s": F.when(seen & (F.col("trailing") > 0), F.col("total") / F.col("trailing")),
        "board_mid_move_bps": F.lit(None).cast("double"), "burst_notional_vs_top_depth": F.when(F.col("total") > 0, ratio),
    })


FLOW = ("ofi", "replenished", "pulled", "added", "cancelled")


def update_flow(changes: DataFrame, width: int) -> DataFrame:
    """market, window, ofi, replenished, pulled, added, cancelled: sums over single updates of the book, by window.

    Best quotes after each update need the whole book, so days are replayed, each from the state at its start:
    a stream in order with one book as state. Windows are of a day or a part of one.
    """
    ends = changes.groupBy("market").agg(F.min(window_start(F.col("ts"), DAY)).alias("first"), F.max(window_start(F.col("ts"), DAY)).alias("last"))
    # the state before a day's first moment; a day without changes needs none
    seeds = state_at(changes, ends.select("market", (F.col("first") + DAY).alias("first"), "last"), DAY)
    days = changes.select("market", by_day().alias("day")).distinct()
    seeds = seeds.select("market", (F.col("anchor") / DAY).cast("long").alias("day"), "side", "price", "qty").join(days, ["market", "day"], "left_semi")
    null = F.lit(None).cast(changes.schema["ord"].dataType)
    rows = seeds.select("market", "day", F.lit(0).alias("kind"), null.alias("ord"), F.lit(0).cast("long").alias("ts"), "side", "price", "qty").unionByName(
        changes.select("market", by_day().alias("day"), F.lit(1).alias("kind"), "ord", "ts", "side", "price", "qty")
    )
    rows = rows.repartition("market", "day").sortWithinPartitions("market", "day", "kind", "ord").drop("ord")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, books, sums = None, {}, {}

        def best(side: str) -> tuple[float | None, float]:
            book = books[side]
            p = (max(book) if side == "bid" else min(book)) if book else None
            return p, book.get(p, 0.0)

        def out() -> pa.RecordBatch:
            done = sorted(sums)
            columns = [pa.array([m for m, _ in done], pa.string()), pa.array([w for _, w in done], pa.int64()), *(pa.array([sums[k][i] for k in done], pa.float64()) for i in range(len(FLOW)))]
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, ["market", "window", *FLOW])

        for batch in batches:
            for m, day, kind, ts, side, price, qty in zip(*(batch.column(c).to_pylist() for c in ("market", "day", "kind", "ts", "side", "price", "qty")), strict=True):
                if at != (m, day):
                    at, books = (m, day), {"bid": {}, "ask": {}}
                    if len(sums) > 10_000:
                        yield out()
                if kind == 0:
                    books[side][price] = qty
                    continue
                (bid, bid_qty), (ask, ask_qty) = best("bid"), best("ask")
                change = qty - books[side].get(price, 0.0)
                if qty > 0:
                    books[side][price] = qty
                else:
                    books[side].pop(price, None)
                (new_bid, new_bid_qty), (new_ask, new_ask_qty) = best("bid"), best("ask")
                s = sums.setdefault((m, ts - ts % width), [0.0] * len(FLOW))
                if new_bid is not None and bid is not None and new_bid >= bid:
                    s[0] += new_bid_qty - bid_qty
                if new_ask is not None and ask is not None and new_ask <= ask:
                    s[0] -= new_ask_qty - ask_qty
                s[1] += max(0.0, new_bid_qty - bid_qty) + max(0.0, new_ask_qty - ask_qty)
                s[2] += max(0.0, bid_qty - new_bid_qty) + max(0.0, ask_qty - new_ask_qty)
                s[3] += max(0.0, change)
                s[4] += max(0.0, -change)
        yield out()

    schema = "market string, window long, " + ", ".join(f"{c} double" for c in FLOW)
    return rows.mapInArrow(told, schema).groupBy("market", "window").agg(*(F.sum(c).alias(c) for c in FLOW))
