"""Quality-checked rollups of dense one-window rows into larger windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import window_start

#: How each field is rolled up. Fields keep their names, so one table serves every level.
OPERATORS = {
    "trades": "sum", "buys": "sum", "sells": "sum", "qty": "sum", "notional": "sum", "buy_qty": "sum", "sell_qty": "sum", "buy_notional": "sum", "sell_notional": "sum",
    "signed_volume": "sum", "signed_notional": "sum", "large_trades": "sum", "large_notional": "sum", "max_notional": "max",
    "open": "first", "high": "max", "low": "min", "close": "last",
    "burst_count": "mean", "burst_total": "p95", "burst_largest": "max", "burst_prints": "max", "burst_duration": "max",
    "ofi": "sum", "bid_add": "sum", "bid_cancel": "sum", "ask_add": "sum", "ask_cancel": "sum", "replenished": "sum", "pulled": "sum",
}


def _rolled(name: str, how: str):
    x = F.col(name)
    return {
        "sum": lambda: F.coalesce(F.sum(x), F.lit(0)), "mean": lambda: F.avg(x), "max": lambda: F.max(x), "min": lambda: F.min(x),
        "first": lambda: F.min_by(x, F.when(x.isNotNull(), F.col("ts"))), "last": lambda: F.max_by(x, F.when(x.isNotNull(), F.col("ts"))),
        "p95": lambda: F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {name})"),
    }[how]().alias(name)


def roll_up(rows: DataFrame, width: int, into: int) -> DataFrame:
    """Windows of ``into`` ms from rows of ``width`` ms; only windows with every row, each once, are kept.

    ``rows`` has market, ts, optional finalized, and any fields of OPERATORS. Sums of nothing are 0; means,
    extremes, first and last ignore nulls. Ratios are computed anew from the sums.
    """
    fields = [c for c in OPERATORS if c in rows.columns]
    need = into // width
    final = F.bool_and("finalized") if "finalized" in rows.columns else F.lit(True)
    on_grid = F.bool_and(F.pmod(F.col("ts"), F.lit(width)) == 0)
    out = rows.groupBy("market", window_start(F.col("ts"), into).alias("window")).agg(
        F.count("*").alias("_n"), F.count_distinct("ts").alias("_d"), on_grid.alias("_g"), final.alias("finalized"), F.count_if(F.coalesce(F.col("trades"), F.lit(0)) > 0).alias("filled"), *(_rolled(c, OPERATORS[c]) for c in fields)
    )
    out = out.where((F.col("_n") == need) & (F.col("_d") == need) & F.col("_g") & F.col("finalized")).drop("_n", "_d", "_g")
    share = lambda a, b: F.when(F.col(b) > 0, a / F.col(b)).otherwise(0.0)
    return out.withColumns({
        "imbalance_qty": share(F.col("signed_volume"), "qty"), "imbalance_notional": share(F.col("signed_notional"), "notional"), "large_share": share(F.col("large_notional"), "notional"),
        "mean_notional": F.when(F.col("trades") > 0, F.col("notional") / F.col("trades")),
    }).withColumn("coverage", F.col("filled") / need)


def rejected(rows: DataFrame, width: int, into: int) -> DataFrame:
    """market, window, reasons: windows that roll_up leaves out, and why."""
    need = into // width
    counts = rows.groupBy("market", window_start(F.col("ts"), into).alias("window")).agg(F.count("*").alias("n"), F.count_distinct("ts").alias("d"), F.bool_and(F.pmod(F.col("ts"), F.lit(width)) == 0).alias("g"))
    why = F.array_compact(F.array(F.when(F.col("d") < need, "missing"), F.when(F.col("n") > F.col("d"), "duplicate"), F.when(~F.col("g"), "misaligned")))
    return counts.select("market", "window", why.alias("reasons")).where(F.size("reasons") > 0)
