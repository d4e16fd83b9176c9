"""Full rollups of feature rows with their quality, and the contracts that rows, windows and files must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import finite, window_start
from .ordered import by_day, with_previous

#: The rollup's fields, how each is made, and of which field of the smallest rows.
FIELDS = {
    "burst_count_mean": ("mean", "burst_count"), "burst_count_max": ("max", "burst_count"), "burst_notional_overlap_sum": ("sum", "total_burst_notional"),
    "burst_notional_overlap_max": ("max", "total_burst_notional"), "burst_notional_overlap_p95": ("p95", "total_burst_notional"), "max_burst_notional_max": ("max", "max_burst_notional"),
    "max_burst_notional_mean": ("mean", "max_burst_notional"), "max_burst_prints_max": ("max", "max_burst_prints"), "max_burst_duration_max": ("max", "max_burst_duration_ms"),
    "trade_count": ("sum", "trade_count"), "buy_trade_count": ("sum", "buy_trade_count"), "sell_trade_count": ("sum", "sell_trade_count"), "traded_qty": ("sum", "traded_qty"),
    "traded_notional": ("sum", "traded_notional"), "buy_qty": ("sum", "buy_qty"), "sell_qty": ("sum", "sell_qty"), "buy_notional": ("sum", "buy_notional"), "sell_notional": ("sum", "sell_notional"),
    "signed_volume": ("sum", "signed_volume"), "signed_notional": ("sum", "signed_notional"), "max_trade_notional": ("max", "max_trade_notional"), "large_trade_count": ("sum", "large_trade_count"),
    "large_trade_notional": ("sum", "large_trade_notional"), "trade_open": ("first", "trade_open"), "trade_high": ("max", "trade_high"), "trade_low": ("min", "trade_low"), "trade_close": ("last", "trade_close"),
    "ofi": ("sum", "ofi"), "bid_add_qty": ("sum", "bid_add_qty"), "bid_cancel_qty": ("sum", "bid_cancel_qty"), "ask_add_qty": ("sum", "ask_add_qty"), "ask_cancel_qty": ("sum", "ask_cancel_qty"),
    "replenishment_qty": ("sum", "replenishment_qty"), "pulling_qty": ("sum", "pulling_qty"),
}
#: Fields made anew from sums: the numerator, the denominator, and what stands for no denominator.
RATIOS = {
    "trade_imbalance_qty": ("signed_volume", "traded_qty", 0.0), "trade_imbalance_notional": ("signed_notional", "traded_notional", 0.0),
    "mean_trade_notional": ("traded_notional", "trade_count", None), "large_trade_notional_share": ("large_trade_notional", "traded_notional", 0.0),
}
#: Fields that may be null in a row that is to be rolled up.
MAY_BE_NULL = ("max_trade_notional", "trade_open", "trade_high", "trade_low", "trade_close", "ofi", "bid_add_qty", "bid_cancel_qty", "ask_add_qty", "ask_cancel_qty", "replenishment_qty", "pulling_qty")
#: Words in an input status that keep a row out of a rollup.
BAD_STATUS = "(?i)missing|quarantine|corrupt|blocked"


def _made(op: str, x: Column) -> Column:
    at = F.when(x.isNotNull(), F.col("ts"))
    return {
        "sum": lambda: F.coalesce(F.sum(x), F.lit(0)), "mean": lambda: F.avg(x), "max": lambda: F.max(x), "min": lambda: F.min(x),
        "first": lambda: F.min_by(x, at), "last": lambda: F.max_by(x, at),
    }[op]()


def window_codes(rows: DataFrame, width: int, into: int, prefix: str = "E_ROLLUP", source_layer: str | None = None, rolled: bool = False) -> DataFrame:
    """market, window, rows, codes: why the rows of each window of ``into`` ms can't be rolled up; no code if they can.

    ``rows`` has market, ts, finalized, input_status and the fields; from an earlier rollup (``rolled``) also source_layer,
    coverage and has_missing_input, which must say that its own input was whole.
    """
    need = into // width
    fields = list(dict.fromkeys(FIELDS if rolled else (source for _, source in FIELDS.values())))
    bad = F.lit(False)
    for f in fields:
        if f in rows.columns:
            x = F.col(f).cast("double")
            bad = bad | (~finite(x) & ~x.isNull() if f in MAY_BE_NULL else ~finite(x))
    status = ~F.coalesce("finalized", F.lit(False)) | F.coalesce(F.col("input_status").rlike(BAD_STATUS), F.lit(False))
    quality = F.lit(False)
    if rolled:
        quality = (F.col("source_layer") != source_layer) | (F.col("coverage") != 1) | F.col("has_missing_input")
    out = rows.groupBy("market", window_start(F.col("ts"), into).alias("window")).agg(
        F.count("*").alias("rows"), F.count_distinct("ts").alias("d"), F.bool_and(F.pmod(F.col("ts"), F.lit(width)) == 0).alias("grid"),
        F.bool_or(status).alias("status"), F.bool_or(bad).alias("bad"), F.bool_or(F.coalesce(quality, F.lit(True))).alias("quality"),
    )
    late = "MISSING_WINDOW" if rolled else "MISSING_SECOND"
    codes = F.array(
        F.when(F.col("rows") != need, "PARTIAL_WINDOW"), F.when(~F.col("grid"), "UNALIGNED"), F.when(F.coalesce(F.col("market"), F.lit("")) == "", "INVALID_MARKET"), F.when(F.col("quality"), "INVALID_QUALITY"),
        F.when(F.col("status"), "INVALID_INPUT_STATUS"), F.when(F.col("bad"), "INVALID_FEATURE"), F.when(F.col("d") < F.col("rows"), "DUPLICATE"), F.when(F.col("d") < need, late),
    )
    return out.select("market", "window", "rows", F.transform(F.array_compact(codes), lambda c: F.concat(F.lit(prefix + "_"), c)).alias("codes"))


def feature_rollup(rows: DataFrame, width: int, into: int, source_layer: str, rolled: bool = False) -> DataFrame:
    """market, ts, all fields and the quality of each whole window of ``into`` ms; windows with a code are left out.

    Means are of means and the percentile of percentiles when ``rows`` are rolled up already. Sums of nothing
    are 0; means, extremes, first and last ignore nulls. One shuffle by (market, window), shared with the check.
    """
    layer = {True: source_layer, False: None}[rolled]
    keys = ["market", "window"]
    p95 = lambda name: F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY `{name}`)")
    made = []
    for name, (op, source) in FIELDS.items():
        column = name if rolled else source
        if column in rows.columns:
            made.append((p95(column) if op == "p95" else _made(op, F.col(column))).alias(name))
    warm = F.bool_or("warmup") if "warmup" in rows.columns else F.lit(False)
    out = rows.groupBy("market", window_start(F.col("ts"), into).alias("window")).agg(*made, F.count("*").alias("source_window_count"), F.max(F.coalesce(F.col("trade_count"), F.lit(0))).alias("_any"), warm.alias("warmup"))
    good = window_codes(rows, width, into, source_layer=layer, rolled=rolled).where(F.size("codes") == 0).select(*keys)
    out = out.join(good, keys)
    for name, (a, b, none) in RATIOS.items():
        out = out.withColumn(name, F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(none).cast("double")))
    empty = F.col("_any") == 0
    return out.withColumns({
        "source_layer": F.lit(source_layer), "finalized": F.lit(True), "coverage": F.lit(1), "has_missing_input": F.lit(False), "has_empty_input": empty,
        "input_status": F.when(empty, "arrived-empty-valid").otherwise("arrived-valid"), "window_end": F.col("window") + into,
    }).drop("_any").withColumnRenamed("window", "ts")


def consumer_reasons(rows: DataFrame, width: int = 300_000, windows: int = 10, layer: str = "features_30s") -> DataFrame:
    """``rows`` with reasons: what a reader of rolled-up rows objects to; valid if it is nothing."""
    said = lambda c, text: F.when(F.coalesce(c, F.lit(True)), text)
    reasons = F.array(
        said(F.pmod(F.col("ts"), F.lit(width)) != 0, "ts is not aligned"), said(F.col("source_layer") != layer, "source_layer"), said(F.col("source_window_count") != windows, "source_window_count"),
        said(F.col("coverage") != 1, "coverage"), said(F.col("has_missing_input"), "has_missing_input"), said(~F.col("finalized"), "finalized"),
        said(~F.col("input_status").isin("arrived-valid", "arrived-empty-valid"), "input_status"), F.when(F.col("has_empty_input").isNull(), "has_empty_input"),
    )
    return rows.withColumn("reasons", F.array_compact(reasons)).withColumn("valid", F.size("reasons") == 0)


def snapshot_block_flags(snapshots: DataFrame, width: int, need: int) -> DataFrame:
    """market, block, flags of each block of snapshots (market, anchor, seeded, crossed): short, unseeded, crossed, repeated."""
    out = snapshots.groupBy("market", window_start(F.col("anchor"), width).alias("block")).agg(F.count("*").alias("n"), F.count_distinct("anchor").alias("d"), F.bool_and("seeded").alias("s"), F.bool_or("crossed").alias("c"))
    flags = F.array(F.when(F.col("d") < need, "short"), F.when(F.col("n") > F.col("d"), "repeated"), F.when(~F.col("s"), "unseeded"), F.when(F.col("c"), "crossed"))
    return out.select("market", "block", F.col("n").alias("rows"), F.array_compact(flags).alias("flags"))


def incomplete_lookups(rows: DataFrame, width: int, length: int = 30) -> DataFrame:
    """market, ts, have: rows before which not all ``length`` windows are there."""
    spread = rows.select("market", "ts").distinct()
    reach = spread.select("market", F.explode(F.sequence(F.col("ts") + width, F.col("ts") + width * length, F.lit(width))).alias("ts")).groupBy("market", "ts").agg(F.count("*").alias("have"))
    return spread.join(reach, ["market", "ts"], "left").select("market", "ts", F.coalesce("have", F.lit(0)).alias("have")).where(F.col("have") < length)


def gap_policy(blocks: DataFrame, width: int, barrier: int) -> DataFrame:
    """market, block_ms, kind, policy for missing blocks between those that are there (market, kind, block_ms).

    A missing block of trades counts as empty; one of book events as missing, and nothing of its market is trusted again before
    the next multiple of ``barrier`` (resumes).
    """
    here = blocks.select("market", "kind", "block_ms").distinct()
    steps = with_previous(here, ["market", "kind"], ["block_ms"], {"before": F.col("block_ms")}, by_day("block_ms")).where(F.col("block_ms") - F.col("before") > width)
    gone = steps.select("market", "kind", F.explode(F.sequence(F.col("before") + width, F.col("block_ms") - width, F.lit(width))).alias("block_ms"))
    policy = F.when(F.col("kind") == "trades", "assumed-empty").otherwise("verified-missing")
    return gone.select("market", "kind", "block_ms", policy.alias("policy"), F.when(F.col("kind") != "trades", F.ceil((F.col("block_ms") + width) / barrier).cast("long") * barrier).alias("resumes"))


def frozen_inventory(files: DataFrame) -> DataFrame:
    """market, kind, block_ms, path, error for an inventory: what has a field missing, an unknown kind, or a key that another row has too."""
    same = F.count("*").over(Window.partitionBy("market", "kind", "block_ms"))
    whole = F.col("market").isNotNull() & F.col("block_ms").isNotNull() & F.col("path").isNotNull()
    error = F.when(~whole, "field").when(~F.coalesce(F.col("kind").isin("trades", "book"), F.lit(False)), "kind").when(same > 1, "duplicate")
    return files.select("market", "kind", "block_ms", "path", error.alias("error"))


def retention(raw: DataFrame, manifest: DataFrame, outputs: DataFrame, footprint: DataFrame, cursors: DataFrame, quarantine: DataFrame, now: int, keep: int) -> DataFrame:
    """market, block_ms, missing for raw blocks older than ``keep`` ms: which proofs a block still lacks; it may go if none.

    The manifest, the outputs and the footprint must have the block, the market's cursor must be past it, and it must not
    be quarantined.
    """
    keys = ["market", "block_ms"]
    out = raw.where(F.col("block_ms") < now - keep).select(*keys)
    for name, table in (("manifest", manifest), ("outputs", outputs), ("footprint", footprint), ("quarantine", quarantine)):
        out = out.join(table.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left")
    out = out.join(cursors.groupBy("market").agg(F.min("cursor").alias("cursor")), "market", "left")
    lacks = F.array(
        *(F.when(F.col(c).isNull(), c) for c in ("manifest", "outputs", "footprint")), F.when(~F.coalesce(F.col("cursor") > F.col("block_ms"), F.lit(False)), "cursor"), F.when(F.col("quarantine"), "quarantine")
    )
    return out.select(*keys, F.array_compact(lacks).alias("missing"))
