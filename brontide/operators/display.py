"""What charts and monitors show: bins, bounds, grids, peaks, sessions, outliers and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import window_start
from .ordered import by_day, by_million, with_previous, with_running

#: Price steps of a chart, in order of preference.
STEPS = (1, 2, 5, 10, 20, 50, 100, 200, 500)


def price_step(span: Column, most: int = 260) -> Column:
    """The first of STEPS with at most ``most`` bins over ``span``; the last one otherwise."""
    out = F.lit(float(STEPS[-1]))
    for step in reversed(STEPS):
        out = F.when(span / step <= most, float(step)).otherwise(out)
    return out


def price_bounds(rows: DataFrame, step: float, margin: float = 0.1) -> DataFrame:
    """market, lower, upper: the price range widened by ``margin`` of itself and aligned to ``step``."""
    ends = rows.groupBy("market").agg(F.min("price").alias("a"), F.max("price").alias("b"))
    pad = F.greatest((F.col("b") - F.col("a")) * margin, F.lit(float(step)))
    return ends.select("market", (F.floor((F.col("a") - pad) / step) * step).cast("double").alias("lower"), (F.ceil((F.col("b") + pad) / step) * step).cast("double").alias("upper"))


def display_grid(state: DataFrame, step: float, clip: float) -> DataFrame:
    """Quantity per (market, anchor, side, price bin), clipped, with how many levels it has and whether it was clipped."""
    bin_ = (F.floor(F.col("price") / step) * step).cast("double")
    out = state.groupBy("market", "anchor", "side", bin_.alias("bin")).agg(F.sum("qty").alias("total"), F.count("*").alias("levels"))
    return out.select("market", "anchor", "side", "bin", F.least("total", F.lit(float(clip))).alias("qty"), "levels", (F.col("total") > clip).alias("clipped"))


def separated_peaks(cells: DataFrame, by: list[str], step: float, n: int = 4, apart: int = 3) -> DataFrame:
    """The ``n`` largest bins of each group that lie at least ``apart`` bins from each larger one taken; ties to the lower bin.

    Bins of a group are few (a price axis), so they are folded in one array.
    """
    kept = "array<struct<bin:double,qty:double>>"
    order = F.array_sort(F.collect_list(F.struct((-F.col("qty")).alias("k"), F.col("bin").alias("bin"), F.col("qty").alias("qty"))))
    fold = F.aggregate(order, F.array().cast(kept), lambda acc, x: F.when((F.size(acc) < n) & F.forall(acc, lambda y: F.abs(y["bin"] - x["bin"]) >= apart * step), F.concat(acc, F.array(F.struct(x["bin"].alias("bin"), x["qty"].alias("qty"))))).otherwise(acc))
    return cells.groupBy(*by).agg(fold.alias("p")).select(*by, F.posexplode("p").alias("rank", "x")).select(*by, (F.col("rank") + 1).alias("rank"), "x.bin", "x.qty")


def sessions(rows: DataFrame, gap: int) -> DataFrame:
    """market, session, first, last, n: runs of rows with no step over ``gap`` ms."""
    times = rows.groupBy("market", "ts").agg(F.count("*").alias("n"))
    times = with_previous(times, ["market"], ["ts"], {"p": F.col("ts")}, by_day())
    cut = F.coalesce(F.col("ts") - F.col("p") > gap, F.lit(True)).cast("long")
    return with_running(times, ["market"], ["ts"], "session", cut, by_day()).groupBy("market", "session").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.sum("n").alias("n"))


def price_outliers(trades: DataFrame, width: int, length: int = 30, share: float = 0.005) -> DataFrame:
    """market, ts, mean, outlier: whether a window has a trade more than ``share`` off the mean price of the ``length`` windows before it."""
    sums = trades.groupBy("market", window_start(F.col("ts"), width).alias("ts")).agg(F.sum("price").alias("s"), F.count("*").alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi"))
    past = Window.partitionBy("market").orderBy("ts").rangeBetween(-width * length, -width)
    mean = F.sum("s").over(past) / F.sum("n").over(past)
    rows = sums.withColumn("mean", mean).where("mean is not null")
    return rows.select("market", "ts", "mean", (F.greatest(F.abs(F.col("hi") - F.col("mean")), F.abs(F.col("lo") - F.col("mean"))) > share * F.col("mean")).alias("outlier"))


def mid_moves(quotes: DataFrame, width: int) -> DataFrame:
    """market, ts, move_bps: the mid against the last one at least ``width`` earlier, for quotes (market, ts, mid)."""
    past = Window.partitionBy("market").orderBy("ts").rangeBetween(Window.unboundedPreceding, -width)
    before = F.last("mid", ignorenulls=True).over(past)
    return quotes.withColumn("b", before).where("b is not null").select("market", "ts", ((F.col("mid") - F.col("b")) / F.col("b") * 1e4).alias("move_bps"))


def sequence_verdicts(events: DataFrame) -> DataFrame:
    """Each update (market, idx, seq, seq_start, prev_seq) as ok, duplicate, gap or unverifiable against the largest number before it."""
    last = F.col("last")
    verdict = (
        F.when(last.isNull() | F.col("seq").isNull(), "unverifiable").when(F.col("seq") <= last, "duplicate").when(F.col("seq_start").isNotNull(), F.when(F.col("seq_start") <= last + 1, "ok").otherwise("gap"))
        .when(F.col("prev_seq").isNotNull(), F.when(F.col("prev_seq") == last, "ok").otherwise("gap")).when(F.col("seq") == last + 1, "ok").otherwise("gap")
    )
    return with_running(events, ["market"], ["idx"], "last", F.col("seq"), by_million("idx"), "max", strict=True).withColumn("verdict", verdict)


def canonical_book(events: DataFrame) -> DataFrame:
    """Book events (market, type, ts, seq, bids, asks) in one shape: floored time, empty quantities 0, numbers where they mean something, and an errors list."""
    level = "array<struct<price:string,qty:string>>"
    side = lambda c: F.transform(c, lambda l: F.struct(l["price"].alias("price"), F.when(l["qty"] == "", "0").otherwise(l["qty"]).alias("qty"))).cast(level)
    bad = lambda c: F.exists(F.coalesce(F.col(c), F.array().cast(level)), lambda l: ~F.coalesce((l["price"].try_cast("double") > 0) & (F.when(l["qty"] == "", "0").otherwise(l["qty"]).try_cast("double") >= 0), F.lit(False)))
    errors = F.array_compact(F.array(
        F.when(F.coalesce(F.col("market"), F.lit("")) == "", "market"), F.when(~F.coalesce(F.col("type").isin("snapshot", "update"), F.lit(False)), "type"), F.when(F.col("ts").isNull() | (F.col("ts") <= 0), "ts"),
        F.when(F.col("bids").isNull() | bad("bids"), "bids"), F.when(F.col("asks").isNull() | bad("asks"), "asks"),
    ))
    seq = F.when(F.col("market").startswith("kraken"), None).when(F.col("market").startswith("coinbase") & (F.col("type") == "snapshot") & (F.col("seq") == 0), None).otherwise(F.col("seq"))
    return events.select("market", "type", F.floor("ts").cast("long").alias("event_ts_ms"), seq.alias("seq"), side(F.col("bids")).alias("bids"), side(F.col("asks")).alias("asks"), F.lit("BTC").alias("qty_unit"), errors.alias("errors")).withColumn("valid", F.size("errors") == 0)


def lifted_after_snapshot(events: DataFrame) -> DataFrame:
    """Events (market, idx, type, ts) with effective_ts: nothing behind a snapshot in order counts as earlier than it."""
    rows = with_running(events, ["market"], ["idx"], "_snap", F.when(F.col("type") == "snapshot", F.col("ts")), by_million("idx"), "max")
    return rows.withColumn("effective_ts", F.greatest("ts", F.coalesce("_snap", F.col("ts")))).drop("_snap")


def silence(last_seen: DataFrame, limits: dict[str, int], default: int, now: int | None = None) -> DataFrame:
    """market, channel, age, silent for rows (market, channel, ts): silent when older than its channel's limit at ``now`` (by default the latest time of all)."""
    limit = F.lit(default)
    for channel, ms in limits.items():
        limit = F.when(F.col("channel") == channel, ms).otherwise(limit)
    latest = last_seen.groupBy("market", "channel").agg(F.max("ts").alias("ts"))
    clock = latest.agg(F.max("ts").alias("now")) if now is None else latest.sparkSession.range(1).select(F.lit(now).alias("now"))
    age = F.col("now") - F.col("ts")
    return latest.join(F.broadcast(clock)).select("market", "channel", age.alias("age"), (age > limit).alias("silent"))
