"""Small operators around the feed: orders, status, digests, counts, joins by block and time, late rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import non_negative, signed, valid_trade, window_start
from . import bursts
from .ordered import by_day, by_million, with_last, with_previous, with_running


def non_burst_delta(trades: DataFrame, width: int, gap: int, cap: int) -> DataFrame:
    """market, ts, delta, burst_delta, non_burst_delta: signed notional of a window, of the bursts of two prints or more that start in it, and the difference."""
    value = F.col("price") * F.col("qty")
    flow = trades.groupBy("market", window_start(F.col("ts"), width).alias("ts")).agg(F.sum(signed(F.col("side"), value)).alias("delta"))
    b = bursts.bursts(trades, gap, cap).where("prints >= 2").groupBy("market", window_start(F.col("start"), width).alias("ts")).agg(F.sum(signed(F.col("side"), F.col("notional"))).alias("burst_delta"))
    out = flow.join(b, ["market", "ts"], "left").na.fill(0, ["burst_delta"])
    return out.withColumn("non_burst_delta", F.col("delta") - F.col("burst_delta"))


def coverage(rows: DataFrame, by: list[str], member: str, required: list[str]) -> DataFrame:
    """``by``, have (sorted different members), covered: whether all that are required are there."""
    have = F.array_sort(F.collect_set(member))
    return rows.groupBy(*by).agg(have.alias("have")).withColumn("covered", F.size(F.array_except(F.array(*map(F.lit, required)), "have")) == 0)


def covered_times(rows: DataFrame, required: DataFrame) -> DataFrame:
    """ts, markets: times at which every market of ``required`` has a row. Markets are few, and are sent to all tasks as one row."""
    need = required.agg(F.count_distinct("market").alias("need"))
    out = rows.join(F.broadcast(required.distinct()), "market").groupBy("ts").agg(F.array_sort(F.collect_set("market")).alias("markets"))
    return out.join(F.broadcast(need)).where(F.size("markets") == F.col("need")).select("ts", "markets")


def book_order(path: str = "path", line: str = "line") -> list[Column]:
    """The order of book events: time, snapshots first, first sequence number (without one last), file and line."""
    return [F.col("ts"), F.when(F.col("type") == "snapshot", 0).otherwise(1), F.coalesce("seq_start", "seq").asc_nulls_last(), F.col(path), F.col(line)]


def placed(events: DataFrame, by: list[str]) -> DataFrame:
    """``events`` with their place in book order within ``by``."""
    return events.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*book_order())))


def batch_order() -> list[Column]:
    """The order of rows in a batch: event time (without one last), arrival, position."""
    return [F.col("event_ts").asc_nulls_last(), F.col("ingest_seq"), F.col("position")]


def top_by_side(bars: DataFrame, n: int) -> DataFrame:
    """side, market, ts, notional, rank: the ``n`` windows with the most notional bought, and the most sold."""
    out = None
    for side in ("buy", "sell"):
        best = bars.select(F.lit(side).alias("side"), "market", "ts", F.col(f"{side}_notional").alias("notional")).orderBy(F.desc("notional"), "market", "ts").limit(n)
        out = best if out is None else out.unionByName(best)
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("side").orderBy(F.desc("notional"), "market", "ts")))


def transitions(rows: DataFrame, last: int) -> DataFrame:
    """market, ts, idx, from, to: the latest changes of state of each market, for rows (market, ts, idx, state)."""
    steps = with_previous(rows.select("market", "ts", "idx", "state"), ["market"], ["ts", "idx"], {"from": F.col("state")}, by_day()).where(F.col("from") != F.col("state"))
    latest = lambda by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("ts"), F.desc("idx"))) <= last
    steps = steps.withColumn("_d", by_day()).withColumn("_k", latest(["market", "_d"])).where("_k")
    return steps.withColumn("_k", latest(["market"])).where("_k").select("market", "ts", "idx", "from", F.col("state").alias("to"))


def degraded(rows: DataFrame) -> DataFrame:
    """``rows`` (market, ts, idx, event) with degraded: a degradation holds until a recovery; ticks change nothing."""
    state = F.when(F.col("event") == "degrade", F.lit(True)).when(F.col("event") == "recover", F.lit(False))
    return with_last(rows, ["market"], ["ts", "idx"], "degraded", state, by_day()).withColumn("degraded", F.coalesce("degraded", F.lit(False)))


def last_good(rows: DataFrame, width: int, value: str) -> DataFrame:
    """market, bucket and ``value`` of the last row of each bucket, one with a book before one without."""
    return rows.groupBy("market", window_start(F.col("ts"), width).alias("bucket")).agg(F.max_by(value, F.struct("has_book", "ts", value)).alias(value))


def previous_sequence(rows: DataFrame) -> DataFrame:
    """``rows`` (market, idx, seq, connected) with prev_seq: the number before; none at the first row of a connection."""
    out = with_previous(rows, ["market"], ["idx"], {"prev_seq": F.col("seq")}, by_million("idx"))
    return out.withColumn("prev_seq", F.when(~F.col("connected"), F.col("prev_seq")))


def event_time(as_of: Column, source: Column, ts: Column) -> Column:
    """The first known of the times of a sample, its source and its receipt, but not after its receipt."""
    return F.least(F.coalesce(as_of, source, ts), ts)


def whole_number(text: Column) -> Column:
    """A number that is not negative, cut to its whole part; null for anything else."""
    x = non_negative(text)
    return F.when(x.isNotNull(), F.floor(x).cast("double"))


def digests(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with md5, sha256 and crc32 of a column."""
    return rows.withColumns({"md5": F.md5(column), "sha256": F.sha2(column, 256), "crc32": F.crc32(column)})


def gap_durations(rows: DataFrame, least: int) -> DataFrame:
    """market, gap_start, shown: gaps over ``least`` ms in the largest unit that fits."""
    steps = with_previous(rows.select("market", "ts").distinct(), ["market"], ["ts"], {"gap_start": F.col("ts")}, by_day())
    g = F.col("ts") - F.col("gap_start")
    unit = lambda ms, name: F.concat(F.floor(g / ms).cast("string"), F.lit(name))
    shown = F.when(g < 60_000, unit(1_000, "s")).when(g < 3_600_000, unit(60_000, "m")).when(g < 86_400_000, unit(3_600_000, "h")).otherwise(unit(86_400_000, "d"))
    return steps.where(g > least).select("market", "gap_start", shown.alias("shown"))


def price_levels(entries: DataFrame) -> DataFrame:
    """market, side, price, qty: single orders added up by price."""
    return entries.groupBy("market", "side", "price").agg(F.sum("qty").alias("qty"))


def store_counts(batches: DataFrame) -> DataFrame:
    """stream, market, batches, row_count, raw_bytes, in order of market."""
    return batches.groupBy("stream", "market").agg(F.count("*").alias("batches"), F.sum("row_count").alias("row_count"), F.sum("raw_bytes").alias("raw_bytes")).orderBy("market", "stream")


def losses(rows: DataFrame, surfaces: list[str]) -> DataFrame:
    """market, lost: of each population the first count that any surface reports, added up."""
    return rows.groupBy("market").agg(F.sum(F.coalesce(*surfaces, F.lit(0))).cast("long").alias("lost"))


def block_join(trades: DataFrame, books: DataFrame) -> DataFrame:
    """Blocks of trades with the book block of the same market and time, if there is one."""
    return trades.join(books, ["market", "block_ms"], "left")


def lag_by_time(rows: DataFrame, value: str, lags: dict[str, int]) -> DataFrame:
    """``rows`` (market, ts, value) with the value exactly so many ms earlier; null where that time has no row.

    Each row is dealt to the times at which it is wanted, so all lags share one shuffle.
    """
    own = F.struct(F.col("ts").alias("at"), F.lit("").alias("n"), F.col(value).alias("v"))
    sent = [F.struct((F.col("ts") + ms).alias("at"), F.lit(n).alias("n"), F.col(value).alias("v")) for n, ms in lags.items()]
    spread = rows.select("market", F.explode(F.array(own, *sent)).alias("x")).select("market", "x.*")
    pick = lambda n: F.max(F.when(F.col("n") == n, F.col("v")))
    out = spread.groupBy("market", F.col("at").alias("ts")).agg(F.bool_or(F.col("n") == "").alias("_own"), pick("").alias(value), *(pick(n).alias(n) for n in lags))
    return out.where("_own").drop("_own")


def cvd_on_rows(rows: DataFrame, bars: DataFrame, width: int) -> DataFrame:
    """market, ts, cvd: running signed volume at each display row; a bucket without trades adds nothing."""
    sums = bars.groupBy("market", window_start(F.col("ts"), width).alias("ts")).agg(F.sum(F.col("buy_qty") - F.col("sell_qty")).alias("delta"))
    out = rows.select("market", "ts").join(sums, ["market", "ts"], "left").na.fill(0, ["delta"])
    return with_running(out, ["market"], ["ts"], "cvd", F.col("delta"), F.floor(F.col("ts") / (width * 10_000))).select("market", "ts", "cvd")


def snapshot_sync(updates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``updates`` (market, first, seq) against the snapshot's number: old ones go, the one that bridges it comes first, others after."""
    s = F.col("snapshot_seq")
    part = F.when(F.col("seq") <= s, "old").when(F.col("first") <= s + 1, "bridge").otherwise("after")
    return updates.join(F.broadcast(snapshots), "market").withColumn("part", part)


def virtual_blocks(rows: DataFrame, width: int) -> DataFrame:
    """market, block_ms, lines, sha256 of every block from the first to the last; an empty block has no digest. Lines are in order of time and number."""
    from .trades import dense_grid

    block = window_start(F.col("ts"), width)
    parts = rows.groupBy("market", block.alias("block_ms")).agg(F.count("*").alias("lines"), F.array_sort(F.collect_list(F.struct("ts", "idx", "line"))).alias("l"))
    parts = parts.select("market", "block_ms", "lines", F.sha2(F.array_join(F.col("l.line"), "\n"), 256).alias("sha256"))
    return dense_grid(rows, width).withColumnRenamed("ts", "block_ms").join(parts, ["market", "block_ms"], "left").na.fill(0, ["lines"])


def mini_batches(rows: DataFrame, width: int) -> DataFrame:
    """market, batch, n, first, last: late rows that fit no batch, as batches of their own by window."""
    return rows.groupBy("market", window_start(F.col("ts"), width).alias("batch")).agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


def canonical_frames(frames: DataFrame, order: str) -> DataFrame:
    """The first frame of each (connection_id, receive_seq), all of those without a number, with its sha256."""
    rest = [c for c in frames.columns if c not in ("connection_id", "receive_seq")]
    numbered = frames.where("receive_seq is not null").groupBy("connection_id", "receive_seq").agg(F.min_by(F.struct(*rest), order).alias("r")).select("connection_id", "receive_seq", "r.*")
    return numbered.unionByName(frames.where("receive_seq is null").select(*numbered.columns)).withColumn("frame_sha256", F.sha2("frame", 256))


def envelopes(rows: DataFrame, fields: list[str]) -> DataFrame:
    """``rows`` with the fields as one JSON text."""
    return rows.withColumn("envelope", F.to_json(F.struct(*fields)))


def dedupe_in_window(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """The first row of each key in each window of time: how long a key is remembered, without a bound on keys."""
    from .asof import keep_first

    return keep_first(rows.withColumn("_w", window_start(F.col("ts"), width)), [*keys, "_w"], ["ts", "idx"]).drop("_w")


def guarded(rows: DataFrame) -> DataFrame:
    """Rows with a usable price, quantity, side and time."""
    return rows.where(valid_trade(F.col("price"), F.col("qty"), F.col("side"), F.col("ts")))


def bar_violations(bars: DataFrame) -> DataFrame:
    """market, violations: bars whose prices are not in order, and those with a negative quantity."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    order = (h < l) | (o > h) | (o < l) | (c > h) | (c < l)
    return bars.groupBy("market").agg((F.count_if(order) + F.count_if((F.col("buy_qty") < 0) | (F.col("sell_qty") < 0))).alias("violations"))


def complete_candles(bars: DataFrame, width: int, least: int) -> DataFrame:
    """Candles of at least ``least`` bars; others are incomplete and go."""
    from .trades import candles

    return candles(bars, width).where(F.col("n") >= least)
