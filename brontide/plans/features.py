"""More registered queries: full rollups, contracts, depth, retention, displays and digests, each with its DuckDB counterpart.

Where the tables have no column for something (book flow of a trade market, quality flags), a stand-in is
made of what they have, alike on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof, book, bursts, contracts, depth, more, trades
from ..sources import rest, sinks
from ..sources import tables as T
from .catalogue import CAP, DAY, GAP, HOUR, LARGE, WEEK, _quotes, _state, query

# --- full rollups ---------------------------------------------------------------------------------

_ONE = """, touch AS (SELECT g.market, g.ts, count(*) AS burst_count, sum(b.notional) AS total_burst_notional, max(b.notional) AS max_burst_notional, max(b.prints) AS max_burst_prints, max(b.duration) AS max_burst_duration_ms
  FROM grid g JOIN bursts b ON b.market = g.market AND b.start < g.ts + $H AND b."end" >= g.ts GROUP BY ALL),
flow AS (SELECT market, h AS ts, count(*) AS trade_count, count(*) FILTER (side = 'buy') AS buy_trade_count, count(*) FILTER (side = 'sell') AS sell_trade_count, sum(qty) AS traded_qty, sum(notional) AS traded_notional,
  coalesce(sum(qty) FILTER (side = 'buy'), 0) AS buy_qty, coalesce(sum(qty) FILTER (side = 'sell'), 0) AS sell_qty, coalesce(sum(notional) FILTER (side = 'buy'), 0) AS buy_notional, coalesce(sum(notional) FILTER (side = 'sell'), 0) AS sell_notional,
  sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) AS signed_volume, sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END) AS signed_notional, max(notional) AS max_trade_notional,
  count(*) FILTER (notional >= $L) AS large_trade_count, coalesce(sum(notional) FILTER (notional >= $L), 0) AS large_trade_notional,
  arg_min(price, (ts, idx)) AS trade_open, max(price) AS trade_high, min(price) AS trade_low, arg_max(price, (ts, idx)) AS trade_close FROM hours GROUP BY market, h),
one AS (SELECT g.market, g.ts, coalesce(burst_count, 0) AS burst_count, coalesce(total_burst_notional, 0) AS total_burst_notional, coalesce(max_burst_notional, 0) AS max_burst_notional, coalesce(max_burst_prints, 0) AS max_burst_prints, coalesce(max_burst_duration_ms, 0) AS max_burst_duration_ms,
  coalesce(trade_count, 0) AS trade_count, coalesce(buy_trade_count, 0) AS buy_trade_count, coalesce(sell_trade_count, 0) AS sell_trade_count, coalesce(traded_qty, 0) AS traded_qty, coalesce(traded_notional, 0) AS traded_notional, coalesce(buy_qty, 0) AS buy_qty, coalesce(sell_qty, 0) AS sell_qty,
  coalesce(buy_notional, 0) AS buy_notional, coalesce(sell_notional, 0) AS sell_notional, coalesce(signed_volume, 0) AS signed_volume, coalesce(signed_notional, 0) AS signed_notional, max_trade_notional, coalesce(large_trade_count, 0) AS large_trade_count, coalesce(large_trade_notional, 0) AS large_trade_notional,
  trade_open, trade_high, trade_low, trade_close, signed_volume AS ofi, buy_qty AS bid_add_qty, buy_qty / 4 AS bid_cancel_qty, sell_qty AS ask_add_qty, sell_qty / 4 AS ask_cancel_qty, max_trade_notional AS replenishment_qty, traded_qty / 2 AS pulling_qty
  FROM grid g LEFT JOIN flow USING (market, ts) LEFT JOIN touch USING (market, ts))"""


def _one(spark, d) -> DataFrame:
    """Feature rows of every window; book flow, which the tables don't have for these markets, stands for parts of the trades."""
    tape = T.tape(spark, d)
    f = trades.trade_flow(tape, HOUR, LARGE)
    names = {"trade_count": "trades", "buy_trade_count": "buys", "sell_trade_count": "sells", "traded_qty": "qty", "traded_notional": "notional", "buy_qty": "buy_qty", "sell_qty": "sell_qty", "buy_notional": "buy_notional", "sell_notional": "sell_notional",
             "signed_volume": "signed_volume", "signed_notional": "signed_notional", "max_trade_notional": "max_notional", "large_trade_count": "large_trades", "large_trade_notional": "large_notional", "trade_open": "open", "trade_high": "high", "trade_low": "low", "trade_close": "close"}
    f = f.select("market", "ts", *(F.col(b).alias(a) for a, b in names.items())).withColumns({
        "ofi": F.col("signed_volume"), "bid_add_qty": F.col("buy_qty"), "bid_cancel_qty": F.col("buy_qty") / 4, "ask_add_qty": F.col("sell_qty"), "ask_cancel_qty": F.col("sell_qty") / 4, "replenishment_qty": F.col("max_trade_notional"), "pulling_qty": F.col("traded_qty") / 2,
    })
    b = bursts.touched_windows(bursts.bursts(tape, GAP, CAP), HOUR).groupBy("market", F.col("second").alias("ts")).agg(
        F.count("*").alias("burst_count"), F.sum("notional").alias("total_burst_notional"), F.max("notional").alias("max_burst_notional"), F.max("prints").alias("max_burst_prints"), F.max("duration").alias("max_burst_duration_ms"))
    out = trades.dense_grid(tape, HOUR).join(f, ["market", "ts"], "left").join(b, ["market", "ts"], "left")
    return out.na.fill(0, [s for _, s in contracts.FIELDS.values() if s not in contracts.MAY_BE_NULL]).withColumns({"finalized": F.lit(True), "input_status": F.lit("arrived-valid"), "warmup": F.lit(False)})


def _rolled_sql(source: str, width: str, into: str, need: int, rolled: bool) -> str:
    how = {"sum": "coalesce(sum({0}), 0)", "mean": "avg({0})", "max": "max({0})", "min": "min({0})", "first": "arg_min({0}, ts) FILTER ({0} IS NOT NULL)", "last": "arg_max({0}, ts) FILTER ({0} IS NOT NULL)", "p95": "quantile_disc({0}, 0.95)"}
    made = ", ".join(f"{how[op].format(name if rolled else s)} AS {name}" for name, (op, s) in contracts.FIELDS.items())
    return f"SELECT market, ts - ts % ({into}) AS w, {made}, count(*) AS source_window_count FROM {source} GROUP BY ALL HAVING count(*) = {need}"


def _full_sql(source: str) -> str:
    exact = ("burst_count_max", "max_burst_prints_max", "max_burst_duration_max", "trade_count", "buy_trade_count", "sell_trade_count", "large_trade_count")
    names = ", ".join(f"{n}::BIGINT AS {n}" if n in exact else f"round({n}::DOUBLE, 6) AS {n}" for n in contracts.FIELDS)
    ratio = ", ".join(f"round(CASE WHEN {b} > 0 THEN {a} / {b} {'ELSE 0 ' if none is not None else ''}END, 6) AS {n}" for n, (a, b, none) in contracts.RATIOS.items())
    return f"SELECT market, w AS ts, {names}, {ratio}, source_window_count, trade_count = 0 AS has_empty_input FROM {source}"


def _shown(df: DataFrame) -> DataFrame:
    whole = ("burst_count_max", "max_burst_prints_max", "max_burst_duration_max", "trade_count", "buy_trade_count", "sell_trade_count", "large_trade_count")
    return df.select("market", "ts", *(F.col(n).cast("long" if n in whole else "double").alias(n) for n in contracts.FIELDS), *contracts.RATIOS, "source_window_count", "has_empty_input")


_THIRTY = _rolled_sql("one", "$H", "30 * $H", 30, False)


@query(_ONE + f", r AS ({_THIRTY}) " + _full_sql("r"))
def feature_rollup_30(spark, d):
    return _shown(contracts.feature_rollup(_one(spark, d), HOUR, 30 * HOUR, "features_1s"))


@query(_ONE + f", r AS ({_THIRTY}), r1 AS (SELECT * EXCLUDE (w), w AS ts FROM r), q AS ({_rolled_sql('r1', '30 * $H', '300 * $H', 10, True)}) " + _full_sql("q"))
def feature_rollup_300(spark, d):
    thirty = contracts.feature_rollup(_one(spark, d), HOUR, 30 * HOUR, "features_30s")
    return _shown(contracts.feature_rollup(thirty, 30 * HOUR, 300 * HOUR, "features_30s", rolled=True))


@query("""SELECT market, "window", n AS rows, list_filter(['E_ROLLUP_PARTIAL_WINDOW', 'E_ROLLUP_UNALIGNED', 'E_ROLLUP_INVALID_INPUT_STATUS', 'E_ROLLUP_INVALID_FEATURE', 'E_ROLLUP_DUPLICATE', 'E_ROLLUP_MISSING_SECOND'],
  lambda c: CASE c WHEN 'E_ROLLUP_PARTIAL_WINDOW' THEN n <> 30 WHEN 'E_ROLLUP_UNALIGNED' THEN bad_grid WHEN 'E_ROLLUP_INVALID_INPUT_STATUS' THEN status WHEN 'E_ROLLUP_INVALID_FEATURE' THEN bad WHEN 'E_ROLLUP_DUPLICATE' THEN n > k ELSE k < 30 END) AS codes
  FROM (SELECT market, ts - ts % (30 * $H) AS "window", count(*) AS n, count(DISTINCT ts) AS k, bool_or(ts % $H <> 0) AS bad_grid, bool_or(trades > 30) AS status, bool_or(notional IS NULL) AS bad FROM (
    SELECT market, ts, trades, CASE WHEN trades % 29 <> 0 THEN notional END AS notional FROM bars UNION ALL SELECT market, ts, trades, notional FROM bars WHERE trades % 13 = 0) GROUP BY ALL)""")
def rollup_codes(spark, d):
    b = trades.bars(T.tape(spark, d), HOUR).select("market", "ts", "trades", (F.col("buy_notional") + F.col("sell_notional")).alias("notional"))
    rows = b.withColumn("notional", F.when(F.col("trades") % 29 != 0, F.col("notional"))).unionByName(b.where("trades % 13 = 0"))
    rows = rows.select("market", "ts", F.col("notional").alias("traded_notional"), F.lit(True).alias("finalized"), F.when(F.col("trades") > 30, "book-Missing").otherwise("arrived-valid").alias("input_status"))
    return contracts.window_codes(rows, HOUR, 30 * HOUR)


@query("""SELECT market, ts, list_filter(['ts is not aligned', 'source_window_count', 'coverage', 'finalized', 'input_status', 'has_empty_input'], lambda c: CASE c WHEN 'ts is not aligned' THEN ts % (5 * $H) <> 0 WHEN 'source_window_count' THEN trades <> 10 WHEN 'coverage' THEN trades % 2 <> 1
  WHEN 'finalized' THEN trades % 3 = 0 WHEN 'input_status' THEN trades % 5 = 0 ELSE trades % 7 = 0 END) AS reasons FROM bars""")
def consumer_rows(spark, d):
    n = F.col("trades")
    b = trades.bars(T.tape(spark, d), HOUR).select("market", "ts", n, n.alias("source_window_count"), (n % 2).alias("coverage"), (n % 3 != 0).alias("finalized"), F.lit("features_30s").alias("source_layer"), F.lit(False).alias("has_missing_input"),
                                                   F.when(n % 5 != 0, "arrived-valid").otherwise("blocked").alias("input_status"), F.when(n % 7 != 0, F.lit(True)).alias("has_empty_input"))
    return contracts.consumer_reasons(b, 5 * HOUR).select("market", "ts", "reasons")


@query("""SELECT market, block, n AS rows, list_filter(['short', 'unseeded', 'crossed'], lambda c: CASE c WHEN 'short' THEN n < 4 WHEN 'unseeded' THEN NOT s ELSE x END) AS flags FROM (SELECT market, anchor - anchor % (4 * $W::BIGINT) AS block, count(*) AS n, bool_and(sd) AS s, bool_or(coalesce(sd AND bb >= ba, false)) AS x FROM (
  SELECT market, anchor, max(price) FILTER (side = 'bid') AS bb, min(price) FILTER (side = 'ask') AS ba, count(*) FILTER (side = 'bid') > 0 AND count(*) FILTER (side = 'ask') > 0 AS sd FROM state GROUP BY ALL) GROUP BY ALL)""")
def snapshot_blocks(spark, d):
    return contracts.snapshot_block_flags(book.snapshots(_state(spark, d)), 4 * WEEK, 4)


@query("SELECT a.market, a.ts, count(b.ts) AS have FROM bars a LEFT JOIN bars b ON b.market = a.market AND b.ts BETWEEN a.ts - 30 * $H AND a.ts - $H GROUP BY ALL HAVING count(b.ts) < 30")
def incomplete_lookups(spark, d):
    return contracts.incomplete_lookups(trades.bars(T.tape(spark, d), HOUR), HOUR, 30)


@query("""SELECT market, kind, unnest(generate_series(p + $H, b - $H, $H)) AS block_ms, CASE WHEN kind = 'trades' THEN 'assumed-empty' ELSE 'verified-missing' END AS policy, CASE WHEN kind <> 'trades' THEN ((unnest(generate_series(p + $H, b - $H, $H)) + $H + $D - 1) // $D) * $D END AS resumes FROM (
  SELECT market, kind, b, lag(b) OVER (PARTITION BY market, kind ORDER BY b) AS p FROM (SELECT DISTINCT market, CASE WHEN side = 'buy' THEN 'trades' ELSE 'book' END AS kind, h AS b FROM hours)) WHERE b - p > $H""")
def gap_policy(spark, d):
    rows = T.tape(spark, d).select("market", F.when(F.col("side") == "buy", "trades").otherwise("book").alias("kind"), S.window_start(F.col("ts"), HOUR).alias("block_ms"))
    return contracts.gap_policy(rows, HOUR, DAY)


@query("""SELECT o_orderpriority AS market, CASE o_orderstatus WHEN 'F' THEN 'trades' WHEN 'O' THEN 'book' ELSE 'x' END AS kind, o_custkey % 500 AS block_ms, o_orderkey::VARCHAR AS path, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'kind' WHEN count(*) OVER (PARTITION BY o_orderpriority, o_orderstatus, o_custkey % 500) > 1 THEN 'duplicate' END AS error FROM orders""")
def frozen_inventory(spark, d):
    o, status = T.table(spark, d, "orders"), F.col("o_orderstatus")
    return contracts.frozen_inventory(o.select(F.col("o_orderpriority").alias("market"), F.when(status == "F", "trades").when(status == "O", "book").otherwise("x").alias("kind"), (F.col("o_custkey") % 500).alias("block_ms"), F.col("o_orderkey").cast("string").alias("path")))


@query("""SELECT o_orderpriority AS market, o_orderkey AS block_ms, list_filter(['manifest', 'outputs', 'footprint', 'cursor', 'quarantine'], lambda c: CASE c WHEN 'manifest' THEN o_custkey % 3 = 0 WHEN 'outputs' THEN o_custkey % 5 = 0 WHEN 'footprint' THEN o_orderstatus = 'P' WHEN 'cursor' THEN o_orderkey >= 3000 ELSE o_custkey % 7 = 0 END) AS missing FROM orders WHERE o_orderkey < 4000""")
def retention(spark, d):
    o = T.table(spark, d, "orders").select(F.col("o_orderpriority").alias("market"), F.col("o_orderkey").alias("block_ms"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"))
    cursors = o.select("market").distinct().withColumn("cursor", F.lit(3000).cast("long"))
    return contracts.retention(o, o.where("c % 3 <> 0"), o.where("c % 5 <> 0"), o.where("s <> 'P'"), cursors, o.where("c % 7 = 0"), 5000, 1000)


# --- depth ----------------------------------------------------------------------------------------


def _order_trades(spark, d) -> DataFrame:
    """Orders as trades that meet the book of the line items."""
    o = T.table(spark, d, "orders")
    return o.select(F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("o_custkey") % 3 + 1).cast("int")).alias("market"), F.col("o_orderkey").alias("idx"), T.millis(F.col("o_orderdate")).alias("ts"),
                    F.when(F.col("o_orderkey") % 2 == 0, "buy").otherwise("sell").alias("side"), (F.col("o_custkey") % 90).cast("double").alias("price"))


_SWEPT = """, o AS (SELECT (['A', 'N', 'R'])[o_custkey % 3 + 1] AS market, o_orderkey AS idx, epoch_us(o_orderdate) // 1000 AS ts, CASE WHEN o_orderkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, (o_custkey % 90)::DOUBLE AS price FROM orders),
v AS (SELECT market, side, price, ts, arg_max(qty, ord) AS qty FROM levels GROUP BY ALL), p AS (SELECT DISTINCT market, side, price FROM levels),
c AS (SELECT o.market, o.idx, o.ts, p.side, p.price FROM o JOIN p ON p.market = o.market AND p.side = CASE WHEN o.side = 'buy' THEN 'ask' ELSE 'bid' END AND CASE WHEN o.side = 'buy' THEN p.price <= o.price ELSE p.price >= o.price END),
s AS (SELECT c.market, c.idx, c.price, v.qty FROM c ASOF JOIN v ON c.market = v.market AND c.side = v.side AND c.price = v.price AND c.ts > v.ts)
SELECT o.market, o.idx, count(s.qty) FILTER (s.qty > 0) AS levels, round(coalesce(sum(s.price * s.qty) FILTER (s.qty > 0), 0), 6) AS notional FROM o LEFT JOIN s ON s.market = o.market AND s.idx = o.idx GROUP BY o.market, o.idx"""


@query(_SWEPT)
def swept_levels(spark, d):
    return depth.swept(_order_trades(spark, d), T.book_levels(spark, d), 30 * DAY)


@query("""SELECT market, anchor, b AS bid_depth, a AS ask_depth, round(CASE WHEN a + b > 0 THEN (b - a) / (a + b) END, 6) AS imbalance FROM (SELECT s.market, s.anchor, coalesce(sum(qty) FILTER (side = 'bid'), 0) AS b, coalesce(sum(qty) FILTER (side = 'ask'), 0) AS a FROM state s JOIN best q USING (market, anchor)
  WHERE CASE WHEN side = 'bid' THEN abs(price - best_bid) <= best_bid * 0.2 ELSE abs(price - best_ask) <= best_ask * 0.2 END GROUP BY ALL)""")
def depth_within(spark, d):
    return depth.depth_within(_state(spark, d), 0.2)


@query("""SELECT market, ts, round(total, 6) AS total, top AS top_depth, round(CASE WHEN top > 0 THEN total / top END, 6) AS board_top_depth_ratio, round(CASE WHEN t30 > 0 THEN total / t30 END, 6) AS board_vs_30s, round(CASE WHEN total > 0 AND top > 0 THEN total / top END, 6) AS burst_notional_vs_top_depth FROM (
  SELECT d.market, d.ts, coalesce(s.total, 0) AS total, t30, round(bb * bq + ba * aq, 6) AS top FROM (SELECT market, ts, coalesce(sum(notional) OVER (PARTITION BY market ORDER BY ts ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0) AS t30 FROM dense) d
  LEFT JOIN (SELECT g.market, g.ts, sum(b.notional) AS total FROM grid g JOIN bursts b ON b.market = g.market AND b.start < g.ts + $H AND b."end" >= g.ts GROUP BY ALL) s USING (market, ts)
  JOIN (SELECT market, ts + $H AS ts, round(close - 1, 2) AS bb, buy_qty AS bq, round(close + 1, 2) AS ba, sell_qty AS aq FROM bars) q USING (market, ts))""")
def board_features(spark, d):
    tape = T.tape(spark, d)
    totals = bursts.touched_windows(bursts.bursts(tape, GAP, CAP), HOUR).groupBy("market", F.col("second").alias("ts")).agg(F.sum("notional").alias("total"))
    rows = trades.trailing_notional(tape, HOUR, 30).drop("notional").join(totals, ["market", "ts"], "left").na.fill(0, ["total"]).join(_quotes(spark, d), ["market", "ts"])
    return depth.board(rows).select("market", "ts", "total", "top_depth", "board_top_depth_ratio", "board_vs_30s", "burst_notional_vs_top_depth")


@query(None)
def update_flow(spark, d):
    """Best quotes after each single update need a replay, which SQL can't say; tests hold a plain replay against it."""
    return depth.update_flow(T.book_levels(spark, d), DAY)


# --- orders, displays and joins -------------------------------------------------------------------


@query("""SELECT t.market, t.ts, round(t.delta, 6) AS delta, round(coalesce(b.burst_delta, 0), 6) AS burst_delta, round(t.delta - coalesce(b.burst_delta, 0), 6) AS non_burst_delta FROM (SELECT market, h AS ts, sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END) AS delta FROM hours GROUP BY ALL) t
  LEFT JOIN (SELECT market, start - start % $H AS ts, sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END) AS burst_delta FROM bursts WHERE prints >= 2 GROUP BY ALL) b USING (market, ts)""")
def non_burst_delta(spark, d):
    return more.non_burst_delta(T.tape(spark, d), HOUR, GAP, CAP)


@query("""SELECT market, list_sort(list(DISTINCT side)) AS sides, count(DISTINCT side) = 2 AS covered, h AS ts FROM hours GROUP BY market, h""")
def coverage_of_required(spark, d):
    rows = T.tape(spark, d).select("market", S.window_start(F.col("ts"), HOUR).alias("ts"), "side")
    return more.coverage(rows, ["market", "ts"], "side", ["buy", "sell"]).withColumnRenamed("have", "sides")


@query("""SELECT market, idx, row_number() OVER (PARTITION BY market, d ORDER BY ts, k, coalesce(seq_start, seq) NULLS LAST, path, line) AS place, d AS day FROM (SELECT market, idx, ts, ts - ts % $D AS d, CASE WHEN idx % 10 = 0 THEN 0 ELSE 1 END AS k, CASE WHEN idx % 3 = 0 THEN idx - 2 END AS seq_start, CASE WHEN idx % 5 <> 0 THEN idx END AS seq, side AS path, idx AS line FROM tape)""")
def book_event_order(spark, d):
    i = F.col("idx")
    rows = T.tape(spark, d).select("market", "idx", "ts", S.window_start(F.col("ts"), DAY).alias("day"), F.when(i % 10 == 0, "snapshot").otherwise("update").alias("type"), F.when(i % 3 == 0, i - 2).alias("seq_start"), F.when(i % 5 != 0, i).alias("seq"), F.col("side").alias("path"), i.alias("line"))
    return more.placed(rows, ["market", "day"]).select("market", "day", "idx", "place")


@query("""SELECT * FROM (SELECT 'buy' AS side, market, ts, round(b, 6) AS notional, row_number() OVER (ORDER BY b DESC, market, ts) AS rank FROM n UNION ALL SELECT 'sell', market, ts, round(s, 6), row_number() OVER (ORDER BY s DESC, market, ts) FROM n) WHERE rank <= 12""".replace("FROM n", "FROM (SELECT market, h AS ts, coalesce(sum(notional) FILTER (side = 'buy'), 0) AS b, coalesce(sum(notional) FILTER (side = 'sell'), 0) AS s FROM hours GROUP BY market, h)"))
def top_seconds_by_side(spark, d):
    return more.top_by_side(trades.bars(T.tape(spark, d), HOUR), 12)


@query("""SELECT market, ts, "from", "to" FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY ts DESC, idx DESC) AS k FROM (SELECT market, ts, idx, lag(side) OVER w AS "from", side AS "to" FROM tape WINDOW w AS (PARTITION BY market ORDER BY ts, idx)) WHERE "from" <> "to") WHERE k <= 50""")
def last_transitions(spark, d):
    return more.transitions(T.tape(spark, d).withColumnRenamed("side", "state"), 50).select("market", "ts", "from", "to")


@query("""SELECT market, ts - ts % $D AS bucket, arg_max(idx, (idx % 4 = 0, ts, idx)) AS idx FROM tape GROUP BY ALL""")
def last_good_row(spark, d):
    rows = T.tape(spark, d).withColumn("has_book", F.col("idx") % 4 == 0)
    return more.last_good(rows, DAY, "idx")


@query("""SELECT market, idx, lag(idx) OVER (PARTITION BY market, c ORDER BY idx) AS prev_seq FROM (SELECT market, idx, sum(CASE WHEN idx % 100 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY market ORDER BY idx) AS c FROM tape)""")
def previous_sequence(spark, d):
    rows = T.tape(spark, d).select("market", "idx", F.col("idx").alias("seq"), (F.col("idx") % 100 == 0).alias("connected"))
    return more.previous_sequence(rows).select("market", "idx", "prev_seq")


@query("SELECT market, idx, row_number() OVER (PARTITION BY market ORDER BY ts, idx) - 1 AS row_id FROM tape")
def row_numbers(spark, d):
    return sinks.numbered(T.tape(spark, d).select("market", "ts", "idx"), ["ts", "idx"], S.window_start(F.col("ts"), DAY)).select("market", "idx", "row_id")


@query("""SELECT o_orderkey AS idx, least(coalesce(CASE WHEN o_orderkey % 3 = 0 THEN a + 5 END, CASE WHEN o_orderkey % 2 = 0 THEN a - 7 END, a), a) AS event_ts FROM (SELECT *, epoch_us(o_orderdate) // 1000 AS a FROM orders)""")
def oi_event_time(spark, d):
    o, k, a = T.table(spark, d, "orders"), F.col("o_orderkey"), T.millis(F.col("o_orderdate"))
    return o.select(k.alias("idx"), more.event_time(F.when(k % 3 == 0, a + 5), F.when(k % 2 == 0, a - 7), a).alias("event_ts"))


@query("""SELECT c_custkey, md5(c_name) AS name_md5, sha256(c_name) AS name_sha256 FROM customer""")
def digests(spark, d):
    c = T.table(spark, d, "customer")
    return more.digests(c, "c_name").select("c_custkey", F.col("md5").alias("name_md5"), F.col("sha256").alias("name_sha256"))


@query("""SELECT c_custkey, CASE WHEN x >= 0 THEN trunc(x) END AS whole, CASE WHEN x >= 0 THEN x END AS number FROM (SELECT c_custkey, try_cast(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_acctbal::VARCHAR ELSE c_name END AS DOUBLE) AS x FROM customer)""")
def strict_numbers(spark, d):
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey") % 3
    text = F.when(k == 0, "").when(k == 1, F.col("c_acctbal").cast("string")).otherwise(F.col("c_name"))
    return c.select("c_custkey", more.whole_number(text).alias("whole"), S.non_negative(text).alias("number"))


@query("""SELECT market, gap_start, CASE WHEN g < 60000 THEN (g // 1000)::VARCHAR || 's' WHEN g < 3600000 THEN (g // 60000)::VARCHAR || 'm' WHEN g < 86400000 THEN (g // 3600000)::VARCHAR || 'h' ELSE (g // 86400000)::VARCHAR || 'd' END AS shown FROM (SELECT market, lag(ts) OVER (PARTITION BY market ORDER BY ts) AS gap_start, ts - lag(ts) OVER (PARTITION BY market ORDER BY ts) AS g FROM (SELECT DISTINCT market, ts FROM tape)) WHERE g > $H""")
def gap_durations(spark, d):
    return more.gap_durations(T.tape(spark, d), HOUR)


@query("SELECT l_returnflag AS market, CASE WHEN l_linestatus = 'F' THEN 'bid' ELSE 'ask' END AS side, (l_partkey % 50)::DOUBLE AS price, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL")
def price_levels(spark, d):
    i = T.table(spark, d, "lineitem")
    return more.price_levels(i.select(F.col("l_returnflag").alias("market"), F.when(F.col("l_linestatus") == "F", "bid").otherwise("ask").alias("side"), (F.col("l_partkey") % 50).cast("double").alias("price"), F.col("l_quantity").alias("qty")))


@query("SELECT o_orderstatus AS stream, o_orderpriority AS market, count(*) AS batches, sum(o_custkey)::BIGINT AS row_count, sum(o_shippriority)::BIGINT AS raw_bytes FROM orders GROUP BY ALL ORDER BY market, stream".replace("o_shippriority", "o_orderkey"))
def store_counts(spark, d):
    o = T.table(spark, d, "orders")
    return more.store_counts(o.select(F.col("o_orderstatus").alias("stream"), F.col("o_orderpriority").alias("market"), F.col("o_custkey").alias("row_count"), F.col("o_orderkey").alias("raw_bytes")))


@query("SELECT market, sum(coalesce(CASE WHEN idx % 2 = 0 THEN 1 END, CASE WHEN idx % 3 = 0 THEN 2 END, 0))::BIGINT AS lost FROM tape GROUP BY market")
def loss_accounting(spark, d):
    i = F.col("idx")
    return more.losses(T.tape(spark, d).select("market", F.when(i % 2 == 0, 1).alias("queue"), F.when(i % 3 == 0, 2).alias("writer")), ["queue", "writer"])


@query("""SELECT t.market, t.h AS block_ms, t.n AS trades, b.n AS books FROM (SELECT market, h, count(*) AS n FROM hours WHERE side = 'buy' GROUP BY ALL) t LEFT JOIN (SELECT market, h, count(*) AS n FROM hours WHERE side = 'sell' GROUP BY ALL) b USING (market, h)""")
def block_join(spark, d):
    rows = T.tape(spark, d).withColumn("block_ms", S.window_start(F.col("ts"), HOUR))
    count = lambda side, name: rows.where(F.col("side") == side).groupBy("market", "block_ms").agg(F.count("*").alias(name))
    return more.block_join(count("buy", "trades"), count("sell", "books"))


@query("SELECT a.market, a.ts, a.close, b.close AS close_1, c.close AS close_30 FROM bars a LEFT JOIN bars b ON b.market = a.market AND b.ts = a.ts - $H LEFT JOIN bars c ON c.market = a.market AND c.ts = a.ts - 30 * $H")
def lag_by_time(spark, d):
    return more.lag_by_time(trades.bars(T.tape(spark, d), HOUR).select("market", "ts", "close"), "close", {"close_1": HOUR, "close_30": 30 * HOUR})


@query("""SELECT d.market, d.ts, round(sum(coalesce(b.delta, 0)) OVER (PARTITION BY d.market ORDER BY d.ts), 6) AS cvd FROM (SELECT market, unnest(generate_series(a - a % $D, b, $D)) AS ts FROM (SELECT market, min(ts) AS a, max(ts) AS b FROM tape GROUP BY market)) d
  LEFT JOIN (SELECT market, ts - ts % $D AS ts, sum(buy_qty - sell_qty) AS delta FROM bars GROUP BY ALL) b USING (market, ts)""")
def cvd_on_rows(spark, d):
    tape = T.tape(spark, d)
    return more.cvd_on_rows(trades.dense_grid(tape, DAY), trades.bars(tape, HOUR), DAY)


@query("""SELECT a.market, a.anchor, s.ts AS seed_ts, s.idx AS seed FROM (SELECT market, unnest(generate_series(min(ts) - min(ts) % $D, max(ts), $D)) AS anchor FROM tape GROUP BY market) a ASOF LEFT JOIN (SELECT market, ts, max(idx) AS idx FROM tape WHERE idx % 10 = 0 GROUP BY ALL) s ON a.market = s.market AND a.anchor >= s.ts""")
def latest_seed(spark, d):
    tape = T.tape(spark, d)
    anchors = trades.dense_grid(tape, DAY).withColumn("anchor", F.col("ts"))
    seeds = tape.where("idx % 10 = 0").select("market", "ts", F.col("idx").alias("seed"))
    return asof.as_of(anchors, seeds, ["market"], ["seed"], "seed").select("market", "anchor", F.col("sample_ts").alias("seed_ts"), "seed")


@query("""SELECT market, ts, idx, state, degraded FROM (SELECT *, CASE WHEN max(CASE WHEN bad THEN r END) OVER w IS NULL THEN false WHEN max(CASE WHEN good THEN r END) OVER w IS NULL THEN true ELSE max(CASE WHEN bad THEN r END) OVER w > max(CASE WHEN good THEN r END) OVER w END AS degraded FROM (
  SELECT market, ts, idx, side AS state, idx % 7 = 0 AS bad, idx % 11 = 0 AND idx % 7 <> 0 AND side = 'buy' AS good, row_number() OVER (PARTITION BY market ORDER BY ts, idx) AS r FROM tape) WINDOW w AS (PARTITION BY market ORDER BY r))""")
def degraded_states(spark, d):
    i = F.col("idx")
    rows = T.tape(spark, d).select("market", "ts", "idx", F.col("side").alias("state"), F.when(i % 7 == 0, "degrade").when((i % 11 == 0) & (F.col("side") == "buy"), "recover").otherwise("tick").alias("event"))
    return more.degraded(rows).select("market", "ts", "idx", "state", "degraded")


@query("""SELECT u.market, u.idx, u.seq, CASE WHEN u.seq <= s.seq THEN 'old' WHEN u.first <= s.seq + 1 THEN 'bridge' ELSE 'after' END AS part FROM (SELECT market, idx, idx AS seq, idx - 4 AS first FROM tape) u JOIN (SELECT market, quantile_disc(idx, 0.5) AS seq FROM tape GROUP BY market) s USING (market)""")
def snapshot_sync(spark, d):
    tape = T.tape(spark, d)
    snapshot = tape.groupBy("market").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY idx)").cast("long").alias("snapshot_seq"))
    return more.snapshot_sync(tape.select("market", "idx", F.col("idx").alias("seq"), (F.col("idx") - 4).alias("first")), snapshot).select("market", "idx", "seq", "part")


@query("""SELECT market, block_ms, count(*) FILTER (idx IS NOT NULL) AS lines, CASE WHEN count(idx) > 0 THEN sha256(string_agg(idx::VARCHAR, chr(10) ORDER BY ts, idx)) END AS sha256 FROM (SELECT g.market, g.ts AS block_ms, h.ts, h.idx FROM grid g LEFT JOIN hours h ON h.market = g.market AND h.h = g.ts) GROUP BY ALL""")
def virtual_blocks(spark, d):
    return more.virtual_blocks(T.tape(spark, d).select("market", "ts", "idx", F.col("idx").cast("string").alias("line")), HOUR)


@query("""SELECT market, ts - ts % $D AS batch, count(*) AS n, min(ts) AS first, max(ts) AS last FROM (SELECT t.* FROM tape t WHERE NOT EXISTS (SELECT 1 FROM bursts b WHERE b.market = t.market AND b.prints >= 3 AND t.ts BETWEEN b.start AND b."end")) GROUP BY ALL""")
def late_leftovers(spark, d):
    tape = T.tape(spark, d)
    batches = bursts.bursts(tape, GAP, CAP).where("prints >= 3").select("market", F.col("burst").cast("long").alias("interval_id"), F.col("start").alias("lo"), F.col("end").alias("hi"))
    placed = asof.narrowest_interval(tape.select("idx", "market", "ts"), batches, ["market"], HOUR)
    return more.mini_batches(placed.where("interval_id is null"), DAY)


@query("""SELECT market, idx, sha256(market || '|' || idx::VARCHAR) AS frame_sha256 FROM (SELECT market, idx, row_number() OVER (PARTITION BY market, price ORDER BY idx) AS k FROM tape) WHERE k = 1""")
def canonical_frames(spark, d):
    rows = T.tape(spark, d).select(F.col("market").alias("connection_id"), F.col("price").alias("receive_seq"), "idx", F.concat_ws("|", "market", F.col("idx").cast("string")).alias("frame"))
    return more.canonical_frames(rows, "idx").select(F.col("connection_id").alias("market"), "idx", "frame_sha256")


@query("""SELECT market, idx, '{"market":"' || market || '","idx":' || idx::VARCHAR || ',"side":"' || side || '"}' AS envelope FROM tape""")
def envelopes(spark, d):
    return more.envelopes(T.tape(spark, d).select("market", "idx", "side"), ["market", "idx", "side"]).select("market", "idx", "envelope")


@query("""SELECT market, ts, idx FROM (SELECT *, row_number() OVER (PARTITION BY market, side, price, ts - ts % (10 * $H) ORDER BY ts, idx) AS k FROM tape) WHERE k = 1""")
def dedupe_in_window(spark, d):
    return more.dedupe_in_window(T.tape(spark, d), ["market", "side", "price"], 10 * HOUR).select("market", "ts", "idx")


@query("""SELECT market, ts, side, price, qty FROM tape WHERE side = 'sell' AND price > 100 AND qty > 5""")
def liquidation_guard(spark, d):
    rows = T.raw_tape(spark, d).where("side = 'sell' and price > 100 and qty > 5")
    return more.guarded(rows).select("market", "ts", "side", "price", "qty")


@query("""SELECT market, violations FROM (SELECT market, count(*) FILTER (high < low OR open > high OR open < low OR close > high OR close < low) + count(*) FILTER (buy_qty < 0 OR sell_qty < 0) AS violations FROM bars GROUP BY market)""")
def bar_violations(spark, d):
    return more.bar_violations(trades.bars(T.tape(spark, d), HOUR))


@query("""SELECT market, ts - ts % $D AS candle, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close, sum(buy_qty) AS buy_qty, sum(sell_qty) AS sell_qty, count(*) AS n FROM bars GROUP BY ALL HAVING count(*) >= 6""")
def complete_candles(spark, d):
    return more.complete_candles(trades.bars(T.tape(spark, d), HOUR), DAY, 6)


@query("SELECT ts, list_sort(list(market)) AS markets FROM bars GROUP BY ts HAVING count(*) = (SELECT count(DISTINCT market) FROM bars)")
def covered_times(spark, d):
    b = trades.bars(T.tape(spark, d), HOUR).select("market", "ts")
    names = b.select("market").distinct()
    return more.covered_times(b, names)


def _text(*columns: str):
    """The columns as texts, as replies hold numbers."""
    return [F.col(c).cast("string") for c in columns]


@query("""SELECT market, ts, round(close, 6) AS last_price, round(high, 6) AS high_24h, round(low, 6) AS low_24h, round(buy_qty, 6) AS volume_24h FROM bars""")
def ticker_replies(spark, d):
    """Each hour's bar as the ticker reply of one of five exchanges, read back."""
    b = trades.bars(T.tape(spark, d), HOUR)
    last, high, low, volume = _text("close", "high", "low", "buy_qty")
    row = lambda *names: F.struct(*(x.alias(n) for n, x in zip(names, (last, high, low, volume), strict=True)))
    listed = F.struct(*(F.array(x).alias(n) for n, x in zip("chlv", (last, high, low, volume), strict=True)))
    bodies = {
        "binance_spot": row("lastPrice", "highPrice", "lowPrice", "volume"), "coinbase_spot": row("price", "high", "low", "volume"), "okx_spot": F.struct(F.array(row("last", "high24h", "low24h", "vol24h")).alias("data")),
        "bybit_spot": F.struct(F.lit(0).alias("retCode"), F.struct(F.array(row("lastPrice", "highPrice24h", "lowPrice24h", "volume24h")).alias("list")).alias("result")),
        "kraken_spot": F.struct(F.array().cast("array<string>").alias("error"), F.struct(listed.alias("PAIR")).alias("result")),
    }
    turn, body = F.floor(F.col("ts") / HOUR) % len(bodies), F.lit(None).cast("string")
    for i, value in enumerate(bodies.values()):
        body = F.when(turn == i, F.to_json(value)).otherwise(body)
    replies = b.select(F.col("market").alias("of"), "ts", F.element_at(F.array(*map(F.lit, bodies)), (turn + 1).cast("int")).alias("market"), body.alias("body"))
    return rest.tickers(replies, ("of", "ts")).select(F.col("of").alias("market"), "ts", "last_price", "high_24h", "low_24h", "volume_24h")


@query("""SELECT o_orderkey AS idx, CASE WHEN o_orderkey % 20 <> 10 THEN round(o_totalprice / 10, 6) END AS mark_price, CASE WHEN o_orderkey % 4 <> 3 AND o_orderkey % 20 <> 10 THEN round((o_orderkey % 7 - 3) / 100.0, 6) END AS funding_rate, CASE WHEN o_orderkey % 5 <> 0 THEN round(o_totalprice, 6) END AS open_interest,
  CASE WHEN o_orderkey % 5 <> 0 THEN epoch_ms(o_orderdate::TIMESTAMP) END AS source_ts, CASE WHEN o_orderkey % 5 = 0 THEN 'source_error' END AS error_code FROM orders""")
def derivative_replies(spark, d):
    """Each open-interest sample as the replies of one of four markets, two of which answer in parts; each fifth tells no open interest (and the third market then nothing)."""
    s = T.oi_samples(spark, d).select("idx", "ts", F.when(F.col("idx") % 5 != 0, F.col("oi").cast("string")).alias("oi"), (F.col("oi") / 10).cast("string").alias("mark"), ((F.col("idx") % 7 - 3) / 100).cast("string").alias("funding"), F.col("ts").cast("string").alias("time"))
    body = lambda **fields: F.to_json(F.struct(*(F.col(x).alias(n) for n, x in fields.items())))
    data = lambda **fields: F.concat(F.lit('{"data":['), body(**fields), F.lit("]}"))
    parts = {
        "binance_perp": [body(markPrice="mark", lastFundingRate="funding", time="time"), body(openInterest="oi", time="time")],
        "okx_perp": [data(markPx="mark"), data(fundingRate="funding"), data(oi="oi", ts="time")],
        "hyperliquid_perp": [F.concat(F.lit("[{},["), F.when(F.col("oi").isNotNull(), body(markPx="mark", funding="funding", openInterest="oi")).otherwise(F.lit("")), F.lit("]]"))],
        "bitmex_perp": [F.concat(F.lit("["), F.to_json(F.struct(F.when(F.col("oi").isNotNull(), "XBTUSD").alias("symbol"), F.col("mark").alias("markPrice"), F.col("oi").alias("openInterest"), F.col("time").alias("timestamp"))), F.lit("]"))],
    }
    turn, bodies = F.col("idx") % len(parts), F.lit(None).cast("array<string>")
    for i, texts in enumerate(parts.values()):
        bodies = F.when(turn == i, F.array(*texts)).otherwise(bodies)
    replies = s.select("idx", "ts", F.element_at(F.array(*map(F.lit, parts)), (turn + 1).cast("int")).alias("market"), F.explode(bodies).alias("body"))
    return rest.derivatives(replies, ("market", "ts", "idx")).select("idx", "mark_price", "funding_rate", "open_interest", "source_ts", "error_code")


@query("""SELECT market, h AS ts, CASE side WHEN 'buy' THEN 'bid' ELSE 'ask' END AS side, price, round(sum(qty), 6) AS qty FROM hours GROUP BY ALL""")
def depth_replies(spark, d):
    """The trades of an hour as the orders of one of three exchanges' depth replies, read back as price levels."""
    t = T.tape(spark, d).withColumn("h", S.window_start(F.col("ts"), HOUR))
    order = F.struct(F.when(F.col("side") == "buy", "Buy").otherwise("Sell").alias("side"), F.col("price").cast("string").alias("price"), F.col("qty").cast("string").alias("size"))
    books = t.groupBy("market", "h").agg(F.collect_list(order).alias("o"))
    one = lambda side, f: F.transform(F.filter("o", lambda x: x["side"] == side), f)
    pair, named = lambda x: F.array(x["price"], x["size"]), lambda x: F.struct(x["price"].alias("px"), x["size"].alias("sz"))
    coinbase = F.to_json(F.struct(one("Buy", pair).alias("bids"), one("Sell", pair).alias("asks")))
    hyperliquid = F.to_json(F.struct(F.array(one("Buy", named), one("Sell", named)).alias("levels")))
    turn = F.floor(F.col("h") / HOUR) % 3
    body = F.when(turn == 0, coinbase).when(turn == 1, hyperliquid).otherwise(F.to_json("o"))
    replies = books.select(F.col("market").alias("of"), "h", F.when(turn == 0, "coinbase_spot").when(turn == 1, "hyperliquid_perp").otherwise("bitmex_perp").alias("market"), body.alias("body"))
    return rest.depth_levels(replies, ("market", "of", "h")).select(F.col("of").alias("market"), F.col("h").alias("ts"), "side", "price", "qty")
