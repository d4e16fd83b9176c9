"""All market-data queries and their DuckDB counterparts.

The tables hold about 14 trades an hour, so a "second" is an hour here and all other times scale
with it; the operators' own defaults are in milliseconds. Doubles are rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof, book, bursts, display, open_interest, quality, rollup, trades
from ..sources import tables as T

HOUR = 3_600_000
DAY = 24 * HOUR
GAP, CAP = 2 * HOUR, 6 * HOUR
LARGE = 1_000.0
WEEK = 7 * DAY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with its DuckDB counterpart if SQL has one."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: _rounded(f(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = _rounding(sql)
        return f

    return put


def _rounded(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        x = F.col(f"`{f.name}`")
        six = lambda y: F.round(y + 1e-10, 6) + F.lit(0.0)  # noqa: E731  exact halves go the same way in both engines
        out.append(six(x).alias(f.name) if kind == "double" else F.transform(x, six).alias(f.name) if kind == "array<double>" else x)
    return df.select(*out)


def _rounding(sql: str) -> str:
    """The whole statement, with its constants and with rounding as in _rounded."""
    return (CTE + sql).replace(", 6)", " + 1e-10, 6)").replace("$H", str(HOUR)).replace("$D", str(DAY)).replace("$G", str(GAP)).replace("$C", str(CAP)).replace("$W", str(WEEK)).replace("$L", str(LARGE))


CTE = """WITH RECURSIVE raw AS (
  SELECT event_type AS market, (epoch_us(ts) // 1000) AS ts, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, value AS price,
         try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS qty, event_id AS idx FROM events),
tape AS (SELECT *, price * qty AS notional FROM raw WHERE ts IS NOT NULL AND price > 0 AND isfinite(price) AND qty > 0 AND isfinite(qty)),
hours AS (SELECT *, ts - ts % $H AS h FROM tape),
bars AS (SELECT market, h AS ts, arg_min(price, (ts, idx)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, idx)) AS close,
  coalesce(sum(qty) FILTER (side = 'buy'), 0) AS buy_qty, coalesce(sum(qty) FILTER (side = 'sell'), 0) AS sell_qty, count(*) AS trades, sum(notional) AS notional FROM hours GROUP BY market, h),
grid AS (SELECT market, unnest(generate_series(min(h), max(h), $H)) AS ts FROM hours GROUP BY market),
dense AS (SELECT g.market, g.ts, coalesce(b.trades, 0) AS trades, coalesce(b.notional, 0) AS notional, b.high FROM grid g LEFT JOIN bars b USING (market, ts)),
num AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY ts, idx) AS n FROM tape),
walk AS (SELECT n.*, n.ts AS burst_start, 1::BIGINT AS burst FROM num n WHERE n = 1
  UNION ALL SELECT n.*, CASE WHEN n.side <> w.side OR n.ts - w.ts > $G OR n.ts - w.burst_start > $C THEN n.ts ELSE w.burst_start END,
    w.burst + CASE WHEN n.side <> w.side OR n.ts - w.ts > $G OR n.ts - w.burst_start > $C THEN 1 ELSE 0 END FROM walk w JOIN num n ON n.market = w.market AND n.n = w.n + 1),
bursts AS (SELECT market, burst, side, min(ts) AS start, max(ts) AS "end", sum(notional) AS notional, count(*) AS prints, min(price) AS low, max(price) AS high, count(DISTINCT price) AS prices,
  CASE WHEN count(DISTINCT price) >= 2 THEN round((max(price) - min(price)) / 0.01)::BIGINT ELSE 0 END AS span_ticks, max(ts) - min(ts) AS duration FROM walk GROUP BY market, burst, side),
levels AS (SELECT l_returnflag AS market, CASE WHEN l_linestatus = 'F' THEN 'bid' ELSE 'ask' END AS side,
  (CASE WHEN l_linestatus = 'F' THEN l_partkey % 50 ELSE l_partkey % 50 + 40 END)::DOUBLE AS price, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity END AS qty, (epoch_us(l_shipdate) // 1000) AS ts,
  ((epoch_us(l_shipdate) // 1000), l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS ord FROM lineitem),
ends AS (SELECT market, min(ts) - min(ts) % $W + $W AS a, max(ts) - max(ts) % $W + $W AS b FROM levels GROUP BY market),
anchors AS (SELECT market, unnest(generate_series(a, b, $W)) AS anchor FROM ends),
state AS (SELECT market, anchor, side, price, qty FROM (SELECT a.market, a.anchor, l.side, l.price, arg_max(l.qty, l.ord) AS qty FROM anchors a JOIN levels l ON l.market = a.market AND l.ts < a.anchor GROUP BY ALL) WHERE qty > 0),
best AS (SELECT market, anchor, max(price) FILTER (side = 'bid') AS best_bid, arg_max(qty, price) FILTER (side = 'bid') AS bid_qty, min(price) FILTER (side = 'ask') AS best_ask, arg_min(qty, price) FILTER (side = 'ask') AS ask_qty FROM state GROUP BY ALL),
quotes AS (SELECT *, (best_bid + best_ask) / 2 AS mid, (best_ask - best_bid) / ((best_bid + best_ask) / 2) * 1e4 AS spread_bps, best_bid * bid_qty + best_ask * ask_qty AS top_depth FROM best WHERE best_bid IS NOT NULL AND best_ask IS NOT NULL),
bins AS (SELECT s.market, s.anchor, s.side, floor(s.price) AS bin, round(sum(s.qty), 8) AS qty FROM state s JOIN quotes q USING (market, anchor) WHERE abs(s.price - q.mid) <= 20 AND abs(floor(s.price) - q.mid) <= 20 GROUP BY ALL)
"""


# --- trades ---------------------------------------------------------------------------------------


@query("SELECT market, ts, side, price, qty, idx, round(notional, 6) AS notional, CASE WHEN notional < 1000 THEN 'small' WHEN notional < 10000 THEN 'medium' ELSE 'large' END AS size FROM tape")
def trade_tape(spark, d):
    n = F.col("price") * F.col("qty")
    return T.tape(spark, d).withColumns({"notional": n, "size": S.size_class(n)})


@query("""SELECT market, side, CASE WHEN notional < 1000 THEN 'small' WHEN notional < 10000 THEN 'medium' ELSE 'large' END AS size, count(*) AS n, round(sum(notional), 6) AS notional,
  round(sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END), 6) AS signed_notional FROM tape GROUP BY ALL""")
def size_buckets(spark, d):
    return trades.size_counts(T.tape(spark, d))


_SIZED = ", ".join(
    f"{f} FILTER (side = '{s}' AND {c}) AS {s}_{z}_{w}" if w == "count" else f"coalesce({f} FILTER (side = '{s}' AND {c}), 0) AS {s}_{z}_{w}"
    for s in ("buy", "sell")
    for z, c in (("small", "notional < 1000"), ("medium", "notional >= 1000 AND notional < 10000"), ("large", "notional >= 10000"))
    for w, f in (("count", "count(*)"), ("qty", "sum(qty)"))
)


@query(f"""SELECT market, h AS ts, arg_min(price, (ts, idx)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, idx)) AS close, count(*) AS trades, count(*) FILTER (side = 'buy') AS buys, count(*) FILTER (side = 'sell') AS sells,
  coalesce(sum(qty) FILTER (side = 'buy'), 0) AS buy_qty, coalesce(sum(qty) FILTER (side = 'sell'), 0) AS sell_qty, round(coalesce(sum(notional) FILTER (side = 'buy'), 0), 6) AS buy_notional, round(coalesce(sum(notional) FILTER (side = 'sell'), 0), 6) AS sell_notional,
  {_SIZED}, arg_min(idx, (ts, idx)) AS first_id, arg_max(idx, (ts, idx)) AS last_id, round(sum(notional) / sum(qty), 6) AS vwap, sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) AS delta_qty,
  round(sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END), 6) AS delta_notional, round(sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) / sum(qty), 6) AS imbalance, round(sum(qty) / count(*), 6) AS mean_qty, round(sum(notional) / count(*), 6) AS mean_notional
  FROM hours GROUP BY market, h""")
def agg_1s(spark, d):
    return trades.bars(T.tape(spark, d), HOUR)


@query("""SELECT market, ts, version, trades, round(notional, 6) AS notional FROM (SELECT *, row_number() OVER (PARTITION BY market, ts ORDER BY version DESC) AS k FROM (
  SELECT market, ts, 1 AS version, trades, notional FROM bars UNION ALL SELECT market, ts, 2, trades + 1, notional FROM bars WHERE ts % (2 * $H) = 0)) WHERE k = 1""")
def agg_upsert(spark, d):
    bars = trades.bars(T.tape(spark, d), HOUR).select("market", "ts", F.lit(1).alias("version"), "trades", (F.col("buy_notional") + F.col("sell_notional")).alias("notional"))
    late = bars.where(F.pmod("ts", F.lit(2 * HOUR)) == 0).select("market", "ts", F.lit(2).alias("version"), (F.col("trades") + 1).alias("trades"), "notional")
    return trades.upserted(bars.unionByName(late), ["market", "ts"], "version")


@query("""SELECT market, h AS ts, arg_min(price, (ts, idx)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, idx)) AS close, count(*) AS trades, count(*) FILTER (side = 'buy') AS buys, count(*) FILTER (side = 'sell') AS sells,
  sum(qty) AS qty, round(sum(notional), 6) AS notional, coalesce(sum(qty) FILTER (side = 'buy'), 0) AS buy_qty, coalesce(sum(qty) FILTER (side = 'sell'), 0) AS sell_qty, round(coalesce(sum(notional) FILTER (side = 'buy'), 0), 6) AS buy_notional, round(coalesce(sum(notional) FILTER (side = 'sell'), 0), 6) AS sell_notional,
  round(quantile_disc(notional, 0.5), 6) AS median_notional, round(max(notional), 6) AS max_notional, count(*) FILTER (notional >= $L) AS large_trades, round(coalesce(sum(notional) FILTER (notional >= $L), 0), 6) AS large_notional,
  round(avg(gap), 6) AS mean_gap, quantile_disc(gap, 0.5) AS median_gap, quantile_disc(gap, 0.95) AS p95_gap, count(*) FILTER (flip) AS flips,
  sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) AS signed_volume, round(sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END), 6) AS signed_notional, round(sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) / sum(qty), 6) AS imbalance_qty,
  round(sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END) / sum(notional), 6) AS imbalance_notional, round(sum(notional) / count(*), 6) AS mean_notional, round(coalesce(sum(notional) FILTER (notional >= $L), 0) / sum(notional), 6) AS large_share
  FROM (SELECT *, greatest(ts - lag(ts) OVER w, 0) AS gap, side <> lag(side) OVER w AS flip FROM hours WINDOW w AS (PARTITION BY market ORDER BY ts, idx)) GROUP BY market, h""")
def trade_flow_1s(spark, d):
    return trades.trade_flow(T.tape(spark, d), HOUR, LARGE)


@query("""SELECT market, s AS ts, count(*) AS returns, round(stddev_pop(r), 6) AS volatility FROM (SELECT market, r, unnest(generate_series(ts - ts % $H + $H, p - p % $H + 10 * $H, $H)) AS s FROM (
  SELECT market, ts, lag(ts) OVER w AS p, ln(price / lag(price) OVER w) AS r FROM tape WINDOW w AS (PARTITION BY market ORDER BY ts, idx)) WHERE r IS NOT NULL) GROUP BY market, s HAVING count(*) >= 2""")
def realized_vol(spark, d):
    return trades.realized_volatility(T.tape(spark, d), HOUR, 10)


@query("SELECT market, ts, trades, round(notional, 6) AS notional, high FROM dense")
def dense_grid(spark, d):
    return trades.dense_volume(T.tape(spark, d), HOUR)


@query("SELECT market, ts FROM grid EXCEPT SELECT market, ts FROM bars")
def missing_blocks(spark, d):
    return trades.missing_windows(T.tape(spark, d), HOUR)


@query("SELECT market, ts, round(notional, 6) AS notional, round(coalesce(sum(notional) OVER (PARTITION BY market ORDER BY ts ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0), 6) AS trailing FROM dense")
def traded_notional_30(spark, d):
    return trades.trailing_notional(T.tape(spark, d), HOUR, 30)


@query("SELECT market, ts - ts % $D AS candle, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close, sum(buy_qty) AS buy_qty, sum(sell_qty) AS sell_qty, count(*) AS n FROM bars GROUP BY ALL")
def candles(spark, d):
    return trades.candles(trades.bars(T.tape(spark, d), HOUR), DAY)


@query("""SELECT market, bucket, delta, CASE WHEN bucket - lag(bucket) OVER w > $H THEN NULL ELSE sum(delta) OVER w END AS cvd FROM (SELECT market, ts AS bucket, sum(buy_qty - sell_qty) AS delta FROM bars GROUP BY ALL) WINDOW w AS (PARTITION BY market ORDER BY bucket)""")
def cvd(spark, d):
    return trades.cumulative_delta(trades.bars(T.tape(spark, d), HOUR), HOUR)


@query("""SELECT market, ts - ts % $D AS "window", floor(price) AS cell, coalesce(sum(qty) FILTER (side = 'buy'), 0) AS buy_qty, coalesce(sum(qty) FILTER (side = 'sell'), 0) AS sell_qty, round(sum(notional), 6) AS notional, count(*) AS n,
  sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) AS delta FROM tape GROUP BY ALL""")
def footprint(spark, d):
    return trades.footprint(T.tape(spark, d), DAY)


@query("""SELECT market, ts - ts % $D AS "window", count(*) AS n, true AS conserved FROM tape GROUP BY ALL""")
def footprint_conservation(spark, d):
    tape = T.tape(spark, d)
    return quality.conservation(trades.footprint(tape, DAY), tape, DAY)


@query("""SELECT l.w AS "window", l.p AS left_price, r.p AS right_price, round(l.p - r.p, 6) AS premium, round((l.p - r.p) / r.p * 10000, 2) AS premium_bps FROM
  (SELECT h AS w, arg_max(price, (ts, idx)) AS p FROM hours WHERE market = 'click' GROUP BY h) l JOIN (SELECT h AS w, arg_max(price, (ts, idx)) AS p FROM hours WHERE market = 'view' GROUP BY h) r USING (w)""")
def premium(spark, d):
    return trades.last_premium(T.tape(spark, d), HOUR, "click", "view")


@query("SELECT market, ts, round(notional, 6) AS notional, trades FROM bars ORDER BY notional DESC, market, ts LIMIT 12")
def top_seconds(spark, d):
    bars = trades.bars(T.tape(spark, d), HOUR).select("market", "ts", (F.col("buy_notional") + F.col("sell_notional")).alias("notional"), "trades")
    return bars.orderBy(F.desc("notional"), "market", "ts").limit(12)


@query("SELECT market, n, row_number() OVER (ORDER BY n DESC, market) AS rank FROM (SELECT market, count(*) AS n FROM tape GROUP BY market)")
def ranking(spark, d):
    from pyspark.sql import Window

    n = T.tape(spark, d).groupBy("market").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "market")))


@query("SELECT market, ts - ts % $D AS bucket, arg_max(close, ts) AS close, max(ts) AS ts FROM bars GROUP BY ALL")
def last_per_bucket(spark, d):
    bars = trades.bars(T.tape(spark, d), HOUR)
    return bars.groupBy("market", S.window_start(F.col("ts"), DAY).alias("bucket")).agg(F.max_by("close", "ts").alias("close"), F.max("ts").alias("ts"))


# --- bursts ---------------------------------------------------------------------------------------


@query('SELECT market, burst, side, start, "end", round(notional, 6) AS notional, prints, low, high, prices, duration, span_ticks FROM bursts')
def burst_list(spark, d):
    return bursts.bursts(T.tape(spark, d), GAP, CAP)


@query("""SELECT market, burst, run, any_value(price) AS price, min(ts) AS start, max(ts) AS "end", count(*) AS prints, round(sum(notional), 6) AS notional FROM (SELECT *, sum(c) OVER (PARTITION BY market, burst ORDER BY ts, idx) AS run FROM (
  SELECT *, CASE WHEN price = lag(price) OVER (PARTITION BY market, burst ORDER BY ts, idx) THEN 0 ELSE 1 END AS c FROM walk)) GROUP BY market, burst, run""")
def same_price_runs(spark, d):
    return bursts.same_price_runs(T.tape(spark, d), GAP, CAP)


@query("""SELECT d.market, d.ts, coalesce(n, 0) AS burst_count, round(coalesce(total, 0), 6) AS total, round(coalesce(largest, 0), 6) AS largest, coalesce(max_prints, 0) AS max_prints, coalesce(max_duration, 0) AS max_duration, round(coalesce(buy, 0), 6) AS buy, round(coalesce(sell, 0), 6) AS sell,
  coalesce(same_price, 0) AS same_price, coalesce(multilevel, 0) AS multilevel, coalesce(spp, 0) AS same_price_prints, round(coalesce(spn, 0), 6) AS same_price_notional, coalesce(mt, 0) AS multilevel_ticks, round(coalesce(mb, 0), 6) AS multilevel_bps, round(coalesce(mn, 0), 6) AS multilevel_notional,
  round((coalesce(buy, 0) - coalesce(sell, 0)) / (coalesce(buy, 0) + coalesce(sell, 0) + 1e-10), 6) AS imbalance, round(coalesce(largest / total, 0), 6) AS largest_share, round(CASE WHEN t30 > 0 THEN coalesce(total, 0) / t30 ELSE 0 END, 6) AS vs_trailing,
  round(coalesce(spn / total, 0), 6) AS absorption, round(coalesce(buy, 0) - coalesce(sell, 0), 6) AS delta, coalesce(largest > 5 * total / n, false) AS outlier
  FROM (SELECT market, ts, coalesce(sum(notional) OVER (PARTITION BY market ORDER BY ts ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0) AS t30 FROM dense) d LEFT JOIN (
    SELECT g.market, g.ts, count(*) AS n, sum(notional) AS total, max(notional) AS largest, max(prints) AS max_prints, max(duration) AS max_duration, coalesce(sum(notional) FILTER (side = 'buy'), 0) AS buy, coalesce(sum(notional) FILTER (side = 'sell'), 0) AS sell,
      count(*) FILTER (prices = 1) AS same_price, count(*) FILTER (prices > 1) AS multilevel, max(prints) FILTER (prices = 1) AS spp, coalesce(sum(notional) FILTER (prices = 1), 0) AS spn, max(span_ticks) FILTER (prices > 1) AS mt, max((high - low) / ((high + low) / 2) * 1e4) FILTER (prices > 1) AS mb, coalesce(sum(notional) FILTER (prices > 1), 0) AS mn
    FROM grid g JOIN bursts b ON b.market = g.market AND b.start < g.ts + $H AND b."end" >= g.ts GROUP BY ALL) s USING (market, ts)""")
def burst_features_1s(spark, d):
    return bursts.burst_features(T.tape(spark, d), HOUR, 30, GAP, CAP)


@query("""SELECT f.*, coalesce(b.bursts, 0) AS bursts, round(b.max_notional, 6) AS max_notional, b.max_ticks, coalesce(b.multilevel, 0) AS multilevel FROM (SELECT market, ts - ts % $D AS "window", arg_min(price, (ts, idx)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, idx)) AS close, sum(qty) AS volume,
  round(sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END), 6) AS delta, count(*) FILTER (k = 1) AS lone_prints, round(coalesce(sum(notional) FILTER (k > 1), 0), 6) AS burst_value FROM (SELECT *, count(*) OVER (PARTITION BY market, burst) AS k FROM walk) GROUP BY ALL) f
  LEFT JOIN (SELECT market, start - start % $D AS "window", count(*) AS bursts, max(notional) AS max_notional, max(span_ticks) AS max_ticks, count(*) FILTER (prices >= 2) AS multilevel FROM bursts GROUP BY ALL) b USING (market, "window")""")
def summary_30s(spark, d):
    return bursts.window_summary(T.tape(spark, d), DAY, GAP, CAP)


@query("""SELECT market, h AS ts, arg_max(side, (n, -run)) AS side, max(n) AS longest FROM (SELECT market, h, run, side, count(*) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY market, h ORDER BY ts, idx) AS run FROM (
  SELECT *, CASE WHEN side = lag(side) OVER (PARTITION BY market, h ORDER BY ts, idx) THEN 0 ELSE 1 END AS c FROM hours)) GROUP BY ALL) GROUP BY market, h""")
def side_runs(spark, d):
    return bursts.side_runs(T.tape(spark, d), HOUR)


# --- rollups --------------------------------------------------------------------------------------


def _dense_flow(spark, d):
    flow = trades.trade_flow(T.tape(spark, d), HOUR, LARGE).select("market", "ts", "open", "high", "low", "close", "trades", "qty", "notional", "signed_volume", "signed_notional", "large_notional", "max_notional")
    out = trades.dense_grid(T.tape(spark, d), HOUR).join(flow, ["market", "ts"], "left")
    return out.na.fill(0, ["trades", "qty", "notional", "signed_volume", "signed_notional", "large_notional"])


_DENSE = """, flow AS (SELECT market, h AS ts, arg_min(price, (ts, idx)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, idx)) AS close, count(*) AS trades, sum(qty) AS qty, sum(notional) AS notional, sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) AS signed_volume,
  sum(CASE WHEN side = 'buy' THEN notional ELSE -notional END) AS signed_notional, coalesce(sum(notional) FILTER (notional >= $L), 0) AS large_notional, max(notional) AS max_notional FROM hours GROUP BY market, h),
full1 AS (SELECT g.market, g.ts, open, high, low, close, coalesce(trades, 0) AS trades, coalesce(qty, 0) AS qty, coalesce(notional, 0) AS notional, coalesce(signed_volume, 0) AS signed_volume, coalesce(signed_notional, 0) AS signed_notional, coalesce(large_notional, 0) AS large_notional, max_notional FROM grid g LEFT JOIN flow USING (market, ts))"""


def _rolled_sql(source: str, width: str, into: str, need: int) -> str:
    return f"""SELECT market, ts - ts % ({into}) AS "window", true AS finalized, count(*) FILTER (trades > 0) AS filled, sum(trades)::BIGINT AS trades, sum(qty) AS qty, sum(notional) AS notional, sum(signed_volume) AS signed_volume, sum(signed_notional) AS signed_notional, sum(large_notional) AS large_notional,
  max(max_notional) AS max_notional, arg_min(open, ts) FILTER (open IS NOT NULL) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) FILTER (close IS NOT NULL) AS close FROM {source} GROUP BY ALL HAVING count(*) = {need}"""


def _out_sql(source: str, need: int) -> str:
    return f"""SELECT market, "window", finalized, filled, trades, qty, round(notional, 6) AS notional, signed_volume, round(signed_notional, 6) AS signed_notional, round(large_notional, 6) AS large_notional, round(max_notional, 6) AS max_notional, open, high, low, close,
  round(CASE WHEN qty > 0 THEN signed_volume / qty ELSE 0 END, 6) AS imbalance_qty, round(CASE WHEN notional > 0 THEN signed_notional / notional ELSE 0 END, 6) AS imbalance_notional, round(CASE WHEN notional > 0 THEN large_notional / notional ELSE 0 END, 6) AS large_share,
  round(CASE WHEN trades > 0 THEN notional / trades END, 6) AS mean_notional, round(filled / {need}, 6) AS coverage FROM {source}"""


@query(_DENSE + f", r AS ({_rolled_sql('full1', '$H', '30 * $H', 30)}) " + _out_sql("r", 30))
def rollup_30s(spark, d):
    return rollup.roll_up(_dense_flow(spark, d), HOUR, 30 * HOUR)


@query(_DENSE + f", r AS ({_rolled_sql('full1', '$H', '30 * $H', 30)}), r1 AS (SELECT * EXCLUDE (\"window\"), \"window\" AS ts FROM r), q AS ({_rolled_sql('r1', '30 * $H', '150 * $H', 5)}) " + _out_sql("q", 5))
def rollup_5m(spark, d):
    rows = rollup.roll_up(_dense_flow(spark, d), HOUR, 30 * HOUR).withColumnRenamed("window", "ts")
    return rollup.roll_up(rows, 30 * HOUR, 150 * HOUR)


@query("""SELECT market, "window", ['missing'] AS reasons FROM (SELECT market, ts - ts % (30 * $H) AS "window", count(*) AS n FROM bars GROUP BY ALL) WHERE n < 30""")
def rollup_rejects(spark, d):
    return rollup.rejected(trades.bars(T.tape(spark, d), HOUR).select("market", "ts"), HOUR, 30 * HOUR)


# --- book -----------------------------------------------------------------------------------------


def _state(spark, d):
    levels = T.book_levels(spark, d)
    return book.state_at(levels, book.anchor_range(levels, WEEK), WEEK)


@query("SELECT market, anchor, side, price, qty FROM state")
def book_state_at(spark, d):
    return _state(spark, d)


@query("""SELECT market, anchor, len(b) > 0 AND len(a) > 0 AS seeded, coalesce(len(b) > 0 AND len(a) > 0 AND b[1].price >= a[1].price, false) AS crossed, list_transform(b, lambda x: x.price) AS bid_prices, list_transform(b, lambda x: x.qty) AS bid_qtys, list_transform(a, lambda x: x.price) AS ask_prices, list_transform(a, lambda x: x.qty) AS ask_qtys FROM (
  SELECT market, anchor, coalesce(list({'price': price, 'qty': qty} ORDER BY price DESC) FILTER (side = 'bid'), []) AS b, coalesce(list({'price': price, 'qty': qty} ORDER BY price) FILTER (side = 'ask'), []) AS a FROM state GROUP BY ALL)""")
def book_snapshots(spark, d):
    return book.snapshots(_state(spark, d))


@query("""SELECT q.market, q.anchor, q.best_bid, q.bid_qty, q.best_ask, q.ask_qty, q.mid, bn AS bid_near, an AS ask_near, bf AS bid_far, af AS ask_far, round(q.spread_bps, 6) AS spread_bps, round((best_ask * bid_qty + best_bid * ask_qty) / (bid_qty + ask_qty), 6) AS microprice,
  round(CASE WHEN bn + an > 0 THEN (bn - an) / (bn + an) END, 6) AS imbalance_near, round(CASE WHEN bf + af > 0 THEN (bf - af) / (bf + af) END, 6) AS imbalance_far, q.top_depth FROM quotes q JOIN (
  SELECT s.market, s.anchor, coalesce(sum(price * qty) FILTER (side = 'bid' AND abs(price - mid) <= 10), 0) AS bn, coalesce(sum(price * qty) FILTER (side = 'ask' AND abs(price - mid) <= 10), 0) AS an, coalesce(sum(price * qty) FILTER (side = 'bid' AND abs(price - mid) <= 30), 0) AS bf,
    coalesce(sum(price * qty) FILTER (side = 'ask' AND abs(price - mid) <= 30), 0) AS af FROM state s JOIN quotes USING (market, anchor) GROUP BY ALL) x USING (market, anchor)""")
def book_features(spark, d):
    return book.features(_state(spark, d), 10.0, 30.0)


@query("SELECT market, anchor, side, bin, qty FROM bins")
def binned_book(spark, d):
    return book.binned(_state(spark, d), 1.0, 20.0)


@query("""SELECT market, anchor, coalesce(list(bin ORDER BY bin) FILTER (side = 'bid'), []) AS bid_prices, coalesce(list(qty ORDER BY bin) FILTER (side = 'bid'), []) AS bid_qtys, coalesce(list(bin ORDER BY bin) FILTER (side = 'ask'), []) AS ask_prices, coalesce(list(qty ORDER BY bin) FILTER (side = 'ask'), []) AS ask_qtys FROM bins GROUP BY ALL""")
def heatmap_rows(spark, d):
    return book.heatmap_rows(_state(spark, d), 20.0)


@query("SELECT market, anchor, side, price, qty, level FROM (SELECT *, row_number() OVER (PARTITION BY market, anchor, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS level FROM state) WHERE level <= 3")
def top_levels(spark, d):
    return book.top_levels(_state(spark, d), 3)


@query("""SELECT market, anchor, round(b / (a + b) * 100, 6) AS bid_pct, round(a / (a + b) * 100, 6) AS ask_pct FROM (SELECT market, anchor, coalesce(sum(qty) FILTER (side = 'bid'), 0) AS b, coalesce(sum(qty) FILTER (side = 'ask'), 0) AS a FROM state GROUP BY ALL)""")
def pressure(spark, d):
    return book.pressure(_state(spark, d))


@query("SELECT market, side, round(quantile_cont(qty, 0.85), 6) AS p85, round(quantile_cont(qty, 0.95), 6) AS p95, round(quantile_cont(qty, 0.97), 6) AS p97, round(quantile_cont(qty, 0.99), 6) AS p99 FROM state GROUP BY ALL")
def depth_percentiles(spark, d):
    return _state(spark, d).groupBy("market", "side").agg(*(F.percentile("qty", F.lit(p / 100)).alias(f"p{p}") for p in (85, 95, 97, 99)))


@query("""SELECT market, ts - ts % $W AS "window", side, sum(greatest(delta, 0)) AS added, sum(greatest(-delta, 0)) AS cancelled FROM (SELECT *, qty - coalesce(lag(qty) OVER (PARTITION BY market, side, price ORDER BY ord), 0) AS delta FROM levels) GROUP BY ALL""")
def book_level_flow(spark, d):
    return book.level_flow(T.book_levels(spark, d), WEEK)


@query("""SELECT market, anchor, CASE WHEN best_bid >= pb THEN bid_qty - pbq ELSE 0 END - CASE WHEN best_ask <= pa THEN ask_qty - paq ELSE 0 END AS ofi, greatest(bid_qty - pbq, 0) + greatest(ask_qty - paq, 0) AS replenished, greatest(pbq - bid_qty, 0) + greatest(paq - ask_qty, 0) AS pulled,
  round(spread_bps - ps, 6) AS spread_delta, round(top_depth - pt, 6) AS depth_delta FROM (SELECT *, lag(best_bid) OVER w AS pb, lag(bid_qty) OVER w AS pbq, lag(best_ask) OVER w AS pa, lag(ask_qty) OVER w AS paq, lag(spread_bps) OVER w AS ps, lag(top_depth) OVER w AS pt FROM quotes WINDOW w AS (PARTITION BY market ORDER BY anchor)) WHERE pb IS NOT NULL""")
def best_quote_flow(spark, d):
    return book.best_flow(_state(spark, d))


def _quotes(spark, d):
    """Hourly quotes around each market's last price, so that trades have a book to meet."""
    b = trades.bars(T.tape(spark, d), HOUR)
    return b.select("market", (F.col("ts") + HOUR).alias("ts"), F.round(F.col("close") - 1, 2).alias("best_bid"), F.col("buy_qty").alias("bid_qty"), F.round(F.col("close") + 1, 2).alias("best_ask"), F.col("sell_qty").alias("ask_qty"))


@query("""SELECT market, "window", trades, CASE WHEN seen THEN at_touch END AS at_touch, CASE WHEN seen THEN "through" END AS "through", round(CASE WHEN seen THEN slippage END, 6) AS slippage_bps, round(CASE WHEN seen THEN over_top END, 6) AS over_top FROM (
  SELECT market, ts - ts % $D AS "window", count(*) AS trades, bool_and(q_ts IS NOT NULL) AS seen, sum(CASE WHEN price = touch THEN qty ELSE 0 END) AS at_touch, sum(CASE WHEN (side = 'buy' AND price > touch) OR (side = 'sell' AND price < touch) THEN qty ELSE 0 END) AS "through",
    avg(CASE WHEN (bb + ba) / 2 > 0 THEN CASE WHEN side = 'buy' THEN price - touch ELSE touch - price END / ((bb + ba) / 2) * 1e4 END) AS slippage, sum(CASE WHEN top > 0 THEN qty / top ELSE 0 END) AS over_top FROM (
    SELECT t.*, q.ts AS q_ts, q.bb, q.ba, CASE WHEN t.side = 'buy' THEN q.ba ELSE q.bb END AS touch, CASE WHEN t.side = 'buy' THEN q.aq ELSE q.bq END AS top FROM tape t ASOF LEFT JOIN (
      SELECT market, ts + $H AS ts, round(close - 1, 2) AS bb, buy_qty AS bq, round(close + 1, 2) AS ba, sell_qty AS aq FROM bars) q ON t.market = q.market AND t.ts > q.ts) GROUP BY ALL)""")
def trade_book_interaction(spark, d):
    return book.trade_interaction(T.tape(spark, d), _quotes(spark, d), DAY)


# --- open interest and joins ----------------------------------------------------------------------

_OI = """SELECT o_orderkey AS idx, CASE o_custkey % 4 WHEN 0 THEN 'binance_perp' WHEN 1 THEN 'bitmex_perp' WHEN 2 THEN 'okx_perp' ELSE 'unknown' END AS market, (epoch_us(o_orderdate) // 1000) AS as_of_ms,
  CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_totalprice END AS native, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice / 100 END AS btc, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice * 400 WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS usd, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 40000.0 END AS price_usd FROM orders"""
_NOW = "(SELECT max((epoch_us(o_orderdate) // 1000)) FROM orders)"


@query(f""", s AS ({_OI}), k AS (SELECT *, {_NOW} - as_of_ms AS age FROM s), e AS (SELECT *, CASE WHEN market = 'unknown' THEN 'oi_not_supported' WHEN native < 0 THEN 'invalid_open_interest' WHEN btc IS NOT NULL AND usd IS NOT NULL AND price_usd > 0 AND abs(btc * price_usd - usd) / greatest(abs(usd), 1e-9) > 0.01 THEN 'oi_mismatch'
  WHEN (btc IS NULL OR usd IS NULL) AND price_usd IS NULL THEN 'missing_price' WHEN btc IS NULL AND usd IS NULL AND market = 'okx_perp' THEN 'unsupported_native_unit' END AS error_code FROM k)
SELECT idx, market, as_of_ms, error_code, CASE WHEN error_code IS NULL THEN age END AS age_ms,
  round(CASE WHEN error_code IS NULL THEN coalesce(btc, usd / price_usd, CASE WHEN market = 'binance_perp' THEN native ELSE native / price_usd END) END, 6) AS oi_btc,
  round(CASE WHEN error_code IS NULL THEN coalesce(usd, btc * price_usd, CASE WHEN market = 'binance_perp' THEN native * price_usd ELSE native END) END, 6) AS oi_usd,
  CASE WHEN error_code IS NOT NULL THEN 'error' WHEN age <= 365::BIGINT * $D THEN 'fresh' ELSE 'stale' END AS status FROM e""")
def oi_normalize(spark, d):
    o, key, price = T.table(spark, d, "orders"), F.col("o_orderkey"), F.col("o_totalprice")
    c = F.col("o_custkey") % 4
    rows = o.select(
        key.alias("idx"), F.when(c == 0, "binance_perp").when(c == 1, "bitmex_perp").when(c == 2, "okx_perp").otherwise("unknown").alias("market"), T.millis(F.col("o_orderdate")).alias("as_of_ms"),
        F.when(key % 7 == 0, -1.0).otherwise(price).alias("native"), F.when(key % 5 == 0, price / 100).alias("btc"), F.when(key % 10 == 0, price * 400).when(key % 3 == 0, price).alias("usd"), F.when(key % 11 != 0, F.lit(40000.0)).alias("price_usd"),
    )
    now = o.agg(F.max(T.millis(F.col("o_orderdate"))).alias("now"))
    out = open_interest.normalized(rows.join(F.broadcast(now)), F.col("now"), max_age=365 * DAY)
    return out.select("idx", "market", "as_of_ms", "error_code", "age_ms", "oi_btc", "oi_usd", "status")


@query("""SELECT a.market, a.ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, s.ts AS sample_ts, CASE WHEN a.ts - s.ts <= 2 * $D THEN s.oi END AS oi, a.ts - s.ts AS age, CASE WHEN s.ts IS NULL THEN 'none' WHEN a.ts - s.ts > 2 * $D THEN 'stale' ELSE 'fresh' END AS status
  FROM (SELECT l_suppkey % 20 AS market, (epoch_us(l_shipdate) // 1000) AS ts, * FROM lineitem) a ASOF LEFT JOIN (SELECT o_custkey % 20 AS market, (epoch_us(o_orderdate) // 1000) AS ts, arg_max(o_totalprice, o_orderkey) AS oi FROM orders GROUP BY 1, 2) s ON a.market = s.market AND a.ts >= s.ts""")
def oi_asof(spark, d):
    out = open_interest.at_anchors(T.oi_anchors(spark, d), T.oi_samples(spark, d), 2 * DAY)
    return out.select("market", "ts", "anchor.*", "sample_ts", "oi", "age", "status")


@query(""", two AS (SELECT min(b) AS t FROM ends), marks AS (SELECT market, unnest([t - $W, t]) AS anchor FROM ends, two),
pair AS MATERIALIZED (SELECT market, anchor, side, price, qty FROM (SELECT m.market, m.anchor, l.side, l.price, arg_max(l.qty, l.ord) AS qty FROM marks m JOIN ends e ON e.market = m.market AND m.anchor BETWEEN e.a AND e.b JOIN levels l ON l.market = m.market AND l.ts < m.anchor GROUP BY ALL) WHERE qty > 0)
SELECT market, side, price, coalesce(n.qty, 0) AS qty FROM (SELECT p.* FROM pair p, two WHERE anchor = t - $W) o FULL JOIN (SELECT p.* FROM pair p, two WHERE anchor = t) n USING (market, side, price) WHERE o.qty IS DISTINCT FROM n.qty""")
def snapshot_diff(spark, d):
    levels = T.book_levels(spark, d)
    ends = book.anchor_range(levels, WEEK)
    ends = ends.join(F.broadcast(ends.agg(F.min("last").alias("l"))))
    two = ends.select("market", F.greatest("first", F.col("l") - WEEK).alias("first"), F.col("l").alias("last"), "l")
    marked = book.state_at(levels, two.drop("l"), WEEK).join(F.broadcast(two.select("market", "l")), "market")
    pick = lambda t: marked.where(F.col("anchor") == t).select("market", "side", "price", "qty")
    return asof.snapshot_diff(pick(F.col("l") - WEEK), pick(F.col("l")), ["market", "side", "price"], "qty")


@query("""SELECT p.idx, p.market, p.ts, arg_min(i.id, (i.hi - i.lo, i.id)) AS interval_id FROM tape p LEFT JOIN (SELECT market, burst AS id, start AS lo, "end" + $H AS hi FROM bursts) i ON i.market = p.market AND p.ts BETWEEN i.lo AND i.hi GROUP BY p.idx, p.market, p.ts""")
def late_to_batch(spark, d):
    tape = T.tape(spark, d)
    batches = bursts.bursts(tape, GAP, CAP).select("market", F.col("burst").cast("long").alias("interval_id"), F.col("start").alias("lo"), (F.col("end") + HOUR).alias("hi"))
    return asof.narrowest_interval(tape.select("idx", "market", "ts"), batches, ["market"], HOUR)


@query("""SELECT market, side, price, min(idx) AS idx FROM tape WHERE ts - ts % $D > (SELECT min(ts) FROM tape) + 10 * $D AND (market, side, price) NOT IN (SELECT (market, side, price) FROM tape WHERE ts - ts % $D <= (SELECT min(ts) FROM tape) + 10 * $D) GROUP BY ALL""")
def dedupe_fresh(spark, d):
    tape = T.tape(spark, d)
    rows = tape.withColumn("day", S.window_start(F.col("ts"), DAY)).join(F.broadcast(tape.agg(F.min("ts").alias("t0"))))
    old, new = rows.where(F.col("day") <= F.col("t0") + 10 * DAY), rows.where(F.col("day") > F.col("t0") + 10 * DAY)
    keys = ["market", "side", "price"]
    return asof.keep_first(asof.fresh_only(new.select(*keys, "idx"), old, keys), keys, ["idx"])


@query("SELECT market, h, arg_min(idx, (ts, idx)) AS idx, arg_min(price, (ts, idx)) AS price, min(ts) AS ts FROM hours GROUP BY market, h")
def dedupe_keep_first(spark, d):
    rows = T.tape(spark, d).withColumn("h", S.window_start(F.col("ts"), HOUR)).select("market", "h", "idx", "price", "ts")
    return asof.keep_first(rows, ["market", "h"], ["ts", "idx"])


# --- quality --------------------------------------------------------------------------------------


@query("SELECT market, count(*) AS n, count(*) FILTER (s > 1) AS gaps, count(*) FILTER (s <= 0) AS repeats FROM (SELECT *, idx - lag(idx) OVER (PARTITION BY market ORDER BY idx) AS s FROM raw) GROUP BY market")
def sequence_gaps(spark, d):
    return quality.sequence_gaps(T.raw_tape(spark, d), "market", "idx", "idx")


@query("""SELECT s.market, s.p + u.step AS gap_start, s.ts AS gap_end FROM (SELECT market, ts, lag(ts) OVER (PARTITION BY market ORDER BY ts) AS p FROM (SELECT DISTINCT market, ts FROM tape)) s JOIN (
  SELECT market, quantile_disc(ts - p, 0.5) AS step FROM (SELECT market, ts, lag(ts) OVER (PARTITION BY market ORDER BY ts) AS p FROM (SELECT DISTINCT market, ts FROM tape)) WHERE p IS NOT NULL GROUP BY market) u USING (market) WHERE s.ts - s.p > 1.75 * u.step""")
def time_gaps(spark, d):
    return quality.time_gaps(T.tape(spark, d))


@query("SELECT o_orderstatus, count(*) AS n, count(*) FILTER (b) AS inversions FROM (SELECT *, o_orderdate < lag(o_orderdate) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS b FROM orders) GROUP BY 1")
def inversions(spark, d):
    o = T.table(spark, d, "orders").select("o_orderstatus", "o_orderkey", T.millis(F.col("o_orderdate")).alias("ts"))
    return quality.inversions(o, "o_orderstatus", "o_orderkey")


@query("""SELECT market, sum(n)::BIGINT AS rows, min(ts) AS first, max(ts) AS last, count(*) FILTER (n > 1) AS repeated, count(*) FILTER (g > $H) AS gaps FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY market ORDER BY ts) AS g FROM (SELECT market, ts, count(*) AS n FROM raw GROUP BY ALL)) GROUP BY market""")
def audit(spark, d):
    return quality.audit(T.raw_tape(spark, d), HOUR)


@query("SELECT h AS ts, count(DISTINCT market) AS markets FROM hours GROUP BY h HAVING count(DISTINCT market) > 1")
def shared_times(spark, d):
    return quality.shared_times(T.tape(spark, d).withColumn("ts", S.window_start(F.col("ts"), HOUR)))


@query("SELECT market, count(*) AS n, coalesce(round(sum(notional), 6), 0) AS notional, min(ts) AS first, max(ts) AS last FROM tape GROUP BY market ORDER BY market")
def stream_stats(spark, d):
    return T.tape(spark, d).groupBy("market").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("price") * F.col("qty")), F.lit(0.0)).alias("notional"), F.min("ts").alias("first"), F.max("ts").alias("last")).orderBy("market")


@query("SELECT count(*) AS n, count(DISTINCT ts) AS times, min(ts) AS first, max(ts) AS last, round(sum(notional), 6) AS notional, round(avg(price), 2) AS mean_price FROM tape")
def global_check(spark, d):
    return T.tape(spark, d).agg(F.count("*").alias("n"), F.count_distinct("ts").alias("times"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.sum(F.col("price") * F.col("qty")).alias("notional"), F.round(F.avg("price"), 2).alias("mean_price"))


@query("""SELECT o_orderpriority AS market, o_orderkey // 1000 AS block, count(*) AS lines, sha256(string_agg(o_orderkey::VARCHAR || '|' || o_custkey::VARCHAR || '|' || o_orderstatus, chr(10) ORDER BY o_orderkey)) AS sha256 FROM orders GROUP BY ALL""")
def archive_roundtrip(spark, d):
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    return quality.archive_proof(T.table(spark, d, "orders").select(F.col("o_orderpriority").alias("market"), F.col("o_orderkey").alias("id"), line.alias("line")))


@query("SELECT bool_and(n > 100 AND e = 0) AS data_complete FROM (SELECT market, count(*) AS n, count(*) FILTER (qty IS NULL) AS e FROM raw WHERE market IN ('click', 'view') GROUP BY market)")
def data_complete(spark, d):
    s = T.raw_tape(spark, d).groupBy("market").agg(F.count("*").alias("n"), F.count_if(F.col("qty").isNull()).alias("e"))
    status = s.select("market", F.when(F.col("n") > 100, "running").otherwise("stopped").alias("state"), (F.col("e") > 0).alias("degraded"))
    return quality.complete(status, ["click", "view"])


@query("""SELECT market, ts - ts % $D AS "window", count(*) AS n, max(idx) - min(idx) AS delta FROM tape GROUP BY ALL HAVING count(*) >= 2""")
def counter_deltas(spark, d):
    return quality.counter_deltas(T.tape(spark, d).withColumn("counter", F.col("idx")), DAY)


@query("""SELECT market, round((arg_max(idx, (ts, idx)) - arg_min(idx, (ts, idx))) / ((max(ts) - min(ts)) / 1000), 6) AS rate FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY ts DESC, idx DESC) AS k FROM tape) WHERE k <= 50 GROUP BY market""")
def rates(spark, d):
    return quality.rates(T.tape(spark, d).withColumn("counter", F.col("idx")), 50)


# --- displays and monitors ------------------------------------------------------------------------


@query("SELECT market, floor((a - greatest((b - a) * 0.1, 5)) / 5) * 5 AS lower, ceil((b + greatest((b - a) * 0.1, 5)) / 5) * 5 AS upper FROM (SELECT market, min(price) AS a, max(price) AS b FROM tape GROUP BY market)")
def price_bounds(spark, d):
    return display.price_bounds(T.tape(spark, d), 5.0)


@query("""SELECT market, anchor, side, floor(price / 20) * 20 AS bin, least(sum(qty), 200) AS qty, count(*) AS levels, sum(qty) > 200 AS clipped FROM state GROUP BY market, anchor, side, floor(price / 20) * 20""")
def display_grid(spark, d):
    return display.display_grid(_state(spark, d), 20.0, 200.0)


@query(""", c AS (SELECT market, side, price AS bin, sum(qty) AS qty FROM state GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY market, side ORDER BY qty DESC, bin) AS n FROM c),
pick AS (SELECT market, side, 0::BIGINT AS n, []::DOUBLE[] AS bins, []::DOUBLE[] AS qtys FROM o GROUP BY ALL
  UNION ALL SELECT p.market, p.side, o.n, CASE WHEN len(bins) < 4 AND len(list_filter(bins, lambda b: abs(b - o.bin) < 3)) = 0 THEN list_append(bins, o.bin) ELSE bins END, CASE WHEN len(bins) < 4 AND len(list_filter(bins, lambda b: abs(b - o.bin) < 3)) = 0 THEN list_append(qtys, o.qty) ELSE qtys END
  FROM pick p JOIN o ON o.market = p.market AND o.side = p.side AND o.n = p.n + 1),
fin AS (SELECT market, side, arg_max(bins, n) AS bins, arg_max(qtys, n) AS qtys FROM pick GROUP BY market, side)
SELECT market, side, unnest(generate_series(1, len(bins)))::INTEGER AS rank, unnest(bins) AS bin, unnest(qtys) AS qty FROM fin""")
def separated_peaks(spark, d):
    cells = _state(spark, d).groupBy("market", "side", F.col("price").alias("bin")).agg(F.sum("qty").alias("qty"))
    return display.separated_peaks(cells, ["market", "side"], 1.0)


@query("""SELECT market, session, min(ts) AS first, max(ts) AS last, count(*) AS n FROM (SELECT market, ts, sum(c) OVER (PARTITION BY market ORDER BY ts) AS session FROM (SELECT market, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY market ORDER BY ts) <= $H THEN 0 ELSE 1 END AS c FROM tape)) GROUP BY ALL""")
def session_groups(spark, d):
    return display.sessions(T.tape(spark, d), HOUR)


@query("""SELECT market, ts, round(mean, 6) AS mean, greatest(abs(hi - mean), abs(lo - mean)) > 0.5 * mean AS outlier FROM (SELECT market, ts, lo, hi, sum(s) OVER w / sum(n) OVER w AS mean FROM (SELECT market, h AS ts, sum(price) AS s, count(*) AS n, min(price) AS lo, max(price) AS hi FROM hours GROUP BY market, h)
  WINDOW w AS (PARTITION BY market ORDER BY ts RANGE BETWEEN 30 * $H PRECEDING AND $H PRECEDING)) WHERE mean IS NOT NULL""")
def price_outliers(spark, d):
    return display.price_outliers(T.tape(spark, d), HOUR, 30, 0.5)


@query("""SELECT market, ts, round((mid - b) / b * 1e4, 6) AS move_bps FROM (SELECT market, anchor AS ts, mid, last_value(mid) OVER (PARTITION BY market ORDER BY anchor RANGE BETWEEN UNBOUNDED PRECEDING AND 2 * $W PRECEDING) AS b FROM quotes) WHERE b IS NOT NULL""")
def mid_moves(spark, d):
    return display.mid_moves(book.features(_state(spark, d)).select("market", F.col("anchor").alias("ts"), "mid"), 2 * WEEK)


@query("""SELECT market, idx, seq, CASE WHEN last IS NULL THEN 'unverifiable' WHEN seq <= last THEN 'duplicate' WHEN seq_start <= last + 1 THEN 'ok' ELSE 'gap' END AS verdict FROM (SELECT *, max(seq) OVER (PARTITION BY market ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM (
  SELECT market, idx, idx - idx % 3 AS seq, idx - 8 AS seq_start FROM tape))""")
def sequence_verdicts(spark, d):
    events = T.tape(spark, d).select("market", "idx", (F.col("idx") - F.col("idx") % 3).alias("seq"), (F.col("idx") - 8).alias("seq_start"), F.lit(None).cast("long").alias("prev_seq"))
    return display.sequence_verdicts(events).select("market", "idx", "seq", "verdict")


@query("""SELECT market, idx, ts, greatest(ts, coalesce(max(CASE WHEN idx % 10 = 0 THEN ts + 5 * $H END) OVER (PARTITION BY market ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ts)) AS effective_ts FROM tape""")
def snapshot_reorder(spark, d):
    rows = T.tape(spark, d).select("market", "idx", "ts", F.when(F.col("idx") % 10 == 0, "snapshot").otherwise("update").alias("type"))
    shifted = rows.withColumn("real", F.col("ts")).withColumn("ts", F.when(F.col("type") == "snapshot", F.col("ts") + 5 * HOUR).otherwise(F.col("ts")))
    return display.lifted_after_snapshot(shifted).select("market", "idx", F.col("real").alias("ts"), "effective_ts")


@query("""SELECT market, side AS channel, max((SELECT max(ts) FROM tape)) - max(ts) AS age, max((SELECT max(ts) FROM tape)) - max(ts) > CASE WHEN side = 'buy' THEN $H ELSE 2 * $H END AS silent FROM tape GROUP BY market, side""")
def channel_silence(spark, d):
    tape = T.tape(spark, d)
    return display.silence(tape.select("market", F.col("side").alias("channel"), "ts"), {"buy": HOUR}, 2 * HOUR)


from . import features  # noqa: E402,F401  registers its queries
