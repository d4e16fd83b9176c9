"""Hand-made rows with exact expectations, and differential tests against direct loops."""

import random

import pytest
from pyspark.sql import functions as F

from brontide.functions import scalars as S
from brontide.operators import asof, book, bursts, open_interest, quality, rollup, trades


def tape(spark, rows):
    return spark.createDataFrame([(m, ts, s, float(p), float(q), i) for i, (m, ts, s, p, q) in enumerate(rows)], "market string, ts long, side string, price double, qty double, idx long")


def test_one_burst_of_four_prints(spark):
    t = tape(spark, [("m", 500, "buy", 100, 1), ("m", 520, "buy", 100, 2), ("m", 540, "buy", 100, 1), ("m", 560, "buy", 100, 1)])
    (b,) = bursts.bursts(t).collect()
    assert (b.notional, b.prints, b.duration, b.prices, b.span_ticks) == (500.0, 4, 60, 1, 0)


def test_gap_makes_two_bursts(spark):
    assert bursts.bursts(tape(spark, [("m", 29_900, "buy", 100, 1), ("m", 30_100, "buy", 100, 1)])).count() == 2


def test_bursts_equal_a_direct_loop(spark):
    rnd, rows, ts = random.Random(3), [], 0
    for _ in range(800):
        ts += rnd.choice([0, 1, 5, 20, 49, 50, 51, 90])
        rows.append(("m", ts, rnd.choice(["buy", "buy", "buy", "sell"]), rnd.randint(99, 102), 1))
    want, start, last = [], None, None
    for _, t, side, *_ in rows:
        if last is None or side != last[1] or t - last[0] > 50 or t - start > 300:
            start = t
            want.append((t, side))
        last = (t, side)
    got = [(r.start, r.side) for r in bursts.bursts(tape(spark, rows), 50, 300).orderBy("burst").collect()]
    assert got == want


def test_size_classes_and_units(spark):
    r = spark.range(1).select(S.size_class(F.lit(999.99)), S.size_class(F.lit(1000.0)), S.size_class(F.lit(10_000.0)), S.epoch_ms(F.lit(1_700_000_000)), S.epoch_ms(F.lit(1_700_000_000_500_000))).first()
    assert tuple(r) == ("small", "medium", "large", 1_700_000_000_000, 1_700_000_000_500)


def test_book_quantities(spark):
    q = lambda m, p, x: spark.range(1).select(S.btc_quantity(F.lit(m), F.lit(p), F.lit(x))).first()[0]
    assert q("okx_perp", "100", "5") == 0.05 and q("bitmex_perp", "50000", "100") == 0.002 and q("binance_spot", "1", "") == 0.0
    assert q("nowhere", "1", "1") is None and q("binance_spot", "1", "-1") is None


def test_intervals():
    assert S.interval_ms("5m") == 300_000 and S.interval_name(3_600_000) == "1h"
    with pytest.raises(ValueError):
        S.interval_ms("5w")


def test_as_of_is_strict_or_inclusive(spark):
    a = spark.createDataFrame([("m", 10, 1), ("m", 5, 2)], "market string, ts long, k int")
    s = spark.createDataFrame([("m", 5, 1.0, 1), ("m", 10, 2.0, 2), ("m", 10, 3.0, 3)], "market string, ts long, v double, n long")
    got = lambda strict: {r.k: r.v for r in asof.as_of(a, s, ["market"], ["v"], "n", strict).collect()}
    assert got(False) == {1: 3.0, 2: 1.0} and got(True) == {1: 1.0, 2: None}


def test_book_state_equals_replay(spark):
    rnd = random.Random(5)
    events = [("m", rnd.choice(["bid", "ask"]), float(rnd.randint(1, 9)), float(rnd.choice([0, 1, 2, 3])), rnd.randint(0, 90), i) for i in range(300)]
    changes = spark.createDataFrame(events, "market string, side string, price double, qty double, ts long, n long").withColumn("ord", F.struct("ts", "n"))
    got = {(r.anchor, r.side, r.price): r.qty for r in book.state_at(changes, book.anchor_range(changes, 10), 10).collect()}
    want = {}
    for anchor in range(10, 101, 10):
        state = {}
        for _, side, p, q, ts, n in sorted(events, key=lambda e: (e[4], e[5])):
            if ts < anchor:
                state[side, p] = q
        want |= {(anchor, s, p): q for (s, p), q in state.items() if q > 0}
    assert got == {k: v for k, v in want.items() if k[0] >= min(a for a, *_ in got)} and len(got) > 50


def test_heatmap_buckets_and_limit(spark):
    s = spark.createDataFrame([("m", 0, "bid", 99.2, 0.1), ("m", 0, "bid", 99.7, 0.2), ("m", 0, "ask", 101.0, 1.0), ("m", 0, "bid", 10.0, 5.0)], "market string, anchor long, side string, price double, qty double")
    r = book.heatmap_rows(s, 50.0).first()
    assert (r.bid_prices, r.bid_qtys, r.ask_prices) == ([99.0], [0.3], [101.0])


def test_rollup_needs_every_window_once(spark):
    rows = [("m", t, 1, 2.0, 10.0, 1.0, 5.0, 0.0) for t in range(0, 30_000, 1000)]
    schema = "market string, ts long, trades long, qty double, notional double, signed_volume double, signed_notional double, large_notional double"
    full = rollup.roll_up(spark.createDataFrame(rows, schema), 1000, 30_000).first()
    assert (full.trades, full.notional, full.imbalance_qty, full.mean_notional) == (30, 300.0, 0.5, 10.0)
    assert rollup.roll_up(spark.createDataFrame(rows[1:], schema), 1000, 30_000).isEmpty()
    twice = spark.createDataFrame([*rows[1:], rows[1]], schema)
    assert rollup.roll_up(twice, 1000, 30_000).isEmpty() and rollup.rejected(twice, 1000, 30_000).first().reasons == ["missing", "duplicate"]


@pytest.mark.parametrize(
    ("market", "native", "price", "lead", "want"),
    [("binance_perp", "2.5", "40000", 0, (2.5, 100_000.0, "fresh", None)), ("bitmex_perp", "100", "40000", 0, (0.0025, 100.0, "fresh", None)), ("binance_perp", "1", "1", 85, (1.0, 1.0, "fresh", None)),
     ("binance_perp", "1", "1", 2_001, (None, None, "error", "future_sample")), ("binance_spot", "1", "1", 0, (None, None, "error", "oi_not_supported")), ("okx_perp", "5", "40000", 0, (None, None, "error", "unsupported_native_unit"))],
)
def test_open_interest(spark, market, native, price, lead, want):
    rows = spark.createDataFrame([(market, 1_000_000 + lead, native, None, None, price)], "market string, as_of_ms long, native string, btc string, usd string, price_usd string")
    r = open_interest.normalized(rows, F.lit(1_000_000)).first()
    assert (r.oi_btc, r.oi_usd, r.status, r.error_code) == want


def test_no_look_ahead_in_volatility_and_trailing_sums(spark):
    t = tape(spark, [("m", 0, "buy", 100, 1), ("m", 500, "buy", 110, 1), ("m", 900, "buy", 100, 1), ("m", 1500, "buy", 500, 1), ("m", 2500, "buy", 1, 1)])
    v = {r.ts: r.returns for r in trades.realized_volatility(t, 1000, 10).collect()}
    assert v[1000] == 2 and v[2000] == 3
    assert {r.ts: r.trailing for r in trades.trailing_notional(t, 1000, 1).collect()} == {0: 0.0, 1000: 310.0, 2000: 500.0}


def test_completeness_and_conservation(spark):
    s = spark.createDataFrame([("a", "running", False), ("b", "running", True)], "market string, state string, degraded boolean")
    assert [quality.complete(s, r).first()[0] for r in (["a"], ["a", "b"], ["a", "z"], [])] == [True, False, False, True]
    t = tape(spark, [("m", 1, "buy", 10.5, 2), ("m", 2, "sell", 11.5, 1)])
    assert quality.conservation(trades.footprint(t, 1000), t, 1000).first().conserved


def test_empty_tables(spark):
    none = spark.createDataFrame([], "market string, ts long, side string, price double, qty double, idx long")
    for f in (trades.bars, trades.trade_flow, trades.realized_volatility, bursts.bursts, bursts.burst_features, bursts.side_runs, trades.footprint):
        assert f(none).isEmpty()
