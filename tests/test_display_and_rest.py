import json

from pyspark.sql import functions as F

from brontide.operators import display
from brontide.sources import rest


def test_price_step_is_the_first_that_fits(spark):
    got = spark.range(1).select(*(display.price_step(F.lit(float(x))) for x in (100, 261, 1000, 1e9))).first()
    assert tuple(got) == (1.0, 2.0, 5.0, 500.0)


def test_canonical_books(spark):
    schema = "market string, type string, ts double, seq long, bids array<struct<price:string,qty:string>>, asks array<struct<price:string,qty:string>>"
    rows = [
        ("kraken_spot", "update", 10.7, 5, [("1", "")], []), ("coinbase_spot", "snapshot", 10.0, 0, [("1", "2")], []), ("binance_spot", "update", 10.0, 7, [("1", "-2")], None), ("", "other", None, 1, [("x", "1")], []),
    ]
    got = [(r.event_ts_ms, r.seq, r.errors, r.valid) for r in display.canonical_book(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(10, None, [], True), (10, None, [], True), (10, 7, ["bids", "asks"], False), (None, 1, ["market", "type", "ts", "bids"], False)]
    assert display.canonical_book(spark.createDataFrame(rows, schema)).first().bids[0].qty == "0"


def test_sequence_verdicts(spark):
    rows = [("m", 0, 10, None, None), ("m", 1, 11, None, 10), ("m", 2, 11, None, 10), ("m", 3, 15, 12, None), ("m", 4, 20, 17, None), ("m", 5, 21, None, None), ("m", 6, None, None, None)]
    got = [r.verdict for r in display.sequence_verdicts(spark.createDataFrame(rows, "market string, idx long, seq long, seq_start long, prev_seq long")).orderBy("idx").collect()]
    assert got == ["unverifiable", "ok", "duplicate", "ok", "gap", "ok", "unverifiable"]


def test_rest_replies(spark):
    df = lambda rows: spark.createDataFrame([(m, json.dumps(b)) for m, b in rows], "market string, body string")
    seeds = {r.market: (tuple(map(tuple, r.bids)), tuple(map(tuple, r.asks))) for r in rest.depth_seeds(df([
        ("binance_spot", {"bids": [["1", "2"]], "asks": [["3", "4"]]}), ("bybit_perp", {"result": {"b": [["1", "2"]], "a": [["3", "4"]]}}), ("okx_spot", {"data": [{"bids": [["1", "2", "0"]], "asks": [["3", "4", "0"]]}]}),
        ("gemini_spot", {"bids": [{"price": "1", "amount": "2"}], "asks": [{"price": "3", "amount": "4"}]}), ("hyperliquid_perp", {"levels": [[{"px": "1", "sz": "2"}], [{"px": "3", "sz": "4"}]]}), ("binance_perp", {"code": -1}),
    ])).collect()}
    assert len(seeds) == 5 and set(seeds.values()) == {(((1.0, 2.0),), ((3.0, 4.0),))}
    candle = {(r.market, r.ts, r.open, r.high, r.low, r.close, r.volume) for r in rest.candles(df([
        ("binance_spot", [[1700000000000, "1", "4", "0.5", "2", "9", 0]]), ("coinbase_spot", [[1700000000, 0.5, 4, 1, 2, 9]]), ("bitfinex_spot", [[1700000000000, 1, 2, 4, 0.5, 9]]), ("bybit_spot", {"result": {"list": [["1700000000000", "1", "4", "0.5", "2", "9", "0"]]}}),
    ])).collect()}
    assert {c[1:] for c in candle} == {(1700000000000, 1.0, 4.0, 0.5, 2.0, 9.0)} and len(candle) == 4
    r = rest.mapped(df([("binance_spot", {"lastPrice": "7.5", "volume": "-1"})]), rest.TICKER).first()
    assert (r["last"], r.volume_24h) == (7.5, None)


def test_status_and_silence(spark):
    seen = spark.createDataFrame([("m", "trade", 100), ("m", "trade", 900), ("m", "depth", 100)], "market string, channel string, ts long")
    assert {(r.channel, r.age, r.silent) for r in display.silence(seen, {"trade": 50}, 5000, 1000).collect()} == {("trade", 100, True), ("depth", 900, False)}


def test_replies_of_all_exchanges(spark):
    df = lambda rows: spark.createDataFrame([(m, json.dumps(b)) for m, b in rows], "market string, body string")
    levels = {(r.market, r.side, r.price): r.qty for r in rest.depth_levels(df([
        ("kraken_spot", {"error": [], "result": {"ANY": {"bids": [["1", "2", 0]], "asks": [["3", "4", 0], ["5", "0", 0]]}}}), ("bitfinex_spot", [[1, 7, 2], [3, 1, -4]]),
        ("bitmex_perp", [{"id": 1, "side": "Buy", "price": 1, "size": 2}, {"id": 2, "side": "Buy", "price": 1, "size": 6}, {"id": 3, "side": "Sell", "price": 3, "size": 4}]),
        ("coinbase_spot", {"bids": [["1", "2", "x"], ["1", "3", "y"]], "asks": []}), ("binance_spot", {"bids": [["1", "2"], ["1", "9"]], "asks": []}), ("kraken_perp", {"error": ["no"]}),
    ])).collect()}
    assert levels == {
        ("kraken_spot", "bid", 1.0): 2.0, ("kraken_spot", "ask", 3.0): 4.0, ("bitfinex_spot", "bid", 1.0): 2.0, ("bitfinex_spot", "ask", 3.0): 4.0,
        ("bitmex_perp", "bid", 1.0): 8.0, ("bitmex_perp", "ask", 3.0): 4.0, ("coinbase_spot", "bid", 1.0): 5.0, ("binance_spot", "bid", 1.0): 9.0,
    }
    candle = rest.candles(df([("kraken_spot", {"result": {"ANY": [[1700000000, "1", "4", "0.5", "2", "3", "9", 5]], "last": 1}}), ("hyperliquid_perp", [{"t": 1700000000000, "o": "1", "h": "4", "l": "0.5", "c": "2", "v": "9"}])])).collect()
    assert len(candle) == 2 and {tuple(c)[1:] for c in candle} == {(1700000000000, 1.0, 4.0, 0.5, 2.0, 9.0)}
    got = {r.market: r for r in rest.tickers(df([
        ("binance_perp_btcusdc", {"lastPrice": "7", "priceChange": "-1"}), ("bybit_perp", {"retCode": 0, "result": {"list": [{"lastPrice": "7", "fundingRate": "-0.1", "nextFundingTime": "12"}]}}), ("bybit_spot", {"retCode": 1, "result": {"list": [{"lastPrice": "7"}]}}),
        ("okx_spot", {"data": [{"last": "7", "ts": "5"}]}), ("coinbase_spot", {"price": "7"}), ("kraken_spot", {"error": [], "result": {"ANY": {"c": ["7", "1"]}}}), ("okx_perp", {"data": []}),
    ])).collect()}
    assert set(got) == {"binance_perp_btcusdc", "bybit_perp", "okx_spot", "coinbase_spot", "kraken_spot"} and {r.last_price for r in got.values()} == {7.0}
    assert (got["binance_perp_btcusdc"].price_change_24h, got["bybit_perp"].funding_rate, got["bybit_perp"].next_funding_time, got["okx_spot"].source_ts, got["coinbase_spot"].high_24h) == (-1.0, -0.1, 12, 5, None)


def test_ratios_and_taker_volume(spark):
    df = lambda rows: spark.createDataFrame([(m, json.dumps(b)) for m, b in rows], "market string, body string")
    got = {r.market: tuple(r)[1:] for r in rest.long_short(df([
        ("binance_perp", [{"longAccount": "0.6", "shortAccount": "0.4", "longShortRatio": "1.5", "period": "5m"}]), ("bybit_perp", {"retCode": 0, "result": {"list": [{"buyRatio": "0.5", "sellRatio": "0", "timestamp": "9"}]}}),
        ("okx_perp", {"data": [["8", "1.25"]]}), ("bitmex_perp", [{"longAccount": "1"}]),
    ])).collect()}
    assert got == {"binance_perp": (0.6, 0.4, 1.5, "5m", None), "bybit_perp": (0.5, 0.0, None, "1h", "9"), "okx_perp": (None, None, 1.25, "1H", "8")}
    taker = rest.taker_volume(df([("binance_perp", [{"buyVol": "3", "sellVol": "2", "buySellRatio": "1.5"}]), ("binance_perp", []), ("okx_perp", [{"buyVol": "3"}])])).collect()
    assert [tuple(r) for r in taker] == [("binance_perp", 3.0, 2.0, 1.5, "1h")]


def test_polls_of_derivatives(spark):
    rows = [
        ("binance_perp", 100, {"markPrice": "7", "lastFundingRate": "-0.1", "nextFundingTime": 200, "time": 90}), ("binance_perp", 100, {"openInterest": "5", "time": 95}), ("binance_perp", 200, {"markPrice": "7", "time": 190}),
        ("okx_perp", 100, {"data": [{"oi": "5", "oiCcy": "6", "oiUsd": "8", "ts": "96"}]}), ("okx_perp", 100, {"data": [{"markPx": "7", "ts": "99"}]}), ("okx_perp", 100, {"data": [{"fundingRate": "-0.1", "fundingTime": "200"}]}),
        ("hyperliquid_perp", 100, [{}, [{"markPx": "7", "funding": "-0.1", "openInterest": "5"}]]), ("bitmex_perp", 100, [{"symbol": "XBTUSD", "markPrice": 7, "openInterest": 5, "timestamp": "1970-01-01T00:00:00.094Z"}]), ("bitmex_perp", 200, [{"symbol": "OTHER", "markPrice": 7}]), ("any_perp", 100, {}),
    ]
    replies = spark.createDataFrame([(m, t, json.dumps(b)) for m, t, b in rows], "market string, ts long, body string")
    got = {(r.market, r.ts): (r.mark_price, r.funding_rate, r.open_interest, r.oi_ccy, r.next_funding_time, r.source_ts, r.error_code) for r in rest.derivatives(replies).collect()}
    assert got == {
        ("binance_perp", 100): (7.0, -0.1, 5.0, None, 200, 95, None), ("binance_perp", 200): (7.0, None, None, None, None, None, "source_error"), ("okx_perp", 100): (7.0, -0.1, 5.0, 6.0, 200, 96, None),
        ("hyperliquid_perp", 100): (7.0, -0.1, 5.0, None, None, 100, None), ("bitmex_perp", 100): (7.0, None, 5.0, None, None, 94, None), ("bitmex_perp", 200): (7.0, None, None, None, None, None, "source_error"), ("any_perp", 100): (None, None, None, None, None, None, "oi_not_supported"),
    }
