import gzip
import json

from brontide.sources import blocks, frames, sinks

#: Payloads made up here from each exchange's wire format, and the trade they mean.
AT = 1_722_333_444_555
FRAMES = [
    ("binance_spot", {"e": "trade", "t": 31, "p": "70123.25", "q": "0.75", "T": AT, "m": True}, (70123.25, 0.75, "sell", AT, "31")),
    ("bybit_perp", {"topic": "publicTrade.BTCUSDT", "data": [{"T": AT + 1, "S": "Buy", "v": "0.375", "p": "70010.5", "i": "by-8"}]}, (70010.5, 0.375, "buy", AT + 1, "by-8")),
    ("okx_perp", {"arg": {"channel": "trades"}, "data": [{"tradeId": "ok-3", "px": "69500.5", "sz": "7", "side": "sell", "ts": str(AT)}]}, (69500.5, 0.07, "sell", AT, "ok-3")),
    ("coinbase_spot", {"channel": "market_trades", "events": [{"trades": [{"trade_id": "cb-4", "price": "71000.75", "size": "0.3", "side": "BUY", "time": "2024-07-30T09:57:24.555Z"}]}]}, (71000.75, 0.3, "sell", AT, "cb-4")),
    ("kraken_spot", [3, [["70555.5", "0.25", "1722333444.5", "s", "m", ""]], "trade", "XBT/USD"], (70555.5, 0.25, "sell", 1_722_333_444_500, "1722333444.5-70555.5-0.25-m-")),
    ("bitstamp_spot", {"event": "trade", "data": {"id": 77, "amount_str": "0.0625", "price_str": "70222.5", "type": 1, "microtimestamp": str(AT * 1000)}}, (70222.5, 0.0625, "sell", AT, "77")),
    ("bitfinex_spot", [8, "tu", [909, AT, 1.25, 70333]], (70333.0, 1.25, "buy", AT, "909")),
    ("bitmex_perp", {"table": "trade", "data": [{"price": 80000, "size": 400, "side": "Sell", "timestamp": "2024-07-30T09:57:24.555Z", "trdMatchID": "mx-2"}]}, (80000.0, 0.005, "sell", AT, "mx-2")),
    ("hyperliquid_perp", {"channel": "trades", "data": [{"px": "70444.5", "sz": "0.5", "side": "B", "time": AT, "tid": 21}]}, (70444.5, 0.5, "buy", AT, "21")),
    ("crypto_com_spot", {"result": {"channel": "trade", "data": [{"p": "70666.5", "q": "0.875", "s": "SELL", "t": AT, "d": "cr-5"}]}}, (70666.5, 0.875, "sell", AT, "cr-5")),
    ("gemini_spot", {"type": "trade", "event_id": 61, "quantity": "0.15", "price": "70777.5", "side": "buy", "timestamp": AT}, (70777.5, 0.15, "buy", AT, "61")),
    ("binance_spot", {"e": "kline"}, None),
    ("bybit_perp", "{cut off", None),
]


def test_trades_of_every_exchange(spark):
    rows = spark.createDataFrame([(m, f if isinstance(f, str) else json.dumps(f)) for m, f, _ in FRAMES], "market string, frame string")
    got = {(r.market, r.price, r.qty, r.side, r.ts, r.trade_id) for r in frames.trades(rows).collect()}
    assert got == {(m, *w) for m, _, w in FRAMES if w}


def test_books_and_liquidations(spark):
    rows = spark.createDataFrame(
        [(m, json.dumps(f)) for m, f in [
            ("binance_perp", {"e": "depthUpdate", "E": 8, "U": 41, "u": 46, "pu": 40, "b": [["70100.5", "0.4"]], "a": [["70101.5", "0"]]}),
            ("okx_perp", {"arg": {"channel": "books"}, "action": "snapshot", "data": [{"asks": [["9.5", "4", "0", "1"]], "bids": [["9", "6", "0", "2"]], "ts": str(AT), "seqId": 88}]}),
            ("binance_perp", {"e": "forceOrder", "o": {"s": "BTCUSDT", "S": "BUY", "q": "0.25", "p": "72000.0", "T": 9}}),
        ]], "market string, frame string")
    got = {r.market: (r.type, r.seq, r.seq_start, r.prev_seq, [tuple(x) for x in r.bids], [tuple(x) for x in r.asks]) for r in frames.books(rows).collect()}
    assert got == {"binance_perp": ("update", 46, 41, 40, [("70100.5", "0.4")], [("70101.5", "0")]), "okx_perp": ("snapshot", 88, None, None, [("9", "6")], [("9.5", "4")])}
    (x,) = frames.liquidations(rows).collect()
    assert (x.exchange, x.side, x.price, x.qty, x.notional, x.source_ts) == ("binance", "buy", 72000.0, 0.25, 18000.0, 9)


def test_blocks_are_scanned_and_validated(spark, tmp_path):
    d = tmp_path / "trades/m/1970-01-01"
    d.mkdir(parents=True)
    (d / "00-00-30.jsonl").write_text('{"ts":30001,"price":1,"qty":2,"side":"buy"}\nnot json\n{"ts":30002,"price":1,"side":"buy"}\n{"ts":30003,"price":-1,"qty":1,"side":"buy"}\n{"ts":99999,"price":1,"qty":1,"side":"buy"}\n')
    (d / "00-01-00.jsonl").write_text('{"ts":60001,"price":1,"qty":2,"side":"sell"}')
    lines = blocks.scan_blocks(spark, str(tmp_path), "trades", 30_000, 60_000)
    assert sorted(str(r.error) for r in blocks.validated_trades(lines).collect()) == ["E001", "E002", "E003", "E005", "None"]
    assert {r.path[-14:]: r.kind for r in blocks.classified_files(spark, str(d)).collect()} == {"00-00-30.jsonl": "nonempty", "00-01-00.jsonl": "partial"}


def test_batches_go_there_and_back(spark):
    lines = spark.createDataFrame([("m", "trades", i, i * 10, f"line {i}") for i in range(10)], "market string, stream string, seq long, ts long, line string")
    packed = blocks.compressed_batches(lines, 4)
    assert sorted((r.batch_id, r.row_count, gzip.decompress(r.payload)[:6]) for r in packed.collect())[0] == (0, 4, b"line 0")
    assert sorted((r.batch_id, r.line_no, r.line) for r in blocks.exploded_batches(packed).collect()) == [(i // 4, i % 4, f"line {i}") for i in range(10)]


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([("m", 1, 1.0), ("m", 86_400_001, 2.0)], "market string, ts long, x double")
    p = str(tmp_path / "f")
    sinks.write_features(a, p)
    sinks.merge_late(spark.createDataFrame([("m", 2, 5.0), ("m", 1, 1.0)], a.schema), p, ["market", "ts"])
    assert sorted(r.ts for r in spark.read.parquet(p).collect()) == [1, 2, 86_400_001]
    assert sinks.prune(spark, p, "1970-01-02") == ["market=m/date=1970-01-01"] and spark.read.parquet(p).count() == 1
    q = str(tmp_path / "q")
    assert (sinks.append_new(a, q, ["market", "ts"]), sinks.append_new(a, q, ["market", "ts"])) == (2, 0)
    sinks.upsert(spark.createDataFrame([("m", 1, 9.0), ("n", 1, 1.0)], a.schema), q, ["market", "ts"])
    assert sorted((r.market, r.ts, r.x) for r in spark.read.parquet(q).collect()) == [("m", 1, 9.0), ("m", 86_400_001, 2.0), ("n", 1, 1.0)]
    w = str(tmp_path / "w")
    assert [sinks.commit_window(x, w, 0) for x in (a, a, a.limit(1))] == ["committed", "idempotent", "conflict"]
    lines = spark.createDataFrame([("m", i, str(i)) for i in range(50)], "market string, id long, line string")
    assert sinks.archived(lines, str(tmp_path / "z"), 10).isEmpty()


def test_sql_over_this(spark):
    spark.range(3).createOrReplaceTempView("trades")
    assert blocks.run_sql(spark, "SELECT count(*) AS n FROM this").first().n == 3
    r = blocks.run_sql(spark, "SELECT 'it''s this' AS a, count(*) AS n FROM this -- this")
    assert tuple(r.first()) == ("it's this", 3) and blocks.as_json(r).first().json == '{"a":"it\'s this","n":"3"}'
