"""Exchange wire frames to trades, books and liquidations, as column functions over JSON text.

Sockets are not part of this engine: frames come as rows (market, frame) of any batch or streaming
source. Frames that carry nothing of a kind give no row of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms, exchange_of

TRADE = "array<struct<price:double,qty:double,side:string,ts:bigint,trade_id:string>>"
LEVELS = "array<struct<price:string,qty:string>>"


def _n(x: Column) -> Column:
    return x.cast("string").try_cast("double")


def _trade(price: Column, qty: Column, side: Column, ts: Column, trade_id: Column) -> Column:
    return F.struct(_n(price).alias("price"), _n(qty).alias("qty"), F.lower(side).alias("side"), ts.cast("long").alias("ts"), trade_id.cast("string").alias("trade_id"))


def _json(frame: Column, schema: str) -> Column:
    return F.from_json(frame, schema)


def _ms(x: Column) -> Column:
    return epoch_ms(_n(x))


def _iso(x: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(x))


def _list(frame: Column, schema: str, path: str, f) -> Column:
    return F.transform(_json(frame, schema)[path], f)


def _fields(v: Column, names: str) -> dict[str, Column]:
    """Fields of a JSON value by exact name; names that differ in case only are different fields."""
    return {n: F.try_variant_get(v, f"$.{n}", "string") for n in names.split()}


def _binance(f: Column, market: Column) -> Column:
    j = _fields(F.try_parse_json(f), "e t p q T m")
    contracts = market.contains("coinm")
    qty = F.when(contracts, _n(j["q"]) * 100 / _n(j["p"])).otherwise(_n(j["q"]))
    return F.when(j["e"].isin("trade", "aggTrade"), F.array(_trade(j["p"], qty, F.when(j["m"] == "true", "sell").otherwise("buy"), _ms(j["T"]), j["t"])))


def _bybit(f: Column, market: Column) -> Column:
    def row(v: Column) -> Column:
        t = _fields(v, "p v S T i")
        return _trade(t["p"], t["v"], t["S"], _ms(t["T"]), t["i"])

    return F.when(F.get_json_object(f, "$.topic").startswith("publicTrade"), _list(f, "data array<variant>", "data", row))


def _okx(f: Column, market: Column) -> Column:
    worth = F.when(market == "okx_perp", 0.01).otherwise(1.0)
    row = lambda t: _trade(t["px"], _n(t["sz"]) * worth, t["side"], _ms(t["ts"]), t["tradeId"])
    return F.when(F.get_json_object(f, "$.arg.channel") == "trades", _list(f, "data array<struct<tradeId:string,px:string,sz:string,side:string,ts:string>>", "data", row))


def _coinbase(f: Column, market: Column) -> Column:
    # the side is the maker's, so it is turned round
    row = lambda t: _trade(t["price"], t["size"], F.when(F.upper(t["side"]) == "SELL", "buy").otherwise("sell"), _iso(t["time"]), t["trade_id"])
    events = _json(f, "channel string, events array<struct<trades:array<struct<trade_id:string,price:string,size:string,side:string,time:string>>>>")
    return F.when(events["channel"] == "market_trades", F.transform(F.flatten(F.transform(events["events"], lambda e: F.coalesce(e["trades"], F.array().cast("array<struct<trade_id:string,price:string,size:string,side:string,time:string>>")))), row))


def _kraken(f: Column, market: Column) -> Column:
    rows = F.from_json(F.get_json_object(f, "$[1]"), "array<array<string>>")
    row = lambda t: _trade(t[0], t[1], F.when(t[3] == "b", "buy").otherwise("sell"), F.floor(_n(t[2]) * 1000), F.concat_ws("-", t[2], t[0], t[1], t[4], t[5]))
    return F.when(F.get_json_object(f, "$[2]") == "trade", F.transform(rows, row))


def _bitstamp(f: Column, market: Column) -> Column:
    j = _json(f, "event string, data struct<id:string,amount_str:string,price_str:string,type:int,microtimestamp:string>")
    d = j["data"]
    return F.when(j["event"] == "trade", F.array(_trade(d["price_str"], d["amount_str"], F.when(d["type"] == 0, "buy").otherwise("sell"), _ms(d["microtimestamp"]), d["id"])))


def _bitfinex(f: Column, market: Column) -> Column:
    t = F.from_json(F.get_json_object(f, "$[2]"), "array<string>")  # id, ms, signed amount, price; only executions that are final
    return F.when(F.get_json_object(f, "$[1]") == "tu", F.array(_trade(F.get(t, F.lit(3)), F.abs(_n(F.get(t, F.lit(2)))), F.when(_n(F.get(t, F.lit(2))) > 0, "buy").otherwise("sell"), _ms(F.get(t, F.lit(1))), F.get(t, F.lit(0)))))


def _bitmex(f: Column, market: Column) -> Column:
    row = lambda t: _trade(t["price"], _n(t["size"]) / _n(t["price"]), t["side"], _iso(t["timestamp"]), t["trdMatchID"])
    return F.when(F.get_json_object(f, "$.table") == "trade", _list(f, "data array<struct<price:string,size:string,side:string,timestamp:string,trdMatchID:string>>", "data", row))


def _hyperliquid(f: Column, market: Column) -> Column:
    row = lambda t: _trade(t["px"], t["sz"], F.when(t["side"] == "B", "buy").otherwise("sell"), _ms(t["time"]), t["tid"])
    return F.when(F.get_json_object(f, "$.channel") == "trades", _list(f, "data array<struct<px:string,sz:string,side:string,time:string,tid:string>>", "data", row))


def _crypto_com(f: Column, market: Column) -> Column:
    row = lambda t: _trade(t["p"], t["q"], t["s"], _ms(t["t"]), t["d"])
    j = _json(f, "result struct<channel:string,data:array<struct<p:string,q:string,s:string,t:string,d:string>>>")["result"]
    return F.when(j["channel"] == "trade", F.transform(j["data"], row))


def _gemini(f: Column, market: Column) -> Column:
    j = _json(f, "type string, event_id string, quantity string, price string, side string, timestamp string")
    return F.when(j["type"] == "trade", F.array(_trade(j["price"], j["quantity"], j["side"], _ms(j["timestamp"]), j["event_id"])))


_TRADES = {"binance": _binance, "bybit": _bybit, "okx": _okx, "coinbase": _coinbase, "kraken": _kraken, "bitstamp": _bitstamp, "bitfinex": _bitfinex, "bitmex": _bitmex, "hyperliquid": _hyperliquid, "crypto_com": _crypto_com, "gemini": _gemini}


def _by_exchange(market: Column, table: dict, frame: Column, kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for name, f in table.items():
        out = F.when(exchange_of(market) == name, f(frame, market).cast(kind)).otherwise(out)
    return out


def trades(frames: DataFrame) -> DataFrame:
    """market, price, qty (BTC), side, ts, trade_id of every trade in (market, frame) rows; invalid ones are left out."""
    rows = frames.select("market", F.explode(_by_exchange(F.col("market"), _TRADES, F.col("frame"), TRADE)).alias("t")).select("market", "t.*")
    return rows.where("price > 0 and qty > 0 and ts is not null and side in ('buy', 'sell')")


def _pairs(x: Column) -> Column:
    return F.transform(x, lambda l: F.struct(F.get(l, F.lit(0)).alias("price"), F.get(l, F.lit(1)).alias("qty"))).cast(LEVELS)


BOOK = f"struct<type:string,ts:bigint,seq:bigint,seq_start:bigint,prev_seq:bigint,bids:{LEVELS},asks:{LEVELS}>"


def _book(kind: Column, ts: Column, seq: Column, start: Column, prev: Column, bids: Column, asks: Column) -> Column:
    names = zip((kind, ts, seq, start, prev, bids, asks), ("type", "ts", "seq", "seq_start", "prev_seq", "bids", "asks"), strict=True)
    return F.struct(*(c.alias(n) for c, n in names))


def _no() -> Column:
    return F.lit(None).cast("long")


def _binance_book(f: Column, market: Column) -> Column:
    j, sides = _fields(F.try_parse_json(f), "e E U u pu"), _json(f, "b array<array<string>>, a array<array<string>>")
    whole = lambda n: j[n].try_cast("long")
    return F.when(j["e"] == "depthUpdate", _book(F.lit("update"), whole("E"), whole("u"), whole("U"), whole("pu"), _pairs(sides["b"]), _pairs(sides["a"])))


def _bybit_book(f: Column, market: Column) -> Column:
    j = _json(f, "topic string, type string, ts long, data struct<u:bigint,b:array<array<string>>,a:array<array<string>>>")
    kind = F.when(j["type"] == "snapshot", "snapshot").otherwise("update")
    return F.when(j["topic"].startswith("orderbook"), _book(kind, j["ts"], j["data"]["u"], _no(), _no(), _pairs(j["data"]["b"]), _pairs(j["data"]["a"])))


def _okx_book(f: Column, market: Column) -> Column:
    j = _json(f, "arg struct<channel:string>, action string, data array<struct<asks:array<array<string>>,bids:array<array<string>>,ts:string,seqId:bigint,prevSeqId:bigint>>")
    d = F.get(j["data"], F.lit(0))
    kind = F.when(j["action"] == "snapshot", "snapshot").otherwise("update")
    return F.when(j["arg"]["channel"] == "books", _book(kind, _ms(d["ts"]), d["seqId"], _no(), d["prevSeqId"], _pairs(d["bids"]), _pairs(d["asks"])))


def _coinbase_book(f: Column, market: Column) -> Column:
    j = _json(f, "channel string, sequence_num long, events array<struct<type:string,updates:array<struct<side:string,price_level:string,new_quantity:string>>>>")
    e = F.get(j["events"], F.lit(0))
    side = lambda s: F.transform(F.filter(e["updates"], lambda u: u["side"].isin(*s)), lambda u: F.struct(u["price_level"].alias("price"), u["new_quantity"].alias("qty"))).cast(LEVELS)
    return F.when(j["channel"] == "l2_data", _book(F.when(e["type"] == "snapshot", "snapshot").otherwise("update"), _no(), j["sequence_num"], _no(), _no(), side(("bid",)), side(("ask", "offer"))))


def _hyperliquid_book(f: Column, market: Column) -> Column:
    j = _json(f, "channel string, data struct<levels:array<array<struct<px:string,sz:string>>>,time:string>")
    side = lambda i: F.transform(F.get(j["data"]["levels"], F.lit(i)), lambda l: F.struct(l["px"].alias("price"), l["sz"].alias("qty"))).cast(LEVELS)
    return F.when(j["channel"] == "l2Book", _book(F.lit("full"), _ms(j["data"]["time"]), _no(), _no(), _no(), side(0), side(1)))


def _kraken_book(f: Column, market: Column) -> Column:
    j = F.from_json(F.get_json_object(f, "$[1]"), "bs array<array<string>>, as array<array<string>>, b array<array<string>>, a array<array<string>>")
    snapshot = j["bs"].isNotNull() | j["as"].isNotNull()
    return F.when(F.get_json_object(f, "$[2]").startswith("book"), _book(F.when(snapshot, "snapshot").otherwise("update"), _no(), _no(), _no(), _no(), _pairs(F.coalesce(j["bs"], j["b"])), _pairs(F.coalesce(j["as"], j["a"]))))


_BOOKS = {"binance": _binance_book, "bybit": _bybit_book, "okx": _okx_book, "coinbase": _coinbase_book, "hyperliquid": _hyperliquid_book, "kraken": _kraken_book}


def books(frames: DataFrame) -> DataFrame:
    """market, type (snapshot, update; full: a whole book to be compared with the one before), ts, seq, seq_start, prev_seq, bids, asks; unknown times and numbers are null."""
    b = _by_exchange(F.col("market"), _BOOKS, F.col("frame"), BOOK)
    return frames.select("market", b.alias("b")).where("b is not null").select("market", "b.*")


LIQUIDATION = "array<struct<symbol:string,side:string,price:double,qty:double,source_ts:bigint,raw_type:string>>"


def _liquidation(symbol: Column, side: Column, price: Column, qty: Column, ts: Column, kind: str) -> Column:
    return F.struct(symbol.alias("symbol"), F.lower(side).alias("side"), _n(price).alias("price"), _n(qty).alias("qty"), ts.alias("source_ts"), F.lit(kind).alias("raw_type"))


def liquidations(frames: DataFrame) -> DataFrame:
    """market, exchange, symbol, side, price, qty, notional, source_ts, raw_type of forced orders."""
    f = F.col("frame")
    b = _fields(F.try_parse_json(f), "e o.s o.S o.q o.p o.T")
    binance = F.when(b["e"] == "forceOrder", F.array(_liquidation(b["o.s"], b["o.S"], b["o.p"], b["o.q"], b["o.T"].try_cast("long"), "forceOrder")))
    bybit = F.when(F.get_json_object(f, "$.topic").rlike("[lL]iquidation"), _list(f, "data array<struct<updatedTime:bigint,symbol:string,side:string,size:string,price:string>>", "data", lambda d: _liquidation(d["symbol"], d["side"], d["price"], d["size"], d["updatedTime"], "liquidation")))
    okx = F.when(F.get_json_object(f, "$.arg.channel") == "liquidation-orders", _list(f, "data array<struct<instId:string,side:string,sz:string,ts:string,fillPx:string>>", "data", lambda d: _liquidation(d["instId"], d["side"], d["fillPx"], _n(d["sz"]) * 0.01, _ms(d["ts"]), "liquidation-orders")))
    table = {"binance": lambda *_: binance, "bybit": lambda *_: bybit, "okx": lambda *_: okx}
    rows = frames.select("market", F.explode(_by_exchange(F.col("market"), table, f, LIQUIDATION)).alias("l")).select("market", exchange_of(F.col("market")).alias("exchange"), "l.*")
    return rows.where("price > 0 and qty > 0").withColumn("notional", F.col("price") * F.col("qty"))
