"""REST replies as column functions: order-book seeds, candles, tickers and derivatives. Fetching is not part of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms, exchange_of, finite

LEVELS = "array<struct<price:double,qty:double>>"
#: Where each exchange's depth reply holds its sides, and the fields of a level (by position or name).
_DEPTH = {
    "binance": ("$.bids", "$.asks", None), "bybit": ("$.result.b", "$.result.a", None), "okx": ("$.data[0].bids", "$.data[0].asks", None), "coinbase": ("$.bids", "$.asks", None),
    "bitstamp": ("$.bids", "$.asks", None), "crypto_com": ("$.result.data[0].bids", "$.result.data[0].asks", None), "gemini": ("$.bids", "$.asks", ("price", "amount")), "hyperliquid": ("$.levels[0]", "$.levels[1]", ("px", "sz")),
}


def _levels(text: Column, fields: tuple[str, str] | None) -> Column:
    if fields is None:
        return F.transform(F.from_json(text, "array<array<string>>"), lambda l: F.struct(F.get(l, F.lit(0)).try_cast("double").alias("price"), F.get(l, F.lit(1)).try_cast("double").alias("qty")))
    p, q = fields
    return F.transform(F.from_json(text, f"array<struct<{p}:string,{q}:string>>"), lambda l: F.struct(l[p].try_cast("double").alias("price"), l[q].try_cast("double").alias("qty")))


def _inner(body: Column) -> Column:
    """The value under a Kraken reply's pair, whatever the pair is called."""
    pairs = F.from_json(F.get_json_object(body, "$.result"), "map<string,string>")
    return F.get(F.map_values(F.map_filter(pairs, lambda k, _: k != "last")), F.lit(0))


def _signed_levels(body: Column, sign: int) -> Column:
    """Bitfinex: rows of price, count and a quantity that is negative on the ask side."""
    rows = F.transform(F.from_json(body, "array<array<string>>"), lambda l: F.struct(F.get(l, F.lit(0)).try_cast("double").alias("price"), (sign * F.get(l, F.lit(2)).try_cast("double")).alias("qty")))
    return F.filter(rows, lambda l: l["qty"] > 0)


def _sided_levels(body: Column, *names: str) -> Column:
    """BitMEX: rows with a side, a price and a size (or, where that is missing or 0, a qty)."""
    rows = F.filter(F.from_json(body, "array<struct<side:string,price:string,size:string,qty:string>>"), lambda l: F.upper(l["side"]).isin(*names))
    size = lambda l: F.coalesce(F.nullif(l["size"].try_cast("double"), F.lit(0.0)), l["qty"].try_cast("double"))
    return F.transform(rows, lambda l: F.struct(l["price"].try_cast("double").alias("price"), size(l).alias("qty")))


def depth_seeds(replies: DataFrame, by: tuple[str, ...] = ("market",)) -> DataFrame:
    """``by``, bids, asks of depth replies (market, body) of ten exchanges.

    Levels without a price or a positive quantity go; replies without both sides (an empty one is a side) are left out.
    """
    exchange, body, bids, asks = exchange_of(F.col("market")), F.col("body"), F.lit(None).cast(LEVELS), F.lit(None).cast(LEVELS)
    for name, (b, a, fields) in _DEPTH.items():
        bids, asks = F.when(exchange == name, _levels(F.get_json_object(body, b), fields).cast(LEVELS)).otherwise(bids), F.when(exchange == name, _levels(F.get_json_object(body, a), fields).cast(LEVELS)).otherwise(asks)
    kraken = [_levels(F.get_json_object(_inner(body), side), None) for side in ("$.bids", "$.asks")]
    others = {"kraken": kraken, "bitfinex": [_signed_levels(body, 1), _signed_levels(body, -1)], "bitmex": [_sided_levels(body, "BUY", "BID"), _sided_levels(body, "SELL", "ASK")]}
    for name, (b, a) in others.items():
        bids, asks = F.when(exchange == name, b.cast(LEVELS)).otherwise(bids), F.when(exchange == name, a.cast(LEVELS)).otherwise(asks)
    real = lambda levels: F.filter(levels, lambda l: l["price"].isNotNull() & (l["qty"] > 0))
    return replies.select(*by, real(bids).alias("bids"), real(asks).alias("asks")).where("bids is not null and asks is not null")


#: Exchanges whose depth replies list orders, so that quantities at a price add up; elsewhere the last entry counts.
_ORDERS = ("coinbase", "bitmex", "hyperliquid")


def depth_levels(replies: DataFrame, by: tuple[str, ...] = ("market",)) -> DataFrame:
    """``by``, side (bid/ask), price, qty: one row a price level of each reply; ``by`` names a reply and has its market."""
    seeds = depth_seeds(replies, by)
    sides = [seeds.select(*by, F.lit(side).alias("side"), F.posexplode(column).alias("at", "level")) for side, column in (("bid", "bids"), ("ask", "asks"))]
    qty = F.when(exchange_of(F.col("market")).isin(*_ORDERS), F.sum("level.qty")).otherwise(F.max_by("level.qty", "at"))
    rows = sides[0].union(sides[1])
    return rows.groupBy(*by, "side", F.col("level.price").alias("price")).agg(qty.alias("qty"))


#: Where candle replies hold their rows, and the positions of time, open, high, low, close and volume.
_CANDLES = {"binance": ("$", (0, 1, 2, 3, 4, 5)), "bybit": ("$.result.list", (0, 1, 2, 3, 4, 5)), "okx": ("$.data", (0, 1, 2, 3, 4, 5)), "coinbase": ("$", (0, 3, 2, 1, 4, 5)), "bitfinex": ("$", (0, 1, 3, 4, 2, 5))}


def _candle(names: tuple[str, ...], at: tuple[int, ...]):
    def row(c: Column) -> Column:
        values = [F.get(c, F.lit(i)).try_cast("double") for i in at]
        return F.struct(epoch_ms(values[0]).alias(names[0]), *(v.alias(n) for n, v in zip(names[1:], values[1:], strict=True)))

    return row


def candles(replies: DataFrame) -> DataFrame:
    """market, ts (ms), open, high, low, close, volume of candle replies (market, body), one row a candle."""
    names = ("ts", "open", "high", "low", "close", "volume")
    out = F.lit(None).cast("array<struct<ts:bigint,open:double,high:double,low:double,close:double,volume:double>>")
    rows = {name: (F.col("body") if path == "$" else F.get_json_object("body", path), at) for name, (path, at) in _CANDLES.items()}
    rows["kraken"] = (_inner(F.col("body")), (0, 1, 2, 3, 4, 6))
    for name, (text, at) in rows.items():
        out = F.when(exchange_of(F.col("market")) == name, F.transform(F.from_json(text, "array<array<string>>"), _candle(names, at))).otherwise(out)
    named = F.from_json("body", "array<struct<t:string,o:string,h:string,l:string,c:string,v:string>>")
    out = F.when(exchange_of(F.col("market")) == "hyperliquid", F.transform(named, lambda c: _candle(names, tuple(range(6)))(F.array(*(c[x] for x in "tohlcv"))))).otherwise(out)
    return replies.select("market", F.explode(out).alias("c")).select("market", "c.*").where("ts is not null and close is not null")


def mapped(replies: DataFrame, fields: dict[str, dict[str, str]]) -> DataFrame:
    """One double column per field of ``fields`` (field -> market -> JSON path); null where a market has no path, '' or a negative value."""
    from ..functions.scalars import non_negative

    out = []
    for field, paths in fields.items():
        value = F.lit(None).cast("double")
        for market, path in paths.items():
            value = F.when(F.col("market") == market, non_negative(F.get_json_object("body", path))).otherwise(value)
        out.append(value.alias(field))
    return replies.select("market", *out)


#: Paths of the last price and the 24-hour volume in ticker replies.
TICKER = {
    "last": {"binance_spot": "$.lastPrice", "bybit_spot": "$.result.list[0].lastPrice", "okx_spot": "$.data[0].last", "coinbase_spot": "$.price", "bitstamp_spot": "$.last"},
    "volume_24h": {"binance_spot": "$.volume", "bybit_spot": "$.result.list[0].volume24h", "okx_spot": "$.data[0].vol24h", "coinbase_spot": "$.volume", "bitstamp_spot": "$.volume"},
}
#: Paths of mark price, open interest and (where they can't be negative) other derivatives fields.
DERIVATIVES = {
    "mark_price": {"binance_perp": "$.markPrice", "bybit_perp": "$.result.list[0].markPrice", "okx_perp": "$.data[0].markPx", "bitmex_perp": "$[0].markPrice"},
    "open_interest": {"binance_perp": "$.openInterest", "bybit_perp": "$.result.list[0].openInterest", "okx_perp": "$.data[0].oi", "bitmex_perp": "$[0].openInterest"},
}


def _number(text: Column) -> Column:
    """A finite number of either sign; null for '' and other text."""
    x = text.try_cast("double")
    return F.when(finite(x), x)


def _time(text: Column) -> Column:
    """Milliseconds of a reply's time, a number of milliseconds or an ISO 8601 text."""
    return F.coalesce(_number(text).cast("long"), F.unix_millis(F.try_to_timestamp(text)))


def _by_market(formats: dict[str, Column], key: Column) -> Column:
    """The format of a row's own market or exchange; null where there is none."""
    first, *rest = formats.items()
    out = F.when(key == first[0], first[1])
    for name, value in rest:
        out = out.when(key == name, value)
    return out


#: Where ticker replies hold their row.
_TICKER_ROW = {"binance": "$", "bybit": "$.result.list[0]", "okx": "$.data[0]", "coinbase": "$"}
#: Fields of a ticker row by exchange; Kraken's are the first of a list.
TICKER_FIELDS = {
    "last_price": {"binance": "lastPrice", "bybit": "lastPrice", "okx": "last", "coinbase": "price", "kraken": "c[0]"},
    "volume_24h": {"binance": "volume", "bybit": "volume24h", "okx": "vol24h", "coinbase": "volume", "kraken": "v[0]"},
    "quote_vol_24h": {"binance": "quoteVolume", "bybit": "turnover24h", "okx": "volCcy24h"},
    "high_24h": {"binance": "highPrice", "bybit": "highPrice24h", "okx": "high24h", "coinbase": "high", "kraken": "h[0]"},
    "low_24h": {"binance": "lowPrice", "bybit": "lowPrice24h", "okx": "low24h", "coinbase": "low", "kraken": "l[0]"},
    "open_24h": {"bybit": "prevPrice24h", "okx": "open24h", "coinbase": "open"},
    "price_change_24h": {"binance": "priceChange"},
    "price_change_pct": {"binance": "priceChangePercent"},
    "mark_price": {"bybit": "markPrice"},
    "funding_rate": {"bybit": "fundingRate"},
    "open_interest": {"bybit": "openInterest"},
    "next_funding_time": {"bybit": "nextFundingTime"},
    "source_ts": {"okx": "ts"},
}


def tickers(replies: DataFrame, by: tuple[str, ...] = ("market",)) -> DataFrame:
    """``by`` and the fields of TICKER_FIELDS (times long, all else double) of 24-hour ticker replies (market, body).

    A field that an exchange doesn't send is null; a reply that is an error or has no row is left out.
    """
    exchange, body = exchange_of(F.col("market")), F.col("body")
    row = {name: F.get_json_object(body, path) for name, path in _TICKER_ROW.items()}
    row["kraken"] = F.coalesce(F.get_json_object(body, "$.result.XBTUSD"), F.get_json_object(body, "$.result.XXBTZUSD"), _inner(body))
    at = lambda path: F.get_json_object(body, path)
    valid = {"binance": at("$.lastPrice").isNotNull(), "bybit": at("$.retCode") == "0", "okx": F.lit(True), "coinbase": at("$.price").isNotNull(), "kraken": at("$.error") == "[]"}
    rows = replies.withColumn("_row", F.when(_by_market(valid, exchange), _by_market(row, exchange))).where("_row is not null")
    value = lambda names: _by_market({e: F.get_json_object("_row", f"$.{name}") for e, name in names.items()}, exchange)
    kind = lambda field: "long" if field in ("next_funding_time", "source_ts") else "double"
    return rows.select(*by, *(_number(value(names)).cast(kind(field)).alias(field) for field, names in TICKER_FIELDS.items()))


def long_short(replies: DataFrame, by: tuple[str, ...] = ("market",)) -> DataFrame:
    """``by``, long_account_ratio, short_account_ratio, long_short_ratio, period, ts_str of the first row of ratio replies (market, body).

    Bybit's ratio is computed, null without short accounts; OKX sends a time and the ratio only. Replies without a row are left out.
    """
    at = lambda path: F.get_json_object("body", path)
    bybit = "$.result.list[0]"
    formats = {
        "binance_perp": (at("$[0]"), at("$[0].longAccount"), at("$[0].shortAccount"), at("$[0].longShortRatio"), F.coalesce(F.nullif(at("$[0].period"), F.lit("")), F.lit("1h")), F.lit(None)),
        "bybit_perp": (F.when(at("$.retCode") == "0", at(bybit)), at(f"{bybit}.buyRatio"), at(f"{bybit}.sellRatio"), F.lit(None), F.coalesce(F.nullif(at(f"{bybit}.period"), F.lit("")), F.lit("1h")), at(f"{bybit}.timestamp")),
        "okx_perp": (at("$.data[0]"), F.lit(None), F.lit(None), at("$.data[0][1]"), F.lit("1H"), at("$.data[0][0]")),
    }
    names = ("_row", "long_account_ratio", "short_account_ratio", "long_short_ratio", "period", "ts_str")
    columns = {n: _by_market({m: v[i].cast("string") for m, v in formats.items()}, F.col("market")) for i, n in enumerate(names)}
    numbers = {n: _number(columns[n]) for n in names[1:4]}
    share = F.when(numbers["short_account_ratio"] > 0, numbers["long_account_ratio"] / numbers["short_account_ratio"])
    numbers["long_short_ratio"] = F.when(F.col("market") == "bybit_perp", share).otherwise(numbers["long_short_ratio"])
    return replies.where(columns["_row"].isNotNull()).select(*by, *(x.alias(n) for n, x in numbers.items()), columns["period"].alias("period"), columns["ts_str"].alias("ts_str"))


def taker_volume(replies: DataFrame, by: tuple[str, ...] = ("market",)) -> DataFrame:
    """``by``, buy_vol_24h, sell_vol_24h, buy_sell_ratio, period of the first row of taker-volume replies (market, body); others are left out."""
    at = lambda path: F.get_json_object("body", path)
    period = F.coalesce(F.nullif(at("$[0].period"), F.lit("")), F.lit("1h"))
    rows = replies.where((F.col("market") == "binance_perp") & at("$[0]").isNotNull())
    return rows.select(*by, *(_number(at(f"$[0].{f}")).alias(n) for n, f in (("buy_vol_24h", "buyVol"), ("sell_vol_24h", "sellVol"), ("buy_sell_ratio", "buySellRatio"))), period.alias("period"))


_BINANCE_PERP = {"mark_price": "$.markPrice", "funding_rate": "$.lastFundingRate", "open_interest": "$.openInterest", "next_funding_time": "$.nextFundingTime", "time": "$.time", "row": "$.openInterest"}
_BYBIT_PERP = {"mark_price": "$.result.list[0].markPrice", "funding_rate": "$.result.list[0].fundingRate", "open_interest": "$.result.list[0].openInterest", "next_funding_time": "$.result.list[0].nextFundingTime", "time": "$.time", "row": "$.result.list[0]"}
#: Paths in the replies of each perpetual market; ``row`` is there if the reply tells open interest.
PERPETUALS = {
    "binance_perp": _BINANCE_PERP, "binance_perp_btcusdc": _BINANCE_PERP, "bybit_perp": _BYBIT_PERP,
    "okx_perp": {"mark_price": "$.data[0].markPx", "funding_rate": "$.data[0].fundingRate", "open_interest": "$.data[0].oi", "oi_ccy": "$.data[0].oiCcy", "oi_usd": "$.data[0].oiUsd", "next_funding_time": "$.data[0].fundingTime", "time": "$.data[0].ts", "row": "$.data[0].oi"},
    "hyperliquid_perp": {"mark_price": "$[1][0].markPx", "funding_rate": "$[1][0].funding", "open_interest": "$[1][0].openInterest", "row": "$[1][0]"},
    "bitmex_perp": {"mark_price": "$[0].markPrice", "funding_rate": "$[0].fundingRate", "open_interest": "$[0].openInterest", "time": "$[0].timestamp", "row": "$[0].symbol"},
}


def derivatives(replies: DataFrame, by: tuple[str, ...] = ("market", "ts")) -> DataFrame:
    """``by``, mark_price, funding_rate, open_interest, oi_ccy, oi_usd, next_funding_time, source_ts, error_code: one row a poll.

    ``replies`` has (market, ts, body), ts being the time of the poll; a market that answers in parts (mark, funding,
    open interest) has one row for each, and ``by`` puts them together. source_ts is the exchange's time of the open
    interest, else the poll's; it is null and error_code 'source_error' where no reply tells open interest, and error_code is
    'oi_not_supported' for other markets.
    """
    market = F.col("market")
    path = lambda field: _by_market({m: F.get_json_object("body", p[field]) for m, p in PERPETUALS.items() if field in p}, market)
    numbers = ("mark_price", "funding_rate", "open_interest", "oi_ccy", "oi_usd", "next_funding_time")
    row = F.when(market == "bitmex_perp", path("row") == "XBTUSD").otherwise(path("row").isNotNull())
    parts = replies.select(*by, F.col("ts").alias("_ts"), *(_number(path(f)).alias(f) for f in numbers), _time(path("time")).alias("_time"), row.alias("_row"))
    own = F.coalesce(F.max(F.when(F.col("_row"), F.col("_time"))), F.max(F.when(market.startswith("binance"), F.col("_time"))), F.max("_ts"))
    known, told = market.isin(*PERPETUALS), F.coalesce(F.bool_or("_row"), F.lit(False))
    out = parts.groupBy(*by).agg(*(F.max(f).cast("long" if f == "next_funding_time" else "double").alias(f) for f in numbers), F.when(told, own).alias("source_ts"), F.when(~known, "oi_not_supported").when(~told, "source_error").alias("error_code"))
    return out
