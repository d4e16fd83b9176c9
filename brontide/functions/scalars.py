"""Column functions for trades, quantities, clocks and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Price step by market; 0.01 elsewhere.
TICK_SIZE = {
    "binance_spot": 0.01, "bybit_spot": 0.01, "okx_spot": 0.01, "coinbase_spot": 0.01, "kraken_spot": 0.01,
    "bitget_spot": 0.01, "mexc_spot": 0.01, "htX_spot": 0.01, "bitfinex_spot": 0.01,
    "binance_perp": 1.0, "bybit_perp": 0.1, "okx_perp": 0.1, "dYdX_perp": 0.1, "hyperliquid_perp": 0.1,
    "kraken_perp": 0.1, "bitfinex_perp": 0.1,
}
#: Markets whose book quantities are contracts, and what one contract is worth.
CONTRACTS = {"okx_perp": ("btc", 0.01), "bitmex_perp": ("usd", 1.0), "binance_coinm_perp": ("usd", 100.0)}
#: Markets whose book quantities are BTC.
BTC_MARKETS = (
    "binance_spot", "binance_spot_usdc", "bybit_spot", "okx_spot", "coinbase_spot", "kraken_spot", "bitstamp_spot",
    "crypto_com_spot", "bitfinex_spot", "binance_perp", "binance_perp_btcusdc", "bybit_perp", "hyperliquid_perp",
)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def valid_trade(price: Column, qty: Column, side: Column, ts: Column) -> Column:
    """Finite time, positive finite price and quantity, known side."""
    return F.coalesce(ts.isNotNull() & finite(price) & (price > 0) & finite(qty) & (qty > 0) & side.isin("buy", "sell"), F.lit(False))


def window_start(ts: Column, width: int) -> Column:
    """Start of the half-open, epoch-aligned window of ``width`` ms."""
    return ts - F.pmod(ts, F.lit(width))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds of a timestamp by the magnitude of its unit: s, ms, us or ns; floored; null beyond."""
    ts = ts.cast("double")
    a = F.abs(ts)
    scaled = F.when(a < 1e11, ts * 1000).when(a < 1e14, ts).when(a < 1e17, ts / 1000).when(a < 1e20, ts / 1000000)
    return F.floor(scaled).cast("long")


def size_class(notional: Column) -> Column:
    """small below 1,000, medium below 10,000, else large."""
    return F.when(notional < 1_000, "small").when(notional < 10_000, "medium").otherwise("large")


def signed(side: Column, x: Column) -> Column:
    return F.when(side == "buy", x).otherwise(-x)


def non_negative(text: Column) -> Column:
    """A number that is not negative; null for '', booleans, other text and negative values."""
    x = text.cast("string").try_cast("double")
    return F.when(finite(x) & (x >= 0), x)


def exchange_of(market: Column) -> Column:
    """The exchange part of a market name."""
    return F.regexp_replace(market, r"_(spot|perp|coinm_perp)(_.*)?$", "")


def tick_size(market: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in TICK_SIZE.items() for x in pair))
    return F.coalesce(F.try_element_at(table, market), F.lit(0.01))


def btc_quantity(market: Column, price: Column, qty: Column) -> Column:
    """A book quantity in BTC: 0 stays 0, contracts are converted, null where that isn't possible or the market is unknown."""
    p, q = price.cast("string").try_cast("double"), F.when(qty.cast("string") == "", 0.0).otherwise(qty.cast("string").try_cast("double"))
    rate = F.lit(None).cast("double")
    for name, (unit, worth) in CONTRACTS.items():
        rate = F.when(market == name, q * worth if unit == "btc" else q * worth / p).otherwise(rate)
    rate = F.when(market.isin(*BTC_MARKETS), q).otherwise(rate)
    return F.when(q == 0, 0.0).when(finite(p) & (p > 0) & finite(q) & (q > 0), rate)


def interval_ms(text: str) -> int:
    """Milliseconds of an interval such as 1s, 5m, 1h or 1d."""
    units = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
    number, unit = text[:-1], text[-1:].lower()
    if unit not in units or not number.isdigit() or int(number) < 1:
        raise ValueError(f"not an interval: {text!r}")
    return int(number) * units[unit]


def interval_name(ms: int) -> str:
    """The shortest name of an interval; the inverse of interval_ms."""
    for unit, size in (("d", 86_400_000), ("h", 3_600_000), ("m", 60_000), ("s", 1_000)):
        if ms >= size and ms % size == 0:
            return f"{ms // size}{unit}"
    raise ValueError(f"not a whole number of seconds: {ms}")
