"""Open interest: normalised samples and their as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite
from .asof import as_of

#: Native unit and the worth of one unit, by market; null where only source values count.
CAPABILITY = {
    "binance_perp": ("BTC", 1.0, None), "bitmex_perp": ("contract", None, 1.0), "binance_perp_btcusdc": ("BTC", 1.0, None),
    "bybit_perp": ("BTC", 1.0, None), "okx_perp": ("contract", None, None), "hyperliquid_perp": ("BTC", 1.0, None),
}
MAX_AGE_MS, SKEW_MS, MISMATCH = 30_000, 2_000, 0.01


def _number(x: Column) -> Column:
    y = x.cast("string").try_cast("double")
    return F.when(finite(y), y)


def normalized(samples: DataFrame, now: Column, max_age: int = MAX_AGE_MS, skew: int = SKEW_MS, mismatch: float = MISMATCH) -> DataFrame:
    """Samples (market, as_of_ms, native, btc, usd, price_usd) with status, age_ms, oi_btc, oi_usd and error_code.

    Source values win over conversion; both must agree with the price within ``mismatch``. A lead of at
    most ``skew`` over the clock is taken as now; more is an error.
    """
    table = F.create_map(*(x for m, (_, btc, usd) in CAPABILITY.items() for x in (F.lit(m), F.struct(F.lit(btc).cast("double").alias("btc"), F.lit(usd).cast("double").alias("usd")))))
    rows = samples.withColumns({"_c": F.try_element_at(table, F.col("market")), "_n": _number(F.col("native")), "_b": _number(F.col("btc")), "_u": _number(F.col("usd")), "_p": _number(F.col("price_usd"))})
    n, b, u, p = (F.col(c) for c in ("_n", "_b", "_u", "_p"))
    priced = F.coalesce(p > 0, F.lit(False))
    converted = F.coalesce(n * F.col("_c.btc"), n * F.col("_c.usd") / p)
    btc = F.when(b.isNotNull(), b).when(u.isNotNull(), u / p).otherwise(converted)
    usd = F.when(u.isNotNull(), u).when(b.isNotNull(), b * p).otherwise(converted * p)
    lead = F.col("as_of_ms") - now
    as_of_ms = F.when((lead > 0) & (lead <= skew), now).otherwise(F.col("as_of_ms"))
    both = b.isNotNull() & u.isNotNull()
    code = (
        F.when(F.col("_c").isNull(), "oi_not_supported").when(F.col("as_of_ms").isNull(), "invalid_timestamp")
        .when((n < 0) | (b < 0) | (u < 0) | (n.isNull() & b.isNull() & u.isNull()), "invalid_open_interest")
        .when(both & priced & (F.abs(b * p - u) / F.greatest(F.abs(u), F.lit(1e-9)) > mismatch), "oi_mismatch")
        .when(~both & ~priced, "missing_price").when(~both & b.isNull() & u.isNull() & converted.isNull(), "unsupported_native_unit")
        .when(lead > skew, "future_sample")
    )
    rows = rows.withColumns({"error_code": code, "age_ms": now - as_of_ms})
    good = F.col("error_code").isNull()
    rows = rows.withColumns({"oi_btc": F.when(good, btc), "oi_usd": F.when(good, usd), "status": F.when(~good, "error").when(F.col("age_ms") <= max_age, "fresh").otherwise("stale")})
    return rows.withColumn("age_ms", F.when(good, F.col("age_ms"))).drop("_c", "_n", "_b", "_u", "_p")


def at_anchors(anchors: DataFrame, samples: DataFrame, max_age: int, order: str = "idx") -> DataFrame:
    """The latest sample (market, ts, oi) up to each anchor; status none, stale (value withheld) or fresh."""
    rows = as_of(anchors, samples, ["market"], ["oi"], order)
    age = F.col("ts") - F.col("sample_ts")
    status = F.when(F.col("sample_ts").isNull(), "none").when(age > max_age, "stale").otherwise("fresh")
    return rows.withColumn("age", age).withColumn("status", status).withColumn("oi", F.when(F.col("status") == "fresh", F.col("oi")))
