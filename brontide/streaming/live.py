"""Streaming forms of the operators: windowed bars, late rows, deduplication, bursts and book replay."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.bursts import CAP_MS, GAP_MS


def with_event_time(trades: DataFrame, delay: str = "30 seconds") -> DataFrame:
    """``trades`` with event_time from ts (ms) and a watermark on it."""
    return trades.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)


def live_bars(trades: DataFrame, width: str = "1 second", delay: str = "30 seconds") -> DataFrame:
    """OHLC, count and quantity by market and tumbling window; a window is final once the watermark has passed it."""
    key = F.struct("ts", "idx")
    return with_event_time(trades, delay).groupBy("market", F.window("event_time", width).alias("w")).agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"), F.count("*").alias("trades"), F.sum("qty").alias("qty")
    ).select("market", F.unix_millis("w.start").alias("ts"), "open", "high", "low", "close", "trades", "qty")


def live_distinct(rows: DataFrame, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """First row of each key within the watermark."""
    return with_event_time(rows, delay).dropDuplicatesWithinWatermark(keys)


def late_splitter(table: str, late_table: str, delay_ms: int):
    """A foreachBatch function that keeps late rows: those behind the latest time so far by more than ``delay_ms`` go to their own table.

    Batches are idempotent: each writes its own batch_id partition, replaced if it runs again. The
    latest time so far is read from what earlier batches wrote.
    """
    from ..sources.sinks import _read

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _read(spark, table)
        seen = before.where(F.col("batch_id") < batch_id).agg(F.max("ts")).first()[0] if before is not None else None
        late = F.lit(False) if seen is None else F.col("ts") < F.lit(seen - delay_ms)
        rows = batch.withColumn("batch_id", F.lit(batch_id))
        for path, part in ((table, rows.where(~late)), (late_table, rows.where(late))):
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return put


BURST = "market string, side string, start long, end long, notional double, prints long, low double, high double"


def live_bursts(trades: DataFrame, gap: int = GAP_MS, cap: int = CAP_MS, delay: str = "30 seconds") -> DataFrame:
    """Closed bursts per market. Trades of a batch are taken in (ts, idx) order; an open burst is closed by the next trade or when the watermark passes its gap."""

    def run(key: tuple, parts: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        burst, closed = (state.get if state.exists else None), []
        if state.hasTimedOut:
            closed.append(burst)
            state.remove()
        else:
            rows = pd.concat(list(parts)).sort_values(["ts", "idx"], kind="stable")
            for ts, side, price, qty in rows[["ts", "side", "price", "qty"]].itertuples(index=False):
                if burst is not None:
                    last_side, start, end, value, n, low, high = burst
                    if side == last_side and ts - end <= gap and ts - start <= cap:
                        burst = (side, start, int(ts), value + price * qty, n + 1, min(low, price), max(high, price))
                        continue
                    closed.append(burst)
                burst = (side, int(ts), int(ts), float(price * qty), 1, float(price), float(price))
            state.update(burst)
            state.setTimeoutTimestamp(max(int(burst[2]) + gap + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *b) for b in closed], columns=[x.split()[0] for x in BURST.split(", ")])

    store = "side string, start long, end long, value double, n long, low double, high double"
    return with_event_time(trades, delay).groupBy("market").applyInPandasWithState(run, BURST, store, "append", GroupStateTimeout.EventTimeTimeout)


QUOTE = "market string, ts long, seq long, status string, best_bid double, bid_qty double, best_ask double, ask_qty double"


class Book:
    """One market's book. Stale repeats are ignored; a malformed level, a gap or a crossed book puts it in quarantine until the end."""

    def __init__(self, status: str = "unseeded", seq: int | None = None, bids: dict | None = None, asks: dict | None = None):
        self.status, self.seq, self.sides = status, seq, {"bids": bids or {}, "asks": asks or {}}

    def apply(self, event: dict) -> bool:
        """Take one event; whether it changed anything."""
        if self.status == "quarantine":
            return False
        snapshot, seq = event["type"] == "snapshot", event.get("seq")
        if not snapshot and self.status == "unseeded":
            return False
        if not snapshot and seq is not None and self.seq is not None:
            if seq <= self.seq:
                return False
            start, prev = event.get("seq_start"), event.get("prev_seq")
            follows = start <= self.seq + 1 if start is not None else prev == self.seq if prev is not None else seq == self.seq + 1
            if not follows:
                self.status = "quarantine"
                return True
        fresh = {s: ({} if snapshot else dict(self.sides[s])) for s in self.sides}
        for s in fresh:
            for price, qty in event.get(s) or []:
                try:
                    p, q = float(price), float(qty)
                except (TypeError, ValueError):
                    p, q = 0.0, -1.0
                if not (p > 0 and q >= 0 and p < float("inf") and q < float("inf")):
                    self.status = "quarantine"
                    return True
                fresh[s].pop(p, None)
                if q:
                    fresh[s][p] = q
        self.sides, self.seq = fresh, seq if seq is not None else self.seq
        crossed = self.sides["bids"] and self.sides["asks"] and max(self.sides["bids"]) >= min(self.sides["asks"])
        self.status = "quarantine" if crossed else "seeded"
        return True

    def quote(self) -> tuple:
        b, a = self.sides["bids"], self.sides["asks"]
        if self.status != "seeded" or not b or not a:
            return (None,) * 4
        return max(b), b[max(b)], min(a), a[min(a)]


def live_quotes(events: DataFrame) -> DataFrame:
    """Best quotes after each event (market, ts, type, seq, seq_start, prev_seq, bids, asks), by stateful replay per market."""

    def run(key: tuple, parts: Iterator, state: GroupState) -> Iterator:
        import json

        import pandas as pd

        saved = json.loads(state.get[0]) if state.exists else None
        book = Book(saved["status"], saved["seq"], *({float(p): q for p, q in saved[s].items()} for s in ("bids", "asks"))) if saved else Book()
        rows = pd.concat(list(parts))
        rows["_k"] = (rows["type"] != "snapshot").astype(int)
        out = []
        for r in rows.sort_values(["ts", "_k", "seq"], kind="stable").to_dict("records"):
            event = {k: (None if not isinstance(v, str) and not hasattr(v, "__len__") and pd.isna(v) else v) for k, v in r.items()}
            for s in ("bids", "asks"):
                event[s] = [(x["price"], x["qty"]) for x in (event[s] if event[s] is not None else [])]
            if book.apply(event):
                out.append((key[0], event["ts"], event["seq"], book.status, *book.quote()))
        state.update((json.dumps({"status": book.status, "seq": None if book.seq is None else int(book.seq)} | book.sides),))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in QUOTE.split(", ")])

    return events.groupBy("market").applyInPandasWithState(run, QUOTE, "book string", "append", GroupStateTimeout.NoTimeout)


def status_changes(rows: DataFrame) -> DataFrame:
    """market, ts, state, before of each change of state in rows (market, ts, state)."""
    from pyspark.sql import Window

    before = F.lag("state").over(Window.partitionBy("market").orderBy("ts"))
    return rows.withColumn("before", before).where(~F.col("before").eqNullSafe(F.col("state"))).select("market", "ts", "state", "before")
