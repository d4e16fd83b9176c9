"""Streams against their batch twins."""

from brontide.operators import bursts, trades
from brontide.streaming import live

from .test_operators import tape

ROWS = [("m", 10, "buy", 100, 1), ("m", 20, "buy", 101, 1), ("m", 400, "sell", 99, 2), ("m", 1500, "sell", 98, 1), ("n", 100, "buy", 5, 1), ("m", 600_000, "buy", 1, 1), ("n", 600_000, "buy", 1, 1)]


def drained(stream, spark, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
        return spark.table(name).collect()
    finally:
        q.stop()


def source(spark, tmp_path, rows, name):
    path = str(tmp_path / name)
    t = tape(spark, rows)
    t.coalesce(1).write.parquet(path)
    return spark.readStream.schema(t.schema).parquet(path), t


def test_bars(spark, tmp_path):
    stream, batch = source(spark, tmp_path, ROWS, "a")
    got = {(r.market, r.ts): (r.open, r.close, r.trades) for r in drained(live.live_bars(stream, delay="1 second"), spark, "bars", "complete")}
    assert got == {(r.market, r.ts): (r.open, r.close, r.trades) for r in trades.bars(batch).collect()}


def test_bursts(spark, tmp_path):
    stream, batch = source(spark, tmp_path, ROWS, "b")
    got = {(r.market, r.start, r.side, r.prints, r.notional) for r in drained(live.live_bursts(stream, delay="1 second"), spark, "bursts")}
    want = {(r.market, r.start, r.side, r.prints, r.notional) for r in bursts.bursts(batch).collect()}
    assert {x for x in want if x[1] < 600_000} <= got <= want


def test_late_rows_are_kept(spark, tmp_path):
    put = live.late_splitter(str(tmp_path / "on"), str(tmp_path / "late"), 1000)
    put(tape(spark, [("m", 10_000, "buy", 1, 1)]), 0)
    for _ in range(2):  # a batch that runs again changes nothing
        put(tape(spark, [("m", 9_500, "buy", 1, 1), ("m", 10, "buy", 1, 1)]), 1)
    assert sorted(r.ts for r in spark.read.parquet(str(tmp_path / "on")).collect()) == [9_500, 10_000]
    assert [r.ts for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [10]


def test_duplicates_within_the_watermark(spark, tmp_path):
    stream, _ = source(spark, tmp_path, [("m", 1, "buy", 1, 1), ("m", 1, "buy", 1, 1), ("m", 2, "buy", 1, 1)], "c")
    assert len(drained(live.live_distinct(stream, ["market", "ts"]), spark, "fresh")) == 2


def test_book_rules():
    b = live.Book()
    up = lambda seq, **k: {"type": "update", "seq": seq, **k}
    assert not b.apply(up(1, bids=[("1", "1")]))
    assert b.apply({"type": "snapshot", "seq": 10, "bids": [("100", "2")], "asks": [("101", "3")]}) and b.quote() == (100.0, 2.0, 101.0, 3.0)
    assert b.apply(up(11, prev_seq=10, bids=[("100", "0"), ("99", "1")])) and b.quote()[:2] == (99.0, 1.0)
    assert not b.apply(up(11, bids=[("98", "1")]))
    assert b.apply(up(13, prev_seq=12)) and b.status == "quarantine" and not b.apply(up(14))
    c = live.Book()
    c.apply({"type": "snapshot", "seq": 1, "bids": [("2", "1")], "asks": [("1", "1")]})
    assert c.status == "quarantine"


def test_quotes(spark, tmp_path):
    schema = "market string, ts long, type string, seq long, seq_start long, prev_seq long, bids array<struct<price:string,qty:string>>, asks array<struct<price:string,qty:string>>"
    rows = [("m", 1, "snapshot", 10, None, None, [("100", "2")], [("101", "3")]), ("m", 2, "update", 11, None, 10, [("100", "5")], []), ("m", 3, "update", 11, None, 10, [], [])]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    got = [(r.ts, r.status, r.best_bid, r.bid_qty, r.best_ask) for r in drained(live.live_quotes(spark.readStream.schema(schema).parquet(path)), spark, "quotes")]
    assert sorted(got) == [(1, "seeded", 100.0, 2.0, 101.0), (2, "seeded", 100.0, 5.0, 101.0)]
