from brontide.plans import catalogue
from brontide.sources import tables as T

from .conftest import SMALL


def test_every_trade_gets_its_narrowest_batch(spark):
    got = {r.idx: r.interval_id for r in catalogue.QUERIES["late_to_batch"](spark, SMALL).collect()}
    batches = {}
    trades = sorted((r.market, r.ts, r.idx, r.side) for r in T.tape(spark, SMALL).collect())
    for market, ts, _, side in trades:
        b = batches.setdefault(market, [])
        if not b or side != b[-1][2] or ts - b[-1][1] > catalogue.GAP or ts - b[-1][0] > catalogue.CAP:
            b.append([ts, ts, side])
        b[-1][1] = ts
    want = {}
    for market, ts, idx, _ in trades:
        held = [(end + catalogue.HOUR - start, k) for k, (start, end, _) in enumerate(batches[market], 1) if start <= ts <= end + catalogue.HOUR]
        want[idx] = min(held)[1] if held else None
    assert got == want and any(i % 3 for i in got)
