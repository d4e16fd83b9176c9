import random

from brontide.operators import asof


def test_narrowest_interval_agrees_with_all_pairs(spark):
    r = random.Random(5)
    points = [(i, r.choice(["a", "b", None]), r.randrange(-500, 3000)) for i in range(600)] + [(600, "a", None), (7, "a", 100), (7, "a", 100)]
    intervals = [(r.choice(["a", "b", None]), lo, lo + r.choice([0, 3, 40, 40, 700]), i) for i in range(120) for lo in [r.randrange(-400, 2500)]] + [("a", 5, 2, 999), ("a", 0, 9, None)]
    p = spark.createDataFrame(points, "idx long, market string, ts long")
    i = spark.createDataFrame(intervals, "market string, lo long, hi long, interval_id long")
    want = []
    for idx, market, ts in points:
        held = [(hi - lo, k) for m, lo, hi, k in intervals if m is not None and m == market and ts is not None and k is not None and lo <= ts <= hi]
        want.append((idx, market, ts, min(held)[1] if held else None))
    out = asof.narrowest_interval(p, i, ["market"], 64)
    assert out.columns == ["idx", "market", "ts", "interval_id"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_pairs_of_a_point_and_an_interval_are_never_rows(spark):
    """1,000 points in each of 1,000 intervals: the plan's nodes make rows in proportion to both, not to their product."""
    n = 1_000
    p = spark.range(n).selectExpr("id AS idx", "'a' AS market", "id + 1000 AS ts")
    i = spark.range(n).selectExpr("'a' AS market", "id AS lo", "id + 2000 AS hi", "id + 1 AS interval_id")
    out = asof.narrowest_interval(p, i, ["market"], 10_000)
    assert sorted({x.interval_id for x in out.collect()}) == [1]

    def rows(node):
        own = [node.metrics().get("numOutputRows").get().value()] if node.metrics().contains("numOutputRows") else []
        kind = node.getClass().getSimpleName()
        inner = "executedPlan" if kind == "AdaptiveSparkPlanExec" else "plan" if kind.endswith("QueryStageExec") else None
        below = [getattr(node, inner)()] if inner else [node.children().apply(k) for k in range(node.children().size())]
        return own + [x for b in below for x in rows(b)]

    assert 0 < max(rows(out._jdf.queryExecution().executedPlan())) <= 4 * n
