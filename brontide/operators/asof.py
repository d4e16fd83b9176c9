"""As-of and interval joins without range predicates."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import by_day, with_last


def as_of(anchors: DataFrame, samples: DataFrame, by: list[str], values: list[str], order: str, strict: bool = False) -> DataFrame:
    """Each anchor with ``values`` of the latest sample of its key before it (``strict``) or up to it.

    Both sides have ``by`` and ts; samples have ``order`` to rank equal times (the later wins). The two
    are put in one sequence per key and day, sorted once, and the last sample is carried along, from
    day to day by one row each: work and memory do not depend on how many samples an anchor could see,
    nor is a key one task. sample_ts is null without one.
    """
    first, second = (1, 0) if not strict else (0, 1)
    extra = [c for c in anchors.columns if c not in (*by, "ts")]
    left = anchors.select(*by, "ts", F.struct(*extra).alias("_a"), F.lit(None).alias("_s"), F.lit(first).alias("_k"), F.lit(None).cast("long").alias("_o"))
    right = samples.select(*by, "ts", F.lit(None).alias("_a"), F.struct(F.col("ts").alias("sample_ts"), *values).alias("_s"), F.lit(second).alias("_k"), F.col(order).cast("long").alias("_o"))
    rows = left.select(*by, "ts", "_a", F.lit(None).cast(right.schema["_s"].dataType).alias("_s"), "_k", "_o").unionByName(right.select(*by, "ts", F.lit(None).cast(left.schema["_a"].dataType).alias("_a"), "_s", "_k", "_o"))
    out = with_last(rows, by, ["ts", "_k", "_o"], "_s", F.col("_s"), by_day()).where("_a is not null")
    return out.select(*by, "ts", "_a.*", "_s.sample_ts", *(f"_s.{v}" for v in values))


def narrowest_interval(points: DataFrame, intervals: DataFrame, by: list[str], grain: int) -> DataFrame:
    """Each point with the narrowest interval [lo, hi] that holds it, the lowest interval_id of equals; null without one.

    Intervals are dealt to the grains of time that they touch; points and intervals of a key and grain are one sequence,
    sorted once and streamed. Pairs of a point and an interval that holds it are never rows: the state are the open
    intervals that can still be a narrowest one.
    """
    extra = [c for c in points.columns if c not in (*by, "ts")]
    own = points.select(*by, F.floor(F.col("ts") / grain).alias("_g"), "ts", F.lit(1).alias("_k"), F.struct(*extra).alias("_p"))
    known = intervals.select(*by, F.col("lo").cast("long"), F.col("hi").cast("long"), F.col("interval_id").cast("long")).dropna().where("lo <= hi")
    cells = F.explode(F.sequence(F.floor(F.col("lo") / grain), F.floor(F.col("hi") / grain))).alias("_g")
    held = known.select(*by, cells, F.col("lo").alias("ts"), F.lit(0).alias("_k"), F.struct("lo", "hi", "interval_id").alias("_i"))
    rows = own.withColumn("_i", F.lit(None).cast(held.schema["_i"].dataType)).unionByName(held.withColumn("_p", F.lit(None).cast(own.schema["_p"].dataType)))
    keys = [*by, "_g"]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_ = None, Narrowest()
        for batch in batches:
            table = zip(zip(*(batch.column(c).to_pylist() for c in keys), strict=True), batch.column("ts").to_pylist(), *(batch.column("_i").field(c).to_pylist() for c in ("lo", "hi", "interval_id")), strict=True)
            best = []
            for k, ts, lo, hi, number in table:
                if k != key:
                    key, open_ = k, Narrowest()
                if lo is None:
                    best.append(open_.at(ts))
                else:
                    open_.add(hi - lo, number, hi)
            chosen = batch.filter(pc.equal(batch.column("_k"), 1))
            yield pa.RecordBatch.from_arrays([*(chosen.column(c) for c in (*by, "ts", "_p")), pa.array(best, pa.int64())], [*by, "ts", "_p", "interval_id"])

    fields = [*(own.schema[c] for c in (*by, "ts", "_p"))]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).add("interval_id", "long")
    out = rows.repartition(*keys).sortWithinPartitions(*keys, "ts", "_k").mapInArrow(told, schema)
    return out.select(*(F.col(f"_p.{c}") if c in extra else c for c in points.columns), "interval_id")


class Narrowest:
    """Open intervals in ascending order of both (width, number) and end; one that ends no later than a narrower one is dropped."""

    def __init__(self):
        self.ranks: list[tuple[int, int]] = []
        self.ends: list[int] = []
        self.gone = 0

    def add(self, width: int, number: int, end: int) -> None:
        rank = (width, number)
        at = bisect_left(self.ranks, rank, self.gone)
        if at > self.gone and self.ends[at - 1] >= end:
            return
        last = bisect_right(self.ends, end, at)
        self.ranks[at:last], self.ends[at:last] = [rank], [end]

    def at(self, ts: int) -> int | None:
        """The number of the first that ends no earlier than ``ts``, which never falls."""
        while self.gone < len(self.ends) and self.ends[self.gone] < ts:
            self.gone += 1
        if self.gone > 1000 and 2 * self.gone > len(self.ends):
            del self.ranks[: self.gone], self.ends[: self.gone]
            self.gone = 0
        return self.ranks[self.gone][1] if self.gone < len(self.ends) else None


def snapshot_diff(old: DataFrame, new: DataFrame, by: list[str], value: str) -> DataFrame:
    """Keys whose value differs between two snapshots; what is missing from the new one has value 0."""
    joined = old.select(*by, F.col(value).alias("_old")).join(new.select(*by, F.col(value).alias("_new")), by, "full_outer")
    return joined.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*by, F.coalesce("_new", F.lit(0.0)).alias(value))


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``, by a minimum with partial aggregation."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def fresh_only(rows: DataFrame, committed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't committed yet, one for each key."""
    return rows.join(committed.select(*keys).distinct(), keys, "left_anti")
