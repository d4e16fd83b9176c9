"""Mixing sources to target weights by nested hash-threshold histograms.

A document's place in its source is a 60-bit hash. The words to take beyond whole copies of a source
are those of the documents below a threshold. It is found without sorting: sum words by source and
the leading 12 bits of the hash, find the bucket in which the running sum passes the budget, look
into that bucket alone by the next 12 bits, and so on until it holds one hash value. Rows are then
taken by comparing their hash with their source's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import staged

BITS, DEPTH = 12, 5
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """60 bits that depend on the id alone (without one, on the text): the leading 15 hexadecimal digits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), text, F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, target for rows (source, source_size): one row per source, all in one task (sources are few).

    Sources in code-point order, null last, weigh ``weights`` in turn and share all words; a target
    stops at ``most`` times its source, and what is above goes to the others by weight. That is
    min(cap, level * weight) with one level for all, found from running sums in order of cap / weight.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("fills_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (total - capped) / open_weight)
    rows = rows.withColumn("turn", F.row_number().over(order))
    # the level follows from the first source, in order of filling, that isn't capped
    level = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("turn", "level"))).over(Window.partitionBy())["level"]
    return rows.withColumn("at", F.coalesce(level, F.lit(0.0))).select("source", "source_size", F.least("cap", F.col("at") * F.col("weight")).alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, copies, below: a document is taken ``copies`` times, and once more if its place <= below."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("copies", whole).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    state = state.withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(None).cast("long")})
    state = staged(state, "mix")
    for depth in range(DEPTH):
        shift = BITS * (DEPTH - 1 - depth)
        ask = state.where("below is null").select(F.col("source").alias("s"), "prefix", "budget")
        near = rows.join(ask, rows["source"].eqNullSafe(ask["s"]) & (F.shiftright("place", shift + BITS) == F.col("prefix")))
        bucket = F.shiftright("place", shift)
        sums = near.groupBy("source", "budget", bucket.alias("bucket")).agg(F.sum("size").alias("n"), F.min("place").alias("low"), F.max("place").alias("high"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        passed = sums.withColumn("upto", upto).where(F.col("upto") > F.col("budget"))
        first = passed.groupBy("source").agg(F.min_by(F.struct("bucket", "n", "low", "high", "upto"), "bucket").alias("f")).select(F.col("source").alias("s"), "f.*")
        joined = state.join(first, state["source"].eqNullSafe(first["s"]), "left")
        prior = F.col("upto") - F.col("n")
        nearer = F.when(F.col("upto") - F.col("budget") < F.col("budget") - prior, F.col("high")).otherwise(F.col("low") - 1)
        decided = F.when(F.col("below").isNotNull(), F.col("below")).when(F.col("bucket").isNull(), F.lit((1 << 60) - 1)).when(F.col("low") == F.col("high"), nearer)
        state = staged(
            joined.select("source", "source_size", "target", "copies", F.when(F.col("bucket").isNull(), F.col("budget")).otherwise(F.col("budget") - prior).alias("budget"), F.coalesce("bucket", "prefix").alias("prefix"), decided.cast("long").alias("below")),
            "mix",
        )
        if state.where("below is null").isEmpty():
            break
    return state.select("source", "source_size", "target", "copies", "below")


def mixture(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(rows, thresholds): doc_id, source, size, place of each document, and the table of ``thresholds``."""
    rows = staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return rows, thresholds(rows, source_targets(sizes, weights, most))


def taken_words(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``docs``.

    A null or empty text has size 0; null is a source of its own, last in order. Rows with the same
    doc_id have the same place, so they are taken together; rows without one go by their text. Reruns agree: nothing depends on order or
    partitions. Other columns are not read; an empty table gives no rows.
    """
    rows, limits = mixture(docs, weights, most)
    limits = limits.withColumnRenamed("source", "s")
    taken = F.col("size") * (F.col("copies") + (F.col("place") <= F.col("below")).cast("long"))
    return rows.join(limits, rows["source"].eqNullSafe(limits["s"])).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it (perhaps not at all)."""
    _, limits = mixture(docs, weights, most)
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    limits = limits.select(F.struct("source", "copies", "below").alias("limit"))
    joined = row.join(limits, F.col("row.source").eqNullSafe(F.col("limit.source")))
    times = F.col("limit.copies") + (place(F.col("row.doc_id"), F.col("row.text")) <= F.col("limit.below")).cast("long")
    return joined.where(times > 0).select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
c AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS fills_at FROM w),
l AS (SELECT *, row_number() OVER (ORDER BY fills_at, source NULLS LAST) AS turn, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, turn) FROM l WHERE level <= fills_at), 0) * weight) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
h AS (SELECT source, place, sum(size)::BIGINT AS n FROM d GROUP BY ALL),
r AS (SELECT h.*, b.target - b.copies * b.source_size AS budget, sum(n) OVER (PARTITION BY h.source ORDER BY place) AS upto
      FROM h JOIN b ON h.source IS NOT DISTINCT FROM b.source),
k AS (SELECT source, place, (upto <= budget OR (upto - n <= budget AND upto - budget < budget - (upto - n)))::INT AS extra FROM r)
SELECT d.doc_id, d.size, b.source_size, b.target, (d.size * (b.copies + k.extra))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.place = k.place
"""
