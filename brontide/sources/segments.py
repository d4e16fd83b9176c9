"""Line files that grow: stable block files, hourly segments with byte offsets, reading on from a cursor, logs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import BLOCK_MS

#: Fixed value: the name of an hourly segment, which is renamed when it is closed.
SEGMENT = r"/([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})/(\d{2})\.jsonl(\.active)?$"
_ENVELOPE = "market string, kind string, event_ts long, seq long, payload string"
_LEVEL = "array<array<string>>"


def stable(files: DataFrame, min_age_ms: int, now_ms: int | None = None) -> DataFrame:
    """Rows of files that nobody has written to for ``min_age_ms``; ``files`` is read by a reader with file metadata."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)
    return files.where(now - F.unix_millis(F.col("_metadata.file_modification_time")) >= min_age_ms)


def discovered(spark: SparkSession, root: str, kind: str, min_age_ms: int = 0, now_ms: int | None = None) -> DataFrame:
    """market, date, path, bytes of the block files <root>/<kind>/<market>/<date>/*.jsonl that are stable; no content is read."""
    rows = spark.read.format("binaryFile").load(f"{root}/{kind}/*/*/*.jsonl").select("path", "length", F.unix_millis("modificationTime").alias("changed"))
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)
    part = lambda i: F.regexp_extract("path", r"/([^/]+)/(\d{4}-\d{2}-\d{2})/[^/]+$", i)
    return rows.where(now - F.col("changed") >= min_age_ms).select(part(1).alias("market"), part(2).alias("date"), "path", F.col("length").alias("bytes"))


def book_updates(lines: DataFrame) -> DataFrame:
    """market, block_ms, ts, type, seq, bids, asks from lines of book block files (market, block_ms, line); malformed ones go."""
    j = F.from_json("line", f"ts long, type string, seq long, bids {_LEVEL}, asks {_LEVEL}")
    rows = lines.withColumn("j", j).where("j.ts is not null and j.type in ('snapshot', 'update')")
    return rows.select("market", "block_ms", *(F.col(f"j.{c}").alias(c) for c in ("ts", "type", "seq", "bids", "asks")))


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, line_no, offset (bytes before the line), bytes (with its line break), line, whole (ended by a line break) of each line.

    A file is read as a stream by one task, as its offsets follow from all lines before; files are far smaller than a partition.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                lines = content.split(b"\n")
                ended = [True] * (len(lines) - 1) + [False]
                if not lines[-1]:
                    lines, ended = lines[:-1], ended[:-1]
                sizes, at, starts = [len(x) + e for x, e in zip(lines, ended, strict=True)], 0, []
                for size in sizes:
                    starts.append(at)
                    at += size
                for k in range(0, len(lines), 10_000):
                    part = lines[k : k + 10_000]
                    columns = [pa.array([path] * len(part)), pa.array(range(k, k + len(part)), pa.int64()), pa.array(starts[k : k + 10_000], pa.int64()), pa.array(sizes[k : k + 10_000], pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([x.decode("utf-8", "replace") for x in part], pa.string()), pa.array(ended[k : k + 10_000], pa.bool_())], ["path", "line_no", "offset", "bytes", "line", "whole"])

    return files.mapInArrow(told, "path string, line_no long, offset long, bytes long, line string, whole boolean")


def segment_key(path: str = "path") -> Column:
    """A segment's name without the mark of an open one, so that closing it doesn't make it another."""
    return F.regexp_replace(path, r"\.active$", "")


def read_segments(spark: SparkSession, root: str, kind: str, cursor: DataFrame | None = None, market: str = "*") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, invalid, cursor) of the hourly segments <root>/<market>/<kind>/<date>/<HH>.jsonl[.active].

    Records are envelopes with where they stand (segment, offset). Of each segment only whole lines beyond ``cursor``
    (segment, offset) are given; the new cursor is where they end. A segment shorter than its cursor ends the job.
    """
    lines = numbered_lines(spark, [f"{root}/{market}/{kind}/*/*.jsonl*"]).withColumn("segment", segment_key())
    sizes = lines.groupBy("segment").agg(F.max(F.col("offset") + F.col("bytes")).alias("size"), F.coalesce(F.max(F.when(F.col("whole"), F.col("offset") + F.col("bytes"))), F.lit(0)).alias("end"))
    start = F.lit(0).cast("long")
    if cursor is not None:
        lines = lines.join(cursor.select("segment", F.col("offset").alias("start")), "segment", "left")
        sizes = sizes.join(cursor.select("segment", F.col("offset").alias("start")), "segment", "left")
        shrunk = F.raise_error(F.concat(F.lit("a segment is shorter than its cursor: "), F.col("segment"))).cast("long")
        sizes = sizes.withColumn("end", F.when(F.coalesce(F.col("size") < F.col("start"), F.lit(False)), shrunk).otherwise(F.col("end")))
        start = F.coalesce("start", start)
    new = lines.where(F.col("whole") & (F.col("offset") >= start)).withColumn("j", F.from_json("line", _ENVELOPE))
    good = F.col("j.market").isNotNull() & F.col("j.kind").isNotNull() & F.col("j.event_ts").isNotNull()
    records = new.where(good).select("segment", "offset", "j.*")
    return records, new.where(~good).select("segment", "offset", "line"), sizes.select("segment", F.col("end").alias("offset"))


def envelope_blocks(records: DataFrame, from_ms: int, to_ms: int, width: int = BLOCK_MS) -> DataFrame:
    """market, block_ms, lines, sha256, first and last place of the envelopes of each virtual block in [from, to); blocks without any are there with 0."""
    place = F.struct("segment", "offset")
    rows = records.where((F.col("event_ts") >= from_ms) & (F.col("event_ts") < to_ms))
    parts = rows.groupBy("market", (F.col("event_ts") - F.pmod("event_ts", F.lit(width))).alias("block_ms")).agg(
        F.count("*").alias("lines"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "offset", "payload"))), lambda x: x["payload"]), "\n"), 256).alias("sha256"), F.min(place).alias("first"), F.max(place).alias("last"))
    grid = records.select("market").distinct().select("market", F.explode(F.sequence(F.lit(from_ms - from_ms % width), F.lit(to_ms - 1), F.lit(width))).alias("block_ms"))
    return grid.join(parts, ["market", "block_ms"], "left").na.fill(0, ["lines"])


def read_json(spark: SparkSession, paths: str | list[str], schema: str | None = None) -> DataFrame:
    """JSON lines with an inferred schema, or with ``schema``, malformed lines left out."""
    return spark.read.json(paths) if schema is None else spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, line: whole lines, whatever they hold."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def health_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """ts, market, state, rate of health log lines, of which each has an object by market; the latest line of a time counts."""
    rows = read_lines(spark, paths).withColumn("j", F.from_json("line", "ts long, markets map<string, struct<state:string,rate:double>>")).where("j.ts is not null")
    out = rows.select("j.ts", F.explode("j.markets").alias("market", "m")).select("ts", "market", "m.state", "m.rate")
    return out.dropDuplicates(["ts", "market"])


def committed(rows: DataFrame, manifest: DataFrame, from_ms: int, to_ms: int, hash_ok: bool = True) -> DataFrame:
    """Rows (market, ts) in [from, to) whose window the manifest (market, ts, sha256, found) has committed, with an equal hash if ``hash_ok``."""
    good = manifest.where("sha256 = found") if hash_ok else manifest
    return rows.where((F.col("ts") >= from_ms) & (F.col("ts") < to_ms)).join(good.select("market", "ts"), ["market", "ts"], "left_semi")


def seeds_at(spark: SparkSession, paths: str | list[str], at_ms: int) -> DataFrame:
    """market, ts, bids, asks: the latest seed of each market up to ``at_ms``, from seed files of JSON lines."""
    rows = read_json(spark, paths, f"market string, ts long, bids {_LEVEL}, asks {_LEVEL}").where(F.col("ts") <= at_ms)
    return rows.groupBy("market").agg(F.max_by(F.struct("ts", "bids", "asks"), "ts").alias("s")).select("market", "s.*")


def inventory_lookup(blocks: DataFrame, inventory: DataFrame) -> DataFrame:
    """``blocks`` with the path that a frozen inventory gives them; those it doesn't have are absent."""
    return blocks.join(inventory.where("error is null").select("market", "kind", "block_ms", "path"), ["market", "kind", "block_ms"], "left").withColumn("absent", F.col("path").isNull())


def latest_per(rows: DataFrame, by: list[str], n: int, order: str = "ts") -> DataFrame:
    """The last ``n`` rows of each key."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))).where(F.col("_k") <= n).drop("_k")
