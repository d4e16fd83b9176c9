"""Files of raw events: block scans, line validation, compressed batches and SQL over named views."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_MS = 30_000
#: The path of a block file; E001 to E006 below are the codes of what is wrong with one.
_PATH = r"/([^/]+)/(\d{4}-\d{2}-\d{2})/(\d{2})-(\d{2})-(\d{2})\.jsonl$"


def scan_blocks(spark: SparkSession, root: str, kind: str, from_ms: int, to_ms: int, market: str = "*") -> DataFrame:
    """market, block_ms, line of the block files <root>/<kind>/<market>/<date>/<HH-MM-SS>.jsonl that overlap [from, to).

    Files are pruned by the dates in the range; a name off the 30 s grid fails the job.
    """
    days = sorted({d.strftime("%Y-%m-%d") for d in _days(from_ms, to_ms)})
    rows = spark.read.text(f"{root}/{kind}/{market}/{{{','.join(days)}}}/*.jsonl").select("value", F.col("_metadata.file_path").alias("path"))
    part = lambda i: F.regexp_extract("path", _PATH, i)
    seconds = part(3).cast("long") * 3600 + part(4).cast("long") * 60 + part(5).cast("long")
    block = F.datediff(part(2).cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000 + seconds * 1000
    rows = rows.select(part(1).alias("market"), F.when(block % BLOCK_MS != 0, F.raise_error(F.concat(F.lit("E006 off the grid: "), "path"))).otherwise(block).alias("block_ms"), F.col("value").alias("line"))
    return rows.where((F.col("block_ms") < to_ms) & (F.col("block_ms") + BLOCK_MS > from_ms))


def _days(from_ms: int, to_ms: int):
    from datetime import UTC, datetime, timedelta

    day, end = datetime.fromtimestamp((from_ms - BLOCK_MS) / 1000, UTC), datetime.fromtimestamp(to_ms / 1000, UTC)
    while day.date() <= end.date():
        yield day
        day += timedelta(days=1)


def validated_trades(lines: DataFrame) -> DataFrame:
    """``lines`` (market, block_ms, line) with the trade's fields and error: E001 not JSON, E002 a field is missing, E003 out of range, E005 outside the block."""
    j = F.from_json("line", "ts long, price double, qty double, side string, tradeId string, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.withColumn("j", j)
    t = lambda c: F.col(f"j.{c}")
    error = (
        F.when(F.col("j").isNull() | t("_bad").isNotNull(), "E001").when(t("ts").isNull() | t("price").isNull() | t("qty").isNull() | t("side").isNull(), "E002")
        .when(~((t("price") > 0) & (t("qty") > 0) & t("side").isin("buy", "sell")), "E003").when((t("ts") < F.col("block_ms")) | (t("ts") >= F.col("block_ms") + BLOCK_MS), "E005")
    )
    return rows.select("market", "block_ms", *(t(c).alias(a) for c, a in (("ts", "ts"), ("price", "price"), ("qty", "qty"), ("side", "side"), ("tradeId", "trade_id"))), error.alias("error"))


def classified_files(spark: SparkSession, glob: str, expected: DataFrame | None = None) -> DataFrame:
    """path, kind of each file: empty, partial (no final newline), invalid (a first line that isn't JSON) or nonempty; of ``expected`` (path) those not there are absent.

    Only lengths, first lines and last bytes go on from the scan.
    """
    raw = spark.read.format("binaryFile").load(glob).select("path", "length", F.substring("content", -1, 1).alias("end"), F.substring_index(F.substring("content", 1, 1 << 20).cast("string"), "\n", 1).alias("first"))
    kind = F.when(F.col("length") == 0, "empty").when(F.col("end") != F.lit(b"\n"), "partial").when(F.try_parse_json("first").isNull(), "invalid").otherwise("nonempty")
    rows = raw.select("path", kind.alias("kind"))
    return rows if expected is None else expected.select("path").join(rows, "path", "left").na.fill("absent", ["kind"])


def exploded_batches(batches: DataFrame) -> DataFrame:
    """market, stream, batch_id, line_no, line from gzip batches (market, stream, batch_id, payload)."""

    def told(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                lines = gzip.decompress(part.column("payload")[k].as_py()).decode().splitlines()
                same = [pa.repeat(part.column(c)[k], len(lines)) for c in ("market", "stream", "batch_id")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(range(len(lines)), pa.int32()), pa.array(lines, pa.string())], ["market", "stream", "batch_id", "line_no", "line"])

    return batches.select("market", "stream", F.col("batch_id").cast("long").alias("batch_id"), "payload").mapInArrow(told, "market string, stream string, batch_id long, line_no int, line string")


def compressed_batches(lines: DataFrame, per_batch: int = 16_384) -> DataFrame:
    """One gzip payload per (market, stream, batch) of at most ``per_batch`` consecutive lines (market, stream, seq, ts, line), with its time range and count."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda x: x["line"]), "\n")
    keys = ["market", "stream", "batch_id", "first_ts", "last_ts", "row_count"]
    groups = lines.groupBy("market", "stream", F.floor(F.col("seq") / per_batch).alias("batch_id")).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("row_count"), text.alias("text"))

    def told(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            packed = [gzip.compress(x.encode(), 1, mtime=0) for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keys), pa.array(packed, pa.binary())], [*keys, "payload"])

    kinds = {f.name: f.dataType.simpleString() for f in groups.schema}
    return groups.mapInArrow(told, ", ".join(f"{c} {kinds[c]}" for c in keys) + ", payload binary")


def expanded(sql: str, this: str) -> str:
    """``sql`` with the word ``this`` replaced by ``this``, but not inside quotes or comments."""
    return re.sub(r"""('(?:[^']|'')*'|"[^"]*"|`[^`]*`|--[^\n]*)|\bthis\b""", lambda m: m[1] or this, sql)


def run_sql(spark: SparkSession, sql: str, this: str = "trades", path: str | None = None) -> DataFrame:
    """``sql`` with the word ``this`` standing for the view named ``this``, or for the Parquet files of ``path`` (a glob)."""
    return spark.sql(expanded(sql, f"parquet.`{path}`" if path else f"`{this}`"))


def as_json(rows: DataFrame) -> DataFrame:
    """json: each row as a JSON object; 64-bit integers stand as text, since not every reader holds them."""
    safe = [F.col(f"`{f.name}`").cast("string").alias(f.name) if f.dataType.simpleString() == "bigint" else F.col(f"`{f.name}`") for f in rows.schema]
    return rows.select(F.to_json(F.struct(*safe)).alias("json"))
