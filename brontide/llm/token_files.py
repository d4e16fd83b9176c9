"""Token ids as Parquet list columns: sorted, range-sharded, with bounded row groups and page indexes.

Layout of a table: one file per shard, shards and rows in ascending doc_id order. ``ids`` is a list
of 32-bit integers, dictionary coded (a vocabulary fits a dictionary page, so ids take about 16 bits)
or delta coded; ``doc_id``, ``n_tokens`` and ``shard_start`` (ids before the row in its shard) are
columns of their own, so that metadata can be read without any token, and the page index lets a
reader skip to the pages of the documents it asks for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .vocab import WordIds, ended, kept, slices

#: Parquet settings by coding; row groups of 16 MB and pages of at most 256 documents.
LAYOUT = {"parquet.block.size": str(16 << 20), "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "256", "compression": "zstd"}
CODING = {"dictionary": {"parquet.enable.dictionary": "true"}, "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2"}}


def write_token_files(docs: DataFrame, path: str, vocab_path: str, end_id: int = 2, coding: str = "dictionary") -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write the table described above.

    Rows with equal doc_id are ordered by a hash of their text, equal rows among themselves at will
    (their bytes are equal). Columns other than doc_id and text are not read. An empty table writes
    a file without rows.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, start = kept(WordIds, vocab_path, True), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole):
                ids, n = ended(*words.flat(batch.column("text")), end_id)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype("int32")), pa.array(ids.astype("int32")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.full(len(n), shard, np.int32)), pa.array(start + ends - n), pa.array(n), lists], ["doc_id", "shard", "shard_start", "n_tokens", "ids"])
                start += int(ends[-1])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(encoded, f"doc_id {kind}, shard int, shard_start long, n_tokens long, ids array<int>")
    out.write.options(**LAYOUT, **CODING[coding]).parquet(path)


def shard_starts(table: DataFrame) -> DataFrame:
    """shard, before: the ids of all earlier shards. One row (12 bytes) per task that wrote; reads no token."""
    sizes = table.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; columns not selected aren't read."""
    table = spark.read.parquet(path)
    return table.join(F.broadcast(shard_starts(table)), "shard").select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def token_digests(table: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(digested, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
