"""Packing token pieces into sequences of a fixed length by minimum bin slack.

Documents longer than the window are cut into full windows and one remainder. How the remainders
share windows depends on nothing but how many there are of each length, so the driver plans on that
histogram (at most ``window - 1`` numbers, whatever the corpus): the longest remaining length opens a
window; a subset-sum dynamic programme over Python-integer bitsets finds the sum of remaining lengths
that comes closest to the room left; walking back through the bitsets gives how many of each length
fill it; and the pattern is used as often as its lengths last. Rows then find their sequence from
their ordinal among the remainders of their length, which two levels of counts give without any
window over a whole length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import staged
from .vocab import WordIds, ended, kept, slices

#: Rows of the plan: a length's ordinals from ``ordinal`` on go, ``each`` to a sequence, to ``sequence`` and those after it, at ``offset``.
PLAN = ("length", "ordinal", "sequence", "each", "offset")


def closest_fill(room: int, lengths: list[int], counts: dict[int, int]) -> dict[int, int]:
    """How many of each length (descending ``lengths``) to take for the sum closest to ``room`` from below."""
    whole, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        most = min(counts[length], room // length) if length <= room else 0
        if not most:
            continue
        steps.append((length, most, reach))
        part = 1
        while most:  # counts as sums of powers of two
            take = min(part, most)
            reach |= (reach << (take * length)) & whole
            most -= take
            part *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        n = next(k for k in range(most + 1) if total >= k * length and before >> (total - k * length) & 1)
        if n:
            taken[length] = n
            total -= n * length
    return taken


def slack_plan(window: int, histogram: dict[int, int]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows of PLAN for the counts of each remainder length, and the number of sequences."""
    counts = {n: c for n, c in histogram.items() if c > 0 and 0 < n < window}
    lengths, used, plan, sequence = sorted(counts, reverse=True), dict.fromkeys(counts, 0), [], 0
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        pattern = closest_fill(window - longest, lengths, counts)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times, offset = min(counts[n] // k for n, k in pattern.items()), 0
        for n, k in sorted(pattern.items(), reverse=True):
            plan.append((n, used[n], sequence, k, offset))
            used[n] += k * times
            counts[n] -= k * times
            offset += n * k
        sequence += times
        lengths = [n for n in lengths if counts[n]]
    return plan, sequence


def tokenized(docs: DataFrame, vocab_path: str, end_id: int, window: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, doc_tokens, crcs (of each piece, windows first) and, if asked for, the ids themselves."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(WordIds, vocab_path, False)
        for whole in batches:
            for batch in slices(whole):
                ids, n = ended(*words.flat(batch.column("text")), end_id)
                ids, ends, pieces = ids.astype("<u4"), np.cumsum(n), -(-n // window)
                data = memoryview(ids)
                crcs = [zlib.crc32(data[a : min(a + window, end)]) for end, k in zip(ends.tolist(), n.tolist(), strict=True) for a in range(end - k, end, window)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(pieces)).astype("int32")), pa.array(crcs, pa.int64()))
                columns = [batch.column("doc_id"), pa.array(n), lists]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype("int32")), pa.array(ids.astype("int32"))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_tokens", "crcs", "ids"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(coded, f"doc_id {kind}, doc_tokens long, crcs array<long>" + ", ids array<int>" * keep_ids)


def pack(docs: DataFrame, vocab_path: str, window: int = 2048, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A null or empty text is the end id alone. Rows are told apart by a key of their own, so rows that
    share a doc_id, or have none, are separate documents and are dealt like any others. Of other
    columns none is read. An empty table gives no rows.
    """
    split = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    coded = staged(tokenized(docs, vocab_path, end_id, window, keep_ids).withColumn("row", F.monotonically_increasing_id()), "tokens")
    buckets = 64 + coded.count() // 20_000
    rows = coded.withColumn("rest", (F.col("doc_tokens") % window).cast("int")).withColumn("bucket", split("row"))
    rows = rows.withColumn("full", F.expr(f"doc_tokens div {window}"))
    groups = staged(rows.groupBy("rest", "bucket").agg(F.count("*").alias("n"), F.sum("full").alias("n_full")), "rests")
    totals = {r["rest"]: (r["n"], r["n_full"]) for r in groups.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("n_full").alias("n_full")).collect()}
    plan, sequences = slack_plan(window, {k: n for k, (n, _) in totals.items()})
    full_from = np.zeros(window + 1, np.int64)  # where the full windows of each remainder's documents begin
    for k in range(window):
        full_from[k + 1] = full_from[k] + totals.get(k, (0, 0))[1]
    full_from += sequences
    plan = np.array(sorted(plan), np.int64).reshape(-1, len(PLAN))
    keys = plan[:, 0] << 44 | plan[:, 1]

    before = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("rest", "bucket", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "n_full")))
    inside = Window.partitionBy("rest", "bucket").orderBy("row")
    rows = rows.withColumn("nth", F.row_number().over(inside) - 1).withColumn("full_nth", F.sum("full").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
    rows = rows.join(starts, ["rest", "bucket"]).select("doc_id", "doc_tokens", "crcs", "rest", (F.col("nth") + F.col("n_before")).cast("long").alias("nth"), (F.col("full_nth") + F.col("n_full_before")).cast("long").alias("full_nth"), *["ids"] * keep_ids)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = lambda name, b=batch: b.column(name).to_numpy(zero_copy_only=False)
            tokens, rest, nth = col("doc_tokens"), col("rest").astype(np.int64), col("nth")
            pieces = -(-tokens // window)
            doc = np.repeat(np.arange(len(tokens)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * window
            length = np.minimum(tokens[doc] - start, window)
            sequence = full_from[rest[doc]] + col("full_nth")[doc] + piece
            offset = np.zeros(len(doc), np.int64)
            last = length < window
            if last.any():
                own, at = doc[last], np.searchsorted(keys, rest[doc[last]] << 44 | nth[doc[last]], "right") - 1
                _, ordinal, first, each, base = plan[at].T
                step, slot = np.divmod(nth[own] - ordinal, each)
                sequence[last], offset[last] = first + step, base + slot * rest[own]
            columns = [batch.column("doc_id").take(pa.array(doc)), start, length, batch.column("crcs").flatten(), tokens[doc], sequence, offset]
            if keep_ids:
                flat, ends = batch.column("ids").flatten(), np.append(0, np.cumsum(length))
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype("int32")), flat))
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return rows.mapInArrow(placed, schema)


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids (pieces in their order) and doc_ids of each sequence, from ``pack(..., keep_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
