"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets and verified pairs.

Each table rotates the unit vectors by three rounds of random signs and a fast Hadamard transform; a
hash is the coordinate of largest size with its sign, several in a row name a bucket. A vector stands
in its own bucket of each table and is also looked up in the buckets of the next likely coordinate.
Pairs are verified by their cosine in double precision and counted in the first table and bucket in
which they meet, so no list of pairs is ever written: a bucket gives counts and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import staged
from .components import components
from .vectors import matrix, usable

#: Vectors of a block of a large bucket, and about how many rows of small buckets go into one group.
BLOCK, PER_GROUP = 1_500, 2_000
#: A pair at the threshold meets in one of the tables at least this often, whatever the number of hashes; and the fewest tables.
RECALL, FEWEST = 0.9995, 10


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of rows whose length is a power of two."""
    x, h = x.copy(), 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), -1)
        h *= 2
    return x / np.sqrt(x.shape[1])


def polytope_codes(unit: np.ndarray, tables: int, hashes: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(rows, tables) bucket codes, and the codes with the least certain hash replaced by its runner-up."""
    n, d = unit.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    own, probe = np.zeros((n, tables), np.int64), np.zeros((n, tables), np.int64)
    for t in range(tables):
        codes, others, margins = [], [], []
        for h in range(hashes):
            signs = np.random.default_rng([seed, t, h]).choice([-1.0, 1.0], (3, size))
            y = padded
            for s in signs:
                y = hadamard(y * s)
            a = np.abs(y)
            first = a.argmax(1)
            top = a[np.arange(n), first]
            a[np.arange(n), first] = -1
            second = a.argmax(1)
            margins.append(top - a[np.arange(n), second])
            sign = lambda at, y=y: 2 * at + (y[np.arange(n), at] < 0)
            codes.append(sign(first))
            others.append(sign(second))
        weak = np.stack(margins).argmin(0)
        for h in range(hashes):
            own[:, t] = own[:, t] * 2 * size + codes[h]
            probe[:, t] = probe[:, t] * 2 * size + np.where(weak == h, others[h], codes[h])
    return own, probe


@lru_cache
def tables_for(d: int, least: float, hashes: int) -> int:
    """Tables that give RECALL at cosine ``least`` with ``hashes`` in a row: measured on random pairs of that cosine.

    More hashes make a bucket smaller and a pair's chance in one table lower, so they need more tables. A pair
    meets in a table if one stands in its own bucket where the other stands or looks.
    """
    size = 1 << max(1, (d - 1).bit_length())
    pairs, rounds, r = max(200, 128_000 // size), 8, np.random.default_rng(5)
    x, y = r.normal(size=(2, pairs, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    cosine = min(max(least, -1.0), 1.0)
    (p, a), (q, b) = (polytope_codes(v, rounds, hashes, 12) for v in (x, cosine * x + math.sqrt(1 - cosine * cosine) * y))
    met = ((p == q) | (p == b) | (a == q)).mean()
    if met == 0:
        raise ValueError(f"cosine {least} is too low for {hashes} hashes in {d} dimensions")
    return FEWEST if met == 1 else max(FEWEST, math.ceil(math.log(1 - RECALL) / math.log(1 - met)))


def _classes(rows: DataFrame) -> DataFrame:
    """Different vectors of a label: label, v, times, first (smallest id), d, and a key of its own once written."""
    out = rows.groupBy("label", "v").agg(F.count("*").alias("times"), F.min("id").alias("first"))
    return out.withColumns({"d": F.size("v"), "key": F.monotonically_increasing_id()})


def _digest() -> tuple[Column, Column]:
    """128 bits that stand for a label and a vector, so that rows find their class without shuffling vectors again."""
    return F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(7), "v", "label").alias("h2")


def _coded(classes: DataFrame, tables: int, hashes: int) -> DataFrame:
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("d").to_numpy()
            for d in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == d))
                x = matrix(part.column("v"))
                x = x / np.abs(x).max(1, keepdims=True)
                own, probe = polytope_codes(x / np.sqrt((x * x).sum(1, keepdims=True)), tables, hashes)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, c.size + 1, tables, dtype="int32")), pa.array(c.ravel())) for c in (own, probe)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("label", "d", "v", "times", "key")), *lists], ["label", "d", "v", "times", "key", "own", "probe"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    schema = f"label {kinds['label']}, d int, v {kinds['v']}, times long, key long, own array<long>, probe array<long>"
    return classes.select("label", "d", "v", "times", "key").mapInArrow(told, schema)


def _verified(least: float):
    """Counts and spanning links within one block pair of one bucket, as a function for grouped tables."""

    def run(table: pa.Table) -> pa.Table:
        """Every bucket of a group of buckets (one bucket, if it is large)."""
        table = table.sort_by([(c, "ascending") for c in ("label", "table", "code")])
        label, t, code = (table.column(c).to_numpy() for c in ("label", "table", "code"))
        cut = np.flatnonzero((label[1:] != label[:-1]) | (t[1:] != t[:-1]) | (code[1:] != code[:-1])) + 1
        columns = {c: table.column(c).to_numpy() for c in ("key", "times", "own_block", "home")} | {c: matrix(table.column(c), k) for c, k in (("own", "i8"), ("probe", "i8"), ("v", "f8"))}
        x = columns.pop("v")
        x = x / np.abs(x).max(1, keepdims=True)
        columns["x"] = x / np.sqrt((x * x).sum(1, keepdims=True))
        same = table.column("left")[0].as_py() == table.column("right")[0].as_py()
        out: list[tuple] = []
        for start, end in zip([0, *cut.tolist()], [*cut.tolist(), len(t)], strict=True):
            if end - start > 1:
                out += bucket(int(t[start]), int(code[start]), same, **{c: y[start:end] for c, y in columns.items()})
        a, b, n = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    def bucket(t: int, code: int, same: bool, key, times, own_block, home, own, probe, x) -> list[tuple]:
        ids, block = key, own_block
        count, of, links = np.zeros(len(ids), np.int64), list(range(len(ids))), []

        def root(i: int) -> int:
            while of[i] != i:
                of[i] = of[of[i]]
                i = of[i]
            return i

        for at in range(0, len(ids), 512):
            i, j = np.nonzero(x[at : at + 512] @ x.T >= least)
            i = i + at
            keep = (ids[i] < ids[j]) & (home[i] | home[j]) & (same | (block[i] != block[j]))
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            for e in range(t):  # drop what has met in an earlier table; most pairs go at once
                p, q, a, b = own[i, e], own[j, e], probe[i, e], probe[j, e]
                keep = (p != q) & (p != b) & (a != q)
                i, j = i[keep], j[keep]
            # of up to two buckets of the table: the common one of their own, else that of the smaller key if the other probes it
            a, b = own[i, t], own[j, t]
            keep = code == np.where((a == b) | (a == probe[j, t]), a, b)
            i, j = i[keep], j[keep]
            np.add.at(count, i, times[j])
            np.add.at(count, j, times[i])
            while len(i):  # join each row to its first partner elsewhere, until none is elsewhere
                label = np.array([root(k) for k in range(len(ids))])
                apart = label[i] != label[j]
                i, j = i[apart], j[apart]
                lead = np.unique(i, return_index=True)[1]
                for p, q in zip(i[lead].tolist(), j[lead].tolist(), strict=True):
                    a_, b_ = root(p), root(q)
                    if a_ != b_:
                        of[a_] = b_
                        links.append((p, q))
        hit = np.flatnonzero(count)
        return [(i, None, n) for i, n in zip(ids[hit].tolist(), count[hit].tolist(), strict=True)] + [(int(ids[p]), int(ids[q]), 0) for p, q in links]

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93, tables: int | None = None, hashes: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label).

    Rows link when their labels are equal and not null and their cosine is at least ``least``. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors
    of different length. Equal vectors of a label are compared once and counted as often as they stand.
    Rows are told apart by label and vector, not by vec_id: rows that share one, or have none, are
    linked and counted like any others (each other too), and component_id is the smallest vec_id that is
    not null among the rows reached, null if all are. An empty table gives no rows; other columns are not read.
    ``hashes`` in a row name a bucket; by default so many that a bucket of unrelated vectors of the
    largest label stays small. ``tables`` follows from the hashes by default, so that the links found
    don't depend on how large the table or another label is.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), "label", F.col("embedding").alias("v"))
    good = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("label").isNotNull()
    classes = staged(_classes(rows.where(good)), "classes")
    most, d = classes.groupBy("label").agg(F.count("*").alias("n"), F.max("d").alias("d")).agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("d"), F.lit(1))).first()
    if hashes is None:
        hashes = 1
        signed = 2 << max(1, (d - 1).bit_length())  # different values of a hash
        while signed**hashes < most / 4 and hashes < 4:
            hashes += 1
    if tables is None:
        tables = tables_for(d, least, hashes)
    coded = staged(_coded(classes, tables, hashes), "codes")
    each = F.transform("own", lambda c, t: F.struct(t.alias("table"), c.alias("code"), F.lit(True).alias("home")))
    also = F.transform("probe", lambda c, t: F.struct(t.alias("table"), c.alias("code"), F.lit(False).alias("home")))
    entries = coded.select("label", "d", F.explode(F.concat(each, also)).alias("e")).select("label", "d", "e.*")
    bucket = ["label", "d", "table", "code"]
    sizes = entries.groupBy(*bucket).agg(F.count("*").alias("n"), F.max("home").alias("any")).where("n > 1 and any")
    sizes = sizes.select(*bucket, "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    sizes = staged(sizes, "buckets")
    entries_n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    entries = coded.select("label", "d", "key", "times", "v", "own", "probe", F.explode(F.concat(each, also)).alias("e")).select("label", "d", "key", "times", "v", "own", "probe", "e.*")
    entries = entries.join(sizes.drop("n"), bucket).withColumn("own_block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    entries = entries.withColumn("o", other).withColumns({"left": F.least("own_block", "o"), "right": F.greatest("own_block", "o")}).drop("o")
    # small buckets are dealt out many to a group, since a group costs more than they do
    groups = 1 + entries_n // PER_GROUP
    lot = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(*bucket), F.lit(groups))).otherwise(F.xxhash64(*bucket))
    entries = entries.withColumns({"lot": lot, "large": F.col("blocks") > 1})
    found = staged(entries.groupBy("d", "large", "lot", "left", "right").applyInArrow(_verified(least), "a long, b long, n long"), "found")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    joined = components(found.where("b is not null").select("a", "b"))
    heads = classes.select("key", *_digest(), "first", "times").join(counts, F.col("key") == F.col("a"), "left").join(joined, F.col("key") == F.col("node"), "left")
    heads = staged(heads.select("h1", "h2", "first", (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "key").alias("component")), "heads")
    least = heads.groupBy("component").agg(F.min("first").alias("head"))
    heads = heads.join(least, "component").select("h1", "h2", "n_links", "head")
    slim = rows.select("id", *(F.when(good, h).alias(n) for h, n in zip(_digest(), ("h1", "h2"), strict=True)), good.alias("good"))
    out = slim.join(heads, ["h1", "h2"], "left")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("good"), F.col("head")).otherwise(F.col("id")).alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE = """
WITH RECURSIVE g AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*)::BIGINT AS n_links FROM e GROUP BY a)
SELECT c.node AS vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, c.node = c.component_id AS kept
FROM c LEFT JOIN n ON c.node = n.a
"""
