"""Exact Jaccard self-join of word n-gram sets in metric regions.

The size of the symmetric difference is a metric, and a pair that is similar enough differs in at
most r elements, r following from the sizes. Cutting the universe of n-grams into r + 1 parts by a
hash leaves at least one part on which such a pair agrees entirely: the contents of a part are the
pivots of its regions, at distance zero. Where the threshold leaves parts too small to tell texts
apart, the regions are those of the rarest n-grams of each set instead. Documents that share a region
are candidates; their connected groups are joined exactly in the Jaccard metric. Large groups are cut
round by round: pivots make Voronoi regions, windows that follow from the triangle inequality copy
boundary documents into each region they may have a partner in, and regions are cut again. What is
small enough is joined in one task, its members in turn being the pivots.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import drop_staged, staged
from .components import components
from .vocab import forget

#: Bytes of text hashed at once, n-grams of a block of a large group, hash seeds for parts without content.
BATCH, BLOCK, SEEDS = 1 << 20, 1_000_000, 6
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(2)  # of the usual size: a table a group would cost more than most groups
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Word and n-gram hashes of lower-cased texts, vectorised over bytes."""

    def __init__(self, n: int):
        self.n, self.size = n, 0

    def _grow(self, size: int) -> None:
        if size > self.size:
            self.size = max(size, BATCH + 1)
            self.up, self.down = _powers(_BASE, self.size), _powers(pow(_BASE, -1, 1 << 64), self.size)

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and start positions of the words of ``data``."""
        raw = np.frombuffer(data, np.uint8)
        gap = np.concatenate(([True], _SPACE[raw], [True]))
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        first, end = edge[::2], edge[1::2]
        if not len(first):
            return np.zeros(0, _U), first
        self._grow(len(raw))
        sums = np.concatenate((np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * self.up[: len(raw)], dtype=_U)))
        return mix((sums[end] - sums[first]) * self.down[first]), first

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text its distinct n-grams as sorted 64-bit hashes; the whole sequence if it has fewer words."""
        out: list[np.ndarray] = []
        part: list[bytes] = []
        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass").lower()
            if size + len(data) > BATCH and part:
                out += self._sets(part)
                part, size = [], 0
            part.append(data)
            size += len(data) + 1
        return out + (self._sets(part) if part else [])

    def _sets(self, parts: list[bytes]) -> list[np.ndarray]:
        words, first = self._words(b" ".join(parts))
        starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
        cut = np.searchsorted(first, starts)
        chain = words
        for _ in range(self.n - 1):  # the hash at i covers the words from i on
            chain = mix(words[: max(len(chain) - 1, 0)] ^ (chain[1:] * _U(3))) if len(chain) > 1 else np.zeros(0, _U)
        out = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if b - a >= self.n:
                out.append(np.unique(chain[a : b - self.n + 1]))
            elif b > a:
                whole = words[b - 1 : b]
                for i in range(b - 2, a - 1, -1):
                    whole = mix(words[i : i + 1] ^ (whole * _U(5)))
                out.append(mix(whole + _U(b - a)))
            else:
                out.append(np.zeros(0, _U))
        return out


def key_of(s: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    return int(mix(mix(s).sum(keepdims=True, dtype=_U) + _U(len(s))).view(np.int64)[0])


def size_classes(up_to: int) -> np.ndarray:
    """First sizes of the classes, each half as large again as the one before."""
    out = [1]
    while out[-1] <= up_to:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out)


def signatures(sets: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """For each set the hashes of its regions: two sets with 100 * common >= percent * union that differ have one in common.

    With sizes a <= b the difference has at most (a + b) * (100 - p) / (100 + p) elements. A set joins
    the parts of its own size class and, if it is large enough for a larger partner, of the next.
    Parts without content would put all sparse sets together; a set that has such a part joins anew
    under another seed, and under the last seed by the empty parts too.
    """
    bounds = size_classes(max(map(len, sets), default=0) + 1)
    out: list[list[np.ndarray]] = [[] for _ in sets]
    todo = []
    for i, s in enumerate(sets):
        if len(s):
            c = int(np.searchsorted(bounds, len(s), "right")) - 1
            todo.append((i, c))
            if 100 * len(s) >= percent * int(bounds[c + 1]) and c + 2 <= len(bounds):
                todo.append((i, c + 1))
    rows = []
    for i, c in todo:
        top = int(bounds[c + 1]) - 1 if c + 1 < len(bounds) else max(int(bounds[c]) + 1, int(bounds[c]) * 3 // 2) - 1
        parts = 2 * top * (100 - percent) // (100 + percent) + 1
        if parts > 1:  # else only equal sets are similar enough
            rows.append((i, c, parts))
    for seed in range(SEEDS):
        if not rows:
            break
        lengths = np.array([len(sets[i]) for i, _, _ in rows])
        parts = np.array([p for *_, p in rows], np.int64)
        base = np.cumsum(parts) - parts
        row = np.repeat(np.arange(len(rows)), lengths)
        flat = mix(np.concatenate([sets[i] for i, _, _ in rows]) + _U(seed * 0x51ED27 + 1))
        at = base[row] + (flat % parts[row].astype(_U)).astype(np.int64)
        sums = np.zeros(int(parts.sum()), _U)
        np.add.at(sums, at, mix(flat))
        full = np.bincount(at, minlength=len(sums)) > 0
        of = np.repeat(np.arange(len(rows)), parts)
        salt = (np.array([c for _, c, _ in rows], np.int64)[of] << 40) + ((np.arange(len(sums)) - base[of]) << 8) + seed
        sig = mix(sums + mix(salt.astype(_U)))
        again = []
        for j, (i, _, n) in enumerate(rows):
            a, b = int(base[j]), int(base[j] + n)
            here = full[a:b]
            if here.all() or seed == SEEDS - 1:
                out[i].append(sig[a:b])
            else:
                out[i].append(sig[a:b][here])
                again.append(rows[j])
        rows = again
    return [np.concatenate(x) if x else np.zeros(0, _U) for x in out]


def room(a, b, percent: int):
    """The most elements in which sets of sizes ``a`` and ``b`` differ if they are similar enough."""
    return (a + b) * (100 - percent) // (100 + percent)


def sketch_words(most: int, percent: int) -> int:
    """64-bit words of the sketches of sets of up to ``most`` elements: at least eight bits for each element that may differ."""
    return 1 << max(int(8 * room(most, most, percent)) - 1, 1).bit_length() >> 6 or 1


def sketches(codes: np.ndarray, lengths: np.ndarray, words: int) -> np.ndarray:
    """A row of bits for each set: the parity of its elements in each of 64 * ``words`` parts of the universe.

    Two rows differ in no more bits than their sets in elements, so more bits than room() prove a pair dissimilar.
    """
    out = np.zeros((len(lengths), words), _U)
    bit = codes.astype(_U) & _U(64 * words - 1)
    row = np.repeat(np.arange(len(lengths)), lengths)
    np.bitwise_xor.at(out.reshape(-1), row * words + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
    return out


class Region:
    """Sets that are joined with each other: links of similar pairs, as far as they change who is connected."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.theta = percent, 1 - percent / 100
        self.n = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        _, code = np.unique(flat, return_inverse=True)
        self.code, self.ends = code, np.cumsum(self.n)
        self.mark = np.zeros(int(code.max()) + 1 if len(code) else 1, np.int64)
        self.of = list(range(len(sets)))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.of[i] != i:
            self.of[i] = self.of[self.of[i]]
            i = self.of[i]
        return i

    def elements(self, i: int) -> np.ndarray:
        return self.code[self.ends[i] - self.n[i] : self.ends[i]]

    def meet(self, pivot: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard distances of ``members`` to a pivot, and which of them are similar enough to it."""
        own = self.elements(pivot)
        self.mark[own] = 1
        lengths = self.n[members]
        starts = np.cumsum(lengths) - lengths
        flat = np.repeat(self.ends[members] - lengths - starts, lengths) + np.arange(int(lengths.sum()))
        common = np.add.reduceat(self.mark[self.code[flat]], starts)
        self.mark[own] = 0
        union = lengths + len(own) - common
        return 1 - common / union, 100 * common >= self.percent * union

    def distances(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Jaccard distances of ``members`` to a pivot; those near enough are linked to it."""
        far, similar = self.meet(pivot, members)
        for j in members[similar].tolist():
            self.link(pivot, j)
        return far

    def link(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.of[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def windows(self, pivots: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pivot (row) and member: whether it belongs to the pivot's widened Voronoi cell, and whether it is similar to the pivot.

        Of a similar pair one lies in the cell of its nearest pivot; the other is at most theta farther from
        that pivot, and so at most 2 theta farther than from its own nearest one.
        """
        far, similar = map(np.stack, zip(*(self.meet(int(p), members) for p in pivots), strict=True))
        return far <= far.min(0) + 2 * self.theta + 1e-9, similar

    def scan(self, members: np.ndarray, pivots: np.ndarray | None = None) -> None:
        """Link all similar pairs of ``members`` of which one is among ``pivots`` (by default all).

        Each in turn is the pivot; earlier pivots' distances exclude what the triangle inequality can, sketches nearly all the rest.
        """
        kept: list[np.ndarray] = []
        turn = np.ones(len(members), bool) if pivots is None else np.isin(members, pivots)
        roots, known = np.array([self.root(i) for i in members.tolist()]), len(self.links)
        met = np.zeros(len(members), bool)
        bits, n = sketches(mix(self.code), self.n, sketch_words(int(self.n.max()), self.percent))[members], self.n[members]
        for k in np.flatnonzero(turn).tolist():
            met[k] = True
            open_ = (roots != roots[k]) & ~met  # earlier pivots have met this one
            for far in kept:
                open_ &= np.abs(far - far[k]) <= self.theta + 1e-9
            at = np.flatnonzero(open_)
            at = at[np.bitwise_count(bits[at] ^ bits[k]).sum(1, dtype=np.int64) <= room(n[at], n[k], self.percent)]
            if not len(at):
                continue
            pivot = int(members[k])
            if len(kept) < 12:
                kept.append(self.distances(pivot, members))
            else:
                self.distances(pivot, members[at])
            if len(self.links) > known:
                roots, known = np.array([self.root(i) for i in members.tolist()]), len(self.links)
                if (roots == roots[0]).all():
                    return


def in_third(s: np.ndarray) -> np.ndarray:
    """The elements in a fixed third of the universe."""
    return s[(mix(s) % _U(3)) == 0]


def _profiles(docs: DataFrame, n: int, of) -> DataFrame:
    """doc_id, ident, n_shingles, key (hash of the whole set, null if it is empty), regions: of(sets), for a key's first row in a task."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher, met = Hasher(n), set()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = hasher.sets(batch.column("text").to_pylist())
                keys = [key_of(s) if len(s) else None for s in sets]
                none = np.zeros(0, _U)
                fresh = []
                for s, key in zip(sets, keys, strict=True):
                    fresh.append(none if key in met else s)
                    met.add(key)
                if len(met) > 500_000:  # a repeated copy costs time only
                    met.clear()
                regions = of(fresh)
                ends = np.cumsum([0, *map(len, regions)]).astype("int32")
                flat = np.concatenate(regions).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ident"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ident", "n_shingles", "key", "regions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "ident", "text").mapInArrow(told, f"doc_id {kind}, ident long, n_shingles long, key long, regions array<long>")


def _stars(entries: DataFrame) -> DataFrame:
    """a, b: each key of a region with the region's smallest key, from rows (region, key).

    One range shuffle on (region, key): however many keys a region has, they are split evenly and
    streamed in order, with the current smallest key as the only state. A region that spans tasks is
    put together from what each task says of its first and last region.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = lead = start = None
        for batch in batches:
            if not batch.num_rows:
                continue
            r, k = batch.column("region").to_numpy(), batch.column("key").to_numpy()
            first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            leads = k[first]
            if region == r[0]:
                leads = np.concatenate(([lead], leads[1:]))
            if start is None:
                start = (int(r[0]), int(k[0]))
            led = np.repeat(leads, np.diff(np.append(first, len(r))))
            region, lead = int(r[-1]), int(led[-1])
            other = k != led
            pairs = np.unique(np.stack((k[other], led[other]), 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], ["a", "b", "region"])
        if start is not None:
            yield pa.RecordBatch.from_arrays([pa.array([start[1], lead], pa.int64()), pa.nulls(2, pa.int64()), pa.array([start[0], region], pa.int64())], ["a", "b", "region"])

    told_rows = staged(entries.repartitionByRange("region", "key").sortWithinPartitions("region", "key").mapInArrow(told, "a long, b long, region long"), "stars")
    edge = told_rows.where("region is not null")
    lead = edge.groupBy("region").agg(F.min("a").alias("b"))
    return told_rows.where("region is null").select("a", "b").union(edge.select("a", "region").join(lead, "region").select("a", "b")).where("a <> b").distinct()


def _meet(entries: DataFrame) -> DataFrame:
    """key, met: at most how many of a key's elements another key has too, from rows (region, key).

    One range shuffle on (region, key), then a stream: an element is shared if its run of rows has two
    keys. A run cut by the end of a batch counts as shared, so ``met`` is never too small.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r, k = batch.column("region").to_numpy(), batch.column("key").to_numpy()
            first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            last = np.append(first[1:], len(r)) - 1
            shared = k[first] != k[last]
            shared[[0, -1]] = True
            row = np.repeat(shared, np.diff(np.append(first, len(r))))
            row[1:] &= (r[1:] != r[:-1]) | (k[1:] != k[:-1])  # a repeated (region, key) counts once
            keys, met = np.unique(k[row], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(met)], ["key", "met"])

    rows = entries.repartitionByRange("region", "key").sortWithinPartitions("region", "key").mapInArrow(told, "key long, met long")
    return rows.groupBy("key").agg(F.sum("met").alias("met"))


def _rarest(elements: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """region, key: the rarest elements of each set, so many that sets similar enough have one of them in common.

    ``elements`` has (region, key), ``sizes`` (key, n). A set of n elements shares at least percent of
    them with such a partner, so in any order of all elements, the same for all sets, the first
    n - ceil(percent * n) + 1 contain a common one. In order of frequency those are mostly elements
    that nothing else has, and these give no candidates.
    """
    often = elements.groupBy("region").agg(F.count("*").alias("df")).where("df > 1")
    shared = elements.join(often, "region")
    alone = shared.groupBy("key").agg(F.count("*").alias("m")).join(sizes, "key")
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("m"))
    room = alone.select("key", room.alias("room")).where("room > 0")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("df", "region"))
    return shared.join(room, "key").withColumn("rank", rank).where(F.col("rank") <= F.col("room")).select("region", "key")


#: A group with more open members than this is cut into Voronoi regions, around about so many pivots; regions that hold this share of their group or more don't count as cut.
LARGE, PIVOTS, SHRINKS, ROUNDS = 256, 12, 0.75, 4
#: Members of a block of a group; of a group that isn't sifted by sketches, at most; of a block of sketches.
CROWD, FEW, SHEET = 1_024, 16, 4_096
CUT = {"group": pa.int64(), "pivot": pa.int64(), "key": pa.int64(), "inside": pa.bool_(), "similar": pa.bool_()}


def _schema(fields: dict[str, pa.DataType]) -> str:
    return ", ".join(f"`{c}` {'boolean' if t == pa.bool_() else 'long'}" for c, t in fields.items())


def _blocks(weight: Column, size: int) -> Column:
    """How many blocks of about ``size`` n-grams."""
    return F.ceil(weight / size).cast("int")


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.greatest(blocks, F.lit(1))).cast("int")


def _cut(big: DataFrame, n: int, percent: int, seed: int) -> DataFrame:
    """CUT: which members of each group are in which pivot's widened Voronoi cell (``inside``), and similar to it.

    ``big`` has (group, key, text, rest, open, w), open and w being open members and n-grams of the group. The pivots are
    about a dozen open members chosen by hash; members are dealt in blocks, and the group's pivots go to each.
    """
    big = big.withColumn("blocks", F.greatest(_blocks(F.col("w"), BLOCK), F.lit(1)))
    lucky = F.col("rest") & (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) < F.lit(float(PIVOTS << 30)) / F.col("open"))
    pivots = staged(big.where(lucky).select("group", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")), "pivots")
    members = big.select("group", _block(F.col("key"), F.col("blocks")).alias("block"), "text")

    def told(left: pa.Table, right: pa.Table) -> pa.Table:
        forget()
        hasher = Hasher(n)
        own, about = hasher.sets(left.column("text").to_pylist()), hasher.sets(right.column("text").to_pylist())
        k = len(about)
        if not own or not k:
            return pa.table({c: pa.array([], t) for c, t in CUT.items()})
        region = Region(about + own, percent)
        inside, similar = region.windows(np.arange(k), k + np.arange(len(own)))
        p, m = np.nonzero(inside | similar)
        keys, heads = np.array([key_of(x) for x in own]), np.array([key_of(x) for x in about])
        columns = {"group": np.full(len(p), left.column("group")[0].as_py()), "pivot": heads[p], "key": keys[m], "inside": inside[p, m], "similar": similar[p, m]}
        return pa.table({c: pa.array(columns[c], t) for c, t in CUT.items()})

    return members.groupBy("group", "block").cogroup(pivots.groupBy("group", "block")).applyInArrow(told, _schema(CUT))


def _labels(cut: DataFrame, core: DataFrame) -> DataFrame:
    """group, pivot, label: pivots that similar members connect have one label; 0 is that of the pivots connected with the group's core.

    Pivots are joined by the members they share: of each member only the steps from one of its pivots to the next, at
    most a few hundred different ones a group.
    """
    near = cut.where("similar").join(core, ["group", "key"], "left").groupBy("group", "key").agg(F.array_sort(F.collect_set("pivot")).alias("p"), F.max("core").alias("core"))
    first = F.when(F.col("core"), F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<long>"))
    chain = F.concat(first, "p")
    steps = F.transform(F.sequence(F.lit(0), F.size(chain) - 1), lambda i: F.struct(F.get(chain, F.greatest(i - 1, F.lit(0))).alias("a"), F.get(chain, i).alias("b")))
    steps = near.select("group", F.explode(steps).alias("s")).select("group", "s.a", "s.b").distinct()

    def told(table: pa.Table) -> pa.Table:
        of = {x: x for c in ("a", "b") for x in table.column(c).to_pylist()}

        def root(x):
            while of[x] != x:
                x = of[x]
            return x

        for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                of[b if a is None else a] = a if a is None else b
        pivots = [x for x in of if x is not None]
        group = table.column("group")[0].as_py()
        return pa.table({"group": pa.array([group] * len(pivots), pa.int64()), "pivot": pa.array(pivots, pa.int64()), "label": pa.array([0 if root(x) is None else root(x) for x in pivots], pa.int64())})

    return steps.groupBy("group").applyInArrow(told, "`group` long, pivot long, label long")


def _with_texts(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Members with their text: merged, not broadcast, at every size, since what is a member grows with the input."""
    return texts.hint("merge").join(members, "ident")


def _few(rows: DataFrame, few: int = 20_000) -> DataFrame:
    """``rows`` to be broadcast if they are few, else as they are."""
    return F.broadcast(rows) if rows.limit(few + 1).count() <= few else rows


def _sifted(members: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``members`` (group, key, ident, n) in the groups that remain when sketches tell which pairs of a group may be similar.

    Small parts put unrelated long texts into one region, and near copies with many changes into the group of
    those with few; both kinds of groups grow with the input. All pairs of a larger group are compared by their sketches,
    a hundredth of their texts, by size class and in blocks; what stays connected is a group, and what no sketch connects with
    anything is similar to nothing.
    """
    sizes = members.groupBy("group").agg(F.count("*").alias("m")).where(F.col("m") > FEW)
    sized = staged(members.join(_few(staged(sizes, "sizes")), "group", "left"), "sized")
    large = sized.where("m is not null")
    if large.isEmpty():
        return members

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher = Hasher(n)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = hasher.sets(batch.column("text").to_pylist())
                bounds = size_classes(max(map(len, sets), default=0) * 100 // percent + 1)
                of, kind, bits = [], [], []
                for i, x in enumerate(sets):
                    c = int(np.searchsorted(bounds, len(x), "right")) - 1
                    while bounds[c] <= len(x) or 100 * len(x) >= percent * int(bounds[c]):  # its own class and those of larger partners
                        of.append(i)
                        kind.append(c)
                        bits.append(sketches(mix(x), np.array([len(x)]), sketch_words(int(bounds[c + 1]), percent)).tobytes())
                        c += 1
                taken = batch.take(pa.array(of, pa.int64()))
                yield pa.RecordBatch.from_arrays([taken.column("group"), pa.array(kind, pa.int64()), taken.column("key"), pa.array([len(sets[i]) for i in of], pa.int64()), pa.array(bits, pa.binary())], ["group", "kind", "key", "n", "bits"])

    with_text = _with_texts(large.select("group", "key", "ident"), texts).select("group", "key", "text")
    rows = staged(with_text.mapInArrow(told, "`group` long, kind long, key long, n long, bits binary"), "sketches")
    dealt = rows.groupBy("group", "kind").agg(F.ceil(F.count("*") / SHEET).cast("int").alias("j")).where("j > 1")
    rows = rows.join(_few(staged(dealt, "dealt")), ["group", "kind"], "left").withColumn("j", F.coalesce("j", F.lit(1)))
    rows = rows.withColumn("own", _block(F.col("key"), F.col("j")))
    # a pair of blocks is a task
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("j") - 1)))
    rows = rows.select("group", "kind", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "key", "n", "bits")

    def near(table: pa.Table) -> pa.Table:
        key, size, own = (table.column(c).to_numpy() for c in ("key", "n", "own"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), _U).reshape(len(key), -1)
        links = sketch_links(bits, size, own, percent)
        return pa.table({"a": pa.array(key[[i for i, _ in links]], pa.int64()), "b": pa.array(key[[j for _, j in links]], pa.int64())})

    kept = components(staged(rows.groupBy("group", "kind", "x", "y").applyInArrow(near, "a long, b long"), "sifted"))
    again = large.join(kept, large["key"] == kept["node"]).select(F.col("component").alias("group"), "key", "ident", "n")
    return staged(sized.where("m is null").select("group", "key", "ident", "n").unionByName(again), "members")


def sketch_links(bits: np.ndarray, size: np.ndarray, block: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows that connect all whose sketches may be those of a similar pair: of two blocks if there are two, else of all."""
    roots, links = np.arange(len(size)), []
    two = len(size) > 0 and (block != block[0]).any()
    for i in range(len(size)):
        open_ = roots != roots[i]
        open_[: i + 1] = False
        if two:
            open_ &= block != block[i]
        at = np.flatnonzero(open_)
        at = at[np.bitwise_count(bits[at] ^ bits[i]).sum(1, dtype=np.int64) <= room(size[at], size[i], percent)]
        for j in at.tolist():
            if roots[j] != roots[i]:
                links.append((i, j))
                roots[roots == roots[j]] = roots[i]
    return links


def _regions(members: DataFrame, texts: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(tasks, links): pairs (a, b) linked on the way, and rows (group, block, ident, rest) of what remains to be joined.

    A group's members are open (``rest``) or in its core, whose members are connected already, so pairs within the
    core need no comparison. A group with many open members is cut into Voronoi regions round by round. A
    region's core are the members that pivots connect with its own. Where regions would not be much smaller than the
    group, as among near copies, it stays whole: what pivots connect with each other becomes its core, and it
    isn't cut again. What remains is joined in blocks, of which each meets each block of the rest.
    """
    links, tasks = members.sparkSession.createDataFrame([], "a long, b long"), None
    now = staged(members.select("group", "key", "ident", "n", F.lit(True).alias("rest"), F.lit(True).alias("cut")), "members")
    for seed in range(ROUNDS):
        sizes = now.groupBy("group").agg(F.count("*").alias("m"), F.count_if("rest").alias("open"), F.sum("n").alias("w"), F.coalesce(F.sum(F.when(F.col("rest"), F.col("n"))), F.lit(0)).alias("r"))
        # only groups that are more than one task matter, and they are few: each has many members or many n-grams
        sizes = staged(sizes.where((F.col("open") > LARGE) | (F.col("m") > CROWD) | (F.col("w") > BLOCK // 5)), "sizes")
        sized = now.join(_few(sizes), "group", "left")
        large = F.col("cut") & F.coalesce(F.col("open") > LARGE, F.lit(False))
        part = sized.where(~large).select("group", "key", "ident", "rest", "w", "r", "m", "open")
        tasks = part if tasks is None else tasks.unionByName(part)
        big = staged(sized.where(large).select("group", "key", "ident", "n", "rest", "open", "m", "w"), "large")
        if big.isEmpty():
            break
        with_text = staged(_with_texts(big.select("group", "key", "ident", "rest", "open", "w"), texts), "texts")
        if not seed:  # groups are disjoint as yet, and later rounds cut only what is in them
            texts = with_text.select("ident", "text")
        cut = staged(_cut(with_text, n, percent, seed), "cells")
        links = links.union(cut.where("similar").select("key", "pivot"))
        labels = staged(_labels(cut, big.where("not rest").select("group", "key", F.lit(True).alias("core"))), "labels")
        # all pivots similar to a member have one label, so any of them tells it
        own = cut.where("similar").join(_few(labels), ["group", "pivot"]).groupBy("group", "key").agg(F.min("label").alias("label"))
        big = staged(big.join(own, ["group", "key"], "left").withColumn("label", F.when(F.col("rest"), F.col("label")).otherwise(F.lit(0))), "labelled")
        cells = cut.where("inside").groupBy("group", "pivot").agg(F.count("*").alias("c"))
        whole = cells.join(sizes, "group").groupBy("group").agg(F.max(F.col("c") >= SHRINKS * F.col("m")).alias("whole"))
        most = big.where("label is not null").groupBy("group", "label").agg(F.count("*").alias("c")).groupBy("group").agg(F.min_by("label", F.struct(F.col("label") != 0, -F.col("c"), "label")).alias("hub"))
        fate = staged(sizes.select("group").join(whole, "group", "left").join(most, "group", "left"), "fate")
        more = F.lit(seed + 2 < ROUNDS)
        facts = big.join(_few(fate), "group")
        stays = F.coalesce("whole", F.lit(True))  # also a group for which no pivot was drawn
        still = facts.where(stays).select("group", "key", "ident", "n", (F.col("rest") & ~F.coalesce(F.col("label") == F.col("hub"), F.lit(False))).alias("rest"), F.lit(False).alias("cut"))
        split = facts.where(~stays).select("group", "key", "ident", "n", "label")
        inside = cut.where("inside").select("group", "pivot", "key").join(split, ["group", "key"]).join(_few(labels).withColumnRenamed("label", "of"), ["group", "pivot"], "left")
        regions = inside.select(F.xxhash64("group", "pivot").alias("group"), "key", "ident", "n", (~F.coalesce(F.col("label") == F.col("of"), F.lit(False))).alias("rest"), more.alias("cut"))
        now = staged(still.union(regions), "members")
    # blocks of the core are small, since only the rest is compared with them; the rest is all of a group that was never cut
    weight = lambda c: F.coalesce(c, F.lit(0))
    tasks = tasks.withColumn("j", F.greatest(_blocks(weight("r"), BLOCK), _blocks(weight("open"), CROWD), F.lit(1)))
    tasks = tasks.withColumn("i", F.col("j") + F.greatest(_blocks(weight("w") - weight("r"), BLOCK // 5), _blocks(weight("m") - weight("open"), CROWD)))
    tasks = tasks.withColumns({"a": _block(F.col("key"), F.col("i")), "b": _block(F.col("key"), F.col("j"))})
    # each pair of a block and a block of the rest is a task: a member stands in those of its block, and if it is of the rest in those of that too
    mine = F.transform(F.sequence(F.lit(0), F.col("j") - 1), lambda k: F.struct((F.col("a") * F.col("j") + k).alias("block"), (F.col("rest") & (F.col("b") == k)).alias("rest")))
    others = F.filter(F.sequence(F.lit(0), F.col("i") - 1), lambda k: F.col("rest") & (k != F.col("a")))
    theirs = F.transform(others, lambda k: F.struct((k * F.col("j") + F.col("b")).alias("block"), F.lit(True).alias("rest")))
    return tasks.select("group", "ident", F.explode(F.concat(mine, theirs)).alias("t")).select("group", "ident", "t.block", "t.rest"), links


def _joined(tasks: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: links between the members (group, block, text, rest) of each task that connect what is similar and not both outside the rest."""

    def told(table: pa.Table) -> pa.Table:
        forget()
        sets = Hasher(n).sets(table.column("text").to_pylist())
        rest = np.array(table.column("rest").to_pylist(), bool)
        full = [i for i, s in enumerate(sets) if len(s)]
        sets, rest = [sets[i] for i in full], rest[full]
        keys = [key_of(s) for s in sets]
        region = Region(sets, percent) if sets else None
        links = []
        if region and rest.any():
            order = np.argsort(region.n, kind="stable")
            region.scan(order, None if rest.all() else np.flatnonzero(rest))
            links = region.links
        return pa.table({"a": pa.array([keys[i] for i, _ in links], pa.int64()), "b": pa.array([keys[j] for _, j in links], pa.int64())})

    return tasks.groupBy("group", "block").applyInArrow(told, "a long, b long")


def linked(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``: components of 100 * common >= percent * union.

    Only components are computed: what is already connected is not compared, so links are neither
    listed nor counted. A null or empty text, or one of white space, has size 0, is linked with nothing and is its own
    component. Rows with equal sets share a key and are compared once. Rows are told apart by their text, so
    rows that share a doc_id but not a text keep their own sets, and rows without one are linked like any others;
    component_id is the smallest doc_id reached that is not null, null if there is none. An empty table gives no rows.
    Columns other than doc_id and text are not read. Sets are compared by 64-bit hashes of their n-grams.
    """
    parts = (100 + percent) / (3 * (100 - percent))  # elements of a part, about
    by_parts = parts >= 6
    of = (lambda sets: signatures(sets, percent)) if by_parts else (lambda sets: [in_third(s) for s in sets])
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("ident"))
    rows = staged(_profiles(docs, n, of), "profiles")
    slim = staged(rows.select("doc_id", "n_shingles", "key", "ident"), "sets")
    classes = slim.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"), F.min("ident").alias("ident"), F.max("n_shingles").alias("n"))
    entries, texts, spent = rows.select("key", F.explode("regions").alias("region")), docs.select("ident", "text"), [rows]
    if not by_parts:
        # parts would hold too few elements to tell texts apart. A set needs percent of its elements in common with
        # one other, so at most the rest of them can be without any other set; count those in a third of the universe
        third = rows.where(F.size("regions") > 0).groupBy("key").agg(F.max(F.size("regions")).alias("third"))
        met = staged(_meet(entries), "met")
        near = classes.join(third, "key", "left").join(met, "key", "left")
        near = near.where(F.coalesce("third", F.lit(0)) - F.coalesce("met", F.lit(0)) <= F.col("n") - F.ceil(F.col("n") * percent / 100))
        near = staged(near.select("key", "ident", "n"), "near")
        chosen = docs.hint("merge").join(near.select("ident"), "ident", "left_semi").select("doc_id", "ident", "text")
        chosen = staged(chosen, "texts")
        texts = chosen.select("ident", "text")
        elements = staged(_profiles(chosen, n, lambda sets: sets).select("key", F.explode("regions").alias("region")).distinct(), "elements")
        entries = _rarest(elements, near.select("key", "n"), percent)
        spent += [met, elements]
    groups = staged(components(_stars(entries)), "groups")
    for table in spent:
        drop_staged(table)
    members = groups.join(classes, groups["node"] == classes["key"]).select(F.col("component").alias("group"), "key", "ident", "n")
    members = staged(members, "members")
    texts = staged(texts.hint("merge").join(members.select("ident"), "ident", "left_semi"), "texts")
    tasks, links = _regions(_sifted(members, texts, n, percent), texts, n, percent)
    found = _joined(_with_texts(staged(tasks, "tasks"), texts).select("group", "block", "text", "rest"), n, percent)
    links = components(staged(found.union(links), "links"))
    heads = classes.join(links, classes["key"] == links["node"], "left").select("key", "first", F.coalesce("component", "key").alias("component"))
    heads = staged(heads, "heads")
    least = heads.groupBy("component").agg(F.min("first").alias("least"))
    final = heads.join(least, "component").select(F.col("key").alias("k"), "least")
    out = slim.join(final, slim["key"] == final["k"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def oracle_sql(n: int = 3, percent: int = 90) -> str:
    """linked() in DuckDB SQL, for documents with different ids."""
    upper = "".join(map(chr, range(65, 91)))
    gram = " || ' ' || ".join(f"ws[i + {j}]" for j in range(n))
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= {n} THEN list_transform(generate_series(1, len(ws) - {n - 1}), lambda i: {gram}) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END) AS g FROM w)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, m.component_id FROM documents d LEFT JOIN c USING (doc_id) JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) m ON m.node = d.doc_id
"""
