"""Token counts by byte-pair merging, without making any token id.

The symbols of a word stand in a doubly linked list; a heap holds the rank of each adjacent pair.
The pair of lowest rank (leftmost of equals) is popped and merged until no known pair is left. The
count is the number of initial symbols less the number of merges.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vocab import LONGEST, MEMORY, cut_pieces, kept, slices

#: Fixed value: how the byte-level tokenizer of the vocabulary file cuts a text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class MergeCounter:
    """Tokens of texts. Arrow numbers the different words of a batch, and the counts of all words met are kept."""

    def __init__(self, path: str):
        self.known, self.counts = pa.array([""], pa.string()), np.zeros(1, np.int64)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        of = model["vocab"]
        self.byte_id = [of[s] for _, s in sorted(byte_symbols().items())]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[of[left] << 32 | of[right]] = (rank, of[left + right])
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.cut = regex.compile(WORDS)
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def merged(self, data: bytes) -> int:
        """Tokens of one cut word, as bytes."""
        n, ranks = len(data), self.ranks
        if n < 2:
            return n
        ids = [self.byte_id[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for at in range(n - 1):
            if hit := ranks.get(ids[at] << 32 | ids[at + 1]):
                heap.append((hit[0], at, hit[1]))
        heapify(heap)
        left = n
        while heap:
            rank, at, made = heappop(heap)
            if ids[at] < 0 or (right := after[at]) >= n:
                continue
            hit = ranks.get(ids[at] << 32 | ids[right])
            if not hit or hit[0] != rank:  # one of the two has been merged meanwhile
                continue
            ids[at], ids[right] = made, -1
            left -= 1
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                if hit := ranks.get(made << 32 | ids[beyond]):
                    heappush(heap, (hit[0], at, hit[1]))
            if (prior := before[at]) >= 0 and (hit := ranks.get(ids[prior] << 32 | made)):
                heappush(heap, (hit[0], prior, hit[1]))
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings, by the words that the tokenizer cuts."""
        return sum(self.merged(w.encode()) for w in self.cut.findall(text))

    def count(self, text: str | None) -> int:
        """Tokens of a whole text, remembering nothing but repeated words within it."""
        text = text or ""
        if self.cut_special is None or "<|" not in text:
            return self._repeated(text)
        return len(self.cut_special.findall(text)) + sum(map(self._repeated, self.cut_special.split(text)))

    def _repeated(self, text: str) -> int:
        return sum(n * self.merged(w.encode()) for w, n in Counter(self.cut.findall(text)).items())

    def tokens(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (null: 0)."""
        if not len(texts):
            return np.zeros(0, np.int64)
        if len(self.counts) > MEMORY:
            self.known, self.counts = self.known[:1], self.counts[:1]
        pieces = cut_pieces(texts, True)
        coded, at = pieces.flat.dictionary_encode(), pieces.starts
        words = coded.dictionary
        found = pc.index_in(words, value_set=self.known)
        numbers, new = pc.fill_null(found, 0).to_numpy(), np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        counts = self.counts[numbers]
        if len(new):
            fresh = words.take(pa.array(new))
            counts[new] = [self.plain(" " + w) for w in fresh.to_pylist()]
            short = pc.less_equal(pc.binary_length(fresh), LONGEST)
            self.known = pa.concat_arrays([self.known, fresh.filter(short)])
            self.counts = np.concatenate((self.counts, counts[new][short.to_numpy(zero_copy_only=False)]))
        each = counts[coded.indices.to_numpy(zero_copy_only=False)]
        heads = pieces.flat.take(pa.array(at)).dictionary_encode()  # a text's first word has no space before it
        each[at] = np.array([self.plain(w) for w in heads.dictionary.to_pylist()], np.int64)[heads.indices.to_numpy(zero_copy_only=False)]
        each[at[pieces.whole]] = [self.count(texts[i].as_py()) for i in pieces.whole.tolist()]
        return np.add.reduceat(each, at)


def token_table(docs: DataFrame, vocab_path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    A null or empty text has 0 of each; equal rows get equal counts; an empty table gives no rows.
    doc_id keeps its type and may be null; other columns are not read.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(MergeCounter, vocab_path)
        for whole in batches:
            for batch in slices(whole):
                tokens = pa.array(counter.tokens(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), tokens], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"), "text")
    out = rows.mapInArrow(counted, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
