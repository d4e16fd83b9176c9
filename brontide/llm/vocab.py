"""Tokenizing whole texts with the public tokenizer files, a word at a time.

A tokenizer never merges across the single spaces of ordinary prose, so the ids of a text are the
ids of its words in a row. Words repeat; each Python worker keeps the ids of those it has met and
asks the library only for new ones. Texts for which the cut at spaces might not be exact (special
strings, or white space after a space) go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers (about 40 bytes each), the longest such word in bytes, and bytes of text worked on at once.
MEMORY, LONGEST, BYTES = 600_000, 64, 4 << 20
#: White space after a space (what ``\s`` means in Python, which is more than Arrow's), or a special string.
_NOT_CUT = r" ([\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)|<\|"
#: Letters from U+0250 on, and the dotted capital I, may have other forms than one lower-case letter.
_BEYOND_LATIN = re.compile("[\u0130\u0250-\U0010ffff]")


def kept(make, *key):
    """make(*key), made once in a Python worker and kept for its later tasks (one such thing at a time).

    Functions travel to the workers by value, so their own module cannot hold what should outlive a task.
    """
    state = vars(sys.modules.setdefault("_brontide_worker", types.ModuleType("_brontide_worker")))
    name = (make.__name__, *key)
    if state.get("name") != name:
        state |= {"name": name, "made": make(*key)}
    return state["made"]


def forget() -> None:
    """Free what an earlier task of another operator has kept in this Python worker."""
    vars(sys.modules.get("_brontide_worker", types.ModuleType("none"))).pop("made", None)
    vars(sys.modules.get("_brontide_worker", types.ModuleType("none"))).pop("name", None)


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Pieces(NamedTuple):
    """The pieces of all texts in a row, where each text's begin (every text has one), and the texts that are not cut."""

    flat: pa.Array
    starts: np.ndarray
    whole: np.ndarray


def cut_pieces(texts: pa.Array, glued: bool) -> Pieces:
    """Pieces whose tokens can be found one by one; a text for which that isn't certain, or that has nothing, is one empty piece."""
    texts = pc.fill_null(texts, "")
    whole = pc.match_substring_regex(texts, _NOT_CUT) if glued else pc.match_substring(texts, "<|")
    at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    if len(at):
        texts = pc.if_else(whole, "", texts)
    lists = pc.split_pattern(texts if glued else pc.replace_substring(texts, "\n", " "), " ")
    n = pc.list_value_length(lists).to_numpy()
    return Pieces(lists.flatten(), (np.cumsum(n) - n).astype(np.int64), at)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about BYTES of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def ended(flat: np.ndarray, n: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts in a row and their counts, with ``end_id`` after each text."""
    return np.insert(flat, np.cumsum(n), end_id), n + 1


def gathered(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``store`` that begin at ``starts``, in a row."""
    ends = np.cumsum(lengths, dtype=np.int32)  # far below 2**31: a slice has about BYTES of text
    where = np.repeat(starts - (ends - lengths), lengths)
    where += np.arange(len(where), dtype=np.int32)
    return store[where]


class WordIds:
    """Token ids of whole texts as unsigned 16-bit integers.

    ``glued``: a space belongs to the word after it (byte-level tokenizers); otherwise white space
    carries no token (word-level tokenizers). Arrow cuts a batch at spaces, numbers its different words
    and finds those that are known; the library is asked for the others, and a text's ids are gathered
    from one array that holds the ids of all words met so far. No word that is known becomes a Python object.
    """

    def __init__(self, path: str, glued: bool):
        self.tokenizer, self.glued = load(path), glued
        n = self.tokenizer.get_vocab_size()
        if n > 1 << 16:
            raise ValueError("ids are kept in 16 bits; this vocabulary has more")
        #: Many words are encoded as one text; what marks where a word's ids begin.
        self.between = " " if glued else " \x01 "
        self.begins = np.zeros(n, bool)
        #: The same tokenizer without its normalizer, for text that needs no more of it than lower case.
        self.lower = None
        if glued:
            space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
            self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(space)]] = True
        else:
            (mark,) = self.tokenizer.encode("\x01", add_special_tokens=False).ids
            self.begins[mark] = True
            spec = json.loads(self.tokenizer.to_str())
            if [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
                self.lower = type(self.tokenizer).from_str(json.dumps(spec | {"normalizer": None}))
        self._clear()

    def _clear(self) -> None:
        """Forget all words; number 0 stays the empty one."""
        self.known, self.heads = pa.array([""], pa.string()), {}
        self.store, self.used = np.zeros(1 << 20, "<u2"), 0
        self.starts, self.lengths, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), 1
        self.again = np.zeros(1, bool)  # which words have been met since they were learned

    def _shrink(self) -> None:
        """Keep the words met more than once; forget all if those are too many."""
        keep = self.again.copy()
        keep[0] = True
        if keep.sum() > MEMORY // 2:
            return self._clear()
        known, heads, starts, lengths, store = self.known.filter(pa.array(keep)), self.heads, self.starts[: len(keep)][keep], self.lengths[: len(keep)][keep], self.store
        self._clear()
        self.known, self.heads, self.n = known, heads, 0
        self._keep(gathered(store, starts, lengths), lengths.astype(np.int64))
        self.again = np.zeros(self.n, bool)

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def _many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of up to a few thousand words without white space, found together, and how many each has."""
        text, tokenizer = self.between + self.between.join(words), self.tokenizer
        if self.lower and not _BEYOND_LATIN.search(text):
            text, tokenizer = text.lower(), self.lower
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
        begins = self.begins[ids]
        starts = np.flatnonzero(begins)
        if len(starts) != len(words):
            raise AssertionError("a word's first token isn't known by its mark")
        lengths = np.diff(starts, append=len(ids))
        return (ids, lengths) if self.glued else (ids[~begins], lengths - 1)

    def _keep(self, flat: np.ndarray, lengths: np.ndarray) -> int:
        """Put the ids of words into the store; the number of the first."""
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate((self.store, np.zeros_like(self.store)))
        while self.n + len(lengths) > len(self.starts):
            self.starts, self.lengths = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.lengths))
        first, here = self.n, slice(self.n, self.n + len(lengths))
        self.store[self.used : self.used + len(flat)] = flat
        self.starts[here], self.lengths[here] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used, self.n = self.used + len(flat), self.n + len(lengths)
        return first

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of different words; those that are new are learned, long and odd ones for the moment only."""
        at = pc.index_in(words, value_set=self.known)
        out, new = pc.fill_null(at, 0).to_numpy().astype(np.int32), np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        self.again[out] = True
        if not len(new):
            return out
        fresh = words.take(pa.array(new))
        odd = pc.or_(pc.greater(pc.binary_length(fresh), LONGEST), pc.match_substring_regex(fresh, "\x01|<\\|")).to_numpy(zero_copy_only=False)
        plain = fresh.filter(pa.array(~odd))
        first = self.n
        for k in range(0, len(plain), 2_000):
            self._keep(*self._many(plain.slice(k, 2_000).to_pylist()))
        self.known = pa.concat_arrays([self.known, plain])
        self.again = np.concatenate((self.again, np.zeros(len(plain), bool)))
        out[new[~odd]] = np.arange(first, first + len(plain))
        out[new[odd]] = self._passing([self._one(" " * self.glued + w) for w in fresh.filter(pa.array(odd)).to_pylist()])
        return out

    def _passing(self, found: list[np.ndarray]) -> np.ndarray:
        """Numbers of what the store holds for one batch only: they follow all that it keeps."""
        if not found:
            return np.zeros(0, np.int32)
        first = self._keep(np.concatenate(found), np.array([len(x) for x in found], np.int64))
        return np.arange(first, first + len(found), dtype=np.int32)

    def _head(self, word: str) -> np.ndarray:
        """The ids of a word at the beginning of a text, which has no space before it."""
        got = self.heads.get(word)
        if got is None:
            got = self._one(word)
            if len(word) <= LONGEST and len(self.heads) < MEMORY // 8:
                self.heads[word] = got
        return got

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) in a row, and how many each text has."""
        if not len(texts):
            return np.zeros(0, "<u2"), np.zeros(0, np.int64)
        if self.n > MEMORY:
            self._shrink()
        pieces = cut_pieces(texts, self.glued)
        coded, at = pieces.flat.dictionary_encode(), pieces.starts
        numbers = self._numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        if self.glued:
            heads = pieces.flat.take(pa.array(at)).dictionary_encode()
            own = self._passing([self._head(w) for w in heads.dictionary.to_pylist()])
            numbers[at] = own[heads.indices.to_numpy(zero_copy_only=False)]
        numbers[at[pieces.whole]] = self._passing([self._one(texts[i].as_py()) for i in pieces.whole.tolist()])
        lengths = self.lengths[numbers]
        out = gathered(self.store, self.starts[numbers], lengths)
        self.n = len(self.known)
        self.used = int(self.starts[self.n - 1] + self.lengths[self.n - 1])
        return out, np.add.reduceat(lengths.astype(np.int64), at)

    def ids(self, texts: Iterable[str | None]) -> list[bytes]:
        """For each text its ids as little-endian bytes."""
        flat, n = self.flat(pa.array(list(texts), pa.string()))
        data, ends = flat.tobytes(), np.cumsum(n) * 2
        return [data[a:b] for a, b in zip((ends - n * 2).tolist(), ends.tolist(), strict=True)]
