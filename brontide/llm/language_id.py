"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are hashed character n-grams of the lower-cased text with TF-IDF weights, scaled to unit
length. The weights are trained online by follow-the-regularised-leader with elastic-net penalties,
which leaves most of them exactly zero; a temperature fitted on rows held back from a first training makes
the scores probabilities, then all rows train. Training sees a bounded sample of whole texts; prediction reads every
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import sample
from .vocab import forget

#: Bounds: training rows of a language, hash bits, and characters worked on at a time.
PER_LANGUAGE, BITS, BLOCK = 400, 16, 1 << 18
ORDERS = (1, 2, 3)
UNKNOWN = "und"


def hashed(codes: np.ndarray) -> list[np.ndarray]:
    """For each order the hashed n-grams of a text given as code points, by position."""
    mixed = (codes.astype(np.uint32) + np.uint32(1)) * np.uint32(2654435761)
    out, gram = [], np.zeros(len(codes), np.uint32)
    for n in ORDERS:
        if len(codes) < n:
            break
        gram = (gram[: len(codes) - n + 1] * np.uint32(0x85EBCA6B)) ^ mixed[n - 1 :]
        out.append(((gram * np.uint32(0xC2B2AE35) + np.uint32(n)) >> np.uint32(32 - BITS)).astype(np.int64))
    return out


def term_counts(text: str) -> np.ndarray:
    """How often each hashed n-gram stands in a whole text; n-grams across blocks are counted too."""
    low = text.lower()
    total, over = np.zeros(1 << BITS, np.int64), max(ORDERS) - 1
    for at in range(0, len(low), BLOCK):
        back = min(at, over)
        codes = np.frombuffer(low[at - back : at + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        for n, grams in zip(ORDERS, hashed(codes), strict=False):
            total += np.bincount(grams[max(0, back - n + 1) :], minlength=1 << BITS)  # those that end in this block
    return total


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of a text and how often each stands: at most 2 ** BITS of them, however long the text."""
    counts = term_counts(text)
    at = np.flatnonzero(counts)
    return at, counts[at]


def features(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the TF-IDF vector of unit length; terms count as 1 + ln(times)."""
    at, times = found
    values = (1 + np.log(times)) * idf[at]
    length = np.sqrt((values * values).sum())
    return at, values / length if length else values


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        at, values = features(terms(text), self.idf)
        return (values @ self.weights[at] + self.bias) / self.temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; ``und`` with 0 for a text that is null or has no letter."""
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        z = self.logits(text)
        p = np.exp(z - z.max())
        best = int(z.argmax())
        return self.languages[best], float(p[best] / p.sum())


def _train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float, beta: float, l1: float, l2: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal updates, one row at a time; column 0 of the state is the bias, without penalty."""
    z, n = np.zeros((1 + (1 << BITS), classes)), np.zeros((1 + (1 << BITS), classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        free = np.where((at == 0)[:, None], 0.0, l1)
        return np.where(np.abs(zs) <= free, 0.0, -(zs - np.sign(zs) * free) / ((beta + np.sqrt(ns)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            at, values, y = rows[i]
            at, x = np.append(0, at + 1), np.append(1.0, values)
            w = weights(at)
            p = x @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(len(z)))
    return w[1:], w[0]


def fit(docs: DataFrame, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, rounds: int = 3) -> Model:
    """Model from the rows of ``docs`` (doc_id, text, lang) with a language and a text.

    About PER_LANGUAGE rows of each language are used. Without any such row there are no languages,
    and every prediction is ``und``.
    """
    rows = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t) for t in batch.column("text").to_pylist()]
            lists = [pa.array([x[i].astype("int64") for x in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), *lists], ["doc_id", "lang", "at", "times"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    chosen = sample(rows, "lang", PER_LANGUAGE).select("doc_id", "lang", "text").mapInArrow(told, f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, at array<long>, times array<long>")
    rows = [(lang, (np.array(at, np.int64), np.array(times, np.int64))) for _, lang, at, times in sorted(map(tuple, chosen.collect()))]
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    seen = np.zeros(1 << BITS)
    for _, (at, _) in rows:
        seen[at] += 1
    idf = np.log((1 + len(rows)) / (1 + seen)) + 1
    coded = [(*features(found, idf), languages.index(lang)) for lang, found in rows]
    held = [r for i, r in enumerate(coded) if i % 5 == 0] or coded
    weights, bias = _train([r for i, r in enumerate(coded) if i % 5] or coded, len(languages), alpha, beta, l1, l2, rounds)
    logits, y = np.array([v @ weights[at] + bias for at, v, _ in held]), np.array([y for *_, y in held])

    def loss(t: float) -> float:
        z = logits / t
        top = z.max(1, keepdims=True)
        return float((np.log(np.exp(z - top).sum(1)) + top[:, 0] - z[np.arange(len(y)), y]).mean())

    temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    # then all rows train, so a language whose only rows were held back is learned too
    weights, bias = _train(coded, len(languages), alpha, beta, l1, l2, rounds)
    return Model(languages, idf, weights, bias, float(temperature))


def identified(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred and score of every row; equal rows get equal results."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            out = [model.predict(t) for t in batch.column("_text").to_pylist()]
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array([a for a, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*keep, "lang_pred", "score"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "lang_pred string, score double"])
    return docs.select(*(docs[c] for c in keep), docs["text"].alias("_text")).mapInArrow(told, schema)
