"""Toxicity by maximum-scoring segments over token log-odds.

A token's score is the log-odds of its form (the word, else its longest known beginning) between toxic
and clean training documents under an informative Dirichlet prior; forms without clear evidence cost
a small constant. A linear scan finds all maximal segments of a text. Extreme-value statistics
turn a segment's score into the number of such segments that a clean text of that length has by
chance; the evidence of a text is the sum over its significant segments, calibrated to a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import staged
from .linear import sample
from .vocab import forget

#: Lengths of word beginnings that are forms of their own.
BEGINNINGS = (6, 5, 4, 3)
#: Bounds: training documents of a class, and what a worker holds: words with scores, counted forms.
PER_CLASS, MEMORY, COUNTED = 3_000, 200_000, 60_000
STRIP = "\"'.,;:!?()[]{}<>*_~`#%&$@^+=|/\\-–—«»“”„…¿¡"


def forms(word: str) -> list[str]:
    """A word's forms, most particular first; beginnings are marked with a trailing star."""
    w = word.strip(STRIP).lower()
    return [w, *(w[:n] + "*" for n in BEGINNINGS if len(w) > n)] if w else []


@dataclass
class Scores(dict):
    """self[word]: the score of a token as it stands in a text; 0 for neutral ones."""

    by_form: dict[str, float] = field(default_factory=dict)

    def __missing__(self, word: str) -> float:
        if len(self) > MEMORY:
            self.clear()
        got = next((self.by_form[f] for f in forms(word) if f in self.by_form), 0.0)
        if len(word) <= 64:
            self[word] = got
        return got


@dataclass
class Model:
    by_form: dict[str, float]
    cost: float = 0.05
    decay: float = 1.0
    spread: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    known: bool = True

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """Sum of -ln(expected number by chance) over the segments that are significant in ``n`` tokens."""
        over = math.log(max(self.spread * n, 1e-9))
        return sum(max(0.0, self.decay * s - over) for _, _, s in found)

    def probability(self, evidence: float) -> float:
        z = self.slope * min(evidence, 200.0) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def maximal_segments(scores: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a sequence, in linear time.

    ``scores`` has (position, score > 0 or < 0) in order; every position between costs ``cost``.
    A candidate knows the last one before it that begins at a smaller sum, so looking for the one to
    join skips those that later candidates have skipped already; where there is none, nothing that
    follows can reach the candidates any more and they are final.
    """
    final: list[tuple[int, int, float]] = []
    first, last, before, through, back = [], [], [], [], []  # of each candidate; back: the index of the one described above
    total, at = 0.0, 0
    for position, score in scores:
        total -= cost * (position - at)
        at = position + 1
        low, total = total, total + score
        if score <= 0:
            continue
        begin, j = position, len(first) - 1
        while j >= 0 and before[j] >= low:
            j = back[j]
        while j >= 0 and through[j] < total:  # join it, and look on from where it looked
            begin, low, k = first[j], before[j], back[j]
            del first[j:], last[j:], before[j:], through[j:], back[j:]
            j = k
        if j < 0:
            final += zip(first, last, map(float.__sub__, through, before), strict=True)
            first, last, before, through, back = [], [], [], [], []
        first.append(begin)
        last.append(position)
        before.append(low)
        through.append(total)
        back.append(j)
    final += zip(first, last, map(float.__sub__, through, before), strict=True)
    return final


def text_segments(text: str | None, scores: Scores, cost: float) -> tuple[list[tuple[int, int, float]], int]:
    words = (text or "").split()
    values = np.fromiter(map(scores.__getitem__, words), float, len(words))
    hits = np.flatnonzero(values)
    return maximal_segments(list(zip(hits.tolist(), values[hits].tolist(), strict=True)), cost), len(words)


def _counts(docs: DataFrame) -> DataFrame:
    """form, and in how many documents of each (part, toxic) it stands; one sum per task before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen = {(part, toxic): Counter() for part in range(PARTS) for toxic in (0, 1)}

        def told() -> pa.RecordBatch:
            keys = list(set().union(*seen.values()))
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in seen.values())], ["form", *COUNTS])
            for c in seen.values():
                c.clear()
            return out

        for batch in batches:
            for text, part, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "part", "toxic")), strict=True):
                seen[part, toxic].update({f for w in set((text or "").split()) for f in forms(w)})
                if sum(map(len, seen.values())) > COUNTED:
                    yield told()
        yield told()

    return docs.select("text", "part", "toxic").mapInArrow(counted, "form string, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("form").agg(*(F.sum(c).alias(c) for c in COUNTS))


#: Parts of the training documents: each is scored by the log-odds of the others. Documents of a form by class (c: clean, t: toxic) and part.
PARTS = 5
COUNTS = tuple(f"{toxic}{part}" for part in range(PARTS) for toxic in "ct")


def _log_odds(counts: DataFrame, sums: list[tuple[Column, Column]], weight: float, margin: float, strength: float) -> list[dict[str, float]]:
    """For each (toxic, clean) of ``sums`` the score of each form with clear and strong evidence for toxic documents.

    Odds are among all forms of a class's documents, so that longer documents don't make every form
    more frequent. The prior of a form is its share in both classes, worth ``weight`` times as much. The
    likelihood ratio of a form against chance must exceed the number of forms by e ** ``margin``; it must reach ``strength`` times the log-odds of one that clean documents never have, and a
    beginning goes if one longer form accounts for most of its toxic documents. All sums share two
    passes over the counts; only forms that pass come to the driver, as many as a bounded sample has.
    """
    aggs = [x for t, c in sums for x in (F.coalesce(F.sum(t), F.lit(0)), F.coalesce(F.sum(c), F.lit(0)), F.count_if(t + c >= 3))]
    totals = counts.agg(*(x.alias(f"a{i}") for i, x in enumerate(aggs))).first()
    wanted = []
    for k, (toxic, clean) in enumerate(sums):
        n_t, n_c, forms_ = totals[3 * k : 3 * k + 3]
        if not n_t or not n_c:
            continue
        prior, share = weight * (n_t + n_c), (toxic + clean) * weight
        logit = lambda y, m, prior=prior, share=share: F.log((y + share) / (F.greatest(F.lit(float(m)) - y, F.lit(0.0)) + F.greatest(F.lit(prior) - share, F.lit(0.5))))
        gain = lambda y, m, n=n_t + n_c, both=toxic + clean: F.when(y > 0, y * F.log(y * n / (m * both))).otherwise(0.0)
        delta, ratio = logit(toxic, n_t) - logit(clean, n_c), gain(toxic, n_t) + gain(clean, n_c)
        least = strength * math.log((1 + weight) / weight * n_c / n_t)
        passes = (toxic + clean >= 3) & (ratio >= math.log(max(forms_, 1)) + margin) & (delta >= least)
        wanted.append(F.when(passes, F.struct(F.lit(k).alias("k"), delta.alias("d"), toxic.alias("t"))))
    found: list[dict[str, tuple[float, int]]] = [{} for _ in sums]
    if wanted:
        rows = counts.select("form", F.array_compact(F.array(*wanted)).alias("odds")).where(F.size("odds") > 0)
        for form, odds in rows.collect():
            for k, d, t in odds:
                found[k][form] = (d, t)
    return [_own_evidence(x) for x in found]


def _own_evidence(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """The log-odds of forms (log-odds, toxic documents), without beginnings that one longer form accounts for."""
    most: dict[str, int] = {}  # toxic documents of the best longer form of each beginning
    for form, (_, t) in found.items():
        word = form.removesuffix("*")
        for n in BEGINNINGS:
            if n < len(word):
                most[word[:n] + "*"] = max(most.get(word[:n] + "*", 0), t)
    return {form: d for form, (d, t) in sorted(found.items()) if most.get(form, 0) < 0.7 * t}


def _decay(positive: list[float], tokens: int, cost: float) -> float:
    """The exponent at which the expected weight of a token of clean text is one."""
    hits = [*positive, *([max(positive, default=1.0)] if not positive else []), 3.0]  # one more than seen: never without a chance
    n = max(tokens, 10)

    def excess(x: float) -> float:
        return sum(math.exp(min(50.0, x * s)) for s in hits) / n + (1 - len(hits) / n) * math.exp(-x * cost) - 1

    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 0.05)


def fit(docs: DataFrame, labels: DataFrame, prior: float = 0.05, margin: float = 1.0, strength: float = 0.65, cost: float = 0.05) -> Model:
    """Model from ``docs`` (doc_id, text) whose ids ``labels`` (doc_id, toxic) marks.

    About PER_CLASS documents of each class are used (a fixed bound of the model). For the calibration
    each of PARTS parts of them is scored by the log-odds of the others. Labels that contradict each other count as toxic; null
    labels are ignored, and equal texts count once. Without documents of both classes every score is 0.
    """
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(share) < 2:
        return Model({}, offset=-30.0, known=False)
    chosen = sample(marks, "toxic", PER_CLASS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int"))
    counts = staged(_counts(rows), "forms")
    total = lambda toxic, without=None: sum((F.col(f"{toxic}{k}") for k in range(PARTS) if k != without), F.lit(0))
    *other, by_form = _log_odds(counts, [(total("t", k), total("c", k)) for k in (*range(PARTS), None)], prior, margin, strength)
    model = Model(by_form, cost)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scores = [Scores(by_form=x) for x in other]
        for batch in batches:
            out = [text_segments(t, scores[h], cost) for t, h in zip(batch.column("text").to_pylist(), batch.column("part").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([n for _, n in out], pa.int64()), pa.array([[s for *_, s in f] for f, _ in out], pa.list_(pa.float64()))], ["toxic", "n", "found"])

    seen = rows.select("toxic", "part", "text").mapInArrow(measured, "toxic int, n long, found array<double>").collect()  # about twice PER_CLASS rows
    clean = [r for r in seen if not r["toxic"]]
    model.decay = _decay([s for r in clean for s in r["found"]], sum(r["n"] for r in clean), cost)
    weight = sum(max(r["n"], 1) * math.exp(-model.decay * max(r["found"], default=0.0)) for r in clean)
    model.spread = max(len(clean) / weight, 1e-6) if weight else 1.0
    x = np.array([min(model.evidence([(0, 0, s) for s in r["found"]], r["n"]), 200.0) for r in seen])
    y = np.array([r["toxic"] for r in seen], float)
    model.slope, model.offset = _logistic(x, y)
    drawn = y.mean() if len(y) else 0.5
    if 0 < drawn < 1:  # from the classes' shares in the sample to those among all labels
        model.offset += math.log(share[1] / share[0]) - math.log(drawn / (1 - drawn))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a small ridge."""
    a, b = 0.1, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 1e-2 * a, (p - y).sum() + 1e-2 * b])
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), spans: bool = False) -> DataFrame:
    """The columns ``keep``, score (0 to 1), predicted (score >= 0.5) and, if asked for, the significant segments.

    Every whole text is read; a null or empty one has no segment and the score of no evidence. Equal
    rows get equal scores. Segments are word positions (first, last) with their score.
    """
    fields = [docs.schema[c] for c in keep]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scores = Scores(by_form=model.by_form)
        for batch in batches:
            found = [text_segments(t, scores, model.cost) for t in batch.column("_text").to_pylist()]
            p = [model.probability(model.evidence(f, n)) for f, n in found]
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32())]
            if spans:
                over = [math.log(max(model.spread * n, 1e-9)) for _, n in found]
                columns.append(pa.array([[{"first": a, "last": b, "score": s} for a, b, s in f if model.decay * s > o] for (f, _), o in zip(found, over, strict=True)], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*keep, "score", "predicted", *["segments"] * spans]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double, predicted int", *["segments array<struct<first:long,last:long,score:double>>"] * spans])
    return docs.select(*(docs[c] for c in keep), docs["text"].alias("_text")).mapInArrow(told, schema)
