"""The registered queries on a whole table against the libraries or plain second implementations."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from brontide.llm import language_id, queries, toxicity, vocab  # noqa: E402

from ..conftest import SMALL  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_packing_of_the_whole_table(spark, docs):
    library, pieces, sequences = vocab.load(public_tokenizers.path("word_bpe_49k.json")), {}, {}
    for r in queries.op1_packing(spark, SMALL).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for i, rows in pieces.items():
        ids, at = np.array([*library.encode(docs[i].text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(rows, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.02 * math.ceil(sum(n for p in sequences.values() for _, n in p) / 2048) + 1


def test_token_files_and_counts_of_the_whole_table(spark, docs):
    library, start = vocab.load(public_tokenizers.path("byte_bpe_50k.json")), 0
    files = {r.doc_id: r for r in queries.op9_token_files(spark, SMALL).collect()}
    counts = {r.doc_id: r for r in queries.op10_token_counts(spark, SMALL).collect()}
    assert set(files) == set(counts) == set(docs)
    for i in sorted(docs):
        ids = np.array([*library.encode(docs[i].text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert (counts[i].n_bytes, counts[i].n_tokens, counts[i].over_limit) == (len((docs[i].text or "").encode()), len(ids) - 1, len(ids) - 1 > 1024)
        start += len(ids)


def test_classifiers_return_a_row_a_document(spark, docs):
    scored, told = queries.op2_toxicity(spark, SMALL), queries.op7_language_id(spark, SMALL)
    assert scored.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert told.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    a, b = {r.doc_id: r for r in scored.collect()}, {r.doc_id: r for r in told.collect()}
    assert set(a) == set(b) == set(docs)
    assert all(r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in a.items())
    languages = {d.lang for d in docs.values()} | {"und"}
    assert all(r.held_out == (fold(i, 4) == 2) and 0 <= r.score <= 1 and r.lang_pred in languages for i, r in b.items())
    held = [(b[i].lang_pred, d.lang) for i, d in docs.items() if b[i].held_out and d.lang]
    assert sum(p == w for p, w in held) >= 0.9 * len(held)


def test_log_odds_and_calibration_by_plain_counts(spark):
    import random

    rnd, words = random.Random(2), [f"word{chr(97 + i % 26)}{i}" for i in range(60)]
    rows = []
    for i in range(120):
        toxic = i % 3 == 0
        text = [rnd.choice(words) for _ in range(30)] + ([rnd.choice(["vileness", "vilely", "grossest"]) for _ in range(4)] if toxic else [])
        rnd.shuffle(text)
        rows.append((i, " ".join(text), int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    seen = {t: Counter(f for _, text, x in rows if x == t for f in {f for w in set(text.split()) for f in toxicity.forms(w)}) for t in (0, 1)}
    n_c, n_t = (sum(seen[t].values()) for t in (0, 1))
    every = {f for f in seen[0] | seen[1] if seen[0][f] + seen[1][f] >= 3}
    want = {}
    for f in every:
        c, t = seen[0][f], seen[1][f]
        share, prior = 0.05 * (c + t), 0.05 * (n_c + n_t)
        odds = lambda y, n, share=share, prior=prior: math.log((y + share) / (n - y + prior - share))
        gain = sum(y * math.log(y * (n_c + n_t) / (n * (c + t))) for y, n in ((t, n_t), (c, n_c)) if y)
        d = odds(t, n_t) - odds(c, n_c)
        if gain >= math.log(len(every)) + 1 and d >= 0.65 * math.log(1.05 / 0.05 * n_c / n_t):
            want[f] = (d, t)
    assert model.by_form.keys() == toxicity._own_evidence(want).keys() and model.by_form
    assert all(abs(model.by_form[f] - want[f][0]) < 1e-9 for f in model.by_form)
    got = {r.doc_id: r.score for r in toxicity.scored(table, model).collect()}
    assert min(got[i] for i, _, x in rows if x) > max(got[i] for i, _, x in rows if not x)


def test_ftrl_equals_a_plain_second_implementation():
    r = np.random.default_rng(1)
    rows = [(np.sort(r.choice(40, 6, replace=False)), r.random(6), int(r.integers(3))) for _ in range(25)]
    got_w, got_b = language_id._train(rows, 3, 0.5, 1.0, 0.02, 0.1, 2)
    z, n, order = Counter(), Counter(), np.random.default_rng(7)

    def weight(j, c):
        if j != "bias" and abs(z[j, c]) <= 0.02:
            return 0.0
        return -(z[j, c] - math.copysign(0.0 if j == "bias" else 0.02, z[j, c])) / ((1.0 + math.sqrt(n[j, c])) / 0.5 + 0.1)

    for _ in range(2):
        for i in order.permutation(len(rows)):
            at, values, y = rows[i]
            x = {"bias": 1.0, **dict(zip(at.tolist(), values.tolist(), strict=True))}
            w = {(j, c): weight(j, c) for j in x for c in range(3)}
            logit = [sum(v * w[j, c] for j, v in x.items()) for c in range(3)]
            top = [math.exp(v - max(logit)) for v in logit]
            for c in range(3):
                error = top[c] / sum(top) - (c == y)
                for j, v in x.items():
                    g = v * error
                    z[j, c] += g - (math.sqrt(n[j, c] + g * g) - math.sqrt(n[j, c])) / 0.5 * w[j, c]
                    n[j, c] += g * g
    assert all(abs(got_b[c] - weight("bias", c)) < 1e-9 for c in range(3))
    assert all(abs(got_w[j, c] - weight(j, c)) < 1e-9 for j in range(40) for c in range(3))


def test_segments_take_linear_time():
    import time

    def seconds(n):
        t = time.process_time()
        toxicity.maximal_segments([(20 * i, 0.5) for i in range(n)], 0.05)
        return time.process_time() - t

    seconds(2_000)
    assert seconds(200_000) < 30 * max(seconds(20_000), 0.005)
