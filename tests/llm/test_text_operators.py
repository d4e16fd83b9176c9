"""The text operators against brute force, round trips and hard rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from brontide.llm import language_id, licenses, mixing, ngram_join, packing, token_count, token_files, toxicity, vocab  # noqa: E402

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n\n", "a", "Hello, World!", "two  spaces   here ", " lead", "x\n \nw", "it's  don't\t\tx", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "é É İ ß Σς ﬁ", "日本 語 ok",
    "a b c\x1cd", "word " * 3000, "z" * 20_000, "123 4567 8a9!? ''' 'll", "same text again", "same text again", "é café K",
]


def documents(spark, texts, **more):
    """Documents with columns whose names clash with what the operators make."""
    rows = [(i, t, more.get("lang", ["en"] * len(texts))[i], more.get("source", ["s"] * len(texts))[i], i, "x", 1.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, score double")


def library(path, end=None):
    t = vocab.load(path)
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, *([] if end is None else [end])], "<u4")


def test_word_by_word_ids_equal_the_librarys():
    for path, glued in ((WORD, False), (BYTE, True)):
        ids = vocab.WordIds(path, glued)
        for _ in range(2):  # with and without remembered words
            assert [np.frombuffer(x, "<u2").tolist() for x in ids.ids(TEXTS)] == [library(path)(t).tolist() for t in TEXTS]


def test_merge_counts_equal_the_librarys(spark):
    got = {r.doc_id: r for r in token_count.token_table(documents(spark, TEXTS), BYTE, 1024).collect()}
    for i, t in enumerate(TEXTS):
        n = len(library(BYTE)(t))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 1024)


def test_merge_counts_of_random_bytes():
    rnd, counter, count = random.Random(1), token_count.MergeCounter(BYTE), library(BYTE)
    for _ in range(300):
        text = "".join(rnd.choice("abehinost  ',.\n1é€😀") for _ in range(rnd.randint(0, 60)))
        assert counter.count(text) == len(count(text))


def test_packing_places_every_id_once(spark):
    rows = packing.pack(documents(spark, TEXTS), WORD, window=64, end_id=1, keep_ids=True).collect()
    want, got, fill = library(WORD, 1), {i: {} for i in range(len(TEXTS))}, {}
    for r in rows:
        ids = np.array(r.ids, "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and len(ids) == r.length <= 64
        got[r.doc_id][r.start] = r.ids
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in enumerate(TEXTS):
        assert [x for s in sorted(got[i]) for x in got[i][s]] == want(t).tolist()
    for parts in fill.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(n for _, n in parts) <= 64
    assert packing.packed_sequences(spark.createDataFrame(rows)).count() == len(fill)


def test_slack_plan_wastes_nothing_that_fits():
    rnd = random.Random(2)
    for _ in range(30):
        window = rnd.choice([10, 64, 100])
        counts = {n: rnd.randint(0, 30) for n in range(1, window)}
        plan, sequences = packing.slack_plan(window, counts)
        used, fill = dict.fromkeys(counts, 0), [[] for _ in range(sequences)]
        ends = {}
        for n, ordinal, sequence, each, offset in plan:
            ends.setdefault(n, []).append((ordinal, sequence, each, offset))
        for n, rows in ends.items():
            for k, (ordinal, sequence, each, offset) in enumerate(sorted(rows)):
                stop = sorted(rows)[k + 1][0] if k + 1 < len(rows) else counts[n]
                for q in range(ordinal, stop):
                    s, slot = divmod(q - ordinal, each)
                    fill[sequence + s].append((offset + slot * n, n))
                    used[n] += 1
        assert used == counts
        for parts in fill:
            parts.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(n for _, n in parts) <= window
    assert packing.closest_fill(10, [7, 4, 3], {7: 1, 4: 1, 3: 5}) == {7: 1, 3: 1}


def test_token_files_round_trip(spark, tmp_path):
    for coding in token_files.CODING:
        path = str(tmp_path / coding)
        token_files.write_token_files(documents(spark, TEXTS).repartition(3), path, BYTE, 2, coding)
        table, want, start = token_files.read_token_files(spark, path), library(BYTE, 2), 0
        digests = {r.doc_id: r for r in token_files.token_digests(table).collect()}
        ids = {r.doc_id: r.ids for r in table.collect()}
        for i, t in enumerate(TEXTS):
            w = want(t)
            assert ids[i] == w.tolist() and (digests[i].start, digests[i].n_tokens, digests[i].ids_crc32) == (start, len(w), zlib.crc32(w.tobytes()))
            start += len(w)
    pages = table.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in pages.split("ReadSchema")[-1]


def test_licenses_against_a_direct_search(spark):
    texts = [*TEXTS, "Released under the MIT License.", "MIT license mit LICENSE", "the GNU  General-Public license and Apache License, cc\nby", "limit license", "İMIT LICENSE", "mitK license", "cc", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"]
    word, fold = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {i: i + 32 for i in range(65, 91)}
    got = {r.doc_id: r for r in licenses.scan(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w = word.findall((t or "").translate(fold))
        at = {label: [k for k in range(len(w)) if w[k : k + len(p.split())] == p.split()] for p, label in licenses.PHRASES.items()}
        places = [k for v in at.values() for k in v]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(k for k, v in at.items() if v)))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[len(texts) - 1].labels == "mit" and got[len(texts) - 1].base_labels == "" and got[5].labels == ""


def test_license_spans_of_an_edited_copy(spark):
    label, notice = licenses.NOTICES[3]
    words = notice.split()
    edited = " ".join(["before"] * 40 + words[:10] + ["inserted"] + words[10:] + ["after"] * 40)
    (span,) = [s for s in licenses.scan(documents(spark, [edited])).first().spans if s["label"] == label and s["cover"] < 1]
    assert span["first"] == 40 and 0.6 <= span["cover"] < 1


def jaccard_components(texts, n, percent):
    word, fold = re.compile(r"[^\x20\x09-\x0D]+"), {i: i + 32 for i in range(65, 91)}
    sets = []
    for t in texts:
        w = word.findall((t or "").translate(fold))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    of = list(range(len(texts)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                of[max(x, y)] = min(x, y)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("n", "percent", "block"), [(3, 90, 300), (5, 80, 1_000_000)])
def test_large_groups_are_cut_into_voronoi_regions(spark, monkeypatch, n, percent, block):
    """Chains of edits: groups that no pivot connects at once, cut round after round; counters show that cells are made."""
    monkeypatch.setattr(ngram_join, "LARGE", 12)
    monkeypatch.setattr(ngram_join, "PIVOTS", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd, texts = random.Random(n), []
    for chain in range(4):
        now = [f"c{chain}w{i}" for i in range(60)]
        for step in range(45):
            texts.append(" ".join(now))
            now = list(now)
            now[step % 60] = f"x{rnd.randrange(10**6)}"
    base = [f"b{i}" for i in range(80)]
    texts += [" ".join(w if rnd.random() > 0.02 else f"y{rnd.randrange(10**6)}" for w in base) for _ in range(60)]  # near copies of one text
    texts += [texts[0], texts[50]]
    rounds, cut = [], ngram_join._cut
    monkeypatch.setattr(ngram_join, "_cut", lambda *a: rounds.append(cut(*a)) or rounds[-1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked(documents(spark, texts).repartition(3), n, percent).collect()}
    assert [got[i] for i in range(len(texts))] == jaccard_components(texts, n, percent)
    cells = rounds[0].where("inside").groupBy("group", "pivot").count()
    assert cells.count() >= 8 and len(rounds) >= (2 if percent == 90 else 1)  # windows are wide at 80: groups stay whole, with a core


def test_ngram_join_links_rows_without_ids_and_with_repeated_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (None, text + " eleven"), (None, "apart from all others here"), (4, text), (4, "of its own kind entirely"), (3, text), (3, text), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, key int, ident int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked(docs, 3, 80).collect()), key=str)
    want = [(None, 8, 3), (None, 9, 3), (None, 3, None), (4, 8, 3), (4, 3, 4), (3, 8, 3), (3, 8, 3), (9, 0, 9), (None, 0, None)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_ngram_join_against_all_pairs(spark, n, percent):
    rnd, texts = random.Random(n), list(TEXTS)
    words = [f"w{i}" for i in range(400)]
    for size in (4, 9, 25, 60, 300):
        base = [rnd.choice(words) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append(" ".join(copy) if rnd.random() < 0.5 else " ".join(copy).upper())
    passage = " ".join(words[:60])
    texts += [f"{passage} {' '.join(rnd.choice(words) for _ in range(rnd.randint(5, 60)))}" for _ in range(25)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked(documents(spark, texts).repartition(3), n, percent).collect()}
    assert [got[i] for i in range(len(texts))] == jaccard_components(texts, n, percent)


def test_region_join_equals_all_pairs():
    rnd = random.Random(9)
    sets = [np.unique(np.array([rnd.randrange(60) for _ in range(rnd.choice([10, 30, 40]))], np.uint64)) for _ in range(150)]
    sets += [np.append(s[:-1], np.uint64(1000 + i)) for i, s in enumerate(sets[:60])]
    region = ngram_join.Region(sets, 80)
    region.scan(np.arange(len(sets)))
    of = list(range(len(sets)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(np.intersect1d(a, sets[j]))
            if 100 * k >= 80 * (len(a) + len(sets[j]) - k):
                of[max(root(i), root(j))] = min(root(i), root(j))
    same = lambda f: {frozenset(i for i in range(len(sets)) if f(i) == r) for r in map(f, range(len(sets)))}
    assert same(root) == same(region.root)


def test_mixing_against_reshared_targets(spark):
    rnd = random.Random(4)
    sizes = {"a": 10, "b": 2000, "c": 50, None: 700, "é": 5}
    texts, sources = [], []
    for source, size in sizes.items():
        for _ in range(size // 5):
            texts.append(" ".join(["w"] * rnd.randint(1, 9)))
            sources.append(source)
    rows = mixing.taken_words(documents(spark, texts, source=sources), (1, 2, 3), 3.0).collect()
    own = {}
    for t, s in zip(texts, sources, strict=True):
        own[s] = own.get(s, 0) + len(t.split())
    names = sorted((s for s in own if s is not None)) + [None]
    weight, target, rest, open_ = {s: 1 + i % 3 for i, s in enumerate(names)}, {}, sum(own.values()), set(names)
    while over := [s for s in open_ if rest * weight[s] / sum(weight[x] for x in open_) > 3 * own[s]]:
        for s in over:
            target[s] = 3 * own[s]
            open_.discard(s)
        rest = sum(own.values()) - sum(target.values())
    target |= {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
    taken = dict.fromkeys(own, 0)
    for r in rows:
        s = sources[r.doc_id]
        taken[s] += r.taken
        assert abs(r.target - target[s]) < 1e-6 and r.source_size == own[s] and r.taken <= 3 * r.size == 3 * len(texts[r.doc_id].split())
    assert all(abs(taken[s] - target[s]) <= 9 for s in own)
    mixed = mixing.mixed(documents(spark, texts, source=sources)).groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))).alias("n")).collect()
    assert {r.source: r.n for r in mixed} == {s: n for s, n in taken.items() if n}


def test_maximal_segments_against_all_subarrays():
    rnd = random.Random(6)
    for _ in range(200):
        values = [rnd.choice([3.0, 1.0, -1.0, -0.25, -0.25, -2.0]) for _ in range(rnd.randint(1, 14))]
        at = [(i, v) for i, v in enumerate(values) if v not in (-0.25,)]

        def pieces(a, b, values=values):
            """The best subarray, then the best ones to both sides of it."""
            best = max(((sum(values[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            return [] if best[0] <= 0 else pieces(a, best[3]) + [(best[3], best[4] - 1, best[0])] + pieces(best[4], b)

        got = toxicity.maximal_segments(at, 0.25)
        assert [round(s, 6) for *_, s in got] == [round(s, 6) for *_, s in pieces(0, len(values))]


def test_toxicity_learns_from_labels_only(spark):
    rnd = random.Random(8)
    clean = ["river", "stone", "cloud", "table", "green", "paper", "light", "round"]
    texts = [" ".join(rnd.choice(clean) for _ in range(60)) for _ in range(300)] + [None, ""]
    for i in range(0, 300, 3):
        texts[i] += " awful nasty awful " + " ".join(rnd.choice(clean) for _ in range(20))
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 200)] + [(900, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = {r.doc_id: r for r in toxicity.scored(docs, model, spans=True).collect()}
    assert all(out[i].predicted == int(i % 3 == 0) for i in range(200, 300)) and out[300].predicted == out[301].predicted == 0
    assert out[201].segments and not out[200].segments and all(0 <= r.score <= 1 for r in out.values())
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.scored(docs, nothing).collect()} == {0}


def test_language_identification(spark):
    rnd = random.Random(3)
    stems = {"en": ["the", "ing", "and", "tion"], "de": ["der", "ung", "sch", "üß"], "xx": ["qqa", "zzu", "vvo"]}
    texts, langs = [], []
    for i in range(240):
        lang = list(stems)[i % 3]
        texts.append(" ".join("".join(rnd.choice(stems[lang]) for _ in range(3)) for _ in range(30)))
        langs.append(lang if i < 180 else None)
    texts += [None, "", "123 !?", "the " * 200_000]
    langs += [None] * 4
    docs = documents(spark, texts, lang=langs)
    model = language_id.fit(docs)
    out = {r.doc_id: r for r in language_id.identified(docs, model).collect()}
    assert all(out[i].lang_pred == list(stems)[i % 3] for i in range(180, 240)) and out[243].lang_pred == "en"
    assert [out[i].lang_pred for i in (240, 241, 242)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in out.values())
    assert (model.weights != 0).mean() < 0.2
    empty = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.identified(docs, empty).collect()} == {"und"}


def test_terms_across_blocks_are_counted(monkeypatch):
    text = "abcdefgé" * 40
    whole = language_id.term_counts(text)
    monkeypatch.setattr(language_id, "BLOCK", 7)
    assert (language_id.term_counts(text) == whole).all()


def test_empty_tables(spark, tmp_path):
    none = documents(spark, ["x"]).where("false")
    assert token_count.token_table(none, BYTE).isEmpty() and packing.pack(none, WORD).isEmpty() and licenses.scan(none).isEmpty()
    assert ngram_join.linked(none).isEmpty() and ngram_join.linked(none, 5, 80).isEmpty() and mixing.taken_words(none).isEmpty() and mixing.mixed(none).isEmpty()
    token_files.write_token_files(none, str(tmp_path / "t"), BYTE)
    assert token_files.token_digests(token_files.read_token_files(spark, str(tmp_path / "t"))).isEmpty()
