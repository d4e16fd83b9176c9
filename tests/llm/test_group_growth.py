import random

import numpy as np
import pytest

from brontide.llm import ngram_join


def varied(r, base, changes):
    words = list(base)
    for at in r.sample(range(len(words)), changes):
        words[at] = f"x{r.randrange(10**9)}"
    return " ".join(words)


def test_far_variants_of_one_text_are_not_compared_in_full(monkeypatch):
    """Variants too far apart are told apart by their sketches: only a dozen pivots meet the whole group."""
    r = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    sets = ngram_join.Hasher(3).sets([varied(r, base, r.randrange(12, 18)) for _ in range(300)] + [" ".join(base)] * 2)
    region, met, meet = ngram_join.Region(sets, 90), [], ngram_join.Region.meet
    monkeypatch.setattr(ngram_join.Region, "meet", lambda self, p, m: (met.append(len(m)), meet(self, p, m))[1])
    region.scan(np.arange(len(sets)))
    assert region.links == [(300, 301)] and sum(met) <= 14 * len(sets)


def brute(sets, percent):
    of = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                old, new = max(of[i], of[j]), min(of[i], of[j])
                of = [new if x == old else x for x in of]
    return of


@pytest.mark.parametrize("percent", [90, 80, 55])
def test_sketches_lose_no_link(percent):
    r = random.Random(percent)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(varied(r, base, r.randrange(0, 40)).split()[: r.randrange(120, 201)]) for _ in range(120)]
    sets = ngram_join.Hasher(3).sets(texts)
    n = np.array([len(x) for x in sets])
    bits = ngram_join.sketches(ngram_join.mix(np.concatenate(sets)), n, ngram_join.sketch_words(int(n.max()), percent))
    of = np.arange(len(sets))
    for block in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        for i, j in ngram_join.sketch_links(bits, n, block, percent):
            of[of == of[j]] = of[i]
    want = brute(sets, percent)
    for i, k in enumerate(want):
        assert of[i] == of[k]
    region = ngram_join.Region(sets, percent)
    region.scan(np.arange(len(sets)))
    assert [min(k for k in range(len(sets)) if region.root(k) == region.root(i)) for i in range(len(sets))] == want


def test_sifted_groups_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", 3)
    monkeypatch.setattr(ngram_join, "SHEET", 16)
    r = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = [varied(r, base, r.randrange(0, 9)) for _ in range(150)]
    sets = ngram_join.Hasher(3).sets(texts)
    want = {i: k for i, k in enumerate(brute(sets, 90))}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.component_id for x in ngram_join.linked(docs, 3, 90).collect()}
    assert got == want and 1 < len(set(want.values())) < 150


def test_unrelated_texts_of_a_group_are_sifted_out(spark):
    """A group that only chance regions hold together is left with its similar members."""
    r = random.Random(4)
    texts = [" ".join(f"v{r.randrange(5000)}" for _ in range(1500)) for _ in range(40)]
    texts.append(texts[0] + " end")
    sets = ngram_join.Hasher(3).sets(texts)
    rows = [(1, ngram_join.key_of(x), i, len(x)) for i, x in enumerate(sets)]
    members = spark.createDataFrame(rows, "`group` long, key long, ident long, n long")
    left = ngram_join._sifted(members, spark.createDataFrame(list(enumerate(texts)), "ident long, text string"), 3, 90)
    assert sorted(x.ident for x in left.collect()) == [0, 40]
