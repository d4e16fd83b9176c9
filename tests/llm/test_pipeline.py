"""The pipeline, stage by stage, against brute-force versions of what each stage decides."""

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from brontide.llm import language_id, mixing, toxicity  # noqa: E402

from ..conftest import SMALL  # noqa: E402
from .test_text_operators import jaccard_components  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root, out = tmp_path_factory.mktemp("pipeline"), [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "packing"]
    assert all(df.columns == stages[0].columns for df in stages[:5])


def test_filters_drop_what_they_reject_and_nothing_else(spark, stages):
    docs, clean, known, *_ = stages
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    keep = {r.doc_id for r in toxicity.scored(docs, model).collect() if not r.predicted}
    assert rows(clean) == [r for r in rows(docs) if r[0] in keep] and len(keep) > 0.8 * docs.count()
    model = language_id.fit(clean)
    want = [tuple(r) for r in clean.collect() if (p := model.predict(r.text))[0] != "und" and p[1] >= corpus_pipeline.LEAST_LANGUAGE]
    assert rows(known) == sorted(want) and len(want) > 0.98 * clean.count()


def test_one_document_of_each_group_stays(stages):
    before = sorted(stages[2].collect(), key=lambda r: r.doc_id)
    keep = {before[c].doc_id for _, c in jaccard_components([r.text for r in before], 5, 80)}
    assert rows(stages[3]) == sorted(tuple(r) for r in before if r.doc_id in keep) and len(keep) < len(before)


def test_one_row_of_each_group_stays_with_null_and_repeated_ids(spark):
    same, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(None, "u " * 9 + "alone"), (None, same), (3, same), (3, same), (2, other), (2, other), (2, "one of a kind with the id of others"), (7, ""), (7, ""), (None, None), (None, "x y z null ids with equal texts"), (None, "x y z null ids with equal texts")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(repr, map(tuple, corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).collect())))
    assert got == sorted(map(repr, [rows[0], rows[2], rows[4], rows[6], rows[7], rows[8], rows[9], rows[10]]))


@pytest.mark.parametrize("count", [2, 10])
def test_language_threshold_follows_the_number_of_languages(spark, count):
    letters = [chr(0x4E00 + 200 * k + i) for k in range(count) for i in range(40)]
    text = lambda k, seed: "".join(letters[40 * k + (7 * seed + i * (1 + seed % 5)) % 40] for i in range(30))
    known = [(20 * k + s, text(k, s), f"l{k}") for k in range(count) for s in range(20)]
    mixed = (9100, "".join(text(k, 3) for k in range(count)), None)
    docs = spark.createDataFrame([*known, mixed], "doc_id long, text string, lang string")
    got = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, SMALL).collect()}
    assert {i for i, *_ in known} <= got
    model = language_id.fit(docs)
    lang, score = model.predict(mixed[1])
    assert (9100 in got) == (score >= 1.04 / count)


def test_least_language():
    assert [corpus_pipeline.least_language(k) for k in (0, 1, 2, 4)] == [1.0, 1.0, 0.52, 0.26] and abs(corpus_pipeline.least_language(10) - 0.104) < 1e-12


def test_mixing_takes_what_the_operator_says(stages):
    times = {}
    for r in stages[4].collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {r.doc_id: r.taken // r.size for r in mixing.taken_words(stages[3]).collect() if r.taken}


def test_packing_covers_the_mix(stages):
    mixed, pieces = stages[4], stages[5].collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0) and sum(r.start == 0 for r in pieces) == mixed.count()
    assert max(r.offset + r.length for r in pieces) <= 2048


def test_run_equals_the_stages(spark, stages):
    keys = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert rows(corpus_pipeline.run(spark, SMALL).select(*keys)) == rows(stages[5].select(*keys))
