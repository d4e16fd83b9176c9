from brontide.llm import language_id
from brontide.llm.linear import sample


def test_every_class_has_its_rows_however_many_there_are(spark):
    rows = spark.range(12_000).selectExpr("id as doc_id", "concat('c', id) as c").union(spark.range(100_000, 100_400).selectExpr("id", "'large'")).union(spark.range(3).selectExpr("id", "cast(null as string)"))
    got = {r.c: r["count"] for r in sample(rows, "c", 100).groupBy("c").count().collect()}
    assert len(got) == 12_001 and None not in got and 50 < got.pop("large") < 200 and set(got.values()) == {1}


def test_a_language_of_one_row_is_learned(spark):
    one = "zzq xxj qqz jjx zqx"  # the first row is held back from the first training
    docs = [(0, one, "aa")] + [(i, f"the quick brown fox {i} and the lazy dog", "en") for i in range(1, 5)] + [(i, f"der schnelle braune fuchs {i} und der faule hund", "xx") for i in range(5, 10)]
    assert language_id.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string")).predict(one)[0] == "aa"
