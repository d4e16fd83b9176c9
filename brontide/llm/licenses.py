"""License scans by diagonal voting, in DataFrame expressions throughout.

All rolling word k-grams of the texts are hashed and joined to the positions that these grams have in
a few license notices. A copy of a notice gives many matches with one difference (diagonal) between
the position in the text and that in the notice; small edits shift it a little. Matches are counted by
diagonal, neighbouring diagonals merged, and a merged span counts if it covers enough of the notice
and is dense enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Label and wording of license notices.
NOTICES = (
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mit", "Released under the MIT License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
)

#: ASCII characters that are not part of a word, once A-Z are lower case.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case. Other letters may change too, but none into an ASCII letter (the Kelvin sign is kept out) nor out of a word."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\ufffd")))


def bound(value: Column, use) -> Column:
    """use(value) with ``value`` computed once: Catalyst may else copy it into every lambda call."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(low: Column) -> Column:
    """The words of a lowered text; an empty array if it has none."""
    return F.array_remove(F.split(low, _GAP), "")


def grams(ws: Column, k: int) -> Column:
    """Hashes of the k-word windows by their first word's position; empty for fewer words."""
    last = F.size(ws) - k
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*(F.get(ws, i + j) for j in range(k))))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def notice_grams(spark: SparkSession, k: int) -> DataFrame:
    """hash, notice, label, at, n_grams: one row per gram of NOTICES, so of a fixed size."""
    rows = F.array(*(F.struct(F.lit(i).alias("notice"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(NOTICES)))
    table = spark.range(1).select(F.inline(rows)).select("notice", "label", bound(words(lowered(F.col("text"))), lambda ws: grams(ws, k)).alias("g"))
    return table.select("notice", "label", F.size("g").alias("n_grams"), F.posexplode("g").alias("at", "hash"))


def phrase_places(ws: Column, phrase: str) -> Column:
    """Positions at which the words of ``phrase`` stand one after the other."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        out = F.get(ws, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            out = out & F.coalesce(F.get(ws, i + j) == part, F.lit(False))
        return out

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0))), lambda i: F.coalesce(here(i), F.lit(False)))


def notice_spans(docs: DataFrame, k: int = 3, drift: int = 2, cover: float = 0.6, density: float = 0.5) -> DataFrame:
    """key_id, key_text, label, first, last, cover: the verified spans of notices in each different (doc_id, text)."""
    keys = [F.xxhash64("doc_id").alias("key_id"), F.xxhash64("text").alias("key_text")]
    rolled = bound(words(lowered(F.col("text"))), lambda ws: grams(ws, k))
    rows = docs.select(*keys, F.posexplode(rolled).alias("pos", "hash"))
    hits = rows.join(F.broadcast(notice_grams(docs.sparkSession, k)), "hash")
    one = ["key_id", "key_text", "notice"]
    votes = hits.groupBy(*one, "label", "n_grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("at").alias("ats"))
    along = Window.partitionBy(*one).orderBy("diagonal")
    fresh = (F.col("diagonal") - F.lag("diagonal").over(along) > drift).cast("int")
    votes = votes.withColumn("band", F.sum(F.coalesce(fresh, F.lit(1))).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    bands = votes.groupBy(*one, "band", "label", "n_grams").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n"))
    covers, dense = F.col("n") / F.col("n_grams"), F.col("n") / (F.col("last") - F.col("first") + 1)
    return bands.where((covers >= cover) & (dense >= density)).select("key_id", "key_text", "label", "first", (F.col("last") + k - 1).alias("last"), covers.alias("cover"))


def read(low: Column) -> Column:
    """n_words, and the places of each phrase (null where none of them can stand) of a lowered text."""
    may = low.contains("license") | low.rlike("cc" + _GAP + "by")
    places = bound(words(low), lambda ws: F.array(*(phrase_places(ws, p) for p in PHRASES)))
    return F.struct(F.regexp_count(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long").alias("n_words"), F.when(may, places).alias("places"))


def scan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans for each row.

    A null or empty text, or one without words, has no places, empty labels and score 0. The score is
    the largest covered share of a notice, at least one half where a phrase stands. Equal rows get
    equal results; columns other than doc_id and text are not read.
    """
    spans = notice_spans(docs, **options).groupBy("key_id", "key_text").agg(F.collect_set("label").alias("found"), F.max("cover").alias("cover"), F.array_sort(F.collect_list(F.struct("first", "last", "label", "cover"))).alias("spans"))
    rows = docs.select("doc_id", F.xxhash64("doc_id").alias("key_id"), F.xxhash64("text").alias("key_text"), bound(lowered(F.col("text")), read).alias("r"))
    rows = rows.select("doc_id", "key_id", "key_text", "r.n_words", "r.places")
    all_places = F.flatten("places")
    labels = F.array(*map(F.lit, PHRASES.values()))
    has = F.transform(F.filter(F.arrays_zip(labels.alias("l"), F.col("places").alias("p")), lambda x: F.size(x["p"]) > 0), lambda x: x["l"])
    empty = F.array().cast("array<string>")
    rows = rows.select(
        "doc_id", "key_id", "key_text", "n_words",
        F.coalesce(F.size(all_places), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"), F.array_max(all_places).cast("long").alias("last_word"),
        F.when(F.col("places").isNull(), empty).otherwise(has).alias("base"),
    )
    joined = rows.join(spans, ["key_id", "key_text"], "left")
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.greatest(F.coalesce("cover", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return joined.select("doc_id", "n_words", F.when(F.col("n_base") < 0, 0).otherwise(F.col("n_base")).cast("long").alias("n_base"), "first_word", "last_word", text(F.col("base")).alias("base_labels"), text(F.concat("base", F.coalesce("found", empty))).alias("labels"), score.alias("score"), "spans")


def oracle_sql(k: int = 3, drift: int = 2, cover: float = 0.6, density: float = 0.5) -> str:
    """The columns of scan() but spans in DuckDB SQL, for documents with different ids."""
    quoted = ", ".join("({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(NOTICES))
    upper = "".join(map(chr, range(65, 91)))
    split = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    gram = " || ' ' || ".join(f"ws[i + {j}]" for j in range(k))
    rolled = f"unnest(list_transform(generate_series(1, len(ws) - {k - 1}), lambda i: {{'place': i - 1, 'g': {gram}}}))"
    parts = {p: " AND ".join(f"coalesce(ws[i + {j}] = '{w}', false)" for j, w in enumerate(p.split(" "))) for p in PHRASES}
    places = ", ".join(f"list_filter(generate_series(1, len(ws)), lambda i: {c}) AS p{n}" for n, c in enumerate(parts.values()))
    every = "list_concat(" * (len(parts) - 1) + "p0" + "".join(f", p{n})" for n in range(1, len(parts)))
    based = " || ".join(f"CASE WHEN len(p{n}) > 0 THEN ['{label}'] ELSE []::VARCHAR[] END" for n, label in enumerate(PHRASES.values()))
    return rf"""
WITH d AS (SELECT doc_id, {split} AS ws FROM documents),
n AS (SELECT notice, label, {split} AS ws FROM (VALUES {quoted}) AS v(notice, label, text)),
ng AS (SELECT notice, label, len(ws) - {k - 1} AS n_grams, x.place, x.g FROM (SELECT *, {rolled} AS x FROM n)),
dg AS (SELECT doc_id, x.place AS pos, x.g FROM (SELECT doc_id, {rolled} AS x FROM d)),
hits AS (SELECT doc_id, notice, label, n_grams, pos, place, pos - place AS diagonal FROM dg JOIN ng USING (g)),
diagonals AS (SELECT DISTINCT doc_id, notice, diagonal FROM hits),
cuts AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= {drift} THEN 0 ELSE 1 END AS cut FROM diagonals WINDOW w AS (PARTITION BY doc_id, notice ORDER BY diagonal)),
bands AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, notice ORDER BY diagonal) AS band FROM cuts),
spans AS (SELECT doc_id, label, count(DISTINCT place) / any_value(n_grams) AS cover FROM hits JOIN bands USING (doc_id, notice, diagonal) GROUP BY doc_id, notice, label, band
          HAVING count(DISTINCT place) / any_value(n_grams) >= {cover} AND count(DISTINCT place) / (max(pos) - min(pos) + 1) >= {density}),
found AS (SELECT doc_id, list(DISTINCT label) AS found, max(cover) AS cover FROM spans GROUP BY doc_id),
b AS (SELECT doc_id, len(ws)::BIGINT AS n_words, {places} FROM d),
c AS (SELECT doc_id, n_words, {every} AS places, {based} AS base FROM b)
SELECT c.doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(found, []::VARCHAR[]))), ',') AS labels,
       greatest(coalesce(cover, 0), CASE WHEN len(places) > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM c LEFT JOIN found USING (doc_id)
"""
