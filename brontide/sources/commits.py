"""Committing windows once: an intent before, a manifest after, other content set aside, and what to do after a crash."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import staged
from .sinks import _read


def digest_of(rows: DataFrame) -> str:
    """A digest of the rows of a table, whatever their order: their number and the sum of their hashes."""
    n, h = rows.agg(F.count("*"), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)"))).first()
    return f"{n}:{h}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    _, at, fs = _fs(spark, path)
    return fs.exists(at)


def _note(spark: SparkSession, path: str, what: dict) -> None:
    """Write a small JSON file aside and rename it, so that it is there whole or not at all."""
    jvm, at, fs = _fs(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(what).encode()))
    out.close()
    fs.delete(at, False)
    fs.rename(aside, at)


def _noted(spark: SparkSession, path: str) -> dict | None:
    jvm, at, fs = _fs(spark, path)
    if not fs.exists(at):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def commit(rows: DataFrame, root: str, window: int, expected: int | None = None, generation: int = 0) -> str:
    """Commit the rows of a window: committed, idempotent (the same is there) or quarantined (other content is).

    The rows are written aside, an intent names their digest, the folder is renamed, and the manifest has the window. With
    ``expected`` a window of another number of rows is refused (E030). What conflicts goes to <root>/quarantine, unread.
    """
    spark = rows.sparkSession
    data, intent, manifest = f"{root}/window={window}", f"{root}/intents/{window}.json", f"{root}/manifest/{window}.json"
    rows = staged(rows, "window")
    digest = digest_of(rows)
    if expected is not None and rows.count() != expected:
        raise ValueError(f"E030 window {window} has {rows.count()} rows, not {expected}")
    done = _noted(spark, manifest)
    if done:
        if done["digest"] == digest:
            return "idempotent"
        rows.write.mode("overwrite").parquet(f"{root}/quarantine/window={window}-{generation}")
        return "quarantined"
    aside = f"{root}/aside/window={window}-{generation}"
    rows.write.mode("overwrite").parquet(aside)
    _note(spark, intent, {"digest": digest, "aside": aside, "generation": generation})
    _finish(spark, root, window)
    return "committed"


def _finish(spark: SparkSession, root: str, window: int) -> None:
    intent = _noted(spark, f"{root}/intents/{window}.json")
    jvm, at, fs = _fs(spark, f"{root}/window={window}")
    if not fs.exists(at):
        fs.rename(jvm.org.apache.hadoop.fs.Path(intent["aside"]), at)
    _note(spark, f"{root}/manifest/{window}.json", {"digest": intent["digest"], "generation": intent["generation"]})
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/intents/{window}.json"), False)


def recover(spark: SparkSession, root: str) -> dict[int, str]:
    """What became of windows whose commit was cut short: committed if the rows are those of the intent, else quarantined."""
    out = {}
    jvm, at, fs = _fs(spark, f"{root}/intents")
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/intents/*.json")) or []:
        window = int(status.getPath().getName().removesuffix(".json"))
        intent = _noted(spark, f"{root}/intents/{window}.json")
        place = next((p for p in (f"{root}/window={window}", intent["aside"]) if _exists(spark, p)), None)
        rows = _read(spark, place) if place else None
        if rows is not None and digest_of(rows) == intent["digest"]:
            _finish(spark, root, window)
            out[window] = "committed"
            continue
        if place:
            target = jvm.org.apache.hadoop.fs.Path(f"{root}/quarantine/window={window}-{intent['generation']}")
            fs.mkdirs(target.getParent())
            fs.rename(jvm.org.apache.hadoop.fs.Path(place), target)
        fs.delete(status.getPath(), False)
        out[window] = "quarantined"
    return out


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    """window, digest, generation of the committed windows."""
    rows = spark.read.text(f"{root}/manifest/*.json").select(F.regexp_extract("_metadata.file_path", r"(\d+)\.json$", 1).cast("long").alias("window"), F.from_json("value", "digest string, generation int").alias("j"))
    return rows.select("window", "j.*")


def gap_records(manifest: DataFrame, width: int, from_ms: int, to_ms: int) -> DataFrame:
    """window: those in [from, to) that the manifest doesn't have, which are to be computed again."""
    grid = manifest.sparkSession.range(from_ms, to_ms, width).withColumnRenamed("id", "window")
    return grid.join(manifest.select("window"), "window", "left_anti")


def rotate(rows: DataFrame, path: str, per_file: int = 1_000_000) -> None:
    """Append envelopes (market, kind, event_ts, ...) as hourly JSON segments by event time, at most ``per_file`` lines a file."""
    hour = F.date_format(F.timestamp_millis(F.col("event_ts")), "yyyy-MM-dd-HH")
    out = rows.withColumn("hour", hour).repartition("market", "kind", "hour").sortWithinPartitions("market", "kind", "hour", "event_ts")
    out.write.mode("append").option("maxRecordsPerFile", per_file).partitionBy("market", "kind", "hour").json(path)


def status_file(rows: DataFrame, path: str, key: str = "market") -> None:
    """One JSON object by ``key`` of a small table of status (one row a market), there whole or not at all."""
    _note(rows.sparkSession, path, {r[key]: r.asDict(True) for r in rows.collect()})
