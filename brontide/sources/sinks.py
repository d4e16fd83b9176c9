"""Writers: partitioned tables, idempotent appends, upserts, late rows, archives and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.ordered import with_running
from .scratch import staged


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def utc_date(ts: Column) -> Column:
    """The UTC day of epoch milliseconds, as text."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ts / 86_400_000).cast("int")).cast("string")


def write_features(rows: DataFrame, path: str) -> None:
    """Replace the (market, date) partitions that ``rows`` touches; others stay. Repeating it changes nothing."""
    out = rows.withColumn("date", utc_date(F.col("ts"))).repartition("market", "date").sortWithinPartitions("market", "date", "ts")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("market", "date").parquet(path)


def append_new(rows: DataFrame, path: str, keys: list[str]) -> int:
    """Append the rows whose key the table doesn't have; how many they were."""
    old = _read(rows.sparkSession, path)
    fresh = staged(rows.dropDuplicates(keys) if old is None else rows.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"), "fresh")
    fresh.write.mode("append").parquet(path)
    return fresh.count()


def upsert(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Insert or replace by key. The new table is written aside first, so a failure leaves the old one."""
    old = _read(rows.sparkSession, path)
    both = rows.withColumn("_v", F.lit(1)) if old is None else old.withColumn("_v", F.lit(0)).unionByName(rows.withColumn("_v", F.lit(1)))
    rest = [c for c in rows.columns if c not in keys]
    now = staged(both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_v").alias("r")).select(*keys, "r.*"), "upsert")
    now.write.mode("overwrite").parquet(path)


def merge_late(late: DataFrame, path: str, identity: list[str]) -> None:
    """Put late rows (with market, ts) into the partitions they belong to, without repeating what is there."""
    spark = late.sparkSession
    days = late.select("market", utc_date(F.col("ts")).alias("date")).distinct()
    old = _read(spark, path)
    if old is not None:
        old = old.withColumn("date", F.col("date").cast("string"))
        touched = old.join(F.broadcast(days), ["market", "date"], "left_semi").drop("date").select(*late.columns)
        late = touched.unionByName(late)
    write_features(staged(late.dropDuplicates(identity), "late"), path)


def prune(spark: SparkSession, path: str, keep_from: str) -> list[str]:
    """Drop the date partitions before ``keep_from`` (a UTC day); those dropped. Only names are listed, no data is read."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs, gone = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), []
    for part in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/market=*/date=*")) or []:
        if part.getPath().getName().removeprefix("date=") < keep_from and fs.delete(part.getPath(), True):
            gone.append("/".join(part.getPath().toString().split("/")[-2:]))
    return sorted(gone)


def archived(lines: DataFrame, path: str, block: int = 1_000) -> DataFrame:
    """Write (market, id, line) as Parquet, read it back and return the blocks whose digests differ: none, if all is well."""
    from ..operators.quality import archive_proof

    lines.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    before, after = archive_proof(lines, block), archive_proof(lines.sparkSession.read.parquet(path), block)
    return before.join(after.withColumnRenamed("sha256", "read").withColumnRenamed("lines", "n"), ["market", "block"], "full_outer").where(~F.col("sha256").eqNullSafe(F.col("read")))


def commit_window(rows: DataFrame, path: str, window: int) -> str:
    """Commit one window's rows by content: committed, idempotent (same content is there) or conflict (other content is; nothing is written)."""
    digest = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")).alias("h"))
    mark = digest.first()
    spark, at = rows.sparkSession, f"{path}/window={window}"
    old = _read(spark, at)
    if old is not None:
        there = old.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")).alias("h")).first()
        return "idempotent" if there == mark else "conflict"
    rows.write.mode("errorifexists").parquet(at)
    return "committed"


def numbered(lines: DataFrame, order: list[str], chunk: Column) -> DataFrame:
    """row_id from 0 in ``order`` for each market; ``chunk`` rises with the order."""
    return with_running(lines, ["market"], order, "row_id", F.lit(1).cast("long"), chunk).withColumn("row_id", F.col("row_id") - 1)
