"""Sinks: snapshots that replace each other, quarantine of broken rows, JSON export, uniqueness checks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, folder: str, version: str, partition_by: list[str] | None = None) -> str:
    """Write a new version beside the old ones and return its path; readers switch when they are given the new path."""
    path = f"{folder.rstrip('/')}/version={version}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine with ``error_type``: the first rule that a row breaks; a rule that is null is broken)."""
    broken = F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()], F.lit(None).cast("string"))
    marked = df.withColumn("error_type", broken)
    return marked.where("error_type is null").drop("error_type"), marked.where("error_type is not null")


def export_json(df: DataFrame, folder: str, **header: str) -> None:
    """Rows as lines of JSON, and a header document with their number beside them."""
    df.write.mode("overwrite").json(f"{folder}/rows")
    top = df.agg(F.count("*").alias("count")).select(*[F.lit(v).alias(k) for k, v in header.items()], "count")
    top.coalesce(1).write.mode("overwrite").json(f"{folder}/header")


def violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that break a unique index on ``keys`` (nulls are free)."""
    return df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def touched(old: DataFrame, new: DataFrame, key: str, stamp: str, now: Column) -> DataFrame:
    """``new`` with ``stamp`` set to now in the rows that differ from ``old``, and kept in the others."""
    data = [c for c in new.columns if c not in (key, stamp)]
    before = old.select(key, F.xxhash64(*data).alias("_hash"), F.col(stamp).alias("_stamp"))
    joined = new.withColumn("_new", F.xxhash64(*data)).join(before, key, "left")
    return joined.withColumn(stamp, F.when(F.col("_hash") == F.col("_new"), F.col("_stamp")).otherwise(now)).select(*new.columns)


def append_requests(ids: DataFrame, sources: list[str], old: DataFrame) -> DataFrame:
    """Requests of every id to every source: ``old(id, source_key, status, priority)`` reset to pending with the larger priority, new ones added."""
    wanted = ids.select("id", F.coalesce("priority", F.lit(0)).alias("_p"), F.explode(F.array(*[F.lit(s) for s in sources])).alias("source_key"))
    joined = old.join(wanted, ["id", "source_key"], "full_outer")
    return joined.select("id", "source_key", F.when(F.col("_p").isNotNull(), F.lit("pending")).otherwise(F.col("status")).alias("status"), F.greatest("priority", "_p").alias("priority"))


def changed_columns(old: DataFrame, changes: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """``old`` with the columns of ``changes`` (one row a key) that are ``allowed`` set where they are not null; others of them are an error."""
    named = [c for c in changes.columns if c != key]
    if unknown := sorted(set(named) - set(allowed)):
        raise ValueError(f"columns that may not change: {unknown}")
    joined = old.join(changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in named]), key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in named else F.col(c) for c in old.columns])


def write_or_show(df: DataFrame, path: str, mode: str = "append", dry_run: bool = False) -> DataFrame:
    """Write ``df`` to ``path`` and return it, or with ``dry_run`` only return what would be written."""
    if not dry_run:
        df.write.mode(mode).parquet(path)
    return df


def save_checkpoint(df: DataFrame, folder: str, **state: str) -> None:
    """Rows and the state of a sweep, so that it can go on from there; replaces what was saved before."""
    df.write.mode("overwrite").json(f"{folder}/rows")
    df.sparkSession.createDataFrame([tuple(state.values())], ", ".join(f"`{k}` string" for k in state)).coalesce(1).write.mode("overwrite").json(f"{folder}/state")


def load_checkpoint(spark: SparkSession, folder: str, schema: str) -> tuple[DataFrame, dict] | None:
    """(rows, state) of the last ``save_checkpoint``; null where none is saved or it is broken."""
    try:
        state = spark.read.json(f"{folder}/state").first()
        return (spark.read.schema(schema).json(f"{folder}/rows"), state.asDict()) if state else None
    except AnalysisException:
        return None


def clear_checkpoint(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def usage_lines(usage: dict[str, float]) -> list[str]:
    """One line a figure, aligned, for a log or a terminal."""
    width = max(map(len, usage), default=0)
    return [f"{name:<{width}}  {value:,.2f}".rstrip("0").rstrip(".") for name, value in usage.items()]
