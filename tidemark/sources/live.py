"""Live tables: plain Parquet under one folder per day of ``current_time``.

Inserts append files (K1). Keyed upserts (K7, K8) append, too, unless a key is
there already; then, as for deletes (K9) and updates, the days that hold such rows are
written anew and replace the old ones (dynamic partition overwrite), and no other
day is touched. All readers and writers (snapshots, maintenance, marts, refill)
work on the same table.

What is written is computed and checkpointed first, so a write never reads what
it replaces, and running a job again merges the same rows to the same table. Spark's
commit of a day is a delete and a rename, not a transaction: a table that is
read while it is maintained wants a table format on top.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import ts_lit
from tidemark.operators.maintenance import merge
from tidemark.session import cut_lineage, spooled

TIME = "current_time"
DAY = "_date"
ROW = "_row"  # file and place of a row: an id as long as its file is there
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, root: str) -> bool:
    fs, p = _fs(spark, root)
    return fs.exists(p) and any(not s.getPath().getName().startswith((".", "_SUCCESS", "_temporary")) for s in fs.listStatus(p))


@contextmanager
def spool(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """``rows`` materialised (``session.spooled``) while the block runs; then the folder goes."""
    spark = rows.sparkSession
    held = spooled(rows, name)
    try:
        yield held
    finally:
        fs, p = _fs(spark, held.inputFiles()[0].rsplit("/", 1)[0])
        fs.delete(p, True)


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DAY, F.to_date(TIME))


def read(spark: SparkSession, root: str, schema: T.StructType | None = None, start: Any = None, end: Any = None, *, days: Sequence | None = None, row_id: bool = False) -> DataFrame | None:
    """The table, without its day column unless ``row_id`` asks for it and ``ROW``.
    A time range (inclusive) or ``days`` (None: rows without a time) prune folders.
    A missing table is an empty frame of ``schema``, or None."""
    if not exists(spark, root):
        return None if schema is None else spark.createDataFrame([], schema)
    df = spark.read.option("mergeSchema", "true").parquet(root)
    if DAY not in df.columns:
        return df
    df = df.withColumn(DAY, F.col(DAY).cast("date"))
    if row_id:
        df = df.withColumn(ROW, F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    if days is not None:
        known = [d for d in days if d is not None]
        hit = F.col(DAY).isin(known) if known else F.lit(False)
        df = df.filter(hit | F.col(DAY).isNull() if len(known) < len(days) else hit)
    if start is not None:
        df = df.filter((F.col(DAY) >= F.to_date(ts_lit(start))) & (F.col(TIME) >= ts_lit(start)))
    if end is not None:
        df = df.filter((F.col(DAY) <= F.to_date(ts_lit(end))) & (F.col(TIME) <= ts_lit(end)))
    return df if row_id else df.drop(DAY)


def insert(rows: DataFrame, root: str) -> None:
    """K1: append, nothing is read or rewritten. New columns are NULL in older rows."""
    with_day(rows).write.mode("append").partitionBy(DAY).parquet(root)
    rows.sparkSession.catalog.refreshByPath(root)


def days_of(rows: DataFrame) -> list:
    """The days that ``rows`` (with ``DAY``) touch, one entry each."""
    return [r[0] for r in rows.select(DAY).distinct().collect()]


def rewrite(rows: DataFrame, root: str, days: Sequence) -> None:
    """Replace the ``days`` of the table by ``rows`` (with times on these days); a
    day that is left without rows goes."""
    spark = rows.sparkSession
    rows = cut_lineage(with_day(rows))
    left = set(days_of(rows))
    if outside := left - set(days):
        raise ValueError(f"rows lie outside the days to rewrite: {sorted(map(str, outside))}")
    # adaptive execution sizes the files: small days share no task, a large one is split
    if left:
        rows.hint("rebalance", F.col(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(root)
    fs, _ = _fs(spark, root)
    for day in set(days) - left:
        _, p = _fs(spark, f"{root.rstrip('/')}/{DAY}={NO_DAY if day is None else day.isoformat()}")
        fs.delete(p, True)
    spark.catalog.refreshByPath(root)


def same(keys: Sequence[str], left: str, right: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def one_per_key(rows: DataFrame, keys: Sequence[str], newest: Sequence[Column] = ()) -> DataFrame:
    """Of rows with equal keys the first by ``newest``; without it, or on ties,
    the one with the greatest hash, so the choice is the same on every run."""
    plain = [f.name for f in rows.schema.fields if "map" not in f.dataType.simpleString()]
    w = Window.partitionBy(*keys).orderBy(*newest, F.xxhash64(*plain).desc())
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(rows: DataFrame, root: str, keys: Sequence[str], *, null_keeps: bool = False, newest: Sequence[Column] = (), settled: bool = False) -> DataFrame:
    """K8, or with ``null_keeps`` K7 (a NULL does not replace a stored value): set
    ``rows`` by ``keys``, of which ``current_time`` is one. Returns the rows as they are stored.
    ``settled`` rows come from a table of their own, outside ``root``, that stays as it is
    until the caller has read what is returned: they are copied only if keys repeat."""
    if TIME not in keys:
        raise ValueError(f"a live table is keyed by {TIME}, among others")
    spark = rows.sparkSession
    if settled and rows.groupBy(*keys).count().filter("count > 1").isEmpty():
        rows = with_day(rows)
    else:
        rows = cut_lineage(with_day(one_per_key(rows, keys, newest)))
    at = rows.agg(F.min(TIME).alias("first"), F.max(TIME).alias("last")).first()
    if not exists(spark, root):
        insert(rows.drop(DAY), root)
        return rows.drop(DAY)
    # keys that are there already; file statistics narrow this to the times of the new rows
    old = read(spark, root, row_id=True, days=days_of(rows))
    if at.first is not None:
        old = old.filter(F.col(TIME).isNull() | F.col(TIME).between(at.first, at.last))
    known = cut_lineage(old.alias("o").join(rows.select(*keys).alias("n"), same(keys, "o", "n"), "left_semi").select(DAY, *keys))
    clash = days_of(known)
    if not clash:
        insert(rows.drop(DAY), root)
        return rows.drop(DAY)
    on_clash = F.col(DAY).isin([d for d in clash if d is not None]) | (F.col(DAY).isNull() & F.lit(None in clash))
    again = rows.filter(on_clash).drop(DAY)
    merged = cut_lineage(merge(read(spark, root, row_id=True, days=clash).drop(DAY, ROW), again, keys, null_keeps_target=null_keeps, check_rows=False).table)
    stored = cut_lineage(merged.alias("o").join(rows.select(*keys).alias("n"), same(keys, "o", "n"), "left_semi"))
    fresh = rows.filter(~F.coalesce(on_clash, F.lit(False))).drop(DAY)
    rewrite(merged, root, clash)
    if not fresh.isEmpty():
        insert(fresh, root)
    return stored.unionByName(fresh, allowMissingColumns=True)


def remove(spark: SparkSession, root: str, gone: DataFrame) -> list:
    """K9: delete the rows that ``gone`` (``ROW``, ``DAY``) names, rewriting only
    their days, which are returned."""
    gone = cut_lineage(gone.select(ROW, DAY))
    days = days_of(gone)
    if days:
        rewrite(read(spark, root, days=days, row_id=True).join(gone.select(ROW), ROW, "left_anti").drop(ROW, DAY), root, days)
    return days


def replace(rows: DataFrame, root: str) -> None:
    """A dimension: the whole table at once."""
    cut_lineage(rows).write.mode("overwrite").parquet(root)
    rows.sparkSession.catalog.refreshByPath(root)


def compact(spark: SparkSession, root: str, days: Sequence) -> None:
    """Write ``days`` anew in files of the size that adaptive execution aims at
    (each insert leaves small ones)."""
    rewrite(read(spark, root, days=days, row_id=True).drop(DAY, ROW), root, days)
