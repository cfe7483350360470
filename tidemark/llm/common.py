"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# ASCII white space [\x20\x09-\x0D]; bytes.split() and bytes.strip() use the same set.
SPACE = " \t\n\x0b\x0c\r"


#: Bytes of the batches in which rows go to Python workers.
BATCH = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let batches for Python workers hold BATCH bytes at most (Spark's bound is
    64 MB, which both sides hold several times); a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if now.isdigit() and int(now) > BATCH:
        spark.conf.set(key, f"{BATCH}b")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder of
    ``spark.checkpoint.dir``. Unlike a checkpoint the last stage runs once, and
    readers prune columns; a lost executor costs nothing. Tables lie in one
    folder per application, to be removed when the application is over."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{checkpoint_root(spark)}/llm-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names (an operator's own output columns
    replace input columns of the same name)."""
    return df.drop(*[n for n in df.columns if n.lower() in {x.lower() for x in names}])


def text_of(name: str = "text"):
    """The text column, a null text read as the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, nulls as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``most`` bytes each, so that the arrays made from
    a range stay small whatever the batch holds (one longer text is a range)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, after which the worker gives freed memory back
    to the system: Python workers live on, and the allocators of several operators add up."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
