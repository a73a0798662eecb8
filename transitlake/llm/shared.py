"""What the operators share: the cluster's shared folder, row keys, ASCII lower case and words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import shared_root

#: Runs of what is no word character; applied to a text whose case is still as it was.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What a word has at least one of.
WORD = NO_WORD.replace("[", "[^").removesuffix("+")
_FOLDERS: list[str] = []
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines see; on a cluster that does not set it this raises."""
    _FOLDERS.append(folder := f"{shared_root(spark)}/transitlake/{uuid.uuid4().hex}")
    return folder


def drop(spark: SparkSession, *folders: str) -> None:
    """Deletes folders; what is not there does not matter."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Deletes all folders that ``shared_dir`` gave in this process but the first ``keep``; what was read from them is lost, token files too."""
    while len(_FOLDERS) > keep:
        drop(spark, _FOLDERS.pop())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``shared_dir`` gives inside are deleted at the end: for a step whose result is written elsewhere."""
    n = len(_FOLDERS)
    try:
        yield
    finally:
        release(spark, n)


def spread(df: DataFrame) -> DataFrame:
    """A scanned table, its rows dealt out anew if it has fewer partitions than the cluster has cores; such a table is small."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written below the shared folder as Parquet and read again; this cuts lineage and outlives executors."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*cols: Column) -> list[Column]:
    """128 bits that name a row by its values, never null; equal rows have equal keys."""
    return [F.xxhash64(*cols).alias("_k1"), F.xxhash64(F.lit(7919), *reversed(cols)).alias("_k2")]


def held(df: DataFrame, *cols: Column) -> DataFrame:
    """All columns of ``df`` in one, ``_row``, beside ``cols``; no name among them can clash then. ``select("_row.*")`` undoes it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *cols)


def words(text: Column) -> Column:
    """Words of a text in their own case: runs of digits, ASCII letters and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NO_WORD), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all else as it was."""
    return F.translate(text, UPPER, LOWER)


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """Marked for broadcast if it has no more rows than that, counted now; else as it was, for a shuffled join."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
