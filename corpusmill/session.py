"""Session helpers: tables of a data folder, and tables written to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITTEN: list[tuple[SparkSession, str]] = []


#: A table under this size is read as it is.
SPREAD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, read lazily (column pruning and filters reach the scan), spread if need be."""
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if it is read in at most half as many parts: a file of one row group is else one task for all that
    follows. A table of as many files as a cluster has cores is never shuffled by this."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if is_small(df, SPREAD_BYTES) or 2 * df._jdf.rdd().getNumPartitions() > cores:
        return df
    return df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local one if all executors are in this
    process, else RuntimeError: on a cluster each machine would write to a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """df, written once as Parquet into the shared folder and read back.

    This cuts the lineage, so a lost executor costs no recomputation of earlier rounds, and gives the
    optimizer true sizes. The folder is removed when the driver ends, or with the scratch() around it.
    """
    spark = df.sparkSession
    if not _WRITTEN:
        atexit.register(remove_written)
    path = f"{shared_dir(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder or file of any file system that Hadoop knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def remove_written(keep: int = 0) -> None:
    """Remove the folders made by written(), but for the first `keep`; a stopped session is no error."""
    while len(_WRITTEN) > keep:
        try:
            remove_path(*_WRITTEN.pop())
        except Exception:
            pass


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Removes at its end what written() made within; results that read such tables must be saved by then."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        remove_written(before)


def is_small(df: DataFrame, max_bytes: int) -> bool:
    """Whether the optimizer's size estimate of df is at most max_bytes; an unknown size counts as large."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """df with a broadcast hint if its estimated size is within max_bytes; else as it is, for a shuffled join."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def distinct_rows(df: DataFrame) -> DataFrame:
    """df with equal rows once, without a shuffle of all its values: rows are told apart by two 64-bit hashes, and only those
    whose hashes occur again are compared."""
    h = df.withColumns({"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit(1), *df.columns)})
    again = written(h.groupBy("_h1", "_h2").count().where("count > 1").select("_h1", "_h2"), "again")
    again = broadcast_if_small(again)
    once = h.join(again, ["_h1", "_h2"], "left_anti").select(*df.columns)
    return once.unionByName(h.join(again, ["_h1", "_h2"], "left_semi").select(*df.columns).distinct())


def blank_to_null(c: Column | str) -> Column:
    """Lower-cased and without surrounding white space; null where nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.regexp_replace(c, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")), F.lit(""))
