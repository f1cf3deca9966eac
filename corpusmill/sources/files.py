"""Sources and sinks: shards, partitions by split, sidecars, and small driver-side artifacts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD_ROWS = 5000


def read_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None, kind: str = "parquet", limit: int | None = None) -> DataFrame:
    """A folder of Parquet, JSON, CSV, ORC or text files; with a schema nothing is inferred. limit, if given, keeps that many rows."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    d = r.format(kind).load(path)
    return d if limit is None else d.limit(limit)


def raw_records(df: DataFrame, repo: str, id_cols: tuple[str, ...] = ("id", "doc_id")) -> DataFrame:
    """(doc_id, source, text) of records of any source: text, else content, else empty; the first id that is there, else a hash of the record."""
    text = F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in ("text", "content") if c in df.columns), F.lit(""))
    ids = [F.col(c).cast("string") for c in id_cols if c in df.columns]
    return df.select(F.coalesce(*ids, F.concat(F.lit(f"{repo}_"), F.substring(F.sha2(F.to_json(F.struct(*df.columns)), 256), 1, 16))).alias("doc_id"), F.lit(repo).alias("source"), text.alias("text"))


def write_shards(df: DataFrame, path: str, rows: int = SHARD_ROWS, mode: str = "append", by: list[str] | None = None) -> None:
    """Snappy Parquet files of at most `rows` rows; `by` makes a folder per value, a split for example."""
    w = df.write.mode(mode).option("maxRecordsPerFile", rows).option("compression", "snappy")
    (w.partitionBy(*by) if by else w).parquet(path)


def shards(df: DataFrame) -> DataFrame:
    """(file, n_rows) of the files a table is read from."""
    return df.select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A small text file, written by the driver to any file system that Hadoop knows; it replaces an older one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(p):
        return None
    f = system.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(f)).decode()
    finally:
        f.close()


def write_sidecar(spark: SparkSession, path: str, content: dict) -> None:
    """A small JSON file beside a table, with sorted keys."""
    write_text(spark, path, json.dumps(content, indent=2, sort_keys=True, default=str))


def write_rows_json(df: DataFrame, path: str) -> None:
    """A log table as line-delimited JSON, written by the executors."""
    df.write.mode("overwrite").json(path)


def dense_array(df: DataFrame, size: int, at: str = "token_id", value: str = "log_p"):
    """A small dense column as a float32 array on the driver; `size` bounds it. Missing places are nan."""
    import numpy as np

    out = np.full(size, np.nan, dtype=np.float32)
    for r in df.where(F.col(at).between(0, size - 1)).select(at, value).toLocalIterator():
        out[r[0]] = r[1]
    return out
