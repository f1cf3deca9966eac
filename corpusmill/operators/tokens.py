"""Around tokenizers: training sample, pre-token counts, spans of characters as spans of tokens, artifact hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.operators.segment import span_array

#: The pre-tokens of byte-level BPE: contractions, letters, digits or others with the blank before, white space.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def sample_per_source(df: DataFrame, source: str, order: str, n: int = 5000) -> DataFrame:
    """The first n rows per source by order. Ranks are cut twice: within hashed parts, then among what is left of each
    source, so no source is sorted as one."""
    part = F.pmod(F.xxhash64(order), F.lit(64))
    d = df.withColumn("_p", part).withColumn("_r", F.row_number().over(Window.partitionBy(source, "_p").orderBy(order))).where(F.col("_r") <= n)
    return d.withColumn("_r", F.row_number().over(Window.partitionBy(source).orderBy(order))).where(F.col("_r") <= n).drop("_p", "_r")


def pretoken_counts(df: DataFrame, text: str, least: int = 2) -> DataFrame:
    """(pretoken, n) of the pre-tokens that occur at least `least` times."""
    d = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(PRETOKEN), F.lit(0))).alias("pretoken"))
    return d.groupBy("pretoken").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def to_token_spans(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Character spans as token spans: from the first token that begins at or after a span's start to the last that ends at
    or before its end; empty ones are dropped. starts and ends of the tokens are in order."""
    if not len(spans):
        return []
    a, b = np.searchsorted(starts, spans[:, 0], "left"), np.searchsorted(ends, spans[:, 1], "right")
    return [(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if y > x]


def token_spans(spans: Column, offsets: Column) -> Column:
    """to_token_spans of two array<struct<start,end>>; none where either is null."""

    def pairs(c: pa.Array) -> list[np.ndarray]:
        return [np.array([(s["start"], s["end"]) for s in x or ()], dtype=np.int64).reshape(-1, 2) for x in c.to_pylist()]

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def run(s: pa.Array, o: pa.Array) -> pa.Array:
        return span_array([to_token_spans(x, y[:, 0], y[:, 1]) for x, y in zip(pairs(s), pairs(o), strict=True)])

    return run(spans, offsets)


def file_sha256(path: str) -> str:
    """SHA-256 of a small artifact on the driver."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
