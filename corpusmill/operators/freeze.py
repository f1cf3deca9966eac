"""Checks of a frozen corpus: the two layers agree, shards are unchanged, splits stay apart."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.tokens import file_sha256


def same_artifact(**hashes: str | None) -> str:
    """The hash that all places state; ValueError names the places if one differs or is missing."""
    if len(set(hashes.values())) != 1 or None in hashes.values():
        raise ValueError("the artifact hashes differ: " + ", ".join(f"{k}={v}" for k, v in sorted(hashes.items())))
    return next(iter(hashes.values()))


def special_ids(vocabulary: dict[str, int], *names: str) -> dict[str, int]:
    """The ids of special tokens; ValueError if one is missing or two are the same."""
    ids = {n: vocabulary[n] for n in names if n in vocabulary}
    if len(ids) < len(names) or len(set(ids.values())) < len(ids):
        raise ValueError(f"special tokens are missing or not distinct: {ids}")
    return ids


def cached_digests(folder: str, known: dict[str, tuple] | None = None) -> dict[str, tuple]:
    """By file (size, time of change, sha256); files whose size and time are known are not read again."""
    out = {}
    for name in sorted(os.listdir(folder)):
        path = os.path.join(folder, name)
        if os.path.isfile(path):
            st = os.stat(path)
            old = (known or {}).get(name)
            out[name] = old if old and tuple(old[:2]) == (st.st_size, st.st_mtime_ns) else (st.st_size, st.st_mtime_ns, file_sha256(path))
    return out


def alignment(a: DataFrame, b: DataFrame, id_col: str = "document_id") -> DataFrame:
    """(document_id, side) of ids that only one layer has: a_only or b_only."""
    x, y = a.select(id_col).distinct().withColumn("_a", F.lit(True)), b.select(id_col).distinct().withColumn("_b", F.lit(True))
    d = x.join(y, id_col, "full_outer").where("_a is null or _b is null")
    return d.select(F.col(id_col), F.when(F.col("_b").isNull(), "a_only").otherwise("b_only").alias("side"))


def first_mismatch(a: DataFrame, b: DataFrame, id_col: str, ids: str) -> DataFrame:
    """(document_id, first_index) of documents whose id arrays differ: the first index, or the shorter length."""
    d = a.select(id_col, F.col(ids).alias("_x")).join(b.select(id_col, F.col(ids).alias("_y")), id_col).where(~F.col("_x").eqNullSafe(F.col("_y")))
    same = F.zip_with("_x", "_y", lambda p, q: F.coalesce(p == q, F.lit(False)))
    at = F.array_position(same, False).cast("int") - 1
    return d.select(id_col, at.alias("first_index"))


def reencoded_mismatch(a: DataFrame, b: DataFrame, encode: Callable[[DataFrame, str, str], DataFrame], id_col: str = "document_id", text: str = "normalized_text", ids: str = "token_ids") -> DataFrame:
    """(document_id, first_index) of documents of both layers where the encoding of a text of layer A is not what layer B has.

    encode: (rows, id column, text column) -> (doc_id, ids). A null text has no ids, and null ids count as none. If an id has
    several rows, each text is compared with each list, and the least index is given.
    """
    x = encode(a.where(F.col(id_col).isNotNull()), id_col, text).select(F.col("doc_id").alias(id_col), F.col("ids").alias(ids))
    y = b.select(id_col, F.coalesce(ids, F.array().cast("array<int>")).alias(ids))
    return first_mismatch(x, y, id_col, ids).groupBy(id_col).agg(F.min("first_index").alias("first_index"))


def checksums(spark: SparkSession, path: str, pattern: str = "*.parquet", chunk: int = 8 << 20) -> DataFrame:
    """(file, bytes, sha256) of the files of a folder, hashed on the executors in chunks; a file is never held as a whole."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            out = []
            for p in b.column("path").to_pylist():
                system, at = fs.FileSystem.from_uri(p.replace("file:/", "file:///", 1) if p.startswith("file:/") and not p.startswith("file://") else p)
                h = hashlib.sha256()
                with system.open_input_stream(at) as f:
                    while part := f.read(chunk):
                        h.update(part)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("length"), pa.array(out, pa.string())], names=["path", "bytes", "sha256"])

    found = d.select("path", "length").mapInArrow(run, "path string, bytes long, sha256 string")  # the content itself is not read by the scan
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "bytes", "sha256")


def changed_shards(frozen: DataFrame, now: DataFrame) -> DataFrame:
    """(file, problem): missing, added or modified against the frozen checksums."""
    x = frozen.select("file", F.col("sha256").alias("_f"))
    d = x.join(now.select("file", F.col("sha256").alias("_n")), "file", "full_outer")
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_f").isNull(), "added").when(F.col("_n") != F.col("_f"), "modified")
    return d.select("file", problem.alias("problem")).where("problem is not null")


def split_violations(views: DataFrame, documents: DataFrame) -> DataFrame:
    """(view_id, document_id, view_split, document_split) of listed documents that belong to another split (both given; case and blanks aside)."""
    norm = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    v = views.select("view_id", norm("split").alias("view_split"), F.explode("source_document_ids").alias("document_id"))
    d = documents.select("document_id", norm("split").alias("document_split")).distinct()
    return v.join(d, "document_id").where("view_split <> document_split").select("view_id", "document_id", "view_split", "document_split").distinct()
